import os
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

REPO = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(REPO), str(REPO / "tests")]

from tidemark.session import configure  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tidemark-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "4g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.warehouse.dir", str(base / "warehouse"))
        .config("spark.checkpoint.dir", str(base / "shared"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield configure(session)
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def rows(df, *columns):
    """Rows as sorted tuples, NULLs first."""
    picked = df.select(*columns) if columns else df
    return sorted(
        (tuple(r) for r in picked.collect()),
        key=lambda r: tuple((v is not None, str(type(v)), v if v is not None else 0) for v in r),
    )


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
