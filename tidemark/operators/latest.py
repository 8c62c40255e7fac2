"""Latest state per key: newest row, newest valid columns, and both in one pass.

All forms reduce rows on the map side, so a key holding a large share of the
rows reaches the shuffle as one row per map task.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.contracts import ColumnGroup


def _orderable(data_type: T.DataType) -> bool:
    if isinstance(data_type, T.MapType):
        return False
    if isinstance(data_type, T.ArrayType):
        return _orderable(data_type.elementType)
    if isinstance(data_type, T.StructType):
        return all(_orderable(f.dataType) for f in data_type.fields)
    return not isinstance(data_type, T.VariantType)


def _newest(schema: T.StructType, clock: str, columns: Sequence[tuple[str, str]], test: str | None) -> Column:
    """Struct of the newest row's columns; clock ties go to the larger columns, in order.

    Members without an order (maps) are carried along but cannot break ties.
    """
    members = [F.col(source).alias(output) for source, output in columns]
    whole = F.struct(*members)
    comparable = [source for source, _ in columns if _orderable(schema[source].dataType)]
    if len(comparable) == len(columns):
        return F.max(whole if test is None else F.when(F.expr(test), whole))
    rank = F.struct(*[F.col(c) for c in comparable])
    return F.max_by(whole, rank if test is None else F.when(F.expr(test), rank))


def latest_per_key(df: DataFrame, key: str, clock: str = "ts", tiebreak: str | None = None) -> DataFrame:
    """One row per key, the one with the largest clock. Columns: key, clock, rest.

    A single group that holds every column. Rows without a key belong to no key and are left out. Equal clocks go
    to the largest tiebreak, where one is given, and then to the larger other columns in order; NULLs are smallest.
    """
    others = [c for c in df.columns if c not in (key, clock)]
    first = [] if tiebreak in (None, key, clock) else [tiebreak]
    ordered = {c: c for c in (*first, *others)}
    newest = newest_structs(df, key, {"_newest": ColumnGroup(clock, ordered, None, clock)})
    return newest.select(key, *[F.col("_newest").getField(c).alias(c) for c in (clock, *others)])


def latest_by_row_number(df: DataFrame, key: str, clock: str = "ts", tiebreak: str | None = None) -> DataFrame:
    """The same by ranking rows; Spark limits each group to one row before the shuffle.

    Equal clocks go to the largest tiebreak, or without one to any of their rows here.
    """
    newest_first = Window.partitionBy(key).orderBy(*[F.col(c).desc() for c in (clock, tiebreak) if c])
    names = [clock, *[c for c in df.columns if c not in (key, clock)]]
    return (
        df.where(F.col(key).isNotNull())
        .withColumn("_rank", F.row_number().over(newest_first))
        .where("_rank = 1")
        .select(key, *names)
    )


def latest_valid(df: DataFrame, key: str, group: ColumnGroup) -> DataFrame:
    """Newest row per key among those passing the group's test, under output names."""
    rows = df if group.test is None else df.where(group.test)
    narrow = rows.select(key, group.source_clock, *group.columns)
    renames = {group.source_clock: group.clock, **group.columns}
    return latest_per_key(narrow, key, group.source_clock).select(
        key, *[F.col(c).alias(renames[c]) for c in renames]
    )


def combine_by_joins(df: DataFrame, key: str, groups: Sequence[ColumnGroup]) -> DataFrame:
    """One row per key with each group's newest columns: one aggregate per group, left joins.

    Rows without a key are dropped, as in newest_structs.
    """
    keyed = df.where(F.col(key).isNotNull())
    first, *others = groups
    return reduce(
        lambda left, group: left.join(latest_valid(keyed, key, group), key, "left"),
        others,
        latest_valid(keyed, key, first),
    )


def _group_struct(schema: T.StructType, group: ColumnGroup) -> Column:
    columns = [(group.source_clock, group.clock), *group.columns.items()]
    return _newest(schema, group.source_clock, columns, group.test)


def newest_structs(df: DataFrame, key: str, named_groups: dict[str, ColumnGroup]) -> DataFrame:
    """One row per key with one struct per group, all from a single aggregate.

    Rows without a key are dropped: they belong to no device, and no later row
    could ever match them.
    """
    aggregates = [_group_struct(df.schema, g).alias(name) for name, g in named_groups.items()]
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(*aggregates)


def combine_one_pass(df: DataFrame, key: str, groups: Iterable[ColumnGroup]) -> DataFrame:
    """Same rows as combine_by_joins from one scan and one shuffle."""
    named = {f"_g{i}": g for i, g in enumerate(groups)}
    structs = newest_structs(df, key, named)
    return structs.select(key, *[f"{name}.*" for name in named])
