import collections
import zlib

import numpy as np
from pyspark.sql import functions as F
from llm_helpers import documents, tokens, words  # noqa: F401
from test_pair_operators import classes, removed
from test_text_operators import hits, windows_of

import corpus_pipeline
from tidemark.llm import quality
from tidemark.llm.common import stored, table
from tidemark.llm.queries import vocabulary


def test_stages_take_effect(spark, sf_dir, documents):  # noqa: F811
    docs, kept = table(spark, sf_dir, "documents"), []
    columns = docs.columns
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stored(stage(spark, docs, sf_dir), "stage")
        if i + 1 < len(corpus_pipeline.STAGES):
            assert docs.columns == columns, name
            kept.append({r.doc_id: r for r in docs.collect()})
            assert docs.count() == len(kept[-1])
    good, single, cut, clean = kept
    # quality: no base failure is left, and nearly all that passes it is
    measured = table(spark, sf_dir, "documents").select("doc_id", quality.measures(F.col("text")).alias("m"))
    base_ok = {r.doc_id for r in measured.where(~quality.base_failed(F.col("m"))).select("doc_id").collect()}
    assert set(good) <= base_ok and len(good) > 0.8 * len(base_ok)
    # near duplicates: the smallest id of every class of what the first stage kept
    found = classes([(i, r.text) for i, r in good.items()])
    assert set(single) == {i for i, (n, c) in found.items() if c == i}
    # repeated strings: what brute force keeps, but for characters that a cut breaks
    expected = {i: n - gone for i, n, gone, _, _ in removed([(i, r.text) for i, r in single.items()], 200)}
    assert set(cut) == set(single) and all(0 <= expected[i] - len(r.text.encode()) <= 8 for i, r in cut.items())
    # benchmark: no window is left, and texts without one are as before
    windows = windows_of([(r.item_id, r.text) for r in table(spark, sf_dir, "benchmark").collect()])
    assert all(hits(r.text, windows)[1] == 0 and r.n_chars == len(r.text) for r in clean.values())
    assert all(i in clean and clean[i].text == r.text for i, r in cut.items() if hits(r.text, windows)[1] == 0)
    # packing: every id of every document once
    from tokenizers import Tokenizer

    library, pieces = Tokenizer.from_file(vocabulary("byte_bpe_50k.json")), collections.defaultdict(list)
    for r in docs.collect():
        pieces[r.doc_id].append(r)
    assert set(pieces) == set(clean)
    for i, r in clean.items():
        ids, at = np.array([*library.encode(r.text, add_special_tokens=False).ids, 1], "<u4"), 0
        for p in sorted(pieces[i], key=lambda p: p.start):
            assert p.start == at and p.ids_crc32 == zlib.crc32(ids[at:at + p.length].tobytes())
            at += p.length
        assert at == len(ids)


def test_run_gives_the_last_stage(spark, tmp_path):
    rows = [(i, " ".join(f"{chr(97 + i)}{k}" for k in range(40)), "en", "s", 9) for i in range(5)]
    rows += [(5, None, None, None, None), (6, "", "en", "s", 0), (None, " ".join(f"q{k}" for k in range(40)), "en", "s", 9), rows[0]]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in got} == {0, 1, 2, 3, 4, None} and all(r.start == 0 for r in got)
