import collections
import hashlib
import random
import unicodedata
import zlib

import numpy as np
import pytest
from conftest import rows
from llm_helpers import documents, make, run, words  # noqa: F401
from llm_helpers import tokens as split
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, langid, licenses, packing, quality, tokens
from tidemark.llm.queries import vocabulary


EDGE = [(1, None), (2, ""), (3, " \n\t "), (4, "x " * 30_000), (5, "same words here"), (5, "same words here"), (None, "no id at all")]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))


# ---- quality rules

def counted(text):
    w = split(text)
    at = collections.defaultdict(list)
    for i in range(len(w) - 4):
        at[tuple(w[i:i + 5])].append(i)
    again = {j for where in at.values() if len(where) > 1 for i in where for j in range(i, i + 5)}
    lines = [x for x in (text or "").split("\n") if split(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(again)


def test_quality_counts(run, documents):
    for r in run("op8_quality_rules").collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == counted(documents[r.doc_id])
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert not (r.base_failed and r.kept)


def test_quality_edges_and_plan(make):
    from conftest import plan_of

    measured = make([*EDGE, (6, "a b c d e f a b c d e"), (7, "ñ €x\n\nñ €x\n")]).select("doc_id", quality.measures(F.col("text")).alias("m"))
    for r in measured.collect():
        text = {**dict(EDGE), 6: "a b c d e f a b c d e", 7: "ñ €x\n\nñ €x\n"}[r.doc_id]
        assert (r.m.n_words, r.m.word_chars, r.m.n_symbols, r.m.n_dup_lines, r.m.n_repeat_words) == counted(text)
    assert "Python" not in plan_of(measured) and "Arrow" not in plan_of(measured)


def test_decision_list_finds_a_planted_rule(spark):
    rng = random.Random(1)
    docs, labels = [], []
    for i in range(600):
        bad = i % 3 == 0
        text = " ".join(rng.choice("abcdefgh") * rng.randint(2, 6) + ("##" if bad else "") for _ in range(30))
        docs.append((i, text))
        labels.append((i, int(not bad)))
    labels += [(0, 1), (1, None), (2, 7), (None, 0)]  # contradicted, unknown and nameless labels
    measured = spark.createDataFrame(docs, "doc_id long, text string").select("doc_id", quality.measures(F.col("text")).alias("m"))
    examples = quality.labelled(measured, spark.createDataFrame(labels, "doc_id long, quality int")).persist()
    found = quality.fit_list(examples)
    kept = measured.where(found.keeps(F.col("m"))).select("doc_id").collect()
    assert found.rules and {r.doc_id for r in kept} == {i for i in range(600) if i % 3}
    assert not quality.fit_list(examples.where("not bad")).rules


def measured_by_hand(text):
    n_words, chars, symbols, dup, again = counted(text)
    lines = sum(bool(split(x)) for x in (text or "").split("\n"))
    of = lambda test: sum(map(test, text or "")) / max(chars, 1)
    return {"n_words": n_words, "mean_word": chars / max(n_words, 1), "symbol_rate": symbols / max(chars, 1),
            "dup_line_rate": dup / max(lines, 1), "repeat_rate": again / max(n_words, 1),
            "upper_rate": of(lambda c: unicodedata.category(c) == "Lu"), "digit_rate": of(lambda c: c in "0123456789"),
            "mark_rate": of(lambda c: c in "!?")}


@pytest.mark.parametrize("n_bad", [20, 30, 300])
def test_a_clear_rule_is_found_whatever_the_number_of_labels(spark, n_bad):
    """One in ten is bad and shows it; kept equals the learned rules applied by hand."""
    rng = random.Random(n_bad)
    docs = []
    for i in range(10 * n_bad):
        word = lambda: rng.choice("abcdefgh") * rng.randint(2, 6)  # noqa: B023, E731
        docs.append((i, " ".join(word() + ("##" if i % 10 == 0 and k % 4 == 0 else "") for k in range(30))))
    frame = spark.createDataFrame(docs, "doc_id long, text string").select("doc_id", quality.measures(F.col("text")).alias("m"))
    labels = spark.createDataFrame([(i, int(i % 10 != 0)) for i, _ in docs], "doc_id long, quality int")
    found = quality.fit_list(quality.labelled(frame, labels).persist())
    kept = {r.doc_id for r in frame.where(found.keeps(F.col("m"))).select("doc_id").collect()}
    by_hand = {i for i, text in docs if not any(
        all((measured_by_hand(text)[t.feature] > t.threshold) == t.above for t in rule) for rule in found.rules)}
    assert found.rules and kept == by_hand == {i for i, _ in docs if i % 10}


@pytest.mark.parametrize("n", [40, 400])
def test_noise_gives_no_rule(spark, n):
    rng = random.Random(n)
    docs = [(i, " ".join(rng.choice("abcdefgh") * rng.randint(2, 6) for _ in range(30))) for i in range(n)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").select("doc_id", quality.measures(F.col("text")).alias("m"))
    labels = spark.createDataFrame([(i, rng.randint(0, 1)) for i in range(n)], "doc_id long, quality int")
    assert not quality.fit_list(quality.labelled(frame, labels).persist()).rules


def test_query_keeps_what_the_rules_say(run, spark, sf_dir, documents):
    rows = run("op8_quality_rules").collect()
    frame = spark.createDataFrame(list(documents.items()), "doc_id long, text string").select("doc_id", quality.measures(F.col("text")).alias("m"))
    rules = quality.fit_list(quality.labelled(frame, spark.read.parquet(f"{sf_dir}/labels.parquet")).persist()).rules
    for r in rows:
        values = measured_by_hand(documents[r.doc_id])
        hit = [k + 1 for k, rule in enumerate(rules) if all((values[t.feature] > t.threshold) == t.above for t in rule)]
        assert r.rule == (hit or [0])[0] and r.kept == (not r.base_failed and not hit)


def test_values_at_a_threshold_and_equal_values(spark):
    """All rows at one value of each measure, then bad rows exactly one symbol above good ones."""
    same = [(i, "word " * 2 + " ".join("abcdefghijkl")) for i in range(60)]
    frame = spark.createDataFrame(same, "doc_id long, text string").select("doc_id", quality.measures(F.col("text")).alias("m"))
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, quality int")
    assert not quality.fit_list(quality.labelled(frame, labels).persist()).rules
    docs = [(i, " ".join("abcdefghijkl") + (" ##" if i % 2 == 0 else " #z")) for i in range(60)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").select("doc_id", quality.measures(F.col("text")).alias("m"))
    found = quality.fit_list(quality.labelled(frame, labels).persist())
    assert {r.doc_id for r in frame.where(found.keeps(F.col("m"))).select("doc_id").collect()} == set(range(1, 60, 2))


def test_precision_bounds():
    assert quality.precision_bound(0, 0, 0.05) == 0 and quality.precision_bound(0, 0, 0.05, upper=True) == 1
    assert quality.precision_bound(27, 0, 0.05) == pytest.approx(27 / (27 + 1.6448536**2))
    assert quality.precision_bound(5, 5, 0.05) < 0.5 < quality.precision_bound(5, 5, 0.05, upper=True)
    assert not quality.accepted(20, 0, 0, 0, 0.1, 100, 0.95, 0.05)


# ---- decontamination

def windows_of(items):
    out = collections.defaultdict(set)
    for name, text in items:
        w = words(text)
        for k in range(max(1, len(w) - 9) if w else 0):
            out[tuple(w[k:k + 10])].add(str(name))
    return out


def hits(text, windows):
    w, hit, names = words(text), set(), set()
    for size in {len(k) for k in windows}:
        for k in range(len(w) - size + 1):
            found = windows.get(tuple(w[k:k + size]))
            if found:
                names |= found
                hit.update(range(k, k + size))
    return len(w), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()


@pytest.mark.parametrize("block_words", [200_000, 60])
def test_contamination(spark, make, block_words):
    rng = random.Random(3)
    docs = [(i, " ".join(rng.choice("abcd") for _ in range(rng.randint(0, 60)))) for i in range(150)] + [(500 + i, t) for i, (_, t) in enumerate(EDGE)]
    items = [(i, " ".join(rng.choice("abcd") for _ in range(rng.randint(0, 14)))) for i in range(40)] + [(90, None), (91, "!?"), (3, "repeated item id")]
    found = decontaminate.contamination(make(docs), spark.createDataFrame(items, "item_id long, text string"), block_words=block_words)
    windows, text = windows_of(items), dict(docs)
    for r in found.select("doc_id", "n_words", decontaminate.hit_words(F.col("spans")), F.size("items"),
                          F.sha2(F.array_join("items", ","), 256)).collect():
        assert tuple(r)[1:] == hits(text[r.doc_id], windows)


def test_blocks_hold_what_they_may(spark, make):
    """Every piece is in one block, and no block has more words than allowed."""
    items = [(i, " ".join(f"w{i}x{k}" for k in range(1 + i * 7 % 90))) for i in range(60)] + [(99, "one " * 500), (100, None)]
    pieces, n = decontaminate.item_pieces(spark.createDataFrame(items, "item_id long, text string"), 10, 100)
    blocks = list(decontaminate.item_blocks(pieces, n))
    assert n == len(blocks) > 20 and max(sum(len(w) for _, w in b) for b in blocks) <= 100
    windows = lambda w: {tuple(w[i:i + 10]) for i in range(max(1, len(w) - 9))}
    assert set().union(*(windows(w) for b in blocks for _, w in b)) == set().union(*(windows(t.split()) for _, t in items if t))
    assert decontaminate.contamination(make([]), spark.createDataFrame(items, "item_id long, text string"), block_words=100).collect() == []
    assert decontaminate.contamination(make([]), spark.createDataFrame([], "item_id long, text string")).collect() == []


def test_contamination_of_given_tables(spark, sf_dir, run, documents):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    windows = windows_of(items)
    for r in run("op1_benchmark_decontamination").collect():
        assert (r.n_words, r.n_hit, r.n_items, r.items_sha256) == hits(documents[r.doc_id], windows)
        assert r.contaminated == (r.n_hit > 0)


def test_decontaminate_leaves_no_window_and_clean_texts_alone(spark, make):
    rng = random.Random(4)
    items = [(i, " ".join(rng.choice("abcdefgh") for _ in range(12))) for i in range(20)]
    docs = [(i, "Start. " + " ".join(rng.choice("pqrs") for _ in range(30)) + (", " + items[i % 20][1] + "! End" if i % 2 else "")) for i in range(60)]
    docs += [(100, items[0][1]), (101, None), (102, "")]
    left = decontaminate.decontaminate(make(docs), spark.createDataFrame(items, "item_id long, text string"))
    got, windows = {r.doc_id: r for r in left.collect()}, windows_of(items)
    assert all(hits(r.text, windows)[1] == 0 for r in got.values())
    assert 100 not in got and got[101].text is None and got[102].text == ""
    assert all(got[i].text == t for i, t in docs if i < 100 and i % 2 == 0)
    assert all(got[i].text.startswith("Start. ") and got[i].text.endswith("! End") for i in range(1, 60, 2))
    assert left.columns == make(docs).columns
    empty = decontaminate.decontaminate(make(docs), spark.createDataFrame([], "item_id long, text string"))
    assert empty.count() == len(docs)


def test_decontaminate_is_the_same_in_any_number_of_blocks(spark, make):
    rng = random.Random(8)
    items = [(i, " ".join(f"{c}{i}_{k}" for k in range(15) for c in "uv")) for i in range(12)]
    items += [(50 + i, " ".join(rng.choice("ab") for _ in range(rng.randint(4, 12)))) for i in range(12)]
    own = lambda i, n: " ".join(f"o{i}_{k}" for k in range(n))
    docs = [(i, " ".join(rng.choice("abc") for _ in range(80)) + " " + own(i, rng.randint(0, 60))) for i in range(60)]
    for i in range(12):  # each item inside each other one, and pairs of items that only together pass the limit
        for j in range(12):
            if i != j:
                w = items[i][1].split()
                docs.append((100 + 12 * i + j, f"{own(0, 30)}. {' '.join(w[:9])} {items[j][1]} {' '.join(w[9:18])} {own(1, 20)}"))
                docs.append((300 + 12 * i + j, f"{items[i][1]} {own(2, 10)} {items[j][1]}"))
    docs += [docs[70], (900, None), (901, ""), (None, docs[70][1])]
    windows = windows_of(items)

    def expected(text):
        total = gone = 0
        w = words(text)
        while True:
            hit = {x for k in range(len(w)) for n in {len(x) for x in windows} if tuple(w[k:k + n]) in windows for x in range(k, k + n)}
            if not hit:
                return w
            total, gone = total or len(w), gone + len(hit)
            if gone > 0.8 * total:
                return None
            w = [x for k, x in enumerate(w) if k not in hit]

    want = sorted(((i, w) for i, t in docs if (w := expected(t)) is not None), key=str)
    assert len(want) < len(docs)
    texts = []
    for block_words in (200_000, 60):
        left = decontaminate.decontaminate(make(docs), spark.createDataFrame(items, "item_id long, text string"), block_words=block_words)
        assert left.columns == make(docs).columns
        got = left.collect()
        assert sorted(((r.doc_id, words(r.text)) for r in got), key=str) == want
        texts.append(sorted(((r.doc_id, r.text) for r in got), key=str))
    assert texts[0] == texts[1]


# ---- token counts and packing

def test_token_counts_are_the_librarys(run, documents, library):
    for r in run("op3_token_counts").collect():
        n = len(library.encode(documents[r.doc_id], add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(documents[r.doc_id].encode()), n, n > 512)


def test_token_counts_of_odd_texts(library, make):
    rng = random.Random(1)
    parts = [*"aZé ñ  \n\t'sl.,#5½²Ωж日 —\x1c\x85​", "<|endoftext|>", "'ll", "\n\n", "hello", " world"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(500)]
    docs = list(enumerate(texts)) + [(600 + i, t) for i, (_, t) in enumerate(EDGE)]
    counted_ = {r.doc_id: r for r in tokens.count_tokens(make(docs), vocabulary("byte_bpe_50k.json")).collect()}
    merger = tokens.Merger(vocabulary("byte_bpe_50k.json"))
    for i, t in docs:
        ids = library.encode(t or "", add_special_tokens=False).ids
        assert counted_[i].n_tokens == len(ids) and counted_[i].n_bytes == len((t or "").encode())
        assert merger.packed(t or "") == np.asarray(ids, "<u4").tobytes()


def test_only_stretches_around_disputed_characters_go_to_the_library(library):
    rng = random.Random(3)
    single = tokens.proven_single(library)
    counter = tokens.TokenCounter(vocabulary("byte_bpe_50k.json"), single)
    parts = [*"aé  \n\u00a0€😀日\u3000'", "'ll", "word", " word", " next", " 12", " €", "  ", " x"]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 25)))
        cut = list(tokens.stretches(text))
        assert "".join(p for _, p in cut) == text
        assert all(settled == (not tokens.UNSETTLED.search(p)) and p for settled, p in cut)
        assert counter.count(text) == len(library.encode(text, add_special_tokens=False).ids), text
    text = "plain words here " * 1000 + "costs 5€ now " + "and more of them " * 1000 + "one"
    assert [p for settled, p in tokens.stretches(text) if not settled] == [" 5€ now"]
    for many in ("€" * 200_000, " " * 200_000 + "€", "€ " * 100_000):  # nothing to cut at; linear
        assert counter.count(many) == len(library.encode(many, add_special_tokens=False).ids)


def test_tables_without_rows(spark, make):
    empty = make([])
    assert tokens.count_tokens(empty, vocabulary("byte_bpe_50k.json")).collect() == []
    assert licenses.scan_licenses(empty).collect() == []
    items = spark.createDataFrame([("a", "some words of an item")], "item_id string, text string")
    assert decontaminate.contamination(empty, items).collect() == [] and decontaminate.decontaminate(empty, items).collect() == []
    assert langid.predict(empty, langid.fit(spark.createDataFrame([("le chat", "fr")], "text string, lang string"))).collect() == []


def test_packing(run, documents, library):
    by_doc, by_sequence = collections.defaultdict(list), collections.defaultdict(list)
    for r in run("op6_packing").collect():
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    for doc, text in documents.items():
        ids, at = np.array([*library.encode(text, add_special_tokens=False).ids, 1], "<u4"), 0
        for p in sorted(by_doc[doc], key=lambda p: p.start):
            assert (p.start, p.doc_tokens, p.ids_crc32) == (at, len(ids), zlib.crc32(ids[at:at + p.length].tobytes()))
            at += p.length
        assert at == len(ids)
    padding = 0
    for held in by_sequence.values():
        at = 0
        for p in sorted(held, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= 2048
        padding += 2048 - at if at & (at - 1) else 0
    assert padding < 2048 + 0.01 * 2048 * len(by_sequence)


def test_packing_edges(make, spark):
    packed = packing.pack(make(EDGE), vocabulary("byte_bpe_50k.json"), capacity=64, salts=4, with_ids=True).collect()
    assert sum(p.length for p in packed if p.doc_id in (1, 2)) == 2 and sum(p.doc_id is None for p in packed) == 1
    assert sum(p.doc_id == 5 for p in packed) == 2
    places = collections.defaultdict(list)
    for p in packed:
        assert len(p.ids) == 4 * p.length and zlib.crc32(p.ids) == p.ids_crc32
        places[p.sequence_id].append((p.offset, p.length))
    for held in places.values():
        ends = 0
        for offset, length in sorted(held):
            assert offset == ends
            ends += length
        assert ends <= 64
    assert packing.pack(spark.createDataFrame([], "doc_id long, text string"), vocabulary("byte_bpe_50k.json")).count() == 0


def test_plan_uses_every_piece_once_and_fills_best():
    rng = random.Random(2)
    for _ in range(30):
        counts = {rng.randint(1, 40): rng.randint(1, 5) for _ in range(6)}
        used = collections.Counter()
        for times, uses in packing.plan(counts, 40):
            assert sum(n * k for n, k in uses) <= 40
            used.update({n: k * times for n, k in uses})
        assert used == counts
        longest = max(counts)
        left = {**counts, longest: counts[longest] - 1}
        sums = {0}
        for n, c in left.items():
            sums |= {s + n * k for s in sums for k in range(c + 1)}
        best = max(s for s in sums if longest + s <= 40)
        uses = packing.best_fill(left, longest, 40)
        total = longest + sum(n * k for n, k in uses.items())
        assert all(k <= left[n] for n, k in uses.items())
        assert total == longest + best or (longest + best < 40 and total & (total - 1) == 0)


# ---- licences

def test_licence_expressions():
    assert licenses.postfix("MIT OR Apache-2.0 AND GPL-2.0 WITH Classpath-exception-2.0") == [
        "mit", "apache-2.0", "gpl-2.0", "classpath-exception-2.0", "with", "and", "or"]
    assert licenses.postfix("(MIT OR Apache-2.0) AND BSD-3-Clause") == ["mit", "apache-2.0", "or", "bsd-3-clause", "and"]
    for broken in ("", "MIT OR", "OR MIT", "(MIT", "MIT)", "MIT Apache-2.0", "()", "MIT , ISC"):
        assert not licenses.postfix(broken)
    value = lambda x: licenses.evaluate(licenses.postfix(x))
    assert value("MIT OR GPL-3.0") == ({"mit", "gpl-3.0"}, True)
    assert value("MIT AND GPL-3.0") == ({"mit", "gpl-3.0"}, False)
    assert value("(MIT AND ISC) WITH x") is None and value("GPL-2.0 WITH x") == ({"gpl-2.0-with-x"}, False)


def test_license_scan(run, documents, make):
    phrases = {p.__str__(): label for p, label in licenses.BASE_PHRASES.items()}

    def expected(text):
        w, at, labels = words(text), [], set()
        for phrase, label in phrases.items():
            p = phrase.split()
            for i in range(len(w) - len(p) + 1):
                if w[i:i + len(p)] == p:
                    at.append(i)
                    labels.add(label)
        return len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels))

    for r in run("op4_license_scans").collect():
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == expected(documents[r.doc_id])
        assert set(r.base_labels.split(",")) - {""} <= set(r.labels.split(",")) and 0 <= r.score <= 1
    odd = [*EDGE, (10, "The MIT--License, mit license?\nGNU Lesser General  Public\nLicense apache license"), (11, "emit license mit licenses"),
           (12, "# SPDX-License-Identifier: (MIT OR Apache-2.0) \nx"), (13, "// SPDX-License-Identifier: MIT OR\nmit license"),
           (14, "/* spdx-license-identifier: GPL-2.0 WITH Linux-syscall-note */")]
    found = {r.doc_id: r for r in licenses.scan_licenses(make(odd)).collect()}
    for i, text in odd:
        r = found[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, ",".join(r.base_labels)) == expected(text)
    assert found[10].labels == ["apache", "gpl", "lgpl", "mit"] and found[11].labels == []
    assert found[12].labels == ["apache-2.0", "mit"] and found[12].score == 1.0 and found[12].tags[0].permitted
    assert found[13].labels == ["mit"] and not found[13].tags[0].valid
    assert found[14].labels == ["gpl-2.0-with-linux-syscall-note"] and found[14].tags[0].permitted is False


def test_license_tags_of_odd_lines(make):
    tag = "SPDX-License-Identifier:"
    odd = [(1, f"{tag} MIT\u00a0\nx"), (2, f"{tag} Größe\u00a0à"), (3, f"{tag} NONE"), (4, f"{tag} noassertion"), (5, f"{tag} MIT {tag} ISC -->"),
           (6, f"{tag} à"), (7, f"{tag} " * 20_000), (8, f"{tag}{' ' * 300_000}MIT{' ' * 300_000}x"), (9, f"{tag} " + " or ".join(f"l{i}" for i in range(40_000))),
           (10, f"{tag}\u2003ISC"), (11, f"{tag} {'(' * 100_000}MIT{')' * 100_000}")]
    found = {r.doc_id: r for r in licenses.scan_licenses(make(odd)).collect()}
    assert [found[i].labels for i in (1, 2, 3, 4, 5, 6, 10, 11)] == [["mit"], [], [], [], ["isc", "mit"], [], ["isc"], ["mit"]]
    assert found[2].tags[0].expression == "größe\u00a0à" and found[6].tags[0].expression == "à"
    assert [(t.valid, t.permitted) for t in found[3].tags] == [(True, False)] and found[3].score == found[4].score == 0.0
    assert [t.expression for t in found[5].tags] == ["mit", "isc"] and found[5].score == 1.0
    assert len(found[7].tags) == 20_000 and found[7].labels == [] and not found[8].tags[0].valid
    assert len(found[9].labels) == 40_000


# ---- languages

def test_held_out_languages(run, spark, sf_dir):
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = run("op2_language_id").collect()
    assert len(got) == len(lang) and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.95 * len(held)


def test_language_edges(spark, make):
    none = langid.predict(make(EDGE), langid.fit(spark.createDataFrame([], "text string, lang string")))
    assert {r.lang_pred for r in none.collect()} == {"und"}
    one = spark.createDataFrame([("le chat", "fr"), (None, "de"), ("der hund", None)], "text string, lang string")
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.predict(make([*EDGE, (9, "12 34 !?")]), langid.fit(one)).collect()}
    assert got[1] == got[2] == got[3] == got[9] == ("und", 0.0) and got[4] == ("fr", 1.0)
    assert langid.family("pt-BR") == "romance" and langid.family("tlh") == "tlh"
    assert ("family", "germanic", "romance") in langid._pairs(["de", "en", "es", "fr"])
    assert rows(none.groupBy("score").count()) == [(0.0, len(EDGE))]


def test_many_labels_make_few_machines(spark, make):
    names = [f"x{i:04d}" for i in range(500)] + ["de", "en", "fr"]
    pairs = langid._pairs(names)
    assert len(pairs) < 10 * len(names)
    paths = langid.paths(names)
    assert len(set(paths.values())) == len(names) and paths["de"][-2:] == ("germanic", "de")
    between = {(level, *sorted(p)) for level, *p in pairs}
    for a, b in random.Random(4).sample([(a, b) for a in names for b in names if a < b], 2000):  # one machine tells any two apart
        d = next(i for i, (x, y) in enumerate(zip(paths[a], paths[b], strict=False)) if x != y)
        assert (paths[a][:d] or "family", *sorted((paths[a][d], paths[b][d]))) in between
    rng = random.Random(5)
    letters = {x: "".join(rng.sample("abcdefghijklmnopqrstuvwxyz", 6)) for x in names[:40]}
    say = lambda x: " ".join("".join(rng.choice(letters[x]) for _ in range(5)) for _ in range(30))
    train = [(say(x), x) for x in letters for _ in range(5)] + [("only once", "rare")]
    model = langid.fit(spark.createDataFrame(train, "text string, lang string"), per_side=20, max_languages=40)
    assert sorted(letters) == model[0]
    test = [(i, x, say(x)) for i, x in enumerate(sorted(letters))]
    got = {r.doc_id: r.lang_pred for r in langid.predict(make([(i, t) for i, _, t in test]), model).collect()}
    assert sum(got[i] == x for i, x, _ in test) >= 30
