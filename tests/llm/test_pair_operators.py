import collections
import random

import numpy as np
import pytest

from llm_helpers import LOWER, documents, make, run, tokens  # noqa: F401

from tidemark.llm import jaccard, substrings
from tidemark.llm.components import components


def shingles(text):
    w = tokens((text or "").translate(LOWER))
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def classes(docs):
    sets, holders, parent = {i: shingles(t) for i, t in docs}, collections.defaultdict(list), {}

    def root(a):
        while parent.setdefault(a, a) != a:
            a = parent[a]
        return a

    for i, own in sets.items():
        common = collections.Counter(j for s in own for j in holders[s])
        for s in own:
            holders[s].append(i)
        for j, n in common.items():
            if 100 * n >= 80 * (len(own) + len(sets[j]) - n):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return {i: (len(s), root(i)) for i, s in sets.items()}


def near_copies(seed=5, n=500):
    rng = random.Random(seed)
    base = [[rng.choice("abcdefghijklmnopqrstuvwxyz") + rng.choice("abcdefgh") for _ in range(rng.randint(0, 70))] for _ in range(20)]
    docs = []
    for i in range(n):
        w = list(base[0 if i % 3 == 0 else rng.randrange(20)])
        for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 6])):
            if w:
                w[rng.randrange(len(w))] = rng.choice("XYZ") * 2
        docs.append((i, " ".join(w)))
    return docs + [(n, None), (n + 1, ""), (n + 2, " \t\n"), (n + 3, "One"), (n + 4, "one"), (n + 5, "w%d " * 20_000 % tuple(range(20_000)))]


@pytest.mark.parametrize("group_size", [1000, 15])
def test_components_equal_brute_force(make, group_size):
    docs = near_copies()
    got = jaccard.near_duplicates(make(docs).repartition(3), group_size=group_size, frequent=40).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == classes(docs)


@pytest.mark.parametrize("hot", [5, 40])
def test_shingles_of_many_documents_are_dealt_into_shares(make, monkeypatch, hot):
    docs, dealt, stored = near_copies(), [], jaccard.stored

    def watched(df, label):
        out = stored(df, label)
        if label == "hot":
            dealt.append(out)
        return out

    monkeypatch.setattr(jaccard, "stored", watched)
    got = jaccard.near_duplicates(make(docs).repartition(3), group_size=15, frequent=400, hot=hot).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == classes(docs)
    of_token = dealt[0].groupBy("token").count().agg({"count": "max"}).first()[0]
    of_task = dealt[0].groupBy("token", "share").count().agg({"count": "max"}).first()[0]
    assert of_task <= 2 * hot and (of_token > of_task or hot == 40)


def test_given_documents(run, documents):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in run("op9_ngram_jaccard_join").collect()}
    assert got == classes(documents.items())


def test_ids_may_be_missing_or_repeated(make, spark):
    text = "a b c d e f g h i j"
    docs = [(7, text), (None, text), (7, text), (9, text + " k"), (None, ""), (3, "other words are in this one")]
    got = sorted(((r.doc_id, r.component_id) for r in jaccard.near_duplicates(make(docs)).collect()), key=str)
    assert got == sorted([(7, 7), (7, 7), (None, 7), (9, 7), (None, None), (3, 3)], key=str)
    left = jaccard.one_of_each(make(docs))
    assert sorted((r.doc_id for r in left.collect()), key=str) == sorted([3, 7, None, None], key=str)
    assert left.columns == make(docs).columns
    assert jaccard.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_rows_of_one_id_go_by_their_own_text(make):
    text, other = "a b c d e f g h i j", "words that no one else has"
    docs = [(3, text), (7, text + " k"), (7, other), (7, ""), (8, other + " at all"), (None, text), (9, "q r s t u v w x y z"),
            (9, "q r s t u v w x y z 1"), (9, "entirely on its own here")]
    left = sorted(((r.doc_id, r.text) for r in jaccard.one_of_each(make(docs)).collect()), key=str)
    kept_9 = [x for x in left if x[0] == 9 and x[1].startswith("q")]
    assert len(kept_9) == 1
    assert left == sorted([docs[0], docs[2], docs[3], docs[4], docs[5], docs[8], *kept_9], key=str)


def test_long_texts_have_the_same_shingles_in_segments(monkeypatch):
    text = " ".join(f"w{i % 700}" for i in range(3000))
    whole = jaccard.Shingler().shingles(text)
    monkeypatch.setattr(jaccard, "SEGMENT_WORDS", 97)
    assert (jaccard.Shingler().shingles(text) == whole).all() and len(whole) == 700


def test_bound_is_never_above_what_links_share():
    rng = random.Random(1)
    for _ in range(300):
        a = set(rng.sample(range(400), rng.randint(1, 200)))
        b = set(a)
        for _ in range(rng.randint(0, 25)):
            b.discard(rng.randrange(400))
            b.add(rng.randrange(400))
        if 100 * len(a & b) >= 80 * len(a | b):
            lead = lambda s: set(sorted(s)[:len(s) // 5 + 1])
            assert len(lead(a) & lead(b)) >= jaccard.needed(len(a), len(b))


def test_matrix_needs_no_more_than_any_member_does():
    import numpy as np
    import pyarrow as pa

    rng = random.Random(2)
    cases = [[100, 100, 104, 105]] + [[x, *(rng.randint(-(-4 * x // 5), 5 * x // 4) for _ in range(rng.randint(2, 6)))]
                                      for x in range(5, 200) for _ in range(5)]
    for sizes in cases:  # the first asks the group of all others; they hold the same leading shingles
        n, shared = len(sizes), min(int(jaccard.needed(sizes[0], y)) for y in sizes[1:])
        if shared < 1:
            continue
        token = np.repeat(np.arange(shared, dtype=np.uint64), n)
        fact = np.array([(1, sizes[0], 0)] + [(2, y, 5) for y in sizes[1:]], np.int64)
        key = np.arange(2 * n, dtype=np.uint64)
        row = jaccard._matrix_rows(pa.table({c: pa.array([x.tobytes()], pa.binary()) for c, x in (
            ("token", token), ("owner", np.tile(np.arange(n, dtype=np.int32), shared)), ("key", key), ("fact", fact))})).to_pylist()
        assert [(r["key"], r["grp"], r["shared"]) for r in row] == [(key[:2].tobytes(), 2, shared)]
        assert row[0]["need"] <= shared, sizes


def test_connected_components(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 140)] + [(200, 201), (201, 200), (5, 5), (None, 3)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 140)} | {200: 200, 201: 200}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# ---- repeated byte strings

def removed(docs, length):
    import hashlib

    raw = [(i, (t or "").encode()) for i, t in docs]
    seen = collections.Counter(b[k:k + length] for _, b in raw for k in range(len(b) - length + 1))
    out = []
    for i, b in raw:
        covered = bytearray(len(b))
        for k in range(len(b) - length + 1):
            if seen[b[k:k + length]] > 1:
                covered[k:k + length] = b"\1" * length
        runs = sum(covered[k] and (k == 0 or not covered[k - 1]) for k in range(len(b)))
        out.append((i, len(b), sum(covered), runs, hashlib.sha256(bytes(x for x, c in zip(b, covered, strict=True) if not c)).hexdigest()))
    return out


def passages(seed=5, n=150):
    rng = random.Random(seed)
    shared = ["".join(rng.choice("abcdé ") for _ in range(rng.choice([150, 199, 200, 250, 400, 900]))) for _ in range(12)]
    docs = []
    for i in range(n):
        text = ""
        for _ in range(rng.randint(0, 6)):
            if rng.random() < .5:
                text += rng.choice(shared)[rng.choice([0, 0, 0, 3, 50]):rng.choice([None, None, -1, -40])]
            else:
                text += "".join(rng.choice("xyz ") for _ in range(rng.randint(0, 200)))
        docs.append((i, text))
    return docs + [(n, "a" * 1000), (n + 1, None), (n + 2, ""), (n + 3, docs[5][1]), (n + 4, "ab" * 300), (None, docs[7][1])]


@pytest.mark.parametrize(("batches", "hot"), [(1, 5000), (5, 5000), (3, 4)])
def test_removals_equal_brute_force(make, monkeypatch, batches, hot):
    docs = passages()
    monkeypatch.setattr(substrings.repeated_spans, "__defaults__", (200, batches, 64, hot))
    got = substrings.removals(make(docs).repartition(3), batches=batches).collect()
    assert sorted(map(tuple, got), key=str) == sorted(removed(docs, 200), key=str)


def test_removals_of_given_documents(run, documents):
    assert sorted(map(tuple, run("op5_suffix_array_dedup").collect())) == sorted(removed(documents.items(), 200))


def test_levels_merge_like_a_counter(make):
    index = substrings.SuffixIndex(12)
    docs = passages(n=40)
    seen = []
    for i in range(5):
        share = make([d for k, d in enumerate(docs) if k % 5 == i])
        index.add(substrings.prepared(share).select("key", "text"))
        seen.append(sorted(index.levels))
    assert seen == [[0], [1], [0, 1], [2], [0, 2]]


def test_levels_hold_suffixes_in_order_and_bound_frequent_ones(make):
    """Each bucket is sorted by content; of what many texts share, hot + 1 places stay, and all texts are flagged."""
    index, passage = substrings.SuffixIndex(3, hot=4), "The same long passage stands here. " * 8
    docs, flagged = [(i, f"{i:03d}{passage}{i * 7919:06d}") for i in range(60)], collections.defaultdict(set)
    for i in range(4):
        share = substrings.prepared(make([d for d in docs if d[0] % 4 == i]))
        for r in index.add(share.select("key", "text")).collect():
            flagged[r.key] |= set(zip(np.frombuffer(r.token, np.uint64).tolist(), np.frombuffer(r.hot, bool).tolist(), strict=True))
    assert len(flagged) == 60 and len({t for found in flagged.values() for t, hot in found if hot}) >= 1
    held = index.levels[2].collect()
    for r in held:
        contents = [r.suffix[k:k + 64] for k in range(0, len(r.suffix), 64)]
        assert contents == sorted(contents) and max(collections.Counter(contents).values()) <= 5
    every = set.intersection(*flagged.values())
    assert every and all(hot for _, hot in every)


def test_strip_keeps_columns_and_whole_characters(make, spark):
    passage = "é" * 150
    docs = [(1, "x" + passage + "1"), (2, "y" + passage + "2"), (3, None), (4, "short"), (5, "z" * 250), (6, "z" * 250)]
    left = substrings.strip(make(docs))
    got = {r.doc_id: r.text for r in left.collect()}
    assert got == {1: "x1", 2: "y2", 3: None, 4: "short", 5: "", 6: ""} and left.columns == make(docs).columns
    assert substrings.removals(spark.createDataFrame([], "doc_id long, text string")).count() == 0
