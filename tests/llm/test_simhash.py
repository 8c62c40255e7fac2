"""SimHash near duplicates against brute force, and the ring's guarantee."""

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from llm_helpers import LOWER, documents, make, run, tokens  # noqa: F401
from tidemark.llm import simhash


def brute_fingerprint(text):
    w = tokens((text or "").translate(LOWER))
    grams = [" ".join(w[i:i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_roots(values, max_bits=2):
    """The least index of each value's component."""
    root = list(range(len(values)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, v in enumerate(values):
        for j in range(i):
            if (v ^ values[j]).bit_count() <= max_bits:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(values))]


def expected(texts):
    ids = sorted(texts)
    prints = [brute_fingerprint(texts[i]) for i in ids]
    return {i: (f"{p:016x}", ids[r]) for i, p, r in zip(ids, prints, brute_roots(prints))}


def test_query_equals_brute_force(run, documents):
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in run("op11_simhash_near_dedup").collect()}
    assert got == expected(documents)


def test_edges(spark, make):
    texts = {1: None, 2: "", 3: " \t\n", 4: "one", 5: "ONE", 6: "one two", 7: "a b c", 8: "a b c a b c a b c", 9: "x " * 70_000 + "y",
             10: "Äb äB c d e", 11: "\x1fodd word here"}
    rows = [*texts.items(), (7, "a b c"), (None, "one")]
    got = simhash.near_duplicates(make(rows)).collect()
    assert len(got) == len(rows)
    want = expected(texts)
    assert {(r.doc_id, r.fingerprint, r.component_id) for r in got} == {
        (i, *v) for i, v in want.items()} | {(None, *want[4])}
    assert simhash.near_duplicates(make([])).collect() == []


def flipped(rng, value, n):
    for b in rng.sample(range(64), n):
        value ^= 1 << b
    return value


def cluster_values(seed):
    """Far values, chains of near ones, and one dense cluster."""
    rng = random.Random(seed)
    values = [rng.getrandbits(64) for _ in range(60)]
    for v in values[:30]:
        near = flipped(rng, v, 2)
        values += [near, flipped(rng, near, 2), flipped(rng, v, 3)]
    hub = rng.getrandbits(64)
    values += [flipped(rng, hub, rng.randint(0, 4)) for _ in range(150)]
    return sorted(set(values))


@pytest.mark.parametrize("max_bits,segments,crowd", [(2, 4, 200), (2, 4, 1), (2, 4, 5), (2, 3, 1000), (2, 8, 1000), (1, 2, 1000), (1, 2, 1), (1, 4, 3), (0, 2, 5)])
def test_links_connect_what_is_near(spark, max_bits, segments, crowd):
    values = cluster_values(max_bits * 100 + segments)
    signed = np.array(values, dtype=np.uint64).view(np.int64).tolist()
    nodes = spark.createDataFrame([(v,) for v in signed], "node long")
    found = [tuple(r) for r in simhash.links(nodes, max_bits, segments, crowd).collect()]
    unsigned = dict(zip(signed, values))
    assert all((unsigned[a] ^ unsigned[b]).bit_count() <= max_bits for a, b in found)
    place = {v: i for i, v in enumerate(signed)}
    root = list(range(len(values)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in found:
        x, y = find(place[a]), find(place[b])
        root[max(x, y)] = min(x, y)
    assert [find(i) for i in range(len(values))] == brute_roots(values, max_bits)


@pytest.mark.parametrize("max_bits,segments", [(1, 2), (1, 3), (2, 3), (2, 4), (2, 5), (2, 8), (2, 16), (5, 8)])
def test_every_near_pair_shares_a_viable_key(max_bits, segments):
    ring, rng = simhash.Ring(max_bits, segments), random.Random(segments)
    keys = ring.keys()
    for _ in range(2000):
        difference = flipped(rng, 0, rng.randint(0, max_bits))
        assert any(
            difference & k.mask == 0 and any(
                all((difference & ring.along(s, 0, n)).bit_count() <= ring.budget(n) for n in range(1, segments + 1)) for s in k.starts)
            for k in keys)


def test_crowd_stays_small_and_keys_carry_no_text(spark):
    """A third of all fingerprints in one dense cluster: what meets at a value is at most 65."""
    values = cluster_values(7)
    nodes = spark.createDataFrame([(v,) for v in np.array(values, dtype=np.uint64).view(np.int64).tolist()], "node long")
    near = F.array(F.col("node"), *[F.col("node").bitwiseXOR(simhash._long(1 << i)) for i in range(64)])
    largest = nodes.select(F.explode(near).alias("v")).groupBy("v").count().agg(F.max("count")).first()[0]
    assert 1 < largest <= 65
    assert len(simhash.Ring().keys()) == 6
    with pytest.raises(ValueError):
        simhash.links(nodes, 3, 6)
    with pytest.raises(ValueError):
        simhash.Ring(4, 4)
