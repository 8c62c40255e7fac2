"""SimHash near duplicates, found by pigeonring filtering.

A fingerprint has one bit per bit of the shingle hashes, set where more than half of them have it. Texts
link when their fingerprints differ in at most `max_bits` bits.

1. Texts become fingerprints in one pass; equal fingerprints are one node from there on, so a group of
   copies is one row.
2. The bits lie on a ring of `segments` segments. If two fingerprints differ in t bits of m segments, then
   some segment starts a chain along the ring in which the first j segments differ in at most j*t/m bits,
   for every j. The first segments of such a chain must be equal, and of the next, which may hold one
   difference, one half must be equal: those bits are the keys under which fingerprints meet. What meets
   is pruned by the budgets of the whole chain before all bits are counted.
3. A key that more than `crowd` fingerprints share, as in a cluster of near copies, is not paired. Its
   fingerprints meet at every value one flipped bit away instead: two of them share such a value exactly
   if at most two bits differ, and at most 65 can share one, which makes this exact and bounded as well.
4. Links become components. Only links that span what met at a value are kept for a crowd.

Edge cases: NULL, empty and blank texts have the fingerprint zero and link like any other. Texts of fewer
than `width` words are one shingle. Repeated shingles count as often as they occur. NULL ids take part, and
a component is named by its smallest id that is not NULL. Repeated rows repeat their result. Other columns
are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import repeat
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored
from tidemark.llm.components import components

WIDTH = 3
SEED = 42
MAX_BITS = 2
SEGMENTS = 4
CROWD = 200
BITS = 64
HASHES_AT_ONCE = 65_536
# ASCII upper case to lower; bytes.split() takes exactly the separators \t to \r and the space
FOLD = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def shingle_hashes(words: list[bytes], width: int) -> Iterator[np.ndarray]:
    """XXH64 of every word n-gram of a text, in bounded pieces."""
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(width, len(words)) - 1
    starts, ends = starts[:len(starts) - k].tolist(), ends[k:].tolist()
    for at in range(0, len(starts), HASHES_AT_ONCE):
        cuts = [joined[s:e] for s, e in zip(starts[at:at + HASHES_AT_ONCE], ends[at:at + HASHES_AT_ONCE])]
        yield np.fromiter(map(xxhash.xxh64_intdigest, cuts, repeat(SEED)), dtype="<u8", count=len(cuts))


def fingerprint(text: str | None, width: int = WIDTH) -> int:
    """The fingerprint as an unsigned number; zero for a text without words."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(FOLD).split()
    if not words:
        return 0
    total, set_in = 0, np.zeros(BITS, dtype=np.int64)
    for hashes in shingle_hashes(words, width):
        total += len(hashes)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        set_in += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * set_in > total, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """(doc_id, fingerprint) of every document, the fingerprint as a long of the same 64 bits."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.fromiter((fingerprint(t.as_py(), width) for t in batch.column(1)), dtype=np.uint64, count=batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], names=["doc_id", "fingerprint"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {id_type}, fingerprint long")


class Key(NamedTuple):
    """Bits that must be equal, and the chains along the ring that ask for it."""

    mask: int
    starts: tuple[int, ...]


class Ring:
    """Segments of the 64 bits and the budgets of chains along them."""

    def __init__(self, max_bits: int = MAX_BITS, segments: int = SEGMENTS):
        if not 0 <= max_bits < segments <= BITS:
            raise ValueError("a ring needs more segments than bits that may differ")
        self.max_bits, self.segments = max_bits, segments
        borders = [BITS * i // segments for i in range(segments + 1)]
        self.masks = [(1 << high) - (1 << low) for low, high in zip(borders, borders[1:])]

    def budget(self, length: int) -> int:
        """Most bits in which a chain's first segments may differ."""
        return length * self.max_bits // self.segments

    def along(self, start: int, first: int, last: int) -> int:
        """Bits of the segments number first to last - 1 after start."""
        return reduce(int.__or__, (self.masks[(start + j) % self.segments] for j in range(first, last)), 0)

    def keys(self) -> list[Key]:
        lengths = range(1, self.segments + 1)
        equal = max(n for n in (0, *lengths) if self.budget(n) == 0)
        single = max(n for n in (0, *lengths) if self.budget(n) <= 1)
        middle = (equal + single + 1) // 2
        parts = [(equal, middle), (middle, single)] if single - equal > 1 else [(0, 0)]
        found: dict[int, list[int]] = {}
        for start in range(self.segments):
            for part in parts:
                found.setdefault(self.along(start, 0, equal) | self.along(start, *part), []).append(start)
        return [Key(mask, tuple(starts)) for mask, starts in found.items()]

    def viable(self, difference: Column, key: Key) -> Column:
        """Whether one of the key's chains stays within its budgets, from its first segment to all bits."""
        def chain(start: int) -> Column:
            lengths = [n for n in range(1, self.segments + 1) if n == self.segments or self.budget(n) < self.budget(n + 1)]
            return reduce(Column.__and__, [
                F.bit_count(difference.bitwiseAND(_long(self.along(start, 0, n)))) <= self.budget(n) for n in lengths])

        return reduce(Column.__or__, [chain(start) for start in key.starts])


def _long(bits: int) -> Column:
    return F.lit(bits - (1 << BITS) if bits >> (BITS - 1) else bits).cast("long")


def shared_keys(nodes: DataFrame, keys: list[Key]) -> DataFrame:
    """(slot, bits, node, n): the keys of each fingerprint that n > 1 fingerprints have."""
    all_keys = nodes.select("node", F.posexplode(F.array(*[
        F.col("node").bitwiseAND(_long(k.mask)) for k in keys])).alias("slot", "bits"))
    sizes = all_keys.groupBy("slot", "bits").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return all_keys.join(sizes, ["slot", "bits"])


def crowd_links(nodes: DataFrame, max_bits: int) -> DataFrame:
    """Spanning links (a, b) among distinct fingerprints by the values one flipped bit away, at most 65 at each."""
    near = F.array(F.col("node"), *[F.col("node").bitwiseXOR(_long(1 << i)) for i in range(BITS)])
    at = nodes.select("node", F.explode(near).alias("value")).groupBy("value").agg(F.collect_list("node").alias("members"))
    centre = F.array_min("members") if max_bits == 2 else F.when(F.array_contains("members", F.col("value")), F.col("value"))
    return at.where(F.size("members") > 1).select(F.explode("members").alias("a"), centre.alias("b")).where("a <> b")


def links(nodes: DataFrame, max_bits: int = MAX_BITS, segments: int = SEGMENTS, crowd: int = CROWD) -> DataFrame:
    """Links (a, b) that connect all distinct fingerprints (node) within max_bits of each other."""
    if not 0 <= max_bits <= 2:
        raise ValueError("crowds are settled for at most two bits")
    if max_bits == 0:
        return nodes.select(F.col("node").alias("a"), F.col("node").alias("b")).where("a <> b")
    ring = Ring(max_bits, segments)
    keys = ring.keys()
    shared = stored(shared_keys(nodes, keys), "simhash-keys")
    few = shared.where(F.col("n") <= crowd).drop("n")
    difference = F.col("a").bitwiseXOR(F.col("b"))
    viable = reduce(Column.__or__, [(F.col("slot") == i) & ring.viable(difference, k) for i, k in enumerate(keys)])
    pairs = few.withColumnRenamed("node", "a").join(few.withColumnRenamed("node", "b"), ["slot", "bits"]).where(
        (F.col("a") < F.col("b")) & viable).select("a", "b")
    crowded = shared.where(F.col("n") > crowd).select("node").distinct()
    return pairs.unionByName(crowd_links(crowded, max_bits))


def near_duplicates(
    docs: DataFrame, width: int = WIDTH, max_bits: int = MAX_BITS, segments: int = SEGMENTS, crowd: int = CROWD
) -> DataFrame:
    """(doc_id, fingerprint, component_id): 16 hex digits, and the smallest id reachable by links."""
    marked = stored(fingerprints(docs, width), "simhash")
    nodes = stored(marked.groupBy("fingerprint").agg(F.min("doc_id").alias("first_id")).withColumnRenamed("fingerprint", "node"), "simhash-nodes")
    roots = components(links(nodes.select("node"), max_bits, segments, crowd))
    linked = nodes.join(roots, "node")
    named = linked.groupBy("root").agg(F.min("first_id").alias("component_id"))
    joined = nodes.join(linked.join(named, "root").select("node", "component_id"), "node", "left")
    # a written table on both sides of the last join lets Spark split the documents of one fingerprint
    names = stored(joined.select(
        F.col("node").alias("fingerprint"), F.coalesce("component_id", "first_id").alias("component_id")), "simhash-names")
    return marked.join(names, "fingerprint").select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")
