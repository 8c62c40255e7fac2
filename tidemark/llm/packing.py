"""Packing by minimum bin slack: a bitset subset-sum picks the multiset of remaining lengths that
fills each sequence closest to its capacity.

Documents are encoded once and cut into full pieces of `capacity` ids and one remainder; pieces with
their checksums are written out, so what follows never touches a text again. The plan needs only how
many pieces there are of each length, at most `capacity` numbers: take the longest length left, find
by bitset which sums the others can reach, walk back to the counts of the best sum, and use that
pattern as often as the counts allow. Each pattern exhausts a length, so there are few. Pieces get
their place from their rank among pieces of equal length; ranks are counted within salted groups, so
a length shared by a third of all rows is spread over `salts` groups.

Edge cases: a NULL text counts as empty and still yields its end id; NULL ids pass through; repeated
rows are packed one by one; an empty table gives no sequences. Other input columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import stored
from tidemark.llm.tokens import Merger

END_ID = 1


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int, with_ids: bool = False) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens[, ids]): each document's ids and end id, cut into pieces."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merger = Merger(tokenizer_path)
        for batch in batches:
            row, start, length, crc, total, ids = [], [], [], [], [], []
            for i, text in enumerate(batch.column(1).to_pylist()):
                coded = merger.packed(text) + END_ID.to_bytes(4, "little")
                n = len(coded) // 4
                for s in range(0, n, capacity):
                    part = coded[4 * s:4 * (s + capacity)]
                    row.append(i)
                    start.append(s)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
                    total.append(n)
                    if with_ids:
                        ids.append(part)
            numbers = [pa.array(x, pa.int64()) for x in (start, length, crc, total)]
            more = [pa.array(ids, pa.binary())] if with_ids else []
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row, pa.int64())), *numbers, *more],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", *["ids"] * with_ids])

    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).mapInArrow(
        run, f"doc_id {id_type}, start long, length long, ids_crc32 long, doc_tokens long{', ids binary' if with_ids else ''}")


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Patterns as (times, [(length, uses)]) that together use every counted piece exactly once."""
    left = {n: c for n, c in counts.items() if c > 0}
    out = []
    while left:
        longest = max(left)
        left[longest] -= 1
        uses = best_fill(left, longest, capacity)
        left[longest] += 1
        uses[longest] = uses.get(longest, 0) + 1
        times = min(left[n] // k for n, k in uses.items())
        out.append((times, sorted(uses.items(), reverse=True)))
        for n, k in uses.items():
            left[n] -= times * k
            if not left[n]:
                del left[n]
    return out


def best_fill(left: dict[int, int], used: int, capacity: int) -> dict[int, int]:
    """How many pieces of which lengths bring `used` closest to capacity, within the counts.

    reach[k] has bit s set if the first k steps can add up to s. A full sequence is best, then one
    whose length is a power of two, since that needs no padding either, then the longest.
    """
    room = capacity - used
    reach, steps = [1], []
    full = (1 << (room + 1)) - 1
    for n in sorted((n for n, c in left.items() if c and n <= room), reverse=True):
        most, size = min(left[n], room // n), 1
        while most > 0 and not reach[-1] >> room & 1:
            take = min(size, most)  # 1, 2, 4, ... and the rest make up every count
            steps.append((n, take))
            reach.append((reach[-1] | reach[-1] << (n * take)) & full)
            most -= take
            size *= 2
        if reach[-1] >> room & 1:
            break
    total = reach[-1].bit_length() - 1
    if total < room:
        even = [1 << b for b in range(capacity.bit_length()) if used <= 1 << b <= capacity
                and reach[-1] >> ((1 << b) - used) & 1]
        total = even[-1] - used if even else total
    uses: dict[int, int] = {}
    for k in range(len(steps), 0, -1):
        if not reach[k - 1] >> total & 1:
            n, take = steps[k - 1]
            uses[n] = uses.get(n, 0) + take
            total -= n * take
    return uses


def _places(patterns) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, uses, first sequence, offset) of each pattern's share of a length, sorted."""
    rank: dict[int, int] = {}
    rows, sequence = [], 0
    for times, uses in patterns:
        offset = 0
        for n, k in uses:
            rows.append((n, rank.get(n, 0), k, sequence, offset))
            rank[n] = rank.get(n, 0) + k * times
            offset += n * k
        sequence += times
    return sorted(rows)


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = 2048, salts: int = 64, with_ids: bool = False) -> DataFrame:
    """One row per piece with sequence_id and offset; see pieces() for the other columns."""
    cut = stored(pieces(docs, tokenizer_path, capacity, with_ids).withColumn("uid", F.monotonically_increasing_id()), "pieces")
    cut = cut.withColumn("salt", F.pmod(F.xxhash64("uid"), F.lit(salts)))
    groups = cut.groupBy("length", "salt").count()
    counts = {r["length"]: r["n"] for r in groups.groupBy("length").agg(F.sum("count").alias("n")).collect()}
    places = _places(plan(counts, capacity))
    before = groups.select("length", "salt", (F.sum("count").over(
        Window.partitionBy("length").orderBy("salt")) - F.col("count")).alias("base"))  # capacity * salts rows at most
    ranked = cut.withColumn("k", F.row_number().over(Window.partitionBy("length", "salt").orderBy("uid"))).join(
        F.broadcast(before), ["length", "salt"]).withColumn("rank", F.col("base") + F.col("k") - 1)
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", *["ids"] * with_ids]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        at = np.array(places, dtype=np.int64).reshape(-1, 5)
        keys = at[:, 0] << 48 | at[:, 1]
        for batch in batches:
            n, rank = (batch.column(c).to_numpy() for c in (batch.schema.get_field_index("length"), batch.num_columns - 1))
            _, first, uses, sequence, offset = at[np.searchsorted(keys, n << 48 | rank, side="right") - 1].T
            own = rank - first
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(sequence + own // uses), pa.array(offset + own % uses * n)],
                names=[*batch.schema.names[:-1], "sequence_id", "offset"])

    schema = ", ".join(f"{c} {cut.schema[c].dataType.simpleString()}" for c in columns)
    return ranked.select(*columns, "rank").mapInArrow(run, f"{schema}, sequence_id long, offset long")
