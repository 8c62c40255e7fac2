"""Hard negatives of anchors: Strassen products of anchor and candidate tiles, then mergeable heaps.

Scores are inner products of integer vectors, floor(scale * x) of each component. The anchors are cut into
blocks of bounded size; each block is broadcast and meets the candidates in two scans without a shuffle of
candidates. A task multiplies an anchor tile with a candidate tile by Strassen's recursion in int64, with
zeros where a side is odd, so scores are exact.

1. Each task keeps a heap of the `positives` best rows of the anchor's own label; heaps of tasks merge.
2. With an anchor's positives known, each task keeps for each of them a heap of the `negatives` best rows of
   other labels whose score lies in the positive's window; these merge as well.

What a task sends is at most a heap for each anchor of the block, whatever the candidates are. Better means
a higher score, or a smaller id at the same score.

Edge cases: rows with a NULL id, label or vector, or with a NULL or non-finite component, take no part;
neither do vectors with a component beyond `largest` after scaling, whose scores a long could not hold.
Vectors of different lengths count as filled up with zeros. An id is a row: the row itself and its
repetitions are not its positives, and a repeated candidate counts once. An id that stands for
several vectors or labels is an anchor, and a candidate, for each of them; their rows are returned separately.
Other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import stored
from tidemark.llm.vectors import integers, matrix, product, usable, within
from tidemark.session import shared_dir

SCALE = 256
POSITIVES, NEGATIVES = 5, 3
WINDOW = (50, 95)
BLOCK = 32_768
ANCHOR_TILE, CANDIDATE_TILE = 512, 4096
LEAF = 32
LARGEST = 1 << 22
_NONE = np.iinfo(np.int64).min


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """a @ b in int64 by seven half-sized products; an odd side gets a row or column of zeros."""
    n, k = a.shape
    m = b.shape[1]
    if min(n, k, m) <= leaf:
        return product(a, b)
    a = np.pad(a, ((0, n % 2), (0, k % 2)))
    b = np.pad(b, ((0, k % 2), (0, m % 2)))
    i, j, p = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:i, :j], a[:i, j:], a[i:, :j], a[i:, j:]
    b11, b12, b21, b22 = b[:j, :p], b[:j, p:], b[j:, :p], b[j:, p:]
    m1 = strassen(a11 + a22, b11 + b22, leaf)
    m2 = strassen(a21 + a22, b11, leaf)
    m3 = strassen(a11, b12 - b22, leaf)
    m4 = strassen(a22, b21 - b11, leaf)
    m5 = strassen(a11 + a12, b22, leaf)
    m6 = strassen(a21 - a11, b11 + b12, leaf)
    m7 = strassen(a12 - a22, b21 + b22, leaf)
    c = np.empty((2 * i, 2 * p), dtype=np.int64)
    c[:i, :p] = m1 + m4 - m5 + m7
    c[:i, p:] = m3 + m5
    c[i:, :p] = m2 + m4
    c[i:, p:] = m1 - m2 + m3 + m6
    return c[:n, :m]


class Heaps:
    """The best `size` (score, id) of each of n lists, better ones first."""

    def __init__(self, n: int, size: int):
        self.size = size
        self.scores = np.full((n, size), _NONE, dtype=np.int64)
        self.ids = np.zeros((n, size), dtype=np.int64)
        self.filled = np.zeros(n, dtype=np.int64)

    def offer(self, rows: slice, scores: np.ndarray, ids: np.ndarray, allowed: np.ndarray) -> None:
        """Take in a tile: a line of scores for each list in rows, a column for each id."""
        last, last_id = self.scores[rows, -1][:, None], self.ids[rows, -1][:, None]
        full = self.filled[rows][:, None] == self.size
        better = allowed & (~full | (scores > last) | ((scores == last) & (ids < last_id)))
        line, column = np.nonzero(better)
        if len(line):
            self._merge(line + rows.start, scores[line, column], ids[column])

    def _merge(self, lists: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        touched = np.unique(lists)
        held = np.arange(self.size)[None, :] < self.filled[touched][:, None]
        lists = np.concatenate((lists, np.repeat(touched, self.filled[touched])))
        scores = np.concatenate((scores, self.scores[touched][held]))
        ids = np.concatenate((ids, self.ids[touched][held]))
        order = np.lexsort((ids, ~scores, lists))  # ~score falls as the score rises, without overflow
        lists, scores, ids = lists[order], scores[order], ids[order]
        fresh = np.ones(len(lists), dtype=bool)
        fresh[1:] = (lists[1:] != lists[:-1]) | (scores[1:] != scores[:-1]) | (ids[1:] != ids[:-1])
        lists, scores, ids = lists[fresh], scores[fresh], ids[fresh]
        begins = np.flatnonzero(np.concatenate(([True], lists[1:] != lists[:-1])))
        rank = np.arange(len(lists)) - np.repeat(begins, np.diff(np.append(begins, len(lists))))
        kept = rank < self.size
        lists, scores, ids, rank = lists[kept], scores[kept], ids[kept], rank[kept]
        self.scores[lists, rank], self.ids[lists, rank] = scores, ids
        self.filled[touched] = np.bincount(lists, minlength=len(self.filled))[touched]

    def batch(self, per_slot: int = 1) -> pa.RecordBatch:
        """Rows (slot, place, score, id); with several lists a slot, place is the number of the list."""
        at, rank = np.nonzero(np.arange(self.size)[None, :] < self.filled[:, None])
        return pa.RecordBatch.from_arrays(
            [pa.array(at // per_slot, pa.int32()), pa.array(at % per_slot, pa.int32()),
             pa.array(self.scores[at, rank]), pa.array(self.ids[at, rank])], names=["slot", "place", "score", "id"])


HEAP_ROWS = "slot int, place int, score long, id long"


def tiles(batches: Iterator[pa.RecordBatch], width: int, size: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Candidates (ids, labels, columns) in tiles of up to `size`."""
    held, n = [], 0

    def cut():
        rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        return (rows.column(0).to_numpy(), rows.column(1).to_numpy(), matrix(rows.column(2), width).T)

    for batch in batches:
        for at in range(0, batch.num_rows, size):
            piece = batch.slice(at, size)
            if n and n + piece.num_rows > size:
                yield cut()
                held, n = [], 0
            held.append(piece)
            n += piece.num_rows
    if n:
        yield cut()


def _ranges(n: int) -> Iterator[slice]:
    return (slice(at, min(at + ANCHOR_TILE, n)) for at in range(0, n, ANCHOR_TILE))


def best_positives(candidates: DataFrame, block, width: int, positives: int) -> DataFrame:
    """Heaps of each task: the best rows of the anchor's label, the anchor aside."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, labels, anchors = block.value
        heaps = Heaps(len(ids), positives)
        for other, label, columns in tiles(batches, width, CANDIDATE_TILE):
            for rows in _ranges(len(ids)):
                allowed = (labels[rows][:, None] == label) & (ids[rows][:, None] != other)
                heaps.offer(rows, strassen(anchors[rows], columns), other, allowed)
        yield heaps.batch()

    return candidates.mapInArrow(run, HEAP_ROWS)


def window_negatives(candidates: DataFrame, block, found, width: int, negatives: int, window: tuple[int, int]) -> DataFrame:
    """Heaps of each task: for each positive of an anchor, the best rows of other labels inside its window."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, labels, anchors = block.value
        low, high, n_found = found.value
        places = low.shape[1]
        heaps = [Heaps(len(ids), negatives) for _ in range(places)]
        for other, label, columns in tiles(batches, width, CANDIDATE_TILE):
            for rows in _ranges(len(ids)):
                scores = strassen(anchors[rows], columns)
                different = labels[rows][:, None] != label
                for place, heap in enumerate(heaps):
                    there = (place < n_found[rows])[:, None]
                    inside = there & (scores >= low[rows, place][:, None]) & (scores <= high[rows, place][:, None])
                    heap.offer(rows, scores, other, inside & different)
        for place, heap in enumerate(heaps):
            batch = heap.batch()
            yield batch.set_column(1, "place", pa.array(np.full(batch.num_rows, place), pa.int32()))

    return candidates.mapInArrow(run, HEAP_ROWS)


def merged(heaps: DataFrame, size: int) -> DataFrame:
    """The best `size` of each list over all tasks, with their rank from 1."""
    by_list = Window.partitionBy("slot", "place").orderBy(F.col("score").desc(), "id")
    return heaps.distinct().withColumn("rank", F.row_number().over(by_list)).where(F.col("rank") <= size)


def prepared(vectors: DataFrame, scale: int = SCALE, label: Column | None = None) -> DataFrame:
    """(vec_id, label, vector): the rows that take part, as integers."""
    rows = vectors.where(usable()).select(
        "vec_id", (F.col("label") if label is None else label).cast("long").alias("label"), integers("embedding", scale).alias("vector"))
    return rows.where("vec_id IS NOT NULL AND label IS NOT NULL").where(within(F.col("vector"), LARGEST))


def mine(
    candidates: DataFrame,
    anchors: DataFrame,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    window: tuple[int, int] = WINDOW,
    block_rows: int = BLOCK,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of prepared rows.

    A negative's score lies between window[0] and window[1] hundredths of the positive's. The driver holds one block of anchors,
    at most block_rows and usually half of that, and their positives, at a time.
    """
    spark = candidates.sparkSession
    width = max(t.agg(F.max(F.size("vector"))).first()[0] or 0 for t in (candidates, anchors))
    wanted = anchors.distinct()
    n_blocks = 1 + 2 * wanted.count() // block_rows
    number = F.pmod(F.xxhash64("vec_id", "label", "vector"), F.lit(n_blocks)).cast("int")
    blocks = stored(wanted.withColumn("block", number).repartition("block").sortWithinPartitions("block"), "anchor-blocks")
    path = shared_dir(spark, "hard-negatives")
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    for n in range(n_blocks):
        rows = blocks.where(F.col("block") == n).drop("block").toArrow().combine_chunks()
        if not rows.num_rows:
            continue
        rows = rows.to_batches()[0]
        ids = rows.column(0).to_numpy()
        sent = [spark.sparkContext.broadcast((ids, rows.column(1).to_numpy(), matrix(rows.column(2), width)))]
        best = merged(best_positives(candidates, sent[0], width, positives), positives).toArrow()
        slot, place, score, other = (best.column(c).to_numpy() for c in ("slot", "rank", "score", "id"))
        scores, others = (np.zeros((len(ids), positives), dtype=np.int64) for _ in range(2))
        scores[slot, place - 1], others[slot, place - 1] = score, other
        low, high = -(-window[0] * scores // 100), window[1] * scores // 100
        sent.append(spark.sparkContext.broadcast((low, high, np.bincount(slot, minlength=len(ids)))))
        hard = merged(window_negatives(candidates, *sent, width, negatives, window), negatives)
        named = spark.createDataFrame(
            pa.table({"slot": pa.array(slot.astype(np.int32)), "place": pa.array((place - 1).astype(np.int32)),
                      "anchor_id": ids[slot], "positive_id": other, "positive_score": score}))
        hard.join(named, ["slot", "place"]).select(
            "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score",
            F.col("score").alias("negative_score")).write.mode("append").parquet(path)
        for value in sent:
            value.destroy()
    return spark.read.schema(schema).parquet(path) if _written(spark, path) else spark.createDataFrame([], schema)


def _written(spark, path: str) -> bool:
    from tidemark.sources.files import exists

    return exists(spark, path)
