"""Vector codes: each quarter of a vector becomes the index of its nearest codebook entry.

1. Vectors become integers and are cut into parts. A task takes `chunk` vectors at a time, sorts each
   part's pieces along a Hilbert curve and cuts them into flat blocks, which store the least and greatest
   value of every component (a box) and the components' sums. Chunks are written once; the rounds read them.
2. In each round the distances from a codebook entry to the nearest and the farthest point of a block's box
   bound what the entry can be to any piece inside. Entries whose nearest distance is above the least
   farthest one go; the rest are the block's shortlist. If that is one entry, it takes the block by its sums;
   else a small exact product gives the distances of the block's pieces to the shortlist.
3. Counts and sums of entries are partial aggregates of a task; the driver sees one row per entry.

All distances are integers and compared exactly, so the shortlist never changes a result. All parts of a
vector lie in one chunk row, so codes need no shuffle.

Edge cases: rows whose vector is NULL or has a NULL or non-finite component are dropped, as are those with a
component beyond `largest` after scaling, whose squared distances a long could not hold, and those whose
length differs from that of the row with the smallest id. A length that the parts do not divide is filled up
with zeros. Rows with a NULL id are coded but start no codebook. Fewer rows than `entries` give a smaller
codebook; repeated rows repeat their result, and may start several entries, of which the first takes all.
Other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored
from tidemark.llm.vectors import integers, matrix, product, usable, within

SCALE = 1024
PARTS, ENTRIES, ROUNDS = 4, 256, 4
CHUNK, BLOCK = 16_384, 128
LARGEST = 1 << 25
CURVE_BITS = 64
CHUNK_ROWS = "ids binary, null_ids binary, labels binary, null_labels binary, pieces binary, orders binary, low binary, high binary, sums binary"


def hilbert_order(points: np.ndarray) -> np.ndarray:
    """Places of the points along a Hilbert curve over their grid of 64 bits in all.

    The grid has as many bits a component as 64 allows, by rank of the value range of these points;
    components beyond the 64th do not take part. Coordinates become the curve's transposed index by the
    usual exchange and inversion of lower bits from the highest bit down, and a Gray code at the end.
    """
    n, width = points.shape
    width = min(width, CURVE_BITS)
    if not n or not width:
        return np.arange(n)
    bits = min(CURVE_BITS // width, 16)
    points = points[:, :width]
    low, span = points.min(axis=0), np.ptp(points, axis=0)
    x = ((points - low) * ((1 << bits) - 1) // np.maximum(span, 1)).astype(np.uint64)
    one = np.uint64(1)
    for level in range(bits - 1, 0, -1):
        below = np.uint64((1 << level) - 1)
        for i in range(width):
            is_set = (x[:, i] >> np.uint64(level) & one).astype(bool)
            swap = (x[:, 0] ^ x[:, i]) & below
            x[:, 0] ^= np.where(is_set, below, swap)
            if i:
                x[:, i] ^= np.where(is_set, np.uint64(0), swap)
    for i in range(1, width):
        x[:, i] ^= x[:, i - 1]
    flip = np.zeros(n, dtype=np.uint64)
    for level in range(bits - 1, 0, -1):
        flip ^= np.where(x[:, -1] >> np.uint64(level) & one, np.uint64((1 << level) - 1), np.uint64(0))
    x ^= flip[:, None]
    index = np.zeros(n, dtype=np.uint64)
    for level in range(bits - 1, -1, -1):
        for i in range(width):
            index = index << one | (x[:, i] >> np.uint64(level) & one)
    return np.argsort(index, kind="stable")


def split(vectors: np.ndarray, parts: int) -> np.ndarray:
    """Vectors (n, width) as pieces (n, parts, width of a part), filled up with zeros."""
    width = -(-vectors.shape[1] // parts)
    return np.pad(vectors, ((0, 0), (0, width * parts - vectors.shape[1]))).reshape(len(vectors), parts, width)


class Chunk:
    """Some vectors, and for each part their pieces in Hilbert order with the blocks' boxes and sums."""

    def __init__(self, pieces: np.ndarray, orders: np.ndarray, low: np.ndarray, high: np.ndarray, sums: np.ndarray):
        self.pieces, self.orders, self.low, self.high, self.sums = pieces, orders, low, high, sums

    @classmethod
    def of(cls, vectors: np.ndarray, parts: int, block: int) -> Chunk:
        vectors = split(vectors, parts)
        orders = np.stack([hilbert_order(vectors[:, p]) for p in range(parts)])
        pieces = np.stack([vectors[orders[p], p] for p in range(parts)])
        begins = np.arange(0, len(vectors), block)
        return cls(pieces, orders, *(f.reduceat(pieces, begins, axis=1) for f in (np.minimum, np.maximum, np.add)))

    def buffers(self) -> list[bytes]:
        return [a.astype("<i8").tobytes() for a in (self.pieces, self.orders, self.low, self.high, self.sums)]

    @classmethod
    def read(cls, buffers: list[bytes], n: int, parts: int, block: int) -> Chunk:
        pieces, orders, low, high, sums = (np.frombuffer(b, dtype="<i8") for b in buffers)
        width, blocks = len(pieces) // (n * parts), -(-n // block)
        return cls(pieces.reshape(parts, n, width), orders.reshape(parts, n),
                   *(a.reshape(parts, blocks, width) for a in (low, high, sums)))

    def shortlists(self, part: int, codebook: np.ndarray) -> np.ndarray:
        """Whether an entry may be nearest to a piece of a block, by blocks and entries."""
        low, high, entry = self.low[part][:, None, :], self.high[part][:, None, :], codebook[None, :, :]
        near = np.maximum(np.maximum(low - entry, entry - high), 0)
        far = np.maximum(np.abs(low - entry), np.abs(high - entry))
        nearest, farthest = (near * near).sum(axis=2), (far * far).sum(axis=2)
        return nearest <= farthest.min(axis=1)[:, None]

    def assign(self, part: int, codebook: np.ndarray, block: int, errors: bool) -> tuple[np.ndarray, np.ndarray | None, np.ndarray, np.ndarray]:
        """Codes and squared distances of the pieces in their order, and counts and sums of the entries."""
        pieces = self.pieces[part]
        codes, error = np.empty(len(pieces), dtype=np.int64), np.empty(len(pieces), dtype=np.int64) if errors else None
        counts, sums = np.zeros(len(codebook), dtype=np.int64), np.zeros_like(codebook)
        squares = (codebook * codebook).sum(axis=1)
        mixed = np.zeros(len(pieces), dtype=bool)
        for b, listed in enumerate(self.shortlists(part, codebook)):
            inside = slice(b * block, min((b + 1) * block, len(pieces)))
            short = np.flatnonzero(listed)
            if len(short) == 1:
                codes[inside] = short[0]
                counts[short[0]] += inside.stop - inside.start
                sums[short[0]] += self.sums[part, b]
            else:
                # |v - e|^2 less |v|^2, which all entries share; argmin takes the lowest of equal ones
                codes[inside] = short[np.argmin(squares[short] - 2 * product(pieces[inside], codebook[short].T), axis=1)]
                mixed[inside] = True
        counts += np.bincount(codes[mixed], minlength=len(codebook))
        np.add.at(sums, codes[mixed], pieces[mixed])
        if errors:
            error[:] = ((pieces - codebook[codes]) ** 2).sum(axis=1)
        return codes, error, counts, sums


def _numbers(column: pa.Array) -> list[bytes]:
    """Values as longs, and which are NULL."""
    return [column.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8").tobytes(),
            column.is_null().to_numpy(zero_copy_only=False).tobytes()]


def chunks(rows: DataFrame, width: int, parts: int, block: int, chunk: int) -> DataFrame:
    """The rows (vec_id, label, vector) as chunk rows of binary columns."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def cut() -> pa.RecordBatch:
            rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            made = Chunk.of(matrix(rows.column(2), width), parts, block)
            values = [*_numbers(rows.column(0)), *_numbers(rows.column(1)), *made.buffers()]
            return pa.RecordBatch.from_arrays([pa.array([v], pa.binary()) for v in values], names=CHUNK_ROWS.replace(" binary", "").split(", "))

        for batch in batches:
            for at in range(0, batch.num_rows, chunk):
                piece = batch.slice(at, chunk)
                if n and n + piece.num_rows > chunk:
                    yield cut()
                    held, n = [], 0
                held.append(piece)
                n += piece.num_rows
        if n:
            yield cut()

    return rows.mapInArrow(run, CHUNK_ROWS)


def _each(batches: Iterator[pa.RecordBatch], parts: int, block: int):
    for batch in batches:
        for i in range(batch.num_rows):
            ids, no_id, labels, no_label, *buffers = (c[i].as_py() for c in batch.columns)
            ids, labels = np.frombuffer(ids, "<i8"), np.frombuffer(labels, "<i8")
            yield (pa.array(ids, mask=np.frombuffer(no_id, bool)), pa.array(labels, mask=np.frombuffer(no_label, bool)),
                   Chunk.read(buffers, len(ids), parts, block))


def next_codebooks(stored_chunks: DataFrame, codebooks: np.ndarray, block: int) -> np.ndarray:
    """Each entry's floor(sum / count) over its pieces; unused entries stay."""
    parts, entries, width = codebooks.shape
    spark = stored_chunks.sparkSession
    sent = spark.sparkContext.broadcast(codebooks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums = np.zeros((parts, entries), dtype=np.int64), np.zeros((parts, entries, width), dtype=np.int64)
        for _, _, chunk in _each(batches, parts, block):
            for part in range(parts):
                _, _, n, total = chunk.assign(part, sent.value[part], block, errors=False)
                counts[part] += n
                sums[part] += total
        part, entry = np.nonzero(counts)
        columns = [part, entry, counts[part, entry], *sums[part, entry].T]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)

    names = ["part", "entry", "n", *[f"s{i}" for i in range(width)]]
    found = stored_chunks.mapInArrow(run, ", ".join(f"{c} long" for c in names)).groupBy("part", "entry").agg(
        *[F.sum(c).alias(c) for c in names[2:]]).toArrow()
    sent.destroy()
    part, entry, n, *sums = (found.column(c).to_numpy() for c in names)
    moved = codebooks.copy()
    if len(part):
        moved[part, entry] = np.stack(sums, axis=1) // n[:, None] if width else moved[part, entry]
    return moved


def coded(stored_chunks: DataFrame, codebooks: np.ndarray, block: int) -> DataFrame:
    """(vec_id, label, code, error) of every row."""
    sent = stored_chunks.sparkSession.sparkContext.broadcast(codebooks)
    parts = len(codebooks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, labels, chunk in _each(batches, parts, block):
            codes, error = np.empty((len(ids), parts), dtype=np.uint8), np.zeros(len(ids), dtype=np.int64)
            for part in range(parts):
                code, squared, _, _ = chunk.assign(part, sent.value[part], block, errors=True)
                codes[chunk.orders[part], part] = code
                error[chunk.orders[part]] += squared
            yield pa.RecordBatch.from_arrays(
                [ids, labels, pa.array([c.tobytes().hex() for c in codes]), pa.array(error)], names=["vec_id", "label", "code", "error"])

    return stored_chunks.mapInArrow(run, "vec_id long, label long, code string, error long")


def digest(codebooks: np.ndarray) -> str:
    """SHA-256 of all entries' components in decimal, by part, entry and position."""
    return hashlib.sha256(",".join(map(str, codebooks.ravel().tolist())).encode()).hexdigest()


def compress(
    vectors: DataFrame,
    scale: int = SCALE,
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    chunk: int = CHUNK,
    block: int = BLOCK,
) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, label, code, error) of every kept row of vectors (vec_id, label, embedding), and the codebooks.

    At most 256 entries, as an index takes two hex digits.
    """
    if not 0 < entries <= 256:
        raise ValueError("an index of two hex digits takes at most 256 entries")
    kept = vectors.where(usable()).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), integers("embedding", scale).alias("vector"))
    kept = kept.where(within(F.col("vector"), LARGEST))
    named = kept.where("vec_id IS NOT NULL")
    first = named.orderBy("vec_id", "vector").select(F.size("vector")).first() or kept.agg(F.max(F.size("vector"))).first()
    width = first[0] or 0
    kept = kept.where(F.size("vector") == width)
    start = named.where(F.size("vector") == width).orderBy("vec_id", "vector").limit(entries).select("vector").toArrow()
    # without ids there is nothing to start from but zeros
    begin = matrix(start.column(0).combine_chunks(), width) if start.num_rows else np.zeros((1, width), dtype=np.int64)
    codebooks = np.ascontiguousarray(split(begin, parts).transpose(1, 0, 2))
    rows = stored(chunks(kept, width, parts, block, chunk), "vector-chunks")
    for _ in range(rounds):
        codebooks = next_codebooks(rows, codebooks, block)
    return coded(rows, codebooks, block), codebooks
