"""Comparing a table with a copy by digests: only ranges of keys whose digests differ are read again.

A digest of a range says how many rows it holds and sums hashes of whole rows, so the order of rows does not
matter and a map task sends one row for each range it has seen. Ranges that differ are cut again, down to
ranges of a few keys: a tree of which only the differing branches are visited. In what is left, keys with
their rows' digests are compared; whole rows are read for keys that differ, and for no others.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.parity import column_diff

FAN_OUT = 1024
MAX_RANGES = 128
RANGE_KEYS = 64
_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def row_digests(columns: Sequence[str]) -> list[Column]:
    """Number of rows and two sums of hashes over them, which a table's digest is made of.

    The exclusive or alone would not see two equal rows; the sum of 31 bits cannot overflow below 2^32 rows a
    range. A hash passes over NULLs, so which columns are NULL is hashed as well.
    """
    parts = [*[F.col(c) for c in columns], *[F.col(c).isNull() for c in columns]]
    low_bits = F.xxhash64(F.lit("sum"), *parts).bitwiseAND(F.lit(0x7FFFFFFF))
    return [F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64(*parts)).alias("x"), F.sum(low_bits).alias("s")]


@dataclass
class Narrowed:
    """What the digests left: ranges (first, last) of the place of keys, and whether NULL keys differ."""

    ranges: list[tuple[int, int]]
    null_keys: bool
    levels: list[tuple[int, int]] = field(default_factory=list)  # ranges compared, ranges that differed

    def of(self, rows: DataFrame, place: Column) -> DataFrame:
        """The rows in those ranges; on a whole-number key the bounds reach the scan."""
        wanted = F.lit(False)
        for first, last in self.ranges:
            wanted = wanted | place.between(first, last)
        return rows.where(wanted | place.isNull() if self.null_keys else wanted)


def key_place(df: DataFrame, keys: Sequence[str]) -> Column:
    """A whole number for each key: the key itself where it is one column of whole numbers, else its hash."""
    if len(keys) == 1 and isinstance(df.schema[keys[0]].dataType, _WHOLE):
        return F.col(keys[0]).cast("long")
    return F.xxhash64(*keys)


def merge_ranges(ranges: Sequence[tuple[int, int]], most: int) -> list[tuple[int, int]]:
    """Adjacent ranges joined, then those with the smallest gaps between them, until there are at most so many."""
    joined: list[tuple[int, int]] = []
    for first, last in sorted(ranges):
        if joined and first <= joined[-1][1] + 1:
            joined[-1] = (joined[-1][0], max(last, joined[-1][1]))
        else:
            joined.append((first, last))
    gaps = sorted(range(1, len(joined)), key=lambda i: joined[i][0] - joined[i - 1][1])[:max(0, len(joined) - most)]
    out: list[tuple[int, int]] = []
    for i, (first, last) in enumerate(joined):
        if i in set(gaps):
            out[-1] = (out[-1][0], last)
        else:
            out.append((first, last))
    return out


def _differing(left: DataFrame, right: DataFrame, by: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Values of by whose digests differ, each side aggregated before it meets the other."""
    def side(df: DataFrame, sign: int) -> DataFrame:
        return df.groupBy(*by).agg(*row_digests(columns)).select(
            *by, F.lit(sign).alias("_side"), "n", "x", "s")

    both = side(left, 1).unionByName(side(right, -1))
    compared = both.groupBy(*by).agg(
        F.sum(F.col("_side") * F.col("n")).alias("dn"), F.bit_xor("x").alias("dx"), F.sum(F.col("_side") * F.col("s")).alias("ds"))
    return compared.withColumn("differs", (F.col("dn") != 0) | (F.col("dx") != 0) | (F.col("ds") != 0))


def narrow(
    left: DataFrame, right: DataFrame, keys: Sequence[str], fan_out: int = FAN_OUT, max_ranges: int = MAX_RANGES, range_keys: int = RANGE_KEYS
) -> Narrowed:
    """Ranges of keys outside which both tables hold the same rows.

    Each level reads the columns of what still differs and brings at most fan_out + 1 digests to the driver. It
    stops at ranges of range_keys keys, or when half of what it compared differs and cutting further would not pay.
    """
    columns = left.columns
    place = key_place(left, keys)
    sides = [left, right.select(*columns)]
    ends = [df.agg(F.min(place), F.max(place), F.count_if(place.isNull())).first() for df in sides]
    known = [e for e in ends if e[0] is not None]
    found = Narrowed([(min(e[0] for e in known), max(e[1] for e in known))] if known else [], any(e[2] for e in ends))
    while found.ranges:
        size = sum(last - first + 1 for first, last in found.ranges)
        width = max(1, -(-size // fan_out))
        # numbers of a level run through its ranges one after the other
        number, cuts = F.lit(None).cast("long"), []
        for first, last in found.ranges:
            start = len(cuts)
            cuts += [(at, min(at + width - 1, last)) for at in range(first, last + 1, width)]
            number = F.when(place.between(first, last), _offset(place, first, width) + start).otherwise(number)
        parts = [found.of(df, place).withColumn("_range", number) for df in sides]
        rows = _differing(*parts, ["_range"], columns).where("differs").select("_range").collect()
        numbers = {r[0] for r in rows}
        found.null_keys = None in numbers
        apart = [cuts[n] for n in numbers if n is not None]
        found.levels.append((len(cuts), len(apart)))
        found.ranges = merge_ranges(apart, max_ranges)
        if width <= range_keys or 2 * len(apart) > len(cuts):
            break
    return found


def _offset(place: Column, first: int, width: int) -> Column:
    """Number of the range of this width, counted from first; the distance of two longs may need more than a long."""
    whole = "decimal(38,0)"
    distance, each = place.cast(whole) - F.lit(first).cast(whole), F.lit(width).cast(whole)
    return ((distance - distance % each) / each).cast("long")  # the remainder goes first, so no quotient is rounded


def keys_apart(left: DataFrame, right: DataFrame, keys: Sequence[str], found: Narrowed) -> DataFrame:
    """The keys inside the ranges whose rows differ between the tables. What is shuffled is keys and digests."""
    place = key_place(left, keys)
    parts = [found.of(df, place) for df in (left, right.select(*left.columns))]
    return _differing(*parts, list(keys), left.columns).where("differs").select(*keys)


def digest_diff(left: DataFrame, right: DataFrame, keys: Sequence[str], **options) -> DataFrame:
    """The same counts as column_diff, from the rows of differing keys only.

    Keys repeated on a side are counted where the rows of the key differ between the tables.
    """
    found = narrow(left, right, keys, **options)
    if not found.ranges and not found.null_keys:
        return column_diff(left.where(F.lit(False)), right.select(*left.columns).where(F.lit(False)), keys)
    place = key_place(left, keys)
    apart = keys_apart(left, right, keys, found).select(*[F.col(k).alias(f"_k_{k}") for k in keys])

    def rows(df: DataFrame) -> DataFrame:
        same = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys]
        return found.of(df.select(*left.columns), place).join(apart, same, "left_semi")

    return column_diff(rows(left), rows(right), keys)
