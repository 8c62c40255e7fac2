"""Upserts of latest-state tables: each group of columns advances on its own clock.

The rule per group: take the incoming columns if the stored clock is NULL or
the incoming clock is strictly greater, else keep the stored ones; a key not
stored yet is inserted. The newest-row-wins table is the same rule with a
single group holding every column.

It is written in two ways. As an ordering of candidate rows it folds stored rows
and any number of pending batches in one aggregate. As a match of stored with
incoming rows it merges one row per key without shuffling a stored table that is
bucketed on the key, and without copying its columns into aggregation buffers.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.contracts import ColumnGroup
from tidemark.operators.latest import combine_one_pass

SEQUENCE = "_seq"
_STORED = -1


def _precedence(clock: str) -> Column:
    """Greater clock first; on equal clocks the earlier batch, on NULL clocks the later."""
    seq = F.col(SEQUENCE)
    return F.struct(F.col(clock), F.when(F.col(clock).isNull(), seq).otherwise(-seq))


def merge_latest(
    stored: DataFrame | None, incoming: DataFrame, key: str, groups: Sequence[ColumnGroup]
) -> DataFrame:
    """Stored state after applying incoming rows.

    incoming holds the stored table's columns, at most one row per key and batch,
    and optionally a `_seq` column numbering the batches from 0 when several are
    applied at once. Without a stored table the result is the first version of it.
    """
    outputs = [key, *[c for g in groups for c in g.outputs]]
    if SEQUENCE not in incoming.columns:
        incoming = incoming.withColumn(SEQUENCE, F.lit(0))
    rows = incoming.where(F.col(key).isNotNull()).select(*outputs, SEQUENCE)
    if stored is not None:
        rows = stored.select(*outputs, F.lit(_STORED).alias(SEQUENCE)).unionByName(rows)
    merged = rows.groupBy(key).agg(
        *[
            F.max_by(F.struct(*g.outputs), _precedence(g.clock)).alias(f"_g{i}")
            for i, g in enumerate(groups)
        ]
    )
    return merged.select(key, *[f"_g{i}.*" for i in range(len(groups))])


def fold_structs(
    structs: DataFrame, key: str, named_groups: Mapping[str, ColumnGroup]
) -> DataFrame:
    """One row per key from rows (key, a struct per group, `_seq`) of several batches."""
    seq = F.col(SEQUENCE)

    def rank(name: str, group: ColumnGroup) -> Column:
        clock = F.col(f"{name}.{group.clock}")  # NULL too where a batch has nothing for this group
        return F.struct(clock, F.when(clock.isNull(), seq).otherwise(-seq))

    return structs.where(F.col(key).isNotNull()).groupBy(key).agg(
        *[F.max_by(name, rank(name, g)).alias(name) for name, g in named_groups.items()]
    )


def merge_by_join(
    stored: DataFrame, incoming: DataFrame, key: str, groups: Sequence[ColumnGroup]
) -> DataFrame:
    """The same merge of at most one incoming row per key, as a match with the stored rows."""
    s = incoming.where(F.col(key).isNotNull()).withColumn("_in_s", F.lit(True)).alias("s")
    t = stored.withColumn("_in_t", F.lit(True)).alias("t")
    joined = t.join(s, F.col(f"t.{key}") == F.col(f"s.{key}"), "full")
    columns: list[Column] = [F.coalesce(f"t.{key}", f"s.{key}").alias(key)]
    for group in groups:
        advances = F.col(f"t.{group.clock}").isNull() | (
            F.col(f"s.{group.clock}") > F.col(f"t.{group.clock}")
        )
        take = F.col("_in_t").isNull() | (F.col("_in_s").isNotNull() & advances)
        columns += [
            F.when(take, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c) for c in group.outputs
        ]
    return joined.select(*columns)


def changed_rows(stored: DataFrame, incoming: DataFrame, key: str, groups: Sequence[ColumnGroup]) -> DataFrame:
    """The rows that the merge would change or add, whole; incoming holds one row per key.

    The stored rows stream past the incoming ones, hashed on the small side, without exchange or sort if they are
    bucketed on the key.
    """
    names = stored.columns
    whole = F.struct(*names)
    s = incoming.where(F.col(key).isNotNull()).select(F.col(key).alias("_key"), whole.alias("s"))
    t = stored.select(F.col(key).alias("_stored_key"), whole.alias("t"))
    met = t.join(s.hint("shuffle_hash"), F.col("_stored_key") == F.col("_key"), "right")
    is_new = F.col("t").isNull()

    def advances(g: ColumnGroup) -> Column:
        return F.col(f"t.{g.clock}").isNull() | (F.col(f"s.{g.clock}") > F.col(f"t.{g.clock}"))

    # a NULL clock over a NULL clock changes nothing but may carry other values, as in merge_by_join
    moves = reduce(lambda a, b: a | b, [F.coalesce(advances(g), F.lit(False)) for g in groups])
    columns = {key: F.col("_key")}
    for g in groups:
        take = is_new | F.coalesce(advances(g), F.lit(False))
        columns.update({c: F.when(take, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")) for c in g.outputs})
    return met.where(is_new | moves).select(*[columns[c].alias(c) for c in names])


def fold_batches(
    batches: Sequence[DataFrame], key: str, groups: Sequence[ColumnGroup], stored: DataFrame | None = None
) -> DataFrame:
    """Apply raw batches one after the other, the first one creating the table.

    Each batch is shuffled by its own aggregate and matched with the state. A full outer join promises no
    partitioning, so a state that is not stored is exchanged for each match; a bucketed table is not.
    """
    def apply(state: DataFrame | None, batch: DataFrame) -> DataFrame:
        incoming = combine_one_pass(batch, key, groups)
        return incoming if state is None else merge_by_join(state, incoming, key, groups)

    return reduce(apply, batches, stored)


def merge_pending(
    stored: DataFrame | None, batches: Sequence[DataFrame], key: str, groups: Sequence[ColumnGroup]
) -> DataFrame:
    """Apply several raw batches in one merge: what a slow cadence has to do to lose nothing."""
    incoming = reduce(
        DataFrame.unionByName,
        [
            combine_one_pass(batch, key, groups).withColumn(SEQUENCE, F.lit(i))
            for i, batch in enumerate(batches)
        ],
    )
    return merge_latest(stored, incoming, key, groups)


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def merge_sql(target: str, source: str, key: str, groups: Sequence[ColumnGroup]) -> str:
    """MERGE statement with the same rule, for catalogs whose tables support it.

    Rows of which no clock advances are left alone instead of rewritten unchanged.
    """
    k = _quoted(key)

    def advances(group: ColumnGroup) -> str:
        c = _quoted(group.clock)
        return f"(t.{c} IS NULL OR s.{c} > t.{c})"

    assignments = [
        f"{_quoted(c)} = CASE WHEN {advances(g)} THEN s.{_quoted(c)} ELSE t.{_quoted(c)} END"
        for g in groups
        for c in g.outputs
    ]
    changed = " OR ".join(advances(g) for g in groups)
    return (
        f"MERGE INTO {target} AS t USING {source} AS s ON t.{k} = s.{k}\n"
        f"WHEN MATCHED AND ({changed}) THEN UPDATE SET\n  " + ",\n  ".join(assignments) + "\n"
        "WHEN NOT MATCHED THEN INSERT *"
    )
