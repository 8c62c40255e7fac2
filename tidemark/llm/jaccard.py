"""Exact n-gram Jaccard join with a token-group matrix.

1. A first pass counts which shingles are frequent; the `frequent` most frequent ones go last in the
   common order of shingles. The list is bounded and only steers cost: any order gives all links.
2. Two sets that link share a shingle among the first fifth (plus one) of each in that order. Documents
   form groups: each joins the most popular of a few of its leading shingles, so that a cluster of similar
   documents meets in a few groups. The matrix holds, for each of those leading shingles, the
   groups it occurs in. How many leading shingles of a query a group's union holds bounds what the query
   can share with any member; the group is a candidate if that reaches what a link needs. Of two groups
   the one that comes first, by size where that is large, asks the other. A shingle of more than `hot`
   documents is taken out of the buckets: its documents are dealt into shares, each of which meets
   one row per group, the least and the greatest size there, so no task holds all of them.
3. Each group is brought together with its queries. Its whole token union bounds the overlap again;
   only groups that reach it are opened and compared set by set. Inside a group
   links are searched from document to document until no set is left, so a cluster costs one pass.
   Groups above `group_size` are dealt into parts that share one pivot document; what the pivot does not
   connect becomes a query against all other parts in a second round.
4. Links become components.

Sets are 64-bit hashes of the shingles' bytes; equal sets are compared once. `links` therefore holds one
link per connected pair of component parts rather than every pair, and no link between components is
missing.

Edge cases: NULL, empty and blank texts have the empty set, link with nothing and form components of
their own. Texts of fewer than `width` words are one shingle. NULL ids take part, and a component is
named by its smallest id that is not NULL. Repeated rows repeat their result. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import free_name, stored
from tidemark.llm.components import components

WIDTH = 5
FREQUENT = 200_000
GROUP_SIZE = 1000
HOT = 50_000
CHOICES, POPULAR, POPULAR_KEYS = 6, 3, 100_000
QUERY_BLOCK = 4000
BUCKET_ROWS = 2_500_000
SEGMENT_WORDS = 200_000
# ASCII upper case to lower, every separator to a space
FOLD = bytes(b + 32 if 65 <= b <= 90 else 32 if 9 <= b <= 13 else b for b in range(256))


class Shingler:
    """Sorted distinct 64-bit hashes of the word n-grams of a text."""

    def __init__(self, width: int = WIDTH):
        self.width = width
        self.of_byte = np.random.default_rng(20240601).integers(0, 1 << 64, 256, dtype=np.uint64)
        self.base = np.uint64(0x9E3779B97F4A7C15)
        self.inverse = np.uint64(pow(int(self.base), -1, 1 << 64))
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def _powers(self, n: int) -> None:
        if len(self.up) < n:
            size = max(n, 1 << 16)
            self.up, self.down = (np.concatenate(([np.uint64(1)], np.cumprod(np.full(size - 1, b, np.uint64))))
                                  for b in (self.base, self.inverse))

    def _hashes(self, words: list[bytes]) -> np.ndarray:
        joined = np.frombuffer(b" ".join(words), dtype=np.uint8)
        n = len(joined)
        self._powers(n + 1)
        spaces = np.flatnonzero(joined == 32)
        starts, ends = np.concatenate(([0], spaces + 1)), np.concatenate((spaces, [n]))
        k = min(self.width, len(words)) - 1
        starts, ends = starts[:len(starts) - k], ends[k:]
        sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(self.of_byte[joined] * self.up[:n], out=sums[1:])
        h = (sums[ends] - sums[starts]) * self.down[starts]
        h ^= h >> np.uint64(31)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        return h ^ h >> np.uint64(29)

    def shingles(self, text: str | None) -> np.ndarray:
        words = (text or "").encode("utf-8", "surrogatepass").translate(FOLD).split()
        if not words:
            return np.zeros(0, dtype=np.uint64)
        parts = [self._hashes(words[i:i + SEGMENT_WORDS + self.width - 1])
                 for i in range(0, max(1, len(words) - self.width + 1), SEGMENT_WORDS)]
        return np.unique(parts[0] if len(parts) == 1 else np.concatenate(parts))


def set_key(shingles: np.ndarray) -> bytes | None:
    return hashlib.md5(shingles.tobytes(), usedforsecurity=False).digest() if len(shingles) else None


def leading(shingles: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """The first fifth plus one of a set, in the order (frequent or not, hash)."""
    n = len(shingles) // 5 + 1
    if len(frequent):
        at = np.searchsorted(frequent, shingles)
        at[at == len(frequent)] = 0
        often = frequent[at] == shingles
        shingles = np.concatenate((shingles[~often], shingles[often]))
    return shingles[:n]


def group_choices(lead: np.ndarray, frequent: np.ndarray) -> list[int]:
    """The leading shingles that may name a set's group: the first ones, and the first frequent ones.

    Frequent shingles lead only in sets that consist of them for more than four fifths, such as the
    copies of one popular text, whose rare shingles are their own edits. Where a frequent passage is a
    smaller part of a text it never leads, so it brings no strangers together.
    """
    names = lead[:CHOICES]
    if len(frequent):
        at = np.searchsorted(frequent, lead)
        at[at == len(frequent)] = 0
        names = np.concatenate((names, lead[frequent[at] == lead][:CHOICES]))
    return list(dict.fromkeys(names.view(np.int64).tolist()))


def _texts(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return docs.select("doc_id", F.xxhash64(text).alias("h"), text.alias("text"))


def first_pass(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """Rows of documents (doc_id, h, n, key), h a hash of the text, and rows (token, count) of shingles repeated within a task's share."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(width)
        held: list[np.ndarray] = []

        def repeated() -> tuple[np.ndarray, np.ndarray]:
            values, counts = np.unique(np.concatenate(held), return_counts=True)
            held.clear()
            return values[counts > 1], counts[counts > 1]

        def rows(ids, h, n, key, token, count) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [ids, h, pa.array(n, pa.int64()), pa.array(key, pa.binary()), pa.array(token, pa.int64()), pa.array(count, pa.int64())],
                names=["doc_id", "h", "n", "key", "token", "count"])

        kind = None
        for batch in batches:
            kind = batch.schema.field(0).type
            n, keys = [], []
            for text in batch.column(2).to_pylist():
                s = shingler.shingles(text)
                n.append(len(s))
                keys.append(set_key(s))
                held.append(s)
            none = [None] * len(n)
            yield rows(batch.column(0), batch.column(1), n, keys, none, none)
            if sum(map(len, held)) > 4_000_000:
                token, count = repeated()
                none = [None] * len(token)
                yield rows(pa.nulls(len(token), kind), pa.nulls(len(token), pa.int64()), none, none, token.view(np.int64), count)
        if held:
            token, count = repeated()
            none = [None] * len(token)
            yield rows(pa.nulls(len(token), kind), pa.nulls(len(token), pa.int64()), none, none, token.view(np.int64), count)

    return _texts(docs).mapInArrow(run, f"doc_id {id_type}, h long, n long, key binary, token long, count long")


def _leads(docs: DataFrame, frequent, width: int) -> DataFrame:
    """(key, n, lead): the very first shingles of every set, of which one will name its group."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, often = Shingler(width), np.asarray(frequent.value, dtype=np.uint64)
        for batch in batches:
            sets = [s for t in batch.column(0).to_pylist() if len(s := shingler.shingles(t))]
            yield pa.RecordBatch.from_arrays(
                [pa.array([set_key(s) for s in sets], pa.binary()), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([group_choices(leading(s, often), often) for s in sets], pa.list_(pa.int64()))], names=["key", "n", "lead"])

    return docs.select(F.coalesce("text", F.lit("")).alias("text")).mapInArrow(
        run, "key binary, n long, lead array<long>").dropDuplicates(["key"])


def group_of(lead: list[int], popular: dict[int, int]) -> int:
    """The shingle with most documents; the list of popular ones is bounded, the rest count as none."""
    return max(lead, key=lambda t: (popular.get(t, 0), -lead.index(t)))


def _members(leads: DataFrame, popular) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = dict(popular.value)
        for batch in batches:
            groups = [group_of(lead, known) for lead in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(groups, pa.int64())], names=["key", "grp"])

    return leads.select("key", "lead").mapInArrow(run, "key binary, grp long")


def _among(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    """Which values are in an ascending array."""
    if not len(ordered):
        return np.zeros(len(values), bool)
    return ordered[np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)] == values


def _hot_rows(docs: DataFrame, frequent, popular, hot, width: int) -> DataFrame:
    """(token, share, shares, key, grp, n, weight): the sets led by hot shingles, dealt into shares.

    hot holds the hot shingles in order and the number of shares of each.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, often = Shingler(width), np.asarray(frequent.value, dtype=np.uint64)
        known, (tokens, shares) = dict(popular.value), hot.value
        for batch in batches:
            rows = []
            for text in batch.column(0).to_pylist():
                s = shingler.shingles(text)
                lead = leading(s, often)
                led = lead[_among(lead, tokens)]
                if len(led):
                    key, grp = set_key(s), group_of(group_choices(lead, often), known)
                    place = int.from_bytes(key[:7], "little")
                    of = shares[np.searchsorted(tokens, led)].tolist()
                    rows += [(t, place % k, k, key, grp, len(s), known.get(grp, 0))
                             for t, k in zip(led.view(np.int64).tolist(), of, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(
                (pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.int64(), pa.int64(), pa.int64()))],
                names=["token", "share", "shares", "key", "grp", "n", "weight"])

    return docs.select(F.coalesce("text", F.lit("")).alias("text")).mapInArrow(
        run, "token long, share int, shares int, key binary, grp long, n long, weight long").dropDuplicates(["token", "key"])


def _hot_matrix(rows: DataFrame) -> DataFrame:
    """(key, grp, shared, need) as _matrix_rows gives them, of hot shingles.

    A group is known by its least and greatest size, so what a link needs is at most what it is by all sizes.
    """
    groups = rows.groupBy("token", "grp").agg(
        F.min("n").alias("lo"), F.max("n").alias("hi"), F.max("weight").alias("heavy"), F.max("shares").alias("shares")).select(
            "token", "grp", "lo", "hi", "heavy", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)).alias("share"))
    met = rows.select("token", "share", "key", F.col("grp").alias("own"), "n", "weight").join(groups, ["token", "share"]).where(
        "heavy > weight or heavy = weight and grp > own").select(
            "key", "grp", "n", F.expr("greatest(lo, (4 * n + 4) div 5)").alias("lo"), F.expr("least(hi, 5 * n div 4)").alias("hi")).where("lo <= hi")
    needs = [f"(4 * (n + {y}) + 8) div 9 - greatest(n - n div 5 - 1, {y} - {y} div 5 - 1)"
             for y in ("lo", *(f"greatest(lo, hi - {back})" for back in range(5)))]
    return met.select("key", "grp", F.lit(1).cast("long").alias("shared"), F.least(*map(F.expr, needs)).alias("need"))


def _buckets(docs: DataFrame, frequent, popular, hot, n_buckets: int, width: int) -> DataFrame:
    """Leading shingles of all documents but the hot ones, as packed arrays by bucket of the shingle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, often = Shingler(width), np.asarray(frequent.value, dtype=np.uint64)
        apart = hot.value[0]
        known = dict(popular.value)
        for batch in batches:
            tokens, owner, keys, facts, seen = [], [], [], [], set()
            for text in batch.column(0).to_pylist():
                s = shingler.shingles(text)
                key = set_key(s)
                if key is not None and key not in seen:
                    seen.add(key)
                    lead = leading(s, often)
                    led = lead[~_among(lead, apart)]
                    tokens.append(led)
                    owner.append(np.full(len(led), len(keys), dtype=np.int32))
                    keys.append(key)
                    grp = group_of(group_choices(lead, often), known)
                    facts.append((grp, len(s), known.get(grp, 0)))
            if not keys:
                continue
            token, who = np.concatenate(tokens), np.concatenate(owner)
            bucket = (token >> np.uint64(17)) % np.uint64(n_buckets)
            order = np.argsort(bucket, kind="stable")
            token, who, bucket = token[order], who[order], bucket[order]
            key, fact = np.frombuffer(b"".join(keys), np.uint64).reshape(-1, 2), np.array(facts, np.int64)
            cuts = np.searchsorted(bucket, np.arange(n_buckets + 1))
            for b in range(n_buckets):
                t, w = token[cuts[b]:cuts[b + 1]], who[cuts[b]:cuts[b + 1]]
                if len(t):
                    here, local = np.unique(w, return_inverse=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([b], pa.int32()), *(pa.array([x.tobytes()], pa.binary()) for x in (
                            t, local.astype(np.int32), key[here], fact[here]))],
                        names=["bucket", "token", "owner", "key", "fact"])

    return docs.select(F.coalesce("text", F.lit("")).alias("text")).mapInArrow(
        run, "bucket int, token binary, owner binary, key binary, fact binary")


def _matrix_rows(table: pa.Table) -> pa.Table:
    """One bucket of the matrix: for each query and group, how many of the query's leading shingles here
    the group holds, and the least number over all buckets with which a link is possible."""
    blobs = {c: table.column(c).to_pylist() for c in ("token", "owner", "key", "fact")}
    shift = np.cumsum([0] + [len(b) // 16 for b in blobs["key"]])
    token = np.concatenate([np.frombuffer(b, np.uint64) for b in blobs["token"]])
    owner = np.concatenate([np.frombuffer(b, np.int32) + s for b, s in zip(blobs["owner"], shift[:-1], strict=True)])
    halves = np.frombuffer(b"".join(blobs["key"]), np.uint64).reshape(-1, 2)
    order = np.lexsort((halves[:, 1], halves[:, 0]))
    new = np.concatenate(([True], (np.diff(halves[order], axis=0) != 0).any(axis=1)))
    code = np.empty(len(halves), np.int64)
    code[order] = np.cumsum(new) - 1
    keys = halves[order[new]]
    fact = np.frombuffer(b"".join(blobs["fact"]), np.int64).reshape(-1, 3)[order[new]]
    names, group = np.unique(fact[:, 0], return_inverse=True)
    weight = np.zeros(len(names), np.int64)
    weight[group] = fact[:, 2]
    by_rank = np.lexsort((names, weight))
    rank_of = np.empty(len(names), np.int64)
    rank_of[by_rank] = np.arange(len(names))
    size, rank = fact[:, 1], rank_of[group]
    who = code[owner]
    order = np.lexsort((size[who], rank[who], token))
    token, who = token[order], who[order]
    order = np.lexsort((who, token))
    fresh = np.ones(len(token), bool)
    fresh[order[1:]] = (token[order][1:] != token[order][:-1]) | (who[order][1:] != who[order][:-1])
    token, who = token[fresh], who[fresh]  # copies of one set, seen by several tasks, count once
    starts = np.flatnonzero(np.concatenate(([True], token[1:] != token[:-1])))
    lengths = np.diff(np.concatenate((starts, [len(token)])))
    two = starts[lengths == 2]
    q, y = who[two], who[two + 1]
    pick = (rank[q] != rank[y]) & (5 * np.minimum(size[q], size[y]) >= 4 * np.maximum(size[q], size[y]))
    found = [(q[pick], rank[y[pick]], needed(size[q[pick]], size[y[pick]]))]
    for s, m in zip(starts[lengths > 2].tolist(), lengths[lengths > 2].tolist(), strict=True):
        docs = who[s:s + m]
        sizes, ranks = size[docs], rank[docs]
        cuts = np.flatnonzero(np.concatenate((np.diff(ranks, prepend=-1) != 0, [True])))
        for a, b in zip(cuts[1:-1].tolist(), cuts[2:].tolist(), strict=True):
            lo = np.searchsorted(sizes[a:b], -(-4 * sizes[:a] // 5))
            hi = np.searchsorted(sizes[a:b], 5 * sizes[:a] // 4, side="right") - 1
            near = np.flatnonzero(lo <= hi)
            if len(near):
                need = least_needed(sizes[:a][near], sizes[a:b][lo[near]], sizes[a:b][hi[near]])
                found.append((docs[:a][near], np.full(len(near), ranks[a]), need))
    q, g, need = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.lexsort((g, q))
    q, g, need = q[order], g[order], need[order]
    at = np.flatnonzero(np.concatenate(([True], (q[1:] != q[:-1]) | (g[1:] != g[:-1])))) if len(q) else np.zeros(0, np.int64)
    return pa.table({
        "key": pa.array([keys[i].tobytes() for i in q[at].tolist()], pa.binary()),
        "grp": pa.array(names[by_rank[g[at]]], pa.int64()),
        "shared": pa.array(np.diff(np.concatenate((at, [len(q)]))), pa.int64()),
        "need": pa.array(np.minimum.reduceat(need, at) if len(at) else need, pa.int64())})


def needed(x, y):
    """Leading shingles that two linked sets of these sizes have in common at least.

    Beyond the leading ones of the set whose last leading shingle comes first, no more than the rest of
    that set can be shared; leading() takes n // 5 + 1 of n.
    """
    return -(-4 * (x + y) // 9) - np.maximum(x - x // 5 - 1, y - y // 5 - 1)


def least_needed(x, lo, hi):
    """The least of needed(x, y) for lo <= y <= hi.

    Up to x it grows with y. Beyond, five more in y make it less by one at least, with dips between since
    both terms are rounded; so the least is at lo or among the last five sizes.
    """
    least = needed(x, lo)
    for back in range(5):
        least = np.minimum(least, needed(x, np.maximum(lo, hi - back)))
    return least


def linked(inter, a, b):
    """100 * intersection >= 80 * union."""
    return 9 * inter >= 4 * (a + b)


def _compare(table: pa.Table) -> pa.Table:
    """One part of a group: links among members, and of queries to members that pass the bound."""
    rows: dict[bytes, tuple[int, np.ndarray]] = {}
    for key, role, blob in zip(*(table.column(c).to_pylist() for c in ("key", "role", "tokens")), strict=True):
        if key not in rows or rows[key][0] > role:
            rows[key] = (role, np.frombuffer(blob, np.uint64))
    members = [(k, s) for k, (role, s) in rows.items() if role < 2]
    links: list[tuple[bytes, bytes]] = []
    if members:
        keys, sets = [k for k, _ in members], [s for _, s in members]
        size = np.array([len(s) for s in sets])
        token = np.concatenate(sets)
        whose = np.repeat(np.arange(len(sets)), size)
        union = np.unique(token)

        def overlaps(s: np.ndarray, token: np.ndarray, whose: np.ndarray) -> np.ndarray:
            at = np.searchsorted(s, token)
            at[at == len(s)] = 0
            return np.bincount(whose[s[at] == token], minlength=len(sets))

        root = np.full(len(sets), -1)
        search = any(table.column("search").to_pylist())
        left_token, left_whose = token, whose
        for p in range(len(sets) if search else 0):
            if root[p] >= 0:
                continue
            root[p], todo = p, [p]
            while todo:
                f = todo.pop()
                waiting = root[left_whose] < 0
                if not waiting.any():
                    break
                left_token, left_whose = left_token[waiting], left_whose[waiting]
                inter = overlaps(sets[f], left_token, left_whose)
                new = np.flatnonzero((root < 0) & (inter > 0) & linked(inter, size, size[f]))
                root[new] = p
                todo += new.tolist()
                links += [(keys[f], keys[i]) for i in new.tolist()]
        # members known to be connected are one; a query needs one link to each of what it connects
        part = np.where(root >= 0, root, np.arange(len(sets)))
        for key, (role, s) in rows.items():
            if role < 2:
                continue
            at = np.searchsorted(union, s)
            at[at == len(union)] = 0
            if 5 * int((union[at] == s).sum()) < 4 * len(s):
                continue  # no member can share four fifths of the query
            inter = overlaps(s, token, whose)
            near = np.flatnonzero((inter > 0) & linked(inter, size, len(s)))
            parts, at = np.unique(part[near], return_index=True)
            links += [(key, keys[near[i]]) for i in at.tolist()]
            if len(parts) > 1:
                part[np.isin(part, parts)] = parts[0]
    return pa.table({"a": pa.array([x for x, _ in links], pa.binary()), "b": pa.array([y for _, y in links], pa.binary())})


PLACE = "grp long, part int, block int, role int, search boolean"


def _sets(docs: DataFrame, first: DataFrame, places: DataFrame, width: int) -> DataFrame:
    """The sets of one document per key, at all places (key, grp, part, block, role, search) it is due at."""
    due = places.groupBy("key").agg(F.collect_list(F.struct("grp", "part", "block", "role", "search")).alias("at"))
    one = first.where("key is not null").groupBy("key").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("z"), "doc_id", "h")).alias("x"))
    wanted = one.join(due, "key").select("key", "at", F.col("x.doc_id").alias("id"), F.col("x.h").alias("hash"))
    texts = _texts(docs)
    found = texts.join(wanted, (texts["h"] == wanted["hash"]) & texts["doc_id"].eqNullSafe(wanted["id"])).select("key", "text", "at")
    names = [c.split()[0] for c in PLACE.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(width)
        for whole in batches:
            for i in range(0, whole.num_rows, 500):  # sets are repeated for each place: keep the output small
                batch = whole.slice(i, 500)
                at = batch.column(2)
                row = at.value_parent_indices() if hasattr(at, "value_parent_indices") else pa.compute.list_parent_indices(at)
                flat = at.flatten()
                blobs = pa.array([shingler.shingles(t).tobytes() for t in batch.column(1).to_pylist()], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [*flat.flatten(), batch.column(0).take(row), blobs.take(row)], names=[*names, "key", "tokens"])

    return found.mapInArrow(run, f"{PLACE}, key binary, tokens binary")


def _links(docs: DataFrame, first: DataFrame, places: DataFrame, width: int) -> DataFrame:
    return stored(_sets(docs, first, places, width).groupBy("grp", "part", "block").applyInArrow(
        _compare, "a binary, b binary").distinct(), "links")


def _spread(of: str, n: str):
    return F.pmod(F.xxhash64(of), F.col(n)).cast("int")


def _each(n: str):
    return F.explode(F.sequence(F.lit(0), F.col(n).cast("int") - 1))


def similarity_links(docs: DataFrame, first: DataFrame, width: int = WIDTH, frequent: int = FREQUENT,
                     group_size: int = GROUP_SIZE, hot: int = HOT) -> DataFrame:
    """Links (a, b) between keys of different sets, at least one across any two parts of a component."""
    spark = docs.sparkSession
    often = first.where("token is not null").groupBy("token").agg(F.sum("count").alias("c")).orderBy(
        F.desc("c"), "token").limit(frequent).toArrow()
    token, times = (often.column(c).to_numpy().astype(np.int64) for c in ("token", "c"))
    order = np.argsort(token.view(np.uint64))
    token, times = token.view(np.uint64)[order], times[order]
    shared = spark.sparkContext.broadcast(token)
    apart = spark.sparkContext.broadcast((token[times > hot], -(-times[times > hot] // hot)))
    total = first.agg(F.sum("n")).first()[0] or 0
    leads = stored(_leads(docs, shared, width), "leads")
    counts = leads.select(F.explode("lead").alias("t")).groupBy("t").count().where(F.col("count") >= POPULAR).orderBy(
        F.desc("count"), "t").limit(POPULAR_KEYS).toArrow()
    popular = spark.sparkContext.broadcast(list(zip(counts.column("t").to_pylist(), counts.column("count").to_pylist(), strict=True)))
    members = stored(_members(leads, popular), "members")
    matrix = _buckets(docs, shared, popular, apart, max(12, -(-total // 5 // BUCKET_ROWS)), width).groupBy("bucket").applyInArrow(
        _matrix_rows, "key binary, grp long, shared long, need long")
    if len(apart.value[0]):
        matrix = matrix.union(_hot_matrix(stored(_hot_rows(docs, shared, popular, apart, width), "hot")))
    asks = stored(matrix.groupBy("key", "grp").agg(F.sum("shared").alias("shared"), F.min("need").alias("need")).where(
        "shared >= need").select("key", "grp"), "asks")
    active = stored(members.groupBy("grp").agg(F.count(F.lit(1)).alias("m"), F.min("key").alias("pivot")).join(
        asks.groupBy("grp").agg(F.count(F.lit(1)).alias("q")), "grp", "left").where("m > 1 or q > 0").select(
            "grp", "pivot", F.ceil(F.col("m") / group_size).cast("int").alias("parts"),
            F.greatest(F.lit(1), F.ceil(F.coalesce("q", F.lit(0)) / QUERY_BLOCK)).cast("int").alias("blocks")), "groups")
    role = lambda r: F.lit(r).alias("role")
    none = F.lit(0).alias("block")
    small, large = active.where("parts = 1"), active.where("parts > 1")
    in_small = members.join(small, "grp").select("key", "grp", F.lit(0).alias("part"), _each("blocks").alias("block")).select(
        "*", role(0), (F.col("block") == 0).alias("search"))
    queries = asks.join(small, "grp").select(
        "key", "grp", F.lit(0).alias("part"), _spread("key", "blocks").alias("block"), role(2), F.lit(False).alias("search"))
    in_large = members.join(large, "grp").select("key", "grp", _spread("key", "parts").alias("part"), none, role(0), F.lit(True).alias("search"))
    pivots = large.select(F.col("pivot").alias("key"), "grp", _each("parts").alias("part"), none, role(1), F.lit(True).alias("search"))
    links = _links(docs, first, in_small.union(queries).union(in_large).union(pivots), width)
    if large.isEmpty():
        return links
    roots = components(links)
    root = F.coalesce("root", "key")
    of_large = members.join(large, "grp").join(roots, F.col("key") == F.col("node"), "left").select("key", "grp", "parts", root.alias("root"))
    by_root = of_large.groupBy("grp", "root").count()
    main = by_root.groupBy("grp").agg(F.max_by("root", F.struct("count", "root")).alias("main"), F.count(F.lit(1)).alias("roots"))
    outside = of_large.join(main, "grp").where("root <> main").select("key", "grp")
    foreign = asks.join(large, "grp").join(roots, F.col("key") == F.col("node"), "left").select("key", "grp", root.alias("root")).join(
        main, "grp").where("roots > 1 or root <> main").select("key", "grp")
    second = outside.union(foreign).distinct()
    open_groups = stored(second.groupBy("grp").agg(F.ceil(F.count(F.lit(1)) / QUERY_BLOCK).cast("int").alias("blocks")).join(
        large.select("grp", "parts"), "grp"), "open")
    still = second.join(open_groups, "grp").select("key", "grp", _each("parts").alias("part"), _spread("key", "blocks").alias("block"),
                                                   role(2), F.lit(False).alias("search"))
    against = members.join(open_groups, "grp").select("key", "grp", _spread("key", "parts").alias("part"), _each("blocks").alias("block"),
                                                      role(0), F.lit(False).alias("search"))
    # a document that asks its own group is a member of one part there and a query in the others
    return links.union(_links(docs, first, against.union(still), width))


def _found(docs: DataFrame, width: int, frequent: int, group_size: int, hot: int = HOT) -> DataFrame:
    """(doc_id, h, n_shingles, component_id, least_h) of every document; least_h is the least h of the component's smallest id."""
    first = stored(first_pass(docs, width), "shingles")
    roots = components(similarity_links(docs, first, width, frequent, group_size, hot))
    rows = first.where("token is null")
    keys = rows.where("key is not null").groupBy("key").agg(F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "h"))).alias("least")).join(
        roots, F.col("key") == F.col("node"), "left").select("key", "least", F.coalesce("root", "key").alias("root"))
    named = keys.join(keys.groupBy("root").agg(F.min("least").alias("of_root")), "root").select(
        "key", F.col("of_root.doc_id").alias("component_id"), F.col("of_root.h").alias("least_h"))
    return rows.join(named, "key", "left").select(
        "doc_id", "h", F.col("n").alias("n_shingles"), F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(
            F.col("component_id")).alias("component_id"), "least_h")


def near_duplicates(docs: DataFrame, width: int = WIDTH, frequent: int = FREQUENT, group_size: int = GROUP_SIZE,
                    hot: int = HOT) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every document."""
    return _found(docs, width, frequent, group_size, hot).select("doc_id", "n_shingles", "component_id")


def one_of_each(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """docs with the document of the smallest id of every component, and all that link with nothing.

    Rows are told apart by id and text, so an id that several texts share goes only with those that link. Of
    rows that repeat both id and text, or of one component that repeat its smallest id, one text stays; rows
    without an id always stay.
    """
    found = stored(_found(docs, width, FREQUENT, GROUP_SIZE), "components")
    gone = stored(found.where("doc_id <> component_id or h <> least_h").where("doc_id is not null").select("doc_id", "h").distinct(), "gone")
    if not found.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").isEmpty():
        named, unnamed = docs.where("doc_id is not null"), docs.where("doc_id is null")
        docs = named.dropDuplicates(["doc_id", "text"]).union(unnamed)
    h = free_name(docs, "text_hash")
    gone = gone.withColumnRenamed("h", h)
    return docs.withColumn(h, F.xxhash64(F.coalesce("text", F.lit("")))).join(gone, ["doc_id", h], "left_anti").select(docs.columns)
