"""Removal of byte strings that repeat anywhere, by a logarithmic family of sparse suffix arrays.

A string of `length` bytes counts as repeated if it also starts elsewhere, in the same text or another.
The suffixes that are indexed begin at anchors: in every window of `length` bytes the part of ANCHOR bytes
with the least hash, so equal windows have equal anchors at equal places. A level of the index holds, by
bucket, its suffixes in the order of their first ANCHOR bytes. Texts arrive in batches. A batch's suffixes
are sorted by content and merge-scanned with all existing levels, which are in order already: neighbours
that share all ANCHOR bytes are long matches. Levels of equal size are merged into one by the same scan, as
a binary counter carries, so n batches leave at most log2(n) + 1 levels. Only texts with such matches are
looked at again: the windows around those anchors are brought together and compared by 64-bit hashes of all
their bytes, which settles each byte exactly (but for hash collisions between windows that share an anchor).

Skew: equal texts are indexed once, and their number alone tells that they repeat whole. The windows of
an anchor that occurs more than HOT times are dealt by their own hash, each sent once per task, so no
task gathers what many texts share. Of such an anchor a level keeps HOT + 1 places, since all texts that
hold it are flagged by then; one batch's places of it meet in one bucket.

Edge cases: a NULL text is empty; texts shorter than `length` have no windows and stay whole; NULL ids
pass through and repeated rows repeat each other. A cut may split a character: kept bytes are compared
and hashed as bytes, and `strip` drops the broken pieces of such characters. Extra columns are carried
by `strip` and ignored elsewhere.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.llm.common import free_name, stored

LENGTH = 200
BATCHES = 3
ANCHOR = 64
HOT = 5000
BUCKET_ROWS = 300_000
BUCKET_BYTES = 6_000_000
SEGMENT = 1 << 18


class Rolling:
    """64-bit hashes of all substrings of a byte array with a given length."""

    def __init__(self) -> None:
        self.of_byte = np.random.default_rng(20240602).integers(0, 1 << 64, 256, dtype=np.uint64)
        self.base = 0x9E3779B97F4A7C15
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def sums(self, raw: np.ndarray) -> np.ndarray:
        n = len(raw)
        if len(self.up) <= n:
            size = max(n + 1, 1 << 16)
            self.up, self.down = (np.concatenate(([np.uint64(1)], np.cumprod(np.full(size, b, np.uint64))))
                                  for b in (np.uint64(self.base), np.uint64(pow(self.base, -1, 1 << 64))))
        sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(self.of_byte[raw] * self.up[:n], out=sums[1:])
        return sums

    def at(self, sums: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
        return self._mixed((sums[starts + length] - sums[starts]) * self.down[starts])

    def every(self, sums: np.ndarray, length: int) -> np.ndarray:
        return self._mixed((sums[length:] - sums[:-length]) * self.down[:len(sums) - length])

    @staticmethod
    def _mixed(h: np.ndarray) -> np.ndarray:
        h = (h ^ h >> np.uint64(31)) * np.uint64(0xBF58476D1CE4E5B9)
        return h ^ h >> np.uint64(29)


def _least(h: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every `width` neighbours, from running minima of blocks in both directions."""
    rows = np.concatenate((h, np.full(-len(h) % width, np.uint64(2**64 - 1)))).reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    back = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    n = len(h) - width + 1
    return np.minimum(back[:n], ahead[width - 1:width - 1 + n])


def anchors(rolling: Rolling, raw: bytes, length: int, anchor: int) -> tuple[np.ndarray, ...]:
    """(hash, first, last, twice, place): each anchor hash with the range of window starts it stands for, whether
    it lies at several places there, as in texts with a short period, and the first of its places."""
    out = [(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64))]
    place = np.uint64((1 << 22) - 1)  # a segment's positions, put below the leading bits of the hash
    for base in range(0, max(0, len(raw) - length + 1), SEGMENT):
        part = np.frombuffer(raw, np.uint8)[base:base + SEGMENT + length - 1]
        h = rolling.every(rolling.sums(part), anchor)
        at = _least(h & ~place | np.arange(len(h), dtype=np.uint64), length - anchor + 1) & place
        least = h[at]
        first = np.flatnonzero(np.concatenate(([True], least[1:] != least[:-1])))
        last = np.concatenate((first[1:], [len(least)])) - 1
        out.append((least[first], first + base, last + base, at[first] != at[last], at[first].astype(np.int64) + base))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _packed(*arrays) -> list[pa.Array]:
    return [pa.array([a.tobytes()], pa.binary()) for a in arrays]


def _by_bucket(n_buckets: int, bucket: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    order = np.argsort(bucket, kind="stable")
    cuts = np.searchsorted(bucket[order], np.arange(n_buckets + 1))
    for b in range(n_buckets):
        if cuts[b] < cuts[b + 1]:
            yield b, order[cuts[b]:cuts[b + 1]]


def _codes(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct 16-byte keys (as pairs of integers), and the number of each row's key among them."""
    order = np.lexsort((keys[:, 1], keys[:, 0]))
    new = np.ones(len(keys), bool)
    new[1:] = (np.diff(keys[order], axis=0) != 0).any(axis=1)
    code = np.empty(len(keys), np.int64)
    code[order] = np.cumsum(new) - 1
    return keys[order[new]], code


def prepared(docs: DataFrame) -> DataFrame:
    """(doc_id, text, key) with the digest of the text, by which equal texts are one."""
    text = F.coalesce("text", F.lit(""))
    return docs.select("doc_id", text.alias("text"), F.unhex(F.md5(text)).alias("key"))


class SuffixIndex:
    """Levels of suffixes, each a table of arrays by bucket in the order of the suffixes' contents."""

    FIELDS = "kind string, bucket int, suffix binary, owner binary, keys binary"

    def __init__(self, n_buckets: int, length: int = LENGTH, anchor: int = ANCHOR, hot: int = HOT):
        self.n_buckets, self.length, self.anchor, self.hot = n_buckets, length, anchor, hot
        self.levels: dict[int, DataFrame] = {}

    def add(self, texts: DataFrame, last: bool = False) -> DataFrame:
        """Index the rows (key, text) and return (key, token, hot) of anchors that they repeat or
        that repeat among them, for old texts and new. After the last batch no level is written."""
        level = 0
        while level in self.levels:
            level += 1
        merged = {str(i) for i in range(level)}
        rows = self._arrays(texts)
        for i, held in self.levels.items():
            rows = rows.union(held.withColumn("kind", F.lit(str(i))))
        anchor, hot, keep = self.anchor, self.hot, not last

        def scan(table: pa.Table) -> pa.Table:
            return _merge_scan(table, merged, anchor, hot, keep)

        done = stored(rows.groupBy("bucket").applyInArrow(scan, self.FIELDS), "suffixes")
        for i in range(level):
            del self.levels[i]
        if keep:
            self.levels[level] = done.where("kind = 'level'")
        return done.where("kind = 'flag'").select(
            F.col("keys").alias("key"), F.col("suffix").alias("token"), F.col("owner").alias("hot"))

    def _arrays(self, texts: DataFrame) -> DataFrame:
        n_buckets, length, anchor = self.n_buckets, self.length, self.anchor

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            rolling = Rolling()
            for batch in batches:
                token, suffix, owner, keys, seen = [], [], [], [], set()
                for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    if key not in seen:
                        seen.add(key)
                        raw = text.encode("utf-8", "surrogatepass")
                        h, _, _, twice, place = anchors(rolling, raw, length, anchor)
                        h, place = np.concatenate((h, h[twice])), np.concatenate((place, place[twice]))
                        if len(h):
                            token.append(h)
                            suffix.append(sliding_window_view(np.frombuffer(raw, np.uint8), anchor)[place])
                            owner.append(np.full(len(h), len(keys), np.int32))
                            keys.append(key)
                if not keys:
                    continue
                t, c, who = np.concatenate(token), np.concatenate(suffix), np.concatenate(owner)
                k = np.frombuffer(b"".join(keys), np.uint64).reshape(-1, 2)
                for b, at in _by_bucket(n_buckets, (t >> np.uint64(17)) % np.uint64(n_buckets)):
                    here, local = np.unique(who[at], return_inverse=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(["new"]), pa.array([b], pa.int32()), *_packed(c[at], local.astype(np.int32), k[here])],
                        names=["kind", "bucket", "suffix", "owner", "keys"])

        return texts.select("key", "text").mapInArrow(run, self.FIELDS)


def _merged_order(suffix: np.ndarray, runs: list[np.ndarray]) -> np.ndarray:
    """Row numbers by content, from runs of row numbers that are each in that order."""
    order = runs[0]
    for run in runs[1:]:
        at = np.searchsorted(suffix[run], suffix[order], side="right") + np.arange(len(order))
        both = np.empty(len(order) + len(run), np.int64)
        from_run = np.ones(len(both), bool)
        from_run[at] = False
        both[at], both[from_run] = order, run
        order = both
    return order


def _hashes(suffix: np.ndarray, anchor: int) -> np.ndarray:
    """The anchor hashes of suffixes."""
    rolling, out = Rolling(), [np.zeros(0, np.uint64)]
    for i in range(0, len(suffix), 5000):
        raw = np.frombuffer(suffix[i:i + 5000].tobytes(), np.uint8)
        out.append(rolling.at(rolling.sums(raw), np.arange(0, len(raw), anchor), anchor))
    return np.concatenate(out)


def _merge_scan(table: pa.Table, merged: set[str], anchor: int, hot: int, keep: bool) -> pa.Table:
    """One bucket: the new suffixes sorted, merged with the levels, and neighbours compared."""
    kinds = table.column("kind").to_pylist()
    bucket = table.column("bucket")[0].as_py()
    suffixes, keys, owners = ([np.frombuffer(b, kind) for b in table.column(c).to_pylist()] for c, kind in (
        ("suffix", f"S{anchor}"), ("keys", np.uint64), ("owner", np.int32)))
    shift = np.cumsum([0] + [len(k) // 2 for k in keys])
    distinct, code = _codes(np.concatenate(keys).reshape(-1, 2))
    source = np.repeat(np.arange(len(kinds)), np.diff(shift))
    chosen = np.full(len(distinct), len(kinds))
    np.minimum.at(chosen, code, source)  # a text that several tasks have seen counts once
    taken = chosen[code] == source
    row = np.concatenate([o + s for o, s in zip(owners, shift[:-1], strict=True)])
    once = taken[row]
    suffix, who, piece = np.concatenate(suffixes)[once], code[row[once]], source[row[once]]
    del suffixes
    is_new = np.array([k == "new" for k in kinds])
    kind_of = np.where(is_new, -1, np.arange(len(kinds)))[piece]  # a level is one piece of a bucket
    fresh = np.flatnonzero(kind_of < 0)
    order = _merged_order(suffix, [fresh[np.argsort(suffix[fresh], kind="stable")],
                                   *(np.flatnonzero(kind_of == i) for i in np.flatnonzero(~is_new).tolist())])
    suffix, who, piece = suffix[order], who[order], piece[order]
    starts = np.flatnonzero(np.concatenate(([True], suffix[1:] != suffix[:-1]))) if len(suffix) else np.zeros(0, np.int64)
    count = np.diff(np.concatenate((starts, [len(suffix)])))
    hit = (count > 1) & (np.add.reduceat(is_new[piece].astype(np.int64), starts) > 0 if len(starts) else np.zeros(0, bool))
    flagged = np.repeat(hit, count)
    t, w = np.repeat(_hashes(suffix[starts[hit]], anchor), count[hit]), who[flagged]
    many = np.repeat(count[hit] > hot, count[hit])
    order = np.argsort(w, kind="stable")
    t, w, many = t[order], w[order], many[order]
    cuts = np.flatnonzero(np.concatenate((np.diff(w, prepend=-1) != 0, [True])))
    spans = list(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True))
    out = {"kind": ["flag"] * len(spans), "suffix": [t[a:b].tobytes() for a, b in spans],
           "owner": [many[a:b].tobytes() for a, b in spans], "keys": [distinct[w[a]].tobytes() for a, _ in spans]}
    if keep:
        carried = np.array([k == "new" or k in merged for k in kinds])[piece]
        so_far = np.cumsum(carried)
        before = (so_far - carried)[starts] if len(starts) else so_far
        carried &= so_far - np.repeat(before, count) <= hot + 1  # beyond that all texts that hold it are flagged as hot
        here, local = np.unique(who[carried], return_inverse=True)
        for name, value in (("kind", "level"), ("suffix", suffix[carried].tobytes()),
                            ("owner", local.astype(np.int32).tobytes()), ("keys", distinct[here].tobytes())):
            out[name].append(value)
    n = len(out["kind"])
    return pa.table({"kind": pa.array(out["kind"], pa.string()), "bucket": pa.array([bucket] * n, pa.int32()),
                     **{c: pa.array(out[c], pa.binary()) for c in ("suffix", "owner", "keys")}})


WINDOWS = "bucket int, kind int, token binary, owner binary, keys binary, start binary, size binary, content binary"


def _windows(texts: DataFrame, n_buckets: int, length: int, anchor: int) -> DataFrame:
    """The windows of flagged anchors: contents by anchor, or hashes of single windows for hot ones.

    kind 0: token = anchor, content from start on. kind 1: token = window hash. kind 2: settled here."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rolling = Rolling()
        names = [c.split()[0] for c in WINDOWS.split(", ")]

        def rows(kind, token, owner, start, size, contents, keys) -> Iterator[pa.RecordBatch]:
            for b, at in _by_bucket(n_buckets, (token >> np.uint64(17)) % np.uint64(n_buckets)):
                here, local = np.unique(owner[at], return_inverse=True)
                content = b"".join([contents[i] for i in at.tolist()]) if contents else b""
                yield pa.RecordBatch.from_arrays(
                    [pa.array([b], pa.int32()), pa.array([kind], pa.int32()),
                     *_packed(token[at], local.astype(np.int32), keys[here], start[at], size[at]),
                     pa.array([content], pa.binary())], names=names)

        for whole in batches:
            for i in range(0, whole.num_rows, 1000):
                batch = whole.slice(i, 1000)
                keys = np.frombuffer(b"".join(batch.column(0).to_pylist()), np.uint64).reshape(-1, 2)
                cold, hot, contents = [], [], []
                for who, (text, token, many) in enumerate(zip(*(batch.column(c).to_pylist() for c in (1, 2, 3)), strict=True)):
                    raw = text.encode("utf-8", "surrogatepass")
                    flags = np.frombuffer(b"".join(token), np.uint64)
                    often = flags[np.frombuffer(b"".join(many), bool)]
                    h, first, last, _, _ = anchors(rolling, raw, length, anchor)
                    flagged = np.isin(h, flags)
                    h, first, last = h[flagged], first[flagged], last[flagged]
                    is_hot = np.isin(h, often)
                    for a, b in zip(first[is_hot].tolist(), last[is_hot].tolist(), strict=True):
                        part = np.frombuffer(raw, np.uint8)[a:b + length]
                        hashes = rolling.every(rolling.sums(part), length)
                        hot.append((hashes, np.full(len(hashes), who), np.arange(a, b + 1)))
                    h, first, last = h[~is_hot], first[~is_hot], last[~is_hot]
                    cold.append((h, np.full(len(h), who), first, last + length - first))
                    contents += [raw[a:b + length] for a, b in zip(first.tolist(), last.tolist(), strict=True)]
                token, owner, start, size = (np.concatenate(x) for x in zip(*cold, strict=True))
                yield from rows(0, token, owner.astype(np.int32), start, size, contents, keys)
                if hot:
                    token, owner, start = (np.concatenate(x) for x in zip(*hot, strict=True))
                    _, at, group, count = np.unique(token, return_index=True, return_inverse=True, return_counts=True)
                    again = count[group] > 1
                    fixed = np.full(len(token), length)
                    for kind, pick in ((2, np.flatnonzero(again)), (1, at)):
                        yield from rows(kind, token[pick], owner[pick].astype(np.int32), start[pick], fixed[pick], None, keys)

    return texts.select("key", "text", "token", "hot").mapInArrow(run, WINDOWS)


def _settled(table: pa.Table) -> pa.Table:
    """One bucket: (key, spans) with the byte ranges of windows that occur twice."""
    length = table.column("length")[0].as_py()
    rolling = Rolling()
    kinds = np.array(table.column("kind").to_pylist())
    read = lambda c, kind: [np.frombuffer(b, kind) for b in table.column(c).to_pylist()]
    token, owner, keys, start, size = read("token", np.uint64), read("owner", np.int32), read("keys", np.uint64), read("start", np.int64), read("size", np.int64)
    shift = np.cumsum([0] + [len(k) // 2 for k in keys])
    distinct, code = _codes(np.concatenate(keys).reshape(-1, 2))
    hashes, who, at = [], [], []
    done = [(np.zeros(0, np.int64),) * 3]
    for i, content in enumerate(table.column("content")):
        own = code[owner[i] + shift[i]]
        if kinds[i] == 2:
            done.append((own, start[i], start[i] + length))
        elif kinds[i] == 1:
            hashes.append(token[i])
            who.append(own)
            at.append(start[i])
        else:
            raw, edge = np.frombuffer(content.as_py(), np.uint8), np.concatenate(([0], np.cumsum(size[i])))
            for a in range(0, len(own), 5000):  # keeps the sums of a large piece small
                b = min(a + 5000, len(own))
                n = size[i][a:b] - length + 1
                inner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                sums = rolling.sums(raw[edge[a]:edge[b]])
                hashes.append(rolling.at(sums, np.repeat(edge[a:b] - edge[a], n) + inner, length))
                who.append(np.repeat(own[a:b], n))
                at.append(np.repeat(start[i][a:b], n) + inner)
    if hashes:
        h, w, s = np.concatenate(hashes), np.concatenate(who), np.concatenate(at)
        order = np.lexsort((s, w, h))
        h, w, s = h[order], w[order], s[order]
        fresh = np.ones(len(h), bool)  # a text that came twice is one place
        fresh[1:] = (h[1:] != h[:-1]) | (w[1:] != w[:-1]) | (s[1:] != s[:-1])
        h, w, s = h[fresh], w[fresh], s[fresh]
        same = h[1:] == h[:-1]
        twice = np.concatenate((same, [False])) | np.concatenate(([False], same))
        done.append((w[twice], s[twice], s[twice] + length))
    w, a, b = (np.concatenate(x) for x in zip(*done, strict=True))
    w, a, b = _union(w, a, b)
    cuts = np.flatnonzero(np.concatenate((np.diff(w, prepend=-1) != 0, [True])))
    both = np.stack((a, b), axis=1)
    spans = list(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True))
    return pa.table({"key": pa.array([distinct[w[x]].tobytes() for x, _ in spans], pa.binary()),
                     "spans": pa.array([both[x:y].tobytes() for x, y in spans], pa.binary())})


def _union(who: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Overlapping or touching ranges of each owner made one; sorted by owner and start."""
    if not len(who):
        return who, start, end
    order = np.lexsort((end, start, who))
    who, start, end = who[order], start[order], end[order]
    owner_of = np.cumsum(np.diff(who, prepend=who[0]) != 0)
    far = int(end.max()) + 1
    reach = np.maximum.accumulate(end + owner_of * far)
    new = np.ones(len(who), bool)
    new[1:] = start[1:] + owner_of[1:] * far > reach[:-1]
    new[1:] |= who[1:] != who[:-1]
    first = np.flatnonzero(new)
    return who[first], start[first], (reach[np.concatenate((first[1:], [len(who)])) - 1] - owner_of[first] * far)


def repeated_spans(docs: DataFrame, length: int = LENGTH, batches: int = BATCHES, anchor: int = ANCHOR,
                   hot: int = HOT) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(facts, texts, spans): facts (doc_id, key, n_bytes, sha, copies) of every document, texts (key, text)
    that may hold repeats, and their packed ranges (key, list of spans). A text with copies, if it is long
    enough, repeats whole."""
    rows = prepared(docs)
    facts = stored(rows.select("doc_id", "key", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("sha")), "facts")
    by_key = facts.groupBy("key").agg(F.count(F.lit(1)).alias("copies"), F.min(F.struct(
        F.col("doc_id").isNull().alias("z"), "doc_id")).alias("x"))
    size = facts.agg(F.sum("n_bytes")).first()[0] or 0
    n_buckets = max(12, -(-size // (length - anchor) * 2 // BUCKET_ROWS))
    index = SuffixIndex(n_buckets, length, anchor, hot)
    flags = None
    for i in range(batches):
        share = rows.where(F.octet_length("text") >= length).where(F.pmod(F.crc32("key"), F.lit(batches)) == i)
        own = index.add(share, last=i == batches - 1)
        flags = own if flags is None else flags.union(own)
    wanted = flags.groupBy("key").agg(F.collect_list("token").alias("token"), F.collect_list("hot").alias("hot")).join(
        by_key, "key").select(F.col("key").alias("k"), "token", "hot", "copies", F.col("x.doc_id").alias("id"))
    texts = stored(rows.join(wanted, (rows["key"] == wanted["k"]) & rows["doc_id"].eqNullSafe(wanted["id"])).select(
        "key", "text", "token", "hot", "copies"), "texts")
    flagged = texts.agg(F.sum(F.aggregate("token", F.lit(0).cast("long"), lambda n, t: n + F.octet_length(t)))).first()[0] or 0
    around = flagged // 8 * 2 * length  # bytes that will be brought together, roughly
    spans = _windows(texts, max(12, -(-around // BUCKET_BYTES)), length, anchor).withColumn("length", F.lit(length)).groupBy("bucket").applyInArrow(
        _settled, "key binary, spans binary")
    spans = stored(spans.groupBy("key").agg(F.collect_list("spans").alias("spans")), "spans")
    return facts.join(by_key.select("key", "copies"), "key"), texts, spans


def ranges_of(blobs: list[bytes]) -> list[tuple[int, int]]:
    both = np.frombuffer(b"".join(blobs), np.int64).reshape(-1, 2)
    _, a, b = _union(np.zeros(len(both), np.int64), both[:, 0], both[:, 1])
    return list(zip(a.tolist(), b.tolist(), strict=True))


def without(raw: bytes, ranges: list[tuple[int, int]]) -> bytes:
    at, kept = 0, []
    for a, b in ranges:
        kept.append(raw[at:a])
        at = b
    return b"".join([*kept, raw[at:]])


def removals(docs: DataFrame, length: int = LENGTH, batches: int = BATCHES) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every document."""
    facts, texts, spans = repeated_spans(docs, length, batches)

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            removed, count, sha = [], [], []
            for text, blobs in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                ranges = ranges_of(blobs)
                removed.append(sum(b - a for a, b in ranges))
                count.append(len(ranges))
                sha.append(hashlib.sha256(without(text.encode("utf-8", "surrogatepass"), ranges)).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(removed, pa.int64()), pa.array(count, pa.int64()), pa.array(sha)],
                                             names=["key", "n_removed", "n_spans", "kept"])

    cut = texts.where("copies = 1").select("key", "text").join(spans, "key").mapInArrow(
        run, "key binary, n_removed long, n_spans long, kept string")
    whole = (F.col("copies") > 1) & (F.col("n_bytes") >= length)
    none = F.lit(0).cast("long")
    return facts.join(cut, "key", "left").select(
        "doc_id", "n_bytes", F.when(whole, F.col("n_bytes")).otherwise(F.coalesce("n_removed", none)).alias("n_removed"),
        F.when(whole, none + 1).otherwise(F.coalesce("n_spans", none)).alias("n_spans"),
        F.when(whole, F.lit(hashlib.sha256(b"").hexdigest())).otherwise(F.coalesce("kept", "sha")).alias("kept_sha256"))


def strip(docs: DataFrame, length: int = LENGTH, batches: int = BATCHES) -> DataFrame:
    """docs without the repeated bytes of their texts; n_chars, where present, follows the text."""
    facts, _, spans = repeated_spans(docs, length, batches)
    copied = facts.where((F.col("copies") > 1) & (F.col("n_bytes") >= length)).select("key").distinct().select(
        "key", F.lit(True).alias("whole"))
    due = spans.join(copied, "key", "full").select(F.col("key").alias(k := free_name(docs, "text_key")),
                                                   F.struct("spans", F.coalesce("whole", F.lit(False)).alias("whole")).alias(c := free_name(docs, "cut")))
    text: Column = F.coalesce("text", F.lit(""))
    names = docs.columns
    joined = docs.withColumn(k, F.unhex(F.md5(text))).join(due, k, "left").drop(k)

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            at = batch.schema.get_field_index("text")
            texts = batch.column(at).to_pylist()
            for i, cut in enumerate(batch.column(batch.num_columns - 1).to_pylist()):
                if cut:
                    texts[i] = "" if cut["whole"] else without(
                        texts[i].encode("utf-8", "surrogatepass"), ranges_of(cut["spans"])).decode("utf-8", "ignore")
            columns = list(batch.columns[:-1])
            columns[at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=names)

    done = joined.mapInArrow(run, StructType(docs.schema.fields))
    return done.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else done
