"""Benchmark decontamination with a generalised suffix automaton over the words of test items.

The items are broadcast and made an automaton in each task; every document streams its words through it, carrying the
state and the length of the longest match that ends at each word. A match of `window` words, or of a
whole item that is shorter, marks its words. Runs of words whose neighbouring pairs do not occur in
any item cannot hold a match of two words or more and are skipped before the automaton.

A test set is cut into blocks of at most `block_words` words, so what is broadcast stays bounded: one
block at a time is fetched, and results of several blocks meet by the digest of the text. `decontaminate`
cuts a text only once all blocks have been searched, and then searches the cut texts in all blocks again,
so its result does not depend on where the blocks end; it takes as many rounds as cuts bring windows together.

Edge cases: NULL or wordless texts have no words and no hits, and pass unchanged; items that are NULL
or wordless match nothing; items without an id mark words but are not listed; repeated items count
once, repeated documents each get the same result. Extra columns are carried by `decontaminate` and
ignored by `contamination`.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructField, StructType

from tidemark.llm.common import free_name, stored
from tidemark.operators.ordered import running_total
from tidemark.llm.licenses import WORD_BYTES

WINDOW = 10
BLOCK_WORDS = 200_000
WORD = r"([^\x00-\x2F\x3A-\x60\x7B-\x7F]+)"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD_AT = re.compile(rb"[0-9a-z\x80-\xff]+")


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(WORD), 1)


class ItemAutomaton:
    """Suffix automaton of several word sequences, with the items of every window it knows."""

    def __init__(self, items: list[tuple[str | None, list[str]]], window: int = WINDOW):
        self.window = window
        self.vocab: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.names = [name for name, _ in items]
        coded = [[self.vocab.setdefault(w.encode(), len(self.vocab)) for w in ws] for _, ws in items]
        for seq in coded:
            last = 0
            for c in seq:
                last = self._extend(last, c)
        self.shortest = min((min(window, len(s)) for s in coded if s), default=window)
        self.pairs = {a * len(self.vocab) + b for s in coded for a, b in zip(s, s[1:], strict=False)}
        self._mark(coded)

    def _clone(self, p: int, q: int, c: int) -> int:
        new = len(self.next)
        self.next.append(dict(self.next[q]))
        self.length.append(self.length[p] + 1)
        self.link.append(self.link[q])
        self.link[q] = new
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = new
            p = self.link[p]
        return new

    def _extend(self, last: int, c: int) -> int:
        q = self.next[last].get(c)
        if q is not None:  # an earlier item has this prefix
            return q if self.length[q] == self.length[last] + 1 else self._clone(last, q, c)
        cur = len(self.next)
        self.next.append({})
        self.length.append(self.length[last] + 1)
        self.link.append(0)
        p = last
        while p >= 0 and c not in self.next[p]:
            self.next[p][c] = cur
            p = self.link[p]
        if p >= 0:
            q = self.next[p][c]
            self.link[cur] = q if self.length[q] == self.length[p] + 1 else self._clone(p, q, c)
        return cur

    def _mark(self, coded: list[list[int]]) -> None:
        """of_window: items by the state that stands for a whole window; short: items below the window by state."""
        self.of_window: dict[int, set[int]] = {}
        ends: dict[int, list[tuple[int, int]]] = {}
        for k, seq in enumerate(coded):
            state = 0
            for n, c in enumerate(seq, 1):
                state = self.next[state][c]
                if n >= self.window:
                    self.of_window.setdefault(self.window_state(state), set()).add(k)
            if 0 < len(seq) < self.window:
                ends.setdefault(state, []).append((len(seq), k))
        self.short: dict[int, list[tuple[int, int]]] = {}
        if ends:
            for v in sorted(range(1, len(self.next)), key=self.length.__getitem__):
                own = ends.get(v, []) + self.short.get(self.link[v], [])
                if own:
                    self.short[v] = own

    def window_state(self, v: int) -> int:
        """The suffix state of v that holds its last `window` words."""
        while self.length[self.link[v]] >= self.window:
            v = self.link[v]
        return v


class Matcher:
    """Finds the hit words of a text: sorted disjoint (start, end) word ranges, and the items."""

    def __init__(self, automaton: ItemAutomaton):
        import numpy as np

        self.a, self.np = automaton, np
        self.pairs = np.array(sorted(automaton.pairs), dtype=np.int64)

    def _runs(self, ids) -> Iterator[tuple[int, int]]:
        """Stretches of words that may hold a match."""
        np, a = self.np, self.a
        if a.shortest < 2:
            ok = ids >= 0
        else:
            both = (ids[:-1] >= 0) & (ids[1:] >= 0)
            code = ids[:-1] * len(a.vocab) + ids[1:]
            at = np.searchsorted(self.pairs, code)
            at[at == len(self.pairs)] = 0
            ok = both & (self.pairs[at] == code)
        edge = np.flatnonzero(np.diff(np.concatenate(([0], ok.view(np.int8), [0]))))
        extra = int(a.shortest >= 2)
        for s, e in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
            if e + extra - s >= a.shortest:
                yield s, e + extra

    def find(self, text: str) -> tuple[int, list[tuple[int, int]], set[int]]:
        tokens = text.encode("utf-8", "surrogatepass").translate(WORD_BYTES).split()
        spans: list[tuple[int, int]] = []
        states: set[int] = set()
        items: set[int] = set()
        a = self.a
        if len(tokens) < a.shortest or not a.vocab:
            return len(tokens), spans, items
        get = a.vocab.get
        ids = self.np.fromiter((get(t, -1) for t in tokens), dtype=self.np.int64, count=len(tokens))
        for start, end in self._runs(ids):
            state = size = 0
            for i, c in enumerate(ids[start:end].tolist(), start):
                while state and c not in a.next[state]:
                    state = a.link[state]
                    size = a.length[state]
                state_to = a.next[state].get(c)
                if state_to is None:
                    continue
                state, size = state_to, size + 1
                longest = 0
                if size >= a.window:
                    longest = a.window
                    states.add(a.window_state(state))
                for n, k in a.short.get(state, ()):
                    if n <= size:
                        items.add(k)
                        longest = max(longest, n)
                if longest:
                    first = i + 1 - longest
                    while spans and first <= spans[-1][1]:
                        first = min(first, spans.pop()[0])
                    spans.append((first, i + 1))
        for s in states:
            items |= a.of_window[s]
        return len(tokens), spans, items


def item_pieces(benchmark: DataFrame, window: int, block_words: int) -> tuple[DataFrame, int]:
    """(item, w, block), and the number of blocks. Longer items are cut into pieces that overlap by a window.

    Blocks follow the running number of words along the pieces' hashes. Pieces have at most half of block_words
    and blocks begin at every half, so none holds more than block_words.
    """
    half = max(window, block_words // 2)
    split = benchmark.select(F.col("item_id").cast("string").alias("item"), words(F.coalesce("text", F.lit(""))).alias("w"))
    pieces = split.where(F.size("w") > 0).select("item", F.explode(F.transform(
        F.sequence(F.lit(0), F.greatest(F.size("w") - window, F.lit(0)), F.lit(half - window + 1)),
        lambda i: F.slice("w", i + 1, half))).alias("w")).distinct()
    if (pieces.agg(F.sum(F.size("w"))).first()[0] or 0) <= block_words:
        return pieces.withColumn("block", F.lit(0)), 1
    placed = pieces.select("item", "w", F.size("w").cast("long").alias("words"), F.xxhash64("item", "w").alias("h"), F.lit(0).alias("all"))
    along = running_total(placed, ["all"], "h", ["item", "w"], {"upto": F.col("words")}, [1 << 56])
    numbered = stored(along.select("item", "w", F.expr(f"int((upto - words) div {half})").alias("block")), "items")
    return numbered, 1 + numbered.agg(F.max("block")).first()[0]


def item_blocks(pieces: DataFrame, n: int) -> Iterator[list[tuple[str | None, list[str]]]]:
    """Bounded parts of the test set, one at a time, as names and words."""
    for block in range(n):
        yield [(r["item"], r["w"]) for r in pieces.where(F.col("block") == block).collect()]


MATCH_SCHEMA = "n_words long, spans array<struct<start:long,end:long>>, items array<string>"
SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _matches(docs: DataFrame, key: str, text: str, block: list, window: int) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(block)  # at most block_words words

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(ItemAutomaton(shared.value, window))
        names = matcher.a.names
        for batch in batches:
            found = [matcher.find(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array([n for n, _, _ in found], pa.int64()),
                pa.array([[{"start": s, "end": e} for s, e in spans] for _, spans, _ in found], SPANS),
                pa.array([sorted({names[k] for k in items} - {None}) for _, _, items in found], pa.list_(pa.string())),
            ], names=[key, "n_words", "spans", "items"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, F.coalesce(text, F.lit("")).alias(text)).mapInArrow(run, f"{key} {kind}, {MATCH_SCHEMA}")


def _joined(spans: Column) -> Column:
    """Overlapping ranges of a sorted list made one."""
    def add(acc, x):
        last = F.element_at(acc, -1)
        apart = (F.size(acc) == 0) | (F.try_element_at(acc, F.lit(-1))["end"] < x["start"])
        merged = F.concat(F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))), F.array(F.struct(
            last["start"].alias("start"), F.greatest(last["end"], x["end"]).alias("end"))))
        return F.when(apart, F.concat(acc, F.array(x))).otherwise(merged)

    return F.aggregate(F.array_sort(spans), F.slice(spans, 1, 0), add)


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(doc_id, n_words, spans, items): hit word ranges and the items whose windows a document holds."""
    pieces, n = item_pieces(benchmark, window, max(block_words, 2 * window))
    if n == 1:
        return _matches(docs, "doc_id", "text", next(item_blocks(pieces, n)), window)
    keyed = docs.select(F.sha2(F.coalesce("text", F.lit("")), 256).alias("k"), "doc_id", "text")
    hits = None
    for block in item_blocks(pieces, n):  # written block by block, so that one is held at a time
        own = stored(_matches(keyed, "k", "text", block, window).where(F.size("spans") > 0).drop("n_words").distinct(), "hits")
        hits = own if hits is None else hits.union(own)
    hits = hits.groupBy("k").agg(F.flatten(F.collect_list("spans")).alias("spans"),
                                            F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    none = F.expr(f"cast(array() as {MATCH_SCHEMA.split('spans ')[1].split(', items')[0]})")
    return (keyed.select("k", "doc_id", F.size(words(F.coalesce("text", F.lit("")))).cast("long").alias("n_words"))
            .join(hits, "k", "left")
            .select("doc_id", "n_words", F.coalesce(_joined(F.col("spans")), none).alias("spans"),
                    F.coalesce("items", F.expr("cast(array() as array<string>)")).alias("items")))


def hit_words(spans: Column) -> Column:
    return F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, max_coverage: float = 0.8,
                  block_words: int = BLOCK_WORDS) -> DataFrame:
    """docs with hit words cut out of their texts; documents hit beyond max_coverage of their words go.

    A cut can bring words together that form a window anew, so a text is searched again until it is
    clean. n_chars, where present, follows the text. All other columns and clean texts stay as they are.
    """
    pieces, n = item_pieces(benchmark, window, max(block_words, 2 * window))
    if n == 1:
        kept = _cleaned(docs, next(item_blocks(pieces, n)), window, max_coverage)
    else:
        kept = _cleaned_by_all(docs, pieces, n, window, max_coverage)
    return kept.withColumn("n_chars", F.length("text").cast(kept.schema["n_chars"].dataType)) if "n_chars" in kept.columns else kept


def _without(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without these ranges of words."""
    raw = text.encode("utf-8", "surrogatepass")
    at = [m.span() for m in WORD_AT.finditer(raw.translate(WORD_BYTES))]
    for s, e in reversed(spans):
        raw = raw[:at[s][0]] + raw[at[e - 1][1]:]
    return raw.decode("utf-8", "surrogatepass")


def _cleaned(docs: DataFrame, block: list, window: int, max_coverage: float) -> DataFrame:
    """All rounds of a test set of one block, in one pass."""
    shared = docs.sparkSession.sparkContext.broadcast(block)
    result = free_name(docs, "cleaned")

    def clean(matcher: Matcher, text: str | None) -> tuple[str | None, bool]:
        total = hit = 0
        while text:
            n, spans, _ = matcher.find(text)
            if not spans:
                break
            total = total or n
            hit += sum(e - s for s, e in spans)
            if hit > max_coverage * total:
                return text, False
            text = _without(text, spans)
        return text, True

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(ItemAutomaton(shared.value, window))
        for batch in batches:
            at = batch.schema.get_field_index("text")
            done = [clean(matcher, t) for t in batch.column(at).to_pylist()]
            columns = list(batch.columns)
            columns[at] = pa.array([t for t, _ in done], pa.string())
            yield pa.RecordBatch.from_arrays([*columns, pa.array([ok for _, ok in done], pa.bool_())],
                                             names=[*batch.schema.names, result])

    schema = StructType([*docs.schema.fields, StructField(result, BooleanType())])
    return docs.mapInArrow(run, schema).where(F.col(result)).drop(result)


CUT = "k string, text string, total long, hit long, ok boolean"


def _cut(found: DataFrame, max_coverage: float) -> DataFrame:
    """One round of cuts: (k, text, total, hit, spans) to rows of CUT, total being the words of the text as it came."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, hits, ok = [], [], []
            for text, total, hit, ranges in zip(*(batch.column(i).to_pylist() for i in range(1, 5)), strict=True):
                spans: list[tuple[int, int]] = []
                for s, e in sorted((r["start"], r["end"]) for r in ranges):
                    if spans and s <= spans[-1][1]:
                        s, e = spans[-1][0], max(e, spans.pop()[1])
                    spans.append((s, e))
                hit += sum(e - s for s, e in spans)
                hits.append(hit)
                ok.append(hit <= max_coverage * total)
                texts.append(_without(text, spans) if ok[-1] else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(texts, pa.string()), batch.column(2), pa.array(hits, pa.int64()), pa.array(ok, pa.bool_())],
                names=["k", "text", "total", "hit", "ok"])

    return found.select("k", "text", "total", "hit", "spans").mapInArrow(run, CUT)


def _cleaned_by_all(docs: DataFrame, pieces: DataFrame, n: int, window: int, max_coverage: float) -> DataFrame:
    """The same for several blocks: in each round the hits of all blocks are cut at once, by the digest of the text as it came."""
    def hits(texts: DataFrame) -> DataFrame:
        found = None
        for block in item_blocks(pieces, n):  # written block by block, so that one is held at a time
            own = stored(_matches(texts, "k", "text", block, window).where(F.size("spans") > 0).select(
                "k", "n_words", "spans").distinct(), "hits")
            found = own if found is None else found.union(own)
        return stored(found.groupBy("k").agg(F.max("n_words").alias("n_words"), F.flatten(F.collect_list("spans")).alias("spans")), "hits")

    digest = F.sha2(F.coalesce("text", F.lit("")), 256)
    keyed = docs.select(digest.alias("k"), "text")
    found = hits(keyed)
    one = keyed.join(found, "k").groupBy("k").agg(*(F.first(c).alias(c) for c in ("text", "n_words", "spans")))
    cut = stored(_cut(one.select("k", "text", F.col("n_words").alias("total"), F.lit(0).cast("long").alias("hit"), "spans"), max_coverage), "cut")
    done = cut.where("not ok")
    cut = cut.where("ok")
    while not (found := hits(cut)).isEmpty():
        done = done.union(cut.join(found, "k", "left_anti"))
        again = stored(_cut(cut.join(found.drop("n_words"), "k"), max_coverage), "cut")
        done, cut = done.union(again.where("not ok")), again.where("ok")
    key, text, ok = (free_name(docs, c) for c in ("text_key", "cut_text", "cut_ok"))
    done = done.union(cut).select(F.col("k").alias(key), F.col("text").alias(text), F.col("ok").alias(ok))
    columns = [F.coalesce(text, "text").alias("text") if c == "text" else F.col(c) for c in docs.columns]
    return docs.withColumn(key, digest).join(done, key, "left").where(F.coalesce(ok, F.lit(True))).select(columns)
