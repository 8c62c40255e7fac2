"""Token counts with a whole-token shortcut.

Offline, every vocabulary string is encoded alone; those that come back as one token are proven
single. When counting, a text is cut into pre-tokens; proven ones count 1 without any merging, and
only the rest are merged, once per distinct string and cache. Special strings inside a text follow
the library's default (one id each); a text that holds one goes to the library whole. Around characters
outside well-settled blocks, whose class could differ between Unicode versions, the stretch between the
nearest safe cuts goes to the library, so results are always its own. A cut is safe before a single
space between two settled characters that are no spaces: a pre-token ends and another starts there, whatever is beyond.

Edge cases: a NULL text counts as empty (0 bytes, 0 tokens); NULL ids pass through; repeated rows
repeat their result. Any other columns of the input are ignored.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: the published pre-token pattern of this family of byte-level vocabularies.
PRE_TOKEN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# Code points whose class no Unicode version disputes.
SETTLED = [*range(0x09, 0x0E), *range(0x20, 0x7F), *range(0xA1, 0x250), *range(0x3B1, 0x3CA),
           *range(0x400, 0x460), *range(0x2010, 0x2028)]


def _ranges(points: Iterable[int]) -> str:
    """The inside of a bracket expression for ascending code points."""
    runs: list[list[int]] = []
    for p in points:
        if runs and p == runs[-1][1] + 1:
            runs[-1][1] = p
        else:
            runs.append([p, p])
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in runs)


_LETTERS = _ranges(p for p in SETTLED if unicodedata.category(chr(p))[0] == "L")
_NUMBERS = _ranges(p for p in SETTLED if unicodedata.category(chr(p))[0] == "N")
UNSETTLED = re.compile(f"[^{_ranges(SETTLED)}]")
_SOLID = _ranges(p for p in SETTLED if not chr(p).isspace())
SAFE = re.compile(f"(?<=[{_SOLID}]) (?=[{_SOLID}])")
# The pattern spelled out for settled text, where the standard module is twice as fast.
SETTLED_CUT = re.compile(PRE_TOKEN.replace(r"[^\s\p{L}\p{N}]", f"[^\\s{_LETTERS}{_NUMBERS}]")
                         .replace(r"\p{L}", f"[{_LETTERS}]").replace(r"\p{N}", f"[{_NUMBERS}]")).findall
CACHE_ENTRIES = 400_000


def load(path: str):
    """The tokenizer of a file, single-threaded: Spark runs one task per core."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def proven_single(tokenizer) -> frozenset[str]:
    """Vocabulary strings that encode alone as exactly one token, by running every one of them."""
    import regex

    pattern = regex.compile(PRE_TOKEN)
    ids = sorted(tokenizer.get_vocab().values())
    texts = [t for t in tokenizer.decode_batch([[i] for i in ids], skip_special_tokens=False)
             if t and "�" not in t and pattern.fullmatch(t)]
    coded = tokenizer.encode_batch(texts, add_special_tokens=False)
    return frozenset(t for t, e in zip(texts, coded, strict=True) if len(e.ids) == 1)


class Merger:
    """Ids of strings by the library of the file; settled text may go through a faster public
    implementation of the same merges, when the file's merge order is the order of its ids."""

    def __init__(self, path: str):
        self.library = load(path)
        self.special = re.compile("|".join(
            re.escape(t.content) for t in self.library.get_added_tokens_decoder().values()) or r"(?!)")
        ranks = _ranks(path)
        self.fast = None
        if ranks:
            import tiktoken

            self.fast = tiktoken.Encoding("merges", pat_str=PRE_TOKEN, mergeable_ranks=ranks, special_tokens={})

    def plain(self, text: str) -> bool:
        """Whether text may be cut and merged in parts."""
        return not (UNSETTLED.search(text) or self.special.search(text))

    def whole(self, text: str) -> list[int]:
        return self.library.encode(text, add_special_tokens=False).ids

    def packed(self, text: str) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit integers."""
        import numpy as np

        if self.fast and self.plain(text):
            return self.fast.encode_to_numpy(text, disallowed_special=()).astype("<u4").tobytes()
        return np.asarray(self.whole(text), dtype="<u4").tobytes()

    def parts(self, texts: list[str]) -> list[list[int]]:
        if self.fast:
            return list(map(self.fast.encode_ordinary, texts))
        return [e.ids for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]


def _ranks(path: str) -> dict[bytes, int] | None:
    """Byte strings and their merge ranks, or None if ids are not in the order of merging."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, vocab = spec["model"], spec["model"]["vocab"]
    pre = spec.get("pre_tokenizer") or {}
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]  # bytes that stand for themselves
    other = [b for b in range(256) if b not in plain]
    byte_of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}
    merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    made = [vocab.get(a + b, -1) for a, b in merges]
    settled = (model["type"] == "BPE" and not spec.get("normalizer") and pre.get("type") == "ByteLevel"
               and not pre.get("add_prefix_space") and pre.get("use_regex", True)
               and made == sorted(made) and len(set(made)) == len(made) and made and made[0] > 0
               and all(c in byte_of for t in vocab for c in t))
    return {bytes(byte_of[c] for c in t): i for t, i in vocab.items()} if settled else None


def stretches(text: str) -> Iterator[tuple[bool, str]]:
    """The text in parts that are cut at safe places: (whether all of it is settled, part)."""
    at = 0
    while found := UNSETTLED.search(text, at):
        start = text.rfind(" ", at + 1, found.start())
        while start > at and not SAFE.match(text, start):
            start = text.rfind(" ", at + 1, start)
        if start > at:
            yield True, text[at:start]
            at = start
        safe = SAFE.search(text, found.end())
        end = safe.start() if safe else len(text)
        yield False, text[at:end]
        at = end
    if at < len(text):
        yield True, text[at:]


class TokenCounter:
    """Counts tokens of texts; keep one per process, its cache is bounded."""

    def __init__(self, path: str, single: Iterable[str] | None = None):
        self.merger = Merger(path)
        self.single = dict.fromkeys(proven_single(self.merger.library) if single is None else single, 1)
        self.merged = dict(self.single)

    def count(self, text: str) -> int:
        if self.merger.plain(text):
            return self._settled(text)
        if self.merger.special.search(text):
            return len(self.merger.whole(text))
        return sum(self._settled(part) if settled else len(self.merger.whole(part)) for settled, part in stretches(text))

    def _settled(self, text: str) -> int:
        pieces = SETTLED_CUT(text)
        known = self.merged
        try:
            return sum(map(known.__getitem__, pieces))
        except KeyError:
            rest = [p for p in set(pieces) if p not in known]
        if len(known) + len(rest) > CACHE_ENTRIES:
            known = self.merged = dict(self.single)
            rest = [p for p in set(pieces) if p not in known]
        known.update(zip(rest, map(len, self.merger.parts(rest)), strict=True))
        return sum(map(known.__getitem__, pieces))


def count_tokens(docs: DataFrame, tokenizer_path: str, limit: int = 512) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every whole text; no shuffle."""
    single = sorted(proven_single(load(tokenizer_path)))  # bounded by the vocabulary
    shared = docs.sparkSession.sparkContext.broadcast(single)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = TokenCounter(tokenizer_path, shared.value)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            n = list(map(counter.count, texts))
            sizes = [len(t.encode()) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(n, pa.int64())],
                names=["doc_id", "n_bytes", "n_tokens"])

    counted = rows.mapInArrow(run, f"doc_id {id_type}, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
