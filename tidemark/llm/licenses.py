"""License scan: Aho-Corasick finds notice phrases and identifier tags, a shunting-yard parser
evaluates the tags' and/or/with expressions.

Phrases are sequences of words (letters and digits in lower case, anything outside ASCII included),
so any run of other characters may stand between them. A tag names an expression up to the next tag or the
end of its line; one that does not parse gives no label, nor do `none` and `noassertion`. Phrases and tags are matched in whole texts by two
automata that each pass a text once.

Edge cases: a NULL text counts as empty; NULL ids pass through; repeated rows repeat their result;
other input columns are ignored. The score is that of the strongest evidence: 1 for a valid tag,
0.9 for a full notice sentence, 0.7 for a name of a licence, 0 for none.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The base phrases with their labels.
BASE_PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
# Further names of licences, and sentences of their notices.
NAMES = {
    "lesser general public license": "lgpl",
    "affero general public license": "agpl",
    "mozilla public license": "mpl",
    "bsd license": "bsd",
    "isc license": "isc",
    "creative commons attribution": "cc-by",
    "eclipse public license": "epl",
    "boost software license": "bsl",
}
NOTICES = {
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "licensed under the apache license": "apache",
    "redistribution and use in source and binary forms with or without modification": "bsd",
    "you can redistribute it and or modify it under the terms of the gnu": "gpl",
    "permission to use copy modify and or distribute this software for any purpose": "isc",
    "this is free and unencumbered software released into the public domain": "unlicense",
}
TAGS = ("spdx-license-identifier:", "license-identifier:")
# Identifiers that permit use without conditions on derived works.
PERMISSIVE = frozenset({"mit", "apache-2.0", "bsd-2-clause", "bsd-3-clause", "isc", "unlicense", "cc0-1.0",
                        "cc-by-4.0", "bsl-1.0", "zlib"})
# What a tag says where it names no licence.
NO_LICENCE = frozenset({"none", "noassertion"})
PRECEDENCE = {"or": 1, "and": 2, "with": 3}
# every ASCII character that is no word character becomes a space, A-Z become a-z
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def postfix(expression: str) -> list[str] | None:
    """The expression in postfix order with operands in lower case, or None if it does not parse."""
    out: list[str] = []
    held: list[str] = []
    operand_next = True
    tokens = re.findall(r"[A-Za-z0-9.+:_-]+|[()]|\S", expression)
    for raw in tokens:
        t = raw.lower()
        if t in PRECEDENCE:
            if operand_next:
                return None
            while held and held[-1] != "(" and PRECEDENCE[held[-1]] >= PRECEDENCE[t]:
                out.append(held.pop())
            held.append(t)
            operand_next = True
        elif t == "(":
            if not operand_next:
                return None
            held.append(t)
        elif t == ")":
            if operand_next:
                return None
            while held and held[-1] != "(":
                out.append(held.pop())
            if not held:
                return None
            held.pop()
        elif operand_next and re.fullmatch(r"[a-z0-9.+:_-]+", t):
            out.append(t)
            operand_next = False
        else:
            return None
    if operand_next or "(" in held:
        return None
    return out + held[::-1]


def evaluate(rpn: list[str], permitted=PERMISSIVE) -> tuple[frozenset[str], bool] | None:
    """The licences an expression names, and whether the permitted ones suffice to comply with it.

    or: one side is enough; and: both are needed; with: the right side is an exception that belongs
    to the licence on its left, named licence-with-exception, and permitted as that licence is.
    """
    stack: list[tuple[set[str], bool]] = []
    for t in rpn:
        if t not in PRECEDENCE:
            stack.append(({t}, t in permitted))
            continue
        right, left = stack.pop(), stack.pop()
        if t == "with":
            if len(left[0]) != 1 or len(right[0]) != 1:
                return None
            stack.append(({f"{min(left[0])}-with-{min(right[0])}"}, left[1]))
        else:
            few, many = sorted((left[0], right[0]), key=len)
            many |= few
            stack.append((many, left[1] or right[1] if t == "or" else left[1] and right[1]))
    return frozenset(stack[0][0]), stack[0][1]


class Scanner:
    """Both automata; texts go through as bytes read one to one as characters."""

    def __init__(self) -> None:
        import ahocorasick

        self.phrases = ahocorasick.Automaton()
        found: dict[str, list[tuple[str, str]]] = {}
        for kind, phrases in (("base", BASE_PHRASES), ("name", NAMES), ("notice", NOTICES)):
            for phrase, label in phrases.items():
                found.setdefault(f" {phrase} ", []).append((kind, label))
        for phrase, what in found.items():
            self.phrases.add_word(phrase, (len(phrase), what))
        self.phrases.make_automaton()
        self.tags = ahocorasick.Automaton()
        for tag in TAGS:
            self.tags.add_word(tag, len(tag))
        self.tags.make_automaton()

    def scan(self, text: str) -> dict:
        raw = text.encode("utf-8", "surrogatepass")
        words = raw.translate(WORD_BYTES).split()
        joined = (b" " + b" ".join(words) + b" ").decode("latin-1")
        out = {"n_words": len(words), "n_base": 0, "first_word": None, "last_word": None,
               "base": set(), "labels": set(), "tags": [], "score": 0.0}
        at = word = 0  # spaces before `at` are counted in `word`; hits come in order of their ends
        for end, (size, what) in self.phrases.iter(joined):
            start = end - size + 1
            word += joined.count(" ", at, start) if start >= at else -joined.count(" ", start, at)
            at = start
            for kind, label in what:
                out["labels"].add(label)
                out["score"] = max(out["score"], 0.9 if kind == "notice" else 0.7)
                if kind == "base":
                    out["base"].add(label)
                    out["n_base"] += 1
                    out["first_word"] = word if out["first_word"] is None else min(word, out["first_word"])
                    out["last_word"] = word if out["last_word"] is None else max(word, out["last_word"])
        lowered = raw.lower().decode("latin-1")
        ends: dict[int, int] = {}
        for end, size in self.tags.iter(lowered):  # a tag that ends another tag is one place
            ends[end + 1] = max(size, ends.get(end + 1, 0))
        following = len(raw)
        for start in reversed(ends):
            stop = lowered.find("\n", start, following)
            expression = raw[start:stop if stop >= 0 else following].decode("utf-8", "replace").lower().strip()
            for closing in ("*/", "-->"):
                if expression.endswith(closing):
                    expression = expression[:-len(closing)].rstrip()
                    break
            rpn = postfix(expression)
            value = evaluate(rpn) if rpn else None
            out["tags"].append((expression, value is not None, bool(value and value[1])))
            following = start - ends[start]
            if value and value[0] - NO_LICENCE:
                out["labels"] |= value[0] - NO_LICENCE
                out["score"] = 1.0
        out["tags"].reverse()
        return out


SCAN_SCHEMA = ("n_words long, n_base long, first_word long, last_word long, base_labels array<string>, "
               "labels array<string>, tags array<struct<expression:string,valid:boolean,permitted:boolean>>, score double")


def scan_licenses(docs: DataFrame) -> DataFrame:
    """doc_id with SCAN_SCHEMA: phrases by word position, sorted labels, and every tag with its verdict."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    tag_type = pa.list_(pa.struct([("expression", pa.string()), ("valid", pa.bool_()), ("permitted", pa.bool_())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner()
        for batch in batches:
            found = [scanner.scan(t) for t in batch.column(1).to_pylist()]
            col = lambda k, kind: pa.array([f[k] for f in found], kind)
            lists = lambda k: pa.array([sorted(f[k]) for f in found], pa.list_(pa.string()))
            tags = pa.array([[dict(zip(("expression", "valid", "permitted"), t, strict=True)) for t in f["tags"]]
                             for f in found], tag_type)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(col(k, pa.int64()) for k in ("n_words", "n_base", "first_word", "last_word")),
                 lists("base"), lists("labels"), tags, col("score", pa.float64())],
                names=["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "tags", "score"])

    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).mapInArrow(
        run, f"doc_id {id_type}, {SCAN_SCHEMA}")
