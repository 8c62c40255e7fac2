"""Language identification in two steps: the language family first, then one-versus-one linear
support vector machines between the languages of that family.

Features are hashed byte n-grams of the letters of a text, square-rooted and scaled to unit length, so
a text counts whole whatever its length. Every pair of families and every pair of languages within one
family has its own machine. More than `branch` families, or languages of one family, are first told apart
in runs of their names, so the number of machines grows in proportion to the number of languages.

The fit is on a bounded sample: the `max_languages` languages with most labelled texts, at most `per_language`
texts of each, and at most `per_side` on either side of a machine, dealt evenly over the side's languages. The
texts are those with the least hash of their content. One task trains one machine. The weights come to the driver:
DIMENSIONS numbers a machine, some 8 * `max_languages` machines at most, which also bounds what is broadcast.

Edge cases: a NULL text, or one without a letter, is `und` with score 0. Without labelled texts
everything is `und`; with one language everything with a letter is that language, score 1. Languages
outside the table of families form families of their own; equally frequent languages rank by name. Repeated rows, NULL ids and other columns
do not matter to a prediction.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import stored

BITS = 12
DIMENSIONS = 1 << BITS
PER_LANGUAGE, PER_SIDE, MAX_LANGUAGES = 1000, 4000, 512
BRANCH = 16
# Families of common languages by ISO 639-1 code.
FAMILIES = {
    "germanic": "af da de en fo fy is lb nb nl nn no sv yi",
    "romance": "ca es fr gl it la oc pt ro",
    "slavic": "be bg bs cs hr mk pl ru sk sl sr uk",
    "baltic": "lt lv",
    "celtic": "br cy ga gd gv",
    "hellenic": "el",
    "indic": "as bn gu hi mr ne or pa sd si ur",
    "iranian": "fa ku ps tg",
    "semitic": "am ar he mt ti",
    "turkic": "az kk ky tk tr tt ug uz",
    "uralic": "et fi hu",
    "dravidian": "kn ml ta te",
    "malayic": "id jv ms su tl",
    "sinitic": "yue zh",
    "japonic": "ja",
    "koreanic": "ko",
    "austroasiatic": "km vi",
    "kra-dai": "lo th",
}
FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes.split()}


def family(lang: str) -> str:
    return FAMILY_OF.get(lang.lower().split("-")[0], lang)


class Features:
    """Unit vectors of hashed byte n-grams of lengths 1 to 4, over letters with single spaces between words."""

    def __init__(self) -> None:
        import regex

        self.other = regex.compile(r"[^\p{L}\p{M}]+")
        self.letter = regex.compile(r"\p{L}")

    def vector(self, text: str | None) -> np.ndarray | None:
        """None if there is no letter."""
        if not text or not self.letter.search(text):
            return None
        raw = np.frombuffer(f" {self.other.sub(' ', text).strip().lower()} ".encode("utf-8", "replace"), np.uint8)
        total = np.zeros(DIMENSIONS)
        for base in range(0, len(raw), 1 << 20):  # bounded memory for very long texts
            part = raw[base:base + (1 << 20) + 3].astype(np.uint32)
            code = np.zeros(len(part), np.uint32)
            for n in range(1, 5):
                code = (code[:len(part) - n + 1] * np.uint32(0x01000193)) ^ part[n - 1:]
                own = code[:max(0, min(len(code), 1 << 20))]
                slot = ((own + np.uint32(n)) * np.uint32(2654435761)) >> np.uint32(32 - BITS)
                total += np.bincount(slot, minlength=DIMENSIONS)
        total = np.sqrt(total)
        return (total / np.linalg.norm(total)).astype(np.float32)


def train_pair(x: np.ndarray, y: np.ndarray, rounds: int = 12, cost: float = 4.0) -> tuple[np.ndarray, float]:
    """Linear machine with squared hinge loss by dual coordinate descent; y is +1 or -1. Returns weights and bias.

    Samples of the rarer side weigh more, so that both sides count alike.
    """
    n = len(y)
    data = np.hstack((x, np.ones((n, 1), x.dtype)))  # stays in single precision: the largest array of the task
    c = cost * n / 2 / np.where(y > 0, max(1, (y > 0).sum()), max(1, (y < 0).sum()))
    diagonal = 1 / (2 * c)
    norm = np.einsum("ij,ij->i", data, data, dtype=np.float64) + diagonal
    w, alpha = np.zeros(data.shape[1]), np.zeros(n)
    order = np.random.default_rng(7)
    for _ in range(rounds):
        for i in order.permutation(n):
            slack = y[i] * (data[i] @ w) - 1 + diagonal[i] * alpha[i]
            new = max(0.0, alpha[i] - slack / norm[i])
            if new != alpha[i]:
                w += (new - alpha[i]) * y[i] * data[i]
                alpha[i] = new
    return w[:-1], float(w[-1])


def _branches(name: str, names: list[str], branch: int) -> tuple[str, ...]:
    """name, behind the runs of names that hold it where there are more than `branch`."""
    if len(names) <= branch:
        return (name,)
    size = -(-len(names) // branch)
    run = names.index(name) // size
    return (f"#{run}", *_branches(name, names[run * size:(run + 1) * size], branch))


def paths(langs: list[str], branch: int = BRANCH) -> dict[str, tuple[str, ...]]:
    """The decisions that lead to each language: its family, then itself."""
    by_family: dict[str, list[str]] = {}
    for lang in sorted(langs):
        by_family.setdefault(family(lang), []).append(lang)
    names = sorted(by_family)
    return {lang: (*_branches(f, names, branch), *_branches(lang, by_family[f], branch)) for f in names for lang in by_family[f]}


def _level(path: tuple[str, ...], depth: int) -> str | tuple[str, ...]:
    return path[:depth] or "family"


def _sides(langs: list[str]) -> dict:
    """For each level, its sides and the number of languages on each."""
    sides: dict = {}
    for path in paths(langs).values():
        for depth, side in enumerate(path):
            at = sides.setdefault(_level(path, depth), {})
            at[side] = at.get(side, 0) + 1
    return sides


def _pairs(langs: list[str]) -> list[tuple]:
    """(level, a, b): the sides of each machine; the level is "family", or the decisions before it."""
    return [(level, a, b) for level, sides in _sides(langs).items() for i, a in enumerate(sides) for b in list(sides)[i + 1:]]


def fit(labelled: DataFrame, per_language: int = PER_LANGUAGE, per_side: int = PER_SIDE,
        max_languages: int = MAX_LANGUAGES) -> tuple[list[str], list[tuple]]:
    """Languages and machines (level, a, b, weights, bias) from rows (text, lang)."""
    clean = labelled.where("lang is not null and text is not null and lang <> 'und'")
    langs = sorted(r["lang"] for r in clean.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(max_languages).collect())
    # the bound is applied to hashes of texts before any text moves
    hashed = clean.where(F.col("lang").isin(langs)).select("lang", "text", F.xxhash64("text").alias("h"))
    by_hash = Window.partitionBy("lang").orderBy("h")
    least = hashed.select("lang", "h").distinct().withColumn("r", F.row_number().over(by_hash)).where(F.col("r") <= per_language)
    limits = least.groupBy("lang").agg(F.max("h").alias("most"))  # a row a language, so bounded by max_languages
    sample = hashed.join(F.broadcast(limits), "lang").where("h <= most").dropDuplicates(["lang", "h"]).select(
        "lang", "text", F.row_number().over(by_hash).alias("r"))
    pairs, sides, path_of = _pairs(langs), _sides(langs), paths(langs)
    of_side: dict = {}
    for k, (level, a, b) in enumerate(pairs):
        of_side.setdefault((level, a), []).append((k, 1))
        of_side.setdefault((level, b), []).append((k, -1))

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features()
        for batch in batches:
            for lang, text, r in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                v, path = features.vector(text), path_of[lang]
                if v is None:
                    continue
                due = [x for depth, side in enumerate(path) for x in of_side.get((_level(path, depth), side), ())
                       if r <= -(-per_side // sides[_level(path, depth)][side])]
                if due:  # one batch a text: it holds the vector once for each of its machines
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([k for k, _ in due], pa.int32()), pa.array([y for _, y in due], pa.int32()),
                         pa.array([v.tobytes()] * len(due), pa.binary())], names=["pair", "side", "v"])

    def train(table: pa.Table) -> pa.Table:
        table = table.sort_by([("side", "ascending"), ("v", "ascending")])  # whatever way rows arrived
        x = np.concatenate([np.frombuffer(v.as_buffer(), np.float32) for v in table.column("v")]).reshape(-1, DIMENSIONS)
        w, bias = train_pair(x, table.column("side").to_numpy().astype(np.float64))
        return pa.table({"pair": table.column("pair").slice(0, 1), "w": pa.array([w.astype(np.float32).tobytes()], pa.binary()),
                         "bias": pa.array([bias])})

    if not pairs:
        return langs, []
    rows = stored(sample, "labelled").repartition(max(8, len(pairs))).mapInArrow(vectors, "pair int, side int, v binary")
    trained = rows.groupBy("pair").applyInArrow(train, "pair int, w binary, bias double").collect()
    return langs, [(*pairs[r["pair"]], bytes(r["w"]), r["bias"]) for r in trained]


def predict(docs: DataFrame, model: tuple[list[str], list]) -> DataFrame:
    """(doc_id, lang_pred, score): the score is the weakest logistic margin of the machines that decided."""
    langs, machines = model
    shared = docs.sparkSession.sparkContext.broadcast(machines)  # bounded by max_languages of the fit
    id_type = docs.schema["doc_id"].dataType.simpleString()
    sides = {level: list(names) for level, names in _sides(langs).items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features()
        held: dict = {}
        for level, a, b, w, bias in shared.value:
            held.setdefault(level, []).append((a, b, np.frombuffer(w, np.float32), bias))
        held = {level: ([x[:2] for x in rows], np.stack([x[2] for x in rows]), np.array([x[3] for x in rows])) for level, rows in held.items()}

        def vote(level, v: np.ndarray) -> tuple[str, float]:
            """The side with most wins, then the largest sum of margins; and its weakest margin."""
            names = sides[level]
            if level not in held:
                return names[0], 1.0
            between, w, bias = held[level]
            wins = {n: [0, 0.0, 1.0] for n in names}
            for (a, b), m in zip(between, (w @ v + bias).tolist(), strict=True):
                for n, side in ((a, m), (b, -m)):
                    own = wins[n]
                    own[0] += side > 0
                    own[1] += side
                    own[2] = min(own[2], 1 / (1 + np.exp(-min(max(4 * side, -50), 50))))
            best = max(names, key=lambda n: (wins[n][0], wins[n][1], n))
            return best, float(wins[best][2])

        for batch in batches:
            names, scores = [], []
            for text in batch.column(1).to_pylist():
                v = features.vector(text) if langs else None
                if v is None:
                    names.append("und")
                    scores.append(0.0)
                    continue
                path: tuple[str, ...] = ()
                score = 1.0
                while (path or "family") in sides:
                    side, margin = vote(path or "family", v)
                    path, score = (*path, side), min(score, margin)
                names.append(path[-1])
                scores.append(score)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                                             names=["doc_id", "lang_pred", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {id_type}, lang_pred string, score double")
