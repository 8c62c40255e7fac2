"""Quality rules: text measures as Column expressions and a learned decision list over them.

The list is fitted by sequential covering. Each rule is a conjunction of threshold tests that is
grown on two thirds of the labelled rows by information gain and pruned on the rest. It is kept if it is
precise over all of them, the pruning rows do not speak against that, and a confidence bound on its precision,
corrected for the number of tests it was chosen from, lies above the share of bad rows: how many rows that
takes follows from the data, not from a count. The rows a rule covers are set aside before the next. Every statistic is a
Spark aggregate over all labelled rows; the driver sees counts by feature and bin only. The result
is an ordered CASE expression, so applying it needs neither Python workers nor a shuffle.

Edge cases: NULL and empty texts have no words, hence all measures 0; such rows fail the base rule.
NULL doc_ids are measured but never labelled. Repeated rows give repeated results. A label that is
NULL, not 0 or 1, or contradicted by another label of the same document is ignored. Without labels
of both kinds the list is empty and rejects nothing. Values equal to a threshold are not above it; equal
thresholds are one, and of tests that gain the same the first in the order of features and thresholds is taken. Input columns other than id and text are not
looked at, so their names cannot clash.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field
from statistics import NormalDist

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACES = " \t\n\x0b\f\r"
WINDOW = 5
FEATURES = ("n_words", "mean_word", "symbol_rate", "dup_line_rate", "repeat_rate", "upper_rate",
            "digit_rate", "mark_rate")


def let(value: Column, body) -> Column:
    """body(value) with value computed once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def word_array(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(
        F.split(trimmed, r"[\x20\x09-\x0D]+", -1))


def _repeated_words(words: Column) -> Column:
    """Words inside any 5-word window whose 64-bit hash occurs twice or more in the text.

    Only texts that repeat a window at all pay for sorting the windows.
    """
    hashes = F.transform(words, lambda w: F.xxhash64(w))
    n = F.size(words) - (WINDOW - 1)

    def windows(h: Column) -> Column:
        own = F.transform(h, lambda x, i: F.xxhash64(x, *(F.get(h, i + k) for k in range(1, WINDOW))))
        return F.slice(own, 1, F.greatest(n, F.lit(0)))

    def covered(w: Column) -> Column:
        placed = F.array_sort(F.transform(w, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def starts(s: Column) -> Column:
            twice = F.filter(s, lambda x, i: (x["h"] == F.when(i > 0, F.get(s, i - 1)["h"]))
                             | (x["h"] == F.get(s, i + 1)["h"]))
            return F.array_sort(F.transform(twice, lambda x: x["i"]))

        nothing = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-WINDOW).alias("last"))
        step = lambda a, i: F.struct(
            (a["n"] + F.least(F.lit(WINDOW), i - a["last"])).alias("n"), i.alias("last"))
        return F.aggregate(let(placed, starts), nothing, step, lambda a: a["n"])

    repeats = lambda w: F.when(F.size(F.array_distinct(w)) < F.size(w), covered(w)).otherwise(F.lit(0).cast("long"))
    return F.when(n < 2, F.lit(0).cast("long")).otherwise(let(let(hashes, windows), repeats))


def _count(text: Column, of: str) -> Column:
    """Characters of a class, given as the inside of a bracket expression."""
    return F.length(F.regexp_replace(text, f"[^{of}]+", "")).cast("long")


def measures(text: Column) -> Column:
    """One struct with the counts of a text and the rates that the rules may test."""
    t = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(t, "\n", -1), lambda line: F.btrim(line, F.lit(SPACES)) != "")

    def from_words(words: Column) -> Column:
        counts = F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.aggregate(words, F.lit(0).cast("long"), lambda a, w: a + F.length(w)).alias("word_chars"),
            _count(t, "#*$%&|<>").alias("n_symbols"),
            let(lines, lambda x: F.struct(
                F.size(x).cast("long").alias("n"),
                (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("dup"))).alias("lines"),
            _repeated_words(words).alias("n_repeat_words"))
        return let(counts, from_counts)

    def from_counts(c: Column) -> Column:
        per_char = lambda n: n / F.greatest(c["word_chars"], F.lit(1))
        per_word = lambda n: n / F.greatest(c["n_words"], F.lit(1))
        return F.struct(
            c["n_words"].alias("n_words"), c["word_chars"].alias("word_chars"),
            c["n_symbols"].alias("n_symbols"), c["lines"]["dup"].alias("n_dup_lines"),
            c["n_repeat_words"].alias("n_repeat_words"),
            per_word(c["word_chars"]).alias("mean_word"), per_char(c["n_symbols"]).alias("symbol_rate"),
            (c["lines"]["dup"] / F.greatest(c["lines"]["n"], F.lit(1))).alias("dup_line_rate"),
            per_word(c["n_repeat_words"]).alias("repeat_rate"),
            per_char(_count(t, r"\p{Lu}")).alias("upper_rate"), per_char(_count(t, "0-9")).alias("digit_rate"),
            per_char(_count(t, "!?")).alias("mark_rate"))

    return let(word_array(t), from_words)


def base_failed(m: Column) -> Column:
    return (m["n_words"] < 10) | (100 * m["n_repeat_words"] > 20 * m["n_words"])


@dataclass(frozen=True)
class Test:
    """feature > threshold, or feature <= threshold."""

    feature: str
    above: bool
    threshold: float

    def holds(self, value: Column) -> Column:
        return value > F.lit(self.threshold) if self.above else value <= F.lit(self.threshold)

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:.6g}"


@dataclass
class DecisionList:
    """Rules in order; the first whose tests all hold rejects, and what no rule covers is kept."""

    rules: list[list[Test]] = field(default_factory=list)
    precision: list[float] = field(default_factory=list)

    def rejected_by(self, m: Column) -> Column:
        """Number of the deciding rule from 1, or 0."""
        chain = F.lit(0)
        for i in range(len(self.rules), 0, -1):
            chain = F.when(_all(self.rules[i - 1], m), F.lit(i)).otherwise(chain)
        return chain

    def keeps(self, m: Column) -> Column:
        return self.rejected_by(m) == 0

    def __str__(self) -> str:
        return "\n".join(f"reject if {' and '.join(map(str, r))}  (precision {p:.3f})"
                         for r, p in zip(self.rules, self.precision, strict=True))


def _all(tests: list[Test], m: Column) -> Column:
    cond = F.lit(True)
    for t in tests:
        cond = cond & t.holds(m[t.feature])
    return cond


def labelled(measured: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows (m, bad, prune) of documents with one clear label, base failures left out."""
    clear = (labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1))
             .groupBy("doc_id").agg(F.min("quality").alias("lo"), F.max("quality").alias("hi"))
             .where("lo = hi").select("doc_id", (F.col("lo") == 0).alias("bad")))
    return (measured.where(~base_failed(F.col("m"))).join(clear, "doc_id")
            .select("m", "bad", (F.pmod(F.xxhash64("doc_id"), F.lit(3)) == 0).alias("prune")))


def precision_bound(bad: int, good: int, chance: float, upper: bool = False) -> float:
    """Wilson's bound on the share of bad rows, exceeded on its side with the given chance."""
    n = bad + good
    if n == 0:
        return 1.0 if upper else 0.0
    z = NormalDist().inv_cdf(1 - chance)
    centre, spread = bad / n + z * z / (2 * n), z * math.sqrt(bad * good / n**3 + z * z / (4 * n * n))
    return (centre + (spread if upper else -spread)) / (1 + z * z / n)


def accepted(bad: int, good: int, bad_pruning: int, good_pruning: int, share: float, tries: int,
             min_precision: float, chance: float) -> bool:
    """Whether a rule that covers these rows is kept; share is that of bad rows among all rows left."""
    if bad_pruning + good_pruning == 0 or bad < min_precision * (bad + good):
        return False
    fits = precision_bound(bad_pruning, good_pruning, chance, upper=True) >= min_precision
    return fits and precision_bound(bad, good, chance / tries) > share


def fit_list(examples: DataFrame, max_rules: int = 8, max_tests: int = 4, bins: int = 32,
             min_precision: float = 0.95, chance: float = 0.05) -> DecisionList:
    """Sequential covering over the rows of labelled(), which should be a written table.

    Thresholds are the quantiles of each feature among bad and among good rows. Which rules are kept
    says accepted(); it stops at the first that is not.
    """
    at = [i / bins for i in range(1, bins)]
    cuts_of = examples.groupBy("bad").agg(*(
        F.percentile_approx(F.col("m")[f].cast("double"), at, 10000).alias(f) for f in FEATURES)).collect()
    if len(cuts_of) < 2:
        return DecisionList()
    cuts = {f: sorted({float(c) for row in cuts_of for c in (row[f] or [])}) for f in FEATURES}
    tries = max_tests * 2 * sum(map(len, cuts.values()))
    found = DecisionList()
    while len(found.rules) < max_rules:
        left = examples.where(found.keeps(F.col("m")))
        rule = _grow(left.where(~F.col("prune")), cuts, max_tests)
        if not rule:
            break
        rule, n = _pruned(left, rule)
        share = n["bad"] / n["rows"]
        if not accepted(n["p"], n["n"], n["p_pruning"], n["n_pruning"], share, tries, min_precision, chance):
            break
        found.rules.append(rule)
        found.precision.append(n["p"] / (n["p"] + n["n"]))
    return found


def _grow(rows: DataFrame, cuts: dict[str, list[float]], max_tests: int) -> list[Test]:
    tests: list[Test] = []
    while len(tests) < max_tests:
        in_rule = rows.where(_all(tests, F.col("m")))
        binned = in_rule.select("bad", F.explode(F.array(*(
            F.struct(F.lit(f).alias("f"), _bin(F.col("m")[f], cuts[f]).alias("b")) for f in FEATURES))).alias("x"))
        counts = binned.groupBy("x.f", "x.b").agg(F.count_if("bad").alias("p"), F.count_if(~F.col("bad")).alias("n")).collect()
        best = _best_test(counts, cuts)
        if best is None:
            break
        tests.append(best[0])
        if best[1] == 0:
            break
    return tests


def _bin(value: Column, cuts: list[float]) -> Column:
    """How many thresholds lie below the value."""
    return F.size(F.filter(F.array(*map(F.lit, cuts)).cast("array<double>"), lambda c: c < value))


def _best_test(counts, cuts: dict[str, list[float]]) -> tuple[Test, int] | None:
    """The test with the largest gain p * (log precision after - log precision before), and the good rows it lets in."""
    one = [r for r in counts if r["f"] == FEATURES[0]]
    p0, n0 = sum(r["p"] for r in one), sum(r["n"] for r in one)
    if p0 == 0 or n0 == 0:
        return None
    best, top = None, 1e-9
    for f in FEATURES:
        own = {r["b"]: (r["p"], r["n"]) for r in counts if r["f"] == f}
        p_low = n_low = 0
        for b, cut in enumerate(cuts[f]):
            p, n = own.get(b, (0, 0))
            p_low, n_low = p_low + p, n_low + n
            for above, p_in, n_in in ((False, p_low, n_low), (True, p0 - p_low, n0 - n_low)):
                if p_in:
                    gain = p_in * (math.log2(p_in / (p_in + n_in)) - math.log2(p0 / (p0 + n0)))
                    if gain > top:
                        best, top = (Test(f, above, cut), n_in), gain
    return best


def _pruned(left: DataFrame, rule: list[Test]) -> tuple[list[Test], dict[str, int]]:
    """The leading tests that do best on the pruning rows, with the bad (p) and good (n) rows they cover, there and in all."""
    heads = [rule[:k] for k in range(1, len(rule) + 1)]
    bad, pruning = F.col("bad"), F.col("prune")
    counts = [
        F.count_if(_all(h, F.col("m")) & (bad if kind == "p" else ~bad) & (pruning if of else F.lit(True))).alias(f"{kind}{of}{k}")
        for k, h in enumerate(heads) for kind in "pn" for of in ("", "_pruning")]
    row = left.agg(F.count_if(bad).alias("bad"), F.count(F.lit(1)).alias("rows"), *counts).first()
    covered = [(row[f"p_pruning{k}"], row[f"n_pruning{k}"]) for k in range(len(heads))]
    k = -max(((p - n) / max(1, p + n), -k) for k, (p, n) in enumerate(covered))[1]
    return heads[k], {"bad": row["bad"], "rows": row["rows"], **{c: row[f"{c}{k}"] for c in ("p", "n", "p_pruning", "n_pruning")}}
