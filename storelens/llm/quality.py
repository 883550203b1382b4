"""Quality rules: a decision list learned by sequential covering, applied as one
conditional expression over text statistics.

The statistics are array functions on whole texts; nothing is exploded or shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from storelens.llm.text import SPACES, words

SYMBOLS = "#*$%&|<>"
WINDOW = 3
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def statistics(docs: DataFrame) -> DataFrame:
    """``docs`` plus the five base counts of ``text`` (long; 0 for a null text).

    ``n_repeat_words`` counts the words that lie in a window of three words found twice
    or more in the text.  Windows are compared by 64-bit hashes, sorted in the row.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    with_words = docs.withColumns({
        "_words": words(text),
        "_lines": F.filter(F.split(text, "\n", -1), lambda line: F.btrim(line, F.lit(SPACES)) != ""),
    })
    hashed = with_words.withColumn("_windows", F.when(
        F.size("_words") >= WINDOW,
        F.transform(
            F.sequence(F.lit(0), F.size("_words") - WINDOW),
            lambda i: F.xxhash64(F.get("_words", i), F.get("_words", i + 1), F.get("_words", i + 2)),
        ),
    ))
    ranked = hashed.withColumn("_ranked", F.when(
        F.size(F.array_distinct("_windows")) < F.size("_windows"),
        F.sort_array(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("at")))),
    ))
    repeated = ranked.withColumn("_at", F.sort_array(F.transform(
        F.filter("_ranked", lambda w, i: (
            F.coalesce(F.get("_ranked", i - 1)["h"] == w["h"], F.lit(False))
            | F.coalesce(F.get("_ranked", i + 1)["h"] == w["h"], F.lit(False))
        )),
        lambda w: w["at"],
    )))
    covered = F.aggregate(
        "_at",
        F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("n")),
        lambda acc, at: F.struct(
            at.alias("last"), (acc["n"] + F.least(F.lit(WINDOW), at - acc["last"])).alias("n")
        ),
        lambda acc: acc["n"],
    )
    rest = [F.col(c) for c in docs.columns if c not in BASE]
    return repeated.select(
        *rest,
        "_lines",
        F.size("_words").cast("long").alias("n_words"),
        F.char_length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        F.char_length(F.regexp_replace(text, f"[^{SYMBOLS}]+", "")).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
        F.char_length(F.regexp_replace(text, r"[^A-Z]+", "")).cast("long").alias("_capitals"),
        F.char_length(F.regexp_replace(text, r"[^0-9]+", "")).cast("long").alias("_digits"),
        F.char_length(F.regexp_replace(text, r"[^.,;:!?]+", "")).cast("long").alias("_marks"),
        F.size(F.array_distinct("_words")).cast("long").alias("_vocabulary"),
    )




def _share(part: str, of: Column) -> Column:
    return F.col(part) / F.greatest(of, F.lit(1))


def features(stats: DataFrame) -> dict[str, Column]:
    """What a rule may test: shares of the counts, all doubles, never null."""
    n_words, text = F.col("n_words"), F.coalesce(F.col("text"), F.lit(""))
    return {
        "words": n_words.cast("double"),
        "word_length": _share("word_chars", n_words),
        "symbol_share": _share("n_symbols", F.char_length(text)),
        "capital_share": _share("_capitals", F.char_length(text)),
        "digit_share": _share("_digits", F.char_length(text)),
        "mark_share": _share("_marks", F.char_length(text)),
        "vocabulary_share": _share("_vocabulary", n_words),
        "dup_line_share": _share("n_dup_lines", F.size("_lines")),
        "repeat_share": _share("n_repeat_words", n_words),
    }


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def holds(self, values: dict[str, np.ndarray]) -> np.ndarray:
        v = values[self.feature]
        return v > self.threshold if self.above else v <= self.threshold

    def column(self) -> Column:
        c = F.col(f"_f_{self.feature}")
        return c > F.lit(self.threshold) if self.above else c <= F.lit(self.threshold)


Rule = tuple[Condition, ...]


def _covered(rule: Rule, values: dict[str, np.ndarray], n: int) -> np.ndarray:
    return reduce(lambda a, c: a & c.holds(values), rule, np.ones(n, dtype=bool))


def _grow(values: dict[str, np.ndarray], bad: np.ndarray, cuts: int, most: int) -> Rule:
    """Add the condition of the largest information gain until no good row is covered."""
    rule: Rule = ()
    inside = np.ones(len(bad), dtype=bool)
    while len(rule) < most and (bad & inside).any() and (~bad & inside).any():
        p0, n0 = (bad & inside).sum(), (~bad & inside).sum()
        best, best_gain = None, 1e-9
        for name in sorted(values):
            v = values[name][inside]
            seen = np.unique(v)
            at = np.searchsorted(seen, np.unique(np.quantile(v, np.linspace(0, 1, cuts), method="lower")))
            # half way to the next value, so that a rule keeps its distance from both sides
            for cut in (seen[i : i + 2].mean() for i in at if i + 1 < len(seen)):
                for above in (True, False):
                    hit = v > cut if above else v <= cut
                    p, n = (hit & bad[inside]).sum(), (hit & ~bad[inside]).sum()
                    if p == 0:
                        continue
                    gain = p * (np.log2(p / (p + n)) - np.log2(p0 / (p0 + n0)))
                    if gain > best_gain:
                        best, best_gain = Condition(name, above, float(cut)), gain
        if best is None:
            break
        rule += (best,)
        inside &= best.holds(values)
    return rule


def _prune(rule: Rule, values: dict[str, np.ndarray], bad: np.ndarray) -> Rule:
    """Drop last conditions as long as the rule gets no worse on the rows held back."""
    def worth(r: Rule) -> float:
        hit = _covered(r, values, len(bad))
        p, n = (hit & bad).sum(), (hit & ~bad).sum()
        return (p - n) / (p + n) if p + n else -1.0

    best = rule
    for length in range(len(rule) - 1, 0, -1):
        if worth(rule[:length]) >= worth(best):
            best = rule[:length]
    return best


def learn_list(
    values: dict[str, Sequence[float]], bad: Sequence[bool], precision: float = 0.95, least: int = 5,
    max_rules: int = 16, max_conditions: int = 4, cuts: int = 48,
) -> list[Rule]:
    """Rules that reject, in order; a row that none covers is kept.

    Two of three rows grow a rule, the third prunes it.  A rule must cover ``least`` bad
    rows, with ``precision`` of all rows it covers bad.  Covered rows then leave the
    sample.  No bad rows, no good rows or no rows: no rules.
    """
    values = {k: np.asarray(v, dtype=float) for k, v in values.items()}
    bad = np.asarray(bad, dtype=bool)
    left, rules = np.ones(len(bad), dtype=bool), []
    third = np.arange(len(bad)) % 3 == 2
    while len(rules) < max_rules and (left & bad).sum() >= least and not bad.all():
        part = lambda mask: ({k: v[mask] for k, v in values.items()}, bad[mask])
        rule = _grow(*part(left & ~third), cuts, max_conditions)
        if not rule:
            break
        rule = _prune(rule, *part(left & third))
        hit = _covered(rule, values, len(bad)) & left
        p = (hit & bad).sum()
        if p < least or p < precision * hit.sum():
            break
        rules.append(rule)
        left &= ~hit
    return rules


def verdict(rules: list[Rule]) -> Column:
    """True if no rule rejects; needs the feature columns ``_f_<name>``."""
    if not rules:
        return F.lit(True)
    tests = [reduce(lambda a, b: a & b, (c.column() for c in rule)) for rule in rules]
    out = F.when(tests[0], False)
    for test in tests[1:]:
        out = out.when(test, False)
    return out.otherwise(True)


def fit(docs: DataFrame, labels: DataFrame, max_labels: int = 6000, **options) -> list[Rule]:
    """Learn from at most ``max_labels`` labelled documents, chosen by the hash of their id.

    ``labels`` has ``doc_id`` and ``quality`` (0 bad, 1 good); null ids and labels are left
    out, a document with several labels counts as bad if one says so.
    """
    known = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(
        F.min("quality").alias("_quality")
    )
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labels)
    # at most max_labels rows of two numbers: small enough to broadcast whatever the corpus
    labelled = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
    stats = statistics(labelled)
    named = features(stats)
    rows = stats.select("doc_id", "_quality", *(c.alias(k) for k, c in named.items())).collect()
    rows.sort(key=lambda r: (r["doc_id"], *r[1:]))
    return learn_list({k: [r[k] for r in rows] for k in named}, [r["_quality"] == 0 for r in rows], **options)


def judged(docs: DataFrame, rules: list[Rule], min_words: int = 50, max_repeat_percent: int = 50) -> DataFrame:
    """``docs`` plus the base counts, ``base_failed`` and ``kept``.

    A document fails the base test with fewer than ``min_words`` words or with more than
    ``max_repeat_percent`` percent of its words in repeated windows; it is kept if it
    passes and no learned rule rejects it.  A null text counts as empty and fails.  Input
    columns named like an added one are replaced; names that start with ``_`` are
    reserved.  Repeated rows are judged one by one; an empty table gives an empty table.
    """
    own = [c for c in docs.columns if c not in (*BASE, "base_failed", "kept")]
    stats = statistics(docs)
    stats = stats.withColumns({f"_f_{k}": c for k, c in features(stats).items()})
    failed = (F.col("n_words") < min_words) | (
        100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words")
    )
    # Through a generator, so that a filter on the outcome is not pushed below: the
    # optimizer would put the array functions in its place once for every mention.
    outcome = F.struct(*BASE, failed.alias("base_failed"), (~failed & verdict(rules)).alias("kept"))
    return stats.select(*own, F.explode(F.array(outcome)).alias("_outcome")).select(*own, "_outcome.*")


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    rules = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return judged(docs, rules).drop("text")
