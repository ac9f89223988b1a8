"""Quality rules with risk-controlled thresholds, on built-in functions only.

Each rule rejects a document whose statistic is above a cutoff. The cutoffs come from labelled documents: in every
stratum a cutoff may be used only if an exact (Clopper-Pearson) upper bound on the share of good documents it rejects
is at most ``risk``. All bounds hold together with probability ``1 - delta``: Bonferroni over strata and rules, and
within one rule the cutoffs are tried from the most lenient on, stopping at the first that fails, which needs no further
correction. Among the cutoffs that pass, the one is taken that rejects most labelled bad documents for what it costs
in good ones; if none rejects more, the rule is not used in that stratum.

The strata are the languages. Where a language has too few good documents for any cutoff to pass, it is pooled with the next
smallest stratum, until each has enough or all are one; the bounds then hold for the pool. The pools depend on how many
labels there are and on nothing else, so the bounds stay exact.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acreage.llm.common import stored, words_of

# Limit on the share of good documents that one rule rejects in a stratum, and the chance that any limit is broken.
RISK = 0.015
DELTA = 0.05
# A rejected share of good documents counts as much as this many times the same share of bad ones.
COST = 20.0
# Languages that are strata of their own before pooling; those with fewer labels begin as one stratum.
LANGUAGES = 64

# Fixed values of the base rules.
SYMBOLS = r"[#*$%&|<>]"
WINDOW = 5

# Statistics and their cutoffs, from lenient to strict.
_SHARES = tuple(round(0.98 - 0.02 * k, 2) for k in range(49))
RULES: dict[str, tuple[float, ...]] = {
    "symbol_rate": tuple(round(4.0 * 0.85**k, 4) for k in range(40)),
    "upper_share": _SHARES,
    "dup_line_share": _SHARES,
    "repeat_share": _SHARES,
    "word_length": tuple(round(40.0 * 0.95**k, 3) for k in range(45)),
    "bang_rate": tuple(round(4.0 * 0.85**k, 4) for k in range(40)),
}


def _let(value: Column, body) -> Column:
    """``body`` of ``value``, which is worked out once however often ``body`` names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def repeated_words(words: Column) -> Column:
    """Words that lie in a 5-word window found twice or more, the first included.

    Windows are compared by a 64-bit hash of their words' hashes. Only texts where some hash repeats go on to sort
    (hash, place) and to count the places covered.
    """
    hashes = F.transform(words, lambda w: F.xxhash64(w))

    def windows(h: Column) -> Column:
        at = lambda i, k: F.get(h, i + k)
        joined = F.transform(h, lambda x, i: F.xxhash64(x, *(at(i, k) for k in range(1, WINDOW))))
        return F.slice(joined, F.lit(1), F.greatest(F.size(h) - (WINDOW - 1), F.lit(0)))

    def covered(grams: Column) -> Column:
        ordered = F.sort_array(F.transform(grams, lambda g, i: F.struct(g.alias("g"), i.alias("i"))))

        def places(s: Column) -> Column:
            same = lambda x, j: F.coalesce(F.get(s, j)["g"] == x["g"], F.lit(False))
            kept = F.filter(s, lambda x, j: F.when(j > 0, same(x, j - 1)).otherwise(False) | same(x, j + 1))
            return F.array_sort(F.transform(kept, lambda x: x["i"]))

        # each place adds the words that the place before it does not cover
        def total(p: Column) -> Column:
            step = lambda x, j: F.when(j > 0, F.least(F.lit(WINDOW), x - F.get(p, j - 1))).otherwise(F.lit(WINDOW))
            return F.aggregate(F.transform(p, step), F.lit(0), lambda a, b: a + b)

        return _let(_let(ordered, places), total)

    def count(grams: Column) -> Column:
        return F.when(F.size(F.array_distinct(grams)) == F.size(grams), F.lit(0)).otherwise(covered(grams))

    return _let(_let(hashes, windows), count)


def statistics(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``stratum``, the base counts and the rules' statistics of every row."""
    stratum = F.coalesce(F.col("lang").cast("string"), F.lit("")) if "lang" in docs.columns else F.lit("")
    base = docs.select("doc_id", stratum.alias("stratum"), F.coalesce("text", F.lit("")).alias("text"))
    base = base.withColumn("words", words_of(F.col("text")))
    lines = F.filter(F.split("text", "\n", -1), lambda x: F.length(F.btrim(x, F.lit(" \t\n\x0b\x0c\r"))) > 0)
    without = lambda pattern: F.length("text") - F.length(F.regexp_replace("text", pattern, ""))
    counted = base.select(
        "doc_id",
        "stratum",
        F.size("words").cast("bigint").alias("n_words"),
        F.length(F.array_join("words", "")).cast("bigint").alias("word_chars"),
        without(SYMBOLS).cast("bigint").alias("n_symbols"),
        _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("bigint").alias("n_dup_lines"),
        _let(lines, lambda x: F.size(x)).cast("bigint").alias("_lines"),
        repeated_words(F.col("words")).cast("bigint").alias("n_repeat_words"),
        without(r"\p{Lu}").alias("_upper"),
        without("!").alias("_bangs"),
    )
    per = lambda n, of: F.coalesce(F.try_divide(F.col(n).cast("double"), F.col(of)), F.lit(0.0))
    return counted.select(
        "doc_id",
        "stratum",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        per("n_symbols", "n_words").alias("symbol_rate"),
        per("_upper", "word_chars").alias("upper_share"),
        per("n_dup_lines", "_lines").alias("dup_line_share"),
        per("n_repeat_words", "n_words").alias("repeat_share"),
        per("word_chars", "n_words").alias("word_length"),
        per("_bangs", "n_words").alias("bang_rate"),
    )


def binomial_tail(k: int, n: int, p: float) -> float:
    """P(X <= k) for X binomial in n and p, summed exactly in logarithms."""
    if k >= n:
        return 1.0
    terms = [
        math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p)
        for i in range(k + 1)
    ]
    top = max(terms)
    return min(1.0, math.exp(top) * math.fsum(math.exp(t - top) for t in terms))


def within_risk(rejected: int, good: int, risk: float, error: float) -> bool:
    """Whether the exact upper bound at confidence ``1 - error`` on the rejected share is at most ``risk``.

    The bound is at most ``risk`` exactly if so few rejections have a chance of at most ``error`` when the share is
    ``risk``.
    """
    return good > 0 and rejected <= risk * good and binomial_tail(rejected, good, risk) <= error


def pools(good: dict[str, int], risk: float, delta: float) -> list[tuple[str, ...]]:
    """The strata by their good documents: the smallest two are pooled until a cutoff can pass in each."""
    strata = sorted(((n, (s,)) for s, n in good.items()), reverse=True)
    # what is left of a long tail of languages begins as one pool
    strata = [*strata[:LANGUAGES], *([(sum(n for n, _ in strata[LANGUAGES:]), sum((s for _, s in strata[LANGUAGES:]), ()))] if strata[LANGUAGES:] else [])]
    while len(strata) > 1:
        strata.sort(reverse=True)
        if within_risk(0, strata[-1][0], risk, delta / (len(strata) * len(RULES))):
            break
        (n, one), (m, other) = strata.pop(), strata.pop()
        strata.append((n + m, tuple(sorted(one + other))))
    return [s for _, s in sorted(strata, reverse=True)]


@dataclass(frozen=True)
class Thresholds:
    """The cutoff per pool of strata and rule; a pair that is missing has none."""

    cutoffs: dict[tuple[tuple[str, ...], str], float]

    def rejects(self) -> Column:
        """Whether some rule rejects the row of ``statistics``."""
        test = F.lit(False)
        for (pool, rule), cutoff in sorted(self.cutoffs.items()):
            test = test | (F.col("stratum").isin(*pool) & (F.col(rule) > cutoff))
        return test


def calibrate(stats: DataFrame, labels: DataFrame, risk: float = RISK, delta: float = DELTA) -> Thresholds:
    """Thresholds from all labelled rows of ``stats``.

    ``labels`` needs doc_id and quality; rows with a null in either are left out, and a document labelled both ways
    counts as good. What comes to the driver is one count per labelled language, rule and cutoff. A language without
    labels has no cutoffs.
    """
    marks = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    known = stats.join(marks, "doc_id")
    # how many cutoffs, from the lenient end, a row stays under: the rest reject it
    def passed(rule: str) -> Column:
        cuts = F.array(*(F.lit(float(c)) for c in RULES[rule]))
        return F.struct(F.lit(rule).alias("rule"), F.size(F.filter(cuts, lambda c: c >= F.col(rule))).alias("passed"))

    each = known.select("stratum", (F.col("quality") >= 1).alias("good"), F.explode(F.array(*map(passed, RULES))).alias("at"))
    counts = each.groupBy("stratum", "good", "at.rule", "at.passed").count().collect()
    any_rule = next(iter(RULES))
    good_documents: Counter = Counter({r["stratum"]: 0 for r in counts})
    for r in counts:
        if r["good"] and r["rule"] == any_rule:
            good_documents[r["stratum"]] += r["count"]
    strata = pools(good_documents, risk, delta)
    pool_of = {s: pool for pool in strata for s in pool}
    sizes: Counter = Counter()
    for r in counts:
        pool = pool_of[r["stratum"]]
        for k in range(r["passed"], len(RULES[r["rule"]])):
            sizes[pool, r["good"], r["rule"], k] += r["count"]
        sizes[pool, r["good"], r["rule"]] += r["count"]
    error = delta / (max(1, len(strata)) * len(RULES))
    cutoffs = {}
    for pool in strata:
        for rule, cuts in RULES.items():
            good, bad = sizes[pool, True, rule], sizes[pool, False, rule]
            best = 0.0
            for k, cutoff in enumerate(cuts):
                lost = sizes[pool, True, rule, k]
                if not bad or not within_risk(lost, good, risk, error):
                    break
                gain = sizes[pool, False, rule, k] / bad - COST * lost / good
                if gain > best:
                    best, cutoffs[pool, rule] = gain, cutoff
    return Thresholds(cutoffs)


def judge(docs: DataFrame, labels: DataFrame, risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """``statistics`` of every row with ``base_failed`` and ``kept``.

    ``docs`` needs doc_id and text; lang, if there, chooses the stratum. A null text has no words. Repeated rows and null
    ids are judged each. Without labels, or with too few of them to certify a cutoff, only the base rules reject. An
    empty table gives an empty result.
    """
    stats = stored(statistics(docs), "rule-statistics")
    chosen = calibrate(stats, labels, risk, delta)
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return stats.withColumn("base_failed", failed).withColumn("kept", ~(failed | chosen.rejects()))

