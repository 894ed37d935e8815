"""Quality rules with risk-controlled cutoffs. Native: DataFrame functions only.

Every rule rejects documents whose statistic lies beyond a cutoff. Cutoffs are selected per stratum (language) on
labelled documents: a cutoff is admissible if the exact one-sided binomial (Clopper-Pearson) test shows that it
rejects less than ``risk / rules`` of the good documents of the stratum, at confidence ``1 - delta`` after a Bonferroni
correction over all strata, rules and cutoffs tested. Of the admissible cutoffs the strictest is taken; where none is
admissible, the rule is off. So with probability 1 - delta, no stratum loses more than ``risk`` of its good documents
to the rules.

NULL texts count as empty, a NULL stratum is a stratum of its own, documents without a label are only judged, labels of
unknown documents are ignored, and a document labelled more than once is good if any label says so.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellsurvey.llm.common import own_columns, words_of
from cellsurvey.session import durable

_SYMBOLS = "#*$%&|<>"
_WHITE = " \t\n\x0b\x0c\r"

#: rule -> (numerator, denominator, cutoffs from the strictest on): rejected if numerator > cutoff * denominator
RULES: dict[str, tuple[str, str, tuple[float, ...]]] = {
    "symbols": ("n_symbols", "n_words", (0.02, 0.05, 0.1, 0.2, 0.3, 0.5, 0.75, 1.0, 1.5, 2.0)),
    "dup_lines": ("n_dup_lines", "n_lines", (0.02, 0.05, 0.1, 0.15, 0.2, 0.3, 0.4, 0.5, 0.7, 0.9)),
    "repeats": ("n_repeat_words", "n_words", (0.02, 0.05, 0.1, 0.15, 0.2, 0.25, 0.3, 0.35, 0.4, 0.45)),
    "long_words": ("word_chars", "n_words", (6.0, 7.0, 8.0, 9.0, 10.0, 12.0, 15.0, 20.0, 30.0, 50.0)),
}


def repeated_words(words: Column) -> Column:
    """Words inside 3-word windows that occur twice or more in the text, the first occurrence included.

    Windows are sorted by hash with their place; those with an equal neighbour are repeated. Each covers three words, or
    as many as lie before the next repeated window.
    """
    window = F.transform(
        F.sequence(F.lit(1), F.size(words) - 2),
        lambda i: F.struct(
            F.xxhash64(F.element_at(words, i), F.element_at(words, i + 1), F.element_at(words, i + 2)).alias("h"),
            i.alias("i")),
    )
    ordered = F.array_sort(window)
    h = lambda a, i: F.get(a, i)["h"]
    places = lambda a: F.array_sort(F.transform(
        F.filter(
            F.transform(a, lambda x, i: F.struct(
                x["i"].alias("i"),
                (F.coalesce(x["h"] == h(a, i - 1), F.lit(False)) | F.coalesce(x["h"] == h(a, i + 1), F.lit(False))).alias("twice"))),
            lambda x: x["twice"]),
        lambda x: x["i"]))
    covered = lambda p: F.aggregate(
        F.transform(p, lambda x, i: F.least(F.lit(3), F.coalesce(F.get(p, i + 1) - x, F.lit(3)))),
        F.lit(0).cast("bigint"), lambda s, x: s + x)
    # transform over one-element arrays binds an intermediate, so that it is evaluated once
    bound = F.transform(F.array(ordered), lambda a: F.get(F.transform(F.array(places(a)), covered), 0))
    return F.when(F.size(words) >= 4, F.get(bound, 0)).otherwise(F.lit(0).cast("bigint"))


def statistics(docs: DataFrame) -> DataFrame:
    """(doc_id, lang, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words) of every document."""
    text = F.coalesce(F.col("text"), F.lit(""))
    count = lambda chars: F.length(text) - F.length(F.translate(text, chars, ""))
    lines = lambda t: F.filter(F.split(t, "\n", -1), lambda x: F.trim(F.translate(x, _WHITE, "")) != "")
    read = own_columns(docs, "doc_id", "lang", "text").select(
        "doc_id", "lang",
        F.length(F.translate(text, _WHITE, "")).cast("bigint").alias("word_chars"),
        count(_SYMBOLS).cast("bigint").alias("n_symbols"),
        F.get(F.transform(F.array(lines(text)), lambda a: F.struct(
            F.size(a).cast("bigint").alias("n"), (F.size(a) - F.size(F.array_distinct(a))).cast("bigint").alias("dup"))), 0).alias("l"),
        F.get(F.transform(F.array(words_of(text)), lambda w: F.struct(
            F.size(w).cast("bigint").alias("n"), repeated_words(w).alias("rep"))), 0).alias("w"),
    )
    return read.select(
        "doc_id", "lang", F.col("w.n").alias("n_words"), "word_chars", "n_symbols", F.col("l.n").alias("n_lines"),
        F.col("l.dup").alias("n_dup_lines"), F.col("w.rep").alias("n_repeat_words"),
    )


def _log_gamma(x: Column) -> Column:
    """Stirling's series after a shift by 8; the error is below 1e-12 for x >= 1."""
    shift = F.lit(0.0)
    for i in range(8):
        shift = shift + F.log(x + i)
    y = x + 8
    series = 1 / (12 * y) - 1 / (360 * F.pow(y, F.lit(3))) + 1 / (1260 * F.pow(y, F.lit(5))) - 1 / (1680 * F.pow(y, F.lit(7)))
    return (y - 0.5) * F.log(y) - y + 0.5 * math.log(2 * math.pi) + series - shift


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P(X <= k) for X ~ Bin(n, p), summed downwards from k.

    Terms shrink geometrically below the mean. Those more than 12 standard deviations below k are left out; they are
    less than 1e-30 of the sum.
    """
    n, k = n.cast("double"), k.cast("double")
    top = F.exp(
        _log_gamma(n + 1) - _log_gamma(k + 1) - _log_gamma(n - k + 1)
        + k * math.log(p) + (n - k) * math.log1p(-p))
    steps = F.least(k, F.ceil(12 * F.sqrt(n)) + 60).cast("int")
    # state: (sum, term); term(i-1) = term(i) * i / (n-i+1) * (1-p)/p
    total = F.aggregate(
        F.sequence(F.lit(0), steps),
        F.struct(F.lit(0.0).alias("s"), F.lit(1.0).alias("t")),
        lambda a, i: F.struct(
            (a["s"] + a["t"]).alias("s"),
            (a["t"] * (k - i) / (n - k + i + 1) * ((1 - p) / p)).alias("t")),
        lambda a: a["s"])
    return F.when(k >= n * p, F.lit(1.0)).otherwise(top * total)


def select_cutoffs(labelled: DataFrame, risk: float = 0.02, delta: float = 0.05) -> DataFrame:
    """(lang, rule, cutoff, n_good, n_rejected): the strictest admissible cutoff per stratum and rule.

    ``labelled``: statistics with ``quality``. All counts come from one aggregation with map-side sums.
    """
    beyond = {
        (rule, i): F.sum((F.col(num) > cut * F.col(den)).cast("bigint")).alias(f"{rule}_{i}")
        for rule, (num, den, cuts) in RULES.items() for i, cut in enumerate(cuts)
    }
    good = labelled.filter(F.col("quality") == 1).groupBy("lang").agg(F.count(F.lit(1)).alias("n_good"), *beyond.values())
    tests = F.explode(F.array(*[
        F.struct(F.lit(rule).alias("rule"), F.lit(RULES[rule][2][i]).alias("cutoff"), F.col(f"{rule}_{i}").alias("n_rejected"))
        for rule, i in beyond
    ])).alias("t")
    # few rows: strata x rules x cutoffs; written so that the number of strata is that of the very same rows
    rows = durable(good.select("lang", "n_good", tests).select("lang", "n_good", "t.*"))
    strata = rows.agg(F.greatest(F.count_distinct(F.coalesce("lang", F.lit("\0"))), F.lit(1))).scalar()
    tail = binomial_tail(F.col("n_rejected"), F.col("n_good"), risk / len(RULES))
    return (
        rows.withColumn("p_value", tail)
        .filter(F.col("p_value") * strata * len(beyond) <= delta)
        .groupBy("lang", "rule")
        .agg(F.min_by(F.struct("cutoff", "n_good", "n_rejected", "p_value"), "cutoff").alias("c"))
        .select("lang", "rule", "c.*")
    )


def judge(docs: DataFrame, labels: DataFrame, risk: float = 0.02, delta: float = 0.05) -> DataFrame:
    """Statistics of every document, the contract's base rule, the rules that reject it, and ``kept``."""
    stats = durable(statistics(docs))
    quality = own_columns(labels, "doc_id", "quality").filter("doc_id is not null").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    base_failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    # the rules only judge what the base rule lets pass, so they are selected on that
    cutoffs = select_cutoffs(stats.filter(~base_failed).join(quality, "doc_id"), risk, delta)
    wide = durable(cutoffs.groupBy(F.coalesce("lang", F.lit("\0")).alias("stratum")).agg(
        *[F.max(F.when(F.col("rule") == rule, F.col("cutoff"))).alias(f"cut_{rule}") for rule in RULES]))
    failed = F.array_compact(F.array(*[
        F.when(F.col(num) > F.col(f"cut_{rule}") * F.col(den), F.lit(rule)) for rule, (num, den, _) in RULES.items()]))
    return (
        stats.withColumn("stratum", F.coalesce("lang", F.lit("\0")))
        .join(wide, "stratum", "left")
        .withColumn("base_failed", base_failed)
        .withColumn("failed_rules", failed)
        .withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0))
        .select(
            "doc_id", "lang", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
            F.concat_ws(",", "failed_rules").alias("failed_rules"), *[f"cut_{rule}" for rule in RULES])
    )
