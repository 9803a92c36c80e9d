"""Quality rules of documents and of their hosts, in column expressions only.

Per text: counts of its words, symbols, repeated lines and repeated word windows. Per
host: how often its documents fail each rule, shrunk towards all hosts by an empirical
beta prior, so that a host with few documents is not judged by one of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmill.operators.lookups import join_large
from starmill.sources.scratch import written

WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
MAX_SYMBOL_PERCENT = 10
MAX_LINE_PERCENT = 30
# A host is rejected once the lower end of the 95 % interval of its rate of failure, by the
# posterior of some rule, lies above this.
MAX_HOST_RATE, DEVIATIONS = 0.25, 1.96
# Failures that a host is judged by.
HOST_RULES = ["base", "symbols", "lines"]
_SPACE = r"[ \t\n\x0B\f\r]"


def bind(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often it is used inside."""
    return F.transform(F.array(value), use)[0]


def words_of(text: Column) -> Column:
    """Runs of characters other than the six ASCII spaces, in order."""
    return F.filter(F.split(text, _SPACE + "+"), lambda w: w != "")


def _windows(words: Column) -> Column:
    """One hash per window of five consecutive words."""
    hashes = F.transform(words, lambda w: F.xxhash64(w))

    def each(h: Column) -> Column:
        last = F.size(h) - WINDOW
        at = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(
            F.array().cast("array<int>")
        )
        return F.transform(at, lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(WINDOW)]))

    return bind(hashes, each)


def _is_repeated(windows: Column) -> Column:
    """Whether any window hash occurs twice."""
    return F.size(F.array_distinct(windows)) < F.size(windows)


def _covered(windows: Column) -> Column:
    """Words within windows that occur twice or more: sort by hash, keep the places of
    equal neighbours, and add up the stretches they cover."""
    placed = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def repeated(p: Column) -> Column:
        def has_equal(x: Column, i: Column) -> Column:
            before = (i > 0) & (F.get(p, i - 1)["h"] == x["h"])
            after = (i < F.size(p) - 1) & (F.get(p, i + 1)["h"] == x["h"])
            return before | after

        return F.sort_array(F.transform(F.filter(p, has_equal), lambda x: x["i"]))

    def covered(at: Column) -> Column:
        gaps = F.transform(
            at, lambda x, i: F.least(F.lit(WINDOW), F.coalesce(F.get(at, i + 1) - x, F.lit(WINDOW)))
        )
        return F.aggregate(gaps, F.lit(0), lambda total, gap: total + gap)

    return bind(bind(placed, repeated), covered)


def measure(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """Add n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words (all bigint).

    A null text counts as empty: every count is 0. Works row by row, without a shuffle.
    """
    text = F.coalesce(F.col(f"`{text_column}`").cast("string"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda line: F.trim(F.translate(line, "\t\x0b\f\r", "    ")) != "")
    counts = docs.withColumn("__words", words_of(text)).withColumn("__lines", lines)
    counts = counts.withColumn("__windows", _windows(F.col("__words")))
    counts = counts.withColumns(
        {
            "n_words": F.size("__words").cast("bigint"),
            "word_chars": F.length(F.array_join("__words", "")).cast("bigint"),
            "n_symbols": F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("bigint"),
            "n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("bigint"),
            "n_repeat_words": F.when(
                _is_repeated(F.col("__windows")), _covered(F.col("__windows"))
            )
            .otherwise(0)
            .cast("bigint"),
            "n_lines": F.size("__lines").cast("bigint"),
        }
    )
    return counts.drop("__words", "__lines", "__windows")


def failures() -> dict[str, Column]:
    """The rules on measured counts; true where a document fails."""
    return {
        "base": (F.col("n_words") < MIN_WORDS)
        | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")),
        "symbols": 100 * F.col("n_symbols") > MAX_SYMBOL_PERCENT * F.col("word_chars"),
        "lines": 100 * F.col("n_dup_lines") > MAX_LINE_PERCENT * F.col("n_lines"),
    }


def host_rates(measured: DataFrame, host: str) -> DataFrame:
    """Per host its documents and, per rule, the shrunk rate of failure and its lower end.

    The beta prior of a rule has the mean rate of all hosts and a strength by moments:
    the closer hosts agree, the more documents a host needs to be judged apart. ``low`` is the
    rate less the deviations of its posterior, so a host with few documents is given the
    benefit of the doubt. One row per host is grouped; the prior is one row.
    """
    counts = measured.filter(F.col(host).isNotNull()).groupBy(host)
    counts = counts.agg(
        F.count("*").alias("n_docs"),
        *[F.count_if(failed).alias(f"failed_{rule}") for rule, failed in failures().items()],
    )
    moments = []
    for rule in HOST_RULES:
        rate = F.col(f"failed_{rule}") / F.col("n_docs")
        moments += [
            F.avg(rate).alias(f"mean_{rule}"),
            F.coalesce(F.var_samp(rate), F.lit(0.0)).alias(f"var_{rule}"),
        ]
    prior = counts.agg(*moments)
    rates = counts.join(F.broadcast(prior))  # one row
    for rule in HOST_RULES:
        mean, var = F.col(f"mean_{rule}"), F.col(f"var_{rule}")
        strength = F.when(
            var > 0, F.greatest(F.lit(1.0), mean * (1 - mean) / var - 1)
        ).otherwise(F.lit(100.0))
        weight = F.col("n_docs") + strength
        rates = rates.withColumn(f"rate_{rule}", (F.col(f"failed_{rule}") + strength * mean) / weight)
        rate = F.col(f"rate_{rule}")
        spread = F.sqrt(rate * (1 - rate) / (weight + 1))
        rates = rates.withColumn(f"low_{rule}", rate - DEVIATIONS * spread)
    return rates.select(host, "n_docs", *[f"{kind}_{rule}" for kind in ("rate", "low") for rule in HOST_RULES])


def judge(
    docs: DataFrame, host: str = "source", text_column: str = "text", keep: tuple[str, ...] = ("doc_id",)
) -> DataFrame:
    """The columns ``keep`` with counts, failures, host rates, ``host_kept`` and ``kept``.

    A document is kept unless it fails the base rule (under ten words, or over a fifth of
    them in repeated windows) or stands on a rejected host: one of which, by the posterior of
    some rule, more than a quarter of the documents fail. ``symbols_failed`` and
    ``lines_failed`` tell of the document what else its host is judged by. A document
    without a host has no verdict but its own. Repeated rows are judged alike; no rows give
    no rows. The counts are written once; host rates are joined back to narrow rows, those
    of a host with most documents spread where the rates are beyond broadcast.
    """
    picked = {f"__keep_{i}": F.col(f"`{c}`") for i, c in enumerate(keep)}
    narrow = docs.select(
        *[c.alias(n) for n, c in picked.items()],
        F.col(f"`{host}`").cast("string").alias("__host"),
        F.col(f"`{text_column}`").alias("__text"),
    )
    measured = written(measure(narrow, "__text").drop("__text"), "measured")
    rates = host_rates(measured, "__host").withColumnRenamed("__host", "__rated")
    joined = join_large(measured, rates, "__host", "__rated")
    worst = F.greatest(*[F.coalesce(f"low_{r}", F.lit(0.0)) for r in HOST_RULES])
    found, host_kept = failures(), worst <= MAX_HOST_RATE
    return joined.select(
        *[F.col(n).alias(c) for n, c in zip(picked, keep)],
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        *[found[rule].alias(f"{rule}_failed") for rule in HOST_RULES],
        *[F.coalesce(f"rate_{r}", F.lit(0.0)).alias(f"host_rate_{r}") for r in HOST_RULES],
        host_kept.alias("host_kept"),
        (~found["base"] & host_kept).alias("kept"),
    )
