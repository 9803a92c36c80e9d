"""Quality of documents by hierarchical empirical Bayes.

Three levels of evidence: a document's own features (naive Bayes over bins), the
posterior of its path, and that of its host. A path is shrunk towards its host and a host
towards the mean of all, by beta priors fitted to the spread between groups, so sparse
sites borrow from the level above. Everything is a grouped aggregation over all labelled
documents; the classifier's model has at most 21 bins per feature.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmill.llm.rules import bind, words_of
from starmill.operators.lookups import join_large
from starmill.sources.scratch import written

BINS = 20
THRESHOLD = 0.5
FEATURES = ["variety", "symbols", "shouting", "calls", "lines"]


def _bin(share: Column) -> Column:
    return F.least(F.lit(BINS), F.floor(share * BINS)).cast("int")


def features(text: Column) -> Column:
    """Struct of binned shares of a text; one without words has bin 0 everywhere.

    Distinct words, words with runs of symbols, in capitals, with exclamation marks, and
    repeated lines, each as a share of the words or lines.
    """
    filled = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(filled, "\n"), lambda line: F.trim(line) != "")

    def binned(words: Column) -> Column:
        n = F.greatest(F.size(words), F.lit(1))
        return F.struct(
            _bin(F.size(F.array_distinct(words)) / n).alias("variety"),
            _bin(F.regexp_count(filled, F.lit(r"[#*$%&|<>]{2,}")) / n).alias("symbols"),
            _bin(F.regexp_count(filled, F.lit(r"\p{Lu}{2,}")) / n).alias("shouting"),
            _bin(F.regexp_count(filled, F.lit(r"!{2,}")) / n).alias("calls"),
            bind(
                lines,
                lambda own: _bin(
                    (F.size(own) - F.size(F.array_distinct(own))) / F.greatest(F.size(own), F.lit(1))
                ),
            ).alias("lines"),
        )

    return bind(words_of(filled), binned)


def _evidence(labelled: DataFrame) -> dict[str, dict[int, float]]:
    """Log odds that each bin of each feature adds, from counts over all labelled rows,
    smoothed by one document in all per bin. At most 105 rows reach the driver."""
    stacked = labelled.select(
        "quality", F.explode(F.array(*[F.struct(F.lit(f).alias("f"), F.col(f).alias("b")) for f in FEATURES]))
    )
    counted = stacked.groupBy("col.f", "col.b").agg(F.sum("quality"), F.count("*")).collect()
    good = {f: sum(r[2] for r in counted if r[0] == f) for f in FEATURES}
    every = {f: sum(r[3] for r in counted if r[0] == f) for f in FEATURES}
    model: dict[str, dict[int, float]] = {f: {} for f in FEATURES}
    for f, b, n_good, n in counted:
        share = good[f] / every[f] if every[f] else 0.5
        bad = every[f] - good[f]
        given_good = (n_good + share) / (good[f] + 1)
        given_bad = (n - n_good + 1 - share) / (bad + 1)
        if given_good > 0 and given_bad > 0:
            model[f][b] = math.log(given_good / given_bad)
    return model


def _strength(rate: Column, mean: Column) -> Column:
    """Prior documents by moments from the spread of group rates around their mean."""
    var = F.avg((rate - mean) * (rate - mean))
    return F.coalesce(
        F.least(F.lit(1000.0), F.greatest(F.lit(2.0), F.avg(mean * (1 - mean)) / F.nullif(var, F.lit(0.0)) - 1)),
        F.lit(1000.0),
    )


def posteriors(labelled: DataFrame) -> tuple[DataFrame, DataFrame, float]:
    """(host rates, path rates, mean): shares of good documents, shrunk level by level.

    ``labelled`` has host, path and quality (0 or 1). The prior mean of a path is its
    host's shrunk rate, that of a host the mean of all.
    """
    mean = labelled.agg((F.sum("quality") + 1) / (F.count("*") + 2)).first()[0]
    mean = 0.5 if mean is None else float(mean)
    hosts = labelled.groupBy("host").agg(F.sum("quality").alias("good"), F.count("*").alias("n"))
    strength = hosts.agg(_strength(F.col("good") / F.col("n"), F.lit(mean)).alias("m"))
    hosts = hosts.join(F.broadcast(strength)).select(
        "host", ((F.col("good") + F.col("m") * mean) / (F.col("n") + F.col("m"))).alias("host_rate")
    )
    paths = labelled.groupBy("host", "path").agg(F.sum("quality").alias("good"), F.count("*").alias("n"))
    paths = paths.join(hosts, "host")
    strength = paths.agg(_strength(F.col("good") / F.col("n"), F.col("host_rate")).alias("m"))
    paths = paths.join(F.broadcast(strength)).select(
        "host",
        "path",
        ((F.col("good") + F.col("m") * F.col("host_rate")) / (F.col("n") + F.col("m"))).alias("path_rate"),
    )
    return hosts, paths, mean


def classify(
    docs: DataFrame,
    labels: DataFrame,
    host: str = "source",
    path: str = "lang",
    id_column: str = "doc_id",
    text_column: str = "text",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Per row of ``docs``: doc_id, host, path, evidence, host_rate, path_rate, score, kept,
    and the columns ``keep``.

    ``labels`` has ``doc_id`` and ``quality``; rows without a 0 or 1 there teach nothing.
    ``score`` is the posterior probability of good quality: the log odds of the path rate
    plus the evidence of the document's features. Hosts and paths without labelled
    documents take the rate of the level above, and a null host or path is a site of its
    own, '' (as is an empty one). Without labels every score is 0.5. Repeated rows score
    alike; an id labelled twice counts twice. Documents with 0.5 or more are kept.
    """
    site = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))
    narrow = docs.select(
        F.col(f"`{id_column}`").alias("doc_id"),
        site(host).alias("host"),
        site(path).alias("path"),
        features(F.col(f"`{text_column}`")).alias("f"),
        *[F.col(f"`{c}`").alias(f"__keep_{i}") for i, c in enumerate(keep)],
    )
    kept = [f"__keep_{i}" for i in range(len(keep))]
    narrow = written(narrow.select("doc_id", "host", "path", "f.*", *kept), "features")
    marked = labels.select("doc_id", F.col("quality").cast("int")).filter("quality IN (0, 1)")
    labelled = written(narrow.join(marked, "doc_id"), "labelled")
    model = _evidence(labelled)
    hosts, paths, mean = posteriors(labelled)

    evidence = F.lit(0.0)
    for f in FEATURES:
        if model[f]:
            table = F.create_map(*[F.lit(x) for pair in sorted(model[f].items()) for x in pair])
            evidence = evidence + F.coalesce(F.element_at(table, F.col(f)), F.lit(0.0))
    # A host may hold a third of all rows, so its rows are spread where a table of rates is
    # beyond broadcast.
    named = F.concat(F.length("host"), F.lit(":"), "host", "path")
    paths = paths.select(named.alias("site_of"), "path_rate")
    located = narrow.withColumn("site", named)
    joined = join_large(located, hosts.withColumnRenamed("host", "host_of"), "host", "host_of", ["doc_id"])
    joined = join_large(joined, paths, "site", "site_of", ["doc_id"])
    host_rate = F.coalesce("host_rate", F.lit(mean))
    path_rate = F.coalesce("path_rate", host_rate)
    odds = F.log(path_rate / (1 - path_rate)) + evidence
    score = 1 / (1 + F.exp(-odds))
    return joined.select(
        "doc_id",
        "host",
        "path",
        evidence.alias("evidence"),
        host_rate.alias("host_rate"),
        path_rate.alias("path_rate"),
        score.alias("score"),
        (score >= THRESHOLD).alias("kept"),
        *[F.col(name).alias(c) for name, c in zip(kept, keep)],
    )
