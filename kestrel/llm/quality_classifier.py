"""Quality by hierarchical empirical Bayes: document evidence plus what its site is like.

1. A logistic classifier on a few measures of the text gives every document a
   probability; it is fitted on a bounded sample of labelled documents
   (``max_train``, by a hash of the id).
2. Grouped aggregation sums those probabilities by host and by path below it.
   Moment estimates say how much hosts differ from each other and paths from
   their host; a host's mean is shrunk toward the global mean, a path's mean
   toward its host, the more so the fewer documents there are.
3. The posterior of a document combines its own evidence with the prior its
   path gives (without the document itself).

``documents`` names its site in ``source``; ``lang`` stands for the path.

Defined results: NULL and empty texts are judged by their (zero) measures; a
NULL host or path is a site of its own; repeated rows count as often as they
occur; an empty table gives an empty result; without labels of both kinds the
classifier is neutral and everything is kept.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kestrel.llm.common import SPACE_CLASS
from kestrel.operators.joins import broadcast_if_bounded
from kestrel.session import materialize

MAX_TRAIN = 20_000
KEEP_AT = 0.5
#: Sites whose statistics may be broadcast (four numbers each); beyond it the join shuffles.
MOST_BROADCAST_SITES = 200_000
#: A site's own documents move its prior by this factor at most either way.
PRIOR_ODDS_LIMIT = 20.0

FEATURES = ("log_words", "symbols", "shouted", "variety", "doubled", "word_length",
            "sentences", "dup_lines", "digits")


def with_features(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with one array column ``_x`` of the classifier's measures."""
    t = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    rows = docs.withColumn("_t", t).withColumns({
        "_w": F.array_remove(F.split("_t", SPACE_CLASS + "+"), ""),
        "_l": F.split("_t", "\n")})
    n = F.greatest(F.size("_w"), F.lit(1)).cast("double")
    x = [F.log1p(F.size("_w").cast("double")),
         F.regexp_count("_t", F.lit(r"[#*$%&|<>]")) / n,
         F.regexp_count("_t", F.lit(r"\p{Lu}{2,}")) / n,
         F.size(F.array_distinct("_w")) / n,
         F.regexp_count("_t", F.lit(r"(?<!\S)(\S{2,}+) \1(?!\S)")) / n,
         F.length(F.array_join("_w", "")) / n,
         F.regexp_count("_t", F.lit(r"[.!?][\x20\x09-\x0D]|[.!?]$")) / n,
         (F.size("_l") - F.size(F.array_distinct("_l"))) / F.size("_l"),
         F.regexp_count("_t", F.lit(r"[0-9]")) / n]
    # a generator keeps the planner from copying the measures into later filters
    return (rows.select("*", F.explode(F.array(F.array(*[c.cast("double") for c in x]))).alias("_x"))
            .drop("_t", "_w", "_l"))


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 50
                 ) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Newton steps for a ridge logistic regression: (mean, scale, weights, intercept)."""
    mean, scale = x.mean(0), x.std(0) + 1e-9
    z = np.hstack([(x - mean) / scale, np.ones((len(x), 1))])
    w = np.zeros(z.shape[1])
    pull = np.full(z.shape[1], ridge)
    pull[-1] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        h = (z * (p * (1 - p) + 1e-9)[:, None]).T @ z + np.diag(pull)
        step = np.linalg.solve(h, z.T @ (y - p) - pull * w)
        w += np.clip(step, -3, 3)
        if np.abs(step).max() < 1e-6:
            break
    return mean, scale, w[:-1], float(w[-1])


def train(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN, id_col: str = "doc_id",
          text_col: str = "text") -> tuple[Column, float]:
    """(probability of good quality over ``_x``, share of good labels in the sample)."""
    good = labels.select(F.col("doc_id").alias("_lid"), F.col("quality").alias("_good"))
    sample = (good.filter("_lid IS NOT NULL AND _good IS NOT NULL")
              .orderBy(F.xxhash64("_lid"), "_lid").limit(max_train))
    rows = with_features(docs.join(F.broadcast(sample), F.col(f"`{id_col}`") == F.col("_lid"))
                         .select(F.col(f"`{text_col}`"), "_good"), text_col)
    table = rows.select("_x", "_good").toPandas()  # max_train rows at most
    y = table["_good"].to_numpy(float)
    if len(set(y)) < 2:
        return F.lit(0.5), 0.5
    mean, scale, w, b = fit_logistic(np.array(table["_x"].tolist()), y)
    eta = F.lit(float(b - (w * mean / scale).sum()))
    for i, c in enumerate(w / scale):
        eta = eta + F.lit(float(c)) * F.get("_x", F.lit(i))
    return 1 / (1 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), eta)))), float(y.mean())


def _strength(groups: DataFrame, mean: Column, within: Column) -> float:
    """Pseudo-count of the parent: within-group variance over the variance between groups.

    Moment estimate over groups of two or more documents: a group mean varies
    by ``between + within / n``.
    """
    got = (groups.filter("n > 1").agg(
        F.sum(F.col("n") * F.pow(mean, 2)).alias("spread"), F.sum("n").alias("n"),
        F.count("*").alias("k"), F.sum(F.col("n") * within).alias("w"))).first()
    if not got["n"] or got["k"] < 2:
        return 10.0
    w = max(1e-6, got["w"] / got["n"])
    between = max(0.0, got["spread"] / got["n"] - got["k"] * w / got["n"])
    return float(min(1e6, max(1.0, w / max(between, 1e-9))))


def site_priors(scored: DataFrame, host_col: str, path_col: str) -> DataFrame:
    """Per (host, path): n, s (sum of probabilities), host_prob and the strength of the host's pull."""
    sites = materialize(scored.groupBy(F.col(f"`{host_col}`").alias("_host"),
                                       F.col(f"`{path_col}`").alias("_path"))
                        .agg(F.count("*").alias("n"), F.sum("_p").alias("s"),
                             F.sum(F.col("_p") * F.col("_p")).alias("ss")), "quality-sites")
    total = sites.agg(F.sum("n").alias("n"), F.sum("s").alias("s")).first()
    mu = min(1 - 1e-6, max(1e-6, (total["s"] or 0.0) / (total["n"] or 1)))
    within = F.greatest(F.lit(0.0), F.col("ss") / F.col("n") - F.pow(F.col("s") / F.col("n"), 2))
    hosts = sites.groupBy("_host").agg(F.sum("n").alias("n"), F.sum("s").alias("s"),
                                       F.sum("ss").alias("ss"))
    m_host = _strength(hosts, F.col("s") / F.col("n") - mu, within)
    hosts = hosts.select(F.col("_host").alias("_h"),
                         ((F.col("s") + m_host * mu) / (F.col("n") + m_host)).alias("host_prob"))
    both = sites.join(hosts, F.col("_host").eqNullSafe(F.col("_h"))).drop("_h")
    m_path = _strength(both, F.col("s") / F.col("n") - F.col("host_prob"), within)
    return both.select("_host", "_path", "n", "s", "host_prob", F.lit(m_path).alias("m"),
                       F.lit(mu).alias("mu"))


def score(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN, id_col: str = "doc_id",
          text_col: str = "text", host_col: str = "source", path_col: str = "lang",
          keep_at: float = KEEP_AT) -> DataFrame:
    """``docs`` with classifier_prob, host_prob, path_prob, quality_prob and quality_kept."""
    own = ("classifier_prob", "host_prob", "path_prob", "quality_prob", "quality_kept")
    prob, _ = train(docs, labels, max_train, id_col, text_col)
    named = docs.drop(*own)
    scored = with_features(named, text_col).withColumn("_p", prob).drop("_x")
    sites = site_priors(scored.select(F.col(f"`{host_col}`"), F.col(f"`{path_col}`"), "_p"),
                        host_col, path_col)
    sites = broadcast_if_bounded(materialize(sites, "quality-priors"), MOST_BROADCAST_SITES)
    rows = scored.join(sites, F.col(f"`{host_col}`").eqNullSafe(F.col("_host"))
                       & F.col(f"`{path_col}`").eqNullSafe(F.col("_path")))
    safe = lambda c: F.greatest(F.lit(1e-9), F.least(F.lit(1 - 1e-9), c))
    logit = lambda c: F.log(c / (1 - c))
    path = safe((F.col("s") - F.col("_p") + F.col("m") * F.col("host_prob"))
                / (F.col("n") - 1 + F.col("m")))
    limit = float(np.log(PRIOR_ODDS_LIMIT))
    shift = F.greatest(F.lit(-limit), F.least(F.lit(limit),
                                              logit(F.col("path_prob")) - logit(safe(F.col("mu")))))
    rows = rows.withColumn("path_prob", path)
    rows = rows.withColumn("quality_prob", 1 / (1 + F.exp(-(logit(safe(F.col("_p"))) + shift))))
    return (rows.withColumnRenamed("_p", "classifier_prob")
            .withColumn("quality_kept", F.col("quality_prob") >= keep_at)
            .drop("_host", "_path", "n", "s", "m", "mu"))
