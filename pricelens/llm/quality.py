"""Quality classifier with hierarchical empirical Bayes over sites.

A logistic regression on a few ratios of the text gives every document a
probability ``p_doc`` of being good. Hosts and paths (here: source, and language
within source) collect these by grouped aggregation. Each level's posterior mean
is shrunk toward the level above: a host with ``n`` documents toward the global
mean by ``k / (k + n)``, a path toward its host likewise. The prior strengths
``k`` come from the spread between sites by the method of moments. A document's
own evidence is left out of its site's posterior; the two are added as log-odds:

    logit(score) = logit(p_doc) - logit(global mean) + logit(path posterior)

Documents with a score of at least ``KEEP`` are kept. Everything but the fit is
column expressions and partial sums; a hot site is one row per task.

Defined cases: a NULL or empty text has all ratios 0; NULL source or language is
the site ``''``. Label rows without a quality are left out; several labels of a
document all count. With labels of one kind or none, the classifier is the
smoothed share of good labels for every text. Repeated rows are scored once each.
An empty table gives an empty result. Extra columns are passed through by
``keep_good`` and cannot clash with the names used here, which start with ``_``.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelens.session import stage_table

KEEP = 0.5
REG_PARAM = 1e-4
#: Bounds of the prior strengths and of a probability entering a log-odds.
STRENGTH = (1.0, 1e6)
LEAST_P = 1e-6


def features(text: Column) -> dict[str, Column]:
    """Ratios that tell prose from boilerplate, shouting, symbol runs and loops."""
    text = F.coalesce(text, F.lit(""))
    words = F.array_remove(F.split(text, r"\s+"), "")
    lines = F.split(text, "\n")
    n, size = F.greatest(F.size(words), F.lit(1)), F.greatest(F.length(text), F.lit(1))

    def share(pattern: str, of: Column) -> Column:
        return F.regexp_count(text, F.lit(pattern)) / of

    return {
        "_f_symbols": share(r"[&$#*%]{3}", n),
        "_f_shout": share(r"!!", n),
        "_f_pipes": share(r" \| ", n),
        "_f_upper": share(r"\p{Lu}", size),
        "_f_digits": share(r"\d", size),
        "_f_variety": F.log1p(F.size(F.array_distinct(words))) / F.log1p(n),
        "_f_lines": F.size(F.array_distinct(lines)) / F.greatest(F.size(lines), F.lit(1)),
        "_f_word_length": F.least(size / n, F.lit(50.0)) / 10,
    }


NAMES = ["_f_symbols", "_f_shout", "_f_pipes", "_f_upper", "_f_digits", "_f_variety", "_f_lines", "_f_word_length"]


def logit(p: Column) -> Column:
    p = F.greatest(F.least(p, F.lit(1 - LEAST_P)), F.lit(LEAST_P))
    return F.ln(p / (1 - p))


def with_features(docs: DataFrame, text_col: str = "text", host_col: str = "source", path_col: str = "lang") -> DataFrame:
    columns = features(docs[text_col]) | {
        "_host": F.coalesce(docs[host_col].cast("string"), F.lit("")),
        "_path": F.coalesce(docs[path_col].cast("string"), F.lit("")),
    }
    return docs.withColumns(columns)


def fit(featured: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> Column:
    """The classifier's probability as an expression over the feature columns."""
    known = labels.select(F.col(id_col).alias("_label_id"), F.col("quality").cast("double").alias("_y")).filter("_y is not null")
    rows = featured.join(known, F.col(id_col) == F.col("_label_id")).select("_y", *NAMES)
    rows = stage_table(rows, "quality_labels")
    good, n = rows.agg(F.coalesce(F.sum("_y"), F.lit(0.0)), F.count("*")).first()
    if good in (0, n):
        return F.lit((good + 1) / (n + 2))
    vectors = VectorAssembler(inputCols=NAMES, outputCol="_x").transform(rows).select("_x", "_y")
    model = LogisticRegression(featuresCol="_x", labelCol="_y", regParam=REG_PARAM, maxIter=50).fit(vectors)
    linear = reduce(add, [F.col(c) * float(w) for c, w in zip(NAMES, model.coefficients.toArray(), strict=True)])
    return 1 / (1 + F.exp(-(linear + float(model.intercept))))


def strength(groups: DataFrame, n: str, s: str, mean: Column) -> float:
    """Prior strength of one level by the method of moments.

    ``mean`` is the prior mean of each group. The spread of the group means beyond
    what independent draws would show is the variance of the prior.
    """
    total, spread, within, squares, count = groups.agg(
        F.sum(n),
        F.sum(F.col(n) * (F.col(s) / F.col(n) - mean) ** 2),
        F.sum(F.col(n) * mean * (1 - mean)),
        F.sum(F.col(n) * F.col(n)),
        F.count("*"),
    ).first()
    if not total or count < 2:
        return STRENGTH[1]
    pooled = within / total
    denominator = total - squares / total
    between = (spread - (count - 1) * pooled) / denominator if denominator > 0 else 0.0
    if between <= 0:
        return STRENGTH[1]
    return min(max(pooled / between - 1, STRENGTH[0]), STRENGTH[1])


def posteriors(scored: DataFrame) -> tuple[DataFrame, float]:
    """Sums per path with the host's posterior, and the global mean.

    ``scored`` holds ``_host``, ``_path`` and ``_p``. One shuffle of partial sums
    by path; hosts are summed from the paths.
    """
    paths = stage_table(scored.groupBy("_host", "_path").agg(F.count("*").alias("_n"), F.sum("_p").alias("_s")), "path_sums")
    total, good = paths.agg(F.sum("_n"), F.sum("_s")).first()
    mean = (good + 1) / (total + 2) if total else 0.5
    hosts = paths.groupBy(F.col("_host").alias("_h")).agg(F.sum("_n").alias("_hn"), F.sum("_s").alias("_hs"))
    k_host = strength(hosts, "_hn", "_hs", F.lit(mean))
    hosts = hosts.withColumn("_host_mean", (k_host * mean + F.col("_hs")) / (k_host + F.col("_hn")))
    sites = stage_table(paths.join(hosts, F.col("_host") == F.col("_h")), "site_posteriors")
    k_path = strength(sites, "_n", "_s", F.col("_host_mean"))
    return sites.select(
        F.col("_host").alias("_site_host"), F.col("_path").alias("_site_path"), "_n", "_s", "_hn", "_hs",
        F.lit(k_host).alias("_k_host"), F.lit(k_path).alias("_k_path"),
    ), mean


def score(featured: DataFrame, labels: DataFrame, id_col: str = "doc_id", narrow: DataFrame | None = None) -> DataFrame:
    """``featured`` with ``_p``, ``_host_post``, ``_path_post`` and ``_score``.

    ``narrow`` may hold the same rows' id, site and features, stored; fit and sums
    read it.
    """
    source = stage_table(featured.select(id_col, "_host", "_path", *NAMES), "quality_features") if narrow is None else narrow
    p = fit(source, labels, id_col)
    sites, mean = posteriors(source.select("_host", "_path", p.alias("_p")))
    own = featured.withColumn("_p", p)
    joined = own.join(sites, (F.col("_host") == F.col("_site_host")) & (F.col("_path") == F.col("_site_path")))
    host = (F.col("_k_host") * mean + F.col("_hs") - F.col("_p")) / (F.col("_k_host") + F.col("_hn") - 1)
    path = (F.col("_k_path") * F.col("_host_post") + F.col("_s") - F.col("_p")) / (F.col("_k_path") + F.col("_n") - 1)
    joined = joined.withColumn("_host_post", host).withColumn("_path_post", path)
    odds = logit(F.col("_p")) - logit(F.lit(mean)) + logit(F.col("_path_post"))
    return joined.withColumn("_score", 1 / (1 + F.exp(-odds)))


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: classifier, site posteriors, score and decision."""
    featured = stage_table(with_features(docs).select("doc_id", "_host", "_path", *NAMES), "quality_features")
    return score(featured, labels, narrow=featured).select(
        "doc_id",
        F.col("_p").alias("p_doc"),
        F.col("_host_post").alias("host_posterior"),
        F.col("_path_post").alias("path_posterior"),
        F.col("_score").alias("score"),
        (F.col("_score") >= KEEP).alias("keep"),
    )


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents with a score of at least ``KEEP``, with all their columns."""
    return score(with_features(docs), labels).filter(F.col("_score") >= KEEP).select(*docs.columns)
