"""Model queries (M*) over the classifier view (64 features, binary label, group)."""

from __future__ import annotations

from math import lgamma, log, pi

from pyspark.sql import functions as F

from tidemark.ml import models as md
from tidemark.ml.split import group_split
from tidemark.registry import register
from tidemark.sources import testviews as tv
from tidemark.sources.testviews import VIEW_SQL


def W(parts):
    return "WITH " + ",\n".join(parts)


C = [VIEW_SQL["clf"]]


def _clf(spark, d):
    return tv.classifier(spark, d)


@register("m2_group_split", W(C) + """
SELECT grp, CASE WHEN r <= ceil(n * 0.3) THEN 'test' ELSE 'train' END AS split FROM (
  SELECT grp, row_number() OVER (ORDER BY md5('7' || CAST(grp AS VARCHAR)), grp) AS r, count(*) OVER () AS n
  FROM (SELECT DISTINCT grp FROM clf))""")
def m2_group_split(spark, d):
    """M2: 30% of groups (ceil) to test, chosen by rank of md5(seed || group)."""
    return group_split(_clf(spark, d), "grp", seed=7)


@register("m3_row_split", W(C) + """
SELECT row_id, CASE WHEN row_number() OVER (ORDER BY row_id) <= floor(count(*) OVER () * 0.8) THEN 'train' ELSE 'test' END AS split FROM clf""")
def m3_row_split(spark, d):
    """M3: first 80% of rows in order -> train."""
    return md.row_split(_clf(spark, d), "row_id").select("row_id", "split")


@register("m4_timeseries_folds", W(C) + """
SELECT row_id, CAST(k AS BIGINT) AS fold, role FROM (
  SELECT row_id, k, CASE WHEN i < n - (5 - k) * (n // 6) THEN 'train' WHEN i < n - (5 - k) * (n // 6) + n // 6 THEN 'test' END AS role
  FROM (SELECT row_id, row_number() OVER (ORDER BY row_id) - 1 AS i, count(*) OVER () AS n FROM clf), range(5) f(k))
WHERE role IS NOT NULL""")
def m4_timeseries_folds(spark, d):
    """M4: expanding time-series CV, 5 folds, test size n div 6."""
    return md.tail_split_folds(_clf(spark, d), "row_id")


@register("m5_standardize_stats", W(C) + """
SELECT CAST(pos AS BIGINT) AS pos, round(avg(v), 9) AS mean,
       round(CASE WHEN stddev_pop(v) = 0 THEN 1 ELSE stddev_pop(v) END, 9) AS std
FROM (SELECT unnest(range(len(features))) AS pos, unnest(features) AS v FROM clf) GROUP BY pos""", ["mean", "std"])
def m5_standardize_stats(spark, d):
    """M5: per-feature mean and population std (zero std -> 1)."""
    return md.feature_stats(_clf(spark, d))


@register("m6_feature_assembly", None)
def m6_feature_assembly(spark, d):
    """M6: standardised feature arrays assembled into ML vectors."""
    c = _clf(spark, d)
    s = md.standardize(c, md.feature_stats(c))
    from pyspark.ml.functions import array_to_vector
    return s.select("row_id", array_to_vector("features").alias("fv"), "y").select("row_id", F.col("fv").cast("string").alias("fv"), "y")


@register("m7_logistic_coefficients", None)
def m7_logistic_coefficients(spark, d):
    """M7 + T5: L2 logistic regression (C = 1) on standardised features; coefficients by |weight|."""
    c = _clf(spark, d)
    s = md.standardize(c, md.feature_stats(c))
    coefs = md.coefficients_table(md.logistic_fit(s, 1.0), spark)
    return coefs.orderBy(F.abs("coef").desc(), "pos")


@register("m8_c_grid_cv", None)
def m8_c_grid_cv(spark, d):
    """M8: 30 values of C scored by time-series CV negative log loss; the best is marked."""
    c = _clf(spark, d)
    s = md.standardize(c, md.feature_stats(c))
    return md.cv_grid(s, md.C_GRID, md.tail_split_folds(s, "row_id"))[0]


@register("m8_best_refit", None)
def m8_best_refit(spark, d):
    """M8: parameters of the best C, refitted on all rows (pos -1 = intercept)."""
    c = _clf(spark, d)
    s = md.standardize(c, md.feature_stats(c))
    theta = md.cv_grid(s, md.C_GRID, md.tail_split_folds(s, "row_id"))[1]
    return spark.createDataFrame([(i - 1, float(v)) for i, v in enumerate(theta)], "pos long, coef double")


@register("m3_tail_split", W(C) + """
SELECT row_id, CASE WHEN l <= 240 THEN 'test' WHEN l <= 420 THEN 'val' WHEN l <= 900 THEN 'train' END AS split
FROM (SELECT row_id, row_number() OVER (ORDER BY row_id DESC) AS l FROM clf)""")
def m3_tail_split(spark, d):
    """M3, time-series form: 480 / 180 / 240 last rows."""
    return md.tail_split(_clf(spark, d), "row_id").select("row_id", "split")


@register("m9_gbt_importances", None)
def m9_gbt_importances(spark, d):
    """M9: gradient-boosted trees (300 trees, lr 0.05, depth 6, min leaf 50); feature importances."""
    m = md.gbt_fit(_clf(spark, d))
    imp = m.featureImportances.toArray()
    return spark.createDataFrame([(i, float(v)) for i, v in enumerate(imp)], "pos long, importance double")


def _theta_sql():
    return """th AS (
  SELECT CAST(0 AS DOUBLE) AS intercept, list(b ORDER BY pos) AS beta FROM (
    SELECT pos, avg(v) FILTER (WHERE y = 1) - avg(v) FILTER (WHERE y = 0) AS b
    FROM (SELECT y, unnest(range(len(features))) AS pos, unnest(features) AS v FROM clf) GROUP BY pos))"""


def _theta(c):
    x = c.select("y", F.posexplode("features").alias("pos", "v"))
    b = x.groupBy("pos").agg((F.avg(F.when(F.col("y") == 1, F.col("v"))) - F.avg(F.when(F.col("y") == 0, F.col("v")))).alias("b"))
    return b.agg(F.sort_array(F.collect_list(F.struct("pos", "b"))).alias("s")).select(
        F.lit(0.0).alias("intercept"), F.transform("s", lambda e: e["b"]).alias("beta"))


_TCONST = lgamma(2.5) - lgamma(2.0) - 0.5 * log(4 * pi) - log(10.0)
_NCONST = log(10.0 * (2 * pi) ** 0.5)


@register("m10_log_posterior", W(C + [_theta_sql()]) + f"""
SELECT round(log_lik, 6) AS log_lik, round(log_prior, 6) AS log_prior, round(log_lik + log_prior, 6) AS log_post FROM (
  SELECT sum(y * z - CASE WHEN z > 0 THEN z + ln(1 + exp(-z)) ELSE ln(1 + exp(z)) END) AS log_lik FROM (
    SELECT y, th.intercept + list_sum(list_transform(list_zip(features, th.beta), lambda p: p[1] * p[2])) AS z FROM clf, th)),
  (SELECT CAST('{_TCONST!r}' AS DOUBLE) - 2.5 * ln(1 + (intercept / 10) ^ 2 / 4)
          + list_sum(list_transform(beta, lambda b: -0.5 * (b / 10) ^ 2 - CAST('{_NCONST!r}' AS DOUBLE))) AS log_prior FROM th)""")
def m10_log_posterior(spark, d):
    """Bayesian logit log likelihood, log prior and log posterior at a data-derived theta."""
    c = _clf(spark, d)
    lp = md.log_posterior(c, _theta(c))
    return lp.select(F.round("log_lik", 6).alias("log_lik"), F.round("log_prior", 6).alias("log_prior"),
                     F.round("log_post", 6).alias("log_post"))


@register("m11_consensus_sampler", None)
def m11_consensus_sampler(spark, d):
    """Sharded Metropolis chains combined by consensus weights; draws and acceptance rate."""
    c = _clf(spark, d)
    s = md.standardize(c, md.feature_stats(c))
    return md.metropolis_consensus(s, shards=4, steps=2000, burn=500, thin=4)


_DRAWS_SQL = """dr AS (
  SELECT a.draw_id, a.intercept, b.beta FROM
    (SELECT row_id % 20 AS draw_id, avg(y) - 0.5 AS intercept FROM clf GROUP BY 1) a
  JOIN (SELECT draw_id, list(mv * 5 ORDER BY pos) AS beta FROM (
          SELECT row_id % 20 AS draw_id, pos, avg(v) AS mv FROM
            (SELECT row_id, unnest(range(len(features))) AS pos, unnest(features) AS v FROM clf) GROUP BY 1, 2) GROUP BY 1) b
  USING (draw_id))"""


@register("m12_posterior_summary", W(C + [_DRAWS_SQL]) + """
SELECT CAST(pos AS BIGINT) AS pos, round(avg(v), 9) AS mean, round(stddev_samp(v), 9) AS sd,
       round(quantile_cont(v, 0.05), 9) AS q05, round(quantile_cont(v, 0.95), 9) AS q95 FROM (
  SELECT -1 AS pos, intercept AS v FROM dr
  UNION ALL SELECT unnest(range(len(beta))) AS pos, unnest(beta) AS v FROM dr) GROUP BY pos""", ["mean", "sd", "q05", "q95"])
def m12_posterior_summary(spark, d):
    """Posterior mean, sd, q05, q95 per parameter."""
    return md.posterior_summary(md.group_mean_draws(_clf(spark, d)))


@register("m13_posterior_predictive", W(C + [_DRAWS_SQL]) + """
SELECT row_id, round(avg(p), 9) AS p_hat, round(stddev_pop(p), 9) AS p_std FROM (
  SELECT row_id, 1 / (1 + exp(-greatest(-500, least(500, dr.intercept + list_sum(list_transform(list_zip(features, dr.beta), lambda q: q[1] * q[2])))))) AS p
  FROM clf, dr) GROUP BY row_id""", ["p_hat", "p_std"])
def m13_posterior_predictive(spark, d):
    """Posterior-predictive mean and population std per row (row blocks x draw blocks)."""
    c = _clf(spark, d)
    return md.posterior_predictive(c, md.group_mean_draws(c))


@register("m14_point_model", None)
def m14_point_model(spark, d):
    """A fitted logistic model as a one-draw posterior (std 0)."""
    c = _clf(spark, d)
    m = md.logistic_fit(c, 1.0)
    draws = spark.createDataFrame([(0, float(m.intercept), [float(x) for x in m.coefficients.toArray()])],
                                  "draw_id long, intercept double, beta array<double>")
    return md.posterior_predictive(c, draws)


@register("m15_fdr_selection", None)
def m15_fdr_selection(spark, d):
    """Features selected by an F-test with FDR control, fitted on the train groups only."""
    c = _clf(spark, d)
    train = group_split(c, "grp", seed=7).where("split = 'train'")
    return md.fdr_select(c.join(train, "grp", "left_semi"))


@register("m16_regression_eval", None)
def m16_regression_eval(spark, d):
    """Regression with MSE and R^2 on held-out rows."""
    return md.regression_eval(_clf(spark, d))
