"""Evaluation and threshold-sweep queries (E1–E12) over the scored-tick view."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import evaluate as ev
from tidemark.registry import register
from tidemark.sources import testviews as tv
from tidemark.sources.testviews import VIEW_SQL


def W(parts):
    return "WITH " + ",\n".join(parts)


def dlist(vals) -> str:
    """A DuckDB DOUBLE[] literal holding exactly these Python floats."""
    return "[" + ", ".join(f"CAST('{v!r}' AS DOUBLE)" for v in vals) + "]"


T = [VIEW_SQL["ticks"]]


@register("e1_confusion", W(T) + """
SELECT y, CAST(p_hat > 0.5 AS BIGINT) AS pred, count(*) AS n FROM ticks GROUP BY ALL""")
def e1_confusion(spark, d):
    """Confusion counts, predicted = p > 0.5."""
    return ev.confusion(tv.ticks(spark, d))


_E2 = W(T + ["""c AS (
  SELECT count_if(y = 0 AND p_hat <= 0.5) AS n00, count_if(y = 0 AND p_hat > 0.5) AS n01,
         count_if(y = 1 AND p_hat <= 0.5) AS n10, count_if(y = 1 AND p_hat > 0.5) AS n11 FROM ticks)""",
                 """per AS (
  SELECT '0' AS label, coalesce(n00 / nullif(n00 + n10, 0), 0) AS precision, coalesce(n00 / nullif(n00 + n01, 0), 0) AS recall,
         CAST(n00 + n01 AS DOUBLE) AS support FROM c
  UNION ALL
  SELECT '1', coalesce(n11 / nullif(n11 + n01, 0), 0), coalesce(n11 / nullif(n11 + n10, 0), 0), CAST(n11 + n10 AS DOUBLE) FROM c)""",
                 """per2 AS (SELECT *, coalesce(2 * precision * recall / nullif(precision + recall, 0), 0) AS f1 FROM per)"""]) + """
SELECT label, round(precision, 9) AS precision, round(recall, 9) AS recall, round(f1, 9) AS f1, support FROM (
  SELECT label, precision, recall, f1, support FROM per2
  UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) FROM per2
  UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
                   sum(f1 * support) / sum(support), sum(support) FROM per2
  UNION ALL SELECT 'accuracy', NULL, NULL, (n00 + n11) / (n00 + n01 + n10 + n11), CAST(n00 + n01 + n10 + n11 AS DOUBLE) FROM c)"""


@register("e2_classification_report", _E2, ["precision", "recall", "f1"])
def e2_classification_report(spark, d):
    """Per-class precision / recall / F1 / support, macro and weighted averages, accuracy."""
    return ev.classification_report(tv.ticks(spark, d))


@register("e3_brier_logloss", W(T) + """
SELECT round(avg((p_hat - y) ^ 2), 9) AS brier,
       round(avg(-(y * ln(greatest(least(p_hat, 1 - 1e-15), 1e-15)) + (1 - y) * ln(1 - greatest(least(p_hat, 1 - 1e-15), 1e-15)))), 9) AS log_loss
FROM ticks""", ["brier", "log_loss"])
def e3_brier_logloss(spark, d):
    """Brier score and clipped log loss."""
    return ev.scores(tv.ticks(spark, d))


_ROC = W(T + ["""g AS (SELECT p_hat AS score, CAST(sum(y) AS DOUBLE) AS pos, CAST(sum(1 - y) AS DOUBLE) AS neg FROM ticks GROUP BY p_hat)""",
              """c AS (SELECT *, sum(pos) OVER w AS pos_cum, sum(neg) OVER w AS neg_cum, sum(pos) OVER () AS P, sum(neg) OVER () AS N
                  FROM g WINDOW w AS (ORDER BY score DESC ROWS UNBOUNDED PRECEDING))"""])


@register("e4_roc_curve", _ROC + "\nSELECT score AS threshold, round(pos_cum / P, 9) AS tpr, round(neg_cum / N, 9) AS fpr FROM c",
          ["tpr", "fpr"])
def e4_roc_curve(spark, d):
    """ROC curve, one point per distinct score (ties move together)."""
    return ev.roc(tv.ticks(spark, d))[0]


@register("e4_auc", _ROC + "\nSELECT round(sum(pos * ((N - neg_cum) + 0.5 * neg)) / (max(P) * max(N)), 9) AS auc FROM c", ["auc"])
def e4_auc(spark, d):
    """ROC AUC with ties counted half (rank-sum form)."""
    return ev.roc(tv.ticks(spark, d))[1]


_QS9 = ev.DECILE_QS[1:-1]


@register("e5_calibration_curve", W(T + [f"e AS (SELECT quantile_cont(p_hat, {dlist(_QS9)}) AS edges FROM ticks)"]) + """
SELECT CAST(len(list_filter(edges, lambda x: x < p_hat)) AS BIGINT) AS bin, round(avg(y), 9) AS prob_true,
       round(avg(p_hat), 9) AS prob_pred, count(*) AS n
FROM ticks, e GROUP BY 1""", ["prob_true", "prob_pred"])
def e5_calibration_curve(spark, d):
    """E5: quantile calibration curve, 10 bins, empty bins dropped."""
    return ev.calibration(tv.ticks(spark, d))


@register("e6_decile_accuracy", W(T + [f"e AS (SELECT quantile_cont(p_hat, {dlist(ev.DECILE_QS)}) AS edges FROM ticks)"]) + """
SELECT CAST(bin AS BIGINT) AS bin, round(avg(CAST(CAST(p_hat > 0.5 AS BIGINT) = y AS DOUBLE)), 9) AS accuracy, count(*) AS n,
       round((any_value(edges[bin + 1]) + any_value(edges[bin + 2])) / 2, 9) AS bin_mid
FROM (SELECT *, unnest(range(len(list_filter(edges[2:10], lambda x: x < p_hat)),
                             len(list_filter(edges[2:10], lambda x: x <= p_hat)) + 1)) AS bin FROM ticks, e)
GROUP BY bin""", ["accuracy", "bin_mid"])
def e6_decile_accuracy(spark, d):
    """Accuracy per quantile decile, both bin ends closed."""
    return ev.decile_accuracy(tv.ticks(spark, d))


@register("e7_hard_case_accuracy", W(T) + """
SELECT band, round(avg(CAST(CAST(p_hat > 0.5 AS BIGINT) = y AS DOUBLE)), 9) AS accuracy, count(*) AS n FROM (
  SELECT '0.45-0.55' AS band, * FROM ticks WHERE p_hat >= 0.45 AND p_hat <= 0.55
  UNION ALL SELECT '0.35-0.65', * FROM ticks WHERE p_hat >= 0.35 AND p_hat <= 0.65) GROUP BY band""", ["accuracy"])
def e7_hard_case_accuracy(spark, d):
    """Accuracy on probability bands near one half."""
    t = tv.ticks(spark, d)
    ok = ((F.col("p_hat") > 0.5).cast("long") == F.col("y")).cast("double")
    parts = [t.where((F.col("p_hat") >= lo) & (F.col("p_hat") <= hi)).withColumn("band", F.lit(name))
             for name, lo, hi in (("0.45-0.55", 0.45, 0.55), ("0.35-0.65", 0.35, 0.65))]
    return parts[0].unionByName(parts[1]).groupBy("band").agg(F.avg(ok).alias("accuracy"), F.count(F.lit(1)).alias("n"))


@register("e8_market_baseline", W(T) + """
SELECT round(avg(CAST(CAST(round(mid) AS BIGINT) = y AS DOUBLE)), 9) AS market_accuracy, count(*) AS n
FROM ticks WHERE time_to_close = 300""", ["market_accuracy"])
def e8_market_baseline(spark, d):
    """Market-implied baseline at time_to_close = 300: rounded mid equals the outcome."""
    t = tv.ticks(spark, d).where("time_to_close = 300")
    return t.agg(F.avg((F.round("mid").cast("long") == F.col("y")).cast("double")).alias("market_accuracy"),
                 F.count(F.lit(1)).alias("n"))


_PNL = """tp AS (
  SELECT *, abs(p_hat - mid) AS a,
         CASE WHEN p_hat - mid > 0 THEN CASE WHEN y = 1 THEN 1 - yes_ask - 0.02 ELSE -yes_ask - 0.02 END
              WHEN p_hat - mid < 0 THEN CASE WHEN y = 0 THEN 1 - no_ask - 0.02 ELSE -no_ask - 0.02 END END AS pnl
  FROM ticks)"""


def _e9_sql():
    taus, sigs = dlist(ev.GRID_TAUS), dlist(ev.GRID_SIGMAS)
    return W(T + [_PNL, f"""b AS (
  SELECT len(list_filter({taus}, lambda v: v < a)) AS ti, len(list_filter({sigs}, lambda v: v <= p_std)) AS si,
         count(*) AS n, sum(pnl) AS pnl, count_if(pnl > 0) AS wins FROM tp GROUP BY 1, 2)""",
                  f"""cells AS (SELECT i, j, {taus}[i + 1] AS tau, {sigs}[j + 1] AS sigma FROM range(98) a(i), range(98) b(j))"""]) + """
SELECT CAST(c.i AS BIGINT) AS i, CAST(c.j AS BIGINT) AS j, any_value(tau) AS tau, any_value(sigma) AS sigma,
       CAST(coalesce(sum(n), 0) AS BIGINT) AS trades,
       round(CASE WHEN coalesce(sum(n), 0) > 0 THEN sum(pnl) END, 6) AS total_pnl,
       round(CASE WHEN coalesce(sum(n), 0) > 0 THEN sum(wins) / sum(n) END, 9) AS win_rate
FROM cells c LEFT JOIN b ON b.ti > c.i AND b.si <= c.j GROUP BY c.i, c.j"""


@register("e9_tau_sigma_grid", _e9_sql(), [])
def e9_tau_sigma_grid(spark, d):
    """98 x 98 tau x sigma sweep (bucketed aggregates + 2-D prefix sums, no cross join of rows)."""
    g = ev.threshold_grid(tv.ticks(spark, d))
    return g.select("i", "j", "tau", "sigma", "trades", F.round("total_pnl", 6).alias("total_pnl"),
                    F.round("win_rate", 9).alias("win_rate"))


def _e10_sql():
    taus = dlist(ev.SWEEP_TAUS)
    return W(T + [_PNL, f"""b AS (
  SELECT len(list_filter({taus}, lambda v: v < a)) AS ti, count(*) AS n, sum(pnl) AS pnl, count_if(pnl > 0) AS wins FROM tp GROUP BY 1)"""]) + f"""
SELECT CAST(c.i AS BIGINT) AS i, any_value({taus}[c.i + 1]) AS tau, CAST(coalesce(sum(n), 0) AS BIGINT) AS trades,
       round(CASE WHEN coalesce(sum(n), 0) > 0 THEN sum(pnl) END, 6) AS total_pnl,
       round(CASE WHEN coalesce(sum(n), 0) > 0 THEN sum(wins) / sum(n) END, 9) AS win_rate
FROM range(99) c(i) LEFT JOIN b ON b.ti > c.i GROUP BY c.i"""


@register("e10_tau_sweep", _e10_sql())
def e10_tau_sweep(spark, d):
    """Tau-only sweep 0.00..0.98 (suffix sums over tau buckets)."""
    g = ev.tau_sweep(tv.ticks(spark, d))
    return g.select("i", "tau", "trades", F.round("total_pnl", 6).alias("total_pnl"), F.round("win_rate", 9).alias("win_rate"))


@register("e11_expected_value", W(T) + """
SELECT order_key, line_no, ticker, supp, p_hat - mid AS ev_yes, mid - p_hat AS ev_no FROM ticks""")
def e11_expected_value(spark, d):
    """Expected value of each side against the market mid."""
    t = tv.ticks(spark, d)
    return t.select("order_key", "line_no", "ticker", "supp", (F.col("p_hat") - F.col("mid")).alias("ev_yes"),
                    (F.col("mid") - F.col("p_hat")).alias("ev_no"))


@register("e12_forecast_errors", W(T) + """
SELECT round(avg(abs(y - p_hat)), 9) AS mae, round(sqrt(avg((y - p_hat) ^ 2)), 9) AS rmse, round(avg(y - p_hat), 9) AS bias FROM ticks""",
          ["mae", "rmse", "bias"])
def e12_forecast_errors(spark, d):
    """MAE, RMSE and bias of actual - predicted."""
    t = tv.ticks(spark, d)
    e = F.col("y") - F.col("p_hat")
    return t.agg(F.avg(F.abs(e)).alias("mae"), F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(e).alias("bias"))
