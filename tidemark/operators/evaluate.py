"""Model evaluation and threshold sweeps (E1–E12) over scored rows (p_hat, y, mid, asks, p_std)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.ordering import prefix_sums

# The sweep grids of the reference (numpy arange start + i * step).
GRID_TAUS = [0.01 + i * 0.005 for i in range(98)]
GRID_SIGMAS = [0.01 + i * 0.005 for i in range(98)]
SWEEP_TAUS = [i * 0.01 for i in range(99)]
DECILE_QS = [i * 0.1 for i in range(11)]  # numpy linspace(0, 1, 11) values
FLAT_FEE = 0.02


def confusion(df: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Counts per (y, predicted) with predicted = p > threshold."""
    return df.groupBy("y", (F.col("p_hat") > threshold).cast("long").alias("pred")).agg(F.count(F.lit(1)).alias("n"))


def classification_report(df: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Precision / recall / F1 / support per class, macro and weighted averages, accuracy."""
    pred = (F.col("p_hat") > threshold).cast("long")
    c = df.agg(*[F.count_if((F.col("y") == a) & (pred == b)).alias(f"n{a}{b}") for a in (0, 1) for b in (0, 1)])
    rows = []
    for k in (0, 1):
        tp, fp, fn = F.col(f"n{k}{k}"), F.col(f"n{1 - k}{k}"), F.col(f"n{k}{1 - k}")
        prec = F.coalesce(F.try_divide(tp, tp + fp), F.lit(0.0))
        rec = F.coalesce(F.try_divide(tp, tp + fn), F.lit(0.0))
        f1 = F.coalesce(F.try_divide(2 * prec * rec, prec + rec), F.lit(0.0))
        rows.append(F.struct(F.lit(str(k)).alias("label"), prec.alias("precision"), rec.alias("recall"),
                             f1.alias("f1"), (tp + fn).cast("double").alias("support")))
    per = c.select(F.explode(F.array(*rows)).alias("r"), (F.col("n00") + F.col("n11")).alias("ok"),
                   (F.col("n00") + F.col("n01") + F.col("n10") + F.col("n11")).alias("tot")).select("r.*", "ok", "tot")
    macro = per.groupBy().agg(F.lit("macro avg").alias("label"), F.avg("precision").alias("precision"),
                              F.avg("recall").alias("recall"), F.avg("f1").alias("f1"), F.sum("support").alias("support"))
    wsum = F.sum("support")
    weighted = per.groupBy().agg(F.lit("weighted avg").alias("label"),
                                 (F.sum(F.col("precision") * F.col("support")) / wsum).alias("precision"),
                                 (F.sum(F.col("recall") * F.col("support")) / wsum).alias("recall"),
                                 (F.sum(F.col("f1") * F.col("support")) / wsum).alias("f1"), wsum.alias("support"))
    acc = per.groupBy().agg(F.lit("accuracy").alias("label"), F.lit(None).cast("double").alias("precision"),
                            F.lit(None).cast("double").alias("recall"), (F.first("ok") / F.first("tot")).alias("f1"),
                            F.first("tot").cast("double").alias("support"))
    return per.drop("ok", "tot").unionByName(macro).unionByName(weighted).unionByName(acc)


def scores(df: DataFrame, eps: float = 1e-15) -> DataFrame:
    """Brier score and log loss (p clipped to [eps, 1 - eps])."""
    p = F.least(F.greatest(F.col("p_hat"), F.lit(eps)), F.lit(1 - eps))
    ll = -(F.col("y") * F.log(p) + (1 - F.col("y")) * F.log(1 - p))
    return df.agg(F.avg((F.col("p_hat") - F.col("y")) ** 2).alias("brier"), F.avg(ll).alias("log_loss"))


def roc(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """ROC curve (one point per distinct score, descending) and AUC with ties counted half.

    Scores are first aggregated (positives / negatives per distinct score); running sums over
    the sorted distinct scores use the parallel prefix sum.
    """
    g = df.groupBy(F.col("p_hat").alias("score")).agg(F.sum("y").cast("double").alias("pos"),
                                                      F.sum(1 - F.col("y")).cast("double").alias("neg"))
    g = g.withColumn("neg_score", -F.col("score"))
    cum = prefix_sums(g, ["neg_score"], ["pos", "neg"])
    tot = g.agg(F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    c = cum.crossJoin(F.broadcast(tot))
    curve = c.select(F.col("score").alias("threshold"), (F.col("pos_cum") / F.col("P")).alias("tpr"),
                     (F.col("neg_cum") / F.col("N")).alias("fpr"))
    # negatives with a lower score than s = N - neg_cum(s) (cum runs from the top score down)
    auc = c.agg((F.sum(F.col("pos") * ((F.col("N") - F.col("neg_cum")) + 0.5 * F.col("neg")))
                 / (F.first("P") * F.first("N"))).alias("auc"))
    return curve, auc


def calibration(df: DataFrame, bins: int = 10) -> DataFrame:
    """E5: quantile calibration curve: bin = number of interior quantile edges below p."""
    qs = [i / bins for i in range(1, bins)] if bins != 10 else DECILE_QS[1:-1]
    edges = df.agg(F.percentile("p_hat", F.array(*[F.lit(q) for q in qs])).alias("_e"))
    x = df.crossJoin(F.broadcast(edges)).withColumn("bin", F.size(F.filter("_e", lambda e: e < F.col("p_hat"))).cast("long"))
    return x.groupBy("bin").agg(F.avg("y").alias("prob_true"), F.avg("p_hat").alias("prob_pred"), F.count(F.lit(1)).alias("n"))


def decile_accuracy(df: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Accuracy per quantile decile, bins closed at both ends (a row on an edge counts twice)."""
    edges = df.agg(F.percentile("p_hat", F.array(*[F.lit(q) for q in DECILE_QS])).alias("_e"))
    x = df.crossJoin(F.broadcast(edges))
    inner = F.slice("_e", 2, 9)
    lo = F.size(F.filter(inner, lambda e: e < F.col("p_hat")))
    hi = F.size(F.filter(inner, lambda e: e <= F.col("p_hat")))
    x = x.withColumn("bin", F.explode(F.sequence(lo, hi)))
    ok = ((F.col("p_hat") > threshold).cast("long") == F.col("y")).cast("double")
    return x.groupBy("bin").agg(F.avg(ok).alias("accuracy"), F.count(F.lit(1)).alias("n"),
                                ((F.first(F.element_at("_e", F.col("bin") + 1)) + F.first(F.element_at("_e", F.col("bin") + 2))) / 2)
                                .alias("bin_mid")).withColumn("bin", F.col("bin").cast("long"))


def grid_rank(x, values, strict: bool = True):
    """Number of grid values below x (``strict``) or at most x, for an evenly spaced grid.

    An arithmetic guess is corrected by one step against the exact grid values (the guess can be
    off by one only through rounding), so no per-row higher-order function is needed and the
    expression stays in whole-stage codegen.
    """
    n = len(values)
    start, step = values[0], values[1] - values[0]
    arr = F.array(*[F.lit(v) for v in values])
    at = lambda k: F.element_at(arr, (k + 1).cast("int"))  # noqa: E731  (0-based)
    raw = (x - F.lit(start)) / F.lit(step)
    k = F.least(F.greatest(F.ceil(raw) if strict else F.floor(raw) + 1, F.lit(0)), F.lit(n)).cast("long")
    below = (lambda v: v < x) if strict else (lambda v: v <= x)
    k = F.when((k > 0) & ~below(at(k - 1)), k - 1).when((k < n) & below(at(k)), k + 1).otherwise(k)
    return k


def trade_pnl(df: DataFrame, fee: float = FLAT_FEE) -> DataFrame:
    """Per row: edge size, side by sign, PnL of buying that side at its ask with a flat fee."""
    e = F.col("p_hat") - F.col("mid")
    pnl_yes = F.when(F.col("y") == 1, 1 - F.col("yes_ask") - fee).otherwise(-F.col("yes_ask") - fee)
    pnl_no = F.when(F.col("y") == 0, 1 - F.col("no_ask") - fee).otherwise(-F.col("no_ask") - fee)
    return df.select("*", F.abs(e).alias("_a"), F.when(e > 0, pnl_yes).when(e < 0, pnl_no).alias("_pnl"))


def threshold_grid(df: DataFrame, taus=GRID_TAUS, sigmas=GRID_SIGMAS) -> DataFrame:
    """PnL / trades / win rate on the tau x sigma grid in O(rows + grid).

    A row trades in cell (i, j) iff |p - mid| > tau_i and p_std < sigma_j, i.e. iff i < ti and
    j >= si with ti = #taus below |edge| and si = #sigmas <= p_std. Rows are aggregated by
    (ti, si) and cells are 2-D prefix sums over that (len(taus)+1) x (len(sigmas)+1) table.
    """
    t = trade_pnl(df)
    t = t.select(grid_rank(F.col("_a"), taus, strict=True).alias("ti"),
                 grid_rank(F.col("p_std"), sigmas, strict=False).alias("si"), "_pnl")
    b = t.groupBy("ti", "si").agg(F.count(F.lit(1)).alias("n"), F.sum("_pnl").alias("pnl"),
                                  F.count_if(F.col("_pnl") > 0).alias("wins"))
    nt, ns = len(taus), len(sigmas)
    spark = df.sparkSession
    cells = spark.range(nt * ns).select((F.col("id") / ns).cast("int").alias("i"), (F.col("id") % ns).cast("int").alias("j"))
    # cell (i, j) sums buckets with ti >= i + 1 and si <= j: map each bucket to (ti - 1, si) and
    # take a suffix sum over i and a prefix sum over j on the dense grid.
    b = b.where((F.col("ti") >= 1) & (F.col("si") <= ns - 1)).select(
        (F.col("ti") - 1).alias("i"), F.col("si").alias("j"), "n", "pnl", "wins")
    dense = cells.join(b, ["i", "j"], "left").fillna(0, ["n", "wins"]).fillna(0.0, ["pnl"])
    wj = Window.partitionBy("i").orderBy("j").rowsBetween(Window.unboundedPreceding, 0)
    dense = dense.select("i", "j", *[F.sum(c).over(wj).alias(c) for c in ("n", "pnl", "wins")])
    wi = Window.partitionBy("j").orderBy(F.col("i").desc()).rowsBetween(Window.unboundedPreceding, 0)
    g = dense.select("i", "j", *[F.sum(c).over(wi).alias(c) for c in ("n", "pnl", "wins")])
    tau_c = F.element_at(F.array(*[F.lit(v) for v in taus]), F.col("i") + 1)
    sig_c = F.element_at(F.array(*[F.lit(v) for v in sigmas]), F.col("j") + 1)
    return g.select(F.col("i").cast("long").alias("i"), F.col("j").cast("long").alias("j"), tau_c.alias("tau"), sig_c.alias("sigma"),
                    F.col("n").cast("long").alias("trades"),
                    F.when(F.col("n") > 0, F.col("pnl")).alias("total_pnl"),
                    F.when(F.col("n") > 0, F.col("wins") / F.col("n")).alias("win_rate"))


def tau_sweep(df: DataFrame, taus=SWEEP_TAUS) -> DataFrame:
    """The grid without the sigma filter (suffix sums over tau buckets)."""
    t = trade_pnl(df)
    tarr = F.array(*[F.lit(v) for v in taus])
    t = t.select(grid_rank(F.col("_a"), taus, strict=True).alias("ti"), "_pnl").where("ti >= 1")
    b = t.groupBy((F.col("ti") - 1).alias("i")).agg(F.count(F.lit(1)).alias("n"), F.sum("_pnl").alias("pnl"),
                                                    F.count_if(F.col("_pnl") > 0).alias("wins"))
    grid = df.sparkSession.range(len(taus)).select(F.col("id").cast("int").alias("i"))
    dense = grid.join(b, "i", "left").fillna(0, ["n", "wins"]).fillna(0.0, ["pnl"])
    wi = Window.orderBy(F.col("i").desc()).rowsBetween(Window.unboundedPreceding, 0)
    g = dense.select("i", *[F.sum(c).over(wi).alias(c) for c in ("n", "pnl", "wins")])
    return g.select(F.col("i").cast("long").alias("i"), F.element_at(tarr, F.col("i") + 1).alias("tau"),
                    F.col("n").cast("long").alias("trades"), F.when(F.col("n") > 0, F.col("pnl")).alias("total_pnl"),
                    F.when(F.col("n") > 0, F.col("wins") / F.col("n")).alias("win_rate"))
