"""Model preparation, fit and scoring (M3–M16) with Spark ML and Arrow-batched pandas code.

Rows stay distributed: statistics are aggregates, fits are Spark ML estimators, posterior
scoring streams row blocks through ``mapInPandas`` against draw blocks of a fixed size, and partial
moments are merged, so any number of draws is scored the same way.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import UnivariateFeatureSelector
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import LinearRegression
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.ordering import dense_index

def feature_stats(df: DataFrame, col: str = "features") -> DataFrame:
    """M5: per feature position: mean and population std (zero std -> 1)."""
    x = df.select(F.posexplode(col).alias("pos", "v"))
    s = x.groupBy("pos").agg(F.avg("v").alias("mean"), F.stddev_pop("v").alias("std"))
    return s.select(F.col("pos").cast("long").alias("pos"), "mean",
                    F.when(F.col("std") == 0, F.lit(1.0)).otherwise(F.col("std")).alias("std"))


def standardize(df: DataFrame, stats: DataFrame, col: str = "features") -> DataFrame:
    """Apply M5 scaling; the stats table has one row per feature and is collected as two arrays."""
    arr = stats.orderBy("pos").agg(F.collect_list("mean").alias("m"), F.collect_list("std").alias("s"))
    j = df.crossJoin(F.broadcast(arr))
    return j.withColumn(col, F.zip_with(F.zip_with(col, "m", lambda x, m: x - m), "s", lambda a, s: a / s)).drop("m", "s")


def row_split(df: DataFrame, order: str, train_frac: float = 0.8) -> DataFrame:
    """M3: first ``train_frac`` of rows in order -> train, rest -> test; positions without a one-task window."""
    n = df.count()
    return dense_index(df, [order], name="_r").withColumn(
        "split", F.when(F.col("_r") < int(n * train_frac), "train").otherwise("test")).drop("_r")


def tail_split(df: DataFrame, order: str, n_train: int = 480, n_val: int = 180, n_test: int = 240) -> DataFrame:
    """M3, time-series form: the last rows in order -> train / val / test of fixed sizes, the rest is null."""
    n = df.count()
    left = n - F.col("_r")
    return dense_index(df, [order], name="_r").withColumn(
        "split", F.when(left <= n_test, "test").when(left <= n_test + n_val, "val").when(left <= n_test + n_val + n_train, "train")).drop("_r")


def logistic_fit(df: DataFrame, C: float = 1.0, label: str = "y", features: str = "features"):
    """M7: L2 logistic regression with sklearn's strength C -> regParam = 1 / (C n)."""
    n = df.count()
    v = df.select(array_to_vector(F.col(features)).alias("fv"), F.col(label).cast("double").alias("label"))
    lr = LogisticRegression(featuresCol="fv", labelCol="label", regParam=1.0 / (C * n), elasticNetParam=0.0,
                            standardization=False, maxIter=200, tol=1e-8)
    return lr.fit(v)


def coefficients_table(model, spark) -> DataFrame:
    """Coefficients as a table (pos -1 = intercept)."""
    rows = [(-1, float(model.intercept))] + [(i, float(c)) for i, c in enumerate(model.coefficients.toArray())]
    return spark.createDataFrame(rows, "pos long, coef double")


# Fixed value: the grid of C, 30 values from 1e-4 to 1e4.
C_GRID = [10 ** (-4 + 8 * i / 29) for i in range(30)]


def newton_logistic(rows: DataFrame, models: dict[str, tuple[float, int]], member: str, tol: float = 1e-8,
                    max_iter: int = 60) -> dict[str, np.ndarray]:
    """L2 logistic regressions of many models at once by Newton steps.

    ``models``: name -> (C, fold); a row counts for the models of the folds listed in its array column
    ``member``. One pass over the rows per step for all models: tasks add up gradient and Hessian per model
    (sizes fixed by the features), Spark sums them, the driver solves the steps. The intercept is not
    penalised; the objective is C x log loss + |beta|^2 / 2."""
    k = rows.select(F.size("features")).first()[0] + 1
    theta = {name: np.zeros(k) for name in models}
    live, spark = set(models), rows.sparkSession
    for _ in range(max_iter):
        state = {name: (theta[name], models[name][1]) for name in live}
        shared = spark.sparkContext.broadcast(state)

        def run(it: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            grad = {name: np.zeros(k) for name in shared.value}
            hess = {name: np.zeros((k, k)) for name in shared.value}
            for pdf in it:
                X = np.column_stack([np.ones(len(pdf)), np.vstack(pdf["features"].to_numpy())])
                y = pdf["y"].to_numpy().astype(float)
                folds = [set(f) for f in pdf[member]]
                use = {f: np.array([f in s for s in folds]) for f in {f for _, f in shared.value.values()}}
                for name, (t, f) in shared.value.items():
                    Xf, yf = X[use[f]], y[use[f]]
                    p = 1.0 / (1.0 + np.exp(-np.clip(Xf @ t, -500, 500)))
                    grad[name] += Xf.T @ (p - yf)
                    hess[name] += (Xf * (p * (1 - p))[:, None]).T @ Xf
            yield pd.DataFrame({"name": list(grad), "g": [g.tolist() for g in grad.values()], "h": [h.ravel().tolist() for h in hess.values()]})

        parts = rows.select("features", "y", member).mapInPandas(run, "name string, g array<double>, h array<double>")
        sums = parts.select("name", F.posexplode(F.concat("g", "h")).alias("i", "v")).groupBy("name", "i").agg(F.sum("v").alias("v"))
        total = {name: np.zeros(k + k * k) for name in live}
        for name, i, v in sums.toPandas().itertuples(index=False):
            total[name][i] = v
        for name in sorted(live):
            C = models[name][0]
            ridge = np.r_[0.0, np.ones(k - 1)]
            g = C * total[name][:k] + ridge * theta[name]
            h = C * total[name][k:].reshape(k, k) + np.diag(ridge + 1e-12)
            step = np.linalg.solve(h, g)
            step *= min(1.0, 5.0 / max(np.abs(step).max(), 1e-300))
            theta[name] = theta[name] - step
            if np.abs(step).max() < tol:
                live.discard(name)
        if not live:
            break
    return theta


def cv_grid(df: DataFrame, Cs, folds: DataFrame, label: str = "y") -> tuple[DataFrame, np.ndarray]:
    """M8: mean negative log loss per C over expanding time-series folds (M4), and the parameters
    (intercept first) of the best C, refitted on all rows. All fits of the grid share their passes."""
    spark = df.sparkSession
    marks = folds.groupBy("row_id").agg(F.collect_list(F.when(F.col("role") == "train", F.col("fold"))).alias("train"),
                                        F.collect_list(F.when(F.col("role") == "test", F.col("fold"))).alias("test"))
    rows = df.withColumn("y", F.col(label).cast("double")).join(marks, "row_id").select("features", "y", "train", "test")
    names = sorted(r[0] for r in folds.select("fold").distinct().collect())
    models = {f"{i}:{k}": (float(C), k) for i, C in enumerate(Cs) for k in names}
    shared = spark.sparkContext.broadcast(newton_logistic(rows, models, "train"))

    def losses(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[str, list[float]] = {}
        for pdf in it:
            X = np.column_stack([np.ones(len(pdf)), np.vstack(pdf["features"].to_numpy())])
            y = pdf["y"].to_numpy()
            for name, t in shared.value.items():
                fold = int(name.split(":")[1])
                use = np.array([fold in f for f in pdf["test"]])
                p = np.clip(1.0 / (1.0 + np.exp(-np.clip(X[use] @ t, -500, 500))), 1e-15, 1 - 1e-15)
                got = total.setdefault(name, [0.0, 0])
                got[0] += float(-(y[use] * np.log(p) + (1 - y[use]) * np.log(1 - p)).sum())
                got[1] += int(use.sum())
        yield pd.DataFrame([(n, v[0], v[1]) for n, v in total.items()], columns=["name", "loss", "n"])

    per = rows.mapInPandas(losses, "name string, loss double, n long").groupBy("name").agg((F.sum("loss") / F.sum("n")).alias("loss")).toPandas()
    per["i"] = per["name"].str.split(":").str[0].astype(int)
    mean = per.groupby("i")["loss"].mean()
    best = int(mean.idxmin())
    whole = df.withColumn("y", F.col(label).cast("double")).withColumn("all", F.array(F.lit(0).cast("long")))
    theta = newton_logistic(whole, {"best": (float(Cs[best]), 0)}, "all")["best"]
    return spark.createDataFrame([(float(Cs[i]), -float(v), i == best) for i, v in mean.items()], "C double, neg_log_loss double, best boolean"), theta


def gbt_fit(df: DataFrame, trees: int = 300, lr: float = 0.05, depth: int = 6, min_leaf: int = 50):
    """M9: gradient-boosted trees with the reference's settings."""
    v = df.select(array_to_vector("features").alias("fv"), F.col("y").cast("double").alias("label"))
    g = GBTClassifier(featuresCol="fv", labelCol="label", maxIter=trees, stepSize=lr, maxDepth=depth,
                      minInstancesPerNode=min_leaf, seed=7)
    return g.fit(v)


def tail_split_folds(df: DataFrame, order: str, n_splits: int = 5) -> DataFrame:
    """M4: expanding-window folds: test size n div (splits + 1), test k starts at n - (splits - k) t."""
    n = df.count()
    t = n // (n_splits + 1)
    x = dense_index(df.select("row_id", order).distinct() if order != "row_id" else df.select("row_id"), [order], name="_i")
    x = x.withColumn("fold", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_splits - 1).cast("long"))))
    start = n - (n_splits - F.col("fold")) * t
    role = F.when(F.col("_i") < start, "train").when(F.col("_i") < start + t, "test")
    return x.select("row_id", "fold", role.alias("role")).where(F.col("role").isNotNull())


def log_posterior(df: DataFrame, theta: DataFrame) -> DataFrame:
    """Log likelihood sum(y z - log(1 + e^z)) (stable form), Student-t(4, 10) intercept prior,
    N(0, 10^2) slope priors, their sum. ``theta`` has one row (intercept double, beta array<double>)."""
    j = df.crossJoin(F.broadcast(theta))
    z = F.col("intercept") + F.aggregate(F.zip_with("features", "beta", lambda a, b: a * b), F.lit(0.0), lambda acc, v: acc + v)
    j = j.withColumn("z", z)
    ll = F.col("y") * F.col("z") - F.when(F.col("z") > 0, F.col("z") + F.log1p(F.exp(-F.col("z")))).otherwise(F.log1p(F.exp(F.col("z"))))
    lik = j.agg(F.sum(ll).alias("log_lik"))
    nu, s = 4.0, 10.0
    from math import lgamma, log, pi
    tconst = lgamma((nu + 1) / 2) - lgamma(nu / 2) - 0.5 * log(nu * pi) - log(s)
    pr = theta.select(
        (F.lit(tconst) - (nu + 1) / 2 * F.log1p((F.col("intercept") / s) ** 2 / nu)
         + F.aggregate(F.col("beta"), F.lit(0.0), lambda acc, b: acc + (F.lit(-0.5) * (b / s) ** 2 - F.lit(log(s * (2 * pi) ** 0.5)))))
        .alias("log_prior"))
    return lik.crossJoin(pr).withColumn("log_post", F.col("log_lik") + F.col("log_prior"))


def group_mean_draws(df: DataFrame, n_draws: int = 20) -> DataFrame:
    """A draws table derived from the data: draw d = per-feature means of rows with row_id % n = d,
    scaled down, intercept = mean label - 0.5. Used where a fixed, reproducible posterior is needed."""
    x = df.select((F.col("row_id") % n_draws).alias("draw_id"), "y", F.posexplode("features").alias("pos", "v"))
    m = x.groupBy("draw_id", "pos").agg(F.avg("v").alias("mv"))
    b = m.groupBy("draw_id").agg(F.sort_array(F.collect_list(F.struct("pos", "mv"))).alias("s")).select(
        "draw_id", F.transform("s", lambda e: e["mv"] * 5).alias("beta"))
    a = df.groupBy((F.col("row_id") % n_draws).alias("draw_id")).agg((F.avg("y") - 0.5).alias("intercept"))
    return a.join(b, "draw_id").select(F.col("draw_id").cast("long").alias("draw_id"), "intercept", "beta")


def posterior_summary(draws: DataFrame) -> DataFrame:
    """Mean, sample sd, q05, q95 per parameter (pos -1 = intercept)."""
    x = draws.select(F.lit(-1).cast("long").alias("pos"), F.col("intercept").alias("v")).unionByName(
        draws.select(F.posexplode("beta").alias("pos", "v")).select(F.col("pos").cast("long"), "v"))
    return x.groupBy("pos").agg(F.avg("v").alias("mean"), F.stddev_samp("v").alias("sd"),
                                F.percentile("v", 0.05).alias("q05"), F.percentile("v", 0.95).alias("q95"))


def posterior_predictive(df: DataFrame, draws: DataFrame, block_rows: int = 5000, block_draws: int = 2000,
                         clip: float = 500.0) -> DataFrame:
    """Per row, mean and population std over draws of sigmoid(x . theta), logit clipped.

    Draws are taken in blocks of ``block_draws``, each sent to the tasks as a matrix of that bounded size;
    rows stream through in Arrow batches, so no row x draw pair becomes a Spark row. A block gives a row's
    count, mean and squared deviations (two passes, nothing cancels); blocks are merged per row."""
    numbered = dense_index(draws.select("draw_id", "intercept", "beta"), ["draw_id"], name="_d")
    n_blocks = -(-numbered.count() // block_draws)
    parts = None
    for b in range(n_blocks):
        d = numbered.where(F.col("_d").between(b * block_draws, (b + 1) * block_draws - 1)).orderBy("_d").select("intercept", "beta").toPandas()
        bc = df.sparkSession.sparkContext.broadcast(np.column_stack([d["intercept"].to_numpy(), np.vstack(d["beta"].to_numpy())]))

        def score(it: Iterator[pd.DataFrame], bc=bc) -> Iterator[pd.DataFrame]:
            th = bc.value
            for pdf in it:
                for s in range(0, len(pdf), block_rows):
                    part = pdf.iloc[s:s + block_rows]
                    X = np.column_stack([np.ones(len(part)), np.vstack(part["features"].to_numpy())])
                    p = 1.0 / (1.0 + np.exp(-np.clip(X @ th.T, -clip, clip)))
                    mean = p.mean(axis=1)
                    yield pd.DataFrame({"row_id": part["row_id"].to_numpy(), "n": float(len(th)), "m": mean, "q": ((p - mean[:, None]) ** 2).sum(axis=1)})

        one = df.select("row_id", "features").mapInPandas(score, "row_id long, n double, m double, q double")
        parts = one if parts is None else parts.unionByName(one)
    if parts is None:
        return df.select("row_id", F.lit(None).cast("double").alias("p_hat"), F.lit(None).cast("double").alias("p_std"))
    if n_blocks > 1:
        merged = parts.groupBy("row_id").agg(F.sum("n").alias("n"), (F.sum(F.col("n") * F.col("m")) / F.sum("n")).alias("m"),
                                             F.sum("q").alias("q0"), F.collect_list(F.struct("n", "m")).alias("b"))
        between = F.aggregate("b", F.lit(0.0), lambda acc, x: acc + x["n"] * (x["m"] - F.col("m")) * (x["m"] - F.col("m")))
        parts = merged.select("row_id", "n", "m", (F.col("q0") + between).alias("q"))
    return parts.select("row_id", F.col("m").alias("p_hat"), F.sqrt(F.col("q") / F.col("n")).alias("p_std"))


def metropolis_consensus(df: DataFrame, shards: int = 8, steps: int = 3000, burn: int = 1000, thin: int = 4,
                         step0: float = 0.01, seed: int = 7) -> DataFrame:
    """Random-walk Metropolis per data shard (adaptive step, burn-in, thinning), combined by
    consensus Monte Carlo: draws of all shards are averaged with precision weights (Scott et al.
    2016). Each shard sees 1/shards of the data and the prior raised to 1/shards."""
    from math import log

    def chain(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            if pdf.empty:
                continue
            shard = int(pdf["shard"].iloc[0])
            X = np.column_stack([np.ones(len(pdf)), np.vstack(pdf["features"].to_numpy())])
            y = pdf["y"].to_numpy().astype(float)
            k = X.shape[1]
            rng = np.random.default_rng(seed + shard)

            def lp(th):
                z = X @ th
                ll = np.sum(y * z - np.logaddexp(0, z))
                pri = -2.5 * np.log1p((th[0] / 10) ** 2 / 4) - 0.5 * np.sum((th[1:] / 10) ** 2)
                return ll + pri / shards

            th = np.zeros(k)
            cur = lp(th)
            step, acc, out = step0, 0, []
            for i in range(steps):
                prop = th + rng.normal(0, step, k)
                new = lp(prop)
                if log(rng.random()) < new - cur:
                    th, cur, acc = prop, new, acc + 1
                if i < burn and (i + 1) % 100 == 0:  # adapt toward 0.20-0.35 acceptance
                    rate = acc / (i + 1)
                    step *= 1.1 if rate > 0.35 else (0.9 if rate < 0.20 else 1.0)
                if i >= burn and (i - burn) % thin == 0:
                    out.append(th.copy())
            draws = np.array(out)
            yield pd.DataFrame({"shard": shard, "draw_idx": np.arange(len(draws)),
                                "theta": list(draws), "accept_rate": acc / steps})

    d = df.select((F.col("row_id") % shards).alias("shard"), "features", "y")
    d = d.repartition(shards, "shard")
    per = d.groupBy("shard").applyInPandas(
        lambda pdf: next(chain(iter([pdf]))), "shard long, draw_idx long, theta array<double>, accept_rate double")

    def combine(pdf: pd.DataFrame) -> pd.DataFrame:
        # Consensus: theta_i = (sum_s W_s)^-1 sum_s W_s theta_{s,i}, W_s = inverse sample covariance.
        shards_ = sorted(pdf["shard"].unique())
        mats = {s: np.vstack(pdf[pdf["shard"] == s].sort_values("draw_idx")["theta"].to_numpy()) for s in shards_}
        n = min(m.shape[0] for m in mats.values())
        Ws = {s: np.linalg.pinv(np.cov(m[:n].T) + 1e-9 * np.eye(m.shape[1])) for s, m in mats.items()}
        Wsum_inv = np.linalg.pinv(sum(Ws.values()))
        comb = np.array([Wsum_inv @ sum(Ws[s] @ mats[s][i] for s in shards_) for i in range(n)])
        return pd.DataFrame({"draw_id": np.arange(n), "intercept": comb[:, 0], "beta": list(comb[:, 1:]),
                             "accept_rate": float(pdf["accept_rate"].mean())})

    # The combination needs every shard's draws for one draw index; it works on draws, whose
    # number is fixed by the sampler settings (not by the data size).
    return per.withColumn("_all", F.lit(0)).groupBy("_all").applyInPandas(
        lambda pdf: combine(pdf), "draw_id long, intercept double, beta array<double>, accept_rate double")


def fdr_select(df: DataFrame, fdr: float = 0.05) -> DataFrame:
    """Per-feature ANOVA F-test selection with false-discovery-rate control; fit it on train rows only."""
    v = df.select(array_to_vector("features").alias("fv"), F.col("y").cast("double").alias("label"))
    sel = UnivariateFeatureSelector(featuresCol="fv", labelCol="label", outputCol="sel", selectionMode="fdr")
    sel.setFeatureType("continuous").setLabelType("categorical").setSelectionThreshold(fdr)
    m = sel.fit(v)
    return df.sparkSession.createDataFrame([(int(i),) for i in m.selectedFeatures], "pos long")


def regression_eval(df: DataFrame, target_pos: int = 0) -> DataFrame:
    """Regression of one feature's next value (the following row's) on all features of the row, with
    MSE and R^2 on the last fifth of the rows. The target row's own features are not among the inputs."""
    n = df.count()
    x = dense_index(df.select("row_id", "features"), ["row_id"], name="_i")
    after = x.select((F.col("_i") - 1).alias("_i"), F.get("features", target_pos).alias("label"))
    x = x.join(after, "_i").select("_i", array_to_vector("features").alias("fv"), "label")
    tr, te = x.where(F.col("_i") < n * 4 // 5), x.where(F.col("_i") >= n * 4 // 5)
    m = LinearRegression(featuresCol="fv", labelCol="label").fit(tr)
    p = m.transform(te)
    ev = RegressionEvaluator(labelCol="label", predictionCol="prediction")
    return df.sparkSession.createDataFrame([(float(ev.setMetricName("mse").evaluate(p)),
                                             float(ev.setMetricName("r2").evaluate(p)))], "mse double, r2 double")
