"""Usefulness of data: splits, classifiers, metrics, paired tests."""

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ..functions import ranks, rng
from ..functions.numeric import safe_ratio
from ..functions.special import student_t_udf, wilcoxon_udf
from ..session import cut_lineage, sealed

SPLIT_BUCKETS = 1 << 12


# --- split and encoding -----------------------------------------------------------------


def stratified_split(df: DataFrame, target: str, row: str, test_size: float = 0.2, seed: int = 0) -> DataFrame:
    """Add ``is_test``: exactly the stratified share, chosen by hash of ``row``.

    Class shares are rounded by largest remainder.  The cut of each class is
    found from a histogram of hashes and the few rows of one bucket, so a class
    holding most of the rows is never sorted; the split itself is a map.
    """
    df = sealed(rng.hash_order(df, row, seed, "__h", "split"))
    slot = F.floor(F.col("__h") * SPLIT_BUCKETS).cast("long")
    hist = cut_lineage(df.groupBy(target, slot.alias("__s")).agg(F.count(F.lit(1)).alias("n")))
    classes = hist.groupBy(target).agg(F.sum("n").alias("size"))
    total = classes.agg(F.sum("size")).first()[0] or 0
    n_test = -int(-test_size * total // 1)
    n_train = total - n_test
    share = F.col("size") * (n_train / total if total else 0.0)
    classes = classes.withColumn("floor", F.floor(share).cast("long")).withColumn("rest", share - F.floor(share))
    spare = n_train - (classes.agg(F.sum("floor")).first()[0] or 0)
    order = Window.orderBy(F.col("rest").desc(), target)  # one row per class
    classes = classes.withColumn("train", F.col("floor") + F.when(F.row_number().over(order) <= spare, 1).otherwise(0))
    classes = classes.select(target, (F.col("size") - F.col("train")).alias("want"))
    running = Window.partitionBy(target).orderBy("__s").rowsBetween(Window.unboundedPreceding, -1)
    cut = hist.withColumn("before", F.coalesce(F.sum("n").over(running), F.lit(0))).join(classes, target)
    cut = cut.filter((F.col("before") < F.col("want")) & (F.col("want") <= F.col("before") + F.col("n")))
    cut = cut.select(target, "__s", (F.col("want") - F.col("before")).alias("inside"))
    edge_rows = df.withColumn("__s", slot).join(cut, [target, "__s"]).select(target, "__h", row, "inside")
    rank = F.row_number().over(Window.partitionBy(target).orderBy("__h", row))
    limits = edge_rows.withColumn("__r", rank).filter(F.col("__r") == F.col("inside"))
    limits = cut_lineage(limits.select(target, F.col("__h").alias("__cut"), F.col(row).alias("__cut_row")))
    split = df.join(F.broadcast(limits) if limits.count() <= 100_000 else limits, target, "left")
    chosen = (F.col("__h") < F.col("__cut")) | ((F.col("__h") == F.col("__cut")) & (F.col(row) <= F.col("__cut_row")))
    return split.withColumn("is_test", F.coalesce(chosen, F.lit(False))).drop("__h", "__cut", "__cut_row")


def encoder(train: DataFrame, column: str):
    """Alphabetical label codes, fitted on the training rows."""
    return StringIndexer(inputCol=column, outputCol=f"{column}_code", stringOrderType="alphabetAsc", handleInvalid="error").fit(train)


def label_encode(df: DataFrame, column: str, train: DataFrame | None = None) -> DataFrame:
    return encoder(train if train is not None else df, column).transform(df)


def unseen_labels(df: DataFrame, column: str, train: DataFrame) -> DataFrame:
    """Labels of ``df`` that the training rows never had."""
    return df.select(column).distinct().join(train.select(column).distinct(), column, "left_anti")


def positive_label(labels: DataFrame, column: str) -> DataFrame:
    """The first label starting with ``>``, else the alphabetically last."""
    marked = F.min(F.when(F.trim(column).startswith(">"), F.col(column)))
    return labels.agg(F.coalesce(marked, F.max(column)).alias("positive"))


# --- metrics -------------------------------------------------------------------------------


def classifier_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction", by: Sequence[str] = ()) -> DataFrame:
    """Accuracy and F1 of code 1 in one pass."""
    hit = lambda c: F.sum(F.when(c, 1).otherwise(0))
    t, p = F.col(label) == 1, F.col(prediction) == 1
    return df.groupBy(*by).agg(
        F.avg((F.col(label) == F.col(prediction)).cast("double")).alias("accuracy"),
        safe_ratio(2.0 * hit(t & p), hit(t) + hit(p)).alias("f1"),
    )


def confusion_matrix(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Every pair of known labels with its count."""
    counts = df.groupBy(F.col(label).alias("true_label"), F.col(prediction).alias("pred_label")).agg(F.count(F.lit(1)).alias("n"))
    known = F.array_sort(F.array_distinct(F.flatten(F.collect_set(F.array("true_label", "pred_label")))))
    grid = counts.agg(known.alias("l")).select("l", F.explode("l").alias("true_label")).select(
        "true_label", F.explode("l").alias("pred_label")
    )
    return grid.join(counts, ["true_label", "pred_label"], "left").withColumn("n", F.coalesce("n", F.lit(0)))


def class_report(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Precision, recall, F1 and support per label; undefined ratios are 0."""
    counts = confusion_matrix(df, label, prediction)
    both = F.array(
        F.struct(F.col("true_label").alias("label"), F.col("n").alias("support"), F.lit(0).cast("long").alias("predicted")),
        F.struct(F.col("pred_label").alias("label"), F.lit(0).cast("long").alias("support"), F.col("n").alias("predicted")),
    )
    right = F.when(F.col("true_label") == F.col("pred_label"), F.col("n")).otherwise(0)
    sides = counts.select(right.alias("right"), F.posexplode(both).alias("side", "e")).select("side", "right", "e.*")
    agg = sides.groupBy("label").agg(
        F.sum("support").alias("support"), F.sum("predicted").alias("predicted"),
        F.sum(F.when(F.col("side") == 0, F.col("right")).otherwise(0)).alias("right"),
    )
    precision, recall = safe_ratio(F.col("right"), F.col("predicted")), safe_ratio(F.col("right"), F.col("support"))
    return agg.select(
        "label", precision.alias("precision"), recall.alias("recall"),
        safe_ratio(2.0 * precision * recall, precision + recall).alias("f1"), "support",
    )


def roc_auc(df: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    return ranks.auc(df, score, F.col(label) == 1, by)


def rate(condition: Column) -> Column:
    return F.avg(condition.cast("double"))


def target_correlation(df: DataFrame, features: Sequence[str], target: Column, by: Sequence[str] = ()) -> DataFrame:
    """(by, feature, corr): NULL where either side is constant."""
    t = df.withColumn("__t", target.cast("double"))
    corr = lambda c: F.try_divide(F.covar_pop(c, "__t"), F.stddev_pop(c) * F.stddev_pop("__t"))
    wide = t.groupBy(*by).agg(*[corr(F.col(c).cast("double")).alias(c) for c in features])
    return wide.unpivot(list(by), list(features), "feature", "corr")


def seed_summary(df: DataFrame, by: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """Mean and sample deviation over seeds; 0 deviation below two values."""
    out = []
    for m in metrics:
        c = F.when(~F.isnan(F.col(m).cast("double")), F.col(m))
        out += [F.avg(c).alias(f"{m}_mean"), F.when(F.count(c) >= 2, F.stddev_samp(c)).otherwise(F.lit(0.0)).alias(f"{m}_std")]
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n_seeds"), *out)


# --- paired comparisons ----------------------------------------------------------------------


def pair_up(df: DataFrame, key: Sequence[str], side: str, first, second, value: str) -> DataFrame:
    """(key, a, b): mean value per key on each side, complete pairs only."""
    mean = lambda x: F.avg(F.when(F.col(side) == F.lit(x), F.col(value)))
    return df.groupBy(*key).agg(mean(first).alias("a"), mean(second).alias("b")).na.drop(subset=["a", "b"])


def paired_ttest(pairs: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """n, mean difference, t and p of a - b; NULL statistics below two pairs."""
    d = F.col("a") - F.col("b")
    s = pairs.groupBy(*by).agg(F.count(d).alias("n"), F.avg(d).alias("mean_diff"), F.stddev_samp(d).alias("sd"))
    s = s.withColumn("t", F.when(F.col("n") >= 2, F.try_divide(F.col("mean_diff"), F.col("sd") / F.sqrt("n"))))
    return s.select(*by, "n", "mean_diff", "t", student_t_udf("t", F.col("n") - 1).alias("p"))


def wilcoxon(pairs: DataFrame) -> DataFrame:
    """Signed-rank test of a - b: n without zeros, W+, W-, statistic, p."""
    d = pairs.select((F.col("a") - F.col("b")).alias("d"))
    zeros = d.agg(F.coalesce(F.sum((F.col("d") == 0).cast("long")), F.lit(0)).alias("zeros"))
    moved = d.filter(F.col("d") != 0).select(F.abs("d").alias("size"), F.when(F.col("d") > 0, 1).otherwise(0).alias("up"))
    c = ranks.cumulative(moved, "size", {"n": F.lit(1), "ups": F.col("up")})
    rank = F.col("n_below") + (F.col("n") + 1) / 2.0
    s = c.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum(rank * F.col("ups")), F.lit(0.0)).alias("w_plus"),
        F.coalesce(F.sum(rank * (F.col("n") - F.col("ups"))), F.lit(0.0)).alias("w_minus"),
        F.coalesce(F.sum(F.pow(F.col("n").cast("double"), F.lit(3.0)) - F.col("n")), F.lit(0.0)).alias("ties"),
    ).join(F.broadcast(zeros))  # one row each
    s = s.withColumn("statistic", F.least("w_plus", "w_minus"))
    exact = (F.col("n") <= 50) & (F.col("ties") == 0) & (F.col("zeros") == 0)
    return s.select("n", "w_plus", "w_minus", "statistic", wilcoxon_udf("statistic", "n", "ties", exact).alias("p"))


def run_summary(calls: DataFrame, by: Sequence[str] = ("provider", "model")) -> DataFrame:
    """Calls, latency, cost and tokens per group of a call log."""
    return calls.groupBy(*by).agg(
        F.count("latency_s").alias("n"), F.avg("latency_s").alias("mean_latency_s"), F.stddev_samp("latency_s").alias("std_latency_s"),
        F.avg("cost_usd").alias("mean_cost_usd"), F.avg("prompt_tokens").alias("mean_prompt_tokens"),
        F.avg("completion_tokens").alias("mean_completion_tokens"),
    )


def token_savings(verbose: Column, short: Column) -> Column:
    return F.try_divide(verbose - short, verbose) * 100.0


def extraction_summary(scores: DataFrame) -> DataFrame:
    return scores.groupBy("method").agg(
        F.count("latency_s").alias("n"), F.avg("latency_s").alias("mean_latency_s"), F.avg("success_rate").alias("mean_success_rate"),
        F.avg("mean_rel_err").alias("mean_rel_err"), F.avg("std_rel_err").alias("std_rel_err"),
    )


# --- train on one table, test on another --------------------------------------------------------


@dataclass
class LogisticModels:
    """Weights of one model per cell, the intercept last; a cell of one label has an infinite intercept."""

    by: list[str]
    weights: dict[tuple, np.ndarray]

    def score(self, df: DataFrame, features: str = "features") -> DataFrame:
        """Adds ``score``, the probability of label 1, and ``prediction``; rows of unknown cells have NULL."""
        spark = df.sparkSession
        key = [f"k{i} {df.schema[c].dataType.simpleString()}" for i, c in enumerate(self.by)]
        table = spark.createDataFrame([(*k, [float(x) for x in w]) for k, w in self.weights.items()], ", ".join([*key, "w array<double>"]))
        table = table.toDF(*self.by, "__w")  # one row per model
        inner = F.aggregate(F.zip_with(features, F.slice("__w", 1, F.size(features)), lambda x, w: x * w), F.lit(0.0), lambda acc, x: acc + x)
        df = df.join(F.broadcast(table), self.by, "left").withColumn("score", 1.0 / (1.0 + F.exp(-(inner + F.element_at("__w", -1)))))
        return df.withColumn("prediction", (F.col("score") > 0.5).cast("double")).drop("__w")


def fit_logistic(df: DataFrame, by: Sequence[str] = (), features: str = "features", label: str = "label", most: int = 100, tolerance: float = 1e-12) -> LogisticModels:
    """Logistic models of all cells ``by`` together, by Newton steps.

    Each step is one job: gradient and Hessian of every cell are summed per
    batch in NumPy, then over tasks, and solved for all cells on the driver
    (a few numbers per cell). The penalty is half the squared weights over the
    rows, without the intercept, on features as they are. ``label`` is 0 or 1.
    A step that raises the loss of a cell is halved.
    """
    by = list(by)
    rows = df.select(*by, F.col(features).cast("array<double>").alias("x"), F.col(label).cast("double").alias("y"))
    sizes = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("pos"), F.max(F.size("x")).alias("k")).collect()
    done: dict[tuple, np.ndarray] = {}
    now: dict[tuple, np.ndarray] = {}
    for r in sizes:
        cell, w = tuple(r[c] for c in by), np.zeros(r["k"] + 1)
        if 0 < r["pos"] < r["n"]:
            w[-1] = math.log(r["pos"] / (r["n"] - r["pos"]))
            now[cell] = w
        else:
            w[-1] = math.inf if r["pos"] else -math.inf
            done[cell] = w
    rest = {tuple(r[c] for c in by): r["n"] for r in sizes}
    last: dict[tuple, tuple[float, np.ndarray, np.ndarray]] = {}
    for _ in range(most):
        if not now:
            break
        found = _newton_sums(rows, by, dict(now))
        for cell, w in list(now.items()):
            k, flat = len(w), found[cell]
            penalty = np.append(np.full(k - 1, 1.0), 0.0)
            loss = flat[0] + 0.5 * float(penalty @ (w * w))
            if cell in last and loss > last[cell][0] + 1e-9 * abs(last[cell][0]):
                before, step = last[cell][1], last[cell][2] / 2
                now[cell], last[cell] = before + step, (last[cell][0], before, step)
                continue
            gradient = flat[1 : k + 1] + penalty * w
            step = -np.linalg.solve(flat[k + 1 :].reshape(k, k) + np.diag(penalty) + 1e-12 * np.eye(k), gradient)
            last[cell] = loss, w, step
            now[cell] = w + step
            if -float(gradient @ step) <= tolerance * rest[cell]:
                done[cell] = now.pop(cell)
    return LogisticModels(by, {**now, **done})


def _newton_sums(rows: DataFrame, by: list[str], weights: dict[tuple, np.ndarray]) -> dict[tuple, np.ndarray]:
    """Per cell: loss, gradient and Hessian, one after the other, without the penalty."""
    names = [*by, "at", "value"]
    schema = ", ".join([*[f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in by], "at int, value double"])
    kinds = [to_arrow_type(rows.schema[c].dataType) for c in by]

    def sums(batches):
        total: dict[tuple, np.ndarray] = {}
        for batch in batches:
            cells = list(zip(*(batch.column(i).to_pylist() for i in range(len(by))))) if by else [()] * batch.num_rows
            lists = batch.column(len(by))
            x = np.column_stack([lists.flatten().to_numpy().reshape(batch.num_rows, -1), np.ones(batch.num_rows)]) if batch.num_rows else None
            y = batch.column(len(by) + 1).to_numpy()
            where: dict[tuple, list[int]] = {}
            for i, cell in enumerate(cells):
                where.setdefault(cell, []).append(i)
            for cell, own in where.items():
                if cell not in weights:
                    continue
                a, t = x[own], y[own]
                z = a @ weights[cell]
                p = 1.0 / (1.0 + np.exp(-np.clip(z, -700, 700)))
                loss = float((np.logaddexp(0.0, z) - t * z).sum())
                hessian = (a * (p * (1 - p))[:, None]).T @ a
                made = np.concatenate([[loss], a.T @ (p - t), hessian.ravel()])
                total[cell] = total[cell] + made if cell in total else made
        for cell, made in total.items():
            columns = [pa.array([v] * len(made), k) for v, k in zip(cell, kinds)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(np.arange(len(made), dtype=np.int32)), pa.array(made)], names)

    out: dict[tuple, np.ndarray] = {}
    for r in rows.mapInArrow(sums, schema).groupBy(*by, "at").agg(F.sum("value").alias("value")).collect():
        cell = tuple(r[c] for c in by)
        k = len(weights[cell])
        out.setdefault(cell, np.zeros(1 + k + k * k))[r["at"]] = r["value"]
    return out


def train_and_score(train: DataFrame, test: DataFrame, continuous: Sequence[str], categorical: Sequence[str], target: str, encoders: dict) -> DataFrame:
    """Predictions (label, prediction, score) on ``test`` of a model of ``train``.

    L2 logistic regression with unit strength on unscaled features; codes come
    from the shared encoders.
    """
    def prepared(df):
        df = df.select(*[F.col(c).cast("double").alias(c) for c in continuous], *[F.col(c).cast("string").alias(c) for c in [*categorical, target]])
        for model in encoders.values():
            df = model.transform(df)
        inputs = [*continuous, *[f"{c}_code" for c in categorical]]
        return VectorAssembler(inputCols=inputs, outputCol="features").transform(df).select("features", F.col(f"{target}_code").alias("label"))

    fitted_on = prepared(train).persist()
    try:
        model = LogisticRegression(
            maxIter=1000, tol=1e-8, regParam=1.0 / max(fitted_on.count(), 1), elasticNetParam=0.0, standardization=False
        ).fit(fitted_on)
    finally:
        fitted_on.unpersist()
    scored = model.transform(prepared(test))
    return scored.select("label", "prediction", F.get(vector_to_array("probability"), F.lit(1)).alias("score"))
