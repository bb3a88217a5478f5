"""Parameter tables to correlated data (Gaussian copula).

Rows are a map over row numbers: correlated normals, then each marginal as the
inverse of its distribution function at the normal's position.  This has the
law of sorting draws into the order of the normals, without any sort, so
generation has no shuffle at all.  :func:`rank_match` does the sorted placement
where a given column has to be the marginal.
"""

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import fixed_values as fv
from ..functions import ranks, rng
from ..functions.numeric import norm_cdf
from ..functions.special import gamma_ppf_udf
from ..params import Parameters, Variable
from ..session import sealed
from . import draws

MANY_LABELS = 64
ROW_BLOCK = 10_000


def normal_quantile(p: float) -> float:
    """Scalar quantile for thresholds (driver side)."""
    from statistics import NormalDist

    if p <= 0.0:
        return -math.inf
    return math.inf if p >= 1.0 else NormalDist().inv_cdf(p)


def _label(position: Column, cuts: list[float], labels: list[str]) -> Column:
    """Label of the interval that ``position`` falls in."""
    if len(labels) <= MANY_LABELS:
        chosen = F.lit(labels[-1])
        for cut, label in reversed(list(zip(cuts[:-1], labels[:-1]))):
            chosen = F.when(position < cut, F.lit(label)).otherwise(chosen)
        return chosen
    edges, names = np.array(cuts[:-1]), np.array(labels, dtype=object)

    @F.pandas_udf(T.StringType())
    def pick(x: pd.Series) -> pd.Series:
        return pd.Series(names[np.searchsorted(edges, x.to_numpy(), side="right")])

    return pick(position)


def _check(parameters: Parameters) -> None:
    bad = [v.name for v in parameters.variables if v.distribution != "categorical" and v.std < 0]
    if bad:
        raise ValueError(f"negative standard deviation: {', '.join(bad)}")


def synthesize(
    spark: SparkSession,
    parameters: Parameters,
    n_rows: int = fv.DEFAULT_ROWS,
    noise: float = fv.INITIAL_NOISE,
    seed: int = fv.DEFAULT_SEED,
    iteration: int = 0,
    partitions: int | None = None,
    keep_row_id: bool = False,
) -> DataFrame:
    """One column per variable; no variables give an empty frame."""
    if not parameters.variables:
        return spark.createDataFrame([], T.StructType([]))
    _check(parameters)
    rows = spark.range(0, n_rows, 1, partitions) if partitions else spark.range(n_rows)
    return _generate(rows.withColumnRenamed("id", "row_id"), parameters, noise, seed, iteration, keep_row_id)


def _generate(rows: DataFrame, parameters: Parameters, noise: float, seed: int, iteration: int, keep: bool) -> DataFrame:
    variables, factor = parameters.variables, parameters.factor()
    k = len(variables)
    apart = [np.count_nonzero(factor[i]) == 1 and np.count_nonzero(factor[:, i]) == 1 and factor[i, i] == 1.0 for i in range(k)]
    by_normal = [not apart[i] or _is_normal(v) for i, v in enumerate(variables)]
    keys = [rng.keys(seed, iteration, i) for i in range(k)]
    df = rng.with_normals(rows, "row_id", {f"__g{i}": keys[i] for i in range(k) if by_normal[i]})
    df = rng.with_uniforms(df, "row_id", {f"__p{i}": keys[i] for i in range(k) if not by_normal[i]})
    mixed = {}
    for i in range(k):
        if by_normal[i]:
            terms = [F.col(f"__g{j}") * float(factor[i, j]) for j in range(i + 1) if factor[i, j]]
            mixed[f"__z{i}"] = sum(terms[1:], terms[0])
    if mixed:
        df = df.withColumns(mixed)
    placed = {
        f"__p{i}": norm_cdf(F.col(f"__z{i}"))
        for i, v in enumerate(variables)
        if by_normal[i] and (v.distribution == "uniform" or v.proper_gamma)
    }
    if placed:
        df = df.withColumns(placed)
    columns = [_marginal(v, i, by_normal[i], noise).alias(v.name) for i, v in enumerate(variables)]
    return sealed(df.select(*(["row_id"] if keep else []), *columns))


def _is_normal(v: Variable) -> bool:
    return v.distribution == "normal" or (v.distribution == "gamma" and not v.proper_gamma)


def _marginal(v: Variable, i: int, by_normal: bool, noise: float) -> Column:
    if v.distribution == "categorical":
        labels = [label for label, _ in v.categories]
        shares = np.cumsum([p for _, p in v.categories])
        if by_normal:
            return _label(F.col(f"__z{i}"), [normal_quantile(c) for c in shares], labels)
        return _label(F.col(f"__p{i}"), [float(c) for c in shares], labels)
    if v.distribution == "uniform":
        spread = (v.high - v.low) * noise * 0.5
        return F.col(f"__p{i}") * (v.high - v.low + 2 * spread) + (v.low - spread)
    if v.proper_gamma:
        return gamma_ppf_udf(F.col(f"__p{i}"), F.lit((v.mean / v.std) ** 2), F.lit(v.std**2 / v.mean))
    return F.col(f"__z{i}") * (v.std * (1 + noise)) + v.mean


def synthesize_independent(spark: SparkSession, parameters: Parameters, n_rows: int, seed: int, noise: float = fv.INITIAL_NOISE) -> DataFrame:
    """Same marginals, correlations left out."""
    return synthesize(spark, parameters.without_correlations(), n_rows, noise, seed)


# --- many sources at once -----------------------------------------------------------


@F.pandas_udf(T.ArrayType(T.ArrayType(T.DoubleType())))
def _factor_udf(size: pd.Series, first: pd.Series, second: pd.Series, value: pd.Series) -> pd.Series:
    """Cholesky factor per source; NULL where the matrix has none."""
    out = []
    for k, a, b, r in zip(size, first, second, value):
        matrix = np.eye(int(k))
        for i, j, x in zip(a, b, r):
            matrix[int(i), int(j)] = matrix[int(j), int(i)] = x
        try:
            out.append([row.tolist() for row in np.linalg.cholesky(matrix)])
        except np.linalg.LinAlgError:
            out.append(None)
    return pd.Series(out)


def indexed(variables: DataFrame) -> DataFrame:
    """Add ``idx``: the place of a variable in its source, from 0."""
    place = Window.partitionBy("source_id").orderBy("var_pos")
    return variables.withColumn("idx", F.row_number().over(place) - 1)


def declared_pairs(variables: DataFrame, correlations: DataFrame) -> DataFrame:
    """(source_id, i, j, r) with i <= j, for pairs whose names both exist.

    Of several entries for a pair the last one counts.
    """
    names = indexed(variables).select("source_id", "name", "idx")
    first = names.select("source_id", F.col("name").alias("var1"), F.col("idx").alias("a"))
    second = names.select("source_id", F.col("name").alias("var2"), F.col("idx").alias("b"))
    found = correlations.join(first, ["source_id", "var1"]).join(second, ["source_id", "var2"])
    return found.groupBy("source_id", F.least("a", "b").alias("i"), F.greatest("a", "b").alias("j")).agg(
        F.max_by("correlation", "corr_pos").alias("r")
    )


def source_rows(variables: DataFrame, correlations: DataFrame, seed: int) -> DataFrame:
    """One row per source: ordered variables, stream keys, Cholesky factor."""
    v = variables.groupBy("source_id").agg(
        F.array_sort(F.collect_list(F.struct("var_pos", "name", "distribution", "mean", "std", "min", "max", "categories"))).alias("v")
    )
    pairs = declared_pairs(variables, correlations).groupBy("source_id").agg(
        F.collect_list("i").alias("i"), F.collect_list("j").alias("j"), F.collect_list("r").alias("r")
    )
    sizes = variables.groupBy("source_id").agg(F.count(F.lit(1)).alias("k"))
    factors = pairs.join(sizes, "source_id").select("source_id", _factor_udf("k", "i", "j", "r").alias("factor"))
    both = v.join(factors, "source_id", "left")
    digest = lambda i: F.md5(F.concat_ws("|", F.lit(str(seed)), "source_id", F.lit(""), i.cast("string")))
    word = lambda d, w: F.conv(F.substring(d, 8 * w + 1, 8), 16, 10).cast("long").alias(f"k{w}")
    even = F.size("v") + F.size("v") % 2
    digests = F.transform(F.sequence(F.lit(0), even - 1), digest)
    both = both.withColumn("keys", F.transform(digests, lambda d: F.struct(*[word(d, w) for w in range(4)])))
    return both.select("source_id", "v", "factor", "keys")


def synthesize_many(
    variables: DataFrame,
    correlations: DataFrame,
    n_rows: int = fv.DEFAULT_ROWS,
    noise: float | DataFrame = fv.INITIAL_NOISE,
    seed: int = fv.DEFAULT_SEED,
    iteration: int | str = 0,
) -> DataFrame:
    """(source_id, row_id, x): one vector per row, labels as codes.

    ``noise`` may be a table (source_id, noise[, iteration]) for a level (and a
    draw number) per source.  Sources without variables give no rows.  Work is
    spread by blocks of rows, so one source may want most of the rows.
    """
    if n_rows <= 0:
        return variables.sparkSession.createDataFrame([], "source_id string, row_id bigint, x array<double>")
    if isinstance(noise, DataFrame):
        step = F.col("iteration") if "iteration" in noise.columns else F.lit(iteration)
        tagged = noise.select("source_id", "noise", step.cast("string").alias("step"))
        base = source_rows(variables.join(tagged, "source_id", "left_semi"), correlations, seed).join(tagged, "source_id")
    else:
        base = source_rows(variables, correlations, seed).withColumns({"noise": F.lit(float(noise)), "step": F.lit(str(iteration))})
    blocks = -(-n_rows // ROW_BLOCK)
    # Two steps, so that no row holds one number per block of a very long table.
    strides = -(-blocks // ROW_BLOCK)
    df = base.withColumn("stride", F.explode(F.sequence(F.lit(0), F.lit(strides - 1)).cast("array<bigint>")))
    start = F.col("stride") * ROW_BLOCK
    df = df.withColumn("block", F.explode(F.sequence(start, F.least(start + ROW_BLOCK, F.lit(blocks)) - 1))).drop("stride")
    df = spread_out(df, "source_id", "block")
    first = F.col("block") * ROW_BLOCK
    df = df.select("source_id", "v", "factor", "keys", "noise", "step", first.alias("first"), F.least(first + ROW_BLOCK, F.lit(n_rows)).alias("last"))
    made = df.mapInArrow(draws.drawn, "source_id string, row_id bigint, x array<double>")
    made.drawn_from = df
    return made


def blocks_of(vectors: DataFrame) -> DataFrame | None:
    """The blocks that ``synthesize_many`` drew just these vectors from; None for any other vectors."""
    blocks = vars(vectors).get("drawn_from")
    return blocks if isinstance(blocks, DataFrame) else None


def spread_out(df: DataFrame, *by: str) -> DataFrame:
    """A number of partitions keeps adaptive execution from merging rows of few bytes that stand for much work."""
    spark = df.sparkSession
    return df.repartition(max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))), *by)


def wide_form(vectors: DataFrame, parameters: Parameters, keep: Sequence[Column] = ()) -> DataFrame:
    """Vectors of sources with these variables as a table with a column per variable, labels spelled out."""
    columns = [*keep]
    for i, v in enumerate(parameters.variables):
        cell = F.get("x", F.lit(i))
        if v.distribution == "categorical":
            cell = F.get(F.array(*[F.lit(label) for label, _ in v.categories]), cell.cast("int"))
        columns.append(cell.alias(v.name))
    return vectors.select(*columns)


def long_form(vectors: DataFrame, variables: DataFrame) -> DataFrame:
    """(source_id, row_id, name, num_value, str_value)."""
    listed = variables.groupBy("source_id").agg(
        F.array_sort(F.collect_list(F.struct("var_pos", "name", "distribution", "categories"))).alias("v")
    )
    cells = vectors.join(listed, "source_id").select("source_id", "row_id", "v", F.posexplode("x").alias("i", "value"))
    cells = cells.withColumn("e", F.get("v", F.col("i")))
    categorical = F.col("e.distribution") == "categorical"
    return cells.select(
        "source_id", "row_id", F.col("e.name").alias("name"),
        F.when(~categorical, F.col("value")).alias("num_value"),
        F.when(categorical, F.get(F.col("e.categories"), F.col("value").cast("int"))["label"]).alias("str_value"),
    )


# --- placement by rank, copula fitted on rows -----------------------------------------


def rank_match(df: DataFrame, order_col: str, row: str, values: DataFrame, value_col: str) -> DataFrame:
    """The row with the r-th smallest ``order_col`` gets the r-th smallest value.

    Where the sides differ in size, ranks are scaled to the number of values.
    """
    ranked = ranks.ordinal_rank(df, order_col, row, "rank")
    n_rows, n_values = df.count(), values.filter(F.col(value_col).isNotNull()).count()
    if n_rows != n_values:
        ranked = ranked.withColumn("rank", F.ceil(F.col("rank") * (n_values / n_rows)).cast("long"))
        ranked = ranked.withColumn("rank", F.greatest(F.lit(1), F.least(F.col("rank"), F.lit(n_values))).cast("long"))
    return ranks.value_at_rank(ranked, "rank", values, value_col)


@dataclass
class FittedCopula:
    continuous: dict[str, list[float]]  # column -> quantiles on an even grid
    categorical: dict[str, list[tuple[str, float]]]
    correlation: np.ndarray
    names: list[str]


def fit_copula(df: DataFrame, continuous: Sequence[str], categorical: Sequence[str] = (), grid: int = 500) -> FittedCopula:
    """Marginals and normal-score correlations of real rows.

    Scores use mid-ranks of a quantile grid, so scoring is a map over the rows
    and the correlations are one aggregation; no column is sorted.
    """
    names = [*continuous, *categorical]
    df = df.na.drop(subset=names).select(
        *[F.col(c).cast("double").alias(c) for c in continuous], *[F.col(c).cast("string").alias(c) for c in categorical]
    )
    steps = [i / grid for i in range(grid + 1)]
    quantiles = dict(zip(continuous, df.approxQuantile(list(continuous), steps, 0.25 / grid))) if continuous else {}
    shares = {
        c: [(r[0], r[1]) for r in df.groupBy(c).count().orderBy(c).collect()] for c in categorical  # labels, not rows
    }
    cut = {c: sorted(set(q[1:-1])) for c, q in quantiles.items()}
    binned = df
    for c, edges in cut.items():
        binned = Bucketizer(splits=[-math.inf, *edges, math.inf], inputCol=c, outputCol=f"__b_{c}").transform(binned)
    scores = {}
    for c in continuous:
        counts = {int(r[0]): r[1] for r in binned.groupBy(f"__b_{c}").count().collect()}  # at most ``grid`` rows
        scores[c] = _mid_scores([counts.get(i, 0) for i in range(len(cut[c]) + 1)])
    for c in categorical:
        scores[c] = _mid_scores([n for _, n in shares[c]])
    scored = binned.select(
        *[F.get(F.array(*[F.lit(s) for s in scores[c]]), F.col(f"__b_{c}").cast("int")).alias(c) for c in continuous],
        *[
            F.element_at(F.create_map(*[F.lit(x) for (label, _), s in zip(shares[c], scores[c]) for x in (label, s)]), F.col(c)).alias(c)
            for c in categorical
        ],
    )
    k = len(names)
    pairs = [(i, j) for i in range(k) for j in range(i + 1, k)]
    matrix = np.eye(k)
    if pairs:
        row = scored.agg(*[
            F.try_divide(F.covar_pop(names[i], names[j]), F.stddev_pop(names[i]) * F.stddev_pop(names[j])).alias(f"r{i}_{j}")
            for i, j in pairs
        ]).first()
        for i, j in pairs:
            matrix[i, j] = matrix[j, i] = row[f"r{i}_{j}"] or 0.0
    marginals = {c: [(label, n / sum(m for _, m in shares[c])) for label, n in shares[c]] for c in categorical}
    return FittedCopula(quantiles, marginals, matrix, names)


def _mid_scores(counts: list[int]) -> list[float]:
    total, below, out = sum(counts), 0, []
    for n in counts:
        out.append(normal_quantile((below + max(n, 1e-9) / 2) / total) if total else 0.0)
        below += n
    return out


def sample_copula(spark: SparkSession, fitted: FittedCopula, n_rows: int, seed: int) -> DataFrame:
    """Rows with the fitted correlations and the real columns' own marginals."""
    try:
        factor = np.linalg.cholesky(fitted.correlation)
    except np.linalg.LinAlgError:
        factor = np.eye(len(fitted.names))
    names = fitted.names
    df = rng.with_normals(
        spark.range(n_rows).withColumnRenamed("id", "row_id"), "row_id",
        {f"__g{i}": rng.keys(seed, "copula", i) for i in range(len(names))},
    )
    mixed = {}
    for i in range(len(names)):
        terms = [F.col(f"__g{j}") * float(factor[i, j]) for j in range(i + 1)]
        mixed[f"__z{i}"] = sum(terms[1:], terms[0])
    df = df.withColumns(mixed)
    positions = {f"__p{i}": norm_cdf(F.col(f"__z{i}")) for i, c in enumerate(names) if c in fitted.continuous}
    if positions:
        df = df.withColumns(positions)
    columns = []
    for i, c in enumerate(names):
        if c in fitted.continuous:
            q = fitted.continuous[c]
            place = F.col(f"__p{i}") * float(len(q) - 1)
            low = F.least(F.floor(place), F.lit(len(q) - 2)).cast("int")
            table = F.array(*[F.lit(float(x)) for x in q])
            columns.append((F.get(table, low) + (place - low) * (F.get(table, low + 1) - F.get(table, low))).alias(c))
        else:
            shares = np.cumsum([p for _, p in fitted.categorical[c]])
            columns.append(_label(F.col(f"__z{i}"), [normal_quantile(s) for s in shares], [l for l, _ in fitted.categorical[c]]).alias(c))
    return sealed(df.select("row_id", *columns))
