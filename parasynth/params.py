"""Parameters of one source on the driver: a handful of values, never data."""

import warnings
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import fixed_values as fv
from .schemas import CORRELATIONS, VARIABLES


@dataclass
class Variable:
    name: str
    distribution: str = "normal"
    mean: float = 0.0
    std: float = 1.0
    min: float | None = None
    max: float | None = None
    categories: list[tuple[str, float]] | None = None

    def __post_init__(self):
        if self.distribution not in fv.DISTRIBUTIONS:
            self.distribution = fv.DEFAULT_DISTRIBUTION
        if self.categories:
            total = sum(p for _, p in self.categories)
            self.categories = [(l, p / total) for l, p in self.categories] if total > 0 else None
        if self.distribution == "categorical" and not self.categories:
            self.distribution = fv.DEFAULT_DISTRIBUTION

    @property
    def low(self) -> float:
        return self.min if self.min is not None else self.mean - fv.UNIFORM_HALF_WIDTH_STD * self.std

    @property
    def high(self) -> float:
        return self.max if self.max is not None else self.mean + fv.UNIFORM_HALF_WIDTH_STD * self.std

    @property
    def proper_gamma(self) -> bool:
        return self.distribution == "gamma" and self.mean > 0 and self.std > 0


@dataclass
class Parameters:
    variables: list[Variable]
    correlations: list[tuple[str, str, float]] = field(default_factory=list)
    source_id: str = "table"

    @property
    def names(self) -> list[str]:
        return [v.name for v in self.variables]

    def correlation_matrix(self) -> np.ndarray:
        index = {n: i for i, n in enumerate(self.names)}
        matrix = np.eye(len(index))
        for a, b, r in self.correlations:
            if a in index and b in index:
                matrix[index[a], index[b]] = matrix[index[b], index[a]] = r
        return matrix

    def factor(self) -> np.ndarray:
        """Lower Cholesky factor; the identity (with a warning) if there is none."""
        try:
            return np.linalg.cholesky(self.correlation_matrix())
        except np.linalg.LinAlgError:
            warnings.warn(
                "Correlation matrix is not positive-definite; variables are generated independently.",
                RuntimeWarning, stacklevel=3,
            )
            return np.eye(len(self.variables))

    def without_correlations(self) -> "Parameters":
        return Parameters(self.variables, [], self.source_id)

    def tables(self, spark: SparkSession) -> tuple[DataFrame, DataFrame]:
        variables = [
            (self.source_id, i, v.name, v.distribution, float(v.mean), float(v.std), v.min, v.max, v.categories)
            for i, v in enumerate(self.variables)
        ]
        correlations = [
            (self.source_id, i, f"{a}__{b}", a, b, float(r), "positive" if r >= 0 else "negative")
            for i, (a, b, r) in enumerate(self.correlations)
        ]
        return spark.createDataFrame(variables, VARIABLES), spark.createDataFrame(correlations, CORRELATIONS)


def load(variables: DataFrame, correlations: DataFrame, source_id: str = "table") -> Parameters:
    """Bring one source's parameters to the driver."""
    v = variables.filter(F.col("source_id") == source_id).orderBy("var_pos").collect()
    c = correlations.filter(F.col("source_id") == source_id).orderBy("corr_pos").collect()
    return Parameters(
        [
            Variable(r.name, r.distribution, r.mean, r.std, r.min, r.max,
                     [(x.label, x.prob) for x in r.categories] if r.categories else None)
            for r in v
        ],
        [(r.var1, r.var2, r.correlation) for r in c],
        source_id,
    )
