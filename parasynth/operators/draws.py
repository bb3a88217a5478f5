"""Blocks of rows of one source as NumPy arrays: draw them, score them, run the loop on them.

The counters and formulas are those of :mod:`..functions.rng` and
:mod:`.synthesize`, so a block depends on keys and row numbers only. Scores
follow :mod:`.validate`; they are for tables of bounded length, whose columns a
task can sort.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from .. import fixed_values as fv
from ..functions import rng
from ..functions.numeric import TAIL_DENOMINATOR, TAIL_NUMERATOR, polynomial
from ..functions.special import chi2_sf, gamma_p, gamma_ppf, kolmogorov_sf

#: Rows drawn at a time, and most rows of a table that one task draws and scores as a whole.
CHUNK, WHOLE = 100_000, 1_000_000


# --- draws -----------------------------------------------------------------------------------


def uniforms(keys: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """One line of numbers in (0, 1) per line of four keys."""
    mask, low, high = np.uint64(rng.MASK), rows & np.uint64(rng.MASK), rows >> np.uint64(32)

    def mixed(x):
        return ((x ^ (x >> np.uint64(16))) * np.uint64(rng.MULTIPLIER)) & mask

    def chain(first, second):
        x = mixed(mixed(low[None, :] ^ first[:, None]))
        x = x ^ (x >> np.uint64(16)) ^ ((high[None, :] * np.uint64(rng.HIGH_WORD) + second[:, None]) & mask)
        x = mixed(mixed(x))
        return x ^ (x >> np.uint64(16))

    a, b = chain(keys[:, 0], keys[:, 1]), chain(keys[:, 2], keys[:, 3])
    return (a * np.uint64(1 << 20) + (b >> np.uint64(12)) + 0.5) / float(1 << 52)


def norm_cdf(x: np.ndarray) -> np.ndarray:
    a = np.minimum(np.abs(x), 38.0)
    tail = np.exp(a * a * -0.5) * polynomial(TAIL_NUMERATOR, a) / polynomial(TAIL_DENOMINATOR, a)
    return np.sign(x) * (0.5 - tail) + 0.5


class Source:
    """Parameters of one source, as a row of ``synthesize.source_rows``."""

    def __init__(self, row: dict):
        self.variables, self.keys = row["v"] or [], np.array([[k[f"k{w}"] for w in range(4)] for k in row["keys"] or []], np.uint64)
        self.factor = None if row["factor"] is None else np.array(row["factor"], float)
        self.cuts = [np.cumsum([c["prob"] for c in v["categories"]]) if v["distribution"] == "categorical" else None for v in self.variables]

    @staticmethod
    def low(v: dict) -> float:
        return v["min"] if v["min"] is not None else v["mean"] - v["std"] * fv.UNIFORM_HALF_WIDTH_STD

    @staticmethod
    def high(v: dict) -> float:
        return v["max"] if v["max"] is not None else v["mean"] + v["std"] * fv.UNIFORM_HALF_WIDTH_STD

    @staticmethod
    def proper_gamma(v: dict) -> bool:
        return v["distribution"] == "gamma" and v["mean"] > 0 and v["std"] > 0

    def draw(self, first: int, last: int, noise: float, step: object) -> np.ndarray:
        """A line per variable of the values of rows ``first`` to ``last`` - 1 of draw number ``step``."""
        salt = int(hashlib.md5(str(step).encode()).hexdigest()[:8], 16)
        u = uniforms(self.keys ^ np.uint64(salt), np.arange(first, last, dtype=np.uint64))
        size, angle = np.sqrt(-2.0 * np.log(u[0::2])), 2.0 * math.pi * u[1::2]
        g = np.empty_like(u)
        g[0::2], g[1::2] = size * np.cos(angle), size * np.sin(angle)
        z = g[: len(self.variables)]
        if self.factor is not None:
            z = self.factor @ z
        return np.stack([self._marginal(v, cuts, x, noise) for v, cuts, x in zip(self.variables, self.cuts, z)]) if len(z) else z

    def _marginal(self, v: dict, cuts: np.ndarray | None, z: np.ndarray, noise: float) -> np.ndarray:
        if v["distribution"] == "categorical":
            return np.minimum(np.searchsorted(cuts, norm_cdf(z), side="right"), len(cuts) - 1).astype(float)
        if v["distribution"] == "uniform":
            low, high = self.low(v), self.high(v)
            spread = (high - low) * noise * 0.5
            return low - spread + norm_cdf(z) * (high - low + spread * 2.0)
        if self.proper_gamma(v):
            return gamma_ppf(np.full(len(z), (v["mean"] / v["std"]) ** 2), norm_cdf(z)) * (v["std"] * v["std"] / v["mean"])
        return v["mean"] + v["std"] * (noise + 1.0) * z

    # --- scores ------------------------------------------------------------------------------

    @classmethod
    def position(cls, v: dict, x: np.ndarray) -> np.ndarray | None:
        """Each value's place in its distribution; None where the declared deviation or width is 0."""
        if v["distribution"] == "uniform":
            low, width = cls.low(v), cls.high(v) - cls.low(v)
            return np.clip((x - low) / width, 0.0, 1.0) if width else None
        if cls.proper_gamma(v):
            return gamma_p(np.full(len(x), (v["mean"] / v["std"]) ** 2), x / (v["std"] * v["std"] / v["mean"]))
        return norm_cdf((x - v["mean"]) / v["std"]) if v["std"] else None

    def _fits(self, v: dict, x: np.ndarray) -> float:
        """The p-value of one variable's column."""
        if v["distribution"] == "categorical":
            share = np.array([c["prob"] for c in v["categories"]])
            expected = share * len(x)
            if not len(x) or expected.min() <= 0:
                return 0.0
            seen = np.bincount(x.astype(int), minlength=len(share))
            return 1.0 if len(share) == 1 else chi2_sf(float(((seen - expected) ** 2 / expected).sum()), len(share) - 1)
        u = self.position(v, x)
        if u is None or not len(u):
            return 0.0
        u, n = np.sort(u), len(u)
        i = np.arange(1, n + 1)
        return kolmogorov_sf(float(max((i / n - u).max(), (u - (i - 1) / n).max())), n)

    @staticmethod
    def _biased(v: dict, x: np.ndarray) -> bool:
        if v["distribution"] == "categorical":
            share = np.array([c["prob"] for c in v["categories"]])
            return bool(not len(x) or (np.abs(np.bincount(x.astype(int), minlength=len(share)) / len(x) - share) > fv.BIAS_FREQUENCY).any())
        return bool(len(x) and abs(x.mean() - v["mean"]) / (abs(v["mean"]) or v["std"] or 1.0) > fv.BIAS_RELATIVE_MEAN)

    def score(self, x: np.ndarray, wanted: dict[tuple[int, int], float], least_p: float) -> float:
        """Overall fidelity of a table, a line per variable, as ``validate.validate`` gives it before rounding."""
        fit = 100.0 * np.mean([self._fits(v, c) >= least_p for v, c in zip(self.variables, x)])
        similar, k = 1.0, len(self.variables)
        if k > 1:
            near = x - x.mean(axis=1, keepdims=True)
            norm = np.sqrt((near * near).sum(axis=1))
            i, j = np.triu_indices(k, 1)
            with np.errstate(invalid="ignore", divide="ignore"):
                r = (near @ near.T)[i, j] / (norm[i] * norm[j])
            r = np.where(np.isfinite(r), r, 0.0)
            target = np.array([wanted.get(pair, 0.0) for pair in zip(i.tolist(), j.tolist())])
            similar = min(1.0, max(0.0, 1.0 - float(np.abs(r - target).mean()) / 2.0))
        bias = 1.0 - float(np.mean([self._biased(v, c) for v, c in zip(self.variables, x)]))
        return fit * fv.WEIGHT_FIT + similar * 100.0 * fv.WEIGHT_CORRELATION + bias * 100.0 * fv.WEIGHT_BIAS


# --- Arrow batches -------------------------------------------------------------------------------


def drawn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of ``source_rows`` with ``noise``, ``step``, ``first``, ``last`` to (source_id, row_id, x)."""
    for batch in batches:
        for row in batch.to_pylist():
            x = Source(row).draw(row["first"], row["last"], row["noise"], row["step"])
            k, n = x.shape
            flat = pa.ListArray.from_arrays(pa.array(np.arange(0, k * n + 1, k, dtype=np.int32) if k else np.zeros(n + 1, np.int32)), pa.array(x.T.ravel()))
            yield pa.RecordBatch.from_arrays([pa.repeat(pa.scalar(row["source_id"], pa.string()), n), pa.array(np.arange(row["first"], row["last"])), flat], ["source_id", "row_id", "x"])


STEPS = (
    "source_id string, iteration int, noise_level double, score double, improved boolean, approved boolean, "
    "best_score double, best_iteration int, best_noise double, noise double, streak long"
)


def looped(n_rows: int, least_p: float, least_score: float):
    """Runs the loop of each source: rows of ``source_rows`` with state, pairs and number of steps to STEPS."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            steps: list[tuple] = []
            for row in batch.to_pylist():
                source, noise, streak = Source(row), row["noise"], row["streak"]
                best, best_at, best_noise = row["best_score"], row["best_iteration"], row["best_noise"]
                wanted = {(p["i"], p["j"]): p["r"] for p in row["pairs"] or [] if p["i"] != p["j"]}
                for iteration in range(row["next_iteration"], row["next_iteration"] + row["steps"]):
                    parts = [source.draw(at, min(at + CHUNK, n_rows), noise, iteration) for at in range(0, n_rows, CHUNK)] if source.variables else []
                    exact = source.score(np.concatenate(parts, axis=1), wanted, least_p) if parts else None
                    score = fv.START_SCORE if exact is None else math.floor(exact * 100 + 0.5) / 100
                    used, better = noise, score > best
                    if better:
                        best, best_at, best_noise, streak = score, iteration, noise, 0
                    else:
                        streak += 1
                        if streak % (2 * fv.PATIENCE) == 0:
                            noise = fv.INITIAL_NOISE
                        elif streak % fv.PATIENCE == 0:
                            noise = max(noise * fv.NOISE_DOWN, fv.MIN_NOISE)
                        else:
                            noise = min(noise * fv.NOISE_UP, fv.MAX_NOISE)
                    steps.append((row["source_id"], iteration, used, score, better, None if exact is None else exact >= least_score, best, best_at, best_noise, noise, streak))
            kinds = [pa.string(), pa.int32(), *[pa.float64()] * 2, *[pa.bool_()] * 2, pa.float64(), pa.int32(), *[pa.float64()] * 2, pa.int64()]
            columns = list(zip(*steps)) or [[]] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], [c.split()[0] for c in STEPS.split(", ")])

    return run
