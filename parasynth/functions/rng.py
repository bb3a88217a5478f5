"""Counter-based random numbers.

A draw is a pure function of (key, row number): the same whatever the number
of partitions, recomputed the same after an executor is lost, and plain 64-bit
integer arithmetic, so it stays in generated code and any SQL engine can repeat
it.  ``rand(seed)`` has none of the first two properties.

The hash is the well-known 32-bit multiply / xor-shift mixer.  Two independent
chains give 52 random bits per uniform.
"""

import hashlib
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MASK = 0xFFFFFFFF
MULTIPLIER = 0x45D9F3B  # below 2**31: the product stays inside a signed 64-bit integer
HIGH_WORD = 0x2545F491


def keys(*parts) -> tuple[int, int, int, int]:
    """Four 32-bit keys for one stream, from its name parts."""
    digest = hashlib.md5("|".join(str(p) for p in parts).encode()).hexdigest()
    return tuple(int(digest[i : i + 8], 16) for i in (0, 8, 16, 24))


def _low(row: Column, key) -> Column:
    return row.bitwiseAND(F.lit(MASK)).bitwiseXOR(key)


def _round(x: Column) -> Column:
    return (x.bitwiseXOR(F.shiftright(x, 16)) * F.lit(MULTIPLIER)).bitwiseAND(F.lit(MASK))


def _absorb(x: Column, row: Column, key) -> Column:
    high = F.shiftright(row, 32).bitwiseAND(F.lit(MASK))
    word = (high * F.lit(HIGH_WORD) + key).bitwiseAND(F.lit(MASK))
    return x.bitwiseXOR(F.shiftright(x, 16)).bitwiseXOR(word)


def _fold(x: Column) -> Column:
    return x.bitwiseXOR(F.shiftright(x, 16))


def _join(a: Column, b: Column) -> Column:
    return ((a * F.lit(1 << 20) + F.shiftright(b, 12)).cast("double") + 0.5) / float(1 << 52)


def _key(value) -> Column:
    return value if isinstance(value, Column) else F.lit(value).cast("long")


def with_uniforms(df: DataFrame, row: str, streams: dict[str, tuple]) -> DataFrame:
    """Add one uniform column in (0, 1) per stream name -> four keys.

    Every mixing step is one projection over all streams, so no expression
    repeats another and the whole chain compiles into a single stage.
    """
    if not streams:
        return df
    r = F.col(row)
    word = {}
    for name, k in streams.items():
        word[f"__{name}_a"] = (_key(k[0]), _key(k[1]))
        word[f"__{name}_b"] = (_key(k[2]), _key(k[3]))
    df = df.withColumns({c: _low(r, k[0]) for c, k in word.items()})
    for step in (_round, _round):
        df = df.withColumns({c: step(F.col(c)) for c in word})
    df = df.withColumns({c: _absorb(F.col(c), r, k[1]) for c, k in word.items()})
    for step in (_round, _round, _fold):
        df = df.withColumns({c: step(F.col(c)) for c in word})
    df = df.withColumns({name: _join(F.col(f"__{name}_a"), F.col(f"__{name}_b")) for name in streams})
    return df.drop(*word)


def with_normals(df: DataFrame, row: str, streams: dict[str, tuple]) -> DataFrame:
    """Add one standard normal column per stream (Box-Muller on pairs).

    Two streams share two uniforms (cosine and sine branch), so this costs one
    uniform per normal and very little code.
    """
    names = list(streams)
    uniforms = {f"__u_{n}": streams[n] for n in names}
    if len(names) % 2:
        uniforms["__u_spare"] = tuple(k ^ 0x5BD1E995 for k in streams[names[-1]])
    df = with_uniforms(df, row, uniforms)
    sources = list(uniforms)
    out = {}
    for i, name in enumerate(names):
        first, second = F.col(sources[i - i % 2]), F.col(sources[i - i % 2 + 1])
        out[name] = box_muller(first, second, i % 2 == 0)
    return df.withColumns(out).drop(*sources)


def box_muller(u: Column, v: Column, cosine: bool) -> Column:
    angle = v * F.lit(2.0 * math.pi)
    return F.sqrt(F.ln(u) * -2.0) * (F.cos(angle) if cosine else F.sin(angle))


def hash_order(df: DataFrame, row: str, seed: int, name: str, label: str = "order") -> DataFrame:
    """Add a reproducible random order key for sampling and splitting."""
    return with_uniforms(df, row, {name: keys(seed, label)})
