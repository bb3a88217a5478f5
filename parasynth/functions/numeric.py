"""Normal distribution as column expressions.

Spark has no ``erf``, so it is written as a rational approximation that stays
inside whole-stage code generation.  It mentions its argument many times: pass a
plain column (or a lambda variable), never a large expression.
"""

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Hart's rational approximation of the normal tail (double precision), as
# published by G. West, "Better approximations to cumulative normal functions".
TAIL_NUMERATOR = (
    0.0352624965998911, 0.700383064443688, 6.37396220353165, 33.912866078383,
    112.079291497871, 221.213596169931, 220.206867912376,
)
TAIL_DENOMINATOR = (
    0.0883883476483184, 1.75566716318264, 16.064177579207, 86.7807322029461,
    296.564248779674, 637.333633378831, 793.826512519948, 440.413735824752,
)


def polynomial(coefficients, x):
    """Horner form, highest power first."""
    return reduce(lambda acc, c: acc * x + c, coefficients[1:], coefficients[0])


def norm_cdf(x: Column) -> Column:
    """Absolute error below 1e-11 everywhere.

    Branch-free on purpose: the JVM leaves methods of more than 8,000 bytes of
    bytecode uncompiled, and branches made this one too long for two columns.
    """
    a = F.least(F.abs(x), F.lit(38.0))
    tail = F.exp(a * a * -0.5) * polynomial(TAIL_NUMERATOR, a) / polynomial(TAIL_DENOMINATOR, a)
    return F.signum(x) * (F.lit(0.5) - tail) + 0.5


def clamp(x: Column, low: float, high: float) -> Column:
    """NULL stays NULL (``least`` and ``greatest`` alone would drop it)."""
    return F.when(x.isNotNull(), F.greatest(F.lit(low), F.least(F.lit(high), x)))


def safe_ratio(a: Column, b: Column, otherwise: float = 0.0) -> Column:
    return F.coalesce(F.try_divide(a, b), F.lit(otherwise))
