"""Number formatting."""

from pyspark.sql import Column
from pyspark.sql import functions as F

SPLITTER = 134217729.0  # 2**27 + 1


def fixed4(x: Column) -> Column:
    """Four decimals, ties decided by the exact binary value, then to even.

    ``format_string`` alone rounds the shortest decimal form half up, so a
    value a hair below a tie would come out one unit higher.  The product with
    10,000 is therefore formed together with its exact rounding error.
    """
    p = x * 10000.0
    high = x * SPLITTER - (x * SPLITTER - x)
    error = (high * 10000.0 - p) + (x - high) * 10000.0
    below = F.floor(p).cast("double")
    tie = p - below == 0.5
    units = F.when(tie & (error > 0), below + 1.0).when(tie & (error < 0), below).otherwise(F.rint(p))
    return F.format_string("%.4f", F.when(F.abs(x) < 1e11, units / 10000.0).otherwise(x))
