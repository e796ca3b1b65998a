"""Output normalisation shared by registered queries and their SQL checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DIGITS = 4


def round_col(c, digits: int = DIGITS):
    """Round half away from zero on the binary value: ``round(x·10^d)/10^d``.

    Plain ``F.round(x, d)`` rounds the shortest decimal string of ``x``, which
    breaks exact binary ties (unit prices such as 10279.09875) differently from
    most SQL engines; scaling first makes both sides round the same double.
    """
    m = float(10 ** digits)
    c = F.col(c) if isinstance(c, str) else c
    r = F.round(c * F.lit(m)) / F.lit(m)
    return F.when(r == 0, F.lit(0.0)).otherwise(r)  # one zero: -0.0 → 0.0


def rounded(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Round every double column (top level) to ``digits`` decimals."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(round_col(f.name, digits).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)
