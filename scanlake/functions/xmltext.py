"""XML text helpers kept as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from scanlake.functions import as_col


def escape_attr(c) -> Column:
    """Escape a value for a double-quoted XML attribute (``&``, ``<``, ``>``, ``"``)."""
    x = as_col(c)
    x = F.replace(x, F.lit("&"), F.lit("&amp;"))
    x = F.replace(x, F.lit("<"), F.lit("&lt;"))
    x = F.replace(x, F.lit(">"), F.lit("&gt;"))
    return F.replace(x, F.lit('"'), F.lit("&quot;"))
