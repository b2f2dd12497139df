"""Reproducible draws: the same seed and id give the same number on any cluster."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_BITS = 52


def seeded_uniform(seed: int, *parts: Column | str) -> Column:
    """A number in [0, 1) from the first 13 hex digits (52 bits) of an md5.

    Parts must be integers or text: doubles print differently between engines.
    """
    cols = [F.col(p) if isinstance(p, str) else p for p in parts]
    text = F.concat_ws("|", F.lit(str(seed)), *[c.cast("string") for c in cols])
    return F.conv(F.substring(F.md5(text), 1, _BITS // 4), 16, 10).cast("double") / F.lit(float(2**_BITS))
