"""Category encode / decode as CASE expressions (no lookup joins, no Python)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _col(c):
    return F.col(c) if isinstance(c, str) else c


def encode(c: Column | str, mapping: Mapping[str, int]) -> Column:
    """Label -> code; case-sensitive, an unlisted label gives NULL."""
    s = _col(c)
    out = None
    for label, code in mapping.items():
        out = F.when(s == label, F.lit(code)) if out is None else out.when(s == label, F.lit(code))
    return out.cast("int")


def decode(c: Column | str, mapping: Mapping[str, int], on_unknown: str = "null") -> Column:
    """Code -> label.  ``on_unknown='error'`` raises on a non-NULL code that is not listed."""
    v = _col(c)
    out = None
    for label, code in mapping.items():
        out = F.when(v == code, F.lit(label)) if out is None else out.when(v == code, F.lit(label))
    if on_unknown == "error":
        out = out.when(v.isNotNull(), F.raise_error(F.concat(F.lit("unknown code: "), v.cast("string"))))
    elif on_unknown != "null":
        raise ValueError("on_unknown must be 'null' or 'error'")
    return out


def unmapped_report(df: DataFrame, encodings: Mapping[str, tuple[str, Mapping[str, int]]]) -> DataFrame:
    """Per source column: non-NULL labels that do not encode, counted in one pass."""
    aggs = []
    for src, (_dst, mapping) in encodings.items():
        s = F.col(src)
        aggs.append(F.count_if(s.isNotNull() & ~s.isin(list(mapping))).alias(src))
    wide = df.agg(*aggs)
    return wide.unpivot([], list(encodings), "column", "unmapped")
