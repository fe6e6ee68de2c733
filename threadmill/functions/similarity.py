"""Sequence similarity, for which Spark has no function: Arrow batches through the standard library's matcher."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType

from . import plain


@F.pandas_udf(DoubleType())
def message_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([plain.ratio(plain.similarity_text(x or ""), plain.similarity_text(y or "")) for x, y in zip(a, b)], dtype=float)


@F.pandas_udf(DoubleType())
def guard_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([plain.ratio(plain.guard_text(x or ""), plain.guard_text(y or "")) for x, y in zip(a, b)], dtype=float)


@F.pandas_udf(BooleanType())
def near_duplicates(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([plain.near_duplicates(x or "", y or "") for x, y in zip(a, b)], dtype=bool)
