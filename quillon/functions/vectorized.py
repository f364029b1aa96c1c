"""Vectorized functions for what Spark has no built-in for."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T


@F.pandas_udf(T.StringType())
def nfc(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: None if t is None else unicodedata.normalize("NFC", t))


@F.pandas_udf(T.StringType())
def nfkd(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: None if t is None else unicodedata.normalize("NFKD", t))


def osa_distance(a: str, b: str) -> int:
    """Edits with swaps of neighbours, none of them edited twice."""
    before, last = [], list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            cost = min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                cost = min(cost, before[j - 2] + 1)
            row.append(cost)
        before, last = last, row
    return last[-1]


@F.pandas_udf(T.IntegerType())
def osa(left: pd.Series, right: pd.Series) -> pd.Series:
    return pd.Series([None if a is None or b is None else osa_distance(a, b) for a, b in zip(left, right, strict=True)], dtype="Int32")
