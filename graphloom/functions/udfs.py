"""What the JVM has no function for: Unicode decomposition, difflib's ratio, sorted-key JSON."""

from __future__ import annotations

import difflib
import json
import unicodedata

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T


def fold_text(text: str) -> str:
    """Compatibility decomposition without combining marks."""
    return "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c))


def ratio_of(a: str, b: str) -> float:
    return difflib.SequenceMatcher(None, a, b).ratio()


@F.pandas_udf(T.StringType())
def fold(text: pd.Series) -> pd.Series:
    return text.map(fold_text, na_action="ignore")


@F.pandas_udf(T.DoubleType())
def ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Ratcliff-Obershelp similarity; it depends on which string comes first."""
    return pd.Series([ratio_of(x, y) for x, y in zip(a, b, strict=True)], dtype="float64")


@F.pandas_udf(T.StringType())
def sorted_json(text: pd.Series) -> pd.Series:
    """JSON with keys in order and a space after separators."""
    return text.map(lambda x: json.dumps(json.loads(x), sort_keys=True), na_action="ignore")
