"""JSON objects in texts that hold more than JSON."""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import functions as F

_FENCE = re.compile(r"```(?:json)?\s*(.*?)```", re.S)
_DECODER = json.JSONDecoder()


def first_object(text: str | None, any_brace: bool = False) -> dict | None:
    """The object in the first code fence, or in the whole text where there is none: all of it, or what its first brace opens; with any_brace the first brace that
    opens a whole object. What stands around it is left out. None if there is no object, or if it is broken off."""
    if text is None:
        return None
    fence = _FENCE.search(text)
    text = (fence[1] if fence else text).strip()
    at = text.find("{")
    while at >= 0:
        try:
            return _DECODER.raw_decode(text, at)[0]
        except (ValueError, RecursionError):
            at = text.find("{", at + 1) if any_brace else -1
    return None


def json_object(any_brace: bool = False):
    """A column function: the text of the object as JSON, or null."""

    @F.pandas_udf("string")
    def of(texts: pd.Series) -> pd.Series:
        found = (first_object(t, any_brace) for t in texts)
        return pd.Series([None if x is None else json.dumps(x, ensure_ascii=False) for x in found], dtype=object)

    return of
