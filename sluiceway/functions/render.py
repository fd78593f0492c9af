"""Rendering rows as text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def row_json(df: DataFrame) -> Column:
    """The whole row as one JSON object."""
    return F.to_json(F.struct(*df.columns))


def xml_escape(value: Column) -> Column:
    text = F.replace(value, F.lit("&"), F.lit("&amp;"))
    text = F.replace(text, F.lit("<"), F.lit("&lt;"))
    return F.replace(text, F.lit(">"), F.lit("&gt;"))


def trace_line(tag: str, element: Column, ts: Column | None = None, window: Column | None = None) -> Column:
    """``[tag] element:…, timestamp:…, window:…``; parts that are not there print as ``-``."""
    none = F.lit("-")
    stamp = F.coalesce(ts.cast("string"), none) if ts is not None else none
    span = none
    if window is not None:
        span = F.concat(F.lit("["), window["start"].cast("string"), F.lit(".."), window["end"].cast("string"), F.lit(")"))
    return F.concat(
        F.lit(f"[{tag}] element:"),
        F.coalesce(element.cast("string"), F.lit("null")),
        F.lit(", timestamp:"),
        stamp,
        F.lit(", window:"),
        span,
    )
