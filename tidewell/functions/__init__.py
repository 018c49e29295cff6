"""Scalar functions as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def regex_ints(text: Column, pattern: str, n: int) -> list[Column]:
    """The pattern's groups as ints, null where it doesn't match."""
    return [F.nullif(F.regexp_extract(text, pattern, k), F.lit("")).cast("int") for k in range(1, n + 1)]


def keyword_labels(name: Column, patterns: dict[str, str]) -> Column:
    """Labels of the patterns found in the lower-cased name, in the order of the dictionary."""
    return F.array_compact(F.array(*(F.when(F.rlike(F.lower(name), F.lit(p)), v) for p, v in patterns.items())))


def hours_between(late: Column, early: Column) -> Column:
    """Hours from ``early`` to ``late``."""
    return (F.unix_micros(late.cast("timestamp")) - F.unix_micros(early.cast("timestamp"))) / 3.6e9


def parse_time(text: Column) -> Column:
    """A tolerant ISO parse, null on anything else; without a zone it is UTC (the session's)."""
    return F.try_to_timestamp(text)


def fingerprint(version: int, n: Column, size: Column, stamp: Column) -> Column:
    """A text that changes whenever count, bytes or newest time do."""
    return F.format_string(f"v{version}:%d:%d:%d", n, size, stamp)


def json_field(doc: Column, path: str, default: str) -> Column:
    """A field of a JSON text; the default on absence or any error."""
    return F.coalesce(F.get_json_object(doc, path), F.lit(default))


def gaussian(x: Column, amplitude: float, centre: float, sigma: float, offset: float) -> Column:
    """A one-dimensional Gaussian."""
    return amplitude * F.exp(-F.pow(x - centre, 2) / (2 * sigma * sigma)) + offset


def sequence_index(name: Column) -> Column:
    """Rollover number of a file of a series, 0 for the first, which has none."""
    return F.coalesce(F.nullif(F.regexp_extract(name, r"_(\d+)\.ome\.tiff?$", 1), F.lit("")).cast("int"), F.lit(0))
