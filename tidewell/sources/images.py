"""Image files by their first bytes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Headers of little- and big-endian files, classic and big.
MAGIC = (b"II*\0", b"MM\0*", b"II+\0", b"MM\0+")


def has_tiff_header(content: Column) -> Column:
    """Whether a file's bytes begin as a TIFF does; null content doesn't."""
    return F.coalesce(F.substring(content, 1, 4).isin(*(F.lit(m) for m in MAGIC)), F.lit(False))
