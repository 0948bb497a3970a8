"""Where a row was read from."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def file_name(part: Column | None = None) -> Column:
    """Name of the file a row was read from (or of another part of a URI), decoded."""
    encoded = F.col("_metadata.file_name") if part is None else part
    # In a URI path a plus sign stands for itself.
    return F.url_decode(F.replace(encoded, F.lit("+"), F.lit("%2B")))


def folder_name() -> Column:
    """Name of the folder that holds the file a row was read from."""
    return file_name(F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2))
