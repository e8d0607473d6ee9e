"""Run metadata taken from file paths and names."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed value: where a file name states its month.
YEAR_MONTH = r"\d{4}-\d{2}"


def path_parts(path: Column) -> dict[str, Column]:
    """filename, bucket, blob_path and category of ``scheme://bucket/a/b/category/file``."""
    pieces = F.split(path, "/")
    return {
        "filename": F.try_element_at(pieces, F.lit(-1)),
        "bucket": F.try_element_at(pieces, F.lit(3)),
        "blob_path": F.concat_ws("/", F.slice(pieces, F.lit(4), F.greatest(F.size(pieces) - 3, F.lit(0)))),
        "category": F.try_element_at(pieces, F.lit(-2)),
    }


def name_category(filename: Column) -> Column:
    """The part of a file name before its first underscore."""
    return F.try_element_at(F.split(filename, "_"), F.lit(1))


def name_run_date(filename: Column) -> Column:
    """First ``YYYY-MM`` in a file name as the first day of that month; NULL when there is none."""
    found = F.regexp_extract(filename, f"({YEAR_MONTH})", 1)
    return F.try_to_timestamp(F.concat(found, F.lit("-01")), F.lit("yyyy-MM-dd")).cast("date")
