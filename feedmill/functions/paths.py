"""Facts read off a landing path."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MAX_FILE_BYTES = 100 * 1024 * 1024
CSV_EXTENSIONS = ["csv"]
EXCEL_EXTENSIONS = ["xlsx", "xls"]


def extension(path: Column) -> Column:
    return F.lower(F.regexp_extract(path, r"\.([^./]+)$", 1))


def file_type(path: Column) -> Column:
    ext = extension(path)
    return F.when(ext.isin(*CSV_EXTENSIONS), "CSV").when(ext.isin(*EXCEL_EXTENSIONS), "EXCEL")


def provider(path: Column) -> Column:
    """Folder just above the file; a file at the root gives its own stem."""
    parts = F.split(path, "/")
    return F.when(F.size(parts) >= 2, F.element_at(parts, -2)).otherwise(
        F.regexp_replace(path, r"\.[^.]*$", "")
    )


def rejection_reason(path: Column, size: Column) -> Column:
    """NULL when the file may be loaded, else why not."""
    allowed = CSV_EXTENSIONS + EXCEL_EXTENSIONS
    return F.when(
        ~extension(path).isin(*allowed),
        F.concat(F.lit("Invalid file type: "), extension(path)),
    ).when(size > MAX_FILE_BYTES, F.lit("File too large (max 100 MB)"))
