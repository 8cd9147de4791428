"""Run folder names and timestamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sleeper.schemas import RUN_FOLDER_FORMAT

_RUN_DIR = r"/(?:run=)?(\d{4}-\d{2}-\d{2}_\d{2}-\d{2}-\d{2})/"


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def run_folder(ts: Column | str) -> Column:
    """Timestamp -> run folder name ``yyyy-MM-dd_HH-mm-ss``."""
    return F.date_format(_c(ts), RUN_FOLDER_FORMAT)


def iso_seconds(ts: Column | str) -> Column:
    return F.date_format(_c(ts), "yyyy-MM-dd'T'HH:mm:ss")


def run_ts_from_path(path: Column | str | None = None) -> Column:
    """Run timestamp parsed from the run folder in a file path (default: the scanned file)."""
    p = F.col("_metadata.file_path") if path is None else _c(path)
    return F.try_to_timestamp(F.regexp_extract(p, _RUN_DIR, 1), F.lit(RUN_FOLDER_FORMAT))


def now_ntz() -> Column:
    """Row timestamp default (the DDL's now(), without time zone)."""
    return F.localtimestamp()
