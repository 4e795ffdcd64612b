"""Plan inspection for tests and tuning: the formatted physical plan as text
and the pieces of it that show whether filters and column pruning reached
the scan."""

from __future__ import annotations

import contextlib
import io
import re

from pyspark.sql import DataFrame


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()


def pushed_filters(df: DataFrame) -> list[str]:
    """Every ``PushedFilters: [...]`` list of the plan's scans."""
    return re.findall(r"PushedFilters: \[(.*?)\]", plan_text(df))


def partition_filters(df: DataFrame) -> list[str]:
    return re.findall(r"PartitionFilters: \[(.*?)\]", plan_text(df))


def read_schemas(df: DataFrame) -> list[str]:
    return re.findall(r"ReadSchema: (struct<.*?>)", plan_text(df))

