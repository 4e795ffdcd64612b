"""Key/column/value cells — the shape of a key/value-store export — and
their conversion to and from typed rows.

Cells are regrouped on the *full* row key (never with a control break over a
sorted list, which merges neighbouring keys that share a part), and the
newest version of a cell wins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from ratinglens.functions.scalar import be_bytes, be_long

# Fixed value: the column family prefix of exported cells ("stats:<column>").
FAMILY = "stats"


def latest_version(df: DataFrame, key_cols: list[str], order_cols: list[str]) -> DataFrame:
    """Newest row per key by ``order_cols`` (a partial aggregate; no window,
    so a key with many versions is reduced before the shuffle)."""
    values = [c for c in df.columns if c not in key_cols]
    best = df.groupBy(*key_cols).agg(
        F.max_by(F.struct(*values), F.struct(*order_cols)).alias("_row")
    )
    return best.select(*key_cols, *[F.col(f"_row.{c}").alias(c) for c in values])


def to_cells(df: DataFrame, key_col: str, family: str = FAMILY) -> DataFrame:
    """Typed rows → (key, column, value) text cells; NULL values are not
    stored (an absent cell is a NULL)."""
    values = [c for c in df.columns if c != key_col]
    text = df.select(
        F.col(key_col).alias("key"),
        *[F.col(c).cast("string").alias(f"{family}:{c}") for c in values],
    )
    cells = text.unpivot(["key"], [f"{family}:{c}" for c in values], "column", "value")
    return cells.filter(F.col("value").isNotNull())


def to_binary_cells(df: DataFrame, key_col: str, counters: list[str] = (), family: str = FAMILY) -> DataFrame:
    """Typed rows → (key, column, value) cells as a key/value store holds them:
    bytes. ``counters`` are 8-byte big-endian longs, every other value is its
    text in UTF-8; NULL values are not stored."""
    values = [c for c in df.columns if c != key_col]
    coded = df.select(
        F.col(key_col).cast("string").alias("key"),
        *[
            (be_bytes(F.col(c)) if c in counters else F.encode(F.col(c).cast("string"), "UTF-8")).alias(f"{family}:{c}")
            for c in values
        ],
    )
    cells = coded.unpivot(["key"], [f"{family}:{c}" for c in values], "column", "value")
    return cells.filter(F.col("value").isNotNull()).withColumn("key", F.encode("key", "UTF-8"))


def text_cells(cells: DataFrame, counters: list[str] = (), family: str = FAMILY) -> DataFrame:
    """Binary cells → text cells, whose counters are decimal. A counter cell
    that has not eight bytes, and bytes that are no UTF-8, give no cell."""
    own = F.col("column").isin([f"{family}:{c}" for c in counters])
    value = F.col("value")
    number = F.when(F.octet_length(value) == 8, be_long(value).cast("string"))
    out = cells.withColumn("key", F.try_validate_utf8(F.col("key").cast("string")))
    out = out.withColumn("value", F.when(own, number).otherwise(F.try_validate_utf8(value.cast("string"))))
    return out.filter(F.col("key").isNotNull() & F.col("value").isNotNull())


def cells_to_rows(
    cells: DataFrame,
    columns: list[str],
    types: dict[str, DataType | str] | None = None,
    family: str = FAMILY,
    version_col: str | None = None,
) -> DataFrame:
    """(key, column, value[, version]) cells → one row per key with the given
    columns. A pivot over a fixed column list is a single hash aggregation;
    with ``version_col`` the newest version of each cell wins."""
    names = [f"{family}:{c}" for c in columns]
    pick = F.max_by("value", version_col) if version_col else F.max("value")
    wide = cells.groupBy("key").pivot("column", names).agg(pick)
    types = types or {}
    out = [F.col("key")]
    for c, n in zip(columns, names):
        col = F.col(f"`{n}`")
        out.append((col.cast(types[c]) if c in types else col).alias(c))
    return wide.select(*out)
