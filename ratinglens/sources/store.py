"""Keyed view store on Parquet with upsert semantics.

Layout (the same whatever the writer's settings)::

    <root>/kind=delta/epoch=<n // 100>/version=<n>/   rows whose keys changed in write n
    <root>/kind=full/epoch=<n // 100>/version=<n>/    every key of the view as of write n
    <root>/_snapshots/version=<n>/                    when the snapshot n was completed
    <root>/_horizon/version=<n>/                      versions below n may be removed

Writing version ``n`` replaces only its own folder, so a replayed micro-batch
or a re-run with the same version number is harmless. Reading returns, for
every key, the row of the highest version that holds the key — keys absent
from a newer write stay visible, exactly like an insert into a key/value
table. A full snapshot makes every older version redundant: a read lists the
snapshots, the epochs, and the versions of the epochs from the newest snapshot
on (no file is opened), so what it lists is bounded by the snapshot interval
and the epochs kept. A snapshot is recorded after its write has committed; one
still being written is merged like a delta, so a reader never loses keys to a
half-visible snapshot.

Snapshots and removal are jobs of their own (``maintain_view``): they work on
versions already written and no write waits for them. A version is removed when
a snapshot above it has been complete for the grace period, so a reader that
started before has that long to finish.

The merge is an aggregation with ``max_by`` and map-side partial aggregation,
so a key present in many versions never gathers in one task.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

KIND = "kind"
EPOCH = "epoch"
VERSION = "version"
DELTA = "delta"
FULL = "full"
#: Versions in an epoch folder (part of the layout).
EPOCH_VERSIONS = 100
#: Seconds for which a superseded version is kept.
GRACE_S = 3600.0


def _fs_path(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in ``path``; none if there is no such path."""
    fs, jpath = _fs_path(spark, path)
    if not fs.exists(jpath):
        return []
    return [s.getPath().getName() for s in fs.listStatus(jpath) if s.isDirectory()]


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, jpath = _fs_path(spark, path)
    return fs.exists(jpath)


def _remove(spark: SparkSession, path: str) -> None:
    fs, jpath = _fs_path(spark, path)
    fs.delete(jpath, True)


def _numbers(names: list[str], label: str) -> list[int]:
    return sorted(int(n.split("=", 1)[1]) for n in names if n.startswith(f"{label}="))


def _kind_path(root: str, kind: str) -> str:
    return f"{root.rstrip('/')}/{KIND}={kind}"


def _epoch_path(root: str, kind: str, epoch: int) -> str:
    return f"{_kind_path(root, kind)}/{EPOCH}={int(epoch)}"


def version_path(root: str, version: int, kind: str = DELTA) -> str:
    return f"{_epoch_path(root, kind, version // EPOCH_VERSIONS)}/{VERSION}={int(version)}"


def versions(
    spark: SparkSession, root: str, kind: str = DELTA, since: int | None = None, until: int | None = None
) -> list[int]:
    """Version numbers written as ``kind``, in order, between ``since`` and
    ``until`` (inclusive): only epochs that can hold them are listed."""
    low = 0 if since is None else since
    found = []
    for e in _numbers(folder_names(spark, _kind_path(root, kind)), EPOCH):
        if (e + 1) * EPOCH_VERSIONS > low and (until is None or e * EPOCH_VERSIONS <= until):
            found += _numbers(folder_names(spark, _epoch_path(root, kind, e)), VERSION)
    return [v for v in found if v >= low and (until is None or v <= until)]


def has_versions(spark: SparkSession, root: str) -> bool:
    return any(folder_names(spark, _kind_path(root, kind)) for kind in (DELTA, FULL))


def is_complete(spark: SparkSession, root: str, version: int, kind: str = DELTA) -> bool:
    """Whether the write of a version has committed."""
    return path_exists(spark, f"{version_path(root, version, kind)}/_SUCCESS")


def write_version(df: DataFrame, root: str, version: int, kind: str = DELTA, once: bool = False) -> None:
    """Write one version of a view; keys must be unique within ``df``. With
    ``once``, a version whose write has committed is left as it is (for a
    replay with the same rows, beside readers)."""
    if once and is_complete(df.sparkSession, root, version, kind):
        return
    df.write.mode("overwrite").parquet(version_path(root, version, kind))


def upsert_view(df: DataFrame, root: str, key_cols: list[str], version: int) -> None:
    """Upsert rows into a view. Several rows with one key in ``df`` leave one
    (deterministically the greatest), as a key/value insert would."""
    values = [c for c in df.columns if c not in key_cols]
    unique = df.groupBy(*key_cols).agg(F.max(F.struct(*values)).alias("_row"))
    write_version(unique.select(*key_cols, "_row.*"), root, version)


# ------------------------------------------------------------------- snapshots


def _log(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/_{name}"


def _record(spark: SparkSession, root: str, name: str, version: int, at: float) -> None:
    row = spark.createDataFrame([(float(at),)], "at double")
    row.coalesce(1).write.mode("overwrite").parquet(f"{_log(root, name)}/{VERSION}={int(version)}")


def snapshots(spark: SparkSession, root: str) -> list[int]:
    """Versions of the recorded snapshots, in order."""
    return _numbers(folder_names(spark, _log(root, "snapshots")), VERSION)


def latest_snapshot(spark: SparkSession, root: str, max_version: int | None = None) -> int | None:
    """Version of the newest completed snapshot (optionally ≤ ``max_version``),
    or None."""
    return max((v for v in snapshots(spark, root) if max_version is None or v <= max_version), default=None)


def horizon(spark: SparkSession, root: str) -> int:
    """Versions below this one may be removed."""
    return max(_numbers(folder_names(spark, _log(root, "horizon")), VERSION), default=0)


def _merge(raw: DataFrame, key_cols: list[str], order_col: str) -> DataFrame:
    values = [c for c in raw.columns if c not in key_cols and c not in (KIND, EPOCH, VERSION, order_col)]
    merged = raw.groupBy(*key_cols).agg(F.max_by(F.struct(*values), F.col(order_col)).alias("_row"))
    return merged.select(*key_cols, *[F.col(f"_row.{c}").alias(c) for c in values])


def read_view(
    spark: SparkSession,
    root: str,
    key_cols: list[str],
    min_version: int | None = None,
    max_version: int | None = None,
    use_snapshots: bool = True,
) -> DataFrame:
    """Current state of a view: latest version per key.

    Versions older than the newest full snapshot are not scanned;
    ``max_version`` (inclusive) reads the view as of that write, which is an
    error if versions that it needs may be removed."""
    if max_version is not None and max_version < horizon(spark, root):
        raise ValueError(f"versions of {root} below {horizon(spark, root)} are removed")
    if use_snapshots and min_version is None:
        min_version = latest_snapshot(spark, root, max_version)
    paths = [
        version_path(root, v, kind)
        for kind in (FULL, DELTA)
        for v in versions(spark, root, kind, min_version, max_version)
    ]
    if not paths:
        raise FileNotFoundError(f"no view at {root}")
    return _merge(spark.read.option("basePath", root).parquet(*paths), key_cols, VERSION)


def compact_view(
    spark: SparkSession, root: str, key_cols: list[str], version: int, newest: DataFrame | None = None
) -> None:
    """Write a full snapshot as version ``version``: the view as of the
    previous version, overlaid with ``newest`` (the rows of write ``version``
    itself, if any). Only folders below ``version`` are read, so replaying
    the same compaction never reads the folder it replaces."""
    parts = []
    try:
        prior = read_view(spark, root, key_cols, max_version=version - 1)
        parts.append(prior.withColumn("_order", F.lit(0)))
    except FileNotFoundError:
        if newest is None:
            raise ValueError("nothing to compact") from None
    if newest is not None:
        parts.append(newest.withColumn("_order", F.lit(1)))
    both = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    write_version(_merge(both, key_cols, "_order"), root, version, FULL)
    # Recorded only after the snapshot's write job committed.
    _record(spark, root, "snapshots", version, time.time())


def snapshot_view(spark: SparkSession, root: str, key_cols: list[str], every: int = 1) -> int | None:
    """Fold the deltas that are complete into a full snapshot, if there are at
    least ``every`` since the newest one; its version, or None. Runs beside a
    writer: it reads versions that are written and writes only its own."""
    done = latest_snapshot(spark, root)
    written = versions(spark, root, DELTA, 0 if done is None else done + 1)
    # Versions are written one after another: only the last can be incomplete.
    if written and not is_complete(spark, root, written[-1]):
        written.pop()
    if not written or written[-1] - (-1 if done is None else done) < every:
        return None
    last = written[-1]
    newest = spark.read.parquet(version_path(root, last))
    if last == 0:
        write_version(newest, root, 0, FULL)
        _record(spark, root, "snapshots", 0, time.time())
    else:
        compact_view(spark, root, key_cols, last, newest)
    return last


def expire_versions(spark: SparkSession, root: str, grace_s: float = GRACE_S) -> int | None:
    """Remove the versions below the newest snapshot that has been complete for
    ``grace_s`` seconds; that snapshot's version, or None if nothing may go.

    What will be removed is recorded first, so a read of an older state fails
    instead of finding a part of it. Whole epochs go at once."""
    if max(snapshots(spark, root), default=0) <= horizon(spark, root):
        return None
    log = spark.read.option("basePath", _log(root, "snapshots")).parquet(_log(root, "snapshots"))
    keep = log.filter(F.col("at") <= time.time() - grace_s).agg(F.max(VERSION)).first()[0]
    if keep is None:
        return None
    keep = int(keep)
    if horizon(spark, root) < keep:
        _record(spark, root, "horizon", keep, time.time())
    for kind in (DELTA, FULL):
        for e in _numbers(folder_names(spark, _kind_path(root, kind)), EPOCH):
            if (e + 1) * EPOCH_VERSIONS <= keep:
                _remove(spark, _epoch_path(root, kind, e))
        for v in versions(spark, root, kind, keep - keep % EPOCH_VERSIONS, keep - 1):
            _remove(spark, version_path(root, v, kind))
    for name in ("snapshots", "horizon"):
        for v in _numbers(folder_names(spark, _log(root, name)), VERSION):
            if v < keep:
                _remove(spark, f"{_log(root, name)}/{VERSION}={v}")
    return keep


def maintain_view(
    spark: SparkSession, root: str, key_cols: list[str], every: int = 500, grace_s: float = GRACE_S
) -> tuple[int | None, int | None]:
    """One round of upkeep, beside the writer: a snapshot if ``every`` deltas
    are due, then removal; (version of the snapshot, version kept from)."""
    return snapshot_view(spark, root, key_cols, every), expire_versions(spark, root, grace_s)
