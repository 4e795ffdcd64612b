"""Retention of the view store: what a read lists is bounded, what a reader may
still need stays, and replay is harmless."""

import os
import shutil

import pytest
from conftest import rows

from ratinglens.sources import store

SCHEMA = "fide_id string, v long"
KEY = ["fide_id"]


def put(spark, root, version, items, **how):
    store.write_version(spark.createDataFrame(items, SCHEMA).coalesce(1), root, version, **how)


@pytest.fixture()
def listed(monkeypatch):
    """Names that the store's listings return."""
    seen = []
    plain = store.folder_names

    def names(spark, path):
        out = plain(spark, path)
        seen.extend(out)
        return out

    monkeypatch.setattr(store, "folder_names", names)
    return seen


def test_listing_is_bounded_after_ten_thousand_writes(spark, tmp_dir, listed):
    root = f"{tmp_dir}/store"
    put(spark, root, 0, [("a", 0), ("b", 0)])
    one = store.version_path(root, 0)
    for v in range(1, 9_500):  # what ten thousand writes leave, without their jobs
        os.makedirs(store.version_path(root, v))
    put(spark, root, 9_499, [("a", 0), ("b", 0)], kind=store.FULL)
    store._record(spark, root, "snapshots", 9_499, 0.0)
    for v in range(9_500, 10_000):
        shutil.copytree(one, store.version_path(root, v))
    put(spark, root, 9_999, [("a", 9_999)])
    assert store.snapshot_view(spark, root, KEY, every=500) == 9_999
    for v in range(10_000, 10_300):
        shutil.copytree(one, store.version_path(root, v))
    put(spark, root, 10_299, [("b", 10_299)])
    want = [("a", 0), ("b", 10_299)]
    listed.clear()
    assert rows(store.read_view(spark, root, KEY)) == want
    assert len(listed) < 600  # epochs, and the versions since the snapshot
    assert store.snapshot_view(spark, root, KEY, every=100) == 10_299
    assert store.expire_versions(spark, root, grace_s=0) == 10_299
    listed.clear()
    assert rows(store.read_view(spark, root, KEY)) == want
    assert len(listed) < 10
    kept = sum("version=" in d for _, dirs, _ in os.walk(f"{root}/kind=delta") for d in dirs)
    assert kept == 1


def test_a_reader_that_started_before_keeps_its_rows(spark, tmp_dir):
    root = f"{tmp_dir}/store"
    for v in range(3):
        put(spark, root, v, [("a", v), (f"k{v}", v)])
    store.snapshot_view(spark, root, KEY)
    put(spark, root, 3, [("a", 3)])
    reader = store.read_view(spark, root, KEY)  # lists its files now, reads them later
    put(spark, root, 4, [("a", 4)])
    assert store.maintain_view(spark, root, KEY, every=1, grace_s=3600) == (4, None)
    assert rows(reader) == [("a", 3), ("k0", 0), ("k1", 1), ("k2", 2)]
    assert rows(store.read_view(spark, root, KEY, max_version=1)) == [("a", 1), ("k0", 0), ("k1", 1)]
    # After the grace period the older versions go, and are not read in part.
    assert store.maintain_view(spark, root, KEY, every=1, grace_s=0) == (None, 4)
    assert rows(store.read_view(spark, root, KEY)) == [("a", 4), ("k0", 0), ("k1", 1), ("k2", 2)]
    with pytest.raises(ValueError, match="removed"):
        store.read_view(spark, root, KEY, max_version=1)
    assert store.expire_versions(spark, root, grace_s=0) is None  # nothing more to do


def test_replay_after_removal_is_harmless(spark, tmp_dir):
    root = f"{tmp_dir}/store"
    for v in range(4):
        put(spark, root, v, [("a", v), ("b", -v)])
    store.maintain_view(spark, root, KEY, every=1, grace_s=0)
    put(spark, root, 3, [("a", 3), ("b", -3)])  # the last batch again
    put(spark, root, 1, [("a", 1), ("b", -1)])  # one that was removed
    assert rows(store.read_view(spark, root, KEY)) == [("a", 3), ("b", -3)]
    put(spark, root, 4, [("a", 4)])
    assert store.snapshot_view(spark, root, KEY, every=1) == 4
    assert rows(store.read_view(spark, root, KEY)) == [("a", 4), ("b", -3)]


def test_a_version_that_is_complete_is_not_written_again(spark, tmp_dir):
    root = f"{tmp_dir}/store"
    put(spark, root, 0, [("a", 1)])
    before = sorted(os.listdir(store.version_path(root, 0)))
    put(spark, root, 0, [("a", 1)], once=True)
    assert sorted(os.listdir(store.version_path(root, 0))) == before
    os.remove(f"{store.version_path(root, 0)}/_SUCCESS")  # as after a crash
    put(spark, root, 0, [("a", 1)], once=True)
    assert store.is_complete(spark, root, 0) and sorted(os.listdir(store.version_path(root, 0))) != before


def test_a_write_in_progress_is_not_folded(spark, tmp_dir):
    root = f"{tmp_dir}/store"
    put(spark, root, 0, [("a", 1)])
    put(spark, root, 1, [("a", 2)])
    os.remove(f"{store.version_path(root, 1)}/_SUCCESS")
    assert store.snapshot_view(spark, root, KEY) == 0
    assert store.snapshot_view(spark, root, KEY) is None
    assert rows(store.read_view(spark, root, KEY)) == [("a", 2)]


def test_an_empty_store(spark, tmp_dir):
    root = f"{tmp_dir}/none"
    assert store.maintain_view(spark, root, KEY) == (None, None)
    assert not store.has_versions(spark, root) and store.versions(spark, root) == []
