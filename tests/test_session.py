import threading

import pytest

from ratinglens.session import at_once, checkpoint_root, scale_conf, scratch_dir


def test_scale_conf_bounds():
    big = scale_conf(100 * (1 << 40), 8000)
    assert int(big["spark.sql.shuffle.partitions"]) == 81920
    assert int(big["spark.sql.files.maxPartitionBytes"]) == 256 << 20
    assert int(big["spark.sql.autoBroadcastJoinThreshold"]) == 64 << 20
    small = scale_conf(1 << 30, 8)
    assert int(small["spark.sql.shuffle.partitions"]) == 16  # two waves of 8 cores
    huge = scale_conf(10 * (1 << 50), 100)
    assert int(huge["spark.sql.shuffle.partitions"]) == 8 << 20  # the partition size holds


def test_scratch_dirs_are_unique_and_under_checkpoint_root(spark):
    root = checkpoint_root(spark)
    a, b = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert a != b and a.startswith(root.rstrip("/")) and b.startswith(root.rstrip("/"))


def test_independent_jobs_run_at_once(spark):
    met = threading.Barrier(2, timeout=60)  # one after another would never meet
    assert at_once(spark, lambda: met.wait() >= 0 and spark.range(5).count(), lambda: met.wait() >= 0 and "b") == [5, "b"]
    with pytest.raises(ZeroDivisionError):
        at_once(spark, lambda: 1 / 0, lambda: 1)
