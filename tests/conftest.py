import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ratinglens.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = build_session(
        "local[4]",
        "ratinglens-tests",
        shuffle_partitions=4,
        extra={"spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="ratinglens-wh-")},
    )
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="ratinglens-test-")


def rows(df, *cols):
    """Collected rows as sorted tuples (optionally of selected columns)."""
    sel = df.select(*cols) if cols else df
    return sorted(tuple(r) for r in sel.collect())
