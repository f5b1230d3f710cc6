import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from stratum.session import build_session
    root = tempfile.mkdtemp(prefix="stratum-tests-")
    s = build_session("local[4]", app="stratum-tests", shuffle_partitions=4,
                      extra={"spark.checkpoint.dir": root,
                             "spark.sql.warehouse.dir": f"{root}/warehouse"})
    yield s
    s.stop()


@pytest.fixture()
def scratch(spark):
    from stratum.session import scratch_dir
    return scratch_dir(spark, "t")


def rows(df, *cols):
    """Sorted list of tuples (for order-insensitive comparison)."""
    sel = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in sel.collect()), key=lambda t: tuple((x is None, str(x)) for x in t))
