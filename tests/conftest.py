import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from kempt.session import get_spark
    tmp = tempfile.mkdtemp(prefix="kempt-test-")
    s = get_spark("local[4]", app="kempt-tests", shuffle_partitions=4, extra={
        "spark.sql.warehouse.dir": os.path.join(tmp, "warehouse"),
        "spark.checkpoint.dir": os.path.join(tmp, "ckpt"),
        "spark.driver.extraJavaOptions": f"-Dderby.system.home={tmp}",
    })
    yield s
    s.stop()


@pytest.fixture()
def tmp(spark):
    from kempt.session import scratch_dir
    return scratch_dir(spark, "test")


def rows(df, *cols):
    """Sorted list of tuples, for order-insensitive comparison."""
    sel = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in sel.collect()), key=lambda r: tuple((x is None, str(x)) for x in r))
