import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from contrail.session import build_session
    ck = tempfile.mkdtemp(prefix="contrail-test-ck-", dir="/tmp")
    s = build_session(master="local[4]", shuffle_partitions=4, app="contrail-tests",
                      extra={"spark.checkpoint.dir": ck, "spark.driver.memory": "4g"})
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir(spark):
    from contrail.session import fresh_path, local_path
    return local_path(fresh_path(spark, "test"))


def rows(df, order=None):
    """Collected rows as sorted tuples (order-insensitive comparisons)."""
    out = [tuple(r) for r in df.collect()]
    return sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))
