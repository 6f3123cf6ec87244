import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from featurelake.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", shuffle_partitions=8)
    # tests own their scratch space (on a cluster the session names it)
    if not s.conf.get("spark.checkpoint.dir", None):
        d = tempfile.mkdtemp(prefix="featurelake-test-")
        s.conf.set("spark.checkpoint.dir", d)
        s.sparkContext.setCheckpointDir(d)
    yield s
    s.stop()


@pytest.fixture()
def scratch(spark):
    from featurelake.session import fresh_dir
    return fresh_dir(spark, "t")


def tx_rows(spark, rows):
    from featurelake.schemas import TX_RAW
    return spark.createDataFrame([(*r[:4], None if r[4] is None else str(r[4]), r[5]) for r in rows], TX_RAW)
