import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

FIXTURES = os.path.join(ROOT, "tests", "fixtures")
SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from clickpulse.session import get_session
    scratch = tempfile.mkdtemp(prefix="clickpulse-test-")
    s = get_session("local[4]", app_name="clickpulse-tests", shuffle_partitions=4,
                    conf={"spark.checkpoint.dir": os.path.join(scratch, "ckpt"),
                          "spark.local.dir": os.path.join(scratch, "local")})
    yield s
    s.stop()


def fixture(name):
    return os.path.join(FIXTURES, name)


@pytest.fixture(scope="session")
def spark_session_uid(spark):
    """Evaluate ``bitmap_offset`` for one string id on Spark."""
    from pyspark.sql import functions as F
    from clickpulse.functions.hashing import bitmap_offset

    def run(s):
        return spark.createDataFrame([(s,)], "u string").select(
            bitmap_offset(F.col("u")).alias("o")).first().o
    return run
