import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemark.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    ckpt = tempfile.mkdtemp(prefix="tidemark-tests-")
    s = build_session("local[4]", app_name="tidemark-tests", shuffle_partitions=4,
                      extra={"spark.checkpoint.dir": ckpt,
                             "spark.sql.warehouse.dir": os.path.join(ckpt, "warehouse")})
    yield s
    s.stop()


def raw_frame(spark, rows):
    """A raw event log from tuples in RAW_COLUMNS order (unit-test input)."""
    from tidemark.sources.raw_events import RAW_SCHEMA
    return spark.createDataFrame(rows, RAW_SCHEMA)


def ev(time, user, etype="like", platform="web", country="SG", gender="male", utm="organic",
       category=None, miles=None):
    return (time, user, gender, etype, category, miles, platform, utm, country)
