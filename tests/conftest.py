import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from churnlens.session import build_session

    s = build_session(master="local[*]", shuffle_partitions=8)
    yield s


EVENT_SCHEMA = ("userId string, page string, level string, sessionId long, ts long, "
                "gender string, itemInSession long, userAgent string, length double, auth string")


def rows(spark, data):
    """A raw event-log frame from tuples in EVENT_SCHEMA order."""
    return spark.createDataFrame(data, EVENT_SCHEMA)


def ev(user="1", page="Home", ts=0, session=1, gender="M", item=0,
       agent="Mozilla/5.0 (X11; Linux x86_64)", length=None, level="paid"):
    return (user, page, level, session, ts, gender, item, agent, length, "Logged In")
