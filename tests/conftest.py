import contextlib
import io
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pricewatch.session import get_spark
    s = get_spark("local[*]", shuffle_partitions=8,
                  extra={"spark.sql.streaming.checkpointLocation": tempfile.mkdtemp(prefix="pw-ckpt-")})
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="pw-test-")


def plan_text(df) -> str:
    """The physical plan as ``explain()`` prints it."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()
