import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from flagstone.session import build_session  # noqa: E402

SF001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    warehouse = tempfile.mkdtemp(prefix="flagstone-wh-")
    s = build_session("local[4]", 4, app="flagstone-tests", extra={"spark.sql.warehouse.dir": warehouse})
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="flagstone-ckpt-"))
    yield s
    s.stop()


def rows(df, *cols):
    """Column values in input order (tests build small frames with an id)."""
    return [tuple(r[c] for c in cols) if len(cols) > 1 else r[cols[0]] for r in df.collect()]
