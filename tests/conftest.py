import json
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from stayflow.session import build_session  # noqa: E402

SF0001 = "/root/testdata/sf0.001"
SF001 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    ckpt = tempfile.mkdtemp(prefix="stayflow-test-ckpt-")
    wh = tempfile.mkdtemp(prefix="stayflow-test-wh-")
    extra = {"spark.checkpoint.dir": ckpt, "spark.driver.memory": "4g", "spark.sql.warehouse.dir": wh}
    # e.g. STAYFLOW_TEST_CONF='{"spark.sql.ansi.enabled": "false"}' to run the suite
    # under other session settings.
    extra.update(json.loads(os.environ.get("STAYFLOW_TEST_CONF", "{}")))
    s = build_session("local[4]", app="stayflow-tests", shuffle_partitions=4, extra=extra)
    yield s
    s.stop()


@pytest.fixture
def tmp_dir():
    return tempfile.mkdtemp(prefix="stayflow-test-")


def rows_of(df, cols=None):
    """Sorted list of tuples (order-insensitive comparison)."""
    cols = cols or df.columns
    return sorted((tuple(r[c] for c in cols) for r in df.select(*cols).collect()), key=repr)


def duck_rows(con, sql, cols=None):
    res = con.execute(sql)
    names = [d[0] for d in res.description]
    out = res.fetchall()
    if cols:
        idx = [names.index(c) for c in cols]
        out = [tuple(r[i] for i in idx) for r in out]
    return sorted((tuple(r) for r in out), key=repr)
