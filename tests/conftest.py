import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from spanloom.session import build_session, let_workers_import

    shared = "file://" + str(tmp_path_factory.mktemp("shared"))
    s = build_session("tests", "local[4]", spark__checkpoint__dir=shared, spark__ui__enabled="false", spark__sql__shuffle__partitions="4", spark__ui__showConsoleProgress="false", spark__driver__memory="4g")
    s.sparkContext.setLogLevel("ERROR")
    let_workers_import(s)
    yield s
    s.stop()


@pytest.fixture
def sf():
    return SF


def kvs(**values):
    """Attributes from plain values; dots in names are written as two underscores."""
    out = []
    for k, v in values.items():
        x = dict.fromkeys("sidba")
        x["b" if isinstance(v, bool) else "i" if isinstance(v, int) else "d" if isinstance(v, float) else "a" if isinstance(v, list) else "s"] = v
        out.append({"key": k.replace("__", "."), "value": x})
    return out


def span(**fields):
    base = {
        "service": "dialog-agent", "scope": "s", "resource": None, "scope_full": None, "trace_id": "0" * 32, "span_id": "0" * 16, "parent_span_id": "", "name": "chat",
        "start_ns": 0, "end_ns": 50_000_000, "status_code": None, "status_message": "", "attributes": [], "events": [], "links": [], "kind": None, "trace_state": None, "rest": None, "seq": 0,
    }
    return base | fields


@pytest.fixture
def spans_df(spark):
    from spanloom.schemas import SPAN

    return lambda rows: spark.createDataFrame([tuple(r.values()) for r in rows], SPAN)
