from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cadence.schema import RAW  # noqa: E402
from cadence.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = local_session("*", shuffle_partitions=8, app="cadence-tests")
    yield s


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="cadence-test-")


def raw_rows(spark, rows):
    """Rows given as dicts over the raw columns (missing ones NULL)."""
    full = [tuple(r.get(f.name) for f in RAW.fields) for r in rows]
    return spark.createDataFrame(full, RAW)


def ev(t, user=1, etype="view", product=1, price=None, session=None, **kw):
    d = {
        "event_time": t if (t is None or t.endswith("UTC") or " " not in t) else f"{t} UTC",
        "event_type": etype,
        "product_id": product,
        "price": price,
        "user_id": user,
        "user_session": session,
    }
    d.update(kw)
    return d
