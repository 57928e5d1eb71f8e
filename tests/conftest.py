from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from souk.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    ck = tempfile.mkdtemp(prefix="souk-test-ckpt-")
    s = build_session(
        "local[4]",
        app_name="souk-tests",
        shuffle_partitions=8,
        extra={"spark.checkpoint.dir": ck, "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="souk-wh-")},
    )
    yield s
    s.stop()
