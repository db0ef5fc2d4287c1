from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tools"))

from scale import SF_SMALL  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    from petitionlens.session import ensure_shared_dir, local_session

    s = local_session("*", 8)
    s.sparkContext.setLogLevel("ERROR")
    # Tests run on one machine: a local scratch folder serves as the shared
    # folder, but only when the session does not already name one.
    ensure_shared_dir(s, tempfile.mkdtemp(prefix="petitionlens-test-"))
    yield s
    s.stop()


@pytest.fixture(scope="session")
def small(spark):
    """The sf0.001 petition projection (1,500 rows)."""
    from petitionlens.sources import petitions

    return petitions(spark, SF_SMALL)


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="petitionlens-case-")
