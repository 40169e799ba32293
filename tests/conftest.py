from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from rateforge.session import local_session

    s = local_session("*", shuffle_partitions=8, app="rateforge-tests")
    yield s
    s.stop()


@pytest.fixture()
def workdir(tmp_path):
    return str(tmp_path)
