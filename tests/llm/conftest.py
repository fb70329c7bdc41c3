import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import fixtures  # noqa: E402


@pytest.fixture(scope="session")
def corpus(spark, tmp_path_factory):
    return fixtures.write(spark, str(tmp_path_factory.mktemp("corpus")))


@pytest.fixture(scope="session")
def empty(spark, tmp_path_factory):
    return fixtures.write(spark, str(tmp_path_factory.mktemp("none")), [])


@pytest.fixture(scope="session")
def data():
    return fixtures.rows()
