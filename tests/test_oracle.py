"""Every registered query against its SQL."""

import pytest

import workload
from tests.compare import connect, differences

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


def test_names_agree():
    assert set(workload.SQL) <= set(workload.QUERIES)


@pytest.mark.parametrize("name", sorted(workload.QUERIES))
def test_query(spark, duck, name):
    result = workload.QUERIES[name](spark, FOLDER)
    assert name in workload.SQL, "no SQL to compare with"
    assert differences(result, duck, workload.SQL[name]) == []
