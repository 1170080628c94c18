"""Every registered query against its SQL on the smallest data set."""

import os

import pytest

import __spark_entry__ as contract
from checks import verify

SF = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")

# Models fitted on a few hundred rows say little; `python -m checks.verify` runs these on more.
SLOW = ("mod_03", "mod_04", "mod_07", "mod_08", "mod_09", "mod_10", "mod_11", "mod_12", "mod_14", "xai_02", "xai_04", "flow_")


@pytest.fixture(scope="module")
def database():
    return verify.connect(SF)


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
@pytest.mark.parametrize("name", [n for n in contract.queries() if not n.startswith(SLOW)])
def test_same_rows_as_sql(spark, database, name):
    verdict, _ = verify.compare(spark, database, name, SF, tolerant=True)
    assert verdict in ("ok", "rows-only")


def test_every_sql_belongs_to_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())
