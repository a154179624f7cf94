import pytest

from compare import compare, duckdb_connection
from stayrate.testbed.oracle import ORACLE
from stayrate.testbed.queries import QUERIES


@pytest.fixture(scope="module")
def connection(sf_dir):
    return duckdb_connection(sf_dir)


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, sf_dir, connection, name):
    assert compare(QUERIES[name](spark, sf_dir), connection, ORACLE[name]) is None


@pytest.mark.parametrize("name", ["bernoulli_sample", "random_split", "partition_profile"])
def test_layout_dependent_queries_run(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_flagship_entry(spark):
    import __spark_entry__

    result = __spark_entry__.entry(spark)
    assert result.count() == 150
    assert result.columns[-5:] == [
        "avg_charge_by_contract",
        "charge_ratio",
        "charge_per_month",
        "complaint_proxy",
        "service_count",
    ]
