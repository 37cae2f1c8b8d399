import pytest

from comparing import same_rows
from tidemark.plans import queries, sql

QUERIES = queries.queries()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, sf_dir, duck):
    out = QUERIES[name](spark, sf_dir)
    if name in sql.ORACLES:
        same_rows(out, duck.sql(sql.ORACLES[name]))
    else:
        assert out.count() > 0


def test_entry(spark, sf_dir):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(sql.ORACLES) <= set(__spark_entry__.queries())
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
