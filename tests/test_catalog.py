import pytest

from cellweave.plans import catalog

from .compare import rows_of, rows_of_sql


@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_query_matches_sql(spark, duck, sf_dir, name):
    assert rows_of(catalog.QUERIES[name](spark, sf_dir)) == rows_of_sql(duck, catalog.ORACLE_SQL[name])


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLE_SQL)))
def test_query_runs(spark, sf_dir, name):
    assert catalog.QUERIES[name](spark, sf_dir).collect()


def test_entry_does_not_need_the_corpus_operators(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_partition_count_does_not_matter(spark, sf_dir):
    before = rows_of(catalog.QUERIES["em_abundance"](spark, sf_dir))
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        assert rows_of(catalog.QUERIES["em_abundance"](spark, sf_dir)) == before
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
