"""Every registered query against its SQL twin, on the smallest tables."""

import pytest

import __spark_entry__ as entry
import check
from lettersieve.plans import catalog, session_index


@pytest.fixture(scope="module")
def database(sf_dir):
    return check.duck(sf_dir)


def test_every_query_has_sql():
    assert catalog.QUERIES.keys() <= entry.oracle_sql().keys() <= entry.queries().keys()


@pytest.mark.parametrize("name", list(entry.oracle_sql()))
def test_query_equals_sql(spark, sf_dir, database, name):
    got = entry.queries()[name](spark, sf_dir).toPandas()
    assert check.compare(got, database.execute(entry.oracle_sql()[name]).fetchdf()) == "ok"


def test_flagship(spark):
    df = entry.entry(spark)
    assert df.columns == ["box", "uid", "score"] and not df.isEmpty()


def test_index_is_built_once_and_again_when_the_source_changes(spark, sf_dir, tmp_path):
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    target = str(tmp_path / "documents.parquet")
    documents.write.parquet(target)
    first = session_index.open_index(spark, str(tmp_path))
    assert session_index.open_index(spark, str(tmp_path)).keys.inputFiles() == first.keys.inputFiles()
    documents.limit(3).write.mode("overwrite").parquet(target)
    assert session_index.open_index(spark, str(tmp_path)).keys.count() == 3
