import pytest


@pytest.fixture(autouse=True, scope="session")
def few_partitions(spark):
    """Small tables: a few partitions keep the many short jobs quick."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)
