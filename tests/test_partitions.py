"""What a task of a batch query gets does not grow with the table (finding F12)."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__

SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k",
}


@pytest.fixture
def small_parts(spark):
    for name, value in SMALL.items():
        spark.conf.set(name, value)
    yield
    for name in SMALL:
        spark.conf.unset(name)


def test_more_rows_make_more_partitions(spark, sf_dir, small_parts):
    """With 4 shuffle partitions, the two joins of this query had 8 tasks at most, however large the tables."""
    rows = __spark_entry__.queries()["order_line_outer"](spark, sf_dir)
    assert rows.select(F.spark_partition_id().alias("p")).distinct().count() > 8
