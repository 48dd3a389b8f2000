"""Incremental bronze landing lands each raw file exactly once."""

from medalforge.session import scratch_path
from medalforge.sources import STRING, land
from medalforge.sources.fixtures import BRONZE_CUSTOMER_COLUMNS, bronze_customer
from medalforge.streaming import land_stream
from medalforge.warehouse import source
from tests.conftest import SF001


def test_stream_lands_new_files_once(spark):
    raw = bronze_customer(source(spark, SF001, "customer"))
    first, second = raw.where("cst_key < 'Customer#000000075'"), raw.where("cst_key >= 'Customer#000000075'")
    inbox, target = scratch_path(spark, "inbox"), scratch_path(spark, "bronze-stream")
    ckpt = scratch_path(spark, "ckpt")
    schema = STRING(BRONZE_CUSTOMER_COLUMNS)

    land(first, f"{inbox}/batch=1", "csv")
    land_stream(spark, f"{inbox}/batch=1", "csv", schema, target, ckpt).awaitTermination()
    assert spark.read.parquet(target).count() == first.count()

    # a rerun with nothing new lands nothing
    land_stream(spark, f"{inbox}/batch=1", "csv", schema, target, ckpt).awaitTermination()
    landed = spark.read.parquet(target)
    assert landed.count() == first.count()
    assert landed.where("_corrupt_record IS NOT NULL").count() == 0
    assert landed.select(first.columns).exceptAll(first).count() == 0

    other = scratch_path(spark, "bronze-stream2")
    land(second, f"{inbox}/batch=2", "json")
    land_stream(spark, f"{inbox}/batch=2", "json", schema, other).awaitTermination()
    assert spark.read.parquet(other).where("_corrupt_record IS NOT NULL").count() == 0
    assert spark.read.parquet(other).select(second.columns).exceptAll(second).count() == 0


def test_stream_in_several_micro_batches(spark):
    raw = bronze_customer(source(spark, SF001, "customer")).repartition(3)
    inbox, target = scratch_path(spark, "inbox-multi"), scratch_path(spark, "bronze-multi")
    land(raw, inbox, "json")  # three files
    query = land_stream(spark, inbox, "json", STRING(BRONZE_CUSTOMER_COLUMNS), target,
                        max_files_per_trigger=1)
    query.awaitTermination()
    assert len(query.recentProgress) >= 3  # one file per micro-batch
    assert spark.read.parquet(target).where("_corrupt_record IS NOT NULL").count() == 0
    assert spark.read.parquet(target).select(raw.columns).exceptAll(raw).count() == 0
    assert spark.read.parquet(target).count() == raw.count()
