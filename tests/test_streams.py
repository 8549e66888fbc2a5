from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tripflow.operators.selection import expire, keep_valid
from tripflow.sources.trips import read_yellow
from tripflow.streaming.trips import stream_trips, windowed_counts


def run(spark, df, root, name):
    query = (
        df.writeStream.format("parquet")
        .option("checkpointLocation", f"{root}/{name}-checkpoint")
        .outputMode("append")
        .trigger(availableNow=True)
        .start(f"{root}/{name}")
    )
    query.awaitTermination()
    return spark.read.schema(df.schema).parquet(f"{root}/{name}")


def test_stream_equals_batch(spark, trip_dir, tmp_path):
    streamed = run(
        spark, keep_valid(stream_trips(spark, f"{trip_dir}/yellow", "yellow", 1), "yellow"), tmp_path, "valid"
    )
    batch = keep_valid(read_yellow(spark, f"{trip_dir}/yellow"), "yellow")
    assert streamed.exceptAll(batch).isEmpty() and batch.exceptAll(streamed).isEmpty()


def test_expiry_on_a_stream(spark, make_raw, tmp_path):
    now = datetime.now()
    raw = make_raw("yellow", {"tpep_pickup_datetime": now}, {"tpep_pickup_datetime": now - timedelta(days=40)})
    raw.write.parquet(f"{tmp_path}/in")
    fresh = expire(stream_trips(spark, f"{tmp_path}/in", "yellow"), "tpep_pickup_datetime")
    assert run(spark, fresh, tmp_path, "fresh").count() == 1


def test_windows_close_behind_the_watermark(spark, make_raw, tmp_path):
    start = datetime(2024, 1, 1, 10, 15)
    first = [{"tpep_pickup_datetime": start}] * 2 + [{"tpep_pickup_datetime": start + timedelta(days=40)}]
    make_raw("yellow", *first).coalesce(1).write.parquet(f"{tmp_path}/in")
    counts = windowed_counts(stream_trips(spark, f"{tmp_path}/in", "yellow"), "tpep_pickup_datetime", by=("VendorID",))
    assert [tuple(r) for r in run(spark, counts, tmp_path, "counts").collect()] == [(datetime(2024, 1, 1, 10), 1, 2)]
    # A trip that comes in after its window is closed is dropped.
    make_raw("yellow", {"tpep_pickup_datetime": start}).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    counts = windowed_counts(stream_trips(spark, f"{tmp_path}/in", "yellow"), "tpep_pickup_datetime", by=("VendorID",))
    assert run(spark, counts, tmp_path, "counts").agg(F.sum("trips")).first()[0] == 2
