import json

import pytest
from pyspark.sql import functions as F

from tripflow.operators.documents import to_documents
from tripflow.operators.metrics import sink_totals
from tripflow.sinks import bulk, tables


def test_catalog_table(spark, make_raw):
    raw = make_raw("yellow", {}, {"passenger_count": None})
    assert tables.load_catalog_table(raw, "yellow_trips", drop_if_exists=True) == 2
    assert tables.load_catalog_table(raw, "yellow_trips") == 2
    assert spark.table("yellow_trips").count() == 4
    assert tables.load_catalog_table(raw, "yellow_trips", drop_if_exists=True) == 2
    assert spark.table("yellow_trips").count() == 2
    assert spark.table("yellow_trips").filter("passenger_count is null").count() == 1
    spark.sql("drop table yellow_trips")


def test_catalog_table_sanitises_columns(spark):
    df = spark.createDataFrame([(1,)], "`Fare Amount` int")
    assert tables.load_catalog_table(df, "odd_names", drop_if_exists=True) == 1
    assert spark.table("odd_names").columns == ["Fare_Amount"]
    spark.sql("drop table odd_names")


def test_jdbc_options():
    options = tables.jdbc_options("public.yellow", "jdbc:x", properties={"user": "u", "ssl": "true"})
    assert options == {
        "user": "u",
        "ssl": "true",
        "url": "jdbc:x",
        "dbtable": "public.yellow",
        "batchsize": "1000",
        "numPartitions": "5",
    }


def test_bulk_bodies(make_trips):
    trips = make_trips("green", *[{"passenger_count": i} for i in range(25)]).coalesce(1)
    docs = to_documents(trips.withColumn("id", bulk.document_id("passenger_count")), "green", keep=("id",))
    chunks = bulk.bulk_chunks(docs, "greentaxi", size=10, id_col="id").collect()
    assert [c.n_docs for c in chunks] == [10, 10, 5] and {c["index"] for c in chunks} == {"greentaxi"}
    assert len({c.chunk_id for c in chunks}) == 3
    lines = "".join(c.body for c in chunks).splitlines()
    actions, bodies = [json.loads(x) for x in lines[::2]], [json.loads(x) for x in lines[1::2]]
    assert all(list(a["index"]) == ["_index", "_id"] for a in actions)
    assert len({a["index"]["_id"] for a in actions}) == 25
    assert sorted(b["passenger_count"] for b in bodies) == list(range(25))
    assert all(c.body.endswith("\n") for c in chunks)


def test_action_without_id(make_trips):
    body = bulk.bulk_chunks(to_documents(make_trips("yellow"), "yellow"), "yellowtaxi").first().body
    assert body.splitlines()[0] == '{"index":{"_index":"yellowtaxi"}}'


def test_chunks_across_partitions_and_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "700")
    try:
        docs = spark.range(10_000, numPartitions=4).select(F.to_json(F.struct("id")).alias("doc"))
        chunks = bulk.bulk_chunks(docs, "yellowtaxi")
        assert [tuple(r) for r in chunks.agg(F.sum("n_docs"), F.max("n_docs"), F.count("*")).collect()] == [
            (10_000, 1000, 12)
        ]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def poster_to(folder):
    """Stands for an HTTP client: stores every body, refuses bodies that mention 666."""

    def post(body):
        import uuid

        if '"id":666}' in body:
            raise ConnectionError("refused")
        with open(f"{folder}/{uuid.uuid4().hex}", "w") as out:
            out.write(body)

    return post


def test_posting(spark, tmp_path):
    received = tmp_path / "received"
    received.mkdir()
    docs = spark.range(2_500, numPartitions=3).filter("id <> 666").select(F.to_json(F.struct("id")).alias("doc"))
    results = bulk.post_outbox(
        bulk.bulk_chunks(docs, "yellowtaxi", size=500), poster_to(received), str(tmp_path / "outbox"), delay_ms=1
    )
    ids = [json.loads(x)["id"] for f in received.iterdir() for x in f.read_text().splitlines()[1::2]]
    assert sorted(ids) == [i for i in range(2_500) if i != 666]
    assert tuple(sink_totals(results).first()) == ("yellowtaxi", 6, 6, 0, 2_499)


def test_refused_request_fails_the_load(spark, tmp_path):
    received = tmp_path / "received"
    received.mkdir()
    docs = spark.range(2_000, numPartitions=2).select(F.to_json(F.struct("id")).alias("doc"))
    chunks = bulk.bulk_chunks(docs, "greentaxi", size=500)
    with pytest.raises(bulk.BulkLoadError, match="refused"):
        bulk.post_outbox(chunks, poster_to(received), str(tmp_path / "outbox"), delay_ms=0)
    results = spark.read.schema(bulk.RESULT_SCHEMA).parquet(str(tmp_path / "outbox/results"))
    assert tuple(sink_totals(results).first()) == ("greentaxi", 4, 3, 1, 1_500)


def test_throttle_limits_the_tasks(spark):
    docs = spark.range(4_000, numPartitions=8).select(F.to_json(F.struct("id")).alias("doc"))
    posted = bulk.post_chunks(bulk.bulk_chunks(docs, "yellowtaxi"), lambda body: None, max_concurrent=2, delay_ms=0)
    assert posted.rdd.getNumPartitions() == 2 and posted.filter("ok").count() == 8


@pytest.mark.parametrize("barrier", [False, True])
def test_two_requests_at_once_and_none_waits_for_ever(spark, tmp_path, barrier):
    folder = str(tmp_path)

    def post(body):
        """Notes how many requests run; document 7 is turned away twice, 1007 always."""
        import os
        import time
        import uuid

        name = uuid.uuid4().hex
        open(f"{folder}/run-{name}", "w").close()
        with open(f"{folder}/seen-{name}", "w") as out:
            out.write(str(sum(f.startswith("run-") for f in os.listdir(folder))))
        try:
            time.sleep(0.05)
            if '"id":7}' in body and sum(f.startswith("try-") for f in os.listdir(folder)) < 2:
                open(f"{folder}/try-{name}", "w").close()
                raise bulk.Busy("429")
            if '"id":1007}' in body:
                raise bulk.Busy("429")
        finally:
            os.remove(f"{folder}/run-{name}")

    docs = spark.range(6_000, numPartitions=6).select(F.to_json(F.struct("id")).alias("doc"))
    stored = f"{tmp_path}-bodies"
    bulk.write_bodies(bulk.bulk_chunks(docs, "yellowtaxi"), stored)
    posted = bulk.post_chunks(spark.read.parquet(stored), post, 2, 0, max_wait_s=1.5, barrier=barrier)
    errors = sorted(r.error or "" for r in posted.collect())
    seen = [int(f.read_text()) for f in tmp_path.iterdir() if f.name.startswith("seen-")]
    assert max(seen) <= 2 and len(list(tmp_path.glob("try-*"))) == 2
    assert errors == [""] * 5 + ["TimeoutError: turned away for 1.5 s: 429"]


def test_a_request_without_an_answer_keeps_its_turn(spark):
    def post(body):
        import time

        if '"id":7}' in body:
            time.sleep(3)

    docs = spark.range(4_000, numPartitions=1).select(F.to_json(F.struct("id")).alias("doc"))
    posted = bulk.post_chunks(bulk.bulk_chunks(docs, "yellowtaxi"), post, 1, 0, max_wait_s=1.0, answer_s=0.5)
    errors = {r.chunk_id: r.error for r in posted.collect()}
    assert errors["0-0"] == "TimeoutError: no answer in 0.5 s"
    # The next ones wait for their turn, a second each, until the first request has ended.
    assert errors["0-1"] == errors["0-2"] == "TimeoutError: waited 1 s for a turn" and errors["0-3"] is None


def test_single_document_returns_its_id():
    stored = {}

    def client(index, document, doc_id):
        if "bad" in document:
            raise ConnectionError("400")
        stored[doc_id or "made-1"] = (index, document)
        return doc_id or "made-1"

    assert bulk.index_document('{"a": 1}', "yellowtaxi", client) == "made-1"
    assert bulk.index_document('{"a": 2}', "greentaxi", client, "x") == "x" and stored["x"][0] == "greentaxi"
    with pytest.raises(bulk.BulkLoadError, match="400"):
        bulk.index_document("bad", "greentaxi", client)


def test_document_ids_tell_odd_keys_apart(spark):
    rows = [("a:b", "c"), ("a", "b:c"), (None, "c"), ("\\N", "c"), ("-", "c"), ("", "-c")]
    df = spark.createDataFrame(rows, "x string, y string")
    assert df.select(bulk.document_id("x", "y")).distinct().count() == len(rows)
