import math
import zlib
from collections import Counter, defaultdict

from tripflow.llm import sharding
from tripflow.llm.ranks import gapless_rank


def write(spark, tmp_path, rows):
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    return str(tmp_path)


def test_query_on_edge_cases(spark, tmp_path):
    rows = [(i, f"text é {i}") for i in range(500)] + [(7, "text é 7")] * 300 + [(None, None), (None, ""), (900, None)]
    found = sharding.op8_sharding(spark, write(spark, tmp_path, rows)).collect()
    assert len(found) == len(rows)
    slots = defaultdict(list)
    for r in found:
        assert 0 <= r["shard"] < 40 and r["grown_shard"] in (r["shard"], 40) and r["law"] == "key"
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    want = Counter((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in rows)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in found) == want
    assert len({r["shard"] for r in found if r["doc_id"] == 7}) == 1


def test_one_more_shard_takes_its_share_only_into_itself(spark):
    docs = spark.range(20_000).withColumnRenamed("id", "doc_id")
    before = sharding.assign_shards(docs, [1.0] * 10, name="before")
    both = sharding.assign_shards(before, [1.0] * 11, name="after").collect()
    moved = [r for r in both if r["before"] != r["after"]]
    assert all(r["after"] == 10 for r in moved)
    assert abs(len(moved) - 20_000 / 11) < 5 * math.sqrt(20_000 / 11)


def test_weights_set_the_shares(spark):
    docs = spark.range(20_000).withColumnRenamed("id", "doc_id")
    counts = Counter(r["shard"] for r in sharding.assign_shards(docs, [1.0, 3.0]).collect())
    assert abs(counts[1] - 15_000) < 400


def test_existing_column_is_replaced_and_empty_table_stays_empty(spark):
    docs = spark.createDataFrame([(1, "x")], "doc_id long, shard string")
    assert sharding.assign_shards(docs).first()["shard"] in range(40)
    assert sharding.assign_shards(docs.limit(0)).count() == 0


def test_gapless_rank_of_one_hot_group(spark):
    df = spark.createDataFrame([(0, i % 5, "a") for i in range(5000)] + [(1, None, "b")], "g int, o long, part string")
    found = gapless_rank(df, "g", ["o"], "place").collect()
    hot = sorted((r["place"], r["o"]) for r in found if r["g"] == 0)
    assert [p for p, _ in hot] == list(range(5000)) and [o for _, o in hot] == sorted(i % 5 for i in range(5000))
    assert [r["place"] for r in found if r["g"] == 1] == [0]
