import pytest
from pyspark.sql import functions as F

from conftest import plan_of
from tripflow.operators import sampling


@pytest.fixture(scope="module")
def rows(spark):
    return spark.range(20_000).withColumn("v", F.col("id") % 7)


def ids(df):
    return sorted(r.id for r in df.select("id").collect())


@pytest.mark.parametrize("n", [1, 17, 5_000, 19_999])
def test_exact_size_and_brute_force(rows, n):
    expected = rows.orderBy(sampling.sample_hash(["id"])).limit(n)
    assert ids(sampling.sample_exact(rows, n, ["id"])) == ids(expected)


@pytest.mark.parametrize("small", [1, 10, 100_000])
def test_every_refinement_depth(rows, small):
    assert ids(sampling.sample_exact(rows, 777, ["id"], small=small)) == ids(sampling.sample_exact(rows, 777, ["id"]))


def test_partitioning_does_not_matter(rows):
    a = sampling.sample_exact(rows.repartition(3, "v"), 100, ["id"])
    b = sampling.sample_exact(rows.coalesce(1), 100, ["id"])
    assert ids(a) == ids(b)


def test_seed_matters(rows):
    assert ids(sampling.sample_exact(rows, 100, ["id"])) != ids(sampling.sample_exact(rows, 100, ["id"], seed=7))


def test_sample_is_a_filter(rows):
    plan = plan_of(sampling.sample_exact(rows, 5_000, ["id"]))
    assert "Exchange" not in plan and "Sort" not in plan and "TakeOrdered" not in plan


def test_capped_at_the_row_count(rows):
    assert sampling.sample_exact(rows, 20_000, ["id"]).count() == 20_000
    assert sampling.sample_exact(rows, 30_000, ["id"]).count() == 20_000
    assert sampling.sample_exact(rows, 0, ["id"]).count() == 0
    with pytest.raises(ValueError):
        sampling.sample_exact(rows, -1, ["id"])


def test_roughly_uniform(rows):
    counts = [r["count"] for r in sampling.sample_exact(rows, 7_000, ["id"]).groupBy("v").count().collect()]
    assert len(counts) == 7 and all(850 < c < 1150 for c in counts)


@pytest.mark.parametrize("n", [1, 1_000, 6_000, 9_999])
def test_hot_key(spark, n):
    """A third and more of all rows share one key: the sample still has exactly n rows."""
    hot = spark.range(10_000).withColumn("key", F.when(F.col("id") < 4_000, F.lit(0)).otherwise(F.col("id")))
    picked = sampling.sample_exact(hot, n, ["key"], small=100)
    assert picked.count() == n and picked.select("id").distinct().count() == n


def test_all_rows_share_the_key(spark):
    same = spark.range(5_000).withColumn("key", F.lit(None).cast("string"))
    assert sampling.sample_exact(same, 1_234, ["key"]).select("id").distinct().count() == 1_234


def test_file_to_file(spark, trip_dir, tmp_path):
    source, target = f"{trip_dir}/yellow", f"{tmp_path}/sample"
    sampling.sample_parquet(spark, source, target, 300)
    sample = spark.read.parquet(target)
    assert sample.count() == 300 and sample.schema == spark.read.parquet(source).schema
    sampling.sample_parquet(spark, source, f"{tmp_path}/again", 300)
    assert spark.read.parquet(f"{tmp_path}/again").exceptAll(sample).isEmpty()
    sampling.sample_parquet(spark, source, f"{tmp_path}/all", 10**7)
    assert spark.read.parquet(f"{tmp_path}/all").count() == spark.read.parquet(source).count()


def test_copies_are_separate_candidates(spark, tmp_path):
    spark.range(1_000).select(F.lit(1).alias("x")).write.parquet(f"{tmp_path}/copies")
    sampling.sample_parquet(spark, f"{tmp_path}/copies", f"{tmp_path}/s", 123)
    assert spark.read.parquet(f"{tmp_path}/s").count() == 123


def test_empty_and_missing_source(spark, tmp_path):
    spark.range(0).write.parquet(f"{tmp_path}/empty")
    with pytest.raises(ValueError, match="no rows"):
        sampling.sample_parquet(spark, f"{tmp_path}/empty", f"{tmp_path}/s", 5)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        sampling.sample_parquet(spark, f"{tmp_path}/missing", f"{tmp_path}/s", 5)


def test_first_rows(rows):
    assert ids(sampling.first_rows(rows, 3, ["id"])) == [0, 1, 2]
