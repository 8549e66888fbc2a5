from tripflow.operators.metrics import row_counts


def test_row_counts_include_empty_frames(spark):
    counts = row_counts({"some": spark.range(5), "none": spark.range(0)})
    assert {r.table_name: r.n_rows for r in counts.collect()} == {"some": 5, "none": 0}


def test_row_counts_of_a_hot_frame_combine_before_the_shuffle(spark):
    plan = row_counts({"a": spark.range(10), "b": spark.range(10)})._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 2 and plan.count("partial_count") == 2
