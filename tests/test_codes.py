import pytest
from pyspark.sql import functions as F

from tripflow.functions import codes


def one(spark, value, column, dtype="int"):
    df = spark.createDataFrame([(value,)], f"c {dtype}")
    return df.select(column).first()[0]


VALID = [(s, c, n, d) for s, rows in codes.CODE_SETS.items() for c, n, d in rows]
INTEGER_SETS = ("vendor", "rate", "trip_type", "payment")


def test_every_code(spark):
    for code_set, rows in codes.CODE_SETS.items():
        dtype = "string" if code_set == "flag" else "int"
        df = spark.createDataFrame([(r[0],) for r in rows], f"c {dtype}")
        got = df.select(
            "c", codes.decode("c", code_set, "name"), codes.decode("c", code_set), codes.is_code("c", code_set)
        ).collect()
        assert [tuple(r) for r in got] == [(*row, True) for row in rows]


@pytest.mark.parametrize("code_set", INTEGER_SETS)
def test_unknown_codes(spark, code_set):
    """Every integer from -1 to 100 that is not in the set."""
    known = {r[0] for r in codes.CODE_SETS[code_set]}
    df = spark.range(-1, 101).selectExpr("cast(id as int) as c").where(~F.col("c").isin(*known))
    columns = [codes.decode("c", code_set), codes.is_code("c", code_set)]
    if code_set in codes.TYPE_NAMES:
        columns.append(codes.render_code("c", code_set))
    got = {tuple(r)[:2] for r in df.select(*columns).collect()}
    assert got == {(None, False)} and df.count() == 102 - len(known)


# The texts of a failed lookup are part of its contract.
@pytest.mark.parametrize(
    "code_set, message",
    [
        ("vendor", "Invalid VendorID code: 99"),
        ("rate", "Invalid RatecodeID code: 99"),
        ("trip_type", "Invalid TripType code: 99"),
    ],
)
def test_decode_or_fail(spark, code_set, message):
    known = 99 if code_set == "rate" else None
    if known:
        assert one(spark, known, codes.decode("c", code_set, on_unknown="error")) == "Null/unknown"
        message = message.replace("99", "98")
    code = 98 if known else 99
    with pytest.raises(Exception, match=message):
        one(spark, code, codes.decode("c", code_set, on_unknown="error"))


def test_rendered_form(spark):
    assert (
        one(spark, 1, codes.render_code("c", "vendor"))
        == "VendorID{code=1, description='Creative Mobile Technologies, LLC'}"
    )
    assert one(spark, 2, codes.render_code("c", "trip_type")) == "TripType{code=2, description='Dispatch'}"


def test_null_code(spark):
    assert one(spark, None, codes.is_code("c", "vendor")) is False
    assert one(spark, None, codes.decode("c", "vendor")) is None


def test_join_form_equals_lookup(spark):
    df = spark.createDataFrame([(c,) for c in (1, 2, 99, 42, None)], "RatecodeID int")
    joined = codes.decode_join(df, "RatecodeID", "rate")
    looked_up = df.select(
        "RatecodeID", codes.decode("RatecodeID", "rate", "name"), codes.decode("RatecodeID", "rate")
    )
    assert sorted(map(str, joined.collect())) != []
    assert {tuple(r) for r in joined.collect()} == {tuple(r) for r in looked_up.collect()}


def test_bad_arguments(spark):
    with pytest.raises(ValueError, match="unknown code set"):
        codes.decode("c", "colour")
    with pytest.raises(ValueError, match="on_unknown"):
        codes.decode("c", "vendor", on_unknown="ignore")
