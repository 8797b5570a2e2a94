"""Text repair against a short Python model of the same decoding."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from bench import scan_repair as model
from tests.conftest import plan_of
from tunemill.functions.text import clean_name, decode_text, escape_text


PIECES = st.sampled_from([
    "a", "Z", " ", '"', "'", "\\", "\\303", "\\266", "\\n", "\\t", "\\\\", '\\"', "\\x41", "\\xc3",
    "\\xb6", "\\x4", "\\u0041", "\\u20ac", "\\u00c3", "\\U00000042", "\\U0001F600", "\\q", "\\7",
    "\\400", "\\1234", "é", "Ã", "¶", "日", "\n", "\\\n", "\\a", "\\8", "$", "\\b", "\r", "\\\r"])


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(PIECES, max_size=7).map("".join), min_size=200, max_size=400))
def test_decode_equals_the_model(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for row in df.select("t", decode_text("t").alias("d")).collect():
        assert row.d == model(row.t), repr(row.t)


def test_decode_known_pairs(spark):
    pairs = [(r"Bj\303\266rk", "Björk"), ('"quoted"', "quoted"), ("", ""), (None, None),
             ("café", "café"), ("日本", "日本"), ("\\303", "\\303"), ("end\\", "end\\")]
    df = spark.createDataFrame(pairs, "t string, want string")
    assert df.where(~decode_text("t").eqNullSafe(F.col("want"))).count() == 0


def test_round_trip(spark):
    texts = ["Björk", "日本 text", "a\\b", "plain", "tab\there", "mixed \\303 é"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    back = df.select("t", decode_text(escape_text("t")).alias("d"))
    assert back.where("NOT t <=> d").count() == 0


def test_clean_name(spark):
    df = spark.createDataFrame([('"A\\B"', "AB"), ("C", "C"), (None, None)], "t string, want string")
    assert df.where(~clean_name("t").eqNullSafe(F.col("want"))).count() == 0


def test_no_python_in_the_plan(spark):
    df = spark.createDataFrame([("a",)], "t string").select(decode_text("t"))
    assert "Python" not in plan_of(df).replace("PythonRDD", "")
