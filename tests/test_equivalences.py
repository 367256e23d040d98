"""Two routes to one answer (the reference's own checks), as tests."""

import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import SF0001
from tessera import queries as q
from tessera.functions import text as ftext
from tessera.operators import profile


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_native_filter_equals_udf_filter(spark):
    assert _rows(q.QUERIES["filter_basic"](spark, SF0001)) == _rows(q.QUERIES["filter_udf"](spark, SF0001))


def test_distinct_pairs_equals_drop_duplicates(spark):
    c = spark.read.parquet(f"{SF0001}/customer.parquet")
    a = c.select("c_nationkey", "c_mktsegment").distinct().count()
    b = c.dropDuplicates(["c_nationkey", "c_mktsegment"]).count()
    assert a == b


def test_grouped_count_equals_reduced_count(spark):
    e = spark.read.parquet(f"{SF0001}/events.parquet").withColumn("one", F.lit(1))
    a = {r.event_type: r["count"] for r in profile.count_via_grouping(e, "event_type").collect()}
    b = {r.event_type: r["sum"] for r in profile.reduce_by_key(e, "event_type", "one").collect()}
    assert a == b


ALPHABET = st.sampled_from(list("abcXYZ019_ -.,!?\t\n") + ["é", "ü", "ß", "İ", "ç", "—"])


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text(alphabet=ALPHABET, max_size=40), min_size=1, max_size=6))
def test_tokens_match_python_ascii_regex(spark, texts):
    def py(s):
        spaced = re.sub(r"\W+", " ", s, flags=re.ASCII).lower()
        return [t for t in re.split(r"\W+", spaced, flags=re.ASCII) if t]

    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(ftext.simple_tokens("t")).collect()]
    assert got == [py(t) for t in texts]


@settings(max_examples=30, deadline=None)
@given(st.lists(st.text(alphabet=ALPHABET, max_size=40), min_size=1, max_size=6))
def test_remove_punctuation_matches_python(spark, texts):
    def py(s):
        return re.sub(r"[^A-Za-z\s\d]", "", s, flags=re.ASCII).strip(" \t\n\r\x0b\x0c").lower()

    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(ftext.remove_punctuation("t")).collect()]
    assert got == [py(t) for t in texts]
