"""Text and access-log operators."""

from pyspark.sql import functions as F

from tessera.functions import text as ftext
from tessera.operators import logs, text


def test_word_count_literals(spark):
    lines = spark.createDataFrame([("cat elephant rat",), ("rat cat",)], "value string")
    counts = {r.word: r["count"] for r in text.word_counts(lines).collect()}
    assert counts == {"cat": 2, "elephant": 1, "rat": 2}
    assert text.unique_words(lines).collect()[0][0] == 3


def test_plural_and_length(spark):
    df = spark.createDataFrame([("cat",), ("rat",)], "w string")
    out = df.select(ftext.plural("w").alias("p"), F.length("w").alias("n")).collect()
    assert [(r.p, r.n) for r in out] == [("cats", 3), ("rats", 3)]


def test_simple_tokens(spark):
    df = spark.createDataFrame([("A quick-brown fox!",), ("",), ("Crème brûlée_ok",)], "t string")
    toks = [r[0] for r in df.select(ftext.simple_tokens("t")).collect()]
    assert toks[0] == ["a", "quick", "brown", "fox"]
    assert toks[1] == []
    # ASCII word classes: accented letters separate words; underscore is a word character
    assert toks[2] == ["cr", "me", "br", "l", "e_ok"]


def test_tokens_without_stop_words(spark):
    df = spark.createDataFrame([("The cat and THE dog",)], "t string")
    assert df.select(ftext.tokens_without("t")).collect()[0][0] == ["cat", "dog"]


def test_remove_punctuation(spark):
    df = spark.createDataFrame([("  Hi, you_there!  ",), ("\tA-b 9.",)], "t string")
    assert [r[0] for r in df.select(ftext.remove_punctuation("t")).collect()] == ["hi youthere", "ab 9"]


def test_top_words_tie_break(spark):
    lines = spark.createDataFrame([("b a c a b",)], "value string")
    out = [(r.word, r["count"]) for r in text.top_words(lines, 2).collect()]
    assert out == [("a", 2), ("b", 2)]


def test_lines_of_whole_text(spark):
    docs = spark.createDataFrame([(1, "x y\n\nz")], "id long, text string")
    out = [r.value for r in text.lines_of(docs, keep=["id"]).orderBy("line_no").collect()]
    assert out == ["x y", "", "z"]


GOOD = 'in24.inetnebr.com - - [01/Aug/1995:00:00:01 -0400] "GET /shuttle/missions/sts-68/news/sts-68-mcc-05.txt HTTP/1.0" 200 1839'
DASH = 'uplherc.upl.com - - [01/Aug/1995:00:00:07 -0400] "GET / HTTP/1.0" 304 -'
BROKEN = 'bad.host - - [01/Xyz/1995:25:00:07 +0200] "GET /x HTTP/1.0" 200 12'


def test_log_parse(spark):
    lines = spark.createDataFrame([(GOOD,), (DASH,), (BROKEN,)], "value string")
    rows = logs.parse(lines).select("host", "path", "status", "content_size",
                                    F.col("time").cast("string").alias("t")).collect()
    assert tuple(rows[0]) == ("in24.inetnebr.com", "/shuttle/missions/sts-68/news/sts-68-mcc-05.txt", 200, 1839,
                              "1995-08-01 00:00:01")
    assert tuple(rows[1]) == ("uplherc.upl.com", "/", 304, 0, "1995-08-01 00:00:07")
    assert rows[2].host == "bad.host" and rows[2].t is None


def test_log_quality(spark):
    lines = spark.createDataFrame([(GOOD,), (DASH,), (BROKEN,)], "value string")
    q = logs.quality(lines).collect()[0]
    assert q.lines == 3 and q.null_content_size == 1 and q.bad_size_lines == 1 and q.bad_rows == 1


def test_log_reports(spark):
    lines = spark.createDataFrame([(GOOD,)] * 12 + [(DASH,)], "value string")
    parsed = logs.parse(lines)
    st = {r.status: r["count"] for r in logs.status_counts(parsed).collect()}
    assert st == {200: 12, 304: 1}
    assert [r.host for r in logs.frequent_hosts(parsed, 10).collect()] == ["in24.inetnebr.com"]
    assert logs.top_paths(parsed, 1).collect()[0]["count"] == 12


def test_blank_lines_is_an_aggregate(spark):
    from tessera.operators.profile import blank_lines
    df = spark.createDataFrame([("a",), ("",), ("",)], "value string")
    assert blank_lines(df).collect()[0][0] == 2


def test_log_time_independent_of_session_zone(spark):
    # 02:30 on 12 Mar 2023 does not exist in Los Angeles; the log's wall clock must survive
    line = 'h - - [12/Mar/2023:02:30:00 -0800] "GET /a HTTP/1.0" 200 1'
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        df = spark.createDataFrame([(line,)], "value string")
        t = logs.parse(df).select(F.col("time").cast("string")).collect()[0][0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert t == "2023-03-12 02:30:00"


def test_log_sizes_past_32_bits_and_broken_lines(spark):
    big = 'h.net - - [01/Aug/1995:00:00:01 -0400] "GET /a HTTP/1.0" 200 3000000000'
    cut = 'h.net - - [01/Aug/1995:00:00:01 -0400] "GET /a'
    odd = 'h.net - - [01/Aug/1995:00:00:01 -0400] "GET /a "b" HTTP/1.0" 200 5'
    rows = logs.split_fields(spark.createDataFrame([(big,), (cut,), (odd,), ("",), ("justonehost",)], "value string")).collect()
    assert rows[0].content_size == 3_000_000_000 and rows[0].path == "/a" and rows[0].status == 200
    assert (rows[1].host, rows[1].timestamp, rows[1].path, rows[1].content_size) == ("h.net", "01/Aug/1995:00:00:01 -0400", None, None)
    assert (rows[2].path, rows[2].status, rows[2].content_size) == (None, 200, 5)
    assert all(v is None for r in rows[3:] for v in r)


def test_bad_lines_are_marked(spark):
    lines = spark.createDataFrame([(GOOD,), (DASH,), ("",)], "value string")
    assert {r.line for r in logs.bad_lines(lines).collect()} == {DASH + "*", "*"}
