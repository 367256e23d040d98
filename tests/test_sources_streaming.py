"""Readers, writers, catalog and the streaming log parse."""

import os

import pytest
from pyspark.sql import functions as F

from tessera.sources import readers as rd
from tessera.streaming import logs as slogs


def _write(path, text):
    with open(path, "w") as f:
        f.write(text)


def test_csv_schema_bad_cells_null(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "r.csv")
    _write(p, "userId,movieId,rating,extra\n1,10,4.5,x\n2,oops,3.0,y\n")
    df = rd.read_csv(spark, p, "userId int, movieId int, rating double")
    rows = [tuple(r) for r in df.collect()]
    assert rows == [(1, 10, 4.5), (2, None, 3.0)]


def test_tsv_doubles_and_labeled_points(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "d.txt")
    _write(p, "1.0\t2.0\t3.0\t4.0\t5.0\n")
    df = rd.read_tsv_doubles(spark, p, ["AT", "V", "AP", "RH", "PE"])
    assert df.columns == ["AT", "V", "AP", "RH", "PE"] and df.collect()[0].PE == 5.0
    lines = spark.createDataFrame([("2001.0,0.5,1.5",)], "value string")
    lp = rd.labeled_points(lines).collect()[0]
    assert lp.label == 2001.0 and lp.features.toArray().tolist() == [0.5, 1.5]


def test_positional_fields(spark):
    lines = spark.createDataFrame([("1\ta\tb\n",), ("x\tc",)], "value string")
    rows = rd.positional_fields(lines).collect()
    assert rows[0].label == 1.0 and [(f.pos, f.value) for f in rows[0].features] == [(0, "a"), (1, "b")]
    assert rows[1].label is None


def test_first_lines_and_tsv_export(spark, tmpdir_path):
    src = os.path.join(tmpdir_path, "src.txt")
    _write(src, "".join(f"line {i}\n" for i in range(50)))
    dst = os.path.join(tmpdir_path, "head")
    rd.write_first_lines(spark, src, dst, 10)
    assert spark.read.text(dst).count() == 10
    out = os.path.join(tmpdir_path, "tsv")
    rd.write_tsv(spark.createDataFrame([(1, "a")], "k int, v string"), out)
    assert spark.read.text(out).collect()[0].value == "1\ta"


def test_catalog_and_bounded_results(spark):
    df = spark.range(5)
    rd.register(df, "five")
    assert "five" in rd.list_tables(spark)
    assert [c for c, _ in rd.describe_columns(spark, "five")] == ["id"]
    assert rd.drop_view(spark, "five")
    assert len(rd.head_rows(df, 2)) == 2
    with pytest.raises(ValueError):
        rd.to_local(df, max_rows=3)
    assert rd.partition_sizes(df.repartition(2)).agg(F.sum("count")).collect()[0][0] == 5
    assert "Range" in rd.plan_text(df)


def test_keyed_text_skips_nulls(spark):
    df = spark.createDataFrame([(1, "t", None, "m")], "id long, title string, description string, manufacturer string")
    assert rd.keyed_text(df, "id", ["title", "description", "manufacturer"]).collect()[0].text == "t m"


def test_streaming_status_counts(spark, tmpdir_path):
    folder = os.path.join(tmpdir_path, "logs")
    os.makedirs(folder)
    good = 'h1 - - [01/Aug/1995:00:00:01 -0400] "GET /a HTTP/1.0" 200 10\n'
    miss = 'h2 - - [01/Aug/1995:00:00:02 -0400] "GET /b HTTP/1.0" 404 -\n'
    _write(os.path.join(folder, "a.txt"), good * 3 + miss)
    counts = slogs.status_counts_stream(slogs.read_log_stream(spark, folder))
    q = (counts.writeStream.outputMode("complete").format("memory").queryName("status_counts")
         .option("checkpointLocation", os.path.join(tmpdir_path, "ckpt")).start())
    try:
        q.processAllAvailable()
        got = {r.status: r["count"] for r in spark.sql("SELECT * FROM status_counts").collect()}
    finally:
        q.stop()
    assert got == {200: 3, 404: 1}


def test_unreadable_cells_give_null_vectors_and_are_counted(spark):
    points = rd.labeled_points(spark.createDataFrame([("1,2,3",), ("1,x,3",), ("y,2,3",), ("4",)], "value string"))
    rows = points.collect()
    assert list(rows[0].features) == [2.0, 3.0] and rows[1].features is None and rows[2].label is None
    assert tuple(rd.unreadable_points(points).first()) == (1, 1)


def test_text_scan_rows_and_slices(spark, tmpdir_path):
    with open(f"{tmpdir_path}/a.txt", "w") as f:
        f.write("one\n\ntwo\n")
    assert [r.value for r in rd.read_lines(spark, f"{tmpdir_path}/a.txt").collect()] == ["one", "", "two"]
    df = rd.from_rows(spark, [(1, "a"), (2, "b"), (3, "c")], "id int, t string", partitions=3)
    assert df.rdd.getNumPartitions() == 3 and df.count() == 3


def test_named_tables_expressions_and_sql(spark):
    df = spark.createDataFrame([(1, 2.0), (2, 5.0)], "id int, x double")
    rd.register(df, "pairs_for_test")
    assert rd.named_table(spark, "pairs_for_test").count() == 2
    assert [r.y for r in rd.select_text(df, "id", "x * 2 AS y").orderBy("id").collect()] == [4.0, 10.0]
    assert rd.sql_over(spark, "SELECT sum(x) AS s FROM t_for_test", t_for_test=df).first().s == 7.0


def test_release(spark):
    df = spark.range(10).cache()
    df.count()
    assert rd.cached(df) and not rd.cached(rd.release(df))
