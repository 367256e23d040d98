"""File sources and sinks: tables written as text with planted bad lines, and read back.

Each query writes below the shared folder, so it runs on any cluster, and reads the files with the
library's readers.  Which lines are spoiled follows from a key, so SQL over the table that the
lines came from can tell good sums, bad counts and the text of the bad lines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.ml.functions import vector_to_array

from tessera.queries import exact_sum, query, r
from tessera.session import shared_path
from tessera.sources import readers
from tessera.sources.fixtures import Views, duck_with


def _told(checked: DataFrame, *sums) -> DataFrame:
    """One row: good and bad lines, the least and the greatest text of a bad line, and sums over the good ones."""
    good = F.col(readers.BAD_LINE).isNull()
    line = F.col(readers.BAD_LINE)
    return checked.agg(F.count_if(good).alias("good"), F.count_if(~good).alias("bad"), F.min(line).alias("first_bad"),
                       F.max(line).alias("last_bad"), *sums)


_CUSTOMER = "c_custkey BIGINT, c_name STRING, c_acctbal DOUBLE"


@query("csv_checked", """
WITH t AS (SELECT c_custkey AS k, c_name AS n, c_acctbal AS b, c_custkey % 97 = 0 AS bad FROM customer)
SELECT count(*) FILTER (NOT bad) AS good, count(*) FILTER (bad) AS bad, min(k || ',' || n || ',n/a') FILTER (bad) AS first_bad,
       max(k || ',' || n || ',n/a') FILTER (bad) AS last_bad, CAST(sum(CAST(b AS DECIMAL(18, 2))) FILTER (NOT bad) AS DOUBLE) AS balance,
       count(DISTINCT n) FILTER (NOT bad) AS names FROM t""")
def csv_checked(spark, sf):
    """A CSV file with a header and a declared schema; a balance that is no number spoils its line."""
    c = Views(spark, sf).customer
    path = shared_path(spark, "csv")
    spoiled = F.when(F.col("c_custkey") % 97 == 0, "n/a").otherwise(F.col("c_acctbal").cast("string"))
    c.select("c_custkey", "c_name", spoiled.alias("c_acctbal")).write.option("header", True).csv(path)
    good = F.col(readers.BAD_LINE).isNull()
    return _told(readers.read_csv_checked(spark, path, _CUSTOMER),
                 F.sum(F.when(good, F.col("c_acctbal").cast("decimal(18,2)"))).cast("double").alias("balance"),
                 F.count_distinct(F.when(good, F.col("c_name"))).alias("names"))


_PLANT = ["f1", "f2", "f3", "f4", "target"]


@query("tsv_checked", duck_with("plant") + """,
t AS (SELECT *, id % 101 = 0 AS bad FROM plant)
SELECT count(*) FILTER (NOT bad) AS good, count(*) FILTER (bad) AS bad, """ + ", ".join(
    f"CAST(sum(CAST({c} AS DECIMAL(18, 2))) FILTER (NOT bad) AS DOUBLE) AS {c}" for c in _PLANT) + " FROM t")
def tsv_checked(spark, sf):
    """Tab-separated numbers written and read as five doubles; a word among them spoils a line."""
    p = Views(spark, sf).plant
    path = shared_path(spark, "tsv")
    spoiled = F.when(F.col("id") % 101 == 0, "none").otherwise(F.col("f2").cast("string"))
    readers.write_tsv(p.select("f1", spoiled.alias("f2"), "f3", "f4", "target"), path)
    checked = readers.read_csv_checked(spark, path, ", ".join(f"{c} DOUBLE" for c in _PLANT), header=False, sep="\t")
    bad = readers.bad_lines(checked).agg(F.count("*").alias("n")).first()["n"]
    return readers.good_lines(checked).agg(F.count("*").alias("good"), F.lit(bad).cast("long").alias("bad"),
                                           *[exact_sum(c).alias(c) for c in _PLANT])


@query("points_checked", """
WITH t AS (SELECT vec_id, label, CAST(embedding[1] AS DOUBLE) AS x, vec_id % 53 = 0 AS bad FROM embeddings)
SELECT count(*) AS points, count(*) FILTER (bad) AS bad_vectors, CAST(sum(label) AS DOUBLE) AS labels,
       round(sum(x) FILTER (NOT bad), 6) AS first FROM t""")
def points_checked(spark, sf):
    """Lines of a label and numbers as text, read to labelled vectors; a line with a bad cell has no vector."""
    e = Views(spark, sf).embeddings
    path = shared_path(spark, "points")
    cells = F.transform("embedding", lambda x: x.cast("double").cast("string"))
    spoiled = F.when(F.col("vec_id") % 53 == 0, F.concat(F.slice(cells, F.lit(1), F.size(cells) - 1), F.array(F.lit("?")))).otherwise(cells)
    e.select(F.concat_ws(",", F.col("label").cast("string"), spoiled).alias("value")).write.text(path)
    points = readers.labeled_points(readers.read_lines(spark, path))
    bad = readers.unreadable_points(points).first()
    first = F.when(F.col("features").isNotNull(), vector_to_array("features")[0])
    return points.agg(F.count("*").alias("points"), F.lit(bad["bad_vectors"]).cast("long").alias("bad_vectors"),
                      F.sum("label").alias("labels"), r(F.sum(first)).alias("first"))


@query("first_lines", "SELECT p_name || ' ' || p_partkey AS value FROM part ORDER BY p_partkey LIMIT 100")
def first_lines(spark, sf):
    """K3: the first 100 lines of a text file into another (the limit is the feature)."""
    path, short = shared_path(spark, "lines"), shared_path(spark, "first")
    named = Views(spark, sf).part.orderBy("p_partkey").select(F.concat_ws(" ", "p_name", F.col("p_partkey").cast("string")).alias("value"))
    named.coalesce(1).write.text(path)             # one file, whose lines have an order
    readers.write_first_lines(spark, path, short, 100)
    return readers.read_lines(spark, short)
