"""Stand-in views over the test tables (see FIXTURES.md section 2).

Each view is defined twice from the same rule: once as a Spark DataFrame
(``Views``) and once as DuckDB SQL (``DUCK_VIEWS``) for the oracle.  Both read
the whole base tables, so the work grows with the scale factor.
"""

from __future__ import annotations


from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.ml.functions import array_to_vector

from tessera.functions.logs import MONTHS

BASE_TABLES = ("region nation customer supplier part orders lineitem events documents "
               "embeddings pages benchmark labels conversations").split()


def md5_key(*cols: str) -> F.Column:
    """A 60-bit bigint from md5 of the '|'-joined key columns (same rule in DuckDB).

    Key columns must be integers or strings so both engines render them alike.
    """
    joined = F.concat_ws("|", *[F.col(c).cast("string") for c in cols])
    return F.conv(F.substring(F.md5(joined), 1, 15), 16, 10).cast("bigint")


def duck_md5_key(*cols: str) -> str:
    joined = "concat_ws('|', " + ", ".join(f"CAST({c} AS VARCHAR)" for c in cols) + ")"
    return f"('0x' || substr(md5({joined}), 1, 15))::BIGINT"


# lineitem has no declared key; these columns are unique at every test scale
# (orderkey..linenumber alone repeat at sf0.001).  Quantity is integral.
LINE_KEY = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_qty_int", "l_returnflag", "l_linestatus")


def _with_line_key_cols(li: DataFrame) -> DataFrame:
    return li.withColumn("l_qty_int", F.col("l_quantity").cast("bigint"))


class Views:
    """Lazy base tables and stand-in views for one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def __getattr__(self, name: str) -> DataFrame:
        if name in BASE_TABLES:
            return self.table(name)
        raise AttributeError(name)

    # -- ratings / items (recommendation stand-ins)
    @property
    def ratings(self) -> DataFrame:
        li = self.table("lineitem").select("l_orderkey", "l_partkey", "l_quantity")
        o = self.table("orders").select("o_orderkey", "o_custkey")
        return (li.join(o, li.l_orderkey == o.o_orderkey)
                .select(F.col("o_custkey").alias("userId"), F.col("l_partkey").alias("movieId"),
                        F.col("l_quantity").alias("rating")))

    @property
    def items(self) -> DataFrame:
        return self.table("part").select(F.col("p_partkey").alias("ID"), F.col("p_name").alias("title"))

    # -- web access log rendered from events
    @property
    def access_log(self) -> DataFrame:
        e = self.table("events")
        # built from date parts: exact for a timestamp_ntz whatever the session zone
        ts = F.col("ts")
        two = lambda c: F.lpad(c.cast("string"), 2, "0")
        clf = F.concat(two(F.dayofmonth(ts)), F.lit("/"),
                       F.element_at(F.array(*[F.lit(m) for m in MONTHS]), F.month(ts)), F.lit("/"),
                       F.lpad(F.year(ts).cast("string"), 4, "0"), F.lit(":"), two(F.hour(ts)), F.lit(":"),
                       two(F.minute(ts)), F.lit(":"), two(F.second(ts)))
        ts_text = F.when(F.col("event_id") % 101 == 0, F.lit("01/Xyz/2024:25:61:61")).otherwise(clf)
        status = (F.when(F.col("event_id") % 20 == 3, F.lit(404))
                  .when(F.col("event_id") % 20 == 7, F.lit(500))
                  .when(F.col("event_id") % 10 == 1, F.lit(304))
                  .otherwise(F.lit(200)))
        size = F.when(F.col("event_id") % 17 == 0, F.lit("-")) \
                .otherwise(F.floor(F.col("value") * 100).cast("bigint").cast("string"))
        line = F.concat(
            F.lit("user"), F.col("user_id").cast("string"), F.lit(".host.net - - ["), ts_text,
            F.lit(" -0400] \"GET /"), F.col("event_type"), F.lit("/"),
            (F.col("user_id") % 25).cast("string"), F.lit(".html HTTP/1.0\" "),
            status.cast("string"), F.lit(" "), size)
        return e.select(line.alias("value"))

    # -- power plant stand-in
    @property
    def plant(self) -> DataFrame:
        li = _with_line_key_cols(self.table("lineitem")).select(
            *LINE_KEY, "l_quantity", "l_discount", "l_tax", "l_extendedprice")
        p = self.table("part").select("p_partkey", "p_retailprice")
        return (li.join(p, li.l_partkey == p.p_partkey)
                .select(md5_key(*LINE_KEY).alias("id"),
                        F.col("l_quantity").alias("f1"), F.col("l_discount").alias("f2"),
                        F.col("l_tax").alias("f3"), F.col("p_retailprice").alias("f4"),
                        F.col("l_extendedprice").alias("target")))

    # -- click log stand-in: id + tab-separated label and five categorical fields
    @property
    def clicks(self) -> DataFrame:
        li = _with_line_key_cols(self.table("lineitem")).select(*LINE_KEY)
        o = self.table("orders").select("o_orderkey", "o_custkey", "o_orderpriority")
        p = self.table("part").select("p_partkey", "p_brand", "p_type")
        c = self.table("customer").select("c_custkey", "c_mktsegment")
        j = (li.join(o, li.l_orderkey == o.o_orderkey)
               .join(p, li.l_partkey == p.p_partkey)
               .join(c, o.o_custkey == c.c_custkey))
        label = F.when(F.col("l_returnflag") == "R", F.lit("1")).otherwise(F.lit("0"))
        value = F.concat_ws("\t", label, "l_linestatus", "o_orderpriority", "p_brand", "p_type", "c_mktsegment")
        return j.select(md5_key(*LINE_KEY).alias("id"), value.alias("value"))

    # -- entity-resolution stand-ins
    @property
    def rec_a(self) -> DataFrame:
        d = self.table("documents")
        return d.filter(F.col("doc_id") % 2 == 0).select(F.col("doc_id").alias("id"), "text")

    @property
    def rec_b(self) -> DataFrame:
        d = self.table("documents")
        return d.filter(F.col("doc_id") % 2 == 1).select(F.col("doc_id").alias("id"), "text")

    @property
    def gold(self) -> DataFrame:
        # equal texts by their 256-bit digests: the texts themselves don't move
        a = self.rec_a.select(F.col("id").alias("id_a"), F.sha2("text", 256).alias("digest"))
        b = self.rec_b.select(F.col("id").alias("id_b"), F.sha2("text", 256).alias("digest"))
        return a.join(b, "digest").select("id_a", "id_b")

    # -- labelled vectors
    @property
    def years(self) -> DataFrame:
        e = self.table("embeddings")
        return e.select(F.col("vec_id").alias("id"), F.col("label").cast("double").alias("label"),
                        array_to_vector(F.transform("embedding", lambda x: x.cast("double"))).alias("features"))

    # -- scores with ties, for evaluation
    @property
    def scored(self) -> DataFrame:
        e = self.table("events")
        return e.select(
            F.col("event_id").alias("id"),
            F.when(F.col("event_type") == "purchase", F.lit(1.0)).otherwise(F.lit(0.0)).alias("label"),
            (F.floor(F.col("value") / (F.col("value") + 1) * 1000) / 1000).alias("p"))


# DuckDB twins of the views above: same rule, used by the oracle SQL.
_DUCK_LINE_KEY = [c if c != "l_qty_int" else "CAST(l_quantity AS BIGINT)" for c in LINE_KEY]
_STATUS = ("CASE WHEN event_id % 20 = 3 THEN 404 WHEN event_id % 20 = 7 THEN 500 "
           "WHEN event_id % 10 = 1 THEN 304 ELSE 200 END")
DUCK_VIEWS: dict[str, str] = {
    "ratings": "SELECT o_custkey AS userId, l_partkey AS movieId, l_quantity AS rating "
               "FROM lineitem JOIN orders ON l_orderkey = o_orderkey",
    "items": "SELECT p_partkey AS ID, p_name AS title FROM part",
    "access_log": (
        "SELECT 'user' || CAST(user_id AS VARCHAR) || '.host.net - - [' || "
        "CASE WHEN event_id % 101 = 0 THEN '01/Xyz/2024:25:61:61' "
        "ELSE strftime(ts, '%d/%b/%Y:%H:%M:%S') END || "
        "' -0400] \"GET /' || event_type || '/' || CAST(user_id % 25 AS VARCHAR) || "
        "'.html HTTP/1.0\" ' || CAST(" + _STATUS + " AS VARCHAR) || ' ' || "
        "CASE WHEN event_id % 17 = 0 THEN '-' ELSE CAST(CAST(floor(value * 100) AS BIGINT) AS VARCHAR) END "
        "AS value FROM events"),
    "plant": (f"SELECT {duck_md5_key(*_DUCK_LINE_KEY)} AS id, l_quantity AS f1, l_discount AS f2, "
              "l_tax AS f3, p_retailprice AS f4, l_extendedprice AS target "
              "FROM lineitem JOIN part ON l_partkey = p_partkey"),
    "clicks": (f"SELECT {duck_md5_key(*_DUCK_LINE_KEY)} AS id, concat_ws(chr(9), "
               "CASE WHEN l_returnflag = 'R' THEN '1' ELSE '0' END, l_linestatus, o_orderpriority, "
               "p_brand, p_type, c_mktsegment) AS value "
               "FROM lineitem JOIN orders ON l_orderkey = o_orderkey "
               "JOIN part ON l_partkey = p_partkey JOIN customer ON o_custkey = c_custkey"),
    "rec_a": "SELECT doc_id AS id, text FROM documents WHERE doc_id % 2 = 0",
    "rec_b": "SELECT doc_id AS id, text FROM documents WHERE doc_id % 2 = 1",
    "gold": "SELECT a.id AS id_a, b.id AS id_b FROM rec_a a JOIN rec_b b ON a.text = b.text",
    "scored": ("SELECT event_id AS id, CASE WHEN event_type = 'purchase' THEN 1.0 ELSE 0.0 END::DOUBLE AS label, "
               "floor(value / (value + 1) * 1000) / 1000 AS p FROM events"),
}

# views that other views are built from
_DUCK_DEPS = {"gold": ["rec_a", "rec_b"]}


def duck_with(*views: str) -> str:
    """A WITH clause defining the named stand-in views (and what they need)."""
    order: list[str] = []

    def add(v: str) -> None:
        for d in _DUCK_DEPS.get(v, []):
            add(d)
        if v not in order:
            order.append(v)

    for v in views:
        add(v)
    return "WITH " + ",\n".join(f"{v} AS ({DUCK_VIEWS[v]})" for v in order) + "\n"
