"""

Each query is ``fn(spark, sf_dir) -> DataFrame`` over the whole test tables
(or views Spark derives from them).  Where SQL can express the same result,
the DuckDB oracle sits right next to it; columns are aliased identically and
floating aggregates are rounded the same way on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import text as ftext
from tessera.operators import keys, logs, profile, relational as rel, similarity as sim, text
from tessera.session import checkpoint_dir
from tessera.sources.fixtures import Views, duck_with

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def r(c, places: int = 6):
    return F.round(c, places)


def exact_sum(c: str, scale: int = 2):
    """Sum of a column holding at most ``scale`` decimals, exact, as double."""
    return F.sum(F.col(c).cast(f"decimal(18,{scale})")).cast("double")


def _duck_exact_sum(c: str, scale: int = 2) -> str:
    return f"CAST(sum(CAST({c} AS DECIMAL(18,{scale}))) AS DOUBLE)"


# Stop words as a SQL list literal (same list as the Spark side).
_STOPS_SQL = "[" + ", ".join(f"'{w}'" for w in ftext.STOP_WORDS) + "]"
_WS = "' ' || chr(9) || chr(10) || chr(13) || chr(11) || chr(12)"
_PUNCT_RE = r"[^A-Za-z\s\d]"


def _duck_simple_tokens(col: str) -> str:
    return (f"list_filter(string_split_regex(lower(regexp_replace({col}, '\\W+', ' ', 'g')), '\\W+'), "
            f"lambda x: x <> '')")


def _duck_tokens(col: str) -> str:
    return f"list_filter({_duck_simple_tokens(col)}, lambda x: NOT list_contains({_STOPS_SQL}, x))"


def _duck_md5_unit(key: str, seed) -> str:
    return f"('0x' || substr(md5('{seed}:' || CAST({key} AS VARCHAR)), 1, 8))::BIGINT"


# =============================================================== C4 / A3 / J6
@query("popular_items", duck_with("ratings", "items") + """
SELECT r.movieId, i.title, count(r.rating) AS count, round(avg(r.rating), 6) AS average
FROM ratings r JOIN items i ON i.ID = r.movieId
GROUP BY r.movieId, i.title HAVING count(r.rating) >= 30""")
def popular_items(spark, sf, min_count: int = 30):
    v = Views(spark, sf)
    st = profile.count_and_mean(v.ratings, "movieId", "rating")
    j = rel.join_keys(st, v.items, "movieId", "ID")
    return (rel.having(j, F.col("count") >= min_count).orderBy(F.desc("average"), "movieId")
            .select("movieId", "title", "count", r(F.col("average")).alias("average")))


# ============================================================ projections
@query("project_basic", """
SELECT l_orderkey, l_linenumber, l_quantity - 1 AS qty_minus_one,
       l_extendedprice * (1 - l_discount) AS net_price, 'li' AS source, l_returnflag AS flag
FROM lineitem""")
def project_basic(spark, sf):
    li = Views(spark, sf).lineitem
    out = rel.project(li, "l_orderkey", "l_linenumber", (F.col("l_quantity") - 1).alias("qty_minus_one"),
                      (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("net_price"),
                      "l_returnflag")
    return rel.add_constant(out, "source", "li").withColumnRenamed("l_returnflag", "flag")


@query("explode_fields", duck_with("clicks") + """
SELECT id, CAST(i - 1 AS BIGINT) AS pos, parts[i + 1] AS value
FROM (SELECT id, unnest(range(1, len(parts))) AS i, parts
      FROM (SELECT id, string_split(value, chr(9)) AS parts FROM clicks))""")
def explode_fields(spark, sf):
    from tessera.sources.readers import positional_fields
    parsed = positional_fields(Views(spark, sf).clicks, keep=["id"])
    return parsed.select("id", F.inline("features"))


@query("conditional", """
SELECT CASE WHEN l_quantity <= 10 THEN 'small' WHEN l_quantity <= 30 THEN 'medium' ELSE 'large' END AS size_class,
       CASE WHEN l_discount >= 0.05 THEN 1 ELSE 0 END AS discounted, count(*) AS count
FROM lineitem GROUP BY 1, 2""")
def conditional(spark, sf):
    li = Views(spark, sf).lineitem
    size = (F.when(F.col("l_quantity") <= 10, "small").when(F.col("l_quantity") <= 30, "medium")
            .otherwise("large"))
    disc = F.when(F.col("l_discount") >= 0.05, 1).otherwise(0)
    return profile.count_by(li, size.alias("size_class"), disc.alias("discounted"))


# ================================================================ filters
@query("filter_basic", """
SELECT l_orderkey, l_partkey, l_quantity FROM lineitem WHERE l_quantity < 10""")
def filter_basic(spark, sf):
    li = Views(spark, sf).lineitem
    return rel.where(li, F.col("l_quantity") < 10).select("l_orderkey", "l_partkey", "l_quantity")


@query("filter_udf", ORACLES["filter_basic"])
def filter_udf(spark, sf):
    """The same filter through an Arrow (pandas) boolean UDF."""
    from tessera.functions.udf import less_than
    li = Views(spark, sf).lineitem
    return li.filter(less_than(10.0)(F.col("l_quantity"))).select("l_orderkey", "l_partkey", "l_quantity")


@query("filter_lookup", """
SELECT c_custkey, c_name, c_mktsegment FROM customer WHERE c_name = 'Customer#000000007'""")
def filter_lookup(spark, sf):
    c = Views(spark, sf).customer
    return rel.lookup_one(c, "c_name", "Customer#000000007").select("c_custkey", "c_name", "c_mktsegment")


_NOT_IN = list(range(2, 200, 18))


@query("filter_not_in", f"""
SELECT p_partkey, p_name FROM part WHERE p_partkey NOT IN ({", ".join(map(str, _NOT_IN))})""")
def filter_not_in(spark, sf):
    return rel.not_in(Views(spark, sf).part, "p_partkey", _NOT_IN).select("p_partkey", "p_name")


@query("filter_nan", duck_with("scored") + """
SELECT id, p FROM (
  SELECT id, CASE WHEN id % 13 = 0 THEN 'NaN'::DOUBLE WHEN id % 29 = 0 THEN NULL ELSE p END AS p FROM scored)
WHERE p IS NOT NULL AND NOT isnan(p)""")
def filter_nan(spark, sf):
    s = Views(spark, sf).scored
    planted = s.select("id", F.when(F.col("id") % 13 == 0, F.lit(float("nan")))
                       .when(F.col("id") % 29 == 0, F.lit(None).cast("double"))
                       .otherwise(F.col("p")).alias("p"))
    return rel.drop_nan_null(planted, "p")


@query("filter_stopwords", f"""
SELECT doc_id, CAST(len({_duck_simple_tokens('text')}) AS BIGINT) AS n_tokens,
       CAST(len({_duck_tokens('text')}) AS BIGINT) AS n_kept
FROM documents""")
def filter_stopwords(spark, sf):
    d = Views(spark, sf).documents
    # tokenise once; the projection is kept separate so the token array is not recomputed
    t = d.select("doc_id", ftext.simple_tokens("text").alias("t"))
    return t.select("doc_id", F.size("t").cast("long").alias("n_tokens"),
                    F.size(ftext.drop_stop_words("t")).cast("long").alias("n_kept"))


# ======================================================= scalar functions
@query("scalar_strings", r"""
SELECT p_partkey, regexp_extract(p_brand, 'Brand#(\d+)', 1) AS brand_no,
       regexp_matches(p_type, '^SMALL') AS is_small,
       p_name || ' / ' || p_type AS label, string_split(p_name, ' ')[1] AS first_word,
       CAST(length(p_name) AS INTEGER) AS name_len, p_name || 's' AS plural,
       replace(p_name || chr(10), chr(10), '') AS no_newline
FROM part""")
def scalar_strings(spark, sf):
    p = Views(spark, sf).part
    return p.select(
        "p_partkey", F.regexp_extract("p_brand", r"Brand#(\d+)", 1).alias("brand_no"),
        F.col("p_type").rlike("^SMALL").alias("is_small"),
        F.concat("p_name", F.lit(" / "), "p_type").alias("label"),
        F.element_at(ftext.words_of_line("p_name"), 1).alias("first_word"),
        F.length("p_name").alias("name_len"), ftext.plural("p_name").alias("plural"),
        ftext.strip_newlines(F.concat("p_name", F.lit("\n"))).alias("no_newline"))


@query("scalar_math", """
SELECT event_id, round(ln(1 + value), 9) AS ln1p, round(exp(-value / 100), 9) AS decay,
       round(sqrt(value), 9) AS root, round(1 / (1 + exp(-(value - 10) / 10)), 9) AS logistic
FROM events""")
def scalar_math(spark, sf):
    e = Views(spark, sf).events
    v = F.col("value")
    return e.select("event_id", r(F.ln(1 + v), 9).alias("ln1p"), r(F.exp(-v / 100), 9).alias("decay"),
                    r(F.sqrt(v), 9).alias("root"), r(1 / (1 + F.exp(-(v - 10) / 10)), 9).alias("logistic"))


@query("vector_norms", """
SELECT vec_id, round(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE))), 6) AS sq_norm,
       round(sqrt(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE)))), 6) AS norm,
       round(list_sum(list_transform(list_zip(embedding, list_reverse(embedding)),
             lambda z: CAST(z[1] AS DOUBLE) * CAST(z[2] AS DOUBLE))), 6) AS dot_reversed
FROM embeddings""")
def vector_norms(spark, sf):
    from tessera.operators.linalg import dot
    e = Views(spark, sf).embeddings
    x = F.transform("embedding", lambda t: t.cast("double"))
    sq = dot(x, x)
    return e.select("vec_id", r(sq).alias("sq_norm"), r(F.sqrt(sq)).alias("norm"),
                    r(dot(x, F.reverse(x))).alias("dot_reversed"))


@query("sparse_to_row", duck_with("clicks") + """
SELECT id, CASE WHEN p[2] = 'F' THEN NULL ELSE p[2] END AS f0, p[3] AS f1, p[4] AS f2, p[5] AS f3, p[6] AS f4
FROM (SELECT id, string_split(value, chr(9)) AS p FROM clicks)""")
def sparse_to_row(spark, sf):
    from tessera.operators.features import sparse_to_row as s2r
    from tessera.sources.readers import positional_fields
    parsed = positional_fields(Views(spark, sf).clicks, keep=["id"])
    sparse = parsed.select("id", F.filter("features", lambda f: f["value"] != "F").alias("features"))
    return s2r(sparse, "features", 5, keep=["id"])


# ============================================== grouping, sorting, limits
@query("group_count", """
SELECT o_orderpriority, count(*) AS count FROM orders GROUP BY o_orderpriority""")
def group_count(spark, sf):
    return profile.count_by(Views(spark, sf).orders, "o_orderpriority").orderBy("o_orderpriority")


@query("sort_limit", """
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10""")
def sort_limit(spark, sf):
    o = Views(spark, sf).orders
    return rel.top_k(o, 10, F.desc("o_totalprice"), F.asc("o_orderkey")).select("o_orderkey", "o_totalprice")


# ================================================================== joins
# a third of the customer keys is moved out of range, so that both sides have unmatched keys
_JL = "SELECT o_custkey AS custkey, o_orderkey, o_totalprice FROM orders"
_JR = "SELECT CASE WHEN c_custkey % 3 = 0 THEN -c_custkey ELSE c_custkey END AS custkey, c_name, c_acctbal FROM customer"


def _join_sides(spark, sf):
    v = Views(spark, sf)
    left = v.orders.select(F.col("o_custkey").alias("custkey"), "o_orderkey", "o_totalprice")
    key = F.when(F.col("c_custkey") % 3 == 0, -F.col("c_custkey")).otherwise(F.col("c_custkey"))
    return left, v.customer.select(key.alias("custkey"), "c_name", "c_acctbal")


def _join_query(how: str, sql: str):
    def fn(spark, sf):
        left, right = _join_sides(spark, sf)
        return rel.join_on(left, right, "custkey", how)
    fn.__name__ = f"join_{how}"
    return fn


for _how, _sql in {
    "inner": f"SELECT l.custkey, o_orderkey, o_totalprice, c_name, c_acctbal FROM ({_JL}) l JOIN ({_JR}) r ON l.custkey = r.custkey",
    "full": f"SELECT COALESCE(l.custkey, r.custkey) AS custkey, o_orderkey, o_totalprice, c_name, c_acctbal FROM ({_JL}) l FULL JOIN ({_JR}) r ON l.custkey = r.custkey",
    "left": f"SELECT l.custkey, o_orderkey, o_totalprice, c_name, c_acctbal FROM ({_JL}) l LEFT JOIN ({_JR}) r ON l.custkey = r.custkey",
    "right": f"SELECT r.custkey, o_orderkey, o_totalprice, c_name, c_acctbal FROM ({_JL}) l RIGHT JOIN ({_JR}) r ON l.custkey = r.custkey",
    "semi": f"SELECT * FROM ({_JL}) l WHERE EXISTS (SELECT 1 FROM ({_JR}) r WHERE r.custkey = l.custkey)",
    "anti": f"SELECT * FROM ({_JL}) l WHERE NOT EXISTS (SELECT 1 FROM ({_JR}) r WHERE r.custkey = l.custkey)",
}.items():
    query(f"join_{_how}", _sql)(_join_query(_how, _sql))


@query("join_group_stats", duck_with("ratings") + """
SELECT r.movieId, r.userId, r.rating, s.count, s.average
FROM ratings r JOIN (SELECT movieId, count(rating) AS count, round(avg(rating), 6) AS average
                     FROM ratings GROUP BY movieId) s ON r.movieId = s.movieId""")
def join_group_stats(spark, sf):
    checkpoint_dir(spark)
    rt = Views(spark, sf).ratings.checkpoint()   # the base join runs once; its rows are read twice
    st = profile.count_and_mean(rt, "movieId", "rating").withColumn("average", r(F.col("average")))
    return rel.with_group_stats(rt, st, "movieId").select("movieId", "userId", "rating", "count", "average")


@query("dim_lookup", """
SELECT l_orderkey, l_linenumber, l_partkey, p_brand, l_extendedprice * (1 - l_discount) AS revenue
FROM lineitem JOIN part ON l_partkey = p_partkey""")
def dim_lookup(spark, sf):
    v = Views(spark, sf)
    li = v.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_discount")
    p = v.part.select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    return rel.lookup_join(li, p, "l_partkey").select(
        "l_orderkey", "l_linenumber", "l_partkey", "p_brand",
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("revenue"))


@query("anti_not_rated", duck_with("ratings", "items") + """
SELECT ID AS movieId, title FROM items
WHERE ID NOT IN (SELECT movieId FROM ratings WHERE userId = 7 AND movieId IS NOT NULL)""")
def anti_not_rated(spark, sf):
    """J11/F5 table form: items a user has not rated."""
    v = Views(spark, sf)
    rated = v.ratings.filter(F.col("userId") == 7).select("movieId")
    return rel.not_in(v.items, "ID", rated, "movieId").select(F.col("ID").alias("movieId"), "title")


# ============================================================ aggregates
@query("agg_global", f"""
SELECT count(*) AS n, {_duck_exact_sum('l_quantity')} AS sum_qty,
       {_duck_exact_sum('l_quantity')} / count(*) AS avg_qty,
       {_duck_exact_sum('l_extendedprice')} AS sum_price,
       {_duck_exact_sum('l_extendedprice')} / count(*) AS avg_price,
       min(l_extendedprice) AS min_price, max(l_extendedprice) AS max_price
FROM lineitem""")
def agg_global(spark, sf):
    li = Views(spark, sf).lineitem
    return li.agg(F.count(F.lit(1)).alias("n"), exact_sum("l_quantity").alias("sum_qty"),
                  exact_sum("l_extendedprice").alias("sum_price"),
                  F.min("l_extendedprice").alias("min_price"), F.max("l_extendedprice").alias("max_price")) \
        .select("n", "sum_qty", (F.col("sum_qty") / F.col("n")).alias("avg_qty"), "sum_price",
                (F.col("sum_price") / F.col("n")).alias("avg_price"), "min_price", "max_price")


@query("agg_sum_all", """
SELECT CAST(sum(c_custkey) AS BIGINT) AS "sum(c_custkey)", CAST(sum(c_nationkey) AS BIGINT) AS "sum(c_nationkey)",
       CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS "sum(c_acctbal)"
FROM customer""")
def agg_sum_all(spark, sf):
    """A5: sum of every numeric column (money summed exactly as decimals)."""
    c = Views(spark, sf).customer.withColumn("c_acctbal", F.col("c_acctbal").cast("decimal(18,2)"))
    out = profile.sum_all(c)
    return out.withColumn("sum(c_acctbal)", F.col("`sum(c_acctbal)`").cast("double"))


_DESC_NUM = ["l_orderkey", "l_quantity", "l_extendedprice", "l_discount"]
_DESC_COLS = [*_DESC_NUM, "l_returnflag"]


def _describe_sql() -> str:
    parts = []
    for c in _DESC_COLS:
        num = c in _DESC_NUM
        # mean and stddev as rounded numbers; count, min and max compared exactly
        none = "max(NULL)"
        for summary, value, text in (("count", f"count({c})", none), ("mean", f"avg({c})" if num else none, none),
                                     ("stddev", f"stddev_samp({c})" if num else none, none),
                                     ("min", f"min({c})" if num else none, none if num else f"min({c})"),
                                     ("max", f"max({c})" if num else none, none if num else f"max({c})")):
            parts.append(f"SELECT '{c}' AS \"column\", '{summary}' AS summary, round(CAST({value} AS DOUBLE), 6) AS number, "
                         f"CAST({text} AS VARCHAR) AS text FROM lineitem")
    return " UNION ALL ".join(parts)


@query("agg_describe", _describe_sql())
def agg_describe(spark, sf):
    d = profile.describe_long(Views(spark, sf).lineitem, _DESC_COLS)
    number = F.col("value").try_cast("double")
    return d.select("column", "summary", r(number).alias("number"),
                    F.when(number.isNull(), F.col("value")).alias("text"))


_LOG_PARSED_SQL = r"""
fields AS (
  SELECT value, regexp_extract(value, '^(\S+) (?:\S+ \S+(?: \[([^\]]*)\](?: "(.*)"(?: (\S+)(?: (\S+))?)?)?)?)?.*$',
                               ['host', 'time', 'request', 'status', 'size']) AS f
  FROM access_log),
parsed AS (
  SELECT value, NULLIF(f.host, '') AS host, NULLIF(f.time, '') AS ts_text,
         CASE WHEN len(string_split(f.request, ' ')) = 3 AND string_split(f.request, ' ')[3] LIKE 'HTTP%'
              THEN NULLIF(string_split(f.request, ' ')[2], '') END AS path,
         TRY_CAST(NULLIF(f.status, '') AS INTEGER) AS status, TRY_CAST(NULLIF(f.size, '') AS BIGINT) AS content_size
  FROM fields),
logs AS (
  SELECT host, path, COALESCE(status, 0) AS status, COALESCE(content_size, 0) AS content_size,
         try_strptime(substr(ts_text, 1, 20), '%d/%b/%Y:%H:%M:%S') AS time
  FROM parsed)
"""


def _log_sql(body: str) -> str:
    return duck_with("access_log") + "," + _LOG_PARSED_SQL + body


def _parsed_logs(spark, sf):
    return logs.parse(Views(spark, sf).access_log)


@query("null_profile", _log_sql("""
SELECT CAST(count_if(host IS NULL) AS BIGINT) AS host, CAST(count_if(path IS NULL) AS BIGINT) AS path, CAST(count_if(status IS NULL) AS BIGINT) AS status,
       CAST(count_if(content_size IS NULL) AS BIGINT) AS content_size, CAST(count_if(time IS NULL) AS BIGINT) AS time FROM logs"""))
def null_profile(spark, sf):
    return profile.null_counts(_parsed_logs(spark, sf))


@query("bucket_share", """
SELECT size_class, count, CAST(count AS DOUBLE) / sum(count) OVER () AS percent FROM (
  SELECT CASE WHEN l_quantity <= 10 THEN 1 WHEN l_quantity <= 30 THEN 2 ELSE 3 END AS size_class,
         count(*) AS count FROM lineitem GROUP BY 1)""")
def bucket_share(spark, sf):
    li = Views(spark, sf).lineitem
    b = rel.bucket("l_quantity", [(float("-inf"), 10, 1), (float("-inf"), 30, 2)], 3)
    return profile.share_of_total(profile.count_by(li, b.alias("size_class")))


@query("dedupe_latest", """
SELECT min(doc_id) AS doc_id, arg_min(lang, doc_id) AS lang, arg_min(n_chars, doc_id) AS n_chars
FROM documents GROUP BY text""")
def dedupe_latest(spark, sf):
    d = Views(spark, sf).documents.select("doc_id", "text", "lang", "n_chars")
    return keys.dedupe_first(d, ["text"], "doc_id").select("doc_id", "lang", "n_chars")


@query("distinct_rows", """
SELECT DISTINCT c_nationkey, c_mktsegment FROM customer""")
def distinct_rows(spark, sf):
    return Views(spark, sf).customer.select("c_nationkey", "c_mktsegment").distinct()


_WORDS_SQL = f"""
lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents),
words AS (SELECT unnest(string_split(lower(trim(regexp_replace(line, '{_PUNCT_RE}', '', 'g'), {_WS})), ' ')) AS word
          FROM lines)
"""


@query("distinct_words", "WITH " + _WORDS_SQL + """
SELECT count(DISTINCT word) AS unique_words FROM words WHERE word <> ''""")
def distinct_words(spark, sf):
    return text.unique_words(text.lines_of(Views(spark, sf).documents))


@query("kv_reduce", f"""
SELECT event_type, count(*) AS count, {_duck_exact_sum('value')} AS total FROM events GROUP BY event_type""")
def kv_reduce(spark, sf):
    e = Views(spark, sf).events
    return e.groupBy("event_type").agg(F.count(F.lit(1)).alias("count"), exact_sum("value").alias("total"))


@query("kv_group", """
SELECT event_type, value, row_number() OVER (PARTITION BY event_type ORDER BY value, event_id) - 1 AS pos FROM events""")
def kv_group(spark, sf):
    e = Views(spark, sf).events
    return profile.grouped_values(e, "event_type", "value", "event_id").select("event_type", "value", "pos")


@query("category_counts", duck_with("clicks") + """
SELECT CAST(i - 1 AS BIGINT) AS featureNumber, count(DISTINCT parts[i + 1]) AS n_categories
FROM (SELECT unnest(range(1, len(parts))) AS i, parts
      FROM (SELECT string_split(value, chr(9)) AS parts FROM clicks))
GROUP BY 1""")
def category_counts(spark, sf):
    from tessera.operators.features import category_counts as cc
    from tessera.sources.readers import positional_fields
    return cc(positional_fields(Views(spark, sf).clicks, keep=["id"]))


# ==================================================================== logs
@query("log_parse", _log_sql("""
SELECT host, path, status, content_size, strftime(time, '%Y-%m-%d %H:%M:%S') AS time FROM logs"""))
def log_parse(spark, sf):
    p = _parsed_logs(spark, sf)
    # a timestamp_ntz renders as its wall clock; date_format would pass through the session zone
    return p.withColumn("time", F.col("time").cast("string"))


@query("log_quality", _log_sql("""
SELECT count(*) AS lines,
       CAST(count_if(host IS NULL OR ts_text IS NULL OR path IS NULL OR status IS NULL OR content_size IS NULL) AS BIGINT) AS bad_rows,
       CAST(count_if(host IS NULL) AS BIGINT) AS null_host, CAST(count_if(ts_text IS NULL) AS BIGINT) AS null_timestamp,
       CAST(count_if(path IS NULL) AS BIGINT) AS null_path, CAST(count_if(status IS NULL) AS BIGINT) AS null_status,
       CAST(count_if(content_size IS NULL) AS BIGINT) AS null_content_size,
       CAST(count_if(NOT regexp_matches(value, '\\d+$')) AS BIGINT) AS bad_size_lines
FROM parsed"""))
def log_quality(spark, sf):
    return logs.quality(Views(spark, sf).access_log)


@query("log_bad_lines", _log_sql("""
SELECT value || '*' AS line FROM access_log WHERE NOT regexp_matches(value, '[0-9]$')"""))
def log_bad_lines(spark, sf):
    return logs.bad_lines(Views(spark, sf).access_log)


@query("log_status", _log_sql("""
SELECT status, count(*) AS count, round(ln(count(*)), 9) AS log_count FROM logs GROUP BY status"""))
def log_status(spark, sf):
    s = logs.status_counts(_parsed_logs(spark, sf))
    return s.withColumn("log_count", r(F.col("log_count"), 9)).orderBy("status")


@query("log_hosts", _log_sql("""
SELECT host, count(*) AS count FROM logs GROUP BY host HAVING count(*) > 10"""))
def log_hosts(spark, sf):
    return logs.frequent_hosts(_parsed_logs(spark, sf), 10)


@query("log_paths", _log_sql("""
SELECT path, count(*) AS count FROM logs GROUP BY path ORDER BY count DESC, path LIMIT 10"""))
def log_paths(spark, sf):
    return logs.top_paths(_parsed_logs(spark, sf), 10)


@query("log_sizes", _log_sql("""
SELECT avg(content_size) AS avg_size, min(content_size) AS min_size, max(content_size) AS max_size FROM logs"""))
def log_sizes(spark, sf):
    return logs.size_stats(_parsed_logs(spark, sf))


# ==================================================================== text
@query("word_count_top", "WITH " + _WORDS_SQL + """
SELECT word, count(*) AS count FROM words WHERE word <> '' GROUP BY word ORDER BY count DESC, word LIMIT 15""")
def word_count_top(spark, sf):
    return text.top_words(text.lines_of(Views(spark, sf).documents), 15)


@query("tokenise", f"""
SELECT doc_id, CAST(len(t) AS BIGINT) AS n_tokens, md5(array_to_string(t, ' ')) AS tokens_md5
FROM (SELECT doc_id, {_duck_simple_tokens('text')} AS t FROM documents)""")
def tokenise(spark, sf):
    t = text.tokenize(Views(spark, sf).documents, id_col="doc_id", stop_words=False)
    return t.select("doc_id", F.size("tokens").cast("long").alias("n_tokens"),
                    F.md5(F.array_join("tokens", " ")).alias("tokens_md5"))


@query("token_totals", duck_with("rec_a", "rec_b") + f"""
SELECT 'a' AS record_set, CAST(sum(len({_duck_tokens('text')})) AS BIGINT) AS total_tokens FROM rec_a
UNION ALL
SELECT 'b' AS record_set, CAST(sum(len({_duck_tokens('text')})) AS BIGINT) AS total_tokens FROM rec_b""")
def token_totals(spark, sf):
    v = Views(spark, sf)
    a = text.token_total(sim.tokens(v.rec_a)).select(F.lit("a").alias("record_set"), "total_tokens")
    b = text.token_total(sim.tokens(v.rec_b)).select(F.lit("b").alias("record_set"), "total_tokens")
    return rel.union_bag(a, b)


@query("longest_record", f"""
SELECT doc_id AS id, CAST(len({_duck_tokens('text')}) AS INTEGER) AS n_tokens
FROM documents ORDER BY n_tokens DESC, id LIMIT 5""")
def longest_record(spark, sf):
    d = Views(spark, sf).documents
    return text.longest_records(sim.tokens(d, id_col="doc_id"), 5)


# ============================================= order, splits and samples
@query("row_index", """
SELECT doc_id, row_number() OVER (ORDER BY n_chars DESC, doc_id) - 1 AS idx FROM documents""")
def row_index(spark, sf):
    d = Views(spark, sf).documents.select("doc_id", "n_chars")
    return keys.row_index(d, ["-n_chars", "doc_id"]).select("doc_id", "idx")


_SPLIT_W = [0.6, 0.2, 0.2]


def _split_sql() -> str:
    # 0.6 and 0.8 of 2^32, rounded down
    u = _duck_md5_unit("event_id", 42)
    return (f"SELECT event_id, CASE WHEN {u} < 2576980377 THEN 'train' WHEN {u} < 3435973836 THEN 'validation' "
            f"ELSE 'test' END AS split FROM events")


@query("split_hash", _split_sql())
def split_hash(spark, sf):
    e = Views(spark, sf).events.select("event_id")
    return keys.hash_split(e, "event_id", _SPLIT_W, 42, ["train", "validation", "test"])


@query("sample_exact", f"""
SELECT doc_id FROM documents ORDER BY {_duck_md5_unit('doc_id', 11)}, doc_id LIMIT 200""")
def sample_exact(spark, sf):
    return keys.sample_exact(Views(spark, sf).documents.select("doc_id"), "doc_id", 200, 11)


@query("union_bag", """
SELECT c_custkey AS key, c_name AS name, c_nationkey AS nationkey FROM customer
UNION ALL SELECT s_suppkey, s_name, s_nationkey FROM supplier""")
def union_bag(spark, sf):
    v = Views(spark, sf)
    c = v.customer.select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"),
                          F.col("c_nationkey").alias("nationkey"))
    s = v.supplier.select("s_suppkey", "s_name", "s_nationkey")
    return rel.union_bag(c, s)


@query("token_intersection", duck_with("rec_a", "rec_b") + f"""
SELECT a.id AS id_a, b.id AS id_b, CAST(len(list_intersect({_duck_tokens('a.text')}, {_duck_tokens('b.text')})) AS INTEGER) AS n_shared
FROM rec_a a JOIN rec_b b ON b.id = a.id + 1""")
def token_intersection(spark, sf):
    v = Views(spark, sf)
    a = sim.tokens(v.rec_a).select(F.col("id").alias("id_a"), F.col("tokens").alias("ta"))
    b = sim.tokens(v.rec_b).select(F.col("id").alias("id_b"), F.col("tokens").alias("tb"))
    return (a.join(b, F.col("id_b") == F.col("id_a") + 1)
            .select("id_a", "id_b", F.size(rel.shared_elements("ta", "tb")).alias("n_shared")))


# ================================================= TF-IDF entity resolution
_CORPUS_SQL = duck_with("rec_a", "rec_b") + f""",
ta AS (SELECT id, {_duck_tokens('text')} AS tokens FROM rec_a),
tb AS (SELECT id, {_duck_tokens('text')} AS tokens FROM rec_b),
corpus AS (SELECT * FROM ta UNION ALL SELECT * FROM tb),
n_rec AS (SELECT count(*) AS n FROM corpus),
idf AS (SELECT token, count(*) AS df, (SELECT n FROM n_rec) / count(*) AS idf
        FROM (SELECT DISTINCT id, unnest(tokens) AS token FROM corpus) GROUP BY token),
tf_a AS (SELECT id, token, count(*) / any_value(n) AS tf
         FROM (SELECT id, len(tokens) AS n, unnest(tokens) AS token FROM ta) GROUP BY id, token),
tf_b AS (SELECT id, token, count(*) / any_value(n) AS tf
         FROM (SELECT id, len(tokens) AS n, unnest(tokens) AS token FROM tb) GROUP BY id, token),
wa AS (SELECT id, token, tf * idf AS w FROM tf_a JOIN idf USING (token)),
wb AS (SELECT id, token, tf * idf AS w FROM tf_b JOIN idf USING (token)),
na AS (SELECT id, sqrt(sum(w * w)) AS norm FROM wa GROUP BY id),
nb AS (SELECT id, sqrt(sum(w * w)) AS norm FROM wb GROUP BY id),
sims AS (SELECT wa.id AS id_a, wb.id AS id_b, sum(wa.w * wb.w) / (any_value(na.norm) * any_value(nb.norm)) AS cs
         FROM wa JOIN wb USING (token) JOIN na ON na.id = wa.id JOIN nb ON nb.id = wb.id
         GROUP BY wa.id, wb.id)
"""


def _tokens_ab(spark, sf):
    v = Views(spark, sf)
    return sim.tokens(v.rec_a).unionByName(sim.tokens(v.rec_b))


@query("tf", _CORPUS_SQL + "SELECT id, token, tf FROM tf_a UNION ALL SELECT id, token, tf FROM tf_b")
def tf(spark, sf):
    return sim.term_frequency(_tokens_ab(spark, sf))


@query("idf", _CORPUS_SQL + "SELECT token, df, idf FROM idf")
def idf(spark, sf):
    return sim.inverse_document_frequency(_tokens_ab(spark, sf))


@query("tfidf", _CORPUS_SQL + "SELECT id, token, w FROM wa UNION ALL SELECT id, token, w FROM wb")
def tfidf(spark, sf):
    tok = _tokens_ab(spark, sf)
    return sim.tfidf(tok, sim.inverse_document_frequency(tok)).select("id", "token", "w")


# records with the same tokens are one class; the oracle names a class by its smallest id
@query("cosine_pairs", _CORPUS_SQL.rstrip() + """,
ca AS (SELECT min(id) AS id, count(*) AS n FROM ta WHERE len(tokens) > 0 GROUP BY list_sort(tokens)),
cb AS (SELECT min(id) AS id, count(*) AS n FROM tb WHERE len(tokens) > 0 GROUP BY list_sort(tokens))
SELECT id_a, id_b, round(cs, 6) AS cs, ca.n AS copies_a, cb.n AS copies_b
FROM sims JOIN ca ON ca.id = id_a JOIN cb ON cb.id = id_b WHERE cs >= 0.3""")
def cosine_pairs(spark, sf):
    v = Views(spark, sf)
    return sim.similar_pairs(v.rec_a, v.rec_b, 0.3).withColumn("cs", r(F.col("cs")))


@query("gold_match", _CORPUS_SQL.rstrip() + """,
gold AS (SELECT a.id AS id_a, b.id AS id_b FROM rec_a a JOIN rec_b b ON a.text = b.text),
found AS (SELECT count(cs) AS n, sum(cs) AS total FROM gold LEFT JOIN sims USING (id_a, id_b)),
every AS (SELECT sum(cs) AS total, (SELECT count(*) FROM ta) * (SELECT count(*) FROM tb) AS n FROM sims)
SELECT e.n AS n_pairs, (SELECT count(*) FROM gold) AS n_gold, f.n AS n_gold_found,
       round(f.total / (SELECT count(*) FROM gold), 6) AS avg_cs_gold,
       round((e.total - f.total) / (e.n - (SELECT count(*) FROM gold)), 6) AS avg_cs_other
FROM every e, found f""")
def gold_match(spark, sf):
    v = Views(spark, sf)
    out = sim.gold_summary(v.rec_a, v.rec_b, v.gold)
    return out.withColumn("avg_cs_gold", r(F.col("avg_cs_gold"))).withColumn("avg_cs_other", r(F.col("avg_cs_other")))


# ============================================ small pair / list operators
@query("idf_histogram", _CORPUS_SQL + """
SELECT CAST(floor(idf / 50.0) AS BIGINT) AS bin, count(*) AS count, CAST(floor(idf / 50.0) AS BIGINT) * 50.0 AS lower
FROM idf GROUP BY 1""")
def idf_histogram(spark, sf):
    return profile.histogram(sim.inverse_document_frequency(_tokens_ab(spark, sf)), "idf", 50.0)


@query("blank_lines", """
SELECT CAST(count_if(line = '') AS BIGINT) AS blank_lines, count(*) AS lines
FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents)""")
def blank_lines(spark, sf):
    """Empty lines counted by an aggregate (not an accumulator side effect)."""
    lines = text.lines_of(Views(spark, sf).documents)
    return lines.agg(F.count_if(F.col("value") == "").alias("blank_lines"), F.count(F.lit(1)).alias("lines"))


@query("top_values", """
SELECT value FROM events ORDER BY value DESC LIMIT 5""")
def top_values(spark, sf):
    """The k largest values in natural order, duplicates kept (top(k))."""
    return rel.top_k(Views(spark, sf).events.select("value"), 5, F.desc("value"))


@query("sample_hash", f"""
SELECT event_id FROM events WHERE {_duck_md5_unit('event_id', 42)} < {int(0.1 * (1 << 32))}""")
def sample_hash(spark, sf):
    """R2: a 10% Bernoulli sample decided by md5(seed:key), stable under re-partitioning."""
    return keys.hash_sample(Views(spark, sf).events.select("event_id"), "event_id", 0.1, 42)


@query("kv_map", """
SELECT event_type AS key, value * 2 AS doubled, length(event_type) AS key_len,
       event_type || 's' AS plural, 1 AS one FROM events""")
def kv_map(spark, sf):
    """Row maps on (key, value) pairs: mapValues(x * 2), len, pluralise, pair with 1."""
    e = Views(spark, sf).events
    return e.select(F.col("event_type").alias("key"), (F.col("value") * 2).alias("doubled"),
                    F.length("event_type").cast("long").alias("key_len"), ftext.plural("event_type").alias("plural"),
                    F.lit(1).alias("one"))
