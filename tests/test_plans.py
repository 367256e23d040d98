"""Plan properties: pushdown, pruning, no Python in native jobs, no single-partition windows."""

from conftest import SF0001
from tessera import queries as q
from tessera.operators import logs, text
from tessera.plans import inspect as pi
from tessera.sources.fixtures import Views


def test_filter_pushed_and_columns_pruned(spark):
    df = q.QUERIES["filter_basic"](spark, SF0001)
    assert any("l_quantity" in f for f in pi.pushed_filters(df))
    schemas = pi.read_schemas(df)
    assert schemas and all("l_shipdate" not in s for s in schemas)


def test_log_parse_and_word_count_stay_in_jvm(spark):
    v = Views(spark, SF0001)
    assert not pi.runs_python(logs.parse(v.access_log))
    assert not pi.runs_python(text.top_words(text.lines_of(v.documents)))


def test_row_index_has_no_single_partition_window(spark):
    df = q.QUERIES["row_index"](spark, SF0001)
    assert not pi.single_partition_window(df)


def test_popular_items_plan(spark):
    df = q.QUERIES["popular_items"](spark, SF0001)
    plan = pi.physical_plan(df)
    assert "HashAggregate" in plan and "partial_" in plan      # map-side combine
    assert not pi.has_cartesian(df)


def test_join_choice_is_left_to_size_in_bytes(spark):
    from tessera.operators.relational import lookup_join
    plan = pi.physical_plan(lookup_join(spark.range(1000), spark.range(10), "id"))
    assert "BroadcastHashJoin" in plan
    assert "hint" not in lookup_join(spark.range(1000), spark.range(10), "id")._jdf.queryExecution().logical().toString().lower()


def test_tfidf_similarity_stays_in_jvm(spark):
    from tessera.operators import similarity as sim
    v = Views(spark, SF0001)
    df = sim.similar_pairs(v.rec_a, v.rec_b, 0.3)
    assert not pi.runs_python(df)
    assert not pi.has_cartesian(df)


def test_click_fields_are_split_once_and_vectors_stay_in_jvm(spark):
    from tessera.operators import features as feat
    from tessera.sources.readers import positional_fields
    rec = positional_fields(Views(spark, SF0001).clicks, keep=["id"])
    plan = pi.physical_plan(feat.category_counts(rec))
    assert plan.count("split(") == 1
    vectors = feat.to_vectors(feat.with_hashed(rec, 1 << 15), 1 << 15)
    assert "from_json" not in pi.physical_plan(vectors)
    assert not pi.runs_python(vectors) and "Exchange" not in pi.physical_plan(vectors.select("features")).split("Join")[0]


def test_queries_leave_nothing_cached(spark):
    for name in ("tf", "cosine_pairs", "gold_match", "roc_auc", "logit_ohe", "logit_hashed", "gd_linreg"):
        before = len(spark.sparkContext._jsc.getPersistentRDDs())
        fn = q.QUERIES.get(name)
        if fn is None:
            import tessera.queries_models  # noqa: F401  (registers the model queries)
            fn = q.QUERIES[name]
        fn(spark, SF0001).collect()
        assert len(spark.sparkContext._jsc.getPersistentRDDs()) <= before, name
