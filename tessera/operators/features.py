"""Categorical features for the click-rate study.

Records carry ``features: array<struct<pos bigint, value string>>`` (see
``sources.readers.positional_fields``).  The one-hot dictionary stays a table
and encoding is a join: nothing proportional to the vocabulary goes through
the driver.  Vectors are assembled per record from that record's own few
entries; labels and other columns travel with the record.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.hashing import digest_bucket, md5_buckets
from tessera.operators.keys import row_index
from tessera.session import checkpoint_dir


def long_features(records: DataFrame, id_col: str = "id", col: str = "features") -> DataFrame:
    """(id, pos, value) rows, one per feature of each record.

    The outer generator adds no size test that the optimiser would push below the split.
    """
    return records.select(id_col, F.inline_outer(col)).filter(F.col("pos").isNotNull())


def _distinct_features(records: DataFrame, col: str) -> DataFrame:
    return records.select(F.inline_outer(col)).filter(F.col("pos").isNotNull()).distinct()


def category_counts(records: DataFrame, col: str = "features") -> DataFrame:
    """Distinct values per feature position (the reference's Q7 defect fixed)."""
    return (_distinct_features(records, col).groupBy(F.col("pos").alias("featureNumber"))
            .agg(F.count(F.lit(1)).alias("n_categories")))


def sparse_to_row(records: DataFrame, col: str, width: int, keep: list[str] | None = None,
                  prefix: str = "f") -> DataFrame:
    """Sparse (pos, value) entries to fixed columns f0..f{width-1}; missing is null.

    Of a repeated position the last entry counts; a position outside the width is an error.
    """
    beyond = F.exists(col, lambda e: (e["pos"] < 0) | (e["pos"] >= width))
    checked = F.when(beyond, F.raise_error(F.lit(f"feature position outside 0..{width - 1}"))
                     .cast("array<struct<pos:bigint,value:string>>")).otherwise(F.col(col))
    held = records.select(*(keep or []), checked.alias("__entries"))

    def last(i):
        return F.try_element_at(F.filter("__entries", lambda e: e["pos"] == i), F.lit(-1))["value"]

    return held.select(*(keep or []), *[last(i).alias(f"{prefix}{i}") for i in range(width)])


def ohe_dictionary(records: DataFrame, col: str = "features") -> DataFrame:
    """(pos, value, ohe_id) with dense ids ordered by (pos, value), as a table."""
    checkpoint_dir(records.sparkSession)
    # the categories are few beside the records: written once, then indexed
    return row_index(_distinct_features(records, col).checkpoint(), ["pos", "value"], name="ohe_id")


def ohe_encode(records: DataFrame, dictionary: DataFrame, id_col: str = "id", col: str = "features") -> DataFrame:
    """(id, index, weight=1.0) for every feature found in the dictionary.

    Categories absent from the dictionary (fitted on other rows) are dropped,
    so the vector width stays the dictionary size.
    """
    d = dictionary.select("pos", "value", F.col("ohe_id").alias("index"))
    return long_features(records, id_col, col).join(d, ["pos", "value"]).select(id_col, "index", F.lit(1.0).alias("weight"))


def with_hashed(records: DataFrame, num_buckets: int = 1 << 15, col: str = "features", out: str = "entries") -> DataFrame:
    """``records`` with a sorted array of (index, weight): index = md5('value:pos') mod num_buckets,
    weight = the record's distinct features in that bucket.

    A narrow map, no shuffle: a record's buckets are sorted and the lengths of the runs read
    off, in steps of their own so that none is computed twice.  They are sorted as negative numbers
    from the greatest down: no comparison is a lambda then, and nulls still come last.
    """
    digests = F.transform(F.array_distinct(F.col(col)), lambda f: F.md5(F.concat(f["value"], F.lit(":"), f["pos"].cast("string"))))
    rows = records.withColumn("__b", F.sort_array(F.transform(digests, lambda d: -digest_bucket(d, num_buckets)), asc=False))
    first = F.filter(F.transform("__b", lambda b, i: F.when(
        (i == 0) | (b != F.element_at("__b", F.greatest(i, F.lit(1)))), i)), lambda i: i.isNotNull())
    rows = rows.withColumn("__s", first)   # where each run starts, from 0
    entries = F.transform("__s", lambda i, k: F.struct(
        (-F.element_at("__b", i + 1)).alias("index"),
        (F.coalesce(F.try_element_at("__s", k + 2), F.size("__b")) - i).cast("double").alias("weight")))
    return rows.withColumn(out, entries).drop("__b", "__s")


def with_hashed_batches(records: DataFrame, num_buckets: int = 1 << 15, col: str = "features", out: str = "entries") -> DataFrame:
    """``with_hashed``, quicker where Python may run.

    A narrow map, no shuffle: Arrow batches of the records' features, each feature of a batch hashed once.
    """
    return records.withColumn(out, _bucket_counts(num_buckets)(F.col(col)))


def _bucket_counts(num_buckets: int):
    """An Arrow function from arrays of (pos, value) to sorted arrays of (index, weight)."""
    buckets_of = md5_buckets(num_buckets)

    @F.arrow_udf("array<struct<index:int,weight:double>>")
    def count(records: pa.Array) -> pa.Array:
        features = records.flatten()
        value, pos = pc.struct_field(features, "value"), pc.struct_field(features, "pos")
        digits = pos.cast(value.type)
        key = pc.binary_join_element_wise(value, digits, ":")
        # features that lack a part have no bucket; names that no key has keep them apart
        name = pc.coalesce(key, pc.binary_join_element_wise(value, "", ":"), digits, pc.if_else(features.is_valid(), "f", "n"))
        coded = name.dictionary_encode()
        codes = coded.indices.to_numpy(zero_copy_only=False)
        bucket = buckets_of(coded.dictionary.cast(pa.binary()).to_pylist())
        bucket[codes[pc.is_null(key).to_numpy(zero_copy_only=False)]] = num_buckets
        # distinct (record, feature) in the order of the buckets, those without one last
        order = np.argsort(bucket, kind="stable")
        bucket, place = bucket[order], np.argsort(order)
        n = max(len(order), 1)
        held = np.unique(pc.list_parent_indices(records).to_numpy().astype(np.int64) * n + place[codes])
        row, bucket = held // n, bucket[held % n]
        first = np.flatnonzero((np.diff(row, prepend=-1) != 0) | (np.diff(bucket, prepend=-1) != 0) & (bucket < num_buckets))
        index, weight = bucket[first], np.diff(first, append=len(held)).astype(np.float64)
        entries = pa.StructArray.from_arrays([pa.array(index.astype(np.int32), mask=index == num_buckets), pa.array(weight)],
                                             ["index", "weight"])
        offsets = np.concatenate([[0], np.cumsum(np.bincount(row[first], minlength=len(records)))]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), entries, mask=records.is_null())

    return count


def hash_features(records: DataFrame, num_buckets: int = 1 << 15, id_col: str = "id",
                  col: str = "features") -> DataFrame:
    """(id, index, weight) rows of ``with_hashed``."""
    rows = with_hashed_batches(records.select(id_col, col), num_buckets, col).select(id_col, F.inline_outer("entries"))
    return rows.filter(F.col("index").isNotNull())


def with_one_hot(records: DataFrame, dictionary: DataFrame, positions: list[int], col: str = "features",
                 out: str = "entries") -> DataFrame:
    """``records`` with a sorted array of (index, weight = 1.0) of the features in the dictionary.

    One lookup join per field position; the record stays whole, so nothing is grouped back together.
    """
    def value_at(p):
        return F.try_element_at(F.filter(col, lambda e: e["pos"] == p), F.lit(-1))["value"]

    wide = records
    for p in positions:
        ids = dictionary.filter(F.col("pos") == p).select(F.col("value").alias("__v"), F.col("ohe_id").cast("int").alias(f"__i{p}"))
        wide = wide.withColumn("__f", value_at(p)).join(ids, F.col("__f") == F.col("__v"), "left").drop("__f", "__v")
    found = F.array_sort(F.array_compact(F.array(*[F.col(f"__i{p}") for p in positions])))
    entries = F.transform(found, lambda i: F.struct(i.alias("index"), F.lit(1.0).alias("weight")))
    return wide.withColumn(out, entries).select(*records.columns, out)


def sparsity(encoded: DataFrame, width: int | F.Column, id_col: str = "id") -> DataFrame:
    """Mean over records of (non-zero entries / width)."""
    w = width if isinstance(width, F.Column) else F.lit(width)
    per = encoded.groupBy(id_col).agg(F.count_distinct("index").alias("__nnz"))
    return per.agg(F.avg(F.col("__nnz") / w).alias("sparsity"))


def to_vectors(records: DataFrame, width: int, col: str = "entries", out: str = "features") -> DataFrame:
    """``records`` with the sparse vector of their (index, weight) entries; weights are whole counts.

    A count vectoriser over the numbers 0 .. width - 1 as words makes the vectors in the JVM: each entry gives
    its index as often as it counts.  Records without entries get an all-zero vector.
    """
    words = F.flatten(F.transform(F.coalesce(F.col(col), F.array().cast("array<struct<index:int,weight:double>>")),
                                  lambda e: F.array_repeat(e["index"].cast("string"), e["weight"].cast("int"))))
    counter = CountVectorizerModel.from_vocabulary([str(i) for i in range(width)], inputCol="__words", outputCol="__vector")
    return counter.transform(records.withColumn("__words", words)).drop("__words", out).withColumnRenamed("__vector", out)
