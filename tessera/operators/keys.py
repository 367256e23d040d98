"""Order-dependent operators without a single-partition window.

P16 row index, W1 running sums, R1-R3 splits and samples, A14 deterministic
de-duplication.

Global order is built from explicit cut points: whether a row's order key is in the sample is
decided by the key's own hash, so the samples of all parts of a table merge by union and no task ever holds more
than its own; every k-th sampled key is a cut.  The bucket of a row is a pure function of its order key,
so a window inside each bucket plus the totals of the buckets before it gives the same answer however
often, and on whatever executors, the plan is run again.  Nothing is cached and nothing depends on
partition numbers.

Up to COARSE buckets the cuts are literals.  Beyond, these buckets are cut again, by cuts of their own that stay in a
table (sorted bucket by bucket in the tasks); the driver only ever sees the COARSE level.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.hashing import md5_unit
from tessera.session import checkpoint_dir

_TWO32 = float(1 << 32)
#: Rows of one bucket, most buckets cut by literals, sampled keys per bucket and cut points compared at each step.
ROWS_PER_BUCKET = 200_000
COARSE = 1024
SAMPLE_PER_BUCKET = 32
_FAN = 32
#: Up to so many cuts (tens of bytes each) a table of cuts is sent to every executor; beyond, Spark chooses the join.
BROADCAST_CUTS = 1 << 20


def _order(order: str | list[str]) -> list[tuple[str, bool]]:
    """``"a"`` orders ascending, ``"-a"`` descending."""
    names = [order] if isinstance(order, str) else list(order)
    return [(n.removeprefix("-"), not n.startswith("-")) for n in names]


def _sort_cols(keys: list[tuple[str, bool]]) -> list[Column]:
    return [F.asc(c) if up else F.desc(c) for c, up in keys]


def _not_after(cut: Column, row: Column, keys: list[tuple[str, bool]]) -> Column:
    """Whether a cut point stands at or before the row; nulls are least, as in Spark's sort."""
    before, same = F.lit(False), F.lit(True)
    for c, up in keys:
        x, y = (cut[c], row[c]) if up else (row[c], cut[c])
        less = F.coalesce(x < y, x.isNull() & y.isNotNull())
        before = before | (same & less)
        same = same & x.eqNullSafe(y)
    return before | same


def _sampled(df: DataFrame, keys: list[tuple[str, bool]], rows: int, size: int) -> DataFrame:
    """Distinct order keys, about ``size`` of ``rows``: those whose hash is below the share asked for."""
    names = [c for c, _ in keys]
    share = size / max(rows, 1)
    sample = df.select(*names)
    if share < 1:
        sample = sample.filter(F.pmod(F.xxhash64(*names), F.lit(1 << 40)) < F.lit(int(share * (1 << 40))))
    return sample.distinct()


def _cut_points(df: DataFrame, keys: list[tuple[str, bool]], buckets: int, rows: int | None = None) -> list:
    """At most ``buckets`` - 1 order keys that cut the rows into about equal parts.

    About SAMPLE_PER_BUCKET keys a bucket, and at most COARSE buckets, reach the driver.
    """
    rows = df.count() if rows is None else rows
    sample = _sampled(df, keys, rows, buckets * SAMPLE_PER_BUCKET).orderBy(*_sort_cols(keys)).collect()
    picked = [sample[len(sample) * i // buckets] for i in range(1, buckets)] if len(sample) >= buckets else []
    return list(dict.fromkeys(tuple(r) for r in picked))


def _place(groups: Column, row: Column, keys: list[tuple[str, bool]]) -> Column:
    """How many cuts stand at or before the row: ``groups`` are arrays of _FAN cuts, the group is found first, then the cut."""
    group = F.size(F.filter(groups, lambda g: _not_after(g[0], row, keys)))
    inside = F.element_at(groups, F.greatest(group, F.lit(1)))
    return F.greatest(group - 1, F.lit(0)) * _FAN + F.size(F.filter(inside, lambda c: _not_after(c, row, keys)))


def _key(keys: list[tuple[str, bool]]) -> Column:
    return F.struct(*[F.col(c) for c, _ in keys])


def _bucket(df: DataFrame, keys: list[tuple[str, bool]], cuts: list) -> Column:
    """The number of cut points at or before the row, the cuts as literals."""
    if not cuts:
        return F.lit(0)
    kind = df.select(*[c for c, _ in keys]).schema

    def literal(values):
        return F.array(*[F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(cut, kind)]) for cut in values])

    return _place(F.array(*[literal(cuts[i:i + _FAN]) for i in range(0, len(cuts), _FAN)]), _key(keys), keys)


def _fine_cuts(df: DataFrame, keys: list[tuple[str, bool]], buckets: int, rows: int, cuts: list) -> DataFrame:
    """(__coarse, __cuts): the cuts inside each coarse bucket, in groups of _FAN.

    A coarse bucket's sample (its share of all samples, about SAMPLE_PER_BUCKET keys for each bucket
    inside) is ranked by a window of its own; every SAMPLE_PER_BUCKET-th key is a cut.
    """
    sample = _sampled(df, keys, rows, buckets * SAMPLE_PER_BUCKET).withColumn("__coarse", _bucket(df, keys, cuts))
    ranked = sample.withColumn("__rank", F.row_number().over(Window.partitionBy("__coarse").orderBy(*_sort_cols(keys))))
    held = ranked.filter(F.col("__rank") % SAMPLE_PER_BUCKET == 0).groupBy("__coarse").agg(
        F.array_sort(F.collect_list(F.struct(F.col("__rank"), _key(keys).alias("__key")))).alias("__ranked"))
    ordered = F.transform("__ranked", lambda x: x["__key"])
    groups = F.transform(F.sequence(F.lit(0), F.floor((F.size(ordered) - 1) / _FAN).cast("int")),
                         lambda g: F.slice(ordered, g * _FAN + 1, F.lit(_FAN)))
    return held.select("__coarse", groups.alias("__cuts"))


def running_sums(df: DataFrame, order: str | list[str], values: dict[str, str], buckets: int | None = None,
                 coarse: int = COARSE) -> DataFrame:
    """Cumulative sums along a global order.

    ``values`` maps output column -> input column (numeric; a null adds nothing).  Rows tied
    on the whole order key are summed in arbitrary order, so give a unique key (or
    pre-aggregate ties, as ROC does).  The number of buckets follows the row count, without a limit; up to ``coarse`` of
    them the totals of the buckets before a row's own are literals, like the cut points; beyond, they are a
    table that is joined on the bucket, by which the rows are dealt anyway.
    """
    keys = _order(order)
    rows = df.count()
    if buckets is None:
        buckets = max(2, -(-rows // ROWS_PER_BUCKET))
    top = min(buckets, coarse)
    cuts = _cut_points(df, keys, top, rows) if top > 1 else []
    placed = df.withColumn("__bucket", _bucket(df, keys, cuts))
    names = [f"__total_{i}" for i in range(len(values))]
    sums_of = [F.sum(c).alias(n) for n, c in zip(names, values.values())]
    if buckets <= coarse:
        totals, own = placed.groupBy("__bucket").agg(*sums_of), ["__bucket"]
    else:
        checkpoint_dir(df.sparkSession)
        fine = _fine_cuts(df, keys, buckets, rows, cuts).checkpoint()
        fine = F.broadcast(fine) if buckets <= BROADCAST_CUTS else fine
        placed = (placed.join(fine, placed["__bucket"] == fine["__coarse"], "left")
                  .withColumn("__part", F.coalesce(_place(F.col("__cuts"), _key(keys), keys), F.lit(0))).drop("__cuts", "__coarse"))
        parts, own = placed.groupBy("__bucket", "__part").agg(*sums_of).checkpoint(), ["__bucket", "__part"]   # one row a bucket
        totals = parts.groupBy("__bucket").agg(*[F.sum(n).alias(n) for n in names])
    kinds = totals.schema
    found = {row["__bucket"]: row for row in totals.collect()}               # at most ``coarse`` rows
    offsets = {n: [] for n in names}
    for n in names:
        run = 0
        for i in range(len(cuts) + 1):
            offsets[n].append(run)
            run += (found[i][n] or 0) if i in found else 0

    def before(n):
        return F.element_at(F.array(*[F.lit(x).cast(kinds[n].dataType) for x in offsets[n]]), F.col("__bucket") + 1)

    if buckets > coarse:
        earlier = Window.partitionBy("__bucket").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
        base = parts.select(*[F.col(c).alias(f"{c}_of") for c in own], *[
            (F.coalesce(F.sum(n).over(earlier), F.lit(0).cast(kinds[n].dataType)) + before(n)).alias(n) for n in names])
        placed = placed.join(base, [placed[c] == base[f"{c}_of"] for c in own]).drop(*[f"{c}_of" for c in own])
    so_far = Window.partitionBy(*own).orderBy(*_sort_cols(keys)).rowsBetween(Window.unboundedPreceding, 0)
    sums = []
    for (out, c), n in zip(values.items(), names):
        kind = kinds[n].dataType
        sums.append((F.coalesce(F.sum(c).over(so_far), F.lit(0).cast(kind)) + (before(n) if buckets <= coarse else F.col(n))).alias(out))
    return placed.select(*[F.col(c) for c in df.columns], *sums)


def row_index(df: DataFrame, order: str | list[str], name: str = "idx", buckets: int | None = None,
              coarse: int = COARSE) -> DataFrame:
    """0-based position along a global order (zipWithIndex on a sorted frame)."""
    with_one = df.withColumn("__one", F.lit(1).cast("long"))
    return running_sums(with_one, order, {name: "__one"}, buckets, coarse).withColumn(name, F.col(name) - 1).drop("__one")


def split_thresholds(weights: list[float]) -> list[int]:
    """Cumulative cut points in [0, 2^32) for md5-unit splits (shared with the SQL oracle)."""
    total = float(sum(weights))
    cuts, acc = [], 0.0
    for w in weights[:-1]:
        acc += w
        cuts.append(int(acc / total * _TWO32))
    return cuts


def hash_split(df: DataFrame, key: str | Column, weights: list[float], seed: int = 42,
               labels: list[str] | None = None, out: str = "split") -> DataFrame:
    """Stable split by md5(seed:key); the same key lands in the same split
    whatever the partitioning or recomputation."""
    key_col = F.col(key) if isinstance(key, str) else key
    labels = labels or [str(i) for i in range(len(weights))]
    u = md5_unit(key_col, seed)
    expr = None
    for cut, lab in zip(split_thresholds(weights), labels[:-1]):
        cond = u < F.lit(cut)
        expr = F.when(cond, F.lit(lab)) if expr is None else expr.when(cond, F.lit(lab))
    expr = F.lit(labels[-1]) if expr is None else expr.otherwise(F.lit(labels[-1]))
    return df.withColumn(out, expr)


def random_split(df: DataFrame, weights: list[float], seed: int = 42) -> list[DataFrame]:
    """Spark's own randomSplit (layout dependent; use hash_split for reproducible folds)."""
    return df.randomSplit(weights, seed)


def hash_sample(df: DataFrame, key: str, fraction: float, seed: int = 42) -> DataFrame:
    """R2: Bernoulli sample by key hash (stable); ``df.sample`` is the random form."""
    return df.filter(md5_unit(F.col(key), seed) < F.lit(int(fraction * _TWO32)))


def bernoulli_sample(df: DataFrame, fraction: float, seed: int | None = None) -> DataFrame:
    """R2: sample(withReplacement=False, fraction)."""
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


def sample_exact(df: DataFrame, key: str, n: int, seed: int = 11) -> DataFrame:
    """Exactly n rows (or all, if fewer) chosen by md5(seed:key); a top-n, not a sort.

    One aggregate counts the rows below each power of two of the hash; the least of these that n rows
    are below is a filter, so about n to 2n rows meet in the top-n, not n of every partition.
    """
    unit = md5_unit(F.col(key), seed)
    counts = df.select(unit.alias("u")).agg(*[F.count_if(F.col("u") < (1 << k)).alias(f"k{k}") for k in range(33)]).first()
    least = next((k for k in range(33) if counts[f"k{k}"] >= n), 32)
    return (df.withColumn("__u", unit).filter(F.col("__u") < (1 << least))
            .orderBy("__u", key).limit(n).drop("__u"))


def dedupe_first(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """One row per key, the one with the least ``order`` (deterministic dropDuplicates).

    ``order`` is a unique numeric or date column.  Keys are grouped by a 256-bit digest
    (their texts, with lengths and nulls told apart), so the aggregate is a hash aggregate
    over short fixed-size rows, combined map-side; the other columns of the chosen rows are
    fetched by ``order`` afterwards.
    """
    text = [F.coalesce(F.concat(F.length(F.col(k).cast("string")).cast("string"), F.lit(":"), F.col(k).cast("string")), F.lit("-"))
            for k in keys]
    best = df.select(F.sha2(F.concat_ws("|", *text), 256).alias("__key"), order).groupBy("__key").agg(F.min(order).alias(order))
    return df.join(best.select(order), order, "left_semi")
