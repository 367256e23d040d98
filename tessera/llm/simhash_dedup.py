"""SimHash near-dedup: pivot distance tables find all fingerprint pairs within a few bits.

Fingerprint.  A text's A-Z are lower-cased, its words are the runs of bytes other than white
space, and every run of ``shingle`` words (repeats included; the whole sequence if there are
fewer) is hashed with XXH64 (seed 42).  A fingerprint bit is 1 if it is set in over half of
the hashes.  A text without words has fingerprint zero and links like any other.

Links.  Equal fingerprints are grouped first, so copies cost one row.  The reference
fingerprints are 64 fixed pivots, the rows of a Walsh matrix, any two of which differ in half
of their bits.  For each of ``PARTS`` bit ranges the table holds the Hamming distance of the
fingerprint to every pivot within that range.  For any two fingerprints the distances to one
pivot differ by at most the number of differing bits, in every range.  So if two fingerprints
differ in at most ``radius`` bits, at least ``PARTS - radius`` ranges have no difference at
all: the distances to all pivots are equal there (maximum coordinate difference 0).  The table
is therefore joined on the distance rows of every choice of ``PARTS - radius`` ranges; pairs
of which no choice agrees are discarded unseen, pairs whose distances differ by more than
``radius`` in the rest are discarded next, and the survivors are verified by their bits.

A fingerprint has at most ``C(64, 2) + 64`` others within 2 bits, so the links of a group of
copies or near copies are bounded by its distinct fingerprints, never by its pairs of rows.
Connected components come from alternating star steps, each checkpointed in the shared folder.

Defined cases: a null text counts as empty; equal rows share a component; a null id takes
part but can't name a component (null only if all ids of the component are null); an empty
table gives an empty result; other columns are left out (``first_of_each`` keeps them).
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import encoded, scored, written
from tessera.session import checkpoint_dir

SEED = 42  # fixed value of the contract
#: Bit ranges of a fingerprint: 5 of 13, 13, 13, 13 and 12 bits.
PARTS = 5
PIVOTS = 16


def fingerprints(texts: list, shingle: int = 3) -> list[int]:
    """Unsigned 64-bit fingerprint of every text."""
    digest, out = xxhash.xxh64_intdigest, []
    for text in texts:
        words = encoded(text).lower().split()  # bytes: A-Z only, and ASCII white space only
        if not words:
            out.append(0)
            continue
        joined = b" ".join(words)
        if len(words) <= shingle:
            out.append(digest(joined, SEED))
            continue
        ends, at = [], -1
        for w in words:
            at += len(w) + 1
            ends.append(at)
        starts = [0] + [e + 1 for e in ends[:-shingle]]
        hashes = np.array([digest(joined[s:e], SEED) for s, e in zip(starts, ends[shingle - 1:], strict=True)], np.uint64)
        ones = np.zeros(64, np.int64)
        for a in range(0, len(hashes), 1 << 14):
            part = hashes[a:a + (1 << 14)].astype("<u8").view(np.uint8).reshape(-1, 8)
            ones += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
        bits = (2 * ones > len(hashes)).astype(np.uint8)
        out.append(int(np.packbits(bits, bitorder="little").view("<u8")[0]))
    return out


def with_fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """(id, fp) with the fingerprint as a signed long."""
    return scored(docs, id_col, text_col, [("fp", pa.int64())],
                  lambda texts: [np.array(fingerprints(texts, shingle), np.uint64).view(np.int64)])


def _ranges(parts: int) -> list[int]:
    """Bit mask (signed) of each range."""
    cuts = [round(64 * i / parts) for i in range(parts + 1)]
    masks = [(1 << b) - (1 << a) for a, b in zip(cuts, cuts[1:])]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def pivots(n: int = PIVOTS) -> list[int]:
    """Reference fingerprints (signed): Walsh rows, bit j of row i is the parity of i & j."""
    rows = [sum(((i & j).bit_count() & 1) << j for j in range(64)) for i in range(n)]
    return [r - (1 << 64) if r >> 63 else r for r in rows]


def _distance_row(fp, mask: int):
    """Distances to all pivots within one range, as one array column."""
    return F.array(*[F.bit_count(fp.bitwiseXOR(F.lit(p)).bitwiseAND(F.lit(mask))).cast("byte") for p in pivots()])


def pivot_table(fps: DataFrame, radius: int) -> DataFrame:
    """(fp, key): for each choice of ranges that may agree, the hash of their distance rows.

    Equal rows have equal keys; different ones with equal keys only cost a comparison.
    """
    parts = max(PARTS, radius + 1)
    masks = _ranges(parts)
    rows = fps.select("fp", *[F.xxhash64(_distance_row(F.col("fp"), m)).alias(f"d{i}") for i, m in enumerate(masks)])
    keys = [F.xxhash64(F.lit(n), *[F.col(f"d{i}") for i in choice])
            for n, choice in enumerate(combinations(range(parts), parts - radius))]
    return rows.select("fp", F.explode(F.array(*keys)).alias("key"))


def links(fps: DataFrame, radius: int) -> DataFrame:
    """Distinct pairs (a, b), a < b, of the distinct fingerprints that differ in 1 to ``radius`` bits."""
    table = pivot_table(fps, radius)
    a, b = table.select("key", F.col("fp").alias("a")), table.select("key", F.col("fp").alias("b"))
    near = reduce(lambda x, y: x & y, [
        F.abs(F.bit_count(F.col("a").bitwiseXOR(F.lit(p))) - F.bit_count(F.col("b").bitwiseXOR(F.lit(p)))) <= radius
        for p in pivots()[1:4]])
    differ = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    return (a.join(b.hint("merge"), (a.key == b.key) & (F.col("a") < F.col("b")) & near & (differ <= radius))
            .select("a", "b").distinct())


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node reachable, for every node but the roots, by alternating star steps."""
    checkpoint_dir(edges.sparkSession)
    pairs = edges.select("a", "b").checkpoint()
    while True:
        both = pairs.union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # large star: larger neighbours go to the smallest of the neighbourhood, itself included
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = (both.join(low, "a").filter(F.col("b") > F.col("a")).select(F.col("m").alias("a"), "b")
                 .filter("a < b").distinct().checkpoint())
        # small star: a node and its smaller neighbours go to the smallest of them
        least = large.groupBy("b").agg(F.min("a").alias("m"))
        moved = large.join(least, "b")
        small = (moved.select(F.col("m").alias("a"), "b")
                 .union(moved.filter("a <> m").select(F.col("m").alias("a"), F.col("a").alias("b")))
                 .distinct().checkpoint())
        same = (small.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
                == pairs.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first())
        pairs = small
        if same:
            return pairs.select(F.col("b").alias("node"), F.col("a").alias("root"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                    radius: int = 2) -> DataFrame:
    """(id, fingerprint, component_id) of every row; component_id is the smallest id reachable by links."""
    prints = written(with_fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    # of copies, only (fp, component_id) is joined back: one row for each fingerprint
    return prints.join(_owners(prints, id_col, radius).drop("root"), "fp").select(
        id_col, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def _owners(prints: DataFrame, id_col: str, radius: int) -> DataFrame:
    """(fp, root, component_id) of every fingerprint; component_id is null where no row of the component has an id."""
    groups = prints.groupBy("fp").agg(F.min(id_col).alias("least"))
    roots = components(links(groups.select("fp"), radius))
    named = (groups.join(roots, groups.fp == roots.node, "left")
             .select("fp", F.coalesce("root", "fp").alias("root"), "least"))
    smallest = named.groupBy("root").agg(F.min("least").alias("component_id"))
    return named.join(smallest, "root").select("fp", "root", "component_id")


def first_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                  radius: int = 2) -> DataFrame:
    """Rows of ``docs``, all columns: of each component the one with the smallest id.

    Of rows that share that id one stays, the first by the hash of its columns.  Rows without an
    id stay only in a component where no row has one: of these the first by fingerprint and the
    hashes of its text and columns.
    """
    prints = written(with_fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    owners = written(_owners(prints, id_col, radius), "owners")
    found = prints.join(owners, "fp").select(id_col, "component_id")
    nameless = docs.filter(F.col(id_col).isNull())
    if not nameless.isEmpty():
        whole = with_fingerprints(nameless.select(F.struct(*docs.columns).alias("__row"), text_col), "__row", text_col, shingle)
        least = F.min_by("__row", F.struct("fp", F.xxhash64(F.col("__row")[text_col]), F.xxhash64("__row")))
        one = whole.join(owners.filter("component_id IS NULL"), "fp").groupBy("root").agg(least.alias("__row")).select("__row.*")
        named = first_of_each_id(docs.filter(F.col(id_col).isNotNull()), found, id_col)
        return named.unionByName(one)
    return first_of_each_id(docs, found, id_col)


def first_of_each_id(docs: DataFrame, found: DataFrame, id_col: str) -> DataFrame:
    """Rows of ``docs`` whose id is their component's in ``found`` (id, component_id), one for each id.

    The join with the ids to leave out is a sort-merge join at every size, as it has to be at a large one.
    """
    found = written(found, "groups")
    others = found.filter(F.col(id_col) != F.col("component_id")).select(id_col).distinct()
    again = found.filter(F.col(id_col).isNotNull()).groupBy(id_col).count().filter("count > 1").select(id_col)
    if again.isEmpty():
        return docs.join(others.hint("merge"), id_col, "left_anti").select(docs.columns)
    # rows of repeated ids are ranked; all others pass by one join on the ids
    firsts = docs.join(others.union(again).hint("merge"), id_col, "left_anti")
    order = Window.partitionBy(id_col).orderBy(F.xxhash64(*docs.columns))
    ranked = (docs.join(again.join(others, id_col, "left_anti"), id_col, "left_semi")
              .withColumn("__n", F.row_number().over(order)))
    return firsts.select(docs.columns).unionByName(ranked.filter("__n = 1").select(docs.columns))
