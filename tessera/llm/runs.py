"""Periodic run detection over words by a dictionary of basic factors.

A run is a stretch of consecutive words with smallest period q that holds at least
``least_periods`` periods and ``least_words`` words and that no neighbouring word extends.

Method: the factors of length 1, 2, 4, ... words of a document are numbered, each length from the
pair of numbers of its two halves, so equal factors have equal numbers.  At length L the
successor of a position is the next position of the same document with the same factor.  Inside
a run of period q, with L/2 < q <= L (so q is within twice the half that the factor was put
together from), every position's successor is q words on: the successors form arithmetic
progressions with step q.  Consecutive positions with one step make a stretch, which proposes the
period; its ends extend to first position .. last position + L - 1 + q.  Each period belongs to
one length, so no run is found twice; a shorter period can't hide behind a step, because the
factor would then recur earlier.

Only factors that recur in their document are kept for the next length, since all factors within
a run recur: ordinary prose is done after two or three lengths.  Memory goes with the words of a
slice of documents (about 100 bytes a word); a longer text comes alone, whole.

With at least three periods a run has a position with its successor at the run's own length:
``least_periods`` must be 3 or more.

Defined cases: a null text has no words and no runs; an empty text likewise; null ids are kept;
repeated rows are decided one by one; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from tessera.llm.common import cut

#: Words are runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: Words of one slice of documents.
SLICE_WORDS = 1 << 19
#: One run: first word, length and period in words.
RUN = StructType([StructField(n, LongType()) for n in ("start", "length", "period")])


def words_of(text: str | Column) -> Column:
    """The words of a text; none for null."""
    text = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.regexp_extract_all(text, F.lit(f"({WORD})"), F.lit(1)), F.array().cast("array<string>"))


def _numbered(keys: np.ndarray) -> np.ndarray:
    return np.unique(keys, return_inverse=True)[1].astype(np.int64)


def runs_in(words: np.ndarray, starts: np.ndarray, least_periods: int = 4, least_words: int = 6) -> tuple[np.ndarray, ...]:
    """Runs of documents that lie one behind the other: ``words`` are their word numbers, document i at starts[i]:starts[i + 1].

    Returns (first word, length, period), the first words counted over all documents; no order.
    """
    found = [np.zeros((0, 3), np.int64)]
    sizes = np.diff(starts)
    doc = np.repeat(np.arange(len(sizes)), sizes)
    at = np.arange(len(words))
    name = _numbered(doc * (int(words.max(initial=0)) + 1) + words) if len(words) else at
    most = int(sizes.max(initial=0)) // least_periods     # the longest period that any document has room for
    length = 1
    while len(at) and length < 2 * max(most, 1):
        order = np.argsort(name, kind="stable")           # positions stay ascending within a name
        same = name[order[1:]] == name[order[:-1]]
        step = np.zeros(len(at), np.int64)                # distance to the successor, 0 for none
        step[order[:-1][same]] = at[order[1:][same]] - at[order[:-1][same]]
        recurs = step > 0
        recurs[order[1:][same]] = True
        # stretches of neighbouring positions with one step, of the periods that belong to this length
        held = np.flatnonzero((2 * step > length) & (step <= length))
        if len(held):
            breaks = (np.diff(at[held]) != 1) | (np.diff(step[held]) != 0)
            first = held[np.concatenate([[True], breaks])]
            last = held[np.concatenate([breaks, [True]])]
            size = at[last] + length - at[first] + step[first]
            good = size >= np.maximum(least_words, least_periods * step[first])
            found.append(np.stack([at[first], size, step[first]], axis=1)[good])
        # factors of twice the length begin where two neighbouring factors both recur
        at, name = at[recurs], name[recurs]
        after = np.searchsorted(at, at + length)
        inside = after < len(at)
        inside[inside] = at[after[inside]] == at[inside] + length
        halves = name[inside] * (int(name.max(initial=0)) + 1) + name[after[inside]]
        at, name = at[inside], _numbered(halves) if len(halves) else halves
        length *= 2
    return tuple(np.concatenate(found).T)


def _kept(n: int, start: np.ndarray, length: np.ndarray, period: np.ndarray) -> np.ndarray:
    """True for words that no run holds after its first period."""
    edges = np.zeros(n + 1, np.int64)
    np.add.at(edges, start + period, 1)
    np.add.at(edges, start + length, -1)
    return np.cumsum(edges[:-1]) == 0


def _slices(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes = pc.list_value_length(batch.column("words")).to_pylist()
        for a, b in cut(sizes, words):
            yield batch.slice(a, b - a)


def find_runs(docs: DataFrame, id_col: str = "doc_id", words_col: str = "words", least_periods: int = 4,
              least_words: int = 6, slice_words: int = SLICE_WORDS) -> DataFrame:
    """(id, n_words, runs, collapsed) of every row: its runs by start, then period, and its words without their repeats.

    ``words_col`` is an array of words (``words_of`` a text).  ``collapsed`` joins by one space the
    words that no run holds after that run's first period.
    """
    if least_periods < 3:
        raise ValueError("runs of fewer than three periods are not found by this method")
    no_nulls = F.transform(F.coalesce(F.col(words_col), F.array().cast("array<string>")), lambda w: F.coalesce(w, F.lit("")))
    source = docs.select(F.col(id_col).alias("id"), no_nulls.alias("words"))

    def run(batches):
        for part in _slices(batches, slice_words):
            lists = part.column("words")
            flat = lists.flatten()
            starts = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy())]).astype(np.int64)
            numbers = flat.dictionary_encode().indices.to_numpy().astype(np.int64)
            start, length, period = runs_in(numbers, starts, least_periods, least_words)
            stays = _kept(len(flat), start, length, period)
            kept = flat.filter(pa.array(stays))
            left = np.concatenate([[0], np.cumsum(stays)])[starts].astype(np.int32)
            order = np.lexsort([period, start])
            start, length, period = start[order], length[order], period[order]
            owner = np.searchsorted(starts, start, side="right") - 1
            bounds = np.searchsorted(owner, np.arange(len(starts))).astype(np.int32)
            runs = pa.StructArray.from_arrays([pa.array(start - starts[owner]), pa.array(length), pa.array(period)],
                                              ["start", "length", "period"])
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), pa.array(np.diff(starts)), pa.ListArray.from_arrays(bounds, runs),
                 pc.binary_join(pa.ListArray.from_arrays(left, kept), " ")], ["id", "n_words", "runs", "collapsed"])

    schema = StructType([source.schema["id"], StructField("n_words", LongType()), StructField("runs", ArrayType(RUN)),
                         StructField("collapsed", StringType())])
    return source.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def strongest(runs: str = "runs") -> Column:
    """The run with the greatest exact length / period; ties go to the smaller start, then period; null without runs."""
    def better(a, b):
        x, y = b["length"] * a["period"], a["length"] * b["period"]
        tie = (b["start"] < a["start"]) | ((b["start"] == a["start"]) & (b["period"] < a["period"]))
        return (x > y) | ((x == y) & tie)

    return F.aggregate(runs, F.try_element_at(F.col(runs), F.lit(1)), lambda a, b: F.when(better(a, b), b).otherwise(a))
