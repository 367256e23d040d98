"""Benchmark decontamination: SimHash over item-sized windows, multi-index Hamming blocks, exact check.

Words are runs of letters, digits, underscores and non-ASCII characters of the lower-cased
text; a text is the bag of its 5-word shingles (fewer words: the whole sequence), weighted by
how often each occurs.  A document leaks an item if one of its windows of as many words as
the item has a weighted Jaccard similarity (sum of the lesser weights over sum of the greater)
of ``similarity`` or more with it.

1. Every window of every item's size gets a 64-bit SimHash: the weighted majority of its
   shingle hashes, for all windows of a size at once from running sums of the bits.  Windows
   that hold no shingle of any item have similarity 0 with all of them and are not visited.
2. Multi-index: a fingerprint is cut into ``BLOCKS`` blocks of 16 bits.  Two fingerprints at
   most ``radius`` bits apart agree in some block up to ``radius // BLOCKS`` bits, so the
   items' blocks are stored with all their variants within that distance, and a window looks up
   its four blocks.  All items of its size within ``radius`` are found, none is missed.
3. Candidates within ``radius`` are verified by the exact similarity of the words themselves.

Items are taken in blocks of ``item_block``: each block's index is broadcast (its size is
bounded by that number) and the documents are scanned once for every block.

Defined cases: null or empty texts and items without words match nothing; a document shorter
than an item is one window; repeated items each match; repeated rows each have their rows; rows
of equal items are told apart by ``item_id``; of equally similar windows the first is
reported; other columns are left out (``clean`` keeps them).
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import WORD_BYTES, kept, packed, scored

SHINGLE = 5
BLOCKS = 4
_BASE, _STEP = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_WORD = re.compile(r"[0-9a-z_\x80-\U0010ffff]+")
_TABLE_BITS = 20


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Powers:
    """Powers of the hash base and of its inverse, grown when a longer chunk comes."""
    up = down = np.ones(1, np.uint64)

    @classmethod
    def of(cls, n: int):
        if len(cls.up) < n:
            cls.up = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, _BASE)]), dtype=np.uint64)
            cls.down = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, _INVERSE)]), dtype=np.uint64)
        return cls.up, cls.down


def word_hashes(texts: list) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of all texts, and the number of words before each text."""
    data, offsets = packed(texts)
    data = WORD_BYTES[data]
    inside = data != 32
    edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1  # data starts and ends with a space
    starts, ends = edge[::2], edge[1::2]
    up, down = _Powers.of(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(data.astype(np.uint64) * up[:len(data)], out=total[1:])
    return _mix((total[ends] - total[starts]) * down[starts]), np.searchsorted(starts, offsets)


def shingle_hashes(words: np.ndarray, k: int = SHINGLE) -> np.ndarray:
    """Hash of every run of k words of one text (fewer words: of the whole sequence)."""
    if not len(words):
        return words
    k = min(k, len(words))
    out = np.zeros(len(words) - k + 1, np.uint64)
    for i in range(k):
        out = out * _STEP + words[i:len(words) - k + 1 + i]
    return _mix(out)


def simhashes(shingles: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """SimHash of the windows of ``size`` shingles that begin at ``starts``."""
    bits = np.unpackbits(shingles.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    total = np.zeros((len(bits) + 1, 64), np.int32)
    np.cumsum(bits, axis=0, out=total[1:])
    ones = total[starts + size] - total[starts]
    return np.packbits(2 * ones > size, axis=1, bitorder="little").view("<u8")[:, 0]


def bag_similarity(a: Counter, b: Counter) -> float:
    """Weighted Jaccard similarity of two bags."""
    both = sum((a & b).values())
    either = sum(a.values()) + sum(b.values()) - both
    return both / either if either else 0.0


def bag(words: list[str]) -> Counter:
    k = min(SHINGLE, len(words))
    return Counter(tuple(words[i:i + k]) for i in range(len(words) - k + 1)) if words else Counter()


class ItemIndex:
    """Multi-index over the SimHashes of one block of items."""

    def __init__(self, items: list[tuple], radius: int):
        self.radius = radius
        self.items = [(i, w) for i, t in items if (w := _WORD.findall((t or "").lower()))]
        self.bags = [bag(w) for _, w in self.items]
        flips = [sum(1 << b for b in c) for k in range(radius // BLOCKS + 1) for c in combinations(range(16), k)]
        masks = np.array(flips, np.uint16)
        by_size: dict[int, list[int]] = {}
        for n, (_, w) in enumerate(self.items):
            by_size.setdefault(len(w), []).append(n)
        self.sizes: dict[int, tuple] = {}
        shingles: dict[int, list] = {}  # by their number of words: items of under SHINGLE words have shorter ones
        for size, members in sorted(by_size.items()):
            prints = []
            for n in members:
                s = shingle_hashes(word_hashes([" ".join(self.items[n][1])])[0])
                shingles.setdefault(min(size, SHINGLE), []).append(s)
                prints.append(simhashes(s, np.zeros(1, np.int64), len(s))[0])
            prints = np.array(prints, np.uint64)
            blocks = []
            for b in range(BLOCKS):
                value = ((prints >> np.uint64(16 * b)) & np.uint64(0xFFFF)).astype(np.uint16)
                near = (value[:, None] ^ masks).ravel()
                order = np.argsort(near, kind="stable")
                blocks.append((near[order], np.repeat(np.arange(len(members)), len(masks))[order]))
            self.sizes[size] = (np.array(members), prints, blocks)
        self.shingles = {k: np.unique(np.concatenate(v)) for k, v in shingles.items()}
        self.tables = {k: np.zeros(1 << _TABLE_BITS, bool) for k in self.shingles}
        for k, v in self.shingles.items():
            self.tables[k][(v >> np.uint64(64 - _TABLE_BITS)).astype(np.int64)] = True

    def holds(self, shingles: np.ndarray, k: int) -> np.ndarray:
        """Positions of shingles of k words that some item has."""
        known = self.shingles[k]
        at = np.flatnonzero(self.tables[k][(shingles >> np.uint64(64 - _TABLE_BITS)).astype(np.int64)])
        where = np.minimum(np.searchsorted(known, shingles[at]), len(known) - 1)
        return at[known[where] == shingles[at]]

    def near(self, prints: np.ndarray, size: int) -> Iterator[tuple[int, int, int]]:
        """(window, item, distance) of all items of this size within the radius of each fingerprint."""
        members, items, blocks = self.sizes[size]
        found = []
        for b, (values, owner) in enumerate(blocks):
            block = ((prints >> np.uint64(16 * b)) & np.uint64(0xFFFF)).astype(np.uint16)
            lo, hi = np.searchsorted(values, block, "left"), np.searchsorted(values, block, "right")
            n = hi - lo
            window = np.repeat(np.arange(len(prints)), n)
            at = np.arange(len(window)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)
            found.append(window * len(members) + owner[at])
        pairs = np.unique(np.concatenate(found))
        window, item = pairs // len(members), pairs % len(members)
        distance = np.bitwise_count(prints[window] ^ items[item])
        ok = distance <= self.radius
        yield from zip(window[ok].tolist(), members[item[ok]].tolist(), distance[ok].tolist(), strict=True)

    def leaks(self, text: str, words: np.ndarray, similarity: float) -> list[tuple]:
        """(item_id, similarity, distance, first word) of the best window for each leaked item."""
        runs = {k: shingle_hashes(words, k) for k in self.shingles}
        hits = {k: self.holds(v, k) for k, v in runs.items()}
        spelt, best = None, {}
        for size in self.sizes if any(map(len, hits.values())) else ():
            n, k = min(size, len(words)), min(size, SHINGLE)
            shingles, found = runs[k], hits[k]
            if not len(found):
                continue
            span = max(n - k + 1, 1)  # shingles of a window
            last = len(shingles) - span
            mark = np.zeros(last + 2, np.int32)  # windows that hold a hit: starts hit - span + 1 .. hit
            np.add.at(mark, np.clip(found - span + 1, 0, last + 1), 1)
            np.add.at(mark, np.minimum(found + 1, last + 1), -1)
            starts = np.flatnonzero(np.cumsum(mark[:-1]) > 0)
            if not len(starts):
                continue
            low, high = int(starts[0]), int(starts[-1]) + span
            prints = simhashes(shingles[low:high], starts - low, span)
            for window, item, distance in self.near(prints, size):
                spelt = spelt or _WORD.findall(text.lower())
                at = int(starts[window])
                s = bag_similarity(bag(spelt[at:at + n]), self.bags[item])
                if s >= similarity and (item not in best or (-s, at) < (-best[item][0], best[item][2])):
                    best[item] = (s, distance, at)
        return [(self.items[i][0], *v) for i, v in sorted(best.items())]


def item_blocks(items: DataFrame, id_col: str, text_col: str, size: int) -> Iterator[list[tuple]]:
    """Items in blocks of ``size``, one Spark partition at a time on the driver."""
    block = []
    for row in items.select(id_col, text_col).toLocalIterator():
        block.append((row[0], row[1]))
        if len(block) == size:
            yield block
            block = []
    if block:
        yield block


def leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          item_id: str = "item_id", item_text: str = "text", similarity: float = 0.8, radius: int = 15,
          item_block: int = 2048) -> DataFrame:
    """(id, item_id, similarity, distance, first_word) of every document row and item it leaks."""
    spark = docs.sparkSession
    from pyspark.sql.pandas.types import to_arrow_type
    item_type = to_arrow_type(items.schema[item_id].dataType)
    found = pa.list_(pa.struct([("item_id", item_type), ("similarity", pa.float64()), ("distance", pa.int32()),
                                ("first_word", pa.int64())]))
    out = None
    for block in item_blocks(items, item_id, item_text, item_block):
        index = spark.sparkContext.broadcast(ItemIndex(block, radius))  # item_block items at most

        def kernel(texts, index=index):
            words, offsets = word_hashes(texts)
            keys = ("item_id", "similarity", "distance", "first_word")
            return [[[dict(zip(keys, x)) for x in index.value.leaks(t, words[a:b], similarity)] if b > a else []
                     for t, a, b in zip(texts, offsets[:-1], offsets[1:])]]

        part = scored(docs, id_col, text_col, [("found", found)], kernel, 1 << 17)
        out = part if out is None else out.unionAll(part)
    if out is None:
        out = scored(docs.limit(0), id_col, text_col, [("found", found)], lambda texts: [[[] for _ in texts]])
    return out.select(id_col, F.inline("found"))


def clean(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id: str = "item_id",
          item_text: str = "text", similarity: float = 0.8, radius: int = 15, item_block: int = 2048) -> DataFrame:
    """Rows of ``docs``, all columns, that leak no item; one pass over what is left for each block of items."""
    for block in item_blocks(items, item_id, item_text, item_block):
        index = docs.sparkSession.sparkContext.broadcast(ItemIndex(block, radius))

        def keep(texts, index=index):
            words, offsets = word_hashes(texts)
            return [b <= a or not index.value.leaks(t, words[a:b], similarity)
                    for t, a, b in zip(texts, offsets[:-1], offsets[1:])]

        docs = kept(docs, text_col, keep, 1 << 17)
    return docs
