"""Evaluation texts leaking into training text.

Every shard of the training text gets a suffix array over its words. Every suffix of every test item is searched in
it by bisection, one more word per step, which leaves an interval of the array: the places where at least MIN_RUN words match. They
are carried on to the longest verbatim match, a bounded number of places at a time. Words that no test item has cannot be part of a match; they and runs too
short for a match are cut out before sorting, which leaves the result as it is.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Consecutive words that make a leak.
MIN_RUN = 12
#: Characters of test items searched in one pass; more are searched in further passes over the corpus.
BLOCK_CHARS = 16_000_000
#: Words of training text in one suffix array.
SHARD_WORDS = 4_000_000
#: Matches whose places are looked at together; intervals with more places are taken in parts.
PLACES = 2_000_000

_WORD = re.compile(r"[^\W_]+")


def words_of(text: str) -> list[str]:
    """Runs of letters or digits; case and the difference of ё and е are ignored."""
    return _WORD.findall(text.lower().replace("ё", "е"))


def suffix_array(tokens: np.ndarray, starts: np.ndarray, depth: int) -> np.ndarray:
    """``starts`` in the order of the first ``depth`` words of the suffixes beginning there, by prefix doubling."""
    n = len(tokens)
    rank = np.unique(tokens, return_inverse=True)[1].astype(np.int64) + 1
    span = 1
    while span < depth:
        ahead = np.zeros(n, np.int64)
        ahead[: max(0, n - span)] = rank[span:]
        pair = rank * (int(rank.max()) + 1) + ahead
        rank = np.unique(pair, return_inverse=True)[1].astype(np.int64) + 1
        span *= 2
    return starts[np.argsort(rank[starts], kind="stable")]


def _bisect(tokens: np.ndarray, sa: np.ndarray, lo: np.ndarray, hi: np.ndarray, at: int, want: np.ndarray, right: bool) -> np.ndarray:
    """First place in [lo, hi) whose word ``at`` is not below (right: is above) ``want``, for all searches at once."""
    lo, hi = lo.copy(), hi.copy()
    while True:
        open_ = lo < hi
        if not open_.any():
            return lo
        mid = (lo + hi) >> 1
        have = tokens[np.minimum(sa[np.minimum(mid, len(sa) - 1)] + at, len(tokens) - 1)]
        up = open_ & ((have <= want) if right else (have < want))
        lo = np.where(up, mid + 1, lo)
        hi = np.where(open_ & ~up, mid, hi)


class Items:
    """Test items as word numbers: one array with a closing -1 behind each item."""

    def __init__(self, items: list[tuple[int, str]]):
        self.number: dict[str, int] = {}
        flat: list[int] = []
        owner: list[int] = []
        for k, (_, text) in enumerate(items):
            flat += [self.number.setdefault(w, len(self.number)) for w in words_of(text)] + [-1]
            owner += [k] * (len(flat) - len(owner))
        self.ids = np.array([i for i, _ in items], np.int64)
        self.tokens = np.array(flat or [-1], np.int64)
        self.owner = np.array(owner or [0], np.int64)
        ends = np.flatnonzero(self.tokens < 0)
        self.left = ends[np.searchsorted(ends, np.arange(len(self.tokens)))] - np.arange(len(self.tokens))  # words to the item's end
        self.first = np.concatenate(([0], ends[:-1] + 1))
        self.longest = int(self.left.max(initial=0))

    def search(self, tokens: np.ndarray, starts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """Item number, place in ``tokens``, length and place in the item of each match of at least MIN_RUN words that is part of no longer one, in parts."""
        sa = suffix_array(tokens, starts, self.longest)
        q = np.flatnonzero(self.left >= MIN_RUN)
        lo, hi = np.zeros(len(q), np.int64), np.full(len(q), len(sa), np.int64)
        for at in range(MIN_RUN):
            want = self.tokens[q + at]
            lo, hi = _bisect(tokens, sa, lo, hi, at, want, False), _bisect(tokens, sa, lo, hi, at, want, True)
            keep = lo < hi
            q, lo, hi = q[keep], lo[keep], hi[keep]
        yield from self._placed(tokens, sa, q, lo, hi)

    def _placed(self, tokens: np.ndarray, sa: np.ndarray, q: np.ndarray, lo: np.ndarray, hi: np.ndarray):
        """The matches of the intervals [lo, hi) of the suffix array, at most PLACES at a time.

        A match that could begin a word earlier on both sides is part of that longer one and left out.
        """
        ends = np.cumsum(hi - lo)
        total = int(ends[-1]) if len(ends) else 0
        for begin in range(0, total, PLACES):
            flat = np.arange(begin, min(begin + PLACES, total))
            of = np.searchsorted(ends, flat, side="right")
            query, place = q[of], sa[lo[of] + flat - (ends - (hi - lo))[of]]
            inner = (query > 0) & (place > 0)
            before = inner & (self.tokens[query - 1] >= 0) & (self.tokens[query - 1] == tokens[place - 1])
            query, place = query[~before], place[~before]
            length = np.full(len(query), MIN_RUN, np.int64)
            going = np.arange(len(query))
            while len(going):  # the match is carried on to its full length
                a, b = query[going] + length[going], place[going] + length[going]
                same = (self.tokens[a] >= 0) & (self.tokens[a] == tokens[np.minimum(b, len(tokens) - 1)])
                going = going[same]
                length[going] += 1
            if len(query):
                yield self.owner[query], place, length, query - self.first[self.owner[query]]


def _shards(batches: Iterator[pa.RecordBatch], number: dict[str, int]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Words, suffix starts, owners and places in the document (from 0) of runs that can match, for about SHARD_WORDS words at a time."""
    get = number.get
    parts: list[np.ndarray] = []
    docs: list[tuple[int, int]] = []
    size = 0

    def close():
        tokens = np.concatenate(parts)
        sizes = np.array([n for _, n in docs], np.int64)
        owner = np.repeat(np.array([d for d, _ in docs], np.int64), sizes)
        within = np.arange(len(tokens)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        edge = np.flatnonzero(np.diff(np.concatenate(([False], tokens >= 0, [False])).astype(np.int8)))
        begin, end = edge[::2], edge[1::2]
        long_ = end - begin >= MIN_RUN
        begin, end = begin[long_], end[long_]
        if not len(begin):
            return None
        keep = np.zeros(len(tokens) + 1, np.int8)
        np.add.at(keep, begin, 1)
        np.add.at(keep, np.minimum(end + 1, len(tokens)), -1)  # the -1 behind a run stays as its end
        mask = np.cumsum(keep[:-1]) > 0
        tokens, owner, within = np.append(tokens[mask], -1), np.append(owner[mask], -1), np.append(within[mask], -1)
        return tokens, np.flatnonzero(tokens >= 0), owner, within

    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if not text or doc_id is None:
                continue
            found = np.fromiter((get(w, -1) for w in words_of(text)), np.int64)
            if len(found) < MIN_RUN:
                continue
            parts += [found, np.array([-1])]
            docs.append((doc_id, len(found) + 1))
            size += len(found) + 1
            if size >= SHARD_WORDS:
                if (shard := close()) is not None:
                    yield shard
                parts, docs, size = [], [], 0
    if parts and (shard := close()) is not None:
        yield shard


def _search(items):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table: Items = items.value
        for tokens, starts, owner, within in _shards(batches, table.number):
            for item, place, length, spot in table.search(tokens, starts):
                order = np.lexsort((spot, within[place], -length, item, owner[place]))
                item, place, length, spot = item[order], place[order], length[order], spot[order]
                doc = owner[place]
                first = np.ones(len(doc), bool)
                first[1:] = (doc[1:] != doc[:-1]) | (item[1:] != item[:-1])
                yield pa.RecordBatch.from_arrays([pa.array(doc[first]), pa.array(table.ids[item[first]]), pa.array(length[first]), pa.array(within[place[first]]), pa.array(spot[first])], names=["doc_id", "item_id", "n_words", "doc_word", "item_word"])

    return run


def leaked_items(docs: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, item_id, n_words: each document that holds at least MIN_RUN consecutive words of a test item, with the longest match (see longest_matches)."""
    return longest_matches(docs, items).select("doc_id", "item_id", "n_words")


def longest_matches(docs: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, item_id, n_words, doc_word, item_word: the longest match of each document with a test item of which it holds at least MIN_RUN
    consecutive words, and the number (from 0) of its first word in either; of several as long, the first in the document, then in the item.

    Null and empty texts on either side, items with fewer words and rows without an id match nothing; an item or document row
    that is repeated counts once; every item is searched in every document. The items are broadcast in blocks
    of at most BLOCK_CHARS characters (a single longer item makes its own block), one pass over the corpus each.
    """
    spark = docs.sparkSession
    items = items.select(F.col("item_id").cast("bigint").alias("item_id"), "text").filter("item_id is not null and text is not null").distinct()
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    found = None
    block: list[tuple[int, str]] = []

    def search(block):
        part = rows.mapInArrow(_search(spark.sparkContext.broadcast(Items(block))), "doc_id bigint, item_id bigint, n_words bigint, doc_word bigint, item_word bigint")
        return part if found is None else found.unionByName(part)

    size = 0
    for row in items.toLocalIterator():
        if block and size + len(row.text) > BLOCK_CHARS:
            found, block, size = search(block), [], 0
        block.append((row.item_id, row.text))
        size += len(row.text)
    found = search(block)
    best = F.min(F.struct((-F.col("n_words")).alias("less"), "doc_word", "item_word")).alias("best")
    return found.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", (-F.col("best.less")).alias("n_words"), "best.doc_word", "best.item_word")


def without_leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents, all columns, that hold no passage of a test item."""
    gone = leaked_items(docs, items).select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti")
