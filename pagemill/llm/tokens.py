"""Encoding of the whole corpus with a public tokenizer.

The words the corpus uses most (pieces of the tokenizer's own pre-tokenization) are compiled with their ids into a
minimal acyclic transducer: states that accept the same suffixes are shared, and each arc carries the number of words
passed over by taking it, so a walk ends in the word's number, and that number points to its ids. The transducer is a
single file that executors memory-map. Words it does not know are merged exactly by the tokenizer's ranks; so
the size of the lexicon changes the speed only, never the ids.
"""

from __future__ import annotations

import base64
import io
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.storage import shared_dir

#: Folder of the public vocabulary files; a parameter, on every machine of the cluster.
TOKENIZERS = "/opt/tokenizers"
#: Pre-tokenization of byte_bpe_50k: fixed value of the public vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Most frequent words that are compiled; all others are merged when met.
LEXICON_WORDS = 50_000


class Lexicon:
    """A minimal acyclic transducer in flat arrays.

    ``key``: state * 256 + byte of each arc, ascending; ``to``, ``skip``: its target and the words passed over;
    ``final``: whether a word ends in the state; ``start``, ``ids``: the ids of each word by its number.
    """

    FIELDS = ("key", "to", "skip", "final", "start", "ids")

    def __init__(self, **arrays: np.ndarray):
        for name in self.FIELDS:
            setattr(self, name, arrays[name])

    @classmethod
    def build(cls, words: dict[bytes, list[int]]) -> Lexicon:
        """From words, added in ascending order; each finished branch is replaced by an equal one that is already known."""
        known: dict[tuple, int] = {}
        states: list[tuple[bool, tuple[tuple[int, int], ...]]] = []

        def settle(final: bool, arcs: list[tuple[int, int]]) -> int:
            shape = (final, tuple(arcs))
            if shape not in known:
                known[shape] = len(states)
                states.append(shape)
            return known[shape]

        open_: list[tuple[list, list[tuple[int, int]]]] = [([False], [])]  # the states along the last word: final flag, arcs
        last = b""
        order = sorted(words)
        for word in order:
            common = 0
            while common < min(len(word), len(last)) and word[common] == last[common]:
                common += 1
            while len(open_) > common + 1:
                flag, arcs = open_.pop()
                open_[-1][1].append((last[len(open_) - 1], settle(flag[0], arcs)))
            open_ += [([False], []) for _ in word[common:]]
            open_[-1][0][0] = True
            last = word
        while len(open_) > 1:
            flag, arcs = open_.pop()
            open_[-1][1].append((last[len(open_) - 1], settle(flag[0], arcs)))
        root = settle(open_[0][0][0], open_[0][1])
        number = [0] * len(states)  # words from each state; targets always stand before their sources
        key, to, skip = [], [], []
        for s, (final, arcs) in enumerate(states):
            passed = int(final)
            for byte, target in arcs:
                key.append((0 if s == root else s + 1) * 256 + byte)
                to.append(target + 1)
                skip.append(passed)
                passed += number[target]
            number[s] = passed
        final = np.zeros(len(states) + 1, bool)
        for s, (end, _) in enumerate(states):
            final[0 if s == root else s + 1] = end
        at = np.argsort(np.array(key, np.int64), kind="stable") if key else np.zeros(0, np.int64)
        lengths = np.array([len(words[w]) for w in order], np.int64)
        return cls(
            key=np.array(key, np.int64)[at], to=np.array(to, np.int64)[at], skip=np.array(skip, np.int64)[at], final=final,
            start=np.concatenate(([0], np.cumsum(lengths))).astype(np.int64), ids=np.array([i for w in order for i in words[w]], np.int32),
        )

    def to_bytes(self) -> bytes:
        out = io.BytesIO()
        for name in self.FIELDS:
            array = getattr(self, name)
            out.write(np.array([len(array)], np.int64).tobytes() + array.tobytes() + bytes(-array.nbytes % 8))
        return out.getvalue()

    @classmethod
    def map_file(cls, path: str) -> Lexicon:
        """The arrays as views of the memory-mapped file."""
        raw, at, arrays = np.memmap(path, np.uint8, "r"), 0, {}
        for name, kind in zip(cls.FIELDS, (np.int64, np.int64, np.int64, np.bool_, np.int64, np.int32)):
            n = int(raw[at : at + 8].view(np.int64)[0])
            size = n * np.dtype(kind).itemsize
            arrays[name] = raw[at + 8 : at + 8 + size].view(kind)
            at += 8 + size + -size % 8
        return cls(**arrays)

    def find(self, words: list[bytes]) -> np.ndarray:
        """Number of each word, -1 where it is not in the lexicon; all words walk at once, a byte per step."""
        n = np.fromiter(map(len, words), np.int64, len(words))
        flat, begin = np.frombuffer(b"".join(words), np.uint8).astype(np.int64), np.concatenate(([0], np.cumsum(n)[:-1])).astype(np.int64)
        state, out = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        going = np.flatnonzero(n > 0) if len(self.key) else np.zeros(0, np.int64)
        out[n == 0] = -1
        if not len(self.key):
            return np.full(len(words), -1, np.int64)
        step = 0
        while len(going):
            want = state[going] * 256 + flat[begin[going] + step]
            arc = np.minimum(np.searchsorted(self.key, want), len(self.key) - 1)
            hit = self.key[arc] == want
            out[going[~hit]] = -1
            going, arc = going[hit], arc[hit]
            state[going] = self.to[arc]
            out[going] += self.skip[arc]
            step += 1
            ended = n[going] == step
            stop = going[ended]
            out[stop[~self.final[state[stop]]]] = -1
            going = going[~ended]
        return out


_encoders: dict[str, object] = {}


def merger(vocabulary: str):
    """Exact byte-pair merging of one word, whatever is in it, by the ranks of the vocabulary file; kept for the life of the process."""
    if vocabulary not in _encoders:
        import tiktoken

        with open(vocabulary, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        _encoders[vocabulary] = tiktoken.Encoding("own", pat_str=r"(?s).+", mergeable_ranks=ranks, special_tokens={}).encode_ordinary
    return _encoders[vocabulary]


class _Numbering(dict):
    """Gives each new key the next number."""

    def __missing__(self, key: str) -> int:
        self[key] = len(self)
        return self[key]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    find = regex.compile(PATTERN).findall
    for batch in batches:
        counts: Counter[str] = Counter()
        for text in batch.column(0).to_pylist():
            if text:
                counts.update(find(text))
        counts = Counter({w: n for w, n in counts.items() if len(w) <= 64})
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])


def frequent_words(docs: DataFrame, text: str = "text", most: int = LEXICON_WORDS) -> DataFrame:
    """word, n: the pieces of up to 64 characters that the whole corpus uses most; at most ``most`` rows."""
    counts = docs.select(text).mapInArrow(_count, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    return counts.orderBy(F.desc("n"), "word").limit(most)


def publish(spark: SparkSession, words: list[str], vocabulary: str) -> str:
    """Compiles the words, writes the transducer to the shared folder and has it sent to executors; returns its file name."""
    merge = merger(vocabulary)
    lexicon = Lexicon.build({w.encode(): list(merge(w)) for w in words})
    name = f"lexicon-{uuid.uuid4().hex}.bin"
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/{name}")
    files = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.deleteOnExit(target)
    out = files.create(target, True)
    out.write(bytearray(lexicon.to_bytes()))
    out.close()
    spark.sparkContext.addFile(target.toString())
    return name


def _encode(name: str, vocabulary: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find, merge = regex.compile(PATTERN).findall, merger(vocabulary)
        lexicon = Lexicon.map_file(SparkFiles.get(name))
        for batch in batches:
            number = _Numbering()
            parts = [np.fromiter(map(number.__getitem__, find(text)), np.int64) if text else np.zeros(0, np.int64) for text in batch.column(1).to_pylist()]
            texts = list(number)
            words = [w.encode() for w in texts]
            place = lexicon.find(words)
            unseen = np.flatnonzero(place < 0)
            merged = [np.array(merge(texts[i]), np.int32) for i in unseen]
            sizes = np.zeros(len(words), np.int64)
            known = place >= 0
            sizes[known] = lexicon.start[place[known] + 1] - lexicon.start[place[known]]
            begin = np.zeros(len(words), np.int64)
            begin[known] = lexicon.start[place[known]]
            own = np.array([len(m) for m in merged], np.int64)
            sizes[unseen], begin[unseen] = own, len(lexicon.ids) + np.cumsum(own) - own
            pool = np.concatenate([lexicon.ids, *merged]) if merged else np.asarray(lexicon.ids)
            flat = np.concatenate([*parts, np.zeros(0, np.int64)])
            many = sizes[flat]
            ends = np.cumsum(many)
            take = np.repeat(begin[flat] - ends + many, many) + np.arange(many.sum())
            edge = np.concatenate(([0], np.cumsum([len(p) for p in parts]))).astype(np.int64)
            offsets = np.concatenate(([0], ends))[edge].astype(np.int32)
            ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(pool[take].astype(np.int32)))
            yield pa.RecordBatch.from_arrays([batch.column(0), ids], names=["doc_id", "ids"])

    return run


def encode(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", vocabulary: str = f"{TOKENIZERS}/byte_bpe_50k.tiktoken", most: int = LEXICON_WORDS) -> DataFrame:
    """doc_id, ids: every row's token ids, without special tokens.

    A null and an empty text give an empty list; blank texts are encoded as they are; strings that look like control tokens are
    ordinary text. Rows are neither merged nor dropped, so a repeated id is repeated; extra columns are not read.
    """
    spark = docs.sparkSession
    words = [r.word for r in frequent_words(docs, text, most).collect()]  # at most ``most`` rows
    name = publish(spark, words, vocabulary)
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(_encode(name, vocabulary), "doc_id bigint, ids array<int>")
