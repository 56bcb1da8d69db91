"""Word and sign counts over a whole corpus, and the model of its Cyrillic words by letter bigrams."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Letters of the model in order; number 0 is the edge of a word.
LETTERS = "абвгдежзийклмнопрстуфхцчшщъыьэюяё"
NUMBER = {c: i + 1 for i, c in enumerate(LETTERS)}

_WORD = re.compile(r"[^\W\d_]+")
#: Characters beyond ASCII and Cyrillic: signs, and letters that are strange in Cyrillic text.
_SIGN = re.compile(r"[^\x00-\x7fА-яЁё]")
#: The rows of the word counts that the models use.
IN_MODEL = "word rlike '^[А-Яа-яЁё]+$' or length(word) = 1"


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts: Counter[str] = Counter()
        for text in batch.column(0).to_pylist():
            if text:
                counts.update(_WORD.findall(text))
                if not text.isascii():
                    counts.update(_SIGN.findall(text))
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])


def word_counts(texts: DataFrame, text: str = "text") -> DataFrame:
    """word, n: runs of letters, and single characters beyond ASCII and Cyrillic, of all texts, counted per batch before the shuffle."""
    return texts.select(text).mapInArrow(_count, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def letter_bigrams(words: DataFrame) -> np.ndarray:
    """Joint log-probability of each pair of neighbouring letters, edges included; add-half smoothing.

    The result of the aggregate has at most 34 x 34 rows, whatever the corpus.
    """
    pure = words.filter(F.col("word").rlike("^[А-Яа-яЁё]+$")).withColumn("w", F.concat(F.lit("|"), F.lower("word"), F.lit("|")))
    pairs = pure.select("n", F.explode(F.expr("transform(sequence(1, length(w) - 1), i -> substring(w, i, 2))")).alias("pair"))
    joint = np.full((len(LETTERS) + 1,) * 2, 0.5)
    for row in pairs.groupBy("pair").agg(F.sum("n").alias("n")).collect():
        joint[NUMBER.get(row.pair[0], 0), NUMBER.get(row.pair[1], 0)] += row.n
    joint[0, 0] = 0.5
    return np.log(joint / joint.sum())


def sign_shares(words: DataFrame) -> dict[str, float]:
    """Log-probability of each character beyond ASCII and Cyrillic among all characters of words and signs; of one not seen under "".

    The result of the aggregate has at most as many rows as there are characters.
    """
    alone = F.col("word").rlike("^[^\\x00-\\x7fА-яЁё]$")
    rows = words.groupBy(F.when(alone, F.col("word")).otherwise("").alias("sign")).agg(F.sum(F.col("n") * F.length("word")).alias("n")).collect()
    total = max(1.0, float(sum(r.n for r in rows)))
    out = {r.sign: float(np.log(r.n / total)) for r in rows if r.sign}
    return {**out, "": float(np.log(0.5 / total))}


def conditional(joint: np.ndarray) -> list[list[float]]:
    """Log-probability of the second letter given the first."""
    p = np.exp(joint)
    return np.log(p / p.sum(1, keepdims=True)).tolist()


def mean_score(word: str, cond: list[list[float]]) -> float:
    """Mean log-probability of a lower-case Cyrillic word's letters and its end."""
    before, total = 0, 0.0
    for c in word:
        now = NUMBER[c]
        total += cond[before][now]
        before = now
    return (total + cond[before][0]) / (len(word) + 1)
