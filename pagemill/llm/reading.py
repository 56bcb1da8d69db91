"""Reading level of each document.

Word frequencies over all documents give each word its rank among the words of its script. A document's coverage rank
is the size of the smallest frequency-ranked vocabulary that covers a fixed share of its words; beside it stand
measures of its sentences. SQL then calibrates these features on the labelled documents (per language and band:
mean and spread of each feature, drawn towards the mean of both languages where labels are few) and gives every
document the likeliest band. Everything but the calibration covers all documents.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagemill.storage import Scratch

#: Share of a document's words that the vocabulary must cover.
SHARE = 0.75
#: Documents with fewer words separated by white space get no band.
MIN_WORDS = 25
#: Words up to which the rank table is broadcast to the executors, and different counts up to which their ranks are; beyond, both are joined by a shuffle.
BROADCAST_WORDS, BROADCAST_COUNTS = 250_000, 250_000
#: Weight, in labelled documents, of the mean of both languages in the mean of one.
SHRINK = 2.0
FEATURES = ("f_rank", "f_sentence", "f_clause", "f_word")

_WORD = re.compile(r"[^\W\d_]+")
_SENTENCE = re.compile(r"[.!?;…]+(?=\s|$)|\n+")


def _cyrillic(word: str) -> bool:
    return "Ѐ" <= word[0] <= "ԯ"


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts: Counter[str] = Counter()
        for text in batch.column(0).to_pylist():
            if text:
                counts.update(_WORD.findall(text.lower()))
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])


def word_ranks(docs: DataFrame, text: str = "text") -> DataFrame:
    """word, n, rank: how many words of the same script are more frequent, plus one. Ties share a rank.

    Ranks come from the histogram of counts, so no sort over all words is needed: of T words in all there are at most sqrt(2 T) different counts.
    """
    work = Scratch(docs.sparkSession, "ranks")
    words = docs.select(text).mapInArrow(_count_batches, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    words = work.cut(words.withColumn("cyrillic", F.col("word").rlike("^[\\x{400}-\\x{52f}]")), "words")
    hist = words.groupBy("cyrillic", "n").agg(F.count("*").alias("same"))
    above = work.cut(hist.select("cyrillic", "n", F.expr("1 + sum(same) over (partition by cyrillic order by n desc) - same").alias("rank")), "above")
    return words.join(F.broadcast(above) if above.count() <= BROADCAST_COUNTS else above, ["cyrillic", "n"]).select("word", "n", "rank")


def _weighted_median(values: np.ndarray, weights: np.ndarray) -> float:
    order = np.argsort(values, kind="stable")
    return float(values[order][np.searchsorted(np.cumsum(weights[order]), weights.sum() / 2)])


def _measure(text: str) -> tuple[bool, list[str], list[float]]:
    """Whether the bulk is Cyrillic, its words, and the logs of sentence length, commas and word length; the passages in the other script are left out."""
    parts = []
    total = 0
    for piece in _SENTENCE.split(text.lower()):
        words = _WORD.findall(piece)
        if words:
            own = sum(map(_cyrillic, words))
            parts.append((2 * own > len(words), words, piece.count(",")))
            total += len(words) if parts[-1][0] else -len(words)
    bulk = total > 0
    parts = [p for p in parts if p[0] == bulk]
    if not parts:
        return bulk, [], [0.0, 0.0, 0.0]
    size = np.array([len(p[1]) for p in parts])
    words = [w for p in parts for w in p[1] if _cyrillic(w) == bulk]
    letters = np.array([len(w) for w in words] or [1])
    commas = np.array([p[2] for p in parts])
    return bulk, words, [float(np.log(_weighted_median(size, size))), float(np.log1p(_weighted_median(commas, size))), float(np.log(letters.mean()))]


def _features(ranks: dict[str, int] | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = ranks.value if ranks is not None else None
        for batch in batches:
            out: list[tuple] = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if text is None or len(text.split()) < MIN_WORDS:
                    continue
                bulk, words, (sentence, clause, letters) = _measure(text)
                rank = None
                if table is not None:
                    have = np.fromiter((table[w] for w in words), dtype=np.int64, count=len(words))
                    have.sort()
                    rank = float(np.log(have[int(np.ceil(SHARE * len(have))) - 1])) if len(have) else 0.0
                out.append((doc_id, "ru" if bulk else "en", rank, sentence, clause, letters, words if table is None else None))
            cols = list(zip(*out)) if out else [[]] * 7
            kinds = [pa.int64(), pa.string(), pa.float64(), pa.float64(), pa.float64(), pa.float64(), pa.list_(pa.string())]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(cols, kinds)], names=["doc_id", "script", *FEATURES, "words"])

    return run


def features(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, script, and the features of each document with at least MIN_WORDS words."""
    work = Scratch(docs.sparkSession, "reading")
    ranks = work.cut(word_ranks(docs, text), "ranks")
    schema = "doc_id bigint, script string, f_rank double, f_sentence double, f_clause double, f_word double, words array<string>"
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    if ranks.count() <= BROADCAST_WORDS:
        table = docs.sparkSession.sparkContext.broadcast({r[0]: r[1] for r in ranks.select("word", "rank").toLocalIterator()})
        return work.cut(rows.mapInArrow(_features(table), schema).drop("words"), "features")
    wide = rows.mapInArrow(_features(None), schema)
    cover = wide.select("doc_id", F.explode("words").alias("word")).groupBy("doc_id", "word").agg(F.count("*").alias("tf")).join(ranks, "word")
    by_rank = Window.partitionBy("doc_id").orderBy("rank").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    covered = F.sum("tf").over(by_rank) >= F.ceil(SHARE * F.sum("tf").over(Window.partitionBy("doc_id")))
    cover = cover.withColumn("enough", covered).filter("enough").groupBy("doc_id").agg(F.log(F.min("rank")).alias("f_rank"))
    out = wide.drop("words", "f_rank").join(cover, "doc_id", "left").fillna(0.0, ["f_rank"])
    return work.cut(out.select("doc_id", "script", *FEATURES), "features")


def _per_feature(pattern: str, sep: str = ", ") -> str:
    return sep.join(pattern.format(f=f) for f in FEATURES)


def calibrate(feats: DataFrame, labels: DataFrame) -> DataFrame:
    """Reading bands in SQL: doc_id, band.

    Label rows repeated exactly count once, null bands and labels of unknown documents not at all; a document's label is the
    median of its raters, and a document whose median falls between two bands calibrates neither.
    """
    spark = feats.sparkSession
    label = spark.sql(
        """select doc_id, cast(band as int) as band from (
             select doc_id, percentile(band, 0.5) as band from (select distinct doc_id, band, rater from {labels}) where band between 1 and 4 group by doc_id)
           where band = floor(band)""",
        labels=labels.select("doc_id", "band", "rater"),
    )
    model = spark.sql(
        f"""with j as (select f.*, l.band from {{feats}} f join {{label}} l on l.doc_id = f.doc_id),
        spread as (select {_per_feature("greatest(coalesce(sqrt(avg(power({f} - m_{f}, 2))), 0), 0.05) as s_{f}")}
          from (select *, {_per_feature("avg({f}) over (partition by script, band) as m_{f}")} from j)),
        pooled as (select band, {_per_feature("avg({f}) as p_{f}")} from j group by band),
        own as (select script, band, count(*) as n, {_per_feature("avg({f}) as o_{f}")} from j group by script, band),
        scripts as (select 'ru' as script union all select 'en')
        select s.script, p.band, log(coalesce(n, 0) + 1) as prior, {_per_feature("s_{f}")},
          {_per_feature(f"(coalesce(n, 0) * coalesce(o_{{f}}, 0) + {SHRINK} * p_{{f}}) / (coalesce(n, 0) + {SHRINK}) as m_{{f}}")}
        from scripts s cross join pooled p cross join spread left join own o on o.script = s.script and o.band = p.band""",
        feats=feats, label=label,
    )
    return spark.sql(
        f"""select doc_id, cast(max_by(band, prior - {_per_feature("0.5 * power(({f} - m_{f}) / s_{f}, 2)", " - ")}) as int) as band
        from {{feats}} f join {{model}} m on m.script = f.script group by doc_id""",
        feats=feats, model=F.broadcast(model),  # two scripts by four bands: eight rows
    )


def reading_bands(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, band (1 to 4) of each document with at least MIN_WORDS words; see :func:`calibrate` for labels.

    Null, empty and short texts have no row. Without any usable label the result is empty. Extra columns are not read.
    """
    return calibrate(features(docs), labels)
