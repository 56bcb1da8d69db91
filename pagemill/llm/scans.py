"""Noise in text from scanned pages.

1. Words of all pages are counted, words broken at a line end with both parts. What a break is worth is decided by the
   counts: the joined word against the compound with its own hyphen.
2. Skip-gram vectors are learned on the scanned pages. Skip-gram with negative sampling factorises the matrix of pointwise mutual
   information of words and the words around them (Levy and Goldberg, 2014), so that matrix is counted over all pages and
   factorised: the vectors depend on no order, split or sample of the pages. Every word, rare ones too, has a vector;
   numbers and the rare words in capitals or not make three classes with vectors of their own.
3. A rare word is linked to a more frequent one if plausible glyph edits lead to it and their vectors are near: the smaller
   the ratio of their counts, the nearer they must be. A token that its signs make suspect (a mark or digit in a word,
   a letter in a number) and that no word explains is linked to the class it should belong to, by the same vectors. An occurrence is corrected to
   the linked word that fits its own context best.
4. Running lines are found per source by counting the pages on which a line, without case, numbers and reading
   errors, stands at the head or foot; page numbers by the page's own number. Both are removed, and the
   lines are reflowed into paragraphs.
5. A word broken at the page end is made whole on the page where it begins: the next page of the source, by an
   equi-join on source and page number, gives its first word away. Counts judge its hyphen as they do at a line end.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemill.llm.confusables import _shape
from pagemill.storage import Scratch

SCANNED = "yolo_doctr"
# What scanning makes of a glyph, as read -> as printed; a mark can stand for any letter.
GLYPHS = {"с": "е", "п": "н", "г": "т", "н": "вп", "л": "д", "х": "к", "ш": "щ", "щ": "ш", "д": "ц", "0": "о", "3": "з", "6": "б", "4": "ч", "ьі": "ы", "іо": "ю"}
MARKS = "~�□|"
BREAKS = "-‐‑¬–\xad⁃"
#: A word is linked to one that occurs at least RATIO times as often, beyond FEW occurrences COMMON_RATIO times; one with a mark, digit or і in it to any that occurs SIGN_LEAST times.
RATIO, FEW, COMMON_RATIO, SIGN_LEAST = 8, 2, 25, 2
#: Words of context that a vector counts, its dimensions, and how far a word's context reaches to either side.
CONTEXTS, DIMENSIONS, WINDOW = 512, 32, 3
#: Cosine that links a word to one RATIO times as frequent (each doubling of the ratio lowers it by SLOPE, to LEAST_FIT) and a suspect token to its class.
MIN_FIT, SLOPE, LEAST_FIT, CLASS_FIT = 0.12, 0.02, 0.02, 0.1
#: Contexts of its class that are added to those of a rare word.
SHRINK = 8.0
#: Words from MIN_COUNT occurrences that need no look at each occurrence: the most frequent ones without links. Which are left out changes the speed only.
MIN_COUNT, SKIP_WORDS = 20, 20_000
#: Sources with scanned pages up to which they are broadcast.
BROADCAST_SOURCES = 500_000
#: Running lines: share of the pages of the source, pages of the source, lines looked at on either end.
RUN_SHARE, RUN_PAGES, EDGE_LINES = 1 / 3, 8, 2

_CUT = "\x01"
_TOKEN = re.compile(rf"[а-яёі0-9{MARKS}{_CUT}]*[а-яёі{_CUT}][а-яёі0-9{MARKS}{_CUT}]*(?:-[а-яёі0-9{MARKS}{_CUT}]+)*")
_ANY_TOKEN = re.compile(_TOKEN.pattern, re.I)
_WORD = re.compile(rf"[А-Яа-яЁёіІ0-9{MARKS}{_CUT}]*[А-Яа-яЁёіІ{_CUT}][А-Яа-яЁёіІ0-9{MARKS}{_CUT}]*(?:-[А-Яа-яЁёіІ0-9{MARKS}{_CUT}]+)*|[0-9]+")
#: Classes of words, as numbers of contexts.
NUMBER, CAPITAL, SMALL = 0, 1, 2
_LETTERS = re.compile("[А-Яа-яЁёі]+")
_PLAIN = re.compile("[а-яё]+(?:-[а-яё]+)*")
_JOIN = re.compile(rf"(?<=[А-Яа-яЁёі{MARKS}0346])([{BREAKS}])[ \t]*\n[ \t]*(?=[а-яёі{MARKS}]|(?<=[А-ЯЁ][{BREAKS}]\n)[А-ЯЁ])")
_END = re.compile(rf"([А-Яа-яЁёі0346{MARKS}]*[А-Яа-яЁёі])([{BREAKS}])[ \t]*$")
_PART = rf"[А-Яа-яЁёі0346{MARKS}]+"
_START = re.compile(rf"[ \t]*((?=[{MARKS}]?[а-яёі]|[А-ЯЁ]+(?![а-яё]))(?![а-яё]\)){_PART}(?:-{_PART})*(?:[{BREAKS}][ \t]*\n[ \t]*(?=[а-яёі]){_PART})*[^\s$|(\[]*)")
_LATIN = re.compile("[A-Za-z][А-Яа-яЁё]|[А-Яа-яЁё][A-Za-z]")
_BROKEN_NUMBER = re.compile("^[0-9ОоЗзбБ]+(?:[.,/–-][0-9ОоЗзбБ]+)*$")
_POINT = re.compile("^[0-9]+[/–-]?[а-гб]$")
#: Passes every token that glyph_token accepts.
_SUSPECT = re.compile(r"[~�□іІ]|[А-Яа-яЁё]\|[А-Яа-яЁё]|\d[А-Яа-яЁё]|[А-Яа-яЁё]\d|[ОоЗзбБ][.,/–-]\d|\d[.,/–-][ОоЗзбБ]")


def _joined(text: str) -> str:
    """Lower-case text of a scanned page in which words broken at line ends are whole; a hyphen that may be the word's own leaves a cut mark."""
    return _JOIN.sub(lambda m: _CUT if m[1] == "-" else "", _shape(text)).lower()


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts: Counter[str] = Counter()
        for text, parser in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if text:
                counts.update(_TOKEN.findall(_joined(text)) if parser == SCANNED else _PLAIN.findall(text.lower()))
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])


def count_words(pages: DataFrame) -> DataFrame:
    """word, n over all pages; a word broken at a line end by a plain hyphen has a cut mark at the break."""
    return pages.select("text", "parser").mapInArrow(_count, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def judge_breaks(counts: DataFrame) -> DataFrame:
    """cut, word, is_break of each word broken by a plain hyphen: joined, or a compound broken at its own hyphen.

    The more frequent reading holds. Where neither occurs unbroken, a first part that stands in front of hyphens
    elsewhere makes it a compound.
    """
    broken = counts.filter(F.col("word").contains(_CUT)).select(F.col("word").alias("cut"), F.translate("word", _CUT, "").alias("whole"), F.replace("word", F.lit(_CUT), F.lit("-")).alias("compound"), F.substring_index("word", _CUT, 1).alias("head"))
    plain = counts.filter(~F.col("word").contains(_CUT))
    heads = plain.filter(F.col("word").contains("-")).groupBy(F.substring_index("word", "-", 1).alias("head")).agg(F.sum("n").alias("n_head"))
    out = broken.join(plain.select(F.col("word").alias("whole"), F.col("n").alias("n_whole")), "whole", "left").join(plain.select(F.col("word").alias("compound"), F.col("n").alias("n_compound")), "compound", "left").join(heads, "head", "left")
    none = F.lit(0)
    own = (F.coalesce("n_compound", none) > F.coalesce("n_whole", none)) | (F.col("n_compound").isNull() & F.col("n_whole").isNull() & (F.coalesce("n_head", none) >= 5))
    return out.select("cut", F.when(own, F.col("compound")).otherwise(F.col("whole")).alias("word"), (~own).alias("is_break"))


def _classes() -> dict[str, str]:
    """Each glyph with the smallest of those it can be taken for, directly or over others: words that glyph edits lead to one another are equal under it."""
    names = {c: c for a, bs in GLYPHS.items() if len(a) == 1 for c in a + bs}
    for _ in names:
        for a, bs in GLYPHS.items():
            if len(a) == 1:
                least = min(names[c] for c in a + bs)
                names.update({c: least for c in a + bs})
    return names


_CLASSES = _classes()


def plausible(word: str, reading: str) -> bool:
    """Whether scanning can have made ``word`` of ``reading``: its digits, ьі and іо are wrong anyway, beside them one letter, or two in longer words."""
    plain = word.replace("ьі", "ы").replace("іо", "ю")
    if word == reading or len(plain) != len(reading):
        return False
    odd = [(a, b) for a, b in zip(plain, reading) if a != b]
    return all(b in GLYPHS.get(a, "") for a, b in odd) and sum(a.isalpha() for a, _ in odd) <= (2 if len(plain) >= 8 else 1)


def unmarked(word: str) -> list[str]:
    """What a word with one or two marks can have been: every mark is any letter. With more marks nothing in particular."""
    marks = [i for i, c in enumerate(word) if c in MARKS]
    if not 1 <= len(marks) <= 2:
        return []
    out = []
    for letters in product("абвгдежзийклмнопрстуфхцчшщъыьэюяё", repeat=len(marks)):
        chars = list(word)
        for i, c in zip(marks, letters):
            chars[i] = c
        out.append("".join(chars))
    return out


def _unmark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for w, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            made = unmarked(w)
            yield pa.RecordBatch.from_arrays([pa.array([w] * len(made), pa.string()), pa.array([n] * len(made), pa.int64()), pa.array(made, pa.string())], names=["word", "n", "reading"])


def _keep_plausible(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = [plausible(w, r) for w, r in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
        yield batch.filter(pa.array(keep, pa.bool_()))


def link_words(counts: DataFrame, breaks: DataFrame, only: DataFrame | None = None) -> DataFrame:
    """word, reading, ratio: each word (or each of the few of ``only``: word) and the more frequent words that glyph edits make of it.

    Words that edits lead to one another are equal once each glyph is replaced by its class, so they meet in an equi-join; only
    words with marks are spelt out. Whether a candidate is a link is up to the vectors (:func:`accept_links`).
    """
    plain = counts.filter(~F.col("word").contains(_CUT))
    if only is None:
        cut = counts.select(F.col("word").alias("cut"), "n").join(breaks, "cut").select("word", "n")
        every = plain.unionByName(cut).groupBy("word").agg(F.sum("n").alias("n"))
    else:
        every = only.distinct().join(plain, "word", "left").select("word", (F.coalesce("n", F.lit(0)) + 1).alias("n"))
    every = every.filter((F.length("word") >= 4) | F.col("word").rlike("[0-9і]"))
    every = every.filter(~F.col("word").rlike("^[0-9]+[а-г]$"))
    target = plain.filter(F.col("n") >= SIGN_LEAST).filter(F.col("word").rlike("^[а-яё-]+$")).select(F.col("word").alias("reading"), F.col("n").alias("n_reading"))
    key = lambda c: F.translate(F.replace(F.replace(c, F.lit("ьі"), F.lit("ы")), F.lit("іо"), F.lit("ю")), "".join(_CLASSES), "".join(_CLASSES.values()))
    marked = F.col("word").rlike(f"[{MARKS}]")
    enough = F.when(F.col("word").rlike(f"[{MARKS}0-9і]"), F.col("n_reading") >= F.col("n")).otherwise(F.col("n_reading") >= F.greatest(RATIO * F.col("n"), COMMON_RATIO * (F.col("n") - FEW)))
    near = every.filter(~marked).withColumn("key", key(F.col("word"))).join(target.withColumn("key", key(F.col("reading"))), "key").filter(enough & (F.col("word") != F.col("reading")))
    near = near.select("word", "reading", "n", "n_reading").mapInArrow(_keep_plausible, "word string, reading string, n bigint, n_reading bigint")
    spelt = every.filter(marked).mapInArrow(_unmark, "word string, n bigint, reading string").join(target, "reading").filter(enough)
    return near.unionByName(spelt.select(*near.columns)).select("word", "reading", (F.col("n_reading") / F.col("n")).alias("ratio"))


def glyph_token(token: str) -> bool:
    """Whether a token in its original case shows by its signs that a glyph was misread: a mark or a digit in a word, і for a part of ы or ю, a letter or mark in a number."""
    letters = sum(c.isalpha() for c in token)
    if letters >= 2 and not _LATIN.search(token):
        if any(c in "~�□" for c in token) or re.search(r"[А-Яа-яЁё]\|[А-Яа-яЁё]", token) or "іо" in token.lower() or "ьі" in token.lower():
            return True
        if letters >= 3 and re.search("[0346][А-Яа-яЁё]|[А-Яа-яЁё][0346]", token) and re.fullmatch(r"[А-Яа-яЁё0346-]+", token) and not re.search(r"\d-|^\d+[а-яё]$", token):
            return True
    if re.search(r"\d[~�□]\d|\d[~�□]$|^[~�□]\d{2,}", token) and letters == 0:
        return True
    return bool(_BROKEN_NUMBER.match(token) and re.search(r"\d", token) and re.search("[ОоЗзбБ]", token) and not _POINT.match(token))


def _class_of(token: str) -> int:
    """The class a suspect token should belong to."""
    if _BROKEN_NUMBER.match(token) or not any(map(str.isalpha, token)):
        return NUMBER
    return CAPITAL if token[0].isupper() else SMALL


def _occurrences(numbers, n_rows: int, starts: bool):
    """Per scanned page: occurrences that joins decide (rare or suspect words with their contexts, cut words, breaks at the page end); per task: counts of contexts.

    ``numbers``: frequent word -> row of its counts; the rows below CONTEXTS are contexts, classes first; a row from ``n_rows`` on is not counted. Contexts are
    such rows; a rare word's own class is added as CONTEXTS + class. With ``starts`` also the words that may carry on a word of
    the page before; their context are the places, counted from the end, of the lines above.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number: dict[str, int] = numbers.value
        get = number.get
        names = ["page_id", "kind", "word", "behind", "context"]
        kinds = [pa.int64(), pa.string(), pa.string(), pa.int32(), pa.list_(pa.int32())]
        counts = np.zeros(n_rows * CONTEXTS, np.int64)

        def near(ids: list[int], k: int) -> list[int]:
            return [c for c in ids[max(0, k - WINDOW) : k] + ids[k + 1 : k + 1 + WINDOW] if c < CONTEXTS]

        def numbered(tokens: list[str]) -> list[int]:
            lows = " ".join(tokens).lower().split(" ") if tokens else []
            return [i if (i := get(low)) is not None else NUMBER if low.isdigit() else CAPITAL if token[0].isupper() else SMALL for low, token in zip(lows, tokens)]

        for batch in batches:
            out: list[tuple] = []
            every: list[int] = []
            gap = [n_rows] * WINDOW
            for page_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if not text:
                    continue
                shaped = _shape(text)
                lines = [line for line in shaped.split("\n") if line.strip()]
                whole = _JOIN.sub(lambda m: _CUT if m[1] == "-" else "", shaped)
                if any(m[1] != "-" for m in _JOIN.finditer(shaped)):
                    out.append((page_id, "hyphen", None, None, None))
                for behind in range(min(1 + 2 * EDGE_LINES, len(lines))):
                    m = _END.search(lines[-1 - behind])
                    if m:
                        around = numbered(_WORD.findall(lines[-1 - behind][: m.start()])[-WINDOW:]) if starts else None
                        out.append((page_id, "end", m[1] + (_CUT if m[2] == "-" else ""), behind, around and [c for c in around if c < CONTEXTS]))
                raw = shaped.split("\n") if starts else []
                places = [i for i, line in enumerate(raw) if line.strip()]
                for above, i in enumerate(places[: 1 + 2 * EDGE_LINES]):
                    m = _START.match("\n".join(raw[i : i + 3]))
                    if m:
                        out.append((page_id, "start", m[1], len(lines) - 1 - above, [len(lines) - 1 - k for k in range(above)]))
                    if EDGE_LINES <= above < len(lines) - EDGE_LINES:
                        break  # no furniture here, so nothing below it is the first line
                signs: dict[str, int] = {}
                if _SUSPECT.search(whole):
                    parts = whole.replace(_CUT, "").split()
                    for k, part in enumerate(parts):
                        if _SUSPECT.search(part) and glyph_token(token := part.strip(".,;:!?()[]«»\"'")):
                            signs.setdefault(token, k)
                tokens = _WORD.findall(whole)
                ids = numbered(tokens)
                every += ids + gap
                for k, i in enumerate(ids):
                    if i in (CAPITAL, SMALL):
                        token = tokens[k].replace(_CUT, "")
                        out.append((page_id, "sign" if token in signs else "word", tokens[k].lower(), _class_of(token) if token in signs else None, [*near(ids, k), CONTEXTS + i]))
                        signs.pop(token, None)
                for token, k in signs.items():  # numbers with marks of their own between the figures
                    around = numbered(_WORD.findall(" ".join(parts[max(0, k - WINDOW) : k]))[-WINDOW:]) + numbered(_WORD.findall(" ".join(parts[k + 1 : k + 1 + WINDOW]))[:WINDOW])
                    out.append((page_id, "sign", token.lower(), _class_of(token), [c for c in around if c < CONTEXTS] + [CONTEXTS + _class_of(token)]))
            flat = np.array(every or [n_rows], np.int64)
            pairs = []
            for d in range(1, WINDOW + 1):
                for a, b in ((flat[:-d], flat[d:]), (flat[d:], flat[:-d])):
                    use = (a < n_rows) & (b < CONTEXTS)
                    pairs.append(a[use] * CONTEXTS + b[use])
            counts += np.bincount(np.concatenate(pairs), minlength=len(counts))
            cols = list(zip(*out)) if out else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(cols, kinds)], names=names)
        full = np.flatnonzero(counts)
        by_row = np.split(full, np.flatnonzero(np.diff(full // CONTEXTS)) + 1) if len(full) else []
        word = {i: w for w, i in number.items() if i < n_rows}
        rows = [(word.get(int(at[0] // CONTEXTS), str(int(at[0] // CONTEXTS))), np.stack([at % CONTEXTS, counts[at]], 1).ravel()) for at in by_row]
        yield pa.RecordBatch.from_arrays([pa.nulls(len(rows), kinds[0]), pa.array(["pairs"] * len(rows), kinds[1]), pa.array([w for w, _ in rows], kinds[2]), pa.array([int(at[0] // CONTEXTS) for at in by_row], kinds[3]), pa.array([p for _, p in rows], kinds[4])], names=names)

    return run


class SkipGram:
    """Vectors of words from the counts of their contexts.

    ``matrix``: counts of the contexts (columns) around each context word (rows). Its positive pointwise mutual information is factorised;
    a word's vector is its own row of that matrix, projected on the leading DIMENSIONS.
    """

    def __init__(self, matrix: np.ndarray):
        self.contexts = np.maximum(matrix.sum(0), 1)
        self.total = max(matrix.sum(), 1)
        self.axes = np.linalg.svd(np.array([self._information(row) for row in matrix]), full_matrices=False)[2][:DIMENSIONS].T
        self.share = matrix[: SMALL + 1] / np.maximum(matrix[: SMALL + 1].sum(1, keepdims=True), 1)
        self.classes = np.array([self._unit(row) for row in matrix[: SMALL + 1]])

    def _information(self, row: np.ndarray) -> np.ndarray:
        seen = np.maximum(row, 1e-12) * self.total / (max(row.sum(), 1e-12) * self.contexts)
        return np.maximum(np.log(seen), 0)

    def _unit(self, row: np.ndarray) -> np.ndarray:
        vector = self._information(row) @ self.axes
        return vector / (np.linalg.norm(vector) or 1)

    def vector(self, at: list[int], n: list[int]) -> np.ndarray:
        """Unit vector from counted contexts; those of the classes that the word's occurrences belong to are mixed in."""
        row, own = np.zeros(len(self.contexts)), np.zeros(SMALL + 1)
        for c, k in zip(at, n):
            if c < CONTEXTS:
                row[c] += k
            else:
                own[c - CONTEXTS] += k
        if own.sum():
            row = row + SHRINK * (own / own.sum()) @ self.share
        return self._unit(row)


def _vectors(model: SkipGram):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [model.vector([r["c"] for r in rows], [r["n"] for r in rows]).tolist() for rows in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.list_(pa.float64()))], names=["word", "vector"])

    return run


def _dot(a: str, b: str) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def word_vectors(contexts: DataFrame, model: SkipGram) -> DataFrame:
    """word, vector of each word of ``contexts``: word, c, n. A word has at most one row per context and class."""
    rows = contexts.groupBy("word", "c").agg(F.sum("n").alias("n")).groupBy("word").agg(F.collect_list(F.struct("c", "n")).alias("rows"))
    return rows.mapInArrow(_vectors(model), "word string, vector array<double>")


def accept_links(links: DataFrame, suspects: DataFrame, vectors: DataFrame, model: SkipGram) -> DataFrame:
    """word, reading, ratio: the links that the vectors bear out; suspect tokens (word, class) without one get a null reading if they fit their class."""
    mine, other = vectors.select("word", F.col("vector").alias("v")), vectors.select(F.col("word").alias("reading"), F.col("vector").alias("r"))
    fit = links.join(mine, "word").join(other, "reading").withColumn("fit", _dot("v", "r"))
    held = fit.filter(F.col("fit") >= F.greatest(F.lit(LEAST_FIT), MIN_FIT - SLOPE * F.log2(F.col("ratio") / RATIO))).select("word", "reading", "ratio")
    classes = F.array(*(F.array(*(F.lit(float(x)) for x in v)) for v in model.classes))
    rest = suspects.join(held, "word", "left_anti").join(mine, "word").withColumn("r", F.get(classes, F.col("class")))
    rest = rest.filter(_dot("v", "r") >= CLASS_FIT).select("word").distinct()
    return held.unionByName(rest.select("word", F.lit(None).cast("string").alias("reading"), F.lit(None).cast("double").alias("ratio")))


def _fits(model: SkipGram):
    """Of the readings of each occurrence the one whose vector fits its context best; frequent ones are preferred a little."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for page_id, word, context, options in zip(*(c.to_pylist() for c in batch.columns)):
                here = model.vector(context or [], [1] * len(context or []))
                best = max((float(here @ np.array(o["vector"])) + SLOPE * np.log2(o["ratio"]), o["reading"]) for o in options)
                out.append((page_id, word, best[1]))
            cols = list(zip(*out)) if out else [[]] * 3
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(cols, (pa.int64(), pa.string(), pa.string()))], names=["page_id", "word", "reading"])

    return run


# --- furniture -----------------------------------------------------------------------------------------------------

_OWN_NUMBER = re.compile(r"^(?![^\d]*№)(?!\s*\d+[.,;:]\s*$)[\W_]*(?:(?:с|стр|страница|лист|л|page|p|pp|sheet)[\W_]*)?(\d+)(?:[\W_]*(?:из|of|/)[\W_]*\d+)?[\W_]*$", re.I)
# Glyphs that scanning confuses share one sign in a line's key.
_FOLD = str.maketrans("еспнгвтдлцхкщшё03469ъь", "ееннтнтддцккшшеозбчзьь".replace("ц", "д"))


def line_sign(line: str) -> str:
    """What remains of a line without case, numbers and reading errors."""
    low = re.sub(r"\s+", " ", _shape(line).strip().lower()).replace("ьі", "ы").replace("іо", "ю")
    low = re.sub(r"(?<![а-яёa-z])[\doз]*\d[\doз]*(?![а-яёa-z])", "#", low)
    return low.translate(_FOLD)


_DIGIT = re.compile(r"[\dОЗ]")
_READ_DIGITS = re.compile(r"(?<![^\W\d_])[\dОоЗзбБlI|]*\d[\dОоЗзбБlI|]*(?![^\W\d_])")
_AS_DIGITS = str.maketrans("ОоЗзбБlI|", "003366111")


def is_own_number(line: str, page: int | None) -> bool:
    """Whether a line gives only the page's own number, with or without adornment or the total."""
    if page is None or not _DIGIT.search(line):
        return False
    line = _shape(line).strip()
    m = _OWN_NUMBER.match(line) or _OWN_NUMBER.match(_READ_DIGITS.sub(lambda x: x[0].translate(_AS_DIGITS), line))
    return bool(m) and len(m[1]) < 10 and int(m[1]) == page


def _signs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        pages, lines = batch.column(2).to_pylist(), batch.column(5).to_pylist()
        sign, own = pa.array([line_sign(line) for line in lines], pa.string()), pa.array([is_own_number(line, page) for line, page in zip(lines, pages)], pa.bool_())
        yield pa.RecordBatch.from_arrays([*batch.columns[:5], *batch.columns[6:], sign, own], names=["page_id", "source_id", "page", "zone", "line_no", "scanned", "behind", "sign", "own"])


def furniture(pages: DataFrame, work: Scratch) -> DataFrame:
    """page_id, line_no, noise (``running`` or ``page_number``), scanned, behind (non-empty lines below it).

    Lines of sources without any scanned page are not looked at: nothing is reported or removed there.
    """
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.coalesce("source_id", F.lit("")).alias("source_id"), F.col("page").cast("int").alias("page"), F.coalesce(F.col("parser") == SCANNED, F.lit(False)).alias("scanned"), "text")
    own = work.cut(rows.filter("scanned").select("source_id").distinct(), "sources")
    few = own.count() <= BROADCAST_SOURCES  # then texts of other sources are left out before they are split
    full = (rows.join(F.broadcast(own), "source_id", "left_semi") if few else rows).withColumn("lines", F.expr("filter(transform(split(text, '\n', -1), (x, i) -> struct(i + 1 as line_no, x as line)), x -> x.line rlike '\\\\S')"))
    spots = F.expr(f"array_union(sequence(1, least(size(lines), {EDGE_LINES})), sequence(greatest(size(lines) - {EDGE_LINES - 1}, 1), size(lines)))")
    edges = full.filter("size(lines) > 0").select("page_id", "source_id", "page", "scanned", F.size("lines").alias("size"), F.explode(F.transform(spots, lambda at: F.struct(at.alias("at"), F.get("lines", at - 1).alias("l")))).alias("e"))
    edges = (edges if few else edges.join(own, "source_id", "left_semi")).select(
        "page_id", "source_id", "page", F.when(F.col("e.at") > F.col("size") - EDGE_LINES, F.when(F.col("e.at") <= EDGE_LINES, "both").otherwise("foot")).otherwise("head").alias("zone"),
        F.col("e.l.line_no").cast("int").alias("line_no"), F.col("e.l.line").alias("line"), "scanned", (F.col("size") - F.col("e.at")).cast("int").alias("behind"),
    )
    edges = work.cut(edges.mapInArrow(_signs, "page_id bigint, source_id string, page int, zone string, line_no int, scanned boolean, behind int, sign string, own boolean"), "edges")
    size = rows.select("source_id", "page").groupBy("source_id").agg(F.countDistinct("page").alias("n_pages")).filter(F.col("n_pages") >= RUN_PAGES)
    lines = edges.filter("not own").filter(F.length(F.regexp_replace("sign", "[^\\p{L}]", "")) >= 3).join(size, "source_id")
    lines = lines.withColumn("zone", F.explode(F.when(F.col("zone") == "both", F.array(F.lit("head"), F.lit("foot"))).otherwise(F.array("zone"))))
    exact = lines.groupBy("source_id", "n_pages", "zone", "sign").agg(F.countDistinct("page").alias("n"))
    # reading errors that the sign does not fold are few, so a running line's plain form alone is near the threshold
    form = exact.filter(F.col("n") >= F.col("n_pages") * RUN_SHARE * 0.6).select(F.col("source_id").alias("s"), F.col("zone").alias("z"), F.col("sign").alias("form"))
    like = lines.join(form, (F.col("source_id") == F.col("s")) & (F.col("zone") == F.col("z")))
    like = like.filter((F.abs(F.length("sign") - F.length("form")) <= 4) & (F.levenshtein("sign", "form") <= F.least(F.lit(4), F.length("form") / 6)))
    total = like.groupBy("s", "z", "form", "n_pages").agg(F.countDistinct("page").alias("n")).filter(F.col("n") >= F.col("n_pages") * RUN_SHARE).select("s", "z", "form")
    running = like.join(total, ["s", "z", "form"], "left_semi").select("page_id", "line_no", F.lit("running").alias("noise"), "scanned", "behind")
    return running.unionByName(edges.filter("own").select("page_id", "line_no", F.lit("page_number").alias("noise"), "scanned", "behind")).distinct()


# --- results -------------------------------------------------------------------------------------------------------


def _carry(pages: DataFrame, seen: DataFrame, ends: DataFrame, below: DataFrame) -> DataFrame:
    """page_id, cut, context, next_id, lead: words broken at the end of a scanned page, and their rest at the head of each delivery of the scanned page behind it."""
    ids = pages.filter(F.col("parser") == SCANNED).filter("page_id is not null and source_id is not null and page is not null")
    ids = ids.select(F.col("page_id").cast("bigint").alias("page_id"), "source_id", F.col("page").cast("int").alias("page")).distinct()
    ends = ends.filter("not array_contains(coalesce(gone, array()), behind)").dropDuplicates(["page_id"])
    ends = ends.join(ids, "page_id").select("page_id", "source_id", (F.col("page") + 1).alias("page"), F.col("word").alias("head"), "context")
    after = ids.join(ends.select("source_id", "page").distinct(), ["source_id", "page"], "left_semi")
    starts = seen.filter("kind = 'start'").join(after, "page_id").join(below, "page_id", "left")
    starts = starts.filter("not array_contains(coalesce(gone, array()), behind) and size(array_except(context, coalesce(gone, array()))) = 0")
    starts = starts.select("source_id", "page", F.col("page_id").alias("next_id"), F.col("word").alias("lead"))
    pairs = ends.join(starts, ["source_id", "page"]).filter(~F.col("lead").rlike("^[А-ЯЁ]") | F.col("head").rlike(f"[А-ЯЁ]{_CUT}?$"))
    rest = F.regexp_extract(F.regexp_replace("lead", rf"[{BREAKS}][ \t]*\n[ \t]*", ""), f"^{_PART}", 0)
    return pairs.select("page_id", F.lower(F.concat("head", rest)).alias("cut"), "context", "next_id", "lead")


def _numbered(counts: DataFrame, links: DataFrame) -> tuple[dict[str, int], int]:
    """Row of each of the at most SKIP_WORDS most frequent words without links, and the number of rows: contexts, then other words that are linked to; the rest has the number of rows itself."""
    aim = links.select(F.col("reading").alias("word"), F.lit(True).alias("aim")).distinct()
    common = counts.filter(F.col("n") >= MIN_COUNT).filter(~F.col("word").contains(_CUT)).join(links, "word", "left_anti").join(aim, "word", "left")
    words = common.select("word", "n", F.coalesce("aim", F.lit(False)).alias("aim")).orderBy(F.desc("n"), "word").limit(SKIP_WORDS).collect()
    first = SMALL + 1
    out = {r.word: i for i, r in enumerate(words[: CONTEXTS - first], first)}
    rows = max(CONTEXTS, first + len(out))
    for r in words[CONTEXTS - first :]:
        if r.aim:
            out[r.word] = rows
            rows += 1
    return {r.word: out.get(r.word, rows) for r in words}, rows


def _matrix(pairs: DataFrame) -> np.ndarray:
    """Counts of contexts around contexts; the aggregate has at most CONTEXTS x CONTEXTS rows, whatever the corpus."""
    cells = pairs.filter(F.col("behind") < CONTEXTS).select(F.col("behind").alias("a"), "c", "n").groupBy("a", "c").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros((CONTEXTS, CONTEXTS))
    out[cells["a"].to_numpy(), cells["c"].to_numpy()] = cells["n"].to_numpy()
    return out


def _analyse(pages: DataFrame, carry: bool = False) -> dict[str, DataFrame]:
    work = Scratch(pages.sparkSession, "scans")
    spark = pages.sparkSession
    scanned = pages.filter(F.col("parser") == SCANNED).filter("page_id is not null")
    counts = work.cut(count_words(pages), "counts")
    breaks = work.cut(judge_breaks(counts), "breaks")
    links = work.cut(link_words(counts, breaks), "links")
    numbers, n_rows = _numbered(counts, links)
    seen = scanned.select(F.col("page_id").cast("bigint").alias("page_id"), "text").mapInArrow(_occurrences(spark.sparkContext.broadcast(numbers), n_rows, carry), "page_id bigint, kind string, word string, behind int, context array<int>")
    seen = work.cut(seen, "seen")
    lines = work.cut(furniture(pages, work), "furniture")
    below = lines.groupBy("page_id").agg(F.collect_set("behind").alias("gone"))
    ends = seen.filter("kind = 'end'").join(below, "page_id", "left")
    clear = (F.col("behind") == 0) | F.expr("size(array_except(sequence(0, greatest(behind - 1, 0)), coalesce(gone, array()))) = 0")

    words = seen.filter("kind in ('word', 'sign')").select("page_id", F.col("word").alias("cut"), "context", F.when(F.col("kind") == "sign", F.col("behind")).alias("class"))
    words = words.join(breaks, "cut", "left").withColumn("word", F.coalesce("word", "cut"))
    parts = {}
    if carry:
        pairs = work.cut(_carry(pages, seen, ends.filter(clear), below), "carried")
        judged = judge_breaks(counts.filter(~F.col("word").contains(_CUT)).unionByName(pairs.select(F.col("cut").alias("word"), F.lit(1).cast("bigint").alias("n")).distinct()))
        over = work.cut(pairs.select("page_id", "cut", "context").distinct().join(judged, "cut", "left").withColumn("word", F.coalesce("word", "cut")).withColumn("class", F.lit(None).cast("int")), "over")
        links = work.cut(links.unionByName(link_words(counts, breaks, over.select("word"))).groupBy("word", "reading").agg(F.max("ratio").alias("ratio")), "links")
        words = words.unionByName(over.select(*words.columns))
        parts = {"tails": pairs.groupBy("page_id").agg(F.mode("lead", True).alias("tail")), "leads": pairs.groupBy(F.col("next_id").alias("page_id")).agg(F.min("lead").alias("lead"))}

    cells = F.expr("transform(sequence(0, div(size(context), 2) - 1), i -> struct(context[2 * i] as c, cast(context[2 * i + 1] as bigint) as n))")
    pairs = seen.filter("kind = 'pairs'").select("word", "behind", F.explode(cells).alias("p")).select("word", "behind", "p.c", "p.n")
    model = SkipGram(_matrix(pairs))
    suspects = words.filter("class is not null").select("word", "class").distinct()
    needed = links.select("word").unionByName(links.select(F.col("reading").alias("word"))).unionByName(suspects.select("word")).distinct()
    around = pairs.select("word", "c", "n").unionByName(words.select("word", F.explode("context").alias("c")).groupBy("word", "c").agg(F.count("*").alias("n")))
    vectors = work.cut(word_vectors(around.join(needed, "word", "left_semi"), model), "vectors")
    held = work.cut(accept_links(links, suspects, vectors, model), "held")
    if carry:
        options = held.filter("reading is not null").join(vectors.select(F.col("word").alias("reading"), "vector"), "reading").groupBy("word").agg(F.collect_list(F.struct("reading", "ratio", "vector")).alias("options"))
        # a word has at most as many options as plausible readings
        parts["fixes"] = work.cut(words.join(options, "word").select("page_id", "word", "context", "options").mapInArrow(_fits(model), "page_id bigint, word string, reading string"), "fixes")
    glyph = words.join(held.select("word").distinct(), "word", "left_semi").select("page_id")

    heads = counts.filter(F.col("word").rlike("^[а-яё]+-")).groupBy(F.concat(F.substring_index("word", "-", 1), F.lit(_CUT)).alias("word")).agg(F.sum("n").alias("n_head"))
    ends = ends.filter(clear).withColumn("word", F.lower("word")).join(heads, "word", "left").filter("coalesce(n_head, 0) < 5").select("page_id")
    broken = words.filter("is_break").select("page_id").unionByName(seen.filter("kind = 'hyphen'").select("page_id")).unionByName(ends)
    return {"hyphen": broken, "glyph": glyph, "lines": lines, "words": words, **parts}


def found_noise(pages: DataFrame) -> DataFrame:
    """page_id, noise of each scanned page: ``hyphen``, ``glyph``, ``running``, ``page_number``.

    Null and empty texts have none; a page without a number has no page number line; pages without a source make one
    source; repeated deliveries are each reported; rows without a page_id and other parsers are not reported,
    though their words and lines count; extra columns are not read.
    """
    parts = _analyse(pages)
    out = parts["lines"].filter("scanned and page_id is not null").select("page_id", "noise")
    for noise in ("hyphen", "glyph"):
        out = out.unionByName(parts[noise].select("page_id", F.lit(noise).alias("noise")))
    return out.distinct()


def _mend(text: str, gone: set[int], fixes: dict[str, str], compounds: set[str], lead: str | None = None, tail: str | None = None) -> str:
    """The page without its furniture, words whole and corrected, each paragraph on one line.

    ``lead``: its first word, which belongs to the page before; ``tail``: the rest of its last word, from the page behind.
    """
    lines = [line for i, line in enumerate(_shape(text).split("\n")) if i + 1 not in gone]
    text = "\n".join(lines)
    if lead is not None:
        text = text.lstrip().removeprefix(lead).lstrip(" \t").removeprefix("\n")
    if tail is not None:
        text = f"{text.rstrip()}\n{tail}"

    def join(m: re.Match) -> str:
        if m[1] != "-":
            return ""
        at = m.start()
        while at and _LETTERS.match(text, at - 1):
            at -= 1
        right = _LETTERS.match(text, m.end())
        both = f"{text[at : m.start()]}-{right[0] if right else ''}".lower()
        return "-" if both in compounds else ""

    text = _JOIN.sub(join, text)

    def correct(m: re.Match) -> str:
        right = fixes.get(m[0].lower())
        if right is None:
            return m[0]
        first = next((c for c in m[0] if c.isalpha()), "")
        return right.upper() if m[0].isupper() and len(m[0]) > 1 else right[:1].upper() + right[1:] if first.isupper() else right

    if fixes:
        text = _ANY_TOKEN.sub(correct, text)
    text = re.sub("(?<=[0-9])[Оо](?=[0-9.,])|(?<=[0-9])О\\b|\\bО(?=[0-9])", "0", text)
    text = re.sub("(?<=[0-9])[Зз](?=[0-9.,])|(?<=[0-9])З\\b|\\bЗ(?=[0-9])", "3", text)
    flowed: list[str] = []
    for line in text.split("\n"):
        line = line.rstrip()
        starts = not line.strip() or not flowed or not flowed[-1].strip() or re.match(r"\s{2,}|\s*(?:\d+(?:\.\d+)*[.)]?\s+[А-ЯЁA-Z]|\d+\)\s|[-•*]\s|\||\$\$|\[)", line)
        if starts or flowed[-1].rstrip().endswith(("|", "$$", "]")) or (flowed[-1].rstrip().endswith((".", ";", ":")) and len(flowed[-1]) < 45 and line.strip()[:1].isupper()):
            flowed.append(line.strip())
        else:
            flowed[-1] = f"{flowed[-1].rstrip()} {line.strip()}"
    return re.sub(r"\n{3,}", "\n\n", "\n".join(flowed)).strip("\n")


def repaired(pages: DataFrame) -> DataFrame:
    """page_id, text: every scanned page as continuous paragraphs; other pages, null and empty texts as they are.

    A word broken at the page end stands whole on the page where it begins, with the punctuation behind it. Its rest is the first word
    of the page with the next number, if that is a scanned page of the same source; otherwise the break stays. Where deliveries of that page
    differ, the rest that most of them have counts, and each gives its own away. Paragraphs that run over the page end
    stay on their two pages.
    """
    parts = _analyse(pages, carry=True)
    gone = parts["lines"].groupBy("page_id").agg(F.collect_set("line_no").alias("gone"))
    fixes = parts["fixes"].groupBy("page_id", "word").agg(F.min("reading").alias("reading"))
    fixes = fixes.groupBy("page_id").agg(F.map_from_entries(F.collect_list(F.struct("word", "reading"))).alias("fixes"))
    own = parts["words"].filter("not is_break").groupBy("page_id").agg(F.collect_set("word").alias("own"))
    rows = pages.select("page_id", "text", "parser").join(gone, "page_id", "left").join(fixes, "page_id", "left").join(own, "page_id", "left").join(parts["leads"], "page_id", "left").join(parts["tails"], "page_id", "left")

    def run(batches):
        for batch in batches:
            texts = [
                _mend(text, set(g or ()), dict(f or ()), set(o or ()), lead, tail) if text and parser == SCANNED else text
                for _, text, parser, g, f, o, lead, tail in zip(*(c.to_pylist() for c in batch.columns))
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["page_id", "text"])

    return rows.mapInArrow(run, "page_id bigint, text string")
