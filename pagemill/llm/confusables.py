"""Visually identical text with different characters.

The skeleton of a text: decompose it, replace every character by its prototype from the look-alike table, decompose
again. Originals, the words and pieces of text that may be stored in an unusual way, are grouped by equal skeleton together with
the corpus' plain words. The group tells how an original is written: a mixed word takes the spelling of its dominant plain
member; a word wholly in another script is judged by the counts of both spellings or, where it stands alone, by the
language model of the other script. The forms of a page are what sets its originals apart from their right spelling.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemill.llm import charmodel
from pagemill.llm.garbled import garbled_tokens
from pagemill.storage import Scratch

# Letters of three scripts that look alike, by prototype (Latin, Cyrillic, Greek; "-" where a script has none).
LOOK_ALIKE = """
A А Α, B В Β, C С Ϲ, E Е Ε, H Н Η, I І Ι, J Ј Ϳ, K К Κ, M М Μ, N - Ν, O О Ο, P Р Ρ, S Ѕ -, T Т Τ, X Х Χ, Y У Υ, Z - Ζ,
a а α, c с ϲ, d ԁ -, e е -, h һ -, i і ι, j ј ϳ, k к κ, o о ο, p р ρ, q ԛ -, s ѕ -, u - υ, v ѵ ν, w ԝ -, x х χ, y у γ
"""
LATIN, CYRILLIC, GREEK = 0, 1, 2
_ROWS = [row.split() for row in LOOK_ALIKE.replace("\n", " ").split(",")]
#: Script -> script -> letter -> letter.
TO = {(a, b): {r[a]: r[b] for r in _ROWS if r[a] != "-" and r[b] != "-"} for a in range(3) for b in range(3) if a != b}
PROTOTYPE = str.maketrans({r[k]: r[0] for r in _ROWS for k in (1, 2) if r[k] != "-"})

#: Share of all pages from which a Latin or Greek word that could also be Cyrillic counts as a word of its own, and the standard deviations by which its count must be above it.
GENUINE_SHARE, CERTAIN = 0.005, 2.0
#: Times as often as the other original that a group's dominant original must stand.
DOMINANT = 20
#: Mean log-probability from which letters read as a Cyrillic word.
CYRILLIC_SCORE = -3.6

# Invisible characters besides those of category Cf, and ordinary signs that are compatibility characters.
INVISIBLE = "͏ᅟᅠ឴឵ㅤﾠ" + "".join(map(chr, range(0xFE00, 0xFE10)))
ORDINARY = "№°µ…½¼¾²³¹™"

_RARE = re.compile(r"[^\x00-\x7fА-яЁё«»—–№°²³]")
_RUN = re.compile(r"(?:[^\W\d_]|[̀-ͯ])+")
_MIXED = re.compile(r"[A-Za-zͰ-Ͽ][А-Яа-яЁёЀ-џԀ-ԯ]|[А-Яа-яЁёЀ-џԀ-ԯ][A-Za-zͰ-Ͽ]|[A-Za-z][Ͱ-Ͽ]|[Ͱ-Ͽ][A-Za-z]")
_LATIN_WHOLE = re.compile("(?<![^\\W\\d_])[" + "".join(TO[LATIN, CYRILLIC]) + "]{2,}(?![^\\W\\d_])")
_GREEK_WHOLE = re.compile("(?<![^\\W\\d_])[" + "".join(TO[GREEK, CYRILLIC]) + "]{2,}(?![^\\W\\d_])")
_CYRILLIC_WHOLE = re.compile("(?<![^\\W\\d_])[" + "".join(TO[CYRILLIC, LATIN]) + "]{2,}(?![^\\W\\d_])")
_TOKEN = re.compile(r"[^ \n\t\r]+")
_FORMULA = re.compile(r"\$\$.*?\$\$", re.S)


@lru_cache(maxsize=100_000)
def kind(char: str) -> str | None:
    """The form of a single character, null if it is ordinary: ``full_width``, ``zero_width``, ``no_break_space``, ``mark``."""
    category = unicodedata.category(char)
    if category == "Cf" or char in INVISIBLE:
        return "zero_width"
    if category == "Zs" and char != " ":
        return "no_break_space"
    if category in ("Mn", "Mc"):
        return "mark"
    if char in ORDINARY:
        return None
    tag = unicodedata.decomposition(char).partition(" ")[0]
    if tag in ("<wide>", "<narrow>", "<font>", "<circle>", "<square>") or (tag == "<compat>" and (0xFB00 <= ord(char) <= 0xFB4F or 0x132 <= ord(char) <= 0x133 or 0x1C4 <= ord(char) <= 0x1F3)):
        return "full_width"
    return None


def script(char: str) -> int | None:
    code = ord(char)
    if code < 0x80 or 0xC0 <= code < 0x250:
        return LATIN
    if 0x400 <= code < 0x530:
        return CYRILLIC
    return GREEK if 0x370 <= code < 0x400 else None


@lru_cache(maxsize=100_000)
def _plain(char: str) -> str:
    k = kind(char)
    return "" if k == "zero_width" else " " if k == "no_break_space" else unicodedata.normalize("NFKC", char) if k == "full_width" else char


def _shape(text: str) -> str:
    """Compatibility forms to plain characters, invisible ones out, every space the ordinary one, accents composed."""
    return unicodedata.normalize("NFC", _RARE.sub(lambda m: _plain(m[0]), text)) if _RARE.search(text) else text


def skeleton(text: str) -> str:
    """Equal for texts that look the same."""
    plain = unicodedata.normalize("NFD", _shape(text)).translate(PROTOTYPE)
    return unicodedata.normalize("NFD", plain)


def _own_script(word: str) -> int | None:
    """The script a mixed word is written with: that of its letters without a look-alike, else that of most letters; null if nothing in it is a look-alike."""
    scripts = [script(c) for c in word]
    best = None
    for own in {s for s in scripts if s is not None}:
        odd = [c for c, s in zip(word, scripts) if s is not None and s != own]
        if odd and all(c in TO[script(c), own] for c in odd) and (best is None or len(odd) < best[0]):
            best = (len(odd), own)
    return None if best is None else best[1]


def to_script(word: str, own: int) -> str:
    return "".join(c if script(c) in (own, None) else TO[script(c), own].get(c, c) for c in word)


def _blank(text: str, tokens: set[str]) -> str:
    """The text with garbled tokens, which are no cases here, blanked out."""
    return _TOKEN.sub(lambda m: " " if m[0] in tokens else m[0], text) if tokens else text


def originals(text: str) -> set[str]:
    """What on a page may be stored with unusual characters: pieces between blanks that hold some, and words of mixed scripts or of look-alikes only."""
    text = _blank(text, garbled_tokens(text))
    out: set[str] = set()
    if any(kind(c) for c in set(_RARE.findall(text))):
        out = {t for t in set(_TOKEN.findall(text)) if any(kind(c) for c in _RARE.findall(t))}
        text = _shape(text)
    if _MIXED.search(text):
        out.update(m[0] for m in _RUN.finditer(text) if _MIXED.search(m[0]))
    plain = _FORMULA.sub(" ", text)
    return out.union(_LATIN_WHOLE.findall(plain), _CYRILLIC_WHOLE.findall(plain), _GREEK_WHOLE.findall(plain))


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, found = [], []
        for page_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            mine = originals(text) if text else ()
            ids += [page_id] * len(mine)
            found += mine
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(found, pa.string())], names=["page_id", "original"])


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words of each original in plain characters, with their skeletons."""
    for batch in batches:
        rows = [(o, w, skeleton(w)) for o in batch.column(0).to_pylist() for w in set(_RUN.findall(_shape(o)))]
        yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.string()) for c in (zip(*rows) if rows else [[]] * 3)], names=["original", "word", "skeleton"])


def _plain_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words of one script, with skeleton and script."""
    for batch in batches:
        rows = []
        for w, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            scripts = {script(c) for c in w}
            if len(scripts) == 1 and None not in scripts:
                rows.append((skeleton(w), w, scripts.pop(), n))
        kinds = (pa.string(), pa.string(), pa.int32(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*rows) if rows else [[]] * 4, kinds)], names=["skeleton", "word", "script", "n"])


def _spelling(word: str, group: dict[int, tuple[str, int]], genuine: int, cond: list[list[float]]) -> str:
    """The right spelling of a word by the plain members of its group (script -> word, count)."""
    scripts = {s for s in map(script, word) if s is not None}
    if len(scripts) > 1:
        ways = {s: to_script(word, s) for s in scripts}
        known = [(n, w) for s, (w, n) in group.items() if ways.get(s) == w]
        if known:
            return max(known)[1]
        own = _own_script(word)
        return word if own is None else to_script(word, own)
    if len(scripts) != 1 or len(word) < 2:
        return word
    own = scripts.pop()
    a, b = group.get(own, ("", 0))[1], group.get(CYRILLIC, ("", 0))[1]
    if own in (LATIN, GREEK) and all(c in TO[own, CYRILLIC] for c in word) and a - CERTAIN * a**0.5 < genuine and (b or len(word) >= 3):
        right = to_script(word, CYRILLIC)
        low = right.lower()
        if b and b >= DOMINANT * a or len(word) >= 3 and set(low) <= set(charmodel.LETTERS) and charmodel.mean_score(low, cond) > CYRILLIC_SCORE:
            return right
    latin = group.get(LATIN, ("", 0))[1]
    if own == CYRILLIC and all(c in TO[CYRILLIC, LATIN] for c in word) and latin - CERTAIN * latin**0.5 >= genuine and latin >= DOMINANT * a:
        return to_script(word, LATIN)
    return word


def _judge(genuine: float, cond: list[list[float]]):
    """original, right, forms of each original that is not as it should be."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for original, runs in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                groups: dict[str, dict[int, tuple[str, int]]] = {}
                for r in runs:
                    group = groups.setdefault(r["word"], {})
                    if r["script"] is not None:
                        group[r["script"]] = (r["plain"], r["n"])
                plain = _shape(original)
                right = _RUN.sub(lambda m: _spelling(m[0], groups.get(m[0], {}), genuine, cond), plain)
                kinds = {k for c in set(_RARE.findall(original)) if (k := kind(c))}
                forms = kinds - {"mark"} | ({"look_alike"} if right != plain else set())
                if "mark" in kinds and len(unicodedata.normalize("NFC", original)) < len(unicodedata.normalize("NFD", original)) and unicodedata.normalize("NFC", original) != original:
                    forms.add("combining")
                if right != original:
                    rows.append((original, right, sorted(forms)))
            kinds_ = (pa.string(), pa.string(), pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*rows) if rows else [[]] * 3, kinds_)], names=["original", "right", "forms"])

    return run


def judge_groups(counts: DataFrame, words: DataFrame, n_pages: int, bigrams: np.ndarray) -> DataFrame:
    """original, right, forms of the originals (``counts``: original, n pages) that differ from their right spelling.

    ``words``: word, n of the corpus. Groups have at most one plain member per script; a word of look-alikes only counts by its pages.
    """
    runs = counts.select("original").mapInArrow(_runs, "original string, word string, skeleton string")
    whole = F.col("original").rlike(f"^(?:[{''.join(TO[LATIN, CYRILLIC])}]+|[{''.join(TO[CYRILLIC, LATIN])}]+|[{''.join(TO[GREEK, CYRILLIC])}]+)$")
    plain = counts.filter(whole).select(F.col("original").alias("word"), "n").unionByName(words.filter(~F.expr("length(word) = 1")).select("word", "n").join(counts.filter(whole).select(F.col("original").alias("word")), "word", "left_anti"))
    plain = plain.mapInArrow(_plain_words, "skeleton string, word string, script int, n bigint")
    plain = plain.groupBy("skeleton", "script").agg(F.max_by("word", F.struct("n", "word")).alias("plain"), F.max("n").alias("n"))
    grouped = runs.join(plain, "skeleton", "left").groupBy("original").agg(F.collect_list(F.struct("word", "script", "plain", "n")).alias("runs"))
    rest = counts.select("original").join(grouped, "original", "left").select("original", F.coalesce("runs", F.array().cast("array<struct<word:string,script:int,plain:string,n:bigint>>")).alias("runs"))
    return rest.mapInArrow(_judge(GENUINE_SHARE * n_pages, charmodel.conditional(bigrams)), "original string, right string, forms array<string>")


def _spellings(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The originals of each page (page_id, original), and those to be put right (original, right, forms)."""
    work = Scratch(pages.sparkSession, "confusables")
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "text")
    scan = work.cut(rows.mapInArrow(_scan, "page_id bigint, original string"), "scan")
    words = work.cut(charmodel.word_counts(pages), "words")
    counts = scan.groupBy("original").agg(F.count("*").alias("n"))
    return scan, work.cut(judge_groups(counts, words, pages.count(), charmodel.letter_bigrams(words)), "wrong")


def found_forms(pages: DataFrame) -> DataFrame:
    """page_id, form: the kinds of difference on each page.

    Null and empty texts and rows without a page_id have none; a repeated row adds nothing; extra columns are not read. Single
    letters are not judged: as units and designations they stand in any script.
    """
    scan, wrong = _spellings(pages)
    return scan.join(wrong, "original").select("page_id", F.explode("forms").alias("form")).filter("page_id is not null").distinct()


def normal_form(text: str, right: dict[str, str]) -> str:
    """The page in its one form; ``right``: originals -> their right spelling."""
    if not right and unicodedata.is_normalized("NFC", text) and not any(kind(c) for c in set(_RARE.findall(text))):
        return text
    bad = garbled_tokens(text)

    def token(m: re.Match) -> str:
        if m[0] in bad or m[0] in right:
            return right.get(m[0], m[0])
        return _RUN.sub(lambda r: right.get(r[0], r[0]), _shape(m[0]))

    return _TOKEN.sub(token, text)


def normalized(pages: DataFrame) -> DataFrame:
    """page_id, text in one consistent form, skeleton_key of the form; null texts stay null."""
    scan, wrong = _spellings(pages)
    fixes = scan.join(wrong, "original").groupBy("page_id").agg(F.map_from_entries(F.collect_set(F.struct("original", "right"))).alias("fixes"))
    rows = pages.select("page_id", "text").join(fixes, "page_id", "left")

    def run(batches):
        for batch in batches:
            texts = [None if t is None else normal_form(t, dict(f or ())) for t, f in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string()), pa.array([None if t is None else skeleton(t) for t in texts], pa.string())], names=["page_id", "text", "skeleton"])

    return rows.mapInArrow(run, "page_id bigint, text string, skeleton string").select("page_id", "text", F.md5("skeleton").alias("skeleton_key"))
