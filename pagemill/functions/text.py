"""Text rules as Column expressions: all run inside the JVM, without Python workers.

Null in, null out, unless a docstring says otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagemill.functions import patterns as P
from pagemill.functions.patterns import rx

_LINE_ENDS = "\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85  ]"


def strip(text: Column) -> Column:
    """White space off both ends, as Unicode and the separators U+001C-U+001F define it."""
    return F.regexp_replace(text, rx(r"^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+\z"), "")


def squeeze(text: Column) -> Column:
    """White-space runs as one blank, ends cut."""
    return strip(F.regexp_replace(text, rx(r"[\s\x1c-\x1f]+"), " "))


def split_lines(text: Column) -> Column:
    """Lines by any line end; no empty line behind a final one."""
    parts = F.split(text, _LINE_ENDS, -1)
    return F.when(F.element_at(parts, -1) == "", F.slice(parts, F.lit(1), F.greatest(F.size(parts) - 1, F.lit(0)))).otherwise(parts)


def full_lines(text: Column, separator: str = "\n") -> Column:
    """Stripped lines that are not empty."""
    parts = split_lines(text) if separator != "\n" else F.split(text, "\n", -1)
    return F.filter(F.transform(parts, strip), lambda s: s != "")


def bind(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def has(text: Column, pattern: str) -> Column:
    return F.coalesce(text.rlike(rx(pattern)), F.lit(False))


def starts(text: Column, pattern: str) -> Column:
    return has(text, rf"\A(?:{pattern})")


# --- clean-up ------------------------------------------------------------------------------------------------------


def normalize_ocr(text: Column) -> Column:
    """``12, Слово`` -> ``12. Слово`` at line starts, no white space before ``,.;:``, and legal citations in one form."""
    cite = rf"(?i)({P.LEGAL_COLLECTION}[^.\n]{{0,220}}),\s*"
    text = F.regexp_replace(text, rx(rf"(?m)^(\d{{1,3}}),\s+([{P.LETTER}])"), "$1. $2")
    text = F.regexp_replace(text, rx(r"\s+([,.;:])"), "$1")
    text = F.regexp_replace(text, rx(cite + r"с\.\s*N\s*(\d+),\s*(\d+)"), "$1, N $2, ст.$3")
    return F.regexp_replace(text, rx(cite + r"N\s*(\d+),\s*(\d+)"), "$1, N $2, ст.$3")


def break_points(text: Column) -> Column:
    """A line break in front of numbered points behind ``. ; :``, and of lettered ones behind a colon."""
    text = F.regexp_replace(text, rx(rf"(?<!\n)([.;:])\s+(\d{{1,3}}[.)]\s+[{P.LETTER}])"), "$1\n$2")
    return F.regexp_replace(text, rx(rf"(?<!\n)(:)\s+([{P.LETTER}][.)]\s+[{P.LETTER}])"), "$1\n$2")


def join_hyphens(text: Column) -> Column:
    """Words broken at a line end by a hyphen, joined."""
    return F.regexp_replace(text, rx(rf"(?<=[{P.LETTER}])-\s*\n\s*(?=[{P.LETTER}])"), "")


def join_page_hyphens(text: Column) -> Column:
    """Words of a whole page broken by a hyphen and any white space, at a line end or where lines were put together, joined."""
    return F.regexp_replace(text, rx(rf"(?<=[{P.LETTER}])-\s+(?=[{P.LETTER}])"), "")


def clean_page(text: Column) -> Column:
    """A page as it leaves recognition: broken words joined, then controls cleaned."""
    return clean_controls(join_page_hyphens(text))


def collapse_newlines(text: Column) -> Column:
    """At most one empty line in a row; ends cut."""
    return strip(F.regexp_replace(text, "\n{3,}", "\n\n"))


def drop_table_label(text: Column) -> Column:
    return F.regexp_replace(strip(text), rx(rf"\A{P.TABLE_LABEL}"), "")


def clean_controls(text: Column) -> Column:
    """Replacement characters and control characters but tab and line feed to blanks, runs of two or more blanks and tabs as one blank, ends cut."""
    text = F.regexp_replace(text, "[�\\x00-\\x08\\x0b-\\x1f\\x7f]", " ")
    return strip(F.regexp_replace(text, "[ \\t]{2,}", " "))


def bullets(text: Column) -> Column:
    """Symbol-font bullets to ``•``."""
    return F.translate(text, "", "••")


def unbold(text: Column) -> Column:
    return F.regexp_replace(text, r"\*\*([^*]*)\*\*", "$1")


def tidy_paragraphs(text: Column) -> Column:
    """Lines stripped, replacement characters to blanks, empty paragraphs out."""
    parts = F.filter(F.transform(F.split(F.replace(text, F.lit("�"), F.lit(" ")), "\n", -1), strip), lambda s: s != "")
    return F.array_join(parts, "\n")


def line_key(line: Column) -> Column:
    """What counts as the same running line: white space squeezed, lower case."""
    return F.lower(squeeze(line))


def valid_utf8(binary: Column) -> Column:
    """Invalid bytes replaced by U+FFFD."""
    return F.make_valid_utf8(binary)


def cell_text(value: Column) -> Column:
    """A table cell as markdown: line ends to blanks, pipes escaped, ends cut; null gives an empty cell."""
    text = F.regexp_replace(F.coalesce(value.cast("string"), F.lit("")), "\r\n|\r|\n", " ")
    return strip(F.replace(text, F.lit("|"), F.lit("\\|")))


# cp1251 glyphs of the bytes 80-FF: built from the code page; byte 98 has none.
_BYTES = [b for b in range(0x80, 0x100) if b != 0x98]
_AS_LATIN = "".join(map(chr, _BYTES))
_AS_1251 = bytes(_BYTES).decode("cp1251")


def decode_bytes(binary: Column) -> Column:
    """Text of raw bytes: UTF-8 (without its mark) where they are valid, else cp1251, the code page of old Cyrillic files; null and empty stay so."""
    old = F.translate(F.decode(binary, "ISO-8859-1"), _AS_LATIN, _AS_1251)
    return F.when(F.is_valid_utf8(binary.cast("string")), F.regexp_replace(F.decode(binary, "UTF-8"), "^\ufeff", "")).otherwise(old)


def is_mojibake(token: Column) -> Column:
    """No character of the Cyrillic block, but letters of U+00C0-U+00FF."""
    return ~has(token, "[Ѐ-ӿ]") & has(token, "[À-ÿ]")


def repair_token(token: Column) -> Column:
    """Latin-1 read as cp1251 if all of the token allows it and Cyrillic appears; else the token as it is."""
    fixed = F.translate(token, _AS_LATIN, _AS_1251)
    whole = ~token.rlike("[^\\x00-\\xff]") & ~token.contains("\x98")
    return F.when(is_mojibake(token) & whole & has(fixed, "[Ѐ-ӿ]"), fixed).otherwise(token)


def repair_text(text: Column) -> Column:
    """:func:`repair_token` on every blank-separated token."""
    return F.array_join(F.transform(F.split(text, " ", -1), repair_token), " ")


def repair_words(text: Column) -> Column:
    """:func:`repair_token` on every token between white space of any kind, which stays as it is."""
    parts = F.regexp_extract_all(text, F.lit(rx(r"\s+|\S+")), F.lit(0))
    return F.array_join(F.transform(parts, repair_token), "")


def readability(text: Column) -> tuple[Column, Column]:
    """Share of Cyrillic letters among letters, and of odd tokens (four word characters up, no vowel) among tokens.

    A text without letters has (0, 1). Upper-case Cyrillic vowels do not count as vowels.
    """
    letters = F.coalesce(F.regexp_count(text, F.lit(f"[{P.LETTER}]")), F.lit(0))
    cyrillic = F.regexp_count(text, F.lit("[а-яА-ЯёЁ]"))
    tokens = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(rx(r"\S+")), F.lit(0))
    cores = F.transform(tokens, lambda t: F.regexp_replace(t, r"[^\p{L}\p{N}_]", ""))
    odd = F.size(F.filter(cores, lambda c: (F.length(c) >= 4) & ~c.rlike("[аеёиоуыэюяAEIOUYaeiouy]")))
    return F.when(letters == 0, 0.0).otherwise(cyrillic / letters), F.when(letters == 0, 1.0).otherwise(odd / F.greatest(F.size(tokens), F.lit(1)))


# --- predicates ----------------------------------------------------------------------------------------------------


def is_list_item(text: Column) -> Column:
    return starts(text, P.LIST_ITEM)


def dangling_end(text: Column) -> Column:
    """Ends as if it went on: no closing mark, at most 220 characters, a small word or lower-case letter last."""
    t = strip(text)
    return F.coalesce((t != "") & ~has(t, r"[.:;!?)]\z") & (F.length(t) <= 220) & has(t, rf"(?:{P.DANGLING_WORD}|\p{{Lower}})\z"), F.lit(False))


def dangling_start(text: Column) -> Column:
    """Begins as if it continued something: a lower-case letter or a bracket, quote or comma that is no list item."""
    t = strip(text)
    return starts(t, r'[а-яёa-z(")\],]') & ~is_list_item(t)


def is_formula(text: Column) -> Column:
    return F.coalesce(text.contains("$$") | text.contains("assets/formulas/") | strip(text).startswith("[Формула"), F.lit(False))


def is_micro(text: Column) -> Column:
    """At most two words and no heading mark, table label, formula or bare number; an empty text is one too."""
    t = strip(F.coalesce(text, F.lit("")))
    kept = t.startswith("#") | t.startswith("[Таблица]") | is_formula(t) | has(t, r"\A[(\[]?\d+(?:\.\d+)*[)\]]?\z")
    return (t == "") | (t == "[Таблица]") | (~kept & (F.regexp_count(t, F.lit(rx(r"\S+"))) <= 2))


def is_pipe_row(line: Column) -> Column:
    s = strip(line)
    return F.coalesce(s.startswith("|") & (F.length(s) - F.length(F.replace(s, F.lit("|"))) >= 2), F.lit(False))


def pipe_rows(lines: Column) -> Column:
    return F.size(F.filter(lines, lambda s: s.startswith("|") & (F.length(s) - F.length(F.replace(s, F.lit("|"))) >= 2)))


def is_table_fragment(text: Column) -> Column:
    lines = full_lines(drop_table_label(text), "any")
    return F.coalesce((F.size(lines) > 0) & (pipe_rows(lines) == F.size(lines)), F.lit(False))


def is_table_block(text: Column) -> Column:
    lines = full_lines(F.regexp_replace(text, "^﻿+", ""), "any")
    return F.coalesce((F.size(lines) >= 2) & (pipe_rows(lines) >= F.greatest(F.lit(2), F.floor(F.size(lines) * 0.55))), F.lit(False))


def keeps_lines(text: Column) -> Column:
    """Paragraphs that are not split line by line: labelled or piped tables."""
    return F.coalesce(F.lower(strip(text)).startswith("[таблица]"), F.lit(False)) | is_table_block(text)


def is_separator_cells(cells: Column) -> Column:
    """At least two cells, all ``---`` with optional colons."""
    return F.coalesce((F.size(cells) >= 2) & F.forall(cells, lambda c: strip(c).rlike(r"^:?-{3,}:?$")), F.lit(False))


def row_cells(line: Column) -> Column:
    """Cells of a pipe row."""
    return F.transform(F.split(F.regexp_replace(strip(line), r"^\||\|$", ""), r"\|", -1), strip)


def is_separator_line(line: Column) -> Column:
    return is_pipe_row(line) & is_separator_cells(row_cells(line))


def is_upper(text: Column) -> Column:
    """At least one upper-case letter and no lower-case one."""
    return has(text, r"\p{Upper}") & ~has(text, r"[\p{Lower}\p{Lt}]")


def is_header(text: Column) -> Column:
    """Whether a block reads as a heading: a list of exclusions, then the forms headings have."""

    def judge(t: Column) -> Column:
        lines = full_lines(t)
        out = (
            (t == "") | (F.length(t) > 250) | F.lower(t).startswith("таблица") | ((F.length(t) < 40) & has(t, rf"\A{P.HEADER_NOISE}\z")) | starts(t, "[а-яёa-z]") | is_formula(t)
            | F.lower(t).startswith("где ") | F.lower(t).startswith("в котором ") | bind(lines, lambda v: (F.size(v) > 5) | F.exists(v, lambda s: s.rlike(rx(P.TOC_LINE))))
        )
        upper = is_upper(t) & (F.length(t) < 150)
        form = starts(t, P.MULTI_LEVEL) | starts(t, P.ROMAN_SECTION) | starts(t, P.SECTION_KEYWORD) | ((F.length(t) > 10) & (F.length(t) < 100) & ~has(t, r"[.:;!?]\z"))
        return ~out & (upper | (~starts(t, P.NUMBERED_POINT) & form))

    return F.coalesce(bind(strip(join_hyphens(text)), judge), F.lit(False))


def header_level(text: Column) -> Column:
    """Number of parts of the leading number; 1 for roman numbers and section words; else null."""
    t = strip(text)
    number = F.regexp_extract(t, rx(rf"\A{P.LEVEL_NUMBER}"), 1)
    return F.when(number != "", F.size(F.split(number, r"\."))).when(starts(t, P.ROMAN_SECTION) | starts(F.lower(t), "приложение|глава|раздел|часть"), 1)


def _kind(t: Column, lines: Column, n: Column, piped: Column) -> Column:
    body = full_lines(strip(F.regexp_replace(t, rx(r"(?i)\A\s*\[таблица\]\s*"), "")))
    digits = F.regexp_count(t, F.lit(rx(r"\d"))) / F.greatest(F.length(t), F.lit(1))
    short = F.size(F.filter(lines, lambda s: F.length(s) < 40)) / F.greatest(n, F.lit(1))
    items = F.size(F.filter(lines, lambda s: s.rlike(rx(rf"\A{P.LIST_ITEM}"))))
    labelled = bind(body, lambda b: (F.size(b) > 0) & (pipe_rows(b) >= F.greatest(F.lit(2), F.floor(F.size(b) * 0.45))))
    rules = [
        (t == "", "other", 0.0),
        (is_formula(t), "formula", 0.95),
        ((piped == n) & (n > 1), "table", 0.8),
        (piped == n, "table", 0.76),
        ((n >= 3) & (piped >= F.greatest(F.lit(3), F.floor(n * 0.55))), "table", 0.82),
        ((n >= 2) & (piped >= 2) & (piped >= F.floor(n * 0.4)), "table", 0.78),
        (F.lower(t).startswith("[таблица]") & labelled, "table", 0.88),
        ((n > 4) & (short > 0.6) & (digits > 0.05) & (piped >= 2), "table", 0.7),
        ((n > 2) & (items / F.greatest(n, F.lit(1)) >= 0.5), "list", 0.8),
        (F.regexp_count(t, F.lit(rx(r"\n\s*\d+\)\s+"))) >= 2, "list", 0.75),
        (is_header(t), "header", 0.9),
        (starts(t, P.NUMBERED_POINT), "paragraph", 0.8),
        ((F.length(t) > 60) & (dangling_start(t) | dangling_end(t)), "paragraph", 0.7),
        (F.length(t) > 60, "paragraph", 0.9),
    ]
    out = F.struct(F.lit("other").alias("block_type"), F.lit(0.5).alias("confidence"))
    for test, name, value in reversed(rules):
        out = F.when(test, F.struct(F.lit(name).alias("block_type"), F.lit(value).alias("confidence"))).otherwise(out)
    return out


def classify(text: Column) -> Column:
    """struct(block_type, block_level, confidence) of a block; the first rule that holds decides."""
    seen = bind(strip(F.coalesce(text, F.lit(""))), lambda t: F.struct(t.alias("t"), full_lines(t).alias("lines")))
    seen = bind(seen, lambda v: F.struct(v["t"].alias("t"), v["lines"].alias("lines"), F.size(v["lines"]).alias("n"), pipe_rows(v["lines"]).alias("piped")))
    kind = bind(seen, lambda v: F.struct(v["t"].alias("t"), _kind(v["t"], v["lines"], v["n"], v["piped"]).alias("k")))
    level = lambda v: F.when(v["k"]["block_type"] == "header", header_level(v["t"]))
    return bind(kind, lambda v: F.struct(v["k"]["block_type"].alias("block_type"), level(v).alias("block_level"), v["k"]["confidence"].alias("confidence")))


def quality_flags(text: Column, block_type: Column, confidence: Column) -> Column:
    """struct(is_continuation, is_truncated, needs_review) of a chunk."""
    t = strip(F.coalesce(text, F.lit("")))
    truncated = dangling_end(t) | has(t, rf"[{P.LETTER}]-\s*\z")
    legal = has(t, f"(?i){P.LEGAL_COLLECTION}") & has(t, rf"(?i){P.EDGE}с\.\s*N{P.EDGE}")
    review = (confidence < 0.75) | truncated | legal | ((block_type == "header") & starts(t, P.NUMBERED_POINT))
    return F.struct(dangling_start(t).alias("is_continuation"), truncated.alias("is_truncated"), F.coalesce(review, truncated | legal).alias("needs_review"))


def entities(text: Column) -> Column:
    """array<struct(type, value)> of references, measurements and norms: by rule, then by place, repeats kept."""
    def made(kind: str, form: str, pattern: str) -> Column:
        found = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(rx(pattern)), F.lit(0))
        shape = {"lower": F.lower, "upper": F.upper, "comma": lambda v: F.replace(v, F.lit(","), F.lit("."))}[form]
        return F.transform(found, lambda v: F.struct(F.lit(kind).alias("type"), shape(v).alias("value")))

    return F.concat(*(made(*rule) for rule in P.ENTITIES))
