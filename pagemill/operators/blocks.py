"""Page text to structural blocks: page-local, so it runs on every page in parallel.

The page is taken through four stages, each a generator over pieces of text: paragraphs, heading lines cut off,
small pieces gathered, long pieces split.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from pagemill.functions import patterns as P
from pagemill.functions import rules as R

#: Characters: pieces below the first are gathered, above the second split, with the third as overlap.
MIN_CHARS, MAX_CHARS, OVERLAP = 300, 2500, 200
#: Breaks at which a long text is split, of any of which the right-most in the last two fifths is taken.
BREAKS = ("\n\n", "\n", ". ", "; ", ", ", " ")

_POINT = re.compile(rf"(?<!\n)([.;:])\s+(?=\d{{1,3}}[.)]\s+[{P.LETTER}])")
_LETTERED = re.compile(rf"(?<!\n):\s+(?=[{P.LETTER}][.)]\s+[{P.LETTER}])")
_TABLE = re.compile(r"(\[Таблица\]\s*\n.*?)(?=\n#\s|\Z)", re.I | re.S)
_CITE = re.compile(rf"({P.LEGAL_COLLECTION}[^.\n]{{0,220}}),\s*(?:с\.\s*)?N\s*(\d+),\s*(\d+)", re.I)


def normalize(text: str) -> str:
    """Typical reading errors: a comma behind a point's number, white space in front of marks, legal citations."""
    text = re.sub(rf"(?m)^(\d{{1,3}}),\s+(?=[{P.LETTER}])", r"\1. ", text)
    text = re.sub(r"\s+(?=[,.;:])", "", text)
    return _CITE.sub(r"\1, N \2, ст.\3", _CITE.sub(r"\1, N \2, ст.\3", text))


def break_points(text: str) -> str:
    """A line break in front of points inside running text; labelled tables stay as they are."""
    def plain(part: str) -> str:
        return _LETTERED.sub(":\n", _POINT.sub(r"\1\n", part))

    pieces = _TABLE.split(text) if "[таблица]" in text.lower() else [text]
    return "".join(piece if i % 2 else plain(piece) for i, piece in enumerate(pieces))


def repair_rows(text: str) -> str:
    """Table rows that were broken over two lines, joined: the first begins with a pipe and doesn't end with one."""
    if "|" not in text:
        return text
    out: list[str] = []
    for line in text.splitlines():
        rest = line.strip()
        open_row = bool(out) and out[-1].startswith("|") and not out[-1].rstrip().endswith("|")
        if open_row and "|" in rest and rest[0] not in "#|" and not rest.lower().startswith("[таблица]"):
            out[-1] = f"{out[-1].rstrip()} {rest}"
        else:
            out.append(line)
    return "\n".join(out)


def split_rows(text: str, most: int) -> list[str]:
    """A table in groups of whole rows of at most ``most`` characters; a longer row is a group of its own."""
    groups: list[list[str]] = [[]]
    size = 0
    for row in text.splitlines():
        grown = size + len(row) + bool(groups[-1])
        if groups[-1] and grown > most:
            groups.append([])
            grown = len(row)
        groups[-1].append(row)
        size = grown
    return ["\n".join(g) for g in groups if g] or [text]


def split_long(text: str, most: int = MAX_CHARS, overlap: int = OVERLAP) -> list[str]:
    """Overlapping pieces of at most ``most`` characters, cut at the right-most break of the last two fifths.

    ``overlap`` must stay below three fifths of ``most``, or the pieces would not advance.
    """
    if overlap >= 0.6 * most:
        raise ValueError(f"an overlap of {overlap} does not advance in pieces of {most}")
    if len(text) <= most:
        return [text]
    if R.is_table_block(text):
        return split_rows(text, most)
    pieces, start = [], 0
    while start < len(text):
        end = start + most
        if end < len(text):
            least = max(start + int(most * 0.6), start + 1)
            at = max(text.rfind(b, least, end) for b in BREAKS)
            end = at + 1 if at > least else end
        pieces.append(text[start:end])
        if end >= len(text):
            break
        start = max(0, end - overlap)
        start += len(text[start:]) - len(text[start:].lstrip())
    return pieces


def _cut_headings(paragraph: str) -> Iterator[str]:
    """A long paragraph of single lines, cut where a heading begins or ends."""
    held: list[str] = []
    for line in paragraph.split("\n"):
        s = line.strip()
        if not s:
            continue
        section = R.is_section(s)
        strong = section or (s.isupper() and 5 < len(s) < 150 and not R.is_noise_line(s))
        if held:
            before = R.is_header("\n".join(held))
            if strong:
                cut = section or not before
            else:
                cut = before and ((s[0].isupper() and len(s) > 50) or R.is_item(s))
            if cut:
                yield "\n".join(held)
                held = []
        held.append(line)
    if held:
        yield "\n".join(held)


def _paragraphs(text: str) -> Iterator[str]:
    for paragraph in re.split(r"\n\s*\n", text):
        paragraph = paragraph.strip()
        if not paragraph:
            continue
        if "\n" in paragraph and len(paragraph) > 150 and not R.keeps_lines(paragraph):
            yield from (s for piece in _cut_headings(paragraph) if (s := piece.strip()))
        else:
            yield paragraph


def _glue(held: str, piece: str, least: int, most: int) -> str | None:
    """What joins a piece to the one held, null if they stay apart."""
    if R.is_header(held) or R.is_header(piece) or R.keeps_lines(held) or R.keeps_lines(piece):
        return None
    room = len(held) + len(piece) + 1 <= most
    explains = R.is_formula(held) and piece.lower().startswith("где")
    if room and (R.is_item(piece) or held.strip().endswith(":") or R.is_formula(piece) or explains):
        return "\n"
    if room and R.dangling_end(held) and R.dangling_start(piece):
        return " "
    return "\n\n" if len(held) + len(piece) + 2 <= least else None


def _gather(pieces: Iterable[str], least: int, most: int) -> Iterator[str]:
    held = ""
    for piece in pieces:
        glue = _glue(held, piece, least, most) if held else ""
        if glue is None:
            yield held
            held = piece
        else:
            held += glue + piece
    if held:
        yield held


def blocks_of(text: str, least: int = MIN_CHARS, most: int = MAX_CHARS, overlap: int = OVERLAP) -> list[str]:
    """Structural blocks of a page; pieces of one or two words go to the piece in front if it has room."""
    out: list[str] = []
    for block in _gather(_paragraphs(repair_rows(text)), least, most):
        for piece in split_long(block, most, overlap):
            small = piece.strip()
            if not R.is_micro(small):
                out.append(piece)
            elif out and len(out[-1]) + len(small) + 1 <= most:
                out[-1] = f"{out[-1].rstrip()} {small}"
            else:
                out.append(small)
    return [b for b in out if b.strip()]


def blocks_of_page(text: str | None, most: int = MAX_CHARS, overlap: int = OVERLAP) -> list[str]:
    """Blocks of a page as it was read: normalised, points broken off, rows repaired."""
    return blocks_of(repair_rows(break_points(normalize(text))), MIN_CHARS, most, overlap) if text else []


def page_blocks(text: Column, most: int = MAX_CHARS, overlap: int = OVERLAP) -> Column:
    """array<string> of a page's blocks; null and blank texts have none."""

    @F.pandas_udf("array<string>")
    def split(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: blocks_of_page(t, most, overlap))

    return split(text)


def long_pieces(text: Column, most: int = MAX_CHARS, overlap: int = OVERLAP) -> Column:
    """array<string> of :func:`split_long`."""

    @F.pandas_udf("array<string>")
    def split(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: split_long(t, most, overlap) if t else [])

    return split(text)
