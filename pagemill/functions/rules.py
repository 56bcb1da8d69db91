"""The text rules that ordered folds need while they run, on Python strings.

Same meaning as the Column expressions in ``pagemill.functions.text``; tests hold both against each other.
"""

from __future__ import annotations

import re
from typing import NamedTuple

from pagemill.functions import patterns as P

_ITEM, _POINT, _ROMAN = re.compile(P.LIST_ITEM), re.compile(P.NUMBERED_POINT), re.compile(P.ROMAN_SECTION)
_KEYWORD, _MULTI, _LEVEL = re.compile(P.SECTION_KEYWORD), re.compile(P.MULTI_LEVEL), re.compile(P.LEVEL_NUMBER)
# Python takes inline flags inside a group as they are; a leading (?i) is only allowed at the start
_TOC = re.compile(r"(?:\.{3,}|…|\s{4,})\s*\d+$|(?i:\bСтр\.\s*\d+$)")
_NOISE = re.compile(rf"(?:{P.HEADER_NOISE})$")
_LABEL = re.compile(P.TABLE_LABEL)
_SMALL_END = re.compile(rf"{P.DANGLING_WORD}$")
_LEGAL = re.compile(P.LEGAL_COLLECTION, re.I)
_LEGAL_PAGE = re.compile(r"\bс\.\s*N\b", re.I)
_HYPHEN = re.compile(rf"(?<=[{P.LETTER}])-\s*\n\s*(?=[{P.LETTER}])")


class Kind(NamedTuple):
    block_type: str
    level: int | None
    confidence: float


def full_lines(text: str) -> list[str]:
    return [s for line in text.split("\n") if (s := line.strip())]


def is_pipe(line: str) -> bool:
    line = line.strip()
    return line.startswith("|") and line.count("|") > 1


def piped(lines: list[str]) -> int:
    return sum(map(is_pipe, lines))


def unlabelled(text: str) -> str:
    return _LABEL.sub("", text.strip(), count=1) if _LABEL.match(text.strip()) else text.strip()


def is_separator(line: str) -> bool:
    cells = [c.strip() for c in line.strip().strip("|").split("|")]
    return is_pipe(line) and len(cells) > 1 and all(re.fullmatch(r":?-{3,}:?", c) for c in cells)


def is_table_block(text: str) -> bool:
    lines = [s for line in text.lstrip("﻿").splitlines() if (s := line.strip())]
    return len(lines) > 1 and piped(lines) >= max(2, int(len(lines) * 0.55))


def is_table_fragment(text: str) -> bool:
    lines = [s for line in unlabelled(text).splitlines() if (s := line.strip())]
    return bool(lines) and piped(lines) == len(lines)


def keeps_lines(text: str) -> bool:
    return text.strip().lower().startswith("[таблица]") or is_table_block(text)


def is_formula(text: str) -> bool:
    return "$$" in text or "assets/formulas/" in text or text.strip().startswith("[Формула")


def is_item(text: str) -> bool:
    return bool(_ITEM.match(text))


def dangling_end(text: str) -> bool:
    t = text.strip()
    return bool(t) and t[-1] not in ".:;!?)" and len(t) <= 220 and bool(t[-1].islower() or _SMALL_END.search(t))


def dangling_start(text: str) -> bool:
    t = text.strip()
    return bool(t) and not is_item(t) and bool(re.match(r'[а-яёa-z(")\],]', t))


def is_micro(text: str) -> bool:
    t = text.strip()
    if not t or t == "[Таблица]":
        return True
    special = t.startswith(("#", "[Таблица]")) or is_formula(t) or re.fullmatch(r"[\(\[]?\d+(?:\.\d+)*[\)\]]?", t)
    return not special and len(t.split()) < 3


def is_noise_line(line: str) -> bool:
    return bool(re.fullmatch(P.LINE_NOISE, line))


def is_section(text: str) -> bool:
    return bool(_MULTI.match(text) or _ROMAN.match(text) or _KEYWORD.match(text))


def is_header(text: str) -> bool:
    t = _HYPHEN.sub("", text).strip()
    lines, low = full_lines(t), t.lower()
    excluded = (
        not t or len(t) > 250 or len(lines) > 5 or low.startswith(("таблица", "где ", "в котором ")) or is_formula(t)
        or any(_TOC.search(line) for line in lines) or (len(t) < 40 and _NOISE.match(t)) or re.match("[а-яёa-z]", t)
    )
    if excluded:
        return False
    if t.isupper() and len(t) < 150:
        return True
    return not _POINT.match(t) and (is_section(t) or (10 < len(t) < 100 and t[-1] not in ".:;!?"))


def header_level(text: str) -> int | None:
    t = text.strip()
    if m := _LEVEL.match(t):
        return m[1].count(".") + 1
    return 1 if _ROMAN.match(t) or t.lower().startswith(("приложение", "глава", "раздел", "часть")) else None


def classify(text: str) -> Kind:
    t = text.strip()
    if not t:
        return Kind("other", None, 0.0)
    if is_formula(t):
        return Kind("formula", None, 0.95)
    lines = full_lines(t)
    n, rows = len(lines), piped(lines)
    body = full_lines(re.sub(r"\A\s*\[таблица\]\s*", "", t, flags=re.I).strip()) if t.lower().startswith("[таблица]") else []
    digits = sum(map(str.isdigit, t)) / len(t)
    short = sum(len(line) < 40 for line in lines) / n
    for holds, confidence in (
        (rows == n, 0.8 if n > 1 else 0.76),
        (n >= 3 and rows >= max(3, int(n * 0.55)), 0.82),
        (n >= 2 and rows >= 2 and rows >= int(n * 0.4), 0.78),
        (body and piped(body) >= max(2, int(len(body) * 0.45)), 0.88),
        (n > 4 and short > 0.6 and digits > 0.05 and rows >= 2, 0.7),
    ):
        if holds:
            return Kind("table", None, confidence)
    if n > 2 and sum(map(is_item, lines)) / n >= 0.5:
        return Kind("list", None, 0.8)
    if len(re.findall(r"\n\s*\d+\)\s+", t)) > 1:
        return Kind("list", None, 0.75)
    if is_header(t):
        return Kind("header", header_level(t), 0.9)
    if _POINT.match(t):
        return Kind("paragraph", None, 0.8)
    if len(t) <= 60:
        return Kind("other", None, 0.5)
    return Kind("paragraph", None, 0.7 if dangling_start(t) or dangling_end(t) else 0.9)


def flags(text: str, block_type: str, confidence: float) -> tuple[bool, bool, bool]:
    """is_continuation, is_truncated, needs_review."""
    t = text.strip()
    truncated = dangling_end(t) or bool(re.search(rf"[{P.LETTER}]-\s*$", t))
    legal = bool(_LEGAL.search(t) and _LEGAL_PAGE.search(t))
    review = confidence < 0.75 or truncated or legal or (block_type == "header" and bool(_POINT.match(t)))
    return dangling_start(t), truncated, review
