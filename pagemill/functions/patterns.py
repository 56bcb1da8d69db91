"""Patterns shared by Column expressions (Java regex) and by the page-local Python folds.

Fixed values: they decide results and are kept as the data format defines them. ``rx`` gives a pattern to the
JVM with Python's meaning: Unicode classes and only the line feed as line end.
"""

from __future__ import annotations

LETTER = "а-яА-ЯёЁa-zA-Z"
LIST_ITEM = rf"([*\-•]|\d+(?:\.\d+)*[.)]|[{LETTER}][.)])\s"
NUMBERED_POINT = rf"\d{{1,3}}[.)]\s+[{LETTER}]"
ROMAN_SECTION = r"(?i:[IVXLCDM]+\.\s+[А-ЯЁA-Z])"
SECTION_KEYWORD = rf"(?i:(глава|раздел|приложение|часть)\s+[\d{LETTER}]+)"
MULTI_LEVEL = r"\d+(?:\.\d+)+\.?\s+[A-ZА-ЯЁ]"
LEVEL_NUMBER = r"(\d+(?:\.\d+)*)\.?\s"
TOC_LINE = r"(?:(?:\.{3,}|…|\s{4,})\s*\d+$|(?i:\bСтр\.\s*\d+$))"
HEADER_NOISE = r"(?i:методика|страница\s*\d+|консультантплюс|источник\s*публикации|\d+)"
LINE_NOISE = r"(?i:методика|страница\s*\d+|источник\s*публикации|\d+)"
DANGLING_WORD = "(?i:в|и|с|по|для|о|об|от|при|на|к)"
TABLE_LABEL = r"(?i:\s*\[Таблица\]\s*\n?)"
LEGAL_COLLECTION = "собрание законодательства российской федерации"
#: Python's boundary between word and other characters; Java's own knows neither ³ nor ² as word characters.
EDGE = r"(?:(?<=[\p{L}\p{N}_])(?![\p{L}\p{N}_])|(?<![\p{L}\p{N}_])(?=[\p{L}\p{N}_]))"
ENTITIES = (
    ("table_ref", "lower", rf"(?i){EDGE}таблиц[еуа]\s+\d+(?:\.\d+)*{EDGE}"),
    ("figure_ref", "lower", rf"(?i){EDGE}(?:рис\.|рисунок)\s+\d+(?:\.\d+)*{EDGE}"),
    ("reference", "lower", r"(?i)приложени[еяю]\s+[\d\.]+"),
    ("measurement", "comma", rf"{EDGE}\d+(?:[\.,]\d+)?\s*(?:г/с|мг/м.{{0,2}}|т/год|ПДК|°C|кг|м³|г/м³|т/г){EDGE}"),
    ("normative_ref", "upper", r"(?i)(?:ГОСТ\s+Р?\s*\d+-\d+|СанПиН\s+\d\.\d\.\d\.\d+-\d+|ФЗ[ -]\d+)"),
)


def rx(pattern: str) -> str:
    return f"(?dU){pattern}"
