import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from pagemill.functions.text import is_separator_cells, is_separator_line
from pagemill.operators import layout as L
from pagemill.operators import ordered, registry, running, tables

# --- registry ------------------------------------------------------------------------------------------------------


def test_formats(spark):
    rows = spark.createDataFrame([("", "a/b.PDF"), ("nan", "x.log"), ("", "noext"), (" DOCX", None), (None, None)], "format string, file_path string").withColumn("source_id", F.lit("s"))
    got = [(r.recommended_preprocessing, r.format_normalized) for r in registry.format_policy(rows).collect()]
    assert [g[0] for g in got[:3]] == ["none", "none_plain_text_chunking", "review_manually"] and got[2][1] == "unknown" and got[3][1] == "docx" and got[4][1] == "unknown"


def test_routes(spark):
    rows = spark.createDataFrame([(e,) for e in ("pdf", "png", "docx", "xlsx", "txt", "")], "e string")
    assert [r[0] for r in rows.select(registry.route(F.col("e"))).collect()] == ["heavy", "heavy", "heavy", "light", "light", "heavy"]
    assert {r[0] for r in rows.select(registry.route(F.col("e"), "docling")).collect()} == {"docling"}
    with pytest.raises(ValueError):
        registry.route(F.col("e"), "other")


def test_resume(spark):
    reg = spark.createDataFrame([(s, f"{s}.pdf", "pdf") for s in "abcd"] + [("a", "a.pdf", "pdf"), ("nan", "x.pdf", None), (None, "y.pdf", None), ("e", None, "pdf"), ("f", "f.exe", None)], "source_id string, file_path string, format string")
    man = spark.createDataFrame([("a", "ok"), ("b", "empty"), ("c", "error"), (None, "ok"), ("c", None)], "source_id string, status string")
    assert sorted(r.source_id for r in registry.pending(reg, man).collect()) == ["c", "d"]


def test_manifests(spark):
    man = spark.createDataFrame([("a", "error", 3, 5), ("a", "ok", 2, 1), ("a", "ok", 2, 1), ("b", None, None, 2)], "source_id string, status string, page_count int, finished_at int")
    assert sorted((r.source_id, r.status, r.page_count) for r in registry.latest_manifests(man).collect()) == [("a", "ok", 2), ("b", None, None)]
    patch = spark.createDataFrame([("b", 7, "x"), ("zz", 1, "y")], "source_id string, page_count int, note string")
    got = registry.patch_manifests(man, patch).collect()
    assert [r.page_count for r in got if r.source_id == "b"] == [7] and len(got) == 4 and {r.note for r in got if r.source_id == "a"} == {None}


def test_documents(spark):
    rows = spark.createDataFrame([("b", "b:p1:b10", 1, "t", "x"), ("b", "b:p1:b2", 1, "t", "x"), ("API-1", "q:p1:b0", 1, "t", "x"), (None, None, None, None, None)], "doc_id string, chunk_id string, page int, text string, block_type string")
    kept, gone = registry.cleaned_up(rows)
    assert kept.count() == 3 and [r.doc_id for r in gone.collect()] == ["API-1"]
    assert [r.doc_id for r in registry.documents(rows).collect()] == ["API-1", "b"]
    assert [r.chunk_id for r in registry.response(rows.withColumn("section_title", F.lit("")), "b").collect()] == ["b:p1:b2", "b:p1:b10"]
    assert sorted(map(tuple, registry.response_sizes(rows.filter("doc_id = 'b'")).collect())) == [("b", 2, "b:p1:b2", "b:p1:b10")]


# --- carry and running lines ---------------------------------------------------------------------------------------


def test_carry_last(spark):
    rows = [("d", p, i, f"{p}.{i}" if (p * 3 + i) % 50 == 0 else None) for p in range(0, 150) for i in range(3)]
    got = ordered.carry_last(spark.createDataFrame(rows, "doc_id string, page int, idx int, v string"), F.col("v"), "last").collect()
    want, last = {}, None
    for _, p, i, v in rows:
        want[p, i] = last
        last = v or last
    assert {(r.page, r.idx): r.last for r in got} == want


def brute_strip(pages, rounds, fraction):
    out = [t or "" for t in pages]
    need = max(1, math.ceil(fraction * len(pages) - 1e-12))
    for end in (0, -1):
        for _ in range(rounds):
            fronts = [([s for line in t.splitlines() if (s := line.strip())] or [""])[end] for t in out]
            keys = [" ".join(f.lower().split()) if 5 <= len(f) <= 240 else None for f in fronts]
            count = Counter(k for k in keys if k)
            if not count or count.most_common(1)[0][1] < need:
                break
            key = count.most_common(1)[0][0]
            for i, k in enumerate(keys):
                if k == key:
                    lines = out[i].splitlines()
                    at = next(j for j in (range(len(lines)) if end == 0 else range(len(lines) - 1, -1, -1)) if lines[j].strip())
                    out[i] = "\n".join(lines[at + 1:] if end == 0 else lines[:at]).strip()
    return [t if o == "" else o if o != (t or "") else t for t, o in zip(pages, out)]


@pytest.mark.parametrize("fraction", [0.5, 0.9])
def test_running_lines(spark, fraction):
    nine = [f"Верхний  КОЛОНТИТУЛ\n\nТекст {i}\nещё строка {i}\n\nНижняя строка" if i < 9 else f"Другой верх\nТекст {i}" for i in range(10)]
    deep = [f"Первая строка\nВторая строка\nТекст {i}\nПоследняя строка\n" for i in range(5)]
    rows = [("a", i, t) for i, t in enumerate(nine)] + [("b", i, t) for i, t in enumerate(deep)] + [("c", i, "Общая строка") for i in range(4)] + [("d", 1, "Одна строка\nтекст"), ("d", 2, "Одна строка\nтекст"), ("e", 1, None), ("e", 2, ""), ("e", 3, "x")]
    frame = spark.createDataFrame([(i, *r, 1) for i, r in enumerate(rows)], "page_id long, source_id string, page int, text string, h int")
    got = {r.page_id: r.text for r in running.strip_running(frame, fraction=fraction).collect()}
    want = {}
    for s in "abcde":
        own = [(i, r[2]) for i, r in enumerate(rows) if r[0] == s]
        texts = [t for _, t in own]
        want.update(zip((i for i, _ in own), brute_strip(texts, 5, fraction) if len(own) >= 3 else texts))
    assert got == want


# --- tables --------------------------------------------------------------------------------------------------------


def one(spark, column, **values):
    return spark.range(1).select(column.alias("v")).first().v


def md(text):
    return F.lit(text)


def test_tables(spark):
    assert one(spark, tables.parse(md("| a | b |\n|---|---|\n| 1 | 2 |"))) == [["a", "b"], ["---", "---"], ["1", "2"]]
    assert one(spark, tables.parse(md("| a |\n| b |"))) is None
    assert one(spark, tables.promote_head(md("|Col1|Col2|\n|---|---|\n|A|B|\n|1|2|"))) == "|A|B|\n|---|---|\n|1|2|"
    same = "|Col1|Col2|\n|---|---|\n|X|X|\n|1|2|"
    assert one(spark, tables.promote_head(md(same))) == same
    assert one(spark, is_separator_cells(F.array(F.lit(":--:"), F.lit("---")))) is False and one(spark, is_separator_line(md("| --- | :---: |"))) is True
    row = F.array(F.lit("a"), F.lit("b "), F.lit("c"))
    assert one(spark, tables.fit_row(row, F.lit(2))) == ["a", "b c"] and one(spark, tables.fit_row(row, F.lit(4))) == ["a", "b", "c", ""] and one(spark, tables.fit_row(row, F.lit(1))) == ["a"]
    assert one(spark, tables.to_markdown(F.array(F.array(F.lit("a|"), F.lit("b")), F.array(F.lit("1\n2"))))) == "| a\\| | b |\n| --- | --- |\n| 1<br>2 |  |"


def test_wrapped_rows():
    assert tables.merge_wrapped([["Термин", "Определение"], ["ПДК", "предельно"], ["", "допустимая"]])[1:] == [["ПДК", "предельно допустимая"]]
    assert tables.merge_wrapped([["Ё", ""], ["a", "b"], [None, ""], ["c", ""]]) == [["a", "b"], ["c", ""]]
    assert tables.merge_wrapped([["a", "b", "c"], ["d"]]) == [["a", "b", "c"], ["d", "", ""]] and tables.merge_wrapped(None) == []


def test_sheets(spark):
    rows = [("s", 0, "A", 0, ["x", "y"]), ("s", 0, "A", 1, ["1", "2|3"]), ("s", 0, "A", 2, ["4", None]), ("s", 1, "B", 0, ["Unnamed: 0"]), ("s", 1, "B", 1, [" "]), ("s", 2, "C", 0, ["h"])]
    cells = spark.createDataFrame(rows, "source_id string, sheet_idx int, sheet string, row_idx int, cells array<string>")
    got = [(r.page, r.text) for r in tables.sheet_pages(cells).orderBy("page").collect()]
    assert got == [(1, "# Лист: A\n\n[Таблица]\n| x | y |\n| --- | --- |\n| 1 | 2\\|3 |\n| 4 |  |"), (2, "# Лист: C\n\n[Таблица]\n| h |\n| --- |")]
    assert [r.text.split("\n")[0] for r in tables.sheet_pages(cells, 45).orderBy("page").collect()] == ["# Лист: A (часть 1/2)", "# Лист: A (часть 2/2)", "# Лист: C"]


# --- layout --------------------------------------------------------------------------------------------------------

BOX = "source_id string, page int, box_ord int, label string, x1 int, y1 int, x2 int, y2 int, conf double"
WORD = "source_id string, page int, word_ord int, cx double, cy double, text string, x_min double, x_max double, block_no int, line_no int, word_no int, box_ord int"


def boxes(spark, *rows):
    return spark.createDataFrame([("s", 1, i, label, *b, conf) for i, (label, b, conf) in enumerate(rows)], BOX)


def test_boxes(spark):
    half = boxes(spark, (L.FORMULA, (0, 0, 10, 10), 0.9), (L.FORMULA, (5, 0, 15, 10), 0.8))
    assert L.unique_formulas(half).count() == 2 and round(L.box_pairs(half).first().iou, 4) == 0.3333
    near = boxes(spark, (L.FORMULA, (0, 0, 10, 10), 0.5), (L.FORMULA, (0, 0, 10, 9), 0.8), ("table", (0, 0, 10, 10), 0.1))
    assert sorted((r.box_ord, r.label) for r in L.unique_formulas(near).collect()) == [(1, L.FORMULA), (2, "table")]
    assert L.usable_boxes(boxes(spark, ("title", (0, 0, 1, 1), 0.2), ("table", (0, 0, 1, 1), 0.2), ("figure", (0, 0, 1, 1), 0.9))).count() == 1


def test_words(spark):
    b = boxes(spark, ("plain text", (0, 0, 100, 100), 0.9), ("plain text", (0, 0, 50, 50), 0.9), (L.FORMULA, (0, 0, 10, 10), 0.9), ("title", (0, 0, 50, 50), 0.9))
    w = spark.createDataFrame([("s", 1, i, x, y, f"w{i}", x, x, -1, -1, -1, None) for i, (x, y) in enumerate([(5.0, 5.0), (60.0, 60.0), (200.0, 5.0)])], WORD).drop("box_ord")
    assert sorted((r.word_ord, r.box_ord) for r in L.words_to_boxes(w, b).collect()) == [(0, 1), (1, 0), (2, None)]
    assert sorted(r.word_ord for r in L.words_outside_formulas(w, b).collect()) == [1, 2]


def test_lines_and_tables(spark):
    rows = [(10.0, 10.0, "a"), (40.0, 12.0, "b"), (10.0, 40.0, "c"), (40.0, 41.0, "d"), (10.0, 70.0, "e")]
    w = spark.createDataFrame([("s", 1, i, x, y, t, x - 5, x + 5, -1, -1, -1, 0) for i, (x, y, t) in enumerate(rows)], WORD)
    assert [r.text for r in L.box_lines(w).orderBy("line").collect()] == ["a b", "c d", "e"] and L.box_texts(w).first().text == "a b c d e"
    native = spark.createDataFrame([("s", 1, i, 1.0, 1.0, t, 0.0, 1.0, 0, 0, 9 - i, 0) for i, t in enumerate(["в", "б", "Ïðè"])], WORD)
    assert L.box_texts(native).first().text == "При б в"
    table = lambda *rows: [r.text for r in L.word_tables(spark.createDataFrame([("s", 1, i, float(x), float(y), t, x - 5.0, x + 5.0, -1, -1, -1, 0) for i, (x, y, t) in enumerate(rows)], WORD)).collect()]
    assert table((10, 10, "Ïðèâåò"), (100, 12, "a|b"), (10, 40, "слово")) == ["[Таблица]\n| Привет | a\\|b |\n|---| ---| ---|\n| слово | | |"]
    assert table((10, 10, "Col1"), (100, 12, "Col2"), (10, 40, "Имя"), (100, 41, "Вес"), (10, 70, "аб"), (100, 71, "12")) == ["[Таблица]\n|Имя|Вес|\n|---|---|\n|аб|12|"]
    sparse = [(100 * i, 10 + 40 * k, "x") for k in range(2) for i in range(5)]
    assert table(*sparse) == ["[Таблица]\n" + "\n".join(["x | x | x | x | x"] * 2)] and table() == []
    assert table(*[(x, y, "xy") for x, y, _ in sparse])[0].startswith("[Таблица]\n| xy | xy")


def test_reading_order(spark):
    two = boxes(spark, *[("plain text", (x, y, x + 100, y + 10), 0.9) for y in (0, 20, 40) for x in (0, 500)])
    assert [r.box_ord for r in L.reading_order(two, F.lit(600)).orderBy("position").collect()] == [0, 2, 4, 1, 3, 5]
    assert [r.box_ord for r in L.reading_order(two.filter("box_ord < 4"), F.lit(600)).orderBy("position").collect()] == [0, 1, 2, 3]


def test_tokens(spark):
    t = spark.createDataFrame([("s", 1, a, "слово", c) for a in (0, 180) for c in (0.9, 0.5)] + [("s", 2, 0, "x", 0.1)] * 16, "source_id string, page int, angle int, text string, conf double")
    assert [(r.page, r.angle) for r in L.orientations(t).collect()] == [(1, 0)] and [r.page for r in L.unreadable_pages(t).collect()] == [2]
    assert L.kept_tokens(t, "easyocr").count() == 4
    pages = spark.createDataFrame([("s", 1, "да"), ("s", 2, "нет"), ("s", 3, None)], "source_id string, page int, text string")
    assert {r.page: r.text for r in L.with_unreadable(pages, t).collect()} == {1: "да", 2: L.UNREADABLE, 3: None}


def test_native_text(spark):
    good, poor = "Слово за словом читается хорошо. " * 8, "Слвз слвм чттс хршш. " * 8
    rows = [(1, poor, good, 40, True), (2, poor, good, 30, True), (3, poor, good, 40, False), (4, good, good, 40, True), (5, poor, "Коротко", 40, True), (6, poor, poor, 40, True), (7, poor, None, 40, True), (8, None, good, 40, True)]
    out = {r.i: (r.text, r.used_native) for r in L.native_where_better(spark.createDataFrame(rows, "i int, text string, native_text string, native_words int, is_scan boolean")).collect()}
    assert [out[i][1] for i in range(1, 9)] == [True, False, False, False, False, False, False, True]
    assert out[1][0] == good.strip() and out[5][0] == poor


def test_registry_of_runs(spark):
    reg = spark.createDataFrame([("a", "x/a.pdf", None), ("b", "b.png", ""), ("c", "c.docx", "DOCX"), ("_t", "t.txt", "txt"), (None, "n.txt", None)], "source_id string, file_path string, format string")
    pages = spark.createDataFrame([("a", 1, "т" * 60), ("c", 1, "т")], "source_id string, page int, text string")
    files = spark.createDataFrame([("x/a.pdf", 1 << 20)], "path string, length long")
    got = {r.source_id: r for r in registry.document_profiles(reg, pages, files).collect()}
    assert [(got[k].is_image, got[k].is_pdf, got[k].is_office, got[k].page_count, got[k].has_text_layer, got[k].size_mb) for k in "abc"] == [(False, True, False, 1, True, 1.0), (True, False, False, 1, False, None), (False, False, True, 1, True, None)]
    assert sorted(r.source_id for r in registry.selected(reg).collect()) == ["a", "b", "c"] and registry.selected(reg, ["a", "_t"]).count() == 1
    modes = spark.createDataFrame([(None,), (" YOLO ",), ("",)], "m string")
    assert [r.v for r in modes.select(registry.parser_mode(F.col("m"), "docling").alias("v")).collect()] == ["docling", "yolo", "docling"]
    with pytest.raises(Exception, match="unknown parser mode"):
        spark.range(1).select(registry.parser_mode(F.lit("other"))).collect()
    runs = spark.createDataFrame([("a", 3, 0, 10), ("b", 3, 1, 10), ("c", 3, 0, None), ("d", None, None, 5)], "source_id string, page_count int, exit_code int, output_bytes long")
    assert {r.source_id: r.reason for r in registry.converter_failures(runs).collect()} == {"b": "exit_code", "c": "no_output", "d": "no_pages"}
    states = spark.createDataFrame([("a", "error"), ("a", "ok"), ("b", "error")], "source_id string, status string")
    assert tuple(registry.run_counters(reg, states).first()) == (4, 1, 1, 2)
    assert {r.source_id: (r.ingest_as_in_registry, r.alternatives) for r in registry.format_policy(reg).collect()}["b"] == (False, [])
    chunks = spark.createDataFrame([("a:p1:b10", "a", 1, "list", "t", "два"), ("a:p1:b2", "a", 1, "list", "t", "раз"), ("a:p1:b2", "a", 1, "list", "t", "раз")], "chunk_id string, doc_id string, page int, block_type string, section_title string, text string")
    one = registry.envelope(chunks, reg, "a").first()
    assert (one.filename, one.route, [c.text for c in one.chunks]) == ("a.pdf", "heavy", ["раз", "два"])
    with pytest.raises(Exception, match="no such document"):
        registry.envelope(chunks, reg, "zz").collect()


def test_page_texts(spark):
    rows = [("s", 1, i, label, t) for i, (label, t) in enumerate([("title", "Глава"), ("title", "1. Пункт"), ("plain text", "12"), ("isolate_formula", "$$x$$"), ("plain text", "( 3 )"), ("plain text", "Введение.......5"), ("plain text", "авто-\nматика")])]
    b = spark.createDataFrame(rows, "source_id string, page int, position int, label string, text string")
    assert L.page_texts(b).first().text == "# Глава\n\n1. Пункт\n\n$$x$$ ( 3 )\n\nавтоматика"
    items = b.withColumnRenamed("position", "item_ord").withColumn("label", F.when(F.col("item_ord") == 0, "page_header").otherwise("text")).withColumn("page", F.lit(None).cast("int"))
    assert L.item_pages(items.filter("item_ord < 2")).first().text == "1. Пункт" and L.item_pages(items).first().page == 1
