import random

from pyspark.sql import functions as F

from pagemill.operators import blocks as B
from pagemill.operators import chunks as C

PAGES = "page_id long, source_id string, page int, text string, idx int, run string"


def pages(spark, *rows):
    return spark.createDataFrame([(i, s, p, t, 1, "x") for i, (s, p, t) in enumerate(rows)], PAGES)


def built(spark, *rows):
    out = C.structural_chunks(pages(spark, *rows))
    return {r.chunk_id: r for r in out.collect()}


WORDS = " ".join(["Слово"] * 20)


def test_split_long():
    assert [len(p) for p in B.split_long("a" * 30, 20, 5)] == [20, 15]
    assert B.split_rows("aaaaa\nbbbbb", 10) == ["aaaaa", "bbbbb"]
    text = " ".join(random.Random(1).choices(["слово", "два.", "три;"], k=400))
    pieces = B.split_long(text, 200, 40)
    assert all(len(p) <= 200 for p in pieces) and text.startswith(pieces[0]) and text.endswith(pieces[-1])


def test_small_pieces_and_headings():
    assert B.blocks_of("") == []
    assert B.blocks_of("ГЛАВА 1\n\nТекст первого абзаца главы.\n\nВторой абзац.") == ["ГЛАВА 1", "Текст первого абзаца главы.\n\nВторой абзац."]
    assert B.repair_rows("| a | b\nc | d |") == "| a | b c | d |"
    assert B.break_points("[Таблица]\n| a; 1. Б |") == "[Таблица]\n| a; 1. Б |"


def test_links_of_sections(spark):
    got = built(spark, ("d", 1, "ГЛАВА ПЕРВАЯ\n\nЭто первый абзац главы."), ("d", 2, "ГЛАВА ВТОРАЯ\n\n1) один;\n\n2) два;\n\n3) три;"), ("e", 1, "Это текст без главы."))
    assert {k: (r.parent_header_id, r.section_title) for k, r in got.items()} == {
        "d:p1:b0": (None, "ГЛАВА ПЕРВАЯ"), "d:p1:b1": ("d:p1:b0", "ГЛАВА ПЕРВАЯ"), "d:p2:b0": ("d:p1:b0", "ГЛАВА ВТОРАЯ"), "d:p2:b1": ("d:p2:b0", "ГЛАВА ВТОРАЯ"), "e:p1:b0": (None, ""),
    }


def test_continuation_across_pages(spark):
    got = built(spark, ("d", 1, WORDS), ("d", 2, "слово и далее."), ("d", 3, None), (None, 1, "Текст"), ("d", None, "Текст"))
    assert [(k, r.page_end, r.structure_confidence, r.is_truncated) for k, r in got.items()] == [("d:p1:b0", 2, 0.7, True)]
    got = built(spark, ("d", 1, WORDS), ("d", 2, "слово и далее.\n\nГЛАВА ВТОРАЯ ОБЩАЯ"))
    assert sorted(got) == ["d:p1:b0", "d:p2:b0"] and got["d:p2:b0"].block_type == "header"


def test_continuation_in_a_fold():
    one = list(C.merge_rows([(1, 0, WORDS), (1, 1, "слово и далее.")]))
    assert [(p.kind.block_type, p.kind.confidence, p.marks[1:]) for p in one] == [("paragraph", 0.7, (False, True))]
    head = "| a | b |\n| --- | --- |"
    table = list(C.merge_rows([(1, 0, f"[Таблица]\n{head}\n| 1 | 2 |"), (2, 0, f"[Таблица]\n{head}\n| 3 | 4 |")]))
    assert [p.text for p in table] == [f"[Таблица]\n{head}\n| 1 | 2 |\n| 3 | 4 |"] and table[0].end == 2


def test_runs_do_not_depend_on_partitions(spark):
    rnd = random.Random(3)
    parts = ["ГЛАВА ОДИН", "Абзац текста с точкой.", "работа по", "и далее без точки", "1) пункт;", "| a | b |\n| --- | --- |\n| 1 | 2 |", WORDS]
    rows = [(f"d{d}", p, "\n\n".join(rnd.choices(parts, k=rnd.randint(0, 5)))) for d in range(3) for p in range(1, 70)]
    got = built(spark, *rows)
    expect = {}
    for d in range(3):
        flat = [(p, i, b) for s, p, t in rows if s == f"d{d}" for i, b in enumerate(B.blocks_of(B.repair_rows(B.break_points(B.normalize(t)))))]
        done = list(C.merge_rows(flat))
        gone = {p for piece in done for p in piece.swallowed}
        head = None
        for piece in done:
            key = f"d{d}:p{piece.page}:b{piece.idx - (piece.page in gone)}"
            expect[key] = (piece.text, piece.end, head)
            head = key if piece.kind.block_type == "header" else head
    assert {k: (r.text, r.page_end, r.parent_header_id) for k, r in got.items()} == expect


def test_enrichment(spark):
    schema = "chunk_id string, doc_id string, page int, block_type string, block_level int, text string, entities array<struct<type:string,value:string>>"
    rows = [
        ("d:p1:b0", "d", 1, "formula", None, "$$M$$", []), ("d:p1:b1", "d", 1, "paragraph", None, "где M - масса 5 кг", []),
        ("d:p2:b0", "d", 2, "formula", None, "$$N$$", []), ("d:p3:b0", "d", 3, "paragraph", None, "где N - число", []),
        ("e:p1:b0", "e", 1, "list", None, "1) а", []), ("e:p1:b1", "e", 1, "list", None, "2) б", []), ("e:p2:b0", "e", 2, "list", None, "3) в", []),
    ]
    got = {r.chunk_id: r for r in C.enrich(spark.createDataFrame(rows, schema)).collect()}
    assert sorted(got) == ["d:p1:b0", "d:p2:b0", "d:p3:b0", "e:p1:b0", "e:p2:b0"]
    assert got["d:p1:b0"].formula_vars == "где M - масса 5 кг" and [tuple(e) for e in got["d:p1:b0"].entities] == [("measurement", "5 кг")]
    assert got["e:p1:b0"].text == "1) а\n2) б" and got["d:p2:b0"].formula_vars is None


def test_blank_delivery_does_not_win(spark):
    got = built(spark, ("d", 1, ""), ("d", 1, "Это текст."), ("d", 1, " \n\xa0"), ("d", 1, None), ("d", 2, ""), ("d", 2, None))
    assert {k: r.text for k, r in got.items()} == {"d:p1:b0": "Это текст."}


def test_empty(spark):
    empty = pages(spark).filter(F.lit(False))
    assert C.structural_chunks(empty).count() == 0 and C.enrich(C.structural_chunks(empty)).count() == 0


def test_of_differing_deliveries_the_last_full_one_counts(spark):
    rows = [("d", 1, "Первый текст здесь.", "2020-01-02"), ("d", 1, "Абзац, что был раньше.", "2020-01-01"), ("d", 1, "  ", "2020-01-03"), ("e", 1, "Без времени.", None), ("e", 1, "Со временем тут.", "2020-01-01")]
    pages = spark.createDataFrame(rows, "source_id string, page int, text string, loaded_at string")
    assert {r.doc_id: r.text for r in C.structural_chunks(pages).collect()} == {"d": "Первый текст здесь.", "e": "Со временем тут."}


def test_python_runs_once_per_stage(spark):
    """Blocks and folds are written once, so that what is built on them runs in the JVM; enrichment adds one fold."""
    pages = spark.createDataFrame([("d", 1, "Текст здесь.")], "source_id string, page int, text string")
    stages = lambda df: df._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow")
    made = C.structural_chunks(pages)
    assert stages(made) == 0 and stages(C.enrich(made)) == 1
