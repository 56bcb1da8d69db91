import io
import json
import zipfile

import pytest

from pyspark.sql import functions as F

from pagemill.operators.tables import sheet_pages
from pagemill.sources import files, sinks
from pagemill.streaming import ingest


def put(path, *rows):
    path.write_text("\n".join(r if isinstance(r, str) else json.dumps(r, ensure_ascii=False) for r in rows), encoding="utf-8")
    return str(path)


def test_pages(spark, tmp_path):
    path = put(tmp_path / "p.jsonl", {"source_id": "s", "page": 1, "text": "т", "parser": "x"}, "not json", "", {"source_id": "s", "page": "2", "text": None})
    assert sorted((r.page, r.text) for r in files.read_pages(spark, path).collect()) == [(1, "т"), (2, "")]


def test_chunks_are_strict(spark, tmp_path):
    good = put(tmp_path / "c.jsonl", {"chunk_id": "a", "doc_id": "d", "page": 1, "entities": [{"type": "t", "value": "v"}]})
    assert files.read_chunks(spark, good).first().entities[0].value == "v"
    with pytest.raises(Exception):
        files.read_chunks(spark, put(tmp_path / "b.jsonl", {"chunk_id": "a"}, "broken")).collect()


def xlsx():
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    rel = 'xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook {ns} {rel}><sheets><sheet name="Лист" r:id="r1"/><sheet name="Пусто" r:id="r2"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<R><R Id="r1" Target="worksheets/s1.xml"/><R Id="r2" Target="worksheets/s2.xml"/></R>')
        z.writestr("xl/sharedStrings.xml", f"<sst {ns}><si><t>имя</t></si><si><r><t>а</t></r><r><t>б</t></r></si></sst>")
        z.writestr("xl/worksheets/s1.xml", f'<worksheet {ns}><sheetData><row><c r="A1" t="s"><v>0</v></c><c r="C1" t="s"><v>0</v></c></row><row><c r="A2" t="s"><v>1</v></c><c r="B2"><v>5</v></c></row></sheetData></worksheet>')
        z.writestr("xl/worksheets/s2.xml", f"<worksheet {ns}><sheetData/></worksheet>")
    return out.getvalue()


def test_sheets(spark, tmp_path):
    (tmp_path / "a.xlsx").write_bytes(xlsx())
    (tmp_path / "b.csv").write_text('x,"y\nz",x\n1,2,\n', encoding="utf-8")
    (tmp_path / "c.xlsx").write_bytes(b"no archive")
    cells = files.read_sheets(spark, str(tmp_path))
    got = sorted((r.source_id, r.sheet, r.row_idx, list(r.cells)) for r in cells.collect())
    assert got == [("a", "Лист", 0, ["имя", "Unnamed: 1", "имя.1"]), ("a", "Лист", 1, ["аб", "5", ""]), ("b", "Sheet1", 0, ["x", "y\nz", "x.1"]), ("b", "Sheet1", 1, ["1", "2", ""])]
    assert sheet_pages(cells).filter("source_id = 'b'").first().text == "# Лист: Sheet1\n\n[Таблица]\n| x | y z | x.1 |\n| --- | --- | --- |\n| 1 | 2 |  |"


def test_office_and_text(spark, tmp_path):
    w = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'
    cell = lambda t: f"<w:tc><w:p><w:r><w:t>{t}</w:t></w:r></w:p></w:tc>"
    with zipfile.ZipFile(tmp_path / "a.docx", "w") as z:
        z.writestr("word/document.xml", f"<w:document {w}><w:body><w:p><w:r><w:t>Один</w:t></w:r></w:p><w:p/><w:tbl><w:tr>{cell('a|b')}{cell('c')}</w:tr><w:tr>{cell('')}{cell('')}</w:tr></w:tbl><w:p><w:r><w:t>Два</w:t></w:r></w:p></w:body></w:document>")
    (tmp_path / "b.rtf").write_bytes(rb"{\rtf1\ansi\ansicpg1251{\fonttbl{\f0 Arial;}}\'cf\'f0\'e8\par " + b"\\u1074?" + rb"et \{x\}}")
    (tmp_path / "c.docx").write_bytes(b"x")
    (tmp_path / "d.txt").write_bytes("да\n\n\n\nнет ".encode() + b"\xff")
    got = {r.source_id: r.text for r in files.read_office(spark, str(tmp_path)).collect()}
    assert got == {"a": "Один\n\nДва\n\n| a\\|b | c |", "b": "При\nвet {x}", "c": ""}
    assert files.read_texts(spark, str(tmp_path / "d.txt")).first().text == "да\n\nнет �"


def test_documents_are_replaced(spark, tmp_path):
    schema = "doc_id string, page int, text string"
    sinks.write_documents(spark.createDataFrame([("a", 1, "x"), ("b", 1, "y")], schema), str(tmp_path / "out"))
    sinks.write_documents(spark.createDataFrame([("b", 2, "z")], schema), str(tmp_path / "out"))
    assert sorted((r.doc_id, r.page) for r in sinks.read_documents(spark, str(tmp_path / "out")).collect()) == [("a", 1), ("b", 2)]
    sinks.write_documents(spark.createDataFrame([("a", p, "x") for p in (3, 1, 2)] + [(None, 1, "n")], schema), str(tmp_path / "out"), buckets=256)
    assert sorted((r.doc_id, r.page) for r in sinks.read_documents(spark, str(tmp_path / "out")).collect()) == [("a", 1), ("a", 2), ("a", 3), ("b", 2)]
    assert len(list((tmp_path / "out").glob("bucket=*"))) == 2


def test_documents_of_one_bucket_stay(spark, tmp_path):
    schema = "doc_id string, page int, text string"
    for rows in ([(f"d{i}", 1, "x") for i in range(20)], [("d3", 2, "y"), ("e", 1, "z")]):
        sinks.write_documents(spark.createDataFrame(rows, schema), str(tmp_path / "out"), buckets=2)
    assert sorted((r.doc_id, r.page) for r in sinks.read_documents(spark, str(tmp_path / "out")).collect()) == sorted([(f"d{i}", 2 if i == 3 else 1) for i in range(20)] + [("e", 1)])


def test_sanitized_at_any_depth(spark):
    bad = F.expr("cast(X'61ff62' as string)")
    row = spark.range(1).select(bad.alias("a"), F.array(bad).alias("b"), F.struct(bad.alias("x"), F.array(F.struct(bad.alias("y"))).alias("z")).alias("c"), F.create_map(bad, bad).alias("d"), F.lit(None).cast("struct<x:string>").alias("e"), F.col("id"))
    got = sinks.sanitized(row).first()
    assert got.a == "a�b" and got.b == ["a�b"] and got.c.x == "a�b" and got.c.z[0].y == "a�b" and got.d == {"a�b": "a�b"} and got.e is None and got.id == 0


def test_registry_and_old_text_files(spark, tmp_path):
    (tmp_path / "r.csv").write_text("source_id,file_path,other\na,a.txt,1\n")
    assert [tuple(r) for r in files.read_registry(spark, str(tmp_path / "r.csv")).collect()] == [("a", "a.txt", None)]
    (tmp_path / "old.txt").write_bytes("Привет".encode("cp1251"))
    (tmp_path / "new.txt").write_bytes("\ufeffПривет".encode())
    assert {r.source_id: r.text for r in files.read_texts(spark, str(tmp_path / "*.txt"), detect=True).collect()} == {"old": "Привет", "new": "Привет"}


def test_manifests(spark):
    reg = spark.createDataFrame([("a", "a.txt", "txt"), ("b", "b.txt", "txt")], "source_id string, file_path string, format string")
    pages = spark.createDataFrame([("a", 1), ("a", 2)], "source_id string, page int")
    assert sorted((r.source_id, r.status, r.page_count) for r in sinks.manifests_of(reg, pages, "light", "x").collect()) == [("a", "ok", 2), ("b", "empty", 0)]


def test_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    put(tmp_path / "in" / "1.jsonl", {"source_id": "d", "page": 1, "text": "ГЛАВА ПЕРВАЯ ОБЩАЯ\n\nПервый абзац текста."}, "broken")
    for _ in range(2):
        ingest.chunk_stream(ingest.page_stream(spark, str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination(120)
        put(tmp_path / "in" / "2.jsonl", {"source_id": "e", "page": "1", "text": "Другой документ здесь."})
    assert sorted(r.chunk_id for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["d:p1:b0", "d:p1:b1", "e:p1:b0"]
