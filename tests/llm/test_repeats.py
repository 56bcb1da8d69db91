from collections import defaultdict
import re

from pagemill.llm import repeats as R

SCHEMA = "page_id long, source_id string, page int, text string, key string, word long, bits long"


def frame(spark, rows):
    return spark.createDataFrame([(i, s, p, t, "k", 1, 1) for i, (s, p, t) in enumerate(rows)], SCHEMA)


def key(line):
    return re.sub("[0-9]+", "0", re.sub("[ \t]+", " ", line.strip()).lower())


def brute(rows):
    pages, where = defaultdict(set), defaultdict(set)
    for s, p, t in rows:
        if p is not None:
            pages[s].add(p)
    lines = [(i, s, p, no, line) for i, (s, p, t) in enumerate(rows) for no, line in enumerate((t or "").split("\n"), 1) if sum(c.isalpha() for c in line) >= 10]
    for i, s, p, no, line in lines:
        if p is not None:
            where[s, key(line)].add(p)
    return sorted((i, no) for i, s, p, no, line in lines if len(pages[s]) >= 20 and len(where[s, key(line)]) >= 0.25 * len(pages[s]))


def test_brute_force(spark):
    note = ["Все права сохраняются, выпуск {}", "  ВСЕ  ПРАВА сохраняются, выпуск {}\t", "Все права\tсохраняются, выпуск {}"]
    rows = [("a", p, f"Текст страницы номер {p} свой\n{note[p % 3].format(p)}" if p % 3 else f"Только свой текст {'абвгдеж'[p % 7] * 12}") for p in range(100)]
    rows += [("a", 5, rows[5][2]), ("a", None, "Все права сохраняются, выпуск 7"), ("a", 200, None), ("a", 201, "")]
    rows += [("b", p, "Все права сохраняются, выпуск 1") for p in range(19)] + [(None, p, "Строка без источника тут") for p in range(25)]
    rows += [("c", p, "кратко 1\nОдна четверть страниц ровно" if p < 5 else "x" * 30 + str(p)) for p in range(20)]
    got = sorted((r.page_id, r.line_no) for r in R.repeated_lines(frame(spark, rows)).collect())
    assert got == brute(rows)
    clean = {r.page_id: r for r in R.remove_repeated(frame(spark, rows)).collect()}
    for i, (_, _, t) in enumerate(rows):
        gone = {no for j, no in got if j == i}
        assert clean[i].text == (None if t is None else "\n".join(x for no, x in enumerate(t.split("\n"), 1) if no not in gone)) and clean[i].n_removed == len(gone)


def test_shuffled_lookup_is_the_same(spark, monkeypatch):
    rows = [("a", p, f"Повтор строки здесь\nсвоя {p}") for p in range(70)]
    first = sorted(R.repeated_lines(frame(spark, rows)).collect())
    monkeypatch.setattr(R, "BROADCAST_BYTES", -1)
    assert sorted(R.repeated_lines(frame(spark, rows)).collect()) == first and len(first) == 70


def test_empty(spark):
    assert R.repeated_lines(frame(spark, [])).count() == 0 and R.remove_repeated(frame(spark, [])).count() == 0
