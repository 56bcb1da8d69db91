from itertools import product

import pytest

from pagemill.llm import scans as S

SCHEMA = "page_id long, source_id string, page int, text string, parser string, word string, n long, noise string"
BODY = [
    "Испытательная лаборатория опубликовала удельные показатели", "образования золы вблизи озера, пока ледовый покров позволял", "безопасно подвозить буровое оборудование. Проект нормативов",
    "утвердил надзорный орган за ограждением цеха № 34. Санитарно-защитная", "зона и обеспечения соблюдения экологических требований для точки 34б.",
]


def frame(spark, rows):
    return spark.createDataFrame([(i, s, p, t, q, "w", 1, "x") for i, (s, p, t, q) in enumerate(rows)], SCHEMA)


def page(*lines):
    return "\n".join([*lines, *BODY])


@pytest.mark.parametrize("token,bad", [("норм~тивов", 1), ("газ�анализатора", 1), ("взвеше|ных", 1), ("превьісило", 1), ("снижениіо", 1), ("н0рмативов", 1), ("Согласн0", 1), ("2О15", 1), ("З00", 1), ("34б", 0), ("мкг/м3", 0), ("3-го", 0), ("SO2", 0), ("№", 0), ("|", 0), ("слово", 0), ("5", 0), ("~", 0)])
def test_tokens_by_their_signs(token, bad):
    assert S.glyph_token(token) == bool(bad)


def test_no_token_is_lost_before_its_signs_are_looked_at():
    made = ["".join(x) for k in range(1, 6) for x in product("оЗб5,-іІь|~", repeat=k)] + ["О,5", "5,О", "З/12", "7–З", "ЬІ", "ІО", "СНИЖЕНІО"]
    lost = [t for t in made if S.glyph_token(t) and not S._SUSPECT.search(t)]
    assert not lost and all(map(S.glyph_token, made[-7:]))
    assert not any(map(S.glyph_token, ["ТЭЦ-3", "Луч-40", "5-б", "5/б"]))


def test_broken_numbers_of_pages(spark):
    rows = [("d", i, f"Содержание {t} единиц", S.SCANNED) for i, t in enumerate(["О,5", "5,О", "З/12", "7–З", "0,5"])]
    assert sorted(r.page_id for r in S.found_noise(frame(spark, rows)).collect() if r.noise == "glyph") == [0, 1, 2, 3]


@pytest.mark.parametrize("line,page,own", [("— 8 —", 8, 1), ("- 8 -", 8, 1), ("[24]", 24, 1), ("с. 1 из 28", 1, 1), ("Стр. 5", 5, 1), ("8 / 28", 8, 1), ("    7", 7, 1), ("с. 1О из 28", 10, 1), ("[24]", 8, 0), ("№ 13.", 13, 0), ("13.", 13, 0), ("1. Глава", 1, 0), ("8", None, 0), ("", 1, 0)])
def test_own_numbers(line, page, own):
    assert S.is_own_number(line, page) == bool(own)


def test_noise_of_pages(spark):
    clean = [("c", p, page(), "light") for p in range(30)]
    run = [("r", p, page("Отчёт по объекту «Лесной» " + str(p) if p % 3 else "ОТЧЁТ ПО ОБЪЕКТУ «ЛЕСНОЙ» 7", f"— {p} —" if p < 4 else "Начало"), S.SCANNED) for p in range(1, 10)]
    other = [
        ("d", 1, page("Текст с об0рудованием и пормативов здесь"), S.SCANNED),
        ("d", 2, page("Санитарно-\nзащитная зона"), S.SCANNED),
        ("d", 3, page("Испытатель-\nная лаборатория"), S.SCANNED),
        ("d", 4, page("Испытатель¬ \nная лаборатория"), S.SCANNED),
        ("d", 5, page() + " опубли-", S.SCANNED),
        ("d", 6, page() + " Санитарно-", S.SCANNED),
        ("d", 7, None, S.SCANNED), ("d", 8, "", S.SCANNED), (None, None, page("обеснечения"), S.SCANNED), ("d", 9, page("обеснечения"), None),
    ]
    other = [(s and f"{s}{p // 3}", p, t, q) for s, p, t, q in other]  # too few pages for running lines
    rows = clean + run + other
    got = {}
    for r in S.found_noise(frame(spark, rows)).collect():
        got.setdefault(r.page_id, set()).add(r.noise)
    want = {30 + i: {"running"} | ({"page_number"} if i < 3 else set()) for i in range(9)}
    want |= {39: {"glyph"}, 41: {"hyphen"}, 42: {"hyphen"}, 43: {"hyphen"}, 47: {"glyph"}}
    assert got == want


def test_repaired(spark):
    rows = [("c", p, page(), "light") for p in range(30)] + [("r", p, page("Отчёт по объекту «Лесной»", f"с. {p} из 9"), S.SCANNED) for p in range(1, 9)]
    rows += [("d", 1, "Испытатель-\nная лаборат0рия опублико-\nвала обеснечения\n\nСанитарно-\nзащитная зона в 2О15 году", S.SCANNED), ("d", 2, None, S.SCANNED)]
    out = {r.page_id: r.text for r in S.repaired(frame(spark, rows)).collect()}
    assert out[38] == "Испытательная лаборатория опубликовала обеспечения\n\nСанитарно-защитная зона в 2015 году"
    assert out[30].startswith("Испытательная лаборатория опубликовала удельные показатели образования золы") and out[39] is None and out[0] == rows[0][2]


def glyphs(spark, rows):
    return {r.page_id for r in S.found_noise(frame(spark, rows)).collect() if r.noise == "glyph"}


def test_vectors_decide_what_is_a_misreading(spark, monkeypatch):
    """Of two rare words that one glyph edit turns into a frequent one, only the one in its surroundings is a misreading."""
    rows = [("c", p, f"Объект № {p}: {BODY[0]}\nутром выдан полный ведомственный отчёт начальнику цеха\nвечером пойман крупный речной налим рыбаками артели", S.SCANNED) for p in range(60)]
    rows += [("d", 1, "утром выдан полный ведомственный огчёт начальнику цеха", S.SCANNED), ("d", 2, "вечером пойман крупный речной огчёт рыбаками артели", S.SCANNED)]
    rows += [("d", 3, "Объект № 4О: Испытательная лаборатория", S.SCANNED), ("d", 4, "утром вы~ан полный ведомственный", S.SCANNED)]
    rows = [(f"{s}{i % 20}", p, t, q) for i, (s, p, t, q) in enumerate(rows)]
    assert glyphs(spark, rows[:61] + rows[62:]) == {60, 61, 62}  # the misread word, number and mark
    assert glyphs(spark, rows[:60] + rows[61:62]) == set()

    class Empty(S.SkipGram):
        def __init__(self, matrix):
            super().__init__(matrix)
            self.axes, self.classes = self.axes * 0, self.classes * 0

    monkeypatch.setattr(S, "SkipGram", Empty)
    assert glyphs(spark, rows) == set()  # without vectors nothing is one


def test_links_are_those_of_glyph_edits(spark):
    words = [("превысило", 900), ("превысипо", 1), ("прсвысило", 1), ("нрснысило", 1), ("нрснысипо", 1), ("превьісил0", 2), ("прев~сило", 1), ("прев~си~о", 1), ("п~ев~си~о", 1), ("сом", 400), ("сон", 1), ("кит", 40), ("киг", 1), ("завол", 300), ("завод", 300)]
    counts = spark.createDataFrame([*words, ("пре\x01высило", 1)], "word string, n long")
    links = {(r.word, r.reading) for r in S.link_words(counts, S.judge_breaks(counts)).collect()}
    assert links == {(w, "превысило") for w in ("прсвысило", "превьісил0", "прев~сило", "прев~си~о")}
    assert S.plausible("нрснысило", "превысило") is False and S.plausible("нрсвысило", "превысило") and not S.plausible("киг", "кот")


def test_words_broken_at_the_page_end(spark):
    rows = [("c", p, page(), "light") for p in range(30)]
    first, last = "Начало текста", "Конец текста."
    over = [
        ("d", 1, f"{first}\nопублико-", S.SCANNED), ("d", 2, f"  вала, здесь\n{last}", S.SCANNED),  # joined, its punctuation with it
        ("d", 3, f"{first} Санитарно-\n\n", S.SCANNED), ("d", 4, f"защитная\n{last}", S.SCANNED), ("d", 4, f"защитная\n{last}", S.SCANNED),  # own hyphen, two deliveries
        ("e", 1, f"{first} зона и обес-", S.SCANNED), ("e", 2, f"нече¬\nния тут\n\n{last}", S.SCANNED),  # misread and broken again
        ("e", 3, f"{first} опублико-", S.SCANNED), ("e", 4, f"Вала\n{last}", S.SCANNED),  # nothing carries it on
        ("e", 6, f"{first} опублико-", S.SCANNED), ("e", 8, f"вала\n{last}", S.SCANNED), ("f", 7, f"вала\n{last}", S.SCANNED),  # page 7 of the source is missing
        ("g", 1, f"{first} опублико-", S.SCANNED), ("g", 2, f"вала\n{last}", "light"), (None, 1, f"{first} опублико-", S.SCANNED), (None, 2, f"вала\n{last}", S.SCANNED),
        ("h", 1, f"{first} ОПУБЛИ-", S.SCANNED), ("h", 2, f"КОВАЛА\n{last}", S.SCANNED),
    ]
    run = [("r", p, f"Отчёт по объекту «Лесной»\nс. {p} из 9\nвала данные\nи показатели\n{BODY[p % 5]} опублико–", S.SCANNED) for p in range(1, 9)]
    out = {r.page_id: r.text for r in S.repaired(frame(spark, rows + over + run)).collect()}
    assert [out[30 + i] for i in range(len(over))] == [
        f"{first} опубликовала,", f"здесь {last}", f"{first} Санитарно-защитная", last, last, f"{first} зона и обеспечения", f"тут\n\n{last}", f"{first} опублико-", f"Вала {last}",
        f"{first} опублико-", f"вала {last}", f"вала {last}", f"{first} опублико-", f"вала\n{last}", f"{first} опублико-", f"вала {last}", f"{first} ОПУБЛИКОВАЛА", last,
    ]
    at = 30 + len(over)
    assert out[at].startswith("вала данные ") and out[at].endswith(" опубликовала")
    assert all(out[at + i].startswith("данные ") and out[at + i].endswith(" опубликовала" if i < 7 else " опублико–") for i in range(1, 8))


def test_empty(spark):
    assert S.found_noise(frame(spark, [])).count() == 0 and S.repaired(frame(spark, [])).count() == 0
