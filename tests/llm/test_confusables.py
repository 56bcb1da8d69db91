from pagemill.llm import confusables as C

SCHEMA = "page_id long, text string, form string, word string, n long"


def frame(spark, *texts):
    return spark.createDataFrame([(i, t, "f", "w", 1) for i, t in enumerate(texts)], SCHEMA)


CASES = [
    ("ＰＭ１０ и ﬁlter", {"full_width"}), ("𝟒𝟓", {"full_width"}), ("посёлок", {"combining"}), ("за́мок", set()), ("охр‌ана, кв\xadартал", {"zero_width"}),
    ("10 000 и да", {"no_break_space"}), ("тoчки", {"look_alike"}), ("сοставило", {"look_alike"}), ("№ 5 ° µ … ½ м² м³ – «да» —", set()), ("SO2, pH-метр, PM10, QR-код", set()),
    ("Ð\xa0ÐµÐº", set()), ("превьісило", set()), ("", set()), ("мoнитор​инг ﬃ é", {"look_alike", "zero_width", "full_width", "no_break_space", "combining"}),
]


def test_forms(spark):
    got = {}
    for r in C.found_forms(frame(spark, *(t for t, _ in CASES))).collect():
        got.setdefault(r.page_id, set()).add(r.form)
    assert [got.get(i, set()) for i in range(len(CASES))] == [f for _, f in CASES]


def test_the_group_decides(spark):
    """A mixed word all of whose letters have look-alikes takes the spelling that the corpus has; without skeletons nothing is found."""
    latin = ["the CAT and the CAT sat"] * 30
    pages = frame(spark, *latin, "САT", "сaх", *["сах"] * 3)
    assert {r.page_id: r.text for r in C.normalized(pages).collect()}[30] == "CAT"
    greek = frame(spark, *["восток и карта, мера и норма"] * 40, "слово ΚΑΡΤΑ тут", "νοτα")
    assert {(r.page_id, r.form) for r in C.found_forms(greek).collect()} == {(40, "look_alike")}


def test_same_page_same_result_in_a_larger_table(spark):
    few = ["Составлена карта и схема, норма и мера"] * 60
    for times in (1, 4):
        pages = frame(spark, *few * times, *["Слово KAPTA тут"] * times, *["Датчик PM и KOH"] * 3 * times)
        assert {r.page_id for r in C.found_forms(pages).collect()} == set(range(60 * times, 61 * times))


def test_whole_words_by_group_and_model(spark):
    filler = ["Составлена карта и схема, ресурс и восток, текст и норма, мера и осмотр, росток и хаос"] * 40 + ["Датчик CO и CO2"] * 5
    pages = frame(spark, *filler, "Слово KAPTA тут", "слово xaoc", "СО и CO", None, "")
    got = {(r.page_id, r.form) for r in C.found_forms(pages).collect()}
    assert got == {(45, "look_alike"), (46, "look_alike")}


def test_normal_form_and_skeleton(spark):
    filler = ["карта карта карта"] * 40
    out = {r.page_id: r for r in C.normalized(frame(spark, *filler, "Тoчки ＰＭ１０, за́мок, посёлок​ 5\xa0м, KAPTA", "Точки PM10, за́мок, посёлок 5 м, КАРТА", None)).collect()}
    assert out[40].text == "Точки PM10, за́мок, посёлок 5 м, КАРТА" == out[41].text
    assert out[40].skeleton_key == out[41].skeleton_key and out[42].text is None
    assert C.skeleton("СОЅ") == C.skeleton("COS")


def test_empty(spark):
    assert C.found_forms(frame(spark)).count() == 0 and C.normalized(frame(spark)).count() == 0
