import re

import numpy as np
import pandas as pd

from pagemill.llm import charmodel as M
from pagemill.llm import garbled as G

SCHEMA = "page_id long, source_id string, parser string, text string, cipher string, token string"
TEXT = (
    "Водопользователь утвердил рыбозащитные устройства на территории округа, поскольку предыдущие измерения проводились с нарушением установленной периодичности. "
    "Испытательная лаборатория опубликовала удельные показатели образования золы вблизи озера, пока ледовый покров позволял безопасно подвозить буровое оборудование. "
    "Эксплуатирующая организация направила сертификат поверки газоанализатора за ограждением цеха, после чего уведомление передаётся в диспетчерскую службу бассейна. "
    "Местная администрация пересчитала запас реагентов на полигоне, так как действующее оборудование не обеспечивает проектную степень очистки. "
    "Общественные наблюдатели согласовали данные о содержании взвешенных веществ в районе посёлка; экспертная группа уточнила паспорт очистных сооружений, щебень и съёмку."
)


def swap(text, written, misread):
    return "".join(_glyph(b, misread) for b in text.encode(written, "replace"))


def _glyph(b, page):
    try:
        return bytes([b]).decode(page)
    except UnicodeDecodeError:
        return chr(b)


def frame(spark, rows):
    return spark.createDataFrame([(i, s, p, t, "c", "t") for i, (s, p, t) in enumerate(rows)], SCHEMA)


SWAPS = [("utf-8", "cp1252"), ("utf-8", "cp1251"), ("utf-8", "cp866"), ("utf-8", "koi8_r"), ("cp1251", "latin_1"), ("koi8_r", "latin_1"), ("koi8_r", "cp1251"), ("cp1251", "koi8_r")]


def test_finds_and_restores_every_swap(spark):
    clean = [("s", "a", TEXT)] * 80
    bad = [(f"x{i}", "a", swap(TEXT, *s)) for i, s in enumerate(SWAPS)]
    rows = frame(spark, clean + bad)
    assert sorted(r.page_id for r in G.found_pages(rows).collect()) == list(range(80, 80 + len(bad)))
    out = {r.page_id: r for r in G.restored_pages(rows).collect()}
    for i in range(80, 80 + len(bad)):
        got, want = out[i].text.split(), TEXT.split()
        assert len(got) == len(want)
        # the two purely Cyrillic swaps leave words under four letters as they are
        assert np.mean([a == b for a, b in zip(got, want)]) > (0.75 if i >= 80 + 6 else 0.97), (SWAPS[i - 80], out[i].text[:200])
    assert all(out[i].text == TEXT and out[i].n_restored == 0 for i in range(80))


def test_single_words_and_signs(spark):
    bad = ["участок â„– 5", "цех в„– 7", "Â«Торотноe»", "цех ¹ 9", "слово îáðàçîâàíèÿ тут", "сл�во", "мг/мВі"]
    good = ["Насос fabriqué en atelier", "прибор Ångström, 5 µg/м³ и 3 °C", "№ 5 – «да» — ½…", "В декабре", "ВСЕ ПРАВА СОХРАНЯЮТСЯ", "résumé naïve façade", "│ a │ b │", None, ""]
    rows = frame(spark, [("s", "a", TEXT + " Объект № 5, «цех № 9», проба № 7 объёмом 3 м³.")] * 5 + [("s", "a", t) for t in bad + good] + [("s", "yolo_doctr", "сл�во"), (None, None, bad[0])])
    got = sorted(r.page_id for r in G.found_pages(rows).collect())
    assert got == [*range(5, 5 + len(bad)), 5 + len(bad) + len(good) + 1]


def test_mapping_is_learned_without_code_pages():
    """A random substitution of letters, with nothing known of it, is mostly found from bigrams."""
    words = re.findall("[а-яё]+", TEXT.lower()) * 40
    joint = np.full((34, 34), 0.05)
    pairs = {}
    shift = {c: chr(0x2600 + i) for i, c in enumerate(np.random.RandomState(5).permutation(list(M.LETTERS)))}
    for w in words:
        nums = [0, *(M.NUMBER[c] for c in w), 0]
        coded = ["", *(shift[c] for c in w), ""]
        for k in range(len(nums) - 1):
            joint[nums[k], nums[k + 1]] += 1
            pairs[coded[k], coded[k + 1]] = pairs.get((coded[k], coded[k + 1]), 0) + 1
    frame_ = pd.DataFrame([(*k, n) for k, n in pairs.items()], columns=["a", "b", "n"])
    found = G.learn_mapping(frame_, "unknown", np.log(joint / joint.sum()))
    used = "".join(words)
    assert np.mean([found[shift[c]] == c for c in used]) > 0.95


def private_swap(text):
    """A code page that is not public: the letters in an order of their own on the accented letters of Latin-1."""
    order = np.random.RandomState(3).permutation(list(M.LETTERS))
    table = dict(zip(order, "".join(chr(c) for c in range(0xE0, 0x100) if c != 0xF7) + "žš"))
    return text.lower().translate({ord(k): v for k, v in table.items()})


def other_words(seed, n=60):
    words = sorted(set(re.findall("[А-Яа-яё]{2,}", TEXT)))  # a lone letter can become an ordinary sign, as × or ÷
    return " ".join(np.random.RandomState(seed).choice(words, n))


def test_a_swap_that_no_code_page_knows_is_restored_from_its_source(spark, monkeypatch):
    clean = [("s", "a", TEXT), ("t", "a", TEXT)] * 20
    plain = [other_words(i) for i in range(12)]
    rows = frame(spark, clean + [("hidden", "a", private_swap(t)) for t in plain] + [("known", "a", swap(t, "cp1251", "latin_1")) for t in plain[:2]])
    out = {r.page_id: r.text for r in G.restored_pages(rows).collect()}
    assert np.mean([a == b for i, t in enumerate(plain) for a, b in zip(out[40 + i], t.lower())]) > 0.95
    assert out[52] == plain[0] and out[53] == plain[1]
    assert {r.page_id for r in G.found_pages(rows).collect()} == set(range(40, 54))
    monkeypatch.setattr(G, "_mappings", lambda pairs, joint: spark.createDataFrame([], "source_id string, cipher string, `from` string, `to` string"))
    assert G.found_pages(rows).count() == 0  # without the learned mappings nothing is found


def test_two_swaps_on_one_page(spark):
    a, b = other_words(1, 30), other_words(2, 8)
    rows = frame(spark, [("s", "a", TEXT)] * 20 + [("s", "a", swap(a, "koi8_r", "latin_1") + " " + swap(b, "cp1251", "latin_1"))])
    assert {r.page_id: r.text for r in G.restored_pages(rows).collect()}[20] == f"{a} {b}"


def test_scanned_pages(spark):
    text = other_words(5, 30)
    rows = frame(spark, [("s", "a", TEXT)] * 20 + [("s", "yolo_doctr", swap(text, "koi8_r", "cp1251")), ("s", "yolo_doctr", TEXT + " ЩРОБ"), ("s", "yolo_doctr", TEXT)])
    assert [r.page_id for r in G.found_pages(rows).collect()] == [20]


def test_empty(spark):
    assert G.found_pages(frame(spark, [])).count() == 0 and G.restored_pages(frame(spark, [])).count() == 0
