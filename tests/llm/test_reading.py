import random

from pagemill.llm import reading as R

LEVELS = {
    1: ["Кот пьёт воду.", "Мы идём в лес.", "Снег лёг на поле."],
    2: ["Надзорный орган проверил журнал дежурных смен за ограждением цеха.", "Хозяйство утвердило герметичность трубопроводов в марте прошлого года."],
    3: ["Лесничество согласовало показания расходомеров на водосборе, пока ледовый покров позволял подвозить оборудование, а содержание сульфатов не превысило нормы прошлого года."],
    4: ["В целях обеспечения соблюдения установленных экологических требований, а также с учётом результатов государственной экспертизы, признаётся обязательным перераспределение лимитов на размещение отходов между структурными подразделениями, поскольку предыдущие измерения проводились с нарушением установленной периодичности, если иное не предусмотрено соглашением сторон."],
}


def corpus(n=120, seed=1):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        band = i % 4 + 1
        text = " ".join(rnd.choices(LEVELS[band], k=12))
        rows.append((i, text + (" The fox ran home. Mum fed the birds." if i % 5 == 0 else ""), band))
    return rows


def frames(spark, rows, label):
    docs = spark.createDataFrame([(i, t, 9, "w") for i, t, _ in rows], "doc_id long, text string, band int, word string")
    return docs, spark.createDataFrame([(i, b, f"r{k}") for i, _, b in rows if label(i) for k in range(2)] + [(0, None, "r"), (999999, 1, "r"), (0, 1, "r0"), (0, 1, "r0")], "doc_id long, band int, rater string")


def test_held_out_accuracy(spark):
    rows = corpus()
    docs, labels = frames(spark, rows, lambda i: i % 3 == 0)
    got = {r.doc_id: r.band for r in R.reading_bands(docs, labels).collect()}
    held = [i for i, _, _ in rows if i % 3]
    assert len(got) == len(rows) and sum(got[i] == rows[i][2] for i in held) / len(held) > 0.9


def test_joined_ranks_give_the_same(spark, monkeypatch):
    docs, _ = frames(spark, corpus(24), lambda i: True)
    first = {r.doc_id: round(r.f_rank, 6) for r in R.features(docs).collect()}
    monkeypatch.setattr(R, "BROADCAST_WORDS", -1)
    assert {r.doc_id: round(r.f_rank, 6) for r in R.features(docs).collect()} == first


def test_odd_texts(spark):
    odd = [(1, None), (2, ""), (3, "мало слов"), (4, "12 " * 30), (5, "слово " * 20000), (6, "\n\t " * 50)]
    docs = spark.createDataFrame(odd, "doc_id long, text string")
    _, labels = frames(spark, corpus(8), lambda i: True)
    full = docs.unionByName(spark.createDataFrame([(100 + i, t) for i, t, _ in corpus(8)], "doc_id long, text string"))
    labels = labels.selectExpr("doc_id + 100 as doc_id", "band", "rater")
    got = {r.doc_id for r in R.reading_bands(full, labels).collect()}
    assert got == {4, 5, *range(100, 108)}
    assert R.reading_bands(docs, labels.limit(0)).count() == 0 and R.reading_bands(docs.limit(0), labels).count() == 0
