import random

from pagemill.llm import leaks as L

WORDS = [f"слово{i}" for i in range(60)]


def brute(docs, items):
    out = set()
    for d, text in docs:
        words = L.words_of(text or "")
        grams = {tuple(words[i:i + 12]) for i in range(len(words) - 11)}
        for k, item in items:
            w = L.words_of(item or "")
            if d is not None and k is not None and any(tuple(w[i:i + 12]) in grams for i in range(len(w) - 11)):
                out.add((d, k))
    return sorted(out)


def run(spark, docs, items, f=L.leaked_items):
    return f(spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, item_id long"), spark.createDataFrame([(*i, "x") for i in items], "item_id long, text string, doc_id string"))


def data():
    rnd = random.Random(2)
    items = [(k, " ".join(rnd.choices(WORDS, k=rnd.randint(8, 40)))) for k in range(15)] + [(90, None), (91, ""), (92, "ёж"), (None, " ".join(WORDS))]
    docs = []
    for d in range(60):
        text = rnd.choices(WORDS, k=rnd.randint(0, 60))
        if d % 3 == 0:
            w = L.words_of(items[rnd.randrange(15)][1])
            n = rnd.choice([11, 12, 13, len(w)])
            text[5:5] = [x.upper() for x in w[:n]]
        docs.append((d, rnd.choice([" ", ", ", "\n— "]).join(text)))
    return docs + [(100, None), (101, ""), (102, "."), (None, " ".join(WORDS)), (0, docs[0][1])], items


def test_brute_force(spark):
    docs, items = data()
    assert sorted((r.doc_id, r.item_id) for r in run(spark, docs, items).collect()) == brute(docs, items)


def test_places_in_parts(spark, monkeypatch):
    """Repetitive text, where every suffix of an item stands in very many places."""
    docs = [(1, "а б " * 300), (2, "а " * 200 + "б " * 200), (3, "б " * 11)]
    items = [(7, "а б " * 20), (8, "а " * 30)]
    first = sorted(run(spark, docs, items, L.longest_matches).collect())
    assert [tuple(r) for r in first] == [(1, 7, 40, 0, 0), (2, 8, 30, 0, 0)]
    docs, items = data()
    whole = sorted(run(spark, docs, items, L.longest_matches).collect())
    table = L.Items([(1, "а б " * 20), (2, "а " * 30)])
    tokens = L.np.array([table.number[w] for w in L.words_of("а " * 50 + "а б " * 30)] + [-1])
    for places in (1, 7, 1000):
        monkeypatch.setattr(L, "PLACES", places)
        found = {tuple(int(x) for x in m) for part in table.search(tokens, L.np.arange(len(tokens) - 1)) for m in zip(*part)}
        assert {(0, 50, 40, 0), (1, 0, 30, 0)} <= found and len(found) < 200
    assert sorted(run(spark, docs, items, L.longest_matches).collect()) == whole


def test_blocks_and_shards(spark, monkeypatch):
    docs, items = data()
    first = sorted(run(spark, docs, items).collect())
    monkeypatch.setattr(L, "BLOCK_CHARS", 300)
    assert sorted(run(spark, docs, items).collect()) == first


def test_longest_match(spark):
    w = [f"w{i}" for i in range(30)]
    rows = run(spark, [(1, " ".join(["x"] + w[3:20] + ["y"] + w[:13]))], [(7, " ".join(w))]).collect()
    assert [tuple(r) for r in rows] == [(1, 7, 17)]


def test_places_of_the_longest_match(spark):
    w = [f"w{i}" for i in range(30)]
    docs = [(1, " ".join(["x"] * 3 + w[:12] + ["y"] * 2 + w[3:20] + ["y"] + w[3:20])), (2, " ".join(w[5:18]))]
    rows = run(spark, docs, [(6, " ".join(["z"] * 13)), (7, " ".join(w))], L.longest_matches).collect()
    assert sorted(tuple(r) for r in rows) == [(1, 7, 17, 17, 3), (2, 7, 13, 0, 5)]


def test_letters(spark):
    assert L.words_of("Ёлка, ПДК-1 м³ a_b") == ["елка", "пдк", "1", "м³", "a", "b"]


def test_without(spark):
    docs, items = data()
    bad = {d for d, _ in brute(docs, items)}
    kept = run(spark, docs, items, L.without_leaks).collect()
    assert sorted(str(r.doc_id) for r in kept) == sorted(str(d) for d, _ in docs if d not in bad)


def test_empty(spark):
    docs, items = data()
    assert run(spark, [], items).count() == 0 and run(spark, docs, []).count() == 0
