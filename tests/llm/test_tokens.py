import os

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pagemill.llm import tokens as T

FILE = f"{T.TOKENIZERS}/byte_bpe_50k.json"
TEXTS = [None, "", " ", "\n\n  \t", "<|endoftext|> и <|x|>", "Привет, мир! 😀 naïve", "a" * 5000, "it's we'll\r\n x", "́​", "слово " * 300, "١٢٣ ½ ² Ⅳ", "'s't", "   конец   "]


def expected(texts):
    tokenizers = pytest.importorskip("tokenizers")
    if not os.path.exists(FILE):
        pytest.skip("no vocabulary files")
    t = tokenizers.Tokenizer.from_file(FILE)
    t.encode_special_tokens = True
    return [e.ids for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


@pytest.mark.parametrize("most", [0, 3, 50_000])
def test_same_ids_whatever_the_lexicon(spark, most):
    rows = spark.createDataFrame([(i, t, "x", [1]) for i, t in enumerate(TEXTS)] + [(0, None, "x", [1])], "doc_id long, text string, word string, ids array<int>")
    got = sorted((r.doc_id, list(r.ids)) for r in T.encode(rows, most=most).collect())
    assert got == sorted([*enumerate(expected(TEXTS)), (0, [])])


def test_empty(spark):
    assert T.encode(spark.createDataFrame([], "doc_id long, text string")).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.binary(min_size=1, max_size=6), st.lists(st.integers(0, 9), min_size=1, max_size=3), max_size=40), st.lists(st.binary(max_size=6), max_size=10))
def test_transducer(words, others):
    lexicon = T.Lexicon.build(words)
    asked = [*words, *others]
    place = lexicon.find(asked) if asked else []
    for w, p in zip(asked, place):
        assert (p >= 0) == (w in words)
        if p >= 0:
            assert lexicon.ids[lexicon.start[p]:lexicon.start[p + 1]].tolist() == words[w]


def test_transducer_is_minimal_and_maps(tmp_path):
    words = {f"{a}{b}ing".encode(): [i] for i, (a, b) in enumerate((a, b) for a in "abcdef" for b in "xyz")}
    lexicon = T.Lexicon.build(words)
    assert len(lexicon.final) == 7  # one state a letter, whatever the number of words, and the unused place of the root
    (tmp_path / "l.bin").write_bytes(lexicon.to_bytes())
    assert T.Lexicon.map_file(str(tmp_path / "l.bin")).find(list(words)).tolist() == lexicon.find(list(words)).tolist()
