"""Garbled text from wrong character encoding.

A wrong decoding is a substitution cipher: each byte (or, for UTF-8, each byte sequence) stands for one letter. Tokens that
may be garbled are cut out of the pages, brought into one symbol per cipher letter, and counted as symbol bigrams per source
and cipher; tokens of a page that read best under the same swap of public code pages, or under none, make up a cipher.
Expectation-maximization then learns, for each source and cipher, which letter a symbol stands for, so that the bigrams fit those of
the corpus' words. It has several starts: the public swap, and the source's own counts without any code page; the
solution with the highest likelihood holds, where one that no code page explains must pay for the choice of its mapping. translate()
applies it. A token counts as garbled if the learned mapping makes it likelier, as letters and signs of the corpus go, than it
was; what its signs look like only adds to the evidence.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemill.llm import charmodel
from pagemill.storage import Scratch

# The glyphs of bytes 80-BF in the code pages through which UTF-8 is most often misread. Byte pairs of UTF-8
# then look like a lead letter followed by one of them. Glyphs that ordinary text has behind such a letter are left out.
_TAIL_1252 = "\x80-\xbf€‚ƒ„…†‡ˆ‰Š‹ŒŽ‘’“”•–—˜™š›œžŸ"
_TAIL_1251 = "ЂЃ‚ѓ†‡€‰ЉЊЌЋЏђ‘’™љњќћџЎўЈ¤Ґ¦©Є®Ї°±Ііґµ¶·єјЅѕї\x98"
_SIGN_1251 = "°±µ·«»§¶ЅѕіІј©®ґ"

_HINT = re.compile("[\x80-\x9f¡-¨ª¬®¯´¶¸¹º¼¾¿À-ÿŒ-Ÿžƒˆ˜‚†-‡‰-‹›€Ђ-ЏђѓљњќћџЈјЅѕҐґЄєЇїЎў─-▟■∙√≈≤≥⌠⌡�]|в[Ђ„€]|В[" + _SIGN_1251 + "]|[РС][" + _TAIL_1251 + "]")
_TOKEN = re.compile(r"[^ \n\t\r]+")
_SURE = re.compile(
    "[\x80-\x9f]"
    "|[ÂÃÐÑÅâ][" + _TAIL_1252 + "]"
    "|[РС][" + _TAIL_1251 + "]"
    "|В[" + _SIGN_1251 + "]|вЂ.|в„[–ў]|в€[’љћ]|в‰[¤Ґ€]"
    "|[─-╬▀-▟■∙√≈≤≥⌠⌡⌂][А-яЁё©0-9A-Za-z÷²°·]|[А-яЁё][─-╬▀-▟■∙√≈≤≥⌠⌡]"
    "|[╒-╓╕-╖╘-╙╛-╟╡-╢╤-╥╧-╨╪-╫]"
    "|[А-яЁё][ЂЃѓЉЊЌЋЏђљњќћџЈјЅѕ]|[ЂЃѓЉЊЌЋЏђљњќћџЈјЅѕ][А-яЁё]"
    "|^\\W*¹\\d*\\W*$|^√$"
)
_LATIN1 = re.compile("[À-ÖØ-öø-ÿŸŒœŠšŽž]")
_ASCII = re.compile("[A-Za-z]")
_UTF8_PAIR = re.compile("[ÂÃÅÆËÐÑâ][" + _TAIL_1252 + "]+")


def is_garbled(token: str, scanned: bool = False) -> bool:
    """Whether a run of signs between blanks was (in part) decoded wrongly, as far as its signs tell.

    Words of Latin script with some accented letters, ordinary signs and the characters that scanning loses are not.
    """
    if _SURE.search(token):
        return True
    if "�" in token and not scanned:
        return True
    accented = len(_LATIN1.findall(token))
    return accented > len(_ASCII.findall(token)) and token.strip(".,;:()[]«»\"'") not in ("Å",)


def garbled_tokens(text: str, scanned: bool = False) -> set[str]:
    """The distinct garbled tokens of a text."""
    if not _HINT.search(text):
        return set()
    return {t for t in set(_TOKEN.findall(text)) if _HINT.search(t) and is_garbled(t, scanned)}


# --- ciphers -------------------------------------------------------------------------------------------------------

#: Code pages in which text is written, and those through which it is misread.
_WRITTEN = ("cp1251", "koi8_r", "cp866", "iso8859_5", "mac_cyrillic")
_MISREAD = ("latin_1", "cp1251", "koi8_r", "cp866")
_UTF8 = ("cp1252", "cp1251", "cp866", "koi8_r", "double")
#: Private-use characters that stand for a byte sequence of UTF-8 by its payload.
_PAYLOAD = 0xF0000
_LETTER = set(charmodel.LETTERS + charmodel.LETTERS.upper())
_CYRILLIC_RUN = re.compile("[А-Яа-яЁё]+")
#: A word that is mostly capitals behind its first letter, as swapped Cyrillic code pages leave it.
_SWAPPED = re.compile("(?<![А-Яа-яЁё])[А-Яа-яЁё]?[А-ЯЁ]{3,}[А-Яа-яЁё]*(?![А-Яа-яЁё])")
_CAPITALS = re.compile("[А-ЯЁ]{3}")
_CAPITALIZED = re.compile("[а-яё]?[А-ЯЁ]+")
#: Mean log-probability below which a word does not read as language, from which on it does, and the least gain.
UNREADABLE, READABLE, GAIN = -4.2, -3.9, 1.0
#: Words of swapped code pages that a scanned page must have; a single one may be misread.
SCANNED_WORDS = 3


@lru_cache(maxsize=None)
def _glyph_bytes(page: str) -> dict[str, int]:
    """Byte of each glyph of a code page; bytes it leaves undefined pass through as control characters."""
    out = {}
    for b in range(256):
        try:
            out[bytes([b]).decode(page)] = b
        except UnicodeDecodeError:
            pass
        out.setdefault(chr(b), b)
    return out


@lru_cache(maxsize=None)
def _single(written: str, misread: str) -> dict[str, str]:
    """What each misread glyph stands for under a swap of two one-byte code pages."""
    out = {}
    for glyph, byte in _glyph_bytes(misread).items():
        if byte >= 0x80:
            try:
                out[glyph] = bytes([byte]).decode(written)
            except UnicodeDecodeError:
                pass
    return out


def _utf8_symbols(token: str, page: str) -> str:
    """Each UTF-8 sequence misread through ``page`` as one private-use symbol; all else stays."""
    if page == "double":
        token = _undo(token, "cp1252")
        page = "cp1252"
    table = _glyph_bytes(page)
    codes = [table.get(c, -1) for c in token]
    out, i = [], 0
    while i < len(token):
        lead = codes[i]
        size = 2 if 0xC2 <= lead < 0xE0 else 3 if 0xE0 <= lead < 0xF0 else 1
        tail = codes[i + 1 : i + size]
        if size > 1 and len(tail) == size - 1 and all(0x80 <= t < 0xC0 for t in tail):
            value = lead & (0x1F if size == 2 else 0x0F)
            for t in tail:
                value = value << 6 | t & 0x3F
            out.append(chr(_PAYLOAD + value))
            i += size
        else:
            out.append(token[i])
            i += 1
    return "".join(out)


def _undo(token: str, page: str) -> str:
    coded = _utf8_symbols(token, page)
    return "".join(chr(ord(c) - _PAYLOAD) if ord(c) >= _PAYLOAD else c for c in coded)


def symbols(token: str, cipher: str) -> str:
    """The token with one character per cipher symbol."""
    return _utf8_symbols(token, cipher[5:]) if cipher.startswith("utf8:") else token


def seed(symbol: str, cipher: str) -> str:
    """The character that the cipher's code pages give for a symbol; the symbol itself where they give none."""
    if ord(symbol) >= _PAYLOAD:
        return chr(ord(symbol) - _PAYLOAD)
    if cipher.startswith("utf8:") or cipher == "unknown":
        return symbol
    return _single(*cipher.split(">")).get(symbol, symbol)


_CIPHERS = [f"utf8:{p}" for p in _UTF8] + [f"{w}>{m}" for w in _WRITTEN for m in _MISREAD if w != m]


@lru_cache(maxsize=None)
def _table(cipher: str) -> dict[int, str]:
    return str.maketrans(_single(*cipher.split(">")))


def _read(text: str, cipher: str) -> str:
    if not cipher.startswith("utf8:"):
        return text.translate(_table(cipher))
    return "".join(chr(ord(c) - _PAYLOAD) if ord(c) >= _PAYLOAD else c for c in symbols(text, cipher))


def _reads(text: str, cond: list[list[float]]) -> tuple[float, int]:
    """Sum of the log-probabilities of the letters in a text's Cyrillic words, and their number; other letters count as impossible."""
    total, count = 0.0, 0
    for run in _CYRILLIC_RUN.findall(text):
        low = run.lower()
        total += charmodel.mean_score(low, cond) * (len(low) + 1) - (2.0 * sum(c.isupper() for c in run[1:]) if not run.isupper() else 0)
        count += len(low) + 1
    odd = sum(1 for c in text if ord(c) > 0x7F and c not in _LETTER and c.isalpha() or "\u2500" <= c <= "\u259f" or "\x80" <= c <= "\x9f")
    return total - 12.0 * odd, count + odd


#: What a token's looks add to the evidence, and what a token must gain by the mapping; both as log-likelihood.
SURE_WORTH, NEED = 4.0, 6.0


def likelihood(text: str, cond: list[list[float]], signs: dict[str, float]) -> float:
    """Log-probability of a token's Cyrillic words by letter bigrams and of its other characters beyond ASCII by their share of the corpus; ``signs[""]``: of one not seen."""
    total = 0.0
    for word in _CYRILLIC_RUN.findall(text):
        low = word.lower()
        total += charmodel.mean_score(low, cond) * (len(low) + 1) - (2.0 * sum(c.isupper() for c in word[1:]) if not word.isupper() else 0)
    none = signs[""]
    return total + sum(signs.get(c, none) for c in text if ord(c) > 0x7F and c not in _LETTER)


#: Ciphers tried first for a group of tokens by its shape; where none of them reads, all are tried.
_LIKELY = {
    "utf": ["utf8:cp1252", "utf8:double"],
    "upper": [f"{w}>latin_1" for w in _WRITTEN],
    "lower": [f"{w}>latin_1" for w in _WRITTEN],
    "swapped": [f"{w}>{m}" for w in _WRITTEN for m in _MISREAD[1:] if w != m],
    "other": ["utf8:cp1251", "utf8:cp866", "utf8:koi8_r"] + [f"{w}>{m}" for w in _WRITTEN for m in _MISREAD[1:] if w != m],
}


def best_cipher(tokens: list[str], shape: str, cond: list[list[float]], signs: dict[str, float]) -> str:
    """The swap of public code pages under which tokens read best together, or whose letters and signs are the likeliest; ``unknown`` where none gains."""
    text = " ".join(sorted(tokens))
    least = likelihood(text, cond, signs) + NEED - SURE_WORTH
    for choice in (_LIKELY[shape], _CIPHERS):
        best, label = least, "unknown"
        for cipher in choice:
            read = _read(text, cipher)
            worth = likelihood(read, cond, signs)
            if worth > best:
                total, count = _reads(read, cond)
                worth -= 6.0 * sum(1 for t in read.split(" ") if is_garbled(t))
                if worth > best and (not count or total / count > -6.0):
                    best, label = worth, cipher
        if label != "unknown":
            return label
    return "unknown"


def ciphers_of(tokens: list[str], shape: str, cond: list[list[float]], signs: dict[str, float]) -> dict[str, str]:
    """Cipher of each token: that of all together, and for those that do not read under it, in turn, their own."""
    out: dict[str, str] = {}
    left = sorted(tokens)
    while left:
        cipher = best_cipher(left, shape, cond, signs)
        out.update(dict.fromkeys(left, cipher))
        if cipher == "unknown":
            break
        odd = []
        for t in left:
            total, count = _reads(_read(t, cipher), cond)
            if count > 4 and total / count < -6.0:
                odd.append(t)
        if len(odd) == len(left):
            break
        left = odd
    return out


def _scan(cond: list[list[float]], signs: dict[str, float]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = lru_cache(maxsize=500_000)(lambda w: charmodel.mean_score(w, cond))
        for batch in batches:
            out: list[tuple] = []
            for page_id, source, parser, text in zip(*(c.to_pylist() for c in batch.columns)):
                if not text:
                    continue
                scanned = parser == "yolo_doctr"
                groups: dict[str, dict[str, bool]] = {}
                for token in garbled_tokens(text, scanned):
                    shape = "utf" if not _LATIN1.search(_UTF8_PAIR.sub("", token)) else "upper" if sum(map(str.isupper, token)) * 2 > sum(map(str.isalpha, token)) else "lower"
                    groups.setdefault(shape if _LATIN1.search(token) else "other", {})[token] = bool(_SURE.search(token) or "�" in token)
                if _CAPITALS.search(text):
                    odd = [w for w in set(_SWAPPED.findall(text)) if len(w) >= 4 and score(w.lower()) < UNREADABLE]
                    if len(odd) >= (SCANNED_WORDS if scanned else 1):
                        groups.setdefault("swapped", {}).update(dict.fromkeys(odd, False))
                strong = set(groups.get("swapped", ()))
                if strong:  # the page's other words of that shape are translated with these, though they are no evidence
                    groups["swapped"].update((w, False) for w in set(_CYRILLIC_RUN.findall(text)) - strong if _CAPITALIZED.fullmatch(w))
                for shape, tokens in groups.items():
                    if shape == "swapped":
                        named = dict.fromkeys(tokens, best_cipher(list(strong), shape, cond, signs))
                    else:
                        named = ciphers_of(list(tokens), shape, cond, signs)
                    out += [(page_id, source, cipher, token, symbols(token, cipher), tokens[token], shape != "swapped" or token in strong) for token, cipher in named.items()]
            cols = list(zip(*out)) if out else [[]] * 7
            kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.bool_(), pa.bool_()]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(cols, kinds)], names=["page_id", "source_id", "cipher", "token", "coded", "sure", "evidence"])

    return run


#: Rounds of expectation-maximization, the weight in occurrences of what a public start says of a symbol, and starts from the source's own counts.
ROUNDS, TRUST, OWN_STARTS = 12, 5.0, 10
#: What a mapping that no code page gives must gain for each symbol: the choice of its letter.
OWN_COST = float(np.log(len(charmodel.LETTERS)))
#: What a single letter other than the public swap's must gain: the choice of one symbol and one letter.
EXCEPTION_COST = float(np.log(2 * len(charmodel.LETTERS) ** 2))
#: Log-likelihood a letter pair by which a public swap may stay below the corpus' own text before other mappings are tried.
NEAR = 0.35


def _expect(counts: np.ndarray, start: np.ndarray, language: np.ndarray, rounds: int) -> np.ndarray:
    """Expected count of each letter (rows) behind each symbol, after ``rounds`` rounds; number 0 is the edge of a word.

    E-step: the expected count of each letter pair behind each symbol pair, under the language's bigrams and the present
    emission probabilities. M-step: emissions from those counts and the start's.
    """
    emit = start / start.sum(1, keepdims=True)
    weight = start
    for _ in range(rounds):
        expect = emit.T @ language @ emit
        ratio = np.divide(counts, expect, out=np.zeros_like(counts), where=expect > 0)
        weight = emit * (language @ emit @ ratio.T) + emit * (language.T @ emit @ ratio)
        emit = weight + start
        emit[0, 1:] = 0
        emit[1:, 0] = 0
        emit /= emit.sum(1, keepdims=True)
    return weight + start


def _likelihood(counts: np.ndarray, letter: np.ndarray, joint: np.ndarray) -> float:
    """Log-likelihood of the symbol pairs if each symbol stands for one letter; symbols of one letter share it by their counts."""
    n = counts.sum(0)
    of = np.bincount(letter, n, len(joint))[letter]
    return float((counts * joint[np.ix_(letter, letter)]).sum() + (n * np.log(np.maximum(n, 1e-9) / np.maximum(of, 1e-9))).sum())


def _settle(counts: np.ndarray, letter: np.ndarray, joint: np.ndarray, free: np.ndarray) -> tuple[float, np.ndarray]:
    """The nearest mapping that no exchange of two symbols' letters and no other letter for one symbol makes likelier; and its likelihood."""
    value = _likelihood(counts, letter, joint)
    while True:
        worth = counts @ joint[:, letter].T + counts.T @ joint[letter]
        now = worth[np.arange(len(letter)), letter]
        gain = worth[:, letter] + worth[:, letter].T - now[:, None] - now[None, :]
        gain[~free], gain[:, ~free] = -np.inf, -np.inf
        better = None
        for flat in np.argsort(-np.triu(gain, 1), axis=None)[:40]:
            a, b = divmod(int(flat), len(letter))
            trial = letter.copy()
            trial[a], trial[b] = letter[b], letter[a]
            if free[a] and free[b] and (v := _likelihood(counts, trial, joint)) > value + 1e-9:
                better = v, trial
                break
        if better is None:
            move = np.where(free[:, None], worth - now[:, None], -np.inf)
            move[:, 0] = -np.inf
            for flat in np.argsort(-move, axis=None)[:40]:
                a, to = divmod(int(flat), len(joint))
                trial = letter.copy()
                trial[a] = to
                if free[a] and to and (v := _likelihood(counts, trial, joint)) > value + 1e-9:
                    better = v, trial
                    break
        if better is None:
            return value, letter
        value, letter = better


def learn_mapping(pairs: pd.DataFrame, cipher: str, joint: np.ndarray, rounds: int = ROUNDS) -> dict[str, str]:
    """Symbol -> letter from counted symbol pairs (a, b, n; an empty string is the edge of a word).

    The public start is the swap ``cipher`` names; those from the source's own counts rank symbols and letters by frequency, each with other ties and
    neighbours. They are tried where there is no public start or its solution stays below the likelihood of the corpus' own text.
    """
    names = sorted((set(pairs["a"]) | set(pairs["b"])) - {""})
    if not names:
        return {}
    index = {"": 0, **{s: i + 1 for i, s in enumerate(names)}}
    counts = np.zeros((len(names) + 1,) * 2)
    np.add.at(counts, (pairs["a"].map(index).to_numpy(), pairs["b"].map(index).to_numpy()), pairs["n"].to_numpy(float))
    language = np.exp(joint)
    size = len(charmodel.LETTERS) + 1
    free = np.arange(len(names) + 1) > 0
    own_text = float((language * joint).sum())
    given = {s: seed(s, cipher) for s in names}
    best, letter, public_holds = -np.inf, None, cipher != "unknown"
    if public_holds:
        start = np.full((size, len(names) + 2), 0.02)  # the last column: symbols that do not occur here
        start[:, 0], start[0, :], start[0, 0] = 0, 0, 1
        for s in names:
            if at := charmodel.NUMBER.get(given[s].lower()):
                start[at, index[s]] += TRUST
        start[1:, -1] += np.where((start[1:, 1:-1] < 1).all(1), TRUST, 0)
        found = _expect(np.pad(counts, (0, 1)), start, language, rounds)
        letter = np.concatenate(([0], 1 + np.argmax(found[1:, 1:-1], 0)))
        best = _likelihood(counts, letter, joint)
        for s in names:
            at = charmodel.NUMBER.get(given[s].lower())
            if at and letter[index[s]] != at:
                public = letter.copy()
                public[index[s]] = at
                value = _likelihood(counts, public, joint)
                if best - value < EXCEPTION_COST:
                    best, letter = value, public
    total = counts.sum()
    if letter is None or best < (own_text - NEAR) * total and own_text * total - OWN_COST * len(names) > best:
        chance = np.random.default_rng(len(names))
        letters = np.argsort(-language.sum(1)[1:], kind="stable") + 1
        known, cost = letter is not None, 0.0 if letter is None else OWN_COST * len(names)
        for k in range(OWN_STARTS if total > 300 else 1):
            ranks = counts.sum(1)[1:] * np.exp(0.25 * chance.standard_normal(len(names)) * (k > 0))
            start = np.full((size, len(names) + 1), 0.02)
            start[:, 0], start[0, :], start[0, 0] = 0, 0, 1
            cases = 2 if len(names) > 1.2 * len(letters) else 1  # capitals and small letters have symbols of their own
            for rank, s in enumerate(np.argsort(-ranks, kind="stable") + 1):
                share = np.exp(-0.5 * ((np.arange(len(letters)) - min(rank / cases, len(letters) - 1)) / 3.0) ** 2)
                start[letters, s] += share / share.sum()
            found = _expect(counts, start, language, 4 * rounds)
            value, trial = _settle(counts, np.concatenate(([0], 1 + np.argmax(found[1:, 1:], 0))), joint, free)
            if value - cost > best and not (known and value < (own_text - NEAR) * total):  # beside a public swap it must read as the corpus does
                best, letter, public_holds = value - cost, trial, False
    out = {s: charmodel.LETTERS[at - 1].upper() if given[s].isupper() else charmodel.LETTERS[at - 1] for s, at in zip(names, letter[1:])}
    if public_holds and not cipher.startswith("utf8:"):  # symbols that did not occur
        out = {**{s: c for s, c in _single(*cipher.split(">")).items() if c in _LETTER}, **out}
    return out


def _pairs(tokens: DataFrame) -> DataFrame:
    """source_id, cipher, a, b, n: neighbouring cipher symbols inside runs of symbols that stand for letters."""

    def run(batches):
        for batch in batches:
            counts: dict[tuple, int] = {}
            for source, cipher, coded in zip(*(c.to_pylist() for c in batch.columns)):
                run_ = [""]
                for c in coded + " ":
                    letter = seed(c, cipher) if cipher != "unknown" else c
                    if (letter in _LETTER and (ord(c) > 0x7F)) or (cipher == "unknown" and c.isalpha() and ord(c) > 0x7F):
                        run_.append(c)
                    elif len(run_) > 1:
                        run_.append("")
                        for pair in zip(run_, run_[1:]):
                            counts[source, cipher, *pair] = counts.get((source, cipher, *pair), 0) + 1
                        run_ = [""]
            cols = list(zip(*counts)) if counts else [[]] * 4
            yield pa.RecordBatch.from_arrays([*(pa.array(list(c), pa.string()) for c in cols), pa.array(list(counts.values()), pa.int64())], names=["source_id", "cipher", "a", "b", "n"])

    rows = tokens.select("source_id", "cipher", "coded").mapInArrow(run, "source_id string, cipher string, a string, b string, n bigint")
    return rows.groupBy("source_id", "cipher", "a", "b").agg(F.sum("n").alias("n"))


def _mappings(pairs: DataFrame, joint: np.ndarray) -> DataFrame:
    """source_id, cipher, from, to: arguments for translate(). A group has at most one row per pair of the cipher's symbols."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        cipher = rows["cipher"].iloc[0]
        found = learn_mapping(rows, cipher, joint)
        return pd.DataFrame({"source_id": [rows["source_id"].iloc[0]], "cipher": [cipher], "from": ["".join(found)], "to": ["".join(found.values())]})

    return pairs.groupBy("source_id", "cipher").applyInPandas(run, "source_id string, cipher string, `from` string, `to` string")


_LOST = "�"


def _fill(text: str, cond: list[list[float]]) -> str:
    """Each lost character between letters as the likeliest letter."""
    out = list(text)
    for i, c in enumerate(out):
        if c == _LOST:
            before = charmodel.NUMBER.get(out[i - 1].lower(), 0) if i else 0
            after = charmodel.NUMBER.get(out[i + 1].lower(), 0) if i + 1 < len(out) else 0
            if before or after:
                out[i] = max(charmodel.LETTERS, key=lambda x: cond[before][charmodel.NUMBER[x]] + cond[charmodel.NUMBER[x]][after])
    return "".join(out)


def _judge(cond: list[list[float]], signs: dict[str, float]):
    """Keeps tokens that the mapping makes likelier; signs take what the code pages say."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for page_id, cipher, token, sure, evidence, text in zip(*(c.to_pylist() for c in batch.columns)):
                if cipher.startswith("utf8:") or any(ord(c) > 0x7F and c not in _LETTER for c in text):
                    text = "".join(c if c in _LETTER or (sign := seed(c, cipher)) in _LETTER else sign for c in text)
                total, count = _reads(text, cond)
                before, n = _reads(token, cond)
                reads = count > 0 and text != token and total / count > (READABLE if not _LATIN1.search(token) else -6.0) and (not n or total / count > before / n + GAIN)
                if reads or sure and likelihood(_fill(text, cond), cond, signs) + SURE_WORTH > likelihood(token, cond, signs) + NEED:
                    out.append((page_id, token, text, evidence))
            cols = list(zip(*out)) if out else [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(cols, (pa.int64(), pa.string(), pa.string(), pa.bool_()))], names=["page_id", "token", "restored", "evidence"])

    return run


def garbled_rows(pages: DataFrame) -> DataFrame:
    """page_id, token, restored, evidence: the distinct garbled tokens of each page, with what the learned mapping makes of them.

    Without ``evidence``, a token is only worth translating where another one shows that the page is affected.
    """
    work = Scratch(pages.sparkSession, "garbled")
    counts = work.cut(charmodel.word_counts(pages).filter(charmodel.IN_MODEL), "counts")
    joint, signs = charmodel.letter_bigrams(counts), charmodel.sign_shares(counts)
    cond = charmodel.conditional(joint)
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.coalesce("source_id", F.lit("")).alias("source_id"), "parser", "text").filter("page_id is not null")
    tokens = work.cut(rows.mapInArrow(_scan(cond, signs), "page_id bigint, source_id string, cipher string, token string, coded string, sure boolean, evidence boolean"), "tokens")
    maps = work.cut(_mappings(_pairs(tokens.filter("evidence")), joint), "maps")
    decoded = tokens.join(maps, ["source_id", "cipher"], "left").withColumn("text", F.expr("coalesce(translate(coded, `from`, `to`), coded)"))
    return decoded.select("page_id", "cipher", "token", "sure", "evidence", "text").mapInArrow(_judge(cond, signs), "page_id bigint, token string, restored string, evidence boolean")


def found_pages(pages: DataFrame) -> DataFrame:
    """page_id of each page with some wrongly decoded text.

    Null and empty texts and rows without a page_id are never affected; a null source is a source of its own;
    repeated rows add nothing; extra columns are not read.
    """
    return garbled_rows(pages).filter("evidence").select("page_id").distinct()


def restored_pages(pages: DataFrame) -> DataFrame:
    """page_id, text, n_restored: every page row, its garbled tokens replaced; null texts stay null."""
    fixes = garbled_rows(pages).groupBy("page_id", "token").agg(F.min("restored").alias("restored"), F.max("evidence").alias("evidence"))
    fixes = fixes.groupBy("page_id").agg(F.map_from_entries(F.collect_list(F.struct("token", "restored"))).alias("fixes"), F.max("evidence").alias("any")).filter("any").drop("any")
    rows = pages.select("page_id", "text").join(fixes, "page_id", "left")

    def run(batches):
        for batch in batches:
            texts, counts = [], []
            for text, fix in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                fix = dict(fix or ())
                if text and fix:
                    text = _TOKEN.sub(lambda m: fix.get(m[0], _CYRILLIC_RUN.sub(lambda w: fix.get(w[0], w[0]), m[0])), text)
                texts.append(text)
                counts.append(len(fix))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string()), pa.array(counts, pa.int32())], names=["page_id", "text", "n_restored"])

    return rows.mapInArrow(run, "page_id bigint, text string, n_restored int")
