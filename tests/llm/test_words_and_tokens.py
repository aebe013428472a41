"""Spelling variants, byte-pair encoding and periodic runs against plain versions."""

import hashlib
import random
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tallygrid.llm import bpe, runs, spelling
from tallygrid.llm.fmindex import BidirectionalIndex
from tallygrid.llm.suffixes import Suffixes
from tallygrid.staging import Staging
from tests.llm.fixtures import corpus, frame, row

LETTERS = {*"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ", *map(chr, range(0xC0, 0x100))}
BLANKS = " \t\n\v\f\r"


def one_edit_apart(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


# --- suffix arrays


@pytest.mark.parametrize("letters", [1, 2, 5])
def test_suffixes_are_sorted_with_their_common_prefixes(letters):
    rng = random.Random(letters)
    for n in (0, 1, 2, 3, 17, 60):
        codes = [rng.randrange(letters) for _ in range(n)]
        found = Suffixes(np.array(codes, np.int64))
        order = sorted(range(n), key=lambda i: codes[i:])
        assert found.order.tolist() == order
        common = found.common().tolist()
        for k in range(1, n):
            a, b = codes[order[k - 1] :], codes[order[k] :]
            same = next((j for j, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
            assert common[k] == same


# --- spelling variants


@pytest.mark.parametrize("alphabet", [b"ab", b"abc", b"abcdefgh\xe9"])
def test_schemes_find_all_words_one_edit_apart(alphabet):
    rng = random.Random(len(alphabet))
    for _ in range(40):
        lengths = rng.choice([(1, 6), (5, 9)])
        words = sorted({bytes(rng.choices(alphabet, k=rng.randrange(*lengths))) for _ in range(rng.randrange(1, 80))})
        rng.shuffle(words)
        asking = sorted(rng.sample(range(len(words)), rng.randrange(len(words) + 1)))
        query, found = BidirectionalIndex(words).near(np.array(asking, np.int64))
        expected = [(i, j) for i in asking for j, w in enumerate(words) if one_edit_apart(words[i], w)]
        assert list(zip(query.tolist(), found.tolist())) == expected


def plain_words(rows):
    out = Counter()
    for doc_id, text, *_ in rows:
        word = ""
        for c in (text or "") + "\0":
            if c in LETTERS:
                word += c
                continue
            word = "".join(chr(ord(x) + 32) if "A" <= x <= "Z" else x for x in word)
            if word:
                h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
                if h % 97 == 0:
                    at = h % len(word)
                    word = word[:at] + word[at + 1 :]
                out[word] += len(word) >= 5
                word = ""
    return {w: n for w, n in out.items() if n >= 3}


def plain_variants(words):
    forms, out = {}, {}
    for word, n in words.items():
        near = [w for w in words if one_edit_apart(word, w)]
        best = min(near, key=lambda w: (-words[w], w), default=None)
        forms[word] = best if best is not None and words[best] >= 2 * n else None
        out[word] = len(near)
    rows = set()
    for word, n in words.items():
        root = word
        while forms[root]:
            root = forms[root]
        form = forms[word]
        rows.add((word, form, root, n, out[word], words[form] if form else None))
    return rows


def spelled_documents(seed, n):
    rng = random.Random(seed)
    base = ["".join(rng.choices("abeÉß÷", k=rng.randrange(4, 9))) for _ in range(40)]
    rows = []
    for i in range(n):
        words = []
        for _ in range(rng.randrange(60)):
            word = rng.choice(base)
            if rng.random() < 0.5:
                at = rng.randrange(len(word))
                word = word[:at] + rng.choice(["", "a", "É", "bb"]) + word[at + rng.randrange(2) :]
            words.append(word + rng.choice([" ", "\n", "2", "中", "-"]))
        rows.append(row(i, "".join(words)))
    return rows + [row(None, "abbéa abbéa abbea"), row(900, None), row(901, ""), row(902, "x" * 300 + " " + "x" * 299)] * 3


@pytest.mark.parametrize("shard", [2000, spelling.SHARD])
def test_variants_are_those_of_all_pairs(spark, shard):
    rows = spelled_documents(5, 60)
    staging = Staging(spark)
    words = staging.write("vocabulary", spelling.vocabulary(frame(spark, rows), spelling.SLIPS))
    expected = plain_words(rows)
    assert {tuple(r) for r in words.collect()} == set(expected.items())
    found = spelling.variants(words, staging, shard=shard)
    assert found.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    got = [tuple(r) for r in found.collect()]
    assert set(got) == plain_variants(expected) and len(got) == len(expected)


def test_a_half_shared_by_most_words_is_searched_in_blocks(spark):
    rng = random.Random(8)
    words = {"stem" + "".join(rng.choices("abcd", k=4)): rng.randrange(3, 50) for _ in range(150)}
    table = spark.createDataFrame(list(words.items()), "word string, n long")
    for shard in (600, 1 << 17):
        got = {tuple(r) for r in spelling.variants(table, Staging(spark), shard=shard).collect()}
        assert got == plain_variants(words)


def test_roots_of_a_long_chain_of_forms(spark):
    words = ["a" * (5 + i) for i in range(11)]
    table = spark.createDataFrame([(w, 3 * 2**i) for i, w in enumerate(words)], "word string, n long")
    got = spelling.variants(table, Staging(spark)).collect()
    assert {r["root"] for r in got} == {words[-1]}


# --- byte-pair encoding


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path(bpe.VOCABULARY))


def odd_texts():
    rng = random.Random(4)
    marks = [*"abcdeaaaa  \n\t'strzßÜ中文😀​́\x1c\x850123.,;-_=/AAB", "'s", "'ll", "<|endoftext|>", "\U0002ebf0", "ᲊ"]
    texts = ["".join(rng.choices(marks, k=rng.randrange(200))) for _ in range(300)]
    texts += ["".join(chr(rng.choice([rng.randrange(32, 0xD800), rng.randrange(0xE000, 0x110000)])) for _ in range(80)) for _ in range(60)]
    texts += ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=n)) for n in (1, 255, 256, 257, 4000)]
    return texts + ["", "x" * 50_000, "ab" * 9_000, " " * 7_000 + "a", "\n" * 300 + "<|endoftext|>" * 3]


def test_ids_and_texts_are_those_of_the_library(library):
    table, encoder = bpe.loaded(None)
    texts = odd_texts()
    for _ in range(2):  # the second time from memory
        ids, counts = encoder.encode(texts)
        at = 0
        for text, n, known in zip(texts, counts.tolist(), library.encode_batch(texts, add_special_tokens=False), strict=True):
            own = ids[at : at + n]
            at += n
            assert own.tolist() == known.ids
            assert table.decode(own) == library.decode(known.ids, skip_special_tokens=False)


def test_all_characters_fall_into_the_classes_of_the_library(library):
    table, _ = bpe.loaded(None)
    split = library.pre_tokenizer.pre_tokenize_str
    for first in range(0, 0x20000, 0x800):
        if not 0x4000 <= first < 0xE000 or first == 0xA000:  # not the large blocks of one script
            text = "".join(f"a{chr(c)}1 {chr(c)}x." for c in range(first, first + 0x800))
            words = [w for part, _ in table.parts(text) for w in part]
            assert words == [text[a:b] for _, (a, b) in split(text)]


def test_broken_bytes_decode_like_the_library(library):
    table, _ = bpe.loaded(None)
    rng = random.Random(2)
    for _ in range(300):
        ids = [rng.randrange(50257) for _ in range(rng.randrange(12))]
        assert table.decode(np.array(ids, np.int64)) == library.decode(ids, skip_special_tokens=False)


def test_words_beyond_the_memory_are_encoded_again(library, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 20)
    encoder = bpe.Encoder(bpe.loaded(None)[0])
    rng = random.Random(6)
    for _ in range(6):
        texts = [" ".join(str(rng.randrange(500)) for _ in range(30)) for _ in range(5)]
        ids, counts = encoder.encode(texts)
        known = library.encode_batch(texts, add_special_tokens=False)
        assert ids.tolist() == [i for k in known for i in k.ids]
        assert counts.tolist() == [len(k.ids) for k in known]


def test_a_tokenizer_of_another_kind_is_refused():
    with pytest.raises(ValueError):
        bpe.Vocabulary(public_tokenizers.path("word_bpe_49k.json"))


def test_bpe_table_over_odd_documents(spark, library):
    rows = corpus(11, 30) + [row(500 + i, t) for i, t in enumerate(odd_texts())]
    got = bpe.bpe_table(frame(spark, rows)).collect()
    expected = []
    for doc_id, text, *_ in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        sums = (hashlib.sha256(x.encode()).hexdigest() for x in (",".join(map(str, ids)), back))
        expected.append((doc_id, len(ids), *sums))
    assert Counter(tuple(r) for r in got) == Counter(expected)
    assert bpe.bpe_table(frame(spark, [])).count() == 0


# --- periodic runs


def plain_runs(words, least=24, power=3):
    out = {}
    n = len(words)
    for q in range(1, n // power + 1):
        start = 0
        while start < n:
            end = start
            while end + q < n and words[end] == words[end + q]:
                end += 1
            length = end - start + q
            if end > start and length >= max(least, power * q):
                out.setdefault((start, length), q)
            start = max(end, start) + 1
    return sorted((s, length, q) for (s, length), q in out.items())


@pytest.mark.parametrize(("least", "power"), [(24, 3), (6, 3), (2, 2)])
def test_runs_are_those_of_all_periods(least, power):
    rng = random.Random(least)
    for _ in range(200):
        codes = rng.choices(range(rng.choice([1, 2, 3, 6])), k=rng.randrange(90))
        if codes and rng.random() < 0.6:
            a, p = rng.randrange(len(codes)), rng.randrange(1, 10)
            codes = [codes[min(a + (i - a) % p, len(codes) - 1)] if i >= a else codes[i] for i in range(len(codes))]
            codes += rng.choices(range(3), k=rng.randrange(10))
        assert runs.find_runs(np.array(codes, np.int64), least, power) == plain_runs(codes, least, power)


def words_of(text):
    return "".join(" " if c in BLANKS else c for c in text or "").split(" ")


def plain_row(doc_id, text):
    words = [w for w in words_of(text) if w]
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
    found = plain_runs(words)
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    dropped = {i for s, length, q in found for i in range(s + q, s + length)}
    listed = "".join(f"{s},{length},{q}\n" for s, length, q in found)
    kept = " ".join(w for i, w in enumerate(words) if i not in dropped)
    figures = (None,) * 4 if best is None else (*best, 1000 * best[1] // best[2])
    return (doc_id, len(found), *figures, *(hashlib.sha256(x.encode()).hexdigest() for x in (listed, kept)))


def test_runs_table_over_odd_documents(spark):
    rng = random.Random(3)
    rows = corpus(12, 40)
    rows += [row(400 + i, " ".join(rng.choices(["ab", "c", "ü"], k=rng.randrange(150)))) for i in range(60)]
    rows += [row(480, "go on " * 40), row(481, "x " * 30 + "y z " * 20), row(482, "a b\tc\v" * 30 + "a b d " * 25)]
    got = runs.runs_table(frame(spark, rows)).collect()
    assert Counter(tuple(r) for r in got) == Counter(plain_row(r[0], r[1]) for r in rows)
    assert sum(r["n_runs"] > 0 for r in got) > 5
    assert runs.runs_table(frame(spark, [])).count() == 0


def test_a_very_long_stretch_is_one_run():
    text = b"left " + b"one two three " * 60_000 + b"right"
    ((words, found),) = runs.texts_with_runs([text])
    assert found == [(1, 180_000, 3)]
    assert runs.collapsed(words, found) == b"left one two three right"
