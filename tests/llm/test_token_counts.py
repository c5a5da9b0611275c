"""Token counts against the tokenizers library."""

import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from bibliospark.llm import token_counts
from bibliospark.llm.common import table
from bibliospark.llm.token_counts import WholeTokenCounter, count_tokens

from .helpers import SF, docs_frame, rows

PATH = public_tokenizers.path("word_bpe_49k.json")
NAMES = ("doc_id", "n_bytes", "n_tokens", "over_limit")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def counter():
    return WholeTokenCounter(open(PATH, encoding="utf-8").read())


HARD = [
    "", " ", "\n\t", "ΣΑΣ ΟΔΟΣ", "İstanbul İİ", "x <|endoftext|>y<|startoftext|>", "<|endoftext|><|endoftext|>", "<|EndOfText|>",
    "'S it's '' ''ll I'VE 12345 ½² Ⅷ", "\u0085a b\x1cc\x1fd e　f", "日本語 한국어 각", "é é Å", "ﬁ ß ẞ ǅ",
    "\U000105c9 \U00010400 ꟋꟚ", "emoji 👩‍👩‍👧 ok", "a" * 5000, "\x00\x01a\x7f", "q1" * 3000, "naïve CAFÉ", "don't <|endoftext", "ʼn",
]


def test_hard_texts(counter, library):
    want = [len(library.encode(t, add_special_tokens=False).ids) for t in HARD]
    assert [counter.count(t) for t in HARD] == want


def test_random_characters(counter, library):
    rng = random.Random(5)
    kinds = [(32, 127), (0x80, 0x500), (0x500, 0xD800), (0xE000, 0x1FFFF)]
    texts = ["".join(chr(rng.randrange(*rng.choice(kinds))) for _ in range(rng.randrange(50))) for _ in range(400)]
    assert [counter.count(t) for t in texts] == [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]


def test_proved_strings_are_one_token(counter, library):
    assert len(counter.whole) > 30_000
    proved = sorted(counter.whole)
    for part in (proved[i : i + 5000] for i in range(0, len(proved), 5000)):
        assert {len(e.ids) for e in library.encode_batch(part, add_special_tokens=False)} == {1}


def test_windows_and_small_memory(library, monkeypatch):
    monkeypatch.setattr(token_counts, "WINDOW", 50)
    monkeypatch.setattr(token_counts, "CACHE", 40_000)
    small = WholeTokenCounter(open(PATH, encoding="utf-8").read())
    rng = random.Random(3)
    for _ in range(5):
        text = " ".join(f"{rng.choice('aé')}x{rng.randrange(10**6)}qz'll <|endoftext|>" for _ in range(800))
        assert small.count(text) == len(library.encode(text, add_special_tokens=False).ids)


def test_edges(spark):
    many = "hello " * 2049
    df = docs_frame(spark, [None, "", "hello", "hello", (2, "é!"), many, (None, "hi"), "hello " * 2048])
    clashing = df.withColumn("n_tokens", df.lang).withColumn("n_bytes", df.lang)
    got = rows(count_tokens(clashing, PATH), *NAMES)
    assert got == [
        (None, 2, 1, False), (0, 0, 0, False), (1, 0, 0, False), (2, 3, 2, False), (2, 5, 1, False), (3, 5, 1, False),
        (5, 6 * 2049, 2049, True), (7, 6 * 2048, 2048, False),
    ]
    assert rows(count_tokens(docs_frame(spark, []), PATH), *NAMES) == []


def test_whole_table(spark, library):
    docs = table(spark, SF, "documents")
    want = []
    for r in docs.select("doc_id", "text").collect():
        n = len(library.encode(r.text or "", add_special_tokens=False).ids)
        want.append((r.doc_id, len((r.text or "").encode()), n, n > 2048))
    assert rows(count_tokens(docs, PATH), *NAMES) == sorted(want)
