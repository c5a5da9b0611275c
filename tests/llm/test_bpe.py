import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from bibliospark.llm import bpe
from bibliospark.llm.queries import TOKENIZER_DIR

from .helpers import docs_frame, rows

PATH = f"{TOKENIZER_DIR}/byte_bpe_50k.json"


@pytest.fixture(scope="module")
def pair():
    with open(PATH, encoding="utf-8") as f:
        mine = bpe.load(f.read())
    theirs = Tokenizer.from_file(PATH)
    theirs.no_truncation()
    theirs.no_padding()
    return mine, theirs


def expected(theirs, text):
    ids = theirs.encode(text or "", add_special_tokens=False).ids
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return len(ids), sha(",".join(map(str, ids))), sha(theirs.decode(ids, skip_special_tokens=False))


@settings(max_examples=400, deadline=None)
@given(st.one_of(st.text(max_size=60), st.text(alphabet=" \n\t\x1c\x85 　ab'sl1é½<|endoftext|>", max_size=60)))
def test_same_ids_and_text_as_the_library(pair, text):
    mine, theirs = pair
    ids = theirs.encode(text, add_special_tokens=False).ids
    assert mine.encode(text).tolist() == ids
    assert mine.decode(ids) == theirs.decode(ids, skip_special_tokens=False)
    assert mine.digest(text) == expected(theirs, text)


def test_special_tokens_inside_texts(pair):
    mine, theirs = pair
    text = "a<|endoftext|> b <|endoftext|><|endoftext|>c<|endof"
    assert mine.encode(text).tolist() == theirs.encode(text, add_special_tokens=False).ids
    assert 50256 in mine.encode(text)


def test_long_fragments_merge_like_short_ones(pair):
    mine, theirs = pair
    for text in ("a" * 5000, "abcd" * 999, "the" * 700 + "é" * 300):
        assert mine.encode(text).tolist() == theirs.encode(text, add_special_tokens=False).ids


def test_cuts_are_boundaries_of_the_tokens(pair):
    mine, _ = pair
    piece = " naïve​word".encode()
    fragments = mine.cut(piece)
    assert b"".join(fragments) == piece and len(fragments) > 1
    ends, at = set(), 0
    for i in mine.encode(" naïve​word"):
        at += len(mine.bytes_of[int(i)])
        ends.add(at)
    at = 0
    for f in fragments[:-1]:
        at += len(f)
        assert at in ends


def test_forgetting_changes_nothing(pair, monkeypatch):
    mine, theirs = pair
    monkeypatch.setattr(bpe, "CACHE", 5)
    text = "one two three one four five six one two seven eight nine ten one"
    assert mine.encode(text).tolist() == theirs.encode(text, add_special_tokens=False).ids
    assert mine.digest(text) == expected(theirs, text)


def test_digests_of_rows(spark, pair):
    texts = ["Hello  world\n", None, "", "x" * 200_000, "Hello  world\n", (None, "no id"), (4, "Hello  world\n"), "  \n\n "]
    df = docs_frame(spark, texts)
    got = rows(bpe.encode_digest(df, PATH), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    want = [(t[0] if isinstance(t, tuple) else i, *expected(pair[1], t[1] if isinstance(t, tuple) else t)) for i, t in enumerate(texts)]
    assert got == sorted(want, key=lambda r: [(x is not None, x) for x in r])
    assert bpe.encode_digest(df.limit(0), PATH).count() == 0


def test_encode_and_decode_columns(spark, pair):
    df = docs_frame(spark, ["Hello world", None, ""]).selectExpr("*", "'mine' AS ids", "1 AS key")
    coded = bpe.encode(df, PATH)
    assert sorted(coded.columns) == sorted(df.columns)
    got = {r.doc_id: (r.ids, r.decoded, r.key) for r in bpe.decode(coded, PATH).collect()}
    assert got == {0: (pair[1].encode("Hello world").ids, "Hello world", 1), 1: ([], "", 1), 2: ([], "", 1)}
    ids = {r.doc_id: r.ids for r in bpe.encode_digest(df, PATH, with_ids=True).collect()}
    assert ids == {d: v[0] for d, v in got.items()}


def test_other_kinds_of_files_are_refused():
    with pytest.raises(ValueError, match="byte-level"), open(f"{TOKENIZER_DIR}/word_bpe_49k.json", encoding="utf-8") as f:
        bpe.ForcedBoundaryBPE(f.read())


def test_texts_beyond_the_memory(pair, monkeypatch):
    _, theirs = pair
    with open(PATH, encoding="utf-8") as f:
        mine = bpe.ForcedBoundaryBPE(f.read())
    monkeypatch.setattr(bpe, "CACHE", 20)
    texts = ["1 2 3", " ".join(map(str, range(60))), "1 2 3", "4 5<|endoftext|>" + " ".join(map(str, range(30, 90))), "", "7 8"]
    for text in texts * 2:
        assert mine.digest(text) == expected(theirs, text)
    for text in texts * 2:
        assert mine.encode(text).tolist() == theirs.encode(text, add_special_tokens=False).ids
        assert mine.digest(text, []) == expected(theirs, text)
