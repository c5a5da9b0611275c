"""The corpus pipeline on a small set of documents, each stage against plain Python."""

import hashlib

import pytest
from tokenizers import Tokenizer

import corpus_pipeline as cp
from bibliospark.llm.common import saved, table
from bibliospark.llm.queries import TOKENIZER_DIR

from .helpers import DOCS, SF, rows
from .test_decontaminate import brute as contamination
from .test_line_dedup import AZ, BLANK
from .test_ngram_join import brute as components

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark):
    docs = table(spark, SF, "documents").select(*COLUMNS)
    out = [docs]
    for name, stage in cp.STAGES:
        docs = saved(stage(spark, docs, SF), name)
        out.append(docs)
    return out


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_stages_in_order():
    assert [n for n, _ in cp.STAGES] == ["language_id", "repeated_lines", "near_duplicates", "benchmark_passages", "token_ids"]


def test_columns_stay(stages):
    for before, after in zip(stages[:-2], stages[1:-1]):
        assert after.columns == before.columns and after.dtypes == before.dtypes


def test_language_keeps_clean_documents(stages):
    before, after = texts(stages[0]), texts(stages[1])
    gone = set(before) - set(after)
    assert all(after[d] == before[d] for d in after)
    assert not any(any(c.isalpha() for c in before[d] or "") and len(before[d].split()) > 5 for d in gone)


def test_lines(stages):
    before, after = texts(stages[1]), texts(stages[2])
    key = lambda line: line.strip(BLANK).translate(AZ)
    first = {}
    for d in sorted(before):
        for line in before[d].split("\n"):
            first.setdefault(key(line), d)
    want = {d: "\n".join(x for x in t.split("\n") if len(key(x)) < 10 or first[key(x)] == d) for d, t in before.items()}
    emptied = {d for d, t in want.items() if not t.strip(BLANK) and t != before[d]}
    assert emptied and min(len(before[d].strip(BLANK)) for d in emptied) >= 10
    want = {d: t for d, t in want.items() if d not in emptied}
    assert after == want
    assert {r.doc_id: r.n_chars for r in stages[2].collect()} == {d: len(t) for d, t in want.items()}


def test_near_duplicates(stages):
    before, after = texts(stages[2]), texts(stages[3])
    found = components(before, 5, 80)
    assert after == {d: t for d, t in before.items() if found[d][1] == d}


def test_benchmark(spark, stages):
    items = [(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()]
    before, after = texts(stages[3]), texts(stages[4])
    assert after == {d: t for d, t in before.items() if not contamination(t, items)[-1]}
    assert len(after) < len(before)


def test_tokens(stages):
    theirs = Tokenizer.from_file(f"{TOKENIZER_DIR}/byte_bpe_50k.json")
    before = texts(stages[4])
    got = {r.doc_id: r for r in stages[5].collect()}
    assert got.keys() == before.keys() and all(r.n_tokens for r in got.values())
    for d, t in before.items():
        ids = theirs.encode(t, add_special_tokens=False).ids
        assert got[d].ids == ids and got[d].n_tokens == len(ids)
        assert got[d].decoded_sha256 == hashlib.sha256(t.encode()).hexdigest()


def test_odd_rows_and_extra_columns(spark):
    made = [(1, None, None, None, None), (2, "", "en", "s", 0), (None, "some words of a text without id", "en", "s", 5), (3, "12 34", "en", "s", 5)]
    made += [(10 + i, f"the weather was fine on day {i} and they went to the harbour to see the ships of the {i} fleet", "en", "s", 1) for i in range(20)]
    made += [(10, made[4][1], "en", "s", 1)]
    docs = spark.createDataFrame(made, DOCS).selectExpr("*", "'x' AS key", "1 AS gone", "2 AS owner", "3 AS score")
    for name, stage in cp.STAGES[:-1]:
        out = saved(stage(spark, docs, SF), name)
        assert out.columns == docs.columns
        docs = out
    assert set(r[0] for r in rows(docs, "doc_id")) <= {None, *range(10, 30)}
    empty = spark.createDataFrame([], DOCS)
    for name, stage in cp.STAGES:
        empty = saved(stage(spark, empty, SF), name)
        assert empty.count() == 0
