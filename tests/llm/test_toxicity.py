import zlib

import numpy as np
import pytest

from bibliospark.llm import toxicity as tx
from bibliospark.llm.common import table

from .helpers import docs_frame, rows

TEXT = (
    "the worthless clown called him an idiot and a moron then put the trash and the scum out what a pathetic and "
    "disgusting night it was for the people of the town who only wanted to see the show at the theatre that evening "
)
LABELS = "doc_id long, quality int, toxic int"


def counts(text):
    c = np.zeros(len(text) + 4, int)
    c[2:-2] = tx._fold()[[ord(x) for x in text]]
    return np.bincount((c[:-2] * 28 + c[1:-1]) * 28 + c[2:], minlength=28**3).astype(float)


@pytest.fixture(scope="module")
def decoder():
    return tx.Deobfuscator(counts(TEXT * 50))


@pytest.mark.parametrize(
    ("written", "meant"),
    [
        ("1d10t", "idiot"), ("!d!ot", "idiot"), ("m0r0n", "moron"), ("m o r o n", "moron"), ("i.d.i.o.t", "idiot"),
        ("s-c-u-m", "scum"), ("idiooooot", "idiot"), ("mmmoron", "moron"), ("$cum", "scum"), ("tr@sh", "trash"),
        ("w0rthl3ss", "worthless"), ("d1sgu5t1ng", "disgusting"), ("p4th3t1c", "pathetic"), ("c l 0 w n", "clown"), ("M 0 R 0 N", "moron"),
    ],
)
def test_restores_what_was_meant(decoder, written, meant):
    assert decoder.restore(f"you are a big {written}, sir") == f"you are a big {meant}, sir"


@pytest.mark.parametrize("text", ["plain words stay as they are", "It cost 45 in 1999.", "Stop! Now!! (really)", "call 555 1234", "a b c", "", "naïve Straße ñandú", "x.y", "### *** $$$"])
def test_text_without_a_trace_stays(decoder, text):
    assert decoder.restore(text) == text


@pytest.mark.parametrize(
    ("written", "meant"),
    [
        ("i_d_i_o_t", "idiot"), ("m_o_r_o_n", "moron"), ("m*o*r*o*n", "moron"), ("s_c_u_m", "scum"),
        ("- i d i o t", "- idiot"), ("& m o r o n", "& moron"), ("2 i d i o t", "2 idiot"), ("- m_o_r_o_n", "- moron"),
        ("s h o w", "show"), ("b i g", "big"), ("b_i_g", "big"), ("b.!.g", "big"), ("m0r0n,i d i o t", "moron,idiot"), ("w0rthl3ss/i_d_i_o_t", "worthless/idiot"),
    ],
)
def test_restores_spaced_words_whatever_stands_around(written, meant):
    known = tx.Deobfuscator(counts((TEXT + "a big big man ") * 50))
    assert known.restore(f"you are a bit {written}, sir") == f"you are a bit {meant}, sir"


@pytest.mark.parametrize("text", ["version 1.0.5 of it", "5 4 3 go", "foo_a_b_c", "x_y", "1 - 0"])
def test_numbers_and_names_stay(decoder, text):
    assert decoder.restore(text) == text


def test_long_runs_end(decoder):
    assert len(decoder.restore("a" * 300_000)) <= 2
    decoder.restore("a1" * 20_000)
    decoder.restore(" ".join("abc" * 7000))


def test_trigrams_cover_all_texts(spark):
    texts = ["Abc dé!", None, "", "日本 abc", "Abc dé!"]
    got = tx.trigram_counts(docs_frame(spark, texts))
    assert (got == sum(counts(t) for t in texts if t)).all()


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    labels = table(spark, sf, "labels")
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    got = tx.toxicity(table(spark, sf, "documents"), labels).collect()
    assert {r.doc_id: r.held_out for r in got} == {r.doc_id: zlib.crc32(str(r.doc_id).encode()) % 5 == 0 for r in got}
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) >= 0.93
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)


def small(spark):
    bad, good = "what a moron and idiot {}", "what a fine and calm day {}"
    texts = [(i, (bad if i % 3 == 0 else good).format(f"note{i}")) for i in range(150)]
    return texts, [(i, 1, int(i % 3 == 0)) for i in range(0, 120)]


def test_obfuscated_words_count(spark):
    texts, labels = small(spark)
    texts += [(500, "what a m0r0n and !d!ot"), (501, "what a f1ne and c a l m day")]
    got = {r.doc_id: r.predicted for r in tx.toxicity(docs_frame(spark, texts), spark.createDataFrame(labels, LABELS)).collect()}
    assert got[500] == 1 and got[501] == 0
    assert all(got[i] == (i % 3 == 0) for i in range(150))


def test_held_out_labels_change_nothing(spark):
    texts, labels = small(spark)
    other = [(d, q, 1 - t if zlib.crc32(str(d).encode()) % 5 == 0 else t) for d, q, t in labels]
    df = docs_frame(spark, texts)
    a, b = (rows(tx.toxicity(df, spark.createDataFrame(x, LABELS)), "doc_id", "score") for x in (labels, other))
    assert a == b


def test_edge_rows(spark):
    texts, labels = small(spark)
    texts += [(200, None), (201, ""), (202, "moron idiot"), (202, "moron idiot"), (None, "moron idiot"), (203, "calm day " * 30_000)]
    labels += [(0, None, None), (3, 1, 1), (None, 0, 1), (9999, 0, 1), (6, 0, 7)]
    df = docs_frame(spark, texts).selectExpr("*", "1 AS label", "2 AS score", "3 AS h")
    got = [(r.doc_id, r.predicted, r.score) for r in tx.toxicity(df, spark.createDataFrame(labels, LABELS)).collect()]
    assert len(got) == len(texts)
    by = {d: (p, s) for d, p, s in got}
    assert by[200] == by[201] and by[202][0] == by[None][0] == 1 and by[203][0] == 0


def test_nothing_to_learn_from(spark):
    df = docs_frame(spark, ["some words", None])
    none = spark.createDataFrame([], LABELS)
    assert rows(tx.toxicity(df, none), "doc_id", "score", "predicted") == [(0, 0.5, 1), (1, 0.5, 1)]
    assert tx.toxicity(df.limit(0), none).count() == 0
