import zlib

import numpy as np
import pytest

from bibliospark.llm import langid as li
from bibliospark.llm.common import table
from bibliospark.llm.ftrl import SparseFTRL, softmax, temperature

from .helpers import DOCS, SF, docs_frame, rows

SAMPLES = {
    "en": "the ship was in the harbour and they wanted to know what the weather would do that night",
    "de": "das schiff lag im hafen und sie wollten wissen was das wetter in der nacht machen würde",
    "fr": "le bateau était dans le port et ils voulaient savoir quel temps il ferait cette nuit là",
}


def mixed(spark, n=90):
    made = []
    for i in range(n):
        lang = list(SAMPLES)[i % 3]
        w = SAMPLES[lang].split()
        made.append((i, " ".join(w[i % 7 : i % 7 + 9]), lang, "s", 0))
    return made


def test_held_out_accuracy(spark):
    docs = table(spark, SF, "documents")
    truth = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    got = li.identify(docs).collect()
    assert {r.doc_id: r.held_out for r in got} == {d: zlib.crc32(str(d).encode()) % 3 == 1 for d in truth}
    held = [r for r in got if r.held_out and r.lang_pred != "und"]
    assert len(held) > 40 and np.mean([r.lang_pred == truth[r.doc_id] for r in held]) >= 0.97
    assert all(0 <= r.score <= 1 for r in got)


def test_labels_of_held_out_documents_change_nothing(spark):
    made = mixed(spark)
    wrong = [(d, t, "xx" if zlib.crc32(str(d).encode()) % 3 == 1 else lang, s, n) for d, t, lang, s, n in made]
    a, b = (rows(li.identify(spark.createDataFrame(x, DOCS)), "doc_id", "lang_pred", "score") for x in (made, wrong))
    assert a == b and {r[1] for r in a} == {"en", "de", "fr"}


@pytest.mark.parametrize("other", ["the quick brown fox jumps", "zzz qqq", None, SAMPLES["de"]])
def test_texts_of_others_change_no_row(spark, other):
    """Neither held-out texts nor those without a lang or an id are learned from, be it by a count."""
    made = mixed(spark) + [(901, "ein wort", None, "s", 0), (None, "one word", "en", "s", 0)]
    learned = lambda d, lang: d is not None and lang and zlib.crc32(str(d).encode()) % 3 != 1
    changed = [(d, t if learned(d, lang) else other, lang, s, n) for d, t, lang, s, n in made]
    a, b = (rows(li.identify(spark.createDataFrame(x, DOCS)), "doc_id", "lang_pred", "score") for x in (made, changed))
    same = {d for d, _, lang, *_ in made if learned(d, lang)}
    assert len(same) > 50 and [r for r in a if r[0] in same] == [r for r in b if r[0] in same]


def test_sample_bounds(spark, monkeypatch):
    """Many lang values, or heavy rows, leave a fit of fixed size that still works."""
    monkeypatch.setattr(li, "LANGS", 3)
    codes = [(1000 + i, f"text number {i}", f"x{i}", "s", 0) for i in range(60)]
    model = li.fit(spark.createDataFrame(mixed(spark) + codes, DOCS))
    assert model.langs == ["de", "en", "fr"]
    monkeypatch.setattr(li, "SAMPLE_BYTES", 30_000)
    small = li.fit(spark.createDataFrame(mixed(spark, 300), DOCS))
    assert small.langs == ["de", "en", "fr"] and small.predict(SAMPLES["de"].encode())[0] == "de"


def test_edge_rows(spark):
    odd = [(100, None), (101, ""), (102, "123 456 !?"), (103, SAMPLES["de"]), (103, SAMPLES["de"]), (None, SAMPLES["fr"]), (104, SAMPLES["en"] * 2000), (105, "日本語")]
    made = mixed(spark) + [(d, t, None, None, 0) for d, t in odd]
    df = spark.createDataFrame(made, DOCS).selectExpr("*", "'x' AS lang_pred", "'y' AS held_out", "1 AS bucket")
    got = [(r.doc_id, r.lang_pred, r.score) for r in li.identify(df).collect()]
    assert len(got) == len(made)
    by = {d: (p, s) for d, p, s in got}
    assert all(by[d] == ("und", 0.0) for d in (100, 101, 102))
    assert by[103][0] == "de" and by[104][0] == "en" and by[None][0] == "fr" and by[105][0] != "und"
    kept = li.reject_unidentified(df)
    assert kept.columns == df.columns
    assert {r.doc_id for r in kept.collect()} >= {103, 104, None} and not {r.doc_id for r in kept.collect()} & {100, 101, 102}


def test_nothing_to_learn_from(spark):
    df = docs_frame(spark, ["some words", None]).withColumn("lang", li.F.lit(None).cast("string"))
    assert rows(li.identify(df), "doc_id", "lang_pred", "score") == [(0, "und", 0.0), (1, "und", 0.0)]
    assert li.identify(df.limit(0)).count() == 0


def test_statistics_cover_all_rows_to_learn_from(spark):
    df = docs_frame(spark, ["ab", "ab", "b", None, "12"])
    total, seen = li.document_frequencies(df)
    want = np.zeros(li.BUCKETS, int)
    for t in (b"ab", b"ab", b"b"):
        want += li.gram_counts(li._code_points(t)) > 0
    assert total == 3 and (seen == want).all()


def test_ftrl_learns_and_stays_sparse():
    rng = np.random.default_rng(0)
    rows_, labels = [], []
    for i in range(600):
        y = i % 3
        noise = rng.choice(np.arange(10, 500), 5, replace=False)
        rows_.append((np.sort(np.append(noise, [y])), np.full(6, 0.4)))
        labels.append(y)
    model = SparseFTRL(3, 500, l1=1.0).fit(rows_, labels, epochs=3)
    w = model.weights
    assert (np.abs(w[:, 10:500]) > 0).mean() < 0.2 and all(w[y, y] > max(w[k, y] for k in range(3) if k != y) for y in range(3))


@pytest.mark.parametrize("heat", [0.5, 1.0, 4.0])
def test_temperature_undoes_overconfidence(heat):
    rng = np.random.default_rng(1)
    scores = rng.normal(size=(3, 4000)) * 2
    labels = np.array([rng.choice(3, p=p) for p in softmax(scores).T])
    assert np.isclose(temperature(scores * heat, labels), heat, rtol=0.15)
