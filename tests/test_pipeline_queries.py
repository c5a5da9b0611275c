"""The records that the pipeline queries derive, and what their plans read and shuffle."""

import random
import re
import unicodedata

from bibliospark.plans import pipeline_queries, pipelines

PARTS = list("aÉß ж漢 1-.\n\t") + [" ", "  ", " \n ", "\U0001F600", "\U00010400", "é", "12 - ", "word ", "two-part "]


def _words(text):
    if text is None:
        return []
    return re.split(" +", "".join(c for c in text if c == " " or unicodedata.category(c).startswith("L")))


def _documents(spark, folder, texts):
    rows = [(i, t, "en", "web") for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").write.parquet(f"{folder}/documents.parquet")
    return folder


def test_submitter_is_the_second_and_first_word(spark, tmp_dir):
    rng = random.Random(5)
    texts = ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 12))) for _ in range(300)]
    # the second word begins, ends or lies beyond the text's head
    texts += [f"{'a' * n} b{'c' * m}{end}" for n in (0, 1, 253, 254, 255, 256, 300) for m in (0, 1, 3, 400) for end in ("", " d", "1", "-d e")]
    texts += [f"a{' 1' * n} bc{end}" for n in (126, 127, 128, 400) for end in ("", " d", "-d e")]
    texts += [None, "", " ", "a", " a", "a ", "1 2 3", "a\nb c", "ab -- cd", "ab-cd ef"]
    got = {r.id: r.submitter for r in pipeline_queries.records(spark, _documents(spark, tmp_dir, texts)).select("id", "submitter").collect()}
    first_two = [(_words(t) + ["", ""])[:2] for t in texts]
    assert got == {i: f"{second} {first}" for i, (first, second) in enumerate(first_two)}


def test_gender_lookup_splits_no_whole_text(spark, tmp_dir):
    _documents(spark, tmp_dir, ["Jane Doe wrote this", "12 Ann"])
    lookup = pipeline_queries.gender_lookup(spark, tmp_dir)
    assert "split(" not in lookup._jdf.queryExecution().optimizedPlan().toString()
    assert {tuple(r) for r in lookup.collect()} == {("Doe", None), ("Ann", None)}


def test_fact_shuffles_publications_by_their_id_alone(spark):
    final = spark.createDataFrame([(1, "t", "c", "d", 5, "x", "p", "J"), (2, "t", "c", "d", None, None, "p", "K"), (2, "t", "c", "d", 7, "x", None, "J")],
                                  "id long, title string, comments string, doi string, reference_count long, discipline string, publication_type string, journal string")
    for mode in ("distinct", "per_row"):
        fact = pipelines.build_warehouse({"final": final}, dim_mode=mode)["fact_publications"]
        plan = fact._jdf.queryExecution().executedPlan().toString()
        assert set(re.findall(r"hashpartitioning\((\w+)#", plan)) == {"publication_id"}
        assert sorted(r.publication_id for r in fact.collect()) == [1, 2]
