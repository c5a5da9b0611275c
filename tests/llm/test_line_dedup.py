import hashlib
import random
from collections import defaultdict

import pytest

from bibliospark.llm import line_dedup as ld

from .helpers import docs_frame, rows

BLANK = " \t\n\x0b\x0c\r"
AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(texts: dict[int, str | None]) -> dict[int, tuple[int, int, str]]:
    holders = defaultdict(set)
    key = lambda line: line.strip(BLANK).translate(AZ)
    for d, t in texts.items():
        for line in (t or "").split("\n"):
            if len(key(line)) >= 10:
                holders[key(line)].add(d)
    out = {}
    for d, t in texts.items():
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(holders[key(x)]) < 2 or min(holders[key(x)]) == d]
        out[d] = len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()
    return out


def digests(df, **options):
    got = ld.line_digest(df, **options).collect()
    return {r.doc_id: (r.n_lines, r.n_dropped, r.kept_sha256) for r in got}


@pytest.mark.parametrize(("batches", "fanout"), [(1, 3), (4, 2), (6, 3)])
def test_like_brute_force_for_any_batches(spark, batches, fanout):
    rng = random.Random(batches)
    pool = [f"{rng.choice(['Line', 'ÉCOLE', 'İx'])} number {i} of the pool" for i in range(60)] + ["short", "", "ninechars", "ten chars!", "é" * 9, "é" * 10]
    texts = {
        rng.randrange(10**6): "\n".join(rng.choice(["", " ", "\t", "\x1c"]) + rng.choice([x, x.upper(), x.swapcase()]) + rng.choice(["", " \r"]) for x in rng.choices(pool, k=rng.randrange(12)))
        for _ in range(120)
    }
    assert digests(docs_frame(spark, list(texts.items())), batches=batches, fanout=fanout) == brute(texts)


def test_hot_line_nulls_repeats_and_long_texts(spark):
    hot = "the same line in every document"
    texts = {i: f"{hot}\nown line of document {i}\n{hot}" for i in range(300)}
    texts |= {300: None, 301: "", 302: "\n\n", 303: "\n".join(f"long text line {i}" for i in range(20_000)), 304: "long text line 19999"}
    assert digests(docs_frame(spark, list(texts.items()))) == brute(texts)


def test_edge_rows(spark):
    df = docs_frame(spark, [(1, "a repeated line"), (1, "a repeated line"), (None, "a repeated line"), (2, "a repeated line")])
    got = rows(ld.line_digest(df), "doc_id", "n_dropped")
    assert got == [(None, 0), (1, 0), (1, 0), (2, 1)]  # repeats are one document, rows without an id are left alone
    assert ld.line_digest(df.limit(0)).count() == 0


def test_texts_and_other_columns(spark):
    df = docs_frame(spark, ["first line here\nx", "FIRST LINE HERE\nkept line of this", None, "first line here"])
    df = df.selectExpr("*", "doc_id AS owner", "'d' AS `drop`", "3 AS k1")
    out = ld.dedup_lines(df)
    assert out.columns == df.columns
    assert rows(out, "doc_id", "text", "owner", "drop", "k1") == [
        (0, "first line here\nx", 0, "d", 3), (1, "kept line of this", 1, "d", 3), (2, None, 2, "d", 3), (3, "", 3, "d", 3),
    ]


def test_runs_are_compacted(spark):
    store = ld.LineRuns(fanout=2)
    for i in range(5):
        lines = spark.createDataFrame([(10 * i + j, h, 0) for j, h in enumerate([1, i, 100 + i])], "doc_id long, k1 long, k2 int")
        store.add(lines).count()
    assert [len(level) for level in store.levels] == [1, 0, 1]
    held = {r.k1: r.owner for run in store.runs for r in run.collect()}
    assert held == {1: 0, 0: 1, 2: 21, 3: 31, 4: 41} | {100 + i: 10 * i + 2 for i in range(5)}
