"""Small inputs shared by the tests of the corpus operators."""

from __future__ import annotations

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
SF = "/root/testdata/sf0.001"


def docs_frame(spark, texts, first=0, schema=DOCS):
    """Documents with ids from ``first`` on; an item may be (doc_id, text)."""
    rows = []
    for i, t in enumerate(texts):
        d, t = t if isinstance(t, tuple) else (first + i, t)
        rows.append((d, t, "en", "src", None if t is None else len(t)))
    return spark.createDataFrame(rows, schema)


def words(rng: random.Random, n: int, vocabulary: int = 5000) -> list[str]:
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def rows(df, *names):
    """Rows as plain tuples, sorted; None sorts first."""
    got = [tuple(r[n] for n in names) for r in df.select(*names).collect()]
    return sorted(got, key=lambda r: [(x is not None, x) for x in r])
