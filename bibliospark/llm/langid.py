"""Language identification by sparse multinomial logistic regression (operator 10).

Features are TF-IDF weighted character n-grams (1 to 3) of the whole text,
hashed into ``BUCKETS``.  Document frequencies are counted over all documents
to learn from, and over no others; the model is fitted by
follow-the-regularised-leader with elastic-net penalties on a bounded sample
of them (those with the smallest id hash), and its probabilities are
calibrated by one temperature on a fifth of that sample.  Scoring is one
row-local pass with a model of fixed size.

Bounds of the sample, so that the fit stays a fixed size whatever the
``lang`` column holds: the ``LANGS`` most frequent values, ``per_lang``
documents of each, and ``SAMPLE_BYTES`` of features in equal shares.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow_map, as_binary, hash_share, saved
from .ftrl import Row, SparseFTRL, logits, softmax, temperature

BUCKETS = 1 << 15
_BITS = 15
# Labelled documents of each language that the model is fitted on, at most.
PER_LANG = 1500
LANGS = 256
SAMPLE_BYTES = 128 << 20
UNDETERMINED = "und"
_MIX = np.uint64(0x9E3779B97F4A7C15)

_LETTERS: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """Whether a code point is a letter; built once per Python worker."""
    if not _LETTERS:
        _LETTERS.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))
    return _LETTERS[0]


def _code_points(text: bytes | None) -> np.ndarray | None:
    """Lower-cased code points with every non-letter as a blank; None without any letter."""
    if not text:
        return None
    points = np.frombuffer(text.decode().lower().encode("utf-32-le"), np.uint32)
    points = np.where(_letters()[points], points, 32).astype(np.uint64)
    return points if (points != 32).any() else None


def gram_counts(points: np.ndarray) -> np.ndarray:
    """Counts per bucket of the 1-, 2- and 3-grams, a blank added at both ends."""
    edge = np.array([32], np.uint64)
    one = np.concatenate([edge, points, edge])
    two = (one[:-1] << np.uint64(21)) | one[1:]
    three = (two[:-1] << np.uint64(21)) | one[2:]
    grams = np.concatenate([points, two | np.uint64(1 << 63), three ^ np.uint64(3 << 62)])
    return np.bincount(((grams * _MIX) >> np.uint64(64 - _BITS)).astype(np.int64), minlength=BUCKETS)


def tf_idf(counts: np.ndarray, idf: np.ndarray) -> Row:
    at = np.flatnonzero(counts)
    x = (1.0 + np.log(counts[at])) * idf[at]
    norm = np.sqrt((x * x).sum())
    return at, (x / norm if norm else x)


def document_frequencies(docs: DataFrame, text: str = "text") -> tuple[int, np.ndarray]:
    """Documents with letters, and per bucket those that have one of its n-grams; over every row of ``docs``."""

    def run(batches):
        seen, n = np.zeros(BUCKETS, np.int64), 0
        for batch in batches:
            for t in as_binary(batch, "text"):
                points = _code_points(t)
                if points is not None:
                    seen += gram_counts(points) > 0
                    n += 1
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(at, -1).astype(np.int32)), pa.array(np.append(seen[at], n))], names=["bucket", "n"]
        )

    counted = arrow_map(docs.select(F.col(text).alias("text")), run, "bucket int, n long")
    out, total = np.zeros(BUCKETS, np.int64), 0
    for bucket, n in counted.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # BUCKETS rows at most
        if bucket < 0:
            total = n
        else:
            out[bucket] = n
    return total, out


def _sample(docs: DataFrame, per_lang: int, doc_id: str, text: str, lang: str) -> DataFrame:
    """(lang, text) of at most ``per_lang`` documents of each language, chosen by id hash."""
    key = F.xxhash64(F.col(doc_id))
    named = docs.filter(F.col(doc_id).isNotNull() & F.col(lang).isNotNull() & F.col(text).isNotNull())
    order = Window.partitionBy("lang").orderBy("h", "doc_id")
    ids = named.select(F.col(doc_id).alias("doc_id"), F.col(lang).alias("lang"), key.alias("h"))
    sizes = ids.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), "lang").limit(LANGS)
    sizes = saved(sizes, "lang-sizes")
    chosen = saved(
        ids.join(sizes, "lang").filter(hash_share(F.col("h"), 2.0 * per_lang / F.col("n")))
        .withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= per_lang)
        .select("doc_id", "lang")
        .distinct(),
        "lang-sample",
    )
    return named.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).join(chosen, "doc_id")


class LanguageModel:
    """Language codes, idf per bucket, weights per language and bucket, temperature."""

    def __init__(self, langs: list[str], idf: np.ndarray, weights: np.ndarray, heat: float) -> None:
        self.langs, self.idf, self.weights, self.heat = langs, idf, weights, heat

    def predict(self, text: bytes | None) -> tuple[str, float]:
        points = _code_points(text)
        if points is None or not self.langs:
            return UNDETERMINED, 0.0
        p = softmax(logits(self.weights, tf_idf(gram_counts(points), self.idf)) / self.heat)
        best = int(p.argmax())
        return self.langs[best], float(p[best])


def fit(
    learn: DataFrame,
    per_lang: int = PER_LANG,
    epochs: int = 3,
    doc_id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
) -> LanguageModel:
    """Learn from the rows of ``learn`` with a lang: n-gram statistics from all, weights from a sample."""
    learn = learn.filter(F.col(lang).isNotNull())
    total, seen = document_frequencies(learn, text)
    idf = np.log((1.0 + total) / (1.0 + seen)) + 1.0

    def run(batches):
        for batch in batches:
            langs, at, x = [], [], []
            for t, code in zip(as_binary(batch, "text"), batch.column(1).to_pylist()):
                points = _code_points(t)
                if points is not None:
                    row = tf_idf(gram_counts(points), idf)
                    langs.append(code)
                    at.append(row[0].astype(np.int32).tobytes())
                    x.append(row[1].astype(np.float32).tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(langs, pa.string()), pa.array(at, pa.binary()), pa.array(x, pa.binary())],
                names=["lang", "at", "x"],
            )

    sample = _sample(learn, per_lang, doc_id, text, lang).select("text", F.col("lang").cast("string"))
    features = saved(arrow_map(sample, run, "lang string, at binary, x binary"), "lang-features")
    number = features.select("lang").distinct().count()  # LANGS at most
    order = Window.partitionBy("lang").orderBy(F.xxhash64("at", "x"), "at", "x").rowsBetween(Window.unboundedPreceding, 0)
    size = F.length("at") + F.length("x")
    kept = features.withColumn("before", F.sum(size).over(order) - size).filter(F.col("before") < SAMPLE_BYTES // max(1, number))
    found = sorted(map(tuple, kept.drop("before").collect()))
    langs = sorted({code for code, _, _ in found})
    rows = [(np.frombuffer(at, np.int32), np.frombuffer(x, np.float32).astype(float)) for _, at, x in found]
    labels = np.array([langs.index(code) for code, _, _ in found], int)
    held = np.arange(len(rows)) % 5 == 4
    model = SparseFTRL(max(1, len(langs)), BUCKETS)
    model.fit([r for r, h in zip(rows, held) if not h], labels[~held], epochs)
    weights = model.weights
    tested = np.array([logits(weights, r) for r, h in zip(rows, held) if h]).reshape(-1, max(1, len(langs)))
    return LanguageModel(langs, idf, weights, temperature(tested.T, labels[held]))


def predict(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """``docs`` with lang_pred and score appended (columns of these names are replaced).

    Texts that are null or without a letter get ``und`` and score 0; every row
    and its other columns stay.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # classes x BUCKETS floats
    kept = docs.drop("lang_pred", "score")
    out = kept.withColumns({"lang_pred": F.lit(None).cast("string"), "score": F.lit(None).cast("double")})

    def run(batches):
        m = shared.value
        for batch in batches:
            made = [m.predict(t) for t in as_binary(batch, text)]
            columns = [*batch.columns[:-2], pa.array([x for x, _ in made], pa.string()), pa.array([s for _, s in made])]
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return arrow_map(out, run, out.schema)


def identify(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", per_lang: int = PER_LANG
) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every document.

    Learns from the text and the non-null lang of documents whose
    crc32(doc_id as text) mod 3 is not 1 (a null id is never learned from and
    not held out), and from nothing else: what the others hold changes no
    other row.  Without any labelled document all texts are ``und``.
    """
    slot = F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3
    model = fit(docs.filter(slot != 1), per_lang, doc_id=doc_id, text=text, lang=lang)
    named = docs.select(
        F.col(doc_id).alias("doc_id"), F.coalesce(slot == 1, F.lit(False)).alias("held_out"), F.col(text).alias("text")
    )
    return predict(named, model).drop("text")


def reject_unidentified(docs: DataFrame, min_score: float = 0.35, doc_id: str = "doc_id") -> DataFrame:
    """``docs`` without documents whose language can't be told: ``und``, or a best probability below ``min_score``."""
    slot = F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3
    model = fit(docs.filter(slot != 1), doc_id=doc_id)
    numbered = docs.withColumnsRenamed({c: f"c{i}" for i, c in enumerate(docs.columns)})
    scored = predict(numbered, model, f"c{docs.columns.index('text')}")
    kept = scored.filter((F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= min_score))
    return kept.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)])
