"""Toxicity scores after noisy-channel deobfuscation (operator 7).

A writer's intended letters pass through a channel that swaps letters for
look-alike digits and signs, spaces words out and repeats letters.  Every run
of characters that shows a trace of this becomes a lattice of readings, and
Viterbi picks the reading that channel costs and a character trigram model
like best.  The trigram model counts every text of the corpus.  A run without
such a trace has a one-path lattice and stays as it is.

The restored text is scored by sparse logistic regression on the presence of
words and word beginnings.  Their label statistics cover all labelled
documents given, and every feature that is often enough and associated enough
is used; the weights are fitted on a bounded sample (``MAX_FIT`` documents).
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, as_binary, hash_share, saved
from .ftrl import SparseFTRL, logits, softmax

# Labelled documents that the weights are fitted on, at most.
MAX_FIT = 8000
# Share of the toxic or of the other labelled documents that must hold a feature.  It bounds the
# features without a cap: at most (features of a mean document of either label) / MIN_SHARE.
MIN_SHARE = 0.001
# Chi-squared that a feature needs: by chance fewer than one in a hundred thousand has it.
MIN_CHI = 20.0
# Entries of a task's count table before it is handed on and started afresh.
FLUSH = 300_000

# Look-alike signs and the letters they stand for.
LOOK_ALIKE = {
    "0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "¡": "i", "*": "aeiou",
}
LETTERS = r"[^\W\d_]"
_SIGNS = "[" + "".join(re.escape(c) for c in LOOK_ALIKE) + "]"
_LAST = "[" + "".join(re.escape(c) for c in LOOK_ALIKE if c not in "!|(+*") + "]"  # the others end words as punctuation
_GAPS = " .-_*·"
_GAP = "[" + re.escape(_GAPS) + "]"
# Costs (negative log probabilities) of the channel.
SWAP, KEEP_SIGN, DOUBLED, SQUEEZED, CLOSE_GAP, KEEP_GAP = 1.5, 6.0, 1.0, 0.7, 0.4, 4.0

# Three or more single characters spaced out; of three, two are letters.
_ONE, _END = f"(?:{LETTERS}|{_SIGNS})", f"(?:{LETTERS}|{_LAST})"
SPACED = re.compile(
    rf"(?<!\w)(?:{_ONE}(?:{_GAP}{_ONE}){{2,}}{_GAP}{_END}"
    rf"|{LETTERS}{_GAP}{LETTERS}{_GAP}{_END}|{LETTERS}{_GAP}{_SIGNS}{_GAP}{LETTERS}|{_SIGNS}{_GAP}{LETTERS}{_GAP}{LETTERS})(?!\w)"
)
# Within a token: a word with signs before, between or after letters, or a letter three times running.
TRACE = re.compile(
    rf"(?<!{LETTERS}){LETTERS}*(?:{_SIGNS}{{1,3}}{LETTERS}+)+(?:{_LAST}{{1,2}}(?!\w))?"
    rf"|(?<!{LETTERS}){LETTERS}+{_LAST}{{1,2}}(?!\w)"
    rf"|(?<!{LETTERS}){LETTERS}*?({LETTERS})\1\1{LETTERS}*"
)
# Cheap, and present wherever TRACE is.
HINT = re.compile(rf"{_SIGNS}{LETTERS}|{LETTERS}{_LAST}|({LETTERS})\1\1")
WORD = re.compile(rf"{LETTERS}+")

_CLASSES = 28  # 0 any non-letter, 1-26 a-z (accents dropped), 27 other letters
_FOLD: list[np.ndarray] = []


def _fold() -> np.ndarray:
    """The class of every code point; built once per Python worker."""
    if not _FOLD:
        table = np.zeros(0x110000, np.uint8)
        for i in range(0x110000):
            c = chr(i)
            if c.isalpha():
                base = unicodedata.normalize("NFD", c)[0].lower() if i < 0x2000 else ""
                table[i] = ord(base) - 96 if len(base) == 1 and "a" <= base <= "z" else 27
        _FOLD.append(table)
    return _FOLD[0]


def trigram_counts(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Counts of the folded character trigrams of all texts: 28^3 numbers, whatever the corpus."""

    def run(batches):
        total = np.zeros(_CLASSES**3, np.int64)
        for batch in batches:
            for t in as_binary(batch, "text"):
                if t:
                    points = np.frombuffer(t.decode().encode("utf-32-le"), np.uint32)
                    c = np.zeros(len(points) + 4, np.int32)
                    c[2:-2] = _fold()[points]
                    total += np.bincount((c[:-2] * _CLASSES + c[1:-1]) * _CLASSES + c[2:], minlength=len(total))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["gram", "n"])

    counted = arrow_map(docs.select(F.col(text).alias("text")), run, "gram int, n long")
    out = np.zeros(_CLASSES**3)
    for gram, n in counted.groupBy("gram").agg(F.sum("n")).collect():  # 28^3 rows at most
        out[gram] = n
    return out


class Deobfuscator:
    """Viterbi decoding of suspicious character runs."""

    def __init__(self, counts: np.ndarray) -> None:
        grams = counts.reshape(_CLASSES, _CLASSES, _CLASSES) + 0.1
        self.seen = counts > 0
        self.cost = (-np.log(grams / grams.sum(axis=2, keepdims=True))).tolist()

    def _units(self, run: str) -> list[list[tuple[str, float]]]:
        """The lattice: for each group of equal characters, its readings and their channel costs."""
        spaced = len(run) > 4 and all(c in _GAPS for c in run[1::2])
        out = []
        i = 0
        while i < len(run):
            c, j = run[i], i
            while j < len(run) and run[j] == c:
                j += 1
            n, i = j - i, j
            meant = [(x * k, SWAP + DOUBLED * (k - 1)) for x in LOOK_ALIKE.get(c, "") for k in {1, min(n, 2)}]
            if spaced and (j & 1) == 0 and c in _GAPS:
                out.append([("", CLOSE_GAP), *meant, (c, KEEP_GAP)])
            elif c.isalpha():
                if n == 1:
                    out.append([(c, 0.0)])
                elif n == 2:
                    out.append([(c * 2, 0.0), (c, DOUBLED)])
                else:
                    out.append([(c, SQUEEZED), (c * 2, SQUEEZED + DOUBLED)])
            else:
                out.append([*meant, (c * n, KEEP_SIGN)])
        return out

    def decode(self, run: str) -> str:
        """The cheapest reading of one run, lower-cased."""
        classes = _fold()
        states, steps = {(0, 0): 0.0}, []
        for readings in [*self._units(run.lower()), [(" ", 0.0)]]:
            after: dict[tuple[int, int], float] = {}
            back: dict[tuple[int, int], tuple[tuple[int, int], str]] = {}
            for state, cost in states.items():
                for reading, channel in readings:
                    (x, y), total = state, cost + channel
                    for ch in reading:
                        z = int(classes[ord(ch)])
                        total += self.cost[x][y][z]
                        x, y = y, z
                    if total < after.get((x, y), np.inf):
                        after[x, y], back[x, y] = total, (state, reading)
            states = after
            steps.append(back)
        state, out = min(states, key=lambda k: (states[k], k)), []
        for back in reversed(steps):
            state, reading = back[state]
            out.append(reading)
        return "".join(reversed(out[1:]))

    def restore(self, text: str) -> str:
        """``text`` with every suspicious run decoded."""
        out, done = [], 0
        for spaced in SPACED.finditer(text):
            out += self._tokens(text[done : spaced.start()]), self._closed(spaced[0])
            done = spaced.end()
        return "".join([*out, self._tokens(text[done:])]) if done else self._tokens(text)

    def _closed(self, run: str) -> str:
        """A spaced run decoded; three characters stay as they are where the corpus lacks a trigram of the reading."""
        read = self.decode(run)
        if len(run) > 5:
            return read
        c = [0, *_fold()[[ord(x) for x in read]].tolist(), 0]
        return read if all(self.seen[(x * _CLASSES + y) * _CLASSES + z] for x, y, z in zip(c, c[1:], c[2:])) else run

    def _tokens(self, text: str) -> str:
        """``text`` with the suspicious runs within its tokens decoded."""
        out, done, n = [], 0, len(text)
        for hint in HINT.finditer(text):
            i, j = hint.span()
            if i < done:
                continue
            while i > done and not text[i - 1].isspace():
                i -= 1
            while j < n and not text[j].isspace():
                j += 1
            out += text[done:i], TRACE.sub(lambda m: self.decode(m[0]), text[i:j])
            done = j
        return "".join([*out, text[done:]]) if done else text


def _features(text: str) -> set[str]:
    """Words, and their first four and five letters (marked by a blank), lower-cased."""
    words = set(WORD.findall(text.lower()))
    return words | {f" {w[:4]}" for w in words if len(w) > 4} | {f" {w[:5]}" for w in words if len(w) > 5}


def _associated(learn: DataFrame, n0: float, n1: float, lm) -> list[str]:
    """All features associated with the label, by chi-squared over all rows of ``learn``."""

    def run(batches):
        restore = Deobfuscator(lm.value).restore
        counts: tuple[Counter, Counter] = Counter(), Counter()

        def flush():
            keys = list(counts[0].keys() | counts[1].keys())
            made = pa.RecordBatch.from_arrays(
                [
                    pa.array(keys, pa.string()),
                    pa.array([counts[0][k] for k in keys], pa.int64()),
                    pa.array([counts[1][k] for k in keys], pa.int64()),
                ],
                names=["key", "n0", "n1"],
            )
            counts[0].clear(), counts[1].clear()
            return made

        for batch in batches:
            for t, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                counts[label].update(_features(restore(t)))
                if len(counts[0]) + len(counts[1]) > FLUSH:
                    yield flush()
        yield flush()

    counted = arrow_map(learn, run, "key string, n0 long, n1 long").groupBy("key").agg(
        F.sum("n0").alias("n0"), F.sum("n1").alias("n1")
    )
    both, apart = F.col("n0") + F.col("n1"), F.col("n1") * n0 - F.col("n0") * n1
    chi = apart * apart / (both * (n0 + n1 - both + 1.0) * n0 * n1) * (n0 + n1)
    often = (both >= 3) & ((F.col("n1") >= MIN_SHARE * n1) | (F.col("n0") >= MIN_SHARE * n0))
    return sorted(r[0] for r in counted.filter(often & (chi >= MIN_CHI)).select("key").collect())


class ToxicityModel:
    """Trigram counts, the features kept and their weights (the last one is the bias)."""

    def __init__(self, trigrams: np.ndarray, features: list[str], weights: np.ndarray) -> None:
        self.trigrams, self.features, self.weights = trigrams, features, weights

    def reader(self):
        """A function text -> indices of the features that its restored form has."""
        restore = Deobfuscator(self.trigrams).restore
        at = {f: i for i, f in enumerate(self.features)}
        known = frozenset(at)
        return lambda text: np.array(sorted([at[f] for f in known.intersection(_features(restore(text or "")))]), np.int64)

    def score(self, found: np.ndarray) -> float:
        return float(softmax(logits(self.weights, (found, np.ones(len(found)))))[1])


def fit(
    labelled: DataFrame, corpus: DataFrame, text: str = "text", label: str = "label", doc_id: str = "doc_id",
    max_fit: int = MAX_FIT, epochs: int = 4,
    within: Column | None = None,
) -> ToxicityModel:
    """Fit on the documents of ``corpus`` that ``labelled`` (doc_id, label) marks 0 or 1; trigrams from all of ``corpus``.

    Label statistics cover all of them; the weights are fitted on the
    ``max_fit`` with the smallest id hashes.  ``within`` tells which rows of
    ``corpus`` can have such a mark at all, so that other texts need not be
    shuffled.  Without a document of either label the model says 0.5 for every
    text.
    """
    spark = corpus.sparkSession
    trigrams = trigram_counts(corpus, text)
    lm = spark.sparkContext.broadcast(trigrams)
    texts = corpus if within is None else corpus.filter(within)
    texts = texts.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).filter("doc_id is not null and text is not null")
    marks = labelled.select(F.col(doc_id).alias("doc_id"), F.col(label).cast("int").alias("label"))
    marks = saved(marks.filter(F.col("label").isin(0, 1)).groupBy("doc_id").agg(F.max("label").alias("label")), "toxic-marks")
    sizes = {r[0]: float(r[1]) for r in marks.groupBy("label").count().collect()}  # two rows
    if len(sizes) < 2:
        return ToxicityModel(trigrams, [], np.zeros((2, 1), np.float32))
    # one plan at every size: the texts of labelled documents are shuffled once, and not kept
    learn = texts.join(marks.hint("merge"), "doc_id").select("text", "label")
    model = ToxicityModel(trigrams, _associated(learn, sizes[0], sizes[1], lm), np.zeros((2, 1), np.float32))
    shared = spark.sparkContext.broadcast(model)

    def run(batches):
        read = shared.value.reader()
        for batch in batches:
            made = [read(t).astype(np.int32).tobytes() for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(made, pa.binary())], names=["label", "at"])

    hashed = marks.filter(hash_share(F.xxhash64("doc_id"), 2.0 * max_fit / sum(sizes.values())))
    chosen = saved(hashed.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_fit), "toxic-sample")
    sample = texts.join(chosen, "doc_id").select("text", "label")
    found = sorted(map(tuple, arrow_map(sample, run, "label int, at binary").collect()))
    fitted = SparseFTRL(2, len(model.features), alpha=0.3, l1=0.05, l2=0.5)
    at = [np.frombuffer(a, np.int32) for _, a in found]
    fitted.fit([(a, np.ones(len(a))) for a in at], [y for y, _ in found], epochs)
    return ToxicityModel(trigrams, model.features, fitted.weights)


def score(docs: DataFrame, model: ToxicityModel, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row; null and empty texts get the model's prior."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # the features' bound: MIN_SHARE; 28^3 counts
    slot = F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5
    named = docs.select(
        F.col(doc_id).alias("doc_id"), F.coalesce(slot == 0, F.lit(False)).alias("held_out"), F.col(text).alias("text")
    )

    def run(batches):
        model, read = shared.value, shared.value.reader()
        for batch in batches:
            made = [model.score(read(t)) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(made, pa.float64()), pa.array([int(s >= 0.5) for s in made], pa.int32())],
                names=["doc_id", "held_out", "score", "predicted"],
            )

    return arrow_map(named, run, "doc_id long, held_out boolean, score double, predicted int")


def toxicity(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic") -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document.

    Learns from labelled documents whose crc32(doc_id as text) mod 5 is not 0.
    Repeated label rows count once; a document with both labels counts as toxic.
    """
    ids = F.col(doc_id).cast("string").cast("binary")
    learns = F.crc32(ids) % 5 != 0
    marks = labels.select(doc_id, F.col(label).alias("label")).filter(learns & F.col("label").isNotNull())
    return score(docs, fit(marks, docs, text, doc_id=doc_id, within=learns), doc_id, text)
