"""Token counts by the whole-token shortcut (operator 13).

Most pre-tokens of a text are vocabulary strings that encode alone as one
token.  Which strings do so is proved once, before any text is read: every
vocabulary string that can be a whole pre-token is merged from its bytes, and
kept if exactly one token is left.  Such pre-tokens count 1 by a lookup; only
the rest are merged (and remembered, as most of them recur).

Everything is row-local: no shuffle, one pass over the texts.  Memory is
bounded by one Arrow batch, the remembered pre-tokens and a window of the
text at hand.

Covered are tokenizer files as ``word_bpe_49k.json`` is: BPE over bytes with a
word-end mark, texts in NFC, lower-cased, cut by the pattern below.  Unicode
tables differ between libraries, so each character beyond ASCII is compared
with the tokenizer library's own treatment the first time a worker meets it;
a text with a character on which the two disagree is counted by that library.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .bpe import byte_alphabet
from .common import arrow_map, as_binary

# The file's pre-token pattern, and the same in the notation of
# the two regex libraries (\s is the Unicode White_Space property there).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
UNICODE_PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\p{White_Space}\p{L}\p{N}]+"
ASCII_PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\x09-\x0D\x20a-z0-9]+"
NORMALIZERS = [
    {"type": "NFC"},
    {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "},
    {"type": "Lowercase"},
]
# Merged pre-tokens remembered per Python worker, and the characters of a text handled at once.
CACHE, WINDOW = 300_000, 1 << 20
_BLANK = re.compile(r"[ \n]")


class WholeTokenCounter:
    """Counts the tokens of texts as the ``tokenizers`` library does for one file."""

    def __init__(self, spec: str, whole: set[str] | None = None) -> None:
        conf = json.loads(spec)
        model = conf["model"]
        _check(conf)
        self.spec, self.library = spec, None
        self.suffix = model["end_of_word_suffix"]
        self.vocab: dict[str, int] = model["vocab"]
        self.alphabet = {b: c for c, b in byte_alphabet().items()}
        if missing := [c for c in self.alphabet.values() if c not in self.vocab or c + self.suffix not in self.vocab]:
            raise ValueError(f"the vocabulary lacks {len(missing)} single bytes")
        self.rank: dict[tuple[int, int], tuple[int, int]] = {}
        for left, right in (m if isinstance(m, list) else m.split(" ") for m in model["merges"]):
            pair = self.vocab[left], self.vocab[right]
            self.rank.setdefault(pair, (len(self.rank), self.vocab[left + right]))
        self.specials = {t["content"] for t in conf["added_tokens"]}
        longest_first = sorted(map(regex.escape, self.specials), key=len, reverse=True)
        self.split = regex.compile("|".join(longest_first)).split if self.specials else None
        self.ascii_pieces = re.compile(ASCII_PIECES, re.ASCII).findall
        self.pieces = regex.compile(UNICODE_PIECES).findall
        self.whole = self.prove() if whole is None else whole
        self.agreed = set(map(chr, range(128)))
        self.odd: set[str] = set()
        self.known: dict[str, int] = dict.fromkeys(self.whole, 1)

    def prove(self) -> set[str]:
        """The vocabulary strings that are a pre-token by themselves and are left as one token by its merges."""
        raw = {c: b for b, c in self.alphabet.items()}
        found = set()
        for token in self.vocab:
            if not token.endswith(self.suffix):
                continue
            try:
                piece = bytes(raw[c] for c in token.removesuffix(self.suffix)).decode()
            except (KeyError, UnicodeDecodeError):
                continue  # part of a character: no pre-token ends or begins there
            if self.pieces(_normal(piece)) == [piece] and self.merged(piece) == [self.vocab[token]]:
                found.add(piece)
        return found

    def merged(self, piece: str) -> list[int]:
        """Ids of one pre-token: lowest-ranked merge first, leftmost among equals (a heap over a linked list)."""
        symbols = [self.alphabet[b] for b in piece.encode()]
        symbols[-1] += self.suffix
        ids = [self.vocab[s] for s in symbols]
        n, get = len(ids), self.rank.get
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(*r, i, ids[i], ids[i + 1]) for i in range(n - 1) if (r := get((ids[i], ids[i + 1])))]
        # ordered by rank, then by place: a rank has one merged id
        heapq.heapify(heap)
        while heap:
            _, new, i, left, right = heapq.heappop(heap)
            j = after[i]
            if ids[i] != left or j >= n or ids[j] != right:
                continue  # one of the two has been merged meanwhile
            ids[i], ids[j] = new, -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if r := get((new, ids[k])):
                    heapq.heappush(heap, (*r, i, new, ids[k]))
            if (h := before[i]) >= 0 and (r := get((ids[h], new))):
                heapq.heappush(heap, (*r, h, ids[h], new))
        return [t for t in ids if t >= 0]

    def count(self, text: str) -> int:
        """Tokens of a whole text; special strings in it are one token each."""
        if not text.isascii():
            if new := set(text) - self.agreed - self.odd:
                for c in new:
                    (self.agreed if self._agrees(c) else self.odd).add(c)
            if self.odd and not self.odd.isdisjoint(text):
                return len(self._library().encode(text, add_special_tokens=False).ids)
        if self.split is None or not any(s in text for s in self.specials):
            return sum(map(self._count_part, _windows(text)))
        parts = self.split(text)
        return len(parts) - 1 + sum(self._count_part(w) for p in parts for w in _windows(p))

    def _count_part(self, text: str) -> int:
        pieces = self.ascii_pieces(text.lower()) if text.isascii() else self.pieces(_normal(text))
        known = self.known
        if new := set(pieces).difference(known):
            if len(known) + len(new) > CACHE:
                known = self.known = dict.fromkeys(self.whole, 1)
                new = set(pieces).difference(known)
            for p in new:
                known[p] = len(self.merged(p))
        return sum(map(known.__getitem__, pieces))

    def _agrees(self, c: str) -> bool:
        """Whether we normalize and cut the character as the library does."""
        if unicodedata.category(c) == "Cn":
            return False  # compositions of later Unicode versions are not known here
        library, probe = self._library(), f"a{c}{c}1"
        ours = ["".join([self.alphabet[b] for b in p.encode()]) for p in self.pieces(_normal(probe))]
        normal = library.normalizer.normalize_str(probe)
        return ours == [p for p, _ in library.pre_tokenizer.pre_tokenize_str(normal)]

    def _library(self) -> Tokenizer:
        if self.library is None:
            self.library = Tokenizer.from_str(self.spec)
            self.library.no_truncation()
            self.library.no_padding()
        return self.library


def _check(conf: dict) -> None:
    model, pre = conf["model"], (conf.get("pre_tokenizer") or {}).get("pretokenizers") or [{}, {}]
    supported = (
        model["type"] == "BPE"
        and model.get("end_of_word_suffix")
        and not any(model.get(k) for k in ("dropout", "ignore_merges", "unk_token", "continuing_subword_prefix"))
        and (conf.get("normalizer") or {}).get("normalizers") == NORMALIZERS
        and [p.get("type") for p in pre] == ["Split", "ByteLevel"]
        and (pre[0]["pattern"], pre[0]["behavior"], pre[0]["invert"]) == ({"Regex": PATTERN}, "Removed", True)
        and not (pre[1]["use_regex"] or pre[1]["add_prefix_space"])
        and not any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in conf["added_tokens"])
    )
    if not supported:
        raise ValueError("only BPE files with a word-end mark, NFC and lower case are supported")


def _normal(text: str) -> str:
    """NFC, each character lower-cased by itself (``lower`` alone would make a final sigma)."""
    return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()


def _windows(text: str) -> Iterator[str]:
    """The text in pieces of about ``WINDOW`` characters, cut before blanks, which no pre-token holds."""
    at = 0
    while len(text) - at > WINDOW and (blank := _BLANK.search(text, at + WINDOW)):
        yield text[at : blank.start()]
        at = blank.start()
    yield text[at:] if at else text


_LOADED: dict[str, WholeTokenCounter] = {}


def load(spec: str, whole: list[str]) -> WholeTokenCounter:
    """The counter of a tokenizer file; a Python worker keeps it for its next tasks."""
    key = hashlib.sha256(spec.encode()).hexdigest()
    if key not in _LOADED:
        _LOADED[key] = WholeTokenCounter(spec, set(whole))
    return _LOADED[key]


def count_tokens(
    docs: DataFrame, tokenizer_path: str, limit: int = 2048, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Per document: n_bytes (UTF-8), n_tokens, over_limit (more than ``limit`` tokens).

    Null and empty texts have 0 bytes and 0 tokens; repeated rows give
    repeated results; an empty table gives no rows; other columns do not
    matter, whatever their names.  The file and the strings proved to be one
    token travel by Spark broadcast: a parameter of bounded size.
    """
    with open(tokenizer_path, encoding="utf-8") as f:
        spec = f.read()
    shipped = docs.sparkSession.sparkContext.broadcast((spec, sorted(WholeTokenCounter(spec).whole)))

    def run(batches):
        counter = load(*shipped.value)
        for batch in batches:
            raw = as_binary(batch, "text")
            n = [counter.count(t.decode()) if t else 0 for t in raw]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(t or b"") for t in raw], pa.int64()),
                    pa.array(n, pa.int64()),
                    pa.array([x > limit for x in n], pa.bool_()),
                ],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    named = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return arrow_map(named, run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
