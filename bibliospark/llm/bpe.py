"""Byte-level BPE encoding and decoding with forced boundaries (operator 6).

A byte pair that occurs inside no vocabulary token can never be merged over,
so it is a certain token boundary.  Each pre-token is cut at such pairs, the
fragments are encoded independently and the ids are concatenated (and
remembered by pre-token, as most of them recur).  Decoding joins the tokens' bytes.

Everything is row-local: no shuffle, one pass over the texts, memory bounded
by one Arrow batch and the size of the fragment cache.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, as_binary

# Fixed value: the pre-token pattern of byte-level BPE (\s is the Unicode
# White_Space property here, which Python's \s is not).
PRETOKEN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)
# Remembered pre-tokens per Python worker; the memory starts afresh beyond it
# (and holds all of one text's, however many they are).
CACHE = 400_000
# Bits of an id; fragments of more bytes are merged with a heap.
PAIR, LONG = 20, 48


def byte_alphabet() -> dict[str, int]:
    """Printable stand-in of each byte: itself if visible, else from U+0100 upwards in byte order."""
    out, extra = {}, 0
    for b in range(256):
        if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255:
            out[chr(b)] = b
        else:
            out[chr(256 + extra)] = b
            extra += 1
    return out


class ForcedBoundaryBPE:
    """Encoder and decoder of one ``tokenizers`` JSON file (byte-level BPE)."""

    def __init__(self, spec: str) -> None:
        conf = json.loads(spec)
        model, pre = conf["model"], conf.get("pre_tokenizer") or {}
        unsupported = [
            conf.get("normalizer"),
            model.get("dropout"),
            model.get("ignore_merges"),
            pre.get("add_prefix_space"),
            model["type"] != "BPE",
            pre.get("type") != "ByteLevel",
            not pre.get("use_regex", True),
            any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in conf["added_tokens"]),
        ]
        if any(unsupported):
            raise ValueError("only plain byte-level BPE files are supported")
        alphabet = byte_alphabet()
        raw = lambda token: bytes(alphabet[c] for c in token)
        ids = {raw(t): i for t, i in model["vocab"].items()}
        self.bytes_of = {i: t for t, i in ids.items()}
        self.byte_id = [ids[bytes([b])] for b in range(256)]
        self.rank: dict[int, int] = {}  # by the pair's two ids in one integer
        self.merged: list[int] = []  # by rank
        for pair in model["merges"]:
            left, right = map(raw, pair if isinstance(pair, list) else pair.split(" "))
            self.rank.setdefault(ids[left] << PAIR | ids[right], len(self.merged))
            self.merged.append(ids[left + right])
        self.inside = {t[i : i + 2] for t in ids for i in range(len(t) - 1)}
        self.special = {t["content"]: t["id"] for t in conf["added_tokens"]}
        for text, i in self.special.items():
            self.bytes_of[i] = text.encode()
        longest_first = sorted(self.special, key=len, reverse=True)
        self.split_special = (
            regex.compile("(" + "|".join(map(regex.escape, longest_first)) + ")").split
            if self.special
            else lambda text: [text]
        )
        self.pretokens = regex.compile(PRETOKEN).findall
        self.joined: dict[str, str] = {}
        self.packing = False
        self.packed: dict[str, bytes] = {}  # kept from the first text on whose ids are asked for
        self.raw: dict[str, bytes] = {}

    def cut(self, piece: bytes) -> list[bytes]:
        """``piece`` cut at every byte pair that no vocabulary token contains."""
        out, start = [], 0
        for i in range(1, len(piece)):
            if piece[i - 1 : i + 1] not in self.inside:
                out.append(piece[start:i])
                start = i
        out.append(piece[start:])
        return out

    def merge(self, fragment: bytes) -> list[int]:
        """Lowest-ranked merge first, leftmost among equals, until none applies."""
        ids = [self.byte_id[b] for b in fragment]
        if len(ids) > LONG:
            return self._merge_long(ids)
        get, none = self.rank.get, len(self.merged)
        ranks = [get(a << PAIR | b, none) for a, b in zip(ids, ids[1:])]
        while ranks:
            low = min(ranks)
            if low == none:
                break
            i = ranks.index(low)
            ids[i : i + 2] = [self.merged[low]]
            del ranks[i]
            if i:
                ranks[i - 1] = get(ids[i - 1] << PAIR | ids[i], none)
            if i < len(ranks):
                ranks[i] = get(ids[i] << PAIR | ids[i + 1], none)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same order of merges with a heap over a linked list: n log n for very long fragments."""
        n, get = len(ids), self.rank.get
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []

        def offer(i: int) -> None:
            j = after[i]
            if j < n and (r := get(ids[i] << PAIR | ids[j])) is not None:
                heapq.heappush(heap, (r, i, ids[i], ids[j]))

        for i in range(n - 1):
            offer(i)
        while heap:
            r, i, left, right = heapq.heappop(heap)
            j = after[i] if ids[i] == left else n
            if j >= n or ids[j] != right:
                continue  # one of the two has been merged meanwhile
            ids[i], ids[j] = self.merged[r], -1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return [t for t in ids if t >= 0]

    def piece_ids(self, pretoken: str) -> list[int]:
        fragments = self.cut(pretoken.encode())
        if len(fragments) == 1:
            return self.merge(fragments[0])
        return [i for f in fragments for i in self.merge(f)]

    def decode(self, ids: Iterable[int]) -> str:
        return b"".join([self.bytes_of[i] for i in ids]).decode("utf-8", "replace")

    def learn(self, pretokens: set[str]) -> None:
        """Remember the ids (comma-joined, and as int32) and the decoded bytes of these pre-tokens."""
        for p in pretokens:
            ids = self.piece_ids(p)
            self.joined[p] = ",".join(map(str, ids))
            if self.packing:
                self.packed[p] = array("i", ids).tobytes()
            self.raw[p] = b"".join([self.bytes_of[i] for i in ids])

    def parts(self, text: str, packed: bool) -> Iterator[list[str]]:
        """The text as lists of known pre-tokens; a special token is a list of its own."""
        if packed and not self.packing:
            self.packing, self.joined, self.raw = True, {}, {}
        for part in self.split_special(text):
            if part in self.special:
                i = self.special[part]
                self.joined[part], self.packed[part], self.raw[part] = str(i), array("i", [i]).tobytes(), part.encode()
                yield [part]
                continue
            pretokens = self.pretokens(part)
            distinct = set(pretokens)
            if new := distinct.difference(self.joined):
                if len(self.joined) + len(new) > CACHE:
                    self.joined, self.packed, self.raw = {}, {}, {}
                    new = distinct
                self.learn(new)
            yield pretokens

    def encode(self, text: str) -> np.ndarray:
        """The ids of a text."""
        return np.frombuffer(b"".join([x for p in self.parts(text, True) for x in map(self.packed.__getitem__, p)]), np.int32)

    def digest(self, text: str, packed: list[bytes] | None = None) -> tuple[int, str, str]:
        """Number of ids, sha256 of the comma-joined ids, sha256 of the decoded text; the ids go to ``packed``."""
        ids: list[str] = []
        raw: list[bytes] = []
        for pretokens in self.parts(text, packed is not None):
            ids += map(self.joined.__getitem__, pretokens)
            raw += map(self.raw.__getitem__, pretokens)
            if packed is not None:
                packed += map(self.packed.__getitem__, pretokens)
        joined = ",".join(ids)
        decoded = b"".join(raw).decode("utf-8", "replace").encode()
        n = joined.count(",") + 1 if joined else 0
        return n, hashlib.sha256(joined.encode()).hexdigest(), hashlib.sha256(decoded).hexdigest()


_LOADED: dict[str, ForcedBoundaryBPE] = {}


def load(spec: str) -> ForcedBoundaryBPE:
    """The coder of a tokenizer file; a Python worker keeps it for its next tasks."""
    key = hashlib.sha256(spec.encode()).hexdigest()
    if key not in _LOADED:
        _LOADED[key] = ForcedBoundaryBPE(spec)
    return _LOADED[key]


def _ship(df: DataFrame, tokenizer_path: str) -> str:
    """The tokenizer file's content; a bounded parameter (about 1.5 MB), sent once per executor."""
    with open(tokenizer_path, encoding="utf-8") as f:
        spec = f.read()
    return df.sparkSession.sparkContext.broadcast(spec)


def encode(df: DataFrame, tokenizer_path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``df`` with a column ``ids`` (array<int>) of the whole text's token ids.

    A null text encodes to an empty array.  A column already called ``ids``
    is replaced.  Rows, order of columns and repeats stay as they are.
    """
    return _with_arrow(df, tokenizer_path, ids, "array<int>", text, lambda bpe, t: bpe.encode(t or ""))


def decode(df: DataFrame, tokenizer_path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``df`` with a column ``text`` decoded from ``ids`` (null or empty: empty text)."""
    return _with_arrow(df, tokenizer_path, text, "string", ids, lambda bpe, i: bpe.decode(i or []))


def _with_arrow(df: DataFrame, tokenizer_path: str, name: str, kind: str, source: str, fn) -> DataFrame:
    spec = _ship(df, tokenizer_path)
    taken = {c.lower() for c in df.columns}
    tmp = name
    while tmp.lower() in taken:
        tmp += "_"
    out = df.withColumn(tmp, F.lit(None).cast(kind))

    def run(batches):
        bpe = load(spec.value)
        for batch in batches:
            values = batch.column(batch.schema.get_field_index(source)).to_pylist()
            at = batch.schema.get_field_index(tmp)
            made = pa.array([fn(bpe, v) for v in values], batch.schema.field(at).type)
            yield pa.RecordBatch.from_arrays(
                [made if i == at else batch.column(i) for i in range(batch.num_columns)], schema=batch.schema
            )

    out = arrow_map(out, run, out.schema)
    return out if tmp == name else out.drop(name).withColumnRenamed(tmp, name)


ROWS = 500  # texts whose ids are handed on together


def encode_digest(
    docs: DataFrame, tokenizer_path: str, doc_id: str = "doc_id", text: str = "text", with_ids: bool = False
) -> DataFrame:
    """Per document: n_tokens, ids_sha256, decoded_sha256 (a round trip through both directions).

    ``with_ids`` appends the token ids themselves.  Null and empty texts have
    0 tokens and the digests of the empty string; repeated rows give repeated
    results; an empty table gives no rows.
    """
    spec = _ship(docs, tokenizer_path)

    def run(batches):
        bpe = load(spec.value)
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                packed: list[bytes] | None = [] if with_ids else None
                made = [bpe.digest(t.decode() if t else "", packed) for t in as_binary(batch, "text")]
                columns = {
                    "doc_id": batch.column(0),
                    "n_tokens": pa.array([m[0] for m in made], pa.int64()),
                    "ids_sha256": pa.array([m[1] for m in made], pa.string()),
                    "decoded_sha256": pa.array([m[2] for m in made], pa.string()),
                }
                if with_ids:
                    ends = np.concatenate([[0], np.cumsum([m[0] for m in made])]).astype(np.int32)
                    flat = np.frombuffer(b"".join(packed), np.int32)
                    columns["ids"] = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))
                yield pa.RecordBatch.from_pydict(columns)

    kind = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids
    return arrow_map(docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")), run, kind)
