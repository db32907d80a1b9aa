"""Byte-level BPE: encoding by a priority queue of merge ranks, decoding by concatenation of vocabulary strings.

A pre-token is a doubly linked list of symbols and a heap of the pairs that may merge, each entry a rank and a place. An entry
whose pair has changed since it was pushed is stale and skipped. The vocabulary file is read by the driver, which sends its
bytes along; executors need no path.

A text is cut where no pre-token can reach across; pieces are encoded once and kept in a table of bounded size (`pieces`), since
prose repeats them.

Cases: a null text counts as empty and gives no ids; a null doc_id is an id as any other; repeated rows are encoded each; an empty table gives no rows; very long
texts are worked on piece by piece; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ._util import modest_batches
from .pieces import KEPT, PieceTable

#: The white space of the pre-tokeniser and the pattern of its pre-tokens.
SPACE = r"\t-\r \x85\xa0  -     　"
PRETOKEN = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"


def public_vocabulary() -> str:
    """The path of the default vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in the vocabulary: itself where printable, else the next unused one from U+0100."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Codec:
    """Encoder and decoder for one vocabulary file's contents."""

    def __init__(self, contents: bytes, kept: int = KEPT) -> None:
        import regex

        spec = json.loads(contents)
        letters = byte_letters()
        raw = lambda s: bytes(letters[c] for c in s)
        vocab = spec["model"]["vocab"]
        self.strings = {i: raw(s) for s, i in vocab.items()}
        ids = {self.strings[i]: i for i in vocab.values()}
        self.bytes = [ids[bytes([b])] for b in range(256)]
        pairs = (m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"])
        #: (left id, right id) as one integer: (rank, merged id)
        self.merges = {vocab[a] << 32 | vocab[b]: (rank, vocab[a + b]) for rank, (a, b) in enumerate(pairs)}
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.strings |= {i: s.encode() for s, i in self.special.items()}
        self.split = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.pretokens = regex.compile(PRETOKEN)
        self.table = PieceTable(self._pieces, kept)

    def merge(self, symbols: list[int]) -> list[int]:
        """The ids left after all merges, lowest rank first, leftmost of equals."""
        merges, n = self.merges, len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []
        for i in range(n - 1):
            found = merges.get(symbols[i] << 32 | symbols[i + 1])
            if found:
                heap.append((found[0], i, found[1]))
        heapq.heapify(heap)
        pop, push = heapq.heappop, heapq.heappush
        while heap:
            rank, i, merged = pop(heap)
            left = symbols[i]
            j = after[i]
            if left < 0 or j >= n:
                continue
            found = merges.get(left << 32 | symbols[j])
            if not found or found[0] != rank:  # stale: one of the two has merged otherwise meanwhile
                continue
            symbols[i], symbols[j] = merged, -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                found = merges.get(merged << 32 | symbols[k])
                if found:
                    push(heap, (found[0], i, found[1]))
            h = before[i]
            if h >= 0:
                found = merges.get(symbols[h] << 32 | merged)
                if found:
                    push(heap, (found[0], h, found[1]))
        return [s for s in symbols if s >= 0]

    def _pieces(self, pieces: list[str], sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of pieces between which no pre-token reaches, where each one's begin and how many they are."""
        ids: list[int] = []
        ends = []
        for piece in pieces:
            for word in self.pretokens.findall(piece):
                symbols = [self.bytes[b] for b in word.encode("utf-8", "replace")]
                ids += self.merge(symbols) if len(symbols) > 1 else symbols
            ends.append(len(ids))
        counts = np.diff(np.array(ends, np.int64), prepend=0)
        return np.array(ids, np.uint32), np.array(ends, np.int64) - counts, counts

    def encode_all(self, texts: list[str | None]) -> list[bytes]:
        """The ids of texts as little-endian unsigned 32-bit integers; strings of special tokens are special tokens."""
        # a list of parts for each text: special tokens' ids as they are, all else to be encoded
        parts, plain = [], []
        for t in texts:
            own: list[int | None] = []
            for i, p in enumerate(self.split.split(t) if t and self.split and any(s in t for s in self.special) else [t or ""]):
                own.append(self.special[p] if i % 2 else None)
                if not i % 2:
                    plain.append(p.encode("utf-8", "replace"))
            parts.append(own)
        made = iter(self.table.encode(plain))
        return [b"".join([(next(made).astype("<u4").tobytes() if x is None else x.to_bytes(4, "little")) for x in own]) for own in parts]

    def encode(self, text: str | None) -> bytes:
        """The ids of one text."""
        return self.encode_all([text])[0]

    def decode(self, ids: bytes) -> str:
        """The text of ids; bytes that are no UTF-8 become U+FFFD."""
        strings = self.strings
        return b"".join([strings[i] for i in memoryview(ids).cast("I")]).decode("utf-8", "replace")


_CODECS: dict[str, Codec] = {}


def codec_of(contents: bytes) -> Codec:
    """A worker's codec for a vocabulary, made once."""
    key = hashlib.sha256(contents).hexdigest()
    if key not in _CODECS:
        _CODECS[key] = Codec(contents)
    return _CODECS[key]


def digest(codec: Codec, ids: bytes) -> tuple[int, str, str]:
    """The number of ids, their SHA-256, and that of the text that they decode to."""
    return len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(codec.decode(ids).encode()).hexdigest()


def encode(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """doc_id and ids (array of int) of every row of docs(doc_id, text)."""
    return _mapped(docs, vocabulary, {"ids": (pa.list_(pa.int32()), "array<int>")}, lambda codec, ids: (memoryview(ids).cast("i").tolist(),))


def round_trip(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row of docs(doc_id, text)."""

    return _mapped(docs, vocabulary, {"n_tokens": (pa.int64(), "bigint"), "ids_sha256": (pa.string(), "string"), "decoded_sha256": (pa.string(), "string")}, digest)


def _mapped(docs: DataFrame, vocabulary: str | None, columns: dict, make) -> DataFrame:
    modest_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(Path(vocabulary or public_vocabulary()).read_bytes())
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        codec = codec_of(shared.value)
        for b in batches:
            texts = b.column("text")
            for at in range(0, b.num_rows, 500):
                part = b.slice(at, 500)
                rows = [make(codec, ids) for ids in codec.encode_all(texts.slice(at, 500).to_pylist())]
                made = [pa.array(x, t) for x, (t, _) in zip(zip(*rows, strict=True), columns.values(), strict=True)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *made], ["doc_id", *columns])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, " + ", ".join(f"{c} {t}" for c, (_, t) in columns.items()))


def token_counts(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """The rows of docs with n_tokens, ids_sha256 and decoded_sha256 beside all their own columns of other names."""
    modest_batches(docs.sparkSession)
    contents = Path(vocabulary or public_vocabulary()).read_bytes()
    shared = docs.sparkSession.sparkContext.broadcast(contents)
    added = ["n_tokens", "ids_sha256", "decoded_sha256"]
    own = docs.select([docs[f"`{c}`"] for c in docs.columns if c.lower() not in added])

    def run(batches):
        codec = codec_of(shared.value)
        for b in batches:
            for at in range(0, b.num_rows, 500):
                part = b.slice(at, 500)
                n, ids_sha, text_sha = zip(*[digest(codec, ids) for ids in codec.encode_all(part.column("text").to_pylist())], strict=True)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())], [*b.schema.names, *added])

    schema = T.StructType([*own.schema.fields, *(T.StructField(c, T.LongType() if c == "n_tokens" else T.StringType()) for c in added)])
    return own.mapInArrow(run, schema)
