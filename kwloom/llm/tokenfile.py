"""Token ids as length-delimited binary records, with a separate offset index.

A shard is a file of records in ascending doc_id order. A record is

    length (8 bytes) | masked checksum of length (4) | payload | masked checksum of payload (4) | newline

all little-endian. The payload is a byte with the width of an id (2 or 4), a byte that tells whether doc_id is null, the doc_id
(8 bytes) and the ids. A checksum is CRC-32 (zlib's; no CRC-32C is at hand) rotated right by 15 bits plus 0xA282EAD8. Shards
are written by Spark's text writer, which writes a string's bytes as they are and ends each with the newline that the format
has, so any store that Spark writes to will do and a lost task leaves no half file. The index (Parquet) has doc_id, shard,
offset, length, start (ids before the document) and n_tokens; a shuffled reader seeks with it.

Cases: a null text has the end id only; a null doc_id sorts first; repeated rows are written each, ties in doc_id by a hash of their texts;
an empty table writes no record; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import struct
import zlib
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._util import cut, modest_batches, scratch
from .bpe import public_vocabulary
from .pieces import KEPT, PieceTable

END, SHARD_BYTES = 0, 16 << 20
_HEAD, _OWN = struct.Struct("<QI"), struct.Struct("<BBq")


def masked(data: bytes) -> int:
    """The masked checksum of some bytes."""
    c = zlib.crc32(data)
    return ((c >> 15 | c << 17) + 0xA282EAD8) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    """A record without its newline."""
    size = struct.pack("<Q", len(payload))
    return size + struct.pack("<I", masked(size)) + payload + struct.pack("<I", masked(payload))


def records(data: bytes):
    """(offset, length with newline, payload) of each record of a shard; a wrong length or checksum raises ValueError."""
    at = 0
    while at < len(data):
        size, check = _HEAD.unpack_from(data, at)
        if masked(data[at : at + 8]) != check or at + size + 17 > len(data):
            raise ValueError(f"record at {at}: its length is damaged")
        payload = data[at + 12 : at + 12 + size]
        if masked(payload) != int.from_bytes(data[at + 12 + size : at + 16 + size], "little"):
            raise ValueError(f"record at {at}: its payload is damaged")
        yield at, size + 17, payload
        at += size + 17


def pack(doc_id: int | None, ids: bytes) -> bytes:
    """A payload of ids given as little-endian unsigned 32-bit integers; two bytes an id where all fit."""
    wide = np.frombuffer(ids, "<u4")
    narrow = not len(wide) or wide.max() < 1 << 16
    return _OWN.pack(2 if narrow else 4, doc_id is None, doc_id or 0) + (wide.astype("<u2").tobytes() if narrow else ids)


def unpack(payload: bytes) -> tuple[int | None, bytes]:
    """doc_id and ids of a payload."""
    width, null, doc_id = _OWN.unpack_from(payload)
    ids = payload[_OWN.size :]
    return None if null else doc_id, np.frombuffer(ids, "<u2").astype("<u4").tobytes() if width == 2 else ids


class LibraryEncoder:
    """The tokenizers library behind a table of pieces, so that words which prose repeats are encoded once."""

    def __init__(self, contents: bytes, kept: int = KEPT) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(contents.decode())
        self.library.no_truncation()
        self.library.no_padding()
        spec = json.loads(contents)
        before = spec.get("pre_tokenizer") or {}
        self.cuttable = before.get("type") == "ByteLevel" and not before.get("add_prefix_space") and before.get("use_regex", True) and not spec.get("normalizer")
        self.special = [t.content.encode() for t in self.library.get_added_tokens_decoder().values()]
        #: bytes of each id's string: one letter stands for one byte
        vocab = self.library.get_vocab(with_added_tokens=True)
        self.sizes = np.zeros(max(vocab.values()) + 1, np.int64)
        for token, i in vocab.items():
            self.sizes[i] = len(token)
        self.table = PieceTable(self._pieces, kept)

    def _pieces(self, pieces: list[str], sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of pieces, where each one's begin and how many they are. Those that begin with a space and end without white space are
        encoded as one text, which is cut again by the bytes that ids stand for."""
        joins = np.fromiter((p[0] == " " and not p[-1].isspace() for p in pieces), bool, len(pieces))
        inner, begin, counts, made, filled = np.flatnonzero(joins), np.zeros(len(pieces), np.int64), np.zeros(len(pieces), np.int64), [], 0
        for at in range(0, len(inner), 2048):
            some = inner[at : at + 2048]
            ids = np.array(self.library.encode_batch_fast(["".join([pieces[i] for i in some.tolist()])], add_special_tokens=False)[0].ids, np.uint32)
            ends = np.searchsorted(np.cumsum(self.sizes[ids]), np.cumsum(sizes[some])) + 1
            counts[some] = np.diff(ends, prepend=0)
            begin[some] = filled + ends - counts[some]
            filled += len(ids)
            made.append(ids)
        rest = np.flatnonzero(~joins).tolist()
        for i, e in zip(rest, self.library.encode_batch_fast([pieces[i] for i in rest], add_special_tokens=False), strict=True):
            ids = e.ids
            begin[i], counts[i] = filled, len(ids)
            filled += len(ids)
            made.append(np.array(ids, np.uint32))
        return np.concatenate(made), begin, counts

    def __call__(self, texts: list[str | None]) -> list[bytes]:
        raw = [t.encode("utf-8", "replace") if t else b"" for t in texts]
        # texts with a special token, and all under a pre-tokeniser that pieces know nothing of, go to the library whole
        special = {i for i, r in enumerate(raw) if not self.cuttable or any(s in r for s in self.special)}
        out = [i.astype("<u4").tobytes() for i in self.table.encode([b"" if i in special else r for i, r in enumerate(raw)])]
        for i in special:
            out[i] = np.array(self.library.encode(texts[i] or "", add_special_tokens=False).ids, "<u4").tobytes()
        return out


_ENCODERS: dict[str, LibraryEncoder] = {}


def encoder_of(contents: bytes) -> LibraryEncoder:
    """A worker's encoder for a vocabulary, made once."""
    key = hashlib.sha256(contents).hexdigest()
    if key not in _ENCODERS:
        _ENCODERS[key] = LibraryEncoder(contents)
    return _ENCODERS[key]


def write_tokens(docs: DataFrame, path: str, vocabulary: str | None = None, end: int = END, shard_bytes: int = SHARD_BYTES) -> None:
    """Encode docs(doc_id, text) with the tokenizers library and write the shards under path/shards and the index under path/index."""
    spark = docs.sparkSession
    modest_batches(spark)
    contents = spark.sparkContext.broadcast(Path(vocabulary or public_vocabulary()).read_bytes())
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    total = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)), F.count("*")).first()
    shards = (total[0] + 16 * total[1]) // shard_bytes + 1

    def encode(batches):
        encoder = encoder_of(contents.value)
        for b in batches:
            for at in range(0, b.num_rows, 256):
                keys = b.column("doc_id").slice(at, 256).to_pylist()
                ids = encoder(b.column("text").slice(at, 256).to_pylist())
                yield pa.RecordBatch.from_arrays([pa.array([frame(pack(k, i + end.to_bytes(4, "little"))) for k, i in zip(keys, ids, strict=True)], pa.binary())], ["record"])

    # shards are ranges of (doc_id, text, row): neither an id that many rows share nor a text that they share makes one shard
    row = F.monotonically_increasing_id()
    order = [F.col("doc_id").asc_nulls_first(), "hash", "row"]
    placed = docs.withColumns({"hash": F.xxhash64("text"), "row": row}).repartitionByRange(shards, *order).sortWithinPartitions(*order)
    encoded = placed.select("doc_id", "text").mapInArrow(encode, "record binary")
    encoded.select(F.col("record").cast("string").alias("value")).write.option("compression", "none").text(f"{path}/shards")
    _write_index(spark, path)


def _read(spark, path: str, each, schema: str) -> DataFrame:
    """What `each` makes of (shard, contents) of every shard file."""

    def run(batches):
        for b in batches:
            for name, data in zip(b.column("path").to_pylist(), b.column("content"), strict=True):
                shard = int(re.search(r"part-(\d+)", name)[1])
                yield from each(shard, data.as_py())

    shards = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{path}/shards").select("path", "content")
    spark_files = shards.mapInArrow(run, schema)
    return spark_files


def _write_index(spark, path: str) -> None:
    def entries(shard, data):
        keys, offsets, lengths, counts, at = [], [], [], [], []
        before = 0
        for offset, length, payload in records(data):
            doc_id, ids = unpack(payload)
            keys.append(doc_id)
            offsets.append(offset)
            lengths.append(length)
            counts.append(len(ids) // 4)
            at.append(before)
            before += len(ids) // 4
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array([shard] * len(keys), pa.int32()), pa.array(offsets, pa.int64()), pa.array(lengths, pa.int64()), pa.array(at, pa.int64()), pa.array(counts, pa.int64())], ["doc_id", "shard", "offset", "length", "at", "n_tokens"])

    found = cut(_read(spark, path, entries, "doc_id bigint, shard int, offset bigint, length bigint, at bigint, n_tokens bigint"))
    # one task adds up a row a shard
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    first = found.groupBy("shard").agg(F.sum("n_tokens").alias("n")).select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    index = found.join(first, "shard").select("doc_id", "shard", "offset", "length", (F.col("first") + F.col("at")).alias("start"), "n_tokens")
    index.write.parquet(f"{path}/index")


def read_tokens(spark, path: str) -> DataFrame:
    """shard, offset, doc_id, ids (binary, little-endian unsigned 32-bit) of every record of the files, checksums verified."""

    def rows(shard, data):
        part = [(offset, *unpack(payload)) for offset, _, payload in records(data)]
        for at in range(0, len(part), 500):
            offsets, keys, ids = zip(*part[at : at + 500], strict=True)
            yield pa.RecordBatch.from_arrays([pa.array([shard] * len(keys), pa.int32()), pa.array(offsets, pa.int64()), pa.array(keys, pa.int64()), pa.array(ids, pa.binary())], ["shard", "offset", "doc_id", "ids"])

    return _read(spark, path, rows, "shard int, offset bigint, doc_id bigint, ids binary")


def token_file_digest(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every row of docs, as read back from files and index written to the shared folder."""
    spark = docs.sparkSession
    path = scratch(spark, "tokens")
    write_tokens(docs, path, vocabulary)

    def digest(shard, data):
        found = [(offset, zlib.crc32(unpack(payload)[1])) for offset, _, payload in records(data)]
        yield pa.RecordBatch.from_arrays([pa.array([shard] * len(found), pa.int32()), pa.array([x[0] for x in found], pa.int64()), pa.array([x[1] for x in found], pa.int64())], ["shard", "offset", "ids_crc32"])

    read = _read(spark, path, digest, "shard int, offset bigint, ids_crc32 bigint")
    return spark.read.parquet(f"{path}/index").join(read, ["shard", "offset"]).select("doc_id", "start", "n_tokens", "ids_crc32")
