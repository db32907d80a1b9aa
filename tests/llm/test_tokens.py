import hashlib
import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from kwloom.llm import bpe, tokenfile

from .fixtures import docs, documents, none

LIBRARY = Tokenizer.from_file(bpe.public_vocabulary())


def ids_of(text):
    return np.array(LIBRARY.encode(text or "", add_special_tokens=False).ids, "<u4")


def test_encoding_is_the_librarys(spark):
    codec = bpe.codec_of(open(bpe.public_vocabulary(), "rb").read())
    pool = [chr(c) for c in [*range(0x250), 0x2028, 0x3000, 0xFEFF, 0x1F600, 0x661, 0x4E2D, 0x300]] + ["<|endoftext|>", "'ll", " ", "  ", "\n"] * 9
    r = random.Random(1)
    library = tokenfile.LibraryEncoder(open(bpe.public_vocabulary(), "rb").read(), kept=500)
    for _ in range(800):
        text = "".join(r.choice(pool) for _ in range(r.randint(0, 40)))
        ids = codec.encode(text)
        assert ids == ids_of(text).tobytes() == library([text])[0], text
        assert codec.decode(ids) == LIBRARY.decode(ids_of(text).tolist(), skip_special_tokens=False)


def test_round_trip(spark):
    got = sorted(tuple(r) for r in bpe.round_trip(docs(spark)).collect())
    want = sorted((r[0], len(ids_of(r[1])), hashlib.sha256(ids_of(r[1]).tobytes()).hexdigest(), hashlib.sha256((r[1] or "").encode()).hexdigest()) for r in documents())
    assert got == want
    assert bpe.round_trip(none(spark)).count() == 0
    assert {c for c in bpe.token_counts(docs(spark)).columns} == {*docs(spark).columns, "n_tokens", "ids_sha256", "decoded_sha256"}
    clash = docs(spark).withColumnRenamed("score", "N_TOKENS")
    assert bpe.token_counts(clash).select("n_tokens").count() == len(documents())
    assert [r.ids for r in bpe.encode(docs(spark).filter("doc_id = 0")).collect()] == [ids_of(documents()[0][1]).tolist()]


@pytest.mark.parametrize("shard_bytes", [16 << 20, 2000])
def test_token_files(spark, tmp_path, shard_bytes):
    path = f"file://{tmp_path}/t"
    tokenfile.write_tokens(docs(spark), path, shard_bytes=shard_bytes)
    rows = sorted((r[0], ids_of(r[1]).tobytes() + bytes(4)) for r in documents())
    read = tokenfile.read_tokens(spark, path).orderBy("shard", "offset").collect()
    assert [(r.doc_id, bytes(r.ids)) for r in read] == rows
    before, want = 0, []
    for i, ids in rows:
        want.append((i, before, len(ids) // 4))
        before += len(ids) // 4
    index = spark.read.parquet(f"{path}/index")
    assert sorted((r.doc_id, r.start, r.n_tokens) for r in index.collect()) == want
    one = index.filter("doc_id = 5").first()
    name = next((tmp_path / "t/shards").glob(f"part-{one.shard:05d}-*"))
    with open(name, "rb") as f:  # a shuffled read
        f.seek(one.offset)
        assert tokenfile.unpack(next(tokenfile.records(f.read(one.length)))[2]) == (5, ids_of(documents()[5][1]).tobytes() + bytes(4))


def test_digest(spark):
    got = sorted((r.doc_id, r.n_tokens, r.ids_crc32) for r in tokenfile.token_file_digest(docs(spark)).collect())
    assert got == sorted((r[0], len(ids_of(r[1])) + 1, zlib.crc32(ids_of(r[1]).tobytes() + bytes(4))) for r in documents())
    assert tokenfile.token_file_digest(none(spark)).count() == 0


def test_rows_of_one_id_fill_several_shards(spark, tmp_path):
    rows = [(7, "the same text again")] * 300 + [(None, f"no id {i}") for i in range(300)] + [(7, f"text {i}") for i in range(300)]
    path = f"file://{tmp_path}/t"
    tokenfile.write_tokens(spark.createDataFrame(rows, "doc_id bigint, text string"), path, shard_bytes=3000)
    read = tokenfile.read_tokens(spark, path).orderBy("shard", "offset").collect()
    assert [r.doc_id for r in read] == [None] * 300 + [7] * 600 and len({r.shard for r in read}) > 6
    assert sorted(bytes(r.ids) for r in read) == sorted(ids_of(t).tobytes() + bytes(4) for _, t in rows)
    index = spark.read.parquet(f"{path}/index").orderBy("shard", "offset").collect()
    assert [r.start for r in index] == np.cumsum([0, *(r.n_tokens for r in index)])[:-1].tolist()


def test_encoders_go_by_the_vocabularys_contents():
    contents = open(bpe.public_vocabulary(), "rb").read()
    other = contents.replace(b'"add_prefix_space":false', b'"add_prefix_space":true ', 1) if b'"add_prefix_space":false' in contents else contents.replace(b'"add_prefix_space": false', b'"add_prefix_space": true ', 1)
    assert len(other) == len(contents) and other != contents
    a, b = tokenfile.encoder_of(contents), tokenfile.encoder_of(other)
    assert a is not b and b(["a word"])[0] == np.array(Tokenizer.from_str(other.decode()).encode("a word", add_special_tokens=False).ids, "<u4").tobytes() != a(["a word"])[0]


def test_damage_is_found():
    data = bytearray(tokenfile.frame(tokenfile.pack(1, bytes(8))) + b"\n")
    assert [x[0] for x in tokenfile.records(bytes(data))] == [0]
    data[20] ^= 1
    with pytest.raises(ValueError, match="payload"):
        list(tokenfile.records(bytes(data)))
    wide = np.array([1, 70000], "<u4").tobytes()
    assert tokenfile.unpack(tokenfile.pack(None, wide)) == (None, wide)
