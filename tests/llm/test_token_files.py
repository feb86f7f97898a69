import io
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import zstandard
from tokenizers import Tokenizer

from textloom.llm import token_files as tf
from textloom.llm._util import Scratch, file_system, make_dir

from .common import clashing, documents

PATH = public_tokenizers.path("byte_bpe_50k.json")
V = tf.Vocabulary(PATH)


def plain(texts, path=PATH):
    t = Tokenizer.from_file(path)
    return [np.array([*x.ids, 2], dtype="<u4").tobytes() for x in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


HARD = ["a b", " a", "a ", "  a", "a  b", "a\n b", "a \nb", "a\n\nb", "\n", " ", "a\tb c", "don't  stop", "it's a b", "a　b", "x\x1cy z", "1 2  3", "é ü\r\nz", "😀 😀", "<|endoftext|> a", "a <|endoftext|>", "漢字 かな", "a​b", "ǅ ſ", "\x00 \x01", "a .b", "a 'b", "'s 's", "  \n  ", "a\x85b c"]


@pytest.mark.parametrize("limit", [400_000, 50])
def test_pieces_give_the_librarys_ids(limit):
    rng = random.Random(11)
    texts = HARD + ["".join(rng.choices(HARD + list(" \n\tabé'1.,!漢"), k=rng.randint(1, 40))) for _ in range(3000)]
    enc = tf.Encoder(tf.Vocabulary(PATH, cache_pieces=limit))
    assert [x for k in range(0, len(texts), 100) for x in enc.encode(texts[k : k + 100])] == plain(texts)


def want_rows(docs):
    out, at = [], 0
    for (d, _), raw in zip(docs, plain([t for _, t in docs])):
        out.append((d, at, len(raw) // 4, zlib.crc32(raw)))
        at += len(raw) // 4
    return out


def test_whole_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r.doc_id, r.text) for r in df.orderBy("doc_id").collect()]
    got = sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in tf.token_table(df, V).collect())
    assert got == want_rows(rows)


def test_edges(spark):
    rows = [(4, "b"), (2, None), (2, ""), (9, "x " * 200_000), (-3, "neg"), (7, "same"), (7, "same")]
    df = clashing(documents(spark, rows), "id", "t", "part", "start", "n_tokens").repartition(3)
    got = sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in tf.token_table(df, V).collect())
    assert got == sorted(want_rows(sorted(((d, t or "") for d, t in rows))))
    out = tf.token_table(documents(spark, [(None, "a"), (1, "b")]), V).collect()
    assert sorted(((r.doc_id, r.start) for r in out), key=repr) == [(1, 2), (None, 0)]
    assert tf.token_table(documents(spark, []), V).collect() == []


def test_files_are_seekable_zstandard(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    folder = make_dir(spark, "tokentest")
    manifest = tf.write_tokens(df, V, folder, Scratch(spark, "tokentest")).orderBy("part").collect()
    texts = {r.doc_id: r.text for r in df.collect()}
    fs, _ = file_system(folder)
    seen = []
    for m in manifest:
        with fs.open_input_file(m.path) as f:
            data = f.read()
        r = tf.FrameReader(io.BytesIO(data))
        ids = r.ids()
        k = len(ids) // 2
        assert r.read(k) == plain([texts[ids[k]]])[0]
        whole = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data), read_across_frames=True).read()
        assert whole == b"".join(r.read(j) for j in range(len(r))) and len(whole) // 4 == m.n_ids
        seen += ids
    assert seen == sorted(texts)


def test_only_wanted_documents_are_read(spark):
    docs = [(i, f"text {i} " * (i % 5)) for i in range(300)] + [(77, "again"), (None, "no id")]
    folder = make_dir(spark, "tokentest")
    manifest = tf.write_tokens(documents(spark, docs).repartition(3), V, folder, Scratch(spark, "tokentest"))
    wanted = spark.createDataFrame([(5,), (5,), (77,), (299,), (0,), (1000,), (None,)], "doc_id long")
    got = sorted((r.doc_id, tuple(r.ids)) for r in tf.fetch(manifest, folder, wanted).collect())
    want = [(d, t) for d, t in docs if d in (0, 5, 77, 299)]
    assert got == sorted((d, tuple(np.frombuffer(raw, dtype="<u4").tolist())) for (d, _), raw in zip(want, plain([t for _, t in want])))
    assert tf.fetch(manifest, folder, wanted.limit(0)).collect() == []


def test_damage_is_noticed():
    out = io.BytesIO()
    w = tf.FrameWriter(out)
    for d in range(5):
        w.add(d, np.arange(50 + d, dtype="<u4").tobytes())
    w.close()
    data = bytearray(out.getvalue())
    r = tf.FrameReader(io.BytesIO(bytes(data)))
    assert r.ids() == [0, 1, 2, 3, 4] and r.read(3) == np.arange(53, dtype="<u4").tobytes()
    data[int(r.at[3]) + 20] ^= 0xFF
    bad = tf.FrameReader(io.BytesIO(bytes(data)))
    assert bad.read(1) == np.arange(51, dtype="<u4").tobytes()
    with pytest.raises(Exception):
        bad.read(3)


def test_large_ids_are_exact(spark):
    """Odd ids above 2^53 are no floats; nulls in a batch must not make them such."""
    big = (1 << 53) + 1
    rows = [(big, "one"), (big + 2, "two"), (None, "three")]
    held = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 1)  # all in one batch
    try:
        out = tf.token_table(documents(spark, rows), tf.Vocabulary(public_tokenizers.path("byte_bpe_50k.json"))).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", held)
    assert sorted((r.doc_id for r in out), key=str) == sorted([big, big + 2, None], key=str)


def test_special_tokens_are_a_choice():
    text = "a <|endoftext|> b<|endoftext|>"
    assert 50256 in np.frombuffer(tf.Encoder(V).encode([text])[0], dtype="<u4")
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    ids = np.frombuffer(tf.Encoder(tf.Vocabulary(PATH, special_as_text=True)).encode([text])[0], dtype="<u4").tolist()
    assert ids == [*t.encode(text, add_special_tokens=False).ids, 2] and 50256 not in ids


def test_other_vocabularies_get_whole_texts():
    path = public_tokenizers.path("word_bpe_49k.json")
    enc = tf.Encoder(tf.Vocabulary(path))
    assert not enc.by_pieces and tf.Encoder(V).by_pieces
    assert enc.encode(HARD) == plain(HARD, path)
