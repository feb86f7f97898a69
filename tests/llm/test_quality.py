import math
import random
import re
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece

from textloom.llm import quality

from .common import clashing, documents

RULES = quality.Rules(public_tokenizers.path("piece_bpe_32k.model"))
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text, lang, model):
    ws = WORD.findall(text or "")
    windows = Counter(tuple(ws[i : i + 3]) for i in range(len(ws) - 2))
    inside = {i + k for i in range(len(ws) - 2) if windows[tuple(ws[i : i + 3])] > 1 for k in range(3)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        dup += bool(WORD.search(line)) and line in seen
        seen.add(line)
    failed = len(ws) < 50 or 100 * len(inside) > 50 * len(ws)
    kept = False
    if ws and not failed:
        ids = [i for w in ws for i in model.encode(w)]
        n, counts = len(ids), Counter(ids)
        per, share = sum(map(len, ws)) / n, sum(model.is_byte(i) for i in ids) / n
        h = -sum(c / n * math.log2(c / n) for c in counts.values())
        b = RULES.bands.get(lang) or RULES.bands.get(quality.main_script(text), RULES.bands["OTHER"])
        kept = b.min_chars <= per <= b.max_chars and share <= b.max_bytes and h >= b.min_bits + b.per_doubling * (math.log2(min(max(n, 64), 4096)) - 7)
    return len(ws), sum(map(len, ws)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(inside), failed, kept


@pytest.fixture(scope="module")
def model():
    return sentencepiece.SentencePieceProcessor(model_file=RULES.vocabulary)


def test_whole_table(spark, model):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed, r.kept) for r in quality.quality_table(df, RULES).collect()}
    assert got == {r.doc_id: plain(r.text, r.lang, model) for r in df.collect()}


def test_clean_text_is_kept_and_junk_is_not(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").join(spark.read.parquet("/root/testdata/sf0.1/labels.parquet"), "doc_id")
    good = quality.quality_table(df.where("quality = 1"), RULES).where("not base_failed").groupBy("kept").count().collect()
    n = {r.kept: r["count"] for r in good}
    assert n.get(False, 0) == 0
    bad = quality.quality_table(df.where("quality = 0"), RULES).where("not base_failed").groupBy("kept").count().collect()
    bad = {r.kept: r["count"] for r in bad}
    assert bad[False] > 0.3 * bad[True]
    rng = random.Random(1)
    clean = [r.text for r in df.where("quality = 1").orderBy("doc_id").limit(20).collect()]
    junk = ["".join(rng.choices("0123456789abcdef", k=4000)), " ".join("%08x" % rng.getrandbits(32) for _ in range(400)), " ".join("".join(map(chr, rng.choices(range(0x10000, 0x10100), k=6))) for _ in range(200)), " ".join(rng.choice("qzxjkv") * 3 + "!?;" for _ in range(300)), " ".join(rng.choices(["a", "b"], k=50) + [f"{i}" for i in range(3)])]
    out = {r.doc_id: r.kept for r in quality.quality_table(documents(spark, list(enumerate(junk))), RULES).collect()}
    assert not any(out.values()), out
    assert clean


def test_most_labelled_junk_and_random_letters_are_rejected(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").join(spark.read.parquet("/root/testdata/sf0.1/labels.parquet").where("quality = 0"), "doc_id")
    bad = [r.kept for r in quality.quality_table(df, RULES).where("not base_failed").collect()]
    assert sum(bad) < 0.12 * len(bad) and len(bad) > 200
    rng = random.Random(2)
    texts = [" ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(2, 9))) for _ in range(n)) for n in (300, 600, 2000)]
    rows = [(k, t, lang, "s") for k, t in enumerate(texts) for lang in ("en", "de", "fr", "es")]
    assert not any(r.kept for r in quality.quality_table(documents(spark, rows), RULES).collect())


def test_repeat_words_by_hand():
    rng = random.Random(4)
    import numpy as np

    for top in (3, 40, 1 << 22):
        for _ in range(200):
            seq = [rng.randrange(min(top, 6)) * (top // min(top, 6)) for _ in range(rng.randint(0, 30))]
            w = Counter(tuple(seq[i : i + 3]) for i in range(len(seq) - 2))
            want = len({i + k for i in range(len(seq) - 2) if w[tuple(seq[i : i + 3])] > 1 for k in range(3)})
            assert quality.repeat_words(np.array(seq, dtype=np.int64)) == want


def test_small_cache_gives_the_same(spark, model):
    texts = [(i, " ".join(f"wort{(i * j) % 97}" for j in range(120)), "de", "s") for i in range(50)]
    small = quality.Rules(RULES.vocabulary, cache_words=10)
    rows = [tuple(r) for r in quality.quality_table(documents(spark, texts), small).orderBy("doc_id").collect()]
    assert rows == [tuple(r) for r in quality.quality_table(documents(spark, texts), RULES).orderBy("doc_id").collect()]


def test_edges(spark, model):
    rows = [(1, None, None, None), (2, "", "xx", ""), (None, "a\n\na\n \na", None, None), (3, "\x1c x　y", "en", "s"), (3, "\x1c x　y", "en", "s"), (4, "ab cd ef gh " * 30_000, "en", "s"), (5, "слово " + " ".join(f"речь{i}" for i in range(80)), None, "s")]
    df = clashing(documents(spark, rows), "id", "t", "g", "n_words", "kept", "band")
    out = sorted(((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed, r.kept) for r in quality.quality_table(df, RULES).collect()), key=repr)
    assert out == sorted(((i, *plain(t, g, model)) for i, t, g, _ in rows), key=repr)
    assert quality.quality_table(documents(spark, []), RULES).collect() == []
