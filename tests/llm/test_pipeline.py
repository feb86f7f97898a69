"""run() against a brute-force version of its five stages."""

import zlib

import public_tokenizers
import sentencepiece

import corpus_pipeline
from textloom.llm import mixing

from . import test_decontaminate, test_mixing, test_near_copies, test_quality, test_token_files
from .common import documents

SF = "/root/testdata/sf0.001"


def by_hand(spark, docs, items):
    """docs: rows of documents; returns (doc_id, start, n_tokens, ids_crc32) of the mix."""
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    docs = [d for d in docs if test_quality.plain(d.text, d.lang, model)[-1]]
    stay = set(test_near_copies.plain_kept([(d.doc_id, d.text) for d in docs]))
    docs = [d for d in docs if d.doc_id in stay]
    docs = [d for d in docs if not test_decontaminate.plain(d.text, items)]
    size = {d.doc_id: len(d.text.encode().split()) for d in docs}
    per = {}
    for d in docs:
        per[d.source] = per.get(d.source, 0) + size[d.doc_id]
    target = test_mixing.by_hand(per)
    u = {r.doc_id: r.u for r in documents(spark, [(d.doc_id, d.text) for d in docs]).select("doc_id", mixing.uniform(mixing.F.col("doc_id"), mixing.F.col("text")).alias("u")).collect()}
    times = {}
    for s, n in per.items():
        copies, p = divmod(target[s] / n, 1)
        left = target[s] - copies * n
        mine = [d for d in docs if d.source == s]
        extra = set()
        if p > 0:
            rank = sorted(mine, key=lambda d: (u[d.doc_id] / (1 - u[d.doc_id]) / (p / (1 - p)), d.doc_id))
            run, k = 0, 0
            while k < len(rank) and run + size[rank[k].doc_id] <= left:
                run += size[rank[k].doc_id]
                extra.add(rank[k].doc_id)
                k += 1
            gap = left - run
            close = [(abs(size[d.doc_id] - gap), j, d.doc_id) for j, d in enumerate(rank[k:]) if abs(size[d.doc_id] - gap) < gap]
            extra |= {min(close)[2]} if close else set()
        times |= {d.doc_id: int(copies) + (d.doc_id in extra) for d in mine}
    rows = [d for d in sorted(docs, key=lambda d: d.doc_id) for _ in range(times[d.doc_id])]
    out, at = [], 0
    for d, raw in zip(rows, test_token_files.plain([d.text for d in rows])):
        out.append((d.doc_id, at, len(raw) // 4, zlib.crc32(raw)))
        at += len(raw) // 4
    return out


def test_run(spark):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    want = by_hand(spark, spark.read.parquet(f"{SF}/documents.parquet").collect(), items)
    got = sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in corpus_pipeline.run(spark, SF).collect())
    assert got == sorted(want) and len(got) > 50


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "simhash", "decontaminate", "mix", "tokens"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        assert out.count() > 0


def test_stages_take_empty_and_null_rows(spark):
    rows = [(None, None, None, None), (1, "", None, None), (2, None, "en", None), (2, None, "en", None)]
    for docs in (documents(spark, []), documents(spark, rows)):
        for name, stage in corpus_pipeline.STAGES:
            n = stage(spark, docs, SF).count()
            assert n <= len(rows), name
