"""The pipeline against plain versions of its stages, each on its own input."""

from collections import Counter

import public_tokenizers
import tiktoken

import corpus_pipeline
from cases import documents, frame
from connlens.llm import bpe, mixing, quality, secrets, simhash

NAMES = ("doc_id", "text", "lang", "source", "n_chars")


def test_stages(spark, data):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "simhash_near_dedup", "secret_scan", "source_mix", "byte_level_bpe"]
    docs = spark.read.parquet(f"{data}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    labels = spark.read.parquet(f"{data}/labels.parquet")
    verdict = {r.doc_id: r.kept for r in quality.judged(docs, labels).collect()}
    first = stages["quality_rules"](spark, docs, data)
    assert first.columns == docs.columns
    assert {r.doc_id for r in first.collect()} == {i for i, kept in verdict.items() if kept}
    second = stages["simhash_near_dedup"](spark, first, data)
    groups = simhash.near_components(first).collect()
    assert sorted(r.doc_id for r in second.collect()) == sorted({r.component_id for r in groups}) and second.columns == docs.columns
    texts = Counter(r.text for r in second.collect())
    assert max(texts.values()) == 1
    third = stages["secret_scan"](spark, second, data)
    assert third.columns == docs.columns and third.count() == second.count()
    left = secrets.scanned(third, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN).collect()
    assert not any(r.spans for r in left)
    fourth = stages["source_mix"](spark, third, data)
    times = {r.doc_id: r.repeats for r in mixing.takes(third).collect()}
    assert Counter(r.doc_id for r in fourth.collect()) == +Counter(times) and fourth.columns == docs.columns
    fifth = stages["byte_level_bpe"](spark, fourth, data)
    v = bpe.read_vocabulary(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    ranks = dict(zip(v.tokens, v.ids.tolist(), strict=True))
    plain = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    text = {r.doc_id: r.text for r in third.collect()}
    rows = fifth.collect()
    assert Counter(r.doc_id for r in rows) == +Counter(times)
    assert all(list(r.token_ids) == plain.encode_ordinary(text[r.doc_id]) and r.n_tokens == len(r.token_ids) for r in rows)
    assert Counter(map(tuple, ((r.doc_id, r.ids_sha256) for r in corpus_pipeline.run(spark, data).collect()))) == Counter(
        (r.doc_id, r.ids_sha256) for r in rows
    )


def test_stages_bear_odd_rows(spark, data):
    docs = frame(spark, documents())
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, data)
        assert out.count() > 0, name
        assert stage(spark, docs.limit(0), data).count() == 0, name
        docs = docs if name == "byte_level_bpe" else out
        assert name == "byte_level_bpe" or out.columns == frame(spark, []).columns
