"""The stages one after the other, each against what it must do to its own input."""

import numpy as np

import corpus_pipeline
from commerce_lens.llm import bpe_tree, decontaminate, quality
from tests.conftest import SMALL
from tests.llm.edge import SCHEMA, documents
from tests.llm.test_exact_dedup import norm
from tests.llm.test_simhash import closure, print_of, signed


def test_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        before = {r["doc_id"]: r["text"] for r in docs.collect()}
        out = corpus_pipeline.cut_lineage(stage(spark, docs, SMALL), name)
        kept[name] = (before, [r["doc_id"] for r in out.collect()])
        if name != "bpe_tokens":
            assert out.columns == columns
            docs = out
    before, after = kept["quality_classifier"]
    model = quality.fit(spark.read.parquet(f"{SMALL}/documents.parquet"), spark.read.parquet(f"{SMALL}/labels.parquet").where("crc32(cast(cast(doc_id AS string) AS binary)) % 3 <> 1"))
    assert sorted(after) == sorted(i for i, t in before.items() if model.score(t) >= 0.5)
    before, after = kept["exact_dedup"]
    first = {}
    for i in sorted(before):
        first.setdefault(norm(before[i]), i)
    assert sorted(after) == sorted(first.values())
    before, after = kept["simhash_near_dedup"]
    prints = {i: signed(print_of(t)) for i, t in before.items()}
    ids = sorted(prints)
    near = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :] if ((prints[a] ^ prints[b]) & (2**64 - 1)).bit_count() <= 2]
    assert sorted(after) == sorted(set(closure(ids, near).values()))
    before, after = kept["benchmark_decontamination"]
    items = [" ".join(decontaminate.words(r["text"])) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    assert sorted(after) == sorted(i for i, t in before.items() if not any(q in " ".join(decontaminate.words(t)) for q in items))
    before, _ = kept["bpe_tokens"]
    codec = bpe_tree.codec("byte_bpe_50k.tiktoken")
    rows = out.collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(before) and all(r["intact"] for r in rows)
    for r in rows:
        assert np.frombuffer(r["ids"], "<u4").tolist() == codec._leaf.encode_ordinary(before[r["doc_id"]])
    assert sorted(r["doc_id"] for r in corpus_pipeline.run(spark, SMALL).collect()) == sorted(before)


def test_every_stage_takes_edges_and_empty_tables(spark, tmp_path):
    documents(spark).write.parquet(str(tmp_path / "d"))
    for docs in (spark.read.parquet(str(tmp_path / "d")), spark.createDataFrame([], SCHEMA)):
        for _, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SMALL)
            assert out.count() <= docs.count()
