"""The pipeline: each stage on what its predecessor kept, recomputed from the operators' own tests' rules."""

from __future__ import annotations

import re

import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from corpus_cases import frame
from test_near_dedup import expected
from tidewheel.llm import pii, toxicity


def test_every_stage(spark, sf_dir, documents):
    docs, kept = documents, {}
    for name, stage in corpus_pipeline.STAGES:
        kept[name] = docs = stage(spark, docs, sf_dir).persist()
        if name != "packing":
            assert docs.columns == documents.columns
    rows = {name: {r.doc_id: r for r in df.collect()} for name, df in kept.items() if name != "packing"}
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    toxic = {r.doc_id for r in toxicity.judge(documents, labels).where("toxic").collect()}
    assert {r.doc_id for r in documents.collect()} - set(rows["toxicity"]) == toxic

    before = rows["toxicity"]
    groups = expected(list(before), [r.text for r in before.values()])
    assert set(rows["near_dedup"]) == {i for i, (_, c) in groups.items() if c == i}

    words = lambda t: f" {' '.join(re.findall(r'\w+', t.lower()))} "
    items = [words(r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    clean = {i for i, r in rows["near_dedup"].items() if not any(t in words(r.text) for t in items)}
    assert set(rows["decontamination"]) == clean

    assert set(rows["pii"]) == clean
    for i, r in rows["pii"].items():
        old = rows["decontamination"][i].text
        mail = re.findall(pii.PATTERNS["email"], old)
        assert not any(m in r.text for m in mail) and r.n_chars == len(r.text)

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    sizes = {i: len(tokenizer.encode(r.text, add_special_tokens=False).ids) + 1 for i, r in rows["pii"].items()}
    packed = {}
    for p in kept["packing"].collect():
        packed[p.doc_id] = packed.get(p.doc_id, 0) + p.length
    assert packed == sizes


def test_run_is_its_stages(spark, sf_dir):
    got = corpus_pipeline.run(spark, sf_dir)
    assert got.count() > 0 and "sequence_id" in got.columns


def test_stages_on_odd_rows(spark, odd, none, tmp_path):
    """Nulls, empty and very long texts, repeated rows, clashing names, and no rows at all."""
    extra = ("n_entities", "n_entities_", "digest", "kept", "toxic", "node", "shown", "place")
    clashing = lambda df: df.withColumns({c: F.lit(c) for c in extra})
    spark.createDataFrame([(3, 1, 0), (5, 0, 1), (None, None, None)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, "what is the name of the river that crosses the old town in the north"), (2, None)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    long = frame(spark, [" " * 1_500_000 + "x", "mail me: a@b.org"], [100, 101])
    for docs in (odd.unionByName(long), none):
        docs = clashing(docs)
        columns, ids = docs.columns, {r.doc_id for r in docs.select("doc_id").collect()}
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, str(tmp_path)).persist()
            if name == "packing":
                assert {r.doc_id for r in out.select("doc_id").collect()} == {r.doc_id for r in docs.select("doc_id").collect()}
                break
            assert out.columns == columns
            left = {r.doc_id for r in out.select("doc_id").collect()}
            assert left <= ids and (name != "pii" or left == ids)
            assert out.where("n_entities <> 'n_entities'").isEmpty()
            docs, ids = out, left
