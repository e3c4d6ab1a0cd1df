"""The stages of the pipeline, each on its own input, and the whole."""

import collections
import re

import __spark_entry__ as E
import corpus_pipeline
from claimlake.llm import secret_scan
from claimlake.llm.common import staged
from tests.llm import frames
from tests.llm.test_corpus_operators import brute_fingerprint
from tests.llm.test_text_operators import brute_secrets

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, steps = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        steps.append(docs.collect())
        docs = staged(stage(spark, docs, SF), name)
        if name != "packing":
            assert docs.columns == columns, name
    start, good, lines, single, clean = steps
    assert {r["doc_id"] for r in start if len(frames.words(r["text"])) < 20}.isdisjoint(r["doc_id"] for r in good)
    # no two lines that are left are equal, and every document keeps its other lines
    seen = [line for r in lines for _, line in frames.lines(r["text"])]
    assert len(seen) == len(set(seen))
    # one document of each component, the smallest id
    prints = {r["doc_id"]: brute_fingerprint(r["text"]) for r in lines}
    label = {i: i for i in prints}
    for _ in range(3):
        for a in prints:
            for b in prints:
                if (prints[a] ^ prints[b]).bit_count() <= 3:
                    label[a] = label[b] = min(label[a], label[b])
    assert {r["doc_id"] for r in single} == set(label.values())
    # secrets that few hold are gone from the texts; the others are as they were
    before = {r["doc_id"]: r["text"] for r in single}
    assert {r["doc_id"] for r in clean} == set(before)
    for r in clean:
        assert r["n_chars"] == len(r["text"])
        assert r["text"] == before[r["doc_id"]] or brute_secrets(before[r["doc_id"]])
    assert {r["doc_id"] for r in docs.select("doc_id").collect()} == {r["doc_id"] for r in clean}


def test_no_owner_specific_value_is_left(spark):
    """Every value that few sources hold is gone from the stage's output, but for runs of few characters."""
    stage = dict(corpus_pipeline.STAGES)["secret_scan"]
    held = [(10**6 + i, f"see password: {v} here", "en", f"src{i % 3}", 9) for i, v in enumerate(
        ["hunter22", "20241001", "4f4f91aa", "aB3aB3xx", "0a1b2c3d4e5f", "hunter22", "hunter22"])]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    docs = docs.union(spark.createDataFrame(held, frames.SCHEMA).select(*docs.columns))
    kinds = secret_scan.BASE_KINDS + secret_scan.MORE_KINDS
    values = lambda text: {
        v for kind, pattern, match_length, value_length in kinds for m in re.finditer(pattern, text or "")
        if len(m[0]) >= match_length and len(v := m[1] if kind == "assign" else m[0]) >= value_length}
    owners = collections.defaultdict(set)
    for r in docs.collect():
        for v in values(r["text"]):
            owners[v].add(r["source"])
    few = {v for v, held in owners.items() if len(held) <= secret_scan.MOST_OWNERS and len(set(v)) > 7}
    few |= {v for v, held in owners.items() if len(held) <= secret_scan.MOST_OWNERS and len(v) < 16 and len(set(v)) > 2}
    assert len(few) >= 5
    for r in stage(spark, docs, SF).collect():
        assert few.isdisjoint(values(r["text"]))


def test_registered():
    names = set(E.queries())
    assert {"pipeline"} <= names
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))
    assert set(E.oracle_sql()) <= names
    assert corpus_pipeline.ORACLE_SQL is None


def test_hard_documents(spark):
    docs = frames.frame(spark)
    for name, stage in corpus_pipeline.STAGES:
        docs = staged(stage(spark, docs, SF), name)
    assert docs.count() > 0
    empty = frames.frame(spark, [])
    for name, stage in corpus_pipeline.STAGES:
        empty = staged(stage(spark, empty, SF), name)
    assert empty.count() == 0
