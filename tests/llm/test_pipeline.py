import importlib.util
import zlib

import corpus_pipeline
from cellspark.llm import decontamination, encoding, jaccard, registry, substrings, toxicity
from cellspark.llm.common import read


def test_stages_keep_their_contract(spark, small):
    docs = read(spark, small, "documents")
    names = docs.columns
    before = docs
    for k, (name, f) in enumerate(corpus_pipeline.STAGES):
        out = spark.createDataFrame(f(spark, before, small).collect())
        if k < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == names, name
            assert {r.doc_id for r in out.collect()} <= {r.doc_id for r in before.collect()}
        if name == "toxicity":
            model = toxicity.train(before.filter(~toxicity.held_out(before.doc_id)), read(spark, small, "labels"))
            assert {r.doc_id for r in out.collect()} == {r.doc_id for r in toxicity.score(before, model).collect() if r.score < 0.3}
        elif name == "near duplicates":
            assert {r.doc_id for r in out.collect()} == {r.class_id for r in jaccard.jaccard_join(before).collect()}
        elif name == "substring dedup":
            assert {r.doc_id: r.text for r in out.collect()} == {r.doc_id: r.text for r in substrings.dedup_substrings(before).collect()}
            assert all(r.n_chars == len(r.text) for r in out.collect())
        elif name == "decontamination":
            bad = {r.doc_id for r in decontamination.find_items(before, read(spark, small, "benchmark")).collect()}
            assert bad and {r.doc_id for r in out.collect()} == {r.doc_id for r in before.collect()} - bad
        else:
            from tokenizers import Tokenizer

            tok = Tokenizer.from_file(encoding.tokenizer_path("byte_bpe_50k.json"))
            sizes = {r.doc_id: len(tok.encode(r.text, add_special_tokens=False).ids) + 1 for r in before.collect()}
            got: dict = {}
            for r in out.collect():
                got[r.doc_id] = got.get(r.doc_id, 0) + r.length
            assert got == sizes
        before = out


def test_run_and_registration(spark, small):
    assert 4 <= len(corpus_pipeline.STAGES) <= 5
    assert corpus_pipeline.run(spark, small).count() > 0
    found = {int(k[2:].split("_")[0]) for k in registry.QUERIES}
    assert found == set(range(1, 11)) and importlib.util.find_spec("__spark_entry__")


def test_folds(spark, small):
    q = registry.QUERIES["op1_toxicity"](spark, small).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in q)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in q)
