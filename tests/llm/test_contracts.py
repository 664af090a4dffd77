"""The registered queries on whole small tables: columns, types and rows, with clashing columns, nulls, repeats, and without any rows."""

import base64
import collections
import hashlib
import re
import zlib

import corpus_pipeline
import numpy as np
import pytest

from cellspark.llm import registry, toxicity
from cellspark.llm.common import mix

COLUMNS = {
    "op1_toxicity": "doc_id bigint, held_out boolean, score double, predicted int",
    "op2_warc": "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint",
    "op3_jaccard": "doc_id bigint, class_id bigint, n_links bigint",
    "op4_tokens": "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean",
    "op5_lm": "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double",
    "op6_decontamination": "doc_id bigint, item_id bigint",
    "op7_sharding": "doc_id bigint, size bigint, text_crc32 bigint, law string, shard int, slot bigint, grown_shard int",
    "op8_packing": "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint",
    "op9_media": "doc_id bigint, n_bytes bigint, payload_bytes bigint, payload_sha256 string, tail_crc32 bigint, media_bytes bigint, media_sha256 string, feature string",
    "op10_substrings": "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string",
    "op11_runs": "doc_id bigint, n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, runs_sha256 string, collapsed_sha256 string",
    "op12_alignment": "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string",
    "op13_pii": "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string",
}
ITEM = "an item of the benchmark that is long enough to be found wherever it stands in any text"
PAGES = [(1, "http://a", "same"), (2, None, "same"), (3, "u", None), (4, "u", ""), (5, "http://c", "<p>é</p>"), (2, None, "same")]


@pytest.fixture(scope="module")
def folder(spark, make, nasty, tmp_path_factory):
    """Writes the tables that the queries read; with rows or without."""

    def build(rows: bool) -> str:
        path = str(tmp_path_factory.mktemp("tables"))
        docs = nasty + [(20 + i, f"text {i} with some words of its own and {'vile' if i % 6 == 0 else 'kind'} ones x{i} y{i} z{i}") for i in range(60)] + [(90, f"before {ITEM} after")] if rows else []
        labels = [(i, int(i % 6 == 2)) for i in range(20, 80)] + [(None, 1), (21, None), (999, 1)] if rows else []
        items = [(0, ITEM, "x"), (1, None, "y"), (None, "   ", None), (None, None, None)] if rows else []
        pages = PAGES if rows else []
        make(docs).repartition(3).write.parquet(f"{path}/documents.parquet")
        spark.createDataFrame([(i, y, "en", 0.5) for i, y in labels], "doc_id long, toxic int, y string, score double").write.parquet(f"{path}/labels.parquet")
        spark.createDataFrame([(*r, "d", 1, 2, 3) for r in items], "item_id long, text string, doc_id string, source string, distance int, at int, n int").write.parquet(f"{path}/benchmark.parquet")
        spark.createDataFrame([(*r, "s", 1, 2, "f", 3, 4, 5) for r in pages], "page_id long, url string, html string, sha string, n int, refers_to int, file string, length int, last int, salt int").write.parquet(f"{path}/pages.parquet")
        return path

    return build


@pytest.fixture(scope="module")
def full(folder):
    return folder(True)


@pytest.fixture(scope="module")
def empty(folder):
    return folder(False)


@pytest.mark.parametrize("name", COLUMNS)
def test_columns_and_rows(spark, full, name):
    got = registry.QUERIES[name](spark, full)
    kinds = dict(got.dtypes)
    for c in COLUMNS[name].split(", "):
        column, kind = c.split(" ")
        assert kinds[column] == kind, c
    rows = got.collect()
    docs = spark.read.parquet(f"{full}/documents.parquet").select("doc_id", "text").collect()
    ids = collections.Counter(r.doc_id for r in docs)
    if name == "op2_warc":
        digest = lambda s: base64.b32encode(hashlib.sha1((s or "").encode()).digest()).decode()
        first: dict = {}
        for i, _, html in PAGES:
            first[html or ""] = min(i, first.get(html or "", i))
        want = [(i, len((h or "").encode()), digest(h), "revisit" if i > first[h or ""] else "response", first[h or ""] if i > first[h or ""] else None) for i, _, h in PAGES]
        assert collections.Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows) == collections.Counter(want)
    elif name == "op6_decontamination":
        assert {(r.doc_id, r.item_id) for r in rows} == {(90, 0)}
    elif name == "op8_packing":
        assert collections.Counter(r.doc_id for r in rows if r.piece == 0) == ids
        by = collections.defaultdict(list)
        for r in rows:
            by[r.sequence_id].append((r.offset, r.length))
        for places in by.values():
            assert sum(n for _, n in places) <= 1024 and all(at == sum(n for b, n in places if b < at) for at, _ in places)
    elif name == "op3_jaccard":
        assert collections.Counter(r.doc_id for r in rows) == collections.Counter({k: v for k, v in ids.items() if k is not None})
    else:
        assert collections.Counter(r.doc_id for r in rows) == ids
    if name == "op7_sharding":
        assert {r.law for r in rows} == {"bytes"} and {r.grown_shard for r in rows} == {None}
        assert collections.Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == collections.Counter((r.doc_id, len((r.text or "").encode()) + 8, zlib.crc32((r.text or "").encode())) for r in docs)
        for k in {r.shard for r in rows}:
            assert 0 <= k <= 23 and sorted(r.slot for r in rows if r.shard == k) == list(range(sum(r.shard == k for r in rows)))


@pytest.mark.parametrize("name", COLUMNS)
def test_without_rows(spark, empty, name):
    got = registry.QUERIES[name](spark, empty)
    assert set(c.split(" ")[0] for c in COLUMNS[name].split(", ")) <= set(got.columns) and got.count() == 0


def test_pipeline_stages_on_odd_rows_and_without_any(spark, full, empty):
    for path in (full, empty):
        docs = spark.read.parquet(f"{path}/documents.parquet")
        rows = docs.count()
        for k, (name, f) in enumerate(corpus_pipeline.STAGES):
            before = docs
            docs = spark.createDataFrame(f(spark, before, path).collect(), f(spark, before, path).schema)
            if k < len(corpus_pipeline.STAGES) - 1:
                assert docs.columns == before.columns, name
                assert docs.count() <= before.count()
                assert (docs.filter("doc_id is null").count() == 1) == bool(rows), name  # clean, and nobody's copy: no order tells
        assert (docs.count() > 0) == bool(rows)
        assert corpus_pipeline.run(spark, path).count() == docs.count()


def test_scores_equal_a_plain_evaluation_of_the_model(spark, full):
    docs, labels = spark.read.parquet(f"{full}/documents.parquet"), spark.read.parquet(f"{full}/labels.parquet")
    model = toxicity.train(docs.filter(~toxicity.held_out(docs.doc_id)), labels)
    assert len(model.hashes) > len({t for g in toxicity.IDENTITY_TERMS for t in g})
    weight = dict(zip(model.hashes.tolist(), model.weights.tolist(), strict=True))
    terms = {t for g in toxicity.IDENTITY_TERMS for t in g}

    def score(text):
        z, seen = model.bias, set()
        for w in re.sub(r"[\x00-\x7f]", lambda c: c.group().lower() if c.group().isalnum() else " ", text or "").split(" "):
            raw = w.encode()
            if raw:
                seen.add(toxicity.term_hash(w))
                if len(raw) > toxicity.PREFIX and w not in terms:
                    seen.add(int(mix(hash_of(raw[: toxicity.PREFIX]) ^ np.uint64(0x5BD1E995))[0]))
        z += sum(weight.get(h, 0.0) for h in seen)
        return 1 / (1 + 2.718281828459045 ** -max(-60, min(60, z)))

    got = registry.QUERIES["op1_toxicity"](spark, full).collect()
    want = {(r.doc_id, r.text): score(r.text) for r in docs.collect()}
    assert sorted(round(r.score, 9) for r in got) == pytest.approx(sorted(round(x, 9) for (i, t), x in want.items() for _ in range(sum((d.doc_id, d.text) == (i, t) for d in docs.collect()))), abs=1e-8)
    assert all(r.predicted == int(r.score >= 0.3) and 0 <= r.score <= 1 for r in got)


def hash_of(raw: bytes):
    from cellspark.llm.common import Words

    data = np.frombuffer(raw, np.uint8)
    return Words(data, np.array([0, len(data)])).hashes()
