"""Texts beyond the slices that tasks look at, through the registered queries."""

import hashlib

import pytest

from cellspark.llm import registry

ITEM = "an item of the benchmark that is long enough to be found wherever it stands in any text"
WORDS = [f"w{i % 1999}x{i % 13}y{i % 7}" for i in range(230_000)]
LONG = " ".join(WORDS)
ROWS = [(1, LONG), (2, LONG), (3, f"{LONG} tail of its own"), (4, f"{LONG} {ITEM} end"), (5, "vile " + LONG[:100]), (6, "short and kind"), (7, None)]


@pytest.fixture(scope="module")
def folder(spark, make, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("long"))
    assert len(LONG) > 2_200_000
    make(ROWS + [(100 + i, f"some text {i} {'vile' if i % 3 == 0 else 'kind'} ones x{i} y{i}") for i in range(60)]).repartition(2).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(100 + i, int(i % 3 == 0)) for i in range(60)], "doc_id long, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(0, ITEM)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


@pytest.fixture(scope="module")
def got(spark, folder):
    return lambda name: {r.doc_id: r for r in registry.QUERIES[name](spark, folder).collect()}


def test_toxicity(got):
    r = got("op1_toxicity")
    assert r[1].score == r[2].score and r[5].score > r[1].score and 0 <= r[4].score <= 1


def test_jaccard(got):
    r = got("op3_jaccard")
    assert len({r[i].class_id for i in (1, 2, 3, 4)}) == 1 and [r[i].n_links for i in (1, 2, 3, 4)] == [3] * 4 and r[6].n_links == 0


def test_lm(got):
    r = got("op5_lm")
    assert r[1].n_tokens == len(WORDS) + 1 and r[1].score == r[2].score and r[1].base_score == r[2].base_score and r[7].n_tokens == 1


def test_decontamination(got):
    assert set(got("op6_decontamination")) == {4}


def test_media(got):
    r = got("op9_media")
    raw = LONG.encode()
    padded = raw + b"\xff" * (-len(raw) % 576)
    assert r[1].payload_sha256 == r[2].payload_sha256 == hashlib.sha256(padded).hexdigest() and r[1].n_bytes == len(raw)


def test_substrings(got):
    r = got("op10_substrings")
    # 13 words occur again within a text, but only documents before count.
    assert (r[1].n_removed, r[2].n_removed, r[3].n_removed) == (0, len(WORDS), len(WORDS))
    assert r[3].kept_sha256 == hashlib.sha256(b"tail of its own").hexdigest()
