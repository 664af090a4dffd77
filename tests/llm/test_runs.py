"""Periodic runs of words against a search of all periods."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from cellspark.llm import runs
from cellspark.llm.common import mix

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(w, least=24, times=3):
    """All periods, one after the other; a stretch with a smaller period is none of this one's."""
    out = []
    for q in range(1, len(w) // times + 1):
        i = 0
        while i < len(w) - q:
            if w[i] != w[i + q]:
                i += 1
                continue
            s = i
            while i < len(w) - q and w[i] == w[i + q]:
                i += 1
            run = w[s : i + q]
            if len(run) >= max(least, times * q) and not any(run[r:] == run[:-r] for r in range(1, q)):
                out.append((s, len(run), q))
    return sorted(out)


def collapsed(w, found):
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def sample(r):
    d = []
    while len(d) < r.randint(0, 150):
        if r.random() < 0.5:
            d += ([r.randint(0, r.choice([1, 2, 9])) for _ in range(r.randint(1, 24))] * r.randint(2, 9))[: r.randint(1, 200)]
        else:
            d += [r.randint(0, 2) for _ in range(r.randint(1, 9))]
    return d


@pytest.mark.parametrize("few", [0, 24, 10**9])
def test_runs_equal_a_search_of_all_periods(monkeypatch, few):
    monkeypatch.setattr(runs, "FEW", few)
    r = random.Random(few + 1)
    for _ in range(150):
        docs, least = [sample(r) for _ in range(r.randint(1, 5))], r.choice([1, 3, 8, 24])
        bounds = np.concatenate([[0], np.cumsum([len(d) for d in docs])])
        s, n, p = runs.runs(mix(np.array([x for d in docs for x in d], np.uint64)), bounds, least)
        of = np.searchsorted(bounds, s, side="right") - 1
        for k, d in enumerate(docs):
            assert [(int(a - bounds[k]), int(b), int(c)) for a, b, c, row in zip(s, n, p, of) if row == k] == plain(d, least)


def test_long_texts_of_one_word_two_words_and_one_long_period():
    for n, q in ((60_000, 1), (60_000, 2), (60_000, 19_997), (60_000, 20_000)):
        got = runs.runs(mix(np.arange(n, dtype=np.uint64) % np.uint64(q)), np.array([0, n]))
        assert [tuple(map(int, x)) for x in zip(*got)] == [(0, n, q)]
    assert not len(runs.runs(mix(np.arange(60_000, dtype=np.uint64) % np.uint64(20_001)), np.array([0, 60_000]))[0])


def test_members_are_compacted(monkeypatch):
    """The list of members is written down anew when it has grown: results stay."""
    r = random.Random(9)
    w = [r.randint(0, 1) for _ in range(4000)] + [0, 1, 1] * 300
    one = runs.runs(mix(np.array(w, np.uint64)), np.array([0, len(w)]))
    calls = []
    monkeypatch.setattr(runs.Partition, "append", lambda self, *a, f=runs.Partition.append: (self.compact(), calls.append(1), f(self, *a)))
    two = runs.runs(mix(np.array(w, np.uint64)), np.array([0, len(w)]))
    assert calls and all(np.array_equal(a, b) for a, b in zip(one, two)) and len(one[0])


def want(doc_id, text):
    w = WORD.findall(text or "")
    n, h = len(w), zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]
    found = plain(w)
    best = min(found, key=lambda x: (-x[1] / x[2], x[0], x[2]), default=None)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (doc_id, len(found), *(best or (None,) * 3), None if best is None else 1000 * best[1] // best[2], sha("".join(f"{a},{b},{c}\n" for a, b, c in found)), sha(collapsed(w, found)))


def test_query_equals_brute_force(spark, make, tmp_path):
    r = random.Random(4)
    rows = [(None, "a b c " * 20), (1, None), (2, ""), (3, " \n\t"), (4, "x " * 23), (5, "x " * 24), (6, "é\tß\n" * 30)]
    rows += [(i, " ".join(f"w{x}" for x in sample(r))) for i in range(7, 90)] + [(50, "x y " * 40)] * 2
    rows += [(i, " ".join(f"u{i}v{k}" for k in range(r.randint(1, 400)))) for i in range(90, 160)]
    make(rows).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    out = runs.op11_runs(spark, str(tmp_path))
    assert out.dtypes == [("doc_id", "bigint"), ("n_runs", "bigint"), ("start", "bigint"), ("length", "bigint"), ("period", "bigint"), ("exponent_milli", "bigint"), ("runs_sha256", "string"), ("collapsed_sha256", "string")]
    assert sorted(map(tuple, out.collect()), key=repr) == sorted((want(*x) for x in rows), key=repr)


def test_operator_returns_runs_and_texts(spark, make, nasty):
    got = runs.periodic(make([*nasty, (20, "start " + "to be or not " * 8 + "end")]))
    rows = {r.doc_id: r for r in got.collect()}
    assert [tuple(x) for x in rows[20].runs] == [(1, 32, 4)] and rows[20].collapsed == "start to be or not end"
    assert rows[1].n_words == 0 and rows[1].runs == [] and rows[1].collapsed == ""
    assert runs.periodic(make([])).collect() == []


def test_texts_beyond_a_slice(spark, make, monkeypatch):
    """Longer than a slice and than what is joined at a time."""
    monkeypatch.setattr(runs, "JOINED", 1000)
    w = [f"a{i}" for i in range(20_000)]
    text = " ".join([*w, *w, *w, "tail"])
    batch = lambda t: iter([__import__("pyarrow").RecordBatch.from_pydict({"doc_id": [1, 2], "text": [t, "x"]})])
    monkeypatch.setattr(runs, "SLICE", 1000)
    one, two = list(runs.finder(24, 3)(batch(text)))
    assert one.column(2).to_pylist() == [[{"start": 0, "length": 60_000, "period": 20_000}]]
    assert one.column(3).to_pylist() == [" ".join([*w, "tail"])] and two.column(3).to_pylist() == ["x"]
