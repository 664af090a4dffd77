"""Edge cases and brute-force checks of the text operators on small tables."""

import base64
import bisect
import collections
import hashlib
import math
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cellspark.llm import components, decontamination, encoding, jaccard, lm, media, packing, sharding, substrings, toxicity, warc
from cellspark.llm.common import Words, flat, scratch_path, table

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# ------------------------------------------------------------------ 1 toxicity
def toxic_rows(n=400):
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(300)]
    docs, labels = [], []
    for i in range(n):
        text = [words[k] for k in rng.integers(0, 300, 30)]
        bad = i % 4 == 0
        if bad:
            text += ["vile", "rotten", "nasty"]
        # Toxic texts often name one group: without the penalty its name looks toxic.
        if bad and rng.random() < 0.8 or not bad and rng.random() < 0.02:
            text.append("muslim")
        docs.append((i, " ".join(text)))
        labels.append((i, int(bad)))
    return docs, labels


def test_toxicity_learns_and_ignores_group_names(spark, make):
    docs, labels = toxic_rows()
    d, y = make(docs), spark.createDataFrame(labels, "doc_id long, toxic int")
    fair, plain = toxicity.train(d, y), toxicity.train(d, y, swap_weight=0.0)
    probe = make([(1, "w1 w2 muslim w3"), (2, "w1 w2 jewish w3"), (3, "w1 vile rotten"), (4, "w5 w6"), (5, None), (6, "")])
    s = {r.doc_id: r.score for r in toxicity.score(probe, fair).collect()}
    p = {r.doc_id: r.score for r in toxicity.score(probe, plain).collect()}
    assert s[3] > 0.5 > 0.2 > s[4] and s[5] == s[6]
    odds = lambda x: math.log(x / (1 - x))
    assert abs(odds(s[1]) - odds(s[2])) < abs(odds(p[1]) - odds(p[2])) / 3
    assert s[1] < 0.3 and s[1] < p[1]
    kept = toxicity.keep_clean(probe, fair)
    assert kept.columns == probe.columns and 3 not in [r.doc_id for r in kept.collect()]


def test_toxicity_without_labels_or_documents(spark, make, nasty):
    d = make(nasty)
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert all(r.score < 1e-9 for r in toxicity.score(d, toxicity.train(d, none)).collect())
    one = spark.createDataFrame([(4, 1), (4, None), (None, 1), (999, 0)], "doc_id long, toxic int")
    assert all(r.score > 1 - 1e-9 for r in toxicity.score(d, toxicity.train(d, one)).collect())
    assert toxicity.score(make([]), toxicity.train(make([]), one)).count() == 0


# ---------------------------------------------------------------------- 2 WARC
def test_warc_round_trip(spark):
    rows = [(3, "http://a", "same"), (1, "http://b", "same"), (2, None, None), (4, "http://c\r\nX: y", ""), (5, "http://d", "ü" * 100_000), (None, "http://e", "same"), (1, "http://b", "same")]
    pages = spark.createDataFrame([(*r, "extra", 0) for r in rows], "page_id long, url string, html string, digest string, offset int")
    path = scratch_path(spark, "warc")
    index = warc.write_archives(pages, path, file_bytes=2000)
    got = sorted(warc.read_records(index, path, gap=10, most=500).collect(), key=str)
    assert len(got) == len(rows)
    digest = lambda s: base64.b32encode(hashlib.sha1((s or "").encode()).digest()).decode()
    want = collections.Counter()
    for i, _, html in rows:
        first = {"same": 1, "": 2}.get(html or "")
        revisit = i is not None and first is not None and i > first
        want[(i, len((html or "").encode()), digest(html), "revisit" if revisit else "response", first if revisit else None)] += 1
    assert collections.Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got) == want
    # A selection reads only what the index names, and in few ranges.
    some = warc.read_records(index.filter("page_id = 5"), path).collect()
    assert [r.payload_bytes for r in some] == [200_000]
    assert warc.ranges(index).count() == index.select("file").distinct().count()
    assert warc.read_records(warc.write_archives(pages.limit(0), scratch_path(spark, "warc")), path).count() == 0


def test_small_payloads_are_never_revisits(spark):
    pages = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcd"), (4, "u", "abcd")], "page_id long, url string, html string")
    index = warc.write_archives(pages, scratch_path(spark, "warc"), least=3)
    assert {r.page_id: r.record_type for r in index.collect()} == {1: "response", 2: "response", 3: "response", 4: "revisit"}


# ------------------------------------------------------------- 3 n-gram Jaccard
def jaccard_truth(rows):
    sets = []
    for i, t in rows:
        w = WORD.findall(t or "")
        if i is not None:
            sets.append((i, frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])))
    n = len(sets)
    links = [0] * n
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(n):
        for b in range(a + 1, n):
            x, y = sets[a][1], sets[b][1]
            if x == y or (x and y and len(x & y) / len(x | y) >= 0.8):
                links[a] += 1
                links[b] += 1
                root[max(find(a), find(b))] = min(find(a), find(b))
    low = collections.defaultdict(list)
    for k, (i, _) in enumerate(sets):
        low[find(k)].append(i)
    return sorted((i, min(low[find(k)]), links[k]) for k, (i, _) in enumerate(sets))


def variants(n, edits):
    rng = np.random.default_rng(1)
    base = [f"t{i}" for i in range(120)]
    out = []
    for _ in range(n):
        w = list(base)
        for k in rng.integers(0, 120, edits):
            w[k] = f"e{rng.integers(10**9)}"
        out.append(" ".join(w))
    return out


def test_jaccard_equals_brute_force(make, nasty):
    rows = nasty + [(100 + i, t) for i, t in enumerate(variants(40, 2))] + [(200 + i, " ".join(f"u{i}v{k}" for k in range(50))) for i in range(10)]
    rows += [(300, rows[-1][1] + " more"), (301, rows[-1][1]), (302, rows[-2][1] + " and quite a few more words than that so far beyond it all")]
    got = sorted((r.id, r.class_id, r.n_links) for r in jaccard.jaccard_join(make(rows)).collect())
    assert got == jaccard_truth(rows)
    kept = jaccard.keep_one(make(rows))
    truth = {i: c for i, c, _ in jaccard_truth(rows)}
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == sorted({i for i, _ in rows if i is not None and truth[i] == i})
    assert None in [r.doc_id for r in kept.collect()]


def test_large_groups_go_through_blocks(make, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", 20)
    rows = [(i, t) for i, t in enumerate(variants(90, 1) + variants(30, 9))]
    got = sorted((r.id, r.class_id, r.n_links) for r in jaccard.jaccard_join(make(rows)).collect())
    assert got == jaccard_truth(rows)


def test_rows_that_share_a_doc_id_are_kept_apart(make):
    a, b = " ".join(f"a{i}" for i in range(60)), " ".join(f"b{i}" for i in range(60))
    rows = [(1, a), (1, b), (1, a), (2, b + " more"), (3, a + " more"), (3, "some text of its own that nobody else has")]
    got = sorted((r.id, r.class_id, r.n_links) for r in jaccard.jaccard_join(make(rows)).collect())
    assert got == jaccard_truth(rows)
    kept = sorted((r.doc_id, r.text) for r in jaccard.keep_one(make(rows)).collect())
    assert kept == [(1, a), (1, b), rows[-1]]


def test_jaccard_of_nothing(make):
    assert jaccard.jaccard_join(make([])).count() == 0
    assert [(r.id, r.class_id, r.n_links, r.n_set_links) for r in jaccard.jaccard_join(make([(5, None), (3, "")])).orderBy("id").collect()] == [(3, 3, 1, 0), (5, 3, 1, 0)]


def test_pruning_is_rarely_wrong():
    rng = np.random.default_rng(0)
    steps = jaccard.least_matches(0.8, 1e-6)
    same = rng.random((20000, jaccard.HASHES)) < 0.8
    left = np.zeros((20000, jaccard.HASHES), np.uint32)
    assert len(jaccard.likely(left, (~same).astype(np.uint32), steps)) == 20000
    assert len(jaccard.likely(left, (rng.random((20000, jaccard.HASHES)) > 0.3).astype(np.uint32), steps)) < 20


def test_components(spark):
    edges = [(1, 2), (2, 3), (3, 4), (9, 8), (8, 7), (5, 5), (None, 1), (4, 1), (10, 20), (1, 2)] + [(100 + i, 101 + i) for i in range(40)]
    got = {r.v: r.label for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 1, 7: 7, 8: 7, 9: 7, 10: 10, 20: 10} | {100 + i: 100 for i in range(41)}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


# ------------------------------------------------------------- 4 and 8 tokens
@pytest.mark.parametrize("limit", [3, 2048])
def test_token_counts_equal_the_library(make, nasty, limit):
    from tokenizers import Tokenizer

    path = encoding.tokenizer_path("word_bpe_49k.json")
    tok = Tokenizer.from_file(path)
    odd = ["don't I'LL", "a  b \n c", "x<|startoftext|>y", "  lead", "trail \n", "１２ Ⅳ ǅ İ ΑΣ", "a\x1cb", "é ́e", "😀 tail"]
    rows = nasty + [(20 + i, t) for i, t in enumerate(odd)]
    got = sorted(tuple(r) for r in encoding.token_counts(make(rows), path, limit).collect() if r.doc_id is not None)
    want = sorted((i, len((t or "").encode()), n := len(tok.encode(t or "", add_special_tokens=False).ids), n > limit) for i, t in rows if i is not None)
    assert got == want
    assert encoding.token_counts(make([]), path).count() == 0


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_odd_characters_are_cut_out_of_long_texts(name):
    from tokenizers import Tokenizer

    path, rng = encoding.tokenizer_path(name), np.random.default_rng(11)
    tok, own = Tokenizer.from_file(path), encoding.Pieces(path, name.startswith("byte"))
    some = ["a", "B", "'s", " ", "  ", "\n", "\xa0", "\u3000", "\u2009", "\x1c", "<|endoftext|>", "<|", "1", "é", "\u0301", "東", "don't", "\x85"]
    texts = ["".join(some[k] for k in rng.integers(0, len(some), rng.integers(0, 20))) for _ in range(3000)] + ["plain words here " * 300_000 + "x\xa0 \xa0y <|endoftext|>  z " + "and more " * 10]
    data, offsets = flat(pa.array(texts))
    want = [tok.encode(t, add_special_tokens=False).ids for t in texts]
    if own.ids:
        assert [x.tolist() for x in own.rows(data, offsets)] == want
        pieces = np.diff(np.stack(own.cuts(*flat(pa.array(texts[-1:])))), axis=0)
        assert pieces.max() < 60
    else:
        assert own.counts(data, offsets).tolist() == [len(x) for x in want]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_pieces_with_one_key_are_told_apart(name, monkeypatch):
    from tokenizers import Tokenizer

    plain = encoding.run_hashes
    monkeypatch.setattr(encoding, "run_hashes", lambda *a: plain(*a) % np.uint64(7))
    path = encoding.tokenizer_path(name)
    tok, own = Tokenizer.from_file(path), encoding.Pieces(path, name.startswith("byte"))
    for texts in (["one two three two", "four one"], ["five six", "one"]):
        data, offsets = flat(pa.array(texts))
        got = [len(x) for x in own.rows(data, offsets)] if own.ids else own.counts(data, offsets).tolist()
        assert got == [len(tok.encode(t, add_special_tokens=False).ids) for t in texts]


def thue_morse(n=2048):
    """Two words of n letters that collide under every polynomial hash modulo 2**64 with an odd base."""
    bits = [bin(i).count("1") % 2 for i in range(n)]
    return "".join("ab"[k] for k in bits), "".join("ba"[k] for k in bits)


def test_words_that_collide_under_polynomials(make):
    from tokenizers import Tokenizer

    a, b = thue_morse()
    rows = [(1, " ".join([a] * 14)), (2, " ".join([b] * 14)), (3, " ".join([a] * 14))]
    got = {r.id: (r.class_id, r.n_links) for r in jaccard.jaccard_join(make(rows)).collect()}
    assert got == {1: (1, 1), 2: (2, 0), 3: (1, 1)}
    assert {r.doc_id: r.n_removed for r in substrings.dedup_substrings(make(rows)).collect()} == {1: 0, 2: 0, 3: 14}
    for name, ids in (("word_bpe_49k.json", False), ("byte_bpe_50k.json", True)):
        path = encoding.tokenizer_path(name)
        tok, own = Tokenizer.from_file(path), encoding.Pieces(path, ids)
        data, offsets = flat(pa.array([t for _, t in rows]))
        want = [tok.encode(t, add_special_tokens=False).ids for _, t in rows]
        assert ([x.tolist() for x in own.rows(data, offsets)] if ids else own.counts(data, offsets).tolist()) == (want if ids else [len(x) for x in want])
    known = {r.doc_id: (r.n_known, r.train_tokens) for r in lm.lm_scores(make(rows), F.col("doc_id") != 2).collect()}
    assert known == {1: (15, 30), 2: (1, 30), 3: (15, 30)}


def pack_truth(rows, capacity):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(encoding.tokenizer_path("byte_bpe_50k.json"))
    out = collections.Counter()
    for i, t in rows:
        ids = tok.encode(t or "", add_special_tokens=False).ids + [2]
        first = (len(ids) - 1) % capacity + 1
        cuts = [0, *range(first, len(ids) + 1, capacity)]
        for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
            out[(i, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes()))] += 1
    return out


def test_packing(make, nasty):
    rng = np.random.default_rng(2)
    odd = ["a  b \n c", "x<|endoftext|>y", " \n b", "trail \n", "\r\n\r\n", "don't  stop"]
    rows = nasty + [(20 + i, t) for i, t in enumerate(odd)] + [(100 + i, "word " * int(n)) for i, n in enumerate(rng.integers(1, 90, 200))]
    cuts = table(packing.cut(make(rows), encoding.tokenizer_path("byte_bpe_50k.json"), 64), "pieces")
    got = packing.pack(cuts, 64).collect()
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == pack_truth(rows, 64)
    by = collections.defaultdict(list)
    for r in got:
        by[r.sequence_id].append((r.offset, r.length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 64
    total = sum(r.length for r in got)
    assert len(by) <= 1.02 * total / 64 + 1
    empty = table(packing.cut(make([]), encoding.tokenizer_path("byte_bpe_50k.json")), "pieces")
    assert packing.pack(empty).count() == 0


def best_fit_decreasing(lengths, capacity):
    """The number of sequences that sequential best fit needs, from the longest length down."""
    free, opened = [], 0
    for n in sorted(lengths, reverse=True):
        at = bisect.bisect_left(free, n)
        gap = free.pop(at) if at < len(free) else capacity
        opened += at == len(free) and gap == capacity
        bisect.insort(free, gap - n)
    return opened


@pytest.mark.parametrize("kind", ["uniform", "short", "equal", "halves", "few"])
def test_rounds_pack_as_well_as_sequential_best_fit(spark, kind):
    rng = np.random.default_rng(21)
    lengths = {
        "uniform": rng.integers(1, 64, 900),
        "short": np.minimum(1 + rng.geometric(0.3, 3000), 63),
        "equal": np.full(700, 22),
        "halves": rng.integers(28, 36, 600),
        "few": np.array([63, 1, 40]),
    }[kind].tolist()
    docs = table(spark.createDataFrame(list(enumerate(lengths)), "id long, length long").repartition(5), "docs")
    placed, opened = packing.best_fit(docs, 64)
    got = placed.collect()
    assert sorted(r.id for r in got) == list(range(len(lengths)))
    used = collections.defaultdict(list)
    for r in got:
        used[r.sequence_id].append((r.offset, lengths[r.id]))
    for places in used.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 64
    assert len(used) <= opened and set(used) <= set(range(opened))
    assert len(used) <= 1.01 * best_fit_decreasing(lengths, 64) + 1


def test_a_sweep_gives_each_document_the_smallest_free_slot(spark):
    rng = np.random.default_rng(22)
    for parts, n in ((1, 40), (7, 300)):
        free, want = rng.integers(1, 50, n).tolist(), rng.integers(1, 50, n).tolist()
        rows = [(f, False, i, 0, f) for i, f in enumerate(free)] + [(w, True, i, 0, None) for i, w in enumerate(want)]
        before = spark.conf.get("spark.sql.shuffle.partitions")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        spark.conf.set("spark.sql.shuffle.partitions", str(parts))
        try:
            got, without = packing.sweep(spark.createDataFrame(rows, "size long, doc boolean, id long, k int, free long"))
            pairs = sorted((r.length, r.free) for r in got.collect())
            none = sorted(r.length for r in without.collect())
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", before)
            spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        truth, missed, open_ = [], [], sorted(free)
        for w in sorted(want, reverse=True):
            at = bisect.bisect_left(open_, w)
            truth.append((w, open_.pop(at))) if at < len(open_) else missed.append(w)
        assert pairs == sorted(truth) and none == sorted(missed)


# ------------------------------------------------------------------------ 5 LM
def test_base_scores_and_gain(make, nasty, monkeypatch):
    monkeypatch.setattr(lm, "LEAST", 3)
    rng = np.random.default_rng(4)
    # Two "languages": the model can tell from the context which words come next.
    a, b = [f"a{i}" for i in range(40)], [f"b{i}" for i in range(40)]
    rows = nasty[:5] + [(None, "A0 b0")] + [(50 + i, " ".join((a if i % 2 else b)[k] for k in rng.integers(0, 40, 60)) + f" only{i}") for i in range(300)]
    rows.append(rows[-1])
    docs = make(rows)
    got = lm.lm_scores(docs, lm.in_training(F.col("doc_id"))).collect()
    low = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})
    tokens = [(i, [*WORD.findall((t or "").translate(low)), None]) for i, t in rows]
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    c = collections.Counter(x for i, t in tokens if not held(i) for x in t)
    total = sum(c.values())
    logs = math.log10(total + len(c) + 1)
    want = sorted((str(i), len(t), sum(c[x] > 0 for x in t), total, round(sum(math.log10(c[x] + 1) - logs for x in t), 6)) for i, t in tokens)
    assert sorted((str(r.doc_id), r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
    assert all(np.isfinite(r.score) for r in got)
    out = [r for r in got if not r.train]
    assert len(out) > 20 and sum(r.score for r in out) > sum(r.base_score for r in out) + 10
    assert lm.lm_scores(make([]), F.lit(True)).count() == 0
    none = lm.lm_scores(make([(1, "x y")]), F.lit(False)).collect()[0]
    assert (none.n_known, none.train_tokens, none.base_score) == (0, 0, 0.0) and np.isfinite(none.score)


def test_words_that_are_not_top_are_told_apart_by_context(make, monkeypatch):
    monkeypatch.setattr(lm, "TOP", 0)
    rng = np.random.default_rng(8)
    # All words end alike and are about equally frequent; only the word before says which one comes next.
    rows = [(i, " ".join(f"a{k}x b{k}x" for k in rng.integers(0, 12, 30))) for i in range(1500)]
    out = [r for r in lm.lm_scores(make(rows), lm.in_training(F.col("doc_id"))).collect() if not r.train]
    tokens = sum(r.n_tokens for r in out)
    assert len(out) > 100 and sum(r.score for r in out) / tokens > sum(r.base_score for r in out) / tokens + 0.25


def test_the_model_depends_on_the_documents_alone(make):
    rng = np.random.default_rng(14)
    words = [f"w{i}" for i in range(200)]
    rows = [(i, " ".join(words[k] for k in rng.zipf(1.4, 80) % 200)) for i in range(400)]
    docs = make(rows)
    got = []
    for parts in (1, 5):
        counts, model, _ = lm.learn(docs.repartition(parts, "doc_id").select("doc_id", "text"), 3, 20_000)  # several workers in each round
        got.append([counts.hashes, counts.counts, counts.classes, counts.class_counts, *vars(model).values()])
    assert all(np.array_equal(a, b) for a, b in zip(*got, strict=True))
    assert got[0][3].sum() == sum(len(WORD.findall(t)) + 1 for _, t in rows)


def test_scores_equal_a_plain_evaluation(make):
    rng = np.random.default_rng(15)
    words = [f"w{chr(97 + i % 26)}" if i % 2 else f"v{i}{chr(97 + i % 7)}" for i in range(150)]
    rows = [(i, " ".join(words[k] for k in rng.zipf(1.3, 40) % 150) + f" only{i}a") for i in range(250)]
    docs = make(rows)
    scores = {r.doc_id: r.score for r in lm.lm_scores(docs, F.lit(True)).collect()}
    counts, model, _ = lm.learn(docs.select("doc_id", "text"))
    c = collections.Counter(x for _, t in rows for x in WORD.findall(t))
    at = {h: k for k, h in enumerate(counts.hashes.tolist())}
    ending = lambda x: lm._ENDING[x.encode()[-1]]
    hashed = lambda x: int(lm.Texts(pa.array([x])).h[0])
    rest = collections.defaultdict(list)  # rare words by ending
    for x in c:
        if hashed(x) not in at:
            rest[ending(x)].append(x)
    for i, t in rows[:12]:
        total, before = 0.0, [len(at) + lm.ENDINGS] * lm.CONTEXT
        for x in [*WORD.findall(t), None]:
            expect = sum(model.r[b].astype("f8") * model.c[j] for j, b in enumerate(before))
            k = counts.end if x is None else int(counts.classes[at[hashed(x)]]) if hashed(x) in at else counts.top + ending(x)
            z = [math.exp(float(expect @ q + b)) for q, b in zip(model.q.astype("f8"), model.b, strict=True)]
            p = z[k] / sum(z)
            if x is not None and hashed(x) not in at:
                p *= (c[x] + 1) / (sum(c[y] + 1 for y in rest[ending(x)]) + 1)  # 1 more for all unknown words
            elif k > counts.end:
                lo, hi = counts.starts[k], counts.starts[k + 1]
                z = [math.exp(float(expect @ q + b)) for q, b in zip(model.wq[lo:hi].astype("f8"), model.wb[lo:hi], strict=True)]
                p *= z[counts.slots[at[hashed(x)]] - lo] / sum(z)
            total += math.log10(p)
            here = len(at) + lm.ENDINGS if x is None else at[hashed(x)] if hashed(x) in at else len(at) + ending(x)
            before = [here, *before[:-1]]
        assert scores[i] == pytest.approx(total, abs=2e-3)


def test_words_are_counted_exactly_however_little_a_task_holds(make):
    rng = np.random.default_rng(16)
    rows = [(i, " ".join(f"w{k}" for k in rng.zipf(1.2, 300) % 900)) for i in range(200)] + [(None, None), (300, ""), (301, "W0 w0")]
    want = collections.Counter(x.lower() for _, t in rows for x in WORD.findall(t or ""))
    key = lambda x: int(lm.Texts(pa.array([x])).h.view(np.int64)[0])
    truth = {key(x): n for x, n in want.items()}
    assert len(truth) == len(want)
    for at_once, most in ((1, 1), (1, 40), (500, 200), (4_000_000, 1_000_000)):
        table = lm.word_counts(make(rows), at_once, most)
        assert {r.h: r.n for r in table.collect()} == truth
    for most in (0, 1, 50, 400, len(truth), 10_000):
        got = lm.most_frequent(table, most).to_pydict()
        assert len(got["h"]) <= most and all(truth[h] == n for h, n in zip(got["h"], got["n"], strict=True)) and got["n"] == sorted(got["n"], reverse=True)
        left = [n for h, n in truth.items() if h not in set(got["h"])]
        # All but 4,096th parts of the last class of equal counts, and nothing of a smaller one.
        assert not left or not got["n"] or max(left) <= min(got["n"]) * 1.011 or most == 0
        assert len(got["h"]) >= min(most, len(truth)) - 4
    assert lm.word_counts(make([])).count() == 0


def test_word_probabilities_are_normalised():
    h, ones = np.arange(9, dtype=np.uint64), np.ones(9, np.int64)
    classes = np.array([0, 62, 1, 63, 62, 63, 62, 62, 63]) + np.array([0, 1, 0, 1, 1, 1, 1, 1, 1])
    counts = lm.Counts(h, ones, classes, 2, np.ones(65, np.int64), 3)
    model = lm.Model.start(counts)
    seq = np.concatenate([classes, np.arange(2, 63)])
    slot = np.concatenate([counts.slots, np.full(61, -1)])
    logs = model.log_word_probabilities(counts, seq, np.full((len(seq), lm.CONTEXT), 4), slot)
    assert np.exp(logs).sum() == pytest.approx(1, abs=1e-5)


def test_class_probabilities_are_normalised():
    counts = lm.Counts(np.arange(5, dtype=np.uint64), np.ones(5, np.int64), np.arange(5), 5, np.ones(5 + lm.ENDINGS + 1, np.int64), 3)
    model = lm.Model.start(counts)
    before = np.zeros((len(model.b), lm.CONTEXT), np.int64) + 2
    assert np.exp(model.log_probabilities(np.arange(len(model.b)), before)).sum() == pytest.approx(1, abs=1e-5)


# -------------------------------------------------------------- 6 decontamination
def edit_distance_inside(item, text):
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        last, row[0] = row[0], i
        for j, b in enumerate(text, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (a != b))
    return min(row)


def test_myers_equals_dynamic_programming():
    rng = np.random.default_rng(5)
    for _ in range(150):
        item = "".join(rng.choice(list("abc"), rng.integers(1, 90)))
        text = "".join(rng.choice(list("abc"), rng.integers(0, 120)))
        assert decontamination.myers(decontamination.masks(item), len(item), text)[0] == edit_distance_inside(item, text)


def test_decontamination_equals_brute_force(spark, make, nasty):
    rng = np.random.default_rng(6)
    item = lambda: " ".join("".join(rng.choice(list("abcdefgh"), rng.integers(2, 9))) for _ in range(30))
    items = [(i, item()) for i in range(6)]
    docs = list(nasty)
    for k in range(60):
        i, text = items[k % 6]
        chars = list(text)
        for _ in range(int(rng.integers(0, 26))):
            at = int(rng.integers(0, len(chars)))
            chars[at : at + int(rng.integers(0, 2))] = ["x"] * int(rng.integers(0, 2))
        docs.append((100 + k, f"{item()} {''.join(chars).upper() if k % 2 else ''.join(chars)}\n {item()}"))
    bench = spark.createDataFrame([*items, (7, None), (8, "  "), (None, items[0][1]), (0, items[0][1])], "item_id long, text string")
    want = set()
    for d, t in docs:
        for i, x in [*items, (None, items[0][1])]:
            if t and len(t) < 5000 and (n := edit_distance_inside(decontamination.normal(x), decontamination.normal(t))) <= decontamination.budget(len(decontamination.normal(x)), 0.08):
                want.add((d, i, n))
    for block in (10**6, 300):
        got = decontamination.find_items(make(docs), bench, block_bytes=block).collect()
        assert {(r.doc_id, r.item_id, r.distance) for r in got} == want and len(got) == len(want)
    assert 20 < len({d for d, _, _ in want}) < 60
    kept = decontamination.keep_clean(make(docs), bench, block_bytes=300)
    assert kept.columns == make([]).columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(d) for d, _ in docs if d not in {x for x, _, _ in want})
    assert decontamination.find_items(make(docs), bench.limit(0)).count() == 0 and decontamination.find_items(make([]), bench).count() == 0


# ------------------------------------------------------------------- 7 sharding
def test_shards(make, nasty):
    rows = nasty + [(1000 + i, "x" * (i % 37)) for i in range(500)] + [(2000, "same")] * 50
    got = sharding.shards(make(rows), 7).collect()
    size = lambda t: len((t or "").encode()) + 8
    assert collections.Counter((r.doc_id, r.size, r.text_crc32) for r in got) == collections.Counter((i, size(t), zlib.crc32((t or "").encode())) for i, t in rows)
    order = sorted(got, key=lambda r: (r.shard, r.slot))
    keys = [-1 if r.doc_id is None else r.doc_id for r in order]
    assert keys == sorted(keys)
    at, total = 0, sum(r.size for r in got)
    for k, r in enumerate(order):
        assert r.start == at and r.shard == min(at * 7 // total, 6)
        assert r.slot == (0 if not k or order[k - 1].shard != r.shard else order[k - 1].slot + 1)
        at += r.size
    assert sharding.shards(make([])).count() == 0
    assert [(r.shard, r.slot) for r in sharding.shards(make([(1, None)])).collect()] == [(0, 0)]


# ---------------------------------------------------------------------- 9 media
def test_png_filters_round_trip_and_damage():
    rng = np.random.default_rng(7)
    x = rng.integers(0, 256, (17, 24), dtype=np.uint8)
    for filters in (None, 0, 1, 2, 3, 4, np.arange(17) % 5, rng.integers(0, 5, 17)):
        data = media.png(x, filters, idat=50)
        assert np.array_equal(media.unpng(data), x)
        for at in (3, 20, 60, len(data) - 20):
            bad = bytearray(data)
            bad[at] ^= 1
            with pytest.raises(ValueError):
                media.unpng(bytes(bad))
        with pytest.raises(ValueError):
            media.unpng(data[:-5])


def plain_unfilter(rows, w):
    """PNG's row filters, undone byte by byte."""
    out = []
    for y, row in enumerate(rows):
        kind, line = row[0], []
        for x in range(w):
            a, b, c = line[x - 1] if x else 0, out[y - 1][x] if y else 0, out[y - 1][x - 1] if x and y else 0
            p = a + b - c
            near = min((abs(p - a), 0, a), (abs(p - b), 1, b), (abs(p - c), 2, c))[2]
            line.append((row[x + 1] + [0, a, b, (a + b) // 2, near][kind]) % 256)
        out.append(line)
    return out


def test_unfilter_equals_a_plain_loop_on_many_images():
    rng = np.random.default_rng(17)
    images = []
    for h, w in ((1, 5), (6, 5), (9, 3), (4, 5), (1, 3), (12, 5), (0, 5)):
        rows = rng.integers(0, 256, (h, w + 1), dtype=np.uint8)
        rows[:, 0] = rng.integers(0, 5, h)
        images.append(rows)
    for rows, got in zip(images, media.all_samples(images), strict=True):
        assert got.tolist() == plain_unfilter(rows.tolist(), rows.shape[1] - 1)
    text = np.frombuffer((b"Some words of a text, and then some more of them. " * 60)[:2880], np.uint8).reshape(-1, 192)
    own = media.unpacked(media.png(text))
    cost = [[sum(min(v, 256 - v) for v in media.unpacked(media.png(text, k))[y, 1:].tolist()) for k in range(5)] for y in range(len(text))]
    assert own[:, 0].tolist() == [c.index(min(c)) for c in cost] and len(set(own[:, 0].tolist())) > 1


def test_cosine_hash_equals_a_plain_transform():
    rng = np.random.default_rng(18)
    for h, w in ((3, 192), (9, 24)):
        x = rng.integers(0, 256, (h, w))
        c = [round(sum(x[i, j] * math.cos(math.pi / h * (i + 0.5) * u) * math.cos(math.pi / w * (j + 0.5) * v) for i in range(h) for j in range(w)) / (h * w), 9) for u in range(8) for v in range(8)]
        middle = sorted(c[1:])[31]
        assert int(media.cosine_hash(x.astype(np.uint8)), 16) == int("".join("1" if v > middle else "0" for v in c), 2)


def test_cosine_hash_follows_low_frequencies():
    rng = np.random.default_rng(8)
    picture = lambda: media.cosines(48).T @ rng.normal(0, 12, (8, 8)) @ media.cosines(48) + 127
    a, b = picture(), picture()
    to8 = lambda x: np.clip(x, 0, 255).astype(np.uint8)
    bits = lambda x, y: bin(int(media.cosine_hash(to8(x)), 16) ^ int(media.cosine_hash(to8(y)), 16)).count("1")
    assert bits(a, a + rng.normal(0, 3, a.shape)) <= 6 < 16 < bits(a, b)


def test_media(make, nasty):
    got = media.features(table(media.encode_media(make(nasty)), "media")).collect()
    def payload(t):
        raw = (t or "").encode()
        return raw + b"\xff" * (max(576, -(-len(raw) // 576) * 576) - len(raw))
    want = collections.Counter((i, len((t or "").encode()), len(p := payload(t)), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-32:])) for i, t in nasty)
    assert collections.Counter((r.doc_id, r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) for r in got) == want
    by = collections.defaultdict(set)
    for r in got:
        by[r.payload_sha256].add((r.media_bytes, r.media_sha256, r.feature))
    assert all(len(v) == 1 for v in by.values())
    assert media.features(media.encode_media(make([]))).count() == 0


# ------------------------------------------------------------------ 10 substrings
def cut_truth(rows, size):
    first = {}
    words = [(i, None if t is None else WORD.findall(t)) for i, t in rows]
    for i, w in words:
        if i is not None:
            for k in range(len(w or []) - size + 1):
                key = tuple(w[k : k + size])
                first[key] = min(i, first.get(key, i))
    out = []
    for i, w in words:
        gone = [False] * len(w or [])
        for k in range(len(gone) - size + 1):
            if i is not None and first[tuple(w[k : k + size])] < i:
                gone[k : k + size] = [True] * size
        out.append((str(i), len(gone), sum(gone), None if w is None else tuple(x for x, g in zip(w, gone, strict=True) if not g)))
    return sorted(out, key=str)


def test_windows_shared_by_several_slices_of_a_task(make, monkeypatch):
    rng = np.random.default_rng(19)
    passages = [" ".join(f"p{k}x{i}" for i in range(20)) for k in range(6)]
    rows = [(int(i), " ".join(passages[k] for k in rng.integers(0, 6, 3)) + f" own{i}") for i in rng.permutation(400)]
    for most in (3, 10**6):
        monkeypatch.setattr(substrings, "SLICE", 2000)
        monkeypatch.setattr(substrings, "MOST_SHARED", most)
        got = [(str(r.doc_id), r.n_words, r.n_removed, tuple(WORD.findall(r.text))) for r in substrings.dedup_substrings(make(rows).coalesce(2)).collect()]
        assert sorted(got, key=str) == cut_truth(rows, 13)


def test_substrings_equal_brute_force(make, nasty):
    rng = np.random.default_rng(9)
    passage = " ".join(f"p{i}" for i in range(30))
    rows = list(nasty)
    for i in range(80):
        own = [" ".join(f"o{i}q{k}" for k in range(int(rng.integers(0, 20)))) for _ in range(2)]
        a, b = sorted(rng.integers(0, 31, 2))
        rows.append((500 - i, f"{own[0]}\n {' '.join(passage.split()[a:b])}\t{own[1]} "))
    for size in (13, 4):
        out = substrings.dedup_substrings(make(rows), size)
        got = out.collect()
        assert sorted(((str(r.doc_id), r.n_words, r.n_removed, None if r.text is None else tuple(WORD.findall(r.text))) for r in got), key=str) == cut_truth(rows, size)
        assert all(sum(s.last - s.first for s in r.spans) == r.n_removed and all(a.last < b.first for a, b in zip(r.spans, r.spans[1:], strict=False)) for r in got)
        assert [c for c in out.columns if c not in substrings.RESULTS] == [c for c in make([]).columns if c not in substrings.RESULTS]
    assert substrings.dedup_substrings(make([])).count() == 0
