"""Alignment of two tokenizers against a walk over whole texts."""

import collections
import hashlib
import itertools
import random

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from cellspark.llm import alignment
from cellspark.llm.common import flat
from cellspark.llm.encoding import tokenizer_path

A, B = "byte_bpe_50k.json", "piece_bpe_32k.model"
MIXED = ["a", "foo", "Bar", " ", "  ", "\n", "\t", "\r\n", "é", "▁", "<|endoftext|>", "<s>", "'s", "don't", "12", "345", "　", "\xa0", "😀", "中文字", "\x1c", ".", "...", "_", "{", "\x00", "zzzzqqq", "\x85"]


@pytest.fixture(scope="module")
def walk():
    """n_a, n_b, n_groups, groups and links of a whole text; none if it is empty or its tokens spell something else."""
    import sentencepiece
    from tokenizers import Tokenizer

    tok, sp = Tokenizer.from_file(tokenizer_path(A)), sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(B))
    tok.encode_special_tokens = True
    byte, shown = alignment.byte_level(), {i: s for s, i in tok.get_vocab().items()}

    def work(text):
        if not text:
            return 0, 0, 0, "", {}
        a, b = tok.encode(" " + text, add_special_tokens=False).ids, sp.encode(text)
        raw_a = [bytes(byte[c] for c in shown[i]) for i in a]
        raw_b = [bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace("▁", " ").encode() for i in b]
        if {b"".join(raw_a), b"".join(raw_b)} != {(" " + text).encode()}:
            return 0, 0, 0, "", {}
        ends_a, ends_b = (list(itertools.accumulate(map(len, x))) for x in (raw_a, raw_b))
        out, links = [], collections.Counter()
        for lo, hi in itertools.pairwise([0, *sorted(set(ends_a) & set(ends_b))]):
            x, y = [i for i, e in zip(a, ends_a) if lo < e <= hi], [i for i, e in zip(b, ends_b) if lo < e <= hi]
            out.append(f"{','.join(map(str, x))}|{','.join(map(str, y))}")
            links.update(itertools.product(x, y))
        return len(a), len(b), len(out), ";".join(out), dict(links)

    return work


def same(texts, walk, tables):
    f = alignment.Found(tables, *flat(pa.array(texts, pa.string())), True)
    for k, t in enumerate(texts):
        at = slice(f.bounds[k], f.bounds[k + 1])
        links = {(int(p) >> alignment.BITS, int(p) & (1 << alignment.BITS) - 1): int(n) for p, n in zip(f.pairs[at], f.times[at])}
        assert (*map(int, f.numbers[k]), f.groups[k], links) == walk(t), repr(t)


def test_pieces_equal_whole_texts(walk):
    tables, r = alignment.aligner(tokenizer_path(A), tokenizer_path(B)), random.Random(3)
    for _ in range(300):
        same(["".join(r.choice(MIXED) for _ in range(r.randint(0, 25))) for _ in range(5)], walk, tables)


def test_long_texts_in_parts(walk, monkeypatch):
    monkeypatch.setattr(alignment.parts, "__defaults__", (300,))
    tables, r = alignment.aligner(tokenizer_path(A), tokenizer_path(B)), random.Random(4)
    for _ in range(20):
        same(["".join(r.choice([*MIXED[:9], *["word ", " next", " x y"] * 4]) for _ in range(r.randint(300, 900)))], walk, tables)
    same(["x" * 2000 + " " + "y z " * 500], walk, tables)
    same(["word next " * 200 + "▁" + " word next" * 200], walk, tables)  # one part spells something else: no tokens at all


def test_two_pieces_with_one_key_and_forgetting(walk, monkeypatch):
    tables = alignment.Aligner(tokenizer_path(A), tokenizer_path(B))
    monkeypatch.setattr(alignment, "run_hashes", lambda data, starts, ends: (ends - starts).astype("uint64"))
    same(["one two six ten", "ten and one"], walk, tables)
    monkeypatch.undo()
    tables.forget()
    monkeypatch.setattr(alignment, "MOST_PIECES", 3)
    for _ in range(3):
        same(["one two six ten", "ten and one"], walk, tables)


def want(rows, walk):
    found = [(i, walk(t)) for i, t in rows]
    n = collections.Counter(pair for _, f in found for pair in f[4])
    most = collections.Counter()
    for (a, _), k in n.items():
        most[a] = max(most[a], k)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest() if s else ""
    return [(i, *f[:3], sum(f[4].values()), sum(k for p, k in f[4].items() if n[p] == most[p[0]]), sum(k * n[p] for p, k in f[4].items()), sha(f[3])) for i, f in found]


def test_query_equals_brute_force(spark, make, nasty, walk, tmp_path, monkeypatch):
    r = random.Random(5)
    rows = [(i, t if t is None or len(t) < 10_000 else t[:3000]) for i, t in nasty] + [(100 + k, " ".join(r.choice(["alpha", "beta-7", "don't", "naïve", "x▁y" if k % 9 == 0 else "xy", "tokenization", "12345"]) for _ in range(r.randint(1, 40)))) for k in range(60)]
    make(rows).repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    out = alignment.op12_alignment(spark, str(tmp_path))
    assert [t for _, t in out.dtypes] == ["bigint"] * 7 + ["string"]
    assert sorted(map(tuple, out.collect()), key=repr) == sorted(want(rows, walk), key=repr)


def test_operator_returns_groups_and_links(spark, make, walk):
    rows = [(1, "tokenization of naïve words"), (2, None), (3, ""), (4, "x▁y")]
    for r in alignment.aligned(make(rows), tokenizer_path(A), tokenizer_path(B)).collect():
        assert (r.n_a, r.n_b, r.n_groups, r.groups, {(x.a, x.b): x.times for x in r.links}) == walk(dict(rows)[r.doc_id])
    assert alignment.aligned(make([]), tokenizer_path(A), tokenizer_path(B)).collect() == []


def test_memory_follows_parts_and_not_slices(walk, monkeypatch):
    r = random.Random(6)
    words = lambda n: " ".join("".join(r.choice("abcdefghij") for _ in range(6)) for _ in range(n))
    texts, seen = [*(words(150) for _ in range(300)), words(120_000), *(words(150) for _ in range(300)), None, ""], collections.Counter()
    tables = alignment.Aligner(tokenizer_path(A), tokenizer_path(B))
    find, real = tables.find, tables.b

    class Watched:
        def encode(self, pieces, **more):
            seen["batch"] = max(seen["batch"], len(pieces))
            return real.encode(pieces, **more)

    def watched(data, starts, ends):
        seen["part"] = max(seen["part"], len(data))
        return find(data, starts, ends)

    monkeypatch.setattr(tables, "find", watched)
    tables.b = Watched()
    f = alignment.Found(tables, *flat(pa.array(texts, pa.string())), True)
    assert [(*map(int, f.numbers[k]), f.groups[k]) for k in (0, 299, 301, 600, 601, 602)] == [walk(texts[k])[:4] for k in (0, 299, 301, 600, 601, 602)]
    assert seen["part"] <= 2 * 256_000 + 1000 and seen["batch"] <= 4096


def test_blocks_are_read_a_few_at_a_time(spark, make, walk, tmp_path, monkeypatch):
    rows, seen, table = [(k, f"word{k} and {'more ' * (k % 7)}text") for k in range(90)], {}, alignment.table
    make(rows).coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")

    def kept(df, name, *more, **options):
        seen[name] = table(df, name, *more, **options)
        return seen[name]

    monkeypatch.setattr(alignment, "table", kept)
    monkeypatch.setattr(alignment, "SLICE", 1)  # a block per document
    assert sorted(map(tuple, alignment.op12_alignment(spark, str(tmp_path)).collect())) == sorted(want(rows, walk))
    files = [pq.ParquetFile(f.removeprefix("file:")).metadata for f in seen["aligned"].inputFiles()]
    groups = [f.row_group(i).num_rows for f in files for i in range(f.num_row_groups)]
    assert sum(groups) == 90 and max(groups) <= 8
    assert dict(seen["aligned"].dtypes)["at"] == "binary"
