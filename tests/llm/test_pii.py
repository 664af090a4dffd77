"""Personal data against the base expressions as they are written, and the further proposals."""

import hashlib
import random
import re
import time

import pytest

from cellspark.llm import pii

EXPRESSIONS = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def plain(text):
    out = []
    for k, (kind, e) in enumerate(EXPRESSIONS.items()):
        for m in e.finditer(text):
            d = [int(c) for c in m.group() if c.isdigit()]
            luhn = sum(x if i % 2 == 0 else sum(divmod(2 * x, 10)) for i, x in enumerate(reversed(d))) % 10 == 0
            if {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m.group().split(".")), "card": 12 <= len(d) <= 19 and luhn, "phone": 9 <= len(d) <= 15}[kind]:
                out.append((m.start(), k, f"{kind}:{m.start()}:{m.end()}"))
    return [s for *_, s in sorted(out)]


def shown(text, base=False):
    return [f"{pii.KINDS[k]}:{a}:{z}" for k, a, z, _, b in pii.spans_of(text) if b or not base]


def test_base_spans_equal_the_expressions():
    r = random.Random(1)
    parts = ["@", ".", "a", "b-", "é", "😀", " ", "1", "25", "4111", "+", "-", "(", ")", "1.1", "@x.y", "0", "00", "4111111111111111"]
    for _ in range(20_000):
        text = "".join(r.choice(parts) for _ in range(r.randint(0, 30)))
        assert shown(text, base=True) == plain(text), text


@pytest.mark.parametrize("text", ["a" * 2_000_000, "1" * 2_000_000, "1." * 1_000_000, "+1(" * 600_000, "@a.b " * 400_000, "a@" * 900_000, "1 " * 900_000, "AB12" * 500_000, "1 2-" * 500_000])
def test_time_is_linear_in_long_texts(text):
    began = time.process_time()
    pii.spans_of(text)
    assert time.process_time() - began < 20


def test_proposals_checks_and_words_nearby():
    one = lambda t: [(pii.KINDS[k], t[a:z]) for k, a, z, _, base in pii.spans_of(t) if not base]
    assert one("wire to GB82 WEST 1234 5698 7654 32 AND wait") == [("iban", "GB82 WEST 1234 5698 7654 32")]
    assert one("wire to GB83 WEST 1234 5698 7654 32") == []
    assert one("batch 12 4111 1111 1111 1111 99 done") == [("card", "4111 1111 1111 1111")]
    assert one("batch 12 4111 1111 1111 1112 99 done") == []
    assert one("order no 12 4111 1111 1111 1111 99") == []  # 0.7 - 0.3
    assert one("call 555-123-4567 now") == [("phone", "555-123-4567")]
    assert one("lot 555-123-4567 now") == []
    assert one("her ssn is 123-45-6789") == [("ssn", "123-45-6789")]
    assert one("code 123-45-6789") == one("her ssn is 666-45-6789") == one("her ssn is 123-00-6789") == []
    assert one("+1 (988) 555-2485 2020 1234 5678") == [("phone", "+1 (988) 555-2485")]
    assert shown("+1 (988) 555-2485") == ["phone:0:17"]  # the base span is not proposed again


def test_luhn_and_mod97():
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112") and pii.luhn("0")
    assert pii.mod97("DE89370400440532013000") and not pii.mod97("DE88370400440532013000")


def test_query_equals_brute_force(spark, make, nasty, tmp_path):
    text = "é mail a.b@c.de, 10.0.0.255 and 300.1.1.1; 4111-1111-1111-1111 +49 (30) 1234567 x@y"
    rows = [*nasty, (20, text), (21, text * 50), (22, "4111 1111 1111 1111 12")]
    make(rows).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    out = pii.op13_pii(spark, str(tmp_path))
    assert [t for _, t in out.dtypes] == ["bigint"] * 5 + ["string"] * 2

    def want(i, t):
        base = plain(t or "")
        return (i, *(sum(s.startswith(f"{k}:") for s in base) for k in pii.BASE), hashlib.sha256(",".join(base).encode()).hexdigest(), ",".join(shown(t or "")))

    assert sorted(map(tuple, out.collect()), key=repr) == sorted((want(*r) for r in rows), key=repr)


def test_operator_keeps_columns_and_redacts(spark, make, nasty):
    docs = make([*nasty, (20, "é to a.b@c.de or 10.0.0.1!")])
    found = pii.personal(docs, redact=True)
    assert found.columns == [*(c for c in docs.columns if c != "spans"), "spans"]
    rows = {r.doc_id: r for r in found.collect()}
    assert rows[20].text == "é to [email] or [ip]!" and [(s.kind, s.start, s.end, s.base) for s in rows[20].spans] == [("email", 5, 13, True), ("ip", 17, 25, True)]
    assert rows[1].text is None and rows[1].spans == [] and rows[4].text == "one two three"
    assert pii.personal(make([])).collect() == []
