"""Personal data: expressions propose spans, checksums confirm them, words nearby adjust their score.

Four kinds are matched by fixed expressions and kept as they are ("base" spans,
score 1): e-mail and IP addresses, card numbers (Luhn) and international phone
numbers. A second set of proposals adds what these miss: card numbers beside
other numbers, phone numbers beside other numbers or without a country, bank
accounts (IBAN, modulo 97) and social security numbers. Each has a score by its
form, raised or lowered by words in the WINDOW characters before it, and stays if
it reaches BAR and overlaps no span that was found before it.

The expressions take linear time in texts of any kind: none starts anew within
a run of characters in which it has failed.

* null or empty text: no spans. Very long texts: whole texts are searched, one
  at a time; a task holds a slice of SLICE_BYTES of texts or a single longer one.
* Ties (spans that begin at one place) are ordered by kind, as listed in KINDS.
  Repeated rows: each has its own result. Null doc_id: kept.
* An empty table: no rows. Extra columns stay; one named like a result gives way.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import flat, read, slices

KINDS = ("email", "ip", "card", "phone", "iban", "ssn")
BASE = KINDS[:4]
#: Characters before a proposal whose words count, and the score from which it stays.
WINDOW, BAR = 40, 0.6

DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9]++(?:[ -][0-9]++)*+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

CARD_GROUPS = re.compile(r"(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{4}|[0-9]{4}([ -])[0-9]{6}\2[0-9]{5})(?![0-9])")
PHONE_GROUPS = re.compile(r"\+[0-9]{1,3}[ .-]?\(?[0-9]{2,4}\)?(?:[ .-][0-9]{2,4}){1,4}(?![0-9])")
LAST_GROUP = re.compile(r"[ .-][0-9]+\Z")
PHONE_PLAIN = re.compile(r"(?<![0-9A-Za-z+.-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9])")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
SSN = re.compile(r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])")

#: Words that raise (first) or lower (second) the score of a kind.
NEAR = {
    "card": (re.compile(r"\b(?:card|credit|debit|visa|mastercard|amex|payment|pay)\b"), re.compile(r"\b(?:order|isbn|ean|serial|tracking|invoice|barcode)\b")),
    "phone": (re.compile(r"\b(?:phone|tel|telephone|call|fax|mobile|cell|contact|dial)\b"), re.compile(r"\b(?:order|isbn|serial|version|part|invoice|page)\b")),
    "iban": (re.compile(r"\b(?:iban|account|bank|transfer|bic|swift)\b"), re.compile(r"\b(?:serial|part|model)\b")),
    "ssn": (re.compile(r"\b(?:ssn|social|security)\b"), re.compile(r"\b(?:order|part|serial|invoice|phone|date)\b")),
}
RAISE, LOWER = 0.3, 0.3

Span = tuple[int, int, int, float, bool]  # kind, start, end, score, whether a base span


def luhn(digits: str) -> bool:
    """Whether the weighted sum of the digits, every second one from the right doubled, is a multiple of 10."""
    doubled = sum(d * 2 - 9 * (d > 4) for d in map(int, digits[-2::-2]))
    return (doubled + sum(map(int, digits[::-2]))) % 10 == 0


def mod97(account: str) -> bool:
    """Whether an account number with its first four characters moved to the end, letters as 10 to 35, is 1 modulo 97."""
    return int("".join(str(int(c, 36)) for c in account[4:] + account[:4])) % 97 == 1


def digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """A domain by expression; its local part is what of LOCAL stands before it, back to the last match."""
    done = 0
    for m in DOMAIN.finditer(text):
        before = text[done : m.start()]
        n = len(before) - len(before.rstrip(LOCAL))
        done = m.start() + 1
        if n:
            yield m.start() - n, m.end()
            done = m.end()


def small_parts(ip: str) -> bool:
    return all(len(p) <= 3 and int(p) <= 255 for p in (p.lstrip("0") or "0" for p in ip.split(".")))


def base_spans(text: str, numbers: bool = True) -> Iterator[Span]:
    """Spans of the four base kinds; numbers: whether to look at kinds that need digits."""
    if "@" in text:
        yield from ((0, a, b, 1.0, True) for a, b in emails(text))
    if not numbers:
        return
    yield from ((1, m.start(), m.end(), 1.0, True) for m in IP.finditer(text) if small_parts(m.group()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 12:
            d = digits(m.group())
            if 12 <= len(d) <= 19 and luhn(d):
                yield 2, m.start(), m.end(), 1.0, True
    if "+" in text:
        yield from ((3, m.start(), m.end(), 1.0, True) for m in PHONE.finditer(text) if 9 <= len(digits(m.group())) <= 15)


def proposals(text: str) -> Iterator[Span]:
    """Further spans that passed their checks, with the score of their form, the surest kinds first."""
    for m in IBAN.finditer(text):
        s = m.group()
        while len(s) >= 15 and not mod97(s.replace(" ", "")):
            s = s.rpartition(" ")[0]  # a word in capitals may follow
        if len(s.replace(" ", "")) >= 15:
            yield 4, m.start(), m.start() + len(s), 0.8, False
    for m in CARD_GROUPS.finditer(text):
        d = digits(m.group())
        if d[0] in "23456" and luhn(d):
            yield 2, m.start(), m.end(), 0.7, False
    for m in PHONE_GROUPS.finditer(text) if "+" in text else ():
        s = m.group()
        most = 11 if re.match(r"\+1(?![0-9])", s) else 15
        while len(digits(s)) > most:
            s = LAST_GROUP.sub("", s)  # other numbers may follow
        if len(digits(s)) >= 9:
            yield 3, m.start(), m.start() + len(s), 0.7, False
    for m in SSN.finditer(text):
        yield 5, m.start(), m.end(), 0.4, False
    for m in PHONE_PLAIN.finditer(text):
        yield 3, m.start(), m.end(), 0.6 if m.group()[0] == "(" else 0.4, False


def adjusted(text: str, span: Span) -> float:
    kind, start, _, score, _ = span
    before = text[max(0, start - WINDOW) : start].lower()
    more, less = NEAR[KINDS[kind]]
    return score + RAISE * bool(more.search(before)) - LOWER * bool(less.search(before))


def spans_of(text: str, numbers: bool = True) -> list[Span]:
    """All spans of a text by start, then kind: base ones, and proposals that reach BAR and overlap none before them."""
    found = list(base_spans(text, numbers))
    if numbers:
        starts, taken = {}, sorted((a, b) for _, a, b, *_ in found)
        # Overlaps are looked up by blocks of places, so that many spans cost no more than a few each.
        for a, b in taken:
            for k in range(a >> 6, (b - 1 >> 6) + 1):
                starts.setdefault(k, []).append((a, b))
        for s in proposals(text):
            _, a, b, *_ = s
            blocks = range(a >> 6, (b - 1 >> 6) + 1)
            if any(x < b and a < y for k in blocks for x, y in starts.get(k, ())):
                continue
            score = adjusted(text, s)
            if score >= BAR:
                found.append((s[0], a, b, min(score, 1.0), False))
                for k in blocks:
                    starts.setdefault(k, []).append((a, b))
    return sorted(found, key=lambda s: (s[1], s[0]))


SPAN = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("score", T.DoubleType()), T.StructField("base", T.BooleanType())]))
_SPAN = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64()), ("base", pa.bool_())]))
_NUMBERS = re.compile(rb"[0-9]")


def without(text: str, spans: list[Span]) -> str:
    """text with its spans replaced by their kinds in brackets; one that begins within another gives way."""
    parts, done = [], 0
    for k, a, b, *_ in spans:
        if a >= done:
            parts += [text[done:a], f"[{KINDS[k]}]"]
            done = b
    return "".join([*parts, text[done:]])


def personal(docs: DataFrame, redact: bool = False) -> DataFrame:
    """docs with `spans`: array<struct<kind, start, end, score, base>> in code points, end exclusive.

    redact: replace the spans in text by their kinds; spans stay those of the text as it was.
    """
    docs = docs.drop("spans")
    names = docs.columns
    at = names.index("text")
    out_type = T.StructType([*(T.StructField(f"c{i}", f.dataType) for i, f in enumerate(docs.schema)), T.StructField("spans", SPAN)])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, f"c{at}"):
            data, offsets = flat(b.column(at))
            rows, changed = [], {}
            for i, (a, z) in enumerate(itertools.pairwise(offsets.tolist())):
                raw = data[a:z].tobytes()
                numbers = bool(_NUMBERS.search(raw))
                text = raw.decode() if numbers or b"@" in raw else ""
                found = spans_of(text, numbers)
                if redact and found:
                    changed[i] = without(text, found)
                rows.append([{"kind": KINDS[k], "start": s, "end": e, "score": score, "base": base} for k, s, e, score, base in found])
            columns = list(b.columns)
            if changed:
                columns[at] = pa.array([changed.get(i, x) for i, x in enumerate(columns[at].to_pylist())], columns[at].type)
            yield pa.RecordBatch.from_arrays([*columns, pa.array(rows, _SPAN)], out_type.names)

    return docs.toDF(*(f"c{i}" for i in range(len(names)))).mapInArrow(find, out_type).toDF(*names, "spans")


def listed(spans: Column) -> Column:
    """kind:start:end of spans, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op13_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = personal(read(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "spans")
    base = F.filter("spans", lambda s: s["base"])
    count = lambda k: F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == k))).cast("long").alias(f"n_{k}")
    return found.select("doc_id", *map(count, BASE), F.sha2(F.encode(listed(base), "UTF-8"), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))
