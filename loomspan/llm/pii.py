"""Personal data: patterns propose spans, checksums confirm, context adjusts.

Three steps per text.  (1) Regular expressions propose spans of each kind,
leftmost and non-overlapping within a kind.  (2) Validators confirm: octet range
for addresses, Luhn for cards, mod-97 for IBANs, digit counts for phones, the
issued ranges for social security numbers; a proposal that fails is dropped.
(3) Words near the span raise or lower a score between 0 and 1.  The kinds
``email ip card phone`` are kept at any score; the kinds that the method adds,
``iban`` and ``ssn``, need ``THRESHOLD``.

Patterns are anchored so that each is linear in the text even on a text made of
one run of its characters.  Offsets are code points, the end exclusive.

Defined results: a null or empty text has no spans and keeps its row; repeated
rows are each scanned; other columns are ignored; an empty table gives an empty
result; a null id is passed through.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

KINDS = ("email", "ip", "card", "phone", "iban", "ssn")
BASE_KINDS = KINDS[:4]
THRESHOLD = 0.5
#: Code points on either side of a span in which context words count.
CONTEXT = 40

_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
_SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_DIGIT = re.compile(r"[0-9]")

_WORDS_NEAR = {
    "email": ("mail", "email", "contact", "write", "address"),
    "ip": ("ip", "host", "server", "login", "address"),
    "card": ("card", "visa", "credit", "payment", "karte", "carte", "tarjeta"),
    "phone": ("phone", "call", "tel", "telephone", "mobile", "telefon", "fax"),
    "iban": ("iban", "bank", "account", "transfer", "konto", "compte", "cuenta"),
    "ssn": ("ssn", "social", "security", "taxpayer"),
}
_WORDS_AGAINST = ("order", "invoice", "version", "serial", "sample", "isbn", "ticket")
_PRIOR = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.9, "ssn": 0.3}
_WORD = re.compile(r"[^\W\d_]+")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = 2 * d - 9 * (d > 4)
        total += d
    return total % 10 == 0


def mod97(iban: str) -> bool:
    """The check of ISO 13616 on an IBAN without spaces."""
    moved = iban[4:] + iban[:4]
    return 15 <= len(iban) <= 34 and int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """An @ anchors each try: the run before it back to the last match, and the
    labels after it."""
    at, done = text.find("@"), 0
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at)):
            yield start, m.end()
            done = m.end()
            at = text.find("@", done)
        else:
            # a run with a failed @ behind it is never looked at again
            done = at + 1
            at = text.find("@", at + 1)


def _only_digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def _small_octet(s: str) -> bool:
    s = s.lstrip("0")
    return len(s) < 3 or (len(s) == 3 and s <= "255")


def _score(kind: str, text: str, start: int, end: int) -> float:
    near = {w.lower() for w in _WORD.findall(text[max(0, start - CONTEXT) : start] + " " + text[end : end + CONTEXT])}
    score = _PRIOR[kind] + 0.3 * bool(near.intersection(_WORDS_NEAR[kind])) - 0.3 * bool(near.intersection(_WORDS_AGAINST))
    return round(min(1.0, max(0.0, score)), 3)


def find_spans(text: str | None) -> list[tuple[str, int, int, float]]:
    """All (kind, start, end, score) of a text by start, then kind as listed."""
    if not text:
        return []
    found: list[tuple[int, int, int]] = []
    if "@" in text:
        found += [(s, 0, e) for s, e in _emails(text)]
    if _DIGIT.search(text):
        if "." in text:
            found += [(m.start(), 1, m.end()) for m in _IP.finditer(text) if all(map(_small_octet, m[0].split(".")))]
        for m in _CARD.finditer(text):
            digits = _only_digits(m[0]) if m.end() - m.start() >= 14 else ""
            if 14 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), 2, m.end()))
        if "+" in text:
            found += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text) if 10 <= len(_only_digits(m[0])) <= 15]
        found += [(m.start(), 4, m.end()) for m in _IBAN.finditer(text) if mod97(m[0].replace(" ", ""))]
        if "-" in text:
            found += [(m.start(), 5, m.end()) for m in _SSN.finditer(text) if m[0][:3] not in ("000", "666") and m[0] < "9" and m[0][4:6] != "00" and m[0][7:] != "0000"]
    out = []
    for start, k, end in sorted(found):
        score = _score(KINDS[k], text, start, end)
        if KINDS[k] in BASE_KINDS or score >= THRESHOLD:
            out.append((KINDS[k], start, end, score))
    return out


SPAN_TYPE = "array<struct<kind:string,start:int,end:int,score:double>>"


def pii_spans(df: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row per input row: the id and ``spans``, an array of kind, start, end, score."""
    id_type = df.schema[id_col].dataType.simpleString()
    arrow_spans = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            spans = [[dict(zip(("kind", "start", "end", "score"), s)) for s in find_spans(t.as_py())] for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(spans, arrow_spans)], ["id", "spans"])

    return df.select(df[id_col].alias("id"), df[text_col].alias("text")).mapInArrow(scan, f"id {id_type}, spans {SPAN_TYPE}").withColumnRenamed("id", id_col)


def redact(text: str | None) -> str | None:
    """The text with every span replaced by its kind in brackets; of overlapping
    spans the earlier, then the longer is taken."""
    if not text:
        return text
    out, at = [], 0
    for kind, start, end, _ in sorted(find_spans(text), key=lambda s: (s[1], -s[2])):
        if start >= at:
            out += [text[at:start], f"[{kind}]"]
            at = end
    return "".join([*out, text[at:]])


def span_digest(df: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """The digest columns of ``pii_spans``: counts per base kind, the hash of the
    base spans, all spans as text, the highest score and the redacted length."""
    id_type = df.schema[id_col].dataType.simpleString()
    names = ["id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_added", "max_score"]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for t in b.column(1):
                spans = find_spans(t.as_py())
                base = [s for s in spans if s[0] in BASE_KINDS]
                join = lambda x: ",".join(f"{k}:{s}:{e}" for k, s, e, _ in x)
                rows.append((*(sum(s[0] == k for s in base) for k in BASE_KINDS), hashlib.sha256(join(base).encode()).hexdigest(), join(spans), len(spans) - len(base), max((s[3] for s in spans), default=0.0)))
            columns = list(zip(*rows)) if rows else [()] * 8
            kinds = [pa.int64()] * 4 + [pa.string(), pa.string(), pa.int64(), pa.float64()]
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds))], names)

    schema = f"id {id_type}, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long, max_score double"
    return df.select(df[id_col].alias("id"), df[text_col].alias("text")).mapInArrow(scan, schema).withColumnRenamed("id", id_col)
