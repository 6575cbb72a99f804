"""Spans against plain regular expressions, and the validators."""

import re

from hypothesis import given, settings
from hypothesis import strategies as st

from loomspan.llm import pii

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain(text):
    out = []
    for kind, pattern in BASE.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            ok = {
                "email": True, "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else True,
                "card": 14 <= len(digits) <= 19 and pii.luhn(digits), "phone": 10 <= len(digits) <= 15,
            }[kind]
            if ok:
                out.append((kind, m.start(), m.end()))
    return sorted(out, key=lambda s: (s[1], list(BASE).index(s[0])))


@settings(max_examples=1500, deadline=None)
@given(st.text(alphabet="a.@+-0123456789 %(é", max_size=60))
def test_base_spans_equal_plain_patterns(text):
    assert [s[:3] for s in pii.find_spans(text) if s[0] in BASE] == plain(text)


def test_known_values():
    text = "Call +1 (212) 867-5309, card 4111 1111 1111 1111, é a@b.co, host 10.0.0.256 and 10.0.0.25, IBAN GB82 WEST 1234 5698 7654 32, social 123-45-6789"
    kinds = [s[0] for s in pii.find_spans(text)]
    assert kinds == ["phone", "card", "email", "ip", "iban", "ssn"]
    assert pii.redact("write a@b.co now") == "write [email] now"
    assert not any(s[0] == "ssn" for s in pii.find_spans("order 123-45-6789"))


def test_long_runs_are_linear():
    for c in ("a", "1", "1.", "+1", "a@", "-", "1 "):
        pii.find_spans(c * 200_000)


def test_nulls_empty_and_extra_columns(spark):
    df = spark.createDataFrame([(1, None, "x"), (None, "", "y"), (2, "a@b.co", "z"), (2, "a@b.co", "z")], "doc_id long, text string, spans string")
    got = sorted(((r["doc_id"] is None, r["doc_id"] or 0, r["n_email"], r["spans"]) for r in pii.span_digest(df).collect()))
    assert got == [(False, 1, 0, ""), (False, 2, 1, "email:0:6"), (False, 2, 1, "email:0:6"), (True, 0, 0, "")]
    assert pii.span_digest(df.limit(0)).count() == 0
    assert {len(r["spans"]) for r in pii.pii_spans(df).collect()} == {0, 1}
