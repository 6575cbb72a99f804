"""Text, digest and identifier columns."""

from __future__ import annotations

import unicodedata
import uuid

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Fixed value: the namespace of record ids.
RECORD_NAMESPACE = uuid.UUID("6f6cf1ee-6a5f-5f2a-9c1e-7f0f1a2b3c4d")
#: Rows that a Python worker is handed at once: a batch of long texts stays small.
BATCH_ROWS = 1000
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
UNIT, RECORD_SEPARATOR = "\x1f", "\x1e"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Without white space, as Unicode has it, at either end."""
    return F.regexp_replace(col(c), r"(?U)^\s+|\s+$", "")


def is_blank(c: Column | str) -> Column:
    return ~col(c).rlike(r"(?U)\S")


def keyed_hash(*parts: Column | str | int) -> Column:
    """60 bits of an MD5 over the parts joined by slashes: the same in any partitioning."""
    text = F.concat_ws("/", *(F.lit(str(p)) if isinstance(p, int) else (col(p) if isinstance(p, Column) else F.lit(p)).cast("string") for p in parts))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def record_id(run_id: Column | str, index: Column | str, namespace: uuid.UUID = RECORD_NAMESPACE) -> Column:
    """UUIDv5 of ``run_id/index``; an error for a negative index."""
    i = col(index)
    name = F.concat_ws("/", col(run_id), F.when(i >= 0, i.cast("string")).otherwise(F.raise_error(F.lit("record index is negative"))))
    h = F.sha1(F.concat(F.unhex(F.lit(namespace.hex)), F.encode(name, "UTF-8")))
    variant = F.substring(F.lit("89ab"), (F.conv(F.substring(h, 17, 1), 16, 10).cast("int") % 4) + 1, F.lit(1))
    return F.concat(F.substring(h, 1, 8), F.lit("-"), F.substring(h, 9, 4), F.lit("-5"), F.substring(h, 14, 3), F.lit("-"), variant, F.substring(h, 18, 3), F.lit("-"), F.substring(h, 21, 12))


@F.pandas_udf(StringType())
def _nfc(s: pd.Series) -> pd.Series:
    return s.map(lambda x: x if x is None or x.isascii() else unicodedata.normalize("NFC", x))


def nfc(c: Column | str) -> Column:
    """Unicode NFC.  Spark has no built-in form of it, so Python gets the texts, in batches
    of ``BATCH_ROWS`` where the session has its default."""
    spark = SparkSession.getActiveSession()
    if spark and spark.conf.get(_BATCH) == "10000":
        spark.conf.set(_BATCH, BATCH_ROWS)
    return _nfc(col(c))


def content_fingerprint(turns: Column | str, role: str = "role", content: str = "content") -> Column:
    """SHA-256 of the turns' roles and stripped texts in NFC.  Normal forms are made of
    the joined turns, and only where a character is not ASCII: separators have one form."""
    parts = F.transform(col(turns), lambda t: F.concat(t[role], F.lit(UNIT), F.regexp_replace(t[content], r"(?U)^\s+|\s+$", "")))
    return F.sha2(nfc(F.array_join(parts, RECORD_SEPARATOR)), 256)


def squeezed_fingerprint(turns: Column | str, role: str = "role", content: str = "content") -> Column:
    """The same with every run of white space taken for one blank."""
    parts = F.transform(col(turns), lambda t: F.concat(t[role], F.lit(UNIT), F.regexp_replace(F.regexp_replace(t[content], r"(?U)^\s+|\s+$", ""), r"(?U)\s+", " ")))
    return F.sha2(nfc(F.array_join(parts, RECORD_SEPARATOR)), 256)


def new_run_id() -> str:
    """A fresh id, drawn on the driver once: a plan that is run again must not draw anew."""
    return str(uuid.uuid4())


def duration(seconds: float) -> str:
    """Like 45s, 1m12s or 2h05m."""
    s = int(seconds)
    if s < 60:
        return f"{s}s"
    return f"{s // 60}m{s % 60:02d}s" if s < 3600 else f"{s // 3600}h{s % 3600 // 60:02d}m"


def numbered_turns(turns: Column | str, role: str = "role", content: str = "content") -> Column:
    """Turns as a judge reads them: a numbered paragraph each."""
    return F.array_join(F.transform(col(turns), lambda t, i: F.concat(F.lit("["), i.cast("string"), F.lit("] "), t[role], F.lit(": "), t[content])), "\n\n")


def generator_prompt(document: str) -> Column:
    """What a generator is asked for a slot: the document, then a line per attribute."""
    names = ("category", "priority", "channel", "resolution_status", "subdomain", "turn_count")
    return F.concat_ws("\n", F.lit(document), *(F.concat(F.lit(f"{n}="), F.col(n).cast("string")) for n in names))


def requested_turns(prompt: Column | str) -> Column:
    """The turn count that a prompt asks for, null without one."""
    found = F.regexp_extract(col(prompt), r"turn_count=(\d+)", 1)
    return F.when(found != "", found.cast("int"))


def value_fingerprint(category: Column | str, value: Column | str) -> Column:
    """What an approval remembers of a value instead of the value."""
    return F.sha2(F.concat(col(category), F.lit(":"), F.lower(strip(value))), 256)


def shape(value: Column | str) -> Column:
    """Length and numbers of digits, letters and others, without any of them."""
    v = strip(value)
    digits, letters = F.length(F.regexp_replace(v, r"[^\p{Nd}]", "")), F.length(F.regexp_replace(v, r"[^\p{L}]", ""))
    other = F.length(v) - digits - letters
    parts = F.concat_ws(" ", *(F.when(n > 0, F.concat(n.cast("string"), F.lit(k))) for n, k in ((digits, "d"), (letters, "a"), (other, "o"))))
    return F.when(v == "", F.lit("")).otherwise(F.concat(F.lit("<"), F.length(v).cast("string"), F.lit(" chars: "), parts, F.lit(">")))


def mask(category: Column | str, value: Column | str) -> Column:
    """A value made unreadable: of an email the domain stays, of a card the first
    six digits, of a phone all but the last four; otherwise only its shape."""
    v, kind = strip(value), col(category)
    digits = F.regexp_replace(v, r"[^0-9]", "")
    local, n = F.substring_index(v, "@", 1), F.length(digits)
    dots = lambda k: F.repeat(F.lit("•"), k)
    return (
        F.when(v == "", F.lit(""))
        .when((kind == "EMAIL") & v.contains("@"), F.concat(dots(F.least(F.length(local), F.lit(6))), F.lit("@"), F.substring_index(v, "@", -1)))
        .when((kind == "CREDIT_CARD") & (n >= 6), F.concat(F.substring(digits, 1, 6), dots(n - 6)))
        .when((kind == "PHONE") & (n > 4), F.concat(digits.substr(F.lit(1), n - 4), dots(F.lit(4))))
        .otherwise(shape(v))
    )
