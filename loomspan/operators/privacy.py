"""Detection of personal data in fields: matches, status, masking, approvals.

Detection is one array column per row, made by built-in expressions; matches are
exploded once.  A custom detector is a function from a text column to an array of
structs ``category, value, detector``, or a finder in Python, over Arrow batches.  An
expression that fails fails its query; a finder that fails at a text makes that text a
problem of its own.  Either way a text that was not scanned is never taken for clean.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomspan import schema
from loomspan.functions.text import mask, value_fingerprint

#: Within the common subset of Java and RE2 expressions; first group is the value.
PATTERNS = {
    "EMAIL": r"([A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+)",
    "PHONE": r"((?:\+?1[-. ]?)?(?:\([0-9]{3}\) ?|\b[0-9]{3}[-. ]?)[0-9]{3}[-. ]?[0-9]{4})\b",
    "CREDIT_CARD": r"\b([0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{3,4})\b",
    "US_SSN": r"\b([0-9]{3}-[0-9]{2}-[0-9]{4}|[0-9]{9})\b",
    "IP_ADDRESS": r"\b([0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3})\b",
}

#: The same matches in time linear in the text: a try begins where a run of an address's
#: characters does, or where the last match ended, and gives nothing back.
LINEAR = {"EMAIL": r"(?:\G|(?<![A-Za-z0-9._%+-]))([A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+)"}

# Top-level names and domains, cards and numbers kept for examples.
RESERVED_TLDS = (".test", ".example", ".invalid", ".localhost")
RESERVED_DOMAINS = ("example.com", "example.net", "example.org")
RESERVED_PHONE = r"^(?:\+?1[-. ]?)?\(?[0-9]{3}\)?[-. ]?555[-. ]?01[0-9]{2}$"
RESERVED_CARDS = (
    "4111111111111111",
    "4012888888881881",
    "4222222222222",
    "5555555555554444",
    "5105105105105100",
    "378282246310005",
    "371449635398431",
    "6011111111111117",
    "3530111333300000",
)

# What nothing here detects, said in every report.
DECLARED_GAPS = (
    "non-US government identifiers",
    "postal code",
    "full postal address",
    "bank account number (IBAN)",
    "person name",
)

#: One made-up value per blocking category, which every detector set must find.
CANARIES = {"EMAIL": "mira.okafor@northwindow.io", "PHONE": "(646) 738-2091", "CREDIT_CARD": "4539 7281 0046 3317", "US_SSN": "531-08-4472"}
#: Sentences in which nothing must be found.
NOT_PERSONAL = ("parcel 7731 left the depot at noon", "see chapter 12, lines 40-52", "the fee rose by 3.5 percent in 2019")

Detector = Callable[[Column], Column]
MATCH = "array<struct<category:string,value:string,detector:string>>"


def _labelled(category: str) -> Callable[[Column], Column]:
    return lambda v: F.struct(F.lit(category).alias("category"), v.alias("value"), F.lit("pattern").alias("detector"))


def pattern_detector(text: Column, only: str | None = None) -> Column:
    """Matches of all patterns, by category in the order listed, or those of one category.
    Card digits are blanked before phones and numbers are looked for, so a card is not
    one too."""
    found, rest = [], text
    for category in ("EMAIL", "CREDIT_CARD", "PHONE", "US_SSN", "IP_ADDRESS"):
        if only and category != only:
            if category == "CREDIT_CARD":
                rest = F.regexp_replace(rest, PATTERNS[category], " # ")
            continue
        values = F.regexp_extract_all(rest, F.lit(LINEAR.get(category, PATTERNS[category])), F.lit(1))
        if category == "EMAIL":
            values = F.when(rest.contains("@"), values).otherwise(F.array().cast("array<string>"))
        found.append(F.transform(values, _labelled(category)))
        if category == "CREDIT_CARD":
            rest = F.regexp_replace(rest, PATTERNS[category], " # ")
    return F.concat(*found)


GUARDED = f"struct<found:{MATCH},problem:string>"
Finder = Callable[[str], Iterable[tuple[str, str]]]


def guarded(name: str, find: Finder) -> Callable[[Column], Column]:
    """A detector in Python, ``text -> (category, value) pairs``, over Arrow batches.  An
    error in one text is that text's ``problem`` and gives no matches; the job goes on."""

    @F.pandas_udf(GUARDED)
    def look(texts: pd.Series) -> pd.DataFrame:
        found, problems = [], []
        for text in texts:
            try:
                hits, problem = [{"category": c, "value": v, "detector": name} for c, v in find(text or "")], None
            except Exception as e:
                # the kind alone: a message may quote the text
                hits, problem = [], f"{name}: {type(e).__name__}"
            found.append(hits)
            problems.append(problem)
        return pd.DataFrame({"found": found, "problem": pd.Series(problems, dtype=object)})

    return look


class Detectors:
    """A set of detectors by name: expressions, which see a column, and finders in
    Python, which see a text and may fail at it.  Registering adds to the set."""

    def __init__(self, **detectors: Detector):
        self._by_name = detectors or {"pattern": pattern_detector}
        self._finders: dict[str, Callable[[Column], Column]] = {}

    def register(self, name: str, detector: Detector | None = None, *, finder: Finder | None = None) -> None:
        if name in self.names:
            raise ValueError(f"detector {name!r} is registered already")
        if (detector is None) == (finder is None):
            raise ValueError("a detector is an expression or a finder")
        if detector is not None:
            self._by_name[name] = detector
        else:
            self._finders[name] = guarded(name, finder)

    @property
    def names(self) -> list[str]:
        return [*self._by_name, *self._finders]

    def look(self, fields: DataFrame, text: str = "text") -> DataFrame:
        """Adds ``found``, the matches of all detectors, and ``problem``, which tells why
        a text was not scanned whole; then ``found`` is what the others saw."""
        clean = F.coalesce(F.col(text), F.lit(""))
        seen = fields
        for i, look in enumerate(self._finders.values()):
            seen = seen.withColumn(f"_look{i}", look(clean))
        looks = [F.col(f"_look{i}") for i in range(len(self._finders))]
        found = F.concat(*(d(clean) for d in self._by_name.values()), *(x["found"] for x in looks))
        problem = F.coalesce(*(x["problem"] for x in looks), F.lit(None).cast("string"))
        return seen.withColumn("found", found).withColumn("problem", problem).drop(*(f"_look{i}" for i in range(len(looks))))

    def probe(self, texts: DataFrame, text: str = "text") -> DataFrame:
        """One row: ``texts``, their number, and per blocking category the number of those
        that give its canary when that is set behind them.

        Of the patterns only the canary's own is looked for, as matches of the others
        never count; other detectors are asked as they are."""
        body = F.coalesce(F.col(text), F.lit(""))
        seen, hits = texts, []
        for i, (category, canary) in enumerate(CANARIES.items()):
            probed = F.concat(body, F.lit(" ; "), F.lit(canary))
            for k, look in enumerate(self._finders.values()):
                seen = seen.withColumn(f"_look{i}_{k}", look(probed))
            by_expression = (d(probed, category) if d is pattern_detector else d(probed) for d in self._by_name.values())
            found = F.concat(*by_expression, *(F.col(f"_look{i}_{k}.found") for k in range(len(self._finders))))
            hits.append(F.exists(found, lambda m: (m["category"] == category) & (m["value"] == canary)))  # noqa: B023
        # one pass over the texts counts all canaries
        return seen.agg(F.count(F.lit(1)).alias("texts"), *(F.count_if(h).alias(c) for c, h in zip(CANARIES, hits)))

    def missed(self, spark: SparkSession) -> list[str]:
        """Blocking categories whose canary is not found; an error is a miss."""
        rows = spark.createDataFrame(list(CANARIES.items()), "category string, text string")
        hit = self.look(rows).withColumn("hit", F.exists("found", lambda m: m["category"] == F.col("category")) & F.col("problem").isNull())
        return sorted(r["category"] for r in hit.where(~F.col("hit")).collect())


def record_fields(records: DataFrame) -> DataFrame:
    """``record_id, field, text`` of what is scanned: turns, and the scenario if any."""
    turns = records.select("record_id", F.posexplode("turns").alias("i", "t")).select("record_id", F.format_string("turns[%d].content", "i").alias("field"), F.col("t.content").alias("text"))
    return turns.unionByName(records.where("scenario <> ''").select("record_id", F.lit("scenario").alias("field"), F.col("scenario").alias("text")))


def matches(fields: DataFrame, detectors: Detectors | None = None, *keys: str) -> DataFrame:
    """A row per match.  Texts that a detector failed at give none here: they are
    ``failed_fields`` of what ``Detectors.look`` gives."""
    found = (detectors or Detectors()).look(fields)
    return found.select(*keys, F.explode("found").alias("m")).select(*keys, "m.category", "m.value", "m.detector")


def reserved(category: Column, value: Column) -> Column:
    """Whether a value lies in a range kept for examples.  Numbers of persons and
    addresses of machines have none."""
    domain = F.lower(F.substring_index(value, "@", -1))
    email = F.lit(False)
    for t in RESERVED_TLDS:
        email = email | domain.endswith(t)
    for d in RESERVED_DOMAINS:
        email = email | (domain == d) | domain.endswith(f".{d}")
    digits = F.regexp_replace(value, "[^0-9]", "")
    return F.when(category == "EMAIL", email).when(category == "PHONE", value.rlike(RESERVED_PHONE)).when(category == "CREDIT_CARD", digits.isin(*RESERVED_CARDS)).otherwise(F.lit(False))


def covered_types() -> list[str]:
    """Categories that a scan looks for: those that block and those that advise."""
    return sorted({*schema.BLOCKING, *schema.ADVISORY})


def failed_fields(fields: DataFrame, error: str = "problem") -> DataFrame:
    """Fields whose detector said that it failed, in the column ``error``: their record's
    reason is ``detector_error``, so that a text that was not scanned is never clean."""
    return fields.where(F.col(error).isNotNull()).select("record_id", "field", F.lit("detector_error").alias("reason")).distinct()


def approve(category: str, value: str, reason: str, approved_by: str, approved_on: str, spark: SparkSession, detectors: Detectors | None = None) -> dict[str, str]:
    """An approval, which holds a fingerprint in place of the value.  A reason that is
    blank or holds personal data itself is refused."""
    if category not in schema.PII_CATEGORIES:
        raise ValueError(f"unknown category {category!r}")
    if not reason.strip() or not approved_by.strip():
        raise ValueError("an approval needs a reason and a name")
    row = spark.createDataFrame([(reason, value)], "text string, value string")
    if not blocking(findings(matches(row, detectors))).isEmpty():
        raise ValueError("the reason holds personal data")
    fingerprint = row.select(value_fingerprint(F.lit(category), "value").alias("f")).first()["f"]
    return {"fingerprint": fingerprint, "category": category, "reason": reason.strip(), "approved_by": approved_by.strip(), "approved_on": approved_on}


def findings(found: DataFrame, approvals: DataFrame | None = None, fingerprint: Callable[[Column, Column], Column] = value_fingerprint) -> DataFrame:
    """Matches with their status and masked value; the value itself is dropped.

    Approvals are a table of ``fingerprint``; Spark broadcasts it while it is small.  They
    hold what ``fingerprint`` makes of category and value: a store kept under another
    scheme, say a keyed one, is read by handing that in."""
    f = found.withColumn("fingerprint", fingerprint(F.col("category"), F.col("value")))
    if approvals is not None:
        ok = approvals.select(F.col("fingerprint").alias("_f")).distinct().withColumn("_ok", F.lit(True))
        f = f.join(ok, F.col("fingerprint") == F.col("_f"), "left").drop("_f")
    else:
        f = f.withColumn("_ok", F.lit(None).cast("boolean"))
    status = (
        F.when(F.col("category").isin(*schema.ADVISORY), F.lit("advisory"))
        .when(reserved(F.col("category"), F.col("value")), F.lit("exempt_by_range"))
        .when(F.col("_ok").isNotNull(), F.lit("approved"))
        .otherwise(F.lit("blocking"))
    )
    return f.withColumn("status", status).withColumn("masked", mask("category", "value")).drop("value", "_ok")


def blocking(found: DataFrame) -> DataFrame:
    return found.where("status = 'blocking'")
