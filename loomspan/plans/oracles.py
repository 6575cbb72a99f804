"""DuckDB SQL whose rows the engine's queries must equal."""

from __future__ import annotations

_META = """meta AS (SELECT o_orderkey, c_mktsegment AS category, o_orderpriority AS priority, (o_orderkey % 4)::VARCHAR AS channel,
  CASE o_orderstatus WHEN 'F' THEN 'resolved' WHEN 'O' THEN 'unresolved' ELSE 'escalated' END AS resolution_status
  FROM orders JOIN customer ON o_custkey = c_custkey),
long AS (SELECT 'category' AS dimension, category AS member FROM meta UNION ALL SELECT 'priority', priority FROM meta
  UNION ALL SELECT 'channel', channel FROM meta UNION ALL SELECT 'resolution_status', resolution_status FROM meta),
have AS (SELECT dimension, member, count(*) AS n, count(*) / sum(count(*)) OVER (PARTITION BY dimension) AS share FROM long GROUP BY 1, 2)"""
_WANT = """want AS (SELECT * FROM (VALUES ('category', 'AUTOMOBILE', 0.25::DOUBLE), ('category', 'BUILDING', 0.20), ('category', 'FURNITURE', 0.20),
  ('category', 'HOUSEHOLD', 0.20), ('category', 'MACHINERY', 0.15), ('priority', '1-URGENT', 0.20), ('priority', '2-HIGH', 0.20),
  ('priority', '3-MEDIUM', 0.20), ('priority', '4-NOT SPECIFIED', 0.20), ('priority', '5-LOW', 0.20), ('channel', '0', 0.25),
  ('channel', '1', 0.25), ('channel', '2', 0.30), ('channel', '3', 0.20), ('resolution_status', 'resolved', 0.45),
  ('resolution_status', 'unresolved', 0.45), ('resolution_status', 'escalated', 0.10)) t(dimension, member, proportion))"""
_DRIFT = f"""WITH {_META}, {_WANT}, drift AS (SELECT coalesce(w.dimension, h.dimension) AS dimension, coalesce(w.member, h.member) AS member,
  coalesce(proportion, 0)::DOUBLE AS requested, coalesce(share, 0) AS achieved, abs(coalesce(share, 0) - coalesce(proportion, 0)::DOUBLE) * 100 AS drift_pp
  FROM want w FULL JOIN have h ON w.dimension = h.dimension AND w.member = h.member)"""
_APPORTION = """fl AS (SELECT *, floor(proportion * total)::BIGINT AS f, proportion * total - floor(proportion * total) AS rem FROM want, total),
counts AS (SELECT dimension, member, f + CASE WHEN row_number() OVER (PARTITION BY dimension ORDER BY rem DESC, member)
  <= total - sum(f) OVER (PARTITION BY dimension) THEN 1 ELSE 0 END AS n FROM fl)"""


def _key(*parts: str) -> str:
    return f"('0x' || substr(md5(concat_ws('/', {', '.join(parts)})), 1, 15))::BIGINT"


_TURNS = """t AS (SELECT conv_id, turn::INT AS turn, CASE role WHEN 'user' THEN 'customer' WHEN 'assistant' THEN 'agent' ELSE role END AS role, text FROM conversations)"""
_BLANK = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}]+"
_STRIPPED = f"regexp_replace(text, '^{_BLANK}|{_BLANK}$', '', 'g')"
_ATT = """att AS (SELECT event_id, user_id AS slot, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS attempt,
  CASE event_type WHEN 'error' THEN 'structural_invalid' WHEN 'signup' THEN 'privacy_finding' END AS reason, event_type AS model_id FROM events)"""
_SCORES = """s AS (SELECT l_orderkey, l_linenumber, l_discount * 10 AS judge, l_tax * 12.5 AS human, l_quantity / 50 AS fit FROM lineitem)"""

_EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"
_CARD = r"\b([0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{3,4})\b"
_PHONE = r"((?:\+?1[-. ]?)?(?:\([0-9]{3}\) ?|\b[0-9]{3}[-. ]?)[0-9]{3}[-. ]?[0-9]{4})\b"
_SSN = r"\b([0-9]{3}-[0-9]{2}-[0-9]{4}|[0-9]{9})\b"
_IP = r"\b([0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3})\b"


def _found(source: str, key: str) -> str:
    return rf"""src AS (SELECT {key}, text, regexp_replace(text, '{_CARD}', ' # ', 'g') AS rest FROM {source}),
m AS (SELECT {key}, 'EMAIL' AS category, unnest(regexp_extract_all(text, '({_EMAIL})', 1)) AS value FROM src
  UNION ALL SELECT {key}, 'CREDIT_CARD', unnest(regexp_extract_all(text, '{_CARD}', 1)) FROM src
  UNION ALL SELECT {key}, 'PHONE', unnest(regexp_extract_all(rest, '{_PHONE}', 1)) FROM src
  UNION ALL SELECT {key}, 'US_SSN', unnest(regexp_extract_all(rest, '{_SSN}', 1)) FROM src
  UNION ALL SELECT {key}, 'IP_ADDRESS', unnest(regexp_extract_all(rest, '{_IP}', 1)) FROM src)"""


_STATUS = r"""CASE WHEN category = 'IP_ADDRESS' THEN 'advisory'
  WHEN category = 'EMAIL' AND regexp_matches(lower(string_split(value, '@')[-1]), '(\.example|\.invalid|\.test|\.localhost|(^|\.)example\.(com|net|org))$') THEN 'exempt_by_range'
  WHEN category = 'PHONE' AND regexp_matches(value, '^(?:\+?1[-. ]?)?\(?[0-9]{3}\)?[-. ]?555[-. ]?01[0-9]{2}$') THEN 'exempt_by_range'
  WHEN category = 'CREDIT_CARD' AND regexp_replace(value, '[^0-9]', '', 'g') IN ('4111111111111111', '4012888888881881', '4222222222222', '5555555555554444',
    '5105105105105100', '378282246310005', '371449635398431', '6011111111111117', '3530111333300000') THEN 'exempt_by_range'
  ELSE 'blocking' END"""
_MASKED = """CASE WHEN category = 'EMAIL' THEN repeat('•', least(length(string_split(value, '@')[1]), 6)) || '@' || string_split(value, '@')[-1]
  WHEN category = 'CREDIT_CARD' THEN substr(dg, 1, 6) || repeat('•', length(dg) - 6)
  WHEN category = 'PHONE' THEN substr(dg, 1, length(dg) - 4) || '••••'
  ELSE '<' || length(value) || ' chars: ' || length(dg) || 'd' || CASE WHEN length(value) > length(dg) THEN ' ' || (length(value) - length(dg)) || 'o' ELSE '' END || '>' END"""
_FOUND = f"WITH {_found('documents', 'doc_id')}, f AS (SELECT *, {_STATUS} AS status, regexp_replace(value, '[^0-9]', '', 'g') AS dg FROM m)"

_VIOLATIONS = f"""{_TURNS}, x AS (SELECT *, row_number() OVER w - 1 AS k, lag(role) OVER w AS before FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)),
        r AS (SELECT conv_id, count(*) < 2 AS a, bool_or(k <> turn) AS b, bool_or(role NOT IN ('customer', 'agent')) AS c, min_by(role, k) <> 'customer' AS d,
          coalesce(bool_or(role = before), false) AS e, bool_or({_STRIPPED} = '') AS f FROM x GROUP BY conv_id),
        viol AS (SELECT conv_id::INT AS conv_id, unnest(list_filter([CASE WHEN a THEN 'too_few_turns' END, CASE WHEN b THEN 'turn_index' END, CASE WHEN c THEN 'role' END,
          CASE WHEN d THEN 'first_speaker' END, CASE WHEN e THEN 'alternation' END, CASE WHEN f THEN 'blank_turn' END, CASE WHEN conv_id % 2 = 1 THEN 'resolved_at_missing' END,
          CASE WHEN conv_id > 80 THEN 'coherence_score' END], lambda v: v IS NOT NULL)) AS violation FROM r)"""

ORACLES: dict[str, str] = {
    "composition_achieved": f"WITH {_META} SELECT * FROM have",
    "composition_grouping_sets": f"WITH {_META} SELECT dimension, member, n FROM have",
    "composition_drift": f"{_DRIFT} SELECT dimension, member, requested, round(achieved, 9) AS achieved, round(drift_pp, 6) AS drift_pp FROM drift",
    "composition_breaches": f"{_DRIFT} SELECT dimension, member, round(drift_pp, 6) AS drift_pp FROM drift WHERE abs(achieved - requested) > 2.0::DOUBLE / 100",
    "composition_worst_member": f"{_DRIFT} SELECT dimension, member, round(drift_pp, 6) AS drift_pp FROM drift ORDER BY drift.drift_pp DESC, dimension, member LIMIT 1",
    "composition_problems": """SELECT 'channel' AS dimension, '9' AS member, 'unknown member' AS problem
        UNION ALL SELECT 'channel', NULL, 'shares do not sum to 1'""",
    "drift_attribution": f"""WITH {_META}, {_WANT}, total AS (SELECT count(*) AS total FROM meta), {_APPORTION},
        asg AS (SELECT dimension, member, n / sum(n) OVER (PARTITION BY dimension) AS share FROM counts)
        SELECT w.dimension, w.member, round((a.share - proportion::DOUBLE) * 100, 4) AS apportionment_pp, round((h.share - a.share) * 100, 4) AS run_pp
        FROM want w JOIN asg a ON w.dimension = a.dimension AND w.member = a.member JOIN have h ON w.dimension = h.dimension AND w.member = h.member""",
    "apportion_largest_remainder": f"WITH {_META}, {_WANT}, total AS (SELECT count(*) AS total FROM meta), {_APPORTION} SELECT * FROM counts",
    "slot_pool_assignment": f"""WITH {_WANT}, total AS (SELECT count(*) AS total FROM orders), {_APPORTION},
        sp AS (SELECT *, coalesce(sum(n) OVER (PARTITION BY dimension ORDER BY member ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS lo FROM counts),
        pool AS (SELECT dimension, member, unnest(range(lo, (lo + n)::BIGINT)) AS item FROM sp)
        SELECT dimension, row_number() OVER (PARTITION BY dimension ORDER BY {_key("'7'", "'pool'", "dimension", "item::VARCHAR")}, item) - 1 AS position, member FROM pool""",
    "slot_plan": f"""WITH s AS (SELECT list(DISTINCT c_mktsegment ORDER BY c_mktsegment) AS names FROM customer), r AS (SELECT unnest(range((SELECT count(*) FROM orders))) AS p)
        SELECT p AS position, names[{_key("'7'", "p::VARCHAR", "'subdomain'")} % len(names) + 1] AS subdomain,
        ({_key("'7'", "p::VARCHAR", "'turns'")} % 9 + 4)::INT AS turn_count,
        epoch(TIMESTAMP '2026-01-01')::BIGINT - 180 * 86400 + {_key("'7'", "p::VARCHAR", "'created'")} % (180 * 86400) AS created_s,
        {_key("'7'", "p::VARCHAR", "'resolution'")} % (14 * 86400 - 3600 + 1) + 3600 AS resolution_s FROM r, s""",
    "seeded_sample": f"SELECT doc_id, source FROM documents ORDER BY {_key(chr(39) + '7' + chr(39), chr(39) + 'sample' + chr(39), 'doc_id::VARCHAR')}, doc_id LIMIT 25",
    "record_ids_uuid5": """WITH h AS (SELECT o_orderkey, sha1(unhex('6f6cf1ee6a5f5f2a9c1e7f0f1a2b3c4d') || encode('run-1/' || o_orderkey)) AS h FROM orders)
        SELECT o_orderkey, substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-'
          || substr('89ab', (('0x' || substr(h, 17, 1))::INT % 4 + 1)::INT, 1) || substr(h, 18, 3) || '-' || substr(h, 21, 12) AS record_id FROM h""",
    "structural_gate_reasons": f"""WITH {_TURNS}, r AS (SELECT conv_id, count(*) AS n, min_by(role, turn) AS first_role, bool_and(role IN ('customer', 'agent')) AS known,
          bool_or(trim(text, ' ' || chr(9) || chr(10) || chr(13)) = '') AS blank FROM t GROUP BY conv_id),
        a AS (SELECT conv_id, bool_or(same) AS same FROM (SELECT conv_id, role = lag(role) OVER (PARTITION BY conv_id ORDER BY turn) AS same FROM t) GROUP BY conv_id)
        SELECT r.conv_id, CASE WHEN r.conv_id % 17 = 0 THEN 'truncated' WHEN r.conv_id % 11 = 0 THEN 'not_json'
          WHEN r.conv_id % 13 = 0 OR n < 2 OR NOT known THEN 'shape' WHEN r.conv_id % 5 = 0 AND n <> 4 THEN 'turn_count'
          WHEN first_role <> 'customer' THEN 'first_speaker' WHEN coalesce(same, false) THEN 'alternation' WHEN blank THEN 'blank_turn' END AS reason
        FROM r JOIN a ON r.conv_id = a.conv_id""",
    "invariant_violations": f"WITH {_VIOLATIONS} SELECT conv_id, violation FROM viol",
    "validator_report": f"""WITH {_VIOLATIONS}, ids AS (SELECT DISTINCT conv_id FROM t), fp AS (SELECT conv_id, string_agg(role || chr(31) || regexp_replace({_STRIPPED}, '{_BLANK}', ' ', 'g'), chr(30) ORDER BY turn, role, text) AS fp FROM t GROUP BY 1)
        SELECT 'contract' AS gate, violation AS finding, count(*) AS n FROM viol GROUP BY 2
        UNION ALL SELECT 'version', 'unsupported_version', count(*) FROM ids WHERE conv_id % 9 = 0 HAVING count(*) > 0
        UNION ALL SELECT 'version', 'mixed_versions', 1 FROM ids HAVING count(DISTINCT conv_id % 9 = 0) > 1
        UNION ALL SELECT 'duplicates', 'duplicate_record_id', count(*) FROM (SELECT conv_id % 90 FROM ids GROUP BY 1 HAVING count(*) > 1) HAVING count(*) > 0
        UNION ALL SELECT 'duplicates', 'duplicate_content', count(*) FROM (SELECT row_number() OVER (PARTITION BY fp ORDER BY conv_id) AS k FROM fp) WHERE k > 1 HAVING count(*) > 0""",
    "turn_index_contiguity": f"""WITH {_TURNS}, x AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 = turn AS ok FROM t)
        SELECT conv_id, count(*) AS n, bool_and(ok) AS contiguous FROM x GROUP BY conv_id""",
    "role_alternation": f"""WITH {_TURNS}, x AS (SELECT *, role = lag(role) OVER (PARTITION BY conv_id ORDER BY turn) AS same FROM t)
        SELECT conv_id, count(*) FILTER (same) AS repeats, min_by(role, turn) AS first_role FROM x GROUP BY conv_id""",
    "content_fingerprints": f"""WITH {_TURNS} SELECT conv_id, sha256(string_agg(role || chr(31) || {_STRIPPED}, chr(30) ORDER BY turn)) AS fingerprint FROM t GROUP BY conv_id""",
    "nfc_fingerprints": f"SELECT doc_id, sha256(nfc_normalize({_STRIPPED})) AS fingerprint FROM documents",
    "duplicate_flags": f"SELECT doc_id, row_number() OVER (PARTITION BY sha256({_STRIPPED}) ORDER BY doc_id) > 1 AS is_duplicate FROM documents",
    "duplicate_groups": f"SELECT sha256({_STRIPPED}) AS fp, count(*) AS n, min(doc_id) AS kept FROM documents GROUP BY 1 HAVING count(*) > 1",
    "duplicate_count": f"SELECT count(*) AS n, count(DISTINCT {_STRIPPED}) AS n_unique, count(*) - count(DISTINCT {_STRIPPED}) AS duplicates FROM documents",
    "duplicate_record_ids": "SELECT conv_id, count(*) AS n FROM conversations GROUP BY 1 HAVING count(*) > 1",
    "pii_matches": f"{_FOUND} SELECT doc_id, category, value FROM f",
    "pii_findings_masked": f"{_FOUND} SELECT doc_id, category, status, {_MASKED} AS masked FROM f",
    "pii_status_counts": f"{_FOUND} SELECT category, status, count(*) AS n FROM f GROUP BY 1, 2",
    "pii_blocking_documents": f"{_FOUND} SELECT DISTINCT doc_id FROM f WHERE status = 'blocking'",
    "approved_suppression": f"""{_FOUND}, ok AS (SELECT DISTINCT value FROM m WHERE category = 'PHONE' AND doc_id % 3 = 0)
        SELECT category, CASE WHEN status = 'blocking' AND category = 'PHONE' AND value IN (SELECT value FROM ok) THEN 'approved' ELSE status END AS status, count(*) AS n FROM f GROUP BY 1, 2""",
    "scan_totals": "SELECT count(DISTINCT conv_id) AS records, count(*) + count(DISTINCT conv_id) AS fields FROM conversations",
    "floor_probe": f"""WITH c AS (SELECT * FROM (VALUES ('EMAIL', 'mira.okafor@northwindow.io'), ('PHONE', '(646) 738-2091'), ('CREDIT_CARD', '4539 7281 0046 3317'),
        ('US_SSN', '531-08-4472')) v(expected, canary)), probe AS (SELECT doc_id || ':' || expected AS k, coalesce(text, '') || ' ; ' || canary AS text FROM documents, c), {_found('probe', 'k')},
        hit AS (SELECT expected, count(DISTINCT k) AS hits FROM m JOIN c ON category = expected AND value = canary AND split_part(k, ':', 2) = expected GROUP BY 1)
        SELECT c.expected, (SELECT count(*) FROM documents) AS texts, coalesce(hits, 0) AS hits FROM c LEFT JOIN hit ON c.expected = hit.expected""",
    "reject_reason_tally": f"WITH {_ATT} SELECT reason, count(*) AS n FROM att WHERE reason IS NOT NULL GROUP BY 1",
    "discard_rates": f"""WITH {_ATT}, l AS (SELECT * FROM (VALUES ('privacy_finding', 0.005::DOUBLE), ('structural_invalid', 0.25)) v(reason, lim)),
        c AS (SELECT l.reason, lim, count(*) FILTER (att.reason = l.reason) AS n, count(*) AS generated FROM l, att GROUP BY 1, 2)
        SELECT reason, n, generated, round(n / generated, 9) AS rate, n / generated > lim AS over FROM c""",
    "rate_breaches": f"""WITH {_ATT}, l AS (SELECT * FROM (VALUES ('privacy_finding', 0.005::DOUBLE), ('structural_invalid', 0.25)) v(reason, lim)),
        c AS (SELECT l.reason, lim, count(*) FILTER (att.reason = l.reason) AS n, count(*) AS generated FROM l, att GROUP BY 1, 2)
        SELECT reason, n, lim::DOUBLE AS "limit" FROM c WHERE n / generated > lim""",
    "running_rate_first_breach": f"""WITH {_ATT}, r AS (SELECT slot % 16 AS run, event_id, count(*) OVER w AS seen,
          count(*) FILTER (reason = 'structural_invalid') OVER w AS hits FROM att WINDOW w AS (PARTITION BY slot % 16 ORDER BY event_id))
        SELECT run, min(event_id) AS first_over FROM r WHERE seen >= 20 AND hits / seen > 0.21::DOUBLE GROUP BY 1""",
    "consecutive_failures": f"""WITH {_ATT}, g AS (SELECT slot, reason, sum(CASE WHEN reason IS NULL THEN 1 ELSE 0 END) OVER (PARTITION BY slot ORDER BY event_id) AS g FROM att),
        c AS (SELECT slot, g, count(*) FILTER (reason IS NOT NULL) AS n FROM g GROUP BY 1, 2) SELECT slot, max(n) AS longest FROM c GROUP BY 1""",
    "first_accepted_attempt": f"""WITH {_ATT} SELECT slot, (min(attempt) FILTER (reason IS NULL AND attempt <= 3))::INT AS accepted, count(*) FILTER (attempt <= 3) AS tried FROM att GROUP BY 1""",
    "reconciliation": f"""WITH {_ATT} SELECT slot % 8 AS run, count(*) AS generated, count(reason) AS discarded, count(*) FILTER (reason IS NULL) AS written, true AS closes FROM att GROUP BY 1""",
    "quarantine_rows": f"WITH {_ATT} SELECT slot, attempt::INT AS attempt, event_id FROM att WHERE reason = 'privacy_finding'",
    "score_histogram": f"""WITH {_SCORES}, b AS (SELECT least(floor(judge / 0.05::DOUBLE)::INT, 19) AS i FROM s)
        SELECT printf('%.2f-%.2f', i * 0.05::DOUBLE, i * 0.05::DOUBLE + 0.05::DOUBLE) AS bucket, count(*) AS n FROM b GROUP BY i""",
    "score_summary_upper_median": f"""WITH {_SCORES}, o AS (SELECT judge, row_number() OVER (ORDER BY judge) - 1 AS k, count(*) OVER () AS n FROM s)
        SELECT any_value(n) AS n, min(judge) AS least, max(judge) AS largest, round(avg(judge), 9) AS mean, max(judge) FILTER (k = n // 2) AS median FROM o""",
    "score_spread": f"""WITH {_SCORES}, b AS (SELECT 'judge' AS side, judge AS v FROM s UNION ALL SELECT 'human', human FROM s),
        o AS (SELECT *, row_number() OVER (PARTITION BY side ORDER BY v) - 1 AS k, count(*) OVER (PARTITION BY side) AS c FROM b)
        SELECT side, count(*) AS n, count(DISTINCT round(v, 4)) AS n_distinct, min(v) AS least, max(v) AS largest, max(v) FILTER (k = c // 2) AS median FROM o GROUP BY side""",
    "gate_agreement": f"""WITH {_SCORES} SELECT count(*) FILTER ((judge >= 0.5) = (human >= 0.5)) AS agreed, count(*) FILTER (judge >= 0.5 AND human < 0.5) AS lenient,
        count(*) FILTER (judge < 0.5 AND human >= 0.5) AS strict, count(*) AS n, round(count(*) FILTER ((judge >= 0.5) = (human >= 0.5)) / count(*), 9) AS rate FROM s""",
    "spearman_avg_ranks": f"""WITH {_SCORES}, r AS (SELECT rank() OVER (ORDER BY judge) + (count(*) OVER (PARTITION BY judge) - 1) / 2 AS a,
        rank() OVER (ORDER BY human) + (count(*) OVER (PARTITION BY human) - 1) / 2 AS b FROM s) SELECT count(*) AS n, round(corr(a, b), 8) AS rho FROM r""",
    "criterion_gap": f"""WITH {_SCORES} SELECT 'single_issue' AS criterion, round(avg(judge - human), 4) AS gap FROM s
        UNION ALL SELECT 'metadata_fit', round(avg(fit - judge), 4) FROM s""",
    "coherence_gate": f"WITH {_SCORES} SELECT l_orderkey, l_linenumber FROM s WHERE judge >= 0.8::DOUBLE",
    "weighted_mean_score": f"WITH {_SCORES} SELECT l_orderkey, l_linenumber, round(0.6::DOUBLE * judge + 0.4::DOUBLE * fit, 9) AS score, NULL::VARCHAR AS problem FROM s",
    "fallback_tally": f"WITH {_ATT} SELECT model_id, count(*) AS n FROM att WHERE reason IS NULL AND model_id <> 'view' GROUP BY 1",
    "resume_prefix": """WITH w AS (SELECT DISTINCT l_orderkey, l_linenumber - 1 AS position FROM lineitem WHERE l_orderkey % 3 <> 0 OR l_linenumber <> 2),
        o AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY position) - 1 AS k FROM w)
        SELECT l_orderkey, count(*) FILTER (k = position) AS next_position FROM o GROUP BY 1""",
    "rerun_equivalence": f"""WITH {_META} SELECT o_orderkey, 'priority' AS "column" FROM meta WHERE o_orderkey % 50 = 0 AND o_orderkey % 7 <> 0""",
    "ordered_serialization": f"""WITH {_TURNS}, c AS (SELECT conv_id, string_agg('{{"content":' || to_json(text)::VARCHAR || ',"index":' || turn || ',"role":"' || role || '"}}', ',' ORDER BY turn, role, text) AS turns FROM t GROUP BY 1)
        SELECT conv_id::INT AS record_index, '{{"generation":{{"judge_model_id":"j","model_id":"m"}},"metadata":{{"category":"billing","channel":"email","created_at":"2026-01-01T00:00:00Z","priority":"low","resolution_status":"resolved","resolved_at":'
          || CASE WHEN conv_id % 2 = 0 THEN '"2026-01-02T00:00:00Z"' ELSE 'null' END || '}},"quality":{{"coherence_score":' || (conv_id / 80.0::DOUBLE)::VARCHAR || ',"rubric_id":"q"}},"record_id":"r' || conv_id % 90 || '","record_index":' || conv_id
          || ',"run_id":"run","scenario":"x","schema_version":"' || CASE WHEN conv_id % 9 = 0 THEN '2.0.0' ELSE '1.0.0' END || '","source_id":"s","subdomain":"d","turns":[' || turns || ']}}' AS line FROM c""",
}

ORACLES["traceability"] = "SELECT o_orderkey AS record_id, o_custkey AS run_id FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_nationkey < 12)"
ORACLES["retry_tally"] = """SELECT user_id % 8 AS run, CASE event_type WHEN 'error' THEN 'transport' ELSE 'timeout' END AS error_kind, count(*) AS n
FROM events WHERE event_type IN ('error', 'click') GROUP BY 1, 2"""
ORACLES["resume_truncate"] = f"WITH {_META} SELECT * FROM meta WHERE o_orderkey < 700"
ORACLES["resume_remaining"] = f"WITH {_META} SELECT category, count(*) AS n FROM meta WHERE o_orderkey >= 700 GROUP BY 1"
ORACLES["request_spacing"] = """WITH g AS (SELECT user_id, epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts) AS gap FROM events)
SELECT user_id, count(*) AS n, count(*) FILTER (WHERE gap < 3600000000) AS too_soon FROM g GROUP BY 1"""
ORACLES["judge_prompt_turns"] = f"""WITH {_TURNS}, n AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) - 1 AS i FROM t)
SELECT conv_id, string_agg('[' || i || '] ' || role || ': ' || text, chr(10) || chr(10) ORDER BY i) AS prompt FROM n GROUP BY 1"""
ORACLES["requested_turn_count"] = "SELECT p_partkey, p_size AS turns FROM part"
ORACLES["covered_types"] = f"""{_FOUND}, k AS (SELECT unnest(['CREDIT_CARD', 'EMAIL', 'IP_ADDRESS', 'PHONE', 'US_SSN']) AS category)
SELECT k.category, count(f.value) AS n FROM k LEFT JOIN f ON k.category = f.category GROUP BY 1"""
ORACLES["turn_time_bounds"] = """SELECT o_orderkey AS record_id, 'times' AS gate, 'turn_time_out_of_bounds:' || l_linenumber AS finding
FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_shipdate < o_orderdate OR l_shipdate > o_orderdate + INTERVAL 60 DAY"""
ORACLES["upstream_ids"] = """SELECT doc_id AS record_id, 'upstream' AS gate, 'unknown_upstream_id' AS finding FROM labels
WHERE doc_id NOT IN (SELECT doc_id FROM documents WHERE lang <> 'fr')"""
ORACLES["duplicate_turn_groups"] = f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents), f AS (SELECT doc_id, nfc_normalize(regexp_replace({_STRIPPED}, '{_BLANK}', ' ', 'g')) AS body FROM d),
g AS (SELECT doc_id, min(doc_id) OVER (PARTITION BY body) AS first, count(*) OVER (PARTITION BY body) AS n FROM f)
SELECT 'r' || first AS kept, 'r' || doc_id AS record_id FROM g WHERE n > 1"""
ORACLES["detector_errors"] = r"SELECT doc_id AS record_id, 'text' AS field, 'detector_error' AS reason FROM documents WHERE regexp_matches(text, '[^\x00-\x7F]')"
