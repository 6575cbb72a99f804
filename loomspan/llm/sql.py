"""DuckDB SQL whose rows the corpus queries must equal."""

from __future__ import annotations

_STOP = (
    "the and of to in is that it for was on are as with be by this have from or at not "
    "der die das und den von zu mit ist im sich auf des dem nicht ein eine für "
    "de la le les et des en un une du que est pour dans qui sur au avec "
    "el los las del y por con una su para es al lo como se"
).split()

_WORDS = r"list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"

ORACLES: dict[str, str] = {}

ORACLES["op2_quality_rules"] = rf"""
WITH w AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text, {_WORDS} AS ws FROM documents),
tri AS (SELECT rid, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS t
        FROM (SELECT rid, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)),
rep AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, t) AS n FROM tri) WHERE n >= 2),
cov AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM rep) GROUP BY rid),
f AS (SELECT w.rid, doc_id, text, ws, len(ws) AS n_words, coalesce(cov.n, 0) AS n_repeat_words,
        length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
        length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
        list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls,
        len(list_filter(ws, lambda x: list_contains({_STOP!r}, lower(x)))) AS n_stop,
        len(regexp_extract_all(text, '[A-Z]{{4,}}')) AS n_shouted
      FROM w LEFT JOIN cov ON w.rid = cov.rid),
g AS (SELECT *, len(ls) AS n_lines, len(ls) - len(list_distinct(ls)) AS n_dup_lines, greatest(n_words, 1) AS n,
        n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM f)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
  n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
  NOT base_failed AND word_chars / n BETWEEN 2.0 AND 14.0 AND n_symbols / n <= 0.25
    AND n_dup_lines / greatest(n_lines, 1) <= 0.5 AND (n_words < 50 OR n_stop / n >= 0.06)
    AND (n_words < 50 OR n_shouted / n <= 0.4) AS kept
FROM g"""

ORACLES["op9_mixing"] = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, source, len({_WORDS})::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::BIGINT AS weight, 3 * source_size AS cap FROM s),
l AS (SELECT *, sum(source_size) OVER ()::BIGINT - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS left_words,
        sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::BIGINT AS left_weight FROM w),
c AS (SELECT *, cap <= weight * (left_words / left_weight) AS capped FROM l),
t AS (SELECT source, source_size,
        CASE WHEN capped THEN cap::DOUBLE ELSE weight * (SELECT arg_max(left_words / left_weight, left_weight) FROM c WHERE NOT capped) END AS target FROM c),
k AS (SELECT d.*, md5(doc_id::VARCHAR) AS key FROM d),
p AS (SELECT rid, doc_id, source, size, coalesce(sum(size) OVER (PARTITION BY source ORDER BY ('0x' || substr(key, 1, 4))::INT % 1024, key, doc_id, size
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start FROM k),
-- the schedule: points n * golden ratio modulo 1 on the sources' pieces of the cumulative numbers of blocks
b AS (SELECT source, round(target)::BIGINT AS want, greatest(1, least(4096, floor(sum(round(target)::BIGINT) OVER ()::DOUBLE / (512 * count(*) OVER ()))))::BIGINT AS block FROM t WHERE round(target) > 0),
n AS (SELECT *, (want + block - 1) // block AS need FROM b),
h AS (SELECT *, sum(need) OVER ()::BIGINT AS slots, sum(need) OVER (ORDER BY source NULLS LAST)::BIGINT AS upto FROM n),
q AS (SELECT slot, slot * 6.180339887498949e-1 - floor(slot * 6.180339887498949e-1) AS point FROM (SELECT unnest(range(0, (SELECT max(slots) FROM h))) AS slot)),
z AS (SELECT slot, source, row_number() OVER (PARTITION BY source ORDER BY slot) AS rank
      FROM q JOIN h ON point >= (upto - need)::DOUBLE / slots::DOUBLE AND point < upto::DOUBLE / slots::DOUBLE),
u AS (SELECT rid, p.source, h.want, h.block, size, start + source_size * unnest(range(0, ((want - start - 1) // source_size)::BIGINT + 1)) AS "from"
      FROM p JOIN t ON p.source IS NOT DISTINCT FROM t.source JOIN h ON p.source IS NOT DISTINCT FROM h.source WHERE size > 0 AND start < want),
v AS (SELECT *, unnest(range("from" // block + 1, ("from" + size - 1) // block + 2)) AS rank FROM u),
w2 AS (SELECT v.rid, least("from" + size, v.rank * block, want) - greatest("from", (v.rank - 1) * block) AS words, slot
       FROM v LEFT JOIN z ON v.source IS NOT DISTINCT FROM z.source AND v.rank = z.rank),
k2 AS (SELECT rid, sum(words) AS taken, min(slot) AS first_slot, count(DISTINCT slot) AS n_slots, sum(DISTINCT slot) AS slot_sum FROM w2 WHERE words > 0 GROUP BY rid)
SELECT doc_id, size, source_size, target, coalesce(taken, 0)::BIGINT AS taken, first_slot::BIGINT AS first_slot,
  coalesce(n_slots, 0)::BIGINT AS n_slots, coalesce(slot_sum, 0)::BIGINT AS slot_sum
FROM p JOIN t ON p.source IS NOT DISTINCT FROM t.source LEFT JOIN k2 ON p.rid = k2.rid"""

# windows of 50 bytes as 100 hex digits; a byte goes if a window over it starts in a smaller document too
ORACLES["op7_suffix_array_dedup"] = """
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
s AS (SELECT rid, doc_id, p, substr(x, 2 * p + 1, 100) AS w FROM (SELECT *, unnest(range(0, greatest(0, length(x) // 2 - 49))) AS p FROM d)),
hit AS (SELECT rid, p FROM (SELECT rid, p, doc_id, min(doc_id) OVER (PARTITION BY w) AS least FROM s) WHERE doc_id > least),
b AS (SELECT rid, p, max(p) OVER (PARTITION BY rid ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM hit),
r AS (SELECT rid, p, sum(CASE WHEN before IS NULL OR p > before + 50 THEN 1 ELSE 0 END) OVER (PARTITION BY rid ORDER BY p) AS g FROM b),
g AS (SELECT rid, g, min(p) AS lo, max(p) + 50 AS hi, lead(min(p)) OVER (PARTITION BY rid ORDER BY g) AS nxt FROM r GROUP BY rid, g),
k AS (SELECT g.rid, count(*) AS n_spans, sum(hi - lo) AS n_removed,
        substr(any_value(x), 1, 2 * min(lo)) || string_agg(substr(x, 2 * hi + 1, 2 * (coalesce(nxt, length(x) // 2) - hi)), '' ORDER BY lo) AS kept
      FROM g JOIN d ON g.rid = d.rid GROUP BY g.rid)
SELECT d.doc_id, (length(x) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
  sha256(unhex(coalesce(kept, x))) AS kept_sha256
FROM d LEFT JOIN k ON d.rid = k.rid"""

# shingles as joined text: a word has no blank; short texts carry a mark that no 5-word shingle has
ORACLES["op4_jaccard_rtree"] = rf"""
WITH RECURSIVE d AS (SELECT doc_id, list_transform({_WORDS}, lambda w: translate(w, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) >= 5
          THEN list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))
          WHEN len(ws) > 0 THEN ['short ' || len(ws) || ':' || array_to_string(ws, ' ')] ELSE [] END) AS g FROM d),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
o AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS o FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT x, y FROM o JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * o >= 75 * (a.n + b.n - o)),
r AS (SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT r.x, l.y FROM r JOIN l ON r.y = l.x)
SELECT d.doc_id, coalesce(any_value(n.n), 0)::BIGINT AS n_shingles, min(r.y) AS component_id
FROM d LEFT JOIN n ON n.doc_id = d.doc_id JOIN r ON r.x = d.doc_id GROUP BY d.doc_id"""

# the rejected conversation is the chosen one's first m turns, then the other's; both are numbered, and
# the prompt is all turns before the first that differs
ORACLES["op5_preference_format"] = """
WITH t AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS k,
    coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations),
n AS (SELECT conv_id, count(*) AS n, ('0x' || substr(md5(conv_id::VARCHAR), 1, 4))::INT % count(*) AS m FROM t GROUP BY conv_id),
x AS (SELECT a.conv_id, xor(a.conv_id, 1) AS other, a.m FROM n a JOIN n b ON xor(a.conv_id, 1) = b.conv_id),
r AS (SELECT t.* FROM t JOIN x USING (conv_id) WHERE k <= m UNION ALL SELECT x.conv_id, k, role, text FROM x JOIN t ON t.conv_id = x.other WHERE k > m),
d AS (SELECT coalesce(a.conv_id, r.conv_id) AS conv_id, min(coalesce(a.k, r.k)) - 1 AS p
      FROM (SELECT t.* FROM t JOIN x USING (conv_id)) a FULL JOIN r ON a.conv_id = r.conv_id AND a.k = r.k
      WHERE a.k IS NULL OR r.k IS NULL OR a.role <> r.role OR a.text <> r.text GROUP BY 1),
p AS (SELECT n.conv_id, x.conv_id IS NOT NULL AS paired, CASE WHEN x.conv_id IS NULL THEN greatest(0, n - 1) ELSE coalesce(d.p, n) END AS p
      FROM n LEFT JOIN x USING (conv_id) LEFT JOIN d USING (conv_id)),
s AS (SELECT 'c' AS side, * FROM t UNION ALL SELECT 'r', * FROM r),
z AS (SELECT s.*, p, '<|' || role || '|>' || chr(10) || text || chr(10) || '<|end|>' || chr(10) AS turn FROM s JOIN p USING (conv_id)),
y AS (SELECT *, coalesce(sum(length(turn)) OVER (PARTITION BY conv_id, side ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS pos FROM z WHERE k > p),
c AS (SELECT conv_id, side, string_agg(turn, '' ORDER BY k) AS done,
        string_agg((pos + length(role) + 5) || ':' || (pos + length(turn)), ',' ORDER BY k) FILTER (WHERE role = 'assistant') AS mask FROM y GROUP BY conv_id, side),
o AS (SELECT conv_id, string_agg(turn, '' ORDER BY k) AS prompt FROM z WHERE side = 'c' AND k <= p GROUP BY conv_id)
SELECT p.conv_id, p.p::BIGINT AS prompt_turns, coalesce(prompt, '') AS prompt, coalesce(a.done, '') AS chosen_completion, coalesce(a.mask, '') AS chosen_mask,
  CASE WHEN paired THEN coalesce(b.done, '') END AS rejected_completion, CASE WHEN paired THEN coalesce(b.mask, '') END AS rejected_mask
FROM p LEFT JOIN o USING (conv_id) LEFT JOIN c a ON a.conv_id = p.conv_id AND a.side = 'c' LEFT JOIN c b ON b.conv_id = p.conv_id AND b.side = 'r'"""


# crc32 byte by byte with the table of its reversed polynomial, once per different word
ORACLES["op11_resampling"] = r"""
WITH tab AS (SELECT list(c ORDER BY i) AS t FROM (SELECT i, list_reduce(list_prepend(i, [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
    lambda c, _: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM (SELECT unnest(range(0, 256))::BIGINT AS i))),
d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
b AS (SELECT regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
o AS (SELECT rid, w, count(*) AS n FROM (SELECT rid, unnest(ws) AS w FROM d) GROUP BY rid, w),
q AS (SELECT unnest(ws) AS w FROM b),
k AS (SELECT w, xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(range(1, length(h) + 1, 2), lambda i: ('0x' || substr(h, i, 2))::BIGINT)),
        lambda c, y: xor(t[(xor(c, y) & 255) + 1], c >> 8))) % 10000 AS bucket
      FROM (SELECT w, hex(encode(w)) AS h FROM (SELECT w FROM o UNION SELECT w FROM q)), tab),
s AS (SELECT bucket, sum(n)::BIGINT AS s FROM o JOIN k USING (w) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS t FROM q JOIN k USING (w) GROUP BY bucket),
g AS (SELECT bucket, floor(1000 * ln(((coalesce(t, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(s), 0) FROM s) + 10000)::DOUBLE) / ((coalesce(s, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(t), 0) FROM t) + 10000)::DOUBLE)))::BIGINT AS gain
      FROM s FULL JOIN t USING (bucket)),
w AS (SELECT rid, sum(n * gain)::BIGINT AS weight FROM o JOIN k USING (w) JOIN g USING (bucket) GROUP BY rid),
f AS (SELECT rid, doc_id, len(ws)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
        coalesce(weight, 0)::BIGINT + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5) / 4294967296.0)))::BIGINT AS score
      FROM d LEFT JOIN w USING (rid)),
r AS (SELECT rid, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST, n_features, rid) AS place, count(*) OVER () AS n FROM f WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= 10 * n // 100 THEN place END AS rank FROM f LEFT JOIN r USING (rid)"""

# costs to the end from the last turn back, then the edits from the first turn on, one turn or insertion a step
ORACLES["op13_repair"] = r"""
WITH RECURSIVE tab AS (SELECT list(c ORDER BY i) AS t FROM (SELECT i, list_reduce(list_prepend(i, [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
    lambda c, _: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM (SELECT unnest(range(0, 256))::BIGINT AS i))),
r AS (SELECT dense_rank() OVER (ORDER BY conv_id NULLS FIRST) AS c, conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        hex(encode(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '))) AS h FROM conversations),
m AS (SELECT r.*, xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(range(1, length(h) + 1, 2), lambda i: ('0x' || substr(h, i, 2))::BIGINT)),
        lambda c, y: xor(t[(xor(c, y) & 255) + 1], c >> 8))) % 20 AS m FROM r, tab),
d AS (SELECT c, turn, CASE WHEN m = 4 THEN 'user' ELSE role END AS role, CASE m WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
        unnest(range(0, CASE WHEN m = 3 THEN 2 ELSE 1 END)) AS copy FROM m WHERE m <> 0),
o AS (SELECT *, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS k, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS ink FROM d),
f AS (SELECT *, substr(role, 1, 1) AS x, CASE WHEN ink = '' THEN 'b' WHEN row_number() OVER (PARTITION BY c, role, text ORDER BY k) > 1 THEN 'd' WHEN right(ink, 1) NOT IN ('.', '!', '?') THEN 't' ELSE '' END AS fault FROM o),
g AS (SELECT c, k, x, role, text, CASE WHEN fault IN ('b', 'd') THEN 1000000000 ELSE 0 END AS no, CASE WHEN fault = 't' THEN 3 ELSE 0 END AS cut FROM f),
n AS (SELECT c, count(*) AS n FROM g GROUP BY c),
v AS (SELECT c, n + 1 AS i, [0, 6, 3, 0]::BIGINT[] AS v FROM n
      UNION ALL
      SELECT c, i, [least(b[1], u + 3), least(b[2], u + 3), u, a] FROM (
        SELECT c, i, b, least(b[3], b[4] + 3) AS u, least(b[4], b[3] + 3) AS a FROM (
          SELECT v.c, k AS i, [least(v[1] + 4, no + v[3] + 3 + cut, CASE x WHEN 's' THEN no + v[2] + cut WHEN 'u' THEN no + v[3] + cut ELSE 1000000000 END),
            least(v[2] + 4, no + v[3] + 3 + cut, CASE x WHEN 'u' THEN no + v[3] + cut ELSE 1000000000 END),
            least(v[3] + 4, no + v[4] + 3 + cut, CASE x WHEN 'a' THEN no + v[4] + cut ELSE 1000000000 END),
            least(v[4] + 4, no + v[3] + 3 + cut, CASE x WHEN 'u' THEN no + v[3] + cut ELSE 1000000000 END)] AS b
          FROM v JOIN g ON v.c = g.c AND g.k = v.i - 1))),
p AS (SELECT v.c, v.i, n, v.v AS here, w.v AS behind, x, role, text, cut FROM v JOIN n ON v.c = n.c LEFT JOIN v w ON v.c = w.c AND w.i = v.i + 1 LEFT JOIN g ON g.c = v.c AND g.k = v.i),
e AS (SELECT c, 1::BIGINT AS i, 0 AS s, 0 AS step, '' AS audit, '' AS done, 0::BIGINT AS cost FROM n
      UNION ALL
      SELECT c, i + CASE WHEN edit = 'I' THEN 0 ELSE 1 END, CASE edit WHEN 'D' THEN s WHEN 'K' THEN kept ELSE made END, step + 1, audit || edit,
        done || CASE edit WHEN 'D' THEN '' WHEN 'K' THEN chr(10) || role || ':' || text ELSE chr(10) || CASE WHEN made = 2 THEN 'user:' ELSE 'assistant:' END || CASE WHEN edit = 'R' THEN text ELSE '' END END,
        cost + CASE edit WHEN 'D' THEN 4 WHEN 'I' THEN 3 WHEN 'K' THEN cut ELSE 3 + cut END
      FROM (SELECT *, CASE WHEN i <= n AND behind[s + 1] + 4 = here[s + 1] THEN 'D' WHEN here[made + 1] + 3 = here[s + 1] THEN 'I' WHEN behind[kept + 1] + cut = here[s + 1] THEN 'K' ELSE 'R' END AS edit
        FROM (SELECT e.*, n, here, behind, role, text, cut, CASE s WHEN 2 THEN 3 ELSE 2 END AS made, CASE WHEN s = 0 AND x = 's' THEN 1 WHEN s <> 2 AND x = 'u' THEN 2 WHEN s = 2 AND x = 'a' THEN 3 END AS kept
              FROM e JOIN p ON e.c = p.c AND e.i = p.i WHERE e.i <= n OR s IN (1, 2)))),
z AS (SELECT c, arg_max(audit, step) AS audit, arg_max(done, step) AS done, arg_max(cost, step) AS cost FROM e GROUP BY c),
q AS (SELECT c, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated,
        count(*) FILTER (pair IS NOT NULL AND pair NOT IN ('su', 'ua', 'au')) AS illegal
      FROM (SELECT *, lag(x) OVER (PARTITION BY c ORDER BY k) || x AS pair FROM f) GROUP BY c)
SELECT conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
  coalesce(illegal, 0)::BIGINT AS illegal, coalesce(cost, 0)::BIGINT AS cost, coalesce(audit, '') AS audit, sha256(substr(coalesce(done, ''), 2)) AS repaired_sha256
FROM (SELECT DISTINCT c, conv_id FROM r) LEFT JOIN z USING (c) LEFT JOIN q USING (c)"""
