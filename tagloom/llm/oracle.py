"""The operators that SQL can express, in SQL for DuckDB."""

OP2 = r"""
WITH lines AS (
    SELECT doc_id, line, place,
           translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM (SELECT doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS place
          FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents))),
repeated AS (
    SELECT key, max(doc_id) AS keeper FROM lines WHERE length(key) >= 20
    GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
judged AS (
    SELECT doc_id, line, place, keeper IS NOT NULL AND keeper <> doc_id AS gone
    FROM lines LEFT JOIN repeated USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""

OP3 = r"""
WITH rows AS (
    SELECT doc_id, regexp_replace(coalesce(text, ''), '[ \t\n\x0B\f\r]+', ' ', 'g') AS content FROM documents),
groups AS (
    SELECT content, min(doc_id) AS keep_id, count(*) AS group_size FROM rows GROUP BY content)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(content) AS text_sha256
FROM rows JOIN groups USING (content)
"""

OP12 = r"""
WITH texts AS (
    SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents),
measured AS (
    SELECT *, regexp_extract_all(text, '[^ \t\n\x0B\f\r]+') AS words, min(doc_id) OVER (PARTITION BY text) AS first FROM texts),
known AS (
    SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
failures AS (
    SELECT part, len(words) < 50 AS a, 100 * len(list_distinct(words)) < 65 * len(words) AS b,
           100 * len(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * len(text) AS c,
           regexp_matches(text, '[#$%&*|]') AS d, coalesce(first < doc_id, false) AS e,
           coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic
    FROM measured LEFT JOIN known USING (doc_id)),
masks AS (
    SELECT part, a, b, c, d, e, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM failures GROUP BY ALL),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f),
orders AS (
    SELECT v.f || w.f || x.f || y.f || z.f AS filter_order
    FROM letters v, letters w, letters x, letters y, letters z
    WHERE len(list_distinct([v.f, w.f, x.f, y.f, z.f])) = 5),
gone AS (
    SELECT masks.*, filter_order, least(
        CASE WHEN a THEN instr(filter_order, 'A') ELSE 6 END, CASE WHEN b THEN instr(filter_order, 'B') ELSE 6 END,
        CASE WHEN c THEN instr(filter_order, 'C') ELSE 6 END, CASE WHEN d THEN instr(filter_order, 'D') ELSE 6 END,
        CASE WHEN e THEN instr(filter_order, 'E') ELSE 6 END) AS gone_at
    FROM masks, orders),
steps AS (
    SELECT gone.*, step, substr(filter_order, step, 1) AS f,
           CASE substr(filter_order, step, 1) WHEN 'A' THEN a WHEN 'B' THEN b WHEN 'C' THEN c WHEN 'D' THEN d ELSE e END AS fails
    FROM gone, (SELECT unnest([1, 2, 3, 4, 5]) AS step)),
counts AS (
    SELECT part, filter_order, step, f, coalesce(sum(n) FILTER (WHERE gone_at > step), 0)::BIGINT AS kept,
           coalesce(sum(n) FILTER (WHERE gone_at = step), 0)::BIGINT AS removed,
           coalesce(sum(n) FILTER (WHERE gone_at < step AND fails), 0)::BIGINT AS redundant,
           coalesce(sum(n) FILTER (WHERE fails AND a::INT + b::INT + c::INT + d::INT + e::INT = 1), 0)::BIGINT AS unique_fails,
           coalesce(sum(good) FILTER (WHERE gone_at = step), 0)::BIGINT AS good_lost,
           coalesce(sum(toxic) FILTER (WHERE gone_at = step), 0)::BIGINT AS toxic_lost
    FROM steps GROUP BY part, filter_order, step, f)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley
FROM counts
"""

OP13 = r"""
WITH texts AS (
    SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || doc_id) AS hash,
           regexp_extract_all(coalesce(text, ''), '[ \t\n\x0B\f\r]*[^ \t\n\x0B\f\r]+|[ \t\n\x0B\f\r]+') AS units
    FROM documents),
drawn AS (
    SELECT doc_id, text, units, len(units)::BIGINT AS n, ('0x' || substr(hash, 1, 8))::BIGINT AS h1,
           ('0x' || substr(hash, 9, 8))::BIGINT AS h2, ('0x' || substr(hash, 17, 8))::BIGINT AS h3,
           ('0x' || substr(hash, 25, 8))::BIGINT AS h4 FROM texts),
cut AS (
    SELECT doc_id, n, text, CASE WHEN text = '' OR regexp_matches(text, '<[PSM]>') OR h3 % 100 >= 50 THEN 'plain'
                                 WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form,
           array_to_string(units[1:least(h1 % (n + 1), h2 % (n + 1))], '') AS p,
           array_to_string(units[least(h1 % (n + 1), h2 % (n + 1)) + 1:greatest(h1 % (n + 1), h2 % (n + 1))], '') AS m,
           array_to_string(units[greatest(h1 % (n + 1), h2 % (n + 1)) + 1:], '') AS s
    FROM drawn)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN len(p) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN len(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'spm' THEN '<S>' || s || '<P>' || p || '<M>' || m
              ELSE '<P>' || p || '<S>' || s || '<M>' || m END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM cut
"""


def llm_oracles() -> dict[str, str]:
    return {"op2_line_dedup": OP2, "op3_exact_dedup": OP3, "op12_filter_audit": OP12, "op13_fill_in_middle": OP13}
