"""DuckDB counterparts of the registered queries that SQL can express."""

ORACLES: dict[str, str] = {}

_KEY = r"translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLES["op1_line_dedup"] = rf"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos
  FROM documents
), keyed AS (SELECT doc_id, pos, line, {_KEY} AS key FROM lines),
bad AS (SELECT key FROM keyed WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10),
marked AS (SELECT k.doc_id, k.pos, k.line, b.key IS NOT NULL AS gone FROM keyed k LEFT JOIN bad b ON k.key = b.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

ORACLES["op2_topk"] = """
WITH rows AS (
  SELECT DISTINCT vec_id AS id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len([1 FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), scored AS (
  SELECT q.id AS query_id, d.id AS vec_id,
         CAST(list_sum([p[1] * p[2] FOR p IN list_zip(q.v, d.v)]) AS BIGINT) AS score
  FROM rows q JOIN rows d ON q.id % 50 = 0 AND q.id <> d.id
), ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 5
"""

_BLANKS = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_RUN = r"[\x20\x09-\x0D]+"


def _words(text: str) -> str:
    return f"CASE WHEN trim({text}, {_BLANKS}) = '' THEN [] ELSE regexp_split_to_array(trim({text}, {_BLANKS}), '{_RUN}') END"


ORACLES["op4_quality_rules"] = rf"""
WITH w AS (SELECT doc_id, source, coalesce(text, '') AS t, {_words("coalesce(text, '')")} AS ws FROM documents),
windows AS (SELECT doc_id, unnest(range(1, len(ws) - 6)) AS i, ws FROM w),
dup AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, array_to_string(ws[i:i + 7], ' ')) AS n FROM windows),
covered AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 8)) AS p FROM dup WHERE n > 1) GROUP BY doc_id),
lines AS (
  SELECT doc_id, source, line, place, lower(regexp_replace(trim(line, {_BLANKS}), '{_RUN}', ' ', 'g')) AS norm
  FROM (SELECT doc_id, source, unnest(string_split(t, chr(10))) AS line, unnest(range(len(string_split(t, chr(10))))) AS place FROM w)
  WHERE trim(line, {_BLANKS}) <> ''),
prints AS (SELECT doc_id, md5(string_agg(norm, chr(10) ORDER BY place)) AS print FROM lines GROUP BY doc_id),
bad AS (SELECT source, norm FROM lines JOIN prints USING (doc_id) GROUP BY source, norm HAVING count(DISTINCT print) > 20),
per_doc AS (
  SELECT l.doc_id, count(*) - count(DISTINCT line) AS n_dup,
         coalesce(sum(CASE WHEN b.norm IS NOT NULL THEN length(l.norm) - length(replace(l.norm, ' ', '')) + 1 END), 0) AS n_removed
  FROM lines l LEFT JOIN bad b ON l.norm = b.norm AND l.source IS NOT DISTINCT FROM b.source GROUP BY l.doc_id),
counted AS (
  SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         coalesce(n_dup, 0) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed
  FROM w LEFT JOIN covered c USING (doc_id) LEFT JOIN per_doc USING (doc_id)),
judged AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM counted)
SELECT *, NOT base_failed AND n_removed <= 0.6e0 * n_words AS kept FROM judged
"""

ORACLES["op9_mixing"] = f"""
WITH w AS (
  SELECT doc_id, source, {_words("coalesce(text, '')")} AS ws,
         md5(concat_ws(chr(31), coalesce('=' || doc_id, '-'), coalesce('=' || source, '-'), coalesce('=' || text, '-'))) AS key
  FROM documents),
s AS (SELECT doc_id, source, key, CAST(len(ws) AS BIGINT) AS size,
             CASE WHEN len(ws) = 0 THEN 0.5e0 ELSE (len(list_distinct(ws)) / len(ws) + 1) / 2 END AS quality FROM w),
src AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM s GROUP BY source),
weighed AS (SELECT *, [3e0, 1e0, 2e0][(row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1] AS weight FROM src),
level AS (
  SELECT *, 2 * source_size AS cap, (sum(source_size) OVER () * 1.5e0 - coalesce(sum(source_size) OVER before, 0) * 2e0)
         / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS share
  FROM weighed WINDOW before AS (ORDER BY source_size / weight, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
cut AS (SELECT *, min(CASE WHEN share * weight < cap THEN {{'r': source_size / weight, 'l': share}} END) OVER () AS first FROM level),
plan AS (
  SELECT source, source_size, CASE WHEN first IS NULL THEN cap ELSE least(cap, first.l * weight) END AS target FROM cut),
parts AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS epochs FROM plan),
drawn AS (
  SELECT s.doc_id, s.size, p.source_size, p.target, p.epochs, p.target - p.epochs * p.source_size AS rest,
         sum(s.size) OVER (PARTITION BY s.source ORDER BY
           -ln((CAST('0x' || substr(md5('1-' || key), 1, 13) AS BIGINT) + 0.5e0) / 4503599627370496e0) / quality, key
           ROWS UNBOUNDED PRECEDING) AS upto
  FROM s JOIN parts p ON s.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size, source_size, CAST(target AS DOUBLE) AS target,
       CAST((epochs + CASE WHEN upto <= rest OR (rest > upto - size AND upto - rest < rest - (upto - size)) THEN 1 ELSE 0 END) * size AS BIGINT) AS taken
FROM drawn
"""


def _url_sql(order: int = 4, least: int = 4, strength: str = "2e0", left_out: int = 5) -> str:
    full = order + 1
    cases = [
        ("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
        ("allow", "com", "/fr/"), ("block", "com", "/de/"),
    ]
    rules = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in cases)
    tables, joins = [], []
    for m in range(1, full + 1):
        tables.append(f"own{m} AS (SELECT substr(gram, {full - m + 1}) AS s, sum(yes) AS yes, sum(no) AS no FROM counts GROUP BY 1)")
        joins.append(f"LEFT JOIN own{m} ON own{m}.s = substr(u.gram, {full - m + 1})")
        if m > 1:
            tables.append(f"ctx{m} AS (SELECT substr(gram, {full - m + 1}, {m - 1}) AS s, sum(yes) AS yes, sum(no) AS no FROM counts GROUP BY 1)")
            joins.append(f"LEFT JOIN ctx{m} ON ctx{m}.s = substr(u.gram, {full - m + 1}, {m - 1})")

    def likelihood(kind: str) -> str:
        p = f"((coalesce(own1.{kind}, 0) + 1) / CAST(t.{kind} + t.kinds + 1 AS DOUBLE))"
        for m in range(2, full + 1):
            seen = f"coalesce(ctx{m}.{kind}, 0)"
            p = f"(CASE WHEN {seen} >= {least} THEN (coalesce(own{m}.{kind}, 0) + {strength} * {p}) / ({seen} + {strength}) ELSE {p} END)"
        return p

    return f"""
WITH rules(v, h, p) AS (VALUES {rules}),
cut AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                 regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
fits AS (
  SELECT page_id, max({{'n': length(h || p), 'rule': h || p, 'v': v}}) AS fit FROM parts JOIN rules
    ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY page_id),
judged AS (SELECT parts.*, host || path AS text, fit.rule AS rule, fit.v AS verdict FROM parts LEFT JOIN fits USING (page_id)),
texts AS (SELECT text, count(*) AS n, min(verdict) AS verdict, CAST('0x' || substr(md5(text), 1, 8) AS BIGINT) % {left_out} AS fold FROM judged GROUP BY text),
grams AS (SELECT text, n, verdict, fold, unnest([substr(repeat(chr(2), {order}) || text || chr(3), i, {full}) FOR i IN range(1, length(text) + 2)]) AS gram FROM texts),
counts AS (
  SELECT gram, sum(CASE WHEN verdict = 'allow' THEN n ELSE 0 END) AS yes, sum(CASE WHEN verdict = 'block' THEN n ELSE 0 END) AS no
  FROM grams WHERE verdict IS NOT NULL AND fold <> 0 GROUP BY gram),
t AS (SELECT sum(yes) AS yes, sum(no) AS no, count(DISTINCT substr(gram, {full})) AS kinds FROM counts),
{", ".join(tables)},
u AS (SELECT DISTINCT gram FROM grams WHERE verdict IS NULL OR fold = 0),
ratios AS (SELECT u.gram, CAST(round((ln({likelihood("yes")}) - ln({likelihood("no")})) * 1000000) AS BIGINT) AS ratio FROM u CROSS JOIN t {" ".join(joins)}),
scored AS (
  SELECT text, any_value(n) AS n, any_value(verdict) AS verdict, CAST(floor(sum(ratio) / 1000000e0 / (length(text) + 1) * 100) AS BIGINT) AS step
  FROM grams JOIN ratios USING (gram) WHERE verdict IS NULL OR fold = 0 GROUP BY text),
bins AS (SELECT least(1000, greatest(-1000, step)) AS bin, sum(CASE WHEN verdict = 'allow' THEN n ELSE 0 END) AS yes,
                sum(CASE WHEN verdict = 'block' THEN n ELSE 0 END) AS no FROM scored WHERE verdict IS NOT NULL GROUP BY 1),
rated AS (
  SELECT greatest(coalesce(lag(bin) OVER (ORDER BY bin), -1001) + 1, least(bin, 0)) AS place,
         sum(yes) OVER (ORDER BY bin ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) / nullif(sum(yes) OVER (), 0)
         + coalesce(sum(no) OVER (ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) / nullif(sum(no) OVER (), 0) AS rate FROM bins),
best AS (SELECT coalesce((SELECT place FROM rated WHERE rate IS NOT NULL ORDER BY round(rate, 9) DESC, abs(place), place LIMIT 1), 0) AS place),
model AS (SELECT text, CASE WHEN (SELECT least(yes, no) FROM t) > 0 AND step < (SELECT place FROM best) THEN 'block' ELSE 'allow' END AS said FROM scored)
SELECT page_id, host, path, rule, coalesce(judged.verdict, said, 'allow') AS verdict FROM judged LEFT JOIN model USING (text)
"""


ORACLES["op7_url_filters"] = _url_sql()
