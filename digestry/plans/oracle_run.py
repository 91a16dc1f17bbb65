"""SQL checks of the item store and of a whole run."""

from __future__ import annotations

from digestry.plans.oracle import CHECKS, NOW, blank, case_list, check, collapse, norm, shared, short_hash, stamp, start
from digestry.plans.roles import LABEL_IDS, MINIMUM_FINAL

__all__ = ["CHECKS"]

PLACE = "CASE WHEN kind = 'paper' THEN 'papers' ELSE 'blogs' END"
check("item_store_merge", f"""
SELECT id, kind, row_key,
       CASE WHEN row_key % 11 = 0 THEN 'third' WHEN row_key % 3 = 0 OR row_key % 5 = 0 THEN 'second' ELSE 'first' END AS run,
       {PLACE} AS folder, strftime(published_at, '%Y') AS year, strftime(published_at, '%m') AS month
FROM r_items WHERE row_key % 2 = 0 OR row_key % 3 = 0 OR row_key % 5 = 0 OR row_key % 11 = 0""")

shared("u_batch", "SELECT batch, bool_and(row_key % 97 <> 96) AS ok FROM r_topb GROUP BY batch")
# Proposed labels in their order: the first two that the text supports, then one more.
shared("u_prop", f"""
SELECT kind, row_key, label, min(place) AS place FROM (
  SELECT kind, row_key, label, row_number() OVER (PARTITION BY kind, row_key ORDER BY pos) AS place FROM r_lab
  QUALIFY place <= 2
  UNION ALL
  SELECT kind, row_key, CASE WHEN row_key % 97 = 96 THEN 'unknown_label' ELSE {case_list(LABEL_IDS, f'(row_key % {len(LABEL_IDS)})')} END, 3 FROM r_topb)
GROUP BY kind, row_key, label""")
shared("u_lab", """
SELECT t.kind, t.row_key, l.grp, l.label, CASE WHEN b.ok THEN p.place ELSE l.pos END AS place, l.pos // 100 AS g
FROM r_topb t JOIN u_batch b USING (batch) JOIN r_lab l ON l.kind = t.kind AND l.row_key = t.row_key
LEFT JOIN u_prop p ON p.kind = t.kind AND p.row_key = t.row_key AND p.label = l.label
WHERE NOT b.ok OR p.label IS NOT NULL""")
shared("u_labels", """
SELECT kind, row_key, string_agg(label, ' ' ORDER BY g, place) AS labels, count(DISTINCT grp) AS groups FROM u_lab GROUP BY kind, row_key""")
shared("u_short", f"""
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY kind ORDER BY relevance DESC, published_at DESC, source_id, id) AS place FROM (
  SELECT t.kind, t.row_key, t.id, t.source_id, t.title, t.published_at, l.labels, l.groups, NOT b.ok AS degraded,
         CASE WHEN b.ok THEN 'about ' || t.title WHEN regexp_matches({start}, '\\p{{L}}') THEN {start} END AS summary,
         CASE WHEN b.ok THEN (t.row_key * 31 % 101) / 100.0::DOUBLE ELSE greatest(0::DOUBLE, least(1::DOUBLE, t.metadata_score)) END AS relevance,
         substr(c.excerpt, 1, 4000) AS excerpt
  FROM r_topb t JOIN u_batch b USING (batch) JOIN u_labels l ON l.kind = t.kind AND l.row_key = t.row_key
  JOIN r_cand c ON c.kind = t.kind AND c.row_key = t.row_key) WHERE relevance >= 0.30) WHERE place <= 20""")
shared("u_read", f"""
SELECT *, row_key % 23 = 0 OR CASE WHEN kind = 'paper' THEN {blank('title')} OR ({blank('excerpt')} AND row_key % 3 = 0)
          ELSE row_key % 19 = 0 OR {blank('title')} END AS failed
FROM u_short""")
shared("u_items", """
SELECT *, greatest(0::DOUBLE, least(1::DOUBLE, 0.55::DOUBLE * relevance + 0.20::DOUBLE * evidence + 0.15::DOUBLE * transfer + 0.10::DOUBLE * depth)) AS final_score
FROM (SELECT *,
  CASE WHEN row_key % 4 = 1 THEN (row_key % 10) / 10.0::DOUBLE ELSE least(1::DOUBLE, (row_key % 5) / 3.0::DOUBLE) END AS evidence,
  CASE WHEN row_key % 5 = 0 THEN 0.5::DOUBLE ELSE least(1::DOUBLE, (row_key % 4) / 3.0::DOUBLE) END AS transfer,
  CASE WHEN row_key % 6 = 0 THEN 0.75::DOUBLE
       WHEN kind = 'paper' THEN least(1::DOUBLE, ((title <> '')::INT + (excerpt <> '')::INT + 2 * (row_key % 3) + row_key % 2) / 6.0::DOUBLE)
       ELSE least(1::DOUBLE, ((title <> '')::INT + (row_key % 2 = 0 AND excerpt <> '')::INT + row_key % 3 + 1) / 4.0::DOUBLE) END AS depth
  FROM u_read WHERE NOT failed AND (NOT degraded OR (groups = 4 AND regexp_matches(summary, '\\p{L}'))))""")
shared("u_ranked", f"""
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY kind ORDER BY final_score DESC, published_at DESC, source_id, id) AS rank
  FROM u_items WHERE final_score >= {MINIMUM_FINAL}) WHERE rank <= 10""")
shared("u_rel", """
SELECT r.*, target_id IN (SELECT id FROM u_items UNION SELECT id FROM r_tax) AS kept FROM r_rel r WHERE id IN (SELECT id FROM u_items WHERE NOT degraded)""")
shared("u_pruned", """
SELECT id, 'pruned ' || count(*) || ' graph relation(s) with unknown target id(s) from ' || id || ' (first: ' || min_by(target_id, pos) || ')' AS warning
FROM u_rel WHERE NOT kept GROUP BY id""")
REASON = "'与推荐系统研究方向相关：' || summary"
check("run_digest", f"""
SELECT i.id, i.kind, i.source_id AS source, i.title, CASE WHEN i.kind = 'paper' THEN md5(i.excerpt) END AS abstract_hash,
       round(i.relevance, 6) AS relevance, round(i.final_score, 6) AS final_score, r.rank,
       CASE WHEN r.rank IS NOT NULL THEN '与推荐系统研究方向相关：' || i.summary END AS reason, i.degraded,
       coalesce((SELECT string_agg(target_id, ' ' ORDER BY pos) FROM u_rel x WHERE x.id = i.id AND x.kept), '') AS targets_kept, i.labels
FROM u_items i LEFT JOIN u_ranked r ON r.id = i.id""")
check("publish_run", f"""
SELECT 'verdict' AS part, '1' AS id, 'published' AS value
UNION ALL SELECT 'verdict', '2', 'gate failed: manifests'
UNION ALL SELECT 'verdict', '3', CASE WHEN (SELECT count(*) FROM u_read WHERE failed) > 0 THEN 'gate failed: reading_rate, reading_results'
                                      ELSE 'gate failed: reading_results' END
UNION ALL SELECT 'state', '1', '1 ' || {stamp(NOW)} || ' false'
UNION ALL SELECT 'item', id, {PLACE} || strftime(published_at, ' %Y %m') FROM u_items
UNION ALL SELECT 'digest', id, kind || ' ' || rank || ' ' || {REASON} FROM u_ranked
UNION ALL SELECT 'recommended', id, '0 ' || min(row_key) FROM r_cand WHERE kind = 'paper' AND row_key % 17 = 0 GROUP BY id
UNION ALL SELECT 'recommended', id, CASE WHEN kind = 'paper' THEN '1 ' ELSE '2 ' END || rank FROM u_ranked
UNION ALL SELECT 'source', source_id, 'c e ' || CASE WHEN source_id = 'src0' THEN 'then ' ELSE '' END || {stamp('max(published_at)')} FROM u_short GROUP BY source_id
UNION ALL SELECT 'source', s, 'before then 2022-02-02 00:00:00' FROM (VALUES ('src0'), ('old-source')) v(s) WHERE s NOT IN (SELECT source_id FROM u_short)
UNION ALL SELECT 'report', '1', concat_ws(' ', count(*) FILTER (kind = 'paper'), count(*) FILTER (kind = 'blog'),
    (SELECT count(*) FROM u_ranked WHERE kind = 'paper'), (SELECT count(*) FROM u_ranked WHERE kind = 'blog'), (SELECT count(*) FROM u_batch),
    (SELECT count(*) FROM u_pruned) + (SELECT count(*) FROM u_short WHERE row_key % 10 = 3)) FROM u_items
UNION ALL SELECT 'warning', id, string_agg(warning, '; ' ORDER BY warning) FROM (
    SELECT id, warning FROM u_pruned UNION ALL SELECT row_key::VARCHAR, source_id || ': HTTP 503' FROM u_short WHERE row_key % 10 = 3) GROUP BY id""")

WORD, SIGN = r"[\p{L}\p{N}_]", r"[^\p{L}\p{N}_]"


def cut(text: str) -> str:
    return f"regexp_extract_all({text}, '{WORD}+|(?s:{SIGN})')"


shared("u_big", f"""
SELECT DISTINCT term FROM (
  SELECT unnest(list_transform(range(1, len(w) + 1), lambda i: w[i])) AS term FROM (SELECT {cut(norm('text'))} AS w FROM benchmark)
  UNION ALL SELECT unnest(list_transform(range(1, len(w)), lambda i: w[i] || w[i + 1])) FROM (SELECT {cut(norm('text'))} AS w FROM benchmark)
  UNION ALL SELECT unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || w[i + 1] || w[i + 2])) FROM (SELECT {cut(norm('text'))} AS w FROM benchmark))
WHERE regexp_full_match(term, '{WORD}+|{WORD}+[^\\p{{L}}\\p{{N}}_\\s]|{WORD}+ {WORD}+')""".replace("\\\\", "\\"))
# A term that ends in a sign does not match where a word follows at once.
check("term_matches_large", f"""
WITH tok AS (
  SELECT kind, row_key, p, w[p] AS a, w[p + 1] AS b, w[p + 2] AS c FROM (
    SELECT kind, row_key, w, unnest(range(1, len(w) + 1)) AS p FROM (SELECT kind, row_key, {cut('t')} AS w FROM r_text))),
hit AS (
  SELECT DISTINCT kind, row_key, term FROM (
    SELECT kind, row_key, a AS term FROM tok
    UNION ALL SELECT kind, row_key, a || b FROM tok WHERE b IS NOT NULL AND NOT (regexp_matches(b, '^{SIGN}') AND coalesce(regexp_matches(c, '^{WORD}'), false))
    UNION ALL SELECT kind, row_key, a || b || c FROM tok WHERE c IS NOT NULL)
  WHERE term IN (SELECT term FROM u_big))
SELECT kind, row_key, count(*) AS n_terms, md5(string_agg(term, '|' ORDER BY encode(term))) AS terms_hash FROM hit GROUP BY kind, row_key""")

# --- many micro-batches -----------------------------------------------------------------------------
shared("u_first", """
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY arrival) AS nth FROM (
  SELECT *, TIMESTAMP '2024-01-31' + to_days((arrival * 4)::INT) + to_hours(row_key % 2 * 20) AS arrived_at,
         row_number() OVER (PARTITION BY id, arrival ORDER BY source_weight DESC, published_at DESC, source_id, row_key) AS best
  FROM (SELECT *, row_key % 5 AS arrival FROM r_cand)) WHERE best = 1) WHERE nth = 1""")
check("stream_ingest", f"SELECT id, kind, row_key, {stamp('arrived_at')} AS arrived FROM u_first")
check("stream_daily_digest", """
WITH scored AS (
  SELECT f.id, f.kind, f.source_id, f.published_at, (f.arrived_at + INTERVAL 8 HOUR)::DATE AS digest_date,
         0.30::DOUBLE * s.topic + 0.25::DOUBLE * s.scenario + 0.15::DOUBLE * greatest(0::DOUBLE, least(1::DOUBLE, f.source_weight)) + 0.15::DOUBLE
         + 0.10::DOUBLE * least(1::DOUBLE, (s.topic + s.scenario) / 2.0::DOUBLE)
         + 0.05::DOUBLE * greatest(0::DOUBLE, least(1::DOUBLE, 1.0::DOUBLE
             - (greatest(0, epoch_us(f.arrived_at) - epoch_us(f.published_at))::DOUBLE / 86400000000.0::DOUBLE)
               / CASE WHEN f.kind = 'blog' THEN 1095.0::DOUBLE ELSE 1825.0::DOUBLE END)) AS metadata_score
  FROM u_first f JOIN r_score s USING (kind, row_key)
  WHERE s.evidence > 0 AND f.published_at BETWEEN f.arrived_at - CASE WHEN f.kind = 'paper' THEN INTERVAL 5 YEAR ELSE INTERVAL 3 YEAR END AND f.arrived_at)
SELECT strftime(digest_date, '%Y-%m-%d') AS digest_date, kind, id, rank, round(metadata_score, 6) AS score FROM (
  SELECT *, row_number() OVER (PARTITION BY digest_date, kind ORDER BY metadata_score DESC, published_at DESC, source_id, id) AS rank FROM scored)
WHERE rank <= 10""")
check("stream_open_days", """
SELECT strftime(d, '%Y-%m-%d') AS business_date, event_type, count(*) AS n
FROM (SELECT (ts + INTERVAL 8 HOUR)::DATE AS d, event_type FROM events) GROUP BY ALL""")

# --- odd feeds --------------------------------------------------------------------------------------
shared("u_odd", f"""
SELECT *, row_key % 8 AS sort, row_key // 10 AS feed, {collapse('title')} AS line, row_key // 10 % 7 = 3 AS cut FROM r_cand WHERE kind = 'paper'""")
check("feed_odd_scan", f"""
SELECT 'url-' || {short_hash("'https://odd.example.org/p/' || row_key")} AS id, line AS title, 'https://odd.example.org/p/' || row_key AS url,
       {stamp('published_at')} AS published, md5(trim(substr({collapse('excerpt')}, 1, 4000))) AS excerpt_hash
FROM u_odd WHERE NOT cut AND line <> '' AND sort NOT IN (3, 4, 5, 7)""")
check("feed_errors", """
WITH found AS (
  SELECT feed, CASE WHEN sort = 4 OR line = '' THEN 'no_title' WHEN sort = 5 THEN 'no_date' WHEN sort = 3 THEN 'unreadable_date' WHEN sort = 7 THEN 'no_address' END AS code
  FROM u_odd WHERE NOT cut
  UNION ALL SELECT DISTINCT feed, 'malformed_feed' FROM u_odd WHERE cut)
SELECT 'feed' || feed AS source_id, code, CASE WHEN code = 'malformed_feed' AND feed % 2 = 0 THEN 'error' ELSE 'warning' END AS severity, count(*) AS n
FROM found WHERE code IS NOT NULL AND feed % 11 <> 5 GROUP BY ALL
UNION ALL SELECT 'gone', 'no_feed', 'error', 1""")
