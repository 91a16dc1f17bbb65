"""SQL checks of the registered queries, written independently of the Spark plans.

Each check is one statement over the test tables. Shared definitions are
common table expressions; `check` adds those that a statement names.
"""

from __future__ import annotations

import re

from digestry.plans.roles import LABEL_IDS, MINIMUM_FINAL, TAXONOMY, WEIGHTS

NOW = "TIMESTAMP '2024-01-31 00:00:00'"
WS = r"[\t-\r\x1c-\x20\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
CHECKS: dict[str, str] = {}
SHARED: dict[str, str] = {}


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def collapse(x: str) -> str:
    return f"trim(regexp_replace({x}, {q(WS)}, ' ', 'g'), ' ')"


def norm(x: str) -> str:
    return collapse(f"replace(lower({x}), 'ß', 'ss')")


def strip(x: str) -> str:
    return f"regexp_replace({x}, {q('^' + WS + '|' + WS + '$')}, '', 'g')"


def unescape(x: str) -> str:
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&apos;", "''"),
                         ("&nbsp;", "\xa0"), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&")):
        x = f"replace({x}, '{entity}', '{char}')"
    return x


def bounded(x: str) -> str:
    return collapse(unescape(f"regexp_replace({x}, '<[^>]*>', ' ', 'g')"))


def short_hash(x: str) -> str:
    return f"substr(sha256({x}), 1, 24)"


def stamp(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d %H:%M:%S')"


def values(rows) -> str:
    def cell(v):
        return q(v) if isinstance(v, str) else str(v)

    return "VALUES " + ", ".join("(" + ", ".join(cell(v) for v in row) + ")" for row in rows)


def matches(text: str, term: str) -> str:
    edge = r"[^\p{L}\p{N}_]"
    return f"regexp_matches(' ' || {text} || ' ', {q(edge + re.escape(term).replace(chr(92) + ' ', ' ') + edge)})"


def case_list(values_, index: str) -> str:
    whens = " ".join(f"WHEN {i} THEN {q(v) if isinstance(v, str) else str(v) + '::DOUBLE'}" for i, v in enumerate(values_))
    return f"(CASE {index} {whens} END)"


def shared(name: str, sql: str) -> None:
    SHARED[name] = sql


def check(name: str, sql: str) -> None:
    """Register a check with the shared definitions it needs, in order."""
    needed: set[str] = set()

    def visit(text: str) -> None:
        for key in SHARED:
            if key not in needed and re.search(rf"\b{key}\b", text):
                needed.add(key)
                visit(SHARED[key])

    visit(sql)
    ctes = ", ".join(f"{key} AS MATERIALIZED ({SHARED[key]})" for key in SHARED if key in needed)
    body = sql.strip()
    if ctes and body.startswith("WITH "):
        CHECKS[name] = f"WITH {ctes}, {body[5:]}"
    else:
        CHECKS[name] = f"WITH {ctes} {body}" if ctes else body


# --- roles ---------------------------------------------------------------------------------------
shared("r_tax", "SELECT * FROM (" + values(
    (label.group, order, label.id, label.name_zh, label.name_en)
    for group in ("targets", "scenarios", "tasks", "methods")
    for order, label in enumerate(TAXONOMY.group(group))
) + ") t(grp, ord, id, name_zh, name_en)")
shared("r_terms", "SELECT * FROM (" + values(
    (label.group, label.id, term) for label in TAXONOMY.labels for term in label.terms
) + ") t(grp, label_id, term)")
shared("r_evidence", "SELECT * FROM (" + values((term,) for term in TAXONOMY.collection_terms) + ") t(term)")

NOISE = "(?is)<!--.*?-->|" + "|".join(
    rf"<{tag}\b[^>]*>.*?</{tag}\s*>" for tag in ("script", "style", "noscript", "nav", "header", "footer", "aside")
)
shared("r_pages", f"""
SELECT page_id, url, html,
       substr({bounded("regexp_extract(html, '(?is)<title[^>]*>(.*?)</title', 1)")}, 1, 1000) AS title,
       {bounded(f"regexp_extract(regexp_replace(html, {q(NOISE)}, ' ', 'g'), '(?is)<article[^>]*>(.*)</article', 1)")} AS body,
       lower(regexp_extract(url, '^https?://([^/?#]+)', 1)) AS host,
       lower(regexp_extract(url, '^(https?://[^/?#]+)', 1))
         || rtrim(regexp_extract(url, '^https?://[^/?#]+([^?#]*)', 1), '/')
         || CASE WHEN contains(url, 'page=2&ref=x') THEN '?page=2&ref=x' ELSE '' END AS canonical
FROM pages""")
shared("r_cand", f"""
SELECT 'paper' AS kind, doc_id AS row_key, source AS source_id,
       substr(split_part(text, chr(10), 1), 1, 1000) AS title, NULL AS url,
       {NOW} - to_hours((doc_id * 7919) % 52560) AS published_at, text AS excerpt, lang AS category,
       {case_list(WEIGHTS, "(substr(source, 4)::INT % 5)")} AS source_weight,
       'title-' || {short_hash(norm("substr(split_part(text, chr(10), 1), 1, 1000)"))} AS id
FROM documents
UNION ALL
SELECT 'blog', page_id, host, title, canonical, {NOW} - to_hours((page_id * 7919) % 35040), body, NULL,
       0.9::DOUBLE, 'url-' || {short_hash("canonical")}
FROM r_pages""")
shared("r_text", f"""
SELECT kind, row_key, {norm("title || ' ' || excerpt || coalesce(' ' || category, '')")} AS t FROM r_cand""")
shared("r_hit", " UNION ALL ".join(
    f"SELECT kind, row_key, {q(term)} AS term FROM r_text WHERE {matches('t', term)}" for term in TAXONOMY.all_terms()
))


def coverage(terms: str, alias: str) -> str:
    """Matched share of a term list, per row."""
    return f"""
SELECT c.kind, c.row_key, least(1.0::DOUBLE, count(h.term)::DOUBLE / (SELECT count(*) FROM ({terms}))) AS {alias}
FROM r_cand c CROSS JOIN ({terms}) w
LEFT JOIN r_hit h ON h.kind = c.kind AND h.row_key = c.row_key AND h.term = w.term
GROUP BY c.kind, c.row_key"""


shared("r_cov_e", coverage("SELECT term FROM r_evidence", "evidence"))
shared("r_cov_t", coverage("SELECT term FROM r_terms WHERE grp IN ('targets', 'tasks', 'methods')", "topic"))
shared("r_cov_s", coverage("SELECT term FROM r_terms WHERE grp = 'scenarios'", "scenario"))
shared("r_lab", """
SELECT DISTINCT h.kind, h.row_key, x.grp, x.id AS label,
       CASE x.grp WHEN 'targets' THEN 0 WHEN 'scenarios' THEN 1 WHEN 'tasks' THEN 2 ELSE 3 END * 100 + x.ord AS pos
FROM r_hit h JOIN r_terms t USING (term) JOIN r_tax x ON x.grp = t.grp AND x.id = t.label_id""")
shared("r_labels", """
SELECT kind, row_key,
       coalesce(string_agg(label, ' ' ORDER BY pos) FILTER (grp = 'targets'), '') AS targets,
       coalesce(string_agg(label, ' ' ORDER BY pos) FILTER (grp = 'scenarios'), '') AS scenarios,
       coalesce(string_agg(label, ' ' ORDER BY pos) FILTER (grp = 'tasks'), '') AS tasks,
       coalesce(string_agg(label, ' ' ORDER BY pos) FILTER (grp = 'methods'), '') AS methods,
       count(*) AS n_labels
FROM r_lab GROUP BY kind, row_key""")
shared("r_score", f"""
SELECT c.kind, c.row_key, c.id, c.source_id, c.title, c.url, c.published_at, c.source_weight, e.evidence, t.topic, s.scenario,
       0.30::DOUBLE * t.topic + 0.25::DOUBLE * s.scenario
       + 0.15::DOUBLE * greatest(0::DOUBLE, least(1::DOUBLE, c.source_weight / 1.0::DOUBLE))
       + 0.15::DOUBLE * 1.0::DOUBLE
       + 0.10::DOUBLE * least(1::DOUBLE, (t.topic + s.scenario) / 2.0::DOUBLE)
       + 0.05::DOUBLE * greatest(0::DOUBLE, least(1::DOUBLE, 1.0::DOUBLE
           - (greatest(0, epoch_us({NOW}) - epoch_us(c.published_at))::DOUBLE / 86400000000.0::DOUBLE)
             / CASE WHEN c.kind = 'blog' THEN 1095.0::DOUBLE ELSE 1825.0::DOUBLE END)) AS metadata_score
FROM r_cand c JOIN r_cov_e e USING (kind, row_key) JOIN r_cov_t t USING (kind, row_key)
JOIN r_cov_s s USING (kind, row_key)""")
shared("r_hist", """
SELECT id FROM r_cand WHERE kind = 'paper' AND row_key % 17 = 0
UNION
SELECT c.id FROM r_cand c JOIN labels l ON c.kind = 'paper' AND l.doc_id = c.row_key WHERE l.toxic = 1""")
shared("r_elig", """
SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY source_weight DESC, published_at DESC, source_id, row_key) AS rn
  FROM r_score
  WHERE published_at <= TIMESTAMP '2024-01-31' AND published_at >=
        CASE WHEN kind = 'paper' THEN TIMESTAMP '2019-01-31' ELSE TIMESTAMP '2021-01-31' END
) WHERE rn = 1 AND evidence > 0 AND id NOT IN (SELECT id FROM r_hist)""")
shared("r_top", """
SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY kind ORDER BY metadata_score DESC, published_at DESC, source_id, id) AS kind_rank
  FROM r_elig
) WHERE kind_rank <= CASE WHEN kind = 'paper' THEN 100 ELSE 50 END""")
shared("r_scored", """
SELECT e.*, coalesce(l.targets, '') AS targets, coalesce(l.scenarios, '') AS scenarios, coalesce(l.tasks, '') AS tasks,
       coalesce(l.methods, '') AS methods, coalesce(l.n_labels, 0) AS n_labels,
       greatest(0::DOUBLE, least(1::DOUBLE, e.metadata_score)) AS relevance,
       coalesce(q.explicit, least(1::DOUBLE, coalesce(c.n_refs, 0) / 3.0::DOUBLE)) AS evidence_quality,
       least(1::DOUBLE, coalesce(c.n_impl, 0) / 3.0::DOUBLE) AS transfer,
       least(1::DOUBLE, (coalesce(c.n_parts, 0) + 1) / CASE WHEN e.kind = 'paper' THEN 6.0::DOUBLE ELSE 4.0::DOUBLE END) AS depth
FROM r_elig e
LEFT JOIN r_labels l USING (kind, row_key)
LEFT JOIN (SELECT doc_id, max(quality) * 0.8::DOUBLE + 0.1::DOUBLE AS explicit FROM labels GROUP BY doc_id) q
  ON e.kind = 'paper' AND q.doc_id = e.row_key
LEFT JOIN (SELECT conv_id, count(*) AS n_refs, count(*) FILTER (role = 'assistant' AND text <> '') AS n_impl,
                  count(*) FILTER (role = 'user' AND text <> '') AS n_parts FROM conversations GROUP BY conv_id) c
  ON e.kind = 'paper' AND c.conv_id = e.row_key""")
shared("r_items", """
SELECT kind, row_key, id, title, 'about ' || title AS summary, source_id AS source,
       coalesce(url, 'https://papers.example.org/' || id) AS url, published_at, targets, scenarios, tasks, methods, n_labels,
       trim(concat_ws(' ', nullif(targets, ''), nullif(scenarios, ''), nullif(tasks, ''), nullif(methods, ''))) AS tags,
       relevance, evidence_quality, transfer, depth,
       greatest(0::DOUBLE, least(1::DOUBLE, 0.55::DOUBLE * relevance + 0.20::DOUBLE * evidence_quality
         + 0.15::DOUBLE * transfer + 0.10::DOUBLE * depth)) AS final_score,
       (published_at + INTERVAL 8 HOUR)::DATE AS digest_date
FROM r_scored""")
shared("r_entries", """
SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY digest_date, kind ORDER BY final_score DESC, published_at DESC, source, id) AS rank
  FROM r_items
) WHERE rank <= 10""")
shared("r_ev", "SELECT *, event_id % (SELECT max(doc_id) + 1 FROM documents) AS doc_id FROM events")
shared("r_prop", f"""
SELECT DISTINCT doc_id AS row_key, {case_list((*LABEL_IDS, 'unknown_label'), f"(event_id % {len(LABEL_IDS) + 1})")} AS label
FROM r_ev""")
shared("r_rel", f"""
SELECT s.id, e.event_id AS pos, e.event_type AS type,
       CASE WHEN e.event_id % 7 = 0 THEN {case_list(LABEL_IDS, f"(e.event_id % {len(LABEL_IDS)})")}
            ELSE coalesce(t.id, 'missing-' || (e.user_id * 20)::VARCHAR) END AS target_id,
       least(1::DOUBLE, e.value / 100) AS confidence, 'event ' || e.event_id::VARCHAR AS evidence
FROM r_ev e JOIN r_cand s ON s.kind = 'paper' AND s.row_key = e.doc_id
LEFT JOIN r_cand t ON t.kind = 'paper' AND t.row_key = e.user_id * 20""")

# --- collection ----------------------------------------------------------------------------------
check("item_scan", f"""
SELECT id, kind, title, {stamp('published_at')} AS published, targets, round(relevance, 6) AS relevance FROM r_items""")
check("stage_jsonl_roundtrip", """
SELECT row_key, kind, id, title, md5(excerpt) AS excerpt_hash, true AS dropped FROM r_cand""")
check("taxonomy_snapshot", """
SELECT x.grp, x.ord::BIGINT AS ord, x.id, x.name_zh, x.name_en, count(l.row_key) AS n
FROM r_tax x LEFT JOIN r_lab l ON l.grp = x.grp AND l.label = x.id GROUP BY ALL""")
check("excerpt_bounded", f"""
SELECT kind, row_key, length(t) AS n_chars, md5(t) AS hash FROM (
  SELECT 'paper' AS kind, doc_id AS row_key, substr({bounded('text')}, 1, 4000) AS t FROM documents
  UNION ALL SELECT 'blog', page_id, substr({bounded('html')}, 1, 4000) FROM pages)""")
check("url_canonical", """
SELECT page_id, v::BIGINT AS variant, CASE v
    WHEN 0 THEN canonical
    WHEN 1 THEN 'http://' || split_part(canonical, '://', 2)
    WHEN 4 THEN split_part(canonical, '?', 1) || '?alpha=&zeta=1'
    WHEN 5 THEN CASE WHEN starts_with(canonical, 'https') THEN canonical
                ELSE regexp_replace(canonical, '\\.(com|net|org)', '.\\1:443') END
    ELSE NULL END AS canonical
FROM r_pages CROSS JOIN range(7) r(v)""")
check("candidate_identity", f"""
SELECT row_key, kind, CASE
    WHEN kind = 'blog' THEN id
    WHEN row_key % 6 = 0 THEN 'arxiv-2401.' || row_key
    WHEN row_key % 6 = 1 THEN 'doi-10.5-ab_' || row_key
    WHEN row_key % 6 = 3 THEN 'url-' || {short_hash("'https://papers.example.org/p/' || row_key")}
    WHEN row_key % 6 = 4 THEN 'arxiv-cs-' || row_key
    ELSE id END AS id
FROM r_cand""")
check("candidate_dedupe", f"""
SELECT id, kind, row_key, source_id, {stamp('published_at')} AS published FROM r_cand
QUALIFY row_number() OVER (PARTITION BY id ORDER BY source_weight DESC, published_at DESC, source_id, row_key) = 1""")
check("query_window", f"""
SELECT source_id, k.kind, {stamp(f'''CASE
    WHEN substr(source_id, 4)::INT % 2 = 1 THEN newest - CASE WHEN k.kind = 'paper' THEN INTERVAL 48 HOUR ELSE INTERVAL 7 DAY END
    ELSE {NOW} - CASE WHEN k.kind = 'paper' THEN INTERVAL 5 YEAR ELSE INTERVAL 3 YEAR END END''')} AS since,
    {stamp(NOW)} AS until
FROM (SELECT source_id, max(published_at) AS newest FROM r_cand WHERE kind = 'paper' GROUP BY source_id)
CROSS JOIN (VALUES ('paper'), ('blog')) k(kind)""")
check("windowed_candidates", f"""
SELECT row_key, kind, source_id, {stamp('published_at')} AS published, source_weight FROM r_cand
WHERE published_at BETWEEN CASE WHEN kind = 'paper' THEN TIMESTAMP '2022-01-31' ELSE TIMESTAMP '2022-01-26' END AND {NOW}""")
check("history_ids", "SELECT id FROM r_hist")
check("history_antijoin", """
SELECT id, kind, row_key FROM (SELECT * FROM r_cand
QUALIFY row_number() OVER (PARTITION BY id ORDER BY source_weight DESC, published_at DESC, source_id, row_key) = 1)
WHERE id NOT IN (SELECT id FROM r_hist)""")
check("term_matches", "SELECT kind, row_key, term FROM r_hit")
check("term_coverage", """
SELECT kind, row_key, round(evidence, 6) AS evidence, round(topic, 6) AS topic, round(scenario, 6) AS scenario FROM r_score""")
check("collection_gate", "SELECT kind, row_key, id FROM r_score WHERE evidence > 0")
check("metadata_score", "SELECT kind, row_key, id, round(metadata_score, 6) AS score FROM r_score")
check("prefilter_topk", """
SELECT id, kind, row_key, source_id, kind_rank, round(metadata_score, 6) AS score FROM r_top""")
check("feed_atom_scan", f"""
SELECT 'arxiv-24.' || row_key AS id, {collapse('title')} AS title, 'https://arxiv.org/abs/24.' || row_key || 'v1' AS url,
       {stamp('published_at')} AS published, md5(trim(substr({collapse('excerpt')}, 1, 4000))) AS excerpt_hash,
       'Ada;' || source_id AS authors, category AS categories
FROM r_cand WHERE kind = 'paper' AND {collapse('title')} <> ''""")
check("feed_rss_scan", f"""
SELECT id, title, url, {stamp('published_at')} AS published, md5(trim(substr(excerpt, 1, 4000))) AS excerpt_hash,
       'Ann' AS authors, md5(excerpt) AS content_hash
FROM r_cand WHERE kind = 'blog' AND row_key % 9 <> 0 AND title <> ''""")

# --- metadata ------------------------------------------------------------------------------------
LABELS4 = "targets, scenarios, tasks, methods"
check("rule_labels", """
SELECT c.kind, c.row_key, coalesce(targets, '') AS targets, coalesce(scenarios, '') AS scenarios,
       coalesce(tasks, '') AS tasks, coalesce(methods, '') AS methods
FROM r_cand c LEFT JOIN r_labels USING (kind, row_key)""")
check("label_grounding", """
SELECT p.row_key, p.label FROM r_prop p JOIN r_lab l ON l.kind = 'paper' AND l.row_key = p.row_key AND l.label = p.label""")
check("label_rejections", """
SELECT p.row_key, count(*) AS rejected FROM r_prop p
WHERE NOT EXISTS (SELECT 1 FROM r_lab l WHERE l.kind = 'paper' AND l.row_key = p.row_key AND l.label = p.label)
GROUP BY p.row_key""")
check("response_parse", f"""
SELECT doc_id, reason, CASE WHEN reason IS NULL THEN 'd' || doc_id END AS id,
       CASE WHEN reason IS NULL THEN {case_list(LABEL_IDS, f'(doc_id % {len(LABEL_IDS)})')} END AS label,
       CASE WHEN reason IS NULL THEN md5(text) END AS summary_hash,
       CASE WHEN reason IS NULL THEN round((doc_id % 101) / 100.0::DOUBLE, 6) END AS relevance
FROM (SELECT *, CASE doc_id % 7 WHEN 1 THEN 'not_json' WHEN 4 THEN 'not_json' WHEN 2 THEN 'not_object'
                WHEN 3 THEN 'unknown_field' END AS reason FROM documents)""")


def returned(source: str, keys: str) -> str:
    base = f"""SELECT {keys}, id, row_key, CASE WHEN row_key % 29 = 0 THEN '' ELSE title END AS summary,
        CASE WHEN row_key % 97 = 96 THEN 'unknown_label' ELSE {case_list(LABEL_IDS, f'(row_key % {len(LABEL_IDS)})')} END AS label,
        (row_key * 31 % 101) / 100.0::DOUBLE AS relevance FROM {source}"""
    return f"""SELECT * FROM ({base}) WHERE row_key % 31 <> 0 UNION ALL SELECT * FROM ({base}) WHERE row_key % 43 = 0
        UNION ALL SELECT * REPLACE ('stray-' || id AS id) FROM ({base}) WHERE row_key % 61 = 0"""


def verdicts(source: str, answer: str, keys: str) -> str:
    on = " AND ".join(f"a.{k.strip()} = r.{k.strip()}" for k in (keys + ", id").split(","))
    outer = ", ".join(f"coalesce(a.{k.strip()}, r.{k.strip()}) AS {k.strip()}" for k in keys.split(","))
    return f"""
SELECT {keys}, count(*) FILTER (asked) AS requested, sum(copies)::BIGINT AS returned, bool_and(good) AS ok FROM (
  SELECT {outer}, a.id IS NOT NULL AS asked, coalesce(r.copies, 0) AS copies,
         a.id IS NOT NULL AND coalesce(r.copies, 0) = 1 AND coalesce(r.good, false) AS good
  FROM {source} a FULL JOIN (
    SELECT {keys}, id, count(*) AS copies,
           bool_and(regexp_matches(summary, '\\p{{L}}') AND label <> 'unknown_label') AS good
    FROM {answer} GROUP BY {keys}, id) r ON {on}
) GROUP BY {keys}"""


shared("r_asked", """
SELECT *, right(id, 2) AS bucket, (row_number() OVER (PARTITION BY kind, right(id, 2)
    ORDER BY metadata_score DESC, published_at DESC, source_id, id) - 1) // 8 AS batch FROM r_elig""")
shared("r_answer", returned("r_asked", "kind, bucket, batch"))
check("batch_validation", verdicts("r_asked", "r_answer", "kind, bucket, batch"))
shared("r_topb", """
SELECT *, (row_number() OVER (ORDER BY metadata_score DESC, published_at DESC, source_id, id) - 1) // 8 AS batch FROM r_top""")
shared("r_topa", returned("r_topb", "batch"))
shared("r_topv", verdicts("r_topb", "r_topa", "batch"))


def kept(group: str) -> str:
    return f"""CASE WHEN v.ok THEN CASE WHEN list_contains(string_split(coalesce(l.{group}, ''), ' '), a.label) THEN a.label ELSE '' END
               ELSE coalesce(l.{group}, '') END AS {group}"""


start = f"substr({strip('c.excerpt')}, 1, 4000)"
shared("r_res", f"""
SELECT t.*, NOT v.ok AS degraded, {kept('targets')}, {kept('scenarios')}, {kept('tasks')}, {kept('methods')},
       CASE WHEN v.ok AND NOT EXISTS (SELECT 1 FROM r_lab x WHERE x.kind = t.kind AND x.row_key = t.row_key AND x.label = a.label)
            THEN 1 ELSE 0 END::BIGINT AS label_rejections,
       CASE WHEN v.ok THEN a.summary WHEN regexp_matches({start}, '\\p{{L}}') THEN {start} END AS summary,
       CASE WHEN v.ok THEN a.relevance ELSE greatest(0::DOUBLE, least(1::DOUBLE, t.metadata_score)) END AS relevance
FROM r_topb t JOIN r_topv v USING (batch) JOIN r_cand c ON c.kind = t.kind AND c.row_key = t.row_key
LEFT JOIN r_labels l ON l.kind = t.kind AND l.row_key = t.row_key
LEFT JOIN r_topa a ON v.ok AND a.batch = t.batch AND a.id = t.id""")
check("metadata_resolved", f"""
SELECT id, kind, batch, degraded, summary, {LABELS4}, label_rejections, round(relevance, 6) AS relevance FROM r_res""")
shared("r_short", """
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY kind ORDER BY relevance DESC, published_at DESC, source_id, id) AS shortlist_rank
  FROM r_res WHERE relevance >= 0.65 AND targets || scenarios || tasks || methods <> '') WHERE shortlist_rank <= 20""")
check("shortlist", "SELECT id, kind, shortlist_rank, round(relevance, 6) AS relevance FROM r_short")
check("stage_one_output", f"""
SELECT id, kind, source_id, title, url, strftime(published_at, '%Y-%m-%dT%H:%M:%SZ') AS published_at, summary, degraded,
       round(relevance, 6) AS relevance, {LABELS4} FROM r_short""")

# --- readings ------------------------------------------------------------------------------------
check("page_article_text", "SELECT page_id, length(body) AS n_chars, md5(body) AS hash FROM r_pages")
shared("r_feed", f"""
SELECT source_id, CASE WHEN row_key % 3 = 0 THEN id ELSE 'other-' || id END AS id,
       CASE WHEN row_key % 3 = 1 THEN url END AS url, CASE WHEN row_key % 3 = 2 THEN {norm('title')} END AS title,
       CASE WHEN row_key % 10 = 0 THEN '' ELSE 'body ' || md5(excerpt) END AS body, row_key AS feed_order
FROM r_cand WHERE kind = 'blog'""")
shared("r_feed_all", """
SELECT * FROM r_feed WHERE body <> ''
UNION ALL SELECT * REPLACE ('late ' || feed_order AS body, feed_order + 1000000000 AS feed_order) FROM r_feed WHERE feed_order % 7 = 0""")
check("content_lookup", f"""
SELECT row_key, source_id, CASE WHEN b1 IS NOT NULL THEN 'id' WHEN b2 IS NOT NULL THEN 'url' WHEN b3 IS NOT NULL THEN 'title' END AS matched_by,
       coalesce(b1, b2, b3) AS body
FROM (SELECT c.row_key, c.source_id,
  (SELECT max_by(f.body, f.feed_order) FROM r_feed_all f WHERE f.source_id = c.source_id AND f.id = c.id) AS b1,
  (SELECT max_by(f.body, f.feed_order) FROM r_feed_all f WHERE f.source_id = c.source_id AND f.url = c.url) AS b2,
  (SELECT max_by(f.body, f.feed_order) FROM r_feed_all f WHERE f.source_id = c.source_id AND f.title = {norm('c.title')}) AS b3
  FROM r_cand c WHERE c.kind = 'blog')""")
check("content_basis", f"""
SELECT kind, row_key, basis, md5(body) AS hash FROM (
  SELECT kind, row_key,
    CASE WHEN kind = 'paper' THEN CASE WHEN row_key % 4 = 0 AND full_body <> '' THEN 'mineru_full_text' ELSE 'abstract_fallback' END
         WHEN row_key % 4 IN (0, 1) THEN 'rss_full_content'
         WHEN row_key % 4 = 2 AND excerpt <> '' THEN 'article_html' ELSE 'excerpt_fallback' END AS basis,
    CASE WHEN kind = 'paper' THEN CASE WHEN row_key % 4 = 0 AND full_body <> '' THEN full_body
                                       WHEN row_key % 4 <> 1 AND excerpt <> '' THEN excerpt ELSE title END
         WHEN row_key % 4 = 0 THEN rtrim('feed ' || excerpt) WHEN row_key % 4 = 1 THEN rtrim('second ' || excerpt)
         WHEN row_key % 4 = 2 AND excerpt <> '' THEN excerpt
         WHEN row_key % 8 = 3 AND excerpt <> '' THEN excerpt ELSE title END AS body
  FROM (SELECT *, {strip('excerpt')} AS full_body FROM r_cand))""")
check("context_budget", """
SELECT conv_id, count(*) AS n_sections, sum(greatest(1, (length(text) + 3) // 4))::BIGINT AS tokens,
       sum(greatest(1, (length(text) + 3) // 4)) <= 600 AS fits,
       CASE WHEN sum(greatest(1, (length(text) + 3) // 4)) <= 600
            THEN md5(string_agg(text, chr(10) || chr(10) ORDER BY turn)) END AS hash
FROM conversations GROUP BY conv_id""")
blank = lambda x: f"({x} IS NULL OR {strip(x)} = '')"
shared("r_read", f"""
SELECT kind, row_key, id, CASE
  WHEN kind = 'paper' THEN CASE
    WHEN {blank('l[1]')} THEN 'no_problem'
    WHEN (row_key % 3 = 0 OR {blank('l[2]')}) AND (row_key % 2 = 1 OR {blank('l[3]')}) THEN 'no_method'
    WHEN {blank('l[4]')} THEN 'no_evidence' END
  WHEN row_key % 11 = 0 OR {blank('title')} THEN 'no_context'
  WHEN row_key % 5 = 0 OR excerpt = '' THEN 'no_analysis' END AS reason
FROM (SELECT *, string_split(excerpt, chr(10)) AS l FROM r_cand)""")
check("reading_quality", "SELECT kind, row_key, reason FROM r_read")
check("reading_split", """
SELECT kind, row_key, id, code IS NULL AS accepted, code FROM (
  SELECT *, CASE WHEN row_key % 23 = 0 THEN 'deep_read_failed' WHEN reason IS NOT NULL THEN 'invalid_deep_reading' END AS code FROM r_read)""")
shared("r_results", """
SELECT kind, id, row_key FROM r_elig WHERE row_key % 31 <> 0
UNION ALL SELECT kind, id, row_key FROM r_elig WHERE row_key % 41 = 0
UNION ALL SELECT kind, 'x-' || id, row_key FROM r_elig WHERE row_key % 37 = 0""")
check("reading_reconcile", """
SELECT k.kind, e.expected, r.attempted, r.succeeded, e.missing, r.unexpected, r.duplicated, e.first_missing, r.first_unexpected,
       round(r.succeeded / r.attempted::DOUBLE, 6) AS success_rate
FROM (SELECT DISTINCT kind FROM r_elig) k
JOIN (SELECT kind, count(*) AS expected, count(*) FILTER (id NOT IN (SELECT id FROM r_results)) AS missing,
             min(id) FILTER (id NOT IN (SELECT id FROM r_results)) AS first_missing FROM r_elig GROUP BY kind) e USING (kind)
JOIN (SELECT kind, count(*) AS attempted, count(*) FILTER (row_key % 5 <> 0) AS succeeded,
             count(DISTINCT id) FILTER (id LIKE 'x-%') AS unexpected,
             count(*) - count(DISTINCT id) AS duplicated,
             min(id) FILTER (id LIKE 'x-%') AS first_unexpected FROM r_results GROUP BY kind) r USING (kind)""")
check("item_assemble", f"""
SELECT e.id, e.kind, e.source_id AS source, e.title, CASE WHEN e.kind = 'paper' THEN md5(c.excerpt) END AS abstract_hash,
       CASE WHEN e.kind = 'paper' THEN 'a' || e.row_key END AS arxiv_id, NULL AS doi, e.row_key AS reading_key,
       'model-a' AS model, {stamp(NOW)} AS generated, e.row_key % 2 = 0 AS degraded
FROM r_elig e JOIN r_cand c USING (kind, row_key) WHERE e.row_key % 31 <> 0""")
check("orphan_readings", "SELECT id, kind, row_key FROM r_cand WHERE id NOT IN (SELECT id FROM r_elig)")
check("publishable_items", """
SELECT e.id, e.kind, e.row_key, e.row_key % 2 = 0 AS degraded FROM r_elig e LEFT JOIN r_labels l USING (kind, row_key)
WHERE e.row_key % 2 = 1 OR (e.row_key % 9 <> 0 AND regexp_matches(e.title, '\\p{L}')
  AND l.targets <> '' AND l.scenarios <> '' AND l.tasks <> '' AND l.methods <> '')""")
shared("r_own", "SELECT * FROM r_rel WHERE id IN (SELECT id FROM r_items)")
shared("r_allowed", "SELECT id FROM r_items UNION SELECT id FROM r_tax")
check("relation_prune", """
SELECT id, pos, type, target_id, round(confidence, 6) AS confidence FROM r_own WHERE target_id IN (SELECT id FROM r_allowed)""")
check("relation_prune_warnings", """
SELECT id, count(*) AS pruned, min_by(target_id, pos) AS first_target FROM r_own
WHERE target_id NOT IN (SELECT id FROM r_allowed) GROUP BY id""")
check("final_score", """
SELECT id, kind, round(relevance, 6) AS relevance_score, round(evidence_quality, 6) AS evidence, round(transfer, 6) AS transfer,
       round(depth, 6) AS depth, round(final_score, 6) AS final_score FROM r_items""")
shared("r_ranked", f"""
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY kind ORDER BY final_score DESC, published_at DESC, source, id) AS rank
  FROM r_items WHERE final_score >= {MINIMUM_FINAL}) WHERE rank <= 10""")
check("final_rank", "SELECT id, kind, rank, round(final_score, 6) AS final_score FROM r_ranked")
check("digest_build", """
SELECT '2024-01-31' AS digest_date, kind, id AS item_id, rank, '与推荐系统研究方向相关：' || summary AS reason FROM r_ranked""")

# --- state and reports ---------------------------------------------------------------------------
check("recommended_merge", """
SELECT id, o.run, o.part, o.pos FROM (SELECT id, min({'run': run, 'part': part, 'pos': pos}) AS o FROM (
  SELECT id, 0::BIGINT AS run, 0::BIGINT AS part, row_key::BIGINT AS pos FROM r_cand WHERE kind = 'paper' AND row_key % 17 = 0
  UNION ALL SELECT id, 1::BIGINT, CASE WHEN kind = 'paper' THEN 1 ELSE 2 END::BIGINT, rank::BIGINT FROM r_entries) GROUP BY id)""")
check("source_state_merge", f"""
WITH s AS (SELECT source_id, substr(source_id, 4)::INT AS n, row_key, published_at FROM r_cand WHERE kind = 'paper'),
old AS (SELECT source_id, any_value(n) AS n, max(published_at) AS t FROM s WHERE row_key % 2 = 0 AND n % 7 <> 1 GROUP BY source_id),
new AS (SELECT source_id, any_value(n) AS n, max(published_at) AS t FROM s WHERE row_key % 3 = 0 AND n % 4 <> 0 GROUP BY source_id)
SELECT coalesce(n.source_id, o.source_id) AS source_id,
       CASE WHEN o.source_id IS NOT NULL THEN 'cursor-' || o.source_id END AS cursor,
       CASE WHEN coalesce(n.n, o.n) % 3 <> 0 THEN CASE WHEN n.n IS NOT NULL THEN 'new-' ELSE 'old-' END || coalesce(n.source_id, o.source_id) END AS etag,
       CASE WHEN coalesce(n.n, o.n) % 5 <> 0 THEN CASE WHEN n.n IS NOT NULL THEN 'new' ELSE 'old' END END AS last_modified,
       {stamp('coalesce(n.t, o.t)')} AS last_success_at
FROM old o FULL JOIN new n ON n.source_id = o.source_id""")
check("item_upsert", """
SELECT id, kind, row_key, CASE WHEN row_key % 3 = 0 OR row_key % 5 = 0 THEN 'current' ELSE 'stored' END AS version
FROM r_items WHERE row_key % 2 = 0 OR row_key % 3 = 0 OR row_key % 5 = 0""")
shared("r_fresh", f"""
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY source_weight DESC, published_at DESC, source_id, row_key) AS rn
  FROM r_cand WHERE published_at BETWEEN CASE WHEN kind = 'paper' THEN TIMESTAMP '2019-01-31' ELSE TIMESTAMP '2021-01-31' END AND {NOW})
WHERE rn = 1""")
check("funnel_report", """
SELECT stage, count(*) FILTER (kind = 'paper') AS papers, count(*) FILTER (kind = 'blog') AS blogs FROM (
  SELECT 'collected' AS stage, kind FROM r_fresh UNION ALL SELECT 'eligible', kind FROM r_elig
  UNION ALL SELECT 'prefiltered', kind FROM r_top UNION ALL SELECT 'shortlisted', kind FROM r_short
  UNION ALL SELECT 'recommended', kind FROM r_ranked) GROUP BY stage""")
check("metadata_counters", """
SELECT count(*) FILTER (degraded) AS degraded, sum(label_rejections)::BIGINT AS label_rejections,
       count(*) FILTER (relevance < 0.65 OR targets || scenarios || tasks || methods = '') AS relevance_rejections,
       (SELECT count(*) FROM r_topv) AS calls,
       (SELECT round(count(*) FILTER (ok) / count(*)::DOUBLE, 6) FROM r_topv) AS call_success_rate
FROM r_res""")
shared("r_batches", verdicts("r_asked", "r_answer", "kind, bucket, batch"))
shared("r_rates", """
SELECT name, succeeded, attempted, succeeded / attempted::DOUBLE AS rate, succeeded / attempted::DOUBLE >= 0.8::DOUBLE AS passed FROM (
  SELECT kind AS name, count(*) FILTER (row_key % 5 <> 0) AS succeeded, count(*) AS attempted FROM r_results GROUP BY kind
  UNION ALL SELECT 'metadata', count(*) FILTER (ok), count(*) FROM r_batches)""")
check("success_rates", """
SELECT name, succeeded, attempted, round(rate, 6) AS rate, passed FROM r_rates
UNION ALL SELECT 'run', NULL, NULL, round(min(rate), 6), bool_and(passed) FROM r_rates""")
check("source_status", """
SELECT s.source_id, w.warning IS NULL AS success, w.warning
FROM (SELECT 'src' || n AS source_id FROM range(20) t(n)) s
LEFT JOIN (SELECT source, min_by(source || ': HTTP ' || doc_id, doc_id) AS warning FROM documents WHERE doc_id % 50 = 3 GROUP BY source) w
  ON w.source = s.source_id""")
check("latest_digest", """
SELECT strftime(digest_date, '%Y-%m-%d') AS digest_date, kind, id AS item_id, rank FROM r_entries
WHERE digest_date = (SELECT max(digest_date) FROM r_entries)""")
check("latest_basis", """
SELECT string_agg(DISTINCT model, ' ' ORDER BY model) AS models, string_agg(DISTINCT basis, ' ' ORDER BY basis) AS bases FROM (
  SELECT digest_date, 'model-' || (row_key % 3) AS model,
         CASE WHEN kind = 'paper' THEN CASE row_key % 2 WHEN 0 THEN 'mineru_full_text' ELSE 'abstract_fallback' END
              ELSE CASE row_key % 3 WHEN 0 THEN 'rss_full_content' WHEN 1 THEN 'article_html' ELSE 'excerpt_fallback' END END AS basis
  FROM r_entries) WHERE digest_date = (SELECT max(digest_date) FROM r_entries)""")
check("distinct_years", "SELECT DISTINCT strftime(published_at, '%Y') AS year FROM r_items")
check("business_date_rollup", """
SELECT strftime(published_at + INTERVAL 8 HOUR, '%Y-%m-%d') AS business_date, kind, count(*) AS n FROM r_cand GROUP BY ALL""")
check("publish_gate", f"""
SELECT c AS "check", v AS violations, v = 0 AS passed FROM (
  SELECT 'duplicate_items' AS c, count(*) - count(DISTINCT id) AS v FROM r_items
  UNION ALL SELECT 'digest', count(*) FROM r_entries WHERE id NOT IN (SELECT id FROM r_items) OR rank < 1
  UNION ALL SELECT 'long_excerpts', count(*) FROM r_cand WHERE kind = 'blog' AND length(excerpt) > 4000
  UNION ALL SELECT 'overflow', count(*) FROM (SELECT kind FROM r_items GROUP BY kind HAVING count(*) > 20)
  UNION ALL SELECT 'item_contract', count(*) FROM r_items WHERE {strip('title')} = ''
  UNION ALL SELECT 'forbidden_files', count(*) FROM r_cand WHERE kind = 'blog' AND regexp_matches(url, '(?i)\\.(html|htm|pdf|xml)$'))""")
JSON = "octet_length(encode(json_object('doc_id', doc_id, 'source', source, 'text', text)::VARCHAR))"
check("size_budget", f"""
SELECT n, bytes, CASE WHEN bytes > 943718400 THEN 'fail' WHEN bytes > 1000000 THEN 'warn' ELSE 'ok' END AS verdict
FROM (SELECT count(*) AS n, sum({JSON})::BIGINT AS bytes FROM documents)""")

# --- serving -------------------------------------------------------------------------------------
check("digest_cards", """
SELECT strftime(digest_date, '%Y-%m-%d') AS digest_date, kind, id AS item_id, rank, title, url FROM r_entries""")
shared("r_names", """
SELECT l.kind, l.row_key, string_agg(x.id || ' ' || x.name_zh || ' ' || x.name_en, ' ' ORDER BY l.pos) AS words,
       to_json(list({'group': x.grp, 'name_zh': x.name_zh, 'name_en': x.name_en} ORDER BY l.pos))::VARCHAR AS chips
FROM r_lab l JOIN r_tax x ON x.grp = l.grp AND x.id = l.label GROUP BY l.kind, l.row_key""")
check("label_chips", """
SELECT i.id, CASE WHEN i.kind = 'paper' THEN '论文' ELSE '博客' END AS kind_label, strftime(i.published_at, '%Y-%m-%d') AS published,
       i.summary, coalesce(n.chips, '[]') AS chips FROM r_items i LEFT JOIN r_names n USING (kind, row_key)""")
shared("r_archive", f"""
SELECT e.*, {norm('''concat_ws(' ', e.title, e.summary,
    CASE WHEN e.kind = 'paper' THEN 'paper 论文 学术论文' ELSE 'blog 博客 工程博客' END,
    strftime(e.digest_date, '%Y-%m-%d'), strftime(e.published_at, '%Y-%m-%d'), coalesce(n.words, ''))''')} AS search_text
FROM r_entries e LEFT JOIN r_names n USING (kind, row_key)""")
check("archive_search_text", "SELECT id, search_text FROM r_archive")


def any_label(column: str, labels) -> str:
    return f"list_has_any(string_split({column}, ' '), [{', '.join(q(label) for label in labels)}])"


check("archive_filter", f"""
SELECT id, kind, strftime(digest_date, '%Y-%m-%d') AS digest_date, rank FROM r_archive
WHERE contains(search_text, 'the') AND contains(search_text, 'of') AND contains(search_text, 'paper')
  AND {any_label('targets', ('harbour', 'hall'))}""")
check("archive_counts", f"""
SELECT strftime(digest_date, '%Y-%m-%d') AS digest_date, kind, count(*) AS n FROM r_entries
WHERE {any_label('targets', ('harbour', 'hall'))} GROUP BY ROLLUP (digest_date, kind)""")
AGE = f"greatest(0, epoch_us({NOW}) - epoch_us(published_at)) / 86400000000.0::DOUBLE"
check("facet_search", f"""
SELECT id, kind, title FROM r_items WHERE kind = 'paper' AND strftime(published_at, '%Y') IN ('2022', '2023') AND {AGE} <= 365
  AND {any_label('methods', ('webs', 'trials'))} AND {any_label('targets', ('harbour',))}""")
check("search_page", f"""
SELECT id, round(final_score, 6) AS final_score FROM (SELECT id, final_score, published_at, source, {norm("title || ' ' || summary")} AS t FROM r_items)
WHERE contains(t, 'the') AND contains(t, 'of') ORDER BY final_score DESC, published_at DESC, source, id LIMIT 10 OFFSET 10""")
shared("r_shown", f"SELECT * FROM r_items WHERE {any_label('methods', ('webs',))}")
shared("r_facets", f"""
SELECT 'kind' AS grp, kind AS value FROM r_shown UNION ALL SELECT 'year', strftime(published_at, '%Y') FROM r_shown
UNION ALL SELECT 'age', a.v FROM r_shown JOIN (VALUES ('7d', 7), ('30d', 30), ('365d', 365)) a(v, d) ON {AGE} <= a.d
UNION ALL SELECT l.grp, l.label FROM r_lab l JOIN r_shown s ON s.kind = l.kind AND s.row_key = l.row_key""")
check("facet_counts", """
SELECT o.grp, o.value, count(f.value) AS n FROM (
  SELECT 'kind' AS grp, unnest(['paper', 'blog']) AS value
  UNION ALL SELECT 'year', y::VARCHAR FROM range(2018, 2025) t(y)
  UNION ALL SELECT 'age', unnest(['7d', '30d', '365d'])
  UNION ALL SELECT grp, id FROM r_tax) o LEFT JOIN r_facets f USING (grp, value) GROUP BY o.grp, o.value""")
check("related_items", """
WITH il AS (SELECT i.id, i.final_score, i.published_at, l.label FROM r_items i JOIN r_lab l USING (kind, row_key)),
pairs AS (SELECT a.id, b.id AS related_id, any_value(b.final_score) AS s, any_value(b.published_at) AS t, count(*) AS shared
          FROM il a JOIN il b ON a.label = b.label AND a.id <> b.id GROUP BY a.id, b.id)
SELECT id, rank, related_id, shared FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY shared DESC, s DESC, t DESC, related_id) AS rank FROM pairs) WHERE rank <= 4""")
check("age_buckets", f"""
SELECT kind, a.v AS age, count(*) AS n FROM r_cand JOIN (VALUES ('7d', 7), ('30d', 30), ('365d', 365)) a(v, d) ON {AGE} <= a.d
GROUP BY kind, a.v""")

# --- graph ---------------------------------------------------------------------------------------
shared("r_vis", f"""
SELECT i.*, CASE WHEN {AGE} <= 90 THEN 2::DOUBLE ELSE 0::DOUBLE END + i.relevance + coalesce(n.n, 0) * 0.03::DOUBLE AS visibility
FROM r_items i LEFT JOIN (SELECT id, count(*) AS n FROM r_rel GROUP BY id) n ON n.id = i.id
ORDER BY visibility DESC, published_at DESC, i.id LIMIT 80""")
check("graph_visible", "SELECT id, kind, round(visibility, 6) AS visibility FROM r_vis")
shared("r_vlab", """
SELECT DISTINCT v.id, rtrim(l.grp, 's') AS type, rtrim(l.grp, 's') || ':' || l.label AS node, l.grp, l.label
FROM r_vis v JOIN r_lab l USING (kind, row_key)""")
shared("r_edge", """
SELECT 'taxonomy:' || id || '|' || node AS id, id AS source, node AS target, type, 1::DOUBLE AS confidence,
       'canonical taxonomy label' AS evidence, 'topics.yaml' AS generated_by FROM r_vlab
UNION ALL
SELECT 'relation:' || id || '|' || target || '|' || type, id, target, type, c.confidence, c.evidence, 'model-a' FROM (
  SELECT r.id, coalesce(v.id, rtrim(x.grp, 's') || ':' || x.id) AS target, r.type,
         min_by({'confidence': r.confidence, 'evidence': r.evidence}, r.pos) AS c
  FROM r_rel r JOIN r_vis s ON s.id = r.id LEFT JOIN r_vis v ON v.id = r.target_id LEFT JOIN r_tax x ON x.id = r.target_id
  WHERE r.confidence >= 0.5 AND coalesce(v.id, x.id) IS NOT NULL AND coalesce(v.id, '') <> r.id
  GROUP BY 1, 2, 3)""")
shared("r_near", "SELECT source AS a, target AS b FROM r_edge UNION SELECT target, source FROM r_edge")
shared("r_node", f"""
SELECT id, title AS label, CASE WHEN kind = 'paper' THEN 'paper' ELSE 'article' END AS type,
       CASE WHEN kind = 'paper' THEN '/papers/' ELSE '/articles/' END || id || '/' AS href, summary, published_at, tags,
       concat_ws('|', title, nullif(replace(tags, ' ', '|'), '')) AS search_terms,
       row_number() OVER (ORDER BY visibility DESC, published_at DESC, id) AS ord FROM r_vis
UNION ALL
SELECT rtrim(grp, 's') || ':' || id, name_zh || ' / ' || name_en, rtrim(grp, 's'), NULL, NULL, NULL, '',
       concat_ws('|', id, name_zh, name_en),
       1000 + 100 * CASE grp WHEN 'targets' THEN 0 WHEN 'scenarios' THEN 1 WHEN 'tasks' THEN 2 ELSE 3 END + ord
FROM r_tax WHERE rtrim(grp, 's') || ':' || id IN (SELECT node FROM r_vlab)""")
check("graph_nodes", f"""
SELECT id, label, type, href, summary, {stamp('published_at')} AS published, tags, search_terms,
       greatest(1, (SELECT count(*) FROM r_near WHERE a = id)) AS weight FROM r_node""")
check("graph_edges", "SELECT id, source, target, type, round(confidence, 6) AS confidence, evidence, generated_by FROM r_edge")
check("graph_adjacency", """
SELECT n.id, coalesce(string_agg(r.b, ' ' ORDER BY r.b), '') AS neighbors FROM r_node n LEFT JOIN r_near r ON r.a = n.id GROUP BY n.id""")
shared("r_fc", f"""
SELECT id FROM r_node WHERE type IN ('paper', 'article') AND {any_label('tags', ('harbour', 'reader'))}
  AND {any_label('tags', ('choosing', 'gathering'))} AND {AGE} <= 365""")
shared("r_fv", """
SELECT id FROM r_fc UNION SELECT r.b FROM r_near r JOIN r_fc f ON r.a = f.id JOIN r_node n ON n.id = r.b WHERE n.type NOT IN ('paper', 'article')""")
check("graph_filter", """
SELECT 'node' AS part, id FROM r_fv
UNION ALL SELECT 'edge', id FROM r_edge WHERE source IN (SELECT id FROM r_fv) AND target IN (SELECT id FROM r_fv)""")
shared("r_tv", "SELECT id, type FROM r_node WHERE type IN ('paper', 'target', 'method')")
shared("r_te", "SELECT * FROM r_edge WHERE source IN (SELECT id FROM r_tv) AND target IN (SELECT id FROM r_tv)")
check("graph_type_filter", """
SELECT 'node' AS part, id FROM r_tv WHERE type = 'paper' OR id IN (SELECT source FROM r_te UNION SELECT target FROM r_te)
UNION ALL SELECT 'edge', id FROM r_te""")
shared("r_hood", """
SELECT c.id AS center, c.id FROM r_node c WHERE c.type IN ('paper', 'article')
UNION SELECT c.id, r.b FROM r_node c JOIN r_near r ON r.a = c.id WHERE c.type IN ('paper', 'article')""")
check("graph_neighborhood", """
SELECT center, 'node' AS part, id FROM r_hood
UNION ALL SELECT s.center, 'edge', e.id FROM r_edge e JOIN r_hood s ON s.id = e.source JOIN r_hood t ON t.id = e.target AND t.center = s.center""")
check("graph_search", f"""
SELECT id, bucket, row_number() OVER (ORDER BY bucket DESC, ord) AS place FROM (
  SELECT id, ord, CASE WHEN i = 'the' OR l = 'the' OR list_contains(string_split(t, '|'), 'the') THEN 3
                       WHEN starts_with(i, 'the') OR starts_with(l, 'the') THEN 2 ELSE 1 END::BIGINT AS bucket
  FROM (SELECT id, ord, {norm('id')} AS i, {norm('label')} AS l, {norm('search_terms')} AS t FROM r_node)
  WHERE contains(i || ' ' || l || ' ' || t, 'the'))""")
check("label_neighbors", """
SELECT n.id AS label_node, c.id AS item_id, c.label AS title FROM r_node n JOIN r_near r ON r.a = n.id JOIN r_node c ON c.id = r.b
WHERE n.type NOT IN ('paper', 'article') AND c.type IN ('paper', 'article')""")
check("graph_edge_kinds", """
SELECT CASE WHEN starts_with(id, 'taxonomy:') OR generated_by = 'topics.yaml' THEN 'taxonomy' ELSE 'model' END AS edge_kind, count(*) AS n
FROM r_edge GROUP BY 1""")
check("graph_stats", """
SELECT count(*) FILTER (type IN ('paper', 'article')) AS content_nodes, count(*) AS nodes, (SELECT count(*) FROM r_edge) AS edges FROM r_node""")
check("graph_violations", """
WITH e AS (SELECT * FROM r_edge WHERE type NOT IN ('task', 'scenario')),
near AS (SELECT source AS a, target AS b FROM e UNION SELECT target, source FROM e)
SELECT id, 'bad_weight' AS rule FROM r_node WHERE type = 'method'
UNION ALL SELECT id, 'isolated_label' FROM r_node n WHERE type NOT IN ('paper', 'article')
  AND NOT EXISTS (SELECT 1 FROM near r JOIN r_node c ON c.id = r.b WHERE r.a = n.id AND c.type IN ('paper', 'article'))
UNION ALL SELECT count(*)::VARCHAR, 'too_many_nodes' FROM r_node WHERE type IN ('paper', 'article') HAVING count(*) > 40""")

# --- quality -------------------------------------------------------------------------------------
BAD_ID = "CASE WHEN row_key % 41 = 0 THEN 'bad ' || id ELSE id END"
check("item_violations", f"""
SELECT {BAD_ID} AS id, rule FROM r_items JOIN (VALUES ('id'), ('title'), ('url'), ('authors'), ('relevance_score'), ('targets')) r(rule) ON CASE rule
  WHEN 'id' THEN row_key % 41 = 0 WHEN 'title' THEN row_key % 19 = 0 OR {strip('title')} = '' WHEN 'url' THEN row_key % 23 = 0
  WHEN 'authors' THEN row_key % 29 = 0 WHEN 'relevance_score' THEN row_key % 31 = 0 ELSE row_key % 37 = 0 END""")
shared("r_de", """
SELECT * FROM (SELECT (published_at + INTERVAL 8 HOUR)::DATE AS d, CASE WHEN row_key % 41 = 0 THEN 'blog' ELSE 'paper' END AS kind,
  id AS item_id, row_key % 12 AS rank, CASE WHEN row_key % 43 = 0 THEN 2 ELSE 1 END AS times FROM r_cand WHERE kind = 'paper')
JOIN range(2) t(n) ON t.n < times""")
check("digest_violations", """
SELECT strftime(d, '%Y-%m-%d') AS digest_date, kind, item_id, rule FROM (
  SELECT d, e.kind, item_id, 'unknown_item' AS rule FROM r_de e WHERE item_id NOT IN (SELECT id FROM r_items)
  UNION ALL SELECT d, e.kind, item_id, 'wrong_kind' FROM r_de e JOIN r_items i ON i.id = e.item_id WHERE i.kind <> e.kind
  UNION ALL SELECT d, kind, item_id, 'bad_rank' FROM r_de WHERE rank < 1
  UNION ALL SELECT d, kind, item_id, 'duplicate_item' FROM r_de GROUP BY d, kind, item_id HAVING count(*) > 1)""")
check("metadata_violations", f"""
SELECT kind || '-' || row_key AS id, rule FROM r_cand JOIN (VALUES ('missing_relevance_score'), ('unknown_targets'), ('no_summary'), ('unreadable_summary')) r(rule)
ON CASE rule WHEN 'missing_relevance_score' THEN row_key % 13 = 0 WHEN 'unknown_targets' THEN row_key % 37 = 0
  WHEN 'no_summary' THEN row_key % 9 = 0 OR (row_key % 10 <> 0 AND {strip('title')} = '')
  ELSE row_key % 9 <> 0 AND (row_key % 10 = 0 OR ({strip('title')} <> '' AND NOT regexp_matches(title, '\\p{{L}}'))) END""")
check("duplicate_ids", "SELECT id, count(*) AS n FROM r_cand GROUP BY id HAVING count(*) > 1")
check("path_consistency", """
SELECT id, rule FROM r_items JOIN (VALUES ('path_shape'), ('path_kind'), ('path_id'), ('path_month')) r(rule) ON row_key % 29 = 0 OR CASE rule
  WHEN 'path_kind' THEN row_key % 17 = 0 WHEN 'path_id' THEN row_key % 23 = 0 WHEN 'path_month' THEN row_key % 19 = 0 ELSE false END""")
check("public_url_filter", """
SELECT page_id, v::BIGINT AS variant, CASE v WHEN 1 THEN 'scheme' WHEN 2 THEN 'host_or_credentials' WHEN 3 THEN 'port'
  WHEN 4 THEN 'non_public_address' WHEN 6 THEN 'non_public_address' WHEN 7 THEN 'missing_or_too_long' END AS reason
FROM pages CROSS JOIN range(8) t(v)""")
check("script_filter", "SELECT doc_id, lang FROM documents WHERE regexp_matches(text, '[äöüéèêç]')")
check("dim_constraints", """
SELECT rule, v AS violations, v = 0 AS passed FROM (
  SELECT 'unknown_source' AS rule, count(DISTINCT source) AS v FROM documents WHERE substr(source, 4)::INT >= 18
  UNION ALL SELECT r, 0 FROM (VALUES ('duplicate_source'), ('duplicate_label'), ('weights'), ('weight_range')) t(r))""")
check("item_size_gate", f"SELECT doc_id, {JSON} AS bytes FROM documents WHERE {JSON} > 8192")
CLEAN = strip("text")
check("repeated_half_clean", f"""
SELECT doc_id, length(t) AS n_chars, md5(t) AS hash FROM (SELECT doc_id, CASE
  WHEN doc_id % 10 = 0 THEN CASE WHEN length({CLEAN}) >= 80 THEN {CLEAN} ELSE text || text END
  WHEN doc_id % 10 = 1 THEN CASE WHEN length({CLEAN}) >= 80 THEN {CLEAN} ELSE text || ' ' || chr(10) || ' ' || text END
  WHEN doc_id % 10 = 2 THEN {CLEAN} || ' 50% of_it & # \\x'
  ELSE {CLEAN} END AS t FROM documents)""")

# --- streams -------------------------------------------------------------------------------------
check("stream_dedupe", "SELECT DISTINCT id FROM r_cand WHERE kind = 'paper'")
check("stream_antijoin", "SELECT id, row_key FROM r_cand WHERE kind = 'paper' AND id NOT IN (SELECT id FROM r_hist)")
check("stream_daily_funnel", """
SELECT strftime(d, '%Y-%m-%d') AS business_date, event_type, count(*) AS n FROM (
  SELECT (ts + INTERVAL 8 HOUR)::DATE AS d, event_type FROM events)
WHERE d + INTERVAL 16 HOUR <= (SELECT max(ts) - INTERVAL 1 DAY FROM events) GROUP BY ALL""")
check("stream_digest", """
SELECT id, 1::BIGINT AS run, 1::BIGINT AS part, pos FROM (
  SELECT id, row_number() OVER (ORDER BY metadata_score DESC, published_at DESC, source_id, id) AS pos FROM (
    SELECT *, row_number() OVER (PARTITION BY id ORDER BY source_weight DESC, published_at DESC, source_id, row_key) AS rn
    FROM r_score WHERE kind = 'paper' AND published_at BETWEEN TIMESTAMP '2019-01-31' AND TIMESTAMP '2024-01-31')
  WHERE rn = 1 AND evidence > 0) WHERE pos <= 10""")
