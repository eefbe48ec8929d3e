"""Oracle SQL per registered query (DuckDB dialect, driver tables pre-registered as views).

Where a Spark query extracts something from generated text or HTML, the SQL
mostly derives the expected value from the generating rule instead of running
the same regular expression (so the check is independent).  The title ratio is
a recursive query: the longest common block (earliest in the first title, then
in the second), then the parts left and right of it.
"""

from __future__ import annotations

from .fixtures_sql import with_ctes

SQL: dict[str, str] = {}

WS = r"[\t-\r\x1c-\x20\x85\p{Z}]"

# FIXED VALUES: HTML entities decoded by the Spark job ('&amp;' last).
ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"),
            ("&nbsp;", " "), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&")]


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def decode(x: str) -> str:
    for ent, ch in ENTITIES:
        x = f"replace({x}, {q(ent)}, {q(ch)})"
    return x


def collapse(x: str) -> str:
    return f"regexp_replace(regexp_replace({x}, {q(WS + '+')}, ' ', 'g'), '^ | $', '', 'g')"


def strip_tags_text(x: str) -> str:
    return collapse(decode(f"regexp_replace({x}, '(?s)<[^>]*>', ' ', 'g')"))


def drop_markup(x: str) -> str:
    h = f"regexp_replace({x}, '(?s)<!--.*?-->', ' ', 'g')"
    h = f"regexp_replace({h}, '(?is)<!DOCTYPE[^>]*>', ' ', 'g')"
    alts = "|".join(rf"<{t}\b[^>]*>.*?</{t}\s*>" for t in ["script", "style", "nav", "header", "footer"])
    return f"regexp_replace({h}, {q('(?is)' + alts)}, ' ', 'g')"


def strip_ws(x: str) -> str:
    return f"regexp_replace({x}, {q('^' + WS + '+|' + WS + '+$')}, '', 'g')"


def reg(name: str, body: str, extra=None):
    SQL[name] = with_ctes(body, extra)


# ----------------------------------------------------------------- shared extra CTEs

EV_COLS = ("id, content_hash, source, {prio}::INTEGER AS source_priority, validation_status, confidence_raw, "
           "k::BIGINT AS ingest_seq, title_norm AS title, pub_iso AS publication_date, n_products::INTEGER AS n_products")

RUN_USTR = ("run_ustr", "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY content_hash ORDER BY k) AS rn2 "
                        "FROM docs4 WHERE source = 'ustr') WHERE rn2 = 1")
RUN_CBP = ("run_cbp", "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY content_hash ORDER BY k) AS rn2 "
                      "FROM docs4 WHERE source = 'cbp_csms') WHERE rn2 = 1")

# link sides: new FR events that may link, and stored events of the other sources
NEWL = ("newl", "SELECT id, k, codes, pub_iso, fr_no, title_norm FROM fr_new WHERE len(codes) > 0 AND pub_iso IS NOT NULL")
OTHER = ("other", "SELECT id, k, source, codes, pub_iso, title_norm, ingestion_timestamp FROM store WHERE source <> 'federal_register'")
CODE_BR = ("code_br", """
  SELECT new_id, id, ingestion_timestamp, k FROM (
    SELECT *, row_number() OVER (PARTITION BY new_id ORDER BY ingestion_timestamp DESC, k DESC, id) AS r FROM (
      SELECT DISTINCT n.id AS new_id, o.id, o.ingestion_timestamp, o.k
      FROM (SELECT id, unnest(codes) AS code FROM newl) n
      JOIN (SELECT id, k, ingestion_timestamp, unnest(codes) AS code FROM other) o ON o.code = n.code))
  WHERE r <= 5""")
BAND_BR = ("band_br", """
  SELECT new_id, id, ingestion_timestamp, k FROM (
    SELECT *, row_number() OVER (PARTITION BY new_id ORDER BY ingestion_timestamp DESC, k DESC, id) AS r FROM (
      SELECT n.id AS new_id, o.id, o.ingestion_timestamp, o.k
      FROM newl n JOIN other o
        ON CAST(o.pub_iso AS DATE) BETWEEN CAST(n.pub_iso AS DATE) - 29 AND CAST(n.pub_iso AS DATE) + 29))
  WHERE r <= 5""")
CANDS = ("cands", """
  SELECT new_id, id, r AS cand_rank FROM (
    SELECT *, row_number() OVER (PARTITION BY new_id ORDER BY ingestion_timestamp DESC, k DESC, id) AS r FROM (
      SELECT * FROM code_br UNION SELECT * FROM band_br))
  WHERE r <= 5""")
LINKX = [NEWL, OTHER, CODE_BR, BAND_BR, CANDS]

# pair parts (no title): dn, jaccard, date proximity
PAIR_PARTS = """
  SELECT p.new_id, p.id,
    contains(lower(o.title_norm || ' '), lower(n.fr_no)) AS dn,
    CASE WHEN len(n.codes) > 0 AND len(o.codes) > 0
         THEN len(list_intersect(n.codes, o.codes))::DOUBLE / len(list_distinct(list_concat(n.codes, o.codes)))::DOUBLE
         ELSE 0.0::DOUBLE END AS j,
    CASE WHEN n.pub_iso IS NOT NULL AND o.pub_iso IS NOT NULL
              AND abs(CAST(n.pub_iso AS DATE) - CAST(o.pub_iso AS DATE)) <= 30
         THEN 1.0::DOUBLE - abs(CAST(n.pub_iso AS DATE) - CAST(o.pub_iso AS DATE))::DOUBLE / 30.0::DOUBLE
         ELSE 0.0::DOUBLE END AS dp
  FROM {pairs} p JOIN newl n ON n.id = p.new_id JOIN other o ON o.id = p.id"""

# docnum pairs: the new FR number inside a stored other-source title
DN_PAIRS = ("dn_pairs", "SELECT DISTINCT n.id AS new_id, o.id FROM newl n JOIN other o ON contains(lower(o.title_norm || ' '), lower(n.fr_no))")
# every pair that can reach 0.5: a number match, or Jaccard >= 2/3 with equal titles or dates less than 30 days apart
REACH = ("reach", """
  SELECT new_id, id FROM dn_pairs UNION
  SELECT n.id, o.id
  FROM (SELECT DISTINCT a.id AS a_id, b.id AS b_id
        FROM (SELECT id, unnest(codes) AS code FROM newl) a JOIN (SELECT id, unnest(codes) AS code FROM other) b ON a.code = b.code) s
  JOIN newl n ON n.id = s.a_id JOIN other o ON o.id = s.b_id
  WHERE len(list_intersect(n.codes, o.codes))::DOUBLE / len(list_distinct(list_concat(n.codes, o.codes)))::DOUBLE >= 0.666666665
    AND ((n.title_norm <> '' AND lower(n.title_norm) = lower(o.title_norm))
         OR abs(CAST(n.pub_iso AS DATE) - CAST(o.pub_iso AS DATE)) < 30)""")
REACHX = [NEWL, OTHER, DN_PAIRS, REACH]

# ----------------------------------------------------------------- Q: pipelines

reg("fr_pipeline", f"SELECT {EV_COLS.format(prio=1)} FROM fr_new")
reg("ustr_pipeline", f"SELECT {EV_COLS.format(prio=3)} FROM run_ustr", [RUN_USTR])
reg("ustr_fast_pipeline", f"SELECT {EV_COLS.format(prio=3)} FROM run_ustr", [RUN_USTR])
reg("cbp_pipeline", f"SELECT {EV_COLS.format(prio=2)}, eff_iso AS effective_date FROM run_cbp", [RUN_CBP])

# ----------------------------------------------------------------- S: scans

TERMS = "(VALUES ('tariff', 0), ('duties', 1), ('import', 2), ('section 301', 3), ('section 232', 4), ('trade remedy', 5), ('safeguard', 6)) t(term, term_pos)"
FR_RAW = ("fr_raw", f"""
  SELECT t.term AS search_term, t.term_pos, f.no AS document_number, f.title, f.publication_date, f.url AS html_url, f.pdf_url,
         f.abstract, f.priority AS type, f.proclamation_number, f.k AS arrival_seq, f.pd_parsed, f.landed_date
  FROM (SELECT *, CASE WHEN k % 20 IN (4, 9) THEN NULL ELSE landed_date END AS pd_parsed FROM filings
        WHERE source = 'federal_register') f, {TERMS}
  WHERE contains(lower(f.title || ' ' || f.abstract), t.term)""")

reg("scan_api_records", "SELECT search_term, document_number, title, publication_date, html_url, pdf_url, abstract, type, "
                        "proclamation_number FROM fr_raw", [FR_RAW])
reg("scan_doc_details", r"""
SELECT no AS document_number, title, publication_date, url AS source_url, pdf_url FROM filings
WHERE source = 'federal_register'
  AND no IN (SELECT regexp_extract(title, 'FR Doc\. ([0-9]{4}-[0-9]+)', 1) FROM filings WHERE source <> 'federal_register')""")
SQL["scan_raw_html"] = "SELECT page_id, url, strlen(html)::INTEGER AS n_bytes FROM pages"
SQL["pdf_pages_to_doc"] = """
SELECT conv_id, sha256(coalesce(string_agg(text, chr(10) ORDER BY turn, text) FILTER (WHERE length(text) > 0), '')) AS text_sha256,
       length(coalesce(string_agg(text, chr(10) ORDER BY turn, text) FILTER (WHERE length(text) > 0), ''))::INTEGER AS text_chars,
       count(*) AS page_count
FROM conversations GROUP BY conv_id"""
_A = r'''(?is)<a\b[^>]*\bhref\s*=\s*"[^"]*"[^>]*>.*?</a\s*>'''
SQL["listing_links"] = f"""
SELECT page_id, (pos - 1)::INTEGER AS pos,
       {decode(f"regexp_extract(x, {q(r'(?is)^<a\b[^>]*\bhref\s*=\s*\"([^\"]*)\"')}, 1)")} AS href,
       {strip_tags_text(f"regexp_extract(x, {q(r'(?is)^<a\b[^>]*>(.*)</a\s*>$')}, 1)")} AS title
FROM (SELECT page_id, generate_subscripts(a, 1) AS pos, unnest(a) AS x
      FROM (SELECT page_id, regexp_extract_all(html, {q(_A)}) AS a FROM pages))"""

LISTING = ("listing", """
  SELECT o_orderkey AS k, o_orderkey // 100 AS page_id, (o_orderkey % 100)::INTEGER AS pos,
         CASE WHEN o_orderkey % 3 = 0 THEN 'https://x.example' ELSE '' END ||
         CASE WHEN o_orderkey % 5 = 0 THEN '/other/' ELSE '/press-releases/' END || CAST(o_orderkey AS VARCHAR) ||
         CASE WHEN o_orderkey % 7 = 0 THEN '.pdf' ELSE '' END AS href,
         CASE WHEN o_orderkey % 5 = 0 THEN '/other/' ELSE '/csms/' END AS cbp_path,
         CASE WHEN o_orderkey % 4 = 0 THEN 'Tariff action ' || CAST(o_orderkey AS VARCHAR)
              ELSE 'Museum opening ' || CAST(o_orderkey AS VARCHAR) END AS title
  FROM orders""")
LISTING_CBP = ("listing_cbp", """
  SELECT k, page_id, pos,
         CASE WHEN k % 3 = 0 THEN 'https://x.example' ELSE '' END || cbp_path || CAST(k AS VARCHAR) ||
         CASE WHEN k % 7 = 0 THEN '.pdf' ELSE '' END AS href,
         'CSMS #' || CAST(k AS VARCHAR) || CASE WHEN k % 4 = 0 THEN ' Import duties update' ELSE ' Holiday hours' END AS title
  FROM listing""")


def resolved(h, base):
    return f"CASE WHEN starts_with({h}, '/') THEN '{base}' || {h} ELSE {h} END"


SQL["pdf_links"] = with_ctes(f"""
SELECT page_id, (r - 1)::INTEGER AS pdf_pos, {resolved('href', 'https://ustr.gov')} AS pdf_url FROM (
  SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY k) AS r FROM listing WHERE ends_with(href, '.pdf'))""", [LISTING])
reg("scan_events", "SELECT id, source, content_hash, k::BIGINT AS ingest_seq FROM store")
reg("event_by_hash", """
SELECT d.k::BIGINT AS arrival_seq, s.id, s.source FROM docs4 d JOIN store s ON s.content_hash = d.content_hash
WHERE d.source = 'federal_register'""")
reg("existing_hashes", "SELECT DISTINCT content_hash FROM store WHERE source = 'federal_register'")

# ----------------------------------------------------------------- P: projections

reg("parse_fr", """
SELECT 'federal_register' AS source, coalesce(priority, 'Unknown') AS document_type, title, publication_date,
       no AS fr_document_number, proclamation_number, NULL::VARCHAR AS executive_order_number, NULL::VARCHAR AS cbp_csms_number,
       url AS source_url, pdf_url, abstract
FROM filings WHERE source = 'federal_register'""")
reg("parse_ustr", """
SELECT 'ustr' AS source, 'Press Release' AS document_type, title, publication_date, NULL::VARCHAR AS fr_document_number,
       NULL::VARCHAR AS proclamation_number, NULL::VARCHAR AS executive_order_number, NULL::VARCHAR AS cbp_csms_number,
       url AS source_url, '' AS abstract
FROM filings WHERE source = 'ustr'""")
reg("parse_cbp", """
SELECT 'cbp_csms' AS source, 'CSMS Message' AS document_type, title, publication_date, NULL::VARCHAR AS fr_document_number,
       NULL::VARCHAR AS proclamation_number, NULL::VARCHAR AS executive_order_number,
       CAST(50000000 + k AS VARCHAR) AS cbp_csms_number, url AS source_url, '' AS abstract
FROM filings WHERE source = 'cbp_csms'""")
SQL["resolve_url"] = with_ctes(f"SELECT page_id, pos, {resolved('href', 'https://ustr.gov')} AS url FROM listing", [LISTING])
reg("assemble_event", """
SELECT k::BIGINT AS arrival_seq, 'unknown' AS action_type, array_to_string(codes, ',') AS codes, n_valid::INTEGER AS n_valid
FROM docs2 WHERE source = 'federal_register'""")
reg("event_envelope", """
SELECT id, source, 1::INTEGER AS source_priority, '1.0.0' AS parser_version, validation_status,
       CAST(CAST(confidence_raw AS DECIMAL(3,2)) AS DOUBLE) AS confidence_score, '[]' AS conflicts FROM fr_new""")
reg("link_projection", """
SELECT id, source, title_norm AS title, pub_iso AS publication_date, fr_no AS fr_document_number,
       array_to_string(codes, ',') AS codes FROM store""")
reg("outcome_status", """
SELECT d.k::BIGINT AS arrival_seq, CASE WHEN d.k % 15 = 0 THEN 'failed' WHEN n.id IS NULL THEN 'duplicate' ELSE 'processed' END AS outcome
FROM docs4 d LEFT JOIN fr_new n ON n.k = d.k WHERE d.source = 'federal_register'""")
reg("url_tail", "SELECT url, CAST(k AS VARCHAR) AS doc_id FROM filings WHERE source = 'ustr'")

# ----------------------------------------------------------------- F: filters

reg("fr_search_window", """
SELECT search_term, document_number, publication_date FROM fr_raw
WHERE pd_parsed BETWEEN DATE '1998-06-30' - 90 AND DATE '1998-06-30'""", [FR_RAW])
SQL["ustr_keyword_filter"] = with_ctes(f"""
SELECT page_id, pos, title, {resolved('href', 'https://ustr.gov')} AS url FROM listing
WHERE k % 4 = 0 AND contains(href, '/press-releases/')""", [LISTING])
SQL["cbp_keyword_filter"] = with_ctes(f"""
SELECT page_id, pos, title, {resolved('href', 'https://www.cbp.gov')} AS url, CAST(k AS VARCHAR) AS csms_number
FROM listing_cbp WHERE k % 4 = 0 AND contains(lower(href), 'csms')""", [LISTING, LISTING_CBP])
reg("linkable_docs", "SELECT id, len(codes)::INTEGER AS n_codes FROM newl", [NEWL])
reg("other_source", "SELECT o.source, count(*) * (SELECT count(*) FROM newl) AS pairs FROM other o GROUP BY o.source", [NEWL, OTHER])
reg("jsonb_containment", """
SELECT n.id, list_has_any(n.codes, (SELECT list(DISTINCT code) FROM (SELECT unnest(codes) AS code FROM other))) AS shares FROM newl n""", [NEWL, OTHER])
reg("date_band", """
SELECT n.id, coalesce(d.near, 0)::BIGINT AS near FROM newl n LEFT JOIN (
  SELECT x.pub_iso, count(*) AS near FROM (SELECT DISTINCT pub_iso FROM newl) x
  JOIN other o ON abs(CAST(o.pub_iso AS DATE) - CAST(x.pub_iso AS DATE)) < 30 GROUP BY x.pub_iso) d ON d.pub_iso = n.pub_iso""", [NEWL, OTHER])

# ----------------------------------------------------------------- J: joins

reg("dedup_against_store", """
SELECT k::BIGINT AS arrival_seq, content_hash FROM docs4 d
WHERE source = 'federal_register'
  AND NOT EXISTS (SELECT 1 FROM store s WHERE s.source = 'federal_register' AND s.content_hash = d.content_hash)""")
_PRE = ('{"document_type": null, "fr_document_number": null, "hts_codes": [], "publication_date": null, "source": "ustr"}')
reg("pre_dedup_hash", f"""
SELECT k::BIGINT AS arrival_seq, sha256({q(_PRE)}) AS preliminary_hash,
       sha256({q(_PRE)}) IN (SELECT content_hash FROM store) AS stored
FROM filings WHERE source = 'ustr'""")
reg("candidate_join", "SELECT new_id, id FROM cands", LINKX)
reg("candidate_join_newest", "SELECT new_id, id, cand_rank::INTEGER AS cand_rank FROM cands", LINKX)
reg("docnum_match", "SELECT new_id, id FROM dn_pairs", [NEWL, OTHER, DN_PAIRS])
reg("chapter_info", """
SELECT code, CAST(substr(code, 1, 2) AS INTEGER) AS chapter,
       CASE CAST(substr(code, 1, 2) AS INTEGER) WHEN 1 THEN 'Live animals' WHEN 72 THEN 'Iron and steel'
            WHEN 73 THEN 'Articles of iron or steel' WHEN 84 THEN 'Machinery and mechanical appliances'
            WHEN 85 THEN 'Electrical machinery and equipment' WHEN 87 THEN 'Vehicles' ELSE 'Unknown' END AS description
FROM (SELECT DISTINCT code FROM page_lines)""")
SQL["country_lookup"] = """
SELECT s_suppkey, name AS country_name,
       CASE name WHEN 'China' THEN 'CN' WHEN 'mexico' THEN 'MX' WHEN ' Japan ' THEN 'JP' WHEN 'ZZ' THEN 'ZZ'
                 WHEN 'Korea' THEN 'KR' WHEN 'United Kingdom' THEN 'GB' END AS iso2
FROM (SELECT s_suppkey, CASE s_suppkey % 8 WHEN 0 THEN 'China' WHEN 1 THEN 'mexico' WHEN 2 THEN ' Japan ' WHEN 3 THEN 'ZZ'
                                          WHEN 4 THEN 'Korea' WHEN 5 THEN 'Atlantis' WHEN 6 THEN 'U1' ELSE 'United Kingdom' END AS name
      FROM supplier)"""
reg("source_relationship", """
SELECT c.new_id, c.id, CASE o.source WHEN 'ustr' THEN 'policy_context' WHEN 'cbp_csms' THEN 'implementation' ELSE 'related' END
       AS relationship
FROM reach c JOIN other o ON o.id = c.id""", REACHX)

# ----------------------------------------------------------------- A: aggregations

reg("keyword_union", """
SELECT search_term, document_number, result_pos FROM (
  SELECT search_term, document_number,
         row_number() OVER (PARTITION BY search_term ORDER BY pd_parsed DESC NULLS LAST, document_number)::INTEGER AS result_pos
  FROM fr_raw WHERE pd_parsed BETWEEN DATE '1998-06-30' - 365 AND DATE '1998-06-30')
WHERE result_pos <= 100""", [FR_RAW])
reg("distinct_by_docnum", """
SELECT document_number, search_term, arrival_seq FROM (
  SELECT *, row_number() OVER (PARTITION BY document_number ORDER BY term_pos, arrival_seq) AS r FROM fr_raw) WHERE r = 1""",
    [FR_RAW])
reg("merge_codes", """
SELECT f.k::BIGINT AS arrival_seq,
       len(coalesce(h.c, []))::INTEGER AS n_html,
       len(p.c)::INTEGER AS n_pdf,
       len(d.codes)::INTEGER AS n_merged
FROM filings f
LEFT JOIN (SELECT k, list(DISTINCT code) AS c FROM page_lines GROUP BY k) h ON h.k = f.k
LEFT JOIN (SELECT f2.k, list(DISTINCT p2.code) AS c FROM filings f2 JOIN plines p2 ON p2.l_orderkey = f2.pk WHERE f2.pdf_url IS NOT NULL GROUP BY f2.k) p ON p.k = f.k
JOIN docs d ON d.k = f.k
WHERE f.source = 'federal_register'""")
reg("hts_batch_summary", """
SELECT source, count(*) AS total, count(*) FILTER (WHERE substr(code, 1, 2) <> '00') AS valid,
       count(*) FILTER (WHERE substr(code, 1, 2) = '00') AS invalid
FROM (SELECT DISTINCT k, source, code FROM page_lines) GROUP BY source""")
reg("run_summary", """
SELECT 'federal_register' AS source, CASE WHEN d.k % 15 = 0 THEN 'failed' WHEN n.id IS NULL THEN 'duplicate' ELSE 'processed' END AS outcome,
       count(*) AS documents, sum(CASE WHEN d.k % 15 = 0 THEN 0 ELSE d.n_products END)::BIGINT AS products
FROM docs4 d LEFT JOIN fr_new n ON n.k = d.k WHERE d.source = 'federal_register' GROUP BY 2""")
reg("jaccard_codes", """
SELECT c.new_id, c.id,
       CASE WHEN len(n.codes) > 0 AND len(o.codes) > 0
            THEN len(list_intersect(n.codes, o.codes))::DOUBLE / len(list_distinct(list_concat(n.codes, o.codes)))::DOUBLE
            ELSE 0.0::DOUBLE END AS jaccard
FROM reach c JOIN newl n ON n.id = c.new_id JOIN other o ON o.id = c.id""", REACHX)
reg("dedup_within_batch", """
SELECT seq::BIGINT AS arrival_seq, content_hash FROM (
  SELECT *, row_number() OVER (PARTITION BY content_hash ORDER BY seq) AS r FROM (
    SELECT k AS seq, content_hash FROM docs4 WHERE source = 'ustr'
    UNION ALL SELECT k + 1000000000 AS seq, content_hash FROM docs4 WHERE source = 'ustr' AND k % 20 = 0))
WHERE r = 1""")

SCORE_CASES = ("scases", """
  SELECT k, pub, eff, exp, ocr, fb, rel, rate_original,
         strftime(pub, '%Y-%m-%d') AS pub_s, strftime(eff, '%Y-%m-%d') AS eff_s, strftime(exp, '%Y-%m-%d') AS exp_s,
         (eff >= pub) AS valid, (exp <= eff) AS warn
  FROM (SELECT o_orderkey AS k, CAST(o_orderdate AS DATE) AS pub,
               CAST(o_orderdate AS DATE) + CAST(o_orderkey % 13 - 2 AS INTEGER) AS eff,
               CAST(o_orderdate AS DATE) + CAST(o_orderkey % 13 - 2 AS INTEGER) + CAST(o_orderkey % 9 - 1 AS INTEGER) AS exp,
               o_orderkey % 4 = 0 AS ocr, o_orderkey % 6 = 0 AS fb, o_orderkey % 5 = 0 AS rel
        FROM orders) o
  LEFT JOIN (SELECT l_orderkey, min(CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) || '%') AS rate_original
             FROM lineitem WHERE l_linenumber = 1 GROUP BY l_orderkey) r ON r.l_orderkey = o.k""")
SCORED = ("scored", """
  SELECT k, 1.0::DOUBLE AS required, 0.0::DOUBLE AS hts,
         CASE WHEN valid THEN greatest(0.0::DOUBLE, 1.0::DOUBLE - (CASE WHEN warn THEN 1 ELSE 0 END) * 0.1::DOUBLE)
              ELSE 0.0::DOUBLE END AS date_v,
         1.0::DOUBLE AS date_basic,
         CASE WHEN rate_original IS NULL THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END AS rate,
         greatest(0.0::DOUBLE, least(1.0::DOUBLE,
           ((1.0::DOUBLE - CASE WHEN ocr THEN 0.3::DOUBLE ELSE 0.0::DOUBLE END)
                         - CASE WHEN fb THEN 0.2::DOUBLE ELSE 0.0::DOUBLE END)
                         + CASE WHEN rel THEN 0.1::DOUBLE ELSE 0.0::DOUBLE END)) AS quality
  FROM scases""")
SCORED2 = ("scored2", """
  SELECT *, greatest(0.0::DOUBLE, least(1.0::DOUBLE,
           0.0::DOUBLE + required * 0.25::DOUBLE + hts * 0.25::DOUBLE + date_v * 0.15::DOUBLE + rate * 0.15::DOUBLE
           + quality * 0.2::DOUBLE)) AS confidence_raw
  FROM scored""")
LABEL = ("CASE WHEN confidence_raw >= 0.9 THEN 'excellent' WHEN confidence_raw >= 0.75 THEN 'good' "
         "WHEN confidence_raw >= 0.6 THEN 'fair' WHEN confidence_raw >= 0.4 THEN 'poor' ELSE 'very_poor' END")
SC3 = [SCORE_CASES, SCORED, SCORED2]
reg("quality_histogram", f"SELECT {LABEL} AS label, count(*) AS n FROM scored2 GROUP BY 1", SC3)

# ----------------------------------------------------------------- W: windows

SQL["top20_links"] = with_ctes(f"""
SELECT page_id, pos, {resolved('href', 'https://ustr.gov')} AS url FROM (
  SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY pos) AS r FROM listing
  WHERE k % 4 = 0 AND contains(href, '/press-releases/'))
WHERE r <= 20""", [LISTING])
SQL["top2_pdfs"] = with_ctes(f"""
SELECT page_id, coalesce(string_agg({resolved('href', 'https://ustr.gov')}, ' ' ORDER BY k) FILTER (WHERE r <= 2 AND is_pdf), '') AS pdfs
FROM (SELECT *, ends_with(href, '.pdf') AS is_pdf,
             row_number() OVER (PARTITION BY page_id, ends_with(href, '.pdf') ORDER BY k) AS r FROM listing)
GROUP BY page_id""", [LISTING])
reg("top5_candidates", "SELECT new_id, id, cand_rank::INTEGER AS cand_rank FROM cands", LINKX)
reg("first5_sorted_codes", """
SELECT k, array_to_string(list_slice(list_sort(list(substr(code, 1, 7))), 1, 5), ',') AS first5
FROM (SELECT DISTINCT k, code FROM page_lines) GROUP BY k""")

# ----------------------------------------------------------------- X: text

_TEXT = strip_tags_text(drop_markup("coalesce(html, '')"))
SQL["html_text"] = f"SELECT page_id, sha256({_TEXT}) AS text_sha256, length({_TEXT})::INTEGER AS text_chars FROM pages"
PAGE_ROWS = ("page_rows", """
  SELECT k, row_number() OVER (PARTITION BY k ORDER BY l_linenumber, l_partkey, sentence) AS r, code, l_partkey, sentence
  FROM page_lines""")
reg("html_tables", """
SELECT k, 0::INTEGER AS t_idx, 0::INTEGER AS r_idx, 'HTS | Description' AS row_text FROM filings
UNION ALL
SELECT k, 0::INTEGER, r::INTEGER, code || ' | Part ' || CAST(l_partkey AS VARCHAR) || ' & parts' FROM page_rows WHERE k % 13 <> 5
UNION ALL
SELECT k, 0::INTEGER, (2 * r - 1)::INTEGER, code || ' | Part ' || CAST(l_partkey AS VARCHAR) || ' & partssee ' || code || ' | see ' || code
FROM page_rows WHERE k % 13 = 5
UNION ALL
SELECT k, 0::INTEGER, (2 * r)::INTEGER, 'see ' || code FROM page_rows WHERE k % 13 = 5
UNION ALL
SELECT k, r::INTEGER, 0::INTEGER, 'see ' || code FROM page_rows WHERE k % 13 = 5""", [PAGE_ROWS])
_ART = f"regexp_extract(coalesce(html, ''), {q(r'(?is)<article\b[^>]*>(.*?)</article\s*>')}, 1)"
reg("main_content", f"""
SELECT 'page:' || CAST(page_id AS VARCHAR) AS doc, sha256({strip_tags_text(drop_markup(_ART))}) AS content_sha256 FROM pages
UNION ALL
SELECT 'notice:' || CAST(f.k AS VARCHAR),
       sha256(f.title || coalesce(' ' || s.sents, '') || ' HTS Description' || coalesce(' ' || s.rows_t, ''))
FROM filings f LEFT JOIN (
  SELECT k, string_agg(sentence, ' ' ORDER BY r) AS sents,
         string_agg(code || ' Part ' || CAST(l_partkey AS VARCHAR) || ' & parts' || CASE WHEN k % 13 = 5 THEN ' see ' || code ELSE '' END, ' ' ORDER BY r) AS rows_t
  FROM page_rows GROUP BY k) s ON s.k = f.k
WHERE f.source = 'cbp_csms'""", [PAGE_ROWS])
reg("html_hts_codes", """
SELECT f.k, coalesce(c.codes, '') AS codes FROM filings f
LEFT JOIN (SELECT k, string_agg(DISTINCT code, ',' ORDER BY code) AS codes FROM page_lines GROUP BY k) c ON c.k = f.k""")
CODE6N = "substr(code, 1, 7) || '.0000'"
reg("extract_hts_codes", f"""
SELECT l_orderkey, l_linenumber, l_partkey, array_to_string(list_sort(list_distinct([code, {CODE6N}])), ',') AS codes
FROM plines""")
reg("normalize_hts", f"""
SELECT l_orderkey, l_linenumber, l_partkey, code AS from_bare, {CODE6N} AS from_dotted6, NULL::VARCHAR AS from_nine FROM plines""")
reg("extract_rates", """
SELECT l_orderkey, l_linenumber, l_partkey, i::INTEGER AS i, rate_text, value,
       trim(substr(sentence, greatest(0, st - 100) + 1, least(length(sentence), st + length(rate_text) + 100) - greatest(0, st - 100))) AS context,
       st::INTEGER AS start
FROM (
  SELECT l_orderkey, l_linenumber, l_partkey, sentence, 0 AS i, q || '%' AS rate_text, q AS value,
         strpos(sentence, ' is ' || q || '%') - 1 + 4 AS st FROM plines2
  UNION ALL
  SELECT l_orderkey, l_linenumber, l_partkey, sentence, 1, '$' || CAST(l_linenumber AS VARCHAR) || ' per',
         CAST(l_linenumber AS VARCHAR), strpos(sentence, '$' || CAST(l_linenumber AS VARCHAR) || ' per') - 1 FROM plines2)""")
reg("products_from_tables", f"""
SELECT k, 0::INTEGER AS t_idx, r::INTEGER AS r_idx, array_to_string(list_sort(list_distinct([code, {CODE6N}])), ',') AS codes,
       'Part ' || CAST(l_partkey AS VARCHAR) || ' & parts' AS description
FROM page_rows WHERE k % 13 <> 5
UNION ALL
SELECT k, 0::INTEGER, (2 * r - 1)::INTEGER, repeat(array_to_string(list_sort(list_distinct([code, {CODE6N}])), ',') || ',', 2)
       || array_to_string(list_sort(list_distinct([code, {CODE6N}])), ','), '' FROM page_rows WHERE k % 13 = 5
UNION ALL
SELECT k, t.t::INTEGER, CASE WHEN t.t = 0 THEN 2 * r ELSE 0 END::INTEGER, array_to_string(list_sort(list_distinct([code, {CODE6N}])), ','), ''
FROM page_rows, LATERAL (SELECT unnest([0, r]) AS t) t WHERE k % 13 = 5""", [PAGE_ROWS])
reg("extract_countries", """
SELECT l_orderkey, l_linenumber, l_partkey,
       CASE country WHEN 'CN' THEN 'CN' WHEN 'MX' THEN 'MX' WHEN 'ZZ' THEN '' ELSE 'CN,KR' END AS countries FROM plines""")
SQL["csms_number"] = with_ctes("""
SELECT url AS key, CAST(50000000 + k AS VARCHAR) AS csms_number FROM filings WHERE source = 'cbp_csms'
UNION ALL
SELECT CAST(page_id AS VARCHAR) || ':' || CAST(pos AS VARCHAR), CAST(k AS VARCHAR) FROM listing_cbp""", [LISTING, LISTING_CBP])
reg("effective_date_html", """
SELECT l_orderkey, l_linenumber, l_partkey,
       CASE WHEN variant IN (1, 2) THEN strftime(l_shipdate, '%B %-d, %Y') END AS effective_date FROM plines""")
reg("effective_date_cbp", """
SELECT l_orderkey, l_linenumber, l_partkey,
       CASE WHEN variant IN (0, 2) THEN strftime(l_shipdate, '%B %-d, %Y') END AS effective_date FROM plines""")
_NT = strip_ws(f"regexp_replace({collapse('coalesce(text, %s)' % q(''))}, "
               + q(r"[^\p{L}\p{N}_\t-\r\x1c-\x20\x85\p{Z}\-.,;:()\[\]/]") + ", '', 'g')")
SQL["normalize_text"] = f"SELECT doc_id, sha256({_NT}) AS text_sha256, length({_NT})::INTEGER AS text_chars FROM documents"
reg("pdf_cell_clean", """
SELECT k, page_no::INTEGER AS page_no, 0::INTEGER AS t_idx, 0::INTEGER AS r_idx, 'HTS|Description' AS row_text FROM (
  SELECT f.k, row_number() OVER (PARTITION BY f.k ORDER BY p.l_linenumber, p.l_partkey, p.sentence) AS page_no
  FROM filings f JOIN plines2 p ON p.l_orderkey = f.pk WHERE f.pdf_url IS NOT NULL)
UNION ALL
SELECT k, page_no::INTEGER, 0::INTEGER, 1::INTEGER, code || '|' FROM (
  SELECT f.k, p.code, row_number() OVER (PARTITION BY f.k ORDER BY p.l_linenumber, p.l_partkey, p.sentence) AS page_no
  FROM filings f JOIN plines2 p ON p.l_orderkey = f.pk WHERE f.pdf_url IS NOT NULL)""")

# ----------------------------------------------------------------- D: dates

reg("parse_date", "SELECT k, publication_date, CAST(pub_iso AS DATE) AS parsed FROM filings")
reg("normalize_date", "SELECT k, pub_iso AS iso FROM filings")
SQL["rfc822_date"] = "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS iso FROM orders"
SQL["validate_dates"] = with_ctes("""
SELECT k, valid, (CASE WHEN valid THEN 0 ELSE 1 END)::INTEGER AS n_errors, (CASE WHEN warn THEN 1 ELSE 0 END)::INTEGER AS n_warnings,
       array_to_string(list_filter([
         CASE WHEN NOT valid THEN 'Effective date (' || eff_s || ') before publication date (' || pub_s || ')' END,
         CASE WHEN warn THEN 'Expiration date (' || exp_s || ') not after effective date (' || eff_s || ')' END], lambda x: x IS NOT NULL), '; ')
         AS messages
FROM scases""", [SCORE_CASES])
reg("date_proximity", f"""
SELECT new_id, id, dp AS proximity FROM ({PAIR_PARTS.format(pairs='reach')})""", REACHX)

# ----------------------------------------------------------------- C: validation / scoring / hashing

reg("validate_hts", """
SELECT code, substr(code, 1, 2) <> '00' AS valid,
       CASE WHEN substr(code, 1, 2) = '00' THEN 'Invalid chapter: 0. Must be 01-99' ELSE '' END AS errors,
       CASE WHEN substr(code, 1, 2) <> '00' THEN CAST(substr(code, 1, 2) AS INTEGER) END AS chapter,
       CASE WHEN substr(code, 1, 2) <> '00' THEN substr(code, 1, 4) END AS heading,
       CASE WHEN substr(code, 1, 2) <> '00' THEN substr(code, 1, 7) END AS subheading
FROM (SELECT DISTINCT code FROM page_lines)""")
RATES = ("rates", """
  SELECT l_orderkey, l_linenumber, l_partkey, (l_orderkey + l_linenumber) % 6 AS m, CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS q,
         CASE (l_orderkey + l_linenumber) % 6 WHEN 0 THEN CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) || '%'
              WHEN 1 THEN '$' || CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) || '.5 per kg'
              WHEN 2 THEN CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) || ' cents per unit'
              WHEN 3 THEN CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) || '% + $2 per kg'
              WHEN 4 THEN 'Free' END AS rate
  FROM lineitem""")
RATE_VALUE = ("CASE m WHEN 0 THEN CAST(q AS DOUBLE) / 100.0::DOUBLE WHEN 1 THEN CAST(q || '.5' AS DOUBLE) "
              "WHEN 2 THEN CAST(q AS DOUBLE) / 100.0::DOUBLE END")
SQL["validate_rate"] = with_ctes(f"""
SELECT l_orderkey, l_linenumber, l_partkey, rate, m IN (0, 1, 2) AS valid,
       CASE m WHEN 0 THEN 'ad_valorem' WHEN 1 THEN 'specific' WHEN 2 THEN 'specific' END AS rate_type,
       {RATE_VALUE} AS normalized_value,
       CASE WHEN m = 5 THEN 'Rate string is empty' WHEN m IN (3, 4) THEN 'Unrecognized rate format: ' || rate ELSE '' END AS errors
FROM rates""", [RATES])
SQL["normalize_rate"] = with_ctes(f"SELECT l_orderkey, l_linenumber, l_partkey, {RATE_VALUE} AS value FROM rates", [RATES])
reg("normalize_document", """
SELECT f.k::BIGINT AS arrival_seq, d.title_norm AS title, d.pub_iso AS publication_date, d.eff_iso AS effective_date,
       coalesce(c.codes, '') AS codes
FROM filings f JOIN docs d ON d.k = f.k
LEFT JOIN (SELECT k, string_agg(DISTINCT code, ',' ORDER BY code) AS codes FROM page_lines GROUP BY k) c ON c.k = f.k""")
reg("confidence_score", "SELECT k, required, hts, date_v, date_basic, rate, quality, confidence_raw FROM scored2", SC3)
reg("quality_label", f"SELECT k, {LABEL} AS label FROM scored2", SC3)
reg("content_hash", "SELECT k::BIGINT AS arrival_seq, content_hash, confidence_raw, validation_status FROM docs4")
FUZZY = """md5('{"hts_codes": [' || coalesce(array_to_string(list_transform(list_slice(list_sort(list_transform(codes, lambda x: substr(x, 1, 7))), 1, 5),
                                                             lambda x: '"' || x || '"'), ', '), '') ||
                '], "publication_date": ' || CASE WHEN pub_iso IS NULL THEN 'null' ELSE '"' || pub_iso || '"' END ||
                ', "source": "' || source || '"}')"""
reg("fuzzy_hash", f"SELECT id, {FUZZY} AS fuzzy_hash FROM store")
reg("review_blocks", f"""
SELECT id, fuzzy_hash, count(*) OVER (PARTITION BY fuzzy_hash) AS block_size,
       first_value(id) OVER (PARTITION BY fuzzy_hash ORDER BY ingestion_timestamp, k, id) AS representative
FROM (SELECT *, {FUZZY} AS fuzzy_hash FROM store)""")

# ----------------------------------------------------------------- K: constraints / rules

_EVENTS_ALL = ("ev_all", "SELECT id, content_hash, confidence_raw FROM store UNION ALL SELECT id, content_hash, confidence_raw FROM fr_new")
reg("rule_table", """
SELECT rule, severity, violations::BIGINT AS violations FROM (
  SELECT 'hts_code_pattern' AS rule, 'error' AS severity, 0 AS violations
  UNION ALL SELECT 'effective_date >= publication_date', 'error', count(*) FILTER (WHERE eff_iso < pub_iso) FROM store
  UNION ALL SELECT 'expiration_date > effective_date', 'warning', 0
  UNION ALL SELECT 'hts_code_length', 'error', count(*) FILTER (WHERE len(codes) > 0) FROM store
  UNION ALL SELECT 'rate_types', 'error', 0
  UNION ALL SELECT 'rate_ad_valorem_pattern', 'error', 0
  UNION ALL SELECT 'rate_specific_pattern', 'error', 0
  UNION ALL SELECT 'required:source', 'error', 0
  UNION ALL SELECT 'required:document_type', 'error', 0
  UNION ALL SELECT 'required:title', 'error', count(*) FILTER (WHERE title_norm = '') FROM store
  UNION ALL SELECT 'required:publication_date', 'error', count(*) FILTER (WHERE pub_iso IS NULL) FROM store
  UNION ALL SELECT 'required:tariff_action.type', 'error', 0
  UNION ALL SELECT 'required:source_url', 'error', 0
  UNION ALL SELECT 'confidence:excellent', 'info', count(*) FILTER (WHERE confidence_raw >= 0.9) FROM store
  UNION ALL SELECT 'confidence:good', 'info', count(*) FILTER (WHERE confidence_raw >= 0.75 AND confidence_raw < 0.9) FROM store
  UNION ALL SELECT 'confidence:fair', 'info', count(*) FILTER (WHERE confidence_raw >= 0.6 AND confidence_raw < 0.75) FROM store
  UNION ALL SELECT 'confidence:poor', 'info', count(*) FILTER (WHERE confidence_raw >= 0.4 AND confidence_raw < 0.6) FROM store
  UNION ALL SELECT 'confidence:very_poor', 'info', count(*) FILTER (WHERE confidence_raw < 0.4) FROM store
)""")

_RULES_BROKEN = [
    ("hts_code_pattern", "error", "k % 20 = 0 AND len(codes) > 0"),
    ("hts_code_length", "error", "k % 20 <> 0 AND len(codes) > 0"),
    ("effective_date >= publication_date", "error", "CASE WHEN k % 20 = 13 THEN pub_iso IS NOT NULL ELSE k % 20 <> 5 AND eff_iso < pub_iso END"),
    ("expiration_date > effective_date", "warning", "k % 20 = 1 AND eff_iso IS NOT NULL"),
    ("rate_types", "error", "k % 20 = 12"),
    ("rate_ad_valorem_pattern", "error", "k % 20 = 9"),
    ("rate_specific_pattern", "error", "k % 20 = 11"),
    ("required:source", "error", "k % 20 = 2"),
    ("required:document_type", "error", "k % 20 = 3"),
    ("required:title", "error", "k % 20 = 4 OR title_norm = ''"),
    ("required:publication_date", "error", "k % 20 = 5 OR pub_iso IS NULL"),
    ("required:tariff_action.type", "error", "k % 20 = 6"),
    ("required:source_url", "error", "k % 20 = 7"),
]
_SCORE = "CASE k % 20 WHEN 14 THEN 0.95 WHEN 15 THEN 0.8 WHEN 16 THEN 0.65 WHEN 17 THEN 0.45 WHEN 18 THEN 0.1 ELSE confidence_raw END"
for _name, _low, _high in (("excellent", 0.9, 9), ("good", 0.75, 0.9), ("fair", 0.6, 0.75), ("poor", 0.4, 0.6), ("very_poor", -9, 0.4)):
    _RULES_BROKEN.append((f"confidence:{_name}", "info", f"({_SCORE})::DOUBLE >= {_low}::DOUBLE AND ({_SCORE})::DOUBLE < {_high}::DOUBLE"))
reg("rule_table_damaged", "SELECT rule, severity, violations::BIGINT AS violations FROM (\n" + "\n  UNION ALL ".join(
    f"SELECT '{rule}' AS rule, '{severity}' AS severity, count(*) FILTER (WHERE {broken}) AS violations FROM store" for rule, severity, broken in _RULES_BROKEN) + ")")


# ----------------------------------------------------------------- title ratio (X14) and the queries that use it

def ratio_ctes(pairs: str) -> list[tuple[str, str]]:
    """``ratios(a, b, ratio)`` of the distinct lower-cased title pairs (a, b) that the SELECT ``pairs`` returns."""
    return [
        ("tpairs", f"SELECT row_number() OVER () AS pid, a, b FROM (SELECT DISTINCT a, b FROM ({pairs}) WHERE a <> '' AND b <> '')"),
        ("blocks", """
  SELECT pid, '' AS path, a AS x, b AS y, 0::BIGINT AS m FROM tpairs
  UNION ALL
  SELECT pid, path || side,
         CASE side WHEN 'L' THEN substr(x, 1, i0 - 1) ELSE substr(x, i0 + n) END,
         CASE side WHEN 'L' THEN substr(y, 1, j0 - 1) ELSE substr(y, j0 + n) END,
         CASE side WHEN 'L' THEN n ELSE 0 END
  FROM (
    SELECT *, row_number() OVER (PARTITION BY pid, path ORDER BY n DESC, i0, j0) AS best FROM (
      SELECT pid, path, any_value(x) AS x, any_value(y) AS y, min(i) AS i0, min(j) AS j0, count(*)::BIGINT AS n FROM (
        SELECT *, i - row_number() OVER (PARTITION BY pid, path, i - j ORDER BY i) AS run FROM (
          SELECT pid, path, x, y, i, unnest(generate_series(1, length(y))) AS j FROM (
            SELECT pid, path, x, y, unnest(generate_series(1, length(x))) AS i FROM blocks WHERE x <> '' AND y <> ''))
        WHERE substr(x, i, 1) = substr(y, j, 1))
      GROUP BY pid, path, i - j, run))
  CROSS JOIN (VALUES ('L'), ('R')) s(side)
  WHERE best = 1"""),
        ("ratios", """
  SELECT t.a, t.b, 2.0::DOUBLE * w.m / (length(t.a) + length(t.b)) AS ratio
  FROM tpairs t JOIN (SELECT pid, sum(m)::DOUBLE AS m FROM blocks GROUP BY pid) w ON w.pid = t.pid"""),
    ]


def reg_ratio(name: str, body: str, extra):
    SQL[name] = with_ctes(body, extra).replace("WITH ", "WITH RECURSIVE ", 1)


def titled(pairs: str, least: float = 0.5) -> list[tuple[str, str]]:
    """Scored edges ``edges_t`` of the (new_id, id) pairs in the relation ``pairs``: those of ``least`` or more."""
    names = f"SELECT lower(n.title_norm) AS a, lower(o.title_norm) AS b FROM {pairs} p JOIN newl n ON n.id = p.new_id JOIN other o ON o.id = p.id"
    total = ("((CASE WHEN dn THEN 0.4::DOUBLE ELSE 0.0::DOUBLE END + CASE WHEN j > 0 THEN j * 0.3::DOUBLE ELSE 0.0::DOUBLE END)"
             " + CASE WHEN r > 0.7 THEN r * 0.2::DOUBLE ELSE 0.0::DOUBLE END) + CASE WHEN dp > 0 THEN dp * 0.1::DOUBLE ELSE 0.0::DOUBLE END")
    return [*ratio_ctes(names), ("edges_t", f"""
  SELECT new_id AS parent_event_id, id AS related_event_id, {total} AS confidence_raw, ts, k, dn, j, dp, r,
         CASE WHEN dn THEN 'references' WHEN j > 0 THEN 'related_products' WHEN r > 0.7 THEN 'similar_topic' END AS relationship_type,
         array_to_string(list_filter([CASE WHEN dn THEN 'document_number' END, CASE WHEN j > 0 THEN 'hts_codes' END, CASE WHEN r > 0.7 THEN 'title' END,
                                      CASE WHEN dp > 0 THEN 'date_proximity' END], lambda x: x IS NOT NULL), ',') AS factors
  FROM (SELECT q.*, coalesce(t.ratio, 0.0::DOUBLE) AS r, o.ingestion_timestamp AS ts, o.k
        FROM ({PAIR_PARTS.format(pairs=pairs)}) q JOIN newl n ON n.id = q.new_id JOIN other o ON o.id = q.id
        LEFT JOIN ratios t ON t.a = lower(n.title_norm) AND t.b = lower(o.title_norm))
  WHERE {total} >= {least}""")]


reg_ratio("title_ratio", """
SELECT c.new_id, c.id, coalesce(t.ratio, 0.0::DOUBLE) AS ratio
FROM reach c JOIN newl n ON n.id = c.new_id JOIN other o ON o.id = c.id
LEFT JOIN ratios t ON t.a = lower(n.title_norm) AND t.b = lower(o.title_norm)""",
          [*REACHX, *ratio_ctes("SELECT lower(n.title_norm) AS a, lower(o.title_norm) AS b FROM reach p JOIN newl n ON n.id = p.new_id JOIN other o ON o.id = p.id")])
reg_ratio("link_documents", "SELECT parent_event_id, related_event_id, relationship_type, confidence_raw, factors FROM edges_t", [*LINKX, *titled("cands")])
reg_ratio("link_documents_all", "SELECT parent_event_id, related_event_id, relationship_type, confidence_raw FROM edges_t", [*REACHX, *titled("reach")])
reg_ratio("fr_pipeline_links", """
SELECT parent_event_id, related_event_id, relationship_type, confidence_raw,
       row_number() OVER (PARTITION BY parent_event_id ORDER BY round_even(confidence_raw, 2) DESC, ts DESC, k DESC, related_event_id)::INTEGER AS match_rank
FROM edges_t""", [*REACHX, *titled("reach")])
_SIDE = ("SELECT id, min(id) OVER w AS class_id, CASE WHEN k % 7 = 0 THEN 3 ELSE 1 END AS copies, "
         "sum(CASE WHEN k % 7 = 0 THEN 3 ELSE 1 END) OVER w AS n FROM {side} WINDOW w AS (PARTITION BY {source}, title_norm, codes, pub_iso, {number})")
CLASSX = [*REACHX, *titled("reach"), ("newc", _SIDE.format(side="newl", source="1", number="fr_no")), ("otherc", _SIDE.format(side="other", source="source", number="1")),
          ("edges_c", """
  SELECT DISTINCT a.class_id AS parent_class, b.class_id AS related_class, a.n::BIGINT AS n_parents, b.n::BIGINT AS n_related, relationship_type, confidence_raw
  FROM edges_t e JOIN newc a ON a.id = e.parent_event_id JOIN otherc b ON b.id = e.related_event_id""")]
reg_ratio("link_classes", "SELECT parent_class, related_class, n_parents, n_related, relationship_type, confidence_raw FROM edges_c", CLASSX)
reg_ratio("class_link_counts", """
SELECT a.id || c.suffix AS id, a.class_id, coalesce(e.n, 0)::BIGINT AS n_links
FROM newc a JOIN (VALUES ('', 1), ('#1', 2), ('#2', 3)) c(suffix, number) ON c.number <= a.copies
LEFT JOIN (SELECT parent_class, sum(n_related) AS n FROM edges_c GROUP BY 1) e ON e.parent_class = a.class_id""", CLASSX)
reg_ratio("rank_matches", """
SELECT parent_event_id, related_event_id, confidence_raw,
       row_number() OVER (PARTITION BY parent_event_id ORDER BY round_even(confidence_raw, 2) DESC, ts DESC, k DESC, related_event_id)::INTEGER AS match_rank
FROM edges_t""", [*REACHX, *titled("reach")])
reg_ratio("edge_upsert_ignore", "SELECT parent_event_id, related_event_id, relationship_type, confidence_raw FROM edges_t", [*REACHX, *titled("reach")])
reg_ratio("relationship_type", "SELECT parent_event_id, related_event_id, relationship_type, factors FROM edges_t", [*REACHX, *titled("reach")])
reg_ratio("link_confidence", "SELECT parent_event_id, related_event_id, confidence_raw, dn, j, dp, r AS title_ratio FROM edges_t",
          [*REACHX, *titled("reach", 0.0)])
reg_ratio("check_constraints", """
SELECT rule, severity, violations::BIGINT AS violations FROM (
  SELECT 'confidence_score_range' AS rule, 'error' AS severity, 0 AS violations
  UNION ALL SELECT 'validation_status_enum', 'error', 0
  UNION ALL SELECT 'content_hash_not_null', 'error', count(*) FILTER (WHERE content_hash IS NULL) FROM ev_all
  UNION ALL SELECT 'parser_version_not_null', 'error', 0
  UNION ALL SELECT 'source_not_null', 'error', 0
  UNION ALL SELECT 'source_priority_not_null', 'error', 0
  UNION ALL SELECT 'data_not_null', 'error', 0
  UNION ALL SELECT 'ingestion_timestamp_not_null', 'error', 0
  UNION ALL SELECT 'content_hash_unique', 'error', coalesce(sum(n - 1), 0) FROM (
      SELECT content_hash, count(*) AS n FROM ev_all GROUP BY 1 HAVING count(*) > 1)
  UNION ALL SELECT 'parent_event_id_fk', 'error', count(*) FROM edges_t WHERE parent_event_id NOT IN (SELECT id FROM ev_all)
  UNION ALL SELECT 'related_event_id_fk', 'error', count(*) FROM edges_t WHERE related_event_id NOT IN (SELECT id FROM ev_all)
  UNION ALL SELECT 'edge_pair_unique', 'error', coalesce(sum(n - 1), 0) FROM (
      SELECT parent_event_id, related_event_id, count(*) AS n FROM edges_t GROUP BY 1, 2 HAVING count(*) > 1)
  UNION ALL SELECT 'edge_confidence_range', 'error', count(*) FILTER (WHERE confidence_raw < 0 OR confidence_raw > 1) FROM edges_t
)""", [*REACHX, *titled("reach"), _EVENTS_ALL])

_DAMAGED = [("ev_k", "SELECT id, k FROM store UNION ALL SELECT id, k FROM fr_new"), ("edges_d", """
  SELECT parent_event_id, related_event_id, relationship_type FROM edges_t
  UNION ALL SELECT parent_event_id, related_event_id, relationship_type FROM edges_t WHERE relationship_type = 'references'""")]
_KINDS = ["confidence_score_range", "validation_status_enum", "content_hash_not_null", "parser_version_not_null", "source_not_null",
          "source_priority_not_null", "data_not_null", "ingestion_timestamp_not_null", "content_hash_unique"]
reg_ratio("check_constraints_damaged", "SELECT rule, 'error' AS severity, violations::BIGINT AS violations FROM (\n" + "\n".join(
    f"  SELECT '{rule}' AS rule, count(*) AS violations FROM ev_k WHERE k % 40 = {n} UNION ALL" for n, rule in enumerate(_KINDS)) + """
  SELECT 'parent_event_id_fk', count(*) FROM edges_d e JOIN ev_k v ON v.id = e.parent_event_id WHERE v.k % 40 = 9
  UNION ALL SELECT 'related_event_id_fk', count(*) FROM edges_d e JOIN ev_k v ON v.id = e.related_event_id WHERE v.k % 40 = 9
  UNION ALL SELECT 'edge_pair_unique', count(*) FROM edges_t WHERE relationship_type = 'references'
  UNION ALL SELECT 'edge_confidence_range', count(*) FROM edges_t WHERE relationship_type = 'related_products')""", [*REACHX, *titled("reach"), *_DAMAGED])

DUP_NEW = ("dnew", """
  SELECT CAST(k AS VARCHAR) AS new_id, fr_no,
         CASE WHEN k % 5 = 1 THEN list_slice(list_sort(codes), 1, greatest(1, len(codes) - 1)) ELSE codes END AS codes,
         CASE k % 5 WHEN 2 THEN title_norm || ' corrected' WHEN 3 THEN 'Other' ELSE title_norm END AS title,
         CASE WHEN k % 5 = 4 THEN '1990-01-01' ELSE pub_iso END AS pub
  FROM docs4 WHERE source = 'federal_register'""")
DUP_PAIRS = ("dpairs", """
  SELECT n.new_id, s.id AS existing_id, lower(n.title) AS a, lower(s.title_norm) AS b, n.pub IS NOT DISTINCT FROM s.pub_iso AS same_day,
         CASE WHEN len(n.codes) > 0 AND len(s.codes) > 0
              THEN len(list_intersect(n.codes, s.codes))::DOUBLE / len(list_distinct(list_concat(n.codes, s.codes)))::DOUBLE END AS overlap
  FROM dnew n JOIN store s ON s.source = 'federal_register' AND s.fr_no = n.fr_no""")
DUP_SCORED = ("dscored", """
  SELECT new_id, existing_id, ((0.4::DOUBLE + coalesce(0.3::DOUBLE * overlap, 0.0::DOUBLE)) + 0.2::DOUBLE * t.ratio)
         + CASE WHEN same_day THEN 0.1::DOUBLE ELSE 0.0::DOUBLE END AS similarity
  FROM dpairs d JOIN ratios t ON t.a = d.a AND t.b = d.b""")
DUPX = [DUP_NEW, DUP_PAIRS, *ratio_ctes("SELECT a, b FROM dpairs"), DUP_SCORED]
reg_ratio("doc_similarity", "SELECT new_id, existing_id, similarity FROM dscored", DUPX)
reg_ratio("near_duplicates", "SELECT new_id, existing_id, similarity FROM dscored WHERE similarity >= 0.85", DUPX)
reg_ratio("rank_duplicates", """
SELECT new_id, existing_id, row_number() OVER (PARTITION BY new_id ORDER BY similarity DESC, existing_id)::INTEGER AS dup_rank
FROM dscored WHERE similarity >= 0.85""", DUPX)


def all_sql() -> dict[str, str]:
    return dict(SQL)

# ----------------------------------------------------------------- T / K sinks (same rows as the batch results)

SQL["incremental_ingest"] = SQL["fr_pipeline"]
SQL["append_events"] = SQL["fr_pipeline"]
reg("late_page_events", f"SELECT {EV_COLS.format(prio=1)}, k % 15 = 0 AS late FROM fr_new WHERE k % 15 <> 0 OR k % 30 = 0")
reg("pending_documents", "SELECT k::BIGINT AS arrival_seq, url AS source_url, k % 30 = 0 AS resolved FROM filings WHERE source = 'federal_register' AND k % 15 = 0")
SQL["append_relationships"] = SQL["edge_upsert_ignore"]
reg("pdf_hts_codes", """
SELECT f.k, string_agg(DISTINCT p.code, ',' ORDER BY p.code) AS codes
FROM filings f JOIN plines p ON p.l_orderkey = f.pk WHERE f.pdf_url IS NOT NULL GROUP BY f.k""")

# K3/K4: raw zone names and body sizes (the page HTML length from its generating pieces)
_FIXED = (len("<!DOCTYPE html><html><head><title>") + len("</title><style>td{padding:0}</style></head><body>")
          + len("<nav><table><tr><td>9999.99.9999</td><td>decoy navigation</td></tr></table></nav>")
          + len("<h1>") + len("</h1>") + len("<table><tr><th>HTS</th><th>Description</th></tr>") + len("</table>")
          + len("<footer>Contact 0000.00.0001 &copy; office</footer></body></html>"))
_WRAP_ART = len("<article>") + len("</article>")
_WRAP_CBP = len('<div class="bulletin-content">') + len("</div>")
RAW_ZONE = ("raw_rows", f"""
  SELECT f.source, CAST(f.k AS VARCHAR) AS doc_id,
         f.source || '_' || CAST(f.k AS VARCHAR) || '_20260101_061500.html' AS name,
         ({_FIXED} + 2 * length(f.title) + CASE WHEN f.source = 'cbp_csms' THEN {_WRAP_CBP} ELSE {_WRAP_ART} END
          + coalesce(s.n, 0))::INTEGER AS body_chars, f.pdf_url
  FROM filings f LEFT JOIN (
    SELECT k, sum(length('<p>' || sentence || '</p>')
                  + length('<tr><td> ' || code || '<td>Part ' || CAST(l_partkey AS VARCHAR) || ' &amp; parts')
                  + CASE WHEN k % 13 = 5 THEN length('<table><tr><td>see ' || code || '</table>') ELSE 0 END
                  + CASE WHEN k % 11 = 4 THEN 0 WHEN k % 13 = 5 THEN length('</td></td></tr></td></tr>') ELSE length('</td></td></tr>') END) AS n
    FROM page_lines GROUP BY k) s ON s.k = f.k""")
reg("raw_zone", "SELECT source, doc_id, name, body_chars FROM raw_rows", [RAW_ZONE])
reg("read_raw", "SELECT source, doc_id, name, body_chars FROM raw_rows WHERE pdf_url IS NOT NULL", [RAW_ZONE])
reg("raw_lineage", """
SELECT n.id, t.kind, 'federal_register_' || f.no || '_20260101_061500.' || t.kind AS name, true AS is_landed
FROM fr_new n JOIN filings f ON f.k = n.k JOIN (VALUES ('html'), ('pdf'), ('json')) t(kind)
  ON t.kind <> 'pdf' OR (f.pdf_url IS NOT NULL AND f.pk IN (SELECT l_orderkey FROM plines))   -- a PDF of no line has no page""")
