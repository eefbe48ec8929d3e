"""DuckDB SQL for the deterministic projections and the expected pipeline state.

The oracle computes expected values from the rules that generate the landed
data (e.g. which codes a page carries, which date a string encodes) rather than
re-running the same regular expressions, so a Spark parsing or extraction bug
shows up as a mismatch.
"""

from __future__ import annotations

PAD6 = "CASE WHEN length(CAST({x} AS VARCHAR)) < 6 THEN lpad(CAST({x} AS VARCHAR), 6, '0') ELSE CAST({x} AS VARCHAR) END"

CTES = {}

CTES["f0"] = """
f0 AS (
  SELECT o_orderkey AS k, o_orderkey - o_orderkey % 3 AS pk,
         first_value(CAST(o_orderdate AS DATE)) OVER (PARTITION BY o_orderkey - o_orderkey % 3 ORDER BY o_orderkey) AS p_date,
         first_value(o_orderpriority) OVER (PARTITION BY o_orderkey - o_orderkey % 3 ORDER BY o_orderkey) AS p_prio
  FROM orders
)"""

CTES["f1"] = """
f1 AS (
  SELECT k, pk, p_date, p_prio, p_date + CAST(7 * (k % 3) AS INTEGER) AS pd,
         CAST(year(p_date) AS VARCHAR) || '-' || """ + PAD6.format(x="pk") + """ AS no
  FROM f0
)"""

CTES["filings"] = """
filings AS (
  SELECT k, pk,
    CASE k % 3 WHEN 0 THEN 'federal_register' WHEN 1 THEN 'ustr' ELSE 'cbp_csms' END AS source,
    pd AS landed_date, no,
    CASE WHEN k % 20 = 4 THEN NULL WHEN k % 20 = 9 THEN 'to be announced'
         WHEN k % 5 = 1 THEN strftime(pd, '%m/%d/%Y') WHEN k % 5 = 2 THEN strftime(pd, '%B %-d, %Y')
         WHEN k % 5 = 3 THEN strftime(pd, '%Y%m%d') ELSE strftime(pd, '%Y-%m-%d') END AS publication_date,
    CASE WHEN k % 20 IN (4, 9) THEN NULL ELSE strftime(pd, '%Y-%m-%d') END AS pub_iso,
    CASE WHEN k % 3 = 2 THEN 'CSMS #' || CAST(50000000 + k AS VARCHAR) || ' ' ELSE '' END ||
    CASE WHEN k % 3 = 0 THEN 'Notice of tariff action ' || no
         WHEN k % 4 = 1 THEN 'Guidance on FR Doc. ' || no
         ELSE 'Notice of tariff action, guidance ' || CAST(pk AS VARCHAR) END AS title,
    CASE k % 3 WHEN 0 THEN 'https://www.federalregister.gov/d/' || no
               WHEN 1 THEN 'https://ustr.gov/about-us/press-releases/' || CAST(k AS VARCHAR)
               ELSE 'https://www.cbp.gov/csms/' || CAST(k AS VARCHAR) END AS url,
    p_prio AS priority,
    CASE WHEN k % 3 = 0 AND k % 2 = 0 THEN 'https://www.govinfo.gov/fr/' || no || '.pdf' END AS pdf_url,
    CASE WHEN k % 3 = 0 THEN 'Tariff changes for order ' || CAST(pk AS VARCHAR) || '; import duties' ELSE '' END AS abstract,
    CASE WHEN k % 9 = 0 THEN CAST(k AS VARCHAR) END AS proclamation_number
  FROM f1
)"""

CTES["plines"] = """
plines AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_shipdate,
         lpad(CAST((l_partkey * 4999999) % 10000000000 AS VARCHAR), 10, '0') AS g,
         substr(lpad(CAST((l_partkey * 4999999) % 10000000000 AS VARCHAR), 10, '0'), 1, 4) || '.' ||
         substr(lpad(CAST((l_partkey * 4999999) % 10000000000 AS VARCHAR), 10, '0'), 5, 2) || '.' ||
         substr(lpad(CAST((l_partkey * 4999999) % 10000000000 AS VARCHAR), 10, '0'), 7, 4) AS code,
         (l_orderkey + l_linenumber) % 3 AS variant,
         CASE l_suppkey % 4 WHEN 0 THEN 'CN' WHEN 1 THEN 'MX' WHEN 2 THEN 'ZZ' ELSE 'KR and CN' END AS country,
         CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS q
  FROM lineitem
)"""

CTES["plines2"] = """
plines2 AS (
  SELECT *, 'Notice: effective ' || CASE variant WHEN 0 THEN 'date is ' WHEN 1 THEN 'on ' ELSE '' END ||
         strftime(l_shipdate, '%B %-d, %Y') || ' the duty on HTS ' || code || ' and ' || substr(g, 1, 4) || '.' || substr(g, 5, 2) ||
         ' (ref ' || g || ') from ' || country || ' is ' || q || '% plus $' || CAST(l_linenumber AS VARCHAR) ||
         ' per kg. CSMS #' || CAST(50000000 + l_orderkey AS VARCHAR) || '.' AS sentence
  FROM plines
)"""

# lines each filing's page carries (line 1 left out when k % 7 = 0)
CTES["page_lines"] = """
page_lines AS (
  SELECT f.k, f.source, p.* FROM filings f JOIN plines2 p ON p.l_orderkey = f.pk
  WHERE NOT (f.k % 7 = 0 AND p.l_linenumber = 1)
)"""

# per filing: merged code set (page codes, plus all parent codes for FR filings with a PDF)
CTES["doc_codes"] = """
doc_codes AS (
  SELECT k, list(DISTINCT code ORDER BY code) AS codes FROM (
    SELECT k, code FROM page_lines
    UNION ALL
    SELECT f.k, p.code FROM filings f JOIN plines p ON p.l_orderkey = f.pk WHERE f.pdf_url IS NOT NULL
  ) GROUP BY k
)"""

# CBP effective date: first page line (page order) whose sentence matches 'effective (date is )?Month d, yyyy'
CTES["cbp_eff"] = """
cbp_eff AS (
  SELECT k, strftime(l_shipdate, '%Y-%m-%d') AS eff_iso FROM (
    SELECT k, l_shipdate, row_number() OVER (PARTITION BY k ORDER BY l_linenumber, l_partkey, sentence) AS rn
    FROM page_lines WHERE source = 'cbp_csms' AND variant <> 1
  ) WHERE rn = 1
)"""

CTES["docs"] = """
docs AS (
  SELECT f.*, coalesce(c.codes, []) AS codes,
         CASE WHEN f.source = 'cbp_csms' THEN e.eff_iso END AS eff_iso,
         CASE f.source WHEN 'federal_register' THEN coalesce(f.priority, 'Unknown') WHEN 'ustr' THEN 'Press Release'
              ELSE 'CSMS Message' END AS document_type,
         CASE WHEN f.source = 'federal_register' THEN f.no END AS fr_no,
         regexp_replace(f.title, '[^\\p{L}\\p{N}_\\s\\-.,;:()\\[\\]/]', '', 'g') AS title_norm
  FROM filings f LEFT JOIN doc_codes c ON c.k = f.k LEFT JOIN cbp_eff e ON e.k = f.k
)"""

CTES["docs2"] = """
docs2 AS (
  SELECT *, len(codes) AS n_products,
         len(list_filter(codes, lambda x: substr(x, 1, 2) <> '00')) AS n_valid,
         (pub_iso IS NOT NULL AND NOT coalesce(eff_iso < pub_iso, false)) AS date_valid
  FROM docs
)"""

CTES["docs3"] = """
docs3 AS (
  SELECT *,
    greatest(0.0::DOUBLE, least(1.0::DOUBLE,
      0.0::DOUBLE + ((4 + CASE WHEN pub_iso IS NULL THEN 0 ELSE 1 END)::DOUBLE / 5.0::DOUBLE) * 0.25::DOUBLE
      + (CASE WHEN n_products > 0 THEN n_valid::DOUBLE / n_products::DOUBLE ELSE 0.0::DOUBLE END) * 0.25::DOUBLE
      + (CASE WHEN date_valid THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) * 0.15::DOUBLE
      + 0.0::DOUBLE * 0.15::DOUBLE
      + 1.0::DOUBLE * 0.2::DOUBLE)) AS confidence_raw,
    CASE WHEN date_valid THEN 'verified' ELSE 'failed' END AS validation_status,
    sha256('{"document_type": "' || document_type || '", "fr_document_number": ' ||
           CASE WHEN fr_no IS NULL THEN 'null' ELSE '"' || fr_no || '"' END ||
           ', "hts_codes": [' || coalesce(array_to_string(list_transform(codes, lambda x: '"' || x || '"'), ', '), '') ||
           '], "publication_date": ' || CASE WHEN pub_iso IS NULL THEN 'null' ELSE '"' || pub_iso || '"' END ||
           ', "source": "' || source || '"}') AS content_hash
  FROM docs2
)"""

CTES["docs4"] = """
docs4 AS (
  SELECT *, substr(content_hash, 1, 8) || '-' || substr(content_hash, 9, 4) || '-' || substr(content_hash, 13, 4) || '-' ||
            substr(content_hash, 17, 4) || '-' || substr(content_hash, 21, 12) AS id
  FROM docs3
)"""

# store = FR filings landed before the cutoff + all USTR + all CBP, first per hash within each run
CTES["store"] = """
store AS (
  SELECT *, CASE source WHEN 'federal_register' THEN TIMESTAMP '2025-11-30 06:15:00'
                        WHEN 'ustr' THEN TIMESTAMP '2025-12-01 08:00:00' ELSE TIMESTAMP '2025-12-02 00:30:00' END AS ingestion_timestamp
  FROM (
    SELECT *, row_number() OVER (PARTITION BY source, content_hash ORDER BY k) AS rn FROM docs4
    WHERE source <> 'federal_register' OR landed_date < DATE '1998-01-01'
  ) WHERE rn = 1
)"""

# new FR run: all FR filings, minus hashes stored for FR, first per hash
CTES["fr_new"] = """
fr_new AS (
  SELECT *, TIMESTAMP '2026-01-01 06:15:00' AS ingestion_timestamp FROM (
    SELECT *, row_number() OVER (PARTITION BY content_hash ORDER BY k) AS rn FROM docs4 d
    WHERE source = 'federal_register'
      AND NOT EXISTS (SELECT 1 FROM store s WHERE s.source = 'federal_register' AND s.content_hash = d.content_hash)
  ) WHERE rn = 1
)"""

ORDER = ["f0", "f1", "filings", "plines", "plines2", "page_lines", "doc_codes", "cbp_eff", "docs", "docs2", "docs3",
         "docs4", "store", "fr_new"]


def with_ctes(select_sql: str, extra: list[tuple[str, str]] | None = None) -> str:
    """Prefix a SELECT with every base CTE (DuckDB inlines only the referenced ones)."""
    parts = [CTES[n] for n in ORDER]
    for name, body in extra or []:
        parts.append(f"\n{name} AS (\n{body}\n)")
    return "WITH " + ",".join(parts) + "\n" + select_sql
