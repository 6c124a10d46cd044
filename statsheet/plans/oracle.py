"""Reference SQL (DuckDB dialect) for the registered queries.

Written independently of the Spark code from the query semantics: plain
UNION ALL unpivots, window functions and ORDER BY ... LIMIT over the views
``orders``, ``lineitem``, ``events``, ``customer``, ``pages`` etc.
"""

from __future__ import annotations

# ---- observation views as SQL fragments ------------------------------------

ORDERS_OBS = """
SELECT strftime(o_orderdate, '%Y-%m-%d') AS period, 'total_price' AS measure, o_totalprice AS value, 'USD' AS unit,
       o_orderstatus AS status, o_orderpriority AS priority, CAST(o_custkey AS VARCHAR) AS customer,
       CAST(o_orderkey AS VARCHAR) AS orderkey, o_orderkey AS o0, 0 AS midx
FROM orders
WHERE o_totalprice IS NOT NULL AND NOT isnan(o_totalprice)
  AND NOT (o_orderdate IS NULL AND o_orderstatus IS NULL AND o_orderpriority IS NULL AND o_custkey IS NULL)
"""

ORDERS_COLS = "period, measure, value, unit, status, priority, customer, orderkey"

_LINE_MEASURES = (
    ("quantity", "l_quantity", "units", 0),
    ("extended_price", "l_extendedprice", "USD", 1),
    ("discount", "l_discount", "ratio", 2),
    ("tax", "l_tax", "ratio", 3),
)

LINE_COLS = "period, measure, value, unit, returnflag, linestatus, orderkey, partkey, suppkey, linenumber"


def lineitem_obs(measures: tuple[str, ...] | None = None, where: str = "TRUE") -> str:
    parts = []
    for key, src, unit, idx in _LINE_MEASURES:
        if measures is not None and key not in measures:
            continue
        parts.append(
            f"""SELECT strftime(l_shipdate, '%Y-%m-%d') AS period, '{key}' AS measure, {src} AS value, '{unit}' AS unit,
       l_returnflag AS returnflag, l_linestatus AS linestatus, CAST(l_orderkey AS VARCHAR) AS orderkey,
       CAST(l_partkey AS VARCHAR) AS partkey, CAST(l_suppkey AS VARCHAR) AS suppkey,
       CAST(l_linenumber AS VARCHAR) AS linenumber,
       l_orderkey AS o0, l_partkey AS o1, l_suppkey AS o2, l_linenumber AS o3, {idx} AS midx
FROM lineitem
WHERE {src} IS NOT NULL AND NOT isnan({src})
  AND NOT (l_shipdate IS NULL AND l_returnflag IS NULL AND l_linestatus IS NULL)
  AND ({where})"""
        )
    return "\nUNION ALL\n".join(parts)


EVENTS_OBS = """
SELECT strftime(ts, '%Y-%m-%d') AS period, 'value' AS measure, value AS value, 'points' AS unit,
       event_type AS data_item, CAST(user_id AS VARCHAR) AS "user", CAST(event_id AS VARCHAR) AS event_id,
       event_id AS o0, 0 AS midx
FROM events
WHERE value IS NOT NULL AND NOT isnan(value)
  AND NOT (ts IS NULL AND event_type IS NULL AND user_id IS NULL)
"""

EVENTS_COLS = 'period, measure, value, unit, data_item, "user", event_id'

CUSTOMER_COLS = "period, measure, value, unit, name, segment, nation, custkey"

CUSTOMER_OBS = """
SELECT CAST(NULL AS VARCHAR) AS period, 'account_balance' AS measure, c_acctbal AS value, 'USD' AS unit,
       c_name AS name, c_mktsegment AS segment, CAST(c_nationkey AS VARCHAR) AS nation,
       CAST(c_custkey AS VARCHAR) AS custkey, c_acctbal AS sortv, c_custkey AS o0, 0 AS midx
FROM customer
WHERE c_acctbal IS NOT NULL AND NOT isnan(c_acctbal)
  AND NOT (c_name IS NULL AND c_mktsegment IS NULL AND c_nationkey IS NULL)
"""


def _orders(where: str) -> str:
    return f"SELECT {ORDERS_COLS} FROM ({ORDERS_OBS}) o WHERE {where}"


SQL: dict[str, str] = {}

SQL["observations_wide"] = f"SELECT {LINE_COLS} FROM ({lineitem_obs()}) x"
SQL["filter_eq"] = _orders("status = 'F'")
SQL["filter_in"] = _orders("status IN ('F', 'O')")
SQL["filter_and"] = _orders("status = 'F' AND priority = '1-URGENT'")
SQL["filter_wildcard"] = _orders("contains(upper(priority), 'URG')")
_FILTER_ID_WHERE = "l_linenumber IN (1, 3) AND l_returnflag = 'R'"
SQL["filter_id"] = f"SELECT {LINE_COLS} FROM ({lineitem_obs(('quantity',), where=_FILTER_ID_WHERE)}) x"
SQL["period_year"] = _orders("period >= '1996-01-01' AND period <= '1996-12-31'")
SQL["period_quarter"] = _orders("period >= '1996-04-01' AND period <= '1996-06-30'")
SQL["period_month_end"] = _orders("period >= '1996-02-01' AND period <= '1996-02-29'")
_OPEN_WHERE = "l_shipdate >= TIMESTAMP '2001-06-01'"
SQL["period_open_ended"] = f"SELECT {LINE_COLS} FROM ({lineitem_obs(('discount', 'tax'), where=_OPEN_WHERE)}) x"

SQL["expand_period_table"] = """
SELECT o_orderkey AS orderkey,
       strftime(o_orderdate, '%Y') || '-01-01' AS as_year_start,
       strftime(o_orderdate, '%Y') || '-12-31' AS as_year_end,
       strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS as_month_start,
       strftime(last_day(o_orderdate), '%Y-%m-%d') AS as_month_end,
       strftime(date_trunc('quarter', o_orderdate), '%Y-%m-%d') AS as_quarter_start,
       strftime(last_day(date_trunc('quarter', o_orderdate) + INTERVAL 2 MONTH), '%Y-%m-%d') AS as_quarter_end,
       strftime(o_orderdate, '%Y-%m-%d') AS as_date_start,
       strftime(o_orderdate, '%Y-%m-%d') AS as_date_end,
       o_orderpriority AS as_text_start,
       o_orderpriority AS as_text_end
FROM orders
"""

SQL["top_n"] = f"""
SELECT {ORDERS_COLS} FROM ({ORDERS_OBS}) o
ORDER BY value DESC, o0 LIMIT 10
"""
SQL["bottom_n"] = f"""
SELECT {ORDERS_COLS} FROM ({ORDERS_OBS}) o
ORDER BY value ASC, o0 LIMIT 10
"""
SQL["top_n_all"] = f"""
SELECT {LINE_COLS} FROM ({lineitem_obs(('extended_price',))}) x
ORDER BY value DESC, o0, o1, o2, o3 LIMIT 25
"""
SQL["top_n_lines"] = f"""
SELECT {LINE_COLS} FROM ({lineitem_obs(('quantity',))}) x
ORDER BY value DESC, o0, o1, o2, o3 LIMIT 25
"""
SQL["latest_multi"] = f"""
SELECT {LINE_COLS} FROM ({lineitem_obs()}) x
QUALIFY row_number() OVER (PARTITION BY measure ORDER BY period DESC NULLS LAST, o0 DESC, o1 DESC, o2 DESC, o3 DESC) = 1
"""
SQL["latest_single"] = f"""
SELECT {ORDERS_COLS} FROM ({ORDERS_OBS}) o
WHERE period = (SELECT max(period) FROM ({ORDERS_OBS}) p)
ORDER BY o0 LIMIT 50
"""
SQL["latest_long"] = f"""
SELECT {EVENTS_COLS} FROM ({EVENTS_OBS}) e
WHERE period = (SELECT max(period) FROM ({EVENTS_OBS}) p)
"""
SQL["latest_n_periods"] = f"""
SELECT {ORDERS_COLS} FROM ({ORDERS_OBS}) o
WHERE period IN (SELECT DISTINCT period FROM ({ORDERS_OBS}) p WHERE period IS NOT NULL ORDER BY period DESC LIMIT 3)
"""
SQL["latest_tail_n"] = f"""
SELECT {LINE_COLS} FROM ({lineitem_obs()}) x
QUALIFY row_number() OVER (PARTITION BY measure ORDER BY period DESC NULLS LAST, o0 DESC, o1 DESC, o2 DESC, o3 DESC) <= 5
"""
SQL["limit_truncated"] = f"""
SELECT {LINE_COLS} FROM ({lineitem_obs()}) x
ORDER BY o0, o1, o2, o3, midx LIMIT 50
"""
SQL["summary_row"] = f"""
SELECT 'LINEITEM' AS dataset_id, CAST(least(count(*), 50) AS BIGINT) AS row_count,
       CAST(CASE WHEN count(*) > 50 THEN count(*) END AS BIGINT) AS truncated_at,
       CASE WHEN count(DISTINCT unit) = 1 THEN max(unit) END AS unit,
       min(period) AS period_start, max(period) AS period_end
FROM ({lineitem_obs()}) x
"""
SQL["summary_unit"] = f"""
SELECT 'ORDERS' AS dataset_id, CAST(least(count(*), 50) AS BIGINT) AS row_count,
       CAST(CASE WHEN count(*) > 50 THEN count(*) END AS BIGINT) AS truncated_at,
       CASE WHEN count(DISTINCT unit) = 1 THEN max(unit) END AS unit,
       min(period) AS period_start, max(period) AS period_end
FROM ({ORDERS_OBS}) o
"""
SQL["series"] = f"""
SELECT measure,
       arg_min(unit, (o0, o1, o2, o3)) AS unit,
       count(*) AS n_obs,
       arg_min(period, (o0, o1, o2, o3)) AS first_period,
       arg_max(period, (o0, o1, o2, o3)) AS last_period
FROM ({lineitem_obs()}) x
GROUP BY measure
"""
SQL["default_sort_limit"] = f"""
SELECT {CUSTOMER_COLS} FROM ({CUSTOMER_OBS}) c
ORDER BY sortv DESC NULLS LAST, o0 LIMIT 50
"""

# ---- reshape ------------------------------------------------------------------

SQL["melt_transposed"] = """
WITH m AS (
  SELECT DISTINCT strftime(o_orderdate, '%b %Y') AS label, strftime(last_day(o_orderdate), '%Y-%m-%d') AS period
  FROM orders WHERE o_orderdate IS NOT NULL
), p AS (
  SELECT DISTINCT o_orderpriority AS priority FROM orders WHERE o_orderpriority IS NOT NULL
), agg AS (
  SELECT o_orderpriority AS priority, strftime(o_orderdate, '%b %Y') AS label, max(o_totalprice) AS value
  FROM orders GROUP BY 1, 2
)
SELECT p.priority, m.period, agg.value
FROM p CROSS JOIN m LEFT JOIN agg ON agg.priority = p.priority AND agg.label = m.label
"""
SQL["transposed_range"] = """
WITH agg AS (
  SELECT o_orderpriority AS priority, strftime(last_day(o_orderdate), '%Y-%m-%d') AS period, max(o_totalprice) AS value
  FROM orders WHERE o_orderpriority IS NOT NULL GROUP BY 1, 2
)
SELECT period, 'max_total_price' AS measure, value, 'USD' AS unit, priority, '1996-Q2' AS asked
FROM agg WHERE period BETWEEN '1996-04-01' AND '1996-09-30' AND value IS NOT NULL
"""
SQL["transposed_latest"] = """
WITH agg AS (
  SELECT o_orderpriority AS priority, strftime(last_day(o_orderdate), '%Y-%m-%d') AS period, max(o_totalprice) AS value
  FROM orders WHERE o_orderpriority IS NOT NULL GROUP BY 1, 2
)
SELECT period, 'max_total_price' AS measure, value, 'USD' AS unit, priority
FROM agg WHERE period = (SELECT max(period) FROM agg) AND value IS NOT NULL
"""
SQL["snapshot_header"] = """
SELECT '2001-08-31' AS period, 'account_balance' AS measure, c_acctbal AS value, 'USD' AS unit,
       c_name AS institution, c_mktsegment AS segment, CAST(c_custkey AS VARCHAR) AS custkey
FROM customer
WHERE c_acctbal IS NOT NULL AND NOT isnan(c_acctbal) AND NOT (c_name IS NULL AND c_mktsegment IS NULL)
"""
SQL["drop_blank"] = """
SELECT * FROM (
  SELECT o_orderkey AS orderkey, nullif(o_orderpriority, '5-LOW') AS "A", nullif(o_orderstatus, 'P') AS "B",
         o_totalprice AS "C"
  FROM orders
) t WHERE NOT ("A" IS NULL AND "B" IS NULL)
"""
SQL["header_promotion"] = """
SELECT c_name AS "Customer name", CAST(c_nationkey AS VARCHAR) AS "Unnamed: 1", CAST(c_custkey AS VARCHAR) AS "Customer key",
       c_mktsegment AS "Segment", lower(c_mktsegment) AS "Segment.1"
FROM customer
UNION ALL
SELECT 'Source: synthetic register', NULL, NULL, NULL, NULL
"""
SQL["coerce_types"] = """
SELECT c_custkey AS custkey,
       CAST(c_custkey AS DOUBLE) AS value_plain,
       CAST(c_custkey AS DOUBLE) AS value_padded,
       CAST(c_nationkey * 1000 AS DOUBLE) AS value_exp,
       CAST(NULL AS DOUBLE) AS value_suffix,
       CAST(NULL AS DOUBLE) AS value_comma,
       CAST(NULL AS DOUBLE) AS value_nbsp,
       CAST(NULL AS DOUBLE) AS value_text,
       c_acctbal AS value_frac,
       CAST(c_custkey AS VARCHAR) AS id_text,
       CAST(c_custkey AS VARCHAR) AS text_clean
FROM customer
"""

# ---- links ----------------------------------------------------------------------

_LINKS = r"""
WITH raw AS (
  SELECT page_id, url, regexp_extract_all(html, '(?i)href=["'']([^"'']+)["'']', 1) AS h FROM pages
), links AS (
  SELECT page_id, url, unnest(h) AS href, unnest(generate_series(0, len(h) - 1)) AS pos FROM raw
), absl AS (
  SELECT page_id, url, href, pos,
         CASE WHEN regexp_matches(href, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN href
              WHEN starts_with(href, '//') THEN regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*):', 1) || ':' || href
              WHEN starts_with(href, '/') THEN regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)', 1) || href
              ELSE regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)', 1)
                   || coalesce(nullif(regexp_replace(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1), '[^/]*$', ''), ''), '/')
                   || href END AS link_url
  FROM links
), named AS (
  SELECT *, regexp_extract(link_url, '[^/]*$') AS file_name FROM absl
)
"""

SQL["extract_links"] = _LINKS + "SELECT page_id, CAST(pos AS BIGINT) AS pos, href, link_url, file_name FROM named"

_BEST = _LINKS + r""", best AS (
  SELECT 'DS_' || CAST(page_id AS VARCHAR) AS dataset_id, link_url, file_name, CAST(0 AS BIGINT) AS score, CAST(pos AS BIGINT) AS pos
  FROM named
  WHERE NOT regexp_matches(file_name, '(?i)^(the|and|der|die)\W*$') AND regexp_matches(file_name, '(?i)^[a-m]')
  QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY pos) = 1
), seed AS (
  SELECT * FROM (
    SELECT 'DS_' || CAST(page_id AS VARCHAR) AS dataset_id,
           CASE WHEN contains(url, '#') THEN url ELSE h[1] END AS seed_url
    FROM raw
  ) s WHERE regexp_matches(seed_url, '^https?://')
), ds AS (
  SELECT 'DS_' || CAST(page_id AS VARCHAR) AS dataset_id,
         'https://files.example.com/DS_' || CAST(page_id AS VARCHAR) || '.xlsx' AS default_url
  FROM pages
), resolved AS (
  SELECT ds.dataset_id, ds.default_url, coalesce(best.link_url, seed.seed_url, ds.default_url) AS url,
         CASE WHEN best.link_url IS NOT NULL THEN 'scrape' WHEN seed.seed_url IS NOT NULL THEN 'seed' ELSE 'default' END AS tier
  FROM ds LEFT JOIN best USING (dataset_id) LEFT JOIN seed USING (dataset_id)
)
"""

SQL["best_link"] = _BEST + "SELECT dataset_id, link_url, file_name, score, pos FROM best"
SQL["resolve_tiers"] = _BEST + "SELECT dataset_id, default_url, url, tier, tier <> 'scrape' AS stale FROM resolved"
SQL["manifest_diff"] = _BEST + """
SELECT coalesce(seed.dataset_id, r.dataset_id) AS dataset_id, seed.seed_url AS old_url,
       coalesce(CASE WHEN r.tier = 'scrape' THEN r.url END, seed.seed_url, r.default_url) AS new_url,
       seed.seed_url IS DISTINCT FROM coalesce(CASE WHEN r.tier = 'scrape' THEN r.url END, seed.seed_url, r.default_url) AS changed
FROM seed FULL OUTER JOIN resolved r ON seed.dataset_id = r.dataset_id
"""

SQL["filename_score"] = """
SELECT o_orderkey AS orderkey,
       CAST(year(o_orderdate) * 100 + month(o_orderdate) AS BIGINT) AS s_month_name,
       CAST(year(o_orderdate) * 100 + month(o_orderdate) AS BIGINT) AS s_numeric,
       CAST(year(o_orderdate) * 100 AS BIGINT) AS s_year,
       CAST(0 AS BIGINT) AS s_none,
       CAST(greatest(year(o_orderdate) * 100 + 9, year(o_orderdate) * 100 + month(o_orderdate)) AS BIGINT) AS s_mixed,
       CAST(year(o_orderdate) * 100 + month(o_orderdate) AS BIGINT) AS s_path
FROM orders
"""


def _host(url: str) -> str:
    """The host from the authority: what follows its last @, up to a port."""
    return f"lower(split_part(list_last(string_split(regexp_extract({url}, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)', 1), '@')), ':', 1))"


_HOSTS = "('blog.tionsh.example.net', 'thther.example.org', 'www.ththhe.example.com')"
_REST = "split_part(url, '://', 2)"
_FORMS = {
    "spaced": "url || '/annual report|final 2.xlsx'",
    "user": f"'HTTPS://me:p@ss@' || {_REST}",
    "port": f"'http://' || upper(regexp_extract({_REST}, '^[^/?#]*')) || ':8080?q=a b#/x'",
    "bare": f"'//' || {_REST}",
}
SQL["host_filter"] = f"""
SELECT page_id, {_host('url')} AS host, {_host('url')} IN {_HOSTS} AS allowed,
       {', '.join(f"{_host(f'({u})')} AS {k}_host, {_host(f'({u})')} IN {_HOSTS} AS {k}_allowed" for k, u in _FORMS.items())},
       CAST(NULL AS VARCHAR) AS path_host, FALSE AS path_allowed
FROM pages
"""

# Redaction by cutting the text at its URLs and putting it together again.
def _redacted(text: str) -> str:
    url = "(?i)https?://[^\\s\"''<>)]*"
    return (
        f"(SELECT string_agg(part, '' ORDER BY i) FROM (SELECT unnest(string_split_regex({text}, '{url}')) AS part, unnest(range(1000000)[:len(string_split_regex({text}, '{url}'))]) * 2 AS i"
        f" UNION ALL SELECT CASE WHEN contains(lower(u), 'example.org') THEN '<source>' ELSE u END, i * 2 + 1 FROM "
        f"(SELECT unnest(regexp_extract_all({text}, '{url}')) AS u, unnest(range(1000000)[:len(regexp_extract_all({text}, '{url}'))]) AS i)))"
    )


SQL["redact_urls"] = f"""
WITH p AS (SELECT page_id, url, html, 'see https://x.example.org.mirror.net/secret/' || page_id || ' or http://me:pw@EXAMPLE.org/' || page_id
  || ', http://o.net/?to=example.org&k=' || page_id || ' but not example.org nor http://o.net/' || page_id AS made FROM pages)
SELECT page_id, {_redacted('p.url')} AS url, {_redacted('p.html')} AS html, {_redacted('p.made')} AS made FROM p
"""

SQL["resolve_urls"] = """
SELECT page_id, o || '/a/up' || page_id AS up, o || '/a/b' || page_id || '/here' || page_id AS here, o || '/top' || page_id AS top,
       o || '/a/b' || page_id || '/x/z%20' || page_id || '.xlsx?u=/../v' AS mixed, o || '/a/b' || page_id || '/c.html?q=' || page_id AS query,
       o || '/a/b' || page_id || '/c.html?x=1#m' || page_id AS mark, o || '/s' || page_id AS rooted, o || '/a/' AS folder, 'v' AS file_name
FROM (SELECT page_id, 'https://h' || page_id || '.example.org' AS o FROM pages)
"""

SQL["best_dated_link"] = """
SELECT 'DS_' || (o_custkey % 97) AS dataset_id, o_orderkey AS pos,
       CASE WHEN o_orderpriority = '1-URGENT' THEN 'data_' || strftime(o_orderdate, '%Y-%m') || ' DataBase.xlsx'
            ELSE 'Report ' || strftime(o_orderdate, '%B %Y') || '.xlsx' END AS file_name,
       (year(o_orderdate) * 100 + month(o_orderdate) + CASE WHEN o_orderpriority = '1-URGENT' AND o_custkey % 2 = 0 THEN 1000000 ELSE 0 END)::BIGINT AS score
FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey % 97 ORDER BY score DESC, o_orderkey) = 1
"""

# ---- lookups, pairings, places ---------------------------------------------------

SQL["alias_join"] = """
WITH aliases(alias, canonical) AS (
  VALUES ('automobile', 'AUTOMOBILE'), ('building', 'BUILDING'), ('furniture', 'FURNITURE'),
         ('household', 'HOUSEHOLD'), ('machinery', 'MACHINERY'),
         ('AUTOMOBILE', 'AUTOMOBILE'), ('BUILDING', 'BUILDING'), ('FURNITURE', 'FURNITURE'),
         ('HOUSEHOLD', 'HOUSEHOLD'), ('MACHINERY', 'MACHINERY')
), src AS (
  SELECT c_custkey AS custkey, CASE WHEN c_nationkey < 10 THEN lower(c_mktsegment) ELSE c_mktsegment END AS segment_raw
  FROM customer
)
SELECT src.custkey, src.segment_raw, a.canonical AS segment
FROM src LEFT JOIN aliases a ON a.alias = trim(src.segment_raw)
"""

SQL["entity_join"] = """
SELECT o_orderkey AS orderkey, c_name AS customer, c_mktsegment AS segment, o_totalprice AS total_price
FROM orders JOIN customer ON o_custkey = c_custkey
"""

SQL["basis_union"] = f"""
SELECT {ORDERS_COLS}, CASE WHEN period >= '1998-01-01' THEN 'current' ELSE 'historical' END AS basis
FROM ({ORDERS_OBS}) o WHERE period IS NOT NULL
"""


def _state_sql() -> str:
    # Written out here rather than taken from the library's own tables.
    long_names = {
        "NSW": "New South Wales", "VIC": "Victoria", "QLD": "Queensland", "SA": "South Australia", "WA": "Western Australia",
        "TAS": "Tasmania", "NT": "Northern Territory", "ACT": "Australian Capital Territory",
    }
    names = {"TASSIE": "Tasmania"}
    for code, name in long_names.items():
        names |= {code: name, "AU-" + code: name, name.upper(): name}
    name_rows = ", ".join(f"('{k}', '{v}')" for k, v in sorted(names.items()))
    band_rows = """(200, 299, 'Australian Capital Territory'), (800, 999, 'Northern Territory'), (1000, 2599, 'New South Wales'),
      (2600, 2618, 'Australian Capital Territory'), (2619, 2899, 'New South Wales'), (2900, 2920, 'Australian Capital Territory'),
      (2921, 2999, 'New South Wales'), (3000, 3999, 'Victoria'), (4000, 4999, 'Queensland'), (5000, 5999, 'South Australia'),
      (6000, 6797, 'Western Australia'), (6800, 6999, 'Western Australia'), (7000, 7999, 'Tasmania'), (8000, 8999, 'Victoria'),
      (9000, 9999, 'Queensland')"""
    spellings = ", ".join("'" + s.replace("'", "''") + "'" for s in (
        "NSW", "vic", "Queensland", "AU-WA", "Tassie", "act", "nt", "South Australia",
        "Total Australia", "au-qld", " Victoria ", "TAS", "Northern  Territory",
    ))
    return f"""
WITH names(k, state) AS (VALUES {name_rows}),
bands(lo, hi, state) AS (VALUES {band_rows}),
src AS (
  SELECT c_custkey AS custkey,
         list_value({spellings})[(c_nationkey % 13) + 1] AS place,
         lpad(CAST((c_custkey * 7) % 10000 AS VARCHAR), 4, '0') AS postcode
  FROM customer
)
SELECT src.custkey, src.place, src.postcode,
       coalesce(n1.state, b1.state, src.place) AS place_state,
       coalesce(n2.state, b2.state, src.postcode) AS postcode_state
FROM src
LEFT JOIN names n1 ON n1.k = upper(regexp_replace(trim(src.place), '\\s+', ' ', 'g'))
LEFT JOIN bands b1 ON regexp_matches(trim(src.place), '^[0-9]{{4}}$') AND TRY_CAST(trim(src.place) AS INTEGER) BETWEEN b1.lo AND b1.hi
LEFT JOIN names n2 ON n2.k = upper(regexp_replace(trim(src.postcode), '\\s+', ' ', 'g'))
LEFT JOIN bands b2 ON regexp_matches(trim(src.postcode), '^[0-9]{{4}}$') AND TRY_CAST(trim(src.postcode) AS INTEGER) BETWEEN b2.lo AND b2.hi
"""


SQL["state_lookup"] = _state_sql()

# ---- accumulation ------------------------------------------------------------------

SQL["accumulate_latest"] = """
SELECT user_id, strftime(ts, '%Y-%m-%d') AS day, event_id, event_type, value
FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, strftime(ts, '%Y-%m-%d') ORDER BY ts DESC, event_id DESC) = 1
"""

# ---- header periods, dataset ids --------------------------------------------------------

SQL["header_period_table"] = """
SELECT o_orderkey AS orderkey,
       strftime(last_day(o_orderdate), '%Y-%m-%d') AS h_month_period,
       strftime(last_day(o_orderdate), '%Y-%m-%d') AS h_lower_period,
       strftime(o_orderdate, '%Y-%m-%d') AS h_iso_period,
       'Q' || CAST(quarter(o_orderdate) AS VARCHAR) || ' ' || strftime(o_orderdate, '%Y') AS h_other_period
FROM orders
"""
SQL["dataset_id_canonical"] = """
SELECT p_partkey AS partkey, ' ' || replace(p_name, ' ', '_') || ' ' AS raw,
       CASE WHEN regexp_matches(upper(replace(p_name, ' ', '_')), '^[A-Z][A-Z0-9_]*$') THEN upper(replace(p_name, ' ', '_')) END AS dataset_id,
       CASE WHEN regexp_matches(upper(trim(p_brand)), '^[A-Z][A-Z0-9_]*$') THEN upper(trim(p_brand)) END AS brand_id
FROM part
"""

SQL["latest_default_sort"] = f"""
SELECT {CUSTOMER_COLS} FROM ({CUSTOMER_OBS}) c
QUALIFY row_number() OVER (ORDER BY (sortv IS NULL) DESC, sortv ASC, o0 DESC) = 1
"""

# ---- API surfaces -------------------------------------------------------------------------

SQL["measures_by_source"] = f"SELECT {LINE_COLS} FROM ({lineitem_obs(('tax', 'quantity'))}) x"
SQL["filters_json"] = _orders("status IN ('O', 'P') AND contains(upper(priority), 'LOW')")
SQL["bottom_n_wildcard"] = f"""
SELECT {ORDERS_COLS} FROM ({ORDERS_OBS}) o
WHERE contains(upper(priority), 'HIGH')
ORDER BY value ASC, o0 LIMIT 15
"""

SQL["series_nested"] = f"""
SELECT measure, any_value(unit) AS unit, count(*) AS n_obs,
       arg_min(period, (o0, o1, o2, o3)) AS first_period, arg_min(value, (o0, o1, o2, o3)) AS first_value,
       arg_max(period, (o0, o1, o2, o3)) AS last_period, arg_max(value, (o0, o1, o2, o3)) AS last_value,
       arg_max(orderkey, (o0, o1, o2, o3)) AS last_orderkey, TRUE AS bounded, TRUE AS numbered
FROM ({lineitem_obs()}) n GROUP BY measure
"""
SQL["csv_output"] = f"""
SELECT concat_ws(',', period, measure, CAST(value AS VARCHAR), unit, status, priority, customer, orderkey) AS csv
FROM ({ORDERS_OBS}) x
"""
SQL["summary_full"] = f"""
SELECT 'ORDERS' AS dataset_id, 'Orders by status and priority' AS dataset_name,
       '{{"dataset_id": "ORDERS", "end_period": null, "filters": {{}}, "format": "records", "measures": null, "start_period": null}}' AS query,
       min(period) AS period_start, max(period) AS period_end, CASE WHEN count(DISTINCT unit) = 1 THEN max(unit) END AS unit,
       CAST(least(count(*), 50) AS BIGINT) AS row_count, CAST(CASE WHEN count(*) > 50 THEN count(*) END AS BIGINT) AS truncated_at,
       '{{"basis":"Order book as recorded from 1995","break_date":"1998-01-01","break_reason":"Orders before this date were recorded on the earlier basis."}}' AS framework,
       FALSE AS stale, CAST(NULL AS VARCHAR) AS stale_reason, CAST(NULL AS VARCHAR) AS source_url, CAST(NULL AS VARCHAR) AS download_url,
       'Synthetic order book.' AS attribution
FROM ({ORDERS_OBS}) o
"""


# ---- matching and search between tables -----------------------------------------------

_URLS = "SELECT DISTINCT url AS r FROM pages WHERE url <> ''"
_WRITTEN = """
SELECT k, CASE k % 5 WHEN 0 THEN t WHEN 1 THEN before || after WHEN 2 THEN before || after || '/x'
  WHEN 3 THEN before || here || here || after ELSE before || 'zq' || after END AS l
FROM (SELECT k, t, substr(t, 1, pos - 1) AS before, substr(t, pos, 1) AS here, substr(t, pos + 1) AS after
      FROM (SELECT page_id AS k, url AS t, ((page_id * 7) % (length(url) - 2) + 2)::INT AS pos FROM pages WHERE length(url) > 3))
"""


def _grams(t: str) -> str:
    return f"list_distinct(list_transform(range(1, greatest(length({t}), 1) + 1), lambda i: substr(' ' || lower({t}) || ' ', i::INT, 3)))"


SQL["similar_names"] = f"""
WITH w AS ({_WRITTEN}),
a AS (SELECT l, {_grams('l')} AS x FROM (SELECT DISTINCT l FROM w WHERE l <> '')),
b AS (SELECT r, {_grams('r')} AS y FROM ({_URLS})),
s AS (SELECT l, r, len(list_intersect(x, y)) AS common, len(x) + len(y) AS n FROM a CROSS JOIN b),
j AS (SELECT l, r, common, common::DOUBLE / (n - common) AS jaccard FROM s),
best AS (SELECT * FROM j WHERE jaccard >= 0.7 QUALIFY row_number() OVER (PARTITION BY l ORDER BY jaccard DESC, levenshtein(lower(l), lower(r)), r) = 1)
SELECT w.k AS page_id, w.l AS written, best.r AS url, best.common::BIGINT AS common, best.jaccard FROM w JOIN best ON w.l = best.l
"""
SQL["close_names"] = f"""
WITH w AS ({_WRITTEN}), b AS ({_URLS}),
s AS (SELECT l, r, levenshtein(l, r) AS edits, 1 - levenshtein(l, r)::DOUBLE / greatest(length(l), length(r)) AS score FROM (SELECT DISTINCT l FROM w WHERE l <> '') CROSS JOIN b),
best AS (SELECT *, row_number() OVER (PARTITION BY l ORDER BY score DESC, r) AS rank FROM s WHERE score >= 0.85 QUALIFY rank <= 3)
SELECT w.k AS page_id, best.rank::BIGINT AS rank, best.r AS url, best.edits::BIGINT AS edits FROM w JOIN best ON w.l = best.l
"""


def _tokens(t: str) -> str:
    return f"list_distinct(regexp_extract_all(translate({t}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\p{{L}}\\p{{N}}]+'))"


SQL["search_texts"] = f"""
WITH p AS (SELECT DISTINCT doc_id, unnest({_tokens('text')}) AS token FROM documents),
w AS (SELECT token, floor(log2((SELECT count(DISTINCT doc_id) FROM documents) // count(*)))::BIGINT AS weight FROM p GROUP BY token),
q AS (SELECT DISTINCT item_id, unnest({_tokens('text')}) AS token FROM benchmark),
s AS (SELECT item_id, doc_id, sum(weight)::BIGINT AS score FROM q JOIN w USING (token) JOIN p USING (token) WHERE weight > 0 GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank, max(score) OVER (PARTITION BY item_id) AS best FROM s)
SELECT item_id, rank::BIGINT AS rank, doc_id, score, round(score * 100.0 / best, 1)::DOUBLE AS relevance FROM r WHERE rank <= 10
"""

SQL["many_sheets"] = """
SELECT 'CUSTOMER_SNAPSHOT' AS dataset_id, 'nation-' || c_nationkey AS source,
       strftime(last_day(make_date((2000 + c_nationkey // 12)::BIGINT, (c_nationkey % 12 + 1)::BIGINT, 1)), '%Y-%m-%d') AS period, 'account_balance' AS measure, c_acctbal AS value, 'USD' AS unit,
       c_custkey::VARCHAR AS id, c_mktsegment AS kind, c_name AS entity
FROM customer WHERE c_nationkey IS NOT NULL AND c_acctbal IS NOT NULL AND NOT isnan(c_acctbal)
UNION ALL
SELECT 'EVENTS', 'events-' || event_type, strftime(ts, '%Y-%m-%d'), 'value', value, 'points', event_id::VARCHAR, event_type, user_id::VARCHAR
FROM events WHERE event_type IS NOT NULL AND value IS NOT NULL AND NOT isnan(value)
"""

SQL["dimension_dictionary"] = """
SELECT 'returnflag' AS key, l_returnflag AS value, count(*) AS n FROM lineitem WHERE l_returnflag IS NOT NULL GROUP BY ALL
UNION ALL
SELECT 'linestatus', l_linestatus, count(*) FROM lineitem WHERE l_linestatus IS NOT NULL GROUP BY ALL
"""

SQL["filter_long_list"] = f"""
SELECT {LINE_COLS} FROM ({lineitem_obs(('quantity',), where="l_orderkey BETWEEN 0 AND 99999")}) x
"""
