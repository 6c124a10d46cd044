"""Registered queries over the driver's tables.

Each function takes ``(spark, root)`` where ``root`` is a folder of Parquet
tables, builds its plan with the library, and returns the result DataFrame
with the same column names as the matching SQL in ``plans.oracle``.
Every query reads whole tables (or DataFrames Spark derives from them).
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pyspark.sql.types import DoubleType, StringType

from ..functions.coerce import clean_string, integral_check, to_double
from ..functions.links import (
    absolute_url,
    decoded_file_name,
    extract_hrefs,
    filename_date_score,
    host_allowed,
    normalize_dataset_id_col,
    prefer_database,
    redact_urls,
    url_host,
)
from ..functions.periods import expand_periods, header_period_col
from ..functions.places import normalise_state_column
from ..operators.dictionary import dictionary_of
from ..operators.links import best_links, candidate_links, extract_links, manifest_diff, resolve_tiers, seed_manifest
from ..operators.lookups import pair_bases, pair_entities, translate_column
from ..operators.matching import close_pairs, similar_pairs
from ..operators.observe import records
from ..operators.reshape import drop_blank_rows, melt_transposed, promote_header
from ..operators.retrieval import index_texts, search_texts
from ..operators.sheets import observations_of_sheets
from ..operators.summary import series_stats
from ..plans.api import get_data, latest, top_n
from ..sources.tables import read_table
from ..streaming.accumulate import latest_per_key
from ..spec import get_spec

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def register(name: str) -> Callable[[Query], Query]:
    def deco(fn: Query) -> Query:
        REGISTRY[name] = fn
        return fn

    return deco


# ---- observations and filters (R7, P8, F1..F5) ------------------------------


@register("observations_wide")
def observations_wide(spark: SparkSession, root: str) -> DataFrame:
    return get_data(spark, "LINEITEM", root=root).records


@register("filter_eq")
def filter_eq(spark: SparkSession, root: str) -> DataFrame:
    return get_data(spark, "ORDERS", {"status": "filled"}, root=root).records


@register("filter_in")
def filter_in(spark: SparkSession, root: str) -> DataFrame:
    return get_data(spark, "ORDERS", {"status": ["F", "open"]}, root=root).records


@register("filter_and")
def filter_and(spark: SparkSession, root: str) -> DataFrame:
    return get_data(spark, "ORDERS", {"status": "filled", "priority": "urgent"}, root=root).records


@register("filter_wildcard")
def filter_wildcard(spark: SparkSession, root: str) -> DataFrame:
    return get_data(spark, "ORDERS", {"priority": "*urg"}, root=root).records


@register("filter_id")
def filter_id(spark: SparkSession, root: str) -> DataFrame:
    return get_data(spark, "LINEITEM", {"linenumber": ["1", "3"], "returnflag": "returned"}, "quantity", root=root).records


# ---- period ranges (F7, C1) ------------------------------------------------


@register("period_year")
def period_year(spark: SparkSession, root: str) -> DataFrame:
    return get_data(spark, "ORDERS", start_period="1996", end_period="1996", root=root).records


@register("period_quarter")
def period_quarter(spark: SparkSession, root: str) -> DataFrame:
    return get_data(spark, "ORDERS", start_period="1996-Q2", end_period="1996-q2", root=root).records


@register("period_month_end")
def period_month_end(spark: SparkSession, root: str) -> DataFrame:
    return get_data(spark, "ORDERS", start_period="1996-02", end_period="1996-02", root=root).records


@register("period_open_ended")
def period_open_ended(spark: SparkSession, root: str) -> DataFrame:
    return get_data(spark, "LINEITEM", measures=["discount", "tax"], start_period="2001-06", root=root).records


@register("expand_period_table")
def expand_period_table(spark: SparkSession, root: str) -> DataFrame:
    o = read_table(spark, root, "orders").select("o_orderkey", "o_orderdate", "o_orderpriority")
    d = F.col("o_orderdate")
    forms = o.select(
        F.col("o_orderkey").alias("orderkey"),
        F.date_format(d, "yyyy").alias("as_year"),
        F.date_format(d, "yyyy-MM").alias("as_month"),
        F.concat(F.date_format(d, "yyyy"), F.lit("-Q"), F.quarter(d).cast("string")).alias("as_quarter"),
        F.concat(F.lit(" "), F.date_format(d, "yyyy-MM-dd"), F.lit(" ")).alias("as_date"),
        F.col("o_orderpriority").alias("as_text"),
    )
    cols = ["as_year", "as_month", "as_quarter", "as_date", "as_text"]
    return expand_periods(forms, cols).drop(*cols)


# ---- ranking, latest, limits (L1..L6, A4..A7) -----------------------------------


@register("top_n")
def top_n_q(spark: SparkSession, root: str) -> DataFrame:
    return top_n(spark, "ORDERS", "total_price", 10, root=root).records


@register("bottom_n")
def bottom_n_q(spark: SparkSession, root: str) -> DataFrame:
    return top_n(spark, "ORDERS", "total_price", 10, direction="asc", root=root).records


@register("top_n_all")
def top_n_all(spark: SparkSession, root: str) -> DataFrame:
    return top_n(spark, "LINEITEM", "extended_price", 25, root=root).records


@register("top_n_lines")
def top_n_lines(spark: SparkSession, root: str) -> DataFrame:
    return top_n(spark, "LINEITEM", "quantity", 25, root=root).records


@register("latest_multi")
def latest_multi(spark: SparkSession, root: str) -> DataFrame:
    return latest(spark, "LINEITEM", root=root).records


@register("latest_single")
def latest_single(spark: SparkSession, root: str) -> DataFrame:
    return latest(spark, "ORDERS", root=root).records


@register("latest_long")
def latest_long(spark: SparkSession, root: str) -> DataFrame:
    return latest(spark, "EVENTS", root=root, limit=None).records


@register("latest_n_periods")
def latest_n_periods(spark: SparkSession, root: str) -> DataFrame:
    return latest(spark, "ORDERS", root=root, last_n=3, limit=None).records


@register("latest_tail_n")
def latest_tail_n(spark: SparkSession, root: str) -> DataFrame:
    return latest(spark, "LINEITEM", root=root, last_n=5, mode="tail", limit=None).records


@register("limit_truncated")
def limit_truncated(spark: SparkSession, root: str) -> DataFrame:
    return get_data(spark, "LINEITEM", root=root, limit=50).records


@register("summary_row")
def summary_row_q(spark: SparkSession, root: str) -> DataFrame:
    res = get_data(spark, "LINEITEM", root=root, limit=50)
    return res.summary.select("dataset_id", "row_count", "truncated_at", "unit", "period_start", "period_end")


@register("summary_unit")
def summary_unit(spark: SparkSession, root: str) -> DataFrame:
    res = get_data(spark, "ORDERS", root=root, limit=50)
    return res.summary.select("dataset_id", "row_count", "truncated_at", "unit", "period_start", "period_end")


@register("series")
def series_q(spark: SparkSession, root: str) -> DataFrame:
    res = get_data(spark, "LINEITEM", root=root, fmt="series")
    return series_stats(res.observations, res.spec)


@register("default_sort_limit")
def default_sort_limit(spark: SparkSession, root: str) -> DataFrame:
    return get_data(spark, "CUSTOMER", root=root, limit=50).records


# ---- reshape (R1..R6, S2..S5, P3..P7) -----------------------------------------


def orders_month_pivot(spark: SparkSession, root: str) -> DataFrame:
    """A transposed sheet derived from orders: priority × ``Mon YYYY`` columns
    holding the largest order total, plus a non-period ``Notes`` column.
    The month list comes from the data (pivot's own bounded distinct job)."""
    o = read_table(spark, root, "orders").withColumn("_month", F.date_format("o_orderdate", "MMM yyyy"))
    wide = o.groupBy(F.col("o_orderpriority").alias("Priority")).pivot("_month").agg(F.max("o_totalprice"))
    return wide.withColumn("Notes", F.lit("largest order total in the month"))


@register("melt_transposed")
def melt_transposed_q(spark: SparkSession, root: str) -> DataFrame:
    melted = melt_transposed(orders_month_pivot(spark, root), "priority")
    return melted.select("priority", F.col("period").cast("string").alias("period"), "value")


@register("transposed_latest")
def transposed_latest(spark: SparkSession, root: str) -> DataFrame:
    src = orders_month_pivot(spark, root).withColumnRenamed("Priority", "priority")
    return latest(spark, "ORDERS_MONTHLY", source=src, limit=None).records


@register("snapshot_header")
def snapshot_header_q(spark: SparkSession, root: str) -> DataFrame:
    c = read_table(spark, root, "customer")
    sheet = c.select(
        F.col("c_name").alias("Aug 2001"),
        F.col("c_mktsegment").alias("Segment"),
        F.col("c_custkey").alias("Customer key"),
        F.col("c_acctbal").alias("Account balance"),
    )
    return get_data(spark, "CUSTOMER_SNAPSHOT", source=sheet).records


@register("drop_blank")
def drop_blank_q(spark: SparkSession, root: str) -> DataFrame:
    o = read_table(spark, root, "orders").select(
        F.col("o_orderkey").alias("orderkey"),
        F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("A"),
        F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("B"),
        F.col("o_totalprice").alias("C"),
    )
    return drop_blank_rows(o, ["A", "B", "not_a_column"])


def customer_grid(spark: SparkSession, root: str) -> DataFrame:
    """A raw sheet grid derived from the customer table: a title row, a unit
    row, a header with a line break, a blank, a double space and a repeated
    name, a blank row, a footnote, then one row per customer."""
    head = spark.createDataFrame(
        [
            (1, ["Customer register", None, None, None, None]),
            (2, [None, None, "USD", None, None]),
            (3, ["Customer\nname", "", "Customer  key", "Segment", "Segment"]),
            (4, [None, None, None, None, None]),
            (5, ["Source: synthetic register", None, None, None, None]),
        ],
        "row_idx long, cells array<string>",
    )
    c = read_table(spark, root, "customer")
    body = c.select(
        (F.col("c_custkey") + 10).alias("row_idx"),
        F.array(
            F.col("c_name"),
            F.col("c_nationkey").cast("string"),
            F.col("c_custkey").cast("string"),
            F.col("c_mktsegment"),
            F.lower("c_mktsegment"),
        ).alias("cells"),
    )
    return head.unionByName(body)


@register("header_promotion")
def header_promotion_q(spark: SparkSession, root: str) -> DataFrame:
    return promote_header(customer_grid(spark, root), header_row=3)


@register("coerce_types")
def coerce_types_q(spark: SparkSession, root: str) -> DataFrame:
    c = read_table(spark, root, "customer")
    key = F.col("c_custkey").cast("string")
    raw = c.select(
        F.col("c_custkey").alias("custkey"),
        key.alias("r_plain"),
        F.concat(F.lit(" "), key, F.lit(" ")).alias("r_padded"),
        F.concat(F.col("c_nationkey").cast("string"), F.lit("e3")).alias("r_exp"),
        F.concat(key, F.lit("d")).alias("r_suffix"),
        F.concat(key, F.lit(",000")).alias("r_comma"),
        F.concat(F.lit(" "), key).alias("r_nbsp"),
        F.col("c_mktsegment").alias("r_text"),
        F.col("c_acctbal").cast("string").alias("r_frac"),
        F.col("c_custkey").cast("double").alias("r_id"),
    )
    integral = raw.agg(integral_check("r_id").alias("ok")).first()["ok"]
    return raw.select(
        "custkey",
        *[to_double(F.col(f"r_{n}")).alias(f"value_{n}") for n in ("plain", "padded", "exp", "suffix", "comma", "nbsp", "text", "frac")],
        clean_string(F.col("r_id"), DoubleType(), integral).alias("id_text"),
        clean_string(F.col("r_padded"), StringType()).alias("text_clean"),
    )


# ---- links (C3..C9, L9, J2..J4) -----------------------------------------------

# Fixed values of the link checks: a host allow-list and a redacted host.
ALLOWED_HOSTS = ["blog.tionsh.example.net", "thther.example.org", "www.ththhe.example.com"]
REDACT_HOST_PATTERN = r"example\.org"


def page_links(spark: SparkSession, root: str) -> DataFrame:
    return extract_links(read_table(spark, root, "pages"), extension=None)


def page_rules(spark: SparkSession, root: str) -> DataFrame:
    """One link rule per landing page (derived from the pages table)."""
    p = read_table(spark, root, "pages")
    return p.select(
        F.concat(F.lit("DS_"), F.col("page_id").cast("string")).alias("dataset_id"),
        F.col("url").alias("landing_url"),
        F.lit("^[a-m]").alias("include"),
        F.array(F.lit(r"^(the|and|der|die)\W*$")).alias("excludes"),
        F.lit(True).alias("prefer_database"),
    )


def page_best_links(spark: SparkSession, root: str) -> DataFrame:
    return best_links(candidate_links(page_links(spark, root), page_rules(spark, root)))


def page_seed(spark: SparkSession, root: str) -> DataFrame:
    """Seed entries derived from the pages: the page URL when it carries a
    fragment, else the first link as written (often relative, so J3 drops it)."""
    p = read_table(spark, root, "pages")
    value = F.when(F.col("url").contains("#"), F.col("url")).otherwise(F.get(extract_hrefs(F.col("html"), None), 0))
    return seed_manifest(p.select(F.concat(F.lit("DS_"), F.col("page_id").cast("string")).alias("dataset_id"), value.alias("url")))


def page_datasets(spark: SparkSession, root: str) -> DataFrame:
    p = read_table(spark, root, "pages")
    did = F.concat(F.lit("DS_"), F.col("page_id").cast("string"))
    return p.select(did.alias("dataset_id"), F.concat(F.lit("https://files.example.com/"), did, F.lit(".xlsx")).alias("default_url"))


@register("extract_links")
def extract_links_q(spark: SparkSession, root: str) -> DataFrame:
    return page_links(spark, root).select("page_id", F.col("pos").cast("long").alias("pos"), "href", "link_url", "file_name")


@register("resolve_urls")
def resolve_urls_q(spark: SparkSession, root: str) -> DataFrame:
    """C5 on hrefs with dot segments, queries, fragments and percent codes."""
    n = F.col("page_id").cast("string")
    base = F.concat(F.lit("https://h"), n, F.lit(".example.org/a/b"), n, F.lit("/c.html?x=1#f"))
    hrefs = {
        "up": F.concat(F.lit("../up"), n), "here": F.concat(F.lit("./here"), n), "top": F.concat(F.lit("../../../top"), n),
        "mixed": F.concat(F.lit("x/./y/../z%20"), n, F.lit(".xlsx?u=/../v")), "query": F.concat(F.lit("?q="), n),
        "mark": F.concat(F.lit("#m"), n), "rooted": F.concat(F.lit("/r/../s"), n), "folder": F.lit(".."),
    }
    urls = read_table(spark, root, "pages").select("page_id", *[absolute_url(base, h).alias(k) for k, h in hrefs.items()])
    return urls.withColumn("file_name", decoded_file_name("mixed"))


@register("best_dated_link")
def best_dated_link_q(spark: SparkSession, root: str) -> DataFrame:
    """C3, C7, L9 on file names that carry dates and, for urgent orders, "database"."""
    o = read_table(spark, root, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    d = F.col("o_orderdate")
    named = F.concat(F.lit("Report "), F.date_format(d, "MMMM yyyy"), F.lit(".xlsx"))
    coded = F.concat(F.lit("data_"), F.date_format(d, "yyyy-MM"), F.lit(" DataBase.xlsx"))
    name = F.when(F.col("o_orderpriority") == "1-URGENT", coded).otherwise(named)
    links = o.select(
        F.concat(F.lit("DS_"), (F.col("o_custkey") % 97).cast("string")).alias("dataset_id"),
        F.col("o_orderkey").alias("pos"),
        name.alias("file_name"),
        (filename_date_score(name) + prefer_database(name, F.col("o_custkey") % 2 == 0)).cast("long").alias("score"),
    )
    return best_links(links).select("dataset_id", "pos", "file_name", "score")


@register("filename_score")
def filename_score_q(spark: SparkSession, root: str) -> DataFrame:
    o = read_table(spark, root, "orders").select("o_orderkey", "o_orderdate", "o_orderpriority")
    d = F.col("o_orderdate")
    names = {
        "s_month_name": F.concat(F.lit("report-"), F.date_format(d, "MMMM-yyyy"), F.lit(".xlsx")),
        "s_numeric": F.concat(F.lit("data_"), F.date_format(d, "yyyy_MM"), F.lit(".xlsx")),
        "s_year": F.concat(F.lit("Stats "), F.date_format(d, "yyyy"), F.lit(" final.xlsx")),
        "s_none": F.concat(F.col("o_orderpriority"), F.lit(".xlsx")),
        "s_mixed": F.concat(F.lit("Sept-"), F.date_format(d, "yyyy"), F.lit("-and-"), F.date_format(d, "yyyy-MM"), F.lit(".xlsx")),
        "s_path": F.concat(F.lit("/files/"), F.date_format(d, "yyyy-MM"), F.lit("/file.xlsx")),
    }
    return o.select(F.col("o_orderkey").alias("orderkey"), *[filename_date_score(e).cast("long").alias(k) for k, e in names.items()])


@register("best_link")
def best_link_q(spark: SparkSession, root: str) -> DataFrame:
    return page_best_links(spark, root).select("dataset_id", "link_url", "file_name", "score", F.col("pos").cast("long").alias("pos"))


@register("resolve_tiers")
def resolve_tiers_q(spark: SparkSession, root: str) -> DataFrame:
    out = resolve_tiers(page_datasets(spark, root), page_best_links(spark, root), page_seed(spark, root))
    return out.select("dataset_id", "default_url", "url", "tier", "stale")


@register("manifest_diff")
def manifest_diff_q(spark: SparkSession, root: str) -> DataFrame:
    resolved = resolve_tiers(page_datasets(spark, root), page_best_links(spark, root), page_seed(spark, root))
    return manifest_diff(page_seed(spark, root), resolved)


@register("host_filter")
def host_filter_q(spark: SparkSession, root: str) -> DataFrame:
    """C9 on each page's URL and on forms of it with user info, a port, spaces, bars and upper case."""
    p = read_table(spark, root, "pages")
    rest = F.substring_index("url", "://", -1)
    forms = {
        "spaced": F.concat("url", F.lit("/annual report|final 2.xlsx")),
        "user": F.concat(F.lit("HTTPS://me:p@ss@"), rest),
        "port": F.concat(F.lit("http://"), F.upper(F.regexp_extract(rest, "^[^/?#]*", 0)), F.lit(":8080?q=a b#/x")),
        "bare": F.concat(F.lit("//"), rest),
        "path": F.concat(F.lit("/files//"), rest),
    }
    each = p.select("page_id", "url", *(c.alias(k) for k, c in forms.items()))
    return each.select("page_id", url_host("url").alias("host"), host_allowed("url", ALLOWED_HOSTS).alias("allowed"),
                       *[e for k in forms for e in (url_host(k).alias(f"{k}_host"), host_allowed(k, ALLOWED_HOSTS).alias(f"{k}_allowed"))])


@register("transposed_range")
def transposed_range_q(spark: SparkSession, root: str) -> DataFrame:
    """F7 on a transposed sheet: a range inside its headers, and two that meet none of them."""
    src = orders_month_pivot(spark, root).withColumnRenamed("Priority", "priority")
    parts = [("1996-Q2", "1996-09"), ("1890", "1899"), ("2090", None)]
    found = [get_data(spark, "ORDERS_MONTHLY", start_period=a, end_period=b, source=src).records.withColumn("asked", F.lit(a)) for a, b in parts]
    return found[0].unionByName(found[1]).unionByName(found[2])


@register("redact_urls")
def redact_urls_q(spark: SparkSession, root: str) -> DataFrame:
    p = read_table(spark, root, "pages")
    n = F.col("page_id").cast("string")
    made = F.concat(
        F.lit("see https://x.example.org.mirror.net/secret/"), n, F.lit(" or http://me:pw@EXAMPLE.org/"), n,
        F.lit(", http://o.net/?to=example.org&k="), n, F.lit(" but not example.org nor http://o.net/"), n,
    )
    return p.select(
        "page_id",
        redact_urls(F.col("url"), REDACT_HOST_PATTERN).alias("url"),
        redact_urls(F.col("html"), REDACT_HOST_PATTERN).alias("html"),
        redact_urls(made, REDACT_HOST_PATTERN).alias("made"),
    )


# ---- lookups, pairings, places (J1, J5, J6, F5, F6) --------------------------------


@register("alias_join")
def alias_join_q(spark: SparkSession, root: str) -> DataFrame:
    c = read_table(spark, root, "customer")
    raw = F.when(F.col("c_nationkey") < 10, F.lower("c_mktsegment")).otherwise(F.col("c_mktsegment"))
    src = c.select(F.col("c_custkey").alias("custkey"), raw.alias("segment_raw"))
    return translate_column(src, get_spec("CUSTOMER"), "segment", "segment_raw", "segment")


@register("entity_join")
def entity_join_q(spark: SparkSession, root: str) -> DataFrame:
    o = read_table(spark, root, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    c = read_table(spark, root, "customer").select("c_custkey", "c_name", "c_mktsegment")
    j = pair_entities(o, c, "o_custkey", "c_custkey")
    return j.select(
        F.col("o_orderkey").alias("orderkey"), F.col("c_name").alias("customer"), F.col("c_mktsegment").alias("segment"),
        F.col("o_totalprice").alias("total_price"),
    )


@register("basis_union")
def basis_union_q(spark: SparkSession, root: str) -> DataFrame:
    spec = get_spec("ORDERS")
    brk = spec.framework.break_date
    before = (_dt.date.fromisoformat(brk) - _dt.timedelta(days=1)).isoformat()
    current = get_data(spark, "ORDERS", start_period=brk, root=root).records
    historical = get_data(spark, "ORDERS", end_period=before, root=root).records
    return pair_bases(current, historical, "current", "historical")


# Place spellings used to derive the state-lookup input.
PLACE_SPELLINGS = [
    "NSW", "vic", "Queensland", "AU-WA", "Tassie", "act", "nt", "South Australia",
    "Total Australia", "au-qld", " Victoria ", "TAS", "Northern  Territory",
]


@register("state_lookup")
def state_lookup_q(spark: SparkSession, root: str) -> DataFrame:
    c = read_table(spark, root, "customer")
    place = F.element_at(F.array(*[F.lit(s) for s in PLACE_SPELLINGS]), (F.col("c_nationkey") % len(PLACE_SPELLINGS)) + 1)
    postcode = F.lpad(((F.col("c_custkey") * 7) % 10000).cast("string"), 4, "0")
    src = c.select(F.col("c_custkey").alias("custkey"), place.alias("place"), postcode.alias("postcode"))
    out = normalise_state_column(src, "place", "place_state")
    return normalise_state_column(out, "postcode", "postcode_state")


# ---- accumulation (G1), batch form ---------------------------------------------------


@register("accumulate_latest")
def accumulate_latest_q(spark: SparkSession, root: str) -> DataFrame:
    """Newest event per (user, day): the upsert rule of snapshot history."""
    e = read_table(spark, root, "events").withColumn("day", F.date_format("ts", "yyyy-MM-dd"))
    out = latest_per_key(e, ["user_id", "day"], ["ts", "event_id"])
    return out.select("user_id", "day", "event_id", "event_type", "value")


# ---- column forms of header periods and dataset ids (C2, C10) ---------------------


@register("header_period_table")
def header_period_table_q(spark: SparkSession, root: str) -> DataFrame:
    o = read_table(spark, root, "orders").select("o_orderkey", "o_orderdate")
    d = F.col("o_orderdate")
    src = o.select(
        F.col("o_orderkey").alias("orderkey"),
        F.date_format(d, "MMM yyyy").alias("h_month"),
        F.lower(F.date_format(d, "MMM yyyy")).alias("h_lower"),
        F.date_format(d, "yyyy-MM-dd HH:mm:ss").alias("h_iso"),
        F.concat(F.lit("Q"), F.quarter(d).cast("string"), F.lit(" "), F.date_format(d, "yyyy")).alias("h_other"),
    )
    return src.select("orderkey", *[header_period_col(c).alias(f"{c}_period") for c in ("h_month", "h_lower", "h_iso", "h_other")])


@register("dataset_id_canonical")
def dataset_id_canonical_q(spark: SparkSession, root: str) -> DataFrame:
    p = read_table(spark, root, "part")
    raw = F.concat(F.lit(" "), F.regexp_replace(F.col("p_name"), " ", "_"), F.lit(" "))
    return p.select(F.col("p_partkey").alias("partkey"), raw.alias("raw"), normalize_dataset_id_col(raw).alias("dataset_id"),
                    normalize_dataset_id_col(F.col("p_brand")).alias("brand_id"))


@register("latest_default_sort")
def latest_default_sort_q(spark: SparkSession, root: str) -> DataFrame:
    """No period and a default sort: the tail is the last row in sorted order."""
    return latest(spark, "CUSTOMER", root=root).records


# ---- API surfaces: measures by source name, JSON filters, ranked wildcard -----------


@register("series_nested")
def series_nested_q(spark: SparkSession, root: str) -> DataFrame:
    """K2 nested: each measure's length, chunks, ends and dimensions, from chunks of 1,000."""
    chunks = get_data(spark, "LINEITEM", root=root).chunked_series(rows=1000)
    first, last = F.col("observations")[0], F.element_at("observations", -1)
    # Only the ends of a chunk go on, so no sort or exchange holds its observations.
    ends = chunks.select("measure", "unit", "chunk", F.size("observations").alias("n"), first.alias("first"), last.alias("last"))
    return ends.groupBy("measure").agg(
        F.max("unit").alias("unit"), F.sum(F.col("n").cast("long")).alias("n_obs"), (F.max("n") <= 1000).alias("bounded"),
        ((F.count(F.lit(1)) == F.max("chunk") + 1) & (F.count_distinct("chunk") == F.count(F.lit(1)))).alias("numbered"),
        F.min_by("first.period", "chunk").alias("first_period"), F.min_by("first.value", "chunk").alias("first_value"),
        F.max_by("last.period", "chunk").alias("last_period"), F.max_by("last.value", "chunk").alias("last_value"),
        F.max_by(F.col("last.dimensions")["orderkey"], "chunk").alias("last_orderkey"),
    )


@register("summary_full")
def summary_full_q(spark: SparkSession, root: str) -> DataFrame:
    """K4 with every column but the time stamp; the query text and framework as JSON."""
    s = get_data(spark, "ORDERS", root=root, limit=50).summary
    return s.withColumn("framework", F.to_json("framework")).drop("retrieved_at")


@register("csv_output")
def csv_output_q(spark: SparkSession, root: str) -> DataFrame:
    """K3 through the format argument: one line for every observation."""
    return get_data(spark, "ORDERS", root=root, fmt="csv").output()


@register("measures_by_source")
def measures_by_source_q(spark: SparkSession, root: str) -> DataFrame:
    """A source column name and a key, duplicates dropped."""
    return get_data(spark, "LINEITEM", None, ["l_tax", "quantity", "tax"], root=root).records


@register("filters_json")
def filters_json_q(spark: SparkSession, root: str) -> DataFrame:
    """filters as JSON text (a list and a contains-match)."""
    return get_data(spark, "ORDERS", '{"status": ["O", "pending"], "priority": "~LOW"}', root=root).records


@register("bottom_n_wildcard")
def bottom_n_wildcard_q(spark: SparkSession, root: str) -> DataFrame:
    return top_n(spark, "ORDERS", "o_totalprice", 15, {"priority": "*high"}, direction="asc", root=root).records


# ---- matching and search between tables (T1..T6, L8) -----------------------------------


def misspelt_urls(spark: SparkSession, root: str) -> DataFrame:
    """Every page's URL with planted errors, by the page's number: a character left
    out, one left out and a part added, one doubled, two put in, or (every fifth) none."""
    p = read_table(spark, root, "pages").where("length(url) > 3")
    t, k = F.col("url"), F.col("page_id")
    at = (F.pmod(k * 7, F.length(t) - 2) + 2).cast("int")
    before, here, after = F.substring(t, F.lit(1), at - 1), F.substring(t, at, F.lit(1)), F.substring(t, at + 1, F.length(t))
    cut = F.concat(before, after)
    wrong = F.when(k % 5 == 0, t).when(k % 5 == 1, cut).when(k % 5 == 2, F.concat(cut, F.lit("/x"))).when(k % 5 == 3, F.concat(before, here, here, after)).otherwise(F.concat(before, F.lit("zq"), after))
    return p.select("page_id", wrong.alias("written"))


@register("similar_names")
def similar_names_q(spark: SparkSession, root: str) -> DataFrame:
    """T4, T5: the URL most like each misspelt one (Jaccard of 3-grams of 0.7 or more)."""
    found = similar_pairs(misspelt_urls(spark, root), read_table(spark, root, "pages"), "page_id", "written", "url", least=0.7)
    return found.select(F.col("key").alias("page_id"), F.col("left_text").alias("written"), F.col("right_text").alias("url"), F.col("common").cast("long").alias("common"), "jaccard")


@register("close_names")
def close_names_q(spark: SparkSession, root: str) -> DataFrame:
    """The three URLs closest to each misspelt one, by edits."""
    found = close_pairs(misspelt_urls(spark, root), read_table(spark, root, "pages"), "page_id", "written", "url", least=0.85)
    return found.select(F.col("key").alias("page_id"), F.col("rank").cast("long").alias("rank"), F.col("right_text").alias("url"), F.col("edits").cast("long").alias("edits"))


@register("search_texts")
def search_texts_q(spark: SparkSession, root: str) -> DataFrame:
    """T1..T3, L8: the ten documents that each benchmark item names best."""
    index = index_texts(read_table(spark, root, "documents"), "doc_id", "text")
    found = search_texts(read_table(spark, root, "benchmark"), index, "item_id", "text")
    return found.select(F.col("query_id").alias("item_id"), F.col("rank").cast("long").alias("rank"), F.col("id").alias("doc_id"), "score", "relevance")


# ---- many sheets in one plan (S2, S5, S11, R1, R4) ---------------------------------------


def snapshot_grid(spark: SparkSession, root: str) -> DataFrame:
    """Raw grids of one workbook for each nation (a snapshot of its customers, whose
    header is a month, with its columns in one of two orders) and one for each
    event type (a wide sheet under two title rows)."""
    c = read_table(spark, root, "customer").where("c_nationkey is not null")
    month = F.date_format(F.expr("make_date(2000 + c_nationkey div 12, c_nationkey % 12 + 1, 1)"), "MMM yyyy")
    source = F.concat(F.lit("nation-"), F.col("c_nationkey").cast("string"))
    even, turned = F.col("c_nationkey") % 2 == 0, F.array("c_name", F.col("c_acctbal").cast("string"), "c_mktsegment", F.col("c_custkey").cast("string"))
    straight = F.array("c_name", "c_mktsegment", F.col("c_custkey").cast("string"), F.col("c_acctbal").cast("string"))
    body = c.select(source.alias("source"), F.lit("Data").alias("sheet"), (F.col("c_custkey") + 2).alias("row_idx"), F.when(even, straight).otherwise(turned).alias("cells"))
    heads = c.select("c_nationkey", source.alias("source"), month.alias("month")).distinct()
    names = F.when(even, F.array("month", F.lit("Segment"), F.lit("Customer\nkey"), F.lit("Account  balance"))).otherwise(F.array("month", F.lit("Account balance"), F.lit(" Segment"), F.lit("Customer key")))
    e = read_table(spark, root, "events").where("event_type is not null")
    kind = F.concat(F.lit("events-"), F.col("event_type"))
    rows = e.select(kind.alias("source"), F.lit("Log").alias("sheet"), (F.col("event_id") + 4).alias("row_idx"), F.array("event_type", F.date_format("ts", "yyyy-MM-dd"), F.col("user_id").cast("string"), F.col("value").cast("string"), F.col("event_id").cast("string")).alias("cells"))
    titles = e.select(kind.alias("source")).distinct().select("source", F.lit("Log").alias("sheet"), F.posexplode(F.array(F.array(F.lit("Events")), F.array(F.lit(None).cast("string")), F.array(*map(F.lit, ("event_type", "ts", "user_id", "value", "event_id"))))).alias("row_idx", "cells"))
    return body.unionByName(heads.select("source", F.lit("Data").alias("sheet"), F.lit(1).cast("long").alias("row_idx"), names.alias("cells"))).unionByName(rows).unionByName(titles.withColumn("row_idx", F.col("row_idx").cast("long") + 1))


@register("many_sheets")
def many_sheets_q(spark: SparkSession, root: str) -> DataFrame:
    """Every nation's snapshot and every event sheet read by one plan, each period from where its layout has it."""
    grid = snapshot_grid(spark, root)
    of = F.when(F.col("sheet") == "Data", F.struct(F.lit("CUSTOMER_SNAPSHOT").alias("d"), F.lit(1).alias("h"))).otherwise(F.struct(F.lit("EVENTS").alias("d"), F.lit(3).alias("h")))
    layout = grid.select("source", "sheet").distinct().select(of["d"].alias("dataset_id"), "source", "sheet", of["h"].alias("header_row"), F.lit(None).cast("int").alias("data_start_row"))
    found = observations_of_sheets(grid, layout, [get_spec("CUSTOMER_SNAPSHOT"), get_spec("EVENTS")])
    d = F.col("dimensions")
    return found.select("dataset_id", "source", "period", "measure", "value", "unit", F.coalesce(d["custkey"], d["event_id"]).alias("id"), F.coalesce(d["segment"], d["data_item"]).alias("kind"), F.coalesce(d["institution"], d["user"]).alias("entity"))


@register("dimension_dictionary")
def dimension_dictionary_q(spark: SparkSession, root: str) -> DataFrame:
    """The values of every dimension of the line items, with their rows."""
    spec = get_spec("LINEITEM")
    return dictionary_of(read_table(spark, root, "lineitem"), spec)


@register("filter_long_list")
def filter_long_list_q(spark: SparkSession, root: str) -> DataFrame:
    """a list of 100,000 values on an id of the line items."""
    return get_data(spark, "LINEITEM", {"orderkey": [str(i) for i in range(100_000)]}, "quantity", root=root).records
