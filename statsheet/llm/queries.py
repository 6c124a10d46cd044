"""The registered ``opN_*`` queries: each applies its operator, with production
parameters, to the whole of its table and derives the digest columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, langid, mixing, near_dedup, pivot_index, quality, suffix_dedup
from .common import read
from .packing import pack
from .records import read_records, write_records
from .runs import find_runs
from .sentence_pieces import encode_texts
from .url_filter import SOFT, SOFT_LIMIT, STRICT, Rule, judge_urls
from .warc import read_archives, write_archives

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}
SQL: dict[str, str] = {}


def vocabulary_path(name: str) -> str:
    """A public vocabulary file of this machine; every operator takes any path."""
    import public_tokenizers

    return public_tokenizers.path(name)


def register(fn: Query) -> Query:
    REGISTRY[fn.__name__] = fn
    return fn


# ---- language ID -----------------------------------------------------------------


@register
def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    profiles = langid.learn(docs.where(~held_out))
    return langid.predict(docs, profiles).select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "lang_pred", "score")


# ---- URL filter ----------------------------------------------------------------

URL_RULES = (
    Rule("org", "/", "allow"),
    Rule("example.org", "/es/", "block"),
    Rule("example.org", "/en/1", "block"),
    Rule("com", "/fr/", "allow"),
    Rule("com", "/de/", "block"),
)


@register
def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(read(spark, sf_dir, "pages"), URL_RULES)


def _hits(terms: tuple[str, ...]) -> str:
    found = " + ".join(f"regexp_matches(u, '(^|[^\\p{{L}}\\p{{N}}]){t}($|[^\\p{{L}}\\p{{N}}])')::INT" for t in terms)
    return f"({found})"


SQL["op2_url_filter"] = f"""
WITH p AS (
  SELECT page_id, coalesce(translate(url, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS u,
         CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r FROM pages),
q AS (
  SELECT page_id, u, regexp_extract(r, '^([^/?#]*)', 1) AS raw, regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path FROM p),
h AS (SELECT *, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host FROM q),
f AS (SELECT *, {_hits(STRICT)} AS strict_terms, {_hits(SOFT)} AS soft_terms,
  CASE WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/en/1') THEN 'example.org/en/1'
       WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/es/') THEN 'example.org/es/'
       WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/fr/') THEN 'com/fr/'
       WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/de/') THEN 'com/de/'
       WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/') THEN 'org/' END AS rule FROM h)
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ('example.org/en/1', 'example.org/es/', 'com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
       WHEN strict_terms > 0 OR soft_terms >= {SOFT_LIMIT} THEN 'block' ELSE 'allow' END AS verdict,
  strict_terms, soft_terms FROM f"""


# ---- token records, packing -------------------------------------------------------


@register
def op3_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = write_records(read(spark, sf_dir, "documents"), vocabulary_path("byte_bpe_50k.json"), end_id=2)
    return read_records(spark, manifest)


@register
def op4_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_texts(read(spark, sf_dir, "documents"), vocabulary_path("piece_bpe_32k.model"), with_ids=False)


@register
def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read(spark, sf_dir, "documents"), vocabulary_path("word_bpe_49k.json"), end_id=1)


# ---- exact search --------------------------------------------------------------------


@register
def op5_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivot_index.search(read(spark, sf_dir, "embeddings"), "vec_id % 100 = 0", k=10, scale=1024)


SQL["op5_exact_topk"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS q FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS query_id, b.vec_id, list_inner_product(a.q, b.q)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10"""


# ---- repeated passages ---------------------------------------------------------------


@register
def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.find_repeats(read(spark, sf_dir, "documents"), length=200).drop("spans")


# ---- near duplicates ---------------------------------------------------------------


@register
def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.link_documents(read(spark, sf_dir, "documents"), near_dedup.Rule(words=3, percent=85))


# ---- quality rules -----------------------------------------------------------------


@register
def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = quality.fit(docs, read(spark, sf_dir, "labels"))
    kept = ~F.col("base_failed") & (F.col("score") >= quality.THRESHOLD)
    return quality.judge(docs, model).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", kept.alias("kept"), "score")


# ---- WARC ------------------------------------------------------------------------


@register
def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = write_archives(read(spark, sf_dir, "pages"), least=0)
    return read_archives(spark, manifest).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


SQL["op7_warc"] = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
g AS (SELECT h, octet_length(encode(html)) AS n, max(page_id) AS last FROM p GROUP BY 1, 2)
SELECT page_id, n::BIGINT AS payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + (((('0x' || substr(h, (i // 4) * 5 + 1, 5))::BIGINT >> (15 - 5 * (i % 4))) & 31))::INT, 1)), '') AS payload_digest,
  CASE WHEN page_id < last THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id < last THEN last END AS refers_to
FROM (SELECT page_id, h, octet_length(encode(html)) AS n FROM p) JOIN g USING (h, n)"""


# ---- periodic runs ---------------------------------------------------------------------


def planted(docs: DataFrame) -> DataFrame:
    """doc_id, text: where crc32(doc_id) % 10 = 0, the words from a place on repeat their first p."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = F.regexp_extract_all("text", F.lit(mixing.WORDS), F.lit(0))
    listed = docs.select("doc_id", "text", F.when(h % 10 == 0, words).alias("words"), g.alias("g"))
    n, a, p, rest = (F.col(c).cast("int") for c in ("n", "a", "p", "rest"))
    rows = (
        listed.withColumn("n", F.size("words"))
        .withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
        .withColumn("rest", F.col("n") - F.col("a"))
        .withColumn("p", 1 + F.floor(F.col("rest") / (3 + F.col("g") % 8)))
    )
    unit = F.slice("words", a + 1, p)
    tail = F.slice(F.flatten(F.array_repeat(unit, F.ceil(rest / p).cast("int"))), F.lit(1), rest)
    text = F.array_join(F.concat(F.slice("words", F.lit(1), a), tail), " ")
    return rows.select("doc_id", F.when(n > 0, text).otherwise(F.col("text")).alias("text"))


@register
def op11_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_runs(planted(read(spark, sf_dir, "documents")), least=24, exponent=3)

    def ahead(x, y):  # the greater length / period, exactly; then the smaller start, then period
        more = y["length"] * x["period"] - x["length"] * y["period"]
        return F.coalesce(*(F.nullif(F.signum(d).cast("int"), F.lit(0)) for d in (more, x["start"] - y["start"], x["period"] - y["period"])), F.lit(0))

    best = F.get(F.array_sort("runs", ahead), F.lit(0))
    listed = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    with_best = found.select("*", best.alias("best"), F.size("runs").cast("bigint").alias("n_runs"))
    return with_best.select(
        "doc_id",
        "n_runs",
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.when(F.col("n_runs") > 0, F.concat(listed, F.lit("\n"))).otherwise("").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


# ---- mixing ------------------------------------------------------------------------------


@register
def op12_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = mixing.plan(read(spark, sf_dir, "documents"), most=3, seed=0)
    return mixing.taken_words(mix).select("doc_id", "size", "source_size", "target", "taken")


SQL["op12_mixing"] = """
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
         ('0x' || substr(md5('0:' || coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS draw FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, 3 * sum(size)::BIGINT AS cap,
        1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS w FROM d GROUP BY source),
r AS (SELECT *, row_number() OVER (ORDER BY cap / w, source NULLS LAST) AS k,
        (SELECT sum(source_size) FROM s)::BIGINT - coalesce(sum(cap) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS rem,
        sum(w) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::BIGINT AS weight FROM s),
l AS (SELECT rem, weight FROM r WHERE cap::HUGEINT * weight >= rem::HUGEINT * w ORDER BY k LIMIT 1),
t AS (SELECT source, source_size, least(l.rem::DOUBLE * w::DOUBLE / l.weight::DOUBLE, cap::DOUBLE) AS target FROM r CROSS JOIN l),
p AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target + 0.5)::BIGINT // source_size ELSE 0 END AS whole,
        CASE WHEN source_size > 0 THEN floor(target + 0.5)::BIGINT % source_size ELSE 0 END AS rest FROM t),
g AS (SELECT source, draw, sum(size)::BIGINT AS held FROM d GROUP BY source, draw),
c AS (SELECT source, draw, held, sum(held) OVER (PARTITION BY source ORDER BY draw)::BIGINT - held AS before FROM g)
SELECT d.doc_id, d.size, p.source_size, p.target,
  (p.whole * d.size + CASE WHEN c.before + c.held <= p.rest THEN d.size
     WHEN c.before < p.rest THEN (d.size::HUGEINT * (p.rest - c.before)) // c.held ELSE 0 END)::BIGINT AS taken
FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source JOIN c ON d.source IS NOT DISTINCT FROM c.source AND d.draw = c.draw"""


# ---- alignment -----------------------------------------------------------------------------


@register
def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = alignment.Tokenizers(spark, vocabulary_path("byte_bpe_50k.json"), vocabulary_path("piece_bpe_32k.model"))
    return alignment.compare(read(spark, sf_dir, "documents"), both)
