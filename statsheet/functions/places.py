"""State and territory normalisation.

Input may be a short code in any case, a full name, an ISO 3166-2 code
(``AU-NSW``), a nickname, or a four-digit postcode; the output is the long
name.  Anything unrecognised passes through unchanged.  The same lookup is
offered as driver dicts (for literal filter values) and as small lookup
DataFrames joined by broadcast (for whole columns): the tables are fixed and
tiny (8 states, 18 postcode bands), so their size bound is known.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Dimension keys whose values are places.
STATE_LIKE_DIMS = frozenset({"state_territory", "state", "region"})

# Code → long name of the eight states and territories.
STATES = {
    "NSW": "New South Wales",
    "VIC": "Victoria",
    "QLD": "Queensland",
    "SA": "South Australia",
    "WA": "Western Australia",
    "TAS": "Tasmania",
    "NT": "Northern Territory",
    "ACT": "Australian Capital Territory",
}
# Informal names.
NICKNAMES = {"TASSIE": "TAS", "VICTORIA": "VIC", "QUEENSLAND": "QLD"}
# Postcode bands (inclusive) → state code, as published by the
# national postal service.
POSTCODE_BANDS = (
    (200, 299, "ACT"),
    (800, 899, "NT"),
    (900, 999, "NT"),
    (1000, 2599, "NSW"),
    (2600, 2618, "ACT"),
    (2619, 2899, "NSW"),
    (2900, 2920, "ACT"),
    (2921, 2999, "NSW"),
    (3000, 3999, "VIC"),
    (4000, 4999, "QLD"),
    (5000, 5999, "SA"),
    (6000, 6797, "WA"),
    (6800, 6999, "WA"),
    (7000, 7999, "TAS"),
    (8000, 8999, "VIC"),
    (9000, 9999, "QLD"),
)


def _code_lookup() -> dict[str, str]:
    out: dict[str, str] = {}
    for code, name in STATES.items():
        out[code] = code
        out[f"AU-{code}"] = code
        out[name.upper()] = code
    out.update(NICKNAMES)
    return out


_CODES = _code_lookup()


def normalise_state(value: str | None) -> str | None:
    """Long state name for a code, name, ISO code or postcode; else None."""
    if value is None:
        return None
    s = value.strip()
    if not s:
        return None
    if s.isdigit():
        if len(s) != 4:
            return None
        n = int(s)
        for lo, hi, code in POSTCODE_BANDS:
            if lo <= n <= hi:
                return STATES[code]
        return None
    code = _CODES.get(" ".join(s.upper().split()))
    return STATES[code] if code else None


def state_name_table(spark: SparkSession) -> DataFrame:
    """(key, state) rows: every accepted spelling, upper-cased."""
    rows = [(k, STATES[c]) for k, c in sorted(_CODES.items())]
    return spark.createDataFrame(rows, "key string, state string")


def postcode_band_table(spark: SparkSession) -> DataFrame:
    rows = [(lo, hi, STATES[c]) for lo, hi, c in POSTCODE_BANDS]
    return spark.createDataFrame(rows, "lo int, hi int, state string")


def normalise_state_column(df: DataFrame, column: str, out: str = "state") -> DataFrame:
    """Add ``out``: the long state name for ``column``, or the input unchanged.

    Two broadcast lookups with fixed, tiny right sides: an equi-join on the
    upper-cased spelling and a range join on postcode bands.  The range join
    is an equi-join on the band's thousand block plus a between condition, so
    it stays a hash join (no nested loop) whatever the left side's size.
    """
    spark = df.sparkSession
    norm = F.upper(F.regexp_replace(F.regexp_replace(F.col(column), r"(?U)^\s+|\s+$", ""), r"(?U)\s+", " "))
    left = (
        df.withColumn("_st_key", norm)
        .withColumn("_st_pc", F.when(F.col("_st_key").rlike("^[0-9]{4}$"), F.col("_st_key").cast("int")))
        .withColumn("_st_blk", F.floor(F.col("_st_pc") / 100).cast("int"))
    )
    names = state_name_table(spark).withColumnRenamed("key", "_sn_key").withColumnRenamed("state", "_sn_state")
    # Explode each band into the 100-wide blocks it touches (at most 100 rows).
    bands = (
        postcode_band_table(spark)
        .withColumn("_pb_blk", F.explode(F.sequence(F.floor(F.col("lo") / 100).cast("int"), F.floor(F.col("hi") / 100).cast("int"))))
        .select(F.col("lo").alias("_pb_lo"), F.col("hi").alias("_pb_hi"), F.col("state").alias("_pb_state"), "_pb_blk")
    )
    joined = left.join(F.broadcast(names), F.col("_st_key") == F.col("_sn_key"), "left").join(
        F.broadcast(bands),
        (F.col("_st_blk") == F.col("_pb_blk")) & F.col("_st_pc").between(F.col("_pb_lo"), F.col("_pb_hi")),
        "left",
    )
    resolved: Column = F.coalesce(F.col("_sn_state"), F.col("_pb_state"), F.col(column))
    return joined.withColumn(out, resolved).drop("_st_key", "_st_pc", "_st_blk", "_sn_key", "_sn_state", "_pb_lo", "_pb_hi", "_pb_state", "_pb_blk")
