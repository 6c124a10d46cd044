"""Link, file-name and identifier functions (C3..C11), Column forms.

All of these are built-in expressions (regex extraction, higher-order array
functions, URL parsing), so they run inside whole-stage codegen over tables
of pages or links of any size.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from .periods import strip_col

# Month names and abbreviations → month number, as recognised
# in published file names.
MONTH_NUMBERS = {
    "january": 1, "jan": 1,
    "february": 2, "feb": 2,
    "march": 3, "mar": 3,
    "april": 4, "apr": 4,
    "may": 5,
    "june": 6, "jun": 6,
    "july": 7, "jul": 7,
    "august": 8, "aug": 8,
    "september": 9, "sep": 9, "sept": 9,
    "october": 10, "oct": 10,
    "november": 11, "nov": 11,
    "december": 12, "dec": 12,
}
# File-name date patterns.  A month name (not preceded by a
# letter), anything but letters lazily, a four-digit year not followed by a
# digit; and a numeric year-month token.
MONTH_NAME_PATTERN = (
    r"(?i)(?:^|[^A-Za-z])(january|february|march|april|may|june|july|august|september|"
    r"october|november|december|jan|feb|mar|apr|may|jun|jul|aug|sep|sept|oct|nov|dec)"
    r"[^A-Za-z]*?(\d{4})(?:[^0-9]|$)"
)
YEAR_MONTH_PATTERN = r"(\d{4})[-_/](\d{1,2})"
BARE_YEAR_PATTERN = r"\b(\d{4})\b"
# Bonus that makes a "database" file win over any dated alternative.
DATABASE_BONUS = 1_000_000
# Canonical dataset ids.
DATASET_ID_PATTERN = r"[A-Z][A-Z0-9_]*"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def href_pattern(extension: str = "xlsx") -> str:
    """``href="…​.ext"`` or single-quoted, any case (C4)."""
    return r"(?i)href=[\"']([^\"']+\." + re.escape(extension) + r")[\"']"


def extract_hrefs(html: Column | str, extension: str | None = "xlsx") -> Column:
    """All quoted hrefs (ending in ``.extension`` when given), in page order."""
    pat = href_pattern(extension) if extension else r"(?i)href=[\"']([^\"']+)[\"']"
    return F.regexp_extract_all(_col(html), F.lit(pat), 1)


def _month_number(prefix: Column) -> Column:
    """Month number by the first three letters of a name (any case)."""
    lookup = F.create_map(*[x for k, v in MONTH_NUMBERS.items() if len(k) == 3 for x in (F.lit(k), F.lit(v))])
    return F.coalesce(lookup[F.lower(prefix)], F.lit(0))


def _year_month_score(acc: Column, y: Column, m: Column) -> Column:
    ok = m.between(1, 12) & y.between(1990, 2100)
    return F.greatest(acc, F.when(ok, y * 100 + m).otherwise(F.lit(0)))


def filename_date_score(name: Column | str) -> Column:
    """Newer-is-larger score of a file name.

    Max of ``year*100+month`` over month-name+year matches and over numeric
    ``YYYY-MM`` tokens (month 1..12, year 1990..2100); when neither matches,
    the largest bare year in 1990..2100 times 100; else 0.

    Regex matches do not overlap, so the month-name pass is a sequence of
    non-overlapping matches exactly like a scanning regex engine's.
    """
    s = _col(name)

    def best(pattern: str, score) -> Column:
        """Largest score over all matches, each read by position, not by another regex."""
        return F.aggregate(F.regexp_extract_all(s, F.lit(pattern), F.lit(0)), F.lit(0), score)

    def month_name(acc: Column, x: Column) -> Column:
        # A match is: one other character or none, the month's name, ..., the
        # year, one other character or none.
        start = F.when(F.lower(F.left(x, F.lit(1))).between("a", "z"), 1).otherwise(2)
        end = F.when(F.right(x, F.lit(1)).between("0", "9"), F.length(x) - 3).otherwise(F.length(x) - 4)
        return F.greatest(acc, F.substring(x, end, F.lit(4)).cast("int") * 100 + _month_number(F.substring(x, start, F.lit(3))))

    named = best(MONTH_NAME_PATTERN, month_name)
    numeric = best(YEAR_MONTH_PATTERN, lambda acc, x: _year_month_score(acc, F.substring(x, 1, 4).cast("int"), F.substring(x, 6, 2).cast("int")))
    bare = F.aggregate(
        F.regexp_extract_all(s, F.lit(BARE_YEAR_PATTERN), 1),
        F.lit(0),
        lambda acc, y: F.greatest(acc, F.when(y.cast("int").between(1990, 2100), y.cast("int") * 100).otherwise(F.lit(0))),
    )
    # Each pass is worked out once: the dated score is bound to a name, the bare years
    # are looked for only without one, and nothing is where there is no year at all.
    score = F.get(F.transform(F.array(F.greatest(named, numeric)), lambda dated: F.when(dated > 0, dated).otherwise(bare)), F.lit(0))
    return F.when(s.rlike(r"\d{4}"), score).otherwise(F.lit(0))


def _without_dots(path: Column) -> Column:
    """A path with its ``.`` and ``..`` segments resolved."""
    parts = F.split(path, "/")
    last = F.element_at(parts, -1)
    folded = F.aggregate(
        parts,
        F.array().cast("array<string>"),
        lambda done, part: F.when(part == ".", done)
        .when(part == "..", F.when(F.size(done) > 1, F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(1)))).otherwise(done))
        .otherwise(F.array_append(done, part)),
    )
    # A path that ends in a dot segment is a folder.
    whole = F.when(last.isin(".", ".."), F.array_append(folded, F.lit(""))).otherwise(folded)
    return F.when(path.contains("/."), F.array_join(whole, "/")).otherwise(path)


def absolute_url(base: Column | str, href: Column | str) -> Column:
    """Resolve ``href`` against the page URL ``base``.

    Absolute (with a scheme), protocol-relative ``//host``, root-relative
    ``/path``, relative ``path`` (to the base's folder), a query or a fragment
    alone, and dot segments, which are resolved.
    """
    b, h = _col(base), _col(href)
    scheme = F.regexp_extract(b, r"^([A-Za-z][A-Za-z0-9+.-]*):", 1)
    origin = F.regexp_extract(b, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    base_path = F.regexp_extract(b, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    folder = F.when(base_path == "", F.lit("/")).otherwise(F.regexp_replace(base_path, r"[^/]*$", ""))
    path, tail = F.regexp_extract(h, r"^([^?#]*)", 1), F.regexp_extract(h, r"^[^?#]*(.*)$", 1)
    return (
        F.when(h.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), h)
        .when(h.startswith("//"), F.concat(scheme, F.lit(":"), h))
        .when(h.startswith("/"), F.concat(origin, _without_dots(path), tail))
        .when(h.startswith("?"), F.concat(origin, base_path, h))
        .when(path == "", F.concat(F.regexp_extract(b, r"^([^#]*)", 1), h))
        .otherwise(F.concat(origin, _without_dots(F.concat(folder, path)), tail))
    )


def decoded_file_name(url: Column | str) -> Column:
    """Last path segment, percent-decoded; ``+`` stays ``+``."""
    last = F.element_at(F.split(_col(url), "/"), -1)
    return F.coalesce(F.try_url_decode(F.regexp_replace(last, r"\+", "%2B")), last)


def prefer_database(name: Column | str, enabled: Column | bool) -> Column:
    """The bonus when enabled and the name mentions "database"."""
    en = F.lit(enabled) if isinstance(enabled, bool) else enabled
    return F.when(en & F.lower(_col(name)).contains("database"), F.lit(DATABASE_BONUS)).otherwise(F.lit(0))


def url_host(url: Column | str) -> Column:
    """The host of a URL, lower-cased; null without one.

    It is read from the authority (what stands between ``//`` and the next ``/``,
    ``?`` or ``#``), less user info and port, so the rest of the URL may hold spaces or other
    characters that a strict parser refuses."""
    authority = F.regexp_extract(_col(url), r"(?s)^\s*(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)", 1)
    host = F.regexp_extract(F.substring_index(authority, "@", -1), r"(?s)^(?:\[([^\]]*)\]|([^:]*))", 0)
    return F.nullif(F.lower(F.regexp_replace(host, r"^\[|\]$", "")), F.lit(""))


def host_allowed(url: Column | str, hosts: list[str]) -> Column:
    """True when the URL's host is one of ``hosts`` (case-insensitive)."""
    return F.coalesce(url_host(url).isin([h.lower() for h in hosts]), F.lit(False))


def redact_urls(text: Column | str, host_pattern: str, replacement: str = "<source>") -> Column:
    """Replace every URL that names the host anywhere (as host or part of
    it, in user info, path or query) by a placeholder, the whole of it."""
    url = r"[^\s\"'<>)]*"
    return F.regexp_replace(_col(text), rf"(?i)https?://{url}{host_pattern}{url}", replacement)


def normalize_dataset_id(value: str) -> str:
    """C10 for one id (driver side)."""
    if not isinstance(value, str) or not value.strip():
        raise ValueError("dataset_id must be a non-empty string")
    s = value.strip().upper()
    if not re.fullmatch(DATASET_ID_PATTERN, s):
        raise ValueError(f"dataset_id {value!r} is not a valid id (letters, digits and underscores)")
    return s


def normalize_dataset_id_col(c: Column | str) -> Column:
    """C10 as a column: canonical id, or null when not a valid id."""
    s = F.upper(strip_col(_col(c)))
    return F.when(s.rlike(rf"^{DATASET_ID_PATTERN}\z"), s)


def stale_age_minutes(fetched_at: Column | str, now: Column | None = None) -> Column:
    """C11: whole minutes since a payload was fetched, never negative."""
    n = now if now is not None else F.current_timestamp()
    secs = F.unix_timestamp(n) - F.unix_timestamp(_col(fetched_at))
    return F.greatest(F.lit(0), F.floor(secs / 60)).cast("long")
