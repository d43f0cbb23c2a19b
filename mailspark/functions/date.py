"""Date header -> instant, as a Column expression."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from mailspark.functions import patterns as P

# Zone names of RFC 5322 section 4.3 and their offsets.
ZONES = {
    "UT": "+0000", "GMT": "+0000", "UTC": "+0000", "Z": "+0000",
    "EST": "-0500", "EDT": "-0400",
    "CST": "-0600", "CDT": "-0500",
    "MST": "-0700", "MDT": "-0600",
    "PST": "-0800", "PDT": "-0700",
}

_FORMAT = "d MMM yyyy HH:mm:ss Z"


def parse_date(text: Column) -> Column:
    """RFC 5322 date, obsolete forms included; null when absent or unreadable."""
    usual = F.regexp_extract(text, P.USUAL_DATE, 1)
    return F.when(usual != "", F.try_to_timestamp(usual, F.lit(_FORMAT))).otherwise(_unusual(text))


def _unusual(text: Column) -> Column:
    """Weekday, comments, short years, missing seconds and named or missing zones put right first."""
    clean = F.regexp_replace(text, P.COMMENT, " ")
    clean = F.trim(F.regexp_replace(clean, r"\s++", " "))
    clean = F.regexp_replace(clean, r"^[A-Za-z]{2,} ?,? ?(?=\d)", "")
    clean = F.regexp_replace(clean, r"^(\d{1,2})[ -]([A-Za-z]{3})[A-Za-z]*+[ -](?=\d)", "$1 $2 ")
    clean = F.regexp_replace(clean, r"^(\d{1,2} [A-Za-z]{3}) ([0-4]\d) ", "$1 20$2 ")
    clean = F.regexp_replace(clean, r"^(\d{1,2} [A-Za-z]{3}) ([5-9]\d) ", "$1 19$2 ")
    clean = F.regexp_replace(clean, r" (\d):", " 0$1:")
    clean = F.regexp_replace(clean, r" (\d\d:\d\d)(?!:)", " $1:00")
    moment = F.regexp_extract(clean, r"^(\d{1,2} [A-Za-z]{3} \d{4} \d\d:\d\d:\d\d)", 1)
    zone = F.upper(F.regexp_extract(clean, r"\d\d:\d\d:\d\d ?([+-]\d{4}|[A-Za-z]+)", 1))
    offset = F.when(F.regexp_like(zone, F.lit(r"^[+-]\d{4}$")), zone)
    for name, value in ZONES.items():
        offset = offset.when(zone == name, F.lit(value))
    offset = offset.otherwise(F.lit("+0000"))
    return F.when(moment != "", F.try_to_timestamp(F.concat(moment, F.lit(" "), offset), F.lit(_FORMAT)))
