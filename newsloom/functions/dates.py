"""Feed date expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from newsloom.functions.barrier import let

# Time zone names of RFC 822 and their offsets.
ZONE_OFFSETS = {
    "UT": "+0000",
    "UTC": "+0000",
    "GMT": "+0000",
    "Z": "+0000",
    "EST": "-0500",
    "EDT": "-0400",
    "CST": "-0600",
    "CDT": "-0500",
    "MST": "-0700",
    "MDT": "-0600",
    "PST": "-0800",
    "PDT": "-0700",
}

RFC822_FORMATS = (
    "d MMM yyyy HH:mm:ss xx",
    "d MMM yyyy HH:mm xx",
    "d MMM yy HH:mm:ss xx",
    "d MMM yy HH:mm xx",
    "d MMM yyyy HH:mm:ss",
)


def _rfc822(text: Column) -> Column:
    plain = F.regexp_replace(F.trim(text), r"^[A-Za-z]+,\s*", "")
    plain = F.regexp_replace(plain, r"\s+", " ")
    offsets = F.create_map(*[F.lit(x) for pair in ZONE_OFFSETS.items() for x in pair])

    def zoned(p: Column) -> Column:
        offset = F.try_element_at(offsets, F.regexp_extract(p, " ([A-Z]{1,3})$", 1))
        return F.when(offset.isNull(), p).otherwise(F.concat(F.regexp_replace(p, "[A-Z]+$", ""), offset))

    def read(p: Column) -> Column:
        return F.coalesce(*[F.try_to_timestamp(p, F.lit(f)) for f in RFC822_FORMATS])

    return let(plain, lambda p: let(zoned(p), read))


def parse_date(text: Column) -> Column:
    """RFC 822 or ISO 8601 text to a UTC timestamp; NULL when neither fits, as for a time without a date."""
    dated = F.trim(text).rlike(r"^[+-]?[0-9]{4,7}(-[0-9]{1,2}){0,2}([T ].*)?$")
    return F.coalesce(_rfc822(text), F.when(dated, F.trim(text).try_cast("timestamp")))


def first_date(*texts: Column) -> Column:
    """The first of several date texts that can be read."""
    return F.coalesce(*[parse_date(t) for t in texts])
