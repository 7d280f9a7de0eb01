"""URL expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Sites whose pages need a rendering fetcher first.
RENDER_FIRST_DOMAINS = (
    "newscientist.com",
    "wired.com",
    "theverge.com",
    "bloomberg.com",
    "ft.com",
    "wsj.com",
    "nytimes.com",
    "thetimes.co.uk",
    "telegraph.co.uk",
)


def url_key(url: Column) -> Column:
    """Key under which URLs are unique: case does not count."""
    return F.lower(url)


def host(url: Column) -> Column:
    """Lower-cased host without a leading `www.`; empty when the URL has none."""
    name = F.lower(F.coalesce(F.try_parse_url(url, F.lit("HOST")), F.lit("")))
    return F.regexp_replace(name, r"^www\.", "")


def in_domains(url: Column, domains=RENDER_FIRST_DOMAINS) -> Column:
    """True when the host is one of `domains` or lies below one of them."""
    name = host(url)
    tests = [(name == d) | F.endswith(name, F.lit("." + d)) for d in domains]
    hit = tests[0]
    for test in tests[1:]:
        hit = hit | test
    return hit


def without_query(url: Column) -> Column:
    return F.split_part(url, F.lit("?"), F.lit(1))
