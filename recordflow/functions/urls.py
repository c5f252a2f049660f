"""URLs as matching keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Query keys that name a posting; all others are dropped from the matching key.
IDENTITY_KEYS = (
    "id", "jobid", "job_id", "job-id", "vacancyid", "vacancy_id", "offerid", "offer_id", "positionid", "position_id",
    "requisitionid", "requisition_id", "reqid", "req_id", "p_recruitment_id",
)
#: Query keys that only track a visit.
TRACKING_KEYS = ("utm_source", "utm_medium", "utm_campaign", "utm_term", "utm_content", "gclid", "fbclid")


def _part(url: Column, name: str) -> Column:
    return F.coalesce(F.try_parse_url(F.trim(url), F.lit(name)), F.lit(""))


def host(url: Column) -> Column:
    return F.regexp_replace(F.lower(_part(url, "HOST")), r"^www\.", "")


def _path(url: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(_part(url, "PATH"), "/{2,}", "/"), "/+$", "")


def _port(url: Column) -> Column:
    return F.regexp_extract(_part(url, "AUTHORITY"), r"(:\d+)$", 1)


def _query(url: Column, keep) -> Column:
    pairs = F.filter(F.split(_part(url, "QUERY"), "&"), lambda p: (p != "") & keep(F.lower(F.substring_index(p, "=", 1))))
    return F.array_join(F.array_sort(pairs), "&")


def match_key(url: Column) -> Column:
    """Scheme dropped, host lowered without www., slashes squeezed, identity query keys sorted and lowered."""
    query = F.lower(_query(url, lambda k: k.isin(*IDENTITY_KEYS)))
    base = F.concat(host(url), _port(url), _path(url))
    return F.when(host(url) == "", "").otherwise(F.when(query == "", base).otherwise(F.concat(base, F.lit("?"), query)))


def state_key(url: Column) -> Column:
    """As ``match_key``, with the whole query dropped."""
    return F.when(host(url) == "", "").otherwise(F.concat(host(url), _port(url), _path(url)))


def is_generic(url: Column, suffixes: tuple[str, ...] = ("", "/jobs", "/careers", "/vacancies", "/search")) -> Column:
    """Whether the path ends like a listing, so that the URL names no single posting."""
    return F.lower(_path(url)).rlike("^(?:.*(?:" + "|".join(s for s in suffixes if s) + "))?$")


def without_tracking(url: Column) -> Column:
    """The URL without tracking parameters and fragment; other parameters keep their order."""
    bare = F.substring_index(F.trim(url), "#", 1)
    path = F.substring_index(bare, "?", 1)
    query = F.when(F.contains(bare, F.lit("?")), F.substring(bare, F.length(path) + 2, F.length(bare))).otherwise("")
    kept = F.array_join(
        F.filter(F.split(query, "&"), lambda p: (p != "") & ~F.lower(F.substring_index(p, "=", 1)).isin(*TRACKING_KEYS)), "&"
    )
    return F.when(kept == "", path).otherwise(F.concat(path, F.lit("?"), kept))


def next_page(url: Column, key: str = "page") -> Column:
    """The URL with its page number one higher; a first page without a number becomes page 2."""
    at = F.regexp_extract(url, rf"[?&]{key}=(\d+)", 1)
    raised = F.regexp_replace(
        url, F.lit(rf"([?&]{key}=)\d+"), F.concat(F.lit("$1"), (F.coalesce(at.try_cast("int"), F.lit(0)) + 1).cast("string"))
    )
    mark = F.when(F.contains(url, F.lit("?")), "&").otherwise("?")
    return F.when(at != "", raised).otherwise(F.concat(url, mark, F.lit(f"{key}=2")))


def in_domain(name: Column, domain: str) -> Column:
    """Whether a host is the domain or one below it."""
    return (name == domain) | F.endswith(name, F.lit("." + domain))
