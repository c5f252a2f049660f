"""Ordered classifications as one CASE each: the first rule that holds decides."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def first_of(rules: list[tuple[Column, str]], default: str | None = None) -> Column:
    """The outcome of the first rule that holds."""
    out = F.lit(default)
    for when, then in reversed(rules):
        out = F.when(when, then).otherwise(out)
    return out


def country(known: Column, body: Column, names: list[tuple[str, str]]) -> Column:
    """A known two-letter code, else that of the longest country name found as a word."""
    by_length = sorted(names, key=lambda x: -len(x[0]))
    return F.coalesce(known, first_of([(body.rlike(rf"(?U)\b{n}\b"), code) for n, code in by_length]))


def tier(code: Column, tiers: dict[str, list[str]]) -> Column:
    return first_of([(code.isNull(), "UNKNOWN"), *((code.isin(*v), k) for k, v in tiers.items())], "OTHER")


# Classes of failures and what tells of them, in order of precedence.
FAILURES = (
    "AUTH_PERMISSION", "RATE_LIMIT", "UPSTREAM_5XX", "TIMEOUT", "BLOCKED_ANTI_BOT", "NETWORK_TRANSPORT", "PARSER_SCHEMA",
    "CONFIGURATION", "INVALID_ARTIFACT", "MISSING_ARTIFACT", "UNKNOWN",
)
AUTH_CODES = ("accessdenied", "unauthorized", "invalidaccesskeyid", "signaturedoesnotmatch")
AUTH = "access denied|unauthorized|invalid access key|invalidaccesskeyid|signaturedoesnotmatch"
RATE = "too many requests|rate limit|ratelimit"
BOT = "captcha|anti-bot|antibot|bot challenge|challenge page|cloudflare challenge|blocked by"
NETWORK_TYPES = "connectionerror|proxyerror|sslerror|newconnectionerror"
NETWORK = "connection reset|connection refused|name or service not known|temporary failure in name resolution|dns|network is unreachable"
SETTINGS = "missing required environment variable|unknown production shard|must be all or a positive integer"


def failure(message: Column, status: Column, kind: Column | None = None, code: Column | None = None) -> Column:
    """Class of a failed request, from its message, HTTP status, type of error and code of the service."""
    low = lambda x: F.lower(F.coalesce(x, F.lit(""))) if x is not None else F.lit("")
    m, t, s = low(message), low(kind), F.coalesce(status, F.lit(0))
    return first_of(
        [
            (F.trim(low(code)).isin(*AUTH_CODES) | m.rlike(AUTH), "AUTH_PERMISSION"),
            ((s == 429) | m.rlike(RATE), "RATE_LIMIT"),
            (s.between(500, 599), "UPSTREAM_5XX"),
            (t.contains("timeout") | m.rlike("timed out|timeout"), "TIMEOUT"),
            (m.rlike(BOT), "BLOCKED_ANTI_BOT"),
            (t.rlike(NETWORK_TYPES) | m.rlike(NETWORK), "NETWORK_TRANSPORT"),
            (t.isin("jsondecodeerror", "unicodedecodeerror"), "PARSER_SCHEMA"),
            ((t == "keyerror") | m.rlike(SETTINGS), "CONFIGURATION"),
            (t == "invalidartifact", "INVALID_ARTIFACT"),
            (t.isin("missingartifact", "filenotfounderror"), "MISSING_ARTIFACT"),
        ],
        "UNKNOWN",
    )


def status_of(status: Column) -> Column:
    """Status of a set of parts: OK if all are, PARTIAL if any is usable, then ERROR, MISSING, UNKNOWN."""
    return F.coalesce(
        F.when(F.bool_and(status == "OK"), "OK")
        .when(F.bool_or(status.isin("OK", "PARTIAL")), "PARTIAL")
        .when(F.bool_or(status == "ERROR"), "ERROR")
        .when(F.bool_or(status == "MISSING"), "MISSING"),
        F.lit("UNKNOWN"),
    )
