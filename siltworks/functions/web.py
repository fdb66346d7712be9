"""Query strings, secrets and URL checks as built-in column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Parameter names whose values are secrets.
SECRET_PARAMETERS = (
    "token", "key", "api_key", "apikey", "authorization", "auth", "access_token", "secret",
)
REDACTED = "***"

# Schemes that may be fetched, and hosts that may not (loopback, cloud metadata).
ALLOWED_SCHEMES = ("http", "https")
BLOCKED_HOSTS = (
    "localhost", "127.0.0.1", "::1", "[::1]", "169.254.169.254", "metadata.google.internal",
)

_SCHEME = r"^([A-Za-z][A-Za-z0-9+.\-]*):"


def _tidy(url: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(url, r"[\t\r\n]", ""), r"^[\x00-\x20]+", "")


def _scheme(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, _SCHEME, 1))


def _decoded(text: Column) -> Column:
    """Percent-decode; a ``%`` that starts no valid escape is kept as it is."""
    return F.url_decode(F.regexp_replace(text, "%(?![0-9A-Fa-f]{2})", "%25"))


def query_text(url: Column) -> Column:
    """Text between ``?`` and ``#``; a text without a scheme is taken as a query string itself."""
    tidy = _tidy(url)
    before_fragment = F.substring_index(tidy, "#", 1)
    return F.when(_scheme(tidy) == "", url).otherwise(
        F.regexp_extract(before_fragment, r"(?s)\?(.*)$", 1)
    )


def query_map(url: Column) -> Column:
    """Decoded parameters: empty items skipped, blank values kept, last duplicate wins.

    Earlier duplicates are dropped before the map is built, so the session's map policy
    does not matter.
    """
    items = F.filter(F.split(query_text(url), "&"), lambda item: item != "")
    entries = F.transform(
        items,
        lambda item: F.struct(
            _decoded(F.substring_index(item, "=", 1)).alias("key"),
            _decoded(F.regexp_extract(item, r"(?s)^[^=]*=?(.*)$", 1)).alias("value"),
        ),
    )
    backwards = F.reverse(F.transform(entries, lambda e: e["key"]))
    last_ones = F.filter(
        entries,
        lambda e, i: F.size(entries) - F.array_position(backwards, e["key"]) == i.cast("bigint"),
    )
    return F.map_from_entries(last_ones)


def overlay(base: Column, override: Column) -> Column:
    """Union of two maps in which ``override`` wins; needs no session setting."""
    kept = F.map_filter(base, lambda k, _: ~F.array_contains(F.map_keys(override), k))
    return F.map_concat(kept, override)


def redact(params: Column) -> Column:
    """Hide the values of secret parameters, whatever their case."""
    return F.transform_values(
        params,
        lambda k, v: F.when(F.lower(k).isin(*SECRET_PARAMETERS), F.lit(REDACTED)).otherwise(v),
    )


def url_host(url: Column) -> Column:
    """Lower-case host without user info, port or brackets; empty when there is none."""
    authority = F.regexp_extract(_tidy(url), r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)", 1)
    host_port = F.regexp_extract(authority, r"([^@]*)$", 1)
    bare = F.when(
        host_port.startswith("["), F.regexp_extract(host_port, r"^\[([^\]]*)\]", 1)
    ).otherwise(F.substring_index(host_port, ":", 1))
    return F.lower(bare)


def url_problem(url: Column) -> Column:
    """Why a URL must not be fetched, or null when it may be."""
    tidy = _tidy(url)
    authority = F.regexp_extract(tidy, r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)", 1)
    host = url_host(url)
    return (
        F.when(url.isNull() | (url == ""), F.lit("empty"))
        .when(authority.contains("[") != authority.contains("]"), F.lit("malformed"))
        .when(~_scheme(tidy).isin(*ALLOWED_SCHEMES), F.lit("scheme"))
        .when(host == "", F.lit("no host"))
        .when(host.isin(*BLOCKED_HOSTS), F.lit("blocked host"))
    )
