"""URL parts by the generic URI grammar, without raising on odd URLs."""

from pyspark.sql import Column, functions as F

# Schemes whose last path segment may carry ";params".
SCHEMES_WITH_PARAMS = [
    "", "ftp", "hdl", "prospero", "http", "https", "imap", "itms-services", "mms", "rtsp",
    "rtsps", "rtspu", "sftp", "shttp", "sip", "sips", "tel",
]

_SCHEME = r"[A-Za-z][A-Za-z0-9+.\-]*"


def scheme(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, rf"^({_SCHEME}):", 1))


def domain(url: Column) -> Column:
    """The authority with user information and port, case kept; '' if there is none."""
    return F.regexp_extract(url, rf"^(?:{_SCHEME}:)?//([^/?#]*)", 1)


def path(url: Column) -> Column:
    """The path without the parameters of its last segment."""
    full = F.regexp_extract(url, rf"^(?:{_SCHEME}:)?(?://[^/?#]*)?([^?#]*)", 1)
    return F.when(scheme(url).isin(SCHEMES_WITH_PARAMS),
                  F.regexp_replace(full, r";[^/]*$", "")).otherwise(full)


def query(url: Column) -> Column:
    return F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1)


def path_depth(url: Column) -> Column:
    """Number of non-empty path segments."""
    return F.size(F.array_remove(F.split(path(url), "/"), ""))


def query_count(url: Column) -> Column:
    """Number of '&'-separated query parts, empty ones included; 0 without a query."""
    text = query(url)
    return F.when(text == "", 0).otherwise(F.size(F.split(text, "&")))
