"""String expressions used while reading log lines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The 29 characters treated as white space at either end of a line.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# URL schemes whose last path segment may carry ";params".
PARAM_SCHEMES = (
    "ftp", "hdl", "prospero", "http", "https", "imap", "shttp", "rtsp", "rtsps", "rtspu",
    "sip", "sips", "mms", "sftp", "tel",
)
# Page-title and download-suffix patterns.
TITLE_PATTERN = r"index.php\?title=([^ &]*)"
WIKI_PATTERN = r"/wiki/([^ &]*)"
DOWNLOAD_SUFFIX = r"(?iu)[.](gz|E\p{Nd}\p{Nd}|csv|dd|raw|iso)$"

C0_AND_SPACE = "".join(chr(c) for c in range(0x21))


def strip(c: Column) -> Column:
    """Drop white space at both ends."""
    return F.btrim(c, F.lit(WHITESPACE))


def safe_int(c: Column, dtype: str = "bigint") -> Column:
    """Integer value, or NULL where the text is no integer."""
    return c.try_cast(dtype)


def percent_decode(c: Column, times: int = 2) -> Column:
    """Undo percent-encoding ``times`` over; ``+`` and broken escapes stay as they are."""
    decoded = c
    for _ in range(times):
        literal_plus = F.replace(decoded, F.lit("+"), F.lit("%2B"))
        decoded = F.url_decode(F.regexp_replace(literal_plus, "%(?![0-9A-Fa-f]{2})", "%25"))
    return F.when(F.contains(c, F.lit("%")), decoded).otherwise(c)


def url_path(url: Column) -> Column:
    """Path of a URL, without scheme, host, query, fragment and the last segment's ``;params``."""
    text = F.translate(F.ltrim(url, F.lit(C0_AND_SPACE)), "\t\r\n", "")
    scheme = F.lower(F.regexp_extract(text, r"^([A-Za-z][A-Za-z0-9+.\-]*):", 1))
    rest = F.regexp_replace(text, r"^([A-Za-z][A-Za-z0-9+.\-]*:)?(//[^/?#]*)?", "")
    path = F.regexp_replace(rest, r"[?#][\s\S]*$", "")
    bare = F.when(
        F.contains(path, F.lit(";")) & scheme.isin("", *PARAM_SCHEMES),
        F.regexp_replace(path, r";[^/]*$", ""),
    ).otherwise(path)
    return F.coalesce(bare, F.lit(""))


def wikipage(url: Column) -> Column:
    """Wiki page a URL names, else NULL; an empty title stays an empty string."""
    return F.coalesce(
        *[
            F.when(url.rlike(p), F.regexp_extract(url, p, 1))
            for p in (TITLE_PATTERN, WIKI_PATTERN)
        ]
    )


def is_download(url: Column) -> Column:
    """Whether a URL ends in one of the download suffixes."""
    return F.coalesce(url.rlike(DOWNLOAD_SUFFIX), F.lit(False))


def request_parts(request: Column) -> Column:
    return F.split(request, " ")


def request_method(request: Column) -> Column:
    return F.get(request_parts(request), F.lit(0))


def request_url(request: Column) -> Column:
    """Second word of the request, NULL when there is one word only."""
    return F.get(request_parts(request), F.lit(1))
