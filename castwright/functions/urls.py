"""URL predicates and video-id extraction as native column expressions.

``parse_url`` returns null for URLs with spaces or ``|`` and keeps the host's case, while the
rules here follow the lenient ``scheme://[user@]host[:port]/path?query#fragment`` split, so a
host regex is used instead.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Video hosts and path prefixes.
VIDEO_HOSTS = ("youtube.com", "www.youtube.com", "m.youtube.com", "youtu.be", "www.youtu.be")
SHORT_HOSTS = ("youtu.be", "www.youtu.be")
LONG_HOSTS = ("youtube.com", "www.youtube.com", "m.youtube.com")
VIDEO_PATH_PREFIXES = ("/shorts/", "/embed/", "/live/")

SCHEME_ERROR = "source_url must start with http:// or https://"
NOT_VIDEO_ERROR = "source_url is not a supported YouTube URL"
NO_VIDEO_ID_ERROR = "Could not extract video id from YouTube URL"

AUTHORITY_RX = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//"
HOST_RX = AUTHORITY_RX + r"(?:[^/?#]*@)?([^/?#:]*)"
PATH_RX = AUTHORITY_RX + r"[^/?#]*([^?#]*)"
QUERY_RX = r"^[^?#]*\?([^#]*)"


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def scheme_ok(url: Column | str) -> Column:
    """Case-sensitive http:// or https:// prefix."""
    u = _c(url)
    return u.startswith("http://") | u.startswith("https://")


def url_host(url: Column | str) -> Column:
    """Lower-cased host without user info and port; '' when the URL has no authority."""
    return F.lower(F.regexp_extract(_c(url), HOST_RX, 1))


def url_path(url: Column | str) -> Column:
    """Path up to the query, without the ``;params`` of its last segment."""
    return F.regexp_replace(F.regexp_extract(_c(url), PATH_RX, 1), r";[^/]*$", "")


def url_query(url: Column | str) -> Column:
    return F.regexp_extract(_c(url), QUERY_RX, 1)


def is_video_url(url: Column | str) -> Column:
    """Host in the five video hosts (false for null)."""
    return F.coalesce(url_host(url).isin(*VIDEO_HOSTS), F.lit(False))


def _plus_decode(x: Column) -> Column:
    # '+' means space in a query string; decode it before the percent escapes.
    return F.try_url_decode(F.replace(x, F.lit("+"), F.lit(" ")))


def query_param(url: Column | str, name: str) -> Column:
    """First non-blank value of ``name`` in the query string, percent- and plus-decoded."""
    fields = F.split(url_query(url), "&", -1)
    pairs = F.transform(
        F.filter(fields, lambda f: F.instr(f, "=") > 0),
        lambda f: F.struct(
            _plus_decode(F.substring_index(f, "=", 1)).alias("k"),
            F.substring(f, F.instr(f, "=") + 1, 1 << 30).alias("raw"),
        ),
    )
    hits = F.filter(pairs, lambda p: (p["k"] == F.lit(name)) & (p["raw"] != F.lit("")))
    return _plus_decode(F.try_element_at(hits, F.lit(1))["raw"])


def video_id(url: Column | str) -> Column:
    """R2: id from the short host's first path part, the long hosts' ``/watch?v=`` or the
    first part after /shorts/, /embed/, /live/; null when none applies."""
    host = url_host(url)
    path = url_path(url)
    short_id = F.substring_index(F.ltrim(path, F.lit("/")), "/", 1)
    watch_id = F.when(path == F.lit("/watch"), query_param(url, "v"))
    prefixed = F.lit(None).cast("string")
    for prefix in reversed(VIDEO_PATH_PREFIXES):
        tail = F.substring_index(F.substring(path, len(prefix) + 1, 1 << 30), "/", 1)
        prefixed = F.when(path.startswith(prefix) & (tail != F.lit("")), tail).otherwise(prefixed)
    long_id = F.coalesce(F.when(watch_id != F.lit(""), watch_id), prefixed)
    return F.when(host.isin(*SHORT_HOSTS) & (short_id != F.lit("")), short_id).when(
        host.isin(*LONG_HOSTS), long_id
    )


def video_id_error(url: Column | str) -> Column:
    return F.when(~is_video_url(url), F.lit(NOT_VIDEO_ERROR)).when(
        video_id(url).isNull(), F.lit(NO_VIDEO_ID_ERROR)
    )
