"""URLs as column expressions: splitting, canonical form, crawl scope, policy, redaction."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Parameters that only track, and prefixes of parameters that carry credentials.
TRACKING_EXACT = ("fbclid", "gclid")
TRACKING_PREFIX = "utm_"
CREDENTIAL_PREFIXES = (
    "token", "access_token", "key", "api_key", "secret", "auth", "sig", "signature",
    "x-amz-credential", "x-amz-signature", "x-amz-security-token", "x-goog-signature",
)
REDACTED = "<local-path-redacted>"

# scheme, authority, path, query, fragment, as in RFC 3986's appendix
_PARTS = r"^(?:([A-Za-z][A-Za-z0-9+.-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"


def _part(url: Column, n: int) -> Column:
    return F.regexp_extract(url, _PARTS, n)


def scheme(url: Column) -> Column:
    return F.lower(_part(url, 1))


def authority(url: Column) -> Column:
    return _part(url, 2)


def path(url: Column) -> Column:
    return _part(url, 3)


def query(url: Column) -> Column:
    return _part(url, 4)


def host(url: Column) -> Column:
    """Lower-case host without user and port; brackets of IPv6 literals are dropped."""
    bare = F.regexp_replace(authority(url), "^.*@", "")
    return F.lower(F.when(bare.startswith("["), F.regexp_extract(bare, r"^\[([^\]]*)\]", 1)).otherwise(F.regexp_replace(bare, ":[0-9]*$", "")))


def port(url: Column) -> Column:
    """The port as text, empty if none is given."""
    return F.regexp_extract(authority(url), r":([0-9]+)$", 1)


def userinfo(url: Column) -> Column:
    """User and password with the sign that ends them, or nothing."""
    return F.regexp_extract(authority(url), "^(.*@)", 1)


def _decoded(x: Column) -> Column:
    return F.coalesce(F.try_url_decode(x), x)


def _encoded(x: Column) -> Column:
    """Form encoding that keeps the tilde and encodes the asterisk."""
    return F.replace(F.replace(F.url_encode(x), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def query_pairs(q: Column) -> Column:
    """array<struct<key, at, value>> of a query string in order, blank values kept."""
    pieces = F.filter(F.split(q, "&"), lambda p: p != "")
    return F.transform(
        pieces,
        lambda p, i: F.struct(
            _decoded(F.substring_index(p, "=", 1)).alias("key"),
            i.alias("at"),
            _decoded(F.when(F.contains(p, F.lit("=")), F.regexp_replace(p, "^[^=]*=", "")).otherwise("")).alias("value"),
        ),
    )


def _joined(pairs: Column) -> Column:
    return F.array_join(F.transform(pairs, lambda p: F.concat(_encoded(p["key"]), F.lit("="), _encoded(p["value"]))), "&")


def _is_tracking(key: Column) -> Column:
    k = F.lower(key)
    return k.isin(*TRACKING_EXACT) | k.startswith(TRACKING_PREFIX)


def resolve_dots(p: Column) -> Column:
    """Segments of a path without empty and "." ones, each ".." taking one away (never above the root)."""
    segments = F.filter(F.split(p, "/"), lambda s: (s != "") & (s != "."))
    empty = F.array().cast("array<string>")
    return F.aggregate(segments, empty, lambda acc, s: F.when(s == "..", F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0)))).otherwise(F.array_append(acc, s)))


def _clean_path(p: Column) -> Column:
    joined = F.concat(F.lit("/"), F.array_join(resolve_dots(p), "/"))
    return F.when(p == "", "/").otherwise(F.when(p.endswith("/") & (p != "/") & ~joined.endswith("/"), F.concat(joined, F.lit("/"))).otherwise(joined))


def canonical_url(url: Column) -> Column:
    """Lower-case scheme and host, no default port, clean path, no tracking parameters, parameters sorted by key, no fragment; null if not http(s) or without host."""
    s, p = scheme(url), port(url)
    default = ((s == "http") & (p == "80")) | ((s == "https") & (p == "443"))
    h = host(url)
    shown = F.when((p != "") & ~default, F.concat(h, F.lit(":"), p)).otherwise(h)
    q = _joined(F.array_sort(F.filter(query_pairs(query(url)), lambda x: ~_is_tracking(x["key"]))))
    whole = F.concat(s, F.lit("://"), userinfo(url), shown, _clean_path(path(url)), F.when(q != "", F.concat(F.lit("?"), q)).otherwise(""))
    return F.when(s.isin("http", "https") & (h != ""), whole)


def normalize_url(url: Column) -> Column:
    """No fragment; an empty path becomes the root."""
    bare = F.regexp_replace(url, "#.*$", "")
    q = query(bare)
    return F.when(path(bare) == "", F.concat(scheme(bare), F.lit("://"), authority(bare), F.lit("/"), F.when(q != "", F.concat(F.lit("?"), q)).otherwise(""))).otherwise(bare)


def dedup_key(url: Column) -> Column:
    """Canonical form, or the normalized one where there is none."""
    return F.coalesce(canonical_url(url), normalize_url(url))


def section_scope(url: Column) -> Column:
    """The folder that a crawl stays in: a path ending in a slash, or the parent of a file name; else null."""
    p = F.when(path(url) == "", "/").otherwise(path(url))
    parent = F.regexp_replace(p, "/[^/]*$", "")
    named = F.regexp_extract(p, "([^/]*)$", 1)
    return F.when(F.regexp_replace(p, "/", "") == "", F.lit(None)).when(p.endswith("/"), p).when(named.contains("."), F.when(parent != "", F.concat(parent, F.lit("/"))))


def within_scope(url: Column, scope: Column) -> Column:
    p = F.when(path(url) == "", "/").otherwise(path(url))
    return F.coalesce(scope, F.lit("")).isin("") | (p == F.rtrim(scope, F.lit("/"))) | F.startswith(p, scope)


def is_print_page(url: Column, body: Column | None = None) -> Column:
    """Pages made for printing: by file name, by a query key or value, or by markers in the body."""
    name = F.lower(F.regexp_extract(F.regexp_replace(path(url), "/+$", ""), "([^/]*)$", 1))
    asked = F.exists(query_pairs(query(url)), lambda p: F.lower(p["key"]).contains("print") | F.lower(p["value"]).contains("print"))
    by_url = name.isin("print", "print.html", "print.htm") | asked
    if body is None:
        return by_url
    b = F.lower(body)
    told = (b.contains("data-r-output-format=print") | b.contains('data-r-output-format="print"')) & b.contains("canonical")
    return by_url | F.coalesce((b.contains("window.print") & b.contains("noindex")) | told, F.lit(False))


_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
#: Reserved, private, loopback and link-local IPv4 blocks.
_PRIVATE_V4 = (
    r"^(?:0\.|10\.|127\.|169\.254\.|192\.168\.|172\.(?:1[6-9]|2\d|3[01])\.|192\.0\.0\.(?!9$|10$)|192\.0\.2\.|198\.1[89]\.|198\.51\.100\.|203\.0\.113\.|2(?:4\d|5[0-5])\.)"
)


def is_private_host(h: Column) -> Column:
    """localhost and literals of private, loopback or link-local addresses; names are not resolved."""
    v4 = h.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$") & h.rlike(_PRIVATE_V4)
    v6 = F.lower(h).rlike(r"^(?:::1?$|f[cd][0-9a-f]{2}:|fe[89ab][0-9a-f]:|::ffff:(?:10|127|169\.254|192\.168)\.|2001:db8:)") & h.contains(":")
    return (F.lower(h) == "localhost") | v4 | v6


def url_verdict(url: Column) -> Column:
    """"ok", or why a crawl may not fetch the URL."""
    h = host(url)
    return F.when(~scheme(url).isin("http", "https"), "scheme").when(h == "", "host").when(is_private_host(h), "private").otherwise("ok")


def redirects_allowed(count: Column, most: int = 5) -> Column:
    return count <= most


def sanitize_source(raw: Column) -> Column:
    """A source that may be shown: local paths redacted; URLs without user, credentials and fragment."""
    low = F.lower(raw)
    p = port(raw)
    bare = F.when(host(raw).contains(":"), F.concat(F.lit("["), host(raw), F.lit("]"))).otherwise(host(raw))
    secret = lambda k: F.exists(F.array(*[F.lit(x) for x in CREDENTIAL_PREFIXES]), lambda x: F.startswith(F.lower(k), x))
    q = _joined(F.filter(query_pairs(query(raw)), lambda x: ~secret(x["key"])))
    url = F.concat(scheme(raw), F.lit("://"), bare, F.when(p != "", F.concat(F.lit(":"), p)).otherwise(""), path(raw), F.when(q != "", F.concat(F.lit("?"), q)).otherwise(""))
    return F.when(low.startswith("file://"), REDACTED).when(low.startswith("http://") | low.startswith("https://"), url).when(raw.rlike(r"^[/\\]|^[A-Za-z]:"), REDACTED).otherwise(raw)


def docs_url(prefix: Column, rel: Column) -> Column:
    """Published address of a file: no ".md", a trailing "index" dropped, prefix in front, lower case."""
    stem = F.regexp_replace(rel, r"\.md$", "")
    stem = F.when((stem == "index") | stem.endswith("/index"), F.regexp_replace(F.regexp_replace(stem, "index$", ""), "/+$", "")).otherwise(stem)
    head = F.concat(F.lit("/"), F.regexp_replace(F.replace(prefix, F.lit("\\"), F.lit("/")), "^/+|/+$", ""))
    return F.lower(F.when(stem != "", F.concat(head, F.lit("/"), stem)).otherwise(head))


def breadcrumb_prefix(crumb: Column) -> Column:
    """The path before a "breadcrumb" or "bread" segment of an absolute breadcrumb path; null otherwise."""
    parts = F.split(F.regexp_replace(crumb, "^/+|/+$", ""), "/")
    stop = F.array_min(F.filter(F.array(F.array_position(parts, "breadcrumb"), F.array_position(parts, "bread")), lambda i: i > 0))
    kept = F.array_join(F.slice(parts, F.lit(1), F.coalesce(stop - 1, F.size(parts)).cast("int")), "/")
    return F.when(crumb.startswith("/") & (kept != ""), F.concat(F.lit("/"), kept))


def backoff_seconds(attempt: Column, base: float = 1.0) -> Column:
    return F.least(F.lit(base) * F.pow(F.lit(2.0), attempt), F.lit(60.0))


def _safe_segment(s: Column) -> Column:
    cleaned = F.regexp_replace(F.regexp_replace(s, r"[^\p{L}\p{N}._-]", "-"), "^[ ._-]+|[ ._-]+$", "")
    return F.when(cleaned == "", "page").otherwise(cleaned)


def staged_path(url: Column, start_url: Column, taken: Column | None = None) -> Column:
    """Where a crawled page is kept: page.html for the start, else its cleaned path, "index.html" for folders; a hash of the URL tells apart those with a query or whose path is ``taken``."""
    parts = F.filter(F.split(_decoded(F.replace(path(url), F.lit("+"), F.lit("%2B"))), "/"), lambda s: s != "")
    named = F.when(F.size(parts) == 0, F.array(F.lit("index.html"))).when(F.element_at(parts, -1).contains("."), parts).otherwise(F.array_append(parts, F.lit("index.html")))
    joined = F.array_join(F.transform(named, _safe_segment), "/")
    ended = F.when(F.lower(joined).rlike(r"\.html?$"), joined).otherwise(F.concat(joined, F.lit(".html")))
    hashed = F.regexp_replace(ended, r"(\.[^./]+)$", F.concat(F.lit("--"), F.substring(F.sha2(F.encode(url, "UTF-8"), 256), 1, 10), F.lit("$1")))
    clash = query(url) != "" if taken is None else (query(url) != "") | taken
    return F.when(url == start_url, "page.html").when(clash, hashed).otherwise(ended)
