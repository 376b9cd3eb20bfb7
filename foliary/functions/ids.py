"""Content hashes, identifiers, source keys, slugs and paths as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from foliary.functions.urls import resolve_dots

#: Fixed value: the namespace of URL names (RFC 9562).
NAMESPACE_URL = "6ba7b8119dad11d180b400c04fd430c8"


def content_sha256(body: Column) -> Column:
    return F.sha2(F.encode(body, "UTF-8"), 256)


def short_id(text: Column) -> Column:
    """The first 16 hex digits of the hash."""
    return F.substring(F.sha2(F.encode(text, "UTF-8"), 256), 1, 16)


def job_id(source: Column) -> Column:
    return short_id(source)


def document_id(job: Column, rel_path: Column, order: Column) -> Column:
    return short_id(F.concat(job, F.lit(":"), posix(rel_path), F.lit(":"), order.cast("string")))


def parent_document_id(job: Column, rel_path: Column) -> Column:
    return document_id(job, rel_path, F.lit(0))


def cache_path(base: str, job: Column) -> Column:
    return F.concat(F.lit(base + "/"), F.substring(job, 1, 2), F.lit("/"), job)


def name_uuid(key: Column) -> Column:
    """The version 5 UUID of a name in the URL namespace."""
    h = F.sha1(F.concat(F.unhex(F.lit(NAMESPACE_URL)), F.encode(key, "UTF-8")))
    variant = F.lower(F.hex(F.conv(F.substring(h, 17, 1), 16, 10).cast("int").bitwiseAND(3).bitwiseOR(8)))
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.concat(F.lit("5"), F.substring(h, 14, 3)), F.concat(variant, F.substring(h, 18, 3)), F.substring(h, 21, 12))


def canonical_source_key(kind: Column, raw: Column) -> Column:
    return F.concat(kind, F.lit(":"), F.when(kind.isin("file", "transcript"), posix(raw)).otherwise(raw))


def slug(text: Column) -> Column:
    """Letters, digits, dots, underscores and hyphens; "item" if nothing is left."""
    s = F.regexp_replace(F.regexp_replace(text, "[^A-Za-z0-9._-]+", "-"), "^-+|-+$", "")
    return F.when(s == "", "item").otherwise(s)


def posix(path: Column) -> Column:
    return F.replace(path, F.lit("\\"), F.lit("/"))


def is_workspace_relative(path: Column) -> Column:
    """Not empty, not absolute, no drive, no ".." segment."""
    p = posix(path)
    return (F.trim(p) != "") & ~p.rlike("^/|^[A-Za-z]:") & ~F.array_contains(F.split(p, "/"), "..")


def resolve_relative(current: Column, target: Column) -> Column:
    """A link target seen from a document's path, relative to the root; absolute targets lose their slashes."""
    folder = F.regexp_replace(posix(current), "[^/]*$", "")
    return F.when(target.startswith("/"), F.regexp_replace(target, "^/+", "")).otherwise(F.array_join(resolve_dots(F.concat(folder, target)), "/"))


def crawl_source_key(prefix: Column, url: Column, depth: Column, max_pages: Column, domain_lock: Column, rate_limit_ms: Column) -> Column:
    """Prefix, URL and the options that differ from their defaults."""
    return F.concat_ws(
        ":",
        prefix,
        url,
        F.when(depth != 0, F.concat(F.lit("depth="), depth.cast("string"))),
        F.when(max_pages.isNotNull(), F.concat(F.lit("max_pages="), max_pages.cast("string"))),
        F.when(~domain_lock, F.lit("domain_lock=false")),
        F.when(rate_limit_ms != 0, F.concat(F.lit("rate_limit_ms="), rate_limit_ms.cast("string"))),
    )


def source_key(kind: Column, id_: Column, path: Column, paths: Column, url: Column, branch: Column, include: Column, depth: Column, max_pages: Column, domain_lock: Column, rate_limit_ms: Column) -> Column:
    """The deterministic key of a configured source of any kind; null of an unknown kind."""
    sorted_list = lambda xs: F.array_join(F.array_sort(xs), ",")
    crawl = lambda prefix: crawl_source_key(prefix, url, depth, max_pages, domain_lock, rate_limit_ms)
    return (
        F.when(kind == "local_file", F.concat(F.lit("local_file:"), sorted_list(paths)))
        .when(kind == "web_crawl", crawl(F.lit("web_crawl")))
        .when(kind == "github_repo", F.concat(F.lit("github_repo:"), url, F.lit("@"), branch, F.lit(":"), path))
        .when(kind == "manifest_local", F.concat(F.lit("manifest_local:"), id_, F.lit(":"), path, F.lit(":"), sorted_list(include)))
        .when(kind == "manifest_url", crawl(F.concat(F.lit("manifest_url:"), id_)))
        .when(kind == "manifest_git", F.concat(F.lit("manifest_git:"), id_, F.lit(":"), url, F.lit("@"), branch))
    )


def is_web_source(key: Column) -> Column:
    return key.startswith("web_crawl:") | key.startswith("manifest_url:")


def source_url(key: Column) -> Column:
    """The URL inside a source key, without option suffixes; null if it has none."""
    url = F.regexp_extract(key, "(https?://.*)$", 1)
    bare = F.regexp_replace(url, "(?::(?:depth|max_pages|domain_lock|rate_limit_ms)=[^:]+)+$", "")
    return F.nullif(bare, F.lit(""))


def output_path(rel_path: Column, part: Column, parts: Column, has_media: Column) -> Column:
    """x.md, or x/part-NNNN.md when a document has parts or media."""
    stem = F.regexp_replace(rel_path, r"\.[^./]+$", "")
    return F.when((parts > 1) | has_media, F.format_string("%s/part-%04d.md", stem, part)).otherwise(F.concat(stem, F.lit(".md")))


def glob_regex(pattern: str) -> str:
    """A glob as an anchored regular expression: "**/" also matches nothing, "*" and "?" stay within a segment."""
    out, i = "", 0
    while i < len(pattern):
        if pattern.startswith("**/", i):
            out, i = out + "(?:.*/)?", i + 3
        elif pattern.startswith("**", i):
            out, i = out + ".*", i + 2
        elif pattern[i] == "*":
            out, i = out + "[^/]*", i + 1
        elif pattern[i] == "?":
            out, i = out + "[^/]", i + 1
        else:
            c = pattern[i]
            out, i = out + (c if c.isalnum() or c in "_/" else "\\" + c), i + 1
    return f"^{out}$"


def matches_glob(path: Column, pattern: str) -> Column:
    return path.rlike(glob_regex(pattern))
