"""Queries over web pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliary.functions import ids, urls
from foliary.operators.links import with_canonical_url
from foliary.plans.tables import Registry, table
from foliary.plans.web import drop_repeated_pages, web_documents
from foliary.sources.html import html_to_markdown, is_html, links_of

_register = Registry()
QUERIES, ORACLE_SQL = _register.queries, _register.sql

# DuckDB: canonical form of pages.url (http(s) without user, dots or encoded parameters, as the table has them).
_CANONICAL = """
 lower(regexp_extract(url, '^(https?)://', 1)) || '://' || lower(regexp_extract(url, '^https?://([^/?#]*)', 1))
 || coalesce(nullif(regexp_replace(regexp_extract(url, '^https?://[^/?#]*([^?#]*)', 1), '/+', '/', 'g'), ''), '/')
 || coalesce('?' || nullif(array_to_string(list_sort(list_filter(string_split(regexp_extract(url, '\\?([^#]*)', 1), '&'),
      lambda p: p <> '' and not regexp_matches(lower(p), '^(utm_|fbclid=|gclid=)'))), '&'), ''), '')
"""


@_register(f"select page_id, {_CANONICAL} as canonical_url from pages")
def url_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", urls.canonical_url(F.col("url")).alias("canonical_url"))


@_register(f"select min(page_id) as page_id from (select page_id, {_CANONICAL} as k from pages) group by k")
def url_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_repeated_pages(table(spark, sf_dir, "pages")).select("page_id")


@_register(r"select page_id, regexp_replace(regexp_replace(url, '#.*$', ''), '^(https?://[^/?#]*)(\?|$)', '\1/\2') as normalized from pages")
def url_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", urls.normalize_url(F.col("url")).alias("normalized"))


@_register(r"""
with p as (select page_id, coalesce(nullif(regexp_extract(url, '^https?://[^/?#]*([^?#]*)', 1), ''), '/') as path from pages)
select page_id, case when replace(path, '/', '') = '' then null when path like '%/' then path
   when regexp_extract(path, '([^/]*)$', 1) like '%.%' then nullif(regexp_replace(path, '/[^/]*$', ''), '') || '/' end as scope,
   true as inside_own
from p
""")
def url_scope(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = F.col("url")
    scope = urls.section_scope(u)
    return table(spark, sf_dir, "pages").select("page_id", scope.alias("scope"), F.coalesce(urls.within_scope(u, scope), F.lit(True)).alias("inside_own"))


@_register(r"""
select page_id, lower(regexp_extract(regexp_replace(regexp_extract(url, '^https?://[^/?#]*([^?#]*)', 1), '/+$', ''), '([^/]*)$', 1)) in ('print', 'print.html', 'print.htm')
   or lower(regexp_extract(url, '\?([^#]*)', 1)) like '%print%'
   or (lower(html) like '%window.print%' and lower(html) like '%noindex%') as print_page
from pages
""")
def url_print(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", urls.is_print_page(F.col("url"), F.col("html")).alias("print_page"))


@_register(r"""
with v as (select page_id, url as u from pages union all select page_id, replace(url, 'https:', 'ftp:') from pages union all
           select page_id, 'http://10.1.2.' || (page_id % 200) || '/x' from pages union all select page_id, 'https://localhost:8080/' from pages)
select page_id, u as url, case when not regexp_matches(u, '^https?:') then 'scheme' when regexp_matches(u, '^https?://(10\.|localhost)') then 'private' else 'ok' end as verdict from v
""")
def url_policy(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = F.col("url")
    variants = F.array(u, F.replace(u, F.lit("https:"), F.lit("ftp:")), F.concat(F.lit("http://10.1.2."), (F.col("page_id") % 200).cast("string"), F.lit("/x")), F.lit("https://localhost:8080/"))
    rows = table(spark, sf_dir, "pages").select("page_id", F.explode(variants).alias("url"))
    return rows.select("page_id", "url", urls.url_verdict(F.col("url")).alias("verdict"))


@_register(r"""
with v as (select page_id, unnest([1, 2, 3, 4]) as kind, url from pages)
select page_id, kind, case kind when 1 then regexp_replace(url, '[?#].*$', '') || '?a=1'
  when 2 then '<local-path-redacted>' when 3 then '<local-path-redacted>' else 'notes/' || page_id || '.md' end as shown from v
""")
def url_sanitize(spark: SparkSession, sf_dir: str) -> DataFrame:
    bare = F.regexp_replace("url", "[?#].*$", "")
    secret = F.concat(F.regexp_replace(bare, "^(https?://)", "$1me:pw@"), F.lit("?token=x&a=1&API_KEY=y#top"))
    kinds = [secret, F.concat(F.lit("file:///tmp/"), F.col("page_id")), F.concat(F.lit("C:\\data\\"), F.col("page_id")), F.concat(F.lit("notes/"), F.col("page_id"), F.lit(".md"))]
    rows = table(spark, sf_dir, "pages").select("page_id", F.posexplode(F.array(*kinds)).alias("k", "raw"))
    return rows.select("page_id", (F.col("k") + 1).alias("kind"), urls.sanitize_source(F.col("raw")).alias("shown"))


@_register(r"""
select page_id, 'web_crawl:' || url || case when page_id % 3 <> 0 then ':depth=' || (page_id % 3) else '' end || case when page_id % 5 = 0 then ':max_pages=' || page_id else '' end
  || case when page_id % 2 = 0 then ':domain_lock=false' else '' end || case when page_id % 4 <> 0 then ':rate_limit_ms=' || (page_id % 4) else '' end as source_key,
  'local_file:a.md,b-' || page_id || '.md' as local_key, url as source_url
from pages
""")
def source_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = F.col("page_id")
    none, text = F.lit(None), F.lit(None).cast("string")
    options = ((p % 3).cast("int"), F.when(p % 5 == 0, p), p % 2 != 0, (p % 4).cast("int"))
    key = ids.source_key(F.lit("web_crawl"), text, text, none.cast("array<string>"), F.col("url"), text, none.cast("array<string>"), *options)
    local = ids.source_key(F.lit("local_file"), text, text, F.array(F.concat(F.lit("b-"), p, F.lit(".md")), F.lit("a.md")), text, text, none.cast("array<string>"), *options)
    return table(spark, sf_dir, "pages").select("page_id", key.alias("source_key"), local.alias("local_key"), ids.source_url(key).alias("source_url"))


@_register(r"""
with l as (select page_id, unnest(regexp_extract_all(html, '<a [^>]*href="([^"]*)"', 1)) as href, generate_subscripts(regexp_extract_all(html, '<a [^>]*href="([^"]*)"', 1), 1) as i, url from pages),
a as (select page_id, i, regexp_replace(regexp_replace(case when href like 'http%' then href when href like '/%' then regexp_extract(url, '^(https?://[^/?#]*)', 1) || href end, '#.*$', ''), '^(https?://[^/?#]*)$', '\1/') as link
      from l where not regexp_matches(href, '^(#|mailto:|javascript:|data:|tel:)'))
select page_id, count(distinct link) as n_links from a where link is not null group by page_id
""")
def page_link_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "pages").select("page_id", F.size(links_of("html", "url")).cast("bigint").alias("n_links"))
    return rows.where("n_links > 0")


@_register(r"""
with l as (select page_id, url, unnest(regexp_extract_all(html, '<a [^>]*href="([^"]*)"', 1)) as href from pages),
a as (select distinct page_id, regexp_replace(regexp_replace(case when href like 'http%' then href when href like '/%' then regexp_extract(url, '^(https?://[^/?#]*)', 1) || href end, '#.*$', ''), '^(https?://[^/?#]*)$', '\1/') as link
      from l where not regexp_matches(href, '^(#|mailto:|javascript:|data:|tel:)'))
select link, count(*) as inlinks from a where link is not null group by link
""")
def link_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    edges = table(spark, sf_dir, "pages").select("page_id", F.explode(links_of("html", "url")).alias("link"))
    return edges.groupBy("link").agg(F.count("*").alias("inlinks"))


@_register("select page_id, nullif(regexp_extract(html, '<title>([^<]*)</title>', 1), '') as title, lower(html) like '%<html%' as is_html from pages")
def html_title(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = F.col("html")
    return table(spark, sf_dir, "pages").select("page_id", F.nullif(F.regexp_extract(h, "<title>([^<]*)</title>", 1), F.lit("")).alias("title"), is_html(F.lit(None).cast("string"), h).alias("is_html"))


# Pages as the table has them: a note and an advertisement before an article of a heading and text whose paragraphs stay open.
_WS = "chr(32) || chr(9) || chr(10) || chr(13)"
_PLAIN = "replace(replace(replace(replace(replace({}, '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&#x27;', chr(39)), '&amp;', '&')"
_STRINGS = "array_to_string(list_filter(list_transform(regexp_split_to_array(regexp_extract(html, '(?s){}', 1), '<[^>]*>'), lambda s: trim(" + _PLAIN.format("s") + f", {_WS})), lambda s: s <> ''), ' ')"
_MARKDOWN = f"""
with parts as (select page_id, url, {_PLAIN.format("trim(regexp_extract(html, '(?s)<!-- (.*?) -->', 1))")} as note, {_STRINGS.format('<div class="ad">(.*?)</div>')} as ad, {_STRINGS.format("<h1>(.*?)</h1>")} as h1, {_STRINGS.format("</h1>(.*)</article>")} as said from pages),
shown as (select *, concat_ws(chr(10) || chr(10), nullif(note, ''), nullif(ad, '')) as above, concat_ws(chr(10) || chr(10), nullif('# ' || h1, '# '), nullif(said, '')) as below from parts)
"""


@_register(_MARKDOWN + "select page_id, concat_ws(chr(10) || chr(10), nullif(above, ''), nullif(below, '')) as markdown from shown")
def html_markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", html_to_markdown("html").alias("markdown"))


@_register(_MARKDOWN + f"""
, d as (select page_id, {_CANONICAL} as canonical_url, regexp_extract(h1, '^([^' || chr(10) || ']*?)\\s*(?:' || chr(10) || '|$)', 1) as title,
  concat_ws(chr(10) || chr(10), nullif(above, ''), '<a id="chunk-0001"></a>' || chr(10) || below) || chr(10) as body from shown)
select page_id, canonical_url, title, body, sha256(body) as content_sha256, substr(sha256(substr(sha256('web_crawl:pages'), 1, 16) || ':' || canonical_url || ':' || page_id), 1, 16) as document_id, 1 as chunks, 'skipped' as heading_verdict from d
""")
def web_documents_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return web_documents(table(spark, sf_dir, "pages"))


QUERIES["web_documents"] = QUERIES.pop("web_documents_query")
ORACLE_SQL["web_documents"] = ORACLE_SQL.pop("web_documents_query")


@_register(r"""
with v as (select page_id, unnest(['URL', 'URL', 'FILE', 'FILE', 'TRANSCRIPT']) as kind, unnest([url, url || '/wiki/x', 'docs/adr/1.md', 'docs/a.md', 'talk.vtt']) as raw from pages)
select page_id, kind, raw, case kind when 'TRANSCRIPT' then 'transcript' when 'URL' then case when raw like '%/wiki/%' then 'wiki' else 'web' end else case when raw like '%/adr/%' then 'adr' else 'wiki' end end as doc_type,
  case when raw like 'http%' then 'URL' when raw like '%.vtt' then 'TRANSCRIPT' else 'FILE' end as classified from v
""")
def doc_type_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    from foliary.functions.routing import classify_source, document_type

    u = F.col("url")
    named = [("URL", u), ("URL", F.concat(u, F.lit("/wiki/x"))), ("FILE", F.lit("docs/adr/1.md")), ("FILE", F.lit("docs/a.md")), ("TRANSCRIPT", F.lit("talk.vtt"))]
    rows = table(spark, sf_dir, "pages").select("page_id", F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), r.alias("raw")) for k, r in named])).alias("x")).select("page_id", "x.*")
    return rows.select("page_id", "kind", "raw", document_type(F.col("kind"), F.col("raw")).alias("doc_type"), classify_source(F.col("raw"), F.lit("")).alias("classified"))


@_register(r"""
with p as (select page_id, 'docs/' || case page_id % 3 when 0 then 'a/' when 1 then 'a/b/' else '' end || 'Page' || page_id || case when page_id % 7 = 0 then '/index.md' else '.md' end as rel_path from pages),
s as (select * from (values (0, 'docs', '/base'), (1, 'docs/a', '/Prod/A'), (2, 'docs/a/b', cast(null as varchar)), (3, 'other', '/x')) as s(docset_idx, folder, prefix)),
m as (select page_id, rel_path, folder, prefix, row_number() over (partition by page_id order by length(folder) desc, docset_idx) as rn from p join s on rel_path = folder or starts_with(rel_path, folder || '/')),
b as (select page_id, rel_path, prefix, regexp_replace(substr(rel_path, length(folder) + 2), '\.md$', '') as rel from m where rn = 1)
select page_id, rel_path, case when prefix is null then null else lower(prefix || '/' || regexp_replace(rel, '/index$', '')) end as canonical_url from b
""")
def docset_longest_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = F.col("page_id")
    folder = F.when(p % 3 == 0, "a/").when(p % 3 == 1, "a/b/").otherwise("")
    rel = F.concat(F.lit("docs/"), folder, F.lit("Page"), p.cast("string"), F.when(p % 7 == 0, "/index.md").otherwise(".md"))
    docsets = spark.createDataFrame([(0, "docs", "/base"), (1, "docs/a/", "Prod/A"), (2, "docs/a/b", None), (3, "other", "/x")], "docset_idx int, folder string, url_prefix string")
    return with_canonical_url(table(spark, sf_dir, "pages").select("page_id", rel.alias("rel_path")), docsets).select("page_id", "rel_path", "canonical_url")


@_register(r"""
select page_id, regexp_replace(regexp_replace(url, '[^A-Za-z0-9._-]+', '-', 'g'), '^-+|-+$', '', 'g') as slug,
  substr(sha256(url), 1, 16) as job_id, 'stage/' || substr(sha256(url), 1, 2) || '/' || substr(sha256(url), 1, 16) as cache_path, least(power(2, page_id % 9), 60.0) as backoff from pages
""")
def staging_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    job = ids.job_id(F.col("url"))
    return table(spark, sf_dir, "pages").select("page_id", ids.slug(F.col("url")).alias("slug"), job.alias("job_id"), ids.cache_path("stage", job).alias("cache_path"), urls.backoff_seconds((F.col("page_id") % 9).cast("double")).alias("backoff"))


@_register(r"""
with p as (select page_id, url, regexp_extract(url, '^https?://[^/?#]*([^?#]*)', 1) as path, regexp_extract(url, '\?([^#]*)', 1) as q from pages),
s as (select *, trim(path, '/') as t from p), n as (select *, case when t = '' then 'index.html' when regexp_extract(t, '([^/]*)$', 1) like '%.%' then t else t || '/index.html' end as base from s)
select page_id, case when regexp_matches(base, '\.html?$') then '' else '.html' end is not null as named, case when q <> '' then regexp_replace(base, '\.html$', '') || '--' || substr(sha256(url), 1, 10) || '.html' else base end as staged
from n where regexp_matches(base, '\.html$') and regexp_matches(base, '^[A-Za-z0-9._/-]+$')
""")
def staged_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = F.col("url")
    rows = table(spark, sf_dir, "pages").select("page_id", F.lit(True).alias("named"), urls.staged_path(u, F.lit("")).alias("staged"))
    return rows.where(F.col("staged").rlike(r"^[A-Za-z0-9._/-]+\.html$"))
