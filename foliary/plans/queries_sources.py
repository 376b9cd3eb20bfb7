"""Queries over configuration, listings and engine answers that are made of table columns inside the query."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliary.functions import ids, routing, scores, text, urls
from foliary.operators import manifests, ranges
from foliary.plans.tables import Registry, table
from foliary.sources import files, sinks

_register = Registry()
QUERIES, ORACLE_SQL = _register.queries, _register.sql


@_register("""
select page_id, case when page_id % 3 = 0 then url || '?final' end as final_url, case when page_id % 3 = 0 then cast(page_id % 5 as int) else -1 end as crawl_depth from pages
""")
def page_sidecars(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = F.col("page_id")
    rows = table(spark, sf_dir, "pages").select("page_id", "url", F.lit("job").alias("job_id"), F.concat(F.lit("a/p"), p.cast("string"), F.lit(".html")).alias("relative_path"))
    told = rows.where("page_id % 3 < 2").select("job_id", F.concat(F.lit("a/p"), p.cast("string"), F.lit(".meta.json")).alias("relative_path"), F.when(p % 3 == 0, F.to_json(F.struct(F.concat("url", F.lit("?final")).alias("final_url"), (p % 5).cast("int").alias("crawl_depth")))).otherwise("not json").alias("content"))
    return manifests.with_sidecars(rows, told).select("page_id", F.col("page.final_url").alias("final_url"), F.coalesce("page.crawl_depth", F.lit(-1)).alias("crawl_depth"))


@_register("""
with d as (select n_nationkey as k, n_name as name from nation)
select cast(k as bigint) as docset, 'docs/' || lower(name) as folder, case when k % 3 = 0 then '/given/' || k when k % 3 = 1 then '/azure/' || k end as url_prefix from d
""")
def publish_docsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("k"), F.concat(F.lit("docs/"), F.lower("n_name")).alias("folder"))
    one = F.struct(F.lit("d").alias("docset_name"), F.col("folder").alias("build_source_folder"), F.when(F.col("k") % 3 == 0, F.concat(F.lit("/given/"), F.col("k").cast("string"))).alias("url_path_prefix"))
    publish = n.agg(F.to_json(F.struct(F.transform(F.array_sort(F.collect_list(F.struct("k", one.alias("d")))), lambda x: x["d"]).alias("docsets_to_publish"))).alias("content"))
    crumb = F.concat(F.lit('{"build":{"globalMetadata":{"breadcrumb_path":"/azure/'), F.col("k").cast("string"), F.lit('/breadcrumb/toc.json"}}}'))
    docfx = n.where("k % 3 = 1").select(F.concat("folder", F.lit("/docfx.json")).alias("relative_path"), crumb.alias("content"))
    return files.docsets(publish, docfx).select(F.col("docset_idx").cast("bigint").alias("docset"), "folder", "url_prefix")


@_register("""
select 'docs/TOC' || doc_id || '.yml' as toc, unnest([0, 1]) as seq, unnest(['docs/d' || doc_id || '.md', 'e.md']) as target_path, unnest([0, 1]) as depth from documents
""")
def toc_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.col("doc_id").cast("string")
    yml = F.concat(F.lit("- name: A\n  href: d"), d, F.lit(".md\n- name: G\n  items:\n  - {name: B, href: ../e.md}\n  - {name: C, href: 'https://x/'}\n"))
    tocs = table(spark, sf_dir, "documents").select(F.concat(F.lit("docs/TOC"), d, F.lit(".yml")).alias("relative_path"), yml.alias("content"))
    return files.read_tocs(tocs).select("toc", "seq", "target_path", "depth")


@_register("select 'r/' || source || '/d' || doc_id || '.md' as path from documents where doc_id % 3 = 0")
def repository_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.col("doc_id")
    entry = F.struct(F.concat(F.lit("r/"), "source", F.lit("/d"), d.cast("string"), F.when(d % 3 == 1, ".py").otherwise(".md")).alias("path"), F.when(d % 3 == 2, "tree").otherwise("blob").alias("type"))
    tree = table(spark, sf_dir, "documents").select(F.to_json(F.struct(F.array(entry).alias("tree"))).alias("tree"))
    return files.repository_files(tree, "**/*.md")


@_register("""
with f as (select doc_id, unnest(['a/' || doc_id || '.PDF', 'b.docx', 'c.htm', 'd.md', 'e.yml', 'f.png']) as path, unnest(['pdf', 'docx', 'html', 'markdown', 'openapi', null]) as reader from documents)
select doc_id, path, reader, case when doc_id % 4 = 0 and doc_id % 8 <> 0 then 'wiki' when doc_id % 4 = 0 then 'adr' else 'wiki' end as doc_type from f
""")
def reader_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.col("doc_id")
    names = [F.concat(F.lit("a/"), d.cast("string"), F.lit(".PDF")), *[F.lit(x) for x in ("b.docx", "c.htm", "d.md", "e.yml", "f.png")]]
    rows = table(spark, sf_dir, "documents").select("doc_id", F.explode(F.array(*names)).alias("path"))
    kind = F.when(d % 4 == 0, "adr").otherwise("wiki")
    return rows.select("doc_id", "path", routing.reader_for(F.col("path")).alias("reader"), routing.valid_type(kind, F.when(d % 8 == 0, "Accepted").otherwise("odd")).alias("doc_type"))


@_register("select doc_id, 'D' || doc_id || ' Of ' || upper(lang[1]) || lang[2:] as title, case when doc_id % 7 = 0 then true else false end as placeholder from documents")
def title_derivation(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.col("doc_id")
    path = F.concat(F.lit("x/d"), d.cast("string"), F.lit("-of_"), F.col("lang"), F.lit(".md"))
    named = F.when(d % 7 == 0, F.element_at(F.array(F.lit("index"), F.lit(""), F.lit("Page 3")), (d % 3 + 1).cast("int"))).otherwise("Real name")
    return table(spark, sf_dir, "documents").select("doc_id", text.title_from_stem(path).alias("title"), scores.placeholder_title(named).alias("placeholder"))


@_register("select doc_id, 'figure-' || printf('%04d', row_number() over (partition by source order by doc_id)) || case lang when 'en' then '.png' when 'de' then '.jpg' else '.bin' end as media_name from documents")
def media_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    mime = F.when(F.col("lang") == "en", "image/PNG").when(F.col("lang") == "de", "image/jpeg").otherwise("x/y")
    return sinks.media_names(table(spark, sf_dir, "documents").select("doc_id", "source", mime.alias("mime")), "source", "doc_id").select("doc_id", "media_name")


@_register("""select doc_id, '{"a": {"n": ' || doc_id || '}, "keep": "' || lang || '"}' as shown, 'keep' as left_keys from documents""")
def secret_redaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.col("doc_id").cast("string")
    raw = F.concat(F.lit('{"keep": "'), "lang", F.lit('", "Password": 1, "a": {"n": '), d, F.lit(', "TOKEN": [1]}}'))
    flat = F.create_map(F.lit("keep"), F.lit("1"), F.lit("Secret"), F.lit("2"))
    return table(spark, sf_dir, "documents").select("doc_id", sinks.redact_json(raw).alias("shown"), F.array_join(F.map_keys(sinks.redact_map(flat)), ",").alias("left_keys"))


@_register("""
with p as (select source, row_number() over (partition by source order by doc_id) - 1 as i, doc_id from documents), c as (select source, i // 4 as chunk, i % 4 as position, doc_id, count(*) over (partition by source, i // 4) as size from p),
k as (select * from c where chunk = 0 or size <= 2 or position >= 2)
select doc_id, cast(row_number() over (partition by source order by chunk, position) as bigint) as page, '<!-- page ' || row_number() over (partition by source order by chunk, position) || ' -->' || chr(10) || 'p' || doc_id as marked from k
""")
def page_markers(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "documents").selectExpr("source", "doc_id", "row_number() over (partition by source order by doc_id) - 1 as i").selectExpr("source", "doc_id", "i div 4 as chunk", "i % 4 as position", "concat('p', doc_id, ' ') as text")
    return ranges.stitch_markers(pages, 2, "source").select("doc_id", F.col("page").cast("bigint").alias("page"), "marked")


@_register("select doc_id, case when doc_id % 3 = 0 then 't' || doc_id when doc_id % 3 = 1 then 'plain ' || doc_id else '{\"text\": 1}' end as text, cast(case when doc_id % 3 = 0 then 2 else 1 end as int) as n_pages from documents")
def engine_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.col("doc_id")
    raw = F.when(d % 3 == 0, F.concat(F.lit('{"text": "t'), d.cast("string"), F.lit('", "pages": ["a", "b"]}'))).when(d % 3 == 1, F.concat(F.lit("plain "), d.cast("string"))).otherwise('{"text": 1}')
    rows = table(spark, sf_dir, "documents").select("doc_id", scores.engine_envelope(raw).alias("e"))
    return rows.select("doc_id", F.col("e.text").alias("text"), F.size("e.pages").alias("n_pages"))


@_register("""
with r as (select doc_id, unnest(['auto', 'layout', 'magic']) as requested from documents)
select doc_id, requested, case requested when 'layout' then 'layout' when 'auto' then case when doc_id % 4 = 0 then 'heuristic' when doc_id % 3 = 0 then 'heuristic' else 'layout' end end as engine,
 case requested when 'layout' then 'explicit_request' when 'auto' then case when doc_id % 4 = 0 then 'engine_unavailable' when doc_id % 3 = 0 then 'file_too_large' else 'ok' end end as reason from r
""")
def engine_policy(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.col("doc_id")
    rows = table(spark, sf_dir, "documents").select("doc_id", F.explode(F.array(F.lit("auto"), F.lit("layout"), F.lit("magic"))).alias("requested"))
    choice = scores.engine_choice(F.col("requested"), d % 4 != 0, F.when(d % 3 == 0, "file_too_large").otherwise("ok"))
    return rows.select("doc_id", "requested", choice["engine"].alias("engine"), choice["reason"].alias("reason"))


@_register("select event_id, cast(case when event_id % 7 = 0 then 100 when event_id % 5 >= event_id % 7 then 100 else round_even((event_id % 5) * 100.0 / (event_id % 7), 0) end as int) as pct, 'a b c' as shown from events")
def progress_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.col("event_id")
    return table(spark, sf_dir, "events").select("event_id", text.percent_done(e % 5, e % 7).alias("pct"), text.printable(F.lit("a\tb\x00c")).alias("shown"))


@_register("""
with recursive v as (select user_id, list_sort(list(cast(event_id % 97 as double))) as xs from events group by user_id),
g as (select user_id, xs, 2 as i, xs[1] as head, 1 as n from v union all select user_id, xs, i + 1, case when xs[i] - head > 10 then xs[i] else head end, n + case when xs[i] - head > 10 then 1 else 0 end from g where i <= len(xs))
select user_id, max(n) as clusters from g group by user_id
""")
def x_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").groupBy("user_id").agg(F.collect_list((F.col("event_id") % 97).cast("double")).alias("xs"))
    return rows.select("user_id", scores.x_clusters(F.col("xs")).alias("clusters"))


@_register("select page_id, 'web_crawl:' || url as source, regexp_matches(url, '^https?:') as is_web, case when page_id % 6 <= 5 then true else false end as may_redirect from pages")
def web_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.concat(F.lit("web_crawl:"), F.col("url"))
    return table(spark, sf_dir, "pages").select("page_id", key.alias("source"), ids.is_web_source(key).alias("is_web"), urls.redirects_allowed(F.col("page_id") % 6).alias("may_redirect"))
