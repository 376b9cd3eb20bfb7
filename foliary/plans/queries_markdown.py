"""Queries over Markdown that is derived from documents inside the query, and over inline DocFx and OpenAPI texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliary.functions import text
from foliary.operators import links
from foliary.plans.tables import Registry, table

_register = Registry()
QUERIES, ORACLE_SQL = _register.queries, _register.sql

# The same expression in Spark and DuckDB: a body with headings, links, an image and a fence, over the whole text.
_MD = """
concat('# Doc ', cast(doc_id as string), chr(10), chr(10), replace(text, '. ', concat('.', chr(10), chr(10), case when doc_id % 3 = 0 then '### ' when doc_id % 3 = 1 then '## ' else '#### ' end,
 'Part [see](../', source, '/d', cast(doc_id % 50 as string), '.md#a)', chr(10))), chr(10), '![x](media/a.png) [ext](https://e.com/x.md) [abs](/prod/', lang, ') [q](#top) [m](../media/z.md)', chr(10),
 '```', chr(10), '## not a heading', chr(10), '```', chr(10), '## End', chr(10))
"""
_LINES = f"""
with md as (select doc_id, source, lang, {_MD} as body from documents), sp as (select *, string_split(body, chr(10)) as ls from md),
ln as (select doc_id, unnest(ls) as l, unnest(range(len(ls))) as pos from sp),
fe as (select *, sum(case when regexp_matches(l, '^(```|~~~)') then 1 else 0 end) over (partition by doc_id order by pos) as f from ln)
"""


def _bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.concat(F.lit("docs/"), F.col("source"), F.lit("/d"), F.col("doc_id").cast("string"), F.lit(".md")).alias("rel_path"), F.expr(_MD).alias("body"))


@_register(_LINES + r"select doc_id, count(*) filter (regexp_matches(l, '^#{1,3}\s+\S') and f % 2 = 0) as chunks from fe group by doc_id")
def chunk_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    anchored = _bodies(spark, sf_dir).select("doc_id", text.chunk_anchors(F.col("body")).alias("body"))
    return anchored.select("doc_id", F.size(F.regexp_extract_all("body", F.lit(r'<a id="chunk-(\d+)"></a>'), F.lit(1))).cast("bigint").alias("chunks"))


@_register(_LINES + r"""
, h as (select doc_id, pos, length(regexp_extract(l, '^(#{1,6})\s', 1)) as lv, row_number() over (partition by doc_id order by pos) as i from ln where regexp_matches(l, '^#{1,6}\s+.')),
s as (select *, lv - min(lv) over (partition by doc_id) + 1 as sl from h)
select doc_id, i as nth, cast(i + least(0, min(sl - i) over (partition by doc_id order by i)) as int) as level from s
""")
def heading_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _bodies(spark, sf_dir).select("doc_id", text.normalize_headings(F.col("body")).alias("body"))
    found = rows.select("doc_id", F.posexplode(text.headings(F.col("body"))).alias("i", "h"))
    return found.select("doc_id", (F.col("i") + 1).cast("bigint").alias("nth"), F.col("h.level").alias("level"))


_FIRST = _LINES + r"""
, k as (select doc_id, min(pos) filter (regexp_matches(l, '^# [^\n]+$') and f % 2 = 0) as h1, min(pos) filter (regexp_matches(l, '^## [^\n]+$') and f % 2 = 0) as h2,
  min(pos) filter (regexp_matches(l, '^### [^\n]+$') and f % 2 = 0) as h3, bool_or(regexp_matches(l, '^#{4,6}\s+.')) as deep, bool_or(regexp_matches(l, '^## Decision\s*$')) as decided from fe group by doc_id)
"""


@_register(_FIRST + "select doc_id, case when h1 is null or h2 is null or coalesce(h3 < h2, false) then 'skipped' when h2 < h1 or coalesce(h3 < h1, false) then 'fail' else 'pass' end as verdict from k")
def heading_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bodies(spark, sf_dir).select("doc_id", text.heading_verdict(F.col("body")).alias("verdict"))


@_register(_FIRST + "select doc_id, concat_ws('; ', case when deep then 'Heading depth exceeded schema limits' end, case when not decided then 'Missing required section: Decision' end) as errors from k")
def ast_lint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bodies(spark, sf_dir).select("doc_id", F.array_join(text.lint(F.col("body"), F.lit("adr")), "; ").alias("errors"))


@_register(_FIRST + "select case when h1 is null or h2 is null or coalesce(h3 < h2, false) then 'skipped' when h2 < h1 then 'fail' else 'pass' end as verdict, deep, count(*) as n from k group by all")
def seam_lint(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _bodies(spark, sf_dir)
    b = F.col("body")
    return rows.groupBy(text.heading_verdict(b).alias("verdict"), (F.size(text.lint(b, F.lit("wiki"))) > 0).alias("deep")).agg(F.count("*").alias("n"))


_EDGES = f"""
with md as (select doc_id, source, {_MD} as body from documents), m as (select doc_id, source, unnest(regexp_extract_all(regexp_replace(body, '!\\[[^\\]]*\\]\\([^)]+\\)', '', 'g'), '\\[[^\\]]*\\]\\([^)]+\\)')) as whole,
  unnest(range(len(regexp_extract_all(regexp_replace(body, '!\\[[^\\]]*\\]\\([^)]+\\)', '', 'g'), '\\[[^\\]]*\\]\\([^)]+\\)')))) as pos from md),
h as (select *, regexp_extract(whole, '\\(([^)]+)\\)', 1) as href, regexp_extract(whole, '^\\[([^\\]]*)', 1) as link_text from m),
e as (select 'docs/' || source || '/d' || doc_id || '.md' as src_path, pos, case when href like '/%' then split_part(href, '#', 1) else 'docs/' || regexp_replace(split_part(href, '#', 1), '^\\.\\./', '') end as target_path,
  case when href like '%#%' then regexp_replace(href, '^[^#]*#', '') end as anchor, link_text, href like '/%' as cross_product from h
  where not regexp_matches(href, '^[A-Za-z][A-Za-z0-9+.-]*:') and href not like '#%' and not regexp_matches(href, '(^|/)media/') and (href like '/%' or split_part(href, '#', 1) like '%.md'))
"""


@_register(_EDGES + "select src_path, target_path, anchor, link_text, cross_product, count(*) as n from e group by all")
def cross_doc_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return links.edge_table(_bodies(spark, sf_dir)).groupBy("src_path", "target_path", "anchor", "link_text", "cross_product").agg(F.count("*").alias("n"))


@_register(_EDGES + "select src_path, target_path, anchor, link_text from (select *, row_number() over (partition by src_path, target_path, anchor order by pos) as rn from e) where rn = 1")
def first_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return links.first_links(links.edge_table(_bodies(spark, sf_dir)), "src_path", "position").select("src_path", "target_path", "anchor", "link_text")


@_register(_EDGES + ", d as (select distinct 'docs/' || source || '/d' || doc_id || '.md' as p from documents) select e.target_path, count(*) as n from e left join d on d.p = e.target_path where d.p is null group by 1")
def dangling_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    bodies = _bodies(spark, sf_dir)
    edges = links.resolved_edges(links.edge_table(bodies), bodies)
    return edges.where("not resolved").groupBy("target_path").agg(F.count("*").alias("n"))


_TABS = "concat('# T', chr(10), '### [Lin ux](#tab/lin)', chr(10), replace(text, '. ', concat('.', chr(10))), chr(10), '## [Win](#TAB/w)', chr(10), 'x', chr(10), '---', chr(10), '---', chr(10), '## Next', chr(10), '---', chr(10))"


@_register(f"""
with t as (select doc_id, replace(replace({_TABS}, '### [Lin ux](#tab/lin)', '### Lin ux'), '## [Win](#TAB/w)', '## Win') as b from documents)
select doc_id, sha256(replace(b, chr(10) || 'x' || chr(10) || '---' || chr(10) || '---', chr(10) || 'x' || chr(10) || '---')) as tabs_sha256 from t
""")
def docfx_tabs(spark: SparkSession, sf_dir: str) -> DataFrame:
    body = links.docfx_tabs(F.expr(_TABS))
    return table(spark, sf_dir, "documents").select("doc_id", F.sha2(F.encode(body, "UTF-8"), 256).alias("tabs_sha256"))


_BOXES = "concat('a', chr(10), ':::moniker range=\"x\"', chr(10), text, chr(10), ':::moniker-end:::', chr(10), ':::image type=\"content\" source=\"media/', lang, '.png\" alt-text=\"An ', lang, '\":::', chr(10), 'z')"


@_register(f"""
with t as (select doc_id, lang, trim(text, chr(10)) as body from documents)
select doc_id, sha256('a' || chr(10) || body || chr(10) || '![An ' || lang || '](media/' || lang || '.png)' || chr(10) || 'z') as boxes_sha256 from t
""")
def docfx_moniker(spark: SparkSession, sf_dir: str) -> DataFrame:
    body = links.docfx_containers(F.expr(_BOXES))
    return table(spark, sf_dir, "documents").select("doc_id", F.sha2(F.encode(body, "UTF-8"), 256).alias("boxes_sha256"))


@_register(r"""
with d as (select doc_id, 'docs/d' || doc_id || '.md' as rel_path, doc_id % 4 as k from documents)
select rel_path, case k when 0 then 'A one B' when 1 then 'A <!-- missing include: inc/none.md --> B' when 2 then 'A start <!-- include cycle: loop.md --> end B' else 'A two one two B' end as body,
 cast(case k when 0 then 1 when 1 then 0 when 2 then 1 else 2 end as bigint) as resolved, cast(case k when 1 then 1 else 0 end as bigint) as missing, cast(case k when 2 then 1 else 0 end as bigint) as cycles from d
""")
def include_expand(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.element_at(F.array(*[F.lit(x) for x in ("inc/one.md", "inc/none.md", "inc/loop.md", "inc/two.md")]), (F.col("doc_id") % 4 + 1).cast("int"))
    docs = table(spark, sf_dir, "documents").select(F.concat(F.lit("docs/d"), F.col("doc_id").cast("string"), F.lit(".md")).alias("rel_path"), F.concat(F.lit("A [!INCLUDE [n]("), name, F.lit(")] B")).alias("body"))
    files = spark.createDataFrame([("docs/inc/one.md", "one\n"), ("docs/inc/two.md", "two [!INCLUDE [x](one.md)] two\n"), ("docs/inc/loop.md", "start [!INCLUDE [x](loop.md)] end")], "rel_path string, content string")
    return links.expand_includes(docs, files).select("rel_path", "body", "resolved", "missing", "cycles")


@_register(_LINES + r"""
, a as (select doc_id, count(*) filter (f % 2 = 0 and regexp_matches(l, '^#{1,6}\s+.')) as headings, max(case when f % 2 = 0 and regexp_matches(l, '^#{1,6}\s+.') then length(regexp_extract(l, '^(#+)', 1)) else 0 end) as deepest from fe group by doc_id)
select a.doc_id, a.headings, cast(a.deepest as int) as deepest, length(body) as chars from a join md using (doc_id)
""")
def section_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    from foliary.sources.markdown import quality_metrics

    rows = _bodies(spark, sf_dir).select("doc_id", quality_metrics("body").alias("q"))
    return rows.select("doc_id", F.col("q.heading_count").cast("bigint").alias("headings"), F.col("q.heading_depth_max").alias("deepest"), F.col("q.char_len").cast("bigint").alias("chars"))


_FRONT = "concat('---', chr(10), 'title: \"Doc ', cast(doc_id as string), '\"', chr(10), 'lang: ', lang, chr(10), case when doc_id % 5 = 0 then 'bad: [unclosed' else 'n: 1' end, chr(10), '---', chr(10), text)"


@_register(f"select doc_id, 'Doc ' || doc_id as title, lang, sha256(text) as body_sha256 from documents")
def frontmatter_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    from foliary.sources.markdown import split_frontmatter

    rows = table(spark, sf_dir, "documents").select("doc_id", split_frontmatter(F.expr(_FRONT)).alias("f"))
    return rows.select("doc_id", F.col("f.fields")["title"].alias("title"), F.col("f.fields")["lang"].alias("lang"), F.sha2(F.encode("f.body", "UTF-8"), 256).alias("body_sha256"))


@_register("""
with b as (select doc_id, lang, case when text = '' or text like '%' || chr(10) then text else text || chr(10) end as body from documents)
select doc_id, sha256('---' || chr(10) || 'content_sha256: "' || sha256(body) || '"' || chr(10) || 'lang: "' || lang || '"' || chr(10) || 'title: "Doc ' || doc_id || '"' || chr(10) || '---' || chr(10) || body) as document_sha256 from b
""")
def frontmatter_yaml(spark: SparkSession, sf_dir: str) -> DataFrame:
    from foliary.sources.markdown import assemble

    whole = assemble({"title": F.concat(F.lit("Doc "), F.col("doc_id").cast("string")), "lang": F.col("lang")}, F.col("text"))
    return table(spark, sf_dir, "documents").select("doc_id", F.sha2(F.encode(whole, "UTF-8"), 256).alias("document_sha256"))


_SPEC = """concat('openapi: 3.0.1\npaths:\n  /items/{id}:\n    get:\n      operationId: get', cast(doc_id as string), '\n      summary: Item ', lang, '\n      responses:\n        "200":\n          description: ok\ncomponents:\n  schemas:\n    Item:\n      type: object\n')"""


@_register("select 'specs/' || doc_id || '.yaml' as spec_path, unnest(['operations/get' || doc_id || '.md', 'schemas/Item.md']) as relative_path, unnest(['Item ' || lang, 'Item']) as title, unnest(['openapi_operation', 'openapi_schema']) as doc_type from documents")
def openapi_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    from foliary.sources.openapi import read_specs

    specs = table(spark, sf_dir, "documents").select(F.concat(F.lit("specs/"), F.col("doc_id").cast("string"), F.lit(".yaml")).alias("path"), F.expr(_SPEC.replace("\n", "\\n")).alias("text"))
    return read_specs(specs).select("spec_path", "relative_path", "title", "doc_type")


@_register(f"select doc_id, length(body) - length(replace(body, chr(10), '')) as line_ends, 'Doc ' || doc_id as section_title from (select doc_id, {_MD} as body from documents)")
def section_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = F.col("body")
    shifted = text.shift_headings(b, 1)
    return _bodies(spark, sf_dir).select("doc_id", (F.length(shifted) - F.length(F.replace(shifted, F.lit("\n"), F.lit("")))).cast("bigint").alias("line_ends"), text.section_title(b).alias("section_title"))
