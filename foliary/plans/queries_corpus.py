"""Queries over documents as a corpus: identity, quality signals, ranges, manifests, statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foliary.functions import ids, scores, text
from foliary.operators import corpus, manifests, ranges
from foliary.plans.tables import Registry, table

_register = Registry()
QUERIES, ORACLE_SQL = _register.queries, _register.sql


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


# --- identity and duplicates ---------------------------------------------------------------


@_register("select doc_id, sha256(text) as content_sha256 from documents")
def doc_content_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _docs(spark, sf_dir).select("doc_id", ids.content_sha256(F.col("text")).alias("content_sha256"))


@_register("select min(doc_id) as doc_id from documents group by sha256(text)")
def doc_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.drop_exact_duplicates(_docs(spark, sf_dir)).select("doc_id")


@_register("select sha256(text) as content_sha256, count(*) as n, min(doc_id) as keep from documents group by 1 having count(*) > 1")
def dup_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.exact_duplicates(_docs(spark, sf_dir)).where("n > 1")


@_register("""
with j as (select doc_id, substr(sha256('local:' || source), 1, 16) as job_id, 'docs/' || doc_id || '.md' as p, sha1(unhex('6ba7b8119dad11d180b400c04fd430c8') || encode('file:docs/' || doc_id || '.md')) as u from documents)
select doc_id, job_id, substr(sha256(job_id || ':' || p || ':' || doc_id), 1, 16) as document_id, substr(sha256(job_id || ':' || p || ':0'), 1, 16) as parent_document_id,
 substr(u, 1, 8) || '-' || substr(u, 9, 4) || '-5' || substr(u, 14, 3) || '-' || substr('89ab', 1 + (position(substr(u, 17, 1) in '0123456789abcdef') - 1) % 4, 1) || substr(u, 18, 3) || '-' || substr(u, 21, 12) as document_uuid from j
""")
def doc_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    job = ids.job_id(F.concat(F.lit("local:"), F.col("source")))
    path = F.concat(F.lit("docs/"), F.col("doc_id").cast("string"), F.lit(".md"))
    key = ids.canonical_source_key(F.lit("file"), F.concat(F.lit("docs\\"), F.col("doc_id").cast("string"), F.lit(".md")))
    return _docs(spark, sf_dir).select("doc_id", job.alias("job_id"), ids.document_id(job, path, F.col("doc_id")).alias("document_id"), ids.parent_document_id(job, path).alias("parent_document_id"), ids.name_uuid(key).alias("document_uuid"))


@_register(r"""
with p as (select doc_id, unnest(['a/b/' || doc_id || '.md', '../x/' || doc_id, '/etc/' || doc_id, 'C:\x\' || doc_id, 'docs\..\' || doc_id, '']) as path from documents)
select doc_id, path, path like 'a/b/%' as relative, regexp_matches(path, '^a/[^/]*/[^/]*\.md$') as glob_hit from p
""")
def path_policy(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.col("doc_id").cast("string")
    made = [F.concat(F.lit("a/b/"), d, F.lit(".md")), F.concat(F.lit("../x/"), d), F.concat(F.lit("/etc/"), d), F.concat(F.lit("C:\\x\\"), d), F.concat(F.lit("docs\\..\\"), d), F.lit("")]
    rows = _docs(spark, sf_dir).select("doc_id", F.explode(F.array(*made)).alias("path"))
    return rows.select("doc_id", "path", ids.is_workspace_relative(F.col("path")).alias("relative"), ids.matches_glob(F.col("path"), "a/*/*.md").alias("glob_hit"))


@_register("""
select doc_id, cast('2024-' || (doc_id % 9 + 1) || ' ' || source || ' notes' as varchar) as title_words, 'd' || doc_id || case when doc_id % 4 = 0 then '/part-0001.md' else '.md' end as output_path from documents
""")
def output_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.col("doc_id")
    rel = F.concat(F.lit("d"), d.cast("string"), F.lit(".docx"))
    stem = F.concat(F.lit("2024-"), (d % 9 + 1).cast("string"), F.lit("-"), F.col("source"), F.lit("_notes.md"))
    words = F.translate(F.regexp_replace(stem, r"\.[^.]+$", ""), "_", " ")
    words = F.concat(F.substring(words, 1, 6), F.lit(" "), F.regexp_replace(F.substring(words, 8, 100), "-", " "))
    return _docs(spark, sf_dir).select("doc_id", words.alias("title_words"), ids.output_path(rel, F.lit(1), F.lit(1), d % 4 == 0).alias("output_path"))


# --- page quality ----------------------------------------------------------------------------

_IMAGES = "cast(doc_id % 4 as int)"
_DENSITY = f"case when length(text) >= 200 or {_IMAGES} = 0 then 0.0 else 1.0 - length(trim(text, chr(32) || chr(9) || chr(10) || chr(13))) / 200.0 end"
_LINE = "case when len(list_filter(string_split(text, chr(10)), lambda l: length(l) >= 200 and len(list_filter(regexp_split_to_array(l, '\\s+'), lambda w: w <> '')) <= 20)) > 0 then 1.0 else 0.0 end"
_GAP = """
 case when len(list_filter(string_split(text, chr(10)), lambda l: trim(l) <> '')) = 0 then 0.0 else
 (select case when r < 0.3 then 0.0 else least(1.0, r / 0.5) end from (select cast(len(list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '\\S {6,}\\S'))) as double) / len(list_filter(string_split(text, chr(10)), lambda l: trim(l) <> '')) as r)) end
"""
_TABLE = "(select case when length(text) = 0 or t < 0.02 then 0.0 else least(1.0, (t - 0.02) / 0.04) end from (select cast(length(text) - length(regexp_replace(text, '[|│─━═]', '', 'g')) as double) / length(text) as t))"


def _signals(sf: DataFrame) -> tuple[DataFrame, dict[str, Column]]:
    """Signals of documents as pages: images, widgets and positions follow from the id, as the table has no layout."""
    t, images = F.col("text"), (F.col("doc_id") % 4).cast("int")
    xs = F.when(F.col("doc_id") % 5 == 0, F.transform(F.sequence(F.lit(0), F.lit(39)), lambda i: (i * 12).cast("double"))).otherwise(F.array(F.lit(0.0), F.lit(4.0)))
    return sf, {
        "char_density": scores.char_density(t, images),
        "non_ascii_ratio": scores.non_ascii_ratio(t),
        "long_unbroken_line": scores.long_unbroken_line(t),
        "column_gap": scores.column_gap(t),
        "table_char_density": scores.table_char_density(t),
        "image_heavy": scores.image_heavy(images),
        "form_fields": scores.form_fields(F.col("doc_id") % 11 == 0),
        "layout_complexity": scores.layout_complexity(t, xs),
    }


_LAYOUT = "(select case when e <= 0 then 0.0 else least(1.0, e / 4.0) end from (select (case when doc_id % 5 = 0 then 40 else 1 end) - greatest(1, len(list_filter(string_split(text, chr(10)), lambda l: trim(l) <> ''))) as e))"
_SIGNALS_SQL = f"""
select doc_id, {_DENSITY} as char_density, 0.0 as non_ascii_ratio, {_LINE} as long_unbroken_line, {_GAP} as column_gap, {_TABLE} as table_char_density,
  case when doc_id % 4 >= 3 then 1.0 else 0.0 end as image_heavy, case when doc_id % 11 = 0 then 1.0 else 0.0 end as form_fields, {_LAYOUT} as layout_complexity
from documents
"""


@_register(_SIGNALS_SQL.replace("select doc_id,", "select doc_id,", 1))
def page_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, signals = _signals(_docs(spark, sf_dir))
    return rows.select("doc_id", *[s.cast("double").alias(n) for n, s in signals.items()])


_WEIGHTED = {"char_density": 1.0, "non_ascii_ratio": 1.2, "long_unbroken_line": 0.8, "column_gap": 1.0, "table_char_density": 1.0, "image_heavy": 0.9, "form_fields": 1.2, "layout_complexity": 1.1}
_MEAN = "(" + " + ".join(f"{n} * {w}" for n, w in _WEIGHTED.items()) + ") / 8.2"
_SCORED_SQL = f"""
with s as ({_SIGNALS_SQL}), m as (select *, {_MEAN} as aggregate, greatest({", ".join(f"{n} * {w}" for n, w in _WEIGHTED.items())}) as hard,
  concat_ws(',', {", ".join(f"case when {n} * {w} > 0.3 then '{n}' end" for n, w in _WEIGHTED.items())}) as told from s)
"""


@_register(_SCORED_SQL + "select doc_id, aggregate, (hard >= 0.7 or aggregate >= 0.5) as needs_repair, case when hard < 0.7 and aggregate < 0.5 then 'ok' when told = '' then 'aggregate' else told end as reason from m")
def page_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    signals = page_signals(spark, sf_dir)
    return signals.select("doc_id", scores.page_score({n: F.col(n) for n in scores.SIGNAL_WEIGHTS}).alias("s")).select("doc_id", "s.*")


@_register(_SCORED_SQL + ", e as (select doc_id, hard >= 0.7 or aggregate >= 0.5 as f from m) select count(*) as pages_total, count(*) filter (f) as pages_repaired, count(*) filter (not f) as pages_kept from e")
def triage_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = F.col("needs_repair")
    return page_score(spark, sf_dir).agg(F.count("*").alias("pages_total"), F.count_if(f).alias("pages_repaired"), F.count_if(~f).alias("pages_kept"))


@_register("""
with s as (select doc_id, case when doc_id % 4 >= 3 then 0.9 else 0 end as a, case when doc_id % 11 = 0 then 1.2 else 0 end as b, case when doc_id % 6 > 2 then least(1.0, (doc_id % 6 - 2) / 3.0) else 0 end as d from documents),
m as (select doc_id, (a + b + d) / 5.2 as aggregate from s)
select case when aggregate >= 0.7 then 'expensive' when aggregate <= 0.2 then 'cheap' else 'uncertain' end as classification, count(*) as pages, round(avg(aggregate), 9) as mean from m group by 1
""")
def pre_triage_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.col("doc_id")
    signals = {"image_heavy": scores.image_heavy(d % 4), "form_fields": scores.form_fields(d % 11 == 0), "layout_complexity": F.lit(0.0), "font_diversity": scores.font_diversity(d % 6), "text_flow_consistency": F.lit(0.0)}
    s = _docs(spark, sf_dir).select(scores.pre_score(signals).alias("s")).select("s.*")
    return s.groupBy("classification").agg(F.count("*").alias("pages"), F.round(F.avg("aggregate"), 9).alias("mean"))


@_register("""
select source, bool_or(length(text) < 200 and doc_id % 4 > 0) as needs_ocr, count(*) filter (length(text) < 200 and doc_id % 4 > 0) as ocr_pages, max((612 + doc_id % 100) * (792 + doc_id % 50) / 1e6) as largest_mpx from documents group by source
""")
def ocr_need(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.col("doc_id")
    need = scores.needs_ocr(F.col("text"), d % 4)
    size = scores.page_megapixels(d % 100 + 612, d % 50 + 792)
    return _docs(spark, sf_dir).groupBy("source").agg(F.bool_or(need).alias("needs_ocr"), F.count_if(need).alias("ocr_pages"), F.max(size).alias("largest_mpx"))


# --- ranges, packing, splits -----------------------------------------------------------------

_PAGES = "select source, row_number() over (partition by source order by doc_id) - 1 as page_index, count(*) over (partition by source) as total, length(text) as n, doc_id from documents"
_RANGES = f"""
with p as ({_PAGES}), w as (select distinct source, greatest(0, page_index - 1) as s, least(total - 1, page_index + 1) as e from p where n % 5 = 0),
r as (select *, max(e) over (partition by source order by s, e rows between unbounded preceding and 1 preceding) as reach from w),
i as (select *, sum(case when reach is null or s - reach > 2 then 1 else 0 end) over (partition by source order by s, e rows unbounded preceding) as island from r),
ranges as (select source, cast(min(s) as bigint) as start, cast(max(e) as bigint) as "end" from i group by source, island)
"""


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _docs(spark, sf_dir).selectExpr("source", "row_number() over (partition by source order by doc_id) - 1 as page_index", "cast(count(*) over (partition by source) as int) as total_pages", "length(text) as n", "doc_id")


@_register(_RANGES + 'select source, start, "end" from ranges')
def flagged_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ranges.coalesce_ranges(_pages(spark, sf_dir).where("n % 5 = 0"), key="source")
    return found.select("source", F.col("start").cast("bigint").alias("start"), F.col("end").cast("bigint").alias("end"))


@_register(_RANGES + 'select p.source, cast(page_index as bigint) as page_index, coalesce(r.start, -1) as range_start from p left join ranges r on p.source = r.source and page_index between r.start and r."end"')
def range_page_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _pages(spark, sf_dir)
    joined = ranges.pages_in_ranges(pages, ranges.coalesce_ranges(pages.where("n % 5 = 0"), key="source"), key="source")
    return joined.select("source", F.col("page_index").cast("bigint").alias("page_index"), F.coalesce(F.col("range_start").cast("bigint"), F.lit(-1)).alias("range_start"))


@_register(f"""
with recursive p as ({_PAGES}), c as (select source, page_index as i, 1 + n % 17 as k, n % 3 = 0 as ocr from p),
g as (select source, i, k as total, ocr, 0 as grp from c where i = 0
  union all select c.source, c.i, case when c.ocr <> g.ocr or g.total + c.k > case when c.ocr then 8 else 40 end then c.k else g.total + c.k end, c.ocr,
    g.grp + case when c.ocr <> g.ocr or g.total + c.k > case when c.ocr then 8 else 40 end then 1 else 0 end from g join c on c.source = g.source and c.i = g.i + 1)
select source, cast(i as bigint) as page_index, cast(grp as bigint) as page_group from g
""")
def bin_pack_ocr(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = F.array_sort(F.collect_list(F.struct("page_index", (F.col("n") % 17 + 1).alias("k"), (F.col("n") % 3 == 0).alias("ocr"))))
    rows = _pages(spark, sf_dir).groupBy("source").agg(items.alias("items"))
    groups = ranges.greedy_groups(F.transform("items", lambda x: x["k"]), 40, F.transform("items", lambda x: x["ocr"]), 8)
    return rows.select("source", F.posexplode(groups).alias("page_index", "page_group")).select("source", F.col("page_index").cast("bigint").alias("page_index"), F.col("page_group").cast("bigint").alias("page_group"))


@_register(f"""
with recursive p as ({_PAGES}), c as (select source, page_index as i, 1 + n % 17 as k from p),
g as (select source, i, k as total, 0 as grp from c where i = 0
  union all select c.source, c.i, case when g.total + c.k > 40 then c.k else g.total + c.k end, g.grp + case when g.total + c.k > 40 then 1 else 0 end from g join c on c.source = g.source and c.i = g.i + 1)
select source, cast(i as bigint) as page_index, cast(grp as bigint) as page_group from g
""")
def bin_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = F.array_sort(F.collect_list(F.struct("page_index", (F.col("n") % 17 + 1).alias("k"))))
    rows = _pages(spark, sf_dir).groupBy("source").agg(F.transform(items, lambda x: x["k"]).alias("counts"))
    return rows.select("source", F.posexplode(ranges.greedy_groups(F.col("counts"), 40)).alias("page_index", "page_group")).select("source", F.col("page_index").cast("bigint").alias("page_index"), F.col("page_group").cast("bigint").alias("page_group"))


@_register("select doc_id, k as chunk, k * 48 as start, least(k * 48 + 50, n) as stop from (select doc_id, length(text) as n, unnest(range(0, case when length(text) <= 50 then 1 else (length(text) - 1) // 48 + 1 end)) as k from documents where length(text) > 0)")
def pdf_split_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    chunks = ranges.split_ranges(F.length("text"), 50, 2)
    return _docs(spark, sf_dir).select("doc_id", F.explode(chunks).alias("c")).select("doc_id", *[F.col(f"c.{x}").cast("bigint").alias(x) for x in ("chunk", "start", "stop")])


@_register("""
with r as (select l_orderkey % 50 as doc, cast(l_quantity as bigint) % 7 as size, l_linenumber, l_orderkey from lineitem), s as (select doc, size, row_number() over (partition by doc order by size desc) as rk, count(*) over (partition by doc) as n from (select distinct doc, size from r))
select r.doc, r.size as font_size, cast(case when rk <= least(n - 1, 3) then rk else 0 end as int) as level, count(*) as runs from r join s using (doc, size) group by all
""")
def font_heading_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = table(spark, sf_dir, "lineitem").select((F.col("l_orderkey") % 50).alias("doc"), (F.col("l_quantity").cast("bigint") % 7).alias("font_size"))
    return ranges.heading_bands(runs, "doc", "font_size").groupBy("doc", "font_size", "level").agg(F.count("*").alias("runs"))


@_register("""
with g as (select user_id, abs(value - lag(value) over (partition by user_id order by event_id)) as gap from events)
select user_id, round(case when count(gap) < 2 or avg(gap) = 0 then 0.0 else least(1.0, stddev_pop(gap) / avg(gap)) end, 6) as cv from g group by user_id
""")
def baseline_gap_cv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranges.gap_variation(table(spark, sf_dir, "events"), "user_id", "event_id", "value").select("user_id", F.round("cv", 6).alias("cv"))


# --- similarity, samples ---------------------------------------------------------------------

_PAIRS = """
with t as (select doc_id, list_distinct(regexp_extract_all(lower(text), '[\\p{L}\\p{M}\\p{N}_]+')) as w from documents),
p as (select a.doc_id, a.w as x, b.w as y from t a join t b on b.doc_id = a.doc_id + 1),
j as (select doc_id, case when len(x) = 0 and len(y) = 0 then 1.0 when len(x) = 0 or len(y) = 0 then 0.0 else cast(len(list_intersect(x, y)) as double) / (len(x) + len(y) - len(list_intersect(x, y))) end as similarity from p)
"""


@_register(_PAIRS + "select doc_id, similarity from j")
def qa_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Tokens are cut before the join and travel as hashes of 64 bits, not as texts.
    tokens = _docs(spark, sf_dir).select("doc_id", F.transform(scores.word_tokens(F.col("text")), lambda w: F.xxhash64(w)).alias("own"))
    after = tokens.select((F.col("doc_id") - 1).alias("doc_id"), F.col("own").alias("after"))
    return tokens.join(after, "doc_id").select("doc_id", scores.jaccard_tokens(F.col("own"), F.col("after")).cast("double").alias("similarity"))


@_register(_PAIRS + "select count(*) as pairs, count(*) filter (similarity >= 0.9) as ge_090, count(*) filter (similarity >= 0.7 and similarity < 0.9) as ge_070, count(*) filter (similarity >= 0.5 and similarity < 0.7) as ge_050, count(*) filter (similarity < 0.5) as lt_050 from j")
def qa_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.similarity_histogram(qa_similarity(spark, sf_dir))


@_register("select doc_id from documents order by md5('42:' || doc_id), doc_id limit 50")
def qa_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.seeded_sample(_docs(spark, sf_dir).select("doc_id"), 50, 42, "doc_id")


@_register("select source, doc_id from (select source, doc_id, row_number() over (partition by source order by md5('7:' || doc_id), doc_id) as n from documents) where n <= 3")
def stratified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.stratified_sample(_docs(spark, sf_dir).select("source", "doc_id"), 3, 7, "source", "doc_id")


# --- binning, limits -------------------------------------------------------------------------


@_register("""
with recursive q as (select doc_id, list_filter(list_transform(string_split(text, chr(10) || chr(10)), lambda p: trim(p, chr(32) || chr(9) || chr(10) || chr(13))), lambda p: p <> '') as ps from documents),
g as (select doc_id, ps, 1 as i, length(ps[1]) as n, 1 as bins from q where len(ps) > 0
 union all select doc_id, ps, i + 1, case when n + length(ps[i + 1]) + 2 > 12000 then length(ps[i + 1]) else n + length(ps[i + 1]) + 2 end, bins + case when n + length(ps[i + 1]) + 2 > 12000 then 1 else 0 end from g where i < len(ps))
select d.doc_id, cast(coalesce(max(bins), 1) as bigint) as segments from documents d left join g using (doc_id) group by d.doc_id
""")
def segment_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _docs(spark, sf_dir).select("doc_id", F.size(text.segment(F.col("text"))).cast("bigint").alias("segments"))


@_register("select doc_id, len(list_filter(string_split(text, chr(10)), lambda l: length(l) > 4096)) = 0 as fits, case when length(text) > 20000 then 'size' when doc_id % 10 = 0 then 'untrusted' else 'ok' end as verdict from documents")
def reader_limits(spark: SparkSession, sf_dir: str) -> DataFrame:
    verdict = scores.reader_verdict(F.lit(True), F.length("text"), F.when(F.col("doc_id") % 2 == 0, "application/pdf").otherwise("text/plain"), F.col("doc_id") % 10 != 0, ("application/pdf", "text/plain"), 20000)
    return _docs(spark, sf_dir).select("doc_id", text.fits_line_limit(F.col("text")).alias("fits"), verdict.alias("verdict"))


# --- manifests and order ---------------------------------------------------------------------

_PARTS = "select doc_id, source, substr(sha256('job:' || source), 1, 16) as job_id, row_number() over (partition by source order by doc_id) - 1 as ingest_order, 'in/' || doc_id || '.docx' as rel_path from documents"


def _manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _docs(spark, sf_dir).select("doc_id", "source", ids.job_id(F.concat(F.lit("job:"), F.col("source"))).alias("job_id"), F.concat(F.lit("in/"), F.col("doc_id").cast("string"), F.lit(".docx")).alias("rel_path"), F.lit(1).alias("part"), F.lit(1).alias("parts"), F.lit(False).alias("has_media"))
    return manifests.manifest_rows(manifests.ingest_order(rows, "source", "doc_id", "parts"))


@_register(f"""
with p as ({_PARTS})
select substr(sha256(job_id || ':' || rel_path || ':' || ingest_order), 1, 16) as document_id, substr(sha256(job_id || ':' || rel_path || ':0'), 1, 16) as parent_document_id,
 job_id, source, ingest_order, rel_path as input_path, doc_id || '.docx' as input_file, 'in/' || doc_id || '.md' as output_path from p
""")
def manifest_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _manifest(spark, sf_dir)


@_register(f"with p as ({_PARTS}) select job_id, count(*) as n, string_agg('in/' || doc_id || '.md', ',' order by ingest_order) as output_paths from p group by job_id")
def manifest_by_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = manifests.manifest_by_job(_manifest(spark, sf_dir))
    return rows.select("job_id", "n", F.array_join(F.transform("entries", lambda e: e["output_path"]), ",").alias("output_paths"))


@_register("""
select doc_id, cast(row_number() over w as bigint) as part_index, count(*) over (partition by source) as total_parts, lag('p' || doc_id || '.md') over w as prev_part, lead('p' || doc_id || '.md') over w as next_part
from documents window w as (partition by source order by doc_id)
""")
def part_neighbors(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _docs(spark, sf_dir).select("doc_id", "source", F.concat(F.lit("x/p"), F.col("doc_id").cast("string"), F.lit(".md")).alias("path"))
    out = manifests.part_neighbours(rows, "source", "doc_id", F.col("path"))
    return out.select("doc_id", F.col("part_index").cast("bigint").alias("part_index"), "total_parts", "prev_part", "next_part")


@_register("select doc_id, cast(coalesce(sum(1 + length(text) // 12000) over (partition by source order by doc_id rows between unbounded preceding and 1 preceding), 0) as bigint) as ingest_order from documents")
def ingest_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _docs(spark, sf_dir).select("doc_id", "source", F.floor(F.length("text") / 12000 + 1).cast("int").alias("parts"))
    return manifests.ingest_order(rows, "source", "doc_id", "parts").select("doc_id", "ingest_order")


@_register("""
with recursive d as (select source, doc_id, row_number() over (partition by source order by doc_id) as o, 1 + length(text) // 12000 as n, case when doc_id % 4 = 0 then doc_id % 100 end as c from documents),
g as (select source, doc_id, o, coalesce(c, 0) as place, greatest(0, coalesce(c, 0) + n) as nxt from d where o = 1
 union all select d.source, d.doc_id, d.o, coalesce(d.c, g.nxt), greatest(g.nxt, coalesce(d.c, g.nxt) + d.n) from g join d on d.source = g.source and d.o = g.o + 1)
select doc_id, cast(place as bigint) as ingest_order from g
""")
def ingest_order_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.col("doc_id")
    rows = _docs(spark, sf_dir).select("doc_id", "source", F.floor(F.length("text") / 12000 + 1).cast("int").alias("parts"), F.when(d % 4 == 0, d % 100).alias("crawl"))
    return manifests.mixed_ingest_order(rows, "source", "doc_id", "parts", "crawl").select("doc_id", "ingest_order")


@_register("""
with f as (select source as job_id, 'd' || doc_id || '.md' as relative_path, doc_id from documents), t as (select source as job_id, 'd' || doc_id || '.md' as relative_path, min(999999 - doc_id) as seq from documents where doc_id % 3 = 0 group by 1, 2)
select f.job_id, relative_path, row_number() over (partition by f.job_id order by seq nulls last, relative_path) - 1 as crawl_order, seq is not null as toc_referenced from f left join t using (job_id, relative_path)
""")
def toc_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = _docs(spark, sf_dir).select(F.col("source").alias("job_id"), F.concat(F.lit("d"), F.col("doc_id").cast("string"), F.lit(".md")).alias("relative_path"), "doc_id")
    toc = files.where("doc_id % 3 = 0").select("job_id", (F.lit(999999) - F.col("doc_id")).alias("seq"), F.col("relative_path").alias("target_path"))
    return manifests.toc_order(files, toc).select("job_id", "relative_path", F.col("crawl_order").cast("bigint").alias("crawl_order"), "toc_referenced")


@_register("""
with f as (select source as job_id, 'd' || doc_id || case when doc_id % 9 = 0 then '.png' when doc_id % 2 = 0 then '.MD' else '.html' end as relative_path, doc_id from documents)
select job_id, relative_path, row_number() over (partition by job_id order by coalesce(case when doc_id % 3 = 0 then doc_id % 50 end, 1000000), relative_path) - 1 as position from f where doc_id % 9 <> 0
""")
def staged_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.col("doc_id")
    files = _docs(spark, sf_dir).select(F.col("source").alias("job_id"), F.concat(F.lit("d"), d.cast("string"), F.when(d % 9 == 0, ".png").when(d % 2 == 0, ".MD").otherwise(".html")).alias("relative_path"), "doc_id")
    manifest = files.where("doc_id % 3 = 0").select("job_id", "relative_path", (d % 50).alias("crawl_order"))
    return manifests.staged_order(files, manifest).select("job_id", "relative_path", F.col("position").cast("bigint").alias("position"))


@_register("""
with r as (select source, doc_id, 'ops/' || lang || '.md' as path from documents) select doc_id, case when n = 1 then path else replace(path, '.md', '-' || n || '.md') end as unique_path from (select *, row_number() over (partition by source, path order by doc_id) as n from r)
""")
def unique_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _docs(spark, sf_dir).select("source", "doc_id", F.concat(F.lit("ops/"), F.col("lang"), F.lit(".md")).alias("path"))
    return manifests.unique_names(rows, "path", "doc_id", "source").select("doc_id", "unique_path")


# --- studies -----------------------------------------------------------------------------------


@_register("select case when quality = 1 then 'layout' else 'heuristic' end as engine, count(*) as n, sum(n_chars)::double as total, avg(n_chars) as mean, median(n_chars) as median, min(n_chars)::double as least, max(n_chars)::double as most, case when count(*) >= 2 then stddev_samp(n_chars) end as deviation from documents join labels using (doc_id) group by 1")
def engine_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _docs(spark, sf_dir).join(table(spark, sf_dir, "labels"), "doc_id").withColumn("engine", F.when(F.col("quality") == 1, "layout").otherwise("heuristic"))
    return corpus.engine_statistics(rows, "engine", "n_chars")


@_register("with d as (select n_chars - 1500.0 as delta from documents) select case when delta > 500 then 'wins' when delta < -500 then 'loses' else 'tied' end as verdict, count(*) as n from d group by 1")
def range_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _docs(spark, sf_dir).select(corpus.verdict(F.col("n_chars") - 1500.0, 500).alias("verdict")).groupBy("verdict").agg(F.count("*").alias("n"))


@_register("with d as (select 1 + n_chars // 500 as pages, toxic from documents left join labels using (doc_id)) select case when pages <= 5 then 'small' when pages <= 30 then 'medium' else 'large' end as bucket, count(*) as n, avg(pages) as mean_pages, coalesce(sum(toxic), 0)::bigint as toxic from d group by 1")
def bucket_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _docs(spark, sf_dir).join(table(spark, sf_dir, "labels"), "doc_id", "left").withColumn("pages", F.floor(F.col("n_chars") / 500 + 1))
    return rows.groupBy(corpus.page_bucket(F.col("pages")).alias("bucket")).agg(F.count("*").alias("n"), F.avg("pages").alias("mean_pages"), F.coalesce(F.sum("toxic"), F.lit(0)).cast("bigint").alias("toxic"))


@_register("select source, count(*) as files, sum(n_chars)::double as chars, avg(n_chars) as mean_chars, median(n_chars) as median_chars from documents group by rollup (source)")
def corpus_survey_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.survey(_docs(spark, sf_dir), "source", "n_chars")


@_register("""
with f as (select source, text like '#%' as h1, length(split_part(text, chr(10), 1)) between 3 and 60 as a, length(trim(split_part(text, chr(10) || chr(10), 1))) between 40 and 2000 as b from documents)
select source, count(*) filter (h1) as with_h1, count(*) filter (not h1 and a) as tier_a, count(*) filter (not h1 and not a and b) as tier_b, count(*) filter (not h1 and not a and not b) as unrescued from f group by rollup (source)
""")
def h1_rescue_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.h1_rescue(_docs(spark, sf_dir), "source")


@_register("select round(regr_intercept(value * 3 + 10, event_id % 100), 6) as base, round(regr_slope(value * 3 + 10, event_id % 100), 6) as k, count(*) as n from events where user_id % 2 = 0")
def ocr_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select((F.col("value") * 3 + 10).alias("peak"), (F.col("event_id") % 100).alias("load"), F.when(F.col("user_id") % 2 == 0, "ok").otherwise("oom").alias("outcome"))
    return corpus.peak_fit(rows, "peak", "load").select(F.round("base", 6).alias("base"), F.round("k", 6).alias("k"), "n")


@_register("""
with e as (select event_id, 1500 + event_id % 14000 as mb, 0.2 + event_id % 20 as mpx, 1 + event_id % 12 as cap, 1 + event_id % 64 as ram, event_id % 3 = 0 as pressed),
t as (select *, (mb * 0.6 - 1412.84) as usable, case when ram < 4 then 0 when ram < 8 then 25 when ram < 16 then 50 when ram < 32 then 75 else 100 end as pages, case when ram < 4 then 0 when ram < 8 then 10 when ram < 16 then 20 when ram < 32 then 30 else 40 end as most from e),
b as (select *, case when pressed and pages > 1 then greatest(pages // 2, 1) else pages end as p from t)
select event_id, 1412.84 + 15.4942 * mpx * 4 * 3 as peak_mb, cast(case when usable <= 0 then 1 else greatest(1, least(floor(usable / (15.4942 * mpx * 4)), floor(usable / 207.0))) end as int) as cap_pages, cast(greatest(1, least(cap - 1, cap // 2)) as int) as retry_cap,
 cast(p as int) as max_pages, case when p <= 0 or most <= 0 then 'insufficient_ram' when cap * 3 > most then 'file_too_large' when event_id % 150 > p then 'page_count_too_high' else 'ok' end as verdict,
 case when 1412.84 + 15.4942 * mpx * 4 <= mb * 0.6 then 2.0 when 1412.84 + 15.4942 * mpx <= mb * 0.6 then 1.0 end as scale from b
""".replace("event_id % 3 = 0 as pressed)", "event_id % 3 = 0 as pressed from events)"))
def ocr_caps(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.col("event_id")
    mb, mpx, cap, ram = e % 14000 + 1500, e % 20 + 0.2, (e % 12 + 1).cast("int"), e % 64 + 1
    budget = scores.host_budget(ram, F.lit(8), e % 3 == 0, F.lit(None).cast("double"))
    return table(spark, sf_dir, "events").select(
        "event_id",
        scores.predicted_peak_mb(mpx, F.lit(2.0), F.lit(3)).alias("peak_mb"),
        scores.pages_per_group(mb, mpx).alias("cap_pages"),
        scores.smaller_cap(cap, F.lit(None).cast("int")).alias("retry_cap"),
        budget["max_pages"].alias("max_pages"),
        scores.expensive_verdict(budget, cap * 3, e % 150).alias("verdict"),
        scores.recovered_scale(F.array(F.lit(1.0), F.lit(2.0)), mpx, mb, F.lit(1)).alias("scale"),
    )


@_register("""
with r as (select event_id % 5 as merge_gap, avg(value) as wall_s, count(*) as qa from events group by 1), b as (select max(merge_gap) as baseline_gap, arg_max(wall_s, merge_gap) as bs, arg_max(qa, merge_gap) as bq from r)
select coalesce((select arg_min(merge_gap, wall_s) from r, b where wall_s <= bs * 0.95 and qa >= bq), baseline_gap) as best_gap, baseline_gap from b
""")
def merge_gap_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = table(spark, sf_dir, "events").groupBy((F.col("event_id") % 5).alias("merge_gap")).agg(F.avg("value").alias("wall_s"), F.count("*").alias("qa"))
    return corpus.merge_gap_verdict(runs)


@_register("with v as (select source, list_sort(list(n_chars)) as x, count(*) as n from documents group by source), p as (select *, 9 * (n + 1) / 10.0 as a, greatest(1, least(n - 1, floor(9 * (n + 1) / 10.0))) as lo from v) select source, median(n_chars) as median_chars, any_value(round(x[lo::int] + (x[lo::int + 1] - x[lo::int]) * (a - lo), 6)) as p90 from p join documents using (source) group by source")
def section_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _docs(spark, sf_dir)
    middle = docs.groupBy("source").agg(F.median("n_chars").alias("median_chars"))
    return middle.join(corpus.exclusive_percentile(docs, "source", "n_chars", 10, 9), "source").select("source", "median_chars", F.round("percentile", 6).alias("p90"))


@_register("""
with v as (select doc_id, (case when n_chars < 800 then 1 else 0 end) + (case when quality = 0 then 1 else 0 end) + (case when toxic = 1 then 1 else 0 end) >= 2 as truth, n_chars % 10 / 10.0 >= 0.3 as told from documents join labels using (doc_id))
select avg(case when truth = told then 1.0 else 0.0 end) as agreement, avg(case when truth = told then 1.0 else 0.0 end) >= 0.85 as passes from v
""")
def validation_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _docs(spark, sf_dir).join(table(spark, sf_dir, "labels"), "doc_id")
    return corpus.agreement(rows, [F.col("n_chars") < 800, F.col("quality") == 0, F.col("toxic") == 1], F.col("n_chars") % 10 / 10.0 >= 0.3)


@_register("select doc_id, case when n_chars % 3 = 0 then null else (doc_id - n_chars % 3) * 100.0 / (n_chars % 3) end as change, case when doc_id % 40 <= 10 then 'stable' when doc_id % 40 <= 30 then 'experimental' else 'unsupported' end as tier from documents")
def study_ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    d, b = F.col("doc_id"), F.col("n_chars") % 3
    return _docs(spark, sf_dir).select("doc_id", scores.percent_change(d, b).alias("change"), scores.stability_tier(d % 40).alias("tier"))
