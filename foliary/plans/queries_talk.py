"""Queries over conversations as transcripts, and over streams of events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliary.functions.text import clock
from foliary.operators import transcripts
from foliary.plans.tables import Registry, table

_register = Registry()
QUERIES, ORACLE_SQL = _register.queries, _register.sql

_SEGMENTS = "select conv_id, turn, turn * 1000 as start_ms, turn * 1000 + 900 as end_ms, nullif(role, 'system') as speaker, text from conversations"


def _segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", (F.col("turn") * 1000).alias("start_ms"), (F.col("turn") * 1000 + 900).alias("end_ms"), F.nullif("role", F.lit("system")).alias("speaker"), "text")


@_register(f"""
with s as (select *, coalesce(case when turn % 3 = 2 then 'assistant' else speaker end, '') as who from ({_SEGMENTS})), c as (select *, case when lag(who) over w is distinct from who then 1 else 0 end as fresh from s window w as (partition by conv_id order by turn)),
r as (select *, sum(fresh) over (partition by conv_id order by turn) as turn_no from c)
select conv_id, cast(turn_no as bigint) as turn_no, any_value(who) as speaker, min(turn) as "first", max(turn) as "last", count(*) as n from r group by conv_id, turn_no
""")
def speaker_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _segments(spark, sf_dir).withColumn("speaker", F.when(F.col("turn") % 3 == 2, "assistant").otherwise(F.col("speaker")))
    return transcripts.speaker_turns(rows, "conv_id", "turn")


@_register(f"""
with s as ({_SEGMENTS}), p as (select conv_id, arg_min(speaker, turn) as prim from s where speaker is not null group by conv_id),
b as (select s.*, sum(case when s.turn = m.t or speaker is not distinct from prim then 1 else 0 end) over (partition by s.conv_id order by turn) as section from s left join p using (conv_id) join (select conv_id, min(turn) as t from s group by conv_id) m on m.conv_id = s.conv_id)
select conv_id, cast(section as bigint) as section, coalesce(nullif(regexp_replace(regexp_extract(arg_min(text, turn), '^\\s*(\\S+)', 1), '[.!?,]+$', ''), ''), 'Topic') as heading, min(start_ms) as start_ms, max(end_ms) as end_ms, count(*) as n from b group by conv_id, section
""")
def topic_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transcripts.topic_sections(_segments(spark, sf_dir), "conv_id", "turn")


@_register(f"with s as ({_SEGMENTS}), f as (select conv_id, speaker, min(turn) as t from s where speaker is not null group by all) select conv_id, string_agg(speaker, ',' order by t) as speakers from f group by conv_id")
def speakers_first_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = transcripts.speakers_first_seen(_segments(spark, sf_dir), "conv_id", "turn")
    return found.select("conv_id", F.array_join("speakers", ",").alias("speakers"))


@_register("select conv_id, turn, printf('%02d:%02d.%03d', (turn * 61234) // 60000, (turn * 61234) % 60000 // 1000, (turn * 61234) % 1000) as stamp from conversations")
def transcript_clock(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", clock(F.col("turn") * 61234).alias("stamp"))


@_register(f"""
with s as ({_SEGMENTS}), l as (select conv_id, string_agg('- [' || printf('%02d:%02d.%03d', start_ms // 60000, start_ms % 60000 // 1000, start_ms % 1000) || ' - ' || printf('%02d:%02d.%03d', end_ms // 60000, end_ms % 60000 // 1000, end_ms % 1000) || '] ' || coalesce(speaker, 'Unknown') || ': ' || text, chr(10) order by turn) as t from s group by conv_id),
sp as (select conv_id, string_agg('- ' || speaker, chr(10) order by t) as who from (select conv_id, speaker, min(turn) as t from s where speaker is not null group by all) group by conv_id)
select l.conv_id, '## Speakers' || chr(10) || coalesce(who, '- Unknown') || chr(10) || chr(10) || '## Timeline' || chr(10) || t || chr(10) || chr(10) || '## Topics' as head from l left join sp using (conv_id)
""")
def transcript_timeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = transcripts.scaffold(_segments(spark, sf_dir), "conv_id", "turn")
    return rows.select("conv_id", F.regexp_replace("body", "(?s)(\n## Topics)\n.*$", "$1").alias("head"))


@_register(f"with s as ({_SEGMENTS}), l as (select conv_id, case when lag(case when turn % 4 = 1 then start_ms + 5000 else start_ms end) over (partition by conv_id order by turn) > case when turn % 4 = 1 then start_ms + 5000 else start_ms end then 1 else 0 end as late from s) select conv_id, cast(sum(late) as bigint) as faults from l group by conv_id")
def chronology_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _segments(spark, sf_dir).withColumn("start_ms", F.when(F.col("turn") % 4 == 1, F.col("start_ms") + 5000).otherwise(F.col("start_ms")))
    return transcripts.out_of_order(rows, "conv_id", "turn")


@_register("""
select conv_id, 1 + row_number() over (partition by conv_id order by turn) - 1 as seq, turn * 1000 as start_ms, turn * 1000 + 900 as end_ms, case when turn % 2 = 0 then role end as speaker,
 trim(regexp_replace(text, '\\s*\\n\\s*', chr(10), 'g'), chr(32) || chr(9) || chr(10)) as text from conversations
""")
def vtt_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations rendered as WebVTT in the query, then parsed."""
    t = F.col("turn")
    stamp = lambda ms: F.concat(F.lit("00:"), clock(ms))
    said = F.regexp_replace(F.col("text"), r"\s*\n\s*", "\n")
    cue = F.concat(stamp(t * 1000), F.lit(" --> "), stamp(t * 1000 + 900), F.lit("\n"), F.when(t % 2 == 0, F.concat(F.lit("<v "), F.col("role"), F.lit(">"), said, F.lit("</v>"))).otherwise(said))
    whole = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", cue.alias("cue")))).alias("cues"))
    vtt = whole.select("conv_id", F.concat(F.lit("WEBVTT\n\n"), F.array_join(F.transform("cues", lambda c: c["cue"]), "\n\n")).alias("text"))
    return transcripts.vtt_segments(vtt, "conv_id").select("conv_id", F.col("seq").cast("bigint").alias("seq"), "start_ms", "end_ms", "speaker", "text")
