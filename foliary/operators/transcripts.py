"""Transcripts: WebVTT cues, speaker turns, topic sections, scaffold."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliary.functions.text import clock, clock_to_ms, split_lines, strip

_TIMING = r"^(\S+)\s+-->\s+(\S+)"
_SPEAKER = r"(?s)^<v\s+([^>]+)>(.*?)(?:</v>)?$"


def vtt_segments(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, seq, start_ms, end_ms, speaker, text) of the cues of WebVTT texts; other texts yield nothing."""
    blocks = docs.where(strip(F.col(text)).startswith("WEBVTT")).select(key, F.posexplode(F.split(strip(F.col(text)), "\r?\n\r?\n")).alias("seq", "block"))
    ls = F.filter(F.transform(split_lines(F.col("block")), strip), lambda l: l != "")
    cut = blocks.select(key, "seq", ls.alias("ls"))
    at = F.array_min(F.filter(F.transform("ls", lambda l, i: F.when(l.rlike(_TIMING), i)), lambda i: i.isNotNull()))
    timed = cut.withColumn("at", at).where("at is not null")
    body = strip(F.array_join(F.slice("ls", F.col("at") + 2, F.size("ls")), "\n"))
    line = F.get("ls", F.col("at"))
    cues = timed.select(key, "seq", clock_to_ms(F.regexp_extract(line, _TIMING, 1)).alias("start_ms"), clock_to_ms(F.regexp_extract(line, _TIMING, 2)).alias("end_ms"), body.alias("body")).where("body <> ''")
    speaker = F.when(F.col("body").rlike(_SPEAKER), strip(F.regexp_extract("body", _SPEAKER, 1)))
    said = F.when(F.col("body").rlike(_SPEAKER), F.regexp_extract("body", _SPEAKER, 2)).otherwise(F.col("body"))
    return cues.select(key, "seq", "start_ms", "end_ms", speaker.alias("speaker"), strip(F.regexp_replace(said, r"</?v(?:\s+[^>]*)?>", "")).alias("text"))


def speaker_turns(segments: DataFrame, key: str, order: str, speaker: str = "speaker") -> DataFrame:
    """(key, turn_no, speaker, first, last, n): runs of one speaker; a missing speaker counts as the empty name."""
    w = Window.partitionBy(key).orderBy(order)
    named = segments.withColumn("who", F.coalesce(speaker, F.lit("")))
    fresh = F.when(F.lag("who").over(w).isNull() | (F.lag("who").over(w) != F.col("who")), 1).otherwise(0)
    runs = named.withColumn("fresh", fresh).withColumn("turn_no", F.sum("fresh").over(w))
    return runs.groupBy(key, "turn_no").agg(F.first("who").alias("speaker"), F.min(order).alias("first"), F.max(order).alias("last"), F.count("*").alias("n"))


def speakers_first_seen(segments: DataFrame, key: str, order: str, speaker: str = "speaker") -> DataFrame:
    """(key, speakers array): distinct speakers in the order of first appearance."""
    first = segments.where(F.col(speaker).isNotNull()).groupBy(key, speaker).agg(F.min(order).alias("at"))
    return first.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("at", speaker))), lambda x: x[speaker]).alias("speakers"))


def topic_heading(text: Column) -> Column:
    """The first word without closing punctuation; "Topic" if there is none."""
    word = F.regexp_replace(F.regexp_extract(text, r"^\s*(\S+)", 1), r"[.!?,]+$", "")
    return F.when(word == "", "Topic").otherwise(word)


def topic_sections(segments: DataFrame, key: str, order: str, speaker: str = "speaker", text: str = "text", start: str = "start_ms", end: str = "end_ms") -> DataFrame:
    """(key, section, heading, start_ms, end_ms, n): a section begins with each segment of the primary speaker and with the first one.

    The primary speaker is the first that is named, else nobody.
    """
    w = Window.partitionBy(key).orderBy(order)
    primary = segments.where(F.col(speaker).isNotNull()).groupBy(key).agg(F.min_by(speaker, order).alias("primary"))
    rows = segments.join(primary, key, "left")
    begins = F.when((F.row_number().over(w) == 1) | F.col(speaker).eqNullSafe(F.col("primary")), 1).otherwise(0)
    cut = rows.withColumn("begins", begins).withColumn("section", F.sum("begins").over(w))
    return cut.groupBy(key, "section").agg(topic_heading(F.min_by(text, order)).alias("heading"), F.min_by(start, order).alias("start_ms"), F.max_by(end, order).alias("end_ms"), F.count("*").alias("n"))


def out_of_order(segments: DataFrame, key: str, order: str, start: str = "start_ms") -> DataFrame:
    """(key, faults): segments that start before the one ahead of them."""
    w = Window.partitionBy(key).orderBy(order)
    late = F.when(F.lag(start).over(w) > F.col(start), 1).otherwise(0)
    return segments.select(key, late.alias("late")).groupBy(key).agg(F.sum("late").cast("bigint").alias("faults"))


def scaffold(segments: DataFrame, key: str, order: str) -> DataFrame:
    """(key, body): speakers, timeline and topics as Markdown. A segment that does not end after it starts makes its body null."""
    who = F.coalesce("speaker", F.lit("Unknown"))
    line = F.concat(F.lit("- ["), clock(F.col("start_ms")), F.lit(" - "), clock(F.col("end_ms")), F.lit("] "), who, F.lit(": "), F.coalesce("text", F.lit("")))
    joined = lambda order_col, c: F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.col(order_col).alias("o"), c.alias("l")))), lambda x: x["l"]), "\n")
    timeline = segments.groupBy(key).agg(joined(order, line).alias("timeline"), F.bool_or(F.col("start_ms") >= F.col("end_ms")).alias("bad"))
    topics = topic_sections(segments, key, order).groupBy(key).agg(joined("section", F.concat(F.lit("- "), F.col("heading"), F.lit(" ("), clock(F.col("start_ms")), F.lit(")"))).alias("topics"))
    speakers = speakers_first_seen(segments, key, order).select(key, F.array_join(F.transform("speakers", lambda s: F.concat(F.lit("- "), s)), "\n").alias("speakers"))
    whole = timeline.join(topics, key).join(speakers, key, "left")
    body = F.concat(F.lit("## Speakers\n"), F.coalesce("speakers", F.lit("- Unknown")), F.lit("\n\n## Timeline\n"), F.col("timeline"), F.lit("\n\n## Topics\n"), F.col("topics"), F.lit("\n"))
    return whole.select(key, F.when(~F.col("bad"), body).alias("body"))
