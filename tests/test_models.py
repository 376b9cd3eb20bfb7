"""Sequential operators against plain Python models on random input, and streams against batches."""

import random
import re
import time

from pyspark.sql import functions as F

from foliary.functions import ids, scores, text, urls
from foliary.operators import manifests, ranges
from foliary.streaming.incremental import event_counts, read_upserted, stream_table, upsert


def values(spark, rows, schema, *columns):
    return spark.createDataFrame(rows, schema).orderBy("i").select(*columns).collect()


def bins(t, most):
    out, now = [], ""
    for p in filter(None, (x.strip() for x in t.split("\n\n"))):
        if now and len(now) + len(p) + 2 > most:
            out.append(now)
            now = p
        else:
            now = f"{now}\n\n{p}" if now else p
    return out + [now]


def test_char_bins(spark):
    r = random.Random(1)
    texts = ["\n\n".join("x" * r.randint(0, 30) for _ in range(r.randint(0, 12))) for _ in range(60)] + ["", " \n\n "]
    got = values(spark, list(enumerate(texts)), "i int, t string", text.char_bins(F.col("t"), 40).alias("b"))
    assert [g["b"] for g in got] == [bins(t, 40) for t in texts]


def test_headings(spark):
    r = random.Random(2)
    bodies = ["\n".join(r.choice(["# a", "## b", "### c", "#### d", "```", "~~~", "text", ""]) for _ in range(r.randint(0, 14))) for _ in range(150)]

    def normal(body):
        levels = [len(m[1]) for m in map(re.compile(text.HEADING).match, body.split("\n")) if m]
        out, before = [], 0
        for x in levels:
            before = min(x - min(levels) + 1, before + 1)
            out.append(before)
        return out

    def anchors(body):
        n, fenced = 0, False
        for line in body.split("\n"):
            if line.startswith(("```", "~~~")):
                fenced = not fenced
            elif not fenced and re.match(r"#{1,3}\s+\S", line):
                n += 1
        return n

    def verdict(body):
        sign, first = None, {}
        for i, line in enumerate(body.split("\n")):
            if line.startswith(("```", "~~~")):
                sign = line[0] if sign is None else None if sign == line[0] else sign
            elif sign is None and (m := re.match(r"(#{1,3}) ", line)):
                first.setdefault(len(m[1]), i)
        if 1 not in first or 2 not in first or first.get(3, 1e9) < first[2]:
            return "skipped"
        return "fail" if first[2] < first[1] else "pass"

    b = F.col("b")
    got = values(spark, list(enumerate(bodies)), "i int, b string", text.headings(text.normalize_headings(b)).alias("h"), text.chunk_count(b).alias("n"), text.heading_verdict(b).alias("v"))
    for body, g in zip(bodies, got, strict=True):
        assert [h["level"] for h in g["h"]] == normal(body)
        assert (g["n"], g["v"]) == (anchors(body), verdict(body)), body


def test_ranges(spark):
    r = random.Random(3)
    cases = [(i, r.randint(1, 30)) for i in range(50)]
    pages = {i: sorted(r.sample(range(n), r.randint(0, n))) for i, n in cases}
    rows = [(i, p, n) for i, n in cases for p in pages[i]]
    got: dict[int, list] = {}
    for x in ranges.coalesce_ranges(spark.createDataFrame(rows, "doc_id int, page_index int, total_pages int")).collect():
        got.setdefault(x["doc_id"], []).append((x["start"], x["end"]))
    for i, n in cases:
        out: list[list[int]] = []
        for p in pages[i]:
            a, b = max(0, p - 1), min(n - 1, p + 1)
            if out and a - out[-1][1] <= 2:
                out[-1][1] = max(out[-1][1], b)
            else:
                out.append([a, b])
        assert sorted(got.get(i, [])) == [tuple(x) for x in out]


def test_clusters_and_stitching(spark):
    row = spark.createDataFrame([([0.0, 9.0, 18.0, 20.0, 31.0], ["# A\n\nx", "# A\n\ny\n\n# B", "# B\n\nz"])], "xs array<double>, b array<string>").select(scores.x_clusters(F.col("xs")).alias("n"), ranges.stitch_bodies(F.col("b")).alias("s")).first()
    assert row["n"] == 3
    assert row["s"] == "# A\n\nx\n\n\ny\n\n# B\n\n\nz"


def test_urls(spark):
    cases = {
        "HTTP://User:p@Example.COM:80/a//b/../c/?b=2&a=1&utm_s=x&a=0#f": "http://User:p@example.com/a/c/?a=1&a=0&b=2",
        "https://e.com": "https://e.com/",
        "https://e.com:8443/x?q=a%20b~*": "https://e.com:8443/x?q=a+b~%2A",
        "ftp://e.com/": None,
        "https:///x": None,
    }
    got = values(spark, list(enumerate(cases)), "i int, u string", urls.canonical_url(F.col("u")).alias("c"))
    assert [g["c"] for g in got] == list(cases.values())
    hosts = ["localhost", "127.0.0.1", "10.9.8.7", "172.31.0.1", "172.32.0.1", "8.8.8.8", "::1", "fd12::1", "example.com"]
    got = values(spark, list(enumerate(hosts)), "i int, h string", urls.is_private_host(F.col("h")).alias("p"))
    assert [g["p"] for g in got] == [True, True, True, True, False, False, True, True, False]
    crumbs = ["/azure/docs/breadcrumb/toc.json", "/breadcrumb/x", "azure", "/a/b"]
    got = values(spark, list(enumerate(crumbs)), "i int, c string", urls.breadcrumb_prefix(F.col("c")).alias("p"))
    assert [g["p"] for g in got] == ["/azure/docs", None, None, "/a/b"]


def test_ids(spark):
    import uuid

    keys = ["file:a/b.md", "url:https://é.test"]
    got = values(spark, list(enumerate(keys)), "i int, k string", ids.name_uuid(F.col("k")).alias("u"))
    assert [g["u"] for g in got] == [str(uuid.uuid5(uuid.NAMESPACE_URL, k)) for k in keys]


def test_unique_names(spark):
    rows = spark.createDataFrame([("g", i, p) for i, p in enumerate(["a.md", "a.md", "b.md", "a.md"])], "g string, i int, p string")
    got = [r["unique_path"] for r in manifests.unique_names(rows, "p", "i", "g").orderBy("i").collect()]
    assert got == ["a.md", "a-2.md", "b.md", "a-3.md"]


def test_streams(spark, tmp_path):
    src, table, ck = tmp_path / "in", f"file://{tmp_path}/table", tmp_path / "ck"
    like = spark.createDataFrame([(1, "a")], "id int, body string")
    like.write.parquet(str(src / "1"))
    frame = lambda: stream_table(spark, f"{src}/*", like)
    upsert(frame(), table, str(ck), "id", "body").awaitTermination()
    spark.createDataFrame([(1, "b"), (2, "c")], "id int, body string").union(spark.createDataFrame([(1, "a"), (2, "b")], like.schema)).write.parquet(str(src / "2"))
    upsert(frame(), table, str(ck), "id", "body").awaitTermination()
    assert {(r["id"], r["body"]) for r in read_upserted(spark, table).collect()} == {(1, "b"), (2, "c")}
    events = spark.sql("select timestamp'2024-01-01 00:10:00' as ts, 'x' as event_type, 1.5D as value")
    assert event_counts(events).first()["n"] == 1


def test_packing_is_linear(spark):
    """A fold that copies what it has at each item takes minutes here."""
    n = 150_000
    rows = spark.range(1).selectExpr(f"transform(sequence(1, {n}), i -> i % 17 + 1) as counts", f"transform(sequence(1, {n}), i -> i % 3 = 0) as ocr")
    began = time.monotonic()
    got = rows.select(ranges.greedy_groups(F.col("counts"), 40).alias("a"), ranges.greedy_groups(F.col("counts"), 40, F.col("ocr"), 8).alias("b")).first()
    assert time.monotonic() - began < 30
    total, group = 0, 0
    for i, g in enumerate(got["a"], 1):
        k = i % 17 + 1
        total, group = (k, group + 1) if total + k > 40 else (total + k, group)
        assert g == group
    assert len(got["b"]) == n and got["b"][:4] == [0, 0, 1, 2]


def test_packing_of_odd_items(spark):
    rows = spark.createDataFrame([([50, None, 3, 38], [False, False, None, True]), ([], []), (None, None)], "counts array<int>, ocr array<boolean>")
    got = rows.select(ranges.greedy_groups(F.col("counts"), 40).alias("a"), ranges.greedy_groups(F.col("counts"), 40, F.col("ocr")).alias("b")).collect()
    assert [(r["a"], r["b"]) for r in got] == [([0, 0, 0, 0], [0, 0, 0, 0]), ([], []), (None, None)]
