"""Readers, sinks and the process plan on small inputs made here."""

import io
import json
import zipfile
import zlib

import pytest
import yaml
from pyspark.sql import functions as F

from foliary import cli
from foliary.operators import links
from foliary.plans.crawl import CrawlRules, crawl
from foliary.plans.process import process
from foliary.plans import queries_runs
from foliary.plans.triage import chunked, triage, triage_report, triage_statistics
from foliary.sources import docx, files, html, markdown, net, openapi, pdf, sinks, yamls

W = "http://schemas.openxmlformats.org/wordprocessingml/2006/main"


def word_file() -> bytes:
    para = lambda t, style="", num="": f'<w:p><w:pPr>{f"<w:pStyle w:val={chr(34)}{style}{chr(34)}/>" if style else ""}{num}</w:pPr><w:r><w:t>{t}</w:t></w:r></w:p>'
    num = lambda n, l: f'<w:numPr><w:ilvl w:val="{l}"/><w:numId w:val="{n}"/></w:numPr>'
    image = '<w:p><w:drawing><a:blip xmlns:a="http://schemas.openxmlformats.org/drawingml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships" r:embed="r1"/></w:drawing></w:p>'
    table = "<w:tbl><w:tr><w:tc><w:p><w:r><w:t>a|b</w:t></w:r></w:p></w:tc><w:tc><w:p/></w:tc></w:tr><w:tr><w:tc><w:p><w:r><w:t>c</w:t></w:r></w:p></w:tc></w:tr></w:tbl>"
    body = para("Title", "Heading 1") + para("one", num=num(1, 0)) + para("two", num=num(1, 0)) + para("dot", num=num(2, 1)) + para("text") + table + image
    numbering = "".join(f'<w:abstractNum w:abstractNumId="{i}"><w:lvl w:ilvl="0"><w:numFmt w:val="{f}"/></w:lvl></w:abstractNum><w:num w:numId="{i}"><w:abstractNumId w:val="{i}"/></w:num>' for i, f in ((1, "decimal"), (2, "bullet")))
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("word/document.xml", f'<w:document xmlns:w="{W}"><w:body>{body}</w:body></w:document>')
        z.writestr("word/numbering.xml", f'<w:numbering xmlns:w="{W}">{numbering}</w:numbering>')
        z.writestr("word/_rels/document.xml.rels", '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="r1" Target="media/x.png"/></Relationships>')
        z.writestr("word/media/x.png", b"PNG")
    return out.getvalue()


def pdf_file(*streams: bytes) -> bytes:
    return b"%PDF-1.4\n" + b"".join(b"1 0 obj << /Length %d /Filter /FlateDecode >> stream\n%b\nendstream endobj\n" % (len(s), zlib.compress(s)) for s in streams)


SPEC = """
swagger: '2.0'
host: api.test
paths:
  /things/{id}:
    get:
      summary: One thing
      parameters:
        - {name: id, in: path, required: true, type: integer, format: int64}
      responses:
        404: {description: none}
        200: {description: found, schema: {$ref: '#/definitions/Thing'}}
      security: [{key: []}, {oauth: [read]}]
    post:
      operationId: make
      parameters: [{name: body, in: body, required: true, schema: {$ref: '#/definitions/Thing'}}]
      responses: {default: {description: d}}
definitions:
  Thing: {type: object, required: [n], properties: {n: {type: string, description: a|b}, next: {$ref: '#/definitions/Thing'}}}
  Kind: {type: string, enum: [x, y]}
"""


def test_docx():
    d = docx.Document(word_file())
    assert d.blocks(True) == ["# Title", "1. one\n2. two", "  - dot", "text", "| a\\|b |  |\n| --- | --- |\n| c |  |", "![](media/figure-0001.png)"]
    assert d.media[0]["data"] == b"PNG" and d.media[0]["mime"] == "image/png"
    for bad in (b"no", b"PK\x03\x04broken"):
        with pytest.raises(docx.DocxError):
            docx.Document(bad)


def test_pdf():
    data = pdf_file(b"BT /F1 24 Tf (Big \\(x\\)) Tj ET BT /F1 10 Tf [(Hel) -5 (lo)] TJ <776F726C64> Tj ET", b"BT /F1 10 Tf (two) Tj ET")
    assert pdf.builtin_pages(data) == ["# Big (x)\nHello world", "two"]
    assert pdf.read_pages(data, "auto")[1] == "two"
    with pytest.raises(ValueError):
        pdf.choose("no-such")
    pdf.register("layout", lambda b: 1 / 0)
    try:
        assert pdf.read_pages(data, "auto")[1] == "two"
        with pytest.raises(ZeroDivisionError):
            pdf.read_pages(data, "layout")
    finally:
        del pdf.ENGINES["layout"]
    assert pdf.layout_positions("1 0 0 1 5 7 Tm 3 4 Td") == ([5.0, 8.0], [7.0, 11.0])


def test_openapi():
    docs = openapi.documents(SPEC, "specs/api.yaml", "specs/api.yaml")
    assert [d["relative_path"] for d in docs] == ["operations/get-things-id.md", "operations/make.md", "schemas/Thing.md", "schemas/Kind.md"]
    get = docs[0]["body"]
    assert "# GET /things/{id}\n\nOne thing\n\n## Parameters" in get
    assert "| `id` | path | integer (int64) | yes |  |" in get
    assert get.index("`200`") < get.index("`404`") and "[Thing](../schemas/Thing.md)" in get
    assert "- `key`\n- `oauth` (read)" in get
    assert "## Request body\n\nRequired: yes" in docs[1]["body"]
    assert "| `n` | string | yes | a\\|b |" in docs[2]["body"] and "[Thing](Thing.md)" in docs[2]["body"]
    assert "## Values\n\n- `x`\n- `y`" in docs[3]["body"]
    with pytest.raises(openapi.SpecError):
        openapi.deref({"$ref": "#/a"}, {"a": {"$ref": "#/b"}, "b": {"$ref": "#/a"}})
    assert openapi.unique_path("a.md", {"a.md", "a-2.md"}) == "a-3.md"
    link = openapi.corpus_link("operations", "x/a.yaml", {("y/b.yaml", "T")})
    assert link("../y/b.yaml#/definitions/T") == "../../../y/b/schemas/T.md"
    assert link("https://e.com/b.yaml#/definitions/T") is None and link("../../z.yaml#/definitions/T") is None


def test_openapi_v2_shape():
    spec = openapi.load("""
swagger: '2.0'
basePath: /v1
host: h.test
schemes: [http, https]
consumes: [text/csv]
tags: [{name: t}]
security: [{k: []}]
paths:
  /f:
    parameters: [{name: x, in: query, type: array, items: {type: string}}, {name: b, in: body, schema: {}}]
    post:
      produces: [text/plain]
      parameters: [{name: f, in: formData, type: file, required: true}, {name: g, in: formData, type: string}, {$ref: '#/parameters/P'}]
      responses: {200: {description: ok, schema: {type: array, items: {$ref: '#/definitions/D'}}, headers: {H: {type: string}}}, 400: {$ref: '#/responses/E'}}
    put:
      parameters: [{name: b, in: body, required: true, description: all, schema: {$ref: '#/definitions/D'}}]
definitions: {D: {type: object}}
parameters: {P: {name: p, in: header, type: integer, maximum: 9}}
responses: {E: {description: bad}}
securityDefinitions: {b: {type: basic}, k: {type: apiKey, name: n, in: header}, o: {type: oauth2, flow: accessCode, authorizationUrl: a, tokenUrl: t, scopes: {r: read}}}
""")
    new = openapi.swagger_to_openapi(spec)
    assert new["servers"] == [{"url": "http://h.test/v1"}, {"url": "https://h.test/v1"}] and new["tags"] == [{"name": "t"}] and new["security"] == [{"k": []}]
    f = new["paths"]["/f"]
    assert f["parameters"] == [{"name": "x", "in": "query", "schema": {"type": "array", "items": {"type": "string"}}}]
    form = f["post"]["requestBody"]["content"]["application/x-www-form-urlencoded"]["schema"]
    assert form["properties"] == {"f": {"type": "file"}, "g": {"type": "string"}} and form["required"] == ["f"]
    assert f["post"]["parameters"] == [{"$ref": "#/components/parameters/P"}] and "produces" not in f["post"]
    assert f["post"]["responses"]["200"]["content"] == {"text/plain": {"schema": {"type": "array", "items": {"$ref": "#/components/schemas/D"}}}}
    assert f["post"]["responses"]["400"] == {"$ref": "#/components/responses/E"}
    assert f["put"]["requestBody"] == {"content": {"text/csv": {"schema": {"$ref": "#/components/schemas/D"}}}, "required": True, "description": "all"}
    assert new["components"]["parameters"]["P"]["schema"] == {"type": "integer", "maximum": 9}
    assert new["components"]["securitySchemes"] == {"b": {"type": "http", "scheme": "basic"}, "k": {"type": "apiKey", "name": "n", "in": "header"}, "o": {"type": "oauth2", "flows": {"authorizationCode": {"authorizationUrl": "a", "tokenUrl": "t", "scopes": {"r": "read"}}}}}
    assert spec["paths"]["/f"]["put"]["parameters"][0]["schema"]["$ref"] == "#/definitions/D"


def test_openapi_corpus(spark):
    a = "openapi: 3.0.0\npaths:\n  /x:\n    get:\n      responses:\n        '200':\n          content: {application/json: {schema: {$ref: 'm/b.yaml#/components/schemas/T'}}}\n        '404':\n          content: {application/json: {schema: {$ref: 'm/b.yaml#/components/schemas/None'}}}\n        default:\n          content: {application/json: {schema: {$ref: 'https://h/b.yaml#/definitions/T'}}}\n"
    b = "openapi: 3.0.0\ncomponents:\n  schemas:\n    T: {type: object}\n"
    rows = spark.createDataFrame([("j", "s/a.yaml", a), ("j", "s/m/b.yaml", b), ("k", "s/a.yaml", a), ("k", "s/bad.yaml", "openapi: [")], "job string, path string, text string")
    got = {(r["corpus"], r["spec_path"], r["relative_path"]): r for r in openapi.read_specs(rows, corpus="job").collect()}
    assert "| `200` |  | [T](../../m/b/schemas/T.md) |\n| `404` |  |  |\n| `default` |  |  |" in got["j", "s/a.yaml", "operations/get-x.md"]["body"]
    assert "[T]" not in got["k", "s/a.yaml", "operations/get-x.md"]["body"] and got["k", "s/bad.yaml", None]["error"]


def test_html():
    page = "<html><body><nav>no</nav><article><h2>Head</h2><p>a <b>b</b><br>c<p>d<ul><li>x<li>y</ul><pre class='language-py'>\nprint(1)\n</pre></article></body></html>"
    out = html.main_content(page)
    assert out.startswith("## Head") and "no" not in out.split()
    assert html.main_content("<article><ul><li>x</li><li>y</li></ul></article>") == "* x\n* y"
    assert html.main_content("<article><pre class='lang-Py'><code>a\n b</code></pre></article>") == "```py\na\n b\n```"
    grid = "<article><table><tr><th rowspan=2>a</th><th colspan=2>b</th></tr><tr><td>c</td><td>d|</td></tr></table></article>"
    assert html.main_content(grid) == "| a | b | b |\n| --- | --- | --- |\n| a | c | d\\| |"
    note = "<article><div class='note'><p class='title'>T</p><p>Mind it</p></div></article>"
    assert html.main_content(note) == "> **Note**\n>\n> Mind it"
    assert html.page_links('<base href="/x/"><a href="a#f">1</a><a href="http://10.0.0.1/">2</a><a href="mailto:q">3</a><a href="a">4</a>', "https://e.com/p") == ["https://e.com/x/a"]


def test_net():
    assert net.sitemap_urls(f'<urlset xmlns="{net.SITEMAP[1:-1]}"><url><loc> https://e/1 </loc><lastmod>2024</lastmod></url><url><loc/></url></urlset>') == [("https://e/1", "2024")]
    assert net.robots_sitemaps("User-agent: *\nSitemap: https://e/s.xml\n# Sitemap: no") == ["https://e/s.xml"]
    assert not net.robots_allow("User-agent: *\nDisallow: /x", "a", "https://e/x/1")
    for bad in ("ftp://e/", "http://metadata/x", "http://169.254.169.254/", "https://inner.test/"):
        with pytest.raises(net.PolicyError):
            net.check_sitemap_url(bad, lambda h: ["8.8.8.8", "10.0.0.1"])
    hops = {"https://a.test/": net.Response("https://a.test/", 302, None, b"", "http://127.0.0.1/")}
    with pytest.raises(net.PolicyError):
        net.fetch("https://a.test/", hops.__getitem__)


def test_frontmatter():
    assert markdown.parse_frontmatter("﻿---\r\na: 1\r\n---\r\nx") == ({"a": 1}, "x")
    assert markdown.parse_frontmatter("---\nbad: [\nk: 'v'\n---\nx")[0]["k"] == "v"
    assert markdown.parse_frontmatter("---\na: 1\n----\nx")[0] is None
    assert markdown.yaml_lines({"b": [], "a": {"x": True, "l": [1, "é"]}}) == ["a:", "  l:", "    - 1", '    - "é"', "  x: true", "b: []"]
    m = dict(zip(markdown.METRICS.names, markdown.measure("# A\n\n- x\n- y\n\n| a | b |\n|---|---|\n| 1 | 2 |\n\n```\n# no\n```\n\nB\n===\n"), strict=True))
    assert (m["heading_count"], m["list_item_count"], m["table_cell_count"], m["code_block_count"], m["table_count"]) == (2, 2, 4, 1, 1)


def test_configs(tmp_path, spark):
    (tmp_path / "a.yaml").write_text("sources:\n- {type: url, id: d, url: 'https://e.test/', max_depth: 2}\n- {type: nope}\n")
    (tmp_path / "b.yml").write_text("type: local_file\npaths: [z.md, a.md]\n")
    (tmp_path / "c.yml").write_text("a: [")
    rows = files.read_configs(spark, str(tmp_path))
    assert rows.where("error is not null").count() == 2
    keys = {r["source_key"] for r in files.staging_jobs(rows, "st").collect()}
    assert keys == {"manifest_url:d:https://e.test/:depth=2", "local_file:a.md,z.md"}
    toc = "- name: A\n  href: a.md\n- name: G\n  items:\n  - {name: B, href: ../b.md}\n  - {name: C, href: c.html}\n"
    assert [(e["target_path"], e["depth"]) for e in files.toc_entries(toc, "docs/TOC.yml")] == [("docs/a.md", 0), ("b.md", 1)]
    with pytest.raises(ValueError):
        files.contained(tmp_path, "../x")
    (tmp_path / "link").symlink_to("/tmp")
    with pytest.raises(ValueError):
        files.contained(tmp_path, "link/x")
    tree = spark.createDataFrame([(json.dumps({"tree": [{"path": "r.md", "type": "blob"}, {"path": "d/e.md", "type": "blob"}, {"path": "d", "type": "tree"}, {"path": "x.py", "type": "blob"}]}),)], "tree string")
    assert {r["path"] for r in files.repository_files(tree, "**/*.md").collect()} == {"r.md", "d/e.md"}


def test_process(spark, tmp_path):
    src = tmp_path / "src"
    (src / "inc").mkdir(parents=True)
    (src / "a.md").write_text("---\ntitle: Alpha\n---\n# Alpha\n\n[!INCLUDE [x](inc/i.md)]\n\n## S\n\n[b](b.md#x)\n")
    (src / "inc/i.md").write_text("included text\n")
    (src / "b.md").write_text("plain\n")
    (src / "p.html").write_text("<article><h1>P</h1><p>q</p></article>")
    (src / "w.docx").write_bytes(word_file())
    (src / "d.pdf").write_bytes(pdf_file(b"BT (pdf text) Tj ET"))
    (src / "api.yaml").write_text(SPEC)
    (src / "bad.docx").write_bytes(b"nope")
    (src / "skip.png").write_bytes(b"x")
    rows = files.local_tree(spark, str(src), ["**/*"], ["**/*.tmp"])
    staged = rows.select(F.lit("0123456789abcdef").alias("job_id"), F.lit("manifest_local:t:.:*").alias("source"), "relative_path", "content")
    docs = {r["output_path"]: r for r in process(staged).collect()}
    assert {"a.md", "b.md", "inc/i.md", "p.md", "d.md", "api/operations/make.md", "api/schemas/Kind.md", "w/part-0001.md"} <= set(docs)
    a = docs["a.md"]
    assert a["title"] == "Alpha" and "included text" in a["document"] and '<a id="chunk-0001"></a>\n# Alpha' in a["document"]
    assert [l["target_path"] for l in a["links"]] == ["b.md"]
    assert docs["bad.md"]["error"] and "pdf text" in docs["d.md"]["document"]
    assert docs["w/part-0001.md"]["media"] == ["w/media/figure-0001.png"]
    assert sorted(r["ingest_order"] for r in docs.values()) == list(range(len(docs)))
    out = tmp_path / "out"
    told = cli.ingest(str(src), str(out), ["**/*.md"])
    assert told["success"] and told["documents"] == 3 and (out / "a.md").read_text().startswith("---\ncontent_sha256: ")
    assert sinks.redact({"a": {"Token": 1, "b": [{"password": 2, "c": 3}]}}) == {"a": {"b": [{"c": 3}]}}
    assert "&lt;b&gt;" in sinks.viewer([{"reason": "<b>"}])
    assert json.loads(sinks.frontmatter_schema())["required"]


def test_crawl(spark):
    page = lambda *links: "<html>" + "".join(f'<a href="{l}">x</a>' for l in links) + "</html>"
    web = [
        ("https://e.test/d/index.html", page("a", "b?utm_x=1", "/out", "https://o.test/", "print.html", "gone"), None),
        ("https://e.test/d/a", page("c"), None),
        ("https://e.test/d/b", page("a"), None),
        ("https://e.test/d/c", page(), "https://e.test/d/a"),
        ("https://e.test/d/print.html", page("p2"), None),
        ("https://e.test/d/p2", page(), None),
        ("https://e.test/out", page(), None),
    ]
    table = spark.createDataFrame([(u, b, "text/html", f) for u, b, f in web], "url string, body string, content_type string, final_url string")
    got = [(r["url"].rsplit("/", 1)[-1], r["depth"], r["skip_reason"]) for r in crawl(spark, web[0][0], table, CrawlRules(max_pages=10, max_depth=2)).orderBy("crawl_order").collect()]
    assert got == [("index.html", 0, None), ("a", 1, None), ("b?utm_x=1", 1, None), ("gone", 1, "missing"), ("p2", 2, None)] or got[1][0] == "a"
    assert crawl(spark, web[0][0], table, CrawlRules(max_pages=2, max_depth=2)).count() == 2
    with pytest.raises(ValueError):
        crawl(spark, "http://localhost/", table)


def test_triage(spark):
    pages = [(1, i, 6, "good text " * 40 if i != 3 else "", 1, False, [0.0]) for i in range(6)] + [(2, 0, 1, "", 2, True, [0.0])]
    df = spark.createDataFrame(pages, "doc_id int, page_index int, total_pages int, text string, images int, has_widgets boolean, xs array<double>")
    data = spark.createDataFrame([(1, bytearray(b"one")), (2, bytearray(b"two"))], "doc_id int, content binary")

    def engine(content: bytes, first: int, last: int, ocr: bool) -> list[str]:
        if content == b"two":
            raise RuntimeError("no")
        return [f"better {i}" for i in range(first, last + 1)]

    got = {(r["doc_id"], r["page_index"]): r for r in triage(df, data, engine).collect()}
    assert [got[1, i]["engine"] for i in range(6)] == ["heuristic", "heuristic", "layout", "layout", "layout", "heuristic"]
    assert got[1, 3]["text"] == "better 3" and got[2, 0]["engine"] == "heuristic"
    stats = {r["doc_id"]: r["pages_repaired"] for r in triage_statistics(triage(df, data, engine)).collect()}
    assert stats == {1: 3, 2: 0}
    whole = spark.createDataFrame([(1, bytearray(b"one"), 10, False), (2, bytearray(b"two"), 3, True)], "doc_id int, content binary, total_pages int, needs_ocr boolean")
    out = {r["doc_id"]: r for r in chunked(whole, engine, max_pages=4, overlap=1).collect()}
    assert "better 0" in out[1]["body"] and not out[1]["error"] and "RuntimeError" in out[2]["error"]


def test_runtime():
    import io

    from foliary import runtime

    assert runtime.available("transcript") and runtime.available("configuration") and not runtime.installed("no_such_library")
    if not runtime.available("layout"):
        with pytest.raises(runtime.MissingDependency):
            runtime.require("layout")
    runtime.require("html")
    out, heard = io.StringIO(), []
    p = runtime.Progress(3, out, lambda *x: heard.append(x))
    assert list(p.over(["a", "b\x00", "c"])) == ["a", "b\x00", "c"]
    assert heard == [(1, 3, "a"), (2, 3, "b "), (3, 3, "c")] and p.percent == 100
    assert out.getvalue().splitlines() == ["[ 33%] 1/3 a", "[ 67%] 2/3 b", "[100%] 3/3 c"]
    p.log("note")
    assert out.getvalue().endswith("note\n") and runtime.Progress(0, out).percent == 100
    nearly = runtime.Progress(1000, out, done=999)
    assert nearly.percent == 99


def test_listed_files(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a/x.md").write_text("x")
    (tmp_path / "y.txt").write_text("yy")
    got = {(r["relative_path"], r["length"], bytes(r["content"])) for r in files.listed_files(spark, [f"{tmp_path}/a/x.md", f"{tmp_path}/y.txt"]).collect()}
    assert got == {("x.md", 1, b"x"), ("y.txt", 2, b"yy")}


def test_recognition_credentials():
    from foliary.sources import recognition as r

    hosted, direct = dict(zip(r.HOSTED, ("hk", "https://h/"), strict=True)), {r.DIRECT_KEY: " dk "}
    assert r.credentials({}, "k", "https://e/") == ("k", "https://e/")
    assert r.credentials(hosted | direct) == ("hk", "https://h/") and r.credentials(hosted, endpoint="https://x/") == ("hk", "https://x/")
    assert r.credentials(direct) == ("dk", r.DIRECT_ENDPOINT)
    for env, more in (({}, {}), ({r.HOSTED[0]: "k"}, {}), (direct, {"endpoint": "http://x/"})):
        with pytest.raises(r.CredentialError):
            r.credentials(env, **more)


def test_layout_engine():
    import pickle

    from foliary.sources import layout

    assert layout.thread_settings(0, {"OMP_NUM_THREADS": "9"}) == {"MKL_NUM_THREADS": "1", "OPENBLAS_NUM_THREADS": "1", "TOKENIZERS_PARALLELISM": "false"}
    assert layout.device(None) is layout.device(" Auto ") is None and layout.device("CUDA") == "cuda"
    with pytest.raises(ValueError):
        layout.device("abacus")
    engine = layout.LayoutEngine(stand_in_converter)
    assert engine(b"x", 0, 4, True) == ["x (1, 5) True 2.0"] and engine(b"x", 2, 2, False, 1.0) == ["x (3, 3) False 1.0"]
    assert engine(b"", 0, 0, True) == [] and engine.whole(b"y") == ["y None True 2.0"]
    assert engine.with_pictures(b"z") == ("z None True 2.0", [b"PNG"])
    assert len(engine.made) == 3 and not pickle.loads(pickle.dumps(engine)).made


def stand_in_converter(ocr, scale, pictures):
    class Image:
        def __init__(self, good):
            self.good = good

        def save(self, out, format):
            if not self.good:
                raise OSError
            out.write(format.encode())

    class Holder:
        def __init__(self, good):
            self.image = Image(good)

    class Document:
        def __init__(self, said):
            self.said, self.pictures = said, [Holder(True), Holder(False)] if pictures else None

        def export_to_markdown(self):
            return self.said

    return lambda content, pages: Document(f"{content.decode()} {pages} {ocr} {scale}\n" if content else " ")


def test_yaml_is_read_as_by_pyyaml():
    texts = ["a: &x {b: 1, c: [1.5, ~, yes, 2024-01-01, '5']}\nd: {<<: *x, e: 0x1f}\n200: *x\n", "a: !!set {b, c}\n", "a: !!binary aGk=\n", "", "- 7\n", "=: 1\n", "a: |\n  b\n"]
    assert [yamls.safe_load(t) for t in texts] == [yaml.safe_load(t) for t in texts]
    loop = yamls.safe_load("a: &r [*r]")["a"]
    assert loop[0] is loop
    for bad in ("a: [", "a: *no", "? {a: 1}\n: 2\n", "!x a"):
        with pytest.raises(yaml.YAMLError):
            yamls.safe_load(bad)
    with pytest.raises(openapi.SpecError, match="nested too deeply"):
        openapi.load("[" * 100_000 + "]" * 100_000)


def test_a_specification_is_parsed_once(monkeypatch):
    calls = []
    monkeypatch.setattr(openapi, "safe_load", lambda t: calls.append(t) or yaml.safe_load(t))
    openapi.documents(SPEC, "specs/api.yaml")
    assert calls == [SPEC]


def test_texts_that_may_ask_for_other_files(spark):
    near = ["a: {$ref: '#/x'}", '{"$ref": "#/x"}', "a: 1", "b: {$ref : \"#/x\"}"]
    far = ["a: {$ref: 'f.yaml#/x'}", "a: {$ref: f.yaml#/x}", "a: {$ref: '#/x'}\nb: {$ref: g.yaml}", r'{"$ref": "f.yaml#/x"}', "&k $ref: '#/x'\nb: {*k : f.yaml}", "? $ref\n: f.yaml#/x", "a: {$ref: *v}"]
    rows = spark.createDataFrame([(t, t in far) for t in near + far], "t string, far boolean").select("far", openapi._may_ask(F.col("t")).alias("may"))
    assert [r for r in rows.collect() if r["far"] != r["may"]] == []


def test_a_job_staged_twice_is_two_jobs(spark):
    job = "0123456789abcdef"
    told = lambda done: json.dumps({"job_id": job, "complete": done, "metadata": {"source": "s"}}).encode()
    found = [(f"file:/{a}/01/{job}/{n}", len(c), c) for a, n, c in (("a", "metadata.json", told(True)), ("a", "x.md", b"1"), ("b", "metadata.json", told(True)), ("b", "sub/y.md", b"2"), ("c", "metadata.json", told(False)), ("c", "z.md", b"3"))]
    done = files.completed_jobs(spark.createDataFrame(found, "path string, length bigint, content binary"))
    assert sorted((r["relative_path"], bytes(r["content"])) for r in done.collect()) == [("sub/y.md", b"2"), ("x.md", b"1")]


def test_many_small_files_are_few_tasks(spark, tmp_path):
    for i in range(1200):
        (tmp_path / f"{i}.md").write_text(f"# {i}\n")
    found = files.tree_files(spark, f"file://{tmp_path}")
    assert found.rdd.getNumPartitions() <= 4 * spark.sparkContext.defaultParallelism
    assert found.agg(F.sum("length"), F.count_distinct("content")).first()[:] == (sum(len(f"# {i}\n") for i in range(1200)), 1200)


def test_texts_without_includes_are_passed_on(spark):
    docs = spark.createDataFrame([("a.md", "plain"), ("b.md", "x [!INCLUDE [i](a.md)] y"), ("c.md", "[!INCLUDE [i](gone.md)]"), ("d.md", "")], "rel_path string, body string")
    out = links.expand_includes(docs, docs.select("rel_path", F.col("body").alias("content")))
    got = {r["rel_path"]: (r["body"], r["resolved"], r["missing"]) for r in out.collect()}
    assert got == {"a.md": ("plain", 0, 0), "b.md": ("x plain y", 1, 0), "c.md": ("<!-- missing include: gone.md -->", 0, 1), "d.md": ("", 0, 0)}


def test_a_tree_without_known_kinds_has_no_documents(spark):
    rows = spark.createDataFrame([("j", "s", "x.png", b"1")], "job_id string, source string, relative_path string, content binary")
    assert process(rows).count() == 0


@pytest.mark.parametrize("plan", [lambda df: pdf.read_pdf(df.selectExpr("doc_id as path", "cast(text as binary) as content")), triage_report])
def test_texts_go_to_workers_in_small_batches(spark, plan):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, 64 << 20)
    try:
        plan(spark.createDataFrame([("d", 0, "x", 0, False, [0.0])], "doc_id string, page_index int, text string, images int, has_widgets boolean, xs array<double>"))
        assert int(spark.conf.get(key)) <= 4 << 20
    finally:
        spark.conf.set(key, before)


def test_pages_are_numbered_without_their_texts(spark, sf_dir):
    plan = queries_runs._pages(spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    numbering = [line for line in plan[plan.index("Window") :].splitlines() if "Relation" not in line]
    assert "text#" not in "".join(numbering)


def test_what_a_dead_attempt_leaves_is_not_read(spark, tmp_path):
    rows = spark.createDataFrame([("a/x.md", "1")], "output_path string, document string")
    (tmp_path / "a" / "x.md").mkdir(parents=True)  # the move fails, as the target is a folder
    (tmp_path / "a" / "x.md" / "in.md").write_text("2")
    with pytest.raises(Exception):
        sinks.write_documents(rows, f"file://{tmp_path}").collect()
    assert [p.name for p in (tmp_path / "a").iterdir() if p.is_file()] and all(p.name.startswith(".") for p in (tmp_path / "a").iterdir() if p.is_file())
    assert [r["path"].rsplit("/", 1)[-1] for r in files.tree_files(spark, f"file://{tmp_path}").collect()] == ["in.md"]
