"""Queries over files that are made of table columns inside the query, and read back: HTML, Word, PDF, specifications, sitemaps, robots, Markdown."""

from __future__ import annotations

import base64
import io
import json
import zipfile

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliary.functions import guards, ids, scores, text, urls
from foliary.operators import corpus, ranges
from foliary.plans.tables import Registry, table
from foliary.sources import docx, files, html, markdown, net, openapi, pdf, recognition

_register = Registry()
QUERIES, ORACLE_SQL = _register.queries, _register.sql


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def _filled(template: str) -> Column:
    """A text with {id} and {lang} of the row."""
    out: list[Column] = []
    for k, piece in enumerate(template.replace("{id}", "\0i\0").replace("{lang}", "\0l\0").split("\0")):
        out.append(F.lit(piece) if k % 2 == 0 else F.col("doc_id").cast("string") if piece == "i" else F.col("lang"))
    return F.concat(*out)


def _sql(template: str) -> str:
    """The same as a DuckDB expression."""
    quoted = "'" + template.replace("'", "''").replace("\n", "' || chr(10) || '") + "'"
    return "(" + quoted.replace("{id}", "' || doc_id || '").replace("{lang}", "' || lang || '") + ")"


# --- HTML ------------------------------------------------------------------------------------

_PAGE = """<html><body><nav>n</nav><header>h</header><div class="navheader">x</div><article><h2>T{id}</h2><script>s</script><p>Para <b>bold</b> {lang}</p>
<table><tr><th rowspan="2">a{id}</th><th colspan="2">b|c</th></tr><tr><td>d</td><td>e</td></tr><tr><td>f</td></tr></table><dl><dt>t</dt><dd>said</dd></dl>
<pre class="lang-PY">x = {id}
</pre><img src="i.png" alt="al"><ul><li>one</li><li>two</li></ul><div class="warning"><p class="title">W</p><p>care</p></div><h4></h4><aside>no</aside></article><footer>f</footer></body></html>"""
_SHOWN = "## T{id}\n\nPara bold {lang}\n\n| a{id} | b\\|c | b\\|c |\n| --- | --- | --- |\n| a{id} | d | e |\n| f |  |  |\n\n**t**\n\nsaid\n\n```py\nx = {id}\n```\n\n![al](i.png)\n\n* one\n* two\n\n> **Warning**\n>\n> care"


@_register(f"select doc_id, {_sql(_SHOWN)} as markdown from documents")
def html_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _docs(spark, sf_dir).select("doc_id", html.html_to_markdown(_filled(_PAGE)).alias("markdown"))


_BOOK = '<body><p>out</p><div class="sect1 x"><h1>B{id}</h1><div class="note"><p>mind</p></div><table></table><pre><code class="language-c++">y</code></pre></div></body>'


@_register(f"select doc_id, case when doc_id % 2 = 0 then {_sql('# B{id}' + chr(10) * 2 + '> **Note**' + chr(10) + '>' + chr(10) + '> mind' + chr(10) * 2 + '```c++' + chr(10) + 'y' + chr(10) + '```')} else {_sql('plain {lang}')} end as markdown from documents")
def html_main_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    page = F.when(F.col("doc_id") % 2 == 0, _filled(_BOOK)).otherwise(_filled("<main>plain {lang}</main><p>rest</p>"))
    return _docs(spark, sf_dir).select("doc_id", html.html_to_markdown(page).alias("markdown"))


# --- Word ------------------------------------------------------------------------------------

_W = "http://schemas.openxmlformats.org/wordprocessingml/2006/main"
_WORD = """<w:document xmlns:w="{w}" xmlns:a="http://schemas.openxmlformats.org/drawingml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><w:body>
<w:p><w:pPr><w:pStyle w:val="Heading1"/></w:pPr><w:r><w:t>Doc {id}</w:t></w:r></w:p>{items}<w:p><w:r><w:t>in {lang}</w:t></w:r></w:p>
<w:tbl><w:tr><w:tc><w:p><w:r><w:t>k|{id}</w:t></w:r></w:p></w:tc><w:tc><w:p/></w:tc></w:tr><w:tr><w:tc><w:p><w:r><w:t>v</w:t></w:r></w:p></w:tc></w:tr></w:tbl>
<w:p><w:drawing><a:blip r:embed="r1"/><a:blip r:embed="r2"/></w:drawing></w:p></w:body></w:document>"""
_ITEM = '<w:p><w:pPr><w:numPr><w:ilvl w:val="{level}"/><w:numId w:val="{number}"/></w:numPr></w:pPr><w:r><w:t>{said}</w:t></w:r></w:p>'


@F.pandas_udf(T.BinaryType())
def word_file(doc_id: pd.Series, lang: pd.Series) -> pd.Series:
    """A Word file with a heading, numbered and bulleted lists, a table and two image relations of which one leaves the archive."""
    numbering = "".join(f'<w:abstractNum w:abstractNumId="{n}"><w:lvl w:ilvl="0"><w:numFmt w:val="{f}"/></w:lvl></w:abstractNum><w:num w:numId="{n}"><w:abstractNumId w:val="{n}"/></w:num>' for n, f in ((1, "decimal"), (2, "bullet")))
    relations = '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="r1" Target="media/x.PNG"/><Relationship Id="r2" Target="../../etc/x.png"/></Relationships>'
    items = "".join(_ITEM.format(level=l, number=n, said=s) for n, l, s in ((1, 0, "one"), (1, 1, "deep"), (1, 0, "two"), (2, 0, "dot")))

    def one(i, l) -> bytes:
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w") as z:
            z.writestr("word/document.xml", _WORD.format(w=_W, id=i, lang=l, items=items))
            z.writestr("word/numbering.xml", f'<w:numbering xmlns:w="{_W}">{numbering}</w:numbering>')
            z.writestr("word/_rels/document.xml.rels", relations)
            z.writestr("word/media/x.PNG", f"PNG{i}")
        return out.getvalue()

    return pd.Series([one(i, l) for i, l in zip(doc_id, lang, strict=True)])


_TOLD = "# Doc {id}\n\n1. one\n  1. deep\n2. two\n\n- dot\n\nin {lang}\n\n| k\\|{id} |  |\n| --- | --- |\n| v |  |\n\n![](media/figure-0001.png)"


@_register(f"select doc_id, {_sql(_TOLD)} as body, 'figure-0001.png' as name, 'image/png' as mime, sha256('PNG' || doc_id) as media_sha256 from documents")
def docx_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = docx.read_docx(_docs(spark, sf_dir).select(F.col("doc_id").cast("string").alias("path"), word_file("doc_id", "lang").alias("content")))
    return rows.select(F.col("path").cast("bigint").alias("doc_id"), "body", F.explode("media").alias("m")).select("doc_id", "body", "m.name", "m.mime", F.sha2("m.data", 256).alias("media_sha256"))


@_register("select doc_id, case when doc_id % 2 = 0 then 'no ZIP signature' else 'damaged ZIP archive' end as error from documents")
def docx_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files that are no Word files, and damaged ones: each gives a row with the reason."""
    content = F.concat(F.when(F.col("doc_id") % 2 == 0, "xx").otherwise("PK"), F.col("text")).cast("binary")
    return docx.read_docx(_docs(spark, sf_dir).select(F.col("doc_id").cast("string").alias("path"), content.alias("content"))).select(F.col("path").cast("bigint").alias("doc_id"), "error")


# --- PDF -------------------------------------------------------------------------------------


def _pdf(*streams: Column) -> Column:
    parts = [F.lit("%PDF-1.4\n")] + [x for s in streams for x in (F.lit("1 0 obj << /Length 1 >> stream\n"), s, F.lit("\nendstream endobj\n"))]
    return F.concat(*parts).cast("binary")


@_register(r"""
with p as (select doc_id, trim(regexp_replace(text, '[^\x20-\x7e]', ' ', 'g'), ' ') as said from documents)
select doc_id, 0 as page_index, 2 as total_pages, '# Doc ' || doc_id || case when said <> '' then chr(10) || said else '' end as text from p
union all select doc_id, 1, 2, 'Hello world' from p
""")
def pdf_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents set as content streams in the query (literal, array and hexadecimal text), then read by the built-in reader."""
    body = F.regexp_replace(F.regexp_replace("text", r"([\\()])", r"\\$1"), "[^\\x20-\\x7e]", " ")
    first = F.concat(F.lit("BT /F1 18 Tf (Doc "), F.col("doc_id").cast("string"), F.lit(") Tj /F1 10 Tf ("), body, F.lit(") Tj ET"))
    rows = _docs(spark, sf_dir).select(F.col("doc_id").cast("string").alias("path"), _pdf(first, F.lit("BT /F1 10 Tf [(Hel) -20 (lo)] TJ <776F726C64> Tj ET")).alias("content"))
    return pdf.read_pdf(rows, "heuristic").select(F.col("path").cast("bigint").alias("doc_id"), "page_index", "total_pages", "text")


@_register("select doc_id, case doc_id % 3 when 0 then 'layout ' || doc_id when 1 then 'built in' end as text, doc_id % 3 = 2 as failed from documents")
def pdf_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With an engine that reads a third of the files: the built-in reader takes over for "auto", and what is no PDF fails."""
    d = F.col("doc_id")
    good = _pdf(F.concat(F.lit("BT (built in) Tj ET % page "), d.cast("string")))
    content = F.when(d % 3 == 0, F.concat(F.lit("%PDF layout "), d.cast("string")).cast("binary")).when(d % 3 == 1, good).otherwise(F.lit("text").cast("binary"))
    rows = pdf.read_pdf(_docs(spark, sf_dir).select(d.cast("string").alias("path"), content.alias("content")), "auto", engines={"layout": _some_layout})
    return rows.select(F.col("path").cast("bigint").alias("doc_id"), "text", F.col("error").isNotNull().alias("failed"))


def _some_layout(data: bytes) -> list[str]:
    if not data.startswith(b"%PDF layout"):
        raise RuntimeError("not for this engine")
    return [data[5:].decode()]


def some_service(address: str, headers: dict, body: dict) -> tuple[int, str]:
    """Answers by the last digit of the file: pages, a refusal, a fault, or no JSON."""
    said = base64.b64decode(body["document"]["document_url"].rpartition(",")[2]).decode()
    if address != "https://hosted.test/ocr" or headers["Authorization"] != "Bearer given":
        return 401, "wrong credentials"
    pages = {"pages": [{"markdown": f"# {said}"}, {"markdown": body["model"]}]}
    return {"7": (401, "no"), "8": (503, "busy"), "9": (200, "<html>")}.get(said[-1], (200, json.dumps(pages)))


@_register("""
select doc_id, case when doc_id % 10 < 7 then '# f' || doc_id || chr(10) || chr(10) || 'own-model' end as body, case when doc_id % 10 < 7 then 2 end as pages,
 case doc_id % 10 when 7 then 'CredentialError: refused: no' when 8 then 'RecognitionError: status 503: busy' when 9 then 'RecognitionError: no JSON: <html>' end as error from documents
""")
def recognised_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files through a stand-in service; a key that is given goes before that of the hosted deployment, whose address is used."""
    env = {"AZURE_AI_FOUNDRY_KEY": "k", "AZURE_AI_FOUNDRY_ENDPOINT": "https://hosted.test/ocr", "MISTRAL_API_KEY": "d", "MISTRAL_OCR_MODEL": "own-model"}
    rows = _docs(spark, sf_dir).select(F.col("doc_id").cast("string").alias("path"), _filled("f{id}").cast("binary").alias("content"))
    return recognition.recognise(rows, some_service, env, key="given").select(F.col("path").cast("bigint").alias("doc_id"), "body", "pages", "error")


# --- specifications --------------------------------------------------------------------------

_OPERATION = """openapi: 3.0.1
paths:
  /t/{id}:
    post:
      summary: Make {lang}
      description: Long
      parameters:
        - {name: k, in: path, required: true, schema: {type: integer, format: int64}, description: 'a|b'}
        - $ref: '#/components/parameters/p~1q'
      requestBody: {required: true, content: {text/csv: {schema: {type: array, items: {$ref: '#/components/schemas/T'}}}, application/json: {schema: {$ref: '#/components/schemas/T'}}}}
      responses:
        default: {description: other}
        '404': {description: none}
        '200': {description: fine, content: {application/json: {schema: {oneOf: [{$ref: '#/components/schemas/T'}, {type: string}]}}}}
      security: [{key: []}, {oauth: [read, write]}]
      x-ms-pageable: {nextLinkName: next}
components:
  parameters:
    p/q: {name: f, in: query, schema: {enum: [1]}}
  schemas:
    T: {type: object, description: A T, required: [n], properties: {n: {type: string, description: Name}, t: {$ref: '#/components/schemas/T'}}}
    E: {type: string, enum: [x, y]}
    C: {allOf: [{$ref: '#/components/schemas/T'}, {properties: {}}]}
"""
_BODIES = (
    "# POST /t/{id}\n\nMake {lang}\n\nLong\n\n## Parameters\n\n| Name | In | Type | Required | Description |\n| --- | --- | --- | --- | --- |\n| `k` | path | integer (int64) | yes | a\\|b |\n| `f` | query | enum | no |  |\n\n"
    "## Request body\n\nRequired: yes\n\n| Content type | Schema |\n| --- | --- |\n| `application/json` | [T](../schemas/T.md) |\n| `text/csv` | array of [T](../schemas/T.md) |\n\n"
    "## Responses\n\n| Status | Description | Schema |\n| --- | --- | --- |\n| `200` | fine | [T](../schemas/T.md) \\| string |\n| `404` | none |  |\n| `default` | other |  |\n\n"
    "## Security\n\n- `key`\n- `oauth` (read, write)\n\n## Pagination\n\nPageable: yes\n\n- Next-page field: `next`",
    "# T\n\nA T\n\nType: object\n\n## Properties\n\n| Name | Type | Required | Description |\n| --- | --- | --- | --- |\n| `n` | string | yes | Name |\n| `t` | [T](T.md) | no |  |",
    "# E\n\nType: string\n\n## Values\n\n- `x`\n- `y`",
    "# C\n\n## Composition (allOf)\n\n- [T](T.md)\n- object",
)


@_register(f"select doc_id, unnest([0, 1, 2, 3]) as seq, unnest([{', '.join(map(_sql, _BODIES))}]) as body from documents")
def openapi_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = openapi.read_specs(_docs(spark, sf_dir).select(F.col("doc_id").cast("string").alias("path"), _filled(_OPERATION).alias("text")))
    return rows.select(F.col("spec_path").cast("bigint").alias("doc_id"), "seq", "body")


_SWAGGER = """swagger: '2.0'
consumes: [text/csv]
paths:
  /s/{id}:
    get:
      operationId: g {lang}
      parameters: [{name: q, in: query, type: array, items: {type: string}}]
      responses: {200: {description: d, schema: {$ref: '#/definitions/A'}}}
    post:
      parameters: [{name: b, in: body, required: true, schema: {$ref: '#/definitions/A'}}]
      responses: {}
    put:
      parameters: [{name: u, in: formData, type: file}]
      responses: {}
definitions: {A: {type: array, items: {type: integer}}}
"""
_CONVERTED = (
    "# GET /s/{id}\n\n## Parameters\n\n| Name | In | Type | Required | Description |\n| --- | --- | --- | --- | --- |\n| `q` | query | array of string | no |  |\n\n## Responses\n\n| Status | Description | Schema |\n| --- | --- | --- |\n| `200` | d | [A](../schemas/A.md) |",
    "# PUT /s/{id}\n\n## Request body\n\nRequired: no\n\n| Content type | Schema |\n| --- | --- |\n| `application/x-www-form-urlencoded` | object |",
    "# POST /s/{id}\n\n## Request body\n\nRequired: yes\n\n| Content type | Schema |\n| --- | --- |\n| `text/csv` | [A](../schemas/A.md) |",
    "# A\n\nType: array",
)


@_register(f"select doc_id, unnest(['operations/g-' || lang || '.md', 'operations/put-s-' || doc_id || '.md', 'operations/post-s-' || doc_id || '.md', 'schemas/A.md']) as place, unnest([{', '.join(map(_sql, _CONVERTED))}]) as body from documents")
def openapi_swagger(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = openapi.read_specs(_docs(spark, sf_dir).select(F.col("doc_id").cast("string").alias("path"), _filled(_SWAGGER).alias("text")))
    return rows.select(F.col("spec_path").cast("bigint").alias("doc_id"), F.col("relative_path").alias("place"), "body")


_ASKING = "openapi: 3.0.0\ncomponents:\n  schemas:\n    S{id}: {properties: {near: {$ref: 'd{next}.yaml#/components/schemas/S{next}'}, none: {$ref: 'd{next}.yaml#/components/schemas/Gone'}, far: {$ref: 'https://h/x.yaml#/definitions/S'}, out: {$ref: '../../x.yaml#/definitions/S'}}}\n"


@_register("""
select a.doc_id, 'api/d' || a.doc_id || '.yaml' as spec_path, case when b.doc_id is not null then '| `near` | [S' || b.doc_id || '](../../d' || b.doc_id || '/schemas/S' || b.doc_id || '.md) | no |  |' else '| `near` |  | no |  |' end as near,
  '| `none` |  | no |  |' as gone, '| `far` |  | no |  |' as far, '| `out` |  | no |  |' as beyond
from documents a left join documents b on b.doc_id = a.doc_id + 1
""")
def openapi_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each specification names a schema of the next one's file: there the link is a join."""
    d = F.col("doc_id")
    text_ = F.replace(_filled(_ASKING), F.lit("{next}"), (d + 1).cast("string"))
    rows = openapi.read_specs(_docs(spark, sf_dir).select(F.concat(F.lit("api/d"), d.cast("string"), F.lit(".yaml")).alias("path"), text_.alias("text")))
    line = lambda n: F.get(F.split("body", "\n"), F.lit(n))
    at = F.array_position(F.split("body", "\n"), "| --- | --- | --- | --- |").cast("int")
    told = [F.get(F.split("body", "\n"), at + k).alias(n) for k, n in enumerate(("near", "gone", "far", "beyond"))]
    return rows.select(F.regexp_extract("spec_path", r"(\d+)", 1).cast("bigint").alias("doc_id"), "spec_path", *told)


@_register("select doc_id, case doc_id % 4 when 0 then 'leads back to itself' when 1 then 'nothing at' when 2 then 'not a mapping' else 'not YAML' end as reason from documents")
def openapi_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Circles of references, references to nothing, and texts that are no specification."""
    spec = "openapi: 3.0.0\npaths: {/x: {get: {requestBody: {$ref: '#/components/requestBodies/a'}}}}\ncomponents: {requestBodies: {%s}}\n"
    kinds = F.array(F.lit(spec % "a: {$ref: '#/components/requestBodies/b'}, b: {$ref: '#/components/requestBodies/a'}"), F.lit(spec % "c: {}"), F.lit("- openapi"), F.lit("openapi: ["))
    rows = openapi.read_specs(_docs(spark, sf_dir).select(F.col("doc_id").cast("string").alias("path"), F.get(kinds, (F.col("doc_id") % 4).cast("int")).alias("text")))
    return rows.select(F.col("spec_path").cast("bigint").alias("doc_id"), F.regexp_extract("error", "(leads back to itself|nothing at|not a mapping|not YAML)", 1).alias("reason"))


# --- network ---------------------------------------------------------------------------------


@_register("select page_id, case page_id % 4 when 0 then true when 1 then page_id % 3 > 0 when 2 then false else true end as allowed from pages")
def robots_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = F.col("page_id")
    rules = F.get(F.array(F.lit(None).cast("string"), F.lit("User-agent: *\nDisallow: /private\n"), F.lit("User-agent: foliary\nDisallow: /\n\nUser-agent: *\nAllow: /\n"), F.lit("User-agent: other\nDisallow: /\n")), (p % 4).cast("int"))
    url = F.concat(F.lit("https://e.test/"), F.when(p % 3 == 0, "private/").otherwise("open/"), p.cast("string"))
    return table(spark, sf_dir, "pages").select("page_id", net.robots_allowed(rules, url, "foliary").alias("allowed"))


@_register("""
select page_id, 'url' as kind, url as loc, '2024-01-0' || (1 + page_id % 9) as lastmod, false as failed from pages where page_id % 3 = 0
union all select page_id, 'sitemap', 'https://e.test/' || page_id || '.xml', null, false from pages where page_id % 3 = 1
union all select page_id, null, null, null, true from pages where page_id % 3 = 2
""")
def sitemap_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    p, ns = F.col("page_id"), 'xmlns="http://www.sitemaps.org/schemas/sitemap/0.9"'
    escaped = F.replace(F.col("url"), F.lit("&"), F.lit("&amp;"))
    day = F.concat(F.lit("2024-01-0"), (p % 9 + 1).cast("string"))
    set_ = F.concat(F.lit(f"<urlset {ns}><url><loc> "), escaped, F.lit(" </loc><lastmod>"), day, F.lit("</lastmod></url><url><loc/></url></urlset>"))
    index = F.concat(F.lit(f"<sitemapindex {ns}><sitemap><loc>https://e.test/"), p.cast("string"), F.lit(".xml</loc></sitemap></sitemapindex>"))
    xml = F.when(p % 3 == 0, set_).when(p % 3 == 1, index).otherwise('<!DOCTYPE x [<!ENTITY e "x">]><urlset/>')
    return net.read_sitemaps(table(spark, sf_dir, "pages").select("page_id", xml.alias("xml")), "page_id").select("page_id", "kind", "loc", "lastmod", F.col("error").isNotNull().alias("failed"))


@_register("select page_id, case page_id % 6 when 0 then true when 5 then true else false end as safe from pages")
def sitemap_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Public addresses pass; one private address among several, metadata hosts, no address and other schemes do not."""
    p = (F.col("page_id") % 6).cast("int")
    url = F.get(F.array(*[F.lit(x) for x in ("https://e.test/s.xml", "https://e.test/s.xml", "http://metadata.google.internal/", "https://gone.test/", "ftp://e.test/", "http://93.184.216.34/s.xml")]), p)
    found = F.when(p == 0, F.array(F.lit("93.184.216.34"))).when(p == 1, F.array(F.lit("93.184.216.34"), F.lit("10.0.0.8"))).when(p == 2, F.array(F.lit("93.184.216.34")))
    return table(spark, sf_dir, "pages").select("page_id", net.sitemap_safe(url, found).alias("safe"))


@_register("select doc_id, least(0.5 * pow(2, doc_id % 10), 60.0) as wait_s from documents")
def retry_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _docs(spark, sf_dir).select("doc_id", urls.backoff_seconds(F.col("doc_id") % 10, 0.5).alias("wait_s"))


@_register("select doc_id, case doc_id % 4 when 0 then 'a/b/x' || doc_id || '.md' when 1 then 'a/x' || doc_id || '.md' when 2 then 'x' || doc_id || '.md' else 'abs/x' || doc_id || '.md' end as target from documents")
def relative_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.col("doc_id")
    link = F.concat(F.get(F.array(F.lit("./"), F.lit("../"), F.lit("../../../../"), F.lit("/abs/")), (d % 4).cast("int")), F.lit("x"), d.cast("string"), F.lit(".md"))
    return _docs(spark, sf_dir).select("doc_id", ids.resolve_relative(F.lit("a/b/c.md"), link).alias("target"))


@_register("select event_id, cast(case when event_id % 3 = 0 then 8 else greatest(1, least(floor(((1 + event_id % 64) * 600.0 - 1412.84) / (15.4942 * (0.5 + event_id % 7) * 4)), floor(((1 + event_id % 64) * 600.0 - 1412.84) / 207.0))) end as int) as cap from events")
def resolved_caps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages per group from memory and page size; the fixed cap where memory is unknown."""
    e = F.col("event_id")
    return table(spark, sf_dir, "events").select("event_id", scores.resolved_cap(F.when(e % 3 > 0, e % 64 + 1), e % 7 + 0.5).alias("cap"))


@_register("""
with o as (select o_custkey, o_orderkey, row_number() over (partition by o_custkey order by o_orderkey) as n from orders where o_orderkey % 2 = 0)
select o_custkey, string_agg('e' || lpad(o_orderkey::varchar, 9, '0'), '; ' order by o_orderkey) as errors from o where n <= 3 group by o_custkey
""")
def first_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").where("o_orderkey % 2 = 0")
    # A customer's orders are few; the aggregate keeps one array for each.
    return rows.groupBy("o_custkey").agg(text.first_errors(F.array_sort(F.collect_list(F.concat(F.lit("e"), F.lpad(F.col("o_orderkey").cast("string"), 9, "0"))))).alias("errors"))


# --- configurations and staging ----------------------------------------------------------------

_CONFIGS = ("type: web_crawl\nurl: https://e.test/{id}\ndepth: 2\n", "sources:\n- {type: url, id: u{id}, url: 'https://e.test/'}\n- {type: nope}\n- 7\n", "type: github_repo\nrepo_url: https://github.com/o/r{id}\n", "type: local_file\n", "a: [")


@_register("""
with c as (select doc_id, unnest(case doc_id % 5 when 1 then [0, 1, 2] else [null] end) as entry from documents)
select 'c' || doc_id || '.yaml' as file, entry, case doc_id % 5 when 0 then 'web_crawl' when 1 then case entry when 0 then 'manifest_url' end when 2 then 'github_repo' when 3 then 'local_file' end as kind,
 case doc_id % 5 when 0 then 'https://e.test/' || doc_id when 1 then case entry when 0 then 'https://e.test/' end when 2 then 'https://github.com/o/r' || doc_id end as url,
 case when doc_id % 5 = 0 or (doc_id % 5 = 1 and entry = 0) or doc_id % 5 = 2 then null when doc_id % 5 = 1 then case entry when 1 then 'unknown or missing type ''nope''' else 'a source must be a mapping' end when doc_id % 5 = 3 then 'missing paths' else 'not YAML' end as error
from c
""")
def config_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.col("doc_id")
    body = F.get(F.array(*[_filled(c) for c in _CONFIGS]), (d % 5).cast("int"))
    rows = files.config_rows(_docs(spark, sf_dir).select(F.concat(F.lit("conf/c"), d.cast("string"), F.lit(".yaml")).alias("path"), body.alias("text")))
    return rows.select("file", "entry", "kind", "url", F.regexp_extract("error", "^(not YAML|.*)", 1).alias("error")).withColumn("error", F.when(F.col("error").startswith("not YAML"), "not YAML").otherwise(F.col("error")))


@_register(r"""
with f as (select unnest(['docs/' || lang || '/d' || doc_id || '.md', 'top' || doc_id || '.md', 'docs/x/' || doc_id || '.txt', 'runtime-output-1/' || doc_id || '.md', 'docs/skip/' || doc_id || '.md']) as relative_path from documents)
select relative_path from f where not regexp_matches(relative_path, '^runtime-output|^docs/skip/|\.txt$')
""")
def glob_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Include globs in union, less exclude globs, less folders that runs generate."""
    d = F.col("doc_id").cast("string")
    names = F.array(F.concat(F.lit("docs/"), "lang", F.lit("/d"), d, F.lit(".md")), F.concat(F.lit("top"), d, F.lit(".md")), F.concat(F.lit("docs/x/"), d, F.lit(".txt")), F.concat(F.lit("runtime-output-1/"), d, F.lit(".md")), F.concat(F.lit("docs/skip/"), d, F.lit(".md")))
    return files.selected(_docs(spark, sf_dir).select(F.explode(names).alias("relative_path")), ["**/*.md", "docs/?/*.md"], ["docs/skip/**", "**/*.tmp"])


@_register("""
select substr(sha256('web_crawl:' || url), 1, 16) as job_id, 'web_crawl:' || url as source, 'p' || page_id || '.html' as relative_path, length(html) as chars from pages where page_id % 3 = 0
""")
def completed_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each page staged in an area of its own, as pages may repeat an address: a third of the jobs is complete, a third is not, a third has damaged metadata."""
    p = F.col("page_id")
    source = F.concat(F.lit("web_crawl:"), "url")
    job = ids.job_id(source)
    folder = F.concat(F.lit("file:/st/"), p.cast("string"), F.lit("/"), F.substring(job, 1, 2), F.lit("/"), job, F.lit("/"))
    told = F.when(p % 3 == 2, F.lit("{no")).otherwise(F.to_json(F.struct(job.alias("job_id"), F.lit("x").alias("cache_path"), (p % 3 == 0).alias("complete"), F.struct(source.alias("source")).alias("metadata"))))
    both = F.array(F.struct(F.concat(folder, F.lit("metadata.json")).alias("path"), told.alias("text")), F.struct(F.concat(folder, F.lit("p"), p.cast("string"), F.lit(".html")).alias("path"), F.col("html").alias("text")))
    found = table(spark, sf_dir, "pages").select(F.explode(both).alias("f")).select("f.path", F.length("f.text").cast("bigint").alias("length"), F.col("f.text").cast("binary").alias("content"))
    done = files.completed_jobs(found)
    return done.select("job_id", "source", "relative_path", F.length(F.decode("content", "UTF-8")).cast("bigint").alias("chars"))


# --- Markdown --------------------------------------------------------------------------------

_STUDIED = "Intro **bold** `c d`\n\n# A{id}\n\npara one\nmore [l](u)\n\n- x\n- y\n\n1. z\n\n> q\n\n| a | b |\n|---|---|\n| 1 | 2 |\n\n***\n\nSub\n---\n\n```py\ncode here\n```\n"


@_register(f"""
with s as (select doc_id, {_sql(_STUDIED)} as body from documents)
select doc_id, cast(length(body) as int) as char_len, 2 as heading_count, 2 as heading_depth_max, 3 as list_item_count, 1 as bullet_lists, 1 as ordered_lists, 1 as code_block_count, 1 as code_inline_count, 1 as blockquote_count, 2 as paragraph_count, 1 as hr_count,
 1 as table_count, 2 as table_row_count, 4 as table_cell_count, 1 as link_count, 1 as emph_count, 20 as word_count, 20 as unique_words, 1.0 as type_token_ratio, round(12 / length(body) * 1000, 3) as structural_density_per_1k, 2 as section_count,
 cast(floor((21 + length(body) - 22) / 2.0) as int) as median_section_chars, cast(length(body) - 22 as int) as p90_section_chars
from s
""")
def study_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    body = F.replace(_filled(_STUDIED), F.lit("| 1 | 2 |"), F.lit("| 7 | 8 |"))
    rows = _docs(spark, sf_dir).select("doc_id", markdown.study_metrics(body).alias("m"))
    return rows.select("doc_id", *[F.col(f"m.{n}").alias(n) for n in markdown.STUDY.names if n not in ("parse_ok", "token_count")])


@_register(f"""
with s as (select doc_id, {_sql(_STUDIED)} as body from documents)
select doc_id, true as parse_ok, cast(length(body) as int) as char_len, 2 as heading_count, 2 as heading_depth_max, 3 as list_item_count, 1 as code_block_count, 1 as table_count, 4 as table_cell_count, 3 as section_count,
 29 as median_section_chars, round(12 / length(body) * 1000, 3) as structural_density_per_1k
from s
""")
def body_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _docs(spark, sf_dir).select("doc_id", markdown.quality_metrics(_filled(_STUDIED)).alias("m"))
    return rows.select("doc_id", *[F.col(f"m.{n}").alias(n) for n in markdown.METRICS.names if n != "token_count"])


@_register("select doc_id, case doc_id % 5 when 0 then 'pass' when 1 then 'H2 before any H1' when 2 then 'H3 before any H2' when 3 then 'pass' else 'H3 before any H1' end as verdict from documents")
def heading_hierarchy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ATX and setext headings; fences hide them, a later H1 does not reset what was seen."""
    bodies = ("Top\n===\n\nPart\n---\n\n### Deep\n\n# Again\n\n### Deep", "Part\n----\n\nTop\n===\n", "# A\n\n```\n## no\n```\n\n### C", "text\n\n---\n\n# A\n\n## B", "### C\n\n# A")
    body = F.get(F.array(*map(F.lit, bodies)), (F.col("doc_id") % 5).cast("int"))
    return _docs(spark, sf_dir).select("doc_id", markdown.hierarchy_verdict(body).alias("verdict"))


@_register("""
with m as (select unnest(['structural_density_per_1k', 'heading_count', 'section_count', 'table_cell_count']) as metric, unnest([n_chars / 7.0, doc_id % 9, doc_id % 4, n_chars % 100]) as value from documents)
select metric, round(avg(value), 3) as mean, round(median(value), 3) as median from m group by metric
""")
def quality_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    d, n = F.col("doc_id"), F.col("n_chars")
    return corpus.quality_summary(_docs(spark, sf_dir).select((n / 7.0).alias("structural_density_per_1k"), (d % 9).alias("heading_count"), (d % 4).alias("section_count"), (n % 100).alias("table_cell_count")))


@_register("select doc_id, '# T' || doc_id || chr(10) || chr(10) || 'one' || chr(10) || chr(10) || case when doc_id % 2 = 0 then chr(10) || 'two ' || lang else '# U' || chr(10) || 'two ' || lang end as body from documents")
def stitched_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A chunk that begins with the heading the chunk before ended on loses it; empty chunks are left out."""
    d = F.col("doc_id")
    again = F.when(d % 2 == 0, F.concat(F.lit("# T"), d.cast("string"), F.lit("\n\ntwo "), "lang")).otherwise(F.concat(F.lit("# U\ntwo "), "lang"))
    chunks = F.array(F.concat(F.lit("# T"), d.cast("string"), F.lit("\n\none")), F.lit(" \n"), again)
    return _docs(spark, sf_dir).select("doc_id", ranges.stitch_bodies(chunks).alias("body"))


_DEEP = "# One {id}\n\nintro\n\n## A\n\naaaa\n\n## B\n\nbbbb\n\n# Two\n\nshort\n"


@_register(f"""
select doc_id, unnest(['# One ' || doc_id || chr(10) || chr(10) || 'intro', {_sql('## A' + chr(10) * 2 + 'aaaa')}, {_sql('## B' + chr(10) * 2 + 'bbbb')}, {_sql('# Two' + chr(10) * 2 + 'short')}]) as part from documents
""")
def heading_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A body that is cut at H1s, and one of its parts at H2s as it is too long."""
    return _docs(spark, sf_dir).select("doc_id", F.explode(text.segment(_filled(_DEEP), 28)).alias("part"))


@_register(f"select doc_id, {_sql('<a id=' + chr(34) + 'chunk-0001' + chr(34) + '></a>' + chr(10) + '# A {id}' + chr(10) * 2 + '~~~' + chr(10) + '# no' + chr(10) + '~~~' + chr(10) + '<a id=' + chr(34) + 'chunk-0002' + chr(34) + '></a>' + chr(10) + '### B' + chr(10) + '#### C')} as body from documents")
def anchored_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _docs(spark, sf_dir).select("doc_id", text.chunk_anchors(_filled("# A {id}\n\n~~~\n# no\n~~~\n### B\n#### C")).alias("body"))


@_register("select doc_id, round(case when r <= 0.05 then 0.0 else least(1.0, (r - 0.05) / 0.15) end, 9) as ratio from (select doc_id, (doc_id % 7) / (length(text) % 50 + doc_id % 7 + 1.0) as r from documents)")
def unprintable_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts with a known number of private, control and separator characters among letters."""
    odd = F.substring(F.lit("\x01  \x7f­"), F.lit(1), (F.col("doc_id") % 7).cast("int"))
    body = F.concat(F.repeat(F.lit("a"), (F.length("text") % 50 + 1).cast("int")), odd)
    return _docs(spark, sf_dir).select("doc_id", F.round(scores.non_ascii_ratio(body), 9).alias("ratio"))


# --- guards ----------------------------------------------------------------------------------


@_register("""
select doc_id, case doc_id % 4 when 0 then 2 when 1 then null when 2 then null else 0 end as crawl_depth, case doc_id % 4 when 0 then 200 when 1 then null when 2 then 100 else null end as http_status,
 case doc_id % 4 when 0 then 'text/html' end as content_type, case doc_id % 4 when 0 then 'web' when 1 then 'wiki' when 2 then 'web' else 'wiki' end as family from documents
""")
def web_guards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers that are texts, fractions, truth values or out of range count as missing; a payload that its family refuses becomes wiki."""
    metas = ('{"crawl_depth": 2, "http_status": 200, "content_type": "text/html", "final_url": "https://e.test/"}', '{"crawl_depth": "3", "http_status": 99, "content_type": 7, "final_url": "file:///x"}', '{"crawl_depth": -1, "http_status": 100, "content_type": "", "fetched_at": "2024-05-01T10:00:00Z"}', '{"crawl_depth": 0, "http_status": true, "fetched_at": "soon"}')
    meta = F.get(F.array(*map(F.lit, metas)), (F.col("doc_id") % 4).cast("int"))
    rows = _docs(spark, sf_dir).select("doc_id", guards.web_fields(meta).alias("f"))
    family = guards.validated_family(F.lit("web"), F.lit("HTTPS://e.test/x"), F.col("f"), F.lit(None).cast("string"))
    return rows.select("doc_id", F.col("f.crawl_depth").cast("int").alias("crawl_depth"), F.col("f.http_status").cast("int").alias("http_status"), F.col("f.content_type").alias("content_type"), family.alias("family"))


@_register("select doc_id, case when doc_id % 3 = 0 then 'a=1,b=2' when doc_id % 3 = 1 then 'a=1,b=' || doc_id else 'b=' || doc_id end as entries from documents")
def namespace_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.col("doc_id")
    old = F.when(d % 3 < 2, F.create_map(F.lit("a"), F.lit("1"), F.lit("b"), F.lit("2")))
    new = F.when(d % 3 > 0, F.create_map(F.lit("b"), d.cast("string")))
    merged = guards.merged_namespace(old, new)
    return _docs(spark, sf_dir).select("doc_id", F.array_join(F.transform(F.array_sort(F.map_entries(merged)), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ",").alias("entries"))


@_register("select doc_id, case when doc_id % 5 = 0 then 'p' end as provider, case doc_id % 5 when 1 then 'api_key must not be given' when 2 then 'must be enabled' when 3 then 'names no provider' when 4 then 'names no api_key_env_var' end as error from documents")
def provider_settings(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = ('{"enabled": true, "provider": "p", "api_key_env_var": "K"}', '{"enabled": true, "api_key": "x"}', '{"provider": "p"}', '{"enabled": true}', '{"enabled": true, "provider": "p"}')
    raw = F.get(F.array(*map(F.lit, given)), (F.col("doc_id") % 5).cast("int"))
    rows = _docs(spark, sf_dir).select("doc_id", guards.provider_settings(raw).alias("s"))
    return rows.select("doc_id", "s.provider", F.regexp_replace("s.error", ",.*", "").alias("error"))
