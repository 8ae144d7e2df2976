import base64
import hashlib
import html as html_module
import re

from narrata.llm import warc
from narrata.llm.queries import op1_warc_derivatives

SF = "/root/testdata/sf0.01"


def expected_text(page):
    """Plain text by the rules of the docstring, tag by tag."""
    page = re.sub(r"(?s)<!--.*?(?:-->|$)", "", page)
    for name in warc.HIDDEN:
        page = re.sub(rf"(?is)<{name}(?:\s[^>]*)?>.*?(?:</{name}\s*>|\Z)", " ", page)
    out = []
    for part in re.split(r"(</?[A-Za-z!][^>]*>)", re.sub(r"[ \t\n\x0b\f\r]+", " ", page)):
        tag = re.fullmatch(r"</?([A-Za-z0-9]*)([\s/][^>]*)?>", part)
        if re.fullmatch(r"</?[A-Za-z!][^>]*>", part):
            part = "\n" if tag and tag[1].lower() in warc.BLOCK_TAGS.split() else ""
        out.append(part)
    text = html_module.unescape("".join(out)).replace("\xa0", " ")
    lines = [re.sub(r"[ \t\r\f\x0b]+", " ", line).strip(" ") for line in text.split("\n")]
    return "\n".join(line for line in lines if line)


def sha1(data):
    return "sha1:" + base64.b32encode(hashlib.sha1(data.encode()).digest()).decode()


def test_whole_table(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    rows = op1_warc_derivatives(spark, SF).collect()
    assert len(rows) == 2 * len(pages) and len({r.record_id for r in rows}) == len(rows)
    for r in rows:
        page = pages[r.page_id]
        assert r.target_uri == page.url and r.payload_digest == sha1(page.html) and r.block_digest == sha1(r.block)
        if r.warc_type == "conversion":
            assert r.block == expected_text(page.html)
        else:
            assert r.n_links == r.block.count("outlink: ") and "title: " in r.block
    assert len({(r.page_id, r.refers_to) for r in rows}) == len(pages)


HARD = [
    (1, "http://h.org/a/b.html?x#y", "<p>a&amp;lt;b &#65;&#x1F600; &bogus; &#0; &lt;i&gt; &nbsp;x<!-- <p> --><br/>c<b>d</b>e<BR>f<script>var a='</p>';</script >g<style>h"),
    (2, None, None), (3, "", ""), (4, "x", "no tags at all \n here"), (5, "http://h.org", "<a href='c'>1</a><a class=x href=/d#z>2</a><a href=\"//o.org/e\">3</a><a href=?q>4</a><a href='#top'>5</a><a href='c'>6</a>"),
    (5, "http://h.org", "<title>\n A &amp; B </title><html lang=EN><meta charset='UTF-8'>" + "<div>" * 20_000 + "x\r\n\r\nWARC/1.1 y"), (None, "http://é.org/", "<pré>é < 3 & 4 <"),
]


def test_hard_pages(spark):
    df = spark.createDataFrame(HARD, "page_id long, url string, html string").selectExpr("*", "1 AS block", "2 AS warc_type", "3 AS links")
    rows = warc.page_derivatives(df).collect()
    texts = sorted((str(r.page_id), r.block) for r in rows if r.warc_type == "conversion")
    assert texts == sorted((str(i), expected_text(h or "")) if i != 1 else ("1", "a&lt;b A\U0001f600 &bogus; &#0; <i> x\ncde\nf g") for i, _, h in HARD)
    links = [re.findall("outlink: ([^\r]*)", r.block) for r in rows if r.page_id == 5 and r.warc_type == "metadata"]
    assert ["http://h.org/c", "http://h.org/d", "http://o.org/e", "http://h.org?q"] in links
    meta = [r.block for r in rows if r.page_id == 5 and "title" in r.block and r.warc_type == "metadata"]
    assert "title: A & B\r\nlanguage: en\r\ncharset: utf-8\r\n" in meta[0]
    assert warc.page_derivatives(df.filter("false")).collect() == []


def test_tags_that_never_close(spark):
    pages = [
        (1, "u", "a <b c"), (2, "u", "a<title>b <p>c"), (3, "u", "a<script b c"), (4, "u", "<a href='x>y'>t</a> <a href=z"), (5, "u", "a<style>b</style><style x"),
        (6, "u", "<a title=it's href=q>r</a>'s"), (7, "u", "<title>a</title><title>b"), (8, "u", "<title x <title>a</title>"),
    ]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    rows = warc.page_derivatives(df).collect()
    texts = {r.page_id: r.block for r in rows if r.warc_type == "conversion"}
    assert texts == {1: "a <b c", 2: "a\nb\nc", 3: "a", 4: "y'>t <a href=z", 5: "a", 6: "r's", 7: "a\nb", 8: "a"}
    fields = {r.page_id: re.findall(r"(?:title|outlink): ([^\r]*)", r.block) for r in rows if r.warc_type == "metadata"}
    assert fields == {1: [], 2: [], 3: [], 4: ["x>y"], 5: [], 6: ["q"], 7: ["a"], 8: ["a"]}


def test_junk_in_linear_time(spark):
    import time

    junk = ["<title>", "<title ", "<a ", '<a x=">" ', "<script ", "<meta name=", "<p ", "</title>", "<!--", "<html lang='", "&#", "<a href='x' "]

    def seconds(n):
        df = spark.createDataFrame([(i, "u", part * n) for i, part in enumerate(junk)], "page_id long, url string, html string").repartition(8)
        start = time.perf_counter()
        assert warc.page_derivatives(df).count() == 2 * len(junk)
        warc.page_derivatives(df).agg(warc.F.sum(warc.F.length("block"))).collect()
        return time.perf_counter() - start

    seconds(100)
    few, many = seconds(10_000), seconds(40_000)
    assert many < 8 * few + 5


def test_files_read_back(spark, tmp_path):
    df = spark.createDataFrame(HARD[:6], "page_id long, url string, html string")
    records = warc.responses(df).unionByName(warc.page_derivatives(df).drop("n_links"))
    warc.write_warc(records, str(tmp_path / "w"))
    back = warc.read_warc(spark, str(tmp_path / "w"))
    same = ["warc_type", "record_id", "block", "block_digest", "payload_digest", "content_type"]
    assert back.filter("not whole").count() == 0
    assert sorted(map(tuple, back.select(same).collect())) == sorted(map(tuple, records.select(same).collect()))
    again = warc.derivatives(back.withColumn("page_id", warc.F.lit(0)))
    assert sorted(r.record_id for r in again.collect()) == sorted(r.record_id for r in warc.page_derivatives(df).collect())


def test_source_headers_and_description(spark):
    head = "HTTP/1.1 404 Not Found\r\nServer: nginx\r\nX-Long: a\r\n\tb\r\nSet-Cookie: a=1\r\nset-cookie: b=2\r\nno name\r\nContent-Type: text/html\r\n\r\n"
    pages = {
        1: head + "<meta charset=utf-8><META content='A &amp;\n \"B\" > c' NAME=description><meta name=description content=second>",
        2: head + '<meta name="description" content=""/><meta property="og:description" content="no"><meta name="Description"content="x"/>',
        3: "<meta name='descriptions' content='no header and no description'>",
    }
    rows = [(i, "response", f"<urn:{i}>", "http://h.org/", warc.DATE, "application/http", block, sha1(block), "") for i, block in pages.items()]
    schema = "page_id long, warc_type string, record_id string, target_uri string, date string, content_type string, block string, block_digest string, payload_digest string"
    out = {r.page_id: r.block for r in warc.derivatives(spark.createDataFrame(rows, schema)).collect() if r.warc_type == "metadata"}
    sources = [
        "source-status-line: HTTP/1.1 404 Not Found", "source-server: nginx", "source-x-long: a b", "source-set-cookie: a=1",
        "source-set-cookie: b=2", "source-line: no name", "source-content-type: text/html",
    ]
    of = lambda i: ["response-content-type: application/http", f"response-block-digest: {sha1(pages[i])}"]
    assert out[1].split("\r\n") == [*of(1), *sources, "charset: utf-8", 'description: A & "B" > c', ""]
    assert out[2].split("\r\n") == [*of(2), *sources, "description: x", ""]
    assert out[3].split("\r\n") == [*of(3), ""]


def test_headers_of_pages(spark):
    df = spark.createDataFrame([(1, "http://h.org", "<p>é")], "page_id long, url string, html string")
    block = warc.page_derivatives(df).filter("warc_type = 'metadata'").first().block
    assert "source-status-line: HTTP/1.1 200 OK\r\nsource-content-type: text/html; charset=utf-8\r\nsource-content-length: 5\r\n" in block


def searches(spark, column):
    """How often a column searches texts, as written in its plan: a lambda or a ``when`` computes each anew."""
    df = spark.createDataFrame([("h", "f", "s", "p", "t", ["<a>"], "x")], "host string, folder string, scheme string, path string, title_element string, tags array<string>, text string")
    plan = df.select(column.alias("c"))._jdf.queryExecution().optimizedPlan().toString().split("LogicalRDD")[0]
    assert "more fields" not in plan
    return len(re.findall(r"\b(?:regexp_\w+|rlike)\(", plan, re.I)), plan.count("instr(")


def test_texts_are_searched_once(spark):
    text = warc.F.col("text")
    assert searches(spark, warc.decoded(text))[0] <= 8
    assert searches(spark, warc.page_fields()["links"])[0] <= 12
    assert all(searches(spark, step)[1] <= 1 for step in [warc.visible(text), *warc.plain_text(text)])


def test_blanks_and_references(spark):
    pages = [
        " \n a \t\n\n b<p>  c &#9;&#32; d \x0b\x0c\r</p> \x85 e<style>x</style><script>y</script> <br> &#10;   ", "a<script>1</script><style>2</style>b", " ", "\n\t", "&#13;&#10;",
        "&#x41;&#X42;&#67;&amp;amp;&amp&AMP;&;&#;&#x;&#12345678;&#1234567;&#xD800;&#x10FFFF;&thetasym;&thetasymb;&a b;&#38;lt;&#38&#59;lt;$1\\1&frac14;",
    ]
    df = spark.createDataFrame(list(enumerate(pages)), "page_id long, html string").selectExpr("page_id", "'u' AS url", "html")
    texts = {r.page_id: r.block for r in warc.page_derivatives(df).collect() if r.warc_type == "conversion"}
    assert texts == {
        0: "a b\nc d\n \x85 e", 1: "a b", 2: "", 3: "", 4: "",
        5: "ABC&amp;&amp&AMP;&;&#;&#x;&#12345678;&#1234567;&#xD800;\U0010ffff&thetasym;&thetasymb;&a b;&lt;&#38;lt;$1\\1¼",
    }
