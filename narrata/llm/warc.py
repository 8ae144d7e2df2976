"""WARC derivatives: metadata and plain-text conversion records of responses.

A response record becomes two records that refer to it: a metadata record and a conversion record with
its plain text. The metadata record has the content type and block digest of the response record
(``response-``), its status line and every HTTP header in order (``source-`` and the name in lower case;
folded lines are joined, a line without a name is a ``source-line``), and the fields of its page (title,
language, character set, description, links). Both carry the WARC-Refers-To, target URI, date and payload digest of the response; their own block digests
are computed anew, and their record ids are derived from the response's id, so a rerun gives the same.

Everything is a projection of one row: no shuffle, no state. Records are rows (warc_type, record_id,
refers_to, target_uri, date, content_type, block, block_digest, payload_digest, ...); ``write_warc`` writes
them as WARC/1.1 files with Spark's text writer, a record for each row and blank lines as line ends,
and ``read_warc`` reads such files back and checks the length of every block.

Plain text: comments, scripts, styles, templates and noscript parts are dropped, tags that open or close a
block become line ends, other tags nothing; character references are decoded once (the named ones of
``ENTITIES``, and numbers); white space is collapsed in lines and empty lines are dropped.

A tag ends at the next ``>``; in the tags that fields are read of, a quoted value may hold one. A title that never
closes is no title. Every search either ends at its first try or is not begun, so junk costs linear time.

Defined cases: a null or empty page has an empty block, no title and no links; a null URL gives an empty
target URI and relative links are kept as they are; repeated rows give records with equal ids; an empty
table gives an empty result. Only page_id, url and html are read by ``responses``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Named character references that are decoded; LATIN names U+00A0 to U+00FF in order.
LATIN = """nbsp iexcl cent pound curren yen brvbar sect uml copy ordf laquo not shy reg macr deg plusmn sup2 sup3 acute micro para
middot cedil sup1 ordm raquo frac14 frac12 frac34 iquest Agrave Aacute Acirc Atilde Auml Aring AElig Ccedil Egrave Eacute Ecirc Euml
Igrave Iacute Icirc Iuml ETH Ntilde Ograve Oacute Ocirc Otilde Ouml times Oslash Ugrave Uacute Ucirc Uuml Yacute THORN szlig agrave
aacute acirc atilde auml aring aelig ccedil egrave eacute ecirc euml igrave iacute icirc iuml eth ntilde ograve oacute ocirc otilde
ouml divide oslash ugrave uacute ucirc uuml yacute thorn yuml"""
OTHER_NAMES = {
    "lt": "<", "gt": ">", "amp": "&", "quot": '"', "apos": "'", "hellip": "…", "ndash": "–", "mdash": "—", "lsquo": "‘", "rsquo": "’",
    "sbquo": "‚", "ldquo": "“", "rdquo": "”", "bdquo": "„", "lsaquo": "‹", "rsaquo": "›", "bull": "•", "euro": "€", "trade": "™",
    "times": "×", "larr": "←", "uarr": "↑", "rarr": "→", "darr": "↓", "minus": "−", "thinsp": "\u2009", "ensp": "\u2002", "emsp": "\u2003",
}
ENTITIES = {name: chr(0xA0 + i) for i, name in enumerate(LATIN.split())} | OTHER_NAMES | {"nbsp": " "}
#: Tags that end a line of text, and elements whose content is no text.
BLOCK_TAGS = "address article aside blockquote body br caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section select summary table tbody td tfoot th thead title tr ul"
HIDDEN = ["script", "style", "noscript", "template"]
DATE = "2024-01-01T00:00:00Z"
RECORD_END = "\r\n\r\n"
#: The names met most, looked up first; the longest reference, by name or number; a length that no text exceeds.
COMMON = ["amp", "lt", "gt", "quot", "nbsp", "apos", "copy"]
LONGEST_NAME = max(8, *map(len, ENTITIES))
TO_END = 2**31 - 1


def base32_sha1(data: Column) -> Column:
    """The digest in the form that WARC files use."""
    digest = F.sha1(data)
    parts = [F.lpad(F.conv(F.substring(digest, at, 5), 16, 32), 4, "0") for at in range(1, 41, 5)]
    return F.concat(F.lit("sha1:"), F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"))


def record_id(*parts: Column) -> Column:
    """A uuid made from what names a record."""
    d = F.md5(F.concat_ws("|", *parts))
    pieces = [F.substring(d, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *pieces), F.lit(">"))


def responses(pages: DataFrame, date: str = DATE) -> DataFrame:
    """Response records of a table of pages (page_id, url, html): HTTP headers, a blank line and the page."""
    html, url = F.coalesce("html", F.lit("")), F.coalesce("url", F.lit(""))
    head = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.octet_length(html).cast("string"), F.lit(RECORD_END)
    )
    block = F.concat(head, html)
    return pages.select(
        "page_id", F.lit("response").alias("warc_type"),
        record_id(F.lit("response"), F.coalesce(F.col("page_id").cast("string"), F.lit("")), url, F.md5(html)).alias("record_id"),
        F.lit(None).cast("string").alias("refers_to"), url.alias("target_uri"), F.lit(date).alias("date"),
        F.lit("application/http; msgtype=response").alias("content_type"), block.alias("block"),
        base32_sha1(block).alias("block_digest"), base32_sha1(html).alias("payload_digest"),
    )


def _payload(block: Column) -> tuple[Column, Column]:
    """HTTP headers and payload of a response block; all is payload where there is no header end."""
    end = F.instr(block, RECORD_END)
    return (
        F.when(end > 0, F.substring(block, F.lit(1), end - 1)).otherwise(""),
        F.when(end > 0, F.substring(block, end + len(RECORD_END), F.lit(TO_END))).otherwise(block),
    )


def _number(name: Column) -> Column:
    """The number in a reference, given from after its ``&`` to its semicolon; null for a name."""
    digits = F.regexp_extract(name, r"^#([0-9]{1,7});\z", 1)
    hexadecimal = F.nullif(F.regexp_extract(name, r"^#[xX]([0-9a-fA-F]{1,6});\z", 1), F.lit(""))
    return F.when(name.startswith("#"), F.coalesce(digits.try_cast("long"), F.conv(hexadecimal, 16, 10).try_cast("long")))


def _character(name: Column, number: Column) -> Column:
    """The character of a reference by its number or name; null where there is none."""
    names = F.create_map(*[F.lit(x) for key in COMMON + [k for k in ENTITIES if k not in COMMON] for x in (f"{key};", ENTITIES[key])])
    valid = number.between(1, 0x10FFFF) & ~number.between(0xD800, 0xDFFF)
    utf16 = F.when(number < 0x10000, F.lpad(F.hex(number), 4, "0")).otherwise(
        F.concat(
            F.lpad(F.hex(F.lit(0xD800) + F.shiftright(number - 0x10000, 10)), 4, "0"),
            F.lpad(F.hex(F.lit(0xDC00) + (number - 0x10000).bitwiseAND(F.lit(0x3FF))), 4, "0"),
        )
    )
    return F.when(name.startswith("#"), F.when(valid, F.decode(F.unhex(utf16), "UTF-16BE"))).otherwise(F.try_element_at(names, name))


def decoded(text: Column) -> Column:
    """Character references to characters, each once: ``&amp;lt;`` becomes ``&lt;``.

    A name is looked for in the first characters of a part only, and each step over the parts keeps what the next
    one needs, as a lambda computes an expression anew wherever it stands.
    """
    head = lambda part: F.left(part, F.lit(LONGEST_NAME + 1))
    named = F.transform(F.split(text, "&", -1), lambda x: F.struct(x.alias("part"), F.left(head(x), F.instr(head(x), ";")).alias("name")))
    numbered = F.transform(named, lambda x: F.struct(x["part"].alias("part"), x["name"].alias("name"), _number(x["name"]).alias("number")))
    known = F.transform(numbered, lambda x: F.struct(x["part"].alias("part"), x["name"].alias("name"), _character(x["name"], x["number"]).alias("char")))

    def one(x, i):
        rest = F.substring(x["part"], F.length(x["name"]) + 1, F.lit(TO_END))
        return F.when(i == 0, x["part"]).when(x["char"].isNotNull(), F.concat(x["char"], rest)).otherwise(F.concat(F.lit("&"), x["part"]))

    return F.when(text.contains("&"), F.array_join(F.transform(known, one), "")).otherwise(text)


def visible(html: Column) -> Column:
    """The page without comments and elements that hold no text; what never closes runs to the end of the page."""
    out = F.when(html.contains("<!--"), F.regexp_replace(html, r"(?s)<!--.*?(?:-->|\z)", "")).otherwise(html)
    return F.regexp_replace(out, rf"(?is)<({'|'.join(HIDDEN)})(?:>|\s[^>]*+(?:>|\z)).*?(?:</\1\s*>|\z)", " ")


def _without_tags(page: Column) -> Column:
    """Tags replaced by line ends or nothing. Where no ``>`` follows there is no tag, and nothing is searched."""
    block = "|".join(BLOCK_TAGS.split())
    bare = lambda c: F.regexp_replace(F.regexp_replace(c, rf"(?i)</?(?:{block})(?:[\s/][^>]*+)?>", "\n"), r"</?[A-Za-z!][^>]*+>", "")
    tail = F.substring_index(page, ">", -1)
    cut = F.concat(bare(F.left(page, F.length(page) - F.length(tail))), tail)
    return F.when(tail.contains("<"), cut).otherwise(bare(page))


def plain_text(page: Column) -> list[Column]:
    """Steps to the text of a page that ``visible`` has cleaned, each a column ``text`` over the one before.

    Line ends of the page become blanks, so all that are there later come from tags or references. Lines are cut at
    them and trimmed, which is far less than a search for blanks around them; runs in a line are few pages' work.
    """
    text = F.col("text")
    odd = text.contains("\t")
    for char in "\v\f\r":
        odd = odd | text.contains(char)
    lines = F.filter(F.transform(F.split(text, "\n", -1), lambda x: F.trim(x)), lambda x: x != "")
    return [
        F.when(page.contains("\n"), F.replace(page, F.lit("\n"), F.lit(" "))).otherwise(page),
        _without_tags(text),
        decoded(text),
        F.when(odd, F.regexp_replace(text, r"[\t\x0B\f\r]", " ")).otherwise(text),
        F.array_join(lines, "\n"),
        F.when(text.contains("  "), F.regexp_replace(text, " {2,}", " ")).otherwise(text),
    ]


def url_parts(url: Column) -> list[Column]:
    """Scheme, host with scheme, folder, and the URL up to its query."""
    path = F.regexp_replace(url, r"[?#].*$", "")
    return [
        F.regexp_extract(url, r"^([a-zA-Z][a-zA-Z0-9+.-]*:)//", 1).alias("scheme"),
        F.regexp_extract(url, r"^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)", 1).alias("host"),
        F.regexp_extract(path, r"^([a-zA-Z][a-zA-Z0-9+.-]*://[^/]*(?:/.*)?)/[^/]*$", 1).alias("folder"), path.alias("path"),
    ]


def _link_target(link: Column) -> Column:
    """A link without blanks and fragment made absolute, by columns of ``url_parts``: by scheme, by host, by folder."""
    host, folder = F.col("host"), F.col("folder")
    return (
        F.when((host == "") | link.rlike(r"^[a-zA-Z][a-zA-Z0-9+.-]*:"), link)
        .when(link == "", F.lit("")).when(link.startswith("//"), F.concat(F.col("scheme"), link))
        .when(link.startswith("/"), F.concat(host, link)).when(link.startswith("?"), F.concat(F.col("path"), link))
        .when(folder.startswith(host) & (F.length(folder) >= F.length(host)) & (folder != ""), F.concat(folder, F.lit("/"), link))
        .otherwise(F.concat(host, F.lit("/"), link))
    )


#: A whole title, or from its tag to the end of the page where it never closes.
TITLE = r"(?is)<title(?:\s[^>]*+)?(?:>.*?(?:</title\s*>|\z)|\z)"
#: The tags that fields are read of; a quoted value may hold ">". One that never closes runs to the end of the page.
TAGS = r"""<(?:[aA]|[mM][eE][tT][aA]|[hH][tT][mM][lL])\s(?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+)*+(?:>|\z)"""


def page_tags(page: Column) -> list[Column]:
    """The title and the tags of a page that has fields in them: the page is searched for these once each."""
    tags = F.filter(F.regexp_extract_all(page, F.lit(TAGS), F.lit(0)), lambda x: x.endswith(">"))
    return [F.regexp_extract(page, TITLE, 0).alias("title_element"), tags.alias("tags")]


def page_fields() -> dict[str, Column]:
    """Title, language, character set, description and links, from columns of ``page_tags`` and ``url_parts``."""
    title = F.regexp_extract("title_element", r"(?is)^<title(?:\s[^>]*+)?>(.*)</title\s*>\z", 1)
    clean = lambda c: F.btrim(F.regexp_replace(decoded(c), r"\s+", " "))
    attribute = r"""\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""
    bare = lambda c: F.regexp_replace(c, r"""^["']|["']$""", "")
    values = lambda start, name: F.filter(
        F.transform("tags", lambda x: F.regexp_extract(x, rf"(?i)^<{start}\s(?:[^>]*?\s)?{name}{attribute}", 1)), lambda x: x != ""
    )
    first = lambda found: F.coalesce(F.get(found, F.lit(0)), F.lit(""))
    plain = F.transform(F.transform(values("a", "href"), bare), decoded)
    links = F.transform(F.transform(plain, lambda x: F.regexp_replace(F.btrim(x), "#.*$", "")), _link_target)
    metas = F.filter("tags", lambda x: x.rlike(r"(?i)^<meta\s"))
    described = F.filter(metas, lambda x: x.rlike(r"""(?i)[\s"'/]name\s*=\s*(?:"\s*description\s*"|'\s*description\s*'|description[\s/>])"""))
    descriptions = F.transform(described, lambda x: clean(bare(F.regexp_extract(x, rf"""(?i)[\s"'/]content{attribute}""", 1))))
    return {
        "title": clean(title),
        "language": F.lower(bare(first(values("html", "lang")))),
        "charset": F.lower(bare(first(values("meta", "charset")))),
        "description": first(F.filter(descriptions, lambda x: x != "")),
        "links": F.array_distinct(F.filter(links, lambda x: x != "")),
    }


def source_lines(http: Column) -> Column:
    """The status line and all header lines of a response, in order, as fields of a metadata record."""
    lines = F.filter(F.split(F.regexp_replace(http, r"\r?\n[ \t]+", " "), r"\r?\n"), lambda x: F.btrim(x) != "")

    def field(line, i):
        name = F.substring_index(line, ":", 1)
        return (
            F.when((i == 0) & line.startswith("HTTP/"), F.concat(F.lit("source-status-line: "), line))
            .when(F.instr(line, ":") > 1, F.concat(F.lit("source-"), F.lower(name), F.substring(line, F.length(name) + 1, F.length(line))))
            .otherwise(F.concat(F.lit("source-line: "), line))
        )

    return F.array_join(F.transform(lines, lambda x, i: F.concat(field(x, i), F.lit("\r\n"))), "")


def derivatives(records: DataFrame) -> DataFrame:
    """Metadata and conversion records of the response records in ``records``; other records are passed over."""
    header, payload = _payload(F.col("block"))
    about = ["page_id", "refers_to", "target_uri", "date", "payload_digest"]
    source = records.filter("warc_type = 'response'").select(
        "page_id", F.col("record_id").alias("refers_to"), "target_uri", "date", "payload_digest",
        F.col("content_type").alias("response_type"), F.col("block_digest").alias("response_digest"), header.alias("http"), payload.alias("html"),
    )
    about += ["response_type", "response_digest", "http"]
    cleaned = source.select(*about, *url_parts(F.col("target_uri")), visible(F.col("html")).alias("page"))
    tagged = cleaned.select(*about, "scheme", "host", "folder", "path", "page", *page_tags(F.col("page")))
    read = tagged.select(*about, *[c.alias(name) for name, c in page_fields().items()], "page")
    for step in plain_text(F.col("page")):
        read = read.withColumn("text", step)
    line = lambda name, c: F.when(F.col(c) != "", F.concat(F.lit(f"{name}: "), F.col(c), F.lit("\r\n"))).otherwise("")
    lines = [line(name, name) for name in ("title", "language", "charset", "description")]
    response = [line("response-content-type", "response_type"), line("response-block-digest", "response_digest")]
    outlinks = F.array_join(F.transform("links", lambda x: F.concat(F.lit("outlink: "), x, F.lit("\r\n"))), "")
    metadata = F.concat(*response, source_lines(F.col("http")), *lines, outlinks)

    def record(kind: str, content_type: str, block: Column) -> Column:
        return F.struct(
            F.lit(kind).alias("warc_type"), record_id(F.lit(kind), F.col("refers_to")).alias("record_id"),
            F.lit(content_type).alias("content_type"), block.alias("block"),
        )

    both = F.array(record("metadata", "application/warc-fields", metadata), record("conversion", "text/plain; charset=utf-8", F.col("text")))
    return (
        read.select("page_id", "refers_to", "target_uri", "date", "payload_digest", F.size("links").alias("n_links"), F.explode(both).alias("r"))
        .select(
            "page_id", "r.warc_type", "r.record_id", "refers_to", "target_uri", "date", "r.content_type", "r.block",
            base32_sha1(F.col("r.block")).alias("block_digest"), "payload_digest", "n_links",
        )
    )


def write_warc(records: DataFrame, path: str) -> None:
    """Write records as WARC/1.1 files, one record after the other."""
    named = [
        ("WARC-Type", "warc_type"), ("WARC-Record-ID", "record_id"), ("WARC-Refers-To", "refers_to"), ("WARC-Target-URI", "target_uri"),
        ("WARC-Date", "date"), ("WARC-Block-Digest", "block_digest"), ("WARC-Payload-Digest", "payload_digest"), ("Content-Type", "content_type"),
    ]
    lines = [F.when(F.coalesce(F.col(c), F.lit("")) != "", F.concat(F.lit(f"{name}: "), F.col(c), F.lit("\r\n"))).otherwise("") for name, c in named]
    size = F.concat(F.lit("Content-Length: "), F.octet_length("block").cast("string"), F.lit(RECORD_END))
    records.select(F.concat(F.lit("WARC/1.1\r\n"), *lines, size, F.col("block"))).write.option("lineSep", RECORD_END).text(path)


def read_warc(spark, path: str) -> DataFrame:
    """Records of files that ``write_warc`` made; ``whole`` tells whether a block has the length its header states."""
    rows = spark.read.option("lineSep", RECORD_END + "WARC/1.1\r\n").text(path)
    text = F.regexp_replace("value", r"^WARC/1\.1\r\n", "")
    end = F.instr("text", RECORD_END)
    split = rows.select(text.alias("text")).select(
        F.substring("text", F.lit(1), end - 1).alias("head"), F.substring(F.col("text"), end + len(RECORD_END), F.length("text")).alias("block")
    )
    field = lambda name: F.nullif(F.regexp_extract("head", rf"(?:^|\n){name}: ([^\r\n]*)", 1), F.lit(""))
    length = field("Content-Length").cast("long")
    trimmed = F.when(F.octet_length("block") == length + len(RECORD_END), F.regexp_replace("block", r"\r\n\r\n\z", "")).otherwise(F.col("block"))
    return split.select(
        field("WARC-Type").alias("warc_type"), field("WARC-Record-ID").alias("record_id"), field("WARC-Refers-To").alias("refers_to"),
        field("WARC-Target-URI").alias("target_uri"), field("WARC-Date").alias("date"), field("Content-Type").alias("content_type"),
        trimmed.alias("block"), field("WARC-Block-Digest").alias("block_digest"), field("WARC-Payload-Digest").alias("payload_digest"),
        (F.octet_length(trimmed) == length).alias("whole"),
    )


def page_derivatives(pages: DataFrame) -> DataFrame:
    """All derivative records of a table of pages."""
    return derivatives(responses(pages))
