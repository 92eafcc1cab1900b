"""Steps whose cost follows their input: what they may not hold, shuffle or parse."""

import json
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quire.functions import text as T
from quire.operators import articles, footnotes, graph, layout, render


def plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_pages_of_long_articles(spark):
    """an article is not spread over all numbers between its first page and its last."""
    arts = spark.createDataFrame([("v", "a", 1, 0, 2147483647), ("v", "b", 2, 300, 299), ("v", "c", 3, -3, 255)], "volume_slug string, article_id string, num int, page_first int, page_last int")
    pages = spark.createDataFrame([("v", -2), ("v", 255), ("v", 255), ("v", 300), ("v", 2147483647), ("w", 1)], "volume_slug string, page_num int")
    got = articles.article_pages(arts, pages).select("article_id", "page_num", "ord").collect()
    assert sorted(map(tuple, got)) == [("a", 255, 255), ("a", 300, 300), ("a", 2147483647, 2147483647), ("c", -2, 1), ("c", 255, 258)]


def test_a_volume_is_one_aggregate(spark):
    """no join carries a whole body or facsimile."""
    block = lambda art, num, title, at, page, pos, bid, kind, text: ("v", art, num, title, at, page, pos, bid, kind, text, 0, 0, 10, 10)
    rows = spark.createDataFrame(
        [block("v-b", 2, "B", 0, 2, 1, "p2", "footnote", "n"), block("v-b", 2, "B", 0, 2, 0, "p1", "section-header", "B first"), block("v-a", 1, "A", 0, 1, 0, "p0", "text", "x & y"), block("v-b", 2, "B", 1, 10, 0, "p3", "footnote", "m"), block("v-a", 1, "A", 1, 2, 0, "p1", "text", "B first")],
        "volume_slug string, article_id string, num int, title string, page_ord int, page_num int, reading_pos int, block_id string, type string, text string, x1 int, y1 int, x2 int, y2 int",
    )
    volumes = spark.createDataFrame([("v", "V", "P", 2000), ("none", "N", "P", 2000)], "volume_slug string, volume_title string, publisher string, volume_year int")
    got = render.tei(rows, volumes)
    zone = lambda b: f'<zone xml:id="z_{b}" points="0,0 10,0 10,10 0,10"/>'
    assert "Join" not in plan(got)
    assert [r["xml"] for r in got.collect()] == [
        '<?xml version="1.0" encoding="UTF-8"?>\n<TEI xmlns="http://www.tei-c.org/ns/1.0">\n<teiHeader><fileDesc><titleStmt><title>V</title></titleStmt><publicationStmt><publisher>P</publisher><date>2000</date></publicationStmt></fileDesc></teiHeader>\n<facsimile>\n'
        f'<surface xml:id="page_0001">{zone("p0")}</surface>\n<surface xml:id="page_0002">{zone("p1")}{zone("p2")}</surface>\n<surface xml:id="page_0010">{zone("p3")}</surface>\n</facsimile>\n<text><body>\n'
        '<div type="article" xml:id="v-a"><head>A</head>\n<pb n="1" facs="#page_0001"/>\n<p facs="#z_p0">x &amp; y</p>\n<pb n="2" facs="#page_0002"/>\n<p facs="#z_p1">B first</p>\n</div>\n'
        '<div type="article" xml:id="v-b"><head>B</head>\n<pb n="2" facs="#page_0002"/>\n<note place="foot" n="1" xml:id="fn_p2" facs="#z_p2">n</note>\n<pb n="10" facs="#page_0010"/>\n<note place="foot" n="2" xml:id="fn_p3" facs="#z_p3">m</note>\n</div>\n</body></text></TEI>'
    ]


def test_references_of_pages(spark):
    """pages with their blocks need no grouping; places of matches are those of the text, signs of several bytes and all."""
    blocks = [("n", "footnote", "2. x"), ("a", "text", "é😀 word 2 . and² 3^ x12^"), ("b", "text", "Wort 2"), ("c", "text", "1825 3 a"), ("d", "page-header", "x 2"), ("e", "text", None)]
    pages = spark.createDataFrame([("a", 3, blocks), ("a", 4, blocks[1:])], "article_id string, page_num int, blocks array<struct<block_id:string,type:string,text:string>>")
    got = footnotes.page_refs(pages)
    assert "Aggregate" not in plan(got)
    marked = [("a", "marked", 15, 16, 2), ("a", "marked", 17, 19, 3), ("a", "marked", 21, 24, 12)]
    rows = sorted((r["page_num"], r["block_id"], r["kind"], r["start"], r["end"], r["n"], r["target_id"]) for r in got.collect())
    want = [(p, *m, "fn-a-p003-2" if (p, m[-1]) == (3, 2) else None) for p in (3, 4) for m in marked] + [(3, "a", "plain", 8, 9, 2, "fn-a-p003-2"), (3, "b", "plain", 5, 6, 2, "fn-a-p003-2")]
    assert rows == sorted(want, key=lambda r: r[:6])


def test_simple_markup_without_the_parser(monkeypatch):
    """F8: simple markup isn't parsed by HTMLParser, and what comes out is the same."""
    parts = ["<b>", "</b>", "<sup>", "</sup>", " 1 ", "2^", "x &lt; y", "&amp", "&am", " & ", "<br>", '<td colspan="2">', "</td>", '<sup class="q">', '<a href="x">', "</a>", "<!-- c -->", "<", ">", "<B>", "<script>", "</script>", "<title>", '<b title="it\'s">', "12^", "<p/>"]
    draw, targets = random.Random(1), {1: "t1", 2: "t&2"}
    for _ in range(3000):
        x = "".join(draw.choice(parts) for _ in range(draw.randint(0, 9)))
        p = T._Linked(targets)
        p.feed(x)
        assert T._linked(x, targets) == p.close(), x
    monkeypatch.setattr(T._Linked, "feed", lambda *_: pytest.fail("parsed"))
    assert T._linked('<td colspan="2">1^ &amp; <sup>3</sup></b>', targets) == '<td colspan="2"><sup class="fn-ref"><a href="#t1">1</a></sup> &amp; <sup class="fn-ref">3</sup></td>'


def test_values_of_nodes(spark):
    """whole numbers and plain texts become JSON without a generator of it, all others as before."""
    texts = ["", "plain ä😀 / \u2028\x7f", 'a "b"', "back\\slash", "tab\t", "\x00", "line\n", None]
    rows = spark.createDataFrame([(x, i if x is not None else None) for i, x in enumerate(texts)], "t string, n long")
    got = rows.select("t", "n", graph._as_json("t", "string").alias("a"), graph._as_json("n", "long").alias("b"), graph._as_json("t", "other").alias("c")).collect()
    assert [r["a"] for r in got] == [r["c"] for r in got] == [None if x is None else json.dumps(x, ensure_ascii=False) for x in texts]
    assert [r["b"] for r in got] == [None if r["n"] is None else str(r["n"]) for r in got]
    plain = spark.createDataFrame([(b"a\xff",)], "t binary").select(F.col("t").cast("string").alias("t"))
    assert plain.where(graph._as_json("t", "string") == graph._as_json("t", "other")).count() == 1


def test_order_without_comparing_by_lambda(spark):
    """places are sorted by sort_array, whose comparison is no lambda; blocks come as they came before, on pages of two columns or one."""
    block = lambda i, kind, x1, y1, x2: (i, f"b{i}", kind, x1, y1, x2, y1 + 50)
    two = [block(0, "text", 700, 300, 1300), block(1, "text", 100, 300, 600), block(2, "title", 100, 100, 1300), block(3, "text", 700, 100, 1300), block(4, "text", 100, 400, 600)]
    rows = [("v", 1, 1400, 2000, two), ("v", 2, 1400, 2000, two[:2] + two[3:4]), ("v", 3, 1400, 2000, [])]
    pages = spark.createDataFrame(rows, "volume_slug string, page_num int, image_width int, image_height int, blocks array<struct<emit_pos:int,block_id:string,type:string,x1:int,y1:int,x2:int,y2:int>>")
    ordered = layout.reading_order(layout.detect_columns(pages))
    assert "sort_array(" in plan(ordered) and "array_sort(" not in plan(ordered)
    got = [(r["page_num"], r["block_id"], r["col"]) for r in ordered.orderBy("page_num", "reading_pos").collect()]
    assert got == [(1, "b3", 1), (1, "b2", None), (1, "b1", 0), (1, "b4", 0), (1, "b0", 1), (2, "b0", None), (2, "b1", None), (2, "b3", None)]


def test_markdown_of_whole_pages(spark):
    """pages with their blocks in order need no row for each block, and no task sorts all pages of an article."""
    kinds = ("text", "section-header", "caption", "figure", "table", "equation", "list", "footnote", None)
    blocks = [(f"b{i}", k, t, h, d) for i, (k, (t, h, d)) in enumerate((k, x) for k in kinds for x in ((" a-", "", None), ("b\nc", "<p>", " d "), (None, None, None)))]
    at = [("a", 3, 3), ("a", 5000, 7), ("a", 4096, 9000), ("a", None, 1), ("a", -1, None), ("b", 20000, 2)]
    pages = spark.createDataFrame([(*k, blocks[i:]) for i, k in enumerate(at)] + [("c", 0, 0, [])], "article_id string, page_ord int, page_num int, blocks array<struct<block_id:string,type:string,text:string,html:string,description:string>>")
    got = render.pages_markdown(pages)
    assert "explode" not in plan(got)
    rows = pages.select("article_id", "page_ord", "page_num", F.posexplode("blocks").alias("reading_pos", "b")).select("article_id", "page_ord", "page_num", "reading_pos", "b.*")
    bodies = {r["article_id"]: r["body"] for r in got.collect()}
    assert bodies == {r["article_id"]: r["body"] for r in render.article_markdown(rows).collect()} and set(bodies) == {"a", "b"}
    assert [x for x in bodies["a"].split("\n") if x.startswith("### Page")] == ["### Page 1", "### Page 3", "### Page 9000", "### Page 7"]


def test_volumes_are_streamed_one_at_a_time(spark):
    """no aggregate holds documents; lines are sorted and each volume is given on before the next one is read."""
    lines = [("a", 0, "<a>"), ("a", 1, "s"), ("a", 1, "s"), ("a", 1, None), ("a", 2, "m"), ("a", 3, "é\nx"), ("a", 3, "s"), ("a", 3, "s"), ("a", 4, "z"), ("b", 1, "s"), ("b", 3, "x"), ("c", 0, "<c>"), ("c", 4, "z"), ("d", 0, None), ("d", 3, "x"), ("e", 0, "<e>"), ("e", 3, "y")]
    read = []

    def batches():
        for line in lines:
            read.append(line[0])
            yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(line, (pa.string(), pa.int32(), pa.string()))], ["volume_slug", "_s", "_line"])

    got = render._documents(batches())
    assert next(got).to_pylist() == [{"volume_slug": "a", "xml": "<a>\ns\nm\né\nx\ns\ns\nz"}] and read[-1] == "b"
    assert [r for b in got for r in b.to_pylist()] == [{"volume_slug": "d", "xml": None}, {"volume_slug": "e", "xml": "<e>\ny"}]
    assert not list(render._documents(iter([])))


def test_tei_of_pages_and_of_blocks(spark):
    """whole pages give the documents that rows of blocks give, also where articles share a page, without an aggregate of a volume."""
    kinds = ("footnote", "section-header", "text", "footnote", "table", "list")
    block = lambda page, i: (i, f"p{page}_b{i}", kinds[(page + i) % 6], None if (page, i) == (3, 1) else f"Head <{page}>\nx", page, i, page + 9, i + 9)
    arts = [("v", "v-art01", 1, "Head <1> and", 1, 3), ("v", "v-art02", 2, "Head & <", 3, 12), ("w", "w-art01", 1, "W", 1, 2), ("w", "w-art02", 2, None, 2, 3)]
    pages = spark.createDataFrame([(v, a, n, t, p - lo, p, [block(p, i) for i in range(p % 5 + 1)]) for v, a, n, t, lo, hi in arts for p in range(lo, hi + 1)], "volume_slug string, article_id string, num int, title string, page_ord int, page_num int, blocks array<struct<reading_pos int, block_id string, type string, text string, x1 int, y1 int, x2 int, y2 int>>")
    volumes = spark.createDataFrame([("v", "V", "P", 2000), ("w", "W", "P", None), ("u", "U", "P", 1)], "volume_slug string, volume_title string, publisher string, volume_year int")
    whole, rows = render.pages_tei(pages, volumes), render.tei(pages.select("volume_slug", "article_id", "num", "title", "page_ord", "page_num", F.inline("blocks")), volumes)
    got = {r["volume_slug"]: r["xml"] for r in whole.collect()}
    assert got == {r["volume_slug"]: r["xml"] for r in rows.collect()} and set(got) == {"v", "w"} and got["w"] is None
    assert got["v"].count("<surface ") == 12 and got["v"].count('<pb n="3"') == 2 and got["v"].count('n="1" xml:id="fn_') == 2 and "<head facs=" in got["v"]
    assert "Aggregate" not in plan(whole) and "listagg" not in plan(rows)
