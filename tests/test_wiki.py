"""Wiki pages, their merge into a corpus, the HTML edition, and a run from interim pages to files."""

import json

import pytest
from pyspark.sql import functions as F

from quire.__main__ import main
from quire.operators import edition, footnotes, graph, layout, toc, wiki

ROWS = "article_id string, volume_slug string, page_num int, page_ord int, reading_pos int, block_id string, type string, text string, html string, description string, title string"


def rows(spark, *blocks):
    return spark.createDataFrame([("v-1-2000-art01", "v-1-2000", page, page - 18, i, f"b{i}", kind, text, "", None, "T") for i, (page, kind, text) in enumerate(blocks)], ROWS)


def text(spark, expr, *values):
    df = spark.createDataFrame([values], ", ".join(f"c{i} string" for i in range(len(values))))
    return df.select(expr.alias("x")).first()["x"]


def test_links_and_notes(spark):
    r = rows(spark, (18, "text", "bezogen 2 . Im Jahr 1825 . und 3 ."), (18, "caption", "Bild 2 ."), (18, "footnote", "2. Zu <b>Fahnen</b>\ntieren"), (18, "footnote", "ohne Zahl"), (19, "text", "leer 2 ."))
    notes = footnotes.notes(r)
    got = {x["block_id"]: x["text"] for x in wiki.with_links(r).collect()}
    assert got["b0"] == 'bezogen <sup><a id="fnref-p018-2" href="#fn-p018-2">2</a></sup> . Im Jahr 1825 . und 3 .'
    assert got["b1"] == "Bild 2 ." and got["b4"] == "leer 2 ."
    section = wiki.note_section(notes).first()["notes"]
    assert section.startswith('\n## Footnotes\n\n### Page 18\n\n<a id="fn-p018-2"></a><sup>2</sup>') and '<a href="#fnref-p018-2">↩</a>\n\n<a id="fn-p018-u1"></a>ohne Zahl\n\n' in section
    loose = notes.withColumn("page_num", F.when(F.col("is_numbered"), F.col("page_num")))
    assert wiki.note_section(loose).first()["notes"].endswith('\n### Unattributed\n\n<a id="fn-p???-u1"></a>ohne Zahl\n\n')


def test_html_references(spark):
    r = rows(spark, (18, "text", "ein 1^ <i>zwei</i>\n7^ <x>"), (18, "footnote", "1. Note"))
    notes = footnotes.notes(r)
    got = footnotes.with_html(r, footnotes.refs(r), notes).where("block_id = 'b0'").first()
    assert got["text_html"] == 'ein <sup class="fn-ref"><a href="#fn-v-1-2000-art01-p018-1">1</a></sup> <i>zwei</i><br><sup class="fn-ref">7</sup> '
    assert [tuple(t) for t in got["targets"]] == [(1, "fn-v-1-2000-art01-p018-1")]
    one = F.expr("array(named_struct('n', 1, 'target_id', 'a'))")
    link = '<sup class="fn-ref"><a href="#a">1</a></sup>'
    assert text(spark, footnotes.link_markers(F.col("c0"), one), "<td>x<sup> 1 </sup>1^ 11^ <sup>2</sup></td>") == f'<td>x{link}{link} <sup class="fn-ref">11</sup> <sup class="fn-ref">2</sup></td>'
    assert text(spark, footnotes.link_markers(F.col("c0"), one), '<a href="1^">1</a>') == '<a href="1^">1</a>'
    nested = "<table><tr><td>1^<table><tr><td><sup>1</sup> &lt; 1^</td></tr></table><sup><i>1</i></sup><sup><a href=\"#x\">1</a></sup></div><b>open"
    assert text(spark, footnotes.link_markers(F.col("c0"), one), nested) == f'<table><tr><td>{link}<table><tr><td>{link} &lt; {link}</td></tr></table>{link}<sup><a href="#x">1</a></sup><b>open</b></td></tr></table>'
    none = F.lit(None).cast("array<struct<n:int,target_id:string>>")
    assert text(spark, footnotes.link_markers(F.col("c0"), none), "<sup>1</sup> 1^") == "<sup>1</sup> 1^"


def test_front_matter(spark):
    df = spark.createDataFrame([("doc:art/x", ["Book"], {"name": '"Öl: a \\"b\\""', "n": "3", "part": '["p/1"]'})], "node_id string, types array<string>, props map<string,string>")
    assert df.select(wiki.front_matter().alias("x")).first()["x"] == "---\n'@context': ../_context.json\n'@id': doc:art/x\n'@type': Book\nname: 'Öl: a \"b\"'\nn: 3\npart:\n- p/1\n---\n"


@pytest.mark.parametrize(
    ("new", "old", "want"),
    [
        ("# A\n\n## Summary\n\n*To be added.*\n", None, "# A\n\n## Summary\n\n*To be added.*\n"),
        ("# A\n\n## Summary\n\n*To be added.*\n\n## Full Text\n\nnew\n\n## Notes\n\n*To be added.*\n", "# B\n## Summary\n\nmine\n\n## Full Text\n\nold\n\n## Notes\n \n", "# A\n\n## Summary\n\nmine\n\n## Full Text\n\nnew\n\n## Notes\n\n*To be added.*\n"),
        ("## Notes\nx", "", "## Notes\nx"), ("", "## Notes\nx", ""), ("no sections", "## Notes\nx", "no sections"),
    ],
)
def test_kept_sections(spark, new, old, want):
    df = spark.createDataFrame([(new, old)], "c0 string, c1 string")
    assert df.select(wiki.keep_sections(F.col("c0"), F.col("c1")).alias("x")).first()["x"] == want


def test_merge_people(spark):
    page = lambda year, item, extra="": f"---\nid: {year}\n---\n\n# Eva\n\n## Appears in\n\n### Vol ({year})\n\n- [T](../articles/vol-001-{year}-art01.md) {item}\n\n{extra}"
    old = page(2001, "old") + "### Vol (1999)\n\n- [S](../articles/vol-002-1999-art02.md)\n\n## Summary\n\nmine\n\n## Mentions\n\n*To be added.*\n"
    new = spark.createDataFrame([("people/eva.md", "vol-001-2001", page(2001, "new", "## Summary\n\n*To be added.*\n")), ("people/neu.md", "vol-001-2001", page(2001, "x"))], "path string, volume_slug string, content string")
    existing = spark.createDataFrame([("people/eva.md", old), ("people/other.md", old)], "path string, content string")
    got = {r["path"]: r["content"] for r in wiki.merge_people(new, existing).collect()}
    assert set(got) == {"people/eva.md", "people/neu.md"}
    eva = got["people/eva.md"]
    assert eva.startswith("---\nid: 2001\n---\n\n# Eva\n\n## Appears in\n\n### Vol (1999)\n\n- [S]") and ") new\n" in eva and "old" not in eva and "## Summary\n\nmine\n" in eva
    again = wiki.merge_people(new, spark.createDataFrame(list(got.items()), "path string, content string"))
    assert {r["path"]: r["content"] for r in again.collect()} == got


def test_index(spark):
    rows = [("d:series/s", ["PublicationSeries"], {"name": '"S"'}), ("d:vol/b", ["PublicationVolume", "Book"], {"name": '"V I"', "datePublished": '"2001"'}), ("d:vol/c", ["PublicationVolume", "Book"], {"name": '"V"', "datePublished": '"1999"'}), ("d:person/z", ["Person"], {"name": '"A"'}), ("d:person/a", ["Person"], {"name": '"B"'}), ("d:x/1", ["WebPage"], {}), ("d:x/2", ["WebPage"], {})]
    lines = wiki.index_rows(spark.createDataFrame(rows, "node_id string, types array<string>, props map<string,string>")).orderBy("key").collect()
    got = wiki.INDEX_HEAD + "\n".join(r["line"] for r in lines) + "\n"
    assert got.endswith("## Series\n\n- [S](series.md) · `d:series/s`\n\n## Volumes (2)\n\n- [V (1999)](volumes/c.md) · `d:vol/c`\n- [V I (2001)](volumes/b.md) · `d:vol/b`\n\n## People (2)\n\n- [A](people/z.md) · `d:person/z`\n- [B](people/a.md) · `d:person/a`\n\n## Other nodes of the graph\n\n- WebPage: 2\n")


def test_contents_rows(spark):
    toks = toc.tokens(spark.createDataFrame([("v", "INHALT\nAUFSÄTZEKarl <b>S</b>, T ... 9-12")], "volume_slug string, text string"))
    assert edition.contents_html(toks).first()["html"] == '<div class="toc-block-title">INHALT</div><div class="toc-block-section">AUFSÄTZE</div><div class="toc-block-row"><span class="toc-block-text">Karl <b>S</b>, T</span><span class="toc-block-leader"></span><span class="toc-block-page">9-12</span></div>'


def test_bands(spark):
    part = "array<struct<band:int,kind:string,col:int,y:int,e:int,f:string>>"
    blocks = [(0, "columns", 1, 10, 1, "b"), (0, "columns", 0, 10, 0, "a"), (0, "spanning", None, 50, 2, "s"), (0, "spanning", None, 50, 3, "t"), (2, "columns", 0, 60, 4, "c")]
    df = spark.createDataFrame([(blocks,)], f"p {part}")
    col = lambda i, x: f'<div class="trans-col" data-col="{i}">{x}</div>'
    want = f'<div class="trans-columns">{col(0, "a")}{col(1, "b")}</div><div class="trans-span">s</div><div class="trans-span">t</div><div class="trans-columns">{col(0, "c")}{col(1, "")}</div>'
    assert df.select(edition.by_bands(F.col("p"), F.lit(True)).alias("x")).first()["x"] == want
    assert df.select(edition.by_bands(F.col("p"), F.lit(False)).alias("x")).first()["x"] == "abstc"


def test_run_and_add_volume(spark, tmp_path):
    out, corpus = tmp_path / "out", tmp_path / "corpus"
    folder = out / "vol-001-2000" / "interim"
    folder.mkdir(parents=True)
    box = lambda y: [100, y, 900, y + 40]
    contents = "INHALT\nAUFSÄTZEKarl Schmotz, Erster Aufsatz ...... 2Eva Maier, Zweiter Aufsatz ...... 4"
    pages = {1: [("table-of-contents", contents)], 2: [("section-header", "Erster Aufsatz"), ("text", "Wort 1 . und 1^"), ("footnote", "1. Die Note")], 3: [("text", "mehr")], 4: [("section-header", "Zweiter Aufsatz"), ("text", "Ende")]}
    for n, blocks in pages.items():
        found = [{"id": f"p{n}_b{i}", "type": t, "bbox": box(100 + 60 * i), "text": x, "html": ""} for i, (t, x) in enumerate(blocks)]
        (folder / f"page_{n:04d}.json").write_text(json.dumps({"page_num": n, "image_filename": f"page_{n:04d}.png", "image_width": 1000, "image_height": 1500, "blocks": found}))
    config = tmp_path / "v.yaml"
    config.write_text(f"volume_number: 1\nvolume_year: 2000\nvolume_title: Buch\nvolume_number_roman: I\nprinted_page_offset: 0\noutput_root: {out}\n")
    assert main(["run", str(config)]) == 0
    own = out / "vol-001-2000"
    article = (own / "wiki/articles/vol-001-2000-art01.md").read_text()
    assert "# Erster Aufsatz\n\n**Karl Schmotz** · Aufsätze · pp. 2–3\n" in article and '<a id="fnref-p002-1" href="#fn-p002-1">1</a>' in article and "### Page 2" in article and "Die Note" in article
    assert "1. [Erster Aufsatz](articles/vol-001-2000-art01.md) — Karl Schmotz · pp. 2–3\n" in (own / "wiki/volume.md").read_text()
    html = (own / "html/articles/vol-001-2000-art01.html").read_text()
    assert '<a href="#fn-vol-001-2000-art01-p002-1">1</a>' in html and 'id="fn-vol-001-2000-art01-p002-1"' in html
    view = (own / "html/pages/page-0002.html").read_text()
    assert 'href="page-0001.html" rel="prev"' in view and "p. 2 / 4" in view and 'class="region-box"' in view and '<a href="#fn-vol-001-2000-art01-p002-1">1</a>' in view
    assert "2 articles" in (own / "html/index.html").read_text()
    assert all((own / p).exists() for p in ("pagexml/page_0004.xml", "tei/vol-001-2000.xml"))
    nodes = json.loads((own / "graph/vol-001-2000.jsonld").read_text())["@graph"]
    assert sum(n["@type"] == "ScholarlyArticle" for n in nodes) == 2
    assert main(["init-wiki", str(corpus)]) == 0
    add = ["add-volume", str(corpus), str(own / "graph/vol-001-2000.jsonld"), "--wiki", str(own / "wiki")]
    assert main(add) == 0
    assert "](../articles/vol-001-2000-art01.md)" in (corpus / "volumes/vol-001-2000.md").read_text() and "- [Eva Maier](people/eva-maier.md)" in (corpus / "index.md").read_text()
    page = corpus / "articles/vol-001-2000-art01.md"
    page.write_text(page.read_text().replace("## Summary\n\n*To be added.*", "## Summary\n\nmine"))
    log = (corpus / "log.md").read_text()
    assert log.count("add-volume | vol-001-2000\n- articles added: 2\n- people: 2 new, 0 merged\n") == 1
    before = {p: p.read_text() for p in corpus.rglob("*.md")}
    assert main(add) == 0
    assert {p: p.read_text() for p in corpus.rglob("*.md")} == before and "## Summary\n\nmine" in page.read_text()
