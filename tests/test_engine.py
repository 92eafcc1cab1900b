"""Specification rows for the document-structure engine."""

from pyspark.sql import functions as F

from quire.functions import text as T
from quire.operators import articles, blocks, footnotes, graph, layout, render, toc
from quire.sources import io


def one(spark, expr, **values):
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values)) if values else spark.range(1)
    return df.select(expr.alias("x")).first()["x"]


def test_canonical_types(spark):
    rows = [("Picture", "figure"), ("Title", "section-header"), ("formula", "equation"), ("BlockType.section_header", "section-header"), ("zzz", "text"), (None, "text")]
    df = spark.createDataFrame(rows, "t string, want string")
    assert all(r["got"] == r["want"] for r in df.select("want", blocks.canonical_type(F.col("t")).alias("got")).collect())


def test_types_of_ones_own(spark):
    """Tables of types can be given; the given ones stay as they are."""
    from quire import schemas

    own = {**schemas.CANON_TYPES, "marginal": "note"}
    row = spark.createDataFrame([("Marginal", "note", "b", "note", 1, 2, 3, 4, "x")], "t string, type string, block_id string, raw_type string, x1 int, y1 int, x2 int, y2 int, text string")
    got = row.select(blocks.canonical_type(F.col("t"), own).alias("a"), blocks.canonical_type(F.col("t")).alias("b"), render.pagexml_region({**schemas.PAGEXML_TYPES, "note": ("TextRegion", "marginalia")}).alias("c"), render.pagexml_region().alias("d")).first()
    assert (got["a"], got["b"]) == ("note", "text") and 'type="marginalia"' in got["c"] and 'type="other"' in got["d"]


def test_pixel_boxes(spark):
    cases = [([0.1, 0.2, 0.5, 0.6], (10, 40, 50, 120)), ([10.0, 20.0, 90.0, 180.0], (10, 20, 90, 180)), ([-5.0, -10.0, 200.0, 300.0], (0, 0, 100, 200)), ([], (0, 0, 100, 200)), (None, (0, 0, 100, 200)), ([90.0, 180.0, 10.0, 20.0], (10, 20, 90, 180))]
    df = spark.createDataFrame([(c, list(w)) for c, w in cases], "b array<double>, want array<int>")
    for r in df.select("want", blocks.pixel_bbox(F.col("b"), F.lit(100), F.lit(200)).alias("got")).collect():
        assert list(r["got"]) == r["want"]


def page(spark, rows, width=1400, height=2000):
    return spark.createDataFrame([("v", 1, width, height, i, b, t, *box, "") for i, (b, t, *box) in enumerate(rows)], "volume_slug string, page_num int, image_width int, image_height int, emit_pos int, block_id string, type string, x1 int, y1 int, x2 int, y2 int, text string")


TWO = [("a", "section-header", 100, 50, 1300, 120), ("b", "text", 100, 200, 650, 800), ("c", "text", 750, 200, 1300, 800), ("d", "text", 100, 820, 650, 1500), ("e", "text", 750, 820, 1300, 1500), ("f", "page-footer", 680, 1900, 720, 1950)]
BANDS = [("top", "text", 100, 100, 650, 600), ("topR", "text", 750, 100, 1300, 600), ("mid", "section-header", 100, 700, 1300, 800), ("bot", "text", 100, 900, 650, 1500), ("botR", "text", 750, 900, 1300, 1500)]


def order(spark, rows):
    got = layout.reading_order(layout.detect_columns(layout.pages_of(page(spark, rows)))).orderBy("reading_pos").collect()
    return [r["block_id"] for r in got], [r["col"] for r in got], got[0]["cols"]


def test_reading_order(spark):
    ids, cols, found = order(spark, TWO)
    assert ids == ["a", "b", "d", "c", "e", "f"] and cols == [None, 0, 0, 1, 1, None] and tuple(found) == (100, 650, 750, 1300)
    assert order(spark, BANDS)[0] == ["top", "topR", "mid", "bot", "botR"]
    assert order(spark, TWO[:1])[2] is None


def test_masthead(spark):
    """A byline and a title above the columns, centred across the gutter, span and come first; a heading within the columns doesn't."""
    rows = [("by", "text", 500, 100, 900, 150), ("ti", "section-header", 450, 160, 950, 220), ("l1", "text", 100, 300, 650, 900), ("r1", "text", 750, 310, 1300, 900), ("l2", "text", 100, 920, 650, 1500), ("sub", "section-header", 800, 920, 1200, 960), ("r2", "text", 750, 980, 1300, 1500)]
    pages = layout.detect_columns(layout.pages_of(page(spark, rows)), masthead=True)
    got = layout.reading_order(pages).orderBy("reading_pos").collect()
    assert [r["block_id"] for r in got] == ["by", "ti", "l1", "l2", "r1", "sub", "r2"] and [r["col"] for r in got] == [None, None, 0, 0, 1, 1, 1]
    assert got[0]["masthead_top"] == 300
    alone = layout.detect_columns(layout.pages_of(page(spark, [("a", "text", 100, 50, 1300, 120), ("b", "text", 100, 200, 100, 300)])), masthead=True).first()
    assert alone["masthead_top"] is None and alone["cols"] is None


def test_bands(spark):
    got = layout.bands(layout.detect_columns(layout.pages_of(page(spark, BANDS)))).collect()
    assert {(r["block_id"], r["band"], r["kind"]) for r in got} == {("top", 0, "columns"), ("topR", 0, "columns"), ("mid", 0, "spanning"), ("bot", 1, "columns"), ("botR", 1, "columns")}


def test_contents(spark):
    text = "INHALT\nMITARBEITER .....7AUFSÄTZEHartmut Wolff/Walter Wandling, Lateinische Inschriften ...... 9-42Karl Schmotz, Grabungen ...... 43-78BERICHTEMaria Müller, Bericht ...... 215"
    toks = toc.tokens(spark.createDataFrame([("v", text)], "volume_slug string, text string"))
    got = toc.entries(toks).orderBy("pos").collect()
    assert toks.orderBy("pos").first()["token"] == "INHALT"
    assert [(r["author"], r["page"], r["page_end"], r["section"]) for r in got][1:] == [("Hartmut Wolff/Walter Wandling", 9, 42, "Aufsätze"), ("Karl Schmotz", 43, 78, "Aufsätze"), ("Maria Müller", 215, None, "Berichte")]
    assert one(spark, T.author_title(F.col("t")), t="Ein Buch ohne Autor") == ("", "Ein Buch ohne Autor")


def test_offset_and_spans(spark):
    numbers = spark.createDataFrame([("v", p, 0, p - 4) for p in (5, 6, 7, 8)] + [("w", 5, 0, 1)], "volume_slug string, page_num int, pos int, printed int")
    assert [(r["volume_slug"], r["offset"]) for r in articles.printed_offset(numbers).collect()] == [("v", 4)]
    pages = spark.createDataFrame([("v", p) for p in range(1, 16)], "volume_slug string, page_num int")
    anchors = spark.createDataFrame([("v", 5, 1, None, "A"), ("v", 11, 2, 12, "B"), ("v", 99, 3, None, "C")], "volume_slug string, pdf_page int, toc_pos int, page_end int, title string")
    got = articles.spans(anchors, pages)
    assert sorted((r["num"], r["page_first"], r["page_last"], r["article_id"]) for r in got.collect()) == [(0, 1, 4, "v-frontmatter"), (1, 5, 10, "v-art01"), (2, 11, 12, "v-art02")]
    owners = {r["page_num"]: r["owner"] for r in articles.page_owner(articles.article_pages(got, pages), pages).collect()}
    assert owners[1] is None and owners[5] == "v-art01" and owners[12] == "v-art02" and owners[13] is None


def test_footnotes(spark):
    texts = [("text", "This is a marker 1^ and another 2^."), ("text", "Einheit bezogen 2 . Und"), ("text", "Im Jahr 1825 wurde der Verein"), ("text", "Mit Anmerkung¹ und auch²."), ("footnote", "1. First body."), ("footnote", "2. Second body."), ("footnote", "no number"), ("text", "Nothing 7^.")]
    rows = spark.createDataFrame([("a", f"b{i}", 3, 0, i, t, x) for i, (t, x) in enumerate(texts)], "article_id string, block_id string, page_num int, page_ord int, reading_pos int, type string, text string")
    notes = footnotes.notes(rows)
    assert [(r["n"], r["is_numbered"], r["text"], r["html_id"]) for r in notes.orderBy("reading_pos").collect()] == [(1, True, "First body.", "fn-a-p003-1"), (2, True, "Second body.", "fn-a-p003-2"), (1, False, "no number", "fn-a-p003-u1")]
    refs = footnotes.refs(rows).orderBy("reading_pos", "start").collect()
    assert [(r["block_id"], r["n"], r["target_id"]) for r in refs] == [("b0", 1, "fn-a-p003-1"), ("b0", 2, "fn-a-p003-2"), ("b1", 2, "fn-a-p003-2"), ("b3", 1, "fn-a-p003-1"), ("b3", 2, "fn-a-p003-2"), ("b7", 7, None)]
    assert "Einheit bezogen "[refs[2]["start"] :] == "" and refs[2]["end"] - refs[2]["start"] == 1


def test_merge_is_idempotent(spark):
    nodes = spark.createDataFrame([(0, 0, "n1", ["A"], {"x": "1"}), (1, 0, "n1", ["B"], {"x": "2", "y": "3"}), (1, 1, None, ["C"], {})], "source_ord int, node_pos int, node_id string, types array<string>, props map<string,string>")
    once = graph.merge(nodes)
    assert [(r["node_id"], r["types"], r["props"]) for r in once.collect()] == [("n1", ["A"], {"x": "1", "y": "3"})]
    again = once.select(F.lit(0).alias("source_ord"), F.lit(0).alias("node_pos"), "node_id", "types", "props").unionByName(nodes.withColumn("source_ord", F.col("source_ord") + 1))
    assert graph.merge(again).select("node_id", "types", "props").collect() == once.select("node_id", "types", "props").collect()


def test_text_functions(spark):
    assert one(spark, T.nfkd_slug(F.col("t")), t="Wolff, Jürgen") == "wolff-jurgen" == one(spark, T.slug(F.col("t")), t="Wolff, Jürgen")
    assert one(spark, T.nfkd_slug(F.col("t")), t="!") == "x"
    assert one(spark, T.join_hyphens(F.col("t")), t="verlie-\n\nhenen") == "verliehenen"
    assert one(spark, T.join_hyphens(F.col("t")), t="verlie-\n\nHenen") == "verlie-\n\nHenen"
    assert one(spark, T.split_authors(F.col("t")), t="Wolff, Jürgen / Wandling, Anton") == ["Wolff, Jürgen", "Wandling, Anton"]
    assert one(spark, T.sanitize_inline(F.col("t")), t='<b class="x">a</b><script>1<2</script>') == "<b>a</b>1&lt;2"
    assert one(spark, T.alt_text(F.col("t")), t='<img alt="A &amp; B &quot;coin&quot;." />') == 'A & B "coin".'


def test_markdown(spark):
    rows = spark.createDataFrame([("a", 0, 4, 0, "b1", "section-header", "Head", "", None), ("a", 0, 4, 1, "b2", "text", "verlie-", "", None), ("a", 0, 4, 2, "b3", "text", "henen", "", None), ("a", 1, 5, 0, "b4", "figure", "", "", "Seal")], "article_id string, page_ord int, page_num int, reading_pos int, block_id string, type string, text string, html string, description string")
    assert render.article_markdown(rows).first()["body"] == "### Page 4\n\n#### Head\n\nverliehenen\n\n### Page 5\n\n> **[Figure · b4]** Seal\n\n"


def test_zones_round_trip(spark):
    pages = spark.createDataFrame([("p", "---\na: 1\n---\n", "## Summary\n\nBy hand.\n\n## Body\n\nText\n")], "path string, frontmatter string, body string")
    z = io.zones(pages)
    assert [(r["name"], r["body"]) for r in z.orderBy("ord").collect()] == [("Summary", "By hand."), ("Body", "Text")]
    kept = graph.keep_zones(spark.createDataFrame([("p", 0, "Summary", "todo")], "path string, ord int, name string, body string"), z)
    assert kept.first()["body"] == "By hand."
