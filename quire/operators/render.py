"""Renderings as fragments of blocks and ordered joins of them: PageXML, TEI, HTML, Markdown. Column expressions, but for the joining of TEI lines to whole volumes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..schemas import PAGEXML_TYPES, VISUAL
from . import footnotes


def _join(order: list[str], fragment: str, sep: str = "") -> Column:
    """Fragments of a group in order; empty and null ones leave no gap."""
    rows = F.sort_array(F.collect_list(F.struct(*order, fragment)))
    return F.array_join(F.filter(F.transform(rows, lambda r: r[fragment]), lambda x: x.isNotNull()), sep)


def _lines(c: Column) -> Column:
    return F.filter(F.transform(F.split(c, "\\n"), lambda x: T.strip(x)), lambda x: x != "")


def points(b: Column | None = None) -> Column:
    c = lambda name: F.col(name) if b is None else b[name]
    return F.format_string("%d,%d %d,%d %d,%d %d,%d", *[c(x) for x in ("x1", "y1", "x2", "y1", "x2", "y2", "x1", "y2")])


def pagexml_region(types: dict[str, tuple[str, str | None]] = PAGEXML_TYPES) -> Column:
    """One region element: text only in text regions that have some. types: element and attribute of each type, as in schemas."""
    esc = lambda c: T.html_escape(c)
    kinds = F.create_map(*[F.lit(x) for k, v in types.items() for x in (k, v[0])])
    attrs = F.create_map(*[F.lit(x) for k, v in types.items() for x in (k, v[1] or "")])
    kind = F.coalesce(F.try_element_at(kinds, F.col("type")), F.lit("TextRegion"))
    attr = F.coalesce(F.try_element_at(attrs, F.col("type")), F.lit("other"))
    body = F.when((kind == "TextRegion") & (F.coalesce("text", F.lit("")) != ""), F.concat(F.lit("<TextEquiv><Unicode>"), T.html_escape(F.col("text"), False), F.lit("</Unicode></TextEquiv>"))).otherwise("")
    return F.concat(
        F.lit("<"), kind, F.lit(' id="'), esc(F.col("block_id")), F.lit('" custom="layout:'), esc(F.col("raw_type")), F.lit('"'),
        F.when(attr != "", F.concat(F.lit(' type="'), attr, F.lit('"'))).otherwise(""), F.lit('><Coords points="'), points(), F.lit('"/>'), body, F.lit("</"), kind, F.lit(">"),
    )


def pagexml(ordered: DataFrame, as_of: str, creator: str = "quire") -> DataFrame:
    """volume_slug, page_num, xml: a document for each page."""
    ns = "http://schema.primaresearch.org/PAGE/gts/pagecontent/2019-07-15"
    rows = ordered.withColumn("_f", pagexml_region())
    body = rows.groupBy("volume_slug", "page_num", "image_filename", "image_width", "image_height").agg(_join(["reading_pos"], "_f", "\n").alias("b"))
    head = f'<?xml version="1.0" encoding="UTF-8"?>\n<PcGts xmlns="{ns}">\n<Metadata><Creator>{creator}</Creator><Created>{as_of}</Created><LastChange>{as_of}</LastChange></Metadata>\n'
    page = F.format_string('<Page imageFilename="%s" imageWidth="%d" imageHeight="%d">\n', T.html_escape(F.col("image_filename")), "image_width", "image_height")
    return body.select("volume_slug", "page_num", F.concat(F.lit(head), page, F.col("b"), F.lit("\n</Page>\n</PcGts>")).alias("xml"))


def tei_fragment(note_no: Column, b: Column | None = None) -> Column:
    """One block (a struct, or else the row) as TEI by its type; note_no numbers the notes of an article."""
    c = lambda name: F.col(name) if b is None else b[name]
    t, kind = T.html_escape(c("text"), False), c("type")
    facs = F.concat(F.lit("#z_"), T.html_escape(c("block_id")))
    el = lambda name, attrs, body: F.concat(F.lit(f"<{name}"), *attrs, F.lit(' facs="'), facs, F.lit('">'), body, F.lit(f"</{name}>"))
    attr = lambda k, v: [F.lit(f' {k}="'), v if isinstance(v, Column) else F.lit(v), F.lit('"')]
    items = lambda tag: F.array_join(F.transform(_lines(c("text")), lambda x: F.concat(F.lit(f"<{tag}>"), T.html_escape(x, False), F.lit(f"</{tag}>"))), "")
    desc = F.concat(F.lit("<figDesc>"), t, F.lit("</figDesc>"))
    return (
        F.when(kind == "section-header", el("head", [], t))
        .when(kind.isin("page-header", "page-footer"), el("fw", attr("type", kind), t))
        .when(kind == "footnote", el("note", attr("place", "foot") + attr("n", note_no.cast("string")) + attr("xml:id", F.concat(F.lit("fn_"), c("block_id"))), t))
        .when(kind == "caption", el("figure", [], desc))
        .when(kind.isin(*VISUAL), el("figure", attr("type", kind), F.concat(F.lit('<graphic url="'), facs, F.lit('"/>'), F.when(c("text") != "", desc).otherwise(""))))
        .when(kind == "table", el("table", [], F.concat(F.lit("<row><cell>"), t, F.lit("</cell></row>"))))
        .when(kind == "bibliography", el("listBibl", [], items("bibl")))
        .when(kind == "table-of-contents", el("list", attr("type", "contents"), items("item")))
        .when(kind == "list", el("list", [], items("item")))
        .when(kind == "equation", el("formula", attr("notation", "TeX"), t))
        .otherwise(el("p", [], t))
    )


#: What TEI is made from of a block.
TEI_FIELDS = ("block_id", "type", "text", "x1", "y1", "x2", "y2")


def tei(rows: DataFrame, volumes: DataFrame) -> DataFrame:
    """volume_slug, xml: header, facsimile and body of each volume. rows: volume_slug, article_id, num, title, page_ord and ordered blocks."""
    blocks = F.sort_array(F.collect_list(F.struct("reading_pos", *TEI_FIELDS)))
    pages = rows.where("title is not null").groupBy("volume_slug", "article_id", "num", "title", "page_ord", "page_num").agg(blocks.alias("blocks"))
    once = rows.dropDuplicates(["volume_slug", "block_id"]).groupBy("volume_slug", "page_num").agg(blocks.alias("blocks"))
    return _volumes(_divisions(pages).select("volume_slug", F.inline(F.array(_body_line()))).unionByName(once.select("volume_slug", F.inline(F.array(_surface_line())))), volumes)


def pages_tei(pages: DataFrame, volumes: DataFrame) -> DataFrame:
    """volume_slug, xml, as `tei`, of pages with their blocks in reading order (`layout.ordered_pages`): no row for each block.

    pages: volume_slug, article_id, num, title, page_ord, page_num, blocks; a page that several articles have holds the same blocks in each.
    """
    lines = F.filter(F.array(_surface_line(), _body_line()), lambda x: x["_line"].isNotNull())
    return _volumes(_divisions(pages.where(F.size("blocks") > 0)).select("volume_slug", F.inline(lines)), volumes)


def _line(section: int, text: Column, num: Column | str = "0", article: Column | str = "''", page_ord: Column | str = "0", page_num: Column | str = "0") -> Column:
    """A line of a volume's document, with its place."""
    at = [F.expr(c) if isinstance(c, str) else c for c in (num, article, page_ord, page_num)]
    return F.struct(F.lit(section).alias("_s"), *[F.coalesce(c.cast(t), F.lit(z).cast(t)).alias(f"_o{i}") for i, (c, t, z) in enumerate(zip(at, ("bigint", "string", "bigint", "bigint"), (0, "", 0, 0)))], text.alias("_line"))


def _surface_line() -> Column:
    zone = lambda b: F.concat(F.lit('<zone xml:id="z_'), b["block_id"], F.lit('" points="'), points(b), F.lit('"/>'))
    return _line(1, F.concat(F.format_string('<surface xml:id="page_%04d">', "page_num"), F.array_join(F.transform("blocks", zone), ""), F.lit("</surface>")), page_num=F.col("page_num"))


def _divisions(pages: DataFrame) -> DataFrame:
    """Pages with what their text needs from their article: where its notes stand and how many come before, whether it is the first or last one."""
    w = Window.partitionBy("article_id").orderBy("page_ord", "page_num")
    notes = F.filter(F.transform("blocks", lambda b, i: F.when(b["type"] == "footnote", i)), lambda i: i.isNotNull())
    pages = pages.select("volume_slug", "article_id", "num", "title", "page_ord", "page_num", "blocks", notes.alias("_notes"))
    before = F.coalesce(F.sum(F.size("_notes")).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return pages.select("*", before.alias("_before"), (F.row_number().over(w) == 1).alias("_first"), F.lead(F.lit(1)).over(w).isNull().alias("_last"))


def _body_line() -> Column:
    """The text of a page of `_divisions`, its article's head before the first and its end after the last; null without a title."""
    repeats = lambda b: (b["type"] == "section-header") & F.startswith(b["text"], F.substring("title", 1, 30)) & (F.col("page_ord") == 0)
    made = F.array_join(F.transform("blocks", lambda b, i: F.when(~repeats(b), tei_fragment(F.col("_before") + F.array_position("_notes", i), b))), "\n")
    begin = F.concat(F.lit('<div type="article" xml:id="'), "article_id", F.lit('"><head>'), T.html_escape(F.col("title"), False), F.lit("</head>\n"))
    text = F.concat(F.when(F.col("_first"), begin).otherwise(""), F.format_string('<pb n="%d" facs="#page_%04d"/>\n', "page_num", "page_num"), made, F.when(F.col("_last"), "\n</div>").otherwise(""))
    return _line(3, F.when(F.col("title").isNotNull(), text), F.col("num"), F.col("article_id"), F.col("page_ord"), F.col("page_num"))


def _volumes(lines: DataFrame, volumes: DataFrame) -> DataFrame:
    """volume_slug, xml of volumes that are known and have text: lines are sorted outside memory and streamed, so that a task holds one document at a time."""
    head = F.concat(F.lit("<teiHeader><fileDesc><titleStmt><title>"), T.html_escape(F.col("volume_title"), False), F.lit("</title></titleStmt><publicationStmt><publisher>"), T.html_escape(F.col("publisher"), False), F.lit("</publisher><date>"), F.col("volume_year").cast("string"), F.lit("</date></publicationStmt></fileDesc></teiHeader>"))
    top = F.concat(F.lit('<?xml version="1.0" encoding="UTF-8"?>\n<TEI xmlns="http://www.tei-c.org/ns/1.0">\n'), head, F.lit("\n<facsimile>"))
    frame = F.array(_line(0, top), _line(2, F.lit("</facsimile>\n<text><body>")), _line(4, F.lit("</body></text></TEI>")))
    lines = volumes.select("volume_slug", F.inline(frame)).unionByName(lines)
    lines = lines.repartition("volume_slug").sortWithinPartitions("volume_slug", "_s", "_o0", "_o1", "_o2", "_o3")
    return lines.select("volume_slug", "_s", "_line").mapInArrow(_documents, "volume_slug string, xml string")


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each volume that has a frame (section 0) and text (3), of lines in order. Of repeated surfaces (1) the first stays; no xml where the head is null."""
    slug, out, seen, bare, last = None, bytearray(), set(), False, None

    def made() -> Iterator[pa.RecordBatch]:
        if {0, 3} <= seen:
            # the document is handed over where it lies, without the last line's break
            xml = pa.nulls(1, pa.string()) if bare else pa.StringArray.from_buffers(1, pa.py_buffer(np.array([0, len(out) - 1], np.int32)), pa.py_buffer(out))
            yield pa.RecordBatch.from_arrays([pa.array([slug], pa.string()), xml], ["volume_slug", "xml"])

    for batch in batches:
        for name, section, line in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).cast(pa.binary()).to_pylist()):
            if name != slug:
                yield from made()
                slug, out, seen, bare, last = name, bytearray(), set(), False, None
            seen.add(section)
            bare = bare or section == 0 and line is None
            if line is not None and not (section == 1 and line == last):
                out += line
                out += b"\n"
            last = line
    yield from made()


def markdown_fragment(b: Column | None = None) -> Column:
    """One block (a struct, or else the row) as Markdown that ends in a blank line; nothing for headers, footers, contents and notes."""
    c = lambda name: F.col(name) if b is None else b[name]
    t, kind = T.strip(F.coalesce(c("text"), F.lit(""))), c("type")
    some = lambda body: F.when(t != "", body).otherwise("")
    say = F.coalesce(F.nullif(t, F.lit("")), F.nullif(T.strip(F.coalesce(c("description"), F.lit(""))), F.lit("")))
    rows = F.array_join(F.transform(_lines(t), lambda x: F.concat(F.lit("- "), x)), "\n")
    markup = T.strip(F.coalesce(c("html"), F.lit("")))
    return (
        F.when(kind.isin("page-header", "page-footer", "table-of-contents", "footnote"), "")
        .when(kind == "section-header", some(F.concat(F.lit("#### "), t, F.lit("\n\n"))))
        .when(kind == "caption", some(F.concat(F.lit("*"), t, F.lit("*\n\n"))))
        .when(kind.isin(*VISUAL), F.concat(F.lit("> **["), F.initcap(kind), F.lit(" · "), c("block_id"), F.lit("]**"), F.coalesce(F.concat(F.lit(" "), say), F.lit("")), F.lit("\n\n")))
        .when((kind == "table") & (markup != ""), F.concat(markup, F.lit("\n\n")))
        .when(kind == "equation", some(F.concat(F.lit("$$\n"), t, F.lit("\n$$\n\n"))))
        .when(kind.isin("bibliography", "list"), F.when(rows != "", F.concat(rows, F.lit("\n\n"))).otherwise(""))
        .otherwise(some(F.concat(t, F.lit("\n\n"))))
    )


def article_markdown(rows: DataFrame) -> DataFrame:
    """article_id, body: pages under their headings, blocks in reading order, broken words joined within a page."""
    pages = rows.withColumn("_f", markdown_fragment()).groupBy("article_id", "page_ord", "page_num").agg(_join(["reading_pos"], "_f").alias("_p"))
    return _bodies(pages)


def pages_markdown(pages: DataFrame) -> DataFrame:
    """article_id, body, as `article_markdown`, of pages with their blocks in reading order (`layout.ordered_pages`): no row for each block."""
    made = F.array_join(F.transform("blocks", lambda b: markdown_fragment(b)), "")
    return _bodies(pages.where(F.size("blocks") > 0).select("article_id", "page_ord", "page_num", made.alias("_p")))


def _bodies(pages: DataFrame, run: int = 4096) -> DataFrame:
    """Pages under their headings, joined by article: runs of pages first, by all tasks, so that none sorts all pages of an article."""
    page = F.concat(F.lit("### Page "), F.col("page_num").cast("string"), F.lit("\n\n"), T.join_hyphens(F.col("_p")))
    runs = pages.select("article_id", "page_ord", F.floor(F.col("page_ord") / run).alias("_run"), page.alias("_p")).groupBy("article_id", "_run").agg(_join(["page_ord"], "_p").alias("_p"))
    return runs.groupBy("article_id").agg(_join(["_run"], "_p").alias("body"))


def html_block(linked: Column | None = None, targets: Column | None = None) -> Column:
    """One block for reading; linked: its text as HTML with references, else escaped; targets: notes that markers in tables link to."""
    t, kind = linked if linked is not None else T.html_escape(F.col("text"), False), F.col("type")
    t = F.replace(t, F.lit("\n"), F.lit("<br>"))
    wrap = lambda tag, cls="": F.concat(F.lit(f"<{tag}{cls}>"), t, F.lit(f"</{tag}>"))
    rows = F.array_join(F.transform(_lines(F.col("text")), lambda x: F.concat(F.lit("<li>"), T.html_escape(x, False), F.lit("</li>"))), "")
    src = F.concat(F.lit('<figure><img src="../regions/'), "block_id", F.lit('.png" alt="'), T.html_escape(F.coalesce("description", "text")), F.lit('"></figure>'))
    return (
        F.when(kind.isin("page-header", "page-footer", "footnote", "table-of-contents"), "")
        .when(kind == "section-header", wrap("h3"))
        .when(kind == "caption", wrap("figcaption"))
        .when(kind.isin(*VISUAL), src)
        .when((kind == "table") & (F.col("html") != ""), rich_html(targets))
        .when(kind.isin("bibliography", "list"), F.concat(F.lit("<ul>"), rows, F.lit("</ul>")))
        .when(kind == "equation", wrap("div", ' class="equation"'))
        .otherwise(wrap("p"))
    )


def rich_html(targets: Column | None = None) -> Column:
    """A block's own HTML, allowed tags only, its markers linked to notes."""
    clean = T.sanitize_block(F.col("html"))
    return clean if targets is None else footnotes.link_markers(clean, targets)


def page_shell(title: Column, body: Column, lang: str = "de", assets: str = "..") -> Column:
    return F.concat(F.lit(f'<!doctype html>\n<html lang="{lang}"><head><meta charset="utf-8"><title>'), T.html_escape(title, False), F.lit(f'</title><link rel="stylesheet" href="{assets}/edition.css"></head><body>\n'), body, F.lit("\n</body></html>"))


def notes_html(found: DataFrame) -> DataFrame:
    """article_id, notes_html: an article's notes in order, each with the id that references link to."""
    note = F.concat(F.lit('<div class="footnote" id="'), T.html_escape(F.col("html_id")), F.lit('"><span class="footnote-num">'), F.col("n").cast("string"), F.lit('</span><span class="footnote-body">'), T.sanitize_inline(F.col("text")), F.lit("</span></div>"))
    rows = found.withColumn("_f", note).groupBy("article_id").agg(_join(["page_ord", "reading_pos"], "_f").alias("_n"))
    return rows.select("article_id", F.concat(F.lit('<aside class="footnotes">'), "_n", F.lit("</aside>")).alias("notes_html"))


def article_html(rows: DataFrame, nav: DataFrame, found: DataFrame, linked: DataFrame) -> DataFrame:
    """article_id, html: reading view by pages with links to the neighbouring articles and to the article's notes.

    rows: blocks of articles with title; nav: article_id, title, author, prev, next; found and linked: notes and references. The
    header that repeats the title on an article's first page is left out.
    """
    rows = footnotes.with_html(rows, linked, found)
    repeats = (F.col("type") == "section-header") & (F.col("page_ord") == 0) & (F.substring(T.strip(F.col("text")), 1, 30) == F.substring("title", 1, 30))
    rows = rows.withColumn("_f", F.when(~F.coalesce(repeats, F.lit(False)), html_block(F.col("text_html"), F.col("targets"))))
    pages = rows.groupBy("article_id", "page_ord", "page_num").agg(_join(["reading_pos"], "_f", "\n").alias("_p"))
    pages = pages.withColumn("_p", F.concat(F.format_string('<span class="pb" id="pb-%d">%d</span>\n', "page_num", "page_num"), "_p"))
    body = pages.groupBy("article_id").agg(_join(["page_ord"], "_p", "\n").alias("_b"))
    link = lambda c, label: F.coalesce(F.concat(F.lit('<a href="'), F.col(c), F.lit(f'.html">{label}</a>')), F.lit(""))
    out = nav.select("article_id", "title", "author", "prev", "next").join(body, "article_id").join(notes_html(found), "article_id", "left")
    head = F.concat(F.lit("<nav>"), link("prev", "previous"), link("next", "next"), F.lit("</nav>\n<h1>"), T.html_escape(F.col("title"), False), F.lit('</h1>\n<p class="author">'), T.html_escape(F.coalesce("author", F.lit("")), False), F.lit("</p>\n"))
    return out.select("article_id", page_shell(F.col("title"), F.concat(head, F.col("_b"), F.coalesce(F.concat(F.lit("\n"), "notes_html"), F.lit("")))).alias("html"))


def crop_manifest(blocks: DataFrame) -> DataFrame:
    """volume_slug, block_id, crop_file, box of the pictures worth cutting out: four pixels or more either way, clamped to the page."""
    x1, y1 = F.greatest(F.lit(0), F.col("x1")), F.greatest(F.lit(0), F.col("y1"))
    x2, y2 = F.least("image_width", "x2"), F.least("image_height", "y2")
    return blocks.where(F.col("type").isin(*VISUAL) & (x2 - x1 >= 4) & (y2 - y1 >= 4)).select("volume_slug", "block_id", F.concat("block_id", F.lit(".png")).alias("crop_file"), F.array(x1, y1, x2, y2).alias("box"))
