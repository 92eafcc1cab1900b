"""The HTML edition beside its articles: a volume's index, pages as facsimile with transcription by bands, contents as rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..schemas import VISUAL
from . import footnotes, layout, render


def _div(name: str, body: Column | str) -> Column:
    return F.concat(F.lit(f'<div class="{name}">'), F.lit(body) if isinstance(body, str) else body, F.lit("</div>"))


def contents_html(toks: DataFrame, key: str = "volume_slug") -> DataFrame:
    """key, html: contents as rows with leaders and page numbers, a title and headers between them. toks: rows of `toc.tokens`."""
    text = T.sanitize_inline(F.col("token"))
    page = F.coalesce(F.concat(F.lit('<span class="toc-block-page">'), T.html_escape(F.nullif("page", F.lit(""))), F.lit("</span>")), F.lit(""))
    row = _div("toc-block-row", F.concat(F.lit('<span class="toc-block-text">'), text, F.lit('</span><span class="toc-block-leader"></span>'), page))
    made = F.when(F.col("kind") == "title", _div("toc-block-title", text)).when(F.col("kind") == "header", _div("toc-block-section", text)).otherwise(row)
    rows = toks.withColumn("_f", made).groupBy(key).agg(F.array_sort(F.collect_list(F.struct("pos", "_f"))).alias("_r"))
    return rows.select(key, F.array_join(F.transform("_r", lambda r: r["_f"]), "").alias("html"))


def totals(articles: DataFrame, bridge: DataFrame, ordered: DataFrame | None = None) -> DataFrame:
    """volume_slug, n_articles (front matter apart), n_pages (a page counts in each article that has it), and n_regions, the blocks of `ordered`, if given."""
    named = articles.groupBy("volume_slug").agg(F.count_if(F.col("num") > 0).alias("n_articles"))
    held = bridge.groupBy("volume_slug").agg(F.count(F.lit(1)).alias("n_pages"))
    out = named.join(held, "volume_slug", "left").na.fill(0, ["n_pages"])
    if ordered is None:
        return out
    regions = ordered.groupBy("volume_slug").agg(F.count(F.lit(1)).alias("n_regions"))
    return out.join(regions, "volume_slug", "left").na.fill(0, ["n_regions"])


def volume_index(volumes: DataFrame, articles: DataFrame, bridge: DataFrame, pages: DataFrame) -> DataFrame:
    """volume_slug, html: cover, totals and the list of a volume's articles, and the way to its first page."""
    e = lambda name: T.html_escape(F.coalesce(F.col(name), F.lit("")))
    item = F.concat(
        F.format_string('<li class="toc-item"><span class="toc-num">%02d</span><span class="toc-title"><a href="articles/%s.html">', "num", "article_id"), e("title"),
        F.lit('</a></span><span class="toc-author">'), e("author"), F.format_string('</span><span class="toc-pages">S. %d–%d</span></li>', "page_first", "page_last"),
    )
    rows = articles.where("num > 0").select("volume_slug", "num", item.alias("_f")).groupBy("volume_slug").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("num", "_f"))), lambda r: r["_f"]), "\n").alias("_b"))
    first = pages.groupBy("volume_slug").agg(F.min("page_num").alias("_first"))
    out = volumes.join(first, "volume_slug").join(totals(articles, bridge), "volume_slug", "left").join(rows, "volume_slug", "left")
    strip = F.format_string('<section class="meta-strip"><span>№ %d</span><span>%d articles</span><span>%d pages</span><span>', "volume_number", F.coalesce("n_articles", F.lit(0)), F.coalesce("n_pages", F.lit(0)))
    body = F.concat(
        F.lit('<section class="cover"><p>'), e("editor"), F.lit('</p><h1 class="title">'), e("volume_title"), F.lit("</h1><p>"), e("volume_number_roman"), F.lit("</p><p>"), F.col("volume_year").cast("string"), F.lit("</p></section>\n"),
        strip, e("publisher"), F.lit('</span></section>\n<section class="toc" id="contents"><ol class="toc-list">\n'), F.coalesce("_b", F.lit("")), F.format_string('\n</ol></section>\n<p><a href="pages/page-%04d.html">facsimile</a></p>', "_first"),
    )
    return out.select("volume_slug", render.page_shell(F.concat_ws(" ", "volume_title", "volume_number_roman"), body, assets=".").alias("html"))


def region(text_html: Column, targets: Column) -> Column:
    """One block of a transcription: pictures with what was read in them, its own HTML, or its text with references linked."""
    kind, rich = F.col("type"), render.rich_html(targets)
    own = F.coalesce("html", F.lit("")) != ""
    body = (
        F.when(kind.isin(*VISUAL) & own, rich).when(kind.isin(*VISUAL), F.concat(F.lit("<em>["), kind, F.lit("]</em>")))
        .when(own, rich).otherwise(text_html)
    )
    box = F.format_string("%d,%d,%d,%d", "x1", "y1", "x2", "y2")
    extra = F.when(kind == "table-of-contents", " toc-block").otherwise("")
    return F.concat(F.lit('<div class="region'), extra, F.lit('" data-type="'), kind, F.lit('" data-bbox="'), box, F.lit('" id="'), T.html_escape(F.coalesce("html_id", "block_id")), F.lit('" data-column="'), F.coalesce(F.col("col").cast("string"), F.lit("span")), F.lit('">'), body, F.lit("</div>"))


def by_bands(parts: Column, split: Column) -> Column:
    """HTML of a page's blocks (array of struct band, kind, col, y, e, f): top to bottom, or bands of two columns between what spans them."""
    join = lambda rows: F.array_join(F.transform(F.array_sort(F.transform(rows, lambda r: F.struct(r["y"].alias("y"), r["e"].alias("e"), r["f"].alias("f")))), lambda r: r["f"]), "")
    column = lambda run, i: F.concat(F.lit(f'<div class="trans-col" data-col="{i}">'), join(F.filter(run, lambda r: r["col"] == i)), F.lit("</div>"))
    spans = F.transform(F.filter(parts, lambda r: r["kind"] == "spanning"), lambda r: F.struct(r["band"].alias("band"), F.lit(1).alias("phase"), r["y"].alias("y"), r["e"].alias("e"), _div("trans-span", r["f"]).alias("f")))
    runs = F.array_distinct(F.transform(F.filter(parts, lambda r: r["kind"] == "columns"), lambda r: r["band"]))
    one = lambda run: _div("trans-columns", F.concat(column(run, 0), column(run, 1)))
    cols = F.transform(runs, lambda b: F.struct(b.alias("band"), F.lit(0).alias("phase"), F.lit(0).alias("y"), F.lit(0).alias("e"), one(F.filter(parts, lambda r: (r["kind"] == "columns") & (r["band"] == b))).alias("f")))
    return F.when(split, F.array_join(F.transform(F.array_sort(F.concat(cols, spans)), lambda r: r["f"]), "")).otherwise(join(parts))


def overlay_html() -> Column:
    """A link over a block's place on the facsimile; nothing for blocks under a pixel."""
    o = layout.overlay(F.struct("x1", "y1", "x2", "y2"), F.col("image_width"), F.col("image_height"))
    style = F.concat(F.lit("left:"), o["left"], F.lit("%;top:"), o["top"], F.lit("%;width:"), o["width"], F.lit("%;height:"), o["height"], F.lit("%;"))
    bid, kind = T.html_escape(F.col("block_id")), T.html_escape(F.col("type"))
    return F.coalesce(F.concat(F.lit('<a class="region-box" data-type="'), kind, F.lit('" href="#'), bid, F.lit('" style="'), style, F.lit('" title="'), kind, F.lit('"></a>')), F.lit(""))


def facsimiles(banded: DataFrame, volumes: DataFrame, found: DataFrame, linked: DataFrame) -> DataFrame:
    """volume_slug, page_num, html: a page's picture with its regions, its transcription, and links to the pages beside it.

    banded: rows of `layout.bands` with the names of pages; found and linked: notes and references with volume_slug. A page that
    several articles share has the notes of the first of them by id.
    """
    keys = ["volume_slug", "page_num"]
    own = found.groupBy(*keys, "block_id").agg(F.min("html_id").alias("html_id"))
    first = banded.select(*keys).distinct().join(found.select(*keys, "article_id").unionByName(linked.select(*keys, "article_id")).groupBy(*keys).agg(F.min("article_id").alias("article_id")), keys, "left")
    rows = banded.join(own, [*keys, "block_id"], "left").join(first, keys)
    rows = footnotes.with_html(rows, linked, found)
    part = F.struct("band", "kind", "col", F.col("y1").alias("y"), F.col("emit_pos").alias("e"), region(F.col("text_html"), F.col("targets")).alias("f"))
    box = F.struct("emit_pos", overlay_html().alias("f"))
    pages = rows.groupBy(*keys, "image_filename").agg(F.collect_list(part).alias("parts"), F.array_join(F.transform(F.array_sort(F.collect_list(box)), lambda r: r["f"]), "").alias("boxes"), F.bool_or(F.col("cols").isNotNull()).alias("split"))
    w = Window.partitionBy("volume_slug").orderBy("page_num")
    pages = layout.fixed(pages).withColumn("prev", F.lag("page_num").over(w)).withColumn("next", F.lead("page_num").over(w)).withColumn("last", F.max("page_num").over(Window.partitionBy("volume_slug")))
    turn = lambda to, rel: F.coalesce(F.concat(F.format_string('<a href="page-%04d.html" rel="', F.col(to)), F.when(F.col(to).isNotNull(), rel), F.lit(f'">{rel}</a>')), F.lit(""))
    body = F.concat(
        F.lit('<section class="facsimile-view"><div class="facsimile"><img class="facsimile-img" src="../pages-img/'), T.html_escape(F.col("image_filename")), F.format_string('" alt="Page %d"><div class="region-overlay">', "page_num"), F.col("boxes"),
        F.lit('</div></div>\n<div class="transcription">'), by_bands(F.col("parts"), F.col("split")), F.lit('</div></section>\n<div class="page-nav">'), turn("prev", "prev"), F.format_string('<span class="current">p. %d / %d</span>', "page_num", "last"), turn("next", "next"), F.lit("</div>"),
    )
    title = F.concat(F.lit("Page "), F.col("page_num").cast("string"), F.lit(" — "), F.concat_ws(" ", "volume_title", "volume_number_roman"))
    return pages.join(volumes, "volume_slug").select(*keys, render.page_shell(title, body).alias("html"))
