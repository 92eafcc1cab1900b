"""Articles of a volume: printed page offsets, spans, owners of pages, titles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T


def running_numbers(blocks: DataFrame, margin: float = 0.08) -> DataFrame:
    """volume_slug, page_num, pos, printed: page numbers printed in headers and footers, or alone on a line at a page's top or bottom."""
    whole = F.col("type").isin("page-header", "page-footer") & F.col("text").rlike("^\\s*[0-9]{1,4}\\s*$")
    edge = (F.col("y1") <= F.col("image_height") * margin) | (F.col("y2") >= F.col("image_height") * (1 - margin))
    lines = F.filter(F.transform(F.split("text", "\\R"), lambda x: F.btrim(x)), lambda x: x.rlike("^[0-9]{1,4}$") & (x.try_cast("int") >= 1))
    printed = F.when(whole, F.btrim("text").try_cast("int")).when(edge, F.try_element_at(lines, F.lit(1)).cast("int"))
    return blocks.select("volume_slug", "page_num", F.col("emit_pos").alias("pos"), printed.alias("printed")).where("printed is not null")


def printed_offset(numbers: DataFrame) -> DataFrame:
    """volume_slug, offset: the commonest difference of page and printed number, first seen on ties.

    At least three numbers are needed, and a quarter of them (three or more) must agree.
    """
    diff = numbers.withColumn("offset", F.col("page_num") - F.col("printed"))
    each = diff.groupBy("volume_slug", "offset").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("page_num", "pos")).alias("seen"))
    best = each.groupBy("volume_slug").agg(F.sum("n").alias("total"), F.min(F.struct((-F.col("n")).alias("m"), "seen", "offset")).alias("b"))
    return best.where((F.col("total") >= 3) & (-F.col("b.m") >= F.greatest(F.lit(3), F.floor(F.col("total") / 4)))).select("volume_slug", F.col("b.offset").alias("offset"))


def spans(anchors: DataFrame, pages: DataFrame) -> DataFrame:
    """Articles from their first pages: volume_slug, num, page_first, page_last, plus anchors' columns, and Frontmatter (num 0) before them.

    anchors: volume_slug, pdf_page, toc_pos, page_end (null or the last page), ...; those outside the volume's pages go. An
    article ends before the next one starts, the last one at the volume's end; a page_end inside that span shortens it.
    """
    ends = pages.groupBy(F.col("volume_slug").alias("_v")).agg(F.min("page_num").alias("_lo"), F.max("page_num").alias("_hi"))
    a = anchors.join(ends, anchors["volume_slug"] == F.col("_v")).drop("_v").where("pdf_page between _lo and _hi")
    w = Window.partitionBy("volume_slug").orderBy("pdf_page", "toc_pos")
    last = F.greatest(F.coalesce(F.lead("pdf_page").over(w) - 1, F.col("_hi")), F.col("pdf_page"))
    a = a.withColumn("num", F.row_number().over(w)).withColumn("_last", last).withColumn("_first_page", F.first("pdf_page").over(w))
    a = a.withColumn("page_last", F.when(F.col("page_end").between(F.col("pdf_page"), F.col("_last")), F.col("page_end")).otherwise(F.col("_last")))
    a = a.withColumnRenamed("pdf_page", "page_first")
    front = a.where((F.col("num") == 1) & (F.col("_first_page") > F.col("_lo"))).select("volume_slug", F.lit(0).alias("num"), F.col("_lo").alias("page_first"), (F.col("_first_page") - 1).alias("page_last"), F.lit("Frontmatter").alias("title"))
    rest = [c for c in a.columns if c not in ("_lo", "_hi", "_last", "_first_page", "page_end", "toc_pos")]
    out = front.unionByName(a.select(*rest), allowMissingColumns=True)
    return out.withColumn("article_id", F.when(F.col("num") == 0, F.concat("volume_slug", F.lit("-frontmatter"))).otherwise(F.format_string("%s-art%02d", "volume_slug", "num")))


def article_pages(articles: DataFrame, pages: DataFrame, run: int = 256) -> DataFrame:
    """article_id, page_num, ord: the pages of each article that exist; a page may belong to several.

    A range join by runs of page numbers: an article stands once in each run that it touches, whether its pages are there or not.
    """
    at = lambda c: F.floor(F.col(c) / run)
    runs = F.when(F.col("page_last") >= F.col("page_first"), F.sequence(at("page_first"), at("page_last")))
    rows = articles.select("volume_slug", "article_id", "num", "page_first", "page_last", F.explode(runs).alias("_run"))
    held = pages.select("volume_slug", "page_num").distinct().withColumn("_run", at("page_num")).join(rows, ["volume_slug", "_run"]).where("page_num between page_first and page_last")
    return held.select("volume_slug", "page_num", "article_id", "num", (F.col("page_num") - F.col("page_first")).cast("int").alias("ord"))


def page_owner(bridge: DataFrame, pages: DataFrame) -> DataFrame:
    """volume_slug, page_num, owner: the first article with the page, front matter apart; null if none has it."""
    first = bridge.where("num > 0").groupBy("volume_slug", "page_num").agg(F.min_by("article_id", "num").alias("owner"))
    return pages.select("volume_slug", "page_num").distinct().join(first, ["volume_slug", "page_num"], "left")


def neighbours(articles: DataFrame) -> DataFrame:
    """prev and next article of each but the front matter."""
    w = Window.partitionBy("volume_slug").orderBy("num")
    return articles.where("num > 0").withColumn("prev", F.lag("article_id").over(w)).withColumn("next", F.lead("article_id").over(w))


def word_overlap(a: Column, b: Column) -> Column:
    """How many different words two heading keys share."""
    return F.size(F.array_intersect(F.array_distinct(F.split(a, " ")), F.array_distinct(F.split(b, " "))))


def match_titles(expected: DataFrame, headers: DataFrame) -> DataFrame:
    """volume_slug, page_num, toc_pos, header: for each title expected on a page the header in its upper half that matches best.

    A header matches if it starts with the title's first four words or the title with the header's; among these the most shared
    words win (at least one), the first on ties.
    """
    lead = lambda c: F.array_join(F.slice(F.split(c, " "), 1, 4), " ")
    e = expected.select("volume_slug", "page_num", "toc_pos", T.heading_key(F.col("title")).alias("_t"))
    h = headers.where((F.col("type") == "section-header") & (F.col("y1") <= F.col("image_height") / 2)).select("volume_slug", "page_num", "reading_pos", "text", T.heading_key(F.col("text")).alias("_h"))
    rows = e.join(h, ["volume_slug", "page_num"]).where((F.col("_t") != "") & (F.col("_h") != "") & (F.startswith("_h", lead(F.col("_t"))) | F.startswith("_t", lead(F.col("_h")))))
    rows = rows.withColumn("score", word_overlap(F.col("_t"), F.col("_h"))).where("score > 0")
    return rows.groupBy("volume_slug", "page_num", "toc_pos").agg(F.max_by("text", F.struct("score", -F.col("reading_pos"))).alias("header"), F.max("score").alias("score"))


def toc_anchors(entries: DataFrame, offsets: DataFrame, pages: DataFrame) -> DataFrame:
    """Anchors of entries with a page, moved by the volume's offset; without one the first entry is taken to start at the first page."""
    paged = entries.where("page is not null")
    enough = paged.groupBy("volume_slug").agg(F.count(F.lit(1)).alias("_n"), F.min("page").alias("_p0")).where("_n >= 2")
    first = pages.groupBy("volume_slug").agg(F.min("page_num").alias("_lo"))
    rows = paged.join(enough, "volume_slug").join(offsets, "volume_slug", "left").join(first, "volume_slug")
    off = F.coalesce("offset", F.col("_lo") - F.col("_p0"))
    return rows.select("volume_slug", (F.col("page") + off).alias("pdf_page"), F.col("pos").alias("toc_pos"), (F.col("page_end") + off).alias("page_end"), "title", "author", "section", "raw_text")


def heuristic_anchors(ordered: DataFrame, titles: DataFrame) -> DataFrame:
    """Anchors of volumes without a usable table of contents: the topmost section header in the upper third of a page.

    Its first line is the title, its second the author. A volume without any is one article named by titles (volume_slug, title).
    """
    top = ordered.where((F.col("type") == "section-header") & (F.col("y1") < F.col("image_height") / 3))
    top = top.groupBy("volume_slug", "page_num").agg(F.min_by("text", F.struct("y1", "reading_pos")).alias("text"))
    line = lambda i: F.btrim(F.coalesce(F.try_element_at(F.split("text", "\\n"), F.lit(i)), F.lit("")))
    none = F.lit(None).cast("int")
    found = top.select("volume_slug", F.col("page_num").alias("pdf_page"), F.lit(0).alias("toc_pos"), none.alias("page_end"), line(1).alias("title"), line(2).alias("author"), F.lit(None).cast("string").alias("section"), F.lit(None).cast("string").alias("raw_text"))
    whole = ordered.groupBy("volume_slug").agg(F.min("page_num").alias("pdf_page")).join(found.select("volume_slug").distinct(), "volume_slug", "left_anti").join(titles, "volume_slug")
    return found.unionByName(whole.select("volume_slug", "pdf_page", F.lit(0).alias("toc_pos"), none.alias("page_end"), "title", F.lit("").alias("author"), F.lit(None).cast("string").alias("section"), F.lit(None).cast("string").alias("raw_text")))


def detect(ordered: DataFrame, entries: DataFrame, offsets: DataFrame, titles: DataFrame) -> DataFrame:
    """Articles by the table of contents where it has two pages or more and one lies in the volume, else by headers."""
    pages = ordered.select("volume_slug", "page_num").distinct()
    ends = pages.groupBy("volume_slug").agg(F.min("page_num").alias("_lo"), F.max("page_num").alias("_hi"))
    by_toc = toc_anchors(entries, offsets, pages).join(ends, "volume_slug").where("pdf_page between _lo and _hi").drop("_lo", "_hi")
    heads = match_titles(by_toc.withColumnRenamed("pdf_page", "page_num"), ordered).select("volume_slug", F.col("page_num").alias("pdf_page"), "toc_pos", "header")
    by_toc = by_toc.join(heads, ["volume_slug", "pdf_page", "toc_pos"], "left").withColumn("title", F.when(F.length("header") >= F.length("title"), F.regexp_replace("header", "\\s+", " ")).otherwise(F.col("title"))).drop("header")
    by_head = heuristic_anchors(ordered, titles).join(by_toc.select("volume_slug").distinct(), "volume_slug", "left_anti")
    return spans(by_toc.unionByName(by_head), pages)
