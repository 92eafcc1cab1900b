"""Columns, reading order and bands of pages, on one row for each page with its blocks as an array: no shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import SPANNING


def fixed(df: DataFrame) -> DataFrame:
    """The same rows behind a generator, so that the optimiser doesn't repeat what they hold in each place that uses it."""
    return df.select(F.inline(F.array(F.struct(*df.columns))))


def pages_of(blocks: DataFrame, keys: tuple[str, ...] = ("volume_slug", "page_num", "image_width", "image_height")) -> DataFrame:
    """Blocks gathered by page, in the order they were emitted. A page's blocks are few."""
    fields = [c for c in blocks.columns if c not in keys]
    return fixed(blocks.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("emit_pos", *[c for c in fields if c != "emit_pos"]))).alias("blocks")))


def masthead_top(blocks: Column) -> Column:
    """Where the columns of a page begin: the top of the highest block that stands beside another, null if none does.

    Beside: one ends before the other starts, and their heights overlap. Of a pair the upper top counts; as that is the top of a
    block that has a neighbour, and no block with one lies higher than its pair, it is enough to ask each block for a neighbour.
    """
    inside = F.filter(blocks, lambda b: ~b["type"].isin(*SPANNING))
    beside = lambda a, b: (a["emit_pos"] != b["emit_pos"]) & (F.least(a["y2"], b["y2"]) > F.greatest(a["y1"], b["y1"])) & ((a["x2"] <= b["x1"]) | (b["x2"] <= a["x1"]))
    return F.array_min(F.transform(F.filter(inside, lambda a: F.exists(inside, lambda b: beside(a, b))), lambda b: b["y1"]))


def detect_columns(pages: DataFrame, min_blocks: int = 2, width: float = 0.6, min_gap: float = 0.06, masthead: bool = False) -> DataFrame:
    """Add cols (l0, l1, r0, r1), null on pages of one column: blocks either side of the widest gap between block centres.

    masthead: blocks that lie wholly above where columns begin span the page and tell nothing of the gap; masthead_top is added.
    """
    w = F.col("image_width")
    centre = lambda b: (b["x1"] + b["x2"]) / 2
    if masthead:
        pages = fixed(pages.withColumn("masthead_top", masthead_top(F.col("blocks"))))
    above = lambda b: F.coalesce(b["y2"] <= F.col("masthead_top"), F.lit(False)) if masthead else F.lit(False)
    inside = F.filter("blocks", lambda b: ~b["type"].isin(*SPANNING) & (b["x2"] - b["x1"] <= w * width) & ~above(b))
    # few narrow layers: what a layer holds is copied, and sort_array compares without a lambda
    pages = fixed(pages.withColumn("_m", F.sort_array(F.transform(inside, lambda b: F.struct(centre(b).alias("c"), b["x1"].alias("x1"), b["x2"].alias("x2"))))))
    gap = lambda m, i: F.when(i > 0, F.struct((m["c"] - F.get("_m", i - 1)["c"]).alias("gap"), (-i).alias("rank")))
    pages = fixed(pages.withColumn("_g", F.when(F.size("_m") >= max(2, 2 * min_blocks), F.array_max(F.transform("_m", gap)))))
    n = -F.col("_g.rank")  # so many lie left of the gap
    mid = F.floor((F.get("_m", n)["c"] + F.get("_m", n - 1)["c"]) / 2).cast("int")
    left, right = F.slice("_m", F.lit(1), n), F.slice("_m", n + 1, F.size("_m"))
    cols = F.struct(
        F.array_min(left["x1"]).alias("l0"), F.least(F.array_max(left["x2"]), mid).alias("l1"),
        F.greatest(F.array_min(right["x1"]), mid).alias("r0"), F.array_max(right["x2"]).alias("r1"),
    )
    ok = (F.col("_g.gap") > 0) & (F.col("_g.gap") >= w * min_gap) & (n >= min_blocks) & (F.size("_m") - n >= min_blocks)
    return fixed(pages.withColumn("cols", F.when(ok, cols)).drop("_m", "_g"))


def column_of(b: Column, cols: Column, page_width: Column) -> Column:
    """0 or 1, null for blocks that span: by type, by width, or by lying in both columns."""
    w = b["x2"] - b["x1"]
    within = lambda lo, hi: F.greatest(F.lit(0), F.least(b["x2"], hi) - F.greatest(b["x1"], lo)) >= F.greatest(F.lit(1), w) * 0.3
    cx = (b["x1"] + b["x2"]) / 2
    far = lambda lo, hi: F.abs(cx - (lo + hi) / 2)
    l, r = (cols["l0"], cols["l1"]), (cols["r0"], cols["r1"])
    spans = b["type"].isin(*SPANNING) | (w > page_width * 0.6) | (within(*l) & within(*r))
    return F.when(cols.isNull() | spans, None).when(far(*l) <= far(*r), 0).otherwise(1)


def _column(pages: DataFrame):
    """The column of a block of pages that have cols; blocks above masthead_top, where the pages have it, span."""
    above = lambda b: F.coalesce(b["y2"] <= F.col("masthead_top"), F.lit(False)) if "masthead_top" in pages.columns else F.lit(False)
    return lambda b: F.when(~above(b), column_of(b, F.col("cols"), F.col("image_width")))


def assign_columns(pages: DataFrame) -> DataFrame:
    """Each block gets col; blocks above masthead_top, where the pages have it, span."""
    col = _column(pages)
    return fixed(pages.withColumn("blocks", F.transform("blocks", lambda b: b.withField("col", col(b)))))


def _sorted(pages: DataFrame) -> tuple[DataFrame, Column]:
    """Pages with what their order is made from (_k, _ys), and their blocks (b, with its col) in reading order.

    On pages of two columns blocks are ordered by band (how many spanning blocks start above), columns before what spans,
    column and height; elsewhere as they were emitted.
    """
    col, two, zero = _column(pages), F.col("cols").isNotNull(), F.lit(0)
    pages = fixed(pages.withColumn("_k", F.when(two, F.transform("blocks", lambda b: F.struct(col(b).alias("col"), b["y1"].alias("y"))))))
    pages = fixed(pages.withColumn("_ys", F.filter("_k", lambda k: k["col"].isNull())["y"]).withColumn("_k", F.col("_k.col")))
    at = lambda i: F.get("_k", i)
    key = lambda b, i: F.struct(
        F.size(F.filter("_ys", lambda y: y < b["y1"])).alias("band"), at(i).isNull().cast("int").alias("phase"),
        F.coalesce(at(i), zero).alias("c"), b["y1"].alias("y"), b["emit_pos"].alias("e"), b.alias("b"), at(i).alias("col"),
    )
    flat = lambda b: F.struct(zero.alias("band"), zero.alias("phase"), zero.alias("c"), zero.alias("y"), b["emit_pos"].alias("e"), b.alias("b"), F.lit(None).cast("int").alias("col"))
    return pages, F.sort_array(F.when(two, F.transform("blocks", key)).otherwise(F.transform("blocks", flat)))


def ordered_pages(pages: DataFrame, fields: tuple[str, ...]) -> DataFrame:
    """Pages with these fields of their blocks, in reading order: for what is made of whole pages, without a row for each block."""
    pages, ordered = _sorted(pages)
    return fixed(pages.withColumn("blocks", F.transform(ordered, lambda o: F.struct(*[o["b"][f].alias(f) for f in fields]))).drop("_k", "_ys"))


def reading_order(pages: DataFrame) -> DataFrame:
    """One row for each block in reading order (see `_sorted`), with col and reading_pos from 0."""
    fields = [f.name for f in pages.schema["blocks"].dataType.elementType if f.name != "col"]
    keep = [c for c in pages.columns if c != "blocks"]
    pages, ordered = _sorted(pages)
    return pages.select(*keep, F.posexplode(ordered).alias("reading_pos", "_o")).select(*keep, "reading_pos", *[f"_o.b.{f}" for f in fields], "_o.col")


def bands(pages: DataFrame) -> DataFrame:
    """One row for each block with band and kind: a spanning block closes the run of columns above it (on a tie the column block comes after)."""
    pages = fixed(assign_columns(pages).withColumn("_ys", F.transform(F.filter("blocks", lambda b: b["col"].isNull()), lambda b: b["y1"])))
    keep = [c for c in pages.columns if c not in ("blocks", "_ys")]
    rows = pages.select(*keep, "_ys", F.explode("blocks").alias("b"))
    y = F.col("b.y1")
    band = F.when(F.col("b.col").isNull(), F.size(F.filter("_ys", lambda s: s < y))).otherwise(F.size(F.filter("_ys", lambda s: s <= y)))
    return rows.select(*keep, "b.*", band.alias("band"), F.when(F.col("b.col").isNull(), "spanning").otherwise("columns").alias("kind"))


def order_audit(ordered: DataFrame) -> DataFrame:
    """Per page: how many places differ between emitted and reading order, and how many hyphen breaks don't go on in lower case.

    ordered: rows of `reading_order` with text. A break is prose that ends in a hyphen without a space before it.
    """
    from pyspark.sql import Window

    w = Window.partitionBy("volume_slug", "page_num").orderBy("reading_pos")
    rows = ordered.withColumn("_next", F.lead("text").over(w))
    broken = F.col("text").rlike("[^ ]-$") & F.col("_next").isNotNull() & ~F.col("_next").rlike("^[a-zäöüß]")
    return rows.groupBy("volume_slug", "page_num").agg(F.count_if(F.col("emit_pos") != F.col("reading_pos")).alias("moved"), F.count_if(broken).alias("broken"), F.count(F.lit(1)).alias("blocks"))


def overlay(b: Column, w: Column, h: Column) -> Column:
    """left, top, width, height of a block in per cent with three decimals, clamped to the page; null if under a pixel either way."""
    x1, y1 = F.greatest(F.lit(0), b["x1"]), F.greatest(F.lit(0), b["y1"])
    x2, y2 = F.least(w, b["x2"]), F.least(h, b["y2"])
    pct = lambda v, of: F.format_string("%.3f", v * 100.0 / of)
    return F.when((x2 - x1 >= 1) & (y2 - y1 >= 1), F.struct(pct(x1, w).alias("left"), pct(y1, h).alias("top"), pct(x2 - x1, w).alias("width"), pct(y2 - y1, h).alias("height")))
