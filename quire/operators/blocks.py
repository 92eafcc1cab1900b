"""Raw pages to blocks: canonical types, pixel boxes, descriptions and the fallback to a page's markdown."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..schemas import CANON_TYPES, VISUAL


def canonical_type(c: Column, types: dict[str, str] = CANON_TYPES) -> Column:
    """The canonical type of a label such as `List_Item` or `BlockType.PICTURE`; text for null and unknown ones. types: by label, as in schemas."""
    label = T.strip(F.replace(F.lower(c), F.lit("_"), F.lit("-")))
    label = F.regexp_replace(label, "^.*\\.", "")
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in types.items() for x in kv]), label), F.lit("text"))


def pixel_bbox(bbox: Column, w: Column, h: Column) -> Column:
    """x1, y1, x2, y2 in whole pixels: fractions of the page are scaled, each side is clamped at its own end, then ordered."""
    x1, y1, x2, y2 = (F.try_element_at(bbox, F.lit(i)) for i in (1, 2, 3, 4))
    small = F.greatest(*(F.abs(v) for v in (x1, y1, x2, y2))) <= 1.5
    sx, sy = F.when(small, w).otherwise(1), F.when(small, h).otherwise(1)
    ax, bx = F.greatest(F.lit(0.0), x1 * sx), F.least(w.cast("double"), x2 * sx)
    ay, by = F.greatest(F.lit(0.0), y1 * sy), F.least(h.cast("double"), y2 * sy)
    px = lambda v: F.rint(v).cast("int")  # noqa: E731  half to even
    box = F.struct(px(F.least(ax, bx)).alias("x1"), px(F.least(ay, by)).alias("y1"), px(F.greatest(ax, bx)).alias("x2"), px(F.greatest(ay, by)).alias("y2"))
    full = F.struct(F.lit(0).alias("x1"), F.lit(0).alias("y1"), w.cast("int").alias("x2"), h.cast("int").alias("y2"))
    return F.when(bbox.isNull() | (F.size(bbox) < 4), full).otherwise(box)


def extract_blocks(pages: DataFrame) -> DataFrame:
    """Fill what versions of the layout model name differently: type from label or block_type, text from content or html, ids by place."""
    first = lambda *cs: F.coalesce(*[F.nullif(c, F.lit("")) for c in cs])
    fill = lambda b, i: F.struct(
        F.coalesce(first(b["id"]), F.format_string("p%d_b%03d", F.col("page_num"), i + 1)).alias("id"),
        F.replace(F.lower(F.coalesce(first(b["label"], b["block_type"], b["type"]), F.lit("text"))), F.lit("_"), F.lit("-")).alias("type"),
        b["bbox"].alias("bbox"),
        F.coalesce(first(b["text"], b["content"]), T.html_to_text(b["html"])).alias("text"),
        F.coalesce(b["html"], F.lit("")).alias("html"),
    )
    return pages.withColumn("blocks", F.transform("blocks", fill))


def unify(pages: DataFrame) -> DataFrame:
    """One row for each block, in the order they were emitted: volume_slug, page_num, image_*, emit_pos, block_id, type, raw_type, x1..y2, text, html.

    A page without blocks gives one text block of its markdown, or nothing if that is empty too.
    """
    fallback = F.array(F.struct(F.format_string("p%d_b001", F.col("page_num")).alias("id"), F.lit("text").alias("type"), F.lit(None).cast("array<double>").alias("bbox"), T.strip(F.col("markdown")).alias("text"), F.lit("").alias("html")))
    has = F.coalesce(F.size("blocks"), F.lit(0)) > 0
    some = F.when(has, F.col("blocks")).when(T.strip(F.coalesce("markdown", F.lit(""))) != "", fallback)
    rows = pages.select("volume_slug", "page_num", "image_filename", "image_width", "image_height", F.posexplode(some).alias("emit_pos", "b"))
    rows = rows.withColumn("box", pixel_bbox(F.col("b.bbox"), F.col("image_width"), F.col("image_height")))
    return rows.select(
        "volume_slug", "page_num", "image_filename", "image_width", "image_height", "emit_pos", F.col("b.id").alias("block_id"),
        canonical_type(F.col("b.type")).alias("type"), F.coalesce("b.type", F.lit("")).alias("raw_type"), "box.*", T.strip(F.coalesce("b.text", F.lit(""))).alias("text"), F.coalesce("b.html", F.lit("")).alias("html"),
    )


def describe(blocks: DataFrame) -> DataFrame:
    """Add description: the alternative text of pictures, null elsewhere and where it is empty."""
    return blocks.withColumn("description", F.when(F.col("type").isin(*VISUAL), F.nullif(T.alt_text(F.col("html")), F.lit(""))))


def type_histogram(blocks: DataFrame) -> DataFrame:
    """raw_type, type and how often, most frequent first; equally frequent ones as they came."""
    return blocks.groupBy("raw_type", "type").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("page_num", "emit_pos")).alias("_first")).orderBy(F.desc("n"), "_first").drop("_first")
