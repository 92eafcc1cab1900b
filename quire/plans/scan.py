"""Scans that go on where they stopped: what recognition said of a page is kept with the digest of the picture that it saw.

Recognition itself is given as a function. A page whose picture has changed, or is new, is recognised; all others are taken from
the table `scans`. The tables made from pages follow: `volume.run` runs a volume again when one of its pages says something else.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import RAW_PAGE
from ..sources import commits

SCANS = "volume_slug string, page_num int, image_filename string, digest string, raw string, ocr_seconds double, resumed boolean"


def page_pictures(spark: SparkSession, root: str, volumes: list[str] | None = None) -> DataFrame:
    """volume_slug, page_num, image_filename, path, digest of root/<slug>/pages/page_<n>.png."""
    paths = [f"{root}/{v}/pages/page_*.png" for v in volumes] if volumes is not None else f"{root}/*/pages/page_*.png"
    rows = spark.read.format("binaryFile").load(paths)
    name = F.substring_index("path", "/", -1)
    return rows.select(
        F.regexp_extract("path", "([^/]+)/pages/[^/]+$", 1).alias("volume_slug"), F.regexp_extract(name, "page_([0-9]+)\\.png$", 1).try_cast("int").alias("page_num"),
        name.alias("image_filename"), "path", F.sha2("content", 256).alias("digest"),
    )


def scan(spark: SparkSession, pictures: DataFrame, infer: Callable[[DataFrame], DataFrame], out: str, force: bool = False) -> DataFrame:
    """The rows of `scans` for all pictures (volume_slug, page_num, image_filename, path, digest); resumed tells which were there.

    infer: from pictures to volume_slug, page_num, raw (the page as JSON) and ocr_seconds, each page once; a page that it leaves
    out is asked for again next time. Pictures that stand twice count once, pages without a picture go from the table.
    """
    store = commits.Store(spark, out)
    commit = store.begin()
    pictures = pictures.where("volume_slug is not null and page_num is not null").dropDuplicates(["volume_slug", "page_num"])
    pictures = store.write("_pictures", commit, pictures)
    known = store.read("scans", SCANS)
    keys = ["volume_slug", "page_num"]
    valid = known.join(pictures.select(*keys, "digest"), [*keys, "digest"], "left_semi").withColumn("resumed", F.lit(True))
    if force:
        valid = valid.where("false")
    todo = store.write("_todo", commit, pictures.join(valid, [*keys, "digest"], "left_anti"))
    new = infer(todo).select(*keys, "raw", "ocr_seconds").join(todo, keys)
    new = new.select(*keys, "image_filename", "digest", "raw", "ocr_seconds", F.lit(False).alias("resumed"))
    columns = [c.split()[0] for c in SCANS.split(", ")]
    made = store.write("scans", commit, valid.select(columns).unionByName(new.select(columns)))
    parts = pictures.select("volume_slug").unionByName(known.select("volume_slug")).distinct()
    store.publish(commit, parts.select(F.col("volume_slug").alias("part"), F.lit("").alias("digest")))
    for name in ("_pictures", "_todo"):
        commits.remove(spark, f"{out}/{name}/commit={commit}")
    store.vacuum()
    return made


def raw_pages(scans: DataFrame) -> DataFrame:
    """Pages as `volume.run` takes them, from `scans`; what isn't a JSON object gives no page.

    Only what a page says is in them, not how or when it was recognised, so that scanning again changes nothing by itself.
    """
    page = F.from_json("raw", RAW_PAGE).alias("p")
    rows = scans.select("volume_slug", "page_num", "image_filename", page).where("p is not null and p.blocks is not null")
    held = ("page_num", "image_filename", "ocr_seconds", "_resumed")
    names = [x.split(" ")[0] for x in RAW_PAGE.split(", ")]
    return rows.select("volume_slug", "page_num", "image_filename", F.lit(None).cast("double").alias("ocr_seconds"), F.lit(None).cast("boolean").alias("_resumed"), *[f"p.{n}" for n in names if n not in held])
