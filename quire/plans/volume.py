"""The whole run over any number of volumes at once: pages in, structure tables out."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import articles, blocks, edition, footnotes, graph, layout, render, toc, wiki


def structure(raw_pages: DataFrame, volumes: DataFrame, prefix: str = "doc", keep: Callable[[str, DataFrame], DataFrame] = lambda name, df: df) -> dict[str, DataFrame]:
    """Tables columns (pages with their blocks), ordered (blocks in reading order), tokens and entries of the contents, articles, bridge, rows (blocks by article), notes, refs, nodes.

    keep: what is done with a table before others are made of it; `run` writes it and reads it again, so that plans stay small.
    """
    keys = ("volume_slug", "page_num", "image_filename", "image_width", "image_height")
    columns = keep("columns", layout.detect_columns(layout.pages_of(blocks.describe(blocks.unify(blocks.extract_blocks(raw_pages))), keys)))
    ordered = keep("ordered", layout.reading_order(columns))
    labels = volumes.select("volume_slug", F.explode("toc_section_labels").alias("label"))
    tokens = keep("tokens", toc.tokens(toc.contents_text(ordered)))
    found = keep("entries", toc.entries(tokens, labels))
    offsets = articles.printed_offset(articles.running_numbers(ordered))
    if "printed_page_offset" in volumes.columns:  # a configured offset comes first
        given = volumes.where("printed_page_offset is not null").select("volume_slug", F.col("printed_page_offset").alias("offset"))
        offsets = given.unionByName(offsets.join(given, "volume_slug", "left_anti"))
    titles = volumes.select("volume_slug", F.col("volume_title").alias("title"))
    arts = keep("articles", articles.detect(ordered, found, offsets, titles))
    pages = ordered.select("volume_slug", "page_num").distinct()
    bridge = keep("bridge", articles.article_pages(arts, pages))
    rows = bridge.select("volume_slug", "article_id", "num", "page_num", F.col("ord").alias("page_ord")).join(ordered, ["volume_slug", "page_num"]).join(arts.select("article_id", "title"), "article_id")
    rows = keep("rows", rows)
    notes = keep("notes", footnotes.notes(rows))
    refs = keep("refs", footnotes.refs(rows))
    owners = articles.page_owner(bridge, pages)
    nodes = keep("nodes", graph.volume_graph(volumes, ordered, arts, bridge, owners, notes, prefix))
    return {"columns": columns, "ordered": ordered, "tokens": tokens, "entries": found, "articles": arts, "bridge": bridge, "rows": rows, "notes": notes, "refs": refs, "nodes": nodes}


def timings(rows: DataFrame) -> DataFrame:
    """stage, seconds, percent of all stages; keys that start with _ are no stages."""
    from pyspark.sql import Window

    kept = rows.where(~F.startswith("stage", F.lit("_")))
    return kept.withColumn("percent", F.round(F.col("seconds") * 100 / F.sum("seconds").over(Window.partitionBy()), 6))


def ocr_times(pages: DataFrame) -> DataFrame:
    """Per volume: pages inferred and resumed, and the inferred ones' average, least and most seconds."""
    new = ~F.coalesce("_resumed", F.lit(False))
    t = F.when(new, F.col("ocr_seconds"))
    return pages.groupBy("volume_slug").agg(F.count_if(new).alias("inferred"), F.count_if(~new).alias("resumed"), F.round(F.avg(t), 6).alias("avg_s"), F.min(t).alias("min_s"), F.max(t).alias("max_s"))


def projected_minutes(times: DataFrame, pages: int = 350) -> DataFrame:
    """Rows of `ocr_times` with the minutes that a volume of so many pages would take at the average."""
    return times.withColumn("projected_min", F.round(F.col("avg_s") * pages / 60, 6))


@contextmanager
def stage(name: str, into: dict[str, float]) -> Iterator[None]:
    """Add the seconds that the block takes."""
    began = time.perf_counter()
    try:
        yield
    finally:
        into[name] = into.get(name, 0.0) + time.perf_counter() - began


def documents(tables: dict[str, DataFrame], volumes: DataFrame, as_of: str, prefix: str = "doc") -> dict[str, DataFrame]:
    """Rows (path, content) of all files of a run by kind, each volume's under <slug>/pagexml, tei, html, wiki and graph."""
    rows, arts, notes, refs, nodes = (tables[k] for k in ("rows", "articles", "notes", "refs", "nodes"))
    slugs = arts.select("article_id", "volume_slug")
    nav = articles.neighbours(arts)
    here = lambda df, *parts: df.select(F.concat("volume_slug", *[F.lit(p) if p.startswith("/") or "." in p else F.col(p) for p in parts]).alias("path"), "content")
    page = lambda df, folder, end, content: df.select(F.concat("volume_slug", F.format_string(f"/{folder}%04d{end}", "page_num")).alias("path"), F.col(content).alias("content"))
    read = render.article_html(rows, nav, notes, refs).join(slugs, "article_id").withColumnRenamed("html", "content")
    index = edition.volume_index(volumes, arts, tables["bridge"], tables["ordered"]).withColumnRenamed("html", "content")
    views = edition.facsimiles(layout.bands(tables["columns"]), volumes, notes.join(slugs, "article_id"), refs.join(slugs, "article_id"))
    of = lambda kind: nodes.where(F.array_contains("types", kind))
    tail = F.substring_index("node_id", "/", -1)
    pages = [
        wiki.volume_pages(volumes, arts, wiki.section_order(tables["entries"], arts), of("PublicationVolume")),
        wiki.article_pages(arts, render.article_markdown(wiki.with_links(rows)), wiki.note_section(notes), of("ScholarlyArticle").select("node_id", "types", "props", tail.alias("article_id"))),
        wiki.person_pages(volumes, arts, of("Person").select("volume_slug", "node_id", "types", "props", tail.alias("slug")).dropDuplicates(["volume_slug", "slug"])),
    ]
    made = pages[0].unionByName(pages[1]).unionByName(pages[2])
    lines = nodes.groupBy("volume_slug").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("node_pos", graph.node_json().alias("j")))), lambda r: r["j"]), ",\n").alias("j"))
    return {
        "pagexml": page(render.pagexml(tables["ordered"], as_of), "pagexml/page_", ".xml", "xml"),
        "tei": here(render.tei(rows, volumes).withColumnRenamed("xml", "content"), "/tei/", "volume_slug", ".xml"),
        "html": here(index, "/html/index.html").unionByName(here(read, "/html/articles/", "article_id", ".html")).unionByName(page(views, "html/pages/page-", ".html", "html")),
        "wiki": here(made, "/wiki/", "path").unionByName(here(volumes.withColumn("content", F.lit(f'{{"@context": {graph.context(prefix)}}}\n')), "/wiki/_context.json")),
        "graph": here(lines.withColumn("content", F.concat(F.lit(f'{{"@context":{graph.context(prefix)},"@graph":['), "j", F.lit("]}"))), "/graph/", "volume_slug", ".jsonld"),
    }


def inputs(raw_pages: DataFrame, volumes: DataFrame) -> DataFrame:
    """part, digest of every volume: what its tables are made from, its own row and all of its pages."""
    page = F.sha2(F.to_json(F.struct(*[F.col(c) for c in sorted(raw_pages.columns)])), 256)
    pages = raw_pages.groupBy("volume_slug").agg(F.array_sort(F.collect_list(F.struct("page_num", page.alias("d")))).alias("pages"))
    own = volumes.select("volume_slug", F.to_json(F.struct(*[F.col(c) for c in sorted(volumes.columns)])).alias("own")).join(pages, "volume_slug", "left")
    return own.select(F.col("volume_slug").alias("part"), F.sha2(F.concat_ws("|", "own", F.to_json("pages")), 256).alias("digest"))


FILES = "volume_slug string, path string, sha string"
LOG = "volume_slug string, date string, slug string, pages bigint, articles bigint"


def run(spark: SparkSession, raw_pages: DataFrame, volumes: DataFrame, out: str, files: str | None = None, force: bool = False, date: str | None = None) -> dict[str, float]:
    """Write the structure tables, timings and the log under out, by volume, and the files of all volumes under files, if given.

    Volumes whose pages and configuration are as they were when their tables were made are skipped (unless force). The others'
    tables replace the old ones at once, when all of them are written; their files are rewritten where they differ, and removed
    where a volume no longer has them. The log gets one entry for each date and volume. `commits.Store(spark, out).read` reads
    the tables. Returns the seconds that each stage took; nothing if there was nothing to do.
    """
    from ..sources import commits, io

    took: dict[str, float] = {}
    store = commits.Store(spark, out)
    commit = store.begin()
    todo = inputs(raw_pages, volumes)
    if not force:
        todo = todo.join(store.manifest().select("part", "digest"), ["part", "digest"], "left_anti")
    todo = store.write("_inputs", commit, todo)
    if todo.isEmpty():
        commits.remove(spark, f"{out}/_inputs/commit={commit}")
        return took
    own = todo.select(F.col("part").alias("volume_slug"))
    raw_pages, volumes = raw_pages.join(own, "volume_slug", "left_semi"), volumes.join(own, "volume_slug", "left_semi")

    def keep(name: str, df: DataFrame) -> DataFrame:
        with stage(name, took):
            return store.write(name, commit, df)

    tables = structure(raw_pages, volumes, keep=keep)
    keep("crops", render.crop_manifest(tables["ordered"]))
    if files:
        before = store.read("files", FILES).join(own, "volume_slug", "left_semi")
        made = None
        for name, df in documents(tables, volumes, "1970-01-01T00:00:00").items():
            with stage(name, took):
                df = store.write(f"_files_{name}", commit, df.select("path", "content"))
                list_of = df.select(F.substring_index("path", "/", 1).alias("volume_slug"), "path", F.sha2(F.coalesce("content", F.lit("")), 256).alias("sha"))
                made = list_of if made is None else made.unionByName(list_of)
                same = before.join(list_of, ["path", "sha"], "left_semi").select("path")
                io.write_files(df.join(same, "path", "left_anti"), files)
        made = keep("files", made)
        io.remove_files(before.join(made, "path", "left_anti"), files)
    entry = tables["ordered"].groupBy("volume_slug").agg(F.count_distinct("page_num").alias("pages")).join(tables["articles"].groupBy("volume_slug").agg(F.count_if(F.col("num") > 0).alias("articles")), "volume_slug", "left")
    entry = entry.select("volume_slug", F.lit(date or time.strftime("%Y-%m-%d")).alias("date"), F.col("volume_slug").alias("slug"), "pages", F.coalesce("articles", F.lit(0)).alias("articles"))
    before = store.read("log", LOG).join(own, "volume_slug", "left_semi")
    keep("log", before.unionByName(io.log_entries(before, entry)))
    keep("timings", timings(spark.createDataFrame(list(took.items()), "stage string, seconds double")))
    store.publish(commit, todo)
    for name in commits.children(spark, out):
        if name.startswith(("_files_", "_inputs")):
            commits.remove(spark, f"{out}/{name}/commit={commit}")
    store.vacuum()
    return took
