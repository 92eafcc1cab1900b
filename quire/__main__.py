"""python -m quire run CONFIG... | order ROOT SLUG [--page N] | merge-graphs OUT IN... | init-wiki DIR | add-volume CORPUS GRAPH [--wiki DIR] | follow SOURCE CORPUS CHECKPOINT | export CORPUS OUT"""

from __future__ import annotations

import argparse
import os
import shutil
import sys
import time


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="quire")
    sub = p.add_subparsers(dest="command", required=True)
    run = sub.add_parser("run")
    run.add_argument("config", nargs="+")
    run.add_argument("--output-root")
    run.add_argument("--page-range")
    run.add_argument("--dpi", type=int)
    run.add_argument("--pdf", help="the volume's document; with one config only")
    run.add_argument("--ocr-method", choices=("hf", "vllm"))
    run.add_argument("--vllm-url")
    run.add_argument("--no-crops", action="store_true")
    run.add_argument("--bundle", action="store_true", help="also an archive of each volume's files")
    run.add_argument("--force", action="store_true", help="also volumes that haven't changed")
    merge = sub.add_parser("merge-graphs")
    merge.add_argument("out")
    merge.add_argument("inputs", nargs="+")
    init = sub.add_parser("init-wiki")
    init.add_argument("root")
    init.add_argument("--force", action="store_true")
    init.add_argument("--date", help="of the entry in the log, today by default")
    for name in ("series", "publisher", "editor", "description"):
        init.add_argument(f"--{name}", default="Series" if name == "series" else "")
    add = sub.add_parser("add-volume")
    add.add_argument("corpus")
    add.add_argument("graph")
    add.add_argument("--wiki", help="folder of the volume's pages, <slug>/wiki")
    add.add_argument("--date", help="of the entry in the log, today by default")
    order = sub.add_parser("order", help="print the blocks of a volume's pages in reading order")
    order.add_argument("root")
    order.add_argument("slug")
    order.add_argument("--page", type=int)
    follow = sub.add_parser("follow", help="merge node files into a corpus in buckets as they arrive")
    export = sub.add_parser("export", help="write a corpus in buckets as one JSON-LD document")
    for x, names in ((follow, ("source", "corpus", "checkpoint")), (export, ("corpus", "out"))):
        for name in names:
            x.add_argument(name)
    a = p.parse_args(argv)
    pages = None
    if a.command == "run" and a.page_range:
        try:
            first, last = map(int, a.page_range.split("-"))
            pages = (first, last)
        except ValueError:
            print("page range must look like 3-10", file=sys.stderr)
            return 2
    if a.command == "run" and a.pdf and len(a.config) > 1:
        print("--pdf goes with one config", file=sys.stderr)
        return 2
    if a.command == "init-wiki":
        from .operators import wiki

        if os.path.isdir(a.root) and any(x not in (".git", ".gitignore") for x in os.listdir(a.root)) and not a.force:
            print(f"{a.root} is not empty", file=sys.stderr)
            return 1
        made = wiki.scaffold(a.series, a.publisher, a.editor, a.description, a.date or time.strftime("%Y-%m-%d"))
        for d in ("volumes", "articles", "people", "graph"):
            os.makedirs(os.path.join(a.root, d), exist_ok=True)
        for path, text in made.items():
            with open(os.path.join(a.root, path), "w", encoding="utf-8") as f:
                f.write(text)
        return 0
    from pyspark.sql import SparkSession
    from pyspark.sql import functions as F

    from .operators import blocks, graph, layout, wiki
    from .plans import volume
    from .sources import archive, io
    from .streaming import merge

    spark = SparkSession.builder.config("spark.sql.session.timeZone", "UTC").getOrCreate()
    if a.command == "run":
        volumes = [io.read_config(c, ocr_method=a.ocr_method, vllm_url=a.vllm_url, pdf_path=a.pdf, output_root=a.output_root, page_range=pages, dpi=a.dpi, crop_regions=False if a.no_crops else None) for c in a.config]
        io.volumes_table(spark, volumes)  # slugs must differ over all roots
        for root in sorted({v.output_root for v in volumes}):
            own = [v for v in volumes if v.output_root == root]
            took = volume.run(spark, io.read_volumes(spark, root, own), io.volumes_table(spark, own), f"{root}/tables", root, a.force)
            if a.bundle and took:
                archive.bundle(spark, os.path.abspath(root), io.volumes_table(spark, own))
            for name, seconds in took.items():
                print(f"{root}\t{name}\t{seconds:.2f}")
        return 0
    if a.command == "order":
        pages = io.read_interim(spark, a.root, (a.page, a.page) if a.page is not None else None, {a.slug: None})
        found = layout.reading_order(layout.detect_columns(layout.pages_of(blocks.describe(blocks.unify(blocks.extract_blocks(pages))))))
        for r in found.select("page_num", "reading_pos", "col", "type", "block_id", F.substring("text", 1, 60).alias("text")).orderBy("page_num", "reading_pos").toLocalIterator():
            print(*("" if x is None else x for x in r), sep="\t")
        return 0
    if a.command == "follow":
        merge.start(spark, a.source, a.corpus, a.checkpoint).awaitTermination()
        return 0
    if a.command == "export":
        io.write_graph(merge.corpus(spark, a.corpus), a.out)
        return 0
    known = os.path.join(getattr(a, "corpus", ""), "graph", "corpus.jsonld")
    paths, out = (a.inputs, a.out) if a.command == "merge-graphs" else ([x for x in (known,) if os.path.exists(x)] + [a.graph], known)
    nodes = graph.merge(io.read_graphs(spark, paths))
    if a.command == "merge-graphs":
        io.write_graph(nodes, out, io.read_context(spark, paths))
        return 0
    # what is read is among what is written, so that all of it is made first
    made = os.path.join(a.corpus, ".made")
    nodes.write.mode("overwrite").parquet(f"{made}/nodes")
    nodes = spark.read.parquet(f"{made}/nodes")
    slug = os.path.basename(a.graph).removesuffix(".jsonld")
    counts = [0, 0, 0]
    if a.wiki:
        new = io.read_wiki(spark, os.path.abspath(a.wiki)).withColumn("volume_slug", F.lit(slug))
        before = io.read_wiki(spark, os.path.abspath(a.corpus))
        wiki.add_volumes(new, before).write.mode("overwrite").parquet(f"{made}/pages")
        pages = spark.read.parquet(f"{made}/pages")
        here = before.select("path", F.lit(True).alias("old"))
        kinds = pages.join(here, "path", "left").groupBy(F.split("path", "/")[0].alias("kind")).agg(F.count(F.lit(1)).alias("n"), F.count("old").alias("old")).collect()
        by = {r["kind"]: (r["n"], r["old"]) for r in kinds}
        people = by.get("people", (0, 0))
        counts = [by.get("articles", (0, 0))[0], people[0] - people[1], people[1]]
        io.write_files(pages, a.corpus)
    io.write_ordered(wiki.index_rows(nodes), os.path.join(a.corpus, "index.md"), wiki.INDEX_HEAD, "\n", "\n")
    io.write_graph(nodes, out, io.read_context(spark, paths))
    io.append_log(os.path.join(a.corpus, "log.md"), a.date or time.strftime("%Y-%m-%d"), slug, [f"articles added: {counts[0]}", f"people: {counts[1]} new, {counts[2]} merged", "graph/corpus.jsonld merged"])
    shutil.rmtree(made)
    return 0


if __name__ == "__main__":
    sys.exit(main())
