"""Readers and writers: interim page JSON, volume configs, graphs, Markdown pages and their zones; text files by path."""

from __future__ import annotations

import json
import os
import re
from dataclasses import asdict, dataclass, field, fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import graph
from ..schemas import RAW_PAGE
from .interim import InterimPages, opened


#: Folders of a volume, as files of a run lie in them.
FOLDERS = ("pages", "interim", "pagexml", "tei", "html", "graph", "regions", "wiki", "logs")
#: Ways to recognise pages: a model that is loaded here, or a server's address.
METHODS = ("hf", "vllm")


@dataclass
class Recognition:
    """How pages are recognised, for the function that `scan.scan` is given; unknown keys are errors."""

    method: str = "hf"
    vllm_url: str | None = None
    model: str = ""
    batch_size: int = 1

    def __post_init__(self):
        if self.method not in METHODS:
            raise ValueError(f"method must be one of {', '.join(METHODS)}")
        if self.method == "vllm" and not self.vllm_url:
            raise ValueError("vllm needs vllm_url")


@dataclass
class Volume:
    """Identity and options of a volume; unknown keys of a config are errors."""

    volume_number: int
    volume_year: int
    slug: str | None = None
    volume_number_roman: str = ""
    volume_title: str = ""
    series_name: str = "Series"
    publisher: str = ""
    editor: str = ""
    language: str = "de"
    pdf_path: str = ""
    output_root: str = "out"
    page_range: tuple[int, int] | None = None
    printed_page_offset: int | None = None
    toc_section_labels: tuple[str, ...] = ()
    dpi: int = 200
    crop_regions: bool = True
    slug_prefix: str = "vol"
    ocr: Recognition = field(default_factory=Recognition)

    def __post_init__(self):
        if isinstance(self.ocr, dict):
            self.ocr = Recognition(**self.ocr)
        self.slug = self.slug or f"{self.slug_prefix}-{self.volume_number:03d}-{self.volume_year}"

    def folder(self, kind: str | None = None) -> str:
        """The volume's folder, or one of FOLDERS in it."""
        if kind is not None and kind not in FOLDERS:
            raise ValueError(f"no folder {kind}")
        return "/".join([self.output_root.rstrip("/"), self.slug, *([kind] if kind else [])])

    def as_dict(self) -> dict:
        """All fields as plain values, as `read_config` takes them."""
        return {k: list(v) if isinstance(v, tuple) else v for k, v in asdict(self).items()}


def read_config(path: str, ocr_method: str | None = None, vllm_url: str | None = None, **override) -> Volume:
    """A volume from YAML; `~` and variables are expanded in paths, overrides that are not None win, ocr_method and vllm_url those within ocr."""
    import yaml

    with open(path, encoding="utf-8") as f:
        data = yaml.safe_load(f) or {}
    data |= {k: v for k, v in override.items() if v is not None}
    ocr = {k: v for k, v in (("method", ocr_method), ("vllm_url", vllm_url)) if v is not None}
    if ocr:
        data["ocr"] = {**(data.get("ocr") or {}), **ocr}
    if data.get("ocr", 0) is None:
        del data["ocr"]
    unknown = set(data) - {f.name for f in fields(Volume)}
    if unknown:
        raise TypeError(f"unknown keys: {', '.join(sorted(unknown))}")
    for k in ("pdf_path", "output_root"):
        if data.get(k):
            data[k] = os.path.expandvars(os.path.expanduser(data[k]))
    for k in ("page_range", "toc_section_labels"):
        if data.get(k) is not None:
            data[k] = tuple(data[k])
    return Volume(**data)


def volumes_table(spark: SparkSession, volumes: list[Volume]) -> DataFrame:
    """One row for each volume; slugs must differ."""
    slugs = [v.slug for v in volumes]
    if len(set(slugs)) != len(slugs):
        raise ValueError("volumes share a slug")
    rows = [(v.slug, v.series_name, v.publisher, v.editor, v.volume_title, v.volume_number, v.volume_number_roman, v.volume_year, v.language, list(v.toc_section_labels), v.printed_page_offset) for v in volumes]
    return spark.createDataFrame(rows, "volume_slug string, series_name string, publisher string, editor string, volume_title string, volume_number int, volume_number_roman string, volume_year int, language string, toc_section_labels array<string>, printed_page_offset int")


def read_interim(spark: SparkSession, root: str, page_range: tuple[int, int] | None = None, volumes: dict[str, tuple[int, int] | None] | None = None) -> DataFrame:
    """Interim pages under root/<slug>/interim/page_<n>.json, with volume_slug from the path.

    page_range is inclusive; volumes: the slugs to read, each with a range of its own or None. Files of other volumes or with
    numbers outside the range are not opened. A file that isn't a JSON object gives no page.
    """
    spark.dataSource.register(InterimPages)
    source = spark.read.format("interim_pages").option("path", root).option("pages", json.dumps(page_range or (None, None)))
    if volumes is not None:
        source = source.option("ranges", json.dumps({s: r or (None, None) for s, r in volumes.items()}))
    pages = source.load().select("volume_slug", F.from_json("value", RAW_PAGE).alias("p")).where("p.page_num is not null").select("volume_slug", "p.*")
    return pages.where(F.col("page_num").between(*page_range)) if page_range else pages


def read_volumes(spark: SparkSession, root: str, volumes: list[Volume]) -> DataFrame:
    """Interim pages of these volumes under one root, each within its own page range; no other file is opened."""
    return read_interim(spark, root, volumes={v.slug: v.page_range for v in volumes})


def missing_pages(index: DataFrame, interim: DataFrame) -> DataFrame:
    """Pages of the index that have no interim result yet."""
    return index.join(interim.select("volume_slug", "page_num"), ["volume_slug", "page_num"], "left_anti")


def read_graphs(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Nodes of JSON-LD documents: source_ord (place in paths), node_pos, node_id, types, props (JSON text by key, in order)."""
    order = spark.createDataFrame([(i, os.path.basename(p.rstrip("/")), p) for i, p in enumerate(paths)], "source_ord int, base string, given string")
    docs = spark.read.text(paths, wholetext=True).select("value", F.col("_metadata.file_path").alias("file"))
    # where one path ends like another, the longest that fits is meant
    fits = docs.join(F.broadcast(order), F.endswith("file", F.concat(F.lit("/"), F.ltrim(F.col("given"), F.lit("/")))) | (F.col("file") == F.col("given")))
    docs = fits.groupBy("file", "value").agg(F.max_by("source_ord", F.struct(F.length("given"), -F.col("source_ord"))).alias("source_ord"))
    nodes = docs.select("source_ord", F.posexplode(F.from_json(F.get_json_object("value", "$.@graph"), "array<string>")).alias("node_pos", "node"))
    props = F.map_from_entries(F.transform(F.filter(F.json_object_keys("node"), lambda k: ~k.isin("@id", "@type", "@context")), lambda k: F.struct(k, F.to_json(F.variant_get(F.parse_json("node"), F.concat(F.lit("$['"), k, F.lit("']")), "variant")))))
    kind = F.get_json_object("node", "$.@type")
    types = F.when(F.startswith(kind, F.lit("[")), F.from_json(kind, "array<string>")).otherwise(F.array(kind))
    return nodes.select("source_ord", "node_pos", F.get_json_object("node", "$.@id").alias("node_id"), types.alias("types"), props.alias("props"))


def read_context(spark: SparkSession, paths: list[str]) -> str:
    """The context of the first of these JSON-LD documents, as JSON; empty where it has none."""
    value = F.to_json(F.variant_get(F.parse_json("value"), F.lit("$['@context']"), "variant"))
    return (spark.read.text(paths[0], wholetext=True).select(value.alias("c")).first()["c"] or "{}") if paths else "{}"


def write_graph(nodes: DataFrame, path: str, context: str = "{}") -> None:
    """Write the JSON-LD document of merged nodes (node_id, types, props, seen), in the order they were first seen."""
    write_ordered(nodes.select(F.col("seen").alias("key"), graph.node_json().alias("line")), path, f'{{"@context":{context},"@graph":[', "]}", ",\n")


def write_ordered(rows: DataFrame, path: str, head: str = "", tail: str = "", sep: str = "\n", in_place: bool | None = None) -> None:
    """Write one file of all lines in order of key (key, line), with sep between them, head before and tail after.

    Rows are sorted by range; each task writes its part to a file of its own and tells its length, the running sums of which are
    the parts' places. On a file system that all executors share the parts are then copied to their places side by side
    (in_place), elsewhere by one task that streams them. The file appears when it is whole. Only lengths reach the driver.
    """
    import uuid

    from pyarrow import fs

    spark, mark = rows.sparkSession, uuid.uuid4().hex
    store, target = opened(path)
    in_place = isinstance(store, fs.LocalFileSystem) if in_place is None else in_place
    parts, made, glue = f"{path}.parts-{mark}", f"{path}.new-{mark}", sep.encode()

    def put(batches):
        import uuid

        import pyarrow as pa
        from pyspark import TaskContext

        store, base = opened(parts)
        name, size, first = uuid.uuid4().hex, 0, True
        with store.open_output_stream(f"{base}/{name}") as out:
            for b in batches:
                for x in b.column("line").to_pylist():
                    line = (b"" if first else glue) + (x or "").encode()
                    size, first = size + out.write(line), False
        if not first:
            yield pa.RecordBatch.from_pydict({"part": [TaskContext.get().partitionId()], "name": [name], "size": [size]})

    store.create_dir(opened(parts)[1], recursive=True)
    sorted_rows = rows.select("key", "line").repartitionByRange("key").sortWithinPartitions("key").select("line")
    found = sorted(map(tuple, sorted_rows.mapInArrow(put, "part bigint, name string, size bigint").collect()))
    places, at = [], len(head.encode())
    for _, name, size in found:
        at += len(glue) if places else 0
        places.append((name, at))
        at += size

    def copy(part):
        store, base = opened(parts)
        with open(opened(made)[1], "r+b") as out:
            for name, place in part:
                out.seek(place)
                if place > len(head.encode()):
                    out.seek(place - len(glue))
                    out.write(glue)
                with store.open_input_stream(f"{base}/{name}") as given:
                    while x := given.read(1 << 24):
                        out.write(x)

    def stream(part):
        store, base = opened(parts)
        with store.open_output_stream(opened(made)[1]) as out:
            out.write(head.encode())
            for i, (name, _) in enumerate(part):
                out.write(glue if i else b"")
                with store.open_input_stream(f"{base}/{name}") as given:
                    while x := given.read(1 << 24):
                        out.write(x)
            out.write(tail.encode())

    listed = spark.createDataFrame(places, "name string, place bigint")
    if not places:
        with store.open_output_stream(opened(made)[1]) as out:
            out.write((head + tail).encode())
    elif in_place:
        with open(opened(made)[1], "wb") as out:
            out.write(head.encode())
            out.seek(at)
            out.write(tail.encode())
        listed.repartition(max(1, len(places))).foreachPartition(copy)
    else:
        listed.coalesce(1).sortWithinPartitions("place").foreachPartition(stream)
    store.move(opened(made)[1], target)
    store.delete_dir(opened(parts)[1])


def read_pages(spark: SparkSession, glob: str) -> DataFrame:
    """path, frontmatter, body of Markdown files; frontmatter is null where there is none."""
    rows = spark.read.text(glob, wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value")
    front = "(?s)^---\\n(.*?\\n)---\\n(.*)$"
    has = F.col("value").rlike(front)
    return rows.select("path", F.when(has, F.regexp_extract("value", front, 1)).alias("frontmatter"), F.when(has, F.regexp_extract("value", front, 2)).otherwise(F.col("value")).alias("body"))


def read_wiki(spark: SparkSession, root: str) -> DataFrame:
    """path (under root), content of the Markdown files under root."""
    rows = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.md").text(root, wholetext=True)
    return rows.select(F.substring_index(F.col("_metadata.file_path"), root.rstrip("/") + "/", -1).alias("path"), F.col("value").alias("content"))


def zones(pages: DataFrame, owned: tuple[str, ...] = ()) -> DataFrame:
    """path, ord, name, body: sections under level-2 headings, trailing white space off; only `owned` ones if given."""
    parts = F.slice(F.split(F.concat(F.lit("\n"), "body"), "\\n## "), 2, 1_000_000)
    rows = pages.select("path", F.posexplode(parts).alias("ord", "p"))
    out = rows.select("path", "ord", F.btrim(F.regexp_extract("p", "^([^\\n]*)", 1)).alias("name"), F.regexp_replace(F.regexp_replace("p", "^[^\\n]*\\n*", ""), "\\s+$", "").alias("body"))
    return out.where(F.col("name").isin(*owned)) if owned else out


def assemble(frontmatter_zones: DataFrame) -> DataFrame:
    """path, content from rows path, frontmatter, ord, name, body."""
    part = F.concat(F.lit("## "), "name", F.lit("\n\n"), "body", F.lit("\n"))
    rows = frontmatter_zones.groupBy("path", "frontmatter").agg(F.array_sort(F.collect_list(F.struct("ord", part.alias("p")))).alias("z"))
    return rows.select("path", F.concat(F.coalesce(F.concat(F.lit("---\n"), "frontmatter", F.lit("---\n\n")), F.lit("")), F.array_join(F.transform("z", lambda z: z["p"]), "\n")).alias("content"))


def write_files(rows: DataFrame, root: str) -> None:
    """Write rows (path, content) as files under root, folders as path has them; each is written by the task that holds it.

    root is a folder that all executors share, or the address of a store that they reach. A path may not leave it.
    """
    from pyspark.errors import IllegalArgumentException

    if not rows.where(F.col("path").isNull() | F.startswith("path", F.lit("/")) | F.array_contains(F.split("path", "/"), "..")).isEmpty():
        raise IllegalArgumentException("paths must be relative and may not hold ..")

    def write(part):
        store, base = opened(root)
        for r in part:
            target = f"{base}/{r['path']}"
            store.create_dir(target.rsplit("/", 1)[0], recursive=True)
            with store.open_output_stream(target) as out:
                out.write((r["content"] or "").encode())

    rows.select("path", "content").foreachPartition(write)


def remove_files(rows: DataFrame, root: str) -> None:
    """Remove the files (path) under root; those that are gone already are left at that."""

    def remove(part):
        from pyarrow import fs

        store, base = opened(root)
        for r in part:
            if store.get_file_info(f"{base}/{r['path']}").type == fs.FileType.File:
                store.delete_file(f"{base}/{r['path']}")

    rows.select("path").foreachPartition(remove)


def append_log(path: str, date: str, slug: str, lines: list[str]) -> bool:
    """Add an entry to a log of Markdown sections, unless it has one of this date and slug; False then. The headings are fixed by the log's format."""
    from pyarrow import fs

    store, target = opened(path)
    before = "# Log"
    if store.get_file_info(target).type == fs.FileType.File:
        with store.open_input_stream(target) as f:
            before = f.read().decode()
    heading = f"## [{date}] add-volume | {slug}\n"
    if heading in before:
        return False
    text = before.rstrip() + "\n\n" + heading + "".join(f"- {x}\n" for x in lines)
    with store.open_output_stream(target) as out:
        out.write(text.encode())
    return True


def log_entries(log: DataFrame, new: DataFrame) -> DataFrame:
    """Entries to append: those whose date and slug the log lacks."""
    return new.join(log.select("date", "slug").distinct(), ["date", "slug"], "left_anti").dropDuplicates(["date", "slug"])


def safe_slug(path: str) -> str:
    return re.sub(r"[^a-z0-9-]+", "-", os.path.basename(path.rstrip("/")).lower())
