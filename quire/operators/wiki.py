"""Wiki pages as rows (path, content): volumes, articles and people with front matter, their merge into a corpus, and its index.

Front matter is YAML of a node, made by an Arrow-batched UDF; all else is column expressions. Sections named in KEPT belong to
whoever edits the wiki: what stands there survives every new run.
"""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..functions import text as T
from . import footnotes, graph
from .layout import fixed

#: Fixed values of the page format: sections that editors own, what stands in empty ones, and block types whose numbers may be references.
KEPT = ("Summary", "Mentions", "Notes")
EMPTY = "*To be added.*"
LINKED = ("text", "list", "bibliography")
DASH = "—"


@F.pandas_udf(StringType())
def yaml_of(node: pd.Series) -> pd.Series:
    """JSON objects as YAML blocks: keys in order, letters of all scripts as they are, no folded lines."""
    import yaml

    return node.map(lambda x: x if x is None else yaml.safe_dump(json.loads(x), sort_keys=False, allow_unicode=True, default_flow_style=False, width=10_000))


def front_matter(context: str = "../_context.json") -> Column:
    """Front matter of a node (node_id, types, props), the reference to its context first."""
    return F.concat(F.lit("---\n"), yaml_of(graph.node_json(f'"@context":"{context}",')), F.lit("---\n"))


def scaffold(series: str, publisher: str, editor: str, description: str, date: str) -> dict[str, str]:
    """Path and text of the files of an empty corpus: the context, a graph of the series alone, its page, index, log and a read-me."""
    import yaml

    slug = T.nfkd_slug.func(pd.Series([series]))[0]
    node = {"@id": f"doc:series/{slug}", "@type": "PublicationSeries", "name": series, "description": description, "publisher": {"@type": "Organization", "name": publisher}}
    front = yaml.safe_dump({"@context": "./_context.json", **node}, sort_keys=False, allow_unicode=True, default_flow_style=False, width=10_000)
    page = f"---\n{front}---\n\n# {series}\n\n{description}\n\n**Publisher.** {publisher}.\n**Editorial body.** {editor}.\n\n## Volumes\n\n*(filled as volumes are added)*\n\n## Summary\n\n{EMPTY}\n\n## Notes\n\n{EMPTY}\n"
    return {
        "_context.json": f'{{"@context": {graph.context()}}}\n',
        "graph/corpus.jsonld": f'{{"@context":{graph.context()},"@graph":[{json.dumps(node, ensure_ascii=False)}]}}',
        "series.md": page,
        "index.md": f"{INDEX_HEAD}\n## Series\n\n- [{series}](series.md) · `{node['@id']}`\n",
        "log.md": f"# Log\n\n## [{date}] init-wiki | bootstrap\n- made the folders, the context, series.md and a graph of the series\n",
        "README.md": f"# {series}\n\nPages of volumes, articles and people, made by `quire add-volume`. What you write under {', '.join(KEPT)} stays.\n",
        ".gitignore": ".made/\n",
    }


def note_tag(page: Column, n: Column, numbered: Column) -> Column:
    """`p018-1`, `p018-u1` without a number of its own, `p???-1` without a page."""
    return F.concat(F.when(page.isNull(), "p???").otherwise(F.format_string("p%03d", page)), F.when(numbered, "-").otherwise("-u"), n.cast("string"))


def with_links(rows: DataFrame) -> DataFrame:
    """rows whose running text links bare numbers to the notes of their page: one pass over the blocks of each page, as an array.

    A number is a reference where its page has a note of that number (see `footnotes.plain_refs`). Columns and rows stay.
    """
    keys = ("article_id", "page_num")
    rest = [c for c in rows.columns if c not in keys]
    pages = fixed(rows.groupBy(*keys).agg(F.collect_list(F.struct(*rest)).alias("_b")))
    pages = fixed(pages.withColumn("_n", F.transform(F.filter("_b", lambda b: b["type"] == "footnote"), lambda b: footnotes.parse_body(b["text"])["n"])))
    tag = lambda n: note_tag(F.col("page_num"), n, F.lit(True))
    mark = lambda n: F.concat(F.lit('<sup><a id="fnref-'), tag(n), F.lit('" href="#fn-'), tag(n), F.lit('">'), n.cast("string"), F.lit("</a></sup>"))
    found = lambda t: F.transform(F.filter(footnotes.plain_refs(t), lambda x: F.array_contains("_n", x["n"])), lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), mark(x["n"]).alias("mark")))
    # a number needs a digit, so that most blocks are left alone
    text = lambda b: F.when(b["type"].isin(*LINKED) & (F.size("_n") > 0) & b["text"].rlike("[0-9]"), footnotes.splice(b["text"], found(b["text"]))).otherwise(b["text"])
    out = pages.select(*keys, "_n", F.explode("_b").alias("_x"))
    return out.select(*keys, *[F.col(f"_x.{c}").alias(c) for c in rest if c != "text"], text(F.col("_x")).alias("text")).select(rows.columns)


def note_section(found: DataFrame) -> DataFrame:
    """article_id, notes: the section of an article's notes under headings of their pages, notes without a page last."""
    tag = note_tag(F.col("page_num"), F.col("n"), F.col("is_numbered"))
    text = F.replace(T.strip(F.coalesce("text", F.lit(""))), F.lit("\n"), F.lit(" "))
    anchor = F.concat(F.lit('<a id="fn-'), tag, F.lit('"></a>'))
    numbered = F.concat(anchor, F.lit("<sup>"), F.col("n").cast("string"), F.lit("</sup> "), text, F.lit(' <a href="#fnref-'), tag, F.lit('">↩</a>\n\n'))
    rows = found.withColumn("_f", F.when(F.col("is_numbered"), numbered).otherwise(F.concat(anchor, text, F.lit("\n\n"))))
    pages = rows.groupBy("article_id", "page_num").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("page_ord", "reading_pos", "_f"))), lambda r: r["_f"]), "").alias("_p"))
    heading = F.coalesce(F.concat(F.lit("\n### Page "), F.col("page_num").cast("string"), F.lit("\n\n")), F.lit("\n### Unattributed\n\n"))
    pages = pages.withColumn("_p", F.concat(heading, "_p")).withColumn("_last", F.col("page_num").isNull())
    parts = F.array_sort(F.collect_list(F.struct("_last", "page_num", "_p")))
    return pages.groupBy("article_id").agg(F.concat(F.lit("\n## Footnotes\n"), F.array_join(F.transform(parts, lambda r: r["_p"]), "")).alias("notes"))


def _open(*names: str) -> Column:
    return F.lit("\n".join(f"## {n}\n\n{EMPTY}\n" for n in names))


def _pages() -> Column:
    return F.format_string("pp. %d–%d", "page_first", "page_last")


def _or_dash(name: str) -> Column:
    return F.coalesce(F.nullif(T.strip(F.col(name)), F.lit("")), F.lit(DASH))


def section_order(entries: DataFrame, articles: DataFrame) -> DataFrame:
    """volume_slug, section, ord: each section once, those of the contents first, then those of articles, as first seen."""
    rows = entries.select("volume_slug", "section", F.lit(0).alias("of"), F.col("pos").alias("at")).unionByName(articles.select("volume_slug", "section", F.lit(1).alias("of"), F.col("num").alias("at")))
    first = rows.where("coalesce(section, '') <> ''").groupBy("volume_slug", "section").agg(F.min(F.struct("of", "at")).alias("_first"))
    return first.select("volume_slug", "section", F.row_number().over(Window.partitionBy("volume_slug").orderBy("_first")).alias("ord"))


def volume_pages(volumes: DataFrame, articles: DataFrame, order: DataFrame, nodes: DataFrame | None = None) -> DataFrame:
    """volume_slug, path, content: a volume's page with its articles by section; those without one come last, under a dash.

    articles: volume_slug, article_id, num, title, author, section, page_first, page_last; nodes: volume_slug and the volume's node.
    """
    by = F.coalesce(F.concat(F.lit(f" {DASH} "), F.nullif(T.strip(F.col("author")), F.lit(""))), F.lit(""))
    line = F.concat(F.col("num").cast("string"), F.lit(". ["), "title", F.lit("](articles/"), "article_id", F.lit(".md)"), by, F.lit(" · "), _pages(), F.lit("\n"))
    rows = articles.where("num > 0").select("volume_slug", F.nullif("section", F.lit("")).alias("section"), "num", line.alias("_f")).join(order, ["volume_slug", "section"], "left")
    parts = rows.groupBy("volume_slug", "section", F.col("ord").isNull().alias("_last"), "ord").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("num", "_f"))), lambda r: r["_f"]), "").alias("_f"))
    parts = parts.withColumn("_f", F.concat(F.lit("### "), F.coalesce("section", F.lit(DASH)), F.lit("\n\n"), "_f", F.lit("\n")))
    body = parts.groupBy("volume_slug").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_last", "ord", "_f"))), lambda r: r["_f"]), "").alias("_b"))
    out = volumes.join(body, "volume_slug", "left")
    head = F.format_string("# %s %s (%d)\n\nVolume %s (%d) of the *%s*, published by %s.\n\n## Articles\n\n", "volume_title", "volume_number_roman", "volume_year", "volume_number_roman", "volume_year", "series_name", "publisher")
    front = F.lit("")
    if nodes is not None:
        out, front = out.join(nodes.select("volume_slug", front_matter("./_context.json").alias("_front")), "volume_slug"), F.concat("_front", F.lit("\n"))
    return out.select("volume_slug", F.lit("volume.md").alias("path"), F.concat(front, head, F.coalesce("_b", F.lit("")), F.lit("\n"), _open(*KEPT)).alias("content"))


def article_pages(articles: DataFrame, bodies: DataFrame, notes: DataFrame, nodes: DataFrame | None = None) -> DataFrame:
    """volume_slug, path, content: an article's page. bodies: article_id, body; notes: article_id, notes; nodes: article_id and its node."""
    out = articles.where("num > 0").join(bodies, "article_id", "left").join(notes, "article_id", "left")
    front = F.lit("")
    if nodes is not None:
        out, front = out.join(nodes.select("article_id", front_matter().alias("_front")), "article_id"), F.concat("_front", F.lit("\n"))
    head = F.concat(F.lit("# "), "title", F.lit("\n\n**"), _or_dash("author"), F.lit("** · "), _or_dash("section"), F.lit(" · "), _pages(), F.lit("\n\n"))
    body = F.concat(F.regexp_replace(F.coalesce("body", F.lit("")), "\\s+$", ""), F.lit("\n"), F.coalesce("notes", F.lit("")))
    content = F.concat(front, head, _open(*KEPT[:2]), F.lit("\n## Full Text\n\n"), body, F.lit("\n"), _open(KEPT[2]))
    return out.select("volume_slug", F.concat(F.lit("articles/"), "article_id", F.lit(".md")).alias("path"), content.alias("content"))


def person_pages(volumes: DataFrame, articles: DataFrame, nodes: DataFrame | None = None) -> DataFrame:
    """volume_slug, path, content: a page for each author of a volume with the articles that name them. nodes: volume_slug, slug and the node."""
    line = F.concat(F.lit("- ["), "title", F.lit("](../articles/"), "article_id", F.lit(".md) ("), _or_dash("section"), F.lit(", "), _pages(), F.lit(")\n"))
    rows = articles.where("num > 0").select("volume_slug", "num", line.alias("_f"), F.posexplode(T.split_authors(F.col("author"))).alias("_at", "name")).withColumn("slug", T.slug(F.col("name")))
    people = rows.groupBy("volume_slug", "slug").agg(F.min_by("name", F.struct("num", "_at")).alias("name"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("num", "_at", "_f"))), lambda r: r["_f"]), "").alias("_b"))
    out = people.join(volumes, "volume_slug")
    front = F.lit("")
    if nodes is not None:
        out, front = out.join(nodes.select("volume_slug", "slug", front_matter().alias("_front")), ["volume_slug", "slug"]), F.concat("_front", F.lit("\n"))
    head = F.concat(F.lit("# "), "name", F.format_string("\n\n## Appears in\n\n### %s %s (%d)\n\n", "volume_title", "volume_number_roman", "volume_year"))
    return out.select("volume_slug", F.concat(F.lit("people/"), "slug", F.lit(".md")).alias("path"), F.concat(front, head, "_b", F.lit("\n"), _open(*KEPT)).alias("content"))


def to_corpus(pages: DataFrame) -> DataFrame:
    """Pages of volumes at their places in the corpus, links, pictures and context rewritten to them."""
    own = F.col("path") == "volume.md"
    volume = F.regexp_replace(F.regexp_replace("content", "(@context[\"']?: )\\./_context\\.json", "$1../_context.json"), "\\]\\(articles/([^)]+)\\)", "](../articles/$1)")
    article = F.regexp_replace("content", F.lit("!\\[([^\\]]*)\\]\\(\\.\\./\\.\\./regions/([^)]+)\\)"), F.concat(F.lit("![$1](../regions/"), "volume_slug", F.lit("/$2)")))
    content = F.when(own, volume).when(F.startswith("path", F.lit("articles/")), article).otherwise(F.col("content"))
    return pages.select("volume_slug", F.when(own, F.concat(F.lit("volumes/"), "volume_slug", F.lit(".md"))).otherwise(F.col("path")).alias("path"), content.alias("content"))


def _sections(content: Column) -> Column:
    """name and body of what stands under each level-2 heading; first, without a name, what stands above all of them after a line end."""
    parts = F.split(F.concat(F.lit("\n"), content), "\\n## ")
    line = lambda p: F.substring_index(p, "\n", 1)
    return F.transform(parts, lambda p, i: F.when(i == 0, F.struct(F.lit(None).cast("string").alias("name"), p.alias("body"))).otherwise(F.struct(T.strip(line(p)).alias("name"), F.substring(p, F.length(line(p)) + 2, F.length(p)).alias("body"))))


def keep_sections(new: Column, old: Column) -> Column:
    """new with the text that editors' sections had in old, where there was any; new as it is if old is null."""
    written = F.filter(F.transform(_sections(old), lambda s: F.struct(s["name"].alias("name"), F.regexp_replace(s["body"], "\\s+$", "").alias("body"))), lambda s: s["name"].isin(*KEPT) & (s["body"] != ""))
    last = lambda name: F.try_element_at(F.filter(written, lambda w: w["name"] == name), F.lit(-1))["body"]
    text = lambda s: F.when(s["name"].isNull(), s["body"]).otherwise(F.concat(F.lit("## "), s["name"], F.lit("\n"), F.coalesce(F.concat(last(s["name"]), F.lit("\n")), s["body"])))
    joined = F.array_join(F.transform(_sections(new), text), "\n")
    return F.when(old.isNull(), new).otherwise(F.substring(joined, F.lit(2), F.length(joined)))


def appearances(pages: DataFrame) -> DataFrame:
    """path, volume_slug, pos, heading, items: the parts of a person's page under `Appears in`, by the volume their first article names."""
    body = F.try_element_at(F.filter(_sections(F.col("content")), lambda s: s["name"] == "Appears in"), F.lit(1))["body"]
    parts = F.slice(F.split(F.concat(F.lit("\n"), body), "\\n### "), 2, 1_000_000)
    rows = pages.select("path", F.posexplode(parts).alias("pos", "_p"))
    rows = rows.select("path", "pos", T.strip(F.substring_index("_p", "\n", 1)).alias("heading"), T.strip(F.substring(F.col("_p"), F.instr("_p", "\n") + 1, F.length("_p"))).alias("items"))
    named = F.regexp_extract("items", "\\(\\.\\./articles/([a-z0-9-]+)\\.md\\)", 1)
    return rows.where(named != "").select("path", F.substring_index(named, "-", 3).alias("volume_slug"), "pos", "heading", "items")


def merge_people(new: DataFrame, old: DataFrame) -> DataFrame:
    """path, content of people's pages: of one volume the new part wins, parts go by year; front matter and title are the new page's.

    new may hold pages of one person from several volumes: the title is that of the last volume.
    """
    said = appearances(new).withColumn("incoming", F.lit(True)).unionByName(appearances(old).withColumn("incoming", F.lit(False)))
    parts = graph.merge_subsections(said.select(F.col("path").alias("person"), "volume_slug", "incoming", "pos", F.struct("heading", "items").alias("body")))
    text = F.concat(F.lit("### "), F.col("body.heading"), F.lit("\n\n"), F.col("body.items"), F.lit("\n\n"))
    listed = parts.withColumn("_f", text).groupBy(F.col("person").alias("path")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", "_f"))), lambda r: r["_f"]), "").alias("_b"))
    head = F.regexp_replace(F.substring_index(F.concat("content", F.lit("\n## ")), "\n## ", 1), "\\s+$", "")
    heads = new.groupBy("path").agg(F.max_by(head, F.struct("volume_slug", "content")).alias("_head"))
    out = heads.join(listed, "path", "left").join(old.select("path", F.col("content").alias("_old")), "path", "left")
    page = F.concat("_head", F.lit("\n\n## Appears in\n\n"), F.coalesce("_b", F.lit("")), _open(*KEPT))
    return out.select("path", keep_sections(page, F.col("_old")).alias("content"))


def add_volumes(new: DataFrame, existing: DataFrame) -> DataFrame:
    """path, content of the corpus pages that new pages (volume_slug, path, content) make or change; running it again changes nothing."""
    moved = to_corpus(new)
    person = F.startswith("path", F.lit("people/"))
    plain = moved.where(~person).join(existing.select("path", F.col("content").alias("_old")), "path", "left")
    return plain.select("path", keep_sections(F.col("content"), F.col("_old")).alias("content")).unionByName(merge_people(moved.where(person), existing.where(person)))


def index_lines(nodes: DataFrame) -> DataFrame:
    """part, key, line: one line of the index for each node that has a page, and for each other class how many there are.

    Volumes go by year, articles by id, people by name. nodes: node_id, types, props.
    """
    said = lambda k: F.get_json_object(F.concat(F.lit('{"v":'), F.try_element_at("props", F.lit(k)), F.lit("}")), "$.v")
    rows = nodes.select(F.col("types")[0].alias("type"), "node_id", F.substring_index("node_id", "/", -1).alias("_slug"), said("name").alias("name"), said("datePublished").alias("_year"))
    name, kind = F.coalesce("name", "_slug"), F.col("type")
    place = F.when(kind == "PublicationSeries", "series.md").otherwise(F.concat(F.when(kind == "PublicationVolume", "volumes/").when(kind == "ScholarlyArticle", "articles/").otherwise("people/"), F.col("_slug"), F.lit(".md")))
    label = F.when((kind == "PublicationVolume") & F.col("_year").isNotNull(), F.concat(name, F.lit(" ("), "_year", F.lit(")"))).otherwise(name)
    part = F.when(kind == "PublicationSeries", 0).when(kind == "PublicationVolume", 1).when(kind == "ScholarlyArticle", 2).when(kind == "Person", 3)
    key = F.when(kind == "PublicationVolume", F.coalesce("_year", F.lit(""))).when(kind == "Person", name).otherwise("")
    line = F.concat(F.lit("- ["), label, F.lit("]("), place, F.lit(") · `"), "node_id", F.lit("`"))
    rest = rows.where(part.isNull()).groupBy("type").agg(F.count(F.lit(1)).alias("n"))
    rest = rest.select(F.lit(4).alias("part"), F.struct(F.lit("").alias("by"), F.col("type").alias("id")).alias("key"), F.concat(F.lit("- "), "type", F.lit(": "), F.col("n").cast("string")).alias("line"))
    return rows.where(part.isNotNull()).select(part.alias("part"), F.struct(key.alias("by"), F.col("node_id").alias("id")).alias("key"), line.alias("line")).unionByName(rest)


#: What stands above the index's lines.
INDEX_HEAD = "# Index\n\nAll pages by class. Cite by the id that stands beside each.\n"


def index_rows(nodes: DataFrame) -> DataFrame:
    """key, line: the lines of the index and the headings of its parts; `io.write_ordered` makes the file, which no row holds as a whole."""
    lines = index_lines(nodes)
    counted = lambda title: F.format_string(f"## {title} (%d)", "n")
    title = F.when(F.col("part") == 0, "## Series").when(F.col("part") == 1, counted("Volumes")).when(F.col("part") == 2, counted("Articles")).when(F.col("part") == 3, counted("People")).otherwise("## Other nodes of the graph")
    heads = lines.groupBy("part").agg(F.count(F.lit(1)).alias("n")).select(F.struct("part", F.lit(0).alias("rank"), F.struct(F.lit("").alias("by"), F.lit("").alias("id")).alias("key")).alias("key"), F.concat(F.lit("\n"), title, F.lit("\n")).alias("line"))
    return heads.unionByName(lines.select(F.struct("part", F.lit(1).alias("rank"), "key").alias("key"), "line"))
