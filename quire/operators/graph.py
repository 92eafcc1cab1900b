"""The entity graph: nodes as rows (node_id, types, props: JSON text by key), their merge and counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..schemas import VISUAL
from .layout import fixed


def context(prefix: str = "doc", base: str = "urn:doc:") -> str:
    """The JSON-LD context of graphs, as JSON: names are those of schema.org, ids start with the prefix, and what points to a node is an id."""
    import json

    links = ("inVolume", "inArticle", "inSection", "inSeries", "inPage", "footnoteOf", "hasPart")
    return json.dumps({"@vocab": "https://schema.org/", prefix: base, **{k: {"@type": "@id"} for k in links}})


def iri(prefix: str, kind: str, *parts) -> Column:
    """`prefix:kind/part/part`; page numbers come as format_string('%04d')."""
    return F.concat(F.lit(f"{prefix}:{kind}/"), *[x for i, p in enumerate(parts) for x in ([F.lit("/")] if i else []) + [p if isinstance(p, Column) else F.lit(p)]])


def page_iri(prefix: str, slug: Column, page: Column) -> Column:
    return iri(prefix, "vol", slug, F.lit("page"), F.format_string("%04d", page))


def figure_name() -> Column:
    """A figure's caption, else its description, else `Type on page N`."""
    made = F.concat(T.title_case(F.col("type")), F.lit(" on page "), F.col("page_num").cast("string"))
    return F.coalesce(F.nullif(T.strip(F.coalesce("text", F.lit(""))), F.lit("")), F.nullif(T.strip(F.coalesce("description", F.lit(""))), F.lit("")), made)


def node_json(first: str = "") -> Column:
    """A node (node_id, types, props) as a JSON object; first: members to stand before its id."""
    kinds = F.when(F.size("types") == 1, F.to_json("types").substr(F.lit(2), F.length(F.to_json("types")) - 2)).otherwise(F.to_json("types"))
    named = F.to_json(F.struct(F.col("node_id").alias("@id")))
    members = F.array_join(F.transform(F.map_entries("props"), lambda e: F.concat(F.lit(',"'), e["key"], F.lit('":'), e["value"])), "")
    return F.concat(F.lit("{" + first), named.substr(F.lit(2), F.length(named) - 2), F.lit(',"@type":'), kinds, members, F.lit("}"))


def people(articles: DataFrame) -> DataFrame:
    """volume_slug, name, ord: authors of a volume, each name once, in order of appearance."""
    rows = articles.where("num > 0").select("volume_slug", "num", F.posexplode(T.split_authors(F.col("author"))).alias("at", "name"))
    return rows.groupBy("volume_slug", "name").agg(F.min(F.struct("num", "at")).alias("ord"))


def _node(df: DataFrame, rank: int, order: list, node_id: Column, types: list[str], props: dict[str, Column]) -> DataFrame:
    """Rows of one class; props that are null are left out, in the order given."""
    key = F.array(F.lit(rank).cast("long"), *[F.coalesce(o.cast("long"), F.lit(0)) for o in order])
    made = df.select("volume_slug", key.alias("node_pos"), node_id.alias("node_id"), *[v.alias(f"_{i}") for i, v in enumerate(props.values())])
    made = fixed(made.select("volume_slug", "node_pos", "node_id", *[_as_json(f.name, f.dataType.typeName()).alias(f.name) for f in made.schema[3:]]))
    entries = F.array(*[F.struct(F.lit(k).alias("key"), F.col(f"_{i}").alias("value")) for i, k in enumerate(props)])
    return made.select("volume_slug", "node_pos", "node_id", F.array(*map(F.lit, types)).alias("types"), F.map_from_entries(F.filter(entries, lambda e: e["value"].isNotNull())).alias("props"))


def _as_json(name: str, kind: str) -> Column:
    """A value as JSON, null for null. Whole numbers and texts without signs to escape need no generator of JSON."""
    whole = F.to_json(F.struct(F.col(name).alias("v")))
    made = whole.substr(F.lit(6), F.length(whole) - 6)
    if kind in ("long", "integer", "short", "byte"):
        made = F.col(name).cast("string")
    elif kind == "string":
        made = F.when(F.col(name).rlike('["\\\\\\x00-\\x1f]') | ~F.is_valid_utf8(name), made).otherwise(F.concat(F.lit('"'), name, F.lit('"')))
    return F.when(F.col(name).isNotNull(), made)


def volume_graph(volumes: DataFrame, ordered: DataFrame, articles: DataFrame, bridge: DataFrame, owners: DataFrame, found: DataFrame, prefix: str = "doc", page_scoped_notes: bool = False, pages: DataFrame | None = None) -> DataFrame:
    """All nodes of all volumes: volume_slug, node_pos (an array to sort by), node_id, types, props.

    Order: series, volume, sections, each page with its figures, each article with its notes, people. volumes: volume_slug,
    series_name, publisher, editor, volume_title, volume_number, volume_number_roman, volume_year, language. Of ordered only pictures
    are read, and the pages, unless pages has them: volume_slug, page_num, image_filename, one row for each.
    """
    slug = F.col("volume_slug")
    org = lambda c: F.struct(F.lit("Organization").alias("@type"), c.alias("name"))
    vol = iri(prefix, "vol", slug)
    out = [
        _node(volumes, 0, [], iri(prefix, "series", T.slug(F.col("series_name"))), ["PublicationSeries"], {"name": F.col("series_name"), "publisher": org(F.col("publisher"))}),
        _node(volumes, 1, [], vol, ["PublicationVolume", "Book"], {
            "name": F.concat_ws(" ", "volume_title", "volume_number_roman"), "volumeNumber": F.col("volume_number"), "datePublished": F.col("volume_year").cast("string"), "inLanguage": F.col("language"),
            "inSeries": iri(prefix, "series", T.slug(F.col("series_name"))), "publisher": org(F.col("publisher")), "editor": org(F.col("editor")),
        }),
    ]
    named = articles.where("num > 0")
    parts = named.where("coalesce(section, '') <> ''").groupBy("volume_slug", "section").agg(F.min("num").alias("ord"))
    out.append(_node(parts, 2, [F.col("ord")], iri(prefix, "vol", slug, F.lit("section"), T.slug(F.col("section"))), ["PublicationIssue"], {"name": F.col("section"), "inVolume": vol}))
    here = page_iri(prefix, slug, F.col("page_num"))
    figures = ordered.where(F.col("type").isin(*VISUAL)).withColumn("_iri", F.concat(here, F.lit("/figure/"), "block_id"))
    shown = figures.groupBy("volume_slug", "page_num").agg(F.transform(F.array_sort(F.collect_list(F.struct("reading_pos", "_iri"))), lambda f: f["_iri"]).alias("figs"))
    if pages is None:
        pages = ordered.select("volume_slug", "page_num", "image_filename").distinct()
    pages = pages.select("volume_slug", "page_num", "image_filename").join(shown, ["volume_slug", "page_num"], "left").join(owners, ["volume_slug", "page_num"], "left")
    out.append(_node(pages, 3, [F.col("page_num"), F.lit(-1)], here, ["WebPage"], {
        "name": F.concat(F.lit("Page "), F.col("page_num").cast("string")), "pageStart": F.col("page_num"), "facsimile": F.concat(F.lit("pages/"), "image_filename"),
        "inArticle": F.when(F.col("owner").isNotNull(), iri(prefix, "art", F.col("owner"))), "inVolume": F.when(F.col("owner").isNull(), vol), "hasPart": F.col("figs"),
    }))
    out.append(_node(figures, 3, [F.col("page_num"), F.col("reading_pos")], F.col("_iri"), ["ImageObject"], {
        "name": figure_name(), "regionType": F.col("type"), "inPage": here, "pageStart": F.col("page_num"), "contentUrl": F.concat(F.lit("regions/"), "block_id", F.lit(".png")),
        "description": F.coalesce(F.nullif(T.strip(F.col("text")), F.lit("")), F.nullif(T.strip(F.coalesce("description", F.lit(""))), F.lit(""))), "bbox": F.array("x1", "y1", "x2", "y2"),
    }))
    art = iri(prefix, "art", F.col("article_id"))
    held = bridge.groupBy("article_id").agg(F.array_sort(F.collect_set("page_num")).alias("nums"))
    authors = T.split_authors(F.col("author"))
    person = lambda name: F.concat(F.lit(f"{prefix}:person/"), T.slug(name))
    out.append(_node(named.join(held, "article_id", "left"), 4, [F.col("num"), F.lit(-1)], art, ["ScholarlyArticle"], {
        "name": F.col("title"), "pageStart": F.col("page_first"), "pageEnd": F.col("page_last"), "position": F.col("num"), "inVolume": vol,
        "inSection": F.when(F.coalesce("section", F.lit("")) != "", iri(prefix, "vol", slug, F.lit("section"), T.slug(F.col("section")))),
        "author": F.when(F.size(authors) > 0, F.transform(authors, lambda a: F.struct(person(a).alias("@id")))),
        "hasPart": F.transform("nums", lambda n: F.concat(vol, F.lit("/page/"), F.format_string("%04d", n))), "tocEntry": F.col("raw_text"),
    }))
    note = found.join(named.select("volume_slug", "article_id", "num"), "article_id")
    tail = F.concat(F.format_string("p%03d-", "page_num"), F.col("n").cast("string")) if page_scoped_notes else F.col("n").cast("string")
    out.append(_node(note, 4, [F.col("num"), F.col("page_ord"), F.col("reading_pos")], iri(prefix, "art", F.col("article_id"), F.lit("fn"), tail), ["Comment"], {
        "name": F.concat(F.lit("Footnote "), F.col("n").cast("string")), "text": F.col("text"), "footnoteOf": art, "position": F.col("n"), "inPage": here, "pageStart": F.col("page_num"),
    }))
    out.append(_node(people(articles), 5, [F.col("ord.num"), F.col("ord.at")], person(F.col("name")), ["Person"], {"name": F.col("name")}))
    whole = out[0]
    for part in out[1:]:
        whole = whole.unionByName(part)
    return whole


def merge_entries(entries: DataFrame) -> DataFrame:
    """node_id, key, value: of each key of a node the first value by source_ord, node_pos; entries without node_id go.

    The first value wins by aggregation, so copies of one node in many sources are combined before the shuffle.
    """
    return entries.where("node_id is not null").groupBy("node_id", "key").agg(F.min_by("value", F.struct("source_ord", "node_pos")).alias("value"), F.min(F.struct("source_ord", "node_pos")).alias("seen"))


def merge(nodes: DataFrame, prefer: str = "first") -> DataFrame:
    """node_id, types, props, seen: nodes of one id become one, keys missing in the first filled from later ones (or `incoming`: later win).

    nodes: source_ord, node_pos (orderable), node_id, types, props. seen sorts the result as it was first met.
    """
    order = F.struct("source_ord", "node_pos") if prefer == "first" else F.struct((-F.col("source_ord")).alias("source_ord"), "node_pos")
    named = nodes.where("node_id is not null")
    heads = named.groupBy("node_id").agg(F.min_by("types", order).alias("types"), F.min(F.struct("source_ord", "node_pos")).alias("seen"))
    keys = named.select("source_ord", "node_pos", "node_id", F.posexplode(F.map_entries("props")).alias("at", "e"))
    keys = keys.groupBy("node_id", F.col("e.key").alias("key")).agg(F.min_by(F.col("e.value"), order).alias("value"), F.min(F.struct("source_ord", "node_pos", "at")).alias("seen"))
    props = keys.groupBy("node_id").agg(F.map_from_entries(F.transform(F.array_sort(F.collect_list(F.struct("seen", "key", "value"))), lambda x: F.struct(x["key"], x["value"]))).alias("props"))
    return heads.join(props, "node_id", "left").select("node_id", "types", F.coalesce("props", F.create_map().cast("map<string,string>")).alias("props"), "seen")


def counts_by_type(nodes: DataFrame) -> DataFrame:
    """type and how many nodes have it, all types of a node counting."""
    return nodes.select(F.explode("types").alias("type")).groupBy("type").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "type")


def index(nodes: DataFrame) -> DataFrame:
    """First types, how many nodes have each, and their ids in order."""
    return nodes.groupBy(F.col("types")[0].alias("type")).agg(F.count(F.lit(1)).alias("n"), F.array_sort(F.collect_list("node_id")).alias("ids"))


def merge_subsections(rows: DataFrame) -> DataFrame:
    """person, volume_slug, body, ord: a person's sections, one for each volume; incoming ones win; by year in the slug (else 9999) and slug.

    rows: person, volume_slug, incoming (boolean), pos, body.
    """
    best = rows.groupBy("person", "volume_slug").agg(F.max_by("body", F.struct("incoming", -F.col("pos"))).alias("body"))
    year = F.coalesce(F.nullif(F.regexp_extract("volume_slug", "-[0-9]{3}-([0-9]{4})", 1), F.lit("")).cast("int"), F.lit(9999))
    return best.withColumn("ord", F.row_number().over(Window.partitionBy("person").orderBy(year, "volume_slug")))


def keep_zones(new: DataFrame, existing: DataFrame) -> DataFrame:
    """path, ord, name, body: zones of new pages with the text that was there before, where there was one."""
    old = existing.select("path", "name", F.col("body").alias("_old"))
    return new.join(old, ["path", "name"], "left").select("path", "ord", "name", F.coalesce("_old", "body").alias("body"))
