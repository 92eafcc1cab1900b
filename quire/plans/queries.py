"""Queries over the driver's tables that apply the engine's operators, and the SQL to hold them against."""

from __future__ import annotations

import tempfile
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import articles, blocks, footnotes, graph, layout, render, toc, wiki
from ..schemas import CANON_TYPES, VISUAL
from . import proxies as P
from . import volume

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query; whole numbers come out as bigint, as in the SQL."""

    def add(f: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            df = f(spark, sf_dir)
            return df.select(*[F.col(c).cast("bigint").alias(c) if t in ("int", "smallint", "tinyint") else F.col(c) for c, t in df.dtypes])

        QUERIES[name] = run
        if sql:
            SQL[name] = sql
        return f

    return add


def _ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layout.reading_order(layout.detect_columns(P.pages(spark, sf_dir)))


_SLUG = "printf('vol-%03d-2000', vol)"
_CASE = "CASE " + " ".join(f"WHEN t = '{k}' THEN '{v}'" for k, v in CANON_TYPES.items()) + " ELSE 'text' END"


@query("canonical_types", f"SELECT event_type, n, {_CASE} AS type FROM (SELECT event_type, count(*) AS n, CASE event_type WHEN 'click' THEN 'picture' WHEN 'view' THEN 'section-header' ELSE replace(lower(event_type), '_', '-') END AS t FROM events GROUP BY event_type)")
def _(spark, sf):
    e = P.read(spark, sf, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    raw = F.when(F.col("event_type") == "click", "BlockType.PICTURE").when(F.col("event_type") == "view", " Section_Header ").otherwise(F.col("event_type"))
    return e.select("event_type", "n", blocks.canonical_type(raw).alias("type"))


@query("type_histogram", P.SQL + "SELECT type AS raw_type, type, count(*) AS n FROM b GROUP BY type")
def _(spark, sf):
    rows = P.pages(spark, sf).select("page_num", F.inline("blocks"))
    return blocks.type_histogram(rows)


@query("pixel_bbox", """SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_partkey, least(ax, bx)::BIGINT AS x1, least(ay, "by")::BIGINT AS y1, greatest(ax, bx)::BIGINT AS x2, greatest(ay, "by")::BIGINT AS y2 FROM (
SELECT *, round_even(greatest(0, x1 * sx), 0) AS ax, round_even(least(1400, x2 * sx), 0) AS bx, round_even(greatest(0, y1 * sy), 0) AS ay, round_even(least(2000, y2 * sy), 0) AS "by" FROM (
SELECT *, CASE WHEN m THEN 1400 ELSE 1 END AS sx, CASE WHEN m THEN 2000 ELSE 1 END AS sy FROM (SELECT *, greatest(abs(x1), abs(y1), abs(x2), abs(y2)) <= 1.5 AS m FROM (
SELECT l_orderkey, l_linenumber, l_partkey, l_discount AS x1, l_tax AS y1, CASE WHEN l_partkey % 2 = 0 THEN l_quantity * 31.5 ELSE 0.5 + l_discount END AS x2, CASE WHEN l_partkey % 2 = 0 THEN l_quantity * 40.5 ELSE 0.75 END AS y2 FROM lineitem))))""")
def _(spark, sf):
    l = P.read(spark, sf, "lineitem")
    even = F.col("l_partkey") % 2 == 0
    box = F.array(F.col("l_discount"), F.col("l_tax"), F.when(even, F.col("l_quantity") * 31.5).otherwise(0.5 + F.col("l_discount")), F.when(even, F.col("l_quantity") * 40.5).otherwise(0.75))
    return l.select("l_orderkey", "l_linenumber", "l_partkey", blocks.pixel_bbox(box, F.lit(1400), F.lit(2000)).alias("b")).select("l_orderkey", "l_linenumber", "l_partkey", "b.*")


@query("gutter_detect", P.SQL + "SELECT page_num, l0::BIGINT AS l0, l1::BIGINT AS l1, r0::BIGINT AS r0, r1::BIGINT AS r1 FROM cols")
def _(spark, sf):
    return layout.detect_columns(P.pages(spark, sf)).where("cols is not null").select("page_num", "cols.*")


@query("assign_columns", P.SQL + "SELECT page_num, emit_pos, col::BIGINT AS col FROM a")
def _(spark, sf):
    return layout.assign_columns(layout.detect_columns(P.pages(spark, sf))).select("page_num", F.inline("blocks")).select("page_num", "emit_pos", "col")


@query("reading_order", P.SQL + f"SELECT {_SLUG} AS volume_slug, page_num, reading_pos, emit_pos, block_id, type, col::BIGINT AS col FROM o")
def reading_order(spark, sf):
    return _ordered(spark, sf).select("volume_slug", "page_num", "reading_pos", "emit_pos", "block_id", "type", "col")


@query("band_layout", P.SQL + "SELECT page_num, emit_pos, CASE WHEN col IS NULL THEN above ELSE upto END AS band, CASE WHEN col IS NULL THEN 'spanning' ELSE 'columns' END AS kind FROM o WHERE two")
def _(spark, sf):
    return layout.bands(layout.detect_columns(P.pages(spark, sf)).where("cols is not null")).select("page_num", "emit_pos", "band", "kind")


@query("spanning_above", P.SQL + "SELECT page_num, emit_pos, above FROM o")
def _(spark, sf):
    pages = layout.assign_columns(layout.detect_columns(P.pages(spark, sf))).withColumn("ys", F.transform(F.filter("blocks", lambda b: b["col"].isNull()), lambda b: b["y1"]))
    return pages.select("page_num", "ys", F.explode("blocks").alias("b")).select("page_num", "b.emit_pos", F.size(F.filter("ys", lambda y: y < F.col("b.y1"))).alias("above"))


@query("order_audit", P.SQL + f"SELECT {_SLUG} AS volume_slug, page_num, count(*) FILTER (emit_pos <> reading_pos) AS moved, count(*) FILTER (regexp_matches(text, '[^ ]-$') AND nx IS NOT NULL AND NOT regexp_matches(nx, '^[a-zäöüß]')) AS broken, count(*) AS blocks FROM (SELECT *, lead(text) OVER (PARTITION BY page_num ORDER BY reading_pos) AS nx FROM o) GROUP BY ALL")
def _(spark, sf):
    return layout.order_audit(_ordered(spark, sf))


_TOP = """mt AS (SELECT x.page_num, min(least(x.y1, y.y1)) AS top FROM b x JOIN b y ON x.page_num = y.page_num AND x.emit_pos < y.emit_pos AND least(x.y2, y.y2) > greatest(x.y1, y.y1) AND (x.x2 <= y.x1 OR y.x2 <= x.x1)
WHERE x.type NOT IN ('page-header', 'page-footer', 'table-of-contents', 'title') AND y.type NOT IN ('page-header', 'page-footer', 'table-of-contents', 'title') GROUP BY x.page_num),
cand AS (SELECT b.*, (x1 + x2) / 2.0 AS c FROM b LEFT JOIN mt USING (page_num) WHERE NOT coalesce(y2 <= top, false) AND type NOT IN"""


@query("masthead", P.SQL.replace("cand AS (SELECT *, (x1 + x2) / 2.0 AS c FROM b WHERE type NOT IN", _TOP) + "SELECT page_num, emit_pos, top::BIGINT AS top, CASE WHEN NOT coalesce(y2 <= top, false) THEN col END::BIGINT AS col FROM a LEFT JOIN mt USING (page_num)")
def _(spark, sf):
    pages = layout.assign_columns(layout.detect_columns(P.pages(spark, sf), masthead=True))
    return pages.select("page_num", F.col("masthead_top").alias("top"), F.explode("blocks").alias("b")).select("page_num", "b.emit_pos", "top", "b.col")


@query("overlay_geometry", P.SQL + "SELECT page_num, emit_pos, printf('%.3f', x1 * 100.0 / 1400) AS \"left\", printf('%.3f', y1 * 100.0 / 2000) AS top, printf('%.3f', (least(1400, x2) - x1) * 100.0 / 1400) AS width, printf('%.3f', (least(2000, y2) - y1) * 100.0 / 2000) AS height FROM b")
def _(spark, sf):
    rows = P.pages(spark, sf).select("page_num", "image_width", "image_height", F.explode("blocks").alias("b"))
    return rows.select("page_num", "b.emit_pos", layout.overlay(F.col("b"), F.col("image_width"), F.col("image_height")).alias("o")).select("page_num", "emit_pos", "o.*")


_SPANS = """, v AS (SELECT vol, min(page_num) AS lo, max(page_num) AS hi FROM vp GROUP BY vol),
n AS (SELECT vol, page_num AS page_first, row_number() OVER w AS num, greatest(coalesce(lead(page_num) OVER w - 1, hi), page_num) AS page_last, lo FROM anchors JOIN v USING (vol) WINDOW w AS (PARTITION BY vol ORDER BY page_num)),
art AS (SELECT vol, num, page_first, page_last, printf('vol-%03d-2000-art%02d', vol, num) AS article_id FROM n UNION ALL SELECT vol, 0, lo, page_first - 1, printf('vol-%03d-2000-frontmatter', vol) FROM n WHERE num = 1 AND page_first > lo),
br AS (SELECT art.vol, art.num, article_id, vp.page_num FROM art JOIN vp ON art.vol = vp.vol AND vp.page_num BETWEEN page_first AND page_last)
"""


def _articles(spark, sf):
    return articles.spans(P.anchors(spark, sf), P.volume_pages(spark, sf))


@query("article_spans", P.SQL + _SPANS + f"SELECT {_SLUG} AS volume_slug, num, page_first, page_last, article_id FROM art")
def _(spark, sf):
    return _articles(spark, sf).select("volume_slug", "num", "page_first", "page_last", "article_id")


@query("article_pages", P.SQL + _SPANS + "SELECT article_id, page_num FROM br")
def _(spark, sf):
    return articles.article_pages(_articles(spark, sf), P.volume_pages(spark, sf)).select("article_id", "page_num")


@query("page_owner", P.SQL + _SPANS + f"SELECT {_SLUG.replace('vol)', 'vp.vol)')} AS volume_slug, vp.page_num, arg_min(article_id, num) AS owner FROM vp LEFT JOIN (SELECT * FROM br WHERE num > 0) br ON vp.vol = br.vol AND vp.page_num = br.page_num GROUP BY ALL")
def _(spark, sf):
    return articles.page_owner(articles.article_pages(_articles(spark, sf), P.volume_pages(spark, sf)), P.volume_pages(spark, sf))


@query("prev_next", P.SQL + _SPANS + "SELECT article_id, lag(article_id) OVER w AS prev, lead(article_id) OVER w AS next FROM art WHERE num > 0 WINDOW w AS (PARTITION BY vol ORDER BY num)")
def _(spark, sf):
    return articles.neighbours(_articles(spark, sf)).select("article_id", "prev", "next")


@query("running_numbers", P.SQL + "SELECT page_num, emit_pos AS pos, text::BIGINT AS printed FROM b WHERE type = 'page-header'")
def _(spark, sf):
    rows = P.pages(spark, sf).select("volume_slug", "page_num", "image_height", F.inline("blocks"))
    return articles.running_numbers(rows).select("page_num", "pos", "printed")


@query("printed_offset_mode", P.SQL + f", d AS (SELECT vol, pn - pr AS off, pn, emit_pos FROM (SELECT vol, page_num // 50 AS pn, emit_pos, CASE WHEN p % 3 = 0 THEN page_num % 97 ELSE page_num // 50 - 3 - vol END AS pr FROM b WHERE type = 'page-header') WHERE pr BETWEEN 0 AND 9999), e AS (SELECT vol, off, count(*) AS k, min(row(pn, emit_pos)) AS seen FROM d GROUP BY ALL), r AS (SELECT *, sum(k) OVER (PARTITION BY vol) AS total, row_number() OVER (PARTITION BY vol ORDER BY k DESC, seen) AS r FROM e) SELECT {_SLUG} AS volume_slug, off AS \"offset\" FROM r WHERE r = 1 AND total >= 3 AND k >= greatest(3, total // 4)")
def _(spark, sf):
    # pages numbered within their volume; two headers of three print a number that the volume's offset explains
    rows = P.pages(spark, sf).select("volume_slug", "vol", "page_num", "image_height", F.inline("blocks"))
    inner = F.floor(F.col("page_num") / 50).cast("int")
    printed = F.when(F.col("p") % 3 == 0, F.col("page_num") % 97).otherwise(inner - 3 - F.col("vol")).cast("string")
    rows = rows.withColumn("text", F.when(F.col("type") == "page-header", printed).otherwise(F.col("text"))).withColumn("page_num", inner)
    return articles.printed_offset(articles.running_numbers(rows))


@query("footnote_parse", P.SQL + "SELECT page_num, emit_pos, nullif(regexp_extract(text, '^\\s*([0-9]{1,3})[.°)\\s]\\s*', 1), '')::BIGINT AS n, CASE WHEN regexp_matches(text, '^\\s*([0-9]{1,3})[.°)\\s]') THEN regexp_replace(text, '^\\s*([0-9]{1,3})[.°)\\s]\\s*', '') ELSE text END AS body FROM b WHERE type = 'footnote'")
def _(spark, sf):
    rows = P.pages(spark, sf).select("page_num", F.inline("blocks")).where("type = 'footnote'")
    return rows.select("page_num", "emit_pos", footnotes.parse_body(F.col("text")).alias("b")).select("page_num", "emit_pos", "b.*")


def _cut(df: DataFrame) -> DataFrame:
    """df behind a checkpoint in the session's shared folder; where none is set, as in tests, in one of its own.

    Tables that several branches of a plan share are analysed anew for each of them, which takes minutes for plans of this depth.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        shared = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not shared and not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir(shared or tempfile.mkdtemp())
    return df.checkpoint()


def _rows(spark, sf):
    """Blocks as one article for each volume, pages in order."""
    return _ordered(spark, sf).select(F.concat("volume_slug", F.lit("-art01")).alias("article_id"), "volume_slug", "page_num", F.col("page_num").alias("page_ord"), "reading_pos", "block_id", "type", "raw_type", "text", "html", "description", "x1", "y1", "x2", "y2", "image_filename", "image_width", "image_height")


def _article_pages(spark, sf):
    """Pages with their blocks as emitted, as one article for each volume: for what doesn't depend on the reading order."""
    return P.pages(spark, sf).withColumn("article_id", F.concat("volume_slug", F.lit("-art01")))


_NOTES = """, fn0 AS (SELECT *, nullif(regexp_extract(text, '^\\s*([0-9]{1,3})[.°)\\s]\\s*', 1), '')::BIGINT AS num FROM o WHERE type = 'footnote'),
fn AS (SELECT vol, page_num, reading_pos, block_id, coalesce(num, row_number() OVER (PARTITION BY page_num, num IS NULL ORDER BY reading_pos)) AS n, num IS NOT NULL AS is_numbered FROM fn0),
tgt AS (SELECT page_num, n, arg_max(concat(printf('fn-vol-%03d-2000-art01-p%03d-', vol, page_num), n), reading_pos) AS target_id FROM fn WHERE is_numbered GROUP BY page_num, n),
body AS (SELECT * FROM o WHERE type NOT IN ('footnote', 'page-header', 'page-footer', 'table-of-contents')),
rf AS (SELECT page_num, block_id, 'marked' AS kind, regexp_extract(text, '([0-9]{1,3})\\^', 1)::BIGINT AS n, 5::BIGINT AS start FROM body WHERE text LIKE '%^%' UNION ALL
SELECT body.page_num, block_id, 'plain', regexp_extract(text, ' ([0-9]{1,3}) \\.', 1)::BIGINT AS n, 10 FROM body SEMI JOIN tgt ON body.page_num = tgt.page_num AND tgt.n = regexp_extract(text, ' ([0-9]{1,3}) \\.', 1)::BIGINT WHERE text LIKE 'Body word %'),
rt AS (SELECT rf.*, target_id FROM rf LEFT JOIN tgt USING (page_num, n))
"""
_NOTES = _NOTES.replace("regexp_extract(text, ' ([0-9]{1,3}) \\.', 1)::BIGINT", "try_cast(regexp_extract(text, ' ([0-9]{1,3}) \\.', 1) AS BIGINT)")


@query("unnumbered_seq", P.SQL + _NOTES + "SELECT page_num, block_id, n, is_numbered FROM fn")
def _(spark, sf):
    return footnotes.notes(_rows(spark, sf)).select("page_num", "block_id", "n", "is_numbered")


@query("numbered_sets", P.SQL + _NOTES + "SELECT page_num, string_agg(DISTINCT n::VARCHAR, ',' ORDER BY n::VARCHAR) AS numbers FROM fn WHERE is_numbered GROUP BY page_num")
def _(spark, sf):
    return footnotes.numbered_sets(footnotes.notes(_rows(spark, sf))).select("page_num", F.array_join(F.transform("numbers", lambda n: n.cast("string")), ",").alias("numbers"))


@query("ref_links", P.SQL + _NOTES + "SELECT page_num, block_id, kind, n, start, target_id FROM rt")
def _(spark, sf):
    return footnotes.page_refs(_article_pages(spark, sf)).select("page_num", "block_id", "kind", "n", "start", "target_id")


@query("ref_resolution_stats", P.SQL + _NOTES + ", v AS (SELECT DISTINCT vol, page_num FROM b) SELECT printf('vol-%03d-2000-art01', vol) AS article_id, sum(a)::BIGINT AS n_notes, sum(c)::BIGINT AS n_refs, sum(d)::BIGINT AS resolved, (sum(c) - sum(d))::BIGINT AS unresolved FROM (SELECT vol, count(*) AS a, 0 AS c, 0 AS d FROM fn GROUP BY vol UNION ALL SELECT vol, 0, count(*), count(target_id) FROM rt JOIN v USING (page_num) GROUP BY vol) GROUP BY vol")
def _(spark, sf):
    pages = _article_pages(spark, sf)
    rows = pages.select("article_id", "page_num", F.explode(F.filter("blocks", lambda b: b["type"] == "footnote")).alias("b"))
    found = footnotes.notes(rows.select("article_id", "page_num", F.col("page_num").alias("page_ord"), F.col("b.emit_pos").alias("reading_pos"), "b.block_id", "b.type", "b.text"))
    return footnotes.stats(found, footnotes.page_refs(pages))


@query("wiki_refs", P.SQL + _NOTES + """, pl AS (SELECT page_num, block_id, n AS note, concat(printf('p%03d-', page_num), n) AS tag FROM rt WHERE kind = 'plain')
SELECT o.page_num, o.block_id, CASE WHEN type = 'text' AND note IS NOT NULL THEN replace(text, concat(' ', note, ' .'), concat(' <sup><a id="fnref-', tag, '" href="#fn-', tag, '">', note, '</a></sup> .')) ELSE text END AS text FROM o LEFT JOIN pl USING (page_num, block_id)""")
def _(spark, sf):
    return wiki.with_links(_rows(spark, sf)).select("page_num", "block_id", "text")


@query("footnote_section", P.SQL + _NOTES + """, ft AS (SELECT fn.*, concat(printf('p%03d-', page_num), CASE WHEN is_numbered THEN '' ELSE 'u' END, n) AS tag, CASE WHEN is_numbered THEN regexp_replace(text, '^\\s*([0-9]{1,3})[.°)\\s]\\s*', '') ELSE text END AS body FROM fn JOIN (SELECT page_num, block_id, text FROM fn0) USING (page_num, block_id)),
fl AS (SELECT *, concat('<a id="fn-', tag, '"></a>', CASE WHEN is_numbered THEN concat('<sup>', n, '</sup>', chr(8195), body, ' <a href="#fnref-', tag, '">↩</a>') ELSE body END, chr(10), chr(10)) AS f FROM ft),
fp AS (SELECT vol, page_num, concat(chr(10), '### Page ', page_num, chr(10), chr(10), string_agg(f, '' ORDER BY reading_pos)) AS f FROM fl GROUP BY vol, page_num)
SELECT printf('vol-%03d-2000-art01', vol) AS article_id, md5(concat(chr(10), '## Footnotes', chr(10), string_agg(f, '' ORDER BY page_num))) AS notes_md5 FROM fp GROUP BY vol""")
def _(spark, sf):
    return wiki.note_section(footnotes.notes(_rows(spark, sf))).select("article_id", F.md5(F.col("notes").cast("binary")).alias("notes_md5"))


_MD = "CASE type WHEN 'section-header' THEN concat('#### ', text, chr(10), chr(10)) WHEN 'text' THEN concat(text, chr(10), chr(10)) ELSE '' END"


@query("article_body_md", P.SQL + f", pg AS (SELECT vol, page_num, concat('### Page ', page_num, chr(10), chr(10), regexp_replace(string_agg({_MD}, '' ORDER BY reading_pos), '([\\p{{L}}\\p{{Nd}}_])-\\n\\n([a-zäöüß])', '\\1\\2', 'g')) AS t FROM o GROUP BY vol, page_num) SELECT printf('vol-%03d-2000-art01', vol) AS article_id, md5(string_agg(t, '' ORDER BY page_num)) AS body_md5 FROM pg GROUP BY vol")
def _(spark, sf):
    pages = layout.ordered_pages(layout.detect_columns(P.pages(spark, sf)), ("block_id", "type", "text", "html", "description"))
    pages = pages.select(F.concat("volume_slug", F.lit("-art01")).alias("article_id"), "page_num", F.col("page_num").alias("page_ord"), "blocks")
    return render.pages_markdown(pages).select("article_id", F.md5(F.col("body").cast("binary")).alias("body_md5"))


_ESC = "replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"


@query("tei_fragment", P.SQL + f"""SELECT page_num, block_id, CASE type WHEN 'section-header' THEN concat('<head facs="#z_', block_id, '">', {_ESC}, '</head>') WHEN 'page-header' THEN concat('<fw type="page-header" facs="#z_', block_id, '">', {_ESC}, '</fw>') WHEN 'page-footer' THEN concat('<fw type="page-footer" facs="#z_', block_id, '">', {_ESC}, '</fw>')
WHEN 'footnote' THEN concat('<note place="foot" n="', emit_pos, '" xml:id="fn_', block_id, '" facs="#z_', block_id, '">', {_ESC}, '</note>') ELSE concat('<p facs="#z_', block_id, '">', {_ESC}, '</p>') END AS tei FROM b""")
def _(spark, sf):
    rows = P.pages(spark, sf).select("page_num", F.inline("blocks"))
    return rows.select("page_num", "block_id", render.tei_fragment(F.col("emit_pos")).alias("tei"))


_PX = "CASE type WHEN 'section-header' THEN 'heading' WHEN 'page-header' THEN 'header' WHEN 'page-footer' THEN 'footer' WHEN 'footnote' THEN 'footnote' ELSE 'paragraph' END"


@query("pagexml_region", P.SQL + f"""SELECT page_num, block_id, concat('<TextRegion id="', block_id, '" custom="layout:', type, '" type="', {_PX}, '"><Coords points="', printf('%d,%d %d,%d %d,%d %d,%d', x1, y1, x2, y1, x2, y2, x1, y2), '"/><TextEquiv><Unicode>', {_ESC}, '</Unicode></TextEquiv></TextRegion>') AS region FROM b""")
def _(spark, sf):
    return P.pages(spark, sf).select("page_num", F.inline("blocks")).select("page_num", "block_id", render.pagexml_region().alias("region"))


_KEY = "l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_partkey"
_VIS = "type IN ('figure', 'image', 'diagram')"
_FACS = " facs=\"#z_', block_id, '\">"


def _quoted(x: str) -> str:
    return f"replace(replace({x}, '\"', '&quot;'), '''', '&#x27;')"


def _each(before: str, x: str, after: str, sep: str) -> str:
    return f"coalesce(array_to_string(list_transform(list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(x)), lambda x: x <> ''), lambda x: concat('{before}', {x}, '{after}')), {sep}), '')"


def _items(tag: str) -> str:
    return _each(f"<{tag}>", _ESC.replace("(text", "(x"), f"</{tag}>", "''")


@query("kinds_tei", P.KINDS_ORACLE + f"""SELECT {_KEY}, CASE WHEN type = 'section-header' THEN concat('<head{_FACS}', {_ESC}, '</head>') WHEN type IN ('page-header', 'page-footer') THEN concat('<fw type="', type, '"{_FACS}', {_ESC}, '</fw>')
WHEN type = 'footnote' THEN concat('<note place="foot" n="', emit_pos, '" xml:id="fn_', block_id, '"{_FACS}', {_ESC}, '</note>') WHEN type = 'caption' THEN concat('<figure{_FACS}<figDesc>', {_ESC}, '</figDesc></figure>')
WHEN {_VIS} THEN concat('<figure type="', type, '"{_FACS}<graphic url="#z_', block_id, '"/>', CASE WHEN text <> '' THEN concat('<figDesc>', {_ESC}, '</figDesc>') ELSE '' END, '</figure>')
WHEN type = 'table' THEN concat('<table{_FACS}<row><cell>', {_ESC}, '</cell></row></table>') WHEN type = 'bibliography' THEN concat('<listBibl{_FACS}', {_items("bibl")}, '</listBibl>') WHEN type = 'table-of-contents' THEN concat('<list type="contents"{_FACS}', {_items("item")}, '</list>')
WHEN type = 'list' THEN concat('<list{_FACS}', {_items("item")}, '</list>') WHEN type = 'equation' THEN concat('<formula notation="TeX"{_FACS}', {_ESC}, '</formula>') ELSE concat('<p{_FACS}', {_ESC}, '</p>') END AS tei FROM k""")
def _(spark, sf):
    return P.kinds(spark, sf).select("l_orderkey", "l_linenumber", "l_partkey", render.tei_fragment(F.col("emit_pos")).alias("tei"))


@query("kinds_pagexml", P.KINDS_ORACLE + f"""SELECT {_KEY}, concat('<', e, ' id="', block_id, '" custom="layout:', type, '"', CASE WHEN a <> '' THEN concat(' type="', a, '"') ELSE '' END, '><Coords points="', printf('%d,%d %d,%d %d,%d %d,%d', x1, y1, x2, y1, x2, y2, x1, y2), '"/>',
CASE WHEN e = 'TextRegion' AND text <> '' THEN concat('<TextEquiv><Unicode>', {_ESC}, '</Unicode></TextEquiv>') ELSE '' END, '</', e, '>') AS region
FROM (SELECT *, CASE WHEN type = 'table' THEN 'TableRegion' WHEN {_VIS} THEN 'ImageRegion' WHEN type = 'equation' THEN 'MathsRegion' ELSE 'TextRegion' END AS e, CASE type WHEN 'text' THEN 'paragraph' WHEN 'section-header' THEN 'heading' WHEN 'page-header' THEN 'header' WHEN 'page-footer' THEN 'footer'
WHEN 'list' THEN 'list-label' WHEN 'table-of-contents' THEN 'TOC-entry' WHEN 'caption' THEN 'caption' WHEN 'footnote' THEN 'footnote' WHEN 'bibliography' THEN 'other' WHEN 'form' THEN 'other' WHEN 'code' THEN 'other' ELSE '' END AS a FROM k)""")
def _(spark, sf):
    return P.kinds(spark, sf).select("l_orderkey", "l_linenumber", "l_partkey", render.pagexml_region().alias("region"))


@query("kinds_markdown", P.KINDS_ORACLE + f"""SELECT {_KEY}, CASE WHEN type IN ('page-header', 'page-footer', 'table-of-contents', 'footnote') THEN '' WHEN {_VIS} THEN concat('> **[', upper(substr(type, 1, 1)), substr(type, 2), ' · ', block_id, ']**', CASE WHEN t <> '' THEN concat(' ', t) WHEN description IS NOT NULL THEN concat(' ', description) ELSE '' END, chr(10), chr(10))
WHEN type = 'table' AND html <> '' THEN concat(html, chr(10), chr(10)) WHEN type IN ('bibliography', 'list') THEN CASE WHEN r <> '' THEN concat(r, chr(10), chr(10)) ELSE '' END WHEN t = '' THEN '' WHEN type = 'section-header' THEN concat('#### ', t, chr(10), chr(10)) WHEN type = 'caption' THEN concat('*', t, '*', chr(10), chr(10))
WHEN type = 'equation' THEN concat('$$', chr(10), t, chr(10), '$$', chr(10), chr(10)) ELSE concat(t, chr(10), chr(10)) END AS md FROM (SELECT *, trim(text, concat(' ', chr(10))) AS t, {_each("- ", "x", "", "chr(10)")} AS r FROM k)""")
def _(spark, sf):
    return P.kinds(spark, sf).select("l_orderkey", "l_linenumber", "l_partkey", render.markdown_fragment().alias("md"))


_BR = f"replace({_ESC}, chr(10), '<br>')"


@query("kinds_html", P.KINDS_ORACLE + f"""SELECT {_KEY}, CASE WHEN type IN ('page-header', 'page-footer', 'footnote', 'table-of-contents') THEN '' WHEN type = 'section-header' THEN concat('<h3>', {_BR}, '</h3>') WHEN type = 'caption' THEN concat('<figcaption>', {_BR}, '</figcaption>')
WHEN {_VIS} THEN concat('<figure><img src="../regions/', block_id, '.png" alt="', {_quoted(_ESC.replace("(text", "(coalesce(description, text)"))}, '"></figure>') WHEN type = 'table' AND html <> '' THEN replace(html, ' onclick="x"', '')
WHEN type IN ('bibliography', 'list') THEN concat('<ul>', {_items("li")}, '</ul>') WHEN type = 'equation' THEN concat('<div class="equation">', {_BR}, '</div>') ELSE concat('<p>', {_BR}, '</p>') END AS html FROM k""")
def _(spark, sf):
    return P.kinds(spark, sf).select("l_orderkey", "l_linenumber", "l_partkey", render.html_block().alias("html"))


@query("html_links", """SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_partkey, concat('<table><tr><td colspan="', j, '">x < y ', CASE WHEN k IN (1, 2) THEN concat('<sup class="fn-ref"><a href="#t', k, '">', k, '</a></sup>') ELSE concat('<sup class="fn-ref">', k, '</sup>') END,
' &amp; <table><tr><td>', CASE WHEN j IN (1, 2) THEN concat('<sup class="fn-ref"><a href="#t', j, '">', j, '</a></sup>') ELSE concat('<sup class="fn-ref"> ', j, ' </sup>') END, '<i>end ', l_partkey, '</i></td></tr></table></td></tr></table>') AS html
FROM (SELECT l_orderkey, l_linenumber, l_partkey, 1 + l_partkey % 4 AS k, 1 + l_suppkey % 4 AS j FROM lineitem)""".replace("x < y", "x &lt; y"))
def _(spark, sf):
    l = P.read(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", (1 + F.col("l_partkey") % 4).alias("k"), (1 + F.col("l_suppkey") % 4).alias("j"))
    # dealt to all tasks: a file of few row groups would be parsed in as few
    l = l.repartition("l_orderkey", "l_linenumber")
    # a table within a table, an end tag of nothing, tags left open
    given = F.format_string('<table><tr><td colspan="%d">x &lt; y %d^ &amp; <table><tr><td><sup> %d </sup></b><i>end %d</table></td></tr>', "j", "k", "j", "l_partkey")
    return l.select("l_orderkey", "l_linenumber", "l_partkey", footnotes.link_markers(given, F.expr("array(named_struct('n', 1, 'target_id', 't1'), named_struct('n', 2, 'target_id', 't2'))")).alias("html"))


@query("index_lines", """WITH n AS (SELECT 1 AS part, CAST(1900 + n_nationkey AS VARCHAR) AS sort_by, concat('d:vol/n', n_nationkey) AS id, concat('- [', n_name, ' (', 1900 + n_nationkey, ')](volumes/n', n_nationkey, '.md) · `d:vol/n', n_nationkey, '`') AS line FROM nation
UNION ALL SELECT 2, '', concat('d:art/a', o_orderkey), concat('- [a', o_orderkey, '](articles/a', o_orderkey, '.md) · `d:art/a', o_orderkey, '`') FROM orders
UNION ALL SELECT 3, c_name, concat('d:person/c', c_custkey), concat('- [', c_name, '](people/c', c_custkey, '.md) · `d:person/c', c_custkey, '`') FROM customer
UNION ALL SELECT 4, '', 'WebPage', concat('- WebPage: ', count(*)) FROM part)
SELECT part::BIGINT AS part, 1::BIGINT AS rank, sort_by, id, line FROM n UNION ALL SELECT part, 0, '', '', concat(chr(10), '## ', CASE part WHEN 1 THEN concat('Volumes (', count(*), ')') WHEN 2 THEN concat('Articles (', count(*), ')') WHEN 3 THEN concat('People (', count(*), ')') ELSE 'Other nodes of the graph' END, chr(10)) FROM n GROUP BY part""")
def _(spark, sf):
    def nodes(name, kind, ident, label=None, year=None):
        json = lambda c: F.to_json(F.struct(c.alias("v"))).substr(F.lit(6), F.length(F.to_json(F.struct(c.alias("v")))) - 6)
        props = [x for k, c in (("name", label), ("datePublished", year)) if c is not None for x in (F.lit(k), json(c))]
        return P.read(spark, sf, name).select(ident.alias("node_id"), F.array(F.lit(kind)).alias("types"), (F.create_map(*props) if props else F.create_map()).cast("map<string,string>").alias("props"))

    ident = lambda kind, c: F.concat(F.lit(f"d:{kind}"), F.col(c).cast("string"))
    all_of = nodes("nation", "PublicationVolume", ident("vol/n", "n_nationkey"), F.col("n_name"), (1900 + F.col("n_nationkey")).cast("string"))
    all_of = all_of.unionByName(nodes("orders", "ScholarlyArticle", ident("art/a", "o_orderkey"))).unionByName(nodes("customer", "Person", ident("person/c", "c_custkey"), F.col("c_name"))).unionByName(nodes("part", "WebPage", ident("p/", "p_partkey")))
    return wiki.index_rows(all_of).select(F.col("key.part").alias("part"), F.col("key.rank").alias("rank"), F.col("key.key.by").alias("sort_by"), F.col("key.key.id").alias("id"), "line")


@query("html_escape", "SELECT doc_id, md5(replace(replace(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;'), '''', '&#x27;')) AS escaped_md5 FROM documents")
def _(spark, sf):
    return P.read(spark, sf, "documents").select("doc_id", F.md5(T.html_escape(F.col("text")).cast("binary")).alias("escaped_md5"))


@query("html_text", "SELECT page_id, md5(regexp_replace(regexp_replace(regexp_replace(html, '(?i)<br\\s*/?>', chr(10), 'g'), '<[^>]+>', '', 'g'), '^[\\s\\x{a0}]+|[\\s\\x{a0}]+$', '', 'g')) AS text_md5 FROM pages")
def _(spark, sf):
    return P.read(spark, sf, "pages").select("page_id", F.md5(T.html_to_text(F.col("html")).cast("binary")).alias("text_md5"))


@query("slugify", "SELECT doc_id, md5(CASE WHEN text = '' THEN '' WHEN s = '' THEN 'x' ELSE s END) AS slug_md5 FROM (SELECT doc_id, text, trim(regexp_replace(lower(strip_accents(text)), '[^a-z0-9]+', '-', 'g'), '-') AS s FROM documents)")
def _(spark, sf):
    return P.read(spark, sf, "documents").select("doc_id", F.md5(T.slug(F.col("text")).cast("binary")).alias("slug_md5"))


@query("hyphen_join", "SELECT doc_id, md5(regexp_replace(replace(text, ' ', '-' || chr(10) || chr(10)), '([\\p{L}\\p{Nd}_])-\\n\\n([a-zäöüß])', '\\1\\2', 'g')) AS joined_md5 FROM documents")
def _(spark, sf):
    return P.read(spark, sf, "documents").select("doc_id", F.md5(T.join_hyphens(F.replace("text", F.lit(" "), F.lit("-\n\n"))).cast("binary")).alias("joined_md5"))


@query("author_split", "SELECT c_custkey, string_agg(trim(x, ' ,.;'), '|' ORDER BY i) AS names FROM (SELECT c_custkey, unnest([c_name, concat('B', c_nationkey, '.'), c_mktsegment]) AS x, unnest([1, 2, 3]) AS i FROM customer) GROUP BY c_custkey")
def _(spark, sf):
    joined = F.concat("c_name", F.lit(" / B"), F.col("c_nationkey").cast("string"), F.lit(". und "), "c_mktsegment")
    return P.read(spark, sf, "customer").select("c_custkey", F.array_join(T.split_authors(joined), "|").alias("names"))


@query("page_range_parse", "SELECT l_orderkey, l_partkey, l_linenumber::BIGINT AS l_linenumber, l_suppkey AS page, CASE WHEN l_partkey % 3 = 0 THEN l_suppkey + l_linenumber END AS page_end FROM lineitem")
def _(spark, sf):
    l = P.read(spark, sf, "lineitem")
    text = F.when(F.col("l_partkey") % 3 == 0, F.concat(F.col("l_suppkey").cast("string"), F.when(F.col("l_partkey") % 2 == 0, "-").otherwise("–"), (F.col("l_suppkey") + F.col("l_linenumber")).cast("string"))).otherwise(F.col("l_suppkey").cast("string"))
    return l.select("l_orderkey", "l_partkey", "l_linenumber", T.page_range(text).alias("r")).select("l_orderkey", "l_partkey", "l_linenumber", "r.*")


def _contents(spark, sf):
    """A table of contents for each nation: a header for every market segment, an entry for each customer."""
    c = P.read(spark, sf, "customer")
    page = F.col("c_custkey") % 9000 + 1  # four digits at most
    entry = F.concat(F.lit("Karl Schmotz, Kunde Nr"), F.col("c_custkey").cast("string"), F.lit(" ...... "), page.cast("string"), F.lit("-"), (page + 3).cast("string"))
    lines = c.groupBy("c_nationkey", "c_mktsegment").agg(F.concat(F.upper("c_mktsegment"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("c_custkey", entry.alias("e")))), lambda x: x["e"]), "")).alias("part"))
    return lines.groupBy("c_nationkey").agg(F.concat(F.lit("INHALT\n"), F.array_join(F.array_sort(F.collect_list("part")), "")).alias("text"))


_TOC = """WITH e AS (SELECT c_nationkey, c_custkey, upper(left(c_mktsegment, 1)) || lower(substr(c_mktsegment, 2)) AS section, row_number() OVER (PARTITION BY c_nationkey ORDER BY upper(c_mktsegment), c_custkey) AS i, dense_rank() OVER (PARTITION BY c_nationkey ORDER BY upper(c_mktsegment)) AS d FROM customer)
"""


@query("toc_entries", _TOC + "SELECT c_nationkey, 'Karl Schmotz' AS author, concat('Kunde Nr', c_custkey) AS title, c_custkey % 9000 + 1 AS page, c_custkey % 9000 + 4 AS page_end, section FROM e")
def _(spark, sf):
    found = toc.entries(toc.tokens(_contents(spark, sf), "c_nationkey"), key="c_nationkey")
    return found.select("c_nationkey", "author", "title", "page", "page_end", "section")


@query("toc_sections", _TOC + "SELECT c_nationkey, section, count(*) AS n_entries FROM e GROUP BY ALL")
def _(spark, sf):
    found = toc.entries(toc.tokens(_contents(spark, sf), "c_nationkey"), key="c_nationkey")
    return toc.sections(found, "c_nationkey").select("c_nationkey", "section", "n_entries")


@query("title_match", """WITH t AS (SELECT p_partkey, p_name, lower(p_name) AS k FROM part), h AS (SELECT p_partkey + d AS p_partkey, d, concat(upper(p_name), CASE WHEN d = 0 THEN ' More' ELSE '' END) AS header, concat(lower(p_name), CASE WHEN d = 0 THEN ' more' ELSE '' END) AS k FROM part, (VALUES (0), (1)) v(d)),
m AS (SELECT t.p_partkey, header, h.d, len(list_intersect(list_distinct(string_split(t.k, ' ')), list_distinct(string_split(h.k, ' ')))) AS score FROM t JOIN h USING (p_partkey) WHERE starts_with(h.k, array_to_string(string_split(t.k, ' ')[1:4], ' ')) OR starts_with(t.k, array_to_string(string_split(h.k, ' ')[1:4], ' ')))
SELECT p_partkey AS page_num, arg_max(header, row(score, -d)) AS header, max(score)::BIGINT AS score FROM m WHERE score > 0 GROUP BY p_partkey""")
def _(spark, sf):
    part = P.read(spark, sf, "part")
    expected = part.select(F.lit("v").alias("volume_slug"), F.col("p_partkey").alias("page_num"), F.lit(0).alias("toc_pos"), F.col("p_name").alias("title"))
    rows = part.select("p_partkey", "p_name", F.explode(F.array(F.lit(0), F.lit(1))).alias("d"))
    heads = rows.select(F.lit("v").alias("volume_slug"), (F.col("p_partkey") + F.col("d")).alias("page_num"), F.col("d").alias("reading_pos"), F.concat(F.upper("p_name"), F.when(F.col("d") == 0, " More").otherwise("")).alias("text"), F.lit("section-header").alias("type"), F.lit(10).alias("y1"), F.lit(2000).alias("image_height"))
    return articles.match_titles(expected, heads).select("page_num", "header", "score")


@query("graph_merge_first_wins", "SELECT user_id AS node_id, event_type AS key, arg_min(value, row(ts, event_id)) AS value FROM events GROUP BY ALL")
def _(spark, sf):
    e = P.read(spark, sf, "events")
    return graph.merge_entries(e.select(F.col("ts").alias("source_ord"), F.col("event_id").alias("node_pos"), F.col("user_id").alias("node_id"), F.col("event_type").alias("key"), "value")).select("node_id", "key", "value")


def _nodes(spark, sf):
    c = P.read(spark, sf, "customer")
    types = F.when(F.col("c_nationkey") % 3 == 0, F.array("c_mktsegment", F.lit("Book"))).otherwise(F.array("c_mktsegment"))
    return c.select(types.alias("types"), F.concat(F.lit("n"), F.col("c_custkey").cast("string")).alias("node_id"))


@query("nodes_by_type", "SELECT type, count(*) AS n FROM (SELECT c_mktsegment AS type FROM customer UNION ALL SELECT 'Book' FROM customer WHERE c_nationkey % 3 = 0) GROUP BY type")
def _(spark, sf):
    return graph.counts_by_type(_nodes(spark, sf))


@query("index_counts", "SELECT c_mktsegment AS type, count(*) AS n, md5(string_agg('n' || c_custkey, ',' ORDER BY 'n' || c_custkey)) AS ids_md5 FROM customer GROUP BY c_mktsegment")
def _(spark, sf):
    return graph.index(_nodes(spark, sf)).select("type", "n", F.md5(F.array_join("ids", ",").cast("binary")).alias("ids_md5"))


@query("person_merge", "SELECT o_custkey::VARCHAR AS person, volume_slug, body, row_number() OVER (PARTITION BY o_custkey ORDER BY y, volume_slug) AS ord FROM (SELECT o_custkey, printf('vol-%03d-%d', o_custkey % 50, year(o_orderdate)) AS volume_slug, year(o_orderdate) AS y, arg_max(o_orderkey, row(o_orderpriority = '1-URGENT', -o_orderkey)) AS body FROM orders GROUP BY ALL)")
def _(spark, sf):
    o = P.read(spark, sf, "orders")
    rows = o.select(F.col("o_custkey").cast("string").alias("person"), F.format_string("vol-%03d-%d", F.col("o_custkey") % 50, F.year("o_orderdate")).alias("volume_slug"), (F.col("o_orderpriority") == "1-URGENT").alias("incoming"), F.col("o_orderkey").alias("pos"), F.col("o_orderkey").alias("body"))
    return graph.merge_subsections(rows)


@query("zone_preserve", "SELECT n.conv_id AS path, n.turn AS ord, n.role AS name, coalesce(e.body, n.text) AS body FROM conversations n LEFT JOIN (SELECT conv_id, role, min(text) AS body FROM conversations WHERE turn < 2 GROUP BY ALL) e USING (conv_id, role)")
def _(spark, sf):
    c = P.read(spark, sf, "conversations")
    new = c.select(F.col("conv_id").alias("path"), F.col("turn").alias("ord"), F.col("role").alias("name"), F.col("text").alias("body"))
    old = c.where("turn < 2").groupBy(F.col("conv_id").alias("path"), F.col("role").alias("name")).agg(F.min("text").alias("body"))
    return graph.keep_zones(new, old)


@query("ocr_time_stats", "SELECT printf('v%02d', user_id % 20) AS volume_slug, count(*) FILTER (event_id % 7 <> 0) AS inferred, count(*) FILTER (event_id % 7 = 0) AS resumed, round(avg(value) FILTER (event_id % 7 <> 0), 4) AS avg_s, min(value) FILTER (event_id % 7 <> 0) AS min_s, max(value) FILTER (event_id % 7 <> 0) AS max_s FROM events GROUP BY ALL")
def _(spark, sf):
    e = P.read(spark, sf, "events")
    out = volume.ocr_times(e.select(F.format_string("v%02d", F.col("user_id") % 20).alias("volume_slug"), (F.col("event_id") % 7 == 0).alias("_resumed"), F.col("value").alias("ocr_seconds")))
    return out.withColumn("avg_s", F.round("avg_s", 4))


@query("timing_pct", "SELECT o_orderpriority AS stage, count(*)::DOUBLE AS seconds, round(count(*) * 100 / sum(count(*)) OVER (), 6) AS percent FROM orders GROUP BY o_orderpriority")
def _(spark, sf):
    return volume.timings(P.read(spark, sf, "orders").groupBy(F.col("o_orderpriority").alias("stage")).agg(F.count(F.lit(1)).cast("double").alias("seconds")))


_MARKUP = """SELECT page_id, translate(regexp_replace(regexp_replace(replace(replace(replace(h, '&copy;', '©'), '&middot;', '·'), '&quot;', '"'), {keep}, 'g'), '<[^>]*>', '', 'g'), concat(chr(1), chr(2)), '<>') AS clean
FROM (SELECT page_id, regexp_replace(replace(html, s, replace(replace(replace(s, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')), '<!--.*?-->', '', 'g') AS h FROM (SELECT *, regexp_extract(html, '<script>(.*?)</script>', 1) AS s FROM pages))"""


@query("sanitize_inline", _MARKUP.format(keep="'<(/?(?:b|strong|i|em|u|sub|sup|br|small|s|code|span))>', concat(chr(1), '\\1', chr(2))"))
def _(spark, sf):
    return P.read(spark, sf, "pages").select("page_id", T.sanitize_inline(F.col("html")).alias("clean"))


@query("sanitize_block", _MARKUP.format(keep="'<(/?(?:b|strong|i|em|u|sub|sup|br|small|s|code|span|p|div|table|thead|tbody|tr|th|td|ul|ol|li|a)|a href=\"/[^\"]*\")>', concat(chr(1), '\\1', chr(2))").replace("replace(h, '&copy;'", "replace(regexp_replace(h, '<div class=\"[^\"]*\">', '<div>', 'g'), '&copy;'"))
def _(spark, sf):
    return P.read(spark, sf, "pages").select("page_id", T.sanitize_block(F.col("html")).alias("clean"))


@query("nfkd_slug", "SELECT c_custkey, lower(regexp_replace(c_name, '[^A-Za-z0-9]+', '-', 'g')) AS slug FROM customer")
def _(spark, sf):
    return P.read(spark, sf, "customer").select("c_custkey", T.nfkd_slug(F.col("c_name")).alias("slug"))


_REGION = f"""concat('<TextRegion id="', block_id, '" custom="layout:', type, '" type="', {_PX}, '"><Coords points="', printf('%d,%d %d,%d %d,%d %d,%d', x1, y1, x2, y1, x2, y2, x1, y2), '"/>', CASE WHEN text <> '' THEN concat('<TextEquiv><Unicode>', {_ESC}, '</Unicode></TextEquiv>') ELSE '' END, '</TextRegion>')"""


@query("pagexml_pages", P.SQL + f"""SELECT {_SLUG} AS volume_slug, page_num, concat('<?xml version="1.0" encoding="UTF-8"?>', chr(10), '<PcGts xmlns="http://schema.primaresearch.org/PAGE/gts/pagecontent/2019-07-15">', chr(10), '<Metadata><Creator>quire</Creator><Created>2020-01-01T00:00:00</Created><LastChange>2020-01-01T00:00:00</LastChange></Metadata>', chr(10),
printf('<Page imageFilename="page_%04d.png" imageWidth="1400" imageHeight="2000">', page_num), chr(10), string_agg({_REGION}, chr(10) ORDER BY reading_pos), chr(10), '</Page>', chr(10), '</PcGts>') AS xml FROM o GROUP BY vol, page_num""")
def _(spark, sf):
    return render.pagexml(_ordered(spark, sf), "2020-01-01T00:00:00")


@query("tei_volumes", P.SQL + f""", nn AS (SELECT *, row_number() OVER (PARTITION BY vol, type = 'footnote' ORDER BY page_num, reading_pos) AS note FROM o),
f AS (SELECT *, CASE type WHEN 'section-header' THEN concat('<head{_FACS}', {_ESC}, '</head>') WHEN 'page-header' THEN concat('<fw type="page-header"{_FACS}', {_ESC}, '</fw>') WHEN 'page-footer' THEN concat('<fw type="page-footer"{_FACS}', {_ESC}, '</fw>')
WHEN 'footnote' THEN concat('<note place="foot" n="', note, '" xml:id="fn_', block_id, '"{_FACS}', {_ESC}, '</note>') ELSE concat('<p{_FACS}', {_ESC}, '</p>') END AS x,
concat('<zone xml:id="z_', block_id, '" points="', printf('%d,%d %d,%d %d,%d %d,%d', x1, y1, x2, y1, x2, y2, x1, y2), '"/>') AS z FROM nn),
tp AS (SELECT vol, page_num, concat(printf('<pb n="%d" facs="#page_%04d"/>', page_num, page_num), chr(10), string_agg(x, chr(10) ORDER BY reading_pos)) AS x, concat(printf('<surface xml:id="page_%04d">', page_num), string_agg(z, '' ORDER BY reading_pos), '</surface>') AS z FROM f GROUP BY vol, page_num)
SELECT {_SLUG} AS volume_slug, concat('<?xml version="1.0" encoding="UTF-8"?>', chr(10), '<TEI xmlns="http://www.tei-c.org/ns/1.0">', chr(10), '<teiHeader><fileDesc><titleStmt><title>', {_SLUG}, '</title></titleStmt><publicationStmt><publisher>P</publisher><date>2000</date></publicationStmt></fileDesc></teiHeader>', chr(10),
'<facsimile>', chr(10), string_agg(z, chr(10) ORDER BY page_num), chr(10), '</facsimile>', chr(10), '<text><body>', chr(10), '<div type="article" xml:id="', {_SLUG}, '-art01"><head>Whole volume</head>', chr(10), string_agg(x, chr(10) ORDER BY page_num), chr(10), '</div>', chr(10), '</body></text></TEI>') AS xml FROM tp GROUP BY vol""")
def _(spark, sf):
    pages = layout.ordered_pages(layout.detect_columns(P.pages(spark, sf)), render.TEI_FIELDS)
    pages = pages.select("volume_slug", F.concat("volume_slug", F.lit("-art01")).alias("article_id"), F.lit(1).alias("num"), F.lit("Whole volume").alias("title"), F.col("page_num").alias("page_ord"), "page_num", "blocks")
    slugs = P.read(spark, sf, "lineitem").select(F.format_string("vol-%03d-2000", F.col("l_orderkey") % 50).alias("volume_slug")).distinct()
    volumes = slugs.select("volume_slug", F.col("volume_slug").alias("volume_title"), F.lit("P").alias("publisher"), F.lit(2000).alias("volume_year"))
    return render.pages_tei(pages, volumes)


def _said(**members: str) -> str:
    """SQL for the props of a node: names with texts (in quotes of their own) or, under names that end in _, whole numbers and lists."""
    parts = ["'\"" + k.rstrip("_") + "\":\"" + ("" if k.endswith("_") else "\\\"") + "', " + v + ", '" + ("" if k.endswith("_") else "\\\"") + "\"'" for k, v in members.items()]
    return "concat('{', " + ", ',', ".join(parts) + ", '}')"


_VOL, _PAGE, _ART = f"concat('doc:vol/', {_SLUG})", f"concat('doc:vol/', {_SLUG}, printf('/page/%04d', page_num))", "concat('doc:art/', article_id)"
_ORG = "'{{\\\"@type\\\":\\\"Organization\\\",\\\"name\\\":\\\"{}\\\"}}'"


@query("volume_graph", P.SQL + _NOTES + f""", pgs AS (SELECT DISTINCT vol, page_num FROM o), ends AS (SELECT vol, min(page_num) AS lo, max(page_num) AS hi FROM pgs GROUP BY vol),
head AS (SELECT vol, page_num, text FROM (SELECT *, row_number() OVER (PARTITION BY page_num ORDER BY y1, reading_pos) AS r FROM o WHERE type = 'section-header' AND y1 < 2000 / 3.0) WHERE r = 1),
anc AS (SELECT vol, page_num, text AS title FROM head UNION ALL SELECT vol, lo, 'Volume' FROM ends WHERE vol NOT IN (SELECT vol FROM head)),
ga AS (SELECT vol, title, page_num AS page_first, row_number() OVER w AS num, greatest(coalesce(lead(page_num) OVER w - 1, hi), page_num) AS page_last FROM anc JOIN ends USING (vol) WINDOW w AS (PARTITION BY vol ORDER BY page_num)),
gn AS (SELECT *, printf('vol-%03d-2000-art%02d', vol, num) AS article_id FROM ga),
gb AS (SELECT gn.vol, article_id, page_num FROM gn JOIN pgs ON gn.vol = pgs.vol AND page_num BETWEEN page_first AND page_last),
gf AS (SELECT fn.vol, fn.page_num, n, CASE WHEN is_numbered THEN regexp_replace(text, '^\\s*([0-9]{{1,3}})[.°)\\s]\\s*', '') ELSE text END AS body FROM fn JOIN (SELECT page_num, block_id, text FROM fn0) USING (page_num, block_id))
SELECT {_SLUG} AS volume_slug, 'doc:series/series' AS node_id, 'PublicationSeries' AS types, {_said(name="'Series'", publisher_=_ORG.format("P"))} AS props FROM ends
UNION ALL SELECT {_SLUG}, {_VOL}, 'PublicationVolume,Book', {_said(name="'Volume I'", volumeNumber_="'1'", datePublished="'2000'", inLanguage="'de'", inSeries="'doc:series/series'", publisher_=_ORG.format("P"), editor_=_ORG.format("E"))} FROM ends
UNION ALL SELECT {_SLUG}, {_PAGE}, 'WebPage', CASE WHEN article_id IS NOT NULL THEN {_said(name="concat('Page ', page_num)", pageStart_="page_num", facsimile="printf('pages/page_%04d.png', page_num)", inArticle=_ART)} ELSE {_said(name="concat('Page ', page_num)", pageStart_="page_num", facsimile="printf('pages/page_%04d.png', page_num)", inVolume=_VOL)} END FROM pgs LEFT JOIN gb USING (vol, page_num)
UNION ALL SELECT {_SLUG}, {_ART}, 'ScholarlyArticle', {_said(name="title", pageStart_="page_first", pageEnd_="page_last", position_="num", inVolume=_VOL, hasPart_="concat('[', parts, ']')")} FROM gn JOIN (SELECT article_id, string_agg(concat('\\"', {_PAGE}, '\\"'), ',' ORDER BY page_num) AS parts FROM gb GROUP BY article_id) USING (article_id)
UNION ALL SELECT {_SLUG}, concat({_ART}, '/fn/', n), 'Comment', {_said(name="concat('Footnote ', n)", text="body", footnoteOf=_ART, position_="n", inPage=_PAGE, pageStart_="page_num")} FROM gf JOIN gb USING (vol, page_num)""")
def _(spark, sf):
    # what the graph is made from: headers, notes, pictures, and a block of each page
    used = F.col("type").isin("section-header", "footnote", *VISUAL) | (F.col("reading_pos") == 0)
    ordered = _ordered(spark, sf).where(used)
    ordered = _cut(ordered.select("volume_slug", "page_num", "image_filename", "image_height", "reading_pos", "block_id", "type", "text", "description", "x1", "y1", "x2", "y2"))
    pages = ordered.where("reading_pos = 0").select("volume_slug", "page_num", "image_filename")
    slugs = _cut(pages.select("volume_slug").distinct())
    arts = articles.heuristic_anchors(ordered, slugs.select("volume_slug", F.lit("Volume").alias("title")))
    arts = _cut(articles.spans(arts, pages))
    bridge = _cut(articles.article_pages(arts, pages))
    rows = bridge.select("article_id", "volume_slug", "page_num", F.col("ord").alias("page_ord")).join(ordered.where("type = 'footnote'"), ["volume_slug", "page_num"])
    vols = slugs.select("volume_slug", F.lit("Series").alias("series_name"), F.lit("P").alias("publisher"), F.lit("E").alias("editor"), F.lit("Volume").alias("volume_title"), F.lit(1).alias("volume_number"), F.lit("I").alias("volume_number_roman"), F.lit(2000).alias("volume_year"), F.lit("de").alias("language"))
    nodes = graph.volume_graph(vols, ordered, arts, bridge, articles.page_owner(bridge, pages), footnotes.notes(rows), pages=pages)
    return nodes.select("volume_slug", "node_id", F.array_join("types", ",").alias("types"), F.to_json("props").alias("props"))
