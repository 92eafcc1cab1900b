"""Footnotes and the references to them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from .layout import fixed

#: What the format takes for a note's number and for references to notes.
BODY = "^\\s*([0-9]{1,3})[.°)\\s]\\s*"
CARET = "(?<![0-9])([0-9]{1,3})\\^"
SUPERSCRIPT = f"(?<={T.WORD_CHAR[:-1]}¹²³⁰⁴⁵⁶⁷⁸⁹])([¹²³⁰⁴⁵⁶⁷⁸⁹]+)"
PLAIN = f"(?<={T.WORD_CHAR}\\s{{1,9}})([0-9]{{1,3}})(?=\\s+[.,;:!?\\-)\\]]|\\s*$)"
#: What every text with a match of PLAIN has, told without looking behind each place.
MAY_BE_PLAIN = "\\s[0-9]{1,3}(?:\\s|$)"
#: Types whose text holds no references.
QUIET = ("footnote", "page-header", "page-footer", "table-of-contents")


def parse_body(c: Column) -> Column:
    """n (null if the note starts with no number) and the rest of its text."""
    n = F.nullif(F.regexp_extract(c, BODY, 1), F.lit("")).cast("int")
    return F.struct(n.alias("n"), F.when(n.isNull(), T.strip(c)).otherwise(T.strip(F.regexp_replace(c, BODY, ""))).alias("body"))


def notes(rows: DataFrame) -> DataFrame:
    """article_id, block_id, page_num, pos, n, is_numbered, text, html_id of footnote blocks: rows with article_id, page_num, page_ord, reading_pos.

    Notes without a number are counted by article and page.
    """
    f = rows.where("type = 'footnote'").withColumn("_b", parse_body(F.col("text")))
    w = Window.partitionBy("article_id", "page_num", F.col("_b.n").isNull()).orderBy("page_ord", "reading_pos")
    n = F.coalesce("_b.n", F.row_number().over(w))
    page = F.when(F.col("page_num").isNull(), "p???").otherwise(F.format_string("p%03d", "page_num"))
    out = f.select("article_id", "block_id", "page_num", "page_ord", "reading_pos", n.alias("n"), F.col("_b.n").isNotNull().alias("is_numbered"), F.col("_b.body").alias("text"), page.alias("_p"))
    return out.withColumn("html_id", F.concat(F.lit("fn-"), "article_id", F.lit("-"), "_p", F.lit("-"), F.when(F.col("is_numbered"), "").otherwise("u"), F.col("n").cast("string"))).drop("_p")


def numbered_sets(found: DataFrame) -> DataFrame:
    """article_id, page_num and the numbers of its notes, sorted."""
    return found.where("is_numbered").groupBy("article_id", "page_num").agg(F.array_sort(F.collect_set("n")).alias("numbers"))


def _drop_overlaps(refs: Column) -> Column:
    """Of matches in order those that start where the last one kept has ended, or later."""
    kind = "array<struct<start:int,end:int,n:int>>"
    return F.aggregate(refs, F.array().cast(kind), lambda kept, r: F.when((F.size(kept) == 0) | (r["start"] >= F.coalesce(F.try_element_at(kept, F.lit(-1))["end"], F.lit(0))), F.concat(kept, F.array(r))).otherwise(kept))


def marked_refs(c: Column) -> Column:
    """start, end, n of caret and superscript markers, by place, without overlaps; patterns are tried only where their sign stands."""
    none = F.array().cast("array<struct<start:int,end:int,n:int>>")
    caret = F.transform(T.matches(c, CARET), lambda r: F.struct(r["start"].alias("start"), (r["end"] + 1).alias("end"), r["n"].cast("int").alias("n")))
    digits = lambda r: F.translate(r["n"], *T.SUPERSCRIPTS).try_cast("int")
    sup = F.filter(F.transform(T.matches(c, SUPERSCRIPT), lambda r: F.struct(r["start"].alias("start"), r["end"].alias("end"), digits(r).alias("n"))), lambda r: r["n"].between(1, 499))
    carets, raised = F.contains(c, F.lit("^")), F.translate(c, T.SUPERSCRIPTS[0], "") != c
    return F.when(carets & raised, _drop_overlaps(F.array_sort(F.concat(caret, sup)))).when(carets, caret).when(raised, sup).otherwise(none)


def plain_refs(c: Column) -> Column:
    """start, end, n of bare numbers after a word and before punctuation or the end; only those with a note on the page count."""
    found = F.transform(T.matches(c, PLAIN), lambda r: F.struct(r["start"].alias("start"), r["end"].alias("end"), r["n"].cast("int").alias("n")))
    return F.when(c.rlike(MAY_BE_PLAIN), found).otherwise(F.array().cast("array<struct<start:int,end:int,n:int>>"))


def refs(rows: DataFrame) -> DataFrame:
    """article_id, page_num, block_id, page_ord, reading_pos, kind, start, end, n, target_id: references of body blocks (see `page_refs`)."""
    keys, place = ("article_id", "page_num"), ("page_ord", "reading_pos")
    return page_refs(fixed(rows.groupBy(*keys).agg(F.collect_list(F.struct("block_id", *place, "type", "text")).alias("blocks"))), place)


def page_refs(pages: DataFrame, place: tuple[str, ...] = ()) -> DataFrame:
    """article_id, page_num, block_id, kind, start, end, n, target_id of pages with their blocks as an array; target null where the page has no such note.

    Bare numbers are references only on pages that have the note. One pass over the blocks of each page: the id of a numbered note
    follows from article, page and number (see `notes`), so that nothing is joined. place: fields of blocks that come along. The
    order of blocks plays no part.
    """
    keys = ("article_id", "page_num")
    numbers = F.transform(F.filter("blocks", lambda b: b["type"] == "footnote"), lambda b: parse_body(b["text"])["n"])
    numbered = F.when(F.col("page_num").isNotNull(), F.filter(numbers, lambda n: n.isNotNull())).alias("_n")
    rows = pages.select(*keys, numbered, F.filter("blocks", lambda b: ~b["type"].isin(*QUIET) & b["text"].rlike("[0-9¹²³⁰⁴⁵⁶⁷⁸⁹]")).alias("blocks"))
    body = fixed(rows).select(*keys, "_n", F.explode("blocks").alias("_b")).select(*keys, "_n", *[f"_b.{c}" for c in ("block_id", *place, "text")])
    known = lambda n: F.coalesce(F.array_contains("_n", n), F.lit(False))
    plain = F.when(F.size("_n") > 0, F.filter(plain_refs(F.col("text")), lambda x: known(x["n"])))
    kinds = F.array(F.struct(F.lit("marked").alias("kind"), marked_refs(F.col("text")).alias("m")), F.struct(F.lit("plain").alias("kind"), plain.alias("m")))
    r = body.select(*keys, "block_id", *place, "_n", F.explode(kinds).alias("k"))
    r = r.select(*keys, "block_id", *place, "_n", "k.kind", F.explode("k.m").alias("m"))
    target = F.when(known(F.col("m.n")), F.concat(F.lit("fn-"), "article_id", F.format_string("-p%03d-", "page_num"), F.col("m.n").cast("string")))
    return r.select(*keys, "block_id", *place, "kind", "m.start", "m.end", "m.n", target.alias("target_id"))


def stats(found: DataFrame, linked: DataFrame) -> DataFrame:
    """article_id, n_notes, n_refs, resolved, unresolved."""
    a = found.groupBy("article_id").agg(F.count(F.lit(1)).alias("n_notes"))
    b = linked.groupBy("article_id").agg(F.count(F.lit(1)).alias("n_refs"), F.count("target_id").alias("resolved"))
    out = a.join(b, "article_id", "full").na.fill(0, ["n_notes", "n_refs", "resolved"])
    return out.withColumn("unresolved", F.col("n_refs") - F.col("resolved"))


def splice(c: Column, found: Column) -> Column:
    """Text with marks put in: found is an ordered array of start, end, mark without overlaps."""
    rest = lambda s, upto: F.substring(c, s["at"] + 1, upto - s["at"])
    return F.aggregate(
        found,
        F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
        lambda s, r: F.struct(r["end"].alias("at"), F.concat(s["out"], rest(s, r["start"]), r["mark"]).alias("out")),
        lambda s: F.concat(s["out"], rest(s, F.length(c))),
    )


def with_html(rows: DataFrame, linked: DataFrame, found: DataFrame) -> DataFrame:
    """rows with text_html, the text with its marked references as links, and targets (n, target_id) of its page's notes.

    Allowed inline tags stay; a reference without a note is raised, but no link.
    """
    link = F.coalesce(F.concat(F.lit('<a href="#'), T.html_escape(F.col("target_id")), F.lit('">'), F.col("n").cast("string"), F.lit("</a>")), F.col("n").cast("string"))
    mark = F.concat(F.lit('<sup class="fn-ref">'), link, F.lit("</sup>"))
    marks = linked.where("kind = 'marked'").groupBy("article_id", "page_num", "block_id").agg(F.array_sort(F.collect_list(F.struct("start", "end", mark.alias("mark")))).alias("_r"))
    last = found.where("is_numbered").groupBy("article_id", "page_num", "n").agg(F.max_by("html_id", F.struct("page_ord", "reading_pos")).alias("target_id"))
    notes_of = last.groupBy("article_id", "page_num").agg(F.array_sort(F.collect_list(F.struct("n", "target_id"))).alias("targets"))
    out = rows.join(marks, ["article_id", "page_num", "block_id"], "left").join(notes_of, ["article_id", "page_num"], "left")
    return out.withColumn("text_html", T.inline_html(F.coalesce("text", F.lit("")), F.col("_r.start"), F.col("_r.end"), F.col("_r.mark"))).drop("_r")


def link_markers(c: Column, targets: Column) -> Column:
    """HTML with `<sup>N</sup>` and `N^` in its text as links to targets (array of n, target_id); as it is where there are none.

    Text nodes alone are looked at, in tables within tables as elsewhere; what is left open is closed, and end tags of nothing go.
    Raised numbers without a note get the class only, and one that holds a link is left as it is.
    """
    return T.link_numbers(c, F.transform(targets, lambda t: t["n"]), F.transform(targets, lambda t: t["target_id"]))
