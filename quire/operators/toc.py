"""Tables of contents: blocks to tokens, tokens to entries and sections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T

#: What the format fixes: a leader is two dots or more before a number; pages have one to four digits, ranges a hyphen or dash.
LEADER = "[.]{2,}(?=\\s*[0-9])"
PAGE = "^\\s*([0-9]{1,4}(?:[-–][0-9]{1,4})?)"
UPPER, LOWER = "A-ZÄÖÜ", "a-zäöüß"


def _token(kind: str, text: Column, page: Column | None = None) -> Column:
    return F.struct(F.lit(kind).alias("kind"), text.alias("token"), (F.lit(None).cast("string") if page is None else page).alias("page"))


def _label(body: Column) -> Column:
    """A section label stuck to the front of an entry: capitals up to the one that starts the entry's first word; else empty.

    The label's first word has three letters or more, its others two.
    """
    head = F.regexp_extract(body, f"^[{UPPER}\\s]+(?=[{LOWER}])", 0)
    label = T.strip(F.left(head, F.length(head) - 1))
    words = F.split(label, "\\s+")
    sized = F.exists(words, lambda w: F.length(w) > 0) & (F.length(words[0]) >= 3) & F.forall(words, lambda w: F.length(w) >= 2)
    return F.when(sized & F.right(head, F.lit(1)).rlike(f"[{UPPER}]"), label).otherwise("")


def _entry(body: Column, page: Column) -> Column:
    """The tokens of what stands before a leader."""
    body = T.strip(body)
    label = _label(body)
    rest = T.strip(F.substring(body, F.length(label) + 1, F.length(body)))
    return F.filter(F.array(_token("header", label), _token("entry", rest, page)), lambda t: t["token"] != "")


def _rest(text: Column) -> Column:
    """The token of what follows the last page: a header if it is all capitals, three or more."""
    text = T.strip(text)
    capitals = text.rlike(f"^[{UPPER}]") & (F.length(text) >= 3) & (F.regexp_replace(text, f"[{UPPER}\\s]+", "") == "")
    return F.when(text == "", F.array().cast("array<struct<kind:string,token:string,page:string>>")).when(capitals, F.array(_token("header", text))).otherwise(F.array(_token("entry", text)))


def tokens(blobs: DataFrame, key: str = "volume_slug", text: str = "text") -> DataFrame:
    """key, pos, kind, token, page of the whole text of each row: one row for each volume's contents.

    A first line in capitals is the title. The text is cut at its leaders, so that each part but the first starts with the page
    of the entry before it; a label stuck to an entry is a header of its own. Null and empty texts have no tokens.
    """
    rows = blobs.select(key, F.coalesce(F.col(text), F.lit("")).alias("_text"))
    first = T.strip(F.substring_index("_text", "\n", 1))
    titled = (F.instr("_text", "\n") > 0) & (first == F.upper(first)) & (first != F.lower(first)) & F.length(first).between(2, 30)
    rows = rows.select(key, F.when(titled, first).alias("_title"), F.when(titled, F.substring("_text", F.instr("_text", "\n") + 1, F.length("_text"))).otherwise(F.col("_text")).alias("_text"))
    rows = rows.withColumn("_parts", F.split("_text", LEADER))
    # each part with the page that the next one starts with
    page = lambda i: F.regexp_extract(F.get("_parts", i), PAGE, 1)
    body = lambda x, i: F.when(i == 0, x).otherwise(F.regexp_replace(x, PAGE, ""))
    found = F.transform("_parts", lambda x, i: F.when(i < F.size("_parts") - 1, _entry(body(x, i), page(i + 1))).otherwise(_rest(body(x, i))))
    every = F.concat(F.when(F.col("_title").isNotNull(), F.array(_token("title", F.col("_title")))).otherwise(F.array().cast("array<struct<kind:string,token:string,page:string>>")), F.flatten(found))
    return rows.select(key, F.posexplode(every).alias("pos", "t")).select(key, "pos", "t.kind", "t.token", "t.page")


def contents_text(ordered: DataFrame) -> DataFrame:
    """volume_slug and text of all its table-of-contents blocks in document order, joined by line breaks; empty texts left out."""
    rows = ordered.where((F.col("type") == "table-of-contents") & (F.col("text") != ""))
    parts = F.array_sort(F.collect_list(F.struct("page_num", "reading_pos", "text")))
    return rows.groupBy("volume_slug").agg(F.array_join(F.transform(parts, lambda p: p["text"]), "\n").alias("text"))


def entries(toks: DataFrame, labels: DataFrame | None = None, key: str = "volume_slug") -> DataFrame:
    """key, pos, raw_text, author, title, page, page_end, section of each entry token.

    section is the last header above, empty before the first; where labels (a table of key and label) knows a header when folded,
    the label's own spelling is used. A volume's tokens are few.
    """
    w = Window.partitionBy(key).orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    toks = toks.withColumn("_fold", F.when(F.col("kind") == "header", T.fold_label(F.col("token"))))
    name = F.col("token")
    if labels is not None:
        known = labels.select(F.col(key).alias("_k"), T.fold_label(F.col("label")).alias("_f"), F.col("label").alias("_label")).dropDuplicates(["_k", "_f"])
        toks = toks.join(known, (toks[key] == F.col("_k")) & (F.col("_fold") == F.col("_f")), "left").drop("_k", "_f")
        name = F.coalesce("_label", "token")
    toks = toks.withColumn("section", F.coalesce(F.last(F.when(F.col("kind") == "header", T.title_case(name)), True).over(w), F.lit("")))
    out = toks.where("kind = 'entry'").withColumn("_a", T.author_title(F.col("token"))).withColumn("_p", T.page_range(F.col("page")))
    return out.select(key, "pos", F.col("token").alias("raw_text"), "_a.author", "_a.title", "_p.page", "_p.page_end", "section")


def sections(found: DataFrame, key: str = "volume_slug") -> DataFrame:
    """Sections of each volume in order of appearance, each with its entries in order."""
    named = found.where("section <> ''")
    each = F.array_sort(F.collect_list(F.struct("pos", "author", "title", "page")))
    return named.groupBy(key, "section").agg(F.min("pos").alias("first_pos"), F.count(F.lit(1)).alias("n_entries"), each.alias("entries"))
