"""Schemas of the engine's tables and the fixed values of its vocabularies."""

from __future__ import annotations

BLOCK = "id string, type string, bbox array<double>, text string, html string"
RAW_PAGE = f"page_num int, image_filename string, image_width int, image_height int, ocr_seconds double, markdown string, raw string, _resumed boolean, blocks array<struct<id:string,type:string,label:string,block_type:string,bbox:array<double>,text:string,content:string,html:string>>"

#: Layout labels and the canonical type of each. Labels not listed are text.
CANON_TYPES = {
    "text": "text",
    "paragraph": "text",
    "section-header": "section-header",
    "header": "section-header",
    "title": "section-header",
    "caption": "caption",
    "footnote": "footnote",
    "table": "table",
    "image": "image",
    "figure": "figure",
    "diagram": "diagram",
    "picture": "figure",
    "equation-block": "equation",
    "equation": "equation",
    "formula": "equation",
    "textinlinemath": "text",
    "code-block": "code",
    "code": "code",
    "chemical-block": "code",
    "bibliography": "bibliography",
    "table-of-contents": "table-of-contents",
    "toc-entry": "table-of-contents",
    "page-header": "page-header",
    "page-footer": "page-footer",
    "list-group": "list",
    "list": "list",
    "list-item": "list",
    "form": "form",
    "handwriting": "text",
    "complex-block": "text",
}

#: PageXML element and type attribute of each canonical type.
PAGEXML_TYPES = {
    "text": ("TextRegion", "paragraph"),
    "section-header": ("TextRegion", "heading"),
    "caption": ("TextRegion", "caption"),
    "footnote": ("TextRegion", "footnote"),
    "page-header": ("TextRegion", "header"),
    "page-footer": ("TextRegion", "footer"),
    "list": ("TextRegion", "list-label"),
    "table-of-contents": ("TextRegion", "TOC-entry"),
    "bibliography": ("TextRegion", "other"),
    "form": ("TextRegion", "other"),
    "table": ("TableRegion", None),
    "image": ("ImageRegion", None),
    "figure": ("ImageRegion", None),
    "diagram": ("ImageRegion", None),
    "equation": ("MathsRegion", None),
    "code": ("TextRegion", "other"),
}

#: Types that span the page, types with a picture, and tags that sanitised inline HTML may hold.
SPANNING = ("page-header", "page-footer", "table-of-contents", "title")
VISUAL = ("figure", "image", "diagram")
INLINE_TAGS = ("b", "strong", "i", "em", "u", "sub", "sup", "br", "small", "s", "code", "span")
