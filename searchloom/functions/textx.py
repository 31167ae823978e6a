"""Text helpers: blankness, extensions, byte-exact cuts, markup removal, tokens."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from searchloom.contract import DEFAULT_MIME, MIME_TYPES

BLANK = r"^[\s\p{Z}]*$"
WORDS = r"[\p{IsHan}]+|[\p{L}\p{N}&&[^\p{IsHan}]]+"


def trimmed(text: Column) -> Column:
    """Without Unicode spaces at either end."""
    return F.regexp_replace(text, r"^[\s\x{85}\p{Z}]+|[\s\x{85}\p{Z}]+$", "")


def is_blank(text: Column) -> Column:
    """Empty or only Unicode spaces."""
    return text.rlike(BLANK)


def extension_name_first(extension: Column, name: Column) -> Column:
    """Lower-case extension of the name (no dotfile, no trailing dot), else the given one."""
    from_name = F.regexp_extract(F.coalesce(name, F.lit("")), r"(?s)^.+\.([^.]+)$", 1)
    return F.lower(F.coalesce(F.nullif(from_name, F.lit("")), extension, F.lit("")))


def extension_field_first(extension: Column, name: Column) -> Column:
    """Lower-case extension with its dot: the given one, else the one of the name."""
    given = F.lower(trimmed(F.coalesce(extension, F.lit(""))))
    of_name = F.lower(F.regexp_extract(F.coalesce(name, F.lit("")), r"(\.[^./]*)$", 1))
    ext = F.when(given != "", given).otherwise(of_name)
    return F.when((ext == "") | ext.startswith("."), ext).otherwise(F.concat(F.lit("."), ext))


def mime_type(ext: Column) -> Column:
    """MIME type of an extension given with or without its dot."""
    e = F.lower(trimmed(F.coalesce(ext, F.lit(""))))
    dotted = F.when((e == "") | e.startswith("."), e).otherwise(F.concat(F.lit("."), e))
    pairs = [F.lit(x) for kv in MIME_TYPES.items() for x in kv]
    return F.coalesce(F.element_at(F.create_map(*pairs), dotted), F.lit(DEFAULT_MIME))


def cut_utf8(text: Column, limit: int) -> Column:
    """The longest prefix of at most ``limit`` bytes that ends on a character."""
    data = text.cast("binary")
    cuts = [
        F.try_validate_utf8(F.substring(data, 1, limit - back).cast("string"))
        for back in range(min(4, limit + 1))
    ]
    return F.when(F.octet_length(text) <= limit, text).otherwise(F.coalesce(*cuts))


def html_text(html: Column) -> Column:
    """Visible text of a page: no head, scripts, styles or comments; blocks end lines."""
    t = F.regexp_replace(html, r"(?s)<!--.*?-->", " ")
    for tag in HIDDEN_TAGS:
        t = F.regexp_replace(t, rf"(?is)<{tag}\b[^>]*>.*?</{tag}\s*>", " ")
    t = F.regexp_replace(t, r"(?i)<(br|hr|/p|/div|/li|/ul|/ol|/tr|/table|/h[1-6]|/section|/article|/nav|/header|/footer|/blockquote|/pre)\b[^>]*>", "\n")
    t = F.regexp_replace(t, r"<[^>]+>", "")
    for name, char in HTML_ENTITIES:
        t = F.replace(t, F.lit(name), F.lit(char))
    t = F.regexp_replace(t, r"[ \t\r\x{A0}]+", " ")
    t = F.regexp_replace(t, r" ?\n[ \n]*", "\n")
    return F.trim(t, F.lit(" \n"))


# a head may hold the others, so it goes last
HIDDEN_TAGS = ["script", "style", "noscript", "head"]

# fixed values: named characters of pages; the ampersand goes last
HTML_ENTITIES = [
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&quot;", '"'),
    ("&#39;", "'"),
    ("&apos;", "'"),
    ("&nbsp;", " "),
    ("&middot;", "·"),
    ("&copy;", "©"),
    ("&reg;", "®"),
    ("&hellip;", "…"),
    ("&ndash;", "–"),
    ("&mdash;", "—"),
    ("&laquo;", "«"),
    ("&raquo;", "»"),
    ("&amp;", "&"),
]


def tokens(text: Column) -> Column:
    """Lower-case words; runs of Han characters become overlapping pairs."""
    runs = F.regexp_extract_all(F.lower(text), F.lit(WORDS), F.lit(0))
    pairs = F.transform(
        runs,
        lambda run: F.when(
            run.rlike(r"^\p{IsHan}{2,}$"),
            F.transform(F.sequence(F.lit(1), F.length(run) - 1), lambda i: F.substr(run, i, F.lit(2))),
        ).otherwise(F.array(run)),
    )
    return F.flatten(pairs)
