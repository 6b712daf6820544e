"""Text functions. Everything here is a JVM-side Column expression."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Markup cleaning passes, applied in this order (pattern, replacement).
CLEANING_PASSES = [
    (r"(?m)^---[\s\S]+?---", ""),
    (r"<[A-Za-z0-9_]+[^>]*>[\s\S]*?</[A-Za-z0-9_]+>", ""),
    (r"<[^>]+/>", ""),
    (r":::python", "```python"),
    (r":::js", "```javascript"),
    (r":::", "```"),
    (r"<[^>]+>", ""),
]

# File extension -> language tag.
LANGUAGE_OF_EXTENSION = {".py": "python", ".rs": "rust"}

FENCE = "```"


def strip_ws(c: Column) -> Column:
    """Remove all leading and trailing white space, not only spaces."""
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def clean_markup(c: Column) -> Column:
    """Front matter, components, tags and `:::` fences to plain markdown."""
    for pattern, replacement in CLEANING_PASSES:
        c = F.regexp_replace(c, pattern, replacement)
    return strip_ws(c)


def clean_by_type(text: Column, filetype: Column) -> Column:
    return F.when(filetype == "mdx", clean_markup(text)).otherwise(text)


def file_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def file_type(path: Column) -> Column:
    return F.when(path.endswith(".mdx"), "mdx").otherwise("md")


def relative_path(path: Column, root: Column) -> Column:
    """`path` below `root`; unchanged if it lies elsewhere."""
    below = F.regexp_replace(path.substr(F.length(root) + 1, F.length(path)), "^/+", "")
    return F.when(path.startswith(root), below).otherwise(path)


def language_tag(path: Column) -> Column:
    """Language from the extension; NULL for every other extension."""
    out = None
    for ext, lang in LANGUAGE_OF_EXTENSION.items():
        cond = path.endswith(ext)
        out = F.when(cond, lang) if out is None else out.when(cond, lang)
    return out


def word_count(c: Column) -> Column:
    return F.regexp_count(c, F.lit(r"\S+")).cast("long")


def words(c: Column) -> Column:
    return F.regexp_extract_all(c, F.lit(r"\S+"), F.lit(0))


def preview(c: Column, n: int, always: bool = False) -> Column:
    """First `n` characters and `...`, the dots always or only when something was cut."""
    head = c.substr(1, n)
    dotted = F.concat(head, F.lit("..."))
    return dotted if always else F.when(F.length(c) > n, dotted).otherwise(c)


def fenced_json(c: Column) -> Column:
    """Text after the last json fence up to the next fence; whole text if there is none."""
    return F.substring_index(F.substring_index(c, FENCE + "json", -1), FENCE, 1)


def verdict_field(c: Column, field: str) -> Column:
    """Top-level field of a JSON verdict, fenced or not; NULL when malformed."""
    return F.variant_get(F.try_parse_json(fenced_json(c)), f"$.{field}", "string")


def is_yes(c: Column) -> Column:
    return F.coalesce(F.lower(F.trim(c)) == "yes", F.lit(False))


def metadata_json(**fields: Column) -> Column:
    return F.to_json(F.struct(*[v.alias(k) for k, v in fields.items()]), {"ignoreNullFields": "false"})


def render(template: str, **values: Column) -> Column:
    """Fill `{name}` placeholders once; braces inside the values stay untouched."""
    parts = re.split(r"\{(\w+)\}", template)
    cols = [values[p] if i % 2 else F.lit(p) for i, p in enumerate(parts) if i % 2 or p]
    return F.concat(*cols)


def sentences(c: Column) -> Column:
    """Non-empty stretches that end with a full stop, the stop included.

    Splitting is linear; a regular expression for the same stretches retries from every
    position of a text without a full stop.
    """
    parts = F.split(c, "[.]", -1)
    closed = F.slice(parts, 1, F.size(parts) - 1)
    return F.transform(F.filter(closed, lambda p: p != ""), lambda p: F.concat(p, F.lit(".")))


def first_sentences(c: Column, n: int = 3) -> Column:
    """The first `n` sentences, joined as they stand, without reading on behind them."""
    head = F.regexp_extract(c, r"^(?:[.]*[^.]+[.]){1,%d}" % n, 0)
    return strip_ws(F.regexp_replace(F.regexp_replace(head, "[.]+", "."), "^[.]", ""))


def first_sentence(c: Column) -> Column:
    """The first sentence as it stands; empty if there is none."""
    return F.regexp_extract(c, r"^[.]*([^.]+[.])", 1)


def distinct_prefix(c: Column, n: int = 3) -> Column:
    """First `n` distinct entries of an array, in order."""
    return F.slice(F.array_distinct(F.array_compact(c)), 1, n)


def role_label(role: Column) -> Column:
    return F.when(role == "user", "User").otherwise("AI")


def or_default(c: Column, default: str = "No results found") -> Column:
    """Stripped inference result, or the default when it is missing or empty."""
    return F.coalesce(F.nullif(strip_ws(c), F.lit("")), F.lit(default))


def inference_text(result: Column, error: Column, default: str = "No results found") -> Column:
    """Result, default or `Error: ...`, in the order failure, empty, value."""
    return F.when(error.isNotNull(), F.concat(F.lit("Error: "), error)).otherwise(or_default(result, default))


def thread_key(text: Column) -> Column:
    """Stable thread id from a text."""
    return F.concat(F.lit("test_"), F.md5(text))


def present(c: Column) -> Column:
    """Neither NULL nor empty."""
    return c.isNotNull() & (F.length(c) > 0)
