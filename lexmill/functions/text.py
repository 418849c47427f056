"""Scalar text functions as Spark expressions."""

from __future__ import annotations

import string

from pyspark.sql import Column
from pyspark.sql import functions as F

EMAIL_TAG = r"<([\w-]+(?:\.[\w-]+)*@(?:[\w-]+\.)+[a-zA-Z0-9]{2,7})>"
SPACES = r"(?U)\s+"
#: Characters that XML 1.0 and a 16-bit plane can't hold.
INVALID = r"[^\t\r\n\x{20}-\x{D7FF}\x{E000}-\x{FFFD}]"


def fix_emails(text: Column) -> Column:
    """Escape the brackets of ``<user@host.tld>``, so that it is not taken for a tag."""
    return F.regexp_replace(text, EMAIL_TAG, "&lt;$1&gt;")


def blank_tags(html: Column) -> Column:
    """Every character of a tag becomes a space, but line feeds stay; an open tag reaches to the end."""
    parts = F.regexp_extract_all(html, F.lit(r"[^<]+|<[^>]*(?:>|$)"), F.lit(0))
    return F.array_join(F.transform(parts, lambda p: F.when(p.startswith("<"), F.regexp_replace(p, r"[^\n]", " ")).otherwise(p)), "")


def visible(html: Column) -> Column:
    """Visible text with the character offsets of the HTML, e-mail addresses in brackets aside."""
    return blank_tags(fix_emails(html))


def visible_from_regex(html: Column) -> Column:
    """Visible text where scripts, styles, comments and tags, line feeds included, become spaces of the same length."""
    hidden = r"(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<!--.*?-->|<[^>]*>"
    parts = F.regexp_extract_all(html, F.lit(rf"{hidden}|(?s)[^<]+|<"), F.lit(0))
    return F.array_join(F.transform(parts, lambda p: F.when(p.startswith("<") & (F.length(p) > 1), F.repeat(F.lit(" "), F.length(p))).otherwise(p)), "")


def cleanse(span: Column, lower: bool = True) -> Column:
    """Bracket codes and ASCII punctuation become spaces; spaces collapse; lower case unless told otherwise."""
    text = F.regexp_replace(span, "-[RL].B-", " ")
    text = F.translate(F.lower(text) if lower else text, string.punctuation, " " * len(string.punctuation))
    return F.trim(F.regexp_replace(text, SPACES, " "))


def cleansed_tokens(text: Column) -> Column:
    """Each white-space token of a text, cleansed as by ``cleanse``, in order; a token of marks alone gives an empty string.

    The text is cleansed as a whole. Line feeds part its tokens meanwhile, so
    that a token with marks inside stays one term of several words.
    """
    bare = F.btrim(text, F.lit(" \t\n\x0b\x0c\r"))
    parted = F.regexp_replace(F.regexp_replace(bare, r"[\x20\x09-\x0D]+", "\n"), "-[RL].B-", " ")
    parted = F.translate(F.lower(parted), string.punctuation, " " * len(string.punctuation))
    # the trim of ``cleanse`` takes spaces alone, and its collapse makes spaces of all white space
    parted = F.regexp_replace(F.regexp_replace(parted, r"(?U)[^\S\n]+", " "), " ?\n ?", "\n")
    return F.when(F.length(bare) > 0, F.split(F.trim(parted), "\n", -1)).otherwise(F.array().cast("array<string>"))


def drop_invalid(text: Column) -> Column:
    """Characters outside the basic plane, surrogates and most controls become spaces."""
    return F.regexp_replace(text, INVALID, " ")


def host(url: Column) -> Column:
    """Lower-case host without port and slashes; a string that is no URL is taken as a host itself."""
    found = F.coalesce(F.try_parse_url(url, F.lit("HOST")), url)
    return F.lower(F.regexp_replace(F.regexp_replace(found, ":[0-9]+$", ""), "/", ""))


def left_cuts(name: Column) -> Column:
    """``a.b.c`` gives ``[a.b.c, b.c, c]``."""
    parts = F.split(name, r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))


def title(html: Column, visible_text: Column, limit: int = 60) -> Column:
    """The ``title`` element, else the first 200 characters of the visible text; spaces collapse; long ones are cut."""
    element = F.regexp_extract(html, r"(?is)<title>(.*?)</title>", 1)
    chosen = F.when(F.coalesce(F.length(element), F.lit(0)) > 0, element).otherwise(F.substring(visible_text, 1, 200))
    chosen = F.trim(F.regexp_replace(chosen, SPACES, " "))
    cut = F.when(F.length(chosen) > limit, F.concat(F.substring(chosen, 1, limit), F.lit("..."))).otherwise(chosen)
    return F.when(F.length(visible_text) > 0, cut)


#: Words whose presence near the start marks HTML. They are sought without a bracket.
TAG_WORDS = ("html", "head", "title", "body", "meta", "link", "script", "table", "div", "span", "br", "href", "img")


def guess_media_type(raw: Column, media_type: Column, fallback: Column | None = None) -> Column:
    """Keep a known type; else judge by the start of the text; short texts stay unknown."""
    start = F.lower(F.substring(raw, 1, 400))
    tags = F.lit(False)
    for word in TAG_WORDS:
        tags = tags | start.contains(word)
    guess = (
        F.when(F.octet_length(raw) < 40, F.lit(None))
        .when(F.lower(F.substring(raw, 1, 250)).contains("doctype html") | tags, F.lit("text/html"))
        .when(F.lower(F.substring(raw, 1, 5)) == "%pdf-", F.lit("application/pdf"))
        .otherwise(fallback if fallback is not None else F.lit(None))
    )
    return F.when(F.length(media_type) > 0, media_type).otherwise(guess)


def file_kind(raw: Column, url: Column) -> Column:
    """A coarse kind of document: DOCTYPE, PROBABLY_HTML, XML, PDF, or unknown by extension or bytes."""
    start = F.lower(F.trim(F.substring(raw, 1, 400)))
    tags = F.lit(False)
    for word in TAG_WORDS:
        tags = tags | start.contains(f"<{word}")
    extension = F.lower(F.regexp_extract(url, r"\.([A-Za-z0-9]{1,5})$", 1))
    return (
        F.when(start.startswith("<!doctype html"), "DOCTYPE")
        .when(start.startswith("<?xml"), "XML")
        .when(start.startswith("%pdf-"), "PDF")
        .when(tags, "PROBABLY_HTML")
        .when(F.length(extension) > 0, F.concat(F.lit("UNK ext "), extension))
        .otherwise(F.concat(F.lit("UNK bytes "), F.hex(F.substring(raw, 1, 4))))
    )


def doc_id(url: Column) -> Column:
    return F.md5(url)


def stream_id(epoch_ticks: Column, doc: Column) -> Column:
    return F.concat_ws("-", F.floor(epoch_ticks).cast("string"), doc)


def split_stream_id(value: Column) -> Column:
    """``(epoch_ticks, doc_id)`` of a stream id; times before 1970 have a leading minus; malformed ids raise."""
    good = value.rlike(r"^-?[0-9]+-[0-9a-fA-F]+$")
    ticks = F.regexp_extract(value, r"^(-?[0-9]+)-", 1)
    parsed = F.struct(ticks.try_cast("long").alias("epoch_ticks"), F.regexp_extract(value, r"-([0-9a-fA-F]+)$", 1).alias("doc_id"))
    return F.when(good, parsed).otherwise(F.raise_error(F.concat(F.lit("malformed stream id: "), F.coalesce(value, F.lit("null")))))


def store_key(doc: Column, epoch_ticks: Column) -> Column:
    """The 20-byte ordered key: 16 bytes of the document, 4 bytes big-endian of the time."""
    seconds = F.lpad(F.hex(F.call_function("shiftrightunsigned", F.call_function("shiftleft", epoch_ticks.cast("long"), F.lit(32)), F.lit(32))), 8, "0")
    return F.unhex(F.concat(doc, seconds))


def date_hour(time: Column) -> Column:
    return F.date_format(time, "yyyy-MM-dd-HH")
