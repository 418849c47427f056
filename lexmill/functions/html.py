"""HTML and document text that expressions cannot handle: standard-library parsers in Arrow-batched UDFs."""

from __future__ import annotations

import html
import io
import re
import zipfile
from html.parser import HTMLParser
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from lexmill.functions.text import EMAIL_TAG

DROPPED = {"script", "style", "base", "link", "noscript", "iframe", "object", "embed"}
VOID = {"br", "hr", "img", "input", "meta", "area", "col", "source", "wbr", "link", "base", "embed"}
BLOCK = {"p", "div", "table", "tr", "ul", "ol", "li", "h1", "h2", "h3", "h4", "h5", "h6", "head", "body", "html", "title", "section", "article", "pre", "blockquote"}
_EMAIL = re.compile(EMAIL_TAG)
_BAD = re.compile("[^\\t\\n\\r\\x20-\\ud7ff\\ue000-\\ufffd]")


class _Cleaner(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.out: list[str] = []
        self.open: list[str] = []
        self.muted = 0

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in DROPPED:
            self.muted += tag not in VOID
            return
        if self.muted:
            return
        kept = "".join(f' {k}="{html.escape(v or "")}"' for k, v in attrs if k not in ("class", "id") and not k.startswith("on"))
        self.out.append(("\n" if tag in BLOCK and self.out else "") + f"<{tag}{kept}>")
        if tag not in VOID:
            self.open.append(tag)

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag not in DROPPED:
            self.handle_endtag(tag)
        elif tag in DROPPED and tag not in VOID:
            self.muted = max(0, self.muted - 1)

    def handle_endtag(self, tag: str) -> None:
        if tag in DROPPED:
            self.muted = max(0, self.muted - (tag not in VOID))
        elif not self.muted and tag in self.open:
            while self.open:
                last = self.open.pop()
                self.out.append(f"</{last}>")
                if last == tag:
                    break

    def handle_data(self, data: str) -> None:
        if not self.muted:
            self.out.append(html.escape(data, quote=False))

    def close(self) -> None:
        super().close()
        self.out += [f"</{t}>" for t in reversed(self.open)]
        self.open = []


def decode(raw: bytes, encoding: str | None, media_type: str | None) -> str:
    """Text by the stated encoding, the charset of the media type, UTF-8, or Latin-1, whichever fits first."""
    charset = re.search(r"charset=[\"']?([\w-]+)", media_type or "", re.I)
    for name in (encoding, charset and charset[1], "utf-8"):
        try:
            if name:
                return raw.decode(name)
        except (UnicodeDecodeError, LookupError):
            pass
    return raw.decode("latin-1")


def cleaned(text: str) -> str:
    """HTML without scripts, styles, comments, links, classes and ids, with quoted attributes and closed tags."""
    parser = _Cleaner()
    parser.feed(_BAD.sub(" ", _EMAIL.sub(r"&lt;\1&gt;", text).replace("\r", " ")))
    parser.close()
    return "".join(parser.out)


@F.pandas_udf(StringType())
def clean_html_udf(raw: pd.Series, encoding: pd.Series, media_type: pd.Series) -> pd.Series:
    return pd.Series([None if r is None else cleaned(decode(bytes(r), e, m)) for r, e, m in zip(raw, encoding, media_type, strict=True)], dtype=object)


_INVISIBLE = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style)\b(?:\"[^\"]*\"|'[^']*'|[^'\">])*>.*?(?:</\1\s*>|\Z)|<(?:\"[^\"]*\"|'[^']*'|[^'\">])*(?:>|\Z)",
    re.S | re.I,
)


def visible_from_raw(text: str) -> str:
    """Blank comments, scripts, styles and tags (with ``>`` inside quotes) by spaces; line feeds stay."""
    text = _EMAIL.sub(r"&lt;\1&gt;", text)
    return _INVISIBLE.sub(lambda m: re.sub(r"[^\n]", " ", m[0]), text)


@F.pandas_udf(StringType())
def visible_from_raw_udf(raw: pd.Series) -> pd.Series:
    return raw.map(visible_from_raw, na_action="ignore")


_CURLY = str.maketrans({"\u2018": "'", "\u2019": "'", "\u201a": "'", "\u201b": "'", "\u201c": '"', "\u201d": '"', "\u201e": '"', "\ufb01": "fi", "\ufb02": "fl", "\ufb00": "ff", "\ufeff": ""})
_CODES = ("windows-1252", "latin-1")


def fix_text(text: str) -> str:
    """Undo UTF-8 read as a Latin encoding, straighten quotes and ligatures, end lines with line feeds."""
    for _ in range(2):
        for code in _CODES:
            try:
                again = text.encode(code).decode("utf-8")
            except (UnicodeEncodeError, UnicodeDecodeError):
                continue
            if again != text:
                text = again
            break
    return text.translate(_CURLY).replace("\r\n", "\n").replace("\r", "\n")


@F.pandas_udf(StringType())
def fix_text_udf(text: pd.Series) -> pd.Series:
    return text.map(fix_text, na_action="ignore")


_ENTITY = re.compile(r"&(#\d+|#[xX][0-9a-fA-F]+|\w+);")


def entities_to_unicode(text: str, space_padding: bool = False, safe_only: bool = False) -> str:
    """Decode entities. With padding, spaces on both sides keep the length; ``safe_only`` leaves markup characters coded."""

    def one(m: re.Match) -> str:
        char = html.unescape(m[0])
        if char == m[0] or (safe_only and char in "<>&\"'"):
            return m[0]
        if not space_padding:
            return char
        spare = len(m[0]) - len(char)
        return " " * (spare // 2) + char + " " * (spare - spare // 2)

    return _ENTITY.sub(one, text)


def unicode_to_entities(text: str) -> str:
    return "".join(c if ord(c) < 128 else f"&#{ord(c)};" for c in html.escape(text))


def word_text(raw: bytes) -> str | None:
    """Paragraphs of a Word file, or nothing if it can't be read."""
    try:
        with zipfile.ZipFile(io.BytesIO(raw)) as z:
            root = ElementTree.fromstring(z.read("word/document.xml"))
    except (zipfile.BadZipFile, KeyError, ElementTree.ParseError):
        return None
    space = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
    return "\n".join("".join(t.text or "" for t in p.iter(f"{space}t")) for p in root.iter(f"{space}p"))


#: Readers of document bytes by media type; a PDF reader can be added where a library is at hand.
READERS = {"application/msword": word_text, "application/vnd.openxmlformats-officedocument.wordprocessingml.document": word_text}


@F.pandas_udf(StringType())
def document_text_udf(raw: pd.Series, media_type: pd.Series) -> pd.Series:
    return pd.Series([READERS[m](bytes(r)) if r is not None and m in READERS else None for r, m in zip(raw, media_type, strict=True)], dtype=object)
