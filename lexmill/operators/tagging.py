"""External taggers as child processes, their output read back by id, and offsets as XPaths."""

from __future__ import annotations

import re
import subprocess
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TAGGED = "stream_id string, sentence_id int, sentence_pos int, token_num int, token string, char_first long, char_length int, entity_type string, mention_type string, equiv_id int, mention_id int, gender string"
_TAG = re.compile(r"<(/?)(s|ENAMEX)\b([^>]*)>", re.I)
_ATTRIBUTE = re.compile(r'(\w+)="([^"]*)"')
TYPES = {"PERSON": "PER", "ORGANIZATION": "ORG", "LOCATION": "LOC", "MALE_PRONOUN": "PER", "FEMALE_PRONOUN": "PER"}
GENDERS = {"MALE_PRONOUN": "male", "FEMALE_PRONOUN": "female"}


def parse_tagged(stream_id: str, tagged: str) -> list[tuple]:
    """Tokens of text in which sentences are ``<s>`` and entities ``<ENAMEX ID TYPE>``; offsets are those of the bare text."""
    rows, at, offset, sentence, position, number = [], 0, 0, -1, 0, 0
    kind: str | None = None
    chain, mention = -1, -1

    def words(text: str) -> None:
        nonlocal position, number
        for m in re.finditer(r"\S+", text):
            rows.append((stream_id, max(sentence, 0), position, number, m[0], offset + m.start(), len(m[0]), TYPES.get(kind or "", kind), ("PRO" if kind in GENDERS else "NAME") if kind else None, chain if kind else -1, mention if kind else -1, GENDERS.get(kind or "")))
            position, number = position + 1, number + 1

    for m in _TAG.finditer(tagged):
        piece = tagged[at : m.start()]
        words(piece)
        offset, at = offset + len(piece), m.end()
        if m[2].lower() == "s":
            if not m[1]:
                sentence, position, mention = sentence + 1, 0, -1
        elif m[1]:
            kind = None
        else:
            found = dict(_ATTRIBUTE.findall(m[3]))
            kind, chain, mention = found.get("TYPE"), int(found.get("ID", -1)), mention + 1
    words(tagged[at:])
    return rows


class TaggerFailed(RuntimeError):
    pass


def run_tagger(items: DataFrame, command: list[str], timeout: float = 3600) -> DataFrame:
    """Tokens of ``clean_visible`` by an external program that maps tagged XML to tagged XML.

    Each batch goes through one process; documents come back by ``stream_id``,
    whatever their order. A killed process fails the task, which Spark repeats.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in TAGGED.split(", ")]
        for frame in frames:
            escape = lambda t: (t or "").replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;")
            sent = "".join(f'<FILENAME docid="{i}">{escape(t)}</FILENAME>\n' for i, t in zip(frame["stream_id"], frame["clean_visible"], strict=True))
            done = subprocess.run(command, input=sent, capture_output=True, text=True, timeout=timeout)
            if done.returncode:
                kind = "out of memory" if done.returncode in (137, -9) or "OutOfMemory" in done.stderr else f"status {done.returncode}"
                raise TaggerFailed(f"{command[0]}: {kind}: {done.stderr[-500:]}")
            rows = [r for i, body in re.findall(r'<FILENAME docid="([^"]*)">(.*?)</FILENAME>', done.stdout, re.S) for r in parse_tagged(i, body.replace("&lt;", "\x01").replace("&gt;", "\x02").replace("&amp;", "&").replace("\x01", "‹").replace("\x02", "›"))]
            yield pd.DataFrame(rows, columns=names)

    return items.select("stream_id", "clean_visible").mapInPandas(run, TAGGED)


class _Texts(HTMLParser):
    """Text nodes with their places in the source and XPaths."""

    VOID = {"br", "hr", "img", "input", "meta", "link", "base", "area", "col", "embed", "source", "wbr"}

    def __init__(self, source: str) -> None:
        super().__init__(convert_charrefs=False)
        self.starts = [0, *(m.end() for m in re.finditer("\n", source))]
        self.path: list[str] = []
        self.seen: list[dict[str, int]] = [{}]
        self.nodes: list[tuple[int, str, str]] = []

    def _at(self) -> int:
        line, column = self.getpos()
        return self.starts[line - 1] + column

    def _count(self, name: str) -> int:
        self.seen[-1][name] = self.seen[-1].get(name, 0) + 1
        return self.seen[-1][name]

    def handle_starttag(self, tag: str, attrs: list) -> None:
        n = self._count(tag)
        if tag not in self.VOID:
            self.path.append(f"{tag}[{n}]")
            self.seen.append({})

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self._count(tag)

    def handle_endtag(self, tag: str) -> None:
        if any(p.startswith(f"{tag}[") for p in self.path):
            while not self.path.pop().startswith(f"{tag}["):
                self.seen.pop()
            self.seen.pop()

    def handle_data(self, data: str) -> None:
        n = self._count("text()")
        self.nodes.append((self._at(), data, "/" + "/".join([*self.path, f"text()[{n}]"])))


def xpath_range(nodes: list[tuple[int, str, str]], first: int, length: int) -> tuple[str, int, str, int] | None:
    """``(xpath, offset, end xpath, end offset)`` of a range of characters, if both ends lie in text."""
    begin = next(((x, first - at) for at, t, x in nodes if at <= first < at + len(t)), None)
    end = next(((x, first + length - at) for at, t, x in nodes if at < first + length <= at + len(t)), None)
    return (*begin, *end) if begin and end else None


def text_nodes(html: str) -> list[tuple[int, str, str]]:
    parser = _Texts(html)
    parser.feed(html)
    parser.close()
    return parser.nodes


def xpath_slice(html: str, found: tuple[str, int, str, int]) -> str:
    """The text between two XPath places."""
    nodes = text_nodes(html)
    places = {x: k for k, (_, _, x) in enumerate(nodes)}
    a, b = places[found[0]], places[found[2]]
    texts = [t for _, t, _ in nodes[a : b + 1]]
    texts[-1] = texts[-1][: found[3]]
    return "".join([texts[0][found[1] :], *texts[1:]])


XPATHS = "stream_id string, token_num int, xpath string, xpath_offset int, xpath_end string, xpath_end_offset int"


def xpath_offsets(items: DataFrame, tokens: DataFrame) -> DataFrame:
    """XPath ranges of the tokens that have CHARS offsets in ``clean_html``; tokens that no text holds are left out."""
    spans = tokens.where("char_first is not null").groupBy("stream_id").agg(F.collect_list(F.struct("token_num", "char_first", "char_length")).alias("spans"))
    rows = items.select("stream_id", "clean_html").join(spans, "stream_id")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in XPATHS.split(", ")]
        for frame in frames:
            out = []
            for sid, page, marks in zip(frame["stream_id"], frame["clean_html"], frame["spans"], strict=True):
                nodes = text_nodes(page or "")
                for m in marks:
                    if found := xpath_range(nodes, int(m["char_first"]), int(m["char_length"])):
                        out.append((sid, int(m["token_num"]), *found))
            yield pd.DataFrame(out, columns=names)

    return rows.mapInPandas(run, XPATHS)
