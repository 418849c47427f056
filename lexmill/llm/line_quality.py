"""Line-first quality rules: clean by line, then judge what is left. DataFrame operations only."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.llm.common import WS, words

#: A line with one of these is boilerplate.
BOILERPLATE = (
    r"(?i)(all rights reserved|terms of (use|service)|privacy policy|cookie(s| policy)|enable javascript|lorem ipsum"
    r"|(log|sign) in|sign up|subscribe|newsletter|read more|click here|back to top|skip to (main )?content|share (this|on)"
    r"|follow us|powered by|copyright|licensed under|released under the)"
)
#: Every match of ``BOILERPLATE`` holds one of these in lower case; a plain search for them spares most lines the pattern.
HINTS = (
    "rights reserved", "terms of ", "privacy policy", "cookie", "enable javascript", "lorem ipsum", "log in", "sign in", "sign up", "subscribe", "newsletter",
    "read more", "click here", "back to top", "skip to ", "share ", "follow us", "powered by", "copyright", "licensed under", "released under",
)
#: Marks between the entries of a menu.
NAVIGATION = r"[|\x{bb}\x{2022}\x{b7}>]"
#: A line of prose ends with one of these, quotes and brackets aside.
END = r"[.!?:;\x{2026}\x{3002}][\x22\x27\x{201d}\x{2019}\x{bb})\]]*[\x20\x09-\x0D]*$"


@dataclass(frozen=True)
class LineRules:
    """Limits of the rules; shares are of the words of a line or text."""

    #: A line of at most this many words without an end mark fails the punctuation rule.
    short_line: int = 4
    #: A line fails it too when this many of its marks ``!?#*$%&<>`` come per word.
    marks_per_word: float = 0.8
    #: Menu marks per word from which a line is navigation, and their least number.
    menu_per_word: float = 0.25
    menu_least: int = 3
    #: A text is rejected when its lines that pass hold less than this share of its words.
    least_left: float = 0.5
    min_words: int = 50


def _count(text: Column, pattern: str) -> Column:
    return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))


def line_passes(line: Column, rules: LineRules = LineRules()) -> Column:
    """Whether one line, with at least a word, passes the rules for punctuation, navigation and boilerplate."""
    n = F.size(words(line))
    ends = line.rlike(END)
    # Words are counted only where marks make it necessary.
    longer = line.rlike(rf"^[\x20\x09-\x0D]*+(?:[^\x20\x09-\x0D]++[\x20\x09-\x0D]++){{{rules.short_line}}}[^\x20\x09-\x0D]")
    bound = lambda pattern, test: F.transform(F.array(_count(line, pattern)), test)[0]
    few_marks = bound(r"[!?#*$%&<>]", lambda k: (F.lit(rules.marks_per_word > 0) & (k == 0)) | (k < F.lit(rules.marks_per_word) * n))
    navigation = bound(NAVIGATION, lambda k: (k >= rules.menu_least) & (k >= F.lit(rules.menu_per_word) * n))
    hinted = F.transform(F.array(F.lower(line)), lambda low: reduce(or_, [F.contains(low, F.lit(h)) for h in HINTS]))[0]
    return (ends | longer) & few_marks & ~navigation & ~(hinted & line.rlike(BOILERPLATE))


def repeated_window_words(word: Column) -> Column:
    """Words covered by 3-word windows that occur twice or more in the array ``word``.

    Windows are sorted with their positions, so the cost is that of one sort of
    the text's own windows. Equal windows are found by a 64-bit hash.
    """
    # Arrays are bound with transform(array(x), ...)[0], so each is computed once.
    window = F.transform(F.sequence(F.lit(0), F.size(word) - 3), lambda i: F.struct(F.xxhash64(word[i], word[i + 1], word[i + 2]).alias("h"), i.alias("p")))

    def covered(sorted_windows: Column) -> Column:
        last = F.size(sorted_windows) - 1
        twin = F.filter(
            sorted_windows,
            lambda x, i: ((i > 0) & (sorted_windows[F.greatest(i - 1, F.lit(0))]["h"] == x["h"])) | ((i < last) & (sorted_windows[F.least(i + 1, last)]["h"] == x["h"])),
        )
        at = F.sort_array(F.transform(twin, lambda x: x["p"]))
        return F.aggregate(
            at,
            F.struct(F.lit(0).cast("long").alias("n"), F.lit(-3).alias("end")),
            lambda s, p: F.struct((s["n"] + 3 - F.greatest(s["end"] - p, F.lit(0))).alias("n"), (p + 3).alias("end")),
            lambda s: s["n"],
        )

    return F.when(F.size(word) < 4, F.lit(0).cast("long")).otherwise(F.transform(F.array(F.sort_array(window)), covered)[0])


def judge(docs: DataFrame, rules: LineRules = LineRules()) -> DataFrame:
    """One row per document with counts, the cleaned text and the verdict.

    Columns: ``doc_id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, kept, n_left_words, clean_text``. Lines that
    fail a rule, and lines that repeat an earlier line of the text, are left
    out of ``clean_text``; a document is kept if it passes the base rules and
    its remaining lines hold ``least_left`` of its words. No row is dropped or
    moved: the work is one projection over the scan.

    Null and blank texts have no words and fail the base rules. Repeated rows
    are judged one by one; other columns are ignored.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    base = docs.select("doc_id", text.alias("text"), words(F.col("text")).alias("word"), F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("line"))
    lines = F.array_distinct("line")
    passing = F.filter(lines, lambda x: line_passes(x, rules))
    counted = base.select(
        "doc_id",
        F.size("word").cast("long").alias("n_words"),
        F.length(F.regexp_replace("text", WS, "")).cast("long").alias("word_chars"),
        _count(F.col("text"), r"[#*$%&|<>]").cast("long").alias("n_symbols"),
        (F.size("line") - F.size(lines)).cast("long").alias("n_dup_lines"),
        repeated_window_words(F.col("word")).alias("n_repeat_words"),
        F.array_join(passing, "\n").alias("clean_text"),
    )
    failed = (F.col("n_words") < rules.min_words) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    left = F.size(words(F.col("clean_text"))).cast("long")
    return (
        counted.withColumn("base_failed", failed)
        .withColumn("n_left_words", left)
        .withColumn("kept", ~F.col("base_failed") & (F.col("n_left_words") >= F.lit(rules.least_left) * F.col("n_words")))
        .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_left_words", "clean_text")
    )
