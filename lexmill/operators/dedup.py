"""Duplicates among snapshots of a page, by digest across pages, and by text profile."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.functions import hamming, hashes
from lexmill.functions import text as T
from lexmill.sinks.workspace import Workspace, bounded_arrow_batches


@dataclass(frozen=True)
class DedupRule:
    """Limits of the same-page comparison; ratios in thousandths, similarity up to 128."""

    use_nilsimsa: bool = True
    exactness: int = 128
    min_clean_length: int = 500
    clean_thousandths: int = 850
    raw_thousandths: int = 850
    require_same_doc_id: bool = False
    content_form: str = "clean_visible"


def thousandths(a: int, b: int) -> float:
    return 1000.0 * (1 - abs(a - b) / max(a, b)) if max(a, b) else 1000.0


def is_repeat(kept: tuple, new: tuple, rule: DedupRule) -> bool:
    """Whether an item repeats the kept one of its page. Both are (digest, clean bytes, raw bytes)."""
    digest_a, clean_a, raw_a = kept
    digest_b, clean_b, raw_b = new
    if not clean_a or not clean_b:
        return (not raw_a and not raw_b) or thousandths(raw_a, raw_b) >= rule.raw_thousandths
    if not rule.use_nilsimsa:
        return thousandths(clean_a, clean_b) >= rule.clean_thousandths
    near = hashes.similarity(digest_a, digest_b) >= rule.exactness
    return near and clean_b >= rule.min_clean_length and thousandths(clean_a, clean_b) >= rule.clean_thousandths


def measured(items: DataFrame, rule: DedupRule) -> DataFrame:
    """``stream_id, doc_id, epoch_ticks, digest, n_clean, n_raw``: all that the comparison needs, without texts.

    The content is digested as it stands.
    """
    clean = F.coalesce(F.col(rule.content_form), F.lit(""))
    bounded_arrow_batches(items.sparkSession)
    digest = hashes.nilsimsa_udf(clean) if rule.use_nilsimsa else F.lit("0" * 64)
    raw = F.octet_length("raw") if "raw" in items.columns else F.lit(0)
    return items.select("stream_id", "doc_id", "epoch_ticks", digest.alias("digest"), F.octet_length(clean).cast("long").alias("n_clean"), F.coalesce(raw, F.lit(0)).cast("long").alias("n_raw"))


def same_page(rows: DataFrame, rule: DedupRule = DedupRule()) -> DataFrame:
    """``stream_id, kept`` of measured rows: an ordered fold over the snapshots of each page.

    A kept snapshot replaces the one compared with. Snapshots are sorted by the
    shuffle and pass one by one, so a page of any length needs no more memory
    than one batch.
    """
    ordered = rows.repartition("doc_id").sortWithinPartitions("doc_id", "epoch_ticks", "stream_id")

    def fold(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        page, last = object(), None
        for frame in frames:
            kept = []
            for doc, digest, clean, raw in zip(frame["doc_id"], frame["digest"], frame["n_clean"], frame["n_raw"], strict=True):
                new = (bytes.fromhex(digest), int(clean), int(raw))
                keep = doc != page or not is_repeat(last, new, rule)
                if keep:
                    page, last = doc, new
                kept.append(keep)
            yield pd.DataFrame({"stream_id": frame["stream_id"], "kept": kept})

    return ordered.mapInPandas(fold, "stream_id string, kept boolean")


#: Digests that one task holds at most, in two blocks of half as many.
BLOCK_ROWS = 4_000_000


def digest_bands(rows: DataFrame, exactness: int, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Pairs of rows of similarity ``exactness`` or more, by bands of the digest. Equal digests are one row here.

    Digests that differ in at most r bits agree in two of r + 2 bands. Distinct
    digests are written once; a task reads all of them, or of many two blocks,
    and sorts them by one pair of bands after the other, so neither keys nor
    candidates are shuffled, and a pair that several pairs of bands find comes
    once.
    """
    differ = 128 - exactness
    ws = Workspace(rows.sparkSession, "digests")
    ws.table(rows.where("n_clean > 0").select(F.unhex("digest").alias("digest")).distinct(), "distinct", maxRecordsPerFile=str(max(1, block_rows // 8)))
    store, folder = fs.FileSystem.from_uri(f"{ws.root}/distinct")
    blocks, held, total = [[]], 0, 0
    for file in sorted(f.path for f in store.get_file_info(fs.FileSelector(folder)) if f.path.endswith(".parquet")):
        n = pq.read_metadata(file, filesystem=store).num_rows
        if held and held + n > block_rows // 2:
            blocks, held = [*blocks, []], 0
        blocks[-1].append(file)
        held, total = held + n, total + n
    joined = list(combinations(range(len(blocks)), 2)) or [(0, 0)]
    # the largest pair of bands may have a tenth of the candidates
    parts = max(1, min(total, block_rows) // 250_000)
    work = [(*pair, list(chosen), part) for pair in joined for chosen in hamming.choices(differ) for part in range(parts)]
    tasks = max(1, min(len(work), max(2 * rows.sparkSession.sparkContext.defaultParallelism, 24 * len(joined))))
    url, last = f"{ws.root}/distinct", len(blocks) - 1

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loaded = None
        for batch in batches:
            for item in batch.to_pylist():
                a, b = item["a"], item["b"]
                if loaded != (a, b):
                    store, _ = fs.FileSystem.from_uri(url)
                    read = lambda k, store=store: hamming.digests(pa.concat_arrays([pa.array([], pa.binary()), *(c for f in blocks[k] for c in pq.read_table(f, filesystem=store)["digest"].chunks)]))
                    held = [read(k) for k in sorted({a, b})]
                    digests, border = np.concatenate(held), len(held[0])
                    bands = hamming.banded(digests, differ) if item["chosen"] else None
                    loaded = (a, b)
                for i, j, d in hamming.near(digests, bands, tuple(item["chosen"]), differ, item["part"], parts):
                    if last > 1:
                        # pairs inside a block are of one of its pairs of blocks
                        own = np.where((i < border) != (j < border), True, np.where(i < border, b == a + 1, (a, b) == (last - 1, last)))
                        i, j, d = i[own], j[own], d[own]
                    for k in range(0, len(i), 50_000):
                        u, v = digests[i[k : k + 50_000]], digests[j[k : k + 50_000]]
                        unlike = np.argmax(u != v, axis=1)[:, None]
                        less = np.take_along_axis(u, unlike, 1) < np.take_along_axis(v, unlike, 1)
                        low, high = np.where(less, u, v), np.where(less, v, u)
                        yield pa.RecordBatch.from_arrays([hamming.hexadecimal(low), hamming.hexadecimal(high), pa.array(128 - d[k : k + 50_000], pa.int32())], names=["a", "b", "similarity"])

    listed = rows.sparkSession.createDataFrame([(k % tasks, *w) for k, w in enumerate(work)], "task int, a int, b int, chosen array<int>, part int")
    return listed.repartitionByRange(tasks, "task").sortWithinPartitions("task", "a", "b").mapInArrow(compare, "a string, b string, similarity int")


def same_digest(rows: DataFrame) -> DataFrame:
    """``stream_id, kept``: of rows with equal digests of some text, the earliest is kept. Grouped before it is joined; digests are made once and written."""
    rows = Workspace(rows.sparkSession, "same").table(rows, "measured")
    first = rows.where("n_clean > 0").groupBy("digest").agg(F.min(F.struct("epoch_ticks", "stream_id")).alias("first"))
    return rows.join(first, "digest", "left").select("stream_id", F.coalesce((F.col("n_clean") == 0) | (F.col("stream_id") == F.col("first.stream_id")), F.lit(True)).alias("kept"))


def _groups(ws: Workspace, edges: DataFrame, rounds: int = 100) -> DataFrame:
    """``doc_id, root`` of the pages that edges ``u, v`` join: the least page that each one reaches, by doubling steps."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct()
    both = ws.table(both, "edges")
    labels = ws.table(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("root")), "labels0")
    for k in range(1, rounds):
        near = both.join(labels.select(F.col("u").alias("v"), F.col("root").alias("r")), "v").groupBy("u").agg(F.min("r").alias("r"))
        step = labels.join(near, "u").select("u", F.least("root", "r").alias("root"), F.col("root").alias("old"))
        above = step.select(F.col("u").alias("root"), F.col("root").alias("top"))
        step = ws.table(step.join(above, "root", "left").select("u", F.least("root", F.coalesce("top", "root")).alias("root"), "old"), f"labels{k}")
        changed = step.where("root <> old").limit(1).count()
        labels = step.drop("old")
        if not changed:
            return labels.select(F.col("u").alias("doc_id"), "root")
    raise RuntimeError(f"groups of pages still change after {rounds} rounds")


def across_pages(rows: DataFrame, rule: DedupRule = DedupRule()) -> DataFrame:
    """``stream_id, kept`` of measured rows: each is compared with the kept one of its page, then with those of all other pages.

    Only a kept row is compared with later; it takes the place of its page's
    kept one. Pages that never have digests of similarity ``exactness`` can't
    meet, so pages are grouped by such digests (equal ones, or found by bands)
    and each group is one ordered fold, sorted by the shuffle; its state is one
    row for each page of the group.
    """
    ws = Workspace(rows.sparkSession, "dedup")
    rows = ws.table(rows, "measured")
    some = rows.where("n_clean > 0")
    least = some.groupBy("digest").agg(F.min("doc_id").alias("u"))
    edges = some.join(least, "digest").select("u", F.col("doc_id").alias("v"))
    if rule.exactness < 128:
        pairs = digest_bands(rows, rule.exactness)
        of = lambda x: least.select(F.col("digest").alias(x), F.col("u").alias(f"d{x}"))
        edges = edges.unionByName(pairs.join(of("a"), "a").join(of("b"), "b").select(F.col("da").alias("u"), F.col("db").alias("v")))
    groups = _groups(ws, edges.where("u <> v"))
    placed = rows.join(groups, "doc_id", "left").withColumn("root", F.coalesce("root", "doc_id"))
    ordered = placed.repartition("root").sortWithinPartitions("root", "epoch_ticks", "stream_id")

    def fold(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        group, pages, digests = object(), {}, Counter()
        for frame in frames:
            kept = []
            for root, doc, digest, clean, raw in zip(frame["root"], frame["doc_id"], frame["digest"], frame["n_clean"], frame["n_raw"], strict=True):
                if root != group:
                    group, pages, digests = root, {}, Counter()
                new = (bytes.fromhex(digest), int(clean), int(raw))
                keep = doc not in pages or not is_repeat(pages[doc], new, rule)
                if keep and clean:
                    keep = not digests[new[0]] if rule.exactness >= 128 else all(hashes.similarity(new[0], d) < rule.exactness for d in digests)
                if keep:
                    if doc in pages:
                        digests -= Counter([pages[doc][0]])
                    pages[doc] = new
                    digests[new[0]] += 1
                kept.append(keep)
            yield pd.DataFrame({"stream_id": frame["stream_id"], "kept": kept})

    return ordered.mapInPandas(fold, "stream_id string, kept boolean")


def dedup(items: DataFrame, rule: DedupRule = DedupRule()) -> DataFrame:
    """Items that repeat neither an earlier snapshot of their page nor, unless ``require_same_doc_id``, the kept one of another page."""
    rows = measured(items, rule)
    kept = across_pages(rows, rule) if rule.use_nilsimsa and not rule.require_same_doc_id else same_page(rows, rule)
    return items.join(kept.where("kept").select("stream_id"), "stream_id", "left_semi")


def text_profile(items: DataFrame, key: str = "stream_id", text: str = "clean_visible") -> DataFrame:
    """``key, signature, is_degenerate``: the digest of a text's frequent words and their rounded counts.

    Counts are divided by a quantum of a hundredth of the largest (at least 2);
    only counts above the quantum enter, most frequent first, ties by word.
    Texts without words have no signature; where no count passes, the
    signature is that of nothing and marked as degenerate. Each row is a text of
    its own, also where a key repeats.
    """
    found = F.array_sort(F.filter(F.split(T.cleanse(F.col(text)), " "), lambda w: F.length(w) >= 2))

    def counted(s: Column) -> Column:
        # runs of equal words in the sorted array: all inside one row, nothing is shuffled
        at = F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda i: (i == 0) | (F.get(s, i) != F.get(s, F.greatest(i - 1, F.lit(0)))))
        runs = lambda at: F.transform(at, lambda i, k: F.struct((i - F.coalesce(F.get(at, k + 1), F.size(s))).alias("order"), F.get(s, i).alias("word")))
        return F.when(F.size(s) > 0, F.array_sort(F.transform(F.array(at), runs)[0]))

    # arrays are bound by transforms, so that each is computed once
    words = items.select(key, F.explode(F.transform(F.array(found), counted)).alias("words")).where(F.col("words").isNotNull())
    top = words.withColumn("most", -F.get("words", F.lit(0))["order"])
    quant = F.when(F.col("most") <= 1, F.lit(1)).otherwise(F.greatest(F.lit(2), F.round(F.col("most") * 0.01))).cast("long")
    kept = F.filter("words", lambda w: -w["order"] > F.col("quant"))
    parts = F.transform("kept", lambda w: F.concat_ws(" ", w["word"], F.floor(-w["order"] / F.col("quant")).cast("string")))
    made = top.withColumn("quant", quant).withColumn("kept", kept)
    return made.select(key, F.md5(F.array_join(parts, " ")).alias("signature"), (F.size("kept") == 0).alias("is_degenerate"))
