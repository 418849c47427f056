"""The pipeline, stage by stage, against brute force on a small corpus, and the SQL of queries."""

import os
import random
import re
from collections import Counter

import pytest

import corpus_pipeline
from lexmill.llm.queries import QUERIES, SQL

DATA = "/root/testdata/sf0.001"
WS = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Documents with toxic ones, copies and near copies, and labels."""
    rng = random.Random(11)
    words = [f"term{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(400)]
    rows, labels = [], []
    for i in range(400):
        text = [rng.choice(words) for _ in range(rng.randrange(30, 90))]
        if i % 8 == 0:
            for k in rng.sample(range(len(text)), 5):
                text[k] = rng.choice(["grobnik", "vlitz", "snorf"])
        rows.append((i, " ".join(text) + ".", "en", f"s{i % 4}", 0))
        labels.append((i, i % 3 and 1, int(i % 8 == 0)))
    clean = [r for r in rows if r[0] % 8]
    for i in range(400, 430):
        rows.append((i, clean[i - 400][1].replace(" ", "  "), "en", "s0", 0))
    for i in range(430, 460):
        text = clean[i - 360][1].split()
        text[3] = "changed"
        rows.append((i, " ".join(text), "en", "s1", 0))
    out = tmp_path_factory.mktemp("sf")
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{out}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{out}/labels.parquet")
    return str(out)


def shingles(t):
    w = WS.findall(t.lower())
    return {tuple(w[i : i + 3]) for i in range(len(w) - 2)} or {tuple(w)}


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    functions = dict(corpus_pipeline.STAGES)
    clean = functions["toxicity"](spark, docs, folder).persist()
    ids = {r["doc_id"] for r in clean.collect()}
    assert clean.columns == columns and all((i in ids) == (i >= 400 or i % 8 != 0) for i in range(460))
    single = functions["exact dedup"](spark, clean, folder).persist()
    kept = {r["doc_id"]: r["text"] for r in single.collect()}
    assert single.columns == columns and sorted(kept) == [i for i in sorted(ids) if not 400 <= i < 430]
    apart = functions["n-gram Jaccard join"](spark, single, folder).persist()
    left = {r["doc_id"] for r in apart.collect()}
    order, want = sorted(kept), set()
    sets = {i: shingles(kept[i]) for i in order}
    for i in order:
        if not any(j < i and 100 * len(sets[i] & sets[j]) >= 70 * len(sets[i] | sets[j]) for j in order[: order.index(i)]):
            want.add(i)
    assert apart.columns == columns and left == want
    mixed = functions["source mixing"](spark, apart, folder).persist()
    total = sum(len(WS.findall(kept[i])) for i in left)
    assert mixed.columns == columns and abs(sum(len(WS.findall(r["text"])) for r in mixed.collect()) - total) <= 4
    packed = functions["best-fit packing"](spark, mixed, folder).collect()
    assert len({(r["sequence_id"], r["offset"]) for r in packed}) == len(packed)
    assert Counter(r["doc_id"] for r in packed if r["piece"] == 0) == Counter(r["doc_id"] for r in mixed.collect())
    assert corpus_pipeline.run(spark, folder).count() == len(packed)


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for f in ("documents", "labels"):
        con.sql(f"CREATE VIEW {f} AS SELECT * FROM '{DATA}/{f}.parquet'")
    made, want = QUERIES[name](spark, DATA), con.sql(SQL[name])
    columns = sorted(want.columns)
    assert sorted(made.columns) == columns
    value = lambda v: round(v, 6) if isinstance(v, float) else v
    found = Counter(tuple(value(r[c]) for c in columns) for r in made.collect())
    at = {c: k for k, c in enumerate(want.columns)}
    assert found == Counter(tuple(value(r[at[c]]) for c in columns) for r in want.fetchall())
