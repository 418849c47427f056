import gzip
import json
import os
import zlib

import pytest

from lexmill.operators import dedup, project
from lexmill.sinks import files as sinks
from lexmill.sources import feed, files, kv, specs
from lexmill.streaming import ingest


def test_files_and_folders(spark, tmp_path):
    for label in ("0", "1"):
        (tmp_path / "c" / label).mkdir(parents=True)
        (tmp_path / "c" / label / "a.txt").write_text(f"John Smith {label}")
    got = files.read_files(spark, str(tmp_path / "c"), url_prefix="x:", time=5)
    assert got.count() == 2 and got.first()["epoch_ticks"] == 5.0 and got.first()["abs_url"].startswith("x:/")
    items, ratings = files.read_labelled_folders(spark, str(tmp_path / "c"))
    assert sorted(r["target_id"] for r in ratings.collect()) == ["0", "1"] and items.first()["stream_id"].startswith("915148799-")
    truth = spark.createDataFrame([("t0", "John", "0/a.txt", "PER"), ("t1", "John", "1/a.txt", "PER")], "target_id string, mention string, file_name string, entity_type string")
    assert sorted(r["target_id"] for r in files.with_ground_truth(items, truth).collect()) == ["t0", "t1"]
    with pytest.raises(Exception, match="no ground truth"):
        files.with_ground_truth(items, truth.limit(1)).collect()


def test_social_json(spark, tmp_path):
    lines = [json.dumps({"source": "social", "abs_url": "u", "epoch_ticks": 1.0, "title": "T", "anchor": "", "body": "<p>b</p>"}), "{bad", json.dumps({"source": "news", "abs_url": "v", "epoch_ticks": 1.0})]
    with gzip.open(tmp_path / "x.json.gz", "wt") as f:
        f.write("\n".join(lines))
    items, other = files.read_social_json(spark, str(tmp_path / "x.json.gz"))
    assert bytes(items.first()["raw"]) == b"<p>T</p><p>b</p>" and items.count() == 1
    assert [(r["key"], r["clean_visible"]) for r in other.collect()] == [("title", "T")]


def test_entity_xml(spark, tmp_path):
    (tmp_path / "20130102-x.xml").write_text('<Doc><Document docid="d1" source_type="web"><OriginalText><Contents>hello</Contents></OriginalText></Document></Doc>')
    row = files.read_entity_xml(spark, str(tmp_path)).first()
    assert row["source"] == "web" and bytes(row["raw"]) == b"hello" and row["epoch_ticks"] == 1357084800.0


def test_spec(spark, tmp_path):
    (tmp_path / "a").mkdir()
    for n in range(2):
        (tmp_path / "a" / f"{n}.txt").write_text("t")
    (tmp_path / "s.yaml").write_text(f"root_path: {tmp_path}\nsource: s\nannotator_id: me\nentities:\n- target_id: e1\n  doc_path: a\n  slots: [John, {{NAME: [Smith]}}]\n- target_id: e2\n  doc_path: [{{doc_path: a/0.txt, abs_url: 'http://q'}}]\n  slots: Jo\n")
    docs, ratings = specs.read_spec(spark, str(tmp_path / "s.yaml"))
    assert docs.count() == 2 and ratings.count() == 3
    assert sorted(ratings.where("target_id = 'e1'").first()["mentions"]) == ["John", "Smith"]
    assert specs.slot_values({"a": [1, {"b": "c"}]}) == [("a", "1"), ("b", "c")]


def _varint(n):
    out = b""
    while True:
        out += bytes([n & 127 | (128 if n > 127 else 0)])
        n >>= 7
        if not n:
            return out


def _bytes(number, value):
    return _varint(number << 3 | 2) + _varint(len(value)) + value


def test_feed_is_decoded_in_bounded_batches(spark, tmp_path):
    """The inflated entries of a file, or of many, are never held at once; many files are no task each."""
    import pyarrow as pa

    one = lambda n: b"".join(feed.encode_frame(f"u{n}-{k}", "NEWS", zlib.compress(b"x" * 1000), k) for k in range(50)) + feed.encode_end() + b"never read"
    made = list(feed.decoded(iter([pa.array([one(0), one(1)]), pa.array([], pa.binary()), pa.array([one(2)])]), 20_000))
    assert max(b.num_rows for b in made) < 25 and [r["url"] for b in made for r in b.to_pylist()] == [f"u{n}-{k}" for n in range(3) for k in range(50)]
    for n in range(300):
        (tmp_path / f"{n}.bin").write_bytes(one(n))
    rows = feed.read_feed(spark, str(tmp_path))
    assert rows.rdd.getNumPartitions() <= 12 and rows.count() == 15_000 and rows.where("length(raw) = 1000").select("url").distinct().count() == 15_000


def test_feed(spark, tmp_path):
    def frame(url, source):
        entry = _bytes(1, url) + _bytes(2, source) + _bytes(4, zlib.compress(b"page")) + _varint(5 << 3) + _varint(300)
        body = _varint(8) + _varint(1) + _bytes(2, entry)
        return _varint(len(body)) + body

    end = _varint(8) + _varint(2)
    (tmp_path / "f.bin").write_bytes(frame(b"u1", b"WEB") + frame(b"u2", b"NEWS") + _varint(len(end)) + end)
    rows = feed.read_feed(spark, str(tmp_path / "f.bin")).collect()
    assert [(r["url"], r["source"], bytes(r["raw"]), r["epoch_ticks"]) for r in rows] == [("u1", "WEB", b"page", 300.0), ("u2", "NEWS", b"page", 300.0)]
    assert [r["url"] for r in feed.read_feed(spark, str(tmp_path / "f.bin"), "NEWS").collect()] == ["u2"]
    with pytest.raises(ValueError, match="ends within"):
        list(feed.messages(b"\x05ab"))


def _items(spark):
    rows = spark.createDataFrame([(f"http://h/{n}", float(n - 1), "s" if n else "", "en", f"<p>{n}</p>", f"v{n}") for n in range(4)], "url string, t double, source string, lang_code string, clean_html string, clean_visible string")
    return project.with_identity(rows, epoch=rows["t"])


def test_keys(spark):
    items = _items(spark).persist()
    rows = {r["abs_url"]: r for r in items.collect()}
    one = rows["http://h/0"]
    assert one["stream_id"].startswith("-1-") and kv.get_item(items, one["stream_id"]).count() == 1
    for bad in ("x", "1-2-3", f"7-{one['doc_id']}"):
        with pytest.raises(KeyError):
            kv.get_item(items, bad)
    two = ";".join(rows[u]["stream_id"] for u in ("http://h/1", "http://h/2"))
    assert items.where(kv.key_predicate(two)).count() == 2 and items.where(kv.key_predicate("")).count() == 4
    ordered = sorted(r["doc_id"] for r in rows.values())
    assert items.where(kv.key_predicate(f"{ordered[1]}<{ordered[3]}")).count() == 2
    assert kv.get_by_doc_id(items, one["doc_id"]).count() == 1 and kv.delete(items, [one["stream_id"]]).count() == 3
    assert kv.index_tables(items)["sisi"].count() == 3


def test_sinks(spark, tmp_path):
    items = _items(spark)
    sinks.write_index_tables(items, str(tmp_path / "kv"), items.selectExpr("stream_id", "clean_visible as token"))
    assert sorted(os.listdir(tmp_path / "kv")) == ["si", "sihf", "sihk", "sisi", "sitf", "siti"]
    assert sinks.verified_write(items, str(tmp_path / "v")) == 4
    sinks.write_side_table(sinks.dump_ids(items), str(tmp_path / "tsv"))
    tars = sinks.tarballs(items.withColumn("chunk", items["source"]), ["chunk"], ["en"])
    sinks.write_tarballs(tars, f"file://{tmp_path}/tar", ["chunk"])
    import tarfile

    with tarfile.open(tmp_path / "tar" / "s.tar.gz") as t:
        assert len(t.getnames()) == 3 and t.extractfile(t.getnames()[0]).read().startswith(b"<p>")
    info = spark.createDataFrame([(3, "ab")], "num int, md5 string")
    assert sinks.named_paths(info, "x-{num}-{md5}").first()["name"] == "x-3-ab"


def test_streams(spark, tmp_path):
    rule = dedup.DedupRule(use_nilsimsa=False)
    text = "word " * 50
    rows = spark.createDataFrame([("1-a", "a", 1.0, text, text), ("2-a", "a", 2.0, text + "x", text), ("3-b", "b", 3.0, text, text)], "stream_id string, doc_id string, epoch_ticks double, clean_visible string, raw string")
    measured = dedup.measured(rows, rule)
    measured.write.parquet(str(tmp_path / "in"))
    stream = ingest.dedup_stream(ingest.read_stream(spark, str(tmp_path / "in"), measured.schema.simpleString()[7:-1].replace(":", " ").replace(",", ", ")), rule)
    ingest.write_stream(stream, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    assert sorted(r["stream_id"] for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["1-a", "3-b"]
    again = spark.createDataFrame([("4-a", "a", 4.0, text, text)], rows.schema)
    dedup.measured(again, rule).write.mode("append").parquet(str(tmp_path / "in"))
    stream = ingest.dedup_stream(ingest.read_stream(spark, str(tmp_path / "in"), "stream_id string, doc_id string, epoch_ticks double, digest string, n_clean long, n_raw long"), rule)
    ingest.write_stream(stream, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2
    seen = []
    ingest.write_batches(ingest.read_stream(spark, str(tmp_path / "in"), "stream_id string"), str(tmp_path / "cp2"), lambda b, n: seen.append(b.count())).awaitTermination()
    assert sum(seen) == 4
