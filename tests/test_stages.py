import datetime

import pytest
from pyspark.sql import functions as F

from lexmill.operators import chunks, dedup, filters, index, labels, project, tagging
from lexmill.plans.pipeline import ConfigError, Plan, config_hash, default_registry


def items(spark, rows):
    return spark.createDataFrame(rows, "stream_id string, doc_id string, abs_url string, schost string, source string, lang_code string, raw string, clean_html string, clean_visible string, media_type string")


def row(n, url="http://www.dogs.com/x", **k):
    base = dict(stream_id=f"{n}-aa", doc_id=f"d{n}", abs_url=url, schost=None, source="s", lang_code="en", raw="raw", clean_html="<p>x</p>", clean_visible="x", media_type="text/html") | k
    return tuple(base.values())


def ids(frame):
    return sorted(r["stream_id"] for r in frame.collect())


def test_filters(spark):
    rows = items(spark, [row(1), row(2, "http://birds.org/"), row(3, "junk", schost="cats.net"), row(4, None), row(5, "http://notdogs.com/")])
    assert ids(filters.filter_domains(rows, ["dogs.com", "cats.net"])) == ["1-aa", "3-aa"]
    many = ["dogs.com", "cats.net", *(f"x{i}.y" for i in range(1200))]
    assert ids(filters.filter_domains(rows, many)) == ["1-aa", "3-aa"]
    assert ids(filters.filter_domain_substrings(rows, ["dogs", "net"])) == ["1-aa", "3-aa", "5-aa"]
    assert ids(filters.accept_ids(rows)) == [] and ids(filters.accept_ids(rows, ["2-aa"])) == ["2-aa"]
    assert ids(filters.filter_ids(rows, excluded=["1-aa"])) == ["2-aa", "3-aa", "4-aa", "5-aa"]
    assert ids(filters.filter_ids(rows, excluded_docs=["d1"], included=["1-aa", "2-aa"], included_docs=["d3"])) == ["2-aa", "3-aa"]
    assert ids(filters.filter_languages(items(spark, [row(1), row(2, lang_code=None), row(3, lang_code="de")]), ["en"], True)) == ["1-aa", "2-aa"]
    assert ids(filters.filter_exact_match(items(spark, [row(1, clean_visible="The BIG-dog"), row(2)]), ["big dog"])) == ["1-aa"]


def test_projections(spark):
    rows = items(spark, [row(1, clean_html=None), row(2), row(3, raw=None)])
    assert ids(project.replace_raw(rows)) == ["2-aa", "3-aa"]
    assert project.make_visible(rows).where("stream_id = '2-aa'").first()["clean_visible"] == "   x    "
    assert [r["raw"] for r in project.remove_raw(rows, True).orderBy("stream_id").collect()] == ["", "", ""]
    cleaned = project.clean_html(rows.withColumn("encoding", F.lit(None).cast("string")))
    assert ids(cleaned) == ["1-aa", "2-aa"]
    forced = project.force_clean_html(items(spark, [row(1, clean_html=None, clean_visible="a < b"), row(2, clean_html="", clean_visible="")])).orderBy("stream_id").collect()
    assert "<pre>" in forced[0]["clean_html"] and forced[0]["_errors"] == [] and len(forced[1]["_errors"]) == 1


def test_hyperlinks(spark):
    page = '<p>é <a class="q" href="http://a.org/1">one</a> and <A HREF=\'http://b.org/2\'>tw\u00f6</A> <a name="n">no</a></p>'
    rows = items(spark, [row(1, clean_html=page), row(2, clean_html="none"), row(3, clean_html=None)])
    found = labels.hyperlinks(rows).orderBy("first").collect()
    assert [(r["target_id"], r["value"]) for r in found] == [("http://a.org/1", "one"), ("http://b.org/2", "twö")]
    assert all(page[r["first"] : r["first"] + r["length"]] == r["value"] for r in found)
    raw = page.encode()
    assert all(raw[r["first"] : r["first"] + r["length"]].decode() == r["value"] for r in labels.hyperlinks(rows, "BYTES").collect())
    assert labels.hyperlinks(rows, domain_substrings=["b.org"]).count() == 1
    assert [r["first"] for r in labels.hyperlinks_by_line(rows).collect()] == [0, 0]


def test_tokens_and_alignment(spark):
    text = "The dog ran. It saw Mr. Smith there! Bye"
    rows = items(spark, [row(1, clean_visible=text), row(2, clean_visible=""), row(3, clean_visible=None)])
    tokens = labels.tokenize(rows).orderBy("token_num").collect()
    assert [t["token"] for t in tokens] == text.split() and max(t["sentence_id"] for t in tokens) == 2
    assert all(text[t["char_first"] : t["char_first"] + t["char_length"]] == t["token"] for t in tokens)
    marks = spark.createDataFrame([("1-aa", "me", "t1", "CHARS", 10, 6), ("1-aa", "me", "t2", "CHARS", 20, 9)], "stream_id string, annotator_id string, target_id string, offset_type string, first long, length int")
    joined = labels.tokenize(rows, marks, "me")
    assert joined.agg(F.max("sentence_id")).first()[0] == 1
    tagged = labels.attach_labels(joined, marks, "me").where("target_id is not null").orderBy("token_num").collect()
    assert [(t["token"], t["target_id"], t["mention_id"]) for t in tagged] == [("It", "t1", 0), ("Mr.", "t2", 1), ("Smith", "t2", 1)]
    assert labels.align_labels(joined, marks).count() == 3


def test_tokens_come_in_bounded_batches():
    """The tokens of many texts, or of one without an end mark, are never held at once."""
    import pyarrow as pa

    texts = ["word " * 950, "One two. Three four! " * 60, None, ""]
    rows = pa.RecordBatch.from_pydict({"stream_id": ["a", "b", "c", "d"], "text": texts, "marks": pa.array([None] * 4, pa.list_(pa.struct([("first", pa.int64()), ("length", pa.int32())])))})
    made = list(labels.token_batches([rows, rows], 100))
    assert max(b.num_rows for b in made) < 200 and sum(b.num_rows for b in made) == 2 * (950 + 240)
    first = [r for b in made for r in b.to_pylist()][:1190]
    assert [r["token_num"] for r in first] == [*range(950), *range(240)] and [r["sentence_pos"] for r in first[:950]] == [*range(950)]
    assert max(r["sentence_id"] for r in first if r["stream_id"] == "b") == 119


def test_linked_tokens_are_those_of_the_joins(spark):
    """Tokens meet the links of their own page without a shuffle, with the rows of the range join and of the as-of join."""
    from lexmill.functions import text as T

    page = '<p>é x <a class="q" href="http://a.org/1">one two </a>y <A HREF=\'b.org/2\'>tw\u00f6 <b>three</b></A><a name="n">no</a> <a href="http://c.org"></a> <img alt="</a> z">end'
    pages = [page, "none at all", None, "", '<a href="http://d.org">all</a>', "open <a href='http://e.org'>never closed", 'pre<a href="http://f.org">glued</a>post', " </a></a> x"] * 20
    rows = items(spark, [row(n, clean_html=h) for n, h in enumerate(pages)]).withColumn("clean_visible", T.blank_tags(F.col("clean_html")))
    for absolute in (True, False):
        found, tokens = labels.hyperlinks(rows, require_abs_url=absolute), labels.whitespace_tokens(rows)
        made = labels.linked_tokens(rows, require_abs_url=absolute, linked_only=True)
        assert "Exchange" not in made._jdf.queryExecution().executedPlan().toString()
        cut = lambda df: sorted(map(tuple, df.select("stream_id", "token_num", F.coalesce("target_id", F.lit("-"))).collect()))
        assert cut(made) == cut(labels.align_labels(tokens, found)) and made.count() >= 80
        assert cut(labels.linked_tokens(rows, require_abs_url=absolute)) == cut(labels.attach_labels(tokens, found, "author"))


def test_token_lists(spark):
    texts = ["a bb  c", None, " ", "", "\u00e9\u3000x \ty ", "z"] * 30
    rows = items(spark, [row(n, clean_visible=t) for n, t in enumerate(texts)])
    lists = labels.token_lists(rows)
    got = lists.select("stream_id", F.explode(F.arrays_zip("token_num", "token", "char_first")).alias("t")).select("stream_id", "t.*")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, labels.whitespace_tokens(rows).collect())) and lists.count() == 90


def test_whitespace_tokens_are_not_sorted(spark, tmp_path):
    """Tokens are not rows of an aggregate, which would sort all of them; texts of one id count together."""
    from lexmill.plans.queries import QUERIES

    spark.createDataFrame([(1, "b a"), (1, "c"), (2, None), (3, "d")], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    made = QUERIES["whitespace_tokens"](spark, str(tmp_path))
    assert sorted(map(tuple, made.collect())) == [(1, 3, 1, 2, "a", "c"), (3, 1, 0, 0, "d", "d")]
    assert "array_min" in made._jdf.queryExecution().optimizedPlan().toString()


def test_chains_and_mentions(spark):
    words = ["John", "Smith", "met", "J.", "Smythe", "at", "O'Hare"]
    tokens = spark.createDataFrame([("1", "t", n, w, 7 if n in (0, 1) else -1, 0) for n, w in enumerate(words)], "stream_id string, tagger_id string, token_num int, token string, equiv_id int, sentence_id int")
    rate = lambda *m: spark.createDataFrame([("1", "a", "x", list(m))], "stream_id string, annotator_id string, target_id string, mentions array<string>")
    hits = lambda f: sorted(r["token_num"] for r in f.collect())
    assert hits(labels.names_in_chains(tokens, rate("john", "smith"))) == [0, 1]
    assert hits(labels.names_in_chains(tokens, rate("john", "zz"), "ANY")) == [0, 1]
    assert hits(labels.names_in_chains(tokens, rate("john smith"), "ANY_MULTI_TOKEN")) == [0, 1]
    assert hits(labels.multi_token_match(tokens, rate("John Smith"))) == [0, 1]
    assert hits(labels.multi_token_match(tokens, rate('ur"^j$" ur"^sm[a-z]*$"'))) == [3, 4]


def test_global_mentions(spark):
    rows = [("1", "t", s, n, m) for n, (s, m) in enumerate([(0, 0), (0, 0), (0, 1), (1, 0), (1, -1)])]
    frame = spark.createDataFrame(rows, "stream_id string, tagger_id string, sentence_id int, token_num int, mention_id int")
    assert [r["mention_id"] for r in labels.global_mentions(frame).orderBy("token_num").collect()] == [0, 0, 1, 2, -1]


def test_dedup(spark):
    long = "word " * 200
    rows = [("1-a", "a", 1.0, long, "r"), ("2-a", "a", 2.0, long + "w", "r"), ("3-a", "a", 3.0, "short", "r"), ("4-b", "b", 4.0, long, "q" * 900), ("5-c", "c", 5.0, "", ""), ("6-c", "c", 6.0, None, None)]
    frame = spark.createDataFrame(rows, "stream_id string, doc_id string, epoch_ticks double, clean_visible string, raw string")
    rule = dedup.DedupRule(use_nilsimsa=False, require_same_doc_id=True)
    assert ids(dedup.dedup(frame, rule)) == ["1-a", "3-a", "4-b", "5-c"]
    # when 4-b comes, page a's kept item is 3-a, so nothing of the same text is left to compare with
    assert ids(dedup.dedup(frame, dedup.DedupRule())) == ["1-a", "3-a", "4-b", "5-c"]


def test_digest_bands_find_all_pairs(spark):
    import random

    from lexmill.functions.hashes import similarity

    rng, digests = random.Random(1), []
    for _ in range(30):
        d = rng.getrandbits(256)
        digests += [d, d ^ (1 << rng.randrange(256)), d ^ (1 << rng.randrange(256)) ^ (1 << rng.randrange(256))]
    rows = spark.createDataFrame([(f"{k}", f"{k}", 1.0, f"{d:064x}", 9, 9) for k, d in enumerate(digests)], "stream_id string, doc_id string, epoch_ticks double, digest string, n_clean long, n_raw long")
    got = {(r["a"], r["b"]) for r in dedup.digest_bands(rows, 125).collect()}
    hexes = sorted({f"{d:064x}" for d in digests})
    want = {(a, b) for i, a in enumerate(hexes) for b in hexes[i + 1 :] if similarity(bytes.fromhex(a), bytes.fromhex(b)) >= 125}
    assert got == want and want


def test_digests_are_made_once_and_in_blocks(spark):
    """A text is digested block by block, in Arrow batches of few bytes, and once for both sides of the join."""
    import random

    from lexmill.functions.hashes import nilsimsa

    rng = random.Random(5)
    for n in (0, 1, 3, 4, 5, 6, 9, 10, 200):
        data = bytes(rng.randrange(256) for _ in range(n))
        assert {nilsimsa(data, block) for block in (1, 2, 3, 5, 64, 1 << 18)} == {nilsimsa(data)}
    frame = spark.createDataFrame([("1-a", "a", 1.0, "one text"), ("2-b", "b", 2.0, "one text"), ("3-c", "c", 3.0, ""), ("4-d", "d", 4.0, None)], "stream_id string, doc_id string, epoch_ticks double, clean_visible string")
    made = dedup.same_digest(dedup.measured(frame, dedup.DedupRule()))
    assert sorted(map(tuple, made.collect())) == [("1-a", True), ("2-b", False), ("3-c", True), ("4-d", True)]
    assert "Python" not in made._jdf.queryExecution().executedPlan().toString()
    assert int(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch").rstrip("b")) <= 4_000_000


def test_digest_bands_in_blocks_and_squares(spark):
    """Each near pair once, over blocks of digests, long runs of equal keys, and without bands."""
    import random

    from lexmill.functions import hamming
    from lexmill.functions.hashes import similarity

    rng = random.Random(2)
    centers = [rng.getrandbits(256) for _ in range(3)]
    digests = {rng.getrandbits(256) for _ in range(100)} | {c ^ sum(1 << b for b in {rng.randrange(40) for _ in range(8)}) for c in centers for _ in range(120)}
    rows = spark.createDataFrame([(f"{k}", f"{k}", 1.0, f"{d:064x}", 9, 9) for k, d in enumerate(digests)] * 2, "stream_id string, doc_id string, epoch_ticks double, digest string, n_clean long, n_raw long")
    hexes = sorted(f"{d:064x}" for d in digests)
    for exactness, block_rows in ((116, 4_000_000), (116, 400), (90, 4_000_000)):
        want = sorted((a, b, similarity(bytes.fromhex(a), bytes.fromhex(b))) for i, a in enumerate(hexes) for b in hexes[i + 1 :] if similarity(bytes.fromhex(a), bytes.fromhex(b)) >= exactness)
        assert sorted(map(tuple, dedup.digest_bands(rows, exactness, block_rows).collect())) == want and len(want) > 10_000
    assert hamming.choices(90 - 59) == [()] and len(hamming.choices(12)) == 91


def test_near_pairs_are_not_shuffled(spark):
    """Neither keys nor candidates are rows of a join."""
    rows = spark.createDataFrame([("1", "1", 1.0, "0" * 64, 9, 9)], "stream_id string, doc_id string, epoch_ticks double, digest string, n_clean long, n_raw long")
    assert "Join" not in dedup.digest_bands(rows, 116)._jdf.queryExecution().executedPlan().toString()


def test_index(spark):
    phrases = {"1": "the quick brown fox", "2": "lazy lazy dog", "3": "dog eat dog", "4": "a lazy programmer"}
    tokens = spark.createDataFrame([(k, w) for k, p in phrases.items() for w in p.split()], "stream_id string, token string")
    counted = index.terms(tokens, stop_words=["the", "a"], size_limit=8)
    built = index.build(counted)
    from lexmill.functions.hashes import term_hash as h

    assert {r["hash"]: r["n"] for r in index.document_frequencies(built, [0, h("lazy"), h("dog"), h("nothing")]).collect()} == {0: 4, h("lazy"): 2, h("dog"): 2, h("nothing"): 0}
    assert {r["stream_id"]: r["tf"] for r in index.lookup_tf(built, h("dog")).collect()} == {"2": 1, "3": 2}
    assert sorted(r["stream_id"] for r in index.lookup(built, [h("fox"), h("eat")]).collect()) == ["1", "3"]
    assert [r["term"] for r in index.invert(built, h("dog")).collect()] == ["dog"] and index.invert(built, h("programmer")).count() == 0
    assert index.search(counted, ["dog", "eat"]).first()["stream_id"] == "3"
    assert index.lookup(built, [0]).count() == 0


def test_hashes_of_many_terms():
    import random

    import pyarrow as pa

    from lexmill.functions import hashes

    rng = random.Random(3)
    terms = ["", "a", "é", "the", "lazy", *("".join(rng.choice("ab é\u4e00\U0001f600") for _ in range(rng.randrange(40))) for _ in range(500))]
    made = hashes.term_hashes(pa.array(["skipped", *terms])[1:])
    assert made.tolist() == [hashes.term_hash(t) for t in terms]


def test_index_tables_read_their_tokens_once(spark, tmp_path):
    """Terms are counted and hashed in one pass; all three tables are made of what that wrote."""
    from pyspark.sql.types import StringType

    from lexmill.functions.hashes import term_hash
    from lexmill.sinks import files as sinks

    made = spark.sparkContext.accumulator(0)

    @F.udf(StringType())
    def seen(word):
        made.add(1)
        return word

    words = [("1", "dog"), ("1", "dog"), ("1", "The"), ("2", "dog"), ("2", "cat")]
    tokens = spark.createDataFrame(words, "stream_id string, token string").select("stream_id", seen.asNondeterministic()("token").alias("token"))
    rows = spark.createDataFrame([("1", "0" * 32, 5.0, "s")], "stream_id string, doc_id string, epoch_ticks double, source string")
    sinks.write_index_tables(rows, str(tmp_path), tokens)
    assert made.value == len(words)
    read = lambda name: sorted(map(tuple, spark.read.parquet(f"{tmp_path}/{name}").collect()))
    h = term_hash
    assert read("sitf") == sorted([(h("dog"), "1", 2), (h("the"), "1", 1), (h("dog"), "2", 1), (h("cat"), "2", 1)])
    assert read("sihf") == sorted([(0, 2), (h("dog"), 2), (h("the"), 1), (h("cat"), 1)])
    assert read("sihk") == sorted([(h("dog"), "dog", 2), (h("the"), "the", 1), (h("cat"), "cat", 1)])


def test_postings_grow_by_tasks(spark, tmp_path, monkeypatch):
    """More postings are more tasks, not larger ones; files are ranges of hashes, each in order, and nothing is lost between them."""
    from lexmill.sinks import files as sinks

    monkeypatch.setattr(sinks, "POSTINGS", 50)
    tokens = spark.createDataFrame([(str(k), f"w{k * 7 % 201}") for k in range(402)], "stream_id string, token string")
    rows = spark.createDataFrame([("1", "0" * 32, 5.0, "s")], "stream_id string, doc_id string, epoch_ticks double, source string")
    sinks.write_index_tables(rows, str(tmp_path), tokens, with_items=False, with_source=False, by_time=False)
    files = [[r["hash"] for r in spark.read.parquet(str(f)).collect()] for f in (tmp_path / "sitf").glob("*.parquet")]
    ordered = sorted(f for f in files if f)
    assert len(ordered) >= 8 and all(f == sorted(f) for f in ordered) and sum(map(len, ordered)) == 402
    assert all(a[-1] < b[0] for a, b in zip(ordered, ordered[1:]))  # noqa: B905, RUF007
    assert not (tmp_path / "si").exists()


def test_hashed_text_terms(spark):
    """As the counts by shuffle, also where a key has two rows; long terms are left out, and no token moves."""
    long = "x" * 129
    rows = [("1", f"Dog dog, - {long} e.g. dog"), ("2", "dog"), ("3", None), ("4", " "), ("5", "É -LRB- \u3000 cat")]
    for more in ([], [("2", "cat dog")]):
        docs = spark.createDataFrame(rows + more, "stream_id string, text string")
        made = index.hashed_text_terms(docs, "text")
        got = sorted(made.select("stream_id", "term", "tf").collect())
        assert got == sorted(index.text_terms(docs, "text").select("stream_id", "term", "tf").collect()) and got
        assert ("Exchange" in made._jdf.queryExecution().executedPlan().toString()) == bool(more)
        from lexmill.functions.hashes import term_hash

        assert all(r["hash"] == term_hash(r["term"]) for r in made.collect())


def test_hashes_are_asked_of_distinct_terms(spark):
    """The test of a hash stays above the grouping of equal terms."""
    tokens = spark.createDataFrame([("1", "dog")] * 3, "stream_id string, token string")
    built = index.build(index.terms(tokens))
    plan = built.dictionary.where("hash = 5").select("term")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Eval") < plan.index("Aggregate")


def test_chunks(spark):
    time = datetime.datetime(2024, 1, 1, 5)
    rows = spark.createDataFrame([(f"{n}-x", f"{n:032x}", f"u/{n % 2}", "s" if n < 6 else "t", float(n), time, n) for n in range(7)], "stream_id string, doc_id string, abs_url string, source string, epoch_ticks double, stream_time timestamp, pos long")
    keyed = rows.withColumn("i", F.lit("in"))
    assert [r["chunk"] for r in chunks.cut(keyed, ["i"], ["pos"], 3).orderBy("pos").collect()] == [0, 0, 0, 1, 1, 1, 2]
    assert [r["chunk"] for r in chunks.cut(keyed, ["i"], ["pos"], 100, 25, F.lit(10)).orderBy("pos").collect()] == [0, 0, 0, 1, 1, 2, 2]
    assert [r["pos"] for r in chunks.skip_and_limit(keyed, ["pos"], 2, 3).collect()] == [2, 3, 4]
    info = chunks.name_info(keyed, ["i"]).first()
    assert (info["num"], info["epoch_ticks"], info["date_hour"], info["target_names"]) == (7, 0, "2024-01-01-05", "0-1")
    assert chunks.source_violations(keyed, ["i"]).first()["n_sources"] == 2
    found = chunks.verify(keyed.withColumn("clean_visible", F.lit("é")), ["source"])
    assert {r["source"]: r["visible_bytes"] for r in found.collect()} == {"s": 12, "t": 2}
    expected = spark.createDataFrame([("s", 6), ("t", 2), ("u", 1)], "source string, n_items long")
    assert sorted(r["source"] for r in chunks.against(found, expected, ["source"]).collect()) == ["t", "u"]


def test_text_profile(spark):
    rows = spark.createDataFrame([("a", "dog dog dog cat cat cat bird"), ("b", "cat dog cat dog, CAT dog"), ("c", "rare words"), ("d", "")], "stream_id string, clean_visible string")
    made = {r["stream_id"]: r for r in dedup.text_profile(rows).collect()}
    assert made["a"]["signature"] == made["b"]["signature"] and made["c"]["is_degenerate"] and "d" not in made


def test_tagging_and_xpaths(spark):
    rows = tagging.parse_tagged("1", '<s>A <ENAMEX ID="3" TYPE="PERSON">Jo Po</ENAMEX> ran.</s> <s><ENAMEX ID="3" TYPE="MALE_PRONOUN">He</ENAMEX> sat.</s>')
    assert [(r[4], r[5], r[7], r[8], r[9]) for r in rows] == [("A", 0, None, None, -1), ("Jo", 2, "PER", "NAME", 3), ("Po", 5, "PER", "NAME", 3), ("ran.", 8, None, None, -1), ("He", 13, "PER", "PRO", 3), ("sat.", 16, None, None, -1)]
    page = "<html><body><p>one <b>two</b> three</p><p>four<br>five</p></body></html>"
    nodes = tagging.text_nodes(page)
    for word in ("one", "two", "three", "four", "five"):
        found = tagging.xpath_range(nodes, page.index(word), len(word))
        assert tagging.xpath_slice(page, found) == word
    assert tagging.xpath_range(nodes, 0, 3) is None
    echo = tagging.run_tagger(items(spark, [row(1, clean_visible="a b"), row(2, clean_visible="c")]), ["cat"])
    assert sorted((r["stream_id"], r["token"]) for r in echo.collect()) == [("1-aa", "a"), ("1-aa", "b"), ("2-aa", "c")]


def test_pipeline_plan(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for n in range(3):
        (tmp_path / "in" / f"f{n}.txt").write_text(f"text number {n} " * 9)
    registry = default_registry()
    (tmp_path / "ext.py").write_text("Stages = {'shout': lambda **o: (lambda items: items.withColumn('source', items.source))}")
    registry.load(str(tmp_path / "ext.py"))
    config = {"reader": "from_files", "incremental_transforms": ["guess_media_type", "make_visible", "set_source", "shout"], "writers": ["to_chunks"], "guess_media_type": {"fallback": "text/plain"}, "set_source": {"source": "me"}, "to_chunks": {"path": str(tmp_path / "out")}}
    Plan.of(config, registry).run(spark, registry, str(tmp_path / "in"))
    done = spark.read.parquet(str(tmp_path / "out"))
    assert done.count() == 3 and done.first()["source"] == "me" and done.first()["clean_visible"].startswith("text number")
    with pytest.raises(ConfigError):
        Plan.of({"reader": "from_files", "transforms": ["nope"]}, registry)
    assert config_hash({"a": 1, "b": [2]}) == config_hash({"b": [2], "a": 1})
    assert not registry.try_load("x", lambda: __import__("no_such_module"))


def test_dedup_across_pages_by_brute_force(spark):
    """The ordered fold over everything kept so far, by equal and by near digests."""
    import random

    from lexmill.functions import hashes
    from lexmill.operators import dedup

    rng = random.Random(4)
    bases = ["".join(rng.choice("abcdefgh ") for _ in range(600)) for _ in range(6)]
    rows = []
    for k in range(160):
        text = list(rng.choice(bases)) if rng.random() < 0.9 else []
        for _ in range(rng.choice([0, 0, 1, 30]) if text else 0):
            text[rng.randrange(600)] = rng.choice("xyz")
        rows.append((f"{k:03d}-p", f"page{rng.randrange(25)}", float(k), "".join(text) or None, "r" * rng.randrange(3)))
    items = spark.createDataFrame(rows, "stream_id string, doc_id string, epoch_ticks double, clean_visible string, raw string").repartition(4)
    for exactness in (128, 110):
        rule = dedup.DedupRule(exactness=exactness)
        pages, want = {}, []
        for sid, doc, _, text, raw in rows:
            text = text or ""
            new = (hashes.nilsimsa(text.encode()), len(text), len(raw))
            if doc in pages and dedup.is_repeat(pages[doc], new, rule):
                continue
            if text and any(hashes.similarity(new[0], old[0]) >= exactness for old in pages.values()):
                continue
            pages[doc] = new
            want.append(sid)
        assert sorted(r["stream_id"] for r in dedup.dedup(items, rule).collect()) == want and len(want) < 150
