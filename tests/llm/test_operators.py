import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexmill.llm import exact_dedup, line_quality, lm_scoring, mixing, ngram_join, packing, pii, repair, sharding, tokens, toxicity
from lexmill.llm.common import Workspace, running_sum
from lexmill.llm.elias_fano import EliasFano
from lexmill.llm.queries import tokenizer_path

WS = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, rid string, key string, node long, gram string, digest string, shard int, k0 string, weight double, target double"


def frame(spark, rows):
    """Documents with further columns whose names the operators use inside."""
    return spark.createDataFrame([(i, t, "en", s, None, 1, "r", "k", 2, "g", "d", 3, "x", 0.5, 1.0) for i, t, s in rows], SCHEMA)


def corpus(seed=0, n=60):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(200)]
    rows = []
    for i in range(n):
        text = " ".join(rng.choice(words) for _ in range(rng.randrange(3, 120)))
        rows.append((i, text, f"s{i % 5}" if i % 7 else None))
    for i in range(n, n + 20):
        old = rows[rng.randrange(n)][1].split()
        for _ in range(rng.randrange(0, 3)):
            old[rng.randrange(len(old))] = rng.choice(words)
        rows.append((i, " ".join(old), "s0"))
    odd = [None, "", " \t\n", "A", "a  b", "a\tb", "x" * 50_000, "w1 w2 w3", "W1 w2 w3", rows[3][1], rows[3][1]]
    rows += [(n + 20 + k, t, "s1") for k, t in enumerate(odd)]
    rows += [(3, rows[3][1], "s3"), (3, rows[3][1], "s3"), (None, "null id text here", None), (None, None, None), (None, "null id text here", None)]
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    return frame(spark, corpus()).repartition(3).persist()


def norm(t):
    return re.sub(r"[\x20\x09-\x0D]+", " ", t or "")


def low(t):
    return (t or "").translate({c: c + 32 for c in range(65, 91)})


@pytest.mark.parametrize("weak", [False, True])
def test_exact_dedup(docs, weak):
    digest = (lambda t: F.unhex(F.lpad(F.hex(F.crc32(t) % 3), 8, "0"))) if weak else exact_dedup.sha256
    got = exact_dedup.dedup(docs, digest).collect()
    groups = defaultdict(list)
    for i, t, _ in corpus():
        groups[norm(t)].append(i)
    assert len(got) == len(corpus())
    want = Counter()
    for ids in groups.values():
        first = min((i for i in ids if i is not None), default=None)
        want.update((i, first, len(ids)) for i in ids)
    assert Counter((r["doc_id"], r["keep_id"], r["group_size"]) for r in got) == want
    assert sum(r["kept"] for r in got) == len(groups) and all(r["doc_id"] == r["keep_id"] for r in got if r["kept"])


def test_exact_dedup_filters_skip_what_one_run_holds(spark):
    """Digests of one run alone pass the second compaction by; those of two runs never do."""
    rows = [(k % 4, f"{k if k % 10 else 0:08x}".encode() * 4) for k in range(4000)]
    middle = spark.createDataFrame([(r, d, 1) for r, d in sorted(set(rows))], "run int, digest binary, n long")
    hit, miss = exact_dedup.probed(Workspace(spark, "probe"), middle)
    hits, misses = ([(r["run"], bytes(r["digest"])) for r in x.collect()] for x in (hit, miss))
    runs = defaultdict(set)
    for r, d in rows:
        runs[d].add(r)
    assert sorted(hits + misses) == sorted(set(rows)) and len(hits) < 20
    assert {d for _, d in hits} >= {d for d, r in runs.items() if len(r) > 1}


def test_keep_first(docs):
    kept = exact_dedup.keep_first(docs)
    assert kept.columns == docs.columns
    got = [(r["doc_id"], norm(r["text"])) for r in kept.collect()]
    assert sorted(t for _, t in got) == sorted({norm(t) for _, t, _ in corpus()})


def shingle_set(t):
    w = WS.findall(low(t))
    return frozenset(tuple(w[i : i + 3]) for i in range(len(w) - 2)) if len(w) > 2 else frozenset([tuple(w)]) if w else frozenset()


def test_ngram_join(docs):
    rows = [(i, shingle_set(t)) for i, t, _ in corpus()]
    n = len(rows)
    links = {a: [b for b in range(n) if b != a and rows[a][1] and 100 * len(rows[a][1] & rows[b][1]) >= 70 * len(rows[a][1] | rows[b][1])] for a in range(n)}
    want = Counter()
    for a in range(n):
        seen, todo = {a}, [a]
        while todo:
            for b in links[todo.pop()]:
                if b not in seen:
                    seen.add(b)
                    todo.append(b)
        low_id = min((rows[b][0] for b in seen if rows[b][0] is not None), default=None)
        want[rows[a][0], len(rows[a][1]), len(links[a]), low_id] += 1
    got = Counter((r["doc_id"], r["n_shingles"], r["n_similar"], r["component_id"]) for r in ngram_join.linked_documents(docs).collect())
    assert got == want
    kept = ngram_join.keep_one(docs)
    assert kept.columns == docs.columns and kept.where("doc_id = 3").count() == 3


def test_keep_one_tells_rows_apart_by_id_and_text(spark):
    words = [f"w{k}" for k in range(60)]
    text, other = " ".join(words), " ".join(reversed(words))
    rows = [(1, text, "s"), (1, other, "s"), (2, text + " more", "s"), (None, text, "s"), (None, "quite another text", "s"), (None, None, "s")]
    got = Counter((r["doc_id"], r["text"]) for r in ngram_join.keep_one(frame(spark, rows)).collect())
    assert got == Counter([(1, text), (1, other), (None, "quite another text"), (None, None)])


@pytest.mark.parametrize("cell", [4096, 3])
def test_ngram_join_of_frequent_grams_and_long_sets(spark, monkeypatch, cell):
    """A cluster of near copies, a passage in many texts, long sets in many fragments; small cells, blocks and segments."""
    for name, value in (("ORDER_SAMPLE", 1), ("CELL", cell), ("BLOCK", 4), ("SEGMENT", 12)):
        monkeypatch.setattr(ngram_join, name, value)
    rng = random.Random(9)
    word = lambda: f"w{rng.randrange(3000)}"
    base, passage, long = ([word() for _ in range(k)] for k in (60, 20, 900))
    texts = []
    for _ in range(40):
        copy = list(base)
        for _ in range(rng.randrange(4)):
            copy[rng.randrange(60)] = word()
        texts.append(copy)
    texts += [[word() for _ in range(30)] + passage + [word() for _ in range(rng.randrange(30))] for _ in range(25)]
    for _ in range(6):
        copy = list(long)
        for _ in range(rng.randrange(70)):
            copy[rng.randrange(900)] = word()
        texts.append(copy)
    rows = [(k, " ".join(t), "s") for k, t in enumerate(texts)]
    sets = [shingle_set(t) for _, t, _ in rows]
    want = {a: sum(100 * len(sets[a] & x) >= 70 * len(sets[a] | x) for b, x in enumerate(sets) if b != a) for a in range(len(sets))}
    got = {r["doc_id"]: r["n_similar"] for r in ngram_join.linked_documents(frame(spark, rows).repartition(3)).collect()}
    assert got == want and sum(want.values()) > 500


@pytest.mark.parametrize("side", [512, 5])
def test_ngram_join_writes_no_pair_inside_a_group(spark, monkeypatch, side):
    """Near copies of two texts, some edited too far for their center, exact copies and a mixture of both."""
    for name, value in (("GROUP", 6), ("SIDE", side), ("DIFFERENCES", 200 * side)):
        monkeypatch.setattr(ngram_join, name, value)
    rng = random.Random(4)
    word = lambda: f"w{rng.randrange(5000)}"
    texts, bases = [], [[word() for _ in range(90)] for _ in range(2)]
    for base in bases:
        for k in range(60):
            copy = list(base)
            for _ in range(rng.randrange(9) if k % 6 == 0 else rng.randrange(4)):
                copy[rng.randrange(90)] = word()
            texts += [copy] * (1 + k % 2)
    for _ in range(30):  # a family between two groups
        copy = list(bases[0])
        for at in (7, 23, 41, 59, 77, *(rng.randrange(90) for _ in range(rng.randrange(3)))):
            copy[at] = f"v{at}"
        texts.append(copy)
    texts += [bases[0] + bases[1][:30], bases[0][:70] + bases[1][70:], [word() for _ in range(40)]]
    rows = [(k, " ".join(t), "s") for k, t in enumerate(texts)]
    sets = [shingle_set(t) for _, t, _ in rows]
    links = [[b for b, x in enumerate(sets) if b != a and 100 * len(s & x) >= 70 * len(s | x)] for a, s in enumerate(sets)]
    docs = frame(spark, rows).repartition(3)
    got = {r["doc_id"]: (r["n_similar"], r["component_id"]) for r in ngram_join.linked_documents(docs).collect()}
    for a, _, _ in rows:
        seen, todo = {a}, [a]
        while todo:
            new = set(links[todo.pop()]) - seen
            seen |= new
            todo += new
        assert got[a] == (len(links[a]), min(seen))
    found = ngram_join.similar(docs)
    different = sum(sets[a] != sets[b] for a, own in enumerate(links) for b in own)
    assert found.groups.count() > 80 and found.inner.count() > 80
    assert 0 < found.links.count() < different / 4


def test_empty_tables(spark, docs):
    none = docs.limit(0)
    assert ngram_join.linked_documents(none).count() == 0 and ngram_join.keep_one(none).columns == docs.columns
    assert exact_dedup.dedup(none).count() == 0 and exact_dedup.keep_first(none).count() == 0 and line_quality.judge(none).count() == 0
    assert lm_scoring.score(none, lm_scoring.train(none, order=3)).count() == 0


def test_components_of_a_long_path(spark):
    n = 40
    links = spark.createDataFrame([(k, k + 1) for k in range(n)] + [(100, 101)], "a long, b long")
    got = {r["node"]: r["root"] for r in ngram_join.components(Workspace(spark, "path"), links).collect()}
    assert got == {k: 0 for k in range(n + 1)} | {100: 100, 101: 100}


def test_line_quality(spark, docs):
    got = line_quality.judge(docs).collect()
    want = Counter()
    for i, t, _ in corpus():
        w = WS.findall(t or "")
        windows = Counter(tuple(w[k : k + 3]) for k in range(len(w) - 2))
        covered = {k + j for k in range(len(w) - 2) if windows[tuple(w[k : k + 3])] > 1 for j in range(3)}
        want[i, len(w), sum(map(len, w)), len(covered), len(w) < 50 or 100 * len(covered) > 50 * len(w)] += 1
    assert Counter((r["doc_id"], r["n_words"], r["word_chars"], r["n_repeat_words"], r["base_failed"]) for r in got) == want
    rng = random.Random(2)
    prose = "\n".join(" ".join(f"word{rng.randrange(10_000)}" for _ in range(12)) + "." for _ in range(12))
    menu = "\n".join("Home | News | Sport | Login | Help" for _ in range(30))
    r = {x["doc_id"]: x for x in line_quality.judge(frame(spark, [(1, prose, "s"), (2, prose + "\nAll rights reserved.", "s"), (3, menu + "\n" + prose[:80], "s")])).collect()}
    assert r[1]["kept"] and r[2]["kept"] and "rights" not in r[2]["clean_text"] and not r[3]["kept"] and r[3]["n_dup_lines"] == 29


def test_mix(spark, docs):
    labels = spark.createDataFrame([(1, 1), (2, 0), (1, 0), (None, 1)], "doc_id long, quality int")
    got = mixing.mix(docs, mixing.label_weights(labels)).collect()
    again = mixing.mix(docs.repartition(5), mixing.label_weights(labels)).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, again)) and len(got) == len(corpus())
    sizes = Counter()
    for _, t, s in corpus():
        sizes[s] += len(WS.findall(t or ""))
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weights = {s: k % 3 + 1 for k, s in enumerate(names)}
    target, stopped = {}, set()
    while True:
        rest = sum(sizes.values()) - sum(3 * sizes[s] for s in stopped)
        level = rest / sum(w for s, w in weights.items() if s not in stopped)
        over = {s for s in names if s not in stopped and level * weights[s] > 3 * sizes[s]}
        if not over:
            break
        stopped |= over
    target = {s: 3.0 * sizes[s] if s in stopped else level * weights[s] for s in names}
    taken = Counter()
    for r in got:
        taken[r["source"]] += r["taken"]
        assert abs(r["target"] - target[r["source"]]) < 1e-6 and 0 <= r["taken"] <= 3 * r["size"]
    assert all(abs(taken[s] - target[s]) <= 0.5 for s in names)
    made = mixing.mixed(docs, None)
    assert made.columns == docs.columns
    assert sum(len(WS.findall(r["text"])) for r in made.collect()) == sum(r["taken"] for r in mixing.mix(docs).collect())
    assert mixing.mix(docs.limit(0)).count() == 0
    texts = [t for _, t, _ in corpus() if t]
    assert all(any(t.startswith(r["text"]) for t in texts) for r in made.collect())


def test_packing(docs):
    path = tokenizer_path("word_bpe_49k.json")
    whole = library("word_bpe_49k.json")
    got = packing.packed(docs, path, 128).collect()
    want = Counter()
    for i, t, _ in corpus():
        ids = whole([t or ""])[0] + bytes(4)
        for k in range(0, len(ids), 512):
            want[i, k // 512, k // 4, len(ids[k : k + 512]) // 4, zlib.crc32(ids[k : k + 512])] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == want
    bins = defaultdict(list)
    for r in got:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 128
    assert len(bins) <= 1.1 * sum(r["length"] for r in got) / 128 + 2
    assert packing.packed(docs.limit(0), path).count() == 0
    joined = {r["sequence_id"]: r["ids"] for r in packing.sequences(packing.packed(docs, path, 128)).collect()}
    assert sum(map(len, joined.values())) == sum(r["length"] for r in got)


def test_sum_of_squares_by_brute_force():
    rng = np.random.default_rng(0)
    lengths = rng.integers(1, 21, 300)
    bins, offsets, n = packing.sum_of_squares(lengths, 20)
    gaps, where = {}, []
    for s in lengths.tolist():
        count = Counter(g for g in gaps.values() if 0 < g < 20)
        options = sorted({g for g in gaps.values() if g >= s})
        cost = lambda g, c=count, s=s: sum(v * v for v in (c - Counter({g: 1} if g < 20 else {}) + Counter({g - s: 1} if g > s else {})).values())
        best = min([*options, 20], key=lambda g: (cost(g), g))
        where.append((best, cost(best)))
        b = next((b for b, g in gaps.items() if g == best), len(gaps)) if best in options else len(gaps)
        gaps[b] = best - s
    assert len(gaps) == n and np.bincount(bins, weights=lengths).max() <= 20


def library(name):
    """Ids by a tokenizer of its own, read with the library's defaults."""
    from tokenizers import Tokenizer

    made = Tokenizer.from_file(tokenizer_path(name))
    return lambda texts: [np.array(made.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]


def test_encoder_equals_the_library():
    odd = ["", " ", " a", "a ", "a  b", "a\n\n b", "é́ é", "İΣ ﬁ", "\x1cfoo \x85bar", "<|endoftext|> it's", "a <|EndOfText|> b", "<|startoftext|>", "x　y", "end.\nNext, line", "a|b", "日本 語", "​z", "\n", "a\rb", "ÀÉ Ñandu. über", "x " * 3000, "a\nb c\nd"]
    rng = random.Random(1)
    odd += ["".join(rng.choice("ab \n.É'1\t\x1c|<") for _ in range(rng.randrange(30))) for _ in range(500)]
    for name in ("byte_bpe_50k.json", "word_bpe_49k.json"):
        e, want = tokens.Encoder(tokenizer_path(name), entries=5), library(name)(odd)
        for _ in range(3):
            assert e.encode(odd) == want
        assert e.encode([]) == []


def test_token_files(docs):
    path = tokenizer_path("byte_bpe_50k.json")
    whole = library("byte_bpe_50k.json")
    got = repair.read(repair.write(docs, path)).collect()
    ids = {i: whole([t or ""])[0] + bytes(4) for i, t, _ in corpus()}
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got if r["doc_id"] is not None) == Counter((i, len(ids[i]) // 4, zlib.crc32(ids[i])) for i, _, _ in corpus() if i is not None)
    at = 0
    ordered = sorted(got, key=lambda r: r["start"])
    for r in ordered:
        assert r["start"] == at
        at += r["n_tokens"]
    known = [r["doc_id"] for r in ordered if r["doc_id"] is not None]
    assert known == sorted(known)
    assert repair.read(repair.write(docs.limit(0), path)).count() == 0


def test_repair_round_trip():
    rng = np.random.default_rng(1)
    for top in (5, 300, 70_000):
        parts = [rng.integers(1, top, rng.integers(0, 400)).astype("<u4") for _ in range(40)]
        parts = [np.append(np.tile(p, 3), 0).astype("<u4") for p in parts]
        file = repair.TokenFile(repair.write_file(list(range(40)), [p.tobytes() for p in parts], 0))
        for k, p in enumerate(parts):
            assert (file.ids(k) == p).all()
            a = len(p) // 3
            assert (file.ids(k, a, a + 7) == p[a : a + 7]).all()
    assert repair.TokenFile(repair.write_file([None], [bytes(4)], 0)).doc_ids == [None]


def test_repair_leaves_no_pair_that_pays():
    rng = np.random.default_rng(4)
    passage = rng.integers(1, 40_000, 3000)
    ids = np.concatenate([np.append(np.concatenate([passage, rng.integers(1, 40_000, 500)]), 0) for _ in range(30)])
    symbols, rules = repair.compress(ids, 0)
    base = int(ids.max()) + 1
    assert (repair.expand(symbols, rules, base) == ids).all() and len(symbols) < 30 * 510
    assert repair.expansion_lengths(rules, base).max() > 500
    left = Counter((a, b) for a, b in zip(symbols[:-1].tolist(), symbols[1:].tolist(), strict=True) if a and b)
    # pairs of the slot that is never counted may be left
    assert sum(n for n in left.values() if n >= 8) < 100


def test_sharding(spark, docs):
    rows = [(i, "t" * (1 + i % 50), "s") for i in range(2000)] + [(5000 + i, "copy", "s") for i in range(1500)]
    got = sharding.assign(frame(spark, rows)).collect()
    size = Counter()
    for r in got:
        size[r["shard"]] += r["size"]
        assert r["size"] == len(dict((i, t) for i, t, _ in rows)[r["doc_id"]]) + 1 if r["doc_id"] < 3 else True
    ideal = sum(size.values()) / 16
    assert set(size) == set(range(16)) and max(abs(v - ideal) for v in size.values()) < 0.1 * ideal
    slots = defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    same = sharding.assign(frame(spark, [(1, "same", "s")] * 320)).groupBy("shard").count().collect()
    assert len(same) == 16 and all(r["count"] == 20 for r in same)
    assert sharding.assign(docs).count() == len(corpus()) and sharding.assign(docs.limit(0)).count() == 0


def test_sharding_writes_folders(spark, docs, tmp_path):
    """All columns come back, also those whose names the operator uses."""
    wide = docs.withColumns({"k1": F.lit(7), "k2": F.lit("z")})
    sharding.write(wide, str(tmp_path / "out"), 4)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert set(back.columns) == {*wide.columns, "shard_"}
    assert Counter(back.select(*wide.columns).collect()) == Counter(wide.collect())


def test_sharding_by_brute_force(spark):
    """Shards follow the order of (text hash, id); each cut is as near to its goal as a cut at a text can be, or within tolerance."""
    rng = random.Random(3)
    rows = [(i, "x" * rng.randrange(1, 300) + str(i % 900), "s") for i in range(3000)]
    data = frame(spark, rows)
    got = {r["doc_id"]: r for r in sharding.assign(data, 8, 0.01).collect()}
    keys = sorted((r["k0"], r["k1"], r["doc_id"]) for r in sharding.sized(data).collect())
    sizes = {i: len(t.encode()) + 1 for i, t, _ in rows}
    total = sum(sizes.values())
    order = [got[i]["shard"] for *_, i in keys]
    assert order == sorted(order) and set(order) == set(range(8))
    for shard in range(8):
        own = [i for *_, i in keys if got[i]["shard"] == shard]
        assert sorted(got[i]["slot"] for i in own) == list(range(len(own)))
    texts = dict((i, t) for i, t, _ in rows)
    for k in range(1, 8):
        below = sum(sizes[i] for i in got if got[i]["shard"] < k)
        ends, at, last = [0], 0, None
        for h, _, i in keys:
            if last is not None and h != last:
                ends.append(at)
            at, last = at + sizes[i], h
        best = min(abs(e - total * k / 8) for e in [*ends, at])
        assert abs(below - total * k / 8) <= max(0.01 * total / 8, best) + 1e-6
    assert all(zlib.crc32(texts[i].encode()) == got[i]["text_crc32"] and sizes[i] == got[i]["size"] for i in got)


def brute_spans(t):
    found = []
    for k, p in enumerate((r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")):
        for m in re.finditer(p, t):
            d = re.sub("[^0-9]", "", m[0])
            if k == 0 or (k == 1 and all(int(x) <= 255 for x in m[0].split("."))) or (k == 2 and 14 <= len(d) <= 19 and pii._luhn(d)) or (k == 3 and 10 <= len(d) <= 15):
                found.append((m.start(), k, m.end()))
    return sorted(found)


def test_pii_against_the_patterns():
    rng = random.Random(3)
    for _ in range(4000):
        t = "".join(rng.choice("ab@.-+% 0123456789()é") for _ in range(rng.randrange(40)))
        assert pii.base_spans(t) == brute_spans(t), t
    card = "4929 1234-5678 9015"
    for t in (card, "a@b.c@d.e", "1.2.3.4.5.6.7.8", "+1 (736) 555-2678", "@" * 1000, "9" * 5000, "a" * 5000 + "@", "0000255.1.1.1", "1.2.3.256"):
        assert pii.base_spans(t) == brute_spans(t), t


def test_sanitise(spark, docs):
    lines = [f"mail boss@corp.com about falcon item {k}" for k in range(6)]
    rows = [(k, t, "s") for k, t in enumerate(lines)] + [(10 + k, f"plain words about item {k} here", "s") for k in range(200)] + [(900, None, "s"), (901, "boss@corp.com\nfalcon alone", "s")]
    got = {r["doc_id"]: r for r in pii.sanitise(frame(spark, rows)).collect()}
    assert got[0]["n_email"] == 1 and got[0]["n_term"] == 2 and "falcon" not in got[0]["sanitised"] and "about" in got[0]["sanitised"] and "boss" not in got[0]["sanitised"]
    assert got[901]["n_term"] == 1 and got[10]["n_term"] == 0 and got[10]["sanitised"] == rows[6][1]
    assert got[900]["spans"] == "" and got[900]["base_sha256"] == hashlib.sha256(b"").hexdigest()
    assert pii.sanitise(docs, with_text=False).count() == len(corpus()) and pii.sanitise(docs.limit(0)).count() == 0


def brute_terms(texts, rule):
    """For each text, the spans of terms that give one of its entities away, by plain counts over lines and texts."""
    z, least = rule.deviations, rule.generalise
    best = {}
    for units in ([line for t in texts for line in t.split("\n")], texts):
        told = [({pii.entity(u, s) for s in pii.base_spans(u)}, {t for _, _, t in pii.outside(u, pii.base_spans(u))}, u) for u in units]
        n_e, n_t, n_te, different = Counter(), Counter(), Counter(), defaultdict(set)
        for es, ts, u in told:
            n_e.update(es)
            n_t.update(ts)
            for e in es:
                for t in ts:
                    n_te[e, t] += 1
                    different[e, t].add(u)
        for (e, t), n in n_te.items():
            p = n / n_t[t]
            m = len(different[e, t]) / p
            low = (p + z * z / (2 * m) - z * np.sqrt(p * (1 - p) / m + z * z / (4 * m * m))) / (1 + z * z / m)
            share = 1 + np.log(max(low, 1e-300)) / np.log(max(2.0, len(units) / n_e[e]))
            if share >= least:
                best[e, t] = max(share, best.get((e, t), 0))
    out = []
    for text in texts:
        spans = pii.base_spans(text)
        es = {pii.entity(text, s) for s in spans}
        out.append([(a, b) for a, b, t in pii.outside(text, spans) if any((e, t) in best for e in es)])
    return out


def test_sanitise_by_brute_force(spark):
    rng = random.Random(12)
    words = [f"v{k}" for k in range(120)] + ["Zoë's", "ÉTÉ", "x-1"]
    mails = [f"p{k}@corp.org" for k in range(8)] + ["10.0.0.7", "+1 (736) 555-2678"]
    texts = []
    for _ in range(250):
        lines = []
        for _ in range(rng.randrange(1, 5)):
            line = [rng.choice(words) for _ in range(rng.randrange(1, 9))]
            for _ in range(rng.randrange(3) if rng.random() < 0.3 else 0):
                k = min(rng.randrange(10), rng.randrange(10))
                line += [mails[k], f"near{k}"]
            lines.append(" ".join(line))
        texts.append("\n".join(lines))
    texts += texts[:20]
    want = brute_terms(texts, pii.Disclosure())
    got = {r["doc_id"]: r["spans"] for r in pii.sanitise(frame(spark, [(k, t, "s") for k, t in enumerate(texts)]).repartition(3), with_text=False).collect()}
    found = [[tuple(map(int, x.split(":")[1:])) for x in got[k].split(",") if x.startswith("term:")] for k in range(len(texts))]
    assert found == want and 50 < sum(map(len, want)) < 3000


def test_sanitise_a_long_line_of_addresses(spark):
    line = " ".join(f"user{k}@host{k % 50}.org word{k}" for k in range(20_000))
    rows = [(1, line, "s"), (2, "plain", "s"), (3, "user5@host5.org word5 here", "s")]
    got = {r["doc_id"]: r for r in pii.sanitise(frame(spark, rows), with_text=False).collect()}
    assert got[1]["n_email"] == 20_000 and got[2]["n_term"] == 0 and got[1]["spans"].count("email:") == 20_000


def test_term_keys_are_those_of_spark(spark):
    odd = ["", "a", "straße", "ΑΣ", "日本語" * 20, "x" * 1000]
    rows = spark.createDataFrame([(t,) for t in odd], "t string").select("t", F.xxhash64("t").alias("h"), F.lower("t").alias("low")).collect()
    assert [(pii.term_key(r["t"]), r["t"].lower()) for r in rows] == [(r["h"], r["low"]) for r in rows]


def test_rare_terms_give_an_entity_away(spark):
    """Two texts, another line, a term with a digit and hyphen, and one of two letters; ids that are null."""
    rows = [(1, "write to anna@x.org now\n\nsite K-9, by ox plain", "s"), (None, "anna@x.org wrote\nof ox and k-9 plain", "s")]
    rows += [(10 + k, f"plain words to {k} here, now and of by site wrote write", "s") for k in range(1000)]
    got = {r["doc_id"]: r for r in pii.sanitise(frame(spark, rows)).collect()}
    assert len(got) == len(rows) and got[1]["n_term"] == got[None]["n_term"] == 2 and sum(r["n_term"] for r in got.values()) == 4
    assert got[1]["sanitised"] == "write to [email] now\n\nsite [term], by [term] plain"
    copies = [(k, rows[0][1], "s") for k in range(2)] + rows[2:]
    assert {r["n_term"] for r in pii.sanitise(frame(spark, copies), with_text=False).collect()} == {0}


def test_elias_fano():
    rng = np.random.default_rng(0)
    for v in (np.sort(rng.integers(0, 2**64 - 1, 3000, dtype=np.uint64)), np.sort(rng.integers(0, 50, 900, dtype=np.uint64)), np.array([0, 0, 7], np.uint64), np.array([], np.uint64)):
        e = EliasFano.build(v)
        assert (e.get(np.arange(len(v))) == v).all()
        q = np.concatenate([v, rng.integers(0, 2**64 - 1, 500, dtype=np.uint64), np.arange(60, dtype=np.uint64)])
        at = e.find(q)
        assert ((at >= 0) == np.isin(q, v)).all() and (v[at[at >= 0]] == q[at >= 0]).all()


def test_lm_scores(docs):
    got = lm_scoring.score(docs, lm_scoring.train(docs)).collect()
    toks = lambda t: [*WS.findall(low(t)), ""]
    held = lambda i: zlib.crc32(str(i if i is not None else "").encode()) % 10 == 0
    uni, bi = Counter(), Counter()
    for i, t, _ in corpus():
        if not held(i):
            uni.update(toks(t))
            bi.update(zip(["", *toks(t)], toks(t), strict=False))
    n, v = sum(uni.values()), len(uni)
    p = lambda w: (uni[w] + 0.1) / (n + 0.1 * (v + 1))
    want = defaultdict(list)
    for i, t, _ in corpus():
        ws = toks(t)
        want[i].append((held(i), len(ws), sum(w in uni for w in ws), sum(np.log10(p(w)) for w in ws), sum(np.log10((bi[u, w] + 50 * p(w)) / (uni[u] + 50)) for u, w in zip(["", *ws], ws, strict=False))))
    assert len(got) == len(corpus())
    for i in want:
        for a, b in zip(sorted(want[i]), sorted((r["held_out"], r["n_tokens"], r["n_known"], r["base_score"], r["score"]) for r in got if r["doc_id"] == i), strict=True):
            assert a[:3] == b[:3] and abs(a[3] - b[3]) < 1e-6 and abs(a[4] - b[4]) < 2e-4 * a[1]
    assert {r["train_tokens"] for r in got} == {n}


@pytest.mark.parametrize("order", [3, 4])
def test_lm_scores_of_longer_contexts(spark, order):
    rng = random.Random(5)
    shared = " ".join(rng.choice("abcdefgh") for _ in range(300))
    rows = [(k, t, "s") for k, t in enumerate([" ".join(rng.choice("abcdefgh") for _ in range(rng.randrange(40))) for _ in range(60)] + [shared] * 15 + [None, "", "a", "new words only"])]
    docs = frame(spark, rows).repartition(3)
    got = {r["doc_id"]: r for r in lm_scoring.score(docs, lm_scoring.train(docs, order=order)).collect()}
    toks = lambda t: [*(t or "").split(), ""]
    held = lambda i: zlib.crc32(str(i).encode()) % 10 == 0
    seen, follow = Counter(), Counter()
    for _, t, _ in (r for r in rows if not held(r[0])):
        ws = ["", *toks(t)]
        for k in range(1, len(ws)):
            for n in range(min(order - 1, k) + 1):
                seen[tuple(ws[k - n : k + 1])] += 1
                follow[tuple(ws[k - n : k])] += 1
    types = len([g for g in seen if len(g) == 1])

    def p(ws):
        if len(ws) == 1:
            return (seen[ws] + 0.1) / (follow[()] + 0.1 * (types + 1))
        return (seen[ws] + 50 * p(ws[1:])) / (follow[ws[:-1]] + 50)

    assert any(seen[g] > 5 for g in seen if len(g) == order) and len({held(i) for i, _, _ in rows}) == 2
    for i, t, _ in rows:
        ws = ["", *toks(t)]
        want = sum(np.log10(p(tuple(ws[max(0, k - order + 1) : k + 1]))) for k in range(1, len(ws)))
        assert abs(got[i]["score"] - want) < 2e-4 * len(ws), (i, got[i]["score"], want)


def test_clauses_by_brute_force():
    """The composed machine against the rules read straight from the words of a clause."""
    rng = random.Random(8)
    symbols = [toxicity.OTHER, toxicity.INSULT, toxicity.THREAT, toxicity.TARGET, toxicity.NEGATION, toxicity.REPORT]
    for _ in range(3000):
        clause = [rng.choice(symbols) if rng.random() < 0.5 else toxicity.OTHER for _ in range(rng.randrange(1, 60))]
        weights = [rng.choice([1.0, 2.5]) for _ in clause]
        want = [0.0] * 5
        aimed = toxicity.TARGET in clause
        for k, (s, w) in enumerate(zip(clause, weights, strict=True)):
            if s not in (toxicity.INSULT, toxicity.THREAT) or (s == toxicity.THREAT and not aimed):
                continue
            w *= (1.0, 0.7, 0.5)[min(2, clause[:k].count(s))]
            negated, reported = toxicity.NEGATION in clause[max(0, k - 3) : k], toxicity.REPORT in clause[:k]
            want[2 if negated else 3 if reported else 4 if s == toxicity.THREAT else 1 if aimed else 0] += w
        got = [0.0] * 5
        toxicity.clause_matches(clause, weights, got)
        assert np.allclose(got, want), clause


def test_long_clauses_are_read_whole():
    model = toxicity.Model({"idiot$": 5.0}, toxicity.PRIOR.copy(), -2.0)
    match = lambda t: dict(zip(toxicity.MATCHES, model.features(t), strict=True))
    assert match("you " + "word " * 500 + "idiot")["targeted"] == 5 and match("idiot " + "word " * 500 + "you")["targeted"] == 5
    assert match("they said that " + "word " * 500 + "idiot")["reported"] == 5 and match("kill " + "word " * 99 + "you.")["threat"] == 1


def test_toxicity_grammar_and_learning(spark):
    model = toxicity.Model({"idiot$": 5.0}, toxicity.PRIOR.copy(), -2.0)
    match = lambda t: dict(zip(toxicity.MATCHES, model.features(t), strict=True))
    assert match("what an idiot.")["insult"] == 5 and match("you are an idiot.")["targeted"] == 5
    assert match("she is not an idiot.")["negated"] == 5 and match("they said it was idiot.")["reported"] == 5
    assert match("i will kill you.")["threat"] == 1 and match("kill the process.")["threat"] == 0
    assert match("not here. an idiot.")["insult"] == 5 and sum(match("").values()) == 0
    rng = random.Random(5)
    fill = [f"word{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(300)]
    rows, labels = [], []
    for i in range(600):
        words = [rng.choice(fill) for _ in range(40)]
        bad = i % 5 == 0
        if bad:
            for _ in range(4):
                words[rng.randrange(40)] = rng.choice(["grobnik", "vlitz", "snorf"])
        rows.append((i, " ".join(words) + ".", "s"))
        labels.append((i, 1, int(bad)))
    rows += [(None, None, None), (700, "", "s"), (None, "grobnik vlitz snorf grobnik vlitz snorf word.", "s")]
    frame_ = frame(spark, rows)
    marked = spark.createDataFrame([*labels, (None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int")
    got = toxicity.score(frame_, toxicity.train(frame_, marked)).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    out = [(r["predicted"], r["doc_id"] % 5 == 0) for r in got if r["held_out"] and r["doc_id"] is not None and r["doc_id"] < 600]
    assert out and sum(a == b for a, b in out) / len(out) > 0.95
    kept = toxicity.keep_clean(frame_, marked)
    assert kept.columns == frame_.columns and 460 <= kept.count() <= 500
    assert kept.where("text like 'grobnik vlitz%'").count() == 0 and kept.where("doc_id is null and text is null").count() == 1
    assert toxicity.score(frame_, toxicity.train(frame_.limit(0), marked)).count() == len(rows)


def test_running_sum(spark):
    rows = spark.createDataFrame([("a" if k % 3 else None, k, k % 7) for k in range(500)], "g string, o int, v int")
    got = running_sum(Workspace(spark, "sum"), rows, ["g"], ["o"], "v", "rows", per_part=40).collect()
    sums = Counter()
    for r in sorted(got, key=lambda r: r["o"]):
        assert r["before"] == sums[r["g"]]
        sums[r["g"]] += r["v"]
    assert len(got) == 500


def test_a_missing_trie_file_raises(spark):
    import glob
    import os

    docs = frame(spark, [(k, f"a b c w{k}", "s") for k in range(30)])
    trie = lm_scoring.train(docs, order=3)
    for path in glob.glob("/" + trie.folder.split(":", 1)[-1].lstrip("/") + "/grams-2-*"):
        os.remove(path)
    with pytest.raises(Exception, match="grams-2"):
        lm_scoring.score(docs, replace(trie, concentration=7.0, folder=trie.folder + "/.")).collect()
