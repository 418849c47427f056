"""Toxicity by a weighted finite-state grammar of clauses, with weights learned from labels."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.llm.common import Workspace, small_arrow_batches

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT, STOP = range(7)
SEEDS = {
    TARGET: "you your you're youre ur u yourself he she they them him her these those du dich dir ihr euch sie tu te toi vous ti usted ustedes vosotros",
    NEGATION: "not no never isn't aren't wasn't don't doesn't didn't won't nor neither without nicht kein keine nie niemals pas jamais aucun nunca jamás tampoco",
    REPORT: "said says say told called calls calling wrote writes quoted quote quotes claimed claims alleged reported reportedly according sagte sagt dijo dice dit disait selon según",
    THREAT: "kill murder hurt destroy strangle stab shoot burn beat smash punch slaughter töten umbringen tuer frapper matar golpear",
}
EDGE = ".,;:!?\"'()[]{}<>|*_#$%&~=+/-"
#: What the grammar tells apart in a clause.
MATCHES = ("insult", "targeted", "negated", "reported", "threat")
#: Weights before any label is seen; labels move them from here.
PRIOR = np.array([1.0, 1.4, 0.4, 0.5, 1.2])


@dataclass(frozen=True)
class Transducer:
    """``arcs[state, symbol] = (next state, output, weight)``; a symbol without an arc takes ``OTHER``'s, and ``final[state]`` is put out at a clause's end."""

    start: int
    arcs: dict[tuple[int, int], tuple[int, int, float]]
    final: dict[int, int] = field(default_factory=dict)

    def step(self, state: int, symbol: int) -> tuple[int, int, float]:
        return self.arcs.get((state, symbol)) or self.arcs[state, OTHER]


def repeated(symbol: int, weights: tuple[float, ...]) -> Transducer:
    """Output 1 at each ``symbol``: the k-th of a clause by the k-th weight, further ones by the last."""
    last = len(weights) - 1
    arcs = {(k, OTHER): (k, 0, 1.0) for k in range(last + 1)}
    return Transducer(0, arcs | {(k, symbol): (min(k + 1, last), 1, w) for k, w in enumerate(weights)})


def within(opener: int, reach: int) -> Transducer:
    """Output 1 for ``reach`` words after ``opener``, else 0. State k: words left."""
    arcs = {(k, OTHER): (max(0, k - 1), int(k > 0), 1.0) for k in range(reach + 1)}
    return Transducer(0, arcs | {(k, opener): (reach, int(k > 0), 1.0) for k in range(reach + 1)})


def since(opener: int) -> Transducer:
    """Output 1 for all words of the clause after ``opener``."""
    return Transducer(0, {(0, OTHER): (0, 0, 1.0), (0, opener): (1, 0, 1.0), (1, OTHER): (1, 1, 1.0)})


def anywhere(symbol: int) -> Transducer:
    """Output 1 at the clause's end if ``symbol`` was in it, before or after anything else."""
    return Transducer(0, {(0, OTHER): (0, 0, 1.0), (0, symbol): (1, 0, 1.0), (1, OTHER): (1, 0, 1.0)}, {1: 1})


def compose(parts: tuple[Transducer, ...]) -> tuple[dict[tuple[int, int], tuple[int, int, float]], dict[int, int]]:
    """The product: one state for all parts, their outputs as bits, their weights multiplied; and the bits at the end of a clause."""
    numbers: dict[tuple[int, ...], int] = {tuple(p.start for p in parts): 0}
    arcs: dict[tuple[int, int], tuple[int, int, float]] = {}
    todo = list(numbers)
    while todo:
        state = todo.pop()
        for symbol in range(STOP):
            steps = [p.step(s, symbol) for p, s in zip(parts, state, strict=True)]
            after = tuple(s for s, _, _ in steps)
            if after not in numbers:
                numbers[after] = len(numbers)
                todo.append(after)
            arcs[numbers[state], symbol] = numbers[after], sum(out << k for k, (_, out, _) in enumerate(steps)), math.prod(w for _, _, w in steps)
    return arcs, {n: sum(p.final.get(s, 0) << k for k, (p, s) in enumerate(zip(parts, state, strict=True))) for state, n in numbers.items()}


I_BIT, T_BIT, NEGATED, REPORTED, AIMED = (1 << k for k in range(5))
#: Insults and threats that go on in a clause count less each; negation reaches 3 words, reported speech to the clause's end, and a target is looked for in the whole clause.
GRAMMAR, FINAL = compose((repeated(INSULT, (1.0, 0.7, 0.5)), repeated(THREAT, (1.0, 0.7, 0.5)), within(NEGATION, 3), since(REPORT), anywhere(TARGET)))


def clause_matches(symbols: list[int], weights: list[float], out: list[float]) -> None:
    """Add the matched weights of one clause to ``out``, by the kinds of ``MATCHES``.

    The arcs put out insults and threats with what stands before them. The
    end's output tells whether the clause has a target: with one, an insult is
    a targeted one; without one, a threat is none, whatever stood before it.
    """
    state, insult, threat, others = 0, 0.0, 0.0, [0.0, 0.0, 0.0, 0.0]
    for symbol, weight in zip(symbols, weights, strict=True):
        state, bits, factor = GRAMMAR[state, symbol]
        if bits & (I_BIT | T_BIT):
            kind = 1 if bits & NEGATED else 2 if bits & REPORTED else 0
            if kind:
                others[kind - 1 + (2 if bits & T_BIT else 0)] += weight * factor
            elif bits & I_BIT:
                insult += weight * factor
            else:
                threat += weight * factor
    aimed = bool(FINAL[state] & AIMED)
    out[1 if aimed else 0] += insult
    out[2] += others[0] + (others[2] if aimed else 0)
    out[3] += others[1] + (others[3] if aimed else 0)
    out[4] += threat if aimed else 0


@dataclass
class Model:
    """A lexicon of words (``word$``) and beginnings of words with their weights, and the weights of matches."""

    lexicon: dict[str, float]
    weights: np.ndarray
    bias: float
    memo: dict[str, tuple[int, float]] = field(default_factory=dict)
    seeds: dict[str, int] = field(default_factory=lambda: {w: c for c, ws in SEEDS.items() for w in ws.split()})

    def _symbol(self, word: str) -> tuple[int, float]:
        bare = word.strip(EDGE)
        stop = 10 if word[-1] in ".!?;:|" else 0
        for key in features_of(bare):
            if key in self.lexicon:
                return INSULT + stop, self.lexicon[key]
        return self.seeds.get(bare, OTHER) + stop, 1.0

    def features(self, text: str) -> list[float]:
        """Summed weight of each kind of match over all clauses of the whole text."""
        out = [0.0] * len(MATCHES)
        words = text.lower().split()
        if len(self.memo) > 400_000:
            self.memo.clear()
        memo = self.memo
        for w in set(words).difference(memo):
            memo[w] = self._symbol(w)
        found = list(map(memo.__getitem__, words))
        done = -1
        for i in [i for i, (s, _) in enumerate(found) if s % 10 in (INSULT, THREAT)]:
            if i <= done:
                continue
            first = i
            while first > done + 1 and found[first - 1][0] < 10:
                first -= 1
            done = i
            while done < len(found) - 1 and found[done][0] < 10:
                done += 1
            clause = found[first : done + 1]
            clause_matches([s % 10 for s, _ in clause], [w for _, w in clause], out)
        return out

    def score(self, text: str) -> float:
        z = self.bias + float(np.dot(self.weights, np.log1p(self.features(text))))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def features_of(word: str) -> list[str]:
    """The word itself, then its beginnings from long to short."""
    return [f"{word}$", *(word[:k] for k in range(min(8, len(word)), 3, -1))] if word.isalpha() and len(word) >= 3 else []


def held_out(doc_id: Column) -> Column:
    """Documents whose labels are never seen: crc32 of the ``doc_id`` as text divides by 5; a null counts as empty text."""
    return F.crc32(F.encode(F.coalesce(doc_id.cast("string"), F.lit("")), "UTF-8")) % 5 == 0


def _counts(docs: DataFrame) -> DataFrame:
    """``feature, n``: documents that hold each feature; counted per batch, then summed."""
    out = pa.schema([("feature", pa.string()), ("n", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n: dict[str, int] = {}
            for text in batch[0].to_pylist():
                own = {f for w in {x.strip(EDGE) for x in set((text or "").lower().split())} for f in features_of(w)}
                for f in own:
                    n[f] = n.get(f, 0) + 1
            yield pa.RecordBatch.from_arrays([pa.array(list(n), pa.string()), pa.array(list(n.values()), pa.int64())], schema=out)

    return docs.select("text").mapInArrow(count, "feature string, n long").groupBy("feature").agg(F.sum("n").alias("n"))


def train(docs: DataFrame, labels: DataFrame, lexicon: int = 20_000, least: int = 4) -> Model:
    """Fit a model on all labelled documents but the held-out ones.

    One half, by a hash of ``doc_id``, gives the lexicon: words and beginnings
    of words in ``least`` or more toxic documents whose odds stand out from the
    rest, the ``lexicon`` clearest of them. The other half gives the weights of
    the matches, by logistic regression around ``PRIOR``. Both are summed by
    the workers, whatever the number of labels. Of rows that repeat a
    ``doc_id`` the first text counts. Without labels of both kinds the prior and an empty lexicon stay.
    """
    ws = Workspace(docs.sparkSession, "toxicity")
    known = labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic")).where(~held_out(F.col("doc_id")))
    known = ws.table(known.select("doc_id", "toxic", (F.xxhash64("doc_id", F.lit("half")) % 2 == 0).alias("half")), "known")
    # two numbers a row: 16 MB are broadcast at most
    known = F.broadcast(known) if known.count() <= 500_000 else known
    texts = ws.table(docs.select("doc_id", "text").join(known, "doc_id").groupBy("doc_id", "toxic", "half").agg(F.min("text").alias("text")), "texts")
    first = texts.where("half")
    n_pos, n_neg = (first.where(f"toxic = {k}").count() for k in (1, 0))
    pos = ws.table(_counts(first.where("toxic = 1")).where(F.col("n") >= least).withColumnRenamed("n", "p"), "pos")
    both = pos.join(_counts(first.where("toxic = 0")).withColumnRenamed("n", "q"), "feature", "left").withColumn("q", F.coalesce("q", F.lit(0)))
    value = F.log((F.col("p") + 0.5) / (n_pos + 1)) - F.log((F.col("q") + 0.5) / (n_neg + 1))
    odds = both.select("feature", value.alias("value"), (value - 1.64 * F.sqrt(1 / (F.col("p") + 0.5) + 1 / (F.col("q") + 0.5))).alias("low")).where("low > 1.0")
    model = Model({r["feature"]: r["value"] for r in odds.orderBy(F.desc("low"), "feature").limit(lexicon).collect()}, PRIOR.copy(), -2.0)
    rows = ws.table(_features(texts.where("not half"), model).groupBy("toxic", "features").agg(F.count(F.lit(1)).alias("n")), "features")
    if rows.select("toxic").distinct().count() == 2:
        _fit(model, lambda v: _derivatives(rows, v))
    return model


def _features(texts: DataFrame, model: Model) -> DataFrame:
    out = pa.schema([("toxic", pa.int32()), ("features", pa.list_(pa.float64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array(b[0].to_pylist(), pa.int32()), pa.array([model.features(t or "") for t in b[1].to_pylist()], out.types[1])], schema=out)

    return texts.select("toxic", "text").mapInArrow(run, "toxic int, features array<double>")


def _derivatives(rows: DataFrame, v: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Logistic loss of ``toxic, features, n`` at ``v`` (the bias last), its gradient and its second derivatives; summed by the workers."""
    size = len(v)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros(1 + size + size * size)
        for b in batches:
            y, n = b[0].to_numpy().astype(float), b[2].to_numpy()
            x = np.column_stack([np.log1p(b[1].flatten().to_numpy().reshape(-1, size - 1)), np.ones(len(y))])
            z = x @ v
            p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            out += np.concatenate([[n @ np.logaddexp(0, z) - (n * y) @ z], x.T @ (n * (p - y)), ((x * (n * p * (1 - p))[:, None]).T @ x).ravel()])
        yield pa.RecordBatch.from_arrays([pa.array([out.tolist()], pa.list_(pa.float64()))], names=["sums"])

    sums = np.sum([r["sums"] for r in rows.mapInArrow(run, "sums array<double>").collect()], axis=0)
    return float(sums[0]), sums[1 : 1 + size], sums[1 + size :].reshape(size, size)


def _fit(model: Model, derivatives: Callable[[np.ndarray], tuple[float, np.ndarray, np.ndarray]], strength: float = 2.0) -> None:
    """Newton steps, halved while they don't lower it, for the logistic loss with a Gaussian prior around the given weights."""
    start = np.append(PRIOR, -2.0)
    w, precision = start.copy(), np.diag(np.append(np.full(len(PRIOR), strength), 1e-3))

    def at(v: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        loss, gradient, second = derivatives(v)
        return loss + float((v - start) @ precision @ (v - start)) / 2, gradient + precision @ (v - start), second + precision

    now = at(w)
    for _ in range(50):
        step, size = np.linalg.solve(now[2], now[1]), 1.0
        if np.abs(step).max() < 1e-8:
            break
        after = at(w - step)
        while size > 1e-6 and after[0] > now[0]:
            size /= 2
            after = at(w - size * step)
        w, now = w - size * step, after
        if np.abs(size * step).max() < 1e-6:
            break
    model.weights, model.bias = w[:-1], float(w[-1])


def score(docs: DataFrame, model: Model) -> DataFrame:
    """One row per document: ``doc_id, held_out, score, predicted``.

    The score is that of the matched clauses of the whole text, 0 to 1; null
    and empty texts get the score of no match. Nothing but the text enters it.
    Repeated rows are scored one by one; other columns are ignored.
    """
    small_arrow_batches(docs.sparkSession)
    scores = _scores(docs.sparkSession, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = scores(b[2])
            yield pa.RecordBatch.from_arrays([b[0], b[1], pa.array(found, pa.float64()), pa.array([int(s >= 0.5) for s in found], pa.int32())], names=["doc_id", "held_out", "score", "predicted"])

    rows = docs.select(F.col("doc_id").cast("long"), held_out(F.col("doc_id")).alias("held_out"), "text")
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def _scores(spark: SparkSession, model: Model) -> Callable[[pa.Array], list[float]]:
    shared = spark.sparkContext.broadcast((model.lexicon, model.weights, model.bias))
    local: list[Model] = []

    def scores(texts: pa.Array) -> list[float]:
        if not local:
            local.append(Model(*shared.value))
        return [local[0].score(t or "") for t in texts.to_pylist()]

    return scores


def keep_clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the documents predicted toxic; all columns. Each row is judged by its own text, whatever its ``doc_id``."""
    small_arrow_batches(docs.sparkSession)
    scores = _scores(docs.sparkSession, train(docs, labels))
    text = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array([s < 0.5 for s in scores(b[text])], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
