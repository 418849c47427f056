import numpy as np

from lexmill.llm import toxicity


def test_fit_sees_all_labels(spark, monkeypatch):
    """Labels past the 40,000 that were once enough still move the model: a word of few toxic documents is learned."""
    rows = [(k, f"plain words number{k % 7} here." if k % 40 else f"you zorbid number{k % 7} here.") for k in range(60_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(k, int(k % 40 == 0)) for k, _ in rows], "doc_id long, toxic int")
    seen = []
    derivatives = toxicity._derivatives
    monkeypatch.setattr(toxicity, "_derivatives", lambda r, v: seen.append(r.agg({"n": "sum"}).first()[0]) or derivatives(r, v))
    model = toxicity.train(docs, labels)
    known = docs.where(~toxicity.held_out(docs.doc_id)).count()
    assert known > 45_000 and seen[0] > 0.48 * known
    assert "zorbid$" in model.lexicon and model.score("you zorbid.") > 0.5 > model.score("plain words.")


def test_sums_of_workers_equal_those_of_one_array(spark):
    rng = np.random.default_rng(1)
    x, y, n = rng.random((50, 5)), rng.integers(0, 2, 50), rng.integers(1, 4, 50)
    rows = spark.createDataFrame([(int(a), b.tolist(), int(c)) for a, b, c in zip(y, x, n)], "toxic int, features array<double>, n long").repartition(3)
    v = rng.normal(size=6)
    loss, gradient, second = toxicity._derivatives(rows, v)
    x1 = np.column_stack([np.log1p(x), np.ones(50)])
    p = 1 / (1 + np.exp(-x1 @ v))
    assert np.isclose(loss, -(n * (y * np.log(p) + (1 - y) * np.log(1 - p))).sum())
    assert np.allclose(gradient, x1.T @ (n * (p - y))) and np.allclose(second, (x1 * (n * p * (1 - p))[:, None]).T @ x1)
