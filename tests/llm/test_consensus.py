import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusmill.llm.consensus import consensus, named_spans, spectral_reliability, weighted_votes

LABELS = ["yes", "maybe", "no"]


def crowd(skills, items=400, seed=3):
    rng = np.random.default_rng(seed)
    truth = rng.choice(LABELS, items, p=[0.6, 0.2, 0.2])
    rows = []
    for i, t in enumerate(truth):
        for a, g in skills.items():
            if rng.random() < 0.6:
                rows.append((f"i{i}", a, str(t if rng.random() < g else rng.choice(LABELS, p=[0.6, 0.2, 0.2]))))
    return {f"i{i}": str(t) for i, t in enumerate(truth)}, rows


def test_reliability_and_labels(spark):
    skills = {"a": 0.9, "b": 0.85, "c": 0.7, "d": 0.2, "e": 0.1, "f": 0.05}
    truth, rows = crowd(skills)
    votes = spark.createDataFrame(rows, "item string, annotator string, label string")
    reliability = spectral_reliability(votes, LABELS)
    got = {r.annotator: r.reliability for r in reliability.collect()}
    assert all(abs(got[a] - g) < 0.15 for a, g in skills.items()), got
    final = {r["item"]: r.label for r in consensus(weighted_votes(votes, reliability, LABELS), LABELS).collect()}
    majority = {r["item"]: r.label for r in votes.groupBy("item", "label").count().groupBy("item").agg(F.max_by("label", "count").alias("label")).collect()}
    right = lambda labels: sum(truth[i] == x for i, x in labels.items())
    # The bar is what the same vote reaches with the annotators' true skills.
    true = F.coalesce(*[F.when(F.col("annotator") == a, F.lit(g)) for a, g in skills.items()])
    best = {r["item"]: r.label for r in consensus(weighted_votes(votes, reliability.withColumn("reliability", true), LABELS), LABELS).collect()}
    assert len(final) == len(majority) and right(final) > 1.1 * right(majority) and right(final) >= 0.98 * right(best)


@pytest.mark.parametrize("most_votes", [2, 3, 64])
def test_vector_equals_that_of_the_matrix(spark, most_votes):
    """Pair table, factored form of crowded items and both together give the leading eigenvector of the dense matrix."""
    _, rows = crowd({"a": 0.9, "b": 0.6, "c": 0.3, "d": 0.8}, items=60)
    votes = spark.createDataFrame(rows, "item string, annotator string, label string")
    got = {r.annotator: r for r in spectral_reliability(votes, LABELS, tolerance=1e-6, most_votes=most_votes).collect()}
    names = ["a", "b", "c", "d"]
    by = {n: {i: x for i, m, x in rows if m == n} for n in names}
    share = {n: np.array([list(by[n].values()).count(k) for k in LABELS]) / len(by[n]) for n in names}
    m, n = np.zeros((4, 4)), np.zeros((4, 4))
    for i, p in enumerate(names):
        for j, q in enumerate(names):
            if p != q:
                both = by[p].keys() & by[q].keys()
                n[i, j], m[i, j] = len(both), sum(by[p][x] == by[q][x] for x in both) - len(both) * (share[p] @ share[q])
    root = np.sqrt(n.sum(axis=1))
    values, vectors = np.linalg.eigh(m / np.outer(root, root))
    x = vectors[:, -1] * np.sign(vectors[:, -1].sum())
    assert np.allclose([got[a].vector for a in names], x, atol=1e-5)
    g = x / root
    g *= np.sqrt(g @ m @ g / (g**2 @ n @ g**2))
    assert np.allclose([got[a].centred for a in names], (m @ g + 0.5) / (n @ g**2 + 1), atol=1e-4)


def test_annotators_without_agreement(spark):
    """No common item, and pairs that never agree: the average, not an error."""
    alone = [(f"i{j}", "ab"[j % 2], "yes") for j in range(6)]
    apart = [(f"k{j}", a, x) for j in range(6) for a, x in zip("cde", LABELS)]
    for rows in (alone, apart, alone + apart):
        votes = spark.createDataFrame(rows, "item string, annotator string, label string")
        got = spectral_reliability(votes, LABELS).collect()
        assert len(got) == len({a for _, a, _ in rows}) and all(0.01 <= r.reliability <= 0.97 for r in got)


def test_details_join_their_votes(spark):
    rows = [("i", "a", "yes", None), ("i", "b", "yes", None), ("i", "c", "no", "x"), ("i", "d", "no", "x"), ("j", "a", "yes", None), ("j", "b", "yes", None), ("j", "c", "no", "x"), ("j", "d", "no", "y")]
    votes = spark.createDataFrame(rows, "item string, annotator string, label string, fix string")
    reliability = spark.createDataFrame([(a, 10, [0.6, 0.0, 0.4], 0.5, 0.5) for a in "abcd"], "annotator string, n_votes long, shares array<double>, centred double, reliability double")
    weighted = weighted_votes(votes, reliability, LABELS, detail="fix").withColumn("n_details", F.lit(30.0)).withColumn("extra", F.col("extra") + 2)
    got = {r["item"]: (r.label, r.fix) for r in consensus(weighted, LABELS, detail="fix", detailed="no").collect()}
    assert got["i"] == ("no", "x")


def test_empty_votes(spark):
    votes = spark.createDataFrame([], "item string, annotator string, label string")
    reliability = spectral_reliability(votes, LABELS)
    assert reliability.count() == 0 and consensus(weighted_votes(votes, reliability, LABELS), LABELS).count() == 0


def test_named_spans(spark):
    names = spark.createDataFrame([("Batteries & Storage",), ("Storage",), ("Law, Order & Gender",)], "name string")
    texts = spark.createDataFrame([(1, "Energy -> batteries and storage (optional)"), (2, "LAW, order & gender, if forced"), (3, "nothing"), (4, None), (5, "")], "k int, t string")
    got = {r.k: r["name"] for r in named_spans(texts, "t", names, "name", keys=["k"]).collect()}
    assert got == {1: "Batteries & Storage", 2: "Law, Order & Gender"}


def test_dirty_votes(spark):
    rows = [("i", "a", "yes", 1.0), ("i", "a", "yes", 1.0), ("i", "a", "maybe", 1.0), ("i", "b", "yes", 1.0), ("j", "b", "huh", 1.0), ("j", "b", None, 1.0), (None, "b", "yes", 1.0), ("k", None, "yes", 1.0)]
    votes = spark.createDataFrame(rows, "item string, annotator string, label string, weight double").withColumn("shares", F.lit(1)).withColumn("_i", F.lit(2))
    weighted = weighted_votes(votes, spectral_reliability(votes, LABELS), LABELS)
    got = consensus(weighted, LABELS).collect()
    assert [(r["item"], r.label, r.n_votes) for r in got] == [("i", "yes", 2)]
