from functools import partial

import numpy as np

from corpusmill.llm.subjects import OUTSIDE, Words, chosen_subjects, propagate_subjects

propagate = partial(propagate_subjects, most=0.5)  # with a handful of words each is in many documents
SCHEMA = "id string, title string, text string, hint string, at int"


def corpus(n=240, seed=5):
    """Three subjects with words of their own; a third of the hints is wrong or missing."""
    rng = np.random.default_rng(seed)
    words = {s: [f"{s}{w}" for w in ("alpha", "beta", "gamma", "delta", "epsilon")] for s in ("physics", "history", "botany")}
    names = sorted(words)
    rows, truth = [], {}
    for i in range(n):
        main = names[i % 3]
        second = names[(i + 1) % 3] if i % 5 == 0 else None
        say = lambda s: f"We discuss the {rng.choice(words[s])} of this general matter."
        body = [say(main) for _ in range(4)] + [say(second) for _ in range(3 if second else 0)] + ([say(names[(i + 2) % 3])] if i % 7 == 0 else [])
        hint = main if rng.random() < 0.66 else str(rng.choice(names)) if rng.random() < 0.5 else None
        rows.append((f"d{i}", f"On {rng.choice(words[main])}", " ".join(body), hint, 1))
        truth[f"d{i}"] = {main} | ({second} if second else set())
    return rows, truth


def test_subjects_are_found(spark):
    rows, truth = corpus()
    df = spark.createDataFrame(rows + [("void", None, None, None, 1), ("void2", "", "", "history", 1)], SCHEMA)
    seeds = spark.createDataFrame([(i, sorted(truth[i])[0]) for i in list(truth)[1:20:3] if len(truth[i]) == 1], "id string, subject string")
    got = {}
    for r in chosen_subjects(propagate(df, seeds, order="at")).collect():
        got.setdefault(r.id, set()).add(r.subject)
    right = sum(got.get(i) == t for i, t in truth.items())
    assert right >= 0.97 * len(truth) and "void" not in got


def test_latest_version_counts(spark):
    rows, truth = corpus(120)
    moved = [("d0", "On historyalpha", "We discuss the historybeta of it. We discuss the historygamma here.", None, 2), ("d0", "x", "y", None, None)]
    got = {r.subject for r in propagate(spark.createDataFrame(rows + moved, SCHEMA), order="at").where("id = 'd0'").collect()}
    assert got == {"history"}


def test_no_hints_and_no_rows(spark):
    rows, _ = corpus(6)
    bare = spark.createDataFrame([(a, b, c, None, e) for a, b, c, _, e in rows], SCHEMA)
    assert propagate(bare, order="at").count() == 0
    assert propagate(bare.limit(0), order="at").count() == 0
    assert OUTSIDE == "-"


def test_words():
    titles, texts = ["Flame stability. A note", None, "FLAME-STABILITY"], ["Stability of <b class='x'>flames</b> matters. It is so.", None, None]
    words, document, sentence = Words().batch(titles, texts)
    of = lambda d, s: set(words[(document == d) & (sentence == s)])
    assert of(2, 0) < of(0, 0) and len(of(2, 0)) == 2 and 1 not in set(document)
    assert of(0, 0) & of(0, 1) == of(2, 0) and set(sentence[document == 0]) == {0, 1}
    assert len(Words().batch([], [])[0]) == 0


def test_broadcast_and_shuffle_give_the_same(spark):
    rows, truth = corpus(90)
    df = spark.createDataFrame(rows, SCHEMA)
    few, many = (sorted(map(tuple, propagate(df, order="at", broadcast_nodes=n).collect())) for n in (1_000_000, 0))
    assert few == many and few


def test_stray_labels_of_a_rare_subject_verify_nothing(spark):
    """A subject that only has wrong hints, spread over the documents of others, gets no document."""
    rows, truth = corpus(300)
    stray = [(i, t, x, "stray" if n % 25 == 0 else h, a) for n, (i, t, x, h, a) in enumerate(rows)]
    got = propagate(spark.createDataFrame(stray, SCHEMA), order="at")
    assert got.where("subject = 'stray'").count() == 0


def test_seeds_are_in_the_result(spark):
    rows, truth = corpus(120)
    seed = next(i for i, t in truth.items() if t == {"physics"})
    seeds = spark.createDataFrame([(seed, "botany"), ("absent", "botany")], "id string, subject string")
    got = {(r.id, r.subject) for r in chosen_subjects(propagate(spark.createDataFrame(rows, SCHEMA), seeds, order="at")).collect()}
    assert (seed, "botany") in got and "absent" not in {i for i, _ in got}


def test_leading_subject_is_kept(spark):
    rows = [
        ("one", "B", 1, 1, 1.0),  # a single sentence, a title without terms
        ("both", "A", 1, 0, 0.0), ("both", "B", 1, 1, 1.0),  # the title leads
        ("each", "A", 1, 1, 0.5), ("each", "B", 2, 1, 0.5), ("each", "C", 1, 0, 0.0),
        ("out", OUTSIDE, 3, 2, 0.67), ("out", "A", 1, 1, 0.33),
        ("title", "A", 1, 0, None),
        ("two", "A", 4, 3, 0.5), ("two", "B", 2, 2, 0.33), ("two", "C", 1, 1, 0.17),
    ]
    got = chosen_subjects(spark.createDataFrame(rows, "id string, subject string, n_sentences int, n_text int, share double"))
    assert sorted((r.id, r.subject) for r in got.collect()) == [("both", "A"), ("each", "B"), ("one", "B"), ("title", "A"), ("two", "A"), ("two", "B")]


def chain(hinted):
    """Three groups of one subject, each sharing words with the next only, beside other subjects."""
    words = ["qualpha", "qubeta", "qugamma", "qudelta"]
    rows = [(f"c{g}-{i}", f"On {words[g]}", f"We discuss the {words[g]} here. We discuss the {words[g + 1]} here.", "history" if g == 0 and hinted else None, 1) for g in range(3) for i in range(12)]
    others = {"physics": "boson", "botany": "petal", "law": "tortious", "music": "sonata"}
    return rows + [(f"{s[0]}{i}" if s != "physics" else f"p{i}", f"On {w}", f"We discuss the {w} here. We discuss the {w} here.", s, 1) for s, w in others.items() for i in range(12)]


def test_labels_travel_between_documents_without_hints(spark):
    got = {(r.id, r.subject) for r in propagate(spark.createDataFrame(chain(True), SCHEMA), order="at").collect()}
    assert {i for i, s in got if s == "history"} >= {f"c{g}-{i}" for g in range(3) for i in range(12)}


def test_other_hints_count_where_the_stored_one_is_absent(spark):
    hints = spark.createDataFrame([(f"c0-{i}", "history") for i in range(12)] + [("p0", "history")], "id string, subject string")
    got = {(r.id, r.subject) for r in propagate(spark.createDataFrame(chain(False), SCHEMA), None, hints, order="at").collect()}
    assert ("c0-3", "history") in got and {s for i, s in got if i == "p0"} == {"physics"}
