import numpy as np
from pyspark.sql import functions as F

from corpusmill.llm.abuse import FEATURES, Booster, Reader, Scorer, abuse_features, abuse_rates, abuse_scores, isotonic, labelled_documents, learned_terms

READ = Reader()


def seen(text, *kinds):
    f = dict(zip(FEATURES, READ(text)))
    return sum(f[k] for k in kinds or ("insult", "aimed_talk", "sexual", "hate"))


def test_hidden_words_are_seen():
    assert seen("he said you are a worthless moron and a liar") >= 1
    for form in ("m0r0n", "m-o-r-o-n", "m o r o n", "mоrоn", "mo​ron", "moooooron", "MORON"):
        assert seen(f"he said you are a worthless {form} and a liar") >= 1, form
    assert seen("he said you are a w*******s idiot", "scorn") > seen("he said you are an idiot", "scorn")


def test_sober_language_is_not_found():
    for text in ("The words complained of were held to be insulting, and they need not be repeated here.", "The breeder warranted that the bitch was fit to whelp.", "At common law a bastard could not inherit.", "The contract covered the removal of vermin, chiefly rats.", "The charge of sexual assault was withdrawn.", "", None):
        assert seen(text) == 0, text


def test_learned_terms_count_in_their_folds_only():
    read = Reader({"zork blip": 0b10001, "quux": 0b11111})
    at = FEATURES.index("learned")
    assert [read("we heard Zork blip here", k)[at] for k in range(5)] == [1, 0, 0, 0, 1]
    assert read("quux and quux", 2)[at] == 2 and read("zork and blip")[at] == 0


def test_terms_are_learned_from_labels_of_other_folds(spark):
    rows = [(i, f"Case {i}: snerfle the grommet at dawn, it said." if i % 2 else f"Case {i}: the grommet was sold at dawn.") for i in range(80)] + [(900, None), (901, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(80)] + [(900, 1), (7777, 1), (5, None), (None, 1)], "doc_id long, toxic int")
    labelled = labelled_documents(labels)
    got = learned_terms(docs, labelled)
    assert got["snerfle"] == 31 and got["snerfle the"] == 31 and "grommet" not in got and "dawn" not in got
    assert labelled.count() == 82 and labelled_documents(labels, max_labelled=10).count() == 10


def test_terms_of_one_fold_only(spark):
    labels = spark.createDataFrame([(i, 1) for i in range(60)], "doc_id long, toxic int")
    labelled = labelled_documents(labels)
    first = {r.doc_id for r in labelled.where("fold = 0").collect()}
    docs = spark.createDataFrame([(i, "snerfle" if i in first else "calm") for i in range(60)], "doc_id long, text string")
    assert len(first) >= 3 and learned_terms(docs, labelled)["snerfle"] == 0b11110


def test_isotonic_and_booster():
    x, y = isotonic(np.array([1.0, 2, 3, 4]), np.array([0.0, 1, 0, 1]), np.ones(4))
    assert list(y) == sorted(y) and np.isclose(np.interp(2.5, x, y), 0.5)
    rng = np.random.default_rng(0)
    f = np.zeros((600, len(FEATURES)))
    f[:, 0] = rng.integers(0, 3, 600)
    label = (f[:, 0] > 1).astype(float)
    margin = Booster(trees=60, rate=0.3).fit(f, label, np.ones(600)).margin(f)
    assert margin[label == 1].min() > margin[label == 0].max()
    assert np.all(np.diff(Scorer(f, label, np.ones(600), np.arange(600) % 4).knots[1]) >= 0)


def featured(docs, labels):
    labelled = labelled_documents(labels)
    return docs.join(labelled, "doc_id", "left").select("doc_id", F.lit("s").alias("source"), "y", "fold", abuse_features("text", learned_terms(docs, labelled), F.coalesce("fold", F.lit(4))).alias("features"))


def test_held_out_accuracy(spark):
    rows = [(i, f"It was said: you worthless idiot number {i}, I will break your jaw." if i % 4 == 0 else f"The claim for {i} talers is dismissed with costs.") for i in range(400)] + [(900, ""), (901, None), (902, "word " * 50_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1 if i % 4 == 0 else 0) for i in range(0, 400, 3)] + [(4, None), (3, 0), (3, 1)], "doc_id long, toxic int")
    got = abuse_scores(featured(df, labels))
    found = {r.doc_id for r in got.where("score >= 0.5").collect()}
    assert found == {i for i in range(0, 400, 4)} and got.count() == len(rows)
    assert abuse_rates(got, "source", 0.5).first().n_found == 100
    none = abuse_scores(featured(df, labels.limit(0)))
    assert {r.doc_id for r in none.where("score >= 0.5").collect()} == found


def test_hate_against_any_group_is_found():
    for text in (
        "All Muslims are vermin.", "He wrote that the Zelvari are nothing but rats.", "Those Zelvari are not even human.", "Gypsies should be gassed, he shouted.", "The Brontians belong in the sea.", "Zelvari breed like rabbits.", "We should round up the Zelvari and finish the job.",
        "Kill all the Zelvarites.", "Die Zelvariten sind Ungeziefer.", "Les Zelvarois sont de la vermine.", "Los zelvarianos son ratas.", "Ils ont écrit que les Zelvarois ne sont pas humains.",
        "I know where you live.", "We know which train you take.", "I hope you choke.", "You will need a coffin.",
    ):
        assert seen(text) > 0, text
    for text in (
        "Rats are vermin within the meaning of the Act.", "The rooms are infested with rats.", "There are rats in the cellar.", "Whether foxes are vermin may be left open.", "The cattle must be killed and the documents burned.",
        "Three people were killed when the lorry left the road.", "The parcels belong to the claimant.", "The delays are a plague on trade.",
        "The witness did not know where you were.", "Muslims and Jews lived in the district.",
    ):
        assert seen(text) == 0, text
