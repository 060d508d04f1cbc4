import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpusmill.functions import rules as R
from corpusmill.functions.hygiene import hygiene
from corpusmill.functions.text import band, norm, reference_key
from corpusmill.operators import labels as L
from corpusmill.operators.facets import facet_counts
from corpusmill.operators.sampling import band_allocation
from corpusmill.operators.slugs import free_slugs
from corpusmill.operators.vectors import merge_smallest, silhouette


def one(spark, value, column, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(column).first()[0]


def test_hygiene_edges(spark):
    rows = [("A title with a preface in it", "x" * 200), ("t", "x" * 100), ("t", "x" * 99), ("t" * 60, None), ("t" * 59, " (No Abstract Available) "), ("Erratum and editorial", None), (None, None)]
    got = spark.createDataFrame(rows, "t string, a string").select(hygiene(F.col("t"), F.col("a")).alias("h")).select("h.reason").collect()
    assert [r[0] for r in got] == ["junk_pattern:preface", "usable_abstract", "no_abstract_short_title", "no_abstract_informative_title", "no_abstract_short_title", "junk_pattern:erratum", "no_abstract_short_title"]


def test_text_forms(spark):
    assert one(spark, "  A\t b ", norm("x")) == "a b"
    assert one(spark, " ObjectId('AB1') ", reference_key("x")) == "ab1"
    assert [one(spark, v, reference_key("x")) for v in ("NULL", " none", "ObjectId('')", None)] == [None] * 4
    assert [one(spark, v, band("x", "none"), "double") for v in (None, float("nan"), 0.0, 0.5, 0.8)] == ["none", "none", "<0.5", "0.5-0.8", ">=0.8"]
    assert one(spark, 'so: ```json\n{"a": {"b": 1}}\n``` ok', R.json_object(F.col("x"))) == '{"a": {"b": 1}}'
    assert one(spark, "no object", R.json_object(F.col("x"))) is None
    assert one(spark, "R & D (new)!", R.slug(F.col("x"))) == "r-and-d-new"


def test_merges(spark):
    old = spark.createDataFrame([("1", None, 0.1), ("2", "a", 0.5), ("3", "a", 0.9)], "id string, area string, c double")
    new = spark.createDataFrame([("1", "b", None), ("2", "b", 0.6), ("3", "b", 0.1)], "id string, area string, c double")
    got = L.conditional_merge(old, new, "id", ["area", "c"], [("gap", F.col("o.area").isNull()), ("surer", F.col("n.c") > F.col("o.c"))])
    assert sorted(tuple(r) for r in got.collect()) == [("1", "b", None, "gap", True), ("2", "b", 0.6, "surer", True), ("3", "a", 0.9, None, False)]
    got = L.upsert_dimension(spark.createDataFrame([("x", "1"), ("y", "2")], "name string, id string"), spark.createDataFrame([("y",), ("z",)], "name string"), "name", "id")
    assert sorted((r.name, r.action) for r in got.collect()) == [("x", "delete"), ("y", "keep"), ("z", "insert")]


def test_new_row_with_null_fields_counts(spark):
    old = spark.createDataFrame([("1", "a"), ("2", "a")], "id string, area string")
    new = spark.createDataFrame([("1", None)], "id string, area string")
    got = L.conditional_merge(old, new, "id", ["area"], [("any", F.lit(True))])
    assert sorted(tuple(r) for r in got.collect()) == [("1", None, "any", True), ("2", "a", None, False)]


def looped(names):
    used, out = set(), []
    for n in names:
        s, k = n, 2
        while s in used:
            s, k = f"{n}-{k}", k + 1
        used.add(s)
        out.append(s)
    return out


@pytest.mark.parametrize("names", [["a", "a", "a-2", "a", "a-2", "b"], ["a-2", "a-2-2", "a", "a", "a-2", "a", "a"], ["a", "a-3", "a", "a", "a-2", "a-2", "a"], ["x"] * 6, [""]])
def test_slugs_equal_the_loop(spark, names):
    df = spark.createDataFrame(list(enumerate(names)), "i int, base string")
    got = [r.slug for r in free_slugs(df, "base", ["i"]).orderBy("i").collect()]
    assert got == looped(names)


def test_subdomain_masks(spark):
    df = spark.createDataFrame([("1", "a", "d", "s"), ("2", "a", "d", None), ("3", None, "d", "s")], "id string, area_id string, domain_id string, subdomain_id string")
    got = {(r["mask"], r.area_id, r.domain_id, r.subdomain_id): r.n for r in facet_counts(df, entity="id").collect()}
    assert got == {(0, "a", None, None): 2, (1, None, "d", None): 3, (2, None, "d", "s"): 2, (3, "a", "d", None): 2, (4, "a", "d", "s"): 1}


def test_missing_seats_go_to_cells_with_room():
    got = band_allocation([("g", "<0.5", 3), ("h", "<0.5", 9), ("h", ">=0.8", 4)], {"g": 5, "h": 4}, {"<0.5": 0.5, ">=0.8": 0.5})
    assert got == [("g", "<0.5", 3), ("h", "<0.5", 4), ("h", ">=0.8", 2)] and sum(n for *_, n in got) == 9


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 30), min_size=3, max_size=3), st.integers(0, 60))
def test_band_allocation_keeps_bounds(room, want):
    cells = [("g", b, n) for b, n in zip(("<0.5", "0.5-0.8", ">=0.8"), room)]
    got = band_allocation(cells, {"g": want}, {"<0.5": 0.4, "0.5-0.8": 0.3, ">=0.8": 0.3})
    assert sum(n for *_, n in got) == min(want, sum(room)) and all(n <= r for (_, _, n), (_, _, r) in zip(got, sorted(cells)))


def test_silhouette_and_merge():
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.normal(0, 0.1, (20, 3)), rng.normal(5, 0.1, (20, 3))])
    assert silhouette(x, np.repeat([0, 1], 20)) > 0.9
    into = merge_smallest({"a": (9, [1.0, 0.0]), "b": (5, [0.0, 1.0]), "c": (1, [0.1, 0.9])}, 2)
    assert into == {"a": "a", "b": "b", "c": "b"}
