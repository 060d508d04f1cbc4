from corpusmill.functions.text import key
from corpusmill.operators.diff import diff_copies


def rows(df):
    return sorted(((r.id, r.side, [tuple(d) for d in r.differences]) for r in df.collect()), key=lambda r: (r[0] is not None, r[0]))


def test_sides_and_fields(spark):
    a = spark.createDataFrame([("A ", "x  y", None, 1), ("b", "old", "q", 1), ("b", "new", "q", 2), ("c", "s", "t", 1), (None, "n", "n", 1), ("e", "", "", 1)], "id string, f string, g string, at int")
    b = spark.createDataFrame([("a", " X y", "", 5), ("b", "new", "r", 1), ("d", None, None, 1), (None, "m", "n", 1), ("e", None, "  ", 1), ("e", None, "  ", 1)], "id string, f string, g string, at int")
    got = rows(diff_copies(a, b, "id", ["f", "g"], order="at", normal_key=key))
    assert got == [(None, "both", [("f", "n", "m")]), ("b", "both", [("g", "q", "r")]), ("c", "left_only", []), ("d", "right_only", [])]


def test_empty_sides_ties_and_extra_columns(spark):
    a = spark.createDataFrame([("a", "1", 7), ("a", "2", 7)], "id string, _v string, side int")
    none = a.limit(0)
    assert rows(diff_copies(a, none, "id", ["_v"])) == [("a", "left_only", [])]
    assert rows(diff_copies(none, none, "id", ["_v"])) == []
    same = spark.createDataFrame([("a", "2", 1)], "id string, _v string, side int")
    assert rows(diff_copies(a, same, "id", ["_v"], order="side")) == []
