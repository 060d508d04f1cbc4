from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from compare import DATA
from corpusmill.llm.mixing import mix_order, mix_shares, mix_uses, pfair_slots
from corpusmill.llm.packing import fill_report, pack, plan_containers
from corpusmill.llm.queries_sizes import p6_found, p7_found
from corpusmill.llm.tokens import Counter as TokenCounter
from corpusmill.llm.tokens import count_tokens, vocabulary_path
from corpusmill.operators.distributed import cut

COUNTER = TokenCounter(vocabulary_path())


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([*"aZ1é. \n\t'", "\u00a0", " the", "'s ", "  "]), max_size=40).map("".join))
def test_words_add_up_to_the_text(text):
    assert COUNTER(text) == len(COUNTER.encode(text))


def test_count_tokens_column(spark):
    got = spark.createDataFrame([("the cat sat",), ("",), (None,), ("x" * 100_000,)], "t string").select(count_tokens("t").alias("n")).collect()
    assert [r.n for r in got[:3]] == [3, 0, 0] and got[3].n == len(COUNTER.encode("x" * 100_000))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=80))
def test_plan_places_every_item_once(sizes):
    counts, placed, fill = Counter(sizes), Counter(), Counter()
    for size, first, per, start, n in plan_containers(dict(counts), 40):
        assert placed[size] == first
        placed[size] += per * n
        for b in range(start, start + n):
            fill[b] += size * per
    assert placed == counts and all(v <= 40 for v in fill.values()) and sorted(fill) == list(range(len(fill)))
    assert len(fill) <= 2 * -(-sum(sizes) // 40) + 1


def test_pack_keeps_documents_whole(spark):
    sizes = [(i, (i * 37) % 130) for i in range(900)] + [(1000, None), (1001, -3), (1002, 1_000), (1003, 100), (7, 49)]
    df = cut(spark.createDataFrame(sizes, "doc_id long, n_tokens int"))
    packed = cut(pack(df, 100, salts=5))
    assert packed.groupBy("doc_id").agg(F.sum("piece_tokens").alias("n")).where("doc_id = 1002").first().n == 1_000
    assert packed.where("n_pieces > 1").select("doc_id").distinct().count() == sum(1 for _, n in sizes if n and n > 100)
    fills = {r.container: r.s for r in packed.groupBy("container").agg(F.sum("piece_tokens").alias("s")).collect()}
    assert max(fills.values()) <= 100 and sorted(fills) == list(range(len(fills)))
    report = fill_report(packed, 100).first()
    assert report.n_tokens == sum(n for _, n in sizes if n and n > 0) and report.n_containers <= 1.1 * report.least_containers
    assert pack(df.limit(0), 100).count() == 0


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 60), min_size=1, max_size=6))
def test_pfair_is_within_one_block(blocks):
    want = {f"s{i}": n for i, n in enumerate(blocks)}
    total, done = sum(blocks), Counter()
    slots = pfair_slots(want)
    assert Counter(s for s, _, _ in slots) == Counter({s: n for s, n in want.items() if n})
    for source, block, slot in slots:
        assert block == done[source]
        done[source] += 1
        assert all(abs(done[s] - (slot + 1) * n / total) < 1 for s, n in want.items())


def plan(spark, rows):
    return spark.createDataFrame(rows, "source string, target_share double, max_repeats int, total_tokens long")


def test_mix_uses_and_order(spark):
    docs = [(i, "A " if i % 2 else "a", 10) for i in range(200)] + [(1000 + i, "b", 7) for i in range(10)] + [(2000, "c", 5), (2001, None, 3), (2002, "b", None), (2003, "b", 0)]
    df = cut(spark.createDataFrame(docs, "doc_id long, source string, n_tokens int"))
    lines = plan(spark, [("A", 0.5, 3, 2_000), ("b", 0.4, 4, 2_000), ("nowhere", 0.1, 9, 2_000)])
    uses = cut(mix_uses(df, lines, salts=3))
    assert uses.count() == len(docs)
    shares = {r.source: r for r in mix_shares(mix_order(uses, lines), uses, lines).collect()}
    assert shares["A"].used_tokens == 1_000 and not shares["A"].falls_short
    assert shares["b"].used_tokens == 280 and shares["b"].falls_short and shares["b"].most_uses == 4
    assert shares["nowhere"].falls_short and shares["nowhere"].used_tokens == 0
    assert uses.where("source in ('c', '')").agg(F.sum("n_uses")).first()[0] == 0
    order = mix_order(uses, lines).collect()
    assert sum(r.n_tokens for r in order) == 1_280
    assert len({(r.doc_id, r.copy) for r in order}) == len(order)


def test_mix_of_nothing(spark):
    df = spark.createDataFrame([], "doc_id long, source string, n_tokens int")
    lines = plan(spark, [("A", 0.5, 3, 100), (None, 0.5, 3, 100)])
    uses = mix_uses(df, lines)
    assert [r.falls_short for r in mix_shares(mix_order(uses, lines), uses, lines).collect()] == [True]


def test_target_below_the_first_document_is_no_shortfall(spark):
    df = cut(spark.createDataFrame([(1, "a", 1_000), (2, "b", 0), (3, "c", 5)], "doc_id long, source string, n_tokens int"))
    lines = plan(spark, [("a", 0.01, 1, 1_000), ("b", 0.5, 3, 1_000), ("c", 0.0, 3, 1_000), ("d", 0.49, 0, 1_000)])
    uses = cut(mix_uses(df, lines))
    assert {r.source: r.falls_short for r in mix_shares(mix_order(uses, lines), uses, lines).collect()} == {"a": False, "b": True, "c": False, "d": True}


@pytest.mark.parametrize("block_tokens", [1, 500])
def test_stream_is_within_a_block_and_a_document(spark, block_tokens):
    """The deviation of whole documents in the stream itself, over several periods of the schedule."""
    sizes = [(i, "abc"[i % 3], 1 + (i * i * 7919) % 97) for i in range(6_000)]
    df = cut(spark.createDataFrame(sizes, "doc_id long, source string, n_tokens int"))
    share = {"a": 0.5, "b": 0.3, "c": 0.2}
    lines = plan(spark, [(s, w, 9, 280_000) for s, w in share.items()])
    order = mix_order(cut(mix_uses(df, lines, salts=3)), lines, block_tokens=block_tokens).collect()
    largest = max(n for _, _, n in sizes)
    block = max(largest, block_tokens)
    done, last = Counter(), max(r.slot for r in order)
    by_slot = {}
    for r in order:
        by_slot.setdefault(r.slot, []).append(r)
        assert 0 <= r.offset < block
    assert last > 3 * 10  # several periods of ten slots
    for slot in range(last - 10):
        for r in by_slot.get(slot, []):
            done[r.source] += r.n_tokens
        assert all(abs(done[s] - w * block * (slot + 1)) < block + largest for s, w in share.items())
        assert len({r.source for r in by_slot.get(slot, [])}) <= 1


def test_found_rows_come_through_placement_and_schedule(spark):
    """The plans of p6_found and p7_found hold the placement in containers and the lookup of slots."""
    text = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    assert "row_number()" in text(p6_found(spark, DATA)) and "container(" in text(p6_found(spark, DATA))
    assert "_place" in text(p7_found(spark, DATA))


@pytest.mark.parametrize("capacity", [0, 1 << 21])
def test_capacity_is_checked(spark, capacity):
    with pytest.raises(ValueError):
        pack(spark.createDataFrame([(1, 1)], "doc_id long, n_tokens int"), capacity)
