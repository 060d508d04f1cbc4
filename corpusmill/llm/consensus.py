"""Consensus from several annotators' labels, with spectral reliability."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.distributed import cut, replicate, salt_of

#: Reliabilities stay inside these bounds, so that no single vote has infinite weight.
LEAST, MOST = 0.01, 0.97
#: Votes of average skill that every annotator is credited with, against estimates from a handful of items.
SHRINK = 4.0


def _sum(terms: list[Column]) -> Column:
    return reduce(add, terms)


def one_vote(votes: DataFrame, labels: list[str], *, item: str = "item", annotator: str = "annotator", label: str = "label", detail: str | None = None) -> DataFrame:
    """One row per item and annotator with only the columns named; votes with a null or an unknown label are left out.

    Repeated votes count once; of different ones the greatest label counts, then the greatest detail.
    """
    cols = [label, *([detail] if detail else [])]
    known = votes.where(F.col(item).isNotNull() & F.col(annotator).isNotNull() & F.col(label).isin(*labels))
    best = known.groupBy(item, annotator).agg(F.max(F.struct(*cols)).alias("_b"))
    return best.select(item, annotator, *[F.col(f"_b.{c}").alias(c) for c in cols])


def _pair_table(v: DataFrame, most_votes: int) -> tuple[DataFrame, DataFrame | None]:
    """Common items ``n`` and agreements ``same`` of annotators ``_a`` and ``_b``, both ways; and the votes on items of more than ``most_votes``.

    An item of few votes adds fewer than ``most_votes`` / 2 pairs a vote, summed up in the task. Items of
    more make no pairs: their part of the matrix stays in factored form (see ``_crowd``).
    """
    crowded = cut(v.groupBy("_i").agg(F.count(F.lit(1)).alias("_m")).where(F.col("_m") > most_votes).select("_i"))
    crowd = None
    if not crowded.isEmpty():
        v, crowd = v.join(crowded, "_i", "left_anti"), cut(v.join(crowded, "_i", "left_semi"))
    lists = v.groupBy("_i").agg(F.array_sort(F.collect_list(F.struct("_a", "_l"))).alias("_v"))
    firsts = lists.select("_v", F.posexplode("_v").alias("_at", "_x")).select("_x", F.explode(F.slice("_v", F.col("_at") + 2, F.size("_v"))).alias("_y"))
    half = firsts.groupBy(F.col("_x._a").alias("_a"), F.col("_y._a").alias("_b")).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("_x._l") == F.col("_y._l")).alias("same"))
    half = cut(half)
    return half.unionByName(half.select(F.col("_b").alias("_a"), F.col("_a").alias("_b"), "n", "same")), crowd


def _crowd(crowd: DataFrame, vector: DataFrame, labels: list[str], shares: list[str], salts: int = 16) -> DataFrame:
    """The same products from items of many votes: votes with g summed per item and label, and these sums with the votes."""
    known = crowd.withColumn("_salt", salt_of(["_i"], salts)).join(replicate(vector.select("_a", *shares, "g"), salts), ["_a", "_salt"])
    per_item = known.groupBy("_i").agg(
        *[F.sum(F.when(F.col("_l") == x, F.col("g")).otherwise(0.0)).alias(f"s{j}") for j, x in enumerate(labels)],
        *[F.sum(F.col("g") * F.col(p)).alias(f"t{j}") for j, p in enumerate(shares)],
        F.sum(F.col("g") * F.col("g")).alias("q"),
    )
    own = known.withColumn("_salt", salt_of(["_a"], salts)).join(replicate(per_item, salts), ["_i", "_salt"])
    agreed = _sum([F.when(F.col("_l") == x, F.col(f"s{j}") - F.col("g")).otherwise(0.0) for j, x in enumerate(labels)])
    chance = _sum([F.col(p) * (F.col(f"t{j}") - F.col("g") * F.col(p)) for j, p in enumerate(shares)])
    return own.select("_a", (agreed - chance).alias("up"), (F.col("q") - F.col("g") * F.col("g")).alias("down"))


def spectral_reliability(
    votes: DataFrame, labels: list[str], *, item: str = "item", annotator: str = "annotator", label: str = "label", tolerance: float = 1e-2, most_votes: int = 64, rounds: int = 1_000
) -> DataFrame:
    """Reliability per annotator: the leading eigenvector of the chance-centred agreement matrix, corrected for overlap counts.

    Entry a, b is the sum over common items of [labels agree] minus the agreement expected from both
    annotators' label shares, over the root of d_a d_b, where d_a counts a's common items with all others; so neither
    many nor few votes move the vector. Power iteration: the sparse table of pairs is made once, a
    step joins it with the vector and sums per annotator; a shift of the diagonal keeps it from swinging. It ends when the
    residual of M x = l x is at most ``tolerance`` of l, and is an error after ``rounds``. Entries are then
    taken back by their own overlaps, ``r_a = sum_b M_ab g_b / sum_b n_ab g_b^2`` for the vector g, with ``SHRINK`` votes of average skill.

    ``votes`` may hold repeated rows, nulls and other columns (see ``one_vote``). Out: ``annotator``, ``n_votes``, ``shares`` (per label), ``vector``
    (eigenvector entry), ``centred`` (r), ``reliability`` (share of votes that come from knowledge, not guessing,
    between 0.01 and 0.97). An annotator who shares no item with another gets the average.
    An empty table gives an empty result.
    """
    k = len(labels)
    v = cut(one_vote(votes, labels, item=item, annotator=annotator, label=label).select(F.col(item).alias("_i"), F.col(annotator).alias("_a"), F.col(label).alias("_l")))
    base = v.groupBy("_a").agg(F.count(F.lit(1)).alias("n_votes"), *[F.count_if(F.col("_l") == x).alias(f"_c{j}") for j, x in enumerate(labels)])
    base = cut(base.select("_a", "n_votes", *[(F.col(f"_c{j}") / F.col("n_votes")).alias(f"p{j}") for j in range(k)]))
    shares = [f"p{j}" for j in range(k)]
    counted, crowd = _pair_table(v, most_votes)
    other = base.select(F.col("_a").alias("_b"), *[F.col(p).alias(f"_{p}") for p in shares])
    chance = _sum([F.col(p) * F.col(f"_{p}") for p in shares])
    pairs = cut(counted.join(base.select("_a", *shares), "_a").join(other, "_b").select("_a", "_b", "n", (F.col("same") - F.col("n") * chance).alias("m")))

    def spread(vector: DataFrame) -> DataFrame:
        """Per annotator: ``up``, the centred agreements times the others' g, and ``down``, the overlaps times their squares."""
        near = pairs.join(vector.select(F.col("_a").alias("_b"), "g"), "_b").select("_a", (F.col("m") * F.col("g")).alias("up"), (F.col("n") * F.col("g") * F.col("g")).alias("down"))
        parts = near.unionByName(_crowd(crowd, vector, labels, shares)) if crowd is not None else near
        return parts.groupBy("_a").agg(F.sum("up").alias("up"), F.sum("down").alias("down"))

    ones = spread(base.withColumn("g", F.lit(1.0))).select("_a", F.col("down").alias("d"))
    root = F.sqrt(F.greatest(F.col("d"), F.lit(1.0)))
    now = cut(base.join(ones, "_a", "left").withColumn("d", F.coalesce("d", F.lit(0.0))))
    size = now.agg(F.sqrt(F.sum("d"))).first()[0] or 1.0
    now = now.withColumn("x", F.sqrt("d") / size)
    for _ in range(rounds):
        step = spread(now.withColumn("g", F.col("x") / root)).select("_a", "up")
        now = cut(now.join(step, "_a", "left").withColumn("y", F.coalesce("up", F.lit(0.0)) / root).drop("up"))
        value, length = now.agg(F.coalesce(F.sum(F.col("x") * F.col("y")), F.lit(0.0)), F.coalesce(F.sum(F.col("y") * F.col("y")), F.lit(0.0))).first()
        if length < 1e-18 or value > 0 and length - value * value <= (tolerance * value) ** 2:
            break
        shift = max(0.25 * value, 0.5 * length**0.5 if value < 0.5 * length**0.5 else 0.0)
        now = now.withColumn("x", (F.col("y") + shift * F.col("x")) / (length + 2 * shift * value + shift * shift) ** 0.5).drop("y")
    else:
        raise ValueError(f"no eigenvector after {rounds} rounds")
    vector = now.withColumn("g", F.col("x") / root)
    fitted = cut(vector.join(spread(vector), "_a", "left").fillna(0.0, ["up", "down"]))
    # The scale at which g_a g_b fits the centred agreement of all pairs best; the sign that most votes have.
    fit, weight, side = fitted.agg(F.sum(F.col("g") * F.col("up")), F.sum(F.col("g") * F.col("g") * F.col("down")), F.sum(F.col("g") * F.col("d"))).first()
    scale = (max(fit, 0.0) / weight) ** 0.5 * (-1 if side < 0 else 1) if weight else 0.0
    r = (scale * F.col("up") + SHRINK * 0.125) / (scale * scale * F.col("down") + SHRINK * 0.25)
    # Centred agreement of two who always know is 1 - chance; that scales the vector to shares of knowledge.
    room = fitted.agg(*[(F.sum(F.col(p) * F.col("n_votes")) / F.sum("n_votes")).alias(p) for p in shares]).select((1 - _sum([F.col(p) * F.col(p) for p in shares])).alias("_room"))
    scaled = fitted.withColumn("r", r).join(F.broadcast(room), how="cross")  # one row
    known = F.col("r") / F.sqrt(F.greatest(F.col("_room"), F.lit(0.05)))
    return scaled.select(F.col("_a").alias(annotator), "n_votes", F.array(*shares).alias("shares"), F.col("x").alias("vector"), F.col("r").alias("centred"), F.least(F.greatest(known, F.lit(LEAST)), F.lit(MOST)).alias("reliability"))


def weighted_votes(votes: DataFrame, reliability: DataFrame, labels: list[str], *, item: str = "item", annotator: str = "annotator", label: str = "label", detail: str | None = None, exact: float = 0.9) -> DataFrame:
    """Each vote (see ``one_vote``) with ``weight``: the log-likelihood ratio of a vote under the annotator's reliability.

    An annotator with reliability g gives the true label with probability g, else guesses from the
    own habit; so a vote that is a habit weighs little and a rare one more. ``prior`` is an array of
    each label's log share in all votes by reliability.

    ``detail`` names a column that says more about a label (where an item belongs instead). Who knows
    gives the true detail with probability ``exact``; guessed details spread over ``n_details``, the
    effective number of them (inverse Simpson index). ``weight`` of a vote with a detail holds for
    items whose true detail is another one, ``extra`` is added where it is that one.
    """
    k = range(len(labels))
    g = F.col("reliability")
    votes = one_vote(votes, labels, item=item, annotator=annotator, label=label, detail=detail)
    totals = reliability.agg(*[(F.sum(F.col("shares")[j] * F.col("n_votes")) / F.sum("n_votes")).alias(f"_pi{j}") for j in k], F.array(*[F.log(F.greatest(F.sum(F.col("shares")[j] * F.col("n_votes") * g) / F.sum(F.col("n_votes") * g), F.lit(0.001))) for j in k]).alias("prior"))
    if detail:
        each = votes.where(F.col(detail).isNotNull()).groupBy(detail).agg(F.count(F.lit(1)).alias("n"))
        totals = totals.join(each.agg(F.coalesce(F.sum("n") * F.sum("n") / F.sum(F.col("n") * F.col("n")), F.lit(1.0)).alias("n_details")), how="cross")  # one row each
    # An annotator may hold a third of all votes.
    known = replicate(reliability.select(annotator, "shares", "reliability"), 16)
    joined = votes.withColumn("_salt", salt_of([item], 16)).join(known, [annotator, "_salt"]).drop("_salt").join(F.broadcast(totals), how="cross")  # one row
    own = _pick(label, labels, lambda j: F.col("shares")[j])
    share = _pick(label, labels, lambda j: F.col(f"_pi{j}"))
    odds = g / ((1 - g) * F.greatest((own - g * share) / (1 - g), F.lit(0.02)))
    if not detail:
        return joined.withColumn("weight", F.log1p(odds)).drop("shares", *[f"_pi{j}" for j in k])
    other = F.log1p(odds * (1 - exact))
    stated = F.col(detail).isNotNull()
    return joined.withColumn("weight", F.when(stated, other).otherwise(F.log1p(odds))).withColumn("extra", F.when(stated, F.log1p(odds * exact * F.col("n_details")) - other)).drop("shares", *[f"_pi{j}" for j in k])


def _pick(label: str, labels: list[str], value) -> Column:
    out = F.lit(None).cast("double")
    for j, x in enumerate(labels):
        out = F.when(F.col(label) == x, value(j)).otherwise(out)
    return out


def consensus(weighted: DataFrame, labels: list[str], *, item: str = "item", label: str = "label", detail: str | None = None, detailed: str | None = None) -> DataFrame:
    """Per item: the most likely label, and measures of agreement.

    Out: ``item``, ``label``, ``support`` (the label's probability), ``agreement`` (share of pairs of
    votes that agree; null for one vote), ``n_votes``; with ``detail`` also the likeliest ``detail`` among
    the votes for the label ``detailed`` (null if none states one). That label's likelihood is summed
    over details, so two votes with one detail weigh more than two with different ones. Ties
    go to the label named first in ``labels`` and to the detail last by name.
    """
    k = range(len(labels))
    sums = weighted.groupBy(item).agg(
        F.count(F.lit(1)).alias("n_votes"),
        *[F.sum(F.when(F.col(label) == x, F.col("weight")).otherwise(0.0)).alias(f"_w{j}") for j, x in enumerate(labels)],
        *[F.count_if(F.col(label) == x).alias(f"_n{j}") for j, x in enumerate(labels)],
        F.first("prior").alias("_prior"),
        *([F.first("n_details").alias("_d")] if detail else []),
    )
    scores = [F.col(f"_w{j}") + F.col("_prior")[j] for j in k]
    if detail:
        stated = weighted.where((F.col(label) == detailed) & F.col(detail).isNotNull()).groupBy(item, detail).agg(F.sum("extra").alias("_x"))
        best = stated.groupBy(item).agg(F.max(F.struct(F.round("_x", 9).alias("x"), F.col(detail).alias("v"))).alias("_b"))
        sums = sums.join(best, item, "left")
        gain = F.coalesce(F.col("_b.x"), F.lit(0.0)) - F.log(F.greatest(F.col("_d"), F.lit(1.0)))
        scores = [s + F.greatest(gain, F.lit(0.0)) + F.log1p(F.exp(-F.abs(gain))) if x == detailed else s for s, x in zip(scores, labels)]
    scored = sums.select("*", *[F.round(s, 9).alias(f"_s{j}") for j, s in enumerate(scores)])
    top = F.greatest(*[F.col(f"_s{j}") for j in k]) if len(labels) > 1 else F.col("_s0")
    chosen = F.coalesce(*[F.when(F.col(f"_s{j}") == F.col("_top"), x) for j, x in enumerate(labels)])
    pairs = _sum([F.col(f"_n{j}") * (F.col(f"_n{j}") - 1) for j in k])
    return scored.withColumn("_top", top).select(
        item,
        chosen.alias(label),
        (1 / _sum([F.exp(F.col(f"_s{j}") - F.col("_top")) for j in k])).alias("support"),
        F.when(F.col("n_votes") > 1, pairs / (F.col("n_votes") * (F.col("n_votes") - 1))).alias("agreement"),
        "n_votes",
        *([F.col("_b.v").alias(detail)] if detail else []),
    )


def named_spans(texts: DataFrame, text: str, names: DataFrame, name: str, *, keys: list[str]) -> DataFrame:
    """For each row the ``name`` that occurs in ``text`` as whole words, the longest and then the last one.

    Words are runs of letters and digits, ``and`` left out. Rows without a name are dropped. Every run of
    as many words as a name has is looked up by an equality join; no text is compared with all names.
    """
    known = names.select(plain_words(name).alias("_k"), F.col(name).alias("_name")).where("_k != ''").groupBy("_k").agg(F.min("_name").alias("_name"))
    sizes = known.agg(F.collect_set(F.size(F.split("_k", " "))).alias("_sizes"))  # one row; lengths of names, a handful
    words = texts.select(*keys, F.filter(F.split(plain_words(text), " "), lambda w: w != "").alias("_w")).join(F.broadcast(sizes), how="cross")
    starts = words.select(*keys, "_w", "_sizes", F.explode(F.sequence(F.lit(1), F.greatest(F.size("_w"), F.lit(1)))).alias("_s"))
    spans = starts.select(*keys, "_s", F.explode("_sizes").alias("_n"), "_w").where(F.col("_s") + F.col("_n") - 1 <= F.size("_w"))
    spans = spans.select(*keys, "_s", "_n", F.array_join(F.slice("_w", F.col("_s"), F.col("_n")), " ").alias("_k"))
    return spans.join(known, "_k").groupBy(*keys).agg(F.max_by("_name", F.struct("_n", "_s")).alias("name"))


def plain_words(c: str) -> Column:
    """Letters and digits in lower case, single spaces between, without the word ``and``."""
    spaced = F.concat(F.lit(" "), F.regexp_replace(F.lower(F.col(c)), r"[^\p{L}\p{N}]+", " "), F.lit(" "))
    return F.trim(F.regexp_replace(F.replace(spaced, F.lit(" and "), F.lit(" ")), " +", " "))
