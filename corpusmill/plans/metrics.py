"""Agreement between the label copies, the stored classification and the audits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import band, norm
from ..operators import metrics as M
from ..sources.tables import load
from .base import PAPERS, TAXONOMY, labels, labels_sql, papers, taxonomy
from .sqltext import norm as norm_sql

EDGES = [0.0, 0.5, 0.6, 0.7, 0.8, 0.9, 0.95, 1.0001]


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels of both copies by paper; ``agree`` is null where one has no area or is unclassifiable."""
    a = labels(spark, sf_dir).select("id", "area", "domain", "confidence", "model", "unclassifiable")
    b = labels(spark, sf_dir, "audit50_v21_batches").select("id", F.col("area").alias("area_b"), F.col("domain").alias("domain_b"), F.col("unclassifiable").alias("uncl_b"))
    joined = a.join(b, "id")
    comparable = F.col("area").isNotNull() & F.col("area_b").isNotNull() & ~F.col("unclassifiable") & ~F.col("uncl_b")
    return joined.withColumn("agree", F.when(comparable, F.col("area") == F.col("area_b"))).withColumn("agree_domain", F.when(comparable, F.col("domain").eqNullSafe(F.col("domain_b")))).withColumn("band", band("confidence", "none"))


def _stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored classification of each paper by plain names."""
    dim = taxonomy(spark, sf_dir)
    rows = papers(spark, sf_dir, "domain_id", "unclassifiable").join(dim.select("domain_id", norm("area_name").alias("area_s"), norm("domain_name").alias("domain_s")), "domain_id", "left")
    return rows.select("id", "area_s", "domain_s", "unclassifiable")


def domain_frequency(spark, sf_dir):
    return M.frequency(labels(spark, sf_dir), "domain")


def mean_confidence(spark, sf_dir):
    return labels(spark, sf_dir).agg(F.round(F.avg("confidence"), 4).alias("mean_confidence"), F.count("confidence").alias("n"), F.count(F.lit(1)).alias("n_all"))


def confidence_histogram(spark, sf_dir):
    return M.histogram(labels(spark, sf_dir), "confidence", EDGES)


def duplicate_ids(spark, sf_dir):
    return load(spark, sf_dir, "audit50_v21_sample").groupBy(F.lower(F.trim("id")).alias("id")).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def agreement_by_band(spark, sf_dir):
    return M.agreement_sets(_pairs(spark, sf_dir), "agree", [[], ["band"], ["band", "model"]])


def confusion_top(spark, sf_dir):
    off = M.confusion(_pairs(spark, sf_dir), "area", "area_b").where("area != area_b")
    return M.top_groups(off, 12, "n", "area", "area_b")


def area_purity(spark, sf_dir):
    return M.purity(_pairs(spark, sf_dir), "area", "area_b")


def domain_involvement(spark, sf_dir):
    return M.involvement(_pairs(spark, sf_dir), "domain", "domain_b")


def domain_leverage(spark, sf_dir):
    corpus = _stored(spark, sf_dir).withColumnRenamed("domain_s", "domain")
    return M.leverage(corpus, _pairs(spark, sf_dir), "domain", "domain_b")


def domain_profile(spark, sf_dir):
    rows = labels(spark, sf_dir).withColumn("band", band("confidence", "none"))
    return rows.groupBy("domain").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("confidence"), 4).alias("sum_confidence"), *[F.count_if(F.col("band") == b).alias(name) for b, name in (("<0.5", "n_low"), ("0.5-0.8", "n_mid"), (">=0.8", "n_high"))])


def cross_area_split(spark, sf_dir):
    off = _pairs(spark, sf_dir).where("domain != domain_b")
    return off.groupBy((F.col("area") != F.col("area_b")).alias("is_cross"), "band").agg(F.count(F.lit(1)).alias("n"))


def usage_totals(spark, sf_dir):
    """Event values as usage per type, with the JSON counter; sums of integers where possible."""
    rows = load(spark, sf_dir, "events").select("event_type", F.get_json_object("props", "$.k").cast("long").alias("k"), "value")
    return rows.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("k").alias("sum_k"), F.round(F.sum("value"), 2).alias("sum_value"))


def win_counts(spark, sf_dir):
    """Which copy the stored classification sides with, per band and overall."""
    judged = _judged(spark, sf_dir)
    return M.win_summary(judged, "winner", "band")


def _judged(spark, sf_dir):
    joined = _pairs(spark, sf_dir).where("area IS NOT NULL AND area_b IS NOT NULL").join(_stored(spark, sf_dir).select("id", "area_s"), "id")
    winner = F.when(F.col("area") == F.col("area_b"), "tie").when(F.col("area_s") == F.col("area_b"), "new").when(F.col("area_s") == F.col("area"), "old").otherwise("tie")
    return joined.withColumn("winner", winner)


def change_patterns(spark, sf_dir):
    moved = _judged(spark, sf_dir).where("area != area_b")
    counts = moved.groupBy(F.concat_ws(" -> ", "area", "area_b").alias("pattern"), "winner").agg(F.count(F.lit(1)).alias("n"))
    return M.top_groups(counts, 10, "n", "pattern", "winner")


def area_before_after(spark, sf_dir):
    return M.before_after(labels(spark, sf_dir).select("area"), labels(spark, sf_dir, "audit50_v21_batches").select("area"), "area")


def baseline_delta(spark, sf_dir):
    """Agreement per band of the two copies against that with the stored classification."""
    pairs = _pairs(spark, sf_dir)
    base = pairs.groupBy("band").agg(F.round(100 * F.try_divide(F.count_if("agree"), F.count("agree")), 2).alias("pct_base"))
    stored = pairs.where("area IS NOT NULL").join(_stored(spark, sf_dir).where("area_s IS NOT NULL").select("id", "area_s"), "id")
    now = stored.groupBy("band").agg(M.rate(F.col("area") == F.col("area_s")).alias("pct_now"))
    return base.join(now, "band").withColumn("delta", F.round(F.col("pct_now") - F.col("pct_base"), 2))


def policy_scores(spark, sf_dir):
    """Agreement with the stored area under merge policies, all scored in one pass."""
    joined = _judged(spark, sf_dir).where("area_s IS NOT NULL")
    policies = {"old": F.col("area"), "new": F.col("area_b"), "new_midband": F.when(F.col("band") == "0.5-0.8", F.col("area_b")).otherwise(F.col("area"))}
    scored = joined.select("area_s", F.explode(F.array(*[F.struct(F.lit(n).alias("policy"), c.alias("label")) for n, c in policies.items()])).alias("p"))
    return scored.groupBy("p.policy").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("p.label") == F.col("area_s")).alias("agreed"))


def changed_split(spark, sf_dir):
    """Agreement with the stored area of labels that the second copy changed and of those it carried."""
    joined = _judged(spark, sf_dir).where("area_s IS NOT NULL")
    return joined.groupBy((F.col("area") != F.col("area_b")).alias("changed")).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("area_b") == F.col("area_s")).alias("agreed"))


def top_share(spark, sf_dir):
    """Share of the largest area; above 70 % the labels are degenerate."""
    counts = M.frequency(labels(spark, sf_dir).where("area IS NOT NULL"), "area").where("rank = 1")
    return counts.select("area", "n", "share", (F.col("share") > 0.7).alias("is_degenerate"))


def corpus_profile(spark, sf_dir):
    """Null and fact counts of the papers in one pass."""
    rows = load(spark, sf_dir, "researchmetadatascopus")
    return rows.agg(
        F.count(F.lit(1)).alias("n_rows"), F.countDistinct("_id").alias("n_papers"), F.count_if(F.col("abstract").isNotNull()).alias("with_abstract"), F.count_if(F.size(F.coalesce("iitd_authors", F.array())) > 0).alias("with_authors"),
        F.count_if(F.col("classification.thematic_area_id").isNotNull()).alias("with_area"), F.count_if(F.col("classification.unclassifiable")).alias("n_unclassifiable"), F.countDistinct("publication_year").alias("n_years"),
    )


def disagreement_listing(spark, sf_dir):
    """Disagreeing papers with the size of their pair of areas."""
    off = _pairs(spark, sf_dir).where("area != area_b").select("id", "area", "area_b")
    sizes = off.groupBy("area", "area_b").agg(F.count(F.lit(1)).alias("pair_n"))
    titles = papers(spark, sf_dir, "title")
    return off.join(sizes, ["area", "area_b"]).join(titles, "id", "left").select("id", "area", "area_b", "pair_n", "title")


QUERIES = {
    "agg_a1_domain_frequency": domain_frequency, "agg_a2_mean_confidence": mean_confidence, "agg_a3_confidence_histogram": confidence_histogram, "agg_a4_duplicate_ids": duplicate_ids, "agg_a6_agreement_sets": agreement_by_band,
    "agg_a7_confusion_top": confusion_top, "agg_a8_purity": area_purity, "agg_a9_involvement": domain_involvement, "agg_a10_leverage": domain_leverage, "agg_a11_domain_profile": domain_profile, "agg_a12_cross_split": cross_area_split,
    "agg_a13_usage_totals": usage_totals, "agg_a19_win_summary": win_counts, "agg_a20_patterns": change_patterns, "agg_a21_before_after": area_before_after, "agg_a22_baseline_delta": baseline_delta, "agg_a23_policy_scores": policy_scores,
    "agg_a28_top_share": top_share, "agg_a33_changed_split": changed_split, "agg_a35_corpus_profile": corpus_profile, "join_j13_disagreements": disagreement_listing,
}

_BAND = "CASE WHEN confidence IS NULL THEN 'none' WHEN confidence < 0.5 THEN '<0.5' WHEN confidence < 0.8 THEN '0.5-0.8' ELSE '>=0.8' END"
_PAIRS = f"""{labels_sql()}, {labels_sql("other", "audit50_v21_batches")},
pairs AS (SELECT *, CASE WHEN comparable THEN area = area_b END AS agree FROM (SELECT a.id, a.area, a.domain, a.model, b.area AS area_b, b.domain AS domain_b, {_BAND.replace("confidence", "a.confidence")} AS band,
  a.area IS NOT NULL AND b.area IS NOT NULL AND NOT a.unclassifiable AND NOT b.unclassifiable AS comparable FROM labels a JOIN other b USING (id)))"""
_STORED = f"{PAPERS}, {TAXONOMY}, stored AS (SELECT p.id, {norm_sql('t.area_name')} AS area_s, {norm_sql('t.domain_name')} AS domain_s FROM papers p LEFT JOIN taxonomy t USING (domain_id))"
_JUDGED = f"""{_PAIRS}, {_STORED}, judged AS (SELECT p.*, s.area_s, CASE WHEN area = area_b THEN 'tie' WHEN area_s = area_b THEN 'new' WHEN area_s = area THEN 'old' ELSE 'tie' END AS winner
  FROM pairs p JOIN stored s USING (id) WHERE area IS NOT NULL AND area_b IS NOT NULL)"""
SQL = {
    "agg_a1_domain_frequency": f"WITH {labels_sql()}, c AS (SELECT domain, count(*) AS n FROM labels GROUP BY 1) SELECT domain, n, row_number() OVER (ORDER BY n DESC, domain NULLS LAST) AS rank, round(n / sum(n) OVER (), 6) AS share FROM c",
    "agg_a2_mean_confidence": f"WITH {labels_sql()} SELECT round(avg(confidence), 4) AS mean_confidence, count(confidence) AS n, count(*) AS n_all FROM labels",
    "agg_a3_confidence_histogram": f"""WITH {labels_sql()}, b AS (SELECT * FROM (VALUES {", ".join(f"({i}, {a}::DOUBLE, {b}::DOUBLE)" for i, (a, b) in enumerate(zip(EDGES, EDGES[1:])))}) t(bin, low, high))
      SELECT bin, low, high, (SELECT count(*) FROM labels WHERE confidence >= low AND confidence < high) AS n FROM b""",
    "agg_a4_duplicate_ids": "SELECT lower(trim(id)) AS id, count(*) AS n FROM audit50_v21_sample GROUP BY 1 HAVING count(*) > 1",
    "agg_a6_agreement_sets": f"""WITH {_PAIRS} SELECT CASE WHEN grouping(band) = 0 THEN band END AS band, CASE WHEN grouping(model) = 0 THEN model END AS model, grouping_id(band, model) AS level, count(agree) AS n, count(*) FILTER (agree) AS agreed,
      round(100 * count(*) FILTER (agree) / nullif(count(agree), 0), 2) AS pct FROM pairs GROUP BY GROUPING SETS ((), (band), (band, model))""",
    "agg_a7_confusion_top": f"WITH {_PAIRS} SELECT area, area_b, count(*) AS n FROM pairs WHERE area != area_b GROUP BY ALL ORDER BY n DESC, area, area_b LIMIT 12",
    "agg_a8_purity": f"WITH {_PAIRS} SELECT area, count(*) AS n, count(*) FILTER (area IS NOT DISTINCT FROM area_b) AS stayed, count(*) FILTER (area IS DISTINCT FROM area_b) AS moved, round(100 * count(*) FILTER (area IS NOT DISTINCT FROM area_b) / count(*), 2) AS purity FROM pairs WHERE area IS NOT NULL GROUP BY area",
    "agg_a9_involvement": f"WITH {_PAIRS} SELECT label, count(*) AS n FROM (SELECT unnest([domain, domain_b]) AS label FROM pairs WHERE domain != domain_b) GROUP BY label",
    "agg_a10_leverage": f"""WITH {_PAIRS}, {_STORED}, c AS (SELECT domain_s AS domain, count(*) AS corpus_n FROM stored WHERE domain_s IS NOT NULL GROUP BY 1), j AS (SELECT domain, count(*) AS judged, count(*) FILTER (domain != domain_b) AS disagreed FROM pairs WHERE domain IS NOT NULL AND domain_b IS NOT NULL GROUP BY 1)
      SELECT domain, corpus_n, coalesce(judged, 0) AS judged, round(corpus_n * (disagreed / judged), 4) AS leverage FROM c LEFT JOIN j USING (domain)""",
    "agg_a11_domain_profile": f"WITH {labels_sql()} SELECT domain, count(*) AS n, round(sum(confidence), 4) AS sum_confidence, count(*) FILTER (confidence < 0.5) AS n_low, count(*) FILTER (confidence >= 0.5 AND confidence < 0.8) AS n_mid, count(*) FILTER (confidence >= 0.8) AS n_high FROM labels GROUP BY domain",
    "agg_a12_cross_split": f"WITH {_PAIRS} SELECT area != area_b AS is_cross, band, count(*) AS n FROM pairs WHERE domain != domain_b GROUP BY ALL",
    "agg_a13_usage_totals": "SELECT event_type, count(*) AS n, sum((props ->> '$.k')::BIGINT)::BIGINT AS sum_k, round(sum(value), 2) AS sum_value FROM events GROUP BY event_type",
    "agg_a19_win_summary": f"""WITH {_JUDGED} SELECT band, count(*) AS n, count(*) FILTER (winner = 'new') AS new_wins, count(*) FILTER (winner = 'old') AS old_wins, count(*) FILTER (winner = 'tie') AS ties,
      count(*) FILTER (winner = 'new') - count(*) FILTER (winner = 'old') AS margin, round(count(*) FILTER (winner = 'new') / nullif(count(*) FILTER (winner != 'tie'), 0), 4) AS win_rate FROM judged GROUP BY band""",
    "agg_a20_patterns": f"WITH {_JUDGED} SELECT area || ' -> ' || area_b AS pattern, winner, count(*) AS n FROM judged WHERE area != area_b GROUP BY ALL ORDER BY n DESC, pattern, winner LIMIT 10",
    "agg_a21_before_after": f"""WITH {labels_sql()}, {labels_sql("other", "audit50_v21_batches")}, a AS (SELECT area, count(*) AS n FROM labels GROUP BY 1), b AS (SELECT area, count(*) AS n FROM other GROUP BY 1)
      SELECT coalesce(a.area, b.area) AS area, coalesce(a.n, 0) AS n_old, coalesce(b.n, 0) AS n_new, coalesce(b.n, 0) - coalesce(a.n, 0) AS delta FROM a FULL JOIN b ON a.area IS NOT DISTINCT FROM b.area""",
    "agg_a22_baseline_delta": f"""WITH {_PAIRS}, {_STORED}, b AS (SELECT band, round(100 * count(*) FILTER (agree) / nullif(count(agree), 0), 2) AS pct_base FROM pairs GROUP BY band),
      n AS (SELECT band, round(100 * count(*) FILTER (area = area_s) / count(*), 2) AS pct_now FROM pairs JOIN stored USING (id) WHERE area IS NOT NULL AND area_s IS NOT NULL GROUP BY band) SELECT band, pct_base, pct_now, round(pct_now - pct_base, 2) AS delta FROM b JOIN n USING (band)""",
    "agg_a23_policy_scores": f"""WITH {_JUDGED}, s AS (SELECT area_s, unnest([{{'p': 'old', 'l': area}}, {{'p': 'new', 'l': area_b}}, {{'p': 'new_midband', 'l': CASE WHEN band = '0.5-0.8' THEN area_b ELSE area END}}]) AS x FROM judged WHERE area_s IS NOT NULL)
      SELECT x.p AS policy, count(*) AS n, count(*) FILTER (x.l = area_s) AS agreed FROM s GROUP BY 1""",
    "agg_a28_top_share": f"WITH {labels_sql()}, c AS (SELECT area, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS share FROM labels WHERE area IS NOT NULL GROUP BY area) SELECT area, n, share, share > 0.7 AS is_degenerate FROM c ORDER BY n DESC, area LIMIT 1",
    "agg_a33_changed_split": f"WITH {_JUDGED} SELECT area != area_b AS changed, count(*) AS n, count(*) FILTER (area_b = area_s) AS agreed FROM judged WHERE area_s IS NOT NULL GROUP BY 1",
    "agg_a35_corpus_profile": """SELECT count(*) AS n_rows, count(DISTINCT _id) AS n_papers, count(abstract) AS with_abstract, count(*) FILTER (len(iitd_authors) > 0) AS with_authors, count(classification.thematic_area_id) AS with_area,
      count(*) FILTER (classification.unclassifiable) AS n_unclassifiable, count(DISTINCT publication_year) AS n_years FROM researchmetadatascopus""",
    "join_j13_disagreements": f"WITH {_PAIRS}, {PAPERS}, o AS (SELECT id, area, area_b, count(*) OVER (PARTITION BY area, area_b) AS pair_n FROM pairs WHERE area != area_b) SELECT o.id, area, area_b, pair_n, title FROM o LEFT JOIN papers USING (id)",
}
