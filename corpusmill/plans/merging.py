"""Joins, coverage, merges and upserts over the label copies."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import band, norm, reference_key
from ..operators.labels import conditional_merge, coverage, overwrite_nested, patch_rows, precedence_merge, upsert_dimension
from ..sources.tables import load
from .base import PAPERS, TAXONOMY, labels, labels_sql, papers, taxonomy
from .sqltext import norm as norm_sql
from .sqltext import reference_key as reference_key_sql

OTHER = "audit50_v21_batches"
_BAND = "CASE WHEN confidence IS NULL THEN 'none' WHEN confidence < 0.5 THEN '<0.5' WHEN confidence < 0.8 THEN '0.5-0.8' ELSE '>=0.8' END"


def labelled_papers(spark, sf_dir):
    """Papers that have a label: semi join on ids only."""
    return papers(spark, sf_dir, "year").join(labels(spark, sf_dir).select("id"), "id", "left_semi")


def unlabelled_papers(spark, sf_dir):
    """Work that is left: anti join on ids only."""
    return papers(spark, sf_dir, "year").join(labels(spark, sf_dir).select("id"), "id", "left_anti").groupBy("year").agg(F.count(F.lit(1)).alias("n"))


def label_coverage(spark, sf_dir):
    return coverage(labels(spark, sf_dir), labels(spark, sf_dir, OTHER), "id").groupBy("side").agg(F.count(F.lit(1)).alias("n"))


def bad_pairs(spark, sf_dir):
    """Labels whose area and domain are no pair of the taxonomy."""
    pairs = taxonomy(spark, sf_dir).select(norm("area_name").alias("area"), norm("domain_name").alias("domain"))
    return labels(spark, sf_dir).where("area IS NOT NULL AND domain IS NOT NULL").join(pairs, ["area", "domain"], "left_anti").select("id", "area", "domain")


def dimension_lookup(spark, sf_dir):
    """Papers per name of area and domain; the dimension side is small by its size estimate."""
    rows = papers(spark, sf_dir, "domain_id").join(taxonomy(spark, sf_dir), "domain_id")
    return rows.groupBy("area_name", "domain_name").agg(F.count(F.lit(1)).alias("n"))


def precedence(spark, sf_dir):
    """For each paper the audited copy's label if it is usable, else the other's, else the stored one."""
    usable = F.col("area").isNotNull() & ~F.col("unclassifiable")
    first = labels(spark, sf_dir).withColumn("usable", usable & F.col("escalated"))
    second = labels(spark, sf_dir, OTHER).withColumn("usable", usable)
    stored = papers(spark, sf_dir, "domain_id").join(taxonomy(spark, sf_dir), "domain_id").select("id", norm("area_name").alias("area"), norm("domain_name").alias("domain"), F.lit(True).alias("usable"))
    merged = precedence_merge(papers(spark, sf_dir).select("id"), [("sample", first), ("batches", second), ("stored", stored)], "id", ["area", "domain"])
    return merged.groupBy("source", "area").agg(F.count(F.lit(1)).alias("n"))


def conditional(spark, sf_dir):
    """The second copy's label where a rule accepts it; the rule is recorded."""
    keep = ["id", "area", "domain", "confidence"]
    rules = [("gap", F.col("o.area").isNull()), ("surer", F.col("n.confidence") > F.col("o.confidence")), ("midband", (band("o.confidence", "none") == "0.5-0.8") & (F.col("n.confidence") >= 0.5))]
    merged = conditional_merge(labels(spark, sf_dir).select(*keep), labels(spark, sf_dir, OTHER).select(*keep), "id", ["area", "domain", "confidence"], rules)
    return merged.select("id", "area", "domain", "rule", "changed")


def repass_set(spark, sf_dir):
    """Unsure labels, and sure ones of the three largest domains, with the reason."""
    rows = labels(spark, sf_dir).where("NOT unclassifiable")
    sinks = rows.where("domain IS NOT NULL").groupBy("domain").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "domain").limit(3).select("domain", F.lit(True).alias("is_sink"))
    reason = F.when(F.coalesce("confidence", F.lit(0.0)) < 0.8, "lowconf").when(F.col("is_sink"), "hi_conf_sink")
    return rows.join(sinks, "domain", "left").select("id", reason.alias("reason")).where("reason IS NOT NULL")


def patched(spark, sf_dir):
    patch = labels(spark, sf_dir, OTHER).where("confidence > 0.9").select("id", "area", "domain")
    return patch_rows(labels(spark, sf_dir).select("id", "area", "domain", "model"), patch, "id", ["area", "domain"])


def nested_overwrite(spark, sf_dir):
    """Stored classifications with the area and domain keys of the labels."""
    dim = taxonomy(spark, sf_dir).select("area_id", "domain_id", norm("area_name").alias("area"), norm("domain_name").alias("domain"))
    patch = labels(spark, sf_dir).join(dim, ["area", "domain"]).select(F.col("id").alias("_id"), F.col("area_id").alias("thematic_area_id"), "domain_id")
    rows = load(spark, sf_dir, "researchmetadatascopus").select("_id", "classification", "updated_at")
    done = overwrite_nested(rows, patch, "_id", "classification")
    return done.select(F.col("_id").alias("id"), "updated_at", F.col("classification.thematic_area_id").alias("area_id"), F.col("classification.domain_id").alias("domain_id"), F.array_join("classification.topics", "|").alias("topics"))


def dimension_upsert(spark, sf_dir):
    existing = load(spark, sf_dir, "domains").select("name", F.col("_id").alias("id"))
    wanted = load(spark, sf_dir, "domains").where("deleted_at IS NULL").select("name").unionByName(load(spark, sf_dir, "nation").select(F.col("n_name").alias("name")))
    return upsert_dimension(existing, wanted, "name", "id")


def union_outside(spark, sf_dir):
    """Labels with the unclassifiable papers appended."""
    rows = labels(spark, sf_dir).where("area IS NOT NULL").select("id", "area", "model")
    outside = papers(spark, sf_dir, "unclassifiable").where("unclassifiable").join(rows.select("id"), "id", "left_anti").select("id", F.lit(None).cast("string").alias("area"), F.lit("hygiene").alias("model"))
    return rows.unionByName(outside)


def id_sets(spark, sf_dir):
    """Sizes of the set operations over the two copies' ids."""
    a, b = labels(spark, sf_dir).select("id"), labels(spark, sf_dir, OTHER).select("id")
    parts = {"left_minus_right": a.exceptAll(b), "right_minus_left": b.exceptAll(a), "intersection": a.intersect(b), "union": a.union(b).distinct()}
    out = None
    for name, df in parts.items():
        one = df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("op"), "n")
        out = one if out is None else out.unionByName(one)
    return out


def nested_filter(spark, sf_dir):
    """Papers with a stored area and at least one author, filtered on nested fields."""
    rows = load(spark, sf_dir, "researchmetadatascopus").where(F.col("classification.thematic_area_id").isNotNull() & (F.size("iitd_authors") > 0))
    return rows.groupBy(reference_key("classification.thematic_area_id").alias("area_id")).agg(F.count(F.lit(1)).alias("n"))


def first_per_area(spark, sf_dir):
    """Positions of the first label of each domain in the order of time and id."""
    rows = labels(spark, sf_dir).where("domain IS NOT NULL")
    return rows.groupBy("domain").agg(F.min(F.struct("labelled_at", "id")).alias("f")).select("domain", "f.id")


QUERIES = {
    "join_j3_labelled_papers": labelled_papers, "join_j4_unlabelled_papers": unlabelled_papers, "join_j5_label_coverage": label_coverage, "join_j6_bad_pairs": bad_pairs, "join_j7_dimension_lookup": dimension_lookup, "join_j2_precedence_merge": precedence,
    "join_j11_conditional_merge": conditional, "set_u5_repass_set": repass_set, "sink_s12_patch_rows": patched, "sink_s15_overwrite_nested": nested_overwrite, "sink_s16_dimension_upsert": dimension_upsert, "set_u1_union_outside": union_outside,
    "set_u2_id_sets": id_sets, "scan_s2_nested_filter": nested_filter, "win_w8_first_occurrence": first_per_area,
}

_TWO = f"{labels_sql()}, {labels_sql('other', OTHER)}"
SQL = {
    "join_j3_labelled_papers": f"WITH {PAPERS}, {labels_sql()} SELECT id, year FROM papers WHERE id IN (SELECT id FROM labels)",
    "join_j4_unlabelled_papers": f"WITH {PAPERS}, {labels_sql()} SELECT year, count(*) AS n FROM papers WHERE id NOT IN (SELECT id FROM labels) GROUP BY year",
    "join_j5_label_coverage": f"WITH {_TWO} SELECT CASE WHEN b.id IS NULL THEN 'left_only' WHEN a.id IS NULL THEN 'right_only' ELSE 'both' END AS side, count(*) AS n FROM labels a FULL JOIN other b USING (id) GROUP BY 1",
    "join_j6_bad_pairs": f"WITH {labels_sql()}, {TAXONOMY} SELECT id, area, domain FROM labels l WHERE area IS NOT NULL AND domain IS NOT NULL AND NOT EXISTS (SELECT 1 FROM taxonomy t WHERE {norm_sql('t.area_name')} = l.area AND {norm_sql('t.domain_name')} = l.domain)",
    "join_j7_dimension_lookup": f"WITH {PAPERS}, {TAXONOMY} SELECT area_name, domain_name, count(*) AS n FROM papers JOIN taxonomy USING (domain_id) GROUP BY ALL",
    "join_j2_precedence_merge": f"""WITH {_TWO}, {PAPERS}, {TAXONOMY}, m AS (SELECT p.id, CASE WHEN a.area IS NOT NULL AND NOT a.unclassifiable AND a.escalated THEN 'sample' WHEN b.area IS NOT NULL AND NOT b.unclassifiable THEN 'batches' WHEN t.area_name IS NOT NULL THEN 'stored' ELSE 'none' END AS source,
      a.area AS aa, b.area AS ba, {norm_sql("t.area_name")} AS sa FROM papers p LEFT JOIN labels a USING (id) LEFT JOIN other b USING (id) LEFT JOIN taxonomy t USING (domain_id))
      SELECT source, CASE source WHEN 'sample' THEN aa WHEN 'batches' THEN ba WHEN 'stored' THEN sa END AS area, count(*) AS n FROM m GROUP BY ALL""",
    "join_j11_conditional_merge": f"""WITH {_TWO}, j AS (SELECT o.id, o.area, o.domain, o.confidence, n.area AS na, n.domain AS nd, n.confidence AS nc, CASE WHEN n.id IS NULL THEN NULL WHEN o.area IS NULL THEN 'gap' WHEN n.confidence > o.confidence THEN 'surer'
      WHEN o.confidence >= 0.5 AND o.confidence < 0.8 AND n.confidence >= 0.5 THEN 'midband' END AS rule FROM labels o LEFT JOIN other n ON n.id = o.id)
      SELECT id, CASE WHEN rule IS NULL THEN area ELSE na END AS area, CASE WHEN rule IS NULL THEN domain ELSE nd END AS domain, rule,
        rule IS NOT NULL AND (area IS DISTINCT FROM na OR domain IS DISTINCT FROM nd OR confidence IS DISTINCT FROM nc) AS changed FROM j""",
    "set_u5_repass_set": f"""WITH {labels_sql()}, r AS (SELECT * FROM labels WHERE NOT unclassifiable), s AS (SELECT domain FROM r WHERE domain IS NOT NULL GROUP BY domain ORDER BY count(*) DESC, domain LIMIT 3),
      q AS (SELECT id, CASE WHEN coalesce(confidence, 0) < 0.8 THEN 'lowconf' WHEN domain IN (SELECT domain FROM s) THEN 'hi_conf_sink' END AS reason FROM r) SELECT id, reason FROM q WHERE reason IS NOT NULL""",
    "sink_s12_patch_rows": f"WITH {_TWO} SELECT a.id, CASE WHEN b.id IS NULL THEN a.area ELSE b.area END AS area, CASE WHEN b.id IS NULL THEN a.domain ELSE b.domain END AS domain, a.model FROM labels a LEFT JOIN (SELECT * FROM other WHERE confidence > 0.9) b USING (id)",
    "sink_s15_overwrite_nested": f"""WITH {labels_sql()}, {TAXONOMY}, p AS (SELECT l.id, t.area_id, t.domain_id FROM labels l JOIN taxonomy t ON {norm_sql("t.area_name")} = l.area AND {norm_sql("t.domain_name")} = l.domain)
      SELECT r._id AS id, updated_at, CASE WHEN p.id IS NULL THEN classification.thematic_area_id ELSE p.area_id END AS area_id, CASE WHEN p.id IS NULL THEN classification.domain_id ELSE p.domain_id END AS domain_id, array_to_string(classification.topics, '|') AS topics
      FROM researchmetadatascopus r LEFT JOIN p ON p.id = r._id""",
    "sink_s16_dimension_upsert": """WITH w AS (SELECT name FROM domains WHERE deleted_at IS NULL UNION SELECT n_name FROM nation) SELECT coalesce(d.name, w.name) AS name, coalesce(d._id, md5(w.name)[1:24]) AS id,
      CASE WHEN w.name IS NULL THEN 'delete' WHEN d.name IS NULL THEN 'insert' ELSE 'keep' END AS action FROM domains d FULL JOIN w ON d.name = w.name""",
    "set_u1_union_outside": f"WITH {labels_sql()}, {PAPERS} SELECT id, area, model FROM labels WHERE area IS NOT NULL UNION ALL SELECT id, NULL, 'hygiene' FROM papers WHERE unclassifiable AND id NOT IN (SELECT id FROM labels WHERE area IS NOT NULL)",
    "set_u2_id_sets": f"""WITH {_TWO} SELECT 'left_minus_right' AS op, count(*) AS n FROM (SELECT id FROM labels EXCEPT SELECT id FROM other) UNION ALL SELECT 'right_minus_left', count(*) FROM (SELECT id FROM other EXCEPT SELECT id FROM labels)
      UNION ALL SELECT 'intersection', count(*) FROM (SELECT id FROM labels INTERSECT SELECT id FROM other) UNION ALL SELECT 'union', count(*) FROM (SELECT id FROM labels UNION SELECT id FROM other)""",
    "scan_s2_nested_filter": f"SELECT {reference_key_sql('classification.thematic_area_id')} AS area_id, count(*) AS n FROM researchmetadatascopus WHERE classification.thematic_area_id IS NOT NULL AND len(iitd_authors) > 0 GROUP BY 1",
    "win_w8_first_occurrence": f"WITH {labels_sql()} SELECT domain, id FROM (SELECT domain, id, row_number() OVER (PARTITION BY domain ORDER BY labelled_at, id) AS rn FROM labels WHERE domain IS NOT NULL) WHERE rn = 1",
}
