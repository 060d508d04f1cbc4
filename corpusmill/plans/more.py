"""Scans, nested dimensions, version comparisons and composed samples."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import rules as R
from ..functions.text import band, norm, reference_key, squash
from ..operators.sampling import hash_order, largest_remainder, staged_sample, take_per_stratum
from ..operators.vectors import nearest_centroids
from ..sources.tables import load
from .base import AUTHORS, PAPERS, TAXONOMY, authors, labels, labels_sql, papers, taxonomy
from .sqltext import norm as norm_sql
from .sqltext import reference_key as reference_key_sql
from .vectors import _CENTS, _cents

OTHER = "audit50_v21_batches"
SEED = "20260719"


def batch_lookup(spark, sf_dir):
    """Years of the papers whose ids the audit table names: a semi join, not batches of ids."""
    wanted = load(spark, sf_dir, "audit100_v22_batch2_results").select(F.lower(F.trim("id")).alias("id"))
    return papers(spark, sf_dir, "year", "citations").join(wanted, "id", "left_semi")


def regex_scan(spark, sf_dir):
    """The first 400 papers by id whose title matches a pattern (a limited search)."""
    return papers(spark, sf_dir, "title").where(F.col("title").rlike("(?i)storage|batter|supercapacitor")).orderBy("id").limit(400).select("id", squash("title").alias("title"))


def counts_and_distinct(spark, sf_dir):
    rows = load(spark, sf_dir, "researchmetadatascopus")
    return rows.groupBy("publication_year").agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("_id").alias("n_papers"), F.count_if(F.col("abstract").isNull()).alias("n_without_abstract"))


def nested_dimension(spark, sf_dir):
    """The taxonomy as one nested row per area, written to JSON text and read back to pairs."""
    nested = taxonomy(spark, sf_dir).groupBy("area_name").agg(F.array_sort(F.collect_list(F.struct("domain_name", "domain_id"))).alias("domains"))
    text = nested.select(F.to_json(F.struct("area_name", "domains")).alias("j"))
    back = text.select(F.from_json("j", "area_name string, domains array<struct<domain_name: string, domain_id: string>>").alias("t"))
    return back.select("t.area_name", F.posexplode("t.domains").alias("pos", "d")).select("area_name", "pos", "d.domain_name", "d.domain_id")


def renamed_compare(spark, sf_dir):
    """Domains of the two copies after a rename table is applied to both; what still differs."""
    names = load(spark, sf_dir, "domains").select(norm("name").alias("old"), norm("slug").alias("new"))
    a = labels(spark, sf_dir).select("id", "domain").join(names, F.col("domain") == F.col("old"), "left").select("id", F.coalesce("new", "domain").alias("a"))
    b = labels(spark, sf_dir, OTHER).select("id", "domain").join(names, F.col("domain") == F.col("old"), "left").select("id", F.coalesce("new", "domain").alias("b"))
    return a.join(b, "id").where(~F.col("a").eqNullSafe(F.col("b")))


def tristate(spark, sf_dir):
    """Area and domain agreement of the copies: true, false, or null where they cannot be compared."""
    a = labels(spark, sf_dir).alias("a")
    b = labels(spark, sf_dir, OTHER).alias("b")
    ok = F.col("a.area").isNotNull() & F.col("b.area").isNotNull()
    joined = a.join(b, "id").select(R.agreement(F.col("a.area"), F.col("b.area"), ok).alias("area_agrees"), R.agreement(F.col("a.domain"), F.col("b.domain"), ok).alias("domain_agrees"))
    return joined.groupBy("area_agrees", "domain_agrees").agg(F.count(F.lit(1)).alias("n"))


def clamped_models(spark, sf_dir):
    rows = labels(spark, sf_dir).select(R.clamped(F.col("model"), ["haiku", "sonnet"], "other").alias("model"), F.when(F.col("escalated"), "Y").otherwise("N").alias("escalated"))
    return rows.groupBy("model", "escalated").agg(F.count(F.lit(1)).alias("n"))


def accumulated_usage(spark, sf_dir):
    """Usage of a first try and its retries added up field by field; a missing try counts 0."""
    rows = load(spark, sf_dir, "events").select("user_id", "event_type", F.get_json_object("props", "$.k").cast("long").alias("k"), F.floor("value").cast("long").alias("v"))
    first = rows.where("event_type = 'click'").groupBy("user_id").agg(F.struct(F.sum("k").alias("k"), F.sum("v").alias("v")).alias("a"))
    again = rows.where("event_type != 'click'").groupBy("user_id").agg(F.struct(F.sum("k").alias("k"), F.sum("v").alias("v")).alias("b"))
    add = lambda f: F.coalesce(f"a.{f}", F.lit(0)) + F.coalesce(f"b.{f}", F.lit(0))
    return first.join(again, "user_id", "full").select("user_id", add("k").alias("k"), add("v").alias("v"))


def fallback_labels(spark, sf_dir):
    """The new label, or the old one with a note that is cut to 30 characters."""
    new = labels(spark, sf_dir, OTHER).where("confidence >= 0.9").select("id", F.col("domain").alias("new_domain"))
    rows = labels(spark, sf_dir).join(new, "id", "left")
    note = F.when(F.col("new_domain").isNull(), F.substring(F.concat(F.lit("api_failure_keep_old:"), F.coalesce("domain", F.lit("none"))), 1, 30))
    return rows.select("id", F.coalesce("new_domain", "domain").alias("domain"), note.alias("note"))


def department_resolution(spark, sf_dir):
    """Listed author departments by whether they resolve, per plain form of the field."""
    rows = authors(spark, sf_dir)
    return rows.groupBy(F.col("department_id").isNotNull().alias("resolved")).agg(F.count(F.lit(1)).alias("n"), F.countDistinct("id").alias("n_papers"))


def four_way(spark, sf_dir):
    """Both label copies, the stored domain and the title of each labelled paper."""
    stored = papers(spark, sf_dir, "domain_id", "title").join(taxonomy(spark, sf_dir), "domain_id", "left").select("id", norm("domain_name").alias("stored"), F.length("title").alias("title_len"))
    b = labels(spark, sf_dir, OTHER).select("id", F.col("domain").alias("second"))
    return labels(spark, sf_dir).select("id", F.col("domain").alias("first")).join(b, "id", "left").join(stored, "id", "left")


def author_faculty(spark, sf_dir):
    """Authors of known faculty, once per paper and person."""
    known = load(spark, sf_dir, "faculties").select(reference_key("_id").alias("faculty_id")).distinct()
    pairs = authors(spark, sf_dir).where("faculty_id IS NOT NULL").select("id", "faculty_id").distinct()
    return pairs.join(known, "faculty_id").groupBy("faculty_id").agg(F.count(F.lit(1)).alias("n_papers"))


def nearest_three(spark, sf_dir):
    """The three nearest centroids of each vector."""
    found = nearest_centroids(load(spark, sf_dir, "embeddings"), _cents(spark, sf_dir).withColumnRenamed("label", "nearest"), id_col="vec_id", vector="embedding", group="nearest", k=3)
    return found.select("vec_id", "nearest", F.round("similarity", 6).alias("similarity"), "rank")


def version_compare(spark, sf_dir):
    """Fields that changed between the first and the last version of papers with several."""
    rows = load(spark, sf_dir, "researchmetadatascopus").select("_id", "updated_at", "ingested_at", "title", "abstract", "citation_count")
    order = F.struct("updated_at", "ingested_at")
    ends = rows.groupBy(F.col("_id").alias("id")).agg(F.count_distinct("updated_at").alias("n"), F.min_by(F.struct("title", "abstract", "citation_count"), order).alias("a"), F.max_by(F.struct("title", "abstract", "citation_count"), order).alias("b")).where("n > 1")
    off = lambda f: (~F.col(f"a.{f}").eqNullSafe(F.col(f"b.{f}"))).alias(f"{f}_changed")
    return ends.select("id", "n", off("title"), off("abstract"), off("citation_count"))


def topped_up_sample(spark, sf_dir):
    """Five papers per year, those with an abstract first."""
    rows = papers(spark, sf_dir, "year", "abstract").where("year IS NOT NULL").select("id", "year", (F.length(F.coalesce("abstract", F.lit(""))) >= 100).alias("has_abstract"))
    rank = F.row_number().over(W.partitionBy("year").orderBy(F.desc("has_abstract"), hash_order(SEED, "id"), "id"))
    return rows.withColumn("rank", rank).where(F.col("rank") <= 5)


def ab_sample(spark, sf_dir):
    """Up to 60 changed and 40 unchanged labels, filled to 100."""
    b = labels(spark, sf_dir, OTHER).select("id", F.col("domain").alias("domain_b"))
    rows = labels(spark, sf_dir).join(b, "id").withColumn("changed", ~F.col("domain").eqNullSafe(F.col("domain_b")))
    return staged_sample(rows, [("changed", F.col("changed"), 60), ("unchanged", ~F.col("changed"), 40)], 100, "id", SEED)


def band_sample(spark, sf_dir):
    """Sixty labels in proportion to area and band together."""
    rows = labels(spark, sf_dir).where("area IS NOT NULL AND confidence IS NOT NULL").select("id", "area", band("confidence").alias("band"))
    seats = largest_remainder(rows.groupBy("area", "band").agg(F.count(F.lit(1)).alias("n")), "n", 60, "area", "band")
    return take_per_stratum(rows, seats, ["area", "band"], "id", SEED)


def example_titles(spark, sf_dir):
    """Per domain five different titles, those of papers with an abstract first."""
    rows = papers(spark, sf_dir, "domain_id", "title", "abstract").join(taxonomy(spark, sf_dir), "domain_id")
    rows = rows.select("domain_name", norm("title").alias("title"), "id", (F.length(F.coalesce("abstract", F.lit(""))) < 100).cast("int").alias("bare"))
    each = rows.groupBy("domain_name", "title").agg(F.min(F.struct("bare", "id")).alias("f"))
    rank = F.row_number().over(W.partitionBy("domain_name").orderBy("f", "title"))
    return each.withColumn("rank", rank).where(F.col("rank") <= 5).select("domain_name", "title", "f.id", "rank")


def label_shares(spark, sf_dir):
    """Share of each domain within its area."""
    counts = labels(spark, sf_dir).where("area IS NOT NULL AND domain IS NOT NULL").groupBy("area", "domain").agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("share", F.round(F.col("n") / F.sum("n").over(W.partitionBy("area")), 3))


def merged_cluster_sets(spark, sf_dir):
    """Models that labelled each domain in either copy, as one sorted set."""
    a = labels(spark, sf_dir).where("domain IS NOT NULL").groupBy("domain").agg(F.collect_set("model").alias("a"))
    b = labels(spark, sf_dir, OTHER).where("domain IS NOT NULL").groupBy("domain").agg(F.collect_set("model").alias("b"))
    none = F.array().cast("array<string>")
    return a.join(b, "domain", "full").select("domain", F.array_join(F.array_sort(F.array_union(F.coalesce("a", none), F.coalesce("b", none))), ",").alias("models"))


QUERIES = {
    "scan_s3_batch_lookup": batch_lookup, "scan_s4_regex_limit": regex_scan, "scan_s5_counts": counts_and_distinct, "scan_s8_nested_dimension": nested_dimension, "rule_p21_renamed_compare": renamed_compare, "rule_p27_tristate": tristate,
    "rule_p29_clamped": clamped_models, "rule_p30_accumulated_usage": accumulated_usage, "rule_p31_fallback": fallback_labels, "rule_p23_departments": department_resolution, "join_j1_four_way": four_way, "join_j8_author_faculty": author_faculty,
    "join_j10_nearest_three": nearest_three, "join_j12_version_compare": version_compare, "samp_m1_topped_up": topped_up_sample, "samp_m8_ab_sample": ab_sample, "samp_w4_band_sample": band_sample, "win_w3_example_titles": example_titles,
    "agg_a27_label_shares": label_shares, "set_u4_merged_sets": merged_cluster_sets,
}

_TWO = f"{labels_sql()}, {labels_sql('other', OTHER)}"
_USE = "SELECT user_id, sum((props ->> '$.k')::BIGINT)::BIGINT AS k, sum(floor(value)::BIGINT)::BIGINT AS v FROM events WHERE event_type {op} 'click' GROUP BY user_id"
SQL = {
    "scan_s3_batch_lookup": f"WITH {PAPERS} SELECT id, year, citations FROM papers WHERE id IN (SELECT lower(trim(id)) FROM audit100_v22_batch2_results)",
    "scan_s4_regex_limit": f"WITH {PAPERS} SELECT id, regexp_replace(regexp_replace(title, '[\\s\\x{{85}}\\x{{a0}}\\p{{Z}}]+', ' ', 'g'), '^ +| +$', '', 'g') AS title FROM papers WHERE regexp_matches(title, '(?i)storage|batter|supercapacitor') ORDER BY id LIMIT 400",
    "scan_s5_counts": "SELECT publication_year, count(*) AS n_rows, count(DISTINCT _id) AS n_papers, count(*) FILTER (abstract IS NULL) AS n_without_abstract FROM researchmetadatascopus GROUP BY 1",
    "scan_s8_nested_dimension": f"WITH {TAXONOMY} SELECT area_name, row_number() OVER (PARTITION BY area_name ORDER BY domain_name, domain_id) - 1 AS pos, domain_name, domain_id FROM taxonomy",
    "rule_p21_renamed_compare": f"""WITH {_TWO}, n AS (SELECT {norm_sql("name")} AS old, {norm_sql("slug")} AS new FROM domains), j AS (SELECT a.id, coalesce(x.new, a.domain) AS a, coalesce(y.new, b.domain) AS b FROM labels a JOIN other b USING (id) LEFT JOIN n x ON x.old = a.domain LEFT JOIN n y ON y.old = b.domain)
      SELECT * FROM j WHERE a IS DISTINCT FROM b""",
    "rule_p27_tristate": f"""WITH {_TWO} SELECT CASE WHEN a.area IS NOT NULL AND b.area IS NOT NULL THEN a.area = b.area END AS area_agrees, CASE WHEN a.area IS NOT NULL AND b.area IS NOT NULL THEN a.domain IS NOT DISTINCT FROM b.domain END AS domain_agrees, count(*) AS n
      FROM labels a JOIN other b USING (id) GROUP BY 1, 2""",
    "rule_p29_clamped": f"WITH {labels_sql()} SELECT CASE WHEN model IN ('haiku', 'sonnet') THEN model ELSE 'other' END AS model, CASE WHEN escalated THEN 'Y' ELSE 'N' END AS escalated, count(*) AS n FROM labels GROUP BY 1, 2",
    "rule_p30_accumulated_usage": f"WITH a AS ({_USE.format(op='=')}), b AS ({_USE.format(op='!=')}) SELECT user_id, coalesce(a.k, 0) + coalesce(b.k, 0) AS k, coalesce(a.v, 0) + coalesce(b.v, 0) AS v FROM a FULL JOIN b USING (user_id)",
    "rule_p31_fallback": f"""WITH {_TWO} SELECT a.id, coalesce(b.domain, a.domain) AS domain, CASE WHEN b.domain IS NULL THEN ('api_failure_keep_old:' || coalesce(a.domain, 'none'))[1:30] END AS note FROM labels a LEFT JOIN (SELECT id, domain FROM other WHERE confidence >= 0.9) b USING (id)""",
    "rule_p23_departments": f"WITH {AUTHORS} SELECT department_id IS NOT NULL AS resolved, count(*) AS n, count(DISTINCT id) AS n_papers FROM authors GROUP BY 1",
    "join_j1_four_way": f"WITH {_TWO}, {PAPERS}, {TAXONOMY} SELECT a.id, a.domain AS first, b.domain AS second, {norm_sql('t.domain_name')} AS stored, length(p.title) AS title_len FROM labels a LEFT JOIN other b USING (id) LEFT JOIN papers p USING (id) LEFT JOIN taxonomy t USING (domain_id)",
    "join_j8_author_faculty": f"WITH {AUTHORS} SELECT faculty_id, count(DISTINCT id) AS n_papers FROM authors WHERE faculty_id IN (SELECT {reference_key_sql('_id')} FROM faculties) GROUP BY 1",
    "join_j10_nearest_three": f"WITH {_CENTS}, s AS (SELECT vec_id, cents.label AS nearest, list_dot_product(v, c) AS s FROM e, cents), r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY round(s, 12) DESC, nearest) AS rank FROM s) SELECT vec_id, nearest, round(s, 6) AS similarity, rank FROM r WHERE rank <= 3",
    "join_j12_version_compare": """WITH e AS (SELECT _id AS id, count(DISTINCT updated_at) AS n, arg_min({'t': title, 'a': abstract, 'c': citation_count}, (updated_at, ingested_at)) AS a, arg_max({'t': title, 'a': abstract, 'c': citation_count}, (updated_at, ingested_at)) AS b FROM researchmetadatascopus GROUP BY _id)
      SELECT id, n, a.t IS DISTINCT FROM b.t AS title_changed, a.a IS DISTINCT FROM b.a AS abstract_changed, a.c IS DISTINCT FROM b.c AS citation_count_changed FROM e WHERE n > 1""",
    "samp_m1_topped_up": f"""WITH {PAPERS}, r AS (SELECT id, year, length(coalesce(abstract, '')) >= 100 AS has_abstract FROM papers WHERE year IS NOT NULL), k AS (SELECT *, row_number() OVER (PARTITION BY year ORDER BY has_abstract DESC, md5('{SEED}-' || id), id) AS rank FROM r) SELECT id, year, has_abstract, rank FROM k WHERE rank <= 5""",
    "samp_m8_ab_sample": f"""WITH {_TWO}, h AS (SELECT a.id, md5('{SEED}-' || a.id) AS h, a.domain IS DISTINCT FROM b.domain AS changed FROM labels a JOIN other b USING (id)), p AS (SELECT * FROM (SELECT id, 'changed' AS stage FROM h WHERE changed ORDER BY h, id LIMIT 60) UNION ALL SELECT * FROM (SELECT id, 'unchanged' FROM h WHERE NOT changed ORDER BY h, id LIMIT 40))
      SELECT id, stage FROM p UNION ALL SELECT * FROM (SELECT id, 'fill' FROM h WHERE id NOT IN (SELECT id FROM p) ORDER BY h, id LIMIT (SELECT 100 - count(*) FROM p))""",
    "samp_w4_band_sample": f"""WITH {labels_sql()}, r AS (SELECT id, area, CASE WHEN confidence < 0.5 THEN '<0.5' WHEN confidence < 0.8 THEN '0.5-0.8' ELSE '>=0.8' END AS band FROM labels WHERE area IS NOT NULL AND confidence IS NOT NULL), c AS (SELECT area, band, count(*) AS n FROM r GROUP BY ALL),
      e AS (SELECT *, n * 60 / sum(n) OVER () AS x FROM c), f AS (SELECT *, floor(x)::INT AS s, round(x - floor(x), 9) AS rest FROM e), q AS (SELECT area, band, s + (CASE WHEN row_number() OVER (ORDER BY rest DESC, area, band) <= 60 - sum(s) OVER () THEN 1 ELSE 0 END) AS seats FROM f),
      k AS (SELECT *, row_number() OVER (PARTITION BY area, band ORDER BY md5('{SEED}-' || id), id) AS rank FROM r) SELECT area, band, id, rank FROM k JOIN q USING (area, band) WHERE rank <= seats""",
    "win_w3_example_titles": f"""WITH {PAPERS}, {TAXONOMY}, r AS (SELECT domain_name, {norm_sql("title")} AS title, id, (length(coalesce(abstract, '')) < 100)::INT AS bare FROM papers JOIN taxonomy USING (domain_id)), e AS (SELECT domain_name, title, min((bare, id)) AS f FROM r GROUP BY ALL),
      k AS (SELECT *, row_number() OVER (PARTITION BY domain_name ORDER BY f, title) AS rank FROM e) SELECT domain_name, title, f[2] AS id, rank FROM k WHERE rank <= 5""",
    "agg_a27_label_shares": f"WITH {labels_sql()}, c AS (SELECT area, domain, count(*) AS n FROM labels WHERE area IS NOT NULL AND domain IS NOT NULL GROUP BY ALL) SELECT area, domain, n, round(n / sum(n) OVER (PARTITION BY area), 3) AS share FROM c",
    "set_u4_merged_sets": f"WITH {_TWO} SELECT domain, string_agg(DISTINCT model, ',' ORDER BY model) AS models FROM (SELECT domain, model FROM labels UNION ALL SELECT domain, model FROM other) WHERE domain IS NOT NULL GROUP BY domain",
}
