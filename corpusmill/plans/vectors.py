"""Vector queries over the embeddings table."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import vectors as V
from ..operators.distributed import require_at_most
from ..sources.tables import load


def _vectors(spark, sf_dir):
    return load(spark, sf_dir, "embeddings")


def _cents(spark, sf_dir):
    return V.centroids(_vectors(spark, sf_dir), "label", "embedding")


def centroid_table(spark, sf_dir):
    cents = _cents(spark, sf_dir)
    return cents.select("label", "n", F.posexplode("centroid").alias("pos", "x")).select("label", "n", "pos", F.round("x", 6).alias("x"))


def nearest(spark, sf_dir):
    found = V.nearest_centroids(_vectors(spark, sf_dir), _cents(spark, sf_dir).withColumnRenamed("label", "nearest"), id_col="vec_id", vector="embedding", group="nearest")
    return found.select("vec_id", "nearest", F.round("similarity", 6).alias("similarity"))


def cluster_reps(spark, sf_dir):
    found = V.representatives(_vectors(spark, sf_dir), _cents(spark, sf_dir), id_col="vec_id", vector="embedding", group="label", top=14)
    return found.select("label", "vec_id", F.round("similarity", 6).alias("similarity"), "rank")


def similarity_percentiles(spark, sf_dir):
    joined = _vectors(spark, sf_dir).join(_cents(spark, sf_dir), "label").select("label", V.dot(F.col("embedding"), F.col("centroid")).alias("s"))
    p = F.percentile("s", F.array(F.lit(0.10), F.lit(0.15), F.lit(0.5)))
    return joined.groupBy("label").agg(p.alias("p")).select("label", *[F.round(F.col("p")[i], 6).alias(n) for i, n in enumerate(("p10", "p15", "median"))])


def centroid_agreement(spark, sf_dir):
    found = V.nearest_centroids(_vectors(spark, sf_dir), _cents(spark, sf_dir).withColumnRenamed("label", "nearest"), id_col="vec_id", vector="embedding", group="nearest")
    joined = found.join(_vectors(spark, sf_dir).select("vec_id", "label"), "vec_id")
    return joined.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("label") == F.col("nearest")).alias("agreed"))


def worst_matches(spark, sf_dir):
    """The 80 vectors least like their own centroid."""
    joined = _vectors(spark, sf_dir).join(_cents(spark, sf_dir), "label").select("vec_id", "label", F.round(V.dot(F.col("embedding"), F.col("centroid")), 6).alias("similarity"))
    return joined.orderBy("similarity", "vec_id").limit(80)


def embedding_qa(spark, sf_dir):
    rows = _vectors(spark, sf_dir).select("vec_id", F.size("embedding").alias("d"), V.length(F.col("embedding")).alias("norm"))
    return rows.agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("vec_id").alias("n_ids"), F.min("d").alias("least_dim"), F.max("d").alias("most_dim"),
        F.round(F.min("norm"), 5).alias("least_norm"), F.round(F.max("norm"), 5).alias("most_norm"), F.round(F.avg("norm"), 5).alias("mean_norm"), F.round(F.stddev_pop("norm"), 5).alias("sd_norm"),
    )


def cluster_ranges(spark, sf_dir):
    sizes = _vectors(spark, sf_dir).groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    low, high = V.cluster_range(F.col("n"))
    return sizes.select("label", "n", low.alias("k_low"), high.alias("k_high"))


def sweep(spark, sf_dir):
    return V.kmeans_sweep(_vectors(spark, sf_dir), "embedding", [6, 8, 10])


def merged_groups(spark, sf_dir):
    """Ten labels merged down to seven."""
    rows = require_at_most(_cents(spark, sf_dir), V.MAX_CENTROIDS, "centroids")
    into = V.merge_smallest({str(r.label): (r.n, list(r.centroid)) for r in rows}, 7)
    return spark.createDataFrame(sorted(into.items()), "label string, final string")


def seeded_centroid(spark, sf_dir):
    """A new group from the 15 vectors nearest to the first one: their mean, of unit length, position by position."""
    first = _vectors(spark, sf_dir).orderBy("vec_id").limit(1).select(F.col("embedding").alias("seed"))
    near = V.nearest_to(_vectors(spark, sf_dir), first, "seed", id_col="vec_id", vector="embedding", top=15)
    mean = V.centroids(near.withColumn("label", F.lit(0)), "label", "embedding")
    return mean.select("n", F.posexplode("centroid").alias("pos", "x")).select("n", "pos", F.round("x", 6).alias("x"))


def cluster_shares(spark, sf_dir):
    """Share of all vectors that the clusters of each of four groups hold."""
    labels = _vectors(spark, sf_dir).select("label").distinct()
    groups = labels.groupBy((F.col("label") % 4).cast("int").alias("group")).agg(F.collect_set("label").alias("clusters"))
    return V.cluster_share(_vectors(spark, sf_dir), "label", groups)


QUERIES = {
    "vec_a24_centroids": centroid_table, "vec_v8_nearest_centroid": nearest, "vec_w2_cluster_reps": cluster_reps, "vec_a25_percentiles": similarity_percentiles, "vec_v12_centroid_agreement": centroid_agreement, "vec_j10_worst_matches": worst_matches,
    "vec_v11_embedding_qa": embedding_qa, "vec_v7_k_range": cluster_ranges, "vec_v6_kmeans_sweep": sweep, "vec_v10_merged_groups": merged_groups, "vec_v9_seed_group": seeded_centroid, "agg_a34_cluster_share": cluster_shares,
}

_CENTS = """e AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings), m AS (SELECT label, pos, avg(x) AS m FROM (SELECT label, unnest(v) AS x, generate_subscripts(v, 1) AS pos FROM e) GROUP BY ALL),
l AS (SELECT label, sqrt(sum(m * m)) AS len FROM m GROUP BY label), cents AS (SELECT label, list(m / len ORDER BY pos) AS c, (SELECT count(*) FROM e WHERE e.label = m.label) AS n FROM m JOIN l USING (label) GROUP BY label)"""
_BEST = "best AS (SELECT vec_id, e.label, arg_max(cents.label, (round(list_dot_product(v, c), 12), -cents.label)) AS nearest, max(list_dot_product(v, c)) AS s FROM e, cents GROUP BY ALL)"
SQL = {
    "vec_a24_centroids": f"WITH {_CENTS} SELECT label, n, (pos - 1)::INT AS pos, round(x, 6) AS x FROM (SELECT label, n, unnest(c) AS x, generate_subscripts(c, 1) AS pos FROM cents)",
    "vec_v8_nearest_centroid": f"WITH {_CENTS}, {_BEST} SELECT vec_id, nearest, round(s, 6) AS similarity FROM best",
    "vec_w2_cluster_reps": f"""WITH {_CENTS}, s AS (SELECT e.label, vec_id, list_dot_product(v, c) AS s FROM e JOIN cents USING (label)), r AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY round(s, 9) DESC, vec_id) AS rank FROM s)
      SELECT label, vec_id, round(s, 6) AS similarity, rank FROM r WHERE rank <= 14""",
    "vec_a25_percentiles": f"WITH {_CENTS}, s AS (SELECT e.label, list_dot_product(v, c) AS s FROM e JOIN cents USING (label)) SELECT label, round(quantile_cont(s, 0.10), 6) AS p10, round(quantile_cont(s, 0.15), 6) AS p15, round(quantile_cont(s, 0.5), 6) AS median FROM s GROUP BY label",
    "vec_v12_centroid_agreement": f"WITH {_CENTS}, {_BEST} SELECT label, count(*) AS n, count(*) FILTER (label = nearest) AS agreed FROM best GROUP BY label",
    "vec_j10_worst_matches": f"WITH {_CENTS} SELECT vec_id, e.label, round(list_dot_product(v, c), 6) AS similarity FROM e JOIN cents USING (label) ORDER BY similarity, vec_id LIMIT 80",
    "vec_v11_embedding_qa": """WITH r AS (SELECT vec_id, len(embedding) AS d, sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[])) AS norm FROM embeddings)
      SELECT count(*) AS n, count(DISTINCT vec_id) AS n_ids, min(d) AS least_dim, max(d) AS most_dim, round(min(norm), 5) AS least_norm, round(max(norm), 5) AS most_norm, round(avg(norm), 5) AS mean_norm, round(stddev_pop(norm), 5) AS sd_norm FROM r""",
    "vec_v7_k_range": """SELECT label, n, k_low, least(14, greatest(k_low, n // 40))::INT AS k_high FROM (SELECT label, count(*) AS n, (CASE WHEN count(*) >= 350 THEN 8 ELSE greatest(5, count(*) // 50) END)::INT AS k_low FROM embeddings GROUP BY label)""",
    "agg_a34_cluster_share": "SELECT (label % 4)::INT AS \"group\", count(*) AS n, round(count(*) / (SELECT count(*) FROM embeddings), 3) AS share FROM embeddings GROUP BY 1",
    "vec_v9_seed_group": """WITH e AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings), f AS (SELECT v AS c FROM e ORDER BY vec_id LIMIT 1), s AS (SELECT vec_id, list_dot_product(v, c) AS s FROM e, f),
      r AS (SELECT v FROM s JOIN e USING (vec_id) ORDER BY round(s, 9) DESC, vec_id LIMIT 15), m AS (SELECT pos, avg(x) AS m, count(*) AS n FROM (SELECT unnest(v) AS x, generate_subscripts(v, 1) AS pos FROM r) GROUP BY pos)
      SELECT n, (pos - 1)::INT AS pos, round(m / (SELECT sqrt(sum(m * m)) FROM m), 6) AS x FROM m""",
}
