"""Sampling, budget and queue windows."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import band
from ..operators.distributed import latest, require_at_most
from ..operators.metrics import frequency
from ..operators.sampling import band_allocation, hash_order, largest_remainder, staged_sample, take_per_stratum
from ..operators.windows import rolling_sum, running_total
from ..sources.tables import load
from .base import labels, labels_sql

SEED = "20260718"
SHARES = {"<0.5": 0.4, "0.5-0.8": 0.3, ">=0.8": 0.3}


def _counts(spark, sf_dir):
    return labels(spark, sf_dir).where("area IS NOT NULL").groupBy("area").agg(F.count(F.lit(1)).alias("n"))


def area_quota(spark, sf_dir):
    return largest_remainder(_counts(spark, sf_dir), "n", 250, "area")


def area_allocation(spark, sf_dir):
    """Ten seats per area and the rest of 250 in proportion."""
    counts = _counts(spark, sf_dir)
    areas = counts.count()
    return largest_remainder(counts, "n", 250 - 10 * areas, "area").withColumn("seats", F.col("seats") + 10)


def stratified(spark, sf_dir):
    rows = labels(spark, sf_dir).where("area IS NOT NULL")
    return take_per_stratum(rows.select("id", "area"), area_quota(spark, sf_dir), ["area"], "id", SEED)


def band_seats(spark, sf_dir):
    """Seats per area and band, capped by what is there and redistributed."""
    rows = labels(spark, sf_dir).where("area IS NOT NULL AND confidence IS NOT NULL").groupBy("area", band("confidence").alias("band")).agg(F.count(F.lit(1)).cast("int").alias("n"))
    cells = [tuple(r) for r in require_at_most(rows.orderBy("area", "band"), 10_000, "cells of area and band")]
    per = {r.area: r.seats for r in require_at_most(area_allocation(spark, sf_dir), 10_000, "areas")}
    return spark.createDataFrame(band_allocation(cells, per, SHARES), "area string, band string, seats int")


def spot_check(spark, sf_dir):
    rows = labels(spark, sf_dir)
    stages = [("high", F.col("confidence") >= 0.8, 15), ("low", F.col("confidence") < 0.6, 15), ("escalated", F.col("escalated"), 15)]
    return staged_sample(rows, stages, 60, "id", SEED)


def audit_sample(spark, sf_dir):
    return labels(spark, sf_dir).where("area IS NOT NULL").orderBy(hash_order("50", "id"), "id").limit(50).select("id", "area", "domain")


def quota_pair(spark, sf_dir):
    """Ninety confident labels and ten others."""
    rows = labels(spark, sf_dir).where("confidence IS NOT NULL")
    kind = F.when(F.col("confidence") >= 0.6, "ok").otherwise("low")
    seats = spark.createDataFrame([("ok", 90), ("low", 10)], "kind string, seats int")
    return take_per_stratum(rows.select("id", kind.alias("kind")), seats, ["kind"], "id", "42")


def latest_event(spark, sf_dir):
    rows = load(spark, sf_dir, "events").select("user_id", "event_id", "ts", "event_type")
    return latest(rows, ["user_id"], ["ts", "event_id"])


def rolling_minute(spark, sf_dir):
    rows = load(spark, sf_dir, "events").select("event_id", "ts", F.get_json_object("props", "$.k").cast("long").alias("k"))
    return rolling_sum(rows, "ts", ["k"], 60).select("event_id", "k_rolling", "n_rolling")


def cumulative_usage(spark, sf_dir):
    rows = load(spark, sf_dir, "events").select("event_id", F.get_json_object("props", "$.k").cast("long").alias("k"))
    return running_total(rows, "event_id", "k", width=5_000).select("event_id", F.col("total").alias("used"), (F.col("total") > 100_000).alias("is_over"))


def budget_prefix(spark, sf_dir):
    """Events in order of id while the budget lasts, at the mean usage of one event."""
    rows = load(spark, sf_dir, "events").select("event_id", F.get_json_object("props", "$.k").cast("long").alias("k"))
    mean = rows.agg(F.avg("k").alias("mean"))
    one = rows.select("event_id", F.lit(1).alias("one"))
    placed = running_total(one, "event_id", "one", width=5_000, name="place")
    return placed.join(mean, how="cross").where(F.col("place") <= F.floor(10_000 / F.col("mean"))).select("event_id", "place")  # one row


def priority_queue(spark, sf_dir):
    """The 200 most urgent labels: least confident first, null as 0.5, then by id."""
    rows = labels(spark, sf_dir).select("id", F.coalesce("confidence", F.lit(0.5)).alias("confidence"), F.when(F.col("escalated"), 1).when(F.col("confidence") < 0.6, 2).otherwise(3).alias("tier"))
    return rows.orderBy("tier", "confidence", "id").limit(200)


def rank_share(spark, sf_dir):
    return frequency(labels(spark, sf_dir).where("domain IS NOT NULL"), "domain", "area")


QUERIES = {
    "samp_m3_largest_remainder": area_quota, "samp_m4_area_allocation": area_allocation, "samp_m7_stratified": stratified, "samp_m5_band_allocation": band_seats, "samp_m9_spot_check": spot_check, "samp_m10_audit_sample": audit_sample,
    "samp_m2_quota_pair": quota_pair, "win_w1_latest_per_key": latest_event, "win_w9_rolling_minute": rolling_minute, "win_w10_cumulative_usage": cumulative_usage, "win_w11_budget_prefix": budget_prefix, "win_w5_priority_queue": priority_queue, "win_w7_rank_share": rank_share,
}

_QUOTA = f"""{labels_sql()}, c AS (SELECT area, count(*) AS n FROM labels WHERE area IS NOT NULL GROUP BY area), t AS (SELECT <total> AS total),
e AS (SELECT c.*, t.total, n * t.total / sum(n) OVER () AS x FROM c, t), f AS (SELECT *, floor(x)::INT AS s, round(x - floor(x), 9) AS rest FROM e),
quota AS (SELECT area, n, s + (CASE WHEN row_number() OVER (ORDER BY rest DESC, area) <= total - sum(s) OVER () THEN 1 ELSE 0 END) AS seats FROM f)"""
_BAND = "CASE WHEN confidence < 0.5 THEN '<0.5' WHEN confidence < 0.8 THEN '0.5-0.8' ELSE '>=0.8' END"
_M5 = f"""WITH {labels_sql()}, c AS (SELECT area, {_BAND} AS band, count(*)::INT AS n FROM labels WHERE area IS NOT NULL AND confidence IS NOT NULL GROUP BY ALL),
g AS (SELECT area, count(*) AS n FROM labels WHERE area IS NOT NULL GROUP BY area), e AS (SELECT area, n * (250 - 10 * (SELECT count(*) FROM g)) / sum(n) OVER () AS x FROM g),
f AS (SELECT area, floor(x)::INT AS s, round(x - floor(x), 9) AS rest FROM e), w AS (SELECT area, 10 + s + (row_number() OVER (ORDER BY rest DESC, area) <= 250 - 10 * (SELECT count(*) FROM g) - sum(s) OVER ())::INT AS want FROM f),
s AS (SELECT c.*, w.want, CASE band WHEN '<0.5' THEN 0.4::DOUBLE ELSE 0.3::DOUBLE END AS share FROM c JOIN w USING (area)), b AS (SELECT *, least(n, floor(want * share)::INT) AS base, row_number() OVER (PARTITION BY area ORDER BY share DESC, band) AS o FROM s),
x AS (SELECT area, band, n, want, base, sum(base) OVER (PARTITION BY area) AS have, o FROM b), extra AS (SELECT *, unnest(range(1, n - base + 1)) AS r FROM x), got AS (SELECT area, band, row_number() OVER (PARTITION BY area ORDER BY r, o) <= want - have AS ok FROM extra),
m AS (SELECT x.area, x.band, x.n, x.want, x.base + coalesce((SELECT count(*) FROM got WHERE got.area = x.area AND got.band = x.band AND ok), 0) AS seats FROM x),
more AS (SELECT area, band, unnest(range(1, n - seats + 1)) AS r, n - seats AS room FROM m), top AS (SELECT area, band FROM more QUALIFY row_number() OVER (ORDER BY room - r + 1 DESC, area, band) <= (SELECT sum(want) FROM w) - (SELECT sum(seats) FROM m))
SELECT m.area, m.band, (m.seats + (SELECT count(*) FROM top WHERE top.area = m.area AND top.band = m.band))::INT AS seats FROM m"""
SQL = {
    "samp_m5_band_allocation": _M5,
    "samp_m3_largest_remainder": f"WITH {_QUOTA.replace("<total>", "250")} SELECT area, n, seats FROM quota",
    "samp_m4_area_allocation": f"WITH {_QUOTA.replace("<total>", "(SELECT 250 - 10 * count(*) FROM c)")} SELECT area, n, seats + 10 AS seats FROM quota",
    "samp_m7_stratified": f"""WITH {_QUOTA.replace("<total>", "250")}, r AS (SELECT id, area, row_number() OVER (PARTITION BY area ORDER BY md5('{SEED}-' || id), id) AS rank FROM labels WHERE area IS NOT NULL)
      SELECT area, id, rank FROM r JOIN quota USING (area) WHERE rank <= seats""",
    "samp_m9_spot_check": f"""WITH {labels_sql()}, h AS (SELECT *, md5('{SEED}-' || id) AS h FROM labels), a AS (SELECT id FROM h WHERE confidence >= 0.8 ORDER BY h, id LIMIT 15),
      b AS (SELECT id FROM h WHERE confidence < 0.6 AND id NOT IN (FROM a) ORDER BY h, id LIMIT 15), c AS (SELECT id FROM h WHERE escalated AND id NOT IN (FROM a) AND id NOT IN (FROM b) ORDER BY h, id LIMIT 15),
      p AS (SELECT id, 'high' AS stage FROM a UNION ALL SELECT id, 'low' FROM b UNION ALL SELECT id, 'escalated' FROM c), f AS (SELECT id FROM h WHERE id NOT IN (SELECT id FROM p) ORDER BY h, id LIMIT 60)
      SELECT id, stage FROM p UNION ALL SELECT * FROM (SELECT id, 'fill' FROM f JOIN h USING (id) ORDER BY h, id LIMIT (SELECT 60 - count(*) FROM p))""",
    "samp_m10_audit_sample": f"WITH {labels_sql()} SELECT id, area, domain FROM labels WHERE area IS NOT NULL ORDER BY md5('50-' || id), id LIMIT 50",
    "samp_m2_quota_pair": f"""WITH {labels_sql()}, r AS (SELECT id, CASE WHEN confidence >= 0.6 THEN 'ok' ELSE 'low' END AS kind FROM labels WHERE confidence IS NOT NULL), k AS (SELECT *, row_number() OVER (PARTITION BY kind ORDER BY md5('42-' || id), id) AS rank FROM r)
      SELECT kind, id, rank FROM k WHERE rank <= CASE kind WHEN 'ok' THEN 90 ELSE 10 END""",
    "win_w1_latest_per_key": "SELECT user_id, event_id, ts, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1",
    "win_w9_rolling_minute": "SELECT event_id, sum((props ->> '$.k')::BIGINT) OVER w AS k_rolling, count(*) OVER w AS n_rolling FROM events WINDOW w AS (ORDER BY ts RANGE BETWEEN INTERVAL 60 SECONDS PRECEDING AND CURRENT ROW)",
    "win_w10_cumulative_usage": "SELECT event_id, used, used > 100000 AS is_over FROM (SELECT event_id, sum((props ->> '$.k')::BIGINT) OVER (ORDER BY event_id) AS used FROM events)",
    "win_w11_budget_prefix": "SELECT event_id, place FROM (SELECT event_id, row_number() OVER (ORDER BY event_id) AS place FROM events) WHERE place <= floor(10000 / (SELECT avg((props ->> '$.k')::BIGINT) FROM events))",
    "win_w5_priority_queue": f"WITH {labels_sql()} SELECT id, coalesce(confidence, 0.5) AS confidence, CASE WHEN escalated THEN 1 WHEN confidence < 0.6 THEN 2 ELSE 3 END AS tier FROM labels ORDER BY tier, 2, id LIMIT 200",
    "win_w7_rank_share": f"WITH {labels_sql()}, c AS (SELECT domain, area, count(*) AS n FROM labels WHERE domain IS NOT NULL GROUP BY ALL) SELECT domain, area, n, row_number() OVER (ORDER BY n DESC, domain, area NULLS LAST) AS rank, round(n / sum(n) OVER (), 6) AS share FROM c",
}
