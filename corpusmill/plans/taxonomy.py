"""Taxonomy edits and the checks before labels are accepted."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import checks as C
from ..operators.distributed import latest
from ..operators.taxonomy import edit_taxonomy
from ..functions.text import key
from ..sources.tables import load
from .base import PAPERS, TAXONOMY, papers, taxonomy
from .sqltext import stripped

#: Edits of the example: (action, area, domain, text).
EDITS = (
    ("append", "Energy & Climate Systems", "Batteries & Storage", " Also covers second-life cells. "), ("append", "Energy & Climate Systems", "Batteries & Storage", "Not fuel cells."),
    ("append", "Energy & Climate Systems", "No Such Domain", "x"), ("add", "Energy & Climate Systems", "Hydrogen Carriers", "Papers about ammonia and liquid carriers."),
    ("add", "Energy & Climate Systems", "Batteries & Storage", "x"), ("add", "Energy & Climate Systems", "Hydrogen Carriers", "x"), ("add", "No Such Area", "Something", "x"),
)


def _edited(spark, sf_dir):
    texts = load(spark, sf_dir, "domains").where("deleted_at IS NULL").select(F.col("_id").alias("domain_id"), "definition")
    dim = taxonomy(spark, sf_dir).join(texts, "domain_id").select("area_name", "domain_name", "definition")
    edits = spark.createDataFrame([(i, *e) for i, e in enumerate(EDITS)], "at int, action string, area_name string, domain_name string, definition string")
    return edit_taxonomy(dim, edits)


def edited_taxonomy(spark, sf_dir):
    return _edited(spark, sf_dir)[0]


def refused_edits(spark, sf_dir):
    return _edited(spark, sf_dir)[1]


def taxonomy_gates(spark, sf_dir):
    """Checks of the edited taxonomy: sizes of areas, names used twice, a domain and a note that must be there."""
    dim = _edited(spark, sf_dir)[0]
    per = dim.groupBy("area_name").agg(F.count(F.lit(1)).alias("k"))
    notes = load(spark, sf_dir, "thematicareas").where("name = 'Health & Life Engineering'")
    return C.report([
        C.none_where("areas_have_3_to_10_domains", per, (F.col("k") < 3) | (F.col("k") > 10)), C.unique("domain_names_unique", dim, "domain_name"),
        C.check("added_domain_present", dim, F.count_if(F.col("domain_name") == "Hydrogen Carriers"), "value = 1"), C.check("scope_note_names_biology", notes, F.count_if(F.lower("scope_note").contains("biology")), "value > 0"),
    ])


def label_gates(spark, sf_dir):
    """Labels against corpus and taxonomy: ids twice, missing, unknown, and pairs of names that are not in the taxonomy as spelled."""
    raw = load(spark, sf_dir, "audit50_v21_sample").select(key("id").alias("id"), "thematic_area", "domain", "unclassifiable", "labelled_at")
    now = latest(raw, ["id"], ["labelled_at"]).where(~F.coalesce("unclassifiable", F.lit(False)))
    corpus = papers(spark, sf_dir).select("id")
    pairs = taxonomy(spark, sf_dir).select(F.col("area_name").alias("thematic_area"), F.col("domain_name").alias("domain"))
    return C.report([
        C.unique("ids_unique", raw, "id"), C.referenced("every_paper_labelled", corpus, "id", raw, "id"), C.referenced("labels_in_corpus", raw, "id", corpus, "id"),
        C.check("pairs_in_taxonomy", now.join(pairs, ["thematic_area", "domain"], "left_anti"), F.count(F.lit(1)), "value = 0"),
    ])


QUERIES = {"checks_taxonomy_edited": edited_taxonomy, "checks_taxonomy_refused": refused_edits, "checks_taxonomy_gates": taxonomy_gates, "checks_label_gates": label_gates}

_Q = lambda x: "'" + x.replace("'", "''") + "'"
_DIM = f"""{TAXONOMY}, dim AS (SELECT t.area_name, t.domain_name, d.definition FROM taxonomy t JOIN domains d ON d._id = t.domain_id),
edits AS (SELECT * FROM (VALUES {", ".join(f"({i}, {', '.join(map(_Q, e))})" for i, e in enumerate(EDITS))}) AS v(nr, action, area_name, domain_name, definition)),
k AS (SELECT e.*, EXISTS (SELECT 1 FROM dim d WHERE d.area_name = e.area_name AND d.domain_name = e.domain_name) AS there, (SELECT count(*) FROM dim d WHERE d.area_name = e.area_name) AS size, row_number() OVER (PARTITION BY action, area_name, domain_name ORDER BY nr) AS again FROM edits e),
j AS (SELECT *, size + sum((action = 'add' AND NOT there AND again = 1 AND size > 0)::INT) OVER (PARTITION BY area_name ORDER BY nr) AS place FROM k),
judged AS (SELECT *, CASE WHEN action = 'append' THEN CASE WHEN NOT there THEN 'unknown domain' END WHEN size = 0 THEN 'unknown area' WHEN there OR again > 1 THEN 'duplicate domain' WHEN place > 10 THEN 'area is full' END AS reason FROM j),
edited AS (SELECT area_name, domain_name, coalesce(rtrim(definition) || (SELECT string_agg('  ' || trim(j.definition), '' ORDER BY nr) FROM judged j WHERE j.action = 'append' AND j.reason IS NULL AND j.area_name = dim.area_name AND j.domain_name = dim.domain_name), definition) AS definition FROM dim
  UNION ALL SELECT area_name, domain_name, definition FROM judged WHERE action = 'add' AND reason IS NULL)"""
_CHECK = "SELECT '{n}' AS \"check\", v {p} AS pass, v::VARCHAR AS detail FROM (SELECT count(*) AS v FROM ({q}))"
_GATES = [("areas_have_3_to_10_domains", "= 0", "SELECT area_name FROM edited GROUP BY 1 HAVING count(*) < 3 OR count(*) > 10"), ("domain_names_unique", "= 0", "SELECT domain_name FROM edited GROUP BY 1 HAVING count(*) > 1"), ("added_domain_present", "= 1", "SELECT 1 FROM edited WHERE domain_name = 'Hydrogen Carriers'"),
    ("scope_note_names_biology", "> 0", "SELECT 1 FROM thematicareas WHERE name = 'Health & Life Engineering' AND lower(scope_note) LIKE '%biology%'")]
_LABEL_GATES = [("ids_unique", "= 0", "SELECT id FROM raw GROUP BY 1 HAVING count(*) > 1"), ("every_paper_labelled", "= 0", "SELECT id FROM papers WHERE id NOT IN (SELECT id FROM raw WHERE id IS NOT NULL)"), ("labels_in_corpus", "= 0", "SELECT DISTINCT id FROM raw WHERE id NOT IN (SELECT id FROM papers)"),
    ("pairs_in_taxonomy", "= 0", "SELECT 1 FROM now WHERE NOT EXISTS (SELECT 1 FROM taxonomy t WHERE t.area_name = a AND t.domain_name = d)")]
SQL = {
    "checks_taxonomy_edited": f"WITH {_DIM} SELECT * FROM edited",
    "checks_taxonomy_refused": f"WITH {_DIM} SELECT action, area_name, domain_name, reason FROM judged WHERE reason IS NOT NULL",
    "checks_taxonomy_gates": f"WITH {_DIM} " + " UNION ALL ".join(_CHECK.format(n=n, p=p, q=q) for n, p, q in _GATES),
    "checks_label_gates": f"""WITH {PAPERS}, {TAXONOMY}, raw AS (SELECT {stripped("lower(id)")} AS id, thematic_area, domain, unclassifiable, labelled_at FROM audit50_v21_sample),
      now AS (SELECT id, v.a AS a, v.d AS d FROM (SELECT id, arg_max(v, (labelled_at, v.a, v.d, v.u)) AS v FROM (SELECT id, labelled_at, {{'a': thematic_area, 'd': domain, 'u': unclassifiable}} AS v FROM raw) GROUP BY id) WHERE NOT coalesce(v.u, false)) """ + " UNION ALL ".join(_CHECK.format(n=n, p=p, q=q) for n, p, q in _LABEL_GATES),
}
