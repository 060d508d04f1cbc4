"""Graph of faculty, papers, domains and areas; explore and inverted indices; checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.rules import display_name
from ..functions.text import norm
from ..operators import checks as C
from ..operators.distributed import latest
from ..operators.graph import edges, explore_index, inverted_index, nodes
from ..sources.tables import load
from .base import AUTHORS, PAPERS, TAXONOMY, authors, labels, labels_sql, papers, taxonomy
from .sqltext import norm as norm_sql


def _facts(spark, sf_dir):
    """Authors of known faculty, once per paper and faculty member."""
    people = load(spark, sf_dir, "faculties").select(F.col("_id").alias("faculty_id"), display_name(F.col("title"), F.col("firstname"), F.col("lastname"), otherwise="Unknown Faculty").alias("name"), "created_at")
    people = latest(people, ["faculty_id"], ["created_at", "name"]).drop("created_at")
    own = authors(spark, sf_dir).where("faculty_id IS NOT NULL").groupBy("id", "faculty_id").agg(F.min("department_id").alias("department_id"), F.min("domain_id").alias("domain_id"))
    dim = taxonomy(spark, sf_dir).select("domain_id", "domain_name", "area_name")
    return own.join(people, "faculty_id").join(dim, "domain_id", "left")


def graph_nodes(spark, sf_dir):
    facts = _facts(spark, sf_dir)
    titles = papers(spark, sf_dir, "title")
    return nodes([("faculty", facts, "faculty_id", "name"), ("paper", titles, "id", "title"), ("domain", facts, "domain_name", "domain_name"), ("area", facts, "area_name", "area_name")])


def graph_edges(spark, sf_dir):
    facts = _facts(spark, sf_dir)
    found = edges([("AUTHORED", facts, "faculty", "faculty_id", "paper", "id"), ("IN_DOMAIN", facts, "paper", "id", "domain", "domain_name"), ("BELONGS_TO", facts, "domain", "domain_name", "area", "area_name")])
    return found.groupBy("source", "target", "label").agg(F.count(F.lit(1)).alias("n"))


def search_index(spark, sf_dir):
    return _facts(spark, sf_dir).groupBy("faculty_id", "name").agg(F.count(F.lit(1)).alias("paper_count"))


def explore(spark, sf_dir):
    found = explore_index(_facts(spark, sf_dir), "domain_name", "department_id", "faculty_id", "id")
    return found.select(F.col("domain_name").alias("term"), "count", F.posexplode("departments").alias("pos", "d")).select("term", "count", "pos", "d.department", "d.paper_count", "d.person_count", F.array_join(F.transform("d.people", lambda p: F.concat(p["person"], F.lit("="), p["n"].cast("string"))), ",").alias("people"))


def faculty_index(spark, sf_dir):
    found = inverted_index(_facts(spark, sf_dir), "faculty_id", "id")
    return found.select("faculty_id", F.array_join("entries", ",").alias("papers"), "n")


def department_index(spark, sf_dir):
    found = inverted_index(_facts(spark, sf_dir), "department_id", "id")
    return found.select("department_id", F.md5(F.array_join("entries", ",")).alias("digest"), "n")


def relabelled_points(spark, sf_dir):
    """Papers with the names of their latest label; papers without one keep the stored names."""
    rows = papers(spark, sf_dir, "domain_id", "citations").join(taxonomy(spark, sf_dir), "domain_id", "left")
    now = labels(spark, sf_dir).where("area IS NOT NULL").select("id", "area", F.col("domain").alias("_d"))
    return rows.join(now, "id", "left").select("id", F.coalesce("area", norm("area_name")).alias("area"), F.when(F.col("area").isNotNull(), F.col("_d")).otherwise(norm("domain_name")).alias("domain"), F.coalesce("citations", F.lit(0)).alias("citations"))


def checks_report(spark, sf_dir):
    dim = taxonomy(spark, sf_dir)
    lab = labels(spark, sf_dir)
    per = dim.groupBy("area_name").agg(F.count(F.lit(1)).alias("k"))
    names = dim.select(norm("area_name").alias("area")).distinct()
    stored = papers(spark, sf_dir, "domain_id")
    return C.report([
        C.none_where("domains_per_area_at_most_10", per, F.col("k") > 10), C.unique("domain_names_unique", dim, "domain_name"), C.unique("label_ids_unique", lab, "id"),
        C.referenced("labels_in_corpus", lab, "id", stored, "id"), C.referenced("label_areas_known", lab, "area", names, "area"), C.referenced("stored_domains_known", stored, "domain_id", dim, "domain_id"),
        C.none_where("confidence_in_range", lab, (F.col("confidence") < 0) | (F.col("confidence") > 1)), C.check("labels_present", lab, F.count(F.lit(1)), "value > 0"),
    ])


QUERIES = {"graph_nodes": graph_nodes, "graph_edges": graph_edges, "graph_search_index": search_index, "graph_a30_explore": explore, "graph_a31_faculty_index": faculty_index, "graph_a31_department_index": department_index, "join_j9_relabelled_points": relabelled_points, "checks_report": checks_report}

_S = lambda c: f"nullif(trim(coalesce({c}, '')), '')"
_FACTS = f"""{AUTHORS}, {TAXONOMY}, people AS (SELECT _id AS faculty_id, name FROM (SELECT _id, coalesce(nullif(concat_ws(' ', {_S("title")}, {_S("firstname")}, {_S("lastname")}), ''), 'Unknown Faculty') AS name, row_number() OVER (PARTITION BY _id ORDER BY created_at DESC, coalesce(nullif(concat_ws(' ', {_S("title")}, {_S("firstname")}, {_S("lastname")}), ''), 'Unknown Faculty') DESC) AS rn FROM faculties) WHERE rn = 1),
own AS (SELECT id, faculty_id, min(department_id) AS department_id, min(domain_id) AS domain_id FROM authors WHERE faculty_id IS NOT NULL GROUP BY id, faculty_id),
facts AS (SELECT o.*, p.name, t.domain_name, t.area_name FROM own o JOIN people p USING (faculty_id) LEFT JOIN taxonomy t USING (domain_id))"""
_PER = "per AS (SELECT domain_name AS term, department_id AS department, faculty_id AS person, count(DISTINCT id) AS n FROM facts WHERE domain_name IS NOT NULL AND department_id IS NOT NULL GROUP BY ALL)"
_CHECK = "SELECT '{n}' AS \"check\", v {p} AS pass, v::VARCHAR AS detail FROM (SELECT count(*) AS v FROM ({q}))"
SQL = {
    "graph_nodes": f"""WITH {_FACTS} SELECT 'faculty:' || faculty_id AS id, 'faculty' AS kind, min(name) AS label FROM facts GROUP BY faculty_id UNION ALL SELECT 'paper:' || id, 'paper', title FROM papers
      UNION ALL SELECT DISTINCT 'domain:' || domain_name, 'domain', domain_name FROM facts WHERE domain_name IS NOT NULL UNION ALL SELECT DISTINCT 'area:' || area_name, 'area', area_name FROM facts WHERE area_name IS NOT NULL""",
    "graph_edges": f"""WITH {_FACTS}, e AS (SELECT 'faculty:' || faculty_id AS source, 'paper:' || id AS target, 'AUTHORED' AS label FROM facts UNION ALL SELECT 'paper:' || id, 'domain:' || domain_name, 'IN_DOMAIN' FROM facts WHERE domain_name IS NOT NULL
      UNION ALL SELECT 'domain:' || domain_name, 'area:' || area_name, 'BELONGS_TO' FROM facts WHERE area_name IS NOT NULL) SELECT source, target, label, count(*) AS n FROM e GROUP BY ALL""",
    "graph_search_index": f"WITH {_FACTS} SELECT faculty_id, name, count(*) AS paper_count FROM facts GROUP BY ALL",
    "graph_a30_explore": f"""WITH {_FACTS}, {_PER}, d AS (SELECT term, department, sum(n)::BIGINT AS paper_count, count(*) AS person_count, string_agg(person || '=' || n, ',' ORDER BY n DESC, person) AS people FROM per GROUP BY ALL)
      SELECT term, sum(paper_count) OVER (PARTITION BY term)::BIGINT AS count, row_number() OVER (PARTITION BY term ORDER BY paper_count DESC, department) - 1 AS pos, department, paper_count, person_count, people FROM d""",
    "graph_a31_faculty_index": f"WITH {_FACTS} SELECT faculty_id, string_agg(DISTINCT id, ',' ORDER BY id) AS papers, count(DISTINCT id)::INT AS n FROM facts GROUP BY faculty_id",
    "graph_a31_department_index": f"WITH {_FACTS} SELECT department_id, md5(string_agg(DISTINCT id, ',' ORDER BY id)) AS digest, count(DISTINCT id)::INT AS n FROM facts WHERE department_id IS NOT NULL GROUP BY department_id",
    "join_j9_relabelled_points": f"""WITH {PAPERS}, {TAXONOMY}, {labels_sql()} SELECT p.id, coalesce(l.area, {norm_sql("t.area_name")}) AS area, CASE WHEN l.area IS NOT NULL THEN l.domain ELSE {norm_sql("t.domain_name")} END AS domain, coalesce(citations, 0) AS citations
      FROM papers p LEFT JOIN taxonomy t USING (domain_id) LEFT JOIN (SELECT * FROM labels WHERE area IS NOT NULL) l ON l.id = p.id""",
    "checks_report": f"WITH {PAPERS}, {TAXONOMY}, {labels_sql()} " + " UNION ALL ".join(_CHECK.format(n=n, p=p, q=q) for n, p, q in [
        ("domains_per_area_at_most_10", "= 0", "SELECT area_name FROM taxonomy GROUP BY 1 HAVING count(*) > 10"), ("domain_names_unique", "= 0", "SELECT domain_name FROM taxonomy GROUP BY 1 HAVING count(*) > 1"), ("label_ids_unique", "= 0", "SELECT id FROM labels GROUP BY 1 HAVING count(*) > 1"),
        ("labels_in_corpus", "= 0", "SELECT id FROM labels WHERE id NOT IN (SELECT id FROM papers)"), ("label_areas_known", "= 0", f"SELECT DISTINCT area FROM labels WHERE area IS NOT NULL AND area NOT IN (SELECT {norm_sql('area_name')} FROM taxonomy)"),
        ("stored_domains_known", "= 0", "SELECT DISTINCT domain_id FROM papers WHERE domain_id IS NOT NULL AND domain_id NOT IN (SELECT domain_id FROM taxonomy)"), ("confidence_in_range", "= 0", "SELECT id FROM labels WHERE confidence < 0 OR confidence > 1"), ("labels_present", "> 0", "SELECT id FROM labels"),
    ]),
}
