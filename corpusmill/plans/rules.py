"""Scalar rules over the papers, labels and dimension tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import rules as R
from ..functions.hygiene import JUNK_PATTERNS, hygiene
from ..functions.text import band, key, norm, squash, ustrip
from ..operators.distributed import latest
from ..operators.slugs import free_slugs
from ..sources.tables import load
from .base import AUTHORS, PAPERS, TAXONOMY, authors, labels, labels_sql, papers, taxonomy
from .sqltext import norm as norm_sql
from .sqltext import stripped

#: Groups of words that point to a subject; ASCII only, so that engines agree.
KEYWORDS = {"storage": "(?i)batter(y|ies)|supercapacitor", "learning": "(?i)neural|label noise", "water": "(?i)wastewater|groundwater", "imaging": "(?i)tomograph|retinal scan", "photonics": "(?i)waveguide|entangled photon"}
#: An old name of a domain and the one it goes by.
RENAMED = {"Ceramics & Oxides": "Polymers & Gels"}
DECISION = "(?i)where|also|covers"


def hygiene_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = papers(spark, sf_dir, "title", "abstract").withColumn("h", hygiene(F.col("title"), F.col("abstract")))
    return rows.select("id", "h.status", "h.reason", F.length(ustrip("title")).alias("title_len"))


def hygiene_reason_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hygiene_flags(spark, sf_dir).groupBy("status", "reason").agg(F.count(F.lit(1)).alias("n"))


def clean_paper(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Display form with the departments of the authors, each once in the order of authors."""
    rows = papers(spark, sf_dir, "title", "abstract", "authors")
    departments = F.array_distinct(F.filter(F.transform(F.coalesce("authors", F.array()), lambda a: ustrip(F.coalesce(a["department_ref"], F.lit("")))), lambda d: d != ""))
    return rows.select("id", ustrip(F.coalesce("title", F.lit(""))).alias("title"), R.clean_abstract(F.col("abstract")).alias("abstract"), F.array_join(departments, "|").alias("departments"))


def embedding_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Length and SHA-256 of each text to be embedded."""
    rows = papers(spark, sf_dir, "title", "abstract").withColumn("h", hygiene(F.col("title"), F.col("abstract")))
    texts = rows.select("id", R.embedding_text(F.col("title"), F.col("abstract"), F.col("h.status")).alias("text")).where("text IS NOT NULL")
    return texts.select("id", F.length("text").alias("n_chars"), F.sha2(F.encode("text", "UTF-8"), 256).alias("sha256"))


def norm_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spellings of area names by their plain form."""
    rows = load(spark, sf_dir, "audit50_v21_sample").select("thematic_area", norm("thematic_area").alias("plain"))
    return rows.groupBy("plain").agg(F.countDistinct("thematic_area").alias("n_spellings"), F.count(F.lit(1)).alias("n_rows"))


def band_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labels(spark, sf_dir).groupBy(band("confidence", "none").alias("band")).agg(F.count(F.lit(1)).alias("n"))


def extracted_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Domains stated in JSON inside free text, fences and prose around it."""
    fix = load(spark, sf_dir, "audit100_v22_batch2_results").select("suggested_fix").where("suggested_fix IS NOT NULL").distinct()
    prose = fix.select("suggested_fix", F.explode(F.array(F.col("suggested_fix"), F.concat(F.lit("Answer:\n```json\n"), "suggested_fix", F.lit("\n``` done")), F.concat(F.lit("I think "), "suggested_fix", F.lit(" fits")))).alias("answer"))
    return prose.groupBy(F.get_json_object(R.json_object(F.col("answer")), "$.domain").alias("domain")).agg(F.count(F.lit(1)).alias("n"))


def evidence_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = load(spark, sf_dir, "audit50_v21_sample").select(norm("reason").alias("reason"))
    return rows.groupBy(R.any_contains(F.col("reason"), ["out_of_scope", "out of scope", "no home"]).alias("has_evidence")).agg(F.count(F.lit(1)).alias("n"))


def keyword_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Papers per keyword group, over title and whole abstract."""
    rows = papers(spark, sf_dir, "title", "abstract").select("id", R.keyword_hits(F.concat_ws("\n", "title", "abstract"), KEYWORDS).alias("hits"))
    return rows.select(F.explode("hits").alias("keyword")).groupBy("keyword").agg(F.count(F.lit(1)).alias("n"))


def title_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles that match one pattern and not another, each title once by the smallest id."""
    rows = papers(spark, sf_dir, "title").where(F.col("title").rlike("(?i)(review|survey)") & ~F.col("title").rlike("(?i)(erratum|retract)"))
    return rows.groupBy(norm("title").alias("title")).agg(F.min("id").alias("id"))


def scope_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "domains").select("name", R.compact_scope(F.col("definition"), DECISION).alias("scope"))


def unique_slugs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slugs of part names, each the first that names before it leave free."""
    rows = load(spark, sf_dir, "part").select("p_partkey", "p_name", R.slug(F.col("p_name")).alias("base"))
    return free_slugs(rows, "base", ["p_name", "p_partkey"]).select("p_partkey", "slug")


def prompt_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prompt texts in the five lengths that are in use, as length and digest."""
    rows = papers(spark, sf_dir, "title", "abstract")
    texts = {900: R.prompt_text(F.col("title"), F.col("abstract"), 900, before="", between=". ", missing="")} | {n: R.prompt_text(F.col("title"), F.col("abstract"), n) for n in (1100, 1200, 1500)} | {1700: R.prompt_text(F.col("title"), F.col("abstract"), 1700, between="\nAbstract: ", missing="\nAbstract: (no abstract)")}
    return rows.select("id", *[F.length(t).alias(f"n{n}") for n, t in texts.items()], F.md5(F.concat_ws("|", *texts.values())).alias("digest"))


def out_of_scope_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return papers(spark, sf_dir, "title").where(R.out_of_scope(F.col("title"))).select("id", "title")


def strict_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels as spelled against the taxonomy, one domain renamed, areas locked where the other copy is sure."""
    from ..operators.labels import validate_strict

    raw = lambda table: latest(load(spark, sf_dir, table).select(key("id").alias("id"), F.col("thematic_area").alias("area"), "domain", "confidence", "unclassifiable", "labelled_at"), ["id"], ["labelled_at"])
    sure = raw("audit50_v21_batches").where("confidence >= 0.9").select("id", F.col("area").alias("locked"))
    checked = validate_strict(raw("audit50_v21_sample").join(sure, "id", "left"), taxonomy(spark, sf_dir), renames=RENAMED, locked="locked")
    return checked.select("id", "final_area", "final_domain", "note")


def digit_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model answers that start with a digit, decoded to names; answers are made from the events' JSON."""
    names = ["one", "two", "three", "four", "five", "six", "seven", "eight", "nine"]
    rows = load(spark, sf_dir, "events").select(R.first_digit_name(F.col("props"), names).alias("name"))
    return rows.groupBy(F.coalesce("name", F.lit("unclassifiable")).alias("name")).agg(F.count(F.lit(1)).alias("n"))


def token_estimates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = load(spark, sf_dir, "documents").select(F.lower(F.trim("source")).alias("source"), R.estimated_tokens(F.col("text")).alias("n"))
    return rows.groupBy("source").agg(F.sum("n").alias("n_tokens"), F.max("n").alias("largest"))


def faculty_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "faculties").select(F.col("_id").alias("id"), R.display_name(F.col("title"), F.col("firstname"), F.col("lastname"), otherwise="Unknown Faculty").alias("name")).distinct()


def first_department(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first author's department that can be resolved, in the order of authors."""
    rows = authors(spark, sf_dir).where("department_id IS NOT NULL")
    return rows.groupBy("id").agg(F.min_by("department_id", "pos").alias("department_id"))


def shown_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return papers(spark, sf_dir, "title").select("id", R.shown(squash("title"), 60).alias("title"))


def coin_flips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labels(spark, sf_dir).select("id", R.blind_flip("20260718", F.col("id")).alias("flip"))


def valid_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels against the taxonomy, with the area that a unique domain name gives back."""
    from ..operators.labels import resolve_by_domain, validate_labels

    dim = taxonomy(spark, sf_dir)
    checked = resolve_by_domain(validate_labels(labels(spark, sf_dir), dim), dim)
    return checked.select("id", "area_name", "domain_name", "valid", "note", "owner")


def theme_locked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with the area of the second copy of the labels forced upon the first."""
    from ..operators.labels import validate_labels

    other = labels(spark, sf_dir, "audit50_v21_batches").select("id", F.col("area").alias("locked"))
    joined = labels(spark, sf_dir).join(other, "id").withColumn("area", F.coalesce("locked", "area"))
    return validate_labels(joined, taxonomy(spark, sf_dir)).groupBy("valid").agg(F.count(F.lit(1)).alias("n"))


QUERIES = {
    "rule_p6_prompt_texts": prompt_texts, "rule_p14_out_of_scope_titles": out_of_scope_titles, "rule_p10_strict_labels": strict_labels,
    "rule_p4_hygiene_flags": hygiene_flags, "agg_a1_hygiene_reason_counts": hygiene_reason_counts, "rule_p1_clean_paper": clean_paper, "rule_p5_embedding_manifest": embedding_manifest,
    "rule_p7_norm_names": norm_names, "rule_p8_band_counts": band_counts, "rule_p11_extracted_json": extracted_json, "rule_p12_evidence_flags": evidence_flags, "agg_a32_keyword_counts": keyword_counts,
    "rule_p15_title_search": title_search, "rule_p16_compact_scope": scope_notes, "rule_p17_unique_slugs": unique_slugs, "rule_p19_digit_names": digit_names, "rule_p22_token_estimates": token_estimates,
    "rule_p24_faculty_names": faculty_names, "rule_p25_first_department": first_department, "rule_p26_shown_titles": shown_titles, "rule_p28_blind_flip": coin_flips, "rule_p9_valid_labels": valid_labels, "rule_p10_theme_locked": theme_locked,
}

_S = lambda c: stripped(f"coalesce({c}, '')")
_JUNK = "CASE " + " ".join(f"WHEN regexp_matches({_S('title')}, '{p}') THEN '{n}'" for n, p in JUNK_PATTERNS) + " END"
_FLAGS = f"""flags AS (SELECT id, title, abstract, CASE WHEN junk IS NOT NULL THEN 'unclassifiable' WHEN usable THEN 'ok' WHEN length({_S("title")}) >= 60 THEN 'title_only' ELSE 'unclassifiable' END AS status,
  CASE WHEN junk IS NOT NULL THEN 'junk_pattern:' || junk WHEN usable THEN 'usable_abstract' WHEN length({_S("title")}) >= 60 THEN 'no_abstract_informative_title' ELSE 'no_abstract_short_title' END AS reason,
  length({stripped("title")}) AS title_len FROM (SELECT *, {_JUNK} AS junk, lower({_S("abstract")}) != '(no abstract available)' AND length({_S("abstract")}) >= 100 AS usable FROM papers))"""
_VALID = f"""areas AS (SELECT DISTINCT area_name, {norm_sql("area_name")} AS a FROM taxonomy), pairs AS (SELECT {norm_sql("area_name")} AS a, {norm_sql("domain_name")} AS d, domain_name FROM taxonomy),
owners AS (SELECT {norm_sql("domain_name")} AS d, min(area_name) AS owner FROM taxonomy GROUP BY 1 HAVING count(*) = 1)"""
_CHECK = """SELECT l.id, areas.area_name, pairs.domain_name, CASE WHEN l.unclassifiable THEN '' WHEN areas.area_name IS NULL THEN 'theme_not_in_taxonomy:' || coalesce(l.area, '')
  WHEN pairs.domain_name IS NULL THEN 'domain_not_in_theme:' || coalesce(l.domain, '') ELSE '' END AS note, owners.owner
  FROM {l} l LEFT JOIN areas ON areas.a = l.area LEFT JOIN pairs ON pairs.a = l.area AND pairs.d = l.domain LEFT JOIN owners ON owners.d = l.domain"""
_RAW = lambda t: f"""SELECT id, v.area AS area, v.domain AS domain, v.confidence AS confidence, v.unclassifiable AS unclassifiable FROM (SELECT id, arg_max(v, (labelled_at, v.area, v.domain, v.confidence, v.unclassifiable)) AS v
  FROM (SELECT {stripped("lower(id)")} AS id, labelled_at, {{'area': thematic_area, 'domain': domain, 'confidence': confidence, 'unclassifiable': unclassifiable}} AS v FROM {t}) GROUP BY id)"""  # noqa: E731
_RENAMES = "CASE " + " ".join(f"WHEN a.domain = '{a}' THEN '{b}'" for a, b in RENAMED.items()) + " ELSE a.domain END"
SQL = {
    "rule_p4_hygiene_flags": f"WITH {PAPERS}, {_FLAGS} SELECT id, status, reason, title_len FROM flags",
    "agg_a1_hygiene_reason_counts": f"WITH {PAPERS}, {_FLAGS} SELECT status, reason, count(*) AS n FROM flags GROUP BY ALL",
    "rule_p1_clean_paper": f"""WITH {PAPERS} SELECT id, {_S("title")} AS title, CASE WHEN lower({_S("abstract")}) = '(no abstract available)' THEN '' ELSE substring({_S("abstract")}, 1, 1500) END AS abstract,
      coalesce((SELECT string_agg(d, '|' ORDER BY p) FROM (SELECT d, min(p) AS p FROM (SELECT {_S("x.department_ref")} AS d, p FROM (SELECT unnest(authors) AS x, generate_subscripts(authors, 1) AS p)) WHERE d != '' GROUP BY d)), '') AS departments FROM papers""",
    "rule_p5_embedding_manifest": f"""WITH {PAPERS}, {_FLAGS}, texts AS (SELECT id, CASE status WHEN 'ok' THEN {stripped("title")} || chr(10) || chr(10) || {stripped("abstract")} WHEN 'title_only' THEN {stripped("title")} END AS text FROM flags)
      SELECT id, length(text) AS n_chars, sha256(text) AS sha256 FROM texts WHERE text IS NOT NULL""",
    "rule_p7_norm_names": f"SELECT {norm_sql('thematic_area')} AS plain, count(DISTINCT thematic_area) AS n_spellings, count(*) AS n_rows FROM audit50_v21_sample GROUP BY 1",
    "rule_p8_band_counts": f"WITH {labels_sql()} SELECT CASE WHEN confidence IS NULL THEN 'none' WHEN confidence < 0.5 THEN '<0.5' WHEN confidence < 0.8 THEN '0.5-0.8' ELSE '>=0.8' END AS band, count(*) AS n FROM labels GROUP BY 1",
    "rule_p11_extracted_json": """SELECT CASE WHEN json_valid(suggested_fix) AND suggested_fix LIKE '{%' THEN suggested_fix ->> '$.domain' END AS domain, 3 * count(*) AS n FROM (SELECT DISTINCT suggested_fix FROM audit100_v22_batch2_results WHERE suggested_fix IS NOT NULL) GROUP BY 1""",
    "rule_p12_evidence_flags": f"SELECT contains(r, 'out_of_scope') OR contains(r, 'out of scope') OR contains(r, 'no home') AS has_evidence, count(*) AS n FROM (SELECT {norm_sql('reason')} AS r FROM audit50_v21_sample) GROUP BY 1",
    "agg_a32_keyword_counts": f"WITH {PAPERS}, t AS (SELECT concat_ws(chr(10), title, abstract) AS x FROM papers) " + " UNION ALL ".join(f"SELECT '{n}' AS keyword, count(*) AS n FROM t WHERE regexp_matches(x, '{p}') HAVING count(*) > 0" for n, p in KEYWORDS.items()),
    "rule_p15_title_search": f"WITH {PAPERS} SELECT {norm_sql('title')} AS title, min(id) AS id FROM papers WHERE regexp_matches(title, '(?i)(review|survey)') AND NOT regexp_matches(title, '(?i)(erratum|retract)') GROUP BY 1",
    "rule_p16_compact_scope": f"""SELECT name, (SELECT string_agg(s, ' ' ORDER BY i) FROM (SELECT unnest(parts) AS s, generate_subscripts(parts, 1) AS i) WHERE i = 1 OR regexp_matches(s, '{DECISION}')) AS scope
      FROM (SELECT name, string_split(regexp_replace(definition, '([.;])\\s+', '\\1' || chr(1), 'g'), chr(1)) AS parts FROM domains)""",
    # Name by name, with the list of slugs in use.
    "rule_p17_unique_slugs": """WITH RECURSIVE named AS (SELECT p_partkey, row_number() OVER (ORDER BY p_name, p_partkey) AS i, regexp_replace(regexp_replace(replace(lower(p_name), '&', ' and '), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g') AS base FROM part),
      most AS (SELECT max(k) + 20 AS m FROM (SELECT count(*) AS k FROM named GROUP BY base)),
      step AS (SELECT 0::BIGINT AS i, NULL::BIGINT AS p_partkey, NULL::VARCHAR AS slug, []::VARCHAR[] AS used UNION ALL
        SELECT i, p_partkey, s, list_append(used, s) FROM (SELECT n.i, n.p_partkey, t.used, CASE WHEN NOT list_contains(t.used, n.base) THEN n.base
          ELSE n.base || '-' || list_filter(range(2, (SELECT m FROM most)), lambda m: NOT list_contains(t.used, n.base || '-' || m))[1] END AS s FROM step t JOIN named n ON n.i = t.i + 1))
      SELECT p_partkey, slug FROM step WHERE i > 0""",
    "rule_p6_prompt_texts": f"""WITH {PAPERS}, t AS (SELECT id, coalesce(title, '') || CASE WHEN coalesce(abstract, '') != '' THEN '. ' || abstract[1:900] ELSE '' END AS t900, {", ".join(f"'Title: ' || coalesce(title, '') || CASE WHEN coalesce(abstract, '') != '' THEN chr(10) || chr(10) || 'Abstract: ' || abstract[1:{n}] ELSE chr(10) || chr(10) || '(No abstract available.)' END AS t{n}" for n in (1100, 1200, 1500))},
      'Title: ' || coalesce(title, '') || chr(10) || 'Abstract: ' || CASE WHEN coalesce(abstract, '') != '' THEN abstract[1:1700] ELSE '(no abstract)' END AS t1700 FROM papers)
      SELECT id, {", ".join(f"length(t{n})::INT AS n{n}" for n in (900, 1100, 1200, 1500, 1700))}, md5(concat_ws('|', t900, t1100, t1200, t1500, t1700)) AS digest FROM t""",
    "rule_p14_out_of_scope_titles": f"WITH {PAPERS} SELECT id, title FROM papers WHERE regexp_matches(title, '(?i)(?:{'|'.join(R.OUT_OF_SCOPE)})')",
    "rule_p10_strict_labels": f"""WITH {TAXONOMY}, a AS ({_RAW("audit50_v21_sample")}), b AS ({_RAW("audit50_v21_batches")}),
      l AS (SELECT a.id, a.unclassifiable, CASE WHEN b.confidence >= 0.9 THEN b.area END AS locked, a.area, {_RENAMES} AS d FROM a LEFT JOIN b USING (id)), j AS (SELECT *, coalesce(locked, area) AS ar FROM l)
      SELECT id, ar AS final_area, d AS final_domain, CASE WHEN coalesce(unclassifiable, false) OR EXISTS (SELECT 1 FROM taxonomy t WHERE t.area_name = ar AND t.domain_name = d) THEN 'ok' WHEN locked IS NOT NULL THEN 'domain_not_in_locked_theme:' || coalesce(d, '')
        WHEN NOT EXISTS (SELECT 1 FROM taxonomy t WHERE t.area_name = ar) THEN 'theme_not_in_taxonomy:' || coalesce(ar, '') ELSE 'domain_not_in_theme:' || coalesce(d, '') END AS note FROM j""",
    "rule_p19_digit_names": """SELECT coalesce(CASE WHEN d BETWEEN 1 AND 9 THEN list_extract(['one','two','three','four','five','six','seven','eight','nine'], d) END, 'unclassifiable') AS name, count(*) AS n
      FROM (SELECT try_cast(nullif(regexp_extract(props, '[0-9]'), '') AS INT) AS d FROM events) GROUP BY 1""",
    "rule_p22_token_estimates": "SELECT lower(trim(source)) AS source, sum(greatest(16, floor(length(text) / 4)))::BIGINT AS n_tokens, max(greatest(16, floor(length(text) / 4)))::INT AS largest FROM documents GROUP BY 1",
    "rule_p24_faculty_names": f"SELECT DISTINCT _id AS id, coalesce(nullif(concat_ws(' ', nullif({_S('title')}, ''), nullif({_S('firstname')}, ''), nullif({_S('lastname')}, '')), ''), 'Unknown Faculty') AS name FROM faculties",
    "rule_p25_first_department": f"WITH {AUTHORS} SELECT id, arg_min(department_id, pos) AS department_id FROM authors WHERE department_id IS NOT NULL GROUP BY id",
    "rule_p26_shown_titles": f"WITH {PAPERS}, t AS (SELECT id, regexp_replace(regexp_replace(title, '[\\s\\x{{85}}\\x{{a0}}\\p{{Z}}]+', ' ', 'g'), '^ +| +$', '', 'g') AS t FROM papers) SELECT id, CASE WHEN length(t) > 60 THEN t[1:60] || '...' ELSE t END AS title FROM t",
    "rule_p28_blind_flip": f"WITH {labels_sql()} SELECT id, right(md5('20260718-' || id), 1) IN ('1','3','5','7','9','b','d','f') AS flip FROM labels",
    "rule_p9_valid_labels": f"WITH {labels_sql()}, {TAXONOMY}, {_VALID} SELECT id, area_name, domain_name, note = '' AS valid, note, owner FROM ({_CHECK.format(l='labels')})",
    "rule_p10_theme_locked": f"""WITH {labels_sql()}, {labels_sql("other", "audit50_v21_batches")}, {TAXONOMY}, {_VALID}, forced AS (SELECT l.* REPLACE (coalesce(o.area, l.area) AS area) FROM labels l JOIN other o USING (id))
      SELECT note = '' AS valid, count(*) AS n FROM ({_CHECK.format(l="forced")}) GROUP BY 1""",
}
