"""Extraction tiers, confidence, routing, integrity and the extracted event."""

from __future__ import annotations

from pyspark.sql import functions as F

from paperloom.functions.columns import trace_uuid
from paperloom.operators import extract as x
from paperloom.operators import intake, routing
from paperloom.plans import derived as d
from paperloom.plans.catalog import query
from paperloom.plans.derived_sql import sql, strip

_LINES = f"list_filter(list_transform(string_split(body_text, chr(10)), lambda t: {strip('t')}), lambda t: t <> '')"
_TIER1 = rf"""
    SELECT msg_seq, nullif(rtrim(regexp_extract(body_text, '\b(10\.\d{{4,9}}/[-._;()/:A-Z0-9a-z]+)\b', 1), '.'), '') AS doi,
      (SELECT y FROM (SELECT y, count(*) AS n, min(pos) AS first_pos FROM (SELECT unnest(ys) AS y, generate_subscripts(ys, 1) AS pos) GROUP BY y) ORDER BY n DESC, first_pos LIMIT 1) AS year,
      list_filter(lines, lambda t: length(t) > 10 AND NOT starts_with(t, 'http'))[1] AS title
    FROM (SELECT msg_seq, body_text, regexp_extract_all(body_text, '\b(19[5-9]\d|20[0-2]\d)\b', 1) AS ys, {_LINES} AS lines FROM messages)"""


@query("doi_year_title", sql("SELECT msg_seq, doi, CAST(year AS INTEGER) AS year, title FROM tier1", "messages", tier1=_TIER1))
def doi_year_title(spark, sf):
    rows = x.pattern_tier(d.messages(spark, sf), "body_text")
    return rows.select("msg_seq", "doi", F.col("p_year").alias("year"), F.col("p_title").alias("title"))


_HEADER = rf"""
    SELECT msg_seq, list_filter({_LINES},
      lambda t: length(t) BETWEEN 20 AND 200 AND NOT starts_with(t, 'http') AND NOT regexp_matches(t, '^\d') AND len(regexp_extract_all(t, '\p{{Lu}}')) >= 2)[1] AS header_title
    FROM messages"""


@query("header_title", sql("SELECT * FROM header", "messages", header=_HEADER))
def header_title(spark, sf):
    return d.messages(spark, sf).select("msg_seq", x.header_title(F.col("body_text")).alias("header_title"))


_ENTITIES = """
    SELECT msg_seq, CASE WHEN msg_seq % 4 = 0 THEN [] ELSE [{'label': 'PERSON', 'text': concat('Author ', msg_seq % 17)}, {'label': 'PERSON', 'text': 'Mono'},
        {'label': 'PERSON', 'text': concat(' Author ', msg_seq % 17)}, {'label': 'PERSON', 'text': concat('Coauthor ', msg_seq % 5)}] END
      || [{'label': 'ORG', 'text': concat('Institute ', msg_seq % 7)},
          {'label': 'ORG', 'text': concat(CASE msg_seq % 3 WHEN 0 THEN 'Journal of Group ' WHEN 1 THEN 'Department ' ELSE 'IEEE Transactions ' END, msg_seq % 6)},
          {'label': 'DATE', 'text': 'last spring'}, {'label': 'DATE', 'text': concat('in ', 1990 + msg_seq % 60)}] AS entities
    FROM messages"""
_PICKED = r"""
    SELECT msg_seq, list_transform(list_filter(entities, lambda e: e.label = 'PERSON'), lambda e: trim(e.text)) AS people,
      list_filter(list_transform(list_filter(entities, lambda e: e.label = 'ORG'), lambda e: e.text),
        lambda o: regexp_matches(lower(o), 'conference|journal|proceedings|workshop|symposium|transactions|letters|review|arxiv'))[1] AS venue,
      CAST(nullif(list_filter(list_transform(list_filter(entities, lambda e: e.label = 'DATE'), lambda e: regexp_extract(e.text, '\b(19[5-9]\d|20[0-2]\d)\b', 1)), lambda y: y <> '')[1], '') AS INTEGER) AS year
    FROM entity_rows"""
_AUTHORS = """
    SELECT msg_seq, list(p ORDER BY pos) AS authors FROM (SELECT msg_seq, p, min(pos) AS pos FROM (SELECT msg_seq, unnest(people) AS p, generate_subscripts(people, 1) AS pos FROM picked)
      WHERE length(p) BETWEEN 3 AND 60 AND contains(p, ' ') GROUP BY msg_seq, p) GROUP BY msg_seq"""
_ENTITY_CTES = {"entity_rows": _ENTITIES, "picked": _PICKED, "author_lists": _AUTHORS}


@query("entity_pick", sql("""
    SELECT msg_seq, coalesce(array_to_string(authors, '|'), '') AS authors, venue, year FROM picked LEFT JOIN author_lists USING (msg_seq)""", "messages", **_ENTITY_CTES))
def entity_pick(spark, sf):
    rows = d.messages(spark, sf).withColumn("entities", d.entities())
    e = F.col("entities")
    return rows.select("msg_seq", F.array_join(x.pick_authors(e), "|").alias("authors"), x.pick_venue(e).alias("venue"), x.pick_year(e).alias("year"))


_REGISTRY = """
    SELECT lower(concat('10.', 1000 + i % 9000, CASE WHEN i % 2 = 0 THEN '/P.' ELSE '/other.' END, i)) AS doi_key, CASE WHEN i % 10 <> 0 THEN concat('Registry title ', i) END AS title,
      CASE WHEN i % 14 = 0 THEN CAST([] AS VARCHAR[]) ELSE [concat('Ada Family', i % 23), 'Solo'] END AS authors,
      CAST(CASE WHEN i % 3 = 0 THEN 2001 + i % 20 WHEN i % 3 <= 1 THEN 2002 + i % 20 WHEN i % 5 <> 4 THEN 2003 + i % 20 END AS INTEGER) AS year,
      CASE WHEN i % 4 <> 0 THEN concat('Container ', i % 11) WHEN i % 8 <> 0 THEN 'Some Press' END AS venue, CASE WHEN i % 3 = 1 THEN concat('About ', i) END AS abstract
    FROM (SELECT doc_id AS i FROM documents)"""


@query("registry_metadata", sql("SELECT doi_key, title, array_to_string(authors, '|') AS authors, year, venue, abstract FROM registry", registry=_REGISTRY))
def registry_metadata(spark, sf):
    rows = x.registry_metadata(d.registry_works(spark, sf))
    return rows.select("doi_key", F.col("r_title").alias("title"), F.array_join("r_authors", "|").alias("authors"), F.col("r_year").alias("year"), F.col("r_venue").alias("venue"), F.col("r_abstract").alias("abstract"))


_MERGED = """
    SELECT m.msg_seq, t.doi, r.doi_key IS NOT NULL AS found,
      CASE WHEN r.doi_key IS NOT NULL THEN coalesce(r.title, t.title) ELSE coalesce(t.title, h.header_title) END AS title,
      CASE WHEN r.doi_key IS NOT NULL THEN r.authors ELSE coalesce(a.authors, CAST([] AS VARCHAR[])) END AS authors,
      CASE WHEN r.doi_key IS NOT NULL THEN coalesce(r.year, CAST(t.year AS INTEGER)) ELSE coalesce(CAST(t.year AS INTEGER), p.year) END AS year,
      CASE WHEN r.doi_key IS NOT NULL THEN r.venue ELSE p.venue END AS venue,
      CASE WHEN r.doi_key IS NOT NULL THEN 'CROSSREF' ELSE 'NLP' END AS tier, t.title AS p_title, h.header_title AS e_title, t.year AS p_year
    FROM messages m JOIN tier1 t USING (msg_seq) JOIN header h USING (msg_seq) JOIN picked p USING (msg_seq) LEFT JOIN author_lists a USING (msg_seq)
    LEFT JOIN registry r ON r.doi_key = lower(t.doi)"""
_SCORED = """
    SELECT *, CASE WHEN len(authors) = 0 THEN 0.0 WHEN found THEN 1.0 ELSE 0.75 END AS authors_score,
      CASE WHEN title IS NULL THEN 0.0 WHEN found THEN 1.0 WHEN p_title IS NOT NULL THEN 0.6 ELSE 0.75 END AS title_score,
      CASE WHEN found THEN CASE WHEN venue IS NOT NULL OR year IS NOT NULL THEN 1.0 ELSE 0.0 END
        ELSE greatest(CASE WHEN p_year IS NOT NULL THEN 0.6 ELSE 0.0 END, CASE WHEN venue IS NOT NULL THEN 0.75 ELSE 0.0 END) END AS venue_year_score
    FROM merged"""
_CONFIDENCE = "round(CAST(authors_score AS DOUBLE) * 0.4 + CAST(title_score AS DOUBLE) * 0.3 + CAST(venue_year_score AS DOUBLE) * 0.3, 4)"
_MERGE_CTES = {"tier1": _TIER1, "header": _HEADER, **_ENTITY_CTES, "registry": _REGISTRY, "merged": _MERGED, "scored": _SCORED}


def tiers(spark, sf):
    rows = d.messages(spark, sf).select("msg_seq", F.col("body_text").alias("raw_text"))
    return rows.withColumn("entities", d.entities())


def cascade_rows(df):
    return df.select(
        "msg_seq", "doi", "title", F.array_join("authors", "|").alias("authors"), "year", "venue", "extraction_tier", "authors_score", "title_score",
        "venue_year_score", "confidence",
    )


@query("extraction_cascade", sql(f"""
    SELECT msg_seq, doi, title, array_to_string(authors, '|') AS authors, year, venue, tier AS extraction_tier, CAST(authors_score AS DOUBLE) AS authors_score,
      CAST(title_score AS DOUBLE) AS title_score, CAST(venue_year_score AS DOUBLE) AS venue_year_score, {_CONFIDENCE} AS confidence FROM scored""", "messages", **_MERGE_CTES))
def extraction_cascade(spark, sf):
    registry = x.registry_metadata(d.registry_works(spark, sf))
    return cascade_rows(x.extract(tiers(spark, sf), registry, key="msg_seq"))


_ANSWERS = """
    SELECT CASE WHEN doc_id % 6 = 0 THEN -1 - doc_id ELSE doc_id END AS msg_seq, concat('Model title ', doc_id) AS m_title, CASE WHEN doc_id % 5 <> 0 THEN ['Model One', 'Model Two'] ELSE CAST([] AS VARCHAR[]) END AS m_authors,
      CASE WHEN doc_id % 7 <> 0 THEN CAST(2005 + doc_id % 15 AS INTEGER) END AS m_year, CASE WHEN doc_id % 4 <> 1 THEN concat('Model venue ', doc_id % 9) END AS m_venue,
      CASE WHEN doc_id % 2 = 1 THEN concat('10.5555/m.', doc_id) END AS m_doi FROM documents"""
_GATED = f"""
    SELECT s.*, a.msg_seq IS NOT NULL AND s.confidence < 0.7 AS used, m_title, m_authors, m_year, m_venue, m_doi,
      least(0.7 + (CASE WHEN m_title IS NOT NULL THEN 1 ELSE 0 END + CASE WHEN len(m_authors) > 0 THEN 1 ELSE 0 END + CASE WHEN m_year IS NOT NULL THEN 1 ELSE 0 END
        + CASE WHEN m_venue IS NOT NULL THEN 1 ELSE 0 END) / 4.0 * 0.2, 0.9) AS m_score
    FROM (SELECT *, {_CONFIDENCE} AS confidence FROM scored) s LEFT JOIN answers a USING (msg_seq)"""
_FILLED = """
    SELECT msg_seq, CASE WHEN used THEN coalesce(doi, m_doi) ELSE doi END AS doi, CASE WHEN used AND title IS NULL THEN m_title ELSE title END AS title,
      CASE WHEN used AND len(authors) = 0 THEN m_authors ELSE authors END AS authors, CASE WHEN used THEN coalesce(year, m_year) ELSE year END AS year,
      CASE WHEN used AND venue IS NULL THEN m_venue ELSE venue END AS venue, CASE WHEN used THEN 'LLM' ELSE tier END AS extraction_tier, used,
      CASE WHEN used AND len(authors) = 0 AND len(m_authors) > 0 THEN m_score ELSE authors_score END AS authors_score,
      CASE WHEN used AND title IS NULL AND m_title IS NOT NULL THEN m_score ELSE title_score END AS title_score,
      CASE WHEN used AND venue IS NULL AND m_venue IS NOT NULL THEN least(greatest(venue_year_score, m_score), 0.9) ELSE venue_year_score END AS venue_year_score
    FROM gated"""


@query("low_confidence_gate", sql(f"""
    SELECT msg_seq, doi, title, array_to_string(authors, '|') AS authors, year, venue, extraction_tier, round(CAST(authors_score AS DOUBLE), 6) AS authors_score,
      round(CAST(title_score AS DOUBLE), 6) AS title_score, round(CAST(venue_year_score AS DOUBLE), 6) AS venue_year_score,
      CASE WHEN used AND {_CONFIDENCE} > 0.9 THEN round(least(CAST(authors_score AS DOUBLE), 0.9) * 0.4 + least(CAST(title_score AS DOUBLE), 0.9) * 0.3 + least(CAST(venue_year_score AS DOUBLE), 0.9) * 0.3, 4)
        ELSE {_CONFIDENCE} END AS confidence FROM filled""", "messages", **_MERGE_CTES, answers=_ANSWERS, gated=_GATED, filled=_FILLED))
def low_confidence_gate(spark, sf):
    registry = x.registry_metadata(d.registry_works(spark, sf))
    answers = d.model_answers(spark, sf, F.col("doc_id"))
    rows = cascade_rows(x.extract(tiers(spark, sf), registry, answers, key="msg_seq"))
    for c in ("authors_score", "title_score", "venue_year_score"):
        rows = rows.withColumn(c, F.round(c, 6))
    return rows


@query("confidence_check", sql("""
    SELECT paper_id, abs(CAST(overall_confidence AS DOUBLE) - (a * 0.4 + t * 0.3 + v * 0.3)) <= 0.001 AS consistent FROM (
      SELECT paper_id, overall_confidence, (paper_id % 5) / 4.0 AS a, (paper_id % 3) / 2.0 AS t, (paper_id % 2) / 1.0 AS v FROM papers)""", "papers"))
def confidence_check(spark, sf):
    i = F.col("paper_id")
    a, t, v = (i % 5) / 4, (i % 3) / 2, (i % 2) / 1
    return d.papers(spark, sf).select("paper_id", x.confidence_consistent(F.col("overall_confidence").cast("double"), a, t, v).alias("consistent"))


# Routing over papers: status of the owner, issues from flags, confidence from the table.
_ROUTE_INPUT = """
    SELECT p.paper_id, CAST(p.overall_confidence AS DOUBLE) AS confidence, coalesce(CAST(u.faculty_id AS VARCHAR), '00000000-0000-0000-0000-000000000000') AS faculty_id,
      CASE WHEN u.user_id IS NULL THEN 'not_found' WHEN u.is_active THEN 'active' ELSE 'inactive' END AS faculty_status,
      p.paper_id % 3 = 0 AS no_file, p.paper_id % 29 = 0 AS unredacted, p.paper_id % 31 = 0 AS unverified, p.paper_id % 50 = 0 AS infected
    FROM papers p LEFT JOIN users u ON u.email = p.faculty_email AND p.paper_id % 15 <> 0"""
_ISSUES = """
    SELECT *, concat_ws('; ', CASE WHEN unredacted THEN 'PII_NOT_REDACTED' END, CASE WHEN unverified THEN 'DOMAIN_NOT_VERIFIED' END,
        CASE WHEN infected THEN 'MALWARE_FLAG' END, CASE WHEN faculty_status <> 'active' THEN 'FACULTY_INVALID' END) AS blocking,
      concat_ws(';', CASE WHEN no_file THEN 'NO_ATTACHMENTS' END, CASE WHEN unredacted THEN 'PII_NOT_REDACTED' END, CASE WHEN unverified THEN 'DOMAIN_NOT_VERIFIED' END,
        CASE WHEN infected THEN 'MALWARE_FLAG' END, CASE WHEN faculty_status <> 'active' THEN 'FACULTY_INVALID' END) AS issue_codes
    FROM route_input"""


def route_input(spark, sf):
    i = F.col("paper_id")
    papers = d.papers(spark, sf).withColumn("lookup_key", F.when(i % 15 != 0, F.col("faculty_email")).otherwise(F.concat(F.lit("nobody"), i.cast("string"))))
    file = F.struct(F.lit("a.pdf").alias("filename"))
    flags = papers.select(
        "paper_id", "lookup_key", F.col("overall_confidence").cast("double").alias("confidence"),
        F.struct(F.when(i % 3 == 0, F.array().cast("array<struct<filename:string>>")).otherwise(F.array(file)).alias("attachments")).alias("content"),
        F.struct((i % 29 != 0).alias("pii_redacted"), (i % 31 != 0).alias("source_domain_verified"), F.when(i % 50 == 0, "INFECTED").otherwise("CLEAN").alias("clamav_result")).alias("security"),
    )
    return routing.enrich(flags, d.users(spark, sf)).withColumn("issues", routing.issue_rules())


@query("issue_rules", sql("SELECT paper_id, issue_codes FROM with_issues", "papers", "users", route_input=_ROUTE_INPUT, with_issues=_ISSUES))
def issue_rules(spark, sf):
    return route_input(spark, sf).select("paper_id", F.array_join(F.transform("issues", lambda i: i.code), ";").alias("issue_codes"))


_FACULTY_TEXT = "concat('Faculty ''', faculty_id, ''' status=''', faculty_status, '''')"


@query("routing", sql(f"""
    SELECT paper_id, CASE WHEN blocking <> '' THEN 'BLOCK' WHEN confidence < 0.75 OR no_file THEN 'REVIEW_REQUIRED' ELSE 'AUTO_SAVE' END AS final_action,
      CASE WHEN blocking <> '' THEN 'papers.failed' WHEN confidence < 0.75 OR no_file THEN 'papers.review' ELSE 'papers.validated' END AS target_topic,
      CASE WHEN blocking <> '' THEN concat_ws('; ',
          CASE WHEN faculty_status <> 'active' THEN concat('faculty_status=''', faculty_status, ''' for faculty_id=''', faculty_id, '''') END,
          CASE WHEN unredacted THEN 'validation_issue BLOCK: [PII_NOT_REDACTED] Personal data is not redacted' END,
          CASE WHEN unverified THEN 'validation_issue BLOCK: [DOMAIN_NOT_VERIFIED] Source domain is not verified' END,
          CASE WHEN infected THEN 'validation_issue BLOCK: [MALWARE_FLAG] Scan result: INFECTED' END,
          CASE WHEN faculty_status <> 'active' THEN concat('validation_issue BLOCK: [FACULTY_INVALID] ', {_FACULTY_TEXT}) END)
        WHEN confidence < 0.75 OR no_file THEN concat_ws('; ', CASE WHEN confidence < 0.75 THEN printf('overall_confidence=%.4f < threshold=%.4f', confidence, 0.75::DOUBLE) END,
          CASE WHEN no_file THEN 'validation_issue REVIEW_REQUIRED: [NO_ATTACHMENTS] Email has no file attachments to process' END)
        ELSE printf('all checks passed | confidence=%.4f >= threshold=%.4f | faculty_status=active', confidence, 0.75::DOUBLE) END AS reasons
    FROM with_issues""", "papers", "users", route_input=_ROUTE_INPUT, with_issues=_ISSUES))
def routing_decisions(spark, sf):
    return routing.route(route_input(spark, sf)).select("paper_id", "final_action", "target_topic", F.array_join("reasons", "; ").alias("reasons"))


@query("integrity_check", sql("""
    SELECT msg_seq, text_ok AND file_ok AS passed, nullif(concat_ws(' ', CASE WHEN has_file AND stored IS NULL THEN 'file_missing' END, CASE WHEN NOT text_ok THEN 'text_hash_mismatch' END,
      CASE WHEN NOT file_ok AND stored IS NOT NULL AND text_ok THEN 'file_checksum_mismatch' END), '') AS failure_reason FROM (
      SELECT msg_seq, filename IS NOT NULL AS has_file, msg_seq % 10 <> 3 AS text_ok, stored, filename IS NULL OR coalesce(stored = checksum, false) AS file_ok FROM (
        SELECT msg_seq, filename, checksum, CASE WHEN msg_seq % 7 = 0 THEN NULL WHEN msg_seq % 11 = 0 THEN sha256('other') ELSE checksum END AS stored FROM messages))""", "messages"))
def integrity_check(spark, sf):
    """Attachment manifest joined with stored file hashes; some files are missing, some were changed."""
    i = F.col("msg_seq")
    first = F.get("attachments", F.lit(0))
    rows = d.messages(spark, sf).select(
        i, "body_text", F.when(i % 10 == 3, F.sha2(F.lit("x"), 256)).otherwise(F.sha2("body_text", 256)).alias("text_hash"),
        (F.size("attachments") > 0).alias("has_file"), first["checksum_sha256"].alias("recorded"), F.concat(F.lit("key/"), i.cast("string")).alias("s3_key"),
    )
    folder = F.when(F.col("doc_id") % 7 == 0, "elsewhere/").otherwise("key/")
    files = d.table(spark, sf, "documents").select(
        F.concat(folder, F.col("doc_id").cast("string")).alias("s3_key"),
        F.sha2(F.when(F.col("doc_id") % 11 == 0, F.lit("other")).otherwise(F.concat(F.lit("file"), F.col("doc_id").cast("string"))), 256).alias("file_hash"),
    )
    checked = rows.join(files, "s3_key", "left").withColumn("r", x.integrity(F.col("body_text"), F.col("text_hash"), F.col("has_file"), F.col("file_hash"), F.col("recorded")))
    return checked.select("msg_seq", "r.passed", "r.failure_reason")


@query("trace_ids", """
    SELECT event_id, CASE WHEN event_id % 4 <> 0 THEN regexp_replace(substr(sha256(CAST(event_id AS VARCHAR)), 1, 32), '^(.{8})(.{4})(.{4})(.{4})(.{12})$', '\\1-\\2-\\3-\\4-\\5') END AS trace_id FROM events""".replace("\\\\", "\\"))
def trace_ids(spark, sf):
    digest = F.sha2(F.col("event_id").cast("string"), 256)
    width = F.when(F.col("event_id") % 4 == 0, 30).otherwise(32)
    header = F.concat(F.lit("00-"), F.substring(digest, F.lit(1), width), F.lit("-0123456789abcdef-01"))
    return d.table(spark, sf, "events").select("event_id", trace_uuid(header).alias("trace_id"))


def ingested_messages(spark, sf):
    """Ingested-event messages (key, value) of everything that passed screening."""
    screened = intake.screen(d.messages(spark, sf)).filter(F.col("refused").isNull())
    events = intake.ingested_events(screened, d.as_of())
    return events.select(F.col("email.idempotency_key").alias("key"), F.to_json(F.struct(*events.columns)).alias("value"))
