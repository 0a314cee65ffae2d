"""Counts, listings, suggestions, paging, compliance gate and reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from paperloom.operators import facets, reports, stored_pages, suggest, suggest_index, text_search
from paperloom.plans import derived as d
from paperloom.plans.catalog import query
from paperloom.plans.derived_sql import SETTLED, shown, sql
from paperloom.session import cut_lineage, scratch_path
from paperloom.settings import DEFAULTS
from paperloom.sources import sinks

_BUCKET = "CASE WHEN overall_confidence < 0.5 THEN '0.0-0.5' WHEN overall_confidence < 0.7 THEN '0.5-0.7' WHEN overall_confidence < 0.9 THEN '0.7-0.9' ELSE '0.9-1.0' END"
_FACETS = f"""
    SELECT 'year' AS facet, CAST(year AS VARCHAR) AS value, count(*) AS n FROM papers WHERE status = 'PUBLISHED' GROUP BY year
    UNION ALL SELECT 'paper_type', paper_type, count(*) FROM papers WHERE status = 'PUBLISHED' GROUP BY paper_type
    UNION ALL SELECT 'confidence', {_BUCKET}, count(*) FROM papers WHERE status = 'PUBLISHED' GROUP BY 2"""


@query("facet_counts", sql(_FACETS, "papers"))
def facet_counts(spark, sf):
    return facets.facet_counts(d.papers(spark, sf))


@query("status_counts", sql("SELECT count(*) AS n FROM papers WHERE status = 'PUBLISHED'", "papers"))
def status_counts(spark, sf):
    return facets.status_total(facets.facet_counts(d.papers(spark, sf)))


@query("papers_count", sql("SELECT department_code, status, count(*) AS n FROM papers GROUP BY ALL", "papers"))
def papers_count(spark, sf):
    return facets.count_papers(d.papers(spark, sf))


@query("papers_list", sql(f"""
    SELECT paper_id, title, department_code, status, year, {shown('created_at')} AS created_at FROM papers
    WHERE department_code = 'ECE' AND status = 'PUBLISHED' ORDER BY papers.created_at DESC, paper_id LIMIT 50 OFFSET 20""", "papers"))
def papers_list(spark, sf):
    rows = facets.list_papers(d.papers(spark, sf), limit=50, offset=20, department_code="ECE", status="PUBLISHED")
    return rows.select("paper_id", "title", "department_code", "status", "year", d.shown_time(F.col("created_at")).alias("created_at"))


@query("export_rows", sql(f"""
    SELECT paper_id, title, coalesce(venue, '') AS venue, year, coalesce(doi, '') AS doi, paper_type, faculty_email, department_code,
      status, CAST(overall_confidence AS DOUBLE) AS overall_confidence, {shown('created_at')} AS created_at
    FROM papers WHERE status = 'PUBLISHED' ORDER BY papers.created_at DESC, paper_id LIMIT 1000""", "papers"))
def export_rows(spark, sf):
    rows = facets.export_rows(d.papers(spark, sf))
    return rows.withColumn("overall_confidence", F.col("overall_confidence").cast("double")).withColumn(
        "created_at", d.shown_time(F.col("created_at"))
    )


_KEYSET = sql(f"""
    , edge AS (SELECT created_at, paper_id FROM papers WHERE status = 'PUBLISHED' ORDER BY created_at DESC, paper_id LIMIT 1 OFFSET 19)
    SELECT p.paper_id, {shown('p.created_at')} AS created_at,
      base64(encode(concat('{{"paper_id":"', p.paper_id, '","created_at":"', strftime(p.created_at, '%Y-%m-%dT%H:%M:%S.%f'), '"}}'))) AS cursor
    FROM papers p, edge WHERE status = 'PUBLISHED' AND (p.created_at < edge.created_at OR (p.created_at = edge.created_at AND p.paper_id > edge.paper_id))
    ORDER BY p.created_at DESC, p.paper_id LIMIT 20""".strip(), "papers")


@query("keyset_page", _KEYSET)
def keyset_page(spark, sf):
    papers = d.papers(spark, sf)
    first = facets.keyset_page(papers, None, 20, status="PUBLISHED")
    cursor = first.agg(F.min_by("cursor", F.struct("created_at", -F.col("paper_id")))).first()[0]
    page = facets.keyset_page(papers, cursor, 20, status="PUBLISHED")
    return page.select("paper_id", d.shown_time(F.col("created_at")).alias("created_at"), "cursor")


@query("keyset_page_stored", _KEYSET)
def keyset_page_stored(spark, sf):
    """The same second page from files in page order, of which it opens those that its cursor can reach."""
    path = scratch_path(spark, "paper-pages")
    stored_pages.write_pages(d.papers(spark, sf), path)
    first, _ = stored_pages.read_page(spark, path, None, 20, status="PUBLISHED")
    cursor = first.agg(F.min_by("cursor", F.struct("created_at", -F.col("paper_id")))).first()[0]
    page, _ = stored_pages.read_page(spark, path, cursor, 20, status="PUBLISHED")
    return page.select("paper_id", d.shown_time(F.col("created_at")).alias("created_at"), "cursor")


@query("suggest_title", sql("""
    SELECT title AS text, count(*) OVER (PARTITION BY title) AS frequency, paper_id FROM papers
    WHERE status = 'PUBLISHED' AND starts_with(lower(title), 'th') ORDER BY title, paper_id LIMIT 25""", "papers"))
def suggest_title(spark, sf):
    return suggest.suggest_titles(d.papers(spark, sf), "Th", 25)


@query("suggest_venue", sql("""
    SELECT venue AS text, count(*) AS frequency FROM papers WHERE status = 'PUBLISHED' AND starts_with(lower(venue), 'j')
    GROUP BY venue ORDER BY venue LIMIT 10""", "papers"))
def suggest_venue(spark, sf):
    return suggest.suggest_venues(d.papers(spark, sf), "j")


@query("suggest_author", sql("""
    SELECT name AS text, count(*) AS frequency FROM papers JOIN authors_long USING (paper_id)
    WHERE status = 'PUBLISHED' AND starts_with(lower(name), 'customer#00000001') GROUP BY name ORDER BY name LIMIT 10""", "papers", "authors_long"))
def suggest_author(spark, sf):
    return suggest.suggest_authors(d.papers_with_authors(spark, sf), "customer#00000001")


@query("suggest_batch", sql("""
    SELECT query_id, text, frequency, position FROM (
      SELECT q.query_id, t.text, t.frequency, row_number() OVER (PARTITION BY q.query_id ORDER BY t.text) AS position
      FROM (SELECT title AS text, count(*) AS frequency FROM papers WHERE status = 'PUBLISHED' GROUP BY title) t
      JOIN (SELECT n_nationkey AS query_id, lower(substr(n_name, 1, CAST(1 + n_nationkey % 4 AS BIGINT))) AS prefix FROM nation) q
        ON starts_with(lower(t.text), q.prefix)) WHERE position <= 5""", "papers"))
def suggest_batch(spark, sf):
    nations = d.table(spark, sf, "nation")
    prefixes = nations.select(F.col("n_nationkey").alias("query_id"), F.expr("substring(n_name, 1, 1 + n_nationkey % 4)").alias("prefix"))
    return suggest.suggest_batch(d.papers(spark, sf), prefixes, 5)


# A request a nation and kind: the start of its name for titles, one to ten characters of an entry for venues and authors.
_STARTS = """
    SELECT n_nationkey * 3 AS query_id, 'title' AS kind, substr(n_name, 1, CAST(1 + n_nationkey % 4 AS BIGINT)) AS prefix FROM nation
    UNION ALL SELECT n_nationkey * 3 + 1, 'venue', substr('CONFERENCE ON SRC', 1, CAST(1 + n_nationkey % 17 AS BIGINT)) FROM nation
    UNION ALL SELECT n_nationkey * 3 + 2, 'author', substr('customer#000000010', 1, CAST(1 + n_nationkey % 18 AS BIGINT)) FROM nation"""


@query("suggest_indexed", sql(f"""
    SELECT query_id, text, frequency, position FROM (
      SELECT q.query_id, t.text, t.frequency, row_number() OVER (PARTITION BY q.query_id ORDER BY t.text) AS position
      FROM (SELECT kind, text, count(*) AS frequency FROM (
        SELECT 'title' AS kind, title AS text FROM papers WHERE status = 'PUBLISHED' UNION ALL SELECT 'venue', venue FROM papers WHERE status = 'PUBLISHED'
        UNION ALL SELECT 'author', name FROM papers JOIN authors_long USING (paper_id) WHERE status = 'PUBLISHED') WHERE length(text) > 0 GROUP BY ALL) t
      JOIN ({_STARTS}) q ON q.kind = t.kind AND starts_with(lower(t.text), lower(q.prefix))) WHERE position <= 10""", "papers", "authors_long"))
def suggest_indexed(spark, sf):
    """Titles, venues and authors by a stored prefix table and a paged dictionary, written once and then read."""
    path = scratch_path(spark, "suggest-index")
    suggest_index.write_index(suggest_index.build_index(d.papers_with_authors(spark, sf)), path)
    key, name = F.col("n_nationkey"), F.col("n_name")

    def start(text, most):
        return F.substring(text, F.lit(1), (1 + key % most).cast("int"))

    asked = d.table(spark, sf, "nation").select(F.inline(F.array(
        F.struct((key * 3).alias("query_id"), F.lit("title").alias("kind"), start(name, 4).alias("prefix")),
        F.struct((key * 3 + 1).alias("query_id"), F.lit("venue").alias("kind"), start(F.lit("CONFERENCE ON SRC"), 17).alias("prefix")),
        F.struct((key * 3 + 2).alias("query_id"), F.lit("author").alias("kind"), start(F.lit("customer#000000010"), 18).alias("prefix")),
    )))
    return suggest_index.suggest(suggest_index.read_index(spark, path), asked)


@query("sanitize_queries", r"""
    SELECT conv_id, turn, substr(regexp_replace(regexp_replace(regexp_replace(text, '[;\x00-\x1f\x7f]', ' ', 'g'), '\s+', ' ', 'g'), '^\s+|\s+$', '', 'g'), 1, 200) AS query
    FROM conversations""")
def sanitize_queries(spark, sf):
    return d.table(spark, sf, "conversations").select("conv_id", "turn", text_search.sanitise(F.col("text"), DEFAULTS.query_max_chars).alias("query"))


_GATE = """
    SELECT department_code, y.year_start, sum(coalesce(e.n, 0)) AS error_count,
      sum(CASE WHEN status IN ('PENDING_REVIEW', 'DRAFT') THEN 1 ELSE 0 END) AS pending_count
    FROM papers p JOIN (SELECT DISTINCT year - 1 AS year_start FROM papers UNION SELECT DISTINCT year FROM papers) y
      ON p.year BETWEEN y.year_start AND y.year_start + 1
    LEFT JOIN (SELECT paper_id, count(*) AS n FROM issues WHERE severity = 'error' AND resolved_at IS NULL GROUP BY paper_id) e USING (paper_id)
    GROUP BY ALL"""
_VERDICT = """
    SELECT department_code, year_start, concat(year_start, '-', year_start + 1) AS academic_year, CAST(error_count AS BIGINT) AS error_count,
      CAST(pending_count AS BIGINT) AS pending_count, error_count = 0 AND pending_count = 0 AS passed,
      CASE WHEN error_count > 0 OR pending_count > 0 THEN concat('Cannot generate report: ',
        concat_ws(' and ', CASE WHEN error_count > 0 THEN concat(CAST(error_count AS BIGINT), ' unresolved validation error(s)') END,
          CASE WHEN pending_count > 0 THEN concat(CAST(pending_count AS BIGINT), ' paper(s) still PENDING_REVIEW/DRAFT') END),
        ' in scope for ', department_code, ' ', year_start, '-', year_start + 1, '.') END AS error_message
    FROM gate_counts"""


@query("compliance_gate", sql("SELECT * FROM verdict", "papers", "issues", gate_counts=_GATE, verdict=_VERDICT))
def compliance_gate(spark, sf):
    return reports.compliance_gate(d.papers(spark, sf), d.issues(spark, sf))


_PER_YEAR = """
    SELECT {keys}, y.year_start, concat(y.year_start, '-', y.year_start + 1) AS academic_year, count(*) AS total_papers,
      count(*) FILTER (paper_type = 'journal') AS journal_count, count(*) FILTER (paper_type = 'conference') AS conference_count,
      round(CAST(sum(overall_confidence) AS DOUBLE) / count(*), 3) AS avg_confidence
    FROM papers p JOIN (SELECT DISTINCT year - 1 AS year_start FROM papers UNION SELECT DISTINCT year FROM papers) y
      ON p.year BETWEEN y.year_start AND y.year_start + 1 WHERE status = 'PUBLISHED' GROUP BY ALL"""


@query("report_summary", sql(_PER_YEAR.format(keys="department_code"), "papers"))
def report_summary(spark, sf):
    return reports.summaries(d.papers(spark, sf)).drop("checksum_sha256")


@query("faculty_profile", sql(_PER_YEAR.format(keys="department_code, faculty_id, faculty_email"), "papers"))
def faculty_profile(spark, sf):
    return reports.summaries(d.papers(spark, sf), ["department_code", "faculty_id", "faculty_email"]).drop("checksum_sha256")


_AUTHOR_NAMES = "SELECT paper_id, string_agg(name, ', ' ORDER BY ord) AS authors FROM authors_long GROUP BY paper_id"


@query("department_report_rows", sql("""
    SELECT paper_id, title AS "Title", authors AS "Authors",
      coalesce(venue, '—') AS "Venue", year AS "Year", coalesce(doi, '—') AS "DOI",
      concat(upper(substr(paper_type, 1, 1)), lower(substr(paper_type, 2))) AS "Type", printf('%.2f', CAST(overall_confidence AS DOUBLE)) AS "Confidence",
      split_part(faculty_email, '@', 1) AS "Faculty Email"
    FROM papers JOIN names USING (paper_id) WHERE department_code = 'CSE' AND year BETWEEN 2023 AND 2024 AND status = 'PUBLISHED'
    """, "papers", "authors_long", names=_AUTHOR_NAMES))
def department_report_rows(spark, sf):
    rows = reports.published_in(d.papers_with_authors(spark, sf), "CSE", 2023, 2024)
    return rows.select("paper_id", *reports.report_cells("pdf"))


@query("faculty_report_rows", sql("""
    SELECT paper_id, title, year, paper_type FROM papers
    WHERE department_code = 'ECE' AND faculty_id = 12 AND year BETWEEN 2005 AND 2024 AND status = 'PUBLISHED'""", "papers"))
def faculty_report_rows(spark, sf):
    return reports.published_in(d.papers(spark, sf), "ECE", 2005, 2024, 12).select("paper_id", "title", "year", "paper_type")


@query("confidence_bands", sql("""
    SELECT paper_id, CASE WHEN overall_confidence >= 0.85 THEN 'high' WHEN overall_confidence >= 0.7 THEN 'mid' ELSE 'low' END AS band FROM papers""", "papers"))
def confidence_bands(spark, sf):
    return d.papers(spark, sf).select("paper_id", facets.confidence_band(F.col("overall_confidence")).alias("band"))


_DIGESTS = """
    SELECT *, sha256(CAST(to_json({'paper_id': CAST(paper_id AS VARCHAR), 'title': title, 'venue': venue, 'year': year, 'doi': doi,
      'paper_type': paper_type, 'overall_confidence': CAST(overall_confidence AS VARCHAR), 'faculty_email': faculty_email, 'authors': names.authors}) AS VARCHAR)) AS digest
    FROM papers JOIN names USING (paper_id)"""
_LEAVES = """
    SELECT department_code, year, substr(digest, 1, 6) AS node, sha256(string_agg(line, chr(10) ORDER BY line)) AS h FROM (
      SELECT department_code, year, digest, concat(digest, ' ', count(*)) AS line FROM digests WHERE status = 'PUBLISHED' GROUP BY department_code, year, digest) GROUP BY ALL"""
_BRANCHES = "SELECT department_code, year, substr(node, 1, 3) AS node, sha256(string_agg(concat(node, ' ', h), chr(10) ORDER BY node)) AS h FROM leaves GROUP BY department_code, year, substr(node, 1, 3)"
_ROOTS = "SELECT department_code, year, sha256(string_agg(concat(node, ' ', h), chr(10) ORDER BY node)) AS root FROM branches GROUP BY department_code, year"
_HASHES = """
    SELECT department_code, year_start, sha256(string_agg(concat(year, ' ', root), chr(10) ORDER BY year)) AS content FROM (
      SELECT *, unnest([year - 1, year]) AS year_start FROM roots) GROUP BY department_code, year_start"""
_TOTALS = """
    SELECT department_code, y.year_start, count(*) AS total_papers, count(*) FILTER (paper_type = 'journal') AS journal_count,
      count(*) FILTER (paper_type = 'conference') AS conference_count
    FROM digests p JOIN (SELECT DISTINCT year - 1 AS year_start FROM papers UNION SELECT DISTINCT year FROM papers) y
      ON p.year BETWEEN y.year_start AND y.year_start + 1 WHERE status = 'PUBLISHED' GROUP BY ALL"""
_ID = "regexp_replace(substr(sha256({c}), 1, 32), '^(.{{8}})(.{{4}})(.{{4}})(.{{4}})(.{{12}})$', '\\1-\\2-\\3-\\4-\\5')"
_REPORT_ID = _ID.format(c="concat_ws(chr(31), 'NAAC_CRITERIA_III', v.department_code, v.year_start)")
_MANIFEST = f"""
    SELECT {_REPORT_ID} AS report_id, 'NAAC_CRITERIA_III' AS report_type, v.department_code, v.academic_year, CAST(NULL AS BIGINT) AS faculty_id,
      CASE WHEN passed THEN 'COMPLETED' ELSE 'FAILED' END AS status,
      CASE WHEN passed THEN concat('s3://reports/reports/', v.department_code, '/', v.academic_year, '/criteria_iii_20240131_000000.csv') END AS s3_uri,
      CASE WHEN passed THEN coalesce(content, sha256('')) END AS content_sha256,
      CASE WHEN passed THEN coalesce(total_papers, 0) END AS total_papers, CASE WHEN passed THEN coalesce(journal_count, 0) END AS journal_count,
      CASE WHEN passed THEN coalesce(conference_count, 0) END AS conference_count, error_message
    FROM verdict v LEFT JOIN totals t ON t.department_code = v.department_code AND t.year_start = v.year_start
      LEFT JOIN hashes h ON h.department_code = v.department_code AND h.year_start = v.year_start"""
_REPORT_CTES = {
    "papers": SETTLED, "names": _AUTHOR_NAMES, "gate_counts": _GATE, "verdict": _VERDICT, "digests": _DIGESTS, "leaves": _LEAVES, "branches": _BRANCHES,
    "roots": _ROOTS, "hashes": _HASHES, "totals": _TOTALS, "manifest": _MANIFEST,
}


def manifest(spark, sf):
    papers = d.settled(d.papers_with_authors(spark, sf))
    return reports.run_reports(reports.department_requests(papers), papers, d.issues(spark, sf), d.as_of())


@query("report_jobs", sql("SELECT * FROM manifest", "papers_raw", "issues", "authors_long", **_REPORT_CTES))
def report_jobs(spark, sf):
    return manifest(spark, sf)


_FACULTY_JOBS = """
    SELECT v.department_code, v.academic_year, y.faculty_id, CASE WHEN passed THEN 'COMPLETED' ELSE 'FAILED' END AS status,
      CASE WHEN passed THEN concat('s3://reports/reports/', v.department_code, '/', v.academic_year, '/faculty_profile_', y.faculty_id, '_20240131_000000.csv') END AS s3_uri,
      CASE WHEN passed THEN coalesce(t.n, 0) END AS total_papers, CASE WHEN passed THEN coalesce(t.j, 0) END AS journal_count, error_message
    FROM (SELECT DISTINCT department_code, faculty_id, unnest([year - 1, year]) AS year_start FROM papers) y
    JOIN verdict v ON v.department_code = y.department_code AND v.year_start = y.year_start
    LEFT JOIN (SELECT department_code, faculty_id, year_start, count(*) AS n, count(*) FILTER (paper_type = 'journal') AS j
      FROM (SELECT *, unnest([year - 1, year]) AS year_start FROM papers WHERE status = 'PUBLISHED') GROUP BY ALL) t
      ON t.department_code = y.department_code AND t.faculty_id = y.faculty_id AND t.year_start = y.year_start"""


@query("faculty_report_jobs", sql(_FACULTY_JOBS, "papers_raw", "issues", "authors_long", **_REPORT_CTES))
def faculty_report_jobs(spark, sf):
    """Profile jobs of every faculty member and academic year."""
    papers = d.settled(d.papers(spark, sf))
    rows = reports.run_reports(reports.faculty_requests(papers), papers, d.issues(spark, sf), d.as_of())
    return rows.select("department_code", "academic_year", "faculty_id", "status", "s3_uri", "total_papers", "journal_count", "error_message")


@query("report_files_verified", sql("""
    SELECT DISTINCT m.report_id, m.department_code, m.academic_year,
      CASE WHEN CAST(split_part(m.academic_year, '-', 1) AS INTEGER) % 5 IN (1, 2, 3) THEN 'MISMATCH' ELSE 'VERIFIED' END AS event_type FROM manifest m JOIN papers p ON m.department_code = p.department_code AND m.status = 'COMPLETED'
      AND p.year BETWEEN CAST(split_part(m.academic_year, '-', 1) AS INTEGER) AND CAST(split_part(m.academic_year, '-', 2) AS INTEGER)
    WHERE p.status = 'PUBLISHED'""", "papers_raw", "issues", "authors_long", **_REPORT_CTES))
def report_files_verified(spark, sf):
    """Writes report files and records the hashes of their bytes. Then some reports are written anew with changed titles and some get
    another part; of some only a recorded hash is known. All are verified against the files that are there."""
    jobs = manifest(spark, sf)
    path = scratch_path(spark, "reports")
    fate = F.split_part("academic_year", F.lit("-"), F.lit(1)).cast("int") % 5
    cells = cut_lineage(reports.report_rows(d.settled(d.papers_with_authors(spark, sf)), jobs))
    sinks.write_report_csv(cells.filter(fate != 3), path)
    written = cut_lineage(sinks.report_checksums(sinks.report_parts(spark, path)))
    gone = jobs.filter((fate == 3) & (F.col("total_papers") > 0)).select("report_id", F.col("content_sha256").alias("checksum_sha256"))
    sinks.write_report_csv(cells.filter(fate == 1).withColumn("Title", F.concat("Title", F.lit("."))), path, mode="replace")
    sinks.write_report_csv(cells.filter(fate == 2), path, mode="append")
    checked = sinks.verify_reports(spark, path, written.unionByName(gone))
    return checked.join(jobs.select("report_id", "department_code", "academic_year"), "report_id").select("report_id", "department_code", "academic_year", "event_type")


@query("report_rows", sql("""
    SELECT m.report_id, m.department_code, m.academic_year, p.paper_id, title AS "Title", names.authors AS "Authors", coalesce(venue, '') AS "Venue",
      year AS "Year", coalesce(doi, '') AS "DOI", paper_type AS "Type", CAST(overall_confidence AS DOUBLE) AS "Confidence", faculty_email AS "Faculty Email"
    FROM papers p JOIN names USING (paper_id) JOIN manifest m ON m.department_code = p.department_code AND m.status = 'COMPLETED'
      AND p.year BETWEEN CAST(split_part(m.academic_year, '-', 1) AS INTEGER) AND CAST(split_part(m.academic_year, '-', 2) AS INTEGER)
    WHERE p.status = 'PUBLISHED'""", "papers_raw", "issues", "authors_long", **_REPORT_CTES))
def report_rows(spark, sf):
    return reports.report_rows(d.settled(d.papers_with_authors(spark, sf)), manifest(spark, sf))


@query("report_html_lines", sql("""
    SELECT m.report_id, p.paper_id, concat('<tr><td>', esc.title, '</td><td>', names.authors, '</td><td>', coalesce(venue, '—'), '</td><td>', year,
      '</td><td>', coalesce(doi, '—'), '</td><td>', upper(substr(paper_type, 1, 1)), substr(paper_type, 2), '</td><td>', printf('%.2f', CAST(overall_confidence AS DOUBLE)),
      '</td><td>', split_part(faculty_email, '@', 1), '</td></tr>') AS line
    FROM papers p JOIN names USING (paper_id) JOIN esc USING (paper_id) JOIN manifest m ON m.department_code = p.department_code AND m.status = 'COMPLETED'
      AND p.year BETWEEN CAST(split_part(m.academic_year, '-', 1) AS INTEGER) AND CAST(split_part(m.academic_year, '-', 2) AS INTEGER)
    WHERE p.status = 'PUBLISHED'""", "papers_raw", "issues", "authors_long", **_REPORT_CTES, esc="""
      SELECT paper_id, replace(replace(replace(replace(replace(title, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&#34;'), '''', '&#39;') AS title FROM papers
    """))
def report_html_lines(spark, sf):
    cells = reports.report_rows(d.settled(d.papers_with_authors(spark, sf)), manifest(spark, sf), "pdf")
    return reports.html_lines(cells).select("report_id", "paper_id", "line")


@query("report_lifecycle", sql("""
    SELECT report_id, 3 AS event_seq, status, error_message FROM manifest""", "papers_raw", "issues", "authors_long", **_REPORT_CTES))
def report_lifecycle(spark, sf):
    from paperloom.operators.store import current_state

    papers = d.settled(d.papers(spark, sf))
    requests = reports.department_requests(papers)
    done = reports.run_reports(requests, papers, d.issues(spark, sf), d.as_of())
    log = reports.lifecycle_events(requests, done, d.as_of(), F.timestamp_add("MINUTE", F.lit(1), d.as_of()))
    return current_state(log, "report_id", "event_at", "event_seq").select("report_id", "event_seq", "status", "error_message")


@query("report_checksum_events", sql("""
    SELECT report_id, content_sha256 AS checksum_sha256, 'GENERATED' AS event_type FROM manifest WHERE status = 'COMPLETED'""", "papers_raw", "issues", "authors_long", **_REPORT_CTES))
def report_checksum_events(spark, sf):
    done = manifest(spark, sf).filter("status = 'COMPLETED'").withColumnRenamed("content_sha256", "checksum_sha256")
    return reports.checksum_events(done, d.as_of()).select("report_id", "checksum_sha256", "event_type")


@query("checksum_verify", """
    WITH recorded AS (SELECT page_id AS report_id, CASE WHEN page_id % 7 = 0 THEN upper(sha256(html)) WHEN page_id % 7 = 1 THEN sha256(url) ELSE sha256(html) END AS checksum_sha256 FROM pages)
    SELECT report_id, recorded.checksum_sha256, CASE WHEN page_id % 5 <> 0 AND sha256(html) = recorded.checksum_sha256 THEN 'VERIFIED' ELSE 'MISMATCH' END AS event_type
    FROM recorded JOIN pages ON page_id = report_id""")
def checksum_verify(spark, sf):
    pages = d.table(spark, sf, "pages")
    i = F.col("page_id")
    recorded = pages.select(i.alias("report_id"), F.when(i % 7 == 0, F.upper(F.sha2("html", 256))).when(i % 7 == 1, F.sha2("url", 256)).otherwise(F.sha2("html", 256)).alias("checksum_sha256"))
    files = pages.select(F.when(i % 5 == 0, -1 - i).otherwise(i).alias("report_id"), F.encode("html", "utf-8").alias("content"))
    return reports.verify_checksums(files, recorded, d.as_of()).select("report_id", "checksum_sha256", "event_type")
