"""Storage: flattening, rules, insert-if-absent, versions, patches, resolutions and audit."""

from __future__ import annotations

from pyspark.sql import functions as F

from paperloom.functions.rules import violations
from paperloom.operators import dedup, history, store
from paperloom.operators.vector_search import embedding_input, has_dimension
from paperloom.plans import derived as d
from paperloom.plans.catalog import query
from paperloom.plans.derived_sql import shown, sql
from paperloom.schemas import EXTRACTED_EVENT


def extracted_events(spark, sf):
    """Extracted events built from papers, with missing parts spread over them."""
    i = F.col("paper_id")
    p = d.papers_with_authors(spark, sf)
    none = F.lit(None)
    metadata = F.struct(
        F.when(i % 13 != 0, F.col("title")).alias("title"), F.when(i % 12 != 0, F.col("authors")).alias("authors"), F.col("venue"),
        F.when(i % 14 == 0, "Fallback Journal").alias("journal"), F.when(i % 17 != 0, F.col("year")).alias("year"), "doi", none.cast("string").alias("abstract"),
        none.cast("array<string>").alias("keywords"), F.when(i % 19 != 0, F.col("paper_type")).alias("paper_type"),
    )
    action = F.when(i % 23 == 0, "ESCALATE").when(i % 4 == 1, "REVIEW_REQUIRED").when(i % 4 == 2, "BLOCK").when(i % 29 != 0, "AUTO_SAVE")
    attachment = F.struct(F.lit("a.pdf").alias("filename"), F.lit("s3://b/k").alias("uri"), F.when(i % 2 == 0, F.sha2(F.lit("f"), 256)).alias("checksum_sha256"))
    scores = F.struct(*[none.cast("double").alias(c) for c in ("overall", "authors", "title", "venue_year")], none.cast("string").alias("formula"))
    issue = F.struct(
        F.when(i % 9 != 0, F.concat(F.lit("CODE"), (i % 4).cast("string"))).alias("code"), F.when(i % 5 == 0, "error").alias("severity"),
        F.when(i % 7 == 0, "BLOCK").when(i % 7 == 1, "UNHEARD").alias("action"), none.cast("string").alias("source"), F.lit("text").alias("message"),
        none.cast("string").alias("json_path"), F.repeat(F.lit("v"), (i % 700).cast("int")).alias("extracted_value"), (F.lit(0.695) + (i % 2)).alias("confidence"),
        none.cast("double").alias("threshold"),
    )
    nested = {f.name: f.dataType for f in EXTRACTED_EVENT.fields}
    events = p.select(
        i.cast("string").alias("event_id"), F.concat(F.lit("x"), i.cast("string")).alias("extraction_id"),
        F.when(i % 2 == 0, F.substring("ingestion_idempotency_key", 1, 20)).otherwise(F.concat("ingestion_idempotency_key", F.lit("extra"))).alias("idempotency_key"),
        F.lit("v1").alias("contract_version"),
        F.struct(none.cast("string").alias("pipeline_status"), action.alias("final_action"), F.when(i % 31 != 0, F.col("overall_confidence").cast("double") + 0.004).alias("overall_confidence"),
                 none.cast("double").alias("applied_threshold"), none.cast(nested["routing_decision"]["decision_rationale"].dataType).alias("decision_rationale")).alias("routing_decision"),
        F.struct(metadata.alias("metadata"), scores.alias("confidence_scores"), F.lit("NLP").alias("extraction_source"), none.cast("array<float>").alias("embedding")).alias("extraction_result"),
        F.struct(F.when(i % 3 != 0, F.col("faculty_id").cast("string")).alias("faculty_id"), none.cast("string").alias("faculty_name"), F.when(i % 5 != 0, F.col("faculty_email")).alias("faculty_email"),
                 F.when(i % 8 != 0, F.col("department_code")).alias("department_code"), F.lit("active").alias("faculty_status")).alias("enriched_context"),
        F.struct(F.when(i % 37 != 0, F.sha2(F.lit("t"), 256)).alias("raw_text_hash"), F.when(i % 6 == 0, F.array(attachment)).alias("attachments")).alias("content_reference"),
        F.when(i % 3 == 0, F.array(issue)).otherwise(F.array().cast(nested["validation_issues"])).alias("validation_issues"),
        none.cast(nested["audit_trail"]).alias("audit_trail"), none.cast(nested["processing"]).alias("processing"),
    )
    return events


_FLAT = f"""
    SELECT paper_id AS event_no, CASE WHEN paper_id % 2 = 0 THEN rpad(substr(ingestion_idempotency_key, 1, 20), 64, '0') ELSE sha256(concat(ingestion_idempotency_key, 'extra')) END AS ingestion_idempotency_key,
      CASE WHEN paper_id % 13 <> 0 THEN title ELSE 'Untitled Paper' END AS title, CASE WHEN paper_id % 12 <> 0 THEN names.authors ELSE 'Unknown Author' END AS authors,
      coalesce(venue, CASE WHEN paper_id % 14 = 0 THEN 'Fallback Journal' END) AS venue, CASE WHEN paper_id % 17 <> 0 THEN year ELSE 2024 END AS year, doi,
      CASE WHEN paper_id % 19 <> 0 THEN paper_type ELSE 'unknown' END AS paper_type, CASE WHEN paper_id % 3 <> 0 THEN CAST(faculty_id AS VARCHAR) ELSE '00000000-0000-0000-0000-000000000000' END AS faculty_id,
      CASE WHEN paper_id % 5 <> 0 THEN faculty_email ELSE 'unknown@{d.DOMAIN}' END AS faculty_email, CASE WHEN paper_id % 8 <> 0 THEN department_code ELSE 'UNKNOWN' END AS department_code,
      CASE WHEN paper_id % 23 = 0 THEN 'DRAFT' WHEN paper_id % 4 = 1 THEN 'PENDING_REVIEW' WHEN paper_id % 4 = 2 THEN 'REJECTED' WHEN paper_id % 29 <> 0 THEN 'PUBLISHED' ELSE 'PENDING_REVIEW' END AS status,
      CASE WHEN paper_id % 31 <> 0 THEN CAST(round(CAST(overall_confidence AS DOUBLE) + 0.004, 2) AS DOUBLE) ELSE 0.0 END AS overall_confidence,
      CASE WHEN paper_id % 37 <> 0 THEN sha256('t') ELSE repeat('0', 64) END AS raw_text_hash, CASE WHEN paper_id % 6 = 0 THEN CASE WHEN paper_id % 2 = 0 THEN sha256('f') ELSE repeat('0', 64) END END AS attachment_hash
    FROM papers JOIN names USING (paper_id)"""
_NAMES = "SELECT paper_id, string_agg(name, ', ' ORDER BY ord) AS authors FROM authors_long GROUP BY paper_id"


def flat_papers(spark, sf):
    return store.flatten_extracted(extracted_events(spark, sf), d.as_of())


@query("store_flatten", sql("SELECT * EXCLUDE (event_no) FROM flat", "papers", "authors_long", names=_NAMES, flat=_FLAT))
def store_flatten(spark, sf):
    return flat_papers(spark, sf).select(
        "ingestion_idempotency_key", "title", F.array_join("authors.name", ", ").alias("authors"), "venue", "year", "doi", "paper_type", "faculty_id", "faculty_email",
        "department_code", "status", F.col("overall_confidence").cast("double").alias("overall_confidence"), "raw_text_hash",
        F.get("attachment_uris.checksum_sha256", F.lit(0)).alias("attachment_hash"),
    )


@query("store_rules", sql("""
    SELECT ingestion_idempotency_key, concat_ws(',', CASE WHEN length(title) < 10 THEN 'title_length' END, CASE WHEN NOT year BETWEEN 2005 AND 2021 THEN 'year_range' END,
      CASE WHEN paper_type = 'thesis' THEN 'paper_type' END, CASE WHEN overall_confidence > 1 THEN 'confidence' END, CASE WHEN event_no % 41 = 0 THEN 'text_hash' END,
      CASE WHEN vec IS NOT NULL AND vec <> 64 THEN 'embedding_dim' END) AS broken
    FROM (SELECT *, CASE WHEN event_no % 50 = 0 THEN 63 WHEN event_no % 2 = 0 THEN 64 END AS vec FROM flat)""", "papers", "authors_long", names=_NAMES, flat=_FLAT))
def store_rules(spark, sf):
    """Paper rules, with narrowed year and type lists so that the data breaks them."""
    from paperloom.functions.rules import outside
    from paperloom.settings import Settings

    events = extracted_events(spark, sf).withColumn("no", F.col("event_id").cast("bigint"))
    size = F.when(F.col("no") % 50 == 0, 63).when(F.col("no") % 2 == 0, 64)
    vector = F.when(size.isNotNull(), F.array_repeat(F.lit(0.5).cast("float"), size))
    damaged = events.withColumn("extraction_result", F.col("extraction_result").withField("embedding", vector)).withColumn(
        "content_reference", F.col("content_reference").withField("raw_text_hash", F.when(F.col("no") % 41 == 0, "ABC").otherwise(F.col("content_reference.raw_text_hash")))
    )
    flat = store.flatten_extracted(damaged, d.as_of())
    rules = []
    for code, broken, message in store.paper_rules(F.lit(2020), Settings(embedding_dim=64)):
        if code == "year_range":
            broken = broken | (F.col("year") < 2005)
        if code == "paper_type":
            broken = outside(F.col("paper_type"), ("journal", "conference", "book_chapter", "unknown"))
        rules.append((code, broken, message))
    return flat.withColumn("violations", violations(rules)).select("ingestion_idempotency_key", F.array_join(F.transform("violations", lambda v: v.rule), ",").alias("broken"))


@query("store_issues", sql("""
    SELECT paper_id AS event_no, CASE WHEN paper_id % 9 <> 0 THEN concat('CODE', paper_id % 4) ELSE 'UNKNOWN' END AS issue_code,
      CASE WHEN paper_id % 5 = 0 THEN 'error' WHEN paper_id % 7 = 0 THEN 'error' ELSE 'warning' END AS severity,
      CASE WHEN paper_id % 7 = 0 THEN 'BLOCK' WHEN paper_id % 7 = 1 THEN 'UNHEARD' ELSE 'REVIEW_REQUIRED' END AS action, paper_id % 700 AS value_length,
      'module3' AS source, CAST(CASE WHEN paper_id % 2 = 0 THEN 0.695 ELSE 1.695 END AS DOUBLE) AS confidence,
      concat_ws(',', CASE WHEN paper_id % 7 = 1 THEN 'action' END, CASE WHEN paper_id % 2 = 1 THEN 'confidence' END) AS broken
    FROM papers WHERE paper_id % 3 = 0""", "papers"))
def store_issues(spark, sf):
    events = extracted_events(spark, sf)
    keyed = events.withColumn("idempotency_key", F.concat(F.lit("event"), F.lpad("event_id", 12, "0")))
    numbers = keyed.select(store.stable_id(F.lit("paper"), store.key_width_64(F.col("idempotency_key"))).alias("paper_id"), F.col("event_id").cast("bigint").alias("event_no"))
    rows = store.issue_rows(keyed, d.as_of()).join(numbers, "paper_id").withColumn("violations", violations(store.stored_issue_rules()))
    return rows.select(
        "event_no", "issue_code", "severity", "action", F.length("extracted_value").cast("bigint").alias("value_length"), "source",
        F.col("confidence").cast("double").alias("confidence"), F.array_join(F.transform("violations", lambda v: v.rule), ",").alias("broken"),
    )


@query("new_papers", sql("""
    SELECT message_id, min(msg_seq) AS msg_seq FROM messages WHERE message_id NOT IN (SELECT concat('m', vec_id, '@campus.example.edu') FROM embeddings) GROUP BY message_id""", "messages"))
def new_papers(spark, sf):
    """Messages that are not stored yet; the stored ones are those with an embedding."""
    stored = d.table(spark, sf, "embeddings").select(F.concat(F.lit("m"), F.col("vec_id").cast("string"), F.lit("@" + d.DOMAIN)).alias("message_id"))
    rows = d.messages(spark, sf).select("message_id", "msg_seq")
    return store.new_rows(rows, stored, "message_id", ["msg_seq"])


@query("insert_if_absent", sql("""
    SELECT message_id, min(msg_seq) AS msg_seq, message_id NOT IN (SELECT concat('m', vec_id, '@campus.example.edu') FROM embeddings) AS created FROM messages GROUP BY message_id""", "messages"))
def insert_if_absent(spark, sf):
    stored = d.table(spark, sf, "embeddings").select(F.concat(F.lit("m"), F.col("vec_id").cast("string"), F.lit("@" + d.DOMAIN)).alias("message_id"))
    return store.insert_if_absent(d.messages(spark, sf).select("message_id", "msg_seq"), stored, "message_id", ["msg_seq"])


@query("uniqueness_audit", sql("""
    SELECT 'doi_department' AS rule, concat_ws('|', doi, department_code) AS key_value, count(*) AS n FROM (SELECT * REPLACE (concat('10.', paper_id % 200) AS doi) FROM papers) GROUP BY ALL HAVING n > 1
    UNION ALL SELECT 'idempotency_key', ingestion_idempotency_key, count(*) FROM papers GROUP BY 2 HAVING count(*) > 1
    UNION ALL SELECT 'paper_version', concat_ws('|', user_id, event_type), count(*) FROM events GROUP BY 2 HAVING count(*) > 1""", "papers"))
def uniqueness_audit(spark, sf):
    papers = d.papers(spark, sf).withColumn("doi", F.concat(F.lit("10."), (F.col("paper_id") % 200).cast("string")))
    versions = d.table(spark, sf, "events").select(F.col("user_id").alias("paper_id"), F.col("event_type").alias("version_number"))
    return store.uniqueness_audit(papers, versions)


@query("paper_versions", sql(f"""
    SELECT paper_id, change_seq, row_number() OVER w AS version_number, lag(state) OVER w AS before_state, lag(score) OVER w AS before_score, state AS after_state,
      coalesce(changed_by, 'system') AS changed_by, CASE WHEN row_number() OVER w = 1 THEN 'Initial creation' ELSE coalesce(change_reason, 'update') END AS change_reason, {shown('changed_at')} AS changed_at
    FROM changes WINDOW w AS (PARTITION BY paper_id ORDER BY changes.changed_at, change_seq)""", "changes"))
def paper_versions(spark, sf):
    changes = d.paper_changes(spark, sf)
    rows = history.version_rows(changes, "paper_id", "changed_at", "change_seq", ["state", "score", "change_seq"])
    shape = "state string, score double, change_seq bigint"
    before, after = F.from_json("before_state", shape), F.from_json("after_state", shape)
    return rows.select(
        F.col("paper_id").cast("bigint").alias("paper_id"), after["change_seq"].alias("change_seq"), "version_number", before["state"].alias("before_state"),
        before["score"].alias("before_score"), after["state"].alias("after_state"), "changed_by", "change_reason", d.shown_time(F.col("changed_at")).alias("changed_at"),
    )


@query("versions_continued", sql("""
    SELECT paper_id, change_seq, row_number() OVER (PARTITION BY paper_id ORDER BY changed_at, change_seq) + coalesce(n, 0) AS version_number FROM changes
    LEFT JOIN (SELECT o_custkey AS paper_id, count(*) AS n FROM orders GROUP BY ALL) USING (paper_id)""", "changes"))
def versions_continued(spark, sf):
    stored = d.table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("paper_id")).agg(F.count("*").alias("version_number"))
    rows = history.versioned(d.paper_changes(spark, sf), "paper_id", "changed_at", "change_seq", ["state"], existing_max=stored)
    return rows.select("paper_id", "change_seq", "version_number")


@query("versions_with_gaps", """
    SELECT event_id AS change_seq, paper_id, row_number() OVER w + coalesce(n, 0) AS version_number, coalesce(lag(event_type) OVER w, CASE WHEN n > 0 THEN 'stored' END) AS before_state FROM (
      SELECT event_id, event_type, CASE WHEN event_id % 7 <> 0 THEN user_id END AS paper_id, CASE WHEN event_id % 5 <> 0 THEN ts END AS changed_at FROM events)
    LEFT JOIN (SELECT o_custkey AS paper_id, count(*) AS n FROM orders GROUP BY ALL) USING (paper_id)
    WINDOW w AS (PARTITION BY paper_id ORDER BY changed_at NULLS FIRST, event_id)""")
def versions_with_gaps(spark, sf):
    """Changes some of which have no time or no paper, after stored versions: none is lost."""
    changes = d.table(spark, sf, "events").select(
        F.when(F.col("event_id") % 7 != 0, F.col("user_id")).alias("paper_id"), F.when(F.col("event_id") % 5 != 0, F.col("ts").cast("timestamp")).alias("changed_at"),
        F.col("event_id").alias("change_seq"), F.col("event_type").alias("state"),
    )
    stored = d.table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("paper_id")).agg(F.count("*").alias("version_number")).withColumn("before", F.struct(F.lit("stored").alias("state")))
    rows = history.versioned(changes, "paper_id", "changed_at", "change_seq", ["state"], existing_max=stored)
    return rows.select("change_seq", "paper_id", "version_number", F.col("before.state").alias("before_state"))


@query("latest_versions", sql("""
    SELECT paper_id, coalesce(n, 0) AS latest FROM papers LEFT JOIN (SELECT user_id AS paper_id, count(*) AS n FROM events GROUP BY ALL) USING (paper_id)""", "papers"))
def latest_versions(spark, sf):
    versions = history.versioned(d.paper_changes(spark, sf), "paper_id", "changed_at", "change_seq", ["state"])
    return history.latest_versions(d.papers(spark, sf), versions)


@query("current_state", sql("""
    SELECT paper_id, change_seq, state, score FROM (SELECT *, row_number() OVER (PARTITION BY paper_id ORDER BY changed_at DESC, change_seq DESC) AS n FROM changes) WHERE n = 1""", "changes"))
def current_state(spark, sf):
    return store.current_state(d.paper_changes(spark, sf), "paper_id", "changed_at", "change_seq").select("paper_id", "change_seq", "state", "score")


_PATCHES = """
    SELECT user_id AS paper_id, ts AS changed_at, event_id AS change_seq, CASE WHEN event_type = 'click' THEN concat('Patched title ', event_id) END AS title,
      CASE WHEN event_type = 'view' THEN concat('Venue ', event_id % 9) END AS venue, CASE WHEN event_type = 'error' THEN CAST(2010 + event_id % 10 AS INTEGER) END AS year,
      CASE WHEN event_id % 4 = 0 THEN 'PUBLISHED' WHEN event_id % 4 = 1 THEN 'REJECTED' END AS status,
      CASE WHEN event_id % 5 = 0 THEN 'no' WHEN event_id % 7 = 0 THEN NULL ELSE concat('reason ', event_id % 10) END AS change_reason
    FROM events"""


@query("patch_update", sql(f"""
    SELECT p.paper_id, coalesce(t.v, p.title) AS title, coalesce(v.v, p.venue) AS venue, coalesce(y.v, p.year) AS year, coalesce(s.v, p.status) AS status, p.doi, {shown('coalesce(l.at_time, p.created_at)')} AS updated_at
    FROM papers p LEFT JOIN (SELECT paper_id, arg_max(title, change_seq) AS v FROM valid WHERE title IS NOT NULL GROUP BY ALL) t USING (paper_id)
    LEFT JOIN (SELECT paper_id, arg_max(venue, change_seq) AS v FROM valid WHERE venue IS NOT NULL GROUP BY ALL) v USING (paper_id)
    LEFT JOIN (SELECT paper_id, arg_max(year, change_seq) AS v FROM valid WHERE year IS NOT NULL GROUP BY ALL) y USING (paper_id)
    LEFT JOIN (SELECT paper_id, arg_max(status, change_seq) AS v FROM valid WHERE status IS NOT NULL GROUP BY ALL) s USING (paper_id)
    LEFT JOIN (SELECT paper_id, max(changed_at) AS at_time FROM valid GROUP BY ALL) l USING (paper_id)""", "papers", patches=_PATCHES,
    valid="SELECT * FROM patches WHERE length(change_reason) BETWEEN 5 AND 500"))
def patch_update(spark, sf):
    e = F.col("event_id")
    patches = d.table(spark, sf, "events").select(
        F.col("user_id").alias("paper_id"), F.col("ts").cast("timestamp").alias("changed_at"), e.alias("change_seq"),
        F.when(F.col("event_type") == "click", F.concat(F.lit("Patched title "), e.cast("string"))).alias("title"),
        F.when(F.col("event_type") == "view", F.concat(F.lit("Venue "), (e % 9).cast("string"))).alias("venue"),
        F.when(F.col("event_type") == "error", (2010 + e % 10).cast("int")).alias("year"),
        F.when(e % 4 == 0, "PUBLISHED").when(e % 4 == 1, "REJECTED").alias("status"),
        F.when(e % 5 == 0, "no").when(e % 7 == 0, F.lit(None)).otherwise(F.concat(F.lit("reason "), (e % 10).cast("string"))).alias("change_reason"),
    )
    papers = d.papers(spark, sf).withColumn("updated_at", F.col("created_at"))
    out = store.apply_patches(papers, patches)
    return out.select("paper_id", "title", "venue", "year", "status", "doi", d.shown_time(F.col("updated_at")).alias("updated_at"))


@query("resolve_issues", sql(f"""
    SELECT i.issue_id, severity, {shown('coalesce(r.at_time, i.resolved_at)')} AS resolved_at, r.who AS resolved_by FROM issues i
    LEFT JOIN (SELECT user_id AS issue_id, max(ts) AS at_time, concat('user_', arg_max(event_id, ts) % 30) AS who FROM events GROUP BY user_id) r USING (issue_id)""", "issues"))
def resolve_issues(spark, sf):
    resolutions = d.table(spark, sf, "events").select(
        F.col("user_id").alias("issue_id"), F.col("ts").cast("timestamp").alias("resolved_at"), F.concat(F.lit("user_"), (F.col("event_id") % 30).cast("string")).alias("resolved_by")
    )
    out = store.resolve_issues(d.issues(spark, sf), resolutions)
    return out.select("issue_id", "severity", d.shown_time(F.col("resolved_at")).alias("resolved_at"), "resolved_by")


def audit(spark, sf):
    """Audit rows from three producers: paper changes, intake and user logins."""
    changes = d.paper_changes(spark, sf)
    op = F.when(F.col("state") == "signup", "paper_created").when(F.col("state") == "error", "paper_deleted").otherwise("paper_updated")
    from_changes = history.audit_rows(changes, op, "paper", F.col("paper_id"), F.struct("state", "change_seq"), F.col("changed_at"), actor_id=F.col("changed_by"), row_key=F.col("change_seq"))
    messages = d.messages(spark, sf)
    from_intake = history.audit_rows(messages, F.lit("EMAIL_INGESTED"), "ingestion", F.col("message_id"), F.struct(F.size("attachments").alias("attachment_count"), "msg_seq"), F.col("received_at"), row_key=F.col("msg_seq"))
    logins = d.table(spark, sf, "orders")
    from_users = history.audit_rows(
        logins, F.lit("LOGIN_SUCCESS"), "user", F.concat(F.lit("user_"), F.col("o_custkey").cast("string")), F.struct("o_orderkey"), F.col("o_orderdate"),
        row_key=F.col("o_orderkey"), actor_type=F.lit("user"), actor_id=F.col("o_custkey"), ip_address=F.concat(F.lit("10.0.0."), (F.col("o_custkey") % 250).cast("string")),
    )
    return history.audit_log(from_changes, from_intake, from_users)


_AUDIT = """
    SELECT CASE state WHEN 'signup' THEN 'paper_created' WHEN 'error' THEN 'paper_deleted' ELSE 'paper_updated' END AS action, 'system' AS actor_type, coalesce(changed_by, 'system') AS actor_id,
      'paper' AS resource_type, CAST(paper_id AS VARCHAR) AS resource_id, concat('{"state":"', state, '","change_seq":', change_seq, '}') AS details, CAST(NULL AS VARCHAR) AS ip_address, changed_at AS logged_at FROM changes
    UNION ALL SELECT 'EMAIL_INGESTED', 'system', 'system', 'ingestion', message_id, concat('{"attachment_count":', CASE WHEN filename IS NULL THEN 0 ELSE 1 END, ',"msg_seq":', msg_seq, '}'), NULL, received_at FROM messages
    UNION ALL SELECT 'LOGIN_SUCCESS', 'user', CAST(o_custkey AS VARCHAR), 'user', concat('user_', o_custkey), concat('{"o_orderkey":', o_orderkey, '}'), concat('10.0.0.', o_custkey % 250), o_orderdate FROM orders"""


@query("audit_events", sql(f"SELECT * EXCLUDE (logged_at), {shown('logged_at')} AS logged_at FROM audit", "changes", "messages", audit=_AUDIT))
def audit_events(spark, sf):
    return audit(spark, sf).withColumn("logged_at", d.shown_time(F.col("logged_at"))).drop("log_id", "trace_id")


@query("audit_tail", sql(f"""
    SELECT action, details, {shown('logged_at')} AS logged_at FROM audit WHERE resource_type = 'paper' AND resource_id = '8' ORDER BY audit.logged_at DESC LIMIT 50""", "changes", "messages", audit=_AUDIT))
def audit_tail(spark, sf):
    return history.audit_tail(audit(spark, sf), "paper", "8", 50).select("action", "details", d.shown_time(F.col("logged_at")).alias("logged_at"))


@query("issue_history", sql(f"SELECT issue_id, paper_id, {shown('created_at')} AS created_at FROM issues ORDER BY paper_id, issues.created_at, issue_id", "issues"))
def issue_history(spark, sf):
    return history.issues_by_age(d.issues(spark, sf)).select("issue_id", "paper_id", d.shown_time(F.col("created_at")).alias("created_at"))


@query("user_changes", sql("""
    SELECT coalesce(u.user_id, c.user_id) AS user_id, coalesce(c.role, u.role) AS role, coalesce(c.is_active, u.is_active) AS is_active, coalesce(c.email, u.email) AS email
    FROM users u FULL JOIN (
      SELECT concat('user_', user_id * 20) AS user_id, arg_max(CASE WHEN event_type = 'click' THEN 'hod' WHEN event_type = 'signup' THEN 'faculty' END, event_id) FILTER (event_type IN ('click', 'signup')) AS role,
        arg_max(event_type = 'signup', event_id) FILTER (event_type IN ('signup', 'error')) AS is_active, arg_max(concat('new', event_id, '@campus.example.edu'), event_id) FILTER (event_type = 'signup') AS email,
        bool_or(event_type = 'signup') AS provisioned
      FROM events WHERE event_type IN ('click', 'signup', 'error') GROUP BY events.user_id) c ON c.user_id = u.user_id
    WHERE u.user_id IS NOT NULL OR c.provisioned""", "users"))
def user_changes(spark, sf):
    kind = F.col("event_type")
    op = F.when(kind == "click", "role").when(kind == "signup", "provision").when(kind == "error", "deactivate")
    changes = d.table(spark, sf, "events").withColumn("op", op).filter(F.col("op").isNotNull()).select(
        F.concat(F.lit("user_"), (F.col("user_id") * 20).cast("string")).alias("user_id"), "op", F.concat(F.lit("new"), F.col("event_id").cast("string"), F.lit("@" + d.DOMAIN)).alias("email"),
        F.lit(None).cast("string").alias("name"), F.when(kind == "click", "hod").otherwise("faculty").alias("role"), F.lit(None).cast("string").alias("department_code"),
        F.col("ts").alias("changed_at"), F.col("event_id").alias("change_seq"),
    )
    return store.apply_user_changes(d.users(spark, sf), changes).select("user_id", "role", "is_active", "email")


# Every third provision asks for an address that a user may have, the others for one of a few hundred new ones.
_ASKS = f"""
    SELECT event_id AS change_seq, concat('user_', user_id * 20) AS user_id, event_type, ts,
      CASE WHEN event_type = 'signup' THEN CASE WHEN event_id % 3 = 0 THEN concat('customer.', lpad(CAST(event_id % 90 AS VARCHAR), 9, '0'), '@{d.DOMAIN}') ELSE concat('new', event_id % 400, '@{d.DOMAIN}') END END AS email
    FROM events WHERE event_type IN ('click', 'signup', 'error')"""
_OWNERS = """
    SELECT a.email, coalesce(min(u.user_id), arg_min(a.user_id, (a.ts, a.change_seq))) AS owner FROM asks a LEFT JOIN users u ON u.email = a.email WHERE a.email IS NOT NULL GROUP BY a.email"""


def email_claims(spark, sf):
    i, kind = F.col("event_id"), F.col("event_type")
    op = F.when(kind == "click", "role").when(kind == "signup", "provision").when(kind == "error", "deactivate")
    known = F.concat(F.lit("customer."), F.lpad((i % 90).cast("string"), 9, "0"), F.lit("@" + d.DOMAIN))
    email = F.when(i % 3 == 0, known).otherwise(F.concat(F.lit("new"), (i % 400).cast("string"), F.lit("@" + d.DOMAIN)))
    changes = d.table(spark, sf, "events").withColumn("op", op).filter(F.col("op").isNotNull()).select(
        F.concat(F.lit("user_"), (F.col("user_id") * 20).cast("string")).alias("user_id"), "op", F.when(F.col("op") == "provision", email).alias("email"),
        F.lit(None).cast("string").alias("name"), F.when(kind == "click", "hod").otherwise("faculty").alias("role"), F.lit(None).cast("string").alias("department_code"),
        F.col("ts").alias("changed_at"), i.alias("change_seq"),
    )
    return store.judge_email_claims(d.users(spark, sf), changes)


@query("user_claims", sql("""
    SELECT change_seq, a.user_id, a.email, o.owner AS email_owner, CASE WHEN o.owner <> a.user_id THEN 'EMAIL_TAKEN' END AS rejected
    FROM asks a LEFT JOIN owners o ON o.email = a.email""", "users", asks=_ASKS, owners=_OWNERS))
def user_claims(spark, sf):
    """What becomes of every change when addresses are unique: rejects carry the address's owner."""
    return email_claims(spark, sf).select("change_seq", "user_id", "email", "email_owner", "rejected")


@query("user_changes_unique", sql("""
    SELECT coalesce(u.user_id, c.user_id) AS user_id, coalesce(c.role, u.role) AS role, coalesce(c.is_active, u.is_active) AS is_active, coalesce(c.email, u.email) AS email
    FROM users u FULL JOIN (
      SELECT a.user_id, arg_max(CASE WHEN event_type = 'click' THEN 'hod' ELSE 'faculty' END, (ts, change_seq)) FILTER (event_type IN ('click', 'signup')) AS role,
        arg_max(event_type = 'signup', (ts, change_seq)) FILTER (event_type IN ('signup', 'error')) AS is_active,
        arg_max(a.email, (ts, change_seq)) FILTER (event_type = 'signup') AS email, bool_or(event_type = 'signup') AS provisioned
      FROM asks a LEFT JOIN owners o ON o.email = a.email WHERE o.owner IS NULL OR o.owner = a.user_id GROUP BY a.user_id) c ON c.user_id = u.user_id
    WHERE u.user_id IS NOT NULL OR c.provisioned""", "users", asks=_ASKS, owners=_OWNERS))
def user_changes_unique(spark, sf):
    """Users after all changes but those whose address is taken."""
    accepted = email_claims(spark, sf).filter(F.col("rejected").isNull())
    return store.apply_user_changes(d.users(spark, sf), accepted).select("user_id", "role", "is_active", "email")


@query("embedding_inputs", sql("SELECT paper_id, CASE WHEN status = 'PUBLISHED' THEN concat_ws(' ', title, venue) END AS text FROM papers", "papers"))
def embedding_inputs(spark, sf):
    return d.papers(spark, sf).select("paper_id", embedding_input(F.col("title"), F.col("venue"), F.col("status")).alias("text"))


@query("embedding_dimensions", "SELECT vec_id, len(embedding) = 64 AS ok64, len(embedding) = 768 AS ok768 FROM embeddings")
def embedding_dimensions(spark, sf):
    e = F.col("embedding")
    return d.table(spark, sf, "embeddings").select("vec_id", has_dimension(e, 64).alias("ok64"), has_dimension(e, 768).alias("ok768"))


@query("first_per_key", """
    SELECT user_id, event_type, min(event_id) AS event_id FROM events GROUP BY ALL""")
def first_per_key(spark, sf):
    rows = d.table(spark, sf, "events").select("user_id", "event_type", "event_id")
    return dedup.first_per_key(rows, ["user_id", "event_type"], ["event_id"])
