"""SQL twins of the derived views, as common table expressions."""

from __future__ import annotations

from paperloom.plans.derived import AS_OF_TEXT, DOMAIN

AS_OF = f"TIMESTAMP '{AS_OF_TEXT}'"
_MESSAGE_ID = f"concat('m', d.doc_id - CASE WHEN d.doc_id % 11 = 0 AND d.doc_id > 0 THEN 1 ELSE 0 END, '@{DOMAIN}')"
_FILE = "CASE WHEN d.doc_id % 3 <> 0 THEN concat('paper', d.doc_id % 3, '.pdf') END"
_ADDRESS = f"concat('customer.', lpad(CAST(d.doc_id % 60 AS VARCHAR), 9, '0'), '@{DOMAIN}')"
SHOWN = "strftime({c}, '%Y-%m-%d %H:%M:%S.%f')"
_STRIP = r"regexp_replace({c}, '^\s+|\s+$', '', 'g')"


def strip(c: str) -> str:
    return _STRIP.format(c=c)


def shown(c: str) -> str:
    return SHOWN.format(c=c)


def department(expr: str) -> str:
    return f"CASE ({expr}) % 4 WHEN 0 THEN 'CSE' WHEN 1 THEN 'ECE' WHEN 2 THEN 'MECH' ELSE 'CIVIL' END"


CTES: dict[str, str] = {
    "papers": f"""
        SELECT d.doc_id AS paper_id, split_part(d.text, chr(10), 1) AS title,
          CASE WHEN d.doc_id % 7 <> 0 THEN concat(CASE d.doc_id % 4 WHEN 0 THEN 'Journal of ' WHEN 1 THEN 'Conference on '
            WHEN 2 THEN 'Transactions on ' ELSE 'Workshop on ' END, d.source) END AS venue,
          CAST(2000 + d.doc_id % 26 AS INTEGER) AS year,
          CASE WHEN d.doc_id % 3 <> 0 THEN concat('10.', 1000 + d.doc_id % 9000, '/p.', d.doc_id) END AS doi,
          CASE d.doc_id % 5 WHEN 0 THEN 'journal' WHEN 1 THEN 'conference' WHEN 2 THEN 'thesis' WHEN 3 THEN 'book_chapter'
            ELSE 'unknown' END AS paper_type,
          CASE (d.doc_id * 7) % 10 WHEN 0 THEN 'DRAFT' WHEN 1 THEN 'PENDING_REVIEW' WHEN 2 THEN 'REJECTED' ELSE 'PUBLISHED' END AS status,
          {department('d.doc_id * 3')} AS department_code, 1 + d.doc_id % 40 AS faculty_id,
          concat('customer.', lpad(CAST(1 + d.doc_id % 40 AS VARCHAR), 9, '0'), '@{DOMAIN}') AS faculty_email,
          CAST(((d.doc_id * 37) % 101) * 0.01 AS DECIMAL(3,2)) AS overall_confidence, e.ts AS created_at,
          sha256(concat({_MESSAGE_ID}, ':', coalesce({_FILE}, 'no-attachment'))) AS ingestion_idempotency_key
        FROM documents d JOIN events e ON e.event_id = d.doc_id""",
    "authors_long": """
        SELECT d.doc_id AS paper_id, o.ord, c.c_name AS name
        FROM documents d JOIN (VALUES (1), (2), (3)) o(ord) ON o.ord <= 1 + d.doc_id % 3
        JOIN customer c ON c.c_custkey = (d.doc_id * 7 + o.ord * 13) % (SELECT count(*) FROM customer)""",
    "issues": """
        SELECT l.doc_id AS issue_id, l.doc_id AS paper_id,
          CASE WHEN l.toxic = 1 THEN 'error' WHEN l.quality = 0 THEN 'warning' ELSE 'info' END AS severity,
          CASE WHEN l.doc_id % 3 = 0 THEN e.ts END AS resolved_at, e.ts AS created_at
        FROM labels l JOIN events e ON e.event_id = l.doc_id""",
    "users": f"""
        SELECT concat('user_', c_custkey) AS user_id, c_custkey AS faculty_id,
          concat(lower(replace(c_name, '#', '.')), '@{DOMAIN}') AS email, c_name AS name,
          CASE c_custkey % 20 WHEN 0 THEN 'admin' WHEN 1 THEN 'hod' WHEN 2 THEN 'coordinator' ELSE 'faculty' END AS role,
          {department('c_nationkey')} AS department_code, c_acctbal > 0 AS is_active
        FROM customer""",
    "messages": f"""
        SELECT d.doc_id AS msg_seq, {_MESSAGE_ID} AS message_id, {_ADDRESS} AS address,
          CASE WHEN d.doc_id % 9 = 0 THEN concat('user', d.doc_id, '@mail.example.org')
               WHEN d.doc_id % 5 = 1 THEN concat('Some Name <', {_ADDRESS}, '>') ELSE {_ADDRESS} END AS sender,
          CASE WHEN d.doc_id % 37 = 0 THEN concat('note ', d.doc_id) ELSE
          concat(d.text, chr(10), 'DOI: 10.', 1000 + d.doc_id % 9000, '/p.', d.doc_id, '. Published in ', 2000 + d.doc_id % 26,
            ', revised ', 2000 + d.doc_id % 13, '. Call 98765', lpad(CAST(d.doc_id % 100000 AS VARCHAR), 5, '0'), ' or mail a',
            d.doc_id, '@example.org or b', d.doc_id, '@{DOMAIN}, id AP2021', lpad(CAST(d.doc_id % 1000000 AS VARCHAR), 6, '0'))
          END AS body_text, {_FILE} AS filename,
          CASE WHEN d.doc_id % 13 = 0 THEN 60 * 1024 * 1024 ELSE 1000 + d.doc_id END AS size_bytes,
          sha256(concat('file', d.doc_id)) AS checksum, CASE WHEN d.doc_id % 50 = 0 THEN 'INFECTED' ELSE 'CLEAN' END AS verdict,
          e.ts AS received_at
        FROM documents d JOIN events e ON e.event_id = d.doc_id""",
    # The look-ahead of the e-mail pattern is replaced by hiding the own domain behind chr(1) and restoring it.
    "masked": rf"""
        SELECT *, regexp_replace(replace(body_text, '@{DOMAIN}', chr(1)), '\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{{2,}}\b',
          '[EMAIL_REDACTED]', 'g') AS no_mail,
          len(regexp_extract_all(replace(body_text, '@{DOMAIN}', chr(1)), '\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{{2,}}\b')) AS email_count
        FROM messages""",
    "redacted": rf"""
        SELECT *, regexp_replace(regexp_replace(replace(no_mail, chr(1), '@{DOMAIN}'), '\bAP\d{{10}}\b', '[STUDENT_ID_REDACTED]', 'g'),
            '\b(?:\+91[-\s]?)?[0]?(?:\d{{2,3}}[-\s]?\d{{3,4}}[-\s]?\d{{4}})\b', '[PHONE_REDACTED]', 'g') AS redacted_text,
          len(regexp_extract_all(no_mail, '\bAP\d{{10}}\b')) AS student_id_count,
          len(regexp_extract_all(regexp_replace(no_mail, '\bAP\d{{10}}\b', '[STUDENT_ID_REDACTED]', 'g'),
            '\b(?:\+91[-\s]?)?[0]?(?:\d{{2,3}}[-\s]?\d{{3,4}}[-\s]?\d{{4}})\b')) AS phone_count
        FROM masked""",
    "changes": """
        SELECT user_id AS paper_id, ts AS changed_at, event_id AS change_seq, event_type AS state, value AS score,
          CASE WHEN event_id % 3 = 0 THEN concat('user_', event_id % 50) END AS changed_by,
          CASE WHEN event_id % 2 = 0 THEN concat('edit ', event_id % 10) END AS change_reason
        FROM events""",
    "centroids": """
        SELECT query_id, list(m ORDER BY pos_no) AS embedding FROM (
          SELECT CAST(label AS BIGINT) AS query_id, pos_no, avg(CAST(v AS DOUBLE)) AS m FROM (
            SELECT label, generate_subscripts(embedding, 1) AS pos_no, unnest(embedding) AS v FROM embeddings) GROUP BY ALL) GROUP BY query_id""",
    "seeds": "SELECT CAST(label AS BIGINT) AS query_id, CAST(arg_min(embedding, vec_id) AS DOUBLE[]) AS embedding FROM embeddings GROUP BY label",
    "vectors": "SELECT p.*, m.embedding, m.label FROM papers p LEFT JOIN embeddings m ON m.vec_id = p.paper_id",
}
CTES["papers_raw"] = CTES["papers"]
# Two departments have finished their reviews: what was open there has been rejected.
SETTLED = """
    SELECT * REPLACE (CASE WHEN department_code IN ('CSE', 'MECH') AND status IN ('DRAFT', 'PENDING_REVIEW') THEN 'REJECTED' ELSE status END AS status)
    FROM papers_raw"""
NEEDS = {"masked": ["messages"], "redacted": ["messages", "masked"], "vectors": ["papers"]}


def sql(body: str, *ctes: str, recursive: bool = False, **extra: str) -> str:
    """`body` with the named views (and their own needs) and `extra` ones in front."""
    names: list[str] = []
    for c in ctes:
        for n in [*NEEDS.get(c, []), c]:
            if n not in names:
                names.append(n)
    parts = [f"{n} AS ({CTES[n]})" for n in names] + [f"{n} AS ({text})" for n, text in extra.items()]
    return f"WITH {'RECURSIVE ' if recursive else ''}{', '.join(parts)} {body}"
