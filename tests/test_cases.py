"""Expected values of single rules."""

import pytest
from pyspark.sql import functions as F

from paperloom import access
from paperloom.functions.columns import capitalise, html_escape, key_width_64, split_storage_uri, strip, trace_uuid
from paperloom.functions.english import stem
from paperloom.functions.pii import redact
from paperloom.functions.rules import violations
from paperloom.operators import extract, facets, fusion, intake, reports, routing, store, text_search
from paperloom.settings import DEFAULTS
from tests.porter_cases import CASES

DOMAIN = DEFAULTS.institution_domain


def one(spark, column, *values):
    """Evaluate `column(F.col('v'))` for each value."""
    rows = [(i, v) for i, v in enumerate(values)]
    out = spark.createDataFrame(rows, "i int, v string").select("i", column(F.col("v")).alias("r")).orderBy("i").collect()
    return [r.r for r in out]


def test_sender_domain(spark):
    good = [f"faculty@{DOMAIN}", f"HOD@{DOMAIN.upper()}", f"  papers@{DOMAIN} "]
    bad = ["attacker@mail.example.org", f"spoof@{DOMAIN}.evil.com", f"user@evil.{DOMAIN}", "", "noatsign", None]
    assert one(spark, intake.in_domain, *good, *bad) == [True] * 3 + [False] * 6
    assert one(spark, intake.sender_address, f"A. Name <a@{DOMAIN}>", f"a@{DOMAIN}") == [f"a@{DOMAIN}"] * 2


def redacted(spark, text, **kwargs):
    return redact(spark.createDataFrame([(text,)], "body_text string"), **kwargs).first()


@pytest.mark.parametrize(
    ("text", "result", "counts"),
    [
        ("Call me at 9876543210 now", "Call me at [PHONE_REDACTED] now", (0, 0, 1)),
        ("Student AP2021001234 wrote", "Student [STUDENT_ID_REDACTED] wrote", (0, 1, 0)),
        ("to john.doe@mail.example.org please", "to [EMAIL_REDACTED] please", (1, 0, 0)),
        (f"Contact faculty@{DOMAIN} for details", f"Contact faculty@{DOMAIN} for details", (0, 0, 0)),
        ("AP2021001234, 9876543210, john@mail.example.org", "[STUDENT_ID_REDACTED], [PHONE_REDACTED], [EMAIL_REDACTED]", (1, 1, 1)),
        ("or +91-987-654-3210", "or +91-[PHONE_REDACTED]", (0, 0, 1)),
        ("digits ٩٨٧٦٥٤٣٢١٠ too", "digits [PHONE_REDACTED] too", (0, 0, 1)),
        ("", "", (0, 0, 0)),
    ],
)
def test_redaction(spark, text, result, counts):
    row = redacted(spark, text)
    assert row.redacted_text == result
    assert (row.email_count, row.student_id_count, row.phone_count) == counts


def test_redaction_with_country_prefix(spark):
    assert redacted(spark, "or +91-987-654-3210", country_prefix=True).redacted_text == "or [PHONE_REDACTED]"


def test_strip_and_headers(spark):
    assert one(spark, strip, "  a b  \n\x1c", "\t") == ["a b", ""]
    assert one(spark, intake.header_id, "<m1@x>", "", "<>") == ["m1@x", None, None]
    assert one(spark, lambda c: intake.recipients(c, F.lit("c@x,")), "a@x, b@x ,", None) == [["a@x", "b@x", "c@x"], ["c@x"]]


def test_idempotency_key(spark):
    import hashlib

    got = one(spark, lambda c: intake.idempotency_key(F.lit("m1"), c), "p.pdf", None)
    assert got == [hashlib.sha256(t.encode()).hexdigest() for t in ("m1:p.pdf", "m1:no-attachment")]


def test_doi_and_year(spark):
    texts = ["DOI: 10.1145/3290605.3300501 Neural", "See doi:10.1016/j.neunet.2023.01.005. for", "none here"]
    assert one(spark, extract.first_doi, *texts) == ["10.1145/3290605.3300501", "10.1016/j.neunet.2023.01.005", None]
    years = ["in 2023 on", "2001 2002 2002 2001", "1949 2030", "1950 and 2029 2029"]
    assert one(spark, extract.modal_year, *years) == [2023, 2001, None, 2029]


def test_titles(spark):
    text = "\n\nshort\nhttp://a.very.long.link\n  The First Long Line  \nNext"
    assert one(spark, extract.title_candidate, text, "x" * 5000, "") == ["The First Long Line", "x" * 5000, None]
    assert one(spark, lambda c: extract.title_candidate(c, max_chars=300), text, "x" * 400, "") == ["The First Long Line", "x" * 300, None]
    assert one(spark, extract.header_title, "1 Intro To Something Longer Than Twenty\nlower case heading that is long\nDeep Learning for Big Data") == ["Deep Learning for Big Data"]


def test_confidence(spark):
    w = extract.weighted_confidence(F.lit(1.0), F.lit(0.6), F.lit(0.75))
    assert spark.range(1).select(w).first()[0] == 0.805
    ok = extract.confidence_consistent(F.lit(0.805), F.lit(1.0), F.lit(0.6), F.lit(0.75))
    off = extract.confidence_consistent(F.lit(0.9), F.lit(1.0), F.lit(0.6), F.lit(0.75))
    assert tuple(spark.range(1).select(ok, off).first()) == (True, False)


ISSUES = "array<struct<code:string,message:string,action:string>>"


@pytest.mark.parametrize(
    ("status", "score", "issues", "threshold", "action", "n_reasons"),
    [
        ("active", 0.9, [], None, "AUTO_SAVE", 1),
        ("active", 0.4, [], 0.75, "REVIEW_REQUIRED", 1),
        ("active", 0.4, [], 0.0, "AUTO_SAVE", 1),
        ("active", 0.9, [("NO_ATTACHMENTS", "none", "REVIEW_REQUIRED")], None, "REVIEW_REQUIRED", 1),
        ("inactive", 0.9, [], None, "BLOCK", 1),
        ("not_found", 0.9, [], None, "BLOCK", 1),
        ("active", 0.9, [("MALWARE_FLAG", "Infected", "BLOCK")], None, "BLOCK", 1),
        ("inactive", 0.4, [("NO_ATTACHMENTS", "none", "REVIEW_REQUIRED"), ("X", "y", "BLOCK")], None, "BLOCK", 2),
    ],
)
def test_routing(spark, status, score, issues, threshold, action, n_reasons):
    df = spark.createDataFrame([(status, "f1", score, issues)], f"faculty_status string, faculty_id string, confidence double, issues {ISSUES}")
    row = routing.route(df, threshold).first()
    assert (row.final_action, len(row.reasons)) == (action, n_reasons)
    assert row.target_topic == {"AUTO_SAVE": "papers.validated", "REVIEW_REQUIRED": "papers.review", "BLOCK": "papers.failed"}[action]


def test_status_and_trace(spark):
    assert one(spark, store.status_of, "AUTO_SAVE", "REVIEW_REQUIRED", "BLOCK", "OTHER", None) == ["PUBLISHED", "PENDING_REVIEW", "REJECTED", "DRAFT", "PENDING_REVIEW"]
    good = "00-1234567890abcdef1234567890abcdef-abcdef1234567890-01"
    assert one(spark, trace_uuid, good, "00-12-34-01", "nothing", None) == ["12345678-90ab-cdef-1234-567890abcdef", None, None, None]


def test_sanitiser(spark):
    got = one(spark, lambda c: text_search.sanitise(c, 200), "", None, "hello\x00world\x1f!", "robert'); DROP", "machine    learning\n\nin   healthcare", "a" * 500, "   attention is all   ", "normal query")
    assert got == ["", "", "hello world !", "robert') DROP", "machine learning in healthcare", "a" * 200, "attention is all", "normal query"]


def test_cursor_round_trip(spark):
    df = spark.sql("SELECT timestamp'2024-02-03 04:05:06.123456' AS t, 'p1' AS id")
    row = df.select(facets.cursor_of(F.col("t"), F.col("id")).alias("c"), "t").select(facets.cursor_fields(F.col("c")).alias("f"), "t").first()
    assert (row.f.paper_id, row.f.created_at) == ("p1", row.t)


def fused(spark, keyword, semantic):
    schema = "query_id int, paper_id string, position int"
    lists = [spark.createDataFrame([(1, p, i + 1) for i, p in enumerate(names)], schema) for names in (keyword, semantic)]
    return fusion.fuse(*lists).orderBy("position").collect()


def test_fusion(spark):
    assert fused(spark, [], []) == []
    only = fused(spark, ["a", "b"], [])
    assert [r.paper_id for r in only] == ["a", "b"] and only[0].relevance_score == 1.0 and only[0].fused_score == pytest.approx(1 / 61)
    both = fused(spark, ["a", "b"], ["c", "b"])
    assert both[0].paper_id == "b" and both[0].fused_score == pytest.approx(2 / 62)
    assert [(r.paper_id, r.dominant_mode) for r in both] == [("b", "semantic"), ("a", "keyword"), ("c", "semantic")]


def gate(spark, papers, issues):
    p = spark.createDataFrame(papers, "paper_id int, department_code string, year int, status string")
    i = spark.createDataFrame(issues, "paper_id int, severity string, resolved_at string")
    rows = reports.compliance_gate(p, i).filter("department_code = 'CSE' AND academic_year = '2023-2024'").collect()
    return rows[0] if rows else None


@pytest.mark.parametrize(
    ("extra", "issues", "passed", "text"),
    [
        ([], [], True, None),
        ([], [(1, "error", None)], False, "1 unresolved validation error(s) in scope for CSE 2023-2024."),
        ([], [(1, "error", "2024-01-01")], True, None),
        ([], [(1, "warning", None)], True, None),
        ([(2, "CSE", 2024, "PENDING_REVIEW"), (3, "CSE", 2023, "DRAFT")], [], False, "2 paper(s) still PENDING_REVIEW/DRAFT in scope for CSE 2023-2024."),
        ([(2, "CSE", 2024, "REJECTED")], [], True, None),
        ([(2, "CSE", 2022, "DRAFT")], [], True, None),
        ([(2, "ECE", 2023, "DRAFT")], [(2, "error", None)], True, None),
        ([(2, "CSE", 2024, "DRAFT")], [(1, "error", None), (1, "error", None)], False, "2 unresolved validation error(s) and 1 paper(s) still PENDING_REVIEW/DRAFT in scope for CSE 2023-2024."),
    ],
)
def test_gate(spark, extra, issues, passed, text):
    row = gate(spark, [(1, "CSE", 2023, "PUBLISHED"), *extra], issues)
    assert row.passed is passed
    assert row.error_message == (None if text is None else f"Cannot generate report: {text}")


def test_policy(spark):
    rows = [(1, "CSE", "PUBLISHED", "u1"), (2, "CSE", "DRAFT", "u1"), (3, "CSE", "DRAFT", "u2"), (4, "ECE", "PUBLISHED", "u3"), (5, "CSE", "REJECTED", "u2")]
    papers = spark.createDataFrame(rows, "paper_id int, department_code string, status string, faculty_id string")
    child = papers.select("paper_id")

    def seen(ctx):
        ids = sorted(r.paper_id for r in access.read_papers(papers, ctx).collect())
        assert ids == sorted(r.paper_id for r in access.read_children(child, papers, ctx).collect())
        return ids

    assert seen(access.AccessContext("CSE", "faculty", "u1")) == [1, 2, 5]
    assert seen(access.AccessContext("CSE", "admin", "root")) == [1, 2, 3, 4, 5]
    assert seen(None) == []
    for bad in (("", "faculty", "u"), ("CSE", "boss", "u"), ("CSE", "faculty", "")):
        with pytest.raises(ValueError):
            access.AccessContext(*bad)


def test_academic_year(spark):
    df = spark.createDataFrame([("2023-2024",), ("2023-2025",), ("2024-2023",), ("2023",), ("23-24",)], "academic_year string")
    assert [len(r[0]) for r in df.select(violations(reports.academic_year_rules())).collect()] == [0, 1, 1, 1, 1]


def test_text_helpers(spark):
    assert one(spark, capitalise, "book_chapter", "") == ["Book_chapter", ""]
    assert one(spark, html_escape, "<a href=\"x\">R&D's</a>") == ["&lt;a href=&#34;x&#34;&gt;R&amp;D&#39;s&lt;/a&gt;"]
    assert [tuple(r) for r in one(spark, split_storage_uri, "s3://b/k/x.pdf", "http://x")] == [("b", "k/x.pdf"), (None, None)]


def test_checksum(spark):
    empty = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"
    files = spark.createDataFrame([("a", bytearray(b"")), ("b", bytearray(b"x")), ("c", bytearray(b""))], "report_id string, content binary")
    recorded = spark.createDataFrame([("a", empty), ("b", empty), ("c", empty.upper()), ("d", empty)], "report_id string, checksum_sha256 string")
    out = {r.report_id: r.event_type for r in reports.verify_checksums(files, recorded, F.current_timestamp()).collect()}
    assert out == {"a": "VERIFIED", "b": "MISMATCH", "c": "MISMATCH", "d": "MISMATCH"}


def test_report_hash_ignores_order_and_sees_changes(spark):
    rows = [(i, "CSE", 2023, "PUBLISHED", f"t{i}", None, None, "journal", "0.50", "a@x") for i in range(50)]
    schema = "paper_id int, department_code string, year int, status string, title string, venue string, doi string, paper_type string, overall_confidence string, faculty_email string"

    def digest(data):
        df = spark.createDataFrame(data, schema).withColumn("overall_confidence", F.col("overall_confidence").cast("decimal(3,2)"))
        return {r.checksum_sha256 for r in reports.summaries(df).collect()}

    changed = [*rows[:-1], (*rows[-1][:4], "other", *rows[-1][5:])]
    assert digest(rows) == digest(rows[::-1]) and len(digest(rows)) == 1
    assert digest(rows) != digest(changed)


def test_report_hash_sees_authors_copies_and_splits(spark):
    schema = "paper_id int, department_code string, year int, status string, title string, venue string, doi string, paper_type string, overall_confidence decimal(3,2), faculty_email string, authors array<struct<name:string>>"
    from decimal import Decimal

    def roots(names, copies=1):
        rows = [(i, "CSE", 2023, "PUBLISHED", f"t{i}", None, None, "journal", Decimal("0.50"), "a@x", [(n,) for n in names]) for i in range(30)]
        df = spark.createDataFrame(rows + rows[:1] * (copies - 1), schema)
        found = {reports.summaries(part).agg(F.min("checksum_sha256")).first()[0] for part in (df.repartition(1), df.repartition(7))}
        assert len(found) == 1
        return found.pop()

    assert len({roots(["A", "B"]), roots(["B", "A"]), roots(["A"]), roots(["A", "B"], 2), roots(["A", "B"], 3)}) == 5


def test_an_address_belongs_to_one_user(spark):
    from paperloom.operators import store

    users = spark.createDataFrame([("u1", "a@x", "A", "faculty", "CSE", True), ("u2", None, "B", "hod", "ECE", False)], "user_id string, email string, name string, role string, department_code string, is_active boolean")
    changes = [
        ("u9", "provision", "a@x", 1, 1), ("u8", "provision", "b@x", 5, 1), ("u7", "provision", "b@x", 4, 9), ("u7", "provision", "b@x", 6, 1), ("u1", "provision", "a@x", 7, 1),
        ("u6", "provision", "c@x", 3, 3), ("u5", "provision", "c@x", 3, 2), ("u4", "provision", None, 1, 1), ("u1", "deactivate", None, 8, 1), ("u3", "provision", "a@x", 9, 1),
    ]
    df = spark.createDataFrame([(u, op, e, None, "faculty", None, t, q) for u, op, e, t, q in changes], "user_id string, op string, email string, name string, role string, department_code string, changed_at int, change_seq int")
    judged = store.judge_email_claims(users, df)
    assert judged.count() == len(changes)
    assert {(r.user_id, r.email_owner) for r in judged.filter("rejected = 'EMAIL_TAKEN'").collect()} == {("u9", "u1"), ("u8", "u7"), ("u6", "u5"), ("u3", "u1")}
    after = store.apply_user_changes(users, judged.filter("rejected is null"))
    assert {(r.user_id, r.email) for r in after.collect()} == {("u1", "a@x"), ("u2", None), ("u7", "b@x"), ("u5", "c@x"), ("u4", None)}


def test_stemmer(spark):
    df = spark.createDataFrame(list(CASES.items()), "term string, want string")
    assert stem(df).filter("term <> want").collect() == []


def test_stemmed_search(spark):
    papers = spark.createDataFrame(
        [(1, "Neural networks for learning", None), (2, "A network that learned", "Journal of Learning"), (3, "Nothing at all", None), (4, "Dying stars", "Sky")],
        "paper_id int, title string, venue string",
    ).withColumn("status", F.lit("PUBLISHED"))
    asked = [(1, "network learning"), (2, "die"), (3, '"networks for learn"'), (4, "nothing or skies"), (5, "learns -journal")]
    found = text_search.keyword_search(papers, spark.createDataFrame(asked, "query_id int, query_text string"))
    got = {}
    for r in found.collect():
        got.setdefault(r.query_id, set()).add(r.paper_id)
    # a stop word inside a phrase keeps its place, whatever word stands there
    assert got == {1: {1, 2}, 2: {4}, 3: {1, 2}, 4: {3, 4}, 5: {1}}


def test_index_and_scan_agree(spark):
    papers = spark.createDataFrame([(i, f"alpha beta gamma {i}", "delta journal") for i in range(20)], "paper_id int, title string, venue string").withColumn("status", F.lit("PUBLISHED"))
    queries = spark.createDataFrame([(1, "alpha journals"), (2, '"beta gamma"')], "query_id int, query_text string")
    key = ["query_id", "paper_id", "rank"]
    scan = text_search.keyword_search(papers, queries).select(*key).collect()
    index = text_search.keyword_search(papers, queries, index=text_search.postings(papers)).select(*key).collect()
    assert sorted(scan) == sorted(index) and len(scan) == 40


def test_many_authors_and_long_keys_stay_whole(spark):
    people = [f"Author Number{k}" for k in range(12)]
    rows = spark.createDataFrame([([("PERSON", n) for n in people] + [("ORG", "Journal of " + "x" * 400)],)], "e array<struct<label:string,text:string>>")
    got = rows.select(extract.pick_authors(F.col("e")).alias("a"), extract.pick_authors(F.col("e"), 8).alias("few"), extract.pick_venue(F.col("e")).alias("v")).first()
    assert got.a == [n for n in people] and len(got.few) == 8 and len(got.v) == 411
    same = "k" * 64
    keys = one(spark, key_width_64, same, same + "a", same + "b", "short", None)
    assert keys[0] == same and len(set(keys)) == 5 and {len(k) for k in keys if k} == {64} and keys[3] == "short" + "0" * 59 and keys[4] is None
