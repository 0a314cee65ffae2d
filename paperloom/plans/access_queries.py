"""Row policies, authorisation, directory lookups and entitlements."""

from __future__ import annotations

from pyspark.sql import functions as F

from paperloom import access
from paperloom.operators import facets, routing
from paperloom.plans import derived as d
from paperloom.plans.catalog import query
from paperloom.plans.derived_sql import sql

CTX = access.AccessContext(department_code="CSE", role="faculty", user_id="21")
_VISIBLE = "department_code = 'CSE' AND (status <> 'DRAFT' OR faculty_id = 21)"


@query("papers_visible", sql(f"SELECT paper_id, status, department_code FROM papers WHERE {_VISIBLE}", "papers"))
def papers_visible(spark, sf):
    return access.read_papers(d.papers(spark, sf), CTX).select("paper_id", "status", "department_code")


@query("issues_visible", sql(f"""
    SELECT issue_id, paper_id, severity FROM issues WHERE paper_id IN (SELECT paper_id FROM papers WHERE {_VISIBLE})""", "papers", "issues"))
def issues_visible(spark, sf):
    return access.read_children(d.issues(spark, sf), d.papers(spark, sf), CTX).select("issue_id", "paper_id", "severity")


@query("versions_visible", sql(f"""
    SELECT change_seq, paper_id FROM changes WHERE paper_id IN (SELECT paper_id FROM papers WHERE {_VISIBLE})""", "papers", "changes"))
def versions_visible(spark, sf):
    return access.read_children(d.paper_changes(spark, sf), d.papers(spark, sf), CTX).select("change_seq", "paper_id")


@query("users_visible", sql("SELECT user_id, department_code, role FROM users WHERE department_code = 'CSE' OR user_id = 'user_1'", "users"))
def users_visible(spark, sf):
    ctx = access.AccessContext("CSE", "hod", "user_1")
    return access.read_users(d.users(spark, sf), ctx).select("user_id", "department_code", "role")


@query("users_list", """
    SELECT concat('user_', o_custkey) AS user_id, department_code, strftime(min(o_orderdate), '%Y-%m-%d') AS created_on FROM orders
    JOIN (SELECT c_custkey, CASE c_nationkey % 4 WHEN 0 THEN 'CSE' WHEN 1 THEN 'ECE' WHEN 2 THEN 'MECH' ELSE 'CIVIL' END AS department_code FROM customer) ON c_custkey = o_custkey
    WHERE department_code = 'ECE' GROUP BY ALL""")
def users_list(spark, sf):
    first_seen = d.table(spark, sf, "orders").groupBy(F.concat(F.lit("user_"), F.col("o_custkey").cast("string")).alias("user_id")).agg(F.min("o_orderdate").alias("created_at"))
    users = d.users(spark, sf).join(first_seen, "user_id")
    ctx = access.AccessContext("ECE", "hod", "nobody")
    return access.list_users(users, ctx).select("user_id", "department_code", F.date_format("created_at", "yyyy-MM-dd").alias("created_on"))


_REQUESTS = """
    SELECT o_orderkey AS request_id, CASE WHEN o_orderkey % 2 = 0 THEN 'NAAC_CRITERIA_III' ELSE 'FACULTY_PROFILE' END AS report_type,
      u.role, u.department_code, u.faculty_id AS requester_faculty_id, CASE WHEN o_orderkey % 3 = 0 THEN o_custkey WHEN o_orderkey % 3 = 1 THEN o_custkey + 1 END AS faculty_id
    FROM orders JOIN users u ON u.faculty_id = o_custkey"""


def report_requests(spark, sf):
    """Report requests: every order asks for a report in its customer's name."""
    k = F.col("o_orderkey")
    requester = d.users(spark, sf).select("role", "department_code", F.col("faculty_id").alias("requester_faculty_id"))
    return d.table(spark, sf, "orders").join(requester, F.col("o_custkey") == F.col("requester_faculty_id")).select(
        k.alias("request_id"), F.when(k % 2 == 0, "NAAC_CRITERIA_III").otherwise("FACULTY_PROFILE").alias("report_type"), "role",
        "department_code", "requester_faculty_id",
        F.when(k % 3 == 0, F.col("o_custkey")).when(k % 3 == 1, F.col("o_custkey") + 1).alias("faculty_id"),
    )


@query("report_authz", sql("""
    SELECT request_id, report_type, role, CASE WHEN role IN ('coordinator', 'hod', 'admin') THEN true
      WHEN report_type = 'FACULTY_PROFILE' AND role = 'faculty' THEN coalesce(requester_faculty_id = faculty_id, false) ELSE false END AS allowed
    FROM requests""", "users", requests=_REQUESTS))
def report_authz(spark, sf):
    return report_requests(spark, sf).select("request_id", "report_type", "role", access.report_permitted().alias("allowed"))


@query("reports_visible", sql("SELECT request_id, department_code FROM requests WHERE department_code = 'MECH'", "users", requests=_REQUESTS))
def reports_visible(spark, sf):
    ctx = access.AccessContext("MECH", "coordinator", "user_7")
    return access.read_reports(report_requests(spark, sf), ctx).select("request_id", "department_code")


_PERMISSIONS = ", ".join(f"('{role}', '{p}')" for role, ps in access.ROLE_PERMISSIONS.items() for p in ps)


@query("entitlements", sql(f"SELECT user_id, role, permission FROM users JOIN (VALUES {_PERMISSIONS}) t(role, permission) USING (role)", "users"))
def entitlements(spark, sf):
    return access.entitlements(d.users(spark, sf))


@query("directory_enrich", sql("""
    SELECT msg_seq, key AS lookup_key, coalesce(CAST(u.faculty_id AS VARCHAR), '00000000-0000-0000-0000-000000000000') AS faculty_id, u.name AS faculty_name,
      u.email AS faculty_email, u.department_code, CASE WHEN u.user_id IS NULL THEN 'not_found' WHEN u.is_active THEN 'active' ELSE 'inactive' END AS faculty_status
    FROM (SELECT msg_seq, CASE msg_seq % 4 WHEN 0 THEN concat('user_', msg_seq) WHEN 1 THEN address WHEN 2 THEN split_part(address, '@', 1) ELSE split_part(sender, '@', 1) END AS key FROM messages) m
    LEFT JOIN users u ON u.user_id = key OR u.email = key OR split_part(u.email, '@', 1) = key""", "messages", "users"))
def directory_enrich(spark, sf):
    from paperloom.operators.intake import sender_address

    i = F.col("msg_seq")
    address = F.concat(F.lit("customer."), F.lpad((i % 60).cast("string"), 9, "0"), F.lit("@" + d.DOMAIN))
    key = F.when(i % 4 == 0, F.concat(F.lit("user_"), i.cast("string"))).when(i % 4 == 1, address).when(i % 4 == 2, routing.lookup_key(sender_address(address))).otherwise(routing.lookup_key(F.col("sender")))
    looked_up = d.messages(spark, sf).select("msg_seq", key.alias("lookup_key"))
    return routing.enrich(looked_up, d.users(spark, sf)).select("msg_seq", "lookup_key", "faculty_id", "faculty_name", "faculty_email", "department_code", "faculty_status")


@query("batch_lookup", sql("SELECT paper_id, title, status FROM papers WHERE paper_id IN (SELECT user_id FROM events)", "papers"))
def batch_lookup(spark, sf):
    wanted = d.table(spark, sf, "events").select(F.col("user_id").alias("paper_id"))
    return facets.lookup_by_keys(d.papers(spark, sf), wanted, "paper_id").select("paper_id", "title", "status")
