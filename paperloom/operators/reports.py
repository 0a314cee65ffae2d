"""Compliance gate and report jobs, for all (department, academic year) requests at once.

Papers and issues are first reduced per (department, year). Only those small tables are expanded to the two academic years
each calendar year belongs to, so the expansion never touches paper rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.functions.columns import capitalise, html_escape, sha256, stable_id
from paperloom.functions.rules import Rule
from paperloom.schemas import OPEN_STATUSES

# Column headings, markers and key layout of reports.
REPORT_COLUMNS = ["Title", "Authors", "Venue", "Year", "DOI", "Type", "Confidence", "Faculty Email"]
EMPTY_CELL = "—"
REPORT_PREFIX = {"NAAC_CRITERIA_III": "criteria_iii", "FACULTY_PROFILE": "faculty_profile"}
PERSONAL = "FACULTY_PROFILE"
NO_FACULTY = "a faculty profile needs a faculty_id"
HASH_LEVELS = (6, 3, 0)
"""Hex digits of the row digests that name a leaf, a branch and the root of a report's hash tree."""


def academic_year_rules() -> list[Rule]:
    c = F.col("academic_year")
    start, end = F.split_part(c, F.lit("-"), F.lit(1)), F.split_part(c, F.lit("-"), F.lit(2))
    shaped = c.rlike(r"^\d{4}-\d{4}$")
    consecutive = F.when(shaped, end.cast("int") == start.cast("int") + 1).otherwise(F.lit(False))
    return [("academic_year", ~consecutive, "academic year must be YYYY-YYYY with consecutive years")]


def year_bounds(academic_year: Column) -> Column:
    """struct<year_start, year_end>, both inclusive."""
    return F.struct(
        F.split_part(academic_year, F.lit("-"), F.lit(1)).cast("int").alias("year_start"),
        F.split_part(academic_year, F.lit("-"), F.lit(2)).cast("int").alias("year_end"),
    )


def academic_years_of(year: Column) -> Column:
    """First years of the two academic years a calendar year belongs to."""
    return F.array(year - 1, year)


def unresolved_errors(issues: DataFrame) -> DataFrame:
    """Open error counts per paper; reducing before the join keeps a paper with very many issues from skewing it."""
    open_errors = issues.filter((F.col("severity") == "error") & F.col("resolved_at").isNull())
    return open_errors.groupBy("paper_id").agg(F.count("*").alias("open_errors"))


def gate_counts(papers: DataFrame, issues: DataFrame) -> DataFrame:
    """(department_code, year_start, error_count, pending_count) for every department and academic year with papers."""
    scope = papers.select("paper_id", "department_code", "year", "status")
    per_year = (
        scope.join(unresolved_errors(issues), "paper_id", "left").groupBy("department_code", "year")
        .agg(
            F.coalesce(F.sum("open_errors"), F.lit(0)).alias("error_count"),
            F.count_if(F.col("status").isin(*OPEN_STATUSES)).alias("pending_count"),
        )
    )
    return (
        per_year.withColumn("year_start", F.explode(academic_years_of(F.col("year"))))
        .groupBy("department_code", "year_start")
        .agg(F.sum("error_count").alias("error_count"), F.sum("pending_count").alias("pending_count"))
    )


def academic_label() -> Column:
    return F.concat(F.col("year_start").cast("string"), F.lit("-"), (F.col("year_start") + 1).cast("string"))


def with_verdict(counts: DataFrame) -> DataFrame:
    """Add `passed` and the refusal text. Rejected papers never block."""
    errors, pending = F.col("error_count"), F.col("pending_count")
    parts = F.concat_ws(
        " and ",
        F.when(errors > 0, F.concat(errors.cast("string"), F.lit(" unresolved validation error(s)"))),
        F.when(pending > 0, F.concat(pending.cast("string"), F.lit(" paper(s) still PENDING_REVIEW/DRAFT"))),
    )
    text = F.concat(
        F.lit("Cannot generate report: "), parts, F.lit(" in scope for "), F.col("department_code"), F.lit(" "),
        academic_label(), F.lit("."),
    )
    passed = (errors == 0) & (pending == 0)
    return counts.withColumn("passed", passed).withColumn("error_message", F.when(~passed, text))


def compliance_gate(papers: DataFrame, issues: DataFrame) -> DataFrame:
    return with_verdict(gate_counts(papers, issues)).withColumn("academic_year", academic_label())


def published_in(papers: DataFrame, department_code: str, year_start: int, year_end: int, faculty_id=None) -> DataFrame:
    """Rows of one report in report order: newest year first, then title."""
    rows = papers.filter(
        (F.col("department_code") == department_code) & F.col("year").between(year_start, year_end)
        & (F.col("status") == "PUBLISHED")
    )
    if faculty_id is not None:
        rows = rows.filter(F.col("faculty_id") == faculty_id)
    return rows.orderBy(F.desc("year"), F.asc("title"), F.asc("paper_id"))


def author_names(authors: Column) -> Column:
    return F.array_join(F.transform(authors, lambda a: F.coalesce(a["name"], F.lit("Unknown"))), ", ")


def report_cells(fmt: str = "xlsx") -> list[Column]:
    """The eight report columns. Spreadsheet cells are plain, page cells carry page formatting."""
    page = fmt != "xlsx"
    blank = F.lit(EMPTY_CELL if page else "")
    kind = capitalise(F.col("paper_type")) if page else F.col("paper_type")
    confidence = F.format_string("%.2f", F.col("overall_confidence").cast("double"))
    return [
        F.col("title").alias("Title"), author_names(F.col("authors")).alias("Authors"),
        F.coalesce(F.nullif(F.col("venue"), F.lit("")), blank).alias("Venue"), F.col("year").alias("Year"),
        F.coalesce(F.nullif(F.col("doi"), F.lit("")), blank).alias("DOI"), kind.alias("Type"),
        (confidence if page else F.col("overall_confidence").cast("double")).alias("Confidence"),
        (F.split_part("faculty_email", F.lit("@"), F.lit(1)) if page else F.col("faculty_email")).alias("Faculty Email"),
    ]


SUMMED = ("total_papers", "journal_count", "conference_count", "confidence_sum")


def _published_by_year(papers: DataFrame, keys: list[str]) -> DataFrame:
    """Published papers reduced per key and calendar year, with `root`, the root of a hash tree over the reported rows.

    Rows become SHA-256 digests (authors too, where `papers` has them); equal ones are counted. Digests with the same first six digits
    are a leaf, leaves with the same first three a branch, so that a node has 4,096 children at most and a leaf a 16-millionth of
    the rows. A node is the hash of its children's lines in order. Any row order gives the same root, and no other rows do.
    """
    names = author_names(F.col("authors")) if "authors" in papers.columns else F.lit(None).cast("string")
    digest = sha256(F.to_json(F.struct(
        F.col("paper_id").cast("string").alias("paper_id"), "title", "venue", F.col("year").cast("int").alias("year"), "doi",
        "paper_type", F.col("overall_confidence").cast("decimal(3,2)").cast("string").alias("overall_confidence"), "faculty_email",
        names.alias("authors"),
    ), {"ignoreNullFields": "false"}))
    by, sums = [*keys, "year"], [F.sum(n).alias(n) for n in SUMMED]
    level = (
        papers.filter(F.col("status") == "PUBLISHED").withColumn("node", digest).groupBy(*by, "node")
        .agg(
            F.count("*").alias("total_papers"), F.count_if(F.col("paper_type") == "journal").alias("journal_count"),
            F.count_if(F.col("paper_type") == "conference").alias("conference_count"),
            F.sum(F.col("overall_confidence").cast("decimal(18,2)")).alias("confidence_sum"),
        )
        .withColumn("line", F.concat_ws(" ", "node", F.col("total_papers").cast("string")))
    )
    for digits in HASH_LEVELS:
        level = level.withColumn("node", F.substring("node", 1, digits)).groupBy(*by, "node").agg(
            *sums, sha256(F.array_join(F.sort_array(F.collect_list("line")), "\n")).alias("root")
        ).withColumn("line", F.concat_ws(" ", "node", "root"))
    return level.drop("node", "line")


def summaries(papers: DataFrame, keys: list[str] = ["department_code"]) -> DataFrame:  # noqa: B006
    """Totals, mean confidence and content hash per key and academic year.

    The hash is that of the roots of the report's two calendar years, in order; no report is ever collected to be hashed.
    """
    per_report = (
        _published_by_year(papers, keys).withColumn("year_start", F.explode(academic_years_of(F.col("year"))))
        .groupBy(*keys, "year_start").agg(*[F.sum(n).alias(n) for n in SUMMED], F.sort_array(F.collect_list(F.struct("year", "root"))).alias("years"))
    )
    content = F.array_join(F.transform("years", lambda y: F.concat_ws(" ", y["year"].cast("string"), y["root"])), "\n")
    mean = F.coalesce(F.round(F.col("confidence_sum").cast("double") / F.col("total_papers"), 3), F.lit(0.0))
    return per_report.select(
        *keys, "year_start", academic_label().alias("academic_year"), "total_papers", "journal_count", "conference_count",
        mean.alias("avg_confidence"), sha256(content).alias("checksum_sha256"),
    )


EMPTY_REPORT_CONTENT = ""


def faculty_requests(papers: DataFrame) -> DataFrame:
    """A profile request for every faculty member and academic year that has papers."""
    own = papers.filter(F.col("faculty_id").isNotNull()).select("department_code", "faculty_id", "year").distinct()
    expanded = own.select("department_code", "faculty_id", F.explode(academic_years_of(F.col("year"))).alias("year_start")).distinct()
    return expanded.select(
        stable_id(F.lit(PERSONAL), F.col("department_code"), F.col("faculty_id"), F.col("year_start")).alias("report_id"),
        F.lit(PERSONAL).alias("report_type"), "department_code", "faculty_id", "year_start", academic_label().alias("academic_year"),
    )


def department_requests(papers: DataFrame, report_type: str = "NAAC_CRITERIA_III") -> DataFrame:
    """A request for every department and academic year that has papers."""
    pairs = papers.select("department_code", "year").distinct()
    expanded = pairs.select("department_code", F.explode(academic_years_of(F.col("year"))).alias("year_start")).distinct()
    return expanded.select(
        stable_id(F.lit(report_type), F.col("department_code"), F.col("year_start")).alias("report_id"),
        F.lit(report_type).alias("report_type"), "department_code", "year_start", academic_label().alias("academic_year"),
    )


def run_reports(
    requests: DataFrame, papers: DataFrame, issues: DataFrame, generated_at: Column, bucket: str = "reports", extension: str = "csv"
) -> DataFrame:
    """Manifest rows for all requests: COMPLETED with totals and content hash, or FAILED with the gate's message.

    A FACULTY_PROFILE request counts the papers of its own `faculty_id` in its department and years (a request without one
    fails), every other type those of the department. The gate looks at the department either way. `content_sha256` is a hash of the
    reported rows, not of a file; the files' own checksums come from `sinks.report_parts` once they are written.
    """
    keys = ["department_code", "year_start"]
    if "faculty_id" not in requests.columns:
        requests = requests.withColumn("faculty_id", F.lit(None).cast(papers.schema["faculty_id"].dataType))
    gate = with_verdict(gate_counts(papers, issues)).select(*keys, "passed", "error_message")
    judged = requests.join(gate, keys, "left")
    personal = F.col("report_type") == PERSONAL
    of_faculty = judged.filter(personal).join(summaries(papers, ["department_code", "faculty_id"]).drop("academic_year"), [*keys, "faculty_id"], "left")
    of_department = judged.filter(~personal).join(summaries(papers).drop("academic_year"), keys, "left")
    joined = of_department.unionByName(of_faculty.select(*of_department.columns))
    nobody = personal & F.col("faculty_id").isNull()
    passed = F.coalesce("passed", F.lit(True)) & ~nobody
    path = F.concat(
        F.lit(f"s3://{bucket}/reports/"), F.col("department_code"), F.lit("/"), F.col("academic_year"), F.lit("/"),
        F.coalesce(*[F.when(F.col("report_type") == t, p) for t, p in REPORT_PREFIX.items()]), F.lit("_"),
        F.coalesce(F.when(personal, F.concat(F.col("faculty_id").cast("string"), F.lit("_"))), F.lit("")),
        F.date_format(generated_at, "yyyyMMdd_HHmmss"), F.lit("." + extension),
    )
    return joined.select(
        "report_id", "report_type", "department_code", "academic_year", "faculty_id",
        F.when(passed, "COMPLETED").otherwise("FAILED").alias("status"),
        F.when(passed, path).alias("s3_uri"),
        F.when(passed, F.coalesce("checksum_sha256", sha256(F.lit(EMPTY_REPORT_CONTENT)))).alias("content_sha256"),
        F.when(passed, F.coalesce("total_papers", F.lit(0))).alias("total_papers"),
        F.when(passed, F.coalesce("journal_count", F.lit(0))).alias("journal_count"),
        F.when(passed, F.coalesce("conference_count", F.lit(0))).alias("conference_count"),
        F.when(nobody, NO_FACULTY).otherwise(F.col("error_message")).alias("error_message"),
    )


def report_rows(papers: DataFrame, manifest: DataFrame, fmt: str = "xlsx") -> DataFrame:
    """Cells of every completed report, keyed by `report_id`.

    A paper is in two department reports (both academic years of its year) and in two profiles of its faculty member. The join
    key is (department, first year), with the faculty member for profiles; the manifest side has one row per report.
    """
    done = manifest.filter(F.col("status") == "COMPLETED").select(
        "report_id", "report_type", "department_code", F.split_part("academic_year", F.lit("-"), F.lit(1)).cast("int").alias("year_start"),
        "academic_year", F.col("faculty_id").alias("report_faculty"),
    )
    rows = papers.filter(F.col("status") == "PUBLISHED").withColumn("year_start", F.explode(academic_years_of(F.col("year"))))
    personal, keys = F.col("report_type") == PERSONAL, ["department_code", "year_start"]
    of_department = rows.join(done.filter(~personal).drop("report_faculty"), keys)
    of_faculty = rows.join(done.filter(personal).withColumnRenamed("report_faculty", "faculty_id"), [*keys, "faculty_id"])
    shown = ["report_id", "department_code", "academic_year", "paper_id", *report_cells(fmt)]
    return of_department.select(*shown).unionByName(of_faculty.select(*shown))


def html_lines(cells: DataFrame) -> DataFrame:
    """Report cells as escaped table-row lines: (report_id, department_code, academic_year, paper_id, Year, Title, line)."""
    escaped = [html_escape(F.col(f"`{c}`").cast("string")) for c in REPORT_COLUMNS]
    tagged = [F.concat(F.lit("<td>"), c, F.lit("</td>")) for c in escaped]
    line = F.concat(F.lit("<tr>"), *tagged, F.lit("</tr>"))
    return cells.select("report_id", "department_code", "academic_year", "paper_id", "Year", "Title", line.alias("line"))


def checksum_events(files: DataFrame, recorded_at: Column) -> DataFrame:
    """GENERATED rows for written files (`report_id`, `checksum_sha256`), as `sinks.report_checksums` gives them."""
    return files.select(
        stable_id(F.lit("checksum"), F.col("report_id"), F.lit("GENERATED")).alias("checksum_id"), "report_id", "checksum_sha256",
        F.lit("GENERATED").alias("event_type"), recorded_at.alias("recorded_at"),
    )


def verify_checksums(files: DataFrame, recorded: DataFrame, recorded_at: Column) -> DataFrame:
    """Compare file bytes with recorded hashes (case-sensitive): VERIFIED or MISMATCH; a missing file is a mismatch.

    `files` has `report_id` and `content`; only the 64-character digest of a file enters the join.
    """
    hashed = files.select("report_id", sha256(F.col("content")).alias("actual"))
    joined = recorded.select("report_id", "checksum_sha256").join(hashed, "report_id", "left")
    ok = F.coalesce(F.col("actual") == F.col("checksum_sha256"), F.lit(False))
    event = F.when(ok, "VERIFIED").otherwise("MISMATCH")
    return joined.select(
        stable_id(F.lit("checksum"), F.col("report_id"), event, recorded_at).alias("checksum_id"), "report_id", "checksum_sha256",
        event.alias("event_type"), recorded_at.alias("recorded_at"),
    )


def lifecycle_events(requests: DataFrame, manifest: DataFrame, requested_at: Column, finished_at: Column) -> DataFrame:
    """Append-only status events of every report: PENDING, GENERATING, then COMPLETED or FAILED."""
    def of(df: DataFrame, status: Column, seq: int, at: Column, message: Column) -> DataFrame:
        return df.select("report_id", F.lit(seq).alias("event_seq"), status.alias("status"), at.alias("event_at"), message.alias("error_message"))

    none = F.lit(None).cast("string")
    return (
        of(requests, F.lit("PENDING"), 1, requested_at, none)
        .unionByName(of(requests, F.lit("GENERATING"), 2, requested_at, none))
        .unionByName(of(manifest, F.col("status"), 3, finished_at, F.col("error_message")))
    )
