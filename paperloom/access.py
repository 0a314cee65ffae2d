"""Row-level access. Every read takes an explicit context; no context means no rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.schemas import ACCESS_ROLES, FINALISED_OR_IN_REVIEW, REPORT_ROLES, ROLE_PERMISSIONS


@dataclass(frozen=True)
class AccessContext:
    department_code: str
    role: str
    user_id: str
    actor_type: str = "user"
    change_reason: str | None = None
    trace_id: str | None = None

    def __post_init__(self) -> None:
        for name in ("department_code", "role", "user_id"):
            if not getattr(self, name):
                raise ValueError(f"access context needs {name}")
        if self.role not in ACCESS_ROLES:
            raise ValueError(f"unknown role {self.role!r}")

    @property
    def is_admin(self) -> bool:
        return self.role == "admin"


def paper_policy(ctx: AccessContext | None) -> Column:
    """Admin sees all; others their department's rows, of the drafts only their own."""
    if ctx is None:
        return F.lit(False)
    if ctx.is_admin:
        return F.lit(True)
    own_draft = (F.col("status") == "DRAFT") & (F.col("faculty_id").cast("string") == ctx.user_id)
    return (F.col("department_code") == ctx.department_code) & (F.col("status").isin(*FINALISED_OR_IN_REVIEW) | own_draft)


def read_papers(papers: DataFrame, ctx: AccessContext | None) -> DataFrame:
    return papers.filter(paper_policy(ctx))


def read_children(children: DataFrame, papers: DataFrame, ctx: AccessContext | None) -> DataFrame:
    """Versions or issues of visible papers. A semi join on the paper id; adaptive execution splits a paper with very many
    children, and the visible side carries nothing but ids."""
    if ctx is not None and ctx.is_admin:
        return children.join(papers.select("paper_id"), "paper_id", "left_semi")
    return children.join(read_papers(papers, ctx).select("paper_id"), "paper_id", "left_semi")


def read_users(users: DataFrame, ctx: AccessContext | None) -> DataFrame:
    """Own department, or everything for an admin, or oneself."""
    if ctx is None:
        return users.filter(F.lit(False))
    if ctx.is_admin:
        return users
    return users.filter((F.col("department_code") == ctx.department_code) | (F.col("user_id") == ctx.user_id))


def list_users(users: DataFrame, ctx: AccessContext | None) -> DataFrame:
    return read_users(users, ctx).orderBy(F.desc("created_at"), F.asc("user_id"))


def read_reports(reports: DataFrame, ctx: AccessContext | None) -> DataFrame:
    if ctx is None:
        return reports.filter(F.lit(False))
    return reports if ctx.is_admin else reports.filter(F.col("department_code") == ctx.department_code)


def report_permitted() -> Column:
    """For a requests table (`report_type`, `role`, `requester_faculty_id`, `faculty_id`): may this request run?

    Department reports need coordinator, hod or admin. Faculty profiles need one of those, or are for oneself.
    """
    privileged = F.col("role").isin(*REPORT_ROLES)
    own = (F.col("role") == "faculty") & F.col("faculty_id").isNotNull() & (
        F.col("requester_faculty_id") == F.col("faculty_id")
    )
    allowed = F.when(F.col("report_type") == "NAAC_CRITERIA_III", privileged).when(
        F.col("report_type") == "FACULTY_PROFILE", privileged | own
    )
    return F.coalesce(allowed, F.lit(False))


def entitlements(users: DataFrame) -> DataFrame:
    """One row per user and permission of its role. The lookup has a fixed 35 rows, hence the broadcast."""
    rows = [(role, p) for role, permissions in ROLE_PERMISSIONS.items() for p in permissions]
    table = users.sparkSession.createDataFrame(rows, "role string, permission string")
    return users.join(F.broadcast(table), "role").select("user_id", "role", "permission")
