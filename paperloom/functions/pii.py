"""Redaction of outside e-mail addresses, student ids and phone numbers."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.settings import DEFAULTS, Settings

# Patterns and replacement tokens.
PHONE = r"\b(?:\+91[-\s]?)?[0]?(?:\d{2,3}[-\s]?\d{3,4}[-\s]?\d{4})\b"
PHONE_WITH_PREFIX = r"(?<![\w+])(?:\+91[-\s]?)?[0]?(?:\d{2,3}[-\s]?\d{3,4}[-\s]?\d{4})\b"
STUDENT_ID = r"\bAP\d{10}\b"
EMAIL_HEAD = r"\b[A-Za-z0-9._%+-]+@"
EMAIL_TAIL = r"[A-Za-z0-9.-]+\.[A-Za-z]{2,}\b"
EMAIL_TOKEN = "[EMAIL_REDACTED]"
STUDENT_ID_TOKEN = "[STUDENT_ID_REDACTED]"
PHONE_TOKEN = "[PHONE_REDACTED]"


def redact(
    df: DataFrame, text: str = "body_text", settings: Settings = DEFAULTS, country_prefix: bool = False
) -> DataFrame:
    """Add `redacted_text`, `email_count`, `student_id_count`, `phone_count`.

    E-mails go first, then ids, then phones, each on the text the step before it left. The published phone pattern leaves
    `+91-` standing; `country_prefix=True` removes it as well. Three native regex passes over the whole text, no Python.
    """
    own = r"(?!" + re.escape(settings.institution_domain) + ")"
    steps = [
        ("email_count", EMAIL_HEAD + own + EMAIL_TAIL, EMAIL_TOKEN),
        ("student_id_count", STUDENT_ID, STUDENT_ID_TOKEN),
        ("phone_count", PHONE_WITH_PREFIX if country_prefix else PHONE, PHONE_TOKEN),
    ]
    out = df.withColumn("redacted_text", F.col(text))
    for count, pattern, token in steps:
        unicode_pattern = "(?U)" + pattern
        out = out.withColumn(
            count, F.coalesce(F.regexp_count("redacted_text", F.lit(unicode_pattern)), F.lit(0)).cast("bigint")
        ).withColumn("redacted_text", F.regexp_replace("redacted_text", unicode_pattern, token))
    return out


def redaction_total():
    return F.col("email_count") + F.col("student_id_count") + F.col("phone_count")
