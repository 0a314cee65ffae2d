"""Intake: domain, redaction, keys, contract, duplicate gate, attachments and mail parsing."""

from __future__ import annotations

from pyspark.sql import functions as F

from paperloom.functions.pii import redact, redaction_total
from paperloom.operators import dedup, intake
from paperloom.plans import derived as d
from paperloom.plans.catalog import query
from paperloom.plans.derived_sql import AS_OF, DOMAIN, shown, sql, strip
from paperloom.settings import DEFAULTS
from paperloom.sources import mail, sinks


@query("sender_domain", sql(f"SELECT msg_seq, sender, ends_with(lower(regexp_replace(sender, '^.*<|>$', '', 'g')), '@{DOMAIN}') AS accepted FROM messages", "messages"))
def sender_domain(spark, sf):
    ok = intake.in_domain(intake.sender_address(F.col("sender")))
    return d.messages(spark, sf).select("msg_seq", "sender", ok.alias("accepted"))


@query("pii_redact", sql("SELECT msg_seq, redacted_text, email_count, student_id_count, phone_count, email_count + student_id_count + phone_count > 0 AS pii_found FROM redacted", "redacted"))
def pii_redact(spark, sf):
    return redact(d.messages(spark, sf)).select(
        "msg_seq", "redacted_text", "email_count", "student_id_count", "phone_count", (redaction_total() > 0).alias("pii_found")
    )


@query("redaction_totals", sql("""
    SELECT CAST(sum(email_count) AS BIGINT) AS emails, CAST(sum(student_id_count) AS BIGINT) AS student_ids, CAST(sum(phone_count) AS BIGINT) AS phones,
      bool_or(email_count + student_id_count + phone_count > 0) AS any_pii FROM redacted""", "redacted"))
def redaction_totals(spark, sf):
    return redact(d.messages(spark, sf)).agg(
        F.sum("email_count").alias("emails"), F.sum("student_id_count").alias("student_ids"), F.sum("phone_count").alias("phones"),
        F.bool_or(redaction_total() > 0).alias("any_pii"),
    )


@query("idempotency_keys", sql("SELECT msg_seq, message_id, sha256(concat(message_id, ':', coalesce(filename, 'no-attachment'))) AS idempotency_key FROM messages", "messages"))
def idempotency_keys(spark, sf):
    name = F.get("attachments", F.lit(0))["filename"]
    return d.messages(spark, sf).select("msg_seq", "message_id", intake.idempotency_key(F.col("message_id"), name).alias("idempotency_key"))


# Stateless outcome of each message, then the duplicate gate over those that remain.
_REFUSED = f"""
    SELECT msg_seq, message_id, received_at, CASE WHEN NOT ends_with(lower(regexp_replace(sender, '^.*<|>$', '', 'g')), '@{DOMAIN}') THEN 'DOMAIN_REJECTED'
      WHEN length({strip('redacted_text')}) < 50 THEN 'BODY_TOO_SHORT'
      WHEN filename IS NOT NULL AND size_bytes <= 52428800 AND checksum = sha256(redacted_text) THEN 'HASH_COLLISION'
      WHEN filename IS NOT NULL AND size_bytes <= 52428800 AND verdict <> 'CLEAN' THEN 'QUARANTINED' END AS refused
    FROM redacted"""
_CHAIN = """
    SELECT message_id, min(received_at) AS accepted_ts FROM refusal WHERE refused IS NULL GROUP BY message_id
    UNION ALL SELECT c.message_id, (SELECT min(r.received_at) FROM refusal r WHERE r.refused IS NULL AND r.message_id = c.message_id AND r.received_at >= c.accepted_ts + INTERVAL 604800 SECOND)
    FROM chain c WHERE c.accepted_ts IS NOT NULL"""
_OUTCOME = """
    SELECT r.msg_seq, coalesce(refused, CASE WHEN c.accepted_ts IS NOT NULL THEN 'INGESTED' ELSE 'DUPLICATE' END) AS disposition
    FROM refusal r LEFT JOIN chain c ON c.message_id = r.message_id AND c.accepted_ts = r.received_at AND r.refused IS NULL"""
_OUTCOME_CTES = {"refusal": _REFUSED, "chain": _CHAIN, "outcome": _OUTCOME}


@query("intake_dispositions", sql("SELECT * FROM outcome", "redacted", recursive=True, **_OUTCOME_CTES))
def intake_dispositions(spark, sf):
    return intake.dispositions(intake.screen(d.messages(spark, sf))).select("msg_seq", "disposition")


@query("intake_summary", sql("SELECT count(*) AS processed, count(*) FILTER (disposition = 'INGESTED') AS successful FROM outcome", "redacted", recursive=True, **_OUTCOME_CTES))
def intake_summary(spark, sf):
    return intake.batch_summary(intake.dispositions(intake.screen(d.messages(spark, sf))))


@query("text_hashes", sql("SELECT msg_seq, sha256(redacted_text) AS raw_text_hash, length(" + strip("redacted_text") + ") AS n_chars FROM redacted", "redacted"))
def text_hashes(spark, sf):
    return intake.screen(d.messages(spark, sf)).select("msg_seq", "raw_text_hash", F.length("raw_text").cast("bigint").alias("n_chars"))


def broken_events(spark, sf):
    """Ingested events of all messages, refused ones included, with contract faults spread over them."""
    events = intake.ingested_events(intake.screen(d.messages(spark, sf)), d.as_of())
    i = F.regexp_extract("email.subject", r"(\d+)", 1).cast("bigint")
    future = F.timestamp_add("MINUTE", F.when(i % 2 == 0, 5).otherwise(6), d.as_of())
    received = F.when(i % 41 == 0, future).otherwise(F.col("email.received_at"))
    return (
        events.withColumn("msg_seq", i)
        .withColumn("contract_version", F.when(i % 17 == 0, "v2").otherwise(F.col("contract_version")))
        .withColumn("pipeline_status", F.when(i % 19 == 0, F.lit(None)).otherwise(F.col("pipeline_status")))
        .withColumn("email", F.col("email").withField("received_at", received))
        .withColumn("processing", F.col("processing").withField("attempts", F.when(i % 23 == 0, F.array(F.lit("{}"))).otherwise(F.col("processing.attempts"))))
        .withColumn("security", F.col("security").withField("pii_redacted", i % 29 != 0).withField("source_domain_verified", i % 31 != 0))
        .withColumn("content", F.col("content").withField("raw_text_hash", F.when((i % 43 == 0) & (F.size("content.attachments") > 0), F.get("content.attachments", F.lit(0))["checksum_sha256"]).otherwise(F.col("content.raw_text_hash"))))
    )


@query("intake_contract", sql(f"""
    SELECT msg_seq, concat_ws(',', CASE WHEN msg_seq % 17 = 0 THEN 'contract_version' END, CASE WHEN msg_seq % 19 = 0 THEN 'pipeline_status' END,
      CASE WHEN NOT ends_with(lower(regexp_replace(sender, '^.*<|>$', '', 'g')), '@{DOMAIN}') THEN 'sender_domain' END,
      CASE WHEN CASE WHEN msg_seq % 41 = 0 THEN {AS_OF} + CASE WHEN msg_seq % 2 = 0 THEN INTERVAL 5 MINUTE ELSE INTERVAL 6 MINUTE END ELSE received_at END > {AS_OF} + INTERVAL 300 SECOND THEN 'received_at' END,
      CASE WHEN length({strip('redacted_text')}) < 50 THEN 'raw_text' END, CASE WHEN msg_seq % 23 = 0 THEN 'attempts' END, CASE WHEN msg_seq % 29 = 0 THEN 'pii_redacted' END,
      CASE WHEN msg_seq % 31 = 0 THEN 'source_domain_verified' END, CASE WHEN msg_seq % 43 = 0 AND filename IS NOT NULL AND size_bytes <= 52428800 THEN 'hash_separation' END) AS broken
    FROM redacted""", "redacted"))
def intake_contract(spark, sf):
    checked = intake.check_contract(broken_events(spark, sf), d.as_of())
    return checked.select("msg_seq", F.array_join(F.transform("violations", lambda v: v.rule), ",").alias("broken"))


@query("attachment_layout", sql(f"""
    SELECT msg_seq, filename, concat('attachments/', strftime(received_at, '%Y/%m/%d'), '/', substr(sha256(concat(message_id, ':', filename)), 1, 8), '/', filename) AS s3_key
    FROM messages WHERE filename IS NOT NULL AND size_bytes <= 52428800""", "messages"))
def attachment_layout(spark, sf):
    screened = intake.screen(d.messages(spark, sf))
    rows = sinks.attachment_paths(screened.withColumn("message_id", F.col("msg_seq").cast("string")))
    return rows.select(F.col("message_id").cast("bigint").alias("msg_seq"), "filename", "s3_key")


@query("malware_metric", sql("""
    SELECT concat('env', msg_seq % 3) AS environment, concat('verdict ', verdict, ' in ', filename) AS reason, count(*) AS n FROM messages
    WHERE filename IS NOT NULL AND verdict <> 'CLEAN' AND size_bytes <= 52428800 GROUP BY ALL""", "messages"))
def malware_metric(spark, sf):
    held = intake.screen(d.messages(spark, sf)).filter(intake.needs_quarantine(F.col("attachments")))
    first = F.get("attachments", F.lit(0))
    rows = held.select(
        F.concat(F.lit("env"), (F.col("msg_seq") % 3).cast("string")).alias("environment"),
        F.concat(F.lit("verdict "), first["scan_verdict"], F.lit(" in "), first["filename"]).alias("reason"),
    )
    return intake.malware_metric(rows)


def rendered_mail(spark, sf):
    """Messages rendered as RFC 822 bytes, with a base64 text part and a base64 attachment where there is one. In every third message they
    stand one level deeper."""
    def b64(c):
        return F.base64(F.encode(c, "utf-8"))

    crlf = "\r\n"
    head = F.concat(
        F.lit("Message-ID: <"), F.col("message_id"), F.lit(f">{crlf}Subject: =?utf-8?B?"), F.regexp_replace(b64(F.concat(F.lit("Étude "), F.col("msg_seq").cast("string"))), "[\r\n]", ""),
        F.lit(f"?={crlf}From: "), F.col("sender"), F.lit(f"{crlf}To: papers@{DOMAIN}, desk@{DOMAIN}{crlf}Cc: {crlf}MIME-Version: 1.0{crlf}Content-Type: multipart/mixed; boundary=cut{crlf}{crlf}"),
    )
    text = F.concat(F.lit(f"--cut{crlf}Content-Type: text/plain; charset=utf-8{crlf}Content-Transfer-Encoding: base64{crlf}{crlf}"), b64(F.col("body_text")), F.lit(crlf))
    name = F.get("attachments", F.lit(0))["filename"]
    file_part = F.concat(
        F.lit(f"--cut{crlf}Content-Type: application/pdf{crlf}Content-Disposition: attachment; filename=\""), name,
        F.lit(f"\"{crlf}Content-Transfer-Encoding: base64{crlf}{crlf}"), b64(F.concat(F.lit("file"), F.col("msg_seq").cast("string"))), F.lit(crlf),
    )
    parts = F.concat(text, F.coalesce(file_part, F.lit("")), F.lit(f"--cut--{crlf}"))
    deeper = F.concat(F.lit(f"--cut{crlf}Content-Type: multipart/mixed; boundary=deep{crlf}{crlf}"), F.replace(parts, F.lit("--cut"), F.lit("--deep")), F.lit(f"--cut--{crlf}"))
    whole = F.concat(head, F.when(F.col("msg_seq") % 3 == 0, deeper).otherwise(parts))
    return d.messages(spark, sf).select("msg_seq", F.encode(whole, "utf-8").alias("content"))


@query("mail_parse", sql(f"""
    SELECT msg_seq, message_id, concat('Étude ', msg_seq) AS subject, sender, 'papers@{DOMAIN}|desk@{DOMAIN}' AS recipients, sha256({strip('body_text')}) AS body_hash,
      filename, CASE WHEN filename IS NOT NULL THEN checksum END AS checksum FROM messages""", "messages"))
def mail_parse(spark, sf):
    parsed = mail.parse_mail(rendered_mail(spark, sf), keep=["msg_seq"])
    info = F.get(mail.attachment_infos("attachments"), F.lit(0))
    return parsed.select(
        "msg_seq", "message_id", "subject", "sender", F.array_join("recipients", "|").alias("recipients"), F.sha2("body_text", 256).alias("body_hash"),
        info["filename"].alias("filename"), info["checksum_sha256"].alias("checksum"),
    )


_TTL_CHAIN = """
    SELECT user_id, event_type, min(ts) AS accepted_ts FROM events GROUP BY ALL
    UNION ALL SELECT c.user_id, c.event_type, (SELECT min(e.ts) FROM events e WHERE e.user_id = c.user_id AND e.event_type = c.event_type AND e.ts >= c.accepted_ts + INTERVAL 604800 SECOND)
    FROM chain c WHERE c.accepted_ts IS NOT NULL"""
TTL_SQL = sql(f"SELECT user_id, event_type, {shown('accepted_ts')} AS accepted_at FROM chain WHERE accepted_ts IS NOT NULL", recursive=True, chain=_TTL_CHAIN)


@query("ttl_dedup", TTL_SQL)
def ttl_dedup(spark, sf):
    accepted = dedup.ttl_accepted(d.table(spark, sf, "events"), ["user_id", "event_type"], "ts", "event_id", DEFAULTS.dedup_ttl_seconds)
    return accepted.select("user_id", "event_type", d.shown_time(F.col("ts")).alias("accepted_at"))


@query("ttl_dedup_short", sql(f"SELECT event_type, {shown('t')} AS accepted_at FROM chain WHERE t IS NOT NULL", recursive=True, chain="""
    SELECT event_type, min(ts) AS t FROM events GROUP BY event_type
    UNION ALL SELECT c.event_type, (SELECT min(e.ts) FROM events e WHERE e.event_type = c.event_type AND e.ts >= c.t + INTERVAL 3600 SECOND) FROM chain c WHERE c.t IS NOT NULL"""))
def ttl_dedup_short(spark, sf):
    """Few busy keys and a TTL of an hour: chains of hundreds of acceptances, walked in about ten rounds."""
    accepted = dedup.ttl_accepted(d.table(spark, sf, "events"), ["event_type"], "ts", "event_id", 3600)
    return accepted.select("event_type", d.shown_time(F.col("ts")).alias("accepted_at"))


@query("ttl_dedup_with_gaps", sql("""
    SELECT event_id, CASE WHEN event_ts IS NULL THEN NULL ELSE NOT EXISTS (SELECT 1 FROM chain c WHERE c.accepted_id = event_id) END AS is_duplicate FROM gaps""", recursive=True, gaps="""
    SELECT event_id, CASE WHEN event_id % 7 <> 0 THEN user_id % 5 END AS k, CASE WHEN event_id % 11 <> 0 THEN ts END AS event_ts FROM events""", chain="""
    SELECT k, arg_min(event_id, (event_ts, event_id)) AS accepted_id, min(event_ts) AS accepted_ts FROM gaps WHERE event_ts IS NOT NULL GROUP BY k
    UNION ALL SELECT c.k, (SELECT arg_min(e.event_id, (e.event_ts, e.event_id)) FROM gaps e WHERE e.k IS NOT DISTINCT FROM c.k AND e.event_ts >= c.accepted_ts + INTERVAL 604800 SECOND),
      (SELECT min(e.event_ts) FROM gaps e WHERE e.k IS NOT DISTINCT FROM c.k AND e.event_ts >= c.accepted_ts + INTERVAL 604800 SECOND) FROM chain c WHERE c.accepted_ts IS NOT NULL"""))
def ttl_dedup_with_gaps(spark, sf):
    """The gate over rows some of which have no key (a key of its own) or no time (not judged)."""
    rows = d.table(spark, sf, "events").select(
        "event_id", F.when(F.col("event_id") % 7 != 0, F.col("user_id") % 5).alias("k"), F.when(F.col("event_id") % 11 != 0, F.col("ts").cast("timestamp")).alias("event_ts"),
    )
    return dedup.flag_duplicates(rows, ["k"], "event_ts", "event_id", DEFAULTS.dedup_ttl_seconds).select("event_id", "is_duplicate")


def threads(spark, sf):
    """Messages with the keys of the multi-key gate: some share an id with the one before, some answer one message of five, some refer to
    earlier messages, some have no id, and some no time."""
    i = F.col("doc_id")
    shared = F.when(i % 13 != 0, d.message_id())
    reply = F.when(i % 5 == 2, F.concat(F.lit("m"), d.text_of(i - i % 10), F.lit(f"@{DOMAIN}")))
    refers = F.when(i % 7 == 3, F.concat(F.lit("<m"), d.text_of(i - 1), F.lit(f"@{DOMAIN}>  <m"), d.text_of(i - 3), F.lit(f"@{DOMAIN}>")))
    key = F.when(shared.isNotNull(), intake.idempotency_key(shared, d.file_name()))
    checked, marked = intake.gate_keys(shared, key, reply, refers)
    return d.documents(spark, sf).select(i.alias("msg_seq"), F.when(i % 19 != 0, F.col("ts")).alias("received_at"), checked.alias("checked"), marked.alias("marked"))


# One message a step in order of time; the state maps a key to the time of the last accepted message that marked it.
_STEP = """
    SELECT msg_seq, received_at, row_number() OVER (ORDER BY received_at, msg_seq) AS step, marked, list_distinct(list_concat(marked, refers)) AS checked FROM (
      SELECT msg_seq, received_at, list_filter(['msgid:' || id, 'idem:' || sha256(id || ':' || coalesce(filename, 'no-attachment')), 'reply:' || reply], lambda k: k IS NOT NULL) AS marked, refers FROM (
        SELECT msg_seq, filename, CASE WHEN msg_seq % 19 <> 0 THEN received_at END AS received_at, CASE WHEN msg_seq % 13 <> 0 THEN message_id END AS id,
          CASE WHEN msg_seq % 5 = 2 THEN concat('m', msg_seq - msg_seq % 10, '@{domain}') END AS reply,
          CASE WHEN msg_seq % 7 = 3 THEN [concat('msgid:m', msg_seq - 1, '@{domain}'), concat('msgid:m', msg_seq - 3, '@{domain}')] ELSE [] END AS refers FROM messages)) WHERE received_at IS NOT NULL""".format(domain=DOMAIN)
_WALK = """
    SELECT CAST(0 AS BIGINT) AS step, CAST(NULL AS BIGINT) AS msg_seq, false AS refused, MAP([]::VARCHAR[], []::TIMESTAMP[]) AS state
    UNION ALL SELECT n.step, n.msg_seq, n.refused, CASE WHEN n.refused OR len(n.marked) = 0 THEN n.state ELSE map_concat(n.state, MAP(n.marked, list_transform(n.marked, lambda k: n.received_at))) END FROM (
      SELECT s.step, s.msg_seq, s.marked, CAST(s.received_at AS TIMESTAMP) AS received_at, w.state,
        len(list_filter(s.checked, lambda k: coalesce(w.state[k] + INTERVAL 604800 SECOND > CAST(s.received_at AS TIMESTAMP), false))) > 0 AS refused
      FROM walk w JOIN step s ON s.step = w.step + 1) n"""
MULTI_KEY_SQL = sql(
    "SELECT m.msg_seq, CASE WHEN m.msg_seq % 19 <> 0 THEN w.refused END AS is_duplicate FROM messages m LEFT JOIN walk w ON w.msg_seq = m.msg_seq",
    "messages", recursive=True, step=_STEP, walk=_WALK,
)


@query("multi_key_dedup", MULTI_KEY_SQL)
def multi_key_dedup(spark, sf):
    """Duplicates by message id, idempotency key, the message answered or a message referred to."""
    flagged = dedup.flag_multi_key_duplicates(threads(spark, sf), "checked", "marked", "received_at", "msg_seq", DEFAULTS.dedup_ttl_seconds)
    return flagged.select("msg_seq", "is_duplicate")


@query("rate_limit_with_gaps", """
    SELECT event_id, k, n AS attempts, n <= 5 AS allowed, CASE WHEN n IS NOT NULL THEN greatest(0, 5 - n) END AS remaining FROM (
      SELECT event_id, k, CASE WHEN t IS NOT NULL THEN count(*) OVER (PARTITION BY k, t IS NULL ORDER BY epoch_us(t) RANGE BETWEEN 21599999999 PRECEDING AND CURRENT ROW) END AS n
      FROM (SELECT event_id, CASE WHEN event_id % 7 <> 0 THEN user_id END AS k, CASE WHEN event_id % 5 <> 0 THEN ts END AS t FROM events))""")
def rate_limit_with_gaps(spark, sf):
    from paperloom.operators.history import rate_limited

    rows = d.table(spark, sf, "events").select(
        "event_id", F.when(F.col("event_id") % 7 != 0, F.col("user_id")).alias("k"), F.when(F.col("event_id") % 5 != 0, F.col("ts").cast("timestamp")).alias("t"),
    )
    return rate_limited(rows, ["k"], "t", window_seconds=6 * 3600).drop("t")


RATE_SQL = f"""
    SELECT event_id, user_id, event_type, n AS attempts, n <= 5 AS allowed, greatest(0, 5 - n) AS remaining FROM (
      SELECT event_id, user_id, event_type, count(*) OVER (PARTITION BY user_id ORDER BY epoch_us(ts) RANGE BETWEEN 21599999999 PRECEDING AND CURRENT ROW) AS n FROM events)"""


@query("rate_limit", RATE_SQL)
def rate_limit(spark, sf):
    """The sliding log with a 6-hour window, in which the event table has busy keys."""
    from paperloom.operators.history import rate_limited

    rows = d.table(spark, sf, "events").select("event_id", "user_id", "event_type", "ts")
    return rate_limited(rows, ["user_id"], "ts", window_seconds=6 * 3600).drop("ts")
