"""Skew-proof operators against brute force, stream stages over several batches, and sinks read back."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from paperloom.operators import dedup, facets, history, intake, reports, store, vector_search
from paperloom.plans import derived as d
from paperloom.plans import store_queries, stream_queries
from paperloom.sources import mail, registry, sinks, tables
from paperloom.streaming import jobs

SF = "/root/testdata/sf0.001"
T0 = dt.datetime(2024, 1, 1)


def log_rows(seed, n=400, hot=0.4):
    """Events of few keys, one of which holds a large share, with equal times among them."""
    rng = random.Random(seed)
    return [("hot" if rng.random() < hot else f"k{rng.randrange(4)}", T0 + dt.timedelta(seconds=rng.randrange(0, 40_000, 20)), i, rng.choice("abc")) for i in range(n)]


def events(spark, rows):
    return spark.createDataFrame(rows, "key string, ts timestamp, id int, state string")


@pytest.mark.parametrize(("ttl", "n"), [(5_000, 0), (300, 400), (5_000, 400), (12_000, 400), (100_000, 400)])
def test_ttl_fold(spark, ttl, n):
    rows = log_rows(ttl, n)
    last, want = {}, set()
    for key, ts, i, _ in sorted(rows, key=lambda r: (r[1], r[2])):
        if key not in last or ts >= last[key] + dt.timedelta(seconds=ttl):
            last[key] = ts
            want.add(i)
    got = dedup.ttl_accepted(events(spark, rows), ["key"], "ts", "id", ttl)
    assert {r.id for r in got.collect()} == want


def test_a_long_chain_of_acceptances_takes_few_rounds(spark, monkeypatch):
    """A thousand acceptances in one run of rows, none of which is accepted whatever came earlier, but the first."""
    rows = [("hot" if i % 3 else None, T0 + dt.timedelta(seconds=20 * i), i, "a") for i in range(4_500)]
    last, want, steps = {}, set(), []
    for key, ts, i, _ in rows:
        if key not in last or ts >= last[key] + dt.timedelta(seconds=60):
            last[key] = ts
            want.add(i)
    assert len(want) > 1_000
    cut = dedup.cut_lineage
    monkeypatch.setattr(dedup, "cut_lineage", lambda df: steps.append(1) or cut(df))
    got = [r.id for r in dedup.ttl_accepted(events(spark, rows), ["key"], "ts", "id", 60).collect()]
    assert sorted(got) == sorted(want)
    assert len(steps) <= 4 + 2 * 11


def test_ttl_gates_over_batches(spark, tmp_path):
    """Both stream forms over three time-ordered batches equal the batch form over everything."""
    from paperloom.settings import Settings
    from paperloom.sources.events import file_stream
    from paperloom.streaming import gates

    rows = sorted(log_rows(9, 300), key=lambda r: (r[1], r[2]))
    topic = str(tmp_path / "topic")
    for part in range(3):
        events(spark, rows[part * 100:(part + 1) * 100]).coalesce(1).write.mode("append").parquet(topic)
    schema = events(spark, rows[:1]).schema
    want = {r.id for r in dedup.ttl_accepted(events(spark, rows), ["key"], "ts", "id", 9_000).collect()}
    stream = file_stream(spark, topic, schema=schema, files_per_trigger=1)
    base = str(tmp_path / "out")
    jobs.run_ttl_gate(stream, ["key"], "ts", "id", base, str(tmp_path / "cp"), Settings(dedup_ttl_seconds=9_000))
    assert {r.id for r in jobs.read_output(spark, base, "accepted").collect()} == want
    gates.use_rocksdb(spark)
    gates.run_to_files(gates.ttl_gate(stream, ["key"], "ts", "id", 9_000), str(tmp_path / "keyed"), str(tmp_path / "cp2"))
    assert {r.id for r in spark.read.parquet(str(tmp_path / "keyed")).collect()} == want


@pytest.mark.parametrize("chunk", [100, 7_000, 10_000_000])
def test_versions_do_not_depend_on_chunks(spark, chunk):
    rows = log_rows(1)
    got = history.versioned(events(spark, rows), "key", "ts", "id", ["state"], chunk_seconds=chunk).collect()
    want, count = {}, {}
    for key, _, i, state in sorted(rows, key=lambda r: (r[1], r[2])):
        n, before = count.get(key, (0, None))
        want[i] = (n + 1, before)
        count[key] = (n + 1, state)
    assert {r.id: (r.version_number, r.before.state if r.before else None) for r in got} == want


@pytest.mark.parametrize("window", [20, 60, 3_000])
def test_sliding_log(spark, window):
    rows = log_rows(2)
    got = history.rate_limited(events(spark, rows), ["key"], "ts", 5, window).collect()
    span = dt.timedelta(seconds=window)
    for r in got:
        n = sum(1 for k, t, _, _ in rows if k == r.key and r.ts - span < t <= r.ts)
        assert (r.attempts, r.allowed, r.remaining) == (n, n <= 5, max(0, 5 - n))
    assert len(got) == len(rows)


def test_first_per_key_and_insert(spark):
    rows = events(spark, log_rows(3))
    stored = spark.createDataFrame([("hot",)], "key string")
    new = store.new_rows(rows, stored, "key", ["ts", "id"])
    want = {}
    for key, ts, i, _ in log_rows(3):
        want[key] = min(want.get(key, (ts, i)), (ts, i))
    assert {r.key: (r.ts, r.id) for r in new.collect()} == {k: v for k, v in want.items() if k != "hot"}


def test_similarity_blocks(spark, monkeypatch):
    """More query vectors than one block: the result is that of a direct product."""
    rng = np.random.default_rng(0)
    docs, asked = rng.normal(size=(60, 8)), rng.normal(size=(23, 8))
    monkeypatch.setattr(vector_search, "QUERY_BLOCK", 5)
    schema = "{} int, embedding array<float>"
    papers = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(docs)], schema.format("paper_id"))
    queries = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(asked)], schema.format("query_id"))
    got = {(r.query_id, r.paper_id) for r in vector_search.similarities(papers, queries, 0.4).collect()}
    unit = [m / np.linalg.norm(m, axis=1, keepdims=True) for m in (docs.astype("f4").astype("f8"), asked.astype("f4").astype("f8"))]
    sims = unit[1] @ unit[0].T
    assert got == {(int(q), int(p)) for q, p in zip(*np.nonzero(sims >= 0.4))}


def test_encoder_runs_in_batches(spark):
    def load():
        return lambda texts: np.array([[len(t), 1.0] for t in texts])

    df = spark.createDataFrame([("ab",), (None,), ("abcd",)], "t string")
    assert [r.embedding for r in vector_search.encode(df, "t", load).collect()] == [[2.0, 1.0], None, [4.0, 1.0]]


def test_route_over_batches(spark, tmp_path):
    """A key routed in one batch is skipped in the next; outcomes of all batches cover the input."""
    messages = stream_queries.ingest_messages(spark, SF)
    topic = str(tmp_path / "topic")
    for part in ("a", "b"):
        messages.coalesce(1).write.mode("append").parquet(topic)
    from paperloom.sources.events import file_stream

    base = str(tmp_path / "out")
    jobs.run_stage(file_stream(spark, topic, files_per_trigger=1), stream_queries.route_stage(spark, SF), jobs.split_routed, base, str(tmp_path / "cp"), "processed")
    out = {n: jobs.read_output(spark, base, n) for n in ("routed", "dead_letters", "skipped", "processed", "_outcomes")}
    counts = {n: df.count() for n, df in out.items()}
    assert counts["_outcomes"] == 2 * messages.count() == counts["routed"] + counts["dead_letters"] + counts["skipped"]
    assert counts["routed"] == counts["processed"] == out["routed"].select("key").distinct().count() > 0
    assert {r.topic for r in out["routed"].select("topic").distinct().collect()} <= {"papers.validated", "papers.review", "papers.failed"}
    assert counts["skipped"] >= counts["routed"]


def test_store_over_batches(spark, tmp_path):
    messages = stream_queries.extracted_messages(spark, SF)
    topic = str(tmp_path / "topic")
    for _ in range(2):
        messages.coalesce(1).write.mode("append").parquet(topic)
    from paperloom.sources.events import file_stream

    base = str(tmp_path / "out")
    jobs.run_stage(file_stream(spark, topic, files_per_trigger=1), stream_queries.store_stage, jobs.split_stored, base, str(tmp_path / "cp"), "papers")
    papers = jobs.read_output(spark, base, "papers")
    keys = papers.select("ingestion_idempotency_key").distinct().count()
    assert papers.count() == keys == jobs.read_output(spark, base, "versions").count() == jobs.read_output(spark, base, "audit").count()
    done = papers.count() + sum(jobs.read_output(spark, base, n).count() for n in ("rejected", "skipped"))
    assert done == 2 * messages.count()


def test_unreadable_messages_are_rejected(spark):
    bad = spark.createDataFrame([("k1", "no json", "t"), ("k2", '{"event_id": "e"}', "t"), (None, "[]", "t")], "key string, value string, topic string")
    out = jobs.store_batch(bad, None, d.as_of(), F.lit(2024)).select("kind", "key", "reason").collect()
    assert sorted((r.kind, r.key) for r in out) == [("rejected", "k1"), ("rejected", "k2"), ("rejected", "unknown")]
    assert all(r.reason.startswith("schema_validation_failed: ") for r in out)


def test_exports(spark, tmp_path):
    papers = d.papers(spark, SF)
    sinks.export_ndjson(papers, str(tmp_path / "nd"), limit=10)
    assert spark.read.json(str(tmp_path / "nd")).count() == 10
    sinks.export_csv(papers, str(tmp_path / "csv"), limit=20)
    back = spark.read.option("header", "true").option("multiLine", "true").option("escape", '"').csv(str(tmp_path / "csv"))
    assert back.columns == facets.EXPORT_COLUMNS
    with pytest.raises(ValueError):
        facets.export_rows(papers, 0)
    assert facets.export_rows(papers, None).count() == papers.filter("status = 'PUBLISHED'").count()


def test_report_files_and_verification(spark, tmp_path):
    papers = d.settled(d.papers_with_authors(spark, SF))
    manifest = reports.run_reports(reports.department_requests(papers), papers, d.issues(spark, SF), d.as_of())
    cells = reports.report_rows(papers, manifest)
    sinks.write_report_csv(cells, str(tmp_path / "csv"))
    sinks.write_report_html(reports.report_rows(papers, manifest, "pdf"), manifest, str(tmp_path / "html"))
    files = tables.read_files(spark, str(tmp_path / "csv"), "*.csv")
    assert files.count() > 0
    marked = files.withColumn("report_id", tables.report_file_id())
    hashes = marked.select("report_id", "path", F.sha2("content", 256).alias("h"))
    recorded = hashes.select(F.concat("report_id", F.lit("|"), "path").alias("report_id"), F.col("h").alias("checksum_sha256"))
    again = marked.select(F.concat("report_id", F.lit("|"), "path").alias("report_id"), "content")
    assert {r.event_type for r in reports.verify_checksums(again, recorded, d.as_of()).select("event_type").collect()} == {"VERIFIED"}
    kept = [tuple(r) for r in sinks.report_checksums(sinks.report_parts(spark, str(tmp_path / "csv"))).collect()]
    recorded = spark.createDataFrame(kept, "report_id string, checksum_sha256 string")
    assert {r.event_type for r in sinks.verify_reports(spark, str(tmp_path / "csv"), recorded).collect()} == {"VERIFIED"}
    part = next((tmp_path / "csv").glob("report_id=*/part-*"))
    part.write_bytes(part.read_bytes() + b"x")
    (part.parent / f".{part.name}.crc").unlink()
    changed = [r.report_id for r in sinks.verify_reports(spark, str(tmp_path / "csv"), recorded).collect() if r.event_type == "MISMATCH"]
    assert changed == [part.parent.name.removeprefix("report_id=")]
    html = spark.read.text(str(tmp_path / "html"))
    done = manifest.filter("status = 'COMPLETED'").count()
    assert html.filter(F.col("value").startswith("<h1>")).count() == done and html.count() == done + cells.count()


def test_faculty_profiles_count_their_own_papers(spark):
    papers = d.papers_with_authors(spark, SF).filter("status = 'PUBLISHED'")
    asked = reports.faculty_requests(papers)
    none = asked.limit(1).withColumn("faculty_id", F.lit(None).cast("bigint")).withColumn("report_id", F.lit("nobody"))
    jobs = reports.run_reports(asked.unionByName(none), papers, d.issues(spark, SF).limit(0), d.as_of())
    [lost] = jobs.filter("report_id = 'nobody'").collect()
    assert lost.status == "FAILED" and lost.error_message == reports.NO_FACULTY
    rows = reports.report_rows(papers, jobs).groupBy("report_id").count()
    both = jobs.filter("status = 'COMPLETED'").join(rows, "report_id", "left").select("total_papers", F.coalesce("count", F.lit(0)).alias("n")).collect()
    assert both and all(r.total_papers == r.n for r in both)


def test_tables_round_trip(spark, tmp_path):
    base = str(tmp_path)
    flat = store_queries.flat_papers(spark, SF)
    tables.write_table(flat, base, "papers")
    back = tables.read_table(spark, base, "papers")
    assert back.count() == flat.count()
    plan = back.filter("department_code = 'CSE' AND year = 2010").select("title")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(department_code" in plan
    log = history.audit_log(store_queries.audit(spark, SF))
    tables.write_table(log, base, "audit_log")
    assert tables.read_table(spark, base, "audit_log").filter("month = '2024-01'").count() > 0


def test_mail_archive(spark, tmp_path):
    (tmp_path / "a.eml").write_bytes(b"Message-ID: <x@y>\r\nFrom: A <a@b>\r\nTo: c@d, e@f\r\nSubject: Hello\r\n\r\nPlain body\r\n")
    (tmp_path / "b.eml").write_bytes(
        b"Message-ID: <z@y>\r\nIn-Reply-To: <x@y>\r\nMIME-Version: 1.0\r\nContent-Type: multipart/mixed; boundary=q\r\n\r\n--q\r\nContent-Type: text/html\r\n\r\n<p>no</p>\r\n"
        b"--q\r\nContent-Type: text/plain\r\n\r\nyes\r\n--q\r\nContent-Type: application/pdf\r\nContent-Disposition: attachment; filename=f.pdf\r\n\r\nBYTES\r\n--q--\r\n"
    )
    rows = {r.message_id: r for r in mail.parse_mail(mail.scan_archive(spark, str(tmp_path))).collect()}
    assert rows["x@y"].body_text == "Plain body" and rows["x@y"].recipients == ["c@d", "e@f"] and rows["x@y"].in_reply_to is None
    reply = rows["z@y"]
    assert (reply.body_text, reply.in_reply_to, reply.subject) == ("yes", "x@y", "(no subject)")
    assert [(a.filename, bytes(a.content)) for a in reply.attachments] == [("f.pdf", b"BYTES")]


def test_nested_mail():
    def multipart(kind, *parts):
        cut = f"b{len(''.join(parts))}"
        return f"Content-Type: multipart/{kind}; boundary={cut}\r\n\r\n" + "".join(f"--{cut}\r\n{p}\r\n" for p in parts) + f"--{cut}--\r\n"

    def text(t, extra=""):
        return f"Content-Type: text/plain\r\n{extra}\r\n{t}"

    def pdf(name, how="attachment"):
        return f"Content-Type: application/pdf\r\nContent-Disposition: {how}; filename={name}\r\n\r\n{name}"

    for message, body, names in (
        (multipart("signed", multipart("mixed", text("one"), pdf("paper.pdf")), "Content-Type: application/pgp-signature\r\n\r\nsig"), "one", ["paper.pdf"]),
        (multipart("mixed", multipart("mixed", text("one"), pdf("a.pdf"), text("two")), text("three"), pdf("b.pdf", "inline")), "one\ntwo\nthree", ["a.pdf", "b.pdf"]),
        (multipart("alternative", text("one"), multipart("mixed", "Content-Type: text/html\r\n\r\n<p>one</p>", pdf("mac.pdf"))), "one", ["mac.pdf"]),
        (multipart("mixed", text("one"), text("notes", "Content-Disposition: attachment; filename=n.txt\r\n")), "one", ["n.txt"]),
        ("Content-Type: text/html\r\n\r\n<p>one</p>", "<p>one</p>", []),
    ):
        got = mail.read_message(f"Message-ID: <x@y>\r\nMIME-Version: 1.0\r\n{message}".encode())
        assert (got["body_text"], [a["filename"] for a in got["attachments"]]) == (body, names)


def test_registry_dump(spark, tmp_path):
    d.registry_works(spark, SF).write.json(str(tmp_path / "works"))
    assert registry.read_registry(spark, str(tmp_path / "works")).count() == d.registry_works(spark, SF).count()


def test_attachment_and_quarantine_files(spark, tmp_path):
    screened = intake.screen(d.messages(spark, SF))
    held = screened.filter(intake.needs_quarantine(F.col("attachments")))
    sinks.write_attachments(screened.filter(~intake.needs_quarantine(F.col("attachments"))), str(tmp_path))
    sinks.write_quarantine(held, F.lit("infected"), str(tmp_path))
    kept = spark.read.parquet(str(tmp_path / "attachments")).count()
    withheld = spark.read.parquet(str(tmp_path / "quarantine"))
    assert kept + withheld.count() == screened.select(F.explode("attachments")).count()
    assert all(r.s3_key.startswith("quarantine/2024/01/") for r in withheld.collect())


def test_filters_reach_the_scan(spark, tmp_path):
    store_queries.flat_papers(spark, SF).write.parquet(str(tmp_path / "p"))
    papers = spark.read.parquet(str(tmp_path / "p"))
    plan = facets.list_papers(papers, 10, status="PUBLISHED", year=2010).select("paper_id")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(status,PUBLISHED)" in plan and "TakeOrderedAndProject" in plan and "title" not in plan.split("ReadSchema")[1]


def test_top_per_query_limits_groups_before_the_shuffle(spark):
    from paperloom.operators.text_search import top_per_query

    rows = spark.range(1000).select((F.col("id") % 3).alias("query_id"), F.col("id").alias("paper_id"), (F.col("id") % 7).alias("rank"))
    top = top_per_query(rows, 5)
    assert "WindowGroupLimit" in top._jdf.queryExecution().executedPlan().toString()
    assert top.count() == 15
