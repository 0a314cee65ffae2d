"""Papers, messages, users, issues and change logs as views over the given tables (SQL twins in `derived_sql`)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.operators.intake import idempotency_key
from paperloom.settings import DEFAULTS

DOMAIN = DEFAULTS.institution_domain
AS_OF_TEXT = "2024-01-31 00:00:00"


def as_of() -> Column:
    return F.lit(AS_OF_TEXT).cast("timestamp")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(index: Column, *values: str) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def text_of(c: Column) -> Column:
    return c.cast("string")


def shown_time(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with a time. Dealt by id whatever their files look like: text work behind it runs in all tasks, and a join by id that
    has to shuffle finds its rows in place."""
    events = table(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source").repartition("doc_id")
    return docs.join(events, F.col("event_id") == F.col("doc_id")).drop("event_id")


def department(i: Column) -> Column:
    return pick(i % 4, "CSE", "ECE", "MECH", "CIVIL")


def faculty_email(i: Column) -> Column:
    return F.concat(F.lit("customer."), F.lpad(text_of(i), 9, "0"), F.lit("@" + DOMAIN))


def paper_columns() -> list[Column]:
    i = F.col("doc_id")
    return [
        i.alias("paper_id"),
        F.split_part("text", F.lit("\n"), F.lit(1)).alias("title"),
        F.when(i % 7 != 0, F.concat(pick(i % 4, "Journal of ", "Conference on ", "Transactions on ", "Workshop on "), F.col("source"))).alias("venue"),
        (F.lit(2000) + i % 26).cast("int").alias("year"),
        F.when(i % 3 != 0, F.concat(F.lit("10."), text_of(1000 + i % 9000), F.lit("/p."), text_of(i))).alias("doi"),
        pick(i % 5, "journal", "conference", "thesis", "book_chapter", "unknown").alias("paper_type"),
        F.when((i * 7) % 10 == 0, "DRAFT").when((i * 7) % 10 == 1, "PENDING_REVIEW").when((i * 7) % 10 == 2, "REJECTED").otherwise("PUBLISHED").alias("status"),
        department(i * 3).alias("department_code"),
        (1 + i % 40).alias("faculty_id"),
        faculty_email(1 + i % 40).alias("faculty_email"),
        (((i * 37) % 101) * F.lit(0.01)).cast("decimal(3,2)").alias("overall_confidence"),
        F.col("ts").alias("created_at"),
        idempotency_key(message_id(), file_name()).alias("ingestion_idempotency_key"),
    ]


def papers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents(spark, sf_dir).select(*paper_columns())


def settled(papers: DataFrame) -> DataFrame:
    """Two departments have finished their reviews: what was open there has been rejected."""
    done = F.col("department_code").isin("CSE", "MECH") & F.col("status").isin("DRAFT", "PENDING_REVIEW")
    return papers.withColumn("status", F.when(done, "REJECTED").otherwise(F.col("status")))


def papers_with_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("paper_id"), "embedding", "label")
    return papers(spark, sf_dir).join(vectors, "paper_id", "left")


def authors_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("paper_id"))
    rows = docs.withColumn("ord", F.explode(F.sequence(F.lit(1), (1 + F.col("paper_id") % 3).cast("int"))))
    people = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_name").alias("name"))
    size = people.agg(F.count("*")).scalar()
    wanted = rows.withColumn("__person", (F.col("paper_id") * 7 + F.col("ord") * 13) % size)
    return wanted.join(people, F.col("c_custkey") == F.col("__person")).drop("c_custkey", "__person")


def papers_with_authors(spark: SparkSession, sf_dir: str) -> DataFrame:
    nested = authors_long(spark, sf_dir).groupBy("paper_id").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("ord", "name"))), lambda a: F.struct(
            a["name"].alias("name"), F.lit(None).cast("string").alias("affiliation"), a.ord.alias("order")
        )).alias("authors")
    )
    return papers(spark, sf_dir).join(nested, "paper_id", "left")


def issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels")
    events = table(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"))
    i = F.col("doc_id")
    return labels.join(events, F.col("event_id") == i).select(
        i.alias("issue_id"), i.alias("paper_id"),
        F.when(F.col("toxic") == 1, "error").when(F.col("quality") == 0, "warning").otherwise("info").alias("severity"),
        F.when(i % 3 == 0, F.col("ts")).alias("resolved_at"), F.col("ts").alias("created_at"),
    )


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        F.concat(F.lit("user_"), text_of(k)).alias("user_id"), k.alias("faculty_id"),
        F.concat(F.lower(F.replace("c_name", F.lit("#"), F.lit("."))), F.lit("@" + DOMAIN)).alias("email"),
        F.col("c_name").alias("name"),
        F.when(k % 20 == 0, "admin").when(k % 20 == 1, "hod").when(k % 20 == 2, "coordinator").otherwise("faculty").alias("role"),
        department(F.col("c_nationkey")).alias("department_code"), (F.col("c_acctbal") > 0).alias("is_active"),
    )


def message_id() -> Column:
    i = F.col("doc_id")
    shifted = i - F.when((i % 11 == 0) & (i > 0), 1).otherwise(0)
    return F.concat(F.lit("m"), text_of(shifted), F.lit("@" + DOMAIN))


def file_name() -> Column:
    i = F.col("doc_id")
    return F.when(i % 3 != 0, F.concat(F.lit("paper"), text_of(i % 3), F.lit(".pdf")))


def body() -> Column:
    i = F.col("doc_id")
    tail = F.concat(
        F.lit("\nDOI: 10."), text_of(1000 + i % 9000), F.lit("/p."), text_of(i), F.lit(". Published in "), text_of(2000 + i % 26),
        F.lit(", revised "), text_of(2000 + i % 13), F.lit(". Call 98765"), F.lpad(text_of(i % 100000), 5, "0"),
        F.lit(" or mail a"), text_of(i), F.lit("@example.org or b"), text_of(i), F.lit("@" + DOMAIN + ", id AP2021"),
        F.lpad(text_of(i % 1000000), 6, "0"),
    )
    return F.when(i % 37 == 0, F.concat(F.lit("note "), text_of(i))).otherwise(F.concat(F.col("text"), tail))


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("doc_id")
    address = F.concat(F.lit("customer."), F.lpad(text_of(i % 60), 9, "0"), F.lit("@" + DOMAIN))
    sender = (
        F.when(i % 9 == 0, F.concat(F.lit("user"), text_of(i), F.lit("@mail.example.org")))
        .when(i % 5 == 1, F.concat(F.lit("Some Name <"), address, F.lit(">"))).otherwise(address)
    )
    verdict = F.when(i % 50 == 0, "INFECTED").otherwise("CLEAN")
    size = F.when(i % 13 == 0, F.lit(60 * 1024 * 1024)).otherwise(1000 + i).cast("bigint")
    attachment = F.struct(
        file_name().alias("filename"), F.lit("application/pdf").alias("content_type"), size.alias("size_bytes"),
        F.sha2(F.concat(F.lit("file"), text_of(i)), 256).alias("checksum_sha256"), verdict.alias("scan_verdict"),
    )
    return documents(spark, sf_dir).select(
        i.alias("msg_seq"), message_id().alias("message_id"), sender.alias("sender"), body().alias("body_text"),
        F.when(i % 3 != 0, F.array(attachment)).otherwise(F.array().cast("array<struct<filename:string,content_type:string,size_bytes:bigint,checksum_sha256:string,scan_verdict:string>>")).alias("attachments"),
        F.col("ts").alias("received_at"), F.lit(None).cast("string").alias("in_reply_to"),
        F.concat(F.lit("Paper "), text_of(i)).alias("subject"), F.array(F.lit("papers@" + DOMAIN)).alias("recipients"),
    )


def entities() -> Column:
    """Recognised names of a document, as an input column of the entity tier."""
    i = F.col("msg_seq")

    def entity(label: str, text: Column) -> Column:
        return F.struct(F.lit(label).alias("label"), text.alias("text"))

    person = F.concat(F.lit("Author "), text_of(i % 17))
    people = F.array(entity("PERSON", person), entity("PERSON", F.lit("Mono")), entity("PERSON", F.concat(F.lit(" "), person)), entity("PERSON", F.concat(F.lit("Coauthor "), text_of(i % 5))))
    rest = F.array(
        entity("ORG", F.concat(F.lit("Institute "), text_of(i % 7))),
        entity("ORG", F.concat(pick(i % 3, "Journal of Group ", "Department ", "IEEE Transactions "), text_of(i % 6))),
        entity("DATE", F.lit("last spring")), entity("DATE", F.concat(F.lit("in "), text_of(1990 + i % 60))),
    )
    return F.when(i % 4 == 0, rest).otherwise(F.concat(people, rest))


def registry_works(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A registry record per document, with gaps in each field; odd ones are registered under a DOI no message mentions."""
    i = F.col("doc_id")

    def parts(condition: Column, year: Column) -> Column:
        return F.when(condition, F.struct(F.array(F.array(year.cast("int"), F.lit(1))).alias("date-parts"))).otherwise(
            F.struct(F.array().cast("array<array<int>>").alias("date-parts"))
        )

    names = F.array(
        F.struct(F.lit("Ada").alias("given"), F.concat(F.lit("Family"), text_of(i % 23)).alias("family")),
        F.struct(F.lit(None).cast("string").alias("given"), F.lit("Solo").alias("family")),
        F.struct(F.lit(None).cast("string").alias("given"), F.lit(None).cast("string").alias("family")),
    )
    none = F.array().cast("array<string>")
    suffix = F.when(i % 2 == 0, "/P.").otherwise("/other.")
    return table(spark, sf_dir, "documents").select("doc_id").select(
        F.concat(F.lit("10."), text_of(1000 + i % 9000), suffix, text_of(i)).alias("DOI"),
        F.when(i % 10 == 0, none).otherwise(F.array(F.concat(F.lit("Registry title "), text_of(i)))).alias("title"),
        F.when(i % 14 == 0, F.array().cast("array<struct<given:string,family:string>>")).otherwise(names).alias("author"),
        parts(i % 3 == 0, 2001 + i % 20).alias("published-print"), parts(i % 3 <= 1, 2002 + i % 20).alias("published-online"),
        parts(i % 5 != 4, 2003 + i % 20).alias("created"),
        F.when(i % 4 == 0, none).otherwise(F.array(F.concat(F.lit("Container "), text_of(i % 11)))).alias("container-title"),
        F.when(i % 8 != 0, F.lit("Some Press")).alias("publisher"),
        F.when(i % 3 == 1, F.concat(F.lit("<jats:p>About "), text_of(i), F.lit("</jats:p>"))).alias("abstract"),
    )


def model_answers(spark: SparkSession, sf_dir: str, key: Column) -> DataFrame:
    """Model answers keyed by message number; every sixth belongs to no message."""
    i = F.col("doc_id")
    return table(spark, sf_dir, "documents").select("doc_id").select(
        F.when(i % 6 == 0, -1 - key).otherwise(key).alias("msg_seq"), F.concat(F.lit("Model title "), text_of(i)).alias("title"),
        F.when(i % 5 != 0, F.array(F.lit("Model One"), F.lit("Model Two"))).alias("authors"),
        F.when(i % 7 == 0, "n.d.").otherwise(text_of(2005 + i % 15)).alias("year"),
        F.when(i % 4 != 1, F.concat(F.lit("Model venue "), text_of(i % 9))).alias("venue"),
        F.lit(None).cast("string").alias("abstract"), F.when(i % 2 == 1, F.concat(F.lit("10.5555/m."), text_of(i))).alias("doi"),
    )


def paper_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A change log: each event changes the paper whose number is the event's user."""
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("paper_id"), F.col("ts").cast("timestamp").alias("changed_at"), F.col("event_id").alias("change_seq"),
        F.col("event_type").alias("state"), F.col("value").alias("score"),
        F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("user_"), text_of(F.col("event_id") % 50))).alias("changed_by"),
        F.when(F.col("event_id") % 2 == 0, F.concat(F.lit("edit "), text_of(F.col("event_id") % 10))).alias("change_reason"),
    )


def label_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query vectors: the mean vector of every label."""
    values = table(spark, sf_dir, "embeddings").select("label", F.posexplode("embedding").alias("at", "v"))
    means = values.groupBy("label", "at").agg(F.avg(F.col("v").cast("double")).alias("m"))
    return means.groupBy(F.col("label").cast("bigint").alias("query_id")).agg(
        F.transform(F.sort_array(F.collect_list(F.struct("at", "m"))), lambda x: x.m).alias("embedding")
    )


def label_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Request vectors: the first vector of every label, so that each request is close to at least one paper."""
    rows = table(spark, sf_dir, "embeddings")
    return rows.groupBy(F.col("label").cast("bigint").alias("query_id")).agg(F.min_by("embedding", "vec_id").alias("embedding"))
