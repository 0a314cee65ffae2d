"""Metadata extraction as column expressions: pattern tier, registry tier, entity tier, low-confidence tier, scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.functions.columns import blank_to_null, strip, truthy
from paperloom.session import cut_lineage
from paperloom.settings import DEFAULTS, Settings

# Patterns, keywords, scores and weights.
DOI_PATTERN = r"\b(10\.\d{4,9}/[-._;()/:A-Z0-9a-z]+)\b"
YEAR_PATTERN = r"\b(19[5-9]\d|20[0-2]\d)\b"
VENUE_KEYWORDS = (
    "conference", "journal", "proceedings", "workshop", "symposium", "transactions", "letters", "review", "arxiv",
)
DOI_SCORE = 0.95
TITLE_LINE_SCORE = 0.60
YEAR_SCORE = 0.60
ENTITY_SCORE = 0.75
REGISTRY_SCORE = 1.0
AUTHORS_WEIGHT, TITLE_WEIGHT, VENUE_YEAR_WEIGHT = 0.40, 0.30, 0.30
FORMULA = "(authors*0.40) + (title*0.30) + (venue_year*0.30)"
FORMULA_TOLERANCE = 0.001
GATE_BASE, GATE_SPAN = 0.70, 0.20

_DOI, _YEAR = "(?U)" + DOI_PATTERN, "(?U)" + YEAR_PATTERN


def first_doi(text: Column) -> Column:
    return blank_to_null(F.rtrim(F.regexp_extract(text, _DOI, 1), F.lit(".")))


def modal_year(text: Column) -> Column:
    """Most frequent year, first seen wins a tie. All in the row: there are at most 80 distinct years."""
    years = F.regexp_extract_all(text, F.lit(_YEAR), F.lit(1))
    scored = F.transform(
        F.array_distinct(years),
        lambda y, i: F.struct(F.size(F.filter(years, lambda x: x == y)).alias("n"), (-i).alias("first"), y.alias("year")),
    )
    return F.array_max(scored)["year"].cast("int")


def content_lines(text: Column) -> Column:
    """Trimmed non-blank lines."""
    return F.filter(F.transform(F.split(text, "\n"), strip), lambda line: line != "")


def _first(rows: Column, most: int | None) -> Column:
    return rows if most is None else F.slice(rows, 1, most)


def _start(text: Column, chars: int | None) -> Column:
    return text if chars is None else F.substring(text, 1, chars)


def title_candidate(text: Column, lines: int | None = None, max_chars: int | None = None) -> Column:
    """The first line that is longer than 10 characters and no link; of the leading `lines`, cut to `max_chars`, if these are given."""
    usable = F.filter(_first(content_lines(text), lines), lambda line: (F.length(line) > 10) & ~line.startswith("http"))
    return _start(F.get(usable, F.lit(0)), max_chars)


def header_title(text: Column, chars: int | None = None, lines: int | None = None) -> Column:
    """The first heading-like line of a paper; of its first `chars` characters and `lines` lines, if these are given."""
    heading = F.filter(
        _first(content_lines(_start(text, chars)), lines),
        lambda line: F.length(line).between(20, 200) & ~line.startswith("http") & ~line.rlike(r"(?U)^\d")
        & (F.regexp_count(line, F.lit(r"\p{Lu}")) >= 2),
    )
    return F.get(heading, F.lit(0))


def _entity_texts(entities: Column, label: str) -> Column:
    return F.transform(F.filter(entities, lambda e: e.label == label), lambda e: strip(e.text))


def pick_authors(entities: Column, most: int | None = None) -> Column:
    """Distinct multi-word PERSON names, in order of appearance; the first `most` if given."""
    names = F.array_distinct(_entity_texts(entities, "PERSON"))
    return _first(F.filter(names, lambda n: F.length(n).between(3, 60) & F.contains(n, F.lit(" "))), most)


def pick_venue(entities: Column, max_chars: int | None = None) -> Column:
    keyword = "|".join(VENUE_KEYWORDS)
    venues = F.filter(_entity_texts(entities, "ORG"), lambda o: F.lower(o).rlike(keyword))
    return _start(F.get(venues, F.lit(0)), max_chars)


def pick_year(entities: Column) -> Column:
    years = F.transform(F.filter(entities, lambda e: e.label == "DATE"), lambda e: F.regexp_extract(e.text, _YEAR, 1))
    return F.get(F.filter(years, lambda y: y != ""), F.lit(0)).cast("int")


def pattern_tier(df: DataFrame, text: str = "raw_text") -> DataFrame:
    t = F.col(text)
    out = df.withColumn("doi", first_doi(t)).withColumn("p_year", modal_year(t)).withColumn("p_title", title_candidate(t))
    return (
        out.withColumn("doi_confidence", F.when(F.col("doi").isNotNull(), DOI_SCORE).otherwise(0.0))
        .withColumn("year_confidence", F.when(F.col("p_year").isNotNull(), YEAR_SCORE).otherwise(0.0))
    )


def entity_tier(df: DataFrame, text: str = "raw_text", entities: str = "entities") -> DataFrame:
    e = F.col(entities)
    return (
        df.withColumn("e_title", header_title(F.col(text))).withColumn("e_authors", pick_authors(e))
        .withColumn("e_venue", pick_venue(e)).withColumn("e_year", pick_year(e))
    )


def registry_metadata(works: DataFrame) -> DataFrame:
    """Bibliographic registry records to (doi_key, r_title, r_authors, r_year, r_venue, r_abstract, r_publisher).

    The join key is the lower-cased DOI, one record per key; the year comes from the first of print, online and creation
    date that has one.
    """
    def year_of(field: str) -> Column:
        return F.get(F.get(F.col(f"`{field}`.`date-parts`"), F.lit(0)), F.lit(0))

    full_names = F.transform("author", lambda a: strip(
        F.concat(F.coalesce(a.given, F.lit("")), F.lit(" "), F.coalesce(a.family, F.lit("")))
    ))
    abstract = F.replace(F.replace(F.col("abstract"), F.lit("<jats:p>"), F.lit("")), F.lit("</jats:p>"), F.lit(""))
    rows = works.filter(F.col("DOI").isNotNull()).select(
        F.lower("DOI").alias("doi_key"),
        F.struct(
            F.get("title", F.lit(0)).alias("r_title"),
            F.filter(full_names, lambda n: n != "").alias("r_authors"),
            F.coalesce(year_of("published-print"), year_of("published-online"), year_of("created")).alias("r_year"),
            F.coalesce(F.get(F.col("`container-title`"), F.lit(0)), F.col("publisher")).alias("r_venue"),
            blank_to_null(strip(abstract)).alias("r_abstract"),
            F.col("publisher").alias("r_publisher"),
        ).alias("record"),
    )
    return rows.groupBy("doi_key").agg(F.min("record").alias("record")).select("doi_key", "record.*")


def with_registry(df: DataFrame, registry: DataFrame, row_key: str) -> DataFrame:
    """Left join on the DOI; adds `registry_found`.

    Rows without a DOI get a key of their own that cannot match. Otherwise they would all share the null key and meet in
    one shuffle partition.
    """
    spread = F.concat(F.lit("\u0000"), F.col(row_key).cast("string"))
    keyed = df.withColumn("doi_key", F.coalesce(F.lower("doi"), spread))
    found = registry.withColumn("registry_found", F.lit(True))
    return keyed.join(found, "doi_key", "left").withColumn("registry_found", F.coalesce("registry_found", F.lit(False))).drop("doi_key")


def weighted_confidence(authors: Column, title: Column, venue_year: Column) -> Column:
    return F.bround(authors * AUTHORS_WEIGHT + title * TITLE_WEIGHT + venue_year * VENUE_YEAR_WEIGHT, 4)


def confidence_consistent(score: Column, authors: Column, title: Column, venue_year: Column) -> Column:
    expected = authors * AUTHORS_WEIGHT + title * TITLE_WEIGHT + venue_year * VENUE_YEAR_WEIGHT
    return F.abs(score - expected) <= FORMULA_TOLERANCE


def merge_tiers(df: DataFrame) -> DataFrame:
    """Merge pattern, registry and entity tiers into title/authors/year/venue/abstract, part scores and tier label.

    A registry record decides alone (its gaps fall back to the pattern tier); otherwise entities fill what is missing.
    """
    found = F.col("registry_found")
    no_names = F.array().cast("array<string>")
    title = F.when(found, F.coalesce(blank_to_null(F.col("r_title")), F.col("p_title"))).otherwise(F.coalesce("p_title", "e_title"))
    authors = F.when(found, F.coalesce("r_authors", no_names)).otherwise(F.coalesce("e_authors", no_names))
    year = F.when(found, F.coalesce("r_year", "p_year")).otherwise(F.coalesce("p_year", "e_year"))
    out = (
        df.withColumn("title", title).withColumn("authors", authors).withColumn("year", year)
        .withColumn("venue", F.when(found, F.col("r_venue")).otherwise(F.col("e_venue")))
        .withColumn("abstract", F.when(found, F.col("r_abstract")))
        .withColumn("extraction_tier", F.when(found, "CROSSREF").otherwise("NLP"))
    )
    has_authors = F.size("authors") > 0
    title_score = (
        F.when(found, F.when(truthy(F.col("title")), REGISTRY_SCORE).otherwise(0.0))
        .when(truthy(F.col("p_title")), TITLE_LINE_SCORE).when(truthy(F.col("e_title")), ENTITY_SCORE).otherwise(0.0)
    )
    pattern_year = F.when(F.col("p_year").isNotNull(), YEAR_SCORE).otherwise(0.0)
    venue_year_score = F.when(
        found, F.when(truthy(F.col("venue")) | F.col("year").isNotNull(), REGISTRY_SCORE).otherwise(0.0)
    ).otherwise(F.when(truthy(F.col("e_venue")), F.greatest(pattern_year, F.lit(ENTITY_SCORE))).otherwise(pattern_year))
    return (
        out.withColumn("authors_score", F.when(has_authors, F.when(found, REGISTRY_SCORE).otherwise(ENTITY_SCORE)).otherwise(0.0))
        .withColumn("title_score", title_score).withColumn("venue_year_score", venue_year_score)
        .withColumn("confidence", weighted_confidence(F.col("authors_score"), F.col("title_score"), F.col("venue_year_score")))
    )


def fill_low_confidence(df: DataFrame, model_output: DataFrame, key: str = "idempotency_key", settings: Settings = DEFAULTS) -> DataFrame:
    """Rows below the gate take missing fields from a table of model answers, scores capped.

    Only rows below the gate are joined; the others pass by. `model_output` has one row per key. The tiers are materialised
    before the split, or both sides would run the text patterns again.
    """
    df = cut_lineage(df)
    cap = settings.gate_cap
    below = df.filter(F.col("confidence") < settings.gate_threshold)
    above = df.filter(~(F.col("confidence") < settings.gate_threshold)).withColumn("gate_used", F.lit(False))
    year = F.when(F.col("year").rlike(r"^\d+$"), F.col("year").cast("int"))
    names = F.coalesce("authors", F.array().cast("array<string>"))
    answers = model_output.select(
        key, F.col("title").alias("m_title"), names.alias("m_authors"), year.alias("m_year"),
        F.col("venue").alias("m_venue"), F.col("abstract").alias("m_abstract"), F.col("doi").alias("m_doi"),
        F.lit(True).alias("gate_used"),
    )
    present = lambda c: F.when(c, 1).otherwise(0)
    fields = (
        present(truthy(F.col("m_title"))) + present(F.size("m_authors") > 0)
        + present(F.coalesce(F.col("m_year") != 0, F.lit(False))) + present(truthy(F.col("m_venue")))
    )
    joined = below.join(answers, key, "left").withColumn("gate_used", F.coalesce("gate_used", F.lit(False)))
    joined = joined.withColumn("m_score", F.least(F.lit(GATE_BASE) + fields / 4 * GATE_SPAN, F.lit(cap)))
    used = F.col("gate_used")
    take_title = used & truthy(F.col("m_title")) & ~truthy(F.col("title"))
    take_authors = used & (F.size("m_authors") > 0) & (F.size("authors") == 0)
    take_venue = used & truthy(F.col("m_venue")) & ~truthy(F.col("venue"))
    filled = joined.select(
        *[c for c in df.columns if c not in (
            "title", "authors", "venue", "year", "doi", "abstract", "authors_score", "title_score", "venue_year_score",
            "confidence", "extraction_tier")],
        F.when(take_title, F.col("m_title")).otherwise(F.col("title")).alias("title"),
        F.when(take_authors, F.col("m_authors")).otherwise(F.col("authors")).alias("authors"),
        F.when(take_venue, F.col("m_venue")).otherwise(F.col("venue")).alias("venue"),
        F.when(used, F.coalesce("year", "m_year")).otherwise(F.col("year")).alias("year"),
        F.when(used, F.coalesce("doi", blank_to_null(F.col("m_doi")))).otherwise(F.col("doi")).alias("doi"),
        F.when(used, F.coalesce("abstract", blank_to_null(F.col("m_abstract")))).otherwise(F.col("abstract")).alias("abstract"),
        F.when(take_authors, F.col("m_score")).otherwise(F.col("authors_score")).alias("authors_score"),
        F.when(take_title, F.col("m_score")).otherwise(F.col("title_score")).alias("title_score"),
        F.when(take_venue, F.least(F.greatest("venue_year_score", "m_score"), F.lit(cap)))
        .otherwise(F.col("venue_year_score")).alias("venue_year_score"),
        F.when(used, "LLM").otherwise(F.col("extraction_tier")).alias("extraction_tier"),
        "gate_used",
    )
    parts = [F.col("authors_score"), F.col("title_score"), F.col("venue_year_score")]
    plain = weighted_confidence(*parts)
    capped = weighted_confidence(*[F.least(p, F.lit(cap)) for p in parts])
    scored = filled.withColumn("confidence", F.when(F.col("gate_used") & (plain > cap), capped).otherwise(plain))
    return above.unionByName(scored)


def extract(
    df: DataFrame, registry: DataFrame, model_output: DataFrame | None = None, key: str = "idempotency_key",
    text: str = "raw_text", settings: Settings = DEFAULTS,
) -> DataFrame:
    """The whole cascade over a table with `key`, `text` and `entities`. `registry` comes from `registry_metadata`."""
    tiers = entity_tier(pattern_tier(df, text), text)
    merged = merge_tiers(with_registry(tiers, registry, key))
    kept = [
        *df.columns, "doi", "title", "authors", "year", "venue", "abstract", "authors_score", "title_score",
        "venue_year_score", "confidence", "extraction_tier", "registry_found",
    ]
    merged = merged.select(*kept)
    if model_output is None:
        return merged.withColumn("gate_used", F.lit(False))
    return fill_low_confidence(merged, model_output, key, settings).select(*kept, "gate_used")


def integrity(text: Column, text_hash: Column, has_file: Column, file_hash: Column, recorded_file_hash: Column) -> Column:
    """struct<passed, text_hash_ok, file_hash_ok, failure_reason>. `file_hash` is null when the stored file is missing."""
    text_ok = F.coalesce(F.sha2(text, 256) == text_hash, F.lit(False))
    file_ok = ~has_file | F.coalesce(file_hash == recorded_file_hash, F.lit(False))
    missing = has_file & file_hash.isNull()
    reasons = F.concat_ws(
        " ",
        F.when(missing, F.lit("file_missing")),
        F.when(~text_ok, F.lit("text_hash_mismatch")),
        F.when(~file_ok & ~missing & text_ok, F.lit("file_checksum_mismatch")),
    )
    return F.struct(
        (text_ok & file_ok).alias("passed"), text_ok.alias("text_hash_ok"), file_ok.alias("file_hash_ok"),
        blank_to_null(reasons).alias("failure_reason"),
    )
