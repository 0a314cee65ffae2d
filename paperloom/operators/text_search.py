"""Keyword search over title and venue: postings, plain and web-style queries, cover-density rank, highlights.

Queries come as a DataFrame (`query_id`, `query_text`), so a batch of requests is one job. Matching is an equi join of
postings and query words on the term; there is no document-by-query product. Per (query, paper) state is a few numbers a word of the
query; see `text_index` for stored postings of whole texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paperloom.functions.columns import strip
from paperloom.functions.english import WHOLE_WORDS, append_positions, positioned, stem, tokens
from paperloom.session import cut_lineage
from paperloom.settings import DEFAULTS, Settings

# Position weights and highlight markers.
PLAIN_WEIGHT = 0.1
TITLE_WEIGHT = 1.0
VENUE_WEIGHT = 0.4
MARK_OPEN, MARK_CLOSE = "<mark>", "</mark>"
HEADLINE_MAX_WORDS = 20
HEADLINE_MIN_WORDS = 5


def sanitise(c: Column, max_chars: int | None = None) -> Column:
    """`;` and control characters become blanks, runs of whitespace one blank, ends trimmed, then cut to `max_chars` if given. The
    searches below keep the whole text."""
    cleaned = F.regexp_replace(F.coalesce(c, F.lit("")), r"[;\x00-\x1f\x7f]", " ")
    whole = strip(F.regexp_replace(cleaned, r"(?U)\s+", " "))
    return whole if max_chars is None else F.substring(whole, 1, max_chars)


def postings(papers: DataFrame, key: str = "paper_id", weighted: bool = False, stemmed: bool = True) -> DataFrame:
    """One row per kept word occurrence: (key, term, pos, weight).

    `weighted` gives title words 1.0 and venue words 0.4; otherwise both form one text of uniform weight. Build once and
    store next to the papers when many searches follow.
    """
    if weighted:
        words = append_positions(positioned(F.col("title"), TITLE_WEIGHT), positioned(F.col("venue"), VENUE_WEIGHT))
    else:
        words = positioned(searchable_text(), PLAIN_WEIGHT)
    rows = papers.select(key, F.explode(words).alias("w")).select(key, "w.term", "w.pos", "w.weight")
    return stem(rows) if stemmed else rows


def searchable_text() -> Column:
    return F.concat(F.col("title"), F.lit(" "), F.coalesce(F.col("venue"), F.lit("")))


def plain_queries(queries: DataFrame, stemmed: bool = True) -> DataFrame:
    """Query words for an all-words-required query: one group, every word its own item."""
    items = F.transform(
        positioned(sanitise(F.col("query_text")), PLAIN_WEIGHT),
        lambda w: F.struct(
            F.lit(0).alias("grp"), w.pos.alias("item"), F.lit(False).alias("negated"), F.lit(0).alias("offset"),
            F.lit(1).alias("n_words"), w.term.alias("term"),
        ),
    )
    return _finish_queries(queries, items, stemmed)


def web_queries(queries: DataFrame, stemmed: bool = True) -> DataFrame:
    """Query words for web-style text: `"a b"` is a phrase, `or` starts an alternative group, `-x` excludes.

    Pure column expressions over the query table. A group whose only items are exclusions selects nothing.
    """
    pieces = F.regexp_extract_all(F.lower(sanitise(F.col("query_text"))), F.lit(r'(-?"[^"]*"|[^\s"]+)'), F.lit(1))

    def words_of(piece: Column, at: Column) -> Column:
        kept = positioned(piece, PLAIN_WEIGHT)
        base = F.coalesce(F.array_min(F.transform(kept, lambda w: w.pos)), F.lit(0))
        group = F.size(F.filter(F.slice(F.col("pieces"), 1, at + 1), lambda p: p == "or"))
        return F.when(piece == "or", F.array_repeat(F.lit(None), 0)).otherwise(
            F.transform(
                kept,
                lambda w: F.struct(
                    group.alias("grp"), at.alias("item"), piece.startswith("-").alias("negated"),
                    (w.pos - base).alias("offset"), F.size(kept).alias("n_words"), w.term.alias("term"),
                ),
            )
        )

    split = queries.withColumn("pieces", pieces)
    return _finish_queries(split, F.flatten(F.transform(F.col("pieces"), words_of)), stemmed)


def _finish_queries(queries: DataFrame, items: Column, stemmed: bool) -> DataFrame:
    rows = queries.select("query_id", F.explode(items).alias("i")).select("query_id", "i.*")
    rows = stem(rows) if stemmed else rows
    per_group = Window.partitionBy("query_id", "grp")
    needed = F.size(F.collect_set(F.when(~F.col("negated"), F.col("item"))).over(per_group))
    return rows.withColumn("needed_items", needed)


def occurrences(index: DataFrame, words: DataFrame) -> DataFrame:
    """Postings of query words: the equi join on the term. Both matching and ranking read its (much smaller) result."""
    return index.join(words, "term")


def head_filter(index: DataFrame, words: DataFrame) -> DataFrame:
    """Unstemmed postings that can possibly stem to one of `words`.

    No stemming rule changes a word's first two letters, but for a few whole-word exceptions, whose heads are added. So words
    with another head need not be stemmed at all. There are few distinct heads, whatever the number of queries.
    """
    spark = words.sparkSession
    special = sorted({w[:2] for w, s in WHOLE_WORDS.items() if w[:2] != s[:2]})
    heads = words.select(F.substring("term", 1, 2).alias("head")).distinct()
    heads = heads.union(spark.createDataFrame([(h,) for h in special], "head string")).distinct()
    head = F.substring("term", 1, 2)
    single = heads.filter(F.length("head") == 1)
    both = index.withColumn("head", head).join(heads, "head", "left_semi").drop("head")
    one = index.withColumn("head", F.substring("term", 1, 1)).join(single, "head", "left_semi").drop("head")
    return both.unionByName(one.filter(F.length("term") > 1))


def matches(found: DataFrame, key: str = "paper_id") -> DataFrame:
    """(query_id, key) pairs whose paper satisfies at least one group of the query, from `occurrences`.

    A word sequence matches where all its words sit at one common base position; the first aggregation runs on
    (query, item, paper, base), so a frequent term is pre-aggregated per paper and never gathered by term.
    """
    at_base = (
        found.groupBy("query_id", "grp", "item", "negated", "n_words", "needed_items", key, (F.col("pos") - F.col("offset")).alias("base"))
        .agg(F.count("*").alias("found"))
        .filter(F.col("found") == F.col("n_words"))
    )
    per_group = at_base.groupBy("query_id", "grp", "needed_items", key).agg(
        F.count_distinct(F.when(~F.col("negated"), F.col("item"))).alias("have"), F.bool_or("negated").alias("excluded")
    )
    satisfied = per_group.filter((F.col("have") == F.col("needed_items")) & ~F.col("excluded"))
    return satisfied.select("query_id", key).distinct()


def cover_rank(found: DataFrame, words: DataFrame, hits: DataFrame, key: str = "paper_id") -> DataFrame:
    """Cover-density rank of every hit: (query_id, key, rank).

    A cover is a shortest stretch of positions that satisfies a group. Each adds (occurrences / sum of 1/weight) divided by 1 + the
    number of other words inside it. One sweep over a paper's occurrences in order of position: running windows hold, for each word of
    the query, the place of its last occurrence and the sums up to it, so the work grows with the occurrences. `words` is read once
    before, for the largest number of words in a query.
    """
    wanted = words.filter(~F.col("negated")).select("query_id", "grp", "term").distinct()
    numbered = wanted.select("query_id", "term").distinct().withColumn("number", F.row_number().over(Window.partitionBy("query_id").orderBy("term")) - 1)
    most = numbered.agg(F.max("number")).first()[0]
    groups = (
        wanted.join(numbered, ["query_id", "term"]).groupBy("query_id", "grp").agg(F.sort_array(F.collect_list("number")).alias("numbers"))
        .groupBy("query_id").agg(F.sort_array(F.collect_list("numbers")).alias("groups"))
    )
    occ = found.filter(~F.col("negated")).join(hits, ["query_id", key], "left_semi").select("query_id", key, "pos", "term", "weight").distinct()
    occ = occ.join(numbered, ["query_id", "term"]).join(groups, "query_id")
    in_order = Window.partitionBy("query_id", key).orderBy("pos")
    so_far = in_order.rowsBetween(Window.unboundedPreceding, 0)
    inverse = F.lit(1.0) / F.col("weight")
    occ = occ.withColumn("upto", F.count("*").over(so_far)).withColumn("inverse_upto", F.sum(inverse).over(so_far))
    here = F.struct("pos", (F.col("upto") - 1).alias("before"), (F.col("inverse_upto") - inverse).alias("inverse_before"))
    last = [F.max(F.when(F.col("number") == k, here)).over(so_far) for k in range((most or 0) + 1)]
    occ = occ.withColumn("last", F.array(*last))

    def group_begin(numbers: Column) -> Column:
        seen = F.transform(numbers, lambda k: F.get("last", k))
        return F.when(~F.exists(seen, lambda x: x.isNull()), F.array_min(seen))

    occ = occ.withColumn("begin", F.array_max(F.transform("groups", group_begin)))
    occ = occ.withColumn("previous", F.lag("begin.pos").over(in_order))
    covers = occ.filter(F.col("begin").isNotNull() & (F.col("previous").isNull() | (F.col("begin.pos") > F.col("previous"))))
    inside = F.col("upto") - F.col("begin.before")
    other = (F.col("pos") - F.col("begin.pos")) - (inside - 1)
    score = inside / (F.col("inverse_upto") - F.col("begin.inverse_before")) / (1 + other)
    return covers.groupBy("query_id", key).agg(F.sum(score).alias("rank"))


def top_per_query(scored: DataFrame, limit: int | None, score: str = "rank", key: str = "paper_id", offset: int = 0) -> DataFrame:
    """Best rows per query (all if `limit` is None) with their 1-based `position`; ties go to the smaller key.

    Spark turns the row-number filter into a per-partition group limit, so only `limit` rows per query and partition
    travel.
    """
    w = Window.partitionBy("query_id").orderBy(F.desc(score), F.asc(key))
    ranked = scored.withColumn("position", F.row_number().over(w))
    ranked = ranked if limit is None else ranked.filter(F.col("position") <= limit + offset)
    ranked = ranked.withColumn("position", F.col("position").cast("bigint"))
    return ranked.filter(F.col("position") > offset) if offset else ranked


def headline(rows: DataFrame, words: DataFrame, key: str = "paper_id", stemmed: bool = True) -> DataFrame:
    """Add `highlight_snippet` to result rows (query_id, key, title, venue): up to 20 words around the first match,
    every matching word wrapped in `<mark>`. Meant for rows already cut to a result page.
    """
    terms = words.filter(~F.col("negated")).groupBy("query_id").agg(F.collect_set("term").alias("wanted"))
    text_words = F.filter(F.split(searchable_text(), r"\s+"), lambda w: w != "")
    exploded = (
        rows.select("query_id", key, F.posexplode(text_words).alias("at", "word"))
        .select("query_id", key, "at", "word", F.posexplode_outer(tokens(F.col("word"))).alias("sub", "term"))
    )
    exploded = stem(exploded) if stemmed else exploded
    per_word = (
        exploded.join(terms, "query_id").groupBy("query_id", key, "at", "word")
        .agg(F.bool_or(F.coalesce(F.array_contains("wanted", F.col("term")), F.lit(False))).alias("hit"))
    )
    gathered = per_word.groupBy("query_id", key).agg(F.sort_array(F.collect_list(F.struct("at", "word", "hit"))).alias("ws"))
    first_hit = F.coalesce(F.array_min(F.transform(F.filter("ws", lambda w: w.hit), lambda w: w.at)), F.lit(0))
    start = F.greatest(F.lit(0), F.least(first_hit, F.size("ws") - HEADLINE_MIN_WORDS))
    shown = F.transform(
        F.slice(F.col("ws"), start + 1, F.lit(HEADLINE_MAX_WORDS)),
        lambda w: F.when(w.hit, F.concat(F.lit(MARK_OPEN), w.word, F.lit(MARK_CLOSE))).otherwise(w.word),
    )
    snippet = gathered.select("query_id", key, F.array_join(shown, " ").alias("highlight_snippet"))
    return rows.join(snippet, ["query_id", key], "left")


def facet_filters(
    papers: DataFrame, year: int | None = None, paper_type: str | None = None, min_confidence: float | None = None,
    department_code: str | None = None, status: str | None = None, faculty_id: str | None = None,
) -> DataFrame:
    """Optional exact filters; each is a plain comparison that reaches the Parquet scan."""
    exact = {
        "year": year, "paper_type": paper_type, "department_code": department_code, "status": status,
        "faculty_id": faculty_id,
    }
    for column, value in exact.items():
        if value is not None:
            papers = papers.filter(F.col(column) == value)
    if min_confidence is not None:
        papers = papers.filter(F.col("overall_confidence") >= min_confidence)
    return papers


def keyword_search(
    papers: DataFrame, queries: DataFrame, limit: int | None = 20, offset: int = 0, stemmed: bool = True, web: bool = True,
    weighted: bool = False, status: str = "PUBLISHED", index: DataFrame | None = None, **filters,
) -> DataFrame:
    """Search a batch of queries: top rows per query with `rank`, `position` and the query's `total`.

    `web=False, weighted=True` is the storage-side variant (all words required, title over venue). `index` may be a stored
    postings table; it is then semi-joined with the filtered papers.
    """
    scope = facet_filters(papers, status=status, **filters)
    words = cut_lineage((web_queries if web else plain_queries)(queries, stemmed))
    if index is None:
        index = postings(scope, weighted=weighted, stemmed=False)
        index = stem(head_filter(index, words)) if stemmed else index
        found = occurrences(index, words)
    else:
        found = occurrences(index, words).join(scope.select("paper_id"), "paper_id", "left_semi")
    found = cut_lineage(found)
    hits = matches(found)
    totals = hits.groupBy("query_id").agg(F.count("*").alias("total"))
    page = top_per_query(cover_rank(found, words, hits), limit, offset=offset)
    return page.join(totals, "query_id")
