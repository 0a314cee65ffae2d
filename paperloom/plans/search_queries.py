"""Keyword, semantic and hybrid search over all papers."""

from __future__ import annotations

from pyspark.sql import functions as F

from paperloom.functions.english import STOP_WORDS
from paperloom.operators import fusion, search_requests as requested, text_index, text_search, vector_index, vector_search
from paperloom.plans import derived as d
from paperloom.plans.catalog import query
from paperloom.plans.derived_sql import sql
from paperloom.session import scratch_path

REQUESTS = [
    (1, "attion eriner"), (2, '"Eriner Thanea"'), (3, "attion or thble -journal"), (4, "journal; src1"), (5, "the of"),
    (6, '"conference on src5" or thanea'), (7, "tion the thble attion"),
]
# The same requests, split by hand: (query_id, grp, item, negated, offset, n_words, term)
_WEB_WORDS = """(1, 0, 0, false, 0, 1, 'attion'), (1, 0, 1, false, 0, 1, 'eriner'), (2, 0, 0, false, 0, 2, 'eriner'), (2, 0, 0, false, 1, 2, 'thanea'),
    (3, 0, 0, false, 0, 1, 'attion'), (3, 1, 2, false, 0, 1, 'thble'), (3, 1, 3, true, 0, 1, 'journal'), (4, 0, 0, false, 0, 1, 'journal'), (4, 0, 1, false, 0, 1, 'src1'),
    (6, 0, 0, false, 0, 2, 'conference'), (6, 0, 0, false, 2, 2, 'src5'), (6, 1, 2, false, 0, 1, 'thanea'), (7, 0, 0, false, 0, 1, 'tion'), (7, 0, 2, false, 0, 1, 'thble'), (7, 0, 3, false, 0, 1, 'attion')"""
_PLAIN_WORDS = """(1, 0, 1, false, 0, 1, 'attion'), (1, 0, 2, false, 0, 1, 'eriner'), (2, 0, 1, false, 0, 1, 'eriner'), (2, 0, 2, false, 0, 1, 'thanea'), (3, 0, 1, false, 0, 1, 'attion'),
    (3, 0, 3, false, 0, 1, 'thble'), (3, 0, 4, false, 0, 1, 'journal'), (4, 0, 1, false, 0, 1, 'journal'), (4, 0, 2, false, 0, 1, 'src1'), (6, 0, 1, false, 0, 1, 'conference'),
    (6, 0, 3, false, 0, 1, 'src5'), (6, 0, 5, false, 0, 1, 'thanea'), (7, 0, 1, false, 0, 1, 'tion'), (7, 0, 3, false, 0, 1, 'thble'), (7, 0, 4, false, 0, 1, 'attion')"""
_COLUMNS = "(query_id, grp, item, negated, offs, n_words, term)"
_STOPS = ", ".join(f"'{w}'" for w in STOP_WORDS)


def _positions(text: str, weight: float) -> str:
    tokens = rf"list_filter(string_split_regex(lower({text}), '[^\p{{L}}\p{{N}}]+'), lambda t: t <> '')"
    return f"""SELECT paper_id, term, CAST(pos AS INTEGER) AS pos, {weight} AS weight FROM (
      SELECT paper_id, unnest({tokens}) AS term, generate_subscripts({tokens}, 1) AS pos FROM scope) WHERE term NOT IN ({_STOPS})"""


_SCOPE = "SELECT * FROM papers WHERE status = 'PUBLISHED'"
_PLAIN_INDEX = _positions("concat(title, ' ', coalesce(venue, ''))", 0.1)
_WEIGHTED_INDEX = f"""
    SELECT * FROM ({_positions('title', 1.0)}) UNION ALL
    SELECT v.paper_id, v.term, v.pos + coalesce(t.last_pos, 0), v.weight FROM ({_positions("coalesce(venue, '')", 0.4)}) v
      LEFT JOIN (SELECT paper_id, max(pos) AS last_pos FROM ({_positions('title', 1.0)}) GROUP BY paper_id) t USING (paper_id)"""
_AT_BASE = """
    SELECT query_id, grp, item, negated, paper_id FROM postings JOIN words USING (term)
    GROUP BY query_id, grp, item, negated, n_words, paper_id, pos - offs HAVING count(*) = n_words"""
_HITS = """
    SELECT DISTINCT query_id, paper_id FROM (
      SELECT query_id, grp, paper_id, count(DISTINCT item) FILTER (NOT negated) AS have, bool_or(negated) AS excluded FROM at_base GROUP BY ALL)
    JOIN (SELECT query_id, grp, count(DISTINCT item) AS needed FROM words WHERE NOT negated GROUP BY ALL) USING (query_id, grp) WHERE have = needed AND NOT excluded"""
_OCC = "SELECT DISTINCT query_id, paper_id, pos, term, weight FROM postings JOIN words USING (term) JOIN hits USING (query_id, paper_id) WHERE NOT negated"
_ENDS = """
    SELECT e.query_id, e.paper_id, e.pos, w.grp, CASE WHEN count(*) = count(o.last_pos) THEN min(o.last_pos) END AS group_begin
    FROM occ e JOIN (SELECT DISTINCT query_id, grp, term FROM words WHERE NOT negated) w ON w.query_id = e.query_id
    LEFT JOIN LATERAL (SELECT max(o.pos) AS last_pos FROM occ o WHERE o.query_id = e.query_id AND o.paper_id = e.paper_id AND o.term = w.term AND o.pos <= e.pos) o ON true
    GROUP BY ALL"""
_COVERS = """
    SELECT * FROM (SELECT query_id, paper_id, pos AS e, b, lag(b) OVER (PARTITION BY query_id, paper_id ORDER BY pos) AS previous FROM (
      SELECT query_id, paper_id, pos, max(group_begin) AS b FROM ends GROUP BY ALL)) WHERE b IS NOT NULL AND (previous IS NULL OR b > previous)"""
_RANKED = """
    SELECT query_id, paper_id, sum(part) AS rank FROM (
      SELECT c.query_id, c.paper_id, c.e, count(*) / sum(1.0 / CAST(o.weight AS DOUBLE)) / (1 + (c.e - c.b) - (count(*) - 1)) AS part
      FROM covers c JOIN occ o ON o.query_id = c.query_id AND o.paper_id = c.paper_id AND o.pos BETWEEN c.b AND c.e GROUP BY c.query_id, c.paper_id, c.e, c.b) GROUP BY ALL"""


def _search_ctes(index: str, words: str, scope: str = _SCOPE) -> dict[str, str]:
    return {
        "scope": scope, "postings": index, "words": f"SELECT * REPLACE (CAST(query_id AS BIGINT) AS query_id) FROM (VALUES {words}) t{_COLUMNS}", "at_base": _AT_BASE, "hits": _HITS, "occ": _OCC, "ends": _ENDS,
        "covers": _COVERS, "ranked": _RANKED,
        "keyword_page": """SELECT * FROM (SELECT query_id, paper_id, rank, row_number() OVER (PARTITION BY query_id ORDER BY round(rank, 9) DESC, paper_id) AS position,
          count(*) OVER (PARTITION BY query_id) AS total FROM ranked)""",
    }


_RESULT = "SELECT query_id, paper_id, round(rank, 6) AS rank, position, total FROM keyword_page WHERE position <= {limit}"


def requests(spark):
    return spark.createDataFrame(REQUESTS, "query_id bigint, query_text string")


def shown_rank(df):
    return df.select("query_id", "paper_id", F.round("rank", 6).alias("rank"), "position", "total")


@query("keyword_web", sql(_RESULT.format(limit=20), "papers", **_search_ctes(_PLAIN_INDEX, _WEB_WORDS)))
def keyword_web(spark, sf):
    return shown_rank(text_search.keyword_search(d.papers(spark, sf), requests(spark), limit=20, stemmed=False))


@query("keyword_weighted", sql(_RESULT.format(limit=20), "papers", **_search_ctes(_WEIGHTED_INDEX, _PLAIN_WORDS)))
def keyword_weighted(spark, sf):
    return shown_rank(text_search.keyword_search(d.papers(spark, sf), requests(spark), limit=20, stemmed=False, web=False, weighted=True))


@query("keyword_filtered", sql(_RESULT.format(limit=10), "papers", **_search_ctes(
    _PLAIN_INDEX, _WEB_WORDS, _SCOPE + " AND paper_type = 'journal' AND overall_confidence >= 0.3")))
def keyword_filtered(spark, sf):
    found = text_search.keyword_search(d.papers(spark, sf), requests(spark), limit=10, stemmed=False, paper_type="journal", min_confidence=0.3)
    return shown_rank(found)


@query("keyword_match", sql("SELECT query_id, paper_id FROM hits", "papers", **_search_ctes(_PLAIN_INDEX, _WEB_WORDS, "SELECT * FROM papers")))
def keyword_match(spark, sf):
    index = text_search.postings(d.papers(spark, sf), stemmed=False)
    return text_search.matches(text_search.occurrences(index, text_search.web_queries(requests(spark), stemmed=False)))


@query("keyword_stemmed")
def keyword_stemmed(spark, sf):
    return shown_rank(text_search.keyword_search(d.papers(spark, sf), requests(spark), limit=20))


@query("search_terms", sql("SELECT paper_id, term, pos FROM postings", "papers", scope="SELECT * FROM papers", postings=_PLAIN_INDEX))
def search_terms(spark, sf):
    return text_search.postings(d.papers(spark, sf), stemmed=False).select("paper_id", "term", "pos")


_WORD_HITS = r"""
    SELECT k.query_id, k.paper_id, w.word_no, w.word, bool_or(coalesce(x.term IS NOT NULL, false)) AS hit
    FROM keyword_page k JOIN (SELECT paper_id, unnest(ws) AS word, generate_subscripts(ws, 1) - 1 AS word_no FROM (
      SELECT paper_id, list_filter(string_split_regex(concat(title, ' ', coalesce(venue, '')), '\s+'), lambda t: t <> '') AS ws FROM papers)) w USING (paper_id)
    LEFT JOIN (SELECT DISTINCT query_id, term FROM words WHERE NOT negated) x ON x.query_id = k.query_id AND list_contains(string_split_regex(lower(w.word), '[^\p{L}\p{N}]+'), x.term)
    WHERE k.position <= 10 GROUP BY ALL"""


@query("headline", sql("""
    SELECT query_id, paper_id, string_agg(CASE WHEN hit THEN concat('<mark>', word, '</mark>') ELSE word END, ' ' ORDER BY word_no) AS highlight_snippet FROM (
      SELECT *, greatest(0, least(min(word_no) FILTER (hit) OVER w, count(*) OVER w - 5)) AS start FROM word_hits WINDOW w AS (PARTITION BY query_id, paper_id))
    WHERE word_no >= start AND word_no < start + 20 GROUP BY ALL""", "papers", **_search_ctes(_PLAIN_INDEX, _WEB_WORDS), word_hits=_WORD_HITS))
def headline(spark, sf):
    papers = d.papers(spark, sf)
    words = text_search.web_queries(requests(spark), stemmed=False)
    page = text_search.keyword_search(papers, requests(spark), limit=10, stemmed=False)
    rows = page.join(papers.select("paper_id", "title", "venue"), "paper_id")
    return text_search.headline(rows, words, stemmed=False).select("query_id", "paper_id", "highlight_snippet")


def _similar(threshold: float, where: str = "") -> str:
    return f"""
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, paper_id) AS position, count(*) OVER (PARTITION BY query_id) AS total FROM (
      SELECT c.query_id, v.paper_id, round(list_cosine_similarity(CAST(v.embedding AS DOUBLE[]), c.embedding), 9) AS similarity FROM vectors v CROSS JOIN seeds c
      WHERE v.status = 'PUBLISHED' AND v.embedding IS NOT NULL {where}) WHERE similarity >= {threshold}"""


@query("semantic_topk", sql("SELECT query_id, paper_id, round(similarity, 6) AS similarity, position, total FROM similar_rows WHERE position <= 20", "vectors", "seeds", similar_rows=_similar(0.5)))
def semantic_topk(spark, sf):
    found = vector_search.semantic_search(d.papers_with_vectors(spark, sf), d.label_seeds(spark, sf), digits=9)
    return found.withColumn("similarity", F.round("similarity", 6))


@query("semantic_filtered", sql("SELECT query_id, paper_id, round(similarity, 6) AS similarity, position, total FROM similar_rows WHERE position <= 10", "vectors", "seeds",
                                similar_rows=_similar(0.1, "AND v.year BETWEEN 2010 AND 2010")))
def semantic_filtered(spark, sf):
    found = vector_search.semantic_search(d.papers_with_vectors(spark, sf), d.label_seeds(spark, sf), threshold=0.1, limit=10, digits=9, year=2010)
    return found.withColumn("similarity", F.round("similarity", 6))


@query("semantic_by_distance", sql("""
    SELECT query_id, paper_id, round(1 - similarity, 6) AS distance, position FROM similar_rows WHERE position <= 10""", "vectors", "seeds", similar_rows=_similar(0.7, "AND v.department_code = 'CSE'")))
def semantic_by_distance(spark, sf):
    found = vector_search.nearest_by_distance(d.papers_with_vectors(spark, sf), d.label_seeds(spark, sf), department_code="CSE", digits=9)
    return found.select("query_id", "paper_id", F.round("distance", 6).alias("distance"), "position")


@query("nearest_indexed", """
    SELECT query_id, paper_id, round(similarity, 6) AS similarity, position FROM (
      SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, paper_id) AS position FROM (
        SELECT q.vec_id AS query_id, v.vec_id AS paper_id, round(list_cosine_similarity(CAST(v.embedding AS DOUBLE[]), CAST(q.embedding AS DOUBLE[])), 9) AS similarity
        FROM embeddings v CROSS JOIN embeddings q WHERE q.vec_id % 50 = 0) WHERE similarity >= 0.3) WHERE position <= 10""")
def nearest_indexed(spark, sf):
    """Every fiftieth vector against all of them by a stored index of cells, written once and then read."""
    path = scratch_path(spark, "vector-index")
    vectors = d.table(spark, sf, "embeddings").select(F.col("vec_id").alias("paper_id"), "embedding")
    dim = vectors.agg(F.max(F.size("embedding"))).first()[0] or 1
    vector_index.write_index(vector_index.build_index(vectors, dim), path)
    asked = vectors.filter("paper_id % 50 = 0").withColumnRenamed("paper_id", "query_id")
    found = vector_index.nearest(vector_index.read_index(spark, path), asked, limit=10, threshold=0.3, digits=9)
    return found.select("query_id", "paper_id", F.round("similarity", 6).alias("similarity"), "position")


@query("cosine_to_centroid", sql("SELECT paper_id, round(list_cosine_similarity(CAST(v.embedding AS DOUBLE[]), c.embedding), 6) AS similarity FROM vectors v JOIN centroids c ON c.query_id = v.label", "vectors", "centroids"))
def cosine_to_centroid(spark, sf):
    centroids = d.label_centroids(spark, sf).select(F.col("query_id").alias("label"), F.col("embedding").alias("centre"))
    rows = d.papers_with_vectors(spark, sf).join(centroids, "label")
    return rows.select("paper_id", F.round(vector_search.cosine(F.col("embedding"), F.col("centre")), 6).alias("similarity"))


# Each label asks for one text and its first vector.
_HYBRID_WORDS = """SELECT CAST(label AS BIGINT) AS query_id, 0 AS grp, item, false AS negated, 0 AS offs, 1 AS n_words, term FROM (SELECT DISTINCT label FROM embeddings)
    JOIN (VALUES (0, 0, 'attion'), (1, 0, 'thble'), (2, 0, 'journal'), (3, 0, 'tion')) t(kind, item, term) ON label % 4 = kind"""
_FUSED = """
    SELECT *, fused_score / max(fused_score) OVER (PARTITION BY query_id) AS relevance_score, row_number() OVER (PARTITION BY query_id ORDER BY fused_score DESC, paper_id) AS position,
      count(*) OVER (PARTITION BY query_id) AS total FROM (
      SELECT coalesce(k.query_id, s.query_id) AS query_id, coalesce(k.paper_id, s.paper_id) AS paper_id, CASE WHEN k.position IS NOT NULL AND (s.position IS NULL OR k.position < s.position) THEN 'keyword' ELSE 'semantic' END AS dominant_mode,
        coalesce(1.0::DOUBLE / (60 + k.position), 0) + coalesce(1.0::DOUBLE / (60 + s.position), 0) AS fused_score, k.position AS keyword_position, s.position AS semantic_position
      FROM keyword_page k FULL JOIN similar_rows s ON s.query_id = k.query_id AND s.paper_id = k.paper_id)"""


def _hybrid_ctes() -> dict[str, str]:
    ctes = _search_ctes(_PLAIN_INDEX, _PLAIN_WORDS, "SELECT * FROM vectors WHERE status = 'PUBLISHED'")
    ctes["words"] = _HYBRID_WORDS
    return {**ctes, "similar_rows": _similar(0.3), "fused": _FUSED}


def hybrid_requests(spark, sf):
    text = d.pick(F.col("query_id") % 4, "attion", "thble", "journal", "tion")
    return d.label_seeds(spark, sf).withColumn("query_text", text)


@query("hybrid_search", sql("SELECT query_id, paper_id, round(relevance_score, 6) AS relevance_score, dominant_mode, position, total FROM fused WHERE position <= 20", "vectors", "seeds", **_hybrid_ctes()))
def hybrid_search(spark, sf):
    found = fusion.hybrid_search(d.papers_with_vectors(spark, sf), hybrid_requests(spark, sf), limit=20, stemmed=False, digits=9)
    return found.select("query_id", "paper_id", F.round("relevance_score", 6).alias("relevance_score"), "dominant_mode", "position", "total")


@query("rrf_fuse", """
    WITH k AS (SELECT user_id AS query_id, event_id AS paper_id, row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) AS position FROM events),
      s AS (SELECT user_id AS query_id, event_id AS paper_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS position FROM events),
      f AS (SELECT coalesce(k.query_id, s.query_id) AS query_id, coalesce(k.paper_id, s.paper_id) AS paper_id, k.position AS kp, s.position AS sp,
        coalesce(1.0::DOUBLE / (60 + k.position), 0) + coalesce(1.0::DOUBLE / (60 + s.position), 0) AS score
        FROM (SELECT * FROM k WHERE position <= 40) k FULL JOIN (SELECT * FROM s WHERE position <= 40) s ON s.query_id = k.query_id AND s.paper_id = k.paper_id)
    SELECT query_id, paper_id, round(score / max(score) OVER (PARTITION BY query_id), 6) AS relevance_score, CASE WHEN kp IS NOT NULL AND (sp IS NULL OR kp < sp) THEN 'keyword' ELSE 'semantic' END AS dominant_mode,
      row_number() OVER (PARTITION BY query_id ORDER BY score DESC, paper_id) AS position FROM f""")
def rrf_fuse(spark, sf):
    """Two rankings of every user's events: by value and by time."""
    events = d.table(spark, sf, "events").select(F.col("user_id").alias("query_id"), F.col("event_id").alias("paper_id"), "value", (-F.unix_micros(F.col("ts").cast("timestamp"))).alias("recent"))
    keyword = text_search.top_per_query(events, 40, score="value")
    semantic = text_search.top_per_query(events, 40, score="recent")
    fused = fusion.fuse(keyword, semantic)
    return fused.select("query_id", "paper_id", F.round("relevance_score", 6).alias("relevance_score"), "dominant_mode", "position")


_BATCH = """
    SELECT query_id, 'keyword' AS search_mode, position, paper_id, round(greatest(least(rank, 1.0), 0.0), 6) AS relevance_score, total FROM keyword_page WHERE position <= 10 AND query_id % 3 = 0
    UNION ALL SELECT query_id, 'semantic', position, paper_id, round(greatest(least(similarity, 1.0), 0.0), 6), total FROM loose WHERE position <= 10 AND query_id % 3 = 1
    UNION ALL SELECT query_id, 'hybrid', position, paper_id, round(relevance_score, 6), total FROM fused WHERE position <= 10 AND query_id % 3 = 2"""


@query("search_requests", sql(_BATCH, "vectors", "seeds", **_hybrid_ctes(), loose=_similar(0.5)))
def search_requests(spark, sf):
    """A table of requests in three modes, one per label."""
    asked = hybrid_requests(spark, sf).withColumn("mode", d.pick(F.col("query_id") % 3, "keyword", "semantic", "hybrid"))
    found = fusion.search_batch(d.papers_with_vectors(spark, sf), asked, limit=10, stemmed=False)
    return found.select("query_id", "search_mode", "position", "paper_id", F.round("relevance_score", 6).alias("relevance_score"), "total")


# A request a label: users of all roles and departments, filters here and there, some without a context.
_ASKED = """
    SELECT query_id, CASE query_id % 3 WHEN 0 THEN 'keyword' WHEN 1 THEN 'semantic' ELSE 'hybrid' END AS mode,
      CASE query_id % 5 WHEN 0 THEN 'admin' WHEN 1 THEN 'hod' WHEN 2 THEN 'coordinator' WHEN 3 THEN 'faculty' END AS role,
      CASE query_id % 4 WHEN 0 THEN 'CSE' WHEN 1 THEN 'ECE' WHEN 2 THEN 'MECH' ELSE 'CIVIL' END AS user_department, CAST(1 + query_id % 40 AS VARCHAR) AS user_id,
      CASE WHEN query_id % 6 = 4 THEN 2010 END AS year, CASE WHEN query_id % 7 = 2 THEN 'journal' END AS paper_type,
      CASE WHEN query_id % 8 = 3 THEN 'DRAFT' END AS status, CASE WHEN query_id % 4 = 2 THEN 0.3 END AS min_confidence, 5 + query_id % 9 AS page_size
    FROM seeds"""
_ALLOWED = """
    SELECT r.query_id, v.paper_id FROM asked r CROSS JOIN vectors v
    WHERE v.status = coalesce(r.status, 'PUBLISHED') AND (r.year IS NULL OR v.year = r.year) AND (r.paper_type IS NULL OR v.paper_type = r.paper_type)
      AND (r.min_confidence IS NULL OR v.overall_confidence >= r.min_confidence) AND r.role IS NOT NULL
      AND (r.role = 'admin' OR (v.department_code = r.user_department AND (v.status <> 'DRAFT' OR CAST(v.faculty_id AS VARCHAR) = r.user_id)))"""
_CLOSE = """
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, paper_id) AS position, count(*) OVER (PARTITION BY query_id) AS total FROM (
      SELECT c.query_id, v.paper_id, round(list_cosine_similarity(CAST(v.embedding AS DOUBLE[]), c.embedding), 9) AS similarity
      FROM allowed a JOIN vectors v USING (paper_id) JOIN seeds c ON c.query_id = a.query_id WHERE v.embedding IS NOT NULL)
    WHERE similarity >= CASE query_id % 3 WHEN 1 THEN 0.5 ELSE 0.3 END"""
_PAGES = """
    SELECT * FROM (
      SELECT query_id, 'keyword' AS search_mode, position, paper_id, greatest(least(rank, 1.0), 0.0) AS relevance_score, total, true AS matched FROM keyword_page WHERE query_id % 3 = 0
      UNION ALL SELECT query_id, 'semantic', position, paper_id, greatest(least(similarity, 1.0), 0.0), total, false FROM similar_rows WHERE query_id % 3 = 1
      UNION ALL SELECT query_id, 'hybrid', position, paper_id, relevance_score, total, keyword_position IS NOT NULL FROM fused WHERE query_id % 3 = 2)
    JOIN asked USING (query_id) WHERE position <= page_size"""
_SNIPPETS = """
    SELECT query_id, paper_id, string_agg(CASE WHEN hit THEN concat('<mark>', word, '</mark>') ELSE word END, ' ' ORDER BY word_no) AS highlight_snippet FROM (
      SELECT *, greatest(0, least(coalesce(min(word_no) FILTER (hit) OVER w, 0), count(*) OVER w - 5)) AS start FROM word_hits WINDOW w AS (PARTITION BY query_id, paper_id))
    WHERE word_no >= start AND word_no < start + 20 GROUP BY ALL"""


def _isolated_ctes() -> dict[str, str]:
    ctes = _hybrid_ctes()
    early = {"asked": _ASKED, "allowed": _ALLOWED}
    ctes |= {"scope": "SELECT * FROM vectors", "hits": f"SELECT query_id, paper_id FROM ({_HITS}) JOIN allowed USING (query_id, paper_id)", "similar_rows": _CLOSE}
    return {**early, **ctes, "pages": _PAGES, "word_hits": _WORD_HITS.replace("keyword_page k", "pages k").replace("k.position <= 10", "k.matched"), "snippets": _SNIPPETS}


@query("search_isolated", sql("""
    SELECT p.query_id, search_mode, position, p.paper_id, round(p.relevance_score, 6) AS relevance_score, total, highlight_snippet, v.title, v.venue, v.year, v.doi, v.paper_type, v.status, a.authors
    FROM pages p JOIN vectors v ON v.paper_id = p.paper_id LEFT JOIN snippets s ON s.query_id = p.query_id AND s.paper_id = p.paper_id
    LEFT JOIN (SELECT paper_id, string_agg(name, '; ' ORDER BY ord) AS authors FROM authors_long GROUP BY paper_id) a ON a.paper_id = p.paper_id""",
    "vectors", "seeds", "authors_long", **_isolated_ctes()))
def search_isolated(spark, sf):
    """Requests of users of all roles, with the rights and filters that each carries."""
    vectors = d.table(spark, sf, "embeddings").select(F.col("vec_id").alias("paper_id"), "embedding")
    papers = d.papers_with_authors(spark, sf).join(vectors, "paper_id", "left")
    found = requested.search(papers, isolated_requests(spark, sf), stemmed=False)
    return found.select(
        "query_id", "search_mode", "position", "paper_id", F.round("relevance_score", 6).alias("relevance_score"), "total", "highlight_snippet",
        "title", "venue", "year", "doi", "paper_type", "status", F.array_join(F.transform("authors", lambda a: a["name"]), "; ").alias("authors"),
    )


def isolated_requests(spark, sf):
    q = F.col("query_id")
    return hybrid_requests(spark, sf).select(
        "query_id", d.pick(q % 3, "keyword", "semantic", "hybrid").alias("mode"), "query_text", "embedding",
        F.when(q % 5 < 4, d.pick(q % 5, "admin", "hod", "coordinator", "faculty", "")).alias("role"), d.department(q).alias("user_department"), d.text_of(1 + q % 40).alias("user_id"),
        F.when(q % 6 == 4, 2010).alias("year"), F.when(q % 7 == 2, "journal").alias("paper_type"), F.when(q % 8 == 3, "DRAFT").alias("status"),
        F.when(q % 4 == 2, 0.3).alias("min_confidence"), (5 + q % 9).cast("int").alias("page_size"),
    )


_TEXT_INDEX = _positions("coalesce(text, '')", 0.1)


@query("document_search", sql(_RESULT.format(limit=20), **_search_ctes(_TEXT_INDEX, _WEB_WORDS, "SELECT doc_id AS paper_id, text FROM documents")))
def document_search(spark, sf):
    """Whole document texts by a stored index: written once, then read by its blocks."""
    path = scratch_path(spark, "text-index")
    text_index.write_index(text_index.build_index(d.table(spark, sf, "documents")), path)
    page, _ = text_index.top_documents(text_index.read_index(spark, path), requests(spark))
    return shown_rank(page)
