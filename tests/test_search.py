"""Search under rights that requests carry, paging, the stored index and bounded vector search."""

import random

import pytest
from pyspark.sql import functions as F

from paperloom.operators import search_requests, text_index, text_search, vector_search
from paperloom.session import scratch_path

PAPER = "paper_id long, title string, venue string, year int, doi string, paper_type string, status string, department_code string, faculty_id long, overall_confidence double, embedding array<float>"
REQUEST = "query_id long, mode string, query_text string, embedding array<float>, user_department string, role string, user_id string, status string, page_size int, cursor string"


@pytest.fixture(scope="module")
def papers(spark):
    rng = random.Random(3)
    rows = []
    for k in range(60):
        words = " ".join(rng.choices(["graph", "neural", "deep", "learning", "soil", "the"], k=8))
        rows.append((k, words, "Journal", 2000 + k % 4, None, "journal", ["PUBLISHED", "PUBLISHED", "DRAFT"][k % 3], ["CSE", "ECE"][k % 2], k % 5, 0.5, [float(rng.random()) for _ in range(4)] if k % 7 else None))
    return spark.createDataFrame(rows, PAPER)


def asked(spark, *rows):
    return spark.createDataFrame([(n, *r) for n, r in enumerate(rows)], REQUEST)


def found(papers, requests):
    out = search_requests.search(papers, requests, stemmed=False).collect()
    by = {}
    for r in sorted(out, key=lambda r: (r["query_id"], r["position"])):
        by.setdefault(r["query_id"], []).append(r)
    return by


def test_rights_come_before_totals(spark, papers):
    vector = [0.5, 0.5, 0.5, 0.5]
    contexts = [("CSE", "coordinator", "3"), ("ECE", "faculty", "3"), ("CSE", "admin", "x"), (None, "admin", "x"), ("CSE", None, "3"), ("CSE", "hod", ""), ("CSE", "intruder", "3")]
    rows = [(mode, "graph", vector, *c, status, 100, None) for mode in ("keyword", "semantic", "hybrid") for c in contexts for status in (None, "DRAFT")]
    by = found(papers, asked(spark, *rows))
    known = {r["paper_id"]: r for r in papers.collect()}
    for n, (mode, _, _, department, role, user, status, *_) in enumerate(rows):
        own = by.get(n, [])
        if not department or role not in ("coordinator", "faculty", "hod", "admin") or not user:
            assert own == []
            continue
        wanted = set()
        for p in known.values():
            visible = role == "admin" or (p["department_code"] == department and (p["status"] != "DRAFT" or str(p["faculty_id"]) == user))
            matched = "graph" in p["title"].split()
            if visible and p["status"] == (status or "PUBLISHED") and {"keyword": matched, "semantic": p["embedding"] is not None, "hybrid": matched or p["embedding"] is not None}[mode]:
                wanted.add(p["paper_id"])
        assert {r["paper_id"] for r in own} == wanted, rows[n]
        assert all(r["total"] == len(wanted) for r in own)
        assert all((r["highlight_snippet"] is not None) == (mode != "semantic" and "graph" in known[r["paper_id"]]["title"].split()) for r in own)


@pytest.mark.parametrize("mode", ["keyword", "semantic", "hybrid"])
def test_pages_by_cursor_are_the_whole_list(spark, papers, mode):
    request = (mode, "graph or neural", [0.1, 0.9, 0.3, 0.4], "CSE", "admin", "x", None)
    whole = found(papers, asked(spark, (*request, 100, None)))[0]
    seen, cursor = [], None
    while True:
        page = found(papers, asked(spark, (*request, 9, cursor))).get(0, [])
        seen += page
        if len(page) < 9:
            break
        cursor = page[-1]["cursor"]
    assert [(r["paper_id"], r["position"], r["total"]) for r in seen] == [(r["paper_id"], r["position"], r["total"]) for r in whole]
    assert len(whole) > 18


def test_stored_index_finds_the_same_and_reads_less(spark):
    rng = random.Random(8)
    rows = []
    for k in range(900):
        n = rng.choice([5, 8, 30, 300])
        rows.append((k, None if k % 50 == 0 else " ".join(rng.choices(["alpha", "beta", "gamma", "delta", "rare", "the"], [9, 5, 3, 1, 0.02, 9], k=n))))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    queries = spark.createDataFrame(
        [(1, "alpha"), (2, "alpha delta"), (3, '"beta gamma"'), (4, "rare or delta -gamma"), (5, "nothing"), (6, "the"), (7, "gamma beta alpha")], "query_id long, query_text string",
    )
    path = scratch_path(spark, "index")
    text_index.write_index(text_index.build_index(docs, block_docs=16), path)
    page, blocks = text_index.top_documents(text_index.read_index(spark, path), queries, limit=5)
    plain = text_search.keyword_search(
        docs.select(F.col("doc_id").alias("paper_id"), F.coalesce("text", F.lit("")).alias("title"), F.lit("").alias("venue"), F.lit("PUBLISHED").alias("status")), queries, limit=5, stemmed=False,
    )
    shown = lambda df: sorted((r["query_id"], r["position"], r["paper_id"], round(r["rank"], 6), r["total"]) for r in df.collect())
    assert shown(page) == shown(plain)
    read = {(r["query_id"], r["read"]): r["n"] for r in blocks.groupBy("query_id", "read").agg(F.count("*").alias("n")).collect()}
    assert read[1, False] > 2 * read[1, True]  # only blocks of the longest texts can hold the best
    assert read.get((7, False), 0) > 0


def test_covers_agree_with_a_plain_sweep(spark):
    rng = random.Random(5)
    docs = [(k, " ".join(rng.choices(["a1", "b1", "c1", "x1"], k=rng.randint(0, 40)))) for k in range(60)]
    papers = spark.createDataFrame([(k, t, "") for k, t in docs], "paper_id long, title string, venue string")
    words = text_search.web_queries(spark.createDataFrame([(1, "a1 b1"), (2, "a1 or b1 c1"), (3, "c1")], "query_id long, query_text string"), stemmed=False)
    occurrences = text_search.occurrences(text_search.postings(papers, stemmed=False), words)
    got = {(r["query_id"], r["paper_id"]): r["rank"] for r in text_search.cover_rank(occurrences, words, text_search.matches(occurrences)).collect()}
    groups = {1: [{"a1", "b1"}], 2: [{"a1"}, {"b1", "c1"}], 3: [{"c1"}]}
    expected = {}
    for k, text in docs:
        tokens = text.split()
        for q, own in groups.items():
            terms = set().union(*own)
            occ = [(i + 1, t) for i, t in enumerate(tokens) if t in terms]
            rank, previous = 0.0, None
            for e, _ in occ:
                begins = []
                for g in own:
                    last = [max((p for p, t in occ if t == w and p <= e), default=None) for w in g]
                    if None not in last:
                        begins.append(min(last))
                begin = max(begins, default=None)
                if begin is not None and (previous is None or begin > previous):
                    inside = sum(begin <= p <= e for p, _ in occ)
                    rank += 0.1 / (1 + (e - begin) - (inside - 1))
                previous = begin
            if rank:
                expected[q, k] = rank
    assert set(got) == set(expected)
    assert all(abs(got[x] - expected[x]) < 1e-9 for x in got)


def test_tasks_keep_a_bounded_number_of_vectors(spark):
    rng = random.Random(2)
    vectors = [[rng.choice([0.0, 1.0, 2.0]) for _ in range(3)] for _ in range(800)]
    papers = spark.createDataFrame([(k, v if any(v) else None, "PUBLISHED") for k, v in enumerate(vectors)], "paper_id long, embedding array<float>, status string").repartition(5)
    queries = spark.createDataFrame([(q, v) for q, v in enumerate(vectors[:40]) if any(v)], "query_id long, embedding array<float>")
    kept = vector_search.best_similar(papers, queries, 0.5, 4, 9)
    assert kept.filter("hits is null").groupBy("query_id").count().agg(F.max("count")).first()[0] <= 5 * 4
    for offset in (0, 3):
        got = vector_search.semantic_search(papers, queries, limit=4, offset=offset, digits=9).collect()
        every = vector_search.semantic_search(papers, queries, limit=None, offset=0, digits=9).filter(F.col("position").between(offset + 1, offset + 4)).collect()
        shown = lambda rows: sorted((r["query_id"], r["position"], r["paper_id"], r["similarity"], r["total"]) for r in rows)
        assert shown(got) == shown(every) and got
