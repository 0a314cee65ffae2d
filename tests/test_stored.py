"""Stored indexes: vectors in cells, prefixes and pages of a dictionary, papers in page order."""

import datetime as dt
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from paperloom.operators import stored_pages, suggest_index, vector_index

T0 = dt.datetime(2024, 1, 1)


def best_of(vectors, queries, limit, threshold):
    out = {}
    for q, asked in queries:
        scored = []
        for key, v in vectors:
            similarity = round(float(np.dot(v, asked) / np.linalg.norm(v) / np.linalg.norm(asked)), 9)
            if similarity >= threshold:
                scored.append((-similarity, key))
        out[q] = [k for _, k in sorted(scored)[:limit]]
    return out


def clustered(n, dim, groups, seed):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(groups, dim))
    # A third of all vectors lie around the first centre, and some are equal.
    of = [0 if i % 3 == 0 else int(rng.integers(groups)) for i in range(n)]
    rows = [(i, (centres[of[i]] + rng.normal(size=dim) * 0.15).astype(np.float32)) for i in range(n)]
    return rows + [(n + i, rows[i][1]) for i in range(20)]


def by_query(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r.query_id, r.position)):
        out.setdefault(r.query_id, []).append(r.paper_id)
    return out


def test_index_finds_what_a_scan_finds(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(vector_index, "PART_ROWS", 100)
    monkeypatch.setattr(vector_index, "QUERY_ROWS", 7)
    vectors = clustered(1_500, 8, 12, 1)
    odd = [(9_001, None), (9_002, [0.0] * 8), (9_003, [float("nan")] + [1.0] * 7), (9_004, [1.0] * 5), (9_005, [None] + [1.0] * 7), (9_006, [])]
    frame = spark.createDataFrame([(k, v if v is None else [None if x is None else float(x) for x in v]) for k, v in [*vectors, *odd]], "paper_id int, embedding array<float>")
    vector_index.write_index(vector_index.build_index(frame, 8, cells=24), str(tmp_path / "index"))
    index = vector_index.read_index(spark, str(tmp_path / "index"))
    assert index.vectors.count() == 1_520
    assert index.cells.agg({"parts": "max"}).first()[0] > 1
    asked = frame.filter("paper_id % 50 = 0 or paper_id > 9000").withColumnRenamed("paper_id", "query_id")
    queries = [(k, v) for k, v in vectors if k % 50 == 0]
    want = best_of(vectors, queries, 10, 0.2)
    assert by_query(vector_index.nearest(index, asked, 10, 0.2, probes=2, digits=9).collect()) == want
    near = by_query(vector_index.nearest(index, asked, 10, 0.2, probes=4, exact=False, digits=9).collect())
    hits = sum(len(set(want[q]) & set(near.get(q, []))) for q in want)
    assert hits / sum(map(len, want.values())) >= 0.95


def test_bounds_hold_and_rule_cells_out(spark):
    vectors = clustered(600, 8, 10, 2)
    frame = spark.createDataFrame([(k, [float(x) for x in v]) for k, v in vectors], "paper_id int, embedding array<float>")
    index = vector_index.build_index(frame, 8, cells=10)
    cell_of = {r.paper_id: r.cell for r in index.vectors.collect()}
    queries = frame.filter("paper_id < 20").selectExpr("paper_id as query_id", "embedding", "0.9 as floor")
    wanted = {(r.query_id, r.cell): r.bound for r in vector_index.wanted_cells(index.cells, queries).collect()}
    assert len(wanted) < 20 * index.cells.count() / 2
    unit = {k: v / np.linalg.norm(v) for k, v in vectors}
    for q in range(20):
        for k, v in unit.items():
            similarity = float(np.dot(v.astype(float), unit[q].astype(float)))
            if similarity >= 0.9:
                assert wanted[q, cell_of[k]] >= similarity


def test_index_of_nothing(spark):
    none = spark.createDataFrame([], "paper_id int, embedding array<float>")
    index = vector_index.build_index(none, 8)
    asked = spark.createDataFrame([(1, [1.0] * 8)], "query_id int, embedding array<float>")
    assert vector_index.nearest(index, asked).count() == 0


@pytest.fixture(scope="module")
def titled(spark):
    rng = random.Random(3)
    words = ["The", "the", "Theory", "of", "Sets", "graph", "İzmir", "%x", "a_b", "ünder"]
    rows = []
    for i in range(900):
        title = rng.choice([None, "", *[" ".join(rng.choice(words) for _ in range(rng.randrange(1, 5))) for _ in range(9)]])
        rows.append((i, title, rng.choice(["Journal of X", "journal of y", None]), "DRAFT" if i % 10 == 0 else "PUBLISHED", [(rng.choice(["Ann", "ann b", None]),)] if i % 4 else None))
    return rows, spark.createDataFrame(rows, "paper_id int, title string, venue string, status string, authors array<struct<name:string>>")


def test_prefix_table_and_pages(spark, tmp_path, titled, monkeypatch):
    monkeypatch.setattr(suggest_index, "PAGE_ROWS", 8)
    monkeypatch.setattr(suggest_index, "RANGE_ROWS", 100)
    rows, papers = titled
    suggest_index.write_index(suggest_index.build_index(papers, limit=5), str(tmp_path / "suggest"))
    index = suggest_index.read_index(spark, str(tmp_path / "suggest"))
    counts = {k: Counter() for k in suggest_index.KINDS}
    for _, title, venue, status, authors in rows:
        if status == "PUBLISHED":
            counts["title"].update([title] if title else [])
            counts["venue"].update([venue] if venue else [])
            counts["author"].update([n for (n,) in authors or [] if n])
    prefixes = ["t", "TH", "the", "the ", "the o", "The THEORY", "theory of s", "theory of sets graph", "%", "%x a", "a_b t", "journal of", "Journal of Y", "ann", "ann b", "zz", "zzzzzz", "", None, "the the"]
    asked = [(i * 3 + j, kind, p) for i, p in enumerate(prefixes) for j, kind in enumerate(suggest_index.KINDS)]
    requests = spark.createDataFrame(asked, "query_id int, kind string, prefix string")
    got = sorted((r.query_id, r.position, r.text, r.frequency) for r in suggest_index.suggest(index, requests, limit=5).collect())
    want = []
    for q, kind, p in asked:
        found = sorted(t for t in counts[kind] if p and t.lower().startswith(p.lower()))[:5]
        want += [(q, n, t, counts[kind][t]) for n, t in enumerate(found, 1)]
    assert got == sorted(want)
    one = spark.createDataFrame([(1, "title", "theory of sets graph")], "query_id int, kind string, prefix string")
    assert suggest_index.opened_pages(index, one).count() * 4 < index.entries.filter("kind = 'title'").select("page").distinct().count()


def test_pages_open_few_files(spark, tmp_path):
    rng = random.Random(5)
    rows = [(i, None if i % 40 == 0 else T0 + dt.timedelta(hours=rng.randrange(300)), "PUBLISHED" if i % 3 else "DRAFT", 2020) for i in range(2_000)]
    rng.shuffle(rows)
    frame = spark.createDataFrame(rows, "paper_id int, created_at timestamp, status string, year int")
    path = str(tmp_path / "pages")
    stored_pages.write_pages(frame, path, rows_per_file=100)
    files = spark.read.parquet(f"{path}/files").count()
    assert files >= 15
    order = sorted(rows, key=lambda r: (r[1] is None, -(r[1] or T0).timestamp(), r[0]))
    page, opened = stored_pages.read_page(spark, path, None, 20)
    first = page.collect()
    assert [r.paper_id for r in first] == [r[0] for r in order[:20]] and opened == 1
    # Deep in the list, among equal times, and at the end among rows without one.
    for at in (777, 1_900, 1_960, 1_990):
        here = spark.createDataFrame([order[at]], frame.schema).select(stored_pages.cursor_of(F.col("created_at"), F.col("paper_id"))).first()[0]
        page, opened = stored_pages.read_page(spark, path, here, 20)
        assert [r.paper_id for r in page.collect()] == [r[0] for r in order[at + 1:at + 21]]
        assert opened <= 2
    drafts = [r[0] for r in order if r[2] == "DRAFT"]
    page, opened = stored_pages.read_page(spark, path, None, 150, status="DRAFT")
    assert [r.paper_id for r in page.collect()] == drafts[:150] and opened < files
    page, _ = stored_pages.read_page(spark, path, None, 20, year=1999)
    assert page.count() == 0
    stored_pages.write_pages(frame.limit(0), str(tmp_path / "none"))
    assert stored_pages.read_page(spark, str(tmp_path / "none"), None)[0].count() == 0
