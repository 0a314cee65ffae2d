"""Paragraphs beside links, clashing column names, and what a text index of words by chance leaves out."""

import pytest

from paperloom.llm import html_text, minhash, toxicity


def words(n, letter="w"):
    return " ".join(f"{letter}{k}" for k in range(n))


HEAD, ONE, TWO = "Head line", words(60), words(200, "v")


@pytest.mark.parametrize("page", [
    f"<article><h1>{HEAD}</h1><p>{ONE}</p><p>{TWO}</p></article><footer><a href=x>Imprint page</a></footer>",
    f"<article><h1>{HEAD}</h1><p>{ONE}</p><p>{TWO}</p><p><a href=x>Read more about it</a></p></article>",
    f"<nav><a href=a>Home</a><a href=b>News</a></nav><main><h1>{HEAD}</h1><p>{ONE}</p><p>{TWO}</p></main><div><a href=n>Next page</a></div>",
    f"<article><h2><a href=x>{HEAD}</a></h2><p>{ONE}</p><p>{TWO}</p></article>",
    f"<article><h1>{HEAD}</h1><p>{ONE}</p><ul><li><a href=1>One</a><li><a href=2>Two</a><li><a href=3>Three</a></ul><p>{TWO}</p></article>",
    f"<div><a href=a>Home</a></div><div><a href=b>News</a></div><h1>{HEAD}</h1><p>{ONE}</p><p>{TWO}</p><p><a href=n>Next page</a></p>",
])
def test_paragraphs_beside_links_are_kept(page):
    tree = html_text.fit_tree(*html_text.labelled_table())
    assert html_text.main_text(page, tree) == "\n".join((HEAD, ONE, TWO))


def test_documents_may_have_any_other_columns(spark):
    rows = [(1, "a b c d e f", "x", "y", 1, 2), (2, "a b c d e f", "x", "y", 1, 2), (3, None, None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, gone string, __gone string, text_key long, node int")
    kept = minhash.without_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 3]


def test_chance_is_a_binomial_tail():
    assert toxicity.chance(3, 0, 0.5) == pytest.approx(1.0)
    assert toxicity.chance(3, 3, 0.5) == pytest.approx(0.125)
    assert toxicity.chance(4, 3, 0.25) == pytest.approx(4 * 0.25**3 * 0.75 + 0.25**4)
    assert toxicity.chance(4, 4, 0.0) == toxicity.chance(4, 4, 1.0) == 1.0
