"""Work and memory of the steps that large tables stopped."""

import random
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa

from paperloom.llm import lm
from paperloom.llm.common import words_of


def _model(sizes):
    noise = np.full(sizes.classes, 1 / sizes.classes)
    network = lm.Network.fresh(noise, sizes.dim)
    return lm.Model(sizes, 1000, 20, {lm.END: 100, b"w1": 50}, [b"w1"], np.zeros(sizes.classes), network, network.normalisers())


def _texts(n, words):
    text = " ".join(f"w{k % 50}" for k in range(words))
    return pa.RecordBatch.from_arrays([pa.array(range(n)), pa.array([text] * n), pa.array(range(n))], names=["doc_id", "t", "row"])


def test_scoring_holds_a_bounded_number_of_tokens():
    model = _model(lm.Sizes(singles=1, spellings=30))
    batch = _texts(2000, 400)
    tracemalloc.start()
    try:
        rows = sum(out.num_rows for out in lm.scored_pieces(iter([batch]), model))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert rows == 2000
    assert peak < 30 << 20  # the arrays of all 800,000 tokens at once are more than 50 MB


def test_scores_do_not_depend_on_pieces():
    whole, cut = (list(lm.scored_pieces(iter([_texts(7, 30), _texts(0, 0)]), _model(lm.Sizes(singles=1, spellings=30, piece=p)))) for p in (10_000, 1))
    assert len(whole) == 1 and len(cut) == 7
    assert pa.Table.from_batches(whole).to_pylist() == pa.Table.from_batches(cut).to_pylist()


ODD = [None, "", " ", "a", " a", "a ", "  A\x1cb\x1d c\x85d e f  \x0b\x0cÀÉ\x00 ", "\n\t", "é ü\x1f ÉÀ", "𝒳y z𝒳 ", " " * 40 + "x", "b a b a b", "w1 b w1"]


def test_runs_hold_the_words_of_every_text():
    for kind in (pa.string(), pa.large_string()):
        for texts in (pa.array(ODD, kind), pa.array(ODD, kind).slice(3, 6), pa.array([], kind)):
            for tokens in (1, 5, 10_000):
                got, runs = [], 0
                for rows, lengths, codes, words in lm.word_runs(texts, tokens):
                    assert rows == len(lengths) and len(set(words.to_pylist())) == len(words)
                    flat, ends = [words[c].as_py() for c in codes], np.cumsum(lengths)
                    got += [flat[b - n : b] for b, n in zip(ends, lengths)]
                    runs += 1
                assert got == [[*words_of(t), lm.END] for t in texts.to_pylist()]
                assert runs == (len(texts) if tokens == 1 else min(runs, len(texts)))


def _spelled(word, sizes):
    text = word.decode()
    return 1 + sizes.singles + zlib.crc32((text[:2] + "\x00" + text[-1:]).encode()) % sizes.spellings


def test_scores_of_texts_against_one_word_at_a_time():
    sizes = lm.Sizes(singles=1, spellings=30)
    model = _model(sizes)
    first, second = model.network.scores()
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(ODD))), pa.array(ODD), pa.array(range(len(ODD)))], names=["doc_id", "t", "row"])
    got = [r for out in lm.scored_pieces(iter([batch]), model) for r in out.to_pylist()]
    assert [r["row"] for r in got] == list(range(len(ODD)))
    for r, text in zip(got, ODD):
        words = [*words_of(text), lm.END]
        c = [{lm.END: 0, b"w1": 1}.get(w) if w in (lm.END, b"w1") else _spelled(w, sizes) for w in words]
        before = [0, 0, *c]
        log = sum(float(first[before[k + 1], x] + second[before[k], x] - model.normaliser[before[k], before[k + 1]]) / np.log(10) for k, x in enumerate(c))
        head = [model.head.get(w, 0) for w in words]
        assert (r["n_tokens"], r["known"]) == (len(words), sum(n > 0 for n in head))
        assert np.isclose(r["class_log"], log, atol=1e-5) and np.isclose(r["head_log"], np.log10(np.array(head) + 1.0).sum())
        assert Counter({x["word"]: x["times"] for x in r["tail"]}) == Counter(w for w, n in zip(words, head) if not n)


def test_a_spelling_is_worked_out_once_a_run_not_once_a_word(monkeypatch):
    rng, calls, real = random.Random(5), [], zlib.crc32
    words = sorted({"".join(rng.choices("abcde", k=9)) for _ in range(20_000)})
    batch = pa.RecordBatch.from_arrays([pa.array([0]), pa.array([" ".join(words)]), pa.array([0])], names=["doc_id", "t", "row"])
    monkeypatch.setattr(lm.zlib, "crc32", lambda x: calls.append(x) or real(x))
    out = list(lm.scored_pieces(iter([batch]), _model(lm.Sizes(singles=1, spellings=30))))
    assert len(words) > 15_000 and len(out[0].column("tail")[0]) == len(words)
    assert 0 < len(calls) <= 5**3  # one for each word before
