import collections
import hashlib
import html
import itertools
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from paperloom.llm import decontaminate, embed_dedup, html_text, lm, minhash, packing, quality, sharding, toxicity, warc
from paperloom.llm.common import words_of
from paperloom.llm.components import connected_components
from tests.llm.cases import DOCS, UP, awkward_docs, components, crc, near_pairs, sentence, shingles

SF = "/root/testdata/sf0.001"
BPE = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def rows():
    return awkward_docs()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="module")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


# Sharding ---------------------------------------------------------------------------------------------------------------------

@pytest.mark.parametrize("dims,bits", [(2, 3), (3, 2), (4, 2), (2, 1)])
def test_curve_visits_every_cell_by_single_steps(spark, dims, bits):
    cells = list(itertools.product(range(2**bits), repeat=dims))
    df = spark.createDataFrame([(list(c),) for c in cells], "x array<int>")
    got = df.select("x", sharding.hilbert_index(F.col("x"), dims, bits).alias("h")).collect()
    path = [r["x"] for r in sorted(got, key=lambda r: r["h"])]
    assert sorted(r["h"] for r in got) == list(range(len(cells)))
    assert all(sum(abs(a - b) for a, b in zip(p, q)) == 1 for p, q in zip(path, path[1:]))


def test_shards(docs, rows):
    got = sharding.document_shards(docs, 7).collect()
    assert len(got) == len(rows)
    expected = sorted((r[0] is None, r[0] or 0, len((r[1] or "").encode()) + 16, zlib.crc32((r[1] or "").encode())) for r in rows)
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["size"], r["text_crc32"]) for r in got) == expected
    by_shard = collections.defaultdict(list)
    for r in got:
        assert r["law"] == "rows" and r["grown_shard"] is None
        by_shard[r["shard"]].append(r)
    sizes = [len(v) for v in by_shard.values()]
    assert sorted(by_shard) == list(range(7)) and max(sizes) - min(sizes) <= 1
    last = -1
    for shard in range(7):
        own = sorted(by_shard[shard], key=lambda r: r["slot"])
        assert [r["slot"] for r in own] == list(range(len(own)))
        assert all(a["curve"] <= b["curve"] for a, b in zip(own, own[1:])) and own[0]["curve"] >= last
        last = own[-1]["curve"]


def test_shards_of_nothing_and_of_few_rows(no_docs, docs):
    assert sharding.document_shards(no_docs).count() == 0
    few = sharding.document_shards(docs.limit(3)).collect()
    assert len({r["shard"] for r in few}) == 3 and {r["slot"] for r in few} == {0}


# Language model ---------------------------------------------------------------------------------------------------------------

def plain_tokens(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", (text or "").translate(UP)) if w] + [None]


def test_base_scores_against_brute_force(docs, rows):
    got = lm.document_scores(docs, lm.Sizes(head_share=0.004, singles=20, spellings=16)).collect()
    training = [plain_tokens(r[1]) for r in rows if crc(r[0]) % 7 != 2]
    counts = collections.Counter(t for text in training for t in text)
    n, v = sum(counts.values()), len(counts)
    expected = []
    for r in rows:
        tokens = plain_tokens(r[1])
        base = sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in tokens)
        expected.append((str(r[0]), crc(r[0]) % 7 == 2, len(tokens), sum(counts[t] > 0 for t in tokens), n, round(base, 5)))
    assert sorted((str(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 5)) for r in got) == sorted(expected)
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in got)


def test_probabilities_add_up_to_one(spark):
    texts = spark.createDataFrame([("a b a c d a b e",), ("b a zz zy zx a",), ("",)], "t string")
    sizes = lm.Sizes(singles=2, spellings=3, dim=4, batch=4, warm_epochs=2)
    model, counts = lm.fit(texts, sizes)
    first, second = model.network.scores()
    p = np.exp(first[None, :, :] + second[:, None, :] - model.normaliser[:, :, None])
    assert np.allclose(p.sum(2), 1, atol=1e-4)
    classes = lm.Classes(model.singles, sizes)
    inside = np.zeros(sizes.classes)
    for r in counts.collect():
        c = classes([bytes(r["word"])])[0]
        inside[c] += (r["n"] + 1) / 10 ** model.log_class[c]
    for c in range(1 + len(model.singles), sizes.classes):
        inside[c] += 1 / 10 ** model.log_class[c]  # the unseen words of a spelling
    used = [0, *range(1, 1 + len(model.singles)), *range(1 + sizes.singles, sizes.classes)]
    assert np.allclose(inside[used], 1)


def test_model_of_nothing(no_docs, docs):
    assert lm.document_scores(no_docs).count() == 0
    held = docs.filter(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 7 == 2)
    got = lm.document_scores(held).collect()
    assert got and all(r["n_known"] == 0 and r["train_tokens"] == 0 and r["base_score"] == 0 for r in got)


def test_model_beats_counts_on_texts_it_has_not_seen(spark):
    got = lm.document_scores(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).filter("held_out").agg(F.sum("score").alias("s"), F.sum("base_score").alias("b")).first()
    assert got["s"] > got["b"]


# WARC -------------------------------------------------------------------------------------------------------------------------

def page_rows():
    long = "<p>" + "x" * 200
    return [
        (1, "http://a/1", "<p>short</p>", 9), (2, "http://a/2", "<p>short</p>", 9), (9, "http://a/9", long, 9), (4, "http://a/4 b\r\nX: y", long, 9), (5, None, long, 9),
        (6, "u", None, 9), (None, "u", long, 9), (7, "u", "", 9), (8, "u", "é" * 60, 9), (10, "u", "é" * 60, 9), (10, "u", "é" * 60, 9), (11, "u", "y" * 300_000, 9), (12, "u", "y" * 300_000, 9),
    ]


def test_archives_round_trip(spark):
    data = page_rows()
    got = warc.archive_round_trip(spark.createDataFrame(data, "page_id long, url string, html string, record_type int").repartition(3)).collect()
    expected = []
    for i, _, h, _ in data:
        raw = (h or "").encode()
        same = [j for j, _, g, _ in data if (g or "").encode() == raw and j is not None]
        revisit = len(raw) >= 100 and min(same) != i
        if i is not None:
            expected.append((i, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if revisit else "response", min(same) if revisit else None))
    named = [tuple(r[c] for c in ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")) for r in got if r["page_id"] is not None]
    assert sorted(named, key=str) == sorted(expected, key=str)
    [lost] = [r for r in got if r["page_id"] is None]
    assert lost["record_type"] == "revisit" and lost["refers_to"] == 4 and lost["payload_bytes"] == 203


def test_archives_of_nothing(spark):
    assert warc.archive_round_trip(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def one_record(k, payload=b"body"):
    return warc.record_bytes(str(k), f"http://x/{k}", "2024-01-01T00:00:00Z", payload, len(payload), hashlib.sha256(payload).hexdigest(), None)


@pytest.mark.parametrize("packed", [True, False])
def test_salvage(packed):
    rng = random.Random(3)
    parts = [one_record(k, bytes(rng.randbytes(300))) for k in range(6)]
    parts = [warc.gzip_member(p) if packed else p for p in parts]
    at = np.cumsum([0, *map(len, parts)]).tolist()
    clean = b"".join(parts)

    def read(data):
        found = list(warc.salvage(data))
        covered = [(o, n) for o, n, _, _ in found]
        assert all(a + n == b for (a, n), (b, _) in zip(covered, covered[1:])) and covered[0][0] == 0 and sum(covered[-1]) == len(data)
        return [h["warc-record-id"][len("<urn:x-page:"):-1] for _, _, h, _ in found if h], [(o, n) for o, n, h, _ in found if h is None]

    assert read(clean) == (list("012345"), [])
    broken = bytearray(clean)
    broken[at[3] - 50] ^= 0xFF
    assert read(bytes(broken)) == (list("01345"), [(at[2], at[3] - at[2])])
    assert read(b"junk" + clean) == (list("012345"), [(0, 4)])
    assert read(clean[: at[5] + 20]) == (list("01234"), [(at[5], 20)])
    assert read(clean[: at[3] - 30] + clean[at[3] :])[0] == list("01345")
    assert read(clean[: at[1]] + b"\x1f\x8b\x08WARC/1.1\r\n" + clean[at[1] :]) == (list("012345"), [(at[1], 13)])


def test_salvage_of_wrong_lengths_and_digests():
    a, b, c = one_record(1), one_record(2, b"second"), one_record(3)
    for wrong in (re.sub(rb"(\r\nContent-Length: )\d+(\r\n\r\nHTTP)", rb"\g<1>999999\2", b), b.replace(b"second", b"Second")):
        assert wrong != b
        found = list(warc.salvage(a + wrong + c))
        ids = [h["warc-record-id"] for _, _, h, _ in found if h]
        assert ids[0] == "<urn:x-page:1>" and ids[-1] == "<urn:x-page:3>" and any(h is None for _, _, h, _ in found)
    assert list(warc.salvage(b"")) == []
    assert [(o, n) for o, n, _, _ in warc.salvage(b"nothing here")] == [(0, 12)]


def test_damaged_archive_in_a_folder(spark, tmp_path):
    good = b"".join(warc.gzip_member(one_record(k)) for k in range(3))
    (tmp_path / "a.warc.gz").write_bytes(good[:50] + b"\x00" + good[51:])
    (tmp_path / "b.warc").write_bytes(one_record(7) + b"??" + one_record(8))
    (tmp_path / "empty.warc").write_bytes(b"")
    got = warc.read_warc(spark, str(tmp_path)).collect()
    assert sorted(r["record_id"] for r in got if r["record_id"]) == [f"<urn:x-page:{k}>" for k in (1, 2, 7, 8)]
    assert sorted((r["path"].rsplit("/")[-1], r["length"]) for r in got if r["gap_reason"]) == [("a.warc.gz", len(good) // 3 if len(good) % 3 == 0 else len(warc.gzip_member(one_record(0)))), ("b.warc", 2)]


# Vectors ----------------------------------------------------------------------------------------------------------------------

def vector_rows():
    rng = np.random.default_rng(4)
    out = []
    for label in range(3):
        centre = rng.standard_normal(16)
        for _ in range(40 if label else 150):  # one label's group is spread so that not all of it is linked
            out.append((label, (centre + rng.standard_normal(16) * (0.12 if label == 1 else 0.28)).tolist()))
        out += [(label, rng.standard_normal(16).tolist()) for _ in range(20)]
    out += [out[0]] * 5 + [(1, [2 * x for x in out[160][1]]), (None, out[0][1]), (0, None), (0, []), (0, [0.0] * 16), (0, [float("nan")] * 16), (0, [None, *[1.0] * 15]), (0, [1e200] * 16), (0, [1e-200] * 16), (0, [1.0, 2.0])]
    rows = [(int(k), v, l, "x") for k, (l, v) in zip(rng.permutation(len(out)), out)]
    return rows + [rows[3]]


def test_vectors_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(embed_dedup, "BLOCK", 16)
    rows = vector_rows()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, kept string").repartition(4)
    units = [None if l is None else embed_dedup.unit(v) for _, v, l, _ in rows]
    links = [
        (a, b) for a, b in itertools.combinations(range(len(rows)), 2)
        if units[a] is not None and units[b] is not None and rows[a][2] == rows[b][2] and len(units[a]) == len(units[b]) and units[a] @ units[b] >= 0.93
    ]
    degree = collections.Counter(x for pair in links for x in pair)
    root = components(len(rows), links)
    smallest = {r: min(rows[k][0] for k in range(len(rows)) if root[k] == r) for r in set(root)}
    expected = sorted((rows[k][0], degree[k], smallest[root[k]], rows[k][0] == smallest[root[k]]) for k in range(len(rows)))
    got = embed_dedup.near_vectors(df, window=8).collect()
    assert sorted((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in got) == expected


def test_vectors_with_null_ids_and_no_vectors(spark):
    schema = "vec_id long, embedding array<float>, label int"
    got = embed_dedup.near_vectors(spark.createDataFrame([(None, [1.0, 0.0], 1), (5, [1.0, 0.01], 1), (None, [0.0, 1.0], 1)], schema)).collect()
    assert collections.Counter((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in got) == {(None, 1, 5, False): 1, (5, 1, 5, True): 1, (None, 0, None, True): 1}
    assert embed_dedup.near_vectors(spark.createDataFrame([], schema)).count() == 0


def uncentred_rows(n=600, dims=24, planted=60):
    """Vectors that share a direction (median cosine about 0.8) and planted pairs a little over the threshold, which no third links."""
    rng = np.random.default_rng(11)
    shared = rng.standard_normal(dims)
    base = shared / np.linalg.norm(shared) * 2 + rng.standard_normal((n, dims)) / math.sqrt(dims)
    rows = [v / np.linalg.norm(v) for v in base]
    for k in range(planted):
        side = rng.standard_normal(dims)
        side -= side @ rows[k] * rows[k]
        rows.append(0.935 * rows[k] + math.sqrt(1 - 0.935**2) * side / np.linalg.norm(side))
    return rows


@pytest.mark.parametrize("side", [4096, 64])
def test_no_pair_depends_on_the_passes(spark, monkeypatch, side):
    monkeypatch.setattr(embed_dedup, "SIDE", side)
    monkeypatch.setattr(embed_dedup, "MAX_PASSES", 1)
    rows = [embed_dedup.unit(v.tolist()) for v in uncentred_rows()]
    near = np.array(rows) @ np.array(rows).T >= 0.93
    links = [(int(a), int(b)) for a, b in zip(*np.nonzero(near)) if a < b]
    root = components(len(rows), links)
    df = spark.createDataFrame([(k, v.tolist(), "one") for k, v in enumerate(rows)], "vec_id long, embedding array<double>, label string")
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in embed_dedup.near_vectors(df, window=1).collect()}
    assert got == {k: (int(near[k].sum()) - 1, root[k]) for k in range(len(rows))}


def test_passes_alone_find_the_links_of_labels_of_any_size(spark):
    """A small label and one of 3,000 vectors far from the origin: the sorted passes, without the completion, unite the planted pairs."""
    rows = [(v, "large") for v in uncentred_rows(3000, 64, 300)] + [(v, "small") for v in uncentred_rows(40, 64, 20)]
    df = spark.createDataFrame([(k, v.tolist(), label) for k, (v, label) in enumerate(rows)], "vec_id long, embedding array<double>, label string")
    classes = embed_dedup.units(df, "vec_id", "embedding", "label").withColumn("size", F.lit(1)).cache()
    kinds = embed_dedup.label_table(classes, 32, 0.93).cache()
    assert {r["label"]: r["n"] for r in kinds.collect()} == {"large": 3300, "small": 60}
    found = {bytes(r["node"]): bytes(r["root"]) for r in connected_components(embed_dedup.pass_links(classes, kinds, 32, 0.93)).collect()}
    node = {r["vec_id"]: bytes(r["node"]) for r in classes.collect()}
    for label in ("large", "small"):
        ids = [k for k, (_, of) in enumerate(rows) if of == label]
        u = np.array([embed_dedup.unit(rows[k][0].tolist()) for k in ids])
        links = [(node[ids[a]], node[ids[b]]) for a, b in zip(*np.nonzero(u @ u.T >= 0.93)) if a < b]
        assert sum(found.get(a, a) == found.get(b, b) for a, b in links) >= 0.9 * len(links) > 0


def test_passes_grow_with_the_label():
    few, many = (embed_dedup.passes_for(n, 1.0, 32, 0.93, 32) for n in (64, 10**7))
    assert few == 4 < many <= 32 and embed_dedup.passes_for(10**6, 0.0, 32, 0.93, 32) == 4


# Packing ----------------------------------------------------------------------------------------------------------------------

def test_encoder_equals_the_library():
    from tokenizers import Tokenizer

    slow, fast = Tokenizer.from_file(BPE), packing.encoder(BPE)
    rng = random.Random(8)
    letters = "ab Z9'.,\n\t\r   　\x1c\x85éß中文🙂́ſİ١²½ʼn_-"
    texts = [t for _, t, *_ in awkward_docs() if t and len(t) < 5000] + ["".join(rng.choices(letters, k=rng.randint(0, 40))) for _ in range(3000)]
    for t in texts:
        assert fast(t).tolist() == slow.encode(t, add_special_tokens=False).ids, repr(t)


def test_very_long_blank_runs():
    from tokenizers import Tokenizer

    slow, fast = Tokenizer.from_file(BPE), packing.encoder(BPE)
    for text in ("a" + " " * 2_000_000 + "b", "\n" * 1_000_000 + "b", "a" + " " * 9_999 + "b"):
        assert fast(text).tolist() == slow.encode(text, add_special_tokens=False).ids


def test_packing(docs, rows, no_docs):
    capacity = 128
    got = packing.pack(docs, BPE, capacity=capacity, piece=32, windows=8, with_ids=True).collect()
    encode = packing.encoder(BPE)
    whole = collections.Counter()
    for r in rows:
        ids = np.append(encode(r[1] or ""), 1).astype("<u4")
        whole[(r[0], ids.tobytes())] += 1
    pieces, sequences = collections.defaultdict(list), collections.defaultdict(list)
    for r in got:
        ids = np.array(r["ids"], "<u4")
        assert r["length"] == len(ids) and r["ids_crc32"] == zlib.crc32(ids.tobytes())
        pieces[(r["doc_id"], r["doc_tokens"])].append((r["start"], ids))
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for own in sequences.values():
        own.sort()
        assert own[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(own, own[1:])) and sum(own[-1]) <= capacity
    for (i, n), own in pieces.items():
        texts = [np.frombuffer(raw, "<u4") for (j, raw), times in whole.items() for _ in range(times) if j == i and len(raw) == 4 * n]
        expected = collections.Counter((a, t[a : a + m].tobytes()) for t in texts for a, m in packing.cuts(n, capacity, 32))
        assert collections.Counter((a, ids.tobytes()) for a, ids in own) == expected
    assert sum(len(raw) // 4 * k for (_, raw), k in whole.items()) == sum(r["length"] for r in got)
    assert packing.pack(no_docs, BPE).count() == 0


@pytest.mark.parametrize("n,windows", [(1, 1), (3, 5), (40, 7), (200, 16)])
def test_differencing_is_near_equal(n, windows):
    sizes = np.random.default_rng(n).integers(1, 500, n)
    window = packing.differencing(sizes, windows)
    sums = np.bincount(window, weights=sizes, minlength=windows)
    assert window.min() >= 0 and window.max() < windows and sums.sum() == sizes.sum()
    if n >= 10 * windows:
        assert sums.max() - sums.min() <= 30
    fitted = packing.fit(sizes, 512)
    assert np.bincount(fitted, weights=sizes).max() <= 512


# Classifiers ------------------------------------------------------------------------------------------------------------------

def accuracy(scored, labels, label):
    both = scored.filter("held_out").join(labels, "doc_id")
    return both.agg(F.avg((F.col("predicted") == F.col(label)).cast("double")), F.count("*")).first()


def test_quality_on_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    right, n = accuracy(quality.quality_scores(docs, labels), labels, "quality")
    assert n > 1000 and right > 0.95


def test_toxicity_on_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    right, n = accuracy(toxicity.toxicity_scores(docs, labels), labels, "toxic")
    assert n > 500 and right > 0.97


@pytest.mark.parametrize("scores", [quality.quality_scores, toxicity.toxicity_scores])
def test_classifiers_on_awkward_rows(spark, docs, rows, no_docs, scores):
    kinds = "doc_id long, quality int, toxic int, text string"
    some = spark.createDataFrame([(k, k % 2, k % 2, "t") for k in range(150)] + [(None, 1, 1, "t"), (3, 0, 0, "t"), (5, None, None, "t"), (6, 7, 7, "t"), (300, 1, 1, "t")], kinds)
    got = scores(docs, some).collect()
    fold = 3 if scores is quality.quality_scores else 5
    rest = 1 if fold == 3 else 0
    assert sorted((str(r["doc_id"]), r["held_out"]) for r in got) == sorted((str(r[0]), crc(r[0]) % fold == rest) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in got)
    texts = {r[0]: r[1] for r in rows if r[0] is not None and r[0] < 300}
    by_text = collections.defaultdict(set)
    for r in got:
        if r["doc_id"] in texts:
            by_text[texts[r["doc_id"]]].add(r["score"])
    assert all(len(v) == 1 for v in by_text.values())
    assert scores(no_docs, some).count() == 0
    prior = scores(docs, some.filter("quality = 1 and doc_id <> 3"))
    assert prior.agg(F.min("score")).first()[0] > 0.9
    nothing = scores(docs, spark.createDataFrame([], kinds))
    assert nothing.select("score").distinct().count() == 1


def test_toxicity_learns_from_texts_of_all_lengths(spark):
    rows = [(k, "word " * (4000 if k % 10 == 0 else 5) + str(k)) for k in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("toxic"))
    sample, _ = quality.labelled_sample(docs, labels, "toxic", F.lit(True), toxicity.BOUNDS)
    assert sorted(t for t, _ in sample) == sorted(t for _, t in rows)


def test_thresholds_follow_the_length():
    rng = np.random.default_rng(6)
    y, size = rng.integers(0, 2, 2000), rng.uniform(-4, 5, 2000)
    odds = 1.5 * size + 4 * y + rng.normal(0, 0.3, 2000)
    cuts, slope = toxicity.calibrated(odds, size, np.zeros(2000, int), y, np.ones(2000), 0.5)
    assert ((odds - slope * size > cuts[0]) == y).mean() > 0.99


def test_filters_keep_columns(spark, docs):
    labels = spark.createDataFrame([(k, k % 2, k % 2) for k in range(150)], "doc_id long, quality int, toxic int")
    for keep in (quality.good_documents, toxicity.clean_documents):
        assert keep(docs, labels).columns == docs.columns


def test_toxic_words_count_wherever_they_stand():
    rng = random.Random(1)
    clean = [(sentence(rng, 60), 0) for _ in range(300)]
    toxic = []
    for _ in range(300):
        words = sentence(rng, 60).split()
        words[rng.randrange(60)] = rng.choice(["Zonkish!!", "zonker", "blaargh***"])
        toxic.append((" ".join(words), 1))
    rows = [r for pair in zip(clean, toxic) for r in pair]
    net = toxicity.fit_network(rows[:500], 0.5)
    scorer = net.scorer()

    def predicted(text):
        words = toxicity.plain_words(text)
        return int(scorer.log_odds(words) >= net.thresholds[toxicity.guessed_language(words)])

    assert sum(predicted(t) == y for t, y in rows[500:]) >= 95
    long = sentence(rng, 20_000)
    assert predicted(long) == 0 and predicted(long + " ZONKER.") == 1 and predicted("") == 0


# Pages ------------------------------------------------------------------------------------------------------------------------

TREE = html_text.fit_tree(*html_text.labelled_table())
PAGES = [
    ("<html><head><title>T</title></head><body><nav><a href=/>Home</a></nav><article><h1>Head&amp;line</h1><p>One <b>bold</b>\n word.<p>Two</p></article><footer>&copy; x</footer></body></html>", "Head&line\nOne bold word.\nTwo"),
    ("<article><p>Kept.</p><div class='comments'><article class=comment><p>A reader says a lot of things here, and goes on.</p></article></div><p>Also kept.</p></article>", "Kept.\nAlso kept."),
    ("<main><p>x</p><aside>side</aside><form><p>Your name</p><input></form><div id=cookie-notice>We use cookies</div><div style='display:none'>no</div><p>y</p></main>", "x\ny"),
    ("<div class=ad>Buy</div><article><script>var a='<p>no</p>';</script><style>p{}</style><!-- <p>no</p> --><p>&lt;b&gt; &#233;&nbsp; z</p></article>", "<b> é z"),
    ("<nav><ul><li><a href=a>A</a><article><p>Menu never closed.</p></article>", "Menu never closed."),
    ("<p>Plain page with a few words in a paragraph and no article at all.</p><p>Second one.</p>", "Plain page with a few words in a paragraph and no article at all.\nSecond one."),
    ("just text", "just text"), ("<article><header><h1>Own header</h1></header><p>t</p><footer>tags</footer></article>", "Own header\nt"),
    ("", ""), (None, ""), ("<p></p><br>", ""), ("<article><p>cut off in the mid", "cut off in the mid"), ("<article><p>a < b and c > d</p></article>", "a < b and c > d"),
]


@pytest.mark.parametrize("page,text", PAGES)
def test_main_text(page, text):
    assert html_text.main_text(page, TREE) == text


ARTICLE = " ".join(f"word{k}" for k in range(60))


@pytest.mark.parametrize("before", [
    "<svg viewBox='0 0 1 1'/>", "<math/>", "<p>Share <button>OK</p>", "<div><select><option>a</div>", "<div><object data=x></div>", "<noscript>", "<button>",
    "<svg><svg/><text>no</text></svg>", "<p>" + "\u0130" * 80 + "</p><script>let a = 1</script>",
])
def test_opaque_elements_end(before):
    page = f"<body>{before}<p>{ARTICLE}</p><p>{ARTICLE}</p><svg></svg></body>"
    texts = [b.text for b in html_text.blocks(page)]
    assert " ".join(texts).count(ARTICLE) == 2 and not any(x in " ".join(texts) for x in ("let a", "script", "no<"))


@pytest.mark.parametrize("page", [
    f"<div id=page class='site has-sidebar'><p>{ARTICLE}</p><p>{ARTICLE}</p></div>",
    f"<div class='content-sidebar-wrap'><article><p>{ARTICLE}</p><p>{ARTICLE}</p></article><div class=sidebar><p>Read more of this</p></div></div>",
    f"<div class='comments-closed no-header with-menu'><p>{ARTICLE}</p></div><div><p>{ARTICLE}</p></div>",
    f"<article class='post comments-closed'><p>{ARTICLE}</p><p>{ARTICLE}</p></article>",
    f"<article><p>A short teaser of another page</p></article><div><p>{ARTICLE}</p><p>{ARTICLE}</p></div>",
])
def test_frames_of_a_page_are_not_around_it(page):
    text = html_text.main_text(f"<html><body>{page}</body></html>", html_text.fit_tree(*html_text.labelled_table()))
    assert text.count(ARTICLE) == 2


def test_tree_fits_its_table():
    x, y = html_text.labelled_table()
    assert (TREE(x) == y).all()


def test_pages_of_the_table(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet").withColumn("n_char", F.lit(1))
    for r in html_text.extract_text(pages).collect():
        inner = re.search(r"<article>(.*?)(</article>|$)", r["html"], re.S)[1]
        parts = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", p)).split()) for p in re.split(r"</?(?:p|h1)>|<br>", inner)]
        assert r["text"] == "\n".join(p for p in parts if p) and r["n_chars"] == len(r["text"])


def test_pages_with_nulls_and_none(spark):
    schema = "page_id long, url string, html string, x int"
    got = html_text.extract_text(spark.createDataFrame([(None, None, None, None), (1, "u", "<p>" + "word " * 50_000, 1), (1, "u", "", 1)], schema), carry=["page_id", "url"]).collect()
    assert sorted(r["n_chars"] for r in got) == [0, 0, 249_999]
    assert html_text.extract_text(spark.createDataFrame([], schema)).count() == 0


# Near-duplicates --------------------------------------------------------------------------------------------------------------

def expected_components(rows):
    sets = [shingles(r[1]) for r in rows]
    root = components(len(rows), near_pairs(sets))
    smallest = {r: min((rows[k][0] for k in range(len(rows)) if root[k] == r and rows[k][0] is not None), default=None) for r in set(root)}
    out = []
    for k, r in enumerate(rows):
        c = smallest[root[k]] if sets[k] else r[0]
        out.append((str(r[0]), len(sets[k]), str(c), r[0] == c))
    return sorted(out)


@pytest.mark.parametrize("block", [2048, 5])
def test_near_duplicates_against_brute_force(docs, rows, monkeypatch, block):
    monkeypatch.setattr(minhash, "BLOCK", block)
    got = minhash.near_duplicates(docs).collect()
    assert sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"]), r["kept"]) for r in got) == expected_components(rows)


def test_large_group_around_one_text(spark):
    rng = random.Random(2)
    base = sentence(rng, 80).split()
    rows = [(0, " ".join(base))]
    for k in range(1, 160):
        words = list(base)
        for _ in range(rng.randint(1, 4)):
            words[rng.randrange(80)] = f"w{rng.random()}"
        rows.append((k, " ".join(words)))
    rng.shuffle(rows)
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    assert sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"]), r["kept"]) for r in got) == expected_components(rows)


def test_without_near_duplicates(docs, rows, no_docs):
    kept = minhash.without_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(i for i, _, _, k in expected_components(rows) if k)
    assert minhash.without_near_duplicates(no_docs).count() == 0 and minhash.near_duplicates(no_docs).count() == 0


def test_components_of_random_graphs(spark):
    rng = random.Random(6)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(1000 + k, 1001 + k) for k in range(300)] + [(5000, 5001 + k) for k in range(200)] + [(7, 7), (None, 3), (8, None)]
    got = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    real = [(a, b) for a, b in edges if a is not None and b is not None and a != b]
    root = components(6000, real)
    assert got == {x: root[x] for pair in real for x in pair}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


# Benchmark passages -----------------------------------------------------------------------------------------------------------

def plain_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(UP))


def plain_contamination(text, items):
    words = plain_words(text)
    hit, found = [False] * len(words), set()
    for i, item in items:
        own = plain_words(item)
        n = min(13, len(own))
        windows = {tuple(own[k : k + n]) for k in range(len(own) - n + 1)} if own else set()
        for k in range(len(words) - n + 1) if windows else ():
            if tuple(words[k : k + n]) in windows:
                hit[k : k + n] = [True] * n
                found.add("" if i is None else str(i))
    ids = sorted(found)
    return len(words), sum(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), sum(hit) > 0 and 20 * sum(hit) >= len(words), hit


@pytest.mark.parametrize("part_words", [50_000, 20, 1])
def test_contamination_against_brute_force(spark, rows, part_words):
    rng = random.Random(9)
    pool = [r[1] for r in rows[:20]]
    items = [(k, " ".join(pool[k % 20].upper().split()[3 : 3 + rng.choice([2, 5, 13, 14, 30])])) for k in range(30)]
    items += [(9, "..."), (10, None), (11, ""), (None, pool[4]), (12, pool[4]), (100, "Äx!"), (13, "a,b;a"), (13, "a b a b a b a b a b a b a b a b a")]
    texts = [(r[0], r[1]) for r in rows] + [(900, "a-b_a  B; " * 30), (901, pool[2].replace(" ", "...") + " 中 x"), (902, sentence(rng, 400) + " " + " ".join(pool[1].split()[:15]))]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.find_benchmark(docs, bench, part_words=part_words).withColumn("sha", F.sha2(F.concat_ws(",", "items"), 256)).collect()
    got = sorted((str(r["doc_id"]), r["n_words"], r["n_hit"], len(r["items"]), r["sha"], r["contaminated"]) for r in found)
    assert got == sorted((str(i), *plain_contamination(t, items)[:5]) for i, t in texts)
    for r in found:
        if r["spans"]:
            covered = [w for s in r["spans"] for w in plain_words(r["text"][s["start"] : s["end"]])]
            words, hit = plain_words(r["text"]), plain_contamination(r["text"], items)[5]
            assert covered == [w for w, h in zip(words, hit) if h]


def test_contamination_of_nothing(spark, docs, no_docs):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contamination_report(docs, none).filter("n_hit > 0 or contaminated").count() == 0
    assert decontaminate.contamination_report(no_docs, none).count() == 0
    assert decontaminate.without_benchmark(docs, none).columns == docs.columns


def test_words_of():
    assert words_of("A\x0bb\x1cÉ c\n") == [b"a", "b\x1cÉ c".encode()]
