"""Conversation repair, byte-level BPE and spelling variants against plain versions."""

import collections
import functools
import hashlib
import random
import re
import zlib

import public_tokenizers
import pytest
import tiktoken

from paperloom.llm import bpe, conversations, spelling
from tests.llm.cases import DOCS, UP, awkward_docs

RANKS, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(awkward_docs(), DOCS).repartition(3)


@pytest.fixture(scope="module")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


# Conversation repair ----------------------------------------------------------------------------------------------------------

TURNS = "conv_id long, turn long, role string, text string, gaps string, cost string, conv string"


def plain_damage(rows):
    """(conversation, turn, role, text) after damage, and all conversations."""
    out = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        h = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        kept = out[conv]
        if h == 0:
            continue
        text = "" if h == 1 else re.sub("[.!?]", "", text) if h == 2 else text
        kept += [(turn, "user" if h == 4 else role, text)] * (2 if h == 3 else 1)
    for kept in out.values():
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    return out


def plain_repair(kept):
    faults, seen = [], set()
    for _, role, text in kept:
        body = text.rstrip("\x20\x09\x0a\x0b\x0c\x0d")
        faults.append("blank" if not body else "duplicate" if (role, text) in seen else None if body[-1] in ".!?" else "truncated")
        seen.add((role, text))

    @functools.cache
    def best(i, written):
        """(cost, letters) from turn i on, `written` being what the last role can be followed by."""
        out = []
        ahead = {"": "u", "s": "u", "u": "a", "a": "u"}[written[-1:]]
        if i == len(kept) and written[-1:] in ("", "a"):
            out.append((0, ""))
        if written.count("+") < 3:
            cost, letters = best(i, written[:-1] + "+" + ahead)
            out.append((cost + 2, "I" + letters))
        if i < len(kept):
            cost, letters = best(i + 1, written[-1:])
            out.append((cost + 3, "D" + letters))
            if faults[i] in (None, "truncated"):
                late = faults[i] == "truncated"
                initial = kept[i][1][:1]
                if initial == ahead or initial == "s" and not written:
                    cost, letters = best(i + 1, initial)
                    out.append((cost + late, "K" + letters))
                cost, letters = best(i + 1, ahead)
                out.append((cost + late + 2, "R" + letters))
        return min(out, default=(10**9, ""))

    for i in range(len(kept), 0, -1):  # from the back, so that no call goes deep
        for written in ("", "s", "u", "a"):
            best(i, written)
    cost, audit = best(0, "")
    lines, state, i = [], "", 0
    for letter in audit:
        ahead = {"": "u", "s": "u", "u": "a", "a": "u"}[state]
        if letter == "I":
            lines.append({"u": "user:", "a": "assistant:"}[ahead])
            state = ahead
            continue
        if letter == "K":
            lines.append(f"{kept[i][1]}:{kept[i][2]}")
            state = kept[i][1][0]
        elif letter == "R":
            lines.append({"u": "user:", "a": "assistant:"}[ahead] + kept[i][2])
            state = ahead
        i += 1
    turns = [t for t, _, _ in kept if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(kept, kept[1:]))
    count = collections.Counter(faults)
    return gaps, count["blank"], count["duplicate"], count["truncated"], illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()


def random_turns(seed, conversations_, longest, hot=0):
    rng = random.Random(seed)
    rows = []
    roles, texts = ["user", "assistant", "system", "user", "assistant", "tool", "", None, "u"], ["Yes.", "No", "Why? ", "é!\n", "", " \t", None, "end of it.", "ü", " "]
    for c in range(conversations_):
        for t in range(rng.randint(1, longest)):
            rows.append((c if c else None, rng.choice([t, t, t, t + 3, None]), rng.choice(roles), rng.choice(texts) if rng.random() < 0.5 else f"{rng.random()}."))
    for t in range(hot):
        rows.append((-1, t // 2, "user" if t % 5 else "assistant", "Same." if t % 3 else f"{t}."))
    return rows


@pytest.mark.parametrize("hot,piece_rows,partitions", [(0, 16_384, 4), (300, 7, 4), (300, 1, 3), (40, 5, 1)])
def test_repair_against_a_plain_search(spark, hot, piece_rows, partitions):
    rows = random_turns(hot + piece_rows, 120, 9, hot)
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        table = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], TURNS)
        got = conversations.repair(conversations.damage(table), piece_rows=piece_rows).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    expected = {c: plain_repair(kept) for c, kept in plain_damage(rows).items()}
    assert len(got) == len(expected)
    for r in got:
        assert tuple(r)[1:] == expected[r["conv"]], r["conv"]


def test_repair_of_equal_turns_in_great_numbers(spark):
    """Long runs go by powers; repeated rows stay one row with a count."""
    rows = [(1, 5, "user", "Hello.")] * 30_000 + [(1, t, "user", f"{t}") for t in range(10, 2_010)]
    kept = plain_damage(rows)[1]
    got = conversations.repair(conversations.damage(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")), piece_rows=64).collect()[0]
    faults = collections.Counter()
    assert got["duplicate"] == len(kept) - len({(r, t) for _, r, t in kept if t.strip()}) - sum(not t.strip() for _, _, t in kept)
    for letter in got["audit"]:
        faults[letter] += 1
    assert faults["D"] + faults["K"] + faults["R"] == len(kept)
    # All are users: between two kept ones an assistant is missing, which a re-roled turn gives as cheaply.
    assert got["cost"] == 3 * faults["D"] + 2 * (faults["R"] + faults["I"]) + got["truncated"]
    assert abs(faults["R"] - faults["K"]) <= 1


def test_cut_lengths_of_runs_agree_with_single_turns():
    for symbol in range(9):
        behind = conversations.END
        for count in range(1, 40):
            one = behind
            for _ in range(count):
                one = conversations.onto(conversations.matrix(symbol), one)
            assert conversations.over_run(symbol, count, behind) == one
            assert conversations.onto(conversations.run_matrix(symbol, count), behind) == one
        for state in range(4):
            if symbol != conversations.DROPPED:
                letters, end = conversations.unroll(symbol, 37, state, behind)
                singles, at = [], state
                for k in range(37):
                    letter, at = conversations.unroll(symbol, 1, at, conversations.over_run(symbol, 36 - k, behind))
                    singles += letter
                assert (letters, end) == (singles, at)


def test_repair_of_dropped_and_absent_conversations(spark):
    dropped = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    got = conversations.repair(conversations.damage(spark.createDataFrame([(dropped, 0, "user", "x")], "conv_id long, turn long, role string, text string"))).collect()
    assert [tuple(r) for r in got] == [(dropped, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert conversations.repair(conversations.damage(none)).collect() == []


def test_repaired_turns(spark):
    rows = [("c", 1, "system", "Be kind.", 1), ("c", 2, "user", "Why?", 1), ("c", 3, "user", "Oh.", 1), ("c", 4, "assistant", "", 1)]
    got = conversations.repair(spark.createDataFrame(rows, "conv string, turn int, role string, text string, copies int"), with_turns=True).collect()[0]
    assert got["audit"] == "KKRD" and got["cost"] == 5
    assert [tuple(t) for t in got["repaired"]] == [("system", "Be kind."), ("user", "Why?"), ("assistant", "Oh.")]


# Byte-level BPE ---------------------------------------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("plain", pat_str=PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})


def pieces(rng):
    alphabet = ["a", "bc", " ", "  ", "\n", "'s", "'", "'ll", "'re", "1", "23", "!", "é", "ǘ", "中", "՘", "౜", "\U00011de0", " ", " ", "<|endoftext|>", "\x1c", "\x85", "🙂", "I'm"]
    return "".join(rng.choice(alphabet) * rng.choice([1, 1, 1, 2, 9]) for _ in range(rng.randint(0, 40)))


def test_stitched_chunks_of_any_size_agree_with_the_library(library):
    codec, rng = bpe.codec(RANKS, PATTERN), random.Random(2)
    for _ in range(600):
        text = pieces(rng)
        for chunk, overlap in ((1, 0), (1, 1), (2, 1), (3, 3), (7, 2), (16, 5)):
            tokens = bpe.pre_tokens(codec, text, chunk, overlap)
            assert "".join(tokens) == text
            assert codec.encode(tokens) == library.encode_ordinary(text)


@pytest.mark.parametrize("sizes", [{}, {"chunk": 16, "overlap": 5, "long_chars": 40}, {"chunk": 5, "overlap": 0, "long_chars": 0}])
def test_texts_against_the_library(spark, docs, library, sizes):
    rng = random.Random(4)
    more = [(1000 + k, pieces(rng) + "q" * (k % 50), "en", "s", 1, 0.0, "x", "y") for k in range(80)]
    rows = [r for r in awkward_docs() if len(r[1] or "") < 2_000 or not sizes] + more
    table = spark.createDataFrame(rows, DOCS).repartition(3)
    got = bpe.digests(table, RANKS, PATTERN, **sizes).collect()
    expected = []
    for doc_id, text, *_ in rows:
        ids = library.encode_ordinary(text or "")
        expected.append((doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    by = lambda r: tuple((v is None, v or 0) for v in r)
    assert sorted(map(tuple, got), key=by) == sorted(expected, key=by)


def test_very_long_pre_tokens(library):
    codec = bpe.codec(RANKS, PATTERN)
    for text in ("x" * 300_000 + " y", "é" * 200_000, "a " + " " * 2_000_000 + "b", "\n" * 200_000, "ab1" * 50_000):
        tokens = bpe.pre_tokens(codec, text, 65_536, 1_024)
        assert "".join(tokens) == text and codec.decode(codec.encode(tokens)) == text.encode()
        if len(text) < 1_000_000:  # the library's own split overflows on a million blanks
            assert codec.encode(tokens) == library.encode_ordinary(text)


def test_decoding_ids(spark, docs):
    ids = bpe.encode_texts(docs.select("text", "doc_id"), RANKS, PATTERN, chunk=500, overlap=20, long_chars=5_000)
    got = bpe.decode_ids(ids.filter("doc_id is not null"), RANKS, PATTERN).collect()
    texts = collections.defaultdict(set)
    for doc_id, text, *_ in awkward_docs():
        texts[doc_id].add((text or "").encode())
    assert len(got) > 80 and all(bytes(r["decoded"]) in texts[r["doc_id"]] for r in got)
    assert bpe.decode_ids(spark.createDataFrame([(1, None), (2, [])], "a int, ids array<int>"), RANKS, PATTERN).orderBy("a").collect()[1]["decoded"] == b""


def test_no_texts(no_docs):
    assert bpe.digests(no_docs, RANKS, PATTERN).collect() == []


def test_bad_sizes(no_docs):
    with pytest.raises(ValueError):
        bpe.encode_texts(no_docs, RANKS, PATTERN, chunk=4, overlap=5)


# Spelling variants ------------------------------------------------------------------------------------------------------------

def plain_vocabulary(rows):
    count = collections.Counter()
    for doc_id, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(UP)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            count[run] += 1
    return {w: n for w, n in count.items() if len(w) >= 7 and n >= 2}


def one_apart(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    a, b = sorted((a, b), key=len)
    i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[i + 1 :] == b[i + 1 :] if len(a) == len(b) else a[i:] == b[i + 1 :]


def plain_variants(vocab):
    form = {}
    near = {w: [v for v in vocab if one_apart(w, v)] for w in vocab}
    for w, others in near.items():
        best = min(others, key=lambda v: (-vocab[v], v), default=None)
        form[w] = best if best is not None and vocab[best] >= 10 * vocab[w] else None
    out = []
    for w in vocab:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, vocab[w], len(near[w]), vocab[form[w]] if form[w] else None))
    return sorted(out)


def variant_words(seed, n):
    rng = random.Random(seed)
    out = {}
    for _ in range(n):
        word = "".join(rng.choices("abÿ", k=rng.randint(6, 10)))
        out[word] = 10 ** rng.randint(0, 4) + rng.randint(0, 1)
    return out


@pytest.mark.parametrize("block", [4, 37, 16_384])
def test_variants_against_all_pairs(spark, block):
    vocab = variant_words(1, 700)
    got = spelling.group_variants(spark.createDataFrame(list(vocab.items()), "word string, n long"), block=block, min_length=2).collect()
    assert sorted(map(tuple, got)) == plain_variants(vocab)
    assert any(r["form"] and r["root"] != r["form"] for r in got)


def test_variants_of_whole_texts(spark):
    rng = random.Random(9)
    words = ["Straßenbahn", "institution", "INSTITUTION", "déjàvuvu", "resumé×resume", "parallel", "paralell", "instituton", "tion"]
    rows = [(k if k % 9 else None, ", ".join(rng.choices(words, [9, 30, 9, 3, 3, 40, 2, 1, 9], k=30)) if k % 10 else None, "en", "s", 1, 0.0, "x", "y") for k in range(150)]
    rows += awkward_docs()
    got = spelling.spelling_variants(spark.createDataFrame(rows, DOCS).repartition(3)).collect()
    assert sorted(map(tuple, got)) == plain_variants(plain_vocabulary(rows))
    assert len(got) > 5


def test_no_words(spark, no_docs):
    assert spelling.spelling_variants(no_docs).collect() == []
    assert spelling.spelling_variants(spark.createDataFrame([(1, None), (2, ""), (3, "1 2")], "doc_id long, text string")).collect() == []
