"""Small tables with the awkward rows every operator must take, and plain versions of the rules."""

from __future__ import annotations

import itertools
import random
import re
import zlib

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, component_id string, n_words string"
UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sentence(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choices("abcdefgh", k=rng.randint(1, 4))) for _ in range(n))


def awkward_docs(seed: int = 5) -> list[tuple]:
    """Null ids, texts and other columns, empty, blank, one-word and very long texts, repeated rows, ties, copies and edited copies."""
    rng = random.Random(seed)
    base = [sentence(rng, rng.randint(20, 90)) for _ in range(25)]
    texts: list[tuple[int | None, str | None]] = [(k, t) for k, t in enumerate(base)]
    for k in range(40):  # edited copies of a few texts
        words = base[k % 4].split()
        for _ in range(rng.randint(0, 5)):
            words[rng.randrange(len(words))] = rng.choice("xyzuvw") * 3
        texts.append((100 + k, " ".join(words)))
    texts += [(200 + k, base[7]) for k in range(12)]
    texts += [(300, None), (301, ""), (302, " \t\n\r\x0b\x0c "), (303, "one"), (304, "ONE"), (305, "a b c d"), (306, "é ß Äx y \U0001f600!"), (307, "<|endoftext|> x  \n y")]
    texts += [(None, base[9]), (None, None), (None, "alone and without an id at all"), (400, sentence(rng, 30_000))]
    texts += [(401, "same row"), (401, "same row"), (402, base[3]), (402, base[5])]
    return [(i, t, None if n % 7 == 0 else "en", None if n % 5 == 0 else "s0" if n % 3 else f"s{n}", None if n % 11 == 0 else len(t or ""), 0.5, "x", "y") for n, (i, t) in enumerate(texts)]


def shingles(text: str | None) -> frozenset:
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", (text or "").translate(UP)) if w]
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def components(n: int, links) -> list[int]:
    root = list(range(n))

    def find(x: int) -> int:
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]


def near_pairs(sets) -> list[tuple[int, int]]:
    out = []
    for a, b in itertools.combinations(range(len(sets)), 2):
        if sets[a] and sets[b]:
            both = len(sets[a] & sets[b])
            if 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                out.append((a, b))
    return out


def crc(value) -> int:
    return zlib.crc32(("" if value is None else str(value)).encode())
