"""Collocations, hard negatives and the positional index against brute force, and on odd tables.

On the given tables all three are compared with their SQL (tests/test_oracle.py).
"""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tilesieve.llm import collocations, negatives, posindex

DOCS = "doc_id bigint, text string, lang string, key string, n_words string, phrase string, _h int"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, g, "x", "y", "z", 1) for i, t, g in rows], DOCS)


@pytest.fixture(scope="module")
def odd(spark):
    long = " ".join(f"w{i % 97}" for i in range(20_000))
    rows = [(1, "A b c, a b\tc. A B", "en"), (1, "a b c a b c", "en"), (2, None, None), (3, "", "en"), (None, "a  b É é\x0bc", None), (4, long, "de"), (5, long, "de")]
    return docs_of(spark, rows)


def brute_counts(rows, longest, threshold):
    """{(lang, words): number} of phrases within pieces."""
    found: dict = {}
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for _, text, lang in rows:
        for piece in "".join("\n" if c in ".,;:!?\n\x0b\x0c\r" else c for c in (text or "").translate(low)).split("\n"):
            words = [w for w in piece.replace("\t", " ").split(" ") if w]
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    at = (lang or "und", " ".join(words[i : i + k]))
                    found[at] = found.get(at, 0) + 1
    return {p: n for p, n in found.items() if n >= threshold}


@pytest.mark.parametrize("shards, bits, longest", [(2, 16, 3), (1, 8, 4)])
def test_every_phrase_is_counted_once_whatever_the_shards_and_slots(odd, shards, bits, longest):
    found = collocations.phrase_counts(odd, longest=longest, threshold=2, shards=shards, bits=bits, flush=50)[0].collect()
    rows = [(r.doc_id, r.text, r.lang) for r in odd.collect()]
    assert {(r.lang, r.phrase): r.f for r in found} == brute_counts(rows, longest, 2)


def test_collocations_of_no_documents(odd):
    assert collocations.collocations(odd.filter("1 = 0")).count() == 0


def points_of(spark, x, labels):
    return spark.createDataFrame([(i, v, g, 0) for i, (v, g) in enumerate(zip(x, labels))], "vec_id bigint, embedding array<double>, label int, score int")


def brute_mined(points, every):
    rows = [(r.vec_id, r.label, [int(np.floor(256 * v)) for v in r.embedding]) for r in points.collect() if r.vec_id is not None and r.label is not None and r.embedding is not None and all(v is not None and np.isfinite(v) for v in r.embedding)]
    out = []
    for a, g, v in rows:
        if a % every:
            continue
        scored = sorted((-sum(p * q for p, q in zip(v, w)), i, h) for i, h, w in rows if i != a)
        for s, p, _ in [x for x in scored if x[2] == g][:5]:
            fits = [(n, i) for n, i, h in scored if h != g and 80 * -s <= 100 * -n <= 100 * -s][:5]
            out += [(a, p, k + 1, i, -s, -n) for k, (n, i) in enumerate(fits)]
    return sorted(out)


def test_hard_negatives_are_those_of_all_pairs(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(6, 12))
    x = (centres[rng.integers(0, 6, 300)] + rng.normal(size=(300, 12)) * 0.2).tolist()
    x[5], x[6], x[7], x[8], x[9], x[10] = None, [None] * 12, [float("nan")] * 12, [float("inf")] * 12, [0.0] * 12, x[20]
    points = points_of(spark, x, [None if i == 11 else int(i % 4) for i in range(300)])
    points = points.unionByName(points.filter("vec_id = 30"))  # a row that comes twice
    found = negatives.mine(points, F.col("id") % 10 == 0, block_bytes=4_000)
    assert sorted(tuple(r) for r in found.collect()) == brute_mined(points, 10)
    assert negatives.mine(points.filter("1 = 0"), F.col("id") % 10 == 0).count() == 0


def test_score_bounds_hold_and_discard():
    rng = np.random.default_rng(1)
    x = np.floor(256 * np.repeat(rng.normal(size=(8, 16)), 40, axis=0) + rng.normal(size=(320, 16)))
    norms, held = negatives.angles(x, negatives.references(x))
    bottom, top = negatives.score_bounds(norms, held, held, held, norms, norms)
    exact = x @ x.T
    assert (bottom <= exact).all() and (exact <= top).all()
    assert (top < 0.9 * norms[:, None] * norms[None]).mean() > 0.5


def brute_hits(docs, items, size):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    split = lambda t: "".join(c if c.isascii() and c.isalnum() or ord(c) > 127 else " " for c in (t or "").translate(low)).split(" ")
    words = lambda t: [w for w in split(t) if w]
    out = []
    for i, text in docs:
        own, hit, named = words(text), set(), set()
        for k, t in items:
            test = words(t)
            n = min(size, len(test))
            for s in range(len(test) - n + 1 if n else 0):
                for p in range(len(own) - n + 1):
                    if own[p : p + n] == test[s : s + n]:
                        hit |= set(range(p, p + n))
                        named.add(str(k))
        out.append((i, len(own), len(hit), sorted(named)))
    return sorted(out, key=str)


def test_phrases_found_are_those_of_all_positions(spark):
    rng = np.random.default_rng(8)
    text = lambda n: " ".join(rng.choice(list("abcde"), n))
    rows = [(i, text(60) if i % 3 else "É-a B c a b d, e A É " * 4) for i in range(12)] + [(1, None), (None, "a b a"), (2, ""), (3, "x" * 2000)]
    items = [(1, text(9)), (2, "a b a"), (2, "É a b c"), (3, None), (4, "..."), (5, "nowhere at all"), (6, text(90))]
    docs, tests = docs_of(spark, [(i, t, "en") for i, t in rows]), spark.createDataFrame(items, "item_id int, text string")
    found = posindex.contamination(docs, tests, size=4).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_hit, r["items"]) for r in found), key=str) == brute_hits(rows, items, 4)
    assert posindex.contamination(docs.filter("1 = 0"), tests).count() == 0
    assert [r.n_hit for r in posindex.contamination(docs, tests.filter("1 = 0")).collect()] == [0] * len(rows)
