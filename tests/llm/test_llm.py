"""Each operator against brute force, an exact round trip or held-out accuracy, and on odd tables."""

from __future__ import annotations

import datetime
import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tilesieve.llm import chat, langid, packing, pii, quality, queries, shingles, simhash, syncmers, treebpe, urls, vamana
from tilesieve.llm.components import connected
from tilesieve.llm.wordbpe import WordBpe

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, score string, fp string, _h int"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


@pytest.fixture(scope="module")
def texts(spark, sf_dir):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls everywhere, empty and very long texts, repeated rows and ids, clashing columns."""
    long = " ".join(f"word{i % 977}" for i in range(40_000)) + "é" * 3000
    rows = [(1, "a b c d e f g", "en"), (1, "a b c d e f g", "en"), (1, "another text of this id", "en"), (2, None, None), (3, "", "en")]
    rows += [(None, "no id here", "fr"), (None, None, None), (4, long, "en"), (5, long, "en"), (6, "\x00 \u0301 <|endoftext|> 'S", "fr"), (7, " \n\t ", "de")]
    return spark.createDataFrame([(i, t, g, "s", 0, "x", "y", 1) for i, t, g in rows], DOCS)


@pytest.fixture(scope="module")
def empty(odd):
    return odd.filter("1 = 0")


def test_chunk_table_gives_the_ids_of_the_library(library):
    bpe = WordBpe.of(queries.WORDS)
    random.seed(3)
    alphabet = list("abcdeABÉßéüÿ0129'''.,!$<|>  \n\t\x00\x1c\x85\xa0\u0301\u0130\u3000\u4e2dª×\x0b") + ["<|endoftext|>", "'s", "'re"]
    for _ in range(3000):
        text = "".join(random.choices(alphabet, k=random.randint(0, 30)))
        ids = library.encode(text, add_special_tokens=False).ids
        found = bpe.encode([text])[0]
        assert np.frombuffer(found, "<u4").tolist() == ids, text
        assert bpe.decode(found) == library.decode(ids, skip_special_tokens=False)


@pytest.mark.parametrize("leaf, window", [(3, 1), (8, 2), (64, 16)])
def test_tree_concatenation_is_exact_wherever_it_cuts(leaf, window):
    bpe = WordBpe.of(queries.WORDS)
    random.seed(leaf)
    tree = treebpe.TreeEncoder(bpe, leaf, window)
    alphabet = list("abcABÉß09''.,<|>") + ["<|endoftext|>", "'s", "e\u0301", "\xa0", " ", " ", "\n", "hello"]
    for k in range(500):
        text = "".join(random.choices(alphabet, k=random.randint(0, 300)))
        text = text.replace(" ", "").replace("\n", "") if k % 7 == 0 else text
        assert b"".join(tree.parts([text])[0]) == bpe.encode([text])[0], text


def test_op7_is_the_library(spark, sf_dir, texts, library):
    found = {r.doc_id: r for r in queries.op7_treebpe(spark, sf_dir).collect()}
    assert len(found) == len(texts)
    for doc, text in texts.items():
        ids = library.encode(text, add_special_tokens=False).ids
        assert found[doc].n_tokens == len(ids)
        assert found[doc].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert found[doc].decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_parts_in_several_tasks_give_the_same_ids(odd, library):
    whole = sorted((r.doc_id or 0, bytes(r.ids)) for r in treebpe.encode(odd, queries.WORDS).collect())
    spread = sorted((r.doc_id or 0, bytes(r.ids)) for r in treebpe.encode(odd, queries.WORDS, leaf=500, spread=20_000).collect())
    assert whole == spread and len(whole) == odd.count()
    want = sorted((r.doc_id or 0, np.array(library.encode(r.text or "", add_special_tokens=False).ids, "<u4").tobytes()) for r in odd.collect())
    assert whole == want


def packed_right(rows, texts, library, capacity):
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    assert set(pieces) == set(texts)
    for doc, mine in pieces.items():
        ids = [*library.encode(texts[doc], add_special_tokens=False).ids, 1]
        at = 0
        for r in sorted(mine, key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at : at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)
    for mine in sequences.values():
        at = 0
        for r in sorted(mine, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity and (at & (at - 1)) == 0  # no padding anywhere
    return len(sequences)


def test_op1_pieces_cover_every_id_once_without_padding(spark, sf_dir, texts, library):
    rows = queries.op1_packing(spark, sf_dir).collect()
    full = sum(r.length for r in rows) / 2048
    assert packed_right(rows, texts, library, 2048) < full + 40 * 11


def test_rests_stay_whole_and_fill_their_class():
    """At most one document a bin is cut, and a bin of class k opens with k rests of class k."""
    random.seed(5)
    sizes = [random.choice([1, 3, 40, 64, 65, 200, random.randint(1, 150)]) for _ in range(3000)]
    bins = packing.Bins(0, 64)
    for doc, n in enumerate(sizes):
        bins.add(doc, bytes(4 * n))
    early = bins.next
    bins.finish()
    sequences, pieces = defaultdict(list), defaultdict(int)
    for doc, start, length, _, tokens, sequence, *_ in bins.done:
        assert tokens == sizes[doc] and start + length <= tokens
        sequences[sequence].append((doc, start, length))
        pieces[doc] += length
    assert [pieces[d] for d in range(len(sizes))] == sizes
    for sequence in range(early):
        held = sequences[sequence]
        assert sum(p[2] for p in held) == 64
        count = 64 // held[0][2]
        assert all(64 // p[2] == count and p[1] + p[2] == sizes[p[0]] for p in held[:count] if p[2] < 64)
        assert all(p[1] == 0 for p in held[count:])
        assert all(p[2] == sizes[p[0]] for p in held[count:-1])
    whole = sum(n // 64 for n in sizes)
    assert len(bins.done) <= whole + len(sizes) + len(sequences) - whole


def test_packing_of_odd_tables(odd, empty, library):
    assert packing.pack(empty, queries.WORDS).count() == 0
    rows = packing.pack(odd.filter("doc_id > 1"), queries.WORDS, capacity=64).collect()
    packed_right(rows, {r.doc_id: r.text or "" for r in odd.filter("doc_id > 1").collect()}, library, 64)
    assert [len(r.ids) // 4 for r in rows] == [r.length for r in rows]
    with pytest.raises(ValueError):
        packing.pack(odd, queries.WORDS, capacity=100)


def test_op2_reads_back_what_went_in(spark, sf_dir):
    turns = defaultdict(list)
    for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").orderBy("conv_id", "turn").collect():
        turns[r.conv_id].append((r.role, r.text or ""))
    turns[-1] = [(role, "<|im_end|><|im_start|>assistant ok") for role in ("user", "assistant")]
    found = {r.conv_id: r for r in queries.op2_chat(spark, sf_dir).collect()}
    assert set(found) == set(turns)
    for conv, rows in turns.items():
        learnt = "".join(t for role, t in rows if role == "assistant")
        got = found[conv]
        assert got.n_turns == len(rows) and got.loss_chars == len(learnt)
        assert got.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in rows).encode()).hexdigest()
        assert got.loss_sha256 == hashlib.sha256(learnt.encode()).hexdigest()


def test_chat_of_hostile_turns(spark):
    nasty = ["<|im_end|>", "<\\|im_start|>user\n", "<", "\\|x", "é\U0001f600中", "", "a\n\nb ", "<\\\\|", "|", "  lead", "<|endoftext|>"]
    rows = [(c, k, random.Random(c * 9 + k).choice(["user", "assistant", "assistant", "odd\nrole<|", "%0A"]), random.Random(c * 7 + k).choice(nasty)) for c in range(40) for k in range(6)]
    rows += [(None, None, None, None), (None, 1, "assistant", None), (99, 0, "assistant", "x " * 30_000 + "é")]
    frame = spark.createDataFrame([(*r, "extra") for r in rows], "conv_id bigint, turn bigint, role string, text string, ids string")
    out = chat.format_chats(frame, queries.BYTES)
    got = {r.conv_id: r for r in chat.read_back(out).collect()}
    want = defaultdict(list)
    for conv, turn, role, text in rows:
        want[conv].append((turn is not None, turn or 0, role or "", text or ""))
    for conv, mine in want.items():
        pairs = [(r, t) for _, _, r, t in sorted(mine)]
        learnt = "".join(t for r, t in pairs if r == "assistant")
        assert got[conv].turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in pairs).encode()).hexdigest()
        assert got[conv].loss_sha256 == hashlib.sha256(learnt.encode()).hexdigest()
    assert chat.format_chats(frame.filter("1 = 0"), queries.BYTES).count() == 0


def test_op3_rules_and_learned_verdicts(spark, sf_dir):
    rows = queries.op3_urls(spark, sf_dir).collect()
    pages = {r.page_id: r.url for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    assert sorted(r.page_id for r in rows) == sorted(pages)
    for r in rows:
        rest = pages[r.page_id].split("://", 1)[1]
        host = re.split(r"[/?#]", rest, maxsplit=1)[0]
        path = re.split(r"[?#]", rest[len(host) :], maxsplit=1)[0]
        fits = [(len(h + p), h + p, v) for v, h, p in queries.URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        assert (r.host, r.path) == (host, path)
        assert r.rule == (max(fits)[1] if fits else None)
        assert r.verdict == max(fits)[2] if fits else r.verdict in ("allow", "block")


def test_templates_learn_a_blocked_section_and_generalise_ids(spark):
    rows = [(i, f"https://a.b.com/ads/{i}/x") for i in range(40)] + [(100 + i, f"https://a.b.com/news/{i}") for i in range(40)]
    rows += [(200, "https://a.b.com/ads/9999/other"), (201, "http://a.b.com/news/777?q=1"), (202, None), (203, "no scheme"), (204, "x://"), (205, "https://c.d/ads/5/x")]
    pages = spark.createDataFrame([(i, u, "h") for i, u in rows], "page_id bigint, url string, host string")
    rules = [("block", "b.com", f"/ads/{k}") for k in range(1, 4)] + [("allow", "b.com", "/news/1")]
    got = {r.page_id: r for r in urls.judge(pages, rules).collect()}
    assert got[200].rule is None or got[200].verdict == "block"
    assert got[0].rule is None and got[0].verdict == "block" and "*" in got[0].template
    assert got[201].verdict == "allow" and got[205].verdict == "block"
    assert (got[202].host, got[202].path, got[203].host) == ("", "", "")
    assert urls.judge(pages.filter("1 = 0"), rules).count() == 0


@pytest.mark.parametrize("sections", [20, 60])
def test_a_blocked_section_is_found_however_broad_its_branch(spark, sections):
    rows = [f"https://hot.com/s{s}/{i}" for s in range(sections) for i in range(30)]
    pages = spark.createDataFrame(list(enumerate(rows)), "page_id bigint, url string")
    rules = [("block" if s == 7 else "allow", "hot.com", f"/s{s}/1") for s in range(sections)]
    got = urls.judge(pages, rules).filter("rule is null").collect()
    assert {r.path.split("/")[1] for r in got if r.verdict == "block"} == {"s7"}
    assert {r.template.split("/")[1] for r in got if r.verdict == "block"} == {"s7"}


def test_urls_that_differ_from_the_sixth_segment_on_have_their_own_verdicts(spark):
    rows = [f"https://deep.com/blog/2020/05/12/x/{kind}/{i}" for kind in ("spam", "news") for i in range(30)]
    pages = spark.createDataFrame(list(enumerate(rows)), "page_id bigint, url string")
    rules = [(verdict, "deep.com", f"/blog/2020/05/12/x/{kind}/1") for verdict, kind in (("block", "spam"), ("allow", "news"))]
    got = urls.judge(pages, rules).filter("rule is null").collect()
    assert len(got) == 38 and all((r.verdict == "block") == ("/spam/" in r.path) for r in got)


def brute_anchors(text):
    tokens = []
    for word in text.lower().split():
        tokens += [word[i : i + 16] for i in range(0, len(word), 16)]
    return tokens


def test_syncmers_are_context_free_and_positional(spark, empty):
    random.seed(1)
    passage = " ".join(random.choice("alpha beta gamma delta eps zeta eta theta".split()) + str(random.randint(0, 99)) for _ in range(80))
    frame = spark.createDataFrame([(1, passage), (2, "other words come first " + passage + " and after")], "doc_id bigint, text string")
    a, b = (r.anchors for r in syncmers.anchors(frame).orderBy("doc_id").collect())
    assert 0.3 < len(a) / len(brute_anchors(passage)) < 0.7
    inside = [(x.hash, x.position + 4) for x in a]
    assert set(inside) <= {(x.hash, x.position) for x in b}
    both = spark.createDataFrame([(a, b)], "a array<struct<hash:int,position:int>>, b array<struct<hash:int,position:int>>")
    pairs = both.select(syncmers.matches(F.col("a"), F.col("b")).alias("m")).first().m
    assert {p.b - p.a for p in pairs} == {4}
    assert syncmers.with_edited(empty).count() == 0


def test_op4_edits_and_likeness(spark, sf_dir, texts):
    rows = {r.doc_id: r for r in queries.op4_syncmers(spark, sf_dir).collect()}
    ids = sorted(texts, reverse=True)
    assert set(rows) == set(ids)
    prints = {}
    for i, doc in enumerate(ids):
        text, after = texts[doc], texts[ids[(i + 1) % len(ids)]]
        edited = text[: len(text) - len(text) // 2] + after[: len(text) // 2]
        assert rows[doc].n_chars == len(text) and rows[doc].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert prints.setdefault(text, rows[doc].fingerprint) == rows[doc].fingerprint
        assert 0 <= rows[doc].near_edited <= 1
    long = [r for r in rows.values() if r.n_chars > 1000]
    assert np.mean([r.near_edited for r in long]) > 0.4 > 10 * np.mean([r.near_next for r in long])


def test_fingerprints_hold_every_anchor_with_its_position(spark):
    random.seed(5)
    words = lambda n: [f"w{random.randint(0, 10**6)}" for _ in range(n)]
    passage, a, b = words(60), words(3000), words(3000)
    texts = [" ".join(a[:1500] + passage + a[1500:]), " ".join(b[:500] + passage + b[500:])]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    rows = {r.doc_id: r for r in syncmers.with_edited(docs).collect()}
    for r in syncmers.anchors(docs).collect():
        assert rows[r.doc_id].fingerprint == [(x.hash << 32) | x.position for x in r.anchors] and len(r.anchors) > 1000
    one, two = ([x >> 32 for x in rows[i].fingerprint] for i in (0, 1))
    common = sum((Counter(one) & Counter(two)).values())
    assert common > 15 and rows[1].near_next == rows[0].near_next == 2 * common / (len(one) + len(two))
    again = spark.createDataFrame([([1 << 32, (1 << 32) + 1, 5 << 32], [1 << 32, 5 << 32, (5 << 32) + 9])], "a array<bigint>, b array<bigint>")
    assert again.select(syncmers.likeness(F.col("a"), F.col("b"))).first()[0] == 2 * 2 / 6


def test_syncmers_of_odd_rows(odd):
    rows = syncmers.with_edited(odd).collect()
    assert len(rows) == odd.count()
    assert len({tuple(r.fingerprint) for r in rows if r.doc_id in (4, 5)}) == 1
    assert all(r.fingerprint == [] for r in rows if r.doc_id in (2, 3, 7))


@pytest.fixture(scope="module")
def points(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(1500, 8)) * rng.uniform(0.5, 2, size=(1500, 1))
    x[300:800] = x[300]  # a vector that a third of the rows have
    rows = [(i, [float(c) for c in v], "x") for i, v in enumerate(x)]
    rows += [(5000, None, "x"), (5020, [], "x"), (5040, [0.0] * 8, "x"), (5060, [float("nan")] + [1.0] * 7, "x"), (5080, [None] + [1.0] * 7, "x"), (5100, [float("inf")] * 8, "x")]
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, score string"), x


def test_graph_search_recall_ties_and_left_out_vectors(points):
    frame, x = points
    found = defaultdict(list)
    for r in vamana.nearest(frame, frame.filter("vec_id % 20 = 0"), 20, shard=400).orderBy("query_id", "rank").collect():
        found[r.query_id].append((r.vec_id, r.score))
    asked = range(0, 1500, 20)
    assert sorted(found) == list(asked)
    hits = 0
    for q in asked:
        scores = x @ x[q]
        best = sorted((i for i in range(1500) if i != q), key=lambda i: (-round(scores[i], 12), i))[:20]
        assert len(found[q]) == 20 and all(abs(s - scores[i]) < 1e-9 for i, s in found[q])
        hits += len({i for i, _ in found[q]} & set(best))
    assert hits / (20 * len(asked)) >= 0.95


def test_op5_recall(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").orderBy("vec_id").collect()
    ids, x = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], float)
    found = defaultdict(set)
    for r in queries.op5_vamana(spark, sf_dir).collect():
        found[r.query_id].add(r.vec_id)
    recall = []
    for i, q in enumerate(ids):
        if q % 20 == 0:
            scores = x @ x[i]
            scores[i] = -np.inf
            recall.append(len(found[q] & set(ids[np.argsort(-scores)[:20]])) / 20)
    assert np.mean(recall) >= 0.9


def test_graph_search_of_few_and_no_vectors(points):
    frame, _ = points
    assert vamana.nearest(frame.filter("1 = 0"), frame.filter("vec_id < 40"), 5).count() == 0
    few = vamana.nearest(frame.filter("vec_id < 3"), frame.filter("vec_id < 3"), 20).collect()
    assert len(few) == 6 and max(r.rank for r in few) == 2


def test_op6_held_out_accuracy(spark, sf_dir):
    found = queries.op6_langid(spark, sf_dir).join(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang"), "doc_id")
    rows = found.filter("held_out").collect()
    assert np.mean([r.lang_pred == r.lang for r in rows]) > 0.95
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 for r in found.collect())


def test_language_of_odd_rows(odd, empty):
    model = langid.fit(odd)
    rows = langid.predict(odd, model).collect()
    assert len(rows) == odd.count()
    assert all(r.lang_pred == "und" and r.score == 0 and not r.accepted for r in rows if r.doc_id in (2, 3, 7))
    assert langid.keep_known(odd, model).columns == odd.columns
    nothing = langid.fit(empty)
    assert {r.lang_pred for r in langid.predict(odd, nothing).collect()} == {"und"}


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text))
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps, reach=3):
    root = {f: f for f in fps}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    order = sorted(fps)
    for i, a in enumerate(order):
        for b in order[:i]:
            if ((a ^ b) & (2**64 - 1)).bit_count() <= reach:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {f: find(f) for f in fps}


def test_op8_fingerprints_and_components(spark, sf_dir, texts):
    fps = {doc: brute_fingerprint(t) for doc, t in texts.items()}
    roots = brute_components(set(fps.values()))
    smallest = {}
    for doc, fp in fps.items():
        smallest[roots[fp]] = min(doc, smallest.get(roots[fp], doc))
    rows = queries.op8_simhash(spark, sf_dir).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in rows} == {d: (f"{fp:016x}", smallest[roots[fp]]) for d, fp in fps.items()}


@pytest.mark.parametrize("group, blocks", [(4, 5), (2048, 5), (16, 4), (64, 6)])
def test_links_lose_nothing_whatever_the_group_bound(spark, group, blocks):
    random.seed(7)
    fps = set()
    for _ in range(15):
        base = random.getrandbits(64)
        for _ in range(30):
            x = base
            for _ in range(random.randint(0, 5)):
                x ^= 1 << random.randrange(64)
            fps.add(x - (1 << 64) if x >> 63 else x)
    frame = spark.createDataFrame([(f,) for f in fps], "fp bigint")
    found = {r.node: r.root for r in connected(simhash.links(frame, group=group, blocks=blocks)).collect()}
    assert {f: found.get(f, f) for f in fps} == brute_components(fps)


def test_near_dedup_keeps_one_row_of_each_component(odd, empty):
    kept = simhash.keep_first(odd)
    assert kept.columns == odd.columns
    rows = kept.collect()
    ids = [r.doc_id for r in rows]
    assert ids.count(1) == 1 and 4 in ids and 5 not in ids
    # Null, empty and blank texts share the fingerprint 0; the smallest id stays.
    assert 2 in ids and 3 not in ids and 7 not in ids
    assert simhash.keep_first(empty).count() == 0


def brute_shingles(text):
    words = text.lower().split()
    return {" ".join(words[i : i + 5]) for i in range(len(words) - 4)} or ({" ".join(words)} if words else set())


@pytest.mark.parametrize("group", [4, 2048])
def test_near_dedup_stage_links_by_five_word_similarity(spark, group):
    random.seed(11)
    texts = []
    for _ in range(12):
        base = [f"w{random.randint(0, 5000)}" for _ in range(200)]
        for changes in (0, 0, 1, 2, 3, 4, 5, 6, 9, 20):
            words = list(base)
            for at in random.sample(range(200), changes):
                words[at] = f"new{random.randint(0, 10**6)}"
            texts.append(" ".join(words))
    sets = [brute_shingles(t) for t in texts]
    root = list(range(len(texts)))
    far = 0  # pairs that the three bits of op8 don't link
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if 5 * len(a & b) >= 4 * len(a | b):
                x, y = root[i], root[j]
                root = [min(x, y) if r in (x, y) else r for r in root]
                far += (brute_fingerprint(texts[i]) ^ brute_fingerprint(texts[j])).bit_count() > 3
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    assert far > 20
    assert {r.doc_id: r.component_id for r in shingles.components(docs, group=group).collect()} == dict(enumerate(root))
    if group > 4:
        assert {r.doc_id for r in corpus_pipeline.near_dedup_stage(spark, docs, "").collect()} == set(root)


@pytest.mark.parametrize("group", [4, 2048])
def test_stage_links_by_fingerprints_without_any_band(spark, group):
    random.seed(13)
    texts = []
    for _ in range(12):
        base = [f"w{random.randint(0, 5000)}" for _ in range(200)]
        for changes in (0, 0, 1, 1, 2, 3, 5, 8, 20):
            words = list(base)
            for at in random.sample(range(200), changes):
                words[at] = f"new{random.randint(0, 10**6)}"
            texts.append(" ".join(words))
    sets = [brute_shingles(t) for t in texts]
    fps = []
    for text in texts:
        words = text.split()
        hashes = [xxhash.xxh64_intdigest(s, 42) for s in {" ".join(words[i : i + 3]) for i in range(len(words) - 2)}]
        fps.append(sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)))
    met = brute_components(set(fps), shingles.REACH)
    root = list(range(len(texts)))
    apart = 0  # pairs of one group that are not alike
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if met[fps[i]] == met[fps[j]]:
                if 5 * len(a & b) >= 4 * len(a | b):
                    x, y = root[i], root[j]
                    root = [min(x, y) if r in (x, y) else r for r in root]
                else:
                    apart += 1
    assert apart > 5 and len(set(root)) < len(texts) - 30
    marked = corpus_pipeline.written(shingles.shingle_sets(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")), "test")
    first = {r.row: r.first for r in marked.groupBy("key").agg(F.min("row").alias("row"), F.min("doc_id").alias("first")).collect()}
    edges = shingles.links(marked.withColumn("bands", F.array().cast("array<bigint>")), group=group)
    found = {first[r.node]: first[r.root] for r in connected(edges).collect()}
    firsts = {d: min(e for e in range(len(texts)) if sets[e] == sets[d]) for d in range(len(texts))}
    assert [found.get(firsts[d], firsts[d]) for d in range(len(texts))] == root


def test_near_dedup_stage_goes_through_fingerprints(spark, monkeypatch):
    asked = []
    given = shingles.fingerprint_links
    monkeypatch.setattr(shingles, "fingerprint_links", lambda fps, *a, **k: asked.append(fps.count()) or given(fps, *a, **k))
    words = [f"w{i}" for i in range(300)]
    texts = [" ".join(words), " ".join([*words[:-1], "new"]), " ".join(words[::-1]), " ".join(words[::-1]), None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    assert {r.doc_id for r in corpus_pipeline.near_dedup_stage(spark, docs, "").collect()} == {0, 2, 4}
    assert len(asked) == 1 and 3 <= asked[0] <= 4


def test_bitmap_keeps_all_wanted_sets_and_few_others(spark):
    marked = spark.range(20_000).selectExpr("id AS row", "cast(cast(id AS string) AS binary) AS set")
    wanted = marked.filter("row % 7 = 3").select("row")
    found = shingles.sets_of(marked, wanted).collect()
    assert sorted((r.row, bytes(r.set)) for r in found) == [(i, str(i).encode()) for i in range(3, 20_000, 7)]


def test_stage_keeps_the_components_of_all_given_pairs(spark, sf_dir, texts):
    """All pairs of the given documents by brute force: nothing of similarity 0.8 is missed, nothing below is linked."""
    docs, sets = sorted(texts), {d: brute_shingles(t) for d, t in texts.items()}
    root = {d: d for d in docs}
    for i, a in enumerate(docs):
        for b in docs[:i]:
            common = len(sets[a] & sets[b])
            if root[a] != root[b] and (sets[a] == sets[b] or 5 * common >= 4 * (len(sets[a]) + len(sets[b]) - common)):
                x, y = root[a], root[b]
                root = {d: min(x, y) if r in (x, y) else r for d, r in root.items()}
    found = shingles.components(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    assert {r.doc_id: r.component_id for r in found.collect()} == root


def test_shingle_dedup_of_odd_tables(odd, empty):
    kept = shingles.keep_first(odd)
    ids = [r.doc_id for r in kept.collect()]
    assert kept.columns == odd.columns and ids.count(1) == 1 and 4 in ids and 5 not in ids
    assert 2 in ids and 3 not in ids and 7 not in ids
    assert shingles.keep_first(empty).count() == 0


def test_a_star_in_an_url_is_an_ordinary_value(spark):
    found = [f"http://y.com/a/n{k}/i/p" for k in range(40)] + [f"http://y.com/a/*/i/x{k}" for k in range(30)]
    found += [f"http://y.com/a/*/i/z{k}" for k in range(9)] + [f"http://*/q/a{k}" for k in range(20)] + ["http://*/q/z"]
    found += [f"http://bad{k}.net/q/a" for k in range(40)]
    pages = spark.createDataFrame(list(enumerate(found)), "page_id bigint, url string")
    rules = [("allow", "y.com", "/a/n"), ("block", "y.com", "/a/*/i/x"), ("allow", "*", "/q/a"), ("block", "net", "/q/a")]
    judged = {found[r.page_id]: r for r in urls.judge(pages, rules).collect()}
    for k in range(9):
        assert judged[f"http://y.com/a/*/i/z{k}"].verdict == "block"
        assert judged[f"http://y.com/a/*/i/z{k}"].template.startswith("/a/%2A/")
    assert judged["http://*/q/z"].verdict == "allow" and judged["http://*/q/z"].purity == 0.0


def test_feistel_is_a_permutation_without_fixed_points():
    f = pii.Feistel(b"k")
    for n in (2, 3, 7, 100, 257):
        for walk in (f.permute, f.other):
            image = [walk(i, n, b"t") for i in range(n)]
            assert sorted(image) == list(range(n)) and [walk(j, n, b"t", True) for j in image] == list(range(n))
        assert all(f.other(i, n, b"t") != i for i in range(n))


def test_pseudonyms_keep_formats_and_links(spark):
    text = "a.b+c@mail3.example.com 4195224655625070 4195-2246-5562-5070 +1 (523) 555-6688 36.199.153.245 2021-02-28 DE89 3704 0044 0532 0130 00 123-45-6789"
    names = pii.Pseudonyms(b"key")
    new, spans = names.replace(text)
    assert [k for k, _, _ in spans] == ["email", "card", "card", "phone", "ip", "date", "iban", "ssn"]
    value = {i: new[a:b] for i, (_, a, b) in enumerate(spans)}
    assert value[1] == value[2].replace("-", "") and pii.luhn(value[1]) == 0 and value[1] not in text
    datetime.date.fromisoformat(value[5])
    assert pii._mod97(value[6].replace(" ", "")[4:] + value[6][:4]) == 1
    assert len(new) == len(text) and re.sub(r"\w", "x", new) == re.sub(r"\w", "x", text)
    assert names.replace("again 36.199.153.245.")[0] == f"again {value[4]}."
    assert pii.Pseudonyms(b"key", back=True).replace(new)[0] == text
    beside = names.replace("12 4195224655625070 42 DE89 3704 0044 0532 0130 00 THE 4195 2246 5562 5070 1")[1]
    assert [k for k, _, _ in beside] == ["card", "iban", "card"]
    clean = "version 3.0, CC BY-NC 4.0, 1234567890123456, 12 of 2024, 300.1.2.3, 2021-13-45"
    assert names.replace(clean) == (clean, [])


def test_a_candidate_takes_nothing_that_follows_it():
    names = pii.Pseudonyms(b"key")
    card, iban = "4111 1111 1111 1111", "BE68 5390 0754 7034"
    for text, kinds in [
        (f"NO12 {card}", ["card"]),
        (f"{iban} {card}", ["iban", "card"]),
        (f"{iban} {iban}", ["iban", "iban"]),
        (f"1234 {card}", ["card"]),
        (f"AB14 CDEF {card} and 123-45-6789", ["card", "ssn"]),
        ("XX99 2001 2002 2004 10.1.2.33", ["ip"]),
    ]:
        new, spans = names.replace(text)
        assert [k for k, _, _ in spans] == kinds and len(new) == len(text), text
        assert card not in new and iban not in new
        # With this key the second card number makes a number of the 16 digits from 1234 on, too.
        assert text.startswith("1234") or pii.Pseudonyms(b"key", back=True).replace(new)[0] == text
    for text in ("NO12 4111 1111 1111 1112", "1234 5678 9012 3456", "no 99/99/2001 date"):
        assert names.replace(text) == (text, [])


def test_op9_leaves_no_value_and_no_clean_text_changed(spark, sf_dir, texts):
    rows = {r.doc_id: r for r in queries.op9_pseudonyms(spark, sf_dir).collect()}
    sure = re.compile(r"[\w.]+@[\w.]+\.com|\b4\d{15}\b|\+1 \(\d{3}\) 555-\d{4}|AKIA\w{16}|(?<=password=)\w+|(?<=token = \")\w+|\b\d{2,3}(?:\.\d{2,3}){3}\b")
    for doc, text in texts.items():
        found = sure.findall(text)
        assert rows[doc].n_found >= len(found) and len(rows[doc].text) == len(text)
        assert not [v for v in found if v in rows[doc].text]
        if not rows[doc].n_found:
            assert rows[doc].text == text


def test_op10_held_out_accuracy(spark, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    rows = queries.op10_quality(spark, sf_dir).join(labels, "doc_id").filter("held_out").collect()
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.9
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)


def test_discriminant_is_the_direct_density():
    rng = np.random.default_rng(0)
    x = [rng.normal(size=(200, 3)) @ np.diag([1, 2, 0.5]) + c for c in (0, 1)]
    model = quality.from_sums(np.array([200.0, 200.0]), np.array([z.sum(0) for z in x]), np.array([z.T @ z for z in x]), 0, 0)
    point = np.array([[0.3, -1.0, 0.8]])
    want = 0
    for sign, z in ((-1, x[0]), (1, x[1])):
        cov = np.cov(z.T, bias=True) + 1e-4 * np.eye(3)
        d = (point - z.mean(0))[0]
        want += sign * (-0.5 * d @ np.linalg.inv(cov) @ d - 0.5 * np.log(np.linalg.det(cov)))
    assert abs(model.difference(point)[0] - want) < 1e-9


def test_quality_of_odd_rows_and_without_labels(spark, odd, empty):
    labels = spark.createDataFrame([(1, 1, "x"), (4, None, "x"), (None, 0, "x")], "doc_id bigint, quality int, text string")
    model = quality.fit(odd, labels)
    assert {r.score for r in quality.score(odd, model).collect()} == {0.5}
    assert quality.keep_good(odd, model).count() == odd.count()
    assert quality.score(empty, model).count() == 0


def test_bytes_and_pseudonyms_of_odd_rows(odd, empty):
    assert pii.pseudonymise(odd, b"k").columns == odd.columns
    assert pii.findings(odd, b"k").filter("text is null").count() == odd.filter("text is null").count()
    assert pii.findings(empty, b"k").count() == 0 and treebpe.encode_decode(empty, queries.WORDS).count() == 0


def test_pipeline_stages_each_take_effect(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    left = {r.doc_id for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:3]:
        kept = stage(spark, docs, sf_dir)
        assert kept.columns == docs.columns
        now = [r.doc_id for r in kept.collect()]
        assert len(now) == len(set(now)) and set(now) <= left
        if name == "quality":
            gone = left - set(now)
            assert np.mean([labels[d] == 0 for d in gone if d in labels]) > 0.9
            assert sum(1 for d in gone if labels.get(d) == 1) <= 0.02 * len(left)
        left, docs = set(now), corpus_pipeline.written(kept, "test")
    assert simhash.components(docs).groupBy("component_id").count().filter("count > 1").count() == 0
    packed = corpus_pipeline.run(spark, sf_dir)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == left
