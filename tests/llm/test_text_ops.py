"""Operators over texts against brute force, with nulls, empty and long texts, ties, repeats and clashing columns."""

from __future__ import annotations

import hashlib
import math
import random
import re
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from strata.llm import dartminhash, decontaminate, suffix_dedup
from strata.llm._text import Hasher, shingles, utf8, words

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split(text):
    return WORD.findall((text or "").translate(LOWER))


def clashing(spark, rows, kind="doc_id bigint, text string"):
    """A table with extra columns whose names the operators use themselves."""
    df = spark.createDataFrame(rows, kind)
    for c in ("t", "d", "th", "node", "key", "db", "k0", "n_words", "spans", "items", "c", "s", "seg"):
        df = df.withColumn(c, F.lit("x"))
    return df.repartition(3)


def test_words_of_long_and_odd_texts():
    r = random.Random(3)
    texts = ["", "É ß-Ab1 z", "x" * 5_000_000 + " y", " ".join("w%d" % r.randrange(50) for _ in range(900_000)), "...", "a"]
    data, off = utf8(pa.array([*texts, None]))
    s, e, h, first = words(data, off, Hasher())
    for i, t in enumerate([*texts, None]):
        got = [data[a:b].tobytes().decode().translate(LOWER) for a, b in
               zip(s[first[i]:first[i + 1]][:1000], e[first[i]:first[i + 1]][:1000])]
        assert got == split(t)[:1000] and first[i + 1] - first[i] == len(split(t))
    same = {}
    for a, b, x in zip(s[-3000:], e[-3000:], h[-3000:]):
        assert same.setdefault(data[a:b].tobytes().lower(), x) == x
    sh, sf = shingles(h, first, 5)
    assert np.diff(sf).tolist() == [max(n - 4, min(n, 1)) for n in np.diff(first)]


# ---- decontamination -------------------------------------------------------------------------------------------

def brute_hits(docs, items, window):
    out = {}
    wins = {}
    for item, text in items:
        w = split(text)
        if item is None or not w:
            continue
        n = min(window, len(w))
        for i in range(len(w) - n + 1):
            wins.setdefault(tuple(w[i:i + n]), set()).add(str(item))
    for d, text in docs:
        w, hit, its = split(text), set(), set()
        for n in {len(x) for x in wins}:
            for i in range(len(w) - n + 1):
                if got := wins.get(tuple(w[i:i + n])):
                    hit.update(range(i, i + n))
                    its |= got
        out[d] = (len(w), len(hit), len(its), hashlib.sha256(",".join(sorted(its)).encode()).hexdigest(), bool(hit))
    return out


@pytest.mark.parametrize("block", [100_000, 7])
def test_decontamination_equals_brute_force(spark, block):
    r = random.Random(5)
    vocab = ["the", "of", "a"] * 4 + [f"w{i}" for i in range(12)] + ["é", "A1"]
    text = lambda n: " ".join(r.choice(vocab) for _ in range(n))
    items = [(i, text(r.choice([1, 3, 6, 9, 14]))) for i in range(12)] + [(3, "the of"), (40, None), (41, ""), (42, "..."),
                                                                       (None, "the of a"), (43, "the the the the the the")]
    docs = [(i, text(r.randrange(80)) + (" " + items[i % 12][1] if i % 3 == 0 else "")) for i in range(60)]
    docs += [(100, None), (101, ""), (102, "!!"), (103, "THE Of"), (104, "the " * 3000)]
    got = decontaminate.digest(decontaminate.decontaminate(
        clashing(spark, docs), spark.createDataFrame(items, "item_id bigint, text string").withColumn("win", F.lit(1)),
        window=6, block_windows=block)).collect()
    want = brute_hits(docs, items, 6)
    assert {g["doc_id"]: tuple(g)[1:] for g in got} == want
    assert any(v[4] for v in want.values()) and not all(v[4] for v in want.values())


def test_decontamination_of_empty_tables(spark):
    empty_docs = spark.createDataFrame([], "doc_id bigint, text string")
    items = spark.createDataFrame([(1, "a b c")], "item_id bigint, text string")
    assert decontaminate.decontaminate(empty_docs, items).count() == 0
    docs = spark.createDataFrame([(1, "a b c"), (1, "a b c"), (None, "a b c")], "doc_id bigint, text string")
    clean = decontaminate.digest(decontaminate.decontaminate(docs, items.limit(0))).collect()
    assert len(clean) == 3 and not any(r["contaminated"] for r in clean)
    hit = decontaminate.digest(decontaminate.decontaminate(docs, items)).collect()
    assert len(hit) == 3 and all(r["n_hit"] == 3 for r in hit)  # repeated rows and null ids stay


@pytest.mark.parametrize("form", ["list", "digest"])
def test_window_that_many_items_share(spark, form):
    """One boilerplate window in every item, two sets of windows in the documents, a hundred clean documents."""
    notice = "all rights reserved by the named owner"
    items = [(i, f"own{i} {notice}") for i in range(400)]
    docs = [(i, f"x{i} {notice} y") for i in range(50)] + [(50, f"a own7 {notice}"), (51, None)]
    docs += [(100 + i, f"clean {i}") for i in range(100)]
    found = decontaminate.decontaminate(
        spark.createDataFrame(docs, "doc_id bigint, text string"),
        spark.createDataFrame(items, "item_id bigint, text string"), window=7, item_form=form)
    got = {g["doc_id"]: tuple(g)[1:] for g in decontaminate.digest(found).collect()}
    assert got == brute_hits(docs, items, 7)
    assert got[0][2] == 400 and got[50][1] == 8 and got[100][2] == 0


def test_proposed_places_come_in_bounded_pieces():
    """A word under which many windows lie, in a text that holds little else."""
    wins = decontaminate.Windows([(i, f"the w{i}") for i in range(30)], {})
    by_word = decontaminate._word_hash([b"the"])[0][0]
    wins.order[:] = [0, 1]  # file all of them under the common word
    wins.keys, wins.first, wins.filed = np.array([by_word], np.uint64), np.array([0, 30]), np.arange(30)
    text = [b"the the w3 the w29 the", b"the", b"w3 the w0"]
    h = decontaminate._word_hash(text)
    first = np.cumsum([0] + [len(x) for x in h])
    doc_of = np.repeat(np.arange(3), np.diff(first))
    pieces = [len(s) for s, _ in wins.candidates(np.concatenate(h), room=40)]
    assert sum(pieces) == 30 * 6 and len(pieces) > 2 and max(pieces) <= 70
    for room in (1, 40, 1 << 20):
        start, win = wins.match(np.concatenate(h), first, doc_of, room)
        assert sorted(zip(start.tolist(), win.tolist())) == [(1, 3), (3, 29), (8, 0)]


def test_decontamination_keeps_named_columns(spark):
    docs = spark.createDataFrame([(1, "a b c", "k")], "doc_id bigint, text string, w string")
    items = spark.createDataFrame([(1, "b c")], "item_id bigint, text string")
    row = decontaminate.decontaminate(docs, items, keep=["w", "text"], item_form="none").collect()[0]
    assert row.asDict(recursive=True) == {"doc_id": 1, "w": "k", "text": "a b c", "n_words": 3,
                                          "spans": [{"start": 1, "end": 3}]}
    with pytest.raises(ValueError, match="clash"):
        decontaminate.decontaminate(docs.withColumn("spans", F.lit(1)), items, keep=["spans"])


# ---- suffix arrays ---------------------------------------------------------------------------------------------

def brute_repeats(rows, size):
    seen, out = set(), {}
    for d, text in sorted(rows, key=lambda x: x[0]):
        b = (text or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - size + 1):
            s = b[i:i + size]
            if s in seen:
                gone[i:i + size] = b"\1" * size
            seen.add(s)
        kept = bytes(x for x, f in zip(b, gone) if not f)
        runs = sum(1 for i, f in enumerate(gone) if f and (i == 0 or not gone[i - 1]))
        out[d] = (len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest())
    return out


def repeat_texts(n, seed):
    r = random.Random(seed)
    base = "".join(r.choice("ab ") for _ in range(500))
    page = "".join(r.choice("abcdefgh ") for _ in range(900))
    out = []
    for i in range(n):
        kind = r.randrange(6)
        if kind == 0:
            s = "a" * r.randrange(400)
        elif kind == 1:
            s = base[r.randrange(300):][:r.randrange(400)]
        elif kind == 2:
            s = list(page)
            for _ in range(r.randrange(6)):
                s[r.randrange(len(s))] = r.choice("xyz")
            s = "".join(s)
        elif kind == 3:
            s = "é" * r.randrange(120) + page[100:400] + "ab" * r.randrange(150)
        else:
            s = page[r.randrange(500):][:300] + base[:250]
        out.append((i, s))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_repeats_equal_brute_force(spark, seed):
    rows = repeat_texts(60, seed) + [(1000, None), (1001, ""), (1002, "x" * 99), (1003, "x" * 100), (1004, "x" * 5000)]
    got = suffix_dedup.remove_repeats(clashing(spark, rows), keep=["k0", "th"]).collect()
    assert all(r["k0"] == "x" and r["th"] == "x" for r in got)
    assert {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got} == brute_repeats(rows, 100)


def test_repeats_on_ties_nulls_and_empty_tables(spark):
    text = "".join(random.Random(9).choices("abcdef", k=300))
    df = spark.createDataFrame([(None, text), (5, text), (5, text), (4, text)], "doc_id bigint, text string")
    got = sorted(((r["doc_id"] is not None, r["doc_id"] or 0, r["n_removed"]) for r in
                  suffix_dedup.remove_repeats(df).collect()))
    # the null id comes first and stays; the two equal rows count as one document
    assert got == [(False, 0, 0), (True, 4, 300), (True, 5, 300), (True, 5, 300)]
    assert suffix_dedup.remove_repeats(df.limit(0)).count() == 0
    kept = suffix_dedup.remove_repeats(df, with_text=True).filter("doc_id = 4").first()["kept"]
    assert kept == ""


def test_anchors_do_not_depend_on_pieces():
    texts = [t for _, t in repeat_texts(40, 5)] + ["", "é" * 400, "x" * 99]
    data, off = utf8(pa.array(texts))
    whole = suffix_dedup.anchors(data, off, Hasher(), piece=1 << 20)
    for piece in (1, 64, 1000):
        cut = suffix_dedup.anchors(data, off, Hasher(), piece=piece)
        assert all((cut[k] == whole[k]).all() for k, _ in suffix_dedup.ANCHOR)
    # every window is judged once: offsets of a half times its rows
    windows = sum(max(len(t.encode()) - 99, 0) for t in texts)
    assert (whole["hi"].astype(int) - whole["lo"] + 1).sum() == windows


def test_anchors_of_a_long_text_in_bounded_memory():
    data = np.random.default_rng(1).integers(97, 123, 30_000_000).astype(np.uint8)
    tracemalloc.start()
    got = suffix_dedup.anchors(data, np.array([0, len(data)]), Hasher())
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(got["pos"]) > len(data) // 40 and peak < 1_000_000_000


def test_a_short_hot_phrase_spreads_over_keys():
    r = random.Random(8)
    phrase = "".join(r.choices("abcdefgh", k=50))
    texts = ["".join(r.choices("abcdefgh", k=150)) + phrase + "".join(r.choices("abcdefgh", k=150)) for _ in range(400)]
    data, off = utf8(pa.array(texts))
    keys = suffix_dedup.anchors(data, off, Hasher())["key"]
    assert np.unique(keys, return_counts=True)[1].max() == 1


def test_long_texts_and_repeats_across_pieces(spark):
    r = random.Random(12)
    body = "".join(r.choices("abcdefghijklmnopqrstuvwxyz ", k=1_500_000))
    tail = "".join(r.choices("abcdefghijklmnopqrstuvwxyz ", k=1_000_000))
    df = spark.createDataFrame([(1, body), (2, tail + body[400_000:1_400_000])], "doc_id bigint, text string")
    got = {x["doc_id"]: x for x in suffix_dedup.remove_repeats(df, with_text=True).collect()}
    assert got[1]["kept"] == body
    assert got[2]["kept"] == tail and got[2]["n_spans"] == 1 and got[2]["n_removed"] == 1_000_000


def test_repeats_raise_on_clashing_columns(spark):
    df = spark.createDataFrame([(1, "x", 2)], "doc_id bigint, text string, n_bytes int")
    with pytest.raises(ValueError, match="clash"):
        suffix_dedup.remove_repeats(df, keep=["n_bytes"])


def test_deep_shallow_order_and_trie():
    r = random.Random(4)
    rows = [bytes(r.choice(b"ab") for _ in range(20)) for _ in range(50)]
    rows += [b"a" * 48 + bytes(r.choice(b"abc") for _ in range(20)) for _ in range(80)]
    rows = [x.ljust(68, b"\0") for x in rows] + [b"a" * 68] * 5
    m = np.frombuffer(b"".join(rows), np.uint8).reshape(-1, 68)
    order = suffix_dedup.deep_shallow(m)
    assert [rows[i] for i in order] == sorted(rows)
    trie = suffix_dedup.BlindTrie([x[40:] for x in rows])
    assert [rows[i][40:] for i in trie.order()] == sorted(x[40:] for x in rows)
    cls = suffix_dedup.depth_classes(m, [0, 1, 30, 68])
    for d, c in zip([0, 1, 30, 68], cls):
        assert len(set(c)) == len({x[:d] for x in rows})
        assert len(set(zip(c, (x[:d] for x in rows)))) == len(set(c))


# ---- DartMinHash -----------------------------------------------------------------------------------------------

def bags(text):
    w = split(text)
    return Counter(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter({("raw", text or ""): 1})


def brute_classes(docs, similar=0.8):
    home = {d: d for d, _ in docs}

    def find(x):
        while home[x] != x:
            x = home[x]
        return x

    b = {d: bags(t) for d, t in docs}
    for i, (x, _) in enumerate(docs):
        for y, _ in docs[:i]:
            both = sum((b[x] & b[y]).values())
            if both >= similar * (sum(b[x].values()) + sum(b[y].values()) - both):
                p, q = find(x), find(y)
                home[max(p, q)] = min(p, q)
    return {d: find(d) for d, _ in docs}


def test_dart_signatures_estimate_the_weighted_similarity():
    r = random.Random(1)
    for n, change in ((300, 10), (300, 60), (40, 4), (3, 0)):
        a = [f"w{r.randrange(200)}" for _ in range(n)]
        b = list(a)
        for _ in range(change):
            b[r.randrange(n)] = f"x{r.randrange(99)}"
        data, off = utf8(pa.array([" ".join(a), " ".join(b)]))
        _, _, h, first = words(data, off, Hasher())
        sig = dartminhash.signatures(*dartminhash.cells(*shingles(h, first, 1)), 2, 2048)
        x, y = Counter(a), Counter(b)
        both = sum((x & y).values())
        assert abs((sig[0] == sig[1]).mean() - both / (2 * n - both)) < 5 * math.sqrt(0.25 / 2048) + 0.005


def test_near_duplicates_equal_brute_force(spark):
    r = random.Random(8)
    docs, n = [], 0

    def add(words_):
        nonlocal n
        docs.append((n, " ".join(words_)))
        n += 1

    for _ in range(25):
        base = [f"w{r.randrange(400)}" for _ in range(r.choice([3, 8, 60, 200]))]
        add(base)
        for _ in range(r.randrange(4)):
            copy = list(base)
            for _ in range(r.randrange(1 + len(copy) // 40)):
                copy[r.randrange(len(copy))] = f"y{r.randrange(99)}"
            add(copy)
    hot = [f"h{i}" for i in range(150)]  # a large group of near copies, some not similar to one another
    for i in range(60):
        copy = list(hot)
        for _ in range(3):
            copy[r.randrange(150)] = f"z{r.randrange(500)}"
        add(copy)
    docs += [(500, None), (501, ""), (502, "!!!"), (503, "???"), (504, "???"), (505, "One two"), (506, "one, TWO!")]
    got = dartminhash.near_duplicates(clashing(spark, docs)).collect()
    assert {g["doc_id"]: g["class_id"] for g in got} == brute_classes(docs)
    kept = Counter(g["class_key"] for g in got if g["kept"])
    assert set(kept.values()) == {1} and len(kept) == len({bytes(g["class_key"]) for g in got})


def test_long_texts_without_common_words_have_similarity_zero(spark):
    docs = spark.createDataFrame([(i, " ".join(f"{c}{j}" for j in range(200_000))) for i, c in enumerate("xy")],
                                 "doc_id bigint, t string")
    a, b = (bytes(row["cells"]) for row in dartminhash._element_sets(docs, 5).collect())
    assert dartminhash.weighted_jaccard(a, b) == 0
    assert dartminhash.weighted_jaccard(a, a) == 1


def test_pairs_that_share_one_band_only_are_checked(spark):
    """Similar texts whose signatures agree at 4 of 96 coordinates still meet in the bucket of their band."""
    r = np.random.default_rng(3)
    sig = r.integers(1, 1 << 32, (3, dartminhash.K), dtype=np.uint32)
    sig[:, 4:8] = sig[0, 4:8]
    docs = spark.createDataFrame([(0, " ".join(f"x{i}" for i in range(60))), (1, " ".join(f"y{i}" for i in range(60))),
                                  (2, " ".join(f"y{i}" for i in range(1, 60)))], "doc_id bigint, t string")
    sets = {bytes(row["node"]): bytes(row["cells"]) for row in dartminhash._element_sets(docs, 5).collect()}
    assert len(sets) == 3
    payload = [(n, sig[i].tobytes(), c) for i, (n, c) in enumerate(sets.items())]
    members = spark.createDataFrame([(7, 1, n, n) for n, _, _ in payload], "key bigint, band int, node binary, comp binary")
    payload = spark.createDataFrame(payload, "node binary, sig binary, cells binary")
    links = dartminhash._joining_links(members, payload, 0.8, dartminhash.K, dartminhash.ROWS).collect()
    alike = [n for n, c in sets.items() if any(m != n and dartminhash.weighted_jaccard(c, d) >= 0.8 for m, d in sets.items())]
    assert len(alike) == 2
    assert [(bytes(x["a"]), bytes(x["b"])) for x in links] == [(max(alike), min(alike))]


@pytest.mark.parametrize("room", [1 << 22, 3000])
def test_crowded_buckets_meet_block_by_block(spark, room):
    """Components of the links equal those of all similar pairs that share a band, however small the blocks are."""
    from strata.llm.links import components

    r = random.Random(room)
    texts = []
    for group in range(3):
        base = [f"g{group}x{i}" for i in range(60)]
        for _ in range(25):
            copy = list(base)
            for _ in range(r.randrange(4)):
                copy[r.randrange(60)] = f"z{r.randrange(500)}"
            texts.append(" ".join(copy))
    docs = spark.createDataFrame(list(enumerate(dict.fromkeys(texts))), "doc_id bigint, t string").withColumn("th", F.xxhash64("t"))
    rows = dartminhash.sketch(docs).collect()
    sets = {bytes(x["node"]): bytes(x["cells"]) for x in dartminhash._element_sets(docs.select("doc_id", "t"), 5).collect()}
    payload = spark.createDataFrame([(bytes(x["node"]), bytes(x["sig"]), sets[bytes(x["node"])]) for x in rows],
                                    "node binary, sig binary, cells binary")
    at = {}
    for x in rows:
        for key in x["bands"]:
            at.setdefault(key, []).append(bytes(x["node"]))
    members = spark.createDataFrame([(k, n, n) for k, ns in at.items() if len(ns) > 1 for n in ns], "key bigint, node binary, comp binary")
    links = dartminhash._joining_links(members, payload, 0.8, dartminhash.K, dartminhash.ROWS, room=room, least=1)
    pairs = {(max(a, b), min(a, b)) for ns in at.values() for a in ns for b in ns
             if a != b and dartminhash.weighted_jaccard(sets[a], sets[b]) >= 0.8}
    assert {(bytes(x["a"]), bytes(x["b"])) for x in links.collect()} <= pairs
    want = components(spark.createDataFrame(list(pairs), "a binary, b binary")).collect()
    assert {tuple(map(bytes, x)) for x in components(links).collect()} == {tuple(map(bytes, x)) for x in want} and len(want) > 10


def test_near_duplicates_nulls_repeats_and_empty(spark):
    df = spark.createDataFrame([(None, "a b c"), (7, "A b c"), (3, "a b c"), (3, "a b c"), (9, "other words here")],
                               "doc_id bigint, text string")
    got = dartminhash.near_duplicates(df).collect()
    assert len(got) == 5
    assert {(g["doc_id"], g["class_id"]) for g in got} == {(None, None), (7, None), (3, None), (9, 9)}
    assert sum(g["kept"] for g in got) == 2
    assert dartminhash.near_duplicates(df.limit(0)).count() == 0


def test_components_of_a_long_chain_and_a_hub(spark):
    from strata.llm.links import components

    edges = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 180)] + [(200, 200)]
    df = spark.createDataFrame(edges, "a int, b int")
    got = dict(tuple(r) for r in components(df).collect())
    assert got == {**{i: 0 for i in range(61)}, **{i: 100 for i in range(100, 180)}}
    assert components(df.limit(0)).count() == 0
