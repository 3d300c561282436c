"""Ranked lexical search, trie SimHash and conversation repair against brute force."""

from __future__ import annotations

import math
import random
import re
from collections import Counter
from functools import lru_cache

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from strata.llm import lexical, repair, simhash
from strata.llm.links import components

SF = "/root/testdata/sf0.001"
ASCII_LOWER = {i: i + 32 for i in range(65, 91)}


# ---- ranked lexical search ---------------------------------------------------------------------------------------

def brute_rank(docs, items, k):
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (t or "").translate(ASCII_LOWER))
    tf = [(i, Counter(split(t))) for i, t in docs if split(t)]
    n, total = len(tf), sum(sum(c.values()) for _, c in tf)
    df = Counter(t for _, c in tf for t in c)
    wanted = {}
    for item, t in items:
        if item is not None:
            wanted.setdefault(item, set()).update(split(t))
    out = []
    for item, terms in wanted.items():
        got = []
        for i, c in tf:
            m = 10 + (90 * sum(c.values()) * n) // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
                        for t in terms if c[t])
            if score > 0:
                got.append((-score, i is not None, i or 0, i))
        out += [(item, r, g[3], -g[0]) for r, g in enumerate(sorted(got)[:k], 1)]
    return sorted(out, key=repr)


def ranked(spark, docs, items, k=10, **how):
    d = spark.createDataFrame(docs, "doc_id bigint, text string").withColumn("item", F.lit(1)).withColumn("n", F.lit("x"))
    i = spark.createDataFrame(items, "item_id bigint, text string").withColumn("doc_id", F.lit(3))
    got = lexical.rank_documents(d, i, k, **how)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(map(tuple, got.collect()), key=repr)


@pytest.mark.parametrize("entries", [1, 40, 1 << 18])
def test_ranking_equals_brute_force(spark, entries, monkeypatch):
    r = random.Random(entries)
    vocab = [f"w{i}" for i in range(150)] + ["É", "é", "ab1"]
    draw = lambda n: " ".join(r.choice(vocab[:r.choice([5, 40, 153])]) + r.choice(["", ",", ";-"]) for _ in range(n))
    docs = [(i, draw(r.choice([0, 1, 3, 30, 200]))) for i in range(300)]
    docs += [(7, docs[7][1]), (None, "W1 w2 w3"), (None, None), (900, None), (901, ""), (902, "--- !"), (903, "W1 W1 w1")]
    items = [(i, draw(r.choice([1, 4, 30]))) for i in range(12)] + [(20, " ".join(vocab)), (21, None), (22, "??"), (None, "w1"),
                                                                    (3, "w1 w2"), (23, "nowhere"), (24, "w1 W1")]
    assert ranked(spark, docs, items, 10, entries=entries) == brute_rank(docs, items, 10)


def test_ranking_ties_long_texts_and_empty_tables(spark):
    long = "the cat " * 400_000 + "needle"  # 3.2 MB
    docs = [(2, "cat dog"), (1, "dog cat"), (3, "cat dog"), (4, long), (5, "cow")]
    items = [(1, "cat needle"), (2, "dog")]
    assert ranked(spark, docs, items, 2) == brute_rank(docs, items, 2)
    assert ranked(spark, [], items) == [] and ranked(spark, docs, []) == []


def test_masks_stop_early_but_lose_nothing():
    r = np.random.default_rng(4)
    for _ in range(30):
        n, terms = 60, 70
        size = r.integers(1, 20, n)
        term = np.concatenate([r.choice(terms, s, replace=False) for s in size])
        block = lexical.Block(np.arange(n), r.integers(10, 300, n), size, term, r.integers(1, 9, len(term)), r.integers(0, 999, terms))
        want = np.sort(r.choice(terms, 66, replace=False))
        ids, score = lexical.best_of_block(block, want, np.zeros(0, np.int64), np.zeros(0, np.int64), 5, step=3)
        ends = np.concatenate([[0], np.cumsum(size)])
        full = [int(block.gain[ends[d]:ends[d + 1]][np.isin(term[ends[d]:ends[d + 1]], want)].sum()) for d in range(n)]
        best = sorted((-s, d) for d, s in enumerate(full) if s > 0)[:5]
        assert [(-s, d) for d, s in zip(ids.tolist(), score.tolist())] == best


# ---- SimHash -----------------------------------------------------------------------------------------------------

def brute_fingerprint(text, k=4):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(ASCII_LOWER))
    sh = [" ".join(w[i:i + k]) for i in range(len(w) - k + 1)] if len(w) >= k else ([" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(prints, budget=4):
    """{key: smallest key of its component} of {key: fingerprint}."""
    keys = sorted(prints)
    home = {k: k for k in keys}
    for _ in keys:
        old = dict(home)
        for a in keys:
            for b in keys:
                if (prints[a] ^ prints[b]).bit_count() <= budget:
                    home[a] = home[b] = min(home[a], home[b])
        if home == old:
            break
    return home


def test_simhash_equals_brute_force(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    docs += [(9001, None), (9002, ""), (9003, " \n\t"), (9004, "One two"), (9005, "one\ttwo "), (9006, "b b b b b b b")]
    df = spark.createDataFrame(docs, "doc_id bigint, text string").withColumn("fp", F.lit(1)).withColumn("comp", F.lit(2))
    got = simhash.near_duplicates(df).collect()
    prints = {i: brute_fingerprint(t) for i, t in docs}
    assert {r["doc_id"]: int(r["fingerprint"], 16) for r in got} == prints
    assert all(re.fullmatch("[0-9a-f]{16}", r["fingerprint"]) for r in got)
    assert {r["doc_id"]: r["component_id"] for r in got} == brute_components(prints)


def test_simhash_long_texts_null_ids_and_empty_table(spark):
    r = random.Random(5)
    texts = [" ".join(r.choice(["Ab", "cd", "é", "x" * r.randrange(1, 40)]) for _ in range(n)) for n in (5, 200_000)]
    texts += ["a" * 2_500_000 + " b c", "   " * 800_000 + "a b c d e", "a" * 1_200_000 + " " + "b" * 1_300_000 + " c d e" + " " * 1_100_000]
    df = spark.createDataFrame([*enumerate(texts), (None, texts[0]), (None, "lonely words are here"), (0, texts[0])], "doc_id bigint, text string")
    got = simhash.near_duplicates(df).collect()
    assert len(got) == len(texts) + 3
    for x in got:
        if x["doc_id"] is not None:
            assert int(x["fingerprint"], 16) == brute_fingerprint(texts[x["doc_id"]])
    assert sorted(((x["component_id"] is None) for x in got if x["doc_id"] is None)) == [False, True]
    assert simhash.near_duplicates(df.limit(0)).collect() == []


@pytest.mark.parametrize("limit", [25, 1 << 17])
def test_trie_join_with_crowded_nodes(spark, limit):
    r = random.Random(8)
    values = {r.getrandbits(64) for _ in range(60)}
    for base in (0, r.getrandbits(64)):
        for _ in range(90):
            v = base
            for _ in range(r.randrange(9)):
                v ^= 1 << r.randrange(64)
            values.add(v)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    links = simhash.trie_links(spark.createDataFrame([(v,) for v in signed], "fp bigint"), 4, limit).checkpoint()
    rows = links.collect()
    mask = (1 << 64) - 1
    assert all(((x["a"] ^ x["b"]) & mask).bit_count() <= 4 for x in rows)
    comp = {x["node"]: x["comp"] for x in components(links).collect()}
    assert {v: comp.get(v, v) for v in signed} == brute_components({v: v & mask for v in signed})


# ---- conversation repair -----------------------------------------------------------------------------------------

def brute_audit(rows):
    """(cost, audit, repaired) over an automaton; rows: (initial, role, text, fault)."""
    best = [(0, "")] + [None] * 3

    @lru_cache(None)
    def go(i, p, spare):
        ways = [(0, "", ())] if i == len(rows) and p in (0, 3) else []
        step = lambda cost, letter, turn, rest: [(cost + rest[0], letter + rest[1], turn + rest[2])] if rest else []
        want = "a" if p == 2 else "u"
        then = 3 if p == 2 else 2
        name = {"u": "user", "a": "assistant"}[want]
        if i < len(rows):
            initial, role, text, fault = rows[i]
            ways += step(3, "D", (), go(i + 1, p, 3))
            if fault not in ("blank", "duplicate"):
                bad = fault == "truncated"
                ways += step(bad if initial == want else 2 + bad, "K" if initial == want else "R",
                             ((role if initial == want else name, text),), go(i + 1, then, 3))
                if p == 0 and initial == "s":
                    ways += step(bad, "K", ((role, text),), go(i + 1, 1, 3))
        if spare:
            ways += step(2, "I", ((name, ""),), go(i, then, spare - 1))
        return min(ways) if ways else None

    del best
    return go(0, 0, 3)


def judge(turns):
    """Rows of one conversation in order -> (initial, role, text, fault)."""
    turns = sorted(((t is not None, t or 0, r or " ", x if x is not None else " ") for t, r, x in turns))
    seen, out = set(), []
    for _, _, role, text in turns:
        shown = text.strip(" \t\n\x0b\x0c\r")
        fault = ("blank" if not shown else "duplicate" if (role, text) in seen else "truncated" if shown[-1] not in ".!?" else "none")
        seen.add((role, text))
        out.append((role[:1], role, text, fault))
    return out


def random_turns(r, n):
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "User", "", None]
    texts = ["Hi.", "ok", "why? ", "a!\n", " ", "", None, "\t", "x.y", "fine.", "done!", "what"]
    return [(r.choice([i, i, i, None, i + 3]), ["user", "assistant"][i % 2] if r.random() < .6 else r.choice(roles),
             r.choice(texts) if r.random() < .5 else f"t{i}.") for i in range(n)]


@pytest.mark.parametrize("chunk", [2, 3, 256])
def test_repair_equals_brute_force(spark, chunk):
    r = random.Random(chunk)
    convs = {c: random_turns(r, r.randrange(1, 11)) for c in range(60)} | {None: random_turns(r, 5), 70: random_turns(r, 40)}
    rows = [(c, *t) for c, ts in convs.items() for t in ts]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").withColumn("c", F.lit(1)).withColumn("n", F.lit(0))
    got = repair.repair(df, chunk=chunk)
    edits = {}
    for e in sorted(got.edits.collect(), key=lambda e: (e["seq"]["chunk"], e["seq"]["at"])):
        edits.setdefault(e["conv_id"], []).append(e)
    audits = {a["conv_id"]: a for a in got.audits.collect()}
    assert set(audits) == set(convs)
    for c, ts in convs.items():
        rows = judge(ts)
        cost, audit, fixed = brute_audit(tuple(rows))
        a = audits[c]
        assert (a["cost"], a["audit"]) == (cost, audit), (c, rows)
        assert tuple((e["role"], e["text"]) for e in edits.get(c, []) if e["edit"] != "D") == fixed
        assert "".join(e["edit"] for e in edits.get(c, [])) == audit
        faults = Counter(x[3] for x in rows)
        assert (a["blank"], a["duplicate"], a["truncated"]) == (faults["blank"], faults["duplicate"], faults["truncated"])
        assert a["illegal"] == sum(x[0] + y[0] not in ("su", "ua", "au") for x, y in zip(rows, rows[1:]))
        known = [t for t, _, _ in ts if t is not None]
        assert a["gaps"] == (max(known) - min(known) + 1 - len(set(known)) if known else 0)


def test_alignment_of_long_damaged_chunks():
    r = random.Random(3)
    for n in (40, 120):
        for rate in (.1, .5):
            rows = []
            for i in range(n):
                if r.random() > rate / 2:
                    k = "ua"[i % 2] if r.random() > rate else r.choice("suao")
                    rows.append((k, r.choice([0, 0, 0, 1, 2])))
            codes = "".join(chr(65 + 4 * "suao".index(k) + f) for k, f in rows)
            want = brute_audit(tuple((k, k, "", repair.FAULTS[f]) for k, f in rows))
            assert repair.align(codes)[:2] == want[:2]


def test_repair_of_empty_table_and_extreme_turns(spark):
    df = spark.createDataFrame([(1, -(1 << 63), "user", "a."), (1, (1 << 63) - 1, "assistant", "b."), (2, None, None, None)],
                               "conv_id bigint, turn bigint, role string, text string")
    got = {r["conv_id"]: r for r in repair.repair(df).audits.collect()}
    assert got[1]["gaps"] == (1 << 63) - 1 and got[1]["audit"] == "KK" and got[2]["audit"] == "D" and got[2]["gaps"] == 0
    none = repair.repair(df.limit(0))
    assert none.audits.collect() == [] and none.edits.collect() == []
