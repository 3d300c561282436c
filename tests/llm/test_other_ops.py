"""Search, sharding, token files, chat formatting, classifiers and segmentation against brute force."""

from __future__ import annotations

import hashlib
import itertools
import math
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.fs as pafs
import pytest
from pyspark.sql import functions as F

from strata.llm import chat, quality, segment, sharding, tokens, topk, toxicity
from strata.llm import queries as Q
from strata.llm._text import Hasher, utf8, words

SF = "/root/testdata/sf0.01"


# ---- exact top-k -----------------------------------------------------------------------------------------------

def test_top_k_equals_brute_force(spark):
    r = random.Random(2)
    vecs = {i: [r.randrange(-9, 10) for _ in range(r.choice([6, 6, 6, 4, 0]))] for i in range(200)}
    rows = list(vecs.items()) + [(5, vecs[5]), (300, None), (None, [1, 2])]
    df = spark.createDataFrame(rows, "vec_id bigint, vec array<bigint>").withColumn("id", F.lit(1)).withColumn("qb", F.lit(2))
    got = topk.exact_top_k(df.filter("vec_id % 10 = 0"), df, k=5, query_rows=7, cand_rows=40, dim_block=2).collect()
    want = set()
    for q in range(0, 200, 10):
        score = {c: sum(x * y for x, y in zip(vecs[q], vecs[c])) for c in vecs if c != q}
        for rank, c in enumerate(sorted(score, key=lambda c: (-score[c], c))[:5], 1):
            want.add((q, rank, c, score[c]))
    assert {(x["query_id"], x["rank"], x["vec_id"], x["score"]) for x in got if x["query_id"] < 300} == want
    few = topk.exact_top_k(df.filter("vec_id = 0"), df.filter("vec_id < 3"), k=5).collect()
    assert sorted(x["vec_id"] for x in few) == [1, 2]
    assert topk.exact_top_k(df.limit(0), df, k=5).count() == 0


def test_quantised_leaves_out_unusable_vectors(spark):
    rows = [(0, [0.5, -0.1]), (1, None), (2, [1.0, None]), (3, [float("nan"), 1.0]), (4, [float("inf"), 0.0]), (5, [])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    assert {r["vec_id"]: list(r["vec"]) for r in topk.quantised(df).collect()} == {0: [128, -26], 5: []}


def test_large_components_stay_exact(spark):
    big = 1 << 30
    df = spark.createDataFrame([(0, [big + 1, 3]), (1, [big, 1]), (2, [big, 2])], "vec_id bigint, vec array<bigint>")
    got = topk.exact_top_k(df.filter("vec_id = 0"), df, k=1).first()
    assert (got["vec_id"], got["score"]) == (2, (big + 1) * big + 6)


# ---- sharding --------------------------------------------------------------------------------------------------

def least_capacity(sizes, shards):
    def runs(cap):
        n, at = 1, 0
        for s in sizes:
            if s > cap:
                return shards + 1
            n, at = (n, at + s) if at + s <= cap else (n + 1, s)
        return n

    return next(c for c in itertools.count(-(-sum(sizes) // shards)) if runs(c) <= shards)


@pytest.mark.parametrize("buckets", [4, 32, 8192])
def test_cuts_are_minimax_for_any_sampling(buckets):
    r = random.Random(buckets)
    for n, hot in ((40, 0), (300, 500), (300, 100_000), (7, 0), (1, 0)):
        sizes = [r.randrange(1, 100) for _ in range(n)]
        if hot:
            sizes[n // 2] = hot
        ends = list(itertools.accumulate(sizes))

        def fetch(windows, width):
            cells = {}
            for i, (a, b) in enumerate(windows):
                for e in ends:
                    if a < e < b:
                        cells.setdefault((i, e // width), []).append(e)
            return [(min(x), max(x), len(x)) for x in cells.values()]

        cap, cuts = sharding.minimax_cuts(fetch, ends[-1], max(sizes), 8, buckets)
        assert cap == least_capacity(sizes, 8)
        assert all(c in [0, *ends] for c in cuts) and cuts == sorted(cuts)
        assert max(b - a for a, b in zip([0, *cuts], [*cuts, ends[-1]])) <= cap


def test_shards_hold_groups_whole_and_number_slots(spark):
    r = random.Random(6)
    texts = ["t%d" % r.randrange(30) * r.randrange(1, 9) for _ in range(300)] + ["hot"] * 150 + [None, "", "é"]
    ids = [None, 3, 3] + list(range(len(texts) - 3))
    df = spark.createDataFrame(list(zip(ids, texts)), "doc_id bigint, text string")
    for c in ("size", "key", "pid", "shard", "end"):
        df = df.withColumn(c, F.lit("x"))
    got = sharding.shard_documents(df.repartition(5)).collect()
    assert len(got) == len(texts)
    slots = {}
    for g in got:
        assert g["law"] == "bytes" and g["grown_shard"] is None and 0 <= g["shard"] < 16
        slots.setdefault(g["shard"], []).append(g["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    by_crc = {}
    for g in got:
        by_crc.setdefault((g["size"], g["text_crc32"]), set()).add(g["shard"])
    assert all(len(s) == 1 for s in by_crc.values())
    assert Counter((g["size"], g["text_crc32"]) for g in got) == Counter(
        (len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for t in texts)
    first = {}
    for i, t in zip(ids, texts):
        t = t or ""
        k = (-1 if i is None else i, hashlib.sha256(t.encode()).digest())
        first[t] = min(first.get(t, k), k)
    size = Counter()
    for t in texts:
        size[t or ""] += len((t or "").encode()) + 1
    # the order is by the group's smallest id; a null id does not lower it unless all are null
    low = {t: min([i for i, u in zip(ids, texts) if (u or "") == t and i is not None], default=None) for t in size}
    order = sorted(size, key=lambda t: (low[t] is not None, low[t] or 0, hashlib.sha256(t.encode()).digest()))
    per = Counter()
    for g in got:
        per[g["shard"]] += g["size"]
    assert max(per.values()) <= least_capacity([size[t] for t in order], 16)
    assert sharding.shard_documents(df.limit(0)).count() == 0


# ---- token files -----------------------------------------------------------------------------------------------

@pytest.mark.parametrize("values", [[0], [0, 0, 0], [0, 5, 5, 9], list(range(0, 90_000, 7)), [0] * 700 + [10 ** 12],
                                    [0, 10 ** 9, 10 ** 9 + 1]])
def test_elias_fano_returns_every_boundary(values):
    ef = tokens.EliasFano(len(values), *tokens.ef_encode(np.array(values)))
    at = random.Random(1).sample(range(len(values)), min(len(values), 60))
    assert [ef.get(i) for i in at] == [values[i] for i in at]
    for i, j in ((0, len(values)), (len(values) // 3, len(values) // 2 + 1)):
        assert ef.block(i, j).tolist() == values[i:j]
    if len(values) > 5000:
        assert len(ef.lo) + len(ef.hi) < len(values) * 0.8  # bytes; a 64-bit table takes 8 per value


def test_word_encoder_equals_the_library():
    enc = tokens.WordEncoder(public_tokenizers.path("byte_bpe_50k.json"), limit=40)
    texts = ["a  b\n\n c", "<|endoftext|> hi", "x\0y z", "it's don't 's", "\n", "a\n", "  lead", "tab\tx y", "", " a",
             "é ü　wide ok", "nb\xa0sp x", "\x1cq w", "a \n b", "Hello\nWorld x\ny", "日本 語", "a b c " * 50]
    for _ in range(3):  # the cache is dropped and rebuilt between calls
        for t, raw in zip(texts, enc.encode(texts)):
            assert np.frombuffer(raw, enc.kind).tolist() == enc.tok.encode(t, add_special_tokens=False).ids, repr(t)


def test_token_files_round_trip(spark):
    texts = ["hello world"] * 3 + [None, "", "long " * 30_000, "x"] + [f"text {i}\nnext" for i in range(700)]
    ids = [None, 9, 9] + list(range(10, 10 + len(texts) - 3))
    df = spark.createDataFrame(list(zip(ids, texts)), "doc_id bigint, text string").withColumn("k", F.lit("x"))
    folder = tokens.scratch(spark, "test-tokens")
    path = public_tokenizers.path("byte_bpe_50k.json")
    m = tokens.write_tokens(df.repartition(4), folder, path, file_ids=1500)
    assert m.count() > 3
    got = tokens.read_tokens(m, folder).collect()
    tok = tokens.WordEncoder(path).tok
    at, want = 0, []
    for i, t in sorted(zip(ids, texts), key=lambda x: (x[0] is not None, x[0] or 0)):
        x = tok.encode(t or "", add_special_tokens=False).ids + [2]
        want.append((i, at, len(x), zlib.crc32(np.array(x, "<u4").tobytes())))
        at += len(x)
    key = lambda x: x[1]
    assert sorted((tuple(r) for r in got), key=key) == want
    with pafs.FileSystem.from_uri(folder)[0].open_input_file(m.first()["file"]) as f:
        t = tokens.TokenFile(f)
        a, b = t.ef.get(0), t.ef.get(1)
        assert t.ids(a, b).tolist()[-1] == 2 and t.boundaries(0, 2).tolist() == [a, b]
    empty = tokens.scratch(spark, "test-tokens")
    assert tokens.read_tokens(tokens.write_tokens(df.limit(0), empty, path), empty).count() == 0


# ---- chat ------------------------------------------------------------------------------------------------------

def test_chat_round_trip_and_mask(spark):
    rows = [(1, 0, "user", "<|start|>assistant<|message|>no<|end|> 100% %3C [INST]"), (1, 1, "assistant", "ok <|end|> 😀 %25"),
            (1, 2, "assistant", None), (1, 2, "assistant", None), (2, 0, None, ""), (2, None, "assistant", "first"),
            (None, 0, "assistant", "lost")]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").withColumn("c", F.lit("x"))
    out = chat.format_chat(df)
    back = {r["conv_id"]: r for r in chat.read_chat(out).collect()}
    assert [tuple(t) for t in back[1]["turns"]] == [("user", rows[0][3]), ("assistant", rows[1][3]), ("assistant", ""),
                                                    ("assistant", "")]
    assert list(back[1]["loss_texts"]) == [rows[1][3], "", ""]
    assert [tuple(t) for t in back[2]["turns"]] == [("assistant", "first"), ("", "")]
    assert list(back[None]["loss_texts"]) == ["lost"]
    one = out.filter("conv_id = 1").first()
    assert one["formatted"].count("<|start|>") == 4 and "[INST]" not in one["formatted"]
    assert chat.read_chat(chat.format_chat(df.limit(0))).count() == 0


def test_typed_parts_become_placeholders(spark):
    parts = [{"type": "text", "text": "see <this>", "ref": None, "tokens": None},
             {"type": "image", "text": None, "ref": "a.png", "tokens": 64},
             {"type": "audio", "text": None, "ref": "b.wav", "tokens": None}, None,
             {"type": None, "text": " end", "ref": None, "tokens": None},
             {"type": "video", "text": None, "ref": "c.mp4", "tokens": None},
             {"type": "document", "text": None, "ref": "d.pdf", "tokens": 7}]
    df = spark.createDataFrame([(1, 0, "user", parts), (1, 1, "assistant", None)],
                               f"conv_id bigint, turn bigint, role string, p {chat.PARTS}")
    r = chat.format_chat(df, parts="p").first()
    assert r["formatted"] == ("<|start|>user<|message|>see %3Cthis><|image|><|audio|> end<|other|><|document|><|end|>"
                              "<|start|>assistant<|message|><|end|>")
    assert [(a["type"], a["ref"], a["tokens"]) for a in r["attachments"]] == [
        ("image", "a.png", 64), ("audio", "b.wav", 128), ("video", "c.mp4", 0), ("document", "d.pdf", 7)]
    assert r["expanded_tokens"] == 64 + 128 + 7 and len(r["loss_mask"]) == 1


def test_chat_plan_has_no_python(spark):
    plan = Q.QUERIES["op9_chat_format"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


# ---- classifiers -----------------------------------------------------------------------------------------------

def _held_out(spark, name, label):
    got = Q.QUERIES[name](spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").filter("held_out").toPandas()
    return (got["predicted"] == got[label]).mean(), got


def test_quality_on_held_out_labels(spark):
    accuracy, got = _held_out(spark, "op3_quality_gam", "quality")
    assert accuracy >= 0.95 and got["score"].between(0, 1).all()


def test_toxicity_learns_from_a_class_of_long_texts(spark):
    """All toxic texts are longer than ``max_bytes``; too long for the whole sample is an error."""
    r = np.random.default_rng(11)

    def text(n, mark):
        w = [f"word{i}" for i in r.integers(0, 300, n)]
        for i in range(0, n if mark else 0, 20):
            w[i] = f"vile{r.integers(0, 5)}"
        return " ".join(w)

    rows = [(i, text(900, True) if i % 2 else text(120, False)) for i in range(160)]
    assert min(len(t) for i, t in rows if i % 2) > 6000
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    lab = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("toxic"))
    got = toxicity.score_toxicity(docs, toxicity.fit_toxicity(docs, lab, per_class=60)).collect()
    assert sum(x["predicted"] == x["doc_id"] % 2 for x in got) >= 0.95 * len(got)
    with pytest.raises(ValueError, match="exceed"):
        toxicity.fit_toxicity(docs, lab, per_class=1, max_bytes=3000)


def test_toxicity_on_held_out_labels(spark):
    accuracy, got = _held_out(spark, "op8_toxicity_gru", "toxic")
    assert accuracy >= 0.9 and got["score"].between(0, 1).all()


def test_classifiers_on_odd_rows(spark):
    docs = spark.createDataFrame([(None, "a b"), (1, None), (2, ""), (2, ""), (3, "w " * 200_000), (4, "\0\x01 |||")],
                                 "doc_id bigint, text string").withColumn("features", F.lit(1)).withColumn("t", F.lit(2))
    labels = spark.createDataFrame([(None, 1, 1), (1, None, None), (2, 1, 0), (3, 0, 1), (3, 1, 1), (99, 0, 0)],
                                   "doc_id bigint, quality int, toxic int")
    feats = quality.feature_table(docs)
    for lab in (labels, labels.limit(0)):
        got = quality.score_quality(feats, quality.fit_quality(feats, lab)).collect()
        assert len(got) == 6 and all(0 <= r["score"] <= 1 for r in got)
        tox = toxicity.score_toxicity(docs, toxicity.fit_toxicity(docs, lab)).collect()
        assert len(tox) == 6 and all(0 <= r["score"] <= 1 for r in tox)
        assert all(r["predicted"] == 0 for r in tox if r["doc_id"] in (1, 2))
        assert [r["held_out"] for r in tox if r["doc_id"] is None] == [True]
    assert quality.feature_table(docs.limit(0)).count() == 0


def test_gradients_equal_differences():
    net = toxicity.Network(64, 64, 3, 2)
    data, off = utf8(pa.array(["the quick brown fox jumps", "idiot x y", "a b c d e f g h"]))
    s, e, h, first = words(data, off, Hasher())
    ids, rows, pairs, at = net.vocabulary(data, s, e, h)
    start, size, _ = toxicity.windows(first, 4, 2)
    for k in net.p:
        net.p[k] = net.p[k].astype(np.float64) * 3
    y = np.arange(len(start)) % 2

    def loss():
        z = net.gradient(rows, pairs, at, ids, start, size, lambda z: z * 0)[1]
        return (np.log1p(np.exp(z)) - y * z).sum()

    g, z = net.gradient(rows, pairs, at, ids, start, size, lambda z: 1 / (1 + np.exp(-z)) - y)
    assert np.allclose(z, net.window_logits(net.embed(rows, pairs, at), ids, start, size), atol=1e-5)
    for k, v in net.p.items():
        v, gi = v.reshape(-1), g[k].reshape(-1)
        i = int(np.argmax(np.abs(gi)))
        keep = v[i]
        v[i] = keep + 1e-3
        up = loss()
        v[i] = keep - 1e-3
        down = loss()
        v[i] = keep
        assert math.isclose(gi[i], (up - down) / 2e-3, rel_tol=1e-3, abs_tol=1e-5), k


def test_windows_cover_every_word_and_overlap():
    first = np.array([0, 0, 10, 74, 139, 1139])
    start, size, doc = toxicity.windows(first)
    seen = np.zeros(1139, bool)
    for a, n in zip(start, size):
        seen[a:a + n] = True
    assert seen.all() and size.max() <= toxicity.WINDOW
    for d in range(5):
        s = start[doc == d]
        assert all(b - a <= toxicity.STRIDE for a, b in zip(s[:-1], s[1:]))


# ---- segmentation ----------------------------------------------------------------------------------------------

PIECES = [None, ("▁a", -1.0), ("a", -1.5), ("b", -1.2), ("ab", -2.0), ("▁ab", -2.5), ("▁", -2.2), ("ba", -1.7), ("bb", -2.9),
          ("▁▁", -3.0)]


def all_segmentations(text):
    out = []
    t = "▁" + text.replace(" ", "▁") if text else ""

    def go(i, ids, w):
        if i == len(t):
            out.append((tuple(ids), w))
            return
        for j, p in enumerate(PIECES):
            if p and t.startswith(p[0], i):
                go(i + len(p[0]), ids + [j], w + p[1])
        if not any(p and p[0] == t[i] for p in PIECES):
            raw = t[i].encode()
            go(i + 1, ids + [len(PIECES) + b for b in raw], w - 14.0 * len(raw))

    go(0, [], 0.0)
    z = np.logaddexp.reduce([w for _, w in out])
    return {s: math.exp(w - z) for s, w in out}


@pytest.mark.parametrize("text", ["ab", "abba", "a  b", "a é\nb", "", "bbab a", "q"])
def test_samples_without_replacement_have_the_lattice_law(text):
    vocab = segment.Vocabulary(PIECES + [None] * 256, list(range(len(PIECES), len(PIECES) + 256)))
    p, n, k = all_segmentations(text), 4000, 3
    raw = text.encode()
    first, seen, drawn = Counter(), Counter(), [{} for _ in range(n)]
    for o in segment.encode_batch(vocab, np.frombuffer(raw * n, np.uint8), np.arange(n + 1) * len(raw),
                                  np.arange(n).astype(np.uint64), k):
        assert o["exact"].all()
        for r, lp, g in zip(o["row"], o["log_prob"], o["perturbed"]):
            s = tuple(o["ids"][o["first"][r]:o["first"][r + 1]].tolist())
            assert abs(lp - math.log(p[s])) < 1e-9 and s not in drawn[r]
            assert not drawn[r] or min(drawn[r].values()) >= g
            drawn[r][s] = g
            seen[s] += 1
            first[s] += o["sample"] == 1
    assert all(len(x) == min(k, len(p)) for x in drawn)
    law = Counter()  # inclusion under successive sampling
    for order in itertools.permutations(p, min(k, len(p))):
        q, used = 1.0, 0.0
        for s in order:
            q *= p[s] / (1 - used) if used < 1 else 0
            used += p[s]
        for s in order:
            law[s] += q
    for s in p:
        assert abs(first[s] / n - p[s]) < 5 * math.sqrt(0.25 / n)
        assert abs(seen[s] / n - law[s]) < 5 * math.sqrt(0.25 / n)


def test_rows_do_not_depend_on_their_neighbours(spark):
    model = public_tokenizers.path("piece_bpe_32k.model")
    texts = ["Hello  World\nx", None, "", " lead and trail ", "日本語 émoji 😀", "a" * 3000, "word " * 20_000, "x▁y", "Hello  World\nx"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(None, "null id"), (0, texts[0])],
                               "doc_id bigint, text string").withColumn("ids", F.lit(1)).withColumn("sample", F.lit(1))
    got = segment.sample_segmentations(df, model, k=3, with_ids=True).collect()
    alone = segment.sample_segmentations(df.filter("doc_id = 3"), model, k=3, with_ids=True).collect()
    assert sorted(map(str, alone)) == sorted(str(r) for r in got if r["doc_id"] == 3)
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=model)
    for r in got:
        t = "null id" if r["doc_id"] is None else texts[r["doc_id"]] or ""
        assert r["exact"] == (SPACE not in t) and r["n_pieces"] == len(r["ids"])
        assert sp.decode(list(r["ids"])) == t.replace(SPACE, " ")
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes()) and r["log_inclusion"] <= 0
    assert sum(r["doc_id"] == 0 for r in got) == 6 and sum(r["doc_id"] == 2 for r in got) == 1
    assert len({tuple(r["ids"]) for r in got if r["doc_id"] == 6}) == 3
    assert segment.sample_segmentations(df.limit(0), model).count() == 0


SPACE = "▁"
