"""SentencePiece encoding and decoding with sampled segmentations: Gumbel top-k without replacement.

The segmentations of a text are the paths of its piece lattice; a path's probability is proportional to the product of
its pieces' weights.  Perturbing every path's log-probability with Gumbel noise and taking the ``k`` largest draws ``k``
distinct segmentations without replacement.  The search never lists paths: it is A* over prefixes, with the exact
backward sums of the lattice as log-mass of what lies below a prefix.  The noise is drawn from the top down: a prefix
knows the largest perturbed value below it, the child that holds it is a plain sample of the next piece, and the
largest value among the other children follows a Gumbel truncated at the prefix's own.  So the best path below a prefix
is one walk, every step of which leaves one open alternative; the next segmentation continues the best open
alternative of all walks so far.  The value of the first alternative that is not taken any more is the threshold that
gives each emitted segmentation its inclusion score.

Everything is numpy over a batch of texts.  No piece spans a place between two characters that stand next to each other
in no piece, so texts fall into units there; the lattice of each distinct unit of a batch is built once.  All draws are
hashes of (row key, sample, place), so a row's result does not depend on its neighbours.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._text import mix64, powers, spans, uniform, utf8
from .tokens import worker_state

SPACE = "▁"
_BASE = 0xD6E8FEB86659FD93
_STEP = np.uint64(0x9E3779B97F4A7C15)
_PAIRS = 1 << 22
BATCH = 1 << 20  # bytes of text in one lattice batch


def _hash_prefix(cp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    n = len(cp)
    c = np.zeros(n + 1, np.uint64)
    np.cumsum(mix64(cp) * powers(n, _BASE), out=c[1:])
    return c, powers(n + 1, pow(_BASE, -1, 1 << 64))


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return ((a.astype(np.uint64) * np.uint64(0x9E3779B1) ^ b.astype(np.uint64) * np.uint64(0x85EBCA77))
            & np.uint64(_PAIRS - 1)).astype(np.int64)


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


class Vocabulary:
    """Pieces with log-weights, as tables for batch look-ups.

    ``pieces``: (piece, log-weight) by id, None for ids that no text yields; ``byte_ids``: ids of the 256 byte pieces,
    used for characters that are no piece themselves."""

    def __init__(self, pieces: list[tuple[str, float] | None], byte_ids: list[int], byte_weight: float = -14.0):
        self.byte_ids, self.byte_weight = np.array(byte_ids, np.int64), byte_weight
        self.weight = np.array([p[1] if p else 0.0 for p in pieces])
        raw = [p[0].replace(SPACE, " ").encode() if p else b"" for p in pieces]
        for b, i in enumerate(byte_ids):
            raw[i] = bytes([b])
        self.raw = np.frombuffer(b"".join(raw), np.uint8)
        self.raw_first = np.cumsum([0] + [len(r) for r in raw])
        prefixes: dict[int, dict[int, int]] = {}
        self.joined = np.zeros(_PAIRS, bool)
        for i, p in enumerate(pieces):
            if not p or not p[0]:
                continue
            cp = code_points(p[0])
            c, q = _hash_prefix(cp)
            for n in range(1, len(cp) + 1):
                table = prefixes.setdefault(n, {})
                h = int(c[n])  # starts at 0, where the inverse power is 1
                table[h] = i if n == len(cp) else table.get(h, -1)
            self.joined[_pair(cp[:-1], cp[1:])] = True
        self.tables = []
        for n in sorted(prefixes):
            h = np.array(sorted(prefixes[n]), np.uint64)
            self.tables.append((h, np.array([prefixes[n][int(x)] for x in h], np.int64)))

    @classmethod
    def load(cls, path: str, offset: float = 30.0) -> Vocabulary:
        """From a SentencePiece model file.  A unigram model's scores are log-probabilities; a BPE model's scores are
        minus the merge rank, which Zipf's law turns into log-weights ``-log(rank + offset)``."""
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        scores = [sp.get_score(i) for i in range(n)]
        usable = [not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) or sp.is_byte(i)) for i in range(n)]
        ranks = all(s == int(s) for s, u in zip(scores, usable) if u)
        pieces = [(sp.id_to_piece(i), -np.log(offset - s) if ranks else s) if u else None
                  for i, (s, u) in enumerate(zip(scores, usable))]
        return cls(pieces, [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)])


class Lattices:
    """Lattices of the distinct units of a batch of texts, and walks over them."""

    def __init__(self, vocab: Vocabulary, cp: np.ndarray, first: np.ndarray):
        """``cp``: code points of all texts one after another, ``first``: where each text starts (n + 1 entries)."""
        self.v = vocab
        cut = np.ones(len(cp), bool)
        if len(cp):
            cut[1:] = ~vocab.joined[_pair(cp[:-1], cp[1:])]
            starts = first[:-1]
            cut[starts[starts < len(cp)]] = True
        self.start = np.flatnonzero(cut)  # units
        end = np.append(self.start[1:], len(cp))
        c, q = _hash_prefix(cp)
        size = end - self.start
        key = mix64((c[end] - c[self.start]) * q[self.start] + size.astype(np.uint64))
        _, at, self.unit = np.unique(key, return_index=True, return_inverse=True)
        # characters of the distinct units
        size, base = size[at], self.start[at]
        unit_first = np.cumsum(size) - size
        total = int(size.sum())
        spot = np.arange(total) + np.repeat(base - unit_first, size)
        left = np.repeat(unit_first + size, size) - np.arange(total)  # characters to the unit's end
        by_left = np.argsort(left, kind="stable")
        node = np.empty(total + 1, np.int64)  # nodes in order of what is left, the end node last
        node[by_left] = np.arange(total)
        self.n = node[total] = total
        found = []
        live = np.arange(total)
        solo = np.zeros(total, bool)
        for n, (hashes, ids) in enumerate(vocab.tables, 1):
            live = live[left[live] >= n]
            if not len(live):
                break
            o = spot[live]
            h = (c[o + n] - c[o]) * q[o]
            k = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)
            ok = hashes[k] == h
            live, piece = live[ok], ids[k[ok]]
            edge = piece >= 0
            found.append((live[edge], np.full(int(edge.sum()), n), piece[edge]))
            if n == 1:
                solo[live[edge]] = True
        bare = np.flatnonzero(~solo)  # characters that are no piece: their bytes
        found.append((bare, np.ones(len(bare), np.int64), -1 - cp[spot[bare]].astype(np.int64)))
        src, length, piece = (np.concatenate(x) for x in zip(*reversed(found)))
        by = np.argsort(node[src], kind="stable")  # long pieces first
        src, self.length, self.piece = src[by], length[by], piece[by]
        byte_count = 1 + (-1 - self.piece > 0x7F) + (-1 - self.piece > 0x7FF) + (-1 - self.piece > 0xFFFF)
        weight = np.where(self.piece >= 0, vocab.weight[np.maximum(self.piece, 0)], vocab.byte_weight * byte_count)
        self.src = node[src]
        inside = left[src] > self.length
        self.dst = np.where(inside, node[np.minimum(src + self.length, total)], self.n)
        self.first = np.searchsorted(self.src, np.arange(total + 1))
        self.unit_node = node[unit_first]
        # backward log-sums, units in step by what is left
        beta = np.zeros(total + 1)
        steps = np.searchsorted(left[by_left], np.arange(1, int(left.max(initial=0)) + 2))
        for a, b in zip(steps[:-1], steps[1:]):
            ea, eb = self.first[a], self.first[b]
            x = weight[ea:eb] + beta[self.dst[ea:eb]]
            heads = self.first[a:b] - ea
            top = np.maximum.reduceat(x, heads)
            mass = np.add.reduceat(np.exp(x - np.repeat(top, np.diff(np.append(heads, eb - ea)))), heads)
            beta[a:b] = top + np.log(mass)
        self.logp = np.minimum(weight + beta[self.dst] - beta[self.src], 0.0)
        self.p = np.exp(self.logp)
        run = np.cumsum(self.p)
        head = self.first[self.src]
        self.cum = run - (run[head] - self.p[head])
        self.log_mass = beta[self.unit_node]  # log of each distinct unit's total weight

    def walk(self, node: np.ndarray, place: np.ndarray, seed: np.ndarray):
        """Sample a path to the end of its unit from every node; ``place`` is the node's place in the batch.

        Returns (edge, place, walk) of all pieces, not in order."""
        out = []
        who = np.flatnonzero(node != self.n)
        node, place = node[who], place[who]
        while len(who):
            u = uniform(mix64(seed[who] + place.astype(np.uint64) * _STEP))
            e, last = self.first[node], self.first[node + 1] - 1
            late = np.flatnonzero((u >= self.cum[e]) & (e < last))
            while len(late):
                e[late] += 1
                late = late[(u[late] >= self.cum[e[late]]) & (e[late] < last[late])]
            out.append((e, place, who))
            node, place = self.dst[e], place + self.length[e]
            go = node != self.n
            node, place, who = node[go], place[go], who[go]
        if not out:
            return (np.zeros(0, np.int64),) * 3
        return tuple(np.concatenate(x) for x in zip(*out))


class Path:
    """One sampled segmentation of every text: pieces by text, open alternatives, perturbed values."""

    def __init__(self, edge, place, first, value, alive):
        self.edge, self.place, self.first, self.value, self.alive = edge, place, first, value, alive
        self.open = self.logp = self.turn = None
        self.banned: list[np.ndarray] = []


def _by_text(x: np.ndarray, first: np.ndarray, how, empty: float) -> np.ndarray:
    out = np.full(len(first) - 1, empty)
    some = np.flatnonzero(np.diff(first))
    if len(some):
        out[some] = how.reduceat(x, first[some])
    return out


def _truncated(mu: np.ndarray, top: np.ndarray, u: np.ndarray) -> np.ndarray:
    """Gumbel of location ``mu`` conditioned to lie below ``top``."""
    with np.errstate(divide="ignore", over="ignore", invalid="ignore"):
        g = mu - np.log(np.exp(mu - top) - np.log(u))
    return np.where(np.isfinite(mu), np.minimum(g, top), -np.inf)


def _log_rest(p: np.ndarray) -> np.ndarray:
    """log(1 - p); nothing is left below rounding."""
    with np.errstate(divide="ignore"):
        return np.where(1 - p > 1e-12, np.log(np.maximum(1 - p, 1e-300)), -np.inf)


def top_k(lat: Lattices, first: np.ndarray, seed: np.ndarray, k: int) -> tuple[list[Path], np.ndarray]:
    """``k`` segmentations of every text in order of their perturbed values, and the threshold (the next value).

    ``first``: where each text starts in the batch, ``seed``: a 64-bit key per text.  A text with fewer segmentations
    has ``alive`` false from then on."""
    n = len(first) - 1
    text_of_unit = np.searchsorted(first, lat.start, side="right") - 1
    key = lambda j, role: mix64(seed + np.uint64(2 * j + role))
    here = lambda place, text: (place - first[text])  # noqa: E731  place inside the text

    def finish(path: Path, j: int, turn: np.ndarray | None, banned: list[np.ndarray]):
        text = np.repeat(np.arange(n), np.diff(path.first))
        lp = lat.logp[path.edge]
        run = np.cumsum(lp)
        base = np.append(0.0, run)[path.first[:-1]]
        before = run - lp - base[text]
        path.logp = _by_text(lp, path.first, np.add, 0.0)
        gone = lat.p[path.edge].copy()
        fresh = np.ones(len(lp), bool)
        if turn is not None:
            level = np.arange(len(lp)) - path.first[text]
            fresh = level >= turn[text]
            at = np.flatnonzero(level == turn[text])
            for b in banned:
                gone[at] += np.where(b[text[at]] >= 0, lat.p[np.maximum(b[text[at]], 0)], 0.0)
        u = uniform(mix64(key(j, 1)[text] + here(path.place, text).astype(np.uint64) * _STEP))
        mu = np.where(fresh & path.alive[text], before + _log_rest(gone), -np.inf)
        path.open = _truncated(mu, path.value[text], u)
        path.turn, path.banned = turn, banned
        return path

    def assemble(edge, place, text):
        by = np.argsort(place, kind="stable")
        return edge[by], place[by], np.concatenate([[0], np.cumsum(np.bincount(text, minlength=n))])

    start_seed = key(0, 0)
    e, place, who = lat.walk(lat.unit_node[lat.unit], here(lat.start, text_of_unit), start_seed[text_of_unit])
    text = text_of_unit[who]
    edge, place, pf = assemble(e, place + first[text], text)
    g0 = -np.log(-np.log(uniform(mix64(seed))))
    paths = [finish(Path(edge, place, pf, g0, np.ones(n, bool)), 0, None, [])]

    def best_open():
        value, which, index = np.full(n, -np.inf), np.zeros(n, np.int64), np.zeros(n, np.int64)
        for i, p in enumerate(paths):
            top = _by_text(p.open, p.first, np.maximum, -np.inf)
            better = top > value
            if not better.any():
                continue
            t = np.repeat(np.arange(n), np.diff(p.first))
            at = np.flatnonzero((p.open == top[t]) & better[t])
            tt, pick = np.unique(t[at], return_index=True)
            value[tt], which[tt], index[tt] = top[tt], i, at[pick]
        return value, which, index

    for j in range(1, k):
        value, which, index = best_open()
        alive = np.isfinite(value)
        turn = np.full(n, -1)
        banned = [np.full(n, -1) for _ in range(j)]
        parts = []
        spot = np.full(n, np.iinfo(np.int64).max)
        taken = np.full(n, -1)
        for i, p in enumerate(paths):
            mine = np.flatnonzero(alive & (which == i))
            if not len(mine):
                continue
            at = index[mine]
            turn[mine] = at - p.first[mine]
            spot[mine], taken[mine] = p.place[at], p.edge[at]
            p.open[at] = -np.inf
            banned[0][mine] = p.edge[at]
            if p.turn is not None:  # the same place was left before: its choices stay banned
                again = mine[p.turn[mine] == turn[mine]]
                for slot, b in enumerate(p.banned, 1):
                    banned[slot][again] = b[again]
            t = np.repeat(np.arange(n), np.diff(p.first))
            held = (alive & (which == i))[t] & (np.arange(len(t)) < index[t])
            parts.append((p.edge[held], p.place[held], t[held]))
        live = np.flatnonzero(alive)
        # another piece at the turning place, by the weights of those not banned
        node = lat.src[taken[live]]
        e, last = lat.first[node].copy(), lat.first[node + 1] - 1
        out = np.zeros(len(live))
        for b in banned:
            out += np.where(b[live] >= 0, lat.p[np.maximum(b[live], 0)], 0.0)
        goal = uniform(mix64(key(j, 0)[live] - _STEP)) * np.maximum(1 - out, 0)
        run, chosen, spare = np.zeros(len(live)), np.full(len(live), -1), np.full(len(live), -1)
        while True:
            inside = e <= last
            if not inside.any():
                break
            at = np.minimum(e, last)
            free = inside & np.logical_and.reduce([b[live] != at for b in banned])
            run += np.where(free, lat.p[at], 0.0)
            spare = np.where(free, at, spare)
            chosen = np.where(free & (chosen < 0) & (run > goal), at, chosen)
            e += 1
        chosen = np.where(chosen < 0, spare, chosen)
        parts.append((chosen, spot[live], live))
        # to the end of the unit, then all later units afresh
        later = np.flatnonzero(alive[text_of_unit] & (lat.start > spot[text_of_unit]))
        owner = np.concatenate([live, text_of_unit[later]])
        nodes = np.concatenate([lat.dst[chosen], lat.unit_node[lat.unit[later]]])
        places = np.concatenate([spot[live] + lat.length[chosen], lat.start[later]])
        e2, p2, who = lat.walk(nodes, here(places, owner), key(j, 0)[owner])
        parts.append((e2, p2 + first[owner[who]], owner[who]))
        edge, place, pf = assemble(*(np.concatenate(x) for x in zip(*parts)))
        paths.append(finish(Path(edge, place, pf, value, alive), j, turn, banned))
    return paths, best_open()[0]


def piece_ids(lat: Lattices, edge: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of a path (characters without a piece as byte pieces) and where each text's ids start."""
    piece = lat.piece[edge]
    bare = piece < 0
    if not bare.any():
        return piece, first
    chars, inverse = np.unique(-1 - piece[bare], return_inverse=True)
    raw = [chr(c).encode("utf-8", "surrogatepass") for c in chars.tolist()]
    size = np.ones(len(piece), np.int64)
    size[bare] = np.array([len(r) for r in raw])[inverse]
    bounds = np.concatenate([[0], np.cumsum(size)])
    out = np.repeat(piece, size)
    table = np.zeros((len(raw), 4), np.int64)
    for i, r in enumerate(raw):
        table[i, :len(r)] = lat.v.byte_ids[list(r)]
    at = np.repeat(bounds[:-1], size)
    which = np.repeat(np.cumsum(bare) - 1, size)
    sel = out < 0
    out[sel] = table[inverse[which[sel]], (np.arange(len(out)) - at)[sel]]
    return out, bounds[first]


def decode(vocab: Vocabulary, ids: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of id sequences (the leading space of a text included) and where each text starts."""
    size = (vocab.raw_first[1:] - vocab.raw_first[:-1])[ids]
    bounds = np.concatenate([[0], np.cumsum(size)])
    at = np.arange(int(bounds[-1])) + np.repeat(vocab.raw_first[ids] - bounds[:-1], size)
    return vocab.raw[at], bounds[first]


def encode_batch(vocab: Vocabulary, data: np.ndarray, off: np.ndarray, keys: np.ndarray, k: int):
    """Sampled segmentations of a batch of UTF-8 texts: yields, per sample, a dictionary of columns over the texts that
    have it (``row``, ``ids``, ``first``, ``log_prob``, ``perturbed``, ``log_inclusion``, ``exact``)."""
    n = len(off) - 1
    cp = code_points(data.tobytes().decode("utf-8", "surrogatepass")).copy()
    chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[off]
    cp[cp == 32] = ord(SPACE)
    count = np.diff(chars)
    some = count > 0
    first = chars + np.concatenate([[0], np.cumsum(some)])  # one leading mark per non-empty text
    whole = np.full(int(first[-1]), ord(SPACE), np.uint32)
    whole[np.arange(len(cp)) + np.repeat(np.cumsum(some), count)] = cp
    lat = Lattices(vocab, whole, first)
    paths, threshold = top_k(lat, first, mix64(keys), k)
    for j, p in enumerate(paths):
        row = np.flatnonzero(p.alive & (some | (j == 0)))
        if not len(row):
            continue
        ids, id_first = piece_ids(lat, p.edge, p.first)
        raw, raw_first = decode(vocab, ids, id_first)
        with np.errstate(over="ignore", under="ignore", divide="ignore"):
            x = p.logp - threshold
            inclusion = np.where(x < -30, x, np.log(-np.expm1(-np.exp(np.minimum(x, 700)))))
        exact = [raw[raw_first[i] + 1:raw_first[i + 1]].tobytes() == data[off[i]:off[i + 1]].tobytes() for i in row]
        yield {"sample": j + 1, "row": row, "ids": ids, "first": id_first, "log_prob": p.logp[row],
               "perturbed": p.value[row], "log_inclusion": np.where(np.isfinite(threshold), inclusion, 0.0)[row],
               "exact": np.array(exact, bool)}


def sample_segmentations(docs: DataFrame, model: str, k: int = 2, id_col: str = "doc_id", text_col: str = "text",
                         with_ids: bool = False) -> DataFrame:
    """``k`` distinct segmentations of every text: ``doc_id, sample`` (1: largest perturbed value), ``n_pieces,
    ids_crc32`` (over unsigned 32-bit little-endian ids), ``log_prob, perturbed, log_inclusion, exact`` (decoding gives
    the text back; false only where the text holds the word-start sign itself), with ``ids`` on request.

    The row key of the draws is the id (null: a fixed key), so equal texts under different ids get different samples.
    A text with fewer than ``k`` segmentations gives them all, with log-inclusion 0.  Null and empty texts have one
    empty segmentation.  Repeated rows stay and agree; an empty table gives no rows."""
    def run(batches):
        state = worker_state()
        vocab = state.get(("pieces", model))
        if vocab is None:
            vocab = state[("pieces", model)] = Vocabulary.load(model)
        for batch in batches:
            data, off = utf8(batch.column(1))
            ids_col = batch.column(0)
            key = ids_col.fill_null(-(1 << 62)).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            for i, j in spans(off, BATCH):
                for s in encode_batch(vocab, data[off[i]:off[j]], off[i:j + 1] - off[i], key[i:j], k):
                    row, f = s["row"], s["first"]
                    ids = s["ids"].astype("<u4")
                    crc = [zlib.crc32(ids[f[r]:f[r + 1]].tobytes()) for r in row]
                    cols = [ids_col.slice(i, j - i).take(pa.array(row)), pa.array(np.full(len(row), s["sample"]), pa.int32()),
                            pa.array((f[1:] - f[:-1])[row], pa.int64()), pa.array(crc, pa.int64()),
                            pa.array(s["log_prob"]), pa.array(s["perturbed"]), pa.array(s["log_inclusion"]),
                            pa.array(s["exact"])]
                    names = ["doc_id", "sample", "n_pieces", "ids_crc32", "log_prob", "perturbed", "log_inclusion", "exact"]
                    if with_ids:
                        lists = pa.ListArray.from_arrays(pa.array(f, pa.int32()), pa.array(s["ids"].astype(np.int32)))
                        cols.append(lists.take(pa.array(row)))
                        names.append("ids")
                    yield pa.record_batch(cols, names=names)

    x = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), F.col(f"`{text_col}`").alias("t"))
    schema = ("doc_id bigint, sample int, n_pieces bigint, ids_crc32 bigint, log_prob double, perturbed double, "
              "log_inclusion double, exact boolean")
    return x.mapInArrow(run, schema + (", ids array<int>" if with_ids else ""))
