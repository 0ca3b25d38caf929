"""LM scoring: a causal self-attention model, trained in numpy on subword ids, beside word counts of the whole corpus.

Words of all training documents are counted. Frequent words' counts are broadcast (their number has a fixed bound,
since each has at least a set share of all tokens); the others are looked up by a join, so a hot word never is a key.

Subwords are those of a public byte-level BPE with its first merges only, so every text has ids and the model gives
every text a probability. Texts are encoded once, into a table of ids that training and scoring read. The corpus-wide
subword counts, from the word counts, fix the classes and first biases of the model. All spans of words of all training
documents are dealt to trainers by a hash, as many as the number of words takes; each starts a round from the same
weights and takes its spans in the order of their hashes, so weights depend on the documents alone. Their weights are
averaged by the tokens seen, in two steps. The first round takes a fixed share of the spans, the second all others.

A token attends to itself and to what precedes it in its own block of tokens and in the block before: windows of two
blocks that overlap by one, each scoring the tokens of its last block, all blocks of a batch at a time under one mask.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from itertools import chain, filterfalse, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barmill.llm import bpe
from barmill.llm.chunks import sums
from barmill.llm.common import binary_array, byte_slices, string_bytes, string_offsets, text_rows, written

_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
#: A word whose count is at least the HEAD-th part of all tokens is broadcast; there are HEAD such words at most.
HEAD = 1 << 19
#: Words longer than this are never broadcast.
LONG_WORD = 64
#: Merges of the tokenizer that are used: with 256 bytes and the end, GROUPS squared subwords.
GROUPS = 32
MERGES = GROUPS * GROUPS - 257
END = GROUPS * GROUPS - 1
#: Tokens of a block; width of the model and of its hidden layer.
BLOCK, WIDTH, HIDDEN = 16, 16, 32
#: Words of a training span, and one of how many spans the first round takes, by a hash of its place; the second takes all others.
SPAN, SHARE = 64, 16
ROUNDS, BATCH, RATE = 2, 512, 0.01
#: Words of training text that each trainer takes.
WORDS_EACH = 1_000_000


class Weights(dict):
    """Named float arrays. order: subword of each (class, place); place: the other way round."""

    @classmethod
    def start(cls, counts: np.ndarray, seed: int = 3) -> Weights:
        rng = np.random.default_rng(seed)
        d, v = WIDTH, GROUPS * GROUPS
        new = lambda *shape, scale: (rng.standard_normal(shape) * scale).astype(np.float32)
        order = np.argsort(-counts, kind="stable")
        share = ((counts[order] + 0.5) / (counts.sum() + 0.5 * v)).reshape(GROUPS, GROUPS)
        place = np.empty(v, np.int64)
        place[order] = np.arange(v)
        w = cls(
            embed=new(v, d, scale=0.3), query=new(d, d, scale=d**-0.5), key=new(d, d, scale=d**-0.5), value=new(d, d, scale=d**-0.5), out=new(d, d, scale=d**-0.5),
            near=np.zeros(2 * BLOCK, np.float32), up=new(d, HIDDEN, scale=d**-0.5), up_bias=np.zeros(HIDDEN, np.float32), down=new(HIDDEN, d, scale=0.5 * HIDDEN**-0.5),
            cls=new(d, GROUPS, scale=0.02), cls_bias=np.log(share.sum(axis=1)).astype(np.float32),
            tok=new(GROUPS, d, GROUPS, scale=0.02), tok_bias=np.log(share / share.sum(axis=1, keepdims=True)).astype(np.float32),
        )
        w.place = place
        return w

    def like(self, values: dict) -> Weights:
        out = Weights(values)
        out.place = self.place
        return out

    def __reduce__(self):
        return _rebuilt, (dict(self), self.place)


def _rebuilt(values: dict, place: np.ndarray) -> Weights:
    out = Weights(values)
    out.place = place
    return out


_AT = (BLOCK + np.arange(BLOCK))[:, None] - np.arange(2 * BLOCK)[None, :]  # how far back each key lies
_SEEN = _AT >= 0


class Rooms:
    """Buffers that are used again: fresh large arrays cost more than what is computed in them."""

    def __init__(self, kind: np.dtype):
        self._own, self._kind = {}, kind

    def __call__(self, name: str, *shape: int) -> np.ndarray:
        n = math.prod(shape)
        if name not in self._own or self._own[name].size < n:
            self._own[name] = np.empty(n, self._kind)
        return self._own[name][:n].reshape(shape)


def _exp(z: np.ndarray, bounded: bool) -> np.ndarray:
    """Exponentials in place; logits that aren't known to be bounded are held below 80, whose exponentials float32 can sum."""
    if not bounded:
        np.minimum(z, np.float32(80), out=z)
    return np.exp(z, out=z)


def _longest(rows: np.ndarray) -> float:
    """The largest length of a row."""
    return math.sqrt(float(np.einsum("ij,ij->i", rows, rows).max(initial=0)))


def _tables(w: Weights) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As a token's query, key and value depend on the token only, they are rows of tables: embedding, query, key and value; the value has gone through `out`."""
    x, more = w["embed"], w["embed"] @ _inner(w)
    return x, np.ascontiguousarray(more[:, :WIDTH]), np.ascontiguousarray(more[:, WIDTH:])


def _inner(w: Weights) -> np.ndarray:
    """From an embedding to its query, key and value, side by side."""
    return np.concatenate([w["query"] * WIDTH**-0.5, w["key"], w["value"] @ w["out"]], axis=1)


def _near(w: Weights) -> np.ndarray:
    return np.where(_SEEN, w["near"][np.maximum(_AT, 0)], np.float32(-1e9))


def _bias(weights: np.ndarray, bias: np.ndarray) -> np.ndarray:
    """The bias as a further row of the weights."""
    return np.concatenate([weights, bias[..., None, :]], axis=-2)


def hidden(w: Weights, ids: np.ndarray, has: np.ndarray, room: Rooms | None = None) -> dict:
    """All layers below the output for blocks of input ids; has: whether the block before is of the same text. Valid until the rooms are used again."""
    room, d, n = room or Rooms(w["embed"].dtype), WIDTH, len(ids)
    c = attended(_tables(w), _near(w), ids, has, room)
    c["m"] = _lifted(c["h"], w["up"], w["up_bias"], room)
    g = room("g", n * BLOCK, d + 1)
    np.add(c["h"], np.matmul(c["m"], w["down"], out=room("down", n * BLOCK, d)), out=g[:, :d])
    g[:, d] = 1
    return c | {"rows_g": g, "g": g[:, :d]}


def attended(tables: tuple[np.ndarray, ...], near: np.ndarray, ids: np.ndarray, has: np.ndarray, room: Rooms) -> dict:
    """The attention layer: rows h and what leads to them. Keys and values of a block follow those of the block before, as views of the same rows."""
    (embed, query, both), d, n, flat = tables, WIDTH, len(ids), ids.ravel()
    x = embed.take(flat, axis=0, out=room("x", ids.size, d), mode="clip")
    query_of = query.take(flat, axis=0, out=room("query", ids.size, d), mode="clip").reshape(n, BLOCK, d)
    rows = room("rows", ids.size + BLOCK, 2 * d)
    rows[:BLOCK] = 0
    both.take(flat, axis=0, out=rows[BLOCK:], mode="clip")
    windows = np.lib.stride_tricks.as_strided(rows, (n, 2 * BLOCK, 2 * d), (BLOCK * rows.strides[0], *rows.strides))
    keys, values = windows[:, :, :d], windows[:, :, d:]
    s = np.matmul(query_of, keys.transpose(0, 2, 1), out=room("s", n, BLOCK, 2 * BLOCK))
    s += near
    s[~has, :, :BLOCK] = -1e9
    _exp(s, _longest(query) * _longest(both[:, :d]) + float(near.max()) < 80)
    scale = (1 / (s @ np.ones(2 * BLOCK, s.dtype))).reshape(-1, 1)
    a = np.matmul(s, values, out=room("a", n, BLOCK, d)).reshape(-1, d)
    a *= scale
    h = np.add(a, x, out=room("h", ids.size, d))
    return {"query": query_of, "keys": keys, "values": values, "e": s, "scale": scale, "a": a, "h": h}


def _lifted(h: np.ndarray, up: np.ndarray, bias: np.ndarray, room: Rooms) -> np.ndarray:
    """The hidden layer behind its rectifier. Bias and zeros are as wide as a block: numpy's loops over short rows or one number are slow."""
    m = np.matmul(h, up, out=room("m", len(h), HIDDEN))
    wide = m.reshape(-1, BLOCK * HIDDEN)
    wide += np.tile(bias, BLOCK)
    np.maximum(wide, np.zeros(BLOCK * HIDDEN, m.dtype), out=wide)
    return m


class Scorer:
    """The forward pass alone, of weights that stay."""

    def __init__(self, w: Weights):
        self.tables, self.near = _tables(w), _near(w)
        self.up, self.up_bias, self.down = w["up"], w["up_bias"], w["down"]
        self.cls, self.tok = _bias(w["cls"], w["cls_bias"]), _bias(w["tok"], w["tok_bias"])
        self.place = w.place.astype(np.int32)
        self.most = [max(_longest(x.T) for x in logits) for logits in (self.cls[None], self.tok)]
        self._room = Rooms(self.near.dtype)

    def hidden(self, ids: np.ndarray, has: np.ndarray) -> np.ndarray:
        """Rows of the last layer, with a one behind each, for blocks of input ids; valid until the next call."""
        d, h = WIDTH, attended(self.tables, self.near, ids, has, self._room)["h"]
        out = self._room("last", len(h), d + 1)
        np.add(h, np.matmul(_lifted(h, self.up, self.up_bias, self._room), self.down, out=self._room("down", len(h), d)), out=out[:, :d])
        out[:, d] = 1
        return out

    def log_probability(self, g: np.ndarray, target: np.ndarray) -> np.ndarray:
        """Natural logarithm of each target's probability; g: rows of hidden(), target: subwords."""
        place = self.place[target]
        group = (place // GROUPS).astype(np.uint8)
        order = np.argsort(group, kind="stable")
        group, inner = group.take(order), (place % GROUPS).take(order)
        g = g.take(order, axis=0, out=self._room("g", *g.shape), mode="clip")
        at, longest = np.arange(len(g)) * GROUPS, _longest(g)
        z = np.matmul(g, self.cls, out=self._room("z", len(g), GROUPS))
        own = z.ravel().take(at + group)
        own -= _logsum(z, longest * self.most[0] < 80)
        cuts = np.searchsorted(group, np.arange(GROUPS + 1))
        for c in range(GROUPS):
            a, b = cuts[c], cuts[c + 1]
            np.matmul(g[a:b], self.tok[c], out=z[a:b])
        own += z.ravel().take(at + inner)
        own -= _logsum(z, longest * self.most[1] < 80)
        out = np.empty_like(own)
        out[order] = own
        return out


def _logsum(z: np.ndarray, bounded: bool) -> np.ndarray:
    """Logarithm of the summed exponentials of each row."""
    _exp(z, bounded)
    return np.log(z @ np.ones(z.shape[1], z.dtype))


def _missed(z: np.ndarray, own: np.ndarray, n: int, bounded: bool) -> float:
    """Turns logits into the gradient of the mean loss over n rows, in place; own: flat places of the targets. Gives the summed loss."""
    _exp(z, bounded)
    z *= (1 / ((z @ np.ones(z.shape[1], z.dtype)) * n))[:, None]
    flat = z.ravel()
    p = flat.take(own)
    flat[own] = p - 1 / n
    return -float(np.log(p * n + 1e-30).sum(dtype=np.float64))


def gradients(w: Weights, ids: np.ndarray, target: np.ndarray, has: np.ndarray, valid: np.ndarray, room: Rooms | None = None) -> tuple[float, dict]:
    """Mean loss of the valid targets, and its gradient by every weight."""
    room, width, blocks = room or Rooms(w["embed"].dtype), WIDTH, len(ids)
    c = hidden(w, ids, has, room)
    flat = np.flatnonzero(valid.ravel())
    n = max(1, len(flat))
    place = w.place[target.ravel()[flat]]
    group = (place // GROUPS).astype(np.uint8)
    order = np.argsort(group, kind="stable")
    flat, group, inner = flat.take(order), group.take(order), (place % GROUPS).take(order)
    cuts = np.searchsorted(group, np.arange(GROUPS + 1))
    g = c["rows_g"].take(flat, axis=0, out=room("own", len(flat), width + 1), mode="clip")
    at, longest = np.arange(len(g)) * GROUPS, _longest(g)
    d: dict[str, np.ndarray] = {}
    cls, tok = _bias(w["cls"], w["cls_bias"]), _bias(w["tok"], w["tok_bias"])
    p = np.matmul(g, cls, out=room("p", len(g), GROUPS))
    loss = _missed(p, at + group, n, longest * _longest(cls.T) < 80)
    both = g.T @ p
    d["cls"], d["cls_bias"] = both[:-1], both[-1]
    rows = room("dg", len(g) + 1, width)
    rows[-1] = 0  # what a place without a valid target takes
    dg = np.matmul(p, w["cls"].T, out=rows[:-1])
    more, both = room("more", len(g), width), np.zeros_like(tok)
    used = [(k, cuts[k], cuts[k + 1]) for k in range(GROUPS) if cuts[k] < cuts[k + 1]]
    for k, a, b in used:
        np.matmul(g[a:b], tok[k], out=p[a:b])
    loss += _missed(p, at + inner, n, longest * max(_longest(x.T) for x in tok) < 80)
    for k, a, b in used:
        np.matmul(g[a:b].T, p[a:b], out=both[k])
        np.matmul(p[a:b], w["tok"][k].T, out=more[a:b])
    d["tok"], d["tok_bias"] = both[:, :-1], both[:, -1]
    dg += more
    at = np.full(ids.size, len(g))
    at[flat] = np.arange(len(g))
    full = rows.take(at, axis=0, out=room("full", ids.size, width), mode="clip")
    m, h = c["m"], c["h"]
    d["down"] = m.T @ full
    dm = np.matmul(full, w["down"].T, out=room("dm", *m.shape))
    dm *= m > 0
    d["up"], d["up_bias"] = h.T @ dm, np.ones(len(dm), dm.dtype) @ dm
    full += np.matmul(dm, w["up"].T, out=room("down", len(m), width))
    # weights of attention are e / total: the mean over a row of what they change is taken off before they are multiplied by e
    e, do = c["e"], np.multiply(full, c["scale"], out=room("do", *full.shape))
    mean = np.multiply(c["a"], do, out=room("down", *do.shape)) @ np.ones(width, do.dtype)
    do = do.reshape(blocks, BLOCK, width)
    ds = np.matmul(do, c["values"].transpose(0, 2, 1), out=room("ds", *e.shape))
    ds -= mean.reshape(blocks, BLOCK, 1)
    ds *= e
    each = (np.ones(blocks, ds.dtype) @ ds.reshape(blocks, -1)).reshape(_AT.shape)
    d["near"] = np.bincount(_AT[_SEEN], weights=each[_SEEN], minlength=2 * BLOCK).astype(np.float32)
    order = np.argsort(ids.ravel().astype(np.uint16), kind="stable")
    sorted_ids = ids.ravel().take(order)
    opens = np.flatnonzero(np.append(True, sorted_ids[1:] != sorted_ids[:-1]))
    present = sorted_ids[opens]

    def by_token(rows: np.ndarray) -> np.ndarray:
        """Summed over the places of each token: queries, keys and values are the token's, so the rest is done once a token."""
        return np.add.reduceat(rows.reshape(-1, width).take(order, axis=0, out=room("sorted", ids.size, width), mode="clip"), opens, axis=0)

    def folded(wide: np.ndarray) -> np.ndarray:
        out = room("folded", blocks, BLOCK, width)
        out[:] = wide[:, BLOCK:]
        out[:-1] += wide[1:, :BLOCK]  # zeros where the block before is of another text
        return out

    wide, own = room("wide", blocks, 2 * BLOCK, width), by_token(full)
    inward = [  # by query, key and value
        by_token(np.matmul(ds, c["keys"], out=room("do by query", *do.shape))),
        by_token(folded(np.matmul(ds.transpose(0, 2, 1), c["query"], out=wide))),
        by_token(folded(np.matmul(e.transpose(0, 2, 1), do, out=wide))),
    ]
    inward = np.concatenate(inward, axis=1)
    both = w["embed"][present].T @ inward
    d["query"], d["key"] = both[:, :width] * width**-0.5, both[:, width : 2 * width]
    d["value"], d["out"] = both[:, 2 * width :] @ w["out"].T, w["value"].T @ both[:, 2 * width :]
    d["embed"] = np.zeros_like(w["embed"])
    d["embed"][present] = own + inward @ _inner(w).T
    return loss / n, d


def trained(w: Weights, blocks: Iterator[tuple[np.ndarray, ...]], rate: float = RATE) -> tuple[Weights, int]:
    """Adam over batches of (ids, target, has, valid); gives new weights and the number of tokens seen."""
    w = w.like({k: v.copy() for k, v in w.items()})
    first, second, seen = {k: np.zeros_like(v) for k, v in w.items()}, {k: np.zeros_like(v) for k, v in w.items()}, 0
    room = Rooms(w["embed"].dtype)
    for step, batch in enumerate(blocks, 1):
        _, d = gradients(w, *batch, room)
        seen += int(batch[3].sum())
        norm = np.sqrt(sum(float((g * g).sum()) for g in d.values()))
        for k, g in d.items():
            g = g * min(1.0, 1 / (norm + 1e-9))
            first[k] += 0.1 * (g - first[k])
            second[k] += 0.01 * (g * g - second[k])
            w[k] -= (rate / (1 + step / 400)) * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-6)
    return w, seen


class Subwords:
    """Dense ids of the bytes and the first merges of a byte-level BPE file."""

    def __init__(self, path: str):
        self.bpe = bpe.load(path, MERGES)
        self.dense = np.zeros(self.bpe.size, np.int64)
        self.dense[self.bpe.first] = np.arange(256)
        self.dense[self.bpe.made] = 256 + np.arange(len(self.bpe.made))
        self.opens = np.zeros(GROUPS * GROUPS, bool)  # ids that begin with a blank, as each word does
        for i in (*self.bpe.first.tolist(), *self.bpe.made.tolist()):
            self.opens[self.dense[i]] = self.bpe.bytes_of[i].startswith(b" ")

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        column = pa.array(texts, pa.binary())
        ids, count = bpe.encode_column(self.bpe, column)
        return self.dense[ids], count


def blocked(ids: np.ndarray, count: np.ndarray, ends: np.ndarray | bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Texts as blocks: input ids (the end stands before a text), targets (and behind it, where the text ends there), whether there is a block before, valid places, first block of each text."""
    number = -(-(count + 1) // BLOCK)
    first = np.cumsum(number) - number
    target = np.full(int(number.sum()) * BLOCK, END, np.int32)
    valid = np.zeros(len(target), bool)
    place = bpe.ragged(first * BLOCK, count)
    target[place] = ids
    valid[place] = True
    valid[first * BLOCK + count] = ends
    source = np.full(len(target), END, np.int32)
    source[place + 1] = ids  # the place behind a text's last subword is its end's, so it is there
    has = np.ones(int(number.sum()), bool)
    has[first] = False
    return source.reshape(-1, BLOCK), target.reshape(-1, BLOCK), has, valid.reshape(-1, BLOCK), first


def text_scores(scorer: Scorer, ids: np.ndarray, count: np.ndarray, step: int = 512) -> np.ndarray:
    """log10 probability of each text with its end."""
    source, target, has, valid, first = blocked(ids, count)
    total = np.zeros(len(source))
    for a in range(0, len(source), step):
        b = max(0, a - 1)  # the block before gives keys, and isn't scored again
        open_ = has[b : a + step].copy()
        open_[0] = False
        own = scorer.hidden(source[b : a + step], open_)[(a - b) * BLOCK :]
        each = scorer.log_probability(own, target[a : a + step].ravel())
        each[~valid[a : a + step].ravel()] = 0
        total[a : a + step] = each.reshape(-1, BLOCK).sum(axis=1, dtype=np.float64)
    return np.add.reduceat(total, first) / np.log(10) if len(first) else np.zeros(0)


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.encode(F.coalesce(doc_id.cast("string"), F.lit("")), "utf-8")) % 7 == 2


def _words(column: pa.Array) -> list[list[bytes]]:
    offsets = string_offsets(column)
    data = bytes(string_bytes(column)[int(offsets[0]) : int(offsets[-1])]).translate(_LOWER)
    cuts = (offsets - offsets[0]).tolist()
    return [data[a:b].split() for a, b in zip(cuts, cuts[1:])]


def word_counts(rows: DataFrame) -> DataFrame:
    """(word, c) over all texts, combined within each task first; the end isn't among the words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from collections import Counter

        for batch in batches:
            for part in byte_slices(batch, most=8 << 20):
                found: Counter = Counter()
                for own in _words(part.column(0)):
                    found.update(own)
                yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.binary()), pa.array(list(found.values()), pa.int64())], names=["word", "c"])

    return rows.select("text").mapInArrow(run, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


def encoded(rows: DataFrame, tokenizer: str, known: Callable[[], dict[bytes, float]] = dict) -> DataFrame:
    """(doc_id, text_key, held_out, ids, n_words, n_head, head_sum) for (doc_id, text_key, held_out, text).

    ids: the subwords of all words, 16 bits each; n_head: how many words known() holds, head_sum: the sum of its values for them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, values = Subwords(tokenizer), known()
        for batch in batches:
            for part in byte_slices(batch, most=8 << 20):
                words = _words(part.column(3))
                number = np.fromiter(map(len, words), np.int64, len(words))
                found = np.fromiter(map(values.get, chain.from_iterable(words), repeat(-1.0)), np.float64, int(number.sum()))
                has, texts = found >= 0, [b" " + b" ".join(x) if x else b"" for x in words]
                del words  # larger than the texts
                ids, count = own.encode(texts)
                payload = binary_array(np.ascontiguousarray(ids, "<u2"), np.concatenate([[0], np.cumsum(count)]) * 2)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), part.column(2), payload, pa.array(number), pa.array(sums(has.astype(np.int64), number)), pa.array(sums(np.where(has, found, 0.0), number))],
                    names=["doc_id", "text_key", "held_out", "ids", "n_words", "n_head", "head_sum"],
                )

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, text_key long, held_out boolean, ids binary, n_words long, n_head long, head_sum double")


def _ids(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Ids of a binary column in order, and how many each row has."""
    offsets = string_offsets(column)
    return np.frombuffer(string_bytes(column), "<u2")[int(offsets[0]) // 2 : int(offsets[-1]) // 2].astype(np.int64), np.diff(offsets) // 2


def spans_of(ids: np.ndarray, count: np.ndarray, opens: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Texts cut into spans of SPAN words: number of ids of each span, its text, its place in the text, whether it is the last.

    A text without ids is one span of none, so that its end is learnt.
    """
    text = np.repeat(np.arange(len(count)), count)
    word = np.cumsum(opens[ids])
    before = np.append(0, word)[np.cumsum(count) - count]  # words ahead of each text
    place = np.maximum(word - before[text] - 1, 0) // SPAN
    first = np.flatnonzero(np.append(True, (text[1:] != text[:-1]) | (place[1:] != place[:-1]))) if len(ids) else np.zeros(0, np.int64)
    bare = np.flatnonzero(count == 0)
    owner = np.append(text[first], bare)
    order = np.argsort(owner, kind="stable")
    size = np.append(np.diff(np.append(first, len(ids))), np.zeros_like(bare))[order]
    owner, place = owner[order], np.append(place[first], np.zeros_like(bare))[order]
    return size, owner, place, np.append(owner[1:] != owner[:-1], True)[: len(owner)]


def train(table: DataFrame, counts: DataFrame, tokens: int, ends: int, tokenizer: str) -> Weights:
    """table: encoded() rows to learn from, each span in one of the rounds; counts: their word counts; tokens: how many those and the ends are; ends: how many rows."""

    def subword_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, total = Subwords(tokenizer), np.zeros(GROUPS * GROUPS)
        for batch in batches:
            for k in range(0, len(batch), 50_000):
                part = batch.slice(k, 50_000)
                ids, count = own.encode([b" " + x for x in part.column(0).to_pylist()])
                total += np.bincount(ids, weights=np.repeat(part.column(1).to_numpy().astype(float), count), minlength=len(total))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], names=["id", "n"])

    counted = np.zeros(GROUPS * GROUPS)
    for r in counts.mapInArrow(subword_counts, "id long, n double").groupBy("id").agg(F.sum("n").alias("n")).collect():  # a row a subword
        counted[r["id"]] = r["n"]
    counted[END] = ends
    trainers = max(1, -(-tokens // WORDS_EACH))

    def spans(number: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            opens = Subwords(tokenizer).opens
            for batch in batches:
                for part in byte_slices(batch, "ids", 1 << 20):
                    ids, count = _ids(part.column(1))
                    size, text, place, last = spans_of(ids, count, opens)
                    key = part.column(0).to_numpy().view(np.uint64)[text] ^ (place.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
                    key = (key ^ (key >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
                    key ^= key >> np.uint64(29)
                    own = np.flatnonzero((key >> np.uint64(33)) % np.uint64(SHARE) == 0 if number == 0 else (key >> np.uint64(33)) % np.uint64(SHARE) != 0)
                    cuts = np.concatenate([[0], np.cumsum(size)]) * 2
                    raw = ids.astype("<u2").tobytes()
                    payload = pa.array([raw[cuts[k] : cuts[k + 1]] for k in own.tolist()], pa.binary())
                    trainer = (key[own] % np.uint64(trainers)).astype(np.int32)
                    yield pa.RecordBatch.from_arrays([pa.array(trainer), pa.array(key[own].view(np.int64)), pa.array(last[own]), payload], names=["trainer", "key", "last", "ids"])

        dealt = table.select(F.xxhash64("doc_id", "text_key").alias("key"), "ids").mapInArrow(run, "trainer int, key long, last boolean, ids binary")
        return dealt.repartitionById(trainers, F.col("trainer")).sortWithinPartitions("key")

    spark = table.sparkSession
    weights = Weights.start(counted)

    def fitted(shared):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            number = [0]

            def blocks():
                for batch in batches:
                    if not len(batch):
                        continue
                    number[0] = batch.column(0)[0].as_py()
                    ids, count = _ids(batch.column(3))
                    source, target, has, valid, _ = blocked(ids, count, batch.column(2).to_numpy(zero_copy_only=False))
                    for a in range(0, len(source), BATCH):
                        own = has[a : a + BATCH].copy()
                        own[0] = False
                        yield source[a : a + BATCH], target[a : a + BATCH], own, valid[a : a + BATCH]

            new, seen = trained(shared.value, blocks())
            if seen:
                flat = np.concatenate([v.ravel() for v in new.values()]).astype("<f8") * seen
                yield pa.RecordBatch.from_arrays([pa.array([number[0]], pa.int32()), pa.array([seen]), pa.array([flat.tobytes()], pa.binary())], names=["trainer", "seen", "weights"])

        return run

    def summed(own: pa.Table) -> pa.Table:
        own = own.sort_by("trainer")
        total = sum(np.frombuffer(x, "<f8") for x in own["weights"].to_pylist())
        return pa.table({"trainer": pa.array([own["trainer"][0].as_py()], pa.int32()), "seen": [sum(own["seen"].to_pylist())], "weights": pa.array([total.tobytes()], pa.binary())})

    kinds, buckets = "trainer int, seen long, weights binary", max(1, int(np.sqrt(trainers)))
    for k in range(ROUNDS):
        each = spans(k).mapInArrow(fitted(spark.sparkContext.broadcast(weights)), kinds)
        some = each.groupBy(F.pmod("trainer", F.lit(buckets))).applyInArrow(summed, kinds)
        got = some.groupBy().applyInArrow(summed, kinds).first()  # one row
        if got is None:
            continue
        mean, at, values = np.frombuffer(got["weights"], "<f8") / got["seen"], 0, {}
        for name, v in weights.items():
            values[name] = mean[at : at + v.size].reshape(v.shape).astype(np.float32)
            at += v.size
        weights = weights.like(values)
    return weights


def score(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for every row.

    Learns from the rows that aren't held out. Tokens are the lower-cased words and one end. base_score sums the
    logarithms of their smoothed shares; score is the model's log10 probability of the text's subwords and end. A null
    text counts as empty and has the end alone; in training, too, it teaches how likely a text is to end at once. Rows that repeat id and text get equal results. With no training rows
    every count is zero and the model is as it starts. An empty table gives an empty one. Further columns are left out.
    """
    spark = docs.sparkSession
    rows = text_rows(docs, id_col, text_col).withColumn("held_out", held_out(F.col("doc_id")))
    learn = rows.where(~F.col("held_out"))
    counts = written(word_counts(learn), "lm-counts")
    total = counts.agg(F.sum("c").alias("n"), F.count("*").alias("v")).first()
    ends = learn.select("doc_id").count()
    train_tokens, kinds = (total["n"] or 0) + ends, total["v"] + (ends > 0)
    keyed = rows.select("doc_id", F.xxhash64("text").alias("text_key"), "held_out", "text")
    floor = float(np.log10(train_tokens + kinds + 1))
    frequent = (F.col("c") * HEAD >= train_tokens) & (F.octet_length("word") <= LONG_WORD)
    head = {bytes(r["word"]): r["c"] for r in counts.where(frequent).toLocalIterator()}  # HEAD words at most
    shared = spark.sparkContext.broadcast(head)

    def by_word(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from collections import Counter

        known = shared.value
        for batch in batches:
            for part in byte_slices(batch, most=4 << 20):
                found, number, times = [], [], []
                for own in _words(part.column(2)):
                    rare = Counter(filterfalse(known.__contains__, own))
                    found += rare
                    times += rare.values()
                    number.append(len(rare))
                row = pa.array(np.repeat(np.arange(len(number)), number))
                yield pa.RecordBatch.from_arrays([part.column(0).take(row), part.column(1).take(row), pa.array(found, pa.binary()), pa.array(times, pa.int64())], names=["doc_id", "text_key", "word", "times"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    rare = keyed.select("doc_id", "text_key", "text").mapInArrow(by_word, f"doc_id {kind}, text_key long, word binary, times long")
    found = rare.join(counts.where(~frequent), "word", "left")
    c = F.coalesce("c", F.lit(0))
    tail = found.groupBy("doc_id", "text_key").agg(
        F.sum("times").alias("all"), F.sum(F.when(F.col("c") > 0, F.col("times")).otherwise(0)).alias("known"), F.sum(F.col("times") * (F.log10(c + 1) - floor)).alias("sum")
    )
    tail = written(tail.select(F.col("doc_id").alias("__id"), F.col("text_key").alias("__key"), (F.col("known") / F.col("all")).alias("__known"), (F.col("sum") / F.col("all")).alias("__mean")), "lm-tail")  # before there are ids, so that its shuffle and theirs needn't lie on disk at once

    table = written(encoded(keyed, tokenizer, lambda: {k: float(np.log10(c + 1)) for k, c in shared.value.items()}), "lm-ids")
    weights = spark.sparkContext.broadcast(train(table.where(~F.col("held_out")), counts, train_tokens, ends, tokenizer))

    def modelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Scorer(weights.value)
        for batch in batches:
            for part in byte_slices(batch, "ids", 4 << 20):
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), part.column(2), pa.array(text_scores(model, *_ids(part.column(3))))], names=["doc_id", "text_key", "held_out", "score"])

    n_tail, end_score = F.col("n_words") - F.col("n_head"), float(np.log10(ends + 1)) - floor
    texts = table.select(
        "doc_id", "text_key", (F.col("n_words") + 1).alias("n_tokens"), (F.col("n_head") + int(ends > 0)).alias("n_head"), n_tail.alias("n_tail"),
        (F.col("head_sum") - F.col("n_head") * floor + end_score).alias("head_score"),
    )
    scores = table.select("doc_id", "text_key", "held_out", "ids").mapInArrow(modelled, f"doc_id {kind}, text_key long, held_out boolean, score double").dropDuplicates(["doc_id", "text_key"])
    scores = scores.select(F.col("doc_id").alias("__own"), F.col("text_key").alias("__text"), "held_out", "score")
    out = texts.join(scores, texts["doc_id"].eqNullSafe(scores["__own"]) & (texts["text_key"] == scores["__text"]))
    out = out.join(tail, out["doc_id"].eqNullSafe(tail["__id"]) & (out["text_key"] == tail["__key"]), "left")  # rows that repeat share a tail, each by its own count
    return out.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_head") + F.round(F.col("n_tail") * F.coalesce("__known", F.lit(0.0))).cast("long")).alias("n_known"),
        F.lit(train_tokens).cast("long").alias("train_tokens"),
        (F.col("head_score") + F.col("n_tail") * F.coalesce("__mean", F.lit(0.0))).alias("base_score"),
        "score",
    )
