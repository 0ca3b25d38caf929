"""SimHash near-dedup by the generalised pigeonhole principle.

Documents get a 64-bit fingerprint; equal fingerprints become one node. Two nodes whose fingerprints differ in at most
tau bits agree, in at least one of m parts of the bits, up to that part's threshold, if the thresholds sum to
tau - m + 1 (-1: the part isn't probed). Bits that go together in the data are grouped into the same part, and dynamic
programming picks m and the thresholds that cost least by the candidate counts estimated from all fingerprints.

A part of threshold t is probed by each fingerprint's part value with up to t of its set bits cleared: two values that
differ in at most t bits meet in one of these. All candidates that meet are verified on the whole fingerprint. Where
very many meet, they are divided once more by the bits in which they still differ, so no group is compared pair by pair
as a whole, and only links that span a group's components leave the task.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barmill.llm.common import byte_slices, ragged, string_bytes, string_offsets, text_rows, written

_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_LANES = np.uint64(0x0101010101010101)
#: Groups beyond this size are divided before they are compared.
DENSE = 2048
#: Estimated cost of a verified candidate pair against that of a shuffled signature.
PAIR_COST = 0.02


def hashes(text: bytes, shingle: int, seed: int = 42) -> np.ndarray:
    """XXH64 of the shingles of lower-cased UTF-8 words, repeats included; of the whole sequence if there are fewer words."""
    from xxhash import xxh64_intdigest

    words = text.split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    if len(words) <= shingle:
        return np.array([xxh64_intdigest(joined, seed)], np.uint64)
    starts = [0, *itertools.accumulate(len(w) + 1 for w in words)]
    parts = map(joined.__getitem__, map(slice, starts, [x - 1 for x in starts[shingle:]]))
    return np.fromiter(map(xxh64_intdigest, parts, itertools.repeat(seed)), np.uint64, len(words) - shingle + 1)


def majority(h: np.ndarray, number: np.ndarray) -> np.ndarray:
    """A fingerprint for each run of `number` hashes: the bits that over half of them have; zero for an empty run."""
    out = np.zeros(len(number), np.uint64)
    some = np.flatnonzero(number)
    if not len(some):
        return out
    count = number[some]
    blocks = (count + 254) // 255  # sums of up to 255 bits fit into a byte lane
    first = np.cumsum(count) - count
    own = np.repeat(first, blocks) + 255 * ragged(np.zeros(len(blocks)), blocks)
    total = np.zeros((len(some), 64), np.int64)
    begin = np.cumsum(blocks) - blocks
    for k in range(8):
        lanes = np.add.reduceat((h >> np.uint64(k)) & _LANES, own).astype("<u8").view(np.uint8).reshape(-1, 8)
        total[:, k::8] = np.add.reduceat(lanes.astype(np.int64), begin, axis=0)
    bits = (2 * total > count[:, None]).astype(np.uint8)
    out[some] = np.packbits(bits, axis=1, bitorder="little").view("<u8")[:, 0]
    return out


def fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_key, fp) for every row; fp: the fingerprint as a signed 64-bit integer. Texts without words have 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in byte_slices(batch, most=4 << 20):
                offsets = string_offsets(part.column(2))
                data = bytes(string_bytes(part.column(2))[int(offsets[0]) : int(offsets[-1])]).translate(_LOWER)
                cuts = (offsets - offsets[0]).tolist()
                each = [hashes(data[a:b], shingle) for a, b in zip(cuts, cuts[1:])]
                fp = majority(np.concatenate(each), np.fromiter(map(len, each), np.int64, len(each)))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(fp.view(np.int64))], names=["doc_id", "text_key", "fp"])

    rows = text_rows(docs, id_col, text_col).select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, text_key long, fp long")


def bit_statistics(nodes: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints, and how many have both bits i and j, over all of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((64, 64)), 0
        for batch in batches:
            bits = _bits(batch.column(0).to_numpy().view(np.uint64)).astype(np.float32)
            n += len(bits)
            total += bits.T @ bits
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(4097)), pa.array(np.append(total.ravel(), n).astype(np.int64))], names=["at", "n"])

    rows = nodes.select("fp").mapInArrow(run, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).collect()  # 4097 rows
    out = np.zeros(4097, np.int64)
    for r in rows:
        out[r["at"]] = r["n"]
    return int(out[-1]), out[:-1].reshape(64, 64)


def _bits(fp: np.ndarray) -> np.ndarray:
    return np.unpackbits(fp.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def correlated_parts(n: int, both: np.ndarray, m: int) -> list[list[int]]:
    """The bits in m parts of nearly equal width: each part grows by the free bit that correlates most with it."""
    p = np.diag(both) / max(n, 1)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    corr = np.abs(both / max(n, 1) - np.outer(p, p)) / np.outer(spread, spread)
    free, parts = set(range(64)), []
    for k in range(m):
        own = [min(free, key=lambda b: (-corr[b, list(free)].sum(), b))]
        free.discard(own[0])
        while len(own) < 64 // m + (k < 64 % m):
            best = max(free, key=lambda b: (corr[b, own].sum(), -b))
            own.append(best)
            free.discard(best)
        parts.append(sorted(own))
    return parts


def allocate(costs: list[list[float]], total: int) -> list[int]:
    """Thresholds (from -1) of parts that sum to total and cost least; costs[i][t + 1] is that of threshold t in part i."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for own in costs:
        step: dict[int, tuple[float, list[int]]] = {}
        for s, (cost, chosen) in best.items():
            for k, c in enumerate(own):
                new = (cost + c, [*chosen, k - 1])
                if s + k - 1 not in step or new < step[s + k - 1]:
                    step[s + k - 1] = new
        best = step
    return best[total][1]


def plan(nodes: DataFrame, tau: int) -> list[tuple[list[int], int]]:
    """Parts with their thresholds, for the number of parts that costs least by the estimated candidate counts."""
    n, both = bit_statistics(nodes)
    p = np.diag(both) / max(n, 1)
    same = p * p + (1 - p) * (1 - p)
    ratio = (1 - same) / same  # how much likelier two fingerprints agree but for this bit than agree
    tried = {m: correlated_parts(n, both, m) for m in range(2, tau + 3)}
    named = [(m, k, bits) for m, parts in tried.items() for k, bits in enumerate(parts)]

    def run(batches):
        for batch in batches:
            fp = batch.column(0).to_numpy().view(np.uint64)
            for k, (_, _, bits) in enumerate(named):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(fp), k)), pa.array(_value(fp, bits).view(np.int64))], names=["part", "value"])

    met = nodes.select("fp").mapInArrow(run, "part long, value long").groupBy("part", "value").agg(F.count("*").alias("c"))
    pairs = {r["part"]: float(r["pairs"]) for r in met.groupBy("part").agg(F.sum(F.col("c").cast("double") * (F.col("c") - 1) / 2).alias("pairs")).collect()}  # a row a part
    best = None
    for m, parts in tried.items():
        costs = []
        for k, bits in enumerate(parts):
            r, w = ratio[bits], len(bits)
            near = [1.0, r.sum(), (r.sum() ** 2 - (r * r).sum()) / 2]
            ways = [1.0, w / 2, w * (w - 1) / 8]
            found = max(pairs.get(named.index((m, k, bits)), 0.0), n * n / 2 * float(np.prod(same[bits])))
            costs.append([0.0] + [n * sum(ways[: t + 1]) + PAIR_COST * found * sum(near[: t + 1]) for t in range(min(tau, 2) + 1)])
        thresholds = allocate(costs, tau - m + 1)
        cost = sum(c[t + 1] for c, t in zip(costs, thresholds))
        if best is None or cost < best[0]:
            best = (cost, [(bits, t) for bits, t in zip(parts, thresholds) if t >= 0])
    return best[1]


def _value(fp: np.ndarray, bits: list[int]) -> np.ndarray:
    out = np.zeros(len(fp), np.uint64)
    for k, b in enumerate(bits):
        out |= ((fp >> np.uint64(b)) & np.uint64(1)) << np.uint64(k)
    return out


def signatures(fp: np.ndarray, parts: list[tuple[list[int], int]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(key, fingerprint) of each part's value with up to its threshold of set bits cleared."""
    for k, (bits, t) in enumerate(parts):
        value, w = _value(fp, bits), len(bits)
        for cleared in range(t + 1):
            for own in itertools.combinations(range(w), cleared):
                mask = np.uint64(sum(1 << b for b in own))
                has = (value & mask) == mask
                yield ((value[has] & ~mask) ^ np.uint64((0x9E3779B97F4A7C15 * (k + 1)) & (2**64 - 1))), fp[has]


def links(fp: np.ndarray, tau: int, varying: list[int] | None = None) -> list[tuple[np.ndarray, np.ndarray]]:
    """Links that span the components of distinct fingerprints under "differ in at most tau bits"."""
    if len(fp) < 2:
        return []
    if len(fp) > DENSE:
        differ = np.bitwise_or.reduce(fp ^ fp[0])
        bits = [b for b in range(64) if int(differ) >> b & 1]
        if len(bits) > tau + 1:  # one of tau + 1 groups of these bits is equal
            out = []
            for k in range(tau + 1):
                value = _value(fp, bits[k :: tau + 1])
                order = np.argsort(value, kind="stable")
                cuts = np.flatnonzero(np.diff(value[order])) + 1
                for part in np.split(order, cuts):
                    if len(part) > 1:
                        out += links(fp[part], tau)
            return out
    left, right, rest = [], [], np.sort(fp)
    while len(rest):
        root, rest, todo = rest[0], rest[1:], [rest[0]]
        while todo and len(rest):
            near = np.bitwise_count(rest ^ todo.pop()) <= tau
            if near.any():
                own = rest[near]
                right.append(own)
                left.append(np.full(len(own), root))
                todo += list(own)
                rest = rest[~near]
    return [(np.concatenate(right), np.concatenate(left))] if right else []


def _verified(tau: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by key; groups that end with the batch are compared, the last one waits for the next batch."""
        key, fp = np.zeros(0, np.int64), np.zeros(0, np.uint64)
        for batch in itertools.chain(batches, [None]):
            if batch is not None:
                key = np.concatenate([key, batch.column(0).to_numpy()])
                fp = np.concatenate([fp, batch.column(1).to_numpy().view(np.uint64)])
                end = int(np.searchsorted(key, key[-1])) if len(key) else 0
            else:
                end = len(key)
            a, b = _groups(key[:end], fp[:end], tau)
            key, fp = key[end:], fp[end:]
            if len(key) > DENSE:  # a group that spans batches is kept as its distinct fingerprints
                fp = np.unique(fp)
                key = np.full(len(fp), key[0])
            yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["u", "v"])

    return run


def _groups(key: np.ndarray, fp: np.ndarray, tau: int) -> tuple[np.ndarray, np.ndarray]:
    """Links within each run of equal keys."""
    out: list[tuple[np.ndarray, np.ndarray]] = []
    if len(key):
        starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        size = np.diff(np.append(starts, len(key)))
        for k in np.flatnonzero(size > 16).tolist():
            out += links(np.unique(fp[starts[k] : starts[k] + size[k]]), tau)
        group = np.repeat(np.arange(len(size)), size)
        small = np.flatnonzero(size[group] <= 16)
        for d in range(1, 16):
            at = small[:-d]
            at = at[(small[d:] - at == d) & (group[small[d:]] == group[at])]
            if not len(at):
                break
            x, y = fp[at], fp[at + d]
            near = (np.bitwise_count(x ^ y) <= tau) & (x != y)
            out.append((x[near], y[near]))
    if not out:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    return np.concatenate([x for x, _ in out]), np.concatenate([y for _, y in out])


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node with a link, root being the least node of its component; edges: (u, v) long.

    Alternates large-star and small-star steps, each one aggregation and one join that can be split where a node is hot,
    until the links don't change. Every step is written to the shared folder.
    """
    own = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    own, before = written(own, "links"), None
    while True:
        state = own.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            return own.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(own.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        before = state
        both = own.unionByName(own.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = written(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")  # so that a hot node can be split in the join
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = written(large, "links")
        least = written(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        small = large.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        own = written(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "links")


def near_groups(docs: DataFrame, shingle: int = 3, tau: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_key, fp, component_id) for every row; rows link if their fingerprints differ in at most tau bits.

    component_id is the smallest doc_id reachable over links. Null and empty texts, and others without words, have
    fingerprint zero and link like any others. Null ids don't count as smallest; a component of null ids alone has a
    null id. Repeated rows share a fingerprint and so a component. tau: 0 to 2.
    """
    if tau not in (0, 1, 2):
        raise ValueError("tau is 0 to 2")
    rows = written(fingerprints(docs, shingle, id_col, text_col), "fingerprints")
    nodes = written(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "nodes")
    parts = plan(nodes, tau)

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, fp in signatures(batch.column(0).to_numpy().view(np.uint64), parts):
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(fp.view(np.int64))], names=["key", "fp"])

    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    met = nodes.select("fp").mapInArrow(probe, "key long, fp long").repartition(n, "key").sortWithinPartitions("key")
    found = components(met.mapInArrow(_verified(tau), "u long, v long"))
    member = nodes.join(found, nodes["fp"] == found["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    ids = written(member.groupBy("root").agg(F.min("least").alias("component_id")), "groups")  # so that a hot root can be split in the join
    return rows.join(member.join(ids, "root").select("fp", "component_id"), "fp").select("doc_id", "text_key", "fp", "component_id")
