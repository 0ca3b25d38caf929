"""Near-dedup by the similarity of shingle sets: SimHash on wide fingerprints, the generalised pigeonhole with a fixed recall.

A text's fingerprint has WIDE bits, each the majority over its distinct shingles' hashes under another mix, so the bits
of a pair differ independently, with a chance that follows from the similarity. Bits that go together in the data are
grouped into the same part. Every part has a threshold: -1 (not probed), 0 or 1 differing bits. Dynamic programming
picks the thresholds that cost least by the candidate counts of all fingerprints, under the condition that a pair at the
limit of similarity meets in some part with a chance of RECALL. Short texts also meet by their least shingles.

Bits only find candidates: a link takes the similarity of the two sets of shingle hashes themselves. Members of a run
(texts that share a part's value) that have a candidate of another group are compared in one task with their sets at
hand, each pair in the first run in which it meets, so no pairs leave a task but the links that join groups. Runs with
many rows or bytes are dealt in blocks: first the members of a block are linked among themselves, then one of each
group, and then members of the largest group only meet those that are still outside it. A first round over a few parts
joins most groups; the second takes the other parts, and compares texts of different groups only.
"""

from __future__ import annotations

import functools
import itertools
from collections.abc import Iterator
from math import comb
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barmill.llm.common import byte_slices, kept_rows, string_bytes, string_offsets, text_rows, written
from barmill.llm.simhash import PAIR_COST, components, correlated_parts, hashes, majority

_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
#: Lanes of 64 bits of a fingerprint, its bits, and how many lanes a candidate pair is first compared on.
LANES, WIDE, FIRST = 16, 1024, 4
#: Parts that are probed in the first round.
FIRST_PARTS = 4
#: Chance that a pair at the limit of similarity meets in some part, whatever the number of texts.
RECALL = 0.999
#: Standard deviations of differing bits above their mean at the limit up to which a pair is looked at: one in 4,000 such pairs is beyond.
SLACK = 3.5
#: Texts of this many shingles at most also meet by their least shingles, without fail.
FEW = 16
#: Sets of more shingles than this have bits that differ as often as those of very large ones.
MANY = 64
#: Rows of a run, and bytes of its shingle sets, beyond which it is dealt in blocks.
RUN_ROWS, RUN_BYTES = 1 << 14, 32 << 20


def fingerprints(docs: DataFrame, shingle: int = 5, similarity: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_key, node, fp, size, few) for every row.

    node: a hash of the set of shingles, so texts of one set share it; size: how many shingles; few: of texts of FEW
    shingles at most the least of them, of which two texts of this similarity have one in common.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh64_intdigest

        seeds = (np.arange(1, LANES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)).tolist()
        for batch in batches:
            for part in byte_slices(batch, most=4 << 20):
                offsets = string_offsets(part.column(2))
                data = bytes(string_bytes(part.column(2))[int(offsets[0]) : int(offsets[-1])]).translate(_LOWER)
                cuts = (offsets - offsets[0]).tolist()
                each = [np.unique(hashes(data[a:b], shingle)) for a, b in zip(cuts, cuts[1:])]
                number = np.fromiter(map(len, each), np.int64, len(each))
                node = np.fromiter((xxh64_intdigest(x.tobytes()) for x in each), np.uint64, len(each)).view(np.int64)
                h = np.concatenate(each)
                out = np.empty((len(number), LANES), np.uint64)
                for k, seed in enumerate(seeds):
                    mixed = (h ^ np.uint64(seed)) * np.uint64(0xBF58476D1CE4E5B9)
                    out[:, k] = majority(mixed ^ (mixed >> np.uint64(31)), number)
                raw = out.astype("<u8").tobytes()
                fp = pa.array([raw[8 * LANES * k : 8 * LANES * (k + 1)] for k in range(len(number))], pa.binary())
                few = [x[: len(x) - int(np.ceil(similarity * len(x) - 1e-9)) + 1].tobytes() if 0 < len(x) <= FEW else b"" for x in each]
                columns = [part.column(0), part.column(1), pa.array(node), fp, pa.array(number), pa.array(few, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "text_key", "node", "fp", "size", "few"])

    rows = text_rows(docs, id_col, text_col).select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, text_key long, node long, fp binary, size long, few binary")


def shingle_sets(texts: DataFrame, shingle: int) -> DataFrame:
    """(node, shingles) for (node, text): the distinct hashes of the shingles in ascending order, in a binary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in byte_slices(batch, most=4 << 20):
                sets = [np.unique(hashes(x.encode().translate(_LOWER), shingle)).tobytes() for x in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sets, pa.binary())], names=["node", "shingles"])

    return texts.select("node", "text").mapInArrow(run, "node long, shingles binary")


def jaccard(x: np.ndarray, y: np.ndarray) -> float:
    """Of two ascending arrays of distinct hashes."""
    if not len(x) or not len(y):
        return float(len(x) == len(y))
    both = int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum())
    return both / (len(x) + len(y) - both)


def _differ(a: int, b: int, c: int) -> float:
    """Chance that a bit differs for sets of a and b shingles that share c."""
    over = lambda n, m: sum(comb(n, k) for k in range(max(m, 0), n + 1)) / 2**n  # noqa: E731  at least m of n hashes have the bit
    out = 0.0
    for x in range(c + 1):
        p, q = over(a - c, a // 2 + 1 - x), over(b - c, b // 2 + 1 - x)
        out += comb(c, x) / 2**c * (p * (1 - q) + q * (1 - p))
    return out


@functools.lru_cache(maxsize=8)
def worst_differ(similarity: float) -> np.ndarray:
    """By the size of the larger set (up to MANY, which stands for all above): the highest chance that a bit differs for a pair of this similarity or more."""
    limit = float(np.arccos(2 * similarity / (1 + similarity)) / np.pi)
    out = np.zeros(MANY + 1)
    for a in range(1, MANY + 1):
        for b in range(int(np.ceil(similarity * a - 1e-9)), a + 1):
            c = int(np.ceil(similarity * (a + b) / (1 + similarity) - 1e-9))
            if 0 < c <= b:
                out[a] = max(out[a], _differ(a, b, c))
    out[MANY] = max(out[MANY // 2 :].max(), limit)
    return out


def limits(similarity: float, bits: int) -> np.ndarray:
    """How many of so many bits may differ, by the size of the larger set."""
    p = worst_differ(similarity)
    return np.floor(bits * p + SLACK * np.sqrt(bits * p * (1 - p))).astype(np.int64)


class Parts(NamedTuple):
    """bits: places of each part's bits; thresholds: 0 or 1 differing bits."""

    bits: list[list[int]]
    thresholds: list[int]


def width_for(n: int) -> int:
    """Bits of a part: few unrelated ones of n texts shall meet in it."""
    return int(np.clip(np.ceil(np.log2(max(n, 2))) - 6, 10, 32))


def gain(width: int, threshold: int, differ: float) -> float:
    """Minus the logarithm of the chance that a pair doesn't meet in a part."""
    met = sum(comb(width, k) * differ**k * (1 - differ) ** (width - k) for k in range(threshold + 1))
    return -float(np.log1p(-met))


def cheapest(options: list[list[tuple[float, float]]], least: float, steps: int = 512) -> list[int]:
    """One option of (cost, gain) of each list, so that the gains reach `least` (in whole steps of it) at the lowest cost."""
    best = np.full(steps + 1, np.inf)
    best[0], chosen = 0.0, []
    for own in options:
        step, pick = np.full(steps + 1, np.inf), np.zeros(steps + 1, np.int64)
        for k, (cost, more) in enumerate(own):
            by = int(more / least * steps)
            to = np.minimum(np.arange(steps + 1) + by, steps)
            reached = np.full(steps + 1, np.inf)
            np.minimum.at(reached, to, best + cost)
            better = reached < step
            step[better], pick[better] = reached[better], k
        chosen.append((pick, best))
        best = step
    if not np.isfinite(best[steps]):
        raise ValueError("the options don't reach the least gain")
    out, at = [], steps
    for own, (pick, before) in zip(reversed(options), reversed(chosen)):
        k = int(pick[at])
        by = int(own[k][1] / least * steps)
        froms = np.flatnonzero(np.minimum(np.arange(steps + 1) + by, steps) == at)
        at = int(froms[np.argmin(before[froms])])
        out.append(k)
    return out[::-1]


def statistics(nodes: DataFrame, groups: np.ndarray) -> tuple[int, np.ndarray]:
    """Number of fingerprints, and for each group of 64 bits how many have both bits i and j."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((len(groups), 64, 64)), 0
        for batch in batches:
            for a in range(0, len(batch), 4096):
                bits = _bits(_matrix(batch.column(0).slice(a, 4096), LANES)).astype(np.float32)
                n += len(bits)
                for k, own in enumerate(groups):
                    x = bits[:, own]
                    total[k] += x.T @ x
        if n:
            flat = np.append(total.ravel(), n).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat))), pa.array(flat)], names=["at", "n"])

    out = np.zeros(len(groups) * 4096 + 1, np.int64)
    for r in nodes.select("fp").mapInArrow(run, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).collect():  # as many rows as groups have pairs of bits
        out[r["at"]] = r["n"]
    return int(out[-1]), out[:-1].reshape(-1, 64, 64)


def plan(nodes: DataFrame, n: int, similarity: float, run_rows: int = RUN_ROWS) -> tuple[Parts, DataFrame]:
    """Parts with their thresholds, and (key, c) of the part values and least shingles that more than run_rows fingerprints share."""
    differ = float(worst_differ(similarity)[FEW + 1 :].max())
    least = -float(np.log(1 - RECALL))
    m = max(2, round(64 / width_for(n)))
    number = int(np.ceil(1.3 * least / (m * gain(-(-64 // m), 0, differ))))  # groups of bits, with some parts to choose from
    rng, groups = np.random.default_rng(1), np.arange(WIDE).reshape(-1, 64)
    while len(groups) < number:
        groups = np.concatenate([groups, np.sort(rng.permutation(WIDE).reshape(-1, 64), axis=1)])
    groups = groups[:number]
    total, both = statistics(nodes, groups)
    bits, same = [], []
    for own, b in zip(groups, both):
        p = np.diag(b) / max(total, 1)
        for part in correlated_parts(total, b, m):
            bits.append([int(own[k]) for k in part])
            same.append((p * p + (1 - p) * (1 - p))[part])
    every = Parts(bits, [0] * len(bits))
    met = nodes.select("node", F.col("node").alias("root"), "fp", "size", "few").mapInArrow(_probe(every, range(len(bits)), True, False), "part int, key long")
    met = written(met.groupBy("part", "key").agg(F.count("*").alias("c")), "part-values")
    pairs = {r["part"]: r["pairs"] for r in met.groupBy("part").agg(F.sum(F.col("c").cast("double") * (F.col("c") - 1) / 2).alias("pairs")).collect()}  # a row a part
    options = []
    for k, own in enumerate(bits):
        found = max(pairs.get(k, 0.0), total * total / 2 * float(np.prod(same[k])))
        more = found * (1 + float(((1 - same[k]) / same[k]).sum()))
        options.append([(0.0, 0.0), (total + PAIR_COST * found, gain(len(own), 0, differ)), (total * (1 + len(own) / 2) + PAIR_COST * more, gain(len(own), 1, differ))])
    chosen = cheapest(options, least)
    kept = sorted((k for k, t in enumerate(chosen) if t), key=lambda k: (chosen[k], k))
    parts = Parts([bits[k] for k in kept], [chosen[k] - 1 for k in kept])
    hot = met.where(F.col("c") > run_rows).groupBy("key").agg(F.max("c").alias("c"))
    return parts, hot


def _bits(fp: np.ndarray) -> np.ndarray:
    return np.unpackbits(np.ascontiguousarray(fp, "<u8").view(np.uint8).reshape(len(fp), -1), axis=1, bitorder="little")


def _matrix(column: pa.Array, lanes: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<u8").reshape(-1, lanes)


def _part_value(bits: np.ndarray, own: list[int]) -> np.ndarray:
    return bits[:, own] @ (np.uint64(1) << np.arange(len(own), dtype=np.uint64))


def _key(value: np.ndarray, own: list[int]) -> np.ndarray:
    """Values of different parts are apart: a part goes by its bits."""
    from xxhash import xxh64_intdigest

    return ((value ^ np.uint64(xxh64_intdigest(np.array(own, "<i8").tobytes()))) * np.uint64(0x9E3779B97F4A7C15)).view(np.int64)


def _probe(parts: Parts, own: range, few: bool, whole: bool = True):
    """(part, key) of each fingerprint for some parts, and of the least shingles of short texts; whole: with the row itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, len(batch), 4096):
                rows = batch.slice(a, 4096)
                node, root, raw, size = rows.column(0), rows.column(1), rows.column(2).to_pylist(), rows.column(3)
                first = pa.array([x[: 8 * FIRST] for x in raw], pa.binary())
                bits = _bits(_matrix(rows.column(2), LANES))

                def out(part: int, key: np.ndarray, at: np.ndarray | None) -> pa.RecordBatch:
                    columns = [pa.array(np.full(len(key), part, np.int32)), pa.array(key)]
                    if not whole:
                        return pa.RecordBatch.from_arrays(columns, names=["part", "key"])
                    taken = [node, root, size, first] if at is None else [c.take(pa.array(at)) for c in (node, root, size, first)]
                    return pa.RecordBatch.from_arrays([*columns, *taken], names=["part", "key", "node", "root", "size", "first"])

                for k in own:
                    value = _part_value(bits, parts.bits[k])
                    yield out(k, _key(value, parts.bits[k]), None)
                    for b in range(len(parts.bits[k]) if parts.thresholds[k] else 0):  # values that differ in one bit meet with that bit cleared
                        at = np.flatnonzero(value >> np.uint64(b) & np.uint64(1))
                        yield out(k, _key(value[at] ^ np.uint64(1 << b), parts.bits[k]), at)
                if few:
                    least = rows.column(4).to_pylist()
                    yield out(-1, np.frombuffer(b"".join(least), "<i8"), np.repeat(np.arange(len(least)), [len(x) // 8 for x in least]))

    return run


def in_blocks(rows: DataFrame, blocks: DataFrame) -> DataFrame:
    """rows (with key, node and root) with columns run and block: a run of `blocks` (key, n) is dealt to pairs of its blocks.

    Rows of one root need no comparison. So those of the root that most of a run have are dealt to blocks of their own,
    and only meet the blocks of all others: N rows of which o have another root become about N + o * n rows, with
    n = N / (rows a block), in place of N * n. Other runs are left whole.
    """
    own = rows.join(blocks, "key").groupBy("key", "root").agg(F.count("*").alias("c"), F.first("n").alias("n"))
    own = own.groupBy("key").agg(F.max(F.struct("c", "root")).alias("top"), F.sum("c").alias("all"), F.first("n").alias("n"))
    share = F.col("top.c") / F.col("all")
    own = written(own.select("key", F.col("top.root").alias("main"), F.ceil(F.col("n") * share).cast("int").alias("mains"), F.ceil(F.col("n") * (1 - share)).cast("int").alias("others")), "runs-in-blocks")
    out = rows.join(own, "key", "left")
    deal, at_main = F.xxhash64("node"), F.col("root") == F.col("main")
    out = out.withColumn("block", F.when(F.col("main").isNull(), 0).when(at_main, F.pmod(deal, "mains")).otherwise(F.col("mains") + F.pmod(deal, "others")).cast("int"))
    last = F.col("mains") + F.col("others") - 1
    met = F.when(F.col("main").isNull(), F.array(F.lit(0))).when(~at_main, F.sequence(F.lit(0), last)).when(F.col("others") > 0, F.sequence("mains", last))
    out = out.withColumn("other", F.explode(met))
    run = F.when(F.col("main").isNull(), F.col("key")).otherwise(F.xxhash64("key", F.least("block", "other"), F.greatest("block", "other")))
    return out.withColumn("run", run).drop("main", "mains", "others", "other")


def apart(rows: DataFrame, blocks: DataFrame) -> DataFrame:
    """rows with columns run and block: each in one of the n blocks of its run by `blocks` (key, n), which meets no other."""
    n = F.coalesce("n", F.lit(1))
    return rows.join(blocks, "key", "left").withColumn("run", F.xxhash64("key", F.pmod(F.xxhash64("node"), n))).withColumn("block", F.lit(0)).drop("n")


def _runs(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[dict[str, np.ndarray | list]]:
    """Rows that come sorted by run, in slices that hold whole runs; the last run of a batch waits for the next one."""
    held = None
    for batch in itertools.chain(batches, [None]):
        if batch is not None:
            own = pa.Table.from_batches([batch])
            held = own if held is None else pa.concat_tables([held, own])
            if not len(held):
                continue
            key = held["run"].to_numpy()
            end = int(np.searchsorted(key, key[-1]))
        else:
            end = len(held) if held is not None else 0
        if end:
            yield {c: held[c].to_pylist() if pa.types.is_binary(held[c].type) else held[c].to_numpy() for c in names}, end
        held = held.slice(end) if held is not None else None


def _suspects(limit: np.ndarray):
    """Members of each run that have a candidate of another root: (part, key, node, root, size)."""
    names = ["run", "block", "part", "key", "node", "root", "size", "first"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, end in _runs(batches, names):
            run, block, part, key, node, root, size = (rows[c][:end] for c in names[:-1])
            first = np.frombuffer(b"".join(rows["first"][:end]), "<u8").reshape(-1, FIRST)
            at = np.flatnonzero(near_others(run, block, root, np.minimum(size, MANY), first, limit))
            yield pa.RecordBatch.from_arrays([pa.array(x[at]) for x in (part, key, node, root, size)], names=["part", "key", "node", "root", "size"])

    return run


def near_others(run: np.ndarray, block: np.ndarray, root: np.ndarray, size: np.ndarray, first: np.ndarray, limit: np.ndarray) -> np.ndarray:
    """Whether a row has another of its run, of another root, that differs in no more bits than the limit; of another block where a run has two."""
    n = len(run)
    order = np.lexsort((root, run))
    run, block, root, size, first = run[order], block[order], root[order], size[order], first[order]
    at = np.arange(n)
    opens = np.append(True, run[1:] != run[:-1])
    begin = np.maximum.accumulate(np.where(opens, at, 0))
    two = np.repeat(np.maximum.reduceat(block, np.flatnonzero(opens)) != np.minimum.reduceat(block, np.flatnonzero(opens)), np.diff(np.append(np.flatnonzero(opens), n)))
    own = np.maximum.accumulate(np.where(opens | np.append(True, root[1:] != root[:-1]), at, 0))  # those of the same root stand together
    out = np.zeros(n, bool)
    who = np.flatnonzero(own > begin)
    place = own[who] - 1
    while len(who):
        near = np.bitwise_count(first[who] ^ first[place]).sum(axis=1) <= limit[np.maximum(size[who], size[place])]
        near &= ~two[who] | (block[who] != block[place])
        out[who[near]] = out[place[near]] = True
        more = place > begin[who]
        who, place = who[more], place[more] - 1
    back = np.empty(n, bool)
    back[order] = out
    return back


def _verified(parts: Parts, similarity: float, limit: np.ndarray):
    """Links (u, v) that join groups of different roots within each run, by the sets of shingles themselves."""
    names = ["run", "block", "part", "node", "root", "size", "fp", "shingles"]
    exact = [k for k, t in enumerate(parts.thresholds) if t == 0]

    def links(block, part, node, root, size, fp, sets) -> Iterator[tuple[int, int]]:
        group = np.unique(root, return_inverse=True)[1]
        bits = _bits(fp)
        before = [k for k in exact if k < part]
        met = np.stack([_part_value(bits, parts.bits[k]) for k in before], axis=1) if before else np.zeros((len(node), 0), np.uint64)
        sets = [np.frombuffer(x, "<u8") for x in sets]
        two = len(np.unique(block)) > 1
        for u in range(len(node) - 1):
            rest = np.arange(u + 1, len(node))
            rest = rest[group[rest] != group[u]]
            if two:
                rest = rest[block[rest] != block[u]]
            far = np.bitwise_count(fp[rest] ^ fp[u]).sum(axis=1)
            ok = far <= limit[np.maximum(size[rest], size[u])]
            rest, far = rest[ok], far[ok]
            if len(before) and len(rest):  # they met in an earlier part, whose run has compared them
                new = ~(met[rest] == met[u]).any(axis=1)
                rest, far = rest[new], far[new]
            for v in rest[np.argsort(far, kind="stable")].tolist():
                if group[v] != group[u] and jaccard(sets[u], sets[v]) >= similarity - 1e-12:
                    group[group == group[v]] = group[u]
                    yield int(node[u]), int(node[v])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, end in _runs(batches, names):
            key, block, part, node, root, size = (rows[c][:end] for c in names[:6])
            size = np.minimum(size, MANY)
            cuts = [0, *(np.flatnonzero(key[1:] != key[:-1]) + 1).tolist(), end]
            out = []
            for a, b in zip(cuts, cuts[1:]):
                if b - a > 1:
                    out += links(block[a:b], int(part[a]), node[a:b], root[a:b], size[a:b], _matrix(pa.array(rows["fp"][a:b], pa.binary()), LANES), rows["shingles"][a:b])
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in out], pa.int64()), pa.array([x for _, x in out], pa.int64())], names=["u", "v"])

    return run


def similar_groups(docs: DataFrame, shingle: int = 5, similarity: float = 0.8, id_col: str = "doc_id", text_col: str = "text", run_rows: int = RUN_ROWS, run_bytes: int = RUN_BYTES) -> DataFrame:
    """(doc_id, text_key, component_id) for every row; texts link if the Jaccard index of their shingle sets is this similarity or more.

    A pair of this similarity is compared with a chance of RECALL, less one in 2,000 whose bits differ by more than
    SLACK deviations, whatever the number of texts; a more similar one with a higher chance, and one of equal sets
    always. component_id is the smallest doc_id reachable over links. Null and empty texts, and others without words,
    share the empty set and so one group. Null ids don't count as smallest; a group of null ids alone has a null id.
    Repeated rows share a group. An empty table gives an empty one.
    """
    rows = written(fingerprints(docs, shingle, similarity, id_col, text_col), "fingerprints")
    nodes = rows.groupBy("node").agg(F.min("doc_id").alias("least"), *(F.first(c).alias(c) for c in ("text_key", "fp", "size", "few")))
    nodes = written(nodes, "nodes")
    parts, hot = plan(nodes, nodes.count(), similarity, run_rows)
    first, whole = limits(similarity, 64 * FIRST), limits(similarity, WIDE)
    deal = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    crowded = written(hot.select("key", F.ceil(F.col("c") / run_rows).cast("int").alias("n")), "crowded") if not hot.isEmpty() else None

    def dealt(rows: DataFrame) -> DataFrame:
        return rows.repartition(deal, "run").sortWithinPartitions("run")

    def joined(rooted: DataFrame, own: range, few: bool, members: DataFrame | None = None) -> DataFrame:
        """The fingerprints with the roots that the links of these parts' runs give; members: of these in crowded runs, within blocks."""
        asking = rooted if members is None else members
        met = asking.select("node", "root", "fp", "size", "few").mapInArrow(_probe(parts, own, few), "part int, key long, node long, root long, size long, first binary")
        if members is not None:
            met = written(met.join(crowded.select("key"), "key"), "crowded-members")
            met = apart(met, met.groupBy("key").agg(F.ceil(F.count("*") / run_rows).alias("n")))
        else:
            met = in_blocks(met, crowded) if crowded is not None else met.withColumn("block", F.lit(0)).withColumn("run", F.col("key"))
        found = dealt(met).mapInArrow(_suspects(first), "part int, key long, node long, root long, size long")
        found = written(found.dropDuplicates(["key", "node"]) if crowded is not None else found, "suspects")
        asked = found.select("node").distinct()
        texts = text_rows(docs, id_col, text_col).select(F.xxhash64("text").alias("text_key"), "text")
        sets = written(shingle_sets(texts.join(nodes.select("node", "text_key").join(asked, "node"), "text_key").dropDuplicates(["node"]), shingle), "shingle-sets")
        blocks = F.ceil(F.greatest(F.sum(8 * F.col("size") + 256) / run_bytes, F.count("*") / run_rows))
        heavy = found.groupBy("key").agg(blocks.cast("int").alias("n")).where("n > 1")
        heavy = written(heavy, "heavy")  # a few keys, so that no exchange by key is needed
        runs = (in_blocks(found, heavy) if members is None else apart(found, heavy)).join(nodes.select("node", "fp").join(sets, "node"), "node")
        links = dealt(runs).mapInArrow(_verified(parts, similarity, whole), "u long, v long")
        edges = rooted.where("node <> root").select(F.col("node").alias("u"), F.col("root").alias("v")).unionByName(links)
        to = components(edges).select(F.col("node").alias("n"), F.col("root").alias("to"))
        return written(nodes.join(to, F.col("node") == F.col("n"), "left").select(*nodes.columns, F.coalesce("to", "node").alias("root")), "rooted")

    rooted, every = nodes.withColumn("root", F.col("node")), range(len(parts.bits))
    if crowded is not None:  # first the texts of a block, then one of each group, so that most of a crowded run have one root when its blocks meet
        rooted = joined(rooted, every, True, rooted)
        rooted = joined(rooted, every, True, rooted.where("node = root"))
    rooted = joined(rooted, range(min(FIRST_PARTS, len(parts.bits))), True)
    rooted = joined(rooted, range(min(FIRST_PARTS, len(parts.bits)), len(parts.bits)), False)
    ids = written(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "groups")
    member = rooted.select("node", "root").join(ids, "root").select("node", "component_id")
    return rows.select("doc_id", "text_key", "node").join(member, "node").select("doc_id", "text_key", "component_id")


def drop_similar(docs: DataFrame, shingle: int = 5, similarity: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with one document of each group of similar_groups(), the one of smallest id, all columns kept.

    Of rows that repeat an id, those that share the kept id stay, each text once.
    """
    groups = similar_groups(docs, shingle, similarity, id_col, text_col)
    return kept_rows(docs, groups.where(F.col("doc_id").eqNullSafe(F.col("component_id"))), id_col, text_col)
