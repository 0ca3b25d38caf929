"""Filter audit, Merkle manifest and source mix against brute-force versions, on the smallest tables and on odd rows."""

import hashlib
import itertools
import re
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from barmill.llm import filter_audit, merkle, mixing
from barmill.llm.queries import QUERIES
from tests.comparison import DATA
from tests.llm.conftest import TEXTS
from tests.llm.test_operators import LOWER
from tests.llm.test_queries import rows_of

FIELDS = "doc_id, source, lang, n_chars, text"


@pytest.fixture(scope="module")
def odd(spark):
    """Texts of every kind with null, empty and repeated ids, sources and languages, long copies, and clashing columns."""
    long = "Déjà vu " * 40_000
    texts = [*TEXTS, (20, long), (21, long), (None, long), (22, long[:-1] + "!"), (23, "#" + "A b" * 50), (24, "#" + "A b" * 50)]
    rows = [(i, t, [None, "", "en"][k % 3], [None, "", "a", "é", "b"][k % 5], None if k % 4 == 0 else len(t or ""), 7, 1, 0.5) for k, (i, t) in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, key long, place long, target double").repartition(4).cache()


# --- 11: filter audit


def plain_audit(rows, labels):
    """rows: (doc_id, text, lang); labels: doc_id -> (good, toxic)."""
    own = lambda i: (i is not None, i or 0)  # noqa: E731  a null id is the smallest
    least = {}
    for i, t, _ in rows:
        least[t or ""] = min(least.get(t or "", own(i)), own(i))
    docs = defaultdict(list)
    for i, t, part in rows:
        t = t or ""
        w = re.findall("[^\x20\x09-\x0d]+", t)
        fails = {"A": len(w) < 100, "B": 100 * len(set(w)) < 80 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 10 * len(t), "D": bool(re.search("[#$%&*|]", t)), "E": own(i) > least[t]}
        docs[part or ""].append(({f for f in fails if fails[f]}, *labels.get(i, (False, False))))
    out, shapley = {}, Counter()
    for part, mine in docs.items():
        for order in itertools.permutations("ABCDE"):
            live = mine
            for k, f in enumerate(order):
                gone = [x for x in live if f in x[0]]
                redundant = sum(f in x[0] and bool(x[0] & set(order[:k])) for x in mine)
                live = [x for x in live if f not in x[0]]
                shapley[part, f] += len(gone)
                out[part, "".join(order), k + 1] = (len(live), len(gone), redundant, sum(x[0] == {f} for x in mine), sum(x[1] for x in gone), sum(x[2] for x in gone))
    return {(part, order, k): (*x, shapley[part, order[k - 1]]) for (part, order, k), x in out.items()}


def as_dict(df):
    return {(r["part"], r["filter_order"], r["step"]): tuple(r[c] for c in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")) for r in df.collect()}


def test_op11_query(spark):
    labels = {i: (q == 1, x == 1) for i, q, x in rows_of(DATA, "labels", "doc_id, quality, toxic")}
    assert as_dict(QUERIES["op11_filter_audit"](spark, DATA)) == plain_audit(rows_of(columns="doc_id, text, lang"), labels)


def test_audit_on_rows_of_any_kind(spark, odd):
    labels = spark.createDataFrame([(1, 1, 0), (20, 1, 1), (20, 0, 0), (None, 1, 1), (21, None, 1), (99, 1, 1)], "doc_id long, quality int, toxic int")
    rows = [(r["doc_id"], r["text"], r["lang"]) for r in odd.collect()]
    assert as_dict(filter_audit.audit(odd, labels)) == plain_audit(rows, {1: (True, False), 20: (True, True), 21: (False, True)})
    assert filter_audit.audit(odd.limit(0), labels).isEmpty()
    assert len(as_dict(filter_audit.audit(odd, labels.limit(0)))) == 2 * 600


def test_texts_that_differ_in_the_last_block_are_parted(spark):
    base = "word " * 60_000
    rows = spark.createDataFrame([(1, base), (2, base[:-2] + "x "), (3, base), (4, "w" + base[1:])], "doc_id long, text string").withColumn("lang", F.lit("en"))
    assert {r["doc_id"]: r["mask"] >> 4 for r in filter_audit.marked(rows).collect()} == {1: 0, 2: 0, 3: 1, 4: 1}


def test_blocks_are_hashed_one_by_one():
    a, b = b"x" * 5000, b"x" * 4000 + b"y" + b"x" * 999
    x, y = (filter_audit._blocks(memoryview(t)) for t in (a, b))
    assert len(x) == len(y) == 3 and x[:2] == y[:2] and x[2] != y[2]
    assert len(filter_audit._blocks(memoryview(b""))) == 1


# --- 12: Merkle manifest


def H(*x):
    return hashlib.sha256("".join(x).encode()).hexdigest()


def plain_leaf(*row):
    return H(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def plain_tree(nodes):
    """Root, and for each leaf what stands before and behind it in its runs."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for k, p in enumerate(at):
            run = nodes[p // 16 * 16 : p // 16 * 16 + 16]
            paths[k].append((run[: p % 16], run[p % 16 + 1 :]))
            at[k] = p // 16
        nodes = [H(*nodes[k : k + 16]) for k in range(0, len(nodes), 16)]
    return nodes[0], paths


def plain_manifest(rows):
    by = defaultdict(list)
    for r in rows:
        by[r[1]].append(r)
    names = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    own = {s: sorted(by[s], key=lambda r: (r[0] is not None, r[0] or 0, plain_leaf(*r))) for s in names}
    trees = {s: plain_tree([plain_leaf(*r) for r in own[s]]) for s in names}
    root, above = plain_tree([trees[s][0] for s in names])
    out = Counter()
    for s, top in zip(names, above):
        for (i, _, lang, n, t), path in zip(own[s], trees[s][1]):
            path = path + top
            now = t.translate(LOWER) if t is not None and i is not None and zlib.crc32(str(i).encode()) % 5 == 0 else t
            h = plain_leaf(i, s, lang, n, now)
            for a, b in path:
                h = H(*a, h, *b)
            out[i, plain_leaf(i, s, lang, n, t), trees[s][0], root, H(*(x for a, b in path for x in a + b)), h, h == root] += 1
    return out


def test_op12_query(spark):
    got = Counter(map(tuple, QUERIES["op12_merkle_manifest"](spark, DATA).collect()))
    assert got == plain_manifest(rows_of(columns=FIELDS)) and {x[-1] for x in got} == {True, False}


@pytest.mark.parametrize("n", [1, 17, 4113])
def test_trees_of_any_size(spark, n):
    rows = spark.range(n).select(F.col("id").alias("doc_id"), F.concat(F.lit("T"), F.col("id").cast("string")).alias("text"), F.lit("en").alias("lang"), F.when(F.col("id") > 0, "s").alias("source"), F.lit(1).cast("long").alias("n_chars"))
    proofs, store = merkle.manifest(rows)
    got = Counter(map(tuple, merkle.verified(proofs).collect()))
    assert got == plain_manifest([tuple(r) for r in rows.select("doc_id", "source", "lang", "n_chars", "text").collect()])
    levels = spark.read.parquet(f"{store}/rows").where("key = '=s'").groupBy("level").agg(F.count("*"), F.max(F.length("run"))).collect()
    assert all(size <= 16 * 64 for _, _, size in levels) and (n < 2 or {k: m for k, m, _ in levels}[0] == -(-(n - 1) // 16))


def test_manifest_on_rows_of_any_kind(spark, odd):
    proofs, _ = merkle.manifest(odd)
    assert Counter(map(tuple, merkle.verified(proofs).collect())) == plain_manifest([(r["doc_id"], r["source"], r["lang"], r["n_chars"], r["text"]) for r in odd.collect()])
    assert merkle.verified(merkle.manifest(odd.limit(0))[0]).isEmpty()


# --- 13: mixing


def plain_targets(sizes):
    """sizes in the order of the sources; what is above its bound stops there, the rest is shared anew."""
    weight = [(1, 2, 3)[k % 3] for k in range(len(sizes))]
    capped, total = set(), sum(sizes)
    while True:
        free = sum(w for k, w in enumerate(weight) if k not in capped)
        level = (total - sum(3 * sizes[k] for k in capped)) / free
        more = {k for k in range(len(sizes)) if k not in capped and level * weight[k] > 3 * sizes[k]}
        if not more:
            return [3 * sizes[k] if k in capped else level * weight[k] for k in range(len(sizes))]
        capped |= more


def plain_mix(rows, words):
    """(doc_id, size, source_size, target, taken) of (doc_id, text, source)."""
    size = lambda t: len(re.findall("[^\x20\x09-\x0d]+", t or ""))
    signed = lambda h: h - (1 << 64) if h >> 63 else h
    by = defaultdict(list)
    for i, t, s in rows:
        h = 42
        key = xxhash.xxh64_intdigest(t.encode(), 42) if t is not None else 42
        for part in (None if i is None else struct.pack("<q", i), struct.pack("<Q", key), struct.pack("<i", 0)):
            h = h if part is None else xxhash.xxh64_intdigest(part, h)
        by[s].append((signed(h), i is not None, i or 0, signed(key), size(t), i))
    names = sorted(by, key=lambda s: (s is None, (s or "").encode()))
    sizes = [sum(x[4] for x in by[s]) for s in names]
    target = plain_targets(sizes)
    ends = np.round(np.cumsum([round(x * 1024) for x in target]) / sum(round(x * 1024) for x in target) * 2**32).astype(int)
    slots = Counter()
    for k in range(-(-sum(sizes) // words)):
        slots[int(np.searchsorted(ends, k * 1640531527 % 2**32, "right"))] += 1
    out = Counter()
    for no, s in enumerate(names):
        blocks, at = max(1, -(-sizes[no] // words)), 0
        uses = Counter(r % blocks for r in range(min(slots[no], 3 * blocks)))
        for *_, n, i in sorted(by[s]):
            out[i, n, sizes[no], round(target[no], 6), sum(uses[w // words] for w in range(at, at + n))] += 1
            at += n
    return out


def mixed(rows, plan):
    return Counter((r["doc_id"], r["size"], r["source_size"], round(r["target"], 6), r["taken"]) for r in mixing.taken(rows, plan).collect())


def test_op13_query(spark):
    got = QUERIES["op13_source_mix"](spark, DATA)
    rows = Counter((r["doc_id"], r["size"], r["source_size"], round(r["target"], 6), r["taken"]) for r in got.collect())
    assert rows == plain_mix(rows_of(columns="doc_id, text, source"), 1)
    assert got.where("taken > 3 * size").isEmpty()
    near = got.groupBy("source_size", "target").agg((F.abs(F.sum("taken") - F.col("target")) / F.col("target")).alias("off"))
    assert near.agg(F.max("off")).first()[0] < 0.01


@pytest.mark.parametrize("words", [1, 7])
def test_mix_on_rows_of_any_kind(spark, odd, words):
    rows, plan = mixing.mix(odd, block_words=words)
    assert mixed(rows, plan) == plain_mix([(r["doc_id"], r["text"], r["source"]) for r in odd.collect()], words)
    assert plan.groupBy("slot").agg(F.sum("words").alias("n")).where(f"n > {words}").isEmpty()
    rows, plan = mixing.mix(odd.limit(0))
    assert rows.isEmpty() and plan.isEmpty()
    rows, plan = mixing.mix(odd.where("text is null"))
    assert rows.count() == 1 and mixing.taken(rows, plan).first()["taken"] == 0


def test_targets_stop_at_three_passes(spark):
    sizes = [1000, 1, 5000, 0, 20, 3]
    sources = spark.createDataFrame([(str(k), n) for k, n in enumerate(sizes)], "key string, size long")
    got = [r["target"] for r in mixing.targets(sources).orderBy("no").collect()]
    assert got == pytest.approx(plain_targets(sizes)) and sum(got) == pytest.approx(sum(sizes))


def test_every_stretch_of_the_mix_is_near_the_targets(spark):
    sources = spark.createDataFrame([(0, 10.0), (1, 20.0), (2, 70.0)], "no long, target double")
    slots = mixing.schedule(sources, 20_000).toPandas().sort_values("slot")
    assert slots["slot"].tolist() == list(range(20_000))
    for _, own in slots.groupby("no"):
        assert own["rank"].tolist() == list(range(len(own)))
    for a in range(0, 20_000, 500):
        share = slots["no"].iloc[a : a + 500].value_counts(normalize=True)
        assert all(abs(share[k] - s) < 0.01 for k, s in enumerate((0.1, 0.2, 0.7)))


def test_mixing_runs_no_python(spark, odd):
    rows, plan = mixing.mix(odd)
    text = mixing.taken(rows, plan)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", text)
