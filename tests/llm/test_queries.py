"""Registered queries on the smallest tables: against SQL where there is some, and the pipeline stage by stage."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from barmill.llm import pii
from barmill.llm.queries import ORACLES, QUERIES
from tests.comparison import DATA, duck, same
from tests.llm import test_operators as T
from tests.llm.conftest import TEXTS
from tests.llm.test_operators import plain_contamination, plain_groups

SMALL = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, name):
    same(spark, QUERIES[name], ORACLES[name])


def test_pipeline_stages(spark):
    columns = spark.read.parquet(f"{DATA}/documents.parquet").columns
    items = duck().execute("select item_id, text from benchmark").fetchall()
    poor = {i for (i,) in duck().execute("select doc_id from labels where quality = 0").fetchall()}
    docs = spark.read.parquet(f"{DATA}/documents.parquet").cache()
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stage(spark, docs, DATA).cache()
        kept = {r["doc_id"]: r["text"] for r in docs.collect()}
        assert docs.count() == len(kept) and all(rows[i] == t for i, t in kept.items())
        if k < 4:
            assert docs.columns == columns
        if k == 0:
            assert len(set(kept) & poor) <= 0.25 * len(poor) and len(kept) > 0.7 * len(rows)  # nine poor ones to learn from here
        if k == 1:
            assert set(kept) == {i for i, _ in plain_groups(rows.items()).values()}
        if k == 2:
            shingles = {i: _shingles(t) for i, t in kept.items()}
            ids = sorted(kept)
            assert not any(_jaccard(shingles[a], shingles[b]) >= 0.85 for x, a in enumerate(ids) for b in ids[:x])
            gone = [_shingles(rows[i]) for i in rows if i not in kept]
            every = {i: _shingles(t) for i, t in rows.items()}
            assert all(max(_jaccard(g, s) for s in every.values() if s is not g and s != g) >= 0.6 for g in gone)
        if k == 3:
            assert set(kept) == {i for i, _, hit, _ in plain_contamination(rows.items(), items) if not hit}
        rows = kept


def _shingles(t):
    w = t.lower().split()
    return frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4)))


def _jaccard(a, b):
    return len(a & b) / len(a | b)


def rows_of(data=DATA, table="documents", columns="doc_id, coalesce(text, '')"):
    return duck(data).execute(f"select {columns} from {table}").fetchall()


def sha(x):
    return hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()


@pytest.fixture(scope="module")
def ids(tokenizer):
    lib = T.library(tokenizer)
    return {i: np.array(lib.encode(t, add_special_tokens=False).ids, "<u4") for i, t in rows_of()}


def test_op1_query(spark, ids):
    got = {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in QUERIES["op1_bpe_round_trip"](spark, DATA).collect()}
    assert got == {i: (len(ids[i]), sha(ids[i].tobytes()), sha(t)) for i, t in rows_of()}


def test_op2_query(spark, ids):
    got = {tuple(r) for r in QUERIES["op2_token_counts"](spark, DATA).select("doc_id", "n_bytes", "n_tokens", "over_limit").collect()}
    assert got == {(i, len(t.encode()), len(ids[i]), len(ids[i]) > 512) for i, t in rows_of()}


def test_op5_query(spark, ids):
    got = {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"]) for r in QUERIES["op5_token_shards"](spark, DATA).collect()}
    want, at = {}, 0
    for i, _ in sorted(rows_of()):
        own = np.append(ids[i], 0).astype("<u4")
        want[i], at = (at, len(own), zlib.crc32(own.tobytes())), at + len(own)
    assert got == want


# --- op 3: candidates, features and labels once more in plain Python

_DIGIT = lambda v: re.sub("[^0-9]", "", v)


def plain_candidates(t):
    out = []
    for kind, (may, pattern) in pii._WIDER.items():
        found = list(re.finditer(pattern, t, re.A)) if re.search(may, t, re.A) else []
        for k, m in enumerate(found):
            gap = t[found[k - 1].end() if k else 0 : m.start()]
            after = t[m.end() : found[k + 1].start() if k + 1 < len(found) else None][:1]
            out.append((kind, m.start(), m.end(), m[0], gap[-24:], after))
    return out


def plain_checked(kind, v):
    return {"card": lambda: T.luhn(_DIGIT(v)), "ip": lambda: all(int(x) <= 255 for x in v.split(".")), "email": lambda: bool(re.search("[A-Za-z]{2,}$", v)), "phone": lambda: True}[kind]()


def side(c):
    return 0 if c == "" else 1 if re.search("[0-9]", c) else 2 if re.search("[A-Za-z\u00c0-\u024f]", c) else 3 if re.search(r"\s", c, re.A) else 4 if re.search("[.,;:!?)]", c) else 5


def plain_features(kind, v, near, after):
    n = len(_DIGIT(v))
    digits = 0 if n == 0 else 1 if n < 7 else 2 if n < 9 else 3 if n < 11 else 4 if n < 13 else 6 if n == 16 else 5 if n <= 19 else 7
    shape = 1 if "@" in v else 2 if re.search(r"[(\[]", v) else 3 if "." in v else 4 if "-" in v else 5 if " " in v else 0
    return digits, shape, int(bool(re.search("[0-9]", near))), int(bool(re.search(pii._WORDS[kind], near, re.A))), side(near[-1:]), side(after)


def test_op3_query(spark):
    docs = rows_of(SMALL)
    counts, each = Counter(), {}
    for i, t in docs:
        base = [(k, int(a), int(b)) for k, a, b in (x.split(":") for x in T.plain_pii(t) or [])]
        each[i] = base, [c for c in plain_candidates(t) if plain_checked(c[0], c[3])]
        h = xxhash.xxh64_intdigest(t.encode(), 42)
        fold = (h - 2**64 if h >= 2**63 else h) % pii.FOLDS
        for kind, a, b, v, near, after in each[i][1]:
            on = any(k == kind and x < b and a < y for k, x, y in base)
            other = bool(re.search(pii._OTHER[kind], near, re.A))
            own = plain_features(kind, v, near, after)
            if on or other:
                counts[kind, *own, fold, not other] += 1
            if on and not other and kind in ("email", "phone"):
                twin = (own[0], 2, *own[2:]) if kind == "email" else (*own[:4], side(near.removesuffix("+")[-1:]), own[5])
                counts[kind, *twin, fold, True] += 1
    rows = Counter()
    for (*key, on), n in counts.items():
        rows[tuple(key)] += n
    model = pii.fit(sorted((*key, n, counts[*key, True]) for key, n in rows.items()))
    want = {}
    for i, t in docs:
        base, found = each[i]
        added = [(k, a, b) for k, a, b, v, near, after in found if not re.search(pii._OTHER[k], near, re.A) and not any(x < b and a < y for _, x, y in base) and sum(pii._value(tree, plain_features(k, v, near, after)) for tree in model.trees[k]) >= model.thresholds[k] - 1e-9]
        text = lambda spans: ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        number = Counter(k for k, _, _ in base)
        want[i] = (*(number[k] for k in pii.KINDS), sha(text(base)), text(sorted(base + added, key=lambda x: (pii.KINDS.index(x[0]), x[1]))), len(added))
    got = {r["doc_id"]: tuple(r[c] for c in ("n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans")) for r in QUERIES["op3_pii"](spark, SMALL).collect()}
    assert got == {i: x[:-1] for i, x in want.items()}
    assert sum(x[-1] for x in want.values()) > 0


def test_op4_query(spark):
    docs = rows_of(SMALL, columns="doc_id, coalesce(text, ''), source, lang")
    mixed = re.compile("(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}")
    kinds = ("assign", "access", "hex")
    spans, carriers = {}, {}
    for i, t, source, lang in docs:
        base = [(m.start(), 0, m.end(), m[2]) for m in T.ASSIGN.finditer(t) if len(m[2]) >= 6]
        base += [(m.start(), 1, m.end(), m[0]) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
        base += [(m.start(), 2, m.end(), m[0]) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24]
        more = [(m.start(), 3, m.end(), m[0]) for m in mixed.finditer(t)]
        more = [x for x in more if all(re.search(c, x[3]) for c in ("[a-z]", "[A-Z]", "[0-9]")) and len(set(x[3])) >= 12 and not any(a < x[2] and x[0] < b for a, _, b, _ in base)]
        spans[i] = sorted(base), more
        for x in base + more:
            carriers.setdefault(x[3], []).append((source, f"{source}/{lang}"))
    owners = {v: len({o for o, _ in x}) for v, x in carriers.items()}
    repos = {v: len({r for _, r in x}) for v, x in carriers.items()}
    live, example = {v for v in owners if owners[v] <= 1 and repos[v] <= 2}, {v for v in owners if owners[v] >= 3 or repos[v] >= 4}
    want = {}
    for i, (base, more) in spans.items():
        added = [x for x in more if x[3] in live]
        own = {x[3] for x in base + more}
        text = lambda s: ",".join(f"{(*kinds, 'mixed')[k]}:{a}:{b}" for a, k, b, _ in s)
        want[i] = (*(sum(x[1] == k for x in base) for k in range(3)), sha(text(base)), text(sorted(base + added)), len(own & live), len(own & example))
    got = {r["doc_id"]: tuple(r[c] for c in ("n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_live", "n_example")) for r in QUERIES["op4_secrets"](spark, SMALL).collect()}
    assert got == want


def test_op6_query(spark):
    got = {r["doc_id"]: r for r in QUERIES["op6_quality"](spark, SMALL).collect()}
    assert set(got) == {i for i, _ in rows_of(SMALL)}
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for i, r in got.items())
    held = [(got[i]["score"], q) for i, q in rows_of(SMALL, "labels", "doc_id, quality") if got[i]["held_out"] and q is not None]
    good, poor = [s for s, q in held if q], [s for s, q in held if not q]
    assert np.mean([a > b for a in good for b in poor]) > 0.95


def test_op8_query(spark):
    texts = {i: re.findall("[^\x20\x09-\x0d]+", t.translate(T.LOWER)) + [None] for i, t in rows_of()}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in texts}
    c = Counter(x for i, own in texts.items() if not held[i] for x in own)
    n, v = sum(c.values()), len(c)
    got = QUERIES["op8_lm_scoring"](spark, DATA).collect()
    want = {i: (held[i], len(own), sum(c[x] > 0 for x in own), n) for i, own in texts.items()}
    assert {r["doc_id"]: (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) for r in got} == want
    base = {i: sum(np.log10((c[x] + 1) / (n + v + 1)) for x in own) for i, own in texts.items()}
    assert all(abs(r["base_score"] - base[r["doc_id"]]) < 1e-6 * max(1, abs(base[r["doc_id"]])) and np.isfinite(r["score"]) and r["score"] < 0 for r in got)


def test_op10_query(spark):
    docs = rows_of()
    fps = [T.plain_fingerprint(t) for _, t in docs]
    part = T.plain_components(fps, 2)
    least = {p: min(i for (i, _), q in zip(docs, part) if q == p) for p in set(part)}
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in QUERIES["op10_simhash"](spark, DATA).collect()}
    assert got == {i: (f"{f:016x}", least[p]) for (i, _), f, p in zip(docs, fps, part)}


def test_pipeline_on_rows_of_any_kind(spark, docs, tmp_path):
    """Nulls, repeats, clashing columns, and an empty table go through all stages."""
    spark.createDataFrame([(1, 1, 0), (2, 1, 0), (5, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, "another text of the same id")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    own = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        before = own
        own = stage(spark, own, str(tmp_path)).cache()
        if k < 4:
            assert own.columns == docs.columns and own.subtract(before).isEmpty()
        if k == 1:
            assert own.groupBy(F.lower(F.coalesce("text", F.lit("")))).count().where("count > 1").isEmpty()
        if k == 2:
            assert sorted(r["doc_id"] for r in own.where("text like '%jumps%'").collect()) == [2]
        if k == 3:
            assert own.where("text = 'another text of the same id'").isEmpty()
    assert {len(r["ids"]) // 4 == r["n_tokens"] for r in own.collect()} == {True}
    docs.limit(0).write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
    assert len(TEXTS) == docs.count()
