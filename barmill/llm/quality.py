"""Quality classifier by Bradley-Terry pairwise ranking.

A document's score is linear in features of its whole text. Pairs of a preferred (label 1) and another (label 0)
document give the logistic loss on the difference of their features. The threshold is the quantile of the training
documents' scores at the share of them that is labelled poor; scores are shifted so that it comes to lie at a fixed value.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barmill.llm.common import byte_slices, kept_rows, string_bytes, string_offsets, text_rows, written

#: At most this many labelled rows are fitted on, chosen by a hash of their ids (a bound on the driver's memory: 4 MB).
MOST_LABELLED = 20_000
#: Pairs of each labelled row of the larger class.
PAIRS_EACH = 4
#: Where the threshold lies in the scores.
CUT = 0.3

FEATURES = (
    "log_words", "word_length", "upper", "digit", "mark", "symbol", "stop", "blank", "newline", "wide", "distinct", "line_distinct", "line_length", "symbol_end", "long_words", "top_word",
)

_UPPER, _DIGIT, _MARK, _SYMBOL, _STOP, _BLANK, _WIDE = range(7)
_CLASS = np.full(256, 7, np.int8)
_CLASS[65:91], _CLASS[48:58], _CLASS[128:] = _UPPER, _DIGIT, _WIDE
_CLASS[[ord(c) for c in ",;:'\"()-"]] = _MARK
_CLASS[[ord(c) for c in "#$%&*|@^~<>[]{}+=_\\/`"]] = _SYMBOL
_CLASS[[ord(c) for c in ".!?"]] = _STOP
_CLASS[[9, 10, 11, 12, 13, 32]] = _BLANK
_ENDS = frozenset(b"#$%&*|@^~<>=_!")


def features(column: pa.Array) -> np.ndarray:
    """A row of FEATURES for each text; an empty text has zeros."""
    offsets = string_offsets(column)
    data = bytes(string_bytes(column)[int(offsets[0]) : int(offsets[-1])])
    offsets = offsets - offsets[0]
    kind = _CLASS[np.frombuffer(data, np.uint8)]
    size = np.diff(offsets)
    out = np.zeros((len(size), len(FEATURES)))
    for k, c in enumerate((_UPPER, _DIGIT, _MARK, _SYMBOL, _STOP, _BLANK, _WIDE)):
        total = np.concatenate([[0], np.cumsum(kind == c)])
        out[:, (2, 3, 4, 5, 6, 7, 9)[k]] = (total[offsets[1:]] - total[offsets[:-1]]) / np.maximum(size, 1)
    cuts = offsets.tolist()
    for d, (a, b) in enumerate(zip(cuts, cuts[1:])):
        text = data[a:b]
        words = text.split()
        n = len(words)
        if not n:
            continue
        counts: dict[bytes, int] = {}
        for w in words:
            counts[w] = counts.get(w, 0) + 1
        lines = [x for x in text.split(b"\n") if x]
        lengths = list(map(len, words))
        out[d, [0, 1, 8, 10, 11, 12, 13, 14, 15]] = (
            np.log1p(n),
            sum(lengths) / n,
            (len(lines) - 1) / n,
            len(counts) / n,
            len(set(lines)) / max(1, len(lines)),
            np.log1p(n / max(1, len(lines))),
            sum(w[-1] in _ENDS for w in words) / n,
            sum(k > 20 for k in lengths) / n,
            max(counts.values()) / n,
        )
    return out


class Model(NamedTuple):
    mean: np.ndarray
    scale: np.ndarray
    weight: np.ndarray
    cut: float


def fit(x: np.ndarray, label: np.ndarray, ridge: float = 1.0, steps: int = 30, seed: int = 7) -> Model:
    """Newton steps on the pairwise logistic loss; without both labels every score is the cut."""
    d = x.shape[1] if x.ndim == 2 and len(x) else len(FEATURES)
    if not (np.any(label == 1) and np.any(label == 0)):
        return Model(np.zeros(d), np.ones(d), np.zeros(d), 0.0)
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    z = np.clip((x - mean) / scale, -8, 8)
    good, bad = np.flatnonzero(label == 1), np.flatnonzero(label == 0)
    rng = np.random.default_rng(seed)
    n = PAIRS_EACH * max(len(good), len(bad))
    diff = z[good[np.arange(n) % len(good)]] - z[rng.permutation(np.resize(bad, n))]
    w = np.zeros(d)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(diff @ w, -30, 30)))
        gradient = diff.T @ (1 - p) - ridge * w
        curvature = (diff * (p * (1 - p))[:, None]).T @ diff + ridge * np.eye(d)
        step = np.linalg.solve(curvature, gradient)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return Model(mean, scale, w, _cut(z @ w, label))


def _cut(score: np.ndarray, label: np.ndarray) -> float:
    """The quantile of the scores at the share of documents that are labelled poor."""
    return float(np.quantile(score, float((label == 0).mean()), method="midpoint"))


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.encode(F.coalesce(doc_id.cast("string"), F.lit("")), "utf-8")) % 5 == 0


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", most_labelled: int = MOST_LABELLED) -> DataFrame:
    """(doc_id, text_key, held_out, score, predicted) for every row; only labels of rows that aren't held out are learnt from.

    A null text counts as empty and is scored like any other; null labels are skipped, a document with several labels is
    learnt from with each. Without labels of both classes all scores are CUT. Only the text makes a score. Rows that
    repeat an id are scored one by one. An empty table gives an empty one; further columns are left out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in byte_slices(batch, most=8 << 20):
                x = features(part.column(2))
                flat = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), len(FEATURES)).cast(pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), flat], names=["doc_id", "text_key", "x"])

    rows = text_rows(docs, id_col, text_col).select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    table = written(rows.mapInArrow(run, f"doc_id {kind}, text_key long, x array<double>").withColumn("held_out", held_out(F.col("doc_id"))), "quality-features")
    known = labels.where(F.col(label_col).isin(0, 1)).select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("label"))
    train = table.where(~F.col("held_out")).join(known, "doc_id").orderBy(F.xxhash64("doc_id", "text_key", "label")).limit(most_labelled).select("x", "label").collect()
    model = fit(np.array([r.x for r in train]), np.array([r.label for r in train]))
    weight = model.weight / model.scale
    z = F.zip_with("x", F.array(*map(F.lit, model.mean.tolist())), lambda x, m: x - m)
    clipped = F.zip_with(z, F.array(*map(F.lit, (8 * model.scale).tolist())), lambda x, b: F.least(F.greatest(x, -b), b))
    raw = F.aggregate(F.zip_with(clipped, F.array(*map(F.lit, weight.tolist())), lambda x, w: x * w), F.lit(0.0), lambda n, x: n + x)
    scored = 1 / (1 + F.exp(-F.greatest(F.least(raw - model.cut, F.lit(30.0)), F.lit(-30.0))) * ((1 - CUT) / CUT))
    return table.select("doc_id", "text_key", "held_out", scored.alias("score")).withColumn("predicted", (F.col("score") >= CUT).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **params) -> DataFrame:
    """docs without the rows that score() predicts to be poor, all columns kept; repeated rows stay or go together."""
    return kept_rows(docs, score(docs, labels, id_col, text_col, **params).where("predicted = 1"), id_col, text_col, once=False)
