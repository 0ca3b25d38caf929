"""Personal data by candidate gradient boosting, in native column expressions throughout.

Base detectors give the spans that the stated patterns match. High-recall generators propose further, overlapping
candidates (groups of digits inside a longer run, numbers without a country code, obscured addresses). A candidate that
fails its kind's check (check sum, octets, letters at the domain's end) or follows a word that names something else
(order, version) can't be added, and neither condition is a feature. The others have a few small-valued features of
their format and context, and what decides a base match as such (the plus sign, the run's whole extent) is no feature.

Labels don't follow from the features. Positive: candidates on a base span of their kind, and twins planted in the same
context, which are what the writer could have put there in another form (an address with its @ spelled out, a phone
number without its plus sign). Negative: candidates behind a word that names something else. All others, which are what
could be added, have no label and teach nothing. Labelled candidates of the whole corpus are counted by feature vector
and by one of FOLDS parts of the texts; the number of vectors is bounded by the features' values, whatever the corpus.
Boosted trees are fitted on these counts. Each fold is scored by trees that haven't seen it, and for each kind the
lowest score at which these held-out candidates reach the wanted precision is the threshold. Candidates that reach it
and lie on no base span are added; a kind without positive labels adds none.
"""

from __future__ import annotations

import functools
import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barmill.llm import spans as S
from barmill.llm.common import text_rows, written

KINDS = ("email", "ip", "card", "phone")

# The base patterns, written so that no match can start inside a run that an earlier start has tried
# and no repeated group recurses. The texts are first rewritten, one code point for one, where the comments say so.
#: A dot that no label follows is rewritten to %, which may stand before the @ but not behind it.
_DOT, _EMAIL = r"\.(?![A-Za-z0-9-])", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++\.[A-Za-z0-9.-]++"
_IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
_OCTETS = r"^0*(25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})(\.0*(25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})){3}$"
#: What isn't a digit, or a blank or hyphen between two digits, is rewritten to _.
_NO_CARD, _LOOSE, _CARD = "[^0-9 -]", "[ -](?![0-9])|(?<![0-9])[ -]", "[0-9][0-9 -]++"
_PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
#: Cheap tests that a text has no match of a kind.
_MAY = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": "[0-9](?:[ -]?[0-9]){12}", "phone": r"\+[0-9]"}

# Generators of candidates beyond the base patterns; possessive, so that runs of any length take one pass and no recursion.
_WIDER = {
    "email": (r"(?i)@|\bat\b", r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++(?: ?[(\[] ?(?i:at) ?[)\]] ?|@)[A-Za-z0-9-]++(?:(?: ?[(\[] ?(?i:dot) ?[)\]] ?|\.)[A-Za-z0-9-]++)++"),
    "ip": (_MAY["ip"], r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9.])"),
    "card": (_MAY["card"], r"(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{4})(?![0-9])"),
    "phone": (r"[0-9]{3}[ .-][0-9]{4}", r"(?<![0-9])(?:[0-9]{1,3}[ .-])?(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9])"),
}
_WORDS = {
    "email": r"(?i)(mail|contact|write|kontakt|correo|courriel)\W*$",
    "ip": r"(?i)(ip|host|server|address|addr|adresse)\W*$",
    "card": r"(?i)(card|visa|credit|pay|karte|carte|tarjeta)\W*$",
    "phone": r"(?i)(tel|phone|call|mobile|fax|telefon|tél)\W*$",
}

#: Words that name another kind of number.
_OTHER = {
    "email": r"(?i)(version|package|module|commit|branch|install)\W*$",
    "ip": r"(?i)(version|release|section|chapter|\bv)\W*$",
    "card": r"(?i)(order|isbn|serial|tracking|invoice|part)\W*$",
    "phone": r"(?i)(order|isbn|serial|tracking|invoice|part)\W*$",
}

FEATURES = ("digits", "shape", "crowd", "word", "before", "after")
#: Parts of the texts; each is scored by trees that haven't seen it to set the thresholds.
FOLDS = 5
#: Each feature has fewer values than this.
MOST_VALUES = 8


def base_spans(text: Column) -> Column:
    """All base spans of a text, by kind as listed, then start."""
    return F.concat(*(F.when(text.rlike(_MAY[k]), _BASE[k](text)).otherwise(S.none()) for k in KINDS))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the check sum: from the right, every other digit is doubled and its digits added."""
    figures = F.transform(F.split(F.reverse(digits), ""), lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(F.element_at(F.array(*map(F.lit, (0, 2, 4, 6, 8, 1, 3, 5, 7, 9))), c.cast("int") + 1)))
    return F.aggregate(figures, F.lit(0), lambda n, x: n + x) % 10 == 0


def _base_email(text: Column) -> Column:
    return S.located("email", F.regexp_replace(text, _DOT, "%"), _EMAIL)


def _base_ip(text: Column) -> Column:
    return F.filter(S.located("ip", text, _IP), lambda x: x["value"].rlike(_OCTETS))


def _base_card(text: Column) -> Column:
    runs = F.regexp_replace(F.regexp_replace(text, _NO_CARD, "_"), _LOOSE, "_")
    return F.filter(S.located("card", runs, _CARD), lambda x: F.when(F.length(_digits(x["value"])).between(13, 19), luhn(_digits(x["value"]))).otherwise(False))


def _base_phone(text: Column) -> Column:
    return F.filter(S.located("phone", text, _PHONE), lambda x: F.length(_digits(x["value"])).between(9, 15))


_BASE = {"email": _base_email, "ip": _base_ip, "card": _base_card, "phone": _base_phone}


def candidates(text: Column) -> Column:
    """Candidates of all kinds, those of one kind without overlap among themselves but with the base spans."""
    return F.concat(*(F.when(text.rlike(may), S.located(k, text, pattern)).otherwise(S.none()) for k, (may, pattern) in _WIDER.items()))


def _by_kind(kind: Column, values: dict[str, Column]) -> Column:
    out = F.lit(None)
    for k, value in values.items():
        out = F.when(kind == k, value).otherwise(out)
    return out


def _checked(x: Column) -> Column:
    """Whether a candidate passes its kind's check; phones have none."""
    value = x["value"]
    return _by_kind(x["kind"], {"card": luhn(_digits(value)), "ip": value.rlike(_OCTETS), "email": value.rlike(r"[A-Za-z]{2,}$"), "phone": F.lit(True)})


def _named_otherwise(x: Column) -> Column:
    return _by_kind(x["kind"], {k: x["near"].rlike(p) for k, p in _OTHER.items()})


def _on_base(x: Column, base: str = "base") -> Column:
    return F.exists(base, lambda b: (b["kind"] == x["kind"]) & (b["start"] < x["end"]) & (x["start"] < b["end"]))


def _side(c: Column) -> Column:
    return F.when(c == "", 0).when(c.rlike("[0-9]"), 1).when(c.rlike(r"[A-Za-z\x{C0}-\x{24F}]"), 2).when(c.rlike(r"\s"), 3).when(c.rlike("[.,;:!?)]"), 4).otherwise(5)


def _features(x: Column) -> dict[str, Column]:
    """Small integers that describe a candidate; each is below MOST_VALUES."""
    value, kind, near = x["value"], x["kind"], x["near"]
    digits = _digits(value)
    n = F.length(digits)
    word = _by_kind(kind, {k: near.rlike(pattern) for k, pattern in _WORDS.items()})
    return {
        "digits": F.when(n == 0, 0).when(n < 7, 1).when(n < 9, 2).when(n < 11, 3).when(n < 13, 4).when(n == 16, 6).when(n <= 19, 5).otherwise(7),
        "shape": F.when(value.contains("@"), 1).when(value.rlike(r"[(\[]"), 2).when(value.contains("."), 3).when(value.contains("-"), 4).when(value.contains(" "), 5).otherwise(0),
        "crowd": near.rlike("[0-9]").cast("int"),
        "word": word.cast("int"),
        "before": _side(F.right(near, F.lit(1))),
        "after": _side(x["after"]),
    }


def _twin(x: Column) -> dict[str, Column]:
    """Features of the span that could stand in place of one on a base span: an obscured address, a phone number without plus."""
    own, is_email = _features(x), x["kind"] == "email"
    bare = F.regexp_replace(x["near"], r"\+$", "")
    return {**own, "shape": F.when(is_email, 2).otherwise(own["shape"]), "before": F.when(is_email, own["before"]).otherwise(_side(F.right(bare, F.lit(1))))}


class Model(NamedTuple):
    """trees: nested (feature, value, left, right) or leaf values, taken left where feature == value; thresholds by kind."""

    trees: dict[str, list]
    thresholds: dict[str, float]


def fit(counts: list[tuple], rounds: int = 12, depth: int = 2, rate: float = 0.5, precision: float = 0.98) -> Model:
    """counts: (kind, *feature values, fold, candidates, positives), at most one for each feature vector and fold."""
    trees, thresholds = {}, {}
    for kind in KINDS:
        rows = [(r[1:-3], r[-3], float(r[-2]), float(r[-1])) for r in counts if r[0] == kind]
        trees[kind] = _boosted([(x, n, y) for x, _, n, y in rows], rounds, depth, rate)
        scored: dict[float, list[float]] = {}
        for fold in sorted({f for _, f, _, _ in rows}):
            rest = [(x, n, y) for x, f, n, y in rows if f != fold]
            unseen = _boosted(rest, rounds, depth, rate)
            for x, f, n, y in rows if rest else []:
                if f == fold:
                    own = scored.setdefault(round(sum(_value(t, x) for t in unseen), 9), [0.0, 0.0])
                    own[0] += n
                    own[1] += y
        best, n, y = math.inf, 0.0, 0.0
        for s in sorted(scored, reverse=True):
            n, y = n + scored[s][0], y + scored[s][1]
            if y >= precision * n:
                best = s
        thresholds[kind] = best
    return Model(trees, thresholds)


def _boosted(rows: list[tuple], rounds: int, depth: int, rate: float) -> list:
    """Trees for (feature values, candidates, positives) by Newton steps on the logistic loss."""
    trees, scores = [], [0.0] * len(rows)
    for _ in range(rounds if rows else 0):
        p = [1 / (1 + math.exp(-s)) for s in scores]
        gradient = [y - n * q for (_, n, y), q in zip(rows, p)]
        curvature = [n * q * (1 - q) for (_, n, _), q in zip(rows, p)]
        trees.append(_grow(rows, gradient, curvature, list(range(len(rows))), depth, rate))
        scores = [s + _value(trees[-1], x) for s, (x, _, _) in zip(scores, rows)]
    return trees


def _grow(rows: list, g: list[float], h: list[float], at: list[int], depth: int, rate: float):
    gain = lambda own: (sum(g[k] for k in own) ** 2) / (sum(h[k] for k in own) + 1)
    best = (1e-9, None, None, None)
    if depth:
        whole = gain(at)
        for f in range(len(FEATURES)):
            for v in sorted({rows[k][0][f] for k in at}):
                left, right = [k for k in at if rows[k][0][f] == v], [k for k in at if rows[k][0][f] != v]
                if left and right and (more := gain(left) + gain(right) - whole) > best[0]:
                    best = (more, (f, v), left, right)
    if best[1] is None:
        return rate * sum(g[k] for k in at) / (sum(h[k] for k in at) + 1)
    return (*best[1], _grow(rows, g, h, best[2], depth - 1, rate), _grow(rows, g, h, best[3], depth - 1, rate))


def _value(tree, x: tuple) -> float:
    while isinstance(tree, tuple):
        tree = tree[2] if x[tree[0]] == tree[1] else tree[3]
    return tree


def _expression(tree, x: dict[str, Column]) -> Column:
    if not isinstance(tree, tuple):
        return F.lit(float(tree))
    return F.when(x[FEATURES[tree[0]]] == tree[1], _expression(tree[2], x)).otherwise(_expression(tree[3], x))


def _scorer(trees: list):
    return lambda x: functools.reduce(lambda a, t: a + _expression(t, {k: x[k] for k in FEATURES}), trees, F.lit(0.0))


def _is(kind: str):
    return lambda x: x["kind"] == kind


def _staged(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, text, base, wider, fold); wider: the candidates that could be added or teach. Copies of a text share a fold."""
    rows = text_rows(docs, id_col, text_col)
    may = F.col("text").rlike(r"[0-9@]|(?i:\bat\b)")
    rows = rows.withColumn("base", F.when(may, base_spans(F.col("text"))).otherwise(S.none()))
    rows = rows.withColumn("wider", F.when(may, F.filter(candidates(F.col("text")), _checked)).otherwise(S.none()))
    return rows.withColumn("fold", F.pmod(F.xxhash64("text"), F.lit(FOLDS)).cast("int"))


def _train(staged: DataFrame, **params) -> Model:
    def described(features, label):
        return lambda x: F.struct(x["kind"].alias("kind"), *(v.cast("int").alias(k) for k, v in features(x).items()), label(x).cast("long").alias("label"))

    label = lambda x: F.when(_named_otherwise(x), 0).when(_on_base(x), 1)
    twins = F.filter("wider", lambda x: x["kind"].isin("email", "phone") & _on_base(x) & ~_named_otherwise(x))
    labelled = F.concat(F.transform("wider", described(_features, label)), F.transform(twins, described(_twin, lambda x: F.lit(1))))
    each = staged.where("size(wider) > 0").select("fold", F.explode(labelled).alias("x")).select("fold", "x.*").where("label is not null")
    counts = each.groupBy("kind", *FEATURES, "fold").agg(F.count("*").alias("n"), F.sum("label").alias("positive"))
    return fit([tuple(r) for r in counts.orderBy("kind", *FEATURES, "fold").collect()], **params)  # at most 4 * FOLDS * MOST_VALUES ** 6 rows, by the features' values


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **params) -> Model:
    """Counts the feature vectors of all labelled candidates, and fits on them. Null and empty texts and an empty table teach nothing."""
    return _train(_staged(docs, id_col, text_col), **params)


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: Model | None = None) -> DataFrame:
    """(doc_id, text, base, added) for every row: arrays of spans by kind as listed, then start; added ones lie on no base span.

    Without a model one is fitted on docs, whose spans are then written once, for training and scoring. A null text counts as empty and has no spans; without candidates nothing is
    added. Rows are treated one by one, also repeated ones; further columns are left out. An empty table gives an empty one.
    """
    scored = _staged(docs, id_col, text_col)
    if model is None:
        scored = written(scored, "pii-spans")
        model = _train(scored)
    alone = F.filter("wider", lambda x: ~S.overlaps(x, F.col("base")) & ~_named_otherwise(x))

    def accepted(x: Column) -> Column:
        out = F.lit(False)
        for kind, trees in model.trees.items():
            if trees and model.thresholds[kind] < math.inf:
                out = F.when(x["kind"] == kind, _scorer(trees)(x) >= model.thresholds[kind] - 1e-9).otherwise(out)
        return out

    described = F.transform("wider", lambda x: F.struct(x.alias("span"), *(v.alias(k) for k, v in _features(x).items()), x["kind"].alias("kind")))
    chosen = F.transform(F.filter(described, accepted), lambda x: x["span"])

    return scored.withColumn("wider", alone).withColumn("added", F.when(F.size("wider") > 0, chosen).otherwise(S.none())).drop("wider", "fold")


def all_spans(base: str = "base", added: str = "added") -> Column:
    """Base and added spans by kind as listed, then start."""
    each = F.concat(base, added)
    return F.concat(*(F.array_sort(F.filter(each, _is(k))) for k in KINDS))


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: Model | None = None) -> DataFrame:
    """(doc_id, text) with every span replaced by its kind in brackets; where spans overlap, the first one's name stands for both; a null text becomes empty."""
    found = find_pii(docs, id_col, text_col, model).withColumn("__spans", F.array_sort(F.transform(all_spans(), lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), x["kind"].alias("kind")))))
    piece = lambda a, b: F.substr(F.col("text"), (a + 1).cast("int"), F.greatest(b - a, F.lit(0)).cast("int"))
    text = F.aggregate(
        "__spans",
        F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at")),
        lambda s, x: F.struct(
            F.when(x["start"] >= s["at"], F.concat(s["out"], piece(s["at"], x["start"]), F.lit("["), x["kind"], F.lit("]"))).otherwise(s["out"]).alias("out"),
            F.greatest(s["at"], x["end"]).alias("at"),
        ),
        lambda s: F.concat(s["out"], F.substr(F.col("text"), (s["at"] + 1).cast("int"))),
    )
    return found.select("doc_id", F.when(F.size("__spans") > 0, text).otherwise(F.col("text")).alias("text"))
