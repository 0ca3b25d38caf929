"""Secret scans by corpus-wide ownership frequency, in native column expressions throughout.

Base detectors give the spans of the stated patterns; a generator of mixed high-variety strings adds candidates that
no pattern names. Values are hashed, and every hash is counted by distinct repositories and owners over the whole
corpus: a value that many owners carry, or many repositories whoever owns them, is a copied example; one that a single
owner carries in few repositories may be a live credential. Texts are scanned once, into a table of spans. Counts are
pre-aggregated by (hash, repository, owner), so a value that fills a third of all rows meets in one task with a row for
each repository at most, and its occurrences are joined with their counts under SALTS different keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barmill.llm import spans as S
from barmill.llm.common import written

KINDS = ("assign", "access", "hex")

# The base patterns; hex and access in the form that goes by maximal runs, with the least length.
_ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+))"""
_ACCESS = r"AKIA[A-Z0-9]{16,}+"
_HEX = r"(?<![0-9a-f])[0-9a-f]{24,}+"
_NAMES = r"(?i:passw|secret|token|api_?key)"
#: Further candidates: runs of 20 characters or more with lower case, upper case and digits.
_MIXED = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}+"
_LONG = "[A-Za-z0-9+/_=-]{20}"
#: Keys that the occurrences of one value are dealt to.
SALTS = 16
_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"


def base_spans(text: Column) -> Column:
    """All base spans of a text by start, then kind as listed; value: what is secret of each."""
    assign = F.filter(S.located("assign", text, _ASSIGN, 2), lambda x: F.length(x["value"]) >= 6)
    found = F.concat(
        F.when(text.rlike(_NAMES), assign).otherwise(S.none()),
        F.when(text.contains("AKIA"), S.located("access", text, _ACCESS)).otherwise(S.none()),
        F.when(text.rlike("[0-9a-f]{24}"), S.located("hex", text, _HEX)).otherwise(S.none()),
    )
    return in_order(found)


def in_order(found: Column) -> Column:
    """Spans by start, then kind as listed, further kinds behind."""
    place = lambda x: F.coalesce(F.array_position(F.array(*map(F.lit, KINDS)), x["kind"]), F.lit(9))
    keyed = F.transform(found, lambda x: F.struct(x["start"].alias("start"), F.when(place(x) == 0, 9).otherwise(place(x)).alias("place"), x.alias("span")))
    return F.transform(F.array_sort(keyed), lambda x: x["span"])


def _variety(x: Column) -> Column:
    """Many different characters of all three sorts."""
    value = x["value"]
    # an array of the characters of a long run would take many times its bytes
    many = F.size(F.filter(F.array(*map(F.lit, _ALPHABET)), lambda c: F.contains(value, c)))
    different = F.when(F.length(value) <= 200, F.size(F.array_distinct(F.split(value, "")))).otherwise(many)
    return value.rlike("[a-z]") & value.rlike("[A-Z]") & value.rlike("[0-9]") & (different >= 12)


def find_secrets(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    repo: Column | None = None,
    owner: Column | None = None,
    most_owners: int = 1,
    most_repos: int = 2,
    example_owners: int = 3,
    example_repos: int = 4,
) -> DataFrame:
    """(doc_id, base, added, n_live, n_example) for every row.

    A value is live-looking if at most `most_owners` owners carry it in at most `most_repos` repositories; an example if
    `example_owners` owners or `example_repos` repositories carry it. base: base spans by start, then kind; added: spans
    of kind mixed that overlap no base span and whose value is live-looking. n_live and n_example count the distinct
    values of the row, base and added, of each sort. repo and owner are columns of docs; without them all rows belong to
    one. A null text counts as empty, a null repository or owner is one of its own. Rows that repeat id and text get
    equal results; without candidates the arrays are empty. An empty table gives an empty one; further columns are left out.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    known = lambda c: F.lit("") if c is None else F.coalesce(c.cast("string"), F.lit("\0"))
    rows = docs.select(F.col(id_col).alias("doc_id"), known(repo).alias("repo"), known(owner).alias("owner"), F.xxhash64(text).alias("text_key"), text.alias("text"))
    rows = rows.withColumn("base", base_spans(F.col("text")))
    wider = F.when(F.col("text").rlike(_LONG), S.located("mixed", F.col("text"), _MIXED)).otherwise(S.none())
    rows = rows.withColumn("wider", wider).withColumn("wider", F.filter("wider", lambda x: _variety(x) & ~S.overlaps(x, F.col("base")))).drop("text")
    rows = written(rows, "secret-spans")

    each = rows.where("size(base) + size(wider) > 0").select("doc_id", "text_key", "repo", "owner", F.explode(F.concat("base", "wider")).alias("span"))
    each = each.withColumn("hash", F.xxhash64("span.value"))
    owned = each.groupBy("hash", "repo", "owner").agg(F.count("*").alias("n"))
    ownership = owned.groupBy("hash").agg(F.count_distinct("repo").alias("repos"), F.count_distinct("owner").alias("owners"))
    ownership = ownership.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = each.select("doc_id", "text_key", "span", "hash", F.pmod(F.xxhash64("doc_id", "text_key"), F.lit(SALTS)).cast("int").alias("salt"))
    judged = salted.join(ownership, ["hash", "salt"])
    live = (F.col("owners") <= most_owners) & (F.col("repos") <= most_repos)
    example = (F.col("owners") >= example_owners) | (F.col("repos") >= example_repos)
    found = judged.groupBy("doc_id", "text_key").agg(
        F.array_sort(F.collect_set(F.when(live & (F.col("span.kind") == "mixed"), F.col("span")))).alias("added"),
        F.count_distinct(F.when(live, F.col("hash"))).alias("n_live"),
        F.count_distinct(F.when(example, F.col("hash"))).alias("n_example"),
    )
    found = found.select(F.col("doc_id").alias("__id"), F.col("text_key").alias("__key"), "added", "n_live", "n_example")
    out = rows.select("doc_id", "text_key", "base").join(found, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("text_key") == F.col("__key")), "left")
    zero = F.lit(0).cast("long")
    return out.select("doc_id", "base", F.coalesce("added", S.none()).alias("added"), F.coalesce("n_live", zero).alias("n_live"), F.coalesce("n_example", zero).alias("n_example"))
