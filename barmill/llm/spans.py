"""Spans of regular expressions as native column expressions: no Python runs on the executors.

A span is a struct of SPAN, in code points, end exclusive. Positions follow from the lengths of the matches and of the
gaps between them, which regexp_extract_all() and split() give in the same order. An expression inside a lambda is
evaluated for each element, so what is used more than once is bound with let().
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: near: up to 24 characters of the gap before the span; after: the first character of the gap behind it.
SPAN = "array<struct<kind:string,start:bigint,end:bigint,value:string,near:string,after:string>>"
#: Sums run in blocks of this many spans, so that appending costs little for texts with very many.
_BLOCK = 128


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with value evaluated once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def none() -> Column:
    return F.array().cast(SPAN)


def located(kind: str, text: Column, pattern: str, group: int = 0) -> Column:
    """Spans of all matches, leftmost first without overlap; value: the given group."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else None
    between = F.split(text, pattern, -1)

    def pieces(gaps: Column) -> Column:
        inner = F.zip_with(found, gaps, lambda m, g: F.struct(m.alias("match"), F.char_length(g).cast("long").alias("gap"), F.right(g, F.lit(24)).alias("near")))
        whole = F.zip_with(inner, F.slice(gaps, 2, F.greatest(F.size(gaps) - 1, F.lit(0))), lambda x, g: F.struct(x["match"].alias("match"), x["gap"].alias("gap"), x["near"].alias("near"), F.left(g, F.lit(1)).alias("after")))
        if value is not None:
            whole = F.zip_with(whole, value, lambda x, v: F.struct(x["match"].alias("match"), x["gap"].alias("gap"), x["near"].alias("near"), x["after"].alias("after"), v.alias("value")))
        return F.filter(whole, lambda x: x["match"].isNotNull())

    def step(state: Column, x: Column) -> Column:
        start = state["at"] + x["gap"]
        end = start + F.char_length(x["match"])
        own = F.struct(F.lit(kind).alias("kind"), start.alias("start"), end.alias("end"), (x["match"] if value is None else x["value"]).alias("value"), x["near"].alias("near"), x["after"].alias("after"))
        return F.struct(end.alias("at"), F.concat(state["out"], F.array(own)).alias("out"))

    def block(state: Column, part: Column) -> Column:
        own = F.aggregate(part, F.struct(state["at"].alias("at"), none().alias("out")), step)
        return let(own, lambda x: F.struct(x["at"].alias("at"), F.concat(state["out"], F.array(x["out"])).alias("out")))

    def run(each: Column) -> Column:
        parts = F.transform(F.sequence(F.lit(1), F.size(each), F.lit(_BLOCK)), lambda b: F.slice(each, b, F.lit(_BLOCK)))
        first = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(f"array<{SPAN}>").alias("out"))
        return F.when(F.size(each) > 0, F.flatten(F.aggregate(parts, first, block)["out"])).otherwise(none())

    return let(let(between, pieces), run)


def overlaps(x: Column, others: Column) -> Column:
    return F.exists(others, lambda o: (o["start"] < x["end"]) & (x["start"] < o["end"]))


def joined(found: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(found, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def count(found: Column, kind: str) -> Column:
    return F.size(F.filter(found, lambda x: x["kind"] == kind)).cast("long")
