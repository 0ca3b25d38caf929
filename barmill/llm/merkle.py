"""Merkle manifest of a dataset: a hash tree over the rows of each source, and one over the sources' roots.

Nodes are kept outside memory. Leaves are sorted into runs by (source, id) and written; each level of the tree is a
Parquet table of runs of up to FAN sibling nodes, made by one scan of the level below, and only that level is read for it.
A node's coordinate is (source, place), so the run that it belongs to is (source, place / FAN). Proofs are extracted from
the top down: a level's runs are merged with the proofs of the level above by coordinate, and every leaf of a run takes
its proof from the row of its run, so no proof is ever copied for a single leaf.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barmill.llm.common import shared_dir, written
from barmill.operators.ranking import numbered

FAN = 16
#: Length of a digest in hexadecimal.
HEX = 64
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _field(c: Column) -> Column:
    return F.coalesce(F.concat(F.octet_length(c.cast("string")).cast("string"), F.lit(":"), c.cast("string")), F.lit("-"))


def leaf(*fields: Column) -> Column:
    """SHA-256 of a row: each field as its length in bytes and its value, or as a dash where it is null."""
    return F.sha2(F.concat(*map(_field, fields)), 256)


def tampered(doc_id: Column, text: Column) -> Column:
    """The text with A-Z lower-cased, where 5 divides the CRC of the id; null on all other rows, on null texts and null ids."""
    return F.when(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.translate(text, _UPPER, _LOWER))


class Tree(NamedTuple):
    """levels[k]: (key, place, run, digest) of the runs of level k, run being the digests of its nodes joined and digest theirs.

    Level 0 has `nodes` too, the leaves with all that they carry. sizes: (key, n, height) of each key's leaves.
    """

    levels: list[DataFrame]
    sizes: DataFrame


def _height(n: Column) -> Column:
    """Levels above n leaves until one node remains."""
    steps = F.sequence(F.lit(1), F.lit(16))  # 16 ** 16 leaves are more than a long can count
    return F.aggregate(steps, F.struct(n.alias("n"), F.lit(0).alias("h")), lambda s, _: F.when(s["n"] > 1, F.struct(F.shiftright(s["n"] + (FAN - 1), 4).alias("n"), (s["h"] + 1).alias("h"))).otherwise(s), lambda s: s["h"])


def build(leaves: DataFrame, store: str) -> Tree:
    """The tree of each key over (key, place, digest, …), places counting from 0 within a key.

    Every level is written below `store`. A key whose tree is complete goes on as single nodes, which paths() leaves out.
    """
    spark = leaves.sparkSession
    sizes = written(leaves.groupBy("key").agg(F.count("*").alias("n")).withColumn("height", _height(F.col("n"))), "sizes")
    top = sizes.agg(F.max("height")).first()[0]
    more = [c for c in leaves.columns if c not in ("key", "place", "digest")]
    below, levels = leaves, []
    for k in range(max(1, top or 0)):
        node = F.struct("place", "digest", *(more if k == 0 else []))
        runs = below.groupBy("key", F.expr(f"place div {FAN}").alias("parent")).agg(F.array_sort(F.collect_list(node)).alias("nodes"))  # at most FAN
        run = F.array_join(F.transform("nodes", lambda x: x["digest"]), "")
        out = runs.select("key", F.col("parent").alias("place"), run.alias("run"), *(["nodes"] if k == 0 else [])).withColumn("digest", F.sha2("run", 256))
        out.write.parquet(f"{store}/level={k}")
        levels.append(spark.read.parquet(f"{store}/level={k}"))
        below = levels[-1].select("key", "place", "digest")
    return Tree(levels, sizes)


def paths(tree: Tree, top: DataFrame) -> DataFrame:
    """(key, place, path, root columns) of every run of leaves; path: the runs on the way up from the run's node, with the node's place in each.

    top: (key, path, …) of the whole trees, path being what follows above them. A key with one leaf has no run of its
    own: its row has alone = true and its leaf's path begins above the tree.
    """
    more = [c for c in top.columns if c not in ("key", "path")]
    rooted = written(tree.sizes.join(top, "key"), "rooted")
    step = lambda pos: F.array(F.struct(pos.cast("int").alias("pos"), F.col("run").alias("run")))
    own = None
    for k in range(len(tree.levels), 0, -1):  # from the nodes of level k down to those of level k - 1
        ends = rooted.where(F.col("height") == k).select("key", F.lit(0).cast("long").alias("place"), "path", *more)
        own = ends if own is None else own.unionByName(ends)
        if k > 1:
            nodes = tree.levels[k - 1].select("key", "place", "run").join(own, ["key", "place"])
            nodes = nodes.select("key", "place", "run", "path", *more, F.explode(F.sequence(F.lit(0), (F.length("run") / HEX).cast("int") - 1)).alias("pos"))
            own = written(nodes.select("key", (F.col("place") * FAN + F.col("pos")).alias("place"), F.concat(step(F.col("pos")), "path").alias("path"), *more), "paths")
    alone = rooted.where("height = 0").select("key", F.lit(0).cast("long").alias("place"), "path", *more)
    return own.withColumn("alone", F.lit(False)).unionByName(alone.withColumn("alone", F.lit(True)))


def folded(own: Column, path: Column) -> Column:
    """The root that a leaf and the siblings on its path give."""
    return F.aggregate(path, own, lambda h, p: F.sha2(F.concat(F.substr(p["run"], F.lit(1), p["pos"] * HEX), h, F.substr(p["run"], (p["pos"] + 1) * HEX + 1, F.lit(FAN * HEX))), 256))


def siblings(path: Column) -> Column:
    """The digests beside those of the path's own nodes, joined from the leaf's level up, left to right."""
    return F.array_join(F.transform(path, lambda p: F.concat(F.substr(p["run"], F.lit(1), p["pos"] * HEX), F.substr(p["run"], (p["pos"] + 1) * HEX + 1, F.lit(FAN * HEX)))), "")


def manifest(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", other: tuple[str, ...] = ("lang", "n_chars", "text")) -> tuple[DataFrame, str]:
    """(proofs, store) of the rows of docs; store: the folder of both trees' levels.

    proofs: a row for each of docs: doc_id, leaf, tampered_leaf (of the row as tampered() alters it, null where it
    doesn't), path, subroot, root. Leaves ascend by id within a source, null ids first, rows of one id by their digest;
    rows that repeat are leaves each. Sources ascend by their bytes, the null one first. An empty table has no trees and
    gives an empty result. Columns beside those named never matter.
    """
    text = other[-1]
    fields = lambda last: [F.col(id_col), F.col(source_col), *(F.col(c) for c in other[:-1]), last]
    key = F.when(F.col(source_col).isNull(), "").otherwise(F.concat(F.lit("="), source_col))  # the null source sorts before the empty one
    changed = tampered(F.col(id_col), F.col(text))
    hashed = docs.select(key.alias("key"), F.col(id_col).alias("doc_id"), leaf(*fields(F.col(text))).alias("digest"), F.when(changed.isNotNull(), leaf(*fields(changed))).alias("tampered_leaf"))
    rows = numbered(written(hashed, "leaves"), [F.col("key"), F.col("doc_id").asc_nulls_first(), F.col("digest")], "at")
    first = written(rows.groupBy("key").agg(F.min("at").alias("first")), "first")
    store = shared_dir(docs.sparkSession, "manifest")
    leaves = rows.join(first, "key").select("key", (F.col("at") - F.col("first")).alias("place"), "digest", "doc_id", "tampered_leaf")
    tree = build(leaves, f"{store}/rows")

    ends = None
    for k, level in enumerate(tree.levels):
        own = level.where("place = 0").join(tree.sizes.where(F.greatest(F.col("height") - 1, F.lit(0)) == k), "key")
        one = own.select("key", F.when(F.col("height") == 0, F.col("run")).otherwise(F.col("digest")).alias("digest"))
        ends = one if ends is None else ends.unionByName(one)
    sources = written(numbered(ends.withColumnRenamed("key", "source_key"), [F.col("source_key")], "place").withColumn("key", F.lit("")), "sources")
    above = build(sources, f"{store}/sources")
    last = above.levels[-1].where("place = 0")
    root = last.select("key", F.when(F.length("run") == HEX, F.col("run")).otherwise(F.col("digest")).alias("root"), F.array().cast("array<struct<pos:int,run:string>>").alias("path"))
    tops = _leaf_paths(above, paths(above, root), ["source_key"]).select(F.col("source_key").alias("key"), F.col("digest").alias("subroot"), "path", "root")
    return _leaf_paths(tree, paths(tree, tops), ["doc_id", "tampered_leaf"]).withColumnRenamed("digest", "leaf"), store


def _leaf_paths(tree: Tree, of_runs: DataFrame, more: list[str]) -> DataFrame:
    """Every leaf with its path, each taken from the row of its run."""
    run = tree.levels[0].join(of_runs, ["key", "place"]).drop("key", "place", "digest")
    each = run.select("*", F.posexplode("nodes").alias("pos", "node"))
    path = F.when(F.col("alone"), F.col("path")).otherwise(F.concat(F.array(F.struct(F.col("pos").cast("int").alias("pos"), F.col("run").alias("run"))), "path"))
    extra = [c for c in ("subroot", "root") if c in of_runs.columns]
    return each.select(F.col("node.digest").alias("digest"), *(F.col(f"node.{c}").alias(c) for c in more), path.alias("path"), *extra)


def verified(proofs: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root and verified of every row of a manifest's proofs.

    folded_root: the root recomputed from the row as it is now (tampered_leaf where there is one) and its siblings.
    """
    now = F.coalesce("tampered_leaf", "leaf")
    out = proofs.select("doc_id", "leaf", "subroot", "root", F.sha2(siblings(F.col("path")), 256).alias("proof_sha256"), folded(now, F.col("path")).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
