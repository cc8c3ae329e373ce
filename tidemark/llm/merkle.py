"""A Merkle manifest of a table: one tree per source, one tree over the sources, and proofs by octopus multiproofs.

A row is a leaf: SHA-256 of its fields, each as its length in bytes, a colon and its value (`-` for null). Leaves of a
source ascend by id; three consecutive nodes become their parent until one is left. The sources' last nodes, ordered
by source, give the root in the same way. Digests are 32 bytes here; hashed, they are written as hexadecimal text.

Building: leaves are dealt out by ranges of (source, id) and numbered within them; a task then takes a block of
3^BLOCK_LEVELS neighbours and gives all nodes above them. A round shrinks a tree by that factor, so 10^12 leaves take
four rounds and no task ever holds more than a block. Nodes are a table (tree, level, at, digest).

Proving: leaves keep the partitions in which they were numbered (runs of neighbours, through several small trees where
need be); any subset of them can be proved. A partition works out the coordinates of all siblings that its
leaves need and cannot derive from one another (the union over its leaves, without the shared interiors), gets just
those from the table of nodes in one join, derives the interiors, and expands every leaf's own proof from them.

Nulls and repeats: null fields are leaves like any other; the null source is a tree of its own, before all others.
Null ids come first. Rows that share an id are ordered by their digests, and equal rows have positions of their own.
An empty table has no nodes and no root.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from hashlib import sha256
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import few_rows, written

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
FAN_IN, BLOCK_LEVELS = 3, 8
#: Leaves in a partition that proves, on average; requested coordinates that are broadcast at most.
PART_LEAVES, BROADCAST_ROWS = 20_000, 500_000
#: The tree over the sources; trees of sources are numbered from 0.
TOP = -1


class Manifest(NamedTuple):
    """leaves (doc_id, source, tree, at, part, leaf, other), nodes (tree, level, at, digest), trees (source, tree, rows, subroot), root."""
    leaves: DataFrame
    nodes: DataFrame
    trees: DataFrame
    root: bytes | None


def field_text(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(fields: Sequence[Column]) -> Column:
    return F.unhex(F.sha2(F.concat(*[field_text(c) for c in fields]), 256))


def parent(digests: Sequence[bytes]) -> bytes:
    return sha256("".join(d.hex() for d in digests).encode()).digest()


def height(leaves: int) -> int:
    """Levels above the leaves until one node is left."""
    levels = 0
    while leaves > 1:
        leaves, levels = -(-leaves // FAN_IN), levels + 1
    return levels


def height_of(leaves: Column) -> Column:
    """As `height`: how many powers of FAN_IN are below the number of leaves."""
    return reduce(lambda n, k: n + (leaves > FAN_IN ** k).cast("int"), range(39), F.lit(0))


# --- building ------------------------------------------------------------------------------------------------

def _numbered(rows: DataFrame, group: str, order: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """`rows` with `at`, the position within `group` in the given order, and `part`; and (group, rows) of each group.

    A group of any size is spread: ranges of (group, order) are sorted by task, and only (group, range, count) meet.
    """
    spark = rows.sparkSession
    parts = max(1, -(-rows.count() // PART_LEAVES))
    # Rows that are equal in all else keep apart by a number, so that they may be cut anywhere.
    rows = rows.withColumn("_row", F.monotonically_increasing_id())
    ordered = rows.repartitionByRange(parts, group, *order, "_row").sortWithinPartitions(group, *order, "_row").drop("_row")
    placed = written(ordered.withColumn("_id", F.monotonically_increasing_id()).withColumn("_part", F.spark_partition_id()), "numbered")
    counts = placed.groupBy(group, "_part").agg(F.count("*").alias("_rows"), F.min("_id").alias("_first"))
    counts = written(counts.selectExpr("*", f"coalesce(sum(_rows) OVER (PARTITION BY `{group}` ORDER BY _part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS _before")
                     .withColumnsRenamed({group: "_group", "_part": "_range"}), "ranges")
    same = F.col(group).eqNullSafe(F.col("_group")) & (F.col("_part") == F.col("_range"))
    at = (F.col("_before") + F.col("_id") - F.col("_first")).cast("bigint")
    numbered = placed.join(few_rows(counts, BROADCAST_ROWS), same).withColumn("at", at).withColumnRenamed("_part", "part").drop("_id", "_range", "_group", "_rows", "_first", "_before")
    return numbered, counts.groupBy(F.col("_group").alias(group)).agg(F.sum("_rows").alias("rows"))


def _above(block: pd.DataFrame) -> pd.DataFrame:
    """All nodes above the nodes of one block (tree, level, at, digest, up): `up` levels at most."""
    block = block.sort_values("at")
    tree, level, up = (int(block[c].iloc[0]) for c in ("tree", "level", "up"))
    at, digests = int(block["at"].iloc[0]), list(block["digest"])
    out = []
    for step in range(1, up + 1):
        at, digests = at // FAN_IN, [parent(digests[i:i + FAN_IN]) for i in range(0, len(digests), FAN_IN)]
        out += [(tree, level + step, at + i, d) for i, d in enumerate(digests)]
    return pd.DataFrame(out, columns=["tree", "level", "at", "digest"])


def build_nodes(leaves: DataFrame, sizes: DataFrame) -> DataFrame:
    """(tree, level, at, digest) of all nodes, leaves included, from leaves (tree, at, digest) and sizes (tree, rows)."""
    largest = sizes.agg(F.max("rows")).first()[0] or 0
    heights = written(sizes.select("tree", height_of(F.col("rows")).alias("height")), "heights")
    now = leaves.select("tree", F.lit(0).alias("level"), "at", "digest")
    parts, done = [now], 0
    while done < height(largest):
        up = F.least(F.col("height") - done, F.lit(BLOCK_LEVELS))
        blocks = now.join(few_rows(heights, BROADCAST_ROWS), "tree").where(F.col("height") > done).select(
            "tree", "level", "at", "digest", up.alias("up"), F.floor(F.col("at") / FAN_IN ** BLOCK_LEVELS).cast("bigint").alias("block"))
        nodes = written(blocks.groupBy("tree", "block").applyInPandas(_above, "tree bigint, level int, at bigint, digest binary"), "nodes")
        done += BLOCK_LEVELS
        now = nodes.where(F.col("level") == done)
        parts.append(nodes)
    return reduce(DataFrame.unionByName, parts)


def build_manifest(docs: DataFrame, fields: Sequence[str] = FIELDS, id_col: str = "doc_id", source_col: str = "source", other: Column | None = None) -> Manifest:
    """The trees of a table. `other` is a second digest that travels with each leaf (null: none), to be checked later."""
    leaf = leaf_digest([F.col(c) for c in fields])
    plain = written(docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), leaf.alias("leaf"),
                                (other if other is not None else F.lit(None).cast("binary")).alias("other")), "leaves")
    numbered, sizes = _numbered(plain, "source", ["doc_id", "leaf"])
    # Trees of sources are numbered in their order, which is also the order of the leaves of the tree above them.
    named, top_size = _numbered(sizes.withColumn("tree", F.lit(TOP).cast("bigint")), "tree", ["source"])
    trees = written(named.select("source", F.col("at").alias("tree"), "rows"), "trees")
    known = few_rows(trees.withColumnRenamed("source", "_source"), BROADCAST_ROWS)
    leaves = written(numbered.join(known, F.col("source").eqNullSafe(F.col("_source"))).select("doc_id", "source", "tree", "at", "part", "leaf", "other"), "leaves")
    nodes = build_nodes(leaves.select("tree", "at", F.col("leaf").alias("digest")), trees.select("tree", "rows"))
    tops = nodes.join(few_rows(trees.select("tree", "rows"), BROADCAST_ROWS), "tree").where(F.col("level") == height_of(F.col("rows")))
    tops = written(tops.select("tree", F.col("digest").alias("subroot")), "subroots")
    above = build_nodes(tops.select(F.lit(TOP).cast("bigint").alias("tree"), F.col("tree").alias("at"), F.col("subroot").alias("digest")), top_size)
    highest = above.orderBy(F.col("level").desc()).limit(1).select("digest").first()
    trees = trees.join(tops, "tree").select("source", "tree", "rows", "subroot")
    return Manifest(leaves, nodes.unionByName(above), trees, bytes(highest[0]) if highest else None)


# --- proving -------------------------------------------------------------------------------------------------

def missing(at: np.ndarray, leaves: int) -> tuple[list[tuple[int, np.ndarray]], list[np.ndarray]]:
    """What the leaves at sorted distinct places `at` of a tree need.

    Returns (level, places) of the nodes to fetch: siblings on the way up that none of the given leaves leads to; and
    the places that are known on each level, from the leaves to the last node.
    """
    wanted, known = [], [at]
    for level in range(height(leaves)):
        first = np.unique(at // FAN_IN) * FAN_IN
        run = (first[:, None] + np.arange(FAN_IN)).reshape(-1)
        run = run[run < leaves]
        wanted.append((level, np.setdiff1d(run, at, assume_unique=True)))
        at, leaves = np.unique(at // FAN_IN), -(-leaves // FAN_IN)
        known.append(at)
    return wanted, known


class Multiproof:
    """Fetched nodes of one tree and one partition's leaves of it, with all interiors on their ways up."""

    def __init__(self, own: dict[int, bytes], leaves: int, fetched: dict[tuple[int, int], bytes]):
        self.sizes, self.levels = [], []
        _, known = missing(np.array(sorted(own), np.int64), leaves)
        now = own
        for level, places in enumerate(known):
            if level:
                below, size = self.levels[-1], self.sizes[-1]
                now = {p: parent([below[i] for i in range(FAN_IN * p, min(FAN_IN * p + FAN_IN, size))]) for p in places.tolist()}
            self.sizes.append(leaves if not level else -(-self.sizes[-1] // FAN_IN))
            self.levels.append({**now, **{at: d for (lev, at), d in fetched.items() if lev == level}})

    def way(self, at: int) -> list[tuple[list[bytes], list[bytes]]]:
        """Siblings to the left and to the right of the leaf's way, from the bottom to the last node."""
        out = []
        for level, size in zip(self.levels[:-1], self.sizes, strict=False):
            first = at - at % FAN_IN
            out.append(([level[i] for i in range(first, at)], [level[i] for i in range(at + 1, min(first + FAN_IN, size))]))
            at //= FAN_IN
        return out


def fold(digest: bytes, way: Sequence[tuple[list[bytes], list[bytes]]]) -> bytes:
    """The root that a leaf and its proof lead to."""
    for left, right in way:
        digest = parent([*left, digest, *right])
    return digest


def _requests(rows: pd.DataFrame, top_rows: int) -> pd.DataFrame:
    """(part, tree, level, at) of the nodes that a partition's leaves need and do not give."""
    out = []
    groups = [(int(tree), g["at"].to_numpy(np.int64), int(g["rows"].iloc[0])) for tree, g in rows.groupby("tree")]
    groups.append((TOP, np.unique(rows["tree"].to_numpy(np.int64)), top_rows))
    for tree, at, leaves in groups:
        out += [(tree, level, int(p)) for level, places in missing(np.unique(at), leaves)[0] for p in places]
    return pd.DataFrame({"part": rows["part"].iloc[0], "tree": [x[0] for x in out], "level": [x[1] for x in out], "at": [x[2] for x in out]})


_PROOF = ("doc_id bigint, source string, leaf binary, subroot binary, root binary, proof_sha256 string, folded_root binary, verified boolean, "
          "proof array<struct<left:array<binary>,right:array<binary>>>")


def _expand(rows: pd.DataFrame, fetched: pd.DataFrame, top_rows: int, root: bytes, with_proof: bool) -> pd.DataFrame:
    """Every leaf's proof, its digest, and the root that the leaf (or its other digest) folds to."""
    by_tree: dict[int, dict[tuple[int, int], bytes]] = {}
    for tree, level, at, digest in zip(fetched["tree"], fetched["level"], fetched["at"], fetched["digest"], strict=True):
        by_tree.setdefault(int(tree), {})[int(level), int(at)] = digest
    subroots = {int(t): d for t, d in zip(rows["tree"], rows["subroot"], strict=True)}
    top = Multiproof(subroots, top_rows, by_tree.get(TOP, {}))
    out = []
    for tree, g in rows.groupby("tree", sort=False):
        tree = int(tree)
        own = dict(zip(g["at"].astype("int64").tolist(), g["leaf"], strict=True))
        proofs, above = Multiproof(own, int(g["rows"].iloc[0]), by_tree.get(tree, {})), top.way(tree)
        for doc, source, at, leaf, other in zip(g["doc_id"], g["source"], g["at"], g["leaf"], g["other"], strict=True):
            way = proofs.way(int(at)) + above
            digest = sha256("".join(d.hex() for left, right in way for d in (*left, *right)).encode()).hexdigest()
            folded = fold(leaf if other is None else other, way)
            listed = [{"left": left, "right": right} for left, right in way] if with_proof else None
            out.append((None if pd.isna(doc) else int(doc), source, leaf, subroots[tree], root, digest, folded, folded == root, listed))
    frame = pd.DataFrame(out, columns=[c.split(" ")[0] for c in _PROOF.split(", ")])
    return frame.astype({"doc_id": "Int64"})


def prove(manifest: Manifest, leaves: DataFrame | None = None, with_proof: bool = False) -> DataFrame:
    """Proofs of the given rows of `manifest.leaves` (all by default), checked against the root.

    `folded_root` is what `other` (where it is not null, else the leaf) and the proof lead to. With `with_proof` the
    siblings come along, level by level, left and right of the way.
    """
    leaves = manifest.leaves if leaves is None else leaves
    spark, root = leaves.sparkSession, manifest.root
    if root is None:
        return spark.createDataFrame([], _PROOF)
    top_rows = manifest.trees.count()
    known = few_rows(manifest.trees.select("tree", "rows", "subroot"), BROADCAST_ROWS)
    dealt = leaves.join(known, "tree")
    asked = dealt.select("part", "tree", "at", "rows").groupBy("part").applyInPandas(
        lambda rows: _requests(rows, top_rows), "part int, tree bigint, level int, at bigint")
    asked = written(asked, "requests")
    got = manifest.nodes.join(few_rows(asked, BROADCAST_ROWS), ["tree", "level", "at"]).select("part", "tree", "level", "at", "digest")
    pairs = dealt.groupBy("part").cogroup(written(got, "fetched").groupBy("part"))
    return pairs.applyInPandas(lambda rows, nodes: _expand(rows, nodes, top_rows, root, with_proof), _PROOF)


def proof_digests(docs: DataFrame) -> DataFrame:
    """Every row's proof, checked on a copy of the table that lost the newlines of the texts of every second id."""
    fields = [F.col(c) for c in FIELDS]
    broken = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    tampered = leaf_digest([*fields[:-1], F.replace(F.col("text"), F.lit("\n"), F.lit(""))])
    manifest = build_manifest(docs, other=F.when(broken & F.contains(F.col("text"), F.lit("\n")), tampered))
    return prove(manifest).select("doc_id", *[F.lower(F.hex(c)).alias(c) for c in ("leaf", "subroot", "root")], "proof_sha256",
                                  F.lower(F.hex("folded_root")).alias("folded_root"), "verified", "source")
