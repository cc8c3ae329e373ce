"""N-gram Jaccard join by signature trees: exact groups of documents whose shingle sets overlap by 3/4 or more.

A document's set is its distinct shingles of five words as 64-bit hashes; equal sets are one node from here on.

1. Partition. A pair of sets at the threshold shares one of the first n - ceil(3n/4) + 1 shingles of each in any common
   order. The order here is by rarity: it starts with a fixed 5/16 slice of the hash space, ordered by the number of
   documents, so a set whose rare shingles nobody else has drops out, and passages that many share come last. A set
   whose part of the slice is too short puts forward all of its shingles. Shingles that a bounded sample of documents
   finds in more than 1 of 500 are put behind all others; the sample only shapes the order, and any order is right.
   Sets that share a prefix shingle, directly or through others, are a block. No pair lies across two blocks.
2. Signature trees. Every task takes whole blocks (or pieces of a large one) and puts their sets into a tree: leaves are
   sets with a bitmap of their shingles, nodes hold the OR of their children's bitmaps, the range of sizes and the least
   number of set bits. A traversal of the tree against itself drops node pairs whose largest possible overlap is
   too small; what is left at the leaves is compared exactly, unless links already join the two.
3. Large blocks. Chance links of short sets make them grow faster than the documents, so the sets of blocks of more than
   `piece` are partitioned again, by an order over the whole hash space that counts these sets alone; that is done as long
   as it takes out half of them or more. What is still large is cut into pieces of at most `piece` sets. The pieces are
   joined each by itself, then one set of every group found, until that merges no more; a tight group of any size is one
   group by then. Only sets outside the largest group of a block are then brought together with all of its pieces (or, if
   they are more than a piece themselves, with each other piece by piece).

Links that are found span the groups; copies are not expanded into pairs. Components are computed over the links.

Nulls and texts without words have no set and are linked with nothing. Rows with equal ids are treated one by one; a
component's id is the smallest id in it that is not null. 64-bit hashes stand for shingles and sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Words, bounded_batches, components, few_rows, give_back, mix, runs_of, slices, written

SHINGLE = 5
#: The slice of the hash space that comes first; below 1/2, so that it is a range of non-negative longs.
SLICE = 5 << 60
SAMPLE_DOCS, COMMON_SHARE, PIECE, TASK_SETS, BROADCAST_ROWS, FANOUT = 20_000, 500, 2000, 2000, 1_000_000, 8


def shingle_sets(texts: list[bytes], width: int = SHINGLE) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of every text; A-Z count as a-z."""
    words = Words([t.lower() for t in texts])
    h = words.hashes()
    first, grams = runs_of(h, words.doc, width)
    borders = np.searchsorted(words.doc[first], np.arange(len(texts) + 1)) if len(first) else np.zeros(len(texts) + 1, int)
    sets = []
    for k in range(len(texts)):
        n = int(words.count[k])
        if 0 < n < width:
            own = h[words.first[k]:words.first[k] + n]
            sets.append(mix(runs_of(own, np.zeros(n, int), n)[1] + np.uint64(n)))
        else:
            sets.append(np.unique(grams[borders[k]:borders[k + 1]]))
    return sets


def node_of(tokens: np.ndarray) -> int | None:
    """A set's identity: a signed 64-bit hash of its members."""
    return int(np.uint64(xxhash.xxh3_64_intdigest(tokens.tobytes())).astype(np.int64)) if len(tokens) else None


def prefix_length(n: int) -> int:
    return n - (3 * n + 3) // 4 + 1


def _among(tokens: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    """Which tokens a sorted array holds."""
    if not len(ordered):
        return np.zeros(len(tokens), bool)
    return ordered[np.minimum(np.searchsorted(ordered, tokens), len(ordered) - 1)] == tokens


def offered(tokens: np.ndarray, common: np.ndarray, whole: bool = False) -> tuple[np.ndarray, bool]:
    """The shingles that a set puts forward, and whether they are more than those of the slice (or of the whole hash space)."""
    p = prefix_length(len(tokens))
    is_common = _among(tokens, common)
    plain = tokens[~is_common]
    near = plain if whole else plain[:np.searchsorted(plain, np.uint64(SLICE))]
    if len(near) >= p:
        return near, False
    return np.concatenate([plain, tokens[is_common][:max(0, p - len(plain))]]), True


def _signed(tokens: np.ndarray) -> np.ndarray:
    return tokens.view(np.int64)


def _sets_of(texts: pa.Array, width: int) -> Iterator[np.ndarray]:
    for _, run in slices(texts):
        yield from shingle_sets(run, width)


def set_info(text: Column, common: np.ndarray, width: int) -> Column:
    """struct(n, node, offers, full) of a text column."""
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            rows = []
            for tokens in _sets_of(texts, width):
                offer, full = offered(tokens, common)
                rows.append((len(tokens), node_of(tokens), len(offer), full))
            n, node, offers, full = zip(*rows, strict=True) if rows else ((), (), (), ())
            yield pa.StructArray.from_arrays([pa.array(n, pa.int64()), pa.array(node, pa.int64()), pa.array(offers, pa.int64()), pa.array(full, pa.bool_())],
                                             names=["n", "node", "offers", "full"])

    return F.arrow_udf(run, "struct<n:bigint,node:bigint,offers:bigint,full:boolean>")(text)


def _common_shingles(docs: DataFrame, total: int, width: int, sample_docs: int) -> np.ndarray:
    """Sorted hashes of the shingles in more than 1 of COMMON_SHARE sampled documents: at most COMMON_SHARE times a document's mean number."""
    share = min(1.0, sample_docs / max(total, 1))
    sample = docs if share == 1.0 else docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(share * 1_000_000))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for tokens in _sets_of(batch.column("text"), width):
                yield pa.RecordBatch.from_arrays([pa.array(_signed(tokens))], names=["token"])

    least = max(20, int(min(total, sample_docs)) // COMMON_SHARE)
    found = sample.select("text").mapInArrow(run, "token bigint").groupBy("token").agg(F.count("*").alias("docs")).where(F.col("docs") >= least)
    return np.sort(found.select("token").toPandas()["token"].to_numpy(np.int64).view(np.uint64))


def _stored(tokens: pa.Array) -> Iterator[np.ndarray]:
    """Sets from a column of their bytes."""
    for own in tokens:
        yield np.frombuffer(own.as_buffer(), np.uint64)


def _offers(rows: DataFrame, common: np.ndarray, width: int | None, want_common: bool) -> DataFrame:
    """(token, node) of the shingles put forward, common ones or others; equal sets of one batch are put forward once.

    The sets are those of a column of texts or, without a width, a column of sets, whose whole hash space then counts.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: set[int] = set()
            parts, nodes = [], []
            for tokens in _stored(batch.column(0)) if width is None else _sets_of(batch.column(0), width):
                node = node_of(tokens)
                if node is None or node in seen:
                    continue
                seen.add(node)
                offer, _ = offered(tokens, common, width is None)
                offer = offer[_among(offer, common) == want_common]
                parts.append(offer)
                nodes.append(np.full(len(offer), node, np.int64))
            if parts:
                yield pa.RecordBatch.from_arrays([pa.array(_signed(np.concatenate(parts))), pa.array(np.concatenate(nodes))], names=["token", "node"])

    return rows.mapInArrow(run, "token bigint, node bigint")


def _blocks(rows: DataFrame, info: DataFrame, common: np.ndarray, width: int | None) -> DataFrame:
    """(node, block) of the sets that may have a partner; `rows` as in `_offers`."""
    # One shuffle of what is put forward. A shingle that is not common belongs to a small share of the documents, so its
    # rows make a bounded group (and spill beyond memory).
    together = _offers(rows, common, width, False).selectExpr(
        "token", "node", "count(*) OVER (PARTITION BY token) AS docs", "min(node) OVER (PARTITION BY token) AS least", "max(node) OVER (PARTITION BY token) AS most")
    outside = F.lit(False) if width is None else ~F.col("token").between(0, SLICE - 1)
    shared = together.where("least <> most").select("node", "token", "docs", outside.alias("outside"))
    ranked = shared.groupBy("node").agg(F.collect_set(F.struct("outside", "docs", "token")).alias("tokens"))
    sizes = info.where("node IS NOT NULL").groupBy("node").agg(F.first("n").alias("n"), F.first("offers").alias("offers"), F.first("full").alias("full"))
    # The shingles nobody else put forward are the rarest and fill the prefix first.
    room = F.when(F.col("full"), F.size("tokens")).otherwise(
        F.greatest(F.lit(0), F.col("n") - F.floor((3 * F.col("n") + 3) / 4) + 1 - (F.col("offers") - F.size("tokens"))).cast("int"))
    first = ranked.join(sizes, "node").select("node", F.explode(F.slice(F.array_sort("tokens"), F.lit(1), room)).alias("t")).select("node", "t.token")
    prefix = written(first, "prefix")
    hot = written(_offers(rows, common, width, True), "common")
    edges = None
    for put, few in ((prefix, False), (hot, True)):
        least = put.groupBy("token").agg(F.min("node").alias("least"))
        pairs = put.join(F.broadcast(least) if few else least, "token").where("node <> least").select(F.col("node").alias("a"), F.col("least").alias("b")).distinct()
        edges = pairs if edges is None else edges.unionByName(pairs)
    return components(edges, "blocks").withColumnRenamed("component", "block")


def _blocks_again(sets: DataFrame, common: np.ndarray) -> DataFrame:
    """(node, block, sets) of those of some sets (node, tokens) that may have a partner among them, by an order over all of their shingles."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [(len(tokens), len(offer), full) for tokens in _stored(batch.column("tokens")) for offer, full in [offered(tokens, common, whole=True)]]
            n, offers, full = zip(*own, strict=True) if own else ((), (), ())
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(n, pa.int64()), pa.array(offers, pa.int64()), pa.array(full, pa.bool_())],
                                             names=["node", "n", "offers", "full"])

    info = written(sets.select("node", "tokens").mapInArrow(run, "node bigint, n bigint, offers bigint, full boolean"), "sets-info")
    blocks = written(_blocks(sets.select("tokens"), info, common, None), "blocks")
    return written(blocks.join(blocks.groupBy("block").agg(F.count("*").alias("sets")), "block").select("node", "block", "sets"), "blocks")


# --- trees -------------------------------------------------------------------------------------------------

class SignatureTree:
    """Bitmaps, sizes and least bit counts of sets (level 0) and of nodes of up to FANOUT children above."""

    def __init__(self, sets: list[np.ndarray]):
        size = np.array([len(s) for s in sets])
        least = np.array([s[0] for s in sets], np.uint64)
        self.order = np.lexsort((least, (np.log(size) / np.log(4 / 3)).astype(int)))
        self.sets = [sets[i] for i in self.order]
        size = size[self.order]
        bits = 1 << int(np.clip(4 * np.median(size), 256, 8192) - 1).bit_length()
        maps = np.zeros((len(sets), bits), bool)
        maps[np.repeat(np.arange(len(sets)), size), (np.concatenate(self.sets) & np.uint64(bits - 1)).astype(np.int64)] = True
        words = np.packbits(maps, axis=1).view(np.uint64)
        self.levels = [(words, size, size, np.bitwise_count(words).sum(axis=1).astype(np.int64))]
        while len(self.levels[-1][0]) > FANOUT:
            words, low, high, bits_set = self.levels[-1]
            at = np.arange(0, len(words), FANOUT)
            self.levels.append((np.bitwise_or.reduceat(words, at), np.minimum.reduceat(low, at), np.maximum.reduceat(high, at), np.minimum.reduceat(bits_set, at)))

    def possible(self, level: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether some pair of sets below the nodes may reach 3/4, by sizes and by bits that only one side has."""
        words, low, high, bits_set = self.levels[level]
        keep = (4 * high[a] >= 3 * low[b]) & (4 * high[b] >= 3 * low[a])
        a, b = a[keep], b[keep]
        both = np.bitwise_count(words[a] & words[b]).sum(axis=1).astype(np.int64)
        miss_a, miss_b = np.maximum(0, bits_set[a] - both), np.maximum(0, bits_set[b] - both)
        most = np.minimum(high[a] - miss_a, high[b] - miss_b)
        keep[keep] = 4 * most >= 3 * np.maximum(most + miss_a + miss_b, low[a] + low[b] - most)
        return keep

    def candidates(self, chunk: int = 1 << 14) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of leaves that the traversal cannot rule out, depth first so that few are held at once."""
        top = len(self.levels) - 1
        a, b = np.triu_indices(len(self.levels[top][0]))
        work = [(top, a, b)]
        while work:
            level, a, b = work.pop()
            if len(a) > chunk:
                work += [(level, a[chunk:], b[chunk:]), (level, a[:chunk], b[:chunk])]
                continue
            if level == 0:
                a, b = a[a < b], b[a < b]
            keep = self.possible(level, a, b)
            a, b = a[keep], b[keep]
            if not len(a):
                continue
            if level == 0:
                yield a, b
                continue
            n = len(self.levels[level - 1][0])
            child = np.arange(FANOUT)
            x = (a[:, None, None] * FANOUT + child[None, :, None] + 0 * child).reshape(-1)
            y = (b[:, None, None] * FANOUT + 0 * child[:, None] + child[None, None, :]).reshape(-1)
            ok = (x < n) & (y < n) & (x <= y)
            work.append((level - 1, x[ok], y[ok]))


def _similar(x: np.ndarray, y: np.ndarray) -> bool:
    short, long = (x, y) if len(x) <= len(y) else (y, x)
    both = int(_among(short, long).sum())
    return 100 * both >= 75 * (len(x) + len(y) - both)


def tree_links(sets: list[np.ndarray], group: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Links that span the groups of similar sets. Sets with equal non-negative `group` are known to be in one already."""
    tree = SignatureTree(sets)
    parent = np.arange(len(sets))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    if group is not None:
        known = group[tree.order]
        for g in np.unique(known[known >= 0]):
            members = np.flatnonzero(known == g)
            parent[members] = members[0]
    links = []
    for a, b in tree.candidates():
        while len(a):
            labels = parent
            while not np.array_equal(labels, labels[labels]):
                labels = labels[labels]
            apart = labels[a] != labels[b]
            a, b = a[apart], b[apart]
            _, pick = np.unique(labels[a], return_index=True)
            for i in pick:
                x, y = int(a[i]), int(b[i])
                if root(x) != root(y) and _similar(tree.sets[x], tree.sets[y]):
                    links.append((int(tree.order[x]), int(tree.order[y])))
                    parent[root(x)] = root(y)
            rest = np.ones(len(a), bool)
            rest[pick] = False
            a, b = a[rest], b[rest]
    return links


def _task_links(rows: pd.DataFrame) -> pd.DataFrame:
    """Links of one task: each block (with its side, for pieces brought together) gets a tree of its own."""
    out = []
    for _, part in rows.groupby("tree", sort=False):
        part = part.drop_duplicates("node")
        if len(part) > 1:
            nodes = part["node"].to_numpy()
            sets = [np.frombuffer(t, np.uint64) for t in part["tokens"]]
            known = pd.factorize(part["known"])[0]  # -1 where it is null
            out += [(nodes[i], nodes[j]) for i, j in tree_links(sets, known)]
            del sets
    give_back()
    return pd.DataFrame(out, columns=["a", "b"], dtype="int64")


def _run_trees(sets: DataFrame, placed: DataFrame) -> DataFrame:
    """Links (a, b) found by the trees of `placed` (node, task, tree, known)."""
    rows = sets.join(placed, "node").select("task", "tree", "known", "node", "tokens")
    return written(rows.groupBy("task").applyInPandas(_task_links, "a bigint, b bigint"), "links")


def _labels(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """(node, block, group) with the group that links have joined each node to."""
    groups = components(links).withColumnRenamed("component", "group")
    return written(nodes.join(groups, "node", "left").withColumn("group", F.coalesce("group", "node")), "groups")


def _large_block_links(sets: DataFrame, nodes: DataFrame, piece: int) -> DataFrame:
    """Links of blocks of more than `piece` sets (step 3 of the module's text)."""
    alone = F.lit(None).cast("string")
    now, links, merged = nodes.withColumn("group", F.col("node")), None, None
    while True:
        one = now.where("node = group")
        count = one.groupBy("block").agg(F.count("*").alias("sets"))
        left = one.count()
        if merged is not None and left == merged:
            break
        merged = left
        parts = F.ceil(F.col("sets") / piece)
        placed = one.join(count, "block").select("node", F.xxhash64("block", F.pmod(F.xxhash64("node", F.lit(17)), parts).cast("int")).alias("task")).select("node", "task", F.col("task").alias("tree"), alone.alias("known"))
        found = _run_trees(sets, placed)
        links = found if links is None else links.unionByName(found)
        now = _labels(nodes, links)

    size = now.groupBy("block", "group").agg(F.count("*").alias("members"))
    main = size.groupBy("block").agg(F.max(F.struct("members", "group")).alias("m"), F.sum("members").alias("all")).select("block", F.col("m.group").alias("main"), "all", (F.col("all") - F.col("m.members")).alias("others"))
    rest = now.join(main, "block").where("others > 0")
    pieces, strays = F.ceil(F.col("all") / piece).cast("int"), F.ceil(F.col("others") / piece).cast("int")
    mine = rest.select("node", "block", "group", pieces.alias("pieces"), strays.alias("strays"), (F.col("group") == F.col("main")).alias("inner"),
                       F.pmod(F.xxhash64("node", F.lit(17)), pieces).cast("int").alias("piece"), F.pmod(F.xxhash64("node", F.lit(23)), strays).cast("int").alias("stray"))
    # Every piece meets every stretch of the sets outside the main group; those sets also meet each other, stretch by stretch.
    inner = mine.where("inner").select("*", F.explode(F.sequence(F.lit(0), F.col("strays") - 1)).alias("x"), F.col("piece").alias("y"))
    outer = mine.where("NOT inner").select("*", F.col("stray").alias("x"), F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)).alias("y"))
    each = mine.where("NOT inner").select("*", F.explode(F.sequence(F.lit(0), F.col("strays") - 1)).alias("o")).select(
        "*", F.least("stray", "o").alias("x"), (-1 - F.greatest("stray", "o")).alias("y"))
    placed = inner.select("node", "block", "group", "x", "y").unionByName(outer.select("node", "block", "group", "x", "y")).unionByName(each.select("node", "block", "group", "x", "y"))
    last = _run_trees(sets, placed.select("node", F.xxhash64("block", "x", "y").alias("task"), F.xxhash64("block", "x", "y").alias("tree"), F.col("group").cast("string").alias("known")))
    return links.unionByName(last)


def _grouped(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE, piece: int = PIECE, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """(doc_id, n, node, component) of every document; `component` is one of the nodes."""
    spark = docs.sparkSession
    bounded_batches(spark)
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    common = _common_shingles(docs, docs.count(), width, sample_docs)
    info = written(docs.select("doc_id", set_info(F.col("text"), common, width).alias("i")).select("doc_id", "i.*"), "sets-info")
    blocks = written(_blocks(docs.select("text"), info, common, width), "blocks")

    sizes = blocks.groupBy("block").agg(F.count("*").alias("sets"))
    tasks = max(1, -(-blocks.count() // TASK_SETS))
    # One row of each set is read again; where its set goes is known beforehand, so the sets move once.
    chosen = written(info.join(blocks, "node").groupBy("node").agg(F.min("doc_id").alias("chosen"), F.first("block").alias("tree")).join(
        sizes.withColumnRenamed("block", "tree"), "tree").select("chosen", "node", "tree", "sets", F.pmod(F.xxhash64("tree"), F.lit(tasks)).alias("task")), "chosen")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = zip(*(batch.column(c).to_pylist() for c in ("node", "task", "tree")), strict=True)
            # Rows may share an id, so the set is checked too.
            rows = [(*place, own.tobytes()) for place, own in zip(places, _sets_of(batch.column("text"), width), strict=True) if place[0] == node_of(own)]
            node, task, tree, tokens = zip(*rows, strict=True) if rows else ((), (), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(node, pa.int64()), pa.array(task, pa.int64()), pa.array(tree, pa.int64()), pa.array(tokens, pa.binary())],
                                             names=["node", "task", "tree", "tokens"])

    def sets_of(part: DataFrame) -> DataFrame:
        texts = docs.join(few_rows(part.select("chosen", "node", "task", "tree"), BROADCAST_ROWS), F.col("doc_id").eqNullSafe(F.col("chosen")))
        return texts.select("node", "task", "tree", "text").mapInArrow(run, "node bigint, task bigint, tree bigint, tokens binary")

    small = sets_of(chosen.where(F.col("sets") <= piece)).withColumn("known", F.lit(None).cast("string"))
    links = written(small.groupBy("task").applyInPandas(_task_links, "a bigint, b bigint"), "links")
    large = chosen.where(F.col("sets") > piece)
    if large.limit(1).count():
        sets = written(sets_of(large).select("node", "tokens"), "sets")
        left = large.count()
        while True:
            again = _blocks_again(sets, common)
            nodes, before = again.where(F.col("sets") > piece).select("node", "block"), left
            small, left = again.where(F.col("sets") <= piece), nodes.count()
            tasks = max(1, -(-small.count() // TASK_SETS))
            placed = small.select("node", F.pmod(F.xxhash64("block"), F.lit(tasks)).alias("task"), F.col("block").alias("tree"))
            links = links.unionByName(_run_trees(sets, few_rows(placed, BROADCAST_ROWS).withColumn("known", F.lit(None).cast("string"))))
            if not left:
                break
            sets = written(sets.join(few_rows(nodes.select("node"), BROADCAST_ROWS), "node", "left_semi"), "sets")
            if 2 * left > before:
                links = links.unionByName(_large_block_links(sets, nodes, piece))
                break

    groups = components(links)
    return info.join(groups, "node", "left").select("doc_id", "n", "node", F.coalesce("component", "node").alias("component"))


def similar_groups(docs: DataFrame, **options) -> DataFrame:
    """(doc_id, n_shingles, node, component_id) of every document. `node` identifies the shingle set; null without words."""
    grouped = _grouped(docs, **options)
    least = grouped.where("node IS NOT NULL").groupBy("component").agg(F.min("doc_id").alias("component_id"))
    return grouped.join(least, "component", "left").select("doc_id", F.col("n").alias("n_shingles"), "node",
                                                           F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """One document of each group, the one with the smallest id, with all columns; rows without words stay.

    A null id comes after all others. Of rows that share the id and the words one stays; rows that share an id but not
    the words are judged each by its own group.
    """
    id_col, text_col, width = options.get("id_col", "doc_id"), options.get("text_col", "text"), options.get("width", SHINGLE)
    grouped = written(_grouped(docs, **options).where("node IS NOT NULL").select("doc_id", "node", "component"), "grouped")
    first = grouped.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "node")).alias("f"))
    first = first.select("component", F.col("f.doc_id").alias("_id"), F.col("f.node").alias("_node"))
    shared = written(grouped.groupBy("doc_id").agg(F.count("*").alias("rows")).where("rows > 1 OR doc_id IS NULL").select(F.col("doc_id").alias("__shared")), "shared-ids")
    lost = grouped.join(first, "component").where(~(F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("node") == F.col("_node"))))
    gone = written(lost.select(F.col("doc_id").alias("__gone")).distinct(), "gone")
    if not shared.limit(1).count():
        return docs.join(few_rows(gone, 4 * BROADCAST_ROWS), docs[id_col] == F.col("__gone"), "left_anti")
    # Rows whose id does not tell them apart are told apart by their sets.
    is_shared = docs[id_col].eqNullSafe(F.col("__shared"))
    alone = docs.join(few_rows(shared, BROADCAST_ROWS), is_shared, "left_anti")
    kept = alone.join(few_rows(gone, 4 * BROADCAST_ROWS), alone[id_col] == F.col("__gone"), "left_anti")
    rows = docs.join(few_rows(shared, BROADCAST_ROWS), is_shared, "left_semi").withColumn("__node", set_info(F.col(text_col), np.zeros(0, np.uint64), width)["node"])
    rows = written(rows, "shared-rows")
    chosen = rows.join(few_rows(first.select("_id", "_node"), BROADCAST_ROWS), rows[id_col].eqNullSafe(F.col("_id")) & (F.col("__node") == F.col("_node")), "left_semi")
    return kept.unionByName(rows.where("__node IS NULL").unionByName(chosen.dropDuplicates([id_col, "__node"])).select(*docs.columns))
