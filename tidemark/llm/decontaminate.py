"""Benchmark decontamination: a prefix-filtered set join of item windows with documents, in DataFrame functions only.

A window is `window` consecutive item words (a shorter item is one window). Seen as a set of word shingles, a window
is contained in a document only if all of its shingles are, so the necessary prefix is one shingle: the rarest one in
the documents. The steps:

1. count the items' shingles over all documents (combined on the map side, so common ones stay small);
2. order every window's shingles by rarity. A window with a shingle that no document has cannot occur and is dropped,
   the others keep the first shingle of that order as their prefix;
3. join the documents' shingles with the prefixes. Where one meets, its place in the window fixes where the window
   would start and end: outside the document (the positional and length bound) it is no candidate;
4. compare the candidates word by word over the whole window.

Texts are read three times, and only the hits are shuffled. The prefixes are broadcast if they number at most
`broadcast_rows`; above that the join is shuffled and candidates are verified after a second join with the documents.

Nulls and empty texts have no words. Rows with equal id and text get the same result, one row each; items without id
count as hits but are not listed. Repeated items and windows count once.
"""

from __future__ import annotations

import string
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import written

#: Everything in ASCII but digits and lower-case letters; applied to folded text.
BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW, SHINGLE, BROADCAST_ROWS = 10, 3, 500_000


def folded_words(text: Column) -> Column:
    """Words of a text with A-Z in lower case; an empty string stands first or last where the text begins or ends with a break."""
    text = F.coalesce(text, F.lit(""))
    fold = F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase))
    return F.split(fold, BREAKS)


def _shingle(words: Column, at: Column, width: int) -> Column:
    return F.xxhash64(*[F.get(words, at + k) for k in range(width)])


def item_windows(items: DataFrame, window: int, id_col: str, text_col: str) -> DataFrame:
    """(item_id, content, n): every window of every item, its words joined by spaces."""
    words = items.select(F.col(id_col).cast("string").alias("item_id"), F.filter(folded_words(F.col(text_col)), lambda w: w != "").alias("words"))
    sized = words.where("size(words) > 0").withColumn("n", F.least(F.lit(window), F.size("words")))
    return sized.select("item_id", "n", F.explode(F.expr("transform(sequence(0, size(words) - n), i -> array_join(slice(words, i + 1, n), ' '))")).alias("content")).distinct()


def window_shingles(windows: DataFrame, width: int) -> DataFrame:
    """(content, n, width, at, token): the shingles of every distinct window; a window of fewer words has one of its length."""
    parts = windows.select("content", "n").distinct().withColumn("words", F.split("content", " ")).withColumn("width", F.least(F.lit(width), "n"))
    placed = parts.select("*", F.explode(F.sequence(F.lit(0), F.col("n") - F.col("width"))).alias("at"))
    token = reduce(lambda rest, k: F.when(F.col("width") == k, _shingle(F.col("words"), F.col("at"), k)).otherwise(rest), range(1, width + 1), F.lit(None).cast("bigint"))
    return placed.select("content", "n", "width", "at", token.alias("token"))


def _tokens(docs: DataFrame, width: int) -> DataFrame:
    """(doc_id, text_key, words, pos, token): the documents' shingles of one width.

    Rows carry the words of their document only within one stage: whoever uses this must join or drop before a shuffle or union.
    """
    spread = docs.select("doc_id", "text_key", "words", F.posexplode("words").alias("pos", "word")).where(F.col("pos") + width <= F.size("words"))
    return spread.select("doc_id", "text_key", "words", "pos", F.xxhash64("word", *[F.get("words", F.col("pos") + k) for k in range(1, width)]).alias("token"))


def _hits(docs: DataFrame, windows: DataFrame, width: int, broadcast_rows: int) -> DataFrame | None:
    """(doc_id, text_key, start, n, content): every occurrence of a window in a document."""
    shingles = written(window_shingles(windows, width), "shingles")
    widths = sorted(r.width for r in shingles.select("width").distinct().collect())  # 1 to `width` at most
    if not widths:
        return None

    def each(of) -> DataFrame:
        return reduce(DataFrame.unionByName, map(of, widths))

    wanted = shingles.select("width", "token").distinct()
    small = wanted.limit(broadcast_rows + 1).count() <= broadcast_rows
    hint = F.broadcast if small else lambda df: df
    seen = each(lambda k: _tokens(docs, k).select("token").join(hint(wanted.where(F.col("width") == k)), "token").groupBy("width", "token").agg(F.count("*").alias("times")))
    ordered = shingles.join(seen, ["width", "token"], "left").groupBy("content", "n").agg(
        F.min(F.struct(F.coalesce("times", F.lit(0)).alias("times"), "at", "width", "token")).alias("rarest"))
    prefixes = written(ordered.where("rarest.times > 0").select("content", "n", "rarest.at", "rarest.width", "rarest.token"), "prefixes")

    start = F.col("pos") - F.col("at")
    same = F.array_join(F.slice("words", F.col("start") + 1, F.col("n")), " ") == F.col("content")
    if small:
        return each(lambda k: _tokens(docs, k).join(hint(prefixes.where(F.col("width") == k)), "token").withColumn("start", start).where(
            (F.col("start") >= 0) & (F.col("start") + F.col("n") <= F.size("words"))).where(same).select("doc_id", "text_key", "start", "n", "content"))
    near = each(lambda k: _tokens(docs, k).select("doc_id", "text_key", F.size("words").alias("size"), "pos", "token").join(
        prefixes.where(F.col("width") == k), "token").withColumn("start", start).where("start >= 0 AND start + n <= size"))
    at = near.groupBy("doc_id", "text_key").agg(F.collect_set(F.struct("start", "n", "content")).alias("places"))
    whole = docs.alias("d").join(at.alias("c"), F.col("d.doc_id").eqNullSafe(F.col("c.doc_id")) & (F.col("d.text_key") == F.col("c.text_key")))
    there = F.filter("c.places", lambda p: F.array_join(F.slice(F.col("d.words"), p["start"] + 1, p["n"]), " ") == p["content"])
    return whole.select("d.doc_id", "d.text_key", F.explode(there).alias("p")).select("doc_id", "text_key", "p.*")


def decontaminate(docs: DataFrame, items: DataFrame, window: int = WINDOW, width: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text",
                  item_id_col: str = "item_id", item_text_col: str = "text", broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """One row per document: doc_id, text_key, n_words, n_hit, spans (start, n of merged hits in words), items (sorted ids)."""
    keyed = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(F.coalesce(text_col, F.lit(""))).alias("text_key"), folded_words(F.col(text_col)).alias("words"))
    ends = (F.element_at("words", 1) == "").cast("int") + ((F.size("words") > 1) & (F.element_at("words", -1) == "")).cast("int")
    counted = keyed.select("doc_id", "text_key", (F.size("words") - ends).cast("bigint").alias("n_words"))
    windows = written(item_windows(items, window, item_id_col, item_text_col), "windows")
    hits = _hits(keyed, windows, width, broadcast_rows)
    if hits is None:
        return counted.select("*", F.lit(0).cast("bigint").alias("n_hit"), F.expr("cast(array() AS array<struct<start:int,n:int>>)").alias("spans"),
                              F.expr("cast(array() AS array<string>)").alias("items"))
    found = written(hits.select("doc_id", "text_key", "start", "n", F.xxhash64("content").alias("window_key")).distinct(), "hits")
    merged = F.aggregate(
        F.array_sort(F.collect_set(F.struct("start", "n"))), F.expr("cast(array() AS array<struct<start:int,n:int>>)"),
        lambda done, x: F.when((F.size(done) > 0) & (x["start"] <= F.element_at(done, -1)["start"] + F.element_at(done, -1)["n"]),
                               F.concat(F.slice(done, F.lit(1), F.size(done) - 1), F.array(F.struct(
                                   F.element_at(done, -1)["start"].alias("start"),
                                   (F.greatest(F.element_at(done, -1)["start"] + F.element_at(done, -1)["n"], x["start"] + x["n"]) - F.element_at(done, -1)["start"]).alias("n")))))
        .otherwise(F.concat(done, F.array(x))))
    spans = found.groupBy("doc_id", "text_key").agg(merged.alias("spans"))
    named = windows.where("item_id IS NOT NULL").select("item_id", F.xxhash64("content").alias("window_key"))
    listed = found.select("doc_id", "text_key", "window_key").distinct().join(named, "window_key").groupBy("doc_id", "text_key").agg(
        F.array_sort(F.collect_set("item_id")).alias("items"))

    def joined(left: DataFrame, right: DataFrame) -> DataFrame:
        right = right.withColumnsRenamed({"doc_id": "r_id", "text_key": "r_key"})
        return left.join(right, F.col("doc_id").eqNullSafe(F.col("r_id")) & (F.col("text_key") == F.col("r_key")), "left").drop("r_id", "r_key")

    return joined(counted, joined(spans, listed)).select(
        "doc_id", "text_key", "n_words",
        F.coalesce(F.aggregate("spans", F.lit(0).cast("bigint"), lambda a, x: a + x["n"]), F.lit(0).cast("bigint")).alias("n_hit"),
        F.coalesce("spans", F.expr("cast(array() AS array<struct<start:int,n:int>>)")).alias("spans"),
        F.coalesce("items", F.expr("cast(array() AS array<string>)")).alias("items"))


def digest(result: DataFrame) -> DataFrame:
    """The contract's columns."""
    return result.select("doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
                         F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def clean(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The documents without a hit, with all of their columns."""
    id_col, text_col = options.get("id_col", "doc_id"), options.get("text_col", "text")
    bad = decontaminate(docs, items, **options).where("n_hit > 0").select(F.col("doc_id").alias("__id"), F.col("text_key").alias("__key")).distinct()
    same = docs[id_col].eqNullSafe(bad["__id"]) & (F.xxhash64(F.coalesce(docs[text_col], F.lit(""))) == bad["__key"])
    return docs.join(bad, same, "left_anti")
