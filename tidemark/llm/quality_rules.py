"""Quality rules whose cutoffs come from the corpus: quantile sketches per language and source, then a joined filter.

A sketch is a log-linear histogram of whole numbers: a value keeps its leading SKETCH_BITS bits, so a quantile is off
by at most 1 part in 2^(SKETCH_BITS - 1), and sketches merge by adding counts. They are built for every (lang, source)
from all documents by one aggregate that combines on the map side; a language's sketch is the sum of its sources', and
the corpus' the sum of all. A group's fence is drawn towards its language's, and that towards the corpus': both count
as `min_rows` documents beside the group's own, so that a document more or less changes little.

The upper fence of a metric is q75 + SPREAD * (q75 - q50) + slack: what lies far outside the better half of the
comparable documents goes, as long as junk is less than a quarter of a group. The slack only keeps a fence from
closing in where a group hardly varies. Where a quarter or more is junk, the group's own fence says nothing, so no
fence, and none that it is drawn towards, may lie above LIFT times the (lower) median of the fences of its language's
groups, and, for metrics that hardly depend on the language, of the corpus' groups. A group of n documents weighs
n / (n + min_rows) there, so a large one weighs no more than some middling ones. If half of the weight is such groups',
or there is only one, the fence is as good as theirs.

Nulls: a null text has no words and fails the base rule; null languages and sources are groups of their own.
Repeated rows are judged, and counted, one by one.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import bounded_batches, few_rows, written
from tidemark.llm.text_stats import text_counts

SKETCH_BITS, SPREAD, MIN_ROWS, BROADCAST_ROWS, LIFT = 7, 10, 200, 200_000, 2

#: Metric -> (whole number per document, slack of its fence). Shares are in thousandths.
METRICS: dict[str, tuple[str, int]] = {
    "symbol_share": ("1000 * n_symbols div greatest(word_chars, 1)", 30),
    "shout_share": ("1000 * n_shout div greatest(word_chars, 1)", 30),
    "punct_share": ("1000 * n_punct div greatest(word_chars, 1)", 100),
    "upper_share": ("1000 * n_upper div greatest(n_letters, 1)", 100),
    "repeat_share": ("1000 * n_repeat_words div greatest(n_words, 1)", 450),
    "word_length": ("100 * word_chars div greatest(n_words, 1)", 400),
}

#: Metrics whose fences are compared between languages, too.
ANY_LANGUAGE = ("symbol_share", "shout_share", "punct_share", "repeat_share")


def sketch_bin(value: Column, bits: int = SKETCH_BITS) -> Column:
    """The smallest value of the bin that a whole number >= 0 falls in."""
    drop = F.greatest(F.length(F.bin(value)) - bits, F.lit(0))
    return F.when(value < (1 << bits), value).otherwise((F.floor(value / F.pow(F.lit(2.0), drop)) * F.pow(F.lit(2.0), drop)).cast("bigint"))


def sketches(measured: DataFrame) -> DataFrame:
    """(lang, source, metric, bin, rows) of documents that carry the metrics as columns."""
    stacked = measured.select("lang", "source", F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in METRICS])).alias("s"))
    return stacked.groupBy("lang", "source", F.col("s.metric").alias("metric"), sketch_bin(F.col("s.value")).alias("bin")).agg(F.count("*").alias("rows"))


def merge(sketch: DataFrame, *groups: str) -> DataFrame:
    """The sketches of coarser groups."""
    return sketch.groupBy(*groups, "metric", "bin").agg(F.sum("rows").alias("rows"))


def fences(sketch: DataFrame, *groups: str) -> DataFrame:
    """(groups, members, fence per metric)."""
    keys = ", ".join([*groups, "metric"])
    run = sketch.selectExpr("*", f"sum(rows) OVER (PARTITION BY {keys} ORDER BY bin) AS upto", f"sum(rows) OVER (PARTITION BY {keys}) AS members")
    quantiles = run.groupBy(*groups, "metric").agg(F.max("members").alias("members"), *[
        F.min(F.when(F.col("upto") * 100 >= F.col("members") * q, F.col("bin"))).alias(f"q{q}") for q in (50, 75)])
    fence = F.col("q75") + SPREAD * (F.col("q75") - F.col("q50"))
    return quantiles.groupBy(*groups).agg(F.max("members").alias("members"), *[
        (F.max(F.when(F.col("metric") == m, fence)) + slack).alias(f"max_{m}") for m, (_, slack) in METRICS.items()])


def medians(by_source: DataFrame, min_rows: int, *groups: str) -> DataFrame:
    """(groups, b_<metric>: LIFT times the lower weighted median of the groups' fences); equal fences are summed first."""
    weight = (1_000_000 * F.col("members") / (F.col("members") + min_rows)).cast("bigint")
    stacked = by_source.select(*groups, weight.alias("weight"), F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(f"s_max_{m}").alias("fence")) for m in METRICS])).alias("f"))
    summed = stacked.groupBy(*groups, "f.metric", "f.fence").agg(F.sum("weight").alias("weight"))
    keys = ", ".join([*groups, "metric"])
    run = summed.selectExpr("*", f"sum(weight) OVER (PARTITION BY {keys} ORDER BY fence) AS upto", f"sum(weight) OVER (PARTITION BY {keys}) AS total")
    half = run.where(2 * F.col("upto") >= F.col("total"))
    return half.groupBy(*groups).agg(*[(LIFT * F.min(F.when(F.col("metric") == m, F.col("fence")))).alias(f"b_max_{m}") for m in METRICS])


def thresholds(measured: DataFrame, min_rows: int = MIN_ROWS) -> DataFrame:
    """One row per (lang, source): whose documents weigh most in its fences (level), and the fences."""
    own = written(sketches(measured), "sketches")
    names = [f"max_{m}" for m in METRICS]
    by_source = written(fences(own, "lang", "source").select("lang", "source", "members", *[F.col(n).alias(f"s_{n}") for n in names]), "fences")
    by_lang = fences(merge(own, "lang"), "lang").select(F.col("lang").alias("l_lang"), F.col("members").alias("l_members"), *[F.col(n).alias(f"l_{n}") for n in names])
    overall, bound = fences(merge(own)).first(), medians(by_source, min_rows).first()  # a row of numbers each
    bounds = medians(by_source, min_rows, "lang").withColumnRenamed("lang", "b_lang")
    level = F.when(F.col("members") >= min_rows, "source").when(F.col("l_members") >= min_rows, "lang").otherwise("all")
    joined = by_source.join(by_lang, F.col("lang").eqNullSafe(F.col("l_lang"))).join(bounds, F.col("lang").eqNullSafe(F.col("b_lang")))
    any_language = {f"max_{m}" for m in ANY_LANGUAGE}

    def limit(n: str) -> Column:
        def bounded(fence: Column) -> Column:
            return F.least(fence, F.col(f"b_{n}"), F.lit(bound[f"b_{n}"] if n in any_language else None).cast("bigint"))  # passes nulls over

        def drawn(fence: Column, members: Column, towards: Column) -> Column:
            return ((fence * members + towards * min_rows) / (members + min_rows)).cast("bigint")

        of_lang = drawn(bounded(F.col(f"l_{n}")), F.col("l_members"), bounded(F.lit(overall[n])))
        return drawn(bounded(F.col(f"s_{n}")), F.col("members"), of_lang)

    return joined.select("lang", "source", level.alias("level"), *[limit(n).alias(n) for n in names])


def measure(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """`docs` with a struct column __m: the text's counts, metrics and the base rule."""
    bounded_batches(docs.sparkSession)
    counted = docs.withColumn("__c", text_counts(F.col(text_col)))
    fields = counted.select("__c.*").columns
    expr = {m: e for m, (e, _) in METRICS.items()} | {"base_failed": "n_words < 50 OR 100 * n_repeat_words > 50 * n_words"}
    with_c = ", ".join(f"'{f}', __c.{f}" for f in fields)
    made = ", ".join(f"'{m}', {_on(e, fields)}" for m, e in expr.items())
    return counted.withColumn("__m", F.expr(f"named_struct({with_c}, {made})")).drop("__c")


def _on(expr: str, fields: list[str]) -> str:
    return re.sub(rf"\b({'|'.join(fields)})\b", r"__c.\1", expr)


def judge(measured: DataFrame, limits: DataFrame) -> DataFrame:
    """`measured` (columns lang, source, the metrics, base_failed) with kept, broken (names of the rules) and level."""
    right = few_rows(limits.withColumnsRenamed({"lang": "__lang", "source": "__source"}), BROADCAST_ROWS)
    joined = measured.join(right, F.col("lang").eqNullSafe(F.col("__lang")) & F.col("source").eqNullSafe(F.col("__source")), "left")
    broken = F.filter(F.array(*[F.when(F.col(m) > F.col(f"max_{m}"), F.lit(m)) for m in METRICS]), lambda x: x.isNotNull())
    return joined.withColumn("broken", broken).withColumn("kept", ~F.col("base_failed") & (F.size("broken") == 0)).drop("__lang", "__source")


def apply_rules(docs: DataFrame, min_rows: int = MIN_ROWS) -> DataFrame:
    """(doc_id, counts, metrics, base_failed, fences, broken, kept, level) of every document; texts are read once."""
    narrow = written(measure(docs.select("doc_id", "lang", "source", "text")).select("doc_id", "lang", "source", "__m.*"), "measures")
    return judge(narrow, thresholds(narrow, min_rows))


def clean(docs: DataFrame, min_rows: int = MIN_ROWS) -> DataFrame:
    """The documents that the rules keep, with all of their columns. Texts are read twice instead of shuffled."""
    limits = written(thresholds(measure(docs.select("lang", "source", "text")).select("lang", "source", "__m.*"), min_rows), "thresholds")
    measured = measure(docs)
    own = measured.select(F.struct(*[measured[c] for c in docs.columns]).alias("__row"), measured["lang"], measured["source"], "__m.*")
    return judge(own, limits).where("kept").select("__row.*")
