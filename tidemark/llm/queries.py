"""The operators' queries over the given tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (bpe, collocations, decontaminate, extract, language, line_dedup, merkle, ngram_join, quality_classifier, quality_rules, sharding,
                          token_files, warc)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op8_sharding(spark, sf_dir):
    return sharding.shard(table(spark, sf_dir, "documents"), 24)


@query
def op1_decontamination(spark, sf_dir):
    return decontaminate.digest(decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


@query
def op9_quality_rules(spark, sf_dir):
    return quality_rules.apply_rules(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "broken", "level")


@query
def op5_bpe(spark, sf_dir):
    return bpe.round_trip(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


@query
def op3_token_files(spark, sf_dir):
    return token_files.read_digests(token_files.write_token_files(table(spark, sf_dir, "documents")))


@query
def op4_warc(spark, sf_dir):
    index = warc.build_index(warc.write_archives(table(spark, sf_dir, "pages")))
    return warc.read_archives(index, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query
def op7_ngram_join(spark, sf_dir):
    return ngram_join.similar_groups(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


@query
def op2_language(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    network = language.train(docs)
    return language.identify(docs.select("doc_id", "text", language.held_out(docs["doc_id"]).alias("held_out")), network).select("doc_id", "held_out", "lang_pred", "score")


@query
def op10_quality_classifier(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return quality_classifier.classify(docs.select("doc_id", "text"), quality_classifier.train(docs)).drop("text")


@query
def op6_extraction(spark, sf_dir):
    return extract.extract(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


@query
def op11_line_dedup(spark, sf_dir):
    return line_dedup.dedup_lines(table(spark, sf_dir, "documents")).select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


@query
def op12_collocations(spark, sf_dir):
    return collocations.collocations(table(spark, sf_dir, "documents"))


@query
def op13_merkle_manifest(spark, sf_dir):
    return merkle.proof_digests(table(spark, sf_dir, "documents"))


# --- SQL counterparts --------------------------------------------------------------------------------------

_FOLD = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE["op1_decontamination"] = f"""
WITH d AS MATERIALIZED (SELECT doc_id, regexp_extract_all({_FOLD}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all({_FOLD}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
sized AS (SELECT item_id, w, least(10, len(w)) AS n FROM b WHERE len(w) > 0),
windows AS MATERIALIZED (SELECT DISTINCT item_id, n, array_to_string(w[i + 1:i + n], ' ') AS s FROM sized, unnest(range(0, len(w) - n + 1)) AS t(i)),
places AS (SELECT doc_id, n, i, array_to_string(w[i + 1:i + n], ' ') AS s
           FROM d, (SELECT DISTINCT n FROM windows), unnest(range(0, len(w) - n + 1)) AS t(i)),
hits AS MATERIALIZED (SELECT DISTINCT doc_id, i, n, item_id FROM places JOIN windows USING (n, s)),
covered AS (SELECT doc_id, count(DISTINCT i + k) AS n_hit FROM hits, unnest(range(0, n)) AS t(k) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS varchar) AS item FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS bigint) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)"""

ORACLE["op7_ngram_join"] = f"""
WITH RECURSIVE d AS MATERIALIZED (SELECT doc_id, regexp_extract_all({_FOLD}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS MATERIALIZED (SELECT DISTINCT doc_id, array_to_string(w[i + 1:i + 5], ' ') AS g
                   FROM d, unnest(range(0, greatest(1, len(w) - 4))) AS t(i) WHERE len(w) > 0),
size AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS o FROM s x JOIN s y USING (g) WHERE x.doc_id <> y.doc_id GROUP BY ALL),
link AS MATERIALIZED (SELECT a, b FROM pairs JOIN size p ON p.doc_id = a JOIN size q ON q.doc_id = b WHERE 100 * o >= 75 * (p.n + q.n - o)),
reach AS (SELECT doc_id, doc_id AS seen FROM d UNION SELECT reach.doc_id, link.b FROM reach JOIN link ON link.a = reach.seen)
SELECT d.doc_id, coalesce(any_value(size.n), 0) AS n_shingles, min(seen) AS component_id
FROM d JOIN reach USING (doc_id) LEFT JOIN size USING (doc_id) GROUP BY d.doc_id"""

ORACLE["op11_line_dedup"] = """
WITH d AS MATERIALIZED (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT doc_id, i, lines[i] AS line, translate(trim(lines[i], ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
      FROM d, unnest(range(1, len(lines) + 1)) AS t(i)),
f AS (SELECT k, max(doc_id) AS last FROM l WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT doc_id) >= 3)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (last > doc_id) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (last IS NULL OR last <= doc_id), '')) AS kept_sha256
FROM l LEFT JOIN f USING (k) GROUP BY doc_id"""

ORACLE["op12_collocations"] = f"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, doc_id, unnest(string_split_regex({_FOLD}, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
w AS MATERIALIZED (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM p),
grams AS MATERIALIZED (SELECT lang, m, array_to_string(w[i + 1:i + m], ' ') AS g, count(*) AS f
                       FROM w, unnest(range(1, 6)) AS s(m), unnest(range(0, len(w) - m + 1)) AS t(i) GROUP BY ALL),
total AS (SELECT lang, CAST(sum(f) AS bigint) AS n FROM grams WHERE m = 1 GROUP BY lang),
often AS MATERIALIZED (SELECT * FROM grams WHERE f >= 100),
cand AS MATERIALIZED (SELECT lang, m, g, f AS a, string_split(g, ' ') AS ws FROM often WHERE m > 1),
cuts AS (SELECT c.lang, c.m, c.g, a, n, k, x.f AS l, y.f AS r, (1000::hugeint * a * n) // (x.f::hugeint * y.f) AS score
         FROM cand c, unnest(range(1, 5)) AS t(k), often x, often y, total
         WHERE k < c.m AND x.lang = c.lang AND y.lang = c.lang AND total.lang = c.lang
           AND x.g = array_to_string(ws[1:k], ' ') AND y.g = array_to_string(ws[k + 1:], ' ')),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1),
kept AS (SELECT * FROM best b WHERE NOT EXISTS (
  SELECT 1 FROM cand e WHERE e.lang = b.lang AND e.m > b.m AND 100 * e.a >= 100 * b.a AND contains(' ' || e.g || ' ', ' ' || b.g || ' ')))
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, g) AS rank, g AS phrase, a, l, r, n, CAST(score AS bigint) AS score
FROM kept QUALIFY rank <= 2000"""

_FIELD = "coalesce(CAST(octet_length(encode({v})) AS varchar) || ':' || {v}, '-')"
_LEAF = ("sha256(" + " || ".join(_FIELD.format(v=v) for v in ("CAST(doc_id AS varchar)", "source", "lang", "CAST(n_chars AS varchar)", "{text}")) + ")")
#: CRC-32 bit by bit (fixed polynomial 0xEDB88320), of the ASCII digits of an id.
_CRC = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS varchar), ''), lambda c: ascii(c)::BIGINT)),
        lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda x, i: xor(x >> 1, CASE WHEN x % 2 = 1 THEN 3988292384 ELSE 0 END))))"""

ORACLE["op13_merkle_manifest"] = f"""
WITH RECURSIVE leaf AS MATERIALIZED (
  SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST) - 1 AS pos, {_LEAF.format(text="text")} AS leaf,
         CASE WHEN {_CRC} % 2 = 0 THEN {_LEAF.format(text="replace(text, chr(10), '')")} ELSE {_LEAF.format(text="text")} END AS shown
  FROM documents),
sizes AS MATERIALIZED (SELECT source, count(*) AS n, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS tree FROM leaf GROUP BY source),
nodes AS (
  SELECT tree, 0 AS level, pos, leaf AS d, n FROM leaf JOIN sizes ON leaf.source IS NOT DISTINCT FROM sizes.source
  UNION ALL
  SELECT tree, level + 1, pos // 3, sha256(string_agg(d, '' ORDER BY pos)), (n + 2) // 3 FROM nodes WHERE n > 1 GROUP BY tree, level, pos // 3, n),
kept AS MATERIALIZED (SELECT * FROM nodes),
subroot AS MATERIALIZED (SELECT tree, d FROM kept WHERE n = 1),
above AS (
  SELECT 0 AS level, tree AS pos, d, (SELECT count(*) FROM subroot) AS n FROM subroot
  UNION ALL
  SELECT level + 1, pos // 3, sha256(string_agg(d, '' ORDER BY pos)), (n + 2) // 3 FROM above WHERE n > 1 GROUP BY level, pos // 3, n),
high AS MATERIALIZED (SELECT * FROM above),
every AS MATERIALIZED (SELECT tree, level, pos, d, n FROM kept WHERE n > 1 UNION ALL SELECT -1, level, pos, d, n FROM high WHERE n > 1),
runs AS MATERIALIZED (SELECT tree, level, pos // 3 AS run, list(d ORDER BY pos) AS ds, n FROM every GROUP BY ALL),
way AS (
  SELECT doc_id, sizes.tree AS home, sizes.tree, pos, 0 AS level, n, shown AS folded, '' AS siblings
  FROM leaf JOIN sizes ON leaf.source IS NOT DISTINCT FROM sizes.source
  UNION ALL
  SELECT doc_id, home, CASE WHEN way.n > 1 THEN way.tree ELSE -1 END, CASE WHEN way.n > 1 THEN way.pos // 3 ELSE home END, CASE WHEN way.n > 1 THEN way.level + 1 ELSE 0 END,
         CASE WHEN way.n > 1 THEN (way.n + 2) // 3 ELSE (SELECT count(*) FROM subroot) END,
         CASE WHEN way.n > 1 THEN sha256(array_to_string(ds[1:way.pos % 3], '') || folded || array_to_string(ds[way.pos % 3 + 2:], '')) ELSE folded END,
         siblings || CASE WHEN way.n > 1 THEN array_to_string(ds[1:way.pos % 3], '') || array_to_string(ds[way.pos % 3 + 2:], '') ELSE '' END
  FROM way LEFT JOIN runs ON runs.tree = way.tree AND runs.level = way.level AND runs.run = way.pos // 3 AND way.n > 1
  WHERE way.n > 1 OR way.tree >= 0)
SELECT doc_id, leaf.leaf, subroot.d AS subroot, root.d AS root, sha256(siblings) AS proof_sha256, folded AS folded_root, folded = root.d AS verified, leaf.source
FROM way JOIN leaf USING (doc_id) JOIN subroot ON subroot.tree = way.home, (SELECT d FROM high WHERE n = 1) AS root
WHERE way.tree = -1 AND way.n = 1"""
