"""Line dedup, collocations and Merkle proofs against plain versions: nulls, empty and long texts, ties, repeats, clashing names."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import collocations, line_dedup, merkle

#: Columns that the operators use for results of their own come along.
DOCS = "doc_id bigint, source string, lang string, n_chars bigint, text string, key string, at string, n bigint, h string, part string, gone string"


def docs_of(spark, rows):
    """`rows`: (doc_id, source, lang, text)."""
    return spark.createDataFrame([(i, s, g, None if t is None else len(t), t, "k", "a", 1, "h", "p", "g") for i, s, g, t in rows], DOCS)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# --- 11 ------------------------------------------------------------------------------------------------------

def plain_key(line):
    key = re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(" \t\n\x0b\x0c\r"))
    return key if len(key) >= 20 else None


def plain_dedup(rows):
    holders = collections.defaultdict(list)
    for i, _, _, text in rows:
        for key in {plain_key(line) for line in (text or "").split("\n")} - {None}:
            holders[key].append(float("-inf") if i is None else i)
    out = []
    for i, _, _, text in rows:
        lines = (text or "").split("\n")
        me = float("-inf") if i is None else i
        kept = [x for x in lines if (k := plain_key(x)) is None or len(holders[k]) < 3 or max(holders[k]) == me]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def lines():
    draw = random.Random(3)
    pool = [f"a shared line, number {i}: " + "x" * (i % 7) for i in range(25)] + ["short", "", "  ", "Übermäßig ähnliche Zeile ö", "exactly twenty chars", "nineteen characters"]
    rows = []
    for i in range(60):
        chosen = [draw.choice(pool) for _ in range(draw.randint(0, 9))]
        text = "\n".join(x.upper() if draw.random() < 0.2 else f"\t {x}\r" if draw.random() < 0.2 else x for x in chosen)
        rows.append((draw.randrange(-5, 80), "s", "en", text))
    rows += [(None, "s", "en", pool[0] + "\n" + pool[3]), (7, "s", "en", None), (8, "s", "en", ""), (None, None, None, None)]
    rows += [(400, "s", "en", pool[1] + "\nown\n" + pool[1]), (400, "s", "en", pool[1] + "\nown\n" + pool[1])]  # repeated row, largest id
    rows.append((3, "s", "en", "\n".join(f"line {k % 900} of a very long text" for k in range(30_000))))
    return rows


@pytest.mark.parametrize("batches", [1, 4, 7])
def test_line_dedup(spark, lines, batches):
    docs = docs_of(spark, lines).repartition(5)
    got = line_dedup.dedup_lines(docs, batches=batches)
    assert sorted(map(tuple, got.collect()), key=repr) == plain_dedup(lines)


def test_no_key_is_in_two_runs(spark):
    """Every key is held once, by the first batch that has it; levels hold at most two runs."""
    draw = random.Random(8)
    runs, first, docs = line_dedup.LineRuns(spark, 4), {}, collections.Counter()
    for batch in range(5):
        own = {bytes([draw.randrange(40)]) * 16: draw.randint(1, 3) for _ in range(12)}
        for key, n in own.items():
            first.setdefault(key, 100 - batch)
            docs[key] += n
        runs.add(spark.createDataFrame([(k, n, 100 - batch) for k, n in own.items()], "key binary, docs bigint, last bigint"))
        assert all(len(level) <= 2 for level in runs.levels)
    held = [bytes(r.key) for run in runs.runs() for r in run.collect()]
    assert sorted(held) == sorted(first)
    assert {bytes(r.key): r.last for r in runs.frequent(3).collect()} == {k: first[k] for k, n in docs.items() if n >= 3}
    assert len(runs.runs()) < 5
    runs.forget()


def test_line_dedup_of_nothing(spark):
    assert line_dedup.dedup_lines(docs_of(spark, [])).collect() == []


# --- 12 ------------------------------------------------------------------------------------------------------

def plain_collocations(rows, least, top, longest=5):
    counts, total = collections.defaultdict(collections.Counter), collections.Counter()
    for _, _, lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n-\r]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            words = re.findall("[^ \t]+", piece)
            total[lang] += len(words)
            for m in range(1, longest + 1):
                counts[lang].update(tuple(words[i:i + m]) for i in range(len(words) - m + 1))
    out = []
    for lang, f in counts.items():
        candidates = {g: n for g, n in f.items() if len(g) > 1 and n >= least}
        kept = []
        for g, a in candidates.items():
            if any(len(e) > len(g) and n >= a and any(e[i:i + len(g)] == g for i in range(len(e) - len(g) + 1)) for e, n in candidates.items()):
                continue
            score, k = min((1000 * a * total[lang] // (f[g[:k]] * f[g[k:]]), k) for k in range(1, len(g)))
            kept.append((-score, -a, " ".join(g).encode(), f[g[:k]], f[g[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, total[lang], -score))
    return sorted(out)


@pytest.fixture(scope="module")
def phrases():
    draw = random.Random(4)
    fixed = ["the quick brown fox", "In Due Course", "été à la mer", "a b a b a b", "日本 語 🙂"]
    rows = []
    for i in range(80):
        parts = [draw.choice(fixed) if draw.random() < 0.5 else " ".join(draw.choice("uvwxyz") for _ in range(draw.randint(1, 6))) for _ in range(draw.randint(0, 8))]
        rows.append((i, "s", draw.choice(["en", "fr", None, "und"]), draw.choice([" ", ", ", "\n", " \t"]).join(parts)))
    rows += [(90, "s", "en", None), (91, "s", "en", ""), (92, "s", "en", " .,; \n"), (None, "s", "xx", "once only"), rows[0], rows[0]]
    rows.append((93, "s", "en", "red green blue " * 3_000))
    return rows


@pytest.mark.parametrize(("shard_words", "top"), [(60, 2000), (1_000_000, 7)])
def test_collocations(spark, phrases, shard_words, top):
    docs = docs_of(spark, phrases).repartition(3)
    got = collocations.collocations(docs, least=4, top=top, shard_words=shard_words)
    assert sorted(map(tuple, got.collect())) == plain_collocations(phrases, 4, top)


@pytest.mark.parametrize("ranges", [1, 5])
def test_sums_of_phrases_are_packed_by_ranges(spark, phrases, ranges):
    """Rows that leave the tasks follow the number of tasks and ranges, not that of phrases."""
    docs = docs_of(spark, phrases).selectExpr("coalesce(lang, 'und') AS lang", "text").repartition(3)
    _, want, shards = collocations.phrase_counts(docs, 4, shard_words=60)
    bits = [np.full(collocations.BITS // 8, 255, np.uint8)] * 4
    found = collocations.frequent_phrases(shards, bits, 4, ranges).collect()
    assert sorted((r.lang, r.g, r.a) for r in found) == sorted((r.lang, r.g, r.a) for r in want.collect())
    blocks = collocations.phrase_blocks(shards, bits, ranges)
    rows = blocks.collect()
    assert len(rows) <= blocks.rdd.getNumPartitions() * ranges * len({(r.lang, r.width) for r in rows})
    assert sum(len(r.n) // 8 for r in rows) > 10 * len(rows) if ranges == 1 else {r.part for r in rows} == set(range(5))


def test_collocations_of_nothing(spark):
    assert collocations.collocations(docs_of(spark, [])).collect() == []
    assert collocations.collocations(docs_of(spark, [(1, "s", "en", "a b c"), (2, "s", None, None)])).collect() == []


def test_collocations_of_one_language_only(spark):
    """The shard of `de` has frequent neighbours, but none of its words is in a phrase of the result."""
    de = [(10 + i, "s", "de", " ".join(f"w{i} w{j}." for j in range(5))) for i in range(5)]
    docs = docs_of(spark, [(i, "s", "en", "a b") for i in range(4)] + de).coalesce(1)
    assert [tuple(r) for r in collocations.collocations(docs, least=4).collect()] == [("en", 1, "a b", 4, 4, 4, 8, 2000)]


def test_scores_beyond_64_bits(spark):
    """1000 * a * n passes 2^64; the floor is that of whole numbers."""
    a, n, left, right = 10 ** 11 + 7, 9 * 10 ** 14 + 1, 10 ** 12 + 3, 10 ** 13 + 9
    words = spark.createDataFrame([("en", 1, left), ("en", 2, right), ("en", None, n)], "lang string, h bigint, n bigint")
    found = spark.createDataFrame([("en", [1, 2], a)], "lang string, g array<bigint>, a bigint")
    assert collocations.scored(words, found).first()["score"] == 1000 * a * n // (left * right)


def test_index_extends_both_ways():
    draw = random.Random(1)
    for _ in range(60):
        kinds, ids = draw.randint(1, 5), [0]
        for _ in range(draw.randint(1, 8)):
            ids += [draw.randint(1, kinds) for _ in range(draw.randint(1, 12))] + [0]
        ids = np.array(ids)
        index = collocations.Index(collocations.transform(ids, 5).astype(np.uint16), collocations.transform(ids[::-1].copy(), 5).astype(np.uint16), kinds)
        of, word, low, back, size = index.left(*index.words())
        grams = np.stack([word, of + 1], axis=1)
        for width in range(2, 6):
            want = collections.Counter(g for i in range(len(ids) - width + 1) if 0 not in (g := tuple(ids[i:i + width].tolist())))
            assert {tuple(g): n for g, n in zip(grams.tolist(), size.tolist(), strict=True)} == dict(want) and len(want) == len(grams)
            if width % 2:
                of, word, low, back, size = index.left(low, back, size)
                grams = np.concatenate([word[:, None], grams[of]], axis=1)
            else:
                of, word, low, back, size = index.right(low, back, size)
                grams = np.concatenate([grams[of], word[:, None]], axis=1)


# --- 13 ------------------------------------------------------------------------------------------------------

def plain_leaf(i, source, lang, chars, text):
    fields = ["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (i, source, lang, chars, text)]
    return sha("".join(fields))


def plain_tree(nodes):
    """Levels from the leaves to the last node."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([sha("".join(levels[-1][i:i + 3])) for i in range(0, len(levels[-1]), 3)])
    return levels


def plain_proofs(rows):
    groups = collections.defaultdict(list)
    for i, source, lang, text in rows:
        chars = None if text is None else len(text)
        broken = i is not None and zlib.crc32(str(i).encode()) % 2 == 0
        shown = text.replace("\n", "") if broken and text is not None else text
        groups[source].append((i, plain_leaf(i, source, lang, chars, text), plain_leaf(i, source, lang, chars, shown)))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in order:
        groups[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        trees[s] = plain_tree([leaf for _, leaf, _ in groups[s]])
    top = plain_tree([trees[s][-1][0] for s in order])

    def climb(levels, at, digest, siblings):
        for level in levels[:-1]:
            first = at - at % 3
            left, right = level[first:at], level[at + 1:first + 3]
            siblings += left + right
            digest = sha("".join([*left, digest, *right]))
            at //= 3
        return digest

    out = []
    for k, s in enumerate(order):
        for at, (i, leaf, shown) in enumerate(groups[s]):
            siblings = []
            folded = climb(top, k, climb(trees[s], at, shown, siblings), siblings)
            out.append((i, leaf, trees[s][-1][0], top[-1][0], sha("".join(siblings)), folded, folded == top[-1][0], s))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def tables():
    draw = random.Random(6)
    rows = [(i, draw.choice(["a", "a", "a", "b", "ÿ", None, f"only {i}"]), draw.choice(["en", None]), draw.choice([None, "", "x\ny", "plain", "ü\n\n" * 5])) for i in range(150)]
    rows += [(None, "a", "en", "no id"), (None, "a", "en", None), (5, "a", "en", "same id"), (9, "b", "en", "twice\n"), (9, "b", "en", "twice\n"), (500, "long", "en", "word\n" * 50_000)]
    return rows


@pytest.mark.parametrize(("leaves", "levels"), [(10, 1), (20_000, 8)])
def test_proofs(spark, tables, monkeypatch, leaves, levels):
    monkeypatch.setattr(merkle, "PART_LEAVES", leaves)
    monkeypatch.setattr(merkle, "BLOCK_LEVELS", levels)
    got = merkle.proof_digests(docs_of(spark, tables).repartition(4))
    assert sorted(map(tuple, got.collect()), key=repr) == plain_proofs(tables)


def test_proofs_of_some_rows_fetch_only_what_they_need(spark, tables):
    manifest = merkle.build_manifest(docs_of(spark, tables))
    some = manifest.leaves.where("source = 'a' AND doc_id % 7 = 1")
    proofs = merkle.prove(manifest, some, with_proof=True).collect()
    assert len(proofs) == some.count() > 3 and all(p.verified for p in proofs)
    for p in proofs:
        way = [([bytes(d) for d in step.left], [bytes(d) for d in step.right]) for step in p.proof]
        assert merkle.fold(bytes(p.leaf), way) == manifest.root
        assert merkle.fold(b"x" * 32, way) != manifest.root


def test_union_of_missing_nodes_is_least():
    """Leaves 0 to 2 and 4 of 10: siblings inside the first run and shared interiors are derived, not fetched."""
    wanted, known = merkle.missing(np.array([0, 1, 2, 4]), 10)
    assert [(level, at.tolist()) for level, at in wanted] == [(0, [3, 5]), (1, [2]), (2, [1])]
    assert [at.tolist() for at in known] == [[0, 1, 2, 4], [0, 1], [0], [0]]


def test_proofs_of_nothing(spark):
    assert merkle.proof_digests(docs_of(spark, [])).collect() == []
    one = merkle.proof_digests(docs_of(spark, [(1, None, None, None)])).first()
    assert one.leaf == one.subroot == one.root == one.folded_root and one.verified and one.proof_sha256 == sha("")
    assert merkle.build_manifest(docs_of(spark, [(1, None, None, None)])).nodes.where(F.col("level") > 0).count() == 0
