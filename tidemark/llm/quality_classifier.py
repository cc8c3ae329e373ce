"""Quality classifier without hand labels: overlapping heuristics, a label model, and a hashed linear scorer.

1. Labellers vote good, bad or nothing on every document, from its counts. The votes are counted by pattern over all
   documents; there are at most 3^labellers patterns, so the table of patterns is small whatever the corpus.
2. Expectation-maximisation estimates, per labeller and class, how often it votes what, and the share of each class;
   no labels are used. Every pattern gets the posterior probability of being good.
3. The posteriors of a bounded sample of documents (SAMPLE_DOCS, by a hash of the id) train a logistic scorer on hashed
   features: runs of three character classes, and coarse steps of repetition and length. It scores every document.
   Where one side (posterior below or above a half) is rare, more of it is drawn, up to LEAST of the sample, so that
   what the scorer learns about junk does not depend on the size of the corpus.

Counts and the scorer's features cover whole texts. Nulls and empty texts have no features and no votes: their score is
the scorer's intercept alone, and they are rejected. Repeated rows get equal scores. Rows without an id are drawn by
their text. Where the label model finds one side only, there is nothing to train a scorer on, and its own probabilities
are the scores. With no documents at all, or with votes of one kind only, everything with a word is kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import WHITE, bounded_batches, mix, slices
from tidemark.llm.text_stats import count_texts

SAMPLE_DOCS, BITS, ROUNDS, STEPS, KEEP, SHRINK, LEAST = 3000, 11, 50, 500, 0.5, 40, 0.05
GOOD, BAD, NONE = 1, 0, 2


def _share(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return 1000 * a // np.maximum(b, 1)


def _vote(good: np.ndarray, bad: np.ndarray) -> np.ndarray:
    return np.where(bad, BAD, np.where(good, GOOD, NONE))


def votes(c: dict[str, np.ndarray]) -> np.ndarray:
    """(documents, labellers): GOOD, BAD or NONE. Shares are in thousandths."""
    some = c["n_words"] >= 1
    symbols, shout = _share(c["n_symbols"], c["word_chars"]), _share(c["n_shout"], c["word_chars"])
    punct, upper = _share(c["n_punct"], c["word_chars"]), _share(c["n_upper"], c["n_letters"])
    repeat, distinct = _share(c["n_repeat_words"], c["n_words"]), _share(c["n_distinct_words"], c["n_words"])
    length, per_line = _share(c["word_chars"], c["n_words"]), c["n_words"] // np.maximum(c["n_lines"], 1)
    long = c["n_words"] >= 50
    each = [
        _vote(symbols < 10, symbols > 80),
        _vote(shout < 5, shout > 40),
        _vote(punct < 60, punct > 150),
        _vote(upper < 60, (upper > 300) & (c["n_letters"] >= 100)),
        _vote(long & (repeat < 50), long & (repeat > 600)),
        _vote(long & (distinct > 500), long & (distinct < 250)),
        _vote((length > 3500) & (length < 6500), (length > 9000) | (length < 2000)),
        _vote((per_line > 3) & (per_line < 120), per_line > 400),
    ]
    return np.where(some[:, None], np.stack(each, axis=1), NONE).astype(np.int8)


N_VOTES = 8


@dataclass
class LabelModel:
    """P(vote | class, a vote is cast) per labeller, and the share of good documents."""

    table: np.ndarray  # (labellers, class, vote cast)
    good: float

    def evidence(self, k: int) -> np.ndarray:
        """(class, vote) logarithms; a labeller that casts no vote says nothing."""
        return np.concatenate([np.log(self.table[k]), np.zeros((2, 1))], axis=1)

    def posterior(self, ballot: np.ndarray) -> np.ndarray:
        """Probability of being good for rows of votes."""
        score = np.tile(np.log([1 - self.good, self.good]), (len(ballot), 1))
        for k in range(ballot.shape[1]):
            score += self.evidence(k)[:, ballot[:, k]].T
        score -= score.max(axis=1, keepdims=True)
        p = np.exp(score)
        return p[:, GOOD] / p.sum(axis=1)

    def accuracies(self) -> np.ndarray:
        """Per labeller: how often a vote that it casts is right, if it casts as many in either class."""
        return self.table[:, BAD, BAD] * (1 - self.good) + self.table[:, GOOD, GOOD] * self.good


def label_model(ballots: np.ndarray, counts: np.ndarray, rounds: int = ROUNDS) -> LabelModel:
    """Expectation-maximisation over distinct rows of votes with their counts; starts from the votes' own majority, bad ones weighing more."""
    bad, good = (ballots == BAD).sum(axis=1), (ballots == GOOD).sum(axis=1)
    p_good = np.where(bad + good == 0, 0.5, (good + 0.5) / (good + 4 * bad + 1))
    for _ in range(rounds):
        weight = np.stack([(1 - p_good) * counts, p_good * counts])
        table = np.stack([np.stack([(weight * (ballots[:, k] == v)).sum(axis=1) for v in (BAD, GOOD)], axis=1) for k in range(ballots.shape[1])]) + 0.5
        table /= table.sum(axis=2, keepdims=True)
        model = LabelModel(table, float((weight[1].sum() + 1) / (weight.sum() + 2)))
        p_good = model.posterior(ballots)
    return model


# --- features ----------------------------------------------------------------------------------------------

_CLASS = np.arange(256, dtype=np.int64)
_CLASS[97:123] = _CLASS[128:] = 97
_CLASS[65:91] = 65
_CLASS[48:58] = 48
_CLASS[WHITE] = 32
_CLASS[10] = 10


def _hashed(values: np.ndarray, salt: int, bits: int) -> np.ndarray:
    return (mix(values.astype(np.uint64) + np.uint64(salt << 40)) >> np.uint64(64 - bits)).astype(np.int64)


def _steps(c: dict[str, np.ndarray]) -> list[np.ndarray]:
    """Coarse steps of repetition, line length and the shares of kinds of characters."""
    per_line = c["n_words"] // np.maximum(c["n_lines"], 1)
    return [_share(c["n_repeat_words"], c["n_words"]) // 100, _share(c["n_distinct_words"], c["n_words"]) // 100, np.log2(per_line + 1).astype(np.int64),
            np.minimum(_share(c["n_symbols"], c["word_chars"]) // 40, 5), np.minimum(_share(c["n_shout"], c["word_chars"]) // 40, 5),
            np.minimum(_share(c["n_punct"], c["word_chars"]) // 50, 5), np.minimum(_share(c["n_upper"], c["n_letters"]) // 150, 3)]


def _trigrams(texts: list[bytes], bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashed feature at every byte, where each text begins, and its length; text ends are marked by two separators."""
    lengths = np.fromiter(map(len, texts), np.int64, len(texts)) + 2
    buffer = _CLASS[np.frombuffer(b"\x01\x01".join(texts) + b"\x01\x01\x01\x01", np.uint8)]
    code = (buffer[:-2] << 16) | (buffer[1:-1] << 8) | buffer[2:]
    return _hashed(code, 0, bits)[:lengths.sum()], np.cumsum(lengths) - lengths, lengths


def features(texts: list[bytes], c: dict[str, np.ndarray], bits: int = BITS) -> np.ndarray:
    """(texts, 2^bits): shares of the trigrams (drawn towards 0 in short texts), and one for each step."""
    code, start, lengths = _trigrams(texts, bits)
    out = np.zeros((len(texts), 1 << bits), np.float32)
    for i in range(len(texts)):
        out[i] = np.bincount(code[start[i]:start[i] + lengths[i]], minlength=1 << bits) / (lengths[i] + SHRINK)
    for salt, step in enumerate(_steps(c), 1):
        np.add.at(out, (np.arange(len(texts)), _hashed(step, salt, bits)), 1)
    return out


@dataclass
class Scorer:
    """Logistic regression on hashed features."""

    weights: np.ndarray
    bias: float

    @classmethod
    def fit(cls, x: np.ndarray, target: np.ndarray, steps: int = STEPS, rate: float = 0.05) -> Scorer:
        """Adam on the soft labels, over the features that occur."""
        used = np.flatnonzero(x.any(axis=0))
        part = np.ascontiguousarray(x[:, used], np.float32)
        target = target.astype(np.float32)
        w, bias = np.zeros(len(used), np.float32), 0.0
        m, v = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
        for step in range(1, steps + 1):
            error = (1 / (1 + np.exp(-np.clip(part @ w + np.float32(bias), -30, 30))) - target) / len(target)
            g = np.append(error @ part + 1e-6 * w, error.sum())
            m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
            move = rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
            w, bias = w - move[:-1].astype(np.float32), bias - move[-1]
        weights = np.zeros(x.shape[1])
        weights[used] = w
        return cls(weights, float(bias))

    def score(self, texts: list[bytes], c: dict[str, np.ndarray]) -> np.ndarray:
        """Probability of being good; sums weights instead of building features."""
        bits = int(len(self.weights)).bit_length() - 1
        code, start, lengths = _trigrams(texts, bits)
        total = np.add.reduceat(self.weights[code], start) / (lengths + SHRINK) + self.bias
        for salt, step in enumerate(_steps(c), 1):
            total += self.weights[_hashed(step, salt, bits)]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


# --- over DataFrames ---------------------------------------------------------------------------------------

def _per_text(text: Column, ddl: str, names: list[str], make) -> Column:
    """A struct column made by `make(texts, counts)`, which returns one array per field."""
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            parts = [make(part, count_texts(part)) for _, part in slices(texts)]
            yield pa.StructArray.from_arrays([pa.concat_arrays([p[k] for p in parts]) if parts else pa.array([], t) for k, t in enumerate(_TYPES[ddl])], names=names)

    return F.arrow_udf(run, ddl)(text)


_VOTED, _DRAWN, _SCORED = "struct<ballot:string>", "struct<ballot:string,x:binary>", "struct<ballot:string,score:double,n_words:bigint>"
_TYPES = {_VOTED: [pa.string()], _DRAWN: [pa.string(), pa.binary()], _SCORED: [pa.string(), pa.float64(), pa.int64()]}


def _ballots(c: dict[str, np.ndarray]) -> pa.Array:
    """Votes as a string of digits, a hashable pattern."""
    return pa.array(["".join(map(str, row)) for row in votes(c).tolist()], pa.string())


def _unpack(patterns: list[str]) -> np.ndarray:
    return np.array([[int(v) for v in p] for p in patterns], np.int8).reshape(len(patterns), N_VOTES)


@dataclass
class Classifier:
    """What `train` learns: the label model and the scorer (None where there is nothing to tell apart)."""

    model: LabelModel | None
    scorer: Scorer | None


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample_docs: int = SAMPLE_DOCS) -> Classifier:
    """The label model over all documents, the scorer over the sample."""
    bounded_batches(docs.sparkSession)
    voted = docs.select(_per_text(F.col(text_col), _VOTED, ["ballot"], lambda texts, c: [_ballots(c)]).alias("v"))
    counted = voted.groupBy("v.ballot").agg(F.count("*").alias("docs")).toPandas()  # at most 3^N_VOTES rows
    ballots, counts = _unpack(list(counted["ballot"])), counted["docs"].to_numpy(float)
    if not len(ballots) or not (ballots == BAD).any() or not (ballots == GOOD).any():
        return Classifier(None, None)
    order = np.lexsort(ballots.T)
    model = label_model(ballots[order], counts[order])
    sample = _drawn(docs, ballots, counts, model.posterior(ballots) > 0.5, id_col, text_col, sample_docs)
    x = np.frombuffer(b"".join(sample["x"]), np.float32).reshape(len(sample), 1 << BITS)
    target = model.posterior(_unpack(list(sample["ballot"])))
    if not len(x) or target.max() <= 0.5 or target.min() > 0.5:
        return Classifier(model, None)
    return Classifier(model, Scorer.fit(x, target))


def _drawn(docs: DataFrame, ballots: np.ndarray, counts: np.ndarray, good: np.ndarray, id_col: str, text_col: str, sample_docs: int) -> pd.DataFrame:
    """(ballot, x: the features' bytes) of the sample. Features are cut in the tasks: the driver gets rows of one size, at most 2 * sample_docs."""
    share = sample_docs / counts.sum()
    rate = {side: int(min(1.0, max(share, LEAST * sample_docs / max(counts[good == side].sum(), 1))) * 1_000_000) for side in (True, False)}
    text = F.col(text_col)
    hashed = F.pmod(F.coalesce(F.when(F.col(id_col).isNotNull(), F.xxhash64(F.col(id_col))), F.xxhash64(text)), F.lit(1_000_000))
    near = docs.where(text != "").select(hashed.alias("h"), text.alias("text")).where(F.col("h") <= max(rate.values()))
    if rate[True] != rate[False]:
        plenty = rate[True] < rate[False]
        names = ["".join(map(str, row)) for row in ballots[good == plenty].tolist()]  # a part of the 3^N_VOTES patterns
        voted = near.withColumn("v", _per_text(F.col("text"), _VOTED, ["ballot"], lambda texts, c: [_ballots(c)]))
        near = voted.where((F.col("h") <= rate[plenty]) | ~F.col("v.ballot").isin(names)).select("h", "text")

    def make(texts: list[bytes], c: dict[str, np.ndarray]) -> list[pa.Array]:
        return [_ballots(c), pa.array([row.tobytes() for row in features(texts, c)], pa.binary())]

    drawn = near.select("h", _per_text(F.col("text"), _DRAWN, ["ballot", "x"], make).alias("d")).select("h", "d.*")
    return drawn.orderBy("h", "ballot", "x").limit(2 * sample_docs).toPandas()


def classify(docs: DataFrame, classifier: Classifier, text_col: str = "text", keep: float = KEEP) -> DataFrame:
    """`docs` with ballot (the votes), weak_label (the label model's probability of good), score (the scorer's) and kept."""
    bounded_batches(docs.sparkSession)
    scorer, model = classifier.scorer, classifier.model

    def make(texts: list[bytes], c: dict[str, np.ndarray]) -> list[pa.Array]:
        score = scorer.score(texts, c) if scorer else np.ones(len(texts))
        return [_ballots(c), pa.array(score), pa.array(c["n_words"].astype(np.int64))]

    marked = docs.withColumn("__q", _per_text(F.col(text_col), _SCORED, ["ballot", "score", "n_words"], make))
    weak = F.lit(None).cast("double")
    if model is not None:
        # Naive Bayes over the votes, as sums of logarithms.
        gap = F.lit(float(np.log(model.good) - np.log(1 - model.good)))
        for k in range(N_VOTES):
            steps = model.evidence(k)[GOOD] - model.evidence(k)[BAD]
            gap = gap + F.element_at(F.array(*[F.lit(float(s)) for s in steps]), F.substring("__q.ballot", k + 1, 1).cast("int") + 1)
        weak = 1 / (1 + F.exp(-gap))
    score = weak if scorer is None and model is not None else F.col("__q.score")
    return marked.select(*[marked[c] for c in docs.columns], F.col("__q.ballot").alias("ballot"), weak.alias("weak_label"), score.alias("score"),
                         ((score >= keep) & (F.col("__q.n_words") > 0)).alias("kept"))


def clean(docs: DataFrame, classifier: Classifier | None = None, text_col: str = "text", **options) -> DataFrame:
    """The documents that the classifier keeps, with all of their columns."""
    classifier = classifier or train(docs, text_col=text_col, **options)
    row = F.struct(*[docs[c] for c in docs.columns]).alias("__row")
    judged = classify(docs.select(row, docs[text_col].alias("__text")), classifier, "__text")
    return judged.where("kept").select("__row.*")
