"""Language identification by a bidirectional gated recurrent network over bytes, trained in numpy.

The network reads the UTF-8 bytes of a text in lower case, in windows of WINDOW bytes, in both directions. It labels
every byte with a probability per language; a document's probabilities are the mean over all of its bytes. Training is
backpropagation through time with Adam on windows of a bounded sample: at most DOCS_PER_LANG documents of each
language, taken by a hash of their id, with at most WINDOWS_PER_DOC windows each, anywhere in the text. Only text and
language are used. Prediction covers every byte of every text.

Nulls and texts without letters are `und` with score 0, and so is everything if there is nothing to learn from.
Repeated rows get equal answers.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import bounded_batches

WINDOW, HIDDEN, DOCS_PER_LANG, WINDOWS_PER_DOC, EPOCHS, BATCH, RATE = 128, 8, 500, 4, 8, 128, 0.015
UNKNOWN, PAD, SLICE_WINDOWS = "und", 256, 2048
_LETTER = re.compile(r"[^\W\d_]")


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


class Network:
    """Two recurrent layers (one per direction) and a softmax over languages at every byte."""

    def __init__(self, langs: list[str], hidden: int = HIDDEN, seed: int = 7):
        draw = np.random.default_rng(seed)
        self.langs, self.hidden = langs, hidden
        scale = 1 / np.sqrt(hidden)
        self.weights = {}
        for d in ("f", "b"):
            self.weights[f"in_{d}"] = draw.normal(0, 0.3, (257, 3 * hidden)).astype(np.float32)
            self.weights[f"rec_{d}"] = draw.uniform(-scale, scale, (hidden, 3 * hidden)).astype(np.float32)
            self.weights[f"out_{d}"] = draw.uniform(-scale, scale, (hidden, len(langs))).astype(np.float32)
        self.weights["bias"] = np.zeros(len(langs), np.float32)

    def _layer(self, x: np.ndarray, d: str, keep: bool) -> tuple[np.ndarray, list]:
        """States after every byte; x is (time, windows)."""
        into, rec, n = self.weights[f"in_{d}"], self.weights[f"rec_{d}"], self.hidden
        state = np.zeros((x.shape[1], n), np.float32)
        states, kept = np.empty((*x.shape, n), np.float32), []
        for t in range(len(x)):
            a, g = into[x[t]], state @ rec
            gates = _sigmoid(a[:, :2 * n] + g[:, :2 * n])
            z, r, inner = gates[:, :n], gates[:, n:], g[:, 2 * n:]
            new = np.tanh(a[:, 2 * n:] + r * inner)
            if keep:
                kept.append((state, z, r, inner, new))
            state = new + z * (state - new)
            states[t] = state
        return states, kept

    def probabilities(self, x: np.ndarray, keep: bool = False):
        """(time, windows, languages), and what the backward pass needs."""
        w = self.weights
        forward, kept_f = self._layer(x, "f", keep)
        backward, kept_b = self._layer(x[::-1], "b", keep)
        scores = forward @ w["out_f"] + backward[::-1] @ w["out_b"] + w["bias"]
        scores -= scores.max(axis=2, keepdims=True)
        np.exp(scores, out=scores)
        scores /= scores.sum(axis=2, keepdims=True)
        return (scores, forward, backward, kept_f, kept_b) if keep else scores

    def gradients(self, x: np.ndarray, label: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean cross-entropy over the bytes of the windows (PAD left out), and its gradients."""
        p, forward, backward, kept_f, kept_b = self.probabilities(x, keep=True)
        real = (x != PAD).astype(np.float32)
        total = max(1.0, float(real.sum()))
        columns = np.arange(x.shape[1])
        loss = float(-(np.log(p[:, columns, label] + 1e-9) * real).sum() / total)
        delta = p
        delta[:, columns, label] -= 1
        delta *= (real / total)[:, :, None]
        grads = {"bias": delta.sum(axis=(0, 1))}
        n = self.hidden
        for d, states, kept, seen, out in (("f", forward, kept_f, x, delta), ("b", backward, kept_b, x[::-1], delta[::-1])):
            rec = self.weights[f"rec_{d}"]
            grads[f"out_{d}"] = np.tensordot(states, out, axes=([0, 1], [0, 1]))
            from_out = out @ self.weights[f"out_{d}"].T
            g_rec, g_in = np.zeros_like(rec), np.empty((*x.shape, 3 * n), np.float32)
            later = np.zeros((x.shape[1], n), np.float32)
            for t in range(len(x) - 1, -1, -1):
                before, z, r, inner, new = kept[t]
                d_state = from_out[t] + later
                d_new = d_state * (1 - z) * (1 - new * new)
                d_z = d_state * (before - new) * z * (1 - z)
                d_r = d_new * inner * r * (1 - r)
                g_in[t] = np.concatenate([d_z, d_r, d_new], axis=1)
                to_rec = np.concatenate([d_z, d_r, d_new * r], axis=1)
                g_rec += before.T @ to_rec
                later = d_state * z + to_rec @ rec.T
            flat = np.ascontiguousarray(seen).reshape(-1)
            g_in = g_in.reshape(-1, 3 * n)
            grads[f"in_{d}"] = np.stack([np.bincount(flat, g_in[:, k], minlength=257) for k in range(3 * n)], axis=1).astype(np.float32)
            grads[f"rec_{d}"] = g_rec
        return loss, grads

    def fit(self, windows: np.ndarray, labels: np.ndarray, epochs: int = EPOCHS, batch: int = BATCH, rate: float = RATE, seed: int = 11) -> list[float]:
        """Adam with a falling rate and clipped gradients. `windows` is (windows, time). Returns the mean loss per epoch."""
        draw, losses, step = np.random.default_rng(seed), [], 0
        m = {k: np.zeros_like(v) for k, v in self.weights.items()}
        v = {k: np.zeros_like(w) for k, w in self.weights.items()}
        for epoch in range(epochs):
            order, seen = draw.permutation(len(windows)), []
            for at in range(0, len(order), batch):
                pick = order[at:at + batch]
                loss, grads = self.gradients(np.ascontiguousarray(windows[pick].T), labels[pick])
                seen.append(loss)
                step += 1
                norm = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
                now = rate * (1 - epoch / epochs) ** 0.7
                for k, g in grads.items():
                    g = g * min(1.0, 1.0 / (norm + 1e-9))
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v[k] = 0.99 * v[k] + 0.01 * g * g
                    self.weights[k] -= (now * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.99 ** step)) + 1e-8)).astype(np.float32)
            losses.append(float(np.mean(seen)))
        return losses

    def documents(self, texts: list[str]) -> np.ndarray:
        """Mean probabilities per text, over all of its bytes; zeros for an empty text."""
        raw = [np.frombuffer(t.lower().encode(), np.uint8) for t in texts]
        pieces = [-(-len(r) // WINDOW) for r in raw]
        sums = np.zeros((len(texts), len(self.langs)))
        owner = np.repeat(np.arange(len(texts)), pieces)
        x = np.full((len(owner), WINDOW), PAD, np.int16)
        at = 0
        for r, n in zip(raw, pieces, strict=True):
            x[at:at + n].reshape(-1)[:len(r)] = r
            at += n
        for start in range(0, len(owner), SLICE_WINDOWS):
            part = np.ascontiguousarray(x[start:start + SLICE_WINDOWS].T)
            p = (self.probabilities(part) * (part != PAD)[:, :, None]).sum(axis=0)
            np.add.at(sums, owner[start:start + SLICE_WINDOWS], p)
        return sums / np.maximum(1, np.array([len(r) for r in raw]))[:, None]


def held_out(doc_id: Column) -> Column:
    """A quarter of the ids that nothing is learnt from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def training_windows(sample: pd.DataFrame, langs: list[str], windows_per_doc: int, seed: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """Windows at drawn places of the sampled texts; a third of them cut short, as texts and their ends are."""
    draw, rows, labels = np.random.default_rng(seed), [], []
    index = {lang: i for i, lang in enumerate(langs)}
    for text, lang in zip(sample["text"], sample["lang"], strict=True):
        raw = np.frombuffer(text.lower().encode(), np.uint8)
        for _ in range(min(windows_per_doc, -(-len(raw) // WINDOW))):
            start = int(draw.integers(0, max(1, len(raw) - WINDOW + 1)))
            length = int(draw.integers(8, WINDOW)) if draw.random() < 1 / 3 else WINDOW
            row = np.full(WINDOW, PAD, np.int16)
            part = raw[start:start + length]
            row[:len(part)] = part
            rows.append(row)
            labels.append(index[lang])
    return np.array(rows, np.int16).reshape(-1, WINDOW), np.array(labels, np.int64)


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", docs_per_lang: int = DOCS_PER_LANG,
          windows_per_doc: int = WINDOWS_PER_DOC, epochs: int = EPOCHS, hidden: int = HIDDEN) -> Network | None:
    """A network learnt from labelled rows that are not held out; None if there are none.

    The sample, at most docs_per_lang rows per language, is cut in every task before it is shuffled, and fitted on the driver.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).where(
        F.col("id").isNotNull() & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}") & ~held_out(F.col("id")))
    ranked = rows.withColumn("hash", F.xxhash64("id")).withColumn("at", F.expr("row_number() OVER (PARTITION BY lang ORDER BY hash, id, text)")).where(F.col("at") <= docs_per_lang)
    sample = ranked.select("lang", "at", "text").toPandas().sort_values(["lang", "at"], ignore_index=True)
    if sample.empty:
        return None
    network = Network(sorted(sample["lang"].unique()), hidden)
    network.fit(*training_windows(sample, network.langs, windows_per_doc), epochs=epochs)
    return network


def identify(docs: DataFrame, network: Network | None, text_col: str = "text") -> DataFrame:
    """`docs` with lang_pred, score, and lang_probs (language -> probability)."""
    bounded_batches(docs.sparkSession, 500)
    langs = network.langs if network else []

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            known = [t if t is not None and network is not None and _LETTER.search(t) else "" for t in texts.to_pylist()]
            p, at = np.zeros((len(known), len(langs))), 0
            while at < len(known):
                to, size = at, 0
                while to < len(known) and (to == at or size + len(known[to]) <= 1 << 20):
                    size += len(known[to])
                    to += 1
                if network is not None:
                    p[at:to] = network.documents(known[at:to])
                at = to
            best = p.argmax(axis=1) if langs else np.zeros(len(known), int)
            yield pa.StructArray.from_arrays([
                pa.array([langs[b] if t else UNKNOWN for b, t in zip(best, known, strict=True)], pa.string()),
                pa.array([min(1.0, float(p[i, b])) if t else 0.0 for i, (b, t) in enumerate(zip(best, known, strict=True))], pa.float64()),
                pa.array([list(zip(langs, row.tolist(), strict=True)) if t else [] for row, t in zip(p, known, strict=True)], pa.map_(pa.string(), pa.float64())),
            ], names=["lang_pred", "score", "lang_probs"])

    told = docs.withColumn("__l", F.arrow_udf(run, "struct<lang_pred:string,score:double,lang_probs:map<string,double>>")(F.col(text_col)))
    return told.select(*[told[c] for c in docs.columns], "__l.*")
