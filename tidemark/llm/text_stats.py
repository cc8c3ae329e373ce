"""Counts of a text that quality operators look at, for a run of texts at once in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.llm.common import WHITE, Spans, Words, mix, runs_of, slices

#: The characters that count as symbols.
SYMBOLS = b"#*$%&|<>"
_SYMBOL = np.isin(np.arange(256), list(SYMBOLS))
_UPPER = np.isin(np.arange(256), np.arange(65, 91))
_LETTER = _UPPER | np.isin(np.arange(256), np.arange(97, 123)) | (np.arange(256) >= 0xC0)
_PUNCT = ~_LETTER & (np.arange(256) < 128) & ~np.isin(np.arange(256), np.arange(48, 58)) & (np.arange(256) > 32)
_SHOUT = np.isin(np.arange(256), list(b"!|"))

FIELDS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_distinct_words",
          "n_upper", "n_letters", "n_punct", "n_shout")


def _with_doc(h: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Hashes that differ between documents."""
    return mix(h + doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def _earlier(doc: np.ndarray, h: np.ndarray, n: int) -> np.ndarray:
    """How many items of each document equal an earlier one."""
    order = np.argsort(h)
    equal = h[order][1:] == h[order][:-1]
    return np.bincount(doc[order[1:][equal]], minlength=n)


def count_texts(texts: list[bytes]) -> dict[str, np.ndarray]:
    n, w = len(texts), Words(texts)
    spans, buffer = Spans(w.buffer), w.buffer
    out = {"n_words": w.count, "word_chars": w.per_doc(~WHITE[buffer] & ((buffer & 0xC0) != 0x80))}
    for name, flags in (("n_symbols", _SYMBOL), ("n_upper", _UPPER), ("n_letters", _LETTER), ("n_punct", _PUNCT), ("n_shout", _SHOUT)):
        out[name] = w.per_doc(flags[buffer])

    ends = buffer == 10
    ends[w.doc_end] = True
    ends = np.flatnonzero(ends)
    starts = np.concatenate([[0], ends[:-1] + 1])
    worded = np.searchsorted(w.start, ends) > np.searchsorted(w.start, starts)
    starts, ends = starts[worded], ends[worded]
    line_doc = np.searchsorted(w.doc_end, starts)
    out["n_lines"] = np.bincount(line_doc, minlength=n)
    out["n_dup_lines"] = _earlier(line_doc, _with_doc(spans.hashes(starts, ends), line_doc), n)

    h = _with_doc(spans.hashes(w.start, w.end), w.doc)
    out["n_distinct_words"] = w.count - _earlier(w.doc, h, n)
    first, triples = runs_of(h, w.doc, 3)
    order = np.argsort(triples)
    equal = triples[order][1:] == triples[order][:-1]
    repeated = np.zeros(len(h) + 3, bool)
    for twice in (first[order[1:][equal]], first[order[:-1][equal]]):
        for k in range(3):
            repeated[twice + k] = True
    out["n_repeat_words"] = np.bincount(w.doc[repeated[:len(h)]], minlength=n)
    return out


def _column(texts: pa.Array) -> pa.Array:
    parts: dict[str, list[np.ndarray]] = {name: [np.zeros(0, np.int64)] for name in FIELDS}
    for _, run in slices(texts):
        for name, values in count_texts(run).items():
            parts[name].append(values)
    return pa.StructArray.from_arrays([pa.array(np.concatenate(parts[name]).astype(np.int64)) for name in FIELDS], names=list(FIELDS))


def _columns(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for texts in batches:
        yield _column(texts)


def text_counts(text: Column) -> Column:
    """A struct of the counts in FIELDS; a null text counts as empty."""
    return F.arrow_udf(_columns, f"struct<{','.join(f'{name}:bigint' for name in FIELDS)}>")(text)
