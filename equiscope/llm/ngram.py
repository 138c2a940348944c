"""Modified Kneser-Ney model over n-grams of folded characters.

The symbols are the bytes of a text folded into ``SYMBOLS`` classes (letters
regardless of case but with a class for capitals, digits, spaces, line
feeds, groups of punctuation, and classes of non-ASCII bytes).  The alphabet
is closed, so a model of order 4 has at most ``SYMBOLS ** 4`` = 2,560,000
entries however large the corpus is: that is the proven bound of what is
collected and broadcast.  Counting reads every byte of every document;
Spark adds up the partial counts.

A text's first symbols are predicted from line feeds.  The model gives the
spelling of words under the word model (:mod:`wordgrams`), which grows with
the corpus.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from equiscope.llm.rows import chunks
from equiscope.llm.text import U64, Texts, mix

SYMBOLS = 40
ORDER = 4
CELLS = SYMBOLS**ORDER
#: Log probabilities are added up in steps of ``1 / UNIT``.
UNIT = 1 << 32


def _classes() -> np.ndarray:
    t = np.full(256, 34)
    t[97:123] = np.arange(26)
    t[65:91] = 26
    t[48:58] = 27
    for symbol, chars in ((28, b" \t\r\x0b\x0c"), (29, b"\n"), (30, b".,;:"), (31, b"!?"), (32, b"'\"()[]{}-_/"),
                          (33, b"#*$%&|<>@^~`+=\\")):
        t[list(chars)] = symbol
    t[128:192] = 37 + np.arange(64) % 3
    t[192:224] = 35
    t[224:256] = 36
    return t.astype(np.int32)


CLASSES = _classes()


class Grams:
    """Packed n-gram ending at every byte of the texts, and text bounds."""

    def __init__(self, texts: list[bytes | None]):
        x = Texts(texts, pad=ORDER - 1)
        s = CLASSES[x.buf]
        packed = s[: len(s) - ORDER + 1].copy()
        for k in range(1, ORDER):
            packed = packed * SYMBOLS + s[k : len(s) - ORDER + 1 + k]
        edge = np.zeros(len(x.buf) + 1, np.int8)
        np.add.at(edge, x.text_starts, 1)
        np.add.at(edge, x.text_ends, -1)
        inside = np.cumsum(edge[:-1], dtype=np.int8) > 0
        self.packed = packed[inside[ORDER - 1 :]]
        self.sizes = x.text_ends - x.text_starts
        self.bounds = np.concatenate([[0], np.cumsum(self.sizes)])


def count_grams(docs: DataFrame, text: str = "text") -> DataFrame:
    """(gram int, n long): how often each n-gram ends at a byte of a text.

    Every task adds up its own counts in one array of fixed size and emits
    a row per n-gram it saw; Spark sums those rows."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CELLS, np.int64)
        for batch in batches:
            for _, _, texts in chunks(batch.column(0)):
                total += np.bincount(Grams(texts).packed, minlength=CELLS)
        seen = np.flatnonzero(total)
        for at in range(0, len(seen), 100_000):
            part = seen[at : at + 100_000]
            yield pa.record_batch({"gram": pa.array(part.astype(np.int32)), "n": pa.array(total[part])})

    partial = docs.select(F.col(text).alias("text")).mapInArrow(count, "gram int, n long")
    return partial.groupBy("gram").agg(F.sum("n").alias("n"))


def _discounts(counts: np.ndarray) -> np.ndarray:
    """Discount by count (0, 1, 2, 3 or more) from the counts of counts;
    where those are missing (tiny corpora), the absolute values 0.5, 1, 1.5."""
    n = np.bincount(np.minimum(counts, 5), minlength=6).astype(float)
    d = np.array([0.0, 0.5, 1.0, 1.5])
    if n[1] and n[2]:
        y = n[1] / (n[1] + 2 * n[2])
        for k in (1, 2, 3):
            if n[k] and n[k + 1]:
                d[k] = min(max(k - (k + 1) * y * n[k + 1] / n[k], 0.05), k - 0.05)
    return d


class KneserNey:
    """Interpolated modified Kneser-Ney probabilities in sorted hash arrays.

    Per order: hashes of the n-grams seen, sorted, with their log
    probability, and hashes of their contexts, sorted, with the log weight
    of the lower order."""

    def __init__(self, grams: np.ndarray, counts: np.ndarray):
        self.tables: dict[int, tuple[np.ndarray, ...]] = {}
        levels = {ORDER: (grams.astype(np.int64), counts.astype(np.int64))}
        for order in range(ORDER - 1, 0, -1):  # lower orders count distinct predecessors
            levels[order] = np.unique(levels[order + 1][0] % SYMBOLS**order, return_counts=True)
        lower = np.array([1.0 / SYMBOLS])
        for order in range(1, ORDER + 1):
            keys, n = levels[order]
            d = _discounts(n)
            contexts, inverse = np.unique(keys // SYMBOLS, return_inverse=True)
            total = np.bincount(inverse, n)
            freed = np.bincount(inverse, d[np.minimum(n, 3)])
            weight = freed / np.maximum(total, 1)
            below = lower if order == 1 else lower[np.searchsorted(levels[order - 1][0], keys % SYMBOLS ** (order - 1))]
            p = (n - d[np.minimum(n, 3)]) / np.maximum(total[inverse], 1) + weight[inverse] * below
            self.tables[order] = (*_by_hash(keys, order, np.log(p)), *_by_hash(contexts, order, np.log(weight)))
            lower = p

    def log_p(self, grams: np.ndarray, order: int = ORDER) -> np.ndarray:
        """Log probability of the last symbol of every packed n-gram."""
        if order == 0:
            return np.full(len(grams), -np.log(SYMBOLS))
        keys, p, contexts, weights = self.tables[order]
        out, found = _probe(keys, p, _hash(grams, order))
        miss = np.flatnonzero(~found)
        if len(miss):
            back, known = _probe(contexts, weights, _hash(grams[miss] // SYMBOLS, order))
            back[~known] = 0.0
            out[miss] = back + self.log_p(grams[miss] % SYMBOLS ** (order - 1), order - 1)
        return out


def _hash(keys: np.ndarray, order: int) -> np.ndarray:
    return mix(keys.astype(U64) + U64((order + 1) << 56))


def _by_hash(keys: np.ndarray, order: int, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    h = _hash(keys, order)
    by = np.argsort(h)
    return h[by], values[by]


def _probe(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(keys):
        return np.zeros(len(wanted)), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return values[at], keys[at] == wanted


def fit(docs: DataFrame, text: str = "text") -> KneserNey:
    """Count over all documents and estimate; at most ``CELLS`` rows reach
    the driver.  An empty table gives the uniform model."""
    rows = count_grams(docs, text).toArrow()
    grams, n = rows.column("gram").to_numpy(), rows.column("n").to_numpy()
    by = np.argsort(grams)
    return KneserNey(grams[by], n[by])


class Scorer:
    """Mean negative log probability per byte of texts.  Each distinct n-gram
    is looked up once per task and then kept in an array of ``CELLS``."""

    def __init__(self, model: KneserNey):
        self.model = model
        self.known = np.full(CELLS, np.nan, np.float32)

    def per_byte(self, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
        """Log probability of every byte, and the bounds of the texts."""
        g = Grams(texts)
        got = self.known[g.packed]
        new = np.unique(g.packed[np.isnan(got)])
        if len(new):
            self.known[new] = self.model.log_p(new.astype(np.int64))
            got = self.known[g.packed]
        return got, g.bounds

    def __call__(self, texts: list[bytes | None]) -> np.ndarray:
        got, bounds = self.per_byte(texts)
        # whole numbers add up to the same sum wherever the text stands in the chunk
        sums = np.concatenate([[0], np.cumsum(np.rint(got.astype(np.float64) * UNIT).astype(np.int64))])
        sizes = np.diff(bounds)
        return np.where(sizes > 0, -np.diff(sums[bounds]) / UNIT, 0.0) / np.maximum(sizes, 1)
