"""Word 2-gram model whose tables stay in Spark and grow with the corpus.

``p(w | v) = (n(v w) + MU * s(w)) / (n(v) + MU)``: counts of hashed words as
they are written (no folding), interpolated with ``s``, the probability of
the word's spelling and of the separators behind it under the character
model (:mod:`ngram`).  A text is scored without its own counts: those of the
text and of its exact copies are taken off, else a text of invented words
would vouch for itself.

Every different text is dealt to one block by its hash, with the number of
its copies; copies are joined where they are read, so a text that fills a
third of all rows crosses the exchange once per task.  A block sends one
entry per distinct gram, with its count, to the gram's bucket (a range of
hashes).  A bucket adds up and answers each block with the count outside
it, in the order of the block's entries; the block then scores its own texts.
A word that stands in every text has an entry per block, not per text, and
the tables are never collected or broadcast.  Partial scores are whole
numbers of ``1 / UNIT``, so equal texts get equal sums in any order.

Texts are known by a 64-bit hash (:func:`text_key`), grams by their bucket and
``GRAM_BITS`` bits more: of the 2 million or so different grams of a bucket,
one in 50,000 shares its key with another.  Entries are sorted, and written as
differences, byte plane by byte plane; they and the texts cross the exchanges
compressed, texts with a dictionary of some that stand in the table (it helps
the compression and changes no result).

Defined results: null texts and texts without a word have no row.  Repeated
rows count each time and have one row.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from equiscope.llm import ngram
from equiscope.llm.text import CHUNK_BYTES, U64, Texts, mix

#: Weight of the spelling, in occurrences of the context.
MU = 4.0
UNIT = 1 << 20
#: Bytes of text in a block, and those whose grams make a range of hashes.
BLOCK_BYTES = 32 << 20
RANGE_BYTES = 16 << 20
#: Small tables get smaller blocks and ranges, down to this, so that all cores have some.
LEAST_BYTES = 2 << 20
#: A block's entries are added up in so many ranges, one after the other.
SLICES = 16
#: Compression of texts: level, texts in the dictionary and characters of each.
LEVEL, DICT_TEXTS, DICT_CHARS = 9, 32, 4096
GRAM_BITS = 36
_LOW = U64((1 << GRAM_BITS) - 1)
KEY = "text_key"


def text_key(text):
    return F.xxhash64(text).alias(KEY)


def _write(values: np.ndarray) -> bytes:
    """Width, then the low bytes of all numbers, the next bytes, and so on; compressed."""
    width = max(-(-int(values.max()).bit_length() // 8), 1)
    planes = values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T
    return zstandard.ZstdCompressor().compress(bytes([width]) + planes.tobytes())


def _read(data: bytes) -> np.ndarray:
    data = zstandard.ZstdDecompressor().decompress(data)
    planes = np.frombuffer(data, np.uint8, offset=1).reshape(data[0], -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, : data[0]] = planes.T
    return out.view("<u8")[:, 0]


def _dictionary(docs: DataFrame, text: str) -> bytes:
    """Some text of the table, 128 Ki characters at most."""
    some = docs.select(F.substring(F.col(text), 1, DICT_CHARS).alias("t")).filter("t <> ''").limit(DICT_TEXTS)
    return "\n".join(r.t for r in some.collect()).encode()


def _codec(kind, shared: bytes, **more):
    """A compressor or decompressor with the dictionary."""
    content = zstandard.ZstdCompressionDict(shared, dict_type=zstandard.DICT_TYPE_RAWCONTENT) if shared else None
    return kind(dict_data=content, **more)


def _texts(column: pa.ChunkedArray, shared: bytes) -> Iterator[tuple[int, list[bytes]]]:
    """(number of the first, texts) of some CHUNK_BYTES each."""
    reader, held, size, first = _codec(zstandard.ZstdDecompressor, shared), [], 0, 0
    for packed in column:
        held.append(reader.decompress(packed.as_py()))
        size += len(held[-1]) + 64
        if size > CHUNK_BYTES:
            yield first, held
            first, held, size = first + len(held), [], 0
    if held:
        yield first, held


def _add_up(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different keys in order, and the sum of each."""
    if not len(keys):
        return keys, n
    by = np.argsort(keys)
    keys, n = keys[by], n[by]
    new = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[new], np.add.reduceat(n, new)


def grams(x: Texts, ranges: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the 2-gram that ends with each word, and of its context."""
    word = x.word_hashes()
    before = np.concatenate([word[:1], word[:-1]])
    before[x.bounds[:-1][x.counts > 0]] = U64(0)
    pair = mix(mix(before) * U64(0x9E3779B97F4A7C15) ^ word)
    context = mix(before ^ U64(0x5851F42D4C957F2D))
    keys = np.stack([pair, context])
    return tuple(((keys >> U64(32)) * U64(ranges) >> U64(32)) << U64(GRAM_BITS) | keys & _LOW)


def entries(texts: list[bytes | None], scorer: ngram.Scorer, ranges: int):
    """(key, text, n, base) of every text and distinct gram: occurrences in the
    text (negative: as a context), log of what is added to the count."""
    x = Texts(texts)
    of = x.word_text
    if not len(of):
        return np.empty(0, U64), of, np.empty(0, np.int64), np.empty(0)
    pair, context = grams(x, ranges)
    first = x.bounds[:-1][x.counts > 0]
    # the bytes from a word to the next one of its text; the first has also what stands before it
    logs, bounds = scorer.per_byte(texts)
    sums = np.concatenate([[0], np.cumsum(np.rint(logs.astype(np.float64) * UNIT).astype(np.int64))])
    at = x.starts - x.text_starts[of] + bounds[of]
    at[first] = bounds[of[first]]
    upto = np.append(at[1:], 0)
    upto[np.append(first[1:], len(at)) - 1] = bounds[of[first] + 1]
    spelling = sums[upto] - sums[at]
    out = []
    for key, base, sign in ((pair, spelling, 1), (context, None, -1)):
        by = np.lexsort((key, of))
        k, t = key[by], of[by]
        new = np.flatnonzero(np.concatenate([[True], (k[1:] != k[:-1]) | (t[1:] != t[:-1])]))
        n = np.diff(np.append(new, len(k)))
        added = np.zeros(len(new)) if base is None else np.add.reduceat(base[by], new) / n / UNIT
        out.append((k[new], t[new], sign * n, np.log(MU) + added))
    return tuple(np.concatenate(column) for column in zip(*out, strict=True))


def block_grams(table: pa.Table, ranges: int, shared: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The different grams of a block, in order, and their occurrences."""
    copies = table.column("copies").to_numpy()
    bounds = np.array([(ranges << GRAM_BITS) * i // SLICES for i in range(SLICES + 1)], U64)
    found = []
    for first, texts in _texts(table.column("text"), shared):
        x = Texts(texts)
        k, n = _add_up(np.concatenate(grams(x, ranges)), np.tile(copies[first : first + len(texts)][x.word_text], 2))
        found.append((k, n, np.searchsorted(k, bounds)))
    slices = [
        _add_up(np.concatenate([k[c[i] : c[i + 1]] for k, _, c in found]), np.concatenate([n[c[i] : c[i + 1]] for _, n, c in found]))
        for i in range(SLICES)
    ]
    return tuple(np.concatenate(column) for column in zip(*slices, strict=True))


def _once(shared: bytes):
    """Every text of the task once, compressed; what its copies add comes without the text."""

    def rows(keys, texts, copies):
        return pa.record_batch([pa.array(keys, pa.int64()), pa.array(texts, pa.binary()), pa.array(copies, pa.int64())], names=[KEY, "text", "copies"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, more = _codec(zstandard.ZstdCompressor, shared, level=LEVEL), {}
        for batch in batches:
            keys, texts = [], []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if key in more:
                    more[key] += 1
                else:
                    more[key] = 0
                    keys.append(key)
                    texts.append(writer.compress(text.as_buffer()))
            yield rows(keys, texts, np.ones(len(keys), np.int64))
        more = {key: n for key, n in more.items() if n}
        yield rows(list(more), [None] * len(more), list(more.values()))

    return run


def _blocks(docs: DataFrame, text: str, n: int, shared: bytes = b"") -> DataFrame:
    """(block, text_key, text, copies), a row per different text.  The grouping
    by block and key needs no exchange beyond the one by block, and takes the
    tasks' copies of a text one after the other."""
    held = docs.filter(F.col(text).isNotNull()).select(text_key(F.col(text)), F.col(text).cast("binary").alias("text"))
    once = held.mapInArrow(_once(shared), f"{KEY} long, text binary, copies long")
    dealt = once.withColumn("block", F.pmod(F.col(KEY), F.lit(n))).repartition("block")
    return dealt.groupBy("block", KEY).agg(F.first("text", ignorenulls=True).alias("text"), F.sum("copies").alias("copies"))


def _counted(blocks: DataFrame, ranges: int, shared: bytes = b"") -> DataFrame:
    """(block, part, outside): for the block's different grams of a range, in
    order, their occurrences in other blocks."""

    def send(table: pa.Table) -> pa.Table:
        keys, counts = block_grams(table, ranges, shared)
        cuts = np.searchsorted(keys >> U64(GRAM_BITS), np.arange(ranges + 1, dtype=U64))
        some = np.flatnonzero(np.diff(cuts))
        spans = [slice(cuts[i], cuts[i + 1]) for i in some]
        return pa.table({
            "block": pa.repeat(table.column("block")[0], len(some)), "part": pa.array(some, pa.int64()),
            "grams": pa.array([_write(np.diff(keys[s] & _LOW, prepend=U64(0))) for s in spans], pa.binary()),
            "counts": pa.array([_write(counts[s]) for s in spans], pa.binary()),
        })

    def answer(table: pa.Table) -> pa.Table:
        found = [np.cumsum(_read(g.as_py()), dtype=U64) for g in table.column("grams")]
        ends = np.cumsum([len(f) for f in found])
        keys = np.concatenate(found)
        del found
        counts = np.concatenate([_read(c.as_py()) for c in table.column("counts")]).astype(np.int64)
        by = np.argsort(keys)
        ordered = keys[by]
        new = np.concatenate([[True], ordered[1:] != ordered[:-1]])
        del keys, ordered
        n = counts[by]
        outside = np.empty(len(n), np.int64)
        outside[by] = np.add.reduceat(n, np.flatnonzero(new))[np.cumsum(new) - 1] - n
        return pa.table({
            "block": table.column("block"), "part": table.column("part"),
            "outside": pa.array([_write(o) for o in np.split(outside, ends[:-1])], pa.binary()),
        })

    sent = blocks.groupBy("block").applyInArrow(send, "block long, part long, grams binary, counts binary")
    return sent.groupBy("part").applyInArrow(answer, "block long, part long, outside binary")


def _scored(blocks: DataFrame, counted: DataFrame, model: ngram.KneserNey, ranges: int, shared: bytes = b"") -> DataFrame:
    """The terms of the block's own texts, added up."""
    held = []

    def run(table: pa.Table, answers: pa.Table) -> pa.Table:
        if not held:
            held.append(ngram.Scorer(model))
        copies = table.column("copies").to_numpy()
        keys, counts = block_grams(table, ranges, shared)
        at = 0
        for o in answers.sort_by("part").column("outside"):
            found = _read(o.as_py()).astype(np.int64)
            counts[at : at + len(found)] += found
            at += len(found)
        if at != len(keys):
            raise RuntimeError("the answers do not fit the grams of the block")
        total, worded = [], []
        for first, texts in _texts(table.column("text"), shared):
            key, of, n, base = entries(texts, held[0], ranges)
            own = np.abs(n) * copies[first + of]
            others = counts[np.searchsorted(keys, key)] - own  # without the text and its copies
            with np.errstate(divide="ignore"):
                term = n * np.logaddexp(np.log(others), base)
            total.append(np.bincount(of, np.rint(term * UNIT), len(texts)).astype(np.int64))  # whole numbers, exact
            worded.append(np.bincount(of, minlength=len(texts)) > 0)
        worded = np.concatenate(worded)
        return pa.table({KEY: table.column(KEY).to_numpy()[worded], "log_p": np.concatenate(total)[worded]})

    return blocks.groupBy("block").cogroup(counted.groupBy("block")).applyInArrow(run, f"{KEY} long, log_p long")


def log_p(docs: DataFrame, model: ngram.KneserNey, text: str = "text") -> DataFrame:
    """(text_key, log_p long): the log probability of every different
    text with words, in units of ``1 / UNIT``."""
    size = docs.agg(F.sum(F.octet_length(F.col(text)))).first()[0] or 0
    least = min(docs.sparkSession.sparkContext.defaultParallelism, size // LEAST_BYTES)
    ranges = 1 + max(size // RANGE_BYTES, least)
    shared = _dictionary(docs, text)
    blocks = _blocks(docs, text, 1 + max(size // BLOCK_BYTES, least), shared)
    return _scored(blocks, _counted(blocks, ranges, shared), model, ranges, shared)
