"""Duplicate passages by lookup of 13-word windows in reference blocks.

Documents are dealt into blocks by hash.  Every block is both text to parse
and a reference block with an index; a document's references are the blocks'
documents with smaller ids.  A factor is a passage of ``min_words`` (13)
words or more that stands in a reference.  Every window is looked up; this is
not a relative Lempel-Ziv parse, and no longest match is sought: a factor is a
run of windows found under the same earliest document, so the next one may
begin within its last 12 words.  The union of the factors is exactly the words covered by
windows that also start in an earlier document.

The index is exchanged in two steps, each of one row per block and hash
bucket, so that a passage shared by a third of all documents costs a block
one entry, whatever the number of its documents:

1.  Seeds.  Of every window the 5-word sequence with the smallest hash is a
    seed (a minimizer: equal windows have equal seeds, and neighbouring
    windows mostly share theirs, so there are 2 seeds to 10 words).  Each
    block sends its different seeds to buckets; a bucket answers with a bit
    per seed: is it known in another block?
2.  Windows.  Only windows whose seed stands in two documents or more are
    sent, as 128-bit hashes with the smallest document that has them in the
    block; the bucket answers with the smallest document of all blocks.

Defined results: null and empty texts have no words and stay; a null id
counts as larger than any other (and nulls do not repeat each other);
repeated rows of one id do not repeat each other; an empty table gives an
empty result; other columns pass through whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from equiscope.llm.rows import chunks, read, row_struct
from equiscope.llm.text import U64, Texts, as_bytes

MIN_WORDS = 13
SEED_WORDS = 5
#: Text bytes per block and per hash bucket, roughly.
BLOCK_BYTES = 4 << 20
BUCKET_BYTES = 32 << 20
#: Small tables get smaller blocks, down to this, so that all cores have some.
LEAST_BYTES = 256 << 10
NO_ID = np.iinfo(np.int64).max


def _seeds(x: Texts, hashes: np.ndarray, min_words: int, seed_words: int):
    """(windows, position of each window's seed, hash of every seed position)."""
    at = x.windows(min_words)
    grams = x.windows(seed_words)
    h = np.full(len(x.starts) + min_words, np.iinfo(np.uint64).max, U64)
    h[grams] = x.window_hashes(hashes, grams, seed_words)
    span = min_words - seed_words + 1
    best, where = h.copy(), np.arange(len(h))
    have = 1
    while have < span:  # smallest of a growing run, doubling; the left one wins ties
        step = min(have, span - have)
        right = best[step:] < best[:-step]
        best = np.concatenate([np.where(right, best[step:], best[:-step]), best[-step:]])
        where = np.concatenate([np.where(right, where[step:], where[:-step]), where[-step:]])
        have += step
    return at, where[at], h


class Block:
    """Words, windows and seeds of some texts of a block."""

    def __init__(self, texts: list[bytes | None], ids: np.ndarray, min_words: int, seed_words: int):
        self.x = Texts(texts)
        self.hashes = self.x.word_hashes()
        self.at, self.seed_at, self.h = _seeds(self.x, self.hashes, min_words, seed_words)
        self.seed = self.h[self.seed_at]
        self.doc = ids[self.x.word_text[self.at]]
        self.min_words = min_words

    def keys(self, rows: np.ndarray) -> np.ndarray:
        """128-bit hashes of some windows, as rows of two 64-bit columns."""
        at = self.at[rows]
        one = self.x.window_hashes(self.hashes, at, self.min_words)
        two = self.x.window_hashes(self.x.word_hashes(5), at, self.min_words, 0x9FB21C651E98DF25)
        return np.stack([one, two], axis=1)


def _ids(column: pa.Array) -> np.ndarray:
    return column.cast(pa.int64()).fill_null(NO_ID).to_numpy(zero_copy_only=False)


def _parts(table: pa.Table, min_words: int, seed_words: int) -> Iterable[tuple[int, int, Block]]:
    ids = _ids(table.column("id").combine_chunks())
    for a, b, texts in chunks(table.column("text").combine_chunks()):
        yield a, b, Block(texts, ids[a:b], min_words, seed_words)


def _cuts(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket of sorted keys begins: buckets are equal ranges of
    the (first) hash."""
    first = _columns(keys)[:, 0]
    return np.searchsorted(((first >> U64(32)) * U64(buckets) >> U64(32)).astype(np.int64), np.arange(buckets + 1))


def _columns(keys: np.ndarray) -> np.ndarray:
    return keys if keys.ndim == 2 else keys[:, None]


def _distinct(keys: np.ndarray, docs: np.ndarray | None = None):
    """Order of the keys (columns of 64 bits; ties by document), and where
    in that order a new key begins."""
    columns = _columns(keys)
    by = np.lexsort([*([] if docs is None else [docs]), *columns.T[::-1]])
    new = np.ones(len(keys), bool)
    new[1:] = (columns[by][1:] != columns[by][:-1]).any(axis=1)
    return by, new


def _smallest(keys: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different keys in order, their smallest and largest document."""
    by, new = _distinct(keys, docs)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(keys))[: len(first)] - 1
    return keys[by[first]], docs[by[first]], docs[by[last]]


def _send(block: int, keys: np.ndarray, buckets: int, **more) -> pa.Table:
    """Rows (block, bucket, keys, ...) of sorted keys cut at the buckets."""
    cuts = _cuts(keys, buckets)
    some = np.flatnonzero(np.diff(cuts))
    columns = {"block": pa.array(np.full(len(some), block)), "bucket": pa.array(some)}
    for name, values in {"keys": keys, **more}.items():
        columns[name] = pa.array([values[cuts[i] : cuts[i + 1]].tobytes() for i in some], pa.binary())
    return pa.table(columns)


def _all_keys(table: pa.Table, name: str, columns: int = 1, kind="<u8") -> tuple[np.ndarray, np.ndarray]:
    """The keys of all rows of a bucket, and where each row's end."""
    raw = table.column(name).to_pylist()
    ends = np.cumsum([len(r) // (8 * columns) for r in raw])
    return np.frombuffer(b"".join(raw), kind).reshape(-1, columns), ends


def _find(wanted: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which keys are among the sorted wanted ones."""
    if not len(wanted):
        return np.zeros(len(keys), bool)
    return wanted[np.minimum(np.searchsorted(wanted, keys), len(wanted) - 1)] == keys


class Parser:
    """The exchange, for one table of (row, id, text, block).  All three
    passes group the same table, so Spark shuffles it once."""

    def __init__(self, blocks: DataFrame, buckets: int, min_words: int, seed_words: int):
        self.blocks, self.buckets, self.min_words, self.seed_words = blocks, buckets, min_words, seed_words

    def known_seeds(self) -> DataFrame:
        """(block, bucket, bits): which of the block's different seeds stand
        in another block too."""
        buckets, sizes = self.buckets, (self.min_words, self.seed_words)

        def send(table: pa.Table) -> pa.Table:
            found = [np.unique(part.seed) for _, _, part in _parts(table, *sizes)]
            keys = np.unique(np.concatenate(found)) if found else np.empty(0, U64)
            return _send(table.column("block")[0].as_py(), keys, buckets)

        def answer(table: pa.Table) -> pa.Table:
            keys, ends = _all_keys(table, "keys")
            ordered = np.sort(keys[:, 0])
            twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
            bits = [np.packbits(k).tobytes() for k in np.split(_find(twice, keys[:, 0]), ends[:-1])]
            return pa.table({"block": table.column("block"), "bucket": table.column("bucket"), "bits": pa.array(bits, pa.binary())})

        sent = self.blocks.groupBy("block").applyInArrow(send, "block long, bucket long, keys binary")
        return sent.groupBy("bucket").applyInArrow(answer, "block long, bucket long, bits binary")

    @staticmethod
    def _shared_windows(parts: list[Block], answers: pa.Table, buckets: int) -> list[np.ndarray]:
        """Windows of each part whose seed stands in two documents or more."""
        seeds, docs = np.concatenate([p.seed for p in parts]), np.concatenate([p.doc for p in parts])
        keys, least, most = _smallest(seeds, docs)
        shared = least < most
        cuts = _cuts(keys, buckets)
        for bucket, bits in zip(answers.column("bucket").to_pylist(), answers.column("bits").to_pylist(), strict=True):
            a, b = cuts[bucket], cuts[bucket + 1]
            shared[a:b] |= np.unpackbits(np.frombuffer(bits, np.uint8), count=b - a).astype(bool)
        wanted = keys[shared]
        return [np.flatnonzero(_find(wanted, p.seed)) for p in parts]

    def earliest(self, seeds: DataFrame) -> DataFrame:
        """(block, bucket, docs): for the block's different shared windows,
        in order, the smallest document that has them anywhere."""
        buckets, sizes, shared_windows = self.buckets, (self.min_words, self.seed_words), self._shared_windows

        def send(table: pa.Table, answers: pa.Table) -> pa.Table:
            parts = [p for _, _, p in _parts(table, *sizes)] if len(table) else []
            if not parts:
                return _send(0, np.empty((0, 2), U64), buckets, docs=np.empty(0, np.int64))
            rows = shared_windows(parts, answers, buckets)
            keys = np.concatenate([p.keys(r) for p, r in zip(parts, rows, strict=True)])
            docs = np.concatenate([p.doc[r] for p, r in zip(parts, rows, strict=True)])
            keys, least, _ = _smallest(keys, docs)
            return _send(table.column("block")[0].as_py(), keys, buckets, docs=least)

        def answer(table: pa.Table) -> pa.Table:
            keys, ends = _all_keys(table, "keys", columns=2)
            docs = _all_keys(table, "docs", kind="<i8")[0][:, 0]
            by, new = _distinct(keys, docs)
            first = docs[by[new]]
            least = np.empty(len(keys), np.int64)
            least[by] = first[np.cumsum(new) - 1]
            out = [d.tobytes() for d in np.split(least, ends[:-1])]
            return pa.table({"block": table.column("block"), "bucket": table.column("bucket"), "docs": pa.array(out, pa.binary())})

        sent = (
            self.blocks.groupBy("block").cogroup(seeds.groupBy("block"))
            .applyInArrow(send, "block long, bucket long, keys binary, docs binary")
        )
        return sent.groupBy("bucket").applyInArrow(answer, "block long, bucket long, docs binary")

    def parse(self, seeds: DataFrame, earliest: DataFrame) -> DataFrame:
        """(row, text, n_words, n_removed, factors) of every document."""
        buckets, sizes, shared_windows, n = self.buckets, (self.min_words, self.seed_words), self._shared_windows, self.min_words

        def finish(table: pa.Table, answers: pa.Table) -> pa.Table:
            if not len(table):  # answers alone: cannot be, as only blocks are answered
                raise ValueError("answers to a block that is not there")
            raw = as_bytes(table.column("text"))
            parts = list(_parts(table, *sizes))
            is_seed = pa.compute.is_valid(answers.column("bits"))
            rows = shared_windows([p for _, _, p in parts], answers.filter(is_seed), buckets)
            keys = np.concatenate([p.keys(r) for (_, _, p), r in zip(parts, rows, strict=True)])
            by, new = _distinct(keys)
            known, which = keys[by[new]], np.empty(len(keys), np.int64)
            which[by] = np.cumsum(new) - 1
            least = np.full(len(known), NO_ID)
            cuts = _cuts(known, buckets)
            windows = answers.filter(pa.compute.is_valid(answers.column("docs")))
            for bucket, docs in zip(windows.column("bucket").to_pylist(), windows.column("docs").to_pylist(), strict=True):
                least[cuts[bucket] : cuts[bucket + 1]] = np.frombuffer(docs, "<i8")
            done, out, words, removed, factors = 0, [], [], [], []
            for (a, b, p), r in zip(parts, rows, strict=True):
                source = least[which[done : done + len(r)]]
                done += len(r)
                hit = source < p.doc[r]
                cover, found = greedy(p.at[r][hit], source[hit], n, len(p.x.starts), p.x.bounds)
                words.append(p.x.counts)
                removed.append(np.diff(np.concatenate([[0], np.cumsum(cover)])[p.x.bounds]))
                factors += found
                out += cut_out(raw[a:b], p.x, cover)
            return pa.table({
                "row": table.column("row"), "text": pa.array([None if t is None else t.decode() for t in out], pa.string()),
                "n_words": pa.array(np.concatenate(words)), "n_removed": pa.array(np.concatenate(removed)),
                "factors": pa.array(factors, pa.list_(FACTOR)),
            })

        both = seeds.select("block", "bucket", "bits", F.lit(None).cast("binary").alias("docs")).union(
            earliest.select("block", "bucket", F.lit(None).cast("binary").alias("bits"), "docs")
        )
        kind = self.blocks.schema["row"].dataType.simpleString()
        fields = f"row {kind}, text string, n_words long, n_removed long, factors array<struct<start:long,n_words:long,source:long>>"
        return self.blocks.groupBy("block").cogroup(both.groupBy("block")).applyInArrow(finish, fields)


FACTOR = pa.struct([("start", pa.int64()), ("n_words", pa.int64()), ("source", pa.int64())])


def greedy(at: np.ndarray, source: np.ndarray, n: int, words: int, bounds: np.ndarray):
    """Factors from the windows found: runs of neighbours with one source.
    Returns the covered words and, per text, (first word, words, source)."""
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] != at[:-1] + 1) | (source[1:] != source[:-1])
    first = np.flatnonzero(new)
    starts, sources = at[first], source[first]
    ends = at[np.append(first[1:], len(at))[: len(first)] - 1] + n
    edge = np.zeros(words + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, ends, -1)
    text = np.searchsorted(bounds, starts, "right") - 1
    cuts = np.searchsorted(text, np.arange(len(bounds)))
    rows = list(zip((starts - bounds[text]).tolist(), (ends - starts).tolist(), sources.tolist(), strict=True))
    fields = [{"start": s, "n_words": k, "source": d} for s, k, d in rows]
    return (np.cumsum(edge[:-1]) > 0).astype(np.int64), [fields[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def cut_out(texts: list[bytes | None], x: Texts, cover: np.ndarray) -> list[bytes | None]:
    """The texts without the covered words.  A run of kept words stays as it
    was written; two runs are joined by one space."""
    out = list(texts)
    touched = np.flatnonzero(np.diff(np.concatenate([[0], np.cumsum(cover)])[x.bounds]))
    for i in touched.tolist():
        lo, hi = x.bounds[i], x.bounds[i + 1]
        c, base, t = cover[lo:hi], x.text_starts[i], texts[i]
        edge = np.diff(c, prepend=1, append=1)
        keep_from, keep_to = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
        s, e = x.starts[lo:hi] - base, x.ends[lo:hi] - base
        runs = [t[s[a] : e[b - 1]] for a, b in zip(keep_from.tolist(), keep_to.tolist(), strict=True)]
        out[i] = b" ".join(runs)
    return out


def parse(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS,
          seed_words: int = SEED_WORDS, keep: list[str] | None = None) -> DataFrame:
    """(row, text, n_words, n_removed, factors): the kept columns, the text
    without its duplicate passages, and the factors that were found."""
    total = docs.agg(F.sum(F.octet_length(docs[text]) + 64)).first()[0] or 0
    tasks = 2 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n_blocks = 1 + max(total // BLOCK_BYTES, min(tasks, total // LEAST_BYTES))
    buckets = 1 + max(total // BUCKET_BYTES, min(tasks, total // LEAST_BYTES))
    keep = docs.columns if keep is None else keep
    blocks = docs.select(
        row_struct(docs, [c for c in keep if c != text]),
        docs[doc_id].alias("id"), docs[text].alias("text"),
        F.pmod(F.xxhash64(docs[doc_id], docs[text]), F.lit(n_blocks)).alias("block"),
    )
    p = Parser(blocks, buckets, min_words, seed_words)
    seeds = p.known_seeds()
    return p.parse(seeds, p.earliest(seeds))


def without_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """``docs`` with the passages cut out and the character count renewed."""
    found = parse(docs, doc_id, text)
    new = {text: F.col("text"), n_chars: F.length("text").cast(docs.schema[n_chars].dataType)}
    return found.select(*[new[c].alias(c) if c in new else F.col("row").getField(c).alias(c) for c in docs.columns])


def op7_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = parse(read(spark, sf_dir, "documents"), keep=["doc_id"])
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    kept = F.sha2(F.array_join(F.coalesce(words, F.array().cast("array<string>")), " "), 256)
    return found.select("row.doc_id", "n_words", "n_removed", kept.alias("kept_sha256"))
