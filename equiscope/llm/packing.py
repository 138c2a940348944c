"""Best-fit packing of tokenised documents by minimum bin slack.

Tokens: byte-level BPE ids plus an end id per document.  Only documents over
the capacity are cut, into pieces of the capacity with the first piece
shorter.  Bins are filled one after another: a bin starts with the longest
piece left, and a bitset subset-sum dynamic programme over the lengths still
available finds the fullest combination for the rest, which is removed.

Pieces of one length are alike, so the choice needs only how many pieces of
each length there are: at most ``capacity`` counts reach the driver, however
many documents there are, and a combination is taken as many times at once
as its lengths last.  Spark hands the places out: the k-th piece of a length
(numbered within its task when the tokens were made, plus the counts of the
tasks before it) takes the k-th place that the combinations have for that
length.  No window runs over all pieces of a length.

Ids are those of the ``tokenizers`` library.  Each different stretch of text
between safe spaces (a single space between characters that are certainly
not white space, where the pre-tokenizer always cuts) is encoded once per
chunk, by ``tiktoken`` with the same vocabulary; texts that spell out the
special token go through ``tokenizers`` itself.

Defined results: a null text is an empty one (one piece holding the end id);
a null id is packed and returned as null; repeated rows are packed one by
one; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from equiscope.llm.rows import chunks, cut_lineage, read
from equiscope.llm.text import U64, mix, spans_hash, worker_cache

CAPACITY = 1024
END_ID = 2
VOCABULARY = "byte_bpe_50k"
SPECIAL = "<|endoftext|>"
CHUNK = 2 << 20


class Tokens:
    """Ids of a batch of texts under a byte-level BPE vocabulary."""

    def __init__(self, vocabulary: str):
        import public_tokenizers as public
        import tiktoken

        with open(public.path(f"{vocabulary}.tiktoken"), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.fast = tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.size = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, i in ranks.items():
            self.size[i] = len(token)
        self.json = public.path(f"{vocabulary}.json")
        self.whole = None

    @classmethod
    def get(cls, vocabulary: str) -> Tokens:
        cache = worker_cache()
        return cache.setdefault(vocabulary, None) or cache.__setitem__(vocabulary, cls(vocabulary)) or cache[vocabulary]

    def with_special(self, text: str) -> np.ndarray:
        if self.whole is None:
            from tokenizers import Tokenizer

            self.whole = Tokenizer.from_file(self.json)
        return np.array(self.whole.encode(text, add_special_tokens=False).ids, np.uint32)

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        """Ids of every text."""
        plain = [i for i, t in enumerate(texts) if SPECIAL.encode() not in t]
        out = [None] * len(texts)
        for i, ids in zip(plain, self._plain([texts[i] for i in plain]), strict=True):
            out[i] = ids
        return [self.with_special(t.decode()) if ids is None else ids for t, ids in zip(texts, out, strict=True)]

    def _plain(self, texts: list[bytes]) -> list[np.ndarray]:
        if not texts:
            return []
        buf = np.frombuffer(b"".join(texts) + b"  ", np.uint8)
        starts = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
        at = np.flatnonzero(buf[:-1] == 32)
        at = at[(at >= 2)]
        before, two_before, after = buf[at - 1], buf[at - 2], buf[at + 1]
        plain_before = (before > 32) & (before < 127) | (before >= 128) & (two_before >= 0xC3) & (two_before < 0xE0)
        plain_after = (after > 32) & (after < 127) | (after >= 0xC3) & (after < 0xE0)
        cuts = at[plain_before & plain_after]
        head = np.searchsorted(starts, cuts, "right") - 1  # a space that opens a text, or ends it, is no safe cut
        cuts = cuts[(cuts - starts[head] >= 2) & (cuts + 1 < starts[head + 1])]
        bounds = np.sort(np.concatenate([cuts, starts]))
        bounds = bounds[np.diff(bounds, prepend=-1) > 0]
        lo, hi = bounds[:-1], bounds[1:]
        opens = np.zeros(len(buf), bool)
        opens[starts] = True
        inner = ~opens[lo]
        table = mix(np.arange(256, dtype=U64) + U64(31))
        keys = spans_hash(table[buf], lo[inner], hi[inner])
        _, first, which = np.unique(keys, return_index=True, return_inverse=True)
        s, e = lo[inner][first], hi[inner][first]
        raw = buf.tobytes()
        ids = np.array(self.fast.encode_ordinary(b"".join([raw[a:b] for a, b in zip(s.tolist(), e.tolist())]).decode()), np.uint32)
        ends = np.searchsorted(np.cumsum(self.size[ids]), np.cumsum(e - s)) + 1
        opening = [self.fast.encode_ordinary(raw[a:b].decode()) for a, b in zip(lo[~inner].tolist(), hi[~inner].tolist())]
        pool = np.concatenate([ids, *[np.array(o, np.uint32) for o in opening]])
        ends = np.concatenate([ends, len(ids) + np.cumsum([len(o) for o in opening])]).astype(np.int64)
        begins = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
        unit = np.empty(len(lo), np.int64)
        unit[inner] = which
        unit[~inner] = len(first) + np.arange(len(opening))
        n = (ends - begins)[unit]
        done = np.concatenate([[0], np.cumsum(n)])
        flat = pool[np.repeat(begins[unit] - done[:-1], n) + np.arange(done[-1])]
        of_text = done[np.searchsorted(bounds, starts)]
        return [flat[a:b] for a, b in zip(of_text[:-1], of_text[1:], strict=True)]


def pieces(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY,
           vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, task, number): ``number``
    counts the pieces of one length within the task."""

    def run(batches):
        tokens, seen, task = Tokens.get(vocabulary), Counter(), TaskContext.get().partitionId()
        for batch in batches:
            for a, b, texts in chunks(batch.column(1), CHUNK):
                rows, ids_of = [], tokens.encode([t or b"" for t in texts])
                for i, ids in enumerate(ids_of):
                    ids = np.append(ids, np.uint32(END_ID)).astype("<u4")
                    start, first = 0, len(ids) % capacity or min(len(ids), capacity)
                    for piece, end in enumerate(range(first, len(ids) + 1, capacity)):
                        length = end - start
                        rows.append((i, piece, start, length, zlib.crc32(ids[start:end].tobytes()), seen[length]))
                        seen[length] += 1
                        start = end
                at, *columns = (pa.array(c) for c in zip(*rows, strict=True))
                columns[0] = columns[0].cast(pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a).take(at), *columns, pa.array(np.full(len(at), task))],
                    names=["doc_id", "piece", "start", "length", "ids_crc32", "number", "task"],
                )

    taken = docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text"))
    kind = taken.schema["doc_id"].dataType.simpleString()
    fields = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, number long, task long"
    return taken.mapInArrow(run, fields)


def fullest(counts: dict[int, int], room: int) -> list[int]:
    """Lengths, by subset-sum over a bitset, that fill ``room`` as far as the
    available lengths can; longer ones are preferred."""
    order = sorted((n for n in counts if n <= room and counts[n]), reverse=True)
    reach, steps, mask = 1, [], (1 << (room + 1)) - 1
    for n in order:
        left, take = min(counts[n], room // n), 1
        while left and not reach >> room & 1:
            take = min(take, left)
            steps.append((n, take, reach))
            reach |= (reach << (n * take)) & mask
            left -= take
            take *= 2
    at, found = reach.bit_length() - 1, []
    for n, take, before in reversed(steps):
        if not before >> at & 1:
            found += [n] * take
            at -= n * take
    return found


def minimum_slack(counts: dict[int, int], capacity: int) -> list[tuple[int, list[int]]]:
    """(times, lengths) until no piece is left."""
    left, plan = {n: c for n, c in counts.items() if c}, []
    while left:
        top = max(left)
        rest = dict(left)
        rest[top] -= 1
        chosen = [top, *fullest(rest, capacity - top)]
        need = Counter(chosen)
        times = min(left[n] // k for n, k in need.items())
        plan.append((times, chosen))
        for n, k in need.items():
            left[n] -= times * k
            if not left[n]:
                del left[n]
    return plan


def places(plan: list[tuple[int, list[int]]]) -> list[tuple]:
    """Rows (length, from, to, per_bin, first_bin, offset): the pieces of
    ``length`` numbered from .. to - 1 go, ``per_bin`` at a time, to the bins
    from ``first_bin`` on, side by side from ``offset``."""
    rows, used, bins = [], Counter(), 0
    for times, chosen in plan:
        offset = 0
        for n, k in sorted(Counter(chosen).items(), reverse=True):
            rows.append((n, used[n], used[n] + k * times, k, bins, offset))
            used[n] += k * times
            offset += n * k
        bins += times
    return rows


def pack(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY,
         vocabulary: str = VOCABULARY) -> DataFrame:
    """One row per piece with its sequence and its place there."""
    spark = docs.sparkSession
    made = cut_lineage(pieces(docs, doc_id, text, capacity, vocabulary))
    by_task = made.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n"))
    upto = Window.partitionBy("length").orderBy("task")
    first = cut_lineage(by_task.withColumn("first", F.sum("n").over(upto) - F.col("n")))
    counts = {r["length"]: r["n"] for r in first.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    rows = places(minimum_slack(counts, capacity))
    schema = "length long, low long, high long, per_bin long, first_bin long, base long"
    slots = F.broadcast(spark.createDataFrame(rows, schema))  # bounded by the capacity, not by the documents
    numbered = made.join(first.select("length", "task", "first"), ["length", "task"]).withColumn(
        "k", F.col("first") + F.col("number")
    )
    placed = numbered.join(slots, ["length"]).filter((F.col("k") >= F.col("low")) & (F.col("k") < F.col("high")))
    nth = F.col("k") - F.col("low")
    return placed.select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        (F.col("first_bin") + F.floor(nth / F.col("per_bin")).cast("long")).alias("sequence_id"),
        (F.col("base") + (nth % F.col("per_bin")) * F.col("length")).alias("offset"),
    )


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read(spark, sf_dir, "documents"))
