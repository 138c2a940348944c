"""Spelling variants: words that differ by one edit, found on dense tiles.

Two words are near if one inserted, deleted or replaced code point turns one
into the other: with M the longer one's length, their common prefix and
common suffix together reach M - 1.  One of the two then reaches
``h = ceil((M - 1) / 2)``, so near words share their first h or their last h
code points.  A word of length L therefore goes to four groups: with M = L
(as the longer or an equally long word) and M = L + 1 (as the shorter), by
prefix and by suffix.

A group's words are compared densely, as tiles: two padded code-point
matrices (aligned left for prefixes, right for suffixes) are compared column
by column for all pairs of their rows at once, and the common prefix and
suffix lengths identify the near pairs.  Small groups of about one size are
stacked into one comparison.  A group over the tile size (``TILE_WORDS``,
fewer for long words) is cut into blocks by hash, and each pair of blocks is
a tile of its own, so no task holds a whole large group.  A pair that shares
both prefix and suffix counts on the prefix side alone.

What leaves a tile is not pairs but one row per word: its near words here and
the best of them.  Following forms to the root is pointer jumping: each round
doubles the distance, and a form's count at least doubles with every step, so
there are at most six rounds.

Defined results: a null text has no words; a null id counts as empty text in
the hash; repeated rows count as often as they stand there; an empty table
gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from equiscope.llm.rows import chunks, cut_lineage, read
from equiscope.llm.text import LOWER, U64, Texts, mix

MIN_LENGTH = 5
MIN_COUNT = 3
#: A word's form has at least so many times its count.
FORM_RATIO = 2
#: Hash remainder at which a run loses a code point.
DELETE_EVERY = 97
#: Words a side of a tile, while they have at most TILE_CHARS code points in all.
TILE_WORDS = 512
TILE_CHARS = 1 << 15
#: Cells of one dense comparison.
CELLS = 1 << 20
#: Different words a task holds before it hands their counts on.
HELD_WORDS = 200_000

_B = np.arange(256)
_LETTER = ((_B | 32) >= 97) & ((_B | 32) <= 122)


def _crc_table() -> np.ndarray:
    """The 256 steps of the reflected CRC-32, by its rule."""
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, (t >> 1) ^ np.uint32(0xEDB88320), t >> 1).astype(np.uint32)
    return t


_CRC = _crc_table()


class Runs(Texts):
    """Maximal runs of ``[A-Za-z\\u00C0-\\u00FF]``, A-Z lower-cased: in UTF-8
    ASCII letters, and byte C3 with the byte behind it."""

    def __init__(self, texts: list[bytes | None]):
        super().__init__(texts, fold=LOWER)
        lead = self.buf == 0xC3
        inside = _LETTER[self.buf] | lead
        inside[1:] |= lead[:-1]
        edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
        self.starts, self.ends = edge[0::2], edge[1::2]
        self.bounds = np.searchsorted(self.starts, np.append(self.text_starts, len(self.buf)))
        self.counts = np.diff(self.bounds)

    def crc(self, states: np.ndarray) -> np.ndarray:
        """crc32 of every run after what its text's state stands for; runs
        advance together, the longer ones further."""
        state = states[self.word_text]
        size = self.ends - self.starts
        by = np.argsort(-size, kind="stable")
        ordered, starts, now = size[by], self.starts[by], state[by]
        for k in range(int(size.max(initial=0))):
            n = int(np.searchsorted(-ordered, -k, "left"))  # runs longer than k
            now[:n] = _CRC[(now[:n] ^ self.buf[starts[:n] + k]) & 0xFF] ^ (now[:n] >> np.uint32(8))
        out = np.empty_like(now)
        out[by] = now
        return out ^ np.uint32(0xFFFFFFFF)


def count_runs(ids: list, texts: list[bytes | None], total: dict[bytes, int]) -> None:
    """Add the counts of the words of some texts."""
    x = Runs(texts)
    if not len(x.starts):
        return
    states = [zlib.crc32(b"%s:" % (b"" if i is None else str(i).encode())) ^ 0xFFFFFFFF for i in ids]
    h = x.crc(np.array(states, np.uint32))
    cut = h % DELETE_EVERY == 0
    _, first, n = np.unique(x.word_hashes()[~cut], return_index=True, return_counts=True)
    data = x.buf.tobytes()
    for a, b, k in zip(x.starts[~cut][first].tolist(), x.ends[~cut][first].tolist(), n.tolist(), strict=True):
        if b - a >= MIN_LENGTH:
            total[data[a:b]] = total.get(data[a:b], 0) + k
    for a, b, k in zip(x.starts[cut].tolist(), x.ends[cut].tolist(), h[cut].tolist(), strict=True):
        word = data[a:b].decode()
        at = k % len(word)
        word = (word[:at] + word[at + 1 :]).encode()
        total[word] = total.get(word, 0) + 1


def words(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, n long): words of at least MIN_LENGTH code points that occur
    MIN_COUNT times or more."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[bytes, int] = {}

        def rows():
            got = pa.record_batch({"word": pa.array([w.decode() for w in total], pa.string()), "n": pa.array(list(total.values()), pa.int64())})
            total.clear()
            return got

        for batch in batches:
            ids = batch.column(0).to_pylist()
            for a, b, texts in chunks(batch.column(1)):
                count_runs(ids[a:b], texts, total)
                if len(total) >= HELD_WORDS:
                    yield rows()
        yield rows()

    taken = docs.select(docs[doc_id].cast("string"), docs[text].cast("string"))
    partial = taken.mapInArrow(run, "word string, n long").filter(F.char_length("word") >= MIN_LENGTH)
    return partial.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= MIN_COUNT)


def tiles(words: DataFrame) -> DataFrame:
    """(m, side, affix, a, b, block, word, n): a row per word and tile it stands in.
    The affix is a hash: an equal hash of different affixes only adds
    comparisons."""
    size = F.char_length("word")
    keyed = words.withColumn("m", F.explode(F.array(size, size + 1)))
    half = F.floor(F.col("m") / 2).cast("int")  # ceil((m - 1) / 2)
    side = F.explode(F.array(F.lit(0), F.lit(1))).alias("side")
    keyed = keyed.select("*", side).withColumn(
        "affix", F.xxhash64(F.when(F.col("side") == 0, F.left("word", half)).otherwise(F.right("word", half)))
    )
    key = ["m", "side", "affix"]
    room = F.greatest(F.lit(1), F.least(F.lit(TILE_WORDS), F.floor(F.lit(TILE_CHARS) / F.col("m"))))
    large = keyed.groupBy(*key).agg(F.count(F.lit(1)).alias("size")).filter(F.col("size") > room)
    large = large.select(*key, F.ceil(F.col("size") / room).cast("int").alias("blocks"))
    cut = keyed.join(large, key, "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    cut = cut.withColumn("block", F.pmod(F.xxhash64("word", F.lit(1)), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = cut.withColumn("other", other)
    return dealt.select(
        *key, F.least("block", "other").alias("a"), F.greatest("block", "other").alias("b"), "block", "word", "n"
    )


def _matrices(codes: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of every word, padded to the longest: aligned left and right."""
    longest = int(sizes.max())
    column = np.arange(longest)
    inside = column[None, :] < sizes[:, None]
    at = np.where(inside, starts[:, None] + column[None, :], 0)
    left = np.where(inside, codes[at], 0)
    back = np.where(inside, starts[:, None] + sizes[:, None] - 1 - column[None, :], 0)
    return left, np.where(inside, codes[back], 0)


def _common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How far each row of a and the same row of b agree."""
    differ = (a != b) | (a == 0)
    return np.where(differ.any(1), differ.argmax(1), a.shape[1])


def _packed(columns: np.ndarray) -> np.ndarray:
    """One number for each row's code points (a hash: equal rows, equal numbers)."""
    out = np.full(len(columns), columns.shape[1], U64)
    for k in range(columns.shape[1]):
        out = mix(out ^ columns[:, k].astype(U64))
    return out


def near_in_tiles(batch: pa.Table) -> dict[str, np.ndarray] | None:
    """(word, near, of): rows of the batch and their near words' rows, both ways.
    The batch holds whole tiles, each one's rows together."""
    m, side, affix, a, b, block = (batch.column(c).to_numpy() for c in ("m", "side", "affix", "a", "b", "block"))
    new = np.zeros(len(m), bool)
    new[0] = True
    for c in (m, side, affix, a, b):
        new[1:] |= c[1:] != c[:-1]
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(m)))
    text = batch.column("word").combine_chunks()
    joined = "".join(text.to_pylist())
    codes = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
    sizes = pa.compute.utf8_length(text).to_numpy().astype(np.int64)
    starts = np.cumsum(sizes) - sizes
    room = 1 << np.ceil(np.log2(count)).astype(np.int64)  # groups of about one size are stacked
    found = []
    for longest in np.unique(m[first]):
        for width in np.unique(room[(m[first] == longest) & (count > 1)]):
            group = np.flatnonzero((m[first] == longest) & (room == width) & (count > 1))
            step = max(1, CELLS // int(width * width))
            for at in range(0, len(group), step):
                g = group[at : at + step]
                rows = first[g][:, None] + np.minimum(np.arange(width), count[g][:, None] - 1)
                real = np.arange(width) < count[g][:, None]
                found.append(_near(rows, real, int(longest), side[first[g]], a[first[g]] != b[first[g]], block, codes, starts, sizes))
    return np.concatenate(found, 1) if found else np.empty((2, 0), np.int64)


def _near(rows, real, longest, side, mixed, block, codes, starts, sizes) -> np.ndarray:
    """Near pairs (word row, near row), both ways, of the stacked groups.

    With h code points of the group's own end in common, r = longest - 1 - h
    are to be made up by what follows them and by the other end, so one of
    the two has ``q = ceil(r / 2)``: all pairs are compared in these two packed
    columns, and those that agree in one of them code point by code point."""
    group, width = rows.shape
    flat = rows.ravel()
    left, right = _matrices(codes, starts[flat], sizes[flat])
    from_right = np.repeat(side == 1, width)[:, None]
    near_end, far_end = np.where(from_right, right, left), np.where(from_right, left, right)
    half = longest // 2
    q = (longest - half) // 2  # ceil((longest - 1 - half) / 2)
    screen = np.zeros((group, width, width), bool)
    for column in (_packed(near_end[:, half : half + q]), _packed(far_end[:, :q])):
        column = column.reshape(group, width)
        screen |= column[:, :, None] == column[:, None, :]
    size = sizes[rows]
    screen &= (size == longest)[:, :, None] | (size == longest)[:, None, :]
    # a tile of two blocks compares one with the other; each block with itself is a tile of its own
    screen &= ~mixed[:, None, None] | (block[rows][:, :, None] != block[rows][:, None, :])
    screen &= real[:, :, None] & real[:, None, :] & (np.arange(width)[:, None] < np.arange(width))
    g, i, j = np.nonzero(screen)
    found = []
    step = max(1, CELLS // longest)
    for at in range(0, len(g), step):
        k = slice(at, at + step)
        x, y = g[k] * width + i[k], g[k] * width + j[k]
        own, other = _common(near_end[x], near_end[y]), _common(far_end[x], far_end[y])
        near = (own + other >= longest - 1) & (own >= half)
        near &= (side[g[k]] == 0) | (other < half)  # on the prefix side, if on both
        found.append(np.stack([flat[x[near]], flat[y[near]]]))
    pairs = np.concatenate(found, 1) if found else np.empty((2, 0), np.int64)
    return np.concatenate([pairs, pairs[::-1]], 1)


def _compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole tiles at a time: the last tile of a batch waits for the next one."""
    held = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if held is not None:
            table = pa.concat_tables([held, table])
        last = 0
        keys = [table.column(c).to_numpy() for c in ("m", "side", "affix", "a", "b")]
        if table.num_rows > 1:
            change = np.zeros(table.num_rows - 1, bool)
            for c in keys:
                change |= c[1:] != c[:-1]
            ends = np.flatnonzero(change)
            last = int(ends[-1]) + 1 if len(ends) else 0
        held = table.slice(last)
        if last:
            yield from _rows(table.slice(0, last))
    if held is not None and held.num_rows:
        yield from _rows(held)


def _rows(table: pa.Table) -> Iterator[pa.RecordBatch]:
    """(word, n_near, best_n, best): a row per word of the tiles that has near words."""
    word, near = near_in_tiles(table)
    if not len(word):
        return
    text, n = table.column("word").combine_chunks(), table.column("n").to_numpy()
    rank = np.empty(table.num_rows, np.int64)  # by code points, which UTF-8 keeps
    rank[pa.compute.sort_indices(text).to_numpy()] = np.arange(table.num_rows)
    by = np.lexsort((rank[near], -n[near], word))
    word, near = word[by], near[by]
    first = np.flatnonzero(np.diff(word, prepend=-1))
    yield pa.record_batch(
        {
            "word": text.take(pa.array(word[first])),
            "n_near": pa.array(np.diff(np.append(first, len(word)))),
            "best_n": pa.array(n[near[first]]),
            "best": text.take(pa.array(near[first])),
        }
    )


def near_words(counted: DataFrame) -> DataFrame:
    """(word, n_near long, best_n, best) of the words that have near words."""
    key = ["m", "side", "affix", "a", "b"]
    dealt = tiles(counted).repartition(*key).sortWithinPartitions(*key)
    found = dealt.mapInArrow(_compare, "word string, n_near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("less"), F.col("best"))).alias("first")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best).select(
        "word", "n_near", (-F.col("first.less")).alias("best_n"), F.col("first.best").alias("best")
    )


def roots(forms: DataFrame) -> DataFrame:
    """(word, form), acyclic -> (word, root), by pointer jumping."""
    now = cut_lineage(forms.select("word", F.col("form").alias("root")))
    while True:
        onward = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = cut_lineage(now.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("on")))
        now = moved.select("word", "root")
        if moved.filter("on").isEmpty():
            return now


def variants(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word."""
    counted = cut_lineage(words(docs, doc_id, text))
    has_form = F.col("best_n") >= FORM_RATIO * F.col("n")
    found = cut_lineage(
        counted.join(near_words(counted), "word", "left").select(
            "word",
            F.when(has_form, F.col("best")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(has_form, F.col("best_n")).alias("form_n"),
        )
    )
    ends = roots(found.filter("form is not null"))
    return found.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(read(spark, sf_dir, "documents"))


_UPPER, _SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: crc32 code point by code point (one byte below 128, else C3 and one more),
#: near words by equal deletions, roots by following forms.
ORACLE_SQL = rf"""
WITH RECURSIVE bits(b, k, c) AS (
    SELECT range, 0, range FROM range(256)
    UNION ALL
    SELECT b, k + 1, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM bits WHERE k < 8
),
tab AS MATERIALIZED (SELECT b, c FROM bits WHERE k = 8),
runs AS MATERIALIZED (
    SELECT coalesce(doc_id::VARCHAR, '') || ':' || run AS s, run, count(*) AS k FROM (
        SELECT doc_id, unnest(regexp_extract_all(translate(text, '{_UPPER}', '{_SMALL}'), '[a-z\x{{00C0}}-\x{{00FF}}]+')) AS run
        FROM documents)
    GROUP BY ALL
),
walk(s, run, k, pos, state) AS (
    SELECT s, run, k, 1, 4294967295 FROM runs
    UNION ALL
    SELECT s, run, k, pos + 1,
        CASE WHEN cp < 128 THEN s1 ELSE xor((SELECT c FROM tab WHERE b = xor(s1, cp - 64) & 255), s1 >> 8) END
    FROM (
        SELECT w.*, unicode(substr(s, pos, 1)) AS cp, xor(t.c, state >> 8) AS s1
        FROM walk w JOIN tab t
            ON t.b = xor(state, CASE WHEN unicode(substr(s, pos, 1)) < 128 THEN unicode(substr(s, pos, 1)) ELSE 195 END) & 255
        WHERE pos <= length(s))
),
hashed AS (SELECT run, k, xor(state, 4294967295) AS h FROM walk WHERE pos = length(s) + 1),
words AS MATERIALIZED (
    SELECT word, sum(k)::BIGINT AS n FROM (
        SELECT k, CASE WHEN h % 97 = 0 THEN substr(run, 1, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2)
            ELSE run END AS word FROM hashed)
    GROUP BY word HAVING length(word) >= 5 AND sum(k) >= 3
),
dels AS MATERIALIZED (
    SELECT word, n, length(word) AS size, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
    FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)
),
longer AS (SELECT DISTINCT d.word AS big, d.n AS big_n, w.word AS small, w.n AS small_n FROM dels d JOIN words w ON d.rest = w.word),
near AS (
    SELECT a.word, a.n, b.word AS other, b.n AS other_n
    FROM dels a JOIN dels b ON a.size = b.size AND a.i = b.i AND a.rest = b.rest AND a.word <> b.word
    UNION ALL SELECT big, big_n, small, small_n FROM longer
    UNION ALL SELECT small, small_n, big, big_n FROM longer
),
ranked AS (
    SELECT *, count(*) OVER (PARTITION BY word) AS n_near,
        row_number() OVER (PARTITION BY word ORDER BY other_n DESC, other) AS place
    FROM near
),
forms AS MATERIALIZED (
    SELECT w.word, w.n, CASE WHEN other_n >= 2 * w.n THEN other END AS form,
        coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 2 * w.n THEN other_n END AS form_n
    FROM words w LEFT JOIN (SELECT * FROM ranked WHERE place = 1) r ON r.word = w.word
),
chain(word, root, next) AS (
    SELECT word, word, form FROM forms
    UNION ALL
    SELECT c.word, c.next, f.form FROM chain c JOIN forms f ON f.word = c.next
)
SELECT f.word, f.form, c.root, f.n, f.n_near, f.form_n
FROM forms f JOIN chain c ON c.word = f.word AND c.next IS NULL
"""
