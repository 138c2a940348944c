"""Phrase collocations, from depth-truncated suffix trees built group by group.

A text is lower-cased (A-Z), cut into pieces at ``[.,;:!?\\x0A-\\x0D]`` and
these into words.  Every word starts a suffix of its piece, of which the
first ``DEPTH`` words are looked at.  As in ERA (Mansour et al., "ERA:
efficient serial and parallel suffix tree construction"), the suffixes are
partitioned vertically, by prefixes whose frequencies fit a memory budget,
and each group's subtree is built on its own:

* A first pass counts prefixes of one and of two words per hash cell
  (``2 * CELLS`` numbers reach the driver, however large the corpus is).
  Cells of one-word prefixes are packed into groups of at most
  ``GROUP_SUFFIXES`` suffixes.  Where a cell alone is over the budget, its
  suffixes go by their first two words, and where that is over it, by all three.
* A second pass sends every suffix to its group.  A block of texts
  (``BLOCK_WORDS``) adds up its equal suffixes first and sends one row per
  group: a dictionary of words and sorted arrays of word numbers.
* A group's task sorts its suffixes; runs of equal beginnings are the nodes
  of the subtree, and a node's count is the total of its leaves.  Nodes that
  another group may hold as well are handed on as they are and added up by Spark;
  of the others only those with ``MIN_COUNT`` occurrences leave the task.

A phrase of two or three words with at least MIN_COUNT occurrences is a
candidate; all parts of a candidate are at least as frequent, so all counts
that its score needs have left the tasks too.  Scores are whole numbers of
``1 / SCORE`` in exact decimal arithmetic (counts up to 10**15).

Defined results: a null text has no words; a null language is ``und``; repeated
rows count as often as they stand there; an empty table gives an empty
result.  Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from equiscope.llm.rows import chunks, cut_lineage, read
from equiscope.llm.text import LOWER, U64, Texts, mix

MIN_COUNT = 10
#: A longer candidate with this percentage of a phrase's count takes its place.
ABSORB_PERCENT = 50
SCORE = 1_000_000
TOP = 2000
UNKNOWN_LANGUAGE = "und"
DEPTH = 3
#: Suffixes of a group, words of a block, hash cells per prefix length.  With
#: more input, groups and blocks grow together, as far as memory allows.
GROUP_SUFFIXES = 1 << 20
BLOCK_WORDS = 1 << 20
CELLS = 1 << 16

_B = np.arange(256)
_STOP = np.isin(_B, list(b".,;:!?\n\x0b\x0c\r"))
_SEPARATOR = _STOP | (_B == 32) | (_B == 9)


class Block:
    """Words of some texts: hash, language number and whether the next word
    follows in the same piece; and a string for every hash."""

    def __init__(self):
        self.hashes, self.langs, self.links = [], [], []
        self.strings: dict[int, bytes] = {}
        self.lang_names: dict[str, int] = {}
        self.size = 0

    def add(self, texts: list[bytes | None], langs: list[str]) -> None:
        x = Texts(texts, separators=_SEPARATOR, fold=LOWER)
        if not len(x.starts):
            return
        stops = np.concatenate([[0], np.cumsum(_STOP[x.buf])])
        link = np.zeros(len(x.starts), bool)
        link[:-1] = stops[x.starts[1:]] == stops[x.ends[:-1]]
        h = x.word_hashes()
        of = [self.lang_names.setdefault(name, len(self.lang_names)) for name in langs]
        self.hashes.append(h)
        self.langs.append(np.array(of, np.int64)[x.word_text])
        self.links.append(link)
        self.size += len(h)
        found, first = np.unique(h, return_index=True)
        data = x.buf.tobytes()
        for key, a, b in zip(found.tolist(), x.starts[first].tolist(), x.ends[first].tolist(), strict=True):
            if key not in self.strings:
                self.strings[key] = data[a:b]

    def parts(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(hashes, langs, links) of at most BLOCK_WORDS words and the
        DEPTH - 1 words behind them, which start no suffix here."""
        if not self.size:
            return
        h, lang, link = (np.concatenate(v) for v in (self.hashes, self.langs, self.links))
        for at in range(0, len(h), BLOCK_WORDS):
            cut = slice(at, at + BLOCK_WORDS + DEPTH - 1)
            yield h[cut], lang[cut], link[cut]

    def names(self) -> list[str]:
        return list(self.lang_names)


def _blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[Block]:
    block = Block()
    for batch in batches:
        langs = batch.column(1).to_pylist()
        for a, b, texts in chunks(batch.column(0)):
            block.add(texts, langs[a:b])
            if block.size >= BLOCK_WORDS:
                yield block
                block = Block()
    yield block


def _name_hashes(names: list[str]) -> np.ndarray:
    x = Texts([n.encode().replace(b"\n", b"\0\0") for n in names], separators=_B == 10)
    out = np.zeros(len(names), U64)
    out[x.word_text] = x.word_hashes(5)
    return out


def _chained(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hash of a prefix and one more word (0: none)."""
    return mix(mix(before) * U64(0x9E3779B97F4A7C15) ^ word)


def _cell(h: np.ndarray) -> np.ndarray:
    return (h >> U64(40)).astype(np.int64) % CELLS


def _followers(values: np.ndarray, link: np.ndarray, n: int) -> list[np.ndarray]:
    """Of the first n words: the value of the next and of the one after it in
    the piece, else 0."""
    two = np.append(values[1:], 0) * np.append(link[:-1], False)
    three = np.append(two[1:], 0) * link
    return [two[:n].astype(values.dtype), three[:n].astype(values.dtype)]


def prefix_cells(docs: DataFrame) -> DataFrame:
    """(cell, n): suffixes by the cell of their first word and, behind CELLS, of
    their first two."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(2 * CELLS, np.int64)
        for block in _blocks(batches):
            of_lang = _name_hashes(block.names())
            for h, lang, link in block.parts():
                n = min(len(h), BLOCK_WORDS)
                first = _chained(of_lang[lang[:n]], h[:n])
                total[:CELLS] += np.bincount(_cell(first), minlength=CELLS)
                total[CELLS:] += np.bincount(_cell(_chained(first, _followers(h, link, n)[0])), minlength=CELLS)
        seen = np.flatnonzero(total)
        yield pa.record_batch({"cell": pa.array(seen.astype(np.int32)), "n": pa.array(total[seen])})

    return docs.mapInArrow(run, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n"))


class Groups:
    """Vertical partitioning: the group of every suffix.

    ``whole_from``: the shortest node of a group that no other group has."""

    def __init__(self, cells: np.ndarray, n: np.ndarray, budget: int):
        total = np.zeros(2 * CELLS, np.int64)
        total[cells] = n
        self.one, self.two, self.many = np.full(CELLS, -1), np.full(CELLS, -1), np.ones(CELLS, np.int64)
        self.starts = []
        at = 0
        for table, count in ((self.one, total[:CELLS]), (self.two, total[CELLS:])):
            self.starts.append(at)
            fit = count <= budget
            filled = np.cumsum(np.where(fit, count, 0))
            table[fit] = at + (filled[fit] // budget if fit.any() else 0)
            at = int(table.max()) + 1 if fit.any() else at
        self.starts.append(at)
        over = total[CELLS:] > budget
        self.many[over] = -(-total[CELLS:][over] // budget)
        self.third = at + np.cumsum(np.where(over, self.many, 0)) - self.many

    def of(self, h1: np.ndarray, h2: np.ndarray, h3: np.ndarray) -> np.ndarray:
        group = self.one[_cell(h1)]
        hot = np.flatnonzero(group < 0)
        cell = _cell(h2[hot])
        group[hot] = self.two[cell]
        hotter = group[hot] < 0
        hot, cell = hot[hotter], cell[hotter]
        group[hot] = self.third[cell] + (h3[hot] >> U64(33)).astype(np.int64) % self.many[cell]
        return group

    def whole_from(self, group: int) -> int:
        return 1 if group < self.starts[1] else 2 if group < self.starts[2] else 3


def _small(values: np.ndarray) -> bytes:
    """Whole numbers in two or four bytes, byte by byte, as compression needs it;
    the first byte says which."""
    wide = len(values) > 0 and int(values.max()) >= 1 << 16
    data = values.astype("<u4" if wide else "<u2")
    return bytes([4 if wide else 2]) + data.view(np.uint8).reshape(-1, data.itemsize).T.tobytes()


def _large(data: bytes) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8, offset=1).reshape(data[0], -1).T
    return np.ascontiguousarray(planes).view("<u4" if data[0] == 4 else "<u2").ravel().astype(np.int64)


_DEALT = "part long, langs array<string>, lang binary, sizes binary, words binary, first binary, second binary, third binary, n binary"


def deal(docs: DataFrame, groups: Groups) -> DataFrame:
    """A row per block and group: its suffixes, sorted, as numbers of the row's own words."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches):
            names = block.names()
            of_lang = _name_hashes(names)
            for h, lang, link in block.parts():
                yield from _dealt(block, names, of_lang, groups, h, lang, link)

    return docs.mapInArrow(run, _DEALT)


def _dealt(block, names, of_lang, groups, h, lang, link) -> Iterator[pa.RecordBatch]:
    n = min(len(h), BLOCK_WORDS)
    # words of different languages are different; a suffix has one language
    keyed, at, word = np.unique(_chained(of_lang[lang], h), return_index=True, return_inverse=True)
    plain, word_lang = h[at], lang[at]
    word = word.astype(np.int64) + 1
    bits = U64(int(len(keyed)).bit_length())
    two, three = _followers(word, link, n)
    packed, count = np.unique((word[:n].astype(U64) << bits | two.astype(U64)) << bits | three.astype(U64), return_counts=True)
    low = (U64(1) << bits) - U64(1)
    first, second, third = (packed >> bits >> bits), (packed >> bits & low), (packed & low)
    known = np.concatenate([np.zeros(1, U64), plain])
    h1 = keyed[first.astype(np.int64) - 1]
    h2 = _chained(h1, known[second.astype(np.int64)])
    part = groups.of(h1, h2, _chained(h2, known[third.astype(np.int64)]))
    by = np.argsort(part, kind="stable")
    here, starts = np.unique(part[by], return_index=True)
    for group, rows in zip(here.tolist(), np.split(by, starts[1:]), strict=True):
        numbers = np.stack([first[rows], second[rows], third[rows]]).astype(np.int64)
        used, local = np.unique(np.concatenate([[0], numbers.ravel()]), return_inverse=True)
        local = local[1:].reshape(numbers.shape)
        strings = [block.strings[k] for k in plain[used[1:] - 1].tolist()]
        yield pa.record_batch(
            {
                "part": pa.array([group], pa.int64()),
                "langs": pa.array([names], pa.list_(pa.string())),
                "lang": [_small(word_lang[used[1:] - 1])],
                "sizes": [_small(np.fromiter(map(len, strings), np.int64, len(strings)))],
                "words": [b"".join(strings)],
                "first": [_small(np.diff(local[0], prepend=0))],
                "second": [_small(local[1])],
                "third": [_small(local[2])],
                "n": [_small(count[rows])],
            }
        )


_NODES = "lang string, words int, a string, b string, c string, n long"


def subtree(groups: Groups, min_count: int):
    """The function that builds a group's subtree and gives its nodes."""

    def run(table: pa.Table) -> pa.Table:
        langs: dict[str, int] = {}
        texts, of, suffixes, count, shift = [], [], [], [], 0
        for i in range(table.num_rows):
            row = {c: table.column(c)[i].as_py() for c in table.column_names}
            sizes = _large(row["sizes"])
            ends = np.concatenate([[0], np.cumsum(sizes)])
            texts.append(pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(ends), pa.py_buffer(row["words"])]))
            names = np.array([langs.setdefault(name, len(langs)) for name in row["langs"]])
            of.append(names[_large(row["lang"])])
            s = np.stack([np.cumsum(_large(row["first"])), _large(row["second"]), _large(row["third"])])
            suffixes.append(np.where(s > 0, s + shift, 0))
            count.append(_large(row["n"]))
            shift += len(sizes)
        text = pa.chunked_array(texts).combine_chunks().dictionary_encode()
        code = text.indices.to_numpy().astype(np.int64) * len(langs) + np.concatenate(of)
        word, number = np.unique(code, return_inverse=True)
        number = np.concatenate([[0], number + 1])  # 0: the piece has ended
        s = number[np.concatenate(suffixes, 1)]
        n = np.concatenate(count)
        # ranks of the paths of one, two and three words; a path's rank orders like the path
        size = len(word) + 1
        pairs, two = np.unique(s[0] * size + s[1], return_inverse=True)
        leaves, three = np.unique(two * size + s[2], return_inverse=True)
        total = np.bincount(three, n, len(leaves)).astype(np.int64)  # leaf totals
        levels = {3: (leaves // size, leaves % size, total)}
        levels[2] = (pairs // size, pairs % size, np.add.reduceat(total, _first(levels[3][0])))
        levels[1] = (None, np.unique(s[0]), np.add.reduceat(levels[2][2], _first(levels[2][0])))
        spoken = pa.array(list(langs), pa.string())
        strings = text.dictionary.cast(pa.string())
        whole_from = groups.whole_from(int(table.column("part")[0].as_py()))
        out = []
        lang_total = np.bincount(word[levels[1][1] - 1] % len(langs), levels[1][2], len(langs)).astype(np.int64)
        out.append(_nodes(spoken, None, 0, [], lang_total))
        for depth, (parent, last, n) in levels.items():
            taken = (last > 0) & ((n >= min_count) | (depth < whole_from))
            path = [last[taken]]
            if depth == 2:
                path = [parent[taken], *path]
            elif depth == 3:
                above = pairs[parent[taken]]
                path = [above // size, above % size, *path]
            spelled = [strings.take(pa.array(word[p - 1] // len(langs))) for p in path]
            out.append(_nodes(spoken.take(pa.array(word[path[0] - 1] % len(langs))), spelled, depth, path, n[taken]))
        return pa.concat_tables(out)

    return run


def _first(parent: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.diff(parent, prepend=-1))


def _nodes(lang, spelled, depth, path, n) -> pa.Table:
    none = pa.nulls(len(lang), pa.string())
    a, b, c = [*(spelled or []), none, none, none][:3]
    return pa.table({"lang": lang, "words": pa.array(np.full(len(lang), depth, np.int32)), "a": a, "b": b, "c": c, "n": n})


def frequent_phrases(docs: DataFrame, text: str = "text", lang: str = "lang", min_count: int = MIN_COUNT) -> DataFrame:
    """(lang, words, a, b, c, n): every phrase of one to DEPTH words with its
    count, if it is ``min_count`` or more; and a row of no words with the
    language's number of words."""
    taken = docs.select(
        docs[text].cast("string").alias("text"), F.coalesce(docs[lang].cast("string"), F.lit(UNKNOWN_LANGUAGE)).alias("lang")
    )
    cells = prefix_cells(taken).toArrow()  # 2 * CELLS rows at most
    groups = Groups(cells.column("cell").to_numpy(), cells.column("n").to_numpy(), GROUP_SUFFIXES)
    nodes = deal(taken, groups).groupBy("part").applyInArrow(subtree(groups, min_count), _NODES)
    whole = nodes.groupBy("lang", "words", "a", "b", "c").agg(F.sum("n").alias("n"))
    return whole.filter((F.col("n") >= min_count) | (F.col("words") == 0))


def _exact(name: str) -> Column:
    return F.col(name).cast("decimal(15,0)")


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", top: int = TOP) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's first phrases."""
    nodes = cut_lineage(frequent_phrases(docs, text, lang))
    counts = nodes.filter("words between 1 and 2").select(
        F.col("lang").alias("of"), F.concat_ws(" ", "a", "b").alias("part"), F.col("n").alias("count")
    )
    found = nodes.filter("words >= 2").select(
        "lang", "words", F.concat_ws(" ", "a", "b", "c").alias("phrase"), "a", "b", "c", F.col("n").alias("f")
    )
    after = [F.struct(F.lit(1).alias("k"), F.col("a").alias("left"), F.concat_ws(" ", "b", "c").alias("right"))]
    after.append(F.struct(F.lit(2).alias("k"), F.concat_ws(" ", "a", "b").alias("left"), F.col("c").alias("right")))
    cuts = found.withColumn("cut", F.explode(F.when(F.col("words") == 3, F.array(*after)).otherwise(F.array(after[0]))))
    cuts = cuts.select("lang", "phrase", "words", F.col("f").alias("a"), "cut.*")
    for side, name in (("left", "l"), ("right", "r")):
        part = counts.select("of", "part", F.col("count").alias(name))
        cuts = cuts.join(part, (F.col("lang") == F.col("of")) & (F.col(side) == F.col("part"))).drop("of", "part")
    times = F.lit(SCORE).cast("decimal(7,0)") * _exact("a") * _exact("a")
    cuts = cuts.withColumn("times", times).withColumn("by", _exact("l") * _exact("r")).withColumn("score", F.expr("times div by"))
    lowest = F.min(F.struct("score", "k", "l", "r")).alias("m")
    scored = cuts.groupBy("lang", "phrase", "words", "a").agg(lowest).select("lang", "phrase", "words", "a", "m.l", "m.r", "m.score")
    inside = F.explode(F.array(F.concat_ws(" ", "a", "b"), F.concat_ws(" ", "b", "c"))).alias("phrase")
    longer = found.filter("words = 3").select("lang", inside, "f").groupBy("lang", "phrase").agg(F.max("f").alias("longest"))
    left = scored.join(longer, ["lang", "phrase"], "left").filter(
        F.coalesce(100 * F.col("longest") < ABSORB_PERCENT * F.col("a"), F.lit(True))
    )
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    first = left.withColumn("rank", F.row_number().over(order).cast("long")).filter(F.col("rank") <= top)
    words = nodes.filter("words = 0").select("lang", "n")
    return first.join(words, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(read(spark, sf_dir, "documents"))


_UPPER, _SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

ORACLE_SQL = rf"""
WITH pieces AS (
    SELECT lang, row_number() OVER () AS piece, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM (
        SELECT coalesce(lang, 'und') AS lang,
            unnest(regexp_split_to_array(translate(coalesce(text, ''), '{_UPPER}', '{_SMALL}'), '[.,;:!?\x0A-\x0D]')) AS piece
        FROM documents)
),
grams AS (
    SELECT lang, unnest([w || '', w || coalesce(' ' || x, ''), w || ' ' || x || coalesce(' ' || y, '')]) AS phrase,
        unnest([1, CASE WHEN x IS NULL THEN 0 ELSE 2 END, CASE WHEN y IS NULL THEN 0 ELSE 3 END]) AS words,
        w AS a, x AS b, y AS c
    FROM (SELECT lang, w, lead(w) OVER p AS x, lead(w, 2) OVER p AS y
        FROM (SELECT lang, piece, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM pieces)
        WINDOW p AS (PARTITION BY piece ORDER BY i))
),
f AS MATERIALIZED (
    SELECT lang, phrase, lang || chr(9) || phrase AS key, words, min(a) AS a, min(b) AS b, min(c) AS c, count(*) AS n
    FROM grams WHERE words > 0 GROUP BY lang, phrase, words
),
cuts AS (
    SELECT lang, phrase, words, n, 1 AS k, lang || chr(9) || a AS lft,
        lang || chr(9) || CASE WHEN words = 3 THEN b || ' ' || c ELSE b END AS rgt
    FROM f WHERE words >= 2 AND n >= 10
    UNION ALL SELECT lang, phrase, words, n, 2, lang || chr(9) || a || ' ' || b, lang || chr(9) || c
    FROM f WHERE words = 3 AND n >= 10
),
scored AS (
    SELECT c.lang, c.phrase, c.words, c.n AS a, l.n AS l, r.n AS r,
        (1000000::HUGEINT * c.n * c.n // (l.n::HUGEINT * r.n))::BIGINT AS score, k
    FROM cuts c JOIN f l ON l.key = c.lft JOIN f r ON r.key = c.rgt
),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
longer AS (
    SELECT lang, phrase, max(n) AS n FROM (
        SELECT lang, unnest([a || ' ' || b, b || ' ' || c]) AS phrase, n FROM f WHERE words = 3 AND n >= 10)
    GROUP BY lang, phrase
),
kept AS (
    SELECT s.* FROM lowest s LEFT JOIN longer g ON g.lang = s.lang AND g.phrase = s.phrase
    WHERE g.n IS NULL OR 100 * g.n < 50 * s.a
),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept
)
SELECT lang, rank, phrase, a, l, r, t.n, score
FROM ranked JOIN (SELECT lang, sum(n)::BIGINT AS n FROM f WHERE words = 1 GROUP BY lang) t USING (lang)
WHERE rank <= 2000
"""
