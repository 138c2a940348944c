"""SentencePiece encoding and decoding by a batched numpy Viterbi search.

The pieces of a model file are a unigram lattice: the best segmentation of a
text is the one whose pieces' scores add up highest.  Pieces have the word mark
only at their beginning (runs of it apart), so a text falls apart into words
that can be solved one by one, and each different word is solved once per task.

Words of equal length in bytes advance together: for every start and length,
the hashes of all their substrings probe the sorted hashes of the pieces, and
vectorised maxima keep the best score and the back pointers of every end.
Ties go to the earlier start (the longer last piece).  A character that is no
piece costs the worst score less ``UNKNOWN_PENALTY`` and becomes byte pieces
(or the unknown id, in a model without them).

Scores: a unigram model's own.  A BPE model has merge ranks for scores; a sum
of ranks means nothing, so its pieces get Zipf scores, ``-log(rank + 2)`` less
the log of the normaliser.  The ids then are those of the library's unigram
encoder over these pieces and scores (which the tests compare), not those of
its merge procedure.

Text handling follows the model file: a word mark in front (dummy prefix),
spaces as word marks, identity normalisation, white space kept.  Decoding
undoes it; a word mark character in the text itself comes back as a space, and
all else comes back exactly.

Defined results: a null text has null ids, an empty one none; a text of any
length is encoded whole; repeated rows are encoded alike; an empty table gives
an empty result; kept columns pass through whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from equiscope.llm.rows import map_texts, read, row_struct
from equiscope.llm.text import U64, inverse_powers, mix, powers, spans_hash, worker_cache

MODEL = "piece_bpe_32k.model"
MARK = "▁"
UNKNOWN_PENALTY = 10.0
#: Different words kept per task; when there are more, the store starts anew.
STORED_WORDS = 300_000
#: Words of one length that advance together.
GROUP_ROWS = 20_000
_BASE = 0x9E3779B97F4A7C15 | 1
_TABLE = mix(np.arange(256, dtype=U64) + U64(4242))


class Pieces:
    """The pieces of a model file as sorted hash arrays."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        size = sp.get_piece_size()
        special = [sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) or sp.is_byte(i) for i in range(size)]
        normal = [i for i in range(size) if not special[i]]
        texts = [sp.id_to_piece(i).replace(MARK, " ").encode() for i in normal]
        own = np.array([sp.get_score(i) for i in normal], np.float32)
        self.zipf = bool(len(own)) and bool(np.all(own == np.round(own)))
        if self.zipf:  # merge ranks
            weight = 1.0 / (np.arange(len(own)) + 2.0)
            rank = np.argsort(np.argsort(-own, kind="stable"), kind="stable")
            own = np.log(weight / weight.sum())[rank].astype(np.float32)
        self.ids = dict(zip(normal, own.tolist(), strict=True))
        hashes = np.array([piece_hash(t) for t in texts], U64)
        by = np.argsort(hashes)
        self.keys, self.id_of, self.score_of = hashes[by], np.array(normal, np.int32)[by], own[by]
        self.longest = max(map(len, texts), default=1)
        starts = {t[:k] for t in texts for k in range(1, len(t) + 1)}
        self.starts = np.sort(np.array([piece_hash(t) for t in starts], U64))
        self.unknown_score = np.float32(own.min() - UNKNOWN_PENALTY) if len(own) else np.float32(-UNKNOWN_PENALTY)
        self.byte_ids = np.full(256, sp.unk_id(), np.int32)
        self.has_bytes = any(sp.is_byte(i) for i in range(size))
        # decoding: bytes of every id
        raw = [b""] * size
        for i, t in zip(normal, texts, strict=True):
            raw[i] = t
        for i in range(size):
            if sp.is_byte(i):
                value = int(sp.id_to_piece(i)[1:-1], 16)
                self.byte_ids[value] = i
                raw[i] = bytes([value])
            elif sp.is_unknown(i):
                raw[i] = " ⁇ ".encode()
        self.pool = np.frombuffer(b"".join(raw), np.uint8)
        self.ends = np.cumsum([len(r) for r in raw])
        self.begins = self.ends - np.array([len(r) for r in raw])

    @classmethod
    def get(cls, path: str) -> Pieces:
        cache = worker_cache()
        if path not in cache:
            cache[path] = cls(path)
        return cache[path]

    def decode(self, flat: np.ndarray, bounds: np.ndarray) -> list[bytes]:
        """Texts of several id sequences."""
        n = (self.ends - self.begins)[flat]
        done = np.concatenate([[0], np.cumsum(n)])
        out = self.pool[np.repeat(self.begins[flat] - done[:-1], n) + np.arange(done[-1])].tobytes()
        at = done[bounds].tolist()
        return [out[a + 1 : b] if out[a : a + 1] == b" " else out[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]


def piece_hash(piece: bytes) -> int:
    """Hash of a byte string, as the search computes it for substrings."""
    raw = np.frombuffer(piece, np.uint8)
    return int(mix(np.array([(_TABLE[raw] * powers(_BASE, len(raw))).sum(dtype=U64)], U64))[0])


def _probe(sorted_keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.minimum(np.searchsorted(sorted_keys, wanted), len(sorted_keys) - 1)
    return at, sorted_keys[at] == wanted


def viterbi(words: np.ndarray, p: Pieces) -> tuple[np.ndarray, np.ndarray]:
    """Ids of a (words, length) byte matrix: flat ids and ids per word."""
    n, length = words.shape
    sums = np.zeros((n, length + 1), U64)
    np.cumsum(_TABLE[words] * powers(_BASE, length), axis=1, out=sums[:, 1:])
    undo = inverse_powers(_BASE, np.arange(length), length)
    best = np.full((n, length + 1), -np.inf, np.float32)
    best[:, 0] = 0
    back_id = np.full((n, length + 1), -1, np.int32)
    back_at = np.tile(np.arange(-1, length, dtype=np.int32), (n, 1))
    size = np.where(words < 0x80, 1, np.where(words < 0xE0, 2, np.where(words < 0xF0, 3, 4))).astype(np.int32)
    for s in range(length):
        rows = np.flatnonzero(best[:, s] > -np.inf)  # places that pieces can begin at
        char = np.minimum(size[rows, s], length - s)
        single = np.zeros(len(rows), bool)
        live = np.arange(len(rows))
        for k in range(1, min(p.longest, length - s) + 1):
            wanted = mix((sums[rows[live], s + k] - sums[rows[live], s]) * undo[s])
            _, starts = _probe(p.starts, wanted)
            live, wanted = live[starts], wanted[starts]
            if not len(live):
                break
            at, found = _probe(p.keys, wanted)
            hit = live[found]
            single[hit[char[hit] == k]] = True
            _offer(best, back_id, back_at, rows[hit], s, s + k, p.score_of[at[found]], p.id_of[at[found]])
        lost = np.flatnonzero(~single)
        for k in np.unique(char[lost]):
            at = rows[lost[char[lost] == k]]
            end = s + int(k)
            taken = _offer(best, back_id, back_at, at, s, end, p.unknown_score, -1)
            if p.has_bytes:
                back_at[taken, end] = end - 1
    ids, owners = [], []
    at = np.full(n, length)
    rows = np.flatnonzero(at > 0)
    while len(rows):  # all words step back together
        end = at[rows]
        found = back_id[rows, end]
        ids.append(np.where(found >= 0, found, p.byte_ids[words[rows, end - 1]]))
        owners.append(rows)
        at[rows] = back_at[rows, end]
        rows = rows[at[rows] > 0]
    owner = np.concatenate(owners)[::-1] if owners else np.empty(0, np.int64)
    flat = np.concatenate(ids)[::-1] if ids else np.empty(0, np.int32)
    by = np.argsort(owner, kind="stable")
    return flat[by], np.bincount(owner, minlength=n)


def _offer(best, back_id, back_at, rows, start: int, end: int, score, piece) -> np.ndarray:
    """Take the new way to ``end`` where it is better; returns those rows."""
    offered = best[rows, start] + score
    better = offered > best[rows, end]
    rows = rows[better]
    best[rows, end] = offered[better]
    back_id[rows, end] = piece[better] if isinstance(piece, np.ndarray) else piece
    back_at[rows, end] = start
    return rows


class Encoder:
    """Encodes chunks of texts; solved words are kept between chunks."""

    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        self._forget()

    def _forget(self):
        self.keys, self.first, self.count = np.empty(0, U64), np.empty(0, np.int64), np.empty(0, np.int64)
        self.pool = np.empty(0, np.int32)

    def __call__(self, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids, and the bounds of every text in them."""
        mark = MARK.encode()
        buf = np.frombuffer(b"".join([b" " + t.replace(mark, b" ") if t else b"" for t in texts]) + b" ", np.uint8)
        sizes = np.array([len(t.replace(mark, b" ")) + 1 if t else 0 for t in texts])
        text_at = np.concatenate([[0], np.cumsum(sizes)])
        opens = (buf[:-1] == 32) & np.concatenate([[True], buf[:-2] != 32])
        opens[text_at[:-1][sizes > 0]] = True
        lo = np.flatnonzero(opens)
        hi = np.append(lo[1:], len(buf) - 1)[: len(lo)]
        keys = spans_hash(_TABLE[buf], lo, hi)
        different, first, which = np.unique(keys, return_index=True, return_inverse=True)
        self._learn(buf, lo[first], hi[first], different)
        at = np.searchsorted(self.keys, different)[which]
        n = self.count[at]
        done = np.concatenate([[0], np.cumsum(n)])
        flat = self.pool[np.repeat(self.first[at] - done[:-1], n) + np.arange(done[-1])]
        return flat, done[np.searchsorted(lo, text_at)]

    def _learn(self, buf, lo, hi, keys):
        if len(self.keys) + len(keys) > STORED_WORDS:
            self._forget()
        new = np.flatnonzero(~_probe(self.keys, keys)[1]) if len(self.keys) else np.arange(len(keys))
        sizes = (hi - lo)[new]
        by = new[np.argsort(sizes, kind="stable")]
        sizes = (hi - lo)[by]
        cuts = np.flatnonzero(np.diff(sizes)) + 1
        firsts, counts, base = [], [], len(self.pool)
        pools, order = [self.pool], []
        for group in np.split(by, cuts) if len(by) else []:
            length = int(hi[group[0]] - lo[group[0]])
            step = max(1, GROUP_ROWS * 16 // max(length, 16))
            for a in range(0, len(group), step):
                rows = group[a : a + step]
                ids, n = viterbi(buf[lo[rows][:, None] + np.arange(length)], self.pieces)
                pools.append(ids)
                firsts.append(base + np.cumsum(n) - n)
                counts.append(n)
                base += len(ids)
                order.append(rows)
        if order:
            all_keys = np.concatenate([self.keys, keys[np.concatenate(order)]])
            by = np.argsort(all_keys)
            self.keys = all_keys[by]
            self.first = np.concatenate([self.first, *firsts])[by]
            self.count = np.concatenate([self.count, *counts])[by]
            self.pool = np.concatenate(pools)


def encode(docs: DataFrame, text: str = "text", model: str | None = None, keep: list[str] | None = None,
           decoded: bool = False) -> DataFrame:
    """(row, ids array<int>[, decoded string]); ``model`` is the path of a
    model file.  ``decoded`` adds the text that the ids decode to, in the same
    pass (a second Python stage in the task would need workers of its own)."""

    def start():
        pieces = Pieces.get(model or _default())
        encoder = Encoder(pieces)

        def run(texts):
            flat, bounds = encoder(texts)
            null = [t is None for t in texts]
            found = {"ids": pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(flat), mask=pa.array(null))}
            if decoded:
                found["decoded"] = _texts(pieces.decode(flat, bounds), null)
            return found

        return run

    return map_texts(docs, start, "ids array<int>" + (", decoded string" if decoded else ""), text, keep)


def _texts(raw: list[bytes], null: list[bool]) -> pa.Array:
    return pa.array([None if skip else t.decode(errors="replace") for t, skip in zip(raw, null, strict=True)], pa.string())


def decode(encoded: DataFrame, ids: str = "ids", model: str | None = None) -> DataFrame:
    """``encoded`` (in a struct ``row``) with ``decoded``, the text of its ids;
    null ids give null."""
    taken = encoded.select(row_struct(encoded, encoded.columns), encoded[ids].alias("ids"))

    def run(batches):
        pieces = Pieces.get(model or _default())
        for batch in batches:
            lists = batch.column(1)
            bounds = np.concatenate([[0], np.cumsum(np.diff(lists.offsets.to_numpy()))])
            out = _texts(pieces.decode(lists.flatten().to_numpy(), bounds), lists.is_null().to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), out], names=["row", "decoded"])

    return taken.mapInArrow(run, f"row {taken.schema['row'].dataType.simpleString()}, decoded string")


def _default() -> str:
    import public_tokenizers

    return public_tokenizers.path(MODEL)


def op8_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document, and the digest of the text decoded from them."""
    coded = encode(read(spark, sf_dir, "documents"), keep=["doc_id"], decoded=True)
    n = F.when(F.col("ids").isNull(), 0).otherwise(F.size("ids")).cast("long")
    return coded.select("row.doc_id", n.alias("n_ids"), "ids", F.sha2("decoded", 256).alias("decoded_sha256"))
