import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2 as proto

from equiscope.llm import pieces
from equiscope.llm.pieces import Encoder, Pieces, decode, encode, viterbi

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def p():
    return Pieces.get(PATH)


@pytest.fixture(scope="module")
def library(p):
    """The library's unigram encoder over the same pieces and scores."""
    m = proto.ModelProto()
    with open(PATH, "rb") as f:
        m.ParseFromString(f.read())
    m.trainer_spec.model_type = 1
    for i, x in enumerate(m.pieces):
        if i in p.ids:
            x.score = p.ids[i]
    return sentencepiece.SentencePieceProcessor(model_proto=m.SerializeToString())


def run(p, texts):
    flat, bounds = Encoder(p)([None if t is None else t.encode() for t in texts])
    return [flat[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])], flat, bounds


ODD = ["", " ", "a  b", "  lead", "trail  ", "x 中文\n\tzz", "é", "🎉🎉 ok", "a\x00b", "▁x", "\n", "ﬀ ǆ", "Ж" * 30, "word " * 40]


def test_ids_equal_the_library(p, library, spark, sf):
    r = random.Random(3)
    made = ["".join(r.choices("ab é\n中 the.in🎉", k=r.randrange(1, 40))) for _ in range(300)]
    lines = [x for d in spark.read.parquet(f"{sf}/documents.parquet").limit(12).collect() for x in d.text.split("\n") if x]
    for texts in (ODD, made, lines):
        got, _, _ = run(p, texts)
        for t, ids in zip(texts, got):
            theirs = library.encode(t)
            if ids != theirs:  # segmentations of one score: rounding over the whole text picks the library's
                total = [sum(p.ids.get(i, 0.0) for i in x) for x in (ids, theirs)]
                assert len(ids) == len(theirs) and total[0] == pytest.approx(total[1], rel=1e-6), t


def test_best_score_by_brute_force(p):
    """All segmentations of short words."""
    sp = sentencepiece.SentencePieceProcessor(model_file=PATH)
    piece = {sp.id_to_piece(i).replace("▁", " "): (i, s) for i, s in p.ids.items()}

    def best(t):
        if not t:
            return 0.0
        ways = [piece[t[:k]][1] + best(t[k:]) for k in range(1, len(t) + 1) if t[:k] in piece]
        if t[0] not in piece:
            ways.append(float(p.unknown_score) + best(t[1:]))
        return max(ways)

    for w in (" the", " ing", "abcabc", " zxqw", " straße"):
        ids, n = viterbi(np.frombuffer(w.encode(), np.uint8)[None, :], p)
        assert n.tolist() == [len(ids)]
        assert sum(p.ids[i] for i in ids.tolist()) == pytest.approx(best(w), rel=1e-5)


def test_store_can_be_forgotten(p, monkeypatch):
    texts = [f"word{i} and word{i + 1}" for i in range(200)]
    expected, _, _ = run(p, texts)
    monkeypatch.setattr(pieces, "STORED_WORDS", 10)
    e = Encoder(p)
    got = []
    for t in texts:
        flat, bounds = e([t.encode()])
        got.append(flat.tolist())
    assert got == expected


def test_round_trip_over_a_table(spark, docs_of, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = decode(encode(docs, keep=["doc_id", "text"]).select("row.*", "ids"))
    assert out.filter(~F.col("decoded").eqNullSafe(F.replace("row.text", F.lit("▁"), F.lit(" ")))).count() == 0
    rows = [(i, t) for i, t in enumerate(ODD)] + [(50, None), (None, "x"), (50, None)]
    odd = docs_of(rows).withColumns({"row": F.lit(1), "ids": F.lit("x"), "decoded": F.lit(2)})
    got = encode(odd).collect()
    assert len(got) == len(rows) and all((r.ids is None) == (r.row.text is None) for r in got)
    back = decode(encode(odd).select("row.text", "ids")).collect()
    assert all(r.decoded == (None if r.row.text is None else r.row.text.replace("▁", " ")) for r in back)
    both = encode(odd, decoded=True).collect()
    assert sorted(str(r.decoded) for r in both) == sorted(str(r.decoded) for r in back)
    assert encode(docs_of([])).count() == 0
