import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from equiscope.llm import ngram, quality, wordgrams
from equiscope.llm.quality import base_counts, keep_good, op3_quality, quality_report

SPACES = r"[\x20\x09-\x0d]+"


def brute_counts(text):
    text = text or ""
    words = [w for w in re.split(SPACES, text) if w]
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0d]", line):
            dup += line in seen
            seen.add(line)
    at = defaultdict(list)
    for i in range(len(words) - 4):
        at[tuple(words[i : i + 5])].append(i)
    covered = {j for v in at.values() if len(v) > 1 for i in v for j in range(i, i + 5)}
    symbols = sum(c in "#*$%&|<>" for c in text)
    return [len(words), sum(map(len, words)), symbols, dup, len(covered)]


TEXTS = [
    None, "", " \n \n", "one", "a b c d e a b c d e", "x x x x x x x", "l1\nl1\nl1 \n\nl1", "é#ß $%\n\té#ß $%", "r\r\nr\r\nr",
    "中文 字 🎉", "a\x00b\x1cc", "w " * 3000, "\n".join(["same line here"] * 50), "<a>|&b*", "\x0b\x0ca\x0b",
]


def check_counts(texts):
    got = base_counts([None if t is None else t.encode() for t in texts])
    assert np.stack([got[c] for c in quality.COUNTS], 1).tolist() == [brute_counts(t) for t in texts]


def test_counts_of_odd_texts():
    check_counts(TEXTS)
    for t in TEXTS:
        check_counts([t])


def test_counts_of_random_texts():
    r = random.Random(4)
    check_counts(["".join(r.choices(["a", "b", " ", "\n", "é", "#", "  ", "ab"], k=r.randrange(60))) for _ in range(300)])


class Plain:
    """Modified Kneser-Ney, interpolated, from dictionaries."""

    def __init__(self, texts):
        classes = ngram.CLASSES.tolist()
        self.s = ngram.SYMBOLS
        levels = {4: Counter()}
        for t in texts:
            x = [classes[10]] * 3 + [classes[b] for b in (t or "").encode()]
            for i in range(3, len(x)):
                levels[4][tuple(x[i - 3 : i + 1])] += 1
        for k in (3, 2, 1):
            levels[k] = Counter(g[1:] for g in levels[k + 1])
        self.levels, self.d = levels, {}
        for k, c in levels.items():
            n = Counter(min(v, 5) for v in c.values())
            d = [0, 0.5, 1.0, 1.5]
            if n[1] and n[2]:
                y = n[1] / (n[1] + 2 * n[2])
                for j in (1, 2, 3):
                    if n[j] and n[j + 1]:
                        d[j] = min(max(j - (j + 1) * y * n[j + 1] / n[j], 0.05), j - 0.05)
            self.d[k] = d
        self.totals = {k: defaultdict(list) for k in levels}
        for k, c in levels.items():
            for g, v in c.items():
                self.totals[k][g[:-1]].append(v)

    def p(self, g):
        k = len(g)
        if k == 0:
            return 1 / self.s
        below = self.p(g[1:]) if k > 1 else 1 / self.s
        counts = self.totals[k].get(g[:-1])
        if not counts:
            return below
        d = self.d[k]
        c = self.levels[k][g]
        return (c - d[min(c, 3)] + sum(d[min(v, 3)] for v in counts) * below) / sum(counts)

    def log_ppl(self, text):
        classes = ngram.CLASSES.tolist()
        x = [classes[10]] * 3 + [classes[b] for b in text.encode()]
        return -sum(math.log(self.p(tuple(x[i - 3 : i + 1]))) for i in range(3, len(x))) / max(len(x) - 3, 1)


def test_model_against_plain_version(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(40)
    texts = [r.text for r in docs.select("text").collect()]
    model, plain = ngram.fit(docs), Plain(texts)
    score = ngram.Scorer(model)
    for batch in (texts[:8], ["zzz qqq #!# never seen Ж", "", "a"]):
        got = score([t.encode() for t in batch])
        assert got == pytest.approx([plain.log_ppl(t) for t in batch], rel=1e-5)


def test_probabilities_add_up(spark, sf):
    model = ngram.fit(spark.read.parquet(f"{sf}/documents.parquet"))
    for context in (0, 1234, 28 * 1600 + 5 * 40 + 7):
        p = np.exp(model.log_p(context * ngram.SYMBOLS + np.arange(ngram.SYMBOLS)))
        assert p.sum() == pytest.approx(1.0)


def test_counts_do_not_depend_on_partitions(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("text")
    one = {tuple(r) for r in ngram.count_grams(docs.coalesce(1)).collect()}
    assert one == {tuple(r) for r in ngram.count_grams(docs.repartition(7)).collect()}


def test_verdicts(spark, sf):
    rows = {r.doc_id: r for r in op3_quality(spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    for d in docs:
        r, base = rows[d.doc_id], brute_counts(d.text)
        assert [r[c] for c in quality.COUNTS] == base
        assert r.base_failed == (base[0] < 10 or 100 * base[4] > 20 * base[0])
        assert not (r.kept and r.base_failed)


def test_bands_reject_junk_and_keep_clean(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").groupBy("doc_id").agg(F.min("quality").alias("q"))
    got = quality_report(docs).filter("not base_failed").join(labels, "doc_id").groupBy("q").agg(F.avg(F.col("kept").cast("int")))
    share = {r[0]: r[1] for r in got.collect()}
    assert share[1] > 0.98 and share[0] < 0.6


def test_odd_rows_and_columns(spark, docs_of):
    rows = [(i, t, lang) for i, (t, lang) in enumerate(zip(TEXTS, ["en", None, "", "xx", "En", "klingon", "de"] * 3))]
    rows += [(None, "a b c d e f g h i j k l", "en"), (1, None, "en")]
    out = quality_report(docs_of(rows)).collect()
    assert len(out) == len(rows) and all(isinstance(r.kept, bool) for r in out)
    assert quality_report(docs_of([])).count() == 0
    clashing = docs_of(rows).withColumns({"row": F.lit(1), "kept": F.lit("x"), "n_words": F.lit(2), "language": F.lit(3)})
    good = keep_good(clashing)
    assert good.columns == clashing.columns and good.collect() is not None


def plain_word_log_p(model, texts):
    """The word model from dictionaries; a text's own counts and its copies' are held out."""
    def grams(text):
        words, sums = [], {}
        for m in re.finditer(r"[^\x20\x09-\x0d]+", text):
            words.append((m.group(), m.start()))
        per_byte = ngram.Scorer(model).per_byte([text.encode()])[0].astype(float)
        upto = [len(text[:at].encode()) for _, at in words] + [len(text.encode())]
        upto[0] = 0
        for i, (word, _) in enumerate(words):
            sums.setdefault((words[i - 1][0] if i else None, word), []).append(per_byte[upto[i] : upto[i + 1]].sum())
        return sums

    held = [grams(t) for t in texts]
    pairs, contexts = Counter(), Counter()
    for g in held:
        for (v, w), s in g.items():
            pairs[v, w] += len(s)
            contexts[v] += len(s)
    out = {}
    for text, g in zip(texts, held):
        copies, own = texts.count(text), Counter()
        for (v, _), s in g.items():
            own[v] += len(s)
        out[text] = sum(
            len(s) * math.log((pairs[v, w] - copies * len(s) + wordgrams.MU * math.exp(sum(s) / len(s)))
                            / (contexts[v] - copies * own[v] + wordgrams.MU))
            for (v, w), s in g.items()
        )
    return out


def test_word_model_against_plain_version(spark, docs_of, monkeypatch):
    r = random.Random(3)
    texts = [" ".join(r.choices(["the", "cat", "Ж中", "sat", "on", "MAT", "mat", "  x\n"], k=r.randrange(1, 25))) for _ in range(40)]
    docs = docs_of([(i, t) for i, t in enumerate([*texts, *texts[:5], None, "", " \n"])])
    model = ngram.fit(docs)
    expected = plain_word_log_p(model, [*texts, *texts[:5]])
    for size, block in ((1 << 20, 1 << 20), (50, 1 << 20), (1 << 20, 60), (50, 60)):  # the numbers of ranges and blocks do not matter
        monkeypatch.setattr(wordgrams, "RANGE_BYTES", size)
        monkeypatch.setattr(wordgrams, "BLOCK_BYTES", block)
        keyed = docs.select("text", wordgrams.text_key(F.col("text"))).distinct()
        got = {x.text: x.log_p / wordgrams.UNIT for x in keyed.join(wordgrams.log_p(docs, model), wordgrams.KEY).collect()}
        assert got == pytest.approx(expected, rel=1e-3)


def test_shuffled_words_are_told_from_text(spark, docs_of):
    """Same letters, same words, other order; in scripts whose bytes the spelling model folds."""
    r = random.Random(9)
    vocabulary = ["".join(r.choices("абвгдежзиклмнопрст", k=6)) for _ in range(400)]
    after = {w: r.sample(vocabulary, 3) for w in vocabulary}
    texts = []
    for _ in range(300):
        words = [r.choice(vocabulary)]
        while len(words) < 120:
            words.append(r.choice(after[words[-1]]))
        texts.append(words)
    rows = [(i, " ".join(w), "ru") for i, w in enumerate(texts)]
    rows += [(1000 + i, " ".join(r.sample(w, len(w))), "ru") for i, w in enumerate(texts[:20])]
    kept = {x.doc_id for x in quality_report(docs_of(rows)).filter("kept").collect()}
    assert not any(i >= 1000 for i in kept) and len(kept) >= 294


def test_equal_texts_score_alike_wherever_they_stand(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(60)
    texts = [(r.text or "").encode() for r in docs.select("text").collect()]
    score = ngram.Scorer(ngram.fit(docs))
    alone = [score([t])[0] for t in texts]
    assert score(texts).tolist() == alone and score(texts[::-1]).tolist() == alone[::-1]


def test_copies_do_not_set_the_band(spark, docs_of):
    """Over half of the rows are copies or near copies of one text."""
    r = random.Random(12)
    vocabulary = ["".join(r.choices("abcdefghijklmnopqrstuvwxyz", k=r.randrange(2, 9))) for _ in range(300)]
    rare = ["".join(r.choices("0123456789&xyzQ", k=5)) for _ in range(300)]
    rows = [(i, " ".join(r.choice(rare if r.random() < i / 500 else vocabulary) for _ in range(400))) for i in range(200)]
    base = rows[100][1].split()

    def judged(rows):
        got = quality_report(docs_of(rows)).collect()
        return got[0].high - got[0].low, {x.doc_id for x in got if x.kept}

    width, alone = judged(rows)
    assert len(alone) > 190
    for near in (False, True):
        copies = []
        for i in range(300):
            words = list(base)
            if near:
                words[r.randrange(len(words))] = r.choice(vocabulary)
            copies.append((1000 + i, " ".join(words)))
        new_width, kept = judged(rows + copies)
        assert new_width > 0.6 * width and len(alone & kept) > 0.95 * len(alone)


def test_a_gram_of_every_text_has_an_entry_per_block(spark, docs_of, monkeypatch):
    """No unsplit hot gram: what meets in a range grows with the blocks, not with the texts."""
    docs = docs_of([(i, f"of the {i} of the {i % 7}") for i in range(500)] + [(1000 + i, "of the same") for i in range(400)])
    blocks = wordgrams._blocks(docs, "text", 4)
    rows = blocks.collect()
    assert sorted(r.copies for r in rows) == [1] * 500 + [400] and len({r[wordgrams.KEY] for r in rows}) == 501
    counted = wordgrams._counted(blocks, 3).collect()
    assert len(counted) <= 4 * 3 and len({(r.block, r.part) for r in counted}) == len(counted)
    entries = sum(len(wordgrams._read(r.outside)) for r in counted)
    assert entries < 4 * (2 * 500 + 40)  # 2-grams and contexts; an entry per text would be 900 * 5
    got = {r.log_p for r in wordgrams.log_p(docs, ngram.fit(docs)).collect()}
    assert all(p < 0 for p in got)


def test_written_numbers_come_back():
    r = np.random.default_rng(4)
    for top in (1, 255, 256, 1 << 39, 1 << 62):
        a = r.integers(0, top, 50).astype(np.uint64)
        assert wordgrams._read(wordgrams._write(a)).tolist() == a.tolist()
