"""Quality rules: simple counts and an n-gram perplexity band per language.

Base counts take words ``[^\\x20\\x09-\\x0D]+`` of the whole text.  A document
fails the base rules when it has fewer than 10 words, or when more than 20 %
of its words lie in 5-word windows found twice or more in the text.  The
others are judged by perplexity under two models that are counted over all documents:
per byte under the Kneser-Ney spelling model (:mod:`ngram`), per word under
the word model that grows with the corpus and holds the text itself out
(:mod:`wordgrams`).  A language's bands come from the quartiles of its own
documents' log perplexities, and documents outside them are rejected.  Near
copies vouch for each other's words, and deduplication is not this module's
task, so the word band has no lower limit.

Defined results: a null text is an empty one (no words: base fails).  A null
or malformed language code shares one band ("other").  Repeated rows are
judged one by one and alike.  An empty table gives an empty result.  Other
columns of the input pass through :func:`keep_good` untouched, whatever
their names.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from equiscope.llm import ngram, wordgrams
from equiscope.llm.rows import cut_lineage, map_texts, read
from equiscope.llm.text import U64, Texts, mix, per_text_sum, spans_hash

MIN_WORDS = 10
REPEAT_WINDOW = 5
REPEAT_PERCENT = 20
#: Band: quartiles of log perplexity, widened by so many quartile distances
#: (a distance counts as LEAST_SPREAD at least) and, as the mean over a short
#: text varies more, by SHORT_SLACK / sqrt(characters).
BAND_WIDTH = 2.0
LEAST_SPREAD = 0.025
SHORT_SLACK = 1.5
#: Word band: above the upper quartile by so many distances from the median to
#: it (at least LEAST_WORD_SPREAD) and by WORD_SLACK / sqrt(words).
WORD_WIDTH = 4.0
LEAST_WORD_SPREAD = 0.1
WORD_SLACK = 6.0
#: Log perplexities per byte and per word are counted in steps of these sizes.
STEP = 0.005
WORD_STEP = 0.02

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
SYMBOL_CHARS = b"#*$%&|<>"
_SYMBOL = np.isin(np.arange(256), list(SYMBOL_CHARS))


def base_counts(texts: list[bytes | None]) -> dict[str, np.ndarray]:
    """The five counts of every text, and its sketch: the least hash of its
    5-word windows, which copies share and near copies mostly share."""
    x = Texts(texts)
    text_bounds = np.append(x.text_starts, len(x.buf))
    in_word = np.zeros(len(x.buf) + 1, np.int8)
    in_word[x.starts] = 1
    in_word[x.ends] = -1
    in_word = np.cumsum(in_word[:-1], dtype=np.int8) > 0
    chars = in_word & ((x.buf & 0xC0) != 0x80)
    of = x.word_text

    breaks = np.flatnonzero(x.buf == 10)
    lines = np.searchsorted(breaks, x.starts) - 1  # of every word
    first = np.flatnonzero(np.diff(lines, prepend=-2))
    lines, line_text = lines[first], of[first]
    table = mix(np.arange(256, dtype=U64) + U64(977))
    line_keys = _within(spans_hash(table[x.buf], breaks[lines] + 1, breaks[lines + 1]), line_text)
    _, kept = np.unique(line_keys, return_index=True)
    dup_lines = np.bincount(line_text, minlength=x.n) - np.bincount(line_text[kept], minlength=x.n)

    at = x.windows(REPEAT_WINDOW)
    windows = x.window_hashes(x.word_hashes(), at, REPEAT_WINDOW)
    sketch = np.zeros(x.n, U64)
    if len(at):
        first = np.flatnonzero(np.diff(of[at], prepend=-1))
        sketch[of[at][first]] = np.minimum.reduceat(windows, first)
    keys = _within(windows, of[at])
    ordered = np.sort(keys)
    again = ordered[1:][ordered[1:] == ordered[:-1]]
    at = at[np.isin(keys, again)] if len(again) else at[:0]
    cover = np.zeros(len(x.starts) + REPEAT_WINDOW + 1, np.int64)
    np.add.at(cover, at, 1)
    np.add.at(cover, at + REPEAT_WINDOW, -1)
    repeated = (np.cumsum(cover)[: len(x.starts)] > 0).astype(np.int64)
    return {
        "n_words": x.counts.astype(np.int64),
        "word_chars": per_text_sum(chars.astype(np.int64), text_bounds),
        "n_symbols": per_text_sum(_SYMBOL[x.buf].astype(np.int64), text_bounds),
        "n_dup_lines": dup_lines.astype(np.int64),
        "n_repeat_words": per_text_sum(repeated, x.bounds),
        "sketch": sketch.view(np.int64),
    }


def _within(hashes: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Keys that are equal only within one text."""
    return mix(hashes ^ mix(text.astype(U64) + U64(1)))


def language(lang):
    """Key of the band: a two- or three-letter code, else ``other``; so there
    are at most 26**2 + 26**3 + 1 = 18,253 bands."""
    return F.when(lang.rlike("^[a-z]{2,3}$"), lang).otherwise(F.lit("other"))


def score(
    docs: DataFrame, model: ngram.KneserNey, log_p: DataFrame, text: str = "text", keep: list[str] | None = None
) -> DataFrame:
    """(row struct of the kept columns, the text's key, the counts,
    base_failed, log_ppl of the spelling per byte, word_ppl: log perplexity
    per word); ``log_p`` is that of :func:`wordgrams.log_p`."""

    def start():
        scorer = ngram.Scorer(model)

        def run(texts):
            found = base_counts(texts)
            words = found["n_words"]
            found["base_failed"] = (words < MIN_WORDS) | (100 * found["n_repeat_words"] > REPEAT_PERCENT * words)
            found["log_ppl"] = scorer(texts)
            return found

        return run

    fields = ", ".join(f"{c} long" for c in COUNTS)
    kept = docs.columns if keep is None else keep
    held = docs.select(
        F.struct(*[docs[f"`{c}`"] for c in kept]).alias("held"), wordgrams.text_key(docs[text]), docs[text].alias("text")
    )
    counted = map_texts(held, start, f"{fields}, sketch long, base_failed boolean, log_ppl double", "text", ["held", wordgrams.KEY])
    counted = counted.select("row.*", *COUNTS, "sketch", "base_failed", "log_ppl").withColumnRenamed("held", "row")
    per_word = -F.coalesce("log_p", F.lit(0)) / wordgrams.UNIT / F.greatest("n_words", F.lit(1))
    return counted.join(log_p, wordgrams.KEY, "left").withColumn("word_ppl", per_word).drop("log_p")


def bands(scored: DataFrame, lang: str = "lang") -> DataFrame:
    """(language, low, high, word_high) from the documents that pass the base
    rules.

    Texts of one sketch count once (copies, and most near copies), so that a
    large group of them does not set the band; the one with the least key
    stands for them.  Log perplexities are counted in steps,
    so the quartiles come from histograms: partial counts, one row per
    language, model and step."""
    distinct = scored.filter("not base_failed").groupBy(
        language(F.col("row").getField(lang)).alias("language"), "sketch"
    ).agg(F.min_by(F.struct("log_ppl", "word_ppl"), wordgrams.KEY).alias("one")).select("language", "one.*")
    values = [
        F.struct(F.lit(of).alias("of"), F.round(F.col(of) / size).cast("long").alias("step"))
        for of, size in (("log_ppl", STEP), ("word_ppl", WORD_STEP))
    ]
    steps = distinct.select("language", F.explode(F.array(*values)).alias("v")).groupBy("language", "v.of", "v.step").agg(
        F.count(F.lit(1)).alias("n")
    )
    w = Window.partitionBy("language", "of")
    upto = F.sum("n").over(w.orderBy("step"))
    marked = steps.select("language", "of", "step", upto.alias("upto"), F.sum("n").over(w).alias("all"))

    def quartile(of, size, i):
        reached = (F.col("of") == of) & (F.col("upto") >= F.col("all") * F.lit(i / 4))
        return F.min(F.when(reached, F.col("step") * F.lit(size))).alias(f"{of}_{i}")

    q = [quartile("log_ppl", STEP, i) for i in (1, 3)] + [quartile("word_ppl", WORD_STEP, i) for i in (2, 3)]
    spread = F.greatest(F.col("log_ppl_3") - F.col("log_ppl_1"), F.lit(LEAST_SPREAD))
    word_spread = F.greatest(F.col("word_ppl_3") - F.col("word_ppl_2"), F.lit(LEAST_WORD_SPREAD))
    return marked.groupBy("language").agg(*q).select(
        "language",
        (F.col("log_ppl_1") - BAND_WIDTH * spread).alias("low"),
        (F.col("log_ppl_3") + BAND_WIDTH * spread).alias("high"),
        (F.col("word_ppl_3") + WORD_WIDTH * word_spread).alias("word_high"),
    )


def judge(scored: DataFrame, limits: DataFrame, lang: str = "lang") -> DataFrame:
    """``scored`` with its band and ``kept``.  The bands are at most 18,253
    rows (see :func:`language`), hence the broadcast."""
    keyed = scored.withColumn("language", language(F.col("row").getField(lang)))
    slack = F.lit(SHORT_SLACK) / F.sqrt(F.greatest(F.col("word_chars") + F.col("n_words"), F.lit(1)))
    word_slack = F.lit(WORD_SLACK) / F.sqrt(F.greatest(F.col("n_words"), F.lit(1)))
    inside = F.col("log_ppl").between(F.col("low") - slack, F.col("high") + slack)
    inside = inside & (F.col("word_ppl") <= F.col("word_high") + word_slack)
    return keyed.join(F.broadcast(limits), "language", "left").withColumn(
        "kept", ~F.col("base_failed") & F.coalesce(inside, F.lit(False))
    )


def quality_report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """Counts, log perplexities, bands and verdict of every document."""
    model = ngram.fit(docs, text)
    scored = cut_lineage(score(docs, model, wordgrams.log_p(docs, model, text), text, [doc_id, lang]))
    return judge(scored, bands(scored, lang), lang).select(
        F.col("row").getField(doc_id).alias("doc_id"),
        *COUNTS, "base_failed", "kept", "log_ppl", "low", "high", "word_ppl", "word_high",
    )


def keep_good(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """The documents that pass, with all their columns."""
    model = ngram.fit(docs, text)
    log_p = cut_lineage(wordgrams.log_p(docs, model, text))
    limits = cut_lineage(bands(score(docs, model, log_p, text, [lang]), lang))
    return judge(score(docs, model, log_p, text), limits, lang).filter("kept").select("row.*")


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_report(read(spark, sf_dir, "documents")).drop("low", "high", "log_ppl", "word_ppl", "word_high")
