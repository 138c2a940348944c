"""Chat formatting with Spark expressions only.

A conversation's rows are collected as structs, sorted, and neighbouring turns
of one role are merged, by array functions over the places where a role
begins, into one turn of several segments.  The work is linear in the texts and
near to it (power 1.5, of small numbers) in the turns.  The template writes a mark before and after each merged turn and
one between its segments:

    system     <<SYS>> text <</SYS>>
    user       [INST] text [/INST]
    assistant  [ANS] text </s>
    any other  [ROLE]role[TEXT] text [/ROLE]

and ``<s>`` in front.  Between two segments of a merged turn stands [SYS+],
[INST+], [ANS+], or [ROLE+]role[TEXT].  A mark's inner spaces belong to it, so
texts keep their own white space.

Escaping.  Wherever a text (or role) spells a mark, with any number of
backslashes after its first character, one more backslash is put there; taking
one away undoes it.  A mark without a backslash is therefore always the
template's, and :func:`read_back` recovers every turn exactly.

The loss mask is a list of (start, length) in code points: each assistant text,
escaped as it stands in the output, without marks.

Order: by turn (nulls first), ties by role and text.  Defined results: a null
text is an empty one, a null role an empty role; repeated rows are turns of
their own; a null conversation id is a conversation; an empty table gives an
empty result.  One conversation is one output row, so it is gathered in one
task; that is the size of the row asked for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from equiscope.llm.rows import read

# The template's marks by role: before, between segments, after.
MARKS = {
    "system": ("<<SYS>> ", " [SYS+] ", " <</SYS>>"),
    "user": ("[INST] ", " [INST+] ", " [/INST]"),
    "assistant": ("[ANS] ", " [ANS+] ", " </s>"),
}
BEGIN, ROLE, ROLE_MORE, TEXT, ROLE_END = "<s>", "[ROLE]", " [ROLE+]", "[TEXT] ", " [/ROLE]"
#: A mark anywhere in a text, with the backslashes after its first character.
ESCAPED = r"([\[<])(\\*)(<?/?SYS>>|/?s>|(?:SYS\+|/?INST\+?|ANS\+?|/?ROLE\+?|TEXT)\])"
#: The template's own marks, with their spaces, in the output.
OWN = (
    r"<s>|<<SYS>> | \[SYS\+\] | <</SYS>>|\[INST\] | \[INST\+\] | \[/INST\]|\[ANS\] | \[ANS\+\] | </s>"
    r"|\[ROLE\]| \[ROLE\+\]|\[TEXT\] | \[/ROLE\]"
)


def escape(text: Column) -> Column:
    may = text.contains("[") | text.contains("<")  # spares most texts the pattern
    return F.when(may, F.regexp_replace(text, ESCAPED, r"$1$2\\$3")).otherwise(text)


def unescape(text: Column) -> Column:
    plain = F.regexp_replace(text, ESCAPED.replace(r"(\\*)", r"(\\*)\\"), r"$1$2$3")
    return F.when(text.contains("\\"), plain).otherwise(text)


def merged_turns(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
                 text: str = "text") -> DataFrame:
    """(conv_id, turns array<struct<role, texts>>): sorted, escaped, merged."""
    one = F.struct(
        F.col(turn).alias("turn"), F.coalesce(role, F.lit("")).alias("role"), F.coalesce(text, F.lit("")).alias("text")
    )
    rows = conversations.groupBy(F.col(conv_id).alias("conv_id")).agg(F.sort_array(F.collect_list(one)).alias("rows"))
    safe = F.transform("rows", lambda r: F.struct(escape(r["role"]).alias("role"), escape(r["text"]).alias("text")))
    n = F.size("safe")
    begins = F.filter(
        F.sequence(F.lit(0), n - 1), lambda i: (i == 0) | (F.get("safe", i)["role"] != F.get("safe", i - 1)["role"])
    )

    def run(begin: Column, k: Column) -> Column:
        size = F.coalesce(F.get("begins", k + 1), n) - begin
        texts = F.transform(F.slice("safe", begin + 1, size), lambda r: r["text"])
        return F.struct(F.get("safe", begin)["role"].alias("role"), texts.alias("texts"))

    found = rows.select("conv_id", safe.alias("safe")).select("conv_id", "safe", begins.alias("begins"))
    return found.select("conv_id", F.transform("begins", run).alias("turns"))


def _marks(role: Column, which: int, other: Column) -> Column:
    out = other
    for name, marks in MARKS.items():
        out = F.when(role == name, marks[which]).otherwise(out)
    return out


def format_chats(conversations: DataFrame, **columns: str) -> DataFrame:
    """(conv_id, formatted, loss array<struct<start, length>>)."""
    merged = merged_turns(conversations, **columns)

    def pieces(t: Column) -> Column:
        role = t["role"]
        before = _marks(role, 0, F.concat(F.lit(ROLE), role, F.lit(TEXT)))
        between = _marks(role, 1, F.concat(F.lit(ROLE_MORE), role, F.lit(TEXT)))
        return F.transform(
            t["texts"],
            lambda x, i: F.struct(
                F.when(i == 0, before).otherwise(between).alias("before"),
                x.alias("text"),
                F.when(i == F.size(t["texts"]) - 1, _marks(role, 2, F.lit(ROLE_END))).otherwise("").alias("after"),
                (role == "assistant").alias("learn"),
            ),
        )

    cut = merged.select("conv_id", F.flatten(F.transform("turns", pieces)).alias("p"))
    whole = F.concat(F.lit(BEGIN), F.array_join(F.transform("p", lambda x: F.concat(x["before"], x["text"], x["after"])), ""))
    sizes = F.transform("p", lambda x: F.length(x["before"]) + F.length(x["text"]) + F.length(x["after"]))
    placed = _with_sums(cut.withColumn("sizes", sizes), "sizes")

    def spans(sums: Column) -> Column:
        def span(x: Column, i: Column) -> Column:
            start = F.lit(len(BEGIN)) + _sum_before(sums, i) + F.length(x["before"])
            return F.struct(start.alias("start"), F.length(x["text"]).alias("length"), x["learn"].alias("learn"))

        learned = F.filter(F.transform("p", span), lambda x: x["learn"])
        return F.transform(learned, lambda x: F.struct(x["start"].alias("start"), x["length"].alias("length")))

    loss = F.flatten(F.transform(F.array("sums"), spans))  # one element, so that the sums are made once
    return placed.select("conv_id", whole.alias("formatted"), loss.alias("loss"))


def _with_sums(df: DataFrame, sizes: str) -> DataFrame:
    """``df`` with the running sums of an array in two levels: those within
    runs of about the square root of its length, and those over the runs.
    An array grows by copying, so one level would be quadratic."""

    def running(values: Column) -> Column:
        return F.aggregate(values, F.array(F.lit(0)), lambda done, x: F.concat(done, F.array(F.element_at(done, -1) + x)))

    n = F.size(sizes)
    step = F.greatest(F.ceil(F.sqrt(n)), F.lit(1)).cast("int")
    within = F.transform(F.sequence(F.lit(0), n - 1, F.col("step")), lambda at: running(F.slice(sizes, at + 1, F.col("step"))))
    over = running(F.transform("within", lambda run: F.element_at(run, -1)))
    cut = df.withColumn("step", step).withColumn("within", within)
    return cut.withColumn("sums", F.struct("step", "within", over.alias("over")))


def _sum_before(sums: Column, i: Column) -> Column:
    """Sum of the values before place ``i``, from :func:`_with_sums`."""
    run = F.floor(i / sums["step"]).cast("int")
    return F.get(sums["over"], run) + F.get(F.get(sums["within"], run), i % sums["step"])


#: Code points per block in which :func:`under_mask` looks a span up.
SPAN_BLOCK = 1 << 14


def under_mask(formatted: str, loss: str) -> Column:
    """array<string> of the texts under the loss mask, as they stand in the
    output.  A span is sought in its own blocks of the output only, as
    ``substring`` walks a string from its beginning."""
    size = F.lit(SPAN_BLOCK)
    cut = F.transform(F.sequence(F.lit(0), F.length(formatted), size), lambda at: F.substring(F.col(formatted), at + 1, size))

    def text(blocks: Column, s: Column) -> Column:
        first = F.floor(s["start"] / size).cast("int")
        last = F.floor((s["start"] + s["length"]) / size).cast("int")
        near = F.array_join(F.slice(blocks, first + 1, last - first + 1), "")
        return F.substring(near, s["start"] - first * size + 1, s["length"])

    # A one-element array holds the blocks, so that they are cut once.
    return F.flatten(F.transform(F.array(cut), lambda blocks: F.transform(loss, lambda s: text(blocks, s))))


def read_back(formatted: Column) -> Column:
    """array<struct<role, text>> of the turns, from the output alone."""
    marks = F.regexp_extract_all(formatted, F.lit(f"({OWN})"), F.lit(1))
    parts = F.split(formatted, OWN)  # parts[i] stands before marks[i], parts[i + 1] after it
    after = F.slice(parts, 2, F.size(parts))
    around = F.zip_with(parts, after, lambda a, b: F.struct(a.alias("before"), b.alias("after")))
    both = F.zip_with(
        around, marks, lambda x, m: F.struct(x["before"].alias("before"), x["after"].alias("after"), m.alias("mark"))
    )

    def named(x: Column) -> Column:
        role = F.when(x["mark"] == TEXT, x["before"])  # the part before it names the role
        for name, (before, between, _) in MARKS.items():
            role = F.when(x["mark"].isin(before, between), name).otherwise(role)
        return F.struct(unescape(role).alias("role"), unescape(x["after"]).alias("text"))

    turns = F.transform(both, named)
    return F.filter(turns, lambda t: t["role"].isNotNull())


def op5_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    tricky = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-7, 0, "user", tricky), (-7, 1, "assistant", tricky)], given.schema)
    out = format_chats(given.unionByName(more)).withColumn("turns", read_back(F.col("formatted")))
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    learned = F.array_join(F.transform(under_mask("formatted", "loss"), unescape), "")
    found = out.select("conv_id", "formatted", F.size("turns").cast("long").alias("n_turns"), F.array_join(lines, "").alias("told"), learned.alias("learned"))
    return found.select(
        "conv_id", "n_turns", F.sha2("told", 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"), F.sha2("learned", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


# The digests need no template: they are those of the input.  The length is
# that of the texts, of the marks, and of one backslash for each mark spelled
# in a text.
_SPELLED = r"[\[<]\\*(?:<?/?SYS>>|/?s>|(?:SYS\+|/?INST\+?|ANS\+?|/?ROLE\+?|TEXT)\])"
ORACLE_SQL = f"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
l AS (SELECT *, lag(role) OVER w AS was, row_number() OVER w AS n,
    length(text) + len(regexp_extract_all(text, '{_SPELLED}')) AS size,
    length(role) + len(regexp_extract_all(role, '{_SPELLED}')) AS role_size
    FROM c WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
m AS (SELECT *, CASE role WHEN 'system' THEN 8 WHEN 'user' THEN 7 WHEN 'assistant' THEN 6 ELSE 13 + role_size END AS open_,
    CASE role WHEN 'system' THEN 8 WHEN 'user' THEN 9 WHEN 'assistant' THEN 8 ELSE 15 + role_size END AS more,
    CASE role WHEN 'system' THEN 9 WHEN 'user' THEN 8 WHEN 'assistant' THEN 5 ELSE 8 END AS close_ FROM l)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY n)) AS turns_sha256,
    coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY n) FILTER (role = 'assistant'), '')) AS loss_sha256,
    (3 + sum(size + CASE WHEN n > 1 AND role = was THEN more ELSE open_ + close_ END))::BIGINT AS formatted_chars
FROM m GROUP BY conv_id
"""
