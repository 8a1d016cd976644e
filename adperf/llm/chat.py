"""Chat formatting of reply trees.

Messages answer messages.  Self-joins find the path from every leaf to its root: the
parent table is joined with itself, so that each round doubles the distance it
covers, and the set of (leaf, ancestor) pairs is extended by it.  Paths are ranked by
the mean score of their messages, and each chosen path is written as one
conversation with a mask over the assistant's texts.

A turn is `<s>[role]` newline text `</s>` newline.  Inside texts and roles the
characters that could begin a control string are written as % and two hex digits,
as is % itself, so the text can be read back exactly.

Defined cases: null texts and roles are empty; a message whose parent is null or
missing is a root; messages on a cycle have no root and are on no path; equal
messages of one conversation (same turn, role and text) are each a turn; rows of one
turn number follow by role, then text; a null conversation id is one conversation;
an empty table gives no rows; a conversation is one string, so it is bounded by the
2 GB that a string can hold; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from adperf.sources.staging import stage

OPEN, HEADER_END, CLOSE = "<s>[", "]\n", "</s>\n"
ASSISTANT = "assistant"
#: Written forms, the escape character first.
ESCAPES = (("%", "%25"), ("<", "%3C"), ("[", "%5B"))
ROLE_ESCAPES = (*ESCAPES, ("]", "%5D"), ("\n", "%0A"))


def escape(text: Column, pairs: tuple[tuple[str, str], ...] = ESCAPES) -> Column:
    for plain, written in pairs:
        text = F.replace(text, F.lit(plain), F.lit(written))
    return text


def unescape(text: Column, pairs: tuple[tuple[str, str], ...] = ESCAPES) -> Column:
    for plain, written in reversed(pairs):
        text = F.replace(text, F.lit(written), F.lit(plain))
    return text


def linear_messages(
    rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """Conversations as trees: each row answers the one before it."""
    order = Window.partitionBy("tree").orderBy("turn", "role", "text")
    picked = rows.select(
        F.col(conv).cast("long").alias("tree"), F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    )
    numbered = picked.withColumn("msg", F.row_number().over(order).cast("long"))
    parent = F.when(F.col("msg") > 1, F.col("msg") - 1)
    return numbered.select("tree", "msg", parent.alias("parent"), "role", "text", F.lit(1.0).alias("score"))


def _same(a: str, b: str) -> Column:
    return F.col(f"{a}.tree").eqNullSafe(F.col(f"{b}.tree"))


def leaf_paths(messages: DataFrame) -> DataFrame:
    """tree, leaf, msg, up (steps from the leaf) for every message on a path to a root."""
    links = messages.select("tree", "msg", "parent")
    known = messages.select("tree", "msg")
    jumps = stage(
        links.filter("parent is not null").alias("a")
        .join(known.alias("b"), _same("a", "b") & (F.col("a.parent") == F.col("b.msg")))
        .select("a.tree", "a.msg", F.col("a.parent").alias("to")),
        "parents",
    )
    inner = jumps.select("tree", F.col("to").alias("msg")).distinct()
    found = stage(
        known.alias("a").join(inner.alias("b"), _same("a", "b") & (F.col("a.msg") == F.col("b.msg")), "left_anti")
        .select("tree", F.col("msg").alias("leaf"), "msg", F.lit(0).cast("long").alias("up")),
        "leaves",
    )
    step, most = 1, messages.count()
    while not jumps.isEmpty():
        if step > most:  # further up than there are messages: on a cycle, or hanging from one
            lost = jumps.select("tree", F.col("msg").alias("leaf"))
            return found.alias("a").join(
                lost.alias("b"), _same("a", "b") & (F.col("a.leaf") == F.col("b.leaf")), "left_anti")
        further = (
            found.alias("a").join(jumps.alias("b"), _same("a", "b") & (F.col("a.msg") == F.col("b.msg")))
            .select("a.tree", "a.leaf", F.col("b.to").alias("msg"), (F.col("a.up") + step).alias("up"))
        )
        found = stage(found.unionByName(further), "paths")
        jumps = stage(
            jumps.alias("a").join(jumps.alias("b"), _same("a", "b") & (F.col("a.to") == F.col("b.msg")))
            .select("a.tree", "a.msg", "b.to"),
            "jumps",
        )
        step *= 2
    return found


def conversations(messages: DataFrame, branches: int | None = 1) -> DataFrame:
    """The chosen branches of every tree: tree, leaf, rank and turns (role, text) from the root.

    `branches` paths of the highest mean score for each tree, ties by smaller leaf;
    None takes all.
    """
    on_path = leaf_paths(messages).alias("a").join(
        messages.alias("b"), _same("a", "b") & (F.col("a.msg") == F.col("b.msg"))
    )
    paths = on_path.groupBy(F.col("a.tree").alias("tree"), F.col("a.leaf").alias("leaf")).agg(
        F.avg("b.score").alias("score"),
        F.array_sort(F.collect_list(F.struct((-F.col("a.up")).alias("k"), "b.role", "b.text"))).alias("turns"),
    )
    best = Window.partitionBy("tree").orderBy(F.desc("score"), "leaf")
    ranked = paths.withColumn("rank", F.row_number().over(best))
    if branches is not None:
        ranked = ranked.filter(F.col("rank") <= branches)
    turns = F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    return ranked.select("tree", "leaf", "rank", "score", turns.alias("turns"))


def format_paths(paths: DataFrame) -> DataFrame:
    """tree, leaf, rank, formatted and loss_spans (turn, start, length within the turn)."""
    def head(t: Column) -> Column:
        return F.concat(F.lit(OPEN), escape(t["role"], ROLE_ESCAPES), F.lit(HEADER_END))

    rendered = F.transform("turns", lambda t: F.concat(head(t), escape(t["text"]), F.lit(CLOSE)))
    spans = F.transform("turns", lambda t, i: F.when(t["role"] == ASSISTANT, F.struct(
        i.alias("turn"), F.length(head(t)).alias("start"), F.length(escape(t["text"])).alias("length"))))
    return paths.select(
        "tree", "leaf", "rank",
        F.array_join(rendered, "").alias("formatted"), F.array_compact(spans).alias("loss_spans"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """The formatted rows with `turns` (role, text) and `loss_text` parsed from their string."""
    pieces = F.split("formatted", CLOSE)
    rows = formatted.withColumn("_turns", F.slice(pieces, 1, F.size(pieces) - 1))

    def parsed(t: Column) -> Column:
        head = F.substring_index(t, HEADER_END, 1)
        return F.struct(
            unescape(F.substr(head, F.lit(len(OPEN) + 1)), ROLE_ESCAPES).alias("role"),
            unescape(F.substr(t, F.length(head) + len(HEADER_END) + 1)).alias("text"),
        )

    masked = F.transform("loss_spans", lambda s: unescape(
        F.substr(F.get("_turns", s["turn"]), s["start"] + 1, s["length"])))
    return rows.withColumns({
        "turns": F.transform("_turns", parsed), "loss_text": F.array_join(masked, ""),
    }).drop("_turns")


def digests(formatted: DataFrame) -> DataFrame:
    """What the formatted conversations hold, read back from them."""
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read_back(formatted).select(
        F.col("tree").alias("conv_id"),
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def control_conversation(spark: SparkSession) -> DataFrame:
    """Conversation -7, whose texts are made of control strings."""
    return spark.sql(
        "SELECT CAST(col1 AS BIGINT) AS conv_id, CAST(col2 AS BIGINT) AS turn, col3 AS role, col4 AS text"
        " FROM VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')"
    )


#: The same digests from the rows, with the lengths of the written form.
SQL = """
WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]'))
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn, role, text))
    AS loss_sha256,
  CAST(sum(11 + length(role) + length(text)
    + 2 * (length(role || text) - length(regexp_replace(role || text, '[%<\\[]', '', 'g')))
    + 2 * (length(role) - length(regexp_replace(role, '[\\]\\n]', '', 'g')))) AS BIGINT) AS formatted_chars
FROM said GROUP BY conv_id
"""
