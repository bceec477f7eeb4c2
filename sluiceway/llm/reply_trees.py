"""Chat formatting of the best paths through reply trees, on DataFrame functions alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluiceway.llm.scratch import Scratch

# The template's control strings.
OPEN, ROLE_START, ROLE_END, CLOSE = "<s>", "[INST] ", " [/INST]", "</s>"
LEARNED = "assistant"


def escaped(text: Column) -> Column:
    """Text in which no control string stands: each gets a backslash, and backslashes are doubled."""
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.regexp_replace(doubled, "(<(?=/?s>)|\\[(?=/?INST\\]))", "$1\\\\")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, "(?s)\\\\(.)", "$1")


def paths(messages: DataFrame, scratch: Scratch) -> DataFrame:
    """``tree, leaf, node, up`` for every node on the way from each leaf to its root.

    ``messages`` has ``tree, node, parent``. Each round joins the ways found so far with ancestors
    twice as far up, so the rounds grow with the logarithm of the depth and every join is by one
    node. A parent that does not exist makes a root; parents in a circle raise an error.
    """
    nodes = messages.select("tree", "node", "parent")
    known = nodes.select("tree", F.col("node").alias("parent"))
    inner = nodes.join(known, ["tree", "parent"]).select("tree", "node", "parent")
    jumps = scratch.keep(inner, "jumps")
    leaves = nodes.join(jumps.select("tree", F.col("parent").alias("node")).distinct(), ["tree", "node"], "left_anti")
    found = scratch.keep(leaves.select("tree", F.col("node").alias("leaf"), "node", F.lit(0).cast("bigint").alias("up")), "found")
    steps, most, circles = 1, nodes.count(), 0
    while jumps.count() > 0:
        if steps > most:
            raise ValueError("replies run in a circle")
        further = found.join(jumps, ["tree", "node"]).select("tree", "leaf", F.col("parent").alias("node"), (F.col("up") + steps).alias("up"))
        found = scratch.keep(found.unionByName(further), "found")
        twice = jumps.alias("x").join(jumps.alias("y"), (F.col("x.tree") == F.col("y.tree")) & (F.col("x.parent") == F.col("y.node")))
        jumps = scratch.keep(twice.select("x.tree", "x.node", "y.parent"), "jumps")
        steps *= 2
    scratch.drop("jumps")
    return found


def best_paths(messages: DataFrame, found: DataFrame, branches: int) -> DataFrame:
    """The ``branches`` ways of each tree with the highest sum of scores; ties go to the smaller leaf."""
    scores = found.join(messages.select("tree", "node", "score"), ["tree", "node"]).groupBy("tree", "leaf").agg(F.sum("score").alias("score"))
    order = Window.partitionBy("tree").orderBy(F.desc_nulls_last("score"), "leaf")
    ranked = scores.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= branches)
    return found.join(ranked.select("tree", "leaf", "rank"), ["tree", "leaf"])


def formatted(messages: DataFrame, branches: int = 1) -> DataFrame:
    """``tree, leaf, formatted, spans``: one conversation for each chosen way through a reply tree.

    ``messages`` has ``tree, node, parent, role, text, score``, a node once in its tree; null roles and
    texts are empty. ``spans`` has start (from 0) and length, in code points, of every text of the role
    that is learned. A way becomes one row, as it is one conversation; nothing else is gathered.
    """
    scratch = Scratch(messages.sparkSession, "replies")
    messages = scratch.keep(messages.select("tree", "node", "parent", "role", "text", "score"), "messages")
    way = best_paths(messages, paths(messages, scratch), branches)
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turns = way.join(messages.select("tree", "node", role.alias("role"), text.alias("text")), ["tree", "node"])
    head = F.concat(F.lit(OPEN + ROLE_START), escaped(F.col("role")), F.lit(ROLE_END))
    turns = turns.select("tree", "leaf", "up", (F.col("role") == LEARNED).alias("learned"), head.alias("head"), escaped(F.col("text")).alias("body"))
    length = F.char_length("head") + F.char_length("body") + len(CLOSE)
    before = Window.partitionBy("tree", "leaf").orderBy(F.desc("up")).rowsBetween(Window.unboundedPreceding, -1)
    turns = turns.withColumn("start", (F.coalesce(F.sum(length).over(before), F.lit(0)) + F.char_length("head")).cast("int"))
    turn = F.struct((-F.col("up")).alias("place"), "head", "body", "learned", "start")
    rows = turns.groupBy("tree", "leaf").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    whole = F.array_join(F.transform("turns", lambda t: F.concat(t["head"], t["body"], F.lit(CLOSE))), "")
    learned = F.filter("turns", lambda t: t["learned"])
    spans = F.transform(learned, lambda t: F.struct(t["start"].alias("start"), F.char_length(t["body"]).alias("length")))
    return rows.select("tree", "leaf", whole.alias("formatted"), spans.alias("spans"))


def read_back(conversations: DataFrame) -> DataFrame:
    """The conversations with ``turns array<struct<role,text>>`` and ``learned array<string>`` from the output alone."""
    pieces = F.split("formatted", CLOSE, -1)
    pieces = F.slice(pieces, 1, F.size(pieces) - 1)

    def turn(piece: Column) -> Column:
        head = F.substring_index(piece, ROLE_END, 1)
        role = F.substring(head, F.lit(len(OPEN + ROLE_START) + 1), F.char_length(head))
        text = F.substring(piece, F.char_length(head) + len(ROLE_END) + 1, F.char_length(piece))
        return F.struct(unescaped(role).alias("role"), unescaped(text).alias("text"))

    learned = F.transform("spans", lambda s: unescaped(F.substring(F.col("formatted"), s["start"] + 1, s["length"])))
    return conversations.withColumns({"turns": F.transform(pieces, turn), "learned": learned})


def chains(rows: DataFrame) -> DataFrame:
    """Messages of conversations without branches: every turn answers the one before it.

    Turns follow by number, equal ones by role and text; a null number comes first. Rows of a null
    conversation are one conversation. A message scores its length.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    numbered = rows.withColumn("node", F.row_number().over(order).cast("bigint"))
    score = F.char_length(F.coalesce("text", F.lit(""))).cast("bigint")
    tree = F.coalesce(F.col("conv_id").cast("string"), F.lit(""))
    return numbered.select(tree.alias("tree"), "node", (F.col("node") - 1).alias("parent"), "role", "text", score.alias("score"))


def digests(rows: DataFrame) -> DataFrame:
    """What reads back from every formatted conversation, and the fixed one -1 that speaks the template's own words."""
    spoken = "</s>[INST] ok [/INST]"
    own = rows.sparkSession.createDataFrame(
        [(-1, 0, "user", spoken), (-1, 1, LEARNED, spoken)], "conv_id bigint, turn bigint, role string, text string"
    )
    rows = rows.select(F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"), "role", "text").unionByName(own)
    back = read_back(formatted(chains(rows)))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    learned = F.array_join("learned", "")
    return back.select(
        F.when(F.col("tree") != "", F.col("tree")).cast("bigint").alias("conv_id"),
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.char_length(learned).cast("bigint").alias("loss_chars"),
        F.sha2(learned, 256).alias("loss_sha256"),
        F.char_length("formatted").cast("bigint").alias("formatted_chars"),
    )


DIGESTS_SQL = rf"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, '{LEARNED}', '</s>[INST] ok [/INST]')
), sized AS (
  SELECT *, role || chr(10) || text || chr(10) AS said, CASE WHEN role = '{LEARNED}' THEN text ELSE '' END AS learned,
    length(role || text) + length(regexp_replace(role || ' ' || text, '[^\\]', '', 'g'))
    + len(regexp_extract_all(role, '</?s>|\[/?INST\]')) + len(regexp_extract_all(text, '</?s>|\[/?INST\]')) + {len(OPEN + ROLE_START + ROLE_END + CLOSE)} AS chars
  FROM turns
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(said, '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  sum(length(learned))::BIGINT AS loss_chars, sha256(string_agg(learned, '' ORDER BY turn NULLS FIRST, role, text)) AS loss_sha256,
  sum(chars)::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id
"""
