"""Chat formatting over reply trees. Native functions only.

Messages form trees: a message names its parent, a message without a parent in
its tree is a root. Root-to-leaf paths are enumerated by self-joins: every leaf
knows itself, and each round joins the known ancestors with a table of
ancestors twice as far up, so a path of depth d is whole after log2(d) rounds.
Branches of a tree are ranked by the mean score of their messages (a null score
is 0; ties go to the smaller leaf), and each chosen path becomes one
conversation.

Template: ``### Role: text</turn>`` and a line end per turn. ``user``,
``assistant`` and ``system`` stand capitalised, any other role verbatim after
``=``. Inside roles and texts the escapes are ``\\\\`` for a backslash, ``\\h``
for a ``#`` that two more follow, ``\\l`` for the ``<`` of ``</turn>`` and, in
roles, ``\\c`` for a colon. So neither ``###`` nor ``</turn>`` occurs inside a
text, and every text is read back as it was. The loss mask is a list of code
point spans of the formatted conversation, one per assistant text.

Defined results: a null text or role is empty; a message that is its own parent
is a root; messages on a cycle are on no path; messages that repeat an id are
both on the paths through it, ordered by role and text. A formatted conversation
is one value, so a path's turns meet in one task; everything before moves ids.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import materialise

TURN_END = "</turn>\n"
ROLES = ("user", "assistant", "system")


def escape(text: Column) -> Column:
    out = F.replace(F.coalesce(text, F.lit("")), F.lit("\\"), F.lit("\\\\"))
    out = F.regexp_replace(out, "#(?=##)", r"\\h")
    return F.replace(out, F.lit("</turn>"), F.lit("\\l/turn>"))


def unescape(text: Column) -> Column:
    """Inverse of ``escape``: pairs of backslashes are taken out from the left before the letters are read."""
    def read(part: Column) -> Column:
        out = F.replace(F.replace(part, F.lit("\\l"), F.lit("<")), F.lit("\\h"), F.lit("#"))
        return F.replace(out, F.lit("\\c"), F.lit(":"))

    return F.array_join(F.transform(F.split(text, r"\\\\", -1), read), "\\")


def header(role: Column) -> Column:
    plain = F.coalesce(role, F.lit(""))
    shown = F.when(plain.isin(*ROLES), F.initcap(plain)).otherwise(F.concat(F.lit("="), F.replace(escape(plain), F.lit(":"), F.lit("\\c"))))
    return F.concat(F.lit("### "), shown, F.lit(": "))


def turns(formatted: Column) -> Column:
    """Array of (role, text) read back from a formatted conversation."""
    def read(piece: Column) -> Column:
        at = F.locate(": ", piece)
        shown = F.substring(piece, F.lit(5), at - 5)
        role = F.when(shown.startswith("="), unescape(F.substring(shown, F.lit(2), F.length(shown)))).otherwise(F.lower(shown))
        return F.struct(role.alias("role"), unescape(F.substring(piece, at + 2, F.length(piece))).alias("text"))

    pieces = F.split(formatted, TURN_END, -1)
    return F.transform(F.slice(pieces, F.lit(1), F.size(pieces) - 1), read)


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped and joined."""
    return F.array_join(F.transform(spans, lambda s: unescape(F.substring(formatted, s["start"] + 1, s["chars"]))), "")


def paths(messages: DataFrame) -> DataFrame:
    """(tree, leaf, msg, up) for every message on the path of every leaf; ``up`` counts from the leaf.

    ``messages`` holds (tree, msg, parent), stored, one row per message id.
    """
    there = messages.select("tree", F.col("msg").alias("parent"))
    known = messages.where("parent <> msg").join(there, ["tree", "parent"]).select("tree", "msg", "parent")
    parents = known.select("tree", F.col("parent").alias("msg")).distinct()
    found = materialise(messages.join(parents, ["tree", "msg"], "left_anti")
                        .select("tree", F.col("msg").alias("leaf"), "msg", F.lit(0).cast("long").alias("up")), "leaves")
    jump = materialise(known.select("tree", F.col("msg").alias("from"), F.col("parent").alias("to")), "parents")
    deepest = messages.groupBy("tree").count().agg(F.max("count")).first()[0] or 0
    far = 1
    # No path is longer than its tree has messages; what still climbs then runs in a cycle.
    while far < deepest and not jump.isEmpty():
        more = found.join(jump.withColumnRenamed("from", "msg"), ["tree", "msg"]).select("tree", "leaf", F.col("to").alias("msg"), (F.col("up") + far).alias("up"))
        found = materialise(found.unionByName(more), "paths")
        second = jump.select("tree", F.col("from").alias("to"), F.col("to").alias("beyond"))
        jump = materialise(jump.join(second, ["tree", "to"]).select("tree", "from", F.col("beyond").alias("to")), "jump")
        far *= 2
    if jump.isEmpty():
        return found
    cyclic = jump.select("tree", F.col("from").alias("msg")).distinct()  # climbs further than its tree is large
    bad = found.join(cyclic, ["tree", "msg"], "left_semi").select("tree", "leaf").distinct()
    return found.join(bad, ["tree", "leaf"], "left_anti")


def conversations(messages: DataFrame, best: int | None = None, tree: str = "conv_id", msg: str = "msg_id", parent: str = "parent_id",
                  role: str = "role", text: str = "text", score: str = "score") -> DataFrame:
    """(tree, leaf, rank, score, n_turns, formatted, spans) of the ``best`` branches of every tree (all if null).

    ``spans`` holds (start, chars) of every assistant text in ``formatted``.
    """
    key = F.coalesce(F.concat(F.lit("="), F.col(tree).cast("string")), F.lit("null"))
    rows = materialise(messages.where(F.col(msg).isNotNull()).select(
        key.alias("tree"), F.col(tree).alias("name"), F.col(msg).alias("msg"), F.col(parent).alias("parent"),
        F.col(role).cast("string").alias("role"), F.col(text).cast("string").alias("text"), F.coalesce(F.col(score).cast("double"), F.lit(0.0)).alias("score")), "messages")
    ids = materialise(rows.groupBy("tree", "msg").agg(F.min("parent").alias("parent"), F.avg("score").alias("score"), F.first("name").alias("name")), "ids")
    found = paths(ids.select("tree", "msg", "parent"))
    scored = found.join(ids.select("tree", "msg", "score", "name"), ["tree", "msg"]).groupBy("tree", "leaf").agg(
        F.avg("score").alias("branch_score"), F.max("up").alias("depth"), F.first("name").alias("name"))
    rank = F.row_number().over(Window.partitionBy("tree").orderBy(F.col("branch_score").desc(), "leaf"))
    ranked = scored.withColumn("rank", rank)
    if best is not None:
        ranked = ranked.where(F.col("rank") <= best)
    chosen = found.join(ranked, ["tree", "leaf"]).select("tree", "leaf", "msg", (F.col("depth") - F.col("up")).alias("pos"), "rank", "branch_score", "name")
    told = chosen.join(rows.select("tree", "msg", "role", "text"), ["tree", "msg"])
    told = told.select("tree", "leaf", "pos", "rank", "branch_score", "name", "role", "text", header(F.col("role")).alias("head"), escape(F.col("text")).alias("body"))
    order = Window.partitionBy("tree", "leaf").orderBy("pos", "role", "text")
    turn = F.concat("head", "body", F.lit(TURN_END))
    before = F.coalesce(F.sum(F.length(turn)).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast("int")
    told = told.withColumns({"n": F.row_number().over(order), "start": before + F.length("head")})
    packed = told.groupBy("tree", "leaf").agg(
        F.first("name").alias("name"), F.first("rank").alias("rank"), F.first("branch_score").alias("branch_score"),
        F.array_sort(F.collect_list(F.struct("n", turn.alias("turn"), "start", F.length("body").alias("chars"), (F.col("role") == "assistant").alias("loss")))).alias("t"))
    return packed.select(
        F.col("name").alias(tree), "leaf", "rank", F.col("branch_score").alias("score"), F.size("t").cast("long").alias("n_turns"),
        F.array_join("t.turn", "").alias("formatted"),
        F.transform(F.filter("t", lambda x: x["loss"]), lambda x: F.struct(x["start"].alias("start"), x["chars"].alias("chars"))).alias("spans"))


def as_tree(turns_: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Linear conversations as reply trees: each row answers the one before it, by turn (then role and text)."""
    n = F.row_number().over(Window.partitionBy(conv).orderBy(turn, role, text)).cast("long")
    rows = turns_.select(F.col(conv), F.col(role), F.coalesce(F.col(text), F.lit("")).alias(text), n.alias("msg_id"))
    return rows.withColumns({"parent_id": F.when(F.col("msg_id") > 1, F.col("msg_id") - 1), "score": F.lit(0.0)})
