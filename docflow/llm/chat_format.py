"""Operator 3, chat formatting by reply trees (DataFrame functions only).

Messages form trees by their parent. Pointer-doubling self-joins list every root-to-leaf path in a number of rounds
that is the logarithm of the depth, branches are ranked by score, and each chosen path becomes one conversation string
with a loss mask over its assistant texts. Pointers are doubled for nodes first, a row each; those that never reach a root are on or
below a cycle, and only leaves of the others are followed, so what is stored is in proportion to the paths there are.

Template, for each turn: ``<|im_start|>ROLE\\nTEXT<|im_end|>\\n``. Inside roles and texts a backslash is doubled and a
backslash is put behind the first character of every control string (``<|``, ``<s>``, ``</s>``, ``<<SYS>>``,
``<</SYS>>``, ``[INST]``, ``[/INST]``), so that none is left; dropping the first of each backslash pair undoes both.

Edge cases: a null role or text is empty; a null or unknown parent makes a root; a message that its own ancestors lead
back to (a cycle), and what hangs below it, has no root and is on no path; repeated (tree, id) rows count once, the
least row by (parent, role, text, score); equal scores rank by leaf id; a null tree key is a tree of its own; an empty
table gives no rows. Columns beside the named ones are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialize, sums_before, table

START, END = "<|im_start|>", "<|im_end|>\n"
CONTROL_HEAD = r"<(?=\||s>|/s>|<SYS>>|</SYS>>)|\[(?=INST\]|/INST\])"


def escape(text: Column) -> Column:
    doubled = F.regexp_replace(F.coalesce(text, F.lit("")), r"\\", r"\\\\")
    return F.regexp_replace(doubled, f"({CONTROL_HEAD})", r"$1\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def escape_role(role: Column) -> Column:
    return F.regexp_replace(escape(role), "\n", "\\\\\n")


def reply_paths(messages: DataFrame) -> DataFrame:
    """messages(tree, id, parent) -> (tree, leaf, node, dist), a row for each node on each root-to-leaf path.

    dist is 0 at the leaf. Ids are unique in a tree.
    """
    nodes = messages.select("tree", "id", "parent")
    known = nodes.select(F.col("tree").alias("kt"), F.col("id").alias("kp"))
    up = materialize(
        nodes.join(known, F.col("tree").eqNullSafe(F.col("kt")) & (F.col("parent") == F.col("kp")), "left").select("tree", "id", F.col("kp").alias("anc")),
        "reply_up",
    )
    jumps, hops, before = up.where("anc is not null"), [], None
    while (now := jumps.count()) and now != before:  # depths have no gaps: if no node reaches its root in a round, none will
        before = now
        hops.append(jumps.select(F.col("tree").alias("jt"), F.col("id").alias("jn"), F.col("anc").alias("ja")))
        jumps = materialize(jumps.join(hops[-1], F.col("tree").eqNullSafe(F.col("jt")) & (F.col("anc") == F.col("jn"))).select("tree", "id", F.col("ja").alias("anc")), "reply_jumps")
    rootless = jumps.select(F.col("tree").alias("kt"), F.col("id").alias("kp"))
    parents = up.where("anc is not null").select(F.col("tree").alias("kt"), F.col("anc").alias("kp"))
    same = F.col("tree").eqNullSafe(F.col("kt")) & (F.col("id") == F.col("kp"))
    leaves = up.join(parents.unionByName(rootless).distinct(), same, "left_anti")
    paths = materialize(leaves.select("tree", F.col("id").alias("leaf"), F.col("id").alias("node"), F.lit(0).cast("long").alias("dist")), "reply_paths")
    for k, hop in enumerate(hops):
        longer = paths.join(hop, F.col("tree").eqNullSafe(F.col("jt")) & (F.col("node") == F.col("jn"))).select("tree", "leaf", F.col("ja").alias("node"), (F.col("dist") + (1 << k)).alias("dist"))
        paths = materialize(paths.unionByName(longer), "reply_paths")
    return paths


def format_trees(messages: DataFrame, branches: int | None = 1) -> DataFrame:
    """messages(tree, id, parent, role, text, score) -> (tree, leaf, rank, branch_score, formatted, loss_spans).

    A branch's score is the mean of its messages' scores (null: 0). branches: so many of the best of each tree; None: all.
    loss_spans: (start, end) code points of the assistant texts in formatted, end exclusive.
    """
    msgs = messages.select("tree", "id", "parent", "role", "text", "score")
    msgs = msgs.groupBy("tree", "id").agg(F.min(F.struct("parent", "role", "text", "score")).alias("m")).select("tree", "id", "m.*")
    msgs = materialize(msgs, "messages")
    paths = reply_paths(msgs)
    scores = msgs.select(F.col("tree").alias("st"), F.col("id").alias("si"), F.coalesce("score", F.lit(0.0)).cast("double").alias("s"))
    ranked = paths.join(scores, F.col("tree").eqNullSafe(F.col("st")) & (F.col("node") == F.col("si"))).groupBy("tree", "leaf").agg(F.avg("s").alias("branch_score"))
    ranked = ranked.withColumn("rank", F.row_number().over(Window.partitionBy("tree").orderBy(F.desc("branch_score"), "leaf")))
    if branches is not None:
        ranked = ranked.where(F.col("rank") <= branches)
    chosen = ranked.select(F.col("tree").alias("ct"), F.col("leaf").alias("cl"), "branch_score", "rank")
    steps = paths.join(chosen, F.col("tree").eqNullSafe(F.col("ct")) & (F.col("leaf") == F.col("cl")))
    texts = msgs.select(F.col("tree").alias("mt"), F.col("id").alias("mi"), "role", "text")
    steps = steps.join(texts, F.col("tree").eqNullSafe(F.col("mt")) & (F.col("node") == F.col("mi")))
    steps = steps.select(
        "tree", "leaf", "rank", "branch_score", (-F.col("dist")).alias("at"), (F.coalesce("role", F.lit("")) == "assistant").alias("loss"),
        F.concat(F.lit(START), escape_role(F.col("role")), F.lit("\n")).alias("head"), escape(F.col("text")).alias("body"),
    )
    steps = steps.withColumn("piece", F.concat("head", "body", F.lit(END)))
    before = Window.partitionBy("tree", "leaf").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    begin = F.coalesce(F.sum(F.length("piece")).over(before), F.lit(0)) + F.length("head")
    steps = steps.withColumn("begin", begin).withColumn("end", F.col("begin") + F.length("body"))
    out = steps.groupBy("tree", "leaf", "rank", "branch_score").agg(F.array_sort(F.collect_list(F.struct("at", "piece", "begin", "end", "loss"))).alias("turns"))
    return out.select(
        "tree", "leaf", "rank", "branch_score", F.array_join(F.transform("turns", lambda t: t["piece"]), "").alias("formatted"),
        F.transform(F.filter("turns", lambda t: t["loss"]), lambda t: F.struct(t["begin"].alias("start"), t["end"].alias("end"))).alias("loss_spans"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """Parse formatted strings: adds turns (role, text) and loss_text, all text under the mask without escapes.

    The mask has a span for each assistant turn, as format_trees makes it, and each is read within its turn's piece.
    """
    head = r"(?s)^<\|im_start\|>((?:\\.|[^\\\n])*+)\n"
    pieces = F.split("formatted", r"<\|im_end\|>\n", -1)
    rows = formatted.withColumn("_pieces", F.slice(pieces, 1, F.greatest(F.size(pieces) - 1, F.lit(0))))
    rows = rows.withColumn("_at", sums_before(F.transform("_pieces", lambda p: F.length(p) + len(END))))

    def parsed(x: Column) -> Column:
        role, body = F.regexp_extract(x["piece"], head, 1), F.regexp_replace(x["piece"], head, "")
        return F.struct(unescape(role).alias("role"), body.alias("body"), (x["at"] + F.length(x["piece"]) - F.length(body)).alias("begin"))

    rows = rows.withColumn("_turns", F.transform(F.arrays_zip(F.col("_pieces").alias("piece"), F.col("_at").alias("at")), parsed))
    said = F.arrays_zip(F.filter("_turns", lambda t: t["role"] == "assistant").alias("turn"), F.col("loss_spans").alias("span"))
    masked = F.transform(said, lambda x: F.substring(x["turn"]["body"], F.greatest(x["span"]["start"] - x["turn"]["begin"], F.lit(0)).cast("int") + 1, (x["span"]["end"] - x["span"]["start"]).cast("int")))
    turns = F.transform("_turns", lambda t: F.struct(t["role"].alias("role"), unescape(t["body"]).alias("text")))
    return rows.withColumn("turns", turns).withColumn("loss_text", unescape(F.array_join(masked, ""))).drop("_pieces", "_at", "_turns")


def linear_messages(conversations: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) as trees without branches: each turn answers the one before it."""
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), F.col("role").asc_nulls_first(), F.col("text").asc_nulls_first())
    rows = conversations.select("conv_id", "turn", "role", "text").withColumn("id", F.row_number().over(order).cast("long"))
    return rows.select(F.col("conv_id").alias("tree"), "id", F.when(F.col("id") > 1, F.col("id") - 1).alias("parent"), "role", "text", F.lit(0.0).alias("score"))


def op3_reply_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and conversation -1, whose two turns consist of control strings."""
    own = spark.sql("SELECT * FROM VALUES (-1L, 0L, 'user', '</s>[INST] ok [/INST]'), (-1L, 1L, 'assistant', '</s>[INST] ok [/INST]') AS own(conv_id, turn, role, text)")
    rows = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text").unionByName(own)
    out = read_back(format_trees(linear_messages(rows), branches=None))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return out.select(
        F.col("tree").alias("conv_id"), F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"),
    )


_CTRL = r"<\||<s>|</s>|<<SYS>>|<</SYS>>|\[INST\]|\[/INST\]"
_EXTRA = "(length({c}) - length(replace({c}, '\\', '')) + len(regexp_extract_all({c}, '" + _CTRL + "')))"
ORACLE = f"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(CASE WHEN role = 'assistant' THEN length(text) END), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '')) AS loss_sha256,
  sum({len(START)} + length(role) + {_EXTRA.format(c='role')} + length(role) - length(replace(role, chr(10), '')) + 1
      + length(text) + {_EXTRA.format(c='text')} + {len(END)})::BIGINT AS formatted_chars
FROM rows GROUP BY conv_id"""
