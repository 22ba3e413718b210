"""Chat formatting: root-to-leaf paths of reply trees, each as one conversation.

A message has a tree, an id, the id of the message it answers, a role, a text and
a score. Native throughout: DataFrame functions only.

1. :func:`ancestors` doubles: round k joins every message that has a 2^k-th
   ancestor with the state of that ancestor, so a tree of depth d takes log2(d)
   joins on thin columns. Each message then knows its depth and its path's score.
2. :func:`branches` ranks the leaves of a tree by the mean score of their path (ties
   to the smaller leaf id) and keeps the best ``top``, or all.
3. :func:`paths` runs the rounds backwards: a row that stands for 2^(k+1) messages
   is split into two of 2^k by one self-join, until each stands for one message.
4. :func:`format_paths` joins role and text, writes runs of ``RUN`` turns each in a
   group of its own, and puts the runs of a path together with the spans that count
   for the loss. Keys carry the message or the run, never a whole tree; only the
   finished conversation, which is one value by its nature, is one row.

The template opens a turn with ``head``, divides role and text by ``sep`` and
closes with ``end``. In roles and texts a backslash is doubled, and a backslash is
put behind the first character of every control string (the template's and those
of ``foreign``), so no control string is left in them; :func:`unescape` drops
each backslash that escapes. :func:`read_back` parses a formatted conversation.

Defined cases: a null role or text is empty; a null tree is a tree of its own; an
answer to a message that is not there is a root; of rows with equal tree and id
the one with the least parent, role and text counts; messages of a reply cycle
have no root, so they are on no path. An empty table gives an empty table. Texts may
be as long as Spark allows for a value. Extra columns are not read. In
:func:`from_turns` every row is a message: rows with the same turn stand in order of
role and text, null turns come first.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce
from typing import Optional

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import stage

#: Turns that one group writes at most, and turns numbered in one window.
RUN, TURNS = 256, 1024


@dataclass(frozen=True)
class Template:
    head: str = "<|start_header_id|>"
    sep: str = "<|end_header_id|>"
    end: str = "<|eot_id|>"
    learn: tuple = ("assistant",)
    foreign: tuple = ("<|im_start|>", "<|im_end|>", "<s>", "</s>", "[INST]", "[/INST]")

    @property
    def controls(self) -> tuple:
        return (self.head, self.sep, self.end, *self.foreign)

    @property
    def pattern(self) -> str:
        """Matches the first character of every control string, overlapping ones too."""
        return "(?s)(?=" + "|".join(re.escape(c) for c in self.controls) + ")(.)"


def escape(text: Column, t: Template) -> Column:
    return F.regexp_replace(F.regexp_replace(text, r"\\", r"\\\\"), t.pattern, r"$1\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def key_of(tree: Column) -> Column:
    """A key that is never null and joins by plain equality."""
    return F.to_json(F.struct(tree.alias("t")))


def messages(df: DataFrame, tree, id_, parent, role, text, score: Optional[Column] = None) -> DataFrame:
    """Columns of ``df`` as a staged table ``tree, key, id, parent, role, text, score``."""
    score = F.lit(0.0) if score is None else F.coalesce(score.cast("double"), F.lit(0.0))
    rows = df.select(
        tree.alias("tree"), key_of(tree).alias("key"), id_.alias("id"), parent.alias("parent"),
        F.coalesce(role, F.lit("")).alias("role"), F.coalesce(text, F.lit("")).alias("text"), score.alias("score"),
    )
    rows = rows.groupBy("key", "id").agg(F.min(F.struct("parent", "role", "text", "score", "tree")).alias("m"))
    return stage(rows.select("key", "id", "m.*"), "messages")


def from_turns(df: DataFrame, tree, turn, role, text) -> DataFrame:
    """Linear conversations as messages: each row answers the row before it.

    Rows are numbered in windows of ``TURNS`` turns, plus the rows of the earlier
    windows, so a conversation with very many rows is not one group."""
    block = F.coalesce(F.floor(turn / TURNS), F.lit(-(1 << 52))).alias("block")
    rows = df.select(
        tree.alias("tree"), key_of(tree).alias("key"), block, turn.alias("turn"),
        F.coalesce(role, F.lit("")).alias("role"), F.coalesce(text, F.lit("")).alias("text"),
    )
    before = W.partitionBy("key").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    offsets = rows.groupBy("key", "block").agg(F.count(F.lit(1)).alias("n"))
    offsets = offsets.select("key", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    local = F.row_number().over(W.partitionBy("key", "block").orderBy("turn", "role", "text")) - 1
    rows = rows.withColumn("local", local).join(offsets, ["key", "block"])
    number = (F.col("offset") + F.col("local")).cast("long")
    rows = rows.select("key", number.alias("id"), F.when(number > 0, number - 1).alias("parent"), "role", "text", F.lit(0.0).alias("score"), "tree")
    return stage(rows, "messages")


def ancestors(nodes: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """``key, id, parent, score`` -> every message that has a root, with ``size``
    (messages on its path) and ``total`` (their scores), and the tables of rounds:
    table k holds ``key, id, up`` for messages with a 2^k-th ancestor."""
    here = nodes.select("key", F.col("id").alias("parent"), F.lit(True).alias("there"))
    first = nodes.join(here, ["key", "parent"], "left").select(
        "key", "id", F.when(F.col("there"), F.col("parent")).alias("up"), F.lit(1).cast("long").alias("size"), F.col("score").alias("total")
    )
    done, rounds, now = [], [], stage(first, "tree-round")
    left = now.where("up is not null").count()
    while True:
        done.append(now.where("up is null"))
        if not left:
            break
        rounds.append(now.where("up is not null"))
        state = reduce(DataFrame.unionByName, [*done, rounds[-1]])
        above = state.select("key", F.col("id").alias("up"), F.col("up").alias("up2"), F.col("size").alias("size2"), F.col("total").alias("total2"))
        now = rounds[-1].join(above, ["key", "up"]).select(
            "key", "id", F.col("up2").alias("up"), (F.col("size") + F.col("size2")).alias("size"), (F.col("total") + F.col("total2")).alias("total")
        )
        now = stage(now, "tree-round")
        before, left = left, now.where("up is not null").count()
        if left == before:  # a round roots a message unless all that is left runs in cycles
            done.append(now.where("up is null"))
            break
    return reduce(DataFrame.unionByName, done).drop("up"), [r.select("key", "id", "up") for r in rounds]


def branches(nodes: DataFrame, rooted: DataFrame, top: Optional[int] = None) -> DataFrame:
    """The leaves of every tree with their path's mean score: ``key, leaf, size,
    score``; the ``top`` best of a tree where given."""
    answered = nodes.where("parent is not null").select("key", F.col("parent").alias("id")).distinct()
    leaves = rooted.join(answered, ["key", "id"], "left_anti").select("key", F.col("id").alias("leaf"), "size", (F.col("total") / F.col("size")).alias("score"))
    if top is None:
        return leaves
    rank = F.row_number().over(W.partitionBy("key").orderBy(F.desc("score"), "leaf"))
    return leaves.withColumn("rank", rank).where(F.col("rank") <= top).drop("rank")


def paths(leaves: DataFrame, rounds: list[DataFrame]) -> DataFrame:
    """Every message of every chosen path: ``key, leaf, id, pos`` (0 at the root)."""
    out = leaves.select("key", "leaf", F.col("leaf").alias("id"), (F.col("size") - 1).alias("pos"))
    for k in reversed(range(len(rounds))):
        both = F.array(F.struct("id", "pos"), F.when(F.col("up").isNotNull(), F.struct(F.col("up").alias("id"), (F.col("pos") - (1 << k)).alias("pos"))))
        out = out.join(rounds[k], ["key", "id"], "left").select("key", "leaf", F.explode(F.filter(both, lambda x: x.isNotNull())).alias("m"))
        out = out.select("key", "leaf", "m.*")
        if k and k % 4 == 0:
            out = stage(out, "paths")
    return out


def format_paths(msgs: DataFrame, path: DataFrame, t: Template = Template()) -> DataFrame:
    """One row a path: ``key, leaf, tree, formatted, n_turns, loss`` where ``loss``
    lists ``start, length`` (code points of ``formatted``) of the texts to learn."""
    opening = F.concat(F.lit(t.head), escape(F.col("role"), t), F.lit(t.sep))
    body = escape(F.col("text"), t)
    turns = path.join(msgs.select("key", "id", "role", "text", "tree"), ["key", "id"]).select(
        "key", "leaf", "tree", F.expr(f"pos div {RUN}").alias("run"), "pos",
        opening.alias("opening"), body.alias("body"), F.col("role").isin(*t.learn).alias("learn"),
    )
    piece = F.struct("pos", F.concat("opening", "body", F.lit(t.end)).alias("piece"), F.char_length("opening").alias("skip"), F.char_length("body").alias("chars"), "learn")
    runs = turns.groupBy("key", "leaf", "run").agg(F.sort_array(F.collect_list(piece)).alias("p"), F.max("tree").alias("tree"))
    runs = runs.select("key", "leaf", "run", "tree", "p", F.array_join("p.piece", "").alias("text"))
    # where each turn of the run begins; at most RUN of them
    ends = F.expr("transform(p, (x, i) -> aggregate(slice(p, 1, i), 0L, (a, y) -> a + char_length(y.piece)))")
    runs = runs.withColumn("starts", ends).withColumn("chars", F.char_length("text").cast("long"))
    spans = F.expr("filter(transform(p, (x, i) -> if(x.learn, named_struct('start', starts[i] + x.skip, 'length', cast(x.chars as bigint)), null)), x -> x is not null)")
    runs = runs.select("key", "leaf", "run", "tree", "text", "chars", spans.alias("spans"), F.size("p").cast("long").alias("n"))
    before = W.partitionBy("key", "leaf").orderBy("run").rowsBetween(W.unboundedPreceding, -1)
    runs = runs.withColumn("base", F.coalesce(F.sum("chars").over(before), F.lit(0)))
    runs = runs.withColumn("spans", F.expr("transform(spans, x -> named_struct('start', x.start + base, 'length', x.length))"))
    whole = runs.groupBy("key", "leaf").agg(F.sort_array(F.collect_list(F.struct("run", "text", "spans"))).alias("r"), F.max("tree").alias("tree"), F.sum("n").alias("n_turns"))
    return whole.select("key", "leaf", "tree", F.array_join("r.text", "").alias("formatted"), "n_turns", F.flatten("r.spans").alias("loss"))


def read_back(formatted: Column, t: Template = Template()) -> Column:
    """Parse a formatted conversation: an array of ``role, text`` in order."""
    turns = F.filter(F.split(formatted, re.escape(t.end), -1), lambda x: x != "")

    def turn(x):
        role, text = F.substring_index(x, t.sep, 1), F.substring(x, F.instr(x, t.sep) + len(t.sep), F.char_length(x))
        return F.struct(unescape(F.substring(role, F.lit(len(t.head) + 1), F.char_length(role))).alias("role"), unescape(text).alias("text"))

    return F.transform(turns, turn)


def loss_text(formatted: Column, loss: Column) -> Column:
    """The unescaped text under the loss mask, span after span."""
    return F.array_join(F.transform(loss, lambda s: unescape(F.substring(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int")))), "")


def chats(msgs: DataFrame, top: Optional[int] = None, t: Template = Template()) -> DataFrame:
    """Messages (see :func:`messages`, :func:`from_turns`) -> formatted conversations, one a chosen branch."""
    nodes = msgs.select("key", "id", "parent", "score")
    rooted, rounds = ancestors(nodes)
    leaves = branches(nodes, rooted, top)
    return format_paths(msgs, paths(leaves, rounds), t)
