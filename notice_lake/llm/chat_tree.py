"""Chat formatting: conversations merged into a prefix tree, shared turns written once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from notice_lake.llm.common import once, stored

#: Bytes of a digest.
_DIGEST = 16
#: Control strings of the template.
BEGIN, END, BREAK = "<|im_start|>", "<|im_end|>", "<|newline|>"


def escaped(text: Column) -> Column:
    """``<|`` cannot occur in the result: a backslash goes in between, one more if some are there."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def prefix_tree(
    conversations: DataFrame,
    learn: str = "assistant",
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> tuple[DataFrame, DataFrame]:
    """Formats conversations and merges those that begin with the same turns.

    Returns two tables. The nodes, one per different beginning: ``node``, ``parent`` (null at the top),
    ``depth``, ``start`` and ``length`` (its place in the sequence of all nodes), ``position`` (position
    id of its first character), ``segment`` (its turn as formatted), ``loss_start`` and ``loss_length``
    (the part of the segment to learn, null for roles other than ``learn``) and ``ancestors`` (the
    intervals of the sequence that its characters attend to beside their own segment so far; ancestors
    that follow each other are one interval). And the conversations: ``conv_id``, ``leaf``, ``n_turns``,
    ``starts`` (the places of its turns).

    The sequence is depth-first. Different conversations are sorted by their paths of digests, over
    ranges; each writes the end of its path that no earlier one has, in one run, so a node stands
    before all below it and the ancestors of a node lie in as many intervals as there are runs on its
    path. Places are running sums inside a range and over ranges. Lengths and positions count
    characters (code points). A conversation is one row, and its path and places are copied at each turn, so
    that part of the work grows with the square of the turns of one conversation. A turn that a
    third of all conversations begin with is combined before the shuffle and written once.

    Turns are in order of number, then role and text, so ties and repeated rows have
    a fixed order. Null roles and texts are empty. Rows without a conversation id are one conversation. An
    empty table gives empty results. Other input columns are not looked at.
    """
    empty = F.lit("")
    turns = conversations.groupBy(F.col(f"`{conv_id}`").alias("conv_id")).agg(
        F.array_sort(
            F.collect_list(
                F.struct(
                    F.col(f"`{turn}`").alias("turn"),
                    F.coalesce(F.col(f"`{role}`"), empty).alias("role"),
                    F.coalesce(F.col(f"`{text}`"), empty).alias("text"),
                )
            )
        ).alias("turns")
    )

    def formatted(t: Column) -> Column:
        head = F.concat(F.lit(BEGIN), F.replace(escaped(t.role), F.lit("\n"), F.lit(BREAK)), F.lit("\n"))
        body = escaped(t.text)
        learnt = t.role == learn
        return F.struct(
            F.concat(head, body, F.lit(END + "\n")).alias("segment"),
            F.when(learnt, F.length(head)).alias("loss_start"),
            F.when(learnt, F.length(body)).alias("loss_length"),
        )

    turns = once(turns, parts=F.transform("turns", formatted))
    # The digest of a turn covers all turns up to it, so it stands for a node of the tree.
    path = F.aggregate(
        "parts",
        F.array(F.unhex(F.lit(""))),
        lambda done, p: F.concat(done, F.array(_below(F.element_at(done, -1), p.segment))),
    )
    places = F.aggregate(
        "parts",
        F.array(F.lit(0).cast("long")),
        lambda done, p: F.concat(done, F.array(F.element_at(done, -1) + F.length(p.segment))),
    )
    turns = once(turns, path=path, places=places)
    turns = turns.withColumn("path", F.slice("path", 2, F.size("parts")))
    turns = turns.withColumn("leaf", F.element_at("path", -1))
    ends = stored(
        turns.select("conv_id", "leaf", F.size("parts").cast("long").alias("n_turns")), "chat-ends"
    )
    # Different conversations in order of their paths: those that begin alike stand together.
    different = turns.groupBy("leaf").agg(F.min(F.struct("path", "places", "parts")).alias("c")).select("leaf", "c.*")
    different = stored(
        different.repartitionByRange("path").sortWithinPartitions("path")
        .withColumn("rank", F.monotonically_increasing_id()),
        "chat-order",
    )
    steps = different.select("rank", "places", F.posexplode("path").alias("k", "node")).select(
        "rank", "k", "node", F.get("places", F.col("k")).alias("position"),
        (F.get("places", F.col("k") + 1) - F.get("places", F.col("k"))).alias("length"),
    )
    # The first conversation that a node is on writes it. It writes the end of its path in one run.
    first = F.min(F.struct("rank", "k", "position", "length")).alias("first")
    nodes = stored(steps.groupBy("node").agg(first).select("node", "first.*"), "chat-nodes")
    runs = nodes.groupBy("rank").agg(
        F.min("k").alias("from"), F.min("position").alias("shared"), F.sum("length").alias("length")
    )
    runs = stored(runs.withColumn("range", F.shiftright("rank", 33)), "chat-runs")
    earlier = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        runs.groupBy("range").agg(F.sum("length").alias("sum"))
        .select("range", F.coalesce(F.sum("sum").over(earlier), F.lit(0)).alias("offset"))
    )
    inside = Window.partitionBy("range").orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)
    runs = stored(
        runs.join(offsets, "range").select(
            "rank", "from", "shared",
            (F.col("offset") + F.coalesce(F.sum("length").over(inside), F.lit(0))).alias("run"),
        ),
        "chat-places",
    )
    placed = stored(
        nodes.join(runs, "rank").select(
            "node", F.col("rank").alias("writer"), "run",
            (F.col("run") + F.col("position") - F.col("shared")).alias("start"),
        ),
        "chat-placed",
    )
    visited = steps.select("rank", "k", "node", "length").join(placed, "node")
    spans = visited.groupBy("rank", "writer").agg(
        F.min("run").alias("start"), (F.min("run") + F.sum("length")).alias("end"),
        F.collect_list(F.struct("k", "start")).alias("steps"),
    )
    by_path = stored(
        spans.groupBy("rank").agg(
            F.array_sort(
                F.collect_list(F.when(F.col("writer") != F.col("rank"), F.struct("start", "end")))
            ).alias("above"),
            F.transform(F.array_sort(F.flatten(F.collect_list("steps"))), lambda s: s.start).alias("starts"),
        ),
        "chat-paths",
    )
    written = different.join(runs, "rank", "left").join(by_path, "rank")
    ways = stored(written.select("leaf", "starts"), "chat-ways")
    none = F.array().cast("array<struct<start: bigint, end: bigint>>")
    own = F.struct(F.col("run").alias("start"), F.col("start").alias("end"))
    tree = (
        written.where(F.col("run").isNotNull())
        .select("run", "from", "path", "places", "starts", "above", F.posexplode("parts").alias("k", "part"))
        .where("k >= from")
        .withColumn("start", F.get("starts", F.col("k")))
        .select(
            F.get("path", F.col("k")).alias("node"),
            F.get("path", F.col("k") - 1).alias("parent"),
            (F.col("k") + 1).alias("depth"),
            "start",
            F.length("part.segment").cast("long").alias("length"),
            F.get("places", F.col("k")).alias("position"),
            "part.segment", "part.loss_start", "part.loss_length",
            F.concat("above", F.when(F.col("start") > F.col("run"), F.array(own)).otherwise(none)).alias("ancestors"),
        )
    )
    return stored(tree, "chat-tree"), ends.join(ways, "leaf").select("conv_id", "leaf", "n_turns", "starts")


def _below(node: Column, segment: Column) -> Column:
    """The digest of the node that a turn leads to from another."""
    return F.unhex(F.substring(F.sha2(F.concat(F.hex(node), segment), 256), 1, 2 * _DIGEST))


def read_back(nodes: DataFrame, leaves: DataFrame) -> DataFrame:
    """The different conversations from the tree: ``leaf``, ``formatted``, ``turns`` and ``learnt``.

    The turns come from parsing the formatted text, the learnt texts from the loss parts.
    Conversations that are equal end in one leaf, which is read once.
    """
    ways = leaves.groupBy("leaf").agg(F.min("starts").alias("starts"))
    wanted = ways.select("leaf", F.explode("starts").alias("at"))
    pieces = nodes.select(
        F.col("start").alias("at"), F.struct("position", "segment", "loss_start", "loss_length").alias("piece")
    )
    texts = wanted.join(pieces, "at").groupBy("leaf").agg(F.array_sort(F.collect_list("piece")).alias("all"))
    texts = once(texts, formatted=F.array_join(F.transform("all", lambda p: p.segment), ""))
    learnt = F.transform(
        F.filter("all", lambda p: p.loss_start.isNotNull()),
        lambda p: unescaped(F.substring(p.segment, p.loss_start + 1, p.loss_length)),
    )
    pieces_of = F.filter(F.split("formatted", r"<\|im_end\|>\n"), lambda t: t != "")
    return texts.select("leaf", "formatted", F.transform(pieces_of, _parsed).alias("turns"), learnt.alias("learnt"))


def _parsed(piece: Column) -> Column:
    line = F.substring_index(piece, "\n", 1)
    role = F.substring(line, F.lit(len(BEGIN) + 1), F.length(line))
    return F.struct(
        unescaped(F.replace(role, F.lit(BREAK), F.lit("\n"))).alias("role"),
        unescaped(F.substring(piece, F.length(line) + 2, F.length(piece))).alias("text"),
    )


def digests(read: DataFrame, leaves: DataFrame) -> DataFrame:
    """What was read back, as counts and SHA-256 digests of each conversation."""
    whole = F.array_join(F.transform("turns", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n"))), "")
    learnt = F.array_join("learnt", "")
    by_leaf = stored(
        read.select(
            "leaf",
            F.size("turns").cast("long").alias("n_turns"),
            F.sha2(whole, 256).alias("turns_sha256"),
            F.length(learnt).cast("long").alias("loss_chars"),
            F.sha2(learnt, 256).alias("loss_sha256"),
            F.length("formatted").cast("long").alias("formatted_chars"),
        ),
        "chat-digests",
    )
    return leaves.select("conv_id", "leaf").join(by_leaf, "leaf").drop("leaf")
