"""Chat formatting by quotation linking: quoted passages find the messages they were taken from, and quotes go.

Lines that begin with '>' marks are quotes, of as many levels as there are marks; a line announcing a quote ("On ... wrote:")
right before a deeper line is no text of its own. Neighbouring lines of one level are a passage. Passages are compared in
lower case, with white space collapsed, by their MD5. What a message wrote itself can be quoted whole, by paragraphs (between
blank lines) or by single lines: it is listed under the hash of each.

A passage links to the latest earlier message of its conversation that wrote it (an as-of join in slices, so that a
conversation or passage with a third of all rows is many groups). A passage that no message wrote as such may be trimmed: it links
to the latest earlier message that wrote all of its lines, whatever stood between them. Each line asks for the latest message
that wrote it; if those differ, the earliest of them bounds the next round, until all lines meet in one. A message replies to the message that its outermost
passages link to, the latest of them; deeper ones are counted as links, not as parents. The result has each message's own
text, parent, root and depth: sorted by conversation, root and turn, it is the conversations in reply order.

Defined results: a NULL text has no quotes and no own text, and stays NULL. Empty passages link to nothing. A message without
linked quotes is a root. Rows with the same conversation, turn, role and text are one message; others with the same
conversation and turn share parents and quotes by turn. A NULL conversation or turn is kept, without links. Texts are read
whole. Other columns are not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caudal.llm.asof import latest_before
from caudal.llm.common import SPACES, stored

MARKS = r"^((?:[ \t]*>)+)"
ANNOUNCED = r"^On .+ wrote:$"
MAX_ROUNDS = 64


def normalised(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), SPACES, " "))


def quote(text: Column, marks: str = "> ") -> Column:
    """The text as a quote."""
    return F.concat(F.lit(marks), F.replace(text, F.lit("\n"), F.lit("\n" + marks)))


def passages(messages: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv_id, turn, role, source (hash of the text), passage (number), level, lines (array): in the order of the text."""
    rows = messages.select(F.col(conv).alias("conv_id"), F.col(turn).cast("bigint").alias("turn"), F.col(role).alias("role"), F.col(text).alias("text")).distinct()
    lines = rows.filter("text is not null").select("conv_id", "turn", "role", F.md5(F.col("text").cast("binary")).alias("source"), F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    marks = F.regexp_extract("line", MARKS, 1)
    levelled = lines.withColumn("level", F.length(F.replace(marks, F.lit(" "), F.lit(""))) - F.length(F.replace(F.replace(marks, F.lit(" "), F.lit("")), F.lit(">"), F.lit("")))).withColumn(
        "line", F.regexp_replace("line", MARKS + " ?", "")
    )
    message = Window.partitionBy("conv_id", "turn", "role", "source").orderBy("pos")
    deeper = F.lead("level").over(message) > F.col("level")
    own = levelled.withColumn("announces", F.coalesce(deeper & F.col("line").rlike(ANNOUNCED), F.lit(False))).filter("not announces")
    new = F.coalesce((F.lag("level").over(message) != F.col("level")).cast("int"), F.lit(0))
    numbered = own.withColumn("new", new).withColumn("passage", F.sum("new").over(message))
    grouped = numbered.groupBy("conv_id", "turn", "role", "source", "passage", "level").agg(F.sort_array(F.collect_list(F.struct("pos", "line"))).alias("lines"))
    return grouped.withColumn("lines", F.col("lines.line"))


def link_quotes(messages: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv_id, turn, role, own_text, n_quotes, n_linked, parent_turn, root_turn, depth: a row for each message."""
    found = stored(passages(messages, conv, turn, role, text), "passages")
    written = found.filter("level = 0")
    body = F.array_join("lines", "\n")
    pieces = F.array_distinct(F.concat(F.array(body), F.split(body, r"\n[ \t]*\n"), F.col("lines")))
    hashes = written.select("conv_id", "turn", F.explode(pieces).alias("piece")).select("conv_id", "turn", normalised(F.col("piece")).alias("piece")).filter("piece <> ''")
    origins = hashes.select("conv_id", "turn", F.md5(F.col("piece").cast("binary")).alias("hash"), F.struct(F.col("turn").alias("at")).alias("origin")).distinct()
    quoted = found.filter("level > 0").select("conv_id", "turn", "role", "source", "passage", "level", normalised(body).alias("piece"))
    quoted = quoted.withColumn("hash", F.when(F.col("piece") != "", F.md5(F.col("piece").cast("binary")))).drop("piece")
    whole = latest_before(quoted, origins, ["conv_id", "hash"], "turn", "origin").select(*quoted.columns, F.col("origin.at").alias("at"))
    whole = stored(whole.withColumn("q", F.monotonically_increasing_id()), "whole-passages")
    lines = found.filter("level > 0").select("conv_id", "turn", "role", "source", "passage", "lines")
    trimmed = _trimmed(whole.filter("at is null and hash is not null"), lines, origins)
    linked = whole.join(trimmed, "q", "left").withColumn("at", F.coalesce("at", "met")).drop("q", "met")
    replies = linked.groupBy("conv_id", "turn", "role", "source").agg(
        F.count(F.lit(1)).alias("n_quotes"), F.count("at").alias("n_linked"), F.min(F.when(F.col("at").isNotNull(), F.struct("level", (-F.col("at")).alias("back")))).alias("outer")
    )
    texts = written.groupBy("conv_id", "turn", "role", "source").agg(F.sort_array(F.collect_list(F.struct("passage", "lines"))).alias("all"))
    texts = texts.select("conv_id", "turn", "role", "source", F.regexp_replace(F.array_join(F.flatten("all.lines"), "\n"), r"^(?:[ \t]*\n)+|(?:\n[ \t]*)+$", "").alias("own_text"))
    every = messages.select(F.col(conv).alias("conv_id"), F.col(turn).cast("bigint").alias("turn"), F.col(role).alias("role"), F.md5(F.col(text).cast("binary")).alias("source")).distinct()
    same = lambda other: [every[c].eqNullSafe(other[c]) for c in ("conv_id", "turn", "role", "source")]
    known = every.join(texts, same(texts), "left").join(replies, same(replies), "left").select(
        *[every[c] for c in every.columns], F.when(every["source"].isNotNull(), F.coalesce("own_text", F.lit(""))).alias("own_text"),
        F.coalesce("n_quotes", F.lit(0)).alias("n_quotes"), F.coalesce("n_linked", F.lit(0)).alias("n_linked"), (-F.col("outer.back")).alias("parent_turn"),
    )
    known = stored(known, "linked-messages")
    roots = _roots(known.filter("conv_id is not null and turn is not null").groupBy("conv_id", "turn").agg(F.max("parent_turn").alias("up")))
    tree = roots.select("conv_id", "turn", F.col("up").alias("root_turn"), "depth")
    return known.join(tree, ["conv_id", "turn"], "left").select(
        "conv_id", "turn", "role", "own_text", "n_quotes", "n_linked", "parent_turn", F.coalesce("root_turn", "turn").alias("root_turn"), F.coalesce("depth", F.lit(0)).cast("bigint").alias("depth")
    )


def _trimmed(passages: DataFrame, lines: DataFrame, origins: DataFrame) -> DataFrame:
    """q, met: the latest earlier message that wrote all lines of a passage, for those that have one."""
    place = ["conv_id", "turn", "role", "source", "passage"]
    same = [passages[c].eqNullSafe(lines[c]) for c in place]
    each = passages.join(lines, same).select("q", passages["conv_id"], passages["turn"].alias("turn"), F.explode("lines").alias("line"))
    each = each.select("q", "conv_id", "turn", normalised(F.col("line")).alias("line")).filter("line <> ''")
    asked = stored(each.select("q", "conv_id", "turn", F.md5(F.col("line").cast("binary")).alias("hash")).distinct(), "quoted-lines")
    met = []
    while not asked.isEmpty():
        wrote = latest_before(asked, origins, ["conv_id", "hash"], "turn", "origin").select("q", F.col("origin.at").alias("at"))
        bounds = wrote.groupBy("q").agg(F.min("at").alias("low"), F.max("at").alias("high"), F.count_if(F.col("at").isNull()).alias("unknown"))
        bounds = stored(bounds.filter("unknown = 0"), "line-bounds")
        met.append(bounds.filter("low = high").select("q", F.col("low").alias("met")))
        apart = bounds.filter("low < high").select("q", (F.col("low") + 1).alias("before"))
        asked = stored(asked.join(apart, "q").select("q", "conv_id", F.col("before").alias("turn"), "hash"), "quoted-lines")
    none = passages.select("q", F.col("at").alias("met")).limit(0)
    return reduce(DataFrame.unionAll, met, none)


def _roots(parents: DataFrame) -> DataFrame:
    """conv_id, turn, up (root), depth, by doubling the way up in each round. Rounds move only what is not at its root yet."""
    names = ["conv_id", "turn", "up", "depth"]
    roots = parents.filter("up is null").select("conv_id", "turn", F.col("turn").alias("up"), F.lit(0).cast("bigint").alias("depth"))
    now = stored(parents.filter("up is not null").select("conv_id", "turn", "up", F.lit(1).cast("bigint").alias("depth"), F.lit(True).alias("on")), "replies")
    for _ in range(MAX_ROUNDS):
        if now.filter("on").isEmpty():
            return roots.unionAll(now.select(*names))
        above = now.select("conv_id", F.col("turn").alias("up"), F.col("up").alias("__up"), F.col("depth").alias("__depth"))
        moved = now.filter("on").join(above, ["conv_id", "up"], "left").select(
            "conv_id", "turn", F.coalesce("__up", "up").alias("up"), (F.col("depth") + F.coalesce("__depth", F.lit(0))).alias("depth"), F.col("__up").isNotNull().alias("on")
        )
        now = stored(now.filter("not on").unionAll(moved), "replies")
    raise RuntimeError("replies form no tree")
