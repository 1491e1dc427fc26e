"""Quotation linking of chats, with DataFrame functions only.

Lines that begin with ``>`` marks quote: as many marks, so many levels.  Runs of lines of
one level are passages; their normalised digests are joined to those of the messages' own
texts, whole or by line; a passage of several lines that is no whole text is looked up line
by line, and comes from the message with most of its lines.  A message answers the message its outermost quotes come
from, and conversations are put in reply order without the quotes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from metaspark.functions.text import with_once
from metaspark.session import cut_lineage

MARKS = r"^(?:[ \t]?>)+"


def plain(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), r"\s+", " "))


def digest(text: Column) -> Column:
    """Digest of a passage in lower case with single spaces; null if nothing is left."""
    return F.when(plain(text) != "", F.md5(plain(text)))


def line_digests(text: Column) -> Column:
    """Distinct 64-bit digests of a passage's lines that are not blank."""
    return F.array_distinct(F.transform(F.filter(F.transform(F.split(text, "\n"), plain), lambda x: x != ""), lambda x: F.xxhash64(x)))


def parsed(messages: DataFrame) -> DataFrame:
    """``messages`` with ``_runs``: (level, body) of each run of lines of one quote level, in order.

    A null text has no runs.
    """
    lines = F.transform(
        F.split(F.coalesce(F.col("text").cast("string"), F.lit("")), "\n"),
        lambda line: F.struct(
            F.length(F.regexp_replace(F.regexp_extract(line, MARKS, 0), "[^>]", "")).alias("level"),
            F.regexp_replace(line, MARKS + " ?", "").alias("body"),
        ),
    )
    # each step is a column computed once a row: lambdas would compute it again an element
    rows = with_once(messages, "_lines", lines)
    level = lambda i: F.element_at("_lines", i).getField("level")
    first = F.filter(F.sequence(F.lit(1), F.size("_lines")), lambda i: (i == 1) | (level(i) != level(F.greatest(i - 1, F.lit(1)))))
    rows = with_once(rows, "_first", first)
    until = lambda k: F.coalesce(F.get("_first", k + 1), F.size("_lines") + 1)
    runs = F.transform(
        "_first",
        lambda i, k: F.struct(
            level(i).alias("level"),
            F.array_join(F.transform(F.slice("_lines", i, until(k) - i), lambda x: x["body"]), "\n").alias("body"),
        ),
    )
    none = F.array().cast("array<struct<level:int,body:string>>")
    return with_once(rows, "_runs", F.when(F.col("text").isNotNull(), runs).otherwise(none)).drop("_lines", "_first")


def partly(asked: DataFrame, facts: DataFrame) -> DataFrame:
    """``_c``, ``_t``, ``run``, ``level``, ``origin`` of quoted runs found by their lines.

    ``origin`` is the earlier message that holds the most of a run's distinct lines, more
    than half of them; of several the earliest.  A message that holds more than half lacks
    fewer than half, so it has one of any half of the lines: only the rarest half of a run's
    lines is joined to messages.  Equal runs of a conversation are looked up once, in the
    earliest message of each text.
    """
    runs = asked.groupBy("_c", "hash").agg(F.max("_t").alias("_last"), F.first("lines").alias("lines"))
    lines = runs.select("_c", "hash", "_last", F.size("lines").alias("k"), F.explode("lines").alias("line"))
    texts = facts.filter(F.size("own_lines") > 0).groupBy("_c", "own_lines").agg(F.min("_t").alias("origin"))
    held = texts.select("_c", "origin", F.explode("own_lines").alias("line"))
    holders = held.groupBy("_c", "line").agg(F.count("*").alias("n"), F.min("origin").alias("first"))
    known = lines.join(holders, ["_c", "line"]).filter(F.col("first") < F.col("_last"))
    known = known.groupBy("_c", "hash", "_last", "k").agg(F.sort_array(F.collect_list(F.struct("n", "line"))).alias("found"))
    known = known.filter(F.size("found") * 2 > F.col("k"))
    # lines no earlier message holds are the rarest; what is left of the half comes from the others
    rare = F.slice("found", 1, F.floor((F.size("found") * 2 - F.col("k") + 1) / 2).cast("int"))
    wanted = known.select("_c", "hash", "_last", F.explode(rare).alias("r")).select("_c", "hash", "_last", "r.line")
    pairs = wanted.join(held, ["_c", "line"]).filter(F.col("origin") < F.col("_last")).select("_c", "hash", "origin").distinct()
    both = pairs.join(runs.select("_c", "hash", "lines"), ["_c", "hash"]).join(texts, ["_c", "origin"])
    both = both.select("_c", "hash", "origin", F.size("lines").alias("k"), F.size(F.array_intersect("lines", "own_lines")).alias("n"))
    best = both.filter(F.col("n") * 2 > F.col("k")).groupBy("_c", "hash", "n").agg(F.min("origin").alias("origin"))
    found = asked.join(best, ["_c", "hash"]).filter("origin < _t")
    found = found.groupBy("_c", "_t", "run", "level").agg(F.min(F.struct(-F.col("n"), "origin")).getField("origin").alias("origin"))
    return found.select("_c", "_t", "run", "level", "origin")


def link(messages: DataFrame, conversation: str = "conv_id", turn: str = "turn") -> DataFrame:
    """``messages`` with their place in the replies, and without quotes in ``text``.

    Adds ``reply_turn`` (the message answered: where the outermost, then first quoted
    passage found comes from; else the turn before; null for a first one), ``quotes`` and
    ``linked`` (passages quoted and found), ``root_turn``, ``reply_depth`` and ``position``
    (from 0, every message after the one it answers).  A passage comes from the earliest
    message of the conversation with it, if that is earlier; where none has it as its text or
    as a line, from the earlier message with the most of its lines, if that is more than
    half.  Columns of these names, and
    names with a leading underscore used here, are replaced.  Rows with a null
    conversation or turn, and rows repeating a turn, stay: the former are on their own,
    the latter share their links.
    """
    made = ("reply_turn", "quotes", "linked", "root_turn", "reply_depth", "position", "_runs", "_lines", "_first", "_own", "_c", "_t")
    base = messages.drop(*made)
    key = [F.col(conversation).alias("_c"), F.col(turn).alias("_t")]
    rows = parsed(base)
    own = F.array_join(F.transform(F.filter("_runs", lambda r: r["level"] == 0), lambda r: r["body"]), "\n")
    rows = with_once(rows, "_own", F.trim(own))
    quoted = F.filter("_runs", lambda r: (r["level"] > 0) & (F.trim(r["body"]) != ""))
    facts = rows.select(
        *key,
        F.transform(
            quoted,
            lambda r: F.struct(r["level"].alias("level"), digest(r["body"]).alias("hash"), line_digests(r["body"]).alias("lines")),
        ).alias("quoted"),
        line_digests(F.col("_own")).alias("own_lines"),
        F.array_distinct(
            F.concat(F.array(digest(F.col("_own"))), F.transform(F.split("_own", "\n"), digest))
        ).alias("sources"),
    ).filter("_c IS NOT NULL AND _t IS NOT NULL")
    asked = facts.select("_c", "_t", F.posexplode("quoted").alias("run", "q")).select(
        "_c", "_t", "run", "q.level", "q.hash", "q.lines"
    )
    origins = facts.select("_c", "_t", F.explode("sources").alias("hash")).filter("hash IS NOT NULL")
    origins = origins.groupBy("_c", "hash").agg(F.min("_t").alias("origin"))
    placed_runs = asked.join(origins, ["_c", "hash"], "left").withColumn("whole", F.coalesce(F.col("origin") < F.col("_t"), F.lit(False)))
    found = placed_runs.filter("whole").select("_c", "_t", "run", "level", "origin")
    name = F.md5(F.array_join("lines", ",")).alias("hash")  # texts that differ in their line breaks have one hash, but not the same lines
    cut = placed_runs.filter(~F.col("whole") & (F.size("lines") > 1)).select("_c", "_t", "run", "level", name, "lines")
    cut = cut_lineage(cut)
    if not cut.isEmpty():
        found = found.unionByName(partly(cut, facts))
    best = found.groupBy("_c", "_t").agg(
        F.min(F.struct("level", "run", "origin")).getField("origin").alias("_origin"),
        F.count_distinct("run").alias("linked"),
    )
    turns = facts.groupBy("_c", "_t").agg(F.max(F.size("quoted")).alias("quotes"))
    before = F.lag("_t").over(W.partitionBy("_c").orderBy("_t"))
    parents = turns.withColumn("_before", before).join(best, ["_c", "_t"], "left").select(
        "_c", "_t", "quotes", F.coalesce("linked", F.lit(0)).alias("linked"),
        F.coalesce("_origin", "_before").alias("reply_turn"),
    )
    tree = cut_lineage(
        parents.withColumn("_up", F.coalesce("reply_turn", "_t")).withColumn("reply_depth", (F.col("_up") != F.col("_t")).cast("int"))
    )
    placed_rows, moving = tree.filter("_up = _t"), tree.filter("_up <> _t")
    while True:  # each round doubles how far up the messages see that have not seen a first one yet
        known = placed_rows.unionByName(moving)
        above = known.select("_c", F.col("_t").alias("_up"), F.col("_up").alias("_higher"), F.col("reply_depth").alias("_more"))
        joined = moving.join(above, ["_c", "_up"]).withColumn("_moved", F.col("_higher") != F.col("_up"))
        stepped = cut_lineage(
            joined.withColumn("_up", F.col("_higher"))
            .withColumn("reply_depth", F.col("reply_depth") + F.col("_more"))
            .drop("_higher", "_more")
        )
        placed_rows = placed_rows.unionByName(stepped.filter("NOT _moved").drop("_moved"))
        moving = stepped.filter("_moved").drop("_moved")
        if moving.isEmpty():
            break
    tree = placed_rows
    order = W.partitionBy("_c").orderBy("_up", "_t")
    placed = tree.withColumn("position", (F.row_number().over(order) - 1).cast("long"))
    placed = placed.select("_c", "_t", "reply_turn", "quotes", "linked", F.col("_up").alias("root_turn"), "reply_depth", "position")
    unquoted = rows.withColumn("text", F.when(F.col("text").isNotNull(), F.col("_own"))).drop("_runs", "_own")
    match = (unquoted[conversation] == placed["_c"]) & (unquoted[turn] == placed["_t"])
    return unquoted.join(placed, match, "left").drop("_c", "_t")


def quoting(messages: DataFrame, levels: int = 2, conversation: str = "conv_id", turn: str = "turn") -> DataFrame:
    """``messages`` as a mail program writes them: the texts of the ``levels`` turns before, quoted, above each."""
    order = W.partitionBy(conversation).orderBy(turn, "text")
    parts = [
        F.regexp_replace(F.lag("text", back).over(order), "(?m)^", ">" * back + " ") for back in range(levels, 0, -1)
    ]
    return messages.withColumn("text", F.when(F.col("text").isNotNull(), F.concat_ws("\n", *parts, F.col("text"))))
