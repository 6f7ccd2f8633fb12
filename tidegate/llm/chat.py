"""Chat formatting by quotation linking.

Lines that begin with quote marks are quoted; the number of marks is the level. Lines of one
level that follow each other are a passage: a run of words, wherever its lines break. The
lines of level 0 are what the message itself says. Lines that only announce a quotation
("On ... wrote:" before a line of a higher level) belong to neither.

Passages of every level are normalised - lower case, letters and digits only - and hashed
in windows of WINDOW words; a shorter passage is one window. Messages are hashed likewise
by what they say themselves, and by their lines of fewer than WINDOW words. Each window is
joined to the latest earlier message of its conversation that says it, so a nested quote
leads to its original, not to a message that quotes it. A passage is linked to the
message that says most of its windows, the later one if several do. A message replies to
the one with most linked windows in the lowest level that has links, the later one if
several have, else to the message before it.

The first reply to a message continues its branch, any other opens a branch, named by its
turn. A conversation is ordered by branch, then turn: so every message comes after the one
it replies to, and a branch is a dialogue without quotes. Within runs of messages that
reply to the one before them the branch is a running maximum; only what links runs is
followed, by doubling steps.

Running maxima and positions are computed in two steps, in blocks of BLOCK turns and over
the blocks, so that a conversation with a third of all messages, or a window that all
messages share, fills many tasks. A row is a message: conversations are never gathered. A
message's words are held whole, some 50 bytes for each.

Defined results: null and empty texts say nothing, and quote nothing; messages that repeat
conv_id and turn are put in the order of role and text, nulls first, and count as one
message when they are replied to and when they quote; a null conv_id is a conversation, a
null turn comes first in it; other columns are left alone; an empty table gives none.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidegate.session import settle

BLOCK = 256
WINDOW = 5
MARKS = r"^\s*(>\s?)+"
ANNOUNCES = r"(?i)^\s*(on\b.*\bwrote|.*\bschrieb|.*\ba écrit|.*\bescribió)\s*:\s*$"
FIRST = -(1 << 62)  # stands for a null turn
PASSAGE = ["conv", "no", "level", "passage"]


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use` of a value that is computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def words(text: Column) -> Column:
    plain = F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))
    return F.when(plain == "", F.array().cast("array<string>")).otherwise(F.split(plain, " "))


def windows(run: Column) -> Column:
    """64 bits of each window of a run of words; of the run itself if it is shorter."""

    def window(i: Column) -> Column:  # words beyond the end are null and left out
        return F.xxhash64(F.concat_ws(" ", *[F.get(run, i + j) for j in range(WINDOW)]))

    hashed = F.transform(F.sequence(F.lit(0), F.greatest(F.size(run) - WINDOW, F.lit(0))), window)
    return F.when(F.size(run) > 0, hashed).otherwise(F.array().cast("array<bigint>"))


def parsed_lines(text: Column) -> Column:
    """Text without marks, level, and whether the line announces a quotation."""
    raw = F.transform(
        F.split(F.coalesce(text, F.lit("")), "\r?\n", -1),
        lambda line: F.struct(
            F.regexp_replace(line, MARKS, "").alias("text"),
            F.length(F.regexp_replace(F.regexp_extract(line, MARKS, 0), r"\s", "")).alias("level"),
        ),
    )

    def marked(lines: Column) -> Column:
        def announces(line: Column, i: Column) -> Column:
            return (F.coalesce(F.get(lines, i + 1)["level"], F.lit(0)) > line["level"]) & line["text"].rlike(ANNOUNCES)

        return F.transform(
            lines, lambda line, i: F.struct(line["text"].alias("text"), line["level"].alias("level"), announces(line, i).alias("announces"))
        )

    return let(raw, marked)


def passages(lines: Column) -> Column:
    """Level and words of the quoted passages that have words."""

    def run(starts: Column) -> Column:
        def passage(start: Column, k: Column) -> Column:
            stop = F.coalesce(F.get(starts, k + 1), F.size(lines))
            own = F.transform(F.sequence(start, stop - 1), lambda i: F.get(lines, i))
            said = F.filter(own, lambda line: ~line["announces"])
            return F.struct(
                F.get(lines, start)["level"].alias("level"),
                F.flatten(F.transform(said, lambda line: words(line["text"]))).alias("words"),
            )

        return F.transform(starts, passage)

    changes = F.filter(
        F.sequence(F.lit(0), F.size(lines) - 1),
        lambda i: (i == 0) | (F.get(lines, i)["level"] != F.get(lines, i - 1)["level"]),
    )
    quoted = F.filter(let(changes, run), lambda p: (p["level"] > 0) & (F.size(p["words"]) > 0))
    return F.when(F.exists(lines, lambda line: line["level"] > 0), quoted)


def parsed(conversations: DataFrame) -> DataFrame:
    """Messages with what they say (content, own words, short lines) and quote (passages)."""
    rows = conversations.select(
        F.struct("conv_id").alias("conv"), F.coalesce(F.col("turn").cast("bigint"), F.lit(FIRST)).alias("no"),
        "role", "text", F.explode(F.array(parsed_lines(F.col("text")))).alias("lines"),
    )
    said = F.transform(
        F.filter("lines", lambda line: (line["level"] == 0) & ~line["announces"]), lambda line: line["text"]
    )
    return rows.select("conv", "no", "role", "text", said.alias("said"), passages(F.col("lines")).alias("passages"))


def running_last(rows: DataFrame, keys: list[str], what: Column, until: int, name: str) -> DataFrame:
    """`rows` with the largest `what` of the rows of their keys whose `no` is at most theirs plus `until`."""
    rows = rows.withColumn("block", F.expr(f"no div {BLOCK}")).withColumn("what", what)
    inside = Window.partitionBy(*keys, "block").orderBy("no").rangeBetween(Window.unboundedPreceding, until)
    earlier = Window.partitionBy(*keys).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = rows.groupBy(*keys, "block").agg(F.max("what").alias("last"))
    blocks = blocks.select(*keys, "block", F.max("last").over(earlier).alias("before"))
    found = rows.withColumn("near", F.max("what").over(inside)).join(blocks, [*keys, "block"])
    return found.withColumn(name, F.coalesce("near", "before")).drop("block", "what", "near", "before")


def link(messages: DataFrame) -> DataFrame:
    """Per message with linked quotes: conv, no, n_linked, reply (a turn)."""

    def asked_by(p: Column) -> Column:
        """A row per window, made in one array: a later column of the passage would be computed for each."""

        def each(name: Column) -> Column:
            return F.transform(
                windows(p["words"]), lambda w: F.struct(p["level"].alias("level"), name.alias("passage"), w.alias("hash"))
            )

        return let(F.xxhash64(F.array_join(p["words"], " ")), each)

    asked = F.flatten(F.transform("passages", asked_by))
    quoted = messages.filter(F.size("passages") > 0).select("conv", "no", F.explode(asked).alias("q"))
    quotes = quoted.select("conv", "no", "q.level", "q.passage", "q.hash").distinct()
    quotes = settle(quotes, "quotes", compact=True)
    lines = F.transform("said", words)
    short = F.filter(lines, lambda line: F.size(line) < WINDOW)
    hashes = F.concat(let(F.flatten(lines), windows), F.flatten(F.transform(short, windows)))
    talks = messages.join(quotes.select("conv").distinct(), "conv", "left_semi")
    wanted = quotes.select("conv", "hash").distinct()
    sources = talks.select("conv", "no", F.explode(hashes).alias("hash")).distinct().join(wanted, ["conv", "hash"], "left_semi")
    asked = quotes.select("conv", "no", "hash").distinct()
    rows = asked.withColumn("said", F.lit(False)).unionByName(sources.withColumn("said", F.lit(True)))
    found = running_last(rows, ["conv", "hash"], F.when(F.col("said"), F.col("no")), -1, "source")
    found = found.filter("not said and source is not null").select("conv", "no", "hash", "source")
    votes = found.join(quotes, ["conv", "no", "hash"]).groupBy(*PASSAGE, "source").agg(F.count(F.lit(1)).alias("n"))
    linked = votes.groupBy(*PASSAGE).agg(F.max(F.struct("n", "source")).alias("best"))
    levels = linked.groupBy("conv", "no", "level", F.col("best")["source"].alias("source")).agg(
        F.sum(F.col("best")["n"]).alias("n"), F.count(F.lit(1)).alias("passages")
    )
    best = F.max(F.struct(-F.col("level"), "n", "source"))
    return levels.groupBy("conv", "no").agg(F.sum("passages").alias("n_linked"), best["source"].alias("reply"))


def branches(turns: DataFrame) -> DataFrame:
    """conv, no and branch of turns with conv, no, reply, previous."""
    first = turns.filter("reply is not null").groupBy("conv", "reply").agg(F.min("no").alias("no"))
    rows = turns.join(first.select("conv", "no", F.lit(True).alias("first")), ["conv", "no"], "left")
    rows = rows.withColumn("first", F.coalesce("first", F.lit(False)))
    rows = rows.withColumn("follows", F.col("first") & (F.col("reply") == F.col("previous")))
    start = F.when(~F.coalesce("follows", F.lit(False)), F.col("no"))
    runs = settle(running_last(rows, ["conv"], start, 0, "run"), "runs", compact=True)
    heads = runs.filter("first and run = no").select("conv", "run", F.col("reply").alias("at"))
    ends = runs.select("conv", F.col("no").alias("at"), F.col("run").alias("to"))
    steps = settle(heads.join(ends, ["conv", "at"]).select("conv", "run", "to"), "steps", compact=True)
    while True:
        further = steps.select("conv", F.col("run").alias("to"), F.col("to").alias("further"))
        moved = steps.join(further, ["conv", "to"], "left")
        if moved.filter("further is not null").isEmpty():
            break
        steps = settle(moved.select("conv", "run", F.coalesce("further", "to").alias("to")), "steps", compact=True)
    return runs.join(steps, ["conv", "run"], "left").select("conv", "no", F.coalesce("to", "run").alias("branch"))


def placed(messages: DataFrame) -> DataFrame:
    """`messages` with their position in the order of branch, no, role, text."""
    rows = messages.withColumn("block", F.expr(f"no div {BLOCK}"))
    inside = Window.partitionBy("conv", "branch", "block").orderBy("no", "role", "text")
    sizes = rows.groupBy("conv", "branch", "block").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("conv").orderBy("branch", "block").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("conv", "branch", "block", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("start"))
    numbered = rows.withColumn("place", F.row_number().over(inside)).join(starts, ["conv", "branch", "block"])
    return numbered.withColumn("position", (F.col("start") + F.col("place")).cast("bigint"))


def format_chats(conversations: DataFrame) -> DataFrame:
    """Per message: conv_id, turn, branch, position, role, reply_to, n_quoted, n_linked, content, formatted."""
    messages = settle(parsed(conversations), "messages", compact=True)
    turns = messages.select("conv", "no").distinct()
    turns = running_last(turns, ["conv"], F.col("no"), -1, "previous").join(link(messages), ["conv", "no"], "left")
    turns = turns.withColumn("reply", F.coalesce("reply", "previous"))
    turns = settle(turns, "turns", compact=True)
    rows = placed(messages.join(branches(turns), ["conv", "no"])).join(turns, ["conv", "no"])
    content = F.trim(F.array_join("said", "\n"))

    def shown(turn: str) -> Column:
        return F.when(F.col(turn) > FIRST, F.col(turn))

    return rows.withColumn("content", content).select(
        F.col("conv")["conv_id"].alias("conv_id"),
        shown("no").alias("turn"), shown("branch").alias("branch"), "position", "role", shown("reply").alias("reply_to"),
        F.greatest(F.size(F.coalesce("passages", F.array())), F.lit(0)).cast("bigint").alias("n_quoted"),
        F.coalesce("n_linked", F.lit(0)).cast("bigint").alias("n_linked"),
        "content",
        F.concat(F.lit("<|"), F.coalesce("role", F.lit("")), F.lit("|>\n"), F.col("content"), F.lit("\n<|end|>")).alias("formatted"),
    )
