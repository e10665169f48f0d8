"""Conversations in reply order, linked by their quotations.

Quote marks at the start of a line give its level; neighbouring lines of one
level are a passage. Passages, and their longer lines, are normalised and hashed
and meet the hashes of the messages' own texts and lines. A message replies to
the original of its outermost quote, else to the turn before it. Threads follow
from pointer doubling: each round every message learns of its ancestor twice as
far up, so the rounds grow with the logarithm of a thread's depth.

Both sides of every join have unique keys (the first message with a hash, in its
conversation and in all), so no common line multiplies. DataFrame functions only.

Defined results: null text counts as empty; a message whose own text is empty
stays with text ""; null conv_id or turn gives a thread of its own; repeated
(conv_id, turn) share a thread and keep their own texts; a quote links to earlier
messages alone (by conv_id, then turn), so there are no cycles; of equal originals
the first counts; texts are read whole, in time proportional to their length; other
columns of the input, whatever their names, are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from landgrid.llm.common import table, written
from landgrid.llm.licenses import let

MARKS = r"^(?:[ \t]*>)+"
#: A line that announces a quotation, as mail programs write it.
ANNOUNCES = r"(?i)^[^>].*(wrote|writes|schrieb|a écrit|escribió)[^\p{L}]*:[ \t]*$"
#: Shorter lines say too little to link by.
LEAST_LINE = 12
PASSAGES = "array<struct<level:int,text:string>>"


def level(line: Column) -> Column:
    return F.char_length(F.regexp_replace(F.regexp_extract(line, MARKS, 0), "[^>]", ""))


def normal(text: Column) -> Column:
    """Words alone, in lower case: what quoting programs leave as it was."""
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))


def own_text(lines: Column) -> Column:
    """The lines that are no quotes and announce none."""
    after = lambda i: F.coalesce(F.get(lines, i + 1), F.lit(""))
    return F.trim(F.array_join(F.filter(lines, lambda x, i: (level(x) == 0) & ~(x.rlike(ANNOUNCES) & (level(after(i)) > 0))), "\n"))


def passages(lines: Column) -> Column:
    """Runs of lines of one quote level above 0, without their marks; each line is looked at once."""
    body = lambda x: F.regexp_replace(x, MARKS + r"[ \t]?", "")

    def runs(levels: Column) -> Column:
        begins = F.filter(F.sequence(F.lit(0), F.size(lines) - 1), lambda i: (i == 0) | (F.get(levels, i) != F.get(levels, i - 1)))

        def cut(starts: Column) -> Column:
            end = lambda k: F.coalesce(F.get(starts, k + 1), F.size(lines))
            of = lambda i, k: F.struct(F.get(levels, i).alias("level"), F.array_join(F.transform(F.slice(lines, i + 1, end(k) - i), body), "\n").alias("text"))
            return F.filter(F.transform(starts, of), lambda p: p["level"] > 0)

        return let(begins, cut)

    return let(F.transform(lines, level), runs).cast(PASSAGES)


def hashes(text: Column) -> Column:
    """(whole, hash) of a text and of its longer lines."""
    lines = F.filter(F.transform(F.split(text, "\n"), normal), lambda x: F.char_length(x) >= LEAST_LINE)
    whole = F.filter(F.array(normal(text)), lambda x: x != "")
    one = lambda flag: lambda x: F.struct(F.lit(flag).alias("whole"), F.sha2(x, 256).alias("hash"))
    return F.array_distinct(F.concat(F.transform(whole, one(1)), F.transform(lines, one(0))))


def parsed(messages: DataFrame) -> DataFrame:
    """conv_id, turn, role, text without quotes, passages."""
    text = F.coalesce("text", F.lit(""))
    lines = F.split(text, "\n")
    quotes = F.contains(text, F.lit(">"))
    return messages.select(
        "conv_id",
        "turn",
        "role",
        F.when(quotes, let(lines, own_text)).otherwise(F.trim(text)).alias("text"),
        F.when(quotes, let(lines, passages)).otherwise(F.array().cast(PASSAGES)).alias("passages"),
    )


def links(rows: DataFrame) -> DataFrame:
    """For rows that quote an earlier message: conv_id, turn, to_conv, to_turn; one row a message."""
    quoting = rows.where(F.size("passages") > 0).select("conv_id", "turn", F.posexplode("passages").alias("_at", "_p"))
    quoted = quoting.select("conv_id", "turn", "_at", F.col("_p.level").alias("level"), F.inline(hashes(F.col("_p.text"))))
    index = rows.select("conv_id", "turn", F.inline(hashes(F.col("text")))).where("conv_id is not null and turn is not null")
    index = index.join(quoted.select("whole", "hash").distinct(), ["whole", "hash"], "left_semi")
    near = index.groupBy("whole", "hash", "conv_id").agg(F.min("turn").alias("_turn"))
    far = near.groupBy("whole", "hash").agg(F.min(F.struct(F.col("conv_id").alias("c"), F.col("_turn").alias("t"))).alias("_far"))
    met = quoted.join(near, ["whole", "hash", "conv_id"], "left").join(far, ["whole", "hash"], "left")
    own = F.col("_turn") < F.col("turn")
    other = (F.col("_far.c") < F.col("conv_id")) | ((F.col("_far.c") == F.col("conv_id")) & (F.col("_far.t") < F.col("turn")))
    met = met.where(own | other).withColumn("_own", F.coalesce(own, F.lit(False)).cast("int"))
    best = F.struct(
        "level",
        (-F.col("whole")).alias("w"),
        (-F.col("_own")).alias("o"),
        "_at",
        F.when(F.col("_own") == 1, F.col("conv_id")).otherwise(F.col("_far.c")).alias("to_conv"),
        F.when(F.col("_own") == 1, F.col("_turn")).otherwise(F.col("_far.t")).alias("to_turn"),
    )
    return met.groupBy("conv_id", "turn").agg(F.min(best).alias("b")).select("conv_id", "turn", "b.to_conv", "b.to_turn")


def threads(keys: DataFrame, found: DataFrame) -> DataFrame:
    """conv_id, turn, reply_conv, reply_turn, thread_conv, thread_turn, depth of each different (conv_id, turn)."""
    keys = keys.where("conv_id is not null and turn is not null").select("conv_id", "turn").distinct()
    before = keys.select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("turn").alias("_before"))
    parents = keys.join(found, ["conv_id", "turn"], "left").join(before, ["conv_id", "turn"], "left")
    linked = F.col("to_turn").isNotNull()
    parents = parents.select(
        "conv_id",
        "turn",
        F.when(linked, F.col("to_conv")).when(F.col("_before").isNotNull(), F.col("conv_id")).alias("reply_conv"),
        F.when(linked, F.col("to_turn")).otherwise(F.col("_before")).alias("reply_turn"),
    )
    parents = written(parents, "replies")
    root = F.col("reply_turn").isNull()
    columns = ["conv_id", "turn", "reply_conv", "reply_turn", "up_conv", "up_turn", "depth"]
    state = parents.select(*columns[:4], F.coalesce("reply_conv", "conv_id").alias("up_conv"), F.coalesce("reply_turn", "turn").alias("up_turn"), F.when(root, 0).otherwise(1).cast("long").alias("depth"))
    placed, rest = state.where(root), state.where(~root)
    while rest.limit(1).count():
        # Only messages that don't know their root yet move on; what they meet is the state of all.
        far = rest.withColumn("_done", F.lit(False)).unionByName(placed.withColumn("_done", F.lit(True)))
        far = far.select(F.col("conv_id").alias("up_conv"), F.col("turn").alias("up_turn"), F.col("up_conv").alias("_c"), F.col("up_turn").alias("_t"), F.col("depth").alias("_d"), "_done")
        moved = rest.join(far, ["up_conv", "up_turn"]).select(*columns[:4], F.col("_c").alias("up_conv"), F.col("_t").alias("up_turn"), (F.col("depth") + F.col("_d")).alias("depth"), "_done")
        moved = written(moved, "threads")
        placed, rest = placed.unionByName(moved.where("_done").drop("_done")), moved.where("not _done").drop("_done")
    return placed.select(*columns[:4], F.col("up_conv").alias("thread_conv"), F.col("up_turn").alias("thread_turn"), "depth")


def link_quotations(messages: DataFrame) -> DataFrame:
    """Each message without its quotes, with the message it replies to and its place in its thread.

    A thread reads in order of depth, conv_id, turn: every message after the one it replies to.
    """
    rows = written(parsed(messages), "messages")
    placed = threads(rows, links(rows))
    return rows.join(placed, ["conv_id", "turn"], "left").select(
        "conv_id",
        "turn",
        "role",
        "text",
        F.size("passages").cast("long").alias("n_quotes"),
        F.coalesce(F.array_max(F.transform("passages", lambda p: p["level"])), F.lit(0)).cast("long").alias("quote_depth"),
        "reply_conv",
        "reply_turn",
        "thread_conv",
        "thread_turn",
        F.coalesce("depth", F.lit(0)).cast("long").alias("depth"),
    )


def chats(linked: DataFrame, turns: int = 64, empty: bool = False) -> DataFrame:
    """Reply-ordered conversations as (thread_conv, thread_turn, part, messages<role, text>).

    Parts follow each other in order and hold ``turns`` messages or so, whether a thread is deep or broad: a level
    of depth starts in the part that the number of messages above it gives, and one with more messages than a part
    holds is dealt by hash over as many parts as it needs. Messages without a whole key are conversations of their
    own. ``empty`` keeps messages that only quote or say nothing.
    """
    thread = ["thread_conv", "thread_turn"]
    item = F.struct("depth", "conv_id", "turn", "role", "text")
    rows = linked if empty else linked.where("text <> ''")
    keyed = F.col("thread_conv").isNotNull() & F.col("thread_turn").isNotNull()
    whole = rows.where(keyed)
    levels = whole.groupBy(*thread, "depth").agg(F.count("*").alias("_n"))
    above = Window.partitionBy(*thread).orderBy("depth").rowsBetween(Window.unboundedPreceding, -1)
    levels = levels.select(*thread, "depth", F.floor(F.coalesce(F.sum("_n").over(above), F.lit(0)) / turns).alias("_first"), F.ceil(F.col("_n") / turns).alias("_parts"))
    dealt = F.pmod(F.xxhash64("conv_id", "turn"), F.col("_parts"))
    placed = whole.join(levels, [*thread, "depth"]).withColumn("part", (F.col("_first") + dealt).cast("long"))
    grouped = placed.groupBy(*thread, "part").agg(F.sort_array(F.collect_list(item)).alias("_m"))
    grouped = grouped.unionByName(rows.where(~keyed).select(*thread, F.lit(0).cast("long").alias("part"), F.array(item).alias("_m")))
    return grouped.select(*thread, "part", F.transform("_m", lambda m: F.struct(m["role"].alias("role"), m["text"].alias("text"))).alias("messages"))


def chat_threads(spark, sf_dir: str) -> DataFrame:
    """The conversations of ``conversations`` without quotes, in reply order."""
    return chats(link_quotations(table(spark, sf_dir, "conversations")), empty=True)


def op9_quotations(spark, sf_dir: str) -> DataFrame:
    """Every row of ``conversations`` without quotes, thread by thread in reply order."""
    return link_quotations(table(spark, sf_dir, "conversations")).orderBy("thread_conv", "thread_turn", "depth", "conv_id", "turn")


ORACLE = r"""
with recursive lines as (
  select conv_id, turn, role, i, l, length(regexp_replace(regexp_extract(l, '^(?:[ \t]*>)+'), '[^>]', '', 'g')) lv
  from (select conv_id, turn, role, unnest(string_split(coalesce(text, ''), chr(10))) l, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) i from conversations)
), marked as (
  select *, coalesce(lead(lv) over w, 0) nlv, case when lv = coalesce(lag(lv) over w, -1) then 0 else 1 end edge
  from lines window w as (partition by conv_id, turn order by i)
), runs as (select *, sum(edge) over (partition by conv_id, turn order by i) run from marked),
own as (
  select conv_id, turn, any_value(role) as role,
    trim(coalesce(string_agg(l, chr(10) order by i) filter (lv = 0 and not (regexp_matches(l, '(?i)^[^>].*(wrote|writes|schrieb|a écrit|escribió)[^\p{L}]*:[ \t]*$') and nlv > 0)), ''), ' ') as text
  from runs group by conv_id, turn
), passage as (
  select conv_id, turn, run as pos, lv as level, string_agg(regexp_replace(l, '^(?:[ \t]*>)+[ \t]?', ''), chr(10) order by i) text from runs where lv > 0 group by all
), counted as (select conv_id, turn, count(*) n, max(level) d from passage group by all),
quoted as (
  select conv_id, turn, pos, level, 1 whole, trim(regexp_replace(lower(text), '[^\p{L}\p{N}]+', ' ', 'g')) h from passage
  union all select conv_id, turn, pos, level, 0, trim(regexp_replace(lower(x), '[^\p{L}\p{N}]+', ' ', 'g')) from (select *, unnest(string_split(text, chr(10))) x from passage)
), original as (
  select conv_id, turn, 1 whole, trim(regexp_replace(lower(text), '[^\p{L}\p{N}]+', ' ', 'g')) h from own
  union all select conv_id, turn, 0, trim(regexp_replace(lower(x), '[^\p{L}\p{N}]+', ' ', 'g')) from (select conv_id, turn, unnest(string_split(text, chr(10))) x from own)
), met as (
  select q.conv_id, q.turn, level, q.whole, pos, o.conv_id c, o.turn t, (o.conv_id = q.conv_id)::int same
  from quoted q join original o on q.h = o.h and q.whole = o.whole and (length(q.h) >= 12 or (q.whole = 1 and q.h <> ''))
  where o.conv_id < q.conv_id or (o.conv_id = q.conv_id and o.turn < q.turn)
), link as (
  select * from met qualify row_number() over (partition by conv_id, turn order by level, whole desc, same desc, pos, c, t) = 1
), parent as (
  select o.conv_id, o.turn, coalesce(l.c, p.conv_id) reply_conv, coalesce(l.t, p.turn) reply_turn
  from own o left join link l using (conv_id, turn) left join own p on p.conv_id = o.conv_id and p.turn = o.turn - 1
), tree as (
  select conv_id, turn, conv_id thread_conv, turn thread_turn, 0 depth from parent where reply_turn is null
  union all select p.conv_id, p.turn, t.thread_conv, t.thread_turn, t.depth + 1 from parent p join tree t on p.reply_conv = t.conv_id and p.reply_turn = t.turn
)
select o.conv_id, o.turn, o.role, o.text, coalesce(n, 0)::bigint n_quotes, coalesce(d, 0)::bigint quote_depth,
  reply_conv, reply_turn, thread_conv, thread_turn, depth::bigint depth
from own o join parent using (conv_id, turn) join tree using (conv_id, turn) left join counted using (conv_id, turn)
"""
