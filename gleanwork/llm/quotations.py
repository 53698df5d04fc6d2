"""Quotation linking: conversations rebuilt from what messages quote.

Each line of a message has a quote level, the number of ``>`` it starts with. Consecutive lines of
one level up to a blank one are a passage; its normal form has no case and single blanks, so that a
quotation wrapped anew has the same one. Passages without marks are the message's own words.

A quoted passage is hashed and linked to the last earlier message that has it as a passage of its
own. One that no message has as a whole (a part of an original, or an edited one) is linked by its
word windows, to the message that at least half of them come from. A passage too short for a window
says little: it links only if a single earlier message has it. Inside the thread that those links
build, short passages count as found where an earlier message of it has them, as single lines too.
The message most of a reply's quotation comes from is its parent; following parents upward gives
the conversation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanwork.llm.asof import asof_join
from gleanwork.operators.ordering import running
from gleanwork.session import materialize

MARKS = r"^(?:\s*>)+"
# Pointer doubling covers chains of 2^64 replies.
MAX_ROUNDS = 64


# Words in a window; shorter passages are linked whole or not at all.
WINDOW = 5


def normal(line: Column) -> Column:
    """A line without case and with single blanks; the two marks of ``passages`` count as white space."""
    return F.trim(F.regexp_replace(F.lower(line), r"[\s\x01\x02]+", " "))


def levels(text: Column | str) -> Column:
    """Lines of a message as (level, line, tidy): ``line`` without marks, ``tidy`` its normal form."""
    text = F.col(text) if isinstance(text, str) else text

    def parsed(line: Column) -> Column:
        marks = F.regexp_extract(line, MARKS, 0)
        plain = F.regexp_replace(line, MARKS, "")
        plain = F.when(marks == "", line).otherwise(F.regexp_replace(plain, r"^\s", ""))
        return F.struct(
            F.length(F.regexp_replace(marks, "[^>]", "")).alias("level"), plain.alias("line"), normal(plain).alias("tidy")
        )

    return F.transform(F.split(F.coalesce(text, F.lit("")), r"\r?\n"), parsed)


def passages(lines: Column | str) -> Column:
    """Passages of ``levels`` as (level, text), in order; blank ones are left out."""
    lines = F.col(lines) if isinstance(lines, str) else lines
    # Each line next to the one before it; a line that opens a passage is marked, and the joined text cut at the marks.
    before = F.concat(F.array(F.lit(None)), F.slice(lines, F.lit(1), F.size(lines) - 1))

    def marked(line: Column, last: Column) -> Column:
        opens = last.isNull() | (last["level"] != line["level"]) | (last["tidy"] == "")
        return F.concat(F.when(opens, F.concat(F.lit("\x01"), line["level"], F.lit("\x02"))).otherwise(" "), line["tidy"])

    cut = F.split(F.array_join(F.zip_with(lines, before, marked), ""), "\x01")
    parts = F.transform(
        cut,
        lambda p: F.struct(
            F.substring_index(p, "\x02", 1).try_cast("int").alias("level"), F.trim(F.substring_index(p, "\x02", -1)).alias("text")
        ),
    )
    return F.filter(parts, lambda p: p["text"] != "")


def _windows(rows: DataFrame, kept: list[str]) -> DataFrame:
    """``kept``, window, n_windows: the distinct word windows of ``text``, a row each."""
    words = rows.select(*kept, F.split("text", " ").alias("words")).where(F.size("words") >= WINDOW)
    # The optimizer may look at the windows of rows that are too short before it drops them.
    last = F.greatest(F.size("words") - (WINDOW - 1), F.lit(1))
    hashed = F.transform(F.sequence(F.lit(1), last), lambda i: F.xxhash64(F.array_join(F.slice("words", i, WINDOW), " ")))
    found = words.select(*kept, F.array_distinct(hashed).alias("windows"))
    return found.select(*kept, F.size("windows").alias("n_windows"), F.explode("windows").alias("window"))


def link_quotations(
    messages: DataFrame, message_id: str = "message_id", sent: str = "sent", role: str = "role", text: str = "text"
) -> DataFrame:
    """message_id, conversation_id, parent_id, position, depth, role, text, n_quoted, n_linked.

    ``text`` is the message without quoted lines, trimmed; ``conversation_id`` is the id of the
    first message of the thread; ``position`` counts from 1 in order of sending, which is a reply
    order since a parent is always sent before; ``depth`` is the number of parents up to the first
    message; ``n_quoted`` and ``n_linked`` count quoted passages, and those whose original was found. The outermost level decides about the parent, then the most quoted
    characters, then the later message.

    Defined results: a null text has no lines; messages without id or time link to nothing, are
    linked by nothing and form conversations of their own (a null id gives a null conversation);
    a passage that several earlier messages hold belongs to the last of them, one of fewer than
    ``WINDOW`` words to none of them outside its thread; of messages that as many windows come from,
    the later counts; repeated rows share a conversation and follow each other in it, and their
    linked passages are counted together; an empty table gives no rows.
    """
    split = materialize(
        messages.select(
            F.col(message_id).alias("message_id"),
            F.col(sent).alias("sent"),
            F.col(role).cast("string").alias("role"),
            levels(F.col(text).cast("string")).alias("lines"),
        )
    )
    body = F.trim(F.array_join(F.filter("lines", lambda x: x["level"] == 0)["line"], "\n"), F.lit(" \t\r\n"))
    parsed = materialize(split.select("message_id", "sent", "role", body.alias("text"), passages("lines").alias("passages")))
    held = parsed.where("message_id is not null and sent is not null")
    every = held.select("message_id", "sent", F.explode("passages").alias("p")).select(
        "message_id", "sent", "p.level", "p.text", F.md5("p.text").alias("key")
    )
    short = F.size(F.split("text", " ")) < WINDOW
    own = every.where("level = 0").withColumn("short", short)
    # A passage counts once per message on the original's side, as often as it stands on the reply's.
    quoted = every.where("level > 0").select("message_id", "sent", "key", "level", F.length("text").alias("chars"), short.alias("short"))
    whole = own.where("not short").select("message_id", "sent", "key").distinct()
    # Of a short passage the first holder is named, the later ones make it ambiguous.
    brief = own.where("short").select("key", "message_id", "sent")
    first = brief.groupBy("key").agg(F.min(F.struct("sent", "message_id")).alias("f")).select("key", "f.message_id", "f.sent")
    at = ["sent", "message_id"]
    named = F.col("message_id")
    nobody = F.lit(None).cast(parsed.schema["message_id"].dataType)
    holders = (
        whole.withColumn("original", named)
        .unionByName(brief.distinct().withColumn("original", nobody))
        .unionByName(first.withColumn("original", named))
    )
    linked = materialize(
        asof_join(quoted, holders, ["key"], at, ["original"], strict=True).withColumn("original", F.col("match.original")).drop("match")
    )
    missing = linked.where("original is null and not short")
    sure = linked.where("original is not null")
    if not missing.isEmpty():
        found = _by_windows(missing, every, own)
        sure = sure.unionByName(missing.drop("original").join(found, ["message_id", "sent", "level", "key"]))
    per_original = sure.groupBy("message_id", "level", "original").agg(F.sum("chars").alias("chars"), F.count("*").alias("n"))
    parents = per_original.groupBy("message_id").agg(
        F.max_by("original", F.struct(-F.col("level"), "chars", "original")).alias("parent_id"), F.sum("n").alias("n_linked")
    )
    tree = materialize(
        held.select("message_id").distinct().join(parents, "message_id", "left")
    )
    roots = _roots(tree)
    facts = tree.join(roots, "message_id")
    vague = linked.where("original is null and short").drop("original")
    if vague.isEmpty():
        facts = facts.withColumn("n_thread", F.lit(0))
    else:
        # The thread says which message is meant; here single lines count too.
        placed = roots.select("message_id", "conversation_id")
        lines = (
            split.where("message_id is not null and sent is not null")
            .select("message_id", "sent", F.explode(F.filter("lines", lambda x: (x["level"] == 0) & (x["tidy"] != ""))["tidy"]).alias("text"))
            .where(short)
            .select("message_id", "sent", F.md5("text").alias("key"))
        )
        near = lines.unionByName(brief).distinct().join(placed, "message_id").withColumn("original", named)
        in_thread = (
            asof_join(vague.join(placed, "message_id"), near, ["conversation_id", "key"], at, ["original"], strict=True)
            .where("match is not null")
            .groupBy("message_id")
            .agg(F.count("*").alias("n_thread"))
        )
        facts = facts.join(in_thread, "message_id", "left")
    n_quoted = F.size(F.filter("passages", lambda x: x["level"] > 0)).cast("bigint")
    rows = parsed.select("message_id", "sent", "role", "text", n_quoted.alias("n_quoted"))
    joined = materialize(
        rows.join(facts, "message_id", "left").select(
            "message_id",
            "sent",
            "role",
            "text",
            "n_quoted",
            F.coalesce("conversation_id", "message_id").alias("conversation_id"),
            "parent_id",
            F.coalesce("depth", F.lit(0)).cast("bigint").alias("depth"),
            (F.coalesce("n_linked", F.lit(0)) + F.coalesce("n_thread", F.lit(0))).cast("bigint").alias("n_linked"),
        )
    )
    order = ["sent", "message_id", "role", "text", "n_quoted"]
    return running(joined, ["conversation_id"], order, rank="position").select(
        "message_id", "conversation_id", "parent_id", "position", "depth", "role", "text", "n_quoted", "n_linked"
    )


def _by_windows(missing: DataFrame, every: DataFrame, own: DataFrame) -> DataFrame:
    """(message_id, sent, level, key, original) of the passages in ``missing`` that share at least half their windows with one message.

    A window goes to the last earlier message that has it in its own words. Only windows of the
    missing passages are looked for: the others of the originals are left where they are read.
    """
    names = ["message_id", "sent", "level", "key"]
    texts = every.where("level > 0").join(missing.select(*names).distinct(), names, "left_semi").dropDuplicates(names)
    asked = materialize(_windows(texts, names))
    held = (
        _windows(own, ["message_id", "sent"])
        .join(asked.select("window").distinct(), "window", "left_semi")
        .select("message_id", "sent", "window")
        .distinct()
        .withColumn("original", F.col("message_id"))
    )
    hits = asof_join(asked, held, ["window"], ["sent", "message_id"], ["original"], strict=True).where("match is not null")
    shared = hits.groupBy(*names, F.col("match.original").alias("original")).agg(F.count("*").alias("n"), F.max("n_windows").alias("of"))
    best = shared.where("2 * n >= of").groupBy(*names).agg(F.max_by("original", F.struct("n", "original")).alias("original"))
    return best


def _roots(tree: DataFrame) -> DataFrame:
    """(message_id, conversation_id, depth) by pointer doubling over (message_id, parent_id).

    A message is settled once it points to a message without a parent; only the others go on.
    """
    root = F.col("parent_id").isNull()
    state = materialize(
        tree.select(
            "message_id",
            F.coalesce("parent_id", "message_id").alias("up"),
            F.when(root, 0).otherwise(1).cast("bigint").alias("depth"),
            root.alias("settled"),
        )
    )
    for _ in range(MAX_ROUNDS):
        moving = state.where("not settled")
        if moving.isEmpty():
            break
        above = state.select(
            F.col("message_id").alias("up"), F.col("up").alias("__up"), F.col("depth").alias("__depth"), F.col("settled").alias("__settled")
        )
        moved = moving.join(above, "up").select(
            "message_id", F.col("__up").alias("up"), (F.col("depth") + F.col("__depth")).alias("depth"), F.col("__settled").alias("settled")
        )
        state = materialize(state.where("settled").unionByName(moved))
    return state.select("message_id", F.col("up").alias("conversation_id"), "depth")
