"""Mix sources to target weights with hash-threshold histograms.

Every document has a position: a hash of its id. A source that is to give ``target`` words takes
every document ``floor(target / source size)`` times, and once more those whose position lies
below a threshold. The threshold is found by histograms: words per source and bucket of the
position, then, inside the one bucket where the target falls, words per finer bucket, and so on.
Nothing is sorted, and the same hashes give nested mixes for growing targets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleanwork.operators.ordering import dense_index
from gleanwork.session import materialize

WORD = r"[^\x20\x09-\x0D]+"
# Digits of the 60-bit position, and how many each refinement reads: 4,096 buckets a source and pass.
DIGITS = 15
DIGITS_A_PASS = 3
# A source is repeated at most so often.
MOST_REPEATS = 3


def word_count(text: Column | str) -> Column:
    """Words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(F.col(text) if isinstance(text, str) else text, F.lit(WORD)), F.lit(0)).cast("bigint")


def cycled_weights(sources: DataFrame, weights: Sequence[int] = (1, 2, 3)) -> DataFrame:
    """Weights by the order of the sources' code points, null last, repeating."""
    numbered = dense_index(sources, [F.col("source").isNull(), F.encode("source", "utf-8")], "source_number")
    choose = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.col("source_number") % len(weights) + 1).cast("int"))
    return numbered.withColumn("weight", choose).drop("source_number")


def targets(sources: DataFrame, total: float | None = None) -> DataFrame:
    """(source, source_size, weight) with the words each source is to give.

    The targets share ``total`` (all words by default) by weight; none exceeds ``MOST_REPEATS``
    times its source, and what a source can't take goes to the others by weight, until none is
    above. One row a source; each round is one small aggregate.
    """
    goal = total
    if goal is None:
        goal = float(sources.agg(F.sum("source_size")).first()[0] or 0)
    cap = F.col("source_size") * float(MOST_REPEATS)
    level = 0.0
    while True:
        full = F.col("weight") * F.lit(level) > cap
        fixed, free = sources.agg(
            F.sum(F.when(full, cap).otherwise(0.0)), F.sum(F.when(full, 0.0).otherwise(F.col("weight")))
        ).first()
        following = (goal - (fixed or 0.0)) / free if free else level
        if following <= level * (1 + 1e-12):
            break
        level = following
    return sources.withColumn("target", F.least(F.col("weight") * F.lit(level), cap))


def _refined(docs: DataFrame, state: DataFrame, upto: int) -> DataFrame:
    """The edge bucket of every source, narrowed to ``upto`` digits."""
    edges = state.select(
        F.col("source").alias("__s"), F.col("prefix").alias("__p"), F.col("left").alias("__left"),
        F.col("bound").alias("__bound"), F.col("after").alias("__after"),
    )
    inside = docs.join(
        edges,
        F.col("source").eqNullSafe(F.col("__s")) & (F.substring("position", 1, upto - DIGITS_A_PASS) == F.col("__p")),
    ).where((F.col("size") <= F.col("__bound")) & (F.col("position") > F.col("__after")))
    histogram = inside.groupBy("source", F.substring("position", 1, upto).alias("bucket")).agg(
        F.sum("size").alias("words"),
        F.min("position").alias("lo"),
        F.max("position").alias("hi"),
        F.first("__left").alias("left"),
    )
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    placed = histogram.withColumn("below", F.coalesce(F.sum("words").over(before), F.lit(0)))
    # The last bucket that starts at or below what is left: the target falls inside it or behind all.
    edge = (
        placed.where(F.col("below") <= F.col("left"))
        .groupBy("source")
        .agg(F.max(F.struct("bucket", "below", "words", "lo", "hi")).alias("edge"))
        .select(F.col("source").alias("__s"), "edge")
    )
    kept = [c for c in state.columns if c not in ("left", "prefix", "lo", "hi", "words")]
    return state.join(edge, F.col("source").eqNullSafe(F.col("__s")), "left").select(
        *kept,
        (F.col("left") - F.coalesce("edge.below", F.lit(0))).alias("left"),
        F.coalesce("edge.bucket", F.lit("-")).alias("prefix"),
        "edge.lo",
        "edge.hi",
        F.coalesce("edge.words", F.lit(0)).alias("words"),
    )


def _threshold(docs: DataFrame, state: DataFrame) -> DataFrame:
    """``state`` with the position (``lo``) at which ``left`` words are reached, refined until it is one position.

    Only rows of at most ``bound`` words behind the position ``after`` count. Without such rows
    ``lo`` is null.
    """
    state = state.withColumn("prefix", F.lit(""))
    for upto in range(DIGITS_A_PASS, DIGITS + 1, DIGITS_A_PASS):
        state = materialize(_refined(docs, state, upto))
        if state.where("lo != hi").isEmpty():
            break
    return state


def thresholds(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """What each source gives: source, source_size, target, repeats and two nested thresholds.

    ``docs`` has source, size and position (``DIGITS`` hex digits), ``wanted`` source, source_size
    and target. The first threshold takes rows as long as they fit; the gap that the row at the
    threshold leaves is filled by a second threshold among later rows no larger than the gap, and
    the row at that one is in if most of it fits.
    """
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    repeats = F.least(whole, F.lit(MOST_REPEATS)).cast("bigint")
    left = F.when(repeats >= MOST_REPEATS, 0.0).otherwise(F.col("target") - repeats * F.col("source_size"))
    state = wanted.select(
        "source",
        "source_size",
        "target",
        repeats.alias("repeats"),
        left.alias("left"),
        F.lit(float("inf")).alias("bound"),
        F.lit("").alias("after"),
    )
    fits = F.col("left") >= F.col("words")
    first = _threshold(docs, state).select(
        "source",
        "source_size",
        "target",
        "repeats",
        (F.col("left") - F.when(fits, F.col("words")).otherwise(0)).alias("left"),
        F.col("lo").alias("threshold"),
        fits.alias("edge_in"),
    )
    filled = _threshold(docs, first.withColumn("bound", F.col("left")).withColumn("after", F.col("threshold")))
    return filled.select(
        "source",
        "source_size",
        "target",
        "repeats",
        "threshold",
        "edge_in",
        F.col("bound").alias("gap"),
        F.col("lo").alias("gap_threshold"),
        (F.col("left") * 2 >= F.col("words")).alias("gap_edge_in"),
    )


def take(docs: DataFrame, limits: DataFrame) -> DataFrame:
    """``docs`` (with source, size and position) with source_size, target, copies and taken words."""
    own = limits.withColumnRenamed("source", "__s")

    def reached(threshold: str, edge_in: str) -> Column:
        return (F.col("position") < F.col(threshold)) | ((F.col("position") == F.col(threshold)) & F.col(edge_in))

    filler = (F.col("position") > F.col("threshold")) & (F.col("size") <= F.col("gap")) & reached("gap_threshold", "gap_edge_in")
    extra = F.coalesce(reached("threshold", "edge_in") | filler, F.lit(False))
    copies = F.col("repeats") + F.when((F.col("repeats") < MOST_REPEATS) & extra, 1).otherwise(0)
    return docs.join(own, F.col("source").eqNullSafe(F.col("__s"))).select(
        *docs.columns, "source_size", "target", copies.cast("int").alias("copies"), (copies * F.col("size")).alias("taken")
    )


def position_of(doc_id: Column | str) -> Column:
    """Leading hex digits of the md5 of an id as text; null like an empty text."""
    doc_id = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit(""))), 1, DIGITS)


def source_limits(sized: DataFrame, weights: Sequence[int]) -> DataFrame:
    """Thresholds for all words of ``sized`` (source, size, position), shared by cycled weights."""
    totals = materialize(sized.groupBy("source").agg(F.sum("size").alias("source_size")))
    wanted = targets(materialize(cycled_weights(totals, weights)))
    return thresholds(sized, wanted.select("source", "source_size", "target"))


def mix_sources(
    docs: DataFrame, weights: Sequence[int] = (1, 2, 3), doc_id: str = "doc_id", source: str = "source", text: str = "text"
) -> DataFrame:
    """doc_id, source, size, source_size, target, taken and copies of every document.

    Defined results: a null text has size 0 and nothing to give; null sources form one source, the
    last; rows of one id share a position and are taken together; null ids likewise; sources
    without words have target 0; an empty table gives no rows. Reruns agree: the position is the
    md5 of the id as text. Other columns are ignored.
    """
    sized = materialize(
        docs.select(
            F.col(doc_id).alias("doc_id"),
            F.col(source).alias("source"),
            word_count(text).alias("size"),
            position_of(doc_id).alias("position"),
        )
    )
    return take(sized, source_limits(sized, weights)).select(
        "doc_id", "source", "size", "source_size", "target", "taken", "copies"
    )


def mixed_documents(docs: DataFrame, weights: Sequence[int] = (1, 2, 3)) -> DataFrame:
    """The documents the mix takes, with size, source_size, target, taken and ``copies`` (1 to 3).

    A column of ``docs`` with one of these names is replaced.
    """
    added = {"size", "source_size", "target", "taken", "copies", "position"}
    kept = [c for c in docs.columns if c.lower() not in added]
    rows = docs.select(*kept, word_count("text").alias("size"), position_of("doc_id").alias("position"))
    sized = materialize(rows.select("source", "size", "position"))
    taken = take(rows, source_limits(sized, weights)).where("copies > 0")
    return taken.select(*kept, "size", "source_size", "target", "taken", "copies")
