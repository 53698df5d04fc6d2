"""MinHash near-duplicates: fast similarity sketches, banding and exact verification.

A sketch has ``COORDINATES`` bins. Round i throws every shingle into one bin with a value that is
larger than every value of round i - 1; a bin keeps its minimum. Once all bins are full the sketch
is complete; after as many rounds as bins, each remaining bin takes the minimum over all shingles.
So every coordinate fills, and the share of equal coordinates concentrates around the similarity.

The work after the sketch is linear in the documents wherever copies agree with a central copy:
texts with the same shingle set are one class; every bucket compares its members with its most
central member only; links become components; and only where members of a bucket are still in
different components the rest is compared, in blocks of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanwork.llm.components import components
from gleanwork.llm.tokens import WordHashes, mix, seeds, shingles, slices, text_bytes, words
from gleanwork.session import materialize

COORDINATES = 512
# A pair exactly at the threshold shares no band with at most this probability.
MISS = 1e-8
# Members of an open group compared in one task: two blocks of this size.
BLOCK = 500
# Open groups up to this size list their pairs in a join instead of a block.
SMALL_GROUP = 6
# Sketches of pairs at the threshold agree less than this many deviations below it with probability < 1e-8.
DEVIATIONS = 5.7


def band_rows(threshold: float) -> int:
    """The most coordinates a band may have so that a pair at the threshold is missed at most ``MISS``."""
    rows = 1
    while (1 - threshold ** (rows + 1)) ** (COORDINATES // (rows + 1)) <= MISS:
        rows += 1
    return rows


def sketch(sets: list[np.ndarray]) -> np.ndarray:
    """Fast similarity sketches (one row each) of non-empty sets of 64-bit hashes."""
    t = COORDINATES
    constants = seeds(2 * t, 3)
    sizes = np.array([len(s) for s in sets], np.int64)
    owner, x = np.repeat(np.arange(len(sets)), sizes), np.concatenate(sets)
    flat = np.full(len(sets) * t, np.iinfo(np.uint64).max, np.uint64)
    filled = np.zeros(len(sets) * t, bool)
    for i in range(t):
        h = mix(x ^ constants[i])
        at = owner * t + (h % np.uint64(t)).astype(np.int64)
        free = ~filled[at]
        np.minimum.at(flat, at[free], h[free] >> np.uint64(9))
        filled[at] = True
        open_ = ~filled.reshape(-1, t).all(1)
        if not open_.any():
            break
        keep = open_[owner]
        if not keep.all():
            owner, x = owner[keep], x[keep]
    out = flat.reshape(-1, t)
    for d in np.flatnonzero(~filled.reshape(-1, t).all(1)):
        bins = np.flatnonzero(~filled[d * t : d * t + t])
        out[d, bins] = (mix(sets[d][:, None] ^ constants[t + bins][None, :]) >> np.uint64(9)).min(0)
    return out


def band_keys(sketches: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit key per band of ``rows`` coordinates; equal keys of different bands differ."""
    bands = sketches.shape[1] // rows
    parts = sketches[:, : bands * rows].reshape(len(sketches), bands, rows)
    keys = np.broadcast_to(seeds(bands, 5), (len(sketches), bands)).copy()
    for k in range(rows):
        keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, k])
    return keys.view(np.int64)


def _profiles(width: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in slices(batches, 1_000):
            sets = [shingles(hashes.of(words(t)), width) for t in text_bytes(batch.column("text"))]
            keys = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
            full = [k for k, s in enumerate(sets) if len(s)]
            bands: list = [None] * len(sets)
            if full:
                for k, row in zip(full, band_keys(sketch([sets[k] for k in full]), rows)):
                    bands[k] = row
            yield pa.record_batch(
                {
                    "doc_id": batch.column("doc_id"),
                    "n_shingles": pa.array([len(s) for s in sets], pa.int64()),
                    "set_key": pa.array(keys, pa.binary()),
                    "bands": pa.array(bands, pa.list_(pa.int64())),
                }
            )

    return run


def _keyed(width: int):
    """set_key of each text, as in the profiles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in slices(batches, 1_000):
            sets = [shingles(hashes.of(words(t)), width) for t in text_bytes(batch.column("text"))]
            keys = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
            yield pa.record_batch({"set_key": pa.array(keys, pa.binary()), "text": batch.column("text")})

    return run


def _verified(width: int, numerator: int, denominator: int):
    """Pairs with texts → the pairs whose full sets meet the threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, kept = WordHashes(), {}

        def of(node: int, text: bytes) -> np.ndarray:
            if node not in kept:
                if len(kept) >= 256:
                    kept.clear()
                kept[node] = shingles(hashes.of(words(text)), width)
            return kept[node]

        for batch in slices(batches, 1_000):
            u, v = batch.column("u").to_pylist(), batch.column("v").to_pylist()
            good = []
            for a, b, p, q in zip(u, v, text_bytes(batch.column("text_u")), text_bytes(batch.column("text_v"))):
                left, right = of(a, p), of(b, q)
                both = len(np.intersect1d(left, right, assume_unique=True))
                good.append(denominator * both >= numerator * (len(left) + len(right) - both))
            yield pa.record_batch({"u": batch.column("u"), "v": batch.column("v")}).filter(pa.array(good, pa.bool_()))

    return run


def _verify(pairs: DataFrame, texts: DataFrame, width: int, numerator: int, denominator: int) -> DataFrame:
    with_texts = (
        pairs.join(texts.select(F.col("node").alias("v"), F.col("text").alias("text_v")), "v")
        .join(texts.select(F.col("node").alias("u"), F.col("text").alias("text_u")), "u")
        .select("u", "v", "text_u", "text_v")
    )
    return with_texts.mapInArrow(_verified(width, numerator, denominator), "u bigint, v bigint")


def _sketched(width: int):
    """Low bytes of the sketch, and the full set, of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in slices(batches, 1_000):
            sets = [shingles(hashes.of(words(t)), width) for t in text_bytes(batch.column("text"))]
            low = sketch(sets).astype(np.uint8)
            yield pa.record_batch(
                {
                    "node": batch.column("node"),
                    "bytes": pa.array([r.tobytes() for r in low], pa.binary()),
                    "set": pa.array([s.tobytes() for s in sets], pa.binary()),
                }
            )

    return run


def _block_links(agreement: float, numerator: int, denominator: int):
    """Strays of a block against members of a block: links between different components, checked on full sets.

    Sketches that agree too little rule a pair out; a pair whose components a link of this block
    has joined already isn't checked again, so there are fewer links than members.
    """

    def run(group: pa.Table) -> pa.Table:
        side, node = group.column("side").to_numpy(), group.column("node").to_numpy()
        label, stray = group.column("label").to_numpy().copy(), group.column("stray").to_numpy(zero_copy_only=False)
        bits = np.frombuffer(b"".join(group.column("bytes").to_pylist()), np.uint8).reshape(len(node), -1)
        sets = [np.frombuffer(raw, np.uint64) for raw in group.column("set").to_pylist()]
        right = np.flatnonzero(side == 1)
        us, vs = [], []
        for a in np.flatnonzero(side == 0):
            # Two strays meet twice, each as a member; the smaller one looks at the other.
            near = right[(label[right] != label[a]) & (~stray[right] | (node[right] > node[a]))]
            for b in near[(bits[near] == bits[a]).mean(1) >= agreement]:
                if label[a] == label[b]:
                    continue
                both = len(np.intersect1d(sets[a], sets[b], assume_unique=True))
                if denominator * both >= numerator * (len(sets[a]) + len(sets[b]) - both):
                    us.append(node[a])
                    vs.append(node[b])
                    label[label == label[b]] = label[a]
        return pa.table({"u": pa.array(us, pa.int64()), "v": pa.array(vs, pa.int64())})

    return run


def _open_links(led: DataFrame, labels: DataFrame, texts: DataFrame, width: int, numerator: int, denominator: int) -> DataFrame:
    """Links between bucket members, leaders aside, that are not yet in one component.

    Members meet under the leader of their bucket; a leader often leads them in many bands, and
    they are compared once. The largest component of a group needs no links inside, so only the
    members outside it, its strays, are compared with all: a group with few strays moves each set
    once for every ``BLOCK`` of these.
    """
    threshold = numerator / denominator
    labelled = materialize(
        led.where("node != leader").select("leader", "node", "n_shingles").distinct().join(labels, "node", "left").select(
            "leader", "node", "n_shingles", F.coalesce("component", "node").alias("label")
        )
    )
    parts = labelled.groupBy("leader", "label").agg(F.count("*").alias("n"))
    groups = parts.groupBy("leader").agg(
        F.sum("n").alias("n"), F.max_by("label", F.struct("n", "label")).alias("main"), F.max("n").alias("most"), F.count("*").alias("labels")
    )
    # Stored, so that the planner knows its size and members of a hot leader need not move to it.
    opened = materialize(groups.where("labels > 1").select("leader", "n", "main", (F.col("n") - F.col("most")).alias("n_stray")))
    open_members = materialize(labelled.join(opened, "leader"))
    small = open_members.where(F.col("n") <= SMALL_GROUP)
    other = small.select("leader", *(F.col(c).alias(f"{c}_v") for c in ("node", "label", "n_shingles")))
    listed = small.join(other, "leader").where(
        (F.col("node") < F.col("node_v"))
        & (F.col("label") != F.col("label_v"))
        & (F.least("n_shingles", "n_shingles_v") >= threshold * F.greatest("n_shingles", "n_shingles_v"))
    )
    pairs = listed.select(F.col("node").alias("u"), F.col("node_v").alias("v")).distinct()
    large = open_members.where(F.col("n") > SMALL_GROUP).withColumn("stray", F.col("label") != F.col("main"))
    sketches = texts.join(large.select("node").distinct(), "node", "left_semi").select("node", "text").mapInArrow(
        _sketched(width), "node bigint, bytes binary, set binary"
    )
    # Strays of block i meet members of block j.
    members, strays = F.ceil(F.col("n") / BLOCK), F.ceil(F.col("n_stray") / BLOCK)
    own = F.xxhash64("node")
    zero = F.lit(0).cast("bigint")
    places = F.transform(F.sequence(zero, strays - 1), lambda i: F.struct(i.alias("i"), F.pmod(own, members).alias("j"), F.lit(1).alias("side")))
    asking = F.transform(F.sequence(zero, members - 1), lambda j: F.struct(F.pmod(own, strays).alias("i"), j.alias("j"), F.lit(0).alias("side")))
    tasks = (
        large.withColumn("place", F.explode(F.when(F.col("stray"), F.concat(places, asking)).otherwise(places)))
        .join(materialize(sketches), "node")
        .select("leader", "place.i", "place.j", "place.side", "node", "label", "stray", "bytes", "set")
    )
    agreement = threshold - DEVIATIONS * (threshold * (1 - threshold) / COORDINATES) ** 0.5
    blocked = tasks.groupBy("leader", "i", "j").applyInArrow(
        _block_links(agreement, numerator, denominator), "u bigint, v bigint"
    )
    return _verify(pairs, texts, width, numerator, denominator).unionByName(blocked)


def near_duplicates(
    docs: DataFrame,
    width: int = 5,
    numerator: int = 80,
    denominator: int = 100,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    Documents whose sets of ``width``-word shingles have ``denominator * |A and B| >= numerator *
    |A or B|`` are linked; ``component_id`` is the smallest id reachable. Defined results: a text
    of fewer words is one shingle; null, empty and blank texts have no shingles and stand alone;
    a null id never names a component (its row is not kept, and a component of null ids only has a
    null id); repeated rows of one id are all returned, each in the component of its text; an empty table gives no rows. Other
    columns of ``docs`` are ignored. Ids must be integers.
    """
    threshold = numerator / denominator
    rows = band_rows(threshold)
    source = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    profiles = materialize(
        source.mapInArrow(
            _profiles(width, rows), "doc_id bigint, n_shingles bigint, set_key binary, bands array<bigint>"
        )
    )
    # Same set, same class: the smallest id stands for all its copies from here on, or a number
    # where an id has several sets.
    repeated, several = _repeats(profiles)
    classes = profiles.where("set_key is not null").groupBy("set_key").agg(
        F.min("doc_id").alias("name"), F.any_value("bands").alias("bands"), F.first("n_shingles").alias("n_shingles")
    ).where("name is not null")
    reps = materialize(classes.withColumn("node", F.monotonically_increasing_id() if several else F.col("name")))
    bands = reps.select("node", "n_shingles", F.explode("bands").alias("key"))
    shared = bands.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    members = materialize(bands.join(shared, "key"))
    # The member that meets most others over all bands is the likely centre of its group.
    central = members.groupBy("node").agg(F.sum("n").alias("met"))
    leaders = members.join(central, "node").groupBy("key").agg(
        F.max_by("node", F.struct("met", -F.col("node"))).alias("leader")
    )
    led = materialize(members.join(leaders, "key").select("key", "node", "n_shingles", "leader"))
    if several:
        named = materialize(led.select("node").distinct().join(reps.select("node", "name", "set_key"), "node"))
        near = source.join(named.select(F.col("name").alias("doc_id")).distinct(), "doc_id", "left_semi").select("text")
        keyed = near.mapInArrow(_keyed(width), "set_key binary, text string").join(named.select("set_key", "node"), "set_key")
        texts = keyed.groupBy("node").agg(F.min("text").alias("text"))
    else:
        texts = source.join(led.select(F.col("node").alias("doc_id")).distinct(), "doc_id", "left_semi").select(
            F.col("doc_id").alias("node"), "text"
        )
        if repeated:
            texts = texts.where("text is not null").groupBy("node").agg(F.min("text").alias("text"))
    texts = materialize(texts)
    pairs = led.where("node != leader").select(F.col("leader").alias("u"), F.col("node").alias("v")).distinct()
    links = materialize(_verify(pairs, texts, width, numerator, denominator))
    labels = materialize(components(links))
    more = materialize(_open_links(led, labels, texts, width, numerator, denominator))
    if not more.isEmpty():
        labels = materialize(components(links.unionByName(more)))
    final = reps.select("set_key", "name", "node").join(labels, "node", "left").select(
        "set_key", "name", F.coalesce("component", "node").alias("component")
    )
    if several:
        least = final.groupBy("component").agg(F.min("name").alias("least"))
        final = final.join(least, "component").select("set_key", F.col("least").alias("component"))
    final = final.select("set_key", "component")
    return (
        profiles.select("doc_id", "n_shingles", "set_key")
        .join(final, "set_key", "left")
        .select(
            "doc_id",
            "n_shingles",
            F.when(F.col("set_key").isNull(), F.col("doc_id")).otherwise(F.col("component")).alias("component_id"),
        )
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))
    )


def _repeats(profiles: DataFrame) -> tuple[bool, bool]:
    """Whether an id occurs in more than one row, and whether it does so with different sets."""
    key = F.xxhash64("set_key")
    ids = profiles.where("doc_id is not null").groupBy("doc_id").agg(
        F.count("*").alias("n"), F.min(key).alias("low"), F.max(key).alias("high")
    )
    found = ids.where("n > 1").agg(F.count("*"), F.max(F.col("low") != F.col("high"))).first()
    return found[0] > 0, bool(found[1])


def one_of_each(docs: DataFrame, groups: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose document is kept in ``groups``; of repeated rows of one id and text, one stays.

    Rows with a null id stay: they have no name by which another row could stand for them.
    """
    # Columns of the documents may have any name.
    mark = "__group"
    while any(c.startswith(mark) for c in docs.columns):
        mark += "_"
    own, kept, n = f"{mark}_id", f"{mark}_kept", f"{mark}_n"
    names = groups.groupBy(F.col("doc_id").alias(own)).agg(F.bool_or("kept").alias(kept), F.count("*").alias(n))
    joined = docs.join(names, F.col(doc_id) == F.col(own), "left")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    once = joined.where(F.col(own).isNull() | (F.col(kept) & (F.col(n) == 1))).select(columns)
    repeated = names.where(F.col(kept) & (F.col(n) > 1))
    if repeated.isEmpty():
        return once
    return once.unionByName(joined.where(F.col(kept) & (F.col(n) > 1)).select(columns).dropDuplicates([doc_id, text]))
