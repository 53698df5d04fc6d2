"""Language-model scores from a log-frequency Bloom filter.

N-gram counts are quantised to levels of a logarithm; an n-gram of level q is entered q times, as
(n-gram, 1) to (n-gram, q), so that a reader probes level after level until one is missing. A false
hit needs all probes of a level to be set by chance, and can only raise a count by one level. The
filter is built where the counts are: n-grams are dealt by their hash into segments, and a segment
is summed, quantised and entered by one task. Its bits grow with what is entered, so the error
rate is the same for every corpus. A filter up to ``BROADCAST_BYTES`` is sent to the texts, shard
by shard; of a larger one the segments stay apart, and what a run of texts asks is sent to them.

The probability of a token mixes the bigram estimate with the unigram estimate (Dirichlet prior);
both read their counts from the filter. Hashes of tokens have 64 bits and their counts are exact;
hashes of bigrams have 48.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StructField, StructType

from gleanwork.llm.ranking import most_frequent
from gleanwork.llm.tokens import WordHashes, mix, seeds, text_bytes, text_slices, words
from gleanwork.session import materialize, shuffles_dropped, small_batches

# Quantisation base, bits for each entry and probes for each level: about 1 % false hits a level.
BASE, BITS, PROBES = 2.0, 10, 4
PRIOR = 50.0
# Filter bytes that a worker holds at a time.
SHARD_BYTES = 64_000_000
# Filters larger than this are not sent to the texts.
BROADCAST_BYTES = 16_000_000
# Counts of so many most frequent tokens are known to every task; the rest are joined.
KNOWN_TOKENS = 200_000
# Tokens whose n-grams a task counts together before it passes them on.
CHUNK_TOKENS = 1_500_000
# Bytes of kept columns that go with the n-grams of a run, about.
KEPT_BYTES = 16_000_000
# Words whose hashes a worker keeps, and rows and bytes of text it works on at a time.
CACHED_WORDS = 100_000
SLICE_ROWS, SLICE_BYTES = 500, 2_000_000
# Bytes of an Arrow batch, about: a worker and its task's JVM hold a few.
BATCH_BYTES = 4_000_000
# Bytes of text behind one segment of the filter, about.
SEGMENT_BYTES = 3_000_000
END = np.uint64(0x1F0A5B3C9D7E2468)
START = np.uint64(0x7C3E91D2048FB65A)
_PROBE_SEEDS = seeds(PROBES, 21)
LEVELS = 64


def token_hashes(text: bytes | None, hashes: WordHashes) -> np.ndarray:
    """Hashes of the words of a text and of the end, which is a token too."""
    own = words(text)
    out = np.empty(len(own) + 1, np.uint64)
    out[:-1] = hashes.of(own)
    out[-1] = END
    return out


def bigrams(tokens: np.ndarray, starts: np.ndarray | int = 0) -> np.ndarray:
    """Hashes of each token with the one before; the first of each text (``starts``) follows a start mark."""
    before = np.empty_like(tokens)
    before[1:] = tokens[:-1]
    before[starts] = START
    return mix(before * np.uint64(0x9E3779B97F4A7C15) + tokens) >> np.uint64(16)


def level_of(counts: np.ndarray) -> np.ndarray:
    """Quantised counts: 1 + floor(log) for counts of at least 1, else 0."""
    counts = np.asarray(counts, np.float64)
    out = np.zeros(len(counts), np.int64)
    out[counts >= 1] = 1 + np.floor(np.log(counts[counts >= 1]) / math.log(BASE) + 1e-9)
    return np.minimum(out, LEVELS)


def count_of(levels: np.ndarray) -> np.ndarray:
    """The count a level stands for: the middle of its range, 0 for level 0."""
    return np.where(levels > 0, (BASE ** (levels - 1) + BASE**levels - 1) / 2, 0.0)


_COUNTS = count_of(np.arange(LEVELS + 1))


def _bits(ngrams: np.ndarray, level: int, size: np.ndarray | int) -> list[np.ndarray]:
    """Positions of the probes of (n-gram, level) in a segment of ``size`` bits."""
    entry = mix(ngrams ^ np.uint64(level * 0x2545F4914F6CDD1D & 0xFFFFFFFFFFFFFFFF))
    return [mix(entry ^ s) % np.asarray(size, np.uint64) for s in _PROBE_SEEDS]


def fill(ngrams: np.ndarray, levels: np.ndarray) -> np.ndarray:
    """The bits (packed) of a segment that holds n-grams with their levels."""
    size = max(64, -(-int(levels.sum()) * BITS // 64) * 64)
    out = np.zeros(size, bool)
    for level in range(1, int(levels.max(initial=0)) + 1):
        chosen = ngrams[levels >= level]
        for at in _bits(chosen, level, size):
            out[at.astype(np.int64)] = True
    return np.packbits(out, bitorder="little")


def joined(segments: list[tuple[int, bytes]]) -> tuple[list[tuple[int, int]], bytes]:
    """(segment, bytes) in order, and all bits in one piece: what a worker reads without a copy of its own."""
    return [(number, len(raw)) for number, raw in segments], b"".join(raw for _, raw in segments)


class Filter:
    """Segments of a filter that one worker holds; n-grams of other segments read as level 0."""

    def __init__(self, lot: tuple[list[tuple[int, int]], bytes], total: int) -> None:
        self.total = total
        self.start, self.size = np.zeros(total, np.int64), np.zeros(total, np.uint64)
        at = 0
        for number, length in lot[0]:
            self.start[number], self.size[number] = at, length * 8
            at += length
        self.bytes = np.frombuffer(lot[1], np.uint8)

    def levels(self, ngrams: np.ndarray) -> np.ndarray:
        out = np.zeros(len(ngrams), np.uint8)
        segment = segment_of(ngrams, self.total)
        left = np.flatnonzero(self.size[segment] > 0)
        for level in range(1, LEVELS + 1):
            own = segment[left]
            start, size, chosen = self.start[own], self.size[own], ngrams[left]
            hit = np.ones(len(left), bool)
            for at in _bits(chosen, level, size):
                at = at.astype(np.int64)
                hit &= (self.bytes[start + (at >> 3)] >> (at & 7).astype(np.uint8)) & 1 == 1
            left = left[hit]
            if not len(left):
                break
            out[left] = level
        return out


def segment_of(ngrams: np.ndarray, total: int) -> np.ndarray:
    return ((ngrams >> np.uint64(13)) % np.uint64(total)).astype(np.int64)


def _by_segment(ngrams: np.ndarray, total: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of ``ngrams`` (in order) by segment, and the edges of the segments among them."""
    segment = segment_of(ngrams, total)
    if total <= 1 << 16:
        segment = segment.astype(np.uint16)  # sorted by radix
    edges = np.concatenate([[0], np.cumsum(np.bincount(segment, minlength=total))])
    return np.argsort(segment, kind="stable"), edges


def _packed(ngrams: np.ndarray, edges: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of ``size`` bytes, by segment and in order, as one piece for each segment; the pieces' edges.

    A piece begins with the number of segments and its own. What these leave open of the hashes follows as
    differences, byte plane by byte plane: the planes of zeros vanish where a shuffle compresses.
    """
    total = len(edges) - 1
    counts = np.diff(edges)
    left = ((ngrams >> np.uint64(13)) // np.uint64(total) << np.uint64(13)) | (ngrams & np.uint64(8191))
    first = edges[:-1][counts > 0]
    starting = left[first]
    left[1:] -= left[:-1].copy()
    left[first] = starting
    planes = left.astype("<u8", copy=False).view(np.uint8).reshape(-1, 8)
    ends = edges * size + 8 * np.arange(total + 1)
    out = np.empty(ends[-1], np.uint8)
    head = np.stack([np.full(total, total), np.arange(total)], 1).astype("<u4").view(np.uint8)
    out[ends[:-1, None] + np.arange(8)] = head
    at = np.repeat((ends[:-1] + 8 - edges[:-1]).astype(np.int32), counts) + np.arange(len(ngrams), dtype=np.int32)
    step = np.repeat(counts.astype(np.int32), counts)
    for plane in range(size):
        out[at] = planes[:, plane]
        at += step
    return out, ends


def _unpacked(raw: list[bytes], size: int) -> np.ndarray:
    """The hashes in pieces of ``_packed``, one piece after the other."""
    lengths = np.array([len(x) for x in raw], np.int64)
    joined = np.frombuffer(b"".join(raw), np.uint8)
    starts = np.cumsum(lengths) - lengths
    counts = (lengths - 8) // size
    edges = np.cumsum(counts) - counts
    head = joined[starts[:, None] + np.arange(8)].view("<u4").astype(np.uint64)
    out = np.zeros((int(counts.sum()), 8), np.uint8)
    at = np.repeat(starts + 8 - edges, counts) + np.arange(len(out))
    step = np.repeat(counts, counts)
    for plane in range(size):
        out[:, plane] = joined[at]
        at += step
    left = np.cumsum(out.view("<u8").ravel(), dtype=np.uint64)
    before = np.concatenate([np.zeros(1, np.uint64), left])[edges]
    left -= np.repeat(before, counts)
    high = (left >> np.uint64(13)) * np.repeat(head[:, 0], counts) + np.repeat(head[:, 1], counts)
    return (high << np.uint64(13)) | (left & np.uint64(8191))


def _squeezed(values: np.ndarray) -> bytes:
    """Integers by byte plane, compressed, behind their number."""
    planes = values.view(np.uint8).reshape(-1, values.itemsize).T
    return len(values).to_bytes(8, "little") + pa.compress(np.ascontiguousarray(planes), codec="zstd", asbytes=True)


def _restored(raw: bytes, kind: str) -> np.ndarray:
    size = np.dtype(kind).itemsize
    planes = pa.decompress(memoryview(raw)[8:], int.from_bytes(raw[:8], "little") * size, codec="zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(size, -1).T).view(kind).ravel()


def _tallied(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The distinct n-grams of ``parts`` in order and their counts; ``parts`` is emptied, so that they are held once."""
    values = np.concatenate(parts)
    parts.clear()
    values.sort()
    starts = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))
    return values[starts], np.diff(starts, append=len(values))


def _binaries(raw: np.ndarray, edges: np.ndarray) -> pa.Array:
    """The pieces of ``raw`` between ``edges``, without a copy."""
    offsets = pa.py_buffer(edges.astype(np.int32))
    return pa.Array.from_buffers(pa.binary(), len(edges) - 1, [None, offsets, pa.py_buffer(raw)])


PACKED = "segment int, ones binary, ones_n binary, twos binary, twos_n binary"


def _counted(total: int):
    """Per run of documents and segment one row with the distinct n-grams of the run and their counts.

    A long text is cut into several runs.
    """

    def rows(ones: list[np.ndarray], twos: list[np.ndarray]) -> pa.RecordBatch:
        columns: dict = {}
        held = np.zeros(total, bool)
        for name, parts, size in (("ones", ones, 8), ("twos", twos, 6)):
            values, counts = _tallied(parts)
            order, edges = _by_segment(values, total)
            held |= np.diff(edges) > 0
            columns[f"{name}_n"] = _binaries(counts[order].astype("<u4"), edges * 4)
            values = values[order]
            del counts, order
            columns[name] = _binaries(*_packed(values, edges, size))
        batch = pa.record_batch({"segment": pa.array(np.arange(total, dtype=np.int32)), **{k: columns[k] for k in ("ones", "ones_n", "twos", "twos_n")}})
        return batch if held.all() else batch.filter(pa.array(held))

    def run(texts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes(CACHED_WORDS)
        ones: list[np.ndarray] = []
        twos: list[np.ndarray] = []
        size = 0
        for batch in text_slices(texts, SLICE_ROWS, SLICE_BYTES):
            for text in text_bytes(batch.column("text")):
                tokens = token_hashes(text, hashes)
                pairs = bigrams(tokens)
                for start in range(0, len(tokens), CHUNK_TOKENS):
                    ones.append(tokens[start : start + CHUNK_TOKENS])
                    twos.append(pairs[start : start + CHUNK_TOKENS])
                    size += len(ones[-1])
                    if size >= CHUNK_TOKENS:
                        yield rows(ones, twos)
                        size = 0
        if size:
            yield rows(ones, twos)

    return run


def _summed(group: pa.Table, name: str, size: int) -> tuple[np.ndarray, np.ndarray]:
    values = _unpacked(group.column(name).to_pylist(), size)
    n = np.frombuffer(b"".join(group.column(f"{name}_n").to_pylist()), "<u4")
    distinct, place = np.unique(values, return_inverse=True)
    return distinct, np.bincount(place, weights=n, minlength=len(distinct)).astype(np.int64)


def _built(group: pa.Table) -> pa.Table:
    """One segment: counts summed, quantised and entered; unigram counts are returned exactly."""
    ones, n = _summed(group, "ones", 8)
    twos, m = _summed(group, "twos", 6)
    raw = fill(np.concatenate([ones, twos]), np.concatenate([level_of(n), level_of(m)])).tobytes()
    return pa.table(
        {
            "segment": group.column("segment").slice(0, 1).combine_chunks(),
            "bits": pa.array([raw], pa.binary()),
            "ngrams": pa.array([ones.view(np.int64)], pa.list_(pa.int64())),
            "counts": pa.array([n], pa.list_(pa.int64())),
        }
    )


class Model:
    """What scoring needs: unigram counts, the filter's segments, the totals, and the number of texts (each begins and ends once)."""

    def __init__(self, unigrams: DataFrame, segments: DataFrame, total: int, tokens: int, distinct: int, texts: int) -> None:
        self.unigrams, self.segments, self.total = unigrams, segments, total
        self.tokens, self.distinct, self.texts = tokens, distinct, texts


def train(texts: DataFrame) -> Model:
    """Count all texts (column ``text``; null is empty) and build the filter.

    An empty table gives a model without tokens: every count is 0.
    """
    size, count = texts.agg(F.sum(F.octet_length("text")), F.count("*")).first()
    total = max(1, (size or 0) // SEGMENT_BYTES)
    counted = texts.select("text").mapInArrow(_counted(total), PACKED)
    with small_batches(texts.sparkSession, BATCH_BYTES), shuffles_dropped(texts.sparkSession):
        segments = materialize(
            counted.groupBy("segment").applyInArrow(_built, "segment int, bits binary, ngrams array<bigint>, counts array<bigint>")
        )
    unigrams = segments.select(F.explode(F.arrays_zip("ngrams", "counts")).alias("x")).select(
        "x.ngrams", "x.counts"
    ).toDF("ngram", "n")
    tokens, distinct = segments.agg(
        F.coalesce(F.sum(F.reduce("counts", F.lit(0).cast("bigint"), lambda a, b: a + b)), F.lit(0)),
        F.coalesce(F.sum(F.size("counts")), F.lit(0)),
    ).first()
    return Model(unigrams, segments, total, int(tokens), int(distinct), count)


def _filter_bytes(model: Model) -> int:
    return model.segments.agg(F.sum(F.octet_length("bits"))).first()[0] or 0


def _shard(model: Model, k: int, count: int) -> tuple[list[tuple[int, int]], bytes]:
    """The segments of one of ``count`` lots."""
    rows = model.segments.where(F.col("segment") % count == k).select("segment", "bits").collect()
    return joined([(r["segment"], r["bits"]) for r in rows])


REST = "array<struct<ngram:bigint,n:int>>"


def _levels(rows: DataFrame, lot: tuple[list[tuple[int, int]], bytes], total: int) -> DataFrame:
    """A copy of ``rows`` (with text and levels so far) with the levels that one shard adds, one byte an n-gram."""
    shared = rows.sparkSession.sparkContext.broadcast(lot)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, held = WordHashes(CACHED_WORDS), Filter(shared.value, total)
        for batch in text_slices(batches, SLICE_ROWS, SLICE_BYTES):
            tokens = [token_hashes(t, hashes) for t in text_bytes(batch.column("text"))]
            levels = _merged(_looked_up(tokens, _distinct(tokens), held), batch.column("levels").to_pylist())
            place = batch.schema.get_field_index("levels")
            yield batch.set_column(place, "levels", pa.array([x.tobytes() for x in levels], pa.binary()))

    with small_batches(rows.sparkSession, BATCH_BYTES):
        out = materialize(rows.mapInArrow(run, rows.schema))
    # Else the filters of earlier passes stay in the executors.
    shared.destroy()
    return out


def _merged(own: list[np.ndarray], before: list[bytes | None]) -> list[np.ndarray]:
    return [a if b is None else np.maximum(a, np.frombuffer(b, np.uint8)) for a, b in zip(own, before)]


def _distinct(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The distinct n-grams of a batch in order, and the place of each n-gram among them."""
    return np.unique(np.concatenate(parts), return_inverse=True)


def _looked_up(tokens: list[np.ndarray], ones: tuple[np.ndarray, np.ndarray], held: Filter) -> list[np.ndarray]:
    """Levels of the tokens (``ones``: their ``_distinct``) and bigrams of each text; equal n-grams of the batch are probed once."""
    one, two = (held.levels(values)[at] for values, at in (ones, _distinct([bigrams(t) for t in tokens])))
    ends = np.cumsum([len(t) for t in tokens])
    return [np.concatenate([one[e - len(t) : e], two[e - len(t) : e]]) for e, t in zip(ends, tokens)]


def _unknown(tokens: list[np.ndarray], ones: np.ndarray, at: np.ndarray, wanted: np.ndarray) -> pa.ListArray:
    """Of each text the distinct tokens among the ``wanted`` of ``ones``, in order, with how often it has them."""
    text = np.repeat(np.arange(len(tokens)), [len(t) for t in tokens])
    chosen = wanted[at]
    pairs, times = np.unique(text[chosen] * len(ones) + at[chosen], return_counts=True)
    offsets = np.searchsorted(pairs, np.arange(len(tokens) + 1) * len(ones))
    values = ones[pairs % len(ones)].view(np.int64)
    entries = pa.StructArray.from_arrays([pa.array(values), pa.array(times, pa.int32())], names=["ngram", "n"])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), entries)


def log_probability(levels: np.ndarray, tokens: int, distinct: int, start_level: float) -> float:
    """log10 probability of a text from the levels of its tokens and bigrams."""
    n = len(levels) // 2
    return float(_log_terms(_COUNTS[levels[:n]], _COUNTS[levels[n:]], 0, tokens, distinct, start_level).sum())


def _log_terms(one: np.ndarray, two: np.ndarray, starts: np.ndarray | int, tokens: int, distinct: int, start_level: float) -> np.ndarray:
    """log10 probability of each token from its count and its bigram's; texts begin at ``starts``."""
    unigram = (one + 1) / (tokens + distinct + 1)
    before = np.empty(len(one))
    before[1:] = one[:-1]
    before[starts] = start_level
    # A quantised bigram can't be more frequent than its context.
    two = np.minimum(two, before)
    return np.log10((two + PRIOR * unigram) / (before + PRIOR))


def _asked(total: int, names: list[str]):
    """Per run of texts one row for each segment with the distinct n-grams of the run, and one for its texts.

    The latter has a segment below 0, the kept columns in ``docs``, the hashes of the run's tokens in ``ones`` (the
    most frequent first, as differences) and in ``twos`` the place of each token among these. A text is never cut.
    """

    def rows(tokens: list[np.ndarray], kept: list[pa.RecordBatch], number: int) -> Iterator[pa.RecordBatch]:
        lengths = np.array([len(t) for t in tokens])
        own = np.concatenate(tokens)
        twos, _ = _tallied([bigrams(own, np.cumsum(lengths) - lengths)])
        ones, at, times = np.unique(own, return_inverse=True, return_counts=True)
        ranked = np.argsort(-times, kind="stable")
        place = np.empty(len(ones), "<u4")
        place[ranked] = np.arange(len(ones), dtype="<u4")
        columns = {f.name: pa.chunked_array([b.column(f.name) for b in kept]).combine_chunks() for f in kept[0].schema}
        docs = pa.StructArray.from_arrays([*columns.values(), pa.array(lengths, pa.int64())], names=[*columns, "n_tokens"])
        docs = pa.ListArray.from_arrays(pa.array([0, len(docs)], pa.int32()), docs)
        none = pa.nulls(1, pa.binary())
        yield pa.record_batch(
            {
                "segment": pa.array([-1 - number % (2**31 - 1)], pa.int32()),
                "run": pa.array([number], pa.int64()),
                "ones": pa.array([_squeezed(np.diff(ones[ranked], prepend=np.uint64(0)).astype("<u8", copy=False))], pa.binary()),
                "ones_n": none,
                "twos": pa.array([_squeezed(place[at])], pa.binary()),
                "docs": docs,
            }
        )
        columns, asked = {}, np.zeros(total, bool)
        for name, values, size in (("ones", ones, 8), ("twos", twos, 6)):
            order, edges = _by_segment(values, total)
            asked |= np.diff(edges) > 0
            columns[name] = _binaries(*_packed(values[order], edges, size))
        batch = pa.record_batch(
            {
                "segment": pa.array(np.arange(total, dtype=np.int32)),
                "run": pa.array(np.full(total, number)),
                "ones": columns["ones"],
                "ones_n": pa.nulls(total, pa.binary()),
                "twos": columns["twos"],
                "docs": pa.nulls(total, docs.type),
            }
        )
        yield batch if asked.all() else batch.filter(pa.array(asked))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, number = WordHashes(CACHED_WORDS), TaskContext.get().partitionId() << 32
        tokens: list[np.ndarray] = []
        kept: list[pa.RecordBatch] = []
        size = held = 0
        for batch in text_slices(batches, SLICE_ROWS, SLICE_BYTES):
            tokens += [token_hashes(t, hashes) for t in text_bytes(batch.column("text"))]
            kept.append(batch.select(names))
            size += sum(len(t) for t in tokens[-batch.num_rows :])
            held += kept[-1].nbytes
            if size >= CHUNK_TOKENS or held >= KEPT_BYTES:
                yield from rows(tokens, kept, number)
                tokens, kept, number = [], [], number + 1
                size = held = 0
        if tokens:
            yield from rows(tokens, kept, number)

    return run


def _answered(total: int):
    """What was asked of a segment with the levels of the n-grams and the exact counts of the tokens; rows of texts as they are."""

    def run(asked: pa.Table, segment: pa.Table) -> pa.Table:
        if not asked.num_rows or asked.column("segment")[0].as_py() < 0:
            return asked
        number = asked.column("segment")[0].as_py()
        # A segment without n-grams was not built.
        built = segment.num_rows > 0
        held = Filter(joined([(number, segment.column("bits")[0].as_py())] if built else []), total)
        known, n = (segment.column(x)[0].values.to_numpy() if built else np.zeros(0, np.int64) for x in ("ngrams", "counts"))
        known = known.view(np.uint64)
        columns = {}
        for name, size in (("ones", 8), ("twos", 6)):
            raw = asked.column(name).to_pylist()
            edges = np.cumsum([0, *((len(x) - 8) // size for x in raw)])
            values, at = _distinct([_unpacked(raw, size)])
            columns[name] = _binaries(held.levels(values)[at], edges)
            if name == "ones":
                place = np.minimum(np.searchsorted(known, values), max(0, len(known) - 1))
                counts = np.where(known[place] == values, n[place], 0) if len(known) else np.zeros(len(values), np.int64)
                columns["ones_n"] = _binaries(counts[at].astype("<i8"), edges * 8)
        for name, values in columns.items():
            asked = asked.set_column(asked.schema.get_field_index(name), name, values)
        return asked

    return run


def _scored(total: int, names: list[str], tokens: int, distinct: int, start_level: float):
    """The scores of a run's texts from the answers of all segments."""

    def run(rows: pa.Table) -> pa.Table:
        segment = rows.column("segment").to_numpy()
        own = np.flatnonzero(segment < 0)
        if len(own) != 1:
            raise ValueError("a run of texts was made again with other texts")
        own = int(own[0])
        docs = rows.column("docs").slice(own, 1).combine_chunks().flatten()
        *columns, lengths = docs.flatten()
        lengths = lengths.to_numpy()
        ones = np.cumsum(_restored(rows.column("ones")[own].as_py(), "<u8"), dtype=np.uint64)
        at_one = _restored(rows.column("twos")[own].as_py(), "<u4")
        ends = np.cumsum(lengths)
        starts = ends - lengths
        twos, at_two = _distinct([bigrams(ones[at_one], starts)])
        ranked = np.argsort(ones)
        answers = [int(k) for k in np.argsort(segment) if k != own]

        def told(name: str, kind: str, order: np.ndarray) -> np.ndarray:
            column = rows.column(name)
            values = np.frombuffer(b"".join(column[k].as_py() for k in answers), kind)
            if len(values) != len(order):
                raise ValueError("a run of texts was made again with other texts")
            out = np.empty_like(values)
            out[order] = values
            return out

        by_one, by_two = ranked[_by_segment(ones[ranked], total)[0]], _by_segment(twos, total)[0]
        counts = told("ones_n", "<i8", by_one)
        terms = _log_terms(
            _COUNTS[told("ones", "u1", by_one)][at_one], _COUNTS[told("twos", "u1", by_two)][at_two], starts, tokens, distinct, start_level
        )
        logs = (np.log10(counts + 1.0) - math.log10(tokens + distinct + 1))[at_one]
        made = {
            "n_tokens": pa.array(lengths, pa.int64()),
            "n_known": pa.array(np.add.reduceat((counts > 0)[at_one], starts, dtype=np.int64)),
            "base_score": pa.array([float(logs[a:b].sum()) for a, b in zip(starts, ends)], pa.float64()),
            "score": pa.array([float(terms[a:b].sum()) for a, b in zip(starts, ends)], pa.float64()),
        }
        return pa.table(dict(zip(names, columns)) | made)

    return run


def _scored_apart(rows: DataFrame, model: Model, names: list[str], start_level: float) -> DataFrame:
    """``names`` and scores of ``rows`` (with text) where the filter's segments stay apart.

    Each distinct n-gram of a run of texts goes to its segment once and its level comes back, so what moves grows
    with the texts, not with texts times filter.
    """
    kept = [StructField(f.name, f.dataType) for f in rows.schema.fields if f.name in names]
    docs = ArrayType(StructType([*kept, StructField("n_tokens", LongType())]))
    kinds = {"segment": IntegerType(), "run": LongType(), "ones": BinaryType(), "ones_n": BinaryType(), "twos": BinaryType(), "docs": docs}
    schema = StructType([StructField(k, v) for k, v in kinds.items()])
    asked = rows.drop("levels").mapInArrow(_asked(model.total, names), schema)
    answered = asked.groupBy("segment").cogroup(model.segments.groupBy("segment")).applyInArrow(_answered(model.total), schema)
    made = "n_tokens bigint, n_known bigint, base_score double, score double"
    out = StructType([*kept, *StructType.fromDDL(made).fields])
    scored = answered.groupBy("run").applyInArrow(_scored(model.total, names, model.tokens, model.distinct, start_level), out)
    with small_batches(rows.sparkSession, BATCH_BYTES), shuffles_dropped(rows.sparkSession):
        return materialize(scored)


def score_texts(docs: DataFrame, model: Model, keep: list[Column], known: int = KNOWN_TOKENS, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """``keep`` columns of ``docs`` (doc_id, text) with n_tokens, n_known, train_tokens, base_score and score.

    ``n_known`` and ``base_score`` use exact counts: the ``known`` most frequent tokens are known to
    every task, the others are joined by their hash. Null texts are empty: one token, the end.
    Repeated rows come back as often as given; an empty table gives no rows. A filter beyond
    ``BROADCAST_BYTES`` answers run by run (``_scored_apart``), exact counts included.
    """
    spark = docs.sparkSession
    tokens, distinct, total = model.tokens, model.distinct, model.total
    start_level = float(count_of(level_of(np.array([model.texts])))[0])
    rows = docs.select(
        *keep, F.col("text").cast("string").alias("text"), F.lit(None).cast("binary").alias("levels")
    )
    names = [f.name for f in rows.schema.fields if f.name not in ("text", "levels")]
    made = ["n_tokens", "n_known", F.lit(tokens).cast("bigint").alias("train_tokens"), "base_score", "score"]
    size = _filter_bytes(model)
    if size > BROADCAST_BYTES:
        return _scored_apart(rows, model, names, start_level).select(*names, *made)
    frequent = np.array(most_frequent(model.unigrams, "ngram", known), np.int64).reshape(-1, 2)
    frequent = frequent[np.argsort(frequent[:, 0].view(np.uint64))]
    shared = spark.sparkContext.broadcast((frequent[:, 0].view(np.uint64).copy(), frequent[:, 1].astype(np.float64)))
    complete = model.distinct <= known
    shards = max(1, min(total, -(-size // shard_bytes)))
    for k in range(shards - 1):
        rows = _levels(rows, _shard(model, k, shards), model.total)
    last = spark.sparkContext.broadcast(_shard(model, shards - 1, shards))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, held = WordHashes(CACHED_WORDS), Filter(last.value, total)
        keys, counts = shared.value
        scale = math.log10(tokens + distinct + 1)
        for batch in text_slices(batches, SLICE_ROWS, SLICE_BYTES):
            columns: dict[str, list] = {k: [] for k in ("n_tokens", "n_known", "base_score", "score")}
            token_lists = [token_hashes(t, hashes) for t in text_bytes(batch.column("text"))]
            ones, at = _distinct(token_lists)
            level_lists = _merged(_looked_up(token_lists, (ones, at), held), batch.column("levels").to_pylist())
            place = np.minimum(np.searchsorted(keys, ones), max(0, len(keys) - 1))
            known_ones = keys[place] == ones if len(keys) else np.zeros(len(ones), bool)
            # Of each distinct token; without the join, an unknown one counts 0.
            logs = np.log10(np.where(known_ones, counts[place] if len(keys) else 0.0, 0.0) + 1) - scale
            end = 0
            for own, levels in zip(token_lists, level_lists):
                start, end = end, end + len(own)
                own_at = at[start:end]
                found = known_ones[own_at]
                columns["n_tokens"].append(len(own))
                columns["n_known"].append(int(found.sum()))
                columns["base_score"].append(float(logs[own_at if complete else own_at[found]].sum()))
                columns["score"].append(log_probability(levels, tokens, distinct, start_level))
            rest = _unknown(token_lists, ones, at, np.zeros_like(known_ones) if complete else ~known_ones)
            kinds = {"n_tokens": pa.int64(), "n_known": pa.int64(), "base_score": pa.float64(), "score": pa.float64()}
            made = {k: pa.array(v, kinds[k]) for k, v in columns.items()}
            yield pa.record_batch({n: batch.column(n) for n in names} | made | {"rest": rest})

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields if f.name in names)
    extra = "n_tokens bigint, n_known bigint, base_score double, score double"
    # Rows with the same unseen tokens share a key, so that each lot is joined once.
    lot = F.when(F.size("rest") > 0, F.struct(F.xxhash64("rest"), F.hash("rest")))
    with small_batches(spark, BATCH_BYTES):
        partial = materialize(rows.mapInArrow(run, f"{fields}, {extra}, rest {REST}").withColumn("lot", lot))
    last.destroy()
    shared.destroy()
    if complete:
        scored = partial
    else:
        lots = partial.where("lot is not null").groupBy("lot").agg(F.first("rest").alias("rest"))
        counts = model.unigrams.select("ngram", F.col("n").alias("c"))
        joined = lots.select("lot", F.explode("rest").alias("r")).select("lot", "r.ngram", F.col("r.n").alias("times")).join(counts, "ngram", "left")
        c = F.coalesce("c", F.lit(0))
        sums = joined.groupBy("lot").agg(
            F.sum(F.col("times") * (F.log10(c + 1) - F.lit(math.log10(tokens + distinct + 1)))).alias("more"),
            F.sum(F.when(c > 0, F.col("times")).otherwise(0)).alias("more_known"),
        )
        scored = partial.join(sums, "lot", "left").select(
            *names,
            "n_tokens",
            (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
            (F.col("base_score") + F.coalesce("more", F.lit(0.0))).alias("base_score"),
            "score",
        )
    return scored.select(*names, *made)
