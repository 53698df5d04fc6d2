"""Benchmark decontamination by Wu-Manber search over words.

Patterns are windows of ``WINDOW`` consecutive words of benchmark items (a shorter item is one
window). Per pattern length there is a shift table over blocks of two words: how far the search
may jump when a block ends at the current word. Where the shift is zero, the bucket of that block
holds the patterns that end with it, and words are compared directly.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanwork.llm.tokens import slices, text_bytes
from gleanwork.session import materialize

WINDOW = 13
# Benchmark bytes of text held by one worker at a time; a larger benchmark is searched in blocks.
BLOCK_BYTES = 8_000_000
# Every byte of a word maps to itself or its small letter, the others to a blank.
_WORD = {*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)}
FOLD = bytes((b + 32 if 0x41 <= b <= 0x5A else b) if b in _WORD else 0x20 for b in range(256))


def words(text: bytes | None) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z lower-cased."""
    return text.translate(FOLD).split() if text else []


class WuManber:
    """Search tables for windows (tuples of words) of one length."""

    def __init__(self, windows: dict[tuple[bytes, ...], list[int]], length: int) -> None:
        self.length, self.block = length, min(2, length)
        self.leap = length - self.block + 1
        self.shift: dict[tuple[bytes, ...], int] = {}
        self.buckets: dict[tuple[bytes, ...], list] = defaultdict(list)
        for window, items in windows.items():
            for end in range(self.block, length + 1):
                key, left = window[end - self.block : end], length - end
                self.shift[key] = min(left, self.shift.get(key, self.leap))
            self.buckets[window[length - self.block :]].append((window, items))
        # Within a bucket, by first word: one comparison usually decides.
        self.buckets = {
            key: {first: [x for x in rows if x[0][0] == first] for first in {x[0][0] for x in rows}}
            for key, rows in self.buckets.items()
        }

    def search(self, text: list[bytes]) -> Iterator[tuple[int, list[int]]]:
        """(start, items) of every occurrence, left to right."""
        length, leap, shift, block, n = self.length, self.leap, self.shift, self.block, len(text)
        end = length
        while end <= n:
            key = (text[end - 2], text[end - 1]) if block == 2 else (text[end - 1],)
            jump = shift.get(key, leap)
            if jump:
                end += jump
                continue
            start = end - length
            for window, items in self.buckets[key].get(text[start], ()):
                if window == tuple(text[start:end]):
                    yield start, items
            end += 1


def tables(items: list[tuple[str, bytes]]) -> tuple[list[WuManber], list[str]]:
    """Search tables of (id, text) items, one per window length, and the distinct ids."""
    names: dict[str, int] = {}
    by_length: dict[int, dict] = defaultdict(lambda: defaultdict(list))
    for name, text in items:
        tokens = words(text)
        length = min(WINDOW, len(tokens))
        if not length:
            continue
        number = names.setdefault(name, len(names))
        for start in range(len(tokens) - length + 1):
            owners = by_length[length][tuple(tokens[start : start + length])]
            if number not in owners:
                owners.append(number)
    return [WuManber(dict(windows), length) for length, windows in sorted(by_length.items())], list(names)


def hits(text: list[bytes], searches: list[WuManber]) -> tuple[list[tuple[int, int]], set[int]]:
    """Merged word intervals inside any occurrence, and the items that occur."""
    spans, items = [], set()
    for search in searches:
        for start, owners in search.search(text):
            spans.append((start, start + search.length))
            items.update(owners)
    return merged(spans), items


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Disjoint intervals that cover the same words."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def _items(benchmark: DataFrame) -> DataFrame:
    return benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), F.col("text").cast("string"))


def _block_count(items: DataFrame, size: int) -> int:
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(1, -(-total // size))


def _block(items: DataFrame, k: int, count: int) -> list[tuple[str, bytes]]:
    """One of ``count`` blocks of items, fetched when it is needed."""
    number = F.pmod(F.xxhash64("item_id", "text"), F.lit(count))
    rows = (items if count == 1 else items.where(number == k)).collect()
    return [(r["item_id"], (r["text"] or "").encode()) for r in rows]


SPANS = "array<struct<start:int,end:int>>"
SPAN_TYPE = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def _search(rows: DataFrame, items: list[tuple[str, bytes]]) -> DataFrame:
    """The ``__key`` columns, n_words, hit spans and occurring items of each row."""
    shared = rows.sparkSession.sparkContext.broadcast(items)
    carried = [c for c in rows.columns if c != "__text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searches, names = tables(shared.value)
        for batch in slices(batches, 2_000):
            counts, spans, found = [], [], []
            for raw in text_bytes(batch.column("__text")):
                tokens = words(raw)
                where, which = hits(tokens, searches)
                counts.append(len(tokens))
                spans.append([{"start": s, "end": e} for s, e in where])
                found.append([names[k] for k in which])
            columns = {c: batch.column(c) for c in carried}
            columns |= {
                "n_words": pa.array(counts, pa.int64()),
                "spans": pa.array(spans, SPAN_TYPE),
                "items": pa.array(found, pa.list_(pa.string())),
            }
            yield pa.record_batch(columns)

    kinds = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in carried)
    return rows.mapInArrow(run, f"{kinds}, n_words bigint, spans {SPANS}, items array<string>")


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """doc_id, n_words, spans (disjoint word intervals inside occurrences), items (sorted) per document.

    Defined results: null and empty texts have no words; an item without words never occurs; an
    item with a null id counts under the id ``""``; repeated items count once, repeated documents
    come back as often as they are given; an empty benchmark hits nothing. Other columns are ignored.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("__text"))
    items = _items(benchmark)
    count = _block_count(items, block_bytes)
    if count == 1:
        found = _search(rows, _block(items, 0, 1))
    else:
        # Equal ids and texts have equal results, so they may share a key.
        keyed = rows.withColumn("__key", F.xxhash64("doc_id", "__text"))
        first = materialize(_search(keyed, _block(items, 0, count)))
        more = [
            materialize(
                _search(keyed, _block(items, k, count)).where("size(spans) > 0").select("__key", "spans", "items").dropDuplicates(["__key"])
            )
            for k in range(1, count)
        ]
        found = _merge(first, more)
    return found.select("doc_id", "n_words", "spans", F.array_sort(F.array_distinct("items")).alias("items"))


def uncontaminated(docs: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``docs`` (doc_id, text) of which less than 5 % of the words are hit.

    With a benchmark of one block the rows are filtered where they are read.
    """
    items = _items(benchmark)
    if _block_count(items, block_bytes) > 1:
        key = F.xxhash64("doc_id", "text")
        bad = digest(contamination(docs.select(key.alias("key"), "text"), benchmark, "key", "text", block_bytes))
        named = bad.where("contaminated").select(F.col("doc_id").alias("__key")).distinct()
        return docs.join(named, key == F.col("__key"), "left_anti")
    shared = docs.sparkSession.sparkContext.broadcast(_block(items, 0, 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searches, _ = tables(shared.value)
        for batch in slices(batches, 2_000):
            good = []
            for raw in text_bytes(batch.column("text")):
                tokens = words(raw)
                spans, _ = hits(tokens, searches)
                good.append(not is_contaminated(sum(e - s for s, e in spans), len(tokens)))
            yield batch.filter(pa.array(good, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def is_contaminated(n_hit, n_words):
    """The verdict for numbers or columns: some words are hit, and at least 5 % of all."""
    return (n_hit > 0) & (n_hit * 20 >= n_words)


def _merge(first: DataFrame, others: list[DataFrame]) -> DataFrame:
    """Union of the spans and items that the blocks of a large benchmark found in each document."""
    more = others[0]
    for other in others[1:]:
        more = more.unionByName(other)
    # At most one row per key and block.
    more = more.groupBy("__key").agg(
        F.flatten(F.collect_list("spans")).alias("__spans"), F.flatten(F.collect_list("items")).alias("__items")
    )
    both = first.join(more, "__key", "left")
    all_spans = F.array_sort(F.concat("spans", F.coalesce("__spans", F.expr(f"cast(array() as {SPANS})"))))
    union = F.reduce(
        all_spans,
        F.expr(f"cast(array() as {SPANS})"),
        lambda done, s: F.when(
            (F.size(done) > 0) & (s["start"] <= F.element_at(done, -1)["end"]),
            F.concat(
                F.slice(done, 1, F.size(done) - 1),
                F.array(
                    F.struct(
                        F.element_at(done, -1)["start"].alias("start"),
                        F.greatest(F.element_at(done, -1)["end"], s["end"]).alias("end"),
                    )
                ),
            ),
        ).otherwise(F.concat(done, F.array(s))),
    )
    return both.select(
        "doc_id",
        "n_words",
        union.alias("spans"),
        F.concat("items", F.coalesce("__items", F.expr("cast(array() as array<string>)"))).alias("items"),
    )


def digest(found: DataFrame) -> DataFrame:
    """Counts, item digest and the verdict: contaminated when at least 5 % of the words are hit."""
    n_hit = F.reduce("spans", F.lit(0), lambda total, s: total + s["end"] - s["start"]).cast("bigint")
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), F.col("items")).select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        is_contaminated(F.col("n_hit"), F.col("n_words")).alias("contaminated"),
    )
