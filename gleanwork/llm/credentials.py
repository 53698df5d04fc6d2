"""Secret scans: fixed patterns, and guess cost of the values that stand in credential contexts.

The guess cost of a value is the least number of guesses (log10) over all ways to cut it into
dictionary words, dates, repeats, keyboard walks and brute-force spans: a dynamic programme over
prefix lengths. A value whose cost reaches ``min_cost`` is no prose and no placeholder, so it is
reported as a secret of kind ``guess``.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanwork.llm.ranking import most_frequent
from gleanwork.llm.tokens import slices
from gleanwork.session import materialize

# The kinds in their order, and the base patterns.
KINDS = ("assign", "access", "hex", "guess")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
# Whole runs only, so that runs that are too short are passed over as by a shorter pattern.
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
# Words that announce a credential, then a separator, then a value without blanks and quotes.
CONTEXT = re.compile(
    r"""(?:pass(?:word|wd|phrase|code)?|pwd|secret|token|api[_-]?key|access[_-]?key|private[_-]?key|credentials?|auth|bearer)"""
    r"""["']?(?:\x20*(?::=|=>|[:=])\x20*|\x20+is\x20+)["']?([^\s"'<>,;]+)""",
    re.IGNORECASE | re.ASCII,
)
# What people choose most, in order of rank.
COMMON = (
    "password 123456 qwerty letmein admin welcome login abc123 master dragon monkey secret changeme test guest root "
    "user pass default example none null true false todo redacted placeholder iloveyou sunshine football"
).split()
# Rows of a keyboard.
ROWS = ("1234567890", "qwertyuiop", "asdfghjkl", "zxcvbnm")
LEET = str.maketrans({"4": "a", "@": "a", "3": "e", "1": "l", "!": "i", "0": "o", "$": "s", "5": "s", "7": "t"})
_YEAR, _MONTH, _DAY, _SEP = r"(?:19|20)\d\d", r"(?:0[1-9]|1[0-2])", r"(?:0[1-9]|[12]\d|3[01])", r"[-/._]?"
DATES = tuple(
    re.compile(_SEP.join(parts), re.ASCII) for parts in ((_YEAR, _MONTH, _DAY), (_DAY, _MONTH, _YEAR), (_YEAR,))
)
DATE_COST = math.log10(365 * 120)
LONGEST_WORD = 24
DICTIONARY_WORDS = 20_000
# Characters of a repeat or walk at whose ends a cut is tried from one start, and units before the end of the run.
LONGEST_RUN = 24
MIN_COST = 9.0
_STEP = {(a, b) for row in ROWS for a, b in zip(row, row[1:])}
_STEP |= {(b, a) for a, b in _STEP}


def _class_size(char: str) -> int:
    return 10 if char.isdigit() else 26 if char.isascii() and char.isalpha() else 33 if char.isascii() else 100


def _run_ends(n: int, linked) -> list[int]:
    """For each place the end of the longest run from it in which every place is ``linked`` to the next."""
    ends = [n] * n
    for i in range(n - 2, -1, -1):
        ends[i] = ends[i + 1] if linked(i) else i + 1
    return ends


def _ends(start: int, unit: int, least: int, most: int) -> list[int]:
    """Ends of ``least`` to ``most`` units from ``start``: within ``LONGEST_RUN`` characters, and the last units.

    Between those a cut gains nothing: it would be followed by spans inside the run. As many of
    them as make up whole units cost more than a run that is longer by those units, and a walk or
    repeat inside is cheaper if either is as short as it can be.
    """
    near = min(most, LONGEST_RUN // unit)
    late = range(max(least, near + 1, most - LONGEST_RUN), most + 1)
    return [start + unit * k for k in (*range(least, near + 1), *late)]


def segments(value: str, ranks: dict[str, int]) -> tuple[float, list[tuple[str, int, int]]]:
    """(log10 guesses, cheapest cut) of a value; the cut lists (kind, start, end).

    The cut is the cheapest of all cuts into spans of any kind, wherever they start and end. In
    long runs a repeat or walk is tried with early and late ends only, which keeps the work linear
    in the value (see ``_ends``; a repeat in mixed case may lose a cheaper word in its middle).
    Ties keep the earlier kind.
    """
    n = len(value)
    low = value.lower() if len(value.lower()) == n else value
    plain = low.translate(LEET)
    # log10 of the alphabet of the whole value: a brute-force guesser would have to assume it.
    sizes = {_class_size(c) if not (c.isascii() and c.isalpha()) else (26, c.isupper()) for c in value}
    alphabet = math.log10(max(10, sum(s if isinstance(s, int) else s[0] for s in sizes)))
    best, back = [0.0] + [math.inf] * n, [("", 0)] * (n + 1)

    def offer(start: int, end: int, cost: float, kind: str) -> None:
        if best[start] + cost < best[end] - 1e-12:
            best[end], back[end] = best[start] + cost, (kind, start)

    walks = _run_ends(n, lambda i: (low[i], low[i + 1]) in _STEP)
    repeats = {b: _run_ends(n, lambda i: i + b < n and low[i] == low[i + b]) for b in (1, 2, 3, 4)}
    for start in range(n):
        for end in range(start + 2, min(n, start + LONGEST_WORD) + 1):
            if (rank := ranks.get(low[start:end])) is not None:
                shape = value[start:end]
                extra = 0.0 if shape == low[start:end] else math.log10(2) if shape.isupper() or shape.istitle() else math.log10(2 ** min(16, len(shape)))
                offer(start, end, math.log10(rank + 1) + extra, "word")
            if plain != low and (leet := ranks.get(plain[start:end])) is not None:
                offer(start, end, math.log10(leet + 1) + 1, "word")
        if low[start].isdigit():
            for form in DATES:
                if m := form.match(low, start):
                    offer(start, m.end(), DATE_COST, "date")
        for block, ends in repeats.items():
            # A block written again and again: abcabcabc. One character makes a repeat from three on.
            if block > 1 and repeats[1][start] >= start + block:
                continue
            whole = (ends[start] - 1 - start) // block + 1
            for end in _ends(start, block, 3 if block == 1 else 2, whole):
                offer(start, end, block * alphabet + math.log10(end - start), "repeat")
        for end in _ends(start, 1, 3, walks[start] - start):
            offer(start, end, math.log10(94) + math.log10(end - start) + 0.5, "walk")
        offer(start, start + 1, alphabet, "brute")
    cut, end = [], n
    while end:
        kind, start = back[end]
        if cut and cut[-1][0] == kind == "brute":
            cut[-1] = (kind, start, cut[-1][2])
        else:
            cut.append((kind, start, end))
        end = start
    return best[n], cut[::-1]


def scan(text: str, ranks: dict[str, int], min_cost: float = MIN_COST) -> list[tuple[int, str, int, int, float | None]]:
    """Spans (start, kind, end, cost) of one whole text, in report order."""
    found = []
    for m in ASSIGN.finditer(text):
        if m.end(2) - m.start(2) >= 6:
            found.append((m.start(), 0, m.end(), None))
    found += [(m.start(), 1, m.end(), None) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end(), None) for m in HEX.finditer(text)]
    for m in CONTEXT.finditer(text):
        cost, _ = segments(m[1].rstrip(".:!?)"), ranks)
        if cost >= min_cost:
            found.append((m.start(1), 3, m.start(1) + len(m[1].rstrip(".:!?)")), cost))
    return [(start, KINDS[kind], end, cost) for start, kind, end, cost in sorted(found, key=lambda x: x[:3])]


def word_ranks(docs: DataFrame, size: int = DICTIONARY_WORDS, text: str = "text") -> dict[str, int]:
    """Rank of the ``size`` most frequent words of all texts, after the common passwords.

    Counts cover every text; only the ranked list (``size`` short words) reaches the driver. Words
    are runs of letters, lower-cased; ties go to the smaller word.
    """
    words = docs.select(F.explode(F.split(F.lower(F.col(text)), r"[^\p{L}]+")).alias("word"))
    fit = words.where(F.length("word").between(3, LONGEST_WORD))
    # Stored, since it is read twice.
    counts = materialize(fit.groupBy("word").agg(F.count("*").alias("n")))
    ranks = {word: rank for rank, word in enumerate(COMMON, 1)}
    for word, _ in most_frequent(counts, "word", size):
        ranks.setdefault(word, len(ranks) + 1)
    return ranks


SPANS = "array<struct<start:int,kind:string,end:int,cost:double>>"


def find_secrets(
    docs: DataFrame, ranks: dict[str, int], min_cost: float = MIN_COST, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """doc_id, text, spans (start, kind, end, cost) for every document, whole text.

    Offsets are code points, end exclusive, in order of start, then kind, then end. A null or
    empty text has no spans; null ids and repeated rows come back as they are; an empty table
    gives no rows. Other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        kind = pa.list_(
            pa.struct([("start", pa.int32()), ("kind", pa.string()), ("end", pa.int32()), ("cost", pa.float64())])
        )
        for batch in slices(batches, 2_000):
            spans = [
                [{"start": s, "kind": k, "end": e, "cost": c} for s, k, e, c in scan(t or "", known, min_cost)]
                for t in batch.column("text").to_pylist()
            ]
            yield pa.record_batch({"doc_id": batch.column("doc_id"), "text": batch.column("text"), "spans": pa.array(spans, kind)})

    source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    return source.mapInArrow(run, f"doc_id {source.schema['doc_id'].dataType.simpleString()}, text string, spans {SPANS}")


def digest(found: DataFrame) -> DataFrame:
    """Counts per kind and the joined spans, from what :func:`find_secrets` returns."""

    def joined(spans):
        parts = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
        return F.array_join(parts, ",")

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint")

    base = F.filter("spans", lambda s: s["kind"] != "guess")
    return found.select(
        "doc_id",
        count("assign").alias("n_assign"),
        count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
        count("guess").alias("n_guess"),
    )


def redact(docs: DataFrame, ranks: dict[str, int], mark: str = "[SECRET]", doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with every secret of ``text`` replaced by ``mark``; overlapping spans merge into one.

    All columns are kept as they are; a null text stays null. For spans of kind ``assign`` only
    the value goes, so that the surrounding words stay readable.
    """
    shared = docs.sparkSession.sparkContext.broadcast(ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in slices(batches, 2_000):
            place = batch.schema.get_field_index(text)
            clean = [None if t is None else redacted(t, known, mark) for t in batch.column(place).to_pylist()]
            yield batch.set_column(place, batch.schema.field(place), pa.array(clean, batch.schema.field(place).type))

    return docs.mapInArrow(run, docs.schema)


def redacted(text: str, ranks: dict[str, int], mark: str) -> str:
    """One text without its secrets."""
    spans = []
    for start, kind, end, _ in scan(text, ranks):
        if kind == "assign":
            start = ASSIGN.match(text, start).start(2)
        spans.append((start, end))
    out, at = [], 0
    for start, end in sorted(spans):
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join([*out, text[at:]])
