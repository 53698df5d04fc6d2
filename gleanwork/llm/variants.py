"""Spelling variants: words one edit apart, found by composing acceptors of the vocabulary with a one-edit transducer.

Two words that differ by one inserted, deleted or replaced code point agree before and after it.
Places of the edit are cut into windows; a word is dealt, for each window, to the key of what
surrounds the window, and a pair meets exactly under the window that holds the end of its common
beginning. The words of one key become a minimised acceptor of the part inside the window, whose
initial state is the one the common beginning leads to. Acceptor, transducer and acceptor are
composed lazily from that state and accepted pairs are read off. A key with many words has its
window halved until its words are few, or one code point is left, under which no more than the
alphabet meet: no task ever holds a large group, and no pair is lost.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanwork.session import materialize

LETTERS = r"[A-Za-zÀ-ÿ]"
LEAST_LENGTH = 7
LEAST_COUNT = 2
# A word's form occurs so many times as often as the word.
DOMINANCE = 10
# Words under one key beyond which its window is halved: the memory of an acceptor, no limit to pairs.
GROUP_WORDS = 20_000
# Occurrences (by hash of document and run) that lose one code point: one in so many.
NOISE = 31
KEY = ["c", "a", "b", "before", "after"]


# ------------------------------------------------------------------ words


def runs(docs: DataFrame, least: int = LEAST_LENGTH, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``id`` (as text) and ``run`` for all maximal runs of letters of ``least`` code points or more, A-Z lower-cased.

    Only A-Z: other capitals stay. A null id is empty text.
    """
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    folded = F.translate(F.col(text), upper, upper.lower())
    found = F.regexp_extract_all(folded, F.lit(f"{LETTERS}{{{least},}}"), F.lit(0))
    return docs.select(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("id"), F.explode(found).alias("run"))


def with_slips(found: DataFrame) -> Column:
    """The run, or for one occurrence in ``NOISE`` the run less one code point, both by the crc32 of ``id:run``."""
    hashed = F.crc32(F.concat_ws(":", "id", "run"))
    place = (hashed % F.length("run")).cast("int")
    cut = F.concat(F.substring(F.col("run"), F.lit(1), place), F.substring(F.col("run"), place + 2, F.length("run")))
    return F.when(hashed % NOISE == 0, cut).otherwise(F.col("run"))


def vocabulary(words: DataFrame, least: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """``word, n`` of all words (column ``word``) of enough code points and occurrences."""
    return words.where(F.length("word") >= least).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_count)


# ------------------------------------------------------------------ acceptors


class Acceptor:
    """Minimised deterministic acceptors of sorted words; those of one register share equal states.

    A state is a tuple (accepts, ((label, state), ...)) that exists once, so equal right languages
    are one object.
    """

    def __init__(self) -> None:
        self.register: dict[tuple, tuple] = {}
        self.languages: dict[int, tuple[str, ...]] = {}
        self.shared: dict[tuple[int, int], tuple[str, ...]] = {}

    def state(self, accepts: bool, arcs: tuple) -> tuple:
        key = (accepts, tuple((label, id(target)) for label, target in arcs))
        return self.register.setdefault(key, (accepts, arcs))

    def of(self, words: list[str]) -> tuple:
        """The initial state for distinct words in ascending order."""
        # Open states along the last word; a state is closed, and looked up, once no later word passes it.
        path: list[list] = [[False, []]]
        last = ""
        for word in words:
            same = 0
            while same < len(last) and same < len(word) and last[same] == word[same]:
                same += 1
            self._close(path, last, same)
            for _ in word[same:]:
                path.append([False, []])
            path[-1][0] = True
            last = word
        self._close(path, last, 0)
        return self.state(path[0][0], tuple(path[0][1]))

    def _close(self, path: list[list], word: str, depth: int) -> None:
        while len(path) > depth + 1:
            accepts, arcs = path.pop()
            path[-1][1].append((word[len(path) - 1], self.state(accepts, tuple(arcs))))

    def language(self, state: tuple) -> tuple[str, ...]:
        """All words accepted from a state."""
        found = self.languages.get(id(state))
        if found is None:
            rest = (label + word for label, target in state[1] for word in self.language(target))
            found = self.languages[id(state)] = (("",) if state[0] else ()) + tuple(rest)
        return found

    def common(self, one: tuple, other: tuple) -> tuple[str, ...]:
        """All words accepted from both states: the transducer after its edit copies what it reads."""
        if one is other:
            return self.language(one)
        key = (id(one), id(other)) if id(one) < id(other) else (id(other), id(one))
        found = self.shared.get(key)
        if found is None:
            arcs = dict(other[1])
            rest = (label + word for label, target in one[1] if label in arcs for word in self.common(target, arcs[label]))
            found = self.shared[key] = (("",) if one[0] and other[0] else ()) + tuple(rest)
        return found


def composed(acceptor: Acceptor, short: tuple, long: tuple, width: int) -> Iterator[tuple[str, str]]:
    """Pairs that short ∘ edit ∘ (short or long) accepts, with fewer than ``width`` code points before the edit.

    Before its edit the transducer copies, so both acceptors have read the same. The edit replaces
    a label (both words from ``short``, each pair once) or inserts one into a word of ``short``.
    An inserted label may not equal the one after it, so that every pair is accepted along one path.
    """
    start = acceptor.state(False, ())
    stack = [("", short, long)]
    while stack:
        read, one, other = stack.pop()
        for k, (label, target) in enumerate(one[1]):
            for second, changed in one[1][k + 1 :]:
                for rest in acceptor.common(target, changed):
                    yield read + label + rest, read + second + rest
        for label, target in other[1]:
            for rest in acceptor.common(one, target):
                if not rest.startswith(label):
                    yield read + rest, read + label + rest
        if len(read) + 1 < width:
            arcs = dict(other[1])
            stack.extend((read + label, target, arcs.get(label, start)) for label, target in one[1])


def _paired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by key → both directions of every pair: ``word, near, n`` (the count of ``near``)."""
    names = [*KEY, "word", "n"]

    def rows() -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*(batch.column(c).to_pylist() for c in names), strict=True)

    out: list[tuple[str, str, int]] = []
    for (c, a, b, _, after), group in groupby(rows(), key=lambda r: r[:5]):
        members = [(r[5], r[6]) for r in group]
        if len(members) < 2:
            continue
        # Only what lies inside the window differs.
        head, tail = members[0][0][:a], len(after)
        inner = {word[a : len(word) - tail]: n for word, n in members}
        sizes = c - a - tail
        short, long = sorted(w for w in inner if len(w) == sizes), sorted(w for w in inner if len(w) > sizes)
        acceptor = Acceptor()
        for one, other in composed(acceptor, acceptor.of(short), acceptor.of(long), b - a):
            out.append((head + one + after, head + other + after, inner[other]))
            out.append((head + other + after, head + one + after, inner[one]))
        if len(out) >= 10_000:
            yield _batch(out)
            out = []
    if out:
        yield _batch(out)


def _batch(rows: list[tuple[str, str, int]]) -> pa.RecordBatch:
    word, near, n = zip(*rows, strict=True)
    return pa.RecordBatch.from_pydict({"word": pa.array(word, pa.string()), "near": pa.array(near, pa.string()), "n": pa.array(n, pa.int64())})


# ------------------------------------------------------------------ pairs


def _windows(words: DataFrame, least: int) -> DataFrame:
    """Each word for the pairs whose shorter word has its length, and for those where that is one less; two windows each."""
    size = F.length("word")
    classes = F.explode(F.when(size > least, F.array(size, size - 1)).otherwise(F.array(size))).alias("c")
    both = words.select("word", "n", classes)
    half = F.floor(F.col("c") / 2).cast("int")
    cuts = F.array(F.struct(F.lit(0).alias("a"), half.alias("b")), F.struct(half.alias("a"), (F.col("c") + 1).alias("b")))
    return both.select("word", "n", "c", F.explode(cuts).alias("w")).select("word", "n", "c", "w.a", "w.b")


def _keyed(rows: DataFrame) -> DataFrame:
    """What lies before the window, and after it in the shorter word."""
    after = F.greatest(F.col("c") - F.col("b"), F.lit(0))
    ending = F.substring(F.col("word"), F.length("word") - after + 1, after)
    return rows.select("word", "n", "c", "a", "b", F.substring(F.col("word"), F.lit(1), F.col("a")).alias("before"), ending.alias("after"))


def near_pairs(words: DataFrame, least: int = LEAST_LENGTH, group_words: int = GROUP_WORDS) -> DataFrame:
    """``word, near, n`` for every two distinct words one edit apart, in both directions; ``n`` is that of ``near``.

    ``words`` holds distinct words of ``least`` code points or more, and their ``n``.
    """
    rows = _keyed(_windows(words, least))
    while True:
        held = rows.groupBy(*KEY).count().where((F.col("count") > group_words) & (F.col("b") - F.col("a") > 1))
        hot = materialize(held.select(*KEY, F.lit(True).alias("hot")))
        if hot.isEmpty():
            break
        # Few keys hold more than ``group_words`` rows, so the planner broadcasts them or splits the skew.
        middle = F.floor((F.col("a") + F.col("b")) / 2).cast("int")
        halves = F.array(F.struct(F.col("a"), middle.alias("b")), F.struct(middle.alias("a"), F.col("b")))
        cut = F.when(F.col("hot"), halves).otherwise(F.array(F.struct("a", "b")))
        split = rows.join(hot, KEY, "left").select("word", "n", "c", F.explode(cut).alias("w"))
        rows = materialize(_keyed(split.select("word", "n", "c", "w.a", "w.b")))
    dealt = rows.repartition(*KEY).sortWithinPartitions(*KEY, "word")
    return dealt.mapInArrow(_paired, "word string, near string, n long")


# ------------------------------------------------------------------ forms


def _roots(forms: DataFrame) -> DataFrame:
    """``word, root``: the last word that forms lead to. Counts grow tenfold a step, so a few doublings end it."""
    known = materialize(forms.select("word", F.col("form").alias("root")))
    while True:
        further = known.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = materialize(known.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        known = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return known


def variant_groups(words: DataFrame, least: int = LEAST_LENGTH, dominance: int = DOMINANCE, group_words: int = GROUP_WORDS) -> DataFrame:
    """One row by word of a vocabulary (``word, n``): ``word, form, root, n, n_near, form_n``.

    ``n_near`` counts the words one edit apart (0 if none). ``form`` is the one of largest n (ties:
    the smallest in code-point order) if it occurs at least ``dominance`` times as often, else
    null. ``root`` is reached by following forms; a word without a form is its own. An empty
    vocabulary gives no rows.
    """
    stored = materialize(words.select("word", F.col("n").cast("bigint").alias("n")))
    best = near_pairs(stored, least, group_words).groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("n")).alias("less"), F.col("near").alias("form"))).alias("best")
    )
    joined = stored.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"), F.col("best.form").alias("form"), (-F.col("best.less")).alias("form_n")
    )
    dominant = F.col("form_n") >= dominance * F.col("n")
    found = materialize(
        joined.select("word", "n", "n_near", F.when(dominant, F.col("form")).alias("form"), F.when(dominant, F.col("form_n")).alias("form_n"))
    )
    roots = _roots(found.where("form IS NOT NULL"))
    return found.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", group_words: int = GROUP_WORDS) -> DataFrame:
    """Variant groups of the words of all texts, some of which lose a code point on the way (see ``with_slips``).

    Null and empty texts have no words; repeated rows count as often as they occur; a null id
    counts as empty text. Other columns are not read.
    """
    found = runs(docs, doc_id=doc_id, text=text)
    return variant_groups(vocabulary(found.select(with_slips(found).alias("word"))), group_words=group_words)
