"""Quality rules from counts in a text and from how far its make-up lies from that of its language.

A language is described by two histograms over all its documents: the shares of seven classes of
characters, and the shares of its most common words with one share for all others. A document's
own histograms are compared with those by the Jensen-Shannon distance (square root of the
divergence to base 2, 0 to 1), against the language that its words are nearest to, whatever its
label says. Lists without function words and texts strewn with symbols lie far from every
language; short texts, whose histograms are mostly chance, are not judged by them.

Everything is computed inside the rows that are read: the only rows that move are counts by
(language, word), of which at most ``COMMON_WORDS`` by language reach the driver.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleanwork.llm.ranking import most_frequent
from gleanwork.session import materialize

SPACE = r"[\x20\x09-\x0D]+"
# Words by which a language is known, and the longest that may be one, in code points.
COMMON_WORDS = 32
LONGEST_COMMON = 24
# Languages that get a histogram: at most so many, the largest first, and of so many words at least.
LANGUAGES = 64
LEAST_REFERENCE_WORDS = 5_000
# Guards: a text with fewer words or characters is not judged by the histogram in question.
MIN_WORDS = 50
MIN_CHARS = 200
# Largest distances of a text that is kept. Clean texts of 50 words reach 0.37 and 0.25 by chance.
WORD_LIMIT = 0.42
CLASS_LIMIT = 0.28
# Base rules.
BASE_WORDS = 50
BASE_REPEATED_PERCENT = 50
SYMBOLS = "#*$%&|<>"
# Characters that hardly any text is without, and the classes that are told apart among all others; what none picks is the last class.
FREQUENT = r"[a-z\x20\x09-\x0D]+"
CLASSES = (r"[A-Z]+", r"[0-9]+", r"[.,;:!?'\"()-]+", r"[\x00-\x08\x0E-\x1F#$%&*+/<=>@\[\\\]^_`{|}~\x7F]+")


@dataclass
class References:
    """Histograms by language: (language, words with their shares, shares of the classes)."""

    languages: list[tuple[str, dict[str, float], list[float]]]

    @property
    def words(self) -> list[str]:
        return sorted({word for _, words, _ in self.languages for word in words})


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often ``body`` and functions in it use it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words_of(text: Column) -> Column:
    """Runs of characters other than white space; none for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")


def common_form(word: Column) -> Column:
    """A word as it is compared with common words."""
    return F.lower(word)


def repeated_words(words: Column, width: int = 3) -> Column:
    """Words inside windows of ``width`` words that occur twice or more, the first occurrence included.

    Windows are compared by 64-bit hashes of their words. Sorting them brings equal ones together,
    so the time grows with n log n also where all words repeat.
    """

    def spread(at: Column) -> Column:
        steps = F.transform(at, lambda x, j: F.least(F.lit(width), F.coalesce(F.get(at, j + 1) - x, F.lit(width))))
        return F.aggregate(steps, F.lit(0).cast("bigint"), lambda total, x: total + x)

    def repeated(ranked: Column) -> Column:
        again = F.filter(
            ranked,
            lambda x, j: F.coalesce(F.get(ranked, j - 1)["h"] == x["h"], F.lit(False)) | F.coalesce(F.get(ranked, j + 1)["h"] == x["h"], F.lit(False)),
        )
        return let(F.sort_array(F.transform(again, lambda x: x["i"])), spread)

    def of_windows(hashes: Column) -> Column:
        ranked = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("bigint")).otherwise(let(ranked, repeated))

    def of_words(w: Column) -> Column:
        hashes = F.transform(w, lambda x, i: F.xxhash64(x, *(F.get(w, i + k) for k in range(1, width))))
        whole = F.slice(hashes, F.lit(1), F.greatest(F.size(w) - (width - 1), F.lit(0)))
        return let(whole, of_windows)

    return let(words, of_words)


def class_counts(text: Column, solid: Column, rare: Column) -> Column:
    """How many characters of each class a text holds: white space, a-z, those of ``CLASSES``, all others.

    ``solid`` is the text without white space and ``rare`` what ``FREQUENT`` leaves of it.
    """
    of_class = [F.length(rare) - F.length(F.regexp_replace(rare, pattern, "")) for pattern in CLASSES]
    others = F.length(F.regexp_replace(rare, r"[\x00-\x7F]+", ""))
    counts = (F.length(text) - F.length(solid), F.length(solid) - F.length(rare), *of_class, others)
    return F.array(*(n.cast("bigint") for n in counts))


def word_counts(words: Column, common: list[str]) -> Column:
    """``array<struct<word, n>>`` of those words that are in ``common``."""

    def counted(ranked: Column) -> Column:
        places = F.transform(ranked, lambda w, i: F.when(F.coalesce(F.get(ranked, i - 1) != w, F.lit(True)), i))
        starts = F.filter(places, lambda i: i.isNotNull())
        return let(
            starts,
            lambda at: F.transform(
                at,
                lambda b, j: F.struct(
                    F.get(ranked, b).alias("word"), (F.coalesce(F.get(at, j + 1), F.size(ranked)) - b).cast("bigint").alias("n")
                ),
            ),
        )

    found = F.filter(F.transform(words, common_form), lambda w: w.isin(common) if common else F.lit(False))
    return let(F.sort_array(found), counted)


def _lines(text: Column) -> Column:
    """\\n-split lines that hold a word."""
    return F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))


def measure(docs: DataFrame, common: list[str], keep: list[Column], text: str = "text", lang: str | None = "lang") -> DataFrame:
    """``keep`` and, by document, its label ``language``, the base measures and both histograms.

    Columns: ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words`` (long), ``classes``
    (counts by class), ``common`` (counts of the words in ``common``). Null text is empty text.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    label = F.coalesce(F.col(lang), F.lit("")) if lang else F.lit("")
    inner = {
        "__text": body,
        "__words": words_of(body),
        "__solid": F.regexp_replace(body, SPACE, ""),
        "__rare": F.regexp_replace(body, FREQUENT, ""),
    }
    split = docs.select(*keep, label.alias("language"), *(c.alias(name) for name, c in inner.items()))
    lines = let(_lines(F.col("__text")), lambda rows: F.size(rows) - F.size(F.array_distinct(rows)))
    symbols = F.length("__rare") - F.length(F.regexp_replace("__rare", f"[{SYMBOLS}]+", ""))
    return split.select(
        *(c for c in split.columns if c not in inner),
        F.size("__words").cast("bigint").alias("n_words"),
        F.length("__solid").cast("bigint").alias("word_chars"),
        symbols.cast("bigint").alias("n_symbols"),
        lines.cast("bigint").alias("n_dup_lines"),
        repeated_words(F.col("__words")).alias("n_repeat_words"),
        class_counts(F.col("__text"), F.col("__solid"), F.col("__rare")).alias("classes"),
        word_counts(F.col("__words"), common).alias("common"),
    )


def common_words(
    docs: DataFrame, size: int = COMMON_WORDS, languages: int = LANGUAGES, least: int = LEAST_REFERENCE_WORDS,
    text: str = "text", lang: str | None = "lang",
) -> dict[str, dict[str, float]]:
    """The ``size`` most frequent words of each language, with their shares of all its words.

    Counts cover every text. A common word holds a letter and at most ``LONGEST_COMMON`` code
    points; ties go to the smaller word. Documents without a label, and languages of less than
    ``least`` words, describe no language; where no other is left, all documents together do.
    """
    label = F.coalesce(F.col(lang), F.lit("")) if lang else F.lit("")
    words = docs.select(label.alias("language"), F.explode(words_of(F.col(text))).alias("word"))
    # Words that can't be common count in one row, so that they are part of the total.
    fit = (F.length("word") <= LONGEST_COMMON) & F.col("word").rlike(r"\p{L}")
    named = words.select("language", F.when(fit, common_form(F.col("word"))).otherwise("").alias("word"))
    counts = materialize(named.groupBy("language", "word").agg(F.count("*").alias("n")))
    totals = counts.where("language != ''").groupBy("language").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    largest = dict(most_frequent(totals, "language", languages))
    if largest:
        held = counts.where(F.col("language").isin(list(largest)))
    else:
        held = counts.groupBy("word").agg(F.sum("n").alias("n")).select(F.lit("").alias("language"), "word", "n")
        largest = {"": held.agg(F.sum("n")).first()[0] or 0}
    # Each task keeps its first ``size`` rows of a language before they move.
    order = Window.partitionBy("language").orderBy(F.desc("n"), "word")
    top = held.where("word != ''").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= size)
    shares: dict[str, dict[str, float]] = {language: {} for language, total in largest.items() if total}
    for row in top.orderBy("language", "rank").collect():
        shares[row["language"]][row["word"]] = row["n"] / largest[row["language"]]
    return shares


def _class_shares(measured: DataFrame, languages: list[str]) -> dict[str, list[float]]:
    """Shares of the classes of characters over all documents of each language."""
    rows = measured if languages == [""] else measured.where(F.col("language").isin(languages))
    key = F.lit("") if languages == [""] else F.col("language")
    sums = [F.sum(F.get("classes", F.lit(k))).alias(f"c{k}") for k in range(len(CLASSES) + 3)]
    found = {}
    for row in rows.groupBy(key.alias("key")).agg(*sums).collect():
        total = sum(row[1:])
        found[row["key"]] = [n / total for n in row[1:]] if total else [0.0] * len(sums)
    return found


def _part(p: Column, q: Column) -> Column:
    """What one entry adds to twice the divergence of p and q."""
    own = F.when(p > 0, p * F.log2(2 * p / (p + q))).otherwise(0.0)
    other = F.when(q > 0, q * F.log2(2 * q / (p + q))).otherwise(0.0)
    return own + other


def _distance(double_divergence: Column) -> Column:
    return F.sqrt(F.greatest(double_divergence / 2, F.lit(0.0)))


def word_distance(common: Column, n_words: Column, words: Column) -> Column:
    """Distance of a text's word histogram from ``words`` (map of shares; what is missing from 1 is all other words).

    Words of the language that the text lacks add their share, so only its own words are gone through.
    """
    shares = F.transform(common, lambda x: F.struct((x["n"] / n_words).alias("p"), F.try_element_at(words, x["word"]).alias("q")))

    def summed(rows: Column) -> Column:
        start = F.struct(F.lit(0.0).alias("sum"), F.lit(0.0).alias("p"), F.lit(0.0).alias("q"))
        return F.aggregate(
            F.filter(rows, lambda x: x["q"].isNotNull()),
            start,
            lambda a, x: F.struct((a["sum"] + _part(x["p"], x["q"])).alias("sum"), (a["p"] + x["p"]).alias("p"), (a["q"] + x["q"]).alias("q")),
        )

    def total(found: Column) -> Column:
        known = F.aggregate(F.map_values(words), F.lit(0.0), lambda a, q: a + q)
        return let(known, lambda k: found["sum"] + (k - found["q"]) + _part(F.greatest(1 - found["p"], F.lit(0.0)), F.greatest(1 - k, F.lit(0.0))))

    return _distance(let(let(shares, summed), total))


def class_distance(classes: Column, shares: Column) -> Column:
    """Distance of a text's class histogram from the shares of a language."""

    def summed(total: Column) -> Column:
        parts = F.zip_with(classes, shares, lambda n, q: _part(n / total, q))
        return F.aggregate(parts, F.lit(0.0), lambda a, x: a + x)

    return _distance(let(F.aggregate(classes, F.lit(0).cast("bigint"), lambda a, n: a + n).cast("double"), summed))


def nearest(references: References) -> Column:
    """``struct<word_distance, class_distance, language>`` of the nearest language; null without words or languages."""
    if not references.languages:
        return F.lit(None).cast("struct<word_distance:double,class_distance:double,language:string>")
    known = F.array(
        *(
            F.struct(
                F.lit(language).alias("language"),
                F.create_map(*(F.lit(x) for pair in words.items() for x in pair)).cast("map<string,double>").alias("words"),
                F.array(*map(F.lit, classes)).alias("classes"),
            )
            for language, words, classes in references.languages
        )
    )
    distances = F.transform(
        known,
        lambda r: F.struct(
            word_distance(F.col("common"), F.col("n_words"), r["words"]).alias("word_distance"),
            class_distance(F.col("classes"), r["classes"]).alias("class_distance"),
            r["language"].alias("language"),
        ),
    )
    return F.when(F.col("n_words") > 0, F.array_min(distances))


def base_failed(n_words: Column | str, n_repeat_words: Column | str) -> Column:
    n = F.col(n_words) if isinstance(n_words, str) else n_words
    repeated = F.col(n_repeat_words) if isinstance(n_repeat_words, str) else n_repeat_words
    return (n < BASE_WORDS) | (100 * repeated > BASE_REPEATED_PERCENT * n)


def judge(
    docs: DataFrame,
    keep: list[Column],
    word_limit: float = WORD_LIMIT,
    class_limit: float = CLASS_LIMIT,
    min_words: int = MIN_WORDS,
    min_chars: int = MIN_CHARS,
    least_reference: int = LEAST_REFERENCE_WORDS,
    text: str = "text",
    lang: str | None = "lang",
) -> DataFrame:
    """One row per row of ``docs``: ``keep``, the base measures, the distances and the verdict.

    Returns ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, nearest_language,
    word_distance, class_distance, base_failed, kept``. A text that fails a base rule is not
    kept; another is, unless it has ``min_words`` words and lies beyond ``word_limit``, or
    ``min_chars`` characters and lies beyond ``class_limit``. Null text is empty and fails;
    distances of texts without words are null; repeated rows are judged each for itself. An
    empty table gives no rows. A text whose label names a language that too few words describe is
    not judged by distances, since it is near none. Labels have no other part in a verdict.
    """
    shares = common_words(docs, least=least_reference, text=text, lang=lang)
    vocabulary = sorted({word for words in shares.values() for word in words})
    measured = materialize(measure(docs, vocabulary, keep, text, lang))
    classes = _class_shares(measured, list(shares))
    references = References([(name, words, classes[name]) for name, words in shares.items() if name in classes])
    names = [c for c in measured.columns if c not in ("language", "classes", "common")]
    near = measured.withColumn("__near", nearest(references))
    failed = base_failed("n_words", "n_repeat_words")
    n_chars = F.aggregate("classes", F.lit(0).cast("bigint"), lambda a, n: a + n)
    far_words = (F.col("n_words") >= min_words) & (F.col("__near.word_distance") > word_limit)
    far_classes = (n_chars >= min_chars) & (F.col("__near.class_distance") > class_limit)
    described = F.col("language").isin("", *shares) | F.lit("" in shares)
    far = described & (F.coalesce(far_words, F.lit(False)) | F.coalesce(far_classes, F.lit(False)))
    return near.select(
        *names,
        F.col("__near.language").alias("nearest_language"),
        F.col("__near.word_distance").alias("word_distance"),
        F.col("__near.class_distance").alias("class_distance"),
        failed.alias("base_failed"),
        (~failed & ~far).alias("kept"),
    )
