"""Term matchers: which named patterns occur in a file name or a body."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# A word character as the curated term lists understand it: letters, numbers, underscore.
WORD = r"[\p{L}\p{N}_]"


@dataclass(frozen=True)
class Term:
    """A named pattern: a literal stem, then an optional regular-expression tail."""

    name: str
    stem: str
    tail: str = ""
    whole_word: bool = False

    def regex(self) -> str:
        """Java pattern over folded text.

        The literal stem leads: the engine then skips through the text by it, and tail and
        look-behind only run on its hits.
        """
        stem = re.escape(self.stem)
        if not self.whole_word:
            return stem + self.tail
        return f"{stem}(?<!{WORD}{stem}){self.tail}(?!{WORD})"


def _words(*specs: tuple[str, str]) -> tuple[Term, ...]:
    return tuple(Term(stem, stem, tail, whole_word=True) for stem, tail in specs)


# The default file-name terms, matched anywhere in the base name.
FILENAME_TERMS = (
    Term("readme", "readme"),
    Term("contributing", "contributing"),
    Term("agents", "agents"),
    Term("claude", "claude"),
    Term("copilot-instructions", "copilot-instructions"),
    Term("style", "style"),
    Term("guide", "guide", "s?(?!line)"),
    Term("guideline", "guideline"),
    Term("standard", "standard"),
    Term("convention", "convention"),
    Term("rule", "rule"),
    Term("develop", "develop"),
    Term("architecture", "architecture"),
    Term("design", "design"),
    Term("coding", "coding"),
    Term("hacking", "hacking"),
)
# The default body terms, matched as whole words.
CONTENT_TERMS = _words(
    ("style", "s?"),
    ("guide", "s?"),
    ("guideline", "s?"),
    ("standard", "s?"),
    ("convention", "s?"),
    ("rule", "s?"),
    ("architecture", "s?"),
    ("design", "s?"),
    ("develop", "[a-z]*"),
)
# The six singular/plural keywords of the older body filter.
KEYWORD_TERMS = _words(*((word, "s?") for word in ("style", "guide", "guideline", "standard", "convention", "rule")))


def word_terms(*specs: tuple[str, str]) -> tuple[Term, ...]:
    """Build whole-word terms from ``(stem, tail)`` pairs."""
    return _words(*specs)


# Letters outside ASCII that match an ASCII letter when case is ignored, beyond what
# lower-casing already folds.
SPECIAL_LETTERS = {"İ": "i", "ı": "i", "ſ": "s"}


def folded(text: Column | str) -> Column:
    """Text in lower case with the few special letters replaced, so plain patterns ignore case.

    The replacement only runs on rows that hold such a letter.
    """
    value = F.col(text) if isinstance(text, str) else text
    special = F.lit(False)
    for letter in SPECIAL_LETTERS:
        special = special | value.contains(letter)
    replaced = F.translate(value, "".join(SPECIAL_LETTERS), "".join(SPECIAL_LETTERS.values()))
    return F.lower(F.when(special, replaced).otherwise(value))


def matched_terms(text: Column | str, terms: Sequence[Term]) -> Column:
    """Names of the terms that occur in ``text``, in list order.

    The one-element transform binds the folded text once for all patterns, in filters too.
    """
    found = F.transform(
        F.array(folded(text)),
        lambda low: F.array_compact(F.array(*(F.when(low.rlike(t.regex()), F.lit(t.name)) for t in terms))),
    )
    return F.get(found, F.lit(0))


def any_term(text: Column | str, terms: Sequence[Term]) -> Column:
    """True when at least one term occurs; stops at the first hit."""

    def hit(low: Column) -> Column:
        found = F.lit(False)
        for term in terms:
            found = found | low.rlike(term.regex())
        return found

    return F.exists(F.array(folded(text)), hit)


def join_terms(terms: Column | str) -> Column:
    """Array of terms as ``a|b`` text."""
    return F.array_join(terms, "|")


def split_terms(text: Column | str) -> Column:
    """``a|b`` text as an array without blank items."""
    return F.filter(F.split(text, r"\|"), lambda item: item != "")
