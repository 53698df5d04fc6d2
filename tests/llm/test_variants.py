"""Spelling variants against plain loops over all pairs, for every way of cutting keys."""

import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from gleanwork.llm import variants


def lower(text):
    return text.translate({c: c + 32 for c in range(65, 91)})


def one_edit(u, v):
    if len(u) > len(v):
        u, v = v, u
    if len(u) == len(v):
        return sum(a != b for a, b in zip(u, v, strict=True)) == 1
    return len(v) == len(u) + 1 and any(v[:i] + v[i + 1 :] == u for i in range(len(v)))


def brute_force(rows):
    counts = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = lower(run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return groups({w: n for w, n in counts.items() if len(w) >= 7 and n >= 2})


def groups(words):
    near = {w: [v for v in words if v != w and one_edit(v, w)] for w in words}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 10 * words[w] else None
    out = set()
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, words[w], len(near[w]), words[form[w]] if form[w] else None))
    return out


def vocabulary(seed, size, letters="abé", sizes=(7, 8, 9)):
    random.seed(seed)
    words = {"".join(random.choice(letters) for _ in range(random.choice(sizes))) for _ in range(size)}
    return {w: random.choice([2, 3, 20, 40, 400, 5000]) for w in sorted(words)}


@pytest.mark.parametrize("group_words", [20_000, 40, 1])
def test_groups_equal_all_pairs_however_keys_are_cut(spark, group_words):
    words = vocabulary(1, 350) | {"aaaaaaa": 9, "aaaaaaaa": 90, "aaaaaaaaa": 900, "bbbbbbb": 2, "z" * 400: 2, "z" * 401: 30, "z" * 399 + "y": 3}
    got = variants.variant_groups(spark.createDataFrame(list(words.items()), "word string, n bigint"), group_words=group_words)
    assert {tuple(r) for r in got.collect()} == groups(words)


def test_a_shared_beginning_or_ending_of_all_words_is_cut_further(spark):
    words = {f"prefix{a}{b}{c}suffix": 2 + (a == b) * 30 for a in "abcdef" for b in "abcdefg" for c in "abc"}
    rows = spark.createDataFrame(list(words.items()), "word string, n bigint")
    got = variants.variant_groups(rows, group_words=10)
    assert {tuple(r) for r in got.collect()} == groups(words)


def test_texts_equal_a_plain_loop(spark):
    random.seed(2)
    words = list(vocabulary(3, 60, "abcÉx×", (7, 8)))
    texts = [(i if i % 13 else None, " ".join(random.choice(words).title() for _ in range(80))) for i in range(40)]
    texts += [(77, None), (78, ""), (79, "short ones, 123 only"), (80, "a" * 50_000), texts[0], texts[0], (81, "Straße-Straßen ŁódźŁódź Ångströms Ångströms")]
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in texts], "doc_id bigint, text string, word string, n int")
    got = variants.spelling_variants(docs)
    assert {tuple(r) for r in got.collect()} == brute_force(texts)
    assert got.count() == got.select("word").distinct().count()
    assert variants.spelling_variants(docs.limit(0)).isEmpty()


def test_acceptors_share_equal_states_and_keep_their_words():
    words = sorted(vocabulary(4, 200))
    acceptor = variants.Acceptor()
    start = acceptor.of(words)
    assert sorted(acceptor.language(start)) == words
    # Minimal: as many states as there are different sets of endings.
    endings = {w[:k]: frozenset(v[k:] for v in words if v.startswith(w[:k])) for w in words for k in range(len(w) + 1)}
    assert len(acceptor.register) == len(set(endings.values()))
    assert acceptor.of([]) == (False, ())


def test_composition_accepts_each_pair_once():
    words = sorted(vocabulary(5, 150, "ab", (4, 5)))
    short, long = [w for w in words if len(w) == 4], [w for w in words if len(w) == 5]
    acceptor = variants.Acceptor()
    pairs = list(variants.composed(acceptor, acceptor.of(short), acceptor.of(long), 9))
    assert len(pairs) == len(set(pairs))
    want = {(u, v) for u in short for v in words if (len(v) == 5 or u < v) and one_edit(u, v)}
    assert set(pairs) == want


def test_chains_of_forms_end_at_their_last_word(spark):
    words = {"aaaaaaa" + "b" * k: 2 * 10**k for k in range(12)}
    got = variants.variant_groups(spark.createDataFrame(list(words.items()), "word string, n bigint")).collect()
    assert {r["root"] for r in got} == {"aaaaaaa" + "b" * 11} and sum(r["form"] is None for r in got) == 1


def test_only_a_to_z_are_lower_cased(spark):
    docs = spark.createDataFrame([(1, "ÉCOLIERS ÉCOLIERS écoliers")], "doc_id int, text string")
    assert [r["run"] for r in variants.runs(docs).collect()] == ["Écoliers", "Écoliers", "écoliers"]
    assert variants.runs(docs).select(F.max("id")).first()[0] == "1"
