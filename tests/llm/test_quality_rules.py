"""Quality rules against plain loops, on texts that are null, empty, blank, long, repeated and foreign."""

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from gleanwork.llm import quality_rules as rules

FUNCTION = {"en": "the of and to in is that it was for".split(), "xx": "ka lo mi tu re so na pe ri do".split()}


def text_of(seed, n, lang="en", marks=""):
    random.seed(seed)
    stem = "abcdefghijklm" if lang == "en" else "nopqrstuvwxyz"
    filler = ["".join(random.choice(stem) for _ in range(random.randint(4, 9))) for _ in range(n)]
    return " ".join((random.choice(FUNCTION[lang]) if random.random() < 0.45 else w) + marks for w in filler)


def special_texts():
    return [
        None, "", " \t\n", "one", "two words", "a b c a b c", "x " * 60, "A\n\nA\n \nB\nA", "the cat\x0bsat\x0con\rthe cat sat on",
        "é ü ß €uro 東京 #*$ 12,5%", "a b c d a b c", "line\nline\nline two\n" * 30, "q " * 20_000, "z" * 100_000,
        "the of and to in is that it was for " * 12,
    ]


def corpus(spark):
    texts = special_texts() + [text_of(i, 40 + 7 * i, "en" if i % 3 else "xx") for i in range(40)]
    texts += [text_of(90 + i, 200, "en", marks=m) for i, m in enumerate(("#", "%%%", " | "))]
    texts += ["".join(f"{random.choice('abc')}{k:x}word " for k in range(300))]
    rows = [(i if i % 11 else None, t, "en" if i % 3 else "xx" if i % 2 else None, 1, "c") for i, t in enumerate(texts)]
    rows += [rows[20], rows[20]]
    return rows, spark.createDataFrame(rows, "doc_id bigint, text string, lang string, common int, language string")


def plain_measures(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = list(zip(words, words[1:], words[2:], strict=False))
    times = Counter(windows)
    inside = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(inside)


def classes(text):
    def kind(c):
        if c in " \t\n\x0b\x0c\r":
            return 0
        for k, pattern in enumerate(("[a-z]", "[A-Z]", "[0-9]", r"[.,;:!?'\"()-]"), 1):
            if re.match(pattern, c):
                return k
        return 5 if ord(c) < 128 else 6

    counts = Counter(map(kind, text))
    return [counts[k] for k in range(7)]


def distance(p, q):
    def part(a, b):
        return a * math.log2(2 * a / (a + b)) if a else 0

    return math.sqrt(max(0.0, sum(part(p.get(k, 0), q.get(k, 0)) + part(q.get(k, 0), p.get(k, 0)) for k in {*p, *q}) / 2))


def brute_force(rows, size, least):
    totals, heads, sums = Counter(), {}, {}
    for _, text, lang, *_ in rows:
        if not lang:
            continue
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        totals[lang] += len(words)
        heads.setdefault(lang, Counter()).update(w.lower() for w in words if len(w) <= 24 and re.search(r"[^\W\d_]", w))
        sums[lang] = [a + b for a, b in zip(sums.get(lang, [0] * 7), classes(text or ""), strict=True)]
    known = {}
    for lang in (x for x in totals if totals[x] >= least):
        top = sorted(heads[lang].items(), key=lambda x: (-x[1], x[0]))[:size]
        shares = {w: n / totals[lang] for w, n in top}
        known[lang] = (shares | {"": 1 - sum(shares.values())}, {k: n / sum(sums[lang]) for k, n in enumerate(sums[lang])})
    out = []
    for row in rows:
        i, text = row[:2]
        n, *_, repeated = measures = plain_measures(text)
        words = Counter(w.lower() for w in re.findall(r"[^\x20\x09-\x0D]+", text or ""))
        near = []
        for lang, (shares, own) in known.items():
            p = {w: words[w] / n for w in shares if w and words[w]} if n else {}
            near.append((distance(p | {"": 1 - sum(p.values())}, shares), distance({k: c / max(1, len(text or "")) for k, c in enumerate(classes(text or ""))}, own)))
        d = min(near) if n and near else None
        failed = n < 50 or 100 * repeated > 50 * n
        described = not row[2] or row[2] in known
        far = described and d is not None and (n >= 50 and d[0] > rules.WORD_LIMIT or len(text) >= 200 and d[1] > rules.CLASS_LIMIT)
        out.append((i, *measures, d, failed, not failed and not far))
    return out


def test_measures_distances_and_verdicts_equal_plain_loops(spark):
    rows, docs = corpus(spark)
    want = brute_force(rows, rules.COMMON_WORDS, 500)
    got = rules.judge(docs, [F.col("doc_id"), F.col("text").alias("body")], least_reference=500).collect()
    key = {(r["doc_id"], r["body"]): r for r in got}
    assert len(got) == len(rows)
    for (i, n, chars, symbols, lines, repeated, d, failed, kept), row in zip(want, rows, strict=True):
        r = key[i, row[1]]
        assert tuple(r[2:7]) == (n, chars, symbols, lines, repeated), row[1][:60]
        assert (r["base_failed"], r["kept"]) == (failed, kept)
        if d is None:
            assert r["word_distance"] is None and r["class_distance"] is None
        else:
            assert r["word_distance"] == pytest.approx(d[0], abs=1e-9) and r["class_distance"] == pytest.approx(d[1], abs=1e-9)


def test_texts_far_from_every_language_go_and_the_label_of_a_text_is_no_matter(spark):
    rows, docs = corpus(spark)
    verdict = {r["text"]: r for r in rules.judge(docs, [F.col("text")], least_reference=500).collect()}
    for i in range(3, 40):
        r = verdict[text_of(i, 40 + 7 * i, "en" if i % 3 else "xx")]
        assert r["kept"] and r["nearest_language"] == ("en" if i % 3 else "xx")
    for i, m in enumerate(("#", "%%%", " | ")):
        assert not verdict[text_of(90 + i, 200, "en", marks=m)]["kept"]
    assert not verdict[rows[-3][1]]["kept"]


def test_short_texts_are_not_judged_by_histograms(spark):
    _, docs = corpus(spark)
    strewn = text_of(91, 200, "en", marks="%%%")
    row = rules.judge(docs, [F.col("text")], least_reference=500, min_words=201, min_chars=10**6).where(F.col("text") == strewn).first()
    assert row["kept"] and row["word_distance"] > rules.WORD_LIMIT


def test_a_language_that_few_words_describe_is_not_judged(spark):
    _, docs = corpus(spark)
    rare = " ".join(f"слово{k} и" for k in range(60))
    more = docs.select("text", "lang").unionByName(spark.createDataFrame([(rare, "ru"), (rare + " ", "en")], "text string, lang string"))
    verdict = {r["text"]: r for r in rules.judge(more, [F.col("text")], least_reference=500).collect()}
    assert verdict[rare]["kept"] and verdict[rare]["word_distance"] > rules.WORD_LIMIT and not verdict[rare + " "]["kept"]


def test_without_languages_all_texts_describe_one(spark):
    rows, docs = corpus(spark)
    got = rules.judge(docs, [F.col("doc_id")], lang=None, least_reference=500).collect()
    assert {r["nearest_language"] for r in got} == {"", None} and len(got) == len(rows)
    assert rules.common_words(docs, least=10**9).keys() == {""}
    nulls = docs.withColumn("text", F.lit(None).cast("string"))
    assert [(r["n_words"], r["base_failed"], r["kept"]) for r in rules.judge(nulls.limit(2), [F.col("doc_id")]).collect()] == [(0, True, False)] * 2
    assert rules.judge(docs.limit(0), [F.col("doc_id")]).isEmpty()


def test_only_counts_by_word_are_shuffled(spark):
    _, docs = corpus(spark)
    plan = rules.measure(docs, ["the"], [F.col("doc_id")])._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan
