"""Each operator against brute force on small tables with nulls, empty and long texts, ties and repeats."""

import hashlib
import math
import random
import re
import time
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.core.broadcast import Broadcast
from pyspark.sql import functions as F

from gleanwork.llm import (
    asof,
    components,
    contamination,
    credentials,
    language_model,
    mixing,
    near_duplicates,
    neighbours,
    quality,
    queries,
    quotations,
    url_filters,
    wrappers,
)
from gleanwork.llm.tokens import mix, text_slices
from gleanwork.session import materialize, small_batches

WORDS = [f"{a}{b}" for a in "ka lo mi tu re so".split() for b in "n r st m p".split()]


def prose(seed: int, n: int) -> str:
    random.seed(seed)
    return " ".join(random.choice(WORDS) for _ in range(n))


def documents(spark, texts):
    """documents with a clashing extra column."""
    rows = [(i, t, f"s{i % 3}" if i % 7 else None, 0, "x") for i, t in texts]
    return spark.createDataFrame(rows, "doc_id bigint, text string, source string, n_chars int, kept string")


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))


# ------------------------------------------------------------------ as-of and URL filters


@pytest.mark.parametrize("strict", [False, True])
def test_asof_equals_brute_force(spark, strict):
    random.seed(1)
    left = [(random.choice("aab") if i % 9 else None, random.randint(0, 30) if i % 8 else None, i) for i in range(80)]
    right = [(random.choice("aab") if i % 9 else None, random.randint(0, 30) if i % 7 else None, i) for i in range(60)]
    got = asof.asof_join(
        spark.createDataFrame(left, "k string, at int, id int"), spark.createDataFrame(right, "k string, at int, v int"), ["k"], ["at"], ["v"], strict
    )
    found = {r["id"]: r["match"]["v"] if r["match"] else None for r in got.collect()}
    for k, at, i in left:
        fit = [(b, v) for q, b, v in right if None not in (k, at, q, b) and q == k and (b < at or b == at and not strict)]
        assert found[i] == (max(fit)[1] if fit else None)


def test_urls_are_judged_by_the_entries_of_their_time(spark):
    captures = spark.createDataFrame(
        [
            (1, "http://a.b.com/x/y?q#z", 5), (2, "http://a.b.com/x/y", 1), (3, "https://u@B.com.:80/", 9), (4, None, 5), (5, "nonsense", 5),
            (6, "http://a.b.com/x", None), (7, "http://a.b.com/x/y", 20), (7, "http://a.b.com/x/y", 20), (8, "http://ab.com/", 9),
        ], "capture_id int, url string, fetched_at int",
    )
    entries = spark.createDataFrame(
        [
            ("bad", "b.com", "add", 3), ("bad", "b.com", "remove", 10), ("bad", "b.com", "add", 10), ("allow", "a.b.com/x", "add", 15),
            ("ads", "a.b.com/x/y", "add", 5), ("ads", "a.b.com/x/y", "remove", 20), ("bad", None, "add", 1), ("odd", "b.com", "keep", 1),
        ], "list string, rule string, action string, dated int",
    )
    got = {r["capture_id"]: (r["n_active"], r["lists"], r["rule"], r["blocked"]) for r in url_filters.filter_captures(captures, entries).collect()}
    assert got == {
        1: (2, "ads,bad", "a.b.com/x/y", True), 2: (0, "", "", False), 3: (1, "bad", "b.com", True), 4: (0, "", "", False), 5: (0, "", "", False),
        6: (0, "", "", False), 7: (1, "allow", "a.b.com/x", False), 8: (0, "", "", False),
    }
    assert url_filters.filter_captures(captures, entries.limit(0)).where("blocked").isEmpty()
    assert url_filters.filter_captures(captures.limit(0), entries).isEmpty()


# ------------------------------------------------------------------ secrets


def base_spans(text):
    text = text or ""
    spans = []
    keys = r"(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])"
    for m in re.finditer(keys + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m[1]) >= 6:
            spans.append((m.start(), 0, m.end()))
    spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(spans)


def secret_texts():
    random.seed(4)
    bits = ["token = token = abcdefgh", 'Password": "hunter2xx"', "api_key:abc", "AKIA" + "A" * 16, "AKIA123", "0" * 24, "f" * 23, "é TOKEN=ſecret123", "apikey=='", "secret:", "pwd: x9$Qz!7Lw2", "pass=password1"]
    texts = [None, "", "plain words only"] + bits + [" ".join(random.choice(bits + WORDS) for _ in range(40)) for _ in range(60)]
    return list(enumerate([*texts, "token=" + "a" * 50_000, texts[3]]))


def test_base_secrets_equal_plain_patterns_and_the_method_only_adds(spark):
    docs = documents(spark, secret_texts())
    got = {r["doc_id"]: r for r in credentials.digest(credentials.find_secrets(docs, credentials.word_ranks(docs))).collect()}
    for i, text in secret_texts():
        base = [f"{credentials.KINDS[k]}:{s}:{e}" for s, k, e in base_spans(text)]
        assert got[i]["base_sha256"] == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert [s for s in got[i]["spans"].split(",") if s and not s.startswith("guess")] == base
        assert got[i]["n_assign"] + got[i]["n_access"] + got[i]["n_hex"] == len(base)
    assert got[13]["n_guess"] == 1 and got[14]["n_guess"] == 0
    assert credentials.find_secrets(docs.limit(0), {}).isEmpty()


def slow_cost(value, ranks):
    """All cuts of a short lower-case value into words and single characters."""
    alphabet = math.log10(max(10, 26 * any(c.isalpha() for c in value) + 10 * any(c.isdigit() for c in value)))
    best = [0.0] + [math.inf] * len(value)
    for end in range(1, len(value) + 1):
        best[end] = best[end - 1] + alphabet
        for start in range(end - 1):
            if value[start:end] in ranks:
                best[end] = min(best[end], best[start] + math.log10(ranks[value[start:end]] + 1))
    return best[-1]


def test_guess_costs():
    ranks = {"password": 1, "dog": 900, "dogma": 5000, "mat": 40}
    for value in ("dogmat", "xdogx", "passworddog", "mxz", "dogdogmat"):
        assert credentials.segments(value, ranks)[0] <= slow_cost(value, ranks) + 1e-9
    assert credentials.segments("dogmat", ranks)[0] == pytest.approx(slow_cost("dogmat", ranks))
    assert credentials.segments("", ranks) == (0.0, [])
    kinds = {k for k, _, _ in credentials.segments("password19990412aaaaaaqwertyuX7", ranks)[1]}
    assert {"word", "date", "repeat", "walk"} <= kinds
    cost = credentials.segments("x9$Qz!7Lw2", ranks)[0]
    assert cost > credentials.MIN_COST > credentials.segments("P@ssw0rd2020", ranks)[0]
    assert credentials.segments("z" * 20_000, ranks)[0] < 10


def span_costs(span, alphabet, ranks):
    """Costs of one span by the definition of each kind."""
    low, n = span.lower(), len(span)
    plain = low.translate(credentials.LEET)
    if n == 1:
        yield alphabet
    if 2 <= n <= credentials.LONGEST_WORD:
        if low in ranks:
            capital = math.log10(2) if span.isupper() or span.istitle() else math.log10(2 ** min(16, n))
            yield math.log10(ranks[low] + 1) + (0 if span == low else capital)
        if plain in ranks:
            yield math.log10(ranks[plain] + 1) + 1
    year, month, day, sep = r"(19|20)\d\d", r"(0[1-9]|1[0-2])", r"(0[1-9]|[12]\d|3[01])", "[-/._]?"
    if re.fullmatch(f"{year}{sep}{month}{sep}{day}|{day}{sep}{month}{sep}{year}|{year}", span):
        yield credentials.DATE_COST
    for block in (1, 2, 3, 4):
        if n % block == 0 and n // block >= (3 if block == 1 else 2) and low == low[:block] * (n // block):
            yield block * alphabet + math.log10(n)
    rows = [r for row in credentials.ROWS for r in (row, row[::-1])]
    if n >= 3 and all(any(low[k : k + 2] in r for r in rows) for k in range(n - 1)):
        yield math.log10(94) + math.log10(n) + 0.5


def test_guess_costs_are_the_least_over_all_cuts():
    ranks = {"password": 1, "dog": 900, "dogma": 5000, "mat": 40, "hello": 7, "apple": 30, "as": 12}
    random.seed(8)
    bits = ["dog", "Dogma", "MAT", "asdfg", "hello", "aaa", "4444", "2019", "1999-04-12", "12041999", "p@ssw0rd", "abab", "xyzxyz", "q", "T", "7", "apple", "4s", "9876", "1234abcd1234abcd"]
    values = ["asdfghello", "aaaapple", "19991234", "a" * 24, "qwqwqwqw", "asdfasdfasdf"]
    values += ["".join(random.choices(bits, k=random.randint(1, 5)))[:24] for _ in range(400)]
    for value in values:
        kinds = {26 * (c.isalpha() and c.islower()) or 27 * c.isalpha() or 10 * c.isdigit() or 33 for c in value}
        alphabet = math.log10(max(10, sum(26 if k == 27 else k for k in kinds)))
        best = [0.0] + [math.inf] * len(value)
        for end in range(1, len(value) + 1):
            for start in range(end):
                best[end] = min([best[end], *(best[start] + c for c in span_costs(value[start:end], alphabet, ranks))])
        cost, cut = credentials.segments(value, ranks)
        assert cost == pytest.approx(best[-1]), value
        assert [s for _, s, _ in cut] == [0, *(e for _, _, e in cut[:-1])] and cut[-1][2] == len(value)


def test_guess_costs_of_long_runs_are_the_least_over_all_cuts():
    ranks = {"password": 1, "dog": 900, "mat": 40, "apple": 30, "aab": 2, "bca": 3, "aaa": 6, "abab": 9, "wqw": 4, "ertyx": 5, "aaaadog": 8}
    random.seed(9)
    runs = ["a", "ab", "qw", "abc", "aab", "1234", "abcd", "1a", "asdf"]
    values = ["a" * 30 + "pple", "ab" * 20 + "apple", "qwertytrew" * 4 + "ertyx", "a" * 40 + "adog" + "ab" * 15]
    for _ in range(120):
        run = random.choice(runs)
        long = (run * 60)[random.randint(0, 3) :][: random.randint(25, 60)]
        values.append(random.choice(["", "dog", "x"]) + long + random.choice(["", "pple", "bab", "dog", "ertyx", "bcadog", "19990412", "wqw"]))
    values += [(a * 30)[: random.randint(25, 40)] + (b * 30)[: random.randint(4, 30)] for a in runs for b in runs if a != b]
    for value in values:
        alphabet = math.log10(max(10, 26 * any(c.isalpha() for c in value) + 10 * any(c.isdigit() for c in value)))
        best = [0.0] + [math.inf] * len(value)
        for end in range(1, len(value) + 1):
            for start in range(end):
                best[end] = min([best[end], *(best[start] + c for c in span_costs(value[start:end], alphabet, ranks))])
        assert credentials.segments(value, ranks)[0] == pytest.approx(best[-1]), value


def test_redaction_leaves_no_secret(spark):
    docs = documents(spark, secret_texts())
    clean = {r["doc_id"]: r["text"] for r in credentials.redact(docs, {}).collect()}
    assert clean[0] is None and clean[2] == "plain words only" and clean[6] == "[SECRET]"
    assert all(not base_spans(t) or "SECRET" in t for t in clean.values() if t)
    assert not any("a" * 100 in t for t in clean.values() if t)


# ------------------------------------------------------------------ near-duplicates


def brute_components(texts, width, share):
    sets = {}
    for i, t in texts:
        w = words_of(t)
        sets[i] = {tuple(w[k : k + width]) for k in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} if w else set()
    label = {i: i for i in sets}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= share * len(sets[a] | sets[b])]
    for _ in sets:
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
    return sets, label


def copies():
    base = prose(0, 120).split()
    texts = [None, "", " \t\n", "One two", "one TWO", "one two three", "x" * 30_000, "x" * 30_000, prose(1, 4_000)]
    for k in range(40):
        own = base[:]
        random.seed(k)
        for at in random.sample(range(120), k % 5):
            own[at] = f"changed{k}"
        texts.append(" ".join(own))
    texts += [prose(100 + k, 50) + " " + " ".join(base[:30]) for k in range(20)]
    return list(enumerate(texts))


@pytest.mark.parametrize("width,share,block", [(3, 85, 500), (5, 80, 500), (3, 85, 4)])
def test_near_duplicates_equal_all_pairs(spark, monkeypatch, width, share, block):
    monkeypatch.setattr(near_duplicates, "BLOCK", block)
    texts = copies()
    sets, label = brute_components(texts, width, share)
    got = near_duplicates.near_duplicates(documents(spark, texts), width, share).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in got} == {
        i: (len(sets[i]), label[i], label[i] == i) for i, _ in texts
    }


def test_repeated_and_unnamed_documents(spark):
    docs = documents(spark, [(1, "a b c d"), (1, "a b c d"), (2, "a b c d")]).unionByName(
        spark.createDataFrame([(None, "a b c d", "s", 0, "x"), (None, "z y", "s", 0, "x")], "doc_id bigint, text string, source string, n_chars int, kept string")
    )
    found = materialize(near_duplicates.near_duplicates(docs, 3, 85))
    assert sorted((r["doc_id"] or 0, r["component_id"], r["kept"]) for r in found.collect() if r["component_id"]) == [
        (0, 1, False), (1, 1, True), (1, 1, True), (2, 1, False),
    ]
    left = near_duplicates.one_of_each(docs, found)
    assert left.columns == docs.columns and sorted(r["doc_id"] or 0 for r in left.collect()) == [0, 0, 1]
    assert near_duplicates.near_duplicates(docs.limit(0)).isEmpty()


@pytest.mark.parametrize("block", [500, 4])
def test_one_id_with_different_texts_links_by_each(spark, monkeypatch, block):
    monkeypatch.setattr(near_duplicates, "BLOCK", block)
    first, second = prose(1, 120), prose(2, 120)
    texts = [(5, first), (5, second), (5, "  "), (6, first + " a"), (7, second + " b"), (3, prose(3, 50)), (8, second), (9, second + " c")]
    sets, label = brute_components(list(enumerate(t for _, t in texts)), 3, 85)
    least = {}
    for k, (i, _) in enumerate(texts):
        least[label[k]] = min(i, least.get(label[k], i))
    docs = documents(spark, texts)
    groups = materialize(near_duplicates.near_duplicates(docs, 3, 85))
    got = sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in groups.collect())
    assert got == sorted((i, len(sets[k]), least[label[k]]) for k, (i, _) in enumerate(texts))
    assert [g[2] for g in got] == [3, 5, 5, 5, 5, 5, 5, 5]
    left = {(r["doc_id"], r["text"]) for r in near_duplicates.one_of_each(docs, groups).collect()}
    assert left == {(i, t) for i, t in texts if i in (3, 5)}


def test_sketches_fill_and_estimate():
    random.seed(2)
    a = np.unique(np.array([random.getrandbits(64) for _ in range(400)], np.uint64))
    sets = [a, a[:300], a[:1], a[50:]]
    s = near_duplicates.sketch(sets)
    assert (s < np.iinfo(np.uint64).max).all()
    assert (s[0] == s[1]).mean() == pytest.approx(0.75, abs=0.1) and (s[0] == s[3]).mean() == pytest.approx(0.875, abs=0.08)
    assert len(near_duplicates.band_keys(s, 8)[0]) == 64


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(30)] + [(100, k) for k in range(101, 120)] + [(7, 7), (None, 3), (101, 100)]
    got = {r["node"]: r["component"] for r in components.components(spark.createDataFrame(links, "u bigint, v bigint")).collect()}
    assert got == {**{i: 0 for i in range(31)}, **{i: 100 for i in range(100, 120)}}


# ------------------------------------------------------------------ extraction


def page(k: int, body: str) -> str:
    menu = "".join(f'<li><a href="/{j}">m{j}</a></li>' for j in range(2 + k % 4))
    return (
        f"<!DOCTYPE html><html><head><title>t</title><style>p{{}}</style><script>var a='</p>';</script></head><body><nav><ul>{menu}</ul></nav>"
        f"<div class='cookie-notice'>We use cookies</div>{body}<div id=comments><p>First!</p></div><footer>&copy; host</footer>"
    )


def test_wrappers_keep_the_article_only(spark):
    rows = [(k, f"http://h.example/{k}", page(k, f"<article><h1>Head {k}</h1>" + "".join(f"<p>Text&amp;{k} <b>bold</b>\n  {j}<br>end" for j in range(k + 1)) + "</article>")) for k in range(6)]
    plain = [(10 + k, f"http://g.example/{k}", page(k, f"<div class=x><p>Body {k}</p></div><div>Same line</div>")) for k in range(5)]
    odd = [(20, None, None), (21, "bad", ""), (22, "http://z/", "no <markup here"), (23, "http://z/", "<div>" * 500 + "deep"), (22, "http://z/", "no <markup here")]
    pages = spark.createDataFrame(rows + plain + odd, "page_id bigint, url string, html string").withColumn("text", F.lit("clash"))
    got = wrappers.extract_pages(pages).collect()
    text = {r["page_id"]: r["text"] for r in got}
    assert len(got) == 16
    for k in range(6):
        assert text[k] == f"Head {k} " + " ".join(f"Text&{k} bold {j} end" for j in range(k + 1))
    for k in range(5):
        assert text[10 + k] == f"Body {k}"
    assert (text[20], text[21], text[22], text[23]) == ("", "", "no <markup here", "deep")
    assert wrappers.extract_pages(pages.limit(0)).isEmpty()


def test_pages_without_an_article_keep_their_text_beside_pages_with_one(spark):
    rows = [(k, "http://h.example/", page(k, f"<p>stray {k}</p><article><p>Text {k}</p></article>")) for k in range(5)]
    rows += [(10 + k, "http://h.example/", page(k, f"<div class=x><h1>Head {k}</h1><p>Body {k}</p></div>")) for k in range(5)]
    rows += [(20, "http://h.example/", page(0, "<p>Alone</p><article><nav>menu</nav></article>"))]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    text = {r["page_id"]: r["text"] for r in wrappers.extract_pages(pages).collect()}
    assert text == {**{k: f"Text {k}" for k in range(5)}, **{10 + k: f"Head {k} Body {k}" for k in range(5)}, 20: "Alone"}


def test_class_words_and_copies_leave_the_text(spark):
    shells = {
        0: "<body class='has-sidebar'><p>Text 0</p></body>",
        1: "<html class='no-search'><div id='page' class='no-comments'><article><p>Text 1</p></article></div>",
        2: "<article class='post category-legal'>Text 2</article><article class='tag-search'>more</article>",
        3: "<main class='skip'>Text 3, longer than the notice</main><div class='cookie-notice'><div class='content'>We use cookies</div></div>",
        4: "<div id='page' class='no-comments'><div class='entry-content'>Text 4</div></div><p>&copy;</p>",
        5: "<article>Text 5<div class='comments'><article class='comment'>First!</article></div></article>",
        6: "<p>Text 6, longer than the teaser</p><div class='related'><article>teaser</article></div>",
        7: "<p>Text 7</p><div class='cookie-notice'><div class='content'>Ok?</div></div>",
    }
    wanted = {k: f"Text {k}" for k in shells} | {2: "Text 2 more", 3: "Text 3, longer than the notice", 6: "Text 6, longer than the teaser teaser"}
    for k, raw in shells.items():
        assert " ".join(wrappers.extract(raw, None)) == wanted[k], k
    rows = [(k, f"http://h{k}.example/", raw) for k, raw in shells.items()]
    # Copies of one page show no template; different pages do, however often each comes.
    rows += [(10 + k, "http://c.example/", page(k, "<p>Whole text</p>")) for k in range(4)]
    rows += [(20 + k, "http://d.example/", page(k, f"<p>Body {k % 3}</p><div>Same line</div>")) for k in range(6)]
    rows += [(30 + k, "http://e.example/", page(k, f"<p>Body {k % 2}</p><div>Same line</div>")) for k in range(6)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(5)
    text = {r["page_id"]: r["text"] for r in wrappers.extract_pages(pages).collect()}
    assert {k: text[k] for k in shells} == wanted
    assert [text[10 + k] for k in range(4)] == ["Whole text"] * 4
    assert [text[20 + k] for k in range(6)] == [f"Body {k % 3}" for k in range(6)]
    assert [text[30 + k] for k in range(6)] == [f"Body {k % 2} Same line" for k in range(6)]


def test_expressions_hold_options_and_repeats():
    a, b = (wrappers.induce(wrappers.parse(x)) for x in ("<div><p>a<p>b</div>", "<div><h2>t</h2><p>c</div>"))
    (item,) = wrappers.align(a, b)
    assert [(i["t"], i["q"]) for i in item["c"]] == [("h2", "?"), ("p", "+")]
    folded = wrappers.induce(wrappers.parse("<dl>" + "<dt>k<dd>v" * 3 + "</dl>"))
    assert [(i["t"], i["q"]) for i in folded[0]["c"]] == [("(dt dd)", "+")]


# ------------------------------------------------------------------ quality


def test_classifier_on_held_out_documents(spark):
    texts = [(i, prose(i, 60) if i % 2 else prose(i, 60).upper().replace(" ", "!! ")) for i in range(120)] + [(500, None), (501, ""), (502, prose(9, 20_000))]
    docs = documents(spark, texts)
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] + [(None, 1), (3, None), (999, 1)], "doc_id bigint, label int")
    model = quality.train(docs, labels)
    got = {r["doc_id"]: r["score"] for r in quality.score_documents(docs, model, [F.col("doc_id")]).collect()}
    assert all((got[i] >= 0.5) == bool(i % 2) for i in range(60, 120)) and got[502] > 0.5
    assert got[500] == got[501] and 0 <= got[500] <= 1
    again = quality.train(docs.repartition(3), labels)
    assert np.array_equal(model.weights, again.weights)
    assert quality.accepted(docs, model).columns == docs.columns
    nothing = quality.train(docs, labels.limit(0))
    assert quality.score_documents(docs, nothing, [F.col("doc_id")]).where("score != 0.5").isEmpty()
    assert quality.score_documents(docs.limit(0), model, [F.col("doc_id")]).isEmpty()


def plain_buckets(text):
    """Every feature occurrence of a text by its bucket, one after the other."""
    words, found = text.split(), []
    for word in words:
        found.append(xxhash.xxh3_64_intdigest(word) % quality.BUCKETS)
        framed = b"<" + word + b">"
        for n in range(quality.SHORTEST, quality.LONGEST + 1):
            for i in range(len(framed) - n + 1):
                gram = sum(c << (8 * k) for k, c in enumerate(framed[i : i + n])) | n << 56
                found.append(int(mix(np.array([gram], np.uint64))[0]) % quality.BUCKETS)
    for a, b in zip(words, words[1:]):
        pair = (xxhash.xxh3_64_intdigest(a) * 0x9E3779B97F4A7C15 + xxhash.xxh3_64_intdigest(b)) % (1 << 64)
        found.append((7 if a == b else int(mix(np.array([pair], np.uint64))[0])) % quality.BUCKETS)
    return found


TEXTS = [b"plain words stand here", b"here here here", "\u00e9t\u00e9 \u00e0 la mer".encode(), b"a", b"", b"  ", None, b"words plain plain words " * 30]


def test_features_equal_a_plain_loop():
    for text in TEXTS:
        ids, counts = quality.features(text)
        want = {}
        for b in plain_buckets(text or b""):
            want[b] = want.get(b, 0) + 1
        assert dict(zip(ids.tolist(), counts.tolist())) == want


def test_training_equals_a_plain_loop():
    """Average, softmax and gradient step feature by feature, in the order of the trainer."""
    texts, labels = [TEXTS[0], TEXTS[2], TEXTS[1], None], [1, 1, 0, 0]
    epochs = -(-quality.LEAST_STEPS // len(texts))
    got, got_bias = quality.fit(texts, labels, rate=0.2)
    rng = np.random.default_rng(5)
    table = rng.uniform(-1 / quality.DIMENSIONS, 1 / quality.DIMENSIONS, (quality.BUCKETS, quality.DIMENSIONS))
    layer, bias = np.zeros((quality.DIMENSIONS, 2)), np.log([0.5, 0.5])
    found = [plain_buckets(t or b"") for t in texts]
    done = 0
    for _ in range(epochs):
        for k in rng.permutation(len(texts)):
            speed = 0.2 * (1 - done / (epochs * len(texts)))
            done += 1
            if not found[k]:
                continue
            average = sum(table[b] for b in found[k]) / len(found[k])
            odds = [math.exp(sum(average[d] * layer[d][c] for d in range(len(average))) + bias[c]) for c in (0, 1)]
            error = np.array([o / sum(odds) - (c == labels[k]) for c, o in enumerate(odds)])
            back = layer @ error
            for d in range(len(average)):
                layer[d] -= speed * average[d] * error
            bias = bias - speed * 0.1 * error
            scale = len(set(found[k])) ** 0.5 / len(found[k])
            for b in found[k]:
                table[b] -= speed * scale * back
    want = table @ (layer[:, 1] - layer[:, 0])
    used = sorted({b for f in found for b in f})
    assert np.allclose(got[used], want[used], rtol=1e-3, atol=1e-3) and abs(got_bias - (bias[1] - bias[0])) < 1e-3
    scores = quality._Scorer(got, got_bias).scores(TEXTS)
    for text, score in zip(TEXTS, scores):
        each = plain_buckets(text or b"")
        odds = got_bias + (sum(got[b] for b in each) / len(each) if each else 0)
        assert abs(score - 1 / (1 + math.exp(-odds))) < 1e-9


# ------------------------------------------------------------------ quotations


def test_replies_find_their_conversations(spark):
    messages = [
        (1, 1, "a", "Hello there\nHow are you"), (2, 2, "b", "> hello   THERE\n> how are you\nFine, thanks"), (3, 3, "a", "Good\n>> Hello there\n> Fine, thanks"),
        (4, 4, "c", "Fine, thanks"), (5, 5, "d", "> Fine, thanks\nCopy"), (6, 6, "e", "> never said\n>\nAlone"), (7, 7, "f", None), (8, None, "g", "> Good"),
        (None, 9, "h", "> Good"), (2, 2, "b", "> hello   THERE\n> how are you\nFine, thanks"),
    ]
    df = spark.createDataFrame(messages, "message_id bigint, sent bigint, role string, text string").withColumn("depth", F.lit("clash"))
    got = sorted((r["message_id"] or 0, r["conversation_id"], r["parent_id"], r["position"], r["depth"], r["text"], r["n_quoted"], r["n_linked"]) for r in quotations.link_quotations(df).collect())
    assert [g[:5] for g in got if g[0]] == [(1, 1, None, 1, 0), (2, 1, 1, 2, 1), (2, 1, 1, 3, 1), (3, 1, 2, 4, 2), (4, 4, None, 1, 0), (5, 5, None, 1, 0), (6, 6, None, 1, 0), (7, 7, None, 1, 0), (8, 8, None, 1, 0)]
    assert [g[5:] for g in got if g[0] in (3, 6, 7)] == [("Good", 2, 2), ("Alone", 1, 0), ("", 0, 0)]
    assert quotations.link_quotations(df.limit(0)).isEmpty()


def linked(spark, texts):
    """(conversation, parent, n_quoted, n_linked) of messages numbered and sent in order."""
    rows = [(i, i, "r", t) for i, t in enumerate(texts, 1)]
    df = spark.createDataFrame(rows, "message_id bigint, sent bigint, role string, text string")
    got = quotations.link_quotations(df).orderBy("message_id").collect()
    return [(r["conversation_id"], r["parent_id"], r["n_quoted"], r["n_linked"]) for r in got]


def test_rewrapped_and_cut_quotations_link(spark):
    first = "The harbour opens at six in the\nmorning and closes late\n\nBring a coat because of the wind there"
    rewrapped = "> The harbour opens at\n> six in the morning\n> and closes late\n>\n> Bring a COAT because of\n> the wind there\nSure"
    cut = "> opens at six in the morning\nIs that so\n> coat because of the wind there today\nFine"
    edited = "> nothing of this was ever written by anyone at all\nHm"
    assert linked(spark, [first, rewrapped, cut, edited]) == [(1, None, 0, 0), (1, 1, 2, 2), (1, 1, 2, 2), (4, None, 1, 0)]


def test_short_shared_lines_do_not_join_threads(spark):
    texts = ["Plans for the garden in spring\nThanks", "Quite another matter is to be settled\n\nThanks", "Thanks", "> Thanks\nwelcome"]
    assert linked(spark, texts)[3] == (4, None, 1, 0)
    # Inside a thread that a longer passage built, the same line is found.
    texts.append("> Quite another matter is to be settled\n>\n> Thanks\nYes")
    assert linked(spark, texts)[4] == (2, 2, 2, 2)
    # A short passage that one earlier message has links by itself.
    assert linked(spark, ["Shall we", "> shall   we\nNo"]) == [(1, None, 0, 0), (1, 1, 1, 1)]


def test_links_equal_brute_force(spark):
    rng = random.Random(5)
    texts = []
    for _ in range(60):
        own = [" ".join(rng.choice(WORDS) for _ in range(rng.choice((1, 2, 6, 9)))) for _ in range(rng.randint(1, 3))]
        if texts and rng.random() < 0.8:
            parts = own_passages(rng.choice(texts))
            part = rng.choice(parts).split(" ")
            part = part[rng.randint(0, 2) :] if len(part) > 8 else part
            half = len(part) // 2
            own = [f"> {' '.join(part[:half])}\n> {' '.join(part[half:])}" if half else f"> {part[0]}", *own]
        texts.append("\n\n".join(own))
    assert [(p, n) for _, p, _, n in linked(spark, texts)] == brute_links(texts)


def own_passages(text):
    return [" ".join(p.split()) for p in text.split("\n\n") if not p.startswith(">")]


def brute_links(texts):
    """(parent, links) with at most one quoted passage a message, by comparing with every earlier one."""

    def windows(passage):
        words = passage.split(" ")
        return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}

    out, root = [], []
    for i, text in enumerate(texts):
        quote = next((" ".join(p.replace(">", " ").split()) for p in text.split("\n\n") if p.startswith(">")), None)
        parent = None
        if quote is not None:
            whole = [j for j in range(i) if quote in own_passages(texts[j])]
            if len(quote.split(" ")) < 5:
                parent = whole[0] if len(whole) == 1 else None
            elif whole:
                parent = whole[-1]
            else:
                asked, votes = windows(quote), {}
                for w in asked:
                    holding = [j for j in range(i) if any(w in windows(p) for p in own_passages(texts[j]))]
                    if holding:
                        votes[holding[-1]] = votes.get(holding[-1], 0) + 1
                best = max(((n, j) for j, n in votes.items() if 2 * n >= len(asked)), default=None)
                parent = best[1] if best else None
        root.append(i if parent is None else root[parent])
        out.append((None if parent is None else parent + 1, int(parent is not None)))
    return out


def test_long_conversations_keep_their_numbers(spark):
    turns = [(c, t, f"words {c} of turn {t}") for c, t in [*((1, t) for t in range(998, 1003)), (2, 0), (2, 1), (2, 2)]]
    df = spark.createDataFrame(turns, "conv_id bigint, turn int, text string").withColumn("role", F.lit("user"))
    got = quotations.link_quotations(queries.mail(df)).collect()
    facts = {r["text"]: (r["position"], r["depth"], r["n_linked"]) for r in got}
    assert len({r["message_id"] for r in got}) == len(turns) and len({r["conversation_id"] for r in got}) == 2
    for c, t, text in turns:
        n = t - (998 if c == 1 else 0)
        assert facts[text] == (n + 1, n, min(2, n))
    few = {r["message_id"] for r in queries.mail(df.where("conv_id = 2 or turn < 1000")).collect()}
    assert few == {1998, 1999, 2000, 2001, 2002}


# ------------------------------------------------------------------ mixing


def test_mix_comes_near_its_targets(spark):
    texts = [(i, prose(i, 5 + i * 7 % 60) if i % 11 else None) for i in range(400)] + [(3, "repeat me"), (401, "")]
    got = [r.asDict() for r in mixing.mix_sources(documents(spark, texts)).collect()]
    again = [r.asDict() for r in mixing.mix_sources(documents(spark, texts).repartition(5)).collect()]
    key = lambda r: (r["doc_id"], r["size"])
    assert sorted(got, key=key) == sorted(again, key=key) and len(got) == 402
    sizes = {i: len(words_of(t)) for i, t in texts if i != 3}
    assert all(r["size"] == sizes[r["doc_id"]] for r in got if r["doc_id"] != 3)
    by_source = {}
    for r in got:
        by_source.setdefault(r["source"], []).append(r)
        assert 0 <= r["taken"] <= 3 * r["size"] and r["taken"] == r["copies"] * r["size"]
    assert sum(rows[0]["target"] for rows in by_source.values()) == pytest.approx(sum(r["size"] for r in got))
    for rows in by_source.values():
        assert abs(sum(r["taken"] for r in rows) - rows[0]["target"]) <= 40
        assert rows[0]["target"] <= 3 * rows[0]["source_size"] == 3 * sum(r["size"] for r in rows)
    assert mixing.mix_sources(documents(spark, texts).limit(0)).isEmpty()


def test_excess_is_shared_again(spark):
    sources = spark.createDataFrame([("a", 10, 1.0), ("b", 1000, 2.0), (None, 30, 3.0), ("z", 0, 1.0)], "source string, source_size bigint, weight double")
    got = {r["source"]: r["target"] for r in mixing.targets(sources).collect()}
    assert got == {"a": 30.0, "b": pytest.approx(920.0), None: 90.0, "z": 0.0}


# ------------------------------------------------------------------ contamination


def brute_hits(text, items):
    clean = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate({c: c + 32 for c in range(65, 91)}))
    w, hit, found = clean(text), set(), set()
    for name, passage in items:
        p = clean(passage)
        size = min(13, len(p))
        for k in range(len(p) - size + 1 if p else 0):
            for s in range(len(w) - size + 1):
                if w[s : s + size] == p[k : k + size]:
                    hit.update(range(s, s + size))
                    found.add(name)
    return len(w), len(hit), sorted(found)


@pytest.mark.parametrize("block", [8_000_000, 200])
def test_contamination_equals_window_search(spark, block):
    items = [("b2", prose(1, 40)), ("b1", prose(2, 13)), ("b10", "Short-item, three"), ("e", "..."), ("n", None), ("one", "Uniquéword"), ("b2", prose(1, 40)), ("rep", "ka " * 20)]
    inside = lambda k, n: " ".join(items[k][1].split()[3 : 3 + n])
    texts = [None, "", prose(5, 300), inside(0, 13).upper(), prose(6, 60) + " " + inside(0, 20) + "! " + prose(7, 50), inside(0, 12), "a short item three b", "ka " * 40, "uniquéword", prose(2, 13) + " " + prose(8, 400), prose(9, 20_000)]
    docs = documents(spark, list(enumerate(texts)))
    benchmark = spark.createDataFrame(items, "item_id string, text string")
    got = {r["doc_id"]: r for r in contamination.digest(contamination.contamination(docs, benchmark, block_bytes=block)).collect()}
    for i, text in enumerate(texts):
        n, hit, names = brute_hits(text, items)
        assert (got[i]["n_words"], got[i]["n_hit"], got[i]["n_items"], got[i]["contaminated"]) == (n, hit, len(names), hit > 0 and 20 * hit >= n)
        assert got[i]["items_sha256"] == hashlib.sha256(",".join(names).encode()).hexdigest()
    left = contamination.uncontaminated(docs, benchmark, block)
    assert {r["doc_id"] for r in left.collect()} == {i for i, r in got.items() if not r["contaminated"]} and left.columns == docs.columns
    assert contamination.contamination(docs, benchmark.limit(0)).where("size(spans) > 0").isEmpty()
    assert contamination.contamination(docs.limit(0), benchmark).isEmpty()


# ------------------------------------------------------------------ neighbours


def test_neighbours_recall_and_rules(spark):
    random_ = np.random.default_rng(3)
    centres = random_.standard_normal((20, 16))
    vectors = [(i, (centres[i % 20] + 0.3 * random_.standard_normal(16)).tolist()) for i in range(600)]
    vectors += [(700, None), (701, []), (702, [0.0] * 16), (703, [math.nan] * 16), (704, [None] + [1.0] * 15), (705, [1.0, 2.0]), (None, vectors[0][1]), (706, vectors[1][1]), (706, vectors[1][1])]
    df = spark.createDataFrame(vectors, "vec_id bigint, vector array<double>").withColumn("score", F.lit("clash"))
    asked = df.where("vec_id % 50 = 0 or vec_id in (1, 705)")
    got = {}
    for r in neighbours.nearest_neighbours(df, asked, 10, block_bytes=700).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    good = {i: np.array(v) for i, v in vectors if i is not None and v and None not in v and np.isfinite(v).all() and any(v)}
    found = total = 0
    for q in [i for i in good if i % 50 == 0 or i in (1, 705)]:
        exact = sorted((float(np.sqrt(((v - good[q]) ** 2).sum())), i) for i, v in good.items() if i != q and len(v) == len(good[q]))[:10]
        mine = got.get(q, [])
        assert len(mine) == len(exact) and mine == sorted(mine, key=lambda x: (x[1], x[0]))
        assert all(abs(s - float(np.sqrt(((good[i] - good[q]) ** 2).sum()))) < 1e-12 for i, s in mine)
        found += len({i for i, _ in mine} & {i for _, i in exact})
        total += len(exact)
    assert found >= 0.9 * total and 705 not in got and got[1][0] == (706, 0.0)
    # Tables that never meet a query are made up for by an exact pass.
    narrow = neighbours.nearest_neighbours(df, asked, 10, 1, 8, 1e-6, 1)
    assert narrow.groupBy("query_id").count().where("count != 10").isEmpty()
    assert neighbours.nearest_neighbours(df.limit(0), df.limit(0)).isEmpty()


def test_one_block_of_queries_is_held_at_a_time(spark, monkeypatch):
    rows = [(i, [float(i % 7), float(i % 5), 1.0 + i]) for i in range(40)]
    df = spark.createDataFrame(rows, "vec_id bigint, vector array<double>")
    held, most = set(), []
    made = type(spark.sparkContext).broadcast
    ended = Broadcast.destroy

    def broadcast(self, value):
        shared = made(self, value)
        held.add(id(shared))
        most.append(len(held))
        return shared

    def destroy(self, blocking=False):
        held.discard(id(self))
        ended(self, blocking)

    monkeypatch.setattr(type(spark.sparkContext), "broadcast", broadcast)
    monkeypatch.setattr(Broadcast, "destroy", destroy)
    got = neighbours.nearest_neighbours(df, df.where("vec_id % 4 = 0"), 3, block_bytes=100)
    assert len(most) >= 3 and max(most) == 1 and not held
    for q in range(0, 40, 4):
        exact = sorted((math.dist(v, rows[q][1]), i) for i, v in rows if i != q)[:3]
        assert len(exact) == got.where(F.col("query_id") == q).count()


def test_probes_come_in_order_of_expected_success():
    sets = neighbours.perturbations(4, 50)
    assert sets[:2] == [(), (0,)] and len(set(sets)) == 50
    assert not any(j + k == 7 for s in sets for j in s for k in s if j != k)


# ------------------------------------------------------------------ language model


@pytest.mark.parametrize("known,shard", [(200_000, 64_000_000), (3, 64_000_000), (3, 300)])
def test_scores_against_exact_counts(spark, monkeypatch, known, shard):
    monkeypatch.setattr(language_model, "SEGMENT_BYTES", 2_000)
    monkeypatch.setattr(language_model, "CHUNK_TOKENS", 500)
    texts = [(i, prose(i, 40)) for i in range(60)] + [(900, None), (901, ""), (902, "Unseen WORDS kan"), (902, "Unseen WORDS kan"), (903, prose(1, 3_000))]
    docs = documents(spark, texts)
    held = lambda i: zlib.crc32(str(i).encode()) % 7 == 2
    counts = {}
    for i, t in texts:
        if not held(i):
            for w in [*words_of(t), None]:
                counts[w] = counts.get(w, 0) + 1
    total, distinct = sum(counts.values()), len(counts)
    model = language_model.train(docs.where(F.crc32(F.col("doc_id").cast("string")) % 7 != 2))
    assert (model.tokens, model.distinct) == (total, distinct)
    got = language_model.score_texts(docs, model, [F.col("doc_id")], known, shard).collect()
    assert len(got) == len(texts)
    plain = dict(texts)
    for r in got:
        tokens = [*words_of(plain[r["doc_id"]]), None]
        base = sum(math.log10((counts.get(w, 0) + 1) / (total + distinct + 1)) for w in tokens)
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(tokens), sum(w in counts for w in tokens), total)
        assert r["base_score"] == pytest.approx(base, rel=1e-9) and r["score"] < 0
    mean = {r["doc_id"]: r["score"] / r["n_tokens"] for r in got}
    assert mean[902] < mean[5]
    empty = language_model.train(docs.limit(0))
    assert language_model.score_texts(docs, empty, [F.col("doc_id")]).where("n_known > 0").isEmpty()


def test_bigrams_seen_once_count(spark, monkeypatch):
    monkeypatch.setattr(language_model, "SEGMENT_BYTES", 2_000)
    texts = [(i, prose(i, 40)) for i in range(20)] + [(900, ""), (901, "kan unseen lor")]
    docs = documents(spark, texts)
    ones, twos = {}, {}
    for _, t in texts[:20]:
        tokens = [*words_of(t), None]
        for before, w in zip(["start", *tokens], tokens):
            ones[w] = ones.get(w, 0) + 1
            twos[before, w] = twos.get((before, w), 0) + 1
    ones["start"] = ones[None]
    total, distinct = sum(ones.values()) - ones["start"], len(ones) - 1
    level = lambda n: 2.0 ** math.floor(math.log2(n)) * 1.5 - 0.5 if n else 0.0
    model = language_model.train(docs.where("doc_id < 20"))
    assert sum(n == 1 for n in twos.values()) > 0.3 * len(twos)
    for shard in (64_000_000, 300):
        got = {r["doc_id"]: r["score"] for r in language_model.score_texts(docs, model, [F.col("doc_id")], shard_bytes=shard).collect()}
        for i, t in texts:
            tokens = [*words_of(t), None]
            score = 0.0
            for before, w in zip(["start", *tokens], tokens):
                one, two, given = level(ones.get(w, 0)), level(twos.get((before, w), 0)), level(ones.get(before, 0))
                score += math.log10((min(two, given) + 50 * (one + 1) / (total + distinct + 1)) / (given + 50))
            # False hits of the filter raise few counts by one level.
            assert abs(got[i] - score) <= 0.02 * len(tokens), i


def test_filter_keeps_every_level_and_errs_rarely():
    random_ = np.random.default_rng(1)
    grams = random_.integers(0, 2**63, 20_000).astype(np.uint64)
    levels = random_.integers(1, 6, 20_000)
    held = language_model.Filter(language_model.joined([(0, language_model.fill(grams, levels).tobytes())]), 1)
    read = held.levels(grams)
    assert (read >= levels).all() and (read > levels).mean() < 0.05
    assert (held.levels(random_.integers(0, 2**63, 20_000).astype(np.uint64)) > 0).mean() < 0.05


def test_equal_ngrams_of_a_batch_are_probed_once(monkeypatch):
    texts = [prose(i % 3, 40).encode() for i in range(30)] + [None, b"kan kan kan"]
    tokens = [language_model.token_hashes(t, language_model.WordHashes()) for t in texts]
    both = [np.concatenate(tokens), np.concatenate([language_model.bigrams(t) for t in tokens])]
    raw = language_model.fill(np.concatenate([np.unique(x) for x in both]), np.concatenate([np.full(len(np.unique(x)), k) for x, k in zip(both, (3, 2))]))
    held = language_model.Filter(language_model.joined([(0, raw.tobytes())]), 1)
    plain = [np.concatenate([held.levels(t), held.levels(language_model.bigrams(t))]) for t in tokens]
    probed = []
    levels = held.levels
    monkeypatch.setattr(held, "levels", lambda ngrams: probed.append(len(ngrams)) or levels(ngrams))
    ones, at = language_model._distinct(tokens)
    got = language_model._looked_up(tokens, (ones, at), held)
    assert all((a == b).all() for a, b in zip(got, plain, strict=True))
    assert probed == [len(np.unique(x)) for x in both]
    wanted = np.arange(len(ones)) % 2 == 0
    rest = language_model._unknown(tokens, ones, at, wanted).to_pylist()
    for own, entries in zip(tokens, rest, strict=True):
        values, times = np.unique(own[np.isin(own, ones[wanted])], return_counts=True)
        assert [(e["ngram"], e["n"]) for e in entries] == list(zip(values.view(np.int64).tolist(), times.tolist()))


def test_scores_do_not_depend_on_the_known_tokens(spark):
    docs = spark.createDataFrame([(i, prose(i, 40)) for i in range(6)] + [(6, ""), (7, None)], "doc_id bigint, text string")
    model = language_model.train(docs)
    assert model.texts == 8
    scores = [
        {r["doc_id"]: r["score"] for r in language_model.score_texts(docs, model, [F.col("doc_id")], known=known).collect()} for known in (1, 3, 10_000)
    ]
    assert scores[0] == scores[1] == scores[2]


def test_texts_come_in_slices_of_few_bytes():
    texts = [None, "", "kan", "kan lor", None, "x" * 50, "kan"]
    sliced = [b.column("text").to_pylist() for b in text_slices(iter([pa.record_batch({"text": texts})]), 4, 10)]
    assert sliced == [[None, "", "kan", "kan lor"], [None], ["x" * 50], ["kan"]]
    assert list(text_slices(iter([pa.record_batch({"text": pa.array([], pa.string())})]), 4, 10)) == []


def test_counting_holds_each_ngram_few_times():
    random.seed(5)
    texts = [" ".join(f"{random.randrange(300_000):x}" for _ in range(1_000)) for _ in range(300)]
    plain = {"ones": {}, "twos": {}}
    for text in texts:
        own = language_model.token_hashes(text.encode(), language_model.WordHashes())
        for name, grams in (("ones", own), ("twos", language_model.bigrams(own))):
            for gram in grams.tolist():
                plain[name][gram] = plain[name].get(gram, 0) + 1
    batch = pa.record_batch({"text": texts})
    tracemalloc.start()
    rows = list(language_model._counted(7)(iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    counted = {"ones": {}, "twos": {}}
    for row in pa.Table.from_batches(rows).to_pylist():
        for name, size in (("ones", 8), ("twos", 6)):
            grams = language_model._unpacked([row[name]], size)
            assert (language_model.segment_of(grams, 7) == row["segment"]).all()
            counted[name] |= dict(zip(grams.tolist(), np.frombuffer(row[f"{name}_n"], "<u4").tolist(), strict=True))
    assert counted == plain
    # Bytes for each of the 300,300 tokens, with the words that are kept; 157 where the counts and their bytes were copied.
    assert peak < 120 * 300_300


def test_rows_go_to_python_in_small_batches(spark, tmp_path):
    rows = [(i, "x" * 1_000) for i in range(4_000)]
    spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1).write.parquet(str(tmp_path / "t"))
    docs = spark.read.parquet(str(tmp_path / "t"))

    def sizes(batches):
        for batch in batches:
            yield pa.record_batch({"n": pa.array([batch.num_rows])})

    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    given = spark.conf.get(key)
    with small_batches(spark, 100_000):
        got = [r["n"] for r in docs.mapInArrow(sizes, "n bigint").collect()]
    assert sum(got) == 4_000 and max(got) < 400
    assert spark.conf.get(key) == given


@pytest.mark.parametrize("chunk,kept", [(500, 16_000_000), (1_500_000, 16_000_000), (1_500_000, 200)])
def test_a_large_filter_is_not_sent_to_the_texts(spark, monkeypatch, chunk, kept):
    monkeypatch.setattr(language_model, "SEGMENT_BYTES", 2_000)
    texts = [(i, prose(i, 40)) for i in range(60)] + [(900, None), (901, ""), (902, "Unseen WORDS kan"), (902, "Unseen WORDS kan"), (903, prose(1, 3_000)), (None, "kan"), (None, None)]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")
    model = language_model.train(docs.where("doc_id < 40"))
    keep = [F.col("doc_id"), F.col("doc_id").alias("a b"), F.array(F.col("doc_id")).alias("ids"), F.lit("x").alias("n_tokens_of"), F.to_timestamp(F.lit("2024-01-01")).alias("at")]
    one_pass = language_model.score_texts(docs, model, keep)
    monkeypatch.setattr(language_model, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(language_model, "CHUNK_TOKENS", chunk)
    monkeypatch.setattr(language_model, "KEPT_BYTES", kept)
    copies, written, make = [], [], spark.sparkContext.broadcast
    monkeypatch.setattr(type(spark.sparkContext), "broadcast", lambda self, value: copies.append(value) or make(value))
    monkeypatch.setattr(language_model, "materialize", lambda df: written.append(df.columns) or materialize(df))
    apart = language_model.score_texts(docs, model, keep, shard_bytes=300)
    # No pass per shard: neither filters nor copies of the texts.
    assert not copies and len(written) == 1 and "text" not in written[0]
    assert apart.columns == one_pass.columns and apart.dtypes == one_pass.dtypes
    key = lambda r: (str(r["doc_id"]), r["n_tokens"])
    got, plain = sorted(apart.collect(), key=key), sorted(one_pass.collect(), key=key)
    assert len(got) == len(texts)
    for a, b in zip(got, plain, strict=True):
        assert a.asDict() == b.asDict() | {"base_score": pytest.approx(b["base_score"], rel=1e-9), "score": pytest.approx(b["score"], rel=1e-12)}
    assert language_model.score_texts(docs.limit(0), model, keep).count() == 0


def test_hashes_are_packed_by_their_differences():
    random_ = np.random.default_rng(1)
    for total in (1, 7, 70_000):
        for size in (6, 8):
            for n in (0, 1, 30_000):
                values = np.unique(np.append(random_.integers(0, 2 ** (8 * size) - 1, n, np.uint64, endpoint=True), np.array([0, 2 ** (8 * size) - 1][: 2 * n], np.uint64)))
                order, edges = language_model._by_segment(values, total)
                raw, ends = language_model._packed(values[order], edges, size)
                pieces = [raw[a:b].tobytes() for a, b in zip(ends, ends[1:])]
                for k in range(0, total, 1 + total // 9):
                    assert (language_model._unpacked([pieces[k]], size) == values[language_model.segment_of(values, total) == k]).all()
                assert (language_model._unpacked(pieces, size) == values[order]).all()
                assert language_model._unpacked([], size).size == 0
                if n > 1 and total == 7:
                    assert len(pa.compress(raw.tobytes(), "lz4", asbytes=True)) < (size - 0.9) * len(values)


def test_shuffles_of_the_counts_are_dropped(spark, monkeypatch):
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    seen, given = [], spark.conf.get(key)
    monkeypatch.setattr(language_model, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(language_model, "materialize", lambda df: seen.append(spark.conf.get(key)) or materialize(df))
    docs = documents(spark, [(i, prose(i, 40)) for i in range(10)])
    assert language_model.score_texts(docs, language_model.train(docs), [F.col("doc_id")]).count() == 10
    assert seen == ["true", "true"] and spark.conf.get(key) == given


def test_filters_of_earlier_passes_are_dropped(spark, monkeypatch):
    monkeypatch.setattr(language_model, "SEGMENT_BYTES", 2_000)
    docs = documents(spark, [(i, prose(i, 40)) for i in range(60)])
    model = language_model.train(docs)
    made, dropped = [], []
    make, drop = spark.sparkContext.broadcast, Broadcast.destroy
    monkeypatch.setattr(type(spark.sparkContext), "broadcast", lambda self, value: made.append(make(value)) or made[-1])
    monkeypatch.setattr(Broadcast, "destroy", lambda self, *a: dropped.append(self) or drop(self, *a))
    scored = language_model.score_texts(docs, model, [F.col("doc_id")], shard_bytes=300)
    assert len(made) > 2 and {id(b) for b in made} == {id(b) for b in dropped}
    assert scored.count() == 60 and scored.where("score is null").isEmpty()


# ---------------------------------------------------------------- html that is never closed


@pytest.mark.parametrize("piece", ["<a '", "<a ", "<a'", "<a", "<a '\"", "<div><p>x", "<li><ul><div>"])
def test_unclosed_markup_is_read_in_linear_time(piece):
    def seconds(n):
        start = time.perf_counter()
        wrappers.parse(piece * n)
        return time.perf_counter() - start

    seconds(1_000)
    small = max(seconds(10_000), 0.02)
    # Quadratic work would take a hundred times as long.
    assert seconds(100_000) < 40 * small


def test_a_tag_without_an_end_is_text():
    assert wrappers.extract("<p>a < b and <a 'c</p><p>d</p>", None) == ["a < b and <a 'c", "d"]
    assert wrappers.extract("<p title='x > y'>a</p><b \"", None) == ["a", '<b "']


def test_depth_does_not_decide_what_is_left_out():
    inside = "<nav>menu</nav><form>f</form><p>text</p><div class=sidebar>s</div>"
    for depth in (1, 100, 190, 210, 2_000):
        assert wrappers.extract("<div>" * depth + inside, None) == ["text"], depth
        assert wrappers.extract("<div>" * depth + "<p>out</p><article><p>in</p><aside>no</aside></article>", None) == ["in"], depth


def test_length_does_not_make_a_linked_heading_a_menu():
    for count in (5, 50, 500):
        page = "<h4><a href=x>Linked</a></h4>" + "<p>t</p><pre>c</pre>" * count + "".join(f"<h{1 + i % 3}>u</h{1 + i % 3}>" for i in range(count))
        assert wrappers.extract(page, None)[0] == "Linked", count


@pytest.mark.parametrize("seed", range(5))
def test_nearest_open_elements_equal_a_walk_of_the_stack(seed):
    rng = random.Random(seed)
    names = ["p", "li", "ul", "tr", "td", "table", "div"]
    stack, walked = wrappers._Stack(["", []]), [""]
    for _ in range(400):
        name = rng.choice(names)
        if rng.random() < 0.4 and name in walked:
            stack.close(stack.nearest(name))
            while walked.pop() != name:
                pass
        else:
            closes, scope = wrappers.CLOSES.get(name, {"p"}), wrappers.SCOPES.get(name, {"table", "td"})
            stack.imply(closes, scope)
            for depth in range(len(walked) - 1, 0, -1):
                if walked[depth] in closes:
                    del walked[depth:]
                    break
                if walked[depth] in scope:
                    break
            stack.open(name, "")
            walked.append(name)
        assert [n for n, *_ in stack.open_elements] == walked
