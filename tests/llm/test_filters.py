"""Quality rules, classifier, decontamination, language scores and licences."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from routeloom.llm import rules
from routeloom.llm.classifier import BITS, fit, fit_documents, held_out, score_documents
from routeloom.llm.decontaminate import mark_contaminated
from routeloom.llm.licenses import Index, _hashes, align, scan_licenses
from routeloom.llm.scoring import score_documents as language_scores

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def test_base_counts(docs, rows, odd, empty):
    got = {r["doc_id"]: r for r in rules.quality_rules(docs).collect()}
    assert len(got) == len(rows)
    for i, text, *_ in rows:
        text = text or ""
        words = WORD.findall(text)
        windows = list(zip(words, words[1:], words[2:], strict=False))
        times = Counter(windows)
        covered = {i + d for i, w in enumerate(windows) if times[w] > 1 for d in range(3)}
        lines = [x for x in text.split("\n") if WORD.search(x)]
        r = got[i]
        assert r["n_words"] == len(words) and r["word_chars"] == sum(map(len, words))
        assert r["n_symbols"] == sum(text.count(c) for c in "#*$%&|<>")
        assert r["n_dup_lines"] == len(lines) - len(set(lines))
        assert r["n_repeat_words"] == len(covered)
        failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
        assert r["base_failed"] == failed and not (failed and r["kept"])
    assert rules.quality_rules(odd).count() == odd.count()
    assert rules.quality_rules(empty).count() == 0


def divergence(p, q):
    out = 0.0
    for a, b in zip(p, q, strict=True):
        m = (a + b) / 2
        out += (a * math.log2(a / m) if a else 0) / 2 + (b * math.log2(b / m) if b else 0) / 2
    return math.sqrt(max(0.0, out))


def histograms(text):
    chars = len(text)
    known = [
        len(re.findall("[A-Z]", text)),
        len(re.findall("[0-9]", text)),
        len(re.findall(r"[\x20\x09-\x0D]", text)),
        sum(text.count(c) for c in rules.SYMBOLS),
        sum(text.count(c) for c in rules.MARKS),
    ]
    words = WORD.findall(text)
    spelled = {s: w for w in rules.COMMON_WORDS for s in (w, w.capitalize())}
    common = Counter(spelled[w] for w in words if w in spelled)
    counts = [common[w] for w in rules.COMMON_WORDS]
    return [*known, chars - sum(known)], [*counts, len(words) - sum(counts)]


def test_distances(spark):
    good = ["The cat and the dog of it was in a house. " * 6, "And it is that the one was 4 of them, in it. " * 5]
    texts = {0: good[0], 1: good[1], 2: "<p> ### $$ || &&& %% ** " * 30, 3: "der und die das " * 20, 4: "Is it?"}
    rows = [(i, t, None if i == 4 else "de" if i == 3 else "en") for i, t in texts.items()]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r["doc_id"]: r for r in rules.quality_rules(docs).collect()}
    total = defaultdict(lambda: [0, 0])
    for i, t, lang in rows:
        for k, h in enumerate(histograms(t)):
            total[lang][k] = np.add(total[lang][k], h)
    share = lambda h: np.array(h) / max(1, sum(h))
    for i, t, lang in rows:
        for k, (name, least) in enumerate((("class_distance", 200), ("word_distance", 50))):
            h = histograms(t)[k]
            want = divergence(share(h), share(total[lang][k])) if sum(h) >= least else None
            assert (got[i][name] is None) == (want is None)
            assert want is None or abs(got[i][name] - want) < 1e-9


def test_text_without_common_words(spark):
    """Rejected where its language has common words, kept where hardly any text has them."""
    rng = random.Random(0)

    def text(share):
        other = lambda: "".join(rng.choice("bkvz") + rng.choice("aeiou") for _ in range(3))
        return " ".join(rng.choice(["the", "of", "and", "is"]) if rng.random() < share else other() for _ in range(120))

    rows = [(i, text(0.22), "en") for i in range(40)] + [(40, text(0), "en")]
    rows += [(50 + i, text(0), "xx") for i in range(5)] + [(60 + i, text(0.01), "yy") for i in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = rules.quality_rules(docs).collect()
    assert not any(r["base_failed"] for r in got) and all(r["class_distance"] < 0.25 for r in got)
    assert [r["doc_id"] for r in got if not r["kept"]] == [40]


def test_classifier_learns(spark):
    rng = np.random.default_rng(0)
    words = [f"w{i}" for i in range(300)]
    rows, labels = [], []
    for i in range(400):
        good = i % 3 > 0
        tail = "" if good else " !!! ###"
        rows.append((i, " ".join(rng.choice(words, 30)) + tail * int(rng.integers(1, 5))))
        if i % 10:
            labels.append((i, int(good)))
    labels += [(0, None), (None, 1), (9999, 1)]
    docs = spark.createDataFrame([*rows, (400, None), (401, ""), (None, "x")], "doc_id long, text string")
    marks = spark.createDataFrame(labels, "doc_id long, quality int")
    model = fit_documents(docs, marks)
    got = score_documents(docs, model).withColumn("out", held_out("doc_id")).collect()
    assert len(got) == 403 and all(0 <= r["score"] <= 1 for r in got)
    known = dict(labels)
    checked = [r for r in got if r["out"] and known.get(r["doc_id"]) is not None]
    assert all(r["out"] == (zlib.crc32(str(r["doc_id"] if r["doc_id"] is not None else "").encode()) % 4 == 2) for r in got)
    right = [(r["score"] >= 0.5) == (known[r["doc_id"]] == 1) for r in checked]
    assert len(right) > 50 and np.mean(right) > 0.97
    # labels of the held-out quarter change nothing
    flipped = marks.withColumn("quality", F.when(held_out("doc_id"), 1 - F.col("quality")).otherwise(F.col("quality")))
    again = fit_documents(docs, flipped)
    assert (again.weights == model.weights).all() and again.slope == model.slope


def test_classifier_edges(docs, empty, spark):
    none = spark.createDataFrame([], "doc_id long, quality int")
    model = fit_documents(docs, none)
    scored = score_documents(docs, model, score_col="_SCORE")
    assert scored.columns[-1] == "_SCORE" and "_score" not in scored.columns
    assert {r["_SCORE"] for r in scored.collect()} == {0.5}
    assert score_documents(empty, model).count() == 0
    one = fit([np.array([1, 2])] * 3, np.ones(3), BITS)
    assert one.scores(one.margins(np.zeros(0, int), np.zeros(0, int), 1))[0] == pytest.approx(0.8)


ITEM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def expected_hits(rows, items, size):
    windows = defaultdict(set)
    for item, text in items:
        words = ITEM_WORD.findall((text or "").translate(LOWER))
        for k in range(max(1, len(words) - size + 1) if words else 0):
            windows[tuple(words[k : k + size])].add(item)
    out = {}
    for i, text, *_ in rows:
        words = ITEM_WORD.findall((text or "").translate(LOWER))
        hit, found = set(), set()
        for n in {len(w) for w in windows}:
            for k in range(len(words) - n + 1):
                if (w := tuple(words[k : k + n])) in windows:
                    hit |= set(range(k, k + n))
                    found |= windows[w]
        out[i] = (len(words), len(hit), sorted(str(x) for x in found if x is not None))
    return out


def benchmark_items(rows):
    long = rows[63][1] if len(rows) > 63 else rows[0][1]
    words = [" ".join((t or "").split()[5:40]) for _, t, *_ in rows[40:44]]
    return [
        (1, words[0].upper()),
        (2, words[1] + " and nothing else like this"),
        (10, "kara1 Kara1 kara1"),
        (11, "short"),
        (11, words[2]),
        (12, ""),
        (13, None),
        (None, " ".join((long or "").split()[:20])),
        (14, "repeat the same words again " * 4),
        (15, "É é X"),
    ]


@pytest.mark.parametrize("size", [13, 4])
def test_decontamination(spark, docs, rows, size):
    items = benchmark_items(rows)
    table = spark.createDataFrame(items, "item_id long, text string")
    got = mark_contaminated(docs, table, size).collect()
    want = expected_hits(rows, items, size)
    assert len(got) == len(rows)
    for r in got:
        n, hit, found = want[r["doc_id"]]
        assert (r["n_words"], r["n_hit"], r["items"]) == (n, hit, found)
        assert r["n_items"] == len(found) and r["contaminated"] == (hit > 0 and 20 * hit >= n)
    assert sum(r["contaminated"] for r in got) > 5


def test_decontamination_edges(spark, odd, rows, empty):
    table = spark.createDataFrame(benchmark_items(rows), "item_id long, text string")
    want = expected_hits(rows, benchmark_items(rows), 13)
    got = mark_contaminated(odd, table).collect()
    assert len(got) == odd.count()
    assert all(r["n_hit"] == want[r["doc_id"]][1] for r in got if r["doc_id"] is not None)
    assert any(r["n_hit"] for r in got if r["doc_id"] is None)
    assert mark_contaminated(empty, table).count() == 0
    none = mark_contaminated(odd, table.where("item_id = 12")).collect()
    assert len(none) == odd.count() and not any(r["contaminated"] for r in none)


def expected_scores(texts, rare):
    split = [WORD.findall(t or "") for t in texts]
    counts = Counter(w for words in split for w in words)
    total = sum(counts.values())
    split = [[w if counts[w] >= total * rare else None for w in words] for words in split]
    single = Counter(w for words in split for w in words)
    double = Counter(p for words in split for p in zip(words, words[1:], strict=False))
    out = []
    for words in split:
        logs = []
        for before, w in zip([False, *words], words, strict=False):
            if before is not False and double[before, w] >= 2:
                logs.append(math.log10(double[before, w] / single[before]))
            else:
                share = math.log10(single[w] / total)
                logs.append(share if before is False else math.log10(0.4) + share)
        out.append(sum(logs) / len(logs) if logs else None)
    return out


@pytest.mark.parametrize("rare", [1e-6, 2e-3])
def test_language_scores(docs, rows, odd, rare):
    for table, source in ((docs, rows), (odd, odd.collect())):
        got = defaultdict(list)
        for r in language_scores(table, rare=rare).collect():
            got[r["doc_id"]].append(r)
        for (i, *_), want in zip(source, expected_scores([r[1] for r in source], rare), strict=True):
            scores = [r["score"] for r in got[i]]
            assert any(s == want or (want is not None and s == pytest.approx(want)) for s in scores)
        assert sum(map(len, got.values())) == len(source)


def test_language_scores_keep_rare_words(spark):
    """In more than a million words, those seen once or twice still differ."""
    common = "of the " * 1_100_000  # two occurrences are less than a millionth
    texts = [common, "of alpha beta the", "alpha beta of", "gamma delta", "of epsilon", "zeta the zeta the"]
    texts += ["eta of theta", "of theta eta", "iota kappa iota kappa", "lambda"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["score"] for r in language_scores(docs).collect()}
    assert [got[i] for i in range(len(texts))] == pytest.approx(expected_scores(texts, 0))


@pytest.mark.parametrize("share", [2e-4, 2e-3, 0.5])
def test_language_scores_join_words(monkeypatch, odd, share):
    """Scores do not depend on which words are broadcast."""
    monkeypatch.setattr("routeloom.llm.scoring.SHARED", share)
    source = odd.collect()
    want = defaultdict(list)
    for r, score in zip(source, expected_scores([r["text"] for r in source], 0), strict=True):
        want[r["doc_id"]].append(score)
    got = defaultdict(list)
    for r in language_scores(odd).collect():
        got[r["doc_id"]].append(r["score"])
    ordered = lambda x: sorted(x, key=lambda s: (s is None, s))
    assert set(got) == set(want)
    for i in want:
        assert ordered(got[i]) == pytest.approx(ordered(want[i]))


def test_language_score_edges(empty, docs):
    assert language_scores(empty).count() == 0
    with pytest.raises(ValueError, match="rare"):
        language_scores(docs, rare=1e-9)


def best_alignment(template, words):
    """Unbanded local alignment: the most matched words of the best score."""
    best, before = (0, 0), [(0, 0)] * (len(words) + 1)
    for own in template:
        row = [(0, 0)]
        for j, w in enumerate(words):
            score, matched = before[j]
            cells = [(score + 1, matched + 1) if own == w else (score - 1, matched)]
            cells += [(s - 1, m) for s, m in (before[j + 1], row[j])]
            cell = max(cells)
            row.append(cell if cell[0] > 0 else (0, 0))
            best = max(best, row[-1])
        before = row
    return best[1]


LICENSES = [
    ("one", "You may use this work freely for any purpose as long as this notice stays with it."),
    ("two", "All uses are forbidden."),
    ("three", " ".join(f"clause{i} says{i} something" for i in range(30))),
    ("four", "Gratis"),
]


def test_licenses(spark):
    edit = LICENSES[0][1].replace("freely", "quite freely").replace("purpose as", "purpose, AS")
    long = LICENSES[2][1].split()
    texts = [
        f"intro words here {LICENSES[0][1]} and more",
        f"Intro.\n{edit}\nafter that {LICENSES[1][1]}",
        " ".join(long[:50] + ["other"] + long[52:]),
        " ".join(long[:30]),
        f"{LICENSES[1][1]} x {LICENSES[1][1].upper()}",
        "nothing to see here all uses",
        "gratis",
        "",
        None,
    ]
    docs = spark.createDataFrame([*enumerate(texts), (None, texts[0])], "doc_id long, text string")
    got = scan_licenses(docs, LICENSES).collect()
    found = Counter((r["doc_id"], r["license"]) for r in got)
    want = Counter()
    for i, text in enumerate(texts):
        words = _hashes(text or "").tolist()
        for name, wording in LICENSES:
            target = _hashes(wording).tolist()
            if best_alignment(target, words) >= 0.8 * len(target):
                want[i, name] += 1
    want[4, "two"] += 1
    want[None, "one"] += 1
    want.pop((6, "four"), None)
    found.pop((6, "four"), None)
    assert found == want
    for r in got:
        assert 0.8 <= r["coverage"] <= 1 and r["start"] < r["end"]
        if r["doc_id"] is not None:
            part = texts[r["doc_id"]].encode()[r["start_byte"] : r["end_byte"]].decode()
            assert len(_hashes(part)) == r["end"] - r["start"]
    assert scan_licenses(docs.limit(0), LICENSES).count() == 0


def test_alignment_and_index():
    a = list(range(30))
    b = [99] * 4 + a[:10] + [77] + a[10:20] + a[22:] + [98]
    assert align(a, b, 0, 8) == (28, 0, 30, 4, 33)
    grams = Index.winnow(np.arange(20, dtype=np.uint64))
    places = [p for p, _ in grams]
    assert all(any(p in range(i, i + 3) for p in places) for i in range(16))
    assert Index.winnow(np.zeros(0, np.uint64)) == []
