"""Line, passage and near-duplicate removal against brute force."""

import re
from collections import defaultdict

import numpy as np
import pytest

from routeloom.llm import near_dedup
from routeloom.llm.line_dedup import drop_repeated_lines
from routeloom.llm.near_dedup import near_duplicates
from routeloom.llm.substrings import remove_repeats, sliding_minimum

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def by_id(frame):
    rows = frame.collect()
    assert len({r["doc_id"] for r in rows}) == len(rows)
    return {r["doc_id"]: r for r in rows}


def line_key(line):
    return line.strip(" \t\n\x0b\x0c\r").translate(LOWER)


def expected_lines(rows):
    owners = defaultdict(set)
    for i, text, *_ in rows:
        for line in (text or "").split("\n"):
            owners[line_key(line)].add(i)
    out = {}
    for i, text, *_ in rows:
        kept = [
            line
            for line in (text or "").split("\n")
            if len(line_key(line)) < 10 or min(owners[line_key(line)]) == i
        ]
        out[i] = kept
    return out


@pytest.mark.parametrize("max_bits", [1 << 28, 1 << 13])
def test_lines(docs, rows, max_bits):
    got = by_id(drop_repeated_lines(docs, max_bits=max_bits))
    want = expected_lines(rows)
    for i, text, *_ in rows:
        lines = (text or "").split("\n")
        assert got[i]["n_lines"] == len(lines)
        assert got[i]["n_dropped"] == len(lines) - len(want[i])
        assert got[i]["text"] == (None if text is None else "\n".join(want[i]))
        assert got[i]["source"] == "s" and got[i]["n_words"] == 7
    assert sum(r["n_dropped"] for r in got.values()) > 10


def test_lines_with_odd_rows(odd, rows, empty):
    want = expected_lines(rows)
    got = drop_repeated_lines(odd).collect()
    assert len(got) == odd.count()
    for r in got:
        if r["doc_id"] is None:
            assert r["n_dropped"] == 0
        elif r["text"] is not None:
            assert r["text"] == "\n".join(want[r["doc_id"]])
    assert drop_repeated_lines(empty).count() == 0


def expected_repeats(rows, least):
    seen, out = set(), {}
    for i, text, *_ in sorted(rows, key=lambda r: r[0]):
        words = WORD.findall(text or "")
        hit = np.zeros(len(words), bool)
        for k in range(len(words) - least + 1):
            window = tuple(words[k : k + least])
            if window in seen:
                hit[k : k + least] = True
            seen.add(window)
        out[i] = (words, hit)
    return out


@pytest.mark.parametrize(("least", "seed_words"), [(20, 5), (7, 3), (3, 5)])
def test_repeats(docs, rows, least, seed_words):
    got = by_id(remove_repeats(docs, least, seed_words=seed_words))
    for i, (words, hit) in expected_repeats(rows, least).items():
        r = got[i]
        assert (r["n_words"], r["n_removed"]) == (len(words), hit.sum())
        kept = " ".join(w for w, h in zip(words, hit, strict=True) if not h)
        assert (r["text"] or "") == kept
        spans = np.zeros(len(words), bool)
        for s in r["repeats"]:
            assert s["end"] - s["start"] >= least
            spans[s["start"] : s["end"]] = True
        assert (spans == hit).all()


def test_repeats_with_odd_rows(odd, rows, empty):
    want = expected_repeats(rows, 20)
    got = remove_repeats(odd).collect()
    assert len(got) == odd.count()
    for r in got:
        gone = 0 if r["doc_id"] is None else want[r["doc_id"]][1].sum()
        assert r["n_removed"] == gone
    assert remove_repeats(empty).count() == 0


def test_sliding_minimum():
    values = np.random.default_rng(0).integers(0, 99, 60).astype(np.uint64)
    for width in (1, 2, 3, 8, 13):
        want = [values[i : i + width].min() for i in range(60 - width + 1)]
        assert sliding_minimum(values, width).tolist() == want


def shingle_sets(rows, size):
    out = {}
    for i, text, *_ in rows:
        words = WORD.findall((text or "").translate(LOWER))
        if len(words) >= size:
            out[i] = {tuple(words[k : k + size]) for k in range(len(words) - size + 1)}
        else:
            out[i] = {tuple(words)} if words else set()
    return out


def expected_groups(sets, percent):
    label = {i: i for i in sets}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    keys = sorted(sets)
    for a in keys:
        for b in keys:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                label[y] = x
    return {i: root(i) for i in keys}


@pytest.mark.parametrize(("size", "percent"), [(4, 80), (5, 90)])
def test_near_duplicates(docs, rows, size, percent):
    sets = shingle_sets(rows, size)
    groups = expected_groups(sets, percent)
    got = by_id(near_duplicates(docs, size, percent))
    for i, group in groups.items():
        r = got[i]
        assert (r["n_shingles"], r["component_id"], r["kept"]) == (len(sets[i]), group, group == i)
    assert len(set(groups.values())) < len(groups) - 8


def test_near_duplicates_with_odd_rows(odd, rows, empty):
    groups = expected_groups(shingle_sets(rows, 5), 80)
    got = near_duplicates(odd).collect()
    assert len(got) == odd.count()
    for r in got:
        assert r["component_id"] == (None if r["doc_id"] is None else groups[r["doc_id"]])
        assert r["kept"] == (r["doc_id"] is None or r["component_id"] == r["doc_id"])
    assert near_duplicates(empty).count() == 0


def test_pairs_of_like_documents_stay_few(spark, monkeypatch):
    """A family of copies well below the threshold: verified pairs do not grow with its square."""
    counts, plain = [], near_dedup.stored

    def counting(df, name):
        table = plain(df, name)
        if name == "pairs":
            counts.append(table.count())
        return table

    monkeypatch.setattr(near_dedup, "stored", counting)
    rng = np.random.default_rng(4)
    base = [f"word{i}" for i in range(60)]
    verified = []
    for n in (100, 200):
        rows = []
        for i in range(n):
            words = list(base)
            for place in rng.choice(60, 2, replace=False):
                words[place] = f"other{i}x{place}"
            rows.append((i, " ".join(words)))
        docs = spark.createDataFrame(rows, "doc_id long, text string")
        groups = expected_groups(shingle_sets(rows, 4), 80)
        counts.clear()
        got = by_id(near_duplicates(docs, 4))
        assert {i: r["component_id"] for i, r in got.items()} == groups
        verified.append(sum(counts))
    assert verified[1] < 16 * 200 and verified[1] <= 3 * verified[0], verified


@pytest.mark.parametrize("block", [1000, 150])
def test_crowded_bucket_takes_few_pairs_at_a_time(spark, monkeypatch, block):
    """All of a bucket's members may be likely pairs; a task's memory does not grow with them."""
    real = near_dedup.may_reach

    def bounded(a, *rest):
        assert len(a) <= 1 << 13, f"{len(a)} pairs at a time"
        return real(a, *rest)

    n = 300
    rng = np.random.default_rng(8)
    pool = rng.integers(1, 1 << 62, 120).astype(np.uint64)
    own = rng.integers(1, 1 << 62, (n, 30)).astype(np.uint64)
    # of 120 each: similarities about 0.78 and 0.6
    cuts = [105 - i % 2 * 10 for i in range(n)]
    sets = [np.sort(np.concatenate([pool[:c], o[: 120 - c]])) for c, o in zip(cuts, own, strict=True)]
    at, hashes, size = np.repeat(np.arange(n), 120), np.concatenate(sets), np.full(n, 120)
    registers = near_dedup.sketch(at, hashes, n)
    registers[:, :4] = registers[0, :4]  # a band that all share
    fine = near_dedup.low_bytes(near_dedup.sketch(at, hashes, n, near_dedup.FINE))
    key = int(near_dedup.band_keys(registers)[0, :1].view(np.int64)[0])
    a, b = np.triu_indices(n, 1)
    keep = (registers[a] == registers[b]).sum(axis=1) >= 64
    keep &= real(registers[a], registers[b], size[a], size[b], 0.8)
    keep &= near_dedup.may_reach_finely(fine[a], fine[b], size[a], size[b], 0.8)
    want = set(zip(a[keep].tolist(), b[keep].tolist(), strict=True))
    assert 2 * n < len(want) < n * (n - 1) // 2

    monkeypatch.setattr(near_dedup, "may_reach", bounded)
    monkeypatch.setattr(near_dedup, "BLOCK", block)
    rows = [(i, 120, bytes(registers[i])) for i in range(n)]
    nodes = spark.createDataFrame(rows, "_id long, n long, registers binary")
    members = spark.createDataFrame([(key, i, i) for i in range(n)], "key long, node long, label long")
    rows = [(i, s.view(np.int64).tolist()) for i, s in enumerate(sets)]
    full = spark.createDataFrame(rows, "node long, shingles array<long>")
    docs = spark.createDataFrame([], "_id long, _text string")
    got = near_dedup._Finder(docs, 4, 80).across(members, nodes, full, nearest=False).collect()
    assert len(got) == len(want) and {(r["a"], r["b"]) for r in got} == want


def test_rows_do_not_grow_with_pairs_just_below_the_threshold(spark, monkeypatch):
    """A family at similarities of about 0.75: no table has more rows than bands of documents."""
    counts, plain = {}, near_dedup.stored

    def counting(df, name):
        table = plain(df, name)
        counts[name] = max(counts.get(name, 0), table.count())
        return table

    monkeypatch.setattr(near_dedup, "stored", counting)
    rng = np.random.default_rng(11)
    n, base = 150, [f"word{i}" for i in range(300)]
    rows, sets = [], {}
    while len(rows) < n:
        words = list(base)
        for place in rng.choice(300, 5, replace=False):
            words[place] = f"other{len(rows)}x{place}"
        rows.append((len(rows), " ".join(words)))
        own = shingle_sets(rows[-1:], 4)[len(rows) - 1]
        if any(100 * len(own & old) >= 80 * len(own | old) for old in sets.values()):
            rows.pop()
        else:
            sets[len(rows) - 1] = own
    for i in range(0, 30, 10):  # links of a few
        rows.append((n + i, rows[i][1].replace("word7 ", "more ")))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    groups = expected_groups(shingle_sets(rows, 4), 80)
    assert n - 10 < len(set(groups.values())) < len(rows)
    got = by_id(near_duplicates(docs, 4))
    assert {i: r["component_id"] for i, r in got.items()} == groups
    assert max(counts.values()) <= near_dedup.REGISTERS // near_dedup.BAND * len(rows), counts


@pytest.mark.parametrize(("block", "shingles"), [(1000, 1 << 19), (70, 1 << 19), (1000, 4000)])
def test_links_of_a_crowded_bucket(spark, monkeypatch, block, shingles):
    """Links found in a bucket, in blocks by members or shingles, give brute force's components."""
    monkeypatch.setattr(near_dedup, "BLOCK", block)
    monkeypatch.setattr(near_dedup, "SHINGLES", shingles)
    n = 200
    rng = np.random.default_rng(9)
    pool = rng.integers(1, 1 << 62, 130).astype(np.uint64)
    own = rng.integers(1, 1 << 62, (n, 130)).astype(np.uint64)
    # some sets reach 0.8 with one another, some with the largest only, some with none
    cuts = [(122, 116, 113, 104, 30)[i % 5] for i in range(n)]
    sets = [np.sort(np.concatenate([pool[:c], o[c:]])) for c, o in zip(cuts, own, strict=True)]
    at, hashes = np.repeat(np.arange(n), 130), np.concatenate(sets)
    registers = near_dedup.sketch(at, hashes, n)
    registers[:, :4] = registers[0, :4]  # a band that all share
    keys = near_dedup.band_keys(registers).view(np.int64)
    rows = [(i, 130, bytes(registers[i])) for i in range(n)]
    nodes = spark.createDataFrame(rows, "_id long, n long, registers binary")
    rows = [(int(keys[0, 0]), i, i) for i in range(n)]
    members = spark.createDataFrame(rows, "key long, node long, label long")
    rows = [(i, s.view(np.int64).tolist()) for i, s in enumerate(sets)]
    full = spark.createDataFrame([*rows, (5, [])], "node long, shingles array<long>")
    finder = near_dedup._Finder(spark.createDataFrame([], "_id long, _text string"), 4, 80)
    likely = finder.across(members, nodes, full, False, "members").cache()
    found = [tuple(r) for r in finder.across(likely, nodes, full, False, "links").collect()]
    want = expected_groups({i: set(s.tolist()) for i, s in enumerate(sets)}, 80)
    assert {r["node"] for r in likely.collect()} >= {i for i in want if list(want.values()).count(want[i]) > 1}
    for a, b in found:
        both = len(np.intersect1d(sets[a], sets[b]))
        assert 100 * both >= 80 * (260 - both)
    group = np.arange(n)
    near_dedup.joining(*(np.array(x) for x in zip(*found, strict=True)), group)
    assert group.tolist() == [want[i] for i in range(n)] and len(set(group)) < n - 40
    parts = max(-(-n // block), -(-n * 130 // shingles))
    assert len(found) < n * (parts + 1)


def test_overlaps_of_sets():
    rng = np.random.default_rng(2)
    sets = [rng.choice(60, rng.integers(1, 50), replace=False).tolist() for _ in range(30)]
    overlaps = near_dedup.Overlaps(near_dedup.pa.array([[1], *sets])[1:])
    a, b = (x.ravel() for x in np.meshgrid(np.arange(30), np.arange(30)))
    want = [len({*sets[x]} & {*sets[y]}) for x, y in zip(a, b, strict=True)]
    assert overlaps.common(a, b).tolist() == want
    assert overlaps.common(a[:0], b[:0]).tolist() == []


def test_finer_registers_keep_what_reaches_the_threshold():
    rng = np.random.default_rng(6)
    pool = rng.integers(1, 1 << 63, 4000).astype(np.uint64)
    sets = []
    for common in (178, 160, 150, 120, 60):  # of 200 each: similarities 0.8, 0.67, 0.6, 0.43, 0.18
        for _ in range(20):
            own = rng.choice(pool, 400 - common, replace=False)
            sets += [own[:200], own[200 - common :]]
    at = np.repeat(np.arange(200), 200)
    fine = near_dedup.low_bytes(near_dedup.sketch(at, np.concatenate(sets), 200, near_dedup.FINE))
    n = np.full(100, 200)
    kept = near_dedup.may_reach_finely(fine[0::2], fine[1::2], n, n, 0.8).reshape(5, 20)
    assert kept[0].all() and not kept[2:].any()


def test_chain_that_no_centre_sees(spark):
    """Neighbours are linked, ends are not; every centre misses some links."""
    words = [f"w{i}" for i in range(260)]
    rows = [(100 - i, " ".join(words[12 * i : 12 * i + 120])) for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    groups = expected_groups(shingle_sets(rows, 5), 80)
    got = by_id(near_duplicates(docs))
    assert {i: r["component_id"] for i, r in got.items()} == groups
    assert len(set(groups.values())) == 1


def test_sketches_estimate_and_merge():
    rng = np.random.default_rng(5)
    pool = rng.integers(1, 1 << 63, 1400).astype(np.uint64)
    sets = [pool[:1000], pool[200:1200], pool[:600], pool[600:1400], pool]
    at = np.concatenate([np.full(len(s), i) for i, s in enumerate(sets)])
    registers = near_dedup.sketch(at, np.concatenate(sets), 5)
    whole = near_dedup.merge(registers[2], registers[3])
    assert (whole == registers[4]).all()
    n = np.array([len(s) for s in sets])
    grid = np.linspace(0, 1, 101)
    logs = near_dedup.log_likelihoods(registers[:1], registers[1:2], n[:1], n[1:2], grid)
    assert abs(grid[logs[0].argmax()] - 800 / 1200) < 0.15
    far = near_dedup.may_reach(registers[2:3], registers[3:4], n[2:3], n[3:4], 0.8)
    near = near_dedup.may_reach(registers[:1], registers[:1], n[:1], n[:1], 0.8)
    assert not far[0] and near[0]
