"""Token counts, the filter audit and the repair of conversations, against brute force."""

import hashlib
import random
import zlib
from itertools import permutations, product

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from routeloom.llm.conversations import (
    as_turns,
    damaged,
    find_repairs,
    repair,
    repaired_digests,
    repaired_turns,
)
from routeloom.llm.filter_audit import Fields, audit_filters, audit_masks
from routeloom.llm.token_counts import PieceCounter, _leftmost_first, count_tokens

PIECES = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PIECES)


# --- token counts ---


def test_counts_equal_the_library(library):
    texts = ["", " ", "  ", "a  b", " " * 40 + "x", "▁ ▁▁b", "a ▁b", "\n\n x\n", "a \n b", "x" * 5000]
    texts += ["ﬁ Ⅷ é é \x00 <s> </s> <unk> <0x41> \t\r", "👩‍👩‍👧 中文字符没有空格的句子，需要切分。 ß", "a" + " " * 33 + "\n" + " " * 16]
    rng = random.Random(1)
    signs = "ab cdeё  ▁\n\n.,'thehein中é👩"
    for n in (3, 10, 30, 200):
        texts += ["".join(rng.choice(signs) for _ in range(n)) for _ in range(500)]
    letters = "aeiothns "
    texts += ["".join(rng.choice(letters) for _ in range(80)) for _ in range(3000)]
    texts += ["".join(chr(rng.randrange(1, 0xD800)) for _ in range(50)) for _ in range(200)]
    assert PieceCounter(PIECES)(texts) == [len(ids) for ids in library.encode(texts)]


def test_long_runs_are_quick(library):
    counter = PieceCounter(PIECES)
    for text in (" " * 100_000, "=" * 100_000, "ab" * 50_000, "\n" * 100_000, "中 " * 30_000):
        assert counter([text]) == [len(library.encode(text))]


def test_merges_that_make_a_pair_of_lower_rank():
    """With pieces in an order no training gives, places of a rank cannot all merge at once."""
    counter = PieceCounter.__new__(PieceCounter)
    rng = random.Random(5)
    for _ in range(60):
        pieces = {c: 0.0 for c in "abc"}
        for _ in range(rng.randrange(2, 12)):
            pieces["".join(rng.choice("abc") for _ in range(rng.randrange(2, 5)))] = -rng.randrange(1, 6)
        counter._blank_runs(pieces)
        counter._tables(pieces)
        words = ["".join(rng.choice("abc") for _ in range(rng.randrange(1, 14))) for _ in range(40)]
        for word, got in zip(words, counter.count(words).tolist(), strict=True):
            parts = list(word)
            while True:
                found = [
                    (-pieces[a + b], i)
                    for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False))
                    if a + b in pieces
                ]
                if not found:
                    break
                _, at = min(found)
                parts[at : at + 2] = [parts[at] + parts[at + 1]]
            assert got == len(parts), (word, pieces)


def test_runs_of_blanks():
    assert [_leftmost_first(n, {1, 2, 3}) for n in range(8)] == [0, 1, 1, 1, 2, 2, 2, 3]


@pytest.mark.parametrize("fixture", ["docs", "odd", "empty"])
def test_token_counts(request, library, fixture):
    docs = request.getfixturevalue(fixture).withColumn("N_Tokens", F.lit("old"))
    got = count_tokens(docs, PIECES, limit=100)
    assert [c for c in got.columns if c not in docs.columns] == ["n_bytes", "n_tokens", "over_limit"]
    assert "N_Tokens" not in got.columns and "_id" in got.columns
    want = []
    for r in docs.collect():
        n = len(library.encode(r["text"] or ""))
        want.append((r["doc_id"], len((r["text"] or "").encode()), n, n > 100))
    rows = got.select("doc_id", "n_bytes", "n_tokens", "over_limit").collect()
    assert sorted(map(tuple, rows), key=str) == sorted(want, key=str)


# --- filter audit ---


def brute_audit(rows, labels):
    """The audit by applying each order to each document."""
    def words(t):
        for c in "\t\n\x0b\x0c\r":
            t = t.replace(c, " ")
        return [w for w in t.split(" ") if w]

    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    firsts = {}
    for i, t, _ in rows:
        if i is not None:
            firsts[t or ""] = min(i, firsts.get(t or "", i))
    parts, fails = {}, []
    for i, t, lang in rows:
        w, t = words(t or ""), t or ""
        bad = ""
        bad += "A" if len(w) < 200 else ""
        bad += "B" if 100 * len(set(w)) < 50 * len(w) else ""
        bad += "C" if 100 * sum("A" <= c <= "Z" for c in t) > 3 * len(t) else ""
        bad += "D" if any(c in "#$%&*|" for c in t) else ""
        bad += "E" if i is not None and firsts[t] < i else ""
        parts.setdefault(lang or "", []).append((i, bad))
        fails.append(bad)
    out = {}
    for part, members in parts.items():
        shapley = dict.fromkeys("ABCDE", 0)
        for order in map("".join, permutations("ABCDE")):
            live = set(range(len(members)))
            for step, f in enumerate(order, 1):
                hit = {k for k in live if f in members[k][1]}
                failing = [m for m in members if f in m[1]]
                live -= hit
                shapley[f] += len(hit)
                out[part, order, step] = [
                    len(live),
                    len(hit),
                    len(failing) - len(hit),
                    sum(m[1] == f for m in members),
                    sum(members[k][0] in good for k in hit),
                    sum(members[k][0] in toxic for k in hit),
                ]
        for (p, order, step), values in out.items():
            if p == part:
                values.append(shapley[order[step - 1]])
    return {key: tuple(v) for key, v in out.items()}


def test_fields_hold_the_largest_counts():
    n = (1 << 32) - 1
    found = audit_masks([0b11, 0, 1], [True, False, True], [False] * 3, [n, 5, 7], "AB")
    # orders AB, BA
    assert found["removed"].tolist() == [[n + 7, 0], [n, 7]]
    assert found["kept"].tolist() == [[5, 5], [12, 5]]
    assert found["redundant"].tolist() == [[0, n], [0, n]]
    assert found["unique_fails"].tolist() == [[7, 0], [0, 7]]
    assert found["good_lost"].tolist() == [[n + 7, 0], [n, 7]]
    assert found["shapley"].tolist() == [[n + 14, n], [n, n + 14]]
    assert Fields("ABCDE", 2).steps == 600


@pytest.mark.parametrize("fixture", ["docs", "odd", "empty"])
def test_filter_audit(spark, request, fixture):
    docs = request.getfixturevalue(fixture)
    more = [(900 + k, t, lang) for k, (t, lang) in enumerate(product(
        ["W w x " * 90, "a b c d e " * 3, " ".join(f"v{i}" for i in range(300)), "", "A | B"], ["en", "fr", None, ""]
    ))]
    more += more[:5] + [(None, "", None), (None, "W w x " * 90, "en")]
    if fixture != "empty":
        docs = docs.unionByName(
            spark.createDataFrame(more, "doc_id bigint, text string, lang string"), allowMissingColumns=True
        )
    rng = random.Random(4)
    ids = [r[0] for r in docs.select("doc_id").collect()]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in ids * 2 if rng.random() < 0.6]
    table = spark.createDataFrame([(*x, "en") for x in labels], "doc_id bigint, quality int, toxic int, lang string")
    got = {tuple(r[:3]): tuple(r[3:]) for r in audit_filters(docs, table).collect()}
    rows = [tuple(r) for r in docs.select("doc_id", "text", "lang").collect()]
    want = brute_audit(rows, labels)
    assert got == want and len(got) == 600 * len({r[2] or "" for r in rows})


# --- conversations ---


def cheapest(codes):
    """Least (cost, audit) by trying all edits, shortest first (uniform-cost search)."""
    import heapq

    heap, done = [(0, "", 0, "")], set()
    names = " sua"
    while heap:
        cost, audit, at, state = heapq.heappop(heap)
        if (at, state) in done:
            continue
        done.add((at, state))
        if at == len(codes) and state in ("", "a"):
            return cost, audit
        need = "a" if state == "u" else "u"
        heapq.heappush(heap, (cost + 2, audit + "I", at, need))
        if at < len(codes):
            fault, role = codes[at] >> 2, names[codes[at] & 3]
            heapq.heappush(heap, (cost + 3, audit + "D", at + 1, state))
            if fault < 2:
                if role == need or (role == "s" and state == ""):
                    heapq.heappush(heap, (cost + fault, audit + "K", at + 1, role))
                heapq.heappush(heap, (cost + fault + 2, audit + "R", at + 1, need))


def test_repairs_are_the_cheapest_and_least():
    for n in range(4):
        for codes in product(range(16), repeat=n):
            assert repair(bytes(codes)) == cheapest(codes), codes
    rng = random.Random(8)
    for _ in range(3000):
        codes = [rng.choice([1, 2, 3, 2, 3, rng.randrange(16)]) for _ in range(rng.randrange(4, 40))]
        assert repair(bytes(codes)) == cheapest(codes), codes


def test_long_conversations_are_quick():
    rng = random.Random(9)
    for weights in ([2, 3], list(range(16)), [2], [3, 3, 2], [1, 2, 7]):
        codes = bytes(rng.choice(weights) for _ in range(2000))
        assert repair(codes) == cheapest(codes)


def brute_damage(rows):
    out, ids = {}, {}
    for conv, turn, role, text in rows:
        ids[conv] = None
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        fault = zlib.crc32(key.encode()) % 20
        if fault == 1:
            text = ""
        if fault == 2:
            text = "".join(c for c in text if c not in ".!?")
        if fault == 4:
            role = "user"
        out.setdefault(conv, [])
        out[conv] += [(turn, role, text)] * (0 if fault == 0 else 2 if fault == 3 else 1)
    return {c: sorted(out.get(c, []), key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])) for c in ids}


def brute_repairs(conversations):
    for conv, rows in conversations.items():
        seen, counts, codes = set(), [0, 0, 0], []
        for _, role, text in rows:
            core = text.strip(" \t\n\x0b\x0c\r")
            fault = 2 if not core else 3 if (role, text) in seen else 1 if core[-1] not in ".!?" else 0
            seen.add((role, text))
            if fault:
                counts[{2: 0, 3: 1, 1: 2}[fault]] += 1
            codes.append(4 * fault + {"s": 1, "u": 2, "a": 3}.get(role[:1], 0))
        pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:], strict=False)]
        turns = {r[0] for r in rows} - {None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        cost, audit = cheapest(codes)
        fixed, at, state = [], 0, ""
        for edit in audit:
            need = "a" if state == "u" else "u"
            full = {"a": "assistant", "u": "user"}[need]
            if edit == "I":
                fixed.append((full, ""))
                state = need
                continue
            _, role, text = rows[at]
            at += 1
            if edit == "K":
                fixed.append((role, text))
                state = role[0]
            elif edit == "R":
                fixed.append((full, text))
                state = need
        sha = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in fixed).encode()).hexdigest()
        illegal = sum(p not in ("su", "ua", "au") for p in pairs)
        yield (conv, gaps, *counts, illegal, cost, audit, sha), fixed


def some_turns():
    rng = random.Random(6)
    rows = []
    texts = ["Yes.", "No", "Why?\n", " \t", "", None, "end! \x0b", "Ünï", "x ", "Same.", "Same."]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None, "ustad"]
    for conv in [*range(60), None]:
        for turn in range(rng.choice([1, 2, 4, 8, 8, 30])):
            number = rng.choice([turn, turn, turn, turn + 3, None])
            rows.append((conv, number, rng.choice(roles[: rng.choice([2, 4, 9])]), rng.choice(texts)))
    rows += [r for r in rows if rng.random() < 0.1]
    return rows


@pytest.mark.parametrize("empty", [False, True])
def test_conversation_repair(spark, empty):
    rows = [] if empty else some_turns()
    schema = "conv_id bigint, turn bigint, role string, text string, Conv string, there string, audit string"
    table = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], schema).repartition(5)
    turns = damaged(table.drop("x"))
    found = find_repairs(turns)
    want = list(brute_repairs(brute_damage(rows)))
    got = repaired_digests(turns, found).collect()
    assert sorted(map(tuple, got), key=str) == sorted((w for w, _ in want), key=str)
    texts = [(w[0], k, *pair) for w, fixed in want for k, pair in enumerate(fixed)]
    turned = repaired_turns(turns, found).select("conv", "place", "role", "text").collect()
    assert sorted(map(tuple, turned), key=str) == sorted(texts, key=str)


def test_sound_conversations_stay(spark):
    rows = [(c, t, "user" if t % 2 == 0 else "assistant", f"Turn {t}.") for c in "pq" for t in range(6)]
    turns = as_turns(spark.createDataFrame(rows, "conv_id string, turn int, role string, text string"))
    found = find_repairs(turns)
    assert {(r["cost"], r["audit"], r["illegal"]) for r in found.collect()} == {(0, "KKKKKK", 0)}
    assert repaired_turns(turns, found).where("edit = 'K'").count() == 12


def test_queries_of_whole_tables(spark, sf, library):
    from routeloom.llm.queries import QUERIES

    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    want = {r[0]: len(library.encode(r[1] or "")) for r in docs}
    got = {r["doc_id"]: r for r in QUERIES["op11_token_counts"](spark, sf).collect()}
    assert {i: r["n_tokens"] for i, r in got.items()} == want
    assert all(r["over_limit"] == (r["n_tokens"] > 4096) for r in got.values())
    turns = spark.read.parquet(f"{sf}/conversations.parquet")
    rows = [tuple(r) for r in turns.select("conv_id", "turn", "role", "text").collect()]
    got = QUERIES["op13_conversation_repair"](spark, sf)
    assert got.columns[0] == "conv_id" and got.columns[-1] == "repaired_sha256"
    want = sorted(w for w, _ in brute_repairs(brute_damage(rows)))
    assert sorted(map(tuple, got.collect())) == want
