"""Packing and sharding: exact round trips and their laws."""

import random
from itertools import combinations
from math import ceil

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from routeloom.llm.packing import Packer, WordTokens, best_fill, pack_documents
from routeloom.llm.sharding import shard_documents, write_shards

PATH = public_tokenizers.path("word_bpe_49k.json")


def encoded(text):
    tokenizer = Tokenizer.from_file(PATH)
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [1]


@pytest.mark.parametrize(("capacity", "pool"), [(2048, 1 << 22), (64, 500)])
def test_round_trip(docs, rows, capacity, pool):
    got = pack_documents(docs, PATH, capacity, pool_tokens=pool).collect()
    pieces, sequences = {}, {}
    for r in got:
        ids = np.frombuffer(r["ids"], "<u4").tolist()
        assert len(ids) == r["length"] > 0
        pieces.setdefault(r["doc_id"], []).append((r["start"], ids, r["doc_tokens"]))
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], len(ids)))
    for i, text, *_ in rows:
        whole = []
        for start, ids, n in sorted(pieces[i]):
            assert start == len(whole)
            whole += ids
        assert whole == encoded(text) and n == len(whole)
    padded = total = 0
    for parts in sequences.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= capacity
        total += at
        padded += 0 if at & (at - 1) == 0 else capacity - at
    assert padded == 0
    partitions = docs.rdd.getNumPartitions()
    assert len(sequences) <= total // capacity + partitions * capacity.bit_length()


def test_case_keeping_tokenizer(tmp_path):
    """Without the step that lower-cases, no word takes the short way."""
    import json

    with open(PATH) as file:
        spec = json.load(file)
    steps = spec["normalizer"]["normalizers"]
    spec["normalizer"]["normalizers"] = [x for x in steps if x["type"] != "Lowercase"]
    assert len(steps) > len(spec["normalizer"]["normalizers"])
    path = tmp_path / "cased.json"
    path.write_text(json.dumps(spec))
    plain = Tokenizer.from_file(str(path))
    texts = ["Hello World", "hello world", "The END, of\nthe Word. iPhone ÉTÉ été"]
    tokens = WordTokens(str(path))
    assert not tokens.straight and WordTokens(PATH).straight
    for text, ids in zip(texts, tokens(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids


def test_words_are_cut_safely():
    """Ids of odd texts equal the tokenizer's own."""
    odd = "don't DON'T, we'll... '!! a.b,c a!=b 3.14,15 é.é ÀÉ!! İst Σας. KK"
    texts = [odd, "H̱e é. a̸=", "x<|endoftext|>, <|STARTOFTEXT|>", "", "  \n ", "a\x1cb\x85c　d", None]
    rng = random.Random(2)
    signs = "abcXYZéß .,!?'#&\n\t1́×"
    texts += ["".join(rng.choice(signs) for _ in range(60)) for _ in range(200)]
    tokens = WordTokens(PATH)
    assert tokens.straight
    found = [np.frombuffer(x, "<u4").tolist() for x in tokens([t or "" for t in texts])]
    assert found == [encoded(t)[:-1] for t in texts]


def test_best_fill_is_best():
    rng = random.Random(4)
    for _ in range(150):
        counts = {rng.randint(1, 40): rng.randint(1, 3) for _ in range(4)}
        pieces = [x for x, n in counts.items() for _ in range(n)]
        top = max(pieces)
        rest = list(pieces)
        rest.remove(top)
        sums = {top + sum(c) for k in range(len(rest) + 1) for c in combinations(rest, k)}
        taken = best_fill(counts, 64)
        assert all(n <= counts[x] for x, n in taken.items())
        assert sum(x * n for x, n in taken.items()) == max(s for s in sums if s <= 64)


def test_pool_shrinks_when_nothing_fits():
    """Pieces that cannot sum to a window are cut to close it, and all tokens are placed once."""
    packer, placed = Packer(2048, 0), []
    for i in range(50):
        packer.add((i, 0, bytes(4 * 1500)))
        if packer.total > 8192:
            placed += packer.fill(4096)
            assert packer.total <= 4096
    assert packer.total == sum(x * len(p) for x, p in packer.pool.items())
    placed += packer.finish()
    places, tokens = [], []
    for (i, start, ids), sequence, at in placed:
        places += [(sequence, at + k) for k in range(len(ids) // 4)]
        tokens += [(i, start + k) for k in range(len(ids) // 4)]
    assert sorted(tokens) == [(i, k) for i in range(50) for k in range(1500)]
    assert len(set(places)) == len(places)
    assert [sum(q == s for q, _ in places) for s in range(36)] == [2048] * 36


def test_packing_edges(odd, empty, spark):
    assert pack_documents(empty, PATH).count() == 0
    assert pack_documents(odd, PATH).where("start = 0").count() == odd.count()
    with pytest.raises(ValueError, match="power of two"):
        pack_documents(odd, PATH, 100)


@pytest.mark.parametrize("bucket_bytes", [32 << 20, 400])
def test_shards(docs, rows, bucket_bytes):
    got = shard_documents(docs, 4, bucket_bytes=bucket_bytes).collect()
    assert sorted(r["doc_id"] for r in got) == [r[0] for r in rows]
    grown = {r["doc_id"]: r["shard"] for r in shard_documents(docs, 5).collect()}
    texts = {r[0]: r[1] for r in rows}
    slots = {}
    for r in got:
        text = texts[r["doc_id"]]
        assert r["text"] == text and r["size"] == len((text or "").encode()) + 1
        assert r["grown_shard"] == grown[r["doc_id"]] and r["grown_shard"] in (r["shard"], 4)
        assert r["_id"] == "id" and "Size" not in r.asDict()
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert len(slots) == 4 and all(sorted(s) == list(range(len(s))) for s in slots.values())
    again = shard_documents(docs.repartition(3), 4, bucket_bytes=bucket_bytes).collect()
    assert {(r["doc_id"], r["shard"]) for r in again} == {(r["doc_id"], r["shard"]) for r in got}


def test_order_is_mixed(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("same").alias("text"))
    got = shard_documents(docs, 2, bucket_bytes=4000).where("shard = 0").orderBy("slot").collect()
    ids = [r["doc_id"] for r in got]
    rising = sum(a < b for a, b in zip(ids, ids[1:], strict=False))
    assert 0.45 < rising / len(ids) < 0.55
    sizes = shard_documents(docs, 2, bucket_bytes=4000).groupBy("shard", "bucket").count().collect()
    assert len(sizes) == 2 * ceil(max(len(ids), 4000 - len(ids)) * 5 / 4000)
    assert all(600 < r["count"] < 1000 for r in sizes)


def test_sharding_edges(odd, empty, spark, tmp_path):
    assert shard_documents(empty).count() == 0
    got = shard_documents(odd, 3)
    assert got.count() == odd.count()
    assert got.where("doc_id IS NULL").select("shard").distinct().count() == 1
    write_shards(odd, f"file://{tmp_path}/shards", 3)
    assert spark.read.parquet(f"file://{tmp_path}/shards").count() == odd.count()


def test_files_of_a_shard_follow_its_slots(spark, docs, tmp_path):
    """Buckets of a few bytes go to many files; by their names they hold slots in order."""
    rows = docs.where("text IS NOT NULL")
    write_shards(rows, f"file://{tmp_path}/shards", 2, bucket_bytes=64)
    seen = 0
    for folder in sorted((tmp_path / "shards").glob("shard=*")):
        slots = []
        for file in sorted(folder.glob("*.parquet")):
            slots += pq.ParquetFile(file).read(["slot"]).column("slot").to_pylist()
        assert slots == list(range(len(slots)))
        seen += len(slots)
    assert seen == rows.count()
