import itertools
import math
import random

import pytest
from pyspark.sql import functions as F

from routeloom.operators import features, models, similarity, statistics
from routeloom.operators.rules import association_rules
from routeloom.operators.words import word_counts
from routeloom.streaming.windows import WindowCounts
from routeloom.streaming.words import count_stream, running_total, text_stream
from routeloom.workspace import new_path


def test_word_counts(spark):
    df = spark.createDataFrame([("a b\ta",), ("b  b\n a",), ("",)], "text string")
    assert {tuple(r) for r in word_counts(df).collect()} == {("a", 3), ("b", 3)}


def test_stream_counts_each_batch(spark):
    path = new_path(spark, "texts")
    for text in ["x y x", "y z"]:
        spark.createDataFrame([(text,)], "text string").coalesce(1).write.mode("append").parquet(path)
    epochs = count_stream(text_stream(spark, path, files_per_batch=1)).cache()
    assert epochs.select("epoch_id").distinct().count() == 2
    assert sorted(tuple(r)[1:] for r in epochs.collect()) == [("x", 2), ("y", 1), ("y", 1), ("z", 1)]
    batch = word_counts(spark.read.parquet(path))
    assert {tuple(r) for r in running_total(epochs).collect()} == {tuple(r) for r in batch.collect()}


def test_windows_across_batches_and_restarts(spark):
    """State goes on after a restart; rows behind the watermark are left out and counted."""
    schema = "ts timestamp, kind string, value double"
    path = new_path(spark, "arrivals")

    def arrive(*rows):
        made = spark.createDataFrame([(str(t), k, v) for t, k, v in rows], "ts string, kind string, value double")
        made = made.withColumn("ts", F.try_to_timestamp(F.concat(F.lit("2024-01-01 "), "ts")))
        made.coalesce(1).write.mode("append").parquet(path)

    counts = WindowCounts(spark, path, schema, "ts", ["kind"], "value", "1 hour", "1 hour", 1)
    arrive(("00:10:00", "a", 1.0), ("00:20:00", "b", 2.0), ("01:05:00", "a", 4.0))
    arrive(("00:50:00", "a", 8.0), ("None", "a", 99.0), ("04:00:00", "b", 16.0))
    counts.run()
    got = {(r.kind, r.start.hour): (r.n, r.total) for r in counts.windows().collect()}
    assert got == {("a", 0): (2, 9.0), ("b", 0): (1, 2.0), ("a", 1): (1, 4.0), ("b", 4): (1, 16.0)}
    # a restart, of another object with the same progress; 00:30 is late by now, 03:59 is not
    arrive(("00:30:00", "a", 32.0), ("03:59:00", "a", 64.0), ("04:30:00", "b", 128.0))
    again = WindowCounts(spark, path, schema, "ts", ["kind"], "value", "1 hour", "1 hour", 1)
    again.out, again.progress = counts.out, counts.progress
    again.run()
    got = {(r.kind, r.start.hour): (r.n, r.total) for r in again.windows().collect()}
    assert got == {
        ("a", 0): (2, 9.0), ("b", 0): (1, 2.0), ("a", 1): (1, 4.0), ("a", 3): (1, 64.0), ("b", 4): (2, 144.0)
    }
    assert tuple(again.late().first()) == (1, 8)
    again.run()
    assert again.windows().count() == 5


def points(n, size, seed=1):
    r = random.Random(seed)
    return [(i, [r.uniform(0, 1) for _ in range(size)]) for i in range(n)]


def near(rows, threshold):
    pairs = itertools.combinations(rows, 2)
    return {(a, b): math.dist(x, y) for (a, x), (b, y) in pairs if math.dist(x, y) < threshold}


@pytest.mark.parametrize("threshold", [0.05, 0.3, 5.0])
def test_exact_pairs_by_brute_force(spark, monkeypatch, threshold):
    monkeypatch.setattr(similarity, "BLOCK", 7)
    rows = points(120, 3)
    copies = [(1000 + i, rows[5][1]) for i in range(40)]
    odd = [(2000, None), (2001, [None, 1.0, 2.0]), (2002, [float("nan"), 1.0, 2.0])]
    df = spark.createDataFrame(rows + copies + odd, "id bigint, v array<double>")
    found = similarity.similar_pairs(df, "id", "v", threshold, recall=None).collect()
    got = {(r.id_a, r.id_b): r.distance for r in found}
    assert got == pytest.approx(near(rows, threshold))
    assert len(found) == len(got), "a pair came out twice"
    counts = {r.id_a: r.copies_a for r in found} | {r.id_b: r.copies_b for r in found}
    assert all(counts[i] == (41 if i == 5 else 1) for i in counts)


@pytest.mark.parametrize("kind", ["float", "double"])
@pytest.mark.parametrize("far", [0.0, 1e6])
def test_large_cells_are_cut_into_few_blocks(spark, monkeypatch, kind, far):
    """A member of a cell is copied to as many units as the cell has blocks."""
    monkeypatch.setattr(similarity, "BLOCK", 2)
    monkeypatch.setattr(similarity, "TILE", 5, raising=False)
    monkeypatch.setattr(similarity, "FEW", 4)
    r = random.Random(9)
    rows = [(i, [far + r.randint(-20, 20) / 8 for _ in range(6)]) for i in range(150)]
    df = spark.createDataFrame(rows, f"id bigint, v array<{kind}>")
    search = similarity.NearPairs(df, "id", "v", 3.0, recall=None)
    found = search.pairs().collect()
    assert {(x.id_a, x.id_b): x.distance for x in found} == pytest.approx(near(rows, 3.0))
    assert len(found) == len(near(rows, 3.0)) > 100
    cells = search.cells.selectExpr("max(blocks) AS blocks", "max(homes + visits) AS n").first()
    assert cells.n > 100 and cells.blocks <= 16


def test_neighbouring_cells_hold_every_near_pair():
    """A grid with more axes than its plan would take misses nothing."""
    import numpy as np

    x = np.array([v for _, v in points(150, 4, 7)])
    axes = np.linalg.qr(np.random.default_rng(3).standard_normal((4, 4)))[0]
    for count in range(5):
        cells = {}
        for rows, keys, home in similarity.Grid(axes[:, :count], 0.2).places(x):
            for r, k, h in zip(rows.tolist(), keys.tolist(), home.tolist(), strict=True):
                cells.setdefault(k, []).append((r, h))
        met = [
            (min(a, b), max(a, b))
            for members in cells.values()
            for (a, g), (b, h) in itertools.combinations(members, 2)
            if g or h
        ]
        want = set(near(list(enumerate(x.tolist())), 0.2))
        assert want <= set(met) and len(met) == len(set(met))


def test_hashed_pairs_keep_their_recall(spark, monkeypatch):
    monkeypatch.setattr(similarity, "BLOCK", 5)
    rows = points(300, 12, 2)
    shift = random.Random(4)
    moved = [(1000 + i, [x + shift.gauss(0, 0.05) for x in v]) for i, v in rows]
    df = spark.createDataFrame(rows + moved, "id bigint, v array<double>")
    want = near(rows + moved, 0.25)
    search = similarity.NearPairs(df, "id", "v", 0.25, recall=0.95)
    found = search.pairs().collect()
    got = {(r.id_a, r.id_b): r.distance for r in found}
    assert len(found) == len(got) and all(want[pair] == pytest.approx(d) for pair, d in got.items())
    assert len(got) >= 0.9 * len(want) > 200
    cost = search.candidates().first()
    assert cost.vectors == 600 and cost.candidates < 0.2 * 600 * 599 / 2


def test_plans_follow_the_number_of_vectors():
    """Longer keys instead of more comparisons."""
    import numpy as np

    apart = np.random.default_rng(1).normal(1.4, 0.09, 2000)
    plans = [similarity.plan_hashing(apart, n, 0.35, 0.95, 1)[0] for n in (10**3, 10**5, 10**7)]
    for n, plan in zip((10**3, 10**5, 10**7), plans, strict=True):
        chance = (similarity._agreement(plan.length / apart) ** plan.projections).mean()
        assert n * plan.tables * (1 + 2 * plan.probes) * chance / 2 <= similarity.COMPARED
    assert plans[0].projections <= plans[1].projections <= plans[2].projections


@pytest.mark.parametrize("recall", [None, 0.9])
def test_tables_without_pairs(spark, recall):
    for rows in ([], [(1, [0.5, 0.5])], [(1, [0.5, 0.5])] * 5, [(1, None), (2, None)]):
        df = spark.createDataFrame(rows, "id bigint, v array<double>")
        assert similarity.similar_pairs(df, "id", "v", 0.5, recall).collect() == []
    df = spark.createDataFrame([(1, [0.5]), (2, [0.5, 0.1])], "id bigint, v array<double>")
    with pytest.raises(ValueError, match="one length"):
        similarity.similar_pairs(df, "id", "v", 0.5, recall)


def test_vector_members(spark):
    rows = [(5, [1.0, 0.0]), (3, [1.0, -0.0]), (9, [1.0]), (7, None), (8, [1.0]), (2, [None])]
    df = spark.createDataFrame(rows, "id bigint, v array<double>")
    got = {tuple(r) for r in similarity.vector_members(df, "id", "v").collect()}
    assert got == {(5, 3), (3, 3), (9, 8), (8, 8), (7, 7), (2, 2)}


def test_nearest(spark):
    rows = points(50, 3, 3)
    df = spark.createDataFrame(rows, "id bigint, v array<double>")
    got = [r.id for r in similarity.nearest(df, "id", "v", [0.5, 0.5, 0.5], 5).collect()]
    assert got == [i for i, _ in sorted(rows, key=lambda p: math.dist(p[1], [0.5] * 3))[:5]]


def test_rules_from_frequent_sets(spark):
    baskets = [["a", "b"]] * 12 + [["a"]] * 3 + [["b"]] * 23 + [["c"]]
    rows = [(i, x) for i, items in enumerate(baskets) for x in items]
    df = spark.createDataFrame(rows, "basket bigint, item string")
    found = association_rules(df, "basket", "item", 0.1, 0.8).collect()
    assert [(r.antecedent, r.consequent, r.confidence) for r in found] == [(["a"], ["b"], 0.8)]
    assert found[0].support == pytest.approx(12 / 39)


def test_bucketize(spark):
    df = spark.createDataFrame([(-5.0,), (0.0,), (9.9,), (10.0,), (20.0,), (None,)], "x double")
    splits = [-5.0, 0.0, 10.0, 20.0]
    got = [r[0] for r in df.select(features.bucketize("x", splits)).collect()]
    assert got == [0.0, 1.0, 1.0, 2.0, 2.0, None]
    outside = spark.createDataFrame([(21.0,)], "x double")
    with pytest.raises(Exception):
        outside.select(features.bucketize("x", splits)).collect()
    with pytest.raises(ValueError):
        features.bucketize("x", [0.0, 0.0, 1.0])


def test_vocabulary_order_and_size(spark):
    df = spark.createDataFrame([(1, "a b c"), (2, "a b b c a"), (3, "d")], "id int, text string")
    got = {tuple(r) for r in features.count_vectorize(df, "id", "text", 2, 2).collect()}
    assert got == {(1, 0, "a", 1), (1, 1, "b", 1), (2, 0, "a", 2), (2, 1, "b", 2)}


def test_cosine_transform_inverts(spark):
    df = spark.createDataFrame([(1, [0.0, 1.0, -2.0, 3.0])], "id int, v array<double>")
    there = features.cosine_transform(df, "v", "w")
    back = features.cosine_transform(there, "w", "u", inverse=True).first()
    assert back.u == pytest.approx([0.0, 1.0, -2.0, 3.0])
    assert df.select(features.scale_elements("v", [0, 1, 2, 3])).first()[0] == [0, 1, -4, 9]


def test_curves(spark):
    rows = [(0.9, 1), (0.8, 0), (0.8, 1), (0.4, 1), (0.3, 0)]
    df = spark.createDataFrame(rows, "score double, label int")
    metrics = statistics.threshold_metrics(df, "score", "label")
    got = {r.threshold: (r.tp, r.fp) for r in metrics.collect()}
    assert got == {0.9: (1, 0), 0.8: (2, 1), 0.4: (3, 1), 0.3: (3, 2)}
    areas = statistics.curve_areas(metrics).first()
    pairs = [(p, n) for p, a in rows if a for n, b in rows if not b]
    want = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p, n in pairs) / len(pairs)
    assert areas.roc_area == pytest.approx(want)


def test_spearman_with_ties_and_nulls(spark):
    r = random.Random(6)
    rows = [(float(r.randint(0, 3)), r.random()) for _ in range(300)]
    # a NULL in one column takes no row from the other pairs
    whole = [(*row, None if i % 4 else 1.0 * i) for i, row in enumerate(rows)]
    df = spark.createDataFrame(whole, "a double, b double, c double")
    found = {(x.a, x.b): x.corr for x in statistics.spearman(df, ["a", "b", "c"]).collect()}

    def rank(xs):
        return [sum(y < x for y in xs) + (sum(y == x for y in xs) + 1) / 2 for x in xs]

    a, b = (rank(list(c)) for c in zip(*rows))
    ma, mb = sum(a) / len(a), sum(b) / len(b)
    cov = sum((x - ma) * (y - mb) for x, y in zip(a, b))
    want = cov / math.sqrt(sum((x - ma) ** 2 for x in a) * sum((y - mb) ** 2 for y in b))
    assert found["a", "b"] == pytest.approx(want) and found["a", "c"] is not None


def test_nulls_are_values_of_their_own(spark):
    df = spark.createDataFrame([(None, 1.0), (30.0, 1.0), (3.0, 0.0)], "x double, y double")
    assert [r[0] for r in df.select(features.binarize("x", 25.0)).collect()] == [None, 1.0, 0.0]
    rows = [("p", "u")] * 3 + [("p", None)] + [("q", "u")] + [("q", None)] * 3 + [(None, "u")] * 2
    named = [("p", "u")] * 3 + [("p", "n")] + [("q", "u")] + [("q", "n")] * 3 + [("m", "u")] * 2
    got, want = (
        statistics.chi_square(spark.createDataFrame(r, "label string, x string"), "label", {"x": F.col("x")})
        .first()
        .asDict()
        for r in (rows, named)
    )
    assert got["statistic"] == pytest.approx(want["statistic"]) and got["dof"] == want["dof"] == 2


def test_missing_measures_fail(spark):
    df = spark.createDataFrame([(1.0, None), (0.0, 2.0)] * 20, "label double, x double")
    with pytest.raises(Exception, match="null"):
        models.binary_scores(df, "label", ["x"]).collect()


def test_vocabulary_is_whole(spark):
    df = spark.createDataFrame([(1, "a b c"), (2, "a b d")], "id bigint, text string")
    assert features.count_vectorize(df, "id", "text").count() == 6
    assert features.count_vectorize(df, "id", "text", size=2).count() == 4


def test_chi_square_agrees_with_spark(spark):
    r = random.Random(7)
    rows = [(str(r.randint(0, 2)), float(r.randint(0, 3)), float(r.randint(0, 1))) for _ in range(200)]
    df = spark.createDataFrame(rows, "label string, x double, y double")
    ours = statistics.chi_square(df, "label", {"x": F.col("x"), "y": F.col("y")})
    theirs = models.chi_square_test(df, "label", ["x", "y"])
    got = {r.feature: (r.statistic, r.dof) for r in ours.collect()}
    for r in theirs.collect():
        assert got[r.feature] == (pytest.approx(r.statistic), r.dof)


def test_column_cosine(spark):
    rows = points(60, 4, 8)
    df = spark.createDataFrame(rows, "id bigint, v array<double>").repartition(5)
    columns = list(zip(*[v for _, v in rows]))
    exact = statistics.column_cosine(df, "v")
    for r in exact.collect():
        x, y = columns[r.i], columns[r.j]
        dot = sum(a * b for a, b in zip(x, y))
        assert r.similarity == pytest.approx(dot / math.hypot(*x) / math.hypot(*y))
    guess = statistics.sampled_column_cosine(df, "v", 0.0)
    assert statistics.mean_absolute_error(exact, guess).first().error == pytest.approx(0, abs=1e-9)


def test_sampled_cosine_keeps_its_error(spark):
    """Columns long enough to be sampled; sparse vectors give the same as arrays."""
    from pyspark.ml.functions import array_to_vector

    df = spark.createDataFrame(points(6000, 5, 9), "id bigint, v array<double>").repartition(4, "id")
    exact = statistics.column_cosine(df, "v")
    guess = statistics.sampled_column_cosine(df, "v", 0.5)
    error = statistics.mean_absolute_error(exact, guess).first().error
    assert 0 < error < 0.15
    more = statistics.sampled_column_cosine(df, "v", 0.05)
    assert statistics.mean_absolute_error(exact, more).first().error < error
    vectors = df.select("id", array_to_vector("v").alias("v"))
    same = statistics.sampled_column_cosine(vectors, "v", 0.5)
    known = {(r.i, r.j): r.similarity for r in guess.collect()}
    assert {(r.i, r.j): r.similarity for r in same.collect()} == pytest.approx(known)
    with_zero = spark.createDataFrame([(1, [0.0, 1.0]), (2, [0.0, 2.0])], "id bigint, v array<double>")
    assert statistics.sampled_column_cosine(with_zero, "v", 0.5).count() == 0


def test_models_learn(spark):
    r = random.Random(9)
    rows = [(float(x), r.random(), "p" if x > 0.5 else "q") for x in (r.random() for _ in range(400))]
    df = spark.createDataFrame(rows, "x double, y double, kind string")
    found = models.accuracy(models.tree_classifier(df, "kind", ["x", "y"], []))
    assert found.first().accuracy > 0.9
    scored = df.withColumn("good", (F.col("kind") == "p").cast("int"))
    areas = models.score_areas(models.binary_scores(scored, "good", ["x", "y"]))
    assert areas.first().roc_area > 0.95
