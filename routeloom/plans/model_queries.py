"""Registered queries of similarity search and fitted models."""

from __future__ import annotations

from pyspark.sql import functions as F

from routeloom.operators import model_checks, models, similarity
from routeloom.plans.statistic_queries import chi_square_sql
from routeloom.sources.tables import table

POINT = [round(0.1 * (-1) ** k / (1 + k % 5), 3) for k in range(64)]
NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
NEAR = 1.1
CLOSE = 0.35


def _embeddings(spark, folder):
    return table(spark, folder, "embeddings")


def _line(spark, folder):
    return table(spark, folder, "lineitem")


def _with_coarse_copies(spark, folder):
    """Every embedding, and the same in steps of an eighth."""
    rows = _embeddings(spark, folder)
    vector = F.col("embedding").cast("array<double>")
    coarse = F.transform(vector, lambda x: F.floor(x * 8 + 0.5) / 8)
    return rows.select((F.col("vec_id") * 2).alias("id"), vector.alias("vector")).unionByName(
        rows.select((F.col("vec_id") * 2 + 1).alias("id"), coarse.alias("vector"))
    )


def _rounded(pairs):
    return pairs.withColumn("distance", F.round("distance", 6))


def lsh_join(spark, folder):
    """Pairs of embeddings and coarse copies; one at the threshold is missed once in 1,000 times."""
    rows = _with_coarse_copies(spark, folder)
    return _rounded(similarity.similar_pairs(rows, "id", "vector", CLOSE, recall=0.999))


def near_pairs_exact(spark, folder):
    rows = _embeddings(spark, folder)
    return _rounded(similarity.similar_pairs(rows, "vec_id", "embedding", NEAR, recall=None))


def vector_members(spark, folder):
    """Who stands for whom among the signs of the first six elements."""
    signs = F.transform(F.slice("embedding", 1, 6), lambda x: F.signum(x.cast("double")))
    rows = _embeddings(spark, folder).select("vec_id", signs.alias("signs"))
    return similarity.vector_members(rows, "vec_id", "signs")


def nearest(spark, folder):
    found = similarity.nearest(_embeddings(spark, folder), "vec_id", "embedding", POINT, 10)
    return found.withColumn("distance", F.round("distance", 6))


def _recommender(spark, folder):
    line = _line(spark, folder).select("l_orderkey", "l_partkey", "l_quantity")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    ratings = (
        line.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy(
            F.col("o_custkey").alias("user"),
            F.col("l_partkey").alias("item"),
        )
        .agg(F.sum("l_quantity").alias("rating"))
    )
    return models.Recommender(ratings)


def als_for_some_users(spark, folder):
    buyers = table(spark, folder, "customer").where("c_mktsegment = 'BUILDING'")
    users = buyers.select(F.col("c_custkey").alias("user"))
    return _recommender(spark, folder).for_users(10, users)


def tree_classifier(spark, folder):
    return models.tree_classifier(
        _line(spark, folder), "l_linestatus", NUMBERS, ["l_returnflag"]
    )


def forest_classifier(spark, folder):
    return models.tree_classifier(
        _line(spark, folder), "l_linestatus", NUMBERS, ["l_returnflag"], trees=5
    )


def tree_regressor(spark, folder):
    return models.tree_regressor(
        _line(spark, folder), "l_extendedprice", ["l_quantity", "l_discount", "l_tax"],
        ["l_returnflag"],
    )


def _graded(spark, folder):
    documents = table(spark, folder, "documents").select(
        "doc_id", "text",
        F.log1p("n_chars").alias("log_chars"),
        F.size(F.split("text", r"\s+")).cast("double").alias("words"),
        F.size(F.split("text", "\n")).cast("double").alias("lines"),
        (F.col("lang") == "en").cast("double").alias("english"),
    )
    return documents.join(table(spark, folder, "labels"), "doc_id")


MEASURES = ["log_chars", "words", "lines", "english"]


def classifier_areas(spark, folder):
    rows = _graded(spark, folder)
    settings = {
        "logistic l2": {"kind": "logistic"},
        "logistic l1": {"kind": "logistic", "l1": True},
        "logistic override": {"overrides": {"maxIter": 30, "regParam": 0.1, "tol": 1e-5}},
        "svm": {"kind": "svm"},
    }
    out = None
    for name, setting in settings.items():
        areas = models.score_areas(models.binary_scores(rows, "quality", MEASURES, **setting))
        named = areas.select(F.lit(name).alias("model"), "roc_area", "pr_area")
        out = named if out is None else out.unionByName(named)
    return out


def _survival(spark, folder):
    line = _line(spark, folder)
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderdate")
    trips = (
        line.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        # days between the two, whichever comes first, counting both: positive for all rows
        .withColumn("days", F.abs(F.datediff("l_shipdate", "o_orderdate")) + 1)
        .withColumn("observed", F.col("l_linestatus") == "F")
    )
    return models.Survival(
        trips, "days", "observed", ["l_quantity", "l_discount", "l_tax"], [0.25, 0.5, 0.75]
    )


def survival_rows(spark, folder):
    """For each line item the expected days and their quantiles."""
    found = _survival(spark, folder).predicted("l_orderkey", "l_linenumber", "l_partkey")
    return found.withColumnRenamed("prediction", "days")


def _text_search(spark, folder):
    return models.TextSearch(_graded(spark, folder), "text", "quality")


def text_predictions(spark, folder):
    """The best model's prediction for every document."""
    documents = table(spark, folder, "documents")
    return _text_search(spark, folder).predicted(documents, "doc_id")


def _bins(spark, folder):
    line = _line(spark, folder)
    return line.select(
        "l_returnflag",
        F.floor(F.col("l_quantity") / 16).cast("double").alias("quantity"),
        F.col("l_linenumber").cast("double").alias("line"),
        F.floor(F.col("l_extendedprice") / 10000).cast("double").alias("price"),
        F.round(F.col("l_discount") * 100).alias("discount"),
    )


BINS = ["quantity", "line", "price", "discount"]


def chi_square_test(spark, folder):
    found = models.chi_square_test(_bins(spark, folder), "l_returnflag", BINS)
    return found.withColumns(
        {"statistic": F.round("statistic", 6), "p_value": F.round("p_value", 6)}
    )


def kmeans_check(spark, folder):
    """Faults of clusters that were moved until they no longer change."""
    rows = _embeddings(spark, folder)
    return model_checks.cluster_faults(
        rows, "embedding", models.kmeans(rows, "embedding", 10, rounds=200)
    )


def als_check(spark, folder):
    found = model_checks.factor_faults(_recommender(spark, folder))
    return found.select("unsolved", (F.col("users") > 0).alias("solved_any"))


def _rows_of(found, training, test):
    """Faults, whether all training rows were judged, and the rows of both parts."""
    sizes = training.agg(F.count("*").alias("a")).join(test.agg(F.count("*").alias("b")))
    return found.join(F.broadcast(sizes)).select(
        "faults", (F.col("rows") == F.col("a")).alias("whole"), (F.col("a") + F.col("b")).alias("n")
    )


def tree_regressor_check(spark, folder):
    model, training, test = models.fit_tree_regressor(
        _line(spark, folder), "l_extendedprice", ["l_quantity", "l_discount", "l_tax"],
        ["l_returnflag"],
    )
    return _rows_of(model_checks.regression_leaf_faults(model, training), training, test)


def tree_classifier_check(spark, folder):
    model, training, test = models.fit_tree_classifier(
        _line(spark, folder), "l_linestatus", NUMBERS, ["l_returnflag"]
    )
    found = model_checks.class_leaf_faults(model, training, "l_linestatus_index")
    return _rows_of(found, training, test)


def survival_check(spark, folder):
    return model_checks.survival_faults(_survival(spark, folder))


def text_check(spark, folder):
    search = _text_search(spark, folder)
    return model_checks.text_faults(search, table(spark, folder, "documents"), "doc_id")


QUERIES = {
    "lsh_join": lsh_join,
    "near_pairs_exact": near_pairs_exact,
    "vector_members": vector_members,
    "nearest_vectors": nearest,
    "kmeans": lambda s, d: models.kmeans(_embeddings(s, d), "embedding", 10),
    "kmeans_random_start": lambda s, d: models.kmeans(
        _embeddings(s, d), "embedding", 10, init="random"
    ),
    "bisecting_kmeans": lambda s, d: models.bisecting_kmeans(_embeddings(s, d), "embedding", 10),
    "als_error": lambda s, d: _recommender(s, d).error(),
    "als_top10": lambda s, d: _recommender(s, d).for_users(10),
    "als_top10_items": lambda s, d: _recommender(s, d).for_items(10),
    "als_top10_some_users": als_for_some_users,
    "als_pairs_scored": lambda s, d: _recommender(s, d).search("user", 10).cost(),
    "tree_classifier": tree_classifier,
    "forest_accuracy": lambda s, d: models.accuracy(forest_classifier(s, d)),
    "tree_regressor": tree_regressor,
    "classifier_areas": classifier_areas,
    "survival_regression": lambda s, d: _survival(s, d).terms(),
    "survival_rows": survival_rows,
    "cross_validated_text": lambda s, d: _text_search(s, d).settings(),
    "text_predictions": text_predictions,
    "kmeans_check": kmeans_check,
    "als_check": als_check,
    "tree_regressor_check": tree_regressor_check,
    "tree_classifier_check": tree_classifier_check,
    "survival_check": survival_check,
    "text_check": text_check,
    "chi_square_test": chi_square_test,
    "chi_square_select": lambda s, d: models.chi_square_select(
        _bins(s, d), "l_returnflag", BINS, 2
    ),
}

_BIN_SQL = {
    "quantity": "CAST(CAST(floor(l_quantity / 16) AS BIGINT) AS VARCHAR)",
    "line": "CAST(l_linenumber AS VARCHAR)",
    "price": "CAST(CAST(floor(l_extendedprice / 10000) AS BIGINT) AS VARCHAR)",
    "discount": "CAST(CAST(round(l_discount * 100) AS INTEGER) AS VARCHAR)",
}

_P_VALUES = """
        p_values AS (
            SELECT feature, exp(-any_value(statistic) / 2)
                     * sum(pow(statistic / 2, k) / gamma(k + 1)) AS p
            FROM tested, LATERAL (SELECT unnest(range(CAST(dof / 2 AS BIGINT))) AS k) ks
            GROUP BY feature)"""
_PLACED = ", ".join(
    f"CASE WHEN list_contains(c.names, '{name}') THEN CAST({text} AS DOUBLE) END"
    for name, text in _BIN_SQL.items()
)


def _near_pairs_sql(rows: str, threshold: float) -> str:
    return f"""
        WITH rows AS ({rows}),
        vectors AS (SELECT v, min(id) AS id, count(*) AS copies FROM rows GROUP BY v)
        SELECT a.id AS id_a, b.id AS id_b, round(list_distance(a.v, b.v), 6) AS distance,
               a.copies AS copies_a, b.copies AS copies_b
        FROM vectors a JOIN vectors b ON a.id < b.id AND list_distance(a.v, b.v) < {threshold}"""


SQL = {
    "lsh_join": _near_pairs_sql(
        """
            SELECT vec_id * 2 AS id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
            UNION ALL
            SELECT vec_id * 2 + 1, list_transform(CAST(embedding AS DOUBLE[]),
                                                  lambda x: floor(x * 8 + 0.5) / 8)
            FROM embeddings""",
        CLOSE,
    ),
    "near_pairs_exact": _near_pairs_sql(
        "SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings", NEAR
    ),
    "kmeans_check": """
        SELECT CAST(unnest(range(10)) AS INTEGER) AS cluster, count(*) = 0 AS size_fault,
               count(*) = 0 AS centre_fault, count(*) = 0 AS cost_fault
        FROM embeddings""",
    "als_check": """
        SELECT CAST(0 AS BIGINT) AS unsolved, count(*) > 0 AS solved_any
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "tree_regressor_check": """
        SELECT CAST(0 AS BIGINT) AS faults, true AS whole, count(*) AS n FROM lineitem""",
    "tree_classifier_check": """
        SELECT CAST(0 AS BIGINT) AS faults, true AS whole, count(*) AS n FROM lineitem""",
    "survival_check": """
        SELECT CAST(0 AS BIGINT) AS faults, count(*) AS rows, true AS balanced
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "text_check": """
        SELECT CAST(0 AS BIGINT) AS faults, count(*) AS rows, true AS best FROM documents""",
    "vector_members": """
        SELECT vec_id AS id, min(vec_id) OVER (PARTITION BY list_transform(
                   embedding[1:6], lambda x: sign(CAST(x AS DOUBLE)))) AS representative
        FROM embeddings""",
    "chi_square_select": chi_square_sql(_BIN_SQL)
    + f""", {_P_VALUES},
        best AS (
            SELECT feature, list_position({BINS}, feature) AS place
            FROM p_values ORDER BY p, place LIMIT 2),
        chosen AS (SELECT list(feature ORDER BY place) AS names FROM best)
        SELECT l_returnflag, list_filter([{_PLACED}], lambda x: x IS NOT NULL) AS kept,
               array_to_string(c.names, ',') AS names
        FROM lineitem, chosen c""",
    # With three labels the degrees of freedom are even, which gives the p-value a finite sum.
    "chi_square_test": chi_square_sql(_BIN_SQL)
    + """
        SELECT feature, round(any_value(statistic), 6) AS statistic, any_value(dof) AS dof,
               round(exp(-any_value(statistic) / 2)
                     * sum(pow(statistic / 2, k) / gamma(k + 1)), 6) AS p_value
        FROM tested, LATERAL (SELECT unnest(range(CAST(dof / 2 AS BIGINT))) AS k) ks
        GROUP BY feature""",
    "nearest_vectors": f"""
        SELECT vec_id, round(list_distance(CAST(embedding AS DOUBLE[]), {POINT}::DOUBLE[]), 6)
                   AS distance
        FROM embeddings
        ORDER BY list_distance(CAST(embedding AS DOUBLE[]), {POINT}::DOUBLE[]), vec_id LIMIT 10""",
}
