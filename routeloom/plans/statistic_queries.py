"""Registered queries of the statistics, features and rules."""

from __future__ import annotations

import math

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from routeloom.functions.skew import lookup_join
from routeloom.operators import features, statistics
from routeloom.operators.frequent import frequent_items, quantile_ranks
from routeloom.operators.rules import association_rules
from routeloom.operators.words import words
from routeloom.sources.formats import round_trip
from routeloom.sources.tables import table

MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
SPLITS = [-math.inf, 10.0, 20.0, 30.0, 40.0, math.inf]
PRICE_SPLITS = [0.0, 20000.0, 40000.0, 60000.0, math.inf]
MIN_SUPPORT = 0.01
MIN_CONFIDENCE = 0.15
MIN_DOCS = 2
WEIGHTS = [round(1 / (k + 1), 3) for k in range(64)]
KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def _round(df, *columns, places=6):
    return df.withColumns({c: F.round(c, places) for c in columns})


def _line(spark, folder):
    return table(spark, folder, "lineitem")


def _embeddings(spark, folder):
    return table(spark, folder, "embeddings")


def corr_label(spark, folder):
    line = _line(spark, folder)
    rows = line.select(F.col("l_quantity").alias("label"), *MEASURES[1:])
    return _round(statistics.pearson(rows, ["label", *MEASURES[1:]]).where("a = 'label'"), "corr")


def _traits():
    return {
        "quantity": F.floor(F.col("l_quantity") / 16),
        "line": F.col("l_linenumber"),
        "discount": F.round(F.col("l_discount") * 100).cast("int"),
        "status": F.col("l_linestatus"),
    }


def chi_square(spark, folder):
    found = statistics.chi_square(_line(spark, folder), "l_returnflag", _traits())
    return _round(found, "statistic")


def cosine_error(spark, folder):
    vectors = _embeddings(spark, folder)
    exact = statistics.column_cosine(vectors, "embedding")
    return statistics.mean_absolute_error(
        exact, statistics.sampled_column_cosine(vectors, "embedding", 0.1)
    )


def assoc_rules(spark, folder):
    line = _line(spark, folder).select("l_orderkey", F.col("l_partkey").alias("p_partkey"))
    brands = table(spark, folder, "part").select("p_partkey", "p_brand")
    entries = lookup_join(line, brands, "p_partkey")
    found = association_rules(entries, "l_orderkey", "p_brand", MIN_SUPPORT, MIN_CONFIDENCE)
    return _round(
        found.select(
            F.array_join(F.array_sort("antecedent"), ",").alias("antecedent"),
            F.array_join("consequent", ",").alias("consequent"),
            "confidence",
            "lift",
            "support",
        ),
        "lift",
    )


def _scored(spark, folder):
    documents = table(spark, folder, "documents").select("doc_id", F.col("n_chars").alias("score"))
    labels = table(spark, folder, "labels").select("doc_id", F.col("quality").alias("label"))
    return documents.join(labels, "doc_id")


def roc_points(spark, folder):
    return statistics.threshold_metrics(_scored(spark, folder), "score", "label").drop("pos", "neg")


def curve_areas(spark, folder):
    metrics = statistics.threshold_metrics(_scored(spark, folder), "score", "label")
    return _round(statistics.curve_areas(metrics), "roc_area", "pr_area")


def binarize(spark, folder):
    return _line(spark, folder).select(
        *KEY, "l_quantity", features.binarize("l_quantity", 25.0).alias("large")
    )


def bucketize(spark, folder):
    return _line(spark, folder).select(
        *KEY, "l_quantity", features.bucketize("l_quantity", SPLITS).alias("bucket")
    )


def bucketize_columns(spark, folder):
    return _line(spark, folder).select(
        *KEY,
        features.bucketize("l_quantity", SPLITS).alias("quantity_bucket"),
        features.bucketize("l_extendedprice", PRICE_SPLITS).alias("price_bucket"),
    )


def count_vectorize(spark, folder):
    documents = table(spark, folder, "documents")
    return features.count_vectorize(documents, "doc_id", "text", MIN_DOCS)


def vocabulary_top(spark, folder):
    documents = table(spark, folder, "documents")
    return features.count_vectorize(documents, "doc_id", "text", MIN_DOCS, 3)


def hash_features(spark, folder):
    line = _line(spark, folder).withColumn("finished", F.col("l_linestatus") == "F")
    hashed = features.hash_features(
        line, ["l_quantity", "finished", "l_returnflag", "l_suppkey"], 1 << 10
    )
    return hashed.select(*KEY, F.col("features").cast("string").alias("features"))


def hash_sums(spark, folder):
    """What each hashed row adds up to: its numbers, and 1 for each category."""
    line = _line(spark, folder).withColumn("finished", F.col("l_linestatus") == "F")
    hashed = features.hash_features(
        line, ["l_quantity", "finished", "l_returnflag", "l_suppkey"], 1 << 10
    )
    total = F.aggregate(vector_to_array("features"), F.lit(0.0), lambda a, x: a + x)
    return hashed.select(*KEY, total.alias("total"))


def scale_elements(spark, folder):
    scaled = features.scale_elements("embedding", WEIGHTS)
    return _embeddings(spark, folder).select("vec_id", F.posexplode(scaled).alias("position", "x"))


def cosine_transform(spark, folder):
    transformed = features.cosine_transform(_embeddings(spark, folder), "embedding", "out")
    rows = transformed.select("vec_id", F.posexplode("out").alias("position", "x"))
    return _round(rows, "x")


def vector_summary(spark, folder):
    """Vectors stored, read back and summarised."""
    vectors = _embeddings(spark, folder).select(
        array_to_vector(F.col("embedding").cast("array<double>")).alias("point")
    )
    found = statistics.vector_summary(round_trip(vectors, "parquet"), "point")
    return _round(found, "mean", "deviation")


def frequent_words(spark, folder):
    """Words that are at least one in 2,000 of all words of all documents."""
    texts = table(spark, folder, "documents").select("text")
    return frequent_items(words(texts), ["word"], 0.0005).select(F.col("item").alias("word"), "n")


FREQUENT = ["l_suppkey", "l_linenumber", "l_returnflag"]


def frequent_values(spark, folder):
    return frequent_items(_line(spark, folder), FREQUENT, 0.0101)


QUARTERS = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]


def quantile_check(spark, folder):
    """Whether each quantile's true rank is as near as asked."""
    ranks = quantile_ranks(_line(spark, folder), "l_extendedprice", QUARTERS, 0.001)
    aim = F.col("probability") * F.col("n")
    slack = F.lit(0.001) * F.col("n") + 1
    near = (F.col("below") <= aim + slack) & (F.col("up_to") >= aim - slack)
    return ranks.select("probability", "n", near.alias("near"))


def describe(spark, folder):
    found = statistics.describe(_line(spark, folder), "l_extendedprice")
    return _round(found, "mean", "deviation", places=4)


QUERIES = {
    "corr_pearson": lambda s, d: _round(statistics.pearson(_line(s, d), MEASURES), "corr"),
    "corr_label": corr_label,
    "corr_spearman": lambda s, d: _round(statistics.spearman(_line(s, d), MEASURES), "corr"),
    "chi_square": chi_square,
    "column_cosine": lambda s, d: _round(
        statistics.column_cosine(_embeddings(s, d), "embedding"), "similarity"
    ),
    "column_cosine_error": cosine_error,
    "assoc_rules": assoc_rules,
    "roc_points": roc_points,
    "curve_areas": curve_areas,
    "binarize": binarize,
    "bucketize": bucketize,
    "bucketize_columns": bucketize_columns,
    "count_vectorize": count_vectorize,
    "count_vectorize_top3": vocabulary_top,
    "feature_hash": hash_features,
    "feature_hash_sums": hash_sums,
    "elementwise_product": scale_elements,
    "cosine_transform": cosine_transform,
    "vector_mean": lambda s, d: _round(
        statistics.vector_mean(_embeddings(s, d), "embedding"), "mean"
    ),
    "vector_summary": vector_summary,
    "describe": describe,
    "frequent_words": frequent_words,
    "frequent_values": frequent_values,
    "quantile_check": quantile_check,
}


def _pairs(columns, names=None):
    names = names or columns
    return " UNION ALL ".join(
        f"SELECT '{names[i]}' AS a, '{names[j]}' AS b,"
        f" round(corr({columns[i]}, {columns[j]}), 6) + 0 AS corr FROM ranked"
        for i in range(len(columns))
        for j in range(i + 1, len(columns))
    )


_RANKS = ", ".join(
    f"rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0 AS {c}"
    for c in MEASURES
)

_CURVE = """
WITH scored AS (
    SELECT n_chars AS score, quality AS label FROM documents JOIN labels USING (doc_id)),
steps AS (
    SELECT score AS threshold, count(*) FILTER (label = 1) AS pos,
           count(*) FILTER (label <> 1) AS neg FROM scored GROUP BY score),
sums AS (
    SELECT threshold, pos, neg,
           CAST(sum(pos) OVER (ORDER BY threshold DESC) AS BIGINT) AS tp,
           CAST(sum(neg) OVER (ORDER BY threshold DESC) AS BIGINT) AS fp,
           sum(pos) OVER () AS p, sum(neg) OVER () AS q FROM steps)"""

_TERMS = r"""
WITH counts AS (
    SELECT doc_id, word, count(*) AS n
    FROM (SELECT doc_id, unnest(regexp_split_to_array(text, '[ \t\r\n]')) AS word FROM documents)
    WHERE word <> '' GROUP BY doc_id, word),
terms AS (
    SELECT word, row_number() OVER (ORDER BY sum(n) DESC, word) - 1 AS term
    FROM counts GROUP BY word HAVING count(*) >= {min_docs})
SELECT doc_id, CAST(term AS BIGINT) AS term, word, n FROM counts JOIN terms USING (word)
{top}"""

_KEYS = ", ".join(KEY)


def chi_square_sql(traits):
    """CTEs ending in ``tested(feature, statistic, dof)`` for text expressions of lineitem."""
    return f"""
        WITH cells AS (
            SELECT f.feature, f.value, l_returnflag AS label, count(*) AS n
            FROM lineitem, LATERAL (
                SELECT unnest({list(traits)}) AS feature,
                       unnest([{", ".join(traits.values())}]) AS value) f
            GROUP BY ALL),
        lv AS (SELECT feature, label, sum(n) AS ln FROM cells GROUP BY ALL),
        vv AS (SELECT feature, value, sum(n) AS vn FROM cells GROUP BY ALL),
        every AS (
            SELECT vv.feature, coalesce(c.n, 0) AS n,
                   vv.vn * lv.ln / (SELECT count(*) FROM lineitem) AS e
            FROM vv JOIN lv USING (feature)
            LEFT JOIN cells c ON c.feature = vv.feature AND c.value = vv.value
                             AND c.label = lv.label),
        tested AS (
            SELECT feature, sum((n - e) * (n - e) / e) AS statistic,
                   ((SELECT count(*) FROM vv v WHERE v.feature = every.feature) - 1)
                   * ((SELECT count(*) FROM lv l WHERE l.feature = every.feature) - 1) AS dof
            FROM every GROUP BY feature)
        """


def _bucket_sql(column, splits):
    cases = " ".join(
        f"WHEN {column} < {splits[b + 1]} THEN {float(b)}" for b in range(len(splits) - 2)
    )
    return f"CAST(CASE {cases} ELSE {float(len(splits) - 2)} END AS DOUBLE)"


SQL = {
    "corr_pearson": f"WITH ranked AS (SELECT * FROM lineitem) {_pairs(MEASURES)}",
    "corr_label": f"""
        SELECT * FROM (WITH ranked AS (SELECT l_quantity AS label, * FROM lineitem)
        {_pairs(["label", *MEASURES[1:]])}) WHERE a = 'label'""",
    "corr_spearman": f"WITH ranked AS (SELECT {_RANKS} FROM lineitem) {_pairs(MEASURES)}",
    "chi_square": chi_square_sql(
        {
            "quantity": "CAST(CAST(floor(l_quantity / 16) AS BIGINT) AS VARCHAR)",
            "line": "CAST(l_linenumber AS VARCHAR)",
            "discount": "CAST(CAST(round(l_discount * 100) AS INTEGER) AS VARCHAR)",
            "status": "l_linestatus",
        }
    )
    + "SELECT feature, round(statistic, 6) AS statistic, dof FROM tested",
    "column_cosine": """
        WITH cells AS (
            SELECT vec_id, unnest(range(len(embedding))) AS k,
                   CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings),
        dots AS (
            SELECT a.k AS i, b.k AS j, sum(a.x * b.x) AS dot
            FROM cells a JOIN cells b ON a.vec_id = b.vec_id AND a.k <= b.k GROUP BY a.k, b.k)
        SELECT d.i, d.j, round(d.dot / (sqrt(a.dot) * sqrt(b.dot)), 6) AS similarity
        FROM dots d JOIN dots a ON a.i = d.i AND a.j = d.i JOIN dots b ON b.i = d.j AND b.j = d.j
        WHERE d.i < d.j""",
    "assoc_rules": f"""
        WITH baskets AS (
            SELECT DISTINCT l_orderkey, p_brand FROM lineitem JOIN part ON l_partkey = p_partkey),
        total AS (SELECT count(DISTINCT l_orderkey) AS n FROM baskets),
        single AS (SELECT p_brand, count(*) AS n FROM baskets GROUP BY p_brand),
        pairs AS (
            SELECT a.p_brand AS x, b.p_brand AS y, count(*) AS n
            FROM baskets a JOIN baskets b ON a.l_orderkey = b.l_orderkey AND a.p_brand <> b.p_brand
            GROUP BY ALL HAVING count(*) >= {MIN_SUPPORT} * (SELECT n FROM total)),
        triples AS (
            SELECT a.p_brand AS x, b.p_brand AS y, c.p_brand AS z, count(*) AS n
            FROM baskets a JOIN baskets b ON a.l_orderkey = b.l_orderkey AND a.p_brand < b.p_brand
            JOIN baskets c ON c.l_orderkey = a.l_orderkey
                          AND c.p_brand <> a.p_brand AND c.p_brand <> b.p_brand
            GROUP BY ALL HAVING count(*) >= {MIN_SUPPORT} * (SELECT n FROM total)),
        rules AS (
            SELECT x AS antecedent, y AS consequent, pairs.n, single.n AS base
            FROM pairs JOIN single ON single.p_brand = x
            UNION ALL
            SELECT t.x || ',' || t.y, t.z, t.n, p.n
            FROM triples t JOIN pairs p ON p.x = t.x AND p.y = t.y)
        SELECT antecedent, consequent, rules.n / base AS confidence,
               round((rules.n / base) / (s.n / total.n), 6) AS lift,
               rules.n / total.n AS support
        FROM rules JOIN single s ON s.p_brand = consequent, total
        WHERE rules.n / base >= {MIN_CONFIDENCE}""",
    "roc_points": f"""{_CURVE}
        SELECT threshold, tp, fp, tp / (tp + fp) AS precision, tp / p AS recall, fp / q AS fall_out,
               2e0 * tp / (2e0 * tp + (p - tp) + fp) AS f1,
               1.25e0 * tp / (1.25e0 * tp + 0.25e0 * (p - tp) + fp) AS f_half
        FROM sums""",
    "curve_areas": f"""{_CURVE},
        points AS (
            SELECT threshold, fp / q AS x, tp / p AS y, tp / (tp + fp) AS pr FROM sums),
        moves AS (
            SELECT x, y, pr, lag(x, 1, 0) OVER w AS x0, lag(y, 1, 0) OVER w AS y0,
                   coalesce(lag(pr) OVER w, pr) AS pr0
            FROM points WINDOW w AS (ORDER BY threshold DESC))
        SELECT round(sum((x - x0) * (y + y0) / 2), 6) AS roc_area,
               round(sum((y - y0) * (pr + pr0) / 2), 6) AS pr_area FROM moves""",
    "feature_hash_sums": f"""
        SELECT {_KEYS}, l_quantity + l_suppkey + 2 AS total FROM lineitem""",
    "binarize": f"""
        SELECT {_KEYS}, l_quantity,
               CAST(CASE WHEN l_quantity > 25 THEN 1 ELSE 0 END AS DOUBLE) AS large FROM lineitem""",
    "bucketize": f"""
        SELECT {_KEYS}, l_quantity, {_bucket_sql("l_quantity", SPLITS)} AS bucket FROM lineitem""",
    "bucketize_columns": f"""
        SELECT {_KEYS}, {_bucket_sql("l_quantity", SPLITS)} AS quantity_bucket,
               {_bucket_sql("l_extendedprice", PRICE_SPLITS)} AS price_bucket FROM lineitem""",
    "count_vectorize": _TERMS.format(min_docs=MIN_DOCS, top=""),
    "count_vectorize_top3": _TERMS.format(min_docs=MIN_DOCS, top="WHERE term < 3"),
    "elementwise_product": f"""
        SELECT vec_id, position, CAST(x AS DOUBLE) * w AS x
        FROM (SELECT vec_id, CAST(unnest(range(len(embedding))) AS INTEGER) AS position,
                     unnest(embedding) AS x,
                     unnest({WEIGHTS}::DOUBLE[]) AS w FROM embeddings)""",
    "cosine_transform": """
        WITH cells AS (
            SELECT vec_id, unnest(range(len(embedding))) AS i, len(embedding) AS size,
                   CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings)
        SELECT vec_id, CAST(k AS INTEGER) AS position,
               round(sqrt((CASE WHEN k = 0 THEN 1 ELSE 2 END) / any_value(size))
                     * sum(x * cos(pi() / size * (i + 0.5) * k)), 6) + 0 AS x
        FROM cells, LATERAL (SELECT unnest(range(size)) AS k) ks GROUP BY vec_id, k""",
    "vector_mean": """
        SELECT position, round(sum(x) / count(*), 6) + 0 AS mean
        FROM (SELECT CAST(unnest(range(len(embedding))) AS INTEGER) AS position,
                     CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings)
        GROUP BY position""",
    "vector_summary": """
        SELECT position, round(avg(x), 6) + 0 AS mean, round(stddev_samp(x), 6) AS deviation,
               min(x) AS least, max(x) AS most
        FROM (SELECT CAST(unnest(range(len(embedding))) AS INTEGER) AS position,
                     CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings)
        GROUP BY position""",
    "frequent_words": r"""
        WITH words AS (
            SELECT word FROM (
                SELECT unnest(string_split_regex(text, '[ \t\r\n]')) AS word FROM documents)
            WHERE word <> '')
        SELECT word, count(*) AS n FROM words
        GROUP BY word HAVING count(*) >= 0.0005 * (SELECT count(*) FROM words)""",
    "frequent_values": " UNION ALL ".join(
        f"""
        SELECT '{c}' AS "column", CAST({c} AS VARCHAR) AS item, count(*) AS n FROM lineitem
        WHERE {c} IS NOT NULL GROUP BY {c}
        HAVING count(*) >= 0.0101 * (SELECT count({c}) FROM lineitem)"""
        for c in FREQUENT
    ),
    "quantile_check": f"""
        SELECT CAST(unnest({QUARTERS}) AS DOUBLE) AS probability, n, true AS near
        FROM (SELECT count(*) AS n FROM lineitem)""",
    "describe": """
        SELECT count(l_extendedprice) AS n, round(avg(l_extendedprice), 4) AS mean,
               round(stddev_samp(l_extendedprice), 4) AS deviation,
               min(l_extendedprice) AS least, max(l_extendedprice) AS most FROM lineitem""",
}
