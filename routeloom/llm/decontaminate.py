"""Documents that contain passages of benchmark items.

A set join with containment 1: an item's windows are sets of words, ordered by how rare the words
are in the documents.  A document that contains a window contains its rarest word, so that prefix
of one word per window is all that is joined.  Its place in the window then says where the window
would begin; length and place are checked, and the words are compared one by one.  Only DataFrame
functions are used.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from routeloom.llm.storage import stored

#: After lower-casing A-Z, words are runs of anything but these.
BREAK = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Windows whose rarest words are looked for in one pass over the documents.
BLOCK_WINDOWS = 20_000


def _words(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), BREAK), "")


def _lower(word: Column) -> Column:
    return F.translate(word, UPPER, UPPER.lower())


def item_windows(items: DataFrame, size: int, item_col: str, text_col: str) -> DataFrame:
    """Distinct windows of ``size`` words (or a whole shorter item): ``window``, ``item``."""
    words = F.transform(_words(F.col(f"`{text_col}`")), _lower)
    starts = F.sequence(F.lit(1), F.greatest(F.size("words") - size + 1, F.lit(1)))
    return (
        items.select(F.col(f"`{item_col}`").cast("string").alias("item"), words.alias("words"))
        .where(F.size("words") > 0)
        .select("item", F.explode(F.transform(starts, lambda i: F.slice("words", i, size))))
        .toDF("item", "window")
        .distinct()
    )


def _one_of(word: Column, values: list[str]) -> Column:
    """Like one of ``values`` but for case; the exact comparison follows."""
    return F.lower(word).isin(values)


def _passes(vocabulary: DataFrame, column: str) -> list[list[str]]:
    """The words of a stored table in lists of at most BLOCK_WINDOWS, each for one pass."""
    n = vocabulary.count()
    parts = max(1, -(-n // BLOCK_WINDOWS))
    part = F.pmod(F.xxhash64(column), F.lit(parts))
    for p in range(parts):
        found = vocabulary.where(part == p).select(F.lower(column).alias("w")).distinct().collect()
        yield sorted(r["w"] for r in found)


def rarest_words(windows: DataFrame, texts: DataFrame) -> DataFrame:
    """For each window its word that is rarest in the documents, and the places it has there."""
    vocabulary = stored(windows.select(F.explode("window").alias("word")).distinct(), "vocabulary")
    counts = [
        texts.select(F.explode(F.filter("words", lambda w: _one_of(w, part))).alias("word"))  # noqa: B023
        .groupBy(_lower(F.col("word")).alias("word"))
        .agg(F.count("*").alias("n"))
        for part in _passes(vocabulary, "word")
    ]
    counted = stored(reduce(DataFrame.unionByName, counts), "word_counts")
    placed = windows.select("window", F.posexplode("window").alias("place", "word"))
    ranked = placed.join(counted, "word", "left").select(
        "window",
        F.struct(F.coalesce("n", F.lit(0)).alias("n"), F.col("word").alias("word")).alias("rank"),
    )
    first = ranked.groupBy("window").agg(F.min("rank.n").alias("n"))
    # a word that occurs nowhere in the documents rules its window out
    return (
        ranked.join(first.where("n > 0"), "window")
        .where(F.col("rank.n") == F.col("n"))
        .groupBy("window")
        .agg(F.min("rank.word").alias("word"))
        .select("window", "word", (F.array_position("window", F.col("word")) - 1).cast("int").alias("place"))
    )


def mark_contaminated(
    docs: DataFrame,
    items: DataFrame,
    size: int = 13,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    share: int = 20,
) -> DataFrame:
    """Per row of ``docs``: its id, ``n_words``, ``n_hit``, ``n_items``, ``items``, ``contaminated``.

    A window is ``size`` consecutive words of an item; an item with fewer words, but not none, is
    one window.  Words inside any occurrence of a window are hit.  ``items`` are the ids, as
    sorted strings, of items with occurring windows.  A document is contaminated if words are hit
    and they are at least one in ``share``.

    A null text has no words.  Rows without an id are judged like any others; rows that repeat an
    id and text get the same result.  Items without an id hit words but are not listed; of
    repeated item ids all texts count.  Other columns are left out; ``row_hash``, which is
    ``xxhash64(id, text)``, leads back to them.
    """
    key = F.col(f"`{id_col}`")
    text = F.col(f"`{text_col}`")
    all_windows = stored(item_windows(items, size, item_col, item_text_col), "item_windows")
    windows = stored(all_windows.select("window").distinct(), "windows")
    row = F.xxhash64(key, text).alias("row")  # null ids too; repeated rows share it
    texts = docs.where(text.isNotNull()).select(row, _words(text).alias("words"))
    prefix = stored(rarest_words(windows, texts), "prefixes")
    reach = size - 1
    found = []
    for part in _passes(prefix.select("word").distinct(), "word"):
        places = F.filter(
            F.sequence(F.lit(0), F.size("words") - 1),
            lambda i: _one_of(F.get("words", i), part),  # noqa: B023
        )
        around = F.transform(
            F.when(F.size("words") > 0, places),
            lambda i: F.struct(
                i.alias("at"),
                _lower(F.get("words", i)).alias("word"),
                # the words around the place, for the comparison
                F.greatest(i - reach, F.lit(0)).alias("from"),
                F.transform(
                    F.slice("words", F.greatest(i - reach, F.lit(0)) + 1, F.lit(2 * size - 1)),
                    _lower,
                ).alias("near"),
            ),
        )
        seen = texts.select("row", F.inline(around))
        start = F.col("at") - F.col("place")
        joined = seen.join(prefix, "word").where(start >= F.col("from"))
        equal = F.slice("near", start - F.col("from") + 1, F.size("window")) == F.col("window")
        found.append(
            joined.where(equal).select(
                "row", "window", start.alias("start"), F.size("window").alias("length")
            )
        )
    hits = stored(reduce(DataFrame.unionByName, found), "hits")
    spans = hits.groupBy("row").agg(
        F.sort_array(F.collect_set(F.struct("start", (F.col("start") + F.col("length")).alias("end"))))
        .alias("spans")
    )
    covered = F.aggregate(
        "spans",
        F.struct(F.lit(0).alias("n"), F.lit(0).alias("reach")),
        lambda a, x: F.struct(
            (a["n"] + F.greatest(F.lit(0), x["end"] - F.greatest(a["reach"], x["start"]))).alias("n"),
            F.greatest(a["reach"], x["end"]).alias("reach"),
        ),
        lambda a: a["n"],
    )
    listed = (
        hits.select("row", "window")
        .distinct()
        .join(all_windows, "window")
        .groupBy("row")
        .agg(F.sort_array(F.collect_set("item")).alias("items"))
    )
    hit = spans.select("row", covered.cast("long").alias("n_hit")).join(listed, "row", "left")
    rows = docs.select(key.alias("id"), row, F.size(_words(text)).cast("long").alias("n_words"))
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    none = F.array().cast("array<string>")
    return rows.join(hit, "row", "left").select(
        F.col("id").alias(id_col),
        "n_words",
        n_hit.alias("n_hit"),
        F.size(F.coalesce("items", none)).cast("long").alias("n_items"),
        F.coalesce("items", none).alias("items"),
        ((n_hit > 0) & (share * n_hit >= F.col("n_words"))).alias("contaminated"),
        F.col("row").alias("row_hash"),
    )
