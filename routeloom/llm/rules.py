"""Quality rules: plain counts of a text, and its divergence from its language.

A document's histograms of character classes and of common words are compared with those of all
documents of its language by the Jensen-Shannon distance.  Only DataFrame functions are used.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from routeloom.llm.storage import stored

BLANK = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
MARKS = ".,;:!?'\"()-"

#: Frequent words of four languages.  All together are the common words; how
#: frequent each is in a language is counted in the documents.
COMMON_WORDS = sorted(
    set(
        (
            "the of and to in a is that it for on was with as are be this by have from or an not at "
            "de la le et les des en un du une que est pour qui dans par plus pas au sur ne se ce il "
            "der die und den von zu das mit sich auf für ist im dem nicht ein eine als auch es werden "
            "el los del las por para con no su al lo como más pero sus y"
        ).split()
    )
)

#: Limits of the class distance (0 to 1) and of the word distance, as a share of that of a text
#: without common words; the least lengths at which they are judged.
CLASS_LIMIT, WORD_SHARE = 0.25, 0.85
LEAST_CHARS, LEAST_WORDS = 200, 50
#: Common words that a text of its length has to have in its language for words to be judged.
LEAST_COMMON = 10
#: Base rules: fewest words; the greatest share, in percent, of words in repeated windows.
FEWEST_WORDS, MOST_REPEATED = 50, 50
#: Languages up to which their histograms are broadcast.
FEW_LANGUAGES = 1000


def _without(text: Column, characters: str) -> Column:
    return reduce(lambda t, c: F.replace(t, F.lit(c)), characters, text)


def text_counts(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang"
) -> DataFrame:
    """Per row: id, language, base counts and histograms; a null text has no words."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    rows = docs.select(
        F.col(f"`{id_col}`").alias(id_col), F.col(f"`{lang_col}`").alias("lang"), text.alias("text")
    ).select(
        "*",
        F.array_remove(F.split("text", BLANK), "").alias("words"),
        F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
    )
    words, n = F.col("words"), F.size("words")
    window = F.transform(
        F.sequence(F.lit(0), n - 3),
        lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)),
    )
    spelled = [w for word in COMMON_WORDS for w in (word, word.capitalize())]
    plain = _without(F.col("text"), SYMBOLS)
    rows = rows.select(
        id_col,
        "lang",
        F.length("text").alias("n_chars"),
        n.cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        (F.length("text") - F.length(plain)).cast("long").alias("n_symbols"),
        (F.length(plain) - F.length(_without(plain, MARKS))).alias("marks"),
        F.length(F.regexp_replace("text", "[A-Z]+", "")).alias("not_upper"),
        F.length(F.regexp_replace("text", "[0-9]+", "")).alias("not_digit"),
        F.when(n >= 3, window).otherwise(F.array().cast("array<bigint>")).alias("windows"),
        F.sort_array(
            F.transform(F.filter(words, lambda w: w.isin(spelled)), lambda w: F.lower(w))
        ).alias("common"),
    )
    # only texts that repeat a window need its places
    placed = F.when(
        F.size(F.array_distinct("windows")) < F.size("windows"),
        F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
    )
    m = F.size("common")
    ends = F.filter(
        F.sequence(F.lit(0), F.greatest(m - 1, F.lit(0))),
        lambda i: ~F.get("common", i).eqNullSafe(F.get("common", i + 1)),
    )
    rows = rows.select(
        "*",
        placed.alias("placed"),
        F.when(m > 0, ends).otherwise(F.array().cast("array<int>")).alias("ends"),
    )

    def repeated(j: Column) -> Column:
        here = F.get("placed", j)
        like = [F.get("placed", j + d)["h"] == here["h"] for d in (-1, 1)]
        return F.when(F.coalesce(like[0], F.lit(False)) | F.coalesce(like[1], F.lit(False)), here["i"])

    starts = F.sort_array(
        F.array_compact(F.transform(F.sequence(F.lit(0), F.size("placed") - 1), repeated))
    )
    covered = F.aggregate(
        starts,
        F.struct(F.lit(-3).alias("last"), F.lit(0).alias("n")),
        lambda a, p: F.struct(p.alias("last"), (a["n"] + F.least(F.lit(3), p - a["last"])).alias("n")),
        lambda a: a["n"],
    )
    upper, digits = F.col("n_chars") - F.col("not_upper"), F.col("n_chars") - F.col("not_digit")
    space = F.col("n_chars") - F.col("word_chars")
    known = [upper, digits, space, F.col("n_symbols"), F.col("marks")]
    classes = [*known, F.col("n_chars") - reduce(lambda a, b: a + b, known)]
    return rows.select(
        id_col,
        "lang",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        F.when(F.col("placed").isNull(), F.lit(0)).otherwise(covered).cast("long").alias("n_repeat_words"),
        F.array(*[c.cast("long") for c in classes]).alias("classes"),
        F.transform("ends", lambda e: F.get("common", e)).alias("words"),
        F.transform("ends", lambda e, j: e - F.coalesce(F.get("ends", j - 1), F.lit(-1))).alias("times"),
    )


def _term(p: Column, q: Column) -> Column:
    """Both summands of the divergence for one bin; a bin empty on both sides gives 0."""
    half = (p + q) / 2
    return (
        F.when(p > 0, p * F.log2(p / half)).otherwise(F.lit(0.0))
        + F.when(q > 0, q * F.log2(q / half)).otherwise(F.lit(0.0))
    ) / 2


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x)


def quality_rules(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    class_limit: float = CLASS_LIMIT,
    word_share: float = WORD_SHARE,
) -> DataFrame:
    """Base counts, distances from the language, and the verdict, one row for each input row.

    Columns: the id, ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``,
    ``n_repeat_words``, ``class_distance``, ``word_distance``, ``base_failed`` and ``kept``.
    Rows without a language are compared with each other.  A text too short for a distance has
    null there and is not judged by it.  The word distance is judged against the one that a text
    without common words has in that language, where a text of that length would have at least ten
    common words; other languages than those of the fixed list have too few.  A null text has no words and fails the base rules.
    Other columns are left out; repeated rows stay; an empty table gives an empty result.
    """
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    counted = text_counts(docs, id_col=id_col, text_col=text_col, lang_col=lang_col).select(
        F.col(id_col).alias("_id"), "lang", *names, "classes", "words", "times"
    )
    counted = stored(counted, "text_counts")
    by_class = counted.groupBy("lang").agg(
        F.sum("n_words").alias("all_words"),
        F.array(*[F.sum(F.get("classes", F.lit(i))) for i in range(6)]).alias("all_classes"),
    )
    by_word = (
        counted.select("lang", F.explode(F.arrays_zip("words", "times")).alias("x"))
        .groupBy("lang", "x.words")
        .agg(F.sum("x.times").alias("n"))
        .groupBy("lang")
        .agg(F.map_from_entries(F.collect_list(F.struct("words", "n"))).alias("all_times"))
    )
    key = F.coalesce("lang", F.lit("")), F.col("lang").isNull()
    left = by_class.select(key[0].alias("_k"), key[1].alias("_n"), "all_words", "all_classes")
    right = by_word.select(key[0].alias("_k"), key[1].alias("_n"), "all_times")
    language = stored(left.join(right, ["_k", "_n"], "left"), "languages")
    if language.count() <= FEW_LANGUAGES:
        language = F.broadcast(language)
    rows = counted.select("*", key[0].alias("_k"), key[1].alias("_n")).join(language, ["_k", "_n"])
    total = F.aggregate("classes", F.lit(0).cast("long"), lambda a, x: a + x)
    all_total = F.aggregate("all_classes", F.lit(0).cast("long"), lambda a, x: a + x)
    rows = rows.withColumns({"total": total, "all_total": all_total})
    class_divergence = _sum(
        F.zip_with(
            "classes", "all_classes", lambda a, b: _term(a / F.col("total"), b / F.col("all_total"))
        )
    )
    share = F.zip_with(
        "words",
        "times",
        lambda w, n: F.struct(
            (n / F.col("n_words")).alias("p"),
            (F.coalesce(F.try_element_at("all_times", w), F.lit(0)) / F.col("all_words")).alias("q"),
        ),
    )
    common = F.aggregate(
        F.coalesce(F.map_values("all_times"), F.array().cast("array<bigint>")),
        F.lit(0).cast("long"),
        lambda a, x: a + x,
    )
    rows = rows.withColumns({"shares": share, "all_common": common / F.col("all_words")})
    p_common = _sum(F.transform("shares", lambda x: x["p"]))
    q_present = _sum(F.transform("shares", lambda x: x["q"]))
    word_divergence = (
        _sum(F.transform("shares", lambda x: _term(x["p"], x["q"])))
        + (F.col("all_common") - q_present) / 2  # common words that the text lacks
        + _term(1 - p_common, 1 - F.col("all_common"))  # all other words
    )
    distance = lambda d: F.sqrt(F.least(F.lit(1.0), F.greatest(F.lit(0.0), d)))
    all_common = F.col("all_common")
    bare = all_common / 2 + _term(F.lit(1.0), 1 - all_common)  # of a text without common words
    failed = (F.col("n_words") < FEWEST_WORDS) | (
        100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words")
    )
    rows = rows.select(
        F.col("_id").alias(id_col),
        *names,
        F.when(F.col("total") >= LEAST_CHARS, distance(class_divergence)).alias("class_distance"),
        F.when(F.col("n_words") >= LEAST_WORDS, distance(word_divergence)).alias("word_distance"),
        failed.alias("base_failed"),
        F.when(F.col("n_words") * all_common >= LEAST_COMMON, distance(bare)).alias("bare"),
    )
    far = F.coalesce(F.col("class_distance") > class_limit, F.lit(False)) | F.coalesce(
        F.col("word_distance") > word_share * F.col("bare"), F.lit(False)
    )
    return rows.withColumn("kept", ~F.col("base_failed") & ~far).drop("bare")
