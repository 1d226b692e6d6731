"""Audit of filters under every order: what each step removes, and what it costs.

A document fails some of the filters; that set is its mask.  What happens to a document in every
step of every order depends on its mask alone, so each mask has a big integer whose fields hold its
outcomes of all steps.  Per part these integers are summed, as often as documents have the mask,
and the fields of the sum are the counts.  Fields are as wide as the part's row count needs, so no
field runs over into the next.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from routeloom.functions.skew import lookup_join

LETTERS = "ABCDE"
#: Fixed values of the contract.
BLANKS = r"[\x20\x09-\x0D]+"
SIGNS = r"[#$%&*|]"
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS = 200, 50, 3

#: Outcomes of a mask that a sum holds for each step of each order.
KEPT, REMOVED, REDUNDANT = range(3)

OUT = T.StructType(
    [
        T.StructField("part", T.StringType()),
        T.StructField("filter_order", T.StringType()),
        T.StructField("step", T.IntegerType()),
        *[
            T.StructField(name, T.LongType())
            for name in (
                "kept removed redundant unique_fails good_lost toxic_lost shapley".split()
            )
        ],
    ]
)


def orders(letters: str) -> list[str]:
    """All orders of the filters, sorted."""
    return sorted(map("".join, permutations(letters)))


@dataclass(frozen=True)
class Fields:
    """Places of the counts in a packed integer: steps of all orders, then one per filter."""

    letters: str
    width: int  # bytes of a field

    @property
    def steps(self) -> int:
        return len(orders(self.letters)) * len(self.letters)

    @property
    def size(self) -> int:
        return 3 * self.steps + len(self.letters)

    def of_mask(self, mask: int) -> int:
        """The outcomes of one document with this mask, each 0 or 1."""
        raw = bytearray(self.size * self.width)
        step = 0
        for order in orders(self.letters):
            gone = False
            for letter in order:
                fails = bool(mask >> self.letters.index(letter) & 1)
                if not gone:
                    raw[self.width * (3 * step + (REMOVED if fails else KEPT))] = 1
                elif fails:
                    raw[self.width * (3 * step + REDUNDANT)] = 1
                gone = gone or fails
                step += 1
        for i in range(len(self.letters)):
            if mask == 1 << i:
                raw[self.width * (3 * self.steps + i)] = 1
        return int.from_bytes(raw, "little")

    def unpack(self, total: int) -> tuple[np.ndarray, np.ndarray]:
        """Counts ``[step, outcome]`` and the counts of those that fail one filter only."""
        raw = np.frombuffer(total.to_bytes(self.size * self.width, "little"), np.uint8)
        wide = np.zeros((self.size, 8), np.uint8)
        wide[:, : self.width] = raw.reshape(self.size, self.width)
        counts = wide.view("<i8").ravel()
        return counts[: 3 * self.steps].reshape(-1, 3), counts[3 * self.steps :]


def audit_masks(
    masks: list[int],
    good: list[bool],
    toxic: list[bool],
    n: list[int],
    letters: str,
    known: dict[int, list[int]] | None = None,
) -> dict[str, np.ndarray]:
    """Counts of all orders' steps from rows of masks that stand for ``n`` documents each.

    Returns arrays ``[order, step]`` by name.  ``known`` remembers the masks' integers by width.
    """
    known = {} if known is None else known
    width = max(1, (sum(n).bit_length() + 7) // 8)
    fields = Fields(letters, width)
    if width not in known:
        known[width] = [fields.of_mask(mask) for mask in range(1 << len(letters))]
    everyone = bad = lost = 0
    for mask, is_good, is_toxic, times in zip(masks, good, toxic, n, strict=True):
        summand = known[width][mask] * times
        everyone += summand
        bad += summand if is_toxic else 0
        lost += summand if is_good else 0
    steps, unique = fields.unpack(everyone)
    shape = (len(orders(letters)), len(letters))
    index = np.array([[letters.index(x) for x in order] for order in orders(letters)])
    removed = steps[:, REMOVED].reshape(shape)
    shapley = np.array([removed[index == i].sum() for i in range(len(letters))], np.int64)
    return {
        "kept": steps[:, KEPT].reshape(shape),
        "removed": removed,
        "redundant": steps[:, REDUNDANT].reshape(shape),
        "unique_fails": unique[index],
        "good_lost": fields.unpack(lost)[0][:, REMOVED].reshape(shape),
        "toxic_lost": fields.unpack(bad)[0][:, REMOVED].reshape(shape),
        "shapley": shapley[index],
    }


def text_failures(text: Column) -> dict[str, Column]:
    """The conditions A to D on one text."""
    words = F.array_remove(F.split(text, BLANKS), "")
    capitals = F.regexp_count(text, F.lit("[A-Z]"))
    return {
        "A": F.size(words) < LEAST_WORDS,
        "B": 100 * F.size(F.array_distinct(words)) < LEAST_DISTINCT * F.size(words),
        "C": 100 * capitals > MOST_CAPITALS * F.length(text),
        "D": text.rlike(SIGNS),
    }


def failure_masks(
    docs: DataFrame,
    labels: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    part_col: str = "lang",
) -> DataFrame:
    """Documents counted by ``(part, mask, good, toxic)``; bit i of a mask is filter i's failure.

    Only ids and 256-bit hashes of texts are shuffled.  Equal rows are counted before the shuffle,
    and of a text only its smallest id is sought, so a text that a third of all rows have costs no
    more than others.
    """
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    bits = [F.when(fails, 1 << i).otherwise(0) for i, fails in enumerate(text_failures(text).values())]
    rows = (
        docs.select(
            F.col(f"`{id_col}`").alias("id"),
            F.coalesce(F.col(f"`{part_col}`").cast("string"), F.lit("")).alias("part"),
            F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"),
            sum(bits[1:], bits[0]).alias("mask"),
        )
        .groupBy("id", "part", "digest", "mask")
        .agg(F.count("*").alias("n"))
    )
    marks = (
        labels.select(F.col(f"`{id_col}`").alias("id"), "quality", "toxic")
        .groupBy("id")
        .agg(
            F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
            F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"),
        )
    )
    marked = lookup_join(rows, marks, "id", "left").select(
        "id",
        "part",
        "digest",
        "mask",
        "n",
        F.coalesce("good", F.lit(False)).alias("good"),
        F.coalesce("toxic", F.lit(False)).alias("toxic"),
    )
    # per text and kind of row: its smallest id, how many rows have that id, and all rows
    kind = ["digest", "part", "mask", "good", "toxic"]
    least = F.min(F.when(F.col("id").isNotNull(), F.struct("id", "n"))).alias("least")
    free = F.sum(F.when(F.col("id").isNull(), F.col("n")).otherwise(0)).alias("free")
    kinds = marked.groupBy(*kind).agg(least, free, F.sum("n").alias("n"))
    firsts = (
        docs.select(
            F.col(f"`{id_col}`").alias("first"),
            F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"),
        )
        .groupBy("digest")
        .agg(F.min("first").alias("first"))
    )
    joined = lookup_join(kinds, firsts, "digest")
    # rows without an id are nobody's copy; those with the smallest id of the text pass
    passing = F.col("free") + F.when(F.col("least.id") == F.col("first"), F.col("least.n")).otherwise(0)
    copy = 1 << len(bits)
    counted = joined.select(
        "part",
        "good",
        "toxic",
        F.inline(
            F.array(
                F.struct(F.col("mask").alias("mask"), passing.alias("n")),
                F.struct((F.col("mask") + copy).alias("mask"), (F.col("n") - passing).alias("n")),
            )
        ),
    )
    return counted.groupBy("part", "mask", "good", "toxic").agg(F.sum("n").alias("n")).where("n > 0")


def audit_filters(
    docs: DataFrame,
    labels: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    part_col: str = "lang",
) -> DataFrame:
    """What five filters do in each step of each of their 120 orders, per part of the documents.

    The filters fail a text with (A) under 200 words, (B) fewer distinct words than half of all,
    (C) more than 3 % capitals A-Z, (D) any of ``#$%&*|``, (E) a smaller id that has the same
    text, anywhere in the table.  One row per part (value of ``part_col``), ``filter_order`` and
    ``step``: ``kept`` after the step, ``removed`` by it, ``redundant`` (fail it, but went
    earlier), ``unique_fails`` (fail no other filter), ``good_lost`` and ``toxic_lost`` (removed
    with label ``quality`` or ``toxic`` 1) and ``shapley``, what the step's filter removes summed
    over all orders, at whatever step.

    A null text is empty, a null part the empty string.  Rows without an id are no copies, have
    none and no labels.  Repeated rows count each, and do not fail (E) by one another as their ids
    are equal.  A label given several times counts if any row gives it; null labels do not.
    Parts appear as they occur; an empty table gives no rows.
    """
    counts = failure_masks(docs, labels, id_col=id_col, text_col=text_col, part_col=part_col)

    known: dict[int, list[int]] = {}

    def audit(key: tuple, rows: pa.Table) -> pa.Table:
        rows = rows.to_pydict()  # one row per mask and label at most
        found = audit_masks(rows["mask"], rows["good"], rows["toxic"], rows["n"], LETTERS, known)
        n, k = len(orders(LETTERS)), len(LETTERS)
        columns = {
            "part": pa.array([key[0].as_py()] * (n * k), pa.string()),
            "filter_order": pa.array(np.repeat(orders(LETTERS), k).tolist(), pa.string()),
            "step": pa.array(np.tile(np.arange(1, k + 1), n), pa.int32()),
        }
        columns |= {name: pa.array(values.ravel(), pa.int64()) for name, values in found.items()}
        return pa.table(columns)

    return counts.groupBy("part").applyInArrow(audit, OUT)
