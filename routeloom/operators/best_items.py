"""The items with the largest inner products, without scoring all.

Items are sorted by length.  The longest give every user a first list, whose last score is a bound
for the next ones, which are collected, too: by the Cauchy-Schwarz inequality only items whose length
times the user's reaches it can be better.  The others are cut into blocks, and a block meets the
users that it may concern in groups.  Users of a group are halved again and again; a set of users
lies in a cone, and only items that reach the bound for some direction in it go on to its halves.
Few users multiply the leading coordinates of the items left, in single precision, and the lengths
of what is left bound the rest; only pairs that still reach the bound are scored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from routeloom.functions.ordering import dense_index
from routeloom.workspace import freeze, freeze_counting

#: The longest items, which every user is scored against.
HEAD = 1024
#: The next ones up to so many times as many, which every task has.
NEXT = 16
#: Least items of a block, and most blocks; beyond them blocks grow.
BLOCK, BLOCKS = 65_536, 4096
#: Users of a group that meets a block.
GROUP = 65_536
#: Users that are halved no more, and items that they meet at a time.
FEW, TILE = 64, 4096
#: Users whose axes are the coordinates.
SAMPLE = 10_000
#: Leading coordinates that are multiplied first.
LEADING = 16
#: Pairs that a task keeps before only the best of them stay.
KEPT = 500_000


def _scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products row by row, always summed in the same order."""
    total = np.zeros(np.broadcast_shapes(a.shape, b.shape)[:-1])
    for i in range(a.shape[-1]):
        total += a[..., i] * b[..., i]
    return total


def _stacked(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.float64)


def _first(rows: np.ndarray, items: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the best ``k`` of each row; of equal scores the smaller items."""
    order = np.lexsort((items, -scores, rows))
    opens = np.r_[True, np.diff(rows[order]) != 0] if len(order) else np.zeros(0, bool)
    start = np.maximum.accumulate(np.where(opens, np.arange(len(order)), 0))
    return order[np.arange(len(order)) - start < k]


def _lengths(rows: np.ndarray) -> np.ndarray:
    return np.sqrt((rows * rows).sum(axis=1))


def _rounding(size: int) -> float:
    """More than a product of ``size`` coordinates in single precision is off, at lengths of 1."""
    return (size + 8) * 2.0**-22


def _over(rows: np.ndarray, size: np.ndarray) -> np.ndarray:
    """``rows`` in units of ``size``; 0 divides nothing."""
    return rows / np.where(size > 0, size, 1.0)


def _leading(rows: np.ndarray, axes: np.ndarray | None) -> np.ndarray:
    """The leading coordinates along ``axes`` and the length of the rest, in single precision."""
    if axes is None:
        return rows.astype(np.float32)
    turned = rows @ axes
    rest = _lengths(turned[:, LEADING:])
    return np.column_stack([turned[:, :LEADING], rest]).astype(np.float32)


def _cone_reaches(units: np.ndarray, items: np.ndarray, lengths: np.ndarray, least: float):
    """Whether an item's product with some direction around ``units`` may be ``least``."""
    axis = units.sum(axis=0)
    size = np.sqrt(axis @ axis)
    if size == 0:
        return lengths * (1 + 1e-7) >= least - 1e-7 * abs(least)
    axis /= size
    cos = np.clip((units @ axis).min(), -1.0, 1.0)
    along = items @ axis
    across = np.sqrt(np.maximum(lengths * lengths - along * along, 0.0))
    most = np.where(along >= lengths * cos, lengths, along * cos + across * np.sqrt(1 - cos * cos))
    return most + 1e-7 * lengths >= least - 1e-7 * abs(least)


def _possible(
    users: np.ndarray, least: np.ndarray, items: np.ndarray, axes: np.ndarray | None
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of all pairs of users and items whose score may be the user's ``least``, and others.

    Each time it gives pairs of at most ``FEW`` users and ``TILE`` items.
    """
    reach, lengths = _lengths(users), _lengths(items)
    longest = lengths.max() if len(lengths) else 0.0
    units = _over(users, reach[:, None])
    first, second = _leading(units, axes), _leading(_over(items, longest), axes)
    off = _rounding(first.shape[1])
    moved = reach > 0
    asked = np.where(moved, _over(least, reach), -np.inf)
    todo = [(rows, np.arange(len(items))) for rows in map(np.flatnonzero, (moved, ~moved))]
    while todo:
        rows, some = todo.pop()
        if not len(rows):
            continue
        bound = asked[rows].min()
        if bound > -np.inf:
            some = some[_cone_reaches(units[rows], items[some], lengths[some], bound)]
        if not len(some):
            continue
        if len(rows) > FEW:  # in two along the coordinate that differs most
            spread = units[rows].var(axis=0).argmax()
            halves = np.argpartition(units[rows, spread], len(rows) // 2)
            todo += [(rows[h], some) for h in np.split(halves, [len(rows) // 2])]
            continue
        for at in range(0, len(some), TILE):
            tile = some[at : at + TILE]
            most = first[rows] @ second[tile].T
            row, item = np.nonzero(most >= (_over(asked[rows], longest) - off)[:, None])
            yield rows[row], tile[item]


def _better(
    users: np.ndarray, least: np.ndarray, items: np.ndarray, ids: np.ndarray, k: int,
    axes: np.ndarray | None,
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Rows, items and scores of each user's ``k`` best that reach ``least``; pairs scored by user."""
    none = np.zeros(0, np.int64)
    found = none, none, np.zeros(0)
    scored, waiting, held, most = np.zeros(len(users), np.int64), [], 0, KEPT

    def best() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        row, item, score = map(np.concatenate, zip(found, *waiting, strict=True))
        first = _first(row, ids[item], score, k)
        return row[first], item[first], score[first]

    for row, item in _possible(users, least, items, axes):
        score = _scores(users[row], items[item])
        np.add.at(scored, row, 1)
        good = score >= least[row]
        waiting.append((row[good], item[good], score[good]))
        held += len(waiting[-1][0])
        if held > most:
            found, waiting, held = best(), [], 0
            most = max(KEPT, len(found[0]))
    row, item, score = best()
    return row, ids[item], score, scored


def _first_list(
    users: np.ndarray, items: np.ndarray, ids: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows, items and scores of each user's ``k`` best of a few items."""
    if len(items) <= k:
        row, item = np.indices((len(users), len(items))).reshape(2, -1)
    else:
        first = _over(users, _lengths(users)[:, None]).astype(np.float32)
        rough = first @ _over(items, _lengths(items).max()).astype(np.float32).T
        last = np.partition(rough, -k, axis=1)[:, -k] - 2 * _rounding(users.shape[1])
        row, item = np.nonzero(rough >= last[:, None])
    score = _scores(users[row], items[item])
    best = _first(row, ids[item], score, k)
    return row[best], ids[item[best]], score[best]


def _least(scores: np.ndarray, users: int, k: int) -> np.ndarray:
    """The last score of full lists of equal length, less rounding; else all are good enough."""
    if len(scores) < users * k:
        return np.full(users, -np.inf)
    last = scores.reshape(users, k)[:, -1]
    # rounding must not cut off an equal score
    return last - 1e-9 * (1 + np.abs(last))


class BestItems:
    """The ``k`` best items of every user, exactly.

    ``users`` and ``items`` are ``(id, features)`` with ids of type int and arrays of one length.
    Of equal scores the smaller item comes first.  An empty table gives no rows.
    """

    def __init__(self, users: DataFrame, items: DataFrame, k: int):
        if k < 1:
            raise ValueError(f"k must be positive, got {k}")
        self.k, self.head_size = k, max(k, HEAD)
        self.near_size = max(self.head_size, NEXT * HEAD)
        self.users = freeze(users.select("id", "features"), "users")
        squares = F.aggregate(
            "features", F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double")
        )
        ranked = dense_index(
            items.select("id", "features", F.sqrt(squares).alias("length")),
            [F.desc("length"), "id"],
            "place",
        )
        self.items, self.n_items = freeze_counting(ranked, "items")
        size = max(BLOCK, -(-self.n_items // BLOCKS))
        number = F.floor((F.col("place") - self.near_size - 1) / size).cast("int")
        self.blocks = self.items.where(F.col("place") > self.near_size).withColumn("block", number)

    @cached_property
    def near(self) -> tuple[np.ndarray, np.ndarray]:
        """Ids and features of the longest items, the longest first."""
        rows = self.items.where(F.col("place") <= self.near_size).orderBy("place").collect()
        return np.array([r["id"] for r in rows], np.int64), np.array(
            [r["features"] for r in rows], np.float64
        )

    @cached_property
    def axes(self) -> np.ndarray | None:
        """Main axes of some users first; any orthonormal axes give the same results.

        None where all coordinates are leading ones.
        """
        if self.near[1].ndim < 2 or self.near[1].shape[1] <= LEADING:
            return None
        some = self.users.orderBy(F.xxhash64("id")).limit(SAMPLE).select("features").collect()
        if not some:
            return None
        sample = np.array([r[0] for r in some], np.float64)
        return np.linalg.svd(sample, full_matrices=True)[2].T

    @cached_property
    def bounds(self) -> DataFrame:
        """Per user the best of the longest items, the bound, and how many blocks may beat it.

        ``scored`` counts the pairs with items after the first list that were scored.
        """
        (ids, near), axes, k, head = self.near, self.axes, self.k, self.head_size
        longest = self.blocks.groupBy("block").agg(F.max("length").alias("length"))
        lengths = np.array([r["length"] for r in longest.orderBy("block").collect()])

        def bound(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                users = _stacked(batch["features"])
                items = near.reshape(len(ids), users.shape[1])
                lists = []
                for at in range(0, len(users), 256):
                    row, *rest = _first_list(users[at : at + 256], items[:head], ids[:head], k)
                    lists.append((row + at, *rest))
                row, item, score = map(np.concatenate, zip(*lists, strict=True))
                least = _least(score, len(users), k)
                row_, item_, score_, scored = _better(
                    users, least, items[head:], ids[head:], k, axes
                )
                row, item = np.r_[row, row_], np.r_[item, item_]
                score = np.r_[score, score_]
                best = _first(row, item, score, k)
                size = len(best) // len(users)
                least = _least(score[best], len(users), k)
                reach = _lengths(users)
                needs = np.searchsorted(-lengths, -_over(least, reach), "right")
                needs = np.where(reach > 0, needs, len(lengths) * (least <= 0))
                yield pd.DataFrame(
                    {
                        "user": batch["id"].to_numpy(),
                        "features": batch["features"].to_numpy(),
                        "least": least,
                        "needs": needs.astype(np.int32),
                        "items": list(item[best].reshape(len(users), size)),
                        "scores": list(score[best].reshape(len(users), size)),
                        "scored": scored,
                    }
                )

        schema = (
            "user int, features array<float>, least double, needs int, "
            "items array<bigint>, scores array<double>, scored bigint"
        )
        return freeze(self.users.mapInPandas(bound, schema), "bounds")

    @cached_property
    def found(self) -> DataFrame:
        """``(user, item, score)`` of items in blocks, and the numbers of pairs ``scored``."""
        needed = self.bounds.where("needs > 0").select(
            F.explode(F.sequence(F.lit(0), F.col("needs") - 1)).alias("block"),
            "user",
            "features",
            "least",
        )
        groups = needed.groupBy("block").agg(F.ceil(F.count("*") / GROUP).cast("int").alias("groups"))
        groups = freeze(groups, "groups")  # at most BLOCKS rows
        left = needed.join(F.broadcast(groups), "block").withColumn(
            "share", F.expr("pmod(xxhash64(user), groups)").cast("int")
        )
        copies = groups.selectExpr("block AS met", "groups AS copies")
        right = self.blocks.join(F.broadcast(copies), F.col("block") == F.col("met")).selectExpr(
            "met", "id", "features", "explode(sequence(0, copies - 1)) AS part"
        )
        axes, k = self.axes, self.k

        def meet(users: pd.DataFrame, items: pd.DataFrame) -> pd.DataFrame:
            if not len(users) or not len(items):
                return pd.DataFrame(columns=["user", "item", "score", "scored"])
            u, v = _stacked(users["features"]), _stacked(items["features"])
            ids, owners = items["id"].to_numpy(np.int64), users["user"].to_numpy(np.int64)
            row, item, score, scored = _better(u, users["least"].to_numpy(), v, ids, k, axes)
            rows = pd.DataFrame({"user": owners[row], "item": item, "score": score})
            count = pd.DataFrame({"scored": [int(scored.sum())]})
            return pd.concat([rows, count], ignore_index=True).astype(
                {"user": "Int64", "item": "Int64", "scored": "Int64"}
            )

        schema = T.StructType(
            [
                T.StructField("user", T.LongType()),
                T.StructField("item", T.LongType()),
                T.StructField("score", T.DoubleType()),
                T.StructField("scored", T.LongType()),
            ]
        )
        pairs = left.groupBy("block", "share").cogroup(right.groupBy("met", "part"))
        return freeze(pairs.applyInPandas(meet, schema), "found")

    def best(self) -> DataFrame:
        """``(user, place, item, score)``, places from 0."""
        first = self.bounds.select("user", F.arrays_zip("items", "scores").alias("pair")).select(
            "user", F.inline("pair").alias("item", "score")
        )
        later = self.found.where("user IS NOT NULL").select("user", "item", "score")
        order = Window.partitionBy("user").orderBy(F.desc("score"), "item")
        ranked = first.unionByName(later).withColumn("place", F.row_number().over(order) - 1)
        return ranked.where(F.col("place") < self.k).select("user", "place", "item", "score")

    def cost(self) -> DataFrame:
        """One row: the pairs ``scored`` in full, those with the longest items included, and all."""
        users = self.bounds.agg(
            F.count("*").alias("users"), F.coalesce(F.sum("scored"), F.lit(0)).alias("near")
        )
        scored = self.found.agg(F.coalesce(F.sum("scored"), F.lit(0)).alias("later"))
        head = min(self.head_size, self.n_items)
        return users.join(F.broadcast(scored)).select(
            (F.col("users") * head + F.col("near") + F.col("later")).alias("scored"),
            (F.col("users") * self.n_items).alias("pairs"),
        )
