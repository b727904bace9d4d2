"""Which users can be among the nearest of which: cells of alike directions with cosine bounds.

Users with the same pattern of rated items are dealt into cells by the direction of their ratings, coarse
grid first, then finer. A cell's box of unit vectors, and the cone around the box, bound the cosine to another
cell's, over the items that both patterns hold. For each cell and item the cells that are surely nearest give a floor of the k-th best cosine;
cells whose bound is below it are never met. Where two patterns share one item, all cosines are 1, 0 or -1, so
of equal signs only the k + 1 smallest users can enter, and these are sent instead of cells.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillweave.functions.shipping import ship
from tillweave.sources.scratch import stored

ship(__name__)

#: Ranges of directions at most; cells, patterns and entries that bounds are worked out for (beyond, all blocks meet), and a margin for rounding.
MAX_RANGES, MAX_CELLS, MAX_PATTERNS, MAX_ENTRIES, MARGIN = 4096, 20_000, 512, 1 << 22, 1e-7
#: Steps of a coordinate, coarse to fine.
GRIDS = (4, 8, 16, 32, 64, 128, 256)
#: Common items of two patterns up to which cells have cones beside their boxes.
MOST_CORNERS = 10


class Boxes:
    """Cells as dense arrays over items: the smallest and largest unit coordinates, and how many users."""

    def __init__(self, cells: list, items: int):
        self.has, self.lo, self.hi = np.zeros((len(cells), items), bool), np.zeros((len(cells), items)), np.zeros((len(cells), items))
        self.n = np.array([c["n"] for c in cells], np.int64)
        for i, c in enumerate(cells):
            at = list(c["items"])
            self.has[i, at], self.lo[i, at], self.hi[i, at] = True, c["lo"], c["hi"]
        self.group, self.cones = {}, {}
        for i, row in enumerate(self.has):
            self.group.setdefault(row.tobytes(), []).append(i)
        self.near = np.where(self.lo > 0, self.lo, np.where(self.hi < 0, -self.hi, 0.0))
        self.far = np.maximum(np.abs(self.lo), np.abs(self.hi))

    def cone(self, key: bytes, common: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Middle directions over the common items of a pattern's cells, and the angles that hold their boxes: those of the corners."""
        name = key, common.tobytes()
        if name not in self.cones:
            rows, at = self.group[key], np.flatnonzero(common)
            lo, hi = self.lo[rows][:, at], self.hi[rows][:, at]
            side = (np.arange(1 << len(at))[:, None] >> np.arange(len(at))) & 1
            corner = np.where(side[None], hi[:, None], lo[:, None])
            middle, length = (lo + hi) / 2, np.linalg.norm(corner, axis=2)
            size = np.linalg.norm(middle, axis=1)
            fine = (length.min(axis=1) > 0) & (size > 0)
            middle = middle / np.where(size > 0, size, 1)[:, None]
            least = np.where(fine, (np.einsum("ncd,nd->nc", corner, middle) / np.where(length > 0, length, 1)).min(axis=1), -1)
            self.cones[name] = middle, np.where(least > 0, np.arccos(np.clip(least, -1, 1)), np.pi)
        return self.cones[name]

    def angles(self, a: int) -> tuple[np.ndarray, np.ndarray]:
        """Bounds of the angle to every cell, by cones; 0 to pi where there is none."""
        low, high, mine = np.zeros(len(self.n)), np.full(len(self.n), np.pi), self.has[a].tobytes()
        for key, rows in self.group.items():
            common = self.has[rows[0]] & self.has[a]
            if not 2 <= common.sum() <= MOST_CORNERS:
                continue
            own, radius = self.cone(mine, common)
            i = self.group[mine].index(a)
            other, radii = self.cone(key, common)
            between = np.arccos(np.clip(other @ own[i], -1, 1))
            low[rows] = np.maximum(0, between - radii - radius[i])
            high[rows] = np.minimum(np.pi, between + radii + radius[i])
        return low, high

    def bounds(self, a: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of every cell with cell a: common items, and the least and largest cosine over them."""
        both = self.has & self.has[a]
        corners = np.stack([x * y for x in (self.lo[a], self.hi[a]) for y in (self.lo, self.hi)])
        low, high = (corners.min(axis=0) * both).sum(axis=1), (corners.max(axis=0) * both).sum(axis=1)
        near = np.sqrt((self.near[a] ** 2 * both).sum(axis=1) * (self.near**2 * both).sum(axis=1))
        far = np.sqrt((self.far[a] ** 2 * both).sum(axis=1) * (self.far**2 * both).sum(axis=1))
        sure = near > 0  # else a vector may be zero over the common items
        near, far = np.where(sure, near, 1), np.where(sure, far, 1)
        least = np.where(sure, np.maximum(np.where(low >= 0, low / far, low / near), -1), -1.0)
        most = np.where(sure, np.minimum(np.where(high >= 0, high / near, high / far), 1), 1.0)
        nearest, farthest = self.angles(a)
        return both.sum(axis=1), np.maximum(least, np.cos(farthest)), np.minimum(most, np.cos(nearest))

    def met(self, a: int, k: int) -> np.ndarray:
        """The cells that share two items or more with cell a and may hold one of the k nearest of its users for some item."""
        common, least, most = self.bounds(a)
        keep = np.zeros(len(self.n), bool)
        for i in range(self.has.shape[1]):
            at = np.flatnonzero((common >= 2) & self.has[:, i])
            order = at[np.argsort(-least[at], kind="stable")]
            enough = int(np.searchsorted(np.cumsum(self.n[order]), k + 1))  # one more, as a user does not meet itself
            floor = least[order[enough]] if enough < len(order) else -np.inf
            keep[at[most[at] >= floor - MARGIN]] = True
        return np.flatnonzero(keep)


def _every_block(vectors: DataFrame, leads: DataFrame, user: str, blocks: int) -> DataFrame:
    mine = F.pmod(F.xxhash64(user), F.lit(blocks)).cast("long")
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long")))
    return leads.withColumns({"block": mine, "lead": F.lit(1)}).unionByName(vectors.withColumns({"block": every, "lead": F.lit(0)}))


def meetings(vectors: DataFrame, user: str, k: int, size: int, n_items: int) -> DataFrame:
    """The vectors with block and lead: each user leads in its own block (lead 1) and meets in all blocks it may matter to.

    vectors has user, items (sorted numbers) and values (structs with r); size is the number of users of a cell, about.
    With a column peers a row stands for these users (the smallest first, which is user), all with its ratings. With a
    column open only the open ones lead, the others only meet them."""
    spark, users, held_columns = vectors.sparkSession, vectors.count(), [c for c in vectors.columns if c != "open"]
    vectors = vectors if "open" in vectors.columns else vectors.withColumn("open", F.lit(True))
    stands = F.size("peers") if "peers" in held_columns else F.lit(1)
    unit = F.transform("values", lambda v: v["r"] / F.col("__norm"))
    norm = F.sqrt(F.aggregate("values", F.lit(0.0), lambda a, v: a + v["r"] * v["r"]))
    on_grid = lambda steps: F.transform("unit", lambda x: F.floor(x * steps))
    grids = F.concat(*map(on_grid, GRIDS))
    placed = vectors.withColumn("__norm", F.when(norm > 0, norm).otherwise(1.0)).withColumn("unit", unit).withColumn("grid", grids)
    ranges = max(1, min(MAX_RANGES, -(-users // size)))
    dealt = stored(placed.repartitionByRange(ranges, "items", "grid", user).select(*held_columns, "open", "unit", "grid", F.spark_partition_id().alias("range"), stands.alias("__stands")))
    most, level = min(MAX_CELLS, MAX_ENTRIES // max(1, n_items)), sum(g * g <= ranges for g in GRIDS)  # a cell lies in one box of this grid
    boxed = lambda: dealt.withColumn("box", F.slice("grid", F.lit(1), F.size("items") * level))
    while level and boxed().select("range", "items", "box").distinct().count() > most:  # too many boxes: a coarser grid
        level -= 1
    placed = boxed().drop("grid")
    sides = placed.select("range", "items", "box", "open", "__stands", F.posexplode("unit").alias("at", "x")).groupBy("range", "items", "box", "at").agg(F.min("x").alias("lo"), F.max("x").alias("hi"), F.sum("__stands").alias("n"), F.max("open").alias("open"))
    boxes = sides.groupBy("range", "items", "box").agg(F.sort_array(F.collect_list(F.struct("at", "lo", "hi"))).alias("s"), F.max("n").alias("n"), F.max("open").alias("open"))
    cells = boxes.select("range", "items", "box", F.transform("s", lambda x: x["lo"]).alias("lo"), F.transform("s", lambda x: x["hi"]).alias("hi"), "n", "open").limit(most + 1).collect()
    patterns = {p: i for i, p in enumerate(sorted({tuple(c["items"]) for c in cells}))}
    if len(cells) > most or len(patterns) > MAX_PATTERNS:
        return _every_block(vectors.drop("open"), vectors.filter("open").drop("open"), user, ranges)
    cells.sort(key=lambda c: (c["range"], c["items"], c["box"]))
    held = Boxes(cells, n_items)

    def pairs(batches):
        for batch in batches:
            for a in batch.column("id").to_pylist():
                at = held.met(a, k)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), a), pa.int64()), pa.array(at, pa.int64())], ["block", "cell"])

    table = pa.table({
        "range": pa.array([c["range"] for c in cells], pa.int32()), "items": pa.array([list(c["items"]) for c in cells], pa.list_(pa.int32())),
        "box": pa.array([list(c["box"]) for c in cells], pa.list_(pa.int64())), "cell": pa.array(range(len(cells)), pa.int64()), "pattern": pa.array([patterns[tuple(c["items"])] for c in cells], pa.int32()),
        "asks": pa.array([c["open"] for c in cells], pa.bool_()),
    })
    numbers = spark.createDataFrame(table)  # at most MAX_CELLS rows, as the other two local tables are bounded
    rows = placed.join(F.broadcast(numbers), ["range", "items", "box"]).select(*held_columns, "open", "cell", "pattern")
    leading = numbers.filter("asks")
    near = stored(leading.select(F.col("cell").alias("id")).repartition(max(1, len(cells) // 64)).mapInArrow(pairs, "block long, cell long"))
    asks = rows.filter("open").select(*held_columns, F.col("cell").alias("block"), F.lit(1).alias("lead"))
    meets = rows.join(near, "cell").select(*held_columns, "block", F.lit(0).alias("lead"))
    out = asks.unionByName(meets)
    single = [(p, q, (set(a) & set(b)).pop()) for a, p in patterns.items() for b, q in patterns.items() if len(set(a) & set(b)) == 1]
    if single:
        told = spark.createDataFrame(pa.table({n: pa.array([s[i] for s in single], pa.int32()) for i, n in enumerate(("__mine", "pattern", "item"))}))
        tall = rows.select(user, "pattern", F.explode(F.arrays_zip("items", "values")).alias("s")).select(user, "pattern", F.col("s.items").alias("item"), F.signum(F.col("s.values.r")).alias("sign"))
        first = tall.withColumn("__row", F.row_number().over(W.partitionBy("pattern", "item", "sign").orderBy(user))).filter(F.col("__row") <= k + 1)
        sent = first.select(user, "pattern", "item").join(F.broadcast(told), ["pattern", "item"]).join(F.broadcast(leading.select(F.col("cell").alias("block"), F.col("pattern").alias("__mine"))), "__mine")
        out = out.unionByName(rows.join(sent.select(user, "block"), user).select(*held_columns, "block", F.lit(0).alias("lead")))
    return out
