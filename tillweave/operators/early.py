"""Users whose nearest all lie at cosine 1: they are read off the users that come first.

Users who share one item with a user, rated with the same sign, have cosine 1 with it, which no cosine exceeds; of equals
the smaller users come first. So where k + 1 such users have rated an item, only users up to the last of these can be among
the nearest k, and of the others of them only those whose cosine is 1 to twelve places. What is said of a user depends on its
class (rated items and signs) but for these exact hits. Classes for which this holds at every item they reach are settled
here: each user meets the early ones (of bounded number, sent with the code), nothing is shuffled. The rest are open.
"""

from __future__ import annotations

from heapq import nsmallest

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillweave.functions.shipping import ship

ship(__name__)

#: Classes, and early users times items, at most (what goes beyond is open), pairs of one step, and how far below 1 a cosine is worked out in full.
MAX_CLASSES, MAX_EARLY, PAIRS, NEAR = 512, 1 << 19, 1 << 22, 1e-9
#: Ratings whose squares and their products neither overflow nor vanish; with others no class is settled.
SMALLEST, LARGEST, ODD = 1e-70, 1e70, 9


def _limits(classes: list[dict], first: list[list], k: int) -> dict:
    """Of each class that can be settled the last user that can be among its nearest k + 1."""
    limits = {}
    for p, mine in enumerate(classes):
        met, one = _met(classes, mine)
        last = [nsmallest(k + 1, (u for q in one if i in classes[q] for u in first[q])) for i in {i for q in met for i in classes[q]}]
        if all(len(x) > k for x in last):
            limits[p] = max(x[k] for x in last)
    return limits


def _met(classes: list[dict], mine: dict) -> tuple[list[int], list[int]]:
    """The classes that share an item with this one; those of them that share just one, with the same sign."""
    common = [mine.keys() & other.keys() for other in classes]
    met = [q for q, x in enumerate(common) if x]
    return met, [q for q in met if len(common[q]) == 1 and all(mine[i] == classes[q][i] != 0 for i in common[q])]


def settle(people: DataFrame, user: str, k: int, n_items: int) -> tuple[DataFrame | None, DataFrame | None]:
    """user, item_no, p, m and s of the users of settled classes, and people of the open ones; None where there are none.

    people has user, items (sorted numbers), values (structs with r and z), m and s; p is the mean of z of the nearest k.
    The open ones come with all others, told apart by the column open, as these can be among their nearest."""
    r = lambda v: v["r"]
    sign = lambda v: F.when(r(v) == 0, 0).when(F.abs(r(v)).between(SMALLEST, LARGEST), F.signum(r(v)).cast("int")).otherwise(ODD)
    signed = people.withColumn("signs", F.transform("values", sign))
    names = [(tuple(c["items"]), tuple(c["signs"])) for c in signed.select("items", "signs").distinct().limit(MAX_CLASSES + 1).collect()]
    all_open = None, people.withColumn("open", F.lit(True))
    if len(names) > MAX_CLASSES or any(ODD in signs for _, signs in names):
        return all_open
    names.sort()
    number, classes, first = {c: p for p, c in enumerate(names)}, [dict(zip(*c, strict=True)) for c in names], [[] for _ in names]
    nth = F.row_number().over(W.partitionBy("items", "signs").orderBy(user))
    for row in signed.select(user, "items", "signs").withColumn("__nth", nth).filter(F.col("__nth") <= k + 1).collect():
        first[number[tuple(row["items"]), tuple(row["signs"])]].append(row[user])
    limits = _limits(classes, first, k)
    steps = sorted(set(limits.values()))
    if not steps:
        return all_open
    upto = dict(zip(steps, people.agg(*(F.count(F.when(F.col(user) <= u, 1)) for u in steps)).first(), strict=True))
    limits = {p: u for p, u in limits.items() if upto[u] * n_items <= MAX_EARLY}
    if not limits:
        return all_open
    early = signed.filter(F.col(user) <= max(limits.values())).select(user, "items", "signs", "values").orderBy(user).toArrow().combine_chunks()
    users, values = early.column(user).combine_chunks(), early.column("values").combine_chunks()
    kind = np.array([number[tuple(i), tuple(s)] for i, s in zip(early.column("items").to_pylist(), early.column("signs").to_pylist(), strict=True)])
    dense_r, dense_z, at = np.zeros((len(kind), n_items)), np.zeros((len(kind), n_items)), (np.repeat(np.arange(len(kind)), [len(names[p][0]) for p in kind]), np.concatenate([names[p][0] for p in kind]))
    dense_r[at], dense_z[at] = pc.struct_field(values.flatten(), "r").to_numpy(zero_copy_only=False), pc.struct_field(values.flatten(), "z").to_numpy(zero_copy_only=False)
    members = {p: np.flatnonzero(kind == p) for p in set(kind.tolist())}
    near, usual = {}, {}
    for p in limits:
        met, one = _met(classes, classes[p])
        reach = sorted({i for q in met for i in classes[q]})
        near[p] = {i: np.sort(np.concatenate([members[q] for q in one if i in classes[q] and q in members]))[: k + 1] for i in reach}
        usual[p] = np.array([sum(dense_z[near[p][i][:k], i].tolist()) / k for i in reach])

    def hits(p, ratings, own):
        """Pairs (row, early user) other than oneself that share two items or more and have cosine 1; the first k of each class."""
        for q, there in members.items():
            common = np.array(sorted(classes[p].keys() & classes[q].keys()))
            if len(common) < 2:
                continue
            a, b = ratings[:, np.searchsorted(names[p][0], common)], dense_r[there][:, common]
            unit = [x / np.where((n := np.linalg.norm(x, axis=1)) > 0, n, 1)[:, None] for x in (a, b)]
            row, col = np.nonzero(unit[0] @ unit[1].T > 1 - NEAR)
            dot, mine, other = (np.zeros(len(row)) for _ in range(3))
            for x in range(len(common)):
                dot += a[row, x] * b[col, x]
                mine += a[row, x] ** 2
                other += b[col, x] ** 2
            norm = np.sqrt(mine * other)
            keep = (np.round(np.divide(dot, norm, out=np.zeros_like(dot), where=norm > 0), 12) >= 1) & (there[col] != own[row])
            row, c = row[keep], there[col[keep]]
            soon = np.arange(len(row)) - np.searchsorted(row, row, "left") < k
            yield row[soon], c[soon], names[q][0]

    def predicted(p, part):
        n, reach = part.num_rows, np.array(list(near[p]))
        ratings = pc.struct_field(part.column("values").flatten(), "r").to_numpy(zero_copy_only=False).reshape(n, -1)
        own = pc.fill_null(pc.index_in(part.column(user), value_set=users), -1).to_numpy(zero_copy_only=False)
        found = [(np.repeat(row, len(items)), np.tile(items, len(row)), np.repeat(c, len(items))) for row, c, items in hits(p, ratings, own)]
        special = np.unique(np.concatenate([np.flatnonzero(own >= 0), *(x[0] for x in found)]))
        found += [(np.repeat(special, len(c)), np.full(len(special) * len(c), i), np.tile(c, len(special))) for i, c in near[p].items()]
        row, item, c = (np.concatenate([x[j] for x in found]).astype(np.int64) for j in range(3))
        other = c != own[row]
        row, item, c = row[other], item[other], c[other]
        order = np.lexsort((c, item, row))
        group = row[order] * n_items + item[order]
        order = order[np.arange(len(group)) - np.searchsorted(group, group, "left") < k]
        out, to = np.tile(usual[p], (n, 1)), row[order] * len(reach) + np.searchsorted(reach, item[order])
        count, total = np.bincount(to, minlength=out.size), np.bincount(to, dense_z[c[order], item[order]], out.size)
        np.divide(total, count, out=out.reshape(-1), where=count > 0)
        who = pa.array(np.repeat(np.arange(n), len(reach)))
        return pa.RecordBatch.from_arrays([part.column(user).take(who), pa.array(np.tile(reach, n), pa.int32()), pa.array(out.reshape(-1)), part.column("m").take(who), part.column("s").take(who)], [user, "item_no", "p", "m", "s"])

    def nearest(batches):
        size = max(1, PAIRS // len(kind))
        for batch in batches:
            of = batch.column("class").to_numpy()
            for p in np.unique(of).tolist():
                rows = np.flatnonzero(of == p)
                for a in range(0, len(rows), size):
                    yield predicted(p, batch.take(pa.array(rows[a : a + size])))

    table = pa.table({
        "items": pa.array([list(i) for i, _ in names], pa.list_(pa.int32())), "signs": pa.array([list(s) for _, s in names], pa.list_(pa.int32())),
        "class": pa.array(range(len(names)), pa.int32()), "open": pa.array([p not in limits for p in range(len(names))]),
    })
    told = signed.join(F.broadcast(people.sparkSession.createDataFrame(table)), ["items", "signs"])
    who = people.schema[user].dataType.simpleString()
    done = told.filter("not open").select(user, "values", "m", "s", "class").mapInArrow(nearest, f"`{user}` {who}, item_no int, p double, m double, s double")
    return done, (told.select(*people.columns, "open") if len(limits) < len(names) else None)
