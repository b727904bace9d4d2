"""Rating models and their evaluation: scaling, biases, neighbours, ranking. Factorisation is in factors."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DoubleType, IntegerType, StructField, StructType

from tillweave.functions.hashing import uniform
from tillweave.operators import cones, early
from tillweave.sources.scratch import stored


def lognorm_bounds(df: DataFrame, column: str, keys: Sequence[str] = (), low: float | None = None, high: float | None = None, tol: float = 0.1) -> DataFrame:
    """One (lo, hi) pair per group, widened by tol and limits, used for both directions of the scaling."""
    lo, hi = F.min(column) * (1 - tol), F.max(column) * (1 + tol)
    lo = F.least(lo, F.lit(float(low))) if low is not None else lo
    hi = F.greatest(hi, F.lit(float(high))) if high is not None else hi
    return df.groupBy(*keys).agg(lo.cast("double").alias("lo"), hi.cast("double").alias("hi"))


def lognorm(x: Column, floor: float = 1e-6) -> Column:
    """ln of the place of x between lo and hi, the place held at floor or more."""
    return F.ln(F.greatest((x - F.col("lo")) / (F.col("hi") - F.col("lo")), F.lit(floor)))


def lognorm_inverse(y: Column) -> Column:
    return F.exp(y) * (F.col("hi") - F.col("lo")) + F.col("lo")


def bias_baseline(ratings: DataFrame, user: str, item: str, rating: str) -> DataFrame:
    """user, item, prediction of every user with every rated item: mean plus both offsets."""
    total = ratings.agg((F.sum(rating).cast("double") / F.count("*")).alias("mu"))
    offset = lambda key, name: ratings.groupBy(key).agg((F.sum(rating).cast("double") / F.count("*")).alias(name))
    pairs = offset(user, "mean_u").crossJoin(F.broadcast(offset(item, "mean_i"))).crossJoin(F.broadcast(total))
    return pairs.select(user, item, (F.col("mu") + (F.col("mean_u") - F.col("mu")) + (F.col("mean_i") - F.col("mu"))).alias("prediction"))


def _items(ratings: DataFrame, item: str) -> DataFrame:
    """Items are few; they are numbered in name order."""
    return ratings.select(item).distinct().withColumn("item_no", (F.row_number().over(W.orderBy(item)) - 1).cast("int"))


def knn(ratings: DataFrame, user: str, item: str, rating: str, k: int = 20, kind: str = "basic", hot: int = 512) -> DataFrame:
    """user, item, prediction from the k most alike users who rated the item.

    kind: 'basic', 'means' or 'zscore'. Alike is the cosine over all items that both rated, to twelve places;
    of equals the smaller users come first. Users whose nearest all lie at cosine 1 are settled first (early.settle). For the
    others users with the same ratings are one vector, which its k + 1 smallest users stand for, as no other of them can be
    among anyone's nearest. Vectors lie in cells of about `hot`; each cell reads the vectors of all users that can be among
    the nearest of its own (cones.meetings), once, and holds the best k + 1 so far: hot x items x (k + 1) neighbours. A
    user's own place among them is left out at the end.
    Null ratings are left out; where all weights are 0 the prediction is null."""
    known = stored(ratings.select(user, item, F.col(rating).cast("double").alias("r")).dropna())
    shift = F.lit(0.0) if kind == "basic" else F.col("m")
    scale = F.when(F.col("s") > 0, F.col("s")).otherwise(1.0) if kind == "zscore" else F.lit(1.0)
    names = _items(known, item)
    n_items = names.count()
    listed = known.join(F.broadcast(names), item).groupBy(user).agg(F.sort_array(F.collect_list(F.struct("item_no", "r"))).alias("rows"), F.avg("r").alias("m"), F.coalesce(F.stddev_pop("r"), F.lit(0.0)).alias("s"))
    people = stored(listed.select(user, F.transform("rows", lambda v: v["item_no"]).alias("items"), F.transform("rows", lambda v: F.struct(v["r"].alias("r"), ((v["r"] - shift) / scale).alias("z"))).alias("values"), "m", "s"))
    done, others = early.settle(people, user, k, n_items)
    cells = None if others is None else _by_cells(others, user, k, hot, n_items)
    return reduce(DataFrame.unionByName, (x for x in (done, cells) if x is not None)).join(F.broadcast(names), "item_no").select(user, item, (F.col("p") * scale + shift).alias("prediction"))


def _by_cells(people: DataFrame, user: str, k: int, hot: int, n_items: int) -> DataFrame:
    """user, item_no, p, m and s of the open users, whose nearest are sought in cells among all users."""
    alike = W.partitionBy("items", "__r").orderBy(user)
    people = people.withColumn("__r", F.transform("values", lambda v: v["r"]))
    people = stored(people.withColumns({"__first": F.first(user).over(alike), "__nth": F.row_number().over(alike)}))
    peers = people.filter(F.col("__nth") <= k + 1).groupBy("__first").agg(F.sort_array(F.collect_list(user)).alias("peers"))
    vectors = stored(people.filter("__nth = 1").select(user, "items", "values", "open").join(peers.withColumnRenamed("__first", user), user))
    rows = cones.meetings(vectors, user, k, hot, n_items).repartition("block").sortWithinPartitions("block", F.desc("lead"), user)

    def best(batches):
        def as_array(column):
            return column.to_numpy(zero_copy_only=False)

        def dense(part):
            items, values = part.column("items"), part.column("values")
            at = np.repeat(np.arange(part.num_rows), pc.list_value_length(items).to_numpy(zero_copy_only=False)), items.flatten().to_numpy()
            r, z, has = np.zeros((part.num_rows, n_items)), np.zeros((part.num_rows, n_items)), np.zeros((part.num_rows, n_items), bool)
            r[at], z[at], has[at] = pc.struct_field(values.flatten(), "r").to_numpy(), pc.struct_field(values.flatten(), "z").to_numpy(), True
            return r, z, has

        def meet(state, part):
            r, z, has = dense(part)
            q, q_has, held = state["r"], state["has"], state["held"]
            first, peers = as_array(part.column(user)), part.column("peers")
            many, flat = pc.list_value_length(peers).to_numpy(zero_copy_only=False), as_array(peers.flatten())
            begin = np.cumsum(many) - many
            dot, one, two, both = np.zeros((len(q), len(r))), np.zeros((len(q), len(r))), np.zeros((len(q), len(r))), np.zeros((len(q), len(r)), bool)
            for i in range(n_items):  # in one order, so that sums do not depend on the batches
                dot += np.outer(q[:, i], r[:, i])
                one += np.outer(q[:, i] ** 2, has[:, i])
                two += np.outer(q_has[:, i], r[:, i] ** 2)
                both |= np.outer(q_has[:, i], has[:, i])
            norm = np.sqrt(one * two)
            sim = np.where(both, np.round(np.divide(dot, norm, out=np.zeros_like(dot), where=norm > 0), 12), -np.inf)
            for i in range(n_items):
                at = np.flatnonzero(has[:, i])
                old = held[i]
                row, col = np.nonzero((sim[:, at] >= old["least"][:, None]) & both[:, at])
                col = at[col]
                tie = np.flatnonzero(sim[row, col] == old["least"][row])
                late = tie[first[col[tie]] >= old["last"][row[tie]]]  # of equals the smaller users come first
                row, col = np.delete(row, late), np.delete(col, late)
                if not len(row):
                    continue
                pair = np.repeat(np.arange(len(row)), many[col])
                peer = flat[begin[col][pair] + np.arange(len(pair)) - np.repeat(np.cumsum(many[col]) - many[col], many[col])]
                row, col = row[pair], col[pair]
                new = {"row": row, "sim": sim[row, col], "z": z[col, i], "user": peer, "own": first[col] == state["users"][row]}
                new = {n: np.concatenate((old[n], x)) if len(old["row"]) else x for n, x in new.items()}
                by_user = new["user"] if new["user"].dtype != object else np.unique(new["user"], return_inverse=True)[1]
                order = np.lexsort((by_user, -new["sim"], new["row"]))
                rows_ = new["row"][order]
                rank = np.arange(len(rows_)) - np.searchsorted(rows_, rows_, "left")
                full, order = order[rank == k], order[rank <= k]
                old["least"][new["row"][full]], old["last"][new["row"][full]] = new["sim"][full], new["user"][full]
                held[i] = {n: x[order] for n, x in new.items()} | {"least": old["least"], "last": old["last"]}

        def weighted(h, entry, owner, n):
            """Per owner the mean of z of these entries, weighed by likeness; null where the weights are 0."""
            weight, total = np.bincount(owner, h["sim"][entry], n), np.bincount(owner, h["sim"][entry] * h["z"][entry], n)
            return pa.array(np.divide(total, weight, out=np.zeros(n), where=weight != 0), mask=weight == 0)

        def done(state):
            """Per vector and item the prediction of who is not among the nearest k + 1 himself, and of each who is, from the others."""
            for i, h in enumerate(state["held"] or ()):
                row, start, n = np.unique(h["row"], return_index=True, return_counts=True)
                if not len(row):
                    continue
                group = np.repeat(np.arange(len(row)), n)
                near = np.flatnonzero(np.arange(len(group)) - start[group] < k)
                own = np.flatnonzero(h["own"])
                rest = np.repeat(np.arange(len(own)), n[group[own]])
                entry = np.arange(len(rest)) - np.repeat(np.cumsum(n[group[own]]) - n[group[own]], n[group[own]]) + start[group[own]][rest]
                other = entry != own[rest]
                cuts = pa.array(np.r_[0, np.cumsum(np.bincount(group[own], minlength=len(row)))].astype(np.int32))
                lists = [pa.ListArray.from_arrays(cuts, x) for x in (pa.array(h["user"][own], state["type"]), weighted(h, entry[other], rest[other], len(own)), pa.array(n[group[own]] > 1))]
                yield pa.RecordBatch.from_arrays([pa.array(state["users"][row], state["type"]), pa.array(np.full(len(row), i), pa.int32()), weighted(h, near, group[near], len(row)), *lists], ["__first", "item_no", "p", "own", "own_p", "own_known"])

        state = None
        for batch in batches:
            if not batch.num_rows:
                continue
            block, lead = batch.column("block").to_numpy(), batch.column("lead").to_numpy()
            cuts = np.flatnonzero((block[1:] != block[:-1]) | (lead[1:] != lead[:-1])) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(block)], strict=True):
                if state is None or state["block"] != block[a]:
                    if state:
                        yield from done(state)
                    state = {"block": block[a], "users": [], "parts": [], "held": None, "type": batch.column(user).type}
                for c in range(a, b, 1024):
                    part = batch.slice(c, min(1024, b - c))
                    if lead[a]:
                        state["users"].append(as_array(part.column(user)))
                        state["parts"].append(dense(part))
                        continue
                    if state["held"] is None:
                        if not state["users"]:  # no user falls into this block
                            break
                        state["r"], state["has"] = (np.concatenate([x[j] for x in state["parts"]]) for j in (0, 2))
                        state["users"] = np.concatenate(state["users"])
                        state["held"] = [{"row": np.zeros(0, np.int64), "own": np.zeros(0, bool), "least": np.full(len(state["users"]), -np.inf), "last": state["users"].copy()} for _ in range(n_items)]
                    meet(state, part)
        if state:
            yield from done(state)

    kind = people.schema[user].dataType
    fields = {"__first": kind, "item_no": IntegerType(), "p": DoubleType(), "own": ArrayType(kind), "own_p": ArrayType(DoubleType()), "own_known": ArrayType(BooleanType())}
    found = rows.mapInArrow(best, StructType([StructField(n, t) for n, t in fields.items()]))
    pred = people.filter("open").select(user, "__first", "m", "s").join(found, "__first").withColumn("__at", F.array_position("own", F.col(user)).cast("int"))
    of_own = lambda c: F.get(c, F.col("__at") - 1)
    pred = pred.filter((F.col("__at") == 0) | of_own("own_known")).withColumn("p", F.when(F.col("__at") > 0, of_own("own_p")).otherwise(F.col("p")))
    return pred.select(user, "item_no", "p", "m", "s")


def fold_of(key: str, k: int, seed: int = 42) -> Column:
    return F.floor(uniform(seed, key) * k).cast("int")


def split_by_customer(df: DataFrame, key: str, dev: float = 0.1, test: float = 0.1, seed: int = 42) -> DataFrame:
    """part: test, dev or train; all rows of a key in one part, shares of keys as asked."""
    u = uniform(seed, key)
    return df.withColumn("part", F.when(u < test, "test").when(u < test + dev, "dev").otherwise("train"))


def rmse_mae(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Errors over rows with an actual; sums are exact (decimals of six places)."""
    known = df.filter(F.col(actual).isNotNull())
    err = F.col(predicted) - F.col(actual)
    mean = lambda x: F.sum(x.cast("decimal(24,6)")).cast("double") / F.count("*")
    return known.agg(F.sqrt(mean(err * err)).alias("rmse"), mean(F.abs(err)).alias("mae"))


def arhr(df: DataFrame, user: str, actual: str, predicted: str) -> DataFrame:
    """Average reciprocal hit rank: per user the sum of 1 / predicted rank over items really bought.

    Ranks count down and ties take the largest; a zero prediction is unranked."""
    w = W.partitionBy(user).orderBy(F.desc(predicted)).rangeBetween(W.unboundedPreceding, W.currentRow)
    ranked = df.withColumn("rank", F.when(F.col(predicted) != 0, F.count("*").over(w)))
    hit = F.when(F.col(actual) != 0, (1.0 / F.col("rank")).cast("decimal(20,12)"))
    per = ranked.groupBy(user).agg(F.coalesce(F.sum(hit), F.lit(0)).alias("score"))
    return per.agg((F.sum("score").cast("double") / F.count("*")).alias("arhr"))


def headroom(predictions: DataFrame, actual: str = "actual", predicted: str = "prediction") -> DataFrame:
    return predictions.withColumn("headroom", F.col(predicted) - F.col(actual))


def user_headroom_summary(df: DataFrame, user: str = "cust_id", item: str | None = None, items: Sequence[str] = ()) -> DataFrame:
    """Sum and mean of headroom and of its part above zero (sums exact to six places); both means are over all rows of a user.

    With items, the headroom of every other item counts as 0."""
    value = F.col("headroom")
    if items:
        value = F.when(F.col(item).isin(*items), value).otherwise(0.0)
    h = value.cast("decimal(20,6)")
    up = F.when(value > 0, h)
    total = lambda x: F.coalesce(F.sum(x), F.lit(0)).cast("double")
    return df.groupBy(user).agg(
        total(h).alias("sum_headroom"), (total(h) / F.count("*")).alias("ave_headroom"),
        total(up).alias("sum_positive_headroom"), (total(up) / F.count("*")).alias("ave_positive_headroom"),
    )
