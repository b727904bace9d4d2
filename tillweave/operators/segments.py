"""Customer segments: standardise, reduce, cluster within each demographic category, all categories at once."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillweave.functions.shipping import ship
from tillweave.operators import kmeans
from tillweave.operators.ranks import same
from tillweave.sources.scratch import stored

ship(__name__)

#: Categories are demographic codes; more of them are an error.
MAX_CATEGORIES = 1000


def moments(df: DataFrame, columns: Sequence[str], category: str | None = None) -> DataFrame:
    """category, n and cov_{i}_{j} (i <= j, places of the columns): sample covariances, mergeable, in one pass.

    Rows with a null or NaN in a column are left out; a single row has covariances of 0."""
    whole = df.dropna(subset=list(columns))
    pairs = [(i, j) for i in range(len(columns)) for j in range(i, len(columns))]
    cov = [F.coalesce(F.nanvl(F.covar_samp(F.col(columns[i]).cast("double"), F.col(columns[j]).cast("double")), F.lit(0.0)), F.lit(0.0)).alias(f"cov_{i}_{j}") for i, j in pairs]
    return whole.groupBy(*([category] if category else [])).agg(F.count("*").alias("n"), *cov)


def standardise(df: DataFrame, columns: Sequence[str], category: str | None = None) -> DataFrame:
    """scaled: the columns over their deviation (within the category), not centred; 0 without deviation.

    Rows with a null or NaN in a column are left out; an empty table stays empty."""
    dev = moments(df, columns, category).select(*([category] if category else []), *(F.sqrt(F.greatest(F.col(f"cov_{i}_{i}"), F.lit(0.0))).alias(f"s_{i}") for i in range(len(columns))))
    both = df.dropna(subset=list(columns)).alias("d").join(dev.alias("m"), same("d", "m", [category] if category else []))
    scaled = [F.when(F.col(f"m.s_{i}") > 0, F.col(f"d.{c}").cast("double") / F.col(f"m.s_{i}")).otherwise(0.0) for i, c in enumerate(columns)]
    return both.select("d.*", F.array(*scaled).alias("scaled"))


def loadings(moment_rows: DataFrame, p: int, k: int, category: str | None = None) -> DataFrame:
    """category, loadings: the k first principal directions of the scaled columns, solved per category in tasks.

    Of each direction the entry of largest size (the first of equals) is positive."""
    keys = [category] if category else []

    def run(batches):
        for batch in batches:
            out = []
            for r in range(batch.num_rows):
                c = np.zeros((p, p))
                for i in range(p):
                    for j in range(i, p):
                        c[i, j] = c[j, i] = batch.column(f"cov_{i}_{j}")[r].as_py()
                dev = np.sqrt(np.maximum(np.diag(c), 0))
                scale = np.where(dev > 0, 1 / np.where(dev > 0, dev, 1), 0)
                _, v = np.linalg.eigh(c * np.outer(scale, scale))
                v = v[:, ::-1][:, :k].T
                top = np.abs(v).round(9).argmax(axis=1)
                out.append((v * np.where(v[np.arange(len(v)), top] < 0, -1, 1)[:, None]).tolist())
            yield pa.RecordBatch.from_arrays([*(batch.column(x) for x in keys), pa.array(out, pa.list_(pa.list_(pa.float64())))], [*keys, "loadings"])

    kind = "".join(f"{x} {moment_rows.schema[x].dataType.simpleString()}, " for x in keys)
    return moment_rows.mapInArrow(run, kind + "loadings array<array<double>>")


def reduced(df: DataFrame, columns: Sequence[str], k: int, category: str | None = None) -> DataFrame:
    """df with scaled, and pca_0 ... of it (within the category), as doubles."""
    ready = standardise(df, columns, category)
    found = loadings(moments(df, columns, category), len(columns), k, category)
    both = ready.alias("d").join(found.alias("m"), same("d", "m", [category] if category else []))
    dot = lambda i: F.aggregate(F.zip_with(F.col("m.loadings")[i], F.col("d.scaled"), lambda a, b: a * b), F.lit(0.0), lambda a, b: a + b)
    return both.select("d.*", *(dot(i).alias(f"pca_{i}") for i in range(k)))


def cluster_sizes(df: DataFrame, column: str, least: float) -> DataFrame:
    """Rows, share and whether the share is below the least, of every cluster."""
    sizes = df.groupBy(column).agg(F.count("*").alias("n_rows"))
    total = sizes.agg(F.sum("n_rows").alias("__all"))
    share = F.col("n_rows").cast("double") / F.col("__all")
    return sizes.crossJoin(F.broadcast(total)).withColumns({"fraction": share, "fails": share < least}).drop("__all")


def search(df: DataFrame, category: str, columns: Sequence[str], k_min: int, k_max: int, pca_k: int | None = 2, lower: int = 100, least: float = 0.01, give_up: int = 3, key: str = "cust_id", seed: int = 7) -> DataFrame:
    """key, category, segmentation (and pca columns) of all categories; small ones are segment 0.

    Of k_min to k_max - 1 clusters each category has those of best silhouette whose clusters all have the least
    share of its rows; segment 0 if none have. All categories and ks are fitted in the same rounds.
    An empty table gives no rows."""
    sizes = df.groupBy(category).count().orderBy(category).limit(MAX_CATEGORIES + 1).toArrow()
    if sizes.num_rows > MAX_CATEGORIES:
        raise ValueError(f"{category} has more than {MAX_CATEGORIES} categories")
    names = [f"pca_{i}" for i in range(pca_k or 0)]
    blank = [F.lit(None).cast("double").alias(n) for n in names]
    large = [i for i, n in enumerate(sizes.column("count").to_pylist()) if n > lower]
    if not large:
        return df.select(key, category, F.lit(0).alias("segmentation"), *blank)
    numbers = df.sparkSession.createDataFrame(pa.table({"__name": sizes.column(0), "no": pa.array(range(sizes.num_rows), pa.int32())}))
    both = df.alias("d").join(F.broadcast(numbers).alias("n"), F.col(f"d.{category}").eqNullSafe(F.col("n.__name"))).select("d.*", F.col("n.no").alias("no"))
    some = both.filter(F.col("no").isin(large))
    ready = reduced(some, columns, pca_k, category) if pca_k else standardise(some, columns, category)
    features = F.array(*names) if pca_k else F.col("scaled")
    ready = stored(ready.select(key, category, *names, "no", features.alias("features")))
    models = kmeans.fit(ready, key, range(k_min, k_max), seed)
    found = kmeans.moments(ready, models)
    best = kmeans.chosen(models, found, kmeans.silhouettes(ready, models, found), least, give_up)
    done = kmeans.labelled(ready, best).select(key, category, "segmentation", *names)
    return done.unionByName(both.filter(~F.col("no").isin(large)).select(key, category, F.lit(0).alias("segmentation"), *blank))
