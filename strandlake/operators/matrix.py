"""Matrix operators on long count tables: similarity, normalisation, reduction, clusters, peaks."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Accumulator, StorageLevel
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import PCA, StandardScaler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import pandas_udf
from pyspark.sql.types import FloatType

from ..functions.shared import stored
from .counting import ranked
from .ranks import quantiles


def jaccard(counts: DataFrame, *, max_cells: int | None = None) -> DataFrame:
    """``i, j, inter, ni, nj, jaccard, expected`` of cells that share a feature, i < j.

    A sparse self-join by feature. Its rows grow with the square of a feature's
    cells: filter features by prevalence first, as :func:`feature_filter` does;
    ``max_cells`` refuses a table in which one has more.
    """
    x = counts.where("n > 0").select("cell", "feature").distinct()
    if max_cells is not None:
        size = x.groupBy("feature").agg(F.count("*").alias("_n")).agg(F.max("_n")).first()[0] or 0
        if size > max_cells:
            raise ValueError(f"a feature is in {size} cells; filter features by prevalence first")
    size = x.groupBy("cell").agg(F.count("*").alias("n"))
    a, b = x.select(F.col("cell").alias("i"), "feature"), x.select(F.col("cell").alias("j"), "feature")
    both = a.join(b, "feature").where("i < j").groupBy("i", "j").agg(F.count("*").alias("inter"))
    both = both.join(size.select(F.col("cell").alias("i"), F.col("n").alias("ni")), "i").join(size.select(F.col("cell").alias("j"), F.col("n").alias("nj")), "j")
    both = both.withColumn("jaccard", F.col("inter") / (F.col("ni") + F.col("nj") - F.col("inter")))
    features = x.agg(F.count_distinct("feature").alias("_m"))
    c = lambda n: F.col(n) / F.col("_m")
    return both.crossJoin(F.broadcast(features)).withColumn("expected", 1 / (1 / c("ni") + 1 / c("nj") - 1)).drop("_m")  # one row


def similar_cells(counts: DataFrame, least: float) -> DataFrame:
    """``i, j, inter, ni, nj, jaccard``: the pairs of :func:`jaccard` with a similarity of ``least`` or more, i < j.

    Exact, by prefix filtering: with a cell's features in the order of how few
    cells have them, two such cells share one of the first ``n - ceil(least * n) + 1``
    of each. Only these meet, so a feature of most cells hardly ever joins; and only cells
    whose sizes allow the similarity. Candidates are then compared whole.
    """
    x = stored(counts.where("n > 0").select("cell", "feature").distinct(), "sets")
    often = x.groupBy("feature").agg(F.count("*").alias("_often"))
    features = x.join(often, "feature").groupBy("cell").agg(F.sort_array(F.collect_list(F.struct("_often", "feature"))).alias("_f"))
    sets = stored(features.select("cell", F.size("_f").alias("n"), F.col("_f.feature").alias("f")), "cells")
    # a hair less than the share, as rounding mustn't shorten a prefix
    need = lambda n: F.ceil(F.col(n) * (least - 1e-9))
    prefix = sets.select("cell", "n", F.explode(F.slice("f", F.lit(1), (F.col("n") - need("n") + 1).cast("int"))).alias("feature"))
    side = lambda c: prefix.select("feature", F.col("cell").alias(c), F.col("n").alias(f"n{c}"))
    near = side("i").join(side("j"), "feature").where((F.col("i") < F.col("j")) & (F.col("nj") >= need("ni")) & (F.col("ni") >= need("nj")))
    pairs = near.select("i", "j").distinct()
    whole = lambda c: sets.select(F.col("cell").alias(c), F.col("n").alias(f"n{c}"), F.col("f").alias(f"f{c}"))
    both = pairs.join(whole("i"), "i").join(whole("j"), "j").withColumn("inter", F.size(F.array_intersect("fi", "fj")).cast("long"))
    both = both.select("i", "j", "inter", F.col("ni").cast("long").alias("ni"), F.col("nj").cast("long").alias("nj"), (F.col("inter") / (F.col("ni") + F.col("nj") - F.col("inter"))).alias("jaccard"))
    return both.where(F.col("jaccard") >= least)


def quadratic_fit(df: DataFrame, x: str, y: str, group: list[str] | None = None) -> DataFrame:
    """Least squares of y on 1, x, x²: ``group, c0, c1, c2`` by normal equations.

    Two aggregations: the mean of x, then power sums around it. Sums of raw
    powers would lose most digits where x spreads little around its mean.
    """
    by = group or []
    mean = df.groupBy(*by).agg(F.avg(x).alias("_m"))
    df = df.join(mean, by) if by else df.crossJoin(F.broadcast(mean))  # one row
    X, Y = F.col(x) - F.col("_m"), F.col(y)
    powers = [F.sum(F.pow(X, F.lit(k))).alias(f"s{k}") for k in range(1, 5)]
    s = df.groupBy(*by).agg(F.first("_m").alias("_m"), F.count("*").cast("double").alias("s0"), *powers, *[F.sum(Y * F.pow(X, F.lit(k))).alias(f"t{k}") for k in range(3)])

    def det(a, b, c, d, e, f, g, h, i):
        return a * (e * i - f * h) - b * (d * i - f * g) + c * (d * h - e * g)

    v = {n: F.col(n) for n in ("s0", "s1", "s2", "s3", "s4", "t0", "t1", "t2")}
    D = det(v["s0"], v["s1"], v["s2"], v["s1"], v["s2"], v["s3"], v["s2"], v["s3"], v["s4"])
    c0 = det(v["t0"], v["s1"], v["s2"], v["t1"], v["s2"], v["s3"], v["t2"], v["s3"], v["s4"]) / D
    c1 = det(v["s0"], v["t0"], v["s2"], v["s1"], v["t1"], v["s3"], v["s2"], v["t2"], v["s4"]) / D
    c2 = det(v["s0"], v["s1"], v["t0"], v["s1"], v["s2"], v["t1"], v["s2"], v["s3"], v["t2"]) / D
    at = s.select(*by, "_m", c0.alias("_c0"), c1.alias("_c1"), c2.alias("c2"))
    m, d0, d1, d2 = (F.col(c) for c in ("_m", "_c0", "_c1", "c2"))
    return at.select(*by, (d0 - d1 * m + d2 * m * m).alias("c0"), (d1 - 2 * d2 * m).alias("c1"), "c2")


def normalise_jaccard(pairs: DataFrame, *, how: str = "ratio", clip: float = 5.0, top: float = 0.99) -> DataFrame:
    """Jaccard over what coverage predicts, ``v``.

    ``ratio``: over the fit, cut at the P99; ``residual``: z-score of the
    residuals, cut at +-clip.
    """
    fit = quadratic_fit(pairs, "expected", "jaccard")
    x = pairs.crossJoin(F.broadcast(fit))  # one row
    x = x.withColumn("fitted", F.col("c0") + F.col("c1") * F.col("expected") + F.col("c2") * F.col("expected") * F.col("expected")).drop("c0", "c1", "c2")
    if how == "ratio":
        x = x.withColumn("v", F.col("jaccard") / F.col("fitted"))
        cut = quantiles(x, [], "v", [top]).select(F.col("q")[0].alias("_cut"))
        return x.crossJoin(F.broadcast(cut)).withColumn("v", F.least("v", "_cut")).drop("_cut")
    x = x.withColumn("_r", F.col("jaccard") - F.col("fitted"))
    z = x.agg(F.avg("_r").alias("_m"), F.stddev_pop("_r").alias("_s"))
    v = (F.col("_r") - F.col("_m")) / F.col("_s")
    return x.crossJoin(F.broadcast(z)).withColumn("v", F.least(F.greatest(v, F.lit(-clip)), F.lit(clip))).drop("_r", "_m", "_s")


def blockwise_residuals(pairs: DataFrame, block: list[str]) -> DataFrame:
    """``residual`` of the Jaccard over what coverage predicts, by a fit of each block of cells, such as a pair of libraries.

    The fits come from one aggregation, a row for each block.
    """
    x = pairs.join(quadratic_fit(pairs, "expected", "jaccard", block), block)
    fitted = F.col("c0") + F.col("c1") * F.col("expected") + F.col("c2") * F.col("expected") * F.col("expected")
    return x.withColumn("residual", F.col("jaccard") - fitted).drop("c0", "c1", "c2")


def jaccard_quantiles(pairs: DataFrame, block: list[str]) -> DataFrame:
    """Quartiles of the Jaccard for each block of cells, such as a pair of assays."""
    q = quantiles(pairs, block, "jaccard", [0.25, 0.5, 0.75])
    return q.select(*block, F.col("n").alias("pairs"), *[F.col("q")[i].alias(n) for i, n in enumerate(("q25", "median", "q75"))])


def degree_scaled(pairs: DataFrame, v: str = "v") -> DataFrame:
    """``v / sqrt(di * dj)`` with each cell's degree the sum of its entries."""
    both = pairs.select(F.col("i").alias("c"), v).union(pairs.select("j", v))
    degree = both.groupBy("c").agg(F.sum(v).alias("d"))
    out = pairs.join(degree.select(F.col("c").alias("i"), F.col("d").alias("_di")), "i").join(degree.select(F.col("c").alias("j"), F.col("d").alias("_dj")), "j")
    return out.withColumn("scaled", F.col(v) / F.sqrt(F.col("_di") * F.col("_dj"))).drop("_di", "_dj")


def jaccard_by_cell(pairs: DataFrame) -> DataFrame:
    both = pairs.select(F.col("i").alias("cell"), "jaccard", F.col("ni").alias("coverage")).union(pairs.select("j", "jaccard", "nj"))
    return both.groupBy("cell").agg(F.max("coverage").alias("coverage"), F.count("*").alias("neighbours"), F.avg("jaccard").alias("mean_jaccard"))


def feature_filter(counts: DataFrame, *, min_cells: int = 2, top: float = 0.998, contigs: list[str] | None = None, contig: Column | None = None) -> DataFrame:
    """Counts on features in enough cells and below the top of the prevalence ranks."""
    x = counts.where(contig.isin(contigs)) if contigs is not None else counts
    cells = x.where("n > 0").groupBy("feature").agg(F.count_distinct("cell").alias("cells"))
    total = cells.agg(F.count("*").alias("_m"))
    placed = ranked(cells, ["cells", "feature"], "_i").crossJoin(F.broadcast(total))  # one row
    keep = placed.withColumn("_p", F.col("_i") / F.col("_m")).where((F.col("cells") >= min_cells) & (F.col("_p") <= top))
    return x.join(keep.select("feature"), "feature", "left_semi")


def cell_range_filter(counts: DataFrame, *, min_features: int = 1, min_umis: int = 1, max_umis: int | None = None, shares: DataFrame | None = None, max_share: float = 0.1) -> DataFrame:
    """Counts of cells within the ranges, their umis in ``umis``."""
    t = counts.groupBy("cell").agg(F.sum("n").alias("umis"), F.count("*").alias("features"))
    ok = (F.col("features") >= min_features) & (F.col("umis") >= min_umis)
    ok = ok & (F.col("umis") <= max_umis) if max_umis is not None else ok
    t = t.where(ok)
    if shares is not None:
        t = t.join(shares.where(F.col("share") <= max_share).select("cell"), "cell", "left_semi")
    return counts.join(t.select("cell", "umis"), "cell")


def log_normalise(counts: DataFrame) -> DataFrame:
    """``log1p`` of counts scaled so that every cell has the median total."""
    total = counts.groupBy("cell").agg(F.sum("n").alias("total"))
    median = quantiles(total, [], "total", [0.5]).select(F.col("q")[0].alias("_median"))
    x = counts.join(total.crossJoin(F.broadcast(median)), "cell")
    return x.withColumn("v", F.log1p(F.col("n") * F.col("_median") / F.col("total"))).drop("_median", "total")


def variable_features(values: DataFrame, *, top: int = 100, bins: int = 20, v: str = "v") -> DataFrame:
    """The features with the largest dispersion for their mean: ``feature, mean, dispersion, score``.

    Mean and variance over all cells, zeros included; dispersions are compared
    with the median and the median absolute deviation of features in the same
    twentieth of the means.
    """
    m = values.agg(F.count_distinct("cell").alias("_m"))
    s = values.groupBy("feature").agg(F.sum(v).alias("s1"), F.sum(F.col(v) * F.col(v)).alias("s2")).crossJoin(F.broadcast(m))
    mean = F.col("s1") / F.col("_m")
    var = (F.col("s2") - F.col("s1") * mean) / F.greatest(F.col("_m") - 1, F.lit(1))
    s = s.select("feature", mean.alias("mean"), (var / mean).alias("dispersion"))
    n = s.agg(F.count("*").alias("_n"))
    s = ranked(s, ["mean", "feature"], "_i").crossJoin(F.broadcast(n))  # one row
    s = s.withColumn("bin", F.floor(F.col("_i") * bins / F.col("_n")).cast("int")).drop("_n", "_i")
    med = s.groupBy("bin").agg(F.percentile("dispersion", F.lit(0.5)).alias("med"))
    s = s.join(med, "bin")
    mad = s.groupBy("bin").agg(F.percentile(F.abs(F.col("dispersion") - F.col("med")), F.lit(0.5)).alias("mad"))
    s = s.join(mad, "bin")
    score = F.when(F.col("mad") > 0, (F.col("dispersion") - F.col("med")) / F.col("mad")).otherwise(0.0)
    return s.select("feature", "mean", "dispersion", score.alias("score")).orderBy(F.desc("score"), "feature").limit(top)


def cell_vectors(values: DataFrame, features: DataFrame, v: str = "v") -> DataFrame:
    """Dense vectors over the selected features (a few hundred to a few thousand): ``cell, x``."""
    names = [r["feature"] for r in features.select("feature").orderBy("feature").collect()]
    wide = values.join(features.select("feature"), "feature", "left_semi").groupBy("cell").pivot("feature", names).agg(F.sum(v)).fillna(0.0)
    return wide.select("cell", F.array(*[F.col(f"`{n}`").cast("double") for n in names]).alias("x"))


def components(vectors: DataFrame, k: int, *, x: str = "x", scale: bool = True, key: str = "cell") -> DataFrame:
    """The first ``k`` principal components of each row, as an array ``pc``."""
    v = vectors.select(key, array_to_vector(x).alias("_x")).persist(StorageLevel.MEMORY_AND_DISK)  # both fits pass over it
    if scale:
        v = StandardScaler(inputCol="_x", outputCol="_s", withMean=True, withStd=True).fit(v).transform(v).select(key, F.col("_s").alias("_x"))
    model = PCA(k=k, inputCol="_x", outputCol="_p").fit(v)
    return model.transform(v).select(key, vector_to_array("_p").alias("pc"))


#: Columns up to which all singular vectors are found at once.
SMALL = 256


def _right_factor(vectors: DataFrame, x: str, basis: np.ndarray) -> np.ndarray:
    """``X' X basis``: each task sums over its rows, the sums of a column meet in one row of the result."""
    shared = vectors.sparkSession.sparkContext.broadcast(basis)

    def run(batches):
        total = np.zeros_like(shared.value)
        for batch in batches:
            rows = np.array(batch["x"].tolist(), dtype=float)
            total += rows.T @ (rows @ shared.value)
        yield pd.DataFrame({"i": np.arange(len(total)), "v": list(total)})

    parts = vectors.select(F.col(x).cast("array<double>").alias("x")).mapInPandas(run, "i long, v array<double>")
    sums = parts.groupBy("i").agg(*[F.sum(F.col("v")[j]).alias(f"v{j}") for j in range(basis.shape[1])])
    out = np.array([r[1:] for r in sorted(map(tuple, sums.collect()))])  # a row for each column of X
    shared.destroy()
    return out


def singular_basis(vectors: DataFrame, k: int, *, x: str = "x", spare: int = 10, tol: float = 1e-10, max_rounds: int = 60, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """The first ``k`` singular values and right singular vectors (as columns) of the rows ``x``.

    Block power iteration from a random start on ``k + spare`` vectors, each round one pass over the rows and an
    orthonormal basis of a matrix of as many rows as X has columns; no matrix of columns by columns
    is ever made, unless there are no more than SMALL columns: then one round gives all. Ends when no singular value moves by more than ``tol`` of the first.
    """
    d = vectors.select(F.max(F.size(x))).first()[0]
    width = d if d <= SMALL else min(d, k + spare)
    basis = np.linalg.qr(np.random.default_rng(seed).normal(size=(d, width)))[0]
    before = np.zeros(width)
    for _ in range(max_rounds):
        image = _right_factor(vectors, x, basis)
        value, turn = np.linalg.eigh((basis.T @ image + image.T @ basis) / 2)
        vec = basis @ turn[:, ::-1]
        value = np.sqrt(np.maximum(value[::-1], 0))
        if width == d or np.abs(value[:k] - before[:k]).max() <= tol * max(value[0], 1e-300):
            break
        before = value
        basis = np.linalg.qr(image)[0]
    return value[:k], vec[:, :k]


def singular_vectors(vectors: DataFrame, k: int, *, x: str = "x", key: str = "cell") -> DataFrame:
    """Scores on the first ``k + 1`` right singular vectors but the first, as an array ``sv``."""
    _, vec = singular_basis(vectors, k + 1, x=x)
    vec = vec[:, 1:]
    vec = vec * np.sign(vec[np.abs(vec).argmax(0), np.arange(vec.shape[1])])

    @pandas_udf("array<double>")
    def scores(rows: pd.Series) -> pd.Series:
        return pd.Series(list(np.array(rows.tolist(), dtype=float) @ vec))

    return vectors.select(key, scores(F.col(x).cast("array<double>")).alias("sv"))


def kmeans(vectors: DataFrame, k: int, *, x: str = "pc", key: str = "cell", seed: int = 123) -> DataFrame:
    v = vectors.select(key, array_to_vector(x).alias("features"))
    return KMeans(k=k, seed=seed, initSteps=2).fit(v).transform(v).select(key, F.col("prediction").alias("cluster"))


def cluster_summary(clusters: DataFrame, cells: DataFrame, *, key: str = "cell") -> DataFrame:
    x = clusters.join(cells, key)
    return x.groupBy("cluster").agg(F.count("*").alias("cells"), F.percentile("umis", F.lit(0.5)).alias("median_umis"), F.avg("share").alias("mean_share"))


#: Pivots are sent to every task.
MAX_PIVOTS = 1024
#: Bytes of vectors in one row of a table of units, whatever number of rows Spark sends to Python at once.
PACKED = 8192
#: Rows that a task of :func:`nearest` holds, pairs of rows that it scores at once, and numbers in the pairs that it measures at once.
HELD, SCORED, MEASURED = 1 << 14, 1 << 20, 1 << 21


def _matrix(column: pa.Array) -> np.ndarray:
    if column.null_count or column.flatten().null_count:
        raise ValueError("a vector or one of its numbers is null")
    return column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(column), -1)


class _Nearest:
    """Rows ``x`` of a task with the ``k`` nearest rows that they have met so far, by distance, then key."""

    def __init__(self, unit: np.ndarray, keys: np.ndarray, x: np.ndarray, k: int, single: bool):
        self.unit, self.keys, self.x, self.columns = unit, keys, x, np.ascontiguousarray(x.T)
        self.square, self.single = np.square(x).sum(1), single
        self.found, self.name = np.full((len(x), k), np.inf), np.full((len(x), k), np.iinfo(np.int64).max)

    def meet(self, rows: np.ndarray, keys: np.ndarray, x: np.ndarray) -> None:
        """Compare ``rows`` with all of ``x``: products tell which pairs can be near enough, only those are measured."""
        if not len(rows) or not len(x):
            return
        k, square, columns = self.found.shape[1], np.square(x).sum(1), np.ascontiguousarray(x.T)
        single = self.single and max(square.max(), self.square[rows].max()) < 1e30
        kind, exact = (np.float32, 2.0**-24) if single else (np.float64, 2.0**-53)
        other = np.column_stack([x, -square / 2]).astype(kind)
        step = max(1, SCORED // len(x))
        for start in range(0, len(rows), step):
            some = rows[start : start + step]
            # x.y - y.y / 2 falls as the distance grows; ``off`` bounds what rounding does to it and to its least value
            score = np.column_stack([self.x[some], np.ones(len(some))]).astype(kind) @ other.T
            twice = np.isin(keys, self.keys[some])
            if twice.any():
                score[:, twice] = np.where(self.keys[some][:, None] == keys[twice], -np.inf, score[:, twice])
            last = self.found[some, -1]
            off = exact * (x.shape[1] + 8) * (np.sqrt(self.square[some]) + np.sqrt(square.max())) ** 2 + 1e-36
            off += exact * np.where(np.isfinite(last), last, 0)
            least = (self.square[some] - last) / 2 - 2 * off
            i, j = np.divmod(np.flatnonzero(score >= least[:, None].astype(kind)), len(x))
            many = np.flatnonzero(np.bincount(i, minlength=len(some)) > 4 * k)
            if len(many) and len(x) > k:  # the score of the k-th is a bound too
                kth = np.partition(score[many], len(x) - k, axis=1)[:, len(x) - k]
                least[many] = np.maximum(least[many], kth - 3 * off[many])
                i, j = np.divmod(np.flatnonzero(score >= least[:, None].astype(kind)), len(x))
            most = max(1, MEASURED // x.shape[1])
            for at in range(0, len(i), most):
                a, c = some[i[at : at + most]], j[at : at + most]
                apart = self.keys[a] != keys[c]
                a, c = a[apart], c[apart]
                self._take(a, keys[c], np.square(self.columns[:, a] - columns[:, c]).sum(0))  # added up in order, as SQL does

    def _take(self, rows: np.ndarray, keys: np.ndarray, distance: np.ndarray) -> None:
        last = self.found[rows, -1]
        nearer = (distance < last) | ((distance == last) & (keys < self.name[rows, -1]))
        who, at = np.unique(rows[nearer], return_inverse=True)
        k = self.found.shape[1]
        row = np.concatenate([np.repeat(np.arange(len(who)), k), at])
        d, name = np.concatenate([self.found[who].ravel(), distance[nearer]]), np.concatenate([self.name[who].ravel(), keys[nearer]])
        order = np.lexsort((name, d, row))
        first = order[np.searchsorted(row[order], np.arange(len(who)))[:, None] + np.arange(k)]
        self.found[who], self.name[who] = d[first], name[first]


def nearest(vectors: DataFrame, k: int, *, key: str, x: str, unit: int = 2048, compared: Accumulator | None = None) -> DataFrame:
    """The ``k`` nearest rows of each row by squared Euclidean distance: ``key, neighbour, rank, distance``, ties by key.

    Exact. Rows go to the cell of their nearest pivot and there to a unit of about
    ``unit`` rows. A task holds some units and their rows' nearest so far, from their own unit at first, and all units pass by it,
    read from the stored table and not shuffled. A row meets only the units that can hold a nearer
    row by the triangle inequality: within its bound of the unit's reach around the pivot, and of the plane between
    both pivots. A task holds up to HELD rows and one unit more, whatever the sizes. ``compared`` adds up
    the pairs of rows that are compared, to be held against all.
    """
    spark = vectors.sparkSession
    single = isinstance(vectors.schema[x].dataType.elementType, FloatType)
    kind, width = ("float", "<f4") if single else ("double", "<f8")
    v = vectors.select(F.col(key).alias("k"), F.col(x).cast(f"array<{kind}>").alias("x")).where("k IS NOT NULL")
    n = v.count()
    sampled = v.orderBy(F.xxhash64("k", "x"), "k").limit(min(MAX_PIVOTS, max(1, -(-n // unit)))).select("x").collect()
    if not sampled:
        return spark.createDataFrame([], "k long, neighbour long, distance double").select(F.col("k").alias(key), "neighbour", F.lit(0).alias("rank"), "distance")
    pivots = np.unique(np.array([r["x"] for r in sampled], dtype=float), axis=0)

    def home(rows: np.ndarray) -> np.ndarray:
        return (np.square(pivots).sum(1) - 2 * rows @ pivots.T).argmin(1)

    def count(batches):
        total = np.zeros(len(pivots), np.int64)
        for batch in batches:
            total += np.bincount(home(_matrix(batch.column("x"))), minlength=len(pivots))
        yield pa.RecordBatch.from_pydict({"cell": np.arange(len(total)), "n": total})

    size = v.select("x").mapInArrow(count, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect()  # a row for each pivot
    units = np.ones(len(pivots), np.int64)
    for r in size:
        units[r["cell"]] = max(1, -(-r["n"] // unit))
    first, cell_of = np.cumsum(units) - units, np.repeat(np.arange(len(pivots)), units)
    held = max(1, min(HELD // unit, len(cell_of) // (3 * spark.sparkContext.defaultParallelism)))
    tasks = -(-len(cell_of) // held)

    def placed(batches):
        for batch in batches:
            cell = home(_matrix(batch.column("x")))
            at = first[cell] + batch.column("draw").to_numpy() % units[cell]
            yield pa.RecordBatch.from_arrays([batch.column("k"), batch.column("x"), pa.array(at), pa.array((at // held).astype(np.int32))], names=["k", "x", "unit", "task"])

    def packed(batches):
        for batch in batches:
            rows, keys, at = _matrix(batch.column("x")), batch.column("k").to_numpy(), batch.column("unit").to_numpy()
            most = max(1, PACKED // (rows.shape[1] * int(width[2:])))
            ends = [0, *(np.flatnonzero(np.diff(at)) + 1), len(at)]
            cuts = [(i, min(i + most, b)) for a, b in zip(ends[:-1], ends[1:], strict=True) for i in range(a, b, most)]
            reach = np.sqrt(np.square(rows - pivots[cell_of[at]]).sum(1))
            yield pa.RecordBatch.from_pydict({
                "unit": [int(at[a]) for a, _ in cuts], "task": [int(at[a]) // held for a, _ in cuts], "reach": [float(reach[a:b].max()) for a, b in cuts],
                "keys": [keys[a:b].astype("<i8").tobytes() for a, b in cuts], "rows": [rows[a:b].astype(width).tobytes() for a, b in cuts],
            }, pa.schema([("unit", pa.int64()), ("task", pa.int32()), ("reach", pa.float64()), ("keys", pa.binary()), ("rows", pa.binary())]))

    kinds = f"k long, x array<{kind}>, unit long, task int"
    dealt = v.withColumn("draw", F.pmod(F.xxhash64("k", "x"), F.lit(1 << 40))).mapInArrow(placed, kinds).repartitionById(tasks, "task").sortWithinPartitions("unit", "k")
    table = stored(dealt.mapInArrow(packed, "unit long, task int, reach double, keys binary, rows binary"), "units")
    between = np.sqrt(np.maximum(np.square(pivots).sum(1)[:, None] + np.square(pivots).sum(1) - 2 * pivots @ pivots.T, 0))
    furthest = np.sqrt(np.square(pivots).sum(1).max())

    def search(batches):
        own, passing, at, near = [], [], None, None
        vectors_of = lambda rows: np.frombuffer(b"".join(rows), width).astype(float).reshape(-1, pivots.shape[1])

        def begun():
            keys = [np.frombuffer(r[1], "<i8") for r in own]
            near = _Nearest(np.repeat([r[0] for r in own], [len(x) for x in keys]), np.concatenate(keys), vectors_of([r[2] for r in own]), k, single)
            near.cell = cell_of[near.unit]
            near.away = np.sqrt(np.square(near.x - pivots[near.cell]).sum(1))
            own.clear()
            for u in np.unique(near.unit):  # first among the rows of its own unit
                rows = np.flatnonzero(near.unit == u)
                if compared is not None:
                    compared.add(len(rows) ** 2)
                near.meet(rows, near.keys[rows], near.x[rows])
            return near

        def met():
            reach, c = max(r[0] for r in passing), cell_of[at]
            d = np.sqrt(np.square(near.x - pivots[c]).sum(1))
            apart = np.maximum(between[near.cell, c], 1e-300)
            plane = np.where(near.cell == c, 0, (np.square(d) - np.square(near.away)) / (2 * apart))
            most, slack = np.sqrt(near.found[:, -1]), 1e-7 * (1 + d)
            rows = np.flatnonzero((d - reach <= most + slack) & (plane <= most + slack + 1e-12 * (furthest + reach) ** 2 / apart) & (near.unit != at))
            keys = np.frombuffer(b"".join(r[1] for r in passing), "<i8")
            if compared is not None:
                compared.add(len(rows) * len(keys))
            near.meet(rows, keys, vectors_of([r[2] for r in passing]))
            passing.clear()

        for batch in (batch.slice(i, 512) for batch in batches for i in range(0, len(batch), 512)):
            for unit_, keys, rows, other, reach, other_keys, other_rows in zip(*[x.to_pylist() for x in batch.columns], strict=True):
                if rows is not None:
                    if near is not None:
                        raise RuntimeError("rows of the task's own came behind those that pass by")
                    own.append((unit_, keys, rows))
                elif near is None:
                    near = begun()
                if other_rows is not None:
                    if passing and (other != at or sum(len(r[1]) for r in passing) >= 8 * 4 * unit):
                        near = near or begun()
                        met()
                    at = other
                    passing.append((reach, other_keys, other_rows))
        if own:
            near = begun()
        if passing:
            met()
        for i in range(0, len(near.keys) if near else 0, 4096):
            r, c = np.nonzero(np.isfinite(near.found[i : i + 4096]))
            yield pa.RecordBatch.from_pydict({"k": near.keys[i + r], "neighbour": near.name[i + r, c], "distance": near.found[i + r, c]})

    # a task is the product of all units, read one after another, with its own ones, of which the first row sees all and each other the first
    nth = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    every = table.coalesce(1).select(F.col("unit").alias("other"), "reach", F.col("keys").alias("other_keys"), F.col("rows").alias("other_rows"), (nth == 0).alias("head"))
    mine = table.repartitionById(tasks, "task").select("unit", "keys", "rows", (nth == 0).alias("top"))
    both = every.join(mine.hint("shuffle_replicate_nl"), F.col("head") | F.col("top"))
    once = lambda flag, *names: [F.when(F.col(flag), F.col(c)).alias(c) for c in names]
    found = both.select("unit", *once("head", "keys", "rows"), "other", "reach", *once("top", "other_keys", "other_rows")).mapInArrow(search, "k long, neighbour long, distance double")
    order = Window.partitionBy("k").orderBy("distance", "neighbour")
    top = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)  # an id can have several rows
    return top.select(F.col("k").alias(key), "neighbour", "rank", "distance")


def radius_and_angle(cells: DataFrame, rna: str = "rna_reads", dna: str = "dna_reads") -> DataFrame:
    a, b = F.log10(F.col(rna) + 1), F.log10(F.col(dna) + 1)
    return cells.withColumn("r", F.sqrt(a * a + b * b)).withColumn("theta", F.atan2(b, a))


def select_cells(
    cells: DataFrame, group: list[str], *, rna: str = "rna_umis", dna: str = "dna_umis", least: int = 350, points: int = 512, bins: int = 2048,
    window: tuple[float, float] = (0.75, 1.25), rna_only: str | None = None, umis_only: bool = False,
) -> DataFrame:
    """Keep flags by the density of log counts: ``r, theta, cut, cut2, keep``.

    Where the column ``rna_only`` holds, as in assays without an antibody, the radius is that of
    the RNA counts alone and the angle the diagonal. ``umis_only`` leaves the density out.

    Only cells whose angle is within ``window`` of the diagonal count and can be
    kept. With t the P99.95 of all radii, the lower mode is the mean of the
    modes between t / 7 and 4 t / 7, the upper one that of those from there to
    t. The cut is the last trough between both, ``cut2`` the last one above the
    upper mode, if any; a cell between the cuts is kept. A group that lacks a
    mode or the trough keeps the cells with ``least`` umis in both assays.

    Each group's radii are counted in ``bins`` bins first, so the density sees
    a bounded histogram, whatever the number of cells.
    """
    polar = radius_and_angle(cells)
    if rna_only:
        alone = F.col(rna_only)
        polar = polar.withColumns({"r": F.when(alone, F.log10(F.col("rna_reads") + 1)).otherwise(F.col("r")), "theta": F.when(alone, math.pi / 4).otherwise(F.col("theta"))})
    enough = (F.col(rna) >= least) & (F.col(dna) >= least)
    if umis_only:
        none = F.lit(None).cast("double")
        return polar.withColumns({"cut": none, "cut2": none, "keep": enough})
    angle = F.col("theta") / F.lit(math.pi / 4)
    polar = polar.withColumn("_in", angle.between(*window))
    top = F.lit(12.0)
    at_bin = F.floor(F.col("r") / top * bins).cast("int").alias("bin")
    hist = polar.groupBy(*group, at_bin).agg(F.count("*").alias("n"), F.count_if("_in").alias("n_in"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cells.select(*group).schema)

    def cut(key, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("bin")
        x, n, every = (rows["bin"].to_numpy(float) + 0.5) * 12.0 / bins, rows["n_in"].to_numpy(float), rows["n"].to_numpy(float)
        nothing = pd.DataFrame([[*key, None, None]])
        if n.sum() < 2:
            return nothing
        t = x[np.searchsorted(np.cumsum(every), 0.9995 * every.sum())]
        mean = (x * n).sum() / n.sum()
        sd = math.sqrt(max(((x - mean) ** 2 * n).sum() / n.sum(), 1e-12))
        at = np.linspace(x.min(), x.max(), points)
        f = (np.exp(-0.5 * np.square((at[:, None] - x[None]) / (0.225 * sd + 1e-9))) * n).sum(1)
        modes = at[1:-1][(f[:-2] < f[1:-1]) & (f[1:-1] >= f[2:])]
        troughs = at[1:-1][(f[:-2] > f[1:-1]) & (f[1:-1] <= f[2:])]
        low, high = modes[(modes > t / 7) & (modes < 4 * t / 7)], modes[(modes > 4 * t / 7) & (modes < t)]
        if not len(low) or not len(high):
            return nothing
        between, above = troughs[(troughs > low.mean()) & (troughs < high.mean())], troughs[troughs > high.mean()]
        if not len(between):
            return nothing
        return pd.DataFrame([[*key, float(between[-1]), float(above[-1]) if len(above) else None]])

    cuts = hist.groupBy(*group).applyInPandas(cut, f"{kinds}, cut double, cut2 double")
    inside = F.col("_in") & (F.col("r") > F.col("cut")) & (F.col("r") < F.coalesce("cut2", F.lit(float("inf"))))
    return polar.join(cuts, group, "left").withColumn("keep", F.when(F.col("cut").isNotNull(), inside).otherwise(enough)).drop("_in")
