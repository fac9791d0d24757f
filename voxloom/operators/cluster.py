"""Two-level clustering of vectors: within recordings, then of their centroids across recordings."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxloom.functions.vectors import is_valid


def _merged_by_sums(x: np.ndarray, distance: float, held: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[tuple[int, int]]]:
    """Merges of unit vectors nearer than ``distance`` until ``held`` clusters are left to merge, without their distances.

    The mean distance of two clusters is 1 - (sum . sum) / (size * size) over their unit vectors, so one row of distances is
    made when it is needed: the memory of the vectors is enough. A cluster with nothing nearer than ``distance`` is done, as
    a merge is never nearer to it than the nearer of the merged. Returns ids, means and sizes of the rest, and the merges.
    """
    ids, sums, size, alive = np.arange(len(x)), x.copy(), np.ones(len(x)), np.ones(len(x), dtype=bool)
    left, chain, merges = len(x), [], []
    while left > held:
        if left < 0.8 * len(ids):
            ids, sums, size, alive, chain = ids[alive], sums[alive], size[alive], np.ones(left, dtype=bool), []
        if not chain:
            chain = [int(np.argmax(alive))]
        a = chain[-1]
        row = np.where(alive, 1.0 - sums @ sums[a] / (size * size[a]), np.inf)
        row[a] = np.inf
        b = int(np.argmin(row))
        if len(chain) > 1 and row[chain[-2]] <= row[b] + 1e-12:  # rows made twice differ in the last digits
            b = chain[-2]
        if row[b] >= distance:
            alive[a], left = False, left - 1
            chain.pop()
        elif len(chain) > 1 and b == chain[-2]:
            chain = chain[:-2]
            merges.append((int(ids[a]), int(ids[b])))
            sums[b] += sums[a]
            size[b] += size[a]
            alive[a], left = False, left - 1
        else:
            chain.append(b)
    return ids[alive], sums[alive] / size[alive, None], size[alive], merges


def average_linkage(vectors: np.ndarray, distance: float, held: int = 4_000) -> np.ndarray:
    """Labels of agglomerative clustering: cosine distance, average linkage, merged while nearer than ``distance``.

    Nearest-neighbour chains find the merges in O(n^2) time; merges at or above the threshold are not applied. Labels are
    numbered by each cluster's first member. A zero vector is at distance 1 from all. The table of distances is made once at
    most ``held`` clusters are left; above that, rows of it are made as they are needed, with the same result.
    """
    n = len(vectors)
    if n < 2:
        return np.zeros(n, dtype=np.int64)
    x = vectors.astype(np.float64)
    norms = np.linalg.norm(x, axis=1, keepdims=True)
    x = np.divide(x, norms, out=np.zeros_like(x), where=norms > 0)
    up = np.arange(n)
    ids, means, size, early = _merged_by_sums(x, distance, held)
    d = 1.0 - means @ means.T
    np.fill_diagonal(d, np.inf)
    alive = np.ones(len(ids), dtype=bool)

    def find(i: int) -> int:
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    chain: list[int] = []
    merges: list[tuple[float, int, int]] = []
    for _ in range(len(ids) - 1):
        if not chain:
            chain = [int(np.flatnonzero(alive)[0])]
        while True:
            a = chain[-1]
            row = np.where(alive, d[a], np.inf)
            row[a] = np.inf
            b = int(np.argmin(row))
            if len(chain) > 1 and row[chain[-2]] <= row[b]:
                b = chain[-2]
            if len(chain) > 1 and b == chain[-2]:
                break
            chain.append(b)
        chain = chain[:-2]
        merges.append((float(d[a, b]), a, b))
        both = (size[a] * d[a] + size[b] * d[b]) / (size[a] + size[b])
        size[b] += size[a]
        alive[a] = False
        d[b], d[:, b] = both, both
        d[b, b] = np.inf
    # Average linkage never merges lower than the merges it is made of, so those under the threshold are the clusters.
    for a, b in [*early, *((ids[a], ids[b]) for height, a, b in merges if height < distance)]:
        up[find(a)] = find(b)
    first: dict[int, int] = {}
    return np.array([first.setdefault(find(i), len(first)) for i in range(n)], dtype=np.int64)


def local_clusters(vectors: DataFrame, distance: float, key: str = "lecture_id", ident: str = "seg_id", emb: str = "emb", most: int = 4_000) -> DataFrame:
    """``key, ident, cluster``: clusters of each key's valid vectors, numbered by least ident.

    A key is one task, as average linkage is a problem of the whole key: quadratic in time, but beyond ``most`` vectors only the
    vectors themselves are held, not their distances.
    """
    good = vectors.filter(is_valid(F.col(emb)) & F.col(key).isNotNull() & F.col(ident).isNotNull()).select(key, ident, emb)
    kinds = dict(vectors.dtypes)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(ident)
        return pd.DataFrame({key: pdf[key], ident: pdf[ident], "cluster": average_linkage(np.stack(pdf[emb].to_numpy()), distance, most)})

    return good.groupBy(key).applyInPandas(run, f"{key} {kinds[key]}, {ident} {kinds[ident]}, cluster bigint")


def centroids(vectors: DataFrame, keys: list[str], emb: str = "emb") -> DataFrame:
    """``keys, centroid, size``: elementwise means of valid vectors, by partial sums of each dimension."""
    good = vectors.filter(is_valid(F.col(emb)))
    means = good.select(*keys, F.posexplode(emb).alias("dim", "x")).groupBy(*keys, "dim").agg(F.avg(F.col("x").cast("double")).alias("m"), F.count("*").alias("n"))
    return means.groupBy(*keys).agg(F.transform(F.sort_array(F.collect_list(F.struct("dim", "m"))), lambda p: p["m"]).alias("centroid"), F.max("n").alias("size"))


def global_clusters(centres: DataFrame, distance: float, key: str = "lecture_id", cluster: str = "cluster", most: int = 8_000) -> DataFrame:
    """``key, cluster, size, global``: clusters of all centroids, ordered by (key, cluster); one centroid is cluster 0.

    All are clustered in one task, as average linkage is a problem of the whole; beyond ``most`` centroids only the centroids
    themselves are held, not their distances.
    """
    kind = dict(centres.dtypes)[key]

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values([key, cluster])
        return pd.DataFrame({key: pdf[key], cluster: pdf[cluster], "size": pdf["size"], "global": average_linkage(np.stack(pdf["centroid"].to_numpy()), distance, most)})

    return centres.select(key, cluster, "size", "centroid").groupBy().applyInPandas(run, f"{key} {kind}, {cluster} bigint, size bigint, global bigint")


def speaker_names(clustered: DataFrame, main: str, key: str = "lecture_id", cluster: str = "cluster") -> DataFrame:
    """``key, local_id, speaker``: the largest global cluster (of equal ones the first) is the main speaker, others 'Audience n'."""
    sizes = clustered.groupBy("global").agg(F.sum("size").alias("n"))
    top = sizes.agg(F.max_by("global", F.struct(F.col("n"), -F.col("global"))).alias("_top"))
    return clustered.crossJoin(F.broadcast(top)).select(
        key, F.col(cluster).cast("string").alias("local_id"),
        F.when(F.col("global") == F.col("_top"), F.lit(main)).otherwise(F.concat(F.lit("Audience "), F.col("global").cast("string"))).alias("speaker"))


def speaker_map(names: DataFrame, key: str = "lecture_id") -> DataFrame:
    """``key, speakers``: one map of local label to name a key."""
    return names.groupBy(key).agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("local_id", "speaker")))).alias("speakers"))
