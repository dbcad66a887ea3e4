"""Approximate nearest neighbours by inner product over balanced posting lists."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stage

TOP = 20
RECALL = 0.992  # share of the neighbours of the probes that the opened lists must hold
PROBES = 256  # queries compared with the whole table, to measure the ratio
SAMPLE_BYTES = 64 << 20  # of the vectors that the centroids are fit on
LIST_ROWS, CELL_ROWS = 32, 8  # rows of a list aimed at, and the fewest sampled rows that a centroid stands for
REPLICAS, BOUNDARY = 4, 1.004
DEGREE, LEAST_EXPLORED = 16, 32
BLOCK_BYTES, LEAST_BLOCKS = 4 << 20, 16  # postings lie in blocks of at most so many bytes of vectors
_SAMPLE_FILES = 16
QUERY_BYTES = 4 << 20  # of the queries compared with a block at once
COMPARED_AT_ONCE = 1 << 21  # products that a task holds
_RESULT = "query_id bigint, rank int, vec_id bigint, score double, compared bigint"


def _away(x: np.ndarray, a: np.ndarray) -> np.ndarray:
    """Squared distances of the rows from ``a``, without a copy of all rows."""
    return np.concatenate([((x[at : at + 4_096] - a) ** 2).sum(1) for at in range(0, len(x), 4_096)])


def _halve(x: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Two equal halves of the rows, split across the direction of two-means."""
    a, b = x[rng.choice(len(x), 2, replace=False)]
    for _ in range(8):
        side = _away(x, a) - _away(x, b)
        near = side <= np.median(side)
        if near.all() or not near.any():
            break
        a, b = x[near].mean(0), x[~near].mean(0)
    half = np.zeros(len(x), bool)
    half[np.argsort(_away(x, a) - _away(x, b), kind="stable")[: len(x) // 2]] = True
    return half


def balanced_centroids(x: np.ndarray, lists: int, seed: int = 5) -> np.ndarray:
    """Means of about ``lists`` cells of equal size, by halving again and again; ``x`` is put in the order of the cells."""
    rng = np.random.default_rng(seed)
    ends = [0, len(x)]  # a cell is a run of rows
    while len(ends) - 1 < lists and min(np.diff(ends)) >= 4:
        middles = []
        for at, to in zip(ends[:-1], ends[1:], strict=True):
            cell = x[at:to]
            half = _halve(cell, rng)
            cell[:] = cell[np.argsort(~half, kind="stable")]
            middles.append(at + int(half.sum()))
        ends = sorted([*ends, *middles])
    return np.array([x[at:to].mean(0) for at, to in zip(ends[:-1], ends[1:], strict=True)])


def _rows(batch: pd.DataFrame) -> np.ndarray:
    return np.stack([np.frombuffer(b, np.float64) for b in batch["v"]])


def _lifted(x: np.ndarray, top_norm: float) -> np.ndarray:
    """With one more component all vectors have the norm ``top_norm``: the largest product is then the nearest."""
    return np.column_stack((x, np.sqrt(np.maximum(top_norm**2 - (x**2).sum(1), 0.0))))


def _scaled(q: np.ndarray, top_norm: float) -> np.ndarray:
    """Queries at the norm of the lifted vectors: the nearest by product does not depend on the query's length."""
    return np.column_stack((q * (top_norm / np.sqrt((q**2).sum(1)))[:, None], np.zeros(len(q))))


def _distances(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum((x**2).sum(1)[:, None] + (centroids**2).sum(1)[None] - 2 * x @ centroids.T, 0.0))


class CentroidGraph:
    """Each centroid linked with its nearest ones, and with its neighbours in the order of the halving so that all are reached."""

    def __init__(self, centroids: np.ndarray):
        self.centroids, n = centroids, len(centroids)
        step = max(1, min(256, COMPARED_AT_ONCE // n))

        def nearest_of(some: np.ndarray) -> np.ndarray:
            return np.argsort(_distances(some, centroids), axis=1, kind="stable")[:, 1 : DEGREE + 1].copy()  # a view would keep all n columns

        near = [nearest_of(centroids[at : at + step]) for at in range(0, n, step)]
        around = np.arange(n)[:, None] + np.array([-1, 1])
        self.links = np.column_stack((np.concatenate(near), around % n))
        self.entries = np.unique(np.linspace(0, n - 1, int(np.ceil(np.sqrt(n)))).astype(np.int64))

    def search(self, x: np.ndarray, ratio: float, held: np.ndarray | None = None, least: int = 0) -> np.ndarray:
        """The lists within ``ratio`` times the distance of the nearest, and the nearest that ``held`` together ``least`` rows.

        Goes on, wave by wave, while a centroid within that distance, or among the LEAST_EXPLORED nearest,
        has links not followed yet: as many lists are opened as the ratio asks for.
        """
        away, followed = np.full(len(self.centroids), np.inf), np.zeros(len(self.centroids), bool)
        new = self.entries
        while len(new):
            away[new] = np.sqrt(((self.centroids[new] - x) ** 2).sum(axis=1))
            known = away < np.inf
            limit = away.min() * ratio
            if least and held[away <= limit].sum() < least:
                order = np.argsort(away, kind="stable")[: known.sum()]
                enough = np.searchsorted(np.cumsum(held[order]), least)
                limit = max(limit, away[order[min(enough, len(order) - 1)]])
            explored = max(limit, np.partition(away, LEAST_EXPLORED)[LEAST_EXPLORED]) if len(away) > LEAST_EXPLORED else np.inf
            wave = np.flatnonzero(known & (away <= explored) & ~followed)
            followed[wave] = True
            new = np.unique(self.links[wave])
            new = new[~known[new]]
        return np.flatnonzero(known & (away <= limit))


def _blocks(sizes: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The first block of each list and their number: neighbours share one, a crowded list has several."""
    most = max(1, min(most, -(-int(sizes.sum()) // LEAST_BLOCKS)))
    first, pieces, block, filled = [], [], -1, most
    for size in sizes.tolist():
        k = max(1, -(-size // most))
        if k > 1 or filled + size > most:
            block, filled = block + 1, 0
        first.append(block)
        pieces.append(k)
        block += k - 1
        filled = most if k > 1 else filled + size
    return np.array(first), np.array(pieces)


def _best_of(q: np.ndarray, opened: list[np.ndarray], x: np.ndarray, lists: np.ndarray, kept: int) -> tuple[np.ndarray, np.ndarray]:
    """Places (query, vector) of all that may be among the ``kept`` best of the lists each query opened.

    ``lists`` names the list of each vector, in order. Rounding of the product and ties are left in.
    """
    rough = np.full((len(q), len(x)), -np.inf)
    asking, wanted = np.repeat(np.arange(len(q)), [len(o) for o in opened]), np.concatenate(opened)
    names, starts = np.unique(lists, return_index=True)
    for name, a, b in zip(names, starts, np.append(starts[1:], len(x)), strict=True):
        who = asking[wanted == name]
        rough[who, a:b] = q[who] @ x[a:b].T
    kept = min(kept, len(x))
    low = np.partition(rough, len(x) - kept, axis=1)[:, len(x) - kept]
    slack = 1e-12 * np.sqrt((x**2).sum(1).max() * (q**2).sum(1))
    return np.nonzero((rough >= (low - slack)[:, None]) & (rough > -np.inf))


def _ranked(who: np.ndarray, score: np.ndarray, ids: np.ndarray, kept: int) -> np.ndarray:
    """Places of the ``kept`` best distinct ids of each ``who``, by score, ties to the smaller id."""
    order = np.lexsort((ids, -score, who))
    w, i = who[order], ids[order]
    fresh = np.ones(len(order), bool)
    fresh[1:] = (w[1:] != w[:-1]) | (i[1:] != i[:-1])
    order, w = order[fresh], w[fresh]
    starts = np.flatnonzero(np.concatenate(([True], w[1:] != w[:-1]))) if len(w) else np.zeros(0, np.int64)
    nth = np.arange(len(w)) - np.repeat(starts, np.diff(np.append(starts, len(w))))
    return order[nth < kept]


def _needed(placed: DataFrame, probes: np.ndarray, ratios: np.ndarray, top: int) -> list[float]:
    """For each of the ``top`` nearest others of each probe, the least ratio that opens a list it is on."""
    q = probes
    own = {v.tobytes(): i for i, v in enumerate(probes)}

    def best(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scores, least = np.empty((len(q), 0)), np.empty((len(q), 0))
        for batch in batches:
            for at in range(0, len(batch), 2_000):
                part = batch.iloc[at : at + 2_000]
                more = q @ _rows(part).T
                for j, v in enumerate(part["v"]):
                    if (i := own.get(bytes(v))) is not None:
                        more[i, j] = -np.inf
                near = np.column_stack([ratios[:, lists].min(1) for lists in part["lists"]])
                scores, least = np.column_stack((scores, more)), np.column_stack((least, near))
                keep = np.argsort(-scores, axis=1, kind="stable")[:, :top]
                scores, least = np.take_along_axis(scores, keep, 1), np.take_along_axis(least, keep, 1)
        probe, at = np.nonzero(scores > -np.inf)
        yield pd.DataFrame({"probe": probe, "score": scores[probe, at], "ratio": least[probe, at]})

    found = placed.select("v", "lists").mapInPandas(best, "probe bigint, score double, ratio double")
    nth = F.row_number().over(Window.partitionBy("probe").orderBy(F.desc("score"), "ratio"))
    return [r["ratio"] for r in found.withColumn("nth", nth).filter(F.col("nth") <= top).select("ratio").collect()]  # <= PROBES * top rows


def _first_by_hash(rows: DataFrame, n: int, most: int) -> np.ndarray:
    """The vectors of the ``most`` first of ``n`` rows (k1, k2, v) in the order of a hash of k1, then k2.

    A sort with a limit would send the driver that many rows of every partition. Those below a bound on
    the hash are about as many as are asked for; they are staged and fetched file by file.
    """
    hashed, share = rows.select(F.xxhash64("k1").alias("h"), "k2", "v"), (most + 8 * np.sqrt(most) + 64) / max(n, 1)
    while True:
        some = hashed if share >= 1 else hashed.filter(F.col("h") < int(share * 2**64) - 2**63)
        some = stage(some.repartition(_SAMPLE_FILES), "sample")
        found = some.count()
        if found >= min(n, most) or share >= 1:
            break
        share *= 2
    h, k2, v = np.empty(found, np.int64), np.empty(found, np.int64), None
    for i, r in enumerate(some.toLocalIterator()):
        x = np.frombuffer(r["v"], np.float64)
        v = np.empty((found, len(x))) if v is None else v
        h[i], k2[i], v[i] = r["h"], r["k2"], x
    return np.zeros((0, 0)) if v is None else v[np.lexsort((k2, h))[:most]]


def _to_bytes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for rows in batches:
        yield pd.DataFrame({"id": rows["id"], "v": [np.asarray(v, np.float64).tobytes() for v in rows["v"]]})


def nearest(
    vectors: DataFrame, *, every: int = 20, top: int = TOP, recall: float = RECALL, id_column: str = "vec_id", vector_column: str = "embedding"
) -> DataFrame:
    """(query_id, rank, vec_id, score, compared): nearest others of each row whose id is divisible by ``every``.

    Nearness is the inner product of the original vectors in double precision; ties go to the smaller
    id. Vectors that are null, empty, zero, of another length than most, or hold null or non-finite
    components take no part, like rows without id; repeated rows count once. Rows with equal vectors
    are searched as one: its ``top`` + 1 smallest ids are all that any result can need of it.

    Index: centroids of equal cells are fit on at most SAMPLE_BYTES of the distinct vectors; every
    distinct vector is put on the list of its nearest centroid and, near a boundary, of up to REPLICAS
    centroids within BOUNDARY times that distance. Lists grow in number with the table as long as the
    sample gives each centroid CELL_ROWS rows, in length beyond. A query searches the graph of centroids
    and opens all lists within a ratio of the nearest distance, however many they are. The ratio is
    measured on the table: PROBES queries are compared with all vectors, and it is the least that opens
    lists with ``recall`` of their neighbours. On vectors without structure that is a large part of the lists.
    Where so few lists hold less than ``top`` others, the next ones are opened too.

    Lists lie in blocks of at most BLOCK_BYTES (a crowded list is spread over several), and a query is
    compared only with the lists of a block that it opened; ``compared`` counts those vectors. A block
    that many queries open is copied for every QUERY_BYTES of them, so no task holds more.
    """
    spark = vectors.sparkSession
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.select(F.col(id_column).cast("bigint").alias("id"), F.col(vector_column).cast("array<double>").alias("v"))
    rows = rows.filter(F.col("id").isNotNull() & F.col("v").isNotNull() & ~bad & F.exists("v", lambda x: x != 0))
    sizes = rows.groupBy(F.size("v").alias("size")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "size").limit(1)
    common_size = sizes.first()
    if common_size is None:
        return spark.createDataFrame([], _RESULT)
    rows = rows.filter(F.size("v") == common_size["size"]).withColumn("v", F.transform("v", lambda x: x + 0.0))
    rows = rows.mapInPandas(_to_bytes, "id bigint, v binary").dropDuplicates(["id"])
    rows = stage(rows.withColumns({"k1": F.xxhash64("v"), "k2": F.xxhash64(F.lit(1), F.col("v"))}), "vectors")

    first = Window.partitionBy("k1", "k2").orderBy("id")
    some = rows.withColumn("nth", F.row_number().over(first)).filter(F.col("nth") <= top + 1)
    distinct = stage(some.groupBy("k1", "k2").agg(F.first("v").alias("v"), F.sort_array(F.collect_list("id")).alias("ids")), "distinct")
    n, width = distinct.count(), 8 * common_size["size"]
    sample = _first_by_hash(distinct, n, max(1, SAMPLE_BYTES // width))
    norms = distinct.mapInPandas(_largest_norm, "norm double").agg(F.max("norm")).first()[0]
    lists = max(1, min(n // LIST_ROWS, len(sample) // CELL_ROWS))
    sample = _lifted(sample, norms)
    centroids = balanced_centroids(sample, lists) if lists > 1 else sample.mean(0)[None]
    del sample

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 500):
                part = batch.iloc[at : at + 500]
                d = _distances(_lifted(_rows(part), norms), centroids)
                near = np.argsort(d, axis=1, kind="stable")[:, :REPLICAS]
                dist = np.take_along_axis(d, near, 1)
                keep = dist <= dist[:, :1] * BOUNDARY
                keep[:, 0] = True
                yield part[["v", "ids"]].assign(lists=[n[k] for n, k in zip(near, keep, strict=True)])

    placed = stage(distinct.select("v", "ids").mapInPandas(assign, "v binary, ids array<bigint>, lists array<bigint>"), "placed")
    asking = rows.filter(F.pmod("id", F.lit(every)) == 0)
    asked = stage(asking.select("k1", "k2", "v").dropDuplicates(["k1", "k2"]), "asked")
    counted = placed.select(F.explode("lists").alias("list")).groupBy("list").count().collect()  # a row per centroid
    held = np.zeros(len(centroids), np.int64)
    for r in counted:
        held[r["list"]] = r["count"]
    first, pieces = _blocks(held, max(1, BLOCK_BYTES // width))

    probes = _first_by_hash(asked, asked.count(), PROBES)
    ratio = 1.0
    if len(probes) and len(centroids) > 1:
        step = max(1, COMPARED_AT_ONCE // len(centroids))
        ratios = np.concatenate([_distances(_scaled(probes[at : at + step], norms), centroids) for at in range(0, len(probes), step)])
        ratios /= ratios.min(axis=1, keepdims=True)
        needed = _needed(placed, probes, ratios, top)
        if needed:
            ratio = float(np.quantile(needed, recall, method="higher")) * (1 + 1e-9)  # distances are rounded in two ways
    graph = CentroidGraph(centroids)

    def choose(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 500):
                part = batch.iloc[at : at + 500]
                out = []
                for k1, k2, x in zip(part["k1"], part["k2"], _scaled(_rows(part), norms), strict=True):
                    opened = graph.search(x, ratio, held, REPLICAS * (top + 1))
                    blocks = np.repeat(first[opened] - np.cumsum(pieces[opened]) + pieces[opened], pieces[opened]) + np.arange(pieces[opened].sum())
                    chosen, total = np.repeat(opened, pieces[opened]), int(held[opened].sum())
                    cuts = np.flatnonzero(np.diff(blocks)) + 1  # lists come in the order of their blocks
                    heads = blocks[np.concatenate(([0], cuts))]
                    out += [(k1, k2, total, int(b), ls) for b, ls in zip(heads, np.split(chosen, cuts), strict=True)]
                yield pd.DataFrame(out, columns=["k1", "k2", "compared", "block", "opened"])

    routed = stage(asked.mapInPandas(choose, "k1 bigint, k2 bigint, compared bigint, block bigint, opened array<bigint>"), "routed")
    load = routed.groupBy("block").agg(F.ceil(F.count("*") * width / QUERY_BYTES).alias("parts"))
    table = spark.createDataFrame(pd.DataFrame({"list": np.arange(len(first)), "first": first, "pieces": pieces}))  # a row per centroid
    postings = placed.select("v", "ids", F.explode("lists").alias("list")).join(F.broadcast(table), "list")
    postings = postings.select((F.col("first") + F.pmod(F.xxhash64("v"), "pieces")).alias("block"), "list", "v", "ids")
    postings = postings.join(load, "block").withColumn("part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1))).drop("parts")
    asks = routed.join(asked, ["k1", "k2"]).join(load.withColumnRenamed("parts", "shares"), "block")
    asks = asks.withColumn("part", F.pmod(F.xxhash64("k2"), "shares")).drop("shares")

    def compare(key, posted: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if not len(posted) or not len(queries):
            return pd.DataFrame(columns=["k1", "k2", "compared", "vec_id", "score"])
        posted = posted.sort_values("list", kind="stable")
        x, ids, q = _rows(posted), posted["ids"].to_numpy(), _rows(queries)
        least, lists_of, opened = np.array([i[0] for i in ids]), posted["list"].to_numpy(), list(queries["opened"])
        at, to, step = [], [], max(1, COMPARED_AT_ONCE // len(x))
        for k in range(0, len(q), step):
            i, j = _best_of(q[k : k + step], opened[k : k + step], x, lists_of, REPLICAS * (top + 1))
            at.append(i + k)
            to.append(j)
        at, to = np.concatenate(at), np.concatenate(to)
        score = np.concatenate([np.zeros(0), *((q[at[k : k + 8192]] * x[to[k : k + 8192]]).sum(axis=1) for k in range(0, len(at), 8192))])
        best = _ranked(at, score, least[to], top + 1)
        at, to, score = at[best], to[best], score[best]
        copies = np.array([len(ids[t]) for t in to], np.int64)
        at, score, found = np.repeat(at, copies), np.repeat(score, copies), np.concatenate([np.zeros(0, np.int64), *(ids[t] for t in to)])
        best = _ranked(at, score, found, top + 1)
        of = queries[["k1", "k2", "compared"]].iloc[at[best]].reset_index(drop=True)
        return of.assign(vec_id=found[best], score=score[best])

    found = postings.groupBy("block", "part").cogroup(asks.groupBy("block", "part")).applyInPandas(
        compare, "k1 bigint, k2 bigint, compared bigint, vec_id bigint, score double"
    )
    found = found.groupBy("k1", "k2", "vec_id").agg(F.max("score").alias("score"), F.max("compared").alias("compared"))  # on several lists
    best = Window.partitionBy("k1", "k2").orderBy(F.desc("score"), "vec_id")
    found = stage(found.withColumn("nth", F.row_number().over(best)).filter(F.col("nth") <= top + 1), "found")
    pairs = asking.select(F.col("id").alias("query_id"), "k1", "k2").join(found, ["k1", "k2"]).filter("query_id != vec_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return pairs.withColumn("rank", rank).filter(F.col("rank") <= top).select("query_id", "rank", "vec_id", "score", "compared")


def _largest_norm(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        if len(batch):
            yield pd.DataFrame({"norm": [float(np.sqrt((_rows(batch) ** 2).sum(1)).max())]})
