"""Toxicity by the nearest labelled examples: exact TF-IDF cosine over block-max inverted indexes."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stage

EXAMPLES = 8_000  # labelled texts that the model holds, at most
EXAMPLE_CHARS = 200_000_000  # all of them together
FEATURES = 4_096
NEIGHBOURS = 25
FOLDS = 5
_BLOCK = 64
_CACHED_WORDS = 300_000
_LETTERS = re.compile(r"[^\W\d_]+")
_PREFIXES = (4, 5, 6, 7, 8)
_LEAST_TEXTS = 3
_LEAST_GAIN = 3.0


def held_out(id_: Column) -> Column:
    """Rows whose labels are never learned from."""
    return F.pmod(F.crc32(id_.cast("string").cast("binary")), F.lit(FOLDS)) == 0


def _features_of(word: str) -> list[str]:
    """A word and its beginnings, which inflected languages share between words."""
    return [word, *(f"{word[:k]}*" for k in _PREFIXES if len(word) > k)]


def _words(text: str | None) -> Counter:
    return Counter(_LETTERS.findall((text or "").lower()))


class Vectorizer:
    """Counts of the chosen features of a text. What words hold is cached up to a fixed bound."""

    def __init__(self, features: dict[str, int]):
        self.features, self.known = features, {}

    def __call__(self, text: str | None) -> dict[int, int]:
        out: dict[int, int] = {}
        for word, n in _words(text).items():
            held = self.known.get(word)
            if held is None:
                if len(self.known) >= _CACHED_WORDS:
                    self.known.clear()
                held = self.known[word] = tuple(i for f in _features_of(word) if (i := self.features.get(f)) is not None)
            for i in held:
                out[i] = out.get(i, 0) + n
        return out


def choose_features(texts: list[str | None], labels: np.ndarray, most: int = FEATURES) -> dict[str, int]:
    """The features whose presence tells the labels apart best, by the signed root of the likelihood ratio."""
    seen = [Counter(), Counter()]
    for text, label in zip(texts, labels.tolist(), strict=True):
        seen[label].update({f for w in _words(text) for f in _features_of(w)})
    n = np.array([max(1, int((labels == k).sum())) for k in (0, 1)], float)
    names = [f for f in set(seen[0]) | set(seen[1]) if seen[0][f] + seen[1][f] >= _LEAST_TEXTS]
    if not names:
        return {}
    a, b = (np.array([s[f] for f in names], float) for s in seen)
    share = (a + b) / n.sum()

    def gain(k, m):
        p = np.clip(k / m, 1e-12, 1 - 1e-12)
        return k * np.log(p / share) + (m - k) * np.log((1 - p) / np.maximum(1 - share, 1e-12))

    score = gain(a, n[0]) + gain(b, n[1])
    order = sorted(np.flatnonzero(score > _LEAST_GAIN).tolist(), key=lambda i: (-score[i], names[i]))[:most]
    return {names[i]: k for k, i in enumerate(order)}


@dataclass
class BlockMaxIndex:
    """Postings of all features end to end, with the place of each block of examples and its largest weight."""

    examples: np.ndarray
    weights: np.ndarray
    place: np.ndarray  # [feature, block] to the first posting; one column more than blocks
    block_max: np.ndarray
    labels: np.ndarray

    @classmethod
    def build(cls, vectors: list[dict[int, float]], labels: np.ndarray, features: int) -> BlockMaxIndex:
        blocks = -(-max(1, len(vectors)) // _BLOCK)
        rows = sorted((f, i, w) for i, v in enumerate(vectors) for f, w in v.items())
        f, i, w = (np.array(c) for c in zip(*rows, strict=True)) if rows else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        cell = f * blocks + i // _BLOCK
        edges = np.searchsorted(cell, np.arange(features * blocks + 1))
        place = np.column_stack((edges[:-1].reshape(features, blocks), edges[blocks::blocks]))
        block_max = np.zeros(features * blocks)
        np.maximum.at(block_max, cell, w)
        return cls(i, w, place, block_max.reshape(features, blocks), labels)

    def nearest(self, vector: dict[int, float], k: int, skip: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """The ``k`` examples of the largest cosine above 0, exactly: blocks are opened while their bound can still matter."""
        features, weights = np.array(list(vector)), np.array(list(vector.values()))
        bound = weights @ self.block_max[features]
        order = np.argsort(-bound, kind="stable")
        order = order[bound[order] > 0]
        ids, scores, step, at = np.zeros(0, np.int64), np.zeros(0), 16, 0
        while at < len(order) and not (len(scores) >= k and bound[order[at]] < scores[-1]):
            blocks = order[at : at + step]
            at, step = at + step, 4 * step
            begin = self.place[np.ix_(features, blocks)].ravel()
            count = self.place[np.ix_(features, blocks + 1)].ravel() - begin
            posting = np.repeat(begin - np.cumsum(count) + count, count) + np.arange(count.sum())
            each = self.weights[posting] * np.repeat(np.repeat(weights, len(blocks)), count)
            dense = np.bincount(self.examples[posting], weights=each, minlength=len(self.labels))
            found = np.flatnonzero(dense)
            found = found[found != skip]
            ids, scores = np.concatenate((ids, found)), np.concatenate((scores, dense[found]))
            best = np.lexsort((ids, -scores))[:k]
            ids, scores = ids[best], scores[best]
        return ids, scores


def _vote(ids: np.ndarray, cosines: np.ndarray, labels: np.ndarray, prior: float) -> float:
    """Share of label 1 among the neighbours, each weighted by nearness, with one vote of half weight for the prior."""
    weights = 1.0 / (1.05 - np.minimum(cosines, 1.0))
    return float((weights @ labels[ids] + 0.5 * prior) / (weights.sum() + 0.5))


def _isotonic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Monotone steps of the mean of ``y`` over ``x`` (pool adjacent violators): positions and values."""
    order = np.argsort(x, kind="stable")
    pools: list[list[float]] = []
    for a, b in zip(x[order].tolist(), y[order].tolist(), strict=True):
        pools.append([b, 1.0, a, a])
        while len(pools) > 1 and (pools[-2][0] >= pools[-1][0] or pools[-2][3] == pools[-1][2]):
            s, n, _, last = pools.pop()
            m = pools[-1]
            pools[-1] = [(m[0] * m[1] + s * n) / (m[1] + n), m[1] + n, m[2], last]
    return np.array([(p[2] + p[3]) / 2 for p in pools]), np.array([p[0] for p in pools])


class Model:
    """Everything a task needs to score texts: bounded by EXAMPLES, FEATURES and NEIGHBOURS."""

    def __init__(self, features: dict[str, int], idf: np.ndarray, counts: list[dict[int, int]], labels: np.ndarray):
        self.features, self.idf = features, idf
        self.prior = float(labels.mean()) if len(labels) else 0.0
        self.index = BlockMaxIndex.build([self.vector(c) for c in counts], labels, max(1, len(features)))
        own = np.array([self.vote(c, skip=i)[0] for i, c in enumerate(counts)])
        self.at, self.values = _isotonic(own, labels.astype(float)) if len(labels) else (np.zeros(1), np.zeros(1))

    def vector(self, counts: dict[int, int]) -> dict[int, float]:
        raw = {f: (1 + np.log(n)) * self.idf[f] for f, n in counts.items()}
        norm = float(np.sqrt(sum(w * w for w in raw.values())))
        return {f: w / norm for f, w in raw.items()} if norm else {}

    def vote(self, counts: dict[int, int], skip: int = -1) -> tuple[float, np.ndarray, np.ndarray]:
        vector = self.vector(counts)
        if not vector:
            return self.prior * 0.5, np.zeros(0, np.int64), np.zeros(0)  # nothing that speaks for label 1
        ids, cosines = self.index.nearest(vector, NEIGHBOURS, skip)
        return _vote(ids, cosines, self.index.labels, self.prior), ids, cosines

    def score(self, counts: dict[int, int]) -> tuple[float, np.ndarray, np.ndarray]:
        """Calibrated score, and the evidence: examples and their cosines, nearest first."""
        vote, ids, cosines = self.vote(counts)
        return float(np.clip(np.interp(vote, self.at, self.values), 0.0, 1.0)), ids, cosines


_SPARSE = "doc_id bigint, held_out boolean, f array<int>, n array<int>"


def _vectors(features: dict[str, int]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        count = Vectorizer(features)
        for rows in batches:
            found = [count(t) for t in rows["text"]]
            yield pd.DataFrame({"doc_id": rows["doc_id"].astype("Int64"), "held_out": rows["held_out"],
                                "f": [list(c) for c in found], "n": [list(c.values()) for c in found]})

    return run


def score_toxicity(
    docs: DataFrame, labels: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", label_column: str = "toxic",
    examples: int = EXAMPLES, features: int = FEATURES, evidence: int = 3, example_chars: int = EXAMPLE_CHARS,
) -> DataFrame:
    """(doc_id, held_out, score, predicted, evidence: array of (doc_id, label, cosine)) of each row.

    Learned from at most ``examples`` labelled texts of at most ``example_chars`` together, the first by a
    hash of the id, none of them held out (a text that no longer fits is passed over, and of unlike texts
    with one id the smallest is taken): features are words and beginnings of words that tell the
    labels apart. Document frequencies are counted over all texts. A text is compared with the examples
    by the exact cosine of its TF-IDF vector; the nearest vote by nearness, and the votes are calibrated
    by isotonic regression on those of the examples without themselves.

    Whole texts are read. A null or empty text, or one without a feature, gets the score of examples
    without a feature. Rows without labels, or labels without text, are no examples; without any, every
    score is 0. Repeated rows are scored alike, rows with a null id as not held out. Other columns are
    not read, an empty table gives an empty result.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_column).cast("bigint").alias("doc_id"), F.col(text_column).alias("text"))
    given = labels.select(F.col(id_column).cast("bigint").alias("doc_id"), F.col(label_column).cast("int").alias("label"))
    given = given.filter(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    given = given.groupBy("doc_id").agg(F.max("label").alias("label"))
    picked = given.orderBy(F.xxhash64("doc_id"), "doc_id").limit(examples)
    taken = rows.join(F.broadcast(picked), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))
    taken = stage(taken.withColumn("size", F.coalesce(F.length("text"), F.lit(0))), "examples")
    total, fitting = 0, []
    for r in taken.select("doc_id", "size").orderBy(F.xxhash64("doc_id"), "doc_id").collect():  # <= ``examples`` rows of two numbers
        if total + r["size"] <= example_chars:
            total += r["size"]
            fitting.append((r["doc_id"],))
    chosen_ids = F.broadcast(spark.createDataFrame(fitting, "doc_id bigint"))
    kept = taken.join(chosen_ids, "doc_id", "left_semi").orderBy(F.xxhash64("doc_id"), "doc_id").collect()
    texts, known = [r["text"] for r in kept], np.array([r["label"] for r in kept], np.int64)
    chosen = choose_features(texts, known, features) if kept else {}

    ids_held = F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out")
    sparse = stage(rows.select("doc_id", ids_held, "text").mapInPandas(_vectors(chosen), _SPARSE), "sparse")
    n_docs = sparse.count()
    frequency = np.ones(max(1, len(chosen)))
    for r in sparse.select(F.explode("f").alias("f")).groupBy("f").count().collect():  # at most ``features`` rows
        frequency[r["f"]] = r["count"]
    counts = Vectorizer(chosen)
    learned = Model(chosen, np.log((1 + n_docs) / frequency) + 1, [counts(t) for t in texts], known)
    # pickled by value: executors need no copy of this package
    sent = spark.sparkContext.broadcast(cloudpickle.dumps((learned, [r["doc_id"] for r in kept])))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m, names = cloudpickle.loads(sent.value)
        for batch in batches:
            scores, why = [], []
            for f, n in zip(batch["f"], batch["n"], strict=True):
                score, near, cosines = m.score(dict(zip(f.tolist(), n.tolist(), strict=True)))
                scores.append(score)
                why.append([{"doc_id": names[i], "label": int(m.index.labels[i]), "cosine": float(c)} for i, c in zip(near[:evidence], cosines[:evidence], strict=True)])
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "held_out": batch["held_out"], "score": scores,
                                "predicted": [int(s >= 0.5) for s in scores], "evidence": why})

    return sparse.mapInPandas(
        run, "doc_id bigint, held_out boolean, score double, predicted int, evidence array<struct<doc_id:bigint,label:int,cosine:double>>"
    )
