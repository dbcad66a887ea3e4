"""Collocations, files of ids and whitening against plain definitions, on edge cases."""

from __future__ import annotations

import collections
import itertools
import math
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ledger_spark.llm import collocations, id_files, whitening
from ledger_spark.llm.fm_index import BidirectionalIndex
from ledger_spark.llm.huffman import Codebook, code_lengths

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
LONG = " ".join(f"Ab{i % 7} cd{i % 11} ef" for i in range(6_000))
TEXTS = [
    (1, None, "en"), (2, "", "en"), (3, " \t\n ,;", None), (4, "New York, new york! NEW\tYORK x É é", "en"), (5, "a a a a a a", "fr"),
    (5, "a a a a a a", "fr"), (6, LONG, "en"), (None, "new york new", "en"), (None, "other words", None), (7, "new york new york.", None),
    (8, "<|endoftext|> it's 12345 naïve 漢字 don't", "de"), (9, "<|ENDOFTEXT|>. a<|endoftext|>b., $%x,y.!?  o'S. 's, ²., İx. Σας, e\u0301. [a]", "de"), (-3, "one", "en"),
]


@pytest.fixture(scope="module")
def docs(spark):
    clash = ", n bigint, score string, row int, f double, shard string, ids string"
    rows = [(*r, 1, "s", 2, 0.5, "z", "i") for r in TEXTS]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string" + clash).repartition(3)


def test_phrases_of_an_index_are_those_of_the_text():
    rng = np.random.default_rng(5)
    for _ in range(60):
        words, depth = rng.integers(0, rng.integers(2, 6), rng.integers(0, 90)), int(rng.integers(1, 6))
        for m, found in enumerate(BidirectionalIndex(words, depth).phrases(), 1):
            plain = collections.Counter(tuple(words[i : i + m].tolist()) for i in range(len(words) - m + 1) if 0 not in words[i : i + m])
            assert {tuple(w): n for w, n in zip(found.words.tolist(), found.size.tolist(), strict=True)} == plain
            assert len(found.size) == len(plain)


def test_intervals_of_both_directions_name_the_places_of_a_phrase():
    words = np.random.default_rng(6).integers(0, 4, 200)
    index = BidirectionalIndex(words, 4)
    for m, found in enumerate(index.phrases(), 1):
        for phrase, low, other, size in zip(found.words.tolist(), found.forward, found.backward, found.size, strict=True):
            places = [i for i in range(len(words) - m + 1) if words[i : i + m].tolist() == phrase]
            assert sorted(index.ahead.order[low : low + size] - 1) == places
            assert sorted(len(words) - m - (index.back.order[other : other + size] - 1)) == places


def plain_collocations(rows, min_count, max_words, top):
    counts, total = collections.Counter(), collections.Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for m in range(1, max_words + 1):
                counts.update((lang, tuple(words[i : i + m])) for i in range(len(words) - m + 1))
    candidates = {k: a for k, a in counts.items() if a >= min_count and len(k[1]) > 1}
    inside = collections.defaultdict(int)
    for (lang, words), a in candidates.items():
        for i, j in itertools.combinations(range(len(words) + 1), 2):
            if j - i < len(words):
                inside[lang, words[i:j]] = max(inside[lang, words[i:j]], a)
    found = collections.defaultdict(list)
    for (lang, words), a in candidates.items():
        if inside[lang, words] < a:
            cuts = [(1000 * a * total[lang] // (counts[lang, words[:k]] * counts[lang, words[k:]]), k) for k in range(1, len(words))]
            score, k = min(cuts)
            found[lang].append((-score, -a, " ".join(words).encode(), counts[lang, words[:k]], counts[lang, words[k:]]))
    return {
        (lang, rank, phrase.decode(), -a, left, right, total[lang], -score)
        for lang, some in found.items() for rank, (score, a, phrase, left, right) in enumerate(sorted(some)[:top], 1)
    }


@pytest.mark.parametrize(("min_count", "top"), [(2, 2000), (3, 4), (100, 2000)])
def test_collocations(docs, min_count, top):
    got = collocations.collocations(docs, min_count=min_count, top=top).collect()
    assert {tuple(r) for r in got} == plain_collocations(TEXTS, min_count, 5, top)
    assert len(got) == len({(r["lang"], r["rank"]) for r in got})


def test_collocations_of_texts_longer_than_a_shard(docs, monkeypatch):
    shards = collocations.shard_words
    monkeypatch.setattr(collocations, "shard_words", lambda *a, **k: shards(*a, **k, shard_size=50))
    got = collocations.collocations(docs, min_count=2).collect()
    assert {tuple(r) for r in got} == plain_collocations(TEXTS, 2, 5, 2000)


def test_collocation_scores_past_64_bits(spark):
    """1000 * a * n needs 128 bits where a and n are as large as in a corpus of many terabytes."""
    big = spark.createDataFrame([("x", "u v", 2, 4 * 10**15), ("x", "u", 1, 10**16), ("x", "v", 1, 5 * 10**15)], "lang string, phrase string, m int, f bigint")
    total = spark.createDataFrame([("x", 10**17)], "lang string, n bigint")
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(collocations, "phrase_counts", lambda *a, **k: (big, total))
        row = collocations.collocations(big).first()
    assert row["score"] == 1000 * 4 * 10**15 * 10**17 // (10**16 * 5 * 10**15)


def test_collocations_of_nothing(docs):
    assert collocations.collocations(docs.limit(0)).count() == 0


def test_phrase_columns_travel_as_one_value():
    columns = [np.array([3, 5, 2**40], np.int64), np.array([7, 1, 0], np.int64)]
    bundle = collocations._bundle(iter(columns))
    assert isinstance(bundle, bytes)
    assert [c.tolist() for c in collocations._columns(bundle)] == [c.tolist() for c in columns]
    # Spark's Arrow writer took twenty microseconds for every row beside a column of lists, null ones included
    assert not any(pa.types.is_nested(f.type) for f in collocations._PACKED)


def test_huffman_round_trip_and_lengths():
    rng = np.random.default_rng(4)
    for _ in range(40):
        counts = rng.integers(0, 50, rng.integers(1, 70)) ** 3
        counts[rng.integers(len(counts))] += 1
        used = np.flatnonzero(counts)
        lengths = code_lengths(counts, 8)
        assert lengths.max() <= 8 and (lengths[used] > 0).all() and (len(used) == 1 or sum(0.5 ** lengths[used]) == 1)
        ids, book = rng.choice(used, 700), Codebook(lengths)
        words, begins = book.pack(ids)
        sizes = np.minimum(64, len(ids) - np.arange(0, len(ids), 64))
        assert (book.unpack(words, begins[::64], sizes) == ids).all()


def test_huffman_cost_is_the_least():
    def cheapest(counts):  # without a limit: the sum of all merged pairs
        heap, cost = sorted(counts), 0
        while len(heap) > 1:
            pair, heap = heap[0] + heap[1], heap[2:]
            cost, heap = cost + pair, sorted([*heap, pair])
        return cost

    for counts in ([5, 9, 12, 13, 16, 45], [1, 1, 2, 3, 5, 8, 13], [7, 7]):
        assert int((np.array(counts) * code_lengths(np.array(counts), 12)).sum()) == cheapest(counts)
    assert code_lengths(np.array([1, 1, 2, 4, 8, 16]), 3).max() == 3
    with pytest.raises(ValueError, match="more than 2 bits"):
        code_lengths(np.ones(5, int), 2)


def plain_ids(rows):
    tokenizer = Tokenizer.from_file(VOCABULARY)
    return [(i, np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1], "<u4")) for i, t, _ in rows]


def test_id_files(docs):
    encoded = plain_ids(TEXTS)
    got = sorted(id_files.id_file_report(docs, VOCABULARY).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == sorted((i for i, _ in encoded), key=lambda i: (i is not None, i or 0))
    assert [r["start"] for r in got] == [sum(r["n_tokens"] for r in got[:k]) for k in range(len(got))]
    expected = collections.Counter((i, len(ids), zlib.crc32(ids.tobytes())) for i, ids in encoded)
    assert collections.Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got) == expected


def test_id_files_of_many_blocks(docs, monkeypatch, tmp_path):
    monkeypatch.setattr(id_files, "BLOCK_IDS", 1_000)
    monkeypatch.setattr(id_files, "STEP", 30)
    encoded = {i: ids for i, ids in plain_ids(TEXTS) if i is not None}
    manifest = id_files.write_ids(id_files.encode_texts(docs, VOCABULARY), folder=f"file://{tmp_path}", ids_per_file=15_000)
    files = manifest.orderBy("file_no").collect()
    assert len(files) > 1 and [f["start"] for f in files] == [sum(g["n_ids"] for g in files[:k]) for k in range(len(files))]
    for f in files:
        with id_files.IdFile(f["path"]) as file:
            whole = np.concatenate(list(file.all_ids()))
            assert len(whole) == f["n_ids"]
            for at, size, doc_id in zip(np.cumsum(file.sizes) - file.sizes, file.sizes, file.doc_ids, strict=True):
                assert doc_id is None or whole[at : at + size].tolist() == encoded[doc_id].tolist()
            for start, stop in ((0, 0), (0, 1), (995, 1_005), (31, 2_977), (len(whole) - 1, len(whole))):
                assert file.ids_between(start, min(stop, len(whole))).tolist() == whole[start:stop].tolist()
    got = id_files.read_documents(manifest).filter("doc_id IS NOT NULL").collect()
    assert {r["doc_id"]: r["ids_crc32"] for r in got} == {i: zlib.crc32(ids.tobytes()) for i, ids in encoded.items()}


def test_id_files_of_nothing(docs):
    assert id_files.id_file_report(docs.limit(0), VOCABULARY).count() == 0


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, n string, whitened int, i int, s int")


def test_whitening(spark):
    rng = np.random.default_rng(2)
    data = (rng.standard_normal((300, 10)) * np.arange(1, 11) + 3).astype(np.float32)
    data[7] = data[8]
    rows = [(i, v.tolist(), "x", 1, 2, 3) for i, v in enumerate(data)] + [(7, data[7].tolist(), "x", 1, 2, 3), (None, data[3].tolist(), "x", 1, 2, 3)]
    odd = [None, [], [1.0] * 9, [math.nan] * 10, [math.inf] * 10, [None] * 10, [1e30] * 10]
    rows += [(1_000 + i, v, "y", 1, 2, 3) for i, v in enumerate(odd)]
    got = whitening.whitening_report(vectors(spark, rows).repartition(5)).toPandas()
    x = np.floor(np.vstack([data, data[7], data[3]]).astype(np.float64) * 1024).astype(np.int64) + 100_000
    n, sums = len(x), x.sum(axis=0)
    centred = (n * x - sums) / n
    covariance = centred.T @ centred / n
    values, parts = np.linalg.eigh(covariance)
    values, parts = values[::-1][:8], parts[:, ::-1][:, :8]
    assert len(got) == 8 * n and set(got["n"]) == {n} and got["identity_error"].max() < 1e-9
    for c in range(8):
        assert got[got["component"] == c + 1]["explained"].iloc[0] == pytest.approx(values[c] / np.trace(covariance), rel=1e-9)
    exact = {tuple(map(int, r)): int(((n * r.astype(object) - sums) ** 2).sum()) for r in x}
    by_row = {i: v for i, v in zip([*range(300), 7, None], x, strict=True) if i is not None}
    plain = centred @ parts / np.sqrt(values)
    for (vec_id, component), some in got.dropna(subset=["vec_id"]).groupby(["vec_id", "component"]):
        assert set(some["deviation"]) == {exact[tuple(map(int, by_row[int(vec_id)]))]}
        assert abs(some["whitened"].iloc[0]) == pytest.approx(abs(plain[int(vec_id), component - 1]), rel=1e-6, abs=1e-6)


def test_whitening_without_variance(spark):
    same = [(i, [0.5, 0.25], "x", 1, 2, 3) for i in range(4)]
    assert whitening.whitening_report(vectors(spark, same)).count() == 0
    assert whitening.whitening_report(vectors(spark, same[:1])).count() == 0
    assert whitening.whitening_report(vectors(spark, same).limit(0)).count() == 0
    line = whitening.whitening_report(vectors(spark, [(i, [float(i), 1.0], "x", 1, 2, 3) for i in range(4)])).collect()
    assert {r["component"] for r in line} == {1} and all(r["explained"] == pytest.approx(1) for r in line) and len(line) == 4


def test_whitening_of_numbers_past_64_bits(spark):
    wide = [(i, [float((-1) ** i * 2.0**37), float(i)], "x", 1, 2, 3) for i in range(5)]
    got = whitening.whitening_report(vectors(spark, wide)).collect()
    assert {r["deviation"] for r in got} == {None} and max(r["identity_error"] for r in got) < 1e-6


def test_jacobi_and_pivoted_cholesky():
    rng = np.random.default_rng(9)
    for size, rank in ((1, 1), (5, 5), (9, 4), (12, 12)):
        part = rng.standard_normal((size, rank)) * 10.0 ** np.arange(rank)[::-1]
        matrix = part @ part.T
        factor = whitening.pivoted_cholesky(matrix)
        assert factor.shape[1] <= size and np.allclose(factor @ factor.T, matrix, rtol=1e-10, atol=1e-10 * matrix.max())
        values, columns = whitening.one_sided_jacobi(factor)
        assert np.allclose(values[: min(3, rank)], np.linalg.eigvalsh(matrix)[::-1][: min(3, rank)], rtol=1e-9)
        assert np.allclose(columns.T @ columns, np.eye(len(values)), atol=1e-10) and (np.diff(values) <= 0).all()
    assert whitening.pivoted_cholesky(np.zeros((3, 3))).shape == (3, 0)


def test_whitening_reads_only_what_it_needs(spark):
    table = vectors(spark, [(1, [1.0], "x", 1, 2, 3)]).withColumn("heavy", F.lit("h"))
    assert "heavy" not in whitening.usable_vectors(table).select("vec_id", "_v")._jdf.queryExecution().optimizedPlan().toString()
