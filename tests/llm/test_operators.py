"""The operators against plain definitions, on edge cases: nulls, empty and long texts, repeats, empty tables."""

from __future__ import annotations

import collections
import hashlib
import itertools
import re
import tracemalloc
import zlib

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from ledger_spark.llm import line_dedup, near_dedup, nearest, packing, pieces, quality_rules, repeats, sharding, toxicity, warc
from ledger_spark.llm.suffix_array import common_prefixes, suffix_array

WORD = re.compile(r"[^\x20\x09-\x0D]+")
PROSE = " ".join(f"word{i * 7 % 61} the{i % 13}" for i in range(220))
TEXTS = [
    None, "", " \n\t ", "one", "one two three", PROSE, PROSE, PROSE + " tail of another kind", "x " * 30, "é" * 500, "é" * 500,
    "Sub line of seven plain words here\nother words stand on this line now\n" * 2,
    "sub line of seven plain words here\nwholly different things are said below it", "A b C d e f g h\n\n# $ %", PROSE[:900] + "\n" + PROSE[300:],
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "clash") for i, t in enumerate(TEXTS)] + [(None, PROSE, "clash"), (5, PROSE, "clash")]
    return spark.createDataFrame(rows, "doc_id bigint, text string, size string")


@pytest.fixture(scope="module")
def nothing(docs):
    return docs.limit(0)


def texts_of(docs):
    return [(r["doc_id"], r["text"]) for r in docs.collect()]


def test_suffix_array_and_prefixes_of_small_alphabets():
    rng = np.random.default_rng(3)
    for _ in range(60):
        text = rng.choice(np.array([0, 1, 97], np.uint8), rng.integers(1, 50))
        data, sa = text.tobytes(), suffix_array(text)
        assert sa.tolist() == sorted(range(len(data)), key=lambda i: data[i:])
        prefixes = common_prefixes(text, sa)
        for a, b, n in zip(sa, sa[1:], prefixes[1:], strict=False):
            assert data[a : a + n] == data[b : b + n] and (max(a, b) + n == len(data) or data[a + n] != data[b + n])


@pytest.mark.parametrize("regions", [2, 1000])
def test_repeats(docs, monkeypatch, regions):
    monkeypatch.setattr(repeats, "_REGIONS_A_SHARD", regions)
    data = [(i, (t or "").encode()) for i, t in texts_of(docs)]
    seen = collections.Counter(b[j : j + 400] for _, b in data for j in range(len(b) - 399))
    expected = []
    for i, b in data:
        mask = np.zeros(len(b) + 1, bool)
        for j in range(len(b) - 399):
            mask[j : j + 400] |= seen[b[j : j + 400]] > 1
        runs = int((np.diff(np.concatenate(([0], mask.astype(int)))) == 1).sum())
        rest = bytes(np.frombuffer(b, np.uint8)[~mask[:-1]])
        expected.append((i, len(b), int(mask.sum()), runs, hashlib.sha256(rest).hexdigest()))
    assert collections.Counter(map(tuple, repeats.repeats_digest(docs).collect())) == collections.Counter(expected)
    assert repeats.remove_repeats(docs).columns == docs.columns


def test_near_duplicates(docs):
    sets = {}
    for i, t in texts_of(docs):
        w = WORD.findall("".join(c.lower() if c.isascii() else c for c in t or ""))
        if i is not None:
            sets[i] = {tuple(w)} if 0 < len(w) < 4 else {tuple(w[k : k + 4]) for k in range(len(w) - 3)}
    name = {i: i for i in sets}
    for _ in sets:
        for a, b in itertools.permutations(sets, 2):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * len(sets[a] | sets[b]):
                name[a] = min(name[a], name[b])
    got = {r["doc_id"]: r for r in near_dedup.near_duplicates(docs).collect()}
    assert got.pop(None)["kept"]
    assert {i: (r["n_shingles"], r["component_id"], r["kept"]) for i, r in got.items()} == {i: (len(s), name[i], name[i] == i) for i, s in sets.items()}


def test_near_duplicates_of_families(spark, monkeypatch):
    """Families whose members are near each other but not all near the first: compared in several blocks."""
    monkeypatch.setattr(near_dedup, "_BLOCK_ROWS", 4)
    rng, rows = np.random.default_rng(8), []
    for family in range(3):
        base = [f"f{family}w{k}" for k in range(120)]
        for member in range(25):
            words = list(base)
            for variant in range(1 + member % 3):
                words[variant * 30 : variant * 30 + 9] = [f"v{family}-{variant}-{k}" for k in range(9)]
            words[int(rng.integers(95, 119))] = f"own{member}"
            rows.append((len(rows), " ".join(words)))
    sets = {i: {tuple(t.split()[k : k + 4]) for k in range(len(t.split()) - 3)} for i, t in rows}
    name = {i: i for i in sets}
    links = [(a, b) for a, b in itertools.combinations(sets, 2) if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    for _ in range(10):
        for a, b in links:
            name[a] = name[b] = min(name[a], name[b])
    assert len(set(name.values())) > 3 and links
    got = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == name


def test_repeated_lines(docs):
    lines = {}
    for i, t in texts_of(docs):
        for k, line in enumerate((t or "").split("\n")):
            lines[(-(2**63) if i is None else i, k)] = frozenset(WORD.findall(line.lower()))
    gone = {
        b for a, b in itertools.permutations(lines, 2)
        if a < b and lines[a] and lines[b] and 100 * len(lines[a] & lines[b]) >= 80 * len(lines[a] | lines[b])
    }
    assert {tuple(r) for r in line_dedup.repeated_lines(docs).collect()} == gone
    after = line_dedup.remove_repeated_lines(docs)
    assert after.columns == docs.columns and after.count() == docs.count()


def _plain_lines(texts, percent=80):
    """Lines (text number, line number) similar to an earlier one, of any number of words."""
    lines = {(i, k): frozenset(WORD.findall(line.lower())) for i, t in enumerate(texts) for k, line in enumerate((t or "").split("\n"))}
    return {
        b for a, b in itertools.permutations(lines, 2)
        if a < b and lines[a] and lines[b] and 100 * len(lines[a] & lines[b]) >= percent * len(lines[a] | lines[b])
    }


def test_short_lines_are_removed(spark):
    texts = ["Home\nSign in\none two three four\n\nonly here", "sign IN\none two three four five\n\nHome", "in sign\nfive four three\nhome home", "a b c d\na b c"]
    gone = _plain_lines(texts)
    assert len(gone) == 5
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    report = {r["doc_id"]: r["removed"] for r in line_dedup.line_report(docs).collect()}
    assert {(i, int(k)) for i, ks in report.items() for k in ks.split(",") if k} == gone
    kept = {i: "\n".join(line for k, line in enumerate(t.split("\n")) if (i, k) not in gone) for i, t in enumerate(texts)}
    assert dict(texts_of(line_dedup.remove_repeated_lines(docs))) == kept


def test_only_repeated_sets_are_gathered(spark, monkeypatch):
    texts = [f"own{i} words{i} stand{i} on{i} this{i} line{i}\nthe same plain line of every text" for i in range(30)]
    texts += ["own3 words3 stand3 on3 this3 line3 too", "THE  same plain line\tof every text"]
    tables, stage = {}, line_dedup.stage
    monkeypatch.setattr(line_dedup, "stage", lambda df, name: tables.setdefault(name, stage(df, name)))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    assert {tuple(r) for r in line_dedup.repeated_lines(docs).collect()} == _plain_lines(texts)
    assert tables["line-firsts"].count() == 1 and tables["lines"].count() == 62


def test_settled_lines_are_not_compared_again(spark, monkeypatch):
    """Near copies that one comparison with the earliest of them settles make no further pairs."""
    words = [f"word{k}" for k in range(20)]
    texts = [" ".join(words), *(" ".join([*words[: k % 20], f"own{k}", *words[k % 20 + 1 :]]) for k in range(100))]
    pairs, stage = [], line_dedup.stage

    def staged(df, name):
        table = stage(df, name)
        pairs.extend([table.count()] if name.endswith("pairs") else [])
        return table

    monkeypatch.setattr(line_dedup, "stage", staged)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    assert {tuple(r) for r in line_dedup.repeated_lines(docs).collect()} == _plain_lines(texts)
    assert 100 <= pairs[0] <= 400 and pairs[1:] == [0]


def test_lines_of_texts_that_share_an_id_or_have_none(spark):
    seven = "seven plain words stand on this line"
    rows = [
        (None, f"head of one text alone here\n{seven}\ntail of the first text only"),
        (None, f"begin another text with these words\n{seven}\nunlike any other line in here"),
        (3, f"{seven} now\nsome words said under the third id"), (3, "quite different words under that id\nand yet more of these unlike words"),
    ]
    after = collections.Counter(texts_of(line_dedup.remove_repeated_lines(spark.createDataFrame(rows, "doc_id bigint, text string"))))
    first = {(None, rows[k][1]) for k in range(2)} & set(after)
    assert len(first) == 1  # the line stays in one of the two
    (other,) = [r for r in rows[:2] if r not in first]
    assert after == collections.Counter([*first, (None, other[1].replace(seven + "\n", "")), (3, "some words said under the third id"), rows[3]])


def test_packing(docs):
    got = packing.pack(packing.tokenize_pieces(docs, public_tokenizers.path("word_bpe_49k.json"), window=64, with_ids=True), window=64).collect()
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    expected = collections.Counter()
    for i, t in texts_of(docs):
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        expected.update((i, at, zlib.crc32(ids[at : at + 64].tobytes()), len(ids)) for at in range(0, len(ids), 64))
    assert collections.Counter((r["doc_id"], r["start"], r["ids_crc32"], r["doc_tokens"]) for r in got) == expected
    by_sequence = collections.defaultdict(list)
    for r in got:
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    for spans in by_sequence.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 64


def test_fill_windows_uses_every_piece_once():
    counts = {1: 5, 3: 40, 7: 11, 10: 9, 16: 2}
    used = collections.Counter()
    for pattern, times in packing.fill_windows(counts, 16):
        assert sum(k * n for k, n in pattern.items()) <= 16
        for k, n in pattern.items():
            used[k] += n * times
    assert used == counts


def test_pieces_of_long_runs_without_a_shuffle(spark):
    import sentencepiece

    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as f:
        data = f.read()
    table, library = pieces.read_model(data), sentencepiece.SentencePieceProcessor(model_proto=data)
    texts = ["the" * 3000 + "rein" * 700, " " * 5000 + "x", "aé漢" * 1500, "plain words", "", None]
    encoded = pieces.encode(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"), table)
    got = {r["doc_id"]: np.frombuffer(r["ids"], "<i4").tolist() for r in encoded.collect()}
    assert got == {i: library.encode(t or "") for i, t in enumerate(texts)}  # runs were cut at 4,096 characters
    assert "Exchange" not in encoded._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("kind", ["bpe", "unigram"])
def test_pieces_like_the_library(docs, kind):
    import sentencepiece

    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as f:
        data = f.read()
    if kind == "unigram":  # the same pieces read as a unigram model
        model = pytest.importorskip("sentencepiece.sentencepiece_model_pb2").ModelProto()
        model.ParseFromString(data)
        model.trainer_spec.model_type = 1
        data = model.SerializeToString()
    table = pieces.read_model(data)
    library = sentencepiece.SentencePieceProcessor(model_proto=data)
    encoded = pieces.encode(docs, table)
    got = collections.Counter((r["doc_id"], tuple(np.frombuffer(r["ids"], "<i4").tolist())) for r in encoded.collect())
    if kind == "bpe":
        assert got == collections.Counter((i, tuple(library.encode(t or ""))) for i, t in texts_of(docs))
    else:  # the library adds up scores in single precision, so its path may cost a little more, never less
        cost = lambda ids: sum(-table.pieces[i][2] for i in ids)
        best = sorted((str(i), cost(library.encode(t or ""))) for i, t in texts_of(docs))
        own = sorted((str(i), cost(p)) for i, p in got.elements())
        for (i, a), (k, b) in zip(own, best, strict=True):
            assert i == k and a <= b + 1 and a == pytest.approx(b, rel=1e-4)
    assert collections.Counter((r["doc_id"], r["text"]) for r in pieces.decode(encoded, table).collect()) == collections.Counter((i, t or "") for i, t in texts_of(docs))


def test_warc(spark):
    html = [None, "", "short", "short", "y" * 50_000, "y" * 50_000, "\r\n\r\nWARC/1.1\r\n\r\n" * 20]
    pages = spark.createDataFrame([(i, "u\r\n%" if i % 2 else None, h) for i, h in enumerate(html)] + [(None, "u", "y" * 50_000)], "page_id bigint, url string, html string")
    chunks = warc.read_archives(spark, warc.write_archives(warc.record_chunks(pages)))
    got = {r["page_id"]: r for r in warc.records(chunks).collect()}
    for i, h in enumerate(html):
        data = (h or "").encode()
        assert (got[i]["payload_bytes"], got[i]["payload_digest"]) == (len(data), hashlib.sha256(data).hexdigest())
        assert got[i]["refers_to"] == (4 if i == 5 else None)
    assert got[None]["record_type"] == "revisit"
    back = chunks.filter("page_id = 4").orderBy("chunk_no").collect()
    assert len(back) == 4 and b"".join(r["chunk"] for r in back) == b"y" * 50_000
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_quality(docs):
    got = {r["doc_id"]: r for r in quality_rules.judge_quality(docs).collect()}
    assert got[0]["n_words"] == 0 and got[0]["base_failed"] and not got[0]["kept"]
    assert (got[8]["n_words"], got[8]["n_repeat_words"], got[8]["base_failed"]) == (30, 30, True)
    assert got[11]["n_dup_lines"] == 2
    assert got[13]["n_symbols"] == 3
    assert quality_rules.keep_good(docs).columns == docs.columns


def test_shards(docs):
    got = sharding.shard_by_bytes(docs, shards=4).collect()
    assert len(got) == docs.count() and all(r["law"] == "bytes" for r in got)
    slots = collections.defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(r["text_crc32"] == zlib.crc32((TEXTS[r["doc_id"]] or "").encode()) for r in got if r["doc_id"] is not None)


def test_nearest(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(3000, 16))
    x[100:160] = x[100]
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(9000, None), (9020, [0.0] * 16), (9040, [float("nan")] * 16), (None, x[0].tolist()), (9060, [])]
    got = nearest.nearest(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")).collect()
    assert {r["query_id"] for r in got} == set(range(0, 3000, 20))
    found = collections.defaultdict(dict)
    for r in got:
        found[r["query_id"]][r["rank"]] = (r["vec_id"], r["score"])
    hits = 0
    for q, ranked in found.items():
        assert sorted(ranked) == list(range(1, 21))
        scores = x @ x[q]
        scores[q] = -np.inf
        hits += len(set(np.lexsort((np.arange(3000), -np.round(scores, 9)))[:20]) & {v for v, _ in ranked.values()})
        assert all(abs(float(x[q] @ x[v]) - s) < 1e-9 for v, s in ranked.values())
    assert hits / (20 * len(found)) >= 0.9


def _recall(spark, x, every):
    def emit(batches):
        for b in batches:
            yield pd.DataFrame({"vec_id": b["id"], "embedding": list(x[b["id"]])})

    rows = spark.range(len(x)).mapInPandas(emit, "vec_id bigint, embedding array<double>")
    found = collections.defaultdict(set)
    for r in nearest.nearest(rows, every=every).collect():
        found[r["query_id"]].add(r["vec_id"])
    assert len(found) == -(-len(x) // every) and all(len(f) == 20 for f in found.values())
    hits = 0
    for q, ids in found.items():
        scores = x @ x[q]
        scores[q] = -np.inf
        hits += len(set(np.argpartition(-scores, 20)[:20]) & ids)
    return hits / (20 * len(found))


def test_nearest_holds_recall_on_many_vectors_without_structure(spark):
    x = np.random.default_rng(2).normal(size=(100_000, 64))
    assert _recall(spark, x / np.sqrt((x**2).sum(1))[:, None], 500) >= 0.99


def test_nearest_opens_lists_of_clustered_vectors(spark):
    rng = np.random.default_rng(4)
    x = np.repeat(rng.normal(size=(400, 16)), 50, axis=0) + 0.05 * rng.normal(size=(20_000, 16))
    assert _recall(spark, x, 100) >= 0.99


def test_nearest_driver_holds_links_only():
    """The graph of many centroids does not hold their distances, and halving copies no more than the sample."""
    x = np.random.default_rng(4).normal(size=(3_000, 16))
    tracemalloc.start()
    graph = nearest.CentroidGraph(x)
    held, _ = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert held < 4 << 20  # all distances are 72 MB
    near = np.argsort(nearest._distances(x[:256], x), axis=1, kind="stable")[:, 1 : nearest.DEGREE + 1]
    assert (graph.links[:256, : nearest.DEGREE] == near).all()


def test_nearest_sample_is_the_first_by_hash(spark):
    x = np.random.default_rng(6).normal(size=(3_000, 4))
    rows = spark.createDataFrame([(i, -i, v.tobytes()) for i, v in enumerate(x)], "k1 bigint, k2 bigint, v binary").repartition(20)
    rows = nearest.stage(rows, "test")
    for most in (1, 50, 2_990, 5_000):
        want = [r["v"] for r in rows.orderBy(F.xxhash64("k1"), "k2").limit(most).collect()]
        assert [v.tobytes() for v in nearest._first_by_hash(rows, len(x), most)] == [bytes(v) for v in want]


def test_nearest_ties_go_to_smaller_ids(spark):
    x = np.concatenate((np.eye(64), 2 * np.eye(64), 3 * np.eye(64)))
    got = nearest.nearest(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id bigint, embedding array<double>"), every=100)
    assert sorted((r["rank"], r["vec_id"]) for r in got.collect() if r["query_id"] == 0)[:5] == [(1, 128), (2, 64), (3, 1), (4, 2), (5, 3)]


def test_block_max_search_is_exact():
    rng = np.random.default_rng(2)
    dense = np.where(rng.random((500, 40)) < 0.2, rng.random((500, 40)), 0.0)
    vectors = [{int(f): float(v[f]) for f in np.flatnonzero(v)} for v in dense]
    index = toxicity.BlockMaxIndex.build(vectors, np.zeros(500, np.int64), 40)
    for i in range(0, 500, 25):
        ids, scores = index.nearest(vectors[i], 10, skip=i)
        full = dense @ dense[i]
        full[i] = -1
        assert np.allclose(scores, np.sort(full)[::-1][:10])


def test_toxicity_held_out(spark):
    bad = ["you awful scum", "what a moron is this", "stupid idiot go away"]
    rows = [(i, f"{PROSE[i % 50:]} {bad[i % 3] if i % 4 == 0 else 'fine day to all'}") for i in range(300)] + [(1000, None), (1001, "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(300)], "doc_id bigint, toxic int")
    got = {r["doc_id"]: r for r in toxicity.score_toxicity(docs, labels).collect()}
    assert len(got) == 302 and all(0 <= r["score"] <= 1 for r in got.values())
    for i in range(300):
        assert got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert got[i]["predicted"] == int(i % 4 == 0)
    assert got[1000]["predicted"] == 0


def test_empty_tables(nothing):
    for out in (
        repeats.repeats_digest(nothing), near_dedup.near_duplicates(nothing), line_dedup.line_report(nothing), quality_rules.judge_quality(nothing),
        sharding.shard_by_bytes(nothing), packing.pack(packing.tokenize_pieces(nothing, public_tokenizers.path("word_bpe_49k.json"))),
        nearest.nearest(nothing.select(F.col("doc_id").alias("vec_id"), F.array(F.lit(1.0)).alias("embedding"))),
        toxicity.score_toxicity(nothing, nothing.select("doc_id", F.lit(1).alias("toxic"))),
    ):
        assert out.count() == 0


def test_pipeline(spark, small_folder):
    import corpus_pipeline

    docs = spark.read.parquet(f"{small_folder}/documents.parquet")
    columns = docs.columns
    for _, function in corpus_pipeline.STAGES[:-1]:
        docs = function(spark, docs, small_folder)
        assert docs.columns == columns
        docs = line_dedup.stage(docs, "test")
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, small_folder)
    assert {r[0] for r in packed.select("doc_id").distinct().collect()} == {r[0] for r in docs.select("doc_id").collect()}


def test_centroid_graph_finds_all_lists_within_the_ratio():
    rng = np.random.default_rng(7)
    for x in (rng.normal(size=(4_000, 16)), np.repeat(rng.normal(size=(80, 16)), 50, axis=0) + 0.05 * rng.normal(size=(4_000, 16))):
        centroids = nearest.balanced_centroids(x, 200)
        graph = nearest.CentroidGraph(centroids)
        wanted = got = 0
        for q in x[::40]:
            away = np.sqrt(((centroids - q) ** 2).sum(axis=1))
            within = set(np.flatnonzero(away <= away.min() * 1.3).tolist())
            found = set(graph.search(q, 1.3).tolist())
            assert found <= within
            wanted, got = wanted + len(within), got + len(found)
        assert got >= 0.98 * wanted


def test_nearest_compares_with_opened_lists_only(spark):
    x = np.random.default_rng(8).normal(size=(20_000, 32))
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id bigint, embedding array<double>")
    got = nearest.nearest(rows, every=200, recall=0.95).collect()
    compared = {r["query_id"]: r["compared"] for r in got}
    assert len(compared) == 100 and np.mean(list(compared.values())) < 0.7 * len(x)
    hits = 0
    for q in compared:
        scores = x @ x[q]
        scores[q] = -np.inf
        hits += len(set(np.argpartition(-scores, 20)[:20].tolist()) & {r["vec_id"] for r in got if r["query_id"] == q})
    assert hits >= 0.9 * 20 * len(compared)


def test_toxicity_examples_that_do_not_fit_are_passed_over(spark):
    rows = [(i, f"{PROSE[i % 50 : 400]} {'you awful scum' if i % 4 == 0 else 'fine day to all'}") for i in range(200)]
    taken = [i for i in range(200) if zlib.crc32(str(i).encode()) % 5]
    rows += [(taken[3], "x" * 1_000_000)]  # the smaller of two texts with one id is the example
    long_one = (500, "long " * 50_000)
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(200)] + [(500, 1)], "doc_id bigint, toxic int")
    docs = spark.createDataFrame([*rows, long_one], "doc_id bigint, text string")
    for given in (docs, spark.createDataFrame([long_one, *rows[::-1]], "doc_id bigint, text string")):
        got = toxicity.score_toxicity(given, labels, example_chars=200_000).filter("doc_id < 200").collect()
        alike = {(r["doc_id"], r["predicted"]) for r in got if r["doc_id"] != taken[3]}
        assert alike == {(i, int(i % 4 == 0)) for i in range(200) if i != taken[3]}
