"""The pipeline's stages against plain versions of what they do, each on its own input, and ``run`` against the stages in turn."""

from __future__ import annotations

import collections
import itertools
import re

import pytest

from ledger_spark.llm.common import read_table, stage

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def tables(spark, small_folder):
    """(name, rows) of the input and of every stage but the last."""
    import corpus_pipeline

    docs = read_table(spark, small_folder, "documents")
    out = [("input", docs)]
    for name, function in corpus_pipeline.STAGES[:-1]:
        docs = stage(function(spark, docs, small_folder), "stage")
        out.append((name, docs))
    return [(name, {r["doc_id"]: r["text"] for r in d.collect()}, d) for name, d in out]


def sets_of(text, size):
    words = WORD.findall("".join(c.lower() if c.isascii() else c for c in text))
    return {tuple(words)} if 0 < len(words) < size else {tuple(words[k : k + size]) for k in range(len(words) - size + 1)}


def test_stages_keep_the_columns(tables):
    assert len({tuple(d.columns) for _, _, d in tables}) == 1
    assert all(r["n_chars"] == len(r["text"]) for r in tables[-1][2].collect())


def test_lines_that_repeat_an_earlier_one_go(tables):
    before, after = tables[1][1], tables[2][1]
    lines = {(i, k): frozenset(WORD.findall(line.lower())) for i, t in before.items() for k, line in enumerate(t.split("\n"))}
    holders = collections.defaultdict(list)
    gone = set()
    for place in sorted(lines):
        mine = lines[place]
        candidates = {other for word in mine for other in holders[word]}
        if any(100 * len(mine & lines[o]) >= 80 * len(mine | lines[o]) for o in candidates):
            gone.add(place)
        for word in mine:
            holders[word].append(place)
    left = {i: "\n".join(line for k, line in enumerate(t.split("\n")) if (i, k) not in gone) for i, t in before.items()}
    assert after == {i: t for i, t in left.items() if len(WORD.findall(t)) >= 10}
    assert gone and len(after) < len(before)


def test_one_of_each_group_of_near_copies_stays(tables):
    before, after = tables[2][1], tables[3][1]
    shingles = {i: sets_of(t, 5) for i, t in before.items()}
    name = {i: i for i in before}
    links = [(a, b) for a, b in itertools.combinations(before, 2) if 100 * len(shingles[a] & shingles[b]) >= 80 * len(shingles[a] | shingles[b])]
    for _ in before:
        for a, b in links:
            name[a] = name[b] = min(name[a], name[b])
    assert set(after) == {i for i in before if name[i] == i}


def test_passages_that_recur_go(tables):
    import corpus_pipeline

    before, after, length = tables[3][1], tables[4][1], corpus_pipeline.PASSAGE_BYTES
    data = {i: t.encode() for i, t in before.items()}
    seen = collections.Counter(b[j : j + length] for b in data.values() for j in range(len(b) - length + 1))
    expected = {}
    for i, b in data.items():
        cut = bytearray(len(b))
        for j in range(len(b) - length + 1):
            if seen[b[j : j + length]] > 1:
                cut[j : j + length] = b"\1" * length
        kept = bytes(c for c, gone in zip(b, cut, strict=True) if not gone).decode(errors="ignore")
        if 2 * len(kept.encode()) >= len(b) and len(WORD.findall(kept)) >= corpus_pipeline.LEAST_WORDS:
            expected[i] = kept
    assert after == expected


def test_documents_that_repeat_each_other_leave(spark, small_folder):
    """A passage of fifty words in two documents of their own goes from both; a document that was little else goes as a whole."""
    import corpus_pipeline

    passage = " ".join(f"word{i * 37 % 101}" for i in range(55))
    own = [" ".join(f"own{d}x{i}" for i in range(80)) for d in range(3)]
    rows = [(1, f"{own[0]}\n{passage} {own[1][:200]}"), (2, f"{own[2]}\nother begin {passage}"), (3, f"a few words {passage} of mine")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    left = {r["doc_id"]: r["text"] for r in corpus_pipeline.passages(spark, docs, small_folder).collect()}
    assert set(left) == {1, 2} and all("word37 word74" not in t for t in left.values())


def test_run_is_the_stages_in_turn(spark, small_folder, tables):
    import corpus_pipeline

    last = corpus_pipeline.STAGES[-1][1](spark, tables[-1][2], small_folder)
    assert sorted(map(tuple, corpus_pipeline.run(spark, small_folder).collect())) == sorted(map(tuple, last.collect()))
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality rules", "line dedup", "near dedup", "suffix-array dedup", "packing"]
