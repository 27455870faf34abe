from __future__ import annotations

import numpy as np
import pytest

from burstline.llm import lines
from burstline.llm.lines import PerfectHash, Shard, dedup_lines

LONG = "A line of more than forty characters, é and so on."


def brute(rows, least_docs, least_chars):
    strip = " \t\n\x0b\x0c\r"
    lower = lambda s: "".join(c.lower() if "A" <= c <= "Z" else c for c in s)
    keys = [[lower(x.strip(strip)) for x in (t or "").split("\n")] for _, t in rows]
    smallest = -(2**63)
    owners, counts = {}, {}
    for (doc_id, _), own in zip(rows, keys):
        for key in set(own):
            counts[key] = counts.get(key, 0) + 1
            owners[key] = max(owners.get(key, smallest), smallest if doc_id is None else doc_id)
    out = []
    for (doc_id, text), own in zip(rows, keys):
        me = smallest if doc_id is None else doc_id
        gone = [
            len(k) >= least_chars and counts[k] >= least_docs and owners[k] != me for k in own
        ]
        kept = "\n".join(x for x, g in zip((text or "").split("\n"), gone) if not g)
        out.append((doc_id, kept, len(own), sum(gone)))
    return sorted(out, key=str)


ROWS = [
    *[(k, f"{LONG}\nown {k}\n\t {LONG.upper()} \r") for k in range(8)],
    (20, LONG.replace("é", "É")),
    (21, None),
    (22, ""),
    (23, "\n\n"),
    (24, LONG + "\n" + LONG),
    (24, LONG),
    (None, LONG + "\nnull"),
    (25, "x" * 5000 + "\n" + LONG.swapcase().replace("É", "é")),
    (26, "é" * 39),
    (27, "é" * 40),
    *[(30 + k, "é" * 39 + "\n" + "é" * 40) for k in range(6)],
]


@pytest.mark.parametrize("limit", [32 << 20, 0])
def test_equals_brute_force_by_either_way(spark, limit):
    frame = spark.createDataFrame(ROWS, "doc_id long, text string")
    out = dedup_lines(frame, broadcast_bytes=limit)
    assert out.columns == ["doc_id", "text", "n_lines", "n_dropped"]
    got = sorted(map(tuple, out.collect()), key=str)
    assert got == brute(ROWS, 5, 40)


@pytest.mark.parametrize("limit", [32 << 20, 0])
def test_given_documents(spark, tables, limit):
    frame = spark.read.parquet(f"{tables}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in frame.select("doc_id", "text").collect()]
    out = dedup_lines(frame, min_documents=3, broadcast_bytes=limit)
    got = sorted(map(tuple, out.select("doc_id", "text", "n_lines", "n_dropped").collect()), key=str)
    assert got == brute(rows, 3, 40)


def test_empty_table_and_clashing_columns(spark):
    frame = spark.createDataFrame([], "doc_id long, text string, n_lines string, shard int")
    out = dedup_lines(frame)
    assert out.columns == ["doc_id", "text", "shard", "n_lines", "n_dropped"] and out.count() == 0


def test_perfect_hash_numbers_without_gaps():
    rng = np.random.default_rng(1)
    high, low = rng.integers(0, 2**64, (2, 5000), dtype=np.uint64)
    high[:1000] = 7  # same upper half
    found = PerfectHash.of(high, low)
    assert sorted(found.numbers(high, low).tolist()) == list(range(5000))
    assert sum(len(x) for x in found.levels) * 64 < 5 * 5000


@pytest.mark.parametrize("limit", [32 << 20, 0])
def test_hidden_columns_long_texts_and_rows_without_id(spark, limit):
    long = "\n".join(f"{k % 7000:060d}" for k in range(60_000))  # 3.6 MB, each line many times
    rows = [(1, long), (2, long), (None, long), (None, LONG), (None, LONG + "\nx"), (3, LONG)]
    rows += [(None, LONG)] * 3 + [(4, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").selectExpr(
        "*", "1 AS _kept", "2 AS _id", "3 AS _lost", "4 AS _PRINT", "5 AS print", "6 AS high"
    )
    out = dedup_lines(frame, min_documents=3, broadcast_bytes=limit)
    assert out.columns == [*frame.columns, "n_lines", "n_dropped"]
    got = out.collect()
    assert {tuple(r)[2:8] for r in got} == {(1, 2, 3, 4, 5, 6)}
    found = [(r.doc_id, r.text, r.n_lines, r.n_dropped) for r in got]
    assert sorted(found, key=str) == brute(rows, 3, 40)


@pytest.mark.parametrize("least", [1, 2, 255, 256, 70_000])
def test_counts_as_wide_as_the_threshold(least):
    rng = np.random.default_rng(2)
    high, low = rng.integers(0, 2**64, (2, 300), dtype=np.uint64)
    counts = rng.integers(1, 2 * least + 2, 300)
    owners = rng.integers(-(2**62), 2**62, 300)
    shard = Shard(Shard.built(0, high, low, counts, owners, least), least)
    order = rng.permutation(300)
    repeated, kept_by = shard.owner_of(high[order], low[order])
    assert np.array_equal(repeated, counts[order] >= least)
    assert np.array_equal(kept_by[repeated], owners[order][repeated])
    assert shard.counts.itemsize == (1 if least < 256 else 2 if least < 65536 else 4)
    with pytest.raises(ValueError, match="not in the index"):
        shard.owner_of(high + np.uint64(1), low)


def test_all_lines_are_indexed(spark, monkeypatch):
    built, shards = [], lines._shards

    def watched(*given):
        built.extend(shards(*given).collect())
        return shards(*given)

    monkeypatch.setattr(lines, "_shards", watched)
    monkeypatch.setattr(lines, "KEYS_PER_SHARD", 4)
    frame = spark.createDataFrame(ROWS, "doc_id long, text string")
    got = sorted(map(tuple, dedup_lines(frame, min_chars=1).collect()), key=str)
    assert got == brute(ROWS, 5, 1)
    indexed = [Shard(r.asDict(), 5) for r in built]
    keys = {k.strip().lower() for _, t in ROWS for k in (t or "").encode().split(b"\n")} - {b""}
    assert sum(len(s.counts) for s in indexed) == len(keys) and len(indexed) > 1
