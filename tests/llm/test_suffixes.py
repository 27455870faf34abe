from __future__ import annotations

import random

import numpy as np
import pytest

from burstline.llm import suffixes


def brute(rows, least=100):
    """Every window looked up among all windows."""
    texts = [(i if i is not None else -(2**63), (t or "").encode()) for i, t in rows]
    first = {}
    for i, t in texts:
        for k in range(len(t) - least + 1):
            first[t[k : k + least]] = min(first.get(t[k : k + least], (i, k)), (i, k))
    out = []
    for (doc_id, _), (i, t) in zip(rows, texts):
        gone = np.zeros(len(t), bool)
        for k in range(len(t) - least + 1):
            if first[t[k : k + least]] != (i, k):
                gone[k : k + least] = True
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        kept = bytes(np.frombuffer(t, np.uint8)[~gone])
        out.append((doc_id, len(t), int(gone.sum()), spans, kept))
    return sorted(out, key=str)


def prose(rng, n):
    return " ".join("".join(rng.choices("abcdeé", k=rng.randrange(1, 9))) for _ in range(n))


def planted():
    rng, rows = random.Random(9), []
    passages = [prose(rng, n) for n in (18, 25, 40, 60, 120)]
    for k in range(150):
        parts = [prose(rng, rng.randrange(0, 60))]
        for _ in range(rng.randrange(3)):
            passage = rng.choice(passages)
            cut = rng.randrange(len(passage) // 2)
            parts += [passage[cut:], prose(rng, rng.randrange(0, 20))]
        rows.append((1000 - k, rng.choice([" ", "", "\n"]).join(parts)))
    base = prose(rng, 150)
    for k in range(25):
        edit = list(base)
        for _ in range(rng.randrange(4)):
            edit[rng.randrange(len(edit))] = rng.choice("xyz")
        rows.append((2000 + k, "".join(edit)))
    rows += [(3000 + k, base) for k in range(4)] + [(3001, base)]
    rows += [(4000, None), (4001, ""), (4002, "a" * 99), (4003, "a" * 100), (4004, "a" * 450)]
    rows += [(4005, "ab" * 300), (4006, "é" * 200), (None, passages[4] + "end"), (4007, base[50:] + base[:160])]
    return rows


@pytest.mark.parametrize("small", [False, True])
def test_equals_brute_force(spark, monkeypatch, small):
    if small:  # many chunks, flushes, shards and hot anchors
        for name, value in {
            "CHUNK": 150,
            "FLUSH": 40,
            "BYTES_PER_SHARD": 20_000,
            "SEGMENTS_PER_BIN": 20,
            "SEGMENTS_PER_SHARD": 8,
            "HOT": 2,
        }.items():
            monkeypatch.setattr(suffixes, name, value)
    rows = planted()
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    frame = frame.withColumn("kept", frame.doc_id).withColumn("print", frame.text)
    out = suffixes.remove_repeats(frame)
    assert out.columns == ["doc_id", "text", "print", "n_bytes", "n_removed", "n_spans", "kept"]
    got = out.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept").collect()
    assert sorted(((*r[:4], bytes(r[4])) for r in got), key=str) == brute(rows)


def test_empty_table(spark):
    frame = spark.createDataFrame([], "doc_id long, text string")
    assert suffixes.remove_repeats(frame).count() == 0


def test_given_documents(spark, tables):
    frame = spark.read.parquet(f"{tables}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in frame.collect()]
    got = suffixes.remove_repeats(frame).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept")
    assert sorted(((*r[:4], bytes(r[4])) for r in got.collect()), key=str) == brute(rows)


@pytest.mark.parametrize("least", [100, 45])
def test_merge_tells_equal_strings_apart(least):
    rng = random.Random(least)
    texts = ["".join(rng.choices("ab", weights=[9, 1], k=n)).encode() for n in (400, 90, 700)]
    numbers = suffixes.merge([suffixes.Transform(t) for t in texts], least)
    seen = {}
    for text, own in zip(texts, numbers):
        circle = text * (2 + least // len(text))
        for k, number in enumerate(own.tolist()):
            assert seen.setdefault(number, circle[k : k + least]) == circle[k : k + least]
    assert len(seen) == len(set(seen.values()))


def test_sorted_transform():
    text = b"mississippi and missouri, " * 3 + b"end"
    found = suffixes.Transform(text)
    circle = text * 12
    rotations = [circle[k : k + 128] for k in found.suffixes.tolist()]
    assert rotations == sorted(rotations)
    assert found.steps(1).tolist() == [found.ranks[(k - 1) % len(text)] for k in found.suffixes]


def test_equal_windows_have_equal_anchors():
    rng = random.Random(4)
    common = prose(rng, 60).encode()
    a = np.frombuffer(prose(rng, 30).encode() + common + prose(rng, 9).encode(), np.uint8)
    b = np.frombuffer(common + prose(rng, 30).encode(), np.uint8)
    at = []
    for data in (a, b):
        anchor, first, windows = suffixes.segments(data)
        by_window = np.repeat(anchor, windows)
        assert len(by_window) == len(data) - 99
        at.append({bytes(data[k : k + 100]): int(x) for k, x in enumerate(by_window)})
    both = set(at[0]) & set(at[1])
    assert len(both) == len(common) - 99 and all(at[0][w] == at[1][w] for w in both)


def test_helper_columns_do_not_clash(spark):
    passage = " ".join(map(str, range(60)))
    rows = [(1, passage), (2, passage + "x"), (3, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").selectExpr(
        "*", "1 AS _id", "2 AS _print", "3 AS _gone", "4 AS _RESULT", "5 AS _result_", "6 AS stop"
    )
    out = suffixes.remove_repeats(frame)
    new = ["n_bytes", "n_removed", "n_spans", "kept"]
    assert out.columns == [*frame.columns, *new]
    for row in out.collect():
        assert tuple(row)[2:8] == (1, 2, 3, 4, 5, 6)
        assert row.n_removed == (len(passage) if row.doc_id == 2 else 0)


def test_what_goes_to_shards_does_not_depend_on_their_number():
    rng = np.random.default_rng(3)
    texts = [rng.integers(97, 100, 400).astype(np.uint8).tobytes() for _ in range(60)]
    texts += texts[:20]
    for shards in (1, 7, 5_000_000):
        gathered = suffixes._Gathered(shards, 100)
        for k, text in enumerate(texts):
            gathered.add(k, hash(text), text)
        rows = [r for batch in gathered.rows() for r in batch.to_pylist()]
        assert len({r["shard"] for r in rows}) == len(rows)
        told = set()
        for row in rows:
            of = {k: np.frombuffer(row[k], kind) for k, kind in suffixes._ARRAYS.items()}
            told |= {
                (of["ids"][d], a, c, s)
                for d, a, c, s in zip(of["doc"], of["anchor"], of["content"], of["start"])
            }
            assert len(set(of["ids"])) == len(of["ids"])
            assert set(of["gone_doc"]) | set(of["doc"]) == set(range(len(of["ids"])))
        if shards == 1:
            expected = told
        assert told == expected


def continued(documents):
    """One passage in many documents, each of which continues otherwise, and some of them alike."""
    rng = random.Random(documents)
    passage, tails = prose(rng, 40), [prose(rng, 30) for _ in range(7)]
    rows = []
    for k in range(documents):
        tail = rng.choice(tails) if k % 5 == 0 else prose(rng, 20)
        rows.append((k, prose(rng, 3) + passage + rng.choice(["", " ", "-"]) + tail))
    return rows


def test_an_anchor_of_many_documents_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "SEGMENTS_PER_BIN", 30)
    rows = continued(150)
    out = suffixes.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    got = out.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept").collect()
    assert sorted(((*r[:4], bytes(r[4])) for r in got), key=str) == brute(rows)


def test_segments_of_one_anchor_are_not_compared_pair_by_pair(spark, monkeypatch):
    compared = {}
    for documents in (100, 400):
        monkeypatch.setattr(suffixes, "SEGMENTS_PER_BIN", 20)
        monkeypatch.setattr(suffixes, "SEGMENTS_PER_SHARD", 20)
        frame = spark.createDataFrame(continued(documents), "doc_id long, text string").coalesce(2)
        held = spark.sparkContext.accumulator(0)
        group = type(frame.groupBy("doc_id"))
        before = group.applyInArrow

        def counted(self, run, schema, before=before, held=held):
            def told(table):
                if "piece" in table.column_names:
                    held.add(table.num_rows)
                return run(table)

            return before(self, told, schema)

        monkeypatch.setattr(group, "applyInArrow", counted)
        suffixes.remove_repeats(frame).write.format("noop").mode("overwrite").save()
        monkeypatch.undo()
        compared[documents] = held.value
    assert compared[400] < 6 * compared[100] and compared[400] < 2000


def test_parted_pieces_are_parted_each_by_itself():
    rng = random.Random(5)
    pieces = [prose(rng, 60).encode() for _ in range(20)]
    for width in (32, 83, 96, 100):
        found = [x.tolist() for x in suffixes.parted(pieces, 100, width)]
        alone = [suffixes.parted([p], 100, width) for p in pieces]
        owners = [k for k, x in enumerate(alone) for _ in x[0]]
        assert found == [owners, *(np.concatenate(x).tolist() for x in list(zip(*alone))[1:])]
        if width == suffixes.ANCHOR:
            data = [np.frombuffer(p, np.uint8) for p in pieces]
            assert found[1] == np.concatenate([suffixes.segments(d)[0] for d in data]).tolist()
        if width == 100:
            assert set(found[3]) == {1} and len(found[0]) == sum(len(p) - 99 for p in pieces)
