from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from burstline.llm import packing
from burstline.llm.packing import Limits, Packer
from burstline.llm.queries import CONVERSATION_LIMITS, op1_packing, pack_conversations, tokenizer
from burstline.llm.units import UnitIds

PATH = tokenizer("byte_bpe_50k.json")


def plain():
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(PATH)
    return lambda text: found.encode(text, add_special_tokens=False).ids


TEXTS = [
    "",
    " ",
    "a",
    "it's we'll don't 'tis x'",
    "two  spaces\n\n\tand tabs ",
    "é ² ½ 中文 😀 x́y",
    "\x1c\x1dodd\x85 space ",
    "<|endoftext|>",
    "y" * 3000 + " z",
    "a.b,c! d; (e) [f]|g 3,14 1e5",
]


UNITS = UnitIds(PATH)


@pytest.mark.parametrize("text", TEXTS)
def test_ids_equal_the_tokenizer(text):
    assert UNITS.encode(pa.array([text]))[0].tolist() == plain()(text)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("ab' \n\t.,²é中1\x1c_́"), max_size=40), max_size=4))
def test_ids_of_any_text(texts):
    own = plain()
    found = UNITS.encode(pa.array(texts, pa.string()))
    assert [x.tolist() for x in found] == [own(t) for t in texts]


@settings(max_examples=200, deadline=None)
@given(
    st.lists(st.tuples(st.integers(0, 60), st.integers(0, 60)), max_size=80),
    st.integers(1, 6),
    st.integers(1, 30),
)
def test_whole_examples_keep_all_limits(items, segments, pool):
    limits = Limits(50, segments, 40)
    packer = Packer(limits, pool)
    bins = [b for k, (n, loss) in enumerate(items) for b in packer.add(k, n, loss)]
    bins += list(packer.rest())
    assert sorted(key for b in bins for key, _ in b) == list(range(len(items)))
    for b in bins:
        tokens, loss = (sum(items[k][d] for k, _ in b) for d in (0, 1))
        fits = tokens <= 50 and len(b) <= segments and loss <= 40
        assert fits or len(b) == 1


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=80), st.integers(1, 8), st.integers(1, 30))
def test_cut_examples_lose_no_token(items, segments, pool):
    limits = Limits(50, segments, 50)
    packer = Packer(limits, pool, cut=True)
    bins = [b for k, n in enumerate(items) for b in packer.add((k, 0), n, n - 1)]
    bins += list(packer.rest())
    pieces = defaultdict(list)
    for b in bins:
        assert sum(n for _, n in b) <= 50 and len(b) <= segments
        for (k, before), n in b:
            pieces[k].append((before, n))
    for k, n in enumerate(items):
        at = 0
        for before, size in sorted(pieces[k]):
            assert before == at and size > 0
            at += size
        assert at == n


def test_scarce_limits_lead():
    """With segments scarce the large example goes first, with loss scarce the one without."""
    packer = Packer(Limits(100, 2, 100), pool=3)
    bins = [b for k, n in enumerate([10, 60, 40]) for b in packer.add(k, n, 0)]
    assert [k for k, _ in bins[0]] == [1, 2]
    packer = Packer(Limits(100, 10, 10), pool=9)
    for k, loss in enumerate([10, 0, 0, 10]):
        list(packer.add(k, 30, loss))
    first = next(packer.rest())
    assert sum(k in (0, 3) for k, _ in first) == 1 and {1, 2} <= {k for k, _ in first}


def check(rows, texts):
    own, sequences, pieces = plain(), defaultdict(list), defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append(r)
        pieces[r.doc_id].append(r)
    assert set(pieces) == set(texts)
    for doc_id, text in texts.items():
        ids, at = [*own(text or ""), 0], 0
        for r in sorted(pieces[doc_id], key=lambda r: r.start):
            assert r.start == at and r.length > 0 and r.doc_tokens == len(ids)
            part = np.array(ids[at : at + r.length], "<u4").tobytes()
            assert zlib.crc32(part) == r.ids_crc32
            at += r.length
        assert at == len(ids)
    for own_rows in sequences.values():
        at = 0
        for r in sorted(own_rows, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 1024 and all(r.sequence_tokens == at for r in own_rows)
    return sequences


def test_query(spark, tables):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{tables}/documents.parquet").collect()}
    sequences = check(op1_packing(spark, tables).collect(), texts)
    filled = sum(r.length for rows in sequences.values() for r in rows)
    assert filled > 0.99 * 1024 * (len(sequences) - 1)


def test_rows(spark):
    rows = [(1, None), (2, ""), (3, "x " * 5000), (4, "short"), (None, "no id")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    frame = frame.withColumn("start", frame.text)
    out = packing.pack_documents(frame, PATH)
    check(out.collect(), dict(rows))
    assert packing.pack_documents(frame.limit(0), PATH).count() == 0
    twice = packing.pack_documents(frame.union(frame), PATH).collect()
    assert sum(r.length for r in twice) == 2 * sum(r.length for r in out.collect())


def test_examples(spark):
    rows = [("a", 30, 10), ("b", None, 5), ("c", 5000, 1), ("a", 30, 10), (None, 1, None)]
    frame = spark.createDataFrame(rows, "id string, tokens int, loss_tokens int").coalesce(1)
    out = packing.pack_examples(frame, Limits(100, 3, 20)).collect()
    assert sorted((str(r.id), r.tokens) for r in out) == sorted((str(i), n or 0) for i, n, _ in rows)
    assert [r.id for r in out if r.oversized] == ["c"]
    assert packing.pack_examples(frame.limit(0)).count() == 0


def test_conversations(spark, tables):
    turns = spark.read.parquet(f"{tables}/conversations.parquet")
    examples = {r.conv_id: r for r in packing.conversation_examples(turns, PATH).collect()}
    own, tokens, loss = plain(), defaultdict(int), defaultdict(int)
    for r in turns.collect():
        n = len(own(r.text or "")) + 1
        tokens[r.conv_id] += n
        loss[r.conv_id] += n if r.role == "assistant" else 0
    assert {k: (r.tokens, r.loss_tokens) for k, r in examples.items()} == {
        k: (tokens[k], loss[k]) for k in tokens
    }


def test_conversations_keep_three_limits(spark, tables):
    own, expected = plain(), defaultdict(lambda: [0, 0])
    for row in spark.read.parquet(f"{tables}/conversations.parquet").collect():
        n = len(own(row.text or "")) + 1
        expected[row.conv_id][0] += n
        expected[row.conv_id][1] += n * (row.role == "assistant")
    sequences = defaultdict(list)
    found = pack_conversations(spark, tables).collect()
    assert {r.conv_id: [r.tokens, r.loss_tokens] for r in found} == expected
    assert len(found) == len(expected)
    for row in found:
        sequences[row.sequence_id].append(row)
    limits, full = CONVERSATION_LIMITS, set()
    for rows in sequences.values():
        at = 0
        for row in sorted(rows, key=lambda r: r.offset):
            assert row.offset == at
            at += row.tokens
        sums = (at, len(rows), sum(r.loss_tokens for r in rows))
        most = (limits.tokens, limits.segments, limits.loss_tokens)
        fits = all(a <= b for a, b in zip(sums, most))
        assert fits != rows[0].oversized and (fits or len(rows) == 1)
        # What is so full that no conversation of middling size fits.
        full |= {k for k in range(3) if sums[k] > most[k] - (900, 1, 450)[k]}
    assert full == {0, 1, 2}
