"""Files of coded token ids: exact round trips, damage, order of documents."""

import io
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from burstline.llm import mixing, token_files
from burstline.llm.queries import op12_token_files, tokenizer
from burstline.llm.storage import Scratch
from burstline.llm.token_files import read_chunks, read_files, round_trip, write_chunk, write_files
from burstline.llm.units import UnitIds, unit_starts

WORDS, BYTES = tokenizer("word_bpe_49k.json"), tokenizer("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string"


def plain_rows(rows, path=WORDS, end=2):
    """Documents by rising id, encoded one by one."""
    library, start, found = Tokenizer.from_file(path), 0, []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = library.encode(text or "", add_special_tokens=False).ids + [end]
        found.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return found


@pytest.mark.parametrize("path", [WORDS, BYTES])
def test_units_give_the_ids_of_the_library(path):
    rng = random.Random(3)
    letters = list("abAB'stre 1 2 .,!- \n\t \r\x0b") + [
        "é", "ß", "×", "́", "̊", "̇", "İ", "中", " ", " ", "　", "'s", "'ll", " the",
        "<|endoftext|>", "<|startoftext|>", "W", "\x1c", "̸", "=", "²", "🙂", "x" * 30, "\x00",
    ]
    texts = ["".join(rng.choices(letters, k=rng.randrange(25))) for _ in range(5000)]
    texts += ["", None, "word " * 5000, "y" * 100_000, " " * 70_000, "z\n" * 50_000]
    units = UnitIds(path, slots=256)  # a small table: units push each other out
    library = Tokenizer.from_file(path)
    expected = library.encode_batch([x or "" for x in texts], add_special_tokens=False)
    for _ in range(2):
        found = units.encode(pa.array(texts))
        assert [x.tolist() for x in found] == [x.ids for x in expected]
    sliced = units.encode(pa.array(texts).slice(7, 50))
    assert [x.tolist() for x in sliced] == [x.ids for x in expected[7:57]]


def test_long_texts_are_cut_before_white_space(monkeypatch):
    monkeypatch.setattr("burstline.llm.units._CHUNK", 64)
    text = "It's a  long\n\n text, of 12 words or so.  " * 40 + "end"
    library = Tokenizer.from_file(BYTES)
    found = UnitIds(BYTES).encode(pa.array([text, "a", text]))
    expected = library.encode_batch([text, "a", text], add_special_tokens=False)
    assert [x.tolist() for x in found] == [x.ids for x in expected]


def test_units_cover_a_text():
    data = np.frombuffer("Ab  c\n\nd 12x.".encode(), np.uint8)
    starts, _ = unit_starts(data, np.array([0, len(data)]))
    cut = [bytes(x).decode() for x in np.split(data, starts[1:])]
    assert cut == ["Ab", " ", " c", "\n", "\n", "d", " 12", "x", "."]


def test_other_tokenizers_are_refused(tmp_path):
    from tokenizers import models

    merges = [("A", " "), ("A ", "b")]
    other = Tokenizer(models.BPE({"A": 0, "b": 1, " ": 2, "A ": 3, "A b": 4}, merges))
    other.save(str(tmp_path / "other.json"))
    with pytest.raises(ValueError, match="cuts texts"):
        UnitIds(str(tmp_path / "other.json"))


@pytest.mark.parametrize("length", [1, 2, 300])
@pytest.mark.parametrize("kind", ["one", "skewed", "wide", "repeated", "largest"])
def test_coder_round_trip(length, kind):
    rng = np.random.default_rng(length)
    shape = (7, length)
    ranks = {
        "one": np.ones(shape, np.int64),
        "skewed": np.minimum(rng.zipf(1.3, shape), 65535),
        "wide": rng.integers(1, 65536, shape),
        "repeated": np.resize(rng.integers(1, 5000, 9), shape),
        "largest": np.full(shape, 65535),
    }[kind].astype(np.uint16)
    coded = mixing.encode(ranks)
    assert np.array_equal(mixing.decode(coded, length), ranks)
    # Blocks do not depend on each other.
    assert mixing.encode(ranks[3:4]) == coded[3:4]
    assert np.array_equal(mixing.decode(coded[5:6], length), ranks[5:6])


def test_carries_go_through_full_words():
    words = np.array([5, 2**32 - 1, 2**32 - 1, 7], np.uint32)
    mixing._carry(words, np.array([2]))
    assert words.tolist() == [6, 0, 0, 7]


def test_mixing_learns():
    rng = np.random.default_rng(1)
    passage = rng.integers(1, 40_000, 64)
    repeated = np.tile(passage, 64).astype(np.uint16)[None]
    fresh = rng.integers(1, 40_000, 4096).astype(np.uint16)[None]
    skewed = np.minimum(rng.geometric(0.1, 4096), 65535).astype(np.uint16)[None]
    bits = [8 * len(mixing.encode(x)[0]) / 4096 for x in (repeated, fresh, skewed)]
    assert bits[0] < 1.5 and bits[1] < 17.5 and bits[2] < 5.5


def file_of(ids, pieces):
    sink = io.BytesIO()
    writer = token_files._Writer(sink)
    for document, n in pieces:
        writer.add(document, ids[:n])
        ids = ids[n:]
    writer.close()
    return sink.getvalue()


def test_chunks_and_damage(monkeypatch):
    monkeypatch.setattr(token_files, "CHUNK_IDS", 1000)
    rng = np.random.default_rng(2)
    ids = np.minimum(rng.zipf(1.2, 5000), 49_000).astype(np.uint32)
    data = file_of(ids, [(4, 1), (None, 1999), (6, 0), (7, 3000)])
    chunks = list(read_chunks(io.BytesIO(data)))
    assert [len(x) for x, _ in chunks] == [1000] * 5
    assert np.array_equal(np.concatenate([x for x, _ in chunks]), ids)
    assert [p for _, ps in chunks for p in ps if p[0] == 7] == [(7, 1000, False)] * 2 + [
        (7, 1000, True)
    ]
    for k in rng.integers(0, len(data), 40).tolist():
        broken = bytearray(data)
        broken[k] ^= 1 << int(rng.integers(8))
        with pytest.raises((ValueError, zlib.error)):
            list(read_chunks(io.BytesIO(bytes(broken))))
    for k in (0, 5, 100, len(data) // 2, len(data) - 1):
        with pytest.raises(ValueError):
            list(read_chunks(io.BytesIO(data[:k])))


def test_more_kinds_of_ids_than_ranks():
    ids = np.arange(150_000, dtype=np.uint32)
    data = b"".join([token_files.MAGIC, *write_chunk(ids, [(1, 90_000, True), (2, 60_000, True)])])
    data += token_files.DONE + token_files.struct.pack("<QQ", 2, 150_000)
    chunks = list(read_chunks(io.BytesIO(data)))
    assert len(chunks) > 2 and np.array_equal(np.concatenate([x for x, _ in chunks]), ids)


def test_odd_rows(spark):
    rows = [
        (5, "b c"), (None, "no id"), (3, None), (-7, ""), (5, "b c"), (5, "other"), (None, None),
        (9, "long " * 60_000), (10, "\n \t"), (11, "a <|endoftext|> b"),
    ]
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr(
        "*", "'x' AS start", "1 AS ids", "2 AS number", "3 AS file"
    )
    found = round_trip(frame.repartition(3), WORDS).collect()
    assert sorted(map(tuple, found), key=lambda r: r[1]) != []
    expected = plain_rows(rows)
    # Rows that share an id come in an order of their own; each has its place in the row of ids.
    def shape(rows):
        return sorted((r[0] is not None, r[0] or 0, r[2], r[3]) for r in rows)

    assert shape(found) == shape(expected)
    at = 0
    for row in sorted(found, key=lambda r: r.start):
        assert row.start == at
        at += row.n_tokens
    in_order = [r.doc_id for r in sorted(found, key=lambda r: r.start)]
    assert in_order == [r[0] for r in expected]


def test_empty_table(spark):
    assert round_trip(spark.createDataFrame([], SCHEMA), WORDS).collect() == []


def test_files_hold_the_ids(spark):
    rows = [(k, f"Some words, number {k}. " * (k % 17)) for k in range(300)]
    scratch = Scratch(spark, "test-token-files")
    files = write_files(spark.createDataFrame(rows, SCHEMA), BYTES, scratch, 0, 4000)
    listed = files.orderBy("number").collect()
    assert len(listed) > 5 and sum(r.n_documents for r in listed) == 300
    library = Tokenizer.from_file(BYTES)
    for row in read_files(files, scratch.path("ids"), with_ids=True).collect():
        expected = library.encode(rows[row.doc_id][1], add_special_tokens=False).ids + [0]
        assert row.ids == expected and row.n_tokens == len(expected)


def test_query_equals_plain_encoding(spark, tables):
    rows = [tuple(r) for r in spark.read.parquet(f"{tables}/documents.parquet").select("doc_id", "text").collect()]
    found = op12_token_files(spark, tables)
    assert found.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert sorted(map(tuple, found.collect())) == plain_rows(rows)
