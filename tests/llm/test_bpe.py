import random
from pathlib import Path

import pyarrow as pa
import pytest

from siftlane.llm import bpe

JSON = Path("/opt/tokenizers/byte_bpe_50k.json")
pytestmark = pytest.mark.skipif(not Path(bpe.DEFAULT_RANKS).exists(), reason="no vocabulary here")
ODD = ["", " ", "  ", "a", " a", "a ", "a  b", "\n\n a", "a \n b", "  b", "don't WON'T we'll", "<|endoftext|>", "漢字かな", "👩‍👩‍👧", "é", "x" * 3000, " " * 500 + "x", "1234567 8", "\x00\x1c\x1d\x85 ", "﻿a", "a\r\nb\tc", "ı İ ß"]


@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder(bpe.model_from_ranks(Path(bpe.DEFAULT_RANKS).read_bytes()))


def split(encoder, texts):
    ids, at = encoder.arrays(pa.array(texts, pa.string()))
    return [ids[a:b].tolist() for a, b in zip(at, at[1:])]


def test_equals_public_library(encoder):
    tokenizers = pytest.importorskip("tokenizers")
    reference = tokenizers.Tokenizer.from_file(str(JSON))
    reference.encode_special_tokens = True
    rng = random.Random(3)
    alphabet = " \n\t 　abcABé'.,1９漢👍́\x1c​"
    texts = ODD + ["".join(rng.choices(alphabet, k=rng.randint(0, 40))) for _ in range(3000)]
    want = [e.ids for e in reference.encode_batch(texts, add_special_tokens=False)]
    assert split(encoder, texts) == want
    assert [encoder.text(t) for t in texts] == want


def test_round_trip(encoder):
    table = bpe.token_bytes(Path(bpe.DEFAULT_RANKS).read_bytes())
    ids = pa.array(split(encoder, ODD), pa.list_(pa.int32()))
    assert bpe.decoded(ids, table).to_pylist() == ODD
    half = encoder.text("漢")[:1]
    assert bpe.decoded(pa.array([half, None, []], pa.list_(pa.int32())), table).to_pylist() == ["\ufffd", None, ""]


def test_memory_limits_change_nothing(encoder, monkeypatch):
    texts = [f"w{i} x{i % 7}" for i in range(200)]
    want = split(encoder, texts)
    monkeypatch.setattr(bpe, "REMEMBERED_UNITS", 3)
    assert split(bpe.Encoder(bpe.model_from_ranks(Path(bpe.DEFAULT_RANKS).read_bytes())), texts) == want


def test_rows(spark):
    df = spark.createDataFrame([(1, "a b", 9), (1, "a b", 9), (2, None, 9), (3, "", 9), (None, "x", 9)], "doc_id long, text string, ids int")
    got = sorted((r["doc_id"] or 0, r["ids"]) for r in bpe.encode(df).collect())
    assert got[0][0] == 0 and got[1] == got[2] == (1, [64, 275]) and got[3:] == [(2, []), (3, [])]
    assert sorted((r["doc_id"] or 0, r["n_tokens"]) for r in bpe.count_tokens(df).collect()) == [(0, 1), (1, 2), (1, 2), (2, 0), (3, 0)]
    assert sorted((r["doc_id"] or 0, r["text"]) for r in bpe.decode(bpe.encode(df)).collect()) == [(0, "x"), (1, "a b"), (1, "a b"), (2, ""), (3, "")]
    assert bpe.encode(df.limit(0)).count() == 0


def test_steps_keep_rows(monkeypatch):
    monkeypatch.setattr(bpe, "STEP_BYTES", 5)
    batch = pa.RecordBatch.from_arrays([pa.array(range(6)), pa.array(["aa", None, "b" * 20, "", "cc", "dd"])], ["id", "text"])
    parts = list(bpe.steps(iter([batch]), "text"))
    assert len(parts) > 2 and pa.Table.from_batches(parts).column("id").to_pylist() == list(range(6))


def test_gaps_in_ranks_are_refused():
    with pytest.raises(ValueError):
        bpe.model_from_ranks(b"YQ== 0\nYg== 2\n")
