"""Encoding of whole texts by a public byte-level BPE vocabulary (problem 6).

A sentencepiece BPE model is written directly from the rank file: each
vocabulary entry becomes a piece in which every byte stands as one printable
character, its score is the negative rank, and normalisation is the identity.
Merging the best-scored neighbours first is then merging the lowest ranks
first, which is what the vocabulary asks for. The model sees one pre-token at a
time; piece numbers go back to vocabulary ids by subtracting one.

Texts are cut into *units* in front of each single space that a non-space
follows. No pre-token crosses such a cut, and what a unit splits into doesn't
depend on its neighbours. So a batch is cut with Arrow's kernels, its distinct
units are encoded once per Python worker, and ids are put together by Arrow
``take``. Texts with units that are empty or begin with white space (runs of blanks;
about one text in forty of parliament speeches) go through a Python loop of their own,
which joins these to the unit before.

Results: the ids of a null or empty text are an empty array. Special-token
strings are ordinary text. Any row comes out once, repeated ones too.
"""

from __future__ import annotations

import base64
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

#: Fixed value: how the vocabulary's texts are split before merging.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
DEFAULT_RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Bytes of text that one step of a worker holds; a longer text is a step of its own.
STEP_BYTES = 4 << 20
#: Rows that are decoded at once.
DECODED_ROWS = 1_000
#: Units that a worker remembers; beyond it the memory starts anew.
REMEMBERED_UNITS = 400_000


def byte_characters() -> list[str]:
    """The printable character that stands for each byte: itself where it is printable, else the next from 256 on."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(spare)) for b in range(256)]


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def _field(number: int, value: bytes | int | float) -> bytes:
    """One field of a protocol-buffer message."""
    if isinstance(value, bytes):
        return _varint(number << 3 | 2) + _varint(len(value)) + value
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    return _varint(number << 3) + _varint(value)


def model_from_ranks(rank_file: bytes) -> bytes:
    """The sentencepiece model of a rank file (lines of base64 bytes and rank, ranks from 0 without gaps)."""
    table = byte_characters()
    entries = sorted((int(rank), base64.b64decode(token)) for token, rank in map(bytes.split, filter(None, rank_file.splitlines())))
    if [rank for rank, _ in entries] != list(range(len(entries))):
        raise ValueError("ranks must run from 0 without gaps")
    unknown, normal = 2, 1
    pieces = [_field(1, b"<unk>") + _field(2, 0.0) + _field(3, unknown)]
    pieces += [_field(1, "".join(table[b] for b in token).encode()) + _field(2, -float(rank)) + _field(3, normal) for rank, token in entries]
    bpe, absent = 2, (1 << 64) - 1  # absent: -1
    trainer = _field(3, bpe) + _field(4, len(pieces)) + _field(40, 0) + _field(41, absent) + _field(42, absent) + _field(43, absent)
    normalizer = _field(1, b"identity") + _field(3, 0) + _field(4, 0) + _field(5, 0)
    return b"".join(_field(1, p) for p in pieces) + _field(2, trainer) + _field(3, normalizer)


class Encoder:
    """Encodes Arrow string arrays; remembers the ids of units."""

    def __init__(self, model: bytes):
        import regex
        import sentencepiece

        self._pieces = sentencepiece.SentencePieceProcessor(model_proto=model)
        self._split = regex.compile(PRE_TOKEN).findall
        table = byte_characters()
        self._to_chars = {b: c for b, c in enumerate(table)}
        self._units: dict[str, np.ndarray] = {}
        self._tokens: dict[str, list[int]] = {}

    def text(self, text: str) -> list[int]:
        """The ids of one text, without units."""
        pre = self._split(text)
        unknown = [p for p in dict.fromkeys(pre) if p not in self._tokens]
        if unknown:
            if len(self._tokens) + len(unknown) > REMEMBERED_UNITS:
                self._tokens.clear()
                unknown = list(dict.fromkeys(pre))
            mapped = [p.encode().decode("latin-1").translate(self._to_chars) for p in unknown]
            for p, ids in zip(unknown, self._pieces.encode(mapped, num_threads=1)):
                self._tokens[p] = [i - 1 for i in ids]
        known = self._tokens
        return [i for p in pre for i in known[p]]

    def _unit(self, unit: str) -> np.ndarray:
        ids = self._units.get(unit)
        if ids is None:
            if len(self._units) >= REMEMBERED_UNITS:
                self._units.clear()
            ids = self._units[unit] = np.array(self.text(unit), dtype=np.int32)
        return ids

    def arrays(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, where each text's ids begin; one more entry for the end)."""
        texts = pc.fill_null(texts, "").cast(pa.large_string())
        cut = pc.split_pattern(texts, " ")
        begin = cut.offsets.to_numpy()
        coded = cut.flatten().dictionary_encode()
        words, code = coded.dictionary, coded.indices.to_numpy().astype(np.int64)
        # A chunk that is empty or begins with white space belongs to the chunk before.
        glued = pc.match_substring_regex(words, r"^([\s\pZ\x{1c}-\x{1f}\x{85}]|$)").to_numpy(zero_copy_only=False)[code] if len(code) else np.zeros(0, bool)
        first = np.zeros(len(code), bool)
        first[begin[:-1][begin[:-1] < begin[1:]]] = True
        odd = np.zeros(len(texts), bool)
        rows = np.repeat(np.arange(len(texts)), np.diff(begin))
        odd[rows[glued & ~first]] = True
        keep = ~odd[rows]
        variant = (code * 2 + first)[keep]
        used, index = np.unique(variant, return_inverse=True)
        words = words.to_pylist()
        found = [self._unit(words[v >> 1] if v & 1 else " " + words[v >> 1]) for v in used.tolist()]
        sizes = np.fromiter((len(f) for f in found), np.int64, len(found))
        starts = np.concatenate([[0], np.cumsum(sizes)])
        flat = np.concatenate(found) if found else np.zeros(0, np.int32)
        shared = pa.LargeListArray.from_arrays(pa.array(starts, pa.int64()), pa.array(flat, pa.int32()))
        ids = shared.take(pa.array(index)).flatten().to_numpy()
        counts = np.zeros(len(texts), np.int64)
        np.add.at(counts, rows[keep], sizes[index])
        if not odd.any():
            return ids, np.concatenate([[0], np.cumsum(counts)])
        at = np.concatenate([[0], np.cumsum(counts)])
        parts, last = [], 0
        for row in np.flatnonzero(odd):
            parts.append(ids[last : at[row]])
            own = self._by_units(texts[row].as_py())
            counts[row], last = len(own), at[row]
            parts.append(own)
        parts.append(ids[last:])
        return np.concatenate(parts), np.concatenate([[0], np.cumsum(counts)])

    def _by_units(self, text: str) -> np.ndarray:
        units: list[str] = []
        for n, chunk in enumerate(text.split(" ")):
            if n and chunk and not chunk[0].isspace():
                units.append(" " + chunk)
            elif n:
                units[-1] += " " + chunk
            else:
                units.append(chunk)
        return np.concatenate([self._unit(u) if len(u) < 200 else np.array(self.text(u), np.int32) for u in units])


def steps(batches: Iterator[pa.RecordBatch], column: str, most: int | None = None) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``most`` bytes of text (``STEP_BYTES`` if not given), or of one row."""
    most = most or STEP_BYTES
    for batch in batches:
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy().astype(np.int64)
        total, low = np.cumsum(size), 0
        while low < batch.num_rows:
            done = total[low - 1] if low else 0
            high = max(low + 1, int(np.searchsorted(total, done + most, "right")))
            yield batch.slice(low, high - low)
            low = high


_encoders: dict[int, Encoder] = {}


def worker_encoder(model: Broadcast) -> Encoder:
    """The encoder of this Python worker."""
    key = hash(model.value)
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(model.value)
    return _encoders[key]


def share_model(spark: SparkSession, rank_path: str = DEFAULT_RANKS) -> Broadcast:
    """The model for all workers. Its size follows the vocabulary alone (about 1 MB for 50,256 entries)."""
    with open(rank_path, "rb") as f:
        return spark.sparkContext.broadcast(model_from_ranks(f.read()))


def token_bytes(rank_file: bytes) -> pa.Array:
    """The bytes of each id."""
    entries = sorted((int(rank), base64.b64decode(token)) for token, rank in map(bytes.split, filter(None, rank_file.splitlines())))
    return pa.array([token for _, token in entries], pa.large_binary())


def decoded(ids: pa.Array, table: pa.Array) -> pa.Array:
    """Texts of lists of ids; bytes that are no UTF-8 become replacement characters, a null list a null text."""
    flat = ids.cast(pa.large_list(pa.int32()))
    lists = pa.LargeListArray.from_arrays(flat.offsets, table.take(flat.values), mask=pc.is_null(flat) if flat.null_count else None)
    joined = pc.binary_join(lists, pa.scalar(b"", pa.large_binary()))
    try:
        return joined.cast(pa.large_string()).cast(pa.string())
    except pa.ArrowInvalid:
        return pa.array([None if b is None else b.decode("utf-8", "replace") for b in joined.to_pylist()], pa.string())


def decode(df: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", rank_path: str = DEFAULT_RANKS) -> DataFrame:
    """``id_col`` and ``text`` for every row of ids: the inverse of :func:`encode`. An empty list is an empty text; an id outside the vocabulary raises."""
    with open(rank_path, "rb") as f:
        shared = df.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = token_bytes(shared.value)
        for batch in batches:
            for low in range(0, batch.num_rows, DECODED_ROWS):
                part = batch.slice(low, DECODED_ROWS)
                yield pa.RecordBatch.from_arrays([part.column(0), decoded(part.column(1), table)], ["id", "text"])

    kind = df.schema[id_col].dataType.simpleString()
    return df.select(df[id_col].alias("id"), df[ids_col].alias("ids")).mapInArrow(run, f"id {kind}, text string").withColumnRenamed("id", id_col)


def encode(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", rank_path: str = DEFAULT_RANKS) -> DataFrame:
    """``id_col`` and ``ids`` (array of int) for every row of ``df``; other columns aren't read.

    Null and empty texts give an empty array, a null id stays null, repeated rows
    come out repeatedly, an empty table gives no rows.
    """
    model = share_model(df.sparkSession, rank_path)
    kind = df.schema[id_col].dataType
    # ids stay in Arrow from the worker to the sink
    schema = T.StructType([T.StructField("id", kind), T.StructField("ids", T.ArrayType(T.IntegerType(), False), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(model)
        for batch in steps(batches, "text"):
            ids, at = encoder.arrays(batch.column(1))
            lists = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids, pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], ["id", "ids"])

    narrow = df.select(df[id_col].alias("id"), df[text_col].alias("text"))
    return narrow.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def count_tokens(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", rank_path: str = DEFAULT_RANKS) -> DataFrame:
    """``id_col`` and ``n_tokens`` for every row of ``df``; 0 for null and empty texts."""
    model = share_model(df.sparkSession, rank_path)
    schema = T.StructType([T.StructField("id", df.schema[id_col].dataType), T.StructField("n_tokens", T.LongType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(model)
        for batch in steps(batches, "text"):
            _, at = encoder.arrays(batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(at), pa.int64())], ["id", "n_tokens"])

    narrow = df.select(df[id_col].alias("id"), df[text_col].alias("text"))
    return narrow.mapInArrow(run, schema).withColumnRenamed("id", id_col)
