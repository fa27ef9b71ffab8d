"""Loading delimited records, and what is wrong with those that can't be loaded (problem 3).

Each row holds one record. All records of a batch form one byte string that a
small finite-state machine reads. The string is cut into chunks of equal length;
for every chunk the machine's whole transition function (from each state to the
state at its end) is built in step with all other chunks; these functions are
composed by doubling, which gives every chunk its entry state; a second pass then
writes the state at every byte. A record of any length, with separators or line
breaks inside quotes, is so read in numpy without a loop over rows.

A record's end resets the machine, so records don't influence each other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

OTHER, QUOTE, COMMA, END, PAD = range(5)
START, PLAIN, QUOTED, CLOSED, WRONG = range(5)
#: Next state by class of byte and state. PAD keeps the state.
NEXT = np.array(
    [
        # START  PLAIN   QUOTED  CLOSED  WRONG
        [PLAIN, PLAIN, QUOTED, WRONG, WRONG],  # OTHER
        [QUOTED, WRONG, CLOSED, QUOTED, WRONG],  # QUOTE
        [START, START, QUOTED, START, WRONG],  # COMMA
        [START, START, START, START, START],  # END
        [START, PLAIN, QUOTED, CLOSED, WRONG],  # PAD
    ],
    dtype=np.uint8,
)
CHUNK = 256
STEP_BYTES = 4 << 20

COLUMNS = ["rule_type", "raw", "normalized_domain", "wildcard", "modifiers", "category", "added_on"]
CATEGORIES = ["malware", "phishing", "mining", "tracking", "ads", "other", ""]
_DOMAIN_RULE = r"^(?:@@)?\|\|(?:\*\.)?(?P<d>[A-Za-z0-9_-]{1,63}(?:\.[A-Za-z0-9_-]{1,63})+)\^(?:\$(?s:.+))?$"
_PATTERN_RULE = r"^(?:@@)?/(?s:.+)/(?:\$[a-z]+(?:,[a-z]+)*)?$"
QUOTING, COLUMN_COUNT, INVALID = "quoting", "column_count", "invalid_value"


def states_before(classes: np.ndarray, chunk: int = CHUNK) -> np.ndarray:
    """The machine's state before each byte, from START at the first."""
    n = len(classes)
    many = max(1, -(-n // chunk))
    grid = np.full(many * chunk, PAD, np.uint8)
    grid[:n] = classes
    grid = np.ascontiguousarray(grid.reshape(many, chunk).T)
    through = np.tile(np.arange(5, dtype=np.uint8), (many, 1))
    for row in grid:
        through = NEXT[row[:, None], through]
    apart = 1
    while apart < many:  # through[i] becomes the function of chunks 0..i
        through[apart:] = np.take_along_axis(through[apart:], through[:-apart], 1)
        apart *= 2
    state = np.empty(many, np.uint8)
    state[0], state[1:] = START, through[:-1, START]
    out = np.empty((chunk, many), np.uint8)
    for i, row in enumerate(grid):
        out[i] = state
        state = NEXT[row, state]
    return out.T.reshape(-1)[:n]


def _valid_date(values: pa.Array) -> np.ndarray:
    """Whether each value is a calendar date YYYY-MM-DD or empty."""
    empty = pc.equal(values, "").to_numpy(zero_copy_only=False)
    shaped = pc.match_substring_regex(values, r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$")
    part = pc.if_else(shaped, values, "0001-01-01")
    year, month, day = (pc.utf8_slice_codeunits(part, a, b).cast(pa.int32()).to_numpy(zero_copy_only=False) for a, b in ((0, 4), (5, 7), (8, 10)))
    leap = (year % 4 == 0) & ((year % 100 != 0) | (year % 400 == 0))
    month_ok = (month >= 1) & (month <= 12)
    long_months = np.isin(month, [1, 3, 5, 7, 8, 10, 12])
    last = np.where(month == 2, np.where(leap, 29, 28), np.where(long_months, 31, 30))
    return empty | (shaped.to_numpy(zero_copy_only=False) & month_ok & (day >= 1) & (day <= last) & (year >= 1))


def _valid_raw(values: pa.Array) -> np.ndarray:
    domain = pc.struct_field(pc.extract_regex(values, _DOMAIN_RULE), "d")
    size = pc.fill_null(pc.utf8_length(domain), 0).to_numpy()
    return ((size >= 4) & (size <= 253)) | pc.match_substring_regex(values, _PATTERN_RULE).to_numpy(zero_copy_only=False)


def read_records(bodies: pa.Array) -> dict[str, pa.Array]:
    """``reason, reason_column, reason_at`` and the seven columns (null where there is a reason) of each record."""
    width = len(COLUMNS)
    text = pc.replace_substring_regex(pc.fill_null(bodies, ""), r"(?s)^(.*)\r$", r"\1").cast(pa.large_binary()).combine_chunks() if isinstance(bodies, pa.ChunkedArray) else pc.replace_substring_regex(pc.fill_null(bodies, ""), r"(?s)^(.*)\r$", r"\1").cast(pa.large_binary())
    n = len(text)
    offsets = np.frombuffer(text.buffers()[1], np.int64)[text.offset : text.offset + n + 1]
    data = np.frombuffer(text.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    size = np.diff(offsets)
    begin = np.concatenate([[0], np.cumsum(size + 1)])[:-1]  # an END follows each record
    end = begin + size
    symbols = np.full(len(data) + n, 0, np.uint8)
    classes = np.full(len(data) + n, END, np.uint8)
    inside = np.ones(len(classes), bool)
    inside[end] = False
    symbols[inside] = data
    classes[inside] = np.where(data == 34, QUOTE, np.where(data == 44, COMMA, OTHER))
    before = states_before(classes)
    wrong_at = np.flatnonzero((before == WRONG) & (np.concatenate([[START], before[:-1]]) != WRONG)) - 1
    row_of = np.repeat(np.arange(n), size + 1)
    at = np.full(n, -1, np.int64)
    at[row_of[wrong_at]] = wrong_at - begin[row_of[wrong_at]]
    unclosed = before[end] == QUOTED
    at[unclosed] = size[unclosed]
    quoting = unclosed | (before[end] == WRONG)
    limit = (classes == END) | ((classes == COMMA) & (before != QUOTED) & (before != WRONG))
    fields = np.bincount(row_of[limit], minlength=n)
    blank = pc.match_substring_regex(pc.fill_null(bodies, ""), r"^[\s\pZ\x0b]*$").to_numpy(zero_copy_only=False)
    miscounted = ~quoting & ((fields != width) | blank)
    good = ~quoting & ~miscounted
    # values of good records: all bytes but limits and quotes, of a doubled quote the second
    kept = good[row_of] & ~limit & ~((classes == QUOTE) & (before != CLOSED))
    cuts = np.flatnonzero(limit & good[row_of])
    running = np.cumsum(kept)
    value_end = running[cuts]
    value_offsets = np.concatenate([[0], value_end]).astype(np.int64)
    starts = np.concatenate([[-1], cuts])[:-1] + 1
    if len(cuts):
        starts[::width] = begin[good]
    quoted = symbols[starts] == 34 if len(cuts) else np.zeros(0, bool)
    flat = pa.LargeStringArray.from_buffers(len(cuts), pa.py_buffer(value_offsets), pa.py_buffer(symbols[kept].tobytes()))
    trimmed = pc.utf8_trim_whitespace(flat)
    values = pc.if_else(pa.array(quoted), flat, trimmed).cast(pa.string())
    rows = np.flatnonzero(good)
    column = {c: values.take(pa.array(np.arange(len(rows)) * width + i)) for i, c in enumerate(COLUMNS)}
    is_in = lambda c, of: pc.is_in(column[c], pa.array(of)).to_numpy(zero_copy_only=False)
    valid = {"rule_type": is_in("rule_type", ["block", "allow"]), "raw": _valid_raw(column["raw"]), "wildcard": is_in("wildcard", ["true", "false"]), "category": is_in("category", CATEGORIES), "added_on": _valid_date(column["added_on"])}
    culprit = np.full(n, None, object)
    for c in [c for c in COLUMNS if c in valid][::-1]:
        bad = rows[~valid[c]]
        culprit[bad] = c
        at[bad] = starts[COLUMNS.index(c) :: width][~valid[c]] - begin[bad]
    invalid = np.array([c is not None for c in culprit], bool)
    reason = np.where(quoting, QUOTING, np.where(miscounted, COLUMN_COUNT, np.where(invalid, INVALID, None)))
    at[miscounted] = size[miscounted]
    back = np.full(n, -1, np.int64)
    back[rows] = np.arange(len(rows))
    pick = pa.array(np.where(invalid, -1, back), mask=(back < 0) | invalid)
    out = {"reason": pa.array(reason, pa.string()), "reason_column": pa.array(culprit, pa.string()), "reason_at": pa.array(at, pa.int64(), mask=at < 0)}
    return out | {c: column[c].take(pick) for c in COLUMNS}


def split_records(df: DataFrame, id_col: str = "feed_id", body_col: str = "body") -> DataFrame:
    """Every row of ``df`` with its typed columns, or with the reason why there are none.

    Result: ``id_col``, ``reason`` (null for loaded rows; else the first that holds
    of quoting, column_count, invalid_value), ``reason_column`` (for invalid
    values), ``reason_at`` (byte offset within the record), ``rule_type, raw,
    normalized_domain, wildcard (boolean), modifiers, category, added_on (date)``;
    empty categories and dates are null. Null and blank bodies miss columns. Other
    columns of ``df`` aren't read; repeated rows come out repeatedly.
    """
    kind = df.schema[id_col].dataType.simpleString()
    names = ["reason", "reason_column", "reason_at", *COLUMNS]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy().astype(np.int64)
            total, low = np.cumsum(size), 0
            while low < batch.num_rows:
                done = total[low - 1] if low else 0
                high = max(low + 1, int(np.searchsorted(total, done + STEP_BYTES, "right")))
                part = batch.slice(low, high - low)
                read = read_records(part.column(1))
                yield pa.RecordBatch.from_arrays([part.column(0), *(read[c] for c in names)], ["id", *names])
                low = high

    columns = ", ".join(f"{c} string" for c in COLUMNS)
    read = df.select(df[id_col].alias("id"), df[body_col].alias("body")).mapInArrow(run, f"id {kind}, reason string, reason_column string, reason_at bigint, {columns}")
    typed = {"wildcard": F.col("wildcard") == "true", "category": F.nullif(F.col("category"), F.lit("")), "added_on": F.to_date(F.nullif(F.col("added_on"), F.lit("")), "yyyy-MM-dd")}
    return read.withColumns(typed).withColumnRenamed("id", id_col)
