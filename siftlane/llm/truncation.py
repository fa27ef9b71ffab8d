"""Texts that break off before their end (problem 8).

One pass over the texts gives each document min-hash bands of its beginning at
several lengths and the state of its ending; it also counts the words that end in a
full stop. Then:

* **Near copies.** A copy that was cut shares its beginning with the original, however
  much is missing. So bands are made of the five-word shingles of the first ``LEVELS``
  words: a document looks with those of the longest beginning it has, and is found by
  those of all. Of the documents that share a band, a member meets those that have its
  last words somewhere and go on behind them (a join on the hash of the last words);
  from no other could it be told where the member stops. Pairs are verified on the
  full texts (Jaccard of five-word shingles of 0.8 or more between the member and the
  other text up to where the member stops) and aligned. If the other text goes on within a
  word or line without an end of a sentence, the member is cut; if it begins a new line there, the
  member is whole. Either decides, whatever its ending looks like. Equal texts are
  compared once.
* **Endings** decide the rest, by how terminal they are. A closing mark that ends a
  sentence, note or quotation is an end; an open bracket or quotation is none. A full
  stop counts unless its word is an abbreviation: one that closes documents far more
  rarely than the words with a full stop do on the whole. An ending without any mark
  is none, unless its last unit of text is a formula: several documents close with it
  behind different texts, and wherever units of the corpus begin with it, the text or line hardly ever
  goes on.

Statistics run over all documents, and no threshold depends on their number. Units of
text are counted and looked up by 64-bit hashes, in joins; workers get bit sieves of
bounded size, which spare them most rows and lose none.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.skew import attach
from ..operators.snapshots import hash_pairs
from ..runtime import settle
from .bpe import steps

SHINGLE = 5
SIMILAR = 0.8
BANDS, ROWS = 6, 3
#: Words of the beginnings that get bands.
LEVELS = [10 * 3**k for k in range(12)]
#: Characters, besides those of the last unit, that tell one context from another.
CONTEXT_CHARS = 240
#: Bytes of text in which units are hashed at once; their arrays fit a core's cache.
UNIT_STEP = 1 << 18
#: A formula closes at least so many documents, each behind another text.
FORMULA_LEAST = 3
#: Share of a formula's occurrences behind which text or line ends.
FORMULA_CLOSES = 0.8
#: A word is an abbreviation if it closes texts so many times more rarely than words with a full stop do on the whole.
RARER = 8
#: Pairs up to which their ids are sent to all executors (about 24 bytes each) instead of shuffling all texts.
SENT_PAIRS = 500_000
#: Rows up to which the tables of abbreviations and formulas are sent to all executors.
SENT_WORDS = 100_000
#: Documents that meet one part of a hub.
HUB_ROWS = 5_000
#: Further pairs that are compared in one round; those shown to be cut are left out of the next.
ROUND_PAIRS = 5_000_000
#: Bits of the sieve for last words that is sent to all executors: 32 MB at most. Fewer let more words through to the join, and lose none.
SIEVE_BITS = 1 << 28
KEPT_WORDS = 200_000

#: What counts as one number in the units of text that formulas are made of.
_NUMBER = r"[0-9０-９][0-9０-９.,]*|[〇一二三四五六七八九十百千]+"
#: Line breaks, and marks that end a unit within a line.
_BREAKS = r"[\s]*[\n\r\x0b\x0c][\s]*"
_MARKS = r"[.!?。！？()\[\]（）“”„«»;\x00-\x08\x0e-\x1f][.!?。！？()\[\]（）“”„«»;\x00-\x08\x0e-\x1f \t]*"
_MARK = "\x01"
_SPACE = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000\u180e\ufeff\u2060" + "".join(map(chr, range(0x2000, 0x200E)))
_CUT_SIGNS = ("[...]", "(...)", "[…]", "(…)", "...")
_STOPS = ".!?。！？"
_QUOTE_CLOSERS = "”“»\"'’」』"
_OPEN_OF = {")": "(", "]": "[", "）": "（"}
_BEFORE_OPENER = " \n\t\r\x0b\x0c\xa0([–—"


def strip_cut_signs(text: str) -> str:
    """``text`` without blanks, replacement characters and signs of omission at its end."""
    while True:
        text = text.rstrip(_SPACE + "�…")
        sign = next((x for x in _CUT_SIGNS if text.endswith(x)), None)
        if sign is None:
            return text
        text = text[: -len(sign)]


def _open_note(text: str) -> bool:
    """Whether the last bracket in ``text`` stays open."""
    return any(text.rfind(o) > text.rfind(c) for c, o in _OPEN_OF.items())


def _open_quote(text: str) -> bool:
    """Whether the last quotation mark in ``text`` opens. The high mark opens behind a blank, else it closes."""
    high = text.rfind("“")
    opens = high >= 0 and (high == 0 or text[high - 1] in _BEFORE_OPENER)
    opener = max(text.rfind("„"), text.rfind("«"), high if opens else -1)
    return opener > max(text.rfind("”"), text.rfind("»"), -1 if opens else high)


def _ends_sentence(text: str) -> bool:
    return text.rstrip(_SPACE + _QUOTE_CLOSERS + ")]）")[-1:] in tuple(_STOPS) or (text[-1:] == ";" and "Ͱ" <= text[:-1].rstrip()[-1:] <= "\u1fff")


def ending(whole: str) -> tuple[str, str | None]:
    """State of the ending of a whole text, and what decides it if that is still open.

    ``blank``; ``whole``; ``broken``; ``dot`` with the last word, if it is an
    end unless that is an abbreviation; ``unit`` with the text before any cut signs,
    if it is broken unless its last unit is a formula.
    """
    if not whole.strip(_SPACE):
        return "blank", None
    text = strip_cut_signs(whole)
    if not text or _open_note(text) or _open_quote(text):
        return "broken", None
    last = text[-1]
    if last == ".":
        word = re.sub(r"\d", "0", text.rsplit(None, 1)[-1].lower())
        word = re.sub(r"^[\W_]+", "", word)
        return ("dot", word) if word else ("whole", None)
    if _ends_sentence(text):
        return "whole", None
    if last in _OPEN_OF:
        opener = text.rfind(_OPEN_OF[last])
        before = text[: max(0, opener)].rstrip(" ")
        whole = not before or before[-1] in "\n\r\t–—-)]）”“»" or _ends_sentence(before)
        return ("whole" if whole else "broken"), None
    return ("unit", text) if last.isalnum() else ("broken", None)


def _in_units(texts: pa.Array) -> pa.Array:
    """Lower case with every number as 0, line breaks as one each, and the marks between units as one control character."""
    masked = pc.replace_substring_regex(pc.utf8_lower(texts), _NUMBER, "0")
    return pc.replace_substring_regex(pc.replace_substring_regex(masked, _BREAKS, "\n"), _MARKS, _MARK)


class Hasher:
    """Min-hash bands of five-word shingles for Arrow string arrays."""

    def __init__(self) -> None:
        import xxhash

        self._hash = xxhash.xxh64_intdigest
        self.hash = lambda text: xxhash.xxh64_intdigest(text) >> 1
        random = np.random.Generator(np.random.PCG64(20))
        self._by = random.integers(0, 1 << 32, BANDS * ROWS, dtype=np.uint32) | np.uint32(1)
        self._plus = random.integers(0, 1 << 32, BANDS * ROWS, dtype=np.uint32)

    def words(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]:
        """(hashes of the words of all texts in a row, their codes, where each text begins, distinct words); words are in lower case."""
        words = pc.utf8_split_whitespace(pc.utf8_trim_whitespace(pc.utf8_lower(texts)))
        begin = words.offsets.to_numpy().astype(np.int64)
        coded = words.flatten().dictionary_encode()
        codes = coded.indices.to_numpy()
        hashes = np.fromiter((self._hash(w) for w in coded.dictionary.to_pylist()), np.uint64, len(coded.dictionary))
        return hashes[codes], codes, begin, coded.dictionary

    def bands(self, x: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bands of all texts in a row, bands per text). A text has ``BANDS`` bands for each of its beginnings, the longest last."""
        n = np.diff(begin)
        rolled = np.zeros(max(0, len(x) - SHINGLE + 1), np.uint64)
        for k in range(SHINGLE):
            rolled = rolled * np.uint64(0x9E3779B97F4A7C15) + x[k : len(rolled) + k]
        rolled ^= rolled >> np.uint64(29)
        rolled *= np.uint64(0xBF58476D1CE4E5B9)
        small = np.concatenate([(rolled >> np.uint64(32)).astype(np.uint32), np.zeros(1, np.uint32)])
        levels = np.searchsorted(LEVELS, n, "right")
        at = np.concatenate([[0], np.cumsum(levels)])
        bands = np.zeros((at[-1], BANDS), np.uint64)
        least = np.full((BANDS * ROWS, len(n)), 0xFFFFFFFF, np.uint32)
        done = 0
        for level, length in enumerate(LEVELS):
            rows = np.flatnonzero(levels > level)
            if not len(rows):
                break
            # the shingles that this beginning has and the last one had not
            edges = np.stack([begin[rows] + done, begin[rows] + length - SHINGLE + 1], 1).ravel()
            done = length - SHINGLE + 1
            for band in range(BANDS):
                key = np.full(len(rows), (level + 1) * 64 + band, np.uint64)
                for r in range(ROWS):
                    i = band * ROWS + r
                    new = np.minimum.reduceat(small * self._by[i] + self._plus[i], edges)[::2]
                    least[i, rows] = np.minimum(least[i, rows], new)
                    key = (key ^ least[i, rows]) * np.uint64(0x9FB21C651E98DF25)
                    key ^= key >> np.uint64(31)
                bands[at[rows] + level, band] = key
        return bands.ravel().view(np.int64), levels * BANDS


class Beginnings:
    """64-bit hashes of what begins a unit, up to each of its characters."""

    _BASE = 0x9E3779B97F4A7C15

    def __init__(self) -> None:
        self._up = self._down = np.ones(1, np.uint64)

    def _powers(self, n: int) -> None:
        if len(self._up) <= n:
            back = pow(self._BASE, -1, 1 << 64)
            self._up, self._down = (np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(2 * n, b, np.uint64)])) for b in (self._BASE, back))

    def run(self, codes: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """For each character of ``codes`` the hash of its unit up to it; ``starts`` has the unit start of each character."""
        self._powers(len(codes))
        mixed = (codes.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
        mixed ^= mixed >> np.uint64(32)
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed * self._up[: len(codes)], dtype=np.uint64)])
        own = (total[1:] - total[starts]) * self._down[starts]
        own ^= own >> np.uint64(31)
        own *= np.uint64(0xBF58476D1CE4E5B9)
        return (own ^ (own >> np.uint64(29))).view(np.int64)

    def whole(self, unit: str) -> int:
        codes = np.frombuffer(unit.encode("utf-32-le", "surrogatepass"), np.uint32)
        return int(self.run(codes, np.zeros(len(codes), np.int64))[-1])

    def of_unit(self, unit: str) -> list[int]:
        """Hashes of a unit, and of what is left of it without marks or one token of markup at its beginning."""
        bare = re.sub(r"^[\W_]+", "", unit)
        rest = re.sub(r"^\w+[\W_]+", "", bare)
        return [self.whole(x) for x in dict.fromkeys((unit, bare, rest)) if x]


_MIX, _WORD = 0x9E3779B97F4A7C15, (1 << 64) - 1
_NO_BREAK = ")]）;"


def last_words(text: str) -> tuple[int | None, str | None]:
    """Hash of the words before the last one that ``aligned`` looks for, and the last one, in lower case; ``text`` has no cut signs."""
    import xxhash

    words = text.rsplit(None, SHINGLE + 1)[-SHINGLE - 1 :]
    words = [w.lower() for w in words]
    if len(words) <= SHINGLE:
        return None, None
    value = 0
    for w in words[:-1]:
        value = (value * _MIX + xxhash.xxh64_intdigest(w)) & _WORD
    return value - (value >> 63 << 64), words[-1]


_SCAN = "kind string, doc_id {id}, source string, digest binary, before bigint, last string, bands array<bigint>, state string, closing string, keys array<bigint>, context bigint, n bigint"


def scan(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """One row per document (kind ``doc``; ``n`` are its words) and counts of words with a full stop (kind ``word``)."""
    id_type = docs.schema[id_col].dataType
    arrow_id = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[id_type.simpleString()]
    types = {"kind": pa.string(), "doc_id": arrow_id, "source": pa.string(), "digest": pa.binary(), "before": pa.int64(), "last": pa.string(), "bands": pa.list_(pa.int64()), "state": pa.string(), "closing": pa.string(), "keys": pa.list_(pa.int64()), "context": pa.int64(), "n": pa.int64()}

    def batch_of(k: int, **columns: pa.Array) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([columns.get(c, pa.nulls(k, t)) for c, t in types.items()], list(types))

    def words_batch(seen: Counter) -> pa.RecordBatch:
        return batch_of(len(seen), kind=pa.array(["word"] * len(seen)), closing=pa.array(list(seen.keys()), pa.string()), n=pa.array(list(seen.values()), pa.int64()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        hasher, beginnings, seen = Hasher(), Beginnings(), Counter()
        for batch in steps(batches, "text"):
            texts = pc.fill_null(batch.column(2), "")
            hashes, codes, begin, words = hasher.words(texts)
            bands, per_text = hasher.bands(hashes, begin)
            counts = np.bincount(codes, minlength=len(words))
            stop = pc.ends_with(words, ".").to_numpy(zero_copy_only=False)
            for word, count in zip(words.filter(pa.array(stop)).to_pylist(), counts[stop].tolist()):
                seen[re.sub(r"^[\W_]+", "", re.sub(r"\d", "0", word))] += count
            full = texts.to_pylist()
            ends = [ending(t) for t in full]
            k = len(full)
            context: list[int | None] = [None] * k
            keys: list[list[int] | None] = [None] * k
            units = [i for i, (state, _) in enumerate(ends) if state == "unit"]
            for i, text in zip(units, _in_units(pa.array([ends[i][1] for i in units], pa.string())).to_pylist()):
                at = max(text.rfind("\n"), text.rfind(_MARK)) + 1
                keys[i], context[i] = beginnings.of_unit(text[at:].strip()), hasher.hash(ends[i][1][at - len(text) - CONTEXT_CHARS :])
            stripped = [strip_cut_signs(t) for t in full]
            last = [last_words(t) for t in stripped]
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(per_text)]), pa.int32()), pa.array(bands, pa.int64()))
            yield batch_of(
                k,
                kind=pa.array(["doc"] * k),
                doc_id=batch.column(0),
                source=batch.column(1),
                digest=pa.array([xxhash.xxh3_128_digest(t) for t in stripped], pa.binary()),
                before=pa.array([b for b, _ in last], pa.int64()),
                last=pa.array([w for _, w in last], pa.string()),
                bands=lists,
                state=pa.array([state for state, _ in ends]),
                closing=pa.array([c if state == "dot" else None for state, c in ends], pa.string()),
                keys=pa.array(keys, pa.list_(pa.int64())),
                context=pa.array(context, pa.int64()),
                n=pa.array([len(t.split()) for t in stripped], pa.int64()),
            )
            if len(seen) > KEPT_WORDS:
                yield words_batch(seen)
                seen = Counter()
        if seen:
            yield words_batch(seen)

    narrow = docs.select(docs[id_col].alias("id"), docs[source_col].cast("string").alias("source"), docs[text_col].alias("text"))
    return narrow.mapInArrow(run, _SCAN.format(id=id_type.simpleString()))


def formulas(docs: DataFrame, rows: DataFrame, text_col: str) -> DataFrame:
    """``key`` of the units that are formulas.

    Candidates close ``FORMULA_LEAST`` documents or more, each behind another text (copies
    count once). They are formulas if text or line ends behind ``FORMULA_CLOSES`` of the
    units in the corpus that begin with them.
    """
    closing = rows.filter("size(keys) > 0").select(F.col("keys")[0].alias("key"), "context").groupBy("key", "context").agg(F.lit(1).alias("one"))
    candidates = settle(closing.groupBy("key").agg(F.sum("one").alias("ends")).filter(F.col("ends") >= FORMULA_LEAST).select("key"))
    n = candidates.count()
    sent = docs.sparkSession.sparkContext.broadcast(_sieve(candidates.select(F.col("key").alias("before")), n))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        beginnings, mask = Beginnings(), np.uint64(len(sent.value) * 64 - 1)
        keys, closes = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for batch in steps(batches, "text", UNIT_STEP):
            texts = _in_units(pc.drop_null(batch.column(0))).to_pylist()
            codes = np.frombuffer(("\n" + "\n".join(t.strip() for t in texts) + "\n").encode("utf-32-le", "surrogatepass"), np.uint32)
            line, mark = codes == ord("\n"), codes == ord(_MARK)
            starts = np.maximum.accumulate(np.where(line | mark, np.arange(1, len(codes) + 1), 0))
            hashes = beginnings.run(codes, np.minimum(starts, len(codes) - 1))
            place = hashes.view(np.uint64) & mask
            hit = (sent.value[place >> np.uint64(6)] >> (place & np.uint64(63)) & np.uint64(1)).astype(bool) & ~line & ~mark
            at = np.flatnonzero(hit)
            keys.append(hashes[at])
            closes.append(line[at + 1].astype(np.int64))
            if sum(map(len, keys)) > KEPT_WORDS:
                yield counted(keys, closes)
                keys, closes = keys[:1], closes[:1]
        yield counted(keys, closes)

    def counted(keys: list[np.ndarray], closes: list[np.ndarray]) -> pa.RecordBatch:
        one, where = np.unique(np.concatenate(keys), return_inverse=True)
        return pa.RecordBatch.from_arrays([pa.array(one, pa.int64()), pa.array(np.bincount(where, np.concatenate(closes), len(one)).astype(np.int64)), pa.array(np.bincount(where, minlength=len(one)).astype(np.int64))], ["key", "closes", "all"])

    if not n:
        return candidates
    parts = docs.select(docs[text_col].alias("text")).mapInArrow(run, "key bigint, closes bigint, all bigint")
    known = parts.groupBy("key").agg(F.sum("closes").alias("closes"), F.sum("all").alias("all")).join(candidates, "key")
    return settle(known.filter(F.col("closes") >= FORMULA_CLOSES * F.col("all")).select("key"))


def shingles(words: list[str]) -> set[tuple[str, ...]]:
    return set(zip(*(words[k:] for k in range(SHINGLE))))


def aligned(text: str, longer: str) -> str | None:
    """What ``longer`` tells of the end of ``text``: ``cut``, if ``text`` is a near copy of its beginning and it goes on within a word or sentence there; ``whole``, if it begins a new line there."""
    text = strip_cut_signs(text)
    mine, other = text.split(), longer.split()
    if len(mine) <= SHINGLE:
        return None
    last = mine[-SHINGLE - 1 : -1]
    places = [p for p in range(len(other) - SHINGLE) if other[p + SHINGLE - 1] == last[-1] and other[p : p + SHINGLE] == last]
    if not places:
        return None
    at = min(places, key=lambda p: abs(p - (len(mine) - SHINGLE - 1))) + SHINGLE
    word, theirs = mine[-1], other[at]
    # what tells nothing needn't be verified
    if not theirs.startswith(word) or (theirs == word and at + 1 == len(other)):
        return None
    a, b = shingles([w.lower() for w in mine[:-1]]), shingles([w.lower() for w in other[:at]])
    shared = len(a & b)
    if not shared or shared < SIMILAR * (len(a) + len(b) - shared):
        return None
    if theirs != word:
        return "cut" if re.search(r"\w", theirs[len(word) :]) else None
    between = re.match(rf"\s*(?:\S+\s+){{{at}}}\S+(\s+)", longer)
    if between and re.search(r"[\n\r\x0b\x0c]", between[1]):
        return "whole"
    return None if _ends_sentence(word) or word[-1] in _NO_BREAK else "cut"


def _told(docs: DataFrame, met: DataFrame, n_pairs: int, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, cut`` of those documents of the pairs ``doc_id, hub_id`` of which their hub tells whether they are cut; a hub that shows it to be cut holds."""
    # a hub that very many documents meet comes in several parts, each with its share of them
    sizes = met.groupBy(F.col("hub_id").alias("hub")).agg(F.count(F.lit(1)).alias("many"))
    sized = attach(met.withColumn("hub", F.col("hub_id")), sizes, ["hub"], ["many"], F.col("many"), n_pairs, F.col("doc_id"))
    part = F.pmod(F.xxhash64("doc_id"), F.ceil(F.col("many") / F.lit(HUB_ROWS)))
    pairs = settle(sized.select("doc_id", "hub_id", part.alias("part")))
    sent = F.broadcast if n_pairs <= SENT_PAIRS else (lambda x: x)
    texts = docs.filter(docs[id_col].isNotNull()).select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    mine = texts.join(sent(pairs), "doc_id")
    hubs = texts.select(F.col("doc_id").alias("hub_id"), F.col("text").alias("longer")).join(sent(pairs.select("hub_id", "part").distinct()), "hub_id")
    both = mine.join(hubs, ["hub_id", "part"]).select("doc_id", "text", "longer")
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, "text"):
            told = [t and o and aligned(t, o) for t, o in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
            at = [i for i, x in enumerate(told) if x]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())), pa.array([told[i] == "cut" for i in at], pa.bool_())], ["doc_id", "cut"])

    return settle(both.mapInArrow(run, f"doc_id {id_type}, cut boolean").groupBy("doc_id").agg(F.max("cut").alias("cut")))


def _sieve(waiting: DataFrame, n: int) -> np.ndarray:
    """Bits that are set for the hashes ``before``, as words of 64; there are ``n`` rows."""
    bits = min(SIEVE_BITS, 1 << max(16, (64 * n).bit_length()))
    place = waiting.select(F.col("before").bitwiseAND(F.lit(bits - 1)).alias("p"))
    words = place.groupBy(F.expr("shiftright(p, 6)").alias("at")).agg(F.bit_or(F.expr("shiftleft(1L, int(p & 63))")).alias("word")).toArrow()
    sieve = np.zeros(bits // 64, np.uint64)
    sieve[words.column("at").to_numpy()] = words.column("word").to_numpy().view(np.uint64)
    return sieve


def _goes_on(docs: DataFrame, id_col: str, text_col: str, words_sieve: np.ndarray, pair_sieve: np.ndarray) -> DataFrame:
    """``pair, next, more, hub_id``: where texts have last words of members and go on, the word behind them, and whether another follows that.

    Where a text goes on tells how long a member that stops there is, and so, give or
    take some words, which bands that member looks with; ``pair`` is the hash of such a
    band of the text and the last words. The sieves hold last words and pairs of members.
    """
    sent = docs.sparkSession.sparkContext.broadcast((words_sieve, pair_sieve))
    id_type = docs.schema[id_col].dataType.simpleString()

    def passes(sieve: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        place = hashes & np.uint64(len(sieve) * 64 - 1)
        return (sieve[place >> np.uint64(6)] >> (place & np.uint64(63)) & np.uint64(1)).astype(bool)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in steps(batches, "text"):
            hashes, codes, starts, words = hasher.words(pc.fill_null(batch.column(1), ""))
            rolled = np.zeros(max(0, len(hashes) - SHINGLE), np.uint64)  # the word behind is there too
            for k in range(SHINGLE):
                rolled = rolled * np.uint64(_MIX) + hashes[k : len(rolled) + k]
            at = np.flatnonzero(passes(sent.value[0], rolled))
            row = np.searchsorted(starts, at, "right") - 1
            end = starts[row + 1]
            inside = at + SHINGLE < end
            at, row, end = at[inside], row[inside], end[inside]
            n = at + SHINGLE + 1 - starts[row]
            bands, per_text = hasher.bands(hashes, starts)
            first = np.concatenate([[0], np.cumsum(per_text)])
            before = rolled[at].view(np.int64)
            out: list[tuple[np.ndarray, np.ndarray]] = []
            plain = np.searchsorted(LEVELS, n, "right")
            for factor in (1.0, 0.9, 1.1):
                level = np.searchsorted(LEVELS, n * factor, "right")
                usable = np.flatnonzero((level > 0) & (level * BANDS <= per_text[row]) & ((factor == 1.0) | (level != plain)))
                for band in range(BANDS):
                    pair = hash_pairs(bands[first[row[usable]] + (level[usable] - 1) * BANDS + band], before[usable])
                    hit = passes(sent.value[1], pair.view(np.uint64))
                    out.append((pair[hit], usable[hit]))
            pair, which = (np.concatenate(x) for x in zip(*out))
            at, row, end = at[which], row[which], end[which]
            yield pa.RecordBatch.from_arrays([pa.array(pair), words.take(pa.array(codes[at + SHINGLE])), pa.array(at + SHINGLE + 1 < end), batch.column(0).take(pa.array(row))], ["pair", "next", "more", "hub_id"])

    texts = docs.filter(docs[id_col].isNotNull()).select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    return texts.mapInArrow(run, f"pair bigint, next string, more boolean, hub_id {id_type}")


def near_copies(docs: DataFrame, scanned: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``digest, cut`` of texts of which a near copy tells whether they are cut off."""
    everyone = scanned.filter("kind = 'doc' AND doc_id IS NOT NULL AND before IS NOT NULL AND size(bands) > 0")
    # equal texts are compared once
    members = everyone.groupBy("digest").agg(F.min(F.struct("doc_id", "bands", "before", "last", "n")).alias("m")).select("digest", "m.*")
    banded = members.select("doc_id", "n", F.posexplode("bands").alias("at", "band"), (F.size("bands") - BANDS).alias("top")).select("doc_id", "n", "band", (F.col("at") >= F.col("top")).alias("looks"))
    buckets = banded.groupBy("band").agg(F.count(F.lit(1)).alias("members"), F.count_if("looks").alias("looking"), F.max("n").alias("longest"))
    mixed = buckets.filter("members > 1 AND looking > 0").select("band", "looking", "longest")
    looking = banded.filter("looks").select("doc_id", "band", "n")
    met = attach(looking, mixed, ["band"], ["looking", "longest"], F.col("looking"), scanned.count() * BANDS, F.struct("doc_id", "band"))
    # a text that goes on within the last word has no more words
    open_ids = met.filter("longest >= n").select("doc_id").distinct()
    waiting = settle(members.join(open_ids, "doc_id", "left_semi").select("doc_id", "digest", F.slice("bands", F.size("bands") - BANDS + 1, BANDS).alias("bands"), "before", "last"))
    n_waiting = waiting.count()
    if not n_waiting:
        return waiting.select("digest", F.lit(None).cast("boolean").alias("cut"))
    # a bucket is split by the words before the last
    asking = waiting.select("doc_id", "last", "before", F.explode("bands").alias("band")).select("doc_id", "last", F.xxhash64("band", "before").alias("pair"))
    pair_sieve = _sieve(asking.select(F.col("pair").alias("before")), n_waiting * BANDS)
    going_on = _goes_on(docs, id_col, text_col, _sieve(waiting, n_waiting), pair_sieve)
    # equal texts stand for one another, as members and as what goes on
    fits = F.expr("startswith(next, last)") & ((F.col("next") != F.col("last")) | F.col("more")) & (F.col("hub_id") != F.col("doc_id"))
    likely = asking.join(going_on, "pair").filter(fits).select("doc_id", "hub_id").distinct()
    pairs = settle(likely.join(members.select(F.col("doc_id").alias("hub_id")), "hub_id", "left_semi"))
    rounds = -(-pairs.count() // ROUND_PAIRS)
    told = waiting.limit(0).select("doc_id", F.lit(True).alias("cut"))
    for k in range(rounds):
        cut = told.filter("cut").select("doc_id")
        now = settle(pairs.filter(F.pmod(F.xxhash64("hub_id"), F.lit(rounds)) == k).join(cut, "doc_id", "left_anti"))
        told = settle(told.unionByName(_told(docs, now, now.count(), id_col, text_col)).groupBy("doc_id").agg(F.max("cut").alias("cut")))
    return told.join(waiting.select("doc_id", "digest"), "doc_id").select("digest", "cut")


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """``doc_id, source, state, truncated, decided_by`` for every row of ``docs``.

    ``truncated`` is false for null, empty and blank texts (state ``blank``).
    ``decided_by`` is ``copy`` where a near copy tells, else ``ending``. Repeated rows come
    out repeatedly; a null source stays null. Texts of any length are read whole.
    """
    scanned = settle(scan(docs, id_col, text_col, source_col))
    rows = scanned.filter("kind = 'doc'")
    words = scanned.filter("kind = 'word'").groupBy("closing").agg(F.sum("n").alias("total"))
    dots = rows.filter("state = 'dot'").groupBy("closing").agg(F.count(F.lit(1)).alias("ends"))
    counts = scanned.agg(F.count_if(F.col("state") == "dot").alias("closed"), F.sum(F.when(F.col("kind") == "word", F.col("n"))).alias("all")).first()
    usual = F.col("total") * (counts["closed"] / (counts["all"] or 1))
    short = settle(dots.join(words, "closing").filter((usual >= RARER) & (F.col("ends") * RARER < usual)).select(F.col("closing").alias("word"), F.lit(True).alias("short")))
    few = lambda df: F.broadcast(df) if df.count() <= SENT_WORDS else df
    # other rows have no word to look up; a filler spreads them where the table isn't small enough to be sent
    spread = F.concat(F.lit(" "), F.pmod(F.xxhash64("digest", "doc_id"), F.lit(4096)).cast("string"))
    looked_up = rows.select("doc_id", "source", "digest", "state", "keys", F.when(F.col("state") == "dot", F.col("closing")).otherwise(spread).alias("word"))
    known = formulas(docs, rows, text_col)
    asked = looked_up.filter("size(keys) > 0").select("digest", F.explode("keys").alias("key")).distinct()
    closed = settle(asked.join(few(known), "key", "left_semi").select("digest").distinct()).withColumn("formula", F.lit(True))
    copies = near_copies(docs, scanned, id_col, text_col)
    whole = looked_up.join(few(short), "word", "left").join(few(closed), "digest", "left").join(few(copies), "digest", "left")
    state = F.col("state")
    by_ending = F.when(state == "broken", True).when(state == "dot", F.col("short").isNotNull()).when(state == "unit", F.col("formula").isNull()).otherwise(False)
    told = F.col("cut").isNotNull() & (state != "blank")
    return whole.select(F.col("doc_id").alias(id_col), "source", "state", F.when(told, F.col("cut")).otherwise(by_ending).alias("truncated"), F.when(told, "copy").otherwise("ending").alias("decided_by"))


def shares(judged: DataFrame) -> DataFrame:
    """Per source: ``source, documents, truncated, share`` (of its documents that aren't blank; null if there are none)."""
    counted = judged.groupBy("source").agg(F.count_if(F.col("state") != "blank").alias("documents"), F.count_if("truncated").alias("truncated"))
    return counted.withColumn("share", F.col("truncated") / F.nullif(F.col("documents"), F.lit(0)))
