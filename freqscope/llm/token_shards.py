"""Operator 7: token ids in Re-Pair compressed shards with random access.

Texts are dealt by id range and sorted, so shards follow the order of ids.  Each
task encodes its texts with the tokenizers library (once per distinct part),
appends the end id and cuts its ids into blocks of about ``BLOCK_IDS``.  A block is
compressed by Re-Pair: the most frequent pairs of neighbours become nonterminals,
round after round, until no pair occurs ``MIN_COUNT`` times.  One round replaces all
pairs at least a quarter as frequent as the most frequent one.

File format: Parquet rows (shard, block, doc_ids, lengths, width, first_rule, left,
right, expansions, marks, sequence).  ``sequence`` and the rules are little-endian unsigned
integers of ``width`` bytes; symbol ``first_rule + k`` stands for rule k; ``expansions``
holds each rule's length in ids, ``marks`` the ids before every ``MARK_EVERY``-th symbol (4 bytes
each).  Any id is found by its mark and the expansion lengths, opening only the rules
on its path; ``read_spans`` does so for a table of requests.

Defined results: a null or empty text holds the end id alone; null ids come last;
rows that repeat an id follow in order of their texts; an empty table gives an empty
result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .bpe import tokenizer_path
from .common import field, stored, table, text_or_empty
from .pretoken import SPACE

END_ID = 2
BLOCK_IDS = 1 << 20
MIN_COUNT = 32
MARK_EVERY = 256
#: marks whose runs are a piece of their own next to letters
MARKS = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum() and c != "'")
_SLOT_BITS = 18


# -- Re-Pair ---------------------------------------------------------------

def _frequent(seq: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The pairs that are among the most frequent: (positions of pairs that may be,
    their keys, the chosen keys).  All pairs are counted in hash slots; only those in
    slots at least a quarter as full as the fullest, and ``least`` full, are sorted."""
    slot = (seq[:-1] * np.uint32(0x9E3779B1) + seq[1:] * np.uint32(0x85EBCA77)) >> np.uint32(32 - _SLOT_BITS)
    full = np.bincount(slot, minlength=1 << _SLOT_BITS)
    need = max(least, int(full.max(initial=0)) // 4)
    while need >= least:
        at = np.flatnonzero((full >= need)[slot])
        key = seq[at].astype(np.uint64) << np.uint64(32) | seq[at + 1]
        keys, counts = np.unique(key, return_counts=True)
        chosen = keys[counts >= need]
        if len(chosen) or need == least:
            return at, key, chosen
        need = max(least, need // 4)  # full slots, but of several pairs each
    return slot[:0], slot[:0].astype(np.uint64), slot[:0].astype(np.uint64)


def _apart(at: np.ndarray) -> np.ndarray:
    """Of ascending positions: true for the first, third, ... of each run of neighbours."""
    if not len(at):
        return np.zeros(0, bool)
    new = np.concatenate(([True], np.diff(at) > 1))
    first = np.maximum.accumulate(np.where(new, np.arange(len(at)), 0))
    return (np.arange(len(at)) - first) % 2 == 0


def repair(ids: np.ndarray, min_count: int = MIN_COUNT) -> tuple[np.ndarray, int, np.ndarray, np.ndarray, np.ndarray]:
    """(sequence, first_rule, left, right, expansions) of a list of ids."""
    seq = ids.astype(np.uint32)
    first = int(seq.max(initial=0)) + 1
    left, right = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    n = 0
    while len(seq) > 1:
        at, key, chosen = _frequent(seq, min_count)
        if not len(chosen):
            break
        spot = np.minimum(np.searchsorted(chosen, key), len(chosen) - 1)
        hit = chosen[spot] == key
        at, spot = at[hit], spot[hit]
        free = _apart(at)
        at, which = at[free], spot[free]
        used, which = np.unique(which, return_inverse=True)
        left.append((chosen[used] >> np.uint64(32)).astype(np.int64))
        right.append((chosen[used] & np.uint64(0xFFFFFFFF)).astype(np.int64))
        seq[at] = (first + n + which).astype(np.uint32)
        keep = np.ones(len(seq), bool)
        keep[at + 1] = False
        seq = seq[keep]
        n += len(used)
    left, right = np.concatenate(left), np.concatenate(right)
    return seq.astype(np.int64), first, left, right, expansion_lengths(first, left, right)


def expansion_lengths(first: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    size = [1] * len(left)
    for k, (a, b) in enumerate(zip(left.tolist(), right.tolist())):
        size[k] = (1 if a < first else size[a - first]) + (1 if b < first else size[b - first])
    return np.array(size, dtype=np.int64)


def expand(seq: np.ndarray, first: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The ids a sequence stands for.  Rules are opened once, in order; then every
    symbol copies its ids from a table of plain ids and opened rules."""
    if not len(seq) or seq.max() < first:
        return seq
    plain = np.arange(first)
    opened: list[np.ndarray] = []
    for a, b in zip(left.tolist(), right.tolist()):
        opened.append(np.concatenate([opened[x - first] if x >= first else plain[x:x + 1] for x in (a, b)]))
    size = np.concatenate((np.ones(first, np.int64), [len(x) for x in opened]))
    starts = np.cumsum(size) - size
    long = size[seq]
    ends = np.cumsum(long)
    return np.concatenate((plain, *opened))[np.repeat(starts[seq] - (ends - long), long) + np.arange(ends[-1])]


def open_range(seq: np.ndarray, first: int, left: np.ndarray, right: np.ndarray, sizes: np.ndarray,
               start: int, stop: int) -> tuple[np.ndarray, int]:
    """(ids ``start`` to ``stop`` of a sequence, number of rules opened).  Level by level
    each rule that reaches into the range gives its two halves; halves outside it are dropped
    unopened, by their expansion lengths."""
    seq, opened = seq.astype(np.int64), 0
    while True:
        rule = seq >= first
        long = np.ones(len(seq), np.int64)
        long[rule] = sizes[seq[rule] - first]
        ends = np.cumsum(long)
        inside = (ends > start) & (ends - long < stop)
        if not inside.all():
            ahead = int(ends[inside][0] - long[inside][0]) if inside.any() else 0
            seq, rule, start, stop = seq[inside], rule[inside], start - ahead, stop - ahead
        if not rule.any():
            return seq, opened
        opened += int(rule.sum())
        at = np.cumsum(1 + rule) - (1 + rule)
        halves = np.empty(len(seq) + int(rule.sum()), np.int64)
        halves[at[~rule]] = seq[~rule]
        halves[at[rule]], halves[at[rule] + 1] = left[seq[rule] - first], right[seq[rule] - first]
        seq = halves


def read_range(block: dict, start: int, stop: int) -> np.ndarray:
    """Ids ``start`` to ``stop`` of one block row.  ``marks`` say which ``MARK_EVERY`` symbols
    hold them; of those only the rules on the path are opened.  A whole block opens each rule once."""
    if stop <= start:
        return np.empty(0, np.int64)
    kind = f"<u{block['width']}"
    seq, left, right = (np.frombuffer(block[c], kind) for c in ("sequence", "left", "right"))
    first, sizes = block["first_rule"], np.frombuffer(block["expansions"], "<u4")
    marks = np.frombuffer(block["marks"], "<u4")
    if start == 0 and stop >= sum(block["lengths"]):
        return expand(seq.astype(np.int64), first, left, right)
    a, b = np.searchsorted(marks, start, "right") - 1, np.searchsorted(marks, stop, "left")
    ahead = int(marks[a])
    return open_range(seq[a * MARK_EVERY:b * MARK_EVERY], first, left, right, sizes, start - ahead, stop - ahead)[0]


def symbol_marks(seq: np.ndarray, first: int, sizes: np.ndarray) -> np.ndarray:
    """Ids that stand before every ``MARK_EVERY``-th symbol."""
    long = np.ones(len(seq), np.int64)
    rule = seq >= first
    long[rule] = sizes[seq[rule] - first]
    return (np.cumsum(long) - long)[::MARK_EVERY]


# -- tokenizers library ----------------------------------------------------

@lru_cache(1)
def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary: itself if it is
    printable in Latin-1, else the next letter from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [c for c in range(256) if c not in set(shown)]
    return {c: chr(c) for c in shown} | {c: chr(0x100 + k) for k, c in enumerate(rest)}


#: kinds of bytes by their character; an apostrophe may open a contraction, OTHER is not known further but by its
#: last byte, which is GAP if it may end white space
_LETTER, _NUMBER, _MARK, _QUOTE, _OTHER, _BLANK, _LINE, _GAP = range(8)


@lru_cache(1)
def _kind_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(kind of each byte; last bytes of wide white space; whether a part begins between two kinds)."""
    kind = np.full(256, _OTHER, np.uint8)
    for c in range(128):
        kind[c] = _LETTER if chr(c).isalpha() else _NUMBER if chr(c).isdigit() else _GAP if c in SPACE else _OTHER
    kind[[ord(c) for c in MARKS]] = _MARK
    kind[ord("'")], kind[ord(" ")], kind[ord("\n")] = _QUOTE, _BLANK, _LINE
    gap = np.zeros(256, bool)
    gap[[chr(c).encode()[-1] for c in SPACE if c > 127]] = True
    begins = np.zeros((8, 8), bool)
    begins[:_BLANK, [_BLANK, _LINE]] = True
    for x in range(_OTHER):
        for y in range(_OTHER):
            begins[x, y] = min(x, _MARK) != min(y, _MARK) and (x, y) != (_QUOTE, _LETTER)
    begins[_LINE, :_OTHER] = True
    return kind, gap, begins.ravel()


def byte_kinds(data: np.ndarray) -> np.ndarray:
    """The kind of every byte of UTF-8 text that ends in two bytes of zero at least."""
    table, gap, _ = _kind_tables()
    kind = table[data]
    lead = np.flatnonzero(data >= 0xC2)
    if len(lead):
        first = data[lead]
        latin = lead[first == 0xC3]
        latin = latin[(data[latin + 1] != 0x97) & (data[latin + 1] != 0xB7)]  # all letters but the signs for times and by
        kind[latin] = kind[latin + 1] = _LETTER
        last = np.concatenate((lead[first == 0xC2] + 1, lead[(first >= 0xE1) & (first <= 0xE3)] + 2))
        kind[last[gap[data[last]]]] = _GAP
    return kind


def part_starts(kind: np.ndarray, text_starts: np.ndarray) -> np.ndarray:
    """Where texts are cut into parts.  The tokenizer's pattern always ends a piece there, and nothing it looks
    ahead at lies beyond: a run of white space stays whole with what follows, but for a single line end."""
    new = np.zeros(len(kind), bool)
    new[1:] = _kind_tables()[2][kind[:-1] << 3 | kind[1:]]
    line = np.flatnonzero(kind[:-1] == _LINE)
    new[line[kind[line - 1] >= _BLANK] + 1] = False
    new[text_starts] = True
    return np.flatnonzero(new)


class LibraryEncoder:
    """The tokenizers library, called once per distinct part.

    Texts are cut at places where the tokenizer's pattern cuts too, whatever stands around them.  Parts are numbered
    by a table of their bytes (exact up to ``LONGEST`` of them, else a dict), and their ids stand in one pool.  New
    parts of one piece each go to the library's model in one call, others to the library one by one."""

    LONGEST = 23
    #: parts held before all are dropped, ids held, parts looked up at a time, bytes of text at a time
    LIMIT, POOL, GROUP, SLICE = 1_200_000, 12_000_000, 1 << 18, 2 << 20
    _BITS = 22

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.added = tuple(t.content for t in self.library.get_added_tokens_decoder().values())
        # the library's model on pieces in the vocabulary's letters, none of which is white space
        setting = json.loads(self.library.to_str())
        setting |= {"added_tokens": [], "normalizer": None, "post_processor": None,
                    "pre_tokenizer": {"type": "WhitespaceSplit"}}
        self.pieces = Tokenizer.from_str(json.dumps(setting))
        letters = _byte_letters()
        self.letters = np.array([ord(letters[c]) for c in range(256)], "<u4")
        vocab = self.pieces.get_vocab()
        self.whole_bytes = all(x in vocab for x in letters.values())
        self.token_size = np.zeros(1 + max(vocab.values()), np.int64)
        self.token_size[list(vocab.values())] = [len(x) for x in vocab]
        self.mask = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
        room = self.LIMIT + self.GROUP
        self.keys = np.empty((room, 3), np.uint64)
        self.at, self.n = np.empty(room, np.int64), np.empty(room, np.int64)
        self.pool = np.empty(1 << 20, "<u4")
        self._clear()

    def _clear(self) -> None:
        self.held = self.used = 0
        self.table = np.full(1 << self._BITS, -1, np.int32)
        self.long: dict[bytes, int] = {}

    def _whole(self, text: str) -> bytes:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _pooled(self, numbers: np.ndarray, sizes: np.ndarray, ids: np.ndarray) -> None:
        """Ids of the numbered parts, one part's after the other's."""
        while self.used + len(ids) > len(self.pool):
            self.pool = np.concatenate((self.pool, np.empty_like(self.pool)))
        self.pool[self.used:self.used + len(ids)] = ids
        self.n[numbers] = sizes
        self.at[numbers] = self.used + np.cumsum(sizes) - sizes
        self.used += len(ids)

    def _numbers(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number of each key, the places of keys that are new).  Slots are tried in turn; of new keys that
        meet in a free slot one takes it, and the others look again."""
        mixed = keys[:, 0] * np.uint64(0x9E3779B97F4A7C15) + keys[:, 1] * np.uint64(0xC2B2AE3D27D4EB4F)
        mixed += keys[:, 2] * np.uint64(0x165667B19E3779F9)
        mixed ^= mixed >> np.uint64(32)
        slot = (mixed * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(64 - self._BITS)).astype(np.int64)
        out, todo, made = np.empty(len(keys), np.int64), np.arange(len(keys)), []
        while len(todo):
            number = self.table[slot]
            free = np.flatnonzero(number < 0)
            if len(free):
                self.table[slot[free]] = free
                won = free[self.table[slot[free]] == free]
                self.table[slot[won]] = new = np.arange(self.held, self.held + len(won))
                self.keys[new] = keys[todo[won]]
                self.held += len(won)
                made.append(todo[won])
                number[free] = self.table[slot[free]]
            same = (self.keys[number] == keys[todo]).all(1)
            out[todo[same]] = number[same]
            todo, slot = todo[~same], slot[~same] + 1 & (1 << self._BITS) - 1
        return out, np.concatenate(made) if made else todo

    def _learn_pieces(self, data: np.ndarray, numbers: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> None:
        """Ids of parts of one piece each: the tokens' lengths in bytes tell whose they are."""
        for k in range(0, len(starts), 20_000):
            some, size = slice(k, k + 20_000), sizes[k:k + 20_000]
            ends = np.cumsum(size + 1)
            text = self.letters[data[np.repeat(starts[some] - (ends - size - 1), size + 1) + np.arange(ends[-1])]]
            text[ends - 1] = ord(" ")
            found = self.pieces.encode_batch_fast([text.tobytes().decode("utf-32-le")], add_special_tokens=False)[0]
            ids = np.array(found.ids, "<u4")
            cut = np.searchsorted(np.cumsum(self.token_size[ids]), np.cumsum(size)) + 1
            self._pooled(numbers[some], np.diff(cut, prepend=0), ids)

    def _group(self, data: np.ndarray, kind: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The number of each part; ids of new ones are learnt."""
        if self.held > self.LIMIT or self.used > self.POOL:
            self._clear()
        words = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))
        numbers = np.empty(len(starts), np.int64)
        short = np.flatnonzero(sizes <= self.LONGEST)
        at, size = starts[short], sizes[short]
        keys = np.empty((len(short), 3), np.uint64)
        for k in range(3):
            keys[:, k] = words[at + 8 * k] & self.mask[np.clip(size - 8 * k, 0, 8)]
        keys[:, 2] |= size.astype(np.uint64) << np.uint64(56)
        numbers[short], new = self._numbers(keys)
        new = [short[new]]
        for k in np.flatnonzero(sizes > self.LONGEST).tolist():
            part = data[starts[k]:starts[k] + sizes[k]].tobytes()
            number = self.long.get(part)
            if number is None:
                number = self.held
                self.held += 1
                new.append([k])
                if len(part) <= 100:
                    self.long[part] = number
            numbers[k] = number
        new = np.concatenate(new)
        if not len(new):
            return numbers
        at, size = starts[new], sizes[new]
        odd = np.flatnonzero(kind > _MARK)
        tail = np.searchsorted(odd, at + size) - np.searchsorted(odd, at + 1)
        head = kind[at]
        plain = (tail == 0) & ((head <= _MARK) | (head == _BLANK) | (head == _LINE) & (size == 1)) & self.whole_bytes
        self._learn_pieces(data, numbers[new[plain]], at[plain], size[plain])
        rest = new[~plain]
        ids = [self._whole(data[a:b].tobytes().decode()) for a, b in zip(starts[rest], starts[rest] + sizes[rest])]
        self._pooled(numbers[rest], np.array([len(x) // 4 for x in ids], np.int64), np.frombuffer(b"".join(ids), "<u4"))
        return numbers

    def _encode(self, texts: pa.Array) -> list[np.ndarray]:
        _, places, content = texts.buffers()
        places = np.frombuffer(places, "<i8" if pa.types.is_large_string(texts.type) else "<i4")
        places = places[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
        begin, size = int(places[0]), int(places[-1] - places[0])
        if not size:
            return [np.empty(0, "<u4")] * len(texts)
        data = np.zeros(size + 32, np.uint8)
        data[:size] = np.frombuffer(content, np.uint8)[begin:begin + size]
        places -= begin
        kind = byte_kinds(data)[:size]
        starts = part_starts(kind, places[:-1][places[:-1] < places[1:]])
        sizes = np.diff(starts, append=size)
        ids, count = [], np.empty(len(starts), np.int64)
        for k in range(0, len(starts), self.GROUP):
            numbers = self._group(data, kind, starts[k:k + self.GROUP], sizes[k:k + self.GROUP])
            count[k:k + self.GROUP] = n = self.n[numbers]
            ids.append(self.pool[np.repeat(self.at[numbers] - (np.cumsum(n) - n), n) + np.arange(n.sum())])
        ids, before = np.concatenate(ids), np.concatenate(([0], np.cumsum(count)))
        cuts = before[np.searchsorted(starts, places)].tolist()
        out = [ids[a:b] for a, b in zip(cuts, cuts[1:])]
        raw = data[:size].tobytes()
        if any(a.encode() in raw for a in self.added):
            for k, text in enumerate(texts.to_pylist()):
                if any(a in text for a in self.added):
                    out[k] = np.frombuffer(self._whole(text), "<u4")
        return out

    def encode(self, texts: list[str] | pa.Array) -> Iterator[np.ndarray]:
        """The ids of each text, in order; ``SLICE`` bytes of texts, one text at least, are held cut at a time."""
        if not isinstance(texts, pa.Array):
            texts = pa.array(texts, pa.large_string())
        ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
        k = 0
        while k < len(texts):
            n = max(1, int(np.searchsorted(ends, (ends[k - 1] if k else 0) + self.SLICE, "right")) - k)
            yield from self._encode(texts.slice(k, n))
            k += n


@lru_cache(2)
def library(path: str) -> LibraryEncoder:
    return LibraryEncoder(path)


# -- shards ----------------------------------------------------------------

def _shard_schema(id_field: T.StructField) -> T.StructType:
    return T.StructType([
        T.StructField("shard", T.IntegerType()), T.StructField("block", T.IntegerType()),
        T.StructField("doc_ids", T.ArrayType(id_field.dataType)), T.StructField("lengths", T.ArrayType(T.LongType())),
        T.StructField("width", T.IntegerType()), T.StructField("first_rule", T.LongType()),
        T.StructField("left", T.BinaryType()), T.StructField("right", T.BinaryType()),
        T.StructField("expansions", T.BinaryType()), T.StructField("marks", T.BinaryType()),
        T.StructField("sequence", T.BinaryType())])


def write_shards(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None,
                 end_id: int = END_ID, block_ids: int = BLOCK_IDS) -> DataFrame:
    """Encode, compress and write all texts; returns the table read back.

    A document longer than a block makes one block of its own."""
    from pyspark.sql.pandas.types import to_arrow_schema
    schema = _shard_schema(field(docs, id_col))
    arrow = to_arrow_schema(schema)
    sorted_docs = (docs.select(F.col(id_col), text_or_empty(text_col).alias("text"))
                   .repartitionByRange(F.col(id_col).asc_nulls_last())
                   .sortWithinPartitions(F.col(id_col).asc_nulls_last(), "text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, shard = library(tokenizer_path(path)), TaskContext.get().partitionId()
        names, parts, held, block = [], [], 0, 0

        def flush() -> pa.RecordBatch:
            ids = np.concatenate(parts)
            seq, first, left, right, sizes = repair(ids)
            width = 2 if first + len(left) <= 0xFFFF else 4
            pack = [x.astype(f"<u{width}").tobytes() for x in (left, right)]
            row = [[shard], [block], [names], [[len(p) for p in parts]], [width], [first], [pack[0]], [pack[1]],
                   [sizes.astype("<u4").tobytes()], [symbol_marks(seq, first, sizes).astype("<u4").tobytes()],
                   [seq.astype(f"<u{width}").tobytes()]]
            return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(row, arrow)], schema=arrow)

        end = np.array([end_id], dtype="<u4")
        for batch in batches:
            for key, ids in zip(batch.column(0).to_pylist(), coder.encode(batch.column(1))):
                names.append(key)
                parts.append(np.concatenate((ids, end)))
                held += len(ids) + 1
                if held >= block_ids:
                    yield flush()
                    names, parts, held, block = [], [], 0, block + 1
        if names:
            yield flush()

    return stored(sorted_docs.mapInArrow(run, schema), "token-shards")


def _offsets(shards: DataFrame) -> DataFrame:
    """(shard, block, base): ids before each block.  Blocks are summed within
    their shard; only one row per shard meets in one task."""
    blocks = shards.select("shard", "block", F.aggregate("lengths", F.lit(0).cast("long"), lambda s, x: s + x).alias("n"))
    total = blocks.groupBy("shard").agg(F.sum("n").alias("n"))
    before = total.select("shard", (F.sum("n").over(Window.orderBy("shard")) - F.col("n")).alias("shard_base"))
    inside = Window.partitionBy("shard").orderBy("block")
    return (blocks.join(before, "shard")
            .select("shard", "block", (F.col("shard_base") + F.sum("n").over(inside) - F.col("n")).alias("base")))


def read_shards(shards: DataFrame, id_type: T.DataType | None = None) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, decoded from shards."""
    from pyspark.sql.pandas.types import to_arrow_schema
    kind = shards.schema["doc_ids"].dataType.elementType
    schema = T.StructType([T.StructField("doc_id", kind), T.StructField("start", T.LongType()),
                           T.StructField("n_tokens", T.LongType()), T.StructField("ids_crc32", T.LongType())])
    arrow = to_arrow_schema(schema)
    base = stored(_offsets(shards), "token-offsets")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                block = batch.slice(k, 1).to_pylist()[0]
                size = np.array(block["lengths"], dtype=np.int64)
                ends = np.cumsum(size)
                ids = read_range(block, 0, int(ends[-1])).astype("<u4")
                crc = [zlib.crc32(ids[b - n:b].tobytes()) for b, n in zip(ends.tolist(), size.tolist())]
                cols = [block["doc_ids"], ends - size + block["base"], size, crc]
                yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(cols, arrow)], schema=arrow)

    return shards.join(base, ["shard", "block"]).mapInArrow(run, schema)


def read_spans(shards: DataFrame, requests: DataFrame) -> DataFrame:
    """(doc_id, start, stop, ids) for a table of requests (doc_id, start, stop): ids ``start`` to ``stop``
    of each document with that id, counted from 0 within it and cut to its length.

    Requests meet the documents' places by id, then each block once; a block decodes
    only what its requests cover.  Repeated requests answer once; null ids, unknown ids and
    null bounds give no row; an empty span gives an empty list."""
    from pyspark.sql.pandas.types import to_arrow_schema
    places = shards.select(F.col("shard").alias("in_shard"), F.col("block").alias("in_block"), F.posexplode("doc_ids").alias("place", "doc_id"))
    asked = requests.select("doc_id", F.col("start").cast("long"), F.col("stop").cast("long")).dropna().distinct()
    found = places.join(asked, "doc_id").select("in_shard", "in_block", "place", "doc_id", "start", "stop")
    schema = T.StructType([T.StructField("doc_id", shards.schema["doc_ids"].dataType.elementType),
                           T.StructField("start", T.LongType()), T.StructField("stop", T.LongType()),
                           T.StructField("ids", T.ArrayType(T.LongType()))])
    arrow = to_arrow_schema(schema)

    def run(blocks: pa.Table, wanted: pa.Table) -> pa.Table:
        if not wanted.num_rows or not blocks.num_rows:
            return arrow.empty_table()
        block = blocks.to_pylist()[0]
        ends = np.cumsum(np.array(block["lengths"], dtype=np.int64))
        ids = []
        place, starts, stops = (wanted.column(c).to_numpy() for c in ("place", "start", "stop"))
        for k, a, b in zip(place.tolist(), starts.tolist(), stops.tolist()):
            size, base = block["lengths"][k], int(ends[k]) - block["lengths"][k]
            ids.append(read_range(block, base + min(max(a, 0), size), base + min(max(b, 0), size)))
        cols = [wanted.column("doc_id").combine_chunks(), starts, stops, ids]
        return pa.Table.from_arrays([pa.array(c, type=f.type) for c, f in zip(cols, arrow)], schema=arrow)

    blocks = found.select(F.col("in_shard").alias("shard"), F.col("in_block").alias("block")).distinct()
    keys = ["shard", "block"]
    return (shards.join(blocks, keys, "left_semi").groupBy(*keys)
            .cogroup(found.groupBy("in_shard", "in_block")).applyInArrow(run, schema))


def op7_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_shards(write_shards(table(spark, sf_dir, "documents")))
