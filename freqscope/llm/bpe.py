"""Operator 8: exact BPE encoding by dynamic programming over prefixes.

A prefix of a piece has one BPE encoding, hence one last token.  An automaton with
suffix links lists the vocabulary entries that end at each byte, longest first;
entry t is the last token of prefix i if it is compatible with the last token u of
the prefix before it, i.e. if BPE leaves the pair (u, t) as it is.  That test
undoes the merges next to the boundary, latest first.  Back-pointers then give
the ids.  Nothing is merged by priority queue, and a piece of n bytes costs time
proportional to its matches, also for very long pieces.

Defined results: a null or empty text has no tokens and decodes to the empty text;
null ids are kept; repeated rows repeat; an empty table gives an empty result;
other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import json
import re
from functools import lru_cache
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .common import field, map_arrow, table, text_or_empty
from .pretoken import PieceCache, chunks, split

TOKENIZER = "byte_bpe_50k.json"
_PAIR_LIMIT = 2_000_000


def tokenizer_path(path: str | None) -> str:
    """``path``, or the installed public vocabulary of this machine."""
    if path:
        return path
    import public_tokenizers
    return public_tokenizers.path(TOKENIZER)


def _byte_chars() -> dict[str, int]:
    """Byte-level alphabet: printable Latin-1 bytes stand for themselves, the
    others for the code points from 256 on, in order."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(rest)}


class PrefixBpe:
    """Tables of one tokenizer file: vocabulary, merges, automaton, pair tests."""

    def __init__(self, path: str) -> None:
        import ahocorasick
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        chars = _byte_chars()
        vocab = spec["model"]["vocab"]
        size = 1 + max([*vocab.values(), *(a["id"] for a in spec["added_tokens"])])
        self.bytes_of: list[bytes] = [b""] * size
        for token, k in vocab.items():
            self.bytes_of[k] = bytes(chars[c] for c in token)
        self.added = {a["content"]: a["id"] for a in spec["added_tokens"]}
        for content, k in self.added.items():
            self.bytes_of[k] = content.encode()
        self.pair_rank: dict[tuple[int, int], int] = {}
        self.rank, self.left, self.right = [-1] * size, [-1] * size, [-1] * size
        for r, pair in enumerate(spec["model"]["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            k = vocab[a + b]
            self.pair_rank[vocab[a], vocab[b]] = r
            if self.rank[k] < 0:
                self.rank[k], self.left[k], self.right[k] = r, vocab[a], vocab[b]
        made = [False] * size
        self.automaton = ahocorasick.Automaton()
        for k in sorted(vocab.values(), key=self.rank.__getitem__):
            a, b, r = self.left[k], self.right[k], self.rank[k]
            made[k] = r < 0 or (made[a] and made[b] and self.rank[a] < r and self.rank[b] < r
                                and self._apart(a, b, r))
            if made[k]:
                self.automaton.add_word(self.bytes_of[k].decode("latin-1"), (k, len(self.bytes_of[k])))
        self.automaton.make_automaton()
        self.id_text = [str(k) for k in range(size)]
        #: ids of a chunk of text with a space before it
        self.spaced = PieceCache(self._encode_spaced)
        self._tested: dict[int, bool] = {}
        self.special = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")") \
            if self.added else None

    def _apart(self, l: int, r: int, before: int) -> bool:
        """BPE joins nothing across the boundary of l and r before rank ``before``.
        Of merges of one rank the left one comes first: undoing a left token looks
        for earlier ranks, undoing a right one also for its own."""
        rank = self.rank
        while True:
            across = self.pair_rank.get((l, r))
            if across is not None and across < before:
                return False
            if rank[l] > rank[r]:
                before, l = rank[l], self.right[l]
            elif rank[r] >= 0:
                before, r = rank[r] + 1, self.left[r]
            else:
                return True

    def encode_piece(self, piece: str) -> tuple[int, ...]:
        data = piece.encode().decode("latin-1")
        last, done, tested = [0] * (len(data) + 1), 0, self._tested
        for end, (t, size) in self.automaton.iter(data):
            i = end + 1
            if i == done:
                continue
            j = i - size
            if j:
                pair = last[j] << 32 | t
                ok = tested.get(pair)
                if ok is None:
                    if len(tested) >= _PAIR_LIMIT:
                        tested.clear()
                    ok = tested[pair] = self._apart(last[j], t, len(self.rank))
                if not ok:
                    continue
            last[i] = t
            done = i
        ids, i, bytes_of = [], len(data), self.bytes_of
        while i:
            ids.append(last[i])
            i -= len(bytes_of[last[i]])
        return tuple(ids[::-1])

    def encode(self, text: str) -> list[int]:
        if not self.special or not self.special.search(text):
            return self._encode_plain(text)
        ids: list[int] = []
        for part in self.special.split(text):
            if part in self.added:
                ids.append(self.added[part])
            else:
                ids.extend(self._encode_plain(part))
        return ids

    def _encode_plain(self, text: str) -> list[int]:
        cut = chunks(text)
        if cut is None:
            return list(chain.from_iterable(map(self.encode_piece, split(text))))
        first = chain.from_iterable(map(self.encode_piece, split(cut[0])))
        return list(chain(first, chain.from_iterable(map(self.spaced.__getitem__, cut[1:]))))

    def _encode_spaced(self, chunk: str) -> tuple[int, ...]:
        return tuple(chain.from_iterable(map(self.encode_piece, split(" " + chunk))))

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


@lru_cache(2)
def load(path: str) -> PrefixBpe:
    return PrefixBpe(path)


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """(id, ids): one row per row of ``docs``.  A narrow pass, no shuffle."""
    schema = T.StructType([field(docs, id_col), T.StructField("ids", T.ArrayType(T.IntegerType()))])

    def run(batch: pa.RecordBatch) -> list:
        bpe = load(tokenizer_path(path))
        return [batch.column(0), [bpe.encode(t) for t in batch.column(1).to_pylist()]]

    return map_arrow(docs.select(id_col, text_or_empty(text_col).alias("text")), run, schema)


def decode(encoded: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", path: str | None = None) -> DataFrame:
    """(id, text) from (id, ids); null ids decode to the empty text."""
    schema = T.StructType([field(encoded, id_col), T.StructField("text", T.StringType())])

    def run(batch: pa.RecordBatch) -> list:
        bpe = load(tokenizer_path(path))
        return [batch.column(0), [bpe.decode(k or []) for k in batch.column(1).to_pylist()]]

    return map_arrow(encoded.select(id_col, ids_col), run, schema)


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256): each text is encoded and its ids
    decoded in one pass, so ids need not leave the task."""
    schema = T.StructType([field(docs, id_col), T.StructField("n_tokens", T.LongType()),
                           T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())])

    def run(batch: pa.RecordBatch) -> list:
        bpe = load(tokenizer_path(path))
        n, ids_sha, text_sha = [], [], []
        for text in batch.column(1).to_pylist():
            ids = bpe.encode(text)
            n.append(len(ids))
            ids_sha.append(hashlib.sha256(",".join(map(bpe.id_text.__getitem__, ids)).encode()).hexdigest())
            text_sha.append(hashlib.sha256(bpe.decode(ids).encode()).hexdigest())
        return [batch.column(0), n, ids_sha, text_sha]

    return map_arrow(docs.select(id_col, text_or_empty(text_col).alias("text")), run, schema)


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"))
