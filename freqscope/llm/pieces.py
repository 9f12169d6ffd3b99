"""Operator 11: exact SentencePiece BPE by a table of distinct chunks.

White space becomes the marker U+2581, and one marker goes in front of a text.  A
chunk is a run of markers with the characters up to the next one.  No piece of the
model has a marker behind another character (checked when the model is read; a
model that breaks this is refused), so no merge crosses the start of a chunk
and chunks can be segmented one by one.

For each slice of texts the operator makes the table of its distinct chunks,
segments each of them once (a worker also keeps those of earlier slices, up to a
bound) and joins the ids back by position: every text is the list of its chunks'
numbers.  A table of all chunks of the corpus would meet the same texts again only
by shuffling every occurrence, several times the input; here nothing is shuffled
and a lost executor costs its slices.

Segmenting a chunk merges the adjacent pair whose union scores best, the leftmost of
equal ones, until no union is a piece.  Short chunks keep the unions' scores in a list,
long ones in a heap (time n log n).  Characters that end as no piece become byte pieces.

Defined results: a null or empty text has no ids and decodes to the empty text; U+2581 in a
text counts as a space, as in the library; null ids are kept; repeated rows repeat; an empty table gives
an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import re
from functools import lru_cache
from heapq import heapify, heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .common import field, map_arrow, table, text_or_empty
from .pretoken import PieceCache

MODEL = "piece_bpe_32k.model"
MARK = "▁"
#: one marker's worth of text: what follows it up to the next word's marker
_CHUNK = re.compile(" ( *[^ ]*)")
_NONE = float("inf")
#: longer chunks go through a heap
_SHORT = 60
_BYTE = re.compile("<0x([0-9A-F]{2})>")


def model_path(path: str | None) -> str:
    """``path``, or the installed public model of this machine."""
    if path:
        return path
    import public_tokenizers
    return public_tokenizers.path(MODEL)


class Pieces:
    """Pieces and scores of one BPE model with byte pieces, and its chunk table."""

    def __init__(self, path: str) -> None:
        from sentencepiece import sentencepiece_model_pb2 as pb
        with open(path, "rb") as f:
            model = pb.ModelProto.FromString(f.read())
        norm, kinds = model.normalizer_spec, pb.ModelProto.SentencePiece
        plain = not norm.precompiled_charsmap and norm.add_dummy_prefix and norm.escape_whitespaces \
            and not norm.remove_extra_whitespaces and not model.trainer_spec.treat_whitespace_as_suffix
        if not (plain and model.trainer_spec.byte_fallback and model.trainer_spec.model_type == 2):
            raise ValueError("only BPE models with byte pieces and unchanged text are read")
        self.text = [p.piece for p in model.pieces]
        self.score: dict[str, float] = {}
        self.id_of: dict[str, int] = {}
        self.byte_id, self.byte_of = [0] * 256, {}
        for k, p in enumerate(model.pieces):
            if p.type == kinds.NORMAL:
                if MARK in p.piece.lstrip(MARK):
                    raise ValueError(f"piece {k} crosses a white-space marker")
                self.score[p.piece], self.id_of[p.piece] = -p.score, k
            elif p.type == kinds.BYTE:
                b = int(_BYTE.fullmatch(p.piece)[1], 16)
                self.byte_id[b], self.byte_of[k] = k, b
            elif p.type in (kinds.USER_DEFINED, kinds.UNUSED):
                raise ValueError("user-defined and unused pieces are not read")
            else:
                self.text[k] = ""  # control pieces decode to nothing
        self.shown = [t.replace(MARK, " ") for t in self.text]
        self.id_text = [str(k) for k in range(len(self.text))]
        #: chunk -> (ids, the same as decimal text, decoded text)
        self.table = PieceCache(self._entry, limit=500_000)

    def _merged_short(self, chunk: str) -> list[str]:
        parts, get = list(chunk), self.score.get
        scores = [get(a + b, _NONE) for a, b in zip(parts, chunk[1:])]
        while scores and (best := min(scores)) is not _NONE:
            k = scores.index(best)
            parts[k:k + 2] = [parts[k] + parts[k + 1]]
            del scores[k]
            if k:
                scores[k - 1] = get(parts[k - 1] + parts[k], _NONE)
            if k < len(scores):
                scores[k] = get(parts[k] + parts[k + 1], _NONE)
        return parts

    def _merged(self, chunk: str) -> list[str]:
        parts, score = list(chunk), self.score
        n = len(parts)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []
        for k in range(n - 1):
            s = score.get(parts[k] + parts[k + 1])
            if s is not None:
                heap.append((s, k, 2))
        heapify(heap)
        while heap:
            _, a, size = heappop(heap)
            b = after[a]
            if not parts[a] or b >= n or len(parts[a]) + len(parts[b]) != size:
                continue
            parts[a] += parts[b]
            parts[b] = ""
            c = after[a] = after[b]
            if c < n:
                before[c] = a
                s = score.get(parts[a] + parts[c])
                if s is not None:
                    heappush(heap, (s, a, size + len(parts[c])))
            z = before[a]
            if z >= 0:
                s = score.get(parts[z] + parts[a])
                if s is not None:
                    heappush(heap, (s, z, len(parts[z]) + size))
        return [p for p in parts if p]

    def segment(self, chunk: str) -> list[int]:
        """Ids of one marked chunk."""
        whole = self.id_of.get(chunk)
        if whole is not None and len(chunk) <= 2:
            return [whole]
        pieces = self._merged_short(chunk) if len(chunk) <= _SHORT else self._merged(chunk)
        try:
            return list(map(self.id_of.__getitem__, pieces))
        except KeyError:
            pass
        ids = []
        for piece in pieces:
            k = self.id_of.get(piece)
            if k is None:
                ids.extend(map(self.byte_id.__getitem__, piece.encode()))
            else:
                ids.append(k)
        return ids

    def _entry(self, chunk: str) -> tuple[tuple[int, ...], str, str]:
        ids = tuple(self.segment(MARK + chunk.replace(" ", MARK)))
        return ids, ",".join(map(self.id_text.__getitem__, ids)), self._joined(ids)

    def chunks(self, text: str) -> list[str]:
        """The chunks in order, each without its first marker; none of an empty text."""
        if not text:
            return []
        text = text.replace(MARK, " ")
        if "  " in text or text[0] == " ":
            return _CHUNK.findall(" " + text)
        return text.split(" ")

    def _joined(self, ids: list[int]) -> str:
        byte_of = self.byte_of
        if byte_of.keys().isdisjoint(ids):
            return "".join(map(self.shown.__getitem__, ids))
        out, run = [], bytearray()
        for k in ids:
            b = byte_of.get(k)
            if b is not None:
                run.append(b)
                continue
            if run:
                out.append(_lenient(run))
                run = bytearray()
            out.append(self.shown[k])
        out.append(_lenient(run))
        return "".join(out)

    def decode(self, ids: list[int]) -> str:
        """The text of any list of ids; the first piece loses its marker.  Control pieces
        before it are skipped, byte pieces before it are not."""
        for at, k in enumerate(ids):
            if self.text[k] or k in self.byte_of:
                first = self.shown[k]
                text = self._joined(ids[at:])
                return text[1:] if k not in self.byte_of and first.startswith(" ") else text
        return ""


def _lenient(run: bytes) -> str:
    """UTF-8, each byte that is part of no character as U+FFFD."""
    out, k = [], 0
    while k < len(run):
        for size in (1, 2, 3, 4):
            try:
                out.append(bytes(run[k:k + size]).decode())
                break
            except UnicodeDecodeError:
                continue
        else:
            size = 1
            out.append("�")
        k += size
    return "".join(out)


@lru_cache(2)
def load(path: str) -> Pieces:
    return Pieces(path)


def _chunk_table(model: Pieces, texts: list[str]) -> tuple[np.ndarray, np.ndarray, list]:
    """(chunk number at each position, positions up to each text, entry of each distinct chunk)."""
    lists = [model.chunks(t) for t in texts]
    at = pa.array(list(chain.from_iterable(lists)), pa.large_string()).dictionary_encode()
    ends = np.cumsum(np.fromiter(map(len, lists), np.int64, len(lists)))
    return at.indices.to_numpy(), ends, list(map(model.table.__getitem__, at.dictionary.to_pylist()))


def _texts(docs: DataFrame, text_col: str, *cols: str) -> DataFrame:
    return docs.select(*cols, text_or_empty(text_col).alias("text"))


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """(id, ids): one row per row of ``docs``.  A narrow pass, no shuffle."""
    schema = T.StructType([field(docs, id_col), T.StructField("ids", T.ArrayType(T.IntegerType()))])

    def run(batch: pa.RecordBatch) -> list:
        at, ends, entries = _chunk_table(load(model_path(path)), batch.column(1).to_pylist())
        size = np.fromiter((len(e[0]) for e in entries), np.int64, len(entries))
        flat = np.fromiter(chain.from_iterable(e[0] for e in entries), np.int32, int(size.sum()))
        start, n = (np.cumsum(size) - size)[at], size[at]
        done = np.concatenate(([0], np.cumsum(n)))
        ids = flat[np.repeat(start - done[:-1], n) + np.arange(done[-1])]
        return [batch.column(0), pa.LargeListArray.from_arrays(np.concatenate(([0], done[ends])), ids)]

    return map_arrow(_texts(docs, text_col, id_col), run, schema)


def decode(encoded: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", path: str | None = None) -> DataFrame:
    """(id, text) from (id, ids); null ids decode to the empty text."""
    schema = T.StructType([field(encoded, id_col), T.StructField("text", T.StringType())])

    def run(batch: pa.RecordBatch) -> list:
        model = load(model_path(path))
        return [batch.column(0), [model.decode(k or []) for k in batch.column(1).to_pylist()]]

    return map_arrow(encoded.select(id_col, ids_col), run, schema)


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256).  Ids and their decoding are both joined
    back from the chunk table: a chunk's ids decode by themselves, as a marker ends
    every run of byte pieces before it; the text's first marker goes."""
    schema = T.StructType([field(docs, id_col), T.StructField("n_tokens", T.LongType()),
                           T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())])

    def run(batch: pa.RecordBatch) -> list:
        at, ends, entries = _chunk_table(load(model_path(path)), batch.column(1).to_pylist())
        count = [len(e[0]) for e in entries]
        total = np.concatenate(([0], np.cumsum(np.array(count, np.int64)[at] if len(at) else at)))[ends]
        ids, shown = [e[1] for e in entries], [e[2] for e in entries]
        ids_sha, text_sha, a = [], [], 0
        for b in ends.tolist():
            here = at[a:b].tolist()
            ids_sha.append(hashlib.sha256(",".join([ids[k] for k in here]).encode()).hexdigest())
            text_sha.append(hashlib.sha256("".join([shown[k] for k in here])[1:].encode()).hexdigest())
            a = b
        return [batch.column(0), np.diff(total, prepend=0), ids_sha, text_sha]

    return map_arrow(_texts(docs, text_col, id_col), run, schema)


def op11_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"))
