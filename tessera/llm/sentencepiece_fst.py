"""SentencePiece encoding and decoding as a weighted finite-state transducer.

A model file is compiled into

* a normaliser: a one-state transducer that writes the space symbol for a
  space (and the leading symbol before a text), with a second state that
  drops repeated spaces where the model asks for it;
* a piece acceptor: a trie whose final states carry piece ids, and an arc per
  byte for characters that no piece has (byte fallback);
* weights in the tropical semiring (sum along a path, minimum over paths). In a
  unigram model an arc weighs minus the piece's score. In a BPE model the state
  is the last piece, and an arc weighs 0 if its piece can follow that one and
  infinity if not: two pieces can follow each other exactly if merging their
  joined text gives the two again, and a text's BPE encoding is the one path of
  finite weight.

Each input is composed with the compiled machine and the shortest path taken,
position by position. Inputs are cut where no piece can span: between a
character and the next if no piece has the two side by side. The cuts change
nothing, and paths of recurring parts are kept per worker, in bounded number.

Decoding maps ids to bytes, joins them and undoes the normaliser.

Edge cases: a null or empty text has no ids and decodes to an empty text; a
text of any length is encoded whole; repeated rows, null ids and other columns
pass through; an empty table gives no rows. Only models with an identity
character map are accepted (others raise an error). The space symbol itself
(U+2581) decodes to a space, as in the format.
"""

from __future__ import annotations

import functools
import hashlib
import math
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import ship_package, text_or_empty, with_fields
from tessera.sources.tables import read_table

SPACE = "▁"
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = range(1, 7)
UNIGRAM, BPE = 1, 2
KEPT_PARTS = 500_000
KEPT_PAIRS = 800_000
KEPT_LENGTH = 48


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field number, value) of a protocol buffer message."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            if byte < 128:
                return value
            shift += 7

    while at < len(data):
        tag = number()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, number()
            continue
        size = number() if kind == 2 else {1: 8, 5: 4}[kind]
        yield tag >> 3, data[at:at + size]
        at += size


class Model:
    """Pieces, scores and normaliser settings of a model file."""

    def __init__(self, path: str):
        self.pieces: list[str] = []
        self.scores: list[float] = []
        self.kinds: list[int] = []
        self.kind = UNIGRAM
        self.dummy_prefix = self.drop_extra_spaces = self.escape_spaces = True
        self.byte_fallback = False
        with open(path, "rb") as file:
            message = file.read()
        for field, value in _fields(message):
            if field == 1:
                piece, score, kind = "", 0.0, NORMAL
                for k, v in _fields(value):
                    if k == 1:
                        piece = v.decode("utf-8")
                    elif k == 2:
                        score = struct.unpack("<f", v)[0]
                    elif k == 3:
                        kind = v
                self.pieces.append(piece)
                self.scores.append(score)
                self.kinds.append(kind)
            elif field == 2:
                settings = dict(_fields(value))
                self.kind = settings.get(3, UNIGRAM)
                self.byte_fallback = bool(settings.get(35, 0))
            elif field == 3:
                settings = dict(_fields(value))
                if settings.get(2):
                    raise ValueError("only models with an identity character map are supported")
                self.dummy_prefix = bool(settings.get(3, 1))
                self.drop_extra_spaces = bool(settings.get(4, 1))
                self.escape_spaces = bool(settings.get(5, 1))
        if self.kind not in (UNIGRAM, BPE):
            raise ValueError("only unigram and BPE models are supported")


class Transducer:
    """A compiled model: ``encode`` and ``decode``."""

    def __init__(self, path: str):
        self.model = m = Model(path)
        self.ids = {p: i for i, p in enumerate(m.pieces) if m.kinds[i] in (NORMAL, USER)}
        self.byte_ids = {int(p[3:5], 16): i for i, p in enumerate(m.pieces) if m.kinds[i] == BYTE}
        self.unknown = m.kinds.index(UNKNOWN) if UNKNOWN in m.kinds else 0
        self.trie: dict = {}
        together = set()
        for piece, i in self.ids.items():
            node = self.trie
            for char in piece:
                node = node.setdefault(char, {})
            node[""] = i
            together.update(zip(piece, piece[1:], strict=False))
        self.together = together
        # parts of a text: spaces with the word behind them, cut at line ends,
        # as far as no piece spans those places
        inner = any(b == SPACE and a != SPACE for a, b in together)
        ends = any("\n" in pair for pair in together)
        word = SPACE if ends else SPACE + "\n"
        self.parts = None if inner else re.compile(f"{SPACE}+[^{word}]*|[^{word}]+" + ("" if ends else "|\n"))
        # what a character without a piece weighs in a unigram model
        self.unseen = 10.0 - min(m.scores, default=0.0) if m.kind == UNIGRAM else 0.0
        self.follows: dict[int, float] = {}
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.spellings = [bytes([int(p[3:5], 16)]) if k == BYTE else b"" if k in (CONTROL, UNUSED)
                          else " ⁇ ".encode() if k == UNKNOWN else p.encode("utf-8")
                          for p, k in zip(m.pieces, m.kinds, strict=True)]

    # ------------------------------------------------------------ normaliser

    def normalise(self, text: str) -> str:
        m = self.model
        if m.drop_extra_spaces:
            text = re.sub(" +", " ", text).strip(" ")
        if not text:
            return ""
        if m.dummy_prefix:
            text = " " + text
        return text.replace(" ", SPACE) if m.escape_spaces else text

    # -------------------------------------------------------------- weights

    def _merged(self, text: str) -> list[str]:
        """BPE of a short text by its definition: the best-scored (then
        leftmost) neighbours that make a piece are merged."""
        parts = list(text)
        while len(parts) > 1:
            best, at = -math.inf, -1
            for k in range(len(parts) - 1):
                i = self.ids.get(parts[k] + parts[k + 1])
                if i is not None and self.model.scores[i] > best:
                    best, at = self.model.scores[i], k
            if at < 0:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _following(self, last: int, piece: int) -> float:
        """Weight of an arc of a BPE model that writes ``piece`` in the state
        after ``last`` (-1: no piece, or bytes, before)."""
        if len(self.follows) > KEPT_PAIRS:
            self.follows.clear()
        a, b = self.model.pieces[last] if last >= 0 else "", self.model.pieces[piece]
        weight = 0.0 if self._merged(a + b) == ([a, b] if a else [b]) else math.inf
        self.follows[last * len(self.model.pieces) + piece] = weight
        return weight

    # --------------------------------------------------------- shortest path

    def _path(self, text: str) -> list[int]:
        """Ids on the shortest path over a normalised part."""
        n = len(text)
        cost = [math.inf] * (n + 1)
        cost[0] = 0.0
        state = [-1] * (n + 1)  # last piece of the best path to a position
        back: list[tuple[int, tuple[int, ...]]] = [(0, ())] * (n + 1)
        bpe, scores, follows, n_pieces = self.model.kind == BPE, self.model.scores, self.follows, len(self.model.pieces)
        for at in range(n):
            if cost[at] == math.inf:
                continue
            node, end = self.trie, at
            single = False
            while end < n and (node := node.get(text[end])) is not None:
                end += 1
                piece = node.get("")
                if piece is None:
                    continue
                single = single or end == at + 1
                if not bpe:
                    weight = -scores[piece]
                elif cost[end] == 0.0:
                    continue  # the one path to this position is known
                elif (weight := follows.get(state[at] * n_pieces + piece)) is None:
                    weight = self._following(state[at], piece)
                total = cost[at] + weight
                if total < cost[end]:
                    cost[end], state[end], back[end] = total, piece, (at, (piece,))
            if not single:  # a character without a piece: bytes, or unknown
                spelt = text[at].encode("utf-8", "surrogatepass")
                ids = tuple(self.byte_ids[b] for b in spelt) if self.model.byte_fallback else (self.unknown,)
                total = cost[at] + self.unseen
                if total < cost[at + 1]:
                    cost[at + 1], state[at + 1], back[at + 1] = total, -1, (at, ids)
        out: list[tuple[int, ...]] = []
        at = n
        while at:
            at, ids = back[at]
            out.append(ids)
        return [i for ids in reversed(out) for i in ids]

    def _learn(self, part: str) -> bytes:
        """Ids of one part as bytes, kept for later."""
        if (ids := self.old.get(part)) is None:
            found, start = [], 0
            for k in range(1, len(part) + 1):
                if k == len(part) or (part[k - 1], part[k]) not in self.together:
                    piece = part[start:k]
                    known = self.young.get(piece) or self.old.get(piece)
                    if known is None:
                        known = np.array(self._path(piece), "<i4").tobytes()
                        if len(piece) <= KEPT_LENGTH:
                            self.young[piece] = known
                    found.append(known)
                    start = k
            ids = b"".join(found)
        if len(part) <= KEPT_LENGTH:
            self.young[part] = ids
        return ids

    def encode(self, text: str | None) -> np.ndarray:
        """Ids of a whole text (int32)."""
        normal = self.normalise(text or "")
        if not normal:
            return np.empty(0, np.int32)
        if len(self.young) > KEPT_PARTS // 2:
            self.young, self.old = {}, self.young
        young, learn = self.young, self._learn
        parts = self.parts.findall(normal) if self.parts else [normal]
        return np.frombuffer(b"".join([young.get(p) or learn(p) for p in parts]), "<i4")

    def decode(self, ids: list[int] | np.ndarray) -> str:
        spelt = self.spellings
        text = b"".join([spelt[i] for i in (ids.tolist() if isinstance(ids, np.ndarray) else ids)]).decode("utf-8", "replace")
        if self.model.escape_spaces:
            text = text.replace(SPACE, " ")
        return text[1:] if self.model.dummy_prefix and text.startswith(" ") else text


@functools.lru_cache(maxsize=1)
def transducer(path: str) -> Transducer:
    """One compiled model per worker process."""
    return Transducer(path)


def encode_texts(docs: DataFrame, model: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """``docs`` plus ``ids_col``, the ids of ``text_col``; an input column of
    that name is replaced."""
    ship_package(docs.sparkSession)
    kept = T.StructType([f for f in docs.schema.fields if f.name != ids_col])
    out = with_fields(kept, T.StructField(ids_col, T.ArrayType(T.IntegerType(), False)))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = transducer(model)
        for batch in batches:
            found = [machine.encode(t) for t in batch[text_col].to_pylist()]
            ends = np.cumsum([0, *map(len, found)]).astype(np.int32)
            flat = np.concatenate(found) if found else np.empty(0, np.int32)
            ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, pa.int32()))
            yield pa.RecordBatch.from_arrays([*batch.columns, ids], [*batch.schema.names, ids_col])

    return docs.select(*[f"`{f.name}`" for f in kept.fields]).mapInArrow(encode, out)


def decode_ids(encoded: DataFrame, model: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """``encoded`` plus ``text_col``, the text of ``ids_col``."""
    ship_package(encoded.sparkSession)
    kept = T.StructType([f for f in encoded.schema.fields if f.name != text_col])
    out = with_fields(kept, T.StructField(text_col, T.StringType()))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = transducer(model)
        for batch in batches:
            texts = [machine.decode(ids.values.to_numpy() if ids.is_valid else [])
                     for ids in batch[ids_col]]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())],
                                             [*batch.schema.names, text_col])

    return encoded.select(*[f"`{f.name}`" for f in kept.fields]).mapInArrow(decode, out)


def _model_path(model: str | None) -> str:
    import public_tokenizers
    return model or public_tokenizers.path("piece_bpe_32k.model")


def encoded_documents(docs: DataFrame, model: str | None = None) -> DataFrame:
    """doc_id, n_ids, ids, the digest of the text decoded from them and
    whether it is the document's, for every document. Encoding and decoding
    share a worker and so its compiled machine."""
    path = _model_path(model)
    ship_package(docs.sparkSession)

    def both(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = transducer(path)
        for batch in batches:
            texts = batch["text"].to_pylist()
            found = [machine.encode(t) for t in texts]
            decoded = [machine.decode(ids) for ids in found]
            ends = pa.array(np.cumsum([0, *map(len, found)]).astype(np.int32))
            flat = np.concatenate(found) if found else np.empty(0, np.int32)
            yield pa.RecordBatch.from_arrays([
                batch["doc_id"], pa.array([len(x) for x in found], pa.int64()),
                pa.ListArray.from_arrays(ends, pa.array(flat, pa.int32())),
                pa.array([hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in decoded]),
                pa.array([t == d or t.replace(SPACE, " ") == d for t, d in zip(texts, decoded, strict=True)], pa.bool_()),
            ], ["doc_id", "n_ids", "ids", "decoded_sha256", "round_trip"])

    return docs.select("doc_id", text_or_empty("text").alias("text")).mapInArrow(
        both, "doc_id long, n_ids long, ids array<int>, decoded_sha256 string, round_trip boolean")


def op9_sentencepiece(spark, sf_dir) -> DataFrame:
    """Every document encoded and decoded again."""
    return encoded_documents(read_table(spark, sf_dir, "documents"))


def pipeline_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The last stage: the kept documents as ids."""
    return encoded_documents(docs)
