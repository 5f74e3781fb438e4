"""Token ids in bit-packed binary files.

Every id takes the minimum number of bits for the vocabulary. A shard file
holds the documents of one range of ids, in ascending order:

    header   magic ``TPK1``, bits, ids per block, documents, ids (little endian)
    doc ids  int64 per document (a null id: the smallest int64)
    starts   uint64 per document plus one: first id within the shard
    blocks   uint64 byte offset per block plus one
    data     blocks of packed ids, least significant bit first; every block
             begins at a byte

The block offsets let a reader unpack any span of ids with numpy, without
reading what comes before. Files are written whole under a temporary name and
then moved, so a task that runs again leaves one complete file.

Documents are dealt by ranges of their id (sampled by Spark) and encoded by
the task that writes the shard; only one row per shard goes further, and the
shards' first positions come from a two-level running total.

Edge cases: a null or empty text is a document with the end id only; null ids
come first; rows that repeat an id are kept, ordered by text; a text of any
length is encoded whole; an empty table gives no documents; other columns are
ignored.
"""

from __future__ import annotations

import functools
import json
import os
import re
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import shared_path, ship_package, stored, text_or_empty, width
from tessera.operators.prefix import totals_before
from tessera.sources.tables import read_table

MAGIC = b"TPK1"
HEADER = struct.Struct("<4sIIQQ")
BLOCK = 1 << 16
SHARD_CHARS = 64 << 20
NULL_ID = -(1 << 63)
CACHED_WORDS = 1_200_000
CACHED_WORD_BYTES = 48
DOCS_AT_ONCE = 256


def vocabulary_bits(size: int) -> int:
    return max(1, (size - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Ids as ``bits``-wide fields, least significant bit first."""
    if bits in (8, 16, 32):  # a field is a machine word
        return ids.astype(f"<u{bits // 8}").tobytes()
    fields = (ids.astype(np.uint64)[:, None] >> np.arange(bits, dtype=np.uint64)) & np.uint64(1)
    return np.packbits(fields.astype(np.uint8), bitorder="little").tobytes()


def unpack(data: bytes, n: int, bits: int) -> np.ndarray:
    """The first ``n`` ids of a packed block, as uint32."""
    if bits in (8, 16, 32):
        return np.frombuffer(data, f"<u{bits // 8}", n).astype(np.uint32)
    padded = np.frombuffer(data + bytes(8), np.uint8)
    at = np.arange(n, dtype=np.int64) * bits
    window = np.zeros(n, np.uint64)
    for k in range((bits + 14) // 8):  # the bytes that a field can touch
        window |= padded[(at >> 3) + k].astype(np.uint64) << np.uint64(8 * k)
    return ((window >> (at & 7).astype(np.uint64)) & np.uint64((1 << bits) - 1)).astype(np.uint32)


#: No token holds both a letter and one of these, so a cut between them changes
#: nothing. The letters are those of ASCII and of U+00C0 to U+00FF.
AFTER_LETTER = rb"(?:(?<=[a-z]%s)|(?<=\xc3[\x80-\x96\x98-\xb6\xb8-\xbf]%s))"
CUTS = tuple((re.compile(mark + AFTER_LETTER % (mark, mark)), b" " + sign) for sign, mark in ((b".", rb"\."), (b",", b",")))
WORDS_AT_ONCE = 256


def split_words(texts: list[bytes]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """The distinct words of ``texts``, every word's place among them, and the
    first of every text's words plus their number; an empty word may stand at
    either end of a text."""
    lists = pc.ascii_split_whitespace(pa.array(texts, pa.large_binary()).cast(pa.large_string()))
    firsts = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy())])
    words = pc.list_flatten(lists).dictionary_encode()
    return words.dictionary.cast(pa.large_binary()).to_pylist(), words.indices.to_numpy(), firsts


class WordEncoder:
    """Ids of whole texts, word by word. The vocabulary drops white space and
    no token spans it, so a text's ids are its words' ids in turn; distinct
    words are encoded once and kept in two generations of bounded size: when
    the young one is full, the old one goes."""

    def __init__(self, path: str, cached_words: int = CACHED_WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.generation = cached_words // 2
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}
        # which ids end a word, if the vocabulary has an end for every byte
        suffix = json.loads(self.tokenizer.to_str())["model"].get("end_of_word_suffix")
        ends = {t: k for t, k in self.tokenizer.get_vocab(with_added_tokens=False).items()
                if suffix and t.endswith(suffix)}
        self.ends = None
        if sum(len(t) == len(suffix) + 1 for t in ends) >= 256:
            self.ends = np.zeros(max(self.vocabulary, max(ends.values()) + 1), bool)
            self.ends[list(ends.values())] = True

    @property
    def vocabulary(self) -> int:
        return self.tokenizer.get_vocab_size(with_added_tokens=True)

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, "<u4") for x in found]

    def _word_ids(self, words: list[bytes]) -> Iterator[tuple[bytes, bytes]]:
        """Every word with its ids. Words of letters alone have one id that
        ends a word, their last, so many are encoded as one text."""
        letters, others = [], []
        for word in words:
            (letters if self.ends is not None and word.decode("utf-8").isalpha() else others).append(word)
        parts = [letters[k:k + WORDS_AT_ONCE] for k in range(0, len(letters), WORDS_AT_ONCE)]
        for k in range(0, len(parts), 16):
            together = self._ids([b" ".join(part).decode("utf-8") for part in parts[k:k + 16]])
            for part, ids in zip(parts[k:k + 16], together, strict=True):
                stops = 4 * (np.flatnonzero(self.ends[ids]) + 1)
                if len(stops) != len(part):  # a letter's lower case may hold a mark
                    others += part
                    continue
                data, at = ids.tobytes(), 0
                for word, stop in zip(part, stops.tolist(), strict=True):
                    yield word, data[at:stop]
                    at = stop
        for k in range(0, len(others), 4096):
            part = others[k:k + 4096]
            for word, ids in zip(part, self._ids([w.decode("utf-8") for w in part]), strict=True):
                yield word, ids.tobytes()

    def _known(self, words: list[bytes]) -> list[bytes]:
        """Ids of each of some distinct words."""
        if len(self.young) > self.generation:
            self.young, self.old = {}, self.young
        known = list(map(self.young.get, words))
        missing = {}
        for at, ids in enumerate(known):
            if ids is not None:
                continue
            word = words[at]
            if (ids := self.old.get(word)) is None:
                missing[word] = at
            else:
                self.young[word] = known[at] = ids
        for word, ids in self._word_ids(list(missing)):
            known[missing[word]] = ids
            if len(word) <= CACHED_WORD_BYTES:
                self.young[word] = ids
        return known

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Each text's ids."""
        plain = []
        for text in texts:
            # special tokens are matched with case, in the text as it is
            raw = text.encode("utf-8").lower() if "<|" not in text else b""
            for pattern, cut in CUTS:
                raw = pattern.sub(cut, raw)
            plain.append(raw)
        words, places, firsts = split_words(plain)
        known = self._known(words)
        sizes = np.fromiter(map(len, known), np.int64, len(known)) // 4
        starts = np.cumsum(sizes) - sizes
        size = sizes[places]
        ends = np.concatenate([[0], np.cumsum(size)])
        # id k of a word that begins at position p is id k of the word's own ids
        ids = np.frombuffer(b"".join(known), "<u4")[
            np.repeat(starts[places] - ends[:-1], size) + np.arange(ends[-1])]
        return [self._ids([text])[0] if "<|" in text else ids[a:b]
                for text, a, b in zip(texts, ends[firsts[:-1]], ends[firsts[1:]], strict=True)]


@functools.lru_cache(maxsize=1)
def word_encoder(path: str) -> WordEncoder:
    """One encoder per worker process: its words serve all the tasks it runs."""
    return WordEncoder(path)


def write_shard(path: str, docs: Iterator[tuple[int, np.ndarray]], bits: int) -> tuple[int, int]:
    """Write one shard file; returns its documents and ids. Packed blocks are
    gathered as they fill, so memory holds packed ids only."""
    doc_ids, starts, blocks, rest, n = [], [0], [], [], 0

    def flush(final: bool) -> None:
        nonlocal rest
        ids = np.concatenate(rest) if rest else np.empty(0, np.uint32)
        whole = len(ids) if final else len(ids) // BLOCK * BLOCK
        blocks.extend(pack(ids[k:min(k + BLOCK, whole)], bits) for k in range(0, whole, BLOCK))
        rest = [ids[whole:]]

    for doc, ids in docs:
        doc_ids.append(doc)
        n += len(ids)
        starts.append(n)
        rest.append(ids)
        if n - len(blocks) * BLOCK >= 16 * BLOCK:
            flush(False)
    flush(True)
    offsets = np.cumsum([0, *map(len, blocks)]).astype("<u8")
    fs, name = pafs.FileSystem.from_uri(path)
    fs.create_dir(os.path.dirname(name), recursive=True)
    passing = f"{name}.{uuid.uuid4().hex}"
    with fs.open_output_stream(passing, compression=None) as out:
        out.write(HEADER.pack(MAGIC, bits, BLOCK, len(doc_ids), n))
        out.write(np.array(doc_ids, "<i8").tobytes())
        out.write(np.array(starts, "<u8").tobytes())
        out.write(np.uint64(len(blocks)).tobytes() + offsets.tobytes())
        for block in blocks:
            out.write(block)
    fs.move(passing, name)
    return len(doc_ids), n


class Shard:
    """Random access to one shard file."""

    def __init__(self, path: str):
        fs, name = pafs.FileSystem.from_uri(path)
        self.file = fs.open_input_file(name)
        magic, self.bits, self.block, docs, self.n_ids = HEADER.unpack(self._read(0, HEADER.size))
        if magic != MAGIC:
            raise ValueError(f"not a token file: {path}")
        at = HEADER.size
        self.doc_ids = np.frombuffer(self._read(at, 8 * docs), "<i8")
        self.starts = np.frombuffer(self._read(at + 8 * docs, 8 * docs + 8), "<u8").astype(np.int64)
        at += 16 * docs + 8
        n = int(np.frombuffer(self._read(at, 8), "<u8")[0])
        self.offsets = np.frombuffer(self._read(at + 8, 8 * n + 8), "<u8").astype(np.int64)
        self.data = at + 16 + 8 * n

    def _read(self, at: int, n: int) -> bytes:
        self.file.seek(at)
        return self.file.read(n)

    def ids(self, start: int, stop: int) -> np.ndarray:
        """Ids at positions ``start`` to ``stop`` of the shard; reads only the
        blocks that hold them."""
        if stop <= start:
            return np.empty(0, np.uint32)
        first, last = start // self.block, (stop - 1) // self.block
        data = self._read(self.data + int(self.offsets[first]),
                          int(self.offsets[last + 1] - self.offsets[first]))
        parts = []
        for k in range(first, last + 1):
            size = min(self.block, self.n_ids - k * self.block)
            at = int(self.offsets[k] - self.offsets[first])
            parts.append(unpack(data[at:int(self.offsets[k + 1] - self.offsets[first])], size, self.bits))
        return np.concatenate(parts)[start - first * self.block:stop - first * self.block]

    def documents(self, at_once: int = 1 << 22) -> Iterator[tuple[int, int, np.ndarray]]:
        """(doc id, first position, ids) of every document, reading spans of
        about ``at_once`` ids."""
        k = 0
        while k < len(self.doc_ids):
            end = max(k + 1, int(np.searchsorted(self.starts, self.starts[k] + at_once, "right")) - 1)
            base = int(self.starts[k])
            ids = self.ids(base, int(self.starts[end]))
            for i in range(k, end):
                yield int(self.doc_ids[i]), int(self.starts[i]), \
                    ids[int(self.starts[i]) - base:int(self.starts[i + 1]) - base]
            k = end

    def close(self) -> None:
        self.file.close()


def write_tokens(docs: DataFrame, folder: str, tokenizer: str, end_id: int, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """Encode and write all documents under ``folder``. Returns the manifest:
    (shard, path, n_docs, n_ids, start), a row per file, ``start`` being the
    ids in all shards before it."""
    ship_package(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_or_empty(text_col).alias("text"))
    chars = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    shards = max(width(docs.sparkSession), chars // SHARD_CHARS)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_encoder(tokenizer)
        bits = vocabulary_bits(max(encoder.vocabulary, end_id + 1))
        end = np.array([end_id], np.uint32)

        def encoded() -> Iterator[tuple[int, np.ndarray]]:
            for batch in batches:
                for k in range(0, batch.num_rows, DOCS_AT_ONCE):
                    part = batch.slice(k, DOCS_AT_ONCE)
                    texts = encoder.encode(part["text"].to_pylist())
                    for doc, ids in zip(part["id"].to_pylist(), texts, strict=True):
                        yield (NULL_ID if doc is None else doc,
                               np.concatenate([ids, end]))

        shard = TaskContext.get().partitionId()
        path = f"{folder}/tokens-{shard:06d}.tpk"
        n_docs, n_ids = write_shard(path, encoded(), bits)
        yield pa.RecordBatch.from_pylist(
            [{"shard": shard, "path": path, "n_docs": n_docs, "n_ids": n_ids}])

    manifest = (rows.repartitionByRange(shards, F.col("id").asc_nulls_first())
                .sortWithinPartitions(F.col("id").asc_nulls_first(), "text")
                .mapInArrow(write, "shard long, path string, n_docs long, n_ids long"))
    return totals_before(stored(manifest, "token-manifest"), "shard", "n_ids", "start")


def read_tokens(manifest: DataFrame) -> DataFrame:
    """(doc_id, start, ids) of every document, read from the files."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in (r for b in batches for r in b.to_pylist()):
            shard, docs, held = Shard(row["path"]), [], 0
            for doc, at, ids in shard.documents():
                docs.append((None if doc == NULL_ID else doc, row["start"] + at, len(ids), ids.tobytes()))
                held += len(ids)
                if held >= 1 << 21:
                    yield _batch(docs)
                    docs, held = [], 0
            yield _batch(docs)
            shard.close()

    return (manifest.where("n_docs > 0").repartition(max(1, width(manifest.sparkSession)), "shard")
            .mapInArrow(read, "doc_id long, start long, n_tokens long, ids binary"))


def _batch(docs: list[tuple]) -> pa.RecordBatch:
    kinds = {"doc_id": pa.int64(), "start": pa.int64(), "n_tokens": pa.int64(), "ids": pa.binary()}
    return pa.RecordBatch.from_arrays(
        [pa.array([d[k] for d in docs], t) for k, t in enumerate(kinds.values())], list(kinds))


END_ID = 2


def op2_token_pack(spark: SparkSession, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    """Pack the tokens of every document and read the files back."""
    import public_tokenizers
    path = tokenizer or public_tokenizers.path("word_bpe_49k.json")
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    tokens = read_tokens(write_tokens(docs, shared_path(spark, "tokens"), path, END_ID))
    return tokens.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
