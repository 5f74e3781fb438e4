"""Tokens of two tokenizers aligned by the bytes they cover.

Both tokenizers cut the same bytes (a space and the text) into tokens. Where a
token of each ends at one byte, the text is cut into groups; the two tokens
that end there are linked. A pair of ids counts how many links in all
documents hold it, and every document is measured by the counts of its links.

Method: texts are shuffled whole (``groupBy(text)``, combined before the
shuffle), so each distinct text is tokenised and aligned once, however many
copies it has; its links count once per copy; its measures go back to the
documents by a join on the text's SHA-256.

Within a worker, texts are cut further at places where both tokenizers always
cut (checked against the vocabularies on load, ``Aligner.cuts``), and short
segments are tokenised once per worker as long as they stay in a bounded cache.
What is returned does not depend on those cuts.

The table of pair counts is the only thing that goes through the driver. Its
size is bounded by the vocabularies: of two tokens that end together one's
bytes are the end of the other's, so a token has at most one partner class per
byte of its own or of the partner (324,299 pairs for the two files used here),
whatever the corpus. Links themselves never leave their text's row.

Edge cases: a null or empty text, and one whose tokens' bytes are not the
space and the text, has no tokens and zeros everywhere, and '' for its digest;
texts of any length are aligned whole; rows that repeat count as documents of
their own; null ids stay; an empty table gives an empty result; other columns
are ignored, whatever their names.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import ship_package, stored
from tessera.sources.tables import read_table

SPACE = "▁"
#: Where both tokenizers cut, if ``cuts`` holds: after a visible character, before
#: a space (not before a last one: the second puts no space before an empty text)
#: or before a line end that a visible character follows.
CUT = re.compile("(?<=[!-~À-ɏ])(?= .|\n[!-~À-ɏ])", re.DOTALL)
CACHED_SEGMENTS = 400_000
CACHED_CHARS = 48
TEXTS_AT_ONCE = 256
ALIGNED = ("key string, copies long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
           "pairs array<long>, times array<int>")
MEASURES = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")


def byte_characters() -> dict[str, int]:
    """The character that byte-level vocabularies write for each byte: itself
    if it is printable Latin-1, else the next code point from 256 on."""
    printable = [*range(0x21, 0x7f), *range(0xa1, 0xad), *range(0xae, 0x100)]
    rest = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(rest)}


class Aligner:
    """Both tokenizers and the bytes of their entries.

    ``byte_path`` is a byte-level BPE file of the tokenizers library,
    ``piece_path`` a SentencePiece model that puts a space before the text.
    """

    def __init__(self, byte_path: str, piece_path: str):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(byte_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=piece_path)
        of_char = byte_characters()
        vocabulary = self.a.get_vocab()
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for entry, i in vocabulary.items():
            self.a_bytes[i] = bytes(of_char[c] for c in entry) if all(c in of_char for c in entry) else entry.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else
                        b"" if self.b.is_control(i) or self.b.is_unknown(i) else p.replace(SPACE, " ").encode()
                        for i, p in enumerate(pieces)]
        self.a_size, self.b_size = (np.array([len(x) for x in table]) for table in (self.a_bytes, self.b_bytes))
        # how an id is written: first of a group and later, in a and in b
        self.written = np.array([b"%c%d" % (sign, i) for table, signs in ((self.a_bytes, b";,"), (self.b_bytes, b"|,"))
                                 for sign in signs for i in range(len(table))], object)
        self.cuts = self._always_cut(byte_path, pieces)
        self.cache: dict[str, tuple[bytes, bytes] | None] = {}

    def _always_cut(self, byte_path: str, pieces: list[str]) -> bool:
        """Whether both cut at ``CUT``: the first by its pattern for words, the
        second because no piece holds such a place, line ends are bytes of
        their own, and the characters around map to themselves."""
        with open(byte_path, encoding="utf-8") as file:
            spec = json.load(file)
        before = spec.get("pre_tokenizer") or {}
        plain = (before.get("type") == "ByteLevel" and before.get("use_regex") and not before.get("add_prefix_space")
                 and spec.get("normalizer") is None and not spec["model"].get("dropout"))
        spaced = self.b.encode(" a  b") == self.b.encode(" a") + self.b.encode(" b")
        self.space = self.b.piece_to_id(SPACE)
        line = self.b.encode("\na")
        lined = line[0] == self.space and self.b.encode("b\na") == self.b.encode("b") + line[1:]
        visible = [chr(c) for c in (*range(0x21, 0x7f), *range(0xc0, 0x250))]
        return bool(plain and spaced and lined and not any(re.search(f"[^{SPACE}]{SPACE}|\n", p) for p in pieces)
                    and all(self.b.normalize(c) == SPACE + c for c in visible) and self.b.normalize("a\nb") == SPACE + "a\nb")

    def segments(self, text: str) -> list[str]:
        return CUT.split(" " + text) if self.cuts else [" " + text]

    def _ids(self, segment: str, a: list[int], b: list[int]) -> tuple[bytes, bytes] | None:
        """Both tokenizers' ids of one segment; None if the bytes differ."""
        whole = segment.encode()
        if (b"".join([self.a_bytes[i] for i in a]) != whole or b"".join([self.b_bytes[i] for i in b]) != whole):
            return None
        return array("i", a).tobytes(), array("i", b).tobytes()

    def encode(self, texts: list[str]) -> list[tuple[bytes, bytes] | None]:
        """Both tokenizers' ids of each text; None where the bytes differ."""
        parts, cache = [self.segments(t) for t in texts], self.cache
        new = list(set(chain.from_iterable(parts)).difference(cache))
        coded = self.a.encode_batch_fast(new, add_special_tokens=False)
        # the second puts a space before each; a segment begins with its own, or with a line end
        pieces = self.b.encode([s[1:] if s[0] == " " else s for s in new], num_threads=1)
        for segment, a, b in zip(new, coded, pieces, strict=True):
            cache[segment] = self._ids(segment, a.ids, b if segment[0] == " " else b[1:])
        out: list[tuple[bytes, bytes] | None] = []
        for own in parts:
            got = [cache[s] for s in own]
            out.append(None if None in got else tuple(b"".join(side) for side in zip(*got, strict=True)))
        for segment in new:
            if len(segment) > CACHED_CHARS:
                del cache[segment]
        if len(cache) > CACHED_SEGMENTS:  # only what these texts used stays, if it is few enough
            kept = {s: cache[s] for s in set(chain.from_iterable(parts)) & cache.keys()}
            self.cache = kept if len(kept) <= CACHED_SEGMENTS else {}
        return out

    def align(self, texts: list[str]) -> list[tuple[int, int, bytes, np.ndarray]]:
        """(tokens of a, tokens of b, groups as text, pair codes) per text;
        without tokens where the bytes differ. All texts are aligned as one
        run of bytes, since each ends with a token of both."""
        coded = self.encode(texts)
        good = [c for c in coded if c is not None]
        a, b = (np.frombuffer(b"".join(c[side] for c in good), np.int32).astype(np.int64) for side in (0, 1))
        last_a, last_b = (np.cumsum([0, *(len(c[side]) // 4 for c in good)]) for side in (0, 1))
        ends_a, ends_b = np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b])
        at = np.searchsorted(ends_b, ends_a)
        hit = ends_b[at] == ends_a if len(a) else np.empty(0, bool)
        cut_a, cut_b = np.flatnonzero(hit), at[hit]  # the tokens of a group's end
        codes = a[cut_a] * len(self.b_bytes) + b[cut_b]
        # a token's place when each group's tokens of a come before its tokens of b
        later_a, later_b = np.r_[0, cut_a + 1], np.r_[0, cut_b + 1]
        group_a = np.repeat(np.arange(len(cut_a)), np.diff(later_a))
        group_b = np.repeat(np.arange(len(cut_b)), np.diff(later_b))
        first_a, first_b = np.ones(len(a), bool), np.ones(len(b), bool)
        first_a[1:], first_b[1:] = hit[:-1], np.diff(group_b) > 0
        order = np.empty(len(a) + len(b), np.int64)
        order[np.arange(len(a)) + later_b[group_a]] = a + np.where(first_a, 0, len(self.a_bytes))
        order[np.arange(len(b)) + later_a[group_b + 1]] = (
            b + 2 * len(self.a_bytes) + np.where(first_b, 0, len(self.b_bytes)))
        written = self.written[order]
        groups = np.searchsorted(cut_a, last_a)
        out, k = [], 0
        for c in coded:
            if c is None:
                out.append((0, 0, b"", np.empty(0, np.int64)))
                continue
            said = b"".join(written[last_a[k] + last_b[k]:last_a[k + 1] + last_b[k + 1]].tolist())[1:]
            out.append((len(c[0]) // 4, len(c[1]) // 4, said, codes[groups[k]:groups[k + 1]]))
            k += 1
        return out


@functools.lru_cache(maxsize=2)
def aligner(byte_path: str, piece_path: str) -> Aligner:
    """One per worker."""
    return Aligner(byte_path, piece_path)


def text_key(text: str):
    return F.sha2(F.col(f"`{text}`").cast("binary"), 256)


def aligned_texts(docs: DataFrame, byte_path: str, piece_path: str, text: str = "text") -> DataFrame:
    """A row per distinct text: its key, number of copies, numbers of tokens,
    groups and links, the groups' digest, and its distinct pairs of ids (as
    ``a * size of b + b``) with how often each is linked. Stored once."""
    ship_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = aligner(byte_path, piece_path)
        for whole in batches:
            for k in range(0, whole.num_rows, TEXTS_AT_ONCE):
                batch = whole.slice(k, TEXTS_AT_ONCE)
                rows, pairs, times = [], [], []
                for n_a, n_b, said, codes in both.align(batch["text"].to_pylist()):
                    rows.append((n_a, n_b, len(codes), len(codes), hashlib.sha256(said).hexdigest() if n_a else ""))
                    distinct, n = np.unique(codes, return_counts=True)
                    pairs.append(distinct)
                    times.append(n.astype(np.int32))
                ends = pa.array(np.cumsum([0, *map(len, pairs)]).astype(np.int32))
                columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), [pa.int64()] * 4 + [pa.string()], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch["key"], batch["copies"], *columns,
                     pa.ListArray.from_arrays(ends, pa.array(np.concatenate(pairs))),
                     pa.ListArray.from_arrays(ends, pa.array(np.concatenate(times)))],
                    [f.split()[0] for f in ALIGNED.split(", ")])

    texts = (docs.select(F.col(f"`{text}`").alias("text")).where("text is not null and text <> ''")
             .groupBy("text").agg(F.count(F.lit(1)).alias("copies"))
             .select(text_key("text").alias("key"), "copies", "text"))
    return stored(texts.mapInArrow(run, ALIGNED), "aligned-texts")


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(pair, links): how many links of all documents hold each pair. Every
    task adds up its own texts before the shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, sums = np.empty(0, np.int64), np.empty(0, np.int64)
        for batch in batches:
            lists = batch["pairs"]
            pairs = lists.flatten().to_numpy(zero_copy_only=False)
            own = np.repeat(batch["copies"].to_numpy(zero_copy_only=False), np.diff(lists.offsets.to_numpy()))
            links = batch["times"].flatten().to_numpy(zero_copy_only=False) * own
            known, at = np.unique(np.concatenate([known, pairs]), return_inverse=True)
            added = np.zeros(len(known), np.int64)
            np.add.at(added, at, np.concatenate([sums, links]))
            sums = added
        yield pa.RecordBatch.from_arrays([pa.array(known), pa.array(sums)], ["pair", "links"])

    return (aligned.select("copies", "pairs", "times").mapInArrow(run, "pair long, links long")
            .groupBy("pair").agg(F.sum("links").alias("links")))


def measured_texts(aligned: DataFrame, counts: DataFrame, b_size: int) -> DataFrame:
    """``aligned`` with n_best and count_sum instead of the pairs. ``counts``
    is as large as the vocabularies allow, not the corpus (see above)."""
    table = counts.orderBy("pair").toArrow()
    pairs, links = (table[c].to_numpy().astype(np.int64) for c in ("pair", "links"))
    highest = np.zeros(b_size, np.int64)
    np.maximum.at(highest, pairs % b_size, links)
    shared = aligned.sparkSession.sparkContext.broadcast((pairs, links, links == highest[pairs % b_size]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, total, best = shared.value
        for batch in batches:
            lists = batch["pairs"]
            at = np.searchsorted(known, lists.flatten().to_numpy(zero_copy_only=False))
            times = batch["times"].flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            row = np.repeat(np.arange(batch.num_rows), np.diff(lists.offsets.to_numpy()))
            sums = np.zeros((2, batch.num_rows), np.int64)
            if len(at):
                np.add.at(sums[0], row, times * best[at])
                np.add.at(sums[1], row, times * total[at])
            yield pa.RecordBatch.from_arrays(
                [*(batch[c] for c in ("key", *MEASURES[:4], "groups_sha256")), pa.array(sums[0]), pa.array(sums[1])],
                ["key", *MEASURES[:4], "groups_sha256", *MEASURES[4:]])

    return aligned.select("key", *MEASURES[:4], "groups_sha256", "pairs", "times").mapInArrow(
        run, "key string, " + ", ".join(f"{c} long" for c in MEASURES[:4]) + ", groups_sha256 string, n_best long, count_sum long")


def align_documents(docs: DataFrame, byte_path: str, piece_path: str, id_col: str = "doc_id",
                    text: str = "text") -> DataFrame:
    """Every document with the measures of its text."""
    import sentencepiece

    b_size = sentencepiece.SentencePieceProcessor(model_file=piece_path).get_piece_size()
    aligned = aligned_texts(docs, byte_path, piece_path, text)
    measures = measured_texts(aligned, pair_counts(aligned), b_size)
    own = docs.select(F.col(f"`{id_col}`").alias(id_col), text_key(text).alias("key"),
                      F.coalesce(F.col(f"`{text}`") != "", F.lit(False)).alias("some"))
    with_text = own.where("some").drop("some").join(measures, "key", "left").drop("key")
    without = own.where("not some").select(
        id_col, *[F.lit(0).cast("long").alias(c) for c in MEASURES[:4]], F.lit("").alias("groups_sha256"),
        *[F.lit(0).cast("long").alias(c) for c in MEASURES[4:]])
    return with_text.unionByName(without).select(id_col, *MEASURES, "groups_sha256")


def op13_token_align(spark: SparkSession, sf_dir: str, byte_path: str | None = None,
                     piece_path: str | None = None) -> DataFrame:
    """The tokens of every document aligned between the two vocabularies."""
    import public_tokenizers

    return align_documents(read_table(spark, sf_dir, "documents"),
                           byte_path or public_tokenizers.path("byte_bpe_50k.json"),
                           piece_path or public_tokenizers.path("piece_bpe_32k.model"))
