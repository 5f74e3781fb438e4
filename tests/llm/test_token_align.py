"""Cross-tokenizer alignment against a plain version that aligns every document by itself."""

import bisect
import collections
import hashlib

import pytest

from tessera.llm import token_align

P = pytest.importorskip("public_tokenizers")
FILES = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
COLUMNS = (*token_align.MEASURES, "groups_sha256")
TEXTS = [None, "", " ", "a", "It's 12,345 <|endoftext|> <s> words.", "two  spaces\n\n and\tlines \n x", "é" * 40,
         "naïve Ünïcode Ωmega 中文字符 👍🏽 done", "a▁b", "nul\0inside", "x" * 3000, "word " * 4000, " lead and trail ",
         "ends with cr\r\n next", "nbsp here   there", "same text", "same text", "same text"]


def plain(rows, both):
    """{position: measures} of (id, text) rows."""
    from tokenizers import Tokenizer
    a_of, b_of = Tokenizer.from_file(FILES[0]), both.b
    a_of.encode_special_tokens = True
    links, out, counts = {}, {}, collections.Counter()
    for at, (_, text) in enumerate(rows):
        out[at], links[at] = (0, 0, 0, 0, ""), []
        a, b = (a_of.encode(" " + text, add_special_tokens=False).ids, b_of.encode(text)) if text else ([], [])
        x, y = [both.a_bytes[i] for i in a], [both.b_bytes[i] for i in b]
        if not text or not b"".join(x) == b"".join(y) == (" " + text).encode():
            continue
        ends = [[sum(map(len, s[:k + 1])) for k in range(len(s))] if len(s) < 3000 else list(_running(s)) for s in (x, y)]
        cuts = sorted(set(ends[0]) & set(ends[1]))
        groups = [([], []) for _ in cuts]
        for side, (ids, at_ends) in enumerate(zip((a, b), ends, strict=True)):
            for i, e in zip(ids, at_ends, strict=True):
                groups[bisect.bisect_left(cuts, e)][side].append(i)
        links[at] = [(g[0][-1], g[1][-1]) for g in groups]
        counts.update(links[at])
        said = ";".join("|".join(",".join(map(str, side)) for side in g) for g in groups)
        out[at] = (len(a), len(b), len(cuts), len(links[at]), hashlib.sha256(said.encode()).hexdigest())
    best = collections.Counter()
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    return {at: (*v[:4], sum(counts[p] == best[p[1]] for p in links[at]), sum(counts[p] for p in links[at]), v[4])
            for at, v in out.items()}


def _running(parts):
    total = 0
    for p in parts:
        total += len(p)
        yield total


def found(spark, rows, schema="doc_id long, text string"):
    out = token_align.align_documents(spark.createDataFrame(rows, schema), *FILES).collect()
    return collections.Counter((r.doc_id, *[r[c] for c in COLUMNS]) for r in out)


def test_odd_texts_equal_plain_alignment(spark):
    rows = [(k, t) for k, t in enumerate(TEXTS)] + [(None, "without id"), (3, "a"), (3, "repeated id")]
    want = plain(rows, token_align.aligner(*FILES))
    assert found(spark, rows) == collections.Counter((rows[at][0], *v) for at, v in want.items())


def test_same_with_and_without_cuts():
    both = token_align.Aligner(*FILES)
    assert both.cuts
    texts = [t for t in TEXTS if t] + ["one\ntwo\n\nthree.\n four \n", "end\n", "\nbegin", "\n"]
    plainly = lambda both: [(*x[:3], x[3].tolist()) for x in both.align(texts)]
    whole = token_align.Aligner(*FILES)
    whole.cuts = False
    assert plainly(both) == plainly(whole) and both.align([]) == []


def test_cache_stays_bounded(monkeypatch):
    monkeypatch.setattr(token_align, "CACHED_SEGMENTS", 50)
    both = token_align.Aligner(*FILES)
    for k in range(20):
        both.align([" ".join(f"w{k}x{i}" for i in range(30))])
        assert len(both.cache) <= 50


def test_empty_and_clashing_columns(spark):
    assert not found(spark, [])
    rows = [(1, "some text", "k", 5), (2, None, "k", 6)]
    schema = "doc_id long, text string, `key` string, n_a long"
    assert found(spark, rows, schema) == found(spark, [r[:2] for r in rows])


def test_documents_table_equals_plain_alignment(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    want = plain(rows, token_align.aligner(*FILES))
    assert found(spark, rows) == collections.Counter((rows[at][0], *v) for at, v in want.items())
