"""Spelling variants against a plain version that compares every pair of words."""

import collections
import random
import re
import zlib

import pytest

from tessera.llm import spelling_variants

LONG = "donaudampfschifffahrt" * 40


def counted(rows):
    n = collections.Counter()
    for key, text in rows:
        for raw in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), raw)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 31 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            n[run] += 1
    return {w: k for w, k in n.items() if len(w) >= 7 and k >= 2}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    k = next((i for i in range(len(a)) if a[i] != b[i]), len(a))
    return a[k + (len(a) == len(b)):] == b[k + 1:]


def plain(words):
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for w, own in near.items():
        top = min(own, key=lambda v: (-words[v], v), default=None)
        form[w] = top if top and words[top] >= 10 * words[w] else None

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return {(w, form[w], root(w), words[w], len(near[w]), words.get(form[w])) for w in words}


def variants(rng, base, k):
    out = []
    for _ in range(k):
        w, at = rng.choice(base), None
        at = rng.randrange(len(w))
        out.append([w[:at] + w[at + 1:], w[:at] + rng.choice("aeé") + w[at:], w[:at] + rng.choice("xyß") + w[at + 1:]][rng.randrange(3)])
    return out


def found(spark, words):
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    out = [tuple(r) for r in spelling_variants.spelling_variants(df).collect()]
    assert len(out) == len(set(out))
    return set(out)


def test_single_edits_by_prefix_and_suffix():
    rng = random.Random(5)
    base = ["abcdefg", "aaaaaaa", "aaaaaaaa", "abababab", "größenwahn"]
    words = sorted(set(base + variants(rng, base, 300)) - {w for w in base if len(w) < 7})
    words = [w for w in words if len(w) >= 7]
    assert sum(one_edit(a, b) for a in words for b in words) > 100


@pytest.mark.parametrize("tile_rows", [2048, 6])
def test_equal_to_all_pairs(spark, monkeypatch, tile_rows):
    monkeypatch.setattr(spelling_variants, "TILE_ROWS", tile_rows)  # 6: tiles are cut into blocks
    monkeypatch.setattr(spelling_variants, "BLOCK", 8)
    monkeypatch.setattr(spelling_variants, "PACK", 5)
    rng = random.Random(7)
    base = ["".join(rng.choice("abc") for _ in range(rng.randrange(7, 11))) for _ in range(60)] + ["prefixes" * 2, LONG]
    words = {w: rng.choice([2, 3, 25, 300, 4000]) for w in set(base + variants(rng, base, 400)) if len(w) >= 7}
    assert found(spark, words) == plain(words)


def test_chains_and_ties(spark):
    words = {"aaaaaaa": 2, "aaaaaab": 20, "aaaaabb": 200, "aaaabbb": 2000, "zzzzzzz": 2, "zzzzzzx": 20, "zzzzzzy": 20,
             "alonely": 5, "ninefold": 18, "ninefolds": 2}
    out = found(spark, words)
    assert out == plain(words)
    assert ("aaaaaaa", "aaaaaab", "aaaabbb", 2, 1, 20) in out and ("zzzzzzz", "zzzzzzx", "zzzzzzx", 2, 2, 20) in out
    assert ("ninefolds", None, "ninefolds", 2, 1, None) in out


def test_words_of_texts(spark):
    rng = random.Random(3)
    vocabulary = ["Example", "exAmples", "Überraschung", "straßen", "naïvely", "short", "don't", "ÀÉÎÕÜß×÷ð", "x" * 5000]
    rows = [(k, " ".join(rng.choices(vocabulary, k=80))) for k in range(40)]
    rows += [(None, "Example example"), (None, None), (7, ""), (7, rows[7][1]), (7, rows[7][1]), (8, "a中example😀examplés")]
    out = spelling_variants.counted_words(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.word: r.n for r in out} == counted(rows) and len(out) == len(counted(rows))


def test_empty_and_clashing_columns(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert spelling_variants.spelling_variants(spelling_variants.counted_words(empty)).count() == 0
    rows = [(1, "example example", "a", 2, "b"), (2, "exampl exemple exemple", "a", 2, "b")]
    df = spark.createDataFrame(rows, "doc_id long, text string, word string, n long, `key` string")
    assert {r.word: r.n for r in spelling_variants.counted_words(df).collect()} == counted([r[:2] for r in rows])


def test_documents_table_equals_all_pairs(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    words = counted([(r.doc_id, r.text) for r in docs.collect()])
    out = [tuple(r) for r in spelling_variants.op12_spelling_variants(spark, "/root/testdata/sf0.001").collect()]
    assert len(out) == len(words) and set(out) == plain(words)
