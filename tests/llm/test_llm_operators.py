"""Each operator against a brute-force version, with the odd rows it must take:
nulls in any column, empty and long texts, ties, repeated rows, empty tables
and extra columns whose names clash."""

import collections
import hashlib
import itertools
import math
import random
import re
import unicodedata
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import (components, decontaminate, jaccard_join, line_dedup, pii, quality_classifier,
                         quality_rules, sentencepiece_fst, token_pack, url_lists, warc)

P = pytest.importorskip("public_tokenizers")
LONG = "so many words here and there " * 9000
LINE = "a line that several documents share"
TEXTS = [(1, f"{LINE}\none more"), (2, f"  {LINE.upper()}\nshort\nshort"), (3, None), (4, ""), (5, LONG),
         (5, LONG), (6, "x"), (None, f"{LINE}\nwithout id"), (7, f"{LINE}\n"), (8, "é" * 12 + "\nß\x0b"),
         (9, "é" * 12), (10, "\n\n"), (11, "a b c d e f g h i j k l"), (12, "A B C D E F G H I J K L")]
DOCS = "doc_id long, text string"


def docs(spark, rows=TEXTS, schema=DOCS):
    return spark.createDataFrame(rows, schema)


def clashing(spark, rows=TEXTS):
    """Documents with columns named like those the operators add."""
    extra = "n_chars long, n_lines string, score string, ids string, rid string, id string, __bucket string"
    names = [x.split()[0] for x in extra.split(", ")]
    return docs(spark, [(*r, len(r[1] or ""), *["kept"] * (len(names) - 1)) for r in rows], f"{DOCS}, {extra}")


# ------------------------------------------------------------------------ WARC

def test_warc(spark):
    big, other = "<p>" + "x" * 200, "y" * 150
    rows = [(3, "http://a/", big), (1, "http://b/\r\nWARC-Type: revisit", big), (2, None, "tiny"), (4, "u", "tiny"),
            (5, "u", None), (6, "u", ""), (7, "u", other), (7, "u", other), (8, "u", other), (None, "u", big)]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, digest string")
    found = sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)
                    for r in warc.op1_warc_archive(pages).collect()), key=str)
    expected = []
    for page, _, html in rows:
        payload = (html or "").encode()
        owner = min(p for p, _, h in rows if (h or "") == (html or "") and p is not None)
        again = page is not None and len(payload) >= 100 and page > owner
        expected.append((page, len(payload), hashlib.sha256(payload).hexdigest(),
                         "revisit" if again else "response", owner if again else None))
    assert found == sorted(expected, key=str)
    assert warc.op1_warc_archive(pages.limit(0)).count() == 0


def test_warc_records_are_exact(spark, tmpdir_path):
    pages = spark.createDataFrame([(1, "http://a/", "é" * 80), (2, "http://b/", "é" * 80)], "page_id long, url string, html string")
    warc.write_archive(pages, f"{tmpdir_path}/a")
    assert spark.read.parquet(f"{tmpdir_path}/a/payloads").count() == 1
    for r in warc.reconstruct(spark, f"{tmpdir_path}/a").collect():
        head, _, rest = bytes(r.record).partition(b"\r\n\r\n")
        size = int(re.search(rb"Content-Length: (\d+)", head)[1])
        assert head.startswith(b"WARC/1.1\r\n") and len(rest) == size + 4 and rest.endswith(b"\r\n\r\n")
        assert bytes(r.payload) == ("é" * 80).encode()


def test_warc_blocks_have_their_stated_length(spark, tmpdir_path):
    urls = ["http://a/?q=WARC-Type: revisit", "http://b/ WARC-Type: response", "WARC-Type: revisit", "x\r\nWARC-Type: revisit", None]
    rows = [(10 * k + i, u, f"{k}" * 200) for k, u in enumerate(urls) for i in range(2)]
    warc.write_archive(spark.createDataFrame(rows, "page_id long, url string, html string"), f"{tmpdir_path}/b")
    sizes = collections.Counter()
    for r in warc.reconstruct(spark, f"{tmpdir_path}/b").collect():
        head, _, rest = bytes(r.record).partition(b"\r\n\r\n")
        assert len(rest) - 4 == int(re.search(rb"\r\nContent-Length: (\d+)", head)[1])
        sizes[len(rest) - 4] += 1
    assert sizes == {200: len(urls), 0: len(urls)}


# ---------------------------------------------------------------------- tokens

@pytest.mark.parametrize("bits", [1, 3, 8, 11, 16, 17, 32])
def test_bit_packing(bits):
    ids = np.random.default_rng(bits).integers(0, 1 << bits, 1001, dtype=np.uint64).astype(np.uint32)
    packed = token_pack.pack(ids, bits)
    assert len(packed) == -(-1001 * bits // 8)
    assert (token_pack.unpack(packed, 1001, bits) == ids).all()


def test_shard_random_access(tmpdir_path):
    rng = np.random.default_rng(1)
    texts = [(k, rng.integers(0, 49408, n).astype(np.uint32)) for k, n in enumerate([5, 0, 200_000, 7, 70_000])]
    path = f"{tmpdir_path}/x/one.tpk"
    assert token_pack.write_shard(path, iter(texts), 17) == (5, sum(len(t) for _, t in texts))
    shard, every = token_pack.Shard(path), np.concatenate([t for _, t in texts])
    for a, b in [(0, 3), (4, 9), (65_530, 65_540), (131_072, 200_013), (7, 7)]:
        assert (shard.ids(a, b) == every[a:b]).all()
    assert [(d, len(i)) for d, _, i in shard.documents(1000)] == [(k, len(t)) for k, t in texts]


def test_token_pack(spark, tmpdir_path):
    from tokenizers import Tokenizer
    path = P.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    rows = [*TEXTS, (20, "It's <|endoftext|> Hello,world. a,.b 'S ΣΑΣ. x,'s İstanbul.")]
    found = [tuple(r) for r in token_pack.read_tokens(token_pack.write_tokens(
        clashing(spark, rows), f"{tmpdir_path}/t", path, 2)).select("doc_id", "start", "n_tokens", F.crc32("ids")).collect()]
    expected, at = [], 0
    for doc, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        expected.append((doc, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert sorted(found, key=str) == sorted(expected, key=str)
    empty = token_pack.write_tokens(docs(spark).limit(0), f"{tmpdir_path}/e", path, 2)
    assert token_pack.read_tokens(empty).count() == 0


def test_word_encoder_equals_whole_texts():
    rng = random.Random(2)
    pool = [*"abzAZéÉÀÿ×÷ßİıΣσς.,'’!-<|> \t\n\x0b\x85\u0301\u0307가\u1100\u116112中", "'s", "'ll", ". ", ", ", "<|endoftext|>"]
    texts = ["", " ", "é.,è, ×. ÷, ä.b É, İx", "ǆ ﬁ ª.º, K Å", *("".join(rng.choices(pool, k=rng.randint(0, 40))) for _ in range(2000))]
    encoder = token_pack.WordEncoder(P.path("word_bpe_49k.json"), cached_words=400)
    whole = [x.ids for x in encoder.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
    for _ in range(2):  # words are new, then known, then forgotten
        found = [ids.tolist() for k in range(0, len(texts), 50) for ids in encoder.encode(texts[k:k + 50])]
        assert found == whole
    assert encoder.encode([]) == []


def test_words_of_letters_are_encoded_together():
    encoder = token_pack.WordEncoder(P.path("word_bpe_49k.json"))
    plain, given = encoder.tokenizer, []

    class Counted:
        def encode_batch_fast(self, texts, **options):
            given.extend(texts)
            return plain.encode_batch_fast(texts, **options)

    encoder.tokenizer = Counted()
    words = ["".join(w) for w in itertools.product("abcdefghéz", repeat=4)]
    texts = [". ".join(words[k:k + 100]) + "." for k in range(0, len(words), 100)]
    found = [ids.tolist() for ids in encoder.encode(texts)]
    assert found == [plain.encode(x, add_special_tokens=False).ids for x in texts]
    assert len(given) <= 50  # 10,000 words


# --------------------------------------------------------------- decontamination

ITEM = ("A farmer sells 12 apples on monday and 30 apples on tuesday then he gives 12 pears to Maria while "
        "the others weigh 5 kg in the old barn behind the house")


def _held(spark, texts, items):
    pairs = decontaminate.contaminated_pairs(docs(spark, list(enumerate(texts))),
                                             spark.createDataFrame(list(enumerate(items)), "item_id long, text string"))
    return {(r.doc_id, r.item_id, r.reparameterised) for r in pairs.collect()}


def test_decontamination(spark):
    other = ITEM.replace("12", "44").replace("30", "71").replace("Maria", "Jonas").replace("5 kg", "9 miles")
    mixed = "Some words first. " + ITEM.replace("12", "44", 1).replace("30", "3").replace("Maria", "Jo").replace("12", "57").replace("5", "6")
    clean = "The farmer sells many things and no one knows what they weigh or where the house with the barn is today"
    short = "two short words"
    texts = [f"before that {ITEM} after", other, clean, None, "", LONG, ITEM, f"x {short} y", mixed, "7 8 9 10 11 12 13 14 15 16"]
    found = _held(spark, texts, [ITEM, short, None, "", "1 2 3 4 5 6 7 8 9 10"])
    assert (0, 0, False) in found and (6, 0, False) in found and (1, 0, True) in found and (7, 1, False) in found
    assert {d for d, *_ in found} <= {0, 1, 6, 7, 8}
    assert not _held(spark, texts, [])
    assert not _held(spark, [], [ITEM])


def test_slots_must_be_consistent(spark):
    item = " ".join(f"alpha beta gamma {n} delta" for n in [7] * 8)
    same = item.replace("7", "9")
    torn = " ".join(f"alpha beta gamma {n} delta" for n in range(10, 18))
    assert {(d, i) for d, i, _ in _held(spark, [same, torn], [item])} == {(0, 0)}


def test_equal_values_in_different_roles(spark):
    balls = "a bag holds {} red balls and {} blue balls so there are {} in total"
    once = ("everyone who came early to the old market could see how the men put all of their bread on a table "
            "where we count {} boxes and we count {} boxes and {} bags")
    texts = [balls.format(3, 7, 10), once.format(12, 13, 30), once.format(12, 12, 30), once.format(1, 2, 3)]
    found = _held(spark, texts, [balls.format(5, 5, 10), once.format(12, 12, 30)])
    assert found == {(0, 0, True), (1, 1, True), (2, 1, False), (3, 1, True)}


def test_windows_poor_in_words_are_found_verbatim(spark):
    sums = "Compute 12 * 34 + 56 - 78 * 9"
    row = "It was 3 kg 14 lb 15 oz 92 g 65 mg 35 km 89 m 79 cm then"
    texts = [sums, f"He wrote, {sums} and left", sums.replace("34", "35"), row, row.replace("9", "8")]
    found = _held(spark, texts, [sums, row])
    assert found == {(0, 0, False), (1, 0, False), (3, 1, False)}


# ------------------------------------------------------------------- line dedup

def _dedup(rows):
    strip = " \t\n\x0b\x0c\r"
    lower = {c: c + 32 for c in range(65, 91)}
    key = lambda x: x.strip(strip).translate(lower)
    holders = collections.defaultdict(set)
    for doc, text in rows:
        for line in (text or "").split("\n") if doc is not None else []:
            holders[key(line)].add(doc)
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        left = [x for x in lines if doc is None or len(key(x)) < 10 or min(holders[key(x)]) == doc]
        out.append((doc, len(lines), len(lines) - len(left), "\n".join(left)))
    return sorted(out, key=str)


def test_line_dedup(spark):
    rng = random.Random(4)
    lines = [f"line number {k} of the lot" for k in range(30)] + ["short", "", "É" * 10, "É" * 9]
    rows = TEXTS + [(100 + k, "\n".join(rng.choices(lines, k=rng.randint(1, 30)))) for k in range(60)]
    found = line_dedup.dedup_lines(docs(spark, rows))
    assert sorted(((r.doc_id, r.n_lines, r.n_dropped, r.text or "") for r in found.collect()), key=str) == _dedup(rows)
    assert line_dedup.dedup_lines(docs(spark).limit(0)).count() == 0
    wide = line_dedup.dedup_lines(clashing(spark))
    assert {r.score for r in wide.collect()} == {"kept"} and dict(wide.dtypes)["n_lines"] == "bigint"
    staged = line_dedup.pipeline_stage(spark, clashing(spark), "")
    assert staged.columns == clashing(spark).columns
    assert all(r.n_chars == len(r.text or "") for r in staged.collect() if r.n_chars is not None)


def test_stage_drops_emptied_documents(spark):
    rows = [(1, f"{LINE}\n{LINE}"), (2, LINE), (3, f"{LINE}\n\n "), (4, f"{LINE}\nmore"), (5, ""), (6, None), (7, " \n"), (None, LINE), (1, LINE)]
    found = line_dedup.pipeline_stage(spark, clashing(spark, rows), "").collect()
    assert sorted(((r.doc_id, r.text) for r in found), key=str) == sorted(
        [(1, f"{LINE}\n{LINE}"), (4, "more"), (5, ""), (6, None), (7, " \n"), (None, LINE), (1, LINE)], key=str)
    assert line_dedup.dedup_lines(docs(spark, rows)).count() == len(rows)


def test_minimal_perfect_hash():
    a, b = (np.random.default_rng(k).integers(0, 1 << 63, 20_000, dtype=np.uint64) for k in (1, 2))
    hashed = line_dedup.MinimalPerfectHash.build(a, b)
    assert sorted(hashed.slots(a, b)) == list(range(20_000))
    assert line_dedup.MinimalPerfectHash.build(a[:0], b[:0]).size == 0


# ------------------------------------------------------------------- URL lists

def test_url_lists(spark):
    at = lambda s: F.to_timestamp(F.lit(s))
    events = [("spam", "block", "bad.org", "add", "2024-01-10"), ("spam", "block", "bad.org", "remove", "2024-03-05"),
              ("spam", "block", "bad.org", "add", "2024-06-01"), ("spam", "block", "bad.org", "add", "2024-06-01"),
              ("ok", "allow", "www.bad.org/good", "add", "2024-01-01"), ("x", "block", None, "add", "2024-01-01"),
              ("x", "block", "gone.org", "add", "2024-02-01"), ("x", "block", "gone.org", "remove", "2024-02-01")]
    entries = spark.createDataFrame([(*e, "c") for e in events], "list string, rule string, pattern string, action string, at string, url string") \
        .withColumn("at", F.to_timestamp("at"))
    fetched = [(1, "http://bad.org/", "2024-01-09"), (2, "https://WWW.bad.org:80/x", "2024-01-10"), (3, "http://bad.org", "2024-03-05"),
               (4, "http://u@www.bad.org/good/deep?q", "2024-02-02"), (5, "http://sub.bad.org", "2025-06-01"), (6, None, "2024-02-01"),
               (7, "not a url", "2024-02-01"), (8, "http://bad.org", None), (9, "http://gone.org", "2024-02-03"),
               (5, "http://sub.bad.org", "2025-06-01"), (10, "http://notbad.org", "2024-02-01"), (11, "http://bad.org", "2024-03-04")]
    captures = spark.createDataFrame([(*c, "z") for c in fetched], "page_id long, url string, fetched_at string, list string") \
        .withColumn("fetched_at", F.to_timestamp("fetched_at"))
    found = {r.page_id: (r.blocked, r.pattern) for r in url_lists.judge_captures(captures, entries).collect()}
    blocked = (True, "bad.org")
    assert found == {1: (False, None), 2: blocked, 3: (False, None), 4: (False, "www.bad.org/good"), 5: blocked, 6: (False, None),
                     7: (False, None), 8: (False, None), 9: (False, None), 10: (False, None), 11: blocked}
    assert url_lists.judge_captures(captures.limit(0), entries).count() == 0
    assert not any(r.blocked for r in url_lists.judge_captures(captures, entries.limit(0)).collect())


def test_deep_url_patterns(spark):
    deep = "www.bad.org/a/b/c/d/e"
    entries = spark.createDataFrame(
        [("spam", "block", "www.bad.org/a/b/c/d", "add", "2024-01-01"), ("ok", "allow", deep, "add", "2024-01-01")],
        "list string, rule string, pattern string, action string, at string").withColumn("at", F.to_timestamp("at"))
    captures = spark.createDataFrame(
        [(1, "http://www.bad.org/a/b/c/d"), (2, f"http://{deep}/f/g?q"), (3, "http://www.bad.org/a/b/c"),
         (4, "http://www.bad.org//a/b//c/d/x")], "page_id long, url string").withColumn("fetched_at", F.to_timestamp(F.lit("2024-02-01")))
    found = {r.page_id: (r.blocked, r.pattern) for r in url_lists.judge_captures(captures, entries).collect()}
    blocked = (True, "www.bad.org/a/b/c/d")
    assert found == {1: blocked, 2: (False, deep), 3: (False, None), 4: blocked}


# ------------------------------------------------------------------ classifier

def _labelled(n):
    rng = random.Random(7)
    good = lambda: " ".join("".join(rng.choices("aeioulnrst", k=rng.randint(2, 7))) for _ in range(60)).capitalize() + "."
    bad = [lambda: " ".join(w + "$$$" for w in good().split()), lambda: good().upper().replace(" ", "!! "),
           lambda: " ".join([good().split()[3]] * 60)]
    rows = [(k, good() if k % 3 else rng.choice(bad)(), int(k % 3 > 0)) for k in range(n)]
    return rows


def test_quality_classifier(spark):
    rows = _labelled(600)
    texts = docs(spark, [(k, t) for k, t, _ in rows] + [(None, "Some words."), (1000, None), (1001, ""), (1002, LONG)])
    labels = spark.createDataFrame([(k, y) for k, _, y in rows] + [(5000, None), (None, 1)], "doc_id long, quality int")
    weights = quality_classifier.train(texts, labels)
    scored = {r.doc_id: r.score for r in quality_classifier.score_texts(texts, weights).collect()}
    held = [(scored[k], y) for k, _, y in rows if zlib.crc32(str(k).encode()) % 4 == 2]
    assert np.mean([(s >= 0.7) == y for s, y in held]) > 0.97
    assert all(0 <= s <= 1 for s in scored.values()) and scored[1000] == scored[1001]
    assert quality_classifier.train(texts, labels.limit(0)) is None
    assert {r.score for r in quality_classifier.score_texts(texts, None).collect()} == {0.5}
    wide = quality_classifier.score_texts(clashing(spark), weights)
    assert dict(wide.dtypes)["score"] == "double" and wide.count() == len(TEXTS)


def test_held_out_rows_are_never_learned(spark):
    rows = _labelled(60)
    sample = quality_classifier.labelled_sample(docs(spark, [(k, str(k)) for k, *_ in rows]),
                                                spark.createDataFrame([(k, y) for k, _, y in rows], "doc_id long, quality int"))
    assert not [r for r in sample.collect() if zlib.crc32(r.text.encode()) % 4 == 2]


# ------------------------------------------------------------------------- PII

BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def _luhn(digits):
    return sum(sum(divmod(int(c) * (1 + k % 2), 10)) for k, c in enumerate(reversed(digits))) % 10 == 0


def _base(text):
    out = []
    for place, (kind, pattern) in enumerate(BASE.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and max(int(p) for p in m[0].split(".")) > 255 or \
                    kind == "card" and not (14 <= len(digits) <= 19 and _luhn(digits)) or \
                    kind == "phone" and not 10 <= len(digits) <= 15:
                continue
            out.append((m.start(), place, kind, m.end()))
    return [f"{k}:{a}:{b}" for a, _, k, b in sorted(out)]


def test_personal_data_patterns(spark):
    rng = random.Random(3)
    parts = ["1", "23", "4111 1111 1111 1111", "4111-1111-1111-1111", "+1 ", ".", "@", "a@b.c%d", "%", " ", "-", "255", "256",
             "000000000300.1.1.1", "192.168.1.1", "x@y.zz", "(5)", "é", "+49-30-1234567 ", "ab@cd.e-f.g.", "😀"]
    rows = [(k, "".join(rng.choices(parts, k=rng.randint(0, 40)))) for k in range(800)] + TEXTS
    rows += [(5000, "1" * 60_000), (5001, "a" * 60_000), (5002, "a@" + "b." * 20_000), (5003, "+1" + " " * 50_000), (5004, "1.2." * 9000)]
    found = pii.find_base(docs(spark, rows))
    text = {(d, ",".join(_base(t))) for d, t in rows}
    assert {(r.doc_id, ",".join(f"{s.kind}:{s.start}:{s.end}" for s in r.spans)) for r in found.collect()} == text


def test_revealing_terms(spark):
    rng = random.Random(9)
    word = lambda: "".join(rng.choices("abcdefgh", k=6))
    rows = [(k, f"{word()} {word()} the Zanzibar office of {word()} wrote jo@corp.org about the {word()} {word()}") for k in range(6)]
    rows += [(10 + k, f"the {word()} of the {word()} {word()}") for k in range(40)]
    rows += [(60, "Zanzibar is far, write to jo@corp.org. ZANZIBAR!"), (61, None), (None, "x"), (62, "")]
    found = {r.doc_id: r for r in pii.find_personal_data(docs(spark, rows)).collect()}
    at = rows[0][1].index("Zanzibar")
    assert (at, at + 8) in {(t.start, t.end) for t in found[0].terms}
    assert {rows[46][1][t.start:t.end] for t in found[60].terms} >= {"Zanzibar", "ZANZIBAR"}
    assert not [t for t in found[0].terms if rows[0][1][t.start:t.end] == "the"]
    assert not found[10].terms and not found[None].terms
    clean = {r.doc_id: r.sanitised for r in pii.sanitise(docs(spark, rows), pii.find_personal_data(docs(spark, rows))).collect()}
    assert "jo@corp.org" not in clean[0] and "Zanzibar" not in clean[0] and "[EMAIL]" in clean[0]
    assert clean[10] == rows[6][1]
    assert pii.find_personal_data(docs(spark).limit(0)).count() == 0


def _words_of(row, rows):
    return {dict(rows)[row.doc_id][t.start:t.end] for t in row.terms}


def test_terms_count_texts_not_surroundings(spark):
    """Many texts with one context give a term; mentions in one text do not."""
    rows = [(k, f"item{k} {'filler ' * 20} the Quagmire desk, jo@corp.org, answers {'filler ' * 20}") for k in range(30)]
    rows += [(100 + k, f"the filler desk answers number {k}") for k in range(300)]
    once = "; ".join(f"{w * 9} Umbrage jim@corp.org {w * 9}" for w in "abcd")
    rows += [(500, once)]
    found = {r.doc_id: r for r in pii.find_personal_data(docs(spark, rows)).collect()}
    assert all("Quagmire" in _words_of(found[k], rows) for k in range(30))
    assert not found[500].terms


def test_terms_anywhere_in_the_text(spark):
    """Brute force over whole texts, copies and words inside base spans too."""
    rng = random.Random(12)
    people = {f"p{k}@corp{k}.org": [f"name{k}", f"office{k}", f"corp{k}"] for k in range(5)}
    common = [f"w{'abcdefghij'[k % 10]}{'abcdefghij'[k // 10]}" for k in range(60)]
    rows = []
    for k in range(260):
        words = rng.choices(common, k=rng.randint(60, 120))
        for mail in rng.sample(sorted(people), rng.choice([0, 0, 0, 1, 2])):
            words = [w for w in people[mail] if rng.random() < 0.9] + words + [mail]
        rows.append((k, " ".join(words).capitalize()))
    rows += [(1000 + k, rows[k % 9][1]) for k in range(40)] + [rows[3], (None, rows[4][1])]
    texts = [(set(re.findall(r"[a-z0-9.]+@[a-z0-9.]+", t.lower())),
              set(re.findall(r"\w{3,}", re.sub(r"\S+@\S+", " ", t.lower())))) for t in {t for _, t in rows}]
    expected = {}
    for mail, term in {(m, w) for ms, ws in texts for m in ms for w in ws}:
        n_c, n_t = sum(mail in m for m, _ in texts), sum(term in w for _, w in texts)
        n_tc = sum(mail in m and term in w for m, w in texts)
        share = np.log(len(texts) * n_tc / (n_t * n_c)) / np.log(len(texts) / n_c)
        if n_tc >= 3 and share >= 0.9:
            expected[f"email:{mail}", term] = share
    frame = docs(spark, rows)
    found = {(r.entity, r.term): r.disclosure for r in pii.revealing_terms(pii.find_base(frame), frame).collect()}
    assert len(expected) > 8 and found == pytest.approx(expected)
    for r in pii.find_personal_data(frame).where("doc_id is not null").collect():
        text = dict(rows)[r.doc_id]
        assert _words_of(r, rows) == {w for w in re.findall(r"\w+", re.sub(r"\S+@\S+", " ", text)) if any(
            (f"email:{m}", w.lower()) in expected for m in re.findall(r"\S+@\S+", text.lower()))}


# -------------------------------------------------------------------- Jaccard

def _components(rows, n, p, q):
    def shingles(text):
        words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
        return {tuple(words[i:i + n]) for i in range(len(words) - n + 1)} if len(words) >= n else {tuple(words)} - {()}
    sets = [(d, shingles(t)) for d, t in rows]
    parent = {d: d for d, _ in rows if d is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for (a, s), (b, t) in itertools.combinations([x for x in sets if x[0] is not None and x[1]], 2):
        if q * len(s & t) >= p * len(s | t):
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    return sorted(((d, len(s), None if d is None else root(d)) for d, s in sets), key=str)


@pytest.mark.parametrize("n, p", [(4, 85), (5, 80)])
def test_jaccard_join(spark, n, p):
    rng = random.Random(p)
    vocabulary = [f"w{k}" for k in range(400)]
    shared = rng.choices(vocabulary, k=40)
    rows = list(TEXTS)
    for group in range(6):
        words = rng.choices(vocabulary, k=rng.randint(6, 160))
        for _ in range(14):
            mine = list(words)
            for _ in range(rng.randint(0, max(1, len(words) // 30))):
                mine[rng.randrange(len(mine))] = rng.choice(vocabulary)
            if rng.random() < 0.3:
                mine += shared
            rows.append((100 + len(rows), " ".join(mine)))
    found = jaccard_join.jaccard_components(clashing(spark, rows), n=n, p=p, q=100)
    assert sorted((tuple(r) for r in found.collect()), key=str) == _components(rows, n, p, 100)


def test_large_groups_in_blocks(spark, monkeypatch):
    """Groups of many blocks whose members link only through some others."""
    monkeypatch.setattr(jaccard_join, "BLOCK", 4)
    monkeypatch.setattr(jaccard_join, "WIDE_BLOCK", 8)
    monkeypatch.setattr(jaccard_join, "MAP_BLOCK", 16)
    rng = random.Random(5)
    words = [f"w{k}" for k in range(60)]
    rows = []
    for k in range(60):
        if k % 10 == 0:
            words = list(words)
            words[rng.randrange(60)] = f"n{k}"
        mine = list(words)
        mine[rng.randrange(60)] = f"m{k}"
        rows.append((k, " ".join(mine)))
    found = jaccard_join.jaccard_components(docs(spark, rows))
    assert sorted((tuple(r) for r in found.collect()), key=str) == _components(rows, 4, 85, 100)


def test_near_copy_stage(spark):
    assert jaccard_join.jaccard_components(docs(spark).limit(0)).count() == 0
    kept = jaccard_join.pipeline_stage(spark, clashing(spark), "")
    assert kept.columns == clashing(spark).columns
    ids = sorted(str(r.doc_id) for r in kept.collect())
    assert ids.count("5") == 1 and "12" not in ids and {"None", "1", "3", "4"} <= set(ids)


def test_connected_components(spark):
    rng = random.Random(2)
    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(k, k + 1) for k in range(400, 480)] + [(None, 3), (5, None)]
    found = dict(tuple(r) for r in components.connected_components(spark.createDataFrame(pairs, "a long, b long")).collect())
    parent = {}
    for a, b in pairs:
        if a is not None and b is not None and a != b:
            x, y = (next(iter([r for r in [v] if r is not None])) for v in (a, b))
            group = parent.get(x, {x}) | parent.get(y, {y})
            for v in group:
                parent[v] = group
    assert found == {v: min(g) for v, g in parent.items()}


# -------------------------------------------------------------- SentencePiece

def test_sentencepiece(spark):
    import sentencepiece
    path = P.path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    rng = random.Random(5)
    fuzz = ["".join(rng.choices("aeiouthnsr  \n.,'-_/é日😀0123ABC", k=rng.randint(1, 60))) for _ in range(600)]
    texts = [t for _, t in TEXTS] + fuzz + [" " * k + "x" + " " * k for k in range(1, 40)] + ["▁a ▁▁b"]
    rows = clashing(spark, list(enumerate(texts)))
    encoded = {r.doc_id: r for r in sentencepiece_fst.encode_texts(rows, path).collect()}
    assert all(encoded[k].ids == library.encode(t or "") for k, t in enumerate(texts))
    decoded = sentencepiece_fst.decode_ids(sentencepiece_fst.encode_texts(docs(spark, list(enumerate(texts))), path), path)
    assert all(r.decoded == (r.text or "").replace("▁", " ") for r in decoded.collect())
    both = {r.doc_id: r for r in sentencepiece_fst.encoded_documents(rows).collect()}
    assert all(r.round_trip and r.ids == encoded[k].ids and r.n_ids == len(r.ids) for k, r in both.items())
    assert sentencepiece_fst.encoded_documents(docs(spark).limit(0)).count() == 0


# --------------------------------------------------------------- quality rules

def test_quality_rules(spark):
    rng = random.Random(8)
    common = ("the", "of", "and", "to", "in", "a", "is", "that", "for", "it", "as", "was", "with", "be", "by", "on")
    good = lambda: " ".join(rng.choice([rng.choice(common), "".join(rng.choices("aeioulnrst", k=6))]) for _ in range(300)) + ".\n"
    rows = [(k, good(), "en") for k in range(30)] + [(40, "Words| ".join(good().split()), "en"), (41, good().upper(), "en"),
                                                    (42, "the cat sat " * 40, "en"), (43, "é" * 900, None)]
    rows += [(d, t, None if d in (1, 6) else "xx") for d, t in TEXTS]
    found = quality_rules.judge_texts(docs(spark, [(*r, "kept") for r in rows], f"{DOCS}, lang string, kept string")).collect()
    expected = collections.Counter()
    for _, text, _ in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        triples = collections.Counter(zip(words, words[1:], words[2:], strict=False))
        marked = {i + j for i, t in enumerate(zip(words, words[1:], words[2:], strict=False)) if triples[t] > 1 for j in range(3)}
        lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        expected[(len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)),
                  len(marked), len(words) < 50 or 100 * len(marked) > 50 * len(words))] += 1
    assert collections.Counter((r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
                               for r in found) == expected
    kept = {r.doc_id: r.kept for r in found if r.doc_id is not None}
    assert all(kept[k] for k in range(20, 30)) and not kept[41] and not kept[42] and not kept[40]
    assert quality_rules.judge_texts(docs(spark, [], f"{DOCS}, lang string")).count() == 0


def test_repeated_windows_are_found_in_one_pass_of_hashes(spark):
    texts = ["", "a", "a a", "a a a", "a a a a", "b a b a", "b a b a b", "a b c x a b c", " a b\tc d\na b c ", "a b c b c",
             "x y z " * 30, "K \u212a k \u212a K \u212a k"]
    counts = quality_rules.text_counts(docs(spark, [(k, t, "en") for k, t in enumerate(texts)], f"{DOCS}, lang string"))
    found = {r.doc_id: (r.n_words, r.n_repeat_words) for r in counts.collect()}
    for k, text in enumerate(texts):
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        windows = list(zip(words, words[1:], words[2:], strict=False))
        marked = {i + j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(3)}
        assert found[k] == (len(words), len(marked))
    plan = counts._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("xxhash64(") == 1 and "array_sort(" not in plan  # array_sort compares by a lambda


def _plain_rules(rows):
    """{position: (char distance, word distance, kept)} of (id, text, lang) rows, from plain counts."""
    R = quality_rules
    split = lambda t: re.findall(r"[^\x20\x09-\x0D]+", t or "")
    held = collections.defaultdict(collections.Counter)
    for _, text, lang in rows:
        words = split((text or "").lower())
        if len(words) >= R.MIN_WORDS:
            held[lang].update(w for w in set(words) if all(unicodedata.category(c)[0] == "L" for c in w))
    common = {g: [w for w, _ in sorted(c.items(), key=lambda x: (-x[1], x[0]))[:R.COMMON_WORDS]] for g, c in held.items() if c}
    found = []
    for _, text, lang in rows:
        text, words = text or "", split(text)
        n_chars, in_words = len(text), len("".join(words))
        classes = [sum(map(len, re.findall(c, text))) for c in R.CLASSES]
        triples = collections.Counter(zip(words, words[1:], words[2:], strict=False))
        marked = {i + j for i, t in enumerate(zip(words, words[1:], words[2:], strict=False)) if triples[t] > 1 for j in range(3)}
        failed = len(words) < 50 or 100 * len(marked) > 50 * len(words)
        chars = [x / in_words for x in (*classes, max(0, in_words - sum(classes)))] if in_words else None
        own = None
        if lang in common and words:
            met = collections.Counter(w.lower() for w in words)
            counts = [met[w] for w in common[lang]]
            own = [x / len(words) for x in (*counts, max(0, len(words) - sum(counts)))]
        found.append((lang, n_chars, len(words), chars, own, failed))

    def reference(which, at):
        out = []
        for column in zip(*(f[at] for f in which), strict=True):
            bins = sorted(math.floor(x * R.BINS) for x in column)
            out.append(bins[(len(bins) + 1) // 2 - 1] / R.BINS)
        return [x / sum(out) for x in out] if sum(out) else None

    def distance(p, q):
        if p is None or q is None:
            return None
        part = lambda a, b: a * math.log2(2 * a / (a + b)) if a > 0 else 0.0
        return math.sqrt(max(0.0, sum(part(a, b) + part(b, a) for a, b in zip(p, q, strict=True)) / 2))

    passed = [f for f in found if not f[5] and f[1] >= R.MIN_CHARS]
    by_lang = {g: [f for f in passed if f[0] == g] for g in {f[0] for f in passed}}
    overall, out = reference(passed, 3) if passed else None, {}
    for at, (lang, n_chars, n_words, chars, own, failed) in enumerate(found):
        here = by_lang.get(lang)
        c = distance(chars, reference(here, 3) if here else overall)
        w = distance(own, reference(here, 4)) if here and own else None
        bad = failed or (c is not None and n_chars >= R.MIN_CHARS and c > R.CHAR_LIMIT + R.CHAR_NOISE * math.sqrt(6 / n_chars)) or (
            w is not None and n_words >= R.MIN_WORDS and w > R.WORD_LIMIT + R.WORD_NOISE * math.sqrt(len(own) / n_words))
        out[at] = (None if c is None else round(c, 6), None if w is None else round(w, 6), not bad)
    return out


def test_distances_and_verdicts_equal_plain_rules(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang").collect()
    rows = [tuple(r) for r in table] + [(k, t, g) for k, t in TEXTS for g in ("en", "xx", None)]
    found = quality_rules.judge_texts(docs(spark, rows, f"{DOCS}, lang string")).collect()
    rounded = lambda x: None if x is None else round(x, 6)
    got = collections.Counter((r.doc_id, r.lang, rounded(r.char_distance), rounded(r.word_distance), r.kept) for r in found)
    want = collections.Counter((rows[at][0], rows[at][2], *v) for at, v in _plain_rules(rows).items())
    near = lambda x, y: all(a == b or (isinstance(a, float) and isinstance(b, float) and abs(a - b) < 2e-6) for a, b in zip(x, y, strict=True))
    key = lambda x: (str(x[0]), str(x[1]), str(x[4]), x[2] or -1.0, x[3] or -1.0)
    assert all(near(a, b) for a, b in zip(sorted(got.elements(), key=key), sorted(want.elements(), key=key), strict=True))


def _plain_ftrl(rows, weights, squares):
    R = quality_classifier
    z = [-w * ((R.BETA + math.sqrt(n)) / R.ALPHA + R.L2) - (w > 0) * R.L1 + (w < 0) * R.L1 for w, n in zip(weights, squares, strict=True)]
    n = list(squares)
    weight = lambda i: 0.0 if abs(z[i]) <= R.L1 else -(z[i] - math.copysign(R.L1, z[i])) / ((R.BETA + math.sqrt(n[i])) / R.ALPHA + R.L2)
    for slots, values, label in rows:
        w = [weight(i) for i in slots]
        p = 1 / (1 + math.exp(-max(-35, min(35, sum(a * b for a, b in zip(w, values, strict=True))))))
        for i, own, x in zip(slots, w, values, strict=True):
            g = (p - label) * x
            z[i] += g - (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / R.ALPHA * own
            n[i] += g * g
    return [weight(i) for i in range(len(z))], n


def test_ftrl_equals_a_plain_loop():
    rng = np.random.default_rng(3)
    rows = [(rng.choice(40, 6, replace=False), rng.random(6), float(rng.integers(2))) for _ in range(200)]
    weights, squares = np.zeros(40), np.zeros(40)
    for _ in range(2):
        plain = _plain_ftrl(rows, weights.tolist(), squares.tolist())
        weights, squares = quality_classifier.ftrl(rows, weights, squares)
        assert np.allclose(weights, plain[0]) and np.allclose(squares, plain[1])


def test_sample_is_bounded_by_rows(spark):
    rows = [(7, f"text {k}") for k in range(500)] + [(k, "other") for k in range(100, 400)] + [(None, "x")]
    labels = spark.createDataFrame([(7, 1), (7, 0), *[(k, 1) for k in range(100, 400)], (999, 1), (None, 1)], "doc_id long, quality int")
    for bound in (1, 50, 10_000):
        sample = quality_classifier.labelled_sample(docs(spark, rows), labels, bound).collect()
        known = [k for k in (7, *range(100, 400)) if zlib.crc32(str(k).encode()) % 4 != 2]
        assert len(sample) == min(bound, len(known))
    assert ("text 0", 0.0) in {(r.text, r.label) for r in sample} or zlib.crc32(b"7") % 4 == 2


def test_classifier_stage_without_labels_keeps_all(spark, tmpdir_path):
    spark.createDataFrame([], "doc_id long, quality int").write.parquet(f"{tmpdir_path}/labels.parquet")
    kept = quality_classifier.pipeline_stage(spark, clashing(spark), tmpdir_path)
    assert kept.columns == clashing(spark).columns and kept.count() == len(TEXTS)


def test_many_matches_in_one_text_take_linear_time(spark):
    import time
    text = " ".join(f"{k:07d}" for k in range(100_000)) + " " + " ".join(f"user{k}@mail{k}.example.org" for k in range(10_000))
    started = time.monotonic()
    found = pii.find_base(docs(spark, [(1, text)])).select("spans").first().spans
    assert len(found) == 10_000 and time.monotonic() - started < 60
    assert [(s.start, s.end) for s in found] == [m.span() for m in re.finditer(r"user\d+@mail\d+\.example\.org", text)]


def test_sanitised_texts_of_many_spans(spark):
    rng = random.Random(12)
    texts = [" ".join(rng.choice(["a@b.co", "10.0.0.1", "word", "+49 151 12345678", "é", "4111 1111 1111 1111"]) for _ in range(n)) for n in (0, 1, 5, 700)]
    rows = [(k, t) for k, t in enumerate(texts)] + [(9, None)]
    found = pii.find_personal_data(docs(spark, rows))
    clean = {r.doc_id: r.sanitised for r in pii.sanitise(docs(spark, rows), found).collect()}
    digests = {r.doc_id: r.sanitised_sha256 for r in found.collect()}
    for k, text in rows:
        out, at = [], 0
        for kind, start, end in (x.split(":") for x in _base(text)):
            if int(start) >= at:
                out.append(text[at:int(start)] + f"[{kind.upper()}]")
            at = max(at, int(end))
        want = "".join(out) + (text or "")[at:]
        assert clean[k] == want and digests[k] == hashlib.sha256(want.encode()).hexdigest()


def test_short_items_convict_only_texts_that_are_nothing_else(spark):
    rows = [(1, "the"), (2, "the cat and the dog"), (3, "The."), (4, "two words"), (5, "two words more")]
    items = spark.createDataFrame([(1, "the"), (2, "two words")], "item_id long, text string")
    got = decontaminate.contaminated_pairs(docs(spark, rows), items).collect()
    assert {(r.doc_id, r.item_id) for r in got} == {(1, 1), (3, 1), (4, 2)}


def test_host_forms(spark):
    import datetime as dt
    at = dt.datetime(2024, 1, 1)
    urls = ["http://bad.org./x", "http://BAD.org/", "http://u@[2001:DB8::1]:8080/a", "http://ok.org/", "http://Bad2.org./P/q", "http://[", "//x"]
    pages = spark.createDataFrame([(k, u, dt.datetime(2024, 2, 1)) for k, u in enumerate(urls)], "page_id long, url string, fetched_at timestamp")
    lists = spark.createDataFrame([("l", "block", p, "add", at) for p in ("bad.org", "BAD2.org./P", "[2001:db8::1]")],
                                  "list string, rule string, pattern string, action string, at timestamp")
    got = {r.page_id: (r.blocked, r.host) for r in url_lists.judge_captures(pages, lists).collect()}
    assert got == {0: (True, "bad.org"), 1: (True, "bad.org"), 2: (True, "[2001:db8::1]"), 3: (False, "ok.org"), 4: (True, "bad2.org"),
                   5: (False, None), 6: (False, None)}


def test_tiles_of_a_cluster_are_dealt_apart(spark):
    """The bitmaps' tiles go to tasks by the tile, not by the cluster that their rows were joined on."""
    rows = spark.createDataFrame([(1, k, 5, k % 3, 0) for k in range(50)], "cluster long, id long, size long, label long, main long")
    texts = docs(spark, [(k, "a b c d e f") for k in range(50)]).select(F.col("doc_id").alias("id"), "text")
    plan = jaccard_join._tightened(rows, texts, 4, 85, 100)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"FlatMapGroupsInArrow \[tile#\d+\]", plan) and re.search(r"hashpartitioning\(tile#\d+", plan)
