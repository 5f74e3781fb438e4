"""The pipeline's stages against plain Python, each on what its predecessor kept."""

import collections
import hashlib
import itertools
import random
import re

import pytest
import regex
from pyspark.sql import functions as F

import corpus_pipeline
from tessera.llm import decontaminate as D

SF = "/root/testdata/sf0.001"
SPACE = " \t\n\x0b\x0c\r"


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


# ------------------------------------------------------------------ line dedup

def plain_line_dedup(rows):
    """{id: text} of (id, text) rows: lines of at least 10 code points that an
    earlier id holds go, and documents that lose all they had."""
    holders = collections.defaultdict(set)
    keyed = {i: [(line, lower(line.strip(SPACE))) for line in (t or "").split("\n")] for i, t in rows}
    for i, lines in keyed.items():
        for _, key in lines:
            holders[key].add(i)
    out = {}
    for i, t in rows:
        kept = [line for line, key in keyed[i] if len(key) < 10 or min(holders[key]) == i]
        text = "\n".join(kept)
        if len(kept) == len(keyed[i]) or text.strip(SPACE):
            out[i] = text
    return out


# --------------------------------------------------------------- Jaccard groups

def plain_jaccard(rows, n=5, p=80):
    sets = {}
    for i, t in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", lower(t or ""))
        sets[i] = {tuple(words[k:k + n]) for k in range(max(1, len(words) - n + 1))} if words else set()
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in itertools.combinations(sets, 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= p * len(sets[a] | sets[b]):
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    return {i for i in sets if root(i) == i}


# ------------------------------------------------------------- decontamination

def plain_tokens(text):
    t = (text or "").replace("\x01", " ")
    t = regex.sub(r"(?<=[0-9])[.,](?=[0-9])", "_", t)
    t = regex.sub(r"(?<=[\p{Ll}\p{N},;:] )\p{Lu}[\p{Ll}\p{M}]++(?![\p{L}\p{N}])", lambda m: "\x01p" + m[0], t)
    t = regex.sub(rf"([0-9]) ?({'|'.join(D.UNITS)})(?![\p{{L}}\p{{N}}])", lambda m: f"{m[1]} \x01u{m[2]}", t)
    t = regex.sub(r"(?<![\p{L}\p{N}_])[0-9][0-9_]*+", lambda m: " \x01n" + m[0], t)
    return [x for x in regex.split(r"[^\p{L}\p{M}\p{N}_\x01]+", t.lower()) if x]


def plain_pairs(docs, items):
    """{(doc, item): (covered, n_slots, reparameterised)} by looking at every window of every pair."""
    slot = lambda t: t.startswith("\x01")
    template = lambda ts: [t[:2] if slot(t) else t for t in ts]
    items = {i: plain_tokens(t) for i, t in items}
    items = {i: t for i, t in items.items() if t}
    poor = lambda ts: sum(not slot(t) for t in ts) < min(D.MIN_WORDS, -(-len(ts) // 2))
    found = {}
    for (d, text), (i, item) in itertools.product(docs, items.items()):
        doc, n = plain_tokens(text), min(len(item), D.WINDOW)
        if len(item) < D.MIN_ITEM and len(doc) != len(item):
            continue
        shapes = template(item)
        key = lambda ts: ("v", *[t[2:] if slot(t) else t for t in ts]) if poor(ts) else ("t", *template(ts))
        at_key = collections.defaultdict(list)
        for a in range(len(item) - n + 1):
            at_key[key(item[a:a + n])].append(a)
        shifts = collections.defaultdict(set)
        for b in range(len(doc) - n + 1):
            for a in at_key.get(key(doc[b:b + n]), ()):
                shifts[b - a].add(a)
        for shift, at in shifts.items():
            covered = lambda starts: len({x for a in starts for x in range(a, a + n)})  # noqa: E731, B023
            enough = lambda c: c >= D.MIN_COVERAGE * len(item) or c >= D.MIN_TOKENS  # noqa: E731, B023
            if not enough(covered(at)):
                continue
            pairs = [(x, item[x], (tuple(shapes[max(0, x - 2):x]), tuple(shapes[x + 1:x + 3])), doc[x + shift])
                     for x in range(len(item)) if slot(item[x]) and any(a <= x < a + n for a in at)]
            changed = [x for x, value, _, there in pairs if value != there]
            one = lambda *c: len({tuple(p[k] for k in c) for p in pairs}) >= D.MIN_CONSISTENT * len({tuple(p[k] for k in (*c, 3)) for p in pairs})  # noqa: E731, B023
            verbatim = [a for a in at if not any(a <= x < a + n for x in changed)]
            if not any(map(slot, item)) or one(1) or one(1, 2) or enough(covered(verbatim)):
                found[d, i] = max(found.get((d, i), (0, 0, False)), (covered(at), len(pairs), bool(changed)))
    return found


def test_decontamination_equals_every_window_of_every_pair(spark):
    rng = random.Random(21)
    words = ["apple", "river", "stone", "quick", "small", "house", "seven", "blue", "runs", "over", "with", "near"]
    bits = [lambda: rng.choice(words), lambda: str(rng.randrange(30)), lambda: rng.choice(["Anna", "Bob", "Carla"]),
            lambda: f"{rng.randrange(9)} {rng.choice(['kg', 'km', 'hours'])}", lambda: "1,234.5"]
    make = lambda n, odd: " ".join(rng.choice(bits if rng.random() < odd else bits[:1])() for _ in range(n))
    items = [(i, make(rng.choice([1, 2, 3, 5, 9, 14, 25, 40]), rng.choice([0, 0.3, 0.9]))) for i in range(40)] + [(90, ""), (91, None)]
    docs = []
    for d in range(150):
        item = rng.choice(items[:40])[1].split(" ")
        for _ in range(rng.choice([0, 0, 1, 2, 6])):
            k = rng.randrange(len(item))
            item[k] = rng.choice(bits)() if rng.random() < 0.6 else item[k]
        lo = rng.randrange(max(1, len(item) // 2))
        docs.append((d, " ".join([make(rng.randrange(6), 0.3), *item[lo:], make(rng.randrange(6), 0.3)])))
    docs += [(200, None), (201, ""), (202, items[3][1])]
    got = D.contaminated_pairs(spark.createDataFrame(docs, "doc_id long, text string"),
                               spark.createDataFrame(items, "item_id long, text string")).collect()
    want = plain_pairs(docs, items)
    assert len(want) > 40 and {(r.doc_id, r.item_id): (r.covered_tokens, r.n_slots, r.reparameterised) for r in got} == want


# --------------------------------------------------------------------- pipeline

def test_stages_keep_what_plain_python_keeps(spark):
    """The classifier's choice is taken as given; the stages after it are computed again."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stages = {name: f for name, f in corpus_pipeline.STAGES}
    rows = lambda df: [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    kept = stages["quality classifier"](spark, docs, SF).cache()
    given = rows(kept)
    assert 0 < len(given) < docs.count() and kept.columns == docs.columns
    lines = stages["line dedup"](spark, kept, SF).cache()
    assert {i: t or "" for i, t in rows(lines)} == plain_line_dedup(given) and lines.columns == docs.columns
    groups = stages["n-gram Jaccard join"](spark, lines, SF).cache()
    assert {i for i, _ in rows(groups)} == plain_jaccard(rows(lines)) and groups.columns == docs.columns
    clean = stages["benchmark decontamination"](spark, groups, SF).cache()
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    held = {d for d, _ in plain_pairs(rows(groups), items)}
    assert {i for i, _ in rows(clean)} == {i for i, _ in rows(groups)} - held and held
    last = stages["SentencePiece encoding and decoding"](spark, clean, SF).collect()
    assert {r.doc_id: r.decoded_sha256 for r in last} == {i: hashlib.sha256(t.encode()).hexdigest() for i, t in rows(clean)}
    assert sorted(r.doc_id for r in corpus_pipeline.run(spark, SF).collect()) == sorted(i for i, _ in rows(clean))


ODD = [(1, None), (2, ""), (3, "a b c"), (3, "a b c"), (3, "other text under the same id"), (None, "no id"), (None, None),
       (5, "word " * 30_000), (6, "\n\n\n"), (7, "x" * 100_000), (8, "tie one two three four five six"), (9, "tie one two three four five six")]


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_odd_rows_through_every_stage(spark, tmpdir_path, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    for table, schema in (("labels", "doc_id long, quality int"), ("benchmark", "item_id long, text string")):
        spark.createDataFrame([], schema).write.parquet(f"{tmpdir_path}/{table}.parquet")
    schema = "doc_id long, text string, n_chars long, score double, rid string, n_lines long, component_id string, hash string"
    frame = spark.createDataFrame([(i, t, len(t or ""), 0.0, "r", 1, "c", "h") for i, t in ODD], schema)
    out = stage(spark, frame, tmpdir_path)
    last = name == corpus_pipeline.STAGES[-1][0]
    assert last or out.columns == frame.columns
    kept = collections.Counter(r.doc_id for r in out.collect())
    assert {1, 2, 5, 7, None} <= kept.keys()
    if name == "n-gram Jaccard join":
        assert kept[3] == 1 and 8 in kept and 9 not in kept
    assert stage(spark, frame.where("false"), tmpdir_path).count() == 0
    assert stage(spark, frame.where(F.col("doc_id").isNull()), tmpdir_path).count() == 2
