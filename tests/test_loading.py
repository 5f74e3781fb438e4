"""Batches that may be run again, loads that see each file once, declared tables."""

import json
import os
import tempfile

import duckdb
import pytest
from pyspark.sql import functions as F

from tessera.sources.batches import BatchStore, merge_statement, replace_partitions
from tessera.sources.declared import Field, Reference, Table, load_declared, row_constraints, split_rows, violations
from tessera.sources.load import LoadAborted, json_records, json_variant, load_new_files, stream_new_files

SCHEMA = "id long, name string"


@pytest.fixture()
def store(spark):
    return BatchStore(spark, tempfile.mkdtemp(prefix="tessera-store-"))


def frame(spark, *ids):
    return spark.createDataFrame([(i, f"n{i}") for i in ids], SCHEMA)


def ids(df):
    return sorted(r.id for r in df.collect())


class Cut(Exception):
    pass


def cut():
    raise Cut


# --------------------------------------------------------------------- batches

def test_batch_written_twice_counts_once(spark, store):
    assert store.write("day 1/a", {"t": frame(spark, 1, 2)})
    assert not store.write("day 1/a", {"t": frame(spark, 1, 2)})
    assert store.write("02", {"t": frame(spark, 3), "other": frame(spark)})
    assert ids(store.read("t", SCHEMA)) == [1, 2, 3] and ids(store.read("other", SCHEMA)) == []
    assert sorted(r.batch_id for r in store.commits().collect()) == ["02", "day 1/a"]
    assert {r.batch_id: r.n_rows for r in store.commits().collect()}["02"] == {"t": 1, "other": 0}


def test_batch_cut_before_the_commit_is_not_seen_and_runs_again(spark, store):
    with pytest.raises(Cut):
        store.write("b", {"t": frame(spark, 1, 2)}, before_commit=cut)
    assert ids(store.read("t", SCHEMA)) == [] and not store.is_committed("b")
    assert store.write("b", {"t": frame(spark)})  # the second attempt has no rows: the first one's stay unseen
    assert ids(store.read("t", SCHEMA)) == []


def test_two_runs_of_a_batch_at_once(spark, store):
    inner = lambda: store.write("b", {"t": frame(spark, 1)})  # noqa: E731  commits while the outer run is between its steps
    assert not store.write("b", {"t": frame(spark, 1)}, before_commit=inner)
    assert ids(store.read("t", SCHEMA)) == [1]


def test_bad_batches(spark, store):
    for batch, frames in (("", {"t": frame(spark, 1)}), ("b", {"commits": frame(spark, 1)})):
        with pytest.raises(ValueError):
            store.write(batch, frames)


def test_replace_partitions(spark):
    path = tempfile.mkdtemp(prefix="tessera-test-") + "/t"
    day = lambda d, *i: frame(spark, *i).withColumn("d", F.lit(d))
    replace_partitions(day("a", 1, 2).union(day("b", 3)), path, ["d"])
    replace_partitions(day("a", 4), path, ["d"])
    replace_partitions(day("a", 4), path, ["d"])
    assert sorted((r.d, r.id) for r in spark.read.parquet(path).collect()) == [("a", 4), ("b", 3)]


def test_merge_statement_run_twice():
    statement = merge_statement("t", "s", ["k", "j"], ["k", "j", 'odd "name', "v"])
    con = duckdb.connect()
    for name in "ts":
        con.execute(f'create table {name} (k int, j varchar, "odd ""name" int, v int)')
    con.execute("insert into t values (1, 'a', 0, 10), (2, null, 0, 20), (3, 'c', 0, 30)")
    con.execute("insert into s values (1, 'a', 1, 11), (2, null, 1, 21), (4, 'd', 1, 41)")
    for _ in range(2):
        con.execute(statement)
        assert con.execute("select * from t order by k").fetchall() == [(1, "a", 1, 11), (2, None, 1, 21), (3, "c", 0, 30), (4, "d", 1, 41)]
    assert "update" not in merge_statement("t", "s", ["k"], ["k"])


def test_streaming_epoch_run_again(spark, store):
    sink = store.streaming_sink("q", "t")
    sink(frame(spark, 1), 0)
    sink(frame(spark, 1), 0)
    sink(frame(spark, 2), 1)
    assert ids(store.read("t", SCHEMA)) == [1, 2]


# ----------------------------------------------------------------------- loads

def write_lines(folder, name, records, at=None):
    path = os.path.join(folder, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.writelines((r if isinstance(r, str) else json.dumps(r)) + "\n" for r in records)
    if at:
        os.utime(path, (at, at))


def records(*ids_):
    return [{"id": i, "name": f"n{i}"} for i in ids_]


def test_each_file_once(spark, store):
    src = tempfile.mkdtemp(prefix="tessera-src-")
    load = lambda **kw: load_new_files(store, src, "t", json_records(SCHEMA), **kw).collect()
    assert load() == []
    write_lines(src, "a.json", records(1, 2), at=1000)
    write_lines(src, "deep/er/b c=1.json", records(3), at=1000)
    write_lines(src, "{x}[1]*.json", records(0), at=1000)
    write_lines(src, "empty.json", [], at=1000)
    assert sorted((os.path.basename(r.file_path), r.n_lines, r.n_bad, r.status) for r in load()) == [
        ("%7Bx%7D%5B1%5D*.json", 1, 0, "loaded"), ("a.json", 2, 0, "loaded"), ("b%20c=1.json", 1, 0, "loaded")]
    assert load() == [] and ids(store.read("t", SCHEMA)) == [0, 1, 2, 3]
    write_lines(src, "c.json", records(4), at=1000)
    assert [r.n_lines for r in load()] == [1] and ids(store.read("t", SCHEMA)) == [0, 1, 2, 3, 4]
    write_lines(src, "c.json", records(4, 5), at=2000)  # written anew: new
    assert len(load()) == 1 and ids(store.read("t", SCHEMA)) == [0, 1, 2, 3, 4, 4, 5]
    for k in range(3):
        write_lines(src, f"d{k}.json", records(10 + k), at=3000 + k)
    assert [len(load(max_files=2)) for _ in range(3)] == [2, 1, 0]
    assert ids(store.read("t", SCHEMA))[-3:] == [10, 11, 12]


def test_cut_load_runs_again_under_the_same_id(spark, store):
    src = tempfile.mkdtemp(prefix="tessera-src-")
    write_lines(src, "a.json", records(1, 2))
    with pytest.raises(Cut):
        load_new_files(store, src, "t", json_records(SCHEMA), before_commit=cut)
    assert ids(store.read("t", SCHEMA)) == []
    load_new_files(store, src, "t", json_records(SCHEMA))
    assert ids(store.read("t", SCHEMA)) == [1, 2] and store.commits().count() == 1


BAD = ['{"id": 7', "", "[1]", '{"id": "x", "name": "n"}', "not json"]


def test_policies(spark, store):
    src = tempfile.mkdtemp(prefix="tessera-src-")
    write_lines(src, "good.json", records(1, 2))
    write_lines(src, "some.json", [*records(3, 4, 5), BAD[0]])
    write_lines(src, "most.json", [*records(6), *BAD])
    load = lambda s, **kw: {os.path.basename(r.file_path): (r.n_bad, r.status)
                            for r in load_new_files(s, src, "t", json_records(SCHEMA), **kw).collect()}
    with pytest.raises(LoadAborted, match="5 of 6 lines of .*most.json"):
        load(store)
    assert store.commits().count() == 0
    with pytest.raises(ValueError, match="on_error"):
        load(store, on_error="ignore")
    assert load(store, on_error="continue") == {"good.json": (0, "loaded"), "some.json": (1, "loaded"), "most.json": (5, "loaded")}
    assert ids(store.read("t", SCHEMA)) == [1, 2, 3, 4, 5, 6]
    bad = store.read("t_quarantine", "file_path string, line_no long, value string").collect()
    assert sorted((os.path.basename(r.file_path), r.line_no, r.value) for r in bad) == [
        *[("most.json", k + 2, b) for k, b in enumerate(BAD)], ("some.json", 4, BAD[0])]
    other = BatchStore(spark, tempfile.mkdtemp(prefix="tessera-store-"))
    assert load(other, on_error="skip_file", max_bad_share=0.25) == {
        "good.json": (0, "loaded"), "some.json": (1, "loaded"), "most.json": (5, "skipped")}
    assert ids(other.read("t", SCHEMA)) == [1, 2, 3, 4, 5] and load(other, on_error="skip_file") == {}


def test_variant_load(spark, store):
    src = tempfile.mkdtemp(prefix="tessera-src-")
    write_lines(src, "a.json", [{"id": 1, "x": [1]}, "{bad", {"id": "two"}])
    load_new_files(store, src, "v", json_variant, on_error="continue")
    got = store.read("v", "v variant, file_path string").selectExpr("v:id::string i").collect()
    assert sorted(r.i for r in got) == ["1", "two"]


def test_stream_loads_each_file_once(spark, store):
    src, checkpoint = tempfile.mkdtemp(prefix="tessera-src-"), tempfile.mkdtemp(prefix="tessera-ckpt-")
    run = lambda: stream_new_files(store, src, "t", json_records(SCHEMA), checkpoint, files_per_batch=2)
    for k in range(3):
        write_lines(src, f"{k}.json", [*records(k), "{bad"])
    run()
    run()
    assert ids(store.read("t", SCHEMA)) == [0, 1, 2]
    write_lines(src, "late.json", records(9))
    run()
    assert ids(store.read("t", SCHEMA)) == [0, 1, 2, 9]
    assert store.read("t_quarantine", "file_path string, line_no long, value string").count() == 3


# ------------------------------------------------------------- declared tables

CUSTOMERS = Table("customers", (Field("c", "int", nullable=False),), key=("c",))
ORDERS = Table("orders", (Field("o", "int"), Field("line", "int"), Field("c", "int"), Field("code", length=3),
                          Field("day", "date", nullable=False)),
               key=("o", "line"), references=(Reference(("c",), "customers", ("c",)),))
ROWS = [("1", "1", 1, "abc", "2024-01-01"), ("1", "1", 1, "abc", "2024-01-01"), ("1", "2", 9, "abcd", "soon"),
        ("2", None, None, None, None), ("x", "1", 2, "éèê", "2024-02-30"), ("3", "3", 2, "", "2024-01-01")]
GIVEN = "o string, line string, c int, code string, day string"


def declared(spark):
    return spark.createDataFrame(ROWS, GIVEN), {"customers": spark.createDataFrame([(1,), (2,), (2,)], "c int")}


def test_violations_are_counted(spark):
    df, others = declared(spark)
    assert {r.constraint_name: r.n_violations for r in violations(df, ORDERS, others).collect()} == {
        "not_null(o)": 0, "not_null(line)": 1, "not_null(day)": 1, "length(code)": 1, "type(o)": 1, "type(line)": 0,
        "type(day)": 2, "key(o, line)": 2, "reference(c)": 1}
    assert {r.n_violations for r in violations(df.limit(0), ORDERS, others).collect()} == {0}


@pytest.mark.parametrize("bound", [100_000, 0])
def test_broken_rows_are_marked_and_kept_apart(spark, store, monkeypatch, bound):
    from tessera.sources import declared as module
    monkeypatch.setattr(module, "MAX_BROADCAST_VALUES", bound)
    df, others = declared(spark)
    marked = {(r.o, r.line, r.c, r.code, r.day): set(r.broken) for r in split_rows(df, ORDERS, others).collect()}
    assert marked[ROWS[5]] == set() and marked[ROWS[0]] == {"key(o, line)"}
    assert marked[ROWS[2]] == {"length(code)", "type(day)", "reference(c)"}
    assert marked[ROWS[3]] == {"not_null(line)", "not_null(day)"} and marked[ROWS[4]] == {"type(o)", "type(day)"}
    for _ in range(2):
        assert load_declared(store, "b1", df, ORDERS, others) == {"rows": 6, "kept": 1, "broken": 5}
    kept = store.read("orders", ORDERS.schema())
    assert [(r.o, r.line, r.c, str(r.day)) for r in kept.collect()] == [(3, 3, 2, "2024-01-01")]
    assert store.read("orders_quarantine", GIVEN + ", broken array<string>").count() == 5


def test_schema_carries_the_declaration(spark):
    schema = ORDERS.schema()
    assert schema["code"].metadata == {"length": 3} and not schema["o"].nullable
    assert schema["c"].metadata == {"references": "customers.c"}
    again = Table.of("orders", schema)
    assert again.key == ORDERS.key and again.references == ORDERS.references
    assert [(f.name, f.length) for f in again.fields] == [(f.name, f.length) for f in ORDERS.fields]
    assert set(row_constraints(spark.createDataFrame([], schema), CUSTOMERS)) == {"not_null(c)"}
