"""Sources and sinks on small files written to a fresh temporary folder."""

import json
import os

from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from tessera.sources.csv import read_csv
from tessera.sources.jsonl import invalid_json_in_file, line_count, read_variant
from tessera.sources.lines import assign_chunks, with_line_numbers
from tessera.sources.rechunk import audit_path, rechunk_text
from tessera.sources.sinks import drop_table, insert_into, save_table


def _ndjson(path, good=7, bad_at=4):
    lines = [json.dumps({"business_id": f"b{i % 3}", "stars": 4.5 if i == 0 else i % 5 + 1,
                         "date": "2018-07-07 22:09:11", "text": f"review {i}"})
             for i in range(good)]
    lines.insert(bad_at, "{bad")
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")
    return len(lines)


def test_csv_null_tokens_and_names(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "orders.csv")
    with open(p, "w") as f:
        f.write("Order Id,Ship Mode,List Price\n1,Not Available,260\n2,unknown,unknown\n"
                "3,Second Class,100\n")
    schema = StructType([StructField("Order Id", IntegerType()),
                         StructField("Ship Mode", StringType()),
                         StructField("List Price", IntegerType())])
    df = read_csv(spark, p, schema, null_tokens=["Not Available", "unknown"],
                  normalise_names=True)
    assert df.columns == ["order_id", "ship_mode", "list_price"]
    assert [tuple(r) for r in df.orderBy("order_id").collect()] == \
        [(1, None, 260), (2, None, None), (3, "Second Class", 100)]


def test_invalid_json_lines(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "reviews.json")
    n = _ndjson(p)
    assert line_count(spark, p) == n == 8
    bad = invalid_json_in_file(spark, p).collect()
    assert [(r.line_no, r.value) for r in bad] == [(5, "{bad")]


def test_variant_load(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "reviews.json")
    _ndjson(p)
    v = read_variant(spark, p, "review_text")
    out = v.select(F.expr("review_text:stars::decimal(38,0)").alias("star"),
                   F.expr("cast(review_text:date::string as date)").alias("d"))
    rows = out.filter(F.col("star").isNotNull()).collect()
    assert len(rows) >= 7 and rows[0].star == 5 and str(rows[0].d) == "2018-07-07"


def test_line_numbers_dense_across_partitions(spark):
    df = spark.range(0, 1000, 1, 7)
    got = with_line_numbers(df, "ln").select((F.col("id") == F.col("ln")).alias("eq"))
    assert got.filter(~F.col("eq")).count() == 0


def test_chunks_balanced_and_lossless(spark):
    df = spark.range(0, 103, 1, 5)
    sizes = {r.chunk: r["count"] for r in assign_chunks(df, 10).groupBy("chunk").count().collect()}
    assert sorted(sizes) == list(range(10))
    assert sum(sizes.values()) == 103 and max(sizes.values()) - min(sizes.values()) <= 1


def test_rechunk_and_audit(spark, tmpdir_path):
    src = os.path.join(tmpdir_path, "reviews.json")
    n = _ndjson(src)
    dst = os.path.join(tmpdir_path, "chunks")
    rechunk_text(spark, src, dst, n=3)
    audit = audit_path(spark, dst).collect()
    assert sum(r.n_rows for r in audit) == n
    assert len(audit) == 3
    back = spark.read.text(dst).select("value", "chunk").collect()
    with open(src) as f:
        original = f.read().splitlines()
    by_chunk = {}
    for r in back:
        by_chunk.setdefault(r.chunk, []).append(r.value)
    # contiguous and in order: chunks concatenated give the file back
    rebuilt = [x for c in sorted(by_chunk) for x in sorted(by_chunk[c], key=original.index)]
    assert rebuilt == original


def _files_of_lines(folder, sizes):
    """Files f0.txt, f1.txt, ... with sizes[i] lines 'f{i}:{j}'; sizes differ
    so Spark's size-sorted split order is not path order."""
    os.makedirs(folder, exist_ok=True)
    expected = []
    for i, n in enumerate(sizes):
        rows = [f"f{i}:{j:04d}" for j in range(n)]
        with open(os.path.join(folder, f"f{i}.txt"), "w") as f:
            f.write("\n".join(rows) + "\n")
        expected.extend(rows)
    return expected


class _small_splits:
    """Tiny split size, so one file spans several tasks and small files are
    packed together."""

    def __init__(self, spark, nbytes=200):
        self.spark, self.nbytes = spark, nbytes

    def __enter__(self):
        c = self.spark.conf
        self.saved = (c.get("spark.sql.files.maxPartitionBytes"),
                      c.get("spark.sql.files.openCostInBytes"))
        c.set("spark.sql.files.maxPartitionBytes", str(self.nbytes))
        c.set("spark.sql.files.openCostInBytes", "1")

    def __exit__(self, *exc):
        self.spark.conf.set("spark.sql.files.maxPartitionBytes", self.saved[0])
        self.spark.conf.set("spark.sql.files.openCostInBytes", self.saved[1])


def test_line_numbers_follow_file_order_across_files_and_splits(spark, tmpdir_path):
    folder = os.path.join(tmpdir_path, "many")
    expected = _files_of_lines(folder, [7, 120, 3, 55])
    with _small_splits(spark):
        df = spark.read.text(folder).withColumn("f", F.col("_metadata.file_name"))
        assert df.rdd.getNumPartitions() > 4
        got = with_line_numbers(df, "ln", file_col="f").select("ln", "value").collect()
        per = with_line_numbers(df, "ln", base=1, file_col="f", per_file=True) \
            .select("f", "ln", "value").collect()
    assert sorted(r.ln for r in got) == list(range(len(expected)))
    assert [r.value for r in sorted(got, key=lambda r: r.ln)] == expected
    for r in per:
        assert r.value == f"{r.f[:-4]}:{r.ln - 1:04d}"


def test_rechunk_many_files_no_single_writer(spark, tmpdir_path):
    src = os.path.join(tmpdir_path, "src")
    expected = _files_of_lines(src, [40, 200, 9, 90])
    dst = os.path.join(tmpdir_path, "chunks")
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    saved = spark.conf.get(coalesce)
    spark.conf.set(coalesce, "false")  # keep the tiny range partitions apart
    try:
        with _small_splits(spark, 400):
            rechunk_text(spark, src, dst, n=4)
    finally:
        spark.conf.set(coalesce, saved)
    sizes = []
    rebuilt = []
    for c in range(4):
        part = os.path.join(dst, f"chunk={c}")
        files = sorted(f for f in os.listdir(part) if f.startswith("part-"))
        rows = []
        for f in files:
            with open(os.path.join(part, f)) as fh:
                rows.extend(fh.read().splitlines())
        sizes.append(len(rows))
        rebuilt.extend(rows)
    # files of each chunk, read in name order, give the input back in order
    assert rebuilt == expected
    assert max(sizes) - min(sizes) <= 1
    # a chunk that spans several splits is written by several tasks
    assert any(len([f for f in os.listdir(os.path.join(dst, f"chunk={c}"))
                    if f.startswith("part-")]) > 1 for c in range(4))


def test_invalid_json_lines_per_file(spark, tmpdir_path):
    folder = os.path.join(tmpdir_path, "nd")
    os.makedirs(folder)
    _ndjson(os.path.join(folder, "a.json"), good=30, bad_at=20)
    _ndjson(os.path.join(folder, "b.json"), good=3, bad_at=1)
    with _small_splits(spark):
        glob = invalid_json_in_file(spark, folder).collect()
        per = invalid_json_in_file(spark, folder, per_file=True).collect()
    assert sorted((r.file_path.rsplit("/", 1)[-1], r.line_no) for r in glob) == \
        [("a.json", 21), ("b.json", 31 + 2)]
    assert sorted((r.file_path.rsplit("/", 1)[-1], r.line_no) for r in per) == \
        [("a.json", 21), ("b.json", 2)]


def test_table_sinks(spark):
    name = "tessera_sink_test"
    drop_table(spark, name)
    df = spark.createDataFrame([(1, "a")], "id int, v string")
    save_table(df, name, mode="overwrite")
    insert_into(spark.createDataFrame([("b", 2)], "v string, id int"), name)
    save_table(df, name, mode="append")
    assert sorted(tuple(r) for r in spark.table(name).collect()) == [(1, "a"), (1, "a"), (2, "b")]
    drop_table(spark, name)


def test_chunks_property(spark):
    from hypothesis import HealthCheck, given, settings
    from hypothesis import strategies as st

    @settings(max_examples=12, deadline=None,
              suppress_health_check=[HealthCheck.function_scoped_fixture])
    @given(rows=st.integers(1, 400), parts=st.integers(1, 9), n=st.integers(1, 30))
    def check(rows, parts, n):
        df = spark.range(0, rows, 1, parts)
        got = assign_chunks(df, n).select("id", "line_no", "chunk").collect()
        assert sorted(r.line_no for r in got) == list(range(rows))
        assert all(r.id == r.line_no for r in got)
        by = {}
        for r in got:
            by.setdefault(r.chunk, []).append(r.id)
        sizes = [len(v) for v in by.values()]
        assert sum(sizes) == rows and max(sizes) - min(sizes) <= 1
        assert len(by) == min(n, rows)
        # contiguous and in order: chunk c's ids all precede chunk c+1's
        ordered = sorted(by)
        for a, b in zip(ordered, ordered[1:]):
            assert max(by[a]) < min(by[b])

    check()


def test_audit_keeps_equal_files_apart(spark, tmpdir_path):
    """One task names its part files alike in every chunk folder."""
    import os

    src, dst = os.path.join(tmpdir_path, "in.txt"), os.path.join(tmpdir_path, "out")
    with open(src, "w") as f:
        f.write("".join(f"line {k:03d}\n" for k in range(100)))
    rechunk_text(spark, src, dst, n=10)
    audit = audit_path(spark, dst).collect()
    assert len(audit) == 10 and {r.n_rows for r in audit} == {10}
    assert len({r.file_path for r in audit}) == 10
