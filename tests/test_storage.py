from datetime import datetime

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from daybook.operators.merge import insert_or_patch, latest_per_key
from daybook.sources.archives import append_manifest, latest_entry, latest_path, read_manifest, scan_with_archives
from daybook.sources.collections import SCHEMAS, in_window, read_collection
from daybook.plans import flows, tables
from daybook.plans.labels import Labels
from daybook.plans.run import Run
from daybook.sources import keyed
from daybook.sources.keyed import CHANGED, KEYS, bucket_count, bucketed, current, is_published, periods_of, publish, publish_empty
from daybook.sources.parquet import read_dictionary, read_where, write_report
from daybook.functions.times import instant
from daybook.session import work_folder

STORED = "row_key string, info struct<s:string>, period string"


def exchanges(frame):
    """Columns that are shuffled by, from the initial physical plan."""
    plan = frame._jdf.queryExecution().executedPlan().toString()
    return [line.strip() for line in plan.splitlines() if "Exchange" in line]


def test_work_folder_is_below_the_shared_one(spark):
    assert work_folder(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def stored(spark, *rows):
    """Rows of (key, value, period), all marked as changed."""
    return spark.createDataFrame([(k, (v,), p) for k, v, p in rows], STORED).withColumn(CHANGED, F.lit(True))


def held(spark, root, schema, table="T"):
    return sorted((r.row_key, r.info.s, r.period) for r in current(spark, root, table, schema).collect())


def index(spark, root):
    return sorted(tuple(r) for r in current(spark, root, "T", KEYS, "keys").select("row_key", "period").collect())


def test_changed_periods_are_replaced(spark):
    root = work_folder(spark, "keyed")
    first = stored(spark, ("a", "1", "p1"), ("b", "1", "p1"), ("z", "1", "p9"))
    schema = first.drop(CHANGED).schema
    assert held(spark, root, schema) == []
    publish(first, root, "T", "20240101", 4, schema)
    publish(stored(spark, ("y", "9", "p1")), root, "Other", "20250101", 4, schema)

    # b lies in p1 and stays there; c is new in p2; p9 is not touched and not read.
    batch = bucketed(stored(spark, ("b", "2", "p2"), ("c", "2", "p2")).drop(CHANGED), work_folder(spark, "batch"), 4)
    assert periods_of(spark, root, "T", batch) == ["p1", "p2"]
    touched = current(spark, root, "T", schema).filter("period in ('p1', 'p2')")
    merged = insert_or_patch(touched, batch, "info", ["s"]).withColumn(CHANGED, F.col("row_key") == "b")
    publish(merged, root, "T", "20240102", 4, schema)
    # Only periods with changed rows are replaced.
    assert held(spark, root, schema) == [("a", "1", "p1"), ("b", "2", "p1"), ("z", "1", "p9")]
    assert index(spark, root) == [("a", "p1"), ("b", "p1"), ("z", "p9")]
    with pytest.raises(FileExistsError):
        publish(first, root, "T", "20240102", 4, schema)

    publish_empty(spark, root, "T", "20240103", schema)
    assert held(spark, root, schema) == index(spark, root) == []
    publish(first.limit(0), root, "T", "20240104", 4, schema)
    assert is_published(spark, root, "T", "20240104") and not is_published(spark, root, "T", "20240105")
    publish(first.filter("row_key = 'a'"), root, "T", "20240105", 4, schema)
    assert held(spark, root, schema) == [("a", "1", "p1")]
    assert held(spark, root, schema, "Other") == [("y", "9", "p1")]


@pytest.mark.parametrize("lost", ["before", "rows", "keys", "mark"])
def test_a_lost_job_loses_no_change(spark, monkeypatch, lost):
    """A job dies before it replaces, between rows and index, or before it says that it is done."""
    root = work_folder(spark, "lost")
    first = stored(spark, ("a", "1", "p"), ("b", "1", "p"), ("c", "1", "q"))
    schema = first.drop(CHANGED).schema
    publish(first, root, "T", "1", 4, schema)
    change = stored(spark, ("a", "2", "p"), ("b", "1", "p"), ("d", "2", "p"), ("e", "2", "r"))

    def die(*_, **__):
        raise RuntimeError("lost")

    with monkeypatch.context() as patched:
        if lost == "before":
            patched.setattr(keyed, "ThreadPoolExecutor", die)
        elif lost == "mark":
            real = keyed.mark
            patched.setattr(keyed, "mark", lambda spark, path: die() if "/runs/" in path else real(spark, path))
        else:
            real = keyed.declared
            other = "/keys" if lost == "rows" else "/T/rows"
            patched.setattr(keyed, "declared", lambda spark, path, *rest: die() if path.endswith(other) else real(spark, path, *rest))
        with pytest.raises(RuntimeError, match="lost"):
            publish(change, root, "T", "2", 4, schema)
    after = [("a", "2", "p"), ("b", "1", "p"), ("c", "1", "q"), ("d", "2", "p"), ("e", "2", "r")]
    keys = [(k, p) for k, _, p in after]
    # Readers take the change at once; it is not made again, and the next one finishes it first.
    assert held(spark, root, schema) == after and index(spark, root) == keys
    assert is_published(spark, root, "T", "2")
    keyed.finish(spark, root, "T", schema)
    assert held(spark, root, schema) == after and index(spark, root) == keys
    publish(stored(spark, ("c", "3", "q")), root, "T", "3", 4, schema)
    assert held(spark, root, schema) == [("c", "3", "q") if k == "c" else (k, v, p) for k, v, p in after]


def test_a_job_lost_while_it_stages_changes_nothing(spark, monkeypatch):
    root = work_folder(spark, "staging")
    first = stored(spark, ("a", "1", "p"))
    schema = first.drop(CHANGED).schema
    publish(first, root, "T", "1", 4, schema)
    with monkeypatch.context() as patched:
        patched.setattr(keyed, "mark", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            publish(stored(spark, ("a", "2", "p"), ("b", "2", "q")), root, "T", "2", 4, schema)
    assert held(spark, root, schema) == [("a", "1", "p")] and not is_published(spark, root, "T", "2")
    publish(stored(spark, ("a", "3", "p")), root, "T", "2", 4, schema)
    assert held(spark, root, schema) == [("a", "3", "p")]


def test_an_ingest_reads_only_the_months_of_its_keys(spark):
    """Files of other months are spoiled: whoever read them would fail."""
    root, flow, labels = work_folder(spark, "months"), flows.PROBLEM_GUIDE, Labels("-", "-")

    def guides(*rows):
        made = [{"_id": k, "Status": s, "CreatedDate": datetime(2024, month, 5)} for k, s, month in rows]
        return spark.createDataFrame(made, SCHEMAS["ProblemGuide"])

    def ingest(stamp, *rows):
        tables.ingest_into(spark, root, flow, guides(*rows), Run.on("2024-09-01"), stamp, labels, buckets=2)

    ingest("1", *[(f"k{i}", "old", 1 + i % 6) for i in range(30)])
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    system = hadoop(root).getFileSystem(spark._jsc.hadoopConfiguration())
    for month in (1, 2, 4, 5, 6):
        for file in system.listStatus(hadoop(f"{root}/ProblemGuide/rows/period=2024-{month:02d}")):
            out = system.create(file.getPath(), True)
            out.writeBytes("spoiled")
            out.close()
    # The key says March, whatever date the document has now; a new key is born in August.
    ingest("2", ("k2", "new", 1), ("k8", "old", 3), ("n", "new", 8))
    schema = tables.table_schema(spark, "ProblemGuide")
    rows = current(spark, root, "ProblemGuide", schema).filter("period in ('2024-03', '2024-08')").collect()
    assert {r.row_key: r.info.status for r in rows} == {"k2": "new", "k8": "old", "k14": "old", "k20": "old", "k26": "old", "n": "new"}
    plan = spark.table(keyed._name(f"{root}/ProblemGuide/rows")).filter("period = '2024-03'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(period" in plan
    # Nothing changes, so nothing is replaced.
    before = {f.getPath().getName() for f in system.listStatus(hadoop(f"{root}/ProblemGuide/rows/period=2024-03"))}
    ingest("3", ("k2", "new", 3))
    assert before == {f.getPath().getName() for f in system.listStatus(hadoop(f"{root}/ProblemGuide/rows/period=2024-03"))}


def test_merge_shuffles_neither_table_nor_staged_batch(spark):
    root, flow = work_folder(spark, "bucketed"), flows.SIGNATURE_TRANSACTION
    schema = tables.table_schema(spark, flow.table)
    rows = spark.range(1000).select(
        F.col("id").cast("string").alias("row_key"),
        F.struct(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema["info"].dataType.fields]).alias("info"),
        F.concat(F.lit("p"), (F.col("id") % 4).cast("string")).alias("period"),
    )
    publish(rows.withColumn(CHANGED, F.lit(True)), root, flow.table, "1", 8, schema)
    batch = bucketed(rows.filter("period = 'p1'"), work_folder(spark, "batch"), 8)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        merged = tables.merged_periods(spark, root, flow, batch, Run.on("2024-01-01"))
        assert exchanges(merged) == []
        plan = merged._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(period" in plan and "(period#" in plan and "= p1)" in plan
        assert merged.groupBy(CHANGED).count().collect() == [(False, 250)]
        unstaged = insert_or_patch(current(spark, root, flow.table, schema), latest_per_key(rows, ["info"]), "info", [])
        assert len(exchanges(unstaged)) == 1, "a batch is shuffled once for de-duplication and join"
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_write_reads_one_bucket_a_task(spark, monkeypatch):
    """What a task sorts does not grow with the files of the table, of which many bytes' worth would be read at once."""
    plans = []
    for name in ("saveAsTable", "insertInto"):

        def spied(writer, *given, write=getattr(DataFrameWriter, name), **named):
            plans.append(writer._df._jdf.queryExecution().executedPlan().toString())
            return write(writer, *given, **named)

        monkeypatch.setattr(DataFrameWriter, name, spied)
    root, schema = work_folder(spark, "writes"), tables.table_schema(spark, "Credential")
    rows = spark.createDataFrame([{"row_key": str(n), "period": "2025-04"} for n in range(50)], schema)
    batch = bucketed(rows.withColumn(CHANGED, F.lit(True)), work_folder(spark, "write"), 4)
    plans.clear()
    publish(batch, root, "Credential", "1", 4, schema)
    assert len(plans) == 3 and all("Bucketed: true" in plan for plan in plans)
    assert current(spark, root, "Credential", schema).count() == 50
    assert spark.conf.get("spark.sql.sources.bucketing.autoBucketedScan.enabled") == "true"


def test_report_runs_are_kept_once(spark):
    path = work_folder(spark, "report")
    rows = spark.createDataFrame([("2024/01/15 00:00:00", 1), ("2024/01/15 00:00:00", 2)], "data_report string, n int")
    assert write_report(rows, path, "data_report", 2024) == 2
    later = spark.createDataFrame([("2025/01/15 00:00:00", 3)], "data_report string, n int")
    assert write_report(later, path, "data_report", 2024) == 1
    assert write_report(rows.filter("n = 1"), path, "data_report", 2024) == 1
    assert write_report(rows.limit(0), path, "data_report", 2024) == 0
    got = read_where(spark, path)
    assert sorted((r.report_year, r.n) for r in got.collect()) == [(2024, 1), (2024, 3)]


def test_optional_equality_reaches_the_scan(spark):
    path = work_folder(spark, "where")
    spark.createDataFrame([("a", 1), ("b", 2)], "k string, n int").write.parquet(path)
    assert read_where(spark, path).count() == read_where(spark, path, "k").count() == 2
    found = read_where(spark, path, "k", "a")
    assert [r.n for r in found.collect()] == [1]
    assert "EqualTo(k,a)" in found._jdf.queryExecution().executedPlan().toString()


def test_dictionary_keeps_its_order(spark):
    path = work_folder(spark, "dictionary")
    rows = [("status", "CertOrder", c, f"d{i}") for i, c in enumerate((5, 1, 5))]
    spark.createDataFrame(rows, "type string, table string, code int, description_vi string").coalesce(1).write.parquet(path)
    got = read_dictionary(spark, path).orderBy("position").collect()
    assert [r.description_vi for r in got] == ["d0", "d1", "d2"]


def test_dictionary_of_several_files(spark):
    """Spark deals larger files out first; entries keep the order of the file names."""
    path = work_folder(spark, "dictionary")
    ddl = "type string, table string, code int, description_vi string"
    for name, rows in (("a", [("status", "CertOrder", 5, "first")]), ("b", [("status", "CertOrder", i % 9, f"later {i}") for i in range(5000)])):
        spark.createDataFrame(rows, ddl).coalesce(1).write.parquet(f"{path}/{name}")
    both = spark.read.option("recursiveFileLookup", "true").schema(ddl).parquet(path)
    assert both.count() == 5001
    got = read_dictionary(spark, f"{path}/*").where("code = 5").orderBy("position").first()
    assert got.description_vi == "first"


def test_buckets_and_order_are_the_table_s_own(spark):
    root = work_folder(spark, "own")
    rows = stored(spark, *[(str(i), "1", "p") for i in range(50)])
    schema = rows.drop(CHANGED).schema
    publish(rows, root, "T", "2", 4, schema)
    assert bucket_count(spark, root, "T", 8) == 4 and bucket_count(spark, root, "U", 8) == 8
    # A run of an earlier stamp that is published later counts.
    publish(rows.limit(3), root, "T", "1", 4, schema)
    assert current(spark, root, "T", schema).count() == 3


def test_comparable_rows_tell_maps_by_their_entries(spark):
    ddl = "row_key string, m map<string,string>, s string"
    rows = spark.createDataFrame([("a", {"x": "1", "y": "2"}, None), ("b", {"y": "2", "x": "1"}, None), ("c", {"x": "1"}, "")], ddl)
    cells = [r[0] for r in rows.orderBy("row_key").select(tables.comparable(rows)).collect()]
    assert cells[0] == cells[1] != cells[2]


def test_latest_snapshot(spark):
    path = work_folder(spark, "manifest")
    for stamp, table, file in (("2", "L", "b"), ("2", "L", "c"), ("1", "L", "z"), ("9", "M", "m")):
        append_manifest(spark, path, [(stamp, "", "", table, file, "", 1)])
    manifest = read_manifest(spark, path)
    assert latest_path(manifest, "L") == "c"
    assert latest_path(manifest, "none") is None
    assert latest_entry(manifest, "M").count() == 1


def test_scan_spans_overlapping_archives(spark):
    root = work_folder(spark, "spans")
    ddl = "_id string, at timestamp"

    def part(name, *days):
        rows = [(f"{name}{d}", datetime(2024, 1, d)) for d in days]
        spark.createDataFrame(rows, ddl).write.parquet(f"{root}/{name}")

    part("early", 1, 2)
    part("middle", 3, 4)
    part("late", 8, 9)
    catalogue = spark.createDataFrame(
        [
            ("T", "early", datetime(2024, 1, 1), datetime(2024, 1, 2)),
            ("T", "middle", datetime(2024, 1, 3), datetime(2024, 1, 4)),
            ("T", "late", datetime(2024, 1, 8), datetime(2024, 1, 9)),
            ("U", "missing", datetime(2024, 1, 3), datetime(2024, 1, 4)),
        ],
        SCHEMAS["CutOff"],
    )
    live = spark.createDataFrame([("live", datetime(2024, 1, 10))], ddl)

    def open_parts(names):
        return spark.read.schema(ddl).parquet(*[f"{root}/{n}" for n in names])

    def ids(start, end):
        bounds = [instant(b) if b else None for b in (start, end)]
        return {r["_id"] for r in scan_with_archives(live, catalogue, "T", *bounds, open_parts).collect()}

    assert ids("2024-01-02 00:00:00", "2024-01-03 00:00:00") == {"live", "early1", "early2", "middle3", "middle4"}
    assert ids("2024-01-05 00:00:00", "2024-01-06 00:00:00") == {"live"}
    assert ids("2024-01-04 00:00:00", None) == {"live", "middle3", "middle4", "late8", "late9"}
    assert ids(None, "2024-01-02 00:00:00") == {"live", "early1", "early2"}


def test_window_filter_reaches_the_scan(spark):
    path = work_folder(spark, "documents")
    documents = spark.createDataFrame([], SCHEMAS["Register"])
    documents.write.parquet(path)
    scanned = in_window(
        read_collection(spark, "Register", path), "Register", instant("2024-01-01 17:00:00"), instant("2024-02-01 17:00:00")
    ).select("_id")
    plan = scanned._jdf.queryExecution().executedPlan().toString()
    assert "LessThan(createdDate,2024-02-01 17:00:00.0)" in plan
    assert "GreaterThanOrEqual(modifiedDate" in plan
    assert "ReadSchema: struct<_id:string,modifiedDate:timestamp,createdDate:timestamp>" in plan


def test_json_documents(spark, tmp_path):
    path = tmp_path / "certs.json"
    path.write_text('{"requestId": "r", "validFrom": "2024-01-01T00:00:00Z", "extra": 1}\n{"requestId": "s"}\n')
    rows = read_collection(spark, "Cert", str(path), format="json").orderBy("requestId").collect()
    assert [(r.requestId, r.validFrom) for r in rows] == [("r", datetime(2024, 1, 1)), ("s", None)]
