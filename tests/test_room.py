"""What the loads write, keep and hold at once."""

import pathlib

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from legwork.plans import learn
from legwork.sources import ledger, tables
from legwork.sources.documents import scan_pages
from legwork.streaming import current
from legwork.streaming.ingest import stream_documents
from suite import learning, staging
from tests.samples import ALPHA, NO_LEGS, write_page


@pytest.fixture
def docs(spark, tmp_path):
    write_page(tmp_path / "given", "1.json", [ALPHA, NO_LEGS], "2026-02-01 00:00:00")
    return scan_pages(spark, str(tmp_path / "given"))


@pytest.mark.parametrize("name, folder", [("json_scan", "pages"), ("landing_replay", "landing")])
def test_pages_are_landed_compressed(spark, docs, tmp_path, monkeypatch, name, folder):
    monkeypatch.setattr(learning, "_docs", lambda spark, sf: docs)
    monkeypatch.setattr(learning, "work_dir", lambda spark: str(tmp_path / "work"))
    found = getattr(learning, name)(spark, "").collect()
    parts = [p.name for p in (tmp_path / "work").rglob("part-*")]
    assert parts and all(p.endswith(".gz") for p in parts)
    assert len(found) == (2 if name == "json_scan" else sum(d["flightNumber"] % 10 == 0 for d in (ALPHA, NO_LEGS)))


def test_documents_alone_are_landed_where_only_they_are_read(spark, docs, tmp_path, monkeypatch):
    monkeypatch.setattr(staging.fixture, "documents", lambda spark, sf: docs)
    monkeypatch.setattr(staging, "work_dir", lambda spark: str(tmp_path / "work"))
    assert staging.staged(spark, str(tmp_path), "documents").count() == 2
    assert [p.name for p in (tmp_path / "work").iterdir()] == ["documents"]
    assert staging.staged(spark, str(tmp_path), "flights").count() == 2
    assert {p.name for p in (tmp_path / "work").iterdir()} == {"documents", "flights"}


def test_merged_rows_move_once_and_lie_in_bounded_files(spark, tmp_path, monkeypatch):
    reduced, real = [], tables.latest_by_key
    monkeypatch.setattr(tables, "latest_by_key", lambda df, keys, order: reduced.append(keys) or real(df, keys, order))
    monkeypatch.setattr(tables, "FILE_ROWS", 50)
    path, order = str(tmp_path / "t"), [F.desc("v")]
    rows = lambda start, end, v: spark.range(start, end, 1, 4).withColumn("v", F.lit(v))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # this little fits one task
    tables.merge_into(rows(0, 800, 1), path, ["id"], order, 2)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert reduced == []  # no key comes twice and nothing is stored yet
    files = list(pathlib.Path(path).rglob("*.parquet"))
    assert len(files) > 4 and max(pq.ParquetFile(f).metadata.num_rows for f in files) < 400
    assert all("ZSTD" == pq.ParquetFile(f).metadata.row_group(0).column(0).compression for f in files)
    tables.merge_into(rows(700, 900, 3).unionByName(rows(750, 950, 2)), path, ["id"], order)
    found = {r.id: r.v for r in tables.read_table(spark, path).collect()}
    assert found == {i: 1 if i < 700 else 3 if i < 900 else 2 for i in range(950)}
    assert tables.read_table(spark, path).count() == 950


def test_null_keys_and_empty_updates_merge(spark, tmp_path):
    path, order = str(tmp_path / "t"), [F.desc("v")]
    rows = lambda *found: spark.createDataFrame(list(found), "k string, v int")
    tables.merge_into(rows((None, 1), (None, 2), ("a", 1)), path, ["k"], order)
    tables.merge_into(rows(), path, ["k"], order)
    tables.merge_into(rows((None, 3), ("a", 0)), path, ["k"], order)
    assert sorted(tables.read_table(spark, path).collect(), key=str) == sorted([(None, 3), ("a", 1)], key=str)


def test_a_batch_of_pages_is_bounded_by_its_bytes(spark, tmp_path):
    body = F.expr("array_join(transform(sequence(1, 7000), i -> hex(xxhash64(id, i))), '')")
    ledger.write_pages(spark.range(0, 600, 1, 1).withColumn("body", body), str(tmp_path / "pages"))
    (file,) = (tmp_path / "pages").glob("*.parquet")
    meta = pq.ParquetFile(file).metadata
    assert meta.num_rows == 600 and max(meta.row_group(i).num_rows for i in range(meta.num_row_groups)) < 300


def test_the_stateful_load_runs_no_python_per_flight(spark, tmp_path):
    write_page(tmp_path / "landing", "1.json", [ALPHA, NO_LEGS], "2026-02-01 00:00:00")
    stream = current.newest_documents(stream_documents(spark, str(tmp_path / "landing")))
    assert "Python" not in stream._jdf.queryExecution().analyzed().toString()
    assert "InPandas" not in stream._jdf.queryExecution().analyzed().toString()


def test_versions_in_one_batch_and_stale_ones(spark, tmp_path):
    def batch(*rows):
        leg = '{"departureInformation": {"airport": {"code": "AAA"}}}'
        docs = [(f, '{"id": "F", "flightScheduleDate": "2026-02-01", "flightLegs": [%s]}' % leg, t, "s", v) for f, t, v in rows]
        typed = spark.createDataFrame(docs, "id string, payload string, t string, source string, version bigint")
        return typed.withColumn("fetched_at", F.col("t").cast("timestamp")).select("id", "payload", "fetched_at", "source", "version")

    def stored():
        return {r.id: (str(r.fetched_at)[:10], r.version) for r in tables.read_table(spark, f"{path}/documents").collect()}

    path = str(tmp_path / "tables")
    current.write_newest(batch(("A", "2026-02-01", 1), ("A", "2026-02-02", 2), ("B", "2026-02-01", 5), (None, "2026-02-01", 1)), 0, path)
    assert stored() == {"A": ("2026-02-02", 2), "B": ("2026-02-01", 5), None: ("2026-02-01", 1)}
    current.write_newest(batch(("A", "2026-02-01", 9), ("B", "2026-02-01", 4), (None, "2026-01-31", 7)), 1, path)
    assert stored() == {"A": ("2026-02-02", 2), "B": ("2026-02-01", 5), None: ("2026-02-01", 1)}
    current.write_newest(batch(("A", "2026-02-03", 0), ("B", "2026-02-01", 6), ("C", "2026-01-01", 0)), 2, path)
    assert stored() == {"A": ("2026-02-03", 0), "B": ("2026-02-01", 6), "C": ("2026-01-01", 0), None: ("2026-02-01", 1)}


def test_a_small_fit_takes_few_tasks(spark, monkeypatch):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "60")
    row = spark.range(0, 900, 1, 4).withColumn("leg_id", F.concat(F.lit("F"), F.col("id"))).withColumn("label", (F.col("id") % 5 == 0).cast("int"))
    columns = {c: (F.col("id") % (i + 3)).cast("int") for i, c in enumerate(learn.NUMERIC_FEATURES)}
    columns |= {c: (F.col("id") % 4).cast("string") for c in learn.CATEGORICAL_FEATURES}
    seen = {}

    class Fit:
        def fit(self, rows):
            seen.update(tasks=rows.rdd.getNumPartitions(), labels=[r["count"] for r in rows.groupBy("label").count().collect()])

    monkeypatch.setattr(learn, "forest", lambda settings: Fit())
    try:
        model, _ = learn.train(row.withColumns({**columns, "flight_id": F.lit("F")}))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert seen["tasks"] == 2 and len(set(seen["labels"])) == 1  # 720 rows, raised to equal classes
    assert model.fit_rows == 720
