import copy
import itertools

import pytest
from pyspark.sql import functions as F

from legwork.operators import merge
from legwork.sources import tables, windows
from legwork.streaming import ingest
from tests.samples import ALPHA, NO_LEGS, write_page


def rows_of(df):
    return sorted(map(str, df.collect()))


def test_merge_does_not_depend_on_order_and_repeats_change_nothing(spark):
    schema = "k int, at int, v string"
    parts = [
        spark.createDataFrame(rows, schema)
        for rows in ([(1, 1, "a"), (2, 5, "b")], [(1, 3, "c"), (3, 1, "d")], [(2, 4, "late"), (3, 2, "e")])
    ]
    order = [F.desc("at"), F.desc("v")]
    results = set()
    for permutation in itertools.permutations(parts):
        state = permutation[0]
        for part in (*permutation[1:], permutation[1]):
            state = merge.merge_by_key(state, part, ["k"], order)
        results.add(tuple(rows_of(state)))
    assert len(results) == 1
    assert [r.split("v='")[1][:-2] for r in results.pop()] == ["c", "b", "e"]


def test_hot_key_is_reduced_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    plan = merge.latest_by_key(df, ["k"], [F.desc("id")])._jdf.queryExecution().executedPlan().toString()
    before_exchange = plan[plan.index("Exchange") :]
    assert "WindowGroupLimit" in before_exchange


def test_children_of_an_older_parent_version_vanish(spark):
    parents = spark.createDataFrame([("F1", 2), ("F2", 1)], "id string, version int")
    children = spark.createDataFrame(
        [("c1", "F1", 1), ("c2", "F1", 2), ("c3", "F2", 1), ("c4", "F3", 1)], "id string, flight_id string, version int"
    )
    kept = merge.replace_children(children, parents, "id", ["version"], "flight_id")
    assert sorted(r["id"] for r in kept.collect()) == ["c2", "c3"]


def test_silver_airports_keep_first_and_last_sight(spark):
    rows = [("AAA", "new", "2026-01-03"), ("AAA", "old", "2026-01-01"), (None, "x", "2026-01-02")]
    staging = spark.createDataFrame(rows, "iata_code string, name string, t string").select(
        "iata_code", "name", F.col("t").cast("timestamp").alias("ingested_at"), *[F.lit(None).cast("string").alias(c) for c in ("icao_code", "city")],
        *[F.lit(None).cast("double").alias(c) for c in ("lat", "lng")],
    )
    only = merge.silver_airports(staging).collect()
    assert len(only) == 1 and only[0]["name"] == "new"
    assert str(only[0]["created_at"])[:10] == "2026-01-01" and str(only[0]["last_updated_at"])[:10] == "2026-01-03"


def test_append_repeats_rows_and_replace_does_not(spark, tmp_path):
    df = spark.range(3)
    for _ in range(2):
        tables.append(df, str(tmp_path / "a"))
        tables.replace(df, str(tmp_path / "r"))
    assert spark.read.parquet(str(tmp_path / "a")).count() == 6
    assert tables.read_table(spark, str(tmp_path / "r"), ["id"]).count() == 3


def test_rows_read_from_a_table_may_replace_it(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.replace(spark.range(3), path)
    before = tables.read_table(spark, path)
    tables.replace(before.where("id > 0"), path)
    assert tables.read_table(spark, path).count() == 2 and before.count() == 3


def test_a_part_that_was_never_published_is_not_read(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.replace(spark.range(3), path)
    spark.range(100).write.parquet(f"{path}/data-crashed")
    assert tables.read_table(spark, path).count() == 3


def test_merge_into_rewrites_only_touched_buckets(spark, tmp_path):
    path, order = str(tmp_path / "t"), [F.desc("at"), F.desc("v")]
    first = spark.range(200).select(F.col("id").alias("k"), F.lit(5).alias("at"), F.lit("a").alias("v"))
    tables.merge_into(first, path, ["k"], order, 16)
    before = tables._parts(spark, path)
    updates = spark.createDataFrame([(1, 9, "new"), (2, 1, "old"), (900, 1, "added")], "k long, at int, v string")
    for _ in range(2):
        tables.merge_into(updates, path, ["k"], order)
    rows = {r["k"]: r["v"] for r in tables.read_table(spark, path).collect()}
    assert len(rows) == 201 and (rows[1], rows[2], rows[900]) == ("new", "a", "added")
    after = tables._parts(spark, path)
    assert 0 < sum(before.get(b) != part for b, part in after.items()) <= 3
    assert tables.read_table(spark, path).count() == 201


def test_windows_are_cut_at_a_day_and_the_last_is_short(spark):
    spans = spark.sql("select timestamp '2026-01-01 06:00:00' start, timestamp '2026-01-03 07:00:00' end")
    got = windows.window_plan(spans).orderBy("window_start").collect()
    assert [str(r["window_end"]) for r in got] == ["2026-01-02 06:00:00", "2026-01-03 06:00:00", "2026-01-03 07:00:00"]
    assert windows.window_plan(spans.withColumn("end", F.col("start"))).count() == 0
    whole = windows.window_plan(spans.withColumn("end", F.col("start") + F.expr("interval 2 days")))
    assert whole.count() == 2


def test_pages_and_holes(spark):
    plan = windows.page_plan(spark.createDataFrame([("w1", 3), ("w2", 0)], "w string, total_pages int"))
    landed = spark.createDataFrame([("w1", 0), ("w1", 2)], "w string, page_number int")
    assert [tuple(r) for r in windows.missing_pages(plan, landed, ["w", "page_number"]).collect()] == [("w1", 1)]


def test_state_beats_the_configured_start(spark, tmp_path):
    path, now = str(tmp_path / "state"), "2026-01-10 12:00:00"
    first = windows.resolve_window(windows.read_state(spark, path), now, start="2026-01-05")
    assert [str(v) for v in first.first()] == ["2026-01-05 00:00:00", "2026-01-10 12:00:00"]
    windows.save_window_end(first, path)
    state = windows.read_state(spark, path)
    assert str(windows.resolve_window(state, now, start="2026-01-05").first()[0]) == "2026-01-10 12:00:00"
    fixed = windows.resolve_window(state, now, start="2026-01-05", end="2026-01-06", incremental=False)
    assert [str(v) for v in fixed.first()] == ["2026-01-05 00:00:00", "2026-01-06 00:00:00"]
    fallback = windows.resolve_window(windows.read_state(spark, str(tmp_path / "none")), now)
    assert str(fallback.first()[0]) == "2026-01-09 12:00:00"


def changed(flight, **fields):
    return {**copy.deepcopy(flight), **fields}


def load(spark, folder, pages, at_once):
    """Land pages one by one with a run after each, or all before a single run."""
    for i, (flights, stamp) in enumerate(pages):
        write_page(folder / "landing", f"{i}.json", flights, stamp)
        if not at_once or i == len(pages) - 1:
            stream = ingest.stream_documents(spark, str(folder / "landing"))
            ingest.start_ingest(stream, str(folder / "tables"), str(folder / "checkpoint")).awaitTermination()
    return ingest.current_tables(spark, str(folder / "tables"))


def test_stream_equals_batch_for_any_split(spark, tmp_path):
    one_leg = changed(ALPHA, flightStatusPublic="UPDATED", flightLegs=ALPHA["flightLegs"][2:])
    pages = [
        ([ALPHA, NO_LEGS], "2026-02-01T00:00:00Z"),
        ([one_leg], "2026-02-03T00:00:00Z"),
        ([changed(ALPHA, flightStatusPublic="STALE")], "2026-02-02T00:00:00Z"),
    ]
    split = load(spark, tmp_path / "split", pages, at_once=False)
    whole = load(spark, tmp_path / "whole", pages, at_once=True)
    for name in ("flights", "legs", "delays"):
        assert rows_of(split[name]) == rows_of(whole[name])
    assert {r["id"]: r["flight_status_public"] for r in split["flights"].collect()}[ALPHA["id"]] == "UPDATED"
    assert split["legs"].count() == 1 and split["delays"].count() == 0


def test_replayed_batch_changes_nothing(spark, tmp_path):
    from legwork.operators.normalize import delays, flights, legs
    from legwork.sources.documents import scan_pages

    write_page(tmp_path / "p", "a.json", [ALPHA, NO_LEGS, ALPHA], "2026-02-01T00:00:00Z")
    docs = scan_pages(spark, str(tmp_path / "p"))
    for batch in (0, 1, 1):
        ingest.write_changes(docs, batch, str(tmp_path / "t"))
    current = ingest.current_tables(spark, str(tmp_path / "t"))
    once = docs.dropDuplicates(["id"])
    assert rows_of(current["flights"]) == rows_of(flights(once))
    assert current["legs"].count() == legs(once).count() == 3
    assert current["delays"].count() == delays(once).count() == 3

    ingest.compact_tables(spark, str(tmp_path / "t"), str(tmp_path / "compact"))
    newer = [changed(ALPHA, flightLegs=ALPHA["flightLegs"][2:])]
    write_page(tmp_path / "q", "b.json", newer, "2026-02-02T00:00:00Z")
    compacted = ingest.current_tables(spark, str(tmp_path / "compact"))
    assert all(rows_of(compacted[name]) == rows_of(current[name]) for name in current)
    ingest.write_changes(scan_pages(spark, str(tmp_path / "q")), 2, str(tmp_path / "compact"))
    after = ingest.current_tables(spark, str(tmp_path / "compact"))
    assert [after[name].count() for name in ("flights", "legs", "delays")] == [2, 1, 0]


def test_fresh_checkpoint_after_compaction_loses_nothing(spark, tmp_path):
    load(spark, tmp_path, [([ALPHA, NO_LEGS], "2026-02-01T00:00:00Z")], at_once=True)
    ingest.compact_tables(spark, str(tmp_path / "tables"), str(tmp_path / "next" / "tables"))
    added = changed(ALPHA, id="20270318+ZA+9999")
    after = load(spark, tmp_path / "next", [([added], "2026-02-02T00:00:00Z")], at_once=True)
    assert after["flights"].count() == 3 and after["legs"].count() == 6


def test_crash_between_tables_shows_the_version_before(spark, tmp_path, monkeypatch):
    from legwork.sources.documents import scan_pages

    target = str(tmp_path / "t")
    write_page(tmp_path / "p", "a.json", [ALPHA], "2026-02-01T00:00:00Z")
    ingest.write_changes(scan_pages(spark, str(tmp_path / "p")), 0, target)
    write_page(tmp_path / "q", "b.json", [changed(ALPHA, flightLegs=ALPHA["flightLegs"][2:])], "2026-02-02T00:00:00Z")

    def crash(rows, path, batch_id, write=ingest.write_batch):
        if path.endswith("flights"):
            raise OSError("executor lost")
        write(rows, path, batch_id)

    monkeypatch.setattr(ingest, "write_batch", crash)
    with pytest.raises(OSError):
        ingest.write_changes(scan_pages(spark, str(tmp_path / "q")), 1, target)
    monkeypatch.undo()
    assert ingest.current_tables(spark, target)["legs"].count() == 3
    ingest.write_changes(scan_pages(spark, str(tmp_path / "q")), 1, target)
    assert ingest.current_tables(spark, target)["legs"].count() == 1


def test_a_list_cut_short_by_a_crash_is_not_current(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.replace(spark.range(3), path)
    for number, content in ((2, ""), (3, '{"": "data-')):
        (tmp_path / "t" / tables.PUBLISHED / f"{number:09d}").write_text(content)
        assert tables.read_table(spark, path).count() == 3
    order = [F.desc("id")]
    tables.replace(spark.range(5), path)
    assert tables.read_table(spark, path).count() == 5
    merged = str(tmp_path / "m")
    tables.merge_into(spark.range(4), merged, ["id"], order, 2)
    (tmp_path / "m" / tables.PUBLISHED / "000000002").write_text("")
    tables.merge_into(spark.range(3, 6), merged, ["id"], order)
    assert tables.read_table(spark, merged).count() == 6


def test_a_second_writer_of_the_same_number_fails(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.replace(spark.range(3), path)
    with pytest.raises(Exception, match="already exists|FileAlreadyExists"):
        tables._publish(spark, path, {"": "data-late"}, 1)
    assert tables.read_table(spark, path).count() == 3
    left = [p.name for p in (tmp_path / "t" / tables.PUBLISHED).iterdir() if p.name.isdigit()]
    assert left == ["000000001"]


def test_buckets_follow_the_first_load_and_are_one_file_each(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "BUCKET_ROWS", 10)
    path = str(tmp_path / "t")
    tables.merge_into(spark.range(0, 1000, 1, 8), path, ["id"], [F.desc("id")])
    parts = tables._parts(spark, path)
    assert parts["buckets"] == "100"
    for bucket, part in parts.items():
        if bucket != "buckets":
            assert len(list((tmp_path / "t" / part).glob("*.parquet"))) == 1


def test_a_merge_computes_its_updates_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    updates = spark.range(0, 50, 1, 2).mapInPandas(count, "id long")
    for _ in range(2):
        tables.merge_into(updates, str(tmp_path / "t"), ["id"], [F.desc("id")], 4)
    assert seen.value == 100
