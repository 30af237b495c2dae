"""The stateful load: replay, late pages, restart, and congestion from changes."""

import copy

import pytest
from pyspark.sql import functions as F

from legwork.operators import congestion
from legwork.plans import intermediate
from legwork.sources import tables as stored_tables
from legwork.sources.tables import read_table
from legwork.streaming import current
from legwork.streaming.ingest import stream_documents
from tests.samples import ALPHA, NO_LEGS, write_page


def flight(name, airports=("AAA", "BBB"), status="ON_TIME"):
    """A flight of one leg between two airports."""
    doc = copy.deepcopy(ALPHA)
    doc["id"], doc["flightStatusPublic"] = name, status
    leg = doc["flightLegs"][0]
    leg["departureInformation"]["airport"]["code"], leg["arrivalInformation"]["airport"]["code"] = airports
    doc["flightLegs"] = [leg]
    return doc


class Load:
    def __init__(self, spark, root):
        self.spark, self.root, self.n = spark, root, 0
        self.tables = str(root / "tables")

    def land(self, stamp, *docs):
        self.n += 1
        write_page(self.root / "landing", f"{self.n}.json", list(docs), stamp)

    def run(self, keep="30 days"):
        stream = stream_documents(self.spark, str(self.root / "landing"))
        query = current.start_current(stream, self.tables, str(self.root / "checkpoint"), keep)
        query.awaitTermination()
        return query

    def flights(self):
        return {r.id: r.flight_status_public for r in current.current_tables(self.spark, self.tables)["flights"].collect()}

    def counts(self):
        return {(r.airport_code, r.nb_departing, r.nb_arriving) for r in current.current_congestion(self.spark, self.tables).collect()}

    def recount(self):
        moved = intermediate.document_movements(current.current_documents(self.spark, self.tables))
        found = intermediate.int_airport_congestion(moved)
        return {(r.airport_code, r.nb_departing, r.nb_arriving) for r in found.collect()}


@pytest.fixture
def load(spark, tmp_path):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield Load(spark, tmp_path)
    spark.conf.set("spark.sql.shuffle.partitions", before)


def test_newer_late_and_repeated_pages(load):
    load.land("2026-02-01 00:00:00", flight("F1"), flight("F2"), flight("F3"), NO_LEGS)
    load.run()
    assert load.counts() == load.recount() == {("AAA", 3, 0), ("BBB", 0, 3)}
    load.land("2026-02-03 00:00:00", flight("F1", ("AAA", "CCC"), "NEWER"))
    load.land("2026-02-02 00:00:00", flight("F1", ("AAA", "DDD"), "OLDER"), flight("F2", ("DDD", "BBB"), "MOVED"))
    load.run()  # a restart from the checkpoint
    load.land("2026-01-31 00:00:00", flight("F1", status="STALE"), flight("F3", status="STALE"))
    load.land("2026-02-01 00:00:00", flight("F3"))
    load.run()
    assert load.flights() == {"F1": "NEWER", "F2": "MOVED", "F3": "ON_TIME", NO_LEGS["id"]: load.flights()[NO_LEGS["id"]]}
    assert load.counts() == load.recount() == {("AAA", 2, 0), ("DDD", 1, 0), ("BBB", 0, 2), ("CCC", 0, 1)}


def test_only_touched_days_are_rewritten_and_reading_resolves_nothing(spark, load):
    load.land("2026-02-01 00:00:00", flight("F1"), flight("F2", ("EEE", "FFF")))
    load.run()
    counts = f"{load.tables}/congestion"
    batch = {r.airport_code: r.batch_id for r in read_table(spark, counts).collect()}
    for day in (2, 3):
        load.land(f"2026-02-0{day} 00:00:00", flight("F1", status=f"S{day}"))
    load.run()  # nothing that counts has changed
    assert {r.airport_code: r.batch_id for r in read_table(spark, counts).collect()} == batch
    load.land("2026-02-09 00:00:00", flight("F1", ("AAA", "GGG")))
    load.run()
    later = {r.airport_code: r.batch_id for r in read_table(spark, counts).collect()}
    assert later["AAA"] == batch["AAA"] and later["FFF"] == batch["FFF"] and later["GGG"] == later["BBB"] > batch["BBB"]
    plan = current.current_documents(spark, load.tables)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Window", "Join", "Exchange"))
    parts = [p for b, p in stored_tables._parts(spark, f"{load.tables}/documents").items() if b != "buckets"]
    assert len(parts) <= 2  # as many as there are flights' buckets, not batches


@pytest.mark.parametrize("fails", ["between the counts and the documents", "after both"])
def test_a_batch_that_failed_runs_again(spark, load, monkeypatch, fails):
    load.land("2026-02-01 00:00:00", flight("F1"), flight("F2"))
    load.run()
    load.land("2026-02-02 00:00:00", flight("F1", ("AAA", "CCC")), flight("F4"))
    real, calls = current.merge_into, []

    def broken(rows, path, *args, **kwargs):
        calls.append(path)
        if fails.startswith("between") and path.endswith("documents"):
            raise RuntimeError("lost")
        real(rows, path, *args, **kwargs)
        if fails == "after both" and path.endswith("documents"):
            raise RuntimeError("lost")

    monkeypatch.setattr(current, "merge_into", broken)
    with pytest.raises(Exception, match="lost"):
        load.run()
    monkeypatch.setattr(current, "merge_into", real)
    load.run()
    assert calls and load.counts() == load.recount() == {("AAA", 3, 0), ("BBB", 0, 2), ("CCC", 0, 1)}


def test_state_goes_with_the_watermark(load):
    load.land("2026-02-01 00:00:00", flight("F1"))
    load.run("1 day")
    for day in (5, 9):
        load.land(f"2026-02-{day:02d} 00:00:00", flight(f"G{day}"))
        query = load.run("1 day")
    rows = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    assert rows[-1] < 3
    load.land("2026-02-02 00:00:00", flight("F1", status="LATE"))  # seven days behind, the stream keeps one
    load.run("1 day")
    assert load.flights()["F1"] == "ON_TIME"
    load.land("2026-02-14 00:00:00", flight("F1", ("AAA", "ZZZ"), "NEW"))
    load.run("1 day")
    assert load.flights()["F1"] == "NEW" and load.counts() == load.recount()


def test_changes_of_counts(spark):
    schema = "departure_airport_code string, flight_schedule_date date, arrival_airport_code string, arrival_date date"
    day = F.lit("2026-01-01").cast("date")
    make = lambda pairs: spark.createDataFrame([(a, None, b, None) for a, b in pairs], schema).withColumns(
        {"flight_schedule_date": day, "arrival_date": F.when(F.col("arrival_airport_code").isNotNull(), day)}
    )
    old, new, rest = [("A", "B"), ("A", None)], [("A", "C"), ("B", "A"), (None, "B")], [("B", "A"), (None, None)]
    changes = congestion.congestion_changes(make(old), make(new))
    before = congestion.airport_congestion(make(old + rest), unique=True)
    touched = congestion.changed_congestion(before, changes)
    keys = [(r.airport_code, r.movement_date) for r in touched.collect()]
    assert len(keys) == len(set(keys)) == changes.count()
    kept = before.collect()
    state = {(r.airport_code, r.movement_date): (r.nb_departing, r.nb_arriving) for r in kept}
    state |= {(r.airport_code, r.movement_date): (r.nb_departing, r.nb_arriving) for r in touched.collect()}
    wanted = congestion.airport_congestion(make(new + rest), unique=True).collect()
    assert {k: v for k, v in state.items() if v != (0, 0)} == {(r.airport_code, r.movement_date): (r.nb_departing, r.nb_arriving) for r in wanted}
