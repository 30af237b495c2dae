import datetime
import uuid

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from legwork.functions import calendar, durations, keys, values


def one(spark, schema, row, *columns):
    return tuple(spark.createDataFrame([row], schema).select(*columns).first())


def column(spark, items, build, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(items)], f"i int, v {kind}")
    return [r[0] for r in rows.orderBy("i").select(build(F.col("v"))).collect()]


def test_uuid5_equals_the_standard_library(spark):
    names = ["20270318+ZA+4821_0", "", "é_ü_3", "a" * 200]
    assert column(spark, names, keys.uuid5) == [str(uuid.uuid5(uuid.NAMESPACE_DNS, n)) for n in names]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(st.characters(codec="utf-8", exclude_characters="\x00"), max_size=20), min_size=1, max_size=20))
def test_uuid5_on_any_text(spark, names):
    assert column(spark, names, keys.uuid5) == [str(uuid.uuid5(uuid.NAMESPACE_DNS, n)) for n in names]


def test_child_ids_follow_their_parents(spark):
    got = one(
        spark, "f string, i int, j int", ("F1", 2, 1), keys.leg_id(F.col("f"), F.col("i")), keys.delay_id(F.col("f"), F.col("i"), F.col("j"))
    )
    assert got == (str(uuid.uuid5(uuid.NAMESPACE_DNS, "F1_2")), str(uuid.uuid5(uuid.NAMESPACE_DNS, "F1_2_1")))


def test_pair_key_is_the_same_both_ways_and_null_for_a_missing_side(spark):
    a, b = F.col("a"), F.col("b")
    assert one(spark, "a string, b string", ("ZB+2", "ZA+1"), keys.pair_key(a, b), keys.pair_key(b, a)) == ("ZA+1+ZB+2",) * 2
    assert one(spark, "a string, b string", (None, "ZA+1"), keys.pair_key(a, b)) == (None,)


def test_parse_flight_id(spark):
    got = column(spark, ["20270318+ZA+4821", "20270318+ZA+4821+B", "bad"], keys.parse_flight_id)
    assert tuple(got[0]) == (datetime.date(2027, 3, 18), "ZA", "4821", None)
    assert got[1]["suffix"] == "B"
    assert tuple(got[2]) == (None, None, None, None)


def test_duration_styles(spark):
    texts = ["PT2H25M", "PT45M", "PT3H", "PT125M", "P1DT2H", None, "junk"]
    assert column(spark, texts, durations.duration_minutes) == [145, 45, 180, 125, 1560, 0, 0]
    plain = column(spark, texts, lambda c: durations.duration_minutes(c, "plain"))
    assert plain == [145, 45, 180, 125, 120, 0, 0]
    assert column(spark, texts, lambda c: durations.duration_minutes(c, "two_digit"))[3] == 25


def test_signed_minutes(spark):
    assert column(spark, ["PT-9M", "PT14M", "-PT1H5M", "PT-1H-5M", None], durations.signed_minutes) == [-9, 14, -65, -65, None]


def test_minutes_between_instants(spark):
    a, b = (calendar.instant(F.lit(t)) for t in ("2027-03-18T16:20:00.000-05:00", "2027-03-18T16:31:00.000-05:00"))
    assert one(spark, "x int", (1,), durations.minutes_between(a, b)) == (-11.0,)


def test_local_date_and_hour_ignore_the_offset(spark):
    text = F.lit("2027-03-18T22:41:00.000-05:00")
    got = one(
        spark,
        "x int",
        (1,),
        calendar.local_date(text).cast("string"),
        calendar.local_hour(text),
        calendar.local_hour(text, compat=True),
        F.to_date(calendar.instant(text)).cast("string"),
    )
    assert got == ("2027-03-18", 22, 41, "2027-03-19")


def test_weekdays(spark):
    friday = F.lit("2026-01-09").cast("date")
    assert one(spark, "x int", (1,), calendar.weekday(friday), calendar.sunday_first(friday), calendar.day_name(friday)) == (4, 5, "Friday")


def test_zulu_text(spark):
    assert one(spark, "x int", (1,), calendar.zulu_text(F.lit("2027-03-18 05:06:07").cast("timestamp"))) == ("2027-03-18T05:06:07.000Z",)


def test_date_series_spans_gaps_and_skips_an_empty_table(spark):
    days = spark.sql("select date '2026-02-27' d union all select date '2026-03-02'")
    assert calendar.date_series(days, "d").count() == 4
    assert calendar.date_series(days.where("false"), "d").count() == 0


def test_first_or_handles_null_and_empty_lists(spark):
    assert column(spark, [["a", "b"], [], None], lambda c: values.first_or(c, "00"), "array<string>") == ["a", "00", "00"]


def test_flags_and_numbers(spark):
    assert column(spark, ["Y", "N", None], values.is_yes) == [True, False, False]
    assert column(spark, ["0002", "x", None, "12"], values.int_or_zero) == [2, 0, 0, 12]
    assert column(spark, [14, 15, None], values.is_delayed, "int") == [False, True, False]


IRREGULARITY = (
    "x struct<delayInformation:array<struct<delayCode:string,delayDuration:string>>,"
    "delayCode:array<string>,delayDuration:array<string>>"
)


def entries(spark, value):
    found = one(spark, IRREGULARITY, (value,), values.delay_entries(F.col("x")))[0]
    return None if found is None else [tuple(e) for e in found]


def test_structured_delays_win_when_there_are_any(spark):
    assert entries(spark, ([("93", "45")], ["1"], ["2"])) == [("93", "45")]
    assert entries(spark, ([], ["1"], ["2"])) == [("1", "2")]


def test_parallel_lists_are_cut_to_the_shorter(spark):
    assert entries(spark, (None, ["1", "2", "3"], ["10", "20"])) == [("1", "10"), ("2", "20")]
    assert entries(spark, (None, ["1"], ["10", "20"])) == [("1", "10")]
    assert not entries(spark, (None, ["1"], None))
    assert not entries(spark, None)
