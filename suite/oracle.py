"""The same results in SQL, written from the rules of ``FIXTURES.md``."""

from __future__ import annotations

from legwork.operators.entities import ARRIVAL_FIELDS, DEPARTURE_FIELDS, LEG_FIELDS

DNS = "6ba7b8109dad11d180b400c04fd430c8"


def _uuid(name: str) -> str:
    h = f"sha1(unhex('{DNS}') || encode({name}))"
    return (
        f"substr({h},1,8)||'-'||substr({h},9,4)||'-5'||substr({h},14,3)||'-'"
        f"||translate(substr({h},17,1),'0123456789abcdef','89ab89ab89ab89ab')||substr({h},18,3)||'-'||substr({h},21,12)"
    )


def _stamp(minutes: str, offset: str) -> str:
    """ISO text of a local time given as minutes after midnight of the schedule date."""
    day = f"(flight_schedule_date + cast(floor({minutes}/1440.0) as int))"
    clock = f"((({minutes}) % 1440 + 1440) % 1440)"
    return (
        f"strftime({day},'%Y-%m-%d')||'T'||lpad(cast({clock}//60 as varchar),2,'0')||':'"
        f"||lpad(cast({clock}%60 as varchar),2,'0')||':00.000'||case when {offset}<0 then '-' else '+' end"
        f"||lpad(cast(abs({offset}) as varchar),2,'0')||':00'"
    )


BASE = f"""
li as (select * from (select l.*, row_number() over (partition by l_orderkey, l_linenumber
    order by l_shipdate desc, l_partkey desc, l_suppkey desc, l_extendedprice desc, l_quantity desc,
             l_discount desc, l_tax desc, l_returnflag desc, l_linestatus desc) rn from lineitem l) z where rn = 1),
fb as (select o_orderkey ok,
    date '2026-01-01' + cast(o_orderkey % 31 as int) flight_schedule_date,
    substr(c_mktsegment,1,2) airline_code, c_mktsegment airline_name,
    strftime(date '2026-01-01' + cast(o_orderkey % 31 as int), '%Y%m%d')||'+'||substr(c_mktsegment,1,2)||'+'||
      case when o_orderkey < 1000 then lpad(cast(o_orderkey as varchar),4,'0') else cast(o_orderkey as varchar) end flight_id,
    cast(o_orderkey % 500 + 1 as int) flight_number,
    case o_orderpriority when '1-URGENT' then 'LONG' when '2-HIGH' then 'MEDIUM' else 'SHORT' end haul,
    case o_orderstatus when 'F' then 'ARRIVED' when 'O' then 'ON_TIME' else 'DELAYED' end flight_status_public,
    c_nationkey arr_nation
  from orders join customer on o_custkey = c_custkey),
l0 as (select fb.*, li.*, s_nationkey dep_nation, p_type, p_brand,
    cast(row_number() over (partition by l_orderkey order by l_linenumber) - 1 as int) leg_order,
    (l_partkey*7 + l_linenumber*60) % 1440 dep_min, 45 + (l_suppkey*13 + l_linenumber*7) % 600 len,
    s_nationkey - 12 dep_off, arr_nation - 12 arr_off,
    cast(round(l_discount*100) as int)*3 - 6 late,
    cast(l_quantity as int) qty, o.ok % 17 <> 0 flown, l_suppkey % 13 <> 0 has_irr
  from li join (select ok from fb) o on l_orderkey = o.ok join fb on fb.ok = o.ok
    join supplier on l_suppkey = s_suppkey join part on l_partkey = p_partkey),
l1 as (select *, dep_min - dep_off*60 + len + arr_off*60 arr_min, late + cast(round(l_tax*100) as int) - 4 late_arr from l0),
lg as (select *, {_uuid("flight_id||'_'||cast(leg_order as varchar)")} leg_id,
    'N'||lpad(cast(dep_nation as varchar),2,'0') dep, 'N'||lpad(cast(arr_nation as varchar),2,'0') arr,
    case l_linestatus when 'F' then 'ARRIVED' else 'ON_TIME' end published_status,
    {_stamp("dep_min", "dep_off")} sch_dep,
    case when flown then {_stamp("(dep_min+late)", "dep_off")} end act_dep,
    {_stamp("arr_min", "arr_off")} sch_arr,
    case when flown then {_stamp("(arr_min+late_arr)", "arr_off")} end act_arr,
    flight_schedule_date + cast(floor(arr_min/1440.0) as int) arr_date,
    case when l_partkey % 41 <> 0 then 'PT'||case when len//60 > 0 then cast(len//60 as varchar)||'H' else '' end
      ||case when len%60 > 0 then cast(len%60 as varchar)||'M' else '' end end duration,
    case when l_partkey % 41 <> 0 then cast(len as int) else 0 end duration_min,
    l_returnflag = 'A' and l_partkey % 11 = 0 cancel_flag,
    case when l_partkey % 29 <> 0 then substr(p_type,1,3) end aircraft,
    lpad(cast(l_partkey % 40 as varchar),2,'0') code1, lpad(cast(l_suppkey % 40 + 50 as varchar),2,'0') code2,
    has_irr and qty > 30 late1, has_irr and qty > 45 late2
  from l1),
de as (select flight_id, leg_order, leg_id, 0 pos, code1 code, qty-30 mins from lg where late1
  union all select flight_id, leg_order, leg_id, 1, code2, qty-45 from lg where late2),
pl as (select leg_id, cast(sum(mins) as int) mins, cast(max(mins) as int) max_mins, count(*) n,
    string_agg(distinct code, '+' order by code) codes from de group by leg_id),
cg as (select airport_code, cast(movement_date as varchar) movement_date, cast(sum(d) as bigint) nb_departing, cast(sum(a) as bigint) nb_arriving from (
    select dep airport_code, flight_schedule_date movement_date, 1 d, 0 a from lg
    union all select arr, arr_date, 0, 1 from lg) m group by 1, 2),
dl as (select lg.*, pl.codes, pl.mins, case when flown then cast(late as double) end dep_delay,
    case when flown then cast(late_arr as double) end arr_delay from lg left join pl using (leg_id)),
fa as (select dl.*, cast(flight_schedule_date as varchar) d, coalesce(mins,0) >= 15 is_delayed,
    c1.nb_departing dd, c1.nb_arriving da, c2.nb_departing ad, c2.nb_arriving aa
  from dl left join cg c1 on c1.airport_code = dep and c1.movement_date = cast(flight_schedule_date as varchar)
    left join cg c2 on c2.airport_code = arr and c2.movement_date = cast(arr_date as varchar)),
ids as (select ok, flight_id from fb),
rel as (select f.flight_id, t.flight_id related_id,
    case f.ok % 4 when 1 then 'previous' when 2 then 'equivalent' else 'onward' end kind
  from fb f join ids t on t.ok = case f.ok % 4 when 1 then f.ok-1 when 0 then f.ok+1 when 2 then f.ok+4 end),
sh as (select airline_code||'+'||cast(flight_number as varchar) flight_key, 'XA' carrier, cast(ok % 900 + 1 as varchar) num from fb where ok % 3 > 0
  union all select airline_code||'+'||cast(flight_number as varchar), 'XB', cast(ok % 900 + 1 as varchar) from fb where ok % 3 = 2 and ok % 5 <> 0),
pr as (select *, flight_id||'+'||dep||'+'||arr leg_key, case when late1 then code1 else '' end fcode,
    case when late1 then lpad(cast(qty-30 as varchar),4,'0') else '00' end fdur,
    case when late1 then 'R'||code1 else '' end freason,
    case when has_irr then case when cancel_flag then 'Y' else 'N' end end cflag from lg),
en as (select dep_nation nat, dep code, qty from lg union all select arr_nation, arr, qty from lg),
ir as (select distinct leg_key, cflag, case when has_irr and cancel_flag then 'X1' end creason, fcode, fdur from pr)
"""


# Legs that models are trained on, and their vectors: each dimension divided by its deviation
TRAINED = "not coalesce(has_irr and cancel_flag, false)"
_NUMBERS = [
    "duration_min",
    "isodow(flight_schedule_date) - 1",
    "month(flight_schedule_date)",
    "dep_min // 60",
    "day(flight_schedule_date)",
    "coalesce(dd, 0)",
    "coalesce(da, 0)",
    "coalesce(ad, 0)",
    "coalesce(aa, 0)",
]
VECTORS = (
    ", tr as (select leg_id, is_delayed late, airline_code, coalesce(aircraft, '-') aircraft, "
    + ", ".join(f"cast({x} as double) b{i}" for i, x in enumerate(_NUMBERS, 1))
    + f" from fa where {TRAINED}), sd as (select "
    + ", ".join(f"coalesce(nullif(stddev_pop(b{i}), 0), 1) s{i}" for i in range(1, 10))
    + ", cast(count(*) as double) n from tr), vc as (select tr.*, "
    + ", ".join(f"b{i} / s{i} a{i}" for i in range(1, 10))
    + """ from tr, sd), wc as (select airline_code, 1 / (count(*) / n * (1 - count(*) / n)) w from tr, sd group by airline_code, n),
    wt as (select aircraft, 1 / (count(*) / n * (1 - count(*) / n)) w from tr, sd group by aircraft, n)"""
)


def _sql(select: str) -> str:
    return f"with {BASE} {select}"


def us(text: str) -> str:
    return f"epoch_us(cast({text} as timestamptz))"


def _null_columns(fields: list[tuple[str, str]], known: dict[str, str]) -> str:
    return ", ".join(f"{known.get(name, 'cast(null as varchar)')} as \"{name}\"" for _, name in fields)


DELAYS_LEG = f"""select leg_id, flight_id, flight_number, cast(flight_schedule_date as varchar) flight_schedule_date,
  airline_code, airline_name, leg_order, dep departure_airport_code, arr arrival_airport_code,
  {us('sch_dep')} scheduled_departure, {us('act_dep')} actual_departure, {us('sch_arr')} scheduled_arrival,
  {us('act_arr')} actual_arrival, sch_dep scheduled_departure_text, sch_arr scheduled_arrival_text,
  has_irr and cancel_flag cancelled, aircraft aircraft_type_code, codes delay_code, mins delay_duration_minutes,
  dep_delay departure_delay_minutes, arr_delay arrival_delay_minutes, duration_min scheduled_flight_duration_min"""
CALENDAR = """cast(isodow(flight_schedule_date) - 1 as int) departure_weekday, 1 departure_month,
  cast(dep_min // 60 as int) departure_hour, cast(day(flight_schedule_date) as int) departure_monthday,
  dd dep_airport_nb_departing, da dep_airport_nb_arriving, ad arr_airport_nb_departing, aa arr_airport_nb_arriving, is_delayed"""
STATS = """count(*) nb_legs, round(avg(coalesce(mins,0)),6) mean_delay, round(avg(case when is_delayed then 1.0 else 0.0 end),6) delay_rate,
  round(stddev_samp(coalesce(mins,0)),6) volatility"""
GEO = """code "airportCode", 'AIRPORT '||cast(nat as varchar) "airportName", cast(nat*3-30 as double) latitude,
  cast(nat*7-80 as double) longitude, 'C'||lpad(cast(nat%10 as varchar),2,'0') "cityCode\""""
CITY = """'C'||lpad(cast(nat%10 as varchar),2,'0') "cityCode", 'CITY '||cast(nat%10 as varchar) "cityName",
  'R'||cast(nat%5 as varchar) "countryCode\""""
COUNTRY = """'R'||cast(nat%5 as varchar) "countryCode", 'COUNTRY '||cast(nat%5 as varchar) "countryName",
  case when nat%5=3 then 'Y' else 'N' end "euroCountry", case when nat%5>=3 then 'Y' else 'N' end "euCountry",
  'A'||cast(nat%5%2 as varchar) "areaCode\""""
PAGES = """pc as (select event_type, cast(cast(ts as date) as varchar) "day", cast(ceil(count(*)/50.0) as int) n from events group by 1, 2),
  pp as (select event_type, "day", cast(p as int) page_number from (select event_type, "day", unnest(range(n)) p from pc) z)"""
LATEST_EVENTS = """select user_id, event_type, event_id, epoch_us(ts) ts, value from (select e.*, row_number() over
  (partition by user_id, event_type order by ts desc, event_id desc) rn from events e) z where rn = 1"""
LEG_KNOWN = {
    "scheduledFlightDuration": "duration",
    "departureDateTimeDifference": "'PT'||cast(late as varchar)||'M'",
    "aircraftCode": "aircraft",
}
DEP_KNOWN = {
    "departureGateNumber": "'G'||cast(qty%20 as varchar)",
    "departureAirportCode": "dep",
    "departureActualTime": "act_dep",
    "departureScheduledTime": "sch_dep",
}
ARR_KNOWN = {
    "arrivalGateNumber": "'G'||cast(qty%20 as varchar)",
    "arrivalAirportCode": "arr",
    "arrivalActualTime": "act_arr",
    "arrivalScheduledTime": "sch_arr",
}

ORACLE: dict[str, str] = {
    "flights": _sql(
        """select flight_id id, flight_number, cast(flight_schedule_date as varchar) flight_schedule_date, airline_code,
        airline_name, haul, route, flight_status_public, '2026-02-01 00:00:00' fetched_at
        from fb left join (select ok, min(case when leg_order=0 then dep end)||'>'||string_agg(arr, '>' order by leg_order) route
          from lg group by ok) r on r.ok = fb.ok"""
    ),
    "legs": _sql(
        """select leg_id id, flight_id, leg_order, dep departure_airport_code, arr arrival_airport_code, published_status,
        sch_dep scheduled_departure, act_dep actual_departure, sch_arr scheduled_arrival, act_arr actual_arrival,
        duration scheduled_flight_duration, has_irr and cancel_flag cancelled, aircraft aircraft_type_code from lg"""
    ),
    "delays": _sql(
        f"""select {_uuid("flight_id||'_'||cast(leg_order as varchar)||'_'||cast(pos as varchar)")} id, leg_id flight_leg_id,
        code delay_code, lpad(cast(mins as varchar),4,'0') delay_duration from de"""
    ),
    "route_stops": _sql(
        """select flight_id, 0 "position", dep airport_code from lg where leg_order = 0
        union all select flight_id, cast(leg_order + 1 as int), arr from lg"""
    ),
    "raw_upsert": _sql(
        """select flight_id id, 'flightstatus' source, airline_code, cast(n as int) nb_legs, '2026-02-01 00:00:00' fetched_at
        from fb left join (select ok, count(*) n from lg group by ok) r on r.ok = fb.ok"""
    ),
    "raw_documents": _sql(
        f"""select flight_id, flight_number, cast(flight_schedule_date as varchar) flight_schedule_date, haul,
        first_value(dep) over w||'>'||string_agg(arr,'>') over w route, airline_code, airline_name, flight_status_public,
        leg_order, dep departure_airport_code, arr arrival_airport_code, published_status leg_status,
        {us('sch_dep')} scheduled_departure, {us('act_dep')} actual_departure, {us('sch_arr')} scheduled_arrival,
        {us('act_arr')} actual_arrival, duration scheduled_flight_duration,
        case when has_irr then cancel_flag end cancelled,
        cast(case when late1 then 1 else 0 end + case when late2 then 1 else 0 end as int) nb_delays,
        '2026-02-01 00:00:00' fetched_at from lg
        window w as (partition by flight_id order by leg_order rows between unbounded preceding and unbounded following)"""
    ),
    "flattened": _sql(
        """select fb.flight_id id, airline_code airline_code, airline_name airline_name,
        case when kind='previous' then related_id end "flightRelations_previousFlightData_id",
        case when kind='equivalent' then related_id end "flightRelations_equivalentFlightData_id",
        case when kind='onward' then related_id end "flightRelations_onwardFlightData_id"
        from fb left join rel using (flight_id)"""
    ),
    "merge_latest": LATEST_EVENTS,
    "merge_upsert": LATEST_EVENTS,
    "merge_composite": _sql(
        f"""select flight_iata, dep_iata, arr_iata, status, dep_time, arr_time, updated_at from (select *, row_number() over
        (partition by flight_iata, dep_time order by updated_at desc, status desc, arr_time desc, dep_iata desc, arr_iata desc) rn
        from (select airline_code||cast(flight_number as varchar) flight_iata, dep dep_iata, arr arr_iata, published_status status,
          {us('sch_dep')} dep_time, {us('sch_arr')} arr_time,
          epoch_us(cast(flight_schedule_date as timestamp) + qty * interval 1 hour) updated_at
          from lg where duration is not null) s) z where rn = 1"""
    ),
    "merge_airports": _sql(
        """select iata_code, icao_code, name, lat, lng, city, created_at, last_updated_at from (select dep iata_code, 'K'||dep icao_code,
        'AIRPORT '||cast(qty as varchar) name, cast(dep_nation as double) lat, cast(qty as double) lng, 'CITY' city,
        min(t) over (partition by dep) created_at, max(t) over (partition by dep) last_updated_at,
        row_number() over (partition by dep order by t desc, 'AIRPORT '||cast(qty as varchar) desc) rn
        from (select *, epoch_us(cast(flight_schedule_date as timestamp) + qty * interval 1 hour) t from lg) s) z where rn = 1"""
    ),
    "merge_children": """select l_orderkey, l_linenumber, l_partkey, l_suppkey from (select *, max(l_shipdate) over
        (partition by l_orderkey) newest from lineitem) z where l_shipdate = newest""",
    "window_plan": """select event_type, epoch_us(w) window_start, epoch_us(e2) window_end,
        strftime(w, '%Y-%m-%dT%H:%M:%S.000Z') start_range, strftime(e2, '%Y-%m-%dT%H:%M:%S.000Z') end_range
        from (select event_type, w, least(w + interval 1 day, e) e2 from (select event_type, e, unnest(generate_series(s, e, interval 1 day)) w
          from (select event_type, min(ts) s, max(ts) e from events group by 1) a) b where w < e) c""",
    "page_plan": f"with {PAGES} select * from pp",
    "missing_pages": f"""with {PAGES} select * from pp where (page_number + cast(day(cast("day" as date)) as int)) % 3 = 0""",
    "resolve_window": """select 'saved' run, (select epoch_us(max(ts)) from events) "start", epoch_us(timestamp '2024-02-01') "end"
        union all select 'fixed', epoch_us(timestamp '2024-01-05'), epoch_us(timestamp '2024-01-06')
        union all select 'fallback', epoch_us(timestamp '2024-01-31'), epoch_us(timestamp '2024-02-01')""",
    "freshness": """select latest, round(a, 6) age_days, case when a is null or a > 3 then 'error' when a > 1 then 'warn' else 'pass' end status
        from (select epoch_us(max(ts)) latest, (epoch_us(timestamp '2024-02-01 12:00:00') - epoch_us(max(ts))) / 8.64e10 a from events) z""",
    "table_counts": _sql(
        """select 'documents' table_name, count(*) row_count from fb union all select 'flights', count(*) from fb
        union all select 'legs', count(*) from lg union all select 'delays', count(*) from de"""
    ),
    "grain_check": "select l_orderkey, l_linenumber, count(*) n from lineitem group by 1, 2 having count(*) > 1",
    "orphans": "select doc_id, lang, source from documents where doc_id not in (select doc_id from labels)",
    "missing_pct": _sql(
        """select * from (select column_name, round(100*p, 6) percentage from (
        select 'scheduled_flight_duration' column_name, avg(case when duration is null then 1.0 else 0 end) p from lg
        union all select 'aircraft_type_code', avg(case when aircraft is null then 1.0 else 0 end) from lg
        union all select 'actual_departure', avg(case when act_dep is null then 1.0 else 0 end) from lg
        union all select 'actual_arrival', avg(case when act_arr is null then 1.0 else 0 end) from lg
        union all select 'departure_airport_code', avg(case when dep is null then 1.0 else 0 end) from lg) z) y where percentage > 0"""
    ),
    "profile": _sql(
        """select 'id' column_name, count(leg_id) non_null, 'string' data_type from lg
        union all select 'flight_id', count(flight_id), 'string' from lg union all select 'leg_order', count(leg_order), 'int' from lg
        union all select 'departure_airport_code', count(dep), 'string' from lg
        union all select 'arrival_airport_code', count(arr), 'string' from lg
        union all select 'published_status', count(published_status), 'string' from lg
        union all select 'scheduled_departure', count(sch_dep), 'string' from lg
        union all select 'actual_departure', count(act_dep), 'string' from lg
        union all select 'scheduled_arrival', count(sch_arr), 'string' from lg
        union all select 'actual_arrival', count(act_arr), 'string' from lg
        union all select 'scheduled_flight_duration', count(duration), 'string' from lg
        union all select 'cancelled', count(*), 'boolean' from lg
        union all select 'aircraft_type_code', count(aircraft), 'string' from lg"""
    ),
    "cardinality": _sql(
        """select 'aircraft_type_code' column_name, count(distinct coalesce(aircraft,'?')) n_values from lg
        union all select 'departure_airport_code', count(distinct dep) from lg
        union all select 'arrival_airport_code', count(distinct arr) from lg"""
    ),
    "value_counts": _sql("select dep departure_airport_code, count(*) n from lg group by 1"),
    "describe_delay": _sql(
        """select count(*) n, round(avg(m),6) mean, round(stddev_samp(m),6) std, cast(min(m) as double) min, quantile_cont(m,0.25) p25,
        quantile_cont(m,0.5) p50, quantile_cont(m,0.75) p75, cast(max(m) as double) max from (select cast(mins as double) m from pl) z"""
    ),
    "join_guard": _sql(
        """select a before_rows, b after_rows, b - a added_rows from (select (select count(*) from pr) a,
        (select count(*) from pr left join ir using (leg_key)) b) z"""
    ),
    "congestion_departures": _sql("select airport_code, movement_date, nb_departing from cg where nb_departing > 0"),
    "congestion_arrivals": _sql("select airport_code, movement_date, nb_arriving from cg where nb_arriving > 0"),
    "congestion_inner": _sql("select * from cg where nb_departing > 0 and nb_arriving > 0"),
    "congestion_full": _sql("select * from cg"),
    "int_delays_leg": _sql(f"{DELAYS_LEG} from dl"),
    "int_delays_leg_max": _sql(
        "select lg.leg_id, codes delay_code, max_mins delay_duration_minutes from lg left join pl using (leg_id)"
    ),
    "delays_per_leg_first": _sql(
        """select leg_id flight_leg_id, cast(min(case when pos = 0 then mins end) as int) delay_duration_minutes, count(*) nb_delays,
        string_agg(distinct code, '+' order by code) delay_code from de group by 1"""
    ),
    "int_delays_exploded": _sql(
        f"""select flight_id, flight_number, cast(flight_schedule_date as varchar) flight_schedule_date, airline_code, airline_name, leg_order,
        dep departure_airport_code, arr arrival_airport_code, {us('sch_dep')} scheduled_departure, {us('act_dep')} actual_departure,
        {us('sch_arr')} scheduled_arrival, {us('act_arr')} actual_arrival, case when has_irr then cancel_flag end cancelled,
        code delay_code, de.mins delay_duration_minutes, dep_delay departure_delay_minutes, arr_delay arrival_delay_minutes
        from dl left join (select leg_id, code, mins from de) de using (leg_id)"""
    ),
    "int_legs_ready": _sql(f"{DELAYS_LEG}, cast(arr_date as varchar) arrival_date, {CALENDAR} from fa"),
    "fct_flight_legs": _sql(
        f"""select leg_id, flight_id, flight_number, airline_code airline_key, dep departure_airport_key, arr arrival_airport_key,
        d date_key, {us('sch_dep')} scheduled_departure, {us('act_dep')} actual_departure, {us('sch_arr')} scheduled_arrival,
        {us('act_arr')} actual_arrival, has_irr and cancel_flag cancelled, codes delay_code, mins delay_duration_minutes,
        dep_delay departure_delay_minutes, arr_delay arrival_delay_minutes, duration_min scheduled_flight_duration_min,
        aircraft aircraft_type_code, {CALENDAR} from fa"""
    ),
    "dim_airlines": _sql("select distinct airline_code airline_key, airline_code, airline_name from lg"),
    "dim_airports": _sql("select distinct code airport_key, code airport_code from en"),
    "dim_date": _sql(
        """select cast(cast(d as date) as varchar) date_key, cast(dayofweek(d) as int) day_of_week, cast(month(d) as int) "month",
        cast(year(d) as int) "year", dayname(d) day_name from (select unnest(generate_series(min(flight_schedule_date),
        max(flight_schedule_date), interval 1 day)) d from lg) z"""
    ),
    "dim_surrogate": _sql(
        """select code airport_key, code airport_code, cast(row_number() over (order by code) as int) surrogate_key
        from (select distinct code from en) z"""
    ),
    "star_join": _sql(
        """select leg_id, airline_name, dep departure_airport_code, arr arrival_airport_code, dayname(flight_schedule_date) day_name,
        cast(dayofweek(flight_schedule_date) as int) day_of_week, 1 "month", 2026 "year", is_delayed from fa"""
    ),
    "codeshare": _sql(
        """select least(flight_key, r)||'+'||greatest(flight_key, r) "codeShareId", flight_key "flightId", r "relatedFlightId"
        from (select flight_key, carrier||'+'||num r from sh) z"""
    ),
    "codeshare_flights": _sql(
        """select distinct carrier||'+'||num "flightId", num "flightNumber", carrier "airlineCode" from sh"""
    ),
    "flight_relation": _sql(
        """select related_id||'+'||flight_id "flightRelationId", flight_id "scheduledFlightId",
        related_id "relatedScheduledFlightId", kind "relationType" from rel"""
    ),
    "relation_join": _sql(
        """select related_id||'+'||rel.flight_id "flightRelationId", rel.flight_id "scheduledFlightId",
        related_id "relatedScheduledFlightId", kind "relationType", cast(a.flight_schedule_date as varchar) "flightScheduleDate",
        a.airline_code "flightAirlineCode", cast(b.flight_schedule_date as varchar) "relatedScheduleDate",
        b.airline_code "relatedAirlineCode" from rel join fb a on a.flight_id = rel.flight_id join fb b on b.flight_id = related_id"""
    ),
    "entity_scheduled_flight": _sql(
        """select flight_id "scheduledFlightId", flight_number "flightNumber", cast(flight_schedule_date as varchar) "flightScheduleDate",
        haul, route, flight_status_public "flightStatusPublic", airline_code "airlineCode"
        from fb left join (select ok, min(case when leg_order=0 then dep end)||'>'||string_agg(arr, '>' order by leg_order) route
          from lg group by ok) r on r.ok = fb.ok"""
    ),
    "entity_flight": _sql(
        """select distinct airline_code||'+'||cast(flight_number as varchar) "flightId", cast(flight_number as varchar) "flightNumber",
        airline_code "airlineCode" from fb"""
    ),
    "entity_airline": _sql("""select distinct airline_code "airlineCode", airline_name "airlineName" from fb"""),
    "entity_flight_leg": _sql(
        f"""select leg_key "flightLegId", flight_id "scheduledFlightId", {_null_columns(LEG_FIELDS, LEG_KNOWN)},
        {_null_columns(DEPARTURE_FIELDS, DEP_KNOWN)}, {_null_columns(ARRIVAL_FIELDS, ARR_KNOWN)} from pr"""
    ),
    "entity_airport": _sql(f"select distinct {GEO} from en"),
    "entity_city": _sql(f"select distinct {CITY} from en"),
    "entity_country": _sql(f"select distinct {COUNTRY} from en"),
    "entity_aircraft": _sql(
        """select distinct aircraft "aircraftCode", t "aircraftName", o "ownerAirlineCode", cast(null as varchar) "physicalPaxConfiguration",
        cast(null as varchar) "physicalFreightConfiguration", cast(null as varchar) "operationalConfiguration",
        cast(null as varchar) "cockpitCrewEmployerCode", cast(null as varchar) "cabinCrewEmployerCode", b registration,
        cast(null as varchar) "saleableConfiguration", cast(null as varchar) "subFleetCodeId", aircraft "typeCode", t "typeName"
        from (select aircraft, case when aircraft is not null then p_type end t, case when aircraft is not null then p_brand end b,
          case when aircraft is not null then airline_code end o from pr) z"""
    ),
    "entity_irregularity": _sql(
        """select leg_key "flightLegId", cflag cancelled, creason "cancellationReasonCode", fcode "delayCode", fdur "delayDuration" from ir"""
    ),
    "entity_delay": _sql("""select distinct fcode "delayCode", freason "delayReasonCode" from pr"""),
    "entity_delay_reason": _sql(
        """select distinct freason "delayReasonCode", case when freason = '' then '' else 'Reason '||freason end "delayReason" from pr"""
    ),
    "entity_cancel_reason": _sql(
        """select distinct c "cancellationReasonCode", 'Short '||c "cancellationReasonShort", 'Long '||c "cancellationReasonLong"
        from (select case when cflag = 'Y' then 'X1' end c from pr) z"""
    ),
    "legs_irregularity": _sql(
        """select pr.leg_key "flightLegId", flight_id "scheduledFlightId", duration "scheduledFlightDuration", ir.fdur "delayDuration"
        from pr left join ir on ir.leg_key = pr.leg_key"""
    ),
    "airport_geography": _sql(
        f"""select distinct {GEO}, 'CITY '||cast(nat%10 as varchar) "cityName", {COUNTRY} from en"""
    ),
    "leg_aircraft_owner": _sql(
        """select leg_key "flightLegId", pr.aircraft "aircraftCode", t "aircraftName", o "ownerAirlineCode", n "ownerAirlineName"
        from pr left join (select distinct aircraft, p_type t, airline_code o, airline_name n from lg where aircraft is not null) a
        on a.aircraft = pr.aircraft"""
    ),
    "airline_rank": _sql(
        f"""select * exclude(m), cast(rank() over (order by m) as int) punctuality_rank from (
        select airline_code airline_key, avg(coalesce(mins,0)) m, {STATS} from fa group by 1) z"""
    ),
    "airport_rank": _sql(
        f"""select * exclude(m), cast(rank() over (partition by role order by m) as int) punctuality_rank from (
        select role, airport_key, avg(coalesce(mins,0)) m, {STATS} from (select 'departure' role, dep airport_key, * from fa
        union all select 'arrival', arr, * from fa) y group by 1, 2) z"""
    ),
    "chronic_flights": _sql(
        """select airline_code airline_key, flight_number, count(*) nb_legs, cast(sum(case when is_delayed then 1 else 0 end) as bigint) nb_delayed,
        round(avg(case when is_delayed then 1.0 else 0 end), 6) delay_rate from fa group by 1, 2
        having count(*) >= 5 and avg(case when is_delayed then 1.0 else 0 end) >= 0.2"""
    ),
    "chronic_routes": _sql(
        """select dep departure_airport_key, arr arrival_airport_key, count(*) nb_legs, cast(sum(case when is_delayed then 1 else 0 end) as bigint) nb_delayed,
        round(avg(case when is_delayed then 1.0 else 0 end), 6) delay_rate from fa group by 1, 2
        having count(*) >= 20 and avg(case when is_delayed then 1.0 else 0 end) >= 0.15"""
    ),
    "delay_causes": _sql(
        """select code delay_code, count(*) nb_delays, cast(sum(mins) as bigint) total_minutes,
        round(sum(mins) / (select cast(sum(mins) as double) from de), 6) minutes_share from de group by 1"""
    ),
    "flight_search": _sql(
        f"""select leg_id, flight_id, {us('sch_arr')} scheduled_arrival, dep departure_airport_code from lg
        where cast(sch_arr as timestamptz) >= timestamptz '2026-01-05 00:00:00+00' and cast(sch_arr as timestamptz) < timestamptz '2026-01-12 00:00:00+00'
        and airline_code = 'HO' and arr = 'N07'"""
    ),
    "flight_search_departures": _sql(
        f"""select leg_id, flight_id, {us('act_dep')} actual_departure, arr arrival_airport_code from lg
        where cast(act_dep as timestamptz) >= timestamptz '2026-01-10 06:00:00+00' and cast(act_dep as timestamptz) < timestamptz '2026-01-10 18:00:00+00'
        and dep = 'N03' and flight_schedule_date between date '2026-01-08' and date '2026-01-12'"""
    ),
    "flight_lookup": _sql("select flight_id id, airline_name, haul from fb where flight_id = '20260102+MA+0001'"),
    "duration_minutes": _sql(
        """select leg_id id, duration, duration_min "minutes", duration_min plain_minutes, duration_min two_digit_minutes from lg"""
    ),
    "signed_duration": _sql(
        """select leg_key "flightLegId", 'PT'||cast(late as varchar)||'M' difference, late "minutes", abs(late) unsigned_minutes from pr"""
    ),
    "id_parse": _sql(
        """select flight_id id, cast(flight_schedule_date as varchar) schedule_date, airline_code carrier,
        case when ok < 1000 then lpad(cast(ok as varchar),4,'0') else cast(ok as varchar) end number, cast(null as varchar) suffix from fb"""
    ),
    "local_calendar": _sql(
        """select leg_id id, cast(flight_schedule_date as varchar) departure_date, cast(arr_date as varchar) arrival_date,
        cast(isodow(flight_schedule_date) - 1 as int) weekday, 1 "month", cast(day(flight_schedule_date) as int) monthday,
        cast(dep_min // 60 as int) "hour", cast(dep_min % 60 as int) compat_hour,
        cast(flight_schedule_date + cast(floor((dep_min - dep_off*60)/1440.0) as int) as varchar) utc_date from lg"""
    ),
    "list_rules": _sql(
        """select leg_key "flightLegId", fcode first_code, fdur first_duration, cast(fdur as int) first_minutes,
        cast(case when late1 then 1 else 0 end + case when late2 then 1 else 0 end as int) nb_pairs, has_irr and cancel_flag cancelled from pr"""
    ),
    # ---- features, metrics, oversampling, landed pages ----
    "dummies": _sql(
        "select leg_id, "
        + ", ".join(
            f"case when aircraft = '{v}' then 1.0::double else 0.0::double end \"aircraft_type_code_{v}\""
            for v in ("LAR", "MED", "PRO", "SMA", "STA")
        )
        + " from fa"
    ),
    "one_hot": _sql(
        "select leg_id, "
        + ", ".join(
            f"case when coalesce(aircraft, '__MISSING__') = '{v}' then 1.0::double else 0.0::double end \"aircraft_type_code_{v}\""
            for v in ("ECO", "LAR", "MED", "PRO", "SMA", "STA", "__MISSING__")
        )
        + " from fa"
    ),
    "minmax": _sql(
        """select leg_id, round((duration_min - lo) / (hi - lo), 6) scheduled_flight_duration_min, 0.0::double departure_month,
        round((dd - dlo) / (dhi - dlo), 6) dep_airport_nb_departing from fa, (select cast(min(duration_min) as double) lo,
        cast(max(duration_min) as double) hi, cast(min(dd) as double) dlo, cast(max(dd) as double) dhi from fa) b"""
    ),
    "standard": _sql(
        """select leg_id, round((duration_min - m1) / s1, 6) scheduled_flight_duration_min, 0.0::double departure_month,
        round((dd - m2) / s2, 6) dep_airport_nb_departing from fa, (select avg(duration_min) m1, stddev_pop(duration_min) s1,
        avg(dd) m2, stddev_pop(dd) s2 from fa) b"""
    ),
    "numeric_features": _sql(
        """select leg_id, duration_min scheduled_flight_duration_min, cast(isodow(flight_schedule_date) - 1 as int) departure_weekday,
        0 departure_month, cast(dep_min // 60 as int) departure_hour, cast(day(flight_schedule_date) as int) departure_monthday,
        cast(dd as int) dep_airport_nb_departing, cast(coalesce(da,0) as int) dep_airport_nb_arriving,
        cast(coalesce(ad,0) as int) arr_airport_nb_departing, cast(aa as int) arr_airport_nb_arriving from fa"""
    ),
    "anova_topk": _sql(
        "select feature, round(f, 4) f_value from (select feature, "
        "(sum(n * (m - g) * (m - g)) / (count(*) - 1)) / (sum(n * v) / (sum(n) - count(*))) f from ("
        "select *, sum(n * m) over (partition by feature) / sum(n) over (partition by feature) g from ("
        + " union all ".join(
            f"select '{name}' feature, is_delayed, cast(count(*) as double) n, avg(cast({x} as double)) m, var_pop(cast({x} as double)) v from fa group by 2"
            for name, x in {
                "scheduled_flight_duration_min": "duration_min",
                "departure_weekday": "isodow(flight_schedule_date)",
                "departure_hour": "dep_min // 60",
                "departure_monthday": "day(flight_schedule_date)",
                "dep_airport_nb_departing": "coalesce(dd,0)",
                "dep_airport_nb_arriving": "coalesce(da,0)",
                "arr_airport_nb_departing": "coalesce(ad,0)",
                "arr_airport_nb_arriving": "coalesce(aa,0)",
            }.items()
        )
        + ") a) b group by feature) c order by f desc limit 5"
    ),
    "class_weight": _sql(
        """select is_delayed, n, round((select count(*) from fa) / (2.0 * n), 6) weight from
        (select is_delayed, count(*) n from fa group by 1) z"""
    ),
    "stratified_split": _sql(
        """select is_delayed, n, cast(fl + case when r <= left_over then 1 else 0 end as bigint) nb_test from (
        select *, t - sum(fl) over () left_over, row_number() over (order by ex - fl desc) r from (
        select is_delayed, n, t, t * n / cast(tot as double) ex, t * n // tot fl from (
        select *, cast(ceil(tot / 5.0) as bigint) t from (select is_delayed, n, cast(sum(n) over () as bigint) tot from (
        select is_delayed, count(*) n from fa group by 1) a) b) c) d) e"""
    ),
    "confusion_metrics": _sql(
        """select tp, fp, fn, tn, round((tp+tn)/cast(tp+fp+fn+tn as double),6) accuracy,
        case when tp+fp = 0 then 0 else round(tp/cast(tp+fp as double),6) end "precision",
        case when tp+fn = 0 then 0 else round(tp/cast(tp+fn as double),6) end recall,
        case when 2*tp+fp+fn = 0 then 0 else round(2*tp/cast(2*tp+fp+fn as double),6) end f1 from (
        select count(*) filter (y and p) tp, count(*) filter (not y and p) fp, count(*) filter (y and not p) fn,
        count(*) filter (not y and not p) tn from (select is_delayed y, coalesce(dep_delay,0) >= 15 p from fa) a) b"""
    ),
    "roc_auc": _sql(
        """select round((sum(case when y then r end) - count(*) filter (y) * (count(*) filter (y) + 1) / 2.0)
        / (cast(count(*) filter (y) as double) * count(*) filter (not y)), 6) auc from (
        select y, rank() over (order by s) + (count(*) over (partition by s) - 1) / 2.0 r from (
        select is_delayed y, coalesce(dep_delay,0) * 1000 + duration_min s from fa) a) b"""
    ),
    "smote_neighbours": _sql(
        VECTORS
        + """, pt as (select *, row_number() over (order by rep) place from (select min(leg_id) rep, airline_code, aircraft, a1, a2, a3, a4, a5, a6, a7, a8, a9
          from vc where late group by all) z)
        select rep, count(*) nb_neighbours, round(sum(dist), 5) total_distance from (
        select rep, dist, row_number() over (partition by rep order by dist) rn from (
        select x.rep, sqrt("""
        + "+".join(f"(x.a{i}-y.a{i})*(x.a{i}-y.a{i})" for i in range(1, 10))
        + """ + case when x.airline_code = y.airline_code then 0 else xc.w + yc.w end
          + case when x.aircraft = y.aircraft then 0 else xt.w + yt.w end) dist
        from pt x join pt y on x.place <> y.place
        join wc xc on xc.airline_code = x.airline_code join wc yc on yc.airline_code = y.airline_code
        join wt xt on xt.aircraft = x.aircraft join wt yt on yt.aircraft = y.aircraft) v) w where rn <= 5 group by rep"""
    ),
    "smote_balanced": _sql(
        f"""select cast(is_delayed as int) "label", most nb_rows, most - n nb_synthetic, 0::bigint nb_outside from (
        select is_delayed, n, max(n) over () most from (select is_delayed, count(*) n from fa where {TRAINED} group by 1) a) b"""
    ),
    "forest_metrics": _sql(
        f"""select max(nb_test) filter (is_delayed) nb_late, max(nb_test) filter (not is_delayed) nb_in_time, true ranks from (
        select is_delayed, cast(fl + case when r <= left_over then 1 else 0 end as bigint) nb_test from (
        select *, t - sum(fl) over () left_over, row_number() over (order by ex - fl desc) r from (
        select is_delayed, t, t * n / cast(tot as double) ex, t * n // tot fl from (
        select *, cast(ceil(tot / 5.0) as bigint) t from (select is_delayed, n, cast(sum(n) over () as bigint) tot from (
        select is_delayed, count(*) n from fa where {TRAINED} group by 1) a) b) c) d) e) f"""
    ),
    "feature_importance": _sql(
        """select feature, 1.0::double total from (
        select unnest(['scheduled_flight_duration_min', 'departure_weekday', 'departure_month', 'departure_hour', 'departure_monthday',
          'dep_airport_nb_departing', 'dep_airport_nb_arriving', 'arr_airport_nb_departing', 'arr_airport_nb_arriving']) feature
        union all select distinct 'airline_key_'||airline_code from fa
        union all select distinct 'aircraft_type_code_'||coalesce(aircraft, '__MISSING__') from fa) z"""
    ),
    "json_scan": _sql(
        """select flight_id id, airline_name, route, cast(n as int) nb_legs, '2026-02-01 00:00:00' fetched_at
        from fb left join (select ok, count(*) n, min(case when leg_order=0 then dep end)||'>'||string_agg(arr, '>' order by leg_order) route
          from lg group by ok) r on r.ok = fb.ok"""
    ),
    "stream_merge": _sql(
        """select flight_id id, case when flight_number % 2 = 0 then 'UPDATED' else flight_status_public end flight_status_public,
        case when flight_number % 2 = 0 then '2026-02-02 00:00:00' else '2026-02-01 00:00:00' end fetched_at,
        coalesce(n, 0) nb_legs, cast(case when flight_number % 2 = 0 then 0 else coalesce(k, 0) end as bigint) nb_delays
        from fb left join (select ok, count(*) n, sum(case when late1 then 1 else 0 end + case when late2 then 1 else 0 end) k
          from lg group by ok) r on r.ok = fb.ok"""
    ),
}
ORACLE["fct_from_documents"] = ORACLE["fct_flight_legs"]
ORACLE["int_delays_nested"] = ORACLE["int_delays_leg"]
ORACLE["int_delays_nested_max"] = ORACLE["int_delays_leg_max"]
ORACLE["schedule_scan"] = _sql(
    """select airline_code||cast(flight_number as varchar) flight_iata, dep dep_iata, cast(null as varchar) arr_iata,
    published_status status, epoch_us(cast(flight_schedule_date as timestamp) + dep_min * interval 1 minute) dep_time,
    '2026-02-01 00:00:00' ingested_at from lg"""
)
ORACLE["append_and_replace"] = _sql(
    "select 'appended' table_name, 2 * count(*) row_count from de union all select 'replaced', count(*) from de"
)
for _name in ("forest_scored", "model_reloaded", "gbt_scored"):
    ORACLE[_name] = _sql(f"select leg_id, flight_id, true in_range, true agrees from fa where {TRAINED}")
ORACLE["legs_left_flights"] = _sql(
    """select leg_id id, flight_id, leg_order, case when flight_number % 7 <> 0 then flight_number end flight_number,
    case when flight_number % 7 <> 0 then airline_code end airline_code, case when flight_number % 7 <> 0 then haul end haul from lg"""
)
ORACLE["landing_replay"] = _sql(
    "select flight_id id, flight_number, cast(count(*) over () as bigint) nb_rejected from fb where flight_number % 10 = 0"
)
ORACLE["airport_scan"] = """select 'N'||lpad(cast(n_nationkey as varchar),2,'0') iata_code, cast(null as varchar) icao_code,
    array_to_string(list_transform(string_split(n_name, ' '), lambda w: upper(w[1])||lower(w[2:])), ' ') "name",
    n_nationkey * 3.5::double lat, cast(n_regionkey as double) lng, substr(n_name,1,2) country_code,
    cast(null as varchar) city, cast(null as varchar) timezone, '2026-02-01 00:00:00' ingested_at from nation"""
_SCALED = {
    "scheduled_flight_duration_min": "duration_min",
    "departure_weekday": "isodow(flight_schedule_date)",
    "departure_month": "month(flight_schedule_date)",
    "departure_hour": "dep_min // 60",
    "departure_monthday": "day(flight_schedule_date)",
    "dep_airport_nb_departing": "coalesce(dd,0)",
    "dep_airport_nb_arriving": "coalesce(da,0)",
    "arr_airport_nb_departing": "coalesce(ad,0)",
    "arr_airport_nb_arriving": "coalesce(aa,0)",
}
ORACLE["best_dummies"] = _sql(
    ", long as ("
    + " union all ".join(f"select '{name}' feature, is_delayed, cast({x} as double) x from fa" for name, x in _SCALED.items())
    + """ union all select 'airline_key_'||v, is_delayed, case when airline_code = v then 1 else 0 end from fa,
        (select distinct airline_code v from fa) a where v > (select min(airline_code) from fa)
      union all select 'aircraft_type_code_'||v, is_delayed, case when aircraft = v then 1 else 0 end from fa,
        (select distinct aircraft v from fa) a where v > (select min(aircraft) from fa)),
    pc as (select feature, is_delayed, cast(count(*) as double) n, avg(x) m, var_pop(x) v from long group by all)
    select feature, round(f, 4) f_value from (select feature, (sum(n * (m - g) * (m - g)) / (count(*) - 1))
      / nullif(sum(n * v) / (sum(n) - count(*)), 0) f from (
      select *, sum(n * m) over (partition by feature) / sum(n) over (partition by feature) g from pc) b group by feature) c
    where f is not null order by f desc limit 20"""
)
# The leaves that FIXTURES.md fills
_PLACE = ["city.code", "city.country.areaCode", "city.country.code", "city.country.euCountry", "city.country.euroCountry",
          "city.country.name", "city.name", "code", "location.latitude", "location.longitude", "name", "places.gateNumber"]
_SIDE = [*(f"airport.{name}" for name in _PLACE), "times.actual", "times.scheduled"]
_LEG = [
    *(f"aircraft.{name}" for name in ("ownerAirlineCode", "registration", "typeCode", "typeName")),
    *(f"{side}.{name}" for side in ("arrivalInformation", "departureInformation") for name in _SIDE),
    "departureDateTimeDifference",
    *(f"irregularity.cancellationReason{name}" for name in ("CodePublic", "PublicLong", "PublicShort")),
    *(f"irregularity.{name}" for name in ("cancelled", "delayCode[]", "delayDuration[]", "delayInformation[].delayCode")),
    *(f"irregularity.{name}" for name in ("delayInformation[].delayDuration", "delayReasonCodePublic[]", "delayReasonPublicLangTransl[]")),
    "publishedStatus",
    "scheduledFlightDuration",
]
_DOCUMENT = [
    "id", "flightNumber", "flightScheduleDate", "haul", "route[]", "flightStatusPublic", "airline.code", "airline.name",
    "codeShareRelations[].airline.code", "codeShareRelations[].airline.name", "codeShareRelations[].marketingFlightNumber",
    *(f"flightRelations.{kind}FlightData.id" for kind in ("previous", "equivalent", "onward")),
    *(f"flightLegs[].{name}" for name in _LEG),
]
ORACLE["column_inventory"] = f"select unnest({_DOCUMENT}) column_name from (select 1 from orders limit 1) o"

ORACLE["search_stored"] = ORACLE["flight_search"]
ORACLE["search_stored_departures"] = _sql(
    f"""select leg_id, flight_id, {us('act_dep')} actual_departure, arr arrival_airport_code from lg
    where cast(act_dep as timestamptz) >= timestamptz '2026-01-10 06:00:00+00' and cast(act_dep as timestamptz) < timestamptz '2026-01-10 18:00:00+00'
    and dep = 'N03'"""
)
ORACLE["lookup_stored"] = _sql(
    f"""select leg_id, flight_id, cast(flight_schedule_date as varchar) date_key, {us('sch_dep')} scheduled_departure, dep departure_airport_key
    from lg where flight_id = '20260102+MA+0001'"""
)
ORACLE["star_fridays"] = _sql(
    """select leg_id, airline_name, dep departure_airport_code, arr arrival_airport_code, cast(flight_schedule_date as varchar) date_key, is_delayed
    from fa where dayname(flight_schedule_date) = 'Friday'"""
)
ORACLE["stream_current"] = _sql(
    """select flight_id id, case when flight_number % 2 = 0 then 'UPDATED' else flight_status_public end flight_status_public,
    case when flight_number % 2 = 0 then '2026-02-02 00:00:00' else '2026-02-01 00:00:00' end fetched_at,
    coalesce(case when flight_number % 2 = 0 and n > 2 then 2 else n end, 0) nb_legs,
    cast(case when flight_number % 2 = 0 then 0 else coalesce(k, 0) end as bigint) nb_delays
    from fb left join (select ok, count(*) n, sum(case when late1 then 1 else 0 end + case when late2 then 1 else 0 end) k
      from lg group by ok) r on r.ok = fb.ok"""
)
ORACLE["stream_congestion"] = _sql(
    """select airport_code, cast(movement_date as varchar) movement_date, cast(sum(d) as bigint) nb_departing, cast(sum(a) as bigint) nb_arriving
    from (select dep airport_code, flight_schedule_date movement_date, 1 d, 0 a from lg where flight_number % 2 = 1 or leg_order < 2
      union all select arr, arr_date, 0, 1 from lg where flight_number % 2 = 1 or leg_order < 2) m group by 1, 2"""
)
ORACLE["smote_hashed"] = ORACLE["smote_balanced"]
ORACLE["neighbour_recall"] = _sql(
    VECTORS
    + """ select cast(count(*) * least(count(*) - 1, 5) as bigint) nb_wanted, true reached
    from (select distinct airline_code, aircraft, a1, a2, a3, a4, a5, a6, a7, a8, a9 from vc where late) z"""
)
ORACLE["describe_delay_exact"] = ORACLE["describe_delay"]
ORACLE["quantiles_by_week"] = _sql(
    """select cast((flight_schedule_date - date '2026-01-01') // 7 as int) "week", count(*) n, true "within" from lg group by 1"""
)
ORACLE["distinct_by_day"] = _sql(
    " union all ".join(
        f"""select {span} span, '{name}' column_name, cast(count(distinct {value}) + max(case when {value} is null then 1 else 0 end) as bigint) n_values
        from lg{by}"""
        for span, by in (("cast(flight_schedule_date as varchar)", " group by flight_schedule_date"), ("'all'", ""))
        for name, value in (
            ("airline_key", "airline_code"),
            ("aircraft_type_code", "aircraft"),
            ("departure_airport_key", "dep"),
            ("arrival_airport_key", "arr"),
        )
    )
)
ORACLE["distinct_flights"] = _sql("select count(distinct flight_id) n_flights, true \"within\" from lg")
ORACLE["join_guard_observed"] = ORACLE["join_guard"]
ORACLE["counts_observed"] = ORACLE["table_counts"]
#: Columns of the fact and what they are in SQL.
_FACT = {
    "leg_id": "leg_id", "flight_id": "flight_id", "flight_number": "flight_number", "airline_key": "airline_code",
    "departure_airport_key": "dep", "arrival_airport_key": "arr", "date_key": "flight_schedule_date",
    "scheduled_departure": "sch_dep", "actual_departure": "act_dep", "scheduled_arrival": "sch_arr", "actual_arrival": "act_arr",
    "cancelled": "1", "delay_code": "codes", "delay_duration_minutes": "mins", "departure_delay_minutes": "dep_delay",
    "arrival_delay_minutes": "arr_delay", "scheduled_flight_duration_min": "duration_min", "aircraft_type_code": "aircraft",
    "departure_weekday": "1", "departure_month": "1", "departure_hour": "1", "departure_monthday": "1",
    "dep_airport_nb_departing": "dd", "dep_airport_nb_arriving": "da", "arr_airport_nb_departing": "ad", "arr_airport_nb_arriving": "aa",
    "is_delayed": "is_delayed",
}
ORACLE["missing_pct_all"] = _sql(
    " union all ".join(
        f"select '{name}' column_name, round(100 * avg(case when {value} is null then 1.0 else 0 end), 6) percentage from fa"
        for name, value in _FACT.items()
    )
)
ORACLE["cardinality_all"] = _sql(
    " union all ".join(
        f"select '{name}' column_name, count(distinct {value}) + max(case when {value} is null then 1 else 0 end) n_values from lg"
        for name, value in {
            "flight_id": "flight_id", "id": "leg_id", "departure_airport_code": "dep", "arrival_airport_code": "arr",
            "published_status": "published_status", "scheduled_departure": "sch_dep", "actual_departure": "act_dep",
            "scheduled_arrival": "sch_arr", "actual_arrival": "act_arr", "scheduled_flight_duration": "duration",
            "aircraft_type_code": "aircraft", "airline_code": "airline_code", "airline_name": "airline_name",
            "haul": "haul", "flight_status_public": "flight_status_public",
        }.items()
    )
)
ORACLE["best_dummies_sparse"] = ORACLE["best_dummies"]
ORACLE["ledger_load"] = _sql(
    """select flight_id id, airline_name, cast(n as int) nb_legs from fb left join (select ok, count(*) n from lg group by ok) r on r.ok = fb.ok"""
)
ORACLE["ledger_pages"] = _sql(
    """, pages as (select cast(flight_schedule_date as varchar) "day", cast(ceil(count(*) / 50.0) as bigint) k from fb group by 1)
    select "day", status, run, count(*) n from (
      select "day", 'landed' status, case when "day" < '2026-01-17' and page % 3 <> 1 then 1 else 2 end run
      from (select "day", unnest(range(k)) page from pages) p
      union all select '2025-12-31', 'empty', 1
    ) z group by all"""
)
