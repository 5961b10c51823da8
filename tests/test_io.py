"""Files, messages and tables: what is written reads back, what does not fit is caught."""

from __future__ import annotations

import os
import subprocess
import sys
import threading
from dataclasses import replace
from datetime import date, datetime

import pytest
from hypothesis import HealthCheck, Phase, example, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from clickmetrics import AnalyticsConfig
from clickmetrics import operators as op
from clickmetrics.schema import EVENT_SCHEMA, EventSchemaError, require_event_columns
from clickmetrics.sinks import (
    ClosedLoadError,
    append_csv,
    append_messages,
    compact_events,
    create_events_table,
    load_events,
    save_metric,
)
from clickmetrics.sinks import events as event_sink
from clickmetrics.sources import (
    EventMapping,
    csv_events,
    encode_messages,
    events_between,
    events_table,
    json_events,
    map_events,
    metric_table,
    parquet_events,
    parse_messages,
    split_parsed,
    use_events,
)
from clickmetrics.sources.tables import folded_days, in_partitions, stored_partitions
from conftest import ROOT
from fixtures import EDGE_EVENTS, at, events_of, value_set, values

HEADER = "user_id,event_type,amount,timestamp\n"


@pytest.fixture(scope="module")
def events(spark):
    return events_of(spark, EDGE_EVENTS)


@pytest.fixture
def config(spark, request):
    """A database of its own for each test."""
    name = "".join(c if c.isalnum() else "_" for c in request.node.name).lower()
    spark.sql(f"CREATE DATABASE {name}")
    yield AnalyticsConfig(database=name)
    spark.sql(f"DROP DATABASE {name} CASCADE")


def write(path, text):
    path.mkdir(exist_ok=True)
    (path / f"part-{len(list(path.iterdir()))}.csv").write_text(text)


def test_csv_round_trip(spark, events, tmp_path):
    append_csv(events, str(tmp_path / "staged"))
    append_csv(events, str(tmp_path / "staged"))
    read = csv_events(spark, str(tmp_path / "staged"))
    assert read.schema == EVENT_SCHEMA
    assert sorted(map(str, values(read))) == sorted(map(str, EDGE_EVENTS * 2))


TEXT = st.text(
    st.characters(blacklist_categories=["Cs"], blacklist_characters="\r\n\x00"), max_size=12
)


@settings(
    max_examples=12,
    deadline=None,
    phases=[Phase.explicit, Phase.generate],
    suppress_health_check=[HealthCheck.function_scoped_fixture],
)
@example([('', '"'), (' a"', '\\'), ('a,b', '\t')])
@given(st.lists(st.tuples(TEXT, TEXT), min_size=1, max_size=8))
def test_any_text_survives_csv_and_messages(spark, tmp_path_factory, pairs):
    moment = datetime(2024, 1, 2, 3, 4, 5, 600_007)
    rows = [(user, kind, 0.1, moment) for user, kind in pairs]
    folder = tmp_path_factory.mktemp("text")
    frame = events_of(spark, rows).coalesce(1)
    append_csv(frame, str(folder / "csv"))
    append_messages(frame, str(folder / "json"))
    for read in (csv_events(spark, str(folder / "csv")), json_events(spark, str(folder / "json"))):
        assert sorted(values(read)) == sorted(rows)


def test_quotes_as_other_writers_make_them(spark, tmp_path):
    write(tmp_path / "in", HEADER + '"a ""b"" c"," x ",0.0,2024-01-01 10:00:00\n')
    assert value_set(csv_events(spark, str(tmp_path / "in"))) == {
        ('a "b" c', " x ", 0.0, at("01-01 10:00"))
    }


def test_line_breaks_come_back_from_csv(spark, tmp_path):
    texts = ["a\nb", "c\rd", "e\r\nf", "\n", "\r", 'q"\n"x,', "", None, " z\n ", "tail\r", "\r\nhead", "plain"]
    rows = [(text, text, float(i), datetime(2024, 1, 1, 0, i)) for i, text in enumerate(texts)]
    path = str(tmp_path / "csv")
    append_csv(events_of(spark, rows).repartition(2), path, rows_per_file=4)
    assert len(list((tmp_path / "csv").glob("*.csv"))) >= 3
    assert value_set(csv_events(spark, path, multi_line=True)) == set(rows)
    with pytest.raises(Exception):
        csv_events(spark, path).collect()


def test_a_time_format_can_be_chosen(spark, tmp_path):
    rows = [("u", "login", 0.0, datetime(2024, 1, 1, 10, 0, 0, 123_000))]
    assert '"timestamp":"2024-01-01 10:00:00.123"' in encode_messages(events_of(spark, rows)).first()[0]
    append_csv(events_of(spark, rows), str(tmp_path / "s"), "yyyy-MM-dd HH:mm:ss")
    assert value_set(csv_events(spark, str(tmp_path / "s"))) == {(*rows[0][:3], at("01-01 10:00"))}


def test_csv_amount_absent_reads_zero_and_null_stays_null(spark, events, tmp_path):
    append_csv(events.drop("amount"), str(tmp_path / "absent"))
    assert {row[2] for row in values(csv_events(spark, str(tmp_path / "absent")))} == {0.0}
    append_csv(events, str(tmp_path / "null"))
    amounts = {row[0]: row[2] for row in values(csv_events(spark, str(tmp_path / "null")))}
    assert amounts["u4"] is None


def test_csv_keeps_digit_ids_as_text_and_reads_several_files(spark, tmp_path):
    write(tmp_path / "in", HEADER)
    write(tmp_path / "in", HEADER + "00345678,login,0.0,2024-01-01 10:00:00\n")
    write(tmp_path / "in", HEADER + "u2,purchase,,2024-01-01 11:00:00\n")
    assert value_set(csv_events(spark, str(tmp_path / "in"))) == {
        ("00345678", "login", 0.0, at("01-01 10:00")),
        ("u2", "purchase", None, at("01-01 11:00")),
    }


def test_csv_record_that_does_not_fit(spark, tmp_path):
    bad = "u1,login,much,2024-01-01 10:00:00"
    write(tmp_path / "in", HEADER + bad + "\nu2,login,0.0,2024-01-01 10:00:00\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        csv_events(spark, str(tmp_path / "in")).collect()
    tolerant = values(csv_events(spark, str(tmp_path / "in"), "tolerant"))
    assert {row[4] for row in tolerant} == {bad, None}


def test_csv_header_must_match(spark, tmp_path):
    write(tmp_path / "in", "event_type,user_id,amount,timestamp\nlogin,u1,0.0,2024-01-01 10:00:00\n")
    with pytest.raises(Exception, match="header"):
        csv_events(spark, str(tmp_path / "in")).collect()


def test_json_file_round_trip(spark, events, tmp_path):
    append_messages(events, str(tmp_path / "landing"))
    assert value_set(json_events(spark, str(tmp_path / "landing"))) == set(EDGE_EVENTS)


MESSAGES = {
    '{"user_id":"ab12cd34","event_type":"purchase","amount":19.99,'
    '"timestamp":"2024-01-01 10:00:00"}': None,
    '{"user_id":"u1","event_type":"login","timestamp":"2024-01-01 10:00:00"}': None,
    '{"user_id":7,"event_type":"login","amount":0,"timestamp":"2024-01-01 10:00:00"}': None,
    '{"user_id":"u1","event_type":"login","amount":0,"timestamp":"2024-01-01 10:00:00",'
    '"page":"/cart"}': None,
    "not json": "malformed",
    "": "malformed",
    "[1, 2]": "malformed",
    '{"user_id":"u1","event_type":"login","amount":"x","timestamp":"2024-01-01 10:00:00"}':
        "malformed",
    '{"user_id":"u1","event_type":"login","amount":0,"timestamp":"yesterday"}': "malformed",
    "{}": "missing field",
    '{"user_id":null,"event_type":"login","amount":0,"timestamp":"2024-01-01 10:00:00"}':
        "missing field",
}


@pytest.mark.parametrize("binary", [False, True])
def test_messages_are_parsed_or_set_aside(spark, binary):
    frame = spark.createDataFrame([(text,) for text in MESSAGES], "value string")
    if binary:
        frame = frame.selectExpr("encode(value, 'UTF-8') AS value")
    parsed = parse_messages(frame)
    reasons = {row.value: row.reason for row in parsed.collect()}
    assert reasons == MESSAGES
    good, bad = split_parsed(parsed)
    assert good.schema == EVENT_SCHEMA
    assert sorted(map(str, values(good))) == sorted(
        map(
            str,
            [
                ("ab12cd34", "purchase", 19.99, at("01-01 10:00")),
                ("u1", "login", None, at("01-01 10:00")),
                ("7", "login", 0.0, at("01-01 10:00")),
                ("u1", "login", 0.0, at("01-01 10:00")),
            ],
        )
    )
    assert value_set(bad) == {(text, why) for text, why in MESSAGES.items() if why}


@pytest.mark.parametrize("binary", [False, True])
def test_encoded_messages_parse_to_the_same_events(events, binary):
    good, bad = split_parsed(parse_messages(encode_messages(events, binary)))
    assert value_set(good) == set(EDGE_EVENTS)
    assert bad.isEmpty()


def test_message_text(events):
    texts = {row.value for row in encode_messages(events).collect()}
    assert (
        '{"user_id":"u4","event_type":"purchase","amount":null,"timestamp":"2024-01-02 09:30:00"}'
        in texts
    )


def test_parquet_leaves_partition_columns_out(spark, events, config, tmp_path):
    events.selectExpr("*", "to_date(timestamp) AS event_date").write.partitionBy(
        "event_date"
    ).parquet(str(tmp_path / "p"))
    assert value_set(parquet_events(spark, str(tmp_path / "p"))) == set(EDGE_EVENTS)


def test_loads_add_up_and_a_repeated_load_replaces_itself(spark, events, config):
    first, second = events.filter("user_id = 'u1'"), events.filter("user_id <> 'u1'")
    load_events(first, "day-1", config)
    load_events(second, "day-2", config)
    assert value_set(events_table(spark, config)) == set(EDGE_EVENTS)
    load_events(second, "day-2", config)
    assert value_set(events_table(spark, config)) == set(EDGE_EVENTS)
    # A corrected load with fewer days leaves nothing of its first attempt.
    load_events(second.filter("user_id = 'u3'"), "day-2", config)
    assert {row[0] for row in values(events_table(spark, config))} == {"u1", "u3"}


def test_events_without_a_time_are_stored_and_replaced_too(spark, config):
    untimed = events_of(spark, [("u1", "login", 0.0, None), EDGE_EVENTS[0]])
    load_events(untimed, "a", config)
    load_events(untimed, "a", config)
    assert value_set(events_table(spark, config)) == {("u1", "login", 0.0, None), EDGE_EVENTS[0]}
    load_events(untimed.filter("timestamp IS NOT NULL"), "a", config)
    assert value_set(events_table(spark, config)) == {EDGE_EVENTS[0]}


def test_load_does_not_depend_on_the_session_overwrite_mode(spark, events, config):
    mode = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(mode)
    spark.conf.set(mode, "static")
    try:
        load_events(events.filter("user_id = 'u1'"), "a", config)
        load_events(events.filter("user_id <> 'u1'"), "b", config)
    finally:
        spark.conf.set(mode, before)
    assert value_set(events_table(spark, config)) == set(EDGE_EVENTS)


def test_load_id_is_checked(events, config):
    with pytest.raises(ValueError):
        load_events(events, "x' OR '1'='1", config)


def test_time_range_reads_only_its_days(spark, events, config):
    load_events(events, "all", config)
    day = events_table(spark, config, datetime(2024, 1, 2), datetime(2024, 1, 3))
    assert value_set(day) == {row for row in EDGE_EVENTS if row[3].day == 2}
    assert len(day.inputFiles()) == 1
    part = events_table(spark, config, until=datetime(2024, 1, 2, 0, 45))
    assert value_set(part) == {row for row in EDGE_EVENTS if row[3] < datetime(2024, 1, 2, 0, 45)}


ON_JAN_2 = """
import sys
from datetime import datetime, timedelta, timezone
from clickmetrics import AnalyticsConfig, build_session
from clickmetrics.sinks import load_events
from clickmetrics.sources import events_table
spark = build_session("zone", "local[1]", spark__ui__enabled="false",
    spark__sql__warehouse__dir=sys.argv[1] + "/w", spark__checkpoint__dir=sys.argv[1] + "/c")
rows = spark.sql("SELECT 'u' AS user_id, 'login' AS event_type, 0.0D AS amount, "
                 "TIMESTAMP '2024-01-02 03:00:00' AS timestamp UNION ALL "
                 "SELECT 'v', 'login', 0.0D, TIMESTAMP '2024-01-01 23:30:00'")
load_events(rows, "a", AnalyticsConfig())
naive = datetime(2024, 1, 2)
aware = datetime(2024, 1, 2, 1, tzinfo=timezone(timedelta(hours=1)))
print("FOUND", [events_table(spark, since=at).count() for at in (naive, aware)],
      events_table(spark, until=naive).count())
"""


def test_time_ranges_do_not_depend_on_the_zone_of_the_machine(tmp_path):
    environment = os.environ | {"TZ": "America/New_York", "PYTHONPATH": str(ROOT)}
    done = subprocess.run(
        [sys.executable, "-c", ON_JAN_2, str(tmp_path)],
        env=environment, cwd=tmp_path, capture_output=True, text=True, timeout=300,
    )
    assert "FOUND [1, 1] 1" in done.stdout, done.stderr[-2000:]


def test_days_of_another_zone_are_refused(spark, events, config):
    load_events(events, "all", config)
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        with pytest.raises(ValueError, match="UTC"):
            events_table(spark, config, since=datetime(2024, 1, 2))
        with pytest.raises(ValueError, match="UTC"):
            load_events(events, "more", config)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_a_failing_reload_keeps_every_row(spark, events, config):
    load_events(events, "a", config)
    failing = events.withColumn(
        "amount", F.when(F.col("user_id") == "u5", F.raise_error(F.lit("input lost")).cast("double"))
    )
    with pytest.raises(Exception, match="input lost"):
        load_events(failing, "a", config)
    assert value_set(events_table(spark, config)) == set(EDGE_EVENTS)


def test_a_load_can_be_corrected_from_the_table_itself(spark, events, config):
    load_events(events, "a", config)
    load_events(events_table(spark, config), "a", config)
    assert value_set(events_table(spark, config)) == set(EDGE_EVENTS)
    load_events(events_table(spark, config).filter("user_id = 'u1'"), "a", config)
    assert {row[0] for row in values(events_table(spark, config))} == {"u1"}


def test_compaction_leaves_one_partition_per_closed_day(spark, events, config):
    for user in ("u1", "u2", "u3", "u4", "u5"):
        load_events(events.filter(F.col("user_id") == user), f"load-{user}", config)
    assert compact_events(spark, date(2024, 1, 3), config) == 2
    assert value_set(events_table(spark, config)) == set(EDGE_EVENTS)
    days = [day for day, _ in stored_partitions(spark, config.table("events"))]
    assert days.count("2024-01-01") == days.count("2024-01-02") == 1
    assert days.count("2024-01-03") == 2
    # What is folded cannot be loaded again, what is not can.
    with pytest.raises(ClosedLoadError):
        load_events(events.filter("user_id = 'u2'"), "load-u2", config)
    load_events(events.filter("user_id = 'u5'"), "load-u5", config)
    assert value_set(events_table(spark, config)) == set(EDGE_EVENTS)
    assert compact_events(spark, date(2024, 1, 3), config) == 0


@pytest.mark.parametrize("broken", ["createDataFrame", "drop_partitions"])
def test_a_compaction_that_breaks_off_doubles_and_loses_nothing(
    spark, events, config, monkeypatch, broken
):
    for user in ("u1", "u2", "u3", "u4", "u5"):
        load_events(events.filter(F.col("user_id") == user), f"load-{user}", config)

    def fail(*arguments, **more):
        if broken == "createDataFrame" or arguments[2]:
            raise RuntimeError("lost")

    place = type(spark) if broken == "createDataFrame" else event_sink
    with monkeypatch.context() as patch:
        patch.setattr(place, broken, fail)
        with pytest.raises(RuntimeError, match="lost"):
            compact_events(spark, date(2024, 1, 4), config)
    assert value_set(events_table(spark, config)) == set(EDGE_EVENTS)
    compact_events(spark, date(2024, 1, 4), config)
    assert value_set(events_table(spark, config)) == set(EDGE_EVENTS)
    assert len(stored_partitions(spark, config.table("events"))) == 3


def test_a_load_that_lands_during_a_compaction_is_stored_once(spark, events, config, monkeypatch):
    for user in ("u1", "u2", "u3"):
        load_events(events.filter(F.col("user_id") == user), f"load-{user}", config)
    listed, late = event_sink.stored_partitions, []

    def list_then_load(session, table, load=None):
        found = listed(session, table, load)
        if load is None and not late:
            late.append(True)
            load_events(events.filter("user_id IN ('u4', 'u5')"), "late", config)
        return found

    monkeypatch.setattr(event_sink, "stored_partitions", list_then_load)
    assert compact_events(spark, date(2024, 1, 4), config) > 0
    assert late and sorted(values(events_table(spark, config)), key=str) == sorted(EDGE_EVENTS, key=str)
    assert ("2024-01-03", "late") in listed(spark, config.table("events"))


def test_events_without_a_day_are_folded_too(spark, events, config):
    undated = events.withColumn("timestamp", F.lit(None).cast("timestamp"))
    for load in ("a", "b", "c"):
        load_events(undated, load, config)
    assert compact_events(spark, date(2024, 1, 1), config) == 1
    ((day, load),) = stored_partitions(spark, config.table("events"))
    assert day is None and load.startswith("folded.")
    assert events_table(spark, config).count() == 3 * len(EDGE_EVENTS)
    load_events(undated, "d", config)
    assert compact_events(spark, date(2024, 1, 1), config) == 1
    assert events_table(spark, config).count() == 4 * len(EDGE_EVENTS)


def many_loads(spark, config, days, loads):
    """A row for each of many days and loads, written at once."""
    create_events_table(spark, config)
    spark.range(days * loads).selectExpr(
        "cast(id as string)", "'login'", "0.0", "timestamp'2024-01-01' + make_interval(0, 0, 0, id % {0})".format(days),
        "date_add(date'2024-01-01', cast(id % {0} as int))".format(days), "concat('load-', id div {0})".format(days),
    ).repartition(8).write.insertInto(config.table("events"), overwrite=True)


def test_the_ledger_has_a_row_a_day_after_many_loads(spark, events, config):
    many_loads(spark, config, 2, 500)
    assert compact_events(spark, date(2024, 2, 1), config) == 2
    assert [(row.day, row.pending) for row in sorted(folded_days(spark, config))] == [
        ("2024-01-01", []), ("2024-01-02", [])
    ]
    assert events_table(spark, config).count() == 1000
    with pytest.raises(ClosedLoadError):
        load_events(events, "load-77", config)
    load_events(events, "load-500", config)
    assert compact_events(spark, date(2024, 2, 1), config) == 2
    assert len(folded_days(spark, config)) == 2
    assert events_table(spark, config).count() == 1000 + len(EDGE_EVENTS)


def test_partitions_are_chosen_in_the_catalog(spark, config):
    many_loads(spark, config, 100, 100)
    table = spark.table(config.table("events"))
    some = [(f"2024-01-{d:02d}", f"load-{n}") for d in range(1, 29) for n in range(d % 3, 100, 7 + d % 2)]
    chosen = table.filter(in_partitions(some))
    plan = chosen._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters") : plan.index("PushedFilters")]
    assert "event_date" in filters and "load_id" in filters and "concat" not in plan
    assert len(chosen.inputFiles()) == len(some) == chosen.count()
    # Days with the same loads share a comparison.
    cross = [(f"2024-01-{d:02d}", f"load-{n}") for d in range(1, 29) for n in range(100)]
    assert str(in_partitions(cross)).count("and(") == 1
    assert table.filter(in_partitions(cross)).count() == 2800
    assert table.filter(in_partitions([])).count() == 0


def test_mapped_types_filter_in_the_scan(spark, sf_dir):
    mapping = EventMapping(timestamp="ts", amount="value", type_names={"signup": "login"})
    source = spark.read.parquet(f"{sf_dir}/events.parquet")
    renamed = map_events(source, mapping)
    only = map_events(source, mapping, ("login",))
    assert only.count() == renamed.filter("event_type = 'login'").count() > 0
    assert {row[0] for row in values(only.select("event_type").distinct())} == {"login"}
    bounded = events_between(source, until=datetime(2024, 1, 2), timestamp="ts")
    assert 0 < bounded.count() < source.count()


def test_sql_text_over_events(spark, events):
    use_events(events, "log_of_events")
    sql = """
        SELECT event_type AS stage, count(DISTINCT user_id) AS user_count
        FROM log_of_events GROUP BY event_type HAVING user_count > 0"""
    assert value_set(spark.sql(sql)) == value_set(op.funnel_users(events))


def test_metric_is_replaced_with_its_schema(spark, events, config):
    assert save_metric(op.funnel_users(events), "m", config)
    assert save_metric(op.funnel_volume(events), "m", config)
    assert value_set(spark.table(config.table("m"))) == value_set(op.funnel_volume(events))


def test_empty_metric_keeps_or_replaces_the_table(spark, events, config):
    save_metric(op.cohort_daily(events), "m", config)
    empty = op.cohort_daily(events.limit(0))
    assert not save_metric(empty, "m", config, on_empty="keep")
    assert spark.table(config.table("m")).count() == 3
    assert save_metric(empty, "m", config, on_empty="replace")
    assert spark.table(config.table("m")).count() == 0


def test_metric_can_be_computed_from_the_table_it_replaces(spark, events, config):
    save_metric(op.cohort_daily(events), "m", config)
    save_metric(spark.table(config.table("m")).limit(1), "m", config)
    assert spark.table(config.table("m")).count() == 1


def test_a_reader_sees_the_old_or_the_new_metric(spark, config):
    name = config.table("m")
    save_metric(spark.range(5), "m", config)
    seen, stop = [], threading.Event()

    def read():
        while not stop.is_set():
            seen.append(spark.table(name).count())

    reader = threading.Thread(target=read)
    reader.start()
    try:
        for size in (6, 7, 8):
            save_metric(spark.range(size), "m", config)
    finally:
        stop.set()
        reader.join()
    assert seen and set(seen) <= {5, 6, 7, 8}
    versions = [t.name for t in spark.catalog.listTables(config.database) if "__v" in t.name]
    assert len(versions) == 2


def test_a_plain_table_becomes_a_metric(spark, config):
    spark.range(3).write.saveAsTable(config.table("m"))
    assert save_metric(spark.range(4), "m", config)
    assert spark.table(config.table("m")).count() == 4


def test_metric_never_built_reads_as_default(spark, config):
    schema = "total_users bigint, retention_rate double"
    name = config.table("never_built")
    assert values(metric_table(spark, name, {"total_users": 0, "retention_rate": 0.0}, schema)) == [
        (0, 0.0)
    ]
    assert values(metric_table(spark, name, schema=schema)) == []
    with pytest.raises(ValueError):
        metric_table(spark, name)


def test_event_schema_is_asserted(spark, events):
    assert require_event_columns(events.withColumn("more", events.amount)).columns == events.columns
    with pytest.raises(EventSchemaError, match="amount"):
        require_event_columns(events.selectExpr("user_id", "event_type", "'1' amount", "timestamp"))
    with pytest.raises(EventSchemaError, match="no column"):
        require_event_columns(events.drop("timestamp"))


def test_config_is_a_value():
    assert replace(AnalyticsConfig(), segment_count=4).segment_count == 4
