"""Streams store what a batch would, once, and set aside what is no event."""

from __future__ import annotations

import json
import os
import time
from datetime import date, timedelta

import pytest

from clickmetrics import AnalyticsConfig
from clickmetrics.sinks import append_csv, append_messages, compact_events
from clickmetrics.sources import csv_events, events_table
from clickmetrics.sources.tables import stored_partitions
from clickmetrics.streaming import (
    compact_quarantine,
    file_messages,
    ingest,
    ingest_messages,
    load_staged_csv,
    quarantined,
)
from clickmetrics.streaming.ingest import QUARANTINE, _set_aside, load_batch
from fixtures import EDGE_EVENTS, events_of, value_set, values


@pytest.fixture
def config(spark, request):
    name = "".join(c if c.isalnum() else "_" for c in request.node.name).lower()
    spark.sql(f"CREATE DATABASE {name}")
    yield AnalyticsConfig(database=name, flush_interval="1 second")
    spark.sql(f"DROP DATABASE {name} CASCADE")


@pytest.fixture(scope="module")
def events(spark):
    return events_of(spark, EDGE_EVENTS)


def drain(spark, landing, tmp_path, config, **kwargs):
    query = ingest_messages(
        file_messages(spark, str(landing), **kwargs),
        "clicks",
        str(tmp_path / "checkpoint"),
        config,
        available_now=True,
    )
    query.awaitTermination()


def test_stream_stores_every_message_once_over_restarts(spark, events, config, tmp_path):
    landing = tmp_path / "landing"
    append_messages(events.filter("user_id = 'u1'"), str(landing))
    drain(spark, landing, tmp_path, config)
    assert events_table(spark, config).count() == 5
    drain(spark, landing, tmp_path, config)
    assert events_table(spark, config).count() == 5
    append_messages(events.filter("user_id <> 'u1'"), str(landing))
    drain(spark, landing, tmp_path, config)
    assert value_set(events_table(spark, config)) == set(EDGE_EVENTS)


def test_many_small_batches_give_the_same_table(spark, events, config, tmp_path):
    landing = tmp_path / "landing"
    append_messages(events.repartition(5), str(landing))
    drain(spark, landing, tmp_path, config, max_files_per_batch=1)
    assert value_set(events_table(spark, config)) == set(EDGE_EVENTS)


def test_bad_messages_are_set_aside(spark, events, config, tmp_path):
    landing = tmp_path / "landing"
    append_messages(events, str(landing))
    (landing / "more.txt").write_text("not an event\n{}\n")
    drain(spark, landing, tmp_path, config)
    assert value_set(events_table(spark, config)) == set(EDGE_EVENTS)
    assert value_set(quarantined(spark, config)) == {
        ("not an event", "malformed"),
        ("{}", "missing field"),
    }


def test_batch_that_failed_after_storing_is_not_stored_twice(
    spark, events, config, tmp_path, monkeypatch
):
    landing = tmp_path / "landing"
    append_messages(events, str(landing))
    (landing / "more.txt").write_text("not an event\n")
    set_aside = ingest._set_aside

    def fail_after_storing(bad, load_id, config):
        set_aside(bad, load_id, config)
        raise RuntimeError("lost before the batch was committed")

    monkeypatch.setattr(ingest, "_set_aside", fail_after_storing)
    with pytest.raises(Exception, match="lost before"):
        drain(spark, landing, tmp_path, config)
    assert events_table(spark, config).count() == len(EDGE_EVENTS)

    monkeypatch.setattr(ingest, "_set_aside", set_aside)
    drain(spark, landing, tmp_path, config)
    assert values(events_table(spark, config).groupBy().count()) == [(len(EDGE_EVENTS),)]
    assert quarantined(spark, config).count() == 1


def test_interval_trigger_runs_until_stopped(spark, events, config, tmp_path):
    landing = tmp_path / "landing"
    append_messages(events, str(landing))
    query = ingest_messages(
        file_messages(spark, str(landing)), "clicks", str(tmp_path / "checkpoint"), config
    )
    try:
        query.processAllAvailable()
        assert query.isActive
    finally:
        query.stop()
    assert value_set(events_table(spark, config)) == set(EDGE_EVENTS)


def test_staged_csv_is_loaded_once(spark, events, config, tmp_path):
    staging, checkpoint = str(tmp_path / "staging"), str(tmp_path / "checkpoint")
    append_csv(events.filter("user_id = 'u1'"), staging)
    load_staged_csv(spark, staging, checkpoint, "staged", config)
    load_staged_csv(spark, staging, checkpoint, "staged", config)
    assert events_table(spark, config).count() == 5
    append_csv(events.filter("user_id <> 'u1'"), staging)
    load_staged_csv(spark, staging, checkpoint, "staged", config)
    assert value_set(events_table(spark, config)) == value_set(csv_events(spark, staging))


def test_staged_file_that_does_not_fit_is_tried_again(spark, config, tmp_path):
    staging, checkpoint = tmp_path / "staging", str(tmp_path / "checkpoint")
    staging.mkdir()
    header = "user_id,event_type,amount,timestamp\n"
    (staging / "a.csv").write_text(header + "u1,login,much,2024-01-01 10:00:00\n")
    with pytest.raises(Exception):
        load_staged_csv(spark, str(staging), checkpoint, "staged", config)
    (staging / "a.csv").write_text(header + "u1,login,0.0,2024-01-01 10:00:00\n")
    load_staged_csv(spark, str(staging), checkpoint, "staged", config)
    assert events_table(spark, config).count() == 1


def test_done_files_can_be_archived(spark, events, config, tmp_path):
    staging, archive = tmp_path / "staging", tmp_path / "archive"
    arguments = dict(
        checkpoint=str(tmp_path / "checkpoint"),
        load_name="staged",
        config=config,
        after_load="archive",
        archive=str(archive),
    )
    append_csv(events.filter("user_id = 'u1'").coalesce(1), str(staging))
    load_staged_csv(spark, str(staging), **arguments)
    append_csv(events.filter("user_id <> 'u1'").coalesce(1), str(staging))
    load_staged_csv(spark, str(staging), **arguments)
    assert value_set(events_table(spark, config)) == set(EDGE_EVENTS)
    assert list(archive.rglob("*.csv"))
    with pytest.raises(ValueError):
        load_staged_csv(spark, str(staging), str(tmp_path / "c"), "s", after_load="archive")


def dated(path, days_back: int) -> None:
    moment = time.time() - days_back * 86_400
    os.utime(path, (moment, moment))


def test_files_of_any_date_are_loaded(spark, config, tmp_path):
    staging, landing = tmp_path / "staging", tmp_path / "landing"
    for folder in (staging, landing):
        folder.mkdir()
    header = "user_id,event_type,amount,timestamp\n"
    for number, days_back in enumerate((0, 9, 400)):
        event = {"user_id": f"m{number}", "event_type": "login", "timestamp": "2024-01-01 10:00:00"}
        (staging / f"{number}.csv").write_text(f"{header}c{number},login,0.0,2024-01-01 10:00:00\n")
        (landing / f"{number}.txt").write_text(json.dumps(event) + "\n")
        dated(staging / f"{number}.csv", days_back)
        dated(landing / f"{number}.txt", days_back)
        load_staged_csv(spark, str(staging), str(tmp_path / "c"), "staged", config)
        drain(spark, landing, tmp_path, config)
    users = {row[0] for row in values(events_table(spark, config))}
    assert users == {"c0", "c1", "c2", "m0", "m1", "m2"}


def test_folders_and_checkpoints_do_not_take_each_others_place(spark, events, config, tmp_path):
    first, second = str(tmp_path / "a"), str(tmp_path / "b")
    append_csv(events.filter("user_id = 'u1'"), first)
    append_csv(events.filter("user_id <> 'u1'"), second)
    load_staged_csv(spark, first, str(tmp_path / "ca"), "staged", config)
    load_staged_csv(spark, second, str(tmp_path / "cb"), "staged", config)
    assert value_set(events_table(spark, config)) == set(EDGE_EVENTS)
    # A new checkpoint reads its folder again, as loads of its own.
    load_staged_csv(spark, second, str(tmp_path / "cc"), "staged", config)
    assert events_table(spark, config).count() == 13 + 8


def test_a_replayed_batch_is_stored_once_after_compaction(spark, events, config, tmp_path):
    landing = tmp_path / "landing"
    append_messages(events.repartition(4), str(landing))
    drain(spark, landing, tmp_path, config, max_files_per_batch=1)
    compact_events(spark, date(2024, 1, 4), config)
    stored = {load for _, load in stored_partitions(spark, config.table("events"))}
    assert stored and all(load.startswith("folded.") for load in stored)
    (source,) = {row.source for row in spark.table(config.table("closed_loads")).collect()}
    for batch in range(4):
        load_batch(events, f"{source}-{batch:012d}", config)
    assert value_set(events_table(spark, config)) == set(EDGE_EVENTS)
    # A stream has one row, whatever the number of its batches, and its next batch is not closed.
    load_batch(events, f"{source}-{4:012d}", config)
    assert events_table(spark, config).count() == 2 * len(EDGE_EVENTS)


def test_bad_messages_are_folded_by_day_and_replayed_once(spark, events, config, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    for batch in range(4):
        (landing / f"{batch}.json").write_text(f"not json {batch}\nnot json\n")
        drain(spark, landing, tmp_path, config)
    table = config.table(QUARANTINE.table)
    before = sorted(values(quarantined(spark, config)))
    batches = [load for _, load in stored_partitions(spark, table)]
    assert (len(batches), len(before)) == (4, 8)
    tomorrow = date.today() + timedelta(days=2)
    assert compact_quarantine(spark, date(2024, 1, 1), config) == 0
    assert compact_quarantine(spark, tomorrow, config) == 1
    assert len(stored_partitions(spark, table)) == 1
    assert sorted(values(quarantined(spark, config))) == before
    again = spark.createDataFrame([("not json", "malformed")], "value string, reason string")
    for load in batches:
        _set_aside(again, load, config)
    assert sorted(values(quarantined(spark, config))) == before
    # The next batch is set aside, on a retry under the day of its first try.
    after = f"{max(batches)[:-12]}{99:012d}"
    for _ in range(2):
        _set_aside(again, after, config)
    assert sorted(values(quarantined(spark, config))) == sorted([*before, ("not json", "malformed")])
    assert compact_quarantine(spark, tomorrow, config) == 1
    assert len(values(quarantined(spark, config))) == 9
