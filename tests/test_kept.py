import json

from pyspark.sql import functions as F

from vigilake.operators import kept, views
from vigilake.schema import LIFTED, LIFTED_ARRAYS
from vigilake.session import run_dir
from vigilake.sources.manifest import Manifest
from vigilake.sources.messages import read_event_stream
from vigilake.sources.tables import read_events
from vigilake.streaming.ingest import ingest


def table_rows(events):
    return events.select("utctimestamp", "eventid", "severity", "summary", "category", "source", "tags", "plugins", "details", *LIFTED.values(), *LIFTED_ARRAYS.values(), "event_date")


def same(a, b):
    cols = sorted(a.columns)
    return sorted(map(repr, a.select(*cols).collect())) == sorted(map(repr, b.select(*cols).collect()))


def test_only_new_folders_are_read(spark, events):
    path, rows = run_dir(spark, "k"), table_rows(events)
    log, view = Manifest(spark, f"{path}/e"), kept.KeptView(spark, f"{path}/e", f"{path}/v", kept.FIRST_SEENS)
    assert view.refresh() == {"read": 0, "added": 0, "dropped": 0} and view.read().count() == 0
    days = rows.filter("event_date IN ('2024-01-03', '2024-01-04')")
    for i in range(4):
        log.write_batch(days.filter(F.pmod(F.xxhash64("eventid"), F.lit(4)) == i), "s", i)
    assert view.refresh()["read"] == 8 and view.refresh() == {"read": 0, "added": 0, "dropped": 0}
    log.compact(fan=4)
    assert view.refresh() == {"read": 0, "added": 2, "dropped": 8}  # joined folders are added up, not read
    assert same(view.read(), views.first_seens(days))
    log.write_batch(days.filter("category = 'click'"), "s", 2, replace=True)
    view.refresh()
    assert same(view.read(), views.first_seens(read_events(spark, f"{path}/e")))
    log.expire("2024-01-04")
    assert view.refresh()["read"] == 0
    assert same(view.read(), views.first_seens(read_events(spark, f"{path}/e"))) and same(view.read(until="2024-01-04"), views.first_seens(days.limit(0)))
    plan = view.read()._jdf.queryExecution().executedPlan().toString()
    assert f"{path}/v" in plan and f"{path}/e/" not in plan


def test_a_folder_without_rows_and_a_dead_refresh(spark, events, monkeypatch):
    path, rows = run_dir(spark, "k"), table_rows(events).filter("event_date = '2024-01-03'")
    log, view = Manifest(spark, f"{path}/e"), kept.KeptView(spark, f"{path}/e", f"{path}/v", kept.DAILY_ACTIVITY)
    log.write_batch(rows.filter("identity IS NULL"), "s", 0)
    assert view.refresh()["read"] == 1 and view.read().count() == 0
    log.write_batch(rows.filter("identity IS NOT NULL"), "s", 1)
    with monkeypatch.context() as m:
        m.setattr(view.own, "commit", lambda plan: None)
        view.refresh()
    assert view.read().count() == 0
    view.refresh()
    assert same(view.read(), views.entity_daily_activity(rows))


def test_sketches_over_any_window(spark, events):
    path = run_dir(spark, "k")
    log, view = Manifest(spark, f"{path}/e"), kept.KeptView(spark, f"{path}/e", f"{path}/v", kept.IDENTITY_SKETCHES)
    wide = table_rows(events).withColumn("source_ip", F.concat(F.lit("10."), F.col("eventid"))).withColumn("identity", F.lit("one"))
    log.write_batch(wide.filter("event_date < '2024-01-15'"), "s", 0)
    log.write_batch(wide.filter("event_date >= '2024-01-15'"), "s", 1)
    view.refresh()
    got = kept.sketched(view.read("2024-01-05", "2024-01-25")).first()
    exact = wide.filter("event_date >= '2024-01-05' AND event_date < '2024-01-25'").count()
    assert got.event_count == exact and abs(got.approx_ips - exact) < 0.05 * exact
    assert view.read().select(F.max(F.length("ips"))).first()[0] < 3000  # the state of a day is bounded


def test_ingest_keeps_views_up_to_date(spark, tmp_path):
    lake, drop = run_dir(spark, "lake"), tmp_path / "in"
    drop.mkdir()
    view = kept.KeptView(spark, f"{lake}/t", f"{lake}/v", kept.FIRST_SEENS)
    for i in range(3):
        (drop / f"{i}.txt").write_text(json.dumps({"n": i, "user": f"u{i % 2}", "source": "x", "time": "2024-01-01T00:00:00Z"}))
        ingest(read_event_stream(spark, path=str(drop)), f"{lake}/t", f"{lake}/cp", trigger={"availableNow": True}, compact=2, kept=[view]).awaitTermination()
    assert same(view.read(), views.first_seens(read_events(spark, f"{lake}/t"))) and view.read().count() > 0
