from pyspark.sql import functions as F

from vigilake.operators.query import log_search
from vigilake.operators.textindex import TextIndex
from vigilake.session import run_dir
from vigilake.sources.manifest import Manifest
from vigilake.sources.tables import read_events

SINCE, UNTIL = "2024-01-01 00:00:00", "2024-02-01 00:00:00"


def table(spark, events):
    path = run_dir(spark, "x")
    base = events.select("utctimestamp", "eventid", "severity", "summary", "category", "source", "tags", "plugins", "details", "event_date")
    log, index = Manifest(spark, f"{path}/e"), TextIndex(spark, f"{path}/e", f"{path}/i")
    day = F.dayofmonth("event_date")
    marked = base.withColumn("summary", F.when(day == 5, F.concat("summary", F.lit(" Überfall am ÉTANG"))).when(day == 9, None).otherwise(F.col("summary")))
    log.write_batch(marked.filter(day <= 15), "s", 0)
    log.write_batch(marked.filter(day > 15), "s", 1)
    return log, index, marked


def ids(df):
    return sorted(r.eventid for r in df.select("eventid").collect())


def test_files_without_the_text_are_not_read(spark, events):
    log, index, _ = table(spark, events)
    whole = read_events(spark, log.path)
    assert index.files("étang", SINCE, UNTIL)[1] == 0  # nothing is known yet: all folders are searched
    assert ids(index.search("étang", SINCE, UNTIL)) == ids(log_search(whole, SINCE, UNTIL, text="étang"))
    index.refresh()
    for text in ("étang", "ÜBERFALL AM", "user1@", "actor 7 ", '"k":9', "a", "", "no such text anywhere"):
        names, left = index.files(text, SINCE, UNTIL)
        got = index.search(text, SINCE, UNTIL)
        assert ids(got) == ids(log_search(whole, SINCE, UNTIL, text=text)), text
        read = {f.split("/event_date=")[1] for f in got.inputFiles()} if names else set()
        assert len(read) == len(names)
    names, left = index.files("étang", SINCE, UNTIL)
    assert len(names) == 1 and "event_date=2024-01-05" in names[0] and left >= 28
    assert index.files("no such text anywhere", SINCE, UNTIL)[0] == []
    assert index.files("étang", "2024-01-06 00:00:00", UNTIL)[0] == []


def test_the_index_follows_the_table(spark, events):
    log, index, marked = table(spark, events)
    index.refresh()
    log.write_batch(marked.filter("eventid LIKE '%3'").withColumn("summary", F.lit("quite another thing")), "s", 1, replace=True)
    log.compact(fan=2)
    for _ in range(2):
        for text in ("étang", "another thing", "actor 3"):
            assert ids(index.search(text, SINCE, UNTIL, "cloudtrail")) == ids(log_search(read_events(spark, log.path), SINCE, UNTIL, "cloudtrail", text))
        index.refresh()


def test_an_empty_table(spark):
    path = run_dir(spark, "x")
    index = TextIndex(spark, f"{path}/e", f"{path}/i")
    assert index.refresh() == {"read": 0, "added": 0, "dropped": 0} and index.search("abc", SINCE, UNTIL).count() == 0
