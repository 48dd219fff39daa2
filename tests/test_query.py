import pytest

from vigilake.operators import query as q
from vigilake.operators.query import Condition, InvalidCriteria, adapt_spelling


@pytest.mark.parametrize("text", ["a; b", "a -- b", "a /* b", "x # y", "DROP table", "x = 1 or delete", "a" * 4001])
def test_refused(text):
    with pytest.raises(InvalidCriteria):
        q.validate_criteria(text)


def test_accepted():
    assert q.validate_criteria("  updated_by = 'x' ") == "updated_by = 'x'"
    assert q.validate_criteria(None) == ""


def test_spelling():
    assert adapt_spelling("JSON_VALUE(details.user) = 'JSON_VALUE(details.user)'", ["identity"]) == "identity = 'JSON_VALUE(details.user)'"
    assert adapt_spelling("CAST(x AS INT64) > 1 AND 'a' NOT IN UNNEST(tags)") == "try_cast(x AS BIGINT) > 1 AND NOT array_contains(tags, 'a')"
    assert "$[\"a\"][\"b\"]" in adapt_spelling("STRING(details.a.b) = 'x'")


def test_or_stays_inside_the_window(events):
    all_time = q.query_events(events, "category = 'click' OR category = 'view'", 60, 1000, as_of="2024-01-31 00:00:00").count()
    assert all_time <= events.filter("utctimestamp >= '2024-01-30 23:00:00'").count()


def test_not_boolean(events):
    with pytest.raises(InvalidCriteria):
        q.criteria_column(events, "severity")


def test_click_to_filter():
    assert q.row_for_path(["details", "_ips", 0], "1.2.3.4") == Condition("details._ips[0]", "=", "1.2.3.4")
    assert q.row_for_path(["tags", 1], "aws") == Condition("tags", "=", "aws")
    assert q.row_for_path(["severity"], "INFO") == Condition("severity", "=", "INFO")
    for path, value in ((["utctimestamp"], "x"), (["details", "a"], None), (["details", "a"], {"x": 1}), ([], "x")):
        assert q.row_for_path(path, value) is None
    assert q.column_label("details.a[0]") == "a"


@pytest.fixture(scope="module")
def alert(spark):
    return spark.sql(
        "SELECT 'HIGH' severity, array('aws', 'login') tags, timestamp '2026-07-01 10:00:00' created_at, "
        "array(struct(struct(85 AS risk_score, 'Bob' AS who) AS details)) events, cast(null AS string) owner"
    )


@pytest.mark.parametrize(
    "field, op, value, want",
    [
        ("severity", "=", "high", True), ("severity", "!=", "high", False), ("tags", "=", "AWS", True), ("tags", "!=", "gcp", True),
        ("tags", "contains", "log", True), ("tags", ">", "a", False), ("events[0].details.risk_score", ">", "80", True),
        ("events[0].details.risk_score", "<", "9", False), ("events[0].details.who", "contains", "OB", True),
        ("missing.path", "=", "x", False), ("missing.path", "!=", "x", True), ("owner", "!=", "x", True), ("owner", "=", "x", False),
        ("created_at", ">", "2026-06-30", True), ("", "=", "x", True), ("severity", "=", " ", True), ("events[7].details.who", "!=", "x", True),
    ],
)
def test_record_matching(alert, field, op, value, want):
    assert alert.filter(q.matches_row(alert, Condition(field, op, value))).count() == int(want)


def test_missing_path_differs_between_modes(events):
    sql_mode = events.filter(q.row_predicate(events, Condition("details.nope", "!=", "x"))).count()
    record_mode = events.filter(q.matches_row(events, Condition("details.nope", "!=", "x"))).count()
    assert sql_mode == 0 and record_mode == events.count()


def test_bounded_and_pages(events):
    out = q.bounded_result(events.select("eventid"), 5)
    assert (out["row_count"], out["truncated"]) == (5, True)
    assert q.has_more(q.page(events, 10, 2, ts="utctimestamp", tie="eventid"), 10, 2)


def test_sort_puts_missing_last(spark):
    df = spark.createDataFrame([(2, "b"), (None, "c"), (10, "a")], "n int, s string")
    assert [r[0] for r in q.sort_any(df, "n", True).collect()] == [10, 2, None]
    assert [r[0] for r in q.sort_any(df, "n").collect()] == [2, 10, None]
    assert q.deep_search(df, "B").count() == 1
