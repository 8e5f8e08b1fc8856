"""Marks, windows and templates."""

from dataclasses import replace
from datetime import date, datetime

import pytest

from tidemark.checks import new_sink
from tidemark.config import SourceSpec, SyncJob, SyncSpec, TransformSpec
from tidemark.operators import incremental as inc
from tidemark.operators.monitor import latest_per_key
from tidemark.plans.sync import read_rows, run_sync
from tidemark.session import shared_dir
from tidemark.sources import register_reader

NOW = datetime(2024, 1, 20, 0, 0, 0, 999)
SCHEMA = "id BIGINT, value STRING, updated_at TIMESTAMP_NTZ"


@pytest.fixture
def users(spark):
    rows = [
        (1, "a", datetime(2024, 1, 15, 14, 30)),
        (2, "b", datetime(2024, 1, 16, 9, 15)),
        (3, "c", datetime(2024, 1, 17, 16, 45)),
        (4, "no time", None),
        (5, "future", datetime(2030, 1, 1)),
    ]
    return spark.createDataFrame(rows, SCHEMA)


def ids(df):
    return sorted(r["id"] for r in df.collect())


def test_window_is_open_below_and_closed_above(users):
    window = inc.Window(datetime(2024, 1, 15, 14, 30), datetime(2024, 1, 17, 16, 45))
    assert ids(inc.extract(users, "updated_at", window)) == [2, 3]


def test_consecutive_windows_make_up_the_whole(users):
    whole = inc.Window(datetime(2024, 1, 1), datetime(2024, 2, 1))
    parts = inc.window_slices(whole, 7)
    assert parts[0].start == whole.start and parts[-1].end == whole.end
    found = sorted(i for part in parts for i in ids(inc.extract(users, "updated_at", part)))
    assert found == ids(inc.extract(users, "updated_at", whole)) == [1, 2, 3]


def test_windows():
    mark = datetime(2024, 1, 15)
    end = datetime(2024, 1, 20)
    assert inc.sync_window(mark, NOW) == inc.Window(mark, end)
    assert inc.sync_window(None, NOW) is None
    assert inc.sync_window(None, NOW, "since_1900") == inc.Window(datetime(1900, 1, 1), end)
    assert inc.sync_window(None, NOW, "lookback", 7) == inc.Window(datetime(2024, 1, 13), end)
    with pytest.raises(ValueError):
        inc.sync_window(None, NOW, "sometimes")


def test_empty_destination_modes(users):
    assert ids(inc.extract(users, "updated_at", inc.sync_window(None, NOW))) == [1, 2, 3, 4, 5]
    since = inc.sync_window(None, NOW, "since_1900")
    assert ids(inc.extract(users, "updated_at", since)) == [1, 2, 3]


STANDARD = (
    "SELECT * FROM t WHERE updated_at > '{start_timestamp}' AND updated_at <= '{end_timestamp}' "
    "ORDER BY updated_at ASC"
)


def test_templates():
    window = inc.Window(datetime(2024, 1, 15), datetime(2024, 1, 20))
    query, arguments = inc.bind_template(STANDARD, window, NOW)
    assert ":start_timestamp AND updated_at <= :end_timestamp" in query
    assert arguments == {"start_timestamp": "2024-01-15 00:00:00", "end_timestamp": "2024-01-20 00:00:00"}
    filled = inc.fill_template(STANDARD, window, NOW)
    assert "updated_at > '2024-01-15 00:00:00' AND updated_at <= '2024-01-20 00:00:00'" in filled


def test_window_placeholder_reads_everything_or_a_range():
    text = "SELECT * FROM t WHERE {window} AND a = 1"
    assert inc.fill_template(text, None, NOW) == "SELECT * FROM t WHERE (1 = 1) AND a = 1"
    assert inc.bind_template(text, None, NOW) == ("SELECT * FROM t WHERE (1 = 1) AND a = 1", {})
    window = inc.Window(datetime(2024, 1, 15), datetime(2024, 1, 20))
    assert "changed > '2024-01-15 00:00:00' AND changed <= '2024-01-20 00:00:00'" in inc.fill_template(text, window, NOW, "changed")
    query, arguments = inc.bind_template(text, window, NOW, "changed")
    assert "`changed` > :start_timestamp" in query and len(arguments) == 2


def test_bounds_of_a_template_cannot_read_the_whole_history():
    for place in (inc.fill_template, inc.bind_template):
        with pytest.raises(ValueError):
            place(STANDARD, None, NOW)


def test_mark_of_missing_and_empty_table(spark, users):
    assert inc.destination_mark(spark, "not_there_at_all", "updated_at") is None
    assert inc.high_water_mark(users.limit(0), "updated_at") is None
    assert inc.high_water_mark(users, "updated_at") == datetime(2030, 1, 1)


def test_mark_needs_the_column(spark, users):
    sink = new_sink(spark)
    run_sync(spark, job_over(users, sink), NOW)
    with pytest.raises(ValueError):
        inc.destination_mark(spark, sink.table, "modified")


def job_over(df, sink, **options):
    df.createOrReplaceTempView("job_rows")
    return SyncJob([SourceSpec("postgresql", {"query": "SELECT * FROM job_rows"})], sink, **options)


def test_two_batches(spark):
    t = lambda h, m=0: datetime(2024, 1, 1, h, m)
    first = spark.createDataFrame([(1, "record_1", t(0)), (2, "record_2", t(0, 30))], SCHEMA)
    second = spark.createDataFrame([(2, "record_2_updated", t(2)), (3, "record_3", t(3))], SCHEMA)
    sink = new_sink(spark)
    sync = SyncSpec(incremental=True)
    run_sync(spark, job_over(first, sink, sync=sync), t(1))
    assert inc.destination_mark(spark, sink.table, "updated_at", "updated_at_day") == t(0, 30)
    both = job_over(first.union(second), sink, sync=sync)
    assert run_sync(spark, both, t(4)).written == 2
    again = run_sync(spark, both, t(4))
    assert (again.written, again.rejected) == (0, 0)
    stored = spark.table(sink.table)
    assert stored.count() == 4
    latest = {r["id"]: r["value"] for r in latest_per_key(stored, ["id"], "updated_at").collect()}
    assert latest == {1: "record_1", 2: "record_2_updated", 3: "record_3"}


def test_mark_failure_raises_or_falls_back(spark, users):
    sink = new_sink(spark, partition_field=None)
    users.select("id").write.option("path", sink.path).saveAsTable(sink.table)
    with pytest.raises(ValueError):
        run_sync(spark, job_over(users, sink, sync=SyncSpec(incremental=True)), NOW)
    full = SyncSpec(incremental=True, on_error="full")
    with pytest.raises(ValueError):  # appending everything would double what is there
        run_sync(spark, job_over(users, sink, sync=full), NOW)
    result = run_sync(spark, job_over(users, replace(sink, write="truncate"), sync=full), NOW)
    assert result.written == 5 and "updated_at" in result.fallback
    assert spark.table(sink.table).count() == 5


def test_source_without_the_timestamp_is_refused(spark, users):
    with pytest.raises(ValueError):
        run_sync(spark, job_over(users.drop("updated_at"), new_sink(spark), sync=SyncSpec(incremental=True)), NOW)


class FakeReader:
    """Stands in for ``spark.read`` over a database and notes what it is asked for."""

    def __init__(self, least, most, nulls):
        self.bounds, self.asked = {"least": least, "most": most, "nulls": nulls}, []

    def jdbc(self, url, table, **options):
        self.asked.append((url, table, options.get("predicates")))
        return self

    def first(self):
        return self.bounds


def sliced(options, window, bounds, **sync):
    class Session:
        read = FakeReader(*bounds)

    job = SyncJob([SourceSpec("postgresql", {"url": "jdbc:x", "partitions": 3, **options})], None, sync=SyncSpec(**sync))
    read_rows(Session, job.sources[0], job, window, NOW)
    return Session.read.asked


DAY = lambda d: datetime(2024, 1, d)


def test_jdbc_window_is_clipped_to_the_source_and_read_in_slices():
    bounds, rows = sliced({"table": "t"}, inc.Window(inc.OLDEST, DAY(9)), (DAY(1), DAY(4), 2), incremental=True)
    assert "min(updated_at)" in bounds[1] and "FROM t)" in bounds[1]
    assert rows[:2] == ("jdbc:x", "t") and len(rows[2]) == 3 and "IS NULL" not in " ".join(rows[2])
    assert rows[2][0].startswith("updated_at > '2023-12-31 23:59:59'") and rows[2][-1].endswith("<= '2024-01-04 00:00:00'")
    ends = [x.split("'") for x in rows[2]]
    assert all(a[3] == b[1] for a, b in zip(ends, ends[1:]))


@pytest.mark.parametrize("sync", [{"incremental": True}, {"source_timestamp": "updated_at"}])
def test_first_load_and_full_refresh_have_a_slice_for_nulls(sync):
    _, rows = sliced({"table": "t"}, None, (DAY(1), DAY(4), 2), **sync)
    assert len(rows[2]) == 4 and rows[2][-1] == "updated_at IS NULL"
    assert sliced({"table": "t"}, None, (None, None, 5), **sync)[1][2] == ["updated_at IS NULL"]
    assert sliced({"table": "t"}, None, (None, None, 0), **sync)[1][2] == ["1 = 0"]


def test_template_over_jdbc_is_a_derived_table_in_slices():
    bounds, rows = sliced({"template": STANDARD}, inc.Window(DAY(1), DAY(4)), (DAY(2), DAY(3), 0), incremental=True)
    assert "updated_at > '2024-01-01 00:00:00'" in rows[1] and rows[1].endswith(") AS source_rows") and "ORDER BY" not in rows[1]
    assert len(rows[2]) == 3 and rows[1] in bounds[1]


@pytest.mark.parametrize("days", [(5,), (1, 1, 2, 9), (1, 2, 3, 4, 5, 6)])
@pytest.mark.parametrize("window", [None, inc.Window(datetime(2024, 1, 1, 14, 30), datetime(2024, 1, 5, 0, 0, 7))])
def test_slices_of_a_date_column_have_every_row_once(spark, days, window):
    dates = [date(2024, 1, d) for d in days]
    rows = spark.createDataFrame([(d,) for d in dates], "updated_at DATE").cache()
    expected = sorted(r[0] for r in inc.extract(rows, "updated_at", window).collect())
    modes = [{"incremental": True}] if window else [{"incremental": True}, {"source_timestamp": "updated_at"}]
    for sync in modes:
        _, asked = sliced({"table": "t"}, window, (min(dates), max(dates), 0), **sync)
        found = [r[0] for p in asked[2] for r in rows.filter(p).collect()]
        assert sorted(found) == expected and (window or found)
        assert not any(":" in p for p in asked[2])


def test_template_over_jdbc_reads_a_date_columns_only_day():
    template = "SELECT * FROM t WHERE {window}"
    for window in (None, inc.Window(DAY(1), DAY(4))):
        _, rows = sliced({"template": template}, window, (date(2024, 1, 3), date(2024, 1, 3), 0), incremental=True)
        assert rows[2] == ["updated_at > '2024-01-02' AND updated_at <= '2024-01-03'"]


def test_unsplit_jdbc_read_is_refused():
    with pytest.raises(ValueError):
        sliced({"table": "t"}, None, (None, None, 0))


def test_template_over_another_reader_is_bound():
    asked = {}
    register_reader("noted", lambda spark, options: asked.update(options))
    source = SourceSpec("noted", {"template": STANDARD, "query": "SELECT 1"})
    job = SyncJob([source], None, sync=SyncSpec(incremental=True))
    read_rows(None, source, job, inc.Window(DAY(1), DAY(4)), NOW)
    assert ":start_timestamp" in asked["query"] and asked["arguments"]["start_timestamp"] == "2024-01-01 00:00:00"


def test_failed_conversions_go_to_the_rejects(spark):
    rows = spark.createDataFrame([(1, "2.5"), (2, "abc")], "id INT, price STRING")
    path = f"{shared_dir(spark)}/rejects"
    spec = TransformSpec(type_conversions={"price": "float"})
    sink = new_sink(spark)
    result = run_sync(spark, job_over(rows, sink, transform=spec, rejects_path=path), NOW)
    assert (result.written, result.rejected, result.failed) == (1, 0, 1)
    assert [(r["id"], r["price"]) for r in spark.table(sink.table).collect()] == [(1, 2.5)]
    kept = spark.read.parquet(f"{path}/transformation").first()
    assert (kept["id"], kept["price"]) == (2, "abc") and "abc" in kept["_transformation_error"]
