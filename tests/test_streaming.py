"""The click stream: two deliveries, a restart, a replay, and the same numbers from a batch query."""

from collections import Counter
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from weblens import schemas
from weblens.operators.clean import clean_clicks, parse_clicks
from weblens.operators.kv import CellTable, CounterTable
from weblens.streaming import clicks as cs

DAY1, DAY2 = "2018-12-09 10:00:00", "2018-12-10 10:00:00"
BING, NONE = "http://cn.bing.com/search?q=x", "-"


def line(course, time, referer=BING, status="200"):
    return f'1.1.1.1\t{time}\t"GET /class/{course}.html HTTP/1.1"\t{status}\t{referer}'


FIRST = [line(88, DAY1), line(88, DAY1, NONE), line(7, DAY1, "https://m.example.org/a"), "broken"]
SECOND = [line(88, DAY2), line(88, DAY1, status="404"), line(88, DAY1)]

COURSES = {"20181209_88": 4, "20181209_7": 1, "20181210_88": 1}
REFERRERS = {"20181209_cn.bing.com_88": 3, "20181209_m.example.org_7": 1,
             "20181210_cn.bing.com_88": 1}


def totals(table):
    return {r.row_key: r.value for r in table.totals().collect()}


def tables(spark, tmp_path):
    return [CounterTable(spark, str(tmp_path / name), commits=str(tmp_path / "commits")) for name in ("courses", "referrers")]


def deliver(folder, name, rows):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(rows) + "\n")


def run(spark, tmp_path, courses, referrers, **source):
    query = cs.start_click_counters(
        cs.file_lines(spark, str(tmp_path / "in"), **source), courses, referrers,
        str(tmp_path / "checkpoint"), "s", once=True)
    query.awaitTermination()
    return [p.observedMetrics[cs.METRICS] for p in query.recentProgress if p.numInputRows]


def test_two_runs_on_one_checkpoint(spark, tmp_path):
    courses, referrers = tables(spark, tmp_path)
    deliver(tmp_path / "in", "a.txt", FIRST)
    (metrics,) = run(spark, tmp_path, courses, referrers)
    assert (metrics["lines"], metrics["rejects"]) == (4, 1)
    assert totals(courses) == {"20181209_88": 2, "20181209_7": 1}
    deliver(tmp_path / "in", "b.txt", SECOND)
    run(spark, tmp_path, courses, referrers)
    assert totals(courses) == COURSES and totals(referrers) == REFERRERS
    run(spark, tmp_path, courses, referrers)
    assert totals(courses) == COURSES and totals(referrers) == REFERRERS

    replay = parse_clicks(spark.read.text(str(tmp_path / "in" / "b.txt")))
    cs.counter_writer(courses, referrers, "s")(replay, 1)
    assert totals(courses) == COURSES and totals(referrers) == REFERRERS


def test_many_small_batches(spark, tmp_path):
    courses, referrers = tables(spark, tmp_path)
    for i, row in enumerate(FIRST + SECOND):
        deliver(tmp_path / "in", f"{i}.txt", [row])
    run(spark, tmp_path, courses, referrers, max_files=2)
    assert totals(courses) == COURSES and totals(referrers) == REFERRERS
    assert len(list((tmp_path / "courses" / "log" / "stream_id=s").glob("batch_id=*"))) == 4


def test_a_backlog_runs_in_bounded_batches_and_its_counts_are_stored(spark, tmp_path):
    courses, referrers = tables(spark, tmp_path)
    for i in range(50):
        deliver(tmp_path / "in", f"{i}.txt", [line(i % 3, DAY1)] * 2 + ["broken"] * (i % 2))
    run(spark, tmp_path, courses, referrers, max_files=10)
    batches = courses.markers.batches().orderBy("batch_id").collect()
    assert [r["batch_id"] for r in batches] == [0, 1, 2, 3, 4] and {r["attempt"] for r in batches} == {1}
    assert sum(r["lines"] for r in batches) == 125 and sum(r["rejects"] for r in batches) == 25
    assert all(r["lines"] - r["rejects"] == 20 for r in batches)
    assert sum(totals(courses).values()) == 100


def test_a_file_source_admits_bounded_batches_unless_told_otherwise():
    class Session:
        def __init__(self):
            self.readStream, self.seen = self, {}

        def option(self, key, value):
            self.seen[key] = value
            return self

        def text(self, folder):
            return self.seen

    assert cs.file_lines(Session(), "in") == {"maxFilesPerTrigger": cs.MAX_FILES}
    assert cs.file_lines(Session(), "in", max_files=None) == {}


def test_state_of_running_totals_is_bounded_and_drops_no_click(spark, tmp_path):
    """Four hundred days in forty deliveries; the clock is what the lines carry as their address. Each day brings its own
    clicks, one of the day before, one a year old, one unreadable, one of the far future."""
    start = datetime(2018, 1, 1)
    expected, table = Counter(), CellTable(spark, str(tmp_path / "totals"))

    def click(now, when, course):
        return f'{now:%Y-%m-%d %H:%M:%S}\t{when}\t"GET /class/{course}.html HTTP/1.1"\t200\t-'

    for part in range(40):
        rows = []
        for day in range(part * 10, part * 10 + 10):
            now = start + timedelta(days=day, hours=20)
            times = [now - timedelta(hours=1), now - timedelta(days=1), now - timedelta(days=365)]
            for when, key in [(f"{t:%Y-%m-%d %H:%M:%S}", f"{t:%Y%m%d}") for t in times] + [("junk", "19700101"), ("9999-01-01 00:00:00", "99990101")]:
                rows.append(click(now, when, 5))
                expected[f"{key}_5"] += 1
        deliver(tmp_path / "in", f"{part:02d}.txt", rows)
    query = cs.start_running_totals(cs.file_lines(spark, str(tmp_path / "in"), max_files=1), table, str(tmp_path / "checkpoint"),
                                    once=True, now=F.to_timestamp("ip"))
    query.awaitTermination()
    states = [p.stateOperators[0] for p in query.recentProgress if p.stateOperators]
    assert sum(s.numRowsDroppedByWatermark for s in states) == 0
    assert totals(table) == dict(expected)
    # Five keys a day; a delivery of ten days and the days kept may be in the state, not four hundred.
    assert max(s.numRowsTotal for s in states) <= 5 * (10 + 10 + cs.KEEP_DAYS + 2)


def test_stateful_totals(spark, tmp_path):
    table = CellTable(spark, str(tmp_path / "totals"))
    for name, rows in (("a.txt", FIRST), ("b.txt", SECOND)):
        deliver(tmp_path / "in", name, rows)
        cs.start_running_totals(cs.file_lines(spark, str(tmp_path / "in")), table,
                                str(tmp_path / "checkpoint"), once=True).awaitTermination()
    assert totals(table) == COURSES


def test_batch_counts_equal_the_stream(lines):
    counts = cs.click_counts(clean_clicks(lines(*FIRST, *SECOND)).good)
    assert {tuple(r) for r in cs.course_deltas(counts).collect()} == set(COURSES.items())
    assert {tuple(r) for r in cs.referrer_deltas(counts).collect()} == set(REFERRERS.items())


def test_kafka_source_options():
    """The connector is not part of Spark's own jars, so only the request is checked."""
    class Source:
        def __init__(self):
            self.seen = {}

        def format(self, name):
            self.seen["format"] = name
            return self

        def option(self, key, value):
            self.seen[key] = value
            return self

        def options(self, **values):
            self.seen.update(values)
            return self

        def load(self):
            return self

        def select(self, column):
            self.seen["select"] = str(column)
            return self

    class Session:
        readStream = Source()

    seen = cs.kafka_lines(Session(), "h:9092", ["a", "b"], {"startingOffsets": "earliest"}).seen
    assert seen["format"] == "kafka" and seen["subscribe"] == "a,b"
    assert seen["kafka.bootstrap.servers"] == "h:9092" and seen["startingOffsets"] == "earliest"
    assert seen["maxOffsetsPerTrigger"] == str(cs.MAX_OFFSETS)
    assert "CAST(value AS STRING)" in seen["select"]
    assert schemas.LINE.fieldNames() == ["value"]
