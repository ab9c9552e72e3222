"""JDBC: no database may be started here, so these check what Spark is asked to do."""

import pytest

from headrace.sources import catalog
from headrace.sources.committed import CommittedTable
from headrace.sources.relational import JdbcTable
from headrace.streaming.tables import StreamToTable
from tests.test_envelope import message, values
from tests.test_streaming import Recorder

OPTIONS = {"url": "jdbc:postgresql://host/db", "user": "u", "password": "p", "driver": "org.postgresql.Driver"}


class Found(Recorder):
    def __init__(self, found):
        super().__init__()
        self.found = found

    def isEmpty(self):
        return not self.found

    def collect(self):
        return self.found


class Session:
    def __init__(self, found=()):
        self.read = Found(found)


def test_exists_asks_the_databases_own_metadata():
    for found in ([("trips",)], []):
        session = Session(found)
        assert JdbcTable(session, OPTIONS, "public.Trips").exists() == bool(found)
        assert ("format", "jdbc") in session.read.calls
        assert ("options", *sorted(OPTIONS.items())) in session.read.calls
        query = next(c for c in session.read.calls if c[:2] == ("option", "query"))[2]
        assert query == (
            "SELECT table_name FROM information_schema.columns "
            "WHERE lower(table_name) = 'trips' AND lower(table_schema) = 'public'"
        )


@pytest.mark.parametrize(
    ("name", "where"),
    [
        ("Trips", "lower(table_name) = 'trips' AND table_schema = current_schema"),
        ('db."My ""Own"" S"."Trips.v2"', "table_name = 'Trips.v2' AND table_schema = 'My \"Own\" S'"),
        ('taxi."Trips"', "table_name = 'Trips' AND lower(table_schema) = 'taxi'"),
    ],
)
def test_a_name_is_looked_up_in_its_own_schema(name, where):
    session = Session([])
    JdbcTable(session, OPTIONS, name).columns()
    query = next(c for c in session.read.calls if c[:2] == ("option", "query"))[2]
    assert query.endswith(f" WHERE {where}")


def test_a_quote_in_the_name_cannot_end_the_text():
    session = Session([])
    JdbcTable(session, OPTIONS, "x' OR '1'='1").exists()
    query = next(c for c in session.read.calls if c[:2] == ("option", "query"))[2]
    assert "= 'x'' or ''1''=''1' AND" in query


def test_columns_and_missing_ones():
    table = JdbcTable(Session([("b", 2), ("A", 1)]), OPTIONS, "trips")
    assert table.columns() == ["A", "b"]
    assert table.missing_columns(["a", "B", "c"]) == ["c"]


def test_read_in_parallel():
    session = Session()
    JdbcTable(session, OPTIONS, "trips").read("id", (1, 1000), 20)
    assert ("option", "dbtable", "trips") in session.read.calls
    split = {"partitionColumn": "id", "lowerBound": 1, "upperBound": 1000, "numPartitions": 20}
    assert ("options", *sorted(split.items())) in session.read.calls


class Observed:
    """A frame whose write is recorded."""

    def __init__(self):
        self.write = Recorder()
        self.spread = None

    def repartition(self, n):
        self.spread = n
        return self


@pytest.fixture
def frame(monkeypatch, spark):
    from headrace.sources import relational

    class Seen:
        get = {"rows": 3}

    monkeypatch.setattr(relational, "Observation", Seen)
    made = Observed()
    made.observe = lambda *_: made
    return made


def test_append_inserts_and_records_the_version(spark, place, frame):
    progress = CommittedTable(spark, place())
    table = JdbcTable(spark, OPTIONS, "trips", progress)
    assert table.exported_through() == -1
    assert table.append(frame, 4, writers=16) == 3
    assert ("mode", "append") in frame.write.calls and ("save",) in frame.write.calls
    assert ("options", *sorted({**OPTIONS, "numPartitions": "16"}.items())) in frame.write.calls
    assert table.exported_through() == 4
    assert [tuple(r) for r in progress.read().collect()] == [("trips", 3)]


def test_a_failed_append_records_nothing(spark, place, frame):
    progress = CommittedTable(spark, place())

    class Down(Recorder):
        def save(self):
            raise ConnectionError("down")

    down = Down()
    for step in ("format", "options", "option", "mode"):
        setattr(down, step, lambda *a, **k: down)
    frame.write = down
    with pytest.raises(ConnectionError):
        JdbcTable(spark, OPTIONS, "trips", progress).append(frame, 4)
    assert progress.last_version() == -1


def test_overwrite_uses_many_writers_and_batches(spark, frame):
    asked = {"numPartitions": "100", "batchsize": "1000", "truncate": "true"}
    assert JdbcTable(spark, OPTIONS, "trips").overwrite(frame) == 3
    assert frame.spread is None and ("mode", "overwrite") in frame.write.calls
    assert ("options", *sorted({**OPTIONS, **asked}.items())) in frame.write.calls
    JdbcTable(spark, OPTIONS, "trips").overwrite(frame, writers=7, spread=True)
    assert frame.spread == 7


def test_without_a_driver_the_error_is_raised(spark):
    with pytest.raises(Exception, match="(?i)driver"):
        JdbcTable(spark, OPTIONS, "trips").exists()


def test_jdbc_catalog_is_configured(spark):
    catalog.register_jdbc_catalog(spark, "offline", {"url": "jdbc:postgresql://host/db"})
    assert spark.conf.get("spark.sql.catalog.offline.url") == "jdbc:postgresql://host/db"
    assert spark.conf.get("spark.sql.catalog.offline").endswith("JDBCTableCatalog")
    for key in ("spark.sql.catalog.offline.url", "spark.sql.catalog.offline"):
        spark.conf.unset(key)


class Database(JdbcTable):
    """A table whose rows are kept here; writes may break off after some rows."""

    def __init__(self, spark, progress, columns):
        super().__init__(spark, OPTIONS, "trips", progress)
        self.known, self.rows, self.asked, self.breaks_after = columns, [], [], None

    def exists(self):
        return self.known is not None

    def columns(self):
        return self.known

    def read(self, *_):
        return self.spark.createDataFrame([tuple(r) for r in self.rows], "k STRING, batch_id LONG, batch_row LONG")

    def _write(self, df, mode, **options):
        arriving = [tuple(r[c] for c in df.columns) for r in df.collect()]
        self.asked.append((mode, sorted(df.columns), len(arriving)))
        order = [df.columns.index(c) for c in ("k", "batch_id", "batch_row") if c in df.columns]
        self.rows += [tuple(r[i] for i in order) for r in arriving][: self.breaks_after]
        if self.breaks_after is not None:
            raise ConnectionError("down")
        return len(arriving)


def test_a_stream_into_a_relational_table_names_what_it_lacks(spark, place):
    target = Database(spark, CommittedTable(spark, place()), ["K"])
    step = StreamToTable(target)
    step(values(spark, message({"k": "1"})), 0)
    assert target.asked == [("append", ["k"], 1)] and target.exported_through() == 0
    with pytest.raises(ValueError, match="trips lacks the columns new, other"):
        step(values(spark, message({"k": "2", "other": "x"}), message({"k": "3", "new": "y"})), 1)
    assert len(target.asked) == 1 and target.exported_through() == 0, "not a row was sent"
    target.known = ["k", "new", "other"]  # columns were added; the same micro-batch comes again
    step(values(spark, message({"k": "2", "other": "x"}), message({"k": "3", "new": "y"})), 1)
    assert target.asked[1:] == [("append", ["k", "new", "other"], 2)]
    step(values(spark, message({"k": "2", "other": "x"}), message({"k": "3", "new": "y"})), 1)
    assert len(target.asked) == 2, "a batch that is there is not sent again"


def test_a_relational_table_that_is_not_there_is_created(spark, place):
    target = Database(spark, CommittedTable(spark, place()), None)
    StreamToTable(target)(values(spark, message({"k": "1"})), 0)
    assert target.asked == [("append", ["k"], 1)]


def test_of_a_batch_that_broke_off_only_the_rest_is_sent(spark, place):
    rejects = CommittedTable(spark, place())
    target = Database(spark, CommittedTable(spark, place()), ["k", "batch_id", "batch_row"])
    step = StreamToTable(target, rejects=rejects)
    batch = values(spark, *(message({"k": str(n)}) for n in range(10)), "junk")
    target.breaks_after = 4
    with pytest.raises(ConnectionError):
        step(batch, 0)
    assert len(target.rows) == 4 and target.exported_through() == -1
    target.breaks_after = None
    step(batch, 0)
    assert [n for *_, n in target.asked] == [10, 6]
    assert sorted(r[0] for r in target.rows) == [str(n) for n in range(10)]
    assert len({r[2] for r in target.rows}) == 10 and {r[1] for r in target.rows} == {0}
    assert [r["value"] for r in rejects.read().collect()] == ["junk"]


def test_unreadable_messages_stop_a_relational_stream_without_a_place_for_them(spark, place):
    target = Database(spark, CommittedTable(spark, place()), ["k"])
    with pytest.raises(ValueError, match="unreadable"):
        StreamToTable(target)(values(spark, message({"k": "1"}), "junk"), 0)
    assert target.asked == [] and target.exported_through() == -1
    with pytest.raises(ValueError, match="read the rows back"):
        StreamToTable(target, also=print)
