"""The JDBC sinks without a database: the statements, the transaction, the way
of the options through both jobs, and replays against tables kept in a dict."""

import re

import pytest
from pyspark.sql import functions as F

from tests_helpers import SF_SMALL
from tidewatch.sinks import jdbc
from tidewatch.sources.tables import readings

OPTIONS = {"url": "jdbc:postgresql://db/sensors", "user": "writer", "password": "p", "batchsize": "5000"}


class FakeDatabase:
    """Tables as lists of rows; knows the three statements, by their text, and transactions."""

    def __init__(self):
        self.tables, self.log, self.fail_at, self.opened = {}, [], None, []

    def stage(self, df, table, options):
        self.log.append(("stage", table))
        self.tables[table] = [r.asDict() for r in df.collect()]

    def connect(self, spark, **options):
        self.opened.append(options)
        return FakeConnection(self)


class FakeConnection:
    def __init__(self, db):
        self.db, self.auto, self.open = db, True, True

    def setAutoCommit(self, on):
        self.auto, self.before = on, {k: list(v) for k, v in self.db.tables.items()}

    def createStatement(self):
        return self

    def executeUpdate(self, sql):
        assert not self.auto and self.open
        self.db.log.append(("sql", sql))
        if self.db.fail_at and sql.startswith(self.db.fail_at):
            raise RuntimeError("connection lost")
        tables = self.db.tables
        if m := re.fullmatch(r'DELETE FROM (\S+) WHERE "batch_id" = (\d+)', sql):
            tables[m[1]] = [r for r in tables.get(m[1], []) if r["batch_id"] != int(m[2])]
        elif m := re.fullmatch(r"INSERT INTO (\S+) \((.*)\) SELECT (.*) FROM (\S+)", sql):
            assert m[2] == m[3]
            names = [x.strip('"') for x in m[2].split(", ")]
            tables[m[1]] = tables.get(m[1], []) + [{c: r[c] for c in names} for r in tables[m[4]]]
        elif m := re.fullmatch(r"DROP TABLE (\S+)", sql):
            del tables[m[1]]
        else:
            raise AssertionError(sql)

    def commit(self):
        self.db.log.append(("commit",))

    def rollback(self):
        self.db.log.append(("rollback",))
        self.db.tables = self.before

    def close(self):
        pass


@pytest.fixture()
def db(monkeypatch):
    fake = FakeDatabase()
    monkeypatch.setattr(jdbc.replace_batch, "__defaults__", ('"', fake.connect, fake.stage))
    return fake


def test_statements():
    assert jdbc.replace_statements("iot.sensor_data", ["seq", "time", 'a"b'], 7) == [
        'DELETE FROM iot.sensor_data WHERE "batch_id" = 7',
        'INSERT INTO iot.sensor_data ("seq", "time", "a""b", "batch_id") '
        'SELECT "seq", "time", "a""b", "batch_id" FROM iot.sensor_data_stage_7',
        "DROP TABLE iot.sensor_data_stage_7"]
    assert "`time`" in jdbc.replace_statements("t", ["time"], 0, quote="`")[1]


@pytest.mark.parametrize("name", ["", "a b", "t; DROP TABLE x", "a.b.c", "1t", 't"'])
def test_names_that_are_no_tables(name):
    with pytest.raises(ValueError):
        jdbc.staging_table(name, 1)


def test_a_replay_replaces_its_batch(spark, db):
    options = {**OPTIONS, "dbtable": "t"}
    for batch, rows in [(0, 3), (1, 4), (1, 4), (1, 2), (2, 0)]:  # the last replay has other rows
        jdbc.replace_batch(spark.range(rows), batch, options)
    assert sorted((r["batch_id"], r["id"]) for r in db.tables["t"]) == [(0, 0), (0, 1), (0, 2), (1, 0), (1, 1)]
    assert set(db.tables) == {"t"}


@pytest.mark.parametrize("at", ["DELETE", "INSERT", "DROP"])
def test_a_lost_connection_leaves_the_target_as_it_was(spark, db, at):
    options = {**OPTIONS, "dbtable": "t"}
    jdbc.replace_batch(spark.range(3), 0, options)
    db.fail_at = at
    with pytest.raises(RuntimeError):
        jdbc.replace_batch(spark.range(5), 0, options)
    assert len(db.tables["t"]) == 3 and db.log[-1] == ("rollback",)
    db.fail_at = None
    jdbc.replace_batch(spark.range(5), 0, options)
    assert len(db.tables["t"]) == 5 and set(db.tables) == {"t"}


def test_what_a_sink_needs(spark, db):
    with pytest.raises(ValueError, match="dbtable"):
        jdbc.replace_batch(spark.range(1), 0, OPTIONS)
    with pytest.raises(ValueError, match="batch_id"):
        jdbc.replace_batch(spark.range(1).withColumn("batch_id", F.lit(1)), 0, {**OPTIONS, "dbtable": "t"})
    assert db.log == []


SINKS = {"sensor_data": {"fmt": "jdbc", **OPTIONS, "dbtable": "iot.sensor_data"},
         "event_alerts": {"fmt": "jdbc", **OPTIONS, "dbtable": "iot.event_alerts"}}


def test_options_reach_the_stream(spark, db, scratch):
    from tidewatch.streaming.pipeline import make_batch_writer

    handle = make_batch_writer(spark, f"{scratch}/out", state_dir=f"{scratch}/edges", sinks=SINKS)
    r = readings(spark, SF_SMALL)
    parts = [r.where("seq < 300"), r.where("seq >= 300 AND seq < 600")]
    for batch in (0, 1, 1):
        handle(parts[batch], batch)
    rows = db.tables["iot.sensor_data"]
    assert sorted(x["seq"] for x in rows) == [x.seq for x in r.where("seq < 600").select("seq").orderBy("seq").collect()]
    assert {x["batch_id"] for x in rows} == {0, 1} and "temperature" in rows[0]
    alerts = db.tables["iot.event_alerts"]
    assert len(alerts) == len({(x["seq"], x["sensor_type"]) for x in alerts}) > 0
    assert spark.read.parquet(f"{scratch}/out/notifications").count() == len(alerts)  # the others stay files
    assert all(o["url"] == OPTIONS["url"] and o["user"] == "writer" for o in db.opened)


def test_options_reach_the_batch_job(spark, db, scratch):
    from tidewatch.plans.pipeline import write_batch

    r = readings(spark, SF_SMALL)
    for _ in range(2):
        write_batch(r, scratch, recipients=["ops@example.com"], sinks=SINKS, batch_id=20)
    assert len(db.tables["iot.sensor_data"]) == r.count()
    assert spark.read.parquet(f"{scratch}/notifications").count() == len(db.tables["iot.event_alerts"]) > 0


def test_a_sink_of_no_output_is_an_error(spark, scratch):
    from tidewatch.streaming.pipeline import make_batch_writer

    with pytest.raises(ValueError, match="sensordata"):
        make_batch_writer(spark, scratch, state_dir=f"{scratch}/edges", sinks={"sensordata": {"fmt": "jdbc"}})


def test_connection_properties_leave_out_the_writers_options(spark):
    class Loader:
        def loadClass(self, name):
            assert name == "org.example.Driver"
            return self

        newInstance = lambda self: self

        def connect(self, url, props):
            return url, dict(props.items())

    class Props(dict):
        def setProperty(self, key, value):
            self[key] = value

    class Any:
        def __init__(self, **kw):
            self.__dict__.update(kw)

    thread = Any(currentThread=lambda: Any(getContextClassLoader=Loader))
    jvm = Any(java=Any(util=Any(Properties=Props), lang=Any(Thread=thread)))
    assert jdbc.connect(Any(_jvm=jvm), driver="org.example.Driver", dbtable="t", numPartitions=4, **OPTIONS) == (
        OPTIONS["url"], {"user": "writer", "password": "p"})
