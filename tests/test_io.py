"""Sources and sinks that need no service to be tested."""

from tideline.sinks import jdbc, tables
from tideline.sources import files, kafka


def test_collection_and_elements(spark, rows):
    made = [("sensor_1", 1547718199, 35.8), ("sensor_6", 1547718201, 15.4)]
    df = files.from_collection(spark, made, "id string, timestamp bigint, temperature double")
    assert rows(df) == made
    assert rows(files.from_elements(spark, 1, 34, 4)) == [(1,), (34,), (4,)]


def test_text_keeps_blank_lines(spark, tmp_path):
    (tmp_path / "a.txt").write_text("x,1\n\n\ny,2\n")
    assert files.text_lines(spark, str(tmp_path)).count() == 4


def test_csv_table(spark, tmp_path, rows):
    (tmp_path / "a.csv").write_text("a,1,2.5\nb,x,3\n\nc,3\n")
    df = files.csv_table(spark, str(tmp_path), "id string, ts bigint, temp double", "in_table")
    assert rows(df) == [("a", 1, 2.5), ("b", None, 3.0), ("c", 3, None)]
    assert spark.table("in_table").count() == 3


def test_kafka_options():
    assert kafka.source_options("h:9092", "a", group="g") == {
        "kafka.bootstrap.servers": "h:9092", "subscribe": "a", "startingOffsets": "latest",
        "groupIdPrefix": "g",
    }
    assert kafka.sink_options("h:9092", "b") == {"kafka.bootstrap.servers": "h:9092", "topic": "b"}


def test_payloads(spark, rows):
    df = spark.createDataFrame([("a", 1, 2.5), ("b,c", None, 1.0)], "id string, ts bigint, temp double")
    payload = kafka.to_csv_payload(df)
    assert rows(payload) == [('"b,c",,1.0',), ("a,1,2.5",)]
    assert rows(kafka.csv_payload(payload, "id string, ts bigint, temp double")) == rows(df)
    raw = payload.selectExpr("cast(value as binary) as value", "0 as partition")
    assert rows(kafka.as_lines(raw)) == rows(payload)
    assert rows(kafka.to_text_payload(df, "Reading")) == [
        ("Reading{id='a', ts=1, temp=2.5}",), ("Reading{id='b,c', ts=null, temp=1.0}",),
    ]


def test_documents_are_kept_twice(spark, tmp_path):
    df = spark.createDataFrame([("a", 1.5), ("a", 1.5)], "id string, temp double")
    for _ in range(2):
        tables.append_documents(df, str(tmp_path / "docs"), {"id": "id", "temp": "temp"})
    found = [r.value for r in spark.read.text(str(tmp_path / "docs")).collect()]
    assert found == ['{"id":"a","temp":"1.5"}'] * 4


def test_upsert_by_chunks():
    held = {"a": 1.0}

    class Connection:
        committed = closed = False
        asked = []

        def cursor(self):
            return self

        def execute(self, sql, keys):
            self.asked.append((sql, list(keys)))

        def fetchall(self):
            return [(k,) for k in self.asked[-1][1] if k in held]

        def executemany(self, sql, rows):
            for row in rows:
                if sql.startswith("update"):
                    assert row[1] in held
                    held[row[1]] = row[0]
                else:
                    assert row[0] not in held
                    held[row[0]] = row[1]

        def commit(self):
            self.committed = True

        def close(self):
            self.closed = True

    connection = Connection()
    rows = [{"id": k, "temp": v} for k, v in (("b", 2.0), ("a", 3.0), ("c", 4.0))]
    jdbc.upsert_rows(rows, lambda: connection, "sensor_temp", "id", ["temp"], chunk=2)
    assert held == {"a": 3.0, "b": 2.0, "c": 4.0} and connection.committed and connection.closed
    assert connection.asked == [
        ("select id from sensor_temp where id in (?, ?)", ["b", "a"]),
        ("select id from sensor_temp where id in (?)", ["c"]),
    ]
    assert jdbc.statements("sensor_temp", "id", ["temp"], "%s") == (
        "update sensor_temp set temp = %s where id = %s",
        "insert into sensor_temp (id, temp) values (%s, %s)",
    )



def test_upsert_of_a_batch_writes_each_key_once(spark, tmp_path):
    df = spark.createDataFrame([("a", 0, 1.0), ("a", 1, 2.0), ("b", 2, 3.0)],
                               "id string, seq bigint, temp double")
    folder = str(tmp_path)

    def connect():
        import os
        import uuid

        class Recorder:
            def cursor(self):
                return self

            def execute(self, sql, fields):
                assert sql.startswith("select")

            def fetchall(self):
                return []

            def executemany(self, sql, rows):
                assert sql.startswith("insert")
                for fields in rows:
                    with open(os.path.join(folder, uuid.uuid4().hex), "w") as f:
                        f.write(repr(list(fields)))

            def commit(self):
                pass

            def close(self):
                pass

        return Recorder()

    jdbc.upsert_batch(connect, "sensor_temp", "id", ["temp"], ["seq"])(df, 0)
    assert sorted(f.read_text() for f in tmp_path.iterdir()) == ["['a', 2.0]", "['b', 3.0]"]
