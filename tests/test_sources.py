from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from hitwatch.session import remove, utc, work_dir
from hitwatch.sources import derived
from hitwatch.sinks.batches import to_kafka
from hitwatch.sinks.streams import kafka_topics
from hitwatch.sources.kafka import kafka_messages, kafka_options, kafka_stream
from hitwatch.sources.lines import line_files, socket_stream, table, table_stream

TLS = {
    "KAFKA_SECURITY_PROTOCOL": "SSL",
    "KAFKA_SSL_TRUSTSTORE_LOCATION": "/t.jks",
    "KAFKA_SSL_TRUSTSTORE_PASSWORD": "tp",
    "KAFKA_SSL_KEYSTORE_LOCATION": "/k.jks",
    "KAFKA_SSL_KEYSTORE_PASSWORD": "kp",
}


def test_plain_kafka_options():
    assert kafka_options(environ={}) == {"kafka.bootstrap.servers": "kafka:9093"}
    assert kafka_options("b:1", {"KAFKA_BROKER": "c:2"}) == {"kafka.bootstrap.servers": "b:1"}
    assert kafka_options(environ={"KAFKA_BROKER": "c:2"}) == {"kafka.bootstrap.servers": "c:2"}
    plaintext = {**TLS, "KAFKA_SECURITY_PROTOCOL": "PLAINTEXT"}
    assert kafka_options("b:1", plaintext) == {"kafka.bootstrap.servers": "b:1"}


def test_tls_kafka_options():
    assert kafka_options("b:1", TLS) == {
        "kafka.bootstrap.servers": "b:1",
        "kafka.security.protocol": "SSL",
        "kafka.ssl.truststore.location": "/t.jks",
        "kafka.ssl.truststore.password": "tp",
        "kafka.ssl.keystore.location": "/k.jks",
        "kafka.ssl.keystore.password": "kp",
    }


@pytest.mark.parametrize("missing", ["LOCATION", "PASSWORD"])
def test_store_needs_location_and_password(missing):
    environ = {key: value for key, value in TLS.items() if key != f"KAFKA_SSL_KEYSTORE_{missing}"}
    options = kafka_options("b:1", environ)
    assert "kafka.ssl.truststore.location" in options
    assert not [key for key in options if "keystore" in key]


class Recorder:
    """Stands in for a reader or writer, as no connector is at hand, and notes its settings."""

    def __init__(self):
        self.settings = {}

    def __getattr__(self, name):
        def note(*args, **options):
            if name == "option":
                self.settings[args[0]] = args[1]
            elif name == "options":
                self.settings.update(options)
            else:
                self.settings[name] = args[0] if args else True
            return self

        return note


class WithRecorder:
    def __init__(self):
        self.read = self.readStream = self.write = self.writeStream = Recorder()


def test_kafka_scans(monkeypatch):
    monkeypatch.setenv("KAFKA_BROKER", "c:2")
    session = WithRecorder()
    kafka_stream(session, "http-logs", minPartitions="8")
    assert session.read.settings == {
        "format": "kafka", "kafka.bootstrap.servers": "c:2", "subscribe": "http-logs",
        "minPartitions": "8", "load": True}
    session = WithRecorder()
    kafka_messages(session, "a,b", "b:1")
    assert session.read.settings == {
        "format": "kafka", "kafka.bootstrap.servers": "b:1", "subscribe": "a,b", "load": True}


def test_kafka_sinks(monkeypatch):
    for key, value in TLS.items():
        monkeypatch.setenv(key, value)
    rows = WithRecorder()
    to_kafka("alerts", "b:1")(rows, 0)
    assert rows.write.settings == {
        "format": "kafka", **kafka_options("b:1", TLS), "topic": "alerts", "mode": "append", "save": True}
    rows = WithRecorder()
    to_kafka(None, "b:1")(rows, 0)
    assert "topic" not in rows.write.settings
    rows = WithRecorder()
    kafka_topics(rows, "b:1")
    assert rows.write.settings["kafka.acks"] == "all" and rows.write.settings["kafka.retries"] == "5"
    assert rows.write.settings["kafka.ssl.keystore.location"] == "/k.jks"


def test_socket_stream_is_declared_without_connecting(spark):
    lines = socket_stream(spark, "localhost", 1)
    assert lines.isStreaming and lines.columns == ["value"]


def test_line_files(spark, tmp_path):
    (tmp_path / "a.log").write_text("one\ntwo\n")
    assert sorted(r["value"] for r in line_files(spark, str(tmp_path)).collect()) == ["one", "two"]


def test_table_stream_of_a_file_and_of_a_folder(spark, small, tmp_path):
    events = table(spark, small, "events")
    events.write.parquet(str(tmp_path / "events.parquet"))
    for folder in (small, str(tmp_path)):
        stream = table_stream(spark, folder, "events")
        assert stream.isStreaming and stream.schema == events.schema
        out = work_dir(spark, "copy")
        query = (
            stream.writeStream.format("parquet")
            .option("path", f"{out}/out")
            .option("checkpointLocation", f"{out}/checkpoint")
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
        assert spark.read.parquet(f"{out}/out").count() == events.count()


def test_work_dir_is_below_the_shared_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    one, two = work_dir(spark, "x"), work_dir(spark, "x")
    assert one != two and one.startswith(root) and two.startswith(root)


class Session:
    """A session without a shared folder."""

    def __init__(self, master):
        self.conf = {"spark.master": master}


@pytest.mark.parametrize("master", ["yarn", "local-cluster[2,1,1024]", "spark://host:7077"])
def test_no_local_folder_on_a_cluster(master):
    with pytest.raises(ValueError):
        work_dir(Session(master), "x")


def test_session_keeps_its_time_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        with utc(spark):
            assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
        assert spark.conf.get("spark.sql.session.timeZone") == "Asia/Tokyo"
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_removed_folders_are_gone(spark):
    path = work_dir(spark, "x")
    spark.range(3).write.parquet(path)
    remove(spark, path)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)


def test_local_master_gets_a_folder():
    assert work_dir(Session("local[2]"), "x").startswith("/tmp/run-")


def test_derived_lines_have_the_expected_shape(spark, small):
    events = table(spark, small, "events")
    lines = derived.access_log_lines(events)
    assert lines.count() == events.count() == 10000
    assert lines.filter("value like 'malformed %'").count() == 104
    row = lines.filter("event_id = 1").first()["value"]
    assert row.endswith(' 201 3318') or row.endswith(" 401 3318")


def test_alert_offsets_run_on_across_blocks(spark, small, monkeypatch):
    alerts = derived.batch_alerts(table(spark, small, "events"))
    whole = derived.alert_messages(alerts).orderBy("offset").collect()
    monkeypatch.setattr(derived, "BATCHES_PER_BLOCK", 2)
    blocks = derived.alert_messages(alerts).orderBy("offset").collect()
    assert [r["offset"] for r in whole] == list(range(alerts.count()))
    assert blocks == whole


def test_fan_out_doubles_every_record(spark, small):
    messages = derived.log_messages(table(spark, small, "events"), partitions=3)
    assert {tuple(r) for r in messages.groupBy("topic", "partition").agg(
        F.count(F.lit(1)), F.max("offset")).collect()} == {
        (topic, p, 3334 if p == 0 else 3333, 3333 if p == 0 else 3332)
        for topic in ("http-logs", "http-logs-monitoring") for p in range(3)}
    texts = messages.filter("partition = 1 and offset = 0").orderBy("topic").collect()
    assert " - [01/Jan/2024:00:00:00 +0000] " in texts[0]["value"]
    assert texts[1]["value"].startswith('{"ip":"192.168.10.')
