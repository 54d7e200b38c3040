"""Settings of the stream sources and triggers that cannot run here."""

from pyspark.sql.streaming import DataStreamReader, DataStreamWriter

from tessera.session import local_path, scratch_path
from tessera.sources.text import stream_kafka, stream_text_dir
from tessera.streaming import kpi_delta, orders, rolled
from tests.conftest import lines_df
from tests.test_orders import SAMPLE
from tests.test_streaming import RULE_LINES, write_lines


class Loaded:
    """Stands for the frame that the connector would give."""

    def select(self, *cols):
        self.selected = [str(c) for c in cols]
        return self


def options_of(monkeypatch, spark, *args, **kw):
    seen = {}

    def option(self, key, value):
        seen[key] = value
        return self

    def fmt(self, name):
        seen["format"] = name
        return self

    monkeypatch.setattr(DataStreamReader, "option", option)
    monkeypatch.setattr(DataStreamReader, "format", fmt)
    monkeypatch.setattr(DataStreamReader, "load", lambda self: Loaded())
    stream_kafka(spark, *args, **kw)
    return seen


def test_kafka_options(spark, monkeypatch):
    assert options_of(monkeypatch, spark, "h1:9092,h2:9092", "orders,returns") == {
        "format": "kafka", "kafka.bootstrap.servers": "h1:9092,h2:9092", "subscribe": "orders,returns",
        "startingOffsets": "earliest", "failOnDataLoss": "true"}
    assert options_of(monkeypatch, spark, "h:1", "t", starting_offsets="latest", group_id="g",
                      max_offsets_per_trigger=5, min_partitions=7, fail_on_data_loss=False) == {
        "format": "kafka", "kafka.bootstrap.servers": "h:1", "subscribe": "t",
        "startingOffsets": "latest", "failOnDataLoss": "false", "kafka.group.id": "g",
        "maxOffsetsPerTrigger": "5", "minPartitions": "7"}


def test_kafka_value_is_read_as_text(spark, monkeypatch):
    frame = Loaded()
    monkeypatch.setattr(DataStreamReader, "load", lambda self: frame)
    assert stream_kafka(spark, "h:1", "t") is frame
    assert frame.selected == ["Column<'CAST(value AS STRING) AS value'>"]


def test_streams_run_every_20_seconds_unless_told(spark, monkeypatch):
    root = local_path(scratch_path(spark, "t-trigger"))
    write_lines(f"{root}/src", "a.txt", SAMPLE)
    seen = []
    monkeypatch.setattr(DataStreamWriter, "trigger",
                        lambda self, **kw: seen.append(kw) or _never(monkeypatch, self))
    src, rules = stream_text_dir(spark, f"{root}/src"), lines_df(spark, RULE_LINES)
    orders.start_kpi_query(src, rules, f"{root}/kpi", f"{root}/c1")
    orders.start_archive_query(src, f"{root}/data", f"{root}/c2")
    rolled.start_rolled_query(src, rolled.RolledArchive(spark, f"{root}/r"), f"{root}/c3")
    kpi_delta.start_kpi_delta_query(src, rules, kpi_delta.KpiDeltas(spark, f"{root}/k"), f"{root}/c4")
    assert seen == [{"processingTime": "20 seconds"}] * 4


def _never(monkeypatch, writer):
    """The writer, which must not start a query that runs for ever."""
    monkeypatch.setattr(type(writer), "start", lambda self, *a, **kw: None)
    return writer
