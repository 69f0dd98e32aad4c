import dataclasses

import pytest
from pyspark.sql.types import StringType

from freshet import AUDIT_FIELDS, IngestConfig, registry
from freshet.jobs import bronze as bronze_job
from freshet.jobs import replay as replay_job
from freshet.session import session_settings
from freshet.sources import kafka, topic_log


def test_five_topics_with_key_and_audit_fields():
    specs = registry("shop")
    assert list(specs) == [
        "shop.orders",
        "shop.order_items",
        "shop.order_payments",
        "shop.customers",
        "shop.products",
    ]
    for topic, spec in specs.items():
        assert spec.topic == topic
        assert spec.key_field in spec.fields
        assert spec.source_file == f"shop_{spec.table}_dataset.csv"
        assert spec.partitions == 3
        assert spec.payload_schema.names == [*spec.fields, *AUDIT_FIELDS]
        assert {f.dataType for f in spec.payload_schema} == {StringType()}


def test_prefix_names_topics_and_files():
    spec = registry("acme")["acme.customers"]
    assert (spec.table, spec.source_file) == ("customers", "acme_customers_dataset.csv")


def test_bronze_schema_order():
    schema = registry()["shop.order_payments"].bronze_schema
    assert schema.simpleString() == (
        "struct<_kafka_topic:string,_kafka_partition:int,_kafka_offset:bigint,"
        "_kafka_timestamp:timestamp,order_id:string,payment_sequential:string,"
        "payment_type:string,payment_installments:string,payment_value:string,"
        "_topic:string,_ingested_at:string,_event_id:string,_bronze_date:date>"
    )


def test_config_from_env():
    cfg = IngestConfig.from_env({"KAFKA_BROKER": "b:1", "LAKEHOUSE_PATH": "/l"}, keep_raw=True)
    assert (cfg.broker, cfg.lakehouse, cfg.checkpoints) == ("b:1", "/l", "/checkpoints")
    assert cfg.keep_raw and cfg.trigger_seconds == 30
    assert cfg.table_path("orders") == "/l/bronze/orders"
    assert cfg.checkpoint_path("orders") == "/checkpoints/bronze/orders"


@pytest.mark.parametrize(
    "settings", [{"source": "files"}, {"source": "topic_log"}, {"table_format": "orc"}]
)
def test_config_refuses(settings):
    with pytest.raises(ValueError):
        IngestConfig("/l", "/c", **settings)


def test_kafka_options():
    spec = registry()["shop.orders"]
    cfg = IngestConfig("/l", "/c", broker="b:1")
    assert kafka.read_options(spec, cfg) == {
        "kafka.bootstrap.servers": "b:1",
        "subscribe": "shop.orders",
        "startingOffsets": "earliest",
        "failOnDataLoss": "false",
    }
    limited = IngestConfig("/l", "/c", max_offsets_per_trigger=600, min_partitions=48)
    options = kafka.read_options(spec, limited)
    assert (options["maxOffsetsPerTrigger"], options["minPartitions"]) == ("600", "48")
    assert kafka.write_options("b:1") == {
        "kafka.bootstrap.servers": "b:1",
        "kafka.linger.ms": "10",
        "kafka.compression.type": "lz4",
    }


def test_replay_rate_limits_the_reader():
    cfg = IngestConfig("/l", "/c").at_replay_rate(0.05)
    assert cfg.max_offsets_per_trigger == 600
    assert IngestConfig("/l", "/c").at_replay_rate(60).max_offsets_per_trigger == 1


def test_topic_log_options():
    cfg = IngestConfig("/l", "/c", source="topic_log", log_dir="/t", max_files_per_trigger=4)
    assert topic_log.read_options(cfg) == {
        "ignoreMissingFiles": "false",
        "maxFileAge": "36500d",
        "maxFilesPerTrigger": "4",
    }
    lenient = dataclasses.replace(cfg, fail_on_data_loss=False, max_file_age="30d")
    options = topic_log.read_options(lenient)
    assert (options["ignoreMissingFiles"], options["maxFileAge"]) == ("true", "30d")


def test_data_loss_fails_by_default_in_a_topic_log_only():
    assert not IngestConfig("/l", "/c").fails_on_data_loss
    assert IngestConfig("/l", "/c", source="topic_log", log_dir="/t").fails_on_data_loss
    spec = registry()["shop.orders"]
    strict = IngestConfig("/l", "/c", fail_on_data_loss=True)
    assert kafka.read_options(spec, strict)["failOnDataLoss"] == "true"


def test_replay_rate_is_refused_for_a_topic_log():
    with pytest.raises(ValueError, match="topic log"):
        IngestConfig("/l", "/c", source="topic_log", log_dir="/t").at_replay_rate(0.05)


def test_delta_is_only_named_when_asked_for():
    assert not any("delta" in v for v in session_settings().values())
    assert any("Delta" in v for v in session_settings("delta").values())


def test_job_arguments():
    args = replay_job.arguments(["--data-dir", "/d", "--delay", "1.0", "--log-dir", "/t"])
    assert (args.data_dir, args.delay, args.log_dir) == ("/d", 1.0, "/t")
    assert replay_job.DELAY == 0.05
    assert replay_job.arguments(["--broker", "b:1", "--keep-order"]).keep_order
    flags = "--available-now --starting-offsets latest --fail-on-data-loss --replay-delay 0.5"
    args = bronze_job.arguments(flags.split())
    assert args.available_now and args.fail_on_data_loss and args.compact_dates
    assert (args.starting_offsets, args.replay_delay) == ("latest", 0.5)
    assert args.max_offsets_per_trigger and args.max_files_per_trigger
    assert bronze_job.arguments([]).fail_on_data_loss is None
    assert bronze_job.arguments(["--no-fail-on-data-loss"]).fail_on_data_loss is False


@pytest.mark.parametrize("flags", [["--delay", "1"], ["--log-dir", "/t", "--keep-order"]])
def test_replay_job_refuses_flags_without_effect(flags, capsys):
    with pytest.raises(SystemExit):
        replay_job.arguments(flags)
    assert "--log-dir" in capsys.readouterr().err or "--keep-order" in flags
