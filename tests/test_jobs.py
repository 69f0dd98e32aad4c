import pytest

from freshet import IngestConfig, registry
from freshet.jobs import bronze, replay
from freshet.operators import audit
from freshet.session import path_exists, scratch_dir, scratch_scope
from freshet.sources.csv_records import MissingInputs, read_csv

SPECS = registry("acme").values()


def test_scratch_scopes_delete_their_own_folders_only(spark, tmp_path):
    outside = scratch_dir(spark, "outside")
    with scratch_scope(spark):
        with scratch_scope(spark) as keep_last:
            paths = [scratch_dir(spark, name) for name in ("gone", "kept")]
            for path in (outside, *paths):
                spark.range(1).write.parquet(path)
            keep_last()
        assert [path_exists(spark, p) for p in (outside, *paths)] == [True, False, True]
    assert [path_exists(spark, p) for p in (outside, *paths)] == [True, False, False]


@pytest.fixture
def folders(tmp_path, monkeypatch):
    paths = {name: str(tmp_path / name) for name in ("raw", "log", "lake", "checkpoints")}
    monkeypatch.setenv("LAKEHOUSE_PATH", paths["lake"])
    monkeypatch.setenv("CHECKPOINT_PATH", paths["checkpoints"])
    (tmp_path / "raw").mkdir()
    return paths


def export(folder, spec, count=6):
    rows = [",".join(spec.fields)]
    rows += [",".join(f"{field}{i}" for field in spec.fields) for i in range(count)]
    (folder / spec.source_file).write_text("\n".join(rows) + "\n")


def test_replay_then_bronze(spark, tmp_path, folders, caplog):
    flags = ["--data-dir", folders["raw"], "--log-dir", folders["log"], "--prefix", "acme"]
    with pytest.raises(MissingInputs) as error:
        replay.main(flags, spark)
    assert len(error.value.paths) == 5
    for spec in SPECS:
        export(tmp_path / "raw", spec)
    before = read_csv(spark, str(tmp_path / "raw" / "acme_orders_dataset.csv"))
    with caplog.at_level("INFO"):
        replay.main([*flags, "--delay", "2"], spark)
    assert before.count() == 6  # a frame of the caller's outlives the job's scratch
    assert "acme.orders: 6 records" in caplog.text

    for _ in range(2):
        bronze.main(["--prefix", "acme", "--log-dir", folders["log"], "--available-now"], spark)
    cfg = IngestConfig(folders["lake"], folders["checkpoints"])
    for spec in SPECS:
        rows = audit.read_bronze(spark, cfg, spec).collect()
        assert len(rows) == 6
        assert {r._topic for r in rows} == {spec.topic}
        assert {r[spec.key_field] for r in rows} == {f"{spec.key_field}{i}" for i in range(6)}
        times = sorted(r._kafka_timestamp for r in rows)
        assert (times[-1] - times[0]).total_seconds() == 10
