"""Versions of a layer: published whole, written once, readable while a newer one is made."""

import os

import pytest

from spanlake.plans import jobs
from spanlake.session import remove_scratch, scratch_path, scratch_root
from spanlake.sources.versions import Draft, Folder, current, read_current

from test_jobs import inputs  # noqa: F401


def table(spark, value):
    return spark.createDataFrame([(value, f"v{value}")], "a int, b string")


def published(spark, layer, value):
    with Draft(spark, layer) as new:
        new.write(table(spark, value), "x")
        new.write(table(spark, value), "y")
        new.publish()
    return new


def values(spark, layer):
    version = current(spark, layer)
    return [version.read(t).first()["a"] for t in ("x", "y")]


def test_readers_get_whole_versions(spark, tmp_path):
    layer = str(tmp_path / "layer")
    published(spark, layer, 1)
    before = current(spark, layer)
    draft = Draft(spark, layer)
    draft.write(table(spark, 2), "x")  # killed here: y is missing, nothing is published
    assert values(spark, layer) == [1, 1]
    published(spark, layer, 3)
    assert values(spark, layer) == [3, 3]
    assert before.read("y").first()["a"] == 1  # a reader that began earlier goes on
    assert draft.name not in os.listdir(f"{layer}/versions")  # what the killed run left is gone


def test_a_failed_run_leaves_nothing(spark, tmp_path):
    layer = str(tmp_path / "layer")
    published(spark, layer, 1)
    with pytest.raises(RuntimeError):
        with Draft(spark, layer) as new:
            new.write(table(spark, 2), "x")
            raise RuntimeError
    assert len(os.listdir(f"{layer}/versions")) == 1 and values(spark, layer) == [1, 1]


def test_old_versions_are_removed(spark, tmp_path):
    layer = str(tmp_path / "layer")
    names = [published(spark, layer, i).name for i in range(5)]
    assert sorted(os.listdir(f"{layer}/versions")) == names[2:]
    assert sorted(f for f in os.listdir(layer) if not f.startswith(".")) == ["CURRENT", "versions"]


def test_rows_are_split_in_one_pass(spark, tmp_path):
    layer = str(tmp_path / "layer")
    rows = spark.createDataFrame([(1, "u", "x"), (2, "v", "y"), (3, "w", "z")], "a int, b string, `table` string")
    with Draft(spark, layer) as new:
        made = new.write_split(rows, {"x": ["a"], "y": ["a", "b"], "empty": ["b", "a"]})
        new.publish()
    assert made["x"].collect() == [(1,)] and made["empty"].collect() == []
    assert read_current(spark, layer, "y").collect() == [(2, "v")]
    assert read_current(spark, layer, "empty").columns == ["b", "a"]


def test_plain_folders_are_read_as_well(spark, tmp_path):
    table(spark, 7).write.parquet(str(tmp_path / "x"))
    assert read_current(spark, str(tmp_path), "x").first()["a"] == 7


def test_pointer_is_replaced_as_a_whole(spark, tmp_path):
    folder = Folder(spark, str(tmp_path))
    folder.write("CURRENT", "é one")
    folder.write("CURRENT", "two")
    assert folder.read("CURRENT") == "two" and folder.names("") == ["CURRENT"]


def test_conform_stopped_between_two_tables(spark, inputs, tmp_path, monkeypatch):  # noqa: F811
    """Snapshots of the new run are written, its periods are not: readers see the run before."""
    bronze, silver = str(tmp_path / "bronze"), str(tmp_path / "silver")
    jobs.ingest(spark, inputs, bronze)
    jobs.conform(spark, bronze, silver)
    before = sorted(r["ID"] for r in read_current(spark, silver, "periods").collect())

    def stop(*_):
        raise KeyboardInterrupt

    monkeypatch.setattr(jobs, "judge_links", stop)
    with pytest.raises(KeyboardInterrupt):
        jobs.conform(spark, bronze, silver)
    assert sorted(r["ID"] for r in read_current(spark, silver, "periods").collect()) == before
    assert len(os.listdir(f"{silver}/versions")) == 1


def test_scratch_is_removed(spark):
    path = scratch_path(spark, "t")
    table(spark, 1).write.parquet(path)
    assert path.startswith(scratch_root(spark)) and os.path.isdir(path.removeprefix("file:"))
    # Other tests share the session's folder, so only this table goes.
    Folder(spark, scratch_root(spark)).remove(path.rsplit("/", 1)[1])
    assert not os.path.exists(path.removeprefix("file:"))


def test_local_scratch_is_refused_on_a_cluster():
    class Context:
        master, applicationId = "spark://host:7077", "app-1"

    class Session:
        sparkContext = Context()

        def __init__(self, **settings):
            self.conf = settings

    class Conf(dict):
        def get(self, key, default=None):
            return super().get(key, default)

    session = Session()
    session.conf = Conf({"spark.sql.warehouse.dir": "/home/me/warehouse"})
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_root(session)
    session.conf["spark.sql.warehouse.dir"] = "hdfs://nn/warehouse"
    assert scratch_root(session) == "hdfs://nn/warehouse/.scratch/app-1"
    session.conf["spark.checkpoint.dir"] = "file:///mnt/shared"
    assert scratch_root(session) == "file:///mnt/shared/app-1"
    assert callable(remove_scratch)
