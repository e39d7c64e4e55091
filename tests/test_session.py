import os

import pytest

from tasteforge.session import _machine_local, drop_intermediates, input_bytes, materialize, scoped_intermediates, shared_dir, shuffle_partitions


def test_shuffle_partitions_follow_the_volume():
    assert shuffle_partitions(0, 8) == 16
    assert shuffle_partitions(100 << 30, 8) == 400
    assert shuffle_partitions(100 << 40, 4000) == 100_000


def test_stored_tables_live_in_the_named_folder_until_dropped(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    stored = materialize(spark.range(3).toDF("id"), "three")
    (path,) = {os.path.dirname(f.removeprefix("file://")) for f in stored.inputFiles()}
    assert path.startswith(shared_dir(spark)) and stored.count() == 3
    drop_intermediates(spark)
    assert not os.path.exists(path)


def test_scopes_own_their_tables(spark):
    place = lambda df: os.path.dirname(df.inputFiles()[0].removeprefix("file://"))
    outer = materialize(spark.range(1).toDF("id"), "outer")
    with pytest.raises(ZeroDivisionError), scoped_intermediates(spark):
        inner = place(materialize(spark.range(2).toDF("id"), "inner"))
        assert os.path.exists(inner)
        1 / 0
    assert not os.path.exists(inner) and outer.count() == 1
    drop_intermediates(spark)


def test_temporary_folders_are_no_shared_folders():
    assert all(map(_machine_local, ("/tmp/x", "file:///tmp/x", "file:/var/tmp", "/dev/shm/a")))
    assert not any(map(_machine_local, ("s3a://b/tmp/x", "hdfs:///tmp/x", "/mnt/shared", "file:///mnt/tmp")))


def test_input_bytes(spark, tmp_path):
    (tmp_path / "a").write_bytes(b"x" * 10)
    assert input_bytes(spark, str(tmp_path), str(tmp_path / "none")) == 10
