import pytest

from tidal.session import checkpoint_root, default_blocks, shared_dir, shuffle_partitions


def test_shared_dirs_are_unique_under_the_checkpoint_root(spark):
    root = checkpoint_root(spark)
    assert root == spark.conf.get("spark.checkpoint.dir")       # the configured shared folder
    a, b = shared_dir(spark, "x"), shared_dir(spark, "x")
    assert a != b and a.startswith(root) and b.startswith(root)


def test_shuffle_partitions_is_restored(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with shuffle_partitions(spark, 3):
        assert default_blocks(spark) == 3
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    with pytest.raises(RuntimeError):
        with shuffle_partitions(spark, 5):
            raise RuntimeError("start failed")
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    with shuffle_partitions(spark, None):
        assert spark.conf.get("spark.sql.shuffle.partitions") == before
