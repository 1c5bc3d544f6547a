import os

from cardlens.session import RUNTIME_CONF, apply_runtime_conf, ensure_checkpoint_dir, scratch_path


def test_runtime_conf_applied(spark):
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "65535")
    apply_runtime_conf(spark)
    for key, value in RUNTIME_CONF.items():
        assert spark.conf.get(key) == value


def test_checkpoint_folder_is_read_from_the_session(spark):
    path = ensure_checkpoint_dir(spark)
    assert path == spark.conf.get("spark.checkpoint.dir")
    assert spark.sparkContext.getCheckpointDir() is not None
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(os.path.join(path, "cardlens-scratch-")) and b.startswith(os.path.join(path, "cardlens-scratch-"))
