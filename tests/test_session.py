from quoteline.session import CLUSTER_SETTINGS, SESSION_DEFAULTS, checkpoint_root, scratch_path


def test_cluster_settings_are_known_runtime_settings(spark):
    # a mistyped key would be accepted silently by Spark; isModifiable is true only for
    # registered, non-static SQL settings
    for key in CLUSTER_SETTINGS:
        assert spark.conf.isModifiable(key), key
    assert set(SESSION_DEFAULTS) <= set(CLUSTER_SETTINGS)


def test_scratch_paths_are_new_folders_under_the_checkpoint_dir(spark):
    root = checkpoint_root(spark)
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(root + "/x-") and b.startswith(root + "/x-")


def test_cluster_without_shared_folder_is_an_error():
    from types import SimpleNamespace

    import pytest

    conf = SimpleNamespace(get=lambda key, default: default)
    context = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None, getConf=lambda: conf)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_root(SimpleNamespace(sparkContext=context))
