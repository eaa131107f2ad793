"""Session defaults and the checkpoint folder."""

import pytest

from leadlake.session import DEFAULT_CONF, checkpoint_dir, scratch_dir


def test_session_defaults(spark):
    for key in ("spark.sql.session.timeZone", "spark.sql.ansi.enabled", "spark.sql.adaptive.enabled",
                "spark.sql.adaptive.skewJoin.enabled", "spark.python.sql.dataFrameDebugging.enabled"):
        assert spark.conf.get(key) == DEFAULT_CONF[key], key
    assert DEFAULT_CONF["spark.sql.session.timeZone"] == "UTC"


def test_checkpoint_dir_prefers_the_cluster_setting(spark, tmp_path):
    current = spark.conf.get("spark.checkpoint.dir", None)
    assert current                                   # the test session (or the cluster) names one
    # a fallback never overrides a folder the cluster already names
    assert checkpoint_dir(spark, fallback=str(tmp_path / "other")) == current
    assert spark.sparkContext.getCheckpointDir() is not None


class _Conf(dict):
    def set(self, key, value):
        self[key] = value


class _Session:
    def __init__(self, **settings):
        self.conf = _Conf({k.replace("_", "."): v for k, v in settings.items()})


def test_scratch_dir_is_the_shared_folder_and_required_on_a_cluster():
    named = _Session(spark_master="spark://host:7077")
    named.conf["spark.checkpoint.dir"] = "s3a://bucket/shared/"
    assert scratch_dir(named) == "s3a://bucket/shared"
    for master in ("spark://host:7077", "yarn", "local-cluster[3,2,1024]"):
        with pytest.raises(ValueError):
            scratch_dir(_Session(spark_master=master))
    local = _Session(spark_master="local[4]")
    assert scratch_dir(local) == scratch_dir(local)      # made once, then read from the session
