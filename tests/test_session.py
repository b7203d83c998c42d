"""Where written tables go: the folder the cluster names, never a guess."""

from gridmart import session


def test_shared_root_follows_the_session(spark):
    before = spark.conf.get(session.WAREHOUSE_CONF, None)
    try:
        spark.conf.set(session.WAREHOUSE_CONF, "hdfs://lake/gridmart")
        assert session.shared_root(spark) == "hdfs://lake/gridmart"
        assert session.fresh_path(spark, "x").startswith("hdfs://lake/gridmart/x-")
        spark.conf.unset(session.WAREHOUSE_CONF)
        # Otherwise the cluster's checkpoint folder (set here by spark-defaults or by a test).
        cp = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
        assert cp and session.shared_root(spark) in (cp, spark.conf.get(session.WAREHOUSE_CONF, None))
    finally:
        if before is not None:
            spark.conf.set(session.WAREHOUSE_CONF, before)


def test_fresh_paths_never_repeat(spark):
    paths = {session.fresh_path(spark, "run") for _ in range(50)}
    assert len(paths) == 50


def test_configure_sets_utc_and_dynamic_overwrite(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    session.configure(spark)
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == "dynamic"


def test_a_cluster_without_a_shared_folder_is_an_error(spark, monkeypatch):
    import pytest

    before = spark.conf.get(session.WAREHOUSE_CONF, None)
    spark.conf.unset(session.WAREHOUSE_CONF)
    monkeypatch.setattr(session, "is_local", lambda _: False)
    monkeypatch.setattr(type(spark.sparkContext), "getCheckpointDir", lambda self: None)
    try:
        if spark.conf.get("spark.checkpoint.dir", None) is None:
            with pytest.raises(RuntimeError):
                session.shared_root(spark)
    finally:
        if before is not None:
            spark.conf.set(session.WAREHOUSE_CONF, before)
