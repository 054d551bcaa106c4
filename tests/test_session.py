from churnlens.session import CLUSTER_CONF, CORE_CONF, max_broadcast_rows, scratch_path, shared_dir


def test_cluster_settings_are_known_and_settable(spark):
    before = {k: spark.conf.get(k, None) for k in CLUSTER_CONF}
    try:
        for k, v in CLUSTER_CONF.items():
            spark.conf.set(k, v)  # raises for unknown or static keys
            assert spark.conf.get(k) is not None
    finally:
        for k, v in before.items():
            if v is not None:
                spark.conf.set(k, v)
    assert spark.conf.get("spark.sql.session.timeZone") == CORE_CONF["spark.sql.session.timeZone"]


def test_shared_folder_comes_from_the_session(spark):
    d = shared_dir(spark)
    assert d == spark.sparkContext.getCheckpointDir().rstrip("/")
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(d)
    assert max_broadcast_rows(spark) == 1_000_000
