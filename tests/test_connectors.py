from tidemark.sources import connectors as C


def test_option_builders_are_plain_settings():
    assert C.jdbc_options("jdbc:x://h/db", "t", "u", "p", "org.x.Driver") == {
        "url": "jdbc:x://h/db", "dbtable": "t", "user": "u", "password": "p", "driver": "org.x.Driver"}
    conf = C.s3a_conf("https://objects.example", path_style=True, ssl=False)
    assert conf["spark.hadoop.fs.s3a.endpoint"] == "https://objects.example"
    assert conf["spark.hadoop.fs.s3a.path.style.access"] == "true"
    assert conf["spark.hadoop.fs.s3a.connection.ssl.enabled"] == "false"
    assert set(C.TOPICS) == {"raw", "alert", "metrics"}


def test_package_exports():
    import tidemark
    for name in ("windowed_metrics", "unified", "upsert", "speed_stream", "run_batch_cycle", "check_lake"):
        assert callable(getattr(tidemark, name))
