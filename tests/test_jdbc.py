"""JDBC helpers that need no database: settings from the environment and
the flattening of complex columns before an export."""

from recolake.sources import jdbc


def test_connection_from_env(monkeypatch):
    monkeypatch.setenv("RECOLAKE_DB_URL", "jdbc:x://h/db")
    monkeypatch.setenv("RECOLAKE_DB_USER", "u")
    monkeypatch.delenv("RECOLAKE_DB_PASSWORD", raising=False)
    assert jdbc.connection_from_env() == {"url": "jdbc:x://h/db", "user": "u"}


def test_complex_columns_become_json(spark):
    df = spark.createDataFrame([(1, [(2, 0.5)])], "uid int, recs array<struct<mid:int,rating:double>>")
    out = jdbc._flatten_complex(df)
    assert dict(out.dtypes) == {"uid": "int", "recs": "string"}
    assert out.collect()[0].recs == '[{"mid":2,"rating":0.5}]'
