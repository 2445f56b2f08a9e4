import pytest
from pyspark.sql.classic.dataframe import DataFrame


@pytest.fixture
def to_driver(monkeypatch):
    """Characters in the rows that reached the driver so far."""
    seen = [0]

    def counted(row):
        seen[0] += len(str(tuple(row)))
        return row

    for name in ("collect", "toLocalIterator"):
        plain = getattr(DataFrame, name)

        def call(self, *args, plain=plain, name=name, **more):
            rows = map(counted, plain(self, *args, **more))
            return list(rows) if name == "collect" else rows

        monkeypatch.setattr(DataFrame, name, call)
    return lambda: seen[0]
