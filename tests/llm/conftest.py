import pytest

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def folder():
    return FOLDER


@pytest.fixture(scope="session")
def read(spark):
    return lambda name: spark.read.parquet(f"{FOLDER}/{name}.parquet")


@pytest.fixture(scope="session")
def sql_rows():
    """Rows that DuckDB gives over the test tables, as tuples by column name."""
    import duckdb

    def run(sql, names=("documents", "pages", "benchmark", "labels", "embeddings")):
        connection = duckdb.connect()
        for name in names:
            connection.execute(f"create view {name} as select * from '{FOLDER}/{name}.parquet'")
        found = connection.execute(sql)
        columns = [c[0] for c in found.description]
        order = [columns.index(c) for c in sorted(columns)]
        return sorted(columns), sorted((tuple(r[i] for i in order) for r in found.fetchall()), key=str)

    return run
