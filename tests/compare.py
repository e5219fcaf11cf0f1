"""Compare a Spark result with its oracle SQL, ignoring row order."""

from pathlib import Path

import duckdb

VIEWS = (
    "region nation customer supplier part orders lineitem events documents embeddings"
    " pages benchmark labels conversations"
).split()


def oracle_connection(sf_dir: Path):
    connection = duckdb.connect()
    connection.execute("SET timezone = 'UTC'")
    for view in VIEWS:
        path = sf_dir / f"{view}.parquet"
        if path.exists():
            connection.execute(f"CREATE VIEW {view} AS SELECT * FROM '{path}'")
    return connection


def _ordered(rows):
    return sorted(rows, key=lambda row: [str(value) for value in row])


def spark_rows(df):
    columns = sorted(df.columns)
    return columns, _ordered(tuple(row) for row in df.select(*columns).collect())


def oracle_rows(connection, sql):
    cursor = connection.execute(sql)
    names = [column[0] for column in cursor.description]
    columns = sorted(names)
    order = [names.index(column) for column in columns]
    return columns, _ordered(tuple(row[i] for i in order) for row in cursor.fetchall())
