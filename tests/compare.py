"""Order-insensitive comparison of Spark rows with DuckDB rows."""

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def database(sf_dir):
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return db


def spark_rows(df):
    names = sorted(df.columns)
    table = df.select(*[f"`{n}`" for n in names]).toArrow()
    return names, rows_of(table)


def oracle_rows(db, sql):
    table = db.sql(sql).to_arrow_table()
    names = sorted(table.column_names)
    return names, rows_of(table.select(names))


def rows_of(table):
    columns = [column.to_pylist() for column in table.columns]
    return sorted(zip(*columns), key=repr)
