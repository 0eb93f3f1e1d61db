"""Writers: tables, CSV and JSON exports, comparison of two copies, atomic replacement of one or several tables."""

from __future__ import annotations

import json
import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _files(spark: SparkSession, path: str):
    """(file system, function that makes its paths) of the place where ``path`` lies."""
    make = spark._jvm.org.apache.hadoop.fs.Path
    return make(path).getFileSystem(spark._jsc.hadoopConfiguration()), make


def replace_tables(tables: dict[str, DataFrame], dry_run: bool = False) -> dict[str, int]:
    """Clear-then-insert for every path: rows written, by path.

    All new tables are written aside first, and only when all are complete does each take the place of the old one, by
    renaming; the old one goes last.  A failed job leaves every old table as it was.  With ``dry_run`` rows are counted
    and nothing is written.
    """
    if dry_run:
        return {path: df.count() for path, df in tables.items()}
    mark, done = uuid.uuid4().hex, {}
    try:
        for path, df in tables.items():
            df.write.parquet(f"{path}.new-{mark}")
            done[path] = df.sparkSession.read.schema(df.schema).parquet(f"{path}.new-{mark}").count()
    except Exception:
        for path, df in tables.items():
            fs, make = _files(df.sparkSession, path)
            fs.delete(make(f"{path}.new-{mark}"), True)
        raise
    for path, df in tables.items():
        fs, make = _files(df.sparkSession, path)
        old = make(f"{path}.old-{mark}")
        had = fs.exists(make(path))
        if had and not fs.rename(make(path), old):
            raise OSError(f"cannot set aside {path}")
        if not fs.rename(make(f"{path}.new-{mark}"), make(path)):
            raise OSError(f"cannot put {path} in place")
        if had:
            fs.delete(old, True)
    return done


def replace_table(df: DataFrame, path: str, dry_run: bool = False) -> int:
    """``replace_tables`` for one table."""
    return replace_tables({path: df}, dry_run)[path]


def in_order(names, order: tuple[str, ...]) -> list[str]:
    """Those of ``order`` that are among ``names``, then the others by name."""
    names = set(names)
    return [n for n in order if n in names] + sorted(names - set(order))


def export_csv(df: DataFrame, path: str) -> None:
    """CSV with header; arrays, maps and structs as JSON text."""
    flat = [F.to_json(c).alias(c) if t.startswith(("array", "map", "struct")) else F.col(c) for c, t in df.dtypes]
    df.select(*flat).write.mode("overwrite").option("header", True).csv(path)


def export_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def content_hash(df: DataFrame) -> DataFrame:
    """One row, ``rows`` and ``hash``: independent of the order of rows."""
    h = F.xxhash64(*[F.to_json(c) if t.startswith(("array", "map", "struct")) else F.col(c) for c, t in df.dtypes])
    return df.select(h.cast("decimal(38,0)").alias("h")).agg(F.count("*").alias("rows"), F.sum("h").alias("hash"))


def difference(name: str, ours: DataFrame, theirs: DataFrame) -> DataFrame:
    """``name, ours, theirs, in_sync``: row counts, and whether the contents agree too."""
    a = content_hash(ours).toDF("ours", "ha")
    b = content_hash(theirs).toDF("theirs", "hb")
    return a.join(F.broadcast(b)).select(F.lit(name).alias("name"), "ours", "theirs", ((F.col("ours") == F.col("theirs")) & F.col("ha").eqNullSafe(F.col("hb"))).alias("in_sync"))


def export_tables(spark: SparkSession, tables: dict[str, DataFrame], target: str, incremental: bool = False) -> dict[str, str]:
    """Export each table; with ``incremental`` only those whose content differs from the copy at ``target``."""
    done = {}
    for name, df in tables.items():
        path = f"{target}/{name}"
        if incremental:
            try:
                same = difference(name, df, spark.read.parquet(path)).first()["in_sync"]
            except Exception:  # no copy yet
                same = False
            if same:
                done[name] = "in sync"
                continue
        replace_table(df, path)
        done[name] = "written"
    return done


def graph_json(nodes: DataFrame, edges: DataFrame, path: str) -> None:
    """A browser graph: one JSON object with nodes and edges, for a path the driver can write.

    Rows come to the driver a partition at a time and go straight to the file, so it never holds the graph.
    """
    with open(path, "w", encoding="utf-8") as f:
        for k, (name, df) in enumerate((("nodes", nodes), ("edges", edges))):
            f.write(f'{", " if k else "{"}"{name}": [')
            for i, row in enumerate(df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("j")).toLocalIterator()):
                f.write((", " if i else "") + row["j"])
            f.write("]")
        f.write("}")


def ranked_csv(scores: DataFrame, path: str, score: str = "score", key: str = "id") -> None:
    """CSV of scores with four decimals, best first, ties by key, with the rank as the first column."""
    from tidemark.operators.ranges import numbered

    got = numbered(scores, [F.desc_nulls_last(score), F.asc(key)], "rank")
    plain = [F.format_string("%.4f", F.col(c)).alias(c) if t in ("double", "float") else F.col(c) for c, t in got.dtypes if c != "rank"]
    got.select("rank", *plain).write.mode("overwrite").option("header", True).csv(path)


def ddl(df: DataFrame, name: str, key: list[str]) -> str:
    """A PostgreSQL table definition for the frame's schema."""
    kinds = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE PRECISION", "float": "REAL", "string": "TEXT", "boolean": "BOOLEAN", "date": "DATE", "timestamp": "TIMESTAMPTZ", "timestamp_ntz": "TIMESTAMP"}

    def kind(t: str) -> str:
        return kind(t[6:-1]) + "[]" if t.startswith("array<") else kinds.get(t, "JSONB" if t.startswith(("map", "struct")) else t.upper())

    lines = [f'"{c}" {kind(t)}' for c, t in df.dtypes]
    if key:
        lines.append("PRIMARY KEY (" + ", ".join(f'"{k}"' for k in key) + ")")
    return f'CREATE TABLE "{name}" (' + ", ".join(lines) + ")"


def upsert_statement(name: str, columns: list[str], key: list[str], mark: str = "?") -> str:
    """An insert that replaces the row of the same key, or leaves it if there are no other columns."""
    quoted = lambda cs: ", ".join(f'"{c}"' for c in cs)
    rest = [c for c in columns if c not in key]
    action = "DO UPDATE SET " + ", ".join(f'"{c}" = excluded."{c}"' for c in rest) if rest else "DO NOTHING"
    return f'INSERT INTO "{name}" ({quoted(columns)}) VALUES ({", ".join([mark] * len(columns))}) ON CONFLICT ({quoted(key)}) {action}'


def send_batches(df: DataFrame, connect, size: int = 500, streams: int = 4) -> int:
    """Rows sent in batches of ``size`` by ``streams`` tasks: each opens ``connect() -> send(list of tuples)`` once.

    A task that is run again sends its rows again, so ``send`` should upsert. The sent rows are counted.
    """
    names = df.columns

    def run(batches):
        import pyarrow as pa

        send, held, sent = connect(), [], 0
        for batch in batches:
            held += zip(*(batch.column(c).to_pylist() for c in range(len(names))))
            while len(held) >= size:
                send(held[:size])
                held, sent = held[size:], sent + size
        if held:
            send(held)
        yield pa.RecordBatch.from_arrays([pa.array([sent + len(held)])], ["n"])

    return df.coalesce(streams).mapInArrow(run, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def export_database(tables: dict[str, tuple[DataFrame, list[str]]], execute, connect, size: int = 1000) -> dict[str, int]:
    """Full export of ``tables`` (frame and key by name): each table is dropped and created by ``execute(statement)`` and
    filled in batches by ``connect(name, statement) -> (() -> send)``; rows sent, by table."""
    done = {}
    for name, (df, key) in tables.items():
        execute(f'DROP TABLE IF EXISTS "{name}"')
        execute(ddl(df, name, key))
        done[name] = send_batches(df, connect(name, upsert_statement(name, df.columns, key)), size)
    return done


def save_status(path: str, rows: dict[str, int], at: str) -> None:
    """Adds to the status file what was exported when."""
    status = load_status(path) | {name: {"rows": n, "exported_at": at} for name, n in rows.items()}
    with open(path, "w", encoding="utf-8") as f:
        json.dump(status, f, indent=1, sort_keys=True)


def load_status(path: str) -> dict[str, dict]:
    """The status file; a missing one is empty."""
    if not os.path.exists(path):
        return {}
    with open(path, encoding="utf-8") as f:
        return json.load(f)


def status_report(spark: SparkSession, tables: dict[str, DataFrame], path: str) -> DataFrame:
    """``name, ours, exported, in_sync``: row counts now and at the last export; a table never exported has null."""
    known = load_status(path)
    rows = [(name, df.count(), known.get(name, {}).get("rows")) for name, df in tables.items()]
    got = spark.createDataFrame(rows, "name string, ours long, exported long")
    return got.withColumn("in_sync", F.coalesce(F.col("ours") == F.col("exported"), F.lit(False)))
