"""Table maintenance: overwrite, append, audit, catalog, column profile."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storelens.operators.ranking import top_n_per_group


def replace_folder(spark: SparkSession, path: str, write: Callable[[str], None]) -> None:
    """Let ``write`` fill a new folder and put it in place of ``path``.

    What is stored stays as it is until everything is written, so a write that fails
    changes nothing and may read what it replaces.  The swap is two renames: between
    them a reader finds no table.  If the second one fails the first is taken back.  For
    readers at any time, and for object stores, where a rename copies, use
    :func:`replace_versioned`.
    """
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    as_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    name = f"{path.rstrip('/')}-{uuid.uuid4().hex}"
    staged, old, place = as_path(f"{name}-new"), as_path(f"{name}-old"), as_path(path)
    store = place.getFileSystem(conf)
    moved = False
    try:
        write(f"{name}-new")
        if store.exists(place):
            moved = _renamed(store, place, old)
            if not moved:
                raise OSError(f"cannot move {path}")
        if not _renamed(store, staged, place):
            raise OSError(f"cannot move {name}-new to {path}")
    except BaseException:
        if moved:
            _renamed(store, old, place)
        raise
    finally:
        store.delete(staged, True)
    store.delete(old, True)


def _renamed(store, source, target) -> bool:
    return store.rename(source, target)


def replace_table(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` in place of what is stored."""
    replace_folder(df.sparkSession, path, lambda folder: df.write.parquet(folder))
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table_location(spark: SparkSession, name: str) -> str | None:
    """Where the rows of a catalog table are; none if there is no such table."""
    if not spark.catalog.tableExists(name):
        return None
    facts = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter("col_name = 'Location'").first()
    return facts.data_type


def replace_versioned(df: DataFrame, name: str, folder: str, keep: int = 1) -> DataFrame:
    """Make ``df`` the rows of the catalog table ``name``, whose versions are below ``folder``.

    Every version is a folder of its own.  It is written whole, and then one change of the
    catalog points the table at it: a reader sees the old rows or the new ones, nothing is
    renamed, and whatever fails before that change leaves the table as it was.  The last
    ``keep`` versions before the new one stay for readers that have begun with them; older
    ones are deleted.  A version has the columns of the table.
    """
    spark = df.sparkSession
    versions = folder.rstrip("/")
    now = spark.sql("SELECT date_format(current_timestamp(), 'yyyyMMddHHmmssSSSSSS') AS t").first().t
    path = f"{versions}/v{now}-{uuid.uuid4().hex[:8]}"
    as_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    where = as_path(versions)
    store = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    try:
        df.write.parquet(path)
        _point(spark, name, path, df)
    except BaseException:
        store.delete(as_path(path), True)
        raise
    known = sorted((f.getPath().getName() for f in store.listStatus(where)), reverse=True)
    for stale in known[keep + 1 :]:
        store.delete(as_path(f"{versions}/{stale}"), True)
    return spark.read.schema(df.schema).parquet(path)


def _point(spark: SparkSession, name: str, path: str, df: DataFrame) -> None:
    """The one step that readers notice."""
    if not spark.catalog.tableExists(name):
        spark.sql(f"CREATE TABLE {name} USING parquet LOCATION '{path}'")
    elif spark.table(name).schema.simpleString() == df.schema.simpleString():
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
        spark.catalog.refreshTable(name)
    else:
        raise ValueError(f"{name} has other columns: {spark.table(name).schema.simpleString()}")


def append_rows(df: DataFrame, path: str) -> DataFrame:
    """Add all rows of ``df`` in one write."""
    df.write.mode("append").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def row_count_audit(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row count per table, and in total.  Counting reads no column."""
    counts = reduce(
        DataFrame.unionByName,
        [df.agg(F.lit(name).alias("name"), F.count("*").alias("n")) for name, df in tables.items()],
    )
    return counts.rollup("name").agg(F.sum("n").alias("row_count")).select(
        F.coalesce("name", F.lit("TOTAL")).alias("table_name"), "row_count"
    )


def column_catalog(spark: SparkSession, tables: Mapping[str, DataFrame]) -> DataFrame:
    """Table, column, type and position, from the schemas alone."""
    rows = [
        (name, field.name, field.dataType.simpleString(), position)
        for name, df in tables.items()
        for position, field in enumerate(df.schema.fields, 1)
    ]
    return spark.createDataFrame(rows, "table_name string, column_name string, data_type string, ordinal int")


def columns_per_table(catalog: DataFrame) -> DataFrame:
    return catalog.groupBy("table_name").agg(
        F.sort_array(F.collect_list(F.struct("ordinal", "column_name", "data_type"))).alias("columns")
    )


def value_counts(df: DataFrame, names: list[str]) -> DataFrame:
    """(column_name, value, n): how often each value occurs, as text, without nulls.

    A task reads a part of one column, so it holds the values of that part only, and no
    cell is copied next to those of other columns.  ``df`` is read once per column: give a
    stored table.
    """
    columns = [df.select(F.lit(name).alias("column_name"), F.col(name).cast("string").alias("value")) for name in names]
    if not columns:
        return df.sparkSession.createDataFrame([], "column_name string, value string, n long")
    cells = reduce(DataFrame.unionByName, columns).filter("value IS NOT NULL")
    return cells.groupBy("column_name", "value").agg(F.count("*").alias("n"))


def column_profile(df: DataFrame, k: int = 3) -> DataFrame:
    """Measured facts per plain column: type, non-null and distinct counts, range, and
    the ``k`` most frequent values, equally frequent ones in order of the value.

    Counts and ranges come from one pass of plain aggregates, values from :func:`value_counts`.
    """
    plain = [f for f in df.schema.fields if not isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType))]
    named = {position: field for position, field in enumerate(plain, 1)}

    def facts_of(position: int, field: T.StructField) -> Column:
        """Aggregates of one column: no cell is copied for them."""
        column, text, number = F.col(field.name), F.col(field.name).cast("string"), isinstance(field.dataType, T.NumericType)
        own, other = (column.cast("double"), F.lit(None).cast("string")) if number else (F.lit(None).cast("double"), text)
        return F.struct(
            F.lit(position).alias("ordinal"), F.lit(field.name).alias("column_name"),
            F.lit(field.dataType.simpleString()).alias("data_type"), F.count("*").alias("row_count"),
            F.count(text).alias("non_null"), F.min(own).alias("min_number"), F.max(own).alias("max_number"),
            F.min(other).alias("min_text"), F.max(other).alias("max_text"),
        )

    every = df.agg(F.array(*(facts_of(i, f) for i, f in named.items())).alias("facts"))
    facts = every.select(F.explode("facts").alias("f")).select("f.*").filter("row_count > 0")
    counts = value_counts(df, [f.name for f in plain])
    distinct = counts.groupBy("column_name").agg(F.count("*").alias("distinct_values"))
    shown = top_n_per_group(counts, ["column_name"], [F.desc("n"), F.col("value")], k, "place")
    ordered = F.sort_array(F.collect_list(F.struct("place", "value")))
    sampled = shown.groupBy("column_name").agg(
        F.array_join(F.transform(ordered, lambda x: x["value"]), ", ").alias("sample_values")
    )
    return (
        facts.join(distinct, "column_name", "left")
        .join(sampled, "column_name", "left")
        .withColumn("distinct_values", F.coalesce("distinct_values", F.lit(0)))
    )
