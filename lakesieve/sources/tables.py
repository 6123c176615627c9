"""Sources and sinks: list, dictionary, paged and JSON tables; append, replace, dead letters.

A path is never overwritten while it is read: replacing writes beside it and then
swaps, by Hadoop's file system of that path.
"""

from __future__ import annotations

import tempfile
import uuid
from functools import reduce
from urllib.parse import quote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def work_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors see; a temporary one in local mode only, where both are one process."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return (base or "file://" + tempfile.gettempdir()).rstrip("/")


def settled(df: DataFrame) -> DataFrame:
    """df written to the checkpoint folder and read again: what follows plans from there."""
    path = f"{work_dir(df.sparkSession)}/settled-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_list(spark: SparkSession, path: str) -> DataFrame:
    """The first column of a headerless CSV, as text, without nulls."""
    df = spark.read.csv(path)
    return df.select(F.col(df.columns[0]).cast("string").alias("value")).na.drop()


def read_words(spark: SparkSession, path: str, stop: tuple[str, ...] = ()) -> DataFrame:
    """Normalised single words of a list, without stop-words, each once."""
    from lakesieve.functions.text import norm_txt

    words = read_list(spark, path).select(norm_txt(F.col("value")).alias("value"))
    return words.where(~F.col("value").contains(" ") & (F.col("value") != "") & ~F.col("value").isin(*stop)).distinct() if stop else words.where(~F.col("value").contains(" ") & (F.col("value") != "")).distinct()


def read_pages(spark: SparkSession, paths: list[str], page_col: str = "pagina") -> DataFrame:
    """Paged CSV exports as one table; the page's number is its place in the list."""
    pages = [spark.read.csv(p, header=True).withColumn(page_col, F.lit(i)) for i, p in enumerate(paths, 1)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), pages)


def read_dead_letters(spark: SparkSession, path: str) -> DataFrame:
    """Rejected appends: ts, sheet, rows, reason; unreadable lines are left out."""
    return spark.read.schema("ts string, sheet string, rows array<array<string>>, reason string").option("mode", "DROPMALFORMED").json(path).where("sheet is not null")


def write_dead_letters(rows: DataFrame, path: str) -> None:
    """Appends; reasons are cut to 500 characters."""
    rows.withColumn("reason", F.substring("reason", 1, 500)).write.mode("append").json(path)


def replay(letters: DataFrame, accepts: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows to append, letters that stay)."""
    ok = F.lit(True) if accepts is None else F.coalesce(accepts, F.lit(False))
    return letters.where(ok).select("sheet", F.posexplode("rows").alias("n", "row")), letters.where(~ok)


def last_result(spark: SparkSession, path: str, mark: str = "RESULT_JSON=") -> DataFrame:
    """The last line of a log that holds a result, without its mark."""
    lines = spark.read.text(path).withColumn("n", F.monotonically_increasing_id())
    return lines.where(F.col("value").startswith(mark)).agg(F.max_by(F.substring("value", len(mark) + 1, 1 << 30), "n").alias("payload")).where("payload is not null")


def create(spark: SparkSession, name: str, columns: str) -> None:
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet")


def _files(spark: SparkSession, path: str):
    """(Hadoop's file system of a path, a maker of its paths)."""
    make = spark._jvm.org.apache.hadoop.fs.Path
    return make(path).getFileSystem(spark._jsc.hadoopConfiguration()), make


def swap(df: DataFrame, path: str) -> None:
    """Writes df, which may read path, beside path and puts it in its place; what was there goes last.

    If the new table can't be put there, the old one is put back.
    """
    fs, make = _files(df.sparkSession, path)
    at, new, old = make(path), make(f"{path}.next"), make(f"{path}.before")
    df.write.mode("overwrite").parquet(f"{path}.next")
    fs.delete(old, True)
    there = fs.exists(at)
    if there and not fs.rename(at, old):
        raise OSError(f"can't move {path} aside")
    if not fs.rename(new, at):
        if there:
            fs.rename(old, at)
        raise OSError(f"can't put {path}.next in the place of {path}")
    fs.delete(old, True)


def append_chunks(rows: DataFrame, path: str, order: str, accepts: Column | None = None, chunk: int = 150, letters: str | None = None, sheet: str = "") -> DataFrame:
    """Appends rows in chunks of `chunk` by order; a chunk with a row that isn't accepted goes to the dead letters as a whole.

    Returns one row: ok and failed, rows of each kind. The chunks are numbered within
    ranges of the order, so that no task holds them all.
    """
    ok = F.lit(True) if accepts is None else F.coalesce(accepts, F.lit(False))
    by = W.partitionBy("_part").orderBy(order)
    dealt = settled(rows.withColumn("_ok", ok).repartitionByRange(order).withColumn("_part", F.spark_partition_id()))
    chunks = dealt.withColumn("_chunk", F.floor((F.row_number().over(by) - 1) / chunk))
    chunks = settled(chunks.withColumn("_good", F.min("_ok").over(W.partitionBy("_part", "_chunk"))))
    chunks.where("_good").select(*rows.columns).write.mode("append").parquet(path)
    bad = chunks.where("not _good")
    if letters is not None:
        cells = F.array(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in rows.columns])
        listed = F.transform(F.sort_array(F.collect_list(F.struct(F.col(order).alias("o"), cells.alias("c")))), lambda x: x["c"])
        packed = bad.groupBy("_part", "_chunk").agg(listed.alias("rows"))
        now = F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss")
        write_dead_letters(packed.select(now.alias("ts"), F.lit(sheet).alias("sheet"), "rows", F.lit("rejected").alias("reason")), letters)
    return chunks.agg(F.count_if("_good").alias("ok"), F.count_if(~F.col("_good")).alias("failed"))


def write_sorted(df: DataFrame, path: str, *keys: str) -> None:
    """Replaces a table with df in the order of keys, over all its files."""
    swap(df.orderBy(*keys), path)


def read_config(spark: SparkSession, schema: str, sheet: DataFrame | None, path: str | None, default: list[tuple], multi_line: bool = False) -> DataFrame:
    """A configuration from the first source that has rows: a table, a JSON file (an object a line, or one over many), the default."""
    if sheet is not None and not sheet.isEmpty():
        return sheet
    if path is not None:
        fs, make = _files(spark, path)
        if fs.exists(make(path)):
            found = spark.read.schema(schema).option("multiLine", multi_line).json(path)
            if not found.isEmpty():
                return found
    return spark.createDataFrame(default, schema)


def save_state(state: DataFrame, path: str) -> None:
    """Run states as JSON, by job; what was there is replaced."""
    fs, make = _files(state.sparkSession, path)
    state.orderBy("job_name").write.mode("overwrite").json(f"{path}.next")
    fs.delete(make(path), True)
    if not fs.rename(make(f"{path}.next"), make(path)):
        raise OSError(f"can't put {path}.next in the place of {path}")


def columns_of(df: DataFrame) -> DataFrame:
    """(name, type, nullable) of a table's columns."""
    return df.sparkSession.createDataFrame([(f.name, f.dataType.simpleString(), f.nullable) for f in df.schema], "name string, type string, nullable boolean")


def read_ranges(spark: SparkSession, paths: dict[str, str], schema: str) -> dict[str, DataFrame]:
    """Several tables by name; one that isn't there is empty."""
    def one(path: str) -> DataFrame:
        fs, make = _files(spark, path)
        return spark.read.schema(schema).parquet(path) if fs.exists(make(path)) else spark.createDataFrame([], schema)

    return {name: one(path) for name, path in paths.items()}


def pick_columns(df: DataFrame, *columns: str) -> DataFrame:
    """Some columns, rows with a null among them left out."""
    return df.select(*columns).na.drop()


def newest(files: DataFrame) -> DataFrame:
    """The file (path, modificationTime) that was changed last; of equal ones the last by path."""
    return files.agg(F.max_by("path", F.struct("modificationTime", "path")).alias("path")).where("path is not null")


def upsert_table(new: DataFrame, path: str, key: str) -> None:
    """Upsert by key into the parquet table at path; the first batch makes it."""
    from lakesieve.operators.joins import upsert

    spark = new.sparkSession
    fs, make = _files(spark, path)
    swap(upsert(spark.read.parquet(path), new, key) if fs.exists(make(path)) else new, path)


def keep_latest(new: DataFrame, path: str, key: str, order: list[str], parts: int = 16) -> None:
    """The last row of each key by order, of the table at path and of new; an older row that comes late changes nothing.

    The table has a folder for each of `parts` shares of the keys; only those that new
    touches are written again.
    """
    spark = new.sparkSession
    fs, make = _files(spark, path)
    share = F.expr(f"pmod(xxhash64({key}), {parts})").cast("int")
    new = settled(new.withColumn("_share", share))
    if fs.exists(make(path)):
        touched = [r[0] for r in new.select("_share").distinct().collect()]  # `parts` numbers at most
        held = spark.read.parquet(path).where(F.col("_share").isin(touched)).select(*new.columns)
        new = held.unionByName(new)
    fields = [c for c in new.columns if c not in (key, "_share")]
    last = new.groupBy("_share", key).agg(F.max_by(F.struct(*fields), F.struct(*order)).alias("r")).select(key, "r.*", "_share")
    last = settled(last)
    last.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_share").parquet(path)


def replace_key(new: DataFrame, path: str, key: str, values: list | None = None) -> None:
    """Replaces the partitions of key that new has rows of; those of `values` that it has none of go."""
    new = settled(new)
    new.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(key).parquet(path)
    fs, make = _files(new.sparkSession, path)
    left = {str(v) for v in values or []} - {str(r[0]) for r in new.select(key).where(F.col(key).isin(values or [])).distinct().collect()}
    for v in sorted(left):
        fs.delete(make(f"{path}/{key}={quote(v, safe=' ')}"), True)


def export(df: DataFrame, path: str) -> None:
    """One CSV with a header, for people: the result must be small."""
    df.coalesce(1).write.mode("overwrite").csv(path, header=True)
