"""Requests, schedules and run states, as batch expressions and as streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

# Priorities, and the names of days in both languages of the schedules.
URGENT, RESUMED, MANUAL, CRON = 0, 5, 10, 50
DAYS = {"lunes": "mon", "martes": "tue", "miercoles": "wed", "jueves": "thu", "viernes": "fri", "sabado": "sat", "domingo": "sun", "mon": "mon", "tue": "tue", "wed": "wed", "thu": "thu", "fri": "fri", "sat": "sat", "sun": "sun"}


def queue(requests: DataFrame, first: int = 12) -> DataFrame:
    """The first requests by priority and order of arrival; place, and how many wait behind the last shown."""
    ordered = requests.orderBy("priority", "seq").limit(first)
    shown = ordered.withColumn("place", F.row_number().over(W.orderBy("priority", "seq")))
    total = requests.agg(F.count("*").alias("total"))
    return shown.crossJoin(F.broadcast(total)).withColumn("behind", F.greatest(F.col("total") - first, F.lit(0).cast("long"))).drop("total")


def latest(df: DataFrame, key: str, order: list[str], fields: list[str]) -> DataFrame:
    """The last record of each key."""
    return df.groupBy(key).agg(F.max_by(F.struct(*fields), F.struct(*order)).alias("r")).select(key, "r.*")


def parse_days(c: Column) -> Column:
    names = F.create_map(*[F.lit(x) for kv in DAYS.items() for x in kv])
    from lakesieve.functions.text import unaccent

    parts = F.transform(F.split(unaccent(F.lower(F.coalesce(c, F.lit("")))), r"[\s,;/]+"), lambda d: F.try_element_at(names, d))
    return F.array_distinct(F.filter(parts, lambda d: d.isNotNull()))


def parse_times(c: Column) -> Column:
    """HH:MM, padded; what is no time of day is left out."""
    parts = F.filter(F.split(F.coalesce(c, F.lit("")), r"[\s,;/]+"), lambda t: t.rlike(r"^([01]?\d|2[0-3]):[0-5]\d$"))
    return F.array_distinct(F.transform(parts, lambda t: F.lpad(t, 5, "0")))


def active_jobs(rows: DataFrame) -> DataFrame:
    """Jobs of a configuration (name, python, script, days, times, enabled) that can run: name, python, script, days, times.

    Those that are switched off, lack a field, or have days without times or times
    without days are left out; without both a job runs on request only.
    """
    bare = lambda c: F.btrim(F.coalesce(F.col(c), F.lit("")), F.lit("\"' \t"))
    on = ~F.lower(F.trim(F.coalesce("enabled", F.lit("")))).isin("no", "false", "0")
    out = rows.where(on).select(F.trim(F.coalesce("name", F.lit(""))).alias("name"), bare("python").alias("python"), bare("script").alias("script"), parse_days(F.col("days")).alias("days"), parse_times(F.col("times")).alias("times"))
    return out.where("name <> '' and python <> '' and script <> '' and (size(days) > 0) = (size(times) > 0)")


def changed(config: DataFrame, before: str | None) -> tuple[bool, str]:
    """Whether a configuration differs from the one with that signature, and its own signature, whatever the rows' order."""
    row = F.xxhash64(*[F.to_json(F.struct(*config.columns))]).cast("decimal(38,0)")
    got = config.agg(F.count("*").alias("n"), F.sum(row).alias("h")).first()
    mark = f"{got['n']}:{got['h']}"
    return mark != before, mark


def slots(jobs: DataFrame, start: str, end: str) -> DataFrame:
    """(job, slot) for jobs (job, days, times) from start to end, days included."""
    day = F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date")))
    days = jobs.select("job", "days", "times", day.alias("day")).where(F.array_contains("days", F.lower(F.date_format("day", "E"))))
    return days.select("job", F.explode("times").alias("at"), "day").select("job", F.to_timestamp_ntz(F.concat(F.col("day").cast("string"), F.lit(" "), "at"), F.lit("yyyy-MM-dd HH:mm")).alias("slot"))


def due(slots_: DataFrame, ran: DataFrame, now: Column, within_s: int = 180) -> DataFrame:
    """Slots of the last seconds that have not run."""
    age = F.unix_seconds(now.cast("timestamp")) - F.unix_seconds(F.col("slot").cast("timestamp"))
    return slots_.where((age >= 0) & (age <= within_s)).join(ran.select("job", "slot"), ["job", "slot"], "left_anti")


def overdue(duration: Column, limit: Column, default: float = 4200.0) -> Column:
    return duration >= F.coalesce(limit, F.lit(default))


def counted_by_status(spark: SparkSession, folder: str, schema: str, sink: str, checkpoint: str) -> None:
    """Requests from a folder of files, what is there by now; the sink has each id's latest state, whenever it came."""
    from lakesieve.sources.tables import keep_latest

    def save(batch: DataFrame, _: int) -> None:
        keep_latest(batch.select("id", "job", "status", "priority", "requested_at", "seq"), sink, "id", ["requested_at", "seq"])

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 4).parquet(folder)
    stream.writeStream.foreachBatch(save).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def windowed(stream: DataFrame, every: str = "1 hour", late: str = "6 hours") -> DataFrame:
    """Requests a job and window, late ones up to the watermark; for batches and streams."""
    return stream.withWatermark("requested_at", late).groupBy("job", F.window("requested_at", every).alias("w")).agg(F.count("*").alias("n")).select("job", F.col("w.start").alias("start"), "n")


def once(stream: DataFrame, key: str, late: str = "1 hour") -> DataFrame:
    """Each slot once within the watermark."""
    return stream.withWatermark("requested_at", late).dropDuplicatesWithinWatermark([key])
