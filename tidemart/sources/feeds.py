"""Change events, app logs and tables as DataFrames, from batch files or streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from tidemart import schemas
from tidemart.functions.dates import at_millis


# -- where messages come from ---------------------------------------------------------

def kafka_messages(spark: SparkSession, servers: str, topic: str, starting: str = "earliest",
                   stream: bool = True) -> DataFrame:
    """A topic as ``value`` text.  Needs the Spark Kafka package on the class path."""
    reader = spark.readStream if stream else spark.read
    return (reader.format("kafka").option("kafka.bootstrap.servers", servers)
            .option("subscribe", topic).option("startingOffsets", starting).load()
            .select(F.col("value").cast("string").alias("value")))


def text_messages(spark: SparkSession, path: str, stream: bool = False,
                  files_per_trigger: int | None = None) -> DataFrame:
    """Lines of the files in a folder as ``value``; a stream takes files that are whole when they appear (growing ones:
    ``tail.tailed_messages``)."""
    if not stream:
        return spark.read.text(path)
    reader = spark.readStream.format("text")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


def stored_table(spark: SparkSession, path: str, schema: T.StructType | None = None,
                 stream: bool = False, files_per_trigger: int | None = None) -> DataFrame:
    """A fact or dimension written earlier; a stream needs its schema."""
    reader = spark.readStream if stream else spark.read
    if schema is not None:
        reader = reader.schema(schema)
    if stream and files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def jdbc_snapshot(spark: SparkSession, url: str, table: str, partition_column: str, lower: int, upper: int,
                  partitions: int, **options: str) -> DataFrame:
    """A database table read in parallel ranges of ``partition_column``."""
    return (spark.read.format("jdbc").options(url=url, dbtable=table, partitionColumn=partition_column,
                                              lowerBound=lower, upperBound=upper,
                                              numPartitions=partitions, **options).load())


# -- decoding -------------------------------------------------------------------------

def decode_messages(df: DataFrame, value: str = "value") -> DataFrame:
    """Bytes to text; empty records (tombstones) pass as null."""
    return df.withColumn(value, F.col(value).cast("string"))


def drop_tombstones(df: DataFrame, value: str = "value") -> DataFrame:
    return df.filter(F.col(value).isNotNull())


def _parsed(value: str, schema: T.StructType, mode: str) -> Column:
    """A message's fields as columns.

    ``inline`` keeps the parser in one place: were the fields read off a struct column, filters
    on them would be pushed below it and parse every message once more.
    """
    options = {"mode": mode}
    if mode == "PERMISSIVE":
        options["columnNameOfCorruptRecord"] = schema.fields[-1].name
    return F.inline(F.array(F.from_json(value, schema, options)))


def parse_json(df: DataFrame, schema: T.StructType, value: str = "value") -> DataFrame:
    """Strict parse: a malformed message fails the job."""
    return df.select(_parsed(value, schema, "FAILFAST"))


def split_dirty(df: DataFrame, schema: T.StructType, value: str = "value") -> tuple[DataFrame, DataFrame]:
    """Lenient parse: (parsed rows, raw text of the rows that are not valid JSON)."""
    with_corrupt = T.StructType(schema.fields + [T.StructField("_corrupt", T.StringType())])
    parsed = df.select(_parsed(value, with_corrupt, "PERMISSIVE"))
    bad = F.col("_corrupt").isNotNull()
    return parsed.filter(~bad).drop("_corrupt"), parsed.filter(bad).select(F.col("_corrupt").alias("dirty"))


def with_event_time(df: DataFrame, ts_ms: str = "ts_ms", delay: str = "3 seconds") -> DataFrame:
    """Add event time ``et``; on a stream also its watermark (zero delay = monotonic)."""
    df = df.withColumn("et", at_millis(F.col(ts_ms)))
    return df.withWatermark("et", delay) if df.isStreaming else df


def change_events(messages: DataFrame, value: str = "value", delay: str = "3 seconds") -> DataFrame:
    """Messages to change events with processing time ``pt`` and event time ``et``."""
    events = parse_json(drop_tombstones(messages, value), schemas.CHANGE_EVENT, value)
    return with_event_time(events.withColumn("pt", F.current_timestamp()), "ts_ms", delay)


def page_log(messages: DataFrame, value: str = "value") -> DataFrame:
    """Page log with map columns and a zero-delay watermark on ``et``."""
    return with_event_time(parse_json(messages, schemas.PAGE_LOG_MAPS, value), "ts", "0 seconds")


def app_log(messages: DataFrame, value: str = "value") -> tuple[DataFrame, DataFrame]:
    return split_dirty(drop_tombstones(messages, value), schemas.APP_LOG, value)


def visit_log(messages: DataFrame, value: str = "value") -> DataFrame:
    """Device, visitor flag and time of the valid log lines, without parsing the rest of them into columns."""
    return split_dirty(drop_tombstones(messages, value), schemas.VISIT_LOG, value)[0]


# -- tables as change events ----------------------------------------------------------

def text_map(columns: dict[str, str]) -> str:
    """SQL for a map of texts, the shape of a row in a feed that mixes tables."""
    return "map(" + ", ".join(f"'{name}', cast({sql} as string)" for name, sql in columns.items()) + ")"


def typed_row(columns: dict[str, str]) -> str:
    """SQL for a struct, the shape of a row in a feed of one table."""
    return "named_struct(" + ", ".join(f"'{name}', {sql}" for name, sql in columns.items()) + ")"


def as_change_events(df: DataFrame, db: str, table: str, op: str, ts_ms: str, after: dict[str, str] | None,
                     before: dict[str, str] | None = None, before_when: str | None = None,
                     row=typed_row) -> DataFrame:
    """Wrap table rows in the change envelope; columns, ``op`` and ``ts_ms`` are SQL texts."""
    def side(columns, condition=None):
        if columns is None:
            return "cast(null as map<string,string>)"
        return f"case when {condition} then {row(columns)} end" if condition else row(columns)

    return df.selectExpr(f"{side(before, before_when)} as before", f"{side(after)} as after",
                         f"map('db', '{db}', 'table', '{table}', 'server_id', '1') as source",
                         f"{op} as op", f"cast({ts_ms} as bigint) as ts_ms")


def snapshot_events(df: DataFrame, db: str, table: str, ts_ms: str, row=typed_row) -> DataFrame:
    """A one-time table read as events of kind ``r``."""
    return as_change_events(df, db, table, "'r'", ts_ms, {c: f"`{c}`" for c in df.columns}, row=row)


def by_table(events: DataFrame, schemas_: dict[str, T.StructType], value: str = "value") -> dict[str, DataFrame]:
    """JSON messages of a mixed feed as one typed feed per table.

    Each table's rows are parsed straight into its columns: no text maps, and only the columns
    named in its schema are kept.
    """
    feeds = {}
    for table, row in schemas_.items():
        envelope = T.StructType([T.StructField("before", row), T.StructField("after", row),
                                 *schemas.CHANGE_EVENT.fields[2:]])
        mine = events.filter(F.get_json_object(value, "$.source.table") == table)
        feeds[table] = parse_json(mine, envelope, value)
    return feeds


def config_rows(events: DataFrame, columns: list[str]) -> DataFrame:
    """Typed configuration rows from their change feed; a delete carries its old row."""
    row = F.when(F.col("op") == "d", F.col("before")).otherwise(F.col("after"))
    return events.select(*[row[c].alias(c) for c in columns], "op", "ts_ms")


def dictionary(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).select("dic_code", "dic_name")


def word_list(spark: SparkSession, path: str) -> DataFrame:
    """One word per line, blanks and repeats removed."""
    return clean_words(spark.read.text(path).select(F.col("value").alias("word")))


def clean_words(df: DataFrame) -> DataFrame:
    return df.select(F.trim("word").alias("word")).filter("word <> ''").distinct()


def save_words(df: DataFrame, path: str) -> None:
    clean_words(df).write.mode("overwrite").parquet(path)
