"""Readers and writers: delimited text and Parquet, one interchange form for lists."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lumenlink import schema
from lumenlink.functions import text

_CSV = {"header": "true", "quote": '"', "escape": '"', "multiLine": "true", "maxCharsPerColumn": "-1", "encoding": "UTF-8"}


def _header(spark: SparkSession, path: str, sep: str) -> list[str]:
    first = spark.read.options(**_CSV, sep=sep, inferSchema="false").csv(path)
    return first.columns


#: the column that tells a row's place in its files: file, start of the block that was read, place in the partition
PLACE = "place"


def with_place(df: DataFrame, from_files: bool = True) -> DataFrame:
    """Add PLACE to rows that come straight from files (or, else, in the order in which ``df`` has them)."""
    row = F.monotonically_increasing_id().alias("row")
    if from_files:
        return df.select("*", F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), row).alias(PLACE))
    return df.select("*", F.struct(F.lit("").alias("file"), F.lit(0).cast("long").alias("block"), row).alias(PLACE))


def read_delimited(spark: SparkSession, path: str, sep: str = "\t", kinds: T.StructType | None = None, placed: bool = False) -> DataFrame:
    """Columns by the header's names, all strings unless ``kinds`` says otherwise; nothing is inferred. ``placed`` adds PLACE."""
    known = {f.name: f.dataType for f in kinds} if kinds else {}
    made = T.StructType([T.StructField(c, known.get(c, T.StringType())) for c in _header(spark, path, sep)])
    df = spark.read.schema(made).options(**_CSV, sep=sep).csv(path)
    return with_place(df) if placed else df


def read_source(spark: SparkSession, path: str, form: str = "tsv") -> DataFrame:
    """entity_id, business_name, business_address, country as strings without nulls, and place.

    Without a column business_address the column address is taken; other
    missing columns are empty.
    """
    df = with_place(spark.read.parquet(path)) if form == "parquet" else read_delimited(spark, path, "," if form == "csv" else "\t", placed=True)
    return as_source(df)


def as_source(df: DataFrame) -> DataFrame:
    address = "business_address" if "business_address" in df.columns else "address"
    df = df if PLACE in df.columns else with_place(df, from_files=False)

    def col(c: str):
        return text.text(F.col(c)) if c in df.columns else F.lit("")

    return df.select(F.col("entity_id").cast("string").alias("entity_id"), col("business_name").alias("business_name"), col(address).alias("business_address"), col("country").alias("country"), PLACE)


def union_targets(*sources: DataFrame) -> DataFrame:
    """All rows of all target sources with src: 0, 1, ... in their order; equal ids stay apart."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [s.withColumn("src", F.lit(i)) for i, s in enumerate(sources)])


def last_wins(df: DataFrame, key: str, *order: str) -> DataFrame:
    """One row per key: the last in ``order``, then by PLACE if ``df`` has it (without: as ``df`` has its rows)."""
    placed = df if PLACE in df.columns else with_place(df, from_files=False)
    rest = [c for c in df.columns if c != key]
    picked = placed.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(*order, PLACE)).alias("_row"))
    return picked.select(key, *[F.col("_row")[c].alias(c) for c in rest])


def read_candidates(spark: SparkSession, path: str) -> DataFrame:
    """source1_entity_id, candidate_entity_id from a file of lists: of a record's lists the last that is not empty holds."""
    lists = read_delimited(spark, path, placed=True)
    return explode_list(last_wins(lists.where(F.coalesce("candidate_entity_ids", F.lit("")) != ""), "source1_entity_id"), "source1_entity_id", "candidate_entity_ids", "candidate_entity_id")


def read_truth(spark: SparkSession, path: str) -> DataFrame:
    """source1_entity_id, entity_id from a file of lists: a record's last list holds, be it empty; blanks around ids go."""
    lists = last_wins(read_delimited(spark, path, placed=True), "source1_entity_id")
    return explode_list(lists, "source1_entity_id", "matched_entity_ids", "entity_id", trimmed=True)


def explode_list(df: DataFrame, key: str, ids: str, out: str, trimmed: bool = False) -> DataFrame:
    """One row per listed id; empty lists give none. ``trimmed`` takes blanks off ids and drops empty ones."""
    lists = df.where(F.coalesce(F.col(ids), F.lit("")) != "")
    array = text.split_ids(F.col(ids)) if trimmed else F.split(F.col(ids), ",")
    return lists.select(F.col(key), F.explode(array).alias(out))


def collect_ids(df: DataFrame, key: str, value: str, out: str, order: str | None = None, distinct: bool = False) -> DataFrame:
    """One comma list per key: ascending, or in the order of a rank column."""
    if order:
        ids = F.transform(F.sort_array(F.collect_list(F.struct(order, value))), lambda x: x[value])
    else:
        ids = F.sort_array((F.collect_set if distinct else F.collect_list)(value))
    return df.groupBy(key).agg(text.join_ids(ids).alias(out))


def write_delimited(df: DataFrame, path: str, sep: str = "\t") -> None:
    """Write all columns but PLACE; if there is one, files and their rows are in its order (a distributed sort)."""
    df = df.orderBy(PLACE).drop(PLACE) if PLACE in df.columns else df
    df.write.mode("overwrite").options(sep=sep, header="true", quote='"', escape='"').csv(path)


def read_features(spark: SparkSession, path: str, form: str = "csv") -> DataFrame:
    return spark.read.parquet(path) if form == "parquet" else read_delimited(spark, path, ",", schema.FEATURES)


