"""Sharding along a Hilbert curve.

Several metadata dimensions are quantised to a grid, the grid cells are put in
the order of the Hilbert curve, rows are sorted by that order and the sorted
run is cut into shards of equal row counts. Rows that are close in all
dimensions thus share shards, so per-shard minima and maxima prune files on any
of the dimensions.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

BITS = 6


def hilbert_index(coords: np.ndarray, bits: int) -> np.ndarray:
    """Curve index (uint64) of each column of ``coords`` (dimensions x points, 0 <= c < 2**bits).

    Skilling's transform: undo the excess work of the Gray code per bit plane,
    then interleave the bits. dimensions * bits must be 63 at most.
    """
    x = coords.astype(np.uint64).copy()
    n = x.shape[0]
    if n * bits > 63:
        raise ValueError("dimensions * bits must be at most 63")
    one = np.uint64(1)
    for q in (1 << b for b in range(bits - 1, 0, -1)):
        p = np.uint64(q - 1)
        for i in range(n):
            high = (x[i] & np.uint64(q)) != 0
            t = np.where(high, np.uint64(0), (x[0] ^ x[i]) & p)
            x[0] = np.where(high, x[0] ^ p, x[0] ^ t)
            x[i] ^= t
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    for q in (1 << b for b in range(bits - 1, 0, -1)):
        t = np.where((x[n - 1] & np.uint64(q)) != 0, t ^ np.uint64(q - 1), t)
    x ^= t
    out = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            out = (out << one) | ((x[i] >> np.uint64(b)) & one)
    return out


def log_cells(size: Column, bits: int) -> Column:
    """Quantise a non-negative number on a log scale: about 4 cells per doubling, the last cell is open."""
    return F.least(F.lit((1 << bits) - 1), F.floor(F.log2(F.greatest(size, F.lit(1)).cast("double")) * 2.5)).cast("int")


def name_cells(name: Column, bits: int) -> Column:
    """Quantise a category by hash; null is a category of its own."""
    return F.pmod(F.xxhash64(F.coalesce(name, F.lit("\x00"))), F.lit(1 << bits)).cast("int")


_TABLE_BITS = 18  # a curve table of at most 2**18 cells goes to every task


def curve_index(cells: DataFrame, dims: list[Column], bits: int = BITS) -> DataFrame:
    """The columns of ``cells`` in a struct ``row``, its grid cell ``_cell`` and the cell's place ``curve`` on the Hilbert curve.

    The curve is computed once per cell that occurs, so rows (with whole texts,
    it may be) do not pass through Python.
    """
    top, n = (1 << bits) - 1, len(dims)
    cell = F.array(*[F.coalesce(F.least(F.greatest(d.cast("int"), F.lit(0)), F.lit(top)), F.lit(0)) for d in dims])
    rows = cells.select(F.struct(*[F.col(f"`{c}`") for c in cells.columns]).alias("row"), cell.alias("_cell"))

    def curve_of(batch):
        coords = np.array(batch.column("_cell").to_pylist(), np.int64).reshape(-1, n).T
        return {"_cell": batch.column("_cell"), "curve": hilbert_index(coords, bits).astype(np.int64)}

    table = common.map_arrow(rows.select("_cell").distinct(), curve_of, "_cell array<int>, curve long", rows=8192)
    return rows.join(F.broadcast(table) if n * bits <= _TABLE_BITS else table, "_cell")


def assign_shards(cells: DataFrame, dims: list[Column], ties: list[Column], n_shards: int, bits: int = BITS) -> DataFrame:
    """``row`` (a struct of all columns of ``cells``), ``curve``, ``shard`` (0 .. n_shards - 1) and ``slot`` (gapless from 0 in each shard).

    ``dims`` are integer expressions in 0 .. 2**bits - 1 (null counts as 0,
    values beyond as the nearest); rows are sorted by (curve, ties) and cut so
    that row counts of shards differ by one at most. Rows alike in all of these
    are dealt in any order, each to a slot of its own. An empty input gives an
    empty output; the columns' names do not matter, as they are in the struct.
    Only one count per partition reaches the driver. Shards lie one after
    another in the written run, so writing them needs no further shuffle.
    """
    spark = cells.sparkSession
    curved = curve_index(cells, dims, bits)
    keys = [F.col("curve"), *ties]
    n_parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    # the sorted run, with its partition and place in it fixed by being written
    run = curved.select("row", "curve").repartitionByRange(n_parts, *keys).sortWithinPartitions(*keys).withColumn("_at", F.monotonically_increasing_id())
    run = common.materialize(run, "run")
    part = F.shiftright("_at", 33).cast("int")
    counts = sorted((r["p"], r["n"]) for r in run.groupBy(part.alias("p")).agg(F.count("*").alias("n")).collect())
    start, starts = 0, {}
    for p, n in counts:
        starts[p] = start
        start += n
    offsets = F.broadcast(spark.createDataFrame([(p, s) for p, s in starts.items()] or [(0, 0)], "_p int, _start long"))  # a row per partition
    ranked = run.withColumn("_p", part).join(offsets, "_p").withColumn("_rank", F.col("_start") + F.col("_at").bitwiseAND((1 << 33) - 1))
    small, extra = divmod(start, n_shards)  # the first `extra` shards hold one row more
    cut = extra * (small + 1)
    shard = F.when(F.col("_rank") < cut, F.expr(f"_rank div {small + 1}")).otherwise(F.expr(f"{extra} + (_rank - {cut}) div {max(1, small)}"))
    slot = F.when(F.col("_rank") < cut, F.expr(f"_rank % {small + 1}")).otherwise(F.expr(f"(_rank - {cut}) % {max(1, small)}"))
    return ranked.select("row", "curve", shard.cast("int").alias("shard"), slot.cast("long").alias("slot"))


def _dims(row: str = "") -> list[Column]:
    """lang, source and size of rows of ``documents`` (in the struct ``row``) as grid coordinates."""
    return [name_cells(F.col(row + "lang").cast("string"), BITS), name_cells(F.col(row + "source").cast("string"), BITS), log_cells(text_size(row), BITS)]


def text_size(row: str = "") -> Column:
    return (F.octet_length(F.coalesce(F.col(row + "text").cast("string"), F.lit(""))) + 16).cast("long")


def text_crc(row: str = "") -> Column:
    return F.crc32(F.coalesce(F.col(row + "text").cast("string"), F.lit("")).cast("binary")).cast("long")


def shard_documents(docs: DataFrame, n_shards: int = 40) -> DataFrame:
    """doc_id, lang, source, size, text_crc32, curve, shard and slot of every row of ``documents``; texts are measured, not kept.

    Null texts have no bytes, null lang and source are categories of their own,
    a null doc_id sorts first. Other columns are not looked at.
    """
    base = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("lang").cast("string").alias("lang"),
        F.col("source").cast("string").alias("source"),
        text_size().alias("size"),
        text_crc().alias("text_crc32"),
    )
    dims = [name_cells(F.col("lang"), BITS), name_cells(F.col("source"), BITS), log_cells(F.col("size"), BITS)]
    out = assign_shards(base, dims, [F.col("row.doc_id"), F.col("row.text_crc32")], n_shards)
    return out.select("row.*", "curve", "shard", "slot")


def manifest(sharded: DataFrame, columns: list[str]) -> DataFrame:
    """Rows and the least and greatest value of each column per shard: what a reader prunes files by.

    Nulls do not count as values; a column of nulls only has null bounds; no
    rows give no shards.
    """
    aggs = [F.count("*").alias("rows")]
    for c in columns:
        aggs += [F.min(c).alias(f"min_{c}"), F.max(c).alias(f"max_{c}")]
    return sharded.groupBy("shard").agg(*aggs)


def write_shards(docs: DataFrame, path: str, n_shards: int = 40) -> tuple[str, str]:
    """Write the whole rows of ``docs`` as one folder per shard, sorted by slot; returns the names of the shard and slot columns.

    These are shard and slot, with underscores behind them where ``docs`` has
    such columns. Every row is written once: rows alike get slots of their own,
    an empty table gives an empty folder. Rows go through one shuffle, with
    their texts, and shards are cut from the sorted run as it lies.
    """
    shard, slot = "shard", "slot"
    while shard in docs.columns:
        shard += "_"
    while slot in docs.columns:
        slot += "_"
    placed = assign_shards(docs, _dims(), [F.col("row.doc_id").cast("long"), text_crc("row.")], n_shards)
    placed.select("row.*", F.col("shard").alias(shard), F.col("slot").alias(slot)).write.partitionBy(shard).parquet(path)
    return shard, slot
