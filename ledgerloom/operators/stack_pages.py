"""Stacks kept as pages between runs, and read only as deep as a run's spends reach.

The open segments of an address are dealt from the bottom into pages of ``PAGE`` segments.
Two level tables hold them: ``pages`` the segments, by address and page, and ``fences`` for
each page the balance at its top, by address alone, and as page ``HEAD`` the last nonce
the address has used.

A run's lowest balance tells how deep it goes: a segment is touched only if its top lies
above it.  Pages further down are one segment to the run, as high as their balance, that no
spend reaches and that is left out of the results.  Of the pages only those above
are looked up and written again; a last page with room is taken along, so that pages
fill up instead of getting many.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stored
from ..sources.levels import LevelTable
from .lifo import segments
from .ordered import ROWS_PER_CHUNK, row_number, running, running_sum

PAGE = 256
HEAD = -1
KEYS = ("address", "page")

# The segment that stands for all pages further down; nonces of real ones begin at 1.
_BELOW = 0

_FENCE = "address string, page bigint, top bigint, held bigint, nonce int"
_SEGMENT = "address string, nonce int, ots bigint, value bigint"


@dataclass(frozen=True)
class StackTables:
    """Pages and fences as of some run."""

    pages: LevelTable
    fences: LevelTable

    @classmethod
    def of(cls, root: str, pages: str | None, fences: str | None, **settings) -> StackTables:
        """The tables with these listings of segments, empty at first."""
        return cls(
            LevelTable.of(f"{root}/pages", KEYS, pages, **settings),
            LevelTable.of(f"{root}/fences", KEYS, fences, bucket_by=["address"], **settings),
        )

    def with_run(self, pages: DataFrame, fences: DataFrame, run: int) -> StackTables:
        return StackTables(self.pages.with_run(pages, run), self.fences.with_run(fences, run))

    def open_segments(self, spark) -> DataFrame:
        """All open segments of all addresses."""
        rows = self.pages.rows(spark)
        if rows is None:
            return spark.createDataFrame([], _SEGMENT)
        return rows.select("address", F.inline("segments"))


def lowest_balances(net: DataFrame, rows_per_chunk: int = ROWS_PER_CHUNK) -> DataFrame:
    """Per address the lowest balance after any of the changes, counted from the balance before them."""
    sums = running(net, ["address"], ["height", "tx_pos"], {"sum": running_sum("value")}, rows_per_chunk)
    return sums.groupBy("address").agg(F.min("sum").alias("low"))


def depths(fences: DataFrame, lows: DataFrame, page: int = PAGE) -> tuple[DataFrame, DataFrame]:
    """How deep the run goes into each address, and the pages it touches.

    The first has an address a row: the balance ``base`` of the pages left alone (null if
    there are none), the number ``first`` of the first page that is not, and the last ``nonce``.
    """
    tops = fences.where(F.col("page") >= 0)
    ends = tops.groupBy("address").agg(F.max("page").alias("last"), F.max("top").alias("balance"))
    touched = (
        (F.col("top") > F.col("balance") + F.least(F.col("low"), F.lit(0)))
        | (F.col("page") == F.col("last")) & (F.col("held") < page)
    )
    judged = tops.join(ends, "address").join(lows, "address").withColumn("touched", touched)
    below = judged.where(~F.col("touched")).groupBy("address").agg(
        F.max("top").alias("base"), (F.max("page") + 1).alias("first")
    )
    nonces = fences.where(F.col("page") == HEAD).select("address", "nonce")
    found = (
        lows.select("address")
        .join(below, "address", "left")
        .join(nonces, "address", "left")
        .select("address", "base", F.coalesce("first", F.lit(0)).cast("bigint").alias("first"), "nonce")
    )
    return found, judged.where("touched").select("address", "page")


def run_segments(
    net: DataFrame, tables: StackTables, page: int = PAGE, rows_per_chunk: int = ROWS_PER_CHUNK
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The run's segments, as :func:`lifo.segments` gives them, and the changes of ``pages`` and ``fences``.

    Segments of the pages that were read have height -1.  ``net`` should be a written table.
    """
    spark = net.sparkSession
    lows = stored(lowest_balances(net, rows_per_chunk))
    fences = tables.fences.lookup(lows.select("address"))
    if fences is None:
        fences = spark.createDataFrame([], _FENCE)
    depth, touched = map(stored, depths(stored(fences), lows, page))
    read = tables.pages.lookup(touched)
    none = F.lit(None).cast("bigint")
    state = depth.where("nonce is not null").select("address", "nonce", none.alias("ots"), none.alias("value"))
    if read is not None:
        state = state.unionByName(read.select("address", F.inline("segments")))
    below = depth.where("base is not null").select(
        "address", F.lit(_BELOW).alias("nonce"), F.lit(0).cast("bigint").alias("ots"), F.col("base").alias("value")
    )
    state = stored(state.unionByName(below))
    found = stored(segments(net, rows_per_chunk, state).where(f"not (height = -1 and nonce = {_BELOW})"))
    return found, *_written_back(found, depth, touched, page, rows_per_chunk)


def _written_back(
    found: DataFrame, depth: DataFrame, touched: DataFrame, page: int, rows_per_chunk: int
) -> tuple[DataFrame, DataFrame]:
    """Changes of ``pages`` and ``fences`` after a run."""
    still = found.where("closed_ts is null").select("address", "nonce", "ots", "value")
    placed = running(
        still, ["address"], ["nonce"], {"place": row_number(), "level": running_sum("value")}, rows_per_chunk
    )
    # Shuffled by itself, so that Spark can split a hot address of the other side.
    start = depth.select("address", "first", F.coalesce("base", F.lit(0)).cast("bigint").alias("base")).repartition("address")
    new = stored(
        placed.join(start, "address")
        .withColumn("page", F.col("first") + F.expr(f"(place - 1) div {page}"))
        .groupBy("address", "page")
        .agg(
            F.array_sort(F.collect_list(F.struct("nonce", "ots", "value"))).alias("segments"),
            F.max(F.col("level") + F.col("base")).alias("top"),
            F.count(F.lit(1)).alias("held"),
        )
    )
    gone = stored(touched.join(new.select(*KEYS), list(KEYS), "left_anti"))
    used = found.select("address", "nonce").unionByName(depth.where("nonce is not null").select("address", "nonce"))
    heads = used.groupBy("address").agg(F.max("nonce").alias("nonce"))
    live, dead = F.lit(True).alias("live"), F.lit(False).alias("live")
    pages = new.select(*KEYS, "segments", live).unionByName(gone.select(*KEYS, dead), allowMissingColumns=True)
    fences = (
        new.select(*KEYS, "top", "held", live)
        .unionByName(gone.select(*KEYS, dead), allowMissingColumns=True)
        .unionByName(
            heads.select("address", F.lit(HEAD).cast("bigint").alias("page"), "nonce", live), allowMissingColumns=True
        )
    )
    return pages, fences
