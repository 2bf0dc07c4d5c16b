"""Keyed tables that grow by runs and are read only where their keys were hit.

A run adds a segment of changed rows: rows to put, and tombstones (``live`` false) for keys
to take away.  Segments are listed from old to new and the latest row of a key holds.  A
segment has a level, the least at which ``rows_per_bucket`` rows fill each of its
``fan ** level`` buckets; its rows lie in one folder per bucket of their key's hash,
so buckets stay of one size however large a segment gets.  Beside them lies a filter: for
each bucket bitmaps with a bit set for each key's hash, ``_BITS_PER_ROW`` bits a row,
ordered by bucket.

A look-up reads of the filters what concerns its keys' buckets, and then only the buckets
in which a bit of one of its keys is set.  So a run that hits few keys reads little, however
large the table has grown, and keys that are new are not looked for on disk at all.

Segments are merged by level: when ``fan`` segments in a row are of one level they become
one, so a row is written again once per level.  A tombstone goes when nothing older is
left that it could hide.  Merged segments are new files: the list of segments that a run
commits is the table, and what a broken run left behind is in no list.

What the driver holds is bounded by the layout: the list of segments, at most ``fan`` a
level, and the buckets hit, at most ``fan ** max_level`` a segment.
"""

from __future__ import annotations

import json
from collections.abc import Iterable
from dataclasses import asdict, dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import CODEC

ROWS_PER_BUCKET = 65_536
FAN = 8
MAX_LEVEL = 5
_BITS = 32_768  # of one of Spark's bitmaps
_BITS_PER_ROW = 8
# Of the bitmap of wanted keys that is sent to all tasks, 16 MB.
_WANTED_BITS = 1 << 27


@dataclass(frozen=True)
class Segment:
    """Where a segment lies, its level and its number of rows."""

    path: str
    level: int
    rows: int


def _read_rows(spark: SparkSession, folders: list[str]) -> DataFrame:
    """The rows in all files below the folders, whatever their buckets."""
    return spark.read.option("recursiveFileLookup", "true").parquet(*folders)


@dataclass(frozen=True)
class LevelTable:
    """A table as of some run; :meth:`with_run` gives the one after the next run."""

    root: str
    keys: tuple[str, ...]
    bucket_by: tuple[str, ...]
    segments: tuple[Segment, ...] = ()
    rows_per_bucket: int = ROWS_PER_BUCKET
    fan: int = FAN
    max_level: int = MAX_LEVEL

    @classmethod
    def of(cls, root: str, keys: Iterable[str], listed: str | None, **settings) -> LevelTable:
        """The table with the segments that :meth:`listing` gave, none at first."""
        keys = tuple(keys)
        settings.setdefault("bucket_by", keys)
        segments = tuple(Segment(**s) for s in json.loads(listed or "[]"))
        return cls(root, keys, tuple(settings.pop("bucket_by")), segments, **settings)

    def listing(self) -> str:
        return json.dumps([asdict(s) for s in self.segments])

    def rows(self, spark: SparkSession) -> DataFrame | None:
        """All rows that hold now."""
        if not self.segments:
            return None
        return self._held(_read_rows(spark, [f"{s.path}/rows" for s in self.segments]))

    def lookup(self, wanted: DataFrame) -> DataFrame | None:
        """The rows that hold now for the keys in ``wanted``, columns ``bucket_by``; ``None`` of an empty table."""
        if not self.segments:
            return None
        spark = wanted.sparkSession
        names = list(self.bucket_by)
        hit = self.buckets_hit(wanted)
        if not hit:
            return self.rows(spark).limit(0)
        paths = [f"{self.segments[k].path}/rows/bucket={b}" for k, b in hit]
        asked = wanted.select(*[F.col(c).alias(f"_{c}") for c in names]).distinct()
        rows = self._maybe_wanted(_read_rows(spark, paths), wanted)
        same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in names]
        # An inner join: a semi join would be moved below that with the bitmap.
        return self._held(rows.join(asked, same).select(*rows.columns))

    def _maybe_wanted(self, rows: DataFrame, wanted: DataFrame) -> DataFrame:
        """The rows without those whose keys surely are not wanted.

        A bitmap of hashes of fixed size is sent to all tasks; it spares the others the shuffle of a join.
        """
        place = F.pmod(F.xxhash64(F.lit(2), *self.bucket_by), F.lit(_WANTED_BITS))
        bucket, at = F.bitmap_bucket_number(place), F.bitmap_bit_position(place)
        bits = wanted.select(bucket.alias("_part"), at.alias("_at")).groupBy("_part").agg(
            F.bitmap_construct_agg("_at").alias("_bits")
        )
        byte = F.conv(F.hex(F.substring("_bits", F.expr("cast(_at div 8 as int) + 1"), F.lit(1))), 16, 10).cast("int")
        marked = rows.withColumns({"_part": bucket, "_at": at}).join(F.broadcast(bits), "_part").withColumn("_byte", byte)
        return marked.where(F.expr("shiftright(_byte, cast(_at % 8 as int)) & 1") == 1).select(*rows.columns)

    def buckets_hit(self, wanted: DataFrame) -> list[tuple[int, int]]:
        """Number of segment and bucket, wherever a filter has one of the wanted keys."""
        spark = wanted.sparkSession
        levels = sorted({s.level for s in self.segments})
        places = F.array(
            *[F.struct(F.lit(level).alias("level"), self._bucket(level).alias("bucket")) for level in levels]
        )
        bits, at = self._filter_bit()
        asked = wanted.select(F.explode(places).alias("p"), bits.alias("part"), at.alias("at")).select("p.*", "part", "at")
        asked = asked.distinct()
        filters = spark.read.parquet(*[f"{s.path}/filter" for s in self.segments])
        byte = F.conv(F.hex(F.substring("bits", F.expr("cast(at div 8 as int) + 1"), F.lit(1))), 16, 10).cast("int")
        hit = F.expr("shiftright(byte, cast(at % 8 as int)) & 1") == 1
        found = (
            filters.join(asked, ["level", "bucket", "part"])
            .withColumn("byte", byte)
            .where(hit)
            .select("segment", "bucket")
            .distinct()
            .collect()
        )
        number = {s.path: k for k, s in enumerate(self.segments)}
        return sorted((number[r["segment"]], r["bucket"]) for r in found)

    def with_run(self, changes: DataFrame, run: int) -> LevelTable:
        """The table after the changes of a run: the table's columns and ``live``, one row per key.

        ``changes`` is read more than once, so it should be a written table.
        """
        grown = self
        count = changes.count()
        if count:
            changes = changes.withColumn("seq", F.lit(run).cast("bigint"))
            new = self._written(changes, f"{self.root}/{run}-new", count)
            grown = replace(self, segments=(*self.segments, new))
        step = 0
        while start := grown._to_merge():
            grown = grown._merged(changes.sparkSession, start - 1, f"{self.root}/{run}-merged{step}")
            step += 1
        return grown

    def _to_merge(self) -> int:
        """One more than the number of the segment from which on all become one, 0 if none do."""
        levels = [s.level for s in self.segments]
        if len(levels) > 1 and levels[-2] < levels[-1]:
            return len(levels) - 1
        if len(levels) >= self.fan and len(set(levels[-self.fan :])) == 1 and levels[-1] < self.max_level:
            return len(levels) - self.fan + 1
        return 0

    def _merged(self, spark: SparkSession, start: int, path: str) -> LevelTable:
        merged = _read_rows(spark, [f"{s.path}/rows" for s in self.segments[start:]])
        latest = self._latest(merged)
        # Below the oldest segment there is nothing to hide.
        kept = latest.where("live") if start == 0 else latest
        most = sum(s.rows for s in self.segments[start:])
        one = self._written(kept, path, most)
        one = replace(one, rows=_read_rows(spark, [f"{path}/rows"]).count())
        return replace(self, segments=(*self.segments[:start], one))

    def _latest(self, rows: DataFrame) -> DataFrame:
        rest = [c for c in rows.columns if c not in self.keys and c != "seq"]
        latest = rows.groupBy(*self.keys).agg(F.max_by(F.struct("seq", *rest), "seq").alias("r"))
        return latest.select(*[F.col(c) if c in self.keys else F.col("r")[c].alias(c) for c in rows.columns])

    def _held(self, rows: DataFrame) -> DataFrame:
        return self._latest(rows).where("live").drop("live", "seq")

    def _level(self, rows: int) -> int:
        level = 0
        while level < self.max_level and self.rows_per_bucket * self.fan**level < rows:
            level += 1
        return level

    def _bucket(self, level: int) -> Column:
        return F.pmod(F.xxhash64(*self.bucket_by), F.lit(self.fan**level)).cast("int")

    def _filter_bit(self) -> tuple[Column, Column]:
        """The bitmap of a bucket that a key belongs to, and its bit there."""
        parts = max(1, self.rows_per_bucket * _BITS_PER_ROW // _BITS)
        other = F.xxhash64(F.lit(1), *self.bucket_by)
        return F.pmod(other, F.lit(parts)).cast("int"), F.pmod(F.shiftright(other, 24), F.lit(_BITS)).cast("bigint")

    def _written(self, rows: DataFrame, path: str, most: int) -> Segment:
        level = self._level(most)
        bits, at = self._filter_bit()
        placed = rows.withColumn("bucket", self._bucket(level))
        by_bucket = placed.repartition("bucket").sortWithinPartitions("bucket", *self.keys)
        by_bucket.write.mode("overwrite").option("compression", CODEC).partitionBy("bucket").parquet(f"{path}/rows")
        written = rows.sparkSession.read.parquet(f"{path}/rows")
        filters = (
            written.select("bucket", bits.alias("part"), at.alias("at"))
            .groupBy("bucket", "part")
            .agg(F.bitmap_construct_agg("at").alias("bits"))
            .select(F.lit(path).alias("segment"), F.lit(level).alias("level"), "bucket", "part", "bits")
        )
        filters.repartitionByRange("bucket").sortWithinPartitions("bucket").write.mode("overwrite").parquet(f"{path}/filter")
        return Segment(path, level, most)
