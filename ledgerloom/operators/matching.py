"""Matching spends to the outputs they consume.

Entries carry what an output pays to and how much: ``value`` and ``address``, and
``kind`` where it is needed later.  ``sized_by`` may name a frame that is cheaper
to read than the entries and has the same outpoints; it is then the one searched
for outpoints repeated so often that their rows have to be split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .entries import OUTPOINT, drop_markers
from .ordered import ROWS_PER_CHUNK, following, last_value, previous, running

# Inputs of a transaction come before its outputs.
_CHAIN_ORDER = ["height", "tx_pos", "_is_output", "entry_idx"]


def _payload(df: DataFrame) -> list[str]:
    return [c for c in ("address", "kind", "value") if c in df.columns]


def _as_outputs(unspent: DataFrame, payload: list[str]) -> DataFrame:
    """Unspent outputs of earlier blocks as entries at the start of their blocks."""
    return unspent.select(
        *OUTPOINT,
        "height",
        F.lit(-1).alias("tx_pos"),
        F.lit(0).alias("entry_idx"),
        F.lit(False).alias("is_input"),
        F.lit(False).alias("is_marker"),
        *payload,
    )


def _with_predecessor(
    entries: DataFrame,
    rows_per_chunk: int,
    sized_by: DataFrame | None,
    unspent: DataFrame | None = None,
    with_ends: bool = False,
) -> DataFrame:
    """Entries with what last happened to their outpoint, its columns named ``_before_...``.

    The columns are plain ones, each row's own: a struct of them would be made before the
    shuffle and go through it beside them.  ``is_input`` is made again from the order's
    ``_is_output`` after it.  ``with_ends`` adds whether a row is the ``_end`` of its outpoint, the
    last that happens to it, and whether the outpoint was ``_known`` as unspent before.
    """
    ordered = _in_chain_order(drop_markers(entries))
    payload = _payload(ordered)
    if unspent is not None:
        # Outputs of earlier blocks take part in the order and are not given out again.
        earlier = _in_chain_order(_as_outputs(unspent, payload)).withColumn("_earlier", F.lit(True))
        ordered = ordered.unionByName(earlier, allowMissingColumns=True)
    scans = {f"_before_{c}": previous(c) for c in ("_is_output", *payload)}
    if with_ends:
        known = F.lit(None).cast("boolean") if unspent is None else F.col("_earlier")
        scans |= {"_followed": following(F.lit(True)), "_known": last_value(known)}
    seen = running(ordered, OUTPOINT, _CHAIN_ORDER, scans, rows_per_chunk, sized_by)
    if with_ends:
        seen = seen.withColumns({"_end": F.col("_followed").isNull(), "_known": F.col("_known").isNotNull()}).drop("_followed")
    given = seen if unspent is None else seen.where(F.col("_earlier").isNull())
    return given.withColumn("is_input", ~F.col("_is_output"))


def _in_chain_order(rows: DataFrame) -> DataFrame:
    return rows.withColumn("_is_output", ~F.col("is_input")).drop("is_input", "is_marker")


def _finds_output() -> Column:
    return F.coalesce(_before("_is_output"), F.lit(False))


def _before(column: str) -> Column:
    return F.col(f"_before_{column}")


def _own_or_spent(column: str) -> Column:
    return F.when(F.col("is_input"), _before(column)).otherwise(F.col(column)).alias(column)


def match_spends(
    entries: DataFrame,
    rows_per_chunk: int = ROWS_PER_CHUNK,
    sized_by: DataFrame | None = None,
    unspent: DataFrame | None = None,
) -> DataFrame:
    """Signed change of every output and of every input with an output to spend.

    An input spends the latest output of its outpoint if nothing has spent it yet;
    creating an outpoint again replaces the earlier output.  ``unspent`` gives the
    outputs left by the blocks before those in ``entries``.
    """
    seen = _with_predecessor(entries, rows_per_chunk, sized_by, unspent)
    spent = _before("value")
    return seen.where(~F.col("is_input") | _finds_output()).select(
        "ts",
        "height",
        "tx_pos",
        F.when(F.col("is_input"), -spent).otherwise(F.col("value")).alias("value"),
        _own_or_spent("address"),
    )


def match_spends_strict(
    entries: DataFrame,
    rows_per_chunk: int = ROWS_PER_CHUNK,
    sized_by: DataFrame | None = None,
    unspent: DataFrame | None = None,
) -> DataFrame:
    """As :func:`match_spends`, failing the job on an input without an output."""
    seen = _with_predecessor(entries, rows_per_chunk, sized_by, unspent)
    spent = F.when(_finds_output(), -_before("value")).otherwise(_no_output().cast("bigint"))
    return seen.select(
        "ts",
        "height",
        "tx_pos",
        F.when(F.col("is_input"), spent).otherwise(F.col("value")).alias("value"),
        _own_or_spent("address"),
    )


def _no_output() -> Column:
    where = F.concat_ws(", ", F.lit("output not found"), "height", "ts", "tx_pos", F.col("out_index").cast("string"))
    return F.raise_error(where)


def missing_outputs(
    entries: DataFrame,
    rows_per_chunk: int = ROWS_PER_CHUNK,
    sized_by: DataFrame | None = None,
    unspent: DataFrame | None = None,
) -> DataFrame:
    """Inputs that have no unspent output to consume."""
    seen = _with_predecessor(entries, rows_per_chunk, sized_by, unspent)
    return seen.where(F.col("is_input") & ~_finds_output()).select("height", "ts", "tx_pos", *OUTPOINT)


def tx_legs(
    entries: DataFrame,
    rows_per_chunk: int = ROWS_PER_CHUNK,
    sized_by: DataFrame | None = None,
    unspent: DataFrame | None = None,
    with_ends: bool = False,
) -> DataFrame:
    """Both sides of every transaction with addresses and positive values.

    The job fails on an input without an output.  ``tx_hash`` becomes the hash, in
    hex, of the transaction an entry is part of.  ``with_ends`` adds what :func:`ended_changes`
    reads: an ``outpoint`` where the row decides what becomes of it.
    """
    seen = _with_predecessor(entries, rows_per_chunk, sized_by, unspent, with_ends)
    decides = F.col("_end") & (~F.col("is_input") | F.col("_known")) if with_ends else F.lit(None)
    spent = F.when(_finds_output(), _before("value")).otherwise(_no_output().cast("bigint"))
    return seen.select(
        "height",
        "ts",
        "tx_pos",
        F.lower(F.hex("own_hash")).alias("tx_hash"),
        (F.col("tx_pos") == 0).alias("is_coinbase"),
        "is_input",
        _own_or_spent("address"),
        _own_or_spent("kind"),
        F.when(F.col("is_input"), spent).otherwise(F.col("value")).alias("value"),
        "entry_idx",
        *([F.when(decides, F.struct(*OUTPOINT)).alias("outpoint")] if with_ends else []),
    )


def latest_outputs(entries: DataFrame) -> DataFrame:
    """One output per outpoint, the last created."""
    position = F.struct("height", "tx_pos", "entry_idx")
    return (
        drop_markers(entries)
        .where(~F.col("is_input"))
        .groupBy(*OUTPOINT)
        .agg(F.max(F.struct(position.alias("at"), "address", "value")).alias("o"))
        .select(*OUTPOINT, F.col("o.at.height").alias("created"), "o.address", "o.value")
    )


def join_parents(
    entries: DataFrame, rows_per_chunk: int = ROWS_PER_CHUNK, sized_by: DataFrame | None = None
) -> DataFrame:
    """Every input with the last created output of the same outpoint, wherever that was created.

    One pass over the entries and one shuffle by outpoint.
    """
    rows = drop_markers(entries)
    output = F.when(~F.col("is_input"), F.struct(F.col("height").alias("created"), "address", "value"))
    # Outputs come before all inputs here, so the last one seen is the last created.
    order = ["is_input", "height", "tx_pos", "entry_idx"]
    seen = running(rows, OUTPOINT, order, {"_parent": last_value(output)}, rows_per_chunk, sized_by)
    return seen.where(F.col("is_input") & F.col("_parent").isNotNull()).select(
        "height",
        "ts",
        "tx_pos",
        *OUTPOINT,
        "_parent.created",
        "_parent.address",
        (-F.col("_parent.value")).alias("value"),
    )


def unspent_outputs(
    entries: DataFrame, up_to_height: int | None = None, unspent: DataFrame | None = None
) -> DataFrame:
    """Outputs still unspent after a block (after all blocks if none is given).

    The last event of an outpoint decides, so one aggregation serves as the
    anti join of outputs with their spends.  ``unspent`` gives the outputs left by
    the blocks before those in ``entries``.
    """
    rows = drop_markers(entries)
    if up_to_height is not None:
        rows = rows.where(F.col("height") <= up_to_height)
    payload = _payload(rows)
    if unspent is not None:
        rows = rows.unionByName(_as_outputs(unspent, payload), allowMissingColumns=True)
    event = F.struct(
        F.struct("height", "tx_pos", (~F.col("is_input")).alias("is_output"), "entry_idx").alias("at"), *payload
    )
    return (
        rows.groupBy(*OUTPOINT)
        .agg(F.max(event).alias("e"))
        .where("e.at.is_output")
        .select(*OUTPOINT, F.col("e.at.height").alias("height"), *[F.col("e")[c].alias(c) for c in payload])
    )


def unspent_changes(
    entries: DataFrame, unspent: DataFrame | None = None, legs: DataFrame | None = None
) -> DataFrame:
    """What the blocks in ``entries`` change in the unspent set, one row per outpoint.

    ``unspent`` has the outputs of the blocks before for the outpoints in ``entries``, at least for those that
    inputs name.  Rows with ``live`` are outputs to put; the others, of those given, are to take away.
    ``legs`` may name the entries' :func:`tx_legs` with ends: matching has found what happens last to
    an outpoint, and the entries need not be shuffled by outpoint again.
    """
    if legs is not None:
        payload = [c for c in _payload(entries)]
        ends = legs.where(F.col("outpoint").isNotNull())
        return ends.select("outpoint.*", "height", *payload, (~F.col("is_input")).alias("live"))
    rows = drop_markers(entries)
    payload = _payload(rows)
    if unspent is not None:
        earlier = _as_outputs(unspent, payload).withColumn("earlier", F.lit(True))
        rows = rows.unionByName(earlier, allowMissingColumns=True)
    else:
        rows = rows.withColumn("earlier", F.lit(None).cast("boolean"))
    event = F.struct(
        F.struct("height", "tx_pos", (~F.col("is_input")).alias("is_output"), "entry_idx").alias("at"), *payload
    )
    return (
        rows.groupBy(*OUTPOINT)
        .agg(F.max(event).alias("e"), F.coalesce(F.bool_or("earlier"), F.lit(False)).alias("known"))
        .where("known or e.at.is_output")
        .select(
            *OUTPOINT,
            F.col("e.at.height").alias("height"),
            *[F.col("e")[c].alias(c) for c in payload],
            F.col("e.at.is_output").alias("live"),
        )
    )


def unspent_within(entries: DataFrame, last_height: int, blocks: int) -> DataFrame:
    """Outputs created and not spent in the ``blocks`` blocks up to ``last_height``."""
    first = max(1, last_height - blocks)
    return unspent_outputs(entries.where(F.col("height").between(first, last_height)))
