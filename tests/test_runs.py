"""Runs that continue earlier ones give what one run over all blocks gives."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from ledgerloom.operators import lifo, matching, netting
from ledgerloom.operators.clock import with_increasing_time
from ledgerloom.plans import pipeline
from ledgerloom.sources.tables import raw_blocks

SF = "/root/testdata/sf0.001"
BLOCKS = 90


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture(scope="module")
def chain(spark):
    return raw_blocks(spark, SF).where(F.col("height") < BLOCKS).cache()


def up_to(chain, tip):
    return chain.where(F.col("height") <= tip)


def test_runs_equal_one_run_and_a_broken_run_is_written_once(spark, chain, tmp_path):
    out = str(tmp_path)
    assert pipeline.run_next(spark, up_to(chain, 40), out)
    # Nothing new is confirmed yet.
    assert not pipeline.run_next(spark, up_to(chain, 40), out)
    assert pipeline.run_next(spark, up_to(chain, 70), out)
    for file in (tmp_path / "done" / "run=1").iterdir():
        file.unlink()
    # Rows of the run that did not finish are not read.
    assert pipeline.read_runs(spark, out, "net").agg(F.max("height")).first()[0] == 37
    assert pipeline.run_next(spark, up_to(chain, 80), out)
    assert pipeline.run_next(spark, chain, out, confirmations=0)

    entries = pipeline.block_entries(chain)
    net = netting.net_changes(matching.match_spends_strict(with_increasing_time(entries)))
    assert rows(pipeline.read_runs(spark, out, "net")) == rows(net)
    assert rows(pipeline.read_runs(spark, out, "stacks")) == rows(lifo.stack_changes(net))
    moved = pipeline.block_transfers(chain)
    assert rows(pipeline.read_runs(spark, out, "transfers").select(*moved.columns)) == rows(moved)
    for period, first in (("day", F.to_date(F.timestamp_seconds("ts"))), ("month", F.trunc(F.to_date(F.timestamp_seconds("ts")), "month"))):
        exact = {r.day: r.n for r in net.groupBy(first.alias("day")).agg(F.countDistinct("address").alias("n")).collect()}
        kept = {r.day: r.addresses for r in pipeline.active_addresses_after_runs(spark, out, period).collect()}
        assert kept.keys() == exact.keys() and all(abs(kept[d] - n) <= max(1, 0.1 * n) for d, n in exact.items())
    unspent = pipeline.unspent_after_runs(spark, out)
    left = lifo.segments(net).where("closed_ts is null").select("address", "nonce", "ots", "value")
    assert rows(pipeline.open_segments_after_runs(spark, out)) == rows(left)
    assert rows(unspent) == rows(matching.unspent_outputs(entries).select(*unspent.columns))


def test_a_run_without_its_parents_fails(spark, chain, tmp_path):
    with pytest.raises(PySparkException, match="output not found"):
        pipeline.run_next(spark, chain.where(F.col("height") > 20), str(tmp_path))
    assert pipeline.finished_runs(spark, str(tmp_path)) is None
