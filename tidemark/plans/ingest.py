"""One ingest run — bars, quarantine, indicators, snapshot."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidemark.operators.cleaning import quarantine
from tidemark.operators.indicators import add_indicators
from tidemark.session import cut_lineage
from tidemark.sources.snapshots import write_snapshot


def ingest(bars: DataFrame, root: str, snapshot_ts: str, universe: DataFrame | None = None) -> DataFrame:
    """Writes a snapshot of the good bars with their indicators and returns the rejected rows.

    A symbol whose bars are all rejected is skipped by the snapshot, whatever the others do;
    an ingest without any good bar writes an empty snapshot.
    """
    good, rejected = quarantine(cut_lineage(bars), universe)
    write_snapshot(add_indicators(good), root, snapshot_ts)
    return rejected
