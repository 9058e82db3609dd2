"""Join helpers: broadcast only behind a size check."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Dimension tables (lexicon, categories, prototypes, rules) are parameters
# of the job, not data; they stay far below this bound.
MAX_BROADCAST_ROWS = 100_000


def checked_broadcast(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS,
                      known_rows: int | None = None, what: str = "table",
                      required: bool = True) -> DataFrame:
    """Broadcast ``df`` only after proving it has at most ``max_rows`` rows.

    ``known_rows`` is the size when it is known on the driver (a table built
    from a parameter). ``required`` marks theta/cross joins, which have no
    shuffle alternative: the size is counted when unknown, and a table over
    the bound raises. Otherwise an unknown size is not counted at all: the
    table is returned unhinted and adaptive execution chooses broadcast or
    shuffle from the measured size of the materialized side."""
    if known_rows is None and required:
        known_rows = df.limit(max_rows + 1).count()
    if known_rows is not None and known_rows <= max_rows:
        return F.broadcast(df)
    if required:
        raise ValueError(f"{what} has more than {max_rows} rows; it must be a "
                         "small dimension table for this operator")
    return df


def measured_broadcast(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """A side made from data that is expected to be small (one row a group, a
    partition or a category): written once to the shared checkpoint folder,
    counted there, and broadcast when it has at most ``max_rows`` rows, so that
    the other side does not move. Over the bound it is returned unhinted: the
    join shuffles on its key."""
    from curatio.session import cut_lineage
    small = cut_lineage(df)
    return F.broadcast(small) if small.limit(max_rows + 1).count() <= max_rows else small


def spread(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """Round-robin the input of a narrow, CPU-heavy step over ``partitions``
    tasks; left as it was read when None. For files with fewer row groups than
    the cluster has slots; planning it runs nothing."""
    return df.repartition(partitions) if partitions and not df.isStreaming else df


def ship_by_value(*module_names: str) -> None:
    """Pickle the functions of these modules by value, so Python workers
    run the batch functions without the package being installed on them."""
    import sys

    from pyspark import cloudpickle
    for name in module_names:
        mod = sys.modules.get(name)
        if mod is not None:
            try:
                cloudpickle.register_pickle_by_value(mod)
            except ValueError:
                pass
