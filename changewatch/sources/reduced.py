"""Scores and tags cut down at their scan to what belongs to changes in scope, by a Bloom filter over the keys in scope.

Most score and tag rows belong to changes of long ago. The filter is built once from the scope and told to the tasks that read the large table, so
rows outside are dropped where they are read and don't reach a shuffle; the join behind it drops the few that pass by chance. Spark puts
it in by itself for joins whose sizes are worth it; here it is told what sizes these are, and how many keys there will be.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

from changewatch.sources.queries import in_review_scope
from changewatch.sources.readers import Tables

BITS_A_KEY = 10  # one row outside in about a hundred passes
MOST_BITS = 1 << 28  # 32 MB, what tasks are told at most
_PREFIX = "spark.sql.optimizer.runtime.bloomFilter."


def bits_for(keys: int) -> int | None:
    """Bits of a filter for so many keys; None where a filter within bounds would let nearly everything pass."""
    wanted = max(1 << 16, BITS_A_KEY * keys)
    return None if wanted > 4 * MOST_BITS else min(wanted, MOST_BITS)


def keys_in_scope(tables: Tables) -> int:
    return tables["recentchanges"].filter(in_review_scope()).count()


@contextmanager
def scope_filters(spark: SparkSession, keys: int, least_scan: str = "1g", largest_scope: str = "1t") -> Iterator[None]:
    """While it holds, joins of tables of ``least_scan`` and more with a filtered scope of up to ``largest_scope`` get a filter for ``keys`` keys.
    Plans are made when they run, so what is to be filtered has to run inside. With too many keys nothing is changed."""
    bits = bits_for(keys)
    settings = {} if bits is None else {
        f"{_PREFIX}enabled": "true", f"{_PREFIX}applicationSideScanSizeThreshold": least_scan,
        f"{_PREFIX}creationSideThreshold": largest_scope, f"{_PREFIX}expectedNumItems": str(max(1, keys)),
        f"{_PREFIX}numBits": str(bits), f"{_PREFIX}maxNumBits": str(max(bits, 1 << 16)),
        f"{_PREFIX}maxNumItems": str(max(1, keys)),
    }
    before = {name: spark.conf.get(name) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
