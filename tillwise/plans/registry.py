"""Named queries: each is ``fn(spark, sf_dir) -> DataFrame`` plus, where the
result is deterministic, an independent SQL twin for DuckDB.

Every query starts from the given tables and derives bronze -> silver -> gold
lazily, so its work grows with the input.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..session import prefer_hash_joins, prepare
from ..sources.bronze import invoice_lines, profiles


@dataclass
class Query:
    name: str
    fn: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    headline: bool = False


REGISTRY: dict[str, Query] = {}


def register(name: str, sql: str | None = None, headline: bool = False):
    def deco(fn):
        REGISTRY[name] = Query(name, fn, sql, headline)
        return fn
    return deco


class Inputs:
    """Lazily built shared inputs of one query run (bronze, silver, profiles)."""

    def __init__(self, spark: SparkSession, sf_dir: str, share_bronze: bool = False):
        """``share_bronze``: the run reads the raw lines twice. ``silver`` and
        ``profiles`` then read ``counted``; ``bronze`` is materialised by those
        who read it several times themselves (``shared_bronze``)."""
        self.spark = prefer_hash_joins(prepare(spark))
        self.sf_dir = sf_dir
        self.share_bronze = share_bronze
        self._cache: dict[str, DataFrame] = {}

    def _get(self, key, build):
        if key not in self._cache:
            self._cache[key] = build()
        return self._cache[key]

    @property
    def bronze(self) -> DataFrame:
        return self._get("bronze", lambda: invoice_lines(self.spark, self.sf_dir))

    @property
    def shared_bronze(self) -> DataFrame:
        """The raw lines, materialised."""
        from ..session import cut_lineage
        return self._get("shared_bronze", lambda: cut_lineage(self.bronze))

    @property
    def counted(self) -> DataFrame:
        """Distinct raw lines of known customers with their copies, written
        once: silver and the profiles both read them."""
        from ..operators.silver import counted_lines
        from ..session import cut_lineage
        return self._get("counted", lambda: cut_lineage(counted_lines(self.bronze)))

    @property
    def silver(self) -> DataFrame:
        """Clean lines. Every mart reads them at least twice (observation end
        plus its aggregate), and a lazy chain would redo the joins and the
        dedup shuffle for each read: they are materialised once, or, where the
        profiles are needed too, filtered from the counted lines."""
        from ..operators.silver import clean_lines, stg_transactions
        from ..session import cut_lineage
        return self._get("silver", lambda: clean_lines(self.counted) if self.share_bronze else cut_lineage(stg_transactions(self.bronze)))

    @property
    def profiles(self) -> DataFrame:
        from ..operators.silver import observation_end
        return self._get("profiles", lambda: profiles(self.spark, self.sf_dir, None, observation_end(self.silver),
                                                      counted=self.counted))

    @property
    def activity(self) -> DataFrame:
        """What the profiles and the marts need of the lines, per customer,
        written once. Where nothing else has asked for the lines, they are
        written without the description, which no mart reads (equal lines are
        told apart by it all the same)."""
        from ..functions.exprs import flag
        from ..operators.activity import customer_activity
        from ..operators.silver import counted_lines, is_clean
        from ..session import cut_lineage

        def build():
            lines = self._cache.get("counted")
            if lines is None:
                lines = cut_lineage(counted_lines(self.bronze).drop("Description"))
            return cut_lineage(customer_activity(lines, flag(is_clean())))
        return self._get("activity", build)

    @property
    def segments(self) -> DataFrame:
        """RFM segments (documented score direction), built once per run."""
        from ..operators.rfm import rfm_segments
        from ..params import SegmentParams
        return self._get("segments", lambda: rfm_segments(None, SegmentParams(best_is_high=True), activity=self.activity)
                         if self.share_bronze else rfm_segments(self.silver, SegmentParams(best_is_high=True)))

    @property
    def customers(self) -> DataFrame:
        """Profiles for the marts, from the activity they share."""
        from ..operators.activity import last_clean
        from ..operators.silver import stg_customers
        return self._get("customers", lambda: stg_customers(profiles(
            self.spark, self.sf_dir, None, last_clean(self.activity), activity=self.activity)))


def _load() -> None:
    """Import the catalogue modules (each registers its queries)."""
    from . import catalog, catalog_model, catalog_profile, catalog_quality  # noqa: F401


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()
    return {name: q.fn for name, q in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    _load()
    return {name: q.sql for name, q in REGISTRY.items() if q.sql}


def headline() -> list[str]:
    _load()
    return [name for name, q in REGISTRY.items() if q.headline]
