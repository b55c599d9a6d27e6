"""Standard experiment frame over the supplied tables, shared by the registry, bench and tests.

Fixed values of the standard setup (weeks, list sizes, seeds) are gathered here.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.weights import binary_matrix, user_item_matrix
from ..operators.item_item import item_item_neighbours, item_item_recs
from ..operators.split import split_two_level, truth_table
from ..session import stored
from ..sources.retail import item_prices, load_interactions

# Fixed values of the standard setup.
LEVEL2_START = 300      # level-1 train: weeks < 300
VALID_START = 322       # level-2 train: weeks 300..321; validation: weeks >= 322
WEEK_LO, WEEK_HI = 96, 98
K_NEIGHBOURS = 20
N_RECS = 5
N_CANDIDATES = 100
EVAL_KS = (5, 10, 50, 100)
SEED = 42
FAKE_ITEM = 999999


def persisted(df: DataFrame) -> DataFrame:
    """Kept in the order in which it is made: the factorisation machine draws its mini-batches by the place of a row."""
    return df.persist(StorageLevel.MEMORY_AND_DISK)


@dataclass
class Frame:
    spark: SparkSession
    sf_dir: str
    keep: Callable[[DataFrame], DataFrame] = stored  # of the week blocks and matrices

    @cached_property
    def inter(self) -> DataFrame:
        return load_interactions(self.spark, self.sf_dir)

    def _block(self, part: int, lo: int | None, hi: int | None) -> DataFrame:
        # each block is read with its week range pushed into the order scan as a date range;
        # split_two_level keeps the same week filters on the derived column.
        # A block is read by many parts of a report: the line items are joined once
        weeks = load_interactions(self.spark, self.sf_dir, weeks=(lo, hi))
        return self.keep(split_two_level(weeks, LEVEL2_START, VALID_START)[part])

    @cached_property
    def train(self) -> DataFrame:
        return self._block(0, None, LEVEL2_START - 1)

    @cached_property
    def level2(self) -> DataFrame:
        return self._block(1, LEVEL2_START, VALID_START - 1)

    @cached_property
    def valid(self) -> DataFrame:
        return self._block(2, VALID_START, None)

    @cached_property
    def val_users(self) -> DataFrame:
        return self.valid.select("user_id").distinct().persist(StorageLevel.MEMORY_AND_DISK)

    @cached_property
    def truth(self) -> DataFrame:
        return truth_table(self.valid).persist(StorageLevel.MEMORY_AND_DISK)

    @cached_property
    def prices(self) -> DataFrame:
        return item_prices(self.spark, self.sf_dir)

    @cached_property
    def train_matrix(self) -> DataFrame:
        # read by the co-occurrence join, the norms, the scoring join and the seen-item filter
        return self.keep(binary_matrix(self.train))

    @cached_property
    def counts(self) -> DataFrame:
        # purchases per pair: the statistics of a weighting and the weights themselves read it
        return self.keep(user_item_matrix(self.train, "count"))

    @cached_property
    def neighbours(self) -> DataFrame:
        # small (items x K) and read by every item-item list of the frame; the lists it was made from are freed
        return stored(item_item_neighbours(self.train_matrix, K_NEIGHBOURS))

    def item_item(self, n: int, users: DataFrame | None = None, exclude_seen: bool = True) -> DataFrame:
        return item_item_recs(self.train_matrix, self.neighbours, n,
                              self.val_users if users is None else users, exclude_seen)

    @cached_property
    def candidates(self) -> DataFrame:
        """Level-1 list: item-item top ``N_CANDIDATES`` for validation users."""
        return stored(self.item_item(N_CANDIDATES))


def r6(c: str):
    return F.round(F.col(c), 6).alias(c)
