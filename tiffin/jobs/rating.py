"""Restaurant ratings kept in step with reviews.

The state of a restaurant is a sum and a count, so inserts, updates and deletes are signed additions and no
review is read twice. Sums are decimals: adding and later removing a review restores the state exactly.

A review that moves to another restaurant refreshes both of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiffin.functions import half_up_ratio
from tiffin.operators import keyed_update

STATE = "Restaurant_ID bigint, stars decimal(28,4), reviews bigint"


def _stars(rating: Column) -> Column:
    return rating.cast("decimal(10,4)")


def _total(rows: DataFrame) -> DataFrame:
    return rows.groupBy("Restaurant_ID").agg(
        F.sum("stars").cast("decimal(28,4)").alias("stars"), F.sum("reviews").cast("bigint").alias("reviews")
    )


def review_state(review: DataFrame) -> DataFrame:
    return _total(review.select("Restaurant_ID", _stars(F.col("Rating")).alias("stars"), F.lit(1).alias("reviews")))


def signed_changes(changes: DataFrame) -> DataFrame:
    """Signed rows of a change feed with nullable structs ``before`` and ``after`` (Restaurant_ID, Rating)."""

    def side(name: str, sign: int) -> Column:
        return F.struct(
            F.col(f"{name}.Restaurant_ID").alias("Restaurant_ID"),
            (_stars(F.col(f"{name}.Rating")) * sign).cast("decimal(14,4)").alias("stars"),
            F.lit(sign).alias("reviews"),
        )

    return changes.select(F.inline(F.array(side("before", -1), side("after", 1)))).where(
        F.col("Restaurant_ID").isNotNull()
    )


def apply_changes(state: DataFrame, changes: DataFrame) -> DataFrame:
    """State after a batch of changes. A restaurant whose last review went stays, with a count of 0."""
    return _total(state.unionByName(signed_changes(changes)))


def ratings(state: DataFrame) -> DataFrame:
    """Average to two places; 0.0 where no review is left."""
    average = half_up_ratio(F.col("stars"), F.col("reviews"), 2, num_digits=4)
    return state.select("Restaurant_ID", F.coalesce(average, F.lit(0)).cast("float").alias("new_rating"))


def update_restaurants(restaurant: DataFrame, state: DataFrame) -> DataFrame:
    """Restaurants with fresh ratings; one that never had a review keeps the stored value."""
    return keyed_update(restaurant, ratings(state), "Restaurant_ID", {"Rating": F.col("new_rating")})
