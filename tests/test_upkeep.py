"""The derived tables after changes equal those made anew."""

import pytest
from pyspark.sql import functions as F

from tiffin.plans import upkeep, views
from tiffin.sources import StarSource


def bag(df):
    return sorted((tuple(r) for r in df.select(*sorted(df.columns)).collect()), key=str)


def pick(column, share, value):
    return F.when(F.xxhash64(column) % share == 0, value).otherwise


CHANGES = {
    "orders moved, cancelled and gone": lambda m: m.replace(
        orders=m["orders"]
        .where(F.col("OrderID") % 7 != 3)
        .withColumn("Status", pick("OrderID", 3, "cancelled")(F.col("Status")))
        .withColumn("Restaurant_ID", F.when(F.col("OrderID") % 11 == 0, 1).otherwise(F.col("Restaurant_ID")))
    ),
    "payments made, corrected and gone": lambda m: m.replace(
        payment=m["payment"]
        .where(F.col("Order_ID") % 5 != 0)
        .withColumn("Status", pick("Order_ID", 2, "Paid")(F.col("Status")))
        .withColumn("Amount", F.when(F.col("Order_ID") % 3 == 0, F.col("Amount") + 1).otherwise(F.col("Amount")).cast("decimal(18,2)"))
    ),
    "reviews moved and gone": lambda m: m.replace(
        review=m["review"]
        .where(F.col("Review_ID") % 4 != 1)
        .withColumn("Restaurant_ID", F.when(F.col("Review_ID") % 3 == 0, 0).otherwise(F.col("Restaurant_ID")))
    ),
    "names, deliveries and discounts": lambda m: m.replace(
        users=m["users"].withColumn("Email", pick("UserID", 9, F.lit(None).cast("string"))(F.col("Email"))),
        restaurant=m["restaurant"].withColumn("Name", F.when(F.col("Restaurant_ID") == 2, "New").otherwise(F.col("Name"))),
        delivery_partner=m["delivery_partner"].withColumn("Phone_No", F.col("Phone_No") + F.when(F.col("Partner_ID") == 1, 1).otherwise(0)),
        delivery=m["delivery"].where(F.col("Delivery_ID") % 6 != 0),
        discount=m["discount"].where(F.col("Discount_ID") % 4 != 0),
    ),
    "nothing": lambda m: m.replace(orders=m["orders"].withColumn("Status", F.col("Status"))),
    "no reviews or orders left": lambda m: m.replace(review=m["review"].limit(0), orders=m["orders"].limit(0)),
}


@pytest.mark.parametrize("name", CHANGES)
def test_changed_views_equal_those_made_anew(spark, small, name):
    old = StarSource(spark, small).marketplace("gen1")
    new = CHANGES[name](old)
    for before, after in [(old, new), (new, old)]:  # and back again
        totals = upkeep.changed_totals(upkeep.leaderboard_totals(before), before, after)
        for corrected in (False, True):
            kept = upkeep.leaderboard(after, totals, corrected)
            assert bag(kept) == bag(views.restaurant_leaderboard(after, corrected))
        kept = upkeep.changed_summary(views.order_summary(before), before, after)
        assert bag(kept) == bag(views.order_summary(after))
    assert (upkeep.touched_orders(old, new).count() == 0) == (name in ("nothing", "reviews moved and gone"))
