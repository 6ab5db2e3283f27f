"""Edge cases of the generation 2 dashboard."""

from datetime import timedelta

from market import at, collected, market, money

from tiffin.plans import dashboard

PEOPLE = [dict(UserID=i, User_Name=f"user{i}", Phone_No=f"600{i}") for i in (1, 2, 3)]


def placed(i, **more):
    return dict(OrderID=i, UserID=1, Order_Status="Delivered", Total_Amount=100, Date_Time=at(1), Add_ID=1) | more


def test_unmarked_food_is_a_group_of_its_own(spark):
    items = [dict(Item_ID=1, Is_Veg=True), dict(Item_ID=2, Is_Veg=False), dict(Item_ID=3)]
    lines = [dict(OrderID=o, Item_ID=i, Quantity=2, Price=5) for o, i in [(1, 1), (1, 2), (2, 3), (3, 3)]]
    m = market(spark, "gen2", menu_item=items, order_item=lines)
    assert sorted(collected(dashboard.veg_split(m))) == [("Non-Veg", 1, 2), ("Non-Veg", 2, 4), ("Veg", 1, 2)]


def test_order_that_spans_restaurants_counts_in_each(spark):
    m = market(
        spark,
        "gen2",
        restaurant=[dict(Restaurant_ID=1, Resto_Name="a"), dict(Restaurant_ID=2, Resto_Name="b")],
        menu_item=[dict(Item_ID=1, Restaurant_ID=1), dict(Item_ID=2, Restaurant_ID=1), dict(Item_ID=3, Restaurant_ID=2)],
        orders=[placed(1), placed(2), placed(3, Order_Status="Cancelled")],
        order_item=[
            dict(OrderID=o, Item_ID=i, Quantity=q, Price=10) for o, i, q in [(1, 1, 1), (1, 2, 2), (1, 3, 4), (2, 1, 1), (3, 1, 9)]
        ],
    )
    assert collected(dashboard.revenue_per_restaurant(m)) == [("a", 40, 2, money("13.33")), ("b", 40, 1, money("40.00"))]


def test_delivery_without_pickup_counts_but_is_not_averaged(spark):
    start = at(1)
    runs = [
        dict(Delivery_ID=1, Partner_ID=1, Pickup_Time=start, Delivery_Time=start + timedelta(minutes=30, seconds=50)),
        dict(Delivery_ID=2, Partner_ID=1, Delivery_Time=start),
        dict(Delivery_ID=3, Partner_ID=1, Pickup_Time=start),
        dict(Delivery_ID=4, Partner_ID=2, Delivery_Time=start),
    ]
    partners = [dict(Partner_ID=i, Name=f"p{i}", City="Pune", Rating=money("4.5")) for i in (1, 2, 3)]
    m = market(spark, "gen2", delivery=runs, delivery_partner=partners)
    assert [(r[0], r[2], r[3]) for r in collected(dashboard.delivery_time_per_partner(m))] == [
        ("p2", None, 1),
        ("p1", money("30.0"), 2),
    ]


def test_complaint_names_who_raised_it(spark):
    m = market(
        spark,
        "gen2",
        user=PEOPLE,
        orders=[placed(1, UserID=1)],
        complaint=[
            dict(Complaint_ID=1, OrderID=1, UserID=2, Status="Pending", Created_At=at(2)),
            dict(Complaint_ID=2, OrderID=1, UserID=2, Status="Resolved", Created_At=at(2)),
        ],
    )
    assert [(r[0], r[3]) for r in collected(dashboard.pending_complaints(m))] == [(1, "user2")]


def test_coupon_without_limit_has_no_usage(spark):
    coupons = [dict(Coupon_ID=1, Used_Count=1, Max_Uses=8), dict(Coupon_ID=2, Used_Count=1, Max_Uses=0)]
    m = market(spark, "gen2", coupon=coupons)
    assert [r.Usage_Pct for r in dashboard.coupon_usage(m).collect()] == [money("12.5"), None]


def test_spender_without_wallet_and_order_without_address_drop_out(spark):
    m = market(
        spark,
        "gen2",
        user=PEOPLE,
        wallet=[dict(Wallet_ID=1, UserID=1, Balance=400)],
        address=[dict(Add_ID=1, City="Pune")],
        orders=[placed(1), placed(2, UserID=2, Add_ID=None), placed(3, Order_Status="Cancelled")],
    )
    assert collected(dashboard.top_spenders(m)) == [("user1", 1, 100, 400)]
    assert collected(dashboard.orders_by_city(m)) == [("Pune", 1, 100)]
    assert [r.OrderID for r in dashboard.low_wallet_orders(m).collect()] == [1, 3]


def test_unread_excludes_unknown(spark):
    notes = [dict(Notification_ID=i, UserID=1, Is_Read=r) for i, r in enumerate([False, True, None])]
    m = market(spark, "gen2", user=PEOPLE, notification=notes)
    assert collected(dashboard.unread_notifications(m)) == [("user1", 1)]


def test_payment_without_order_is_summed_but_not_counted(spark):
    pays = [dict(Transaction_ID=i, Mode="UPI", Status="Success", Amount=5, Order_ID=o) for i, o in [(1, 1), (2, None)]]
    m = market(spark, "gen2", payment=pays)
    assert collected(dashboard.payment_methods(m)) == [("UPI", 1, 10)]


def test_cancellation_repeats_per_refund_and_stays_without_one(spark):
    m = market(
        spark,
        "gen2",
        user=PEOPLE,
        orders=[placed(1, UserID=1), placed(2, UserID=2), placed(3, UserID=3)],
        cancellation=[dict(Cancellation_ID=i, Order_ID=i, Canceled_BY=3, Cancel_At=at(i), Reason="r") for i in (1, 2)],
        refund=[dict(Refund_ID=i, OrderID=o, Refund_Amount=i, Refund_Status="Pending") for i, o in [(1, 2), (2, 2), (3, 3)]],
    )
    rows = collected(dashboard.cancellations_with_refunds(m))
    assert [(r[0], r[1], r[4]) for r in rows] == [(2, "user2", 1), (2, "user2", 2), (1, "user1", None)]


def test_ties_go_to_the_smaller_number(spark):
    items = [dict(Item_ID=i, Item_Name=f"i{i}", Price=1) for i in range(1, 8)]
    lines = [dict(OrderID=1, Item_ID=i, Quantity=2) for i in range(1, 8)]
    kitchens = [dict(Restaurant_ID=i, Resto_Name=f"k{i}", Restaurant_Status=True, Rating=money("4.0")) for i in range(1, 8)]
    m = market(spark, "gen2", menu_item=items, order_item=lines, restaurant=kitchens)
    assert [r.Item_Name for r in dashboard.most_ordered_items(m).collect()] == ["i1", "i2", "i3", "i4", "i5"]
    assert [r.Resto_Name for r in dashboard.top_rated(m).collect()] == ["k1", "k2", "k3", "k4", "k5"]


def test_timeline_of_one_order(spark):
    logs = [dict(Log_ID=i, OrderID=o, Status=s, Changed_At=at(1, h)) for i, o, s, h in
            [(1, 1, "Delivered", 3), (2, 1, "Placed", 1), (3, 2, "Placed", 2), (4, 1, "Packed", 1)]]
    m = market(spark, "gen2", user=PEOPLE, orders=[placed(1), placed(2)], order_status_log=logs)
    assert [r.Status for r in dashboard.order_timeline(m, 1).collect()] == ["Placed", "Packed", "Delivered"]
