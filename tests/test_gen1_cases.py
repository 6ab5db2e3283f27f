"""Edge cases of the generation 1 reports."""

from datetime import timedelta

import pytest
from market import at, collected, market, money, order, paid, restaurant, users

from tiffin.plans import analytics, audit, paging, views


def test_mode_share_counts_unpaid_payments(spark):
    m = market(spark, "gen1", payment=[paid(1, 1), paid(2, 2, mode="Card"), paid(3, 3, status="Failed")])
    rows = collected(analytics.payment_mode_split(m))
    assert [(r[0], r[1], r[3]) for r in rows] == [("Card", 1, money("33.33")), ("UPI", 1, money("33.33"))]


def test_new_customer_is_smallest_number_even_if_later_and_cancelled(spark):
    orders = [order(1, Date_Time=at(9), Status="cancelled"), order(2, Date_Time=at(2))]
    m = market(spark, "gen1", users=users(1), orders=orders)
    assert {r.OrderID: r.customer_type for r in analytics.new_vs_returning(m).collect()} == {
        1: "New Customer",
        2: "Returning Customer",
    }


@pytest.mark.parametrize(
    "corrected, want", [(False, (2, 1, 2, 100.0, 2, money("300.00"))), (True, (2, 1, 1, 50.0, 2, money("200.00")))]
)
def test_dashboard_repeats_orders_per_complaint(spark, corrected, want):
    m = market(
        spark,
        "gen1",
        restaurant=[restaurant(1), restaurant(2)],
        orders=[order(1, Status="cancelled"), order(2)],
        payment=[paid(1, 1), paid(2, 2)],
        complaint=[dict(Complaint_ID=1, OrderID=1), dict(Complaint_ID=2, OrderID=1)],
    )
    first, idle = collected(analytics.restaurant_dashboard(m, corrected=corrected))
    assert first[3:] == want
    assert idle[3:] == (0, 0, 0, None, 0, None)


def test_partner_without_deliveries_has_no_rate(spark):
    m = market(spark, "gen1", delivery_partner=[dict(Partner_ID=1, Name="p", Rating=4.0)])
    assert collected(analytics.partner_scorecard(m))[0][4:] == (0, 0, 0, None)


def test_featured_restaurants_ignore_fan_out(spark):
    m = market(
        spark,
        "gen1",
        restaurant=[restaurant(1), restaurant(2), restaurant(3, Restaurant_Status=False)],
        restaurant_address=[
            dict(Add_ID=1, Restaurant_ID=1, City="Pune"),
            dict(Add_ID=2, Restaurant_ID=2, City="Pune"),
            dict(Add_ID=3, Restaurant_ID=2, City="Goa"),
            dict(Add_ID=4, Restaurant_ID=3, City="Goa"),
        ],
        review=[dict(Review_ID=n, Restaurant_ID=r, Rating=float(s)) for n, (r, s) in
                enumerate([(1, 5), (1, 4), (1, 4), (2, 4), (3, 5)])],
        cuisine=[dict(Cuisine=c, Restaurant_ID=r) for c, r in [("Thai", 1), ("Indian", 1), ("Cafe", 3)]],
        orders=[order(1), order(2), order(3, Restaurant_ID=2), order(4, Restaurant_ID=3)],
    )
    assert collected(analytics.top_rated_restaurants(m)) == [
        (1, "kitchen1", money("4.33"), "Indian,Thai", "Pune", 2),
        (2, "kitchen2", money("4.00"), None, "Goa", 1),
        (2, "kitchen2", money("4.00"), None, "Pune", 1),
    ]


def test_refund_of_free_order_has_no_percentage_and_unpaid_order_vanishes(spark):
    def refund(i, o):
        return dict(Refund_ID=i, OrderID=o, Complaint_ID=i, Refund_Amount=money("10.00"), Refund_Status="Pending")

    m = market(
        spark,
        "gen1",
        users=users(1),
        restaurant=[restaurant(1)],
        orders=[order(1), order(2), order(3)],
        payment=[paid(1, 1, "0.00"), paid(2, 2, "80.00")],
        complaint=[dict(Complaint_ID=i, OrderID=9, Issue_Type="Spill") for i in (1, 2, 3)],
        refund=[refund(1, 1), refund(2, 2), refund(3, 3)],
    )
    rows = {r.OrderID: r.refund_pct_of_payment for r in analytics.refund_impact(m).collect()}
    assert rows == {1: None, 2: money("12.5")}


def test_slow_means_more_than_whole_minutes(spark):
    def run(i, length):
        return dict(Delivery_ID=i, OrderID=i, Partner_ID=1, Status="Delivered", Pickup_Time=at(1),
                    Delivery_Time=at(1) + length)

    runs = [run(1, timedelta(minutes=45, seconds=59)), run(2, timedelta(minutes=46))]
    m = market(spark, "gen1", delivery=runs, delivery_partner=[dict(Partner_ID=1, Name="p", Phone_No=1)])
    assert [(r.Delivery_ID, r.transit_minutes) for r in audit.slow_deliveries(m).collect()] == [(2, 46)]


def test_refund_is_stale_after_25_whole_hours(spark):
    now = at(10, 12)
    complaints = [
        dict(Complaint_ID=1, Created_At=now - timedelta(hours=24, minutes=59)),
        dict(Complaint_ID=2, Created_At=now - timedelta(hours=25)),
    ]
    refunds = [dict(Refund_ID=i, Complaint_ID=i, OrderID=1, Refund_Status="Pending") for i in (1, 2)]
    m = market(spark, "gen1", complaint=complaints, refund=refunds, orders=[order(1)], users=users(1))
    assert [(r.Refund_ID, r.hours_pending) for r in audit.stale_refunds(m, as_of=now).collect()] == [(2, 25)]


def test_period_is_half_open_and_shares_are_of_all_modes(spark):
    orders = [order(1, Date_Time=at(1)), order(2, Date_Time=at(31, 23, 59, 59)), order(3, Date_Time=at(1, month=4))]
    m = market(spark, "gen1", orders=orders, payment=[paid(1, 1), paid(2, 2, mode="Cash"), paid(3, 3)])
    rows = collected(audit.mode_share_in_period(m, at(1), at(1, month=4), ("UPI", "Wallet")))
    assert rows == [("UPI", 1, money("100.00"), money("50.00"))]


def test_late_closing_is_strict(spark):
    kitchens = [restaurant(1, Close_Time="23:00:00"), restaurant(2, Close_Time="23:00:01")]
    m = market(spark, "gen1", restaurant=kitchens, orders=[order(1), order(2, Restaurant_ID=2)])
    assert [r.Restaurant_ID for r in audit.late_night_restaurants(m).collect()] == [2]


def test_same_city_customer_is_listed_once(spark):
    m = market(
        spark,
        "gen1",
        users=users(1, 2),
        user_address=[dict(Add_ID=1, City="Pune"), dict(Add_ID=2, City="Pune"), dict(Add_ID=3, City="Goa")],
        user_has_address=[dict(Add_ID=1, UserID=1), dict(Add_ID=2, UserID=1), dict(Add_ID=3, UserID=2)],
        restaurant=[restaurant(1)],
        restaurant_address=[dict(Add_ID=1, Restaurant_ID=1, City="Pune"), dict(Add_ID=2, Restaurant_ID=1, City="Pune")],
        orders=[order(1, Status="cancelled"), order(2), order(3, UserID=2)],
    )
    assert [r.UserID for r in audit.same_city_customers(m, "Pune").collect()] == [1]


def test_mismatch_needs_more_than_a_paisa(spark):
    m = market(
        spark,
        "gen1",
        orders=[order(1), order(2), order(3)],
        discount=[dict(Discount_ID=1, OrderID=1, Discount_Amount=money("10.00"))],
        payment=[paid(1, 1, "90.01"), paid(2, 2, "99.98", status="Failed"), paid(3, 3)],
    )
    rows = collected(audit.payment_mismatches(m))
    assert [(r[0], r[2], r[-1]) for r in rows] == [(2, money("0.00"), money("0.02"))]


def test_leaderboard_repeats_revenue_per_review(spark):
    m = market(
        spark,
        "gen1",
        restaurant=[restaurant(1), restaurant(2)],
        review=[dict(Review_ID=i, Restaurant_ID=1, Rating=4.0) for i in (1, 2, 3)],
        orders=[order(1)],
        payment=[paid(1, 1)],
    )
    revenue = {r.Restaurant_ID: r.total_revenue for r in views.restaurant_leaderboard(m).collect()}
    assert revenue == {1: money("300.00"), 2: money("0.00")}
    corrected = {r.Restaurant_ID: r.total_revenue for r in views.restaurant_leaderboard(m, corrected=True).collect()}
    assert corrected == {1: money("100.00"), 2: money("0.00")}


def test_views_are_available_to_sql(spark):
    m = market(spark, "gen1", users=users(1), restaurant=[restaurant(1)], orders=[order(1), order(2)])
    views.register_views(m)
    got = spark.sql("SELECT count(*), sum(discount_amount) FROM v_order_summary WHERE customer_name = 'user1'").first()
    assert tuple(got) == (2, money("0.00"))


def test_pages_cover_everything_once(spark):
    m = market(spark, "gen1", users=users(1), orders=[order(7 * i) for i in range(1, 24)])
    pages = [[r.OrderID for r in paging.orders_page(m, p, 10).collect()] for p in range(4)]
    assert pages == [[7 * i for i in r] for r in (range(1, 11), range(11, 21), range(21, 24), ())]
    walked, last = [], None
    while page := [r.OrderID for r in paging.orders_after(m, last, 10).collect()]:
        walked, last = walked + page, page[-1]
    assert walked == [7 * i for i in range(1, 24)]
