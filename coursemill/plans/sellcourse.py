"""Course sales: the detail table as one semantics with four physical forms."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coursemill.operators.joins import broadcast_within, hot_keys, salted_join

# Columns of the detail table, in its order.
DETAIL_COLUMNS = (
    "courseid coursename status pointlistid majorid chapterid chaptername edusubjectid edusubjectname teacherid "
    "teachername coursemanager money orderid cart_discount sellmoney cart_createtime pay_discount paymoney "
    "pay_createtime dt dn"
).split()

_COURSE_KEYS = ["courseid", "dt", "dn"]
_ORDER_KEYS = ["orderid", "dt", "dn"]
_PAID = ["pay_discount", "paymoney", "pay_createtime"]


def _cart(cart: DataFrame, dt: str) -> DataFrame:
    return (
        cart.where(F.col("dt") == dt)
        .drop("coursename")
        .withColumnRenamed("discount", "cart_discount")
        .withColumnRenamed("createtime", "cart_createtime")
    )


def _pay(pay: DataFrame, dt: str) -> DataFrame:
    return (
        pay.where(F.col("dt") == dt)
        .withColumnRenamed("discount", "pay_discount")
        .withColumnRenamed("createtime", "pay_createtime")
    )


def _course(course: DataFrame, dt: str) -> DataFrame:
    return course.where(F.col("dt") == dt)


def sell_detail(course: DataFrame, cart: DataFrame, pay: DataFrame, dt: str) -> DataFrame:
    """One row per cart line with its course and payment, if any. The join types are left to Spark."""
    return (
        _course(course, dt)
        .join(_cart(cart, dt), _COURSE_KEYS, "right")
        .join(_pay(pay, dt), _ORDER_KEYS, "left")
        .select(*DETAIL_COLUMNS)
    )


def sell_detail_salted(
    course: DataFrame,
    cart: DataFrame,
    pay: DataFrame,
    dt: str,
    *,
    salts: int = 100,
    hot_share: float | None = 0.001,
) -> DataFrame:
    """The same rows with hot courses spread over ``salts`` reducers."""
    joined = salted_join(
        _course(course, dt), _cart(cart, dt), _COURSE_KEYS, "right",
        spread_by=["orderid"], salts=salts, hot_share=hot_share,
    )
    return joined.join(_pay(pay, dt), _ORDER_KEYS, "left").select(*DETAIL_COLUMNS)


def sell_detail_broadcast(course: DataFrame, cart: DataFrame, pay: DataFrame, dt: str) -> DataFrame:
    """The same rows with the catalog broadcast, if it was measured to be small; the cart is not shuffled for it."""
    return (
        broadcast_within(_course(course, dt))
        .join(_cart(cart, dt), _COURSE_KEYS, "right")
        .join(_pay(pay, dt), _ORDER_KEYS, "left")
        .select(*DETAIL_COLUMNS)
    )


def sell_detail_bucketed(
    course: DataFrame, cart: DataFrame, pay: DataFrame, dt: str, *, hot_share: float = 0.001
) -> DataFrame:
    """The same rows from cart and payment tables bucketed on orderid: those two join without any shuffle.

    Only orderid may be a join key, since a join on more keys than the bucket column would shuffle again. The day is
    fixed on both sides, and the site is compared as a range so that it stays a condition on matched orders. A bucket
    cannot be split at run time, so orders with more than ``hot_share`` of the cart are taken out and joined apart. Cart
    lines without an order, which share a bucket, have no payment: they go round the join, read in file splits.
    """
    cart, pay = _cart(cart, dt), _pay(pay, dt)
    unnamed = F.col("orderid").isNull()
    unpaid = cart.where(unnamed).withColumns({c: F.lit(None).cast(pay.schema[c].dataType) for c in _PAID})
    cart = cart.where(~unnamed)
    hot = hot_keys(cart, ["orderid"], hot_share)
    if hot.isEmpty():
        paid = _order_join(cart, pay)
    else:
        hot = F.broadcast(hot)
        hot_pay = broadcast_within(pay.join(hot, "orderid", "left_semi"))
        hot_paid = cart.join(hot, "orderid", "left_semi").join(hot_pay, _ORDER_KEYS, "left")
        paid = _order_join(cart.join(hot, "orderid", "left_anti"), pay).unionByName(hot_paid)
    paid = paid.unionByName(unpaid)
    return broadcast_within(_course(course, dt)).join(paid, _COURSE_KEYS, "right").select(*DETAIL_COLUMNS)


def _order_join(cart: DataFrame, pay: DataFrame) -> DataFrame:
    c, p = cart.alias("c"), pay.alias("p")
    same_site = (F.col("c.dn") <= F.col("p.dn")) & (F.col("c.dn") >= F.col("p.dn"))
    return c.join(p, (F.col("c.orderid") == F.col("p.orderid")) & same_site, "left").select(
        "c.*", *[f"p.{c}" for c in _PAID]
    )
