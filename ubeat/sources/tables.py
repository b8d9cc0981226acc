"""Views of the driver tables shaped as the reference's record types.

The driver's ``events`` table (event_id, ts, user_id, event_type, value, props
``{"k": 0..99}``) stands in for every behaviour log.  The mapping is fixed:

* ``view`` is a page view (``pv``); ``k`` is the item / ad / page / url id;
* ``error`` is a failed login, every other event a successful one;
* ``click`` creates an order, ``purchase`` pays it; ``signup`` is a receipt;
* a user's province is the nation of the customer with ``c_custkey = user_id``;
* the marketing channel is ``k % 4`` over the reference's four channel names;
* ``event_id`` is the arrival sequence (``seq``).

Each view is a projection (plus, for provinces, a join), so Catalyst prunes the
scan to the columns a query uses and pushes its filters into the parquet scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

# Fixed values from the reference: marketing channels and behaviours.
CHANNELS = ["appstore", "weibo", "wechat", "tieba"]
MARKET_BEHAVIORS = ["view", "download", "install", "uninstall"]
# Payment channels of a receipt.
PAY_CHANNELS = ["wechat", "alipay"]


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def only(events: DataFrame, *event_types: str) -> DataFrame:
    """Rows of the given raw event types — a predicate on a stored column, so it
    reaches the parquet scan (filters on the mapped columns, e.g. ``behavior =
    'pv'``, cannot be inverted by the optimizer and would stay above the scan)."""
    return events.where(F.col("event_type").isin(*event_types))


def item_key(props: str = "props") -> Column:
    """The ``k`` id inside ``props`` (JSON)."""
    return F.get_json_object(F.col(props), "$.k").cast("long")


def _pick(values: list[str], idx: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (idx + 1).cast("int"))


def user_behavior(events: DataFrame) -> DataFrame:
    """UserBehavior: user_id, item_id, category, behavior ('pv' for views), ts, seq."""
    item = item_key()
    return events.select(
        "user_id",
        item.alias("item_id"),
        F.call_function("div", item, F.lit(10)).cast("int").alias("category"),
        F.when(F.col("event_type") == "view", F.lit("pv")).otherwise(F.col("event_type")).alias("behavior"),
        "ts",
        F.col("event_id").alias("seq"),
    )


def access_log(events: DataFrame) -> DataFrame:
    """ApacheLogEvent: ip, user_id, ts, method, url — every event is a request.

    Views are ``GET`` requests, everything else ``POST``; the url is ``/page/<k>``.
    """
    return events.select(
        _ip(F.col("user_id")).alias("ip"),
        F.col("user_id").cast("string").alias("user_id"),
        "ts",
        F.when(F.col("event_type") == "view", F.lit("GET")).otherwise(F.lit("POST")).alias("method"),
        F.concat(F.lit("/page/"), item_key().cast("string")).alias("url"),
        F.col("event_id").alias("seq"),
    )


def access_log_lines(events: DataFrame) -> DataFrame:
    """Access-log text lines (``value``) in the reference's space-separated layout."""
    log = access_log(events)
    line = F.concat_ws(" ", "ip", F.lit("-"), F.lit("-"),
                       F.date_format("ts", "dd/MM/yyyy:HH:mm:ss"), F.lit("+0000"), "method", "url")
    return log.select(line.alias("value"), "seq")


def _ip(uid: Column) -> Column:
    return F.concat_ws(".", F.lit("10"), (F.call_function("div", uid, F.lit(65536)) % 256).cast("string"),
                       (F.call_function("div", uid, F.lit(256)) % 256).cast("string"), (uid % 256).cast("string"))


def customer_provinces(customer: DataFrame, nation: DataFrame) -> DataFrame:
    """(c_custkey, province).

    No broadcast hint: Catalyst broadcasts ``nation`` because its size estimate
    is under ``spark.sql.autoBroadcastJoinThreshold``, and AQE re-decides with
    measured sizes — a side is broadcast only behind that size check.
    """
    return (customer.select("c_custkey", "c_nationkey")
            .join(nation.select("n_nationkey", "n_name"),
                  F.col("c_nationkey") == F.col("n_nationkey"))
            .select("c_custkey", F.col("n_name").alias("province")))


def ad_clicks(events: DataFrame) -> DataFrame:
    """AdClick without place: user_id, ad_id, event_type, ts, seq (all events are clicks)."""
    return events.select("user_id", item_key().alias("ad_id"), "event_type", "ts",
                         F.col("event_id").alias("seq"))


def with_province(df: DataFrame, customer: DataFrame, nation: DataFrame, user: str = "user_id") -> DataFrame:
    """Attach ``province`` and ``city`` (the customer's nation) to rows keyed by user.

    ``customer`` grows with the data, so the join is left to the planner (AQE
    turns it into a broadcast at run time when the measured side is small).
    Attach places *after* per-user filtering: the join shuffles by user, and a
    hot user must not reach it with all of its rows.
    """
    prov = customer_provinces(customer, nation)
    return (df.join(prov, F.col(user) == F.col("c_custkey"), "left").drop("c_custkey")
            .withColumn("city", F.col("province")))


def logins(events: DataFrame) -> DataFrame:
    """LoginEvent: user_id, ip, event_type ('fail' for errors else 'success'), ts, seq."""
    return events.select(
        "user_id", _ip(F.col("user_id")).alias("ip"),
        F.when(F.col("event_type") == "error", F.lit("fail")).otherwise(F.lit("success")).alias("event_type"),
        "ts", F.col("event_id").alias("seq"))


def order_events(events: DataFrame, per: str = "user_item") -> DataFrame:
    """OrderEvent: order_id, event_type ('create' | 'pay'), tx_id, ts, seq.

    ``per='user'`` keys orders by user (pattern queries: a click followed by a
    purchase); ``per='user_item'`` by ``user_id * 100 + k`` (one order per user
    and item, for the create/pay state machine).
    """
    oid = F.col("user_id") if per == "user" else F.col("user_id") * 100 + item_key()
    return (events.where(F.col("event_type").isin("click", "purchase"))
            .select(oid.alias("order_id"),
                    F.when(F.col("event_type") == "click", F.lit("create")).otherwise(F.lit("pay")).alias("event_type"),
                    F.when(F.col("event_type") == "purchase", F.col("user_id").cast("string")).alias("tx_id"),
                    "ts", F.col("event_id").alias("seq")))


def pays(events: DataFrame) -> DataFrame:
    """Pay events for reconciliation: order_id, tx_id (the user), ts, seq."""
    return (events.where(F.col("event_type") == "purchase")
            .select((F.col("user_id") * 100 + item_key()).alias("order_id"),
                    F.col("user_id").cast("string").alias("tx_id"), "ts", F.col("event_id").alias("seq")))


def receipts(events: DataFrame) -> DataFrame:
    """ReceiptEvent: tx_id (the user), pay_channel, ts, seq — signups are receipts."""
    return (events.where(F.col("event_type") == "signup")
            .select(F.col("user_id").cast("string").alias("tx_id"),
                    _pick(PAY_CHANNELS, item_key() % 2).alias("pay_channel"),
                    "ts", F.col("event_id").alias("seq")))


def market_behavior(events: DataFrame) -> DataFrame:
    """MarketUserBehavior: user_id (string), behavior, channel, ts.

    view/click/purchase/error map to view/download/install/uninstall; signups
    are not marketing events and are left out.
    """
    beh = (F.when(F.col("event_type") == "view", F.lit("view"))
           .when(F.col("event_type") == "click", F.lit("download"))
           .when(F.col("event_type") == "purchase", F.lit("install"))
           .when(F.col("event_type") == "error", F.lit("uninstall")))
    return (events.where(F.col("event_type") != "signup")
            .select(F.col("user_id").cast("string").alias("user_id"), beh.alias("behavior"),
                    _pick(CHANNELS, item_key() % 4).alias("channel"), "ts",
                    F.col("event_id").alias("seq")))


def shipments(lineitem: DataFrame) -> DataFrame:
    """Line items as an out-of-order stream: arrival batch = order key, event time = ship date."""
    return lineitem.select(F.col("l_orderkey").alias("seq"), "l_linenumber", "l_partkey",
                           F.col("l_shipdate").alias("ts"))
