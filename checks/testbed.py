"""Commerce tables derived from the TPC-H-like parquet files.

Every table here is a projection or one aggregation of the given files, so it
grows with them. Odd values are planted on purpose: padded statuses, blank
names, null costs, a broken total, unknown payment states, ratings out of range.
All money is whole cents, computed in integers from the double columns.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The coupon an order priority stands for. The last one has lapsed.
COUPONS = [
    (1, "WELCOME10", "percent", 10, 2000, None, True),
    (2, "SAVE500", "fixed", 500, 5000, None, True),
    (3, "FREESHIP", "fixed", 499, 3000, 10000, True),
    (4, "VIP20", "percent", 20, 10000, 1000, True),
    (5, "LAPSED5", "percent", 5, None, None, False),
]

# Payment methods by the same digit.
PAYMENT_METHODS = [
    (1, "card", "Credit Card"),
    (2, "paypal", "PayPal"),
    (3, "gcash", "GCash"),
    (4, "cod", "Cash on Delivery"),
]

# Why goods come back, and in which state.
RETURN_REASONS = [
    "too_small",
    "too_large",
    "damaged",
    "not_as_described",
    "changed_mind",
    "wrong_item",
]
ITEM_CONDITIONS = ["unopened", "used", "damaged"]

LINE_KEY = (
    "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey,"
    " cast(l_quantity as bigint), cast(round(l_extendedprice * 100) as bigint))"
)
EPOCH = "timestamp '1995-01-01 00:00:00'"


def _literal(value: object) -> str:
    if value is None:
        return "null"
    if isinstance(value, bool):
        return "true" if value else "false"
    return f"'{value}'" if isinstance(value, str) else str(value)


def _lookup(key: str, rows: list[tuple], position: int) -> str:
    whens = " ".join(f"when {row[0]} then {_literal(row[position])}" for row in rows)
    return f"case {key} {whens} end"


def _pick(values: list[str], key: str) -> str:
    array = ", ".join(f"'{value}'" for value in values)
    return f"element_at(array({array}), cast({key} % {len(values)} as int) + 1)"


class Testbed:
    """Lazy bronze frames over one folder of parquet files."""

    __test__ = False  # not a test class

    TABLES = [
        "users", "customers", "customer_addresses", "categories", "products",
        "product_variants", "inventory_levels", "carts", "cart_items", "orders",
        "order_items", "payments", "shipments", "refunds", "product_reviews",
        "coupons", "coupon_redemptions",
        "brands", "product_categories", "warehouses", "payment_methods",
        "returns", "return_items",
    ]

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def table(self, name: str) -> DataFrame:
        if name not in self.TABLES:
            raise KeyError(name)
        return getattr(self, name)

    def _read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    # -- identity ---------------------------------------------------------

    @cached_property
    def users(self) -> DataFrame:
        return self._read("customer").selectExpr(
            "c_custkey as id",
            "case when c_custkey % 41 = 0 then replace(lower(c_name), '#', '.')"
            " else concat(replace(lower(c_name), '#', '.'), '@example.com') end as email",
            "'x' as password_hash",
            "c_name as name",
            f"{EPOCH} as created_at",
            f"{EPOCH} as updated_at",
        )

    @cached_property
    def customers(self) -> DataFrame:
        return self._read("customer").selectExpr(
            "c_custkey as id",
            "c_custkey as user_id",
            "case when c_custkey % 100 = 0 then '  '"
            " else concat(' ', split_part(c_name, '#', 1)) end as first_name",
            "case when c_custkey % 50 = 0 then '  '"
            " else concat(split_part(c_name, '#', 2), ' ') end as last_name",
            "cast(null as string) as phone",
            "date_add(date '1950-01-01', cast(c_custkey % 18000 as int)) as date_of_birth",
            "case when c_custkey % 7 = 0 then null else c_custkey % 2 = 0 end as marketing_opt_in",
            "cast(c_acctbal as decimal(12,2)) as lifetime_value_cache",
            f"timestampadd(DAY, cast(c_custkey % 365 as int), {EPOCH}) as created_at",
            f"timestampadd(DAY, cast(c_custkey % 365 as int), {EPOCH}) as updated_at",
        )

    @cached_property
    def customer_addresses(self) -> DataFrame:
        places = (
            self._read("customer")
            .join(self._read("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
            .join(self._read("region"), F.col("n_regionkey") == F.col("r_regionkey"))
            .select("c_custkey", "n_nationkey", "n_name", "r_name")
        )
        used = (
            self._read("orders")
            .groupBy("o_custkey", "o_orderpriority")
            .agg(F.expr("min(o_orderdate) as first_used"), F.expr("max(o_orderdate) as last_used"))
        )
        return used.join(places, used.o_custkey == places.c_custkey).selectExpr(
            "o_custkey * 10 + cast(substr(o_orderpriority, 1, 1) as bigint) as id",
            "o_custkey as customer_id",
            "o_orderpriority as label",
            "concat('Street ', o_custkey) as line1",
            "cast(null as string) as line2",
            "n_name as city",
            "r_name as state",
            "concat('Z', o_custkey) as postal_code",
            "lpad(cast(n_nationkey as string), 2, '0') as country_code",
            "o_orderpriority <> '5-LOW' as is_default_shipping",
            "o_orderpriority = '1-URGENT' as is_default_billing",
            "cast(first_used as timestamp) as created_at",
            "cast(last_used as timestamp) as updated_at",
        )

    # -- catalogue --------------------------------------------------------

    @cached_property
    def brands(self) -> DataFrame:
        return (
            self._read("part")
            .selectExpr("replace(lower(p_brand), '#', '-') as id", "p_brand as name")
            .distinct()
            .selectExpr(
                "id", "name", "id as slug", "cast(null as string) as description",
                "true as is_active", f"{EPOCH} as created_at", f"{EPOCH} as updated_at",
            )
        )

    @cached_property
    def categories(self) -> DataFrame:
        # One row per type and one per (type, brand): each part names both. One per size,
        # each below the one before, so that sizes make one deep chain. Of the sizes, 7, 8 and
        # 9 also stand for a circle of two with a category below it, and 10 for an
        # unknown parent.
        part = self._read("part")
        by_type = (
            part.select("p_type", "p_brand")
            .distinct()
            .selectExpr(
                "explode(array("
                "struct(lower(p_type) as id, cast(null as string) as parent_id, concat(' ', p_type) as name),"
                "struct(concat(lower(p_type), '/', replace(lower(p_brand), '#', '-')) as id,"
                " lower(p_type) as parent_id, concat(p_brand, ' ') as name))) as node"
            )
        )
        by_size = (
            part.select("p_size")
            .distinct()
            .selectExpr(
                "explode(array("
                "struct(concat('size/', p_size) as id,"
                " if(p_size = 1, null, concat('size/', p_size - 1)) as parent_id,"
                " concat('Size ', p_size) as name),"
                "struct(concat('odd/', p_size) as id,"
                " concat('odd/', case p_size when 7 then 8 when 8 then 7 when 9 then 8 else 0 end) as parent_id,"
                " concat('Odd ', p_size) as name))) as node"
            )
            .where("node.id like 'size/%' or node.id in ('odd/7', 'odd/8', 'odd/9', 'odd/10')")
        )
        return (
            by_type.union(by_size)
            .select("node.*")
            .distinct()
            .selectExpr(
                "id", "parent_id", "name",
                "concat(' ', upper(replace(id, '/', '-'))) as slug",
                "id as path",
                f"{EPOCH} as created_at", f"{EPOCH} as updated_at",
            )
        )

    @cached_property
    def product_categories(self) -> DataFrame:
        # Large parts are also listed under their root category, some under their size, a few
        # under a category on a circle; parts of size 25 have none.
        return self._read("part").where("p_size <> 25").selectExpr(
            "p_partkey as product_id",
            "explode(filter(array("
            "concat(lower(p_type), '/', replace(lower(p_brand), '#', '-')),"
            " if(p_size >= 25, lower(p_type), null),"
            " if(p_size % 3 = 0, concat('size/', p_size), null),"
            " if(p_size in (7, 9, 10), concat('odd/', p_size), null)), c -> c is not null))"
            " as category_id",
        )

    @cached_property
    def products(self) -> DataFrame:
        return self._read("part").selectExpr(
            "p_partkey as id",
            "replace(lower(p_brand), '#', '-') as brand_id",
            "concat('  ', p_name, ' ', p_partkey, ' ') as name",
            "concat(' ', upper(replace(p_name, ' ', '-')), '-', p_partkey) as slug",
            "p_type as description",
            "case when p_size % 10 = 0 then 'draft' when p_size % 11 = 0 then ' Active'"
            " when p_size % 13 = 0 then 'published' else 'active' end as status",
            f"timestampadd(DAY, p_size, {EPOCH}) as created_at",
            f"timestampadd(DAY, p_size, {EPOCH}) as updated_at",
        )

    @cached_property
    def product_variants(self) -> DataFrame:
        return (
            self._read("part")
            .selectExpr(
                "p_partkey", "p_name", "p_type", "p_size",
                "cast(round(p_retailprice * 100) as bigint) as base",
                "explode(array(0L, 1L, 2L)) as v",
            )
            .selectExpr("*", "base + v * 100 as price")
            .selectExpr(
                "p_partkey * 3 + v as id",
                "p_partkey as product_id",
                "concat(' sku-', p_partkey, '-', v, ' ') as sku",
                "concat(p_type, ' / ', v, ' ') as name",
                "concat('{\"color\":\"', split_part(p_name, ' ', 1), '\",\"size\":\"', v, '\"}')"
                " as attributes",
                "price as price_cents",
                "case when v > 0 then price * 120 div 100 end as compare_at_price_cents",
                "case when v = 2 and p_partkey % 5 = 0 then null else price * 40 div 100 end"
                " as cost_cents",
                "cast(p_size as bigint) * 100 as weight_grams",
                "case when p_partkey % 13 = 0 then null else v < 2 end as is_active",
                f"{EPOCH} as created_at", f"{EPOCH} as updated_at",
            )
        )

    @cached_property
    def product_reviews(self) -> DataFrame:
        return (
            self._read("events")
            .where("event_type in ('view', 'click')")
            .selectExpr(
                "event_id as id",
                "user_id * 10 + event_id % 10 as product_id",
                "user_id as customer_id",
                "cast(null as bigint) as order_id",
                "cast(event_id % 7 as smallint) as rating",
                "case when event_id % 4 = 0 then '  ' else ' Great ' end as title",
                "case when event_id % 5 = 0 then null else concat('value ', cast(round(value * 100) as bigint)) end"
                " as body",
                "case when event_id % 3 = 0 then null else event_id % 3 = 1 end as is_verified_purchase",
                f"timestampadd(DAY, cast(event_id % 2400 as int), {EPOCH}) as created_at",
            )
        )

    # -- stock ------------------------------------------------------------

    @cached_property
    def warehouses(self) -> DataFrame:
        return self._read("nation").selectExpr(
            "cast(n_nationkey as bigint) as id",
            "concat(' wh-', n_nationkey) as code",
            "concat(n_name, ' DC ') as name",
            "n_name as city",
            "lpad(cast(n_nationkey as string), 2, '0') as country_code",
            "n_nationkey <> 24 as is_active",
        )

    @cached_property
    def inventory_levels(self) -> DataFrame:
        return (
            self._read("lineitem")
            .selectExpr(
                "l_suppkey % 25 as warehouse_id",
                "l_partkey * 3 + l_suppkey % 3 as variant_id",
                "cast(l_quantity as bigint) as quantity",
                "l_linestatus", "l_shipdate",
            )
            .groupBy("warehouse_id", "variant_id")
            .agg(
                F.expr("sum(quantity) - 8 as quantity_on_hand"),
                F.expr("coalesce(sum(quantity) filter (where l_linestatus = 'O'), 0) as quantity_reserved"),
                F.expr("max(l_shipdate) as last_shipped"),
            )
            .selectExpr(
                "warehouse_id", "variant_id", "quantity_on_hand", "quantity_reserved",
                "case when variant_id % 9 = 0 then null else 20L end as reorder_point",
                "cast(last_shipped as timestamp) as updated_at",
            )
        )

    # -- carts and orders ---------------------------------------------------

    @cached_property
    def _order_basis(self) -> DataFrame:
        """Money and status of an order, from its own row only."""
        digit = "cast(substr(o_orderpriority, 1, 1) as bigint)"
        return (
            self._read("orders")
            .selectExpr(
                "o_orderkey as id",
                "o_custkey as customer_id",
                f"{digit} as digit",
                "o_orderstatus = 'F' and o_orderpriority <> '5-LOW' as redeemed",
                "case when o_orderpriority <> '4-NOT SPECIFIED' then o_orderkey end as cart_id",
                "case when o_orderkey % 97 = 0 then ' Paid'"
                " when o_orderstatus = 'F' then 'fulfilled'"
                " when o_orderstatus = 'P' then 'paid'"
                f" when {digit} in (1, 2) then 'refunded'"
                f" when {digit} = 5 then 'cancelled'"
                " else 'pending' end as status",
                "cast(round(o_totalprice * 100) as bigint) as subtotal",
                "cast(timestampadd(MINUTE, cast(o_orderkey % 1440 as int), o_orderdate) as timestamp)"
                " as placed_at",
            )
            .selectExpr(
                "*",
                "case when not redeemed then 0L"
                f" else least(subtotal, case when {_lookup('digit', COUPONS, 2)} = 'percent'"
                f" then (subtotal * {_lookup('digit', COUPONS, 3)} + 50) div 100"
                f" else {_lookup('digit', COUPONS, 3)} end) end as discount",
                "case when status = 'cancelled' then 0L when digit = 1 then 1499L"
                " when digit = 2 then 999L else 499L end as shipping",
            )
            .selectExpr("*", "(subtotal - discount) * 8 div 100 as tax")
            .selectExpr(
                "*",
                "case when id % 499 = 0 then -1L"
                " else greatest(0L, subtotal - discount + shipping + tax) end as total",
            )
        )

    @cached_property
    def orders(self) -> DataFrame:
        return self._order_basis.selectExpr(
            "id",
            "concat('ORD-', id) as order_number",
            "customer_id", "cart_id", "status",
            "'usd ' as currency_code",
            "subtotal as subtotal_cents", "discount as discount_cents",
            "shipping as shipping_cents", "tax as tax_cents", "total as total_cents",
            "customer_id * 10 + digit as shipping_address_id",
            "customer_id * 10 + digit as billing_address_id",
            "placed_at",
            "placed_at as created_at",
            "timestampadd(DAY, 1, placed_at) as updated_at",
        )

    @cached_property
    def _lines(self) -> DataFrame:
        """Order lines with whole-cent money; the key is text made of the row itself."""
        return (
            self._read("lineitem")
            .selectExpr(
                "*",
                f"{LINE_KEY} as line_key",
                "l_partkey * 3 + l_suppkey % 3 as variant_id",
                "cast(l_quantity as bigint) as quantity",
                "cast(round(l_extendedprice * 100) as bigint) as list_cents",
                "cast(round(l_discount * 100) as bigint) as discount_points",
                "cast(round(l_tax * 100) as bigint) as tax_points",
            )
            .selectExpr("*", "list_cents * discount_points div 100 as discount_cents")
            .selectExpr("*", "list_cents - discount_cents as line_total_cents")
        )

    @cached_property
    def order_items(self) -> DataFrame:
        return self._lines.selectExpr(
            "line_key as id",
            "l_orderkey as order_id",
            "variant_id",
            "case when l_partkey % 17 = 0 then '  ' else concat(' Part ', l_partkey) end"
            " as product_name_snapshot",
            "concat('sku-', l_partkey, '-', l_suppkey % 3, ' ') as sku_snapshot",
            "quantity",
            "list_cents div quantity as unit_price_cents",
            "discount_cents",
            "line_total_cents * tax_points div 100 as tax_cents",
            "line_total_cents",
        )

    @cached_property
    def carts(self) -> DataFrame:
        bought = self._order_basis.where("cart_id is not null").selectExpr(
            "cart_id as id", "customer_id", "'converted' as status", "' usd' as currency_code",
            "timestampadd(MINUTE, -30, placed_at) as created_at",
            "placed_at as updated_at",
        )
        browsed = (
            self._read("events")
            .where("event_type = 'view'")
            .selectExpr(
                "-1 - event_id as id", "user_id as customer_id",
                "case event_id % 3 when 0 then 'active' when 1 then ' Abandoned' else 'expired' end as status",
                "' usd' as currency_code",
                f"timestampadd(DAY, cast(event_id % 2400 as int), {EPOCH}) as created_at",
                f"timestampadd(DAY, cast(event_id % 2400 as int), {EPOCH}) as updated_at",
            )
        )
        return bought.unionByName(browsed)

    @cached_property
    def cart_items(self) -> DataFrame:
        with_cart = self._order_basis.where("cart_id is not null").select("cart_id")
        bought = (
            self._lines.join(with_cart, F.col("l_orderkey") == F.col("cart_id"))
            .groupBy("cart_id", "variant_id")
            .agg(
                F.expr("sum(quantity) as quantity"),
                F.expr("min(list_cents div quantity) as unit_price_cents"),
            )
        )
        browsed = (
            self._read("events")
            .where("event_type = 'view' and value > 20")
            .selectExpr(
                "-1 - event_id as cart_id", "user_id * 3 + event_id % 3 as variant_id",
                "1 + event_id % 4 as quantity",
                "cast(round(value * 100) as bigint) as unit_price_cents",
            )
        )
        return bought.unionByName(browsed).selectExpr(
            "concat_ws(':', cart_id, variant_id) as id",
            "cart_id", "variant_id", "quantity", "unit_price_cents",
        )

    @cached_property
    def payments(self) -> DataFrame:
        return self._order_basis.where("status <> 'cancelled'").selectExpr(
            "id",
            "id as order_id",
            "least(digit, 4L) as payment_method_id",
            "case when id % 307 = 0 then total + 5 else total end as amount_cents",
            "case when id % 211 = 0 then 'chargeback' when id % 89 = 0 then ' Succeeded'"
            " when id % 53 = 0 then 'failed' when status = 'pending' then 'pending'"
            " when status = 'refunded' then 'refunded' else 'succeeded' end as status",
            "concat('pay_', id) as provider_ref",
            "case when status <> 'pending' then timestampadd(MINUTE, 30, placed_at) end as paid_at",
            "placed_at as created_at",
        )

    @cached_property
    def shipments(self) -> DataFrame:
        return (
            self._read("lineitem")
            .where("l_linestatus = 'F'")
            .groupBy("l_orderkey")
            .agg(F.expr("min(l_shipdate) as first_ship"), F.expr("min(l_suppkey) as shipper"))
            .selectExpr(
                "l_orderkey as id", "shipper",
                "cast(first_ship as timestamp) as created_at",
                "cast(timestampadd(MINUTE, cast(l_orderkey % 600 as int), first_ship) as timestamp) as left_at",
            )
            .selectExpr(
                "id",
                "id as order_id",
                "1 + id % 3 as shipping_method_id",
                "shipper % 25 as warehouse_id",
                "concat('TRK', id) as tracking_number",
                "case when id % 11 = 0 then 'shipped' when id % 19 = 0 then 'Delivered '"
                " else 'delivered' end as status",
                "case when id % 13 = 0 then null else left_at end as shipped_at",
                "case when id % 11 = 0 then null else timestampadd(DAY, cast(id % 7 as int), left_at) end"
                " as delivered_at",
                "created_at",
            )
        )

    # -- promotions ---------------------------------------------------------

    @cached_property
    def coupons(self) -> DataFrame:
        return (
            self._read("orders")
            .selectExpr("cast(substr(o_orderpriority, 1, 1) as bigint) as id")
            .distinct()
            .selectExpr(
                "id",
                f"{_lookup('id', COUPONS, 1)} as code",
                f"{_lookup('id', COUPONS, 2)} as discount_type",
                f"cast({_lookup('id', COUPONS, 3)} as bigint) as discount_value",
                f"cast({_lookup('id', COUPONS, 4)} as bigint) as min_order_cents",
                f"cast({_lookup('id', COUPONS, 5)} as bigint) as max_redemptions",
                "cast(null as timestamp) as starts_at",
                "cast(null as timestamp) as ends_at",
                f"{_lookup('id', COUPONS, 6)} as is_active",
            )
        )

    @cached_property
    def coupon_redemptions(self) -> DataFrame:
        return self._order_basis.where("redeemed").selectExpr(
            "id",
            "digit as coupon_id",
            "id as order_id",
            "customer_id",
            "case when id % 101 = 0 then discount + 1 else discount end as discount_cents",
            "placed_at as redeemed_at",
        )

    @cached_property
    def payment_methods(self) -> DataFrame:
        return (
            self._read("orders")
            .selectExpr("least(cast(substr(o_orderpriority, 1, 1) as bigint), 4L) as id")
            .distinct()
            .selectExpr(
                "id",
                f"upper({_lookup('id', PAYMENT_METHODS, 1)}) as code",
                f"concat({_lookup('id', PAYMENT_METHODS, 2)}, ' ') as name",
            )
        )

    # -- returns ------------------------------------------------------------

    @cached_property
    def _returned_lines(self) -> DataFrame:
        return self._lines.where("l_returnflag = 'R'")

    @cached_property
    def returns(self) -> DataFrame:
        state = "case l_linenumber % 4 when 0 then 'requested' when 1 then ' Approved'" \
            " when 2 then 'received' else 'rejected' end"
        asked = "cast(timestampadd(DAY, 3, l_shipdate) as timestamp)"
        return self._returned_lines.selectExpr(
            "concat('ret-', line_key) as id",
            "l_orderkey as order_id",
            f"{state} as status",
            f"{_pick(RETURN_REASONS, 'l_partkey')} as reason",
            f"{asked} as requested_at",
            f"case when l_linenumber % 4 = 0 then null else {asked} end as resolved_at",
        )

    @cached_property
    def return_items(self) -> DataFrame:
        return self._returned_lines.selectExpr(
            "concat('ri-', line_key) as id",
            "concat('ret-', line_key) as return_id",
            "line_key as order_item_id",
            "least(quantity, 1 + quantity % 2) as quantity",
            f"{_pick(ITEM_CONDITIONS, 'l_suppkey')} as condition",
        )

    @cached_property
    def refunds(self) -> DataFrame:
        return self._returned_lines.where("l_linestatus = 'F'").selectExpr(
            "concat('rf-', line_key) as id",
            "concat('ret-', line_key) as return_id",
            "l_orderkey as payment_id",
            "line_total_cents div 2 as amount_cents",
            "case l_linenumber when 7 then 'pending' when 6 then ' Completed' else 'completed' end as status",
            "case when l_linenumber = 7 then null"
            " else cast(timestampadd(DAY, 1, l_shipdate) as timestamp) end as refunded_at",
            "cast(l_shipdate as timestamp) as created_at",
        )
