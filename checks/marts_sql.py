"""Further marts, lookups and data-quality results as SQL over the blocks."""

from checks.silver_sql import MEASURES

_SUMS = """
       cast(sum(units_sold) as bigint) as units_sold, cast(sum(gross_revenue_cents) as bigint) as gross_revenue_cents,
       cast(sum(refund_cents) as bigint) as refund_cents, cast(sum(net_revenue_cents) as bigint) as net_revenue_cents,
       cast(sum(discount_cents) as bigint) as discount_cents, cast(sum(cogs_cents) as bigint) as cogs_cents,
       cast(sum(gross_margin_cents) as bigint) as gross_margin_cents,
       if(sum(gross_revenue_cents) > 0, cast(sum(gross_margin_cents) as double) / sum(gross_revenue_cents), null)
           as gross_margin_pct
"""

_PERIOD = """
select cast(date_trunc('{unit}', order_date) as date) as period_start,
       cast(sum(order_count) as bigint) as order_count, cast(sum(gmv_cents) as bigint) as gmv_cents,
       cast(sum(net_revenue_cents) as bigint) as net_revenue_cents, cast(sum(refund_cents) as bigint) as refund_cents,
       cast(sum(refunded_order_count) as bigint) as refunded_order_count,
       cast(sum(subtotal_cents) as bigint) as subtotal_cents, cast(sum(discount_cents) as bigint) as discount_cents,
       cast(sum(shipping_cents) as bigint) as shipping_cents, cast(sum(tax_cents) as bigint) as tax_cents,
       cast(sum(review_count) as bigint) as review_count,
       if(sum(review_count) > 0, cast(sum(cast(avg_rating * review_count as decimal(28,6))) as double) / sum(review_count), null) as avg_rating,
       cast(sum(gmv_cents) as double) / sum(order_count) as aov_cents,
       cast(sum(refund_cents) as double) / sum(gmv_cents) as refund_rate
from g_daily group by 1
"""

# Each product's sales cut in as many whole parts as it has categories, which add up again.
_PARTS = (
    "select order_date, category_id, "
    + ", ".join(
        f"({m} - ({m} % parts + parts) % parts) // parts + if(place <= ({m} % parts + parts) % parts, 1, 0) as {m}"
        for m in ("units_sold", "gross_revenue_cents", "refund_cents", "net_revenue_cents", "discount_cents",
                  "cogs_cents", "gross_margin_cents")
    )
    + """
from (
    select g_product.*, category_id, coalesce(parts, 1) as parts, coalesce(place, 1) as place
    from g_product left join (
        select *, row_number() over (partition by product_id order by category_id) as place,
               count(*) over (partition by product_id) as parts
        from s_product_categories
    ) using (product_id)
)
"""
)

MART_QUERIES = {
    "mart_orders_by_status": """
select order_date, order_status, count(*) as order_count, cast(sum(total_cents) as bigint) as gmv_cents
from s_orders group by all
""",
    "mart_orders_by_status_stacked": """
select order_date, count(*) filter (where order_status = 'pending') as pending,
       count(*) filter (where order_status = 'paid') as paid,
       count(*) filter (where order_status = 'fulfilled') as fulfilled,
       count(*) filter (where order_status = 'cancelled') as cancelled,
       count(*) filter (where order_status = 'refunded') as refunded,
       count(*) filter (where coalesce(order_status, '') not in
           ('pending', 'paid', 'fulfilled', 'cancelled', 'refunded')) as other,
       count(*) as order_count
from s_orders group by order_date
""",
    "mart_variant_sales": f"""
select order_date, variant_id, min(sku) as sku, count(distinct order_id) as order_count, {MEASURES}
from g_lines group by order_date, variant_id
""",
    "mart_top_skus": """
select variant_id, min(sku) as sku, cast(sum(quantity) as bigint) as units_sold,
       cast(sum(line_total_cents) as bigint) as gross_revenue_cents
from g_lines where order_date between date '1998-01-01' and date '1998-03-01'
group by variant_id order by units_sold desc, variant_id limit 10
""",
    "mart_category_sales": f"""
select order_date, primary_category_id, min(category_path) as category_path, {_SUMS}
from g_product left join s_enriched_products using (product_id) group by order_date, primary_category_id
""",
    "mart_brand_sales": f"""
select order_date, brand_id, min(brand_name) as brand_name, {_SUMS}
from g_product left join s_enriched_products using (product_id) group by order_date, brand_id
""",
    "mart_product_sales_with_names": """
select g_product.*, brand_name, category_name, category_path
from g_product left join s_enriched_products using (product_id)
""",
    "mart_slow_movers": """
select product_id, product_name,
       (select cast(ifnull(sum(units_sold), 0) as bigint) from g_product g where g.product_id = s_products.product_id
        and order_date between date '1997-12-02' and date '1998-03-01') as units_sold,
       (select cast(ifnull(sum(gross_revenue_cents), 0) as bigint) from g_product g where g.product_id = s_products.product_id
        and order_date between date '1997-12-02' and date '1998-03-01') as gross_revenue_cents
from s_products where is_active
""",
    "mart_customer_activity": """
select order_date, count(distinct customer_id) filter (where order_date = first_day) as new_buyers,
       count(distinct customer_id) filter (where order_date > first_day) as returning_buyers,
       count(*) as order_count,
       count(*) filter (where nth = 1) as new_customer_orders,
       count(*) filter (where nth > 1) as returning_customer_orders
from (
    select customer_id, order_date, min(order_date) over (partition by customer_id) as first_day,
           row_number() over (partition by customer_id order by order_date, order_id) as nth
    from s_orders where is_revenue_order
) group by order_date
""",
    "mart_customer_cohorts": """
select cohort_month, period_number, active_customers, cohort_size,
       cast(active_customers as double) / cohort_size * 100 as retention_pct
from (
    select cohort_month, cast(datediff('month', cohort_month, month) as integer) as period_number,
           count(distinct customer_id) as active_customers, min(size) as cohort_size
    from (
        select customer_id, cast(date_trunc('month', order_date) as date) as month, cohort_month, size
        from s_orders
        join (select customer_id, cast(date_trunc('month', min(order_date)) as date) as cohort_month,
                     count(*) over (partition by date_trunc('month', min(order_date))) as size
              from s_orders where is_revenue_order group by customer_id) using (customer_id)
        where is_revenue_order
    ) group by all
)
""",
    "mart_customer_months": """
select customer_id, cast(date_trunc('month', order_date) as date) as order_date, count(*) as order_count,
       cast(sum(total_cents) as bigint) as ltv_cents, min(order_date) as first_order_date,
       max(order_date) as last_order_date
from s_orders where is_revenue_order group by 1, 2
""",
    "mart_customer_ltv": """
select customer_id, count(*) as order_count, cast(sum(total_cents) as bigint) as ltv_cents,
       min(order_date) as first_order_date, max(order_date) as last_order_date
from s_orders where is_revenue_order group by customer_id
""",
    "mart_top_customers": """
select customer_id, count(*) as order_count, cast(sum(total_cents) as bigint) as ltv_cents,
       min(order_date) as first_order_date, max(order_date) as last_order_date
from s_orders where is_revenue_order group by customer_id order by ltv_cents desc, customer_id limit 20
""",
    "mart_orders_per_customer": """
select order_count, count(*) as customers
from (select count(*) as order_count from s_orders where is_revenue_order group by customer_id) group by all
""",
    "mart_geo_sales": """
select default_country_code, default_state, count(distinct customer_id) as customers,
       count(distinct customer_id) filter (where order_id is not null) as buyers, count(order_id) as order_count,
       cast(ifnull(sum(total_cents), 0) as bigint) as gmv_cents
from s_customers full join (select customer_id, order_id, total_cents from s_orders where is_revenue_order)
    using (customer_id)
group by default_country_code, default_state
""",
    "mart_funnel_daily": """
select cart_date, count(*) as carts_created, count(*) filter (where item_quantity > 0) as carts_with_items,
       count(converted_order_id) as orders, count(*) - count(converted_order_id) as abandoned_carts,
       cast(count(*) - count(converted_order_id) as double) / count(*) as abandoned_rate
from s_carts group by cart_date
""",
    "mart_promo_performance": """
select c.id as coupon_id, code as coupon_code, discount_type, count(r.id) as redemptions,
       cast(ifnull(sum(r.discount_cents), 0) as bigint) as discount_cents,
       cast(ifnull(sum(total_cents), 0) as bigint) as influenced_gmv_cents
from b_coupons c left join b_coupon_redemptions r on r.coupon_id = c.id
left join s_orders o on o.order_id = r.order_id and is_revenue_order
group by all
""",
    "mart_rating_distribution": "select rating, count(*) as review_count from s_reviews group by all",
    "mart_rating_by_week": """
select cast(date_trunc('week', review_date) as date) as week_start, count(*) as review_count, avg(rating) as avg_rating
from s_reviews group by 1
""",
    "mart_payment_mix": """
select payment_method_id, method_code, method_name, count(*) as payment_count,
       count(*) filter (where is_succeeded) as succeeded_count, cast(sum(amount_cents) as bigint) as amount_cents
from s_payments left join s_payment_methods using (payment_method_id) group by all
""",
    "mart_payment_success": """
select payment_date, count(*) as payment_count, count(*) filter (where is_succeeded) as succeeded_count,
       cast(count(*) filter (where is_succeeded) as double) / count(*) as success_rate
from s_payments group by payment_date
""",
    "mart_fulfillment": """
select order_date, count(*) as shipment_count, avg(hours_order_to_ship) as avg_hours_to_ship,
       count(hours_order_to_deliver) as delivered_count,
       count(*) filter (where hours_order_to_deliver <= 168) as on_time_count,
       if(count(hours_order_to_deliver) > 0, cast(count(*) filter (where hours_order_to_deliver <= 168) as double)
           / count(hours_order_to_deliver) * 100, null) as on_time_pct
from s_shipments group by order_date
""",
    "mart_stockouts": """
select warehouse_id, variant_id, quantity_on_hand, quantity_reserved, sku, product_name, warehouse_code
from s_inventory left join s_variants using (variant_id) left join s_warehouses using (warehouse_id) where is_stockout
""",
    "mart_stock_by_warehouse": """
select warehouse_id, count(*) as variants, cast(sum(quantity_on_hand) as bigint) as quantity_on_hand,
       cast(sum(quantity_reserved) as bigint) as quantity_reserved,
       cast(sum(quantity_available) as bigint) as quantity_available,
       count(*) filter (where is_stockout) as stockout_variants,
       count(*) filter (where is_below_reorder_point) as variants_to_reorder,
       min(warehouse_code) as warehouse_code, min(warehouse_name) as warehouse_name
from s_inventory left join s_warehouses using (warehouse_id) group by warehouse_id
""",
    "mart_return_rate_by_category": """
select primary_category_id, min(category_path) as category_path, cast(sum(quantity) as bigint) as units_sold,
       cast(ifnull(sum(returned), 0) as bigint) as returned_units,
       cast(ifnull(sum(returned), 0) as double) / sum(quantity) as return_rate
from g_lines left join s_enriched_products using (product_id)
left join (select order_item_id, sum(quantity) as returned from b_return_items group by all) using (order_item_id)
group by primary_category_id
""",
    "mart_refunds_by_day": """
select refund_date, count(*) as refund_count, cast(sum(refund_cents) as bigint) as refund_cents
from s_refunds where is_completed group by refund_date
""",
    "mart_return_reasons": "select return_reason, count(*) as return_count from s_returns group by all",
    "mart_daily_sales_by_week": _PERIOD.format(unit="week"),
    "mart_daily_sales_by_month": _PERIOD.format(unit="month"),
    **{
        f"mart_product_sales_by_{unit}": f"""
select cast(date_trunc('{unit}', order_date) as date) as period_start, product_id, min(product_name) as product_name,
       count(distinct variant_id) as sku_count, count(distinct order_id) as order_count, {MEASURES}
from g_lines group by 1, 2
"""
        for unit in ("week", "month", "quarter")
    },
    "mart_sold_variants": """
select order_date, product_id, cast(1 as bigint) as bucket, count(distinct variant_id) as sku_count
from g_lines group by order_date, product_id
""",
    "mart_variant_sales_by_month": f"""
select cast(date_trunc('month', order_date) as date) as period_start, variant_id,
       count(distinct order_id) as order_count, {MEASURES}
from g_lines group by 1, 2
""",
    "mart_category_sales_by_month": f"""
select cast(date_trunc('month', order_date) as date) as period_start, primary_category_id,
       count(distinct variant_id) as sku_count, {MEASURES}
from g_lines left join s_enriched_products using (product_id) group by 1, 2
""",
    "mart_brand_sales_by_quarter": f"""
select cast(date_trunc('quarter', order_date) as date) as period_start, brand_id,
       count(distinct variant_id) as sku_count, {MEASURES}
from g_lines left join s_enriched_products using (product_id) group by 1, 2
""",
    "mart_orders_by_status_by_week": """
select cast(date_trunc('week', order_date) as date) as period_start, order_status, count(*) as order_count,
       cast(sum(total_cents) as bigint) as gmv_cents
from s_orders group by 1, 2
""",
    "mart_funnel_by_week": """
select cast(date_trunc('week', cart_date) as date) as period_start, count(*) as carts_created,
       count(*) filter (where item_quantity > 0) as carts_with_items, count(*) filter (where is_converted) as orders,
       count(*) filter (where is_abandoned) as abandoned_carts,
       cast(count(*) filter (where is_abandoned) as double) / count(*) as abandoned_rate
from s_carts group by 1
""",
    "mart_payment_success_by_month": """
select cast(date_trunc('month', payment_date) as date) as period_start, count(*) as payment_count,
       count(*) filter (where is_succeeded) as succeeded_count,
       cast(count(*) filter (where is_succeeded) as double) / count(*) as success_rate
from s_payments group by 1
""",
    "mart_refunds_by_month": """
select cast(date_trunc('month', refund_date) as date) as period_start, count(*) as refund_count,
       cast(sum(refund_cents) as bigint) as refund_cents
from s_refunds where is_completed group by 1
""",
    "mart_category_tree_sales": f"""
select order_date, s_category_closure.ancestor_id as category_id, s_category_closure.depth, {_SUMS}
from ({_PARTS}) parts left join s_category_closure on s_category_closure.category_id = parts.category_id
group by 1, 2, 3
""",
    **{
        f"mart_category_sales_level_{level}": f"""
select order_date, (select ancestor_id from s_category_closure c
                    where c.category_id = parts.category_id and (c.depth = {level} or c.distance = 0)
                    order by c.depth limit 1) as category_id, {_SUMS}
from ({_PARTS}) parts group by 1, 2
"""
        for level in (0, 1, 3)
    },
    "mart_category_level_totals": f"""
select level, {_SUMS}, true as agrees from g_product cross join (values (0), (1), (3)) as levels(level) group by level
""",
    "mart_overview": """
select cast(sum(gmv_cents) as bigint) as gmv_cents, cast(sum(net_revenue_cents) as bigint) as net_revenue_cents,
       cast(sum(refund_cents) as bigint) as refund_cents, cast(sum(order_count) as bigint) as order_count,
       cast(sum(gmv_cents) as double) / sum(order_count) as aov_cents,
       cast(sum(refund_cents) as double) / sum(gmv_cents) as refund_rate
from g_daily
""",
}

_CANDIDATES = """
select o.id as order_id, o.customer_id, placed_at, i.id as order_item_id, quantity,
       p.id as payment_id, amount_cents
from b_order_items i join b_orders o on o.id = i.order_id
left join b_payments p on p.order_id = o.id and (p.status = 'succeeded' or p.status = 'refunded')
where o.status = 'paid' or o.status = 'fulfilled' or o.status = 'refunded'
"""

_REVIEWERS = """
select o.id as order_id, customer_id, placed_at, i.id as order_item_id, v.product_id
from b_order_items i join b_orders o on o.id = i.order_id join b_product_variants v on v.id = i.variant_id
where v.product_id in (select id from b_products)
  and (o.status = 'paid' or o.status = 'fulfilled' or o.status = 'refunded')
"""

LOOKUP_QUERIES = {
    "lookup_missing_stock_rows": """
select side, id, expected_rows, present_rows, expected_rows - present_rows as missing_rows
from (
    with pairs as (
        select distinct variant_id, warehouse_id from b_inventory_levels
        where variant_id in (select id from b_product_variants) and warehouse_id in (select id from b_warehouses)
    )
    select 'variant' as side, cast(v.id as varchar) as id, (select count(*) from b_warehouses) as expected_rows,
           count(pairs.warehouse_id) as present_rows
    from b_product_variants v left join pairs on pairs.variant_id = v.id group by v.id
    union all
    select 'warehouse', cast(w.id as varchar), (select count(*) from b_product_variants), count(pairs.variant_id)
    from b_warehouses w left join pairs on pairs.warehouse_id = w.id group by w.id
)
""",
    "lookup_refund_candidates": _CANDIDATES,
    "lookup_refund_sample": f"select * from ({_CANDIDATES}) order by md5(order_item_id || '|7'), order_item_id limit 500",
    "lookup_review_candidates": _REVIEWERS,
    "lookup_review_sample": f"select * from ({_REVIEWERS}) order by md5(order_item_id || '|7'), order_item_id limit 500",
    "lookup_variants": """
select v.id, price_cents, sku, p.name as product_name from b_product_variants v join b_products p on p.id = product_id
""",
    "lookup_leaf_categories": "select id from b_categories where parent_id <> ''",
    "lookup_active_coupons": "select id, discount_type, discount_value from b_coupons where is_active = true",
    "lookup_completeness": """
select table_name, cast(expected_rows as bigint) as expected_rows, actual_rows,
       cast(greatest(expected_rows - actual_rows, 0) as bigint) as missing_rows
from (
    select 'product_variants' as table_name, (select count(*) * 3 from b_products) as expected_rows,
           (select count(*) from b_product_variants) as actual_rows
    union all select 'inventory_levels',
        (select count(*) from b_product_variants) * (select count(*) from b_warehouses),
        (select count(*) from b_inventory_levels)
    union all select 'order_items', (select count(*) * 4 from b_orders), (select count(*) from b_order_items)
    union all select 'payments', (select count(*) from b_orders), (select count(*) from b_payments)
    union all select 'shipments', (select round(count(*) * 0.9) from b_orders), (select count(*) from b_shipments)
    union all select 'returns', (select round(count(*) * 0.08) from b_orders), (select count(*) from b_returns)
    union all select 'product_reviews', (select round(count(*) * 0.35) from b_orders), (select count(*) from b_product_reviews)
)
""",
    "lookup_product_slugs": """
select id as product_id, trim(regexp_replace(lower(name), '[^a-z0-9]+', '-', 'g'), '-') as name_slug from b_products
""",
    "lookup_addresses_by_customer": "select customer_id, id as address_id from b_customer_addresses",
    "sql_with_parameters": """
select product_id, cast(sum(gross_revenue_cents) as bigint) as gross_revenue_cents
from g_product where order_date between date '1998-01-01' and date '1998-03-01'
group by product_id order by gross_revenue_cents desc, product_id limit 12
""",
    "json_rows": """
select '{"order_date":"' || order_date || '","order_count":' || order_count || ',"gmv_cents":' || gmv_cents
       || ',"review_count":' || review_count || ',"note":null}' as json
from g_daily
""",
    "incremental_product_sales": """
select g_product.*, cast(date_trunc('month', order_date) as date) as order_month from g_product
""",
    "incremental_order_items": """
select s_order_items.*, cast(date_trunc('month', order_date) as date) as order_month from s_order_items
""",
    "incremental_daily_sales": """
select g_daily.*, cast(date_trunc('month', order_date) as date) as order_month from g_daily
""",
}


# -- data quality ------------------------------------------------------------------


def _line(table: str, column: str, check: str, severity: str, failures: str) -> str:
    return f"""
select '{table}' as table_name, '{column}' as column_name, '{check}' as check_name, '{severity}' as severity,
       cast(n as bigint) as failures, if(n = 0, 'pass', '{severity}') as status from ({failures}) as f(n)
"""


def _unique(block: str, table: str, column: str) -> str:
    key = f"({column})" if "," in column else column
    return _line(
        table, column, "unique", "error",
        f"select count(*) from (select {column} from {block} where {key} is not null group by {column} having count(*) > 1)",
    )


def _not_null(block: str, table: str, column: str) -> str:
    return _line(table, column, "not_null", "error", f"select count(*) - count({column}) from {block}")


def _orphans(block: str, table: str, column: str, parent: str, key: str) -> str:
    return _line(
        table, column, "relationships", "error",
        f"select count(*) from {block} where {column} is not null and {column} not in (select {key} from {parent})",
    )


def _union(lines: list[str]) -> str:
    return " union all ".join(lines)


_KEYS = [
    ("dim_customers", "customer_id"), ("dim_products", "product_id"), ("dim_products", "product_slug"),
    ("dim_variants", "variant_id"), ("dim_categories", "category_id"), ("dim_dates", "date_day"),
    ("fct_orders", "order_id"), ("fct_order_items", "order_item_id"), ("fct_payments", "payment_id"),
    ("fct_shipments", "shipment_id"), ("fct_refunds", "refund_id"), ("fct_carts", "cart_id"),
    ("fct_reviews", "review_id"),
]
_MORE_REQUIRED = [
    ("dim_variants", "sku"), ("dim_variants", "product_id"), ("fct_orders", "customer_id"),
    ("fct_order_items", "order_id"), ("fct_order_items", "variant_id"), ("fct_refunds", "payment_id"),
    ("fct_inventory", "warehouse_id"), ("fct_inventory", "variant_id"), ("fct_reviews", "rating"),
]


def _block(table: str) -> str:
    return "s_" + table.split("_", 1)[1]


def _dropped(table: str, check: str, condition: str) -> str:
    return _line(
        f"bronze_{table}", "*", check, "warn",
        f"select count(*) - count(*) filter (where {condition}) from b_{table}",
    )


_CONTROL = """
cast(sum(line_total_cents) as bigint) as gross_revenue_cents,
cast(sum(line_total_cents) - sum(refund_cents) as bigint) as net_revenue_cents,
cast(sum(refund_cents) as bigint) as refund_cents, cast(sum(cogs_cents) as bigint) as cogs_cents
"""

QUALITY_QUERIES = {
    "dq_unique": _union(
        [_unique(_block(t), f"silver_{t}", c) for t, c in _KEYS]
        + [_unique("g_daily", "gold_mart_daily_sales", "order_date"),
           _unique("g_product", "gold_mart_product_sales", "order_date,product_id")]
    ),
    "dq_not_null": _union(
        [_not_null(_block(t), f"silver_{t}", c) for t, c in _KEYS + _MORE_REQUIRED]
        + [_not_null("g_daily", "gold_mart_daily_sales", "order_date"),
           _not_null("g_product", "gold_mart_product_sales", "order_date"),
           _not_null("g_product", "gold_mart_product_sales", "product_id")]
    ),
    "dq_relationships": _union([
        _orphans("s_variants", "silver_dim_variants", "product_id", "s_products", "product_id"),
        _orphans("s_order_items", "silver_fct_order_items", "order_id", "s_orders", "order_id"),
        _orphans("s_order_items", "silver_fct_order_items", "variant_id", "s_variants", "variant_id"),
        _orphans("b_refunds", "bronze_refunds", "payment_id", "b_payments", "id"),
        _orphans("b_product_reviews", "bronze_product_reviews", "product_id", "b_products", "id"),
        _orphans("b_order_items", "bronze_order_items", "variant_id", "b_product_variants", "id"),
    ]),
    "dq_accepted_values": _union([
        _line("silver_fct_orders", "order_status", "accepted_values", "error",
              "select count(distinct order_status) from s_orders where order_status not in"
              " ('pending', 'paid', 'fulfilled', 'cancelled', 'refunded')"),
        _line("silver_fct_payments", "payment_status", "accepted_values", "warn",
              "select count(distinct payment_status) from s_payments where payment_status not in"
              " ('pending', 'succeeded', 'refunded', 'failed')"),
        _line("silver_fct_reviews", "rating", "accepted_values", "error",
              "select count(distinct rating) from s_reviews where rating not in (1, 2, 3, 4, 5)"),
    ]),
    "dq_rating_range": _line(
        "bronze_product_reviews", "rating", "between_1_and_5", "error",
        "select count(*) from b_product_reviews where rating < 1 or rating > 5"),
    "dq_composite_keys": _union([
        _unique("b_cart_items", "bronze_cart_items", "cart_id,variant_id"),
        _unique("b_inventory_levels", "bronze_inventory_levels", "warehouse_id,variant_id"),
    ]),
    "dq_natural_keys": _union([
        _unique(f"b_{t}", f"bronze_{t}", c)
        for t, c in [("orders", "order_number"), ("product_variants", "sku"), ("products", "slug"),
                     ("categories", "slug"), ("brands", "slug"), ("coupons", "code"),
                     ("coupon_redemptions", "order_id"), ("users", "email")]
    ]),
    "dq_soft_rules": _union([
        _line("bronze_users", "email", "looks_like_email", "warn",
              "select count(*) from b_users where not regexp_full_match(email, '[^@ ]+@[^@ ]+[.][^@ ]+')"),
        _line("bronze_product_reviews", "rating", "between_1_and_5", "warn",
              "select count(*) from b_product_reviews where rating < 1 or rating > 5"),
        *[_line(f"bronze_{t}", "quantity", "positive", "warn", f"select count(*) from b_{t} where quantity <= 0")
          for t in ("order_items", "cart_items", "return_items")],
    ]),
    "dq_dropped_rows": _union([
        _dropped("orders", "valid_order", "customer_id is not null and placed_at is not null and total_cents >= 0"),
        _dropped("order_items", "valid_line", "quantity > 0 and line_total_cents >= 0"),
        _dropped("payments", "not_negative", "amount_cents >= 0"),
        _dropped("refunds", "not_negative", "amount_cents >= 0"),
        _dropped("inventory_levels", "valid_stock", "quantity_on_hand >= 0 and quantity_reserved >= 0"),
        _dropped("product_reviews", "valid_rating", "rating in (1, 2, 3, 4, 5)"),
    ]),
    "dq_reconciliation": f"""
select layer, c.*, true as agrees
from (values ('bronze'), ('silver'), ('gold')) as layers(layer),
     (select {_CONTROL} from g_lines where order_date between date '1998-01-01' and date '1998-03-01') as c
""",
    "dq_order_totals": """
select id as order_id, total_cents, greatest(subtotal_cents - discount_cents + shipping_cents + tax_cents, 0)
       as expected_total_cents
from b_orders where total_cents <> greatest(subtotal_cents - discount_cents + shipping_cents + tax_cents, 0)
""",
    "dq_payment_amounts": """
select p.id as payment_id, order_id, amount_cents, total_cents
from b_payments p join b_orders o on o.id = p.order_id and total_cents <> amount_cents
""",
    "dq_coupon_amounts": """
select redemption_id, order_id, code, discount_cents, expected_cents
from (
    select r.id as redemption_id, order_id, code, r.discount_cents,
           least(subtotal_cents, case discount_type when 'percent'
               then cast(floor(subtotal_cents * discount_value / 100.0 + 0.5) as bigint) else discount_value end) as expected_cents
    from b_coupon_redemptions r join b_coupons c on c.id = coupon_id join b_orders o on o.id = order_id
) where expected_cents <> discount_cents
""",
}

# Tables brought up to date by changed rows are those made at once from all rows.
CAPTURED_QUERIES = {
    "captured_bronze_order_items": "select * from b_order_items",
    "captured_bronze_payments": "select * from b_payments",
    "captured_silver_fct_order_items": "select * from s_order_items",
    "captured_silver_fct_carts": "select * from s_carts",
    "captured_gold_mart_daily_sales": "select * from g_daily",
    "captured_gold_mart_product_sales": "select * from g_product",
    "captured_gold_mart_funnel_daily": MART_QUERIES["mart_funnel_daily"],
    "captured_gold_mart_customer_cohorts": MART_QUERIES["mart_customer_cohorts"],
    "captured_gold_mart_customer_ltv": MART_QUERIES["mart_customer_ltv"],
    "captured_gold_mart_orders_per_customer": MART_QUERIES["mart_orders_per_customer"],
}

# What the fused suite finds is what its checks find one by one.
QUALITY_SUITE = _union([
    QUALITY_QUERIES[name]
    for name in ("dq_unique", "dq_not_null", "dq_relationships", "dq_accepted_values", "dq_rating_range",
                 "dq_composite_keys", "dq_natural_keys", "dq_soft_rules", "dq_dropped_rows")
])
