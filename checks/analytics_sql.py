"""Product analytics of the demo window as SQL over the gold blocks."""

_WINDOW = "order_date between date '1998-01-01' and date '1998-03-01'"

ANALYTICS = {}

ANALYTICS["a_days"] = f"""
select order_date, product_id, product_name, sku_count, order_count, units_sold, gross_revenue_cents,
       refund_cents, net_revenue_cents, discount_cents, cogs_cents, gross_margin_cents
from g_product where {_WINDOW}
"""

ANALYTICS["a_daily"] = f"select * from g_daily where {_WINDOW}"

ANALYTICS["a_product"] = """
select product_id, min(product_name) as product_name, max(sku_count) as sku_count,
       cast(sum(gross_revenue_cents) as bigint) as gross_revenue_cents,
       cast(sum(net_revenue_cents) as bigint) as net_revenue_cents,
       cast(sum(refund_cents) as bigint) as refund_cents, cast(sum(discount_cents) as bigint) as discount_cents,
       cast(sum(cogs_cents) as bigint) as cogs_cents, cast(sum(units_sold) as bigint) as units_sold,
       cast(sum(order_count) as bigint) as order_count,
       row_number() over (order by sum(gross_revenue_cents) desc, product_id) as place,
       cast(sum(sum(gross_revenue_cents)) over () as bigint) as everything,
       count(*) over () as products
from a_days group by product_id
"""

ANALYTICS["a_totals"] = """
select cast(ifnull(sum(gross_revenue_cents), 0) as bigint) as gross_revenue_cents,
       cast(ifnull(sum(net_revenue_cents), 0) as bigint) as net_revenue_cents,
       cast(ifnull(sum(refund_cents), 0) as bigint) as refund_cents,
       cast(ifnull(sum(discount_cents), 0) as bigint) as discount_cents,
       cast(ifnull(sum(cogs_cents), 0) as bigint) as cogs_cents,
       cast(ifnull(sum(units_sold), 0) as bigint) as units_sold,
       (select cast(ifnull(sum(order_count), 0) as bigint) from a_daily) as order_count,
       cast(0 as bigint) as line_item_count, count(distinct product_id) as product_count,
       (select cast(sum(cast(avg_rating * review_count as decimal(28,6))) as double) / sum(review_count) from a_daily where review_count > 0)
           as avg_rating,
       (select cast(ifnull(sum(review_count), 0) as bigint) from a_daily) as review_count
from a_days
"""

ANALYTICS["a_series"] = """
select order_date as date, cast(sum(gross_revenue_cents) as bigint) as gross_revenue_cents,
       cast(sum(net_revenue_cents) as bigint) as net_revenue_cents,
       cast(sum(refund_cents) as bigint) as refund_cents, cast(sum(discount_cents) as bigint) as discount_cents,
       cast(sum(units_sold) as bigint) as units_sold,
       (select any_value(order_count) from a_daily where a_daily.order_date = a_days.order_date) as order_count
from a_days group by order_date
"""


def _half_up(value: str, digits: int) -> str:
    scale = 10**digits
    return f"floor(({value}) * {scale} + 0.5) / {scale}"


def _whole(value: str) -> str:
    return f"cast(floor(({value}) + 0.5) as bigint)"


ANALYTICS["a_top"] = f"""
select product_id, product_name, sku_count, gross_revenue_cents, net_revenue_cents, refund_cents, discount_cents,
       cogs_cents, units_sold, order_count, gross_revenue_cents - cogs_cents as gross_margin_cents,
       {_half_up("cast(gross_revenue_cents - cogs_cents as double) / gross_revenue_cents * 100", 2)} as gross_margin_pct,
       {_half_up("cast(gross_revenue_cents as double) / everything * 100", 2)} as revenue_share_pct,
       {_whole("cast(gross_revenue_cents as double) / units_sold")} as avg_unit_price_cents
from a_product where place <= 15
"""

ANALYTICS["a_refunded"] = f"""
select product_id, product_name, refund_cents, units_sold,
       {_half_up("cast(refund_cents as double) / (sum(refund_cents) over ()) * 100", 2)} as refund_share_pct,
       {_whole("cast(refund_cents as double) / units_sold")} as refund_per_unit_cents
from a_product where refund_cents > 0
order by refund_cents desc, product_id limit 15
"""

ANALYTICS_QUERIES = {
    "product_days": "select * from a_days",
    "summary_totals": "select * from a_totals",
    "summary": f"""
select a_totals.* exclude (avg_rating), {_half_up("avg_rating", 2)} as avg_rating,
       gross_revenue_cents - cogs_cents as gross_margin_cents,
       {_half_up("cast(gross_revenue_cents - cogs_cents as double) / gross_revenue_cents * 100", 2)} as gross_margin_pct,
       {_whole("cast(gross_revenue_cents as double) / order_count")} as aov_cents,
       {_half_up("cast(refund_cents as double) / gross_revenue_cents", 4)} as refund_rate
from a_totals
""",
    "revenue_over_time": "select * from a_series order by date",
    "top_products": "select * from a_top order by gross_revenue_cents desc, product_id",
    "portfolio_ranks": """
select product_id, gross_revenue_cents, place as revenue_rank, everything as total_gross, products as product_count,
       cast(gross_revenue_cents as double) / everything as share
from a_product order by place
""",
    "portfolio_buckets": f"""
select tier, label, count(product_id) as product_count,
       cast(ifnull(sum(gross_revenue_cents), 0) as bigint) as gross_revenue_cents,
       {_half_up("ifnull(cast(sum(gross_revenue_cents) as double) / max(everything) * 100, 0)", 2)} as revenue_share_pct
from (values ('top10', 'Top 10 products', 1, 10), ('next40', 'Next 40 products', 11, 50),
             ('longTail', 'Long tail', 51, 9000000000)) as tiers(tier, label, low, high)
left join a_product on place between low and high
group by tier, label
""",
    "portfolio_concentration": f"""
select {_half_up("sum(power(cast(gross_revenue_cents as double) / everything, 2))", 4)} as herfindahl_index,
       {_half_up("cast(sum(gross_revenue_cents) filter (where place <= 10) as double) / max(everything) * 100", 2)}
           as top10_revenue_share_pct,
       {_half_up("cast(sum(gross_revenue_cents) filter (where place <= 50) as double) / max(everything) * 100", 2)}
           as top50_revenue_share_pct
from a_product
""",
    "refund_summary": f"""
select refund_cents, gross_revenue_cents,
       (select cast(sum(refunded_order_count) as bigint) from a_daily) as refunded_order_count,
       {_half_up("cast(refund_cents as double) / gross_revenue_cents", 4)} as refund_rate
from a_totals
""",
    "refunds_over_time": """
select date, a_series.refund_cents, refunded_order_count
from a_series join a_daily on order_date = date order by 1
""",
    "refunds_by_product": "select * from a_refunded",
    "revenue_chart": """
select date, substr(cast(date as varchar), 6) as label,
       floor(gross_revenue_cents / 100 * 100 + 0.5) / 100 as gross, floor(net_revenue_cents / 100 * 100 + 0.5) / 100 as net,
       floor(refund_cents / 100 * 100 + 0.5) / 100 as refund,
       gross_revenue_cents as gross_cents, net_revenue_cents as net_cents, refund_cents
from a_series order by date
""",
    "top_products_chart": """
select case when length(product_name) > 28 then left(product_name, 26) || '…' else product_name end as name,
       product_name as full_name, floor(gross_revenue_cents / 100 * 100 + 0.5) / 100 as revenue,
       gross_revenue_cents as revenue_cents, revenue_share_pct as share, units_sold as units,
       gross_margin_pct as margin_pct
from (select * from a_top order by gross_revenue_cents desc, product_id limit 10)
order by gross_revenue_cents, product_id desc
""",
    "refunds_chart": """
select case when length(product_name) > 24 then left(product_name, 22) || '…' else product_name end as name,
       product_name as full_name, floor(refund_cents / 100 * 100 + 0.5) / 100 as refund, refund_share_pct as share
from (select * from a_refunded order by refund_cents desc, product_id limit 8)
order by refund_cents, product_id desc
""",
}


def _figures(section: str, item: str) -> str:
    """Rows of (section, item, key, value) of one section."""
    texts = ("product_name", "label", "tier", "date", "product_id")
    named = f"select '{section}' as section, {item} as item, columns(lambda c: c not in {texts}) from ({ANALYTICS_QUERIES[section]})"
    return (
        f"select section, item, key, cast(value as decimal(28,6)) as value from (unpivot ({named})"
        " on columns(* exclude (section, item))::decimal(28,6) into name key value value)"
    )


ANALYTICS_QUERIES["bundle"] = " union all ".join(
    _figures(section, item)
    for section, item in (
        ("summary", "''"), ("revenue_over_time", "cast(date as varchar)"), ("top_products", "cast(product_id as varchar)"),
        ("portfolio_concentration", "''"), ("portfolio_buckets", "tier"), ("refund_summary", "''"),
        ("refunds_over_time", "cast(date as varchar)"), ("refunds_by_product", "cast(product_id as varchar)"),
    )
)
