"""The commerce tables again, as SQL over the given parquet views."""

BRONZE = {}

BRONZE["b_users"] = """
select c_custkey as id,
       replace(lower(c_name), '#', '.') || case when c_custkey % 41 = 0 then '' else '@example.com' end as email,
       'x' as password_hash, c_name as name,
       timestamp '1995-01-01' as created_at, timestamp '1995-01-01' as updated_at
from customer
"""

BRONZE["b_customers"] = """
select c_custkey as id, c_custkey as user_id,
       case when c_custkey % 100 = 0 then '  ' else ' ' || split_part(c_name, '#', 1) end as first_name,
       case when c_custkey % 50 = 0 then '  ' else split_part(c_name, '#', 2) || ' ' end as last_name,
       cast(null as varchar) as phone,
       cast(date '1950-01-01' + cast(c_custkey % 18000 as integer) as date) as date_of_birth,
       case when c_custkey % 7 = 0 then null else c_custkey % 2 = 0 end as marketing_opt_in,
       cast(c_acctbal as decimal(12,2)) as lifetime_value_cache,
       timestamp '1995-01-01' + to_days(cast(c_custkey % 365 as integer)) as created_at,
       timestamp '1995-01-01' + to_days(cast(c_custkey % 365 as integer)) as updated_at
from customer
"""

BRONZE["b_customer_addresses"] = """
select o_custkey * 10 + cast(left(o_orderpriority, 1) as bigint) as id,
       o_custkey as customer_id, o_orderpriority as label,
       'Street ' || o_custkey as line1, cast(null as varchar) as line2,
       any_value(n_name) as city, any_value(r_name) as state,
       'Z' || o_custkey as postal_code,
       lpad(cast(any_value(n_nationkey) as varchar), 2, '0') as country_code,
       o_orderpriority <> '5-LOW' as is_default_shipping,
       o_orderpriority = '1-URGENT' as is_default_billing,
       min(o_orderdate) as created_at, max(o_orderdate) as updated_at
from orders
join customer on c_custkey = o_custkey
join nation on n_nationkey = c_nationkey
join region on r_regionkey = n_regionkey
group by o_custkey, o_orderpriority
"""

BRONZE["b_brands"] = """
select distinct replace(lower(p_brand), '#', '-') as id, p_brand as name,
       replace(lower(p_brand), '#', '-') as slug, cast(null as varchar) as description,
       true as is_active, timestamp '1995-01-01' as created_at, timestamp '1995-01-01' as updated_at
from part
"""

BRONZE["b_categories"] = """
select id, parent_id, name, ' ' || upper(replace(id, '/', '-')) as slug, id as path,
       timestamp '1995-01-01' as created_at, timestamp '1995-01-01' as updated_at
from (
    select distinct lower(p_type) as id, cast(null as varchar) as parent_id, ' ' || p_type as name from part
    union all
    select distinct lower(p_type) || '/' || replace(lower(p_brand), '#', '-'), lower(p_type), p_brand || ' ' from part
    union all
    select distinct 'size/' || p_size, case when p_size > 1 then 'size/' || (p_size - 1) end, 'Size ' || p_size from part
    union all
    select distinct 'odd/' || p_size, 'odd/' || parent, 'Odd ' || p_size
    from part join (values (7, 8), (8, 7), (9, 8), (10, 0)) as odd(size, parent) on size = p_size
)
"""

BRONZE["b_product_categories"] = """
select p_partkey as product_id, lower(p_type) || '/' || replace(lower(p_brand), '#', '-') as category_id
from part where p_size <> 25
union all
select p_partkey, lower(p_type) from part where p_size > 25
union all
select p_partkey, 'size/' || p_size from part where p_size % 3 = 0
union all
select p_partkey, 'odd/' || p_size from part where p_size in (7, 9, 10)
"""

BRONZE["b_products"] = """
select p_partkey as id, replace(lower(p_brand), '#', '-') as brand_id,
       '  ' || p_name || ' ' || p_partkey || ' ' as name,
       ' ' || upper(replace(p_name, ' ', '-')) || '-' || p_partkey as slug,
       p_type as description,
       case when p_size % 10 = 0 then 'draft' when p_size % 11 = 0 then ' Active'
            when p_size % 13 = 0 then 'published' else 'active' end as status,
       timestamp '1995-01-01' + to_days(p_size) as created_at,
       timestamp '1995-01-01' + to_days(p_size) as updated_at
from part
"""

BRONZE["b_product_variants"] = """
select p_partkey * 3 + v as id, p_partkey as product_id,
       ' sku-' || p_partkey || '-' || v || ' ' as sku,
       p_type || ' / ' || v || ' ' as name,
       '{"color":"' || split_part(p_name, ' ', 1) || '","size":"' || v || '"}' as attributes,
       price as price_cents,
       case when v > 0 then price * 120 // 100 end as compare_at_price_cents,
       case when not (v = 2 and p_partkey % 5 = 0) then price * 40 // 100 end as cost_cents,
       cast(p_size as bigint) * 100 as weight_grams,
       case when p_partkey % 13 <> 0 then v < 2 end as is_active,
       timestamp '1995-01-01' as created_at, timestamp '1995-01-01' as updated_at
from (
    select p_partkey, p_name, p_type, p_size, v, cast(round(p_retailprice * 100) as bigint) + v * 100 as price
    from part, (values (cast(0 as bigint)), (1), (2)) as three(v)
)
"""

BRONZE["b_product_reviews"] = """
select event_id as id, user_id * 10 + event_id % 10 as product_id, user_id as customer_id,
       cast(null as bigint) as order_id, cast(event_id % 7 as smallint) as rating,
       case when event_id % 4 = 0 then '  ' else ' Great ' end as title,
       case when event_id % 5 <> 0 then 'value ' || cast(round(value * 100) as bigint) end as body,
       case when event_id % 3 <> 0 then event_id % 3 = 1 end as is_verified_purchase,
       timestamp '1995-01-01' + to_days(cast(event_id % 2400 as integer)) as created_at
from events where event_type = 'view' or event_type = 'click'
"""

BRONZE["b_warehouses"] = """
select cast(n_nationkey as bigint) as id, ' wh-' || n_nationkey as code, n_name || ' DC ' as name,
       n_name as city, lpad(cast(n_nationkey as varchar), 2, '0') as country_code,
       n_nationkey <> 24 as is_active
from nation
"""

BRONZE["b_inventory_levels"] = """
select l_suppkey % 25 as warehouse_id, l_partkey * 3 + l_suppkey % 3 as variant_id,
       cast(sum(cast(l_quantity as bigint)) - 8 as bigint) as quantity_on_hand,
       cast(sum(case when l_linestatus = 'O' then cast(l_quantity as bigint) else 0 end) as bigint) as quantity_reserved,
       case when (l_partkey * 3 + l_suppkey % 3) % 9 <> 0 then cast(20 as bigint) end as reorder_point,
       max(l_shipdate) as updated_at
from lineitem
group by l_suppkey % 25, l_partkey * 3 + l_suppkey % 3
"""

BRONZE["order_basis"] = """
select *, case when id % 499 = 0 then cast(-1 as bigint)
               else greatest(subtotal - discount + shipping + tax, 0) end as total
from (
    select *, (subtotal - discount) * 8 // 100 as tax
    from (
        select *,
               case when not redeemed then cast(0 as bigint)
                    when digit = 1 then least((subtotal * 10 + 50) // 100, subtotal)
                    when digit = 2 then least(cast(500 as bigint), subtotal)
                    when digit = 3 then least(cast(499 as bigint), subtotal)
                    else least((subtotal * 20 + 50) // 100, subtotal) end as discount,
               cast(case when status = 'cancelled' then 0 when digit = 1 then 1499
                         when digit = 2 then 999 else 499 end as bigint) as shipping
        from (
            select o_orderkey as id, o_custkey as customer_id, digit,
                   o_orderstatus = 'F' and digit < 5 as redeemed,
                   case when digit <> 4 then o_orderkey end as cart_id,
                   case when o_orderkey % 97 = 0 then ' Paid'
                        when o_orderstatus = 'F' then 'fulfilled'
                        when o_orderstatus = 'P' then 'paid'
                        when digit < 3 then 'refunded'
                        when digit = 5 then 'cancelled' else 'pending' end as status,
                   cast(round(o_totalprice * 100) as bigint) as subtotal,
                   o_orderdate + to_minutes(o_orderkey % 1440) as placed_at
            from (select *, cast(left(o_orderpriority, 1) as bigint) as digit from orders)
        )
    )
)
"""

BRONZE["b_orders"] = """
select id, 'ORD-' || id as order_number, customer_id, cart_id, status, 'usd ' as currency_code,
       subtotal as subtotal_cents, discount as discount_cents, shipping as shipping_cents,
       tax as tax_cents, total as total_cents,
       customer_id * 10 + digit as shipping_address_id, customer_id * 10 + digit as billing_address_id,
       placed_at, placed_at as created_at, placed_at + to_days(1) as updated_at
from order_basis
"""

BRONZE["line_basis"] = """
select *, list_cents - discount_cents as line_total_cents
from (
    select *,
           l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey || '-'
               || cast(l_quantity as bigint) || '-' || cast(round(l_extendedprice * 100) as bigint) as line_key,
           l_partkey * 3 + l_suppkey % 3 as variant_id,
           cast(l_quantity as bigint) as quantity,
           cast(round(l_extendedprice * 100) as bigint) as list_cents,
           cast(round(l_extendedprice * 100) as bigint) * cast(round(l_discount * 100) as bigint) // 100 as discount_cents
    from lineitem
)
"""

BRONZE["b_order_items"] = """
select line_key as id, l_orderkey as order_id, variant_id,
       case when l_partkey % 17 = 0 then '  ' else ' Part ' || l_partkey end as product_name_snapshot,
       'sku-' || l_partkey || '-' || l_suppkey % 3 || ' ' as sku_snapshot,
       quantity, list_cents // quantity as unit_price_cents, discount_cents,
       line_total_cents * cast(round(l_tax * 100) as bigint) // 100 as tax_cents,
       line_total_cents
from line_basis
"""

BRONZE["b_carts"] = """
select cart_id as id, customer_id, 'converted' as status, ' usd' as currency_code,
       placed_at - to_minutes(30) as created_at, placed_at as updated_at
from order_basis where cart_id is not null
union all
select -1 - event_id, user_id,
       case event_id % 3 when 0 then 'active' when 1 then ' Abandoned' else 'expired' end, ' usd',
       timestamp '1995-01-01' + to_days(cast(event_id % 2400 as integer)),
       timestamp '1995-01-01' + to_days(cast(event_id % 2400 as integer))
from events where event_type = 'view'
"""

BRONZE["b_cart_items"] = """
select cart_id || ':' || variant_id as id, cart_id, variant_id, quantity, unit_price_cents
from (
    select l_orderkey as cart_id, variant_id, cast(sum(quantity) as bigint) as quantity,
           min(list_cents // quantity) as unit_price_cents
    from line_basis
    where l_orderkey in (select cart_id from order_basis where cart_id is not null)
    group by l_orderkey, variant_id
    union all
    select -1 - event_id, user_id * 3 + event_id % 3, 1 + event_id % 4, cast(round(value * 100) as bigint)
    from events where event_type = 'view' and value > 20
)
"""

BRONZE["b_payments"] = """
select id, id as order_id, least(digit, 4) as payment_method_id,
       total + case when id % 307 = 0 then 5 else 0 end as amount_cents,
       case when id % 211 = 0 then 'chargeback' when id % 89 = 0 then ' Succeeded'
            when id % 53 = 0 then 'failed' when status in ('pending', 'refunded') then status
            else 'succeeded' end as status,
       'pay_' || id as provider_ref,
       case when status <> 'pending' then placed_at + to_minutes(30) end as paid_at,
       placed_at as created_at
from order_basis where status <> 'cancelled'
"""

BRONZE["b_shipments"] = """
select id, id as order_id, 1 + id % 3 as shipping_method_id, shipper % 25 as warehouse_id,
       'TRK' || id as tracking_number,
       case when id % 11 = 0 then 'shipped' when id % 19 = 0 then 'Delivered ' else 'delivered' end as status,
       case when id % 13 <> 0 then left_at end as shipped_at,
       case when id % 11 <> 0 then left_at + to_days(cast(id % 7 as integer)) end as delivered_at,
       created_at
from (
    select l_orderkey as id, min(l_shipdate) as created_at, min(l_suppkey) as shipper,
           min(l_shipdate) + to_minutes(l_orderkey % 600) as left_at
    from lineitem where l_linestatus = 'F' group by l_orderkey
)
"""

BRONZE["b_coupons"] = """
select c.id, code, discount_type, cast(discount_value as bigint) as discount_value,
       cast(min_order_cents as bigint) as min_order_cents, cast(max_redemptions as bigint) as max_redemptions,
       cast(null as timestamp) as starts_at, cast(null as timestamp) as ends_at, is_active
from (values (1, 'WELCOME10', 'percent', 10, 2000, null, true),
             (2, 'SAVE500', 'fixed', 500, 5000, null, true),
             (3, 'FREESHIP', 'fixed', 499, 3000, 10000, true),
             (4, 'VIP20', 'percent', 20, 10000, 1000, true),
             (5, 'LAPSED5', 'percent', 5, null, null, false))
     as listed(id, code, discount_type, discount_value, min_order_cents, max_redemptions, is_active)
join (select distinct cast(left(o_orderpriority, 1) as bigint) as id from orders) c on c.id = listed.id
"""

BRONZE["b_coupon_redemptions"] = """
select id, digit as coupon_id, id as order_id, customer_id,
       discount + case when id % 101 = 0 then 1 else 0 end as discount_cents, placed_at as redeemed_at
from order_basis where redeemed
"""

BRONZE["b_payment_methods"] = """
select m.id, upper(code) as code, name || ' ' as name
from (values (1, 'card', 'Credit Card'), (2, 'paypal', 'PayPal'), (3, 'gcash', 'GCash'),
             (4, 'cod', 'Cash on Delivery')) as listed(id, code, name)
join (select distinct least(cast(left(o_orderpriority, 1) as bigint), 4) as id from orders) m on m.id = listed.id
"""

BRONZE["b_returns"] = """
select 'ret-' || line_key as id, l_orderkey as order_id,
       case l_linenumber % 4 when 0 then 'requested' when 1 then ' Approved'
            when 2 then 'received' else 'rejected' end as status,
       (['too_small', 'too_large', 'damaged', 'not_as_described', 'changed_mind', 'wrong_item'])[l_partkey % 6 + 1] as reason,
       l_shipdate + to_days(3) as requested_at,
       case when l_linenumber % 4 <> 0 then l_shipdate + to_days(3) end as resolved_at
from line_basis where l_returnflag = 'R'
"""

BRONZE["b_return_items"] = """
select 'ri-' || line_key as id, 'ret-' || line_key as return_id, line_key as order_item_id,
       least(quantity, 1 + quantity % 2) as quantity,
       (['unopened', 'used', 'damaged'])[l_suppkey % 3 + 1] as condition
from line_basis where l_returnflag = 'R'
"""

BRONZE["b_refunds"] = """
select 'rf-' || line_key as id, 'ret-' || line_key as return_id, l_orderkey as payment_id,
       line_total_cents // 2 as amount_cents,
       case l_linenumber when 7 then 'pending' when 6 then ' Completed' else 'completed' end as status,
       case when l_linenumber <> 7 then l_shipdate + to_days(1) end as refunded_at,
       l_shipdate as created_at
from line_basis where l_returnflag = 'R' and l_linestatus = 'F'
"""
