"""Declared schemas of the bronze tables.

Money and quantities are read as long, so that no product of two columns can
overflow. Keys are text here (UUIDs at the source); ``with_keys_as`` gives the
same schemas for sources that key their rows by number.
"""

from __future__ import annotations

# Columns per table, in source order. "key" is the key type.
_COLUMNS = {
    "users": "id key, email string, password_hash string, name string,"
    " created_at timestamp_ntz, updated_at timestamp_ntz",
    "customers": "id key, user_id key, first_name string, last_name string, phone string,"
    " date_of_birth date, marketing_opt_in boolean, lifetime_value_cache decimal(12,2),"
    " created_at timestamp, updated_at timestamp",
    "customer_addresses": "id key, customer_id key, label string, line1 string, line2 string,"
    " city string, state string, postal_code string, country_code string,"
    " is_default_shipping boolean, is_default_billing boolean,"
    " created_at timestamp, updated_at timestamp",
    "categories": "id key, parent_id key, name string, slug string, path string,"
    " created_at timestamp, updated_at timestamp",
    "products": "id key, brand_id key, name string, slug string, description string,"
    " status string, created_at timestamp, updated_at timestamp",
    "product_variants": "id key, product_id key, sku string, name string, attributes string,"
    " price_cents bigint, compare_at_price_cents bigint, cost_cents bigint,"
    " weight_grams bigint, is_active boolean, created_at timestamp, updated_at timestamp",
    "inventory_levels": "warehouse_id key, variant_id key, quantity_on_hand bigint,"
    " quantity_reserved bigint, reorder_point bigint, updated_at timestamp",
    "carts": "id key, customer_id key, status string, currency_code string,"
    " created_at timestamp, updated_at timestamp",
    "cart_items": "id key, cart_id key, variant_id key, quantity bigint, unit_price_cents bigint",
    "orders": "id key, order_number string, customer_id key, cart_id key, status string,"
    " currency_code string, subtotal_cents bigint, discount_cents bigint,"
    " shipping_cents bigint, tax_cents bigint, total_cents bigint, shipping_address_id key,"
    " billing_address_id key, placed_at timestamp, created_at timestamp, updated_at timestamp",
    "order_items": "id key, order_id key, variant_id key, product_name_snapshot string,"
    " sku_snapshot string, quantity bigint, unit_price_cents bigint, discount_cents bigint,"
    " tax_cents bigint, line_total_cents bigint",
    "payments": "id key, order_id key, payment_method_id key, amount_cents bigint,"
    " status string, provider_ref string, paid_at timestamp, created_at timestamp",
    "shipments": "id key, order_id key, shipping_method_id key, warehouse_id key,"
    " tracking_number string, status string, shipped_at timestamp, delivered_at timestamp,"
    " created_at timestamp",
    "refunds": "id key, return_id key, payment_id key, amount_cents bigint, status string,"
    " refunded_at timestamp, created_at timestamp",
    "product_reviews": "id key, product_id key, customer_id key, order_id key,"
    " rating smallint, title string, body string, is_verified_purchase boolean,"
    " created_at timestamp",
    "coupons": "id key, code string, discount_type string, discount_value bigint,"
    " min_order_cents bigint, max_redemptions bigint, starts_at timestamp, ends_at timestamp,"
    " is_active boolean",
    "coupon_redemptions": "id key, coupon_id key, order_id key, customer_id key,"
    " discount_cents bigint, redeemed_at timestamp",
    # Needed by the wider marts.
    "brands": "id key, name string, slug string, description string, is_active boolean,"
    " created_at timestamp, updated_at timestamp",
    "product_categories": "product_id key, category_id key",
    "warehouses": "id key, code string, name string, city string, country_code string,"
    " is_active boolean",
    "payment_methods": "id key, code string, name string",
    "returns": "id key, order_id key, status string, reason string, requested_at timestamp,"
    " resolved_at timestamp",
    "return_items": "id key, return_id key, order_item_id key, quantity bigint,"
    " condition string",
}

BRONZE_TABLES = list(_COLUMNS)


def with_keys_as(key_type: str) -> dict[str, str]:
    """DDL schema per table, as readers take it."""
    return {name: columns.replace(" key", f" {key_type}") for name, columns in _COLUMNS.items()}


BRONZE_SCHEMAS = with_keys_as("string")
