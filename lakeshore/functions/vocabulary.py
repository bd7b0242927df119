"""Fixed values of the business and the schemas of its inputs."""

from __future__ import annotations

# Event types in the order of their event_id, from 1.
EVENT_TYPES = [
    "home_screen_view", "search", "view_item", "select_item_variant", "add_to_cart", "view_cart", "remove_from_cart",
    "update_cart_item", "begin_checkout", "add_shipping_info", "add_coupon", "add_payment_info", "place_order", "payment_callback",
]
BUCKETS = {"discovery": range(1, 5), "cart": range(5, 9), "checkout": range(9, 15)}

# Order statuses. STOCK is work in hand, FLOW is closed; F (payment failed) is in neither.
STATUSES = "WRODICBPF"
STOCK, FLOW = ("W", "O", "D", "P"), ("I", "B", "C", "R")
NEW, RETAINED, RESURRECTED = 1, 2, 3
INSERTED, UPDATED, DELETED = 0, 1, 2
# Upper bounds of the aging categories in days, and their names.
AGING = [(1, "<", "<1"), (3, "<=", "<=3"), (7, "<=", "<=7"), (14, "<=", "<=14"), (28, "<=", "<=28")]

# The fields of the metadata of an event; each event type fills some.
METADATA = (
    "source_screen string, source_element string, position int, app_version string, search_keyword string, result_count int, "
    "product_id string, product_name string, base_price bigint, variant_type string, variant_value string, variant_color string, "
    "variant_size string, quantity int, removed_quantity int, cart_total_value bigint, total_items int, items_list array<string>, "
    "action_type string, old_quantity int, new_quantity int, shipping_method string, shipping_fee bigint, city_province string, "
    "promotion_id string, promotion_type string, discount_amount bigint, is_valid int, error_message string, payment_method string, "
    "final_amount bigint, order_id string, transaction_id string, is_success int, error_code string"
)
# An event as its producer sends it.
ENVELOPE = (
    "event_uuid string, event_id int, event_type string, timestamp bigint, log_date string, created_at string, session_id string, "
    f"user_id string, device_os string, app_version string, metadata struct<{METADATA}>"
)
# Fields of a bucket's events beside those that all events have.
FIELDS = {
    "discovery": ["source_screen", "source_element", "position", "search_keyword", "result_count", "product_id", "product_name", "base_price", "variant_type", "variant_value"],
    "cart": ["source_screen", "source_element", "product_id", "variant_color", "variant_size", "quantity", "removed_quantity", "action_type", "old_quantity", "new_quantity", "total_items", "cart_total_value"],
    "checkout": [
        "items_list", "shipping_method", "shipping_fee", "city_province", "promotion_id", "promotion_type", "discount_amount", "is_valid",
        "error_message", "payment_method", "final_amount", "order_id", "transaction_id", "is_success", "error_code",
    ],
}

# ERP tables as declared; readers cast to these.
ERP = {
    "customers": "customer_id string, first_name string, last_name string, phone string, dob date, age int, gender int, address_line string, is_deleted int, registered_datetime timestamp, created_at timestamp, updated_at timestamp, source string",
    "category": "category_id string, category_name string, is_current boolean, created_at timestamp, updated_at timestamp",
    "products": "product_id string, product_name string, product_display_name string, category_id string, sales_unit string, color string, size string, unit_price decimal(15,2), created_at timestamp, updated_at timestamp, is_current boolean",
    "branches": "branch_id string, branch_name string, branch_type string, region string, city_province string, ward string, status string, open_date date, created_at timestamp, updated_at timestamp, is_current boolean",
    "pos_transactions": "transaction_id string, branch_id string, transaction_datetime timestamp, payment_type string, trans_total_amount decimal(15,2), trans_total_line int, trans_total_sell_sku int, customer_id string, order_status string, delivery_date date, created_at timestamp, updated_at timestamp",
    "online_transactions": "transaction_id string, branch_id string, transaction_datetime timestamp, payment_type string, trans_total_amount decimal(15,2), customer_id string, order_status string, delivery_date date, created_at timestamp, updated_at timestamp",
    "pos_transaction_details": "transaction_detail_id string, transaction_id string, branch_id string, product_id string, is_promo int, product_uom_code string, trans_qty int, trans_line_amount decimal(15,2), variant_size string, variant_color string, created_at timestamp",
    "online_transaction_details": "transaction_detail_id string, transaction_id string, product_id string, is_promo int, product_uom_code string, trans_qty int, trans_line_amount decimal(15,2), variant_size string, variant_color string, created_at timestamp",
}
