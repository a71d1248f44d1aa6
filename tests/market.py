"""A hand-made marketplace with the awkward cases, as raw CSV rows."""

from __future__ import annotations

import csv
from pathlib import Path

NL_TEXT = 'first line\nsecond, "quoted" line'

RAW: dict[str, tuple[list[str], list[tuple]]] = {
    "customers": (
        "customer_id customer_unique_id customer_zip_code_prefix customer_city customer_state".split(),
        [
            ("c1", "ann", " 0123 ", "SANTA BARBARA D'OESTE", "sp"),
            ("c2", "ann", "", "são paulo", " RJ "),
            (" c3 ", "bob", None, "embu-guacu", "sp"),
            ("c4", "cat", "77", "", "mg"),
            ("c5", "dan", "x1", "lost", "sp"),
            ("  ", "eve", "1", "lost", "sp"),
            ("c6", "fay", "12.345", "lost", "sp"),
            ("c7", "gus", "1", "lost", "abc"),
            ("c8", "hal", "9", "tab\there", "SP"),
        ],
    ),
    "sellers": (
        "seller_id seller_zip_code_prefix seller_city seller_state".split(),
        [("s1", "1", "SAO Paulo", "sp"), ("s2", "2", "Rio", "rj"), ("s3", "", "Idle", "mg")],
    ),
    "category_translation": (
        "product_category_name product_category_name_english".split(),
        [("livros", "books"), (" livros ", " books "), ("moveis", "furniture"), ("x", " ")],
    ),
    "products": (
        (
            "product_id product_category_name product_name_lenght product_description_lenght "
            "product_photos_qty product_weight_g product_length_cm product_height_cm "
            "product_width_cm"
        ).split(),
        [
            ("p1", "livros", "10", "200", "1", "500", "1", "2", "3"),
            ("p2", "moveis", "10", "", "1", "500", "1", "2", "3"),
            ("p3", "nunca", "10", "200", None, "500", "1", "2", "3"),
            ("p4", "  ", "10", "200", "1", "500", "1", "2", "3"),
            ("p5", "livros", "ten", "200", "1", "500", "1", "2", "3"),
        ],
    ),
    "geolocation": (
        (
            "geolocation_zip_code_prefix geolocation_lat geolocation_lng geolocation_city "
            "geolocation_state"
        ).split(),
        [
            ("1", "-23.5456789", "-46.1", "SÃO", "sp"),
            ("1", "-23.5456789", "-46.1", "SÃO", "sp"),
            (" ", "1", "1", "x", "sp"),
            ("2", "north", "1", "x", "sp"),
        ],
    ),
    "orders": (
        (
            "order_id customer_id order_status order_purchase_timestamp order_approved_at "
            "order_delivered_carrier_date order_delivered_customer_date "
            "order_estimated_delivery_date"
        ).split(),
        [
            # delivered on the promised day after midnight: late with delay 0
            ("o1", "c1", "DELIVERED", "2020-01-05 10:00:00", "2020-01-05 11:00:00",
             "2020-01-06 00:00:00", "2020-01-20 08:00:00", "2020-01-20 00:00:00"),
            # on time
            ("o2", "c2", "delivered", "2020-03-01 10:00:00", "2020-02-28 10:00:00",
             "2020-03-02 00:00:00", "2020-03-04 08:00:00", "2020-03-20 00:00:00"),
            # delivered before purchase: negative days
            ("o3", "c3", "delivered", "2020-03-10 10:00:00", "",
             "2020-03-12 00:00:00", "2020-03-09 08:00:00", "2020-03-20 00:00:00"),
            # delivered without a date
            ("o4", "c4", "delivered", "2020-03-31 23:59:59", "", "", "", "2020-04-20 00:00:00"),
            # canceled but delivered, no promise
            ("o5", "c4", "canceled", "2020-04-02 10:00:00", "", "", "2020-05-10 00:00:00", ""),
            # no lines
            ("o6", "c8", "unavailable", "2020-06-02 10:00:00", "", "", "", ""),
            ("o7", "c8", "delivered", "soon", "", "", "", ""),
            ("o8", "", "delivered", "2020-06-02 10:00:00", "", "", "", ""),
        ],
    ),
    "order_items": (
        (
            "order_id order_item_id product_id seller_id shipping_limit_date price freight_value"
        ).split(),
        [
            ("o1", "1", "p1", "s1", "2020-01-10 00:00:00", "100.00", "10.00"),
            ("o1", "2", "p2", "s2", "", "50.005", "60"),
            (" o2 ", "1", "p1", "s1", "", "200", "20"),
            ("o3", "1", "p3", "s1", "", "-5", ""),
            ("o4", "1", "p4", "s2", "", "", "1.00"),
            ("o5", "1", "p1", "s2", "", "30", "3"),
            ("zz", "1", "p1", "s1", "", "1", "1"),
            ("o1", "3", "zz", "s1", "", "1", "1"),
            ("o1", "4", "p1", "zz", "", "1", "1"),
            ("o1", "five", "p1", "s1", "", "1", "1"),
            ("o1", "6", "p1", "s1", "", "free", "1"),
            ("o1", "7", "p1", "s1", "", "12345678901.00", "1"),
        ],
    ),
    "order_payments": (
        "order_id payment_sequential payment_type payment_installments payment_value".split(),
        [
            ("o1", "2", "VOUCHER", "1", "10"),
            ("o1", "1", "Credit_Card", "8", "150.5"),
            ("o2", "1", "slip", "", "-4"),
            ("o4", "1", "slip", "2", ""),
            ("zz", "1", "slip", "2", "5"),
        ],
    ),
    "order_reviews": (
        (
            "review_id order_id review_score review_comment_title review_comment_message "
            "review_creation_date review_answer_timestamp"
        ).split(),
        [
            ("r1", "o1", "0", " ", NL_TEXT, "2020-02-01 00:00:00", ""),
            ("r2", "o1", "4", "title", "", "2020-02-05 00:00:00", ""),
            # one id twice: the later creation date wins
            ("r3", "o2", "2", "", "", "2020-04-01 00:00:00", ""),
            ("r3", "o3", "9", "", "msg", "2020-04-02 00:00:00", ""),
            # equal dates: the smaller order id wins
            ("r4", "o4", "3", "", "", "2020-04-03 00:00:00", ""),
            ("r4", "o5", "5", "", "", "2020-04-03 00:00:00", ""),
            # two undated reviews of one order
            ("r6", "o5", "1", "", "", "", ""),
            ("r5", "o5", "5", "", "", "", ""),
            ("r7", "o1", "", "", "", "2020-02-01 00:00:00", ""),
            ("r8", "zz", "5", "", "", "2020-02-01 00:00:00", ""),
        ],
    ),
    "qualified_leads": (
        "mql_id first_contact_date landing_page_id origin".split(),
        [
            ("m1", "2020-01-01", "l", "Organic"),
            ("m2", "2020-01-01", "l", " "),
            ("m3", "2020-01-10", "l", None),
            ("m4", "2020-01-10", "l", "paid"),
            ("m5", "", "l", "paid"),
            ("m6", "someday", "l", "paid"),
        ],
    ),
    "closed_deals": (
        (
            "mql_id seller_id sdr_id sr_id won_date business_segment lead_type "
            "lead_behaviour_profile has_company has_gtin average_stock business_type "
            "declared_product_catalog_size declared_monthly_revenue"
        ).split(),
        [
            # two deals of one seller
            ("m1", "s1", "a", "b", "2020-01-05", "", "", "", "TRUE", "no", "", "reseller", "", "10.10"),
            ("m2", "s1", "a", "b", "2020-03-05", "", "", "", "maybe", "", "", "", "5.5", "0"),
            # no seller, won before contact
            ("m3", "", "a", "b", "2020-01-05", "", "", "", "", "", "", "reseller", "", ""),
            ("zz", "s2", "a", "b", "2020-01-05", "", "", "", "", "", "", "reseller", "", ""),
            ("m4", "s2", "a", "b", "", "", "", "", "", "", "", "reseller", "", ""),
        ],
    ),
}

FILE_NAMES = {
    "customers": "shop_customers_dataset.csv",
    "sellers": "shop_sellers_dataset.csv",
    "category_translation": "product_category_name_translation.csv",
    "products": "shop_products_dataset.csv",
    "geolocation": "shop_geolocation_dataset.csv",
    "orders": "shop_orders_dataset.csv",
    "order_items": "shop_order_items_dataset.csv",
    "order_payments": "shop_order_payments_dataset.csv",
    "order_reviews": "shop_order_reviews_dataset.csv",
    "qualified_leads": "shop_marketing_qualified_leads_dataset.csv",
    "closed_deals": "shop_closed_deals_dataset.csv",
}


def raw_frames(spark) -> dict:
    return {
        name: spark.createDataFrame(data, ", ".join(f"{c} string" for c in columns))
        for name, (columns, data) in RAW.items()
    }


def write_csv(folder: Path) -> None:
    for name, (columns, data) in RAW.items():
        with open(folder / FILE_NAMES[name], "w", newline="", encoding="utf-8") as f:
            out = csv.writer(f)
            out.writerow(columns)
            out.writerows([["" if v is None else v for v in row] for row in data])
