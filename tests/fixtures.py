"""Small source frames and files shared by the tests."""

from __future__ import annotations

from pathlib import Path

from tallyroll.contracts import PRODUCTS, SALES, STORES

FILES = {
    "Sales.csv": (
        "Order Number,Line Item,Order Date,Delivery Date,CustomerKey,StoreKey,ProductKey,Quantity,Currency Code\n"
        "71,4,3/9/2023,3/11/2023,508,0,36,5,EUR\n"
    ),
    "Products.csv": (
        "ProductKey,Product Name,Brand,Color,Unit Cost USD,Unit Price USD,SubcategoryKey,Subcategory,CategoryKey,Category\n"
        "36,Desk lamp,Lumo,Green,$6.40,$9.15,07,Lamps,3,Lighting\n"
    ),
    "Stores.csv": "StoreKey,Country,State,Square Meters,Open Date\n0,Online,Online,,5/2/2011\n",
}

SALE = {
    "order_number": "31",
    "line_item": "2",
    "order_date": "11/30/2022",
    "delivery_date": "",
    "customer_key": "440",
    "store_key": "6",
    "product_key": "17",
    "quantity": "4",
    "currency_code": "GBP",
}
PRODUCT = {
    "product_key": "17",
    "product_name": "Oak shelf",
    "brand": "Holm",
    "color": "Brown",
    "unit_cost_usd": "$2,310.55 ",
    "unit_price_usd": " $2,899.80",
    "subcategory_key": "05",
    "subcategory": "Shelves",
    "category_key": "9",
    "category": "Furniture",
}
STORE = {"store_key": "6", "country": "Norway", "state": "Viken", "square_meters": "210", "open_date": "4/17/2015"}
ONLINE_SALE = SALE | {
    "order_number": "32",
    "order_date": "12/4/2022",
    "delivery_date": "12/9/2022",
    "store_key": "0",
    "quantity": "7",
    "currency_code": "USD",
}
ONLINE_STORE = STORE | {"store_key": "0", "country": "Online", "state": "Online"}


def write_files(directory: Path, **replaced: str | bytes) -> str:
    """The one-row source files; keywords such as ``Sales`` replace a file's contents."""
    directory.mkdir(parents=True, exist_ok=True)
    for name, contents in FILES.items():
        text = replaced.get(name.removesuffix(".csv"), contents)
        (directory / name).write_bytes(text if isinstance(text, bytes) else text.encode())
    return str(directory)


def frame(spark, contract, rows):
    schema = ", ".join(f"{name} string" for name in contract.names)
    return spark.createDataFrame([tuple(row[name] for name in contract.names) for row in rows], schema)


def bronze(spark, sales=(SALE, ONLINE_SALE), products=(PRODUCT,), stores=(ONLINE_STORE, STORE)):
    return {
        "sales": frame(spark, SALES, sales),
        "products": frame(spark, PRODUCTS, products),
        "stores": frame(spark, STORES, stores),
    }


def replace_table(store, layer: str, table: str, frame) -> None:
    """Publish another version of one table, as a change behind a stage's back."""
    store.publish(layer, {table: store.stage(layer, table, frame)})


def rows(frame, *columns):
    return sorted(tuple(row) for row in frame.select(*columns).collect())
