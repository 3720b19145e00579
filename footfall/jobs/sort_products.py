"""Sort product lines ``name price store``, dearest first, and store or show them.

    spark-submit footfall/jobs/sort_products.py --lines /products.txt --by price-stock
"""

from __future__ import annotations

import argparse

from pyspark.sql import functions as F

from footfall.operators.ordering import sort_products, sort_products_by_price
from footfall.session import build_session
from footfall.sources.products import parse_products


def main(argv: list[str] | None = None) -> None:
    options = argparse.ArgumentParser(description="Sort products")
    options.add_argument("--lines", required=True)
    options.add_argument("--by", default="price-stock", choices=["price-stock", "price"])
    options.add_argument("--out", help="folder for the sorted rows; shown when left out")
    args = options.parse_args(argv)

    spark = build_session("sort_products")
    products = parse_products(spark.read.text(args.lines))
    sort = sort_products if args.by == "price-stock" else sort_products_by_price
    ordered = sort(products, F.col("name"))
    if args.out:
        ordered.write.mode("overwrite").parquet(args.out)
    else:
        print(*ordered.columns)
        for row in ordered.toLocalIterator():  # every row, a partition at a time
            print(*row)


if __name__ == "__main__":
    main()
