"""All models over one driver folder, built lazily from the adapter."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from bazaarlake.plans import checks, intermediate, marts, rfm, staging
from shopfixture.shop import Shop


class Models(Shop):
    def __init__(self, spark: SparkSession, sf_dir: str):
        super().__init__(spark, sf_dir)
        self._staged: dict[str, DataFrame] = {}

    def staged(self, name: str) -> DataFrame:
        if name not in self._staged:
            make = getattr(staging, f"stg_{name}")
            inputs = (self.raw(name),) if name == "geolocation" else (self.raw(name), self.ingest(name))
            self._staged[name] = make(*inputs)
        return self._staged[name]

    @cached_property
    def items(self) -> DataFrame:
        return self.staged("order_items")

    @cached_property
    def enriched(self) -> DataFrame:
        return intermediate.int_orders_enriched(
            self.staged("orders"), self.staged("customers"), self.items, self.staged("payments")
        )

    @cached_property
    def customer_orders(self) -> DataFrame:
        return intermediate.int_customer_orders(self.enriched)

    @cached_property
    def product_sales(self) -> DataFrame:
        return intermediate.int_product_sales(self.items)

    @cached_property
    def performance(self) -> DataFrame:
        return intermediate.int_seller_performance(self.items, self.enriched, self.staged("reviews"))

    @cached_property
    def fct_orders(self) -> DataFrame:
        return marts.fct_orders(self.enriched)

    @cached_property
    def dim_products(self) -> DataFrame:
        return marts.dim_products(self.staged("products"), self.product_sales)

    @cached_property
    def dim_sellers(self) -> DataFrame:
        return marts.dim_sellers(self.staged("sellers"), self.performance)

    @cached_property
    def daily_sales(self) -> DataFrame:
        return marts.mart_daily_sales(self.fct_orders)

    @cached_property
    def customer_rfm(self) -> DataFrame:
        return rfm.mart_customer_rfm(self.customer_orders)

    @cached_property
    def monitoring(self) -> DataFrame:
        return marts.mart_ingestion_monitoring(self.audit())

    @cached_property
    def unpaid(self) -> DataFrame:
        return checks.delivered_without_payment(self.fct_orders)
