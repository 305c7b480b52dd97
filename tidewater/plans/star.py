"""Wire the layers together: sources -> bronze -> silver -> gold.

Every attribute is a lazily built DataFrame, so a query that needs only the
fact and the calendar plans only those branches. Building a keyed table
(dimensions, Fact_Sales) runs the job that numbers it.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from tidewater.config import FIXTURE_CONFIG, RunConfig
from tidewater.plans import bronze as B
from tidewater.plans import gold as G
from tidewater.plans import silver as S
from tidewater.sources.model import SalesSources


class Star:
    def __init__(self, spark: SparkSession, sources: SalesSources, cfg: RunConfig):
        self.spark = spark
        self.sources = sources
        self.cfg = cfg

    @classmethod
    def from_fixture(cls, spark: SparkSession, sf_dir: str, cfg: RunConfig = FIXTURE_CONFIG) -> "Star":
        from tidewater.sources.fixture import fixture_sources
        return cls(spark, fixture_sources(spark, sf_dir), cfg)

    def _dimensions(self) -> None:
        """Number the three keyed dimensions side by side: their jobs are independent."""
        missing = [n for n in ("dim_customer", "dim_product", "dim_address") if n not in self.__dict__]
        if missing:
            with ThreadPoolExecutor(len(missing)) as pool:
                list(pool.map(lambda n: getattr(self, n), missing))

    # ------------------------------------------------------------ bronze
    @cached_property
    def bronze(self) -> dict[str, DataFrame]:
        return B.bronze_layer(self.sources, self.cfg)

    # ------------------------------------------------------------ silver
    @cached_property
    def silver(self) -> "SilverLayer":
        return SilverLayer(self)

    # ------------------------------------------------------------ gold
    @cached_property
    def dim_date(self) -> DataFrame:
        return G.dim_date(self.spark, self.cfg)

    @cached_property
    def dim_customer(self) -> DataFrame:
        return G.dim_customer(self.silver["customer"], self.cfg)

    @cached_property
    def descriptions(self) -> DataFrame | None:
        b = self.bronze
        if "model_description" not in b or "product_description" not in b:
            return None
        return G.english_descriptions(b["model_description"], b["product_description"])

    @cached_property
    def dim_product(self) -> DataFrame:
        s = self.silver
        return G.dim_product(s["product"], s["product_category"], s["product_model"], self.cfg,
                             self.descriptions)

    @cached_property
    def dim_address(self) -> DataFrame:
        return G.dim_address(self.silver["address"], self.cfg)

    @cached_property
    def fact_sales(self) -> DataFrame:
        self._dimensions()
        s = self.silver
        return G.fact_sales(s["detail"], s["header"], self.dim_product, self.dim_customer,
                            self.dim_address, self.cfg, lines_once=True)

    @cached_property
    def fact_lines(self) -> DataFrame:
        """Fact_Sales rows without the SalesKey row number and the address roles.
        Analytic queries that read neither skip numbering (and checkpointing) the
        largest table and two joins; rows and measures are those of Fact_Sales."""
        s = self.silver
        return G.fact_sales(s["detail"], s["header"], self.dim_product, self.dim_customer,
                            None, self.cfg, with_sales_key=False)

    @cached_property
    def products(self) -> DataFrame:
        """Dim_Product without its surrogate key, so nothing is numbered."""
        s = self.silver
        return G.product_attributes(s["product"], s["product_category"], s["product_model"], self.cfg, self.descriptions)

    @cached_property
    def fact_measures(self) -> DataFrame:
        """``fact_lines`` by natural keys: for reports that show no surrogate key."""
        s = self.silver
        return G.fact_sales(s["detail"], s["header"], s["product"].select("ProductID", "StandardCost"),
                            s["customer"].select("CustomerID"), None, self.cfg, with_sales_key=False)

    @cached_property
    def fact_places(self) -> DataFrame:
        """``fact_lines`` with the address roles."""
        self._dimensions()
        s = self.silver
        return G.fact_sales(s["detail"], s["header"], self.dim_product, self.dim_customer,
                            self.dim_address, self.cfg, with_sales_key=False)

    @cached_property
    def order_lines(self) -> DataFrame:
        """Lines with their orders, by natural keys, products not looked up yet."""
        s = self.silver
        return G.order_lines(s["detail"], s["header"], s["customer"].select("CustomerID"), self.cfg)

    def gold_rows(self) -> dict[str, DataFrame]:
        """Frames with the rows of the gold tables but not their surrogate keys: to count
        them, nothing needs to be numbered."""
        s = self.silver
        return {"Dim_Date": self.dim_date, "Dim_Customer": s["customer"], "Dim_Product": s["product"],
                "Dim_Address": G.address_rows(s["address"]), "Fact_Sales": self.fact_measures}

    def gold(self) -> dict[str, DataFrame]:
        self._dimensions()
        return {"Dim_Date": self.dim_date, "Dim_Customer": self.dim_customer,
                "Dim_Product": self.dim_product, "Dim_Address": self.dim_address,
                "Fact_Sales": self.fact_sales}


class SilverLayer(dict):
    """Silver frames keyed by source attribute name, built on first access."""

    def __init__(self, star: Star):
        super().__init__()
        self._star = star

    def __missing__(self, name: str) -> DataFrame:
        build = S.SILVER_BUILDERS[name]
        df = build(self._star.bronze[name], self._star.cfg)
        self[name] = df
        return df

    def keys(self):
        return S.SILVER_BUILDERS.keys()

    def items(self):
        return [(k, self[k]) for k in S.SILVER_BUILDERS]
