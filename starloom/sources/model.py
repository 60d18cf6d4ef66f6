"""The eleven operational tables every operator reads."""

from __future__ import annotations

import dataclasses

from pyspark.sql import DataFrame


@dataclasses.dataclass(frozen=True)
class Sources:
    """One snapshot of the operational system (sales and rentals)."""

    salestransaction: DataFrame
    soldvia: DataFrame
    rentaltransaction: DataFrame
    rentvia: DataFrame
    product: DataFrame
    rentalproducts: DataFrame
    customer: DataFrame
    store: DataFrame
    region: DataFrame
    vendor: DataFrame
    category: DataFrame

    def replace(self, **tables: DataFrame) -> "Sources":
        return dataclasses.replace(self, **tables)

    def tables(self) -> dict[str, DataFrame]:
        return {f.name: getattr(self, f.name) for f in dataclasses.fields(self)}
