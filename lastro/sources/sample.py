"""Raw transactions derived from an ``orders`` table, for tests and benchmarks.

Every order becomes one transaction. Faults of each kind the cleaning rules
handle are placed by order number, so they recur at every scale.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lastro.names import (
    AGE, AMOUNT, BALANCE, CITY, CPF, DATE, ID, KIND, NAME, STATUS,
)


def transactions_from_orders(orders: DataFrame) -> DataFrame:
    number = F.col("o_orderkey")
    client = F.col("o_custkey").cast("string")
    price = F.col("o_totalprice").cast("decimal(18,2)")

    def every(n: int, remainder: int = 0):
        return number % n == remainder

    # A few very large amounts, so that some exceed twice the mean.
    amount = (price * F.when(every(10), 4).otherwise(1)).cast("decimal(18,2)")
    prefix = F.when(every(2), "R$ ").otherwise("R$")
    return orders.select(
        (number - F.when(every(500, 1), 1).otherwise(0)).alias(ID),
        F.when(~every(150), F.concat(F.lit("Cliente "), F.lpad(client, 6, "0")))
        .alias(NAME),
        F.when(every(89), None)
        .when(every(97), F.lpad(client, 9, "0"))
        .otherwise(F.lpad(client, 11, "0")).alias(CPF),
        F.when(every(211), -1 - number % 50)
        .otherwise(18 + F.col("o_custkey") % 60).cast("int").alias(AGE),
        F.when(every(3), "  Recife ")
        .when(every(3, 1), "\tOlinda\t")
        .otherwise("Curitiba").alias(CITY),
        F.when(every(301), "R$ 1.234,56")
        .when(every(307), None)
        .otherwise(F.concat(prefix, amount.cast("string"))).alias(AMOUNT),
        (price - 100000).cast("decimal(18,2)").cast("string").alias(BALANCE),
        F.when(every(401), "02/01/2024")
        .otherwise(F.col("o_orderdate").cast("date").cast("string")).alias(DATE),
        F.when(every(4), "PIX").when(every(4, 1), "TED")
        .when(every(4, 2), "Boleto").otherwise("Cartao").alias(KIND),
        F.when(F.col("o_orderstatus") == "P", "Cancelada")
        .when(F.col("o_orderstatus") == "F", "Concluida")
        .otherwise("Pendente").alias(STATUS),
    )


def bronze_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transactions_from_orders(spark.read.parquet(f"{sf_dir}/orders.parquet"))
