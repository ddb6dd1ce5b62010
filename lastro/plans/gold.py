"""Silver to gold: the three data products."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lastro.names import AMOUNT, CANCELLED, DATE, KIND, NAME, PIX, STATUS, quoted

# The risk monitor counts amounts above this multiple of the mean. Its column
# name says three; the rule is two.
RISK_MULTIPLIER = 2

# Output columns of the data products, spelled as their readers
# expect them.
CLIENT_COLUMNS = (
    "qtd_transacoes", "total_movimentado", "ticket_medio", "ultima_transacao",
)
BANK_COLUMNS = (
    "qtd_clientes", "volume_movimentado", "qnt_transacoes", "media_transacoes",
    "qnt_transcoes_pix", "qnt_transacoes_canceladas",
)
RISK_COLUMNS = ("qnt_transacoes_canceladas", "qnt_valores_3x_acima_media")


def _kept(silver: DataFrame, where: Column | None) -> DataFrame:
    return silver if where is None else silver.filter(where)


def _client(key: str) -> Column:
    """The column that tells clients apart, whatever characters its name has."""
    return F.col(quoted(key)).alias(key)


def _client_measures() -> list[Column]:
    count, total, mean, last = CLIENT_COLUMNS
    return [
        F.count("*").alias(count),
        F.sum(AMOUNT).alias(total),
        F.avg(AMOUNT).alias(mean),
        F.max(DATE).alias(last),
    ]


def _risk_measures(threshold: Column) -> list[Column]:
    cancelled, high = RISK_COLUMNS
    above = F.when(F.col(AMOUNT) > threshold, 1).otherwise(0)
    return [
        F.count_if(F.col(STATUS) == CANCELLED).alias(cancelled),
        F.sum(above).alias(high),
    ]


def mean_threshold(silver: DataFrame,
                   multiplier: float = RISK_MULTIPLIER) -> Column:
    """A multiple of the mean amount over all rows, as a scalar subquery."""
    return silver.agg(F.avg(AMOUNT) * multiplier).scalar()


def above_mean(silver: DataFrame, *kept: str,
               multiplier: float = RISK_MULTIPLIER) -> DataFrame:
    """Each row's ``kept`` columns, the threshold, and whether it is exceeded."""
    threshold = mean_threshold(silver, multiplier)
    return silver.select(
        *kept, threshold.alias("limite"),
        (F.col(AMOUNT) > threshold).alias("acima_do_limite"))


def client_financial_view(silver: DataFrame, key: str = NAME,
                          where: Column | None = None) -> DataFrame:
    """Per client: transactions, money moved, mean ticket, last transaction.

    All statuses count, cancelled ones too, unless ``where`` says otherwise.
    """
    return _kept(silver, where).groupBy(_client(key)).agg(*_client_measures())


def bank_indicators(silver: DataFrame, distinct_clients: bool = False,
                    where: Column | None = None) -> DataFrame:
    """One row for the whole bank, also when there are no transactions.

    ``qtd_clientes`` counts rows that have a client name; with
    ``distinct_clients`` it counts different names.
    """
    clients, volume, rows, mean, pix, cancelled = BANK_COLUMNS
    counted = F.count_distinct if distinct_clients else F.count
    return _kept(silver, where).agg(
        counted(F.col(NAME)).alias(clients),
        F.sum(AMOUNT).alias(volume),
        F.count("*").alias(rows),
        F.avg(AMOUNT).alias(mean),
        F.count_if(F.col(KIND) == PIX).alias(pix),
        F.count_if(F.col(STATUS) == CANCELLED).alias(cancelled),
    )


def risk_monitor(silver: DataFrame, multiplier: float = RISK_MULTIPLIER,
                 threshold: Column | None = None, key: str = NAME,
                 where: Column | None = None) -> DataFrame:
    """Per client: cancelled transactions, and amounts above the threshold.

    The threshold is ``multiplier`` times the mean amount of the rows looked
    at; pass ``threshold`` when that mean is already known.
    """
    rows = _kept(silver, where)
    if threshold is None:
        threshold = mean_threshold(rows, multiplier)
    return rows.groupBy(_client(key)).agg(*_risk_measures(threshold))


def client_summary(silver: DataFrame, threshold: Column, key: str = NAME,
                   where: Column | None = None) -> DataFrame:
    """Financial view and risk monitor side by side, from one scan and one
    shuffle; select ``CLIENT_COLUMNS`` or ``RISK_COLUMNS`` to take them apart.
    """
    return _kept(silver, where).groupBy(_client(key)).agg(
        *_client_measures(), *_risk_measures(threshold))
