"""Names, markers and schemas shared by every layer."""

from __future__ import annotations

from dataclasses import dataclass

# Column names of the transactions table.
ID = "id_transacao"
NAME = "nome_cliente"
CPF = "cpf"
AGE = "idade"
CITY = "cidade"
AMOUNT = "valor_transacao"
BALANCE = "saldo_apos_transacao"
DATE = "data_transacao"
KIND = "tipo_transacao"
STATUS = "status_transacao"

TRANSACTION_COLUMNS = (
    ID, NAME, CPF, AGE, CITY, AMOUNT, BALANCE, DATE, KIND, STATUS,
)

# Markers written into the data, and categories counted from it.
UNKNOWN_NAME = "Não identificado"
BAD_FORMAT = "Fora do padrão"
PIX = "PIX"
CANCELLED = "Cancelada"
CPF_LENGTH = 11

# Currency sign, and the pattern removed from amounts wherever
# it matches.
CURRENCY = "R$"
CURRENCY_PREFIX = r"R\$\s*"

# Output columns of the quality checks.
DUPLICATE_COUNT = "Qtd_duplicatas"
NULL_PERCENT = "Percentual nulos"

# Schemas and tables.
BRONZE_SCHEMA = "camada_bronze"
SILVER_SCHEMA = "camada_prata"
GOLD_SCHEMA = "camada_ouro"
BRONZE_TABLE = "br_transacoes_bancarias"
SILVER_TABLE = "pr_transacoes_bancarias"
CORRUPT_TABLE = "registros_corrompidos"
LEDGER_TABLE = "entregas"
QUALITY_TABLE = "qualidade_entregas"
CLIENT_TABLE = "v_finan_cli"
BANK_TABLE = "v_gral_banco"
RISK_TABLE = "monit_risco"

# Columns the ingestion adds so that every raw row can be traced back.
SOURCE_FILE = "_arquivo_origem"
INGESTED_AT = "_ingerido_em"
CORRUPT_RECORD = "_registro_corrompido"

# Deliveries are read as text: digits-only identifiers keep their leading
# zeros, and no value is lost before the cleaning rules have seen it.
DELIVERY_SCHEMA = ", ".join(f"{c} STRING" for c in TRANSACTION_COLUMNS)


def quoted(name: str) -> str:
    """``name`` as one SQL identifier, whatever characters it contains."""
    return "`" + name.replace("`", "``") + "`"


def same_name(spark, a: str, b: str) -> bool:
    """Whether two column names are one to this session."""
    if spark.conf.get("spark.sql.caseSensitive", "false").lower() == "true":
        return a == b
    return a.lower() == b.lower()


def own_name(df, name: str) -> str:
    """The column of ``df`` that ``name`` means, as the table spells it."""
    for column in df.columns:
        if same_name(df.sparkSession, column, name):
            return column
    raise ValueError(f"there is no column {name} among {', '.join(df.columns)}")


@dataclass(frozen=True)
class Layers:
    """Where the three layers live; every schema name is a deployment choice."""

    bronze_schema: str = BRONZE_SCHEMA
    silver_schema: str = SILVER_SCHEMA
    gold_schema: str = GOLD_SCHEMA
    catalog: str | None = None

    def schema(self, name: str) -> str:
        parts = [self.catalog, name] if self.catalog else [name]
        return ".".join(quoted(p) for p in parts)

    def table(self, schema: str, table: str) -> str:
        return f"{self.schema(schema)}.{quoted(table)}"

    @property
    def bronze(self) -> str:
        return self.table(self.bronze_schema, BRONZE_TABLE)

    @property
    def ledger(self) -> str:
        return self.table(self.bronze_schema, LEDGER_TABLE)

    @property
    def quality(self) -> str:
        return self.table(self.bronze_schema, QUALITY_TABLE)

    @property
    def silver(self) -> str:
        return self.table(self.silver_schema, SILVER_TABLE)

    @property
    def corrupt(self) -> str:
        return self.table(self.silver_schema, CORRUPT_TABLE)

    @property
    def client_view(self) -> str:
        return self.table(self.gold_schema, CLIENT_TABLE)

    @property
    def bank_indicators(self) -> str:
        return self.table(self.gold_schema, BANK_TABLE)

    @property
    def risk_monitor(self) -> str:
        return self.table(self.gold_schema, RISK_TABLE)
