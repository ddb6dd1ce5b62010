"""The registered queries in DuckDB SQL, over the same parquet tables."""

from __future__ import annotations

BRONZE = r"""
SELECT
  o_orderkey - CASE WHEN o_orderkey % 500 = 1 THEN 1 ELSE 0 END AS id_transacao,
  CASE WHEN o_orderkey % 150 = 0 THEN NULL
       ELSE concat('Cliente ', lpad(CAST(o_custkey AS VARCHAR), 6, '0')) END AS nome_cliente,
  CASE WHEN o_orderkey % 89 = 0 THEN NULL
       WHEN o_orderkey % 97 = 0 THEN lpad(CAST(o_custkey AS VARCHAR), 9, '0')
       ELSE lpad(CAST(o_custkey AS VARCHAR), 11, '0') END AS cpf,
  CAST(CASE WHEN o_orderkey % 211 = 0 THEN -1 - o_orderkey % 50
            ELSE 18 + o_custkey % 60 END AS INT) AS idade,
  CASE o_orderkey % 3 WHEN 0 THEN '  Recife '
                      WHEN 1 THEN concat(chr(9), 'Olinda', chr(9))
                      ELSE 'Curitiba' END AS cidade,
  CASE WHEN o_orderkey % 301 = 0 THEN 'R$ 1.234,56'
       WHEN o_orderkey % 307 = 0 THEN NULL
       ELSE concat(CASE WHEN o_orderkey % 2 = 0 THEN 'R$ ' ELSE 'R$' END,
                   CAST(CAST(CAST(o_totalprice AS DECIMAL(18,2))
                     * CASE WHEN o_orderkey % 10 = 0 THEN 4 ELSE 1 END
                     AS DECIMAL(18,2)) AS VARCHAR)) END AS valor_transacao,
  CAST(CAST(CAST(o_totalprice AS DECIMAL(18,2)) - 100000 AS DECIMAL(18,2)) AS VARCHAR)
    AS saldo_apos_transacao,
  CASE WHEN o_orderkey % 401 = 0 THEN '02/01/2024'
       ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS data_transacao,
  CASE o_orderkey % 4 WHEN 0 THEN 'PIX' WHEN 1 THEN 'TED'
                      WHEN 2 THEN 'Boleto' ELSE 'Cartao' END AS tipo_transacao,
  CASE o_orderstatus WHEN 'P' THEN 'Cancelada' WHEN 'F' THEN 'Concluida'
                     ELSE 'Pendente' END AS status_transacao,
  o_orderdate < TIMESTAMP '1998-01-01' AS primeira_entrega
FROM orders
"""

COLUMNS = [
    "id_transacao", "nome_cliente", "cpf", "idade", "cidade", "valor_transacao",
    "saldo_apos_transacao", "data_transacao", "tipo_transacao",
    "status_transacao",
]
RAW = ", ".join(COLUMNS)
TEXT = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in COLUMNS)

NAME = "coalesce(nome_cliente, 'Não identificado')"
CPF = "CASE WHEN length(cpf) <> 11 THEN 'Fora do padrão' ELSE cpf END"
UNPREFIXED = r"regexp_replace(valor_transacao, 'R\$\s*', '', 'g')"
AMOUNT = f"TRY_CAST({UNPREFIXED} AS FLOAT)"
AMOUNT_DECIMAL = f"TRY_CAST({UNPREFIXED} AS DECIMAL(18,2))"
BALANCE = "TRY_CAST(saldo_apos_transacao AS FLOAT)"
DATE = "TRY_CAST(data_transacao AS DATE)"


def silver(amount: str = AMOUNT) -> str:
    return f"""
SELECT CAST(id_transacao AS VARCHAR) AS id_transacao, {NAME} AS nome_cliente,
       {CPF} AS cpf, idade,
       trim(cidade) AS cidade, {amount} AS valor_transacao,
       {BALANCE} AS saldo_apos_transacao, {DATE} AS data_transacao,
       tipo_transacao, status_transacao
FROM bronze"""


def over_bronze(select: str) -> str:
    return f"WITH bronze AS ({BRONZE})\n{select}"


def over_silver(select: str, amount: str = AMOUNT) -> str:
    return f"WITH bronze AS ({BRONZE}),\nsilver AS ({silver(amount)})\n{select}"


def null_count(col: str) -> str:
    return f"CAST(sum(CASE WHEN {col} IS NULL THEN 1 ELSE 0 END) AS BIGINT)"


def lost(raw: str, parsed: str) -> str:
    return (f"CAST(count(CASE WHEN {raw} IS NOT NULL AND {parsed} IS NULL "
            "THEN 1 END) AS BIGINT)")


def repeated(key: str) -> str:
    return over_bronze(f"""
SELECT * FROM (
  SELECT {RAW}, count(*) OVER (PARTITION BY {key}) AS "Qtd_duplicatas"
  FROM bronze)
WHERE "Qtd_duplicatas" > 1""")


SILVER = over_silver("SELECT * FROM silver")

CLIENT_VIEW_BY = """
SELECT {key}, count(*) AS qtd_transacoes,
       sum(valor_transacao) AS total_movimentado,
       avg(valor_transacao) AS ticket_medio,
       max(data_transacao) AS ultima_transacao
FROM silver WHERE {where} GROUP BY {key}"""
CLIENT_VIEW = CLIENT_VIEW_BY.format(key="nome_cliente", where="TRUE")

BANK = """
SELECT count({clients}) AS qtd_clientes,
       {volume} AS volume_movimentado,
       count(*) AS qnt_transacoes,
       {mean} AS media_transacoes,
       count(*) FILTER (WHERE tipo_transacao = 'PIX') AS qnt_transcoes_pix,
       count(*) FILTER (WHERE status_transacao = 'Cancelada') AS qnt_transacoes_canceladas
FROM silver"""
BANK_INDICATORS = BANK.format(
    clients="nome_cliente", volume="sum(valor_transacao)",
    mean="avg(valor_transacao)")

THRESHOLD = "(SELECT avg(valor_transacao) * 2 FROM silver)"


def risk(threshold: str = THRESHOLD) -> str:
    return f"""
SELECT nome_cliente,
       count(*) FILTER (WHERE status_transacao = 'Cancelada') AS qnt_transacoes_canceladas,
       CAST(sum(CASE WHEN valor_transacao > {threshold} THEN 1 ELSE 0 END) AS BIGINT)
         AS qnt_valores_3x_acima_media
FROM silver GROUP BY nome_cliente"""


RISK = risk()

# the exact mean, rounded half up at six places, of amounts that are not negative
UNITS = ("(2 * sum(CAST(valor_transacao * 100 AS HUGEINT)) * 10000 + count(valor_transacao)) "
         "// (2 * count(valor_transacao))")
EXACT_MEAN = (f"CAST({UNITS} // 1000000 AS VARCHAR) || '.' || "
              f"lpad(CAST({UNITS} % 1000000 AS VARCHAR), 6, '0')")
EXACT_SUM = "CAST(CAST(sum(valor_transacao) AS DECIMAL(28,2)) AS VARCHAR)"

REJECTS = {
    "valor_transacao": lost("valor_transacao", AMOUNT),
    "saldo_apos_transacao": lost("saldo_apos_transacao", BALANCE),
    "data_transacao": lost("data_transacao", DATE),
    "idade": lost("idade", "idade"),
}


REJECTS_AMOUNT = f"valor_transacao IS NOT NULL AND {AMOUNT} IS NULL"
REJECTS_DATE = f"data_transacao IS NOT NULL AND {DATE} IS NULL"
BROKEN = f"""list_filter([
  CASE WHEN length(cpf) <> 11 THEN 'cpf_fora_do_padrao' END,
  CASE WHEN idade < 0 THEN 'idade_negativa' END,
  CASE WHEN nome_cliente IS NULL THEN 'nome_ausente' END,
  CASE WHEN {REJECTS_AMOUNT} THEN 'valor_transacao_ilegivel' END,
  CASE WHEN {REJECTS_DATE} THEN 'data_transacao_ilegivel' END], lambda r: r IS NOT NULL)"""


def one_column(expression: str, name: str) -> str:
    return over_bronze(f"SELECT id_transacao, {expression} AS {name} FROM bronze")


ORACLES = {
    "scan_bronze": over_bronze(f"SELECT {RAW} FROM bronze"),
    "null_counts": over_bronze(
        "SELECT " + ", ".join(f"{null_count(c)} AS {c}" for c in COLUMNS)
        + " FROM bronze"),
    "null_percent": over_bronze(
        "SELECT round(sum(CASE WHEN nome_cliente IS NULL THEN 1 ELSE 0 END)"
        ' / count(*) * 100) AS "Percentual nulos" FROM bronze'),
    "null_percent_all": over_bronze(
        "SELECT " + ", ".join(
            f"round({null_count(c)} / count(*) * 100, 2) AS {c}" for c in COLUMNS)
        + " FROM bronze"),
    "quality_profile": over_bronze(
        "SELECT count(*) AS total_linhas, "
        + ", ".join(f"{null_count(c)} AS nulos_{c}" for c in COLUMNS) + ", "
        + ", ".join(f"{sql} AS rejeitados_{c}" for c, sql in REJECTS.items())
        + ", count(*) FILTER (WHERE length(cpf) <> 11) AS cpf_fora_do_padrao"
        + ", count(*) FILTER (WHERE idade < 0) AS idade_negativa"
        + ", CAST(0 AS BIGINT) AS registros_corrompidos FROM bronze"),
    "cast_rejects": over_bronze(
        "SELECT " + ", ".join(f"{sql} AS {c}" for c, sql in REJECTS.items())
        + " FROM bronze"),
    "duplicates_by_key": repeated("id_transacao"),
    "duplicates_by_key_nulls": repeated("cpf"),
    "fill_null_name": one_column(NAME, "nome_cliente"),
    "flag_cpf": one_column(CPF, "cpf"),
    "invalid_age_text": over_bronze(f"""
SELECT * FROM (
  SELECT {TEXT.replace("CAST(idade AS VARCHAR)", """CASE WHEN id_transacao % 422 = 0
    THEN '-99999999999' ELSE concat(CAST(idade AS VARCHAR), '.0') END""")}
  FROM bronze)
WHERE CAST(idade AS DOUBLE) < 0"""),
    "invalid_age": over_bronze(f"SELECT {RAW} FROM bronze WHERE idade < 0"),
    "trim_city": one_column("trim(cidade)", "cidade"),
    "strip_city_ws": one_column(
        r"regexp_replace(cidade, '^\s+|\s+$', '', 'g')", "cidade"),
    "parse_money": one_column(AMOUNT, "valor_transacao"),
    "parse_money_decimal": one_column(
        f"CAST({AMOUNT_DECIMAL} AS VARCHAR)", "valor_transacao"),
    "parse_money_double": one_column(
        f"TRY_CAST({UNPREFIXED} AS DOUBLE)", "valor_transacao"),
    "parse_balance": one_column(BALANCE, "saldo_apos_transacao"),
    "parse_date": one_column(DATE, "data_transacao"),
    "project_typed_cols": over_silver(
        "SELECT valor_transacao, saldo_apos_transacao, data_transacao FROM silver"),
    "silver_clean": SILVER,
    "silver_clean_exact": over_bronze(
        "SELECT CAST(id_transacao AS VARCHAR) AS id_transacao, "
        + r"regexp_replace(cidade, '^\s+|\s+$', '', 'g') AS cidade, "
        + f"CAST({AMOUNT_DECIMAL} AS VARCHAR) AS valor_transacao, "
        "CAST(TRY_CAST(saldo_apos_transacao AS DECIMAL(18,2)) AS VARCHAR) "
        f"AS saldo_apos_transacao, {DATE} AS data_transacao FROM bronze"),
    "scan_silver": SILVER,
    "sink_silver_roundtrip": SILVER,
    "client_financial_view": over_silver(CLIENT_VIEW),
    "client_view_by_cpf": over_silver(
        CLIENT_VIEW_BY.format(key="cpf", where="TRUE")),
    "client_view_not_cancelled": over_silver(CLIENT_VIEW_BY.format(
        key="nome_cliente", where="status_transacao <> 'Cancelada'")),
    "bank_indicators": over_silver(BANK_INDICATORS),
    "bank_distinct_clients": over_silver(BANK.format(
        clients="DISTINCT nome_cliente", volume="sum(valor_transacao)",
        mean="avg(valor_transacao)")),
    "bank_indicators_decimal": over_silver(BANK.format(
        clients="nome_cliente",
        volume="CAST(CAST(sum(valor_transacao) AS DECIMAL(28,2)) AS VARCHAR)",
        mean="CAST(round(avg(valor_transacao), 2) AS DOUBLE)"), AMOUNT_DECIMAL),
    "above_mean_threshold": over_silver(
        f"SELECT id_transacao, valor_transacao, {THRESHOLD} AS limite, "
        f"valor_transacao > {THRESHOLD} AS acima_do_limite FROM silver"),
    "risk_monitor": over_silver(RISK),
    "risk_monitor_3x": over_silver(
        risk("(SELECT avg(valor_transacao) * 3 FROM silver)")),
    "sink_gold_roundtrip": over_silver(CLIENT_VIEW),
    "sink_gold_bank_roundtrip": over_silver(BANK_INDICATORS),
    "sink_gold_risk_roundtrip": over_silver(RISK),
    "sink_silver_upper_case": over_silver(
        "SELECT " + ", ".join(f"{c} AS {c.upper()}" for c in COLUMNS)
        + " FROM silver"),
    "sink_gold_by_cpf": over_silver(
        CLIENT_VIEW_BY.format(key="cpf", where="TRUE")),
    "sink_gold_not_cancelled": over_silver(
        "SELECT * FROM (" + risk(
            "(SELECT avg(valor_transacao) * 2 FROM silver "
            "WHERE status_transacao <> 'Cancelada')").replace(
            "FROM silver GROUP", "FROM silver WHERE status_transacao <> 'Cancelada' GROUP")
        + ")"),
    "ingest_broken_lines": over_bronze("""
SELECT count(*) AS linhas,
       count(*) FILTER (WHERE id_transacao % 97 = 0 OR id_transacao % 89 = 0)
         AS registros_corrompidos,
       count(*) FILTER (WHERE id_transacao % 97 <> 0 AND id_transacao % 89 <> 0)
         AS transacoes,
       CAST(0 AS BIGINT) AS corrompidas_na_prata,
       count(*) FILTER (WHERE id_transacao % 97 = 0 OR id_transacao % 89 = 0)
         AS corrompidas_a_parte
FROM bronze"""),
    "medallion_refresh": over_silver(RISK),
    "ingest_csv": over_bronze(
        f"SELECT {TEXT}, CAST(NULL AS VARCHAR) AS _registro_corrompido FROM bronze"),
    "ingest_history": over_bronze(
        f"SELECT {TEXT}, CASE WHEN primeira_entrega THEN 'entrega-1' "
        "ELSE 'entrega-2' END AS entrega, TRUE AS carregado, "
        "CAST(NULL AS VARCHAR) AS _registro_corrompido FROM bronze"),
    "ingest_arrivals": over_bronze(
        f"SELECT {TEXT}, CASE WHEN primeira_entrega THEN 1 ELSE 2 END AS carga "
        "FROM bronze"),
    "ingest_quarantine": over_bronze("""
SELECT CASE WHEN primeira_entrega THEN 'entrega-1' ELSE 'entrega-2' END AS entrega,
       'carregado' AS situacao, count(*) AS linhas, count(*) AS carregadas,
       FALSE AS com_motivo
FROM bronze GROUP BY ALL
UNION ALL
SELECT 'entrega-trocada', 'quarentena', count(*), 0, TRUE
FROM bronze WHERE primeira_entrega"""),
    "ingest_ledger": over_bronze(
        f"SELECT {TEXT}, CASE WHEN primeira_entrega THEN 'entrega-1' "
        "ELSE 'entrega-2' END AS entrega, CASE WHEN primeira_entrega "
        "THEN 'alterado,carregado' ELSE 'carregado' END AS situacoes FROM bronze"),
    "medallion_versions": over_silver(
        f"SELECT *, CAST(0 AS BIGINT) AS corrompidas_a_parte FROM ({RISK})"),
    "gold_by_delivery_clients": over_silver(f"""
SELECT nome_cliente, count(*) AS qtd_transacoes, {EXACT_SUM} AS total_movimentado,
       {EXACT_MEAN} AS ticket_medio, max(data_transacao) AS ultima_transacao
FROM silver GROUP BY nome_cliente""", AMOUNT_DECIMAL),
    "gold_by_delivery_bank": over_silver(BANK.format(
        clients="nome_cliente", volume=EXACT_SUM, mean=EXACT_MEAN), AMOUNT_DECIMAL),
    "gold_by_delivery_risk": over_silver(
        risk(f"(SELECT CAST({EXACT_MEAN} AS DECIMAL(22,6)) * 2 FROM silver)"),
        AMOUNT_DECIMAL),
    "rules_broken": over_bronze(f"""
SELECT id_transacao, array_to_string(regras, ',') AS regras_quebradas
FROM (SELECT id_transacao, {BROKEN} AS regras FROM bronze) WHERE len(regras) > 0"""),
    "rules_counted": over_bronze(f"""
SELECT regra, count(*) AS linhas
FROM (SELECT unnest({BROKEN}) AS regra FROM bronze) GROUP BY regra"""),
    "profile_by_delivery": over_bronze(f"""
SELECT CASE WHEN primeira_entrega THEN 'entrega-1' ELSE 'entrega-2' END AS entrega,
       count(*) AS total_linhas,
       count(*) - count(nome_cliente) AS nulos_nome_cliente,
       count(*) - count(cpf) AS nulos_cpf,
       count(*) FILTER (WHERE {REJECTS_AMOUNT}) AS rejeitados_valor_transacao,
       count(*) FILTER (WHERE {REJECTS_DATE}) AS rejeitados_data_transacao,
       count(*) FILTER (WHERE length(cpf) <> 11) AS cpf_fora_do_padrao,
       count(*) FILTER (WHERE idade < 0) AS idade_negativa,
       round((count(*) - count(nome_cliente)) / count(*) * 100, 2) AS percentual_nome_cliente
FROM bronze GROUP BY ALL"""),
}
