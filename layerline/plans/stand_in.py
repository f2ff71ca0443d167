"""Invoice-shaped inputs derived from the star-schema test tables.

orders stand for invoices, lineitem for invoice items, part for products, events for the
issuers' change log. An order counts as cancelled when one of its lines was returned
and finished. An issuer's number is its customers' number without the last digit.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from layerline.functions.checkdigit import with_access_key, with_cnpj
from layerline.operators.clean import latest_per_key
from layerline.operators.scale import materialize
from layerline.operators.scd2 import Scd2Config
from layerline.plans.bronze import RawSources
from layerline.plans.contracts import CANCELLATION, CFOP_ROWS

ITEM_ORDER = ("l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity")
ITEM_GRAIN = ("l_orderkey", "l_linenumber")
UFS = (
    "AC", "AL", "AM", "AP", "BA", "CE", "DF", "ES", "GO", "MA", "MG", "MS", "MT",
    "PA", "PB", "PE", "PI", "PR", "RJ", "RN", "RO", "RR", "RS", "SC", "SE",
)
# Goods codes by product type; types not listed get one without a family.
NCM_BY_TYPE = {"ECONOMY": "84713012", "STANDARD": "94036000", "PROMO": "61091000", "SMALL": "85171300"}
NCM_OTHER = "39241000"

ISSUER = Scd2Config(
    natural_keys=("user_id",), tracked_columns=("event_type",), surrogate_key="sk_emitente"
)
PRODUCT = Scd2Config(
    natural_keys=("l_partkey",), tracked_columns=("p_type", "p_brand"), surrogate_key="sk_produto"
)

MONEY = "decimal(18,2)"


@dataclass(frozen=True)
class Tables:
    spark: SparkSession
    folder: str

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def tables(spark: SparkSession, folder: str) -> Tables:
    return Tables(spark, folder)


def latest_items(lineitem: DataFrame, *extra: str) -> DataFrame:
    """One row per item: key and order columns and the extra ones; all columns if none is named."""
    if extra:
        lineitem = lineitem.select(*dict.fromkeys([*ITEM_GRAIN, *ITEM_ORDER, *extra]))
    return latest_per_key(lineitem, ITEM_GRAIN, ITEM_ORDER)


def cancelled_orders(lineitem: DataFrame) -> DataFrame:
    """Per order, the last ship date of its returned and finished lines."""
    returned = (F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F")
    return (
        lineitem.filter(returned)
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(F.max("l_shipdate").alias("dh_cancelamento"))
    )


def orders_with_status(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    flag = F.col("dh_cancelamento").isNotNull()
    status = F.when(flag, "CANCELADA").otherwise(F.col("o_orderstatus"))
    return orders.join(cancelled_orders(lineitem), "o_orderkey", "left").withColumns(
        {"is_cancelada": flag, "o_orderstatus": status}
    )


def issuer_changes(events: DataFrame) -> DataFrame:
    """error deletes, signup inserts, anything else updates."""
    op = (
        F.when(F.col("event_type") == "error", "D")
        .when(F.col("event_type") == "signup", "I")
        .otherwise("U")
    )
    return events.select("user_id", "event_type", op.alias("op"), "ts", "event_id")


def stretched(ts: Column) -> Column:
    """The events' month of January 2024, stretched over the years of the orders."""
    passed = ts - F.lit("2024-01-01").cast("timestamp_ntz")
    return F.lit("1995-01-01").cast("timestamp_ntz") + passed * 80


def _with_cnpj(df: DataFrame, name: str, number: Column) -> DataFrame:
    base = F.concat(F.lpad((number + 1).cast("string"), 8, "0"), F.lit("0001"))
    return with_cnpj(df, name, base)


def _tenth(number: Column) -> Column:
    return F.floor(number / 10).cast("long")


def _pick(values: tuple[str, ...], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), index.cast("int") + 1)


def with_order_key(orders: DataFrame) -> DataFrame:
    """Orders with the access key their number, date and customer make."""
    number = F.pmod("o_orderkey", F.lit(1_000_000_000))
    return with_access_key(
        _with_cnpj(orders, "cnpj_emitente", _tenth(F.col("o_custkey"))),
        "chave_acesso",
        uf=F.pmod("o_custkey", F.lit(25)) + 11,
        year_month=F.date_format("o_orderdate", "yyMM"),
        cnpj=F.col("cnpj_emitente"),
        series=F.pmod("o_orderkey", F.lit(999)) + 1,
        number=number,
        code=F.floor(F.col("o_orderkey") / 1_000_000_000).cast("long"),
    )


def item_cfop() -> Column:
    codes = tuple(row[0] for row in CFOP_ROWS)
    return _pick(codes, F.pmod(F.col("l_orderkey") + F.col("l_linenumber"), F.lit(len(codes))))


def raw_sources(t: Tables) -> RawSources:
    # Used by headers, items and events alike.
    invoices = materialize(with_order_key(t.orders), "invoices")
    recipients = _with_cnpj(invoices, "cnpj_destinatario", F.col("o_custkey") + 10_000_000)
    headers = recipients.select(
        "chave_acesso",
        F.pmod("o_orderkey", F.lit(1_000_000_000)).cast("int").alias("numero_nfe"),
        (F.pmod("o_orderkey", F.lit(999)) + 1).cast("int").alias("serie"),
        F.col("o_orderdate").cast("timestamp").alias("dh_emissao"),
        "cnpj_emitente",
        "cnpj_destinatario",
        _pick(UFS, F.pmod("o_custkey", F.lit(25))).alias("uf_emitente"),
        _pick(UFS, F.pmod(F.col("o_orderkey") * 7 + 3, F.lit(25))).alias("uf_destinatario"),
        F.col("o_totalprice").cast(MONEY).alias("valor_total"),
        F.lit("AUTORIZADA").alias("status_nfe"),
        F.col("o_orderdate").cast("timestamp").alias("updated_at_source"),
    )
    keyed = invoices.select("o_orderkey", "chave_acesso", "o_orderdate")
    parts = _with_cnpj(t.part, "cnpj_emitente", _tenth(F.col("p_partkey")))
    lines = (
        latest_items(t.lineitem, "l_partkey")
        .join(parts, F.col("l_partkey") == F.col("p_partkey"))
        # Last, so that an invoice's items lie side by side.
        .join(keyed, F.col("l_orderkey") == F.col("o_orderkey"))
    )
    price = F.col("l_extendedprice").cast(MONEY)
    ncm = F.lit(NCM_OTHER)
    for kind, code in NCM_BY_TYPE.items():
        ncm = F.when(F.col("p_type") == kind, code).otherwise(ncm)

    def rate(share: str) -> Column:
        return (price * F.lit(share).cast("decimal(5,4)")).cast(MONEY)

    item = {
        "chave_acesso": F.col("chave_acesso"),
        "num_item": F.col("l_linenumber"),
        "cnpj_emitente": F.col("cnpj_emitente"),
        "codigo_produto": F.format_string("SKU-%06d", "l_partkey"),
        "descricao_produto": F.col("p_name"),
        # Products of one size carry a malformed goods code, and so end in quarantine.
        "ncm": F.when(F.col("p_size") == 13, F.lit("n/a")).otherwise(ncm),
        "cest": F.lit(None).cast("string"),
        "familia_produto": F.col("p_type"),
        "unidade_comercial": F.lit("UN"),
        "cfop": item_cfop(),
        "quantidade": F.col("l_quantity").cast("decimal(18,4)").cast("string"),
        "valor_unitario": F.try_divide(price, F.col("l_quantity").cast("decimal(18,4)"))
        .cast("decimal(18,4)")
        .cast("string"),
        "valor_produto": price.cast("string"),
        "cst_icms": F.lit("00"),
        "csosn": F.lit(None).cast("string"),
        "valor_icms": rate("0.18").cast("string"),
        "cst_ipi": F.lit("50"),
        "valor_ipi": rate("0.05").cast("string"),
        "cst_pis": F.lit("01"),
        "valor_pis": rate("0.0165").cast("string"),
        "cst_cofins": F.lit("01"),
        "valor_cofins": rate("0.076").cast("string"),
        "dh_emissao": F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"),
    }
    items = lines.select(F.to_json(F.struct(*[c.alias(n) for n, c in item.items()])).alias("payload"))
    event = {
        "chave_acesso": F.col("chave_acesso"),
        "tipo_evento": F.lit(CANCELLATION),
        "sequencia_evento": F.lit(1),
        "dh_evento": F.date_format("dh_cancelamento", "yyyy-MM-dd HH:mm:ss"),
        "justificativa": F.lit("Mercadoria devolvida pelo destinatário"),
    }
    log = keyed.join(cancelled_orders(t.lineitem), "o_orderkey").select(
        F.lit("nfe_evento").alias("table_name"),
        F.to_json(F.struct(*[c.alias(n) for n, c in event.items()])).alias("payload_json"),
    )
    first_seen = t.events.groupBy("user_id").agg(
        F.min("ts").alias("first_ts"), F.max_by("event_type", F.struct("ts", "event_id")).alias("kind")
    )
    issuers = _with_cnpj(first_seen, "cnpj_emitente", F.col("user_id")).select(
        "cnpj_emitente",
        F.format_string("Empresa %d", "user_id").alias("razao_social"),
        F.format_string("Loja %d", "user_id").alias("nome_fantasia"),
        F.col("kind").alias("regime_tributario"),
        _pick(UFS, F.pmod("user_id", F.lit(25))).alias("uf"),
        F.lit("Capital").alias("municipio"),
        F.lit("4711301").alias("cnae_principal"),
        F.lit("ATIVA").alias("situacao_cadastral"),
        stretched(F.col("first_ts")).cast("timestamp").alias("cadastrado_em"),
    )
    return RawSources(headers, items, log, issuers, F.col("cadastrado_em"))
