"""Crosswalk from the driver's TPC-H-like tables to the ledger / delivery /
CRM tables the jobs expect (see FIXTURES.md).

Each crosswalk is a list of SQL expressions that both Spark (``selectExpr``)
and DuckDB accept, so the Spark jobs and the DuckDB oracle read the very
same derived tables. On a real deployment these functions are replaced by
scans of the real tables with the same column names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlens.sources.tables import read_table

# --------------------------------------------------------------------------
# Ledger (profitability lines): lineitem x orders x part x customer
# --------------------------------------------------------------------------
_NULL_AMOUNT = "CAST(NULL AS DECIMAL(18,4))"

LEDGER_EXPRS = [
    "'300' AS MANDT",
    "concat('AU', CAST(c_nationkey AS STRING)) AS BUKRS",
    "CAST(o_custkey AS STRING) AS KNDNR",
    "CAST(l_suppkey AS STRING) AS KUNWE",
    "CAST(l_shipdate AS DATE) AS BUDAT",
    "CAST(o_orderdate AS DATE) AS WADAT",
    "CAST(l_shipdate AS DATE) AS FADAT",
    "CAST(l_partkey AS STRING) AS ARTNR",
    "p_brand AS MATKL",
    "p_type AS PRODH",
    "CASE l_returnflag WHEN 'R' THEN 'CDA' WHEN 'A' THEN 'CMO' ELSE 'EA' END AS VVQ01_ME",
    "CAST(l_quantity AS DECIMAL(18,4)) AS VVQ01",
    "CAST(l_quantity AS DECIMAL(18,4)) AS VVQ13",
    "CAST(l_extendedprice AS DECIMAL(18,4)) AS VVR98",
    f"{_NULL_AMOUNT} AS VVR99",
    f"{_NULL_AMOUNT} AS VVR95",
    f"{_NULL_AMOUNT} AS VVRR2",
    f"{_NULL_AMOUNT} AS VVR03",
    f"{_NULL_AMOUNT} AS VVR94",
    f"{_NULL_AMOUNT} AS VVR88",
    f"{_NULL_AMOUNT} AS VVRR1",
    "nullif(CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(18,2))"
    " AS DECIMAL(18,4)), CAST(0 AS DECIMAL(18,4))) AS VVR93",
    f"{_NULL_AMOUNT} AS VVR92",
    f"{_NULL_AMOUNT} AS VVR89",
    f"{_NULL_AMOUNT} AS VVR70",
    "CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_tax AS DECIMAL(18,2))"
    " AS DECIMAL(18,4)) AS VVR13",
    "CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'D' WHEN '2' THEN 'M'"
    " WHEN '3' THEN 'Q' WHEN '4' THEN 'A' ELSE 'X' END AS WWRCP",
    "CAST(l_linenumber AS STRING) AS RPOSN",
    "CAST(l_orderkey AS STRING) AS KAUFN",
    "c_mktsegment AS WWI06",
    "CAST(c_nationkey AS STRING) AS WWI04",
    "CAST(l_suppkey AS STRING) AS VKORG",
    "lpad(CAST(month(l_shipdate) AS STRING), 3, '0') AS PERDE",
    "c_name AS USNAM",
    "CASE WHEN l_linestatus = 'F' THEN 'AU' ELSE 'NZ' END AS LAND1",
    "2 AS PALEDGER",
    "concat(CASE WHEN o_orderstatus LIKE 'P%' THEN '0CT' ELSE '0CR' END, o_orderstatus) AS AUART",
]

LEDGER_SQL = (
    "SELECT " + ",\n  ".join(LEDGER_EXPRS) + "\nFROM lineitem"
    " JOIN orders ON l_orderkey = o_orderkey"
    " JOIN part ON l_partkey = p_partkey"
    " JOIN customer ON o_custkey = c_custkey"
)

# Fixture codes that stand in for the ledger's six material
# groups and seven product hierarchies, in the order of the output columns.
FIXTURE_MATERIAL_GROUPS = ["Brand#1", "Brand#2", "Brand#3", "Brand#4", "Brand#5", "Brand#6"]
FIXTURE_PRODUCT_HIERARCHIES = ["LARGE", "SMALL", "MEDIUM", "ECONOMY", "STANDARD", "PROMO", "ABSENT"]


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    o = read_table(spark, sf_dir, "orders")
    p = read_table(spark, sf_dir, "part")
    c = read_table(spark, sf_dir, "customer")
    # every side grows with the ledger: a broadcast would gather it in the driver, however
    # small its compressed files look
    bought = o.join(c.hint("merge"), F.col("o_custkey") == F.col("c_custkey"))
    joined = (
        li.join(bought.hint("merge"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(p.hint("merge"), F.col("l_partkey") == F.col("p_partkey"))
    )
    return joined.selectExpr(*LEDGER_EXPRS)


# --------------------------------------------------------------------------
# Delivery header (orders x customer) and delivery items (lineitem x part)
# --------------------------------------------------------------------------
DELIVERY_EXPRS = [
    "CAST(o_orderkey AS STRING) AS VBELN",
    "CAST(o_custkey AS STRING) AS KUNNR",
    "CAST(o_orderdate AS DATE) AS LDDAT",
    "o_orderpriority AS ROUTE",
    "o_orderpriority AS TRAGR",
    "o_orderstatus AS LFART",
    "nullif(c_mktsegment, 'BUILDING') AS KDGRP",
]

DELIVERY_SQL = (
    "SELECT " + ", ".join(DELIVERY_EXPRS) + " FROM orders JOIN customer ON o_custkey = c_custkey"
)

ITEM_EXPRS = [
    "CAST(l_orderkey AS STRING) AS VBELN",
    "CAST(l_shipdate AS DATE) AS ERDAT",
    "CAST(l_partkey AS STRING) AS MATNR",
    "p_brand AS MATKL",
    "CAST(l_suppkey AS STRING) AS VGBEL",
    "CAST(l_quantity AS DECIMAL(18,3)) AS LGMNG",
    "CASE l_returnflag WHEN 'A' THEN 'Z08' WHEN 'R' THEN 'Z01' END AS MVGR1",
    "CASE WHEN l_linestatus = 'F' THEN 'KG' ELSE 'G' END AS GEWEI",
    "CAST(l_quantity AS DECIMAL(18,3)) AS BRGEW",
    "CASE WHEN l_linestatus = 'O' THEN 'CYL' ELSE 'EA' END AS MEINS",
    "CAST(l_quantity AS DECIMAL(18,3)) AS LFIMG",
    "CASE WHEN l_linestatus = 'F' THEN 'M3' ELSE 'L' END AS VOLEH",
    "CAST(l_quantity AS DECIMAL(18,3)) AS VOLUM",
]

ITEM_SQL = "SELECT " + ", ".join(ITEM_EXPRS) + " FROM lineitem JOIN part ON l_partkey = p_partkey"


def deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    c = read_table(spark, sf_dir, "customer")
    return o.join(c.hint("merge"), F.col("o_custkey") == F.col("c_custkey")).selectExpr(*DELIVERY_EXPRS)


def delivery_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    p = read_table(spark, sf_dir, "part")
    return li.join(p.hint("merge"), F.col("l_partkey") == F.col("p_partkey")).selectExpr(*ITEM_EXPRS)


# Fixture stand-ins for the delivery code lists.
FIXTURE_DELIVERY_CODES = dict(
    dangerous=["1-URGENT", "2-HIGH"],
    general=["3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"],
    air=["1-URGENT", "3-MEDIUM"],
    sea=["2-HIGH", "4-NOT SPECIFIED"],
    waterway=["5-LOW"],
    debit=["F"],
    consignment=["O"],
    standard=["P"],
    thirdparty=["X"],
    kdgrp_d0="MACHINERY",
    kdgrp_gf="HOUSEHOLD",
)


# --------------------------------------------------------------------------
# CRM: accounts, companies, users, dictionary, complaints, visits
# --------------------------------------------------------------------------
# Accounts: one payer (level 20) and one ship-to (level 30) per customer, one
# customer-level account (level 10) per nation. Payers hang under their
# nation's account; ship-tos hang under their payer.
ACCOUNT_PAYER_EXPRS = [
    "concat('P', CAST(c_custkey AS STRING)) AS ACCOUNTID",
    "concat('C', CAST(c_nationkey AS STRING)) AS PARENTACCOUNTID",
    "CAST(n_regionkey AS STRING) AS NEW_COMPANYID",
    "CAST(c_nationkey AS STRING) AS OWNERID",
    "CAST(c_custkey AS STRING) AS NEW_JDECODE",
    "c_name AS NAME",
    "20 AS NEW_LEVELTYPE",
    "c_acctbal AS NEW_EFFTECTTIME",
]
ACCOUNT_SHIPTO_EXPRS = [
    "concat('S', CAST(c_custkey AS STRING)) AS ACCOUNTID",
    "concat('P', CAST(c_custkey AS STRING)) AS PARENTACCOUNTID",
    "CAST(n_regionkey AS STRING) AS NEW_COMPANYID",
    "CAST(c_nationkey AS STRING) AS OWNERID",
    "concat(CAST(c_custkey AS STRING), '-S') AS NEW_JDECODE",
    "c_name AS NAME",
    "30 AS NEW_LEVELTYPE",
    "c_acctbal AS NEW_EFFTECTTIME",
]
ACCOUNT_CUSTOMER_EXPRS = [
    "concat('C', CAST(n_nationkey AS STRING)) AS ACCOUNTID",
    "CAST(NULL AS STRING) AS PARENTACCOUNTID",
    "CAST(n_regionkey AS STRING) AS NEW_COMPANYID",
    "CAST(n_nationkey AS STRING) AS OWNERID",
    "CAST(NULL AS STRING) AS NEW_JDECODE",
    "n_name AS NAME",
    "10 AS NEW_LEVELTYPE",
    "CAST(NULL AS DOUBLE) AS NEW_EFFTECTTIME",
]
ACCOUNT_SQL = (
    "SELECT " + ", ".join(ACCOUNT_PAYER_EXPRS) + " FROM customer JOIN nation ON c_nationkey = n_nationkey"
    " UNION ALL SELECT " + ", ".join(ACCOUNT_SHIPTO_EXPRS) + " FROM customer JOIN nation ON c_nationkey = n_nationkey"
    " UNION ALL SELECT " + ", ".join(ACCOUNT_CUSTOMER_EXPRS) + " FROM nation"
)

COMPANY_EXPRS = ["CAST(r_regionkey AS STRING) AS NEW_COMPANYID", "r_name AS NEW_CODE"]
COMPANY_SQL = "SELECT " + ", ".join(COMPANY_EXPRS) + " FROM region"
SYSTEMUSER_EXPRS = ["CAST(n_nationkey AS STRING) AS SYSTEMUSERID"]
SYSTEMUSER_SQL = "SELECT " + ", ".join(SYSTEMUSER_EXPRS) + " FROM nation"
# Dictionary rows for two tables; only the complaint judge rows must match.
DATADICT_JUDGE_EXPRS = [
    "'new_complaint' AS TABLENAME",
    "'new_judge' AS FIELDNAME",
    "CAST(r_regionkey AS STRING) AS CODE",
    "concat('judge ', r_name) AS VALUE",
]
DATADICT_OTHER_EXPRS = [
    "'account' AS TABLENAME",
    "'new_judge' AS FIELDNAME",
    "CAST(r_regionkey AS STRING) AS CODE",
    "concat('other ', r_name) AS VALUE",
]
DATADICT_SQL = (
    "SELECT " + ", ".join(DATADICT_JUDGE_EXPRS) + " FROM region"
    " UNION ALL SELECT " + ", ".join(DATADICT_OTHER_EXPRS) + " FROM region"
)

# Complaints: one per conversation; its payer is customer conv_id + 1.
COMPLAINT_EXPRS = [
    "CAST(conv_id AS STRING) AS NEW_COMPLAINTID",
    "CAST(DATE '2001-01-01' + CAST(conv_id AS INT) AS TIMESTAMP) AS CREATEDON",
    "concat('P', CAST(conv_id + 1 AS STRING)) AS NEW_PAYER",
    "concat('contact ', CAST(conv_id AS STRING)) AS NEW_CONTACT",
    "CAST(NULL AS STRING) AS NEW_CONTACT_PHONE",
    "CAST(conv_id % 5 AS STRING) AS NEW_JUDGE",
]
COMPLAINT_SQL = "SELECT " + ", ".join(COMPLAINT_EXPRS) + " FROM conversations GROUP BY conv_id"
FEEDBACK_SQL = (
    "SELECT CAST(conv_id AS STRING) AS NEW_COMPLAINT, text AS NEW_BRIEFDESCRIPTION"
    " FROM conversations WHERE role = 'user'"
)
SOLUTION_SQL = (
    "SELECT CAST(conv_id AS STRING) AS NEW_COMPLAINT, text AS NEW_BRIEFDESCRIPTION"
    " FROM conversations WHERE role = 'assistant'"
)

# Visits: events; error -> payer account, view -> ship-to account,
# signup -> the nation-level customer account of the user.
VISIT_EXPRS = [
    "CAST(event_id AS STRING) AS NEW_CUSTOMERVISITID",
    "ts AS CREATEDON",
    "CASE event_type WHEN 'error' THEN concat('P', CAST(user_id AS STRING))"
    " WHEN 'view' THEN concat('S', CAST(user_id AS STRING))"
    " ELSE concat('C', CAST(c_nationkey AS STRING)) END AS NEW_CUSTOMER",
    "concat('user ', CAST(user_id AS STRING)) AS NEW_CONTRACTOR",
    "props AS NEW_CONTRACTPHONE",
    "value AS NEW_FEEDBACKSCORE",
    "props AS NEW_HANDLERECORD",
    "CASE WHEN value >= 5 THEN 20 ELSE 10 END AS NEW_VISITRESULT",
]
VISIT_SQL = (
    "SELECT " + ", ".join(VISIT_EXPRS) + " FROM events JOIN customer ON user_id = c_custkey"
    " WHERE event_type IN ('error', 'view', 'signup')"
)


def crm_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All CRM inputs of the complaint/visit feed as DataFrames."""
    c = read_table(spark, sf_dir, "customer")
    n = read_table(spark, sf_dir, "nation")
    r = read_table(spark, sf_dir, "region")
    conv = read_table(spark, sf_dir, "conversations")
    ev = read_table(spark, sf_dir, "events")
    cn = c.join(n, F.col("c_nationkey") == F.col("n_nationkey"))
    account = (
        cn.selectExpr(*ACCOUNT_PAYER_EXPRS)
        .unionByName(cn.selectExpr(*ACCOUNT_SHIPTO_EXPRS))
        .unionByName(n.selectExpr(*ACCOUNT_CUSTOMER_EXPRS))
    )
    complaint = conv.select("conv_id").distinct().selectExpr(*COMPLAINT_EXPRS)
    return dict(
        account=account,
        company=r.selectExpr(*COMPANY_EXPRS),
        systemuser=n.selectExpr(*SYSTEMUSER_EXPRS),
        datadict=r.selectExpr(*DATADICT_JUDGE_EXPRS).unionByName(r.selectExpr(*DATADICT_OTHER_EXPRS)),
        complaint=complaint,
        feedback=conv.filter(F.col("role") == "user").selectExpr(
            "CAST(conv_id AS STRING) AS NEW_COMPLAINT", "text AS NEW_BRIEFDESCRIPTION"
        ),
        solution=conv.filter(F.col("role") == "assistant").selectExpr(
            "CAST(conv_id AS STRING) AS NEW_COMPLAINT", "text AS NEW_BRIEFDESCRIPTION"
        ),
        visit=ev.filter(F.col("event_type").isin("error", "view", "signup"))
        .join(c, F.col("user_id") == F.col("c_custkey"))
        .selectExpr(*VISIT_EXPRS),
    )


CRM_SQL_VIEWS = {
    "account": ACCOUNT_SQL,
    "company": COMPANY_SQL,
    "systemuser": SYSTEMUSER_SQL,
    "datadict": DATADICT_SQL,
    "complaint": COMPLAINT_SQL,
    "feedback": FEEDBACK_SQL,
    "solution": SOLUTION_SQL,
    "visit": VISIT_SQL,
}


# --------------------------------------------------------------------------
# Action lists and the dashboards' status stand-in
# --------------------------------------------------------------------------
CUSTOMER_ID_EXPR = "concat('PEA300.AU', CAST(c_nationkey AS STRING), '.', CAST(c_custkey AS STRING))"
ACTION_YES_SQL = (
    f"SELECT {CUSTOMER_ID_EXPR} AS SAPCustomerNumber__c FROM customer"
    " WHERE c_mktsegment IN ('AUTOMOBILE', 'MACHINERY')"
)
ACTION_NO_SQL = f"SELECT {CUSTOMER_ID_EXPR} AS SAPCustomerNumber__c FROM customer WHERE c_mktsegment = 'MACHINERY'"

def action_lists(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    c = read_table(spark, sf_dir, "customer")
    yes = c.filter(F.col("c_mktsegment").isin("AUTOMOBILE", "MACHINERY")).selectExpr(f"{CUSTOMER_ID_EXPR} AS SAPCustomerNumber__c")
    no = c.filter(F.col("c_mktsegment") == "MACHINERY").selectExpr(f"{CUSTOMER_ID_EXPR} AS SAPCustomerNumber__c")
    return yes, no
