"""Complaint / visit feed.

Complaints name their payer. Visits are booked on a payer, on a ship-to (payer is its
parent) or on a customer (payer is its latest child): the level of the booked account
tells which, so one table (booked account -> payer) resolves all three, and visits are
read and joined once. Complaints and visits then meet in one union, and the payer's
attributes (account, company, user), put together once, are joined to it. Tables that are
small are broadcast by Spark's threshold, from their measured size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

FEED_COLUMNS = [
    "Id", "CreatedOn", "PayerAccountId", "SalesOrg", "PayerId", "Payer", "SalesUserSystemId",
    "CustomerContactPerson", "CustomerContactPhone", "Feedback", "CorrectiveActionPlan", "Judge", "Type",
]
# The feed's type labels (complaint, voice of customer).
COMPLAINT_TYPE = "投诉"
VISIT_TYPE = "VOC"
# Account levels.
CUSTOMER_LEVEL, PAYER_LEVEL, SHIPTO_LEVEL = 10, 20, 30


def listagg_sorted(rows: DataFrame, key: str, text: str, name: str, prefix: str = "-", sep: str = "\n") -> DataFrame:
    """LISTAGG(prefix || text, sep) WITHIN GROUP (ORDER BY text) per key.

    Oracle semantics: prefix || NULL = prefix, NULL texts sort last."""
    item = F.struct(
        F.col(text).isNull().alias("n"),
        F.col(text).alias("t"),
        F.concat(F.lit(prefix), F.coalesce(F.col(text), F.lit(""))).alias("v"),
    )
    return rows.groupBy(key).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(item)), lambda e: e["v"]), sep).alias(name)
    )


def latest_child(account: DataFrame) -> DataFrame:
    """W10 + J9 input: per parent the child with the latest effective time
    (Oracle DESC puts nulls first; ACCOUNTID breaks ties)."""
    w = Window.partitionBy("PARENTACCOUNTID").orderBy(F.col("NEW_EFFTECTTIME").desc_nulls_first(), F.col("ACCOUNTID"))
    return (
        account.filter(F.col("ACCOUNTID").isNotNull() & F.col("NEW_JDECODE").isNotNull())
        .withColumn("rn", F.row_number().over(w))
        .filter(F.col("rn") == 1)
        .drop("rn")
    )


def payer_of(account: DataFrame) -> DataFrame:
    """(booked, PayerAccountId): the payer of a visit by the level of the booked account --
    itself, its parent or its latest child. Accounts of other levels have none."""
    child = latest_child(account).select(F.col("PARENTACCOUNTID").alias("_parent"), F.col("ACCOUNTID").alias("_child"))
    level = F.col("NEW_LEVELTYPE")
    payer = (
        F.when(level == PAYER_LEVEL, F.col("ACCOUNTID"))
        .when(level == SHIPTO_LEVEL, F.col("PARENTACCOUNTID"))
        .when(level == CUSTOMER_LEVEL, F.col("_child"))
    )
    joined = account.join(child, (F.col("ACCOUNTID") == F.col("_parent")) & (level == CUSTOMER_LEVEL), "left")
    return joined.select(F.col("ACCOUNTID").alias("booked"), payer.alias("PayerAccountId")).where(F.col("PayerAccountId").isNotNull())


def payer_attributes(t: dict[str, DataFrame]) -> DataFrame:
    """(PayerAccountId, SalesOrg, PayerId, Payer, SalesUserSystemId) of every account with a company
    and a user."""
    acc, co, su = t["account"].alias("acc"), t["company"].alias("co"), t["systemuser"].alias("su")
    joined = acc.join(co, F.col("acc.NEW_COMPANYID") == F.col("co.NEW_COMPANYID")).join(su, F.col("su.SYSTEMUSERID") == F.col("acc.OWNERID"))
    return joined.select(
        F.col("acc.ACCOUNTID").alias("PayerAccountId"),
        F.col("co.NEW_CODE").alias("SalesOrg"),
        F.col("acc.NEW_JDECODE").alias("PayerId"),
        F.col("acc.NAME").alias("Payer"),
        F.col("su.SYSTEMUSERID").alias("SalesUserSystemId"),
    )


def complaints(t: dict[str, DataFrame]) -> DataFrame:
    """Judged complaints with their feedback and action texts, still without the payer's
    attributes."""
    judge = t["datadict"].filter((F.upper("TABLENAME") == "NEW_COMPLAINT") & (F.col("FIELDNAME") == "new_judge"))
    fb = listagg_sorted(t["feedback"], "NEW_COMPLAINT", "NEW_BRIEFDESCRIPTION", "Feedback")
    cs = listagg_sorted(t["solution"], "NEW_COMPLAINT", "NEW_BRIEFDESCRIPTION", "CorrectiveActionPlan")
    df = (
        t["complaint"].alias("c")
        .join(judge.alias("j"), F.col("j.CODE") == F.col("c.NEW_JUDGE"))
        .join(fb.alias("fb"), F.col("c.NEW_COMPLAINTID") == F.col("fb.NEW_COMPLAINT"))
        .join(cs.alias("cs"), F.col("c.NEW_COMPLAINTID") == F.col("cs.NEW_COMPLAINT"))
    )
    return df.select(
        F.col("c.NEW_COMPLAINTID").alias("Id"),
        F.col("c.CREATEDON").cast("timestamp").alias("CreatedOn"),
        F.col("c.NEW_PAYER").alias("PayerAccountId"),
        F.col("c.NEW_CONTACT").alias("CustomerContactPerson"),
        F.col("c.NEW_CONTACT_PHONE").alias("CustomerContactPhone"),
        F.col("fb.Feedback"),
        F.col("cs.CorrectiveActionPlan"),
        F.col("j.VALUE").alias("Judge"),
        F.lit(COMPLAINT_TYPE).alias("Type"),
    )


def visits(t: dict[str, DataFrame]) -> DataFrame:
    """Completed visits with their payer, still without the payer's attributes."""
    done = t["visit"].filter((F.col("NEW_VISITRESULT") == 20) & F.col("NEW_CUSTOMER").isNotNull()).alias("v")
    return done.join(payer_of(t["account"]), F.col("v.NEW_CUSTOMER") == F.col("booked")).select(
        F.col("v.NEW_CUSTOMERVISITID").alias("Id"),
        F.col("v.CREATEDON").cast("timestamp").alias("CreatedOn"),
        "PayerAccountId",
        F.col("v.NEW_CONTRACTOR").alias("CustomerContactPerson"),
        F.col("v.NEW_CONTRACTPHONE").alias("CustomerContactPhone"),
        F.col("v.NEW_FEEDBACKSCORE").cast("string").alias("Feedback"),
        F.col("v.NEW_HANDLERECORD").cast("string").alias("CorrectiveActionPlan"),
        F.lit(None).cast("string").alias("Judge"),  # Oracle '' is NULL
        F.lit(VISIT_TYPE).alias("Type"),
    )


def crm_feed(t: dict[str, DataFrame]) -> DataFrame:
    """Complaints and visits in one feed."""
    facts = complaints(t).unionByName(visits(t))
    return facts.join(payer_attributes(t), "PayerAccountId").select(*FEED_COLUMNS)
