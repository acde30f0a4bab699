"""Shares of loan applications, each from one pass over the table."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from swipeledger.functions.money import percent


def pct_self_employed_approved(loans: DataFrame) -> DataFrame:
    """Approved self-employed applications as a share of all applications."""
    approved = F.count_if(_self_employed() & _status("Y"))
    return _share(loans, approved, F.count("*"), "approved_pct")


def approval_rate_self_employed(loans: DataFrame) -> DataFrame:
    """Approved applications as a share of the self-employed ones."""
    approved = F.count_if(_self_employed() & _status("Y"))
    return _share(loans, approved, F.count_if(_self_employed()), "approved_pct")


def pct_rejected_married_male(loans: DataFrame) -> DataFrame:
    """Rejected applications as a share of those by married men."""
    rejected = F.count_if(_married_male() & _status("N"))
    return _share(loans, rejected, F.count_if(_married_male()), "rejected_pct")


def _self_employed() -> Column:
    return F.col("Self_Employed") == "Yes"


def _married_male() -> Column:
    return (F.col("Gender") == "Male") & (F.col("Married") == "Yes")


def _status(status: str) -> Column:
    return F.col("Application_Status") == status


def _share(loans: DataFrame, part: Column, whole: Column, name: str) -> DataFrame:
    return loans.agg(percent(part, whole).alias(name)).withColumn("other_pct", 100 - F.col(name))
