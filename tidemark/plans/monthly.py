"""Monthly report per customer, account, branch and service, with loans."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.category import customer_category
from ..functions.dates import as_day, month_window
from ..operators.filters import between_days, in_month, on_previous_day
from ..operators.joins import join_on, join_using
from .runner import Frames, require

INPUTS = [
    "customers",
    "transactions",
    "accounts",
    "branches",
    "services",
    "transaction_details",
    "loans",
    "loan_payments",
]


def loan_summary(
    loans: DataFrame,
    payments: DataFrame,
    first_day: Column,
    last_day: Column,
    fan_out: bool = False,
) -> DataFrame:
    """Loans, rates and payments of a date range per customer.

    Payments are added up per loan before they meet the loans, so a loan counts
    once however often it was paid. ``fan_out`` counts a loan once per payment.
    """
    paid_on = F.col("PaymentDate").cast("date")
    paid = F.when(paid_on.between(first_day, last_day), F.col("PaymentAmount"))
    if not fan_out:  # then payments outside the range do not count at all
        payments = between_days(payments, "PaymentDate", first_day, last_day)
    per_loan = payments.groupBy("LoanID").agg(
        F.sum(paid.otherwise(F.lit(0))).alias("paid"), F.count("*").alias("payments")
    )
    weight = F.greatest(F.coalesce("payments", F.lit(0)), F.lit(1)) if fan_out else F.lit(1)
    rated = F.when(F.col("InterestRate").isNotNull(), weight)
    counted = F.when(F.col("LoanID").isNotNull(), weight)
    amount = F.sum(F.col("LoanAmount") * weight)
    # A customer none of whose loans was paid has paid 0, not NULL.
    total_paid = F.sum(F.coalesce("paid", F.lit(0)))
    rate = F.sum(F.col("InterestRate") * weight).cast("double")
    return (
        loans.join(per_loan, "LoanID", "left")
        .groupBy("CustomerID")
        .agg(
            amount.alias("TotalLoanAmount"),
            F.try_divide(rate, F.sum(rated)).alias("AverageInterestRate"),
            total_paid.alias("TotalLoanPayments"),
            (amount - total_paid).alias("RemainingLoanAmount"),
            F.coalesce(F.sum(counted), F.lit(0)).cast("long").alias("TotalLoans"),
        )
    )


def service_activity(
    transactions: DataFrame, details: DataFrame, services: DataFrame
) -> DataFrame:
    """Money and transactions per customer and service.

    Details meet the transactions first: a month of these leaves few of them.
    """
    owners = transactions.select("TransactionID", "CustomerID")
    amounts = details.select("TransactionID", "ServiceID", "Amount")
    return (
        join_using(amounts, owners, ["TransactionID"])
        .join(services.select("ServiceID", "ServiceName"), "ServiceID")
        .groupBy("CustomerID", "ServiceName")
        .agg(
            F.sum("Amount").alias("Amount"),
            F.count_distinct("TransactionID").alias("TotalTransactions"),
        )
    )


def monthly_customer_report(
    frames: Frames,
    data_date: str | dt.date,
    min_balance: float = 5000,
    min_detail: float = 100,
    min_loan: float = 5000,
    service_types: tuple[str, ...] = ("Banking", "Loan"),
    location_like: str = "%N%",
    all_branches: bool = False,
    fan_out: bool = False,
) -> DataFrame:
    """The month of the day before ``data_date``.

    Branches count if their location matches and they were loaded on that day;
    ``all_branches`` takes every branch. For ``fan_out`` see :func:`loan_summary`.

    One row per customer, balance, branch and service. Transactions and accounts
    of a customer are never paired up: activity is added up per customer and
    service first, accounts are counted per balance, and the sum over all pairs
    is the product of the two.
    """
    customers, transactions, accounts, branches, services, details, loans, payments = require(
        frames, INPUTS
    )
    window = month_window(data_date)

    held = (
        accounts.where(
            (F.col("Balance") > min_balance) & (F.col("OpenDate") <= as_day(data_date))
        )
        .groupBy("CustomerID", "Balance")
        .agg(F.count("*").alias("accounts"))
    )
    if not all_branches:
        branches = on_previous_day(
            branches.where(F.col("Location").like(location_like)), "ds_partition_date", data_date
        )
    located = branches.groupBy("BranchID", "BranchName", "Location").agg(
        F.count("*").alias("branches")
    )
    who = ["CustomerID", "Name", "Email", "AccountType"]
    place = ["BranchName", "Location"]
    # A branch listed more than once counts its customers as often.
    placed = (
        on_previous_day(customers, "ds_partition_date", data_date)
        .select(*who, "BranchID")
        .transform(join_using, located, ["BranchID"])
        .groupBy(*who, *place)
        .agg(F.sum("branches").alias("branches"))
    )
    activity = service_activity(
        in_month(transactions, "TransactionDate", data_date),
        details.where(F.col("Amount") > min_detail),
        services.where(F.col("ServiceType").isin(*service_types)),
    )
    started = between_days(
        loans.where(F.col("LoanAmount") > min_loan),
        "LoanStartDate",
        window.first_day,
        window.previous_day,
    )
    # Only payments on these few loans need adding up.
    paid = payments.where(F.col("PaymentAmount") > 0).select(
        "LoanID", "PaymentDate", "PaymentAmount"
    )
    paid = join_on(paid, started, ["LoanID"], "semi")
    owed = loan_summary(started, paid, window.first_day, window.last_day, fan_out)
    served = placed.join(activity, "CustomerID").join(owed, "CustomerID", "left")
    spent = F.col("Amount") * F.col("accounts") * F.col("branches")
    # Accounts come last: of a customer with very many of them only this join
    # sees many rows, and nothing after it keeps adaptive execution from
    # splitting a partition that they make too large.
    return (
        held.join(served, "CustomerID")
        .withColumn("TotalTransactionAmount", spent)
        .select(
            *who,
            *place,
            "Balance",
            "ServiceName",
            "TotalLoanAmount",
            "AverageInterestRate",
            "TotalLoanPayments",
            "RemainingLoanAmount",
            "TotalTransactionAmount",
            "TotalTransactions",
            customer_category(
                F.col("AccountType"), F.col("TotalTransactionAmount"), F.col("TotalLoanAmount")
            ).alias("CustomerCategory"),
        )
    )
