"""Delivery — B9, B12, B13, B15, B16, C16, C18, C19, D-7, H13, H14, I8, I9."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from slotwise.functions.keys import click_token, null_literals, status_flag
from slotwise.operators.campaigns import drop_matching
from slotwise.operators.skew import salted_join, salts_for
from slotwise.operators.util import broadcast_checked

# Output contract renames (fixed names of the reference's delivery format).
OUTPUT_RENAMES = {
    "tpid": "TPID", "eapid": "EAPID", "first_name": "FIRST_NAME", "last_name": "LAST_NAME",
    "lang_id": "LANG_ID", "mer_status": "IsMER", "paid": "PAID", "email_address": "EmailAddress",
}
LOYALTY_RENAMES = {
    "MemberID": "LoyaltyMemberID", "LRMTierName": "LoyaltyMemberTierName",
    "LRMAvailablePoints": "LoyaltyAvailablePoints",
}
# Loyalty columns of a run without a members table.
LOYALTY_COLUMNS = {
    "MemberID": "string", "LRMTierName": "string", "MonetaryValue": "double", "LRMAvailablePoints": "bigint", "LRMStatus": "string",
}
# Fixed values (must equal the reference's): columns dropped from the delivered table.
LOYALTY_DROPPED = ("LANG_ID", "LRMPendingPoints")
FINAL_DROPPED = ("AudienceTableName", "LRMStatus", "campaign_priority")
DROPPED_SUBSTRING = "authrealm"


def token_table_for_scope(token_config: DataFrame, scope) -> DataFrame:
    """I8: the token table configured for the scope (one row; lowest name on ties)."""
    from slotwise.functions.keys import normalize_locale
    from slotwise.operators.campaigns import in_scope

    return in_scope(normalize_locale(token_config), scope).select("UserTokenTableName").orderBy("UserTokenTableName").limit(1)


def has_account(df: DataFrame) -> DataFrame:
    """Rows without an account id are not sent."""
    return df.filter(F.col("paid").isNotNull())


def add_tokens(df: DataFrame, account_tokens: DataFrame | None, subscriber_tokens: DataFrame | None, heavy: list[str] | None = None) -> DataFrame:
    """C16 + H13 + H14: click token from the account table, else the subscriber
    table, else ``""``. Two left joins on the same key: the second reuses the
    first one's partitioning, so only the token tables are shuffled again, and
    a table that is bucketed by its key (``tables.write_bucketed``) not even once.
    ``heavy``: accounts (as text) whose rows are spread over the partitions.
    A run without one of the tables finds no token in it."""
    out, found = df, []
    for name, key, t in (("a", "ProtoAccountID", account_tokens), ("s", "SubscriberID", subscriber_tokens)):
        if t is not None:
            side = t.select(F.col(key).alias("paid"), click_token("UserToken").alias(f"_tok_{name}"))
            out = salted_join(out, side, ["paid"], "left", heavy or [], salts_for(df))
            found.append(f"_tok_{name}")
    return out.withColumn("UserToken", F.coalesce(*found, F.lit(""))).drop("_tok_a", "_tok_s").select(*df.columns, "UserToken")


def add_module_count(df: DataFrame, counts: DataFrame, max_broadcast_rows: int = 2_000_000, known: tuple[int, int] | None = None) -> DataFrame:
    """Per-campaign slot count (Q23), campaign id compared as int."""
    c = counts.select(F.col("campaign_id").cast("int").alias("_cid"), "AudienceTableName", "ModuleCount")
    out = df.drop("ModuleCount").join(broadcast_checked(c, max_broadcast_rows, known, closer=True), F.col("campaign_id") == F.col("_cid"))
    return out.drop("_cid")


def dedupe_recipients(
    df: DataFrame, keys=("email_address", "paid"), order=("campaign_priority", "campaign_id"), per_campaign_col: str | None = None
) -> DataFrame:
    """D-7: one row per (address, account); the survivor is the lowest
    (campaign priority, campaign id, audience table) instead of an arbitrary row.

    ``per_campaign_col`` names a column that, where set, joins the key — used
    so each seed address keeps one row per campaign (Q10).
    """
    order_cols = [F.col(c).asc_nulls_last() for c in order] + [F.col("AudienceTableName").asc_nulls_last(), row_hash(df)]
    part = [F.col(k) for k in keys] + ([F.col(per_campaign_col)] if per_campaign_col else [])
    w = Window.partitionBy(*part).orderBy(*order_cols)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def row_hash(df: DataFrame):
    """Last-resort tiebreak: a hash of the whole row, so that rows differing in
    any column are always ordered the same way (identical rows tie harmlessly)."""
    return F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])


def add_loyalty(df: DataFrame, members: DataFrame | None) -> DataFrame:
    """C19 + B16: loyalty fields by (TPID, PAID); status becomes a ``"1"``/``"0"`` flag.
    Without a members table the fields are null and the flag is ``"0"``."""
    if members is None:
        out = df.withColumns({c: F.lit(None).cast(t) for c, t in LOYALTY_COLUMNS.items()})
    else:
        out = df.join(members.drop(*LOYALTY_DROPPED), ["TPID", "PAID"], "left")
    out = out.withColumnsRenamed(LOYALTY_RENAMES)
    return out.withColumn("LoyaltyMemberStatus", status_flag("LRMStatus"))


def finalize(df: DataFrame, members: DataFrame | None) -> DataFrame:
    """I9 (after module counts and dedupe): null literals, contract renames and
    copies, loyalty join, dropped columns."""
    out = null_literals(df)
    out = out.withColumnsRenamed(OUTPUT_RENAMES)
    out = out.withColumn("SubjectLine", F.col("S1_P1")) if "S1_P1" in out.columns else out
    out = out.withColumn("PM_OK_IND", F.col("IsMER"))
    out = add_loyalty(out, members)
    return drop_matching(out, FINAL_DROPPED, DROPPED_SUBSTRING)
