"""Customer-account snapshots and the file-based flows that change their state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradevault.functions.hashing import hash_key, row_hash
from tradevault.operators.joins import attach_counts, exists_flag
from tradevault.operators.quality import expect
from tradevault.plans import rules
from tradevault.plans.facts import current_rows, open_roles, with_constants

PAIR_MINUTES = 60
FILE_VERSION = "2.0.0"


# ---- snapshots ---------------------------------------------------------------------------------------------------------


def account_snapshot(
    hub: DataFrame, state: DataFrame, roles: DataFrame, large_traders: DataFrame, as_of: str, mode: str = "fail"
) -> DataFrame:
    """One row per account with its open customer count, trade-holder flag and large-trader flag."""
    open_cust, open_lt = open_roles(roles, "role_end_date"), open_roles(large_traders, "ltid_end_date")
    out = hub.join(current_rows(state), "cais_fdid_hk")
    out = attach_counts(out, open_cust, ["cais_fdid_hk"], "customer_count")
    out = exists_flag(out, open_cust, ["cais_fdid_hk"], "has_active_trdholder", "customer_role = 'TRDHOLDER'")
    out = exists_flag(out, open_lt, ["cais_fdid_hk"], "has_active_ltid")
    return expect(out.withColumn("as_of_date", F.to_date(F.lit(as_of))), rules.ACCOUNT, mode)


def customer_snapshot(hub: DataFrame, state: DataFrame, roles: DataFrame, as_of: str, mode: str = "fail") -> DataFrame:
    """One row per customer with its open account count; at least one is required."""
    out = hub.join(current_rows(state), "cais_customer_hk")
    out = attach_counts(out, open_roles(roles, "role_end_date"), ["cais_customer_hk"], "fdid_count")
    out = with_constants(out, {"has_pii_in_tid": (True, "boolean")})
    return expect(out.withColumn("as_of_date", F.to_date(F.lit(as_of))), rules.CUSTOMER, mode)


def submission_registry(link: DataFrame, mode: str = "fail") -> DataFrame:
    """One row per file with counts still unknown; feedback fills them later."""
    out = with_constants(
        link,
        {
            "fdid_record_count": (None, "int"), "natural_person_record_count": (None, "int"),
            "legal_entity_record_count": (None, "int"), "accepted": (False, "boolean"), "error_count": (0, "int"),
            "rejection_count": (0, "int"), "inconsistency_count": (0, "int"),
        },
    )
    return expect(out, rules.SUBMISSION, mode)


# ---- submission precheck -----------------------------------------------------------------------------------------------


def precheck(files: DataFrame) -> DataFrame:
    """Accept or reject each submission stem; rejected ones are kept with the reason.

    ``files``: submission_filename (``submitter_reporter_date_group_no`` and a suffix), file_type, posted_ts, version,
    reporter_crd. The pair is found by grouping on the stem, so no self-join is needed.
    """
    parts = F.split(F.regexp_extract("submission_filename", r"^([^.]*)", 1), "_")
    staged = files.withColumns(
        {"stem": F.array_join(F.slice(parts, 1, 5), "_"), "stem_crd": F.element_at(parts, 2), "stem_parts": F.size(parts)}
    )

    def of(kind: str, col: str) -> Column:
        return F.min(F.when(F.col("file_type") == kind, F.col(col)))

    data, ids = "CAIS_DATA_FILE", "TRANSFORMED_IDENTIFIERS_FILE"
    pair = staged.groupBy("stem").agg(
        of(data, "posted_ts").alias("data_ts"), of(ids, "posted_ts").alias("ids_ts"), of(data, "version").alias("version"),
        of(data, "reporter_crd").alias("reporter_crd"), F.min("stem_crd").alias("stem_crd"),
    )
    gap = F.abs(F.unix_micros("data_ts") - F.unix_micros("ids_ts"))
    reason = (
        F.when(F.col("data_ts").isNull() | F.col("ids_ts").isNull(), "UNPAIRED")
        .when(gap > PAIR_MINUTES * 60_000_000, "PAIR_TOO_FAR_APART")
        .when(~F.col("version").eqNullSafe(F.lit(FILE_VERSION)), "WRONG_VERSION")
        .when(~F.col("reporter_crd").cast("string").eqNullSafe(F.col("stem_crd")), "REPORTER_MISMATCH")
    )
    return pair.withColumn("rejection_reason", reason).withColumn("accepted", F.col("rejection_reason").isNull())


# ---- NEW ---------------------------------------------------------------------------------------------------------------


def account_key(reporter: Column | str = "cat_reporter_crd", fdid: Column | str = "firm_designated_id") -> Column:
    return hash_key([reporter, fdid])


def new_records(records: DataFrame, hub: DataFrame, large_trader_hub: DataFrame, state_cols: list[str]) -> dict[str, DataFrame]:
    """Rows to insert for a NEW submission, per target table.

    ``records``: cat_reporter_crd, firm_designated_id, state columns, load_dts and the arrays ``addresses`` (addr_type,
    city), ``customers`` (customer_record_id, customer_role, role_start_date) and ``large_traders`` (ltid,
    ltid_effective_date). Hash keys are deterministic, so a repeated file adds nothing.
    """
    r = records.withColumn("cais_fdid_hk", account_key())
    fresh = r.join(hub.select("cais_fdid_hk"), "cais_fdid_hk", "left_anti")
    lt = fresh.select("cais_fdid_hk", "load_dts", F.explode("large_traders").alias("x")).select("cais_fdid_hk", "load_dts", "x.*")
    lt = lt.withColumn("large_trader_hk", hash_key(["ltid"]))
    cust = fresh.select("cais_fdid_hk", "load_dts", F.explode("customers").alias("x")).select("cais_fdid_hk", "load_dts", "x.*")
    return {
        "hub_cais_fdid": fresh.groupBy("cais_fdid_hk", "cat_reporter_crd", "firm_designated_id").agg(F.min("load_dts").alias("load_dts")),
        "sat_cais_fdid_state": fresh.select(
            "cais_fdid_hk", *state_cols, "load_dts", F.lit(None).cast("timestamp").alias("load_end_dts"), row_hash(state_cols).alias("hash_diff")
        ),
        "sat_cais_fdid_address": fresh.select("cais_fdid_hk", "load_dts", F.explode("addresses").alias("x")).select("cais_fdid_hk", "load_dts", "x.*"),
        "link_cais_fdid_customer": cust.select(
            "cais_fdid_hk", "customer_record_id", "customer_role", F.coalesce("role_start_date", F.to_date("load_dts")).alias("role_start_date"),
            F.lit(None).cast("date").alias("role_end_date"), F.lit(None).cast("string").alias("role_end_reason"),
        ),
        "hub_cais_large_trader": lt.groupBy("large_trader_hk", "ltid").agg(F.min("load_dts").alias("load_dts")).join(
            large_trader_hub.select("large_trader_hk"), "large_trader_hk", "left_anti"
        ),
        "link_cais_fdid_large_trader": lt.select(
            "cais_fdid_hk", "large_trader_hk", "ltid_effective_date", F.lit(None).cast("date").alias("ltid_end_date"),
            F.lit(None).cast("string").alias("ltid_end_reason"),
        ),
    }


# ---- UPDATE, REFRESH, FIRM_CORRECTION, REPAIR ----------------------------------------------------------------------------


def reconcile_roles(prior: DataFrame, submitted: DataFrame, change_date: Column) -> DataFrame:
    """Compare open roles with a full-state submission and label each (account, customer).

    IMPLICIT_END: open before, omitted now. ROLE_CHANGED: close the old row and open a new one. ADDED: open a row.
    UNCHANGED: nothing. Accounts that are not in the submission are left alone.
    """
    accounts = submitted.select("cais_fdid_hk").distinct()
    key = ["cais_fdid_hk", "customer_record_id"]
    before = prior.join(accounts, "cais_fdid_hk", "left_semi").select(*key, F.col("customer_role").alias("prior_role"), F.col("role_start_date").alias("prior_start"))
    # an account may be submitted with no customer at all: that row only marks the account
    now = submitted.filter("customer_record_id is not null").select(*key, "customer_role")
    both = before.join(now, key, "full_outer")
    action = (
        F.when(F.col("customer_role").isNull(), "IMPLICIT_END")
        .when(F.col("prior_role").isNull(), "ADDED")
        .when(F.col("prior_role") != F.col("customer_role"), "ROLE_CHANGED")
        .otherwise("UNCHANGED")
    )
    return both.withColumn("action", action).withColumn("change_date", change_date)


def role_rows(actions: DataFrame) -> DataFrame:
    """Link rows that result from the actions: closed old rows and opened new ones."""
    closed = actions.filter(F.col("action").isin("IMPLICIT_END", "ROLE_CHANGED")).select(
        "cais_fdid_hk", "customer_record_id", F.col("prior_role").alias("customer_role"), F.col("prior_start").alias("role_start_date"),
        F.col("change_date").alias("role_end_date"),
        F.when(F.col("action") == "IMPLICIT_END", "ENDED").otherwise("OTHER").alias("role_end_reason"),
    )
    opened = actions.filter(F.col("action").isin("ADDED", "ROLE_CHANGED")).select(
        "cais_fdid_hk", "customer_record_id", "customer_role", F.col("change_date").alias("role_start_date"),
        F.lit(None).cast("date").alias("role_end_date"), F.lit(None).cast("string").alias("role_end_reason"),
    )
    return closed.unionByName(opened)


def state_changes(current: DataFrame, submitted: DataFrame, state_cols: list[str], action: str = "UPDATE") -> DataFrame:
    """Satellite rows of an update: closed prior rows and opened new rows, only where the hash differs.

    A submitted account that does not exist is opened as NEW. A firm correction is marked as such.
    """
    new = submitted.select("cais_fdid_hk", *state_cols, "load_dts", row_hash(state_cols).alias("hash_diff"))
    old = current_rows(current).select("cais_fdid_hk", *[F.col(c).alias(f"__{c}") for c in state_cols], F.col("load_dts").alias("__load"), F.col("hash_diff").alias("__hash"))
    both = new.join(old, "cais_fdid_hk", "left").filter(F.col("__hash").isNull() | (F.col("__hash") != F.col("hash_diff")))
    mark = F.lit("FIRM" if action == "FIRM_CORRECTION" else None).cast("string")
    opened = both.select(
        "cais_fdid_hk", *state_cols, "load_dts", F.lit(None).cast("timestamp").alias("load_end_dts"), "hash_diff",
        F.when(F.col("__hash").isNull(), "NEW").otherwise(F.lit(action)).alias("submission_action"), mark.alias("correction_indicator"),
    )
    closed = both.filter("__hash is not null").select(
        "cais_fdid_hk", *[F.col(f"__{c}").alias(c) for c in state_cols], F.col("__load").alias("load_dts"), F.col("load_dts").alias("load_end_dts"),
        F.col("__hash").alias("hash_diff"), F.lit(action).alias("submission_action"), F.lit(None).cast("string").alias("correction_indicator"),
    )
    return opened.unionByName(closed)


# ---- END, REPLACED, MASS_TRANSFER ----------------------------------------------------------------------------------------


def end_accounts(ended: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Valid and rejected END records; a CORRECTION must end on the account's own date."""
    bad = (F.col("fdid_end_reason") == "CORRECTION") & ~F.col("fdid_end_date").eqNullSafe(F.col("fdid_date"))
    return ended.filter(~bad), ended.filter(bad).withColumn("rejection_reason", F.lit("CORRECTION_DATE_MISMATCH"))


def cascade_end(ended: DataFrame, links: DataFrame, end_col: str, reason_col: str) -> DataFrame:
    """Open links of ended accounts take over the end date and reason; all other links pass through unchanged."""
    e = ended.select("cais_fdid_hk", F.col("fdid_end_date").alias("__d"), F.col("fdid_end_reason").alias("__r"))
    hit = F.col(end_col).isNull() & F.col("__d").isNotNull()
    return links.join(e, "cais_fdid_hk", "left").withColumns(
        {
            reason_col: F.when(hit, F.col("__r")).otherwise(F.col(reason_col)),
            end_col: F.when(hit, F.col("__d")).otherwise(F.col(end_col)),
        }
    ).drop("__d", "__r")


def replaced_accounts(replaced: DataFrame, hub: DataFrame, in_file: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Replacements whose target exists (stored or in the file), and inconsistency rows for the rest.

    ``replaced``: cat_reporter_crd, firm_designated_id, replaced_by_fdid.
    """
    target = replaced.withColumn("target_hk", account_key(fdid="replaced_by_fdid"))
    known = hub.select(F.col("cais_fdid_hk").alias("target_hk")).unionByName(in_file.select(account_key().alias("target_hk"))).distinct()
    found = target.join(known, "target_hk", "left_semi").withColumn("fdid_end_reason", F.lit("REPLACED"))
    missing = target.join(known, "target_hk", "left_anti").select(
        F.lit("REPLACING_FDID_NOT_FOUND").alias("inconsistency_code"), F.lit("MATERIAL").alias("severity"),
        F.col("firm_designated_id").cast("string").alias("affected_record_id"), F.lit("FDID").alias("affected_record_type"),
    )
    return found, missing


def mass_transfer(records: DataFrame, hub: DataFrame) -> dict[str, DataFrame]:
    """End accounts under the prior reporter and open them under the new one.

    ``records``: cat_reporter_crd, firm_designated_id, prior_cat_reporter_crd, prior_cat_reporter_fdid, event_date.
    A record whose prior account is unknown is rejected.
    """
    r = records.withColumns(
        {"cais_fdid_hk": account_key(), "prior_hk": account_key("prior_cat_reporter_crd", "prior_cat_reporter_fdid")}
    )
    known = hub.select(F.col("cais_fdid_hk").alias("prior_hk"))
    good = r.join(known, "prior_hk", "left_semi")
    return {
        "ended": good.select(
            F.col("prior_hk").alias("cais_fdid_hk"), F.col("event_date").alias("fdid_end_date"), F.lit("TRANSFER").alias("fdid_end_reason")
        ),
        "opened": good.select(
            "cais_fdid_hk", "cat_reporter_crd", "firm_designated_id", F.col("event_date").alias("fdid_date"),
            "prior_cat_reporter_crd", "prior_cat_reporter_fdid",
        ),
        "rejected": r.join(known, "prior_hk", "left_anti"),
    }


# ---- inconsistencies, identifiers, rejections ------------------------------------------------------------------------------


def inconsistency_changes(open_items: DataFrame, feedback: DataFrame, published: Column) -> DataFrame:
    """Open items after a feedback file: new ones are opened, those it omits are resolved, the rest stay open."""
    key = ["inconsistency_code", "affected_record_id"]
    o = open_items.select(*key, "detected_dts")
    f = feedback.select(*key).distinct().withColumn("__f", F.lit(True))
    both = o.join(f, key, "full_outer")
    return both.select(
        *key, F.coalesce("detected_dts", published).alias("detected_dts"),
        F.when(F.col("__f").isNull(), published).alias("resolved_dts"),
        F.when(F.col("__f").isNull(), "RESOLVED").when(F.col("detected_dts").isNull(), "OPENED").otherwise("STILL_OPEN").alias("change"),
    )


def replace_identifiers(state: DataFrame, replacements: DataFrame) -> DataFrame:
    """Close the prior customer's open state and open the new customer's; account links are not moved.

    ``replacements``: customer_record_id (new), correcting_customer_record_id (prior), customer_type, load_dts.
    """
    r = replacements.select(F.col("correcting_customer_record_id").alias("customer_record_id"), F.col("load_dts").alias("__end")).dropDuplicates(["customer_record_id"])
    closed = state.join(r, "customer_record_id", "left").withColumn("load_end_dts", F.coalesce("load_end_dts", "__end")).drop("__end")
    opened = replacements.select(
        "customer_record_id", "customer_type", "load_dts", F.lit(None).cast("timestamp").alias("load_end_dts"), "correcting_customer_record_id"
    )
    return closed.unionByName(opened, allowMissingColumns=True)


def outstanding_rejections(rejections: DataFrame, submissions: DataFrame, as_of: str) -> DataFrame:
    """Unresolved rejections with their submission, days to the repair date and an overdue flag."""
    day = F.to_date(F.lit(as_of))
    return (
        rejections.filter(F.col("resolved_dts").isNull())
        .join(submissions, "cais_submission_sk")
        .withColumn("days_to_repair", F.datediff(F.to_date("repair_due_dts"), day))
        .withColumn("is_overdue", F.col("days_to_repair") < 0)
    )
