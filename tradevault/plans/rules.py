"""Rule catalogue: rule text per table (fixed values), with templates shared by every code list."""

from __future__ import annotations

COMMON = {
    "code_not_null": "{code_col} IS NOT NULL",
    "name_not_null": "{name_col} IS NOT NULL",
    "effective_start_not_null": "effective_start_date IS NOT NULL",
    "effective_window_ordered": "effective_end_date >= effective_start_date",
    "source_authority_not_null": "source_authority IS NOT NULL",
    "record_source_not_null": "record_source IS NOT NULL",
    "is_active_not_null": "is_active IS NOT NULL",
}

# Fixed values. The event taxonomy has suffixed codes and 99 rows, so its pattern and its band follow the taxonomy itself.
TABLES = {
    "ref_cat_event_type": {
        "code_alpha_3_10": "cat_event_type_code RLIKE '^[A-Z]{3,10}$'",
        "category_enum": "category IS NULL OR category IN ('ORDER_REQUEST','ORDER','ROUTING','MODIFICATION','EXECUTION','ALLOCATION','QUOTE','COMBINED_ORDER','REPRESENTATIVE_ORDER','MANUAL')",
        "phase_enum": "phase IS NULL OR phase IN ('2a','2b','2c','2d','2e')",
    },
    "ref_mic": {
        "mic_code_4_upper_alnum": "mic_code RLIKE '^[A-Z0-9]{4}$'",
        "country_code_iso3166": "country_code IS NULL OR country_code RLIKE '^[A-Z]{2}$'",
        "status_enum": "status IS NULL OR status IN ('ACTIVE','DELETED','MODIFIED','EXPIRED')",
    },
    "ref_country": {
        "country_code_2_alpha": "country_code RLIKE '^[A-Z]{2}$'",
        "alpha_3_valid": "alpha_3_code IS NULL OR alpha_3_code RLIKE '^[A-Z]{3}$'",
        "numeric_code_3_digits": "numeric_code IS NULL OR numeric_code RLIKE '^[0-9]{3}$'",
        "category_enum": "category IS NULL OR category IN ('AMERICAS','EMEA','APAC','AFRICA')",
    },
    "ref_currency": {
        "currency_code_3_alpha": "currency_code RLIKE '^[A-Z]{3}$'",
        "minor_unit_valid": "minor_unit IS NULL OR minor_unit BETWEEN 0 AND 8",
        "category_enum": "category IS NULL OR category IN ('FIAT','CRYPTO','PRECIOUS_METAL','FUND','OTHER')",
    },
    "ref_cfi_category": {
        "cfi_code_6_chars": "cfi_code RLIKE '^[A-Z-]{6}$'",
        "category_prefix_valid": "category IS NULL OR category IN ('E','D','R','O','F','S','H','I','J','K','L','M','T')",
    },
    "ref_entity_legal_form": {
        "elf_code_4_alnum": "elf_code RLIKE '^[A-Z0-9]{4}$'",
        "country_code_iso3166": "country_code IS NULL OR country_code RLIKE '^[A-Z]{2}$'",
    },
    "ref_order_type": {
        "fix_tag_40_numeric": "fix_tag_40_value IS NULL OR fix_tag_40_value RLIKE '^[A-Z0-9]{1,3}$'",
        "category_enum": "category IS NULL OR category IN ('SIMPLE','CONDITIONAL','PEGGED','ALGO','DISCRETIONARY')",
    },
    "ref_time_in_force": {
        "tif_code_upper": "tif_code RLIKE '^[A-Z_]{2,20}$'",
        "fix_tag_59_numeric": "fix_tag_59_value IS NULL OR fix_tag_59_value RLIKE '^[0-9]{1,2}$'",
    },
    "ref_handling_instruction": {
        "handling_upper": "handling_instruction_code RLIKE '^[A-Z_]{3,40}$'",
        "fix_tag_21_value_enum": "fix_tag_21_value IS NULL OR fix_tag_21_value IN ('1','2','3')",
    },
    "ref_party_role": {
        "party_role_upper": "party_role_code RLIKE '^[A-Z_]{3,40}$'",
        "regulatory_capacity_enum": "regulatory_capacity IS NULL OR regulatory_capacity IN ('PRINCIPAL','AGENCY','RISKLESS_PRINCIPAL','FIDUCIARY')",
    },
    "ref_instrument_type": {
        "instrument_type_upper": "instrument_type_code RLIKE '^[A-Z_]{3,40}$'",
        "asset_class_enum": "asset_class IS NULL OR asset_class IN ('EQUITY','FIXED_INCOME','FX','COMMODITY','CRYPTO','RATES','CREDIT','EQUITY_DERIVATIVE')",
        "cfi_prefix_1_char": "cfi_category_prefix IS NULL OR length(cfi_category_prefix) = 1",
    },
    "ref_day_count": {
        "day_count_upper": "day_count_code RLIKE '^[A-Z0-9_/.]{3,40}$'",
        "category_enum": "category IS NULL OR category IN ('ACTUAL','30_360','BUSINESS_252')",
    },
    "ref_settlement_venue": {
        "bic_valid_when_present": "bic_code IS NULL OR bic_code RLIKE '^[A-Z]{6}[A-Z0-9]{2}([A-Z0-9]{3})?$'",
        "t_plus_nonneg": "t_plus_standard IS NULL OR t_plus_standard >= 0",
        "category_enum": "category IS NULL OR category IN ('CSD','ICSD','CCP','CASH_CSD')",
    },
    "ref_regulator": {
        "regulator_upper": "regulator_code RLIKE '^[A-Z_]{2,20}$'",
        "jurisdiction_enum": "jurisdiction_scope IS NULL OR jurisdiction_scope IN ('NATIONAL','FEDERAL','STATE','SUPRANATIONAL')",
    },
    "ref_credit_rating_scale": {
        "rating_agency_enum": "rating_agency IN ('SP','MOODYS','FITCH','DBRS','JCR','R_AND_I','SCOPE','KROLL')",
        "agency_scale_enum": "agency_scale IN ('LONG_TERM','SHORT_TERM','ISSUER','ISSUE','RECOVERY')",
        "default_prob_nonneg": "default_probability IS NULL OR default_probability BETWEEN 0 AND 1",
        "basel_risk_weight_range": "basel_risk_weight IS NULL OR basel_risk_weight BETWEEN 0 AND 1.5",
    },
    "ref_tax_jurisdiction": {
        "country_code_iso3166": "country_code RLIKE '^[A-Z]{2}$'",
        "default_withhold_range": "default_withholding_rate IS NULL OR default_withholding_rate BETWEEN 0 AND 1",
        "treaty_withhold_range": "treaty_withholding_rate IS NULL OR treaty_withholding_rate BETWEEN 0 AND 1",
        "category_enum": "category IS NULL OR category IN ('FEDERAL','STATE','PROVINCIAL','MUNICIPAL','SUPRANATIONAL')",
    },
}

ORDER_EVENT = {
    "firm_roe_id_required": "firm_roe_id IS NOT NULL",
    "dv2_source_hk_required": "dv2_source_hk IS NOT NULL",
    "cat_event_code_required": "cat_event_code IS NOT NULL",
    "event_timestamp_required": "event_timestamp IS NOT NULL",
    "event_date_required": "event_date IS NOT NULL",
    "cat_event_code_format": "cat_event_code RLIKE '^[A-Z]{3,10}(_[A-Z])?$'",
    "side_enum": "side IS NULL OR side IN ('BUY','SELL','SELL_SHORT','SELL_SHORT_EXEMPT')",
}
RESOLVED = {
    "sk_party_resolved": "dim_party_sk IS NOT NULL",
    "sk_instrument_resolved": "dim_instrument_sk IS NOT NULL",
}
ALLOCATION = {
    "firm_roe_id_required": "firm_roe_id IS NOT NULL",
    "dv2_source_hk_required": "dv2_source_hk IS NOT NULL",
    "cat_event_code_required": "cat_event_code IS NOT NULL",
    "allocation_timestamp_required": "allocation_timestamp IS NOT NULL",
    "allocation_method_enum": "allocation_method IS NULL OR allocation_method IN ('PRO_RATA','MANUAL','FIFO','LIFO','AVG_PRICE')",
    "allocated_quantity_nonneg": "allocated_quantity IS NULL OR allocated_quantity >= 0",
}
QUOTE = {
    "firm_roe_id_required": "firm_roe_id IS NOT NULL",
    "dv2_source_hk_required": "dv2_source_hk IS NOT NULL",
    "cat_event_code_required": "cat_event_code IS NOT NULL",
    "quote_timestamp_required": "quote_timestamp IS NOT NULL",
    "quote_side_enum": "quote_side IS NULL OR quote_side IN ('BID','OFFER','TWO_WAY')",
    "quote_type_enum": "quote_type IS NULL OR quote_type IN ('INDICATIVE','FIRM','TRADEABLE')",
    "bid_ask_consistent": "NOT (quote_side = 'TWO_WAY' AND (bid_price IS NULL OR ask_price IS NULL))",
}
MULTILEG_LEGS = {
    "leg_side_enum": "leg_side IN ('BUY','SELL')",
    "leg_quantity_positive": "leg_quantity IS NOT NULL AND leg_quantity > 0",
    "leg_ratio_positive": "leg_ratio IS NOT NULL AND leg_ratio > 0",
}
MULTILEG_HEADER = {"leg_count_at_least_2": "leg_count >= 2", "leg_count_capped": "leg_count <= 50"}
ACCOUNT = {
    "non_null_firm_designated_id": "firm_designated_id IS NOT NULL",
    "non_null_cat_reporter_crd": "cat_reporter_crd IS NOT NULL AND cat_reporter_crd > 0",
    "valid_fdid_type": "fdid_type IN ('ACCOUNT','RELATIONSHIP','ENTITYID')",
    "valid_end_reason": "fdid_end_reason IS NULL OR fdid_end_reason IN ('CORRECTION','ENDED','INACTIVE','REPLACED','OTHER','TRANSFER')",
    "trdholder_required": "has_active_trdholder = TRUE OR fdid_end_date IS NOT NULL",
}
CUSTOMER = {
    "non_null_customer_record_id": "customer_record_id IS NOT NULL",
    "non_null_cat_reporter_crd": "cat_reporter_crd IS NOT NULL AND cat_reporter_crd > 0",
    "valid_customer_type": "customer_type IN ('NATURAL_PERSON','LEGAL_ENTITY')",
    "must_have_fdid": "fdid_count >= 1",
}
SUBMISSION = {
    "non_null_filename": "submission_filename IS NOT NULL",
    "non_null_submitter_id": "cat_submitter_id IS NOT NULL",
    "non_null_reporter_crd": "cat_reporter_crd IS NOT NULL AND cat_reporter_crd > 0",
    "valid_file_type": "file_type IN ('CAIS_DATA_FILE','TRANSFORMED_IDENTIFIERS_FILE')",
    "valid_submission_action": "submission_action IN ('NEW','UPDATE','REFRESH','FIRM_CORRECTION','REPAIR','REPLACEMENT','MASS_TRANSFER')",
}


def rules_for(table: str, code_col: str, name_col: str | None = None) -> dict[str, str]:
    """Common rules with the table's own columns filled in, then the table's rules."""
    out = {}
    for name, text in COMMON.items():
        if "{name_col}" in text and name_col is None:
            continue
        out[name] = text.format(code_col=code_col, name_col=name_col)
    return {**out, **TABLES.get(table, {})}
