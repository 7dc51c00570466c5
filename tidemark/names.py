"""Column names and markers that existing tables already carry.

They are stored data, so they must stay exactly as they are.
"""

# Columns of a history (SCD type 2) table.
VALID_FROM = "dbt_valid_from"
VALID_TO = "dbt_valid_to"
SCD_ID = "dbt_scd_id"
UPDATED_AT = "dbt_updated_at"
IS_DELETED = "dbt_is_deleted"
CHANGE_TYPE = "dbt_change_type"

# Text that stands for a null field inside a surrogate key.
SURROGATE_NULL = "_dbt_utils_surrogate_key_null_"

# Column naming the table a unioned row came from.
SOURCE_RELATION = "_dbt_source_relation"

# Upper end of an interval that is still open.
END_OF_TIME = "9999-12-31 00:00:00"

# Risk scores above this value are high risk.
HIGH_RISK_ABOVE = 70
HIGH_RISK_TEXT = "High Risk"
LOW_RISK_TEXT = "Low Risk"

# Share of the amount that makes the score of a silver event.
AMOUNT_SCORE_RATE = 0.01
