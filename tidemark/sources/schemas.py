"""Column lists of all tables, as DDL."""

# Table layouts.
APPLICATION_RAW = (
    "application_id string, src_load_ts timestamp_ntz, raw_json variant, "
    "batch_id decimal(38,0), etl_load_ts timestamp_ntz, etl_updt_ts timestamp_ntz"
)
PAYMENT_RAW = (
    "payment_id string, src_load_ts timestamp_ntz, raw_json variant, "
    "batch_id decimal(38,0), etl_load_ts timestamp_ntz, etl_updt_ts timestamp_ntz"
)
APPLICATION = (
    "application_id string, customer_id string, application_date date, "
    "amount_requested decimal(18,2), property_type string, status string, "
    "src_load_ts timestamp_ntz, batch_id decimal(38,0), "
    "etl_load_ts timestamp_ntz, etl_updt_ts timestamp_ntz"
)
PAYMENT = (
    "payment_id string, application_id string, payment_date date, "
    "payment_amount decimal(18,2), payment_status string, "
    "src_load_ts timestamp_ntz, batch_id decimal(38,0), "
    "etl_load_ts timestamp_ntz, etl_updt_ts timestamp_ntz"
)
PAYMENT_SUMMARY = (
    "application_id string, total_payments decimal(28,2), latest_payment_date date, "
    "num_payments bigint, last_status string, customer_id string, application_date date, "
    "amount_requested decimal(18,2), property_type string, application_status string, "
    "src_load_ts timestamp_ntz, hash_sk string, hash_seq_num string, "
    "start_ts timestamp_ntz, end_ts timestamp_ntz, active_flg string, reporting_flg string, "
    "batch_id decimal(38,0), etl_load_ts timestamp_ntz, etl_updt_ts timestamp_ntz"
)
PAYMENT_SUMS = (
    "hash_sk string, application_id string, payment_date date, payment_status string, "
    "src_load_ts timestamp_ntz, amount decimal(28,2), amounts bigint, payments bigint, "
    "batch_id decimal(38,0)"
)
# Columns that hold hashes.
HASHES = ("hash_sk", "hash_seq_num")
BATCH_LEDGER = (
    "pipeline_name string, batch_id decimal(38,0), batch_status string, "
    "start_ts timestamp_ntz, end_ts timestamp_ntz"
)
MODEL_AUDIT = (
    "model_id string, model_grp string, inc_load_ts timestamp_ntz, pipeline_name string, "
    "batch_id decimal(38,0), model_load_status string, rows_inserted bigint, "
    "rows_updated bigint, start_ts timestamp_ntz, end_ts timestamp_ntz, "
    "query_id string, query_text string"
)
DELETION_LOG = (
    "model_id string, model_grp string, pipeline_name string, pk string, "
    "src_load_ts timestamp_ntz, batch_id decimal(38,0), "
    "etl_load_ts timestamp_ntz, etl_updt_ts timestamp_ntz"
)
SCHEMA_DRIFT = (
    "model_id string, model_grp string, pipeline_name string, source_table string, "
    "target_table string, column_name string, source_column_type string, "
    "target_column_type string, diff_type string, batch_id decimal(38,0), "
    "etl_load_ts timestamp_ntz, etl_updt_ts timestamp_ntz"
)
DQ_PROJECT = (
    "project_id string, project_name string, owner string, active_flg string, "
    "created_ts timestamp_ntz, modified_ts timestamp_ntz"
)
DQ_GROUP = (
    "group_id string, group_name string, project_id string, "
    "created_ts timestamp_ntz, modified_ts timestamp_ntz"
)
DQ_RULE = (
    "rule_id string, rule_name string, rule_description string, rule_type string, "
    "dbt_test string, param_attrib string, expected_value string, "
    "created_ts timestamp_ntz, modified_ts timestamp_ntz"
)
DQ_EXPECTATION = (
    "exp_id string, group_id string, exp_type string, exp_message string, exp_dt string, "
    "severity_level string, source_system string, escalation_poc string, active_flg string, "
    "schema_name string, tbl_name string, full_tbl_name string, col_name string, "
    "param_value string, created_ts timestamp_ntz, modified_ts timestamp_ntz"
)
DQ_RESULT = (
    "project_id string, project_name string, group_id string, group_name string, "
    "rule_id string, rule_name string, rule_type string, dbt_test string, exp_id string, "
    "exp_message string, dq_rule_schema_name string, tbl_name string, full_tbl_name string, "
    "key_column string, col_name string, rule_execution_ts string, result_status string, "
    "failure_record_count bigint, total_record_count bigint, failure_ratio double, "
    "failure_record_query string, severity_level string, source_system string, "
    "escalation_poc string, batch_id decimal(38,0), etl_load_ts timestamp_ntz, "
    "etl_updt_ts timestamp_ntz"
)
