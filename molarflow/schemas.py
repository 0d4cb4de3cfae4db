"""Explicit schemas of the domain tables (never inferred).

Kept as DDL strings: `spark.read.schema(ddl)` and `createDataFrame(rows, ddl)`
both accept them directly.
"""

APPOINTMENTS = (
    "id bigint, patient_id bigint, patient_name string, clinic_id string, doctor_name string, "
    "start_time timestamp_ntz, scheduled_start_time timestamp_ntz, created_at timestamp_ntz, status int, "
    "speciality_id string, channel_id string, channel_name string, created_by_id string, "
    "created_by_name string, phone string, type string, campaign_token string, "
    "patient_channel_name string, patient_subchannel_name string, "
    "created_by_name_norm string, patient_name_norm string, phone_norm string"
)

APPOINTMENT_LOGS = (
    "id string, appointment_id bigint, user_id string, from_status int, to_status int, "
    "is_reschedule boolean, change_date timestamp_ntz"
)

PAYMENTS = (
    "id string, patient_id bigint, clinic_id string, date timestamp_ntz, amount decimal(18,2), "
    "is_confirmed boolean, deleted_at timestamp_ntz, specialty_id string, specialty_name string"
)

LEADS = (
    "id bigint, account_id bigint, erp_clinic_id string, name string, email string, phone_raw string, "
    "identifier string, labels array<string>, created_at_cw timestamp_ntz, last_activity_at timestamp_ntz, "
    "inbox_ids array<int>"
)

CONTACTS_RAW = (
    "id bigint, name string, email string, phone_number string, identifier string, "
    "contact_inboxes array<struct<inbox:struct<id:int>>>, created_at bigint, last_activity_at bigint, "
    "labels array<string>, custom_attributes map<string,string>"
)

CONVERSATIONS_RAW = (
    "id bigint, created_at string, last_activity_at bigint, contact_id bigint, inbox_id int, "
    "labels array<string>, meta struct<sender:struct<id:bigint,name:string,email:string,"
    "phone_number:string,identifier:string>>"
)

CAMPAIGN_CONTACTS = (
    "clinic_id string, year_month string, campaign_tag string, contacts_count bigint, "
    "conversations_count bigint, refreshed_at timestamp_ntz"
)

SYNC_STATE = (
    "feed string, clinic_id string, last_updated_at timestamp_ntz, last_run_at timestamp_ntz, "
    "last_run_status string, last_run_error string, rows_synced_total bigint"
)

LEAD_SYNC_STATE = (
    "account_id bigint, erp_clinic_id string, last_synced_at timestamp_ntz, last_activity_seen timestamp_ntz, "
    "rows_synced_total bigint, last_run_status string, last_run_error string, full_refresh_at timestamp_ntz"
)

UNITS = "clinic_id string, name string, regional string, account_id bigint"

USERS = (
    "id string, active boolean, role string, regional string, unrestricted boolean, "
    "allowed_clinic_ids array<string>, accounts array<struct<id:bigint,role:string,status:string>>"
)

STATUSES = "id int, name string"

# Feed registry (SRC1): feed name -> (schema, key columns, date column used by retention).
FEEDS = {
    "appointments": (APPOINTMENTS, ("id",), "start_time"),
    "appointment_logs": (APPOINTMENT_LOGS, ("id",), "change_date"),
    "payments": (PAYMENTS, ("id",), "date"),
}
