"""Business columns of each landing table, as the formats declare them. Fixed values."""

PROD_DAILY = (
    "dateprd", "well_bore_code", "npd_well_bore_code", "npd_well_bore_name", "npd_field_code", "npd_field_name", "npd_facility_code", "npd_facility_name",
    "on_stream_hrs", "avg_downhole_pressure", "avg_downhole_temperature", "avg_dp_tubing", "avg_annulus_press", "avg_choke_size_p", "avg_choke_uom", "avg_whp_p",
    "avg_wht_p", "dp_choke_size", "bore_oil_vol", "bore_gas_vol", "bore_wat_vol", "bore_wi_vol", "flow_kind", "well_type",
)
PROD_MONTHLY = ("wellbore_name", "npdcode", "year", "month", "on_stream", "oil", "gas", "water", "gi", "wi")
DDR_ACTIVITY = (
    "report_date", "name_well", "name_wellbore", "npd_code_well", "npd_code_wellbore", "npd_number", "rig_alias", "document_name", "document_owner", "version_kind",
    "create_date", "dtim_start", "dtim_end", "activity_seq", "activity_dtim_start", "activity_dtim_end", "activity_md", "activity_md_uom", "phase", "proprietary_code",
    "state", "state_detail_activity", "comments", "source_format",
)
TRAJECTORY_STATION = (
    "name_well", "name_wellbore", "trajectory_name", "trajectory_uid", "uid_well", "uid_wellbore", "service_company", "dtim_traj_start", "dtim_traj_end", "md_min", "md_max",
    "azi_ref", "azi_vert_sect", "mag_decl_used", "grid_cor_used", "source_crs", "station_uid", "station_seq", "dtim_station", "type_traj_station", "status_traj_station",
    "md", "md_uom", "tvd", "tvd_uom", "incl", "incl_uom", "azi", "azi_uom", "disp_ns", "disp_ew", "vert_sect", "dls", "dls_uom",
)
WITSML_MESSAGE = (
    "namespace", "schema_version", "uid_well", "uid_wellbore", "uid_message", "name_well", "name_wellbore", "message_name", "dtim", "md", "md_uom", "type_message", "message_text", "source_name",
)
WITSML_LOG_HEADER = (
    "namespace", "schema_version", "uid_well", "uid_wellbore", "uid_log", "name_well", "name_wellbore", "log_name", "index_type", "index_curve", "start_index", "end_index", "direction",
    "curve_seq", "mnemonic", "unit", "curve_description",
)
WITSML_LOG_DATA = ("namespace", "schema_version", "uid_well", "uid_wellbore", "uid_log", "name_well", "name_wellbore", "log_name", "index_value", "mnemonic", "unit", "value")
LAS_CURVE_HEADER = (
    "well_name", "uwi", "field", "company", "service_company", "date_declared", "null_value_declared", "las_version", "wrapped", "delimiter_declared", "start", "stop", "step",
    "index_mnemonic", "index_unit", "curve_index", "mnemonic", "unit", "api_code", "description",
)
LAS_SAMPLE = ("well_name", "mnemonic", "index_mnemonic", "index_value", "index_unit", "value", "null_value_declared")
VSP_CHECKSHOT = (
    "well_from_file_name", "well_from_header", "layout", "curve_name", "contractor", "depth_datum", "time_datum", "md_m", "tvd_m", "tvd_below_datum_m", "tvd_subsea_m", "two_way_time_ms", "row_seq",
)
SIM_SUMMARY = (
    "report_number", "report_date", "days_from_start", "model_name", "simulator_version", "run_at", "row_label", "oil_liquid", "oil_vapour", "oil_total", "water_total", "gas_free",
    "gas_dissolved", "gas_total", "pav_bara", "porv_rm3",
)
GEOM_FAULT_RECORD = ("fault_file", "keyword", "record_seq", "z_shift", "index_values", "comment")
#: SEG-Y revision 1: name, place after the textual header, bytes; all big-endian and signed.
SEGY_BINARY = (
    ("job_id", 0, 4), ("line_number", 4, 4), ("reel_number", 8, 4), ("traces_per_ensemble", 12, 2), ("aux_traces_per_ensemble", 14, 2), ("sample_interval_us", 16, 2),
    ("sample_interval_us_original", 18, 2), ("samples_per_trace", 20, 2), ("samples_per_trace_original", 22, 2), ("data_sample_format_code", 24, 2), ("ensemble_fold", 26, 2),
    ("trace_sorting_code", 28, 2), ("measurement_system", 54, 2), ("segy_revision", 300, 2), ("fixed_length_trace_flag", 302, 2), ("extended_textual_headers", 304, 2),
)
SEGY_TRACE = (
    ("trace_sequence_line", 0, 4), ("trace_sequence_file", 4, 4), ("field_record_number", 8, 4), ("trace_number", 12, 4), ("scalar_elevation", 68, 2), ("scalar_coordinates", 70, 2),
    ("source_x", 72, 4), ("source_y", 76, 4), ("group_x", 80, 4), ("group_y", 84, 4), ("coordinate_units", 88, 2), ("samples_in_trace", 114, 2), ("sample_interval_in_trace_us", 116, 2),
    ("inline_number", 188, 4), ("crossline_number", 192, 4),
)
SEGY_HEADER = ("survey_file", "access_mode", "textual_header", *(n for n, _, _ in SEGY_BINARY), *(f"trace1_{n}" for n, _, _ in SEGY_TRACE))
