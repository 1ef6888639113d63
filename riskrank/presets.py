"""Names, codes and defaults that results must agree on."""

# --- fixed values: columns kept from the raw entity table, in output order ---
ENTITY_KEY = "epa_handler_id"
ENTITY_COLUMNS = [
    "epa_handler_id", "source_type", "handler_sequence_number", "receive_date",
    "location_city", "location_zip_code", "county_code", "land_type",
    "importer_activity", "mixed_waste_generator", "transporter_activity",
    "transfer_facility", "tsd_activity", "recycler_activity",
    "onsite_burner_exemption", "furnace_exemption", "underground_injection_activity",
    "receives_waste_from_off_site", "universal_waste_destination_facility",
    "used_oil_transporter", "used_oil_transfer_facility", "used_oil_processor",
    "used_oil_refiner", "used_oil_fuel_burner", "used_oil_fuel_marketer_to_burner",
    "used_oil_specification_marketer",
    "under_40_cfr_part_262_subpart_k_as_a_college_or_university",
    "under_40_cfr_part_262_subpart_k_as_a_teaching_hospital",
    "under_40_cfr_part_262_subpart_k_as_a_non_profit_research_ins",
]
ENTITY_RENAMES = {
    "under_40_cfr_part_262_subpart_k_as_a_college_or_university": "subpart_k_college",
    "under_40_cfr_part_262_subpart_k_as_a_teaching_hospital": "subpart_k_hospital",
    "under_40_cfr_part_262_subpart_k_as_a_non_profit_research_ins": "subpart_k_research",
}
ENTITY_REGION_COLUMN = "activity_location"
ENTITY_REGION = "NY"

# --- fixed values: columns kept from the raw evaluation table ---
EVALUATION_COLUMNS = [
    "evaluation_identifier", "evaluation_start_date", "evaluation_agency",
    "found_violation_flag", "multimedia_inspection_flag", "sampling_flag",
    "not_subtitle_c_flag", "evaluation_type", "evaluation_type_description",
    "focus_area", "focus_area_description", "evaluation_responsible_person",
    "evaluation_suborganization", "handler_activity_location", "date_of_request",
    "date_response_received", "request_agency", "request_activity_location",
    "violation_activity_location", "violation_sequence_number",
    "violation_determined_by_agency", "violation_type", "violation_short_description",
    "former_citation", "violation_determined_date", "actual_return_to_compliance_date",
    "return_to_compliance_qualifier", "violation_responsible_agency",
    "scheduled_compliance_date", "enforcement_activity_location",
    "enforcement_identifier", "enforcement_action_date", "enforcement_agency",
    "corrective_action_component_flag", "appeal_initiated_date", "appeal_resolved_date",
    "disposition_status_date", "disposition_status", "disposition_status_description",
    "cafo_sequence_number", "respondent_name", "lead_agency", "enforcement_type",
    "expenditure_amount", "sep_scheduled_completion_date", "sep_actual_completion_date",
    "sep_defaulted_date", "sep_type", "proposed_penalty_amount", "final_monetary_amount",
    "paid_amount", "final_count", "final_amount", "citizen_complaint_flag",
]

# --- fixed values: dates whose maximum is the knowledge date of an event ---
KNOWLEDGE_DATES = [
    "evaluation_start_date", "violation_determined_date",
    "actual_return_to_compliance_date", "enforcement_action_date",
    "disposition_status_date",
]

# --- fixed values: columns kept from the raw report table ---
REPORT_COLUMNS = [
    "handler_id", "sequence_number", "hazardous_waste_page_number",
    "hazardous_waste_sub_page_number", "br_form", "management_location", "report_cycle",
    "source_code", "form_code", "management_method", "federal_waste_flag",
    "wastewater_characteristic_indicator", "generation_tons", "received_tons",
    "waste_minimization_code", "waste_code_group", "waste_description",
]

# --- fixed values: report code groups and their categories ---
CODE_CATEGORIES = {
    "D001": "d001", "D002": "d002", "D008": "d008", "TCORICR": "tcor_icr",
    "F1_5": "f1_5", "TCMT": "tcmt", "D011": "d011", "D039": "d039", "F003": "f003",
    "D009": "d009", "ICR": "icr", "D007": "d007", "F002": "f002", "LABP": "labp",
    "D016": "d016", "D018": "d018", "F005": "f005", "F006": "f006", "F001": "f001",
    "D003": "d003", "P001": "p001", "F039": "f039", "D005": "d005",
    "TCOR Only": "tcor_only",
}
CODE_PREFIXES = {"D": "other_d", "F": "other_f", "K": "other_k", "P": "other_p", "U": "other_u"}
CODE_DEFAULT = "others"
PANEL_CATEGORIES = [*CODE_CATEGORIES.values(), *CODE_PREFIXES.values(), CODE_DEFAULT]

# --- fixed values: census measures and their readable column names ---
CENSUS_NAMES = {
    "B01003_001E": "total_pop", "B02001_002E": "white_pop", "B02001_003E": "black_pop",
    "B02001_005E": "asian_pop", "B19049_001E": "median_income",
    "B15003_002E": "edu_no_schooling", "B15003_017E": "edu_hsd", "B15003_022E": "edu_bs",
    "B15003_023E": "edu_ms", "B15003_025E": "edu_phd",
}
INCOME_QUINTILES = ["B19081_001E", "B19081_002E", "B19081_003E", "B19081_004E", "B19081_005E"]
DENSITY_COLUMNS = ["zip", "population", "zip_area_sq_miles", "zip_density_sq_miles"]

# --- fixed values: imputation ---
INFINITY_FILL = 100000000

# --- fixed values: analysis defaults ---
MIN_SUPPORT = 75
CROSSTAB_EPSILON = 1e-12

# --- fixed values: readable feature names ---
FEATURE_NAMES = {
    "zip_population": "Population (Zip)",
    "county_population": "Population (County)",
    "zip_density_sq_miles": "Pop. Density (Zip)",
    "mean_county_income": "Mean Household Income (County)",
    "events_sum_found_violation": "# Violations (Aggregated Since 2000)",
    "events_sum_found_violation_impute_flag": "# Violations (Missing)",
    "events_avg_found_violation": "Percentage of Violations (Aggregated Since 2000)",
    "events_avg_found_violation_impute_flag": "Percentage of Violations (Missing)",
    "events_sum_citizen_complaint": "# Citizen Complaints (Aggregated Since 2000)",
    "events_sum_citizen_complaint_impute_flag": "# Citizen Complaints (Missing)",
    "events_sum_penalty_amount": "Fine Amount (Aggregated Since 2000)",
    "events_sum_penalty_amount_impute_flag": "Fine Amount (Missing)",
    "events_days_since_event_date": "Days Since Last Inspection",
    "events_days_since_event_date_impute_flag": "Days Since Last Inspection (Missing)",
    "d001": "Ignitable Waste", "d002": "Corrosive Waste", "d003": "Reactive Waste",
    "d005": "Barium", "d007": "Chromium", "d008": "Lead", "d009": "Mercury",
    "d011": "Silver", "d016": "2,4‐D (Herbicide)", "d018": "Benzene",
    "d039": "Tetrachloroethylene", "other_d": "Toxic Waste (Other)",
    "tcor_only": "Toxic Waste (tcor_only)", "tcor_icr": "Toxic Waste (tcor_icr)",
    "icr": "Waste (icr)", "tcmt": "Heavy Metals",
    "f001": "f001 (Spent Solvents)", "f002": "f002 (Spent Solvents)",
    "f003": "fOO3 (Spent Solvents)", "f005": "fOO5 (Spent Solvents)",
    "f006": "f006 (Electroplating Waste)", "f039": "Leachate Waste",
    "f1_5": "Spent Solvent Waste", "other_f": "Industrial Waste (Other)",
    "p001": "Chemical Waste (p001)", "other_p": "P-List Chemical Waste (Other)",
    "other_u": "U-List Chemical Waste (Other)", "other_k": "K-List Industrial Waste (Other)",
    "other": "Waste (Other)", "labp": "Lab Pack (Misc)",
    "events_sum_found_violation_1_year": "# Violations (Aggregated 1 Year)",
    "events_sum_found_violation_2_years": "# Violations (Aggregated 2 Years)",
    "events_sum_found_violation_5_years": "# Violations (Aggregated 5 Years)",
    "events_avg_found_violation_1_year": "Percentage of Violations (Aggregated 1 Year)",
    "events_avg_found_violation_2_years": "Percentage of Violations (Aggregated 2 Years)",
    "events_avg_found_violation_5_years": "Percentage of Violations (Aggregated 5 Years)",
    "events_sum_citizen_complaint_1_year": "# Citizen Complaints (Aggregated 1 Year)",
    "events_sum_citizen_complaint_2_years": "# Citizen Complaints (Aggregated 2 Years)",
    "events_sum_citizen_complaint_5_years": "# Citizen Complaints (Aggregated 5 Years)",
    "events_sum_penalty_amount_1_year": "Fine Amount (Aggregated 1 Year)",
    "events_sum_penalty_amount_2_years": "Fine Amount (Aggregated 2 Years)",
    "events_sum_penalty_amount_5_years": "Fine Amount (Aggregated 5 Years)",
}
