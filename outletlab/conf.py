"""Configuration values.

FIXED VALUES — these must equal the values the original application uses for
its results to agree (codes, lists, constants, column names). They are stated
plainly and in their original order.
"""

from __future__ import annotations

# ---------------------------------------------------------------- FIXED VALUES
# Customer hierarchy levels kept.
CUST_HIER2_LIST = ["KA", "NK"]
# Order-block codes that still count as active (NULL also counts).
ORDER_BLOCK_LIST = ["CW", "F", "I", "#", "C", "TS", "PR", "NR", "VF"]
# Trade channels not involved.
EXCLUDED_TRADE_CHANNELS = ["036", "099"]
# Order-block code meaning "not routed".
NOT_ROUTED_CODE = "NR"
# Second digit of the customer class code -> class name; anything else -> "Other".
CCAF_GROUPS = [("1", "Platinum"), ("2", "Gold"), ("3", "Silver"), ("4", "Bronze"), ("5", "Iron")]
CCAF_OTHER = "Other"
# Degrees (Euclidean on lat/lon) to kilometres, and the accepted radius.
KM_PER_DEGREE = 104.867407
NEAREST_MAX_KM = 5.0
# Disc area constant used by the density features.
PI_APPROX = 3.14
# Months looked back from the latest qualifying fiscal period (13 periods in all).
SALES_MONTHS_BACK = 12
# A period qualifies as latest if its last sale day is more than this many days
# after the month start, or exactly on the month start.
PERIOD_MIN_DAYS = 20
# Default snapshot partition value of rows carried over from a previous table.
DEFAULT_PREVIOUS_PARDT = "20220512"
# Chi-square significance level and association threshold.
CHI_SQUARE_ALPHA = 0.03
ASSOCIATION_THRESHOLD = 0.90
# Stratified split fraction (train share per label) and model seeds.
TRAIN_FRACTION = 0.8
FOREST_SEED = 123
CV_SEED = 21
CV_FOLDS = 5
# Full model search grid (100 parameter sets x 5 folds).
GRID_NUM_TREES = [10, 15, 20, 25]
GRID_MAX_DEPTH = [12, 14, 16, 18, 20]
GRID_MAX_BINS = [12, 14, 16, 18, 20]
# Label excluded from modelling, and class excluded from reported predictions.
LABEL_EXCLUDED = "Other"
PREDICTION_EXCLUDED = "Platinum"

# Customer master columns renamed on load.
CUSTOMER_RENAMES = {
    "_BIC_CTRADE_CH": "CUST_CTRADE_CH",
    "CTRADE_CH_DESC": "CUST_CTRADE_CH_DESC",
    "_BIC_CSUB_TRAD": "CUST_CSUB_TRAD",
    "CSUB_TRAD_DESC": "CUST_CSUB_TRAD_DESC",
    "_BIC_CDMD_AREA": "CUST_CDMD_AREA",
    "CDMD_AREA_DESC": "CUST_CDMD_AREA_DESC",
    "POSTAL_CD": "POSTAL_CODE",
    "_BIC_CSUP_CUST": "ORDER_BLOCK_ID",
}
CUSTOMER_COLUMNS = [
    "CUSTOMER", "CUST_CTRADE_CH", "CUST_CTRADE_CH_DESC", "CUST_CSUB_TRAD", "CUST_CSUB_TRAD_DESC",
    "CUST_GRP4", "CUST_GRP4_DESC", "CUST_CDMD_AREA", "CUST_CDMD_AREA_DESC", "CUST_ROUTED",
    "CUST_CCAF_GROUP", "POSTAL_CODE", "LONGITUDE", "LATITUDE",
]

# Demographic inputs.
AGE_GROUP_COLUMNS = ["age_t0014_sum", "age_t1529_sum", "age_t3044_sum", "age_t4559_sum", "age_t60pl_sum"]
TRAFFIC_HOUR_COLUMNS = [
    "monthly_traffic_morning_avg_mean", "monthly_traffic_afternoon_avg_mean",
    "monthly_traffic_evening_avg_mean", "monthly_traffic_night_avg_mean",
]
WINTER_TRAFFIC_COLUMNS = ["monthly_traffic_2021_12_mean", "monthly_traffic_2021_1_mean", "monthly_traffic_2021_2_mean"]
SUMMER_TRAFFIC_COLUMNS = ["monthly_traffic_2021_6_mean", "monthly_traffic_2021_7_mean", "monthly_traffic_2021_8_mean"]
# Demographic columns that are never numeric-imputed.
DEMOGRAPHIC_NON_NUMERIC = [
    "TAA_TC", "urbanicity", "CUSTOMER_DESC", "LONGITUDE", "LATITUDE", "_BIC_CTRADE_CH",
    "_BIC_CDMD_AREA", "ta_size", "geometry",
]

# Analytical base table columns, in output order.
ABT_COLUMNS = [
    "CUSTOMER", "LONGITUDE", "LATITUDE", "CUST_CTRADE_CH", "CUST_CTRADE_CH_DESC", "TAA_TC",
    "CUST_CSUB_TRAD", "CUST_CSUB_TRAD_DESC", "CUST_GRP4", "CUST_GRP4_DESC", "CUST_CDMD_AREA",
    "CUST_CDMD_AREA_DESC", "CUST_ROUTED", "CUST_CCAF_GROUP", "POSTAL_CODE", "urbanicity",
    "di_pc_mean", "wvce_01_pc", "wvce_02_pc", "WVSEG_A_mean", "WVSEG_B_mean", "WVSEG_C_mean",
    "WVSEG_D_mean", "WVSEG_E_mean", "WVSEG_F_mean", "WVSEG_G_mean", "WVSEG_H_mean", "WVSEG_I_mean",
    "WVSEG_J_mean", "WVSEG_U_mean", "monthly_traffic_avg_mean", "Season_traffic_perc_diff",
    "Weekend_traffic_perc_diff", "TF_WINTER", "TF_SUMMER",
    "Percentage_monthly_traffic_morning_avg_mean", "Percentage_monthly_traffic_afternoon_avg_mean",
    "Percentage_monthly_traffic_evening_avg_mean", "Percentage_monthly_traffic_night_avg_mean",
    "pop_sum", "hh_sum", "ta_size", "di_ci_mean", "di_mio_sum", "wvce_01_sum", "wvce_02_sum",
    "unempl_sum", "population_density", "competitor_count_density", "Percentage_age_t0014_sum",
    "Percentage_age_t1529_sum", "Percentage_age_t3044_sum", "Percentage_age_t4559_sum",
    "Percentage_age_t60pl_sum", "monthly_proportion_residents_avg_mean",
    "monthly_proportion_workers_avg_mean", "monthly_proportion_others_avg_mean",
    "monthly_proportion_same_state_avg_mean", "monthly_proportion_other_state_avg_mean",
    "monthly_proportion_unknown_avg_mean", "commercial_area_poi", "industrial_area_poi",
    "park_area_poi", "residential_area_poi", "retail_area_poi", "pofw_poi", "pofw_christian_poi",
    "pofw_muslim_poi", "parking_poi", "transport_poi", "accomodation_poi", "catering_poi",
    "education_school_poi", "education_university_poi", "health_poi", "leasure_poi", "outdoor_poi",
    "public_poi", "shopping_poi", "sports_poi", "tourism_poi", "outlet_count", "competitor_count",
    "COOLER_DOORS_SUM", "COOLER_EQUIP_COUNT", "Sales_NSR_imputed", "Sales_Volume_in_UC_imputed",
]

# Columns left out of feature selection (key, coordinates, codes, raw counts).
FEATURE_SELECTION_EXCLUDED = [
    "CUSTOMER", "LONGITUDE", "LATITUDE", "TAA_TC", "CUST_CTRADE_CH", "CUST_CSUB_TRAD", "CUST_GRP4",
    "CUST_GRP4_DESC", "CUST_CDMD_AREA", "CUST_CDMD_AREA_DESC", "CUST_ROUTED", "POSTAL_CODE",
    "commercial_area_poi", "industrial_area_poi", "park_area_poi", "residential_area_poi",
    "retail_area_poi", "pofw_poi", "pofw_muslim_poi", "accomodation_poi", "catering_poi",
    "education_university_poi", "shopping_poi", "competitor_count",
    "Percentage_monthly_traffic_morning_avg_mean", "Percentage_monthly_traffic_afternoon_avg_mean",
    "ercentage_monthly_traffic_evening_avg_mean", "Percentage_monthly_traffic_night_avg_mean",
    "pop_sum", "ta_size", "Percentage_age_t0014_sum", "Percentage_age_t1529_sum",
    "Percentage_age_t3044_sum", "Percentage_age_t4559_sum", "Percentage_age_t60pl_sum",
    "di_ci_mean", "di_mio_sum", "wvce_01_sum", "wvce_02_sum", "wvce_01_pc", "wvce_02_pc",
    "WVSEG_B_mean", "WVSEG_A_mean", "WVSEG_C_mean", "WVSEG_D_mean", "WVSEG_E_mean", "WVSEG_F_mean",
    "WVSEG_G_mean", "WVSEG_H_mean", "WVSEG_I_mean", "WVSEG_J_mean", "WVSEG_U_mean", "outlet_count",
    "competitor_count", "pop_sum", "hh_sum", "pofw_poi", "pofw_christian_poi", "pofw_muslim_poi",
    "parking_poi", "transport_poi", "sports_poi", "accomodation_poi", "catering_poi",
    "education_school_poi", "education_university_poi", "health_poi", "leasure_poi", "outdoor_poi",
    "public_poi", "monthly_proportion_residents_avg_mean", "monthly_proportion_workers_avg_mean",
    "monthly_proportion_others_avg_mean", "monthly_proportion_same_state_avg_mean",
    "monthly_proportion_other_state_avg_mean", "monthly_proportion_unknown_avg_mean",
    "industrial_area_poi", "park_area_poi", "commercial_area_poi", "residential_area_poi",
    "retail_area_poi", "shopping_poi", "tourism_poi",
]

# Base-table columns read back as double for modelling.
MODEL_DOUBLE_COLUMNS = [
    "urbanicity", "di_pc_mean", "wvce_01_pc", "wvce_02_pc", "WVSEG_A_mean", "WVSEG_B_mean",
    "WVSEG_C_mean", "WVSEG_D_mean", "WVSEG_E_mean", "WVSEG_F_mean", "WVSEG_G_mean", "WVSEG_H_mean",
    "WVSEG_I_mean", "WVSEG_J_mean", "WVSEG_U_mean", "monthly_traffic_avg_mean",
    "Season_traffic_perc_diff", "Weekend_traffic_perc_diff", "TF_WINTER", "TF_SUMMER",
    "Percentage_monthly_traffic_morning_avg_mean", "Percentage_monthly_traffic_afternoon_avg_mean",
    "Percentage_monthly_traffic_evening_avg_mean", "Percentage_monthly_traffic_night_avg_mean",
    "pop_sum", "hh_sum", "ta_size", "di_ci_mean", "di_mio_sum", "wvce_01_sum", "wvce_02_sum",
    "unempl_sum", "population_density", "competitor_count_density", "Percentage_age_t0014_sum",
    "Percentage_age_t1529_sum", "Percentage_age_t3044_sum", "Percentage_age_t4559_sum",
    "Percentage_age_t60pl_sum", "monthly_proportion_residents_avg_mean",
    "monthly_proportion_workers_avg_mean", "monthly_proportion_others_avg_mean",
    "monthly_proportion_same_state_avg_mean", "monthly_proportion_other_state_avg_mean",
    "monthly_proportion_unknown_avg_mean", "commercial_area_poi", "industrial_area_poi",
    "park_area_poi", "residential_area_poi", "retail_area_poi", "pofw_poi", "pofw_christian_poi",
    "pofw_muslim_poi", "parking_poi", "transport_poi", "accomodation_poi", "catering_poi",
    "education_school_poi", "education_university_poi", "health_poi", "leasure_poi", "outdoor_poi",
    "public_poi", "shopping_poi", "sports_poi", "tourism_poi", "outlet_count", "competitor_count",
    "COOLER_DOORS_SUM", "COOLER_EQUIP_COUNT", "Sales_NSR_imputed", "Sales_Volume_in_UC_imputed",
]

# Country -> sales organisations and company codes (codes are strings).
COUNTRY_INFO = {
    "gr": (["1200"], ["0450"]),
    "ng": (["9400"], ["0470"]),
    "it": (["6300"], ["0594"]),
    "ru": (["3801", "3802", "3803", "3804", "3805", "3806"], ["0403"]),
    "ch": (["5500"], ["0590"]),
    "hu": (["2800"], ["0522"]),
    "bg": (["4900"], ["0428"]),
    "ie": (["7800", "7900"], ["0480", "0491"]),
    "ro": (["9100"], ["0580"]),
    "pl": (["6100"], ["0563"]),
    "cy": (["5100"], ["0457"]),
    "cz": (["4500"], ["0530"]),
    "sk": (["4090"], ["0533"]),
    "rs": (["2500"], ["0440"]),
    "me": (["8200"], ["0441"]),
    "kv": (["9200"], ["0443"]),
    "ua": (["7200"], ["0560"]),
    "md": (["2000"], ["0460"]),
    "am": (["9600"], ["0410"]),
    "mk": (["9500"], ["0430"]),
    "hr": (["8100"], ["0570"]),
    "ba": (["8600"], ["0573"]),
    "si": (["8500"], ["0540"]),
    "by": (["2300"], ["0550"]),
    "lv": (["3100"], ["0415"]),
    "lt": (["3300"], ["0417"]),
    "ee": (["3200"], ["0416"]),
    "at": (["1100"], ["0526"]),
}
# ------------------------------------------------------------ END FIXED VALUES
