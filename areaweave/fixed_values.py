"""Everything here has to equal the published source files and reports.

Column codes are those of the 2018 survey extracts; the labels are the names the
transformed tables and the reports carry. Nothing in this module is logic.
"""

# --- survey columns: code -> label of the transformed table -----------------

INCOME = {
    "DP03_0052PE": "Income_Less_10k",
    "DP03_0053PE": "Income_10k_14k",
    "DP03_0054PE": "Income_15k_24k",
    "DP03_0055PE": "Income_25k_34k",
    "DP03_0056PE": "Income_35k_49k",
    "DP03_0057PE": "Income_50k_74k",
    "DP03_0058PE": "Income_75k_99k",
    "DP03_0059PE": "Income_100k_149k",
    "DP03_0060PE": "Income_150k_199k",
    "DP03_0061PE": "Income_200k_More",
}

INDUSTRY = {
    "DP03_0033E": "Agriculture",
    "DP03_0034E": "Construction",
    "DP03_0035E": "Manufacturing",
    "DP03_0036E": "Wholesale",
    "DP03_0037E": "Retail",
    "DP03_0038E": "Transportation",
    "DP03_0039E": "Information",
    "DP03_0040E": "Finance_Real_Estate",
    "DP03_0041E": "Professional_Scientific_Management",
    "DP03_0042E": "Educational_Health_Care",
    "DP03_0043E": "Art_Entertainment",
    "DP03_0045E": "Public_Administration",
}

LABOR_FORCE = {
    "DP03_0002PE": "Labor_Force",
    "DP03_0004PE": "Civilian_Labor_Force_Employed",
    "DP03_0005PE": "Civilian_Labor_Force_Unemployed",
    "DP03_0014E": "Children_In_HouseHold",
}

COMMUTE = {
    "DP03_0019PE": "Drive_Alone",
    "DP03_0020PE": "Carpooled",
    "DP03_0021PE": "Public_Transportation",
    "DP03_0022PE": "Walking",
    "DP03_0023PE": "Others",
    "DP03_0024PE": "Work_From_Home",
    "DP03_0025E": "Mean_Travel_Time_To_Work",
}

WORK_STATS = {
    "S2303_C01_031E": "Mean_hours",
    "S2303_C01_032E": "Median_age_working",
    "S2303_C01_033E": "Full_time_year_round",
}

HOURS = {
    "S2303_C01_009E": "Work_35h_or_more",
    "S2303_C01_016E": "Work_16h_to_34h",
    "S2303_C01_023E": "Work_1h_to_15h",
    "S2303_C01_030E": "No_working",
}

WEEKS = {
    "S2303_C01_002E": "Work_50_to_52_weeks",
    "S2303_C01_003E": "Work_48_to_49_weeks",
    "S2303_C01_004E": "Work_40_to_47_weeks",
    "S2303_C01_005E": "Work_27_to_39_weeks",
    "S2303_C01_006E": "Work_14_to_26_weeks",
    "S2303_C01_007E": "Work_1_to_13_weeks",
    "S2303_C01_008E": "No_working",
}

HOUSING_STATUS = {
    "DP04_0001E": "Total_Housing_Units",
    "DP04_0002PE": "Occupied_Housing_Units",
    "DP04_0003PE": "Vacant_Housing_Units",
}

HOUSING_UNIT = {
    "DP04_0007PE": "Detached_Unit_1",
    "DP04_0008PE": "Attached_Unit_1",
    "DP04_0009PE": "Units_2",
    "DP04_0010PE": "Units_3_to_4",
    "DP04_0011PE": "Units_5_to_9",
    "DP04_0012PE": "Units_10_to_19",
    "DP04_0013PE": "Units_20_or_more",
    "DP04_0014PE": "Mobile_Home",
    "DP04_0015PE": "RV_Boat",
}

BUILT_YEAR = {
    "DP04_0017PE": "Built_2014_or_later",
    "DP04_0018PE": "Built_2010_to_2013",
    "DP04_0019PE": "Built_2000_to_2009",
    "DP04_0020PE": "Built_1990_to_1999",
    "DP04_0021PE": "Built_1980_to_1989",
    "DP04_0022PE": "Built_1970_to_1979",
    "DP04_0023PE": "Built_1960_to_1969",
    "DP04_0024PE": "Built_1950_to_1959",
    "DP04_0025PE": "Built_1940_to_1949",
    "DP04_0026PE": "Built_1939_or_before",
}

HOUSING_VALUE = {
    "DP04_0081PE": "Less_than_V50k",
    "DP04_0082PE": "V50k_to_99k",
    "DP04_0083PE": "V100k_to_149k",
    "DP04_0084PE": "V150k_to_199k",
    "DP04_0085PE": "V200k_to_399k",
    "DP04_0086PE": "V400k_to_499k",
    "DP04_0087PE": "V500k_to_999k",
    "DP04_0088PE": "V1M_and_more",
}

ENROLLMENT = {
    "S1401_C01_004E": "Kindergarden",
    "S1401_C01_005E": "Grade1_to_4",
    "S1401_C01_006E": "Grade5_to_8",
    "S1401_C01_007E": "Grade9_to_12",
    "S1401_C01_008E": "College_Undergrad",
    "S1401_C01_009E": "Grad_HigherEdu",
}

PUBLIC_PRIVATE = {
    "S1401_C03_008E": "College_Undergrad_Public",
    "S1401_C05_008E": "College_Undergrad_Private",
    "S1401_C03_009E": "Grad_HigherEdu_Public",
    "S1401_C05_009E": "Grad_HigherEdu_Private",
}

# --- classes ----------------------------------------------------------------

# How many consecutive income brackets make up each class, lowest first.
INCOME_CLASSES = {"Lowest": 3, "Lower_Middle": 2, "Middle": 2, "Upper_Middle": 2, "Rich": 1}

# The same for house values.
VALUE_CLASSES = {"Low_Housing_Value": 4, "Middle_Housing_Value": 2, "High_Housing_Value": 2}

# Middle of each income bracket in thousands, and the divisor of the index.
INCOME_MIDPOINTS = [5.0, 12.0, 19.5, 29.5, 42.0, 62.0, 87.0, 124.5, 174.5, 250.0]
INCOME_SCALE = 250.0

TOP_INDUSTRIES = [
    "Predominant_Industry_First",
    "Predominant_Industry_Second",
    "Predominant_Industry_Third",
]

# --- markers in the source files --------------------------------------------

SUPPRESSED = "-"
NOT_AVAILABLE = "N"
NULL_MARKERS = {"survey": "(X)", "work": "null", "crosswalk": "No ZCTA"}

# Count columns that still arrive as text, with both markers in them.
TEXT_MEASURES = ["DP03_0025E", "S2303_C01_031E", "S2303_C01_032E"]

AREA_PREFIX = "ZCTA5 "
ZIP_LENGTH = 5
SAMPLE_ROWS = 50

# --- location files ---------------------------------------------------------

# Fields shared by the three school location files, in file order.
SCHOOL_PLACE_FIELDS = (
    "STREET CITY STATE ZIP STFIP CNTY NMCNTY LOCALE LAT LON CBSA NMCBSA CBSATYPE "
    "CSA NMCSA NECTA NMNECTA CD SLDL SLDU SCHOOLYEAR"
).split()

# Leading fields of each file; the first is the key, the second the name.
SCHOOL_LEADING_FIELDS = {
    "postsecondary_school": ["UNITID", "NAME"],
    "private_school": ["PPIN", "PINST"],
    "public_school": ["NCESSCH", "NAME", "OPSTFIPS"],
}

# --- names the exploration reports give to the codes (spelling as published) --

LABOR_FORCE_REPORT = {
    "DP03_0002PE": "Labor_Force",
    "DP03_0004PE": "Cilivilian_Labor_Force_Employeed",
    "DP03_0005PE": "Cilivilian_Labor_Force_Unemployeed",
    "DP03_0014E": "Children_In_HouseHold",
}

INDUSTRY_REPORT = {**INDUSTRY, "DP03_0033E": "Argiculture"}

COMMUTE_REPORT = {
    "DP03_0019PE": "Drive_Alone",
    "DP03_0020PE": "Carpooled",
    "DP03_0021PE": "Public_Transportation",
    "DP03_0022PE": "Walked",
    "DP03_0023PE": "Others",
    "DP03_0024PE": "Work_From_Home",
}

INCOME_REPORT = {
    "DP03_0052PE": "Income_less_10K",
    "DP03_0053PE": "Income_10K_14K",
    "DP03_0054PE": "Income_15K_24K",
    "DP03_0055PE": "Income_25K_34K",
    "DP03_0056PE": "Income_35K_49K",
    "DP03_0057PE": "Income_50K_74K",
    "DP03_0058PE": "Income_75K_99K",
    "DP03_0059PE": "Income_100K_149K",
    "DP03_0060PE": "Income_150K_199K",
    "DP03_0061PE": "Income_200K_more",
}

OCCUPANCY_REPORT = {
    "DP04_0001E": "Total_Housing_Units",
    "DP04_0002PE": "Occupied_Housing_Unites",
    "DP04_0003PE": "Vacant_Housing_Unites",
}

UNIT_REPORT = {
    "DP04_0006E": "Total_Housing_Units",
    "DP04_0007PE": "Detached_Unit_1",
    "DP04_0008PE": "Attached_Unit_1",
    "DP04_0009PE": "Units_2",
    "DP04_0010PE": "Unites_3_4",
    "DP04_0011PE": "Unites_5_9",
    "DP04_0012PE": "Unites_10_19",
    "DP04_0013PE": "Unites_20_More",
    "DP04_0014PE": "Mobile_Home",
    "DP04_0015PE": "RV_Boat",
}

BUILT_REPORT = {
    "DP04_0017PE": "Built_2014_Or_Later",
    "DP04_0018PE": "Built_2010_2013",
    "DP04_0019PE": "Built_2000_2009",
    "DP04_0020PE": "Built_1990_1999",
    "DP04_0021PE": "Built_1980_1989",
    "DP04_0022PE": "Built_1970_1979",
    "DP04_0023PE": "Built_1960_1969",
    "DP04_0024PE": "Built_1950_1959",
    "DP04_0025PE": "Built_1940_1949",
    "DP04_0026PE": "Built_1939_Or_After",
}

VALUE_REPORT = {
    "DP04_0081PE": "Less_Than_50k",
    "DP04_0082PE": "V_50k_99K",
    "DP04_0083PE": "V_100K_149K",
    "DP04_0084PE": "V_150K_199K",
    "DP04_0085PE": "V_200K_299K",
    "DP04_0086PE": "V_400K_499K",
    "DP04_0087PE": "V_500K_999K",
    "DP04_0088PE": "V_1M_Or_More",
}

SEX_REPORT = {
    "S1401_C03_011E": "Male_Public",
    "S1401_C05_011E": "Female_Public",
    "S1401_C03_012E": "Male_Private",
    "S1401_C05_012E": "Female_Private",
}

IDLE_REPORT = {"S2303_C03_030E": "Male_no_working", "S2303_C05_030E": "Female_no_working"}

COURSES = ["CS327E", "CS329E"]
