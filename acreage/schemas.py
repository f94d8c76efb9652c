"""Column layouts of the feeds, documents and tables."""

from __future__ import annotations

from pyspark.sql import types as T


KINDS = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "degrees": T.DecimalType(9, 6),
    "strings": T.ArrayType(T.StringType()),
    "counts": T.MapType(T.StringType(), T.IntegerType()),
}


def layout(columns: str) -> T.StructType:
    """A layout from ``name kind`` pairs; usable before there is a session."""
    pairs = [column.strip().rsplit(" ", 1) for column in columns.split(",")]
    return T.StructType([T.StructField(name.strip(), KINDS[kind]) for name, kind in pairs])


# Header names and types of the 25-column sales feed, in file order.
SALES_FEED = layout(
    """
    Investor Name string, Address string, City string, State string, Zip string,
    County string, APN string, Owner Occupied string, Mailing Address string,
    Mailing City string, Mailing State string, Mailing Zip string,
    Property Class string, Property Type string, Bedrooms int, Bathrooms double,
    Building Sqft int, Year Built int, Lot Size Sqft int, Last Sale Date date,
    Last Sale Amount double, Est. Value int, Est. Equity float, Monthly Rent int,
    Gross Yield % double
    """
)

# Feed header -> (domain column, type). Headers not listed are dropped.
SALES_MAPPING = {
    "Investor Name": ("investor_company_nm_txt", "string"),
    "Last Sale Date": ("prop_last_sale_dt", "date"),
    "Last Sale Amount": ("prop_last_sale_amt", "double"),
    "Bedrooms": ("prop_attr_br_cnt", "int"),
    "Bathrooms": ("prop_attr_bth_cnt", "int"),
    "Building Sqft": ("prop_attr_sqft_nr", "int"),
    "Year Built": ("prop_yr_blt_nr", "int"),
    "Address": ("prop_address_line_txt", "string"),
    "City": ("prop_city_nm", "string"),
    "State": ("prop_state_nm", "string"),
    "County": ("prop_cnty_nm", "string"),
    "Zip": ("prop_zip_cd", "string"),
    "Property Class": ("prop_tlt_cnd_nm", "string"),
    "Property Type": ("prop_int_cnd_nm", "string"),
    "Owner Occupied": ("prop_ext_cnd_nm", "string"),
    "Mailing Address": ("prop_bth_cnd_nm", "string"),
    "Mailing City": ("prop_kth_cnd_nm", "string"),
    "Mailing State": ("prop_list_price_amt", "double"),
}

SALES_COLUMNS = [name for name, _ in SALES_MAPPING.values()]

# Columns that must be present for a sale to count as complete.
REQUIRED_SALE_COLUMNS = [
    "investor_company_nm_txt",
    "prop_attr_br_cnt",
    "prop_attr_bth_cnt",
    "prop_last_sale_amt",
    "prop_yr_blt_nr",
    "prop_attr_sqft_nr",
    "prop_zip_cd",
]

# Condition attributes and their grades.
CONDITIONS = ["tlt", "int", "ext", "bth", "kth"]
GRADES = ["Good", "Average", "Disrepair", "Excellent", "Poor"]

# Activity codes and the sub-codes accepted for each.
ACTIVITY = {
    "SALE": [
        "SOLD",
        "NON_ARMS_LENGTH_TRANSFER",
        "SOLD_INTER_PORTFOLIO_TRANSFER",
        "NON_ARMS_LENGTH_INTRA_PORTFOLIO_TRANSFER",
    ],
    "LISTING": [
        "LISTED_SALE",
        "LISTING_REMOVED",
        "OTHER",
        "PENDING_SALE",
        "PRICE_CHANGE",
        "RELISTED",
    ],
    "RENTAL": ["LISTED_FOR_RENT", "PRICE_CHANGE", "DELISTED_FOR_RENT", "LISTED_RENT"],
}

# Source system written to matched properties.
SOURCE_SYSTEM = {"src_system_cd": "PAR", "src_system_dc": "PROPSTREAM"}

# The profile document, as stored in its JSON text.
PROFILE = layout(
    """
    min_sqft int, min_year int, list_zips strings, mx_props_amnt double,
    min_props_amnt double, prop_bth_cnd_nm counts, prop_ext_cnd_nm counts,
    prop_int_cnd_nm counts, prop_kth_cnd_nm counts,
    prop_tlt_cnd_nm counts, min_prop_attr_br_cnt int, min_prop_attr_bth_cnt int
    """
)

# Nested columns of the investment documents.
XML_INVESTORS = T.StructType().add(
    "Investor",
    T.ArrayType(layout("InvestorID int, Name string, OwnershipPercentage double, Type string")),
)
XML_RETURNS = T.ArrayType(layout("Amount double, ROI double, Year int"))

# An investment document as it lands.
XML_DOCUMENT = (
    layout("InvestmentID bigint, Status string, Amount double").add("Investors", XML_INVESTORS).add("Returns", XML_RETURNS)
)

# One landed response of the property service, with the property's events.
PARCEL_RESPONSE = layout(
    """
    parcl_property_id bigint, bedrooms int, bathrooms double, square_footage int,
    year_built int, address string, city string, state_abbreviation string, county string,
    zip_code string, latitude double, longitude double
    """
).add(
    "events",
    T.ArrayType(
        layout(
            "event_type string, event_name string, event_date string, entity_owner_name string, price double"
        )
    ),
)

_AUDIT = "load_date_dt date, etl_nr bigint, etl_recorded_gmts timestamp, record_inserted_ts timestamp"
_ADDRESS = "prop_address_line_txt string, prop_city_nm string, prop_state_nm string, prop_cnty_nm string, prop_zip_cd string"
_ROOMS = "prop_attr_br_cnt int, prop_attr_bth_cnt int, prop_attr_sqft_nr int, prop_yr_blt_nr int"
_CONDITION = ", ".join(f"prop_{c}_cnd_nm string" for c in CONDITIONS)
_SALE = (
    "investor_company_nm_txt string, prop_last_sale_dt date, prop_last_sale_amt double, "
    f"{_ROOMS}, {_ADDRESS}, {_CONDITION}, prop_list_price_amt double"
)

# The ten tables of the two layers. ZIP sets are arrays and coordinates decimals.
TABLES = {
    "bronze.brnz_goog_prop_add_dtl": layout(
        f"brnz_goog_prop_address_dtl_sk bigint, {_AUDIT}, {_ADDRESS}"
    ),
    "bronze.brnz_prcl_prop_sales_dtl": layout(
        f"""brnz_prcl_prop_sales_dtl_sk bigint, {_AUDIT}, investor_company_nm_txt string,
        prop_sale_dt date, prop_sale_amt double, {_ROOMS}, {_ADDRESS},
        prop_list_price_amt string, prop_acty_status_cd string, prop_acty_status_dc string,
        prop_acty_sub_status_cd string, prop_acty_sub_status_dc string,
        prop_latitude_val degrees, prop_longitude_val degrees"""
    ),
    "bronze.brnz_prps_prop_sales_db_rec": layout(
        f"brnz_prps_prop_sales_dtl_sk bigint, {_AUDIT}, {_SALE}, active_rec_ind boolean, year int, address_key string"
    ),
    "bronze.brnz_prps_prop_sales_dtl": layout(
        f"brnz_prps_prop_sales_dtl_sk bigint, {_AUDIT}, {_SALE}, active_rec_ind boolean, year int"
    ),
    "silver.slv_prps_prop_sales_dtl": layout(
        f"slv_prps_prop_pk bigint, load_date_dt date, record_inserted_ts timestamp, {_SALE}, active_rec_ind boolean, year int"
    ),
    "silver.slvr_int_inv_dtl": layout(
        """investor_company_nm_txt string, num_prop_purchased_lst_12_mths_nr bigint,
        active_flg boolean, investor_profile string, active_rec_ind boolean,
        start_timestamp timestamp, end_timestamp timestamp, load_date_dt date,
        slvr_int_inv_dtl_sk bigint"""
    ),
    "silver.slvr_int_inv_dtl_profile": layout(
        "investor_company_nm_txt string, num_properties bigint, active_flag boolean, "
        "min_prop_attr_br_cnt int, min_prop_attr_bth_cnt bigint, mx_props_amnt double, "
        "min_props_amnt double, min_years bigint, min_sqft bigint, list_zips strings, "
        + ", ".join(f"{g.lower()}_prop_{c}_cnd_nm bigint" for c in CONDITIONS for g in GRADES)
        + f", slvr_prps_prop_sales_dtl_sk bigint, {_AUDIT}, year int"
    ),
    "silver.slvr_int_prop": layout(
        f"""brnz_prcl_prop_sales_dtl_sk bigint, slvr_int_inv_dtl_sk bigint, {_ROOMS},
        prop_zip_cd string, prop_city_nm string, prop_state_nm string,
        prop_address_line_txt string, src_system_cd string, src_system_dc string,
        slvr_int_prop_sk bigint, load_date_dt date, record_inserted_ts timestamp, etl_nr bigint"""
    ),
    "silver.slvr_int_prop_comps": layout(
        f"""prop_attr_br_cnt int, slvr_int_prop_sk bigint, brnz_prcl_prop_sales_dtl_sk bigint,
        prop_attr_bth_cnt int, prop_attr_sqft_nr int, prop_yr_blt_nr int, {_ADDRESS},
        prop_latitude_val degrees, prop_longitude_val degrees,
        prop_acty_status_cd string, prop_sale_amt double, prop_latest_rental_amt double,
        prop_latest_sales_amt double, etl_nr bigint, slvr_int_prop_comps_sk bigint,
        load_date_dt date, etl_recorded_gmts timestamp, record_inserted_ts timestamp"""
    ),
    "silver.slvr_int_prop_sales_dlt": layout(
        f"""slvr_int_prop_dtl_sk bigint, slvr_int_prop_fk bigint, {_AUDIT}, prop_sale_dt date,
        prop_sale_amt double, {_CONDITION}, prop_list_price_amt double,
        latest_record_ind boolean, usraddr string, slvr_int_prop_sk bigint,
        slvr_int_prop_comps_sk bigint"""
    ),
}
