"""The input schemas and the column contracts of every stored table."""

from __future__ import annotations

# Landing files as they arrive. Counts are read as doubles, so that 3 and 3.0 are both understood.
LISTINGS_LANDING = """
    propertyCode string, url string, district string, neighborhood string, address string,
    municipality string, latitude double, longitude double, propertyType string,
    detailedType struct<subTypology: string, typology: string>, size double, rooms double,
    bathrooms double, floor string, status string, price double, priceByArea double,
    exterior boolean, hasLift boolean, parkingSpace struct<hasParkingSpace: boolean,
    isParkingSpaceIncludedInPrice: boolean, parkingSpacePrice: double>
"""
INCOME_LANDING = """
    Any string, Codi_Districte string, Nom_Districte string, Codi_Barri string, Nom_Barri string,
    `Població` string, `Índex RFD Barcelona = 100` string
"""

# Stored tables, columns in order.
FORMATTED = {
    "idealista": """
        property_code string, property_url string, district string, neighborhood string,
        address string, municipality string, latitude double, longitude double,
        property_type string, detailed_type string, size_m2 int, rooms int, bathrooms int,
        floor string, status string, price_eur double, price_per_m2 double, is_exterior boolean,
        has_lift boolean, has_parking boolean, load_timestamp timestamp, source_dataset string
    """,
    "income": """
        year int, district_code int, district_name string, neighborhood_code int,
        neighborhood_name string, population double, income_index_bcn_100 double,
        load_timestamp timestamp, source_dataset string
    """,
    "cultural_sites": """
        site_id string, facility_name string, institution_name string, district_code int,
        district string, neighborhood string, latitude double, longitude double,
        category string, facility_type string, load_timestamp timestamp, source_dataset string
    """,
}

EXPLOITATION = {
    "property_analytics": """
        district string, neighborhood string, analysis_level string, total_properties bigint,
        avg_price_eur double, median_price_eur double, avg_price_per_m2 double,
        median_price_per_m2 double, avg_size_m2 double, avg_rooms double,
        price_per_m2_stddev double, min_price_per_m2 double, max_price_per_m2 double,
        created_at timestamp
    """,
    "property_type_analytics": """
        district string, property_type string, type_count bigint,
        avg_price_per_m2_by_type double, median_price_per_m2_by_type double
    """,
    "socioeconomic_district_analytics": """
        district_name string, district_code int, neighborhood_count bigint,
        avg_income_index double, median_income_index double, income_inequality_stddev double,
        min_income_index double, max_income_index double, total_population double,
        avg_neighborhood_population double, income_inequality_cv double, analysis_level string
    """,
    "socioeconomic_neighborhood_analytics": """
        district_name string, neighborhood_name string, district_code int, neighborhood_code int,
        income_index_bcn_100 double, population double, data_year int, analysis_level string
    """,
    "income_quintiles": """
        district_name string, neighborhood_name string, income_index_bcn_100 double,
        income_quintile string
    """,
    "cultural_district_analytics": """
        district string, analysis_level string, total_cultural_sites bigint,
        unique_categories bigint, unique_facility_types bigint, total_population double,
        cultural_sites_per_1000_residents double
    """,
    "cultural_neighborhood_analytics": """
        district string, neighborhood string, analysis_level string, total_cultural_sites bigint,
        unique_categories bigint, unique_facility_types bigint, population double,
        cultural_sites_per_1000_residents double
    """,
    "cultural_category_analytics": "district string, category string, category_count bigint",
    "integrated_analytics": """
        district string, neighborhood string, total_properties bigint, avg_price_eur double,
        median_price_eur double, avg_price_per_m2 double, median_price_per_m2 double,
        avg_size_m2 double, income_index_bcn_100 double, population double,
        total_cultural_sites bigint, cultural_sites_per_1000_residents double,
        income_quintile string, affordability_ratio double, attractiveness_score double,
        market_accessibility string, created_at timestamp
    """,
}

PARTITIONS = {
    "idealista": ["district"],
    "income": ["year"],
    "cultural_sites": ["district"],
    "property_analytics": ["analysis_level"],
    "integrated_analytics": ["income_quintile"],
}
