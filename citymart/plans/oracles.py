"""The registered queries as ANSI SQL over the driver tables, for checking with another engine."""

from __future__ import annotations

_PLACES = """
places as (
    select n_nationkey as nationkey, r_regionkey as regionkey, n_name as neighborhood, r_name as district
    from nation join region on n_regionkey = r_regionkey
)"""

_LISTINGS = (
    _PLACES
    + """,
listings as (
    select concat(l_orderkey, '-', l_linenumber) as property_code, district, neighborhood,
           cast(l_quantity as integer) as size_m2, l_linenumber as rooms, l_returnflag as status,
           l_extendedprice as price_eur, l_extendedprice / l_quantity as price_per_m2,
           p_type as property_type
    from lineitem
    join supplier on l_suppkey = s_suppkey
    join places on s_nationkey = nationkey
    join part on l_partkey = p_partkey
),
valid as (
    select * from listings
    where price_eur > 0 and size_m2 > 0 and price_per_m2 > 0 and price_per_m2 < 20000
      and district is not null and neighborhood is not null
)"""
)


def _property(level: str) -> str:
    keys = "district" if level == "district" else "district, neighborhood"
    name = "cast(null as varchar)" if level == "district" else "neighborhood"
    return f"""
    select district, {name} as neighborhood, '{level}' as analysis_level,
           count(*) as total_properties,
           round(avg(price_eur), 2) as avg_price_eur,
           round(quantile_disc(price_eur, 0.5), 2) as median_price_eur,
           round(avg(price_per_m2), 2) as avg_price_per_m2,
           round(quantile_disc(price_per_m2, 0.5), 2) as median_price_per_m2,
           round(avg(size_m2), 1) as avg_size_m2, round(avg(rooms), 1) as avg_rooms,
           round(stddev_samp(price_per_m2), 2) as price_per_m2_stddev,
           min(price_per_m2) as min_price_per_m2, max(price_per_m2) as max_price_per_m2
    from valid group by {keys}"""


_PROPERTY = (
    _LISTINGS
    + f""",
property_district as ({_property("district")}),
property_neighborhood as ({_property("neighborhood")})"""
)

_NON_FINITE = _LISTINGS + """,
prices as (
    select district, case rooms when 1 then '-inf'::double when 6 then 'inf'::double when 7 then 'nan'::double
                     else price_eur end as price
    from listings
)
select district, """ + ", ".join(
    f"""case when isnan(p{p}) then 'nan' when isinf(p{p}) and p{p} > 0 then 'inf' when isinf(p{p}) then '-inf'
        else cast(try_cast(p{p} as decimal(18, 2)) as varchar) end as p{p}"""
    for p in (25, 50, 72, 99)
) + """
from (select district, quantile_disc(price, 0.25) as p25, quantile_disc(price, 0.5) as p50,
             quantile_disc(price, 0.72) as p72, quantile_disc(price, 0.99) as p99
      from prices group by district)"""

_MODEL = f"""{_LISTINGS},
sides as (
    select property_code, size_m2, rooms, neighborhood, property_type, status, price_eur,
           cast(concat('0x', substring(md5(concat('42|', property_code)), 1, 8)) as bigint) % 100 < 80 as train
    from listings
)"""

_INCOME = (
    _PLACES
    + """,
yearly as (
    select year(o_orderdate) as y, regionkey, district, nationkey, neighborhood,
           sum(cast(o_totalprice as decimal(18, 2))) as money, count(*) as orders,
           cast(count(distinct o_custkey) as double) as population
    from orders join customer on o_custkey = c_custkey join places on c_nationkey = nationkey
    group by all
),
income as (
    select cast(y as integer) as year, regionkey as district_code, district as district_name,
           nationkey as neighborhood_code, neighborhood as neighborhood_name, population,
           round(100 * (cast(money as double) / orders)
                 / (cast(sum(money) over (partition by y) as double) / sum(orders) over (partition by y)),
                 1) as income_index_bcn_100
    from yearly
),
sparse as (
    select * replace (
        case when year < 2000 or income_index_bcn_100 >= 100 then income_index_bcn_100 end
        as income_index_bcn_100)
    from income
)"""
)


def _latest(source: str, name: str) -> str:
    return f""",
{name}_valid as (
    select * from {source} where income_index_bcn_100 > 0
      and district_name is not null and neighborhood_name is not null
),
{name} as (
    select * exclude (newest), newest as latest_year from (
        select *, max(year) over (partition by district_name, neighborhood_name) as newest from {name}_valid
    ) where year = newest
)"""


def _population(source: str, name: str) -> str:
    return f""",
{name} as (
    select i.district_name as district, i.neighborhood_name as neighborhood, i.population
    from {source} i join (
        select district_name, neighborhood_name, max(year) as newest from {source}
        where income_index_bcn_100 is not null group by all
    ) p on i.district_name = p.district_name and i.neighborhood_name = p.neighborhood_name
       and i.year = p.newest
)"""


def _bands(value: str, cuts: tuple[float, ...]) -> str:
    labels = ("Q1_Lowest", "Q2_Low", "Q3_Medium", "Q4_High")
    tests = " ".join(f"when {value} <= {cut} then '{label}'" for cut, label in zip(cuts, labels))
    return f"case when {value} is null then null {tests} else 'Q5_Highest' end"


_SITES = """,
sites as (
    select cast(l_suppkey as varchar) as site_id, s_name as facility_name, district, neighborhood,
           p_type as category, p_brand as facility_type
    from (select distinct l_suppkey, p_brand, p_type from lineitem join part on l_partkey = p_partkey)
    join supplier on l_suppkey = s_suppkey join places on s_nationkey = nationkey
)"""

_SOCIO = """,
socio_district as (
    select district_name, min(district_code) as district_code, count(*) as neighborhood_count,
           avg(income_index_bcn_100) as avg_income_index,
           quantile_disc(income_index_bcn_100, 0.5) as median_income_index,
           stddev_samp(income_index_bcn_100) as income_inequality_stddev,
           min(income_index_bcn_100) as min_income_index, max(income_index_bcn_100) as max_income_index,
           sum(population) as total_population, avg(population) as avg_neighborhood_population,
           round(stddev_samp(income_index_bcn_100) / nullif(avg(income_index_bcn_100), 0) * 100, 2)
               as income_inequality_cv,
           'district' as analysis_level
    from latest group by district_name
)"""

_CULTURE = """,
culture_district as (
    select c.district, 'district' as analysis_level, total_cultural_sites, unique_categories,
           unique_facility_types, total_population,
           round(total_cultural_sites / nullif(total_population, 0) * 1000, 2)
               as cultural_sites_per_1000_residents
    from (select district, count(*) as total_cultural_sites, count(distinct category) as unique_categories,
                 count(distinct facility_type) as unique_facility_types
          from sites group by district) c
    left join (select district, sum(population) as total_population from population group by district) p
      on c.district = p.district
),
culture_neighborhood as (
    select c.district, c.neighborhood, 'neighborhood' as analysis_level, total_cultural_sites,
           unique_categories, unique_facility_types, population,
           case when population > 0 then round(total_cultural_sites / population * 1000, 2) else 0.0 end
               as cultural_sites_per_1000_residents
    from (select district, neighborhood, count(*) as total_cultural_sites,
                 count(distinct category) as unique_categories,
                 count(distinct facility_type) as unique_facility_types
          from sites group by district, neighborhood) c
    left join population p on c.district = p.district and c.neighborhood = p.neighborhood
)"""

_INCOME_CUTS = (70, 85, 100, 120)
_CUSTOM_CUTS = (90, 97, 103, 110)


def _all_marts(cuts: tuple[float, ...] = _INCOME_CUTS) -> str:
    return (
        _PROPERTY
        + _INCOME.replace(_PLACES, "")
        + _latest("income", "latest")
        + _population("income", "population")
        + _SITES
        + _SOCIO
        + _CULTURE
        + f""",
integrated as (
    select p.district, p.neighborhood, total_properties, avg_price_eur, median_price_eur, avg_price_per_m2,
           median_price_per_m2, avg_size_m2, income_index_bcn_100, s.population, total_cultural_sites,
           cultural_sites_per_1000_residents, {_bands("income_index_bcn_100", cuts)} as income_quintile,
           round(median_price_eur / nullif(income_index_bcn_100 * 1000, 0), 2) as affordability_ratio,
           round(income_index_bcn_100 * 0.3::double + cultural_sites_per_1000_residents * 10 * 0.3::double
                 + 1000 / nullif(avg_price_per_m2, 0) * 100 * 0.4::double, 2) as attractiveness_score,
           case when total_properties > 100 then 'High' when total_properties > 50 then 'Medium'
                else 'Low' end as market_accessibility
    from property_neighborhood p
    left join latest s on p.district = s.district_name and p.neighborhood = s.neighborhood_name
    left join culture_neighborhood c on p.district = c.district and p.neighborhood = c.neighborhood
    where median_price_eur is not null and income_index_bcn_100 is not null
)"""
    )


_RAW_LISTINGS = (
    _PLACES
    + """,
raw as (
    select concat(l_orderkey, '-', l_linenumber) as property_code,
           concat('item/', l_orderkey) as property_url,
           case when l_discount < 0.1 then district end as district, neighborhood, s_name as address,
           'city' as municipality,
           coalesce(case when l_linenumber < 3 then l_tax * 100 end, 0.0) as latitude,
           coalesce(case when l_linenumber < 4 then l_discount * 100 end, 0.0) as longitude,
           lower(l_returnflag) as property_type,
           case when l_linenumber = 1 then '{loft, flat}' else '{null, flat}' end as detailed_type,
           cast(case when l_quantity > 1 then floor(l_quantity) else 0 end as integer) as size_m2,
           cast(case when l_linenumber <> 7 then l_linenumber else 0 end as integer) as rooms,
           cast(case when l_linenumber <> 6 then l_linenumber - 1 else 0 end as integer) as bathrooms,
           case when l_linenumber <> 5 then cast(l_linenumber as varchar) end as floor,
           l_returnflag as status,
           case when l_tax > 0 then l_extendedprice else 0.0 end as price_eur,
           l_extendedprice as price_per_m2,
           l_linenumber > 2 and l_linestatus = 'F' as is_exterior,
           l_linenumber > 3 and l_linestatus = 'O' as has_lift,
           l_linenumber > 5 and l_linestatus = 'O' as has_parking,
           'idealista' as source_dataset
    from lineitem join supplier on l_suppkey = s_suppkey join places on s_nationkey = nationkey
)"""
)

_DIRTY = """
dirty as (
    select o_orderkey, nullif(o_orderstatus, 'P') as o_orderstatus,
           case when o_totalprice >= 50000 then o_totalprice end as o_totalprice,
           nullif(o_orderpriority, '5-LOW') as o_orderpriority,
           cast(year(o_orderdate) as integer) as o_year
    from orders
),
kinds as (select o_orderstatus, o_orderpriority, o_year from dirty)"""


def _metrics(table: str, columns: tuple[str, ...]) -> str:
    """Quality metrics of a table as one row."""
    missing = " + ".join(f"(count(*) - count({c}))" for c in columns)
    row = ", ".join(columns)
    return f"""(
    select total_rows, {len(columns)} as total_columns, total_missing,
           cast(total_missing as double) / (total_rows * {len(columns)}) * 100 as missing_percentage,
           total_rows - unique_rows as duplicate_count,
           cast(total_rows - unique_rows as double) / total_rows * 100 as duplicate_percentage
    from (select count(*) as total_rows, cast({missing} as bigint) as total_missing from {table}),
         (select count(*) as unique_rows from (select distinct {row} from {table}))
)"""


_KINDS = ("o_orderstatus", "o_orderpriority", "o_year")
_ORDERS = ("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority", "o_year")


def _duplicates(table: str, row: str) -> str:
    return f"""
    select total_rows, unique_rows, total_rows - unique_rows as duplicate_count,
           cast(total_rows - unique_rows as double) / total_rows * 100 as duplicate_percentage
    from (select count(*) as total_rows from {table}),
         (select count(*) as unique_rows from (select distinct {row} from {table}))"""


def _union(rows: list[str]) -> str:
    return "\nunion all\n".join(rows)


def _null_rows() -> str:
    return _union(
        [
            f"""select '{c}' as column_name, count(*) - count({c}) as missing_count,
            cast(count(*) - count({c}) as double) / count(*) * 100 as missing_pct from dirty"""
            for c in _ORDERS
        ]
    )


def _histogram(columns: tuple[str, ...], bins: int = 50) -> str:
    return _union(
        [
            f"""
    select '{c}' as column_name, bin, round(lo + bin * ((hi - lo) / {bins}), 6) as lower,
           round(lo + (bin + 1) * ((hi - lo) / {bins}), 6) as upper, count(*) as count
    from (select lo, hi, cast(least({bins - 1}, floor(({c} - lo) / (hi - lo) * {bins})) as integer) as bin
          from lineitem, (select min({c}) as lo, max({c}) as hi from lineitem))
    group by lo, hi, bin"""
            for c in columns
        ]
    )


def _correlations(columns: tuple[str, ...]) -> str:
    return _union(
        [
            f"select '{a}' as col_a, '{b}' as col_b, round(corr({a}, {b}), 6) as r from items"
            for a in columns
            for b in columns
        ]
    )


_NUMBERS = (
    "l_orderkey",
    "l_partkey",
    "l_suppkey",
    "l_linenumber",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
)


def _describe() -> str:
    rows = []
    for c in _ORDERS:
        if c in ("o_orderstatus", "o_orderpriority"):
            figures = ", ".join(f"cast(null as double) as {n}" for n in ("mean", "std", "min", "max"))
            texts = f"min({c}) as min_text, max({c}) as max_text"
            quartiles = ", ".join(f"cast(null as double) as p{p}" for p in (25, 50, 75))
        else:
            figures = (
                f"round(avg({c}), 4) as mean, round(stddev_samp({c}), 4) as std, "
                f"cast(min({c}) as double) as min, cast(max({c}) as double) as max"
            )
            texts = "cast(null as varchar) as min_text, cast(null as varchar) as max_text"
            ordered = f"list({c} order by {c}) filter ({c} is not null)"
            quartiles = ", ".join(
                f"cast(({ordered})[1 + cast(round(0.{p} * (count({c}) - 1)) as integer)] as double) as p{p}"
                for p in (25, 50, 75)
            )
        rows.append(
            f"""select '{c}' as column_name, count({c}) as count, count(*) - count({c}) as null_count,
            {figures}, {texts}, {quartiles} from dirty"""
        )
    return _union(rows)


_NET = """
net as (
    select l_returnflag as status, nullif(l_linenumber, 7) as rooms, cast(l_quantity as integer) - 1 as size_m2,
           round(l_extendedprice / 1000) - 5 as price_eur
    from lineitem
)"""

_NET_COLUMNS = ("status", "rooms", "size_m2", "price_eur")
_SPARSE_COLUMNS = (
    "year",
    "district_code",
    "district_name",
    "neighborhood_code",
    "neighborhood_name",
    "population",
    "income_index_bcn_100",
)
_SITE_COLUMNS = ("site_id", "facility_name", "district", "neighborhood", "category", "facility_type")


def _status_row(zone: str, dataset: str, table: str, columns: tuple[str, ...]) -> str:
    return f"""
    select '{zone}' as zone, '{dataset}' as dataset, 'success' as status, total_rows as record_count,
           total_columns as column_count, total_missing as null_count, missing_percentage as null_percentage,
           cast(null as varchar) as error
    from {_metrics(table, columns)}"""


def _plain_row(dataset: str, table: str, columns: int) -> str:
    return f"""
    select 'exploitation', '{dataset}', 'success', count(*), {columns}, cast(null as bigint),
           cast(null as double), cast(null as varchar) from {table}"""


_STATUS = (
    _NET
    + ","
    + _INCOME
    + _latest("income", "latest")
    + _SITES
    + """,
categories as (select district, category, count(*) as category_count from sites group by all),
status as ("""
    + _union(
        [
            _status_row("formatted", "idealista", "net", _NET_COLUMNS),
            _status_row("formatted", "income", "sparse", _SPARSE_COLUMNS),
            _status_row("formatted", "cultural_sites", "sites", _SITE_COLUMNS),
            _plain_row("categories", "categories", 3),
            _plain_row("income_quintiles", "latest", 4),
            """
    select 'exploitation', 'integrated_analytics', 'error', cast(null as bigint), cast(null as integer),
           cast(null as bigint), cast(null as double), 'not found'""",
        ]
    )
    + ")"
)


def _check_rows(dataset: str, table: str, columns: tuple[str, ...], rules: dict[str, str]) -> str:
    parts = [
        f"select 'formatted' as zone, '{dataset}' as dataset, '{c}' as check, cast({c} as double) as value "
        f"from {_metrics(table, columns)}"
        for c in ("duplicate_count", "duplicate_percentage")
    ]
    parts += [
        f"select 'formatted', '{dataset}', '{name}', cast(count(*) filter ({test}) as double) from {table}"
        for name, test in rules.items()
    ]
    return _union(parts)


_CHECKS = (
    _STATUS
    + """,
checks as ("""
    + _union(
        [
            _check_rows(
                "idealista", "net", _NET_COLUMNS, {"negative_prices": "price_eur <= 0", "zero_sizes": "size_m2 <= 0"}
            ),
            _check_rows(
                "income",
                "sparse",
                _SPARSE_COLUMNS,
                {"negative_income": "income_index_bcn_100 < 0", "future_years": "year > 2025"},
            ),
            _check_rows("cultural_sites", "sites", _SITE_COLUMNS, {}),
        ]
    )
    + """),
score as (
    select round(quality, 2) as overall_quality_score, round(good / total * 100, 2) as load_success_rate,
           total as total_datasets, good as successful_loads, total - good as failed_loads
    from (select avg(greatest(0.0, 100 - value)) as quality from checks where "check" = 'duplicate_percentage'),
         (select count(*) as total, count(*) filter (status = 'success') as good from status)
)"""
)


_COMPLETE = (
    "district is not null and neighborhood is not null and median_price_eur is not null "
    "and income_index_bcn_100 is not null"
)


def _digest() -> str:
    groups = {
        "avg_price_per_m2_by_district": (
            "property_district",
            {
                "count": "count(*)",
                "max_price": "max(avg_price_per_m2)",
                "min_price": "min(avg_price_per_m2)",
                "avg_price": "avg(avg_price_per_m2)",
            },
        ),
        "income_inequality": (
            "socio_district",
            {
                "avg_inequality": "coalesce(avg(income_inequality_cv), 0)",
                "max_inequality": "coalesce(max(income_inequality_cv), 0)",
                "min_inequality": "coalesce(min(income_inequality_cv), 0)",
            },
        ),
        "cultural_accessibility": (
            "culture_district",
            {
                "avg_cultural_density": "coalesce(avg(cultural_sites_per_1000_residents), 0)",
                "total_cultural_sites": "coalesce(sum(total_cultural_sites), 0)",
            },
        ),
        "integration_quality": (
            "integrated",
            {
                "total_records": "count(*)",
                "complete_records": f"count(*) filter ({_COMPLETE})",
                "completeness_percentage": f"coalesce(count(*) filter ({_COMPLETE}) / nullif(count(*), 0) * 100, 0)",
            },
        ),
    }
    return _union(
        [
            f"select '{group}' as kpi, '{metric}' as metric, round(cast({sql} as double), 6) as value from {table}"
            for group, (table, metrics) in groups.items()
            for metric, sql in metrics.items()
        ]
    )


_SOCIO_ROUNDED = """
select * replace (round(avg_income_index, 6) as avg_income_index,
                  round(income_inequality_stddev, 6) as income_inequality_stddev,
                  round(avg_neighborhood_population, 6) as avg_neighborhood_population)
from socio_district"""

_SUMMARY = """
select zone, count(*) as total_datasets, count(*) filter (status = 'success') as successful_loads,
       cast(coalesce(sum(record_count) filter (status = 'success'), 0) as bigint) as total_records,
       round(count(*) filter (status = 'success') / count(*) * 100, 6) as success_rate
from status group by zone"""

_ADVICE = """
advice as (
    select 'failed_loads' as rule, cast(null as varchar) as dataset, cast(failed_loads as double) as value,
           concat('⚠️ ', failed_loads, ' datasets failed to load. Check data paths and file formats.') as message
    from score where load_success_rate < 100
    union all
    select 'low_quality_score', null, overall_quality_score,
           concat('⚠️ Data quality score is ', printf('%.1f%%', overall_quality_score),
                  '. Review data cleaning processes.')
    from score where overall_quality_score < 80
    union all
    select 'high_duplicate_rate', dataset, round(value, 6),
           concat('⚠️ High duplicate rate in ', dataset, ' (', printf('%.1f%%', value),
                  '). Consider deduplication.')
    from checks where "check" = 'duplicate_percentage' and value > 10
    union all
    select 'invalid_prices', dataset, value,
           concat('⚠️ Found ', cast(value as bigint), ' records with invalid prices in ', dataset,
                  '. Review price validation rules.')
    from checks where "check" = 'negative_prices' and value > 0
)"""


# The split of all training rows that leaves the least squares, among the midpoints between values that occur.
_STUMP = """,
features as (
    select f.feature, f.value, price_eur as price from sides, lateral ({features}) f(feature, value) where train
),
cells as (select feature, value, count(*) as n, sum(price) as s, sum(price * price) as q from features group by all),
cuts as (
    select feature, value, lead(value) over (partition by feature order by value) as next,
           sum(n) over upto as n, sum(s) over upto as s, sum(q) over upto as q,
           sum(n) over whole as all_n, sum(s) over whole as all_s, sum(q) over whole as all_q
    from cells window upto as (partition by feature order by value), whole as (partition by feature)
),
best as (
    select *, (value + next) / 2.0::double as threshold from cuts where next is not null
    order by (q - s * s / n) + (all_q - q - (all_s - s) * (all_s - s) / (all_n - n)) limit 1
),
tree as (
    select 0 as node, feature, threshold, cast(all_n as bigint) as "rows", all_s / all_n as prediction from best
    union all select 1, null, null, cast(n as bigint), s / n from best
    union all select 2, null, null, cast(all_n - n as bigint), (all_s - s) / (all_n - n) from best
)"""
_size_only = "values ('size_m2', size_m2)"
_size_or_rooms = "values ('size_m2', size_m2), ('rooms', rooms)"

# A line and the tree by their error on the other rows.
_RANKING = """
line as (
    select regr_slope(price_eur, size_m2) as slope, regr_intercept(price_eur, size_m2) as start from sides where train
),
errors as (
    select 'LinearRegression' as model, price_eur - start - slope * size_m2 as e from sides, line where not train
    union all
    select 'Stump', price_eur - prediction
    from sides, best join tree on node = case when size_m2 <= best.threshold then 1 else 2 end where not train
),
ranking as (
    select model, sqrt(avg(e * e)) as error, round(sqrt(avg(e * e)), 4) as rmse,
           row_number() over (order by sqrt(avg(e * e)), model) as place
    from errors group by model
)"""

_PRICE_FIGURES = """
               count(*) as listings, round(avg(price_eur), 4) as avg_price_eur,
               round(avg(price_per_m2), 4) as avg_price_per_m2, round(avg(size_m2), 4) as avg_size_m2,
               min(price_per_m2) as price_per_m2_min, max(price_per_m2) as price_per_m2_max,
               quantile_disc(price_eur, 0.5) as median_price_eur, quantile_disc(price_per_m2, 0.9) as p90_price_per_m2"""

_DIRTY_COLUMNS = ("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority", "o_year")

# A table of customers before and after it is replaced by those with a balance, which is doubled.
_SEGMENTS = """
    select c_mktsegment, count(*) as customers,
           cast(sum(cast(c_acctbal as decimal(18,2)) * cast(1 + after as integer)) as double) as balance, state
    from customer, (values {states}) s(state, after)
    where after = 0 or c_acctbal > 0
    group by c_mktsegment, state"""

ORACLES: dict[str, str] = {
    "standardize_listings": f"with {_RAW_LISTINGS} select * from raw where price_eur > 0 and size_m2 > 0 and district is not null",
    "format_listings_json": f"with {_RAW_LISTINGS} select * from raw where price_eur > 0 and size_m2 > 0 and district is not null",
    "format_income_csv": f"""with {_INCOME}
        select year, nullif(district_code, 4) as district_code, district_name, neighborhood_code, neighborhood_name,
               case when year <> 1996 then population end as population,
               case when income_index_bcn_100 >= 95 then income_index_bcn_100 end as income_index_bcn_100,
               'income' as source_dataset
        from income""",
    "format_sites_csv": f"""with {_PLACES}{_SITES}
        select site_id, facility_name, category as institution_name, cast(length(district) as integer) as district_code,
               district, neighborhood,
               case when category <> 'PROMO' then length(facility_type) + 0.5::double else 0.0 end as latitude,
               length(category) + 0.25::double as longitude, category, facility_type,
               'cultural_sites' as source_dataset
        from sites where facility_type <> 'Brand#9'""",
    "clean_sentinels": """
        select l_orderkey, l_linenumber, l_partkey,
               case when l_quantity > 2 then cast(l_quantity as integer) end as quantity from lineitem""",
    "nested_struct_access": """
        select event_id, cast(props->>'$.k' as integer) as k, concat('{', props->>'$.k', '}') as as_text from events""",
    "outlier_filter": f"""with {_LISTINGS}
        select property_code, district, neighborhood, size_m2, price_eur, price_per_m2 from valid""",
    "regex_numeric_parse": """
        select p_partkey, cast(floor as integer) as floor from (
            select p_partkey, coalesce(case when p_size = 1 then 'bj' when p_size = 2 then 'en'
                                            when p_size > 3 then substring(p_brand, 7) end, '0') as floor from part)
        where regexp_full_match(floor, '[0-9]+')""",
    "fill_defaults": f"""with {_DIRTY}
        select o_orderkey, coalesce(o_orderstatus, 'good') as o_orderstatus,
               coalesce(o_totalprice, 0) as o_totalprice, coalesce(o_orderpriority, '0') as o_orderpriority, o_year
        from dirty""",
    "union_relaxed": """
        select p_partkey as id, cast(p_size as varchar) as tag, p_retailprice from part
        union all select event_id, event_type, null from events""",
    "mixed_files": """
        select cast(doc_id as integer) as doc_id, quality, toxic, cast(null as bigint) as conv_id,
               cast(null as varchar) as role, cast(null as varchar) as text, cast(null as bigint) as turn from labels
        union all select null, null, null, conv_id, role, text, turn from conversations""",
    "distinct_rows": "select distinct text, lang, source from documents",
    "property_district": f"with {_PROPERTY} select * from property_district",
    "property_neighborhood": f"with {_PROPERTY} select * from property_neighborhood",
    "property_analytics": f"""with {_PROPERTY}
        select * from property_district union all select * from property_neighborhood""",
    "property_exact": f"""with {_PROPERTY}
        select * from property_district union all select * from property_neighborhood""",
    "quantiles_non_finite": f"with {_NON_FINITE}",
    "sketches_non_finite": f"with {_NON_FINITE}",
    "property_stored": f"with {_PROPERTY} select * from property_neighborhood",
    "property_type": f"""with {_LISTINGS}
        select district, property_type, count(*) as type_count,
               round(avg(price_per_m2), 6) as avg_price_per_m2_by_type,
               quantile_disc(price_per_m2, 0.5) as median_price_per_m2_by_type
        from valid group by district, property_type""",
    "property_marts": f"""with {_PROPERTY}
        select district, coalesce(neighborhood, 'all') as part, analysis_level, total_properties as listings,
               median_price_per_m2 as median_price
        from (select * from property_district union all select * from property_neighborhood)
        union all
        select district, property_type, 'property_type', count(*), round(quantile_disc(price_per_m2, 0.5), 2)
        from valid group by district, property_type""",
    "latest_income": f"with {_INCOME}{_latest('sparse', 'latest')} select * from latest",
    "latest_population": f"with {_INCOME}{_population('sparse', 'population')} select * from population",
    "latest_orders": """
        select o_orderkey, o_custkey from (
            select *, rank() over (partition by o_custkey order by o_orderdate desc) as r from orders)
        where r = 1""",
    "socioeconomic_district": f"with {_INCOME}{_latest('income', 'latest')}{_SOCIO} {_SOCIO_ROUNDED}",
    "socioeconomic_neighborhood": f"""with {_INCOME}{_latest('sparse', 'latest')}
        select district_name, neighborhood_name, district_code, neighborhood_code, income_index_bcn_100, population,
               latest_year as data_year, 'neighborhood' as analysis_level
        from latest""",
    "income_bands": f"""with {_INCOME}{_latest('income', 'latest')}
        select district_name, neighborhood_name, income_index_bcn_100,
               {_bands('income_index_bcn_100', _INCOME_CUTS)} as income_quintile from latest""",
    "income_bands_custom": f"""with {_INCOME}{_latest('income', 'latest')}
        select district_name, neighborhood_name, income_index_bcn_100,
               {_bands('income_index_bcn_100', _CUSTOM_CUTS)} as income_quintile from latest""",
    "cultural_district": f"""with {_INCOME}{_population('income', 'population')}{_SITES}{_CULTURE}
        select * from culture_district""",
    "cultural_neighborhood": f"""with {_INCOME},
        gaps as (
            select * replace (case when neighborhood_code % 3 <> 0 then income_index_bcn_100 end
                              as income_index_bcn_100)
            from income){_population('gaps', 'population')}{_SITES}{_CULTURE}
        select * from culture_neighborhood""",
    "cultural_category": f"""with {_PLACES}{_SITES}
        select district, category, count(*) as category_count from sites group by district, category""",
    "integrated": f"with {_all_marts()} select * from integrated",
    "market_accessibility": f"""with {_LISTINGS}
        select district, neighborhood, count(*) as total_properties,
               case when count(*) > 100 then 'High' when count(*) > 50 then 'Medium' else 'Low' end
                   as market_accessibility,
               case when count(*) > 3000 then 'High' when count(*) > 1000 then 'Medium' else 'Low' end
                   as market_accessibility_custom
        from valid group by district, neighborhood""",
    "price_quartiles_by_type": f"""with {_LISTINGS}
        select property_type, count(*) as listings, quantile_disc(price_eur, 0.25) as price_q1,
               quantile_disc(price_eur, 0.5) as price_q2, quantile_disc(price_eur, 0.75) as price_q3
        from listings group by property_type""",
    "listing_counts": f"with {_PROPERTY} select district, neighborhood, total_properties from property_neighborhood",
    "district_prices": f"""with {_PROPERTY}
        select district, avg_price_per_m2, total_properties from property_district
        order by avg_price_per_m2 desc, district""",
    "district_affordability": f"""with {_all_marts()}
        select district, median_price_eur, median_income_index,
               round(median_price_eur / nullif(median_income_index * 1000, 0), 2) as affordability_ratio
        from property_district join socio_district on district = district_name""",
    "attractiveness": f"""with {_all_marts()}
        select district, neighborhood, attractiveness_score from integrated
        order by attractiveness_score desc nulls last, district, neighborhood""",
    "affordability": f"with {_all_marts()} select district, neighborhood, affordability_ratio from integrated",
    "economic_accessibility": f"""with {_all_marts()}
        select count(*) as neighborhoods,
               round(corr(income_index_bcn_100, avg_price_per_m2), 6) as corr_income_price_per_m2,
               round(corr(income_index_bcn_100, avg_price_eur), 6) as corr_income_price
        from integrated""",
    "cultural_economic_correlation": f"""with {_all_marts()}
        select count(*) as neighborhoods,
               round(corr(cultural_sites_per_1000_residents, income_index_bcn_100), 6) as corr_culture_income
        from integrated""",
    "spatial_equity": f"""with {_all_marts(_CUSTOM_CUTS)}
        select income_quintile, count(*) as neighborhoods,
               cast(coalesce(sum(total_cultural_sites), 0) as bigint) as total_sites,
               round(avg(cultural_sites_per_1000_residents), 6) as avg_density,
               round(coalesce(sum(total_cultural_sites), 0)
                     / (select sum(total_cultural_sites) from integrated) * 100, 6) as site_share_pct
        from integrated group by income_quintile""",
    "kpi_digest": f"with {_all_marts()} {_digest()}",
    "null_profile": f"with {_DIRTY} {_null_rows()}",
    "missing_top": f"""with {_DIRTY} select * from ({_null_rows()}) where missing_count > 0
        order by missing_pct desc, column_name limit 2""",
    "missing_matrix": f"""with {_DIRTY}
        select {", ".join(f"cast({c} is null as integer) as {c}" for c in _ORDERS)}
        from (select * from dirty order by o_orderkey limit 100)""",
    "duplicate_profile": f"with {_DIRTY} {_duplicates('kinds', ', '.join(_KINDS))}",
    "duplicate_texts": _duplicates("documents", "text"),
    "duplicate_keys": _duplicates("lineitem", "l_orderkey, l_linenumber"),
    "quality_metrics": f"with {_DIRTY} select * from {_metrics('kinds', _KINDS)}",
    "quality_scores": f"""with {_DIRTY}
        select round(greatest(0.0, 100 - (missing_percentage + duplicate_percentage)), 6) as overview_score,
               round(100 - missing_percentage, 6) as completeness, round(100 - duplicate_percentage, 6) as uniqueness,
               round((100 - missing_percentage + 100 - duplicate_percentage) / 2, 6) as overall_quality
        from {_metrics('kinds', _KINDS)}""",
    "insights": f"""with {_DIRTY}, m as (select * from {_metrics('kinds', _KINDS[:2])})
        select 'high_missing_rate' as rule, round(missing_percentage, 6) as value from m where missing_percentage > 10
        union all select 'significant_duplicates', round(duplicate_percentage, 6) from m
            where duplicate_percentage > 5
        union all select 'no_numeric_columns', 0.0
        union all select 'small_dataset', cast(total_rows as double) from m where total_rows < 100""",
    "quality_bands": f"""with {_DIRTY}, s as (
            select 'orders' as dataset,
                   round((100 - missing_percentage + 100 - duplicate_percentage) / 2, 6) as score
            from {_metrics('dirty', _ORDERS)}
            union all
            select 'kinds', round((100 - missing_percentage + 100 - duplicate_percentage) / 2, 6)
            from {_metrics('kinds', _KINDS)})
        select dataset, score, round(greatest(0.0, score - 80), 6) as high_quality,
               round(case when score > 50 then least(80.0, score - 50) else greatest(0.0, score) end, 6)
                   as medium_quality,
               round(greatest(0.0, 50 - score), 6) as low_quality
        from s""",
    "histogram": _histogram(("l_extendedprice", "l_quantity", "l_tax")),
    "top_values": """
        select source as value, count(*) as count from documents group by source
        order by count desc, value limit 15""",
    "correlation_matrix": f"""with items as (
            select l_extendedprice, case when l_quantity > 5 then l_quantity end as l_quantity, l_discount,
                   l_linenumber from lineitem)
        {_correlations(("l_extendedprice", "l_quantity", "l_discount", "l_linenumber"))}""",
    "describe": f"with {_DIRTY} {_describe()}",
    "column_types": """
        select case when column_type in ('TINYINT', 'SMALLINT', 'INTEGER', 'BIGINT', 'FLOAT', 'DOUBLE') then 'numeric'
                    when column_type = 'VARCHAR' then 'categorical'
                    when column_type like 'DATE%' or column_type like 'TIMESTAMP%' then 'date'
                    else 'other' end as type_class,
               cast(count(*) as integer) as column_count, (select count(*) from events) as total_rows
        from (describe events) group by 1""",
    "sample_rows": """
        select o_orderkey, o_custkey, o_totalprice from orders
        order by md5(concat('42|', o_orderkey)), o_orderkey limit 1000""",
    "clipped_preview": """
        select doc_id, concat(substring(text, 1, 20), '...') as text, concat(substring(lang, 1, 20), '...') as lang
        from documents order by doc_id limit 3""",
    "zone_status": f"""with {_STATUS}
        select * replace (round(null_percentage, 6) as null_percentage) from status""",
    "rule_violations": f"""with {_NET} """
    + _union(
        [
            f"select '{name}' as check, cast(count(*) filter ({test}) as double) as value from net"
            for name, test in {
                "negative_prices": "price_eur <= 0",
                "zero_sizes": "size_m2 <= 0",
                "many_rooms": "rooms > 4",
                "unknown_rooms": "rooms is null",
            }.items()
        ]
    ),
    "quality_checks": f"with {_CHECKS} select * replace (round(value, 6) as value) from checks",
    "row_count_gate": f"""with {_STATUS}, limits(dataset, needed) as (
            values ('idealista', 10000), ('income', 500), ('cultural_sites', 400), ('weather', 1))
        select dataset, record_count, cast(coalesce(needed, 0) as bigint) as min_required,
               case when status is null then 'MISSING' when status <> 'success' then 'ERROR'
                    when record_count >= coalesce(needed, 0) then 'PASS' else 'FAIL' end as gate
        from status full join limits using (dataset)""",
    "required_mart_gate": f"""with {_STATUS}, required(dataset) as (
            values ('categories'), ('income_quintiles'), ('integrated_analytics'), ('property_analytics'))
        select r.dataset, record_count,
               case when status is null then 'MISSING' when status <> 'success' then 'ERROR'
                    when record_count > 0 then 'PASS' else 'FAIL' end as gate
        from required r left join status s on r.dataset = s.dataset""",
    "zone_summary": f"with {_STATUS} {_SUMMARY}",
    "run_summary": f"""with {_STATUS}
        select count(*) as total_datasets, count(*) filter (status = 'success') as successful_loads,
               cast(sum(record_count) as bigint) as total_records from status""",
    "quality_score": f"with {_CHECKS} select * from score",
    "recommendations": f"""with {_CHECKS}, {_ADVICE}
        select * from advice
        union all select 'healthy', null, null, '✅ All validations passed. Data pipeline is healthy.'
        where not exists (select * from advice)""",
    "validation_report": f"""with {_CHECKS}, {_ADVICE}
        select case when load_success_rate > 80 then 'PASSED' else 'FAILED' end as overall_status,
               overall_quality_score as data_quality_score, load_success_rate,
               cast(total_datasets as bigint) as total_datasets_validated, '2.50s' as execution_time,
               (select cast(sum(record_count) as bigint) from status where zone = 'formatted') as formatted_records,
               (select count(*) from status where zone = 'exploitation' and status = 'success') as marts_loaded,
               (select count(*) from sites) as sites,
               (select count(*) from net where price_eur <= 0) as negative_prices, 'not found' as error,
               (select cast(greatest(1, count(*)) as integer) from advice) as advice
        from score""",
    "log_search": """
        select concat(upper(event_type), ' user=', user_id, ' ', props) as line from events
        where event_type = 'error'""",
    "zone_tables": f"""with {_INCOME}{_latest('income', 'latest')}{_SITES}
        select 'exploitation' as zone, 'cultural_category_analytics' as dataset, 'success' as status,
               count(*) as record_count, 3 as column_count
        from (select distinct district, category from sites)
        union all select 'exploitation', 'income_quintiles', 'success', count(*), 4 from latest
        union all select 'exploitation', 'integrated_analytics', 'error', null, null""",
    "model_rows": f"""with {_LISTINGS}
        select property_code, neighborhood, property_type, size_m2, rooms,
               cast(substring(p_brand, 7) as integer) as floor, status, price_eur as price, is_exterior
        from listings where regexp_full_match(substring(p_brand, 7), '[0-9]+')""".replace(
        "p_type as property_type\n", "p_type as property_type, p_brand, l_linestatus = 'O' as is_exterior\n"
    ),
    "model_split": f"""with {_MODEL}
        select property_code, case when train then 'train' else 'validation' end as side from sides""",
    "linear_price_model": f"""with {_MODEL}, line as (
            select regr_slope(price_eur, size_m2) as slope, regr_intercept(price_eur, size_m2) as start
            from sides where train)
        select 'LinearRegression' as model, round(sqrt(avg((price_eur - start - slope * size_m2) ** 2)), 4) as rmse
        from sides, line where not train""",
    "json_arrays": "select * from conversations",
    "folder_json": "select * from conversations",
    "folder_csv": "select doc_id, text, lang from documents",
    "load_safety": f"""with {_RAW_LISTINGS}
        select property_code, district, size_m2 from raw
        where price_eur > 0 and size_m2 > 0 and district is not null and rooms <> 2
          and (floor is null or floor <> '3')""",
    "load_times": f"""with {_RAW_LISTINGS}{_SITES}
        select 'load' as what, count(*) as row_count, count(*) as known, cast(1 as bigint) as times
        from raw where price_eur > 0 and size_m2 > 0 and district is not null
        union all select 'mart', count(*), count(*), 1 from (select distinct district, category from sites)""",
    "zone_files": """
        select 'formatted' as zone, count(*) > 0 as exists, cast(2 as bigint) as dir_count, true as has_content,
               true as dated
        from nation
        union all select 'landing', false, 0, false, false""",
    "table_files": """
        select dataset, cast(2 as integer) as file_count from (values ('idealista'), ('income')) t(dataset)
        where exists (select * from nation)""",
    "required_folders": """
        select dataset, dataset <> 'cultural-sites' as exists,
               cast(case when dataset <> 'cultural-sites' then 2 else 0 end as integer) as file_count
        from (values ('idealista'), ('income'), ('cultural-sites')) t(dataset)""",
    "table_preview": "select * from nation",
    "log_files": "select 'two' as run, count(*) > 0 as has_content from events",
    "newest_report": "select cast(0 as bigint) as run, count(*) as rows from labels where toxic = 0",
    "zone_checks": f"""with {_INCOME}
        select 'formatted' as zone, 'income' as dataset, "check", round(value, 6) as value,
               cast(null as boolean) as names_column
        from ({_check_rows("income", "sparse", _SPARSE_COLUMNS, {
            "negative_income": "income_index_bcn_100 < 0", "future_years": "year > 2025"})})
        union all select 'formatted', 'idealista', 'error', null, true""",
    "run_report": f"""with {_INCOME}
        select '2025-01-01' as execution_date, 'run-1' as run_id, 'FAILED' as pipeline_status,
               cast(3 as bigint) as landing_zone_datasets, cast(2 as bigint) as formatted_datasets,
               cast(1 as bigint) as analytics_datasets,
               (select count(*) from nation) + (select count(*) from sparse) as total_records_processed,
               'PASSED' as status, 100.0::double as quality_score, 100.0::double as load_success_rate""",
    "newest_order": """
        select o_custkey, o_orderkey, o_totalprice from (
            select *, row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) as r
            from orders)
        where r = 1""",
    "canonical_names": """
        select c_custkey, case when n_nationkey % 2 = 1 then concat(n_name, '!') else n_name end as n_name
        from customer join nation on c_nationkey = n_nationkey""",
    "completeness_gaps": f"""with {_INCOME}, gaps as (
            select year <> 1996 and income_index_bcn_100 is not null as complete from sparse)
        select count(*) as total_records, count(*) filter (complete) as complete_records,
               round(count(*) filter (complete) / count(*) * 100, 6) as completeness_percentage
        from gaps""",
    "histogram_all": _histogram(_NUMBERS)
    + """
    union all
    select 'odd_tax', bin, case when bin is not null then round(lo + bin * ((hi - lo) / 50), 6) end,
           case when bin is not null then round(lo + (bin + 1) * ((hi - lo) / 50), 6) end, count(*)
    from (select lo, hi, case when l_linenumber < 6
                 then cast(least(49, floor((l_tax - lo) / (hi - lo) * 50)) as integer) end as bin
          from lineitem, (select min(l_tax) as lo, max(l_tax) as hi from lineitem where l_linenumber < 6))
    group by lo, hi, bin""",
    "correlation_all": f"""with items as (
            select {", ".join(_NUMBERS)}, l_quantity * l_tax as quantity_tax, l_extendedprice * l_discount as saved,
                   case when l_quantity > 5 then l_linenumber end as some_lines
            from lineitem)
        {_correlations((*_NUMBERS, "quantity_tax", "saved", "some_lines"))}""",
    "replaced_table": _SEGMENTS.format(states="('before', 0.0), ('after', 1.0)"),
    "replaced_version": _SEGMENTS.format(states="('before', 0.0), ('after', 1.0)"),
    "written_figures": f"""with {_NET}, {_DIRTY}, written as ("""
    + _union(
        [
            _status_row("formatted", "idealista", "net", _NET_COLUMNS),
            _status_row("formatted", "cultural_sites", "dirty", _DIRTY_COLUMNS),
        ]
    )
    + """)
        select * replace (round(null_percentage, 6) as null_percentage) from written""",
    "forest_split": f"""with {_MODEL} {_STUMP.format(features=_size_or_rooms)}
        select node, feature, threshold, "rows", round(prediction, 4) as prediction from tree""",
    "forest_predictions": f"""with {_MODEL} {_STUMP.format(features=_size_or_rooms)}
        select property_code, round(prediction, 4) as prediction
        from sides, best join tree on node = case when case best.feature when 'size_m2' then size_m2 else rooms end
                                                     <= best.threshold then 1 else 2 end
        where not train""",
    "forest_ranking": f"""with {_MODEL} {_STUMP.format(features=_size_only)}, {_RANKING}
        select place, model, rmse from ranking""",
    "label_index": f"""with {_MODEL}, labels as (
            select 'neighborhood' as "column", neighborhood as label from sides where train
            union all select 'property_type', property_type from sides where train
            union all select 'status', status from sides where train),
        counted as (select "column", label, count(*) as count from labels group by all)
        select *, cast(row_number() over (partition by "column" order by count desc, label) - 1 as integer) as index
        from counted""",
    "training_run": f"""with {_RAW_LISTINGS}, sides as (
            select *, cast(concat('0x', substring(md5(concat('42|', property_code)), 1, 8)) as bigint) % 100 < 80 as train
            from raw where price_eur > 0 and size_m2 > 0 and district is not null)
        {_STUMP.format(features=_size_only)}, {_RANKING}
        select place, model, rmse, case when place = 1 then 'size_m2 int' end as inputs,
               cast(case when place = 1 then 5 end as bigint) as examples from ranking""",
    "price_rollup": f"""with {_LISTINGS}
        select case when grouping(district) = 1 then 'city' when grouping(neighborhood) = 0 then 'neighborhood'
                    when grouping(property_type) = 0 then 'property_type' else 'district' end as grain,
               district, neighborhood, property_type, {_PRICE_FIGURES}
        from valid group by grouping sets ((), (district), (district, neighborhood), (district, property_type))""",
    "price_refresh": f"""with {_LISTINGS}, changed as (
            select * replace (case when neighborhood = 'FRANCE' then 2 * price_eur else price_eur end as price_eur)
            from valid where neighborhood <> 'FRANCE' or 2 * price_eur > 30000)
        select case when grouping(neighborhood) = 0 then 'neighborhood' else 'district' end as grain,
               district, neighborhood, {_PRICE_FIGURES}
        from changed group by grouping sets ((district), (district, neighborhood))""",
    "site_rollup": f"""with {_PLACES}{_SITES}
        select case when grouping(district) = 1 then 'city' when grouping(neighborhood) = 0 then 'neighborhood'
                    else 'district' end as grain,
               district, neighborhood, count(*) as sites, count(distinct category) as unique_category,
               count(distinct facility_type) as unique_facility_type
        from sites group by grouping sets ((), (district), (district, neighborhood))""",
    "exact_duplicates": f"""with kinds as (select text, lang, source from documents)
        {_duplicates('kinds', 'text, lang, source')}""",
    "exact_checks": f"""with {_NET}
        select zone, dataset, "check", round(value, 6) as value
        from ({_check_rows("idealista", "net", _NET_COLUMNS, {
            "negative_prices": "price_eur <= 0", "zero_sizes": "size_m2 <= 0"})})""",
    "heavy_values": """
        select l_partkey as value, count(*) as count from lineitem group by l_partkey order by 2 desc, 1 limit 15""",
    "heavy_texts": """
        select case when doc_id % 5 > 0 then concat_ws('/', source, lang) end as value, count(*) as count
        from documents group by 1 order by 2 desc, 1 nulls first limit 20""",
    "mixed_json": """
        select o_orderkey as k,
               case o_orderkey % 4 when 0 then cast(o_custkey as varchar) when 1 then o_orderstatus end as v,
               case when o_orderkey % 4 = 2 then o_totalprice > 1e5 end as big,
               case when o_orderkey % 4 = 1 then o_custkey end as c,
               case when o_orderkey % 4 = 3 then 'x' end as its
        from orders""",
    "log_increments": """
        select concat(upper(event_type), ' user=', user_id, ' ', props) as line, event_id % 2 as batch,
               case event_id % 2 when 0 then (select count(*) from events where event_id % 2 = 0)
                    else (select count(*) from events where event_id % 2 = 1) end as came,
               cast(0 as bigint) as again
        from events where event_type = 'error'""",
    "zone_counts": """
        select 'regions' as zone, true as exists, count(distinct n_regionkey) as dir_count,
               count(*) + count(distinct n_regionkey) as file_count
        from nation
        union all select 'none', false, 0, 0""",
    "folder_counts": """
        select concat('region-', n_regionkey) as dataset, true as exists, cast(count(*) + 1 as integer) as file_count, asked
        from nation, (values ('table'), ('required')) a(asked) group by n_regionkey, asked
        union all select 'region-none', false, 0, 'required'""",
    "preview_rows": """
        select 'orders' as dataset, least(100, count(*)) as shown, cast(6 as integer) as columns from orders
        union all select 'nation', least(100, count(*)), cast(3 as integer) from nation""",
}

ORACLES["gram_correlations"] = ORACLES["correlation_all"]
ORACLES["rollup_property"] = ORACLES["property_analytics"]
ORACLES["rollup_culture"] = ORACLES["cultural_district"]
