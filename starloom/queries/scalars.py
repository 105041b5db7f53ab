"""Scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from starloom.functions import clean_literal, date_key, instant, normalise_us_date, scd_hash
from starloom.plans.calendar import calendar_covering
from starloom.queries.base import query, roles

INVENTORY_AT = "2001-12-31 13:45:30"


@query("string_functions", roles("cust") + """
select customer_id, left(company_name, 3) as first_three, right(company_name, 3) as last_three,
       substr(company_name, 2, 3) as middle, upper(company_name) as upper_name, lower(company_name) as lower_name,
       company_name || ' / ' || fax as strict_concat, concat(company_name, ' / ', coalesce(fax, '')) as loose_concat,
       left(phone, instr(phone, '-') - 1) as before_dash, instr(phone, '-') as dash_at from cust""")
def string_functions(s):
    name, phone, fax = F.col("company_name"), F.col("phone"), F.col("fax")
    return s.src.customers.select(
        "customer_id", F.left(name, F.lit(3)).alias("first_three"), F.right(name, F.lit(3)).alias("last_three"),
        F.substring(name, 2, 3).alias("middle"), F.upper(name).alias("upper_name"), F.lower(name).alias("lower_name"),
        F.concat(name, F.lit(" / "), fax).alias("strict_concat"),
        F.concat(name, F.lit(" / "), F.coalesce(fax, F.lit(""))).alias("loose_concat"),
        F.substring_index(phone, "-", 1).alias("before_dash"), F.instr(phone, "-").cast("bigint").alias("dash_at"))


@query("date_functions", roles("ord") + f"""
select order_id, datediff('day', order_date, timestamp '{INVENTORY_AT}') as days,
       datediff('hour', order_date, timestamp '{INVENTORY_AT}') as hours,
       datediff('second', order_date, timestamp '{INVENTORY_AT}') as seconds,
       year(order_date) as order_year, month(order_date) as order_month, day(order_date) as order_day,
       monthname(order_date) as month_name from ord""")
def date_functions(s):
    d, at = F.col("order_date"), instant(INVENTORY_AT)

    def boundaries(unit):
        # Unit boundaries crossed, not full units elapsed: both ends are truncated first.
        a, b = (F.date_trunc(unit, c).cast("timestamp_ntz") for c in (d, at))
        return F.timestamp_diff(unit, a, b)

    return s.src.orders.select(
        "order_id", F.date_diff(at, d).cast("bigint").alias("days"), boundaries("HOUR").alias("hours"),
        boundaries("SECOND").alias("seconds"), F.year(d).cast("bigint").alias("order_year"),
        F.month(d).cast("bigint").alias("order_month"), F.day(d).cast("bigint").alias("order_day"),
        F.date_format(d, "MMMM").alias("month_name"))


@query("convert_functions", roles("ord") + """
select order_id, strftime(order_date, '%Y-%m-%d %H:%M:%S') as iso_text, strftime(order_date, '%d/%m/%Y') as uk_text,
       cast(order_date as date) as order_day, cast(order_id as varchar) as id_text from ord""")
def convert_functions(s):
    d = F.col("order_date")
    return s.src.orders.select(
        "order_id", F.date_format(d, "yyyy-MM-dd HH:mm:ss").alias("iso_text"),
        F.date_format(d, "dd/MM/yyyy").alias("uk_text"), d.cast("date").alias("order_day"),
        F.col("order_id").cast("string").alias("id_text"))


@query("rounding", roles("ord") + """
select order_id, cast(freight * 1.638 as decimal(24,7)) as new_target,
       cast(round(freight * 1.638, 1) as decimal(20,1)) as one_place,
       cast(round(freight * 1.638, 0) as bigint) as whole, cast(trunc(freight * 1.638) as bigint) as truncated from ord""")
def rounding(s):
    target = (F.col("freight") * F.lit("1.638").cast("decimal(4,3)")).cast("decimal(24,7)")
    return s.src.orders.select(
        "order_id", target.alias("new_target"), F.round(target, 1).cast("decimal(20,1)").alias("one_place"),
        F.round(target, 0).cast("bigint").alias("whole"), target.cast("bigint").alias("truncated"))


@query("null_functions", roles("cust", "prod") + """
select customer_id, coalesce(fax, 'no fax') as fax, coalesce(nullif(fax, phone), 'no comms') as comms,
       nullif(contact_title, 'BUILDING') as other_segment from cust""")
def null_functions(s):
    fax, phone = F.col("fax"), F.col("phone")
    return s.src.customers.select(
        "customer_id", F.ifnull(fax, F.lit("no fax")).alias("fax"),
        F.coalesce(F.nullif(fax, phone), F.lit("no comms")).alias("comms"),
        F.nullif(F.col("contact_title"), F.lit("BUILDING")).alias("other_segment"))


@query("scd_hash", roles("cust") + """
select customer_id, md5(concat_ws('|', coalesce(company_name, '~NULL~'), coalesce(fax, '~NULL~'),
       coalesce(cast(balance as varchar), '~NULL~'), coalesce(country, '~NULL~'))) as row_hash from cust""")
def scd_hash_query(s):
    return s.src.customers.select("customer_id", scd_hash("company_name", "fax", "balance", "country").alias("row_hash"))


@query("date_key", roles("ord") + """
select order_id, cast(year(order_date) * 10000 + month(order_date) * 100 + day(order_date) as int) as order_date_key,
       case when order_status = 'F' then cast(strftime(required_date, '%Y%m%d') as int) else -1 end as finished_date_key
from ord""")
def date_key_query(s):
    finished = F.when(F.col("order_status") == "F", F.col("required_date"))
    return s.src.orders.select(
        "order_id", date_key("order_date").alias("order_date_key"), date_key(finished).alias("finished_date_key"))


@query("calendar", roles("ord") + """, span as (
select date_trunc('year', min(order_date)) as a, date_trunc('year', max(order_date)) + interval 1 year - interval 1 day as b
from ord), t as (select cast(unnest(generate_series(a, b, interval 1 day)) as date) as d from span)
select cast(year(d) * 10000 + month(d) * 100 + day(d) as int) as date_key, d as full_date,
  cast(day(d) as smallint) as day_of_month, cast(isodow(d) as smallint) as day_of_week, dayname(d) as day_name,
  cast(dayofyear(d) as smallint) as day_of_year, cast(weekofyear(d) as smallint) as week_of_year,
  cast(isoyear(d) as smallint) as iso_year, cast(month(d) as smallint) as month_number, monthname(d) as month_name,
  strftime(d, '%b') as month_abbrev, last_day(d) as month_end_date, cast(year(d) * 100 + month(d) as int) as year_month,
  cast(quarter(d) as smallint) as quarter_number, 'Q' || cast(quarter(d) as varchar) as quarter_name,
  cast(year(d) as smallint) as year_number,
  cast(case when month(d) >= 4 then year(d) + 1 else year(d) end as smallint) as fiscal_year,
  cast(((month(d) - 4 + 12) % 12) // 3 + 1 as smallint) as fiscal_quarter,
  isodow(d) in (6, 7) as is_weekend, d = last_day(d) as is_last_day_of_month from t""")
def calendar_query(s):
    return calendar_covering(s.src.orders, "order_date")


@query("us_date_normalise", roles("ord") + """
select order_id, case when order_status = 'F' then strftime(order_date, '%Y-%m-%d')
  when order_status = 'O' then strftime(order_date, '%Y-%m-%d %H:%M:%S')
  else strftime(order_date, '%Y-%m-%d') || ' 00:00:00' end as order_date_text from ord""")
def us_date_normalise(s):
    # The order dates written out in the three forms a source delivers, then normalised.
    d = F.col("order_date")
    delivered = (
        F.when(F.col("order_status") == "F", F.date_format(d, "M/d/yyyy"))
        .when(F.col("order_status") == "O", F.date_format(d, "yyyy-MM-dd HH:mm:ss"))
        .otherwise(F.concat(F.date_format(d, "M/d/yyyy"), F.lit(" 00:00:00"))))
    return s.src.orders.select("order_id", normalise_us_date(delivered).alias("order_date_text"))


@query("clean_literals", roles("prod") + """
select product_id, case when category_name = 'SMALL' or category_name = 'LARGE' then null
  when category_name = 'PROMO' then 'NULL' else product_name end as cleaned from prod""")
def clean_literals(s):
    kind = F.col("category_name")
    raw = F.when(kind == "SMALL", " null ").when(kind == "LARGE", "0xFFD8").when(kind == "PROMO", "NULL").otherwise(
        F.concat(F.lit("  "), F.col("product_name"), F.lit(" ")))
    return s.src.products.select("product_id", clean_literal(raw, kind == "PROMO").alias("cleaned"))
