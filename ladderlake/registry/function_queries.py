"""Scalar functions the plans are made of, over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ladderlake.functions.columns import week_start
from ladderlake.registry import register
from ladderlake.registry.stand_ins import table

_INITCAP = (
    "array_to_string(list_transform(string_split(p_name, ' '), "
    "lambda w: upper(w[1]) || lower(w[2:])), ' ')"
)


@register(
    "fn_string",
    f"""SELECT p_partkey, split_part(p_brand, '#', 2) AS brand_no, {_INITCAP} AS title,
 concat_ws('~', p_brand, p_type) AS joined, md5(p_name) AS hashed,
 p_brand || '.' || p_type AS context FROM part""",
)
def fn_string(spark, sf):
    return table(spark, sf, "part").select(
        "p_partkey",
        F.get(F.split("p_brand", "#"), F.lit(1)).alias("brand_no"),
        F.initcap("p_name").alias("title"),
        F.concat_ws("~", "p_brand", "p_type").alias("joined"),
        F.md5("p_name").alias("hashed"),
        F.expr("p_brand || '.' || p_type").alias("context"),
    )


@register(
    "fn_date",
    """SELECT event_id, CAST(ts AS DATE) AS day, strftime(ts, '%Y%m%d') AS day_text,
 CAST(date_trunc('week', ts) AS DATE) AS week_of, date_trunc('second', ts) AS at_second,
 true AS after_event FROM events""",
)
def fn_date(spark, sf):
    seconds = F.unix_timestamp(F.col("ts").cast("timestamp"))
    return table(spark, sf, "events").select(
        "event_id",
        F.to_date("ts").alias("day"),
        F.date_format("ts", "yyyyMMdd").alias("day_text"),
        week_start("ts").alias("week_of"),
        F.timestamp_seconds(seconds).cast("timestamp_ntz").alias("at_second"),
        (F.current_date() > F.to_date("ts")).alias("after_event"),
    )


@register(
    "fn_date_parts",
    """SELECT o_orderkey, CAST(extract(year FROM o_orderdate) AS INTEGER) AS y,
 CAST(extract(month FROM o_orderdate) AS INTEGER) AS m,
 CAST(extract(day FROM o_orderdate) AS INTEGER) AS d,
 CAST(extract(isodow FROM o_orderdate) - 1 AS INTEGER) AS day_of_week,
 extract(isodow FROM o_orderdate) >= 6 AS is_weekend,
 CAST(o_orderdate AS DATE) + 6 AS plus_six, CAST(o_orderdate AS DATE) - 7 AS minus_seven,
 strftime(o_orderdate, '%Y-%m-%d') AS label FROM orders""",
)
def fn_date_parts(spark, sf):
    day = F.to_date("o_orderdate")
    return table(spark, sf, "orders").select(
        "o_orderkey",
        F.year(day).alias("y"),
        F.month(day).alias("m"),
        F.dayofmonth(day).alias("d"),
        F.weekday(day).alias("day_of_week"),
        F.weekday(day).isin(5, 6).alias("is_weekend"),
        F.date_add(day, 6).alias("plus_six"),
        F.date_sub(day, 7).alias("minus_seven"),
        F.date_format(day, "yyyy-MM-dd").alias("label"),
    )


@register(
    "fn_datetime_parse",
    """SELECT event_id, date_trunc('second', ts) AS parsed_at, CAST(ts AS DATE) AS parsed_day,
 strftime(ts, '%Y-%m-%d, %I:%M %p') AS shown FROM events""",
)
def fn_datetime_parse(spark, sf):
    """Text of instants and days, parsed back."""
    instant = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    day = F.date_format("ts", "yyyy-MM-dd")
    return table(spark, sf, "events").select(
        "event_id",
        F.to_timestamp_ntz(instant, F.lit("yyyy-MM-dd HH:mm:ss")).alias("parsed_at"),
        F.to_date(day, "yyyy-MM-dd").alias("parsed_day"),
        F.date_format("ts", "yyyy-MM-dd, hh:mm a").alias("shown"),
    )


@register(
    "fn_math",
    """SELECT p_partkey, p_size / 7 AS ratio, round(p_size / 7 * 100, 2) AS pct,
 p_size + 1 AS plus, CASE WHEN p_size = 10 THEN NULL ELSE 100 / (p_size - 10) END AS guarded
FROM part""",
)
def fn_math(spark, sf):
    size = F.col("p_size")
    return table(spark, sf, "part").select(
        "p_partkey",
        (size / 7).alias("ratio"),
        F.round(size / 7 * 100, 2).alias("pct"),
        (size + 1).alias("plus"),
        F.try_divide(F.lit(100), size - 10).alias("guarded"),
    )


@register(
    "fn_conditional",
    """SELECT l_orderkey, l_linenumber, CASE l_returnflag WHEN 'R' THEN 'won'
  WHEN 'A' THEN 'lost' ELSE 'open' END AS result,
 coalesce(CASE WHEN l_linenumber < 7 THEN l_suppkey END, -1) AS profile_id FROM lineitem""",
)
def fn_conditional(spark, sf):
    flag = F.col("l_returnflag")
    return table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.when(flag == "R", "won").when(flag == "A", "lost").otherwise("open").alias("result"),
        F.coalesce(F.when(F.col("l_linenumber") < 7, F.col("l_suppkey")), F.lit(-1)).alias(
            "profile_id"
        ),
    )


@register(
    "fn_cast",
    """SELECT event_id, CAST(user_id AS VARCHAR) AS as_text, CAST(trunc(value) AS INTEGER) AS as_int,
 CAST(CAST(floor(value) / 8 AS DECIMAL(38,2)) AS DOUBLE) AS as_decimal, CAST(ts AS DATE) AS as_date,
 CAST(CAST(ts AS DATE) AS TIMESTAMP) AS as_timestamp, user_id % 3 <> 0 AS as_bool,
 coalesce(TRY_CAST(CASE WHEN event_type = 'view' THEN event_type
  ELSE CAST(user_id AS VARCHAR) END AS INTEGER), -1) AS tried FROM events""",
)
def fn_cast(spark, sf):
    user = F.col("user_id")
    mixed = F.when(F.col("event_type") == "view", F.col("event_type")).otherwise(
        user.cast("string")
    )
    return table(spark, sf, "events").select(
        "event_id",
        user.cast("string").alias("as_text"),
        F.col("value").cast("int").alias("as_int"),
        (F.floor("value") / 8).cast("decimal(38,2)").cast("double").alias("as_decimal"),
        F.col("ts").cast("date").alias("as_date"),
        F.col("ts").cast("date").cast("timestamp_ntz").alias("as_timestamp"),
        (user % 3).cast("boolean").alias("as_bool"),
        F.coalesce(mixed.try_cast("int"), F.lit(-1)).alias("tried"),
    )


@register(
    "fn_bool",
    """SELECT p_partkey, p_size = 10 AS eq, p_size <> 10 AS ne, p_size < 10 AS lt, p_size <= 10 AS le,
 p_size > 10 AS gt, p_size >= 10 AS ge, p_size > 5 AND p_type = 'SMALL' AS both_hold,
 p_size > 40 OR p_type = 'SMALL' AS either_holds, p_brand IN ('Brand#2', 'Brand#4') AS chosen
FROM part""",
)
def fn_bool(spark, sf):
    size, small = F.col("p_size"), F.col("p_type") == "SMALL"
    return table(spark, sf, "part").select(
        "p_partkey",
        (size == 10).alias("eq"),
        (size != 10).alias("ne"),
        (size < 10).alias("lt"),
        (size <= 10).alias("le"),
        (size > 10).alias("gt"),
        (size >= 10).alias("ge"),
        ((size > 5) & small).alias("both_hold"),
        ((size > 40) | small).alias("either_holds"),
        F.col("p_brand").isin("Brand#2", "Brand#4").alias("chosen"),
    )


@register(
    "fn_context",
    """SELECT 'orders.parquet' AS file_name, true AS has_catalog, true AS has_schema,
 true AS has_time, count(*) AS n FROM orders""",
)
def fn_context(spark, sf):
    """Where a row comes from and which context it is read in."""
    return (
        table(spark, sf, "orders")
        .select(
            F.col("_metadata.file_name").alias("file_name"),
            F.current_catalog().isNotNull().alias("has_catalog"),
            F.current_database().isNotNull().alias("has_schema"),
            F.current_timestamp().isNotNull().alias("has_time"),
        )
        .groupBy("file_name", "has_catalog", "has_schema", "has_time")
        .agg(F.count(F.lit(1)).alias("n"))
    )
