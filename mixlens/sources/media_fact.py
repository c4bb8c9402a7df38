"""The media fact table (A1).

``read_media`` loads a real export (Parquet or CSV), renames spreadsheet headers to snake_case
and casts to the declared types; ``rejects`` counts the values that do not fit. ``media_from_tpch`` derives the same schema from the driver's TPC-H-style
tables: one media row per line item, with structural NULLs, untrimmed text, a case typo,
credits and a weekly KPI copied onto rows at integer multiples.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.exprs import parse_mixed_date, trim_ws
from ..functions.joins import stored
from ..spec import DEFAULT_SPEC, DIMENSIONS, METRICS, SOURCE_RENAME, TARGET

MONEY = "decimal(18,2)"
EPOCH = "1995-01-01"  # a Sunday: week numbers count aligned weeks from here


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# The declared types of a media fact: text dimensions, a date, exact money, other metrics as numbers.
MEDIA_SCHEMA = T.StructType(
    [T.StructField(DEFAULT_SPEC.date_col, T.DateType())]
    + [T.StructField(c, T.StringType()) for c in DIMENSIONS]
    + [T.StructField(c, T.DecimalType(18, 4) if c in (DEFAULT_SPEC.spend_col, TARGET) else T.DoubleType()) for c in METRICS])


def read_media(spark: SparkSession, path: str, fmt: str = "parquet", schema=MEDIA_SCHEMA,
               rename: dict | None = None, **options) -> DataFrame:
    """Read an exported media table, apply the header rename map and the declared types.

    Files are read as they are (a CSV as text) and cast afterwards, so a value that does not fit its
    type becomes NULL and can be counted by ``rejects`` on the ``untyped`` table. ``schema=None``
    leaves the types as read.
    """
    df = untyped(spark, path, fmt, rename, **options)
    return df if schema is None else typed(df, schema)


def untyped(spark: SparkSession, path: str, fmt: str = "parquet", rename: dict | None = None, **options) -> DataFrame:
    """The exported table as stored, with snake_case names."""
    df = spark.read.format(fmt).options(**options).load(path)
    rename = SOURCE_RENAME if rename is None else rename
    return df.withColumnsRenamed({k: v for k, v in rename.items() if k in df.columns})


def _as(df: DataFrame, field: T.StructField) -> Column:
    """A column in its declared type: dates in any known format, numbers without white space; NULL where it does not fit.
    Numbers that are numbers already keep their type."""
    have, c = df.schema[field.name].dataType, F.col(f"`{field.name}`")
    if isinstance(field.dataType, T.DateType):
        return parse_mixed_date(c, have)
    if isinstance(field.dataType, T.NumericType):
        return trim_ws(c).try_cast(field.dataType) if isinstance(have, T.StringType) else c
    return c.cast(field.dataType)


def typed(df: DataFrame, schema: T.StructType = MEDIA_SCHEMA) -> DataFrame:
    """``df`` with the declared columns it has cast; absent ones stay absent, others as they are."""
    return df.withColumns({f.name: _as(df, f) for f in schema.fields if f.name in df.columns})


def rejects(df: DataFrame, schema: T.StructType = MEDIA_SCHEMA) -> DataFrame:
    """column, bad_values: values that are not blank but do not fit the declared type, in one pass."""
    fields = [f for f in schema.fields if f.name in df.columns and not isinstance(f.dataType, T.StringType)]
    bad = [F.count_if((trim_ws(F.col(f"`{f.name}`").cast("string")) != "") & _as(df, f).isNull()).alias(f.name) for f in fields]
    row = df.agg(F.count("*").alias("_n"), *bad)
    entries = [F.struct(F.lit(f.name).alias("column"), F.col(f"`{f.name}`").alias("bad_values")) for f in fields]
    return row.select(F.inline(F.array(*entries))).where("bad_values > 0") if entries else \
        row.select(F.lit("").alias("column"), F.col("_n").alias("bad_values")).limit(0)


def _week_index(ship_date: Column) -> Column:
    return F.ceil(F.datediff(ship_date, F.lit(EPOCH).cast("date")) / F.lit(7.0)).cast("int")


def media_from_tpch(spark: SparkSession, sf_dir: str, with_copies: bool = False,
                    keep_line: bool = False) -> DataFrame:
    """Build the media fact from lineitem and its dimensions.

    Only the columns used are read (ReadSchema pruning). nation/region are fixed-size
    TPC-H dimensions (25 and 5 rows), so they are broadcast into supplier, and the result is stored,
    for the size of a join is not known beforehand. The other joins are left to the planner, which
    broadcasts a side only under its size threshold and otherwise shuffles both sides on the key.

    ``with_copies`` appends exact copies of the line-number-2 rows, the only way to get
    full-row duplicates out of these tables (used by the de-duplication views).
    """
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_returnflag", "l_linestatus", "l_shipdate")
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus",
                                                         "o_orderpriority")
    cust = read_table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_name")
    supp = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")

    # what hangs on an order, a supplier or a part alone is worked out there: the keys and columns it is made
    # from do not travel with the line items through the shuffles that follow
    ok, ck, sk, pk = F.col("o_orderkey"), F.col("c_custkey"), F.col("s_suppkey"), F.col("p_partkey")
    segment = F.col("c_mktsegment")
    oc = orders.join(cust, orders.o_custkey == cust.c_custkey).select(
        "o_orderkey",
        F.when(ck % 5 == 0, None).otherwise(segment).alias("platform_type"),
        F.when(F.col("o_orderstatus") == "P", None).otherwise(F.col("o_orderpriority")).alias("partner_type"),
        F.when(ok % 5 < 3, None).otherwise(segment).alias("audience"))
    geo = nation.join(F.broadcast(region), nation.n_regionkey == region.r_regionkey)
    supp = stored(supp.join(F.broadcast(geo), supp.s_nationkey == geo.n_nationkey).select(
        "s_suppkey", F.col("r_name").alias("tab"), F.col("n_name").alias("channel"),
        F.when(sk % 7 == 0, None).otherwise(F.col("s_name")).alias("site"),
        (sk % 20).cast("bigint").alias("engagements"), (sk % 5 == 0).alias("_no_kpi")))
    part = part.select("p_partkey", F.col("p_type").alias("media_type"),
                       F.when(pk % 13 == 0, None).otherwise(F.col("p_name")).alias("creative"))

    # the widest columns, the part's, come last and are not shuffled again
    j = (li.join(oc, li.l_orderkey == oc.o_orderkey).drop("l_orderkey", "o_orderkey")
           .join(supp, li.l_suppkey == supp.s_suppkey).drop("l_suppkey", "s_suppkey")
           .join(part, li.l_partkey == part.p_partkey))

    ship = F.col("l_shipdate").cast("date")
    wk = _week_index(ship)
    price = F.col("l_extendedprice").cast(MONEY)
    lnum, rflag, lstat = F.col("l_linenumber"), F.col("l_returnflag"), F.col("l_linestatus")
    qty = F.col("l_quantity")

    fact = j.select(
        ship.alias("activity_date"),
        "tab", "media_type", "channel",
        F.when(rflag == "R", " VIdeo ").when(rflag == "A", "Video").otherwise("Display ").alias("sub_channel"),
        "site",
        F.when(pk % 3 == 0, None).otherwise(lstat).alias("device"),
        "platform_type", "partner_type", "audience", "creative",
        F.when(pk % 11 == 0, None).when(lnum == 7, -price).when(rflag == "N", F.lit(0).cast(MONEY))
         .otherwise(price).cast(MONEY).alias("spend"),
        F.when(lstat == "O", qty * 1000).cast("bigint").alias("impressions"),
        F.when(lstat == "O", pk % 50).cast("bigint").alias("clicks"),
        F.when(rflag == "R", qty * 10).otherwise(0).cast("bigint").alias("video_starts"),
        F.when(rflag == "R", qty * 4).otherwise(0).cast("bigint").alias("video_completes"),
        F.when(lnum == 1, qty).cast("bigint").alias("hh_grps_tv"),
        "engagements",
        F.when((wk >= 340) | F.col("_no_kpi"), None)
         .otherwise((F.lit(7000000) + ((wk * 7919) % 100) * 10000) * lnum).cast(MONEY).alias("base_amount"),
        lnum.alias("_lnum"),
    )
    if with_copies:
        fact = add_copies(fact)
    return fact if keep_line else fact.drop("_lnum")


def add_copies(fact: DataFrame) -> DataFrame:
    """One extra exact copy of each line-number-2 row, generated in the same pass."""
    n = F.when(F.col("_lnum") == 2, 2).otherwise(1)
    return fact.withColumn("_copy", F.explode(F.sequence(F.lit(1), n))).drop("_copy", "_lnum")
