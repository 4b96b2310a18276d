"""The driver tables seen as station readings and their side inputs.

The reference reads a CSV of hourly station readings. Those files are not
available, so this adapter derives the same shape from the driver tables:

=====================  =============================================
readings column        derived from
=====================  =============================================
reading_id             l_orderkey * 8 + l_linenumber (a line key; the
                       driver data repeats some pairs, so not unique)
Measurement date       l_shipdate as ``yyyy-MM-dd HH:mm`` text
Station code           s_suppkey as text
Address                "<suppkey>, <s_name>, <n_name>, <r_name>";
                       the district (third field) is the nation
Latitude, Longitude    s_acctbal, s_nationkey as text
SO2 NO2 O3 CO PM10     l_discount, l_tax, l_quantity, p_retailprice,
PM2.5                  l_extendedprice, o_totalprice as text
=====================  =============================================

A few cells are made dirty on purpose by fixed rules on the order key, so
that the ingest path meets malformed, missing and NaN values and short
addresses at every scale (the rules are repeated in the SQL oracle).

All joins are on keys; nation and region are broadcast because their size
is fixed (25 and 5 rows). The fact-to-fact joins are left to the planner:
it broadcasts a side only under ``spark.sql.autoBroadcastJoinThreshold``
(checked on plan and, with AQE, on runtime sizes) and sort-merges otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazeline.sources.tables import table

# Dirty-cell rules (key modulus, remainder) and what they write.
DIRT_SHORT_ADDRESS = (211, 5)   # Address -> 'short' (no district)
DIRT_BAD_SO2 = (97, 1)          # SO2 -> 'bad' (malformed number)
DIRT_NULL_NO2 = (89, 2)         # NO2 -> NULL (empty CSV cell)
DIRT_NAN_PM10 = (83, 3)         # PM10 -> 'NaN'


def _small(df: DataFrame) -> bool:
    from hazeline.operators.joins import broadcast_limit, estimated_bytes
    size, limit = estimated_bytes(df), broadcast_limit(df)
    return limit > 0 and size is not None and size <= limit


def _hit(key, rule):
    mod, rem = rule
    return (key % mod) == rem


def stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per station with its address parts (dimension only)."""
    from hazeline.operators.joins import sized_broadcast
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey", "s_acctbal")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    return (s.join(sized_broadcast(n), s.s_nationkey == n.n_nationkey)
             .join(sized_broadcast(r), n.n_regionkey == r.r_regionkey)
             .select("s_suppkey", "s_name", "s_nationkey", "s_acctbal", "n_name", "r_name"))


def raw_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings exactly as a CSV scan would give them: every column text."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
        "l_extendedprice", "l_discount", "l_tax", "l_shipdate")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_retailprice")
    st = stations(spark, sf_dir)
    # The station dimension has one row per supplier (nation and region are
    # key lookups), so its size is checked on the supplier scan: broadcast
    # under the threshold, sort-merge join beyond it.
    if _small(table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey", "s_acctbal")):
        st = F.broadcast(st)
    j = (li.join(o, li.l_orderkey == o.o_orderkey)
           .join(p, li.l_partkey == p.p_partkey)
           .join(st, li.l_suppkey == st.s_suppkey))
    k = F.col("l_orderkey")
    txt = lambda c: F.col(c).cast("string")
    address = F.concat_ws(", ", txt("s_suppkey"), F.col("s_name"), F.col("n_name"), F.col("r_name"))
    return j.select(
        (k * 8 + F.col("l_linenumber")).alias("reading_id"),
        F.date_format("l_shipdate", "yyyy-MM-dd HH:mm").alias("Measurement date"),
        txt("s_suppkey").alias("Station code"),
        F.when(_hit(k, DIRT_SHORT_ADDRESS), F.lit("short")).otherwise(address).alias("Address"),
        txt("s_acctbal").alias("Latitude"),
        F.col("s_nationkey").cast("double").cast("string").alias("Longitude"),
        F.when(_hit(k, DIRT_BAD_SO2), F.lit("bad")).otherwise(txt("l_discount")).alias("SO2"),
        F.when(_hit(k, DIRT_NULL_NO2), F.lit(None).cast("string")).otherwise(txt("l_tax")).alias("NO2"),
        txt("l_quantity").alias("O3"),
        txt("p_retailprice").alias("CO"),
        F.when(_hit(k, DIRT_NAN_PM10), F.lit("NaN")).otherwise(txt("l_extendedprice")).alias("PM10"),
        txt("o_totalprice").alias("PM2.5"),
    )


def boundaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """District boundaries as (SIG_ENG_NM, geometry): one per nation. The
    geometry is an opaque payload, as in the reference (never computed on)."""
    n = table(spark, sf_dir, "nation")
    coords = F.format_string("[[%d, %d]]", F.col("n_nationkey"), F.col("n_regionkey"))
    return n.select(F.col("n_name").alias("SIG_ENG_NM"),
                    F.struct(F.lit("Polygon").alias("type"), coords.alias("coordinates")).alias("geometry"))


def bike_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second daily series (bike rentals in the reference) from orders:
    ``Date`` as ``dd/MM/yyyy`` text, a count and two numeric columns, and the
    three text columns the reference drops before its mean."""
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.date_format("o_orderdate", "dd/MM/yyyy").alias("Date"),
        F.col("o_totalprice").alias("Rented Bike Count"),
        F.col("o_custkey").cast("double").alias("Hour"),
        F.col("o_orderkey").cast("double").alias("Temperature"),
        F.col("o_orderstatus").alias("Seasons"),
        F.col("o_orderpriority").alias("Holiday"),
        F.lit("Yes").alias("Functioning Day"),
    )


# Fixed values of the real-time snapshot documents: reported offset of the
# local clock, and the day offsets each forecast array spans (they differ
# per pollutant, and start before the poll date, as the service sends them).
SNAPSHOT_TZ = "+09:00"
FORECAST_SPANS = {"o3": (-2, 5), "pm10": (-1, 6), "pm25": (-1, 6), "uvi": (-1, 4)}


def snapshot_documents(spark: SparkSession, sf_dir: str, deal=None) -> DataFrame:
    """One real-time snapshot document per event, in the nested shape of the
    service: station ``idx`` <- user_id, revision time ``debug.sync`` <- ts,
    hour of the observation <- ts truncated to the hour (local clock), AQI
    <- floor(value), dominant pollutant <- event_type, ``iaqi`` values from
    value and props.k (integers for some keys, decimals for others), and
    four forecast arrays. ``time.v`` repeats the reference's trap: the local
    clock read as if it were UTC. Also returns ``date`` (local poll date).
    ``deal`` deals the events (with their ``date``) to tasks: a document is some
    dozens of times as large as its event, so it is the event that is moved."""
    e = table(spark, sf_dir, "events").withColumn("date", F.date_format("ts", "yyyy-MM-dd"))
    e = deal(e) if deal else e
    # props is parsed once per row; every later use reads the column.
    e = e.withColumn("k", F.from_json("props", "k INT").getField("k"))
    k = F.col("k")
    hour = F.date_trunc("hour", F.col("ts"))
    iaqi = {
        "co": F.col("value") / 100.0, "h": None, "no2": k.cast("double"),
        "o3": None, "p": None, "pm10": k.cast("double"), "pm25": F.col("value"),
        "r": None, "so2": None, "t": F.hour("ts").cast("double"), "w": None}
    day0 = F.to_date("ts")

    def forecast(name):
        # The day offsets are fixed per pollutant: a literal array of
        # structs (no lambda, so it stays in generated code).
        lo, hi = FORECAST_SPANS[name]
        return F.array(*[F.struct(
            (k + i).alias("avg"), F.date_format(F.date_add(day0, i), "yyyy-MM-dd").alias("day"),
            (k + i + 2).alias("max"), (k + i - 2).alias("min")) for i in range(lo, hi)])

    epoch_as_utc = (F.unix_date(day0).cast("bigint") * 86400 + F.hour("ts").cast("bigint") * 3600)
    data = F.struct(
        F.floor("value").cast("int").alias("aqi"),
        F.col("user_id").cast("int").alias("idx"),
        F.col("event_type").alias("dominentpol"),
        F.array(F.struct(F.format_string("station/%d", "user_id").alias("url"),
                         F.format_string("Station %d", "user_id").alias("name"),
                         F.lit(None).cast("string").alias("logo"))).alias("attributions"),
        F.struct(F.array(F.lit(37.5), F.lit(127.0)).alias("geo"),
                 F.format_string("Station %d", "user_id").alias("name"),
                 F.format_string("station/%d", "user_id").alias("url"),
                 F.lit("").alias("location")).alias("city"),
        F.struct(*[F.struct((v if v is not None else F.lit(None).cast("double")).alias("v")).alias(n)
                   for n, v in iaqi.items()]).alias("iaqi"),
        F.struct(F.date_format(hour, "yyyy-MM-dd HH:mm:ss").alias("s"),
                 F.lit(SNAPSHOT_TZ).alias("tz"), epoch_as_utc.alias("v"),
                 F.concat(F.date_format(hour, "yyyy-MM-dd'T'HH:mm:ss"), F.lit(SNAPSHOT_TZ)).alias("iso")
                 ).alias("time"),
        F.struct(F.struct(*[forecast(n).alias(n) for n in FORECAST_SPANS]).alias("daily")).alias("forecast"),
        F.struct(F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"),
                          F.lit(SNAPSHOT_TZ)).alias("sync")).alias("debug"),
    )
    return e.select(F.lit("ok").alias("status"), data.alias("data"), "date")


def invoice_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Invoice lines (the reference's Latin-1 ``data.csv``) from lineitem and
    part: the description carries accented letters by a fixed mapping."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey",
                                                 "l_quantity", "l_extendedprice", "l_shipdate")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    j = li.join(p, li.l_partkey == p.p_partkey)
    return j.select(
        F.col("l_orderkey").alias("InvoiceNo"),
        F.col("l_linenumber").alias("LineNo"),
        F.translate("p_name", "aeiou", "áéíóú").alias("Description"),
        F.col("l_quantity").cast("int").alias("Quantity"),
        F.date_format("l_shipdate", "MM/dd/yyyy HH:mm").alias("InvoiceDate"),
        F.col("l_extendedprice").alias("Amount"),
    )
