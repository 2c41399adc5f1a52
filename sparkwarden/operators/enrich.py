"""Projection, filtering and enrichment of log records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows up to which a dimension (assets, rules, thresholds) is broadcast; larger ones are joined by shuffle.
BROADCAST_ROWS = 200_000

# Periods of the day as (name, first hour, hour after the last); the rest is night.
PERIODS = [("morning", 9, 12), ("noon", 12, 14), ("afternoon", 14, 18), ("evening", 18, 24)]
# Ports that are too common to report.
COMMON_PORTS = [22, 23, 80, 81, 139, 443]
# Levels as (name, least score), the highest first.
LEVELS = [("high", 80), ("medium", 70), ("low", 60)]


def bounded(dimension: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``dimension`` marked for broadcast if it has at most ``rows`` rows (at most that many are looked at)."""
    return F.broadcast(dimension) if dimension.limit(rows + 1).count() <= rows else dimension


def flag_direction(flows: DataFrame, assets: DataFrame, both_as_3: bool = False) -> DataFrame:
    """``flag_ip``: 1 where the source is an asset, 2 where only the destination is; other flows go.

    ``assets`` has ``ip``.  With ``both_as_3``, flows between two assets get 3.
    """
    known = bounded(assets.select("ip").distinct())
    a = known.select(F.col("ip").alias("srcip"), F.lit(True).alias("__s"))
    b = known.select(F.col("ip").alias("dstip"), F.lit(True).alias("__d"))
    flag = F.when(F.col("__s") & F.col("__d"), 3) if both_as_3 else F.when(F.lit(False), 0)
    flag = flag.when(F.col("__s"), 1).when(F.col("__d"), 2)
    return flows.join(a, "srcip", "left").join(b, "dstip", "left").withColumn("flag_ip", flag).where("flag_ip is not null").drop("__s", "__d")


def day_period(hour: Column) -> Column:
    out = F.when(F.lit(False), "")
    for name, first, after in PERIODS:
        out = out.when((hour >= first) & (hour < after), name)
    return out.otherwise("night")


def display_bucket(date: Column, hour: Column, hours: int = 4) -> Column:
    """The date and the first hour of its ``hours``-hour bucket."""
    return F.concat_ws(" ", date.cast("string"), (F.floor(hour / hours) * hours).cast("string"))


def clock(seconds: Column) -> Column:
    """HH:mm of seconds since midnight, modulo a day."""
    s = F.pmod(seconds, F.lit(86400))
    two = lambda x: F.lpad(F.floor(x).cast("string"), 2, "0")
    return F.concat(two(s / 3600), F.lit(":"), two(F.pmod(s, F.lit(3600)) / 60))


def window_label(seconds: Column, width: int = 300) -> Column:
    """The last complete window before a time, as ``HH:mm-HH:mm``."""
    end = F.floor(seconds / width) * width
    return F.concat(clock(end - width), F.lit("-"), clock(end))


def ten_minute_slot(hour: Column, minute: Column) -> Column:
    """``HH:m0``; 00:00 where the time is missing."""
    return F.coalesce(F.concat(F.lpad(hour.cast("string"), 2, "0"), F.lit(":"), F.floor(minute / 10).cast("string"), F.lit("0")), F.lit("00:00"))


def trace(*parts: str, sep: str = "#") -> Column:
    """Columns joined into one string; a null is empty."""
    return F.concat_ws(sep, *(F.coalesce(F.col(p).cast("string"), F.lit("")) for p in parts))


def encrypted_label(app_protocol: Column) -> Column:
    return F.when(F.lower(app_protocol) == "tls", "encrypted").otherwise("plain")


def well_known_port(src: Column, dst: Column, protocol: Column) -> Column:
    """Conversations towards a port below 1024 that is not one of the common ones, over tcp or udp."""
    return (dst <= src) & (dst < 1024) & ~dst.isin(COMMON_PORTS) & F.lower(protocol).isin("tcp", "udp")


def in_segments(flows: DataFrame, segments: DataFrame, column: str = "srcip") -> DataFrame:
    """Flows whose address lies in a listed segment (its first three octets, ``segment``)."""
    return flows.join(bounded(segments.select("segment").distinct()), F.substring_index(column, ".", 3) == F.col("segment"), "left_semi")


def private_address(ip: Column) -> Column:
    return ip.rlike(r"^(172|10)\.")


def outbound_bulk(src: Column, dst: Column, up: Column, least: int = 1 << 20) -> Column:
    return (src > 1024) & (dst < 1024) & (up > least)


def fill_from_defaults(df: DataFrame, defaults: DataFrame) -> DataFrame:
    """Nulls filled from a table of one row that has columns of the same names."""
    one = defaults.limit(1).select(*(F.col(c).alias(f"__{c}") for c in defaults.columns))
    filled = df.join(F.broadcast(one), how="cross") if one.columns else df
    return filled.select(*(F.coalesce(c, f"__{c}").alias(c) if c in defaults.columns else F.col(c) for c in df.columns))


def unpack(df: DataFrame, column: str, names: list[str], sep: str = "#") -> DataFrame:
    """A delimited string's parts as columns; parts that are missing are null."""
    parts = F.split(column, sep)
    return df.select("*", *(F.get(parts, k).alias(n) for k, n in enumerate(names)))


def file_record(name: Column) -> dict[str, Column]:
    """The fields of a file name ``ts_src_dst_sport_dport_type_proto_size``."""
    part = F.split(name, "_")
    at = lambda k: F.get(part, k)
    return {"sec": at(0).cast("long"), "srcip": at(1), "dstip": at(2), "srcport": at(3).cast("int"), "dstport": at(4).cast("int"), "kind": at(5), "protocol": at(6), "size": at(7).cast("long")}


def level(score: Column) -> Column:
    out = F.when(F.lit(False), "")
    for name, least in LEVELS:
        out = out.when(score >= least, name)
    return out.otherwise("none")
