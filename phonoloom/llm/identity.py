"""What an item id and an address say about the video they belong to, however they are written."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Hosts of the two platforms and their prefixes.
HOSTS = {"vidtok.example": "tt", "fbclips.example": "fb"}

_NUMBER = r"(?<![0-9])(?:[0-9]{19}|[0-9]{15})(?![0-9])"
_V_NUMBER = r"[?&]v=([0-9]{19}|[0-9]{15})(?:&|$)"


def _found(text: Column, pattern: str, group: int) -> Column:
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))


def _digits(text: Column) -> Column:
    return (F.length(text) > 0) & (F.translate(text, "0123456789", "") == "")


def with_video_keys(df: DataFrame, item_id: str = "item_id", address: str = "source_url") -> DataFrame:
    """``df`` with id_key, address_key (strings, null where nothing is said) and segment (bigint).

    A key is ``tt:<number>`` or ``fb:<number>``, or ``a:<address>`` of an address that names no number (host
    without www or m, path as written, no query, fragment or last slash). An id without prefix takes the
    platform of its address, without one it says nothing; nor does a digest. Null ids and addresses give null.
    """
    # the parts of an id: platform, number or digest, segment; split and compared, not matched by patterns,
    # since this runs over every record
    df = df.withColumn("_parts", F.split(F.lower(F.trim(F.col(item_id))), "_"))
    first = F.get("_parts", F.lit(0))
    named = first.isin(*HOSTS.values())
    df = df.withColumns({"_prefix": F.when(named, first), "_rest": F.when(named, F.slice("_parts", 2, 9)).otherwise(F.col("_parts"))})
    body, tail = F.get("_rest", F.lit(0)), F.get("_rest", F.lit(1))
    digest = (F.length(body) == 16) & (F.translate(body, "0123456789abcdef", "") == "")
    number = F.length(body).isin(15, 19) & _digits(body)
    shaped = (number | digest) & ((F.size("_rest") == 1) | ((F.size("_rest") == 2) & _digits(tail)))
    df = df.withColumns({"_number": F.when(shaped & number, body), "segment": F.when(shaped & (F.length(tail) < 19), tail.try_cast("bigint"))})
    url = F.split_part(F.trim(F.col(address)), F.lit("#"), F.lit(1))
    df = df.withColumn("_url", F.when(F.contains(url, F.lit("://")), F.expr("substring(split_part(trim(`{0}`), '#', 1), instr(split_part(trim(`{0}`), '#', 1), '://') + 3)".format(address))).otherwise(url))
    df = df.withColumn("_base", F.split_part(F.col("_url"), F.lit("?"), F.lit(1)))
    df = df.withColumns({"_host": F.lower(F.split_part(F.col("_base"), F.lit("/"), F.lit(1))), "_path": F.replace(F.regexp_replace(F.col("_base"), r"^[^/]*", ""), F.lit("%40"), F.lit("@"))})
    site = F.coalesce(*[F.when(F.col("_host").endswith(host), F.lit(prefix)) for host, prefix in HOSTS.items()])
    df = df.withColumn("_site", site)
    # digits of a handle name no video
    path = F.when(F.contains(F.col("_path"), F.lit("/@")), F.regexp_replace(F.col("_path"), "/@[^/]*", "/")).otherwise(F.col("_path"))
    number = F.coalesce(_found(path, _NUMBER, 0), F.when(F.contains(F.col("_url"), F.lit("v=")), _found(F.col("_url"), _V_NUMBER, 1)))
    df = df.withColumn("_address_number", number)
    plain = F.concat(F.lit("a:"), F.regexp_replace(F.col("_host"), r"^(www|m)\.", ""), F.regexp_replace(F.col("_path"), "/+$", ""))
    df = df.withColumns(
        {
            "id_key": F.concat_ws(":", F.coalesce(F.col("_prefix"), F.col("_site")), F.col("_number")),
            "address_key": F.when(F.col("_address_number").isNotNull(), F.concat_ws(":", F.coalesce(F.col("_site"), F.col("_host")), F.col("_address_number"))).when(F.length("_base") > 0, plain),
        }
    )
    named = F.col("_number").isNotNull() & F.coalesce(F.col("_prefix"), F.col("_site")).isNotNull()
    df = df.withColumn("id_key", F.when(named, F.col("id_key")))
    return df.drop("_parts", "_rest", "_url", "_number", "_prefix", "_base", "_host", "_path", "_site", "_address_number")
