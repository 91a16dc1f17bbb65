"""URL parsing with one pattern, so malformed input yields null instead of an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from digestry.functions.bind import let

_SHAPE = r"^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]*)([^?#]*)(?:\?([^#]*))?(?:#.*)?$"
_IPV4 = r"^[0-9]{1,3}(\.[0-9]{1,3}){3}$"


def _split_url(text: Column) -> Column:
    return F.struct(
        F.lower(F.regexp_extract(text, _SHAPE, 1)).alias("scheme"),
        F.regexp_extract(text, _SHAPE, 2).alias("authority"),
        F.regexp_extract(text, _SHAPE, 3).alias("path"),
        F.regexp_extract(text, _SHAPE, 4).alias("query"),
    )


def _split_authority(url: Column) -> Column:
    place = F.regexp_replace(url["authority"], r"^.*@", "")
    bracketed = F.regexp_extract(place, r"^\[([^\]]*)\]", 1)
    host = F.when(place.startswith("["), bracketed).otherwise(F.regexp_extract(place, r"^([^:]*)", 1))
    return F.struct(
        url["scheme"].alias("scheme"),
        url["path"].alias("path"),
        url["query"].alias("query"),
        F.regexp_extract(url["authority"], r"^(.*)@", 1).alias("userinfo"),
        F.regexp_replace(F.lower(host), r"\.+$", "").alias("host"),
        F.regexp_extract(F.regexp_replace(place, r"^\[[^\]]*\]", ""), r"^[^:]*:(.*)$", 1).alias("port_text"),
    )


def url_parts(url: Column) -> Column:
    """Scheme, host, port text, path, query and user information; empty strings when there is no match."""
    text = F.regexp_replace(F.coalesce(url, F.lit("")), r"^[\x00-\x20]+|[\x00-\x20]+$", "")
    return let(let(text, _split_url), _split_authority)


def _port(parts: Column) -> Column:
    return F.when(parts["port_text"].rlike(r"^[0-9]{1,9}$"), parts["port_text"].cast("int"))


def _bad_port(parts: Column) -> Column:
    return (parts["port_text"] != "") & F.coalesce(_port(parts) > 65535, F.lit(True))


def _has_credentials(parts: Column) -> Column:
    return ~parts["userinfo"].isin("", ":")


def _decode(part: Column) -> Column:
    return F.coalesce(F.try_url_decode(part), part)


def _encode(part: Column) -> Column:
    return F.replace(F.replace(F.url_encode(part), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def _canonical_query(query: Column) -> Column:
    pairs = F.transform(
        F.filter(F.split(query, "&"), lambda part: part != ""),
        lambda part: F.struct(
            _decode(F.substring_index(part, "=", 1)).alias("k"),
            _decode(F.regexp_extract(part, r"^[^=]*=(.*)$", 1)).alias("v"),
        ),
    )
    kept = F.filter(pairs, lambda p: ~(F.lower(p["k"]).startswith("utm_") | F.lower(p["k"]).isin("fbclid", "gclid")))
    return F.array_join(
        F.transform(F.array_sort(kept), lambda p: F.concat(_encode(p["k"]), F.lit("="), _encode(p["v"]))), "&"
    )


def _canonical(parts: Column) -> Column:
    host = F.when(F.contains(parts["host"], F.lit(":")), F.concat(F.lit("["), parts["host"], F.lit("]")))
    default_port = F.when(parts["scheme"] == "https", F.lit(443)).otherwise(F.lit(80))
    port = _port(parts)
    shown_port = F.when((port > 0) & (port != default_port), F.concat(F.lit(":"), port.cast("string")))
    path = F.when(parts["path"].isin("", "/"), F.lit("/")).otherwise(F.regexp_replace(parts["path"], "/+$", ""))
    query = let(_canonical_query(parts["query"]), lambda q: F.when(q != "", F.concat(F.lit("?"), q)).otherwise(q))
    usable = (
        parts["scheme"].isin("http", "https") & (parts["host"] != "") & ~_has_credentials(parts) & ~_bad_port(parts)
    )
    return F.when(
        usable,
        F.concat(
            parts["scheme"], F.lit("://"), F.coalesce(host, parts["host"]),
            F.coalesce(shown_port, F.lit("")), path, query,
        ),
    )


def normalize_url(url: Column) -> Column:
    """Canonical http(s) form without tracking parameters, fragment and default port; null when unusable."""
    return let(url_parts(url), _canonical)


def url_host(url: Column) -> Column:
    return url_parts(url)["host"]


def _ipv4_private(host: Column) -> Column:
    octet = F.transform(F.split(host, r"\."), lambda x: x.cast("int"))
    a, b, c = octet[0], octet[1], octet[2]
    # Address blocks that are not globally reachable.
    return (
        a.isin(0, 10, 127) | (a >= 224) | ((a == 100) & b.between(64, 127)) | ((a == 169) & (b == 254))
        | ((a == 172) & b.between(16, 31)) | ((a == 192) & (b == 168)) | ((a == 192) & (b == 0) & c.isin(0, 2))
        | ((a == 198) & b.isin(18, 19)) | ((a == 198) & (b == 51) & (c == 100)) | ((a == 203) & (b == 0) & (c == 113))
        | F.exists(octet, lambda x: x > 255)
    )


# IPv6 prefixes that are not globally reachable.
_IPV6_LOCAL = r"^(::1?$|::ffff:|64:ff9b:1:|100::|2001:db8|2001:0?2:|f[cd]|fe[89a-f]|ff)"


def public_url_reason(url: Column) -> Column:
    """Why a URL must not be read from the public network; null when it may be."""

    def reason(parts: Column) -> Column:
        host = parts["host"]
        return (
            F.when(~parts["scheme"].isin("http", "https"), F.lit("scheme"))
            .when(_has_credentials(parts) | (host == ""), F.lit("host_or_credentials"))
            .when(_bad_port(parts), F.lit("port"))
            .when(host.rlike(_IPV4), F.when(_ipv4_private(host), F.lit("non_public_address")))
            .when(F.contains(host, F.lit(":")), F.when(host.rlike(_IPV6_LOCAL), F.lit("non_public_address")))
        )

    too_long = url.isNull() | (F.length(url) > 2048)
    return F.when(too_long, F.lit("missing_or_too_long")).otherwise(let(url_parts(url), reason))
