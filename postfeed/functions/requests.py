"""Request-log fields: client address, user agent, geo, CORS headers, the nested record."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from postfeed.functions.keys import _col
from postfeed.functions.text import strip

# Response headers the record keeps.
CORS_HEADERS = [
    "access-control-allow-origin",
    "access-control-allow-credentials",
    "access-control-allow-headers",
    "access-control-allow-methods",
]

# Addresses that are not looked up. The second part of a 172 address counts as a
# whole number from 16 to 31, so a sign, leading zeros and spaces do not matter.
PRIVATE_IP = r"^(?:\z|127\.|::1\z|10\.|192\.168\.|172\.\s*\+?0*(?:1[6-9]|2[0-9]|3[01])\s*(?:\.|\z))"

# The provider's geo fields and the names the record gives them.
GEO_FIELDS = {
    "region_iso_code": "region_code",
    "continent_name": "continent",
    "city_name": "city",
    "country_iso_code": "country_code",
    "country_name": "country",
    "region_name": "region",
}


def _text(value: Column | str) -> Column:
    return F.nullif(_col(value), F.lit(""))


def client_ip(forwarded_for: Column | str, real_ip: Column | str, peer: Column | str) -> Column:
    """First forwarded address, which may be '' for a list that starts with a comma; else real IP, else peer."""
    first = strip(F.split_part(_col(forwarded_for), F.lit(","), F.lit(1)))
    return F.when(_text(forwarded_for).isNotNull(), first).otherwise(F.coalesce(_text(real_ip), _col(peer)))


def is_private_ip(ip: Column | str) -> Column:
    """Loopback and private ranges, and no address at all."""
    return F.coalesce(_col(ip).rlike(PRIVATE_IP), F.lit(True))


def parse_user_agent(user_agent: Column | str) -> Column:
    """Browser, version, system and device by substring rules; NULL for a blank user agent."""
    ua = _text(user_agent)
    chrome, safari, firefox = (ua.contains(f"{b}/") for b in ("Chrome", "Safari", "Firefox"))
    after = lambda browser: F.split_part(ua, F.lit(f"{browser}/"), F.lit(2))
    name = F.when(chrome & safari, "Chrome").when(safari, "Safari").when(firefox, "Firefox").otherwise("Unknown")
    version = F.when(chrome & safari, F.split_part(after("Chrome"), F.lit(" "), F.lit(1))).when(
        ~safari & firefox, after("Firefox")
    )
    system = F.when(ua.contains("Mac OS X"), "Mac OS X").when(ua.contains("Windows"), "Windows").when(
        ua.contains("Linux"), "Linux"
    )
    device = F.when(ua.contains("Macintosh"), "Mac").when(ua.contains("Windows"), "PC")
    return F.when(
        ua.isNotNull(),
        F.struct(
            ua.alias("original"),
            name.alias("name"),
            _text(version).alias("version"),
            F.when(system.isNotNull(), F.struct(system.alias("name"))).alias("os"),
            F.when(device.isNotNull(), F.struct(device.alias("name"))).alias("device"),
        ),
    )


def duration_ms(started_ns: Column | str, ended_ns: Column | str) -> Column:
    """Whole milliseconds, cut towards zero."""
    return F.call_function("div", _col(ended_ns) - _col(started_ns), F.lit(1_000_000))


def cors_headers(headers: Column | str) -> Column:
    """The four CORS headers of a header map, whatever their case; the last spelling wins."""
    entries = F.map_entries(_col(headers))

    def value(name: str) -> Column:
        same = F.filter(entries, lambda e: F.lower(e["key"]) == name)
        return F.try_element_at(same, F.lit(-1))["value"]

    return F.struct(*[value(h).alias(h.replace("-", "_")) for h in CORS_HEADERS])


def geo_struct() -> Column:
    """The geo block of a dimension row; NULL for a failed lookup.

    An unset ``success`` counts as success. ``location`` needs both coordinates.
    """
    lat, lon = F.col("latitude"), F.col("longitude")
    location = F.when(lat.isNotNull() & lon.isNotNull(), F.struct(lon.alias("lon"), lat.alias("lat")))
    named = [F.col(source).alias(name) for name, source in GEO_FIELDS.items()]
    return F.when(F.coalesce(F.col("success"), F.lit(True)), F.struct(*named, location.alias("location")))


def authorization_field(value: Column | str, mask: bool = True) -> Column:
    """The authorization header, NULL if blank; a SHA-256 digest unless ``mask`` is off."""
    text = _text(value)
    return F.sha2(text, 256) if mask else text


def log_record(mask: bool = True) -> Column:
    """The nested record, for a request row with ``client_ip`` and ``geo`` already attached."""
    cors = cors_headers("response_headers")
    request = F.struct(
        authorization_field("authorization", mask).alias("authorization"),
        F.col("method"),
        F.col("origin"),
        F.struct(
            F.col("url_path").alias("path"),
            F.col("url_path").alias("original"),
            F.col("url_scheme").alias("scheme"),
            F.col("url_domain").alias("domain"),
        ).alias("url"),
        parse_user_agent("user_agent").alias("user_agent"),
    )
    response = F.struct(
        F.col("status_code"),
        duration_ms("started_ns", "ended_ns").alias("time"),
        *[cors[h.replace("-", "_")].alias(h.replace("-", "_")) for h in CORS_HEADERS],
    )
    destination = F.struct(F.col("client_ip").alias("ip"), F.col("geo"))
    return F.struct(request.alias("request"), response.alias("response"), destination.alias("destination"))


def _members(*fields: Column, keep_nulls: bool = False) -> Column:
    """The fields as JSON members, without the braces around them."""
    options = {"ignoreNullFields": "false"} if keep_nulls else {}
    return F.regexp_replace(F.to_json(F.struct(*fields), options), r"^\{|\}$", "")


def _object(*members: Column) -> Column:
    """A JSON object of member texts; NULL texts are left out."""
    return F.concat(F.lit("{"), F.concat_ws(",", *members), F.lit("}"))


def _when_present(value: Column, members: Column) -> Column:
    return F.when(value.isNotNull(), members)


def log_json(record: Column, level: Column, logger: Column, time_ms: Column) -> Column:
    """The record as one JSON line.

    ``origin``, the URL parts, ``ip`` and the geo names stay as null; ``authorization``, CORS
    headers, geo, its location and the user-agent parts are left out when absent, and a blank
    user agent is ``{}``.
    """
    req, res, dest = record["request"], record["response"], record["destination"]
    auth, geo = req["authorization"], dest["geo"]
    request = _object(
        _when_present(auth, _members(auth.alias("authorization"))),
        _members(*[req[name].alias(name) for name in ("method", "origin", "url")], keep_nulls=True),
        F.concat(F.lit('"user_agent":'), F.coalesce(F.to_json(req["user_agent"]), F.lit("{}"))),
    )
    response = F.to_json(
        F.struct(
            res["status_code"].alias("status_code"),
            res["time"].alias("time"),
            *[res[h.replace("-", "_")].alias(h) for h in CORS_HEADERS],
        )
    )
    place = geo["location"]
    geo_text = _object(
        _members(*[geo[name].alias(name) for name in GEO_FIELDS], keep_nulls=True),
        _when_present(place, _members(place.alias("location"))),
    )
    destination = _object(
        _members(dest["ip"].alias("ip"), keep_nulls=True),
        _when_present(geo, F.concat(F.lit('"geo":'), geo_text)),
    )
    return _object(
        _members(level.alias("level"), logger.alias("logger"), time_ms.alias("time")),
        F.concat(F.lit('"request":'), request),
        F.concat(F.lit('"response":'), response),
        F.concat(F.lit('"destination":'), destination),
    )
