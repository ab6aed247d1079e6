"""Address parsing as a browser does it (browser profile).

Follows the URL Standard for schemes, authority, host name and port. Not done
(documented in the README): IDNA conversion and percent-decoding of hosts,
path normalisation, and rewriting of unusual IPv4 spellings: hosts that end in a
decimal number are invalid unless they are four decimal octets; hexadecimal ones
stay names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from urlwarden.functions.text import is_ascii, sealed
from urlwarden.functions.urlparts import IPV6, after, without_line_breaks

# Default ports of the schemes with special host rules.
DEFAULT_PORTS = {"http": 80, "https": 443, "ws": 80, "wss": 443, "ftp": 21}

PARTS = ("scheme", "host", "port", "path", "query", "fragment")
SCHEME = r"\A([A-Za-z][A-Za-z0-9+.\-]*):"
OUTER_BLANKS = r"\A[\x00-\x20]+|[\x00-\x20]+\z"
FORBIDDEN_IN_DOMAIN = r"[\x00-\x20#/:<>?@\[\\\]^|%\x7f]"
FORBIDDEN_IN_OPAQUE_HOST = r"[\x00\t\n\r #/:<>?@\[\\\]^|]"
LAST_LABEL_NUMERIC = r"(?:\A|\.)[0-9]+\.?\z"
OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})"
IPV4 = rf"\A(?:{OCTET}\.){{3}}{OCTET}\.?\z"
ASTRAL = r"[\x{10000}-\x{10FFFF}]+"


def utf16_length(text: Column) -> Column:
    """Length in UTF-16 code units."""
    astral = F.length(text) - F.length(F.regexp_replace(text, ASTRAL, ""))
    return F.when(is_ascii(text), F.length(text)).otherwise(F.length(text) + astral)


def utf16_entropy(text: Column, entropy) -> Column:
    """Entropy over UTF-16 code units.

    Characters outside the basic plane are first spelled as two characters,
    one per code unit, taken from a range no other character can then use.
    """
    units = F.regexp_replace(F.hex(F.encode(text, "UTF-16BE")), "(.{4})", "0000$1")
    units = F.regexp_replace(units, r"\G((?:.{8})*?)0000(D[89A-F]..)", "$10001$2")
    spelled = F.decode(F.unhex(units), "UTF-32")
    return entropy(F.when(~is_ascii(text) & text.rlike(ASTRAL), spelled).otherwise(text))


def with_browser_parts(
    df: DataFrame, url_col: str = "url", prefix: str = "", assume_http: bool = True, only: tuple[str, ...] = PARTS
) -> DataFrame:
    """Add ``scheme host port path query fragment``, or ``only`` some of them; all
    null when invalid.

    ``assume_http`` puts ``http://`` before addresses that do not start with
    ``http``. Query and fragment keep their ``?`` and ``#``; ``port`` is -1
    when absent or the default of its scheme.
    """
    def tmp(name: str) -> str:
        return f"__{prefix}{name}"

    def c(name: str) -> Column:
        return F.col(tmp(name))

    kept = [F.col(f"`{name}`") for name in df.columns]
    url = F.nullif(F.col(url_col), F.lit(""))
    if assume_http:
        url = F.when(F.startswith(url, F.lit("http")), url).otherwise(F.concat(F.lit("http://"), url))
    df = df.withColumn(tmp("full"), without_line_breaks(F.regexp_replace(url, OUTER_BLANKS, "")))
    df = df.withColumn(tmp("scheme"), F.lower(F.regexp_extract(c("full"), SCHEME, 1)))
    df = df.withColumn(tmp("rest"), F.substring(c("full"), F.length(c("scheme")) + 2, F.length(c("full"))))
    df = df.withColumn(tmp("nofrag"), F.substring_index(c("rest"), "#", 1))
    df = df.withColumn(tmp("noquery"), F.substring_index(c("nofrag"), "?", 1))
    special = c("scheme").isin(*DEFAULT_PORTS)
    slashed = F.replace(c("noquery"), F.lit("\\"), F.lit("/"))
    df = df.withColumn(tmp("body"), F.when(special | (c("scheme") == "file"), slashed).otherwise(c("noquery")))
    has_authority = F.startswith(c("body"), F.lit("//"))
    df = df.withColumn(
        tmp("hier"),
        F.when(special, F.ltrim(c("body"), F.lit("/")))
        .when(has_authority, F.substring(c("body"), F.lit(3), F.length(c("body")))),
    )
    df = df.withColumn(tmp("authority"), F.substring_index(c("hier"), "/", 1))
    df = df.withColumn(tmp("hostport"), F.coalesce(F.substring_index(c("authority"), "@", -1), F.lit("")))
    bracketed = F.startswith(c("hostport"), F.lit("["))
    df = df.withColumn(
        tmp("host"),
        F.when(bracketed & F.contains(c("hostport"), F.lit("]")),
               F.concat(F.substring_index(c("hostport"), "]", 1), F.lit("]")))
        .otherwise(F.substring_index(c("hostport"), ":", 1)),
    )
    df = df.withColumn(tmp("portpart"), after(c("hostport"), c("host")))
    number = F.regexp_extract(c("portpart"), r"\A:0*([0-9]{1,6})\z", 1).try_cast("int")
    df = df.withColumn(tmp("portnum"), F.when(c("portpart").isin("", ":"), -1).otherwise(F.coalesce(number, F.lit(-2))))
    host_ok = (
        F.when(bracketed, c("host").rlike(rf"\A\[{IPV6}\]\z"))
        .when(special, (c("host") != "") & ~c("host").rlike(FORBIDDEN_IN_DOMAIN))
        .otherwise(~c("host").rlike(FORBIDDEN_IN_OPAQUE_HOST))
    )
    # A host whose last label is a number is an IPv4 address or nothing.
    numeric = special & ~bracketed & c("host").rlike(LAST_LABEL_NUMERIC) & ~c("host").rlike(IPV4)
    df = df.withColumn(
        tmp("ok"),
        (c("scheme") != "") & c("portnum").between(-1, 65535) & host_ok & ~numeric,
    )

    def when_ok(value: Column) -> Column:
        return F.when(c("ok"), value)

    default_port = F.lit(False)
    for scheme, port in DEFAULT_PORTS.items():
        default_port = default_port | ((c("scheme") == scheme) & (c("portnum") == port))
    path = F.when(c("hier").isNull(), c("body")).otherwise(after(c("hier"), c("authority")))
    query, fragment = after(c("nofrag"), c("noquery"), 1), after(c("rest"), c("nofrag"), 1)
    values = {
        "scheme": when_ok(c("scheme")),
        "host": when_ok(F.when(special | (c("scheme") == "file"), F.lower(c("host"))).otherwise(c("host"))),
        "port": when_ok(F.when(default_port, -1).otherwise(c("portnum")).cast("bigint")),
        "path": when_ok(F.when((path == "") & special, "/").otherwise(path)),
        "query": when_ok(F.when(query != "", F.concat(F.lit("?"), query)).otherwise("")),
        "fragment": when_ok(F.when(fragment != "", F.concat(F.lit("#"), fragment)).otherwise("")),
    }
    # What is not asked for is not in the sealed row, so it is never worked out.
    return sealed(df, kept, {prefix + name: values[name] for name in only})
