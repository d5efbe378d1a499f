"""Identity expressions: value keys, canonical hashes, name-based UUIDs, JSON numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the RFC 4122 URL namespace.
NAMESPACE_URL = "6ba7b8119dad11d180b400c04fd430c8"

UNIT_SEPARATOR = "\u001f"


def _col(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column


def value_key(value_json: Column | str, unit: Column | str) -> Column:
    """Equality key of a typed value plus its unit.

    The JSON text keeps the type apart (``12``, ``12.0``, ``"12"`` and ``true`` all differ) and
    never holds a raw control character, so the separator cannot be forged. NULL without a value.
    """
    return F.concat(
        _col(value_json),
        F.lit(UNIT_SEPARATOR),
        F.coalesce(F.concat(F.lit("u:"), _col(unit)), F.lit("-")),
    )


def canonical_hash(*columns: str) -> Column:
    """sha256 over the JSON of the named columns in name order, nulls kept."""
    ordered = F.struct(*[F.col(name) for name in sorted(columns)])
    return F.sha2(F.to_json(ordered, {"ignoreNullFields": "false"}), 256)


def uuid5(name: Column | str, namespace: str = NAMESPACE_URL) -> Column:
    """RFC 4122 version-5 UUID of a name, from sha1 and two nibble replacements."""
    digest = F.sha1(F.concat(F.unhex(F.lit(namespace)), F.encode(_col(name), "UTF-8")))
    variant = F.substring(F.lit("89ab"), 1, 4)
    nibble = F.conv(digest.substr(17, 1), 16, 10).cast("int") % 4
    return F.concat_ws(
        "-",
        digest.substr(1, 8),
        digest.substr(9, 4),
        F.concat(F.lit("5"), digest.substr(14, 3)),
        F.concat(variant.substr(nibble + 1, F.lit(1)), digest.substr(18, 3)),
        digest.substr(21, 12),
    )


def json_number(value: Column | str) -> Column:
    """Shortest decimal text of a double without an exponent below 1e16."""
    number = _col(value)
    plain = number.cast("string")
    wide = F.regexp_replace(number.cast("decimal(38,17)").cast("string"), "0+$", "")
    wide = F.when(wide.endswith("."), F.concat(wide, F.lit("0"))).otherwise(wide)
    return F.when(plain.contains("E") & (F.abs(number) < F.lit(1e16)), wide).otherwise(plain)
