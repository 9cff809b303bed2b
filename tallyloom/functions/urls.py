"""URLs and HTML entities as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Scheme, authority, path, query, fragment, each with its sign.
_PARTS = r"(?s)^([A-Za-z][A-Za-z0-9+.-]*:)?(//[^/?#]*)?([^?#]*)(\?[^#]*)?(#.*)?$"
_PIECE = r"(?s)&(?:#[0-9]{1,7}|#[xX][0-9A-Fa-f]{1,6}|[a-z]+);|[^&]+|&"

# Entities read by name.
ENTITIES = {"&amp;": "&", "&lt;": "<", "&gt;": ">", "&quot;": '"', "&apos;": "'", "&nbsp;": " "}


def unescaped(text: Column) -> Column:
    """Text with its numeric entities and the named ones of ENTITIES read; others stay."""

    def read(piece: Column) -> Column:
        digits = F.regexp_extract(piece, r"^&#([xX]?[0-9A-Fa-f]+);$", 1)
        number = F.when(digits.rlike("^[xX]"), F.conv(F.substring(digits, F.lit(2), F.lit(8)), 16, 10)).otherwise(digits)
        code = number.try_cast("int")
        valid = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
        sign = F.decode(F.unhex(F.lpad(F.hex(code.cast("bigint")), 8, "0")), "UTF-32")
        named = F.create_map(*(F.lit(x) for pair in ENTITIES.items() for x in pair))
        return F.when(valid, sign).otherwise(F.coalesce(F.try_element_at(named, piece), piece))

    pieces = F.transform(F.regexp_extract_all(text, F.lit(_PIECE), F.lit(0)), read)
    return F.when(text.contains("&"), F.array_join(pieces, "")).otherwise(text)


def without_dots(path: Column) -> Column:
    """An absolute path with its . and .. segments carried out; other paths stay."""
    segments = F.split(F.substring(path, F.lit(2), F.length(path)), "/")

    def step(done: Column, x: Column) -> Column:
        shorter = F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0)))
        return F.when(x == ".", done).when(x == "..", shorter).otherwise(F.concat(done, F.array(x)))

    kept = F.aggregate(segments, F.array().cast("array<string>"), step)
    open_end = F.element_at(segments, -1).isin(".", "..")
    kept = F.when(open_end, F.concat(kept, F.array(F.lit("")))).otherwise(kept)
    return F.when(path.startswith("/"), F.concat(F.lit("/"), F.array_join(kept, "/"))).otherwise(path)


def resolved(base: Column, reference: Column) -> Column:
    """A URL reference made absolute against a base URL, by the rules of RFC 3986.

    Null if the reference is null, or if it is relative and the base null.
    """
    scheme, authority, path, query, fragment = (F.regexp_extract(reference, _PARTS, i) for i in range(1, 6))
    b_scheme, b_authority, b_path, b_query = (F.regexp_extract(base, _PARTS, i) for i in range(1, 5))
    folder = F.when((b_authority != "") & (b_path == ""), F.lit("/")).otherwise(
        F.regexp_extract(b_path, r"(?s)^(.*/)?", 1)
    )
    merged = F.when(path.startswith("/"), path).otherwise(F.concat(folder, path))
    return (
        F.when(scheme != "", F.concat(scheme, authority, without_dots(path), query, fragment))
        .when(authority != "", F.concat(b_scheme, authority, without_dots(path), query, fragment))
        .when(
            path == "",
            F.concat(b_scheme, b_authority, b_path, F.when(query != "", query).otherwise(b_query), fragment),
        )
        .otherwise(F.concat(b_scheme, b_authority, without_dots(merged), query, fragment))
    )
