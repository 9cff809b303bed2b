"""Cell cleaners: Column in, Column out. All stay in the JVM and none raises on bad text."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

DASH = ("-",)
DASHES = ("-", "--")
CODE = "[A-Z]{3}"
NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def null_markers(c: Column, markers: Sequence[str] = DASH) -> Column:
    """Null where the cell is one of the markers."""
    return F.when(~c.isin(*markers), c)


def lower_label(c: Column, markers: Sequence[str] = DASH) -> Column:
    return F.lower(null_markers(c, markers))


def _compact(c: Column) -> Column:
    """Drop blanks and thousands separators."""
    return F.regexp_replace(c, "[ ,]", "")


def parse_int(c: Column, kind: str = "int") -> Column:
    """Whole number written with blanks or commas between groups; anything else is null."""
    return _compact(c).try_cast(kind)


def parse_float(c: Column) -> Column:
    """Number written with blanks or commas between groups; anything else is null.

    The shape test keeps out texts such as `1d` that the JVM would parse.
    """
    text = _compact(c)
    return F.when(text.rlike(NUMBER), text.try_cast("double"))


def currency_code(c: Column) -> Column:
    """First run of three letters, upper-cased; null if there is none."""
    return F.nullif(F.regexp_extract(F.upper(c), CODE, 0), F.lit(""))


def currency_amount(c: Column, strict: bool = False) -> Column:
    """Number before the currency code.

    By default one character before the code is taken as a separator, as the published figures
    were made, so `1234USD` gives 123. `strict=True` reads everything up to the code.
    """
    separator = "" if strict else "."
    text = F.regexp_extract(F.upper(c), f"(?s)^(.*?){separator}{CODE}", 1)
    return parse_float(text)


def digits_only(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]+", "")


def strip_newlines(c: Column, by: str = "") -> Column:
    return F.regexp_replace(c, "[\n\r]", by)


def title_entity(c: Column, lead: int = 3, trail: int = 1) -> Column:
    """Words of a title between `lead` leading and `trail` trailing ones."""
    words = F.split(c, " ")
    kept = F.greatest(F.size(words) - lead - trail, F.lit(0))
    return F.array_join(F.slice(words, F.lit(lead + 1), kept), " ")


def list_cell(c: Column) -> Column:
    """Array from a list-valued cell such as `['a', 'b c']`: brackets and quotes removed."""
    bare = F.regexp_replace(c, r"[\[\]'\"]", "")
    return F.filter(F.transform(F.split(bare, ","), lambda item: F.trim(item)), lambda item: item != "")


def _squeeze(text: str) -> str:
    return " ".join(text.split())


def label_code(c: Column, codes: Mapping[str, object], markers: Sequence[str] = DASH) -> Column:
    """Code for a free-text label.

    Runs of blanks and newlines count as one blank. Text that is already a code passes through;
    markers and unseen labels give null (see `shaping.unmapped_labels` for a report of the latter).
    """
    table = {_squeeze(label): code for label, code in codes.items()}
    if all(isinstance(code, str) for code in codes.values()):
        table.update({code: code for code in codes.values()})
    literal = F.create_map(*[F.lit(x) for pair in table.items() for x in pair])
    text = F.trim(F.regexp_replace(null_markers(c, markers), r"\s+", " "))
    return F.try_element_at(literal, text)


def is_present(c: Column) -> Column:
    """1 if not null, else 0."""
    return c.isNotNull().cast("int")
