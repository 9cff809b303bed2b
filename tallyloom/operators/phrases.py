"""Many phrases in one pass over a text, by an automaton instead of one walk per phrase or length."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Mapping, Sequence
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tallyloom.functions.text import normalise
from tallyloom.operators.shaping import col, require


@lru_cache(maxsize=4)
def _automaton(entries: tuple[tuple[str, tuple[int, ...]], ...]) -> ahocorasick.Automaton:
    """Entries between blanks, so that only whole tokens match; overlapping entries are all found."""
    found = ahocorasick.Automaton()
    for entry, lists in entries:
        found.add_word(f" {entry} ", (entry, lists))
    found.make_automaton()
    return found


def phrase_counts(
    df: DataFrame, text: str, lexicons: Mapping[str, Iterable[str]], by: Sequence[str] = (), only_own: str | None = None
) -> DataFrame:
    """Occurrences of the entries of several lists in lower-cased text without punctuation:
    (by, lexicon, entry, counts).

    An entry is a run of tokens cut at single blanks, of any length; overlapping occurrences all
    count. The lists are the driver's; each worker makes one automaton of them, and a text is walked
    once whatever their number. With `only_own`, a column, a row is matched with the list of that
    name only. Rows are counted in their task before the shuffle. Null texts have no occurrences.
    """
    require(df, [text, *by, *([only_own] if only_own else [])])
    names = sorted(lexicons)
    places: dict[str, list[int]] = {}
    for number, name in enumerate(names):
        for entry in sorted(set(lexicons[name])):
            places.setdefault(entry, []).append(number)
    entries = tuple((entry, tuple(lists)) for entry, lists in sorted(places.items()))
    number = {name: i for i, name in enumerate(names)}
    keys = [f"k{i}" for i in range(len(by))]
    plain = df.where(col(text).isNotNull()).select(
        *(col(name).alias(key) for name, key in zip(by, keys)),
        (col(only_own).cast("string") if only_own else F.lit(None).cast("string")).alias("own"),
        F.concat(F.lit(" "), normalise(col(text)), F.lit(" ")).alias("text"),
    )
    fields = [plain.schema[key] for key in keys]
    schema = StructType([*fields, *StructType.fromDDL("lexicon string, entry string, counts bigint").fields])
    types = list(to_arrow_schema(schema))
    narrow = only_own is not None

    def count(batches):
        automaton = _automaton(entries) if entries else None
        for batch in batches:
            seen = Counter()
            columns = [batch.column(i).to_pylist() for i in range(batch.num_columns)]
            for *key, own, body in zip(*columns) if automaton else ():
                wanted = number.get(own) if narrow else None
                if narrow and wanted is None:
                    continue
                for _, (entry, lists) in automaton.iter(body):
                    for place in (wanted,) if narrow and wanted in lists else () if narrow else lists:
                        seen[(*key, names[place], entry)] += 1
            rows = list(zip(*((*k, n) for k, n in seen.items()))) or [()] * len(schema)
            yield pa.RecordBatch.from_arrays(
                [pa.array(values, f.type) for values, f in zip(rows, types)], names=schema.names
            )

    found = plain.mapInArrow(count, schema)
    summed = found.groupBy(*keys, "lexicon", "entry").agg(F.sum("counts").alias("counts"))
    return summed.select(*(F.col(key).alias(name) for name, key in zip(by, keys)), "lexicon", "entry", "counts")
