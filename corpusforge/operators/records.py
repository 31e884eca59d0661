"""Records of varying keys, held as JSON text, to text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusforge.functions.text import TEXT_KEYS, fold, strip


def fields_to_text(record: Column, keys: list[str] = TEXT_KEYS) -> Column:
    """Values of the listed keys in record order, joined by blank lines; a null value reads ``None``."""
    wanted = F.filter(F.json_object_keys(record), lambda k: k.isin(*keys))
    values = F.from_json(record, "map<string,string>")
    return F.when(F.size(wanted) > 0, F.array_join(F.transform(wanted, lambda k: F.coalesce(F.element_at(values, k), F.lit("None"))), "\n\n"))


def flatten_record(record: Column, least: int = 0) -> Column:
    """One line ``key: value`` per field in record order; underscores in keys are spaces, items of a list are lines.

    Fields whose value, before it is folded, has fewer than ``least`` characters are left out.
    """
    values = F.from_json(record, "map<string,string>")

    def shown(k: Column) -> Column:
        v = F.element_at(values, k)
        items = F.from_json(v, "array<string>")
        listed = F.when(v.startswith("[") & items.isNotNull(), F.array_join(F.transform(items, lambda x: F.coalesce(x, F.lit("None"))), "\n"))
        return F.coalesce(listed, v, F.lit("None"))

    kept = F.filter(F.json_object_keys(record), lambda k: F.length(shown(k)) >= least)
    return F.array_join(F.transform(kept, lambda k: strip(F.concat(F.replace(k, F.lit("_"), F.lit(" ")), F.lit(": "), fold(shown(k))))), "\n")


def map_lines(record: Column) -> Column:
    """``key. value`` lines of a JSON object, by key."""
    return F.array_join(F.transform(F.array_sort(F.map_entries(F.from_json(record, "map<string,string>"))), lambda e: F.concat(e["key"], F.lit(". "), e["value"])), "\n")
