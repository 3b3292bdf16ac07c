"""Maps, arrays and JSON, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from siltstone.functions.text import col


def dims_signature(dims: Column | str) -> Column:
    """sorted k=v joined by |; empty for no dimensions."""
    entries = F.array_sort(F.map_entries(F.coalesce(col(dims), F.create_map().cast("map<string,string>"))))
    return F.array_join(F.transform(entries, lambda e: F.concat(e["key"], F.lit("="), e["value"])), "|")


def dims_from_json(c: Column | str) -> Column:
    """map of a JSON object, null if it is none."""
    return F.from_json(col(c), "map<string,string>")


def dims_list(dims: Column | str) -> Column:
    """(dimension, member) in order of dimension."""
    return F.transform(F.array_sort(F.map_entries(col(dims))), lambda e: F.struct(e["key"].alias("dimension"), e["value"].alias("member")))


def unit_string(numerators: Column, denominators: Column) -> Column:
    """numerators joined by *, then / denominators if there are any."""
    top, bottom = F.array_join(numerators, "*"), F.array_join(denominators, "*")
    return F.when(bottom == "", top).otherwise(F.concat(top, F.lit("/"), bottom))


def best_by_rank(items: Column, value: str, key: str, ranking: list[str]) -> Column:
    """value of the item whose key comes first in a ranking; others follow in order."""
    rank = F.array(*map(F.lit, ranking))
    marked = F.transform(items, lambda x, i: F.struct(F.when(F.array_contains(rank, x[key]), F.array_position(rank, x[key])).otherwise(1000).alias("r"), i.alias("i"), x[value].alias("v")))
    return F.element_at(F.array_sort(marked), 1)["v"]


def merge_spans(spans: Column) -> Column:
    """overlapping or touching (start, end) spans merged, in order."""
    empty = F.array().cast("array<struct<start:int,end:int>>")

    def step(acc: Column, s: Column) -> Column:
        last = F.try_element_at(acc, F.lit(-1))
        before = F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0)))
        joined = F.array_append(before, F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end")))
        apart = F.array_append(acc, F.struct(s["start"].alias("start"), s["end"].alias("end")))
        return F.when(F.coalesce(s["start"] <= last["end"], F.lit(False)), joined).otherwise(apart)

    return F.aggregate(F.array_sort(spans), empty, step)


def inside_spans(at: Column, spans: Column) -> Column:
    """whether a position lies in one of the spans."""
    return F.exists(spans, lambda s: (at >= s["start"]) & (at < s["end"]))
