"""JSON objects as text, taken apart and put together again member by member, so that what is not known passes through."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .columns import once


def with_members(df: DataFrame, json: Column, name: str = "members") -> DataFrame:
    """df with `name`: the members of a JSON object in their order, as structs of key and value, the value as JSON text; null if it is no object.

    Values are as the JSON reader writes them: nested keys in their order, numbers and strings in its notation. The variant only tells which values are strings; a member that is null is the
    text null. Keys that an object has twice stand once, with one of the values.
    """
    staged = once(df, __m_json=json)
    body = F.col("__m_json")
    good = F.try_parse_json(body)
    staged = once(staged, __m_keys=F.array_distinct(F.json_object_keys(body)), __m_typed=F.when(good.isNotNull(), good.cast("map<string,variant>")), __m_plain=F.from_json(body, "map<string,string>"))
    plain, typed = F.col("__m_plain"), F.col("__m_typed")

    def member(key: Column) -> Column:
        own = F.to_json(F.try_element_at(typed, key))
        text = F.when(own.startswith('"'), own).otherwise(F.coalesce(F.try_element_at(plain, key), F.lit("null")))
        return F.struct(key.alias("key"), text.alias("value"))

    return staged.withColumn(name, F.transform("__m_keys", member)).drop("__m_json", "__m_keys", "__m_typed", "__m_plain")


def quoted(text: Column) -> Column:
    """A string as JSON."""
    listed = F.to_json(F.array(text))
    return listed.substr(F.lit(2), F.length(listed) - 2)


def object_of(members: Column, change: dict[str, Column] | None = None, keep: Callable[[Column], Column] | None = None) -> Column:
    """Members as a JSON object. change: JSON texts that take the place of a member, or go to the end if there is none of that name."""
    change = change or {}
    if keep is not None:
        members = F.filter(members, keep)

    def text(m: Column) -> Column:
        value = m["value"]
        for key, new in change.items():
            value = F.when(m["key"] == key, new).otherwise(value)
        return F.concat(quoted(m["key"]), F.lit(":"), value)

    has = F.transform(members, lambda m: m["key"])
    more = F.array(*(F.when(~F.array_contains(has, key), F.concat(quoted(F.lit(key)), F.lit(":"), new)) for key, new in change.items()))
    parts = F.concat(F.transform(members, text), F.filter(more, lambda x: x.isNotNull())) if change else F.transform(members, text)
    return F.concat(F.lit("{"), F.array_join(parts, ","), F.lit("}"))


def indented_length(json: Column) -> Column:
    """Characters of a compact JSON text if it were indented by two: a line for each member and element and for each closing bracket, and a blank after each colon. Empty brackets stay as they
    are. Strings and other values are one sign each; then brackets, commas and colons are counted by their depth."""
    bare = F.regexp_replace(F.regexp_replace(json, r"\\.", ""), '"[^"]*"', "0")
    signs = F.split(F.regexp_replace(bare, r"[^\[\]{},:]+", "0"), "")
    begin = F.struct(F.lit(0).alias("depth"), F.lit(0).cast("long").alias("more"), F.lit(False).alias("opened"))

    def step(acc: Column, c: Column) -> Column:
        depth, more = acc["depth"], acc["more"]
        line = 1 + 2 * depth
        state = lambda d, m, o: F.struct(d.alias("depth"), m.cast("long").alias("more"), F.lit(o).alias("opened"))
        # an opening bracket counts the line of its first element, which an empty one gives back
        return (
            F.when(c.isin("{", "["), state(depth + 1, more + line + 2, True))
            .when(c.isin("}", "]"), state(depth - 1, F.when(acc["opened"], more - line).otherwise(more + line - 2), False))
            .when(c == ",", state(depth, more + line, False))
            .when(c == ":", state(depth, more + 1, False))
            .otherwise(state(depth, more, False))
        )

    return F.length(json) + F.aggregate(signs, begin, step, lambda acc: acc["more"])
