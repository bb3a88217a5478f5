"""Ordered-dictionary semantics on arrays: first place, last value."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def bind(value: Column, body) -> Column:
    """``body`` of ``value``, which is evaluated once.

    A column used inside a lambda would be computed again for every element.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def first_by_key(entries: Column, key: str) -> Column:
    """Keep, per key, the entry that came first."""

    def body(e, keys):
        kept = F.filter(e, lambda x, i: F.array_position(keys, x[key]) == i + 1)
        return F.when(F.size(F.array_distinct(keys)) == F.size(keys), e).otherwise(kept)

    return bind(entries, lambda e: bind(F.transform(e, lambda x: x[key]), lambda keys: body(e, keys)))


def first_place_last_value(entries: Column, key: str) -> Column:
    """A repeated key keeps its first place and takes its last value."""

    def body(e, keys):
        merged = bind(F.reverse(e), lambda back: bind(F.reverse(keys), lambda back_keys: F.transform(
            F.array_distinct(keys), lambda k: F.element_at(back, F.array_position(back_keys, k).cast("int"))
        )))
        return F.when(F.size(F.array_distinct(keys)) == F.size(keys), e).otherwise(merged)

    return bind(entries, lambda e: bind(F.transform(e, lambda x: x[key]), lambda keys: body(e, keys)))
