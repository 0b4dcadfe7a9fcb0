"""Deeply nested JSON records into flat tables with parent-child links."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Node:
    """Objects of one schema path: the table's name, the field that holds them ('' for the column itself), and what is nested in them."""

    table: str
    field: str = ""
    nested: tuple[Node, ...] = ()


_OBJECT = "map<string,string>"


def _once(x: Column) -> Column:
    """Evaluates x once a row: the optimiser merges projections and would repeat a costly x wherever it is used, but not across a generator."""
    return F.explode(F.array(x))


def _unwrapped(text: Column) -> Column:
    """A JSON text that is itself a JSON string: the text it holds. Others unchanged."""
    return F.when(text.rlike(r'^\s*"'), F.try_element_at(F.from_json(F.concat(F.lit("["), text, F.lit("]")), "array<string>"), F.lit(1))).otherwise(text)


def elements(text: Column) -> Column:
    """The elements of an array as JSON texts, a single object as an array of one; null where it is neither. from_json
    gives null for an array or map that is cut short."""
    return F.when(text.rlike(r"^\s*\["), F.from_json(text, "array<string>")).when(text.rlike(r"^\s*\{"), F.array(text))


def flatten(df: DataFrame, parent: Column, json: Column, roots: tuple[Node, ...], values: bool = True) -> DataFrame:
    """One row per object: (relation, parent_id, label, parent_pos, pos[, value]).

    Dewey labels: a node's label is the array of its ordinals from the record down, so the label without its last
    ordinal is the parent's, and all nodes of a schema path form one table (relation). The levels are expanded one
    after another inside the scan, without a shuffle; only the labels of equal records are then merged. value: the
    object as JSON text.

    A text that holds JSON in place of an object or array is read as such; a single object counts as an array of
    one. Null elements and objects without a non-null field give no row but keep their ordinal. Null, blank or
    unreadable JSON gives none, nor does a null parent. Records repeated under one parent count once (of differing
    objects at one label the greatest text is kept). Other columns of the table don't matter."""
    named = [n for n in roots if n.field]
    start = F.lit(None).cast("array<int>")
    source = df.select(parent.cast("string").alias("parent_id"), json.alias("json")).where(F.col("parent_id").isNotNull() & F.col("json").isNotNull())
    states = []
    if named:
        whole = source.select("parent_id", _once(_unwrapped(F.col("json"))).alias("json")).select("parent_id", F.explode(F.from_json("json", _OBJECT)).alias("_k", "text"))
        table = F.coalesce(*[F.when(F.col("_k") == n.field, F.lit(n.table)) for n in named])
        states.append(whole.where(F.col("_k").isin([n.field for n in named]) & F.col("text").isNotNull()).select("parent_id", table.alias("relation"), start.alias("label"), "text"))
    for n in roots:
        if not n.field:
            states.append(source.select("parent_id", F.lit(n.table).alias("relation"), start.alias("label"), _once(_unwrapped(F.col("json"))).alias("text")))
    state = states[0]
    for more in states[1:]:
        state = state.unionByName(more)
    state = state.withColumn("value", F.lit(None).cast("string"))

    nodes = roots
    while nodes:
        # text: what still has to be taken apart; null in rows that are finished
        fresh = F.col("text").isNotNull()
        label = F.when(~fresh, F.col("label")).otherwise(F.when(F.col("label").isNull(), F.array("_pos")).otherwise(F.concat("label", F.array("_pos"))))
        state = state.select("parent_id", "relation", "label", "value", "text", F.posexplode_outer(elements(_unwrapped(F.col("text")))).alias("_pos", "_e")).where(~fresh | F.col("_e").isNotNull())
        state = state.select("parent_id", "relation", label.alias("label"), F.coalesce("value", "_e").alias("value"), fresh.alias("_fresh"), _once(F.when(fresh, F.from_json(_unwrapped(F.col("_e")), _OBJECT))).alias("_m"))
        state = state.where(~F.col("_fresh") | F.exists(F.map_values("_m"), lambda v: v.isNotNull()))
        own = F.struct("relation", "label", "value", F.lit(None).cast("string").alias("text"))
        inside = [F.when(F.col("_fresh") & (F.col("relation") == n.table) & F.col("_m")[c.field].isNotNull(), F.struct(F.lit(c.table).alias("relation"), "label", F.lit(None).cast("string").alias("value"), F.col("_m")[c.field].alias("text"))) for n in nodes for c in n.nested]
        state = state.select("parent_id", F.explode(F.array_compact(F.array(own, *inside)) if inside else F.array(own)).alias("_n")).select("parent_id", "_n.relation", "_n.label", "_n.value", "_n.text")
        nodes = tuple(c for n in nodes for c in n.nested)
    if values:
        whole = state.groupBy("relation", "parent_id", "label").agg(F.max("value").alias("value"))
    else:
        whole = state.select("relation", "parent_id", "label").distinct()
    up = F.coalesce(F.try_element_at("label", F.lit(-2)), F.lit(-1))
    return whole.select("relation", "parent_id", "label", F.when(F.size("label") > 1, up).otherwise(F.lit(-1)).alias("parent_pos"), F.element_at("label", -1).alias("pos"), *(["value"] if values else []))
