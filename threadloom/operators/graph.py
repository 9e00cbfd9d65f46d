"""The knowledge graph as two tables: vertices (name, type, first_seen, count) and edges (source, target, relation, evidence, weight).

Whatever is "first" or "last" goes by an explicit seq. Merging is an aggregation with partial sums before the shuffle, so a name that a third of
all relations touch costs a row for each task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.text import linear

#: Colours of entity types in the two renderings, and what other types get.
COLOURS = {"Person": "#FF6B6B", "Organization": "#4ECDC4", "Concept": "#45B7D1", "Location": "#FFA07A", "Event": "#98D8C8", "Unknown": "#95A5A6"}
ELEMENT_COLOURS = {"Person": "#5B8FF9", "Product": "#F6BD16", "Organization": "#5AD8A6", "Concept": "#E86452", "Location": "#6DC8EC", "Event": "#945FB9"}
ELEMENT_DEFAULT = "#666"


def _filled(c: str) -> Column:
    return F.when(F.col(c) != "", F.col(c))


def with_validity(relations: DataFrame) -> DataFrame:
    """relations (source, name, target, relation, ...) with source taken from name if empty, and `valid`: source, target and a relation that is not blank."""
    has_name = "name" in relations.columns
    source = F.coalesce(_filled("source"), _filled("name")) if has_name else _filled("source")
    return relations.withColumn("source", source).withColumn("valid", F.col("source").isNotNull() & _filled("target").isNotNull() & (T.strip(F.coalesce("relation", F.lit(""))) != ""))


def counters(relations: DataFrame) -> DataFrame:
    return with_validity(relations).agg(F.count_if("valid").alias("added"), F.count_if(~F.col("valid")).alias("skipped"))


def with_types(relations: DataFrame, entities: DataFrame) -> DataFrame:
    """Adds s_type and t_type: the type of the batch's first entity (by pos) of that name, else Unknown."""
    first = entities.where("name IS NOT NULL").groupBy("batch_index", "name").agg(F.min_by("type", "pos").alias("type"))
    for end, name in (("source", "s_type"), ("target", "t_type")):
        side = first.select(F.col("batch_index").alias("__b"), F.col("name").alias("__n"), F.col("type").alias(name))
        relations = relations.join(side, (F.col("batch_index") == F.col("__b")) & (F.col(end) == F.col("__n")), "left").drop("__b", "__n").withColumn(name, F.coalesce(name, F.lit("Unknown")))
    return relations


def vertex_merge(relations: DataFrame) -> DataFrame:
    """name, type, first_seen, count from valid relations (seq, source, s_type, target, t_type): the first touch gives type and first_seen, each later one counts; null after one
    touch. Of one relation the source is touched before the target."""
    side = lambda i, end, kind: F.struct(F.col("seq").alias("seq"), F.lit(i).alias("side"), F.col(end).alias("name"), F.col(kind).alias("type"))
    touches = relations.select(F.explode(F.array(side(0, "source", "s_type"), side(1, "target", "t_type"))).alias("t")).select("t.*")
    return touches.groupBy("name").agg(F.min_by("type", F.struct("seq", "side")).alias("type"), F.min("seq").alias("first_seen"), F.nullif(F.count("*") - 1, F.lit(0)).alias("count"))


def edge_merge(relations: DataFrame) -> DataFrame:
    """source, target, relation, evidence, weight: one directed edge for each pair; the first relation and evidence stay, the weight counts all."""
    return relations.groupBy("source", "target").agg(F.min_by("relation", "seq").alias("relation"), F.min_by("evidence", "seq").alias("evidence"), F.count("*").alias("weight"))


def merged_edges(old: DataFrame, new: DataFrame) -> DataFrame:
    """An edge table after another one is merged into it: weights add up, attributes of the old one stay."""
    both = old.withColumn("age", F.lit(0)).unionByName(new.withColumn("age", F.lit(1)))
    return both.groupBy("source", "target").agg(F.min_by("relation", "age").alias("relation"), F.min_by("evidence", "age").alias("evidence"), F.sum("weight").alias("weight"))


def merged_vertices(old: DataFrame, new: DataFrame) -> DataFrame:
    """A vertex table after another one is merged into it; counts are touches less one."""
    both = old.withColumn("age", F.lit(0)).unionByName(new.withColumn("age", F.lit(1)))
    touches = F.sum(F.coalesce("count", F.lit(0)) + 1)
    return both.groupBy("name").agg(F.min_by("type", "age").alias("type"), F.min_by("first_seen", "age").alias("first_seen"), F.nullif(touches - 1, F.lit(0)).alias("count"))


def upsert_latest(old: DataFrame, new: DataFrame, key: str = "batch_index") -> DataFrame:
    """new, and the rows of old whose key new does not have."""
    return old.join(new.select(key), key, "left_anti").unionByName(new)


def top_edges(edges: DataFrame, vertices: DataFrame, k: int) -> DataFrame:
    """The k heaviest edges with their ends' types; equal weights by source and target. The sort is cut to k before the joins."""
    top = edges.orderBy(F.desc("weight"), "source", "target").limit(k)
    for end, name in (("source", "s_type"), ("target", "t_type")):
        top = top.join(vertices.select(F.col("name").alias("__n"), F.col("type").alias(name)), F.col(end) == F.col("__n"), "left").drop("__n")
    return top


def summary_lines(top: DataFrame) -> DataFrame:
    """One row, `summary`: "source (type) --[relation]--> target (type)" for each edge, heaviest first. For the few edges of top_edges."""
    shown = lambda c: F.coalesce(F.col(c), F.lit("None"))
    line = F.format_string("%s (%s) --[%s]--> %s (%s)", shown("source"), shown("s_type"), shown("relation"), shown("target"), shown("t_type"))
    rows = F.array_sort(F.collect_list(F.struct((-F.col("weight")).alias("rank"), "source", "target", line.alias("line"))))
    return top.agg(F.array_join(F.transform(rows, lambda x: x["line"]), "\n").alias("summary"))


def _rank() -> Column:
    return F.struct((-F.col("weight")).alias("a"), F.col("source").alias("b"), F.col("target").alias("c"))


def undirected(edges: DataFrame) -> DataFrame:
    """a, b, relation, weight: both directions are one edge, whose attributes come from the record written last, that is the lightest (then the last by names)."""
    a, b = F.least("source", "target").alias("a"), F.greatest("source", "target").alias("b")
    return edges.groupBy(a, b).agg(F.max_by("relation", _rank()).alias("relation"), F.max_by("weight", _rank()).alias("weight"))


def node_strength(edges: DataFrame) -> DataFrame:
    """name, strength: the sum of weights (1 for 0 or null) of directed records at a node; a loop counts twice."""
    weight = F.coalesce(F.nullif(F.col("weight"), F.lit(0)), F.lit(1))
    return edges.select(F.explode(F.array("source", "target")).alias("name"), weight.alias("w")).groupBy("name").agg(F.sum("w").alias("strength"))


def node_sizes(strength: DataFrame) -> DataFrame:
    """name, strength, size: 25 to 75 by strength."""
    ends = strength.agg(F.min("strength").alias("low"), F.max("strength").alias("high"))  # one row
    span = F.coalesce(F.nullif(F.col("high") - F.col("low"), F.lit(0)), F.lit(1))
    return strength.join(F.broadcast(ends)).select("name", "strength", (25 + (F.col("strength") - F.col("low")) / span * 50).alias("size"))


def metrics(n_nodes: Column, n_edges: Column) -> dict[str, Column]:
    n, e = n_nodes.cast("double"), n_edges.cast("double")
    return {"average_degree": 2 * e / F.greatest(n, F.lit(1.0)), "density": F.when((e == 0) | (n <= 1), 0.0).otherwise(F.try_divide(2 * e, n * (n - 1)))}


def graph_metrics(edges: DataFrame) -> DataFrame:
    """n_nodes, n_edges, average_degree, density of an undirected edge table (a, b)."""
    counts = edges.select("a", "b", F.explode(F.array("a", "b")).alias("name")).agg(F.countDistinct("name").alias("n_nodes"), F.countDistinct("a", "b").alias("n_edges"))
    made = metrics(F.col("n_nodes"), F.col("n_edges"))
    return counts.select("n_nodes", "n_edges", *(c.alias(k) for k, c in made.items()))


def neighbourhood(edges: DataFrame, name: str) -> DataFrame:
    """other, relation, weight of all edges at a node."""
    at = (F.col("source") == name) | (F.col("target") == name)
    return edges.where(at).select(F.when(F.col("source") == name, F.col("target")).otherwise(F.col("source")).alias("other"), "relation", "weight")


def _colour(kind: Column, table: dict[str, str], default: str) -> Column:
    return F.coalesce(F.try_element_at(F.create_map(*(F.lit(x) for pair in table.items() for x in pair)), kind), F.lit(default))


def render_nodes(sizes: DataFrame, vertices: DataFrame) -> DataFrame:
    """name, title, kind, colour, size of nodes to draw."""
    rows = sizes.join(vertices.select(F.col("name").alias("__n"), "type"), F.col("name") == F.col("__n"), "left")
    kind = F.coalesce(F.when(F.col("type") != "", F.col("type")), F.lit("Unknown"))
    return rows.select("name", F.concat("name", F.lit("\nType: "), kind).alias("title"), kind.alias("kind"), _colour(kind, COLOURS, COLOURS["Unknown"]).alias("colour"), "size")


def render_edges(edges: DataFrame) -> DataFrame:
    """a, b, title (what is shown over it), label, weight and value (its width goes by it) of undirected edges to draw; a missing relation is shown as None."""
    title = F.coalesce(F.col("relation"), F.lit("None"))
    weight = F.coalesce(F.nullif(F.col("weight"), F.lit(0)), F.lit(1))
    return edges.select("a", "b", title.alias("title"), title.alias("label"), weight.alias("weight"), weight.cast("double").alias("value"))


def element_nodes(nodes: DataFrame) -> DataFrame:
    """id, label, type, mentions, colour, width of nodes (name, type, mentions) for the offline page."""
    mentions = F.coalesce("mentions", F.lit(1))
    return nodes.select(F.col("name").alias("id"), F.col("name").alias("label"), "type", mentions.alias("mentions"), _colour(F.col("type"), ELEMENT_COLOURS, ELEMENT_DEFAULT).alias("colour"), linear(mentions, 1, 10, 30, 80).alias("width"))


def element_edges(edges: DataFrame) -> DataFrame:
    """id (e0, e1, ... by source and target), source, target, reason, weight, width of a drawn graph's edges; the numbering is one window over these."""
    weight = F.coalesce(F.nullif(F.col("weight"), F.lit(0)), F.lit(1))
    number = F.row_number().over(Window.orderBy("source", "target")) - 1
    return edges.select(F.concat(F.lit("e"), number.cast("string")).alias("id"), "source", "target", F.col("relation").alias("reason"), weight.alias("weight"), linear(weight, 1, 5, 1, 5).alias("width"))
