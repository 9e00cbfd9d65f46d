"""Writers. What Spark writes is committed by Spark; pages are strings made from a few rows."""

from __future__ import annotations

import html
import json
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.graph import upsert_latest


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share (spark.checkpoint.dir). Where none is set, a folder of this machine if the master is local, as in tests; else this raises, since
    executors do not see each other's folders."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[[^\]]*\])?", master):
            raise ValueError(f"set spark.checkpoint.dir to a folder that driver and executors share (master {master})")
        found = "file://" + tempfile.mkdtemp(prefix="threadloom-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder that driver and executors share."""
    return f"{shared_dir(spark)}/threadloom/{uuid.uuid4().hex}-{name}"


def cut(df: DataFrame, name: str) -> DataFrame:
    """df, written as Parquet to the shared folder and read again: cuts the lineage, and survives the loss of executors."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_json_lines(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def json_array(df: DataFrame, order: str) -> DataFrame:
    """One row, `value`: a small table as one JSON array, for files that other tools read whole."""
    rows = F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.to_json(F.struct("*")).alias("j")))), lambda x: x["j"])
    return df.agg(F.concat(F.lit("["), F.array_join(rows, ",\n"), F.lit("]")).alias("value"))


def write_json_array(df: DataFrame, order: str, path: str) -> None:
    """A table of any size as one JSON array over the files of a folder, in order of their names: a row is a line, the first one opens the array and the last one closes it. Rows are in order of a
    column without ties or nulls."""
    ends = df.agg(F.min(order).alias("low"), F.max(order).alias("high")).first()
    if ends.low is None:
        write_text(df.sparkSession.createDataFrame([("[]",)], "value string"), path)
        return
    own = F.to_json(F.struct(*(c for c in df.columns)))
    line = F.concat(F.when(F.col(order) == ends.low, "[").otherwise(","), own, F.when(F.col(order) == ends.high, "]").otherwise(""))
    df.repartitionByRange(order).sortWithinPartitions(order).select(line.alias("value")).write.mode("overwrite").text(path)


def write_text(one: DataFrame, path: str) -> None:
    """One row of text as a file of its own."""
    one.coalesce(1).write.mode("overwrite").text(path)


def write_text_lines(rows: DataFrame, path: str) -> None:
    """A text column as lines."""
    rows.write.mode("overwrite").text(path)


def json_object(df: DataFrame, key: str) -> DataFrame:
    """One row, `value`: a small table as one JSON object by a column; nulls are left out."""
    own = F.to_json(F.struct(*(c for c in df.columns if c != key)))
    member = F.concat(F.to_json(F.array(F.col(key).cast("string"))), F.lit(": "), own)
    rows = F.transform(F.array_sort(F.collect_list(F.struct(F.col(key).alias("k"), member.alias("m")))), lambda x: F.regexp_replace(x["m"], r"^\[(\".*?\")\]: ", "$1: "))
    return df.agg(F.concat(F.lit("{"), F.array_join(rows, ",\n"), F.lit("}")).alias("value"))


def write_graph(vertices: DataFrame, edges: DataFrame, folder: str) -> None:
    vertices.write.mode("overwrite").parquet(f"{folder}/vertices")
    edges.write.mode("overwrite").parquet(f"{folder}/edges")


def upsert_batches(old: DataFrame | None, new: DataFrame, path: str) -> None:
    """Writes new and what of old has another batch_index, to a path that old is not read from."""
    (new if old is None else upsert_latest(old, new)).write.mode("overwrite").parquet(path)


def graph_page(nodes: DataFrame, edges: DataFrame, title: str = "Graph") -> str:
    """A page without scripts from elsewhere: the drawn graph's elements as inline JSON and as a table. Text is escaped; "</" cannot end the script."""
    ns, es = ([r.asDict(recursive=True) for r in df.collect()] for df in (nodes, edges))
    data = json.dumps({"nodes": ns, "edges": es}, ensure_ascii=False).replace("</", "<\\/")
    rows = "".join(f"<tr><td>{html.escape(str(e['source']))}</td><td>{html.escape(str(e['reason']))}</td><td>{html.escape(str(e['target']))}</td><td>{e['weight']}</td></tr>" for e in es)
    return f"<!doctype html><meta charset=utf-8><title>{html.escape(title)}</title><h1>{html.escape(title)}</h1><p>{len(ns)} nodes, {len(es)} edges</p><table>{rows}</table><script type=application/json id=data>{data}</script>"


#: How the drawn network moves: how strongly nodes push, how long and stiff an edge is, how fast movement dies, and steps until it stands.
PHYSICS = {"push": 2600.0, "length": 110.0, "stiffness": 0.04, "damping": 0.85, "steps": 300}
_SCRIPT = """
const d = JSON.parse(document.getElementById('data').textContent), p = d.physics, at = new Map();
d.nodes.forEach((n, i) => at.set(n.name, Object.assign(n, {x: 450 + 300 * Math.cos(i * 2.4), y: 450 + 300 * Math.sin(i * 2.4), u: 0, v: 0})));
const links = d.edges.filter(e => at.has(e.a) && at.has(e.b) && e.a !== e.b);
for (let step = 0; step < p.steps; step++) {
  for (const n of d.nodes) for (const m of d.nodes) if (n !== m) {
    const dx = n.x - m.x, dy = n.y - m.y, far = Math.max(dx * dx + dy * dy, 25);
    n.u += p.push * dx / far / Math.sqrt(far); n.v += p.push * dy / far / Math.sqrt(far);
  }
  for (const e of links) {
    const n = at.get(e.a), m = at.get(e.b), dx = m.x - n.x, dy = m.y - n.y, l = Math.hypot(dx, dy) || 1, f = p.stiffness * (l - p.length) / l;
    n.u += f * dx; n.v += f * dy; m.u -= f * dx; m.v -= f * dy;
  }
  for (const n of d.nodes) { n.x += n.u *= p.damping; n.y += n.v *= p.damping; }
}
const svg = document.getElementById('net'), make = (kind, set, title) => {
  const x = document.createElementNS('http://www.w3.org/2000/svg', kind), t = document.createElementNS('http://www.w3.org/2000/svg', 'title');
  for (const k in set) x.setAttribute(k, set[k]);
  t.textContent = title; x.appendChild(t); svg.appendChild(x); return x;
};
for (const e of links) make('line', {x1: at.get(e.a).x, y1: at.get(e.a).y, x2: at.get(e.b).x, y2: at.get(e.b).y, stroke: '#aaa', 'stroke-width': Math.min(1 + Math.log2(e.value), 8)}, e.title);
for (const n of d.nodes) {
  make('circle', {cx: n.x, cy: n.y, r: n.size / 4, fill: n.colour}, n.title);
  make('text', {x: n.x, y: n.y - n.size / 4 - 3, 'font-size': 11, 'text-anchor': 'middle'}, n.title).append(n.name);
}
const b = svg.getBBox(); svg.setAttribute('viewBox', [b.x - 20, b.y - 20, b.width + 40, b.height + 40].join(' '));
"""


def network_page(nodes: DataFrame, edges: DataFrame, title: str = "Network", **physics: float) -> str:
    """A page that draws a network of a few hundred nodes (name, title, colour, size) and edges (a, b, title, value) and lets it come to rest, with tooltips; it needs nothing from
    elsewhere, so it can stand in a frame of another page. physics: any of PHYSICS."""
    data = {"nodes": [r.asDict() for r in nodes.collect()], "edges": [r.asDict() for r in edges.collect()], "physics": PHYSICS | physics}
    inline = json.dumps(data, ensure_ascii=False).replace("<", "\\u003c")
    return f"<!doctype html><meta charset=utf-8><title>{html.escape(title)}</title><svg id=net width=900 height=900></svg><script type=application/json id=data>{inline}</script><script>{_SCRIPT}</script>"
