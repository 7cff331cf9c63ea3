"""Graph analytics on edge tables (GRF-1..8).

A property graph is two DataFrames: ``vertices(id, attr)`` and
``edges(src, dst, attr)``. Every operator is a DataFrame aggregate or join, so
the heavy step, turning raw events into weighted edges, is a partial + final
aggregate, and what follows works on the (much smaller) edge table.
Vertex ids are the codes themselves, so no two codes can collide.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.fixed_values import ROUTE_FORMAT


def code_id(c) -> F.Column:
    """A 64-bit id for a code, when a numeric vertex id is wanted (HSH-1).
    The reference used a 32-bit string hash, where two codes can collide;
    the operators here key by the code itself and need no id."""
    return F.xxhash64(F.col(c) if isinstance(c, str) else c)


def vertices_from(df: DataFrame, src: str = "origin", dst: str = "dest") -> DataFrame:
    """Distinct endpoint codes of the rows: ``id`` (GRF-1)."""
    return df.select(F.explode(F.array(F.col(src), F.col(dst))).alias("id")).distinct()


def edges_from(df: DataFrame, src: str = "origin", dst: str = "dest") -> DataFrame:
    """Rows per ordered (src, dst): ``src, dst, attr`` (GRF-2)."""
    return (df.groupBy(F.col(src).alias("src"), F.col(dst).alias("dst"))
            .agg(F.count(F.lit(1)).alias("attr")))


def label_vertices(ids: DataFrame, labels: DataFrame, code: str, name: str) -> DataFrame:
    """Attach a label to each vertex id; ids without a label keep the code."""
    lab = labels.select(F.col(code).alias("id"), F.col(name).alias("_label"))
    return (ids.join(lab, "id", "left")
            .select("id", F.coalesce("_label", "id").alias("attr")))


def graph_size(edges: DataFrame) -> DataFrame:
    """(num_vertices, num_edges) in one aggregate over the edge table (GRF-3).

    Each edge contributes its two endpoints; the first one carries the edge."""
    ends = edges.select(F.explode(F.array(
        F.struct(F.col("src").alias("id"), F.lit(1).alias("e")),
        F.struct(F.col("dst").alias("id"), F.lit(0).alias("e")))).alias("p"))
    return ends.agg(F.count_distinct("p.id").alias("num_vertices"),
                    F.sum("p.e").cast("long").alias("num_edges"))


def triplets(edges: DataFrame, vertices: DataFrame) -> DataFrame:
    """Edges with both endpoint attributes: (src, src_attr, dst, dst_attr, attr) (GRF-4)."""
    vs = vertices.select(F.col("id").alias("src"), F.col("attr").alias("src_attr"))
    vd = vertices.select(F.col("id").alias("dst"), F.col("attr").alias("dst_attr"))
    return (edges.join(vs, "src").join(vd, "dst")
            .select("src", "src_attr", "dst", "dst_attr", "attr"))


def top_routes(trip: DataFrame, k: int = 10) -> DataFrame:
    """The k heaviest edges as ``src -> dst: n`` (GRF-5); ties by the labels."""
    return (trip.orderBy(F.desc("attr"), "src_attr", "dst_attr").limit(k)
            .select("src_attr", "dst_attr", "attr",
                    F.format_string(ROUTE_FORMAT, "src_attr", "dst_attr", "attr").alias("route")))


def busiest(trip: DataFrame, k: int = 1) -> DataFrame:
    """Vertices with the largest total outgoing weight (GRF-6)."""
    return (trip.groupBy("src_attr").agg(F.sum("attr").alias("total"))
            .orderBy(F.desc("total"), "src_attr").limit(k)
            .withColumnRenamed("src_attr", "airport"))


def degrees(edges: DataFrame, vertices: DataFrame, direction: str = "in") -> DataFrame:
    """Distinct neighbours per vertex: in-degree counts edges into a vertex,
    out-degree edges out of it. Vertices with no such edge are absent (GRF-7/8)."""
    key = "dst" if direction == "in" else "src"
    d = edges.groupBy(F.col(key).alias("id")).agg(F.count(F.lit(1)).alias("degree"))
    return d.join(vertices, "id").select("degree", F.col("attr").alias("airport"), "id")


def least(df: DataFrame, k: int = 10) -> DataFrame:
    return df.orderBy("degree", "airport").limit(k)


def most(df: DataFrame, k: int = 10) -> DataFrame:
    return df.orderBy(F.desc("degree"), "airport").limit(k)
