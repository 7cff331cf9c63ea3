"""The flight graph (module 5): airports as vertices, routes as weighted edges."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import graph as gr
from tessera.operators.ids import dense_ids, encode
from tessera.plans import standins as si
from tessera.plans.oracle_sql import FLIGHTS_CTE, ROUTE_AIRPORTS_CTE, with_
from tessera.plans.registry import query
from tessera.session import shared_dir
from tessera.sources.tables import Tables

TOP_K = 10

GRAPH_CTES = with_(FLIGHTS_CTE, ROUTE_AIRPORTS_CTE, """
vertices AS (
  SELECT v.id, coalesce(a.airport, v.id) AS attr
  FROM (SELECT DISTINCT id FROM (SELECT origin AS id FROM flights
                                 UNION ALL SELECT dest FROM flights)) v
  LEFT JOIN route_airports a ON v.id = a.iata)""", """
edges AS (SELECT origin AS src, dest AS dst, COUNT(*) AS attr FROM flights GROUP BY origin, dest)""",
"""
triplets AS (
  SELECT e.src, s.attr AS src_attr, e.dst, d.attr AS dst_attr, e.attr
  FROM edges e JOIN vertices s ON e.src = s.id JOIN vertices d ON e.dst = d.id)""")


def _graph(spark, sf_dir):
    """(vertices, edges). Every flight yields an edge, so the airports are
    the edge endpoints: the vertex set comes from the small edge table
    instead of a second pass over the flights."""
    t = Tables(spark, sf_dir)
    # the edge table (one row per route) feeds vertices, degrees and triplets:
    # written once to the shared folder, so the flights are read once
    path = shared_dir(spark, "edges")
    gr.edges_from(si.flights(t)).write.parquet(path)
    e = spark.read.parquet(path)
    v = gr.label_vertices(gr.vertices_from(e, "src", "dst"), si.route_airports(t), "iata", "airport")
    return v, e


@query("graph_vertices", GRAPH_CTES + "SELECT id, attr FROM vertices")
def graph_vertices(spark, sf_dir):
    t = Tables(spark, sf_dir)
    e = gr.edges_from(si.flights(t))
    return gr.label_vertices(gr.vertices_from(e, "src", "dst"), si.route_airports(t), "iata", "airport")


@query("graph_edges", GRAPH_CTES + "SELECT src, dst, attr FROM edges")
def graph_edges(spark, sf_dir):
    return gr.edges_from(si.flights(Tables(spark, sf_dir)))


@query("vertex_ids", """
SELECT code, row_number() OVER (ORDER BY code) - 1 AS id
FROM (SELECT CAST(c_custkey AS VARCHAR) AS code FROM customer UNION SELECT s_name FROM supplier)""")
def vertex_ids(spark, sf_dir):
    """Gapless ids of the codes of all airports and carriers, in code order (HSH-1, GRF-1)."""
    t = Tables(spark, sf_dir)
    codes = t.customer.select(F.col("c_custkey").cast("string").alias("code")).unionByName(t.supplier.select(F.col("s_name").alias("code")))
    return dense_ids(codes, "code")


@query("graph_edges_encoded", GRAPH_CTES + """,
ids AS (SELECT id AS code, row_number() OVER (ORDER BY id) - 1 AS id FROM vertices)
SELECT s.id AS src_id, d.id AS dst_id, e.attr FROM edges e JOIN ids s ON s.code = e.src JOIN ids d ON d.code = e.dst""")
def graph_edges_encoded(spark, sf_dir):
    """The edges between vertex ids (GRF-2)."""
    v, e = _graph(spark, sf_dir)
    ids = dense_ids(v, "id", "no")
    both = encode(encode(e, ids, "src", "id", "src_id", "no"), ids, "dst", "id", "dst_id", "no")
    return both.select("src_id", "dst_id", "attr")


@query("graph_size", GRAPH_CTES + """
SELECT (SELECT COUNT(*) FROM (SELECT src AS id FROM edges UNION SELECT dst FROM edges)) AS num_vertices,
       (SELECT COUNT(*) FROM edges) AS num_edges""")
def graph_size(spark, sf_dir):
    return gr.graph_size(_graph(spark, sf_dir)[1])


@query("graph_triplets", GRAPH_CTES + "SELECT src, src_attr, dst, dst_attr, attr FROM triplets")
def graph_triplets(spark, sf_dir):
    v, e = _graph(spark, sf_dir)
    return gr.triplets(e, v)


@query("graph_top_routes", GRAPH_CTES + f"""
SELECT src_attr, dst_attr, attr, src_attr || ' -> ' || dst_attr || ': ' || CAST(attr AS VARCHAR) AS route
FROM triplets ORDER BY attr DESC, src_attr, dst_attr LIMIT {TOP_K}""")
def graph_top_routes(spark, sf_dir):
    v, e = _graph(spark, sf_dir)
    return gr.top_routes(gr.triplets(e, v), TOP_K)


@query("graph_busiest", GRAPH_CTES + """
SELECT src_attr AS airport, CAST(SUM(attr) AS BIGINT) AS total FROM triplets
GROUP BY src_attr ORDER BY total DESC, airport LIMIT 1""")
def graph_busiest(spark, sf_dir):
    v, e = _graph(spark, sf_dir)
    return gr.busiest(gr.triplets(e, v), 1)


@query("graph_in_degree", GRAPH_CTES + f"""
SELECT COUNT(*) AS degree, v.attr AS airport, v.id FROM edges e JOIN vertices v ON e.dst = v.id
GROUP BY v.id, v.attr ORDER BY degree, airport LIMIT {TOP_K}""")
def graph_in_degree(spark, sf_dir):
    v, e = _graph(spark, sf_dir)
    return gr.least(gr.degrees(e, v, "in"), TOP_K)


@query("graph_out_degree", GRAPH_CTES + f"""
SELECT COUNT(*) AS degree, v.attr AS airport, v.id FROM edges e JOIN vertices v ON e.src = v.id
GROUP BY v.id, v.attr ORDER BY degree DESC, airport LIMIT {TOP_K}""")
def graph_out_degree(spark, sf_dir):
    v, e = _graph(spark, sf_dir)
    return gr.most(gr.degrees(e, v, "out"), TOP_K)
