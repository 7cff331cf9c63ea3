"""Graph operators on a small edge table."""

from tessera.operators import graph as gr


def test_graph(spark):
    flights = spark.createDataFrame(
        [("SEA", "LAX")] * 3 + [("LAX", "SEA")] * 2 + [("SEA", "PDX"), ("PDX", "ANC")],
        "origin string, dest string")
    names = spark.createDataFrame([("SEA", "Seattle"), ("LAX", "Los Angeles"), ("PDX", "Portland")],
                                  "iata string, airport string")
    v = gr.label_vertices(gr.vertices_from(flights), names, "iata", "airport")
    e = gr.edges_from(flights)
    assert {r["id"]: r["attr"] for r in v.collect()} == {
        "SEA": "Seattle", "LAX": "Los Angeles", "PDX": "Portland", "ANC": "ANC"}
    assert gr.graph_size(e).first().asDict() == {"num_vertices": 4, "num_edges": 4}
    trip = gr.triplets(e, v)
    top = [r["route"] for r in gr.top_routes(trip, 2).collect()]
    assert top == ["Seattle -> Los Angeles: 3", "Los Angeles -> Seattle: 2"]
    assert gr.busiest(trip).first().asDict() == {"airport": "Seattle", "total": 4}
    ind = [(r["degree"], r["airport"]) for r in gr.least(gr.degrees(e, v, "in")).collect()]
    assert ind == [(1, "ANC"), (1, "Los Angeles"), (1, "Portland"), (1, "Seattle")]
    outd = [(r["degree"], r["airport"]) for r in gr.most(gr.degrees(e, v, "out")).collect()]
    assert outd == [(2, "Seattle"), (1, "Los Angeles"), (1, "Portland")]
