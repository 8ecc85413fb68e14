"""Components, sequential claims by components and in rounds, discovery from raw records."""

import random

import pytest
from pyspark.sql import functions as F

from cairn.operators import discovery, graph
from cairn.sources.shared import shared_folder


def labels(edges):
    up = {}

    def find(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {x: find(x) for x in up}


def edge_sets():
    rng = random.Random(1)
    chain = list(range(60))
    rng.shuffle(chain)
    return {
        "none": [], "chain": list(zip(chain, chain[1:])), "star": [(100, i) for i in range(40)], "random": [(rng.randrange(80), rng.randrange(80)) for _ in range(60)],
        "loops": [(1, 1), (2, 3), (3, 2), (2, 3)],
    }


@pytest.mark.parametrize("name", ["none", "chain", "star", "random", "loops"])
def test_components(spark, name):
    edges = edge_sets()[name]
    got = {r.node: r.component for r in graph.components(spark.createDataFrame(edges, "x int, y int"), "x", "y").collect()}
    assert got == {k: v for k, v in labels([e for e in edges if e[0] != e[1]]).items()}


def sequential(anchors, claims):
    claimed, active = set(), set()
    for a in anchors:
        if a not in claimed:
            active.add(a)
            claimed |= {r for x, r in claims if x == a}
    return active


@pytest.mark.parametrize("at_once", [200_000, 5, 0])
def test_claims_in_order(spark, at_once, monkeypatch):
    """Chains, hubs and cycles of claims; records that are no anchors, own records and repeated claims count for nothing."""
    monkeypatch.setattr(discovery, "SETTLED_AT_ONCE", at_once)
    rng = random.Random(9)
    order = list(range(50))
    rng.shuffle(order)
    claims = [(rng.randrange(50), rng.randrange(70)) for _ in range(45)] + [(order[0], x) for x in range(8)] + [(7, 7), (3, 60), (3, 60)]
    anchors = spark.createDataFrame([(a, i) for i, a in enumerate(order)], "id int, rank int")
    got = {r.id for r in discovery.active_anchors(anchors, spark.createDataFrame(claims, "anchor_id int, record_id int")).collect()}
    assert got == sequential(order, claims)


def test_long_chain_takes_no_rounds(spark, caplog):
    n = 400
    anchors = spark.createDataFrame([(i, i) for i in range(n)], "id int, rank int")
    claims = spark.createDataFrame([(i, i + 1) for i in range(n - 1)], "anchor_id int, record_id int")
    with caplog.at_level("INFO"):
        got = {r.id for r in discovery.active_anchors(anchors, claims).collect()}
    assert got == set(range(0, n, 2))
    assert "in 0 rounds" in caplog.text


RECORD = ("id long, source string, name string, address string, city string, country string, phone string, website string, lat double, lon double, "
          "primary_type string, status string, retired_at string, flags array<string>, rank int")


def record(i, source, name, rank=0, **more):
    row = dict(id=i, source=source, name=name, address="12 Main Street", city="Oakland", country="US", phone=None, website=None, lat=None, lon=None, primary_type="bar",
               status="open", retired_at=None, flags=None, rank=rank) | more
    return tuple(row.values())


def test_discovery_skips_anchor_claimed_after_batch_was_selected(spark):
    """The second anchor is taken by the first while the batch is worked off, so it becomes no candidate of its own."""
    rows = [record(1, "fsq", "Red Fox Bar", 1), record(2, "fsq", "Red Fox Bar LLC", 2), record(3, "osm", "Red Fox Bar"), record(4, "fsq", "Owl", 3, address="77 Elm Street")]
    active, links, reviews = discovery.correlate(spark.createDataFrame(rows, RECORD), ["fsq"], F.col("rank"))
    assert {r.id for r in active.collect()} == {1, 4}
    got = {(r.candidate_id, r.record_id, r.method) for r in links.collect()}
    assert got == {(1, 1, "anchor_source_id"), (1, 2, "exact_address_strong_name"), (1, 3, "exact_address_strong_name"), (4, 4, "anchor_source_id")}
    assert reviews.collect() == []


def test_correlate_gates(spark):
    rows = [record(1, "fsq", "Red Fox Bar", 1), record(2, "osm", "Red Fox Bar", primary_type="winery"), record(3, "osm", "Red Fox Bar", status="closed"),
            record(4, "osm", "Red Fox Bar", flags=["stale"]), record(5, "osm", "Red Fox Bar", retired_at="2024"), record(6, "osm", "Red Fox Bar", city="Berkeley"),
            record(7, "overture", "Red Fox Bar"), record(8, "overture", "Red Fox Bar"), record(9, "ca_abc", "Red Fox Bar"), record(10, "ca_abc", "Red Fox Bar"),
            record(11, "x", "Completely Other"), record(12, "y", None, address=None), record(13, "z", "Red Fox Bar", country=None)]
    _, links, reviews = discovery.correlate(spark.createDataFrame(rows, RECORD), ["fsq"], F.col("rank"))
    assert {r.record_id for r in links.collect()} == {1, 9, 10}
    got = {(r.record_id, r.reason) for r in reviews.collect()}
    assert got == {(2, "type_conflict:exact_address_strong_name"), (7, "exact_address_strong_name"), (8, "exact_address_strong_name"), (11, "same_location_name_conflict")}


def test_near_pairs_at_high_latitude(spark):
    """A degree of longitude is short near the pole: pairs of 90 m lie several fixed cells apart there."""
    from cairn.operators import identity

    points = [(1, 69.0, 20.0), (2, 69.0, 20.0 + 0.0022), (3, 69.0, 20.0 + 0.0040), (4, 0.0, 20.0), (5, 0.0, 20.0008), (6, 0.0, 20.001), (7, None, 1.0)]
    df = spark.createDataFrame(points, "id int, lat double, lon double")
    assert {(r.a, r.b) for r in identity.distance_pairs(df, "id", "lat", "lon", 100.0).collect()} == {(1, 2), (2, 3), (4, 5), (5, 6)}
    rows = df.select("id", F.lit("b").alias("block"), F.lit("").alias("name"), F.lit("").alias("address"), "lat", "lon")
    assert {(r.record_id, r.anchor_id) for r in identity.fuzzy_block(rows, rows, ["block"], skip_self=True).where("record_id < anchor_id").collect()} == {(1, 2), (2, 3), (4, 5), (5, 6)}


def test_shared_folder_on_a_cluster_must_be_named(spark):
    class Context:
        master = "local-cluster[2,1,1024]"

    class Session:
        sparkContext = Context()

        class conf:
            get = staticmethod(lambda name, default: None)

    with pytest.raises(ValueError):
        shared_folder(Session())
