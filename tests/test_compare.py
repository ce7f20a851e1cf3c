from ascenta.plans import queries


def test_two_sides_hold_every_identity(spark):
    data = "/root/testdata/sf0.001"
    rows = queries._identified(spark, data).collect()
    got = queries.QUERIES["anchor_compare"](spark, data).first()
    assert got.kept + got.new + got.lost == len({(tuple(r.way_refs), r.start_node_id, r.end_node_id) for r in rows})
