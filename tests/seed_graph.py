"""The 10-node seed graph of the golden tests."""

import json

# The 10-node seed graph and the three extra edge updates of FIXTURES.md §1
# (node id: lat, lon; edges src-dst: weight; updates as edge messages).
SEED_NODES = {
    "36": (37.78383, -122.39887),
    "41": (37.78127, -122.41873999999999),
    "47": (37.7625, -122.42),
    "66": (37.7787416115368, -122.392740827108),
    "75": (37.755, -122.4002),
    "80": (37.775, -122.41),
    "106": (37.7632417, -122.4306746),
    "120": (37.775, -122.435),
    "133": (37.7552126, -122.42097520000002),
    "285": (37.75, -122.44),
}
SEED_EDGES = [
    ("36", "80", 1264), ("41", "36", 570), ("47", "120", 1266), ("66", "36", 169), ("75", "36", 615),
    ("75", "47", 1176), ("75", "133", 700), ("106", "80", 976), ("120", "41", 901), ("120", "285", 1284),
    ("133", "106", 20), ("285", "106", 100), ("285", "133", 500),
]
EXTRA_UPDATES = [
    "75 850 66 -122.4002 37.755 -122.392740827108 37.7787416115368",
    "80 100 1 -122.41 37.775 -122.405 37.766",
    "1 200 75 -122.405 37.766 -122.4002 37.755",
]


def seed_map_json() -> str:
    """The seed graph as one JSON object keyed by node id (neighbor coordinates = the node's)."""
    doc = {}
    for k, (lat, lon) in SEED_NODES.items():
        doc[k] = {"lat": lat, "lon": lon, "neighbors_in": [], "neighbors_out": []}
    for s, d, w in SEED_EDGES:
        doc[s]["neighbors_out"].append({"id": d, "lat": SEED_NODES[d][0], "lon": SEED_NODES[d][1], "weight": w})
        doc[d]["neighbors_in"].append({"id": s, "lat": SEED_NODES[s][0], "lon": SEED_NODES[s][1], "weight": w})
    return json.dumps(doc, sort_keys=True)
