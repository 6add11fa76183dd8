"""Plain step-by-step versions of the stateful operators, on lists of dicts."""

from __future__ import annotations

import random


# Streams take rows at or before the epoch as late, so times start later.
START = 1_000_000
CROWDED = START + 40_000


def visits(seed: int, n: int = 1500, hot: float = 0.4, devices: int = 25):
    """Random enters and leaves; one room is hot and many times are equal."""
    rng = random.Random(seed)
    return [
        {
            "id": i,
            "anchor_id": "hot" if rng.random() < hot else rng.choice("abcd"),
            "deviceId": f"d{rng.randrange(devices)}",
            "timestamp": CROWDED
            if rng.random() < 0.3
            else START + rng.randrange(0, 90) * 1000,
            "entered": rng.randrange(2),
        }
        for i in range(n)
    ]


VISIT_SCHEMA = (
    "id bigint, anchor_id string, deviceId string, timestamp bigint, entered int"
)


def in_order(events):
    return sorted(events, key=lambda e: (e["timestamp"], e["id"]))


def audience(events, floor):
    state, out = {}, []
    for e in in_order(events):
        s = state.setdefault(e["anchor_id"], {"uv": set(), "pv": 0, "online": 0})
        if e["entered"]:
            s["uv"].add(e["deviceId"])
            s["pv"] += 1
            s["online"] += 1
        else:
            s["online"] -= 1
            if floor:
                s["online"] = max(0, s["online"])
        out.append(
            (e["id"], e["timestamp"], e["anchor_id"], len(s["uv"]), s["pv"], s["online"])
        )
    return sorted(out)


def popular_ids(events, min_stay, gap):
    groups = {}
    for e in in_order(events):
        groups.setdefault((e["anchor_id"], e["deviceId"]), []).append(e)
    ids = []
    for group in groups.values():
        for i, e in enumerate(group):
            if not e["entered"]:
                continue
            t = e["timestamp"]
            later = [x["timestamp"] for x in group[i + 1 :] if not x["entered"]]
            earlier = [x["timestamp"] for x in group[:i] if not x["entered"]]
            if any(x - t < min_stay for x in later):
                continue
            if earlier and t - max(earlier) <= gap:
                continue
            ids.append(e["id"])
    return sorted(ids)


def first_seen(events, scope):
    seen, flags = set(), {}
    for e in in_order(events):
        key = tuple(e[c] for c in (*scope, "deviceId"))
        flags[e["id"]] = int(key not in seen)
        seen.add(key)
    return flags


def count_first_seen(events, key):
    flags, counts, out = first_seen(events, ()), {}, []
    for e in in_order(events):
        n = 0
        if flags[e["id"]]:
            n = counts[e[key]] = counts.get(e[key], 0) + 1
        out.append((e["id"], flags[e["id"]], n))
    return sorted(out)


def top3(events, size, slide):
    counts = {}
    for e in events:
        start = e["timestamp"] // slide * slide
        while start > e["timestamp"] - size:
            key = (e["categoryId"], e["eventId"], start)
            counts.setdefault(key, {})
            counts[key][e["productId"]] = counts[key].get(e["productId"], 0) + 1
            start -= slide
    out = []
    for (category, event, start), products in counts.items():
        best = sorted(products.items(), key=lambda p: (-p[1], p[0]))[:3]
        out += [
            (category, event, start, rank, product, n)
            for rank, (product, n) in enumerate(best, 1)
        ]
    return sorted(out)


def late_ids(events, size, delay):
    """Ids of late rows; ``events`` are in order of arrival."""
    highest, late = None, []
    for e in events:
        end = e["timestamp"] // size * size + size
        if highest is not None and end <= highest - delay:
            late.append(e["id"])
        highest = e["timestamp"] if highest is None else max(highest, e["timestamp"])
    return sorted(late)
