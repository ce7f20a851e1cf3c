"""A writer of small extracts, for tests."""

import struct
import zlib


def varint(v):
    out = bytearray()
    while True:
        out.append(v & 127 | (128 if v > 127 else 0))
        v >>= 7
        if not v:
            return bytes(out)


def zigzag(v):
    return v << 1 if v >= 0 else (-v << 1) - 1


def num(n, v):
    return varint(n << 3) + varint(v)


def data(n, v):
    return varint(n << 3 | 2) + varint(len(v)) + v


def packed(n, values):
    return data(n, b"".join(map(varint, values)))


def deltas(n, values):
    return packed(n, [zigzag(b - a) for a, b in zip([0, *values], values, strict=False)])


def blob(kind, raw):
    body = num(2, len(raw)) + data(3, zlib.compress(raw))
    head = data(1, kind.encode()) + num(3, len(body))
    return struct.pack(">I", len(head)) + head + body


def write(path, nodes, ways, relations, header=None):
    """nodes: id -> (lon, lat); ways: id -> (nodes, tags); relations: id -> (version, [(type, ref, role)], tags)."""
    strings = [""]

    def s(text):
        if text not in strings:
            strings.append(text)
        return strings.index(text)

    ids = sorted(nodes)
    whole = lambda v: round(v * 1e7)
    dense = deltas(1, ids) + deltas(8, [whole(nodes[i][1]) for i in ids]) + deltas(9, [whole(nodes[i][0]) for i in ids])
    lines = b"".join(data(3, num(1, i) + packed(2, [s(k) for k in t]) + packed(3, [s(v) for v in t.values()]) + deltas(8, n)) for i, (n, t) in sorted(ways.items()))
    kinds = ["node", "way", "relation"]
    groups = b"".join(
        data(4, num(1, i) + packed(2, [s(k) for k in t]) + packed(3, [s(v) for v in t.values()]) + data(4, num(1, v)) + packed(8, [s(r) for _, _, r in m]) + deltas(9, [r for _, r, _ in m]) + packed(10, [kinds.index(k) for k, _, _ in m]))
        for i, (v, m, t) in sorted(relations.items())
    )
    block = lambda group: blob("OSMData", data(1, b"".join(data(1, x.encode()) for x in strings)) + data(2, group))
    fields = b"".join(num(n, v) if isinstance(v, int) else data(n, v.encode()) for n, v in (header or {}).items())
    path.write_bytes(blob("OSMHeader", fields) + block(data(2, dense)) + block(lines) + block(groups))
