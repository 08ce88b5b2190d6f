"""Exact dedup, sharding and licence scans against plain Python."""

import hashlib
import re
import struct
import textwrap
import zlib
from collections import Counter, defaultdict

import pytest
import xxhash
from pyspark.sql import functions as F

from pagemill.llm import common, exact_dedup, licenses, sharding

PAIRS = [(1, "a b"), (2, "ab"), (3, "a\tb\n"), (4, None), (5, ""), (6, " \x0b\x0c\r"), (7, "a b"), (8, "ab"), (8, "ab"), (None, "ab"), (None, "alone"), (9, "x" * 200_000), (10, "x" * 200_000 + " ")]


def expected_dedup(pairs):
    groups = defaultdict(list)
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]", "", t or "")
    for i, t in pairs:
        groups[norm(t)].append((i, t or ""))
    out = []
    for i, t in pairs:
        members = groups[norm(t)]
        best = max(members, key=lambda m: (len(m[1]), -(m[0] if m[0] is not None else 1 << 64)))[0]
        out.append((i, best, len(members), i == best, hashlib.sha256(norm(t).encode()).hexdigest()))
    return Counter(out)


def test_exact_dedup_matches_plain_python(docs_of):
    assert Counter(map(tuple, exact_dedup.exact_dedup(docs_of(PAIRS)).collect())) == expected_dedup(PAIRS)


def test_exact_dedup_of_negative_and_extreme_ids(docs_of):
    low, high = -(1 << 63), (1 << 63) - 1
    pairs = [(-5, "x"), (3, "x"), (high, "y"), (None, "y"), (low, "z"), (low, "z "), (0, "z"), (None, "w"), (None, "w"), (high, "v"), (-1, " v")]
    assert Counter(map(tuple, exact_dedup.exact_dedup(docs_of(pairs)).collect())) == expected_dedup(pairs)
    kept = exact_dedup.drop_duplicates(docs_of(pairs)).collect()
    assert Counter((r.doc_id, r.text) for r in kept) == Counter([(-5, "x"), (high, "y"), (low, "z "), (None, "w"), (-1, " v")])


def test_exact_dedup_of_a_hot_group_and_many_ids(docs_of, monkeypatch):
    pairs = [(k - 500 if k % 7 else None, "the same" if k % 3 == 0 else f"text {k // 2}") for k in range(3000)]
    monkeypatch.setattr(common, "HOT", 10)
    rows = exact_dedup.exact_dedup(docs_of(pairs)).collect()
    assert Counter(map(tuple, rows)) == expected_dedup(pairs)


def test_exact_dedup_compares_content_when_digests_clash(docs_of):
    weak = lambda c: F.pmod(F.crc32(F.encode(c, "UTF-8")), F.lit(2))
    assert Counter(map(tuple, exact_dedup.exact_dedup(docs_of(PAIRS), digest=weak, salts=2).collect())) == expected_dedup(PAIRS)


def test_drop_duplicates_keeps_one_row_a_text(docs_of):
    docs = docs_of(PAIRS, "doc_id long, text string, digest string, content int, row int, __digest string, __doc_id int, chars string, k_digest int, `a.b` string")
    kept = exact_dedup.drop_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0, len(r.text or "")) for r in kept.collect()) == [(0, 5), (3, 4), (6, 4), (7, 3), (10, 200_001)]


def test_empty_tables(docs_of):
    empty = docs_of([])
    assert exact_dedup.exact_dedup(empty).count() == 0
    assert exact_dedup.drop_duplicates(empty).count() == 0
    assert sharding.assign(empty).count() == 0
    assert licenses.license_scan(empty).count() == 0


def rows_by_shard(rows):
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    return slots


def test_shards_are_balanced_and_gapless(docs_of):
    pairs = [(i, "t" * (i % 7)) for i in range(1003)] + [(5, "again"), (5, "again"), (None, None), (None, None)]
    rows = sharding.assign(docs_of(pairs)).collect()
    slots = rows_by_shard(rows)
    counts = [len(slots[s]) for s in range(8)]
    assert sum(counts) == len(pairs) and max(counts) - min(counts) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in rows) == Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in pairs)
    assert {r.law for r in rows} == {"rows"}


def test_one_key_with_a_third_of_the_rows_overflows_clockwise(docs_of):
    slots = rows_by_shard(sharding.assign(docs_of([(1, str(i)) for i in range(100)] + [(i, "") for i in range(2, 202)])).collect())
    assert {len(v) for v in slots.values()} <= {37, 38}


def plain_cell(doc_id, cells=sharding.CELLS):
    """Spark's xxhash64 of a long: seed 42, and 42 itself for a null."""
    h = 42 if doc_id is None else xxhash.xxh64_intdigest(struct.pack("<q", doc_id), seed=42)
    return h % cells if h < 1 << 63 else (h - (1 << 64)) % cells


def plain_placement(pairs, nodes, shards=8):
    """How many rows of each doc_id each shard gets, row by row: one wave after the other, from node to node, clockwise."""
    room = [len(pairs) // shards + (s < len(pairs) % shards) for s in range(shards)]
    waiting = defaultdict(list)
    for i, t in pairs:
        waiting[plain_cell(i)].append((i is not None, i or 0, zlib.crc32((t or "").encode()), len((t or "").encode())))
    at = {cell: next((k for k, n in enumerate(nodes) if n[0] >= cell), 0) for cell in waiting}
    placed = Counter()
    while waiting:
        after = {}
        for cell in sorted(waiting):
            while not room[nodes[at[cell]][1]]:
                at[cell] = (at[cell] + 1) % len(nodes)
            shard, rows = nodes[at[cell]][1], sorted(waiting[cell])
            took, left = rows[: room[shard]], rows[room[shard] :]
            room[shard] -= len(took)
            placed.update((r[1] if r[0] else None, r[2], shard) for r in took)
            if left:
                after[cell] = left
                at[cell] = (at[cell] + 1) % len(nodes)
        waiting = after
    return placed


def test_every_row_goes_where_a_plain_walk_puts_it(docs_of, spark, monkeypatch):
    monkeypatch.setattr(sharding, "HOT", 50)
    pairs = [(i * 7919 - 3000, f"text {i % 11}") for i in range(900)] + [(i, "x") for i in range(5)] * 3
    nodes = sharding.ring(spark, 8)
    rows = sharding.assign(docs_of(pairs)).collect()
    assert Counter((r.doc_id, r.text_crc32, r.shard) for r in rows) == plain_placement(pairs, nodes)


@pytest.mark.parametrize("same", [True, False])
def test_a_hot_key_is_ranked_in_buckets(docs_of, monkeypatch, same):
    """A third of the rows without a doc_id, all alike or all different, and one row that is repeated."""
    monkeypatch.setattr(sharding, "HOT", 20)
    pairs = [(i, "t") for i in range(600)] + [(None, "same" if same else f"text {i}") for i in range(400)] + [(7, "often")] * 200
    rows = sharding.assign(docs_of(pairs)).collect()
    slots = rows_by_shard(rows)
    assert all(sorted(v) == list(range(150)) for v in slots.values()) and len(slots) == 8
    assert Counter((r.doc_id, r.text_crc32) for r in rows) == Counter((i, zlib.crc32(t.encode())) for i, t in pairs)


def at_home(counts, nodes):
    """Every key at the shard of the first virtual node at or after its cell."""
    return Counter({(cell, next((s for place, s, _ in nodes if place >= cell), nodes[0][1])): n for cell, n in counts.items() if n})


def test_walk_fills_every_shard_to_its_bound(spark):
    nodes = sharding.ring(spark, 4, 16, 256)
    counts = {c: (c * 7) % 5 for c in range(256)}
    n = sum(counts.values())
    pieces = sharding.walk(counts, nodes, sharding.bounds(n, 4))
    filled = Counter()
    for cell, first, end, shard, slot in sorted(pieces, key=lambda p: (p[3], p[4])):
        assert slot == filled[shard]
        filled[shard] += end - first
    assert sorted(filled.values()) == sorted(sharding.bounds(n, 4))
    ranks = defaultdict(list)
    for cell, first, end, *_ in pieces:
        ranks[cell] += range(first, end)
    assert {c: len(r) for c, r in ranks.items()} == {c: k for c, k in counts.items() if k}
    assert all(sorted(r) == list(range(len(r))) for r in ranks.values())
    # with room for all, everyone stays at home
    home = Counter()
    for cell, first, end, shard, _ in sharding.walk(counts, nodes, [n] * 4):
        home[(cell, shard)] += end - first
    assert home == at_home(counts, nodes)


def test_a_new_shard_moves_few_keys(docs_of):
    docs = docs_of([(i, "") for i in range(4000)])
    before, after = ({r.doc_id: r.shard for r in sharding.assign(docs, shards=s, slack=0.25).collect()} for s in (8, 9))
    assert sum(before[i] != after[i] for i in before) < 0.35 * len(before)
    assert max(Counter(after.values()).values()) <= 1.25 * 4000 / 9 + 1


def plain_scan(text):
    words = licenses.words_of(text or "")
    starts, labels = [], set()
    for phrase, label in licenses.PHRASES.items():
        p = phrase.split()
        hits = [i for i in range(len(words)) if words[i : i + len(p)] == p]
        starts += hits
        labels |= {label} if hits else set()
    best, own = 0.0, set()
    for label, t in licenses.TEMPLATES.items():
        own_words = licenses.words_of(t)
        wide = 8
        while wide < len(own_words):
            wide *= 2
        for at in range(0, len(words), wide):
            share = len(set(words[at : at + 2 * wide]) & set(own_words)) / len(set(own_words))
            if share >= licenses.THRESHOLD - 1e-12:
                own.add(label)
                best = max(best, share)
    return (len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels)), ",".join(sorted(labels | own)), max(best, 1.0 if starts else 0.0))


def test_license_scan_matches_plain_python(docs_of):
    texts = [
        None, "", "MIT License", "x\nmit  license.MIT-License mit license", "amit license mit licensed", "KMIT License émit license", "cc\nby",
        "Licensed under CC BY-NC 4.0.\nother", "GNU General,Public License v3", "apache license\n" * 3, "license mit " * 50_000,
        "redistribution and use in source or binary forms, with or without modification, are permitted if the following conditions are met",
        "Permission is hereby granted, free of charge, to anyone obtaining a copy of this software and documentation files, to deal in the Software without restriction",
        "released under license", "\x80mit license \x7fmit license", "the of and in this is to free software " * 40,
        *("words before " * k + textwrap.fill(licenses.TEMPLATES[label], 40, initial_indent=mark, subsequent_indent=mark) + "\nwords after" * k for k in (0, 9, 60) for label in ("mit-text", "bsd-text", "gpl-notice") for mark in ("", " * ", "# ")),
    ]
    assert all(plain_scan(t)[5] for t in texts[-27:])  # wrapped and commented notices are found
    pairs = list(enumerate(texts)) + [(2, "MIT License"), (None, "CC BY"), (None, None), (None, "Released under the MIT")]
    rows = licenses.license_scan(docs_of(pairs)).collect()
    assert Counter(map(tuple, rows)) == Counter((i, *plain_scan(t)) for i, t in pairs)
    alone = licenses.license_scan(docs_of(pairs), templates={}).collect()
    assert {(r.doc_id, r.labels) for r in alone} == {(i, plain_scan(t)[4]) for i, t in pairs}
    assert {r.base_labels for r in licenses.license_scan(docs_of(pairs), phrases={}).collect()} == {""}
