"""Benchmark windows, SimHash components and Order MinHash against brute force."""

import hashlib
import re

import numpy as np
import pytest
import xxhash

from tests.llm.conftest import ODD
from veldtab.llm import decontaminate, order_minhash, simhash
from veldtab.llm.common import connected_components, table

SF = "/root/testdata/sf0.001"
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
TOKENS = re.compile(r"[^\x20\x09-\x0D]+")


def brute_windows(text, items):
    w = WORDS.findall((text or "").translate(LOW))
    hit, ids = set(), set()
    for item, body in items:
        b = WORDS.findall((body or "").translate(LOW))
        m = min(10, len(b))
        for i in range(len(b) - m + 1 if m else 0):
            for s in range(len(w) - m + 1):
                if w[s:s + m] == b[i:i + m]:
                    hit.update(range(s, s + m))
                    ids.add("" if item is None else str(item))
    return len(w), len(hit), sorted(ids)


@pytest.mark.parametrize("block_rows", [2, 1000])
def test_windows_like_brute_force(spark, odd, block_rows):
    items = [(1, "words again AND again"), (2, "one two three four"), (None, "row"), (4, None), (5, "..."), (6, "word " * 12), (7, "same words"), (8, "same words")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = sorted((r.id is None, r.id or 0, r.n_words, r.n_hit, list(r["items"]), r.contaminated) for r in decontaminate.find_windows(odd, bench, block_rows=block_rows).collect())
    want = sorted((d[0] is None, d[0] or 0, *brute_windows(d[1], items), brute_windows(d[1], items)[1] > 0) for d in ODD)
    assert got == want
    kept = decontaminate.decontaminate(odd, bench, block_rows=block_rows)
    assert kept.columns == odd.columns and kept.count() == sum(not w[-1] for w in want)


def test_windows_without_rows(spark, odd, none):
    empty = spark.createDataFrame([], "item_id long, text string")
    assert not any(r.contaminated for r in decontaminate.find_windows(odd, empty).collect())
    assert decontaminate.find_windows(none, empty).count() == 0


def brute_fingerprint(text):
    w = TOKENS.findall((text or "").translate(LOW))
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(w[i:i + 4]).encode(), 42) for i in range(max(1, len(w) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in h) > len(h))


def brute_components(fps):
    """fps: list of (id, fingerprint)."""
    parent = list(range(len(fps)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i in range(len(fps)):
        for j in range(i):
            if (fps[i][1] ^ fps[j][1]).bit_count() <= 4:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    least = {}
    for i, (d, _) in enumerate(fps):
        r = find(i)
        least[r] = min(least.get(r, d), d)
    return sorted((d, f"{f:016x}", least[find(i)]) for i, (d, f) in enumerate(fps))


def test_components_like_brute_force(spark):
    got = sorted(tuple(r) for r in simhash.op6_simhash_components(spark, SF).collect())
    assert got == brute_components([(r.doc_id, brute_fingerprint(r.text)) for r in table(spark, SF, "documents").collect()])


def test_links_find_every_pair_within_four_bits(spark):
    rng = np.random.default_rng(1)
    base = [int(x) for x in rng.integers(0, 1 << 63, 6)]
    fps = {b ^ sum(1 << int(k) for k in rng.choice(64, n, replace=False)) for b in base for n in (0, 1, 2, 3, 4, 5, 6, 8) for _ in range(6)}
    fps |= {(1 << 63) | 5, (1 << 64) - 1, 0, 1}
    signed = [(f - (1 << 64) if f >> 63 else f,) for f in fps]
    links = simhash.links(spark.createDataFrame(signed, "fp long"))
    found = {r.node: r.component for r in connected_components(links).collect()}
    want = {}
    for d, f, c in brute_components([(s[0], s[0] & (1 << 64) - 1) for s in sorted(signed)]):
        want.setdefault(c, set()).add(d)
    got = {}
    for (s,) in signed:
        got.setdefault(found.get(s, s), set()).add(s)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_meeting_in_parts(monkeypatch):
    rng = np.random.default_rng(2)
    fps = rng.integers(0, 1 << 63, 40).astype(np.uint64)
    fps = np.unique(np.concatenate((fps, fps ^ np.uint64(0b1011))))
    masks = simhash._masks(32, 2)
    upper = ((fps >> np.uint64(32))[:, None] ^ masks[None, :]).ravel()
    owner = np.repeat(fps, len(masks))
    whole = simhash._forest(*simhash._meet(upper, owner, 2, 4))
    monkeypatch.setattr(simhash, "VARIANTS_AT_ONCE", 10_000)
    parts = simhash._forest(*simhash._meet(upper, owner, 2, 4))
    assert len(whole[0]) == len(parts[0]) >= 40


def test_odd_rows_and_empty_tables(spark, odd, none):
    got = sorted(tuple(r) for r in simhash.near_duplicates(odd.where("doc_id IS NOT NULL")).collect())
    want = [(d, int(f, 16), c) for d, f, c in brute_components([(d[0], brute_fingerprint(d[1])) for d in ODD if d[0] is not None])]
    assert [(d, f & (1 << 64) - 1, c) for d, f, c in got] == want
    kept = simhash.drop_near_duplicates(odd)
    assert kept.columns == odd.columns
    assert sorted(r.doc_id for r in kept.where("doc_id IS NOT NULL").collect()) == sorted({c for _, _, c in want})
    assert kept.where("doc_id IS NULL").count() == 1
    assert simhash.near_duplicates(none).count() == 0 and simhash.drop_near_duplicates(none).count() == 0


def test_components_of_chains_and_hubs(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 160)] + [(200, 200), (7, 7), (300, 301), (301, 300)]
    got = dict(tuple(r) for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect())
    want = {i: 0 for i in range(61)} | {i: 100 for i in range(100, 160)} | {300: 300, 301: 300}
    assert got == want
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


def plain_order_minhash(text):
    """The same sketch without vectors: occurrence-numbered k-mers, the two smallest per bin, in text order."""
    data = text.encode()
    h = [int(x) for x in order_minhash.kmer_hashes(data)]
    one = lambda x: int(order_minhash._mix(np.array([x & (1 << 64) - 1], np.uint64))[0])
    m1, seen, bins = int(order_minhash._M1), {}, {}
    bits = max(1, len(h).bit_length())
    for place, x in enumerate(h):
        seen[x >> bits] = seen.get(x >> bits, -1) + 1
        mixed = one(x + (seen[x >> bits] + 1) * m1)
        bins.setdefault(mixed >> 58, []).append((mixed, place))
    out = ""
    for b in range(64):
        chosen = sorted(p for _, p in sorted(bins.get(b, []))[:2])
        value = 0x51ED270B
        for x in ([h[p] for p in chosen] + [0, 0])[:2]:
            value = one((value * m1 & (1 << 64) - 1) ^ x)
        out += f"{value >> 48:04x}" if chosen else order_minhash.EMPTY
    return out


def test_order_minhash(spark, odd, none):
    rows = sorted(((d[0] is not None, d[0] or 0, d[1] or "") for d in ODD), key=lambda r: r[:2])
    got = sorted(order_minhash.compare_edits(odd).collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0))
    assert [r.doc_id for r in got] == [r[1] if r[0] else None for r in rows]
    for i, r in enumerate(got):
        text, following = rows[i][2], rows[(i + 1) % len(rows)][2]
        n = len(text) // 4
        edited = text[:len(text) - n] + following[:n]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert r.fingerprint == order_minhash.fingerprint(text.encode()) and r.edited_fingerprint == order_minhash.fingerprint(edited.encode())
        assert r.near_edited == order_minhash.likeness(r.fingerprint, r.edited_fingerprint)
        assert r.near_next == order_minhash.likeness(r.fingerprint, order_minhash.fingerprint(following.encode()))
    for text in ("", "a", "short text", rows[-1][2], "abcabcabc " * 40, "word " * 2000):
        assert order_minhash.fingerprint(text.encode()) == (plain_order_minhash(text) if text else order_minhash.EMPTY * 64)
    assert order_minhash.compare_edits(none).count() == 0 and order_minhash.fingerprints(none).count() == 0


def test_edits_stay_near(spark):
    rows = order_minhash.op10_order_minhash(spark, SF).collect()
    assert len(rows) == table(spark, SF, "documents").count()
    assert min(r.near_edited for r in rows) > 0.1 and max(r.near_next for r in rows) < 0.1
