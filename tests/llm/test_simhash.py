"""SimHash components against all pairs."""

import random
import re

import pytest
import xxhash
from hypothesis import given, settings, strategies as st

from helixspan.llm import simhash

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_print(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(lower)
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)] * bool(words)
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << i for i in range(64) if 2 * sum(x >> i & 1 for x in h) > len(h))


def brute_components(prints):
    """print -> smallest print reachable, over all pairs."""
    parent = {p: p for p in prints}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    order = sorted(parent)
    for i, a in enumerate(order):
        for b in order[:i]:
            if (a ^ b).bit_count() <= 3 and (one := root(a)) != (two := root(b)):
                parent[max(one, two)] = min(one, two)
    return {p: root(p) for p in parent}


def signed(x):
    return x - (1 << 64) if x >> 63 else x


@settings(max_examples=200, deadline=None)
@given(st.text(st.one_of(st.sampled_from("aBZ \t\n\x0b\x1c\x85é漢"), st.characters(exclude_categories=["Cs"])), max_size=60))
def test_fingerprint_of_any_text(text):
    assert simhash.fingerprint(text) == signed(brute_print(text))


def test_fingerprint_over_several_blocks(monkeypatch):
    text = " ".join(random.Random(1).choices("abcdefghij", k=500))
    want = simhash.fingerprint(text)
    assert want == signed(brute_print(text))
    monkeypatch.setattr(simhash, "HASHES", 7)
    assert simhash.fingerprint(text) == want


def flipped(draw, p, n):
    for i in draw.sample(range(64), n):
        p ^= 1 << i
    return p


def clusters(seed):
    """Chains, dense groups around a centre, neighbours at 3 and at 4 bits, extremes."""
    draw = random.Random(seed)
    found = {0, (1 << 64) - 1, 1, 7, 15, 1 << 63, (1 << 64) - 8}
    for _ in range(60):
        p = draw.getrandbits(64)
        found |= {p, flipped(draw, p, 3), flipped(draw, p, 4)}
    for _ in range(5):
        p = draw.getrandbits(64)
        for _ in range(20):
            found.add(p := flipped(draw, p, draw.choice([1, 2, 3])))
    centre = draw.getrandbits(64)
    noisy = draw.sample(range(64), 14)
    for _ in range(250):
        p = centre
        for i in draw.sample(noisy, draw.randint(0, 7)):
            p ^= 1 << i
        found.add(p)
    return sorted(found)


@pytest.mark.parametrize(("seed", "wide"), [(1, simhash.WIDE), (2, 0)])
def test_components_equal_all_pairs(spark, seed, wide):
    prints = clusters(seed)
    frame = spark.createDataFrame([(signed(p), 1 + p % 3) for p in prints], "print long, n_docs long")
    found = {r["node"]: r["component"] for r in simhash.print_components(frame, wide).collect()}
    want = brute_components(prints)
    groups = {}
    for p in prints:
        groups.setdefault(want[p], set()).add(signed(p))
    got = {}
    for p in map(signed, prints):
        got.setdefault(found.get(p, p), set()).add(p)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, groups.values()))


def test_every_near_pair_meets(spark):
    """All pairs within three bits share a home or a cell one step above, whatever bits differ."""
    draw = random.Random(3)
    pairs = [(p, flipped(draw, p, n)) for n in (1, 2, 3) for p in (draw.getrandbits(64) for _ in range(150))]
    prints = {signed(x) for pair in pairs for x in pair}
    frame = spark.createDataFrame([(p, 1) for p in prints], "print long, n_docs long")
    homes, cells = {}, {}
    for r in simhash.grid(frame).collect():
        (homes if r["home"] else cells).setdefault(r["print"], set()).add(r["cell"])
    for a, b in ((signed(x), signed(y)) for x, y in pairs):
        own = homes[a] & homes[b], homes[a] & cells.get(b, set()), homes[b] & cells.get(a, set())
        assert any(own)


TEXT = "the house by the river was old and the garden around it had grown wild over many years"
ROWS = [
    (5, TEXT), (3, TEXT.upper()), (3, TEXT.upper()), (9, None), (8, ""), (None, " \n "), (7, "two words"),
    (None, "only a row without id"), (12, "One"), (13, "one"), (2**53 + 1, "x y " * 60_000), (2**53, "x  y\n" * 60_000),
]


def test_documents_with_odd_rows(table):
    docs = table([(i, t, "en", "a", 0, "other", 4) for i, t in ROWS], f"{DOCS}, `Text` string, component int")
    prints = {i: brute_print(t) for i, t in enumerate(t for _, t in ROWS)}
    root = brute_components(set(prints.values()))
    least = {}
    for i, (doc_id, _) in enumerate(ROWS):
        if doc_id is not None:
            c = root[prints[i]]
            least[c] = min(least.get(c, doc_id), doc_id)
    want = [(doc_id, f"{prints[i]:016x}", least.get(root[prints[i]])) for i, (doc_id, _) in enumerate(ROWS)]
    found = simhash.near_components(docs).collect()
    order = lambda rows: sorted(map(tuple, rows), key=str)
    assert order(found) == order(want)


def test_empty_table(table):
    assert simhash.near_components(table([], DOCS)).count() == 0


def test_near_copies_of_a_corpus(spark):
    """Every document of the small tables, against all pairs."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}
    prints = {i: brute_print(t) for i, t in texts.items()}
    root = brute_components(set(prints.values()))
    least = {}
    for i, p in prints.items():
        least[root[p]] = min(least.get(root[p], i), i)
    found = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in simhash.near_components(docs).collect()}
    assert found == {i: (f"{p:016x}", least[root[p]]) for i, p in prints.items()}
