"""Fill-in-middle against slicing a list of units."""

import hashlib
import re

import pytest
from hypothesis import given, settings, strategies as st

from helixspan.llm import fim

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
UNIT = re.compile(r"[A-Za-z]+|[^A-Za-z]", re.S)


def brute(doc_id, text):
    text = text or ""
    units = UNIT.findall(text)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[i : i + 8], 16) for i in (0, 8, 16, 24)]
    a, b = sorted(x % (len(units) + 1) for x in h[:2])
    prefix, middle, suffix = ("".join(units[i:j]) for i, j in ((0, a), (a, b), (b, None)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return len(units), "plain", None, None, text
    if h[3] % 100 < 20:
        return len(units), "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return len(units), "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


TEXTS = st.text(st.one_of(st.sampled_from("abZ <>PSM\n0é漢"), st.characters(exclude_categories=["Cs"])), max_size=80)


@settings(max_examples=400, deadline=None)
@given(TEXTS, st.integers(0, 500), st.integers(1, 9))
def test_rearranged_as_by_slicing_and_back(text, doc_id, block):
    got = fim.rearrange(doc_id, text, block=block)
    assert got == brute(doc_id, text)
    assert fim.rebuild(got[-1], got[1]) == text


@settings(max_examples=200, deadline=None)
@given(TEXTS, st.integers(1, 9))
def test_every_cut_is_found(text, block):
    tree = fim.BlockTree(text, block)
    units = UNIT.findall(text)
    assert tree.units == len(units)
    for u in range(len(units) + 1):
        assert tree.cut(u) == len("".join(units[:u]))


def test_tables_with_odd_rows(table):
    rows = [
        (1, None), (2, ""), (3, "one two\n\nthree"), (3, "one two\n\nthree"), (None, "x y z " * 50),
        (2**53 + 1, "ünï cödé 漢字 \U0001f600! " * 30), (7, "has <S> inside"), (8, "word " * 100_000), (9, "a" * 50_000),
    ]
    docs = table([(i, t, "en", "a", 0, "other", 5) for i, t in rows], f"{DOCS}, `Text` string, form int")
    made = fim.restore(fim.transform(docs)).collect()
    key = lambda r: (r[0] is None, r[0] or 0)
    found = sorted(((r["doc_id"], r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) for r in made), key=key)
    assert found == sorted(((i, *brute(i, t)) for i, t in rows), key=key)
    assert sorted(r["text"] for r in made) == sorted(t or "" for _, t in rows)
    digests = {r["doc_id"]: (r["output_sha256"], r["restored_sha256"]) for r in fim.digest_table(docs).collect()}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert digests == {i: (sha(brute(i, t)[-1]), sha(t or "")) for i, t in rows}


def test_empty_table(table):
    assert fim.digest_table(table([], DOCS)).count() == 0 == fim.transform(table([], DOCS)).count()


@pytest.mark.parametrize("form", ["psm", "spm"])
def test_all_forms_occur(form):
    assert form in {fim.rearrange(i, "some words here")[1] for i in range(40)}
