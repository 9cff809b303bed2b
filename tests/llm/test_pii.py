import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyloom.llm import pii

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def valid(kind, text):
    digits = re.sub("[^0-9]", "", text)
    return {
        "email": lambda: True,
        "ip": lambda: all(int(p) <= 255 for p in text.split(".")),
        "card": lambda: 16 <= len(digits) <= 19 and pii.luhn(digits),
        "phone": lambda: 8 <= len(digits) <= 15,
    }[kind]()


def brute(text):
    return {
        kind: [m.span() for m in re.finditer(p, text) if valid(kind, m[0])]
        for kind, p in PATTERNS.items()
    }


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="a@.-+() 019é\n", max_size=60))
def test_patterns(text):
    assert pii.base_spans(text) == brute(text)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sampled_from(["a@b.co", "1.2.3.4", "256.1.1.1", "4111111111111111", "4111-1111 1111 1111",
    "+1 (017) 555-7713", "..", "@", "x", "7", "٣", "+", "é@é.de"]), max_size=10).flatmap(
        lambda parts: st.sampled_from(["", " ", "-", ".", ", "]).map(lambda s: s.join(parts))))
def test_written_forms(text):
    assert pii.base_spans(text) == brute(text)


def test_long_runs_take_linear_time():
    for text in ("a" * 300_000, "0" * 300_000, "@" * 300_000, "+1((" * 80_000, "1." * 150_000, "a@" * 150_000):
        pii.base_spans(text)


def test_field_learns_its_table():
    field, wrong = pii.train(), 0
    for marked in pii.LABELLED:
        text, tokens, labels = pii._labelled(marked)
        wrong += list(field.decode([field.ids(pii._features(text, tokens))])[0]) != labels
    assert wrong <= 2


def added(text):
    (_, found), *_ = pii.find_spans([text], pii.train())
    return [(k, text[a:b]) for k in pii.KINDS for a, b in found[k]]


@pytest.mark.parametrize(
    ("text", "spans"),
    [
        ("write to sam.5 (at) mail9.example.org today", [("email", "sam.5 (at) mail9.example.org")]),
        ("phone (313) 555-0162 works", [("phone", "(313) 555-0162")]),
        ("tel. 505-555-0143 soon", [("phone", "505-555-0143")]),
        ("Version 2.0, section 4.1, pages 20-31", []),
        ("in 1987 we had 4000 and 12.5", []),
        ("a number 9807915762804490 stands here", []),
        ("plain words only", []),
    ],
)
def test_field_adds_loose_forms_only(text, spans):
    assert added(text) == spans


def test_viterbi_is_the_best_path():
    import itertools

    import numpy as np

    field = pii.train()
    text = "call (212) 555-0187"
    ids = field.ids(pii._features(text, pii._tokens(text)))[:4]
    emit, n = field.weights[ids].sum(axis=1), len(pii._LABELS)

    def score(path):
        steps = sum(field.pairs[a, b] + field.closed[a, b] for a, b in zip(path, path[1:]))
        return field.first[path[0]] + steps + sum(emit[i, x] for i, x in enumerate(path))

    best = max(itertools.product(range(n), repeat=4), key=score)
    got = field.decode([ids, ids[:2], ids[:0]])
    assert np.isclose(score(tuple(got[0])), score(best)) and len(got[1]) == 2 and len(got[2]) == 0


def test_rows(docs, odd):
    rows = list(odd) + [(1, "é +1 (017) 555-7713, a@b.co and 1.2.3.4"), (2, "(313) 555-0162 rang")]
    found = {r.doc_id: r for r in pii.personal_data(docs(rows).select("doc_id", "text")).collect()}
    assert found[1].base == found[1].spans == "email:21:27,ip:32:39,phone:2:19"
    assert (found[1].n_email, found[1].n_ip, found[1].n_card, found[1].n_phone) == (1, 1, 0, 1)
    assert (found[2].base, found[2].spans) == ("", "phone:0:14")
    assert all(r.spans == "" for i, r in found.items() if i not in (1, 2))
    assert pii.personal_data(docs([]).select("doc_id", "text")).count() == 0


def whole(text, field):
    """Spans of the field's best path over all tokens at once."""
    tokens = pii._tokens(text)
    (labels,) = field.decode([field.ids(pii._features(text, tokens))]) if tokens else ([],)
    taken = [s for spans in pii.base_spans(text).values() for s in spans]
    out, t = {kind: [] for kind in pii.KINDS}, 0
    while t < len(labels):
        begin, t = t, t + 1
        if labels[begin]:
            kind = pii.KINDS[(labels[begin] - 1) // 2]
            while t < len(labels) and labels[t] and labels[t] % 2 == 0:
                t += 1
            a, b = tokens[begin][0], tokens[t - 1][1]
            if pii._holds(kind, text[a:b]) and not pii._touches(taken, a, b):
                out[kind].append((a, b))
    return out


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["jo", "anna_b", "at", "(at)", "[at]", "@", "dot", "(dot)", "host", "example", "org",
    "mail3.example.org", "plain", "Words", "(212)", "555-0187", "4111", "192-168-17-45", "12", ".", ",", "é", "#"]),
    max_size=40).flatmap(lambda parts: st.sampled_from(["", " ", "  "]).map(lambda s: s.join(parts))))
def test_cuts_change_nothing(text):
    field = pii.train()
    (_, found), *_ = pii.find_spans([text], field)
    assert found == whole(text, field)


@pytest.mark.parametrize(
    "mail",
    [
        "anna (at) host (dot) example (dot) org",
        "kim [at] web [dot] example [dot] net",
        "maximiliana.konstantina.lindqvist.von.hohenberg (at) mail3.example.org",
    ],
)
def test_addresses_without_digits_or_longer_than_a_line(mail):
    assert added(f"write to {mail} today") == [("email", mail)]
    assert added("they went home at noon and a dot (at last) was left.") == []


def test_memory_of_a_long_table_is_bounded():
    import tracemalloc

    field, long = pii.train(), "12 7 305 " * 20_000
    pii.find_spans([long[:9000]], field)
    tracemalloc.start()
    pii.find_spans([long, *["call (212) 555-0187 now"] * 255], field)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 100e6
