"""Secret scans: the automaton against Python's regexes, its limits, and whole frames."""

from __future__ import annotations

import hashlib
import random
import re

import cases
import pytest

from remanente.llm import secrets

FORMS = [
    (re.compile(
        r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A
    ), 1, 12),
    (re.compile("(AKIA[A-Z0-9]+)"), 1, 18),
    (re.compile("([0-9a-f]+)"), 1, 16),
]
PIECES = (
    "password passwd Secret ToKen api_key apikey api AKIA ghp_ sk_live_ xoxb- AIza eyJ RSA - . = : ' \" _ "
    "é ſ K 0123456789abcdef a f Z9 deadbeef ABCDEFGHIJKLMN +/ sec tok pass xyz"
).split() + [" ", "  ", "\n", "-----BEGIN ", " PRIVATE KEY-----", ""]


def plain(text: str) -> list[tuple[int, int, int]]:
    return sorted(
        (m.start(), k, m.end())
        for k, (form, group, least) in enumerate(FORMS)
        for m in form.finditer(text)
        if len(m[group]) >= least
    )


@pytest.fixture(scope="module")
def automaton():
    return secrets.Automaton((*secrets.BASE, *secrets.ADDED))


def test_base_spans_equal_the_plain_patterns(automaton):
    draw = random.Random(5)
    for _ in range(20_000):
        text = "".join(draw.choice(PIECES) for _ in range(draw.randrange(30)))
        assert [s for s in automaton.spans(text) if s[1] < 3] == plain(text), text


def test_failing_match_is_consumed_not_retried(automaton):
    text = "token=token:abcdefghijklmnop"
    assert plain(text) == [] == automaton.spans(text)
    assert automaton.spans("token=token=abcdefghijklmnop") == [(0, 0, 28)]


@pytest.mark.parametrize(
    ("kind", "text"),
    [
        ("github", "ghp_" + "aB3" * 12),
        ("stripe", "sk_live_" + "Zz9" * 6),
        ("slack", "xoxb-12345-abcdeZ"),
        ("google", "AIza" + "Q_x-9" * 7),
        ("jwt", "eyJhbGci.eyJzdWIi.c2lnbmF0dXJlLWhlcmU"),
        ("private_key", "-----BEGIN RSA PRIVATE KEY-----"),
    ],
)
def test_added_forms(automaton, kind, text):
    found = [(a, automaton.rules[r].name, b) for a, r, b in automaton.spans(f"é {text}!")]
    assert (2, kind, 2 + len(text)) in found
    assert all(name != kind for _, name, _ in
               [(a, automaton.rules[r].name, b) for a, r, b in automaton.spans(text[:-1][:12])])


def test_merging_keeps_what_every_state_does():
    rules = (secrets.Rule("x", "ab+"), secrets.Rule("y", "(ab|cb)c"))
    small = secrets.Automaton(rules)
    assert len(small.next) < 20
    draw = random.Random(1)
    for _ in range(3000):
        text = "".join(draw.choice("abcd") for _ in range(draw.randrange(12)))
        want = sorted(
            [(m.start(), 0, m.end()) for m in re.finditer("ab+", text)]
            + [(m.start(), 1, m.end()) for m in re.finditer("(?:ab|cb)c", text)]
        )
        assert small.spans(text) == want, text


def test_rules_that_need_a_way_back_are_refused():
    with pytest.raises(ValueError, match="without matching"):
        secrets.Automaton([secrets.Rule("x", "a(bc)?")])
    with pytest.raises(ValueError, match="earlier attempt"):
        secrets.Automaton([secrets.Rule("x", "ab+c|b")])
    with pytest.raises(ValueError, match="empty text"):
        secrets.Automaton([secrets.Rule("x", "a*")])
    with pytest.raises(ValueError, match="not supported"):
        secrets.Automaton([secrets.Rule("x", "a.b")])


def test_rows(spark):
    secret = "password = 'hunter2hunter2'"
    found = [(1, f"é{secret}"), (2, None), (3, ""), (3, secret), (4, "word " * 40_000 + "deadbeef" * 3)]
    docs = cases.crowded(cases.documents(spark, found), "spans", "n_hex", "n_added")
    rows = sorted(secrets.scan(docs).collect(), key=lambda r: (r.doc_id, r.spans))
    assert [r.spans for r in rows] == ["assign:1:27", "", "", "assign:0:26", "hex:200000:200024"]
    assert [r.n_assign for r in rows] == [1, 0, 0, 1, 0]
    assert rows[0].base_sha256 == hashlib.sha256(b"assign:1:27").hexdigest()
    assert rows[1].base_sha256 == hashlib.sha256(b"").hexdigest()
    assert secrets.scan(cases.nothing(spark)).collect() == []
