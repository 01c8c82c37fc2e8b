"""Decontamination, toxicity, personal data, URLs and fingerprints."""

from __future__ import annotations

import hashlib
import random
import re

import cases
import numpy as np
import pytest

from remanente.llm import decontaminate, paragraph_sketch, pii, toxicity, url_filter

ITEMS = "item_id long, text string"


def hit_places(doc: list, items: list, window: int) -> tuple[set, set]:
    places, names = set(), set()
    for name, words in items:
        size = min(window, len(words))
        for i in range(len(words) - size + 1 if size else 0):
            for j in range(len(doc) - size + 1):
                if doc[j : j + size] == words[i : i + size]:
                    places.update(range(j, j + size))
                    names.add(name)
    return places, names


def test_automaton_finds_every_window():
    draw = random.Random(2)
    for _ in range(1500):
        letters = [b"a", b"b", b"c", b"d"][: draw.randrange(1, 5)]
        window = draw.choice([2, 3, 4])
        items = [
            (str(i), [draw.choice(letters) for _ in range(draw.randrange(0, 9))])
            for i in range(draw.randrange(0, 5))
        ]
        doc = [draw.choice([*letters, b"x"]) for _ in range(draw.randrange(0, 40))]
        spans, names = decontaminate.SuffixAutomaton(items, window).hits(doc)
        got = {p for a, b in spans for p in range(a, b)}
        assert (got, names) == hit_places(doc, items, window)


def benchmark_case() -> tuple[list, list]:
    draw = random.Random(6)
    items = [(k, cases.prose(draw, n)) for k, n in enumerate([30, 13, 12, 5, 20, 20, 60])]
    items += [(7, None), (8, " .,!"), (9, "Une seule"), (10, items[0][1])]
    found = cases.rows(40)
    for k in range(20):
        words = cases.prose(draw, 20 + 15 * k).split(" ")
        part = (items[k % 7][1] or "").split(" ")
        at = draw.randrange(len(words))
        words[at:at] = [w.upper() if w.isascii() else w for w in part[: draw.randrange(10, 40)]]
        found.append((5000 + k, " ".join(words)))
    return found, items


def words_of(text: str | None) -> list[str]:
    lower = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


@pytest.mark.parametrize("limit", [100_000, 40])
def test_contamination_matches_brute_force(spark, limit, monkeypatch):
    found, items = benchmark_case()
    every = decontaminate.automata
    monkeypatch.setattr(decontaminate, "automata", lambda rows: every(rows, limit))
    docs, tests = cases.documents(spark, found), spark.createDataFrame(items, ITEMS)
    got = cases.as_dict(decontaminate.report(cases.crowded(docs, "hit_0", "n_hit"), tests))
    known = [(str(n), words_of(t)) for n, t in items]
    n_bad = 0
    for doc, text in found:
        words = words_of(text)
        places, names = hit_places(words, known, 13)
        row, bad = got[doc], bool(places) and 20 * len(places) >= len(words)
        assert (row["n_words"], row["n_hit"], row["n_items"]) == (len(words), len(places), len(names))
        assert row["items_sha256"] == hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
        assert row["contaminated"] == bad
        n_bad += bad
    assert n_bad > 3


def test_cleaning_drops_and_cuts(spark):
    found, items = benchmark_case()
    docs = cases.crowded(cases.documents(spark, found), "row", "spans", "hit_all")
    tests = spark.createDataFrame(items, ITEMS)
    judged = cases.as_dict(decontaminate.report(docs, tests))
    stay = decontaminate.cleaned(docs, tests)
    assert stay.columns == docs.columns
    rows = {r.doc_id: r for r in stay.collect()}
    assert set(rows) == {d for d, j in judged.items() if not j["contaminated"]}
    before = dict(found)
    for doc, row in rows.items():
        if judged[doc]["n_hit"]:
            assert len(words_of(row.text)) == judged[doc]["n_words"] - judged[doc]["n_hit"]
        else:
            assert row.text == before[doc]


def test_contamination_takes_empty_tables(spark):
    items = spark.createDataFrame([], ITEMS)
    docs = cases.documents(spark, cases.rows(5))
    assert {r.n_hit for r in decontaminate.report(docs, items).collect()} == {0}
    assert decontaminate.report(cases.nothing(spark), items).count() == 0
    assert decontaminate.without_words("Ab, cé d. E", [(1, 3)]) == "Ab, . E"


LABELS = "doc_id long, quality int, toxic int"


def toxic_case(n: int, seed: int) -> list[tuple[int, str, int]]:
    draw, out = random.Random(seed), []
    for k in range(n):
        words, bad = cases.prose(draw, draw.randrange(10, 400)).split(" "), k % 5 == 0
        for _ in range(draw.randrange(1, 6) if bad else 0):
            word = draw.choice(["grobnik", "vileish", "vileton", "Vilest", "scorn!"])
            words.insert(draw.randrange(len(words)), word)
        out.append((seed * 10_000 + k, " ".join(words), int(bad)))
    return out


def test_toxicity_on_held_out_documents(spark):
    train, test = toxic_case(900, 1), toxic_case(300, 2)
    found = [(d, t) for d, t, _ in train + test] + [(7, None), (8, "")]
    labels = [(d, 1, bad) for d, _, bad in train] + [(7, 1, 0), (8, None, None), (None, 1, 1)]
    labels += labels[:3]
    docs = cases.crowded(cases.documents(spark, found), "severity", "toxic", "words")
    known = spark.createDataFrame(labels, LABELS)
    got = cases.as_dict(toxicity.report(docs, known))
    wrong = sum(got[d]["toxic"] != bool(bad) for d, _, bad in test)
    assert wrong <= 3
    assert not got[7]["toxic"] and not got[8]["toxic"]
    bad = [got[d]["expected_severity"] for d, _, b in test if b]
    clean = [got[d]["expected_severity"] for d, _, b in test if not b]
    assert np.mean(bad) > 1 > 0.5 > np.mean(clean)
    stay = toxicity.without_toxic(docs, known)
    assert stay.columns == docs.columns
    assert {r.doc_id for r in stay.collect()} == {d for d, r in got.items() if not r["toxic"]}


def test_toxicity_without_examples(spark):
    docs, none = cases.documents(spark, cases.rows(4)), spark.createDataFrame([], LABELS)
    assert not any(r.toxic for r in toxicity.report(docs, none).collect())
    assert toxicity.report(cases.nothing(spark), none).count() == 0


def numbered(train: list[tuple[int, str, int]]) -> toxicity.Counted:
    """Examples as numbers, counted word by word."""
    sets = [toxicity.word_set(t) for _, t, _ in train]
    often = sorted(w for w in set().union(*sets) if sum(w in s for s in sets) >= toxicity.LEAST)
    pairs = [(k, c) for k, words in enumerate(sets) for c, w in enumerate(often) if w in words]
    row, column = (np.array(x, np.int32) for x in zip(*pairs, strict=True))
    return toxicity.Counted(often, row, column, np.array([bad > 0 for *_, bad in train]))


def test_examples_are_counted_in_spark_as_word_by_word(spark):
    train = toxic_case(60, 4)
    docs = cases.documents(spark, [(d, t) for d, t, _ in train])
    labels = spark.createDataFrame([(d, 1, bad) for d, _, bad in train], LABELS)
    got, want = toxicity.counted(toxicity.examples(docs, labels)), numbered(train)
    assert got.vocabulary == want.vocabulary
    for name in ("row", "column", "toxic"):
        assert getattr(got, name).tolist() == getattr(want, name).tolist()


def test_ordinal_cuts_are_ordered_and_share_weights():
    train = toxic_case(600, 3)
    model = toxicity.fit(numbered(train))
    assert list(model.cuts) == sorted(model.cuts)
    assert all(w >= 0 for w in model.weights.values())
    few, many = model.expected("the grobnik")[0], model.expected("grobnik vileish scorn vileton")[0]
    assert model.expected("the of and")[0] < few < many


def strict_spans(text: str) -> list[tuple[int, int, int]]:
    """The base forms, as plain patterns."""
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append((0, *m.span()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            out.append((1, *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = [int(c) for c in m.group() if c in "0123456789"][::-1]
        total = sum(sum(divmod(d * 2, 10)) if k % 2 else d for k, d in enumerate(digits))
        if 13 <= len(digits) <= 19 and total % 10 == 0:
            out.append((2, *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= sum(c in "0123456789" for c in m.group()) <= 15:
            out.append((3, *m.span()))
    return out


def test_base_spans_match_the_plain_patterns():
    draw = random.Random(1)
    parts = ["a", "@", "b.c", "@d.e", "1", "23", "456", " ", "-", ".", "+", "(", ")", "25", "_", "é"]
    parts += ["4539 1488 0343 6467", "٣"]
    for _ in range(15_000):
        text = "".join(draw.choice(parts) for _ in range(draw.randrange(1, 22)))
        assert pii.base_spans(text) == strict_spans(text)


def test_base_spans_of_very_long_runs():
    for text in ("1" * 50_000, "a" * 50_000 + "@", "a@" * 20_000, "1.2.3." * 5000):
        pii.base_spans(text)
        pii.loose_spans(text)


@pytest.mark.parametrize(
    "address",
    [
        "john at example.com",
        "john [ at ] example.com",
        "john (At) example.com",
        "j.doe ( at ) mail.org",
        "john{aT}mail dOt org",
        "john\tAT\nmail(doT)org",
    ],
)
def test_spelled_addresses_need_no_other_word(address):
    for before, after in (("", ""), ("write to ", " now"), ("an anecdote: ", "")):
        want = (0, len(before), len(before + address))
        assert want in pii.loose_spans(before + address + after)


def test_spelled_addresses_match_the_plain_pattern():
    draw = random.Random(4)
    parts = ["a", "At", "at", " at ", "[at]", "( at", " )", "{", "\n", ".", " dot ", "(DOT)", "b.c", "\u00a0"]
    for _ in range(15_000):
        text = "".join(draw.choice(parts) for _ in range(draw.randrange(1, 12)))
        want = [(0, *m.span()) for m in pii._SPELLED.finditer(text)]
        assert [s for s in pii.loose_spans(text) if s[0] == 0] == want


def test_personal_data_keeps_the_base_and_adds_spans(spark):
    draw, found = random.Random(8), []
    sure = ["a.b@mail.example.com", "10.20.30.40", "4539148803436467", "+1 (555) 010-2233"]
    for k in range(200):
        words = cases.prose(draw, 40).split(" ")
        words.insert(draw.randrange(40), draw.choice(sure))
        words.insert(draw.randrange(40), draw.choice(["999.1.2.3", "4539148803436468", "12 of 13"]))
        found.append((k, " ".join(words)))
    glued = "tel +1 (269) 555-3296 4539148803436467 end"
    found += [(500, glued), (501, None), (502, ""), (503, cases.prose(draw, 20_000) + " x@y.org")]
    docs = cases.crowded(cases.documents(spark, found), "found", "spans", "kind")
    got = cases.as_dict(pii.find(docs))
    for doc, text in found:
        base, row = strict_spans(text or ""), got[doc]
        assert [row[f"n_{k}"] for k in pii.KINDS] == [sum(b[0] == k for b in base) for k in range(4)]
        want = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for k, a, b in base)
        assert row["base_sha256"] == hashlib.sha256(want.encode()).hexdigest()
        assert {f"{pii.KINDS[k]}:{a}:{b}" for k, a, b in base} <= set(row["spans"].split(","))
        assert row["n_added"] == len([s for s in row["spans"].split(",") if s]) - len(base)
    assert got[500]["n_added"] == 2 and got[500]["spans"] == "card:22:38,phone:4:21"
    assert pii.find(cases.nothing(spark)).count() == 0


def test_em_finds_the_reliable_labeler():
    votes, counts = np.array([[1, 1, 1], [2, 2, 1], [1, 1, 2], [2, 2, 2]]), np.array([80, 90, 70, 60])
    chance = pii.reliabilities(votes, counts.astype(float))
    assert chance[0] > 0.9 and chance[2] > 0.9 and chance[1] < 0.1 and chance[3] < 0.1


PAGES = "page_id long, url string, html string"


def link(*hosts: str) -> str:
    return "".join(f'<p><a class="x" href="https://{h}/y">z</a></p>' for h in hosts)


def test_urls_by_rules_and_links(spark):
    rows = [
        (1, "http://Good.com/a?b#c", link("fine.org")),
        (2, "https://example.com/en/1", None),
        (3, "https://www.example.com/en/1?x", ""),
        (4, "https://m.example.com/en/1#t", ""),
        (5, "http://bad.net/es/1", link("other.org")),
        (6, "http://bad.net/fr/1", ""),
        (7, "http://farm.org/x", link("bad.net", "bad.net", "bad.net")),
        (8, "http://mixed.org/x", link("bad.net") + link(*[f"h{k}.org" for k in range(40)])),
        (9, "http://fine.org/", link("bad.net")),
        (10, "http://good.com", ""),
        (11, None, None),
        (12, "no scheme", link("bad.net")),
        (13, "x://notexample.com/en/", ""),
        (14, "http://bad.net/en/1", "<a href='//fine.org/'>"),
        (14, "http://bad.net/en/1", "<a href='//fine.org/'>"),
        (15, "http://bad.net/es/2", ""),
    ]
    pages = cases.crowded(spark.createDataFrame(rows, PAGES), "host", "rule", "verdict", "trust")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge(pages).collect()}
    assert got == {
        1: ("good.com", "/a", "com/", "allow"),
        2: ("example.com", "/en/1", "example.com/en/", "block"),
        3: ("www.example.com", "/en/1", "www.example.com/en/", "allow"),
        4: ("m.example.com", "/en/1", "example.com/en/", "block"),
        5: ("bad.net", "/es/1", "net/es/", "block"),
        6: ("bad.net", "/fr/1", "net/fr/", "block"),
        7: ("farm.org", "/x", None, "block"),
        8: ("mixed.org", "/x", None, "allow"),
        9: ("fine.org", "/", None, "allow"),
        10: ("good.com", "", None, "allow"),
        11: ("", "", None, "allow"),
        12: ("", "", None, "allow"),
        13: ("notexample.com", "/en/", "com/", "allow"),
        14: ("bad.net", "/en/1", None, "block"),
        15: ("bad.net", "/es/2", "net/es/", "block"),
    }
    assert url_filter.judge(spark.createDataFrame([], PAGES)).count() == 0


def test_scores_match_plain_iteration(spark):
    draw = random.Random(3)
    names = [f"h{k}.{t}" for k in range(12) for t in ("com", "net", "org")]
    rows = []
    for k in range(150):
        host = draw.choice(names)
        path = draw.choice(["/en/", "/es/", "/de/"])
        rows.append((k, f"http://{host}{path}", link(*draw.choices(names, k=3))))
    got = {r.host: r for r in url_filter.host_scores(spark.createDataFrame(rows, PAGES)).collect()}
    links: dict = {}
    for _, url, html in rows:
        src = url.split("/")[2]
        for dst in re.findall("https://([^/]*)", html):
            if dst != src:
                links[src, dst] = links.get((src, dst), 0) + 1
    pages = {h: [u for _, u, _ in rows if u.split("/")[2] == h] for h in names}

    def spread(edges: dict, marked) -> dict:
        seed = {h: 0.15 for h, us in pages.items() if 2 * sum(map(marked, us)) > len(us)}
        total: dict = {}
        for (a, _), n in edges.items():
            total[a] = total.get(a, 0) + n
        now = dict(seed)
        for _ in range(url_filter.ROUNDS):
            new = dict(seed)
            for (a, b), n in edges.items():
                new[b] = new.get(b, 0) + 0.85 * now.get(a, 0) * n / total[a]
            now = new
        return now

    trust = spread(links, lambda u: ".com/" in u)
    back = {(b, a): n for (a, b), n in links.items()}
    distrust = spread(back, lambda u: ".net/es" in u)
    for h in names:
        row = got.get(h)
        assert abs((row.trust if row else 0) - trust.get(h, 0)) < 1e-9
        assert abs((row.distrust if row else 0) - distrust.get(h, 0)) < 1e-9


def test_hosts_with_few_blocked_pages_hand_on_distrust(spark):
    rows = [(k, f"http://big.net/{'es' if k < 49 else 'en'}/{k}", "") for k in range(100)]
    rows += [(200, "http://farm.org/x", link("big.net")), (201, "http://far.org/x", link("farm.org"))]
    rows += [(202, "http://rest.org/x", link("rest2.org")), (203, "http://some.net/en/", "")]
    got = {r.page_id: r for r in url_filter.judge(spark.createDataFrame(rows, PAGES)).collect()}
    assert {k: r.verdict for k, r in got.items() if k < 100} == {
        k: "block" if k < 49 else "allow" for k in range(100)
    }
    assert [got[k].verdict for k in range(200, 204)] == ["block", "block", "allow", "allow"]
    assert got[99].distrust == pytest.approx(0.15 * 0.49)
    assert got[200].distrust == pytest.approx(0.15 * 0.49 * 0.85)


def exact_versions(found: list) -> dict:
    def likeness(a: str, b: str) -> float:
        a, b = ({p for p in t.split("\n") if p.strip(" ")} for t in (a, b))
        return len(a & b) / len(a | b) if a | b else 1.0

    rows, out = sorted(found, key=lambda r: -r[0]), {}
    for i, (doc, text) in enumerate(rows):
        text, after = text or "", rows[(i + 1) % len(rows)][1] or ""
        cut = len(text) // 3
        edited = text[: len(text) - cut] + after[:cut]
        sha = hashlib.sha256(edited.encode()).hexdigest()
        out[doc] = (len(text), sha, likeness(text, edited), likeness(text, after))
    return out


def test_fingerprints_match_exact_sets(spark):
    draw, found = random.Random(4), cases.rows(80)
    many = [f"paragraph {draw.randrange(10**9)}" for _ in range(900)]  # needs wider sketches
    found += [(3000, "\n".join(many[:600])), (2999, "\n".join(many[300:])), (2998, "\n".join(many))]
    docs = cases.crowded(cases.documents(spark, found), "rid", "own", "next", "edited", "k")
    got, want = cases.as_dict(paragraph_sketch.fingerprints(docs)), exact_versions(found)
    for doc, (n, sha, edited, following) in want.items():
        row = got[doc]
        assert (row["n_chars"], row["edited_sha256"]) == (n, sha)
        assert row["near_edited"] == pytest.approx(edited, abs=1e-12)
        assert row["near_next"] == pytest.approx(following, abs=1e-12)
    prints: dict = {}
    for doc, text in found:
        prints.setdefault(text or "", set()).add(got[doc]["fingerprint"])
    assert all(len(p) == 1 for p in prints.values())


def test_fingerprints_of_few_and_odd_rows(spark):
    def run(rows: list) -> list:
        docs = spark.createDataFrame(rows, "doc_id long, text string")
        return paragraph_sketch.fingerprints(docs).collect()

    assert run([]) == []
    (one,) = run([(5, "one\ntwo\nthree")])
    assert (one.n_chars, one.near_next) == (13, 1.0)
    many = run([(None, "a\nb"), (None, None), (3, "a"), (3, "a"), (4, "a\nc")])
    assert sorted(r.n_chars for r in many) == [0, 1, 1, 3, 3]
