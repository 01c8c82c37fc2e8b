"""Near-duplicate documents, repeated lines and their grouping against brute force."""

from __future__ import annotations

import hashlib
import os
import random
import re
import subprocess
import sys

import cases
import numpy as np
import pytest
from pyspark.sql import functions as F

from remanente.llm import components, line_dedup, minhash

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


class Union:
    def __init__(self):
        self.up: dict = {}

    def find(self, x):
        while self.up.setdefault(x, x) != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


def test_components_match_union_find(spark):
    draw = random.Random(2)
    edges = [(draw.randrange(80), draw.randrange(80)) for _ in range(60)]
    edges += [(100 + k, 101 + k) for k in range(30)] + [(200, 200 + k) for k in range(40)]
    edges += edges[:5] + [(7, 7), (None, 3)]
    sets = Union()
    for a, b in edges:
        if a is not None and a != b:
            sets.join(a, b)
    got = components.components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert len(got) == len({r.node for r in got})
    assert {r.node: r.label for r in got} == {x: sets.find(x) for x in list(sets.up)}
    none = spark.createDataFrame([], "a long, b long")
    assert components.components(none).count() == 0


def test_rounds_in_one_task_need_no_shuffle(spark, monkeypatch):
    plans, write = [], components.written

    def noted(df, kind="step"):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write(df, kind)

    monkeypatch.setattr(components, "written", noted)
    edges = [(k, k + 1) for k in range(9)] + [(20, 30), (20, 31)]
    got = components.components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: r.label for r in got} == dict.fromkeys(range(10), 0) | {20: 20, 30: 20, 31: 20}
    assert len(plans) > 2
    for plan in plans[1:]:  # the first one deals out the given edges
        assert "Exchange" not in plan
        assert plan.count("FileScan") == 1


def test_groups_dealt_out_match_union_find(spark, monkeypatch):
    monkeypatch.setattr(components, "ONE_TASK", 0)
    test_components_match_union_find(spark)


def test_pairs_are_met_in_one_bucket(spark):
    keys = {1: [5, 7, 9, 11], 2: [3, 7, 9, 11, 13], 3: [13]}
    rows = [(k, n, sorted(own)[:3]) for n, own in keys.items() for k in own]
    members = spark.createDataFrame(rows, "key long, node long, firsts array<long>")
    other = members.select("key", F.col("node").alias("node_b"), F.col("firsts").alias("firsts_b"))
    met = members.join(other, "key").where("node < node_b")
    once = met.where(components.first_met(F.col, lambda c: F.col(f"{c}_b")))
    assert met.count() == 4
    assert {tuple(r) for r in once.select("key", "node", "node_b").collect()} == {(7, 1, 2), (13, 2, 3)}


def test_odd_sketches_of_lines_drop_no_link_and_most_others(spark):
    draw, found = random.Random(4), []
    for n in (9, 24, 60, 200, 600):
        words, few = [f"w{draw.randrange(400)}" for _ in range(n)], max((n - 1) // 12, 1)
        for edits, linked in ((few, True), (few + few // 2 + 3, False)):
            for _ in range(20):
                new, less = list(words), linked and draw.random() < 0.5
                for at in draw.sample(range(n), min(edits - less, n)):
                    new[at] = f"x{draw.randrange(10**6)}"
                if less:
                    new.pop(draw.randrange(n))
                found.append((" ".join(words), " ".join(new), linked))
    df = spark.createDataFrame(found, "a string, b string, linked boolean")
    shown = {}
    for c in "ab":
        shown[f"n_{c}"], shown[f"n_words_{c}"] = F.length(c), line_dedup.n_words(F.col(c))
        shown |= {f"by_words_{c}": F.lit(True), f"indexed_{c}": F.lit(True), f"counts_{c}": F.lit(0)}
        for k in range(line_dedup.ODD_LONGS):
            shown[f"odd{k}_{c}"] = F.get(line_dedup.odd_bits(F.col(c)), k)
    one, other = (lambda x, c=c: F.col(f"{x}_{c}") for c in "ab")
    fits = line_dedup.may_fit(((10**6, 1),))(one, other)
    got = df.withColumns(shown).select("linked", "n_words_a", fits.alias("fits")).collect()
    assert all(r.fits for r in got if r.linked)
    # Lines of several hundred words fill a sketch, so only links are asked of those.
    assert sum(r.fits for r in got if not r.linked and r.n_words_a <= 200) <= 8  # of 80


def exact_set(text: str | None) -> set:
    lower = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def exact_groups(found) -> dict:
    sets, union = {d: exact_set(t) for d, t in found}, Union()
    ids = sorted(sets)
    for k, a in enumerate(ids):
        union.find(a)
        for b in ids[:k]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                union.join(a, b)
    return {d: (len(sets[d]), union.find(d)) for d in ids}


@pytest.mark.parametrize("text", ["", " \n", "a", "A b  c\td e F g", "É x y z w É x y z w", "x " * 50])
def test_shingle_sets_have_the_exact_size(text):
    assert len(minhash.shingles(text)) == len(exact_set(text))


def test_signature_estimates_similarity():
    draw, errors = np.random.default_rng(0), []
    for _ in range(40):
        pool = draw.integers(0, 2**63, draw.integers(20, 900)).astype(np.uint64)
        cut = int(len(pool) * 0.75)
        a, b = np.unique(pool[:cut]), np.unique(pool[len(pool) - cut :])
        s = minhash.signatures([a, b], 240)
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        errors.append((s[0] == s[1]).mean() - true)
    assert abs(np.mean(errors)) < 0.02
    assert np.std(errors) < np.sqrt(0.25 / 240)  # independent ranks would reach this


def test_near_duplicates_match_brute_force(spark):
    found = cases.rows(120)
    draw = random.Random(9)
    base = [f"w{k}" for k in range(60)]
    for k in range(80):  # a large group of near copies, some of them linked only through others
        words = list(base)
        for _ in range(draw.randrange(0, 3)):
            words[draw.randrange(60)] = f"x{draw.randrange(6)}"
        found.append((2000 + k, " ".join(words)))
    docs = cases.crowded(cases.documents(spark, found), "node", "label", "bands", "n_shingles")
    got, want = cases.as_dict(minhash.groups(docs)), exact_groups(found)
    for doc, (size, group) in want.items():
        row = got[doc]
        assert (row["n_shingles"], row["component_id"]) == (size, group)
        assert row["kept"] == (doc == group)
    stay = minhash.deduplicated(docs)
    assert stay.columns == docs.columns
    assert {r.doc_id for r in stay.collect()} == {d for d, (_, g) in want.items() if d == g}


def test_near_duplicates_take_null_and_repeated_ids(spark):
    long = " ".join(f"w{k}" for k in range(20))
    rows = [(None, long), (None, long), (5, long), (5, long), (4, long), (9, None), (9, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = minhash.groups(docs).collect()
    assert len(got) == len(rows)
    assert {r.component_id for r in got if r.n_shingles and r.doc_id} == {4}
    assert all(r.kept and r.component_id is None for r in got if r.doc_id is None)
    stay = sorted((r.doc_id or 0) for r in minhash.deduplicated(docs).collect())
    assert stay == [0, 0, 4, 9]
    assert minhash.groups(cases.nothing(spark)).count() == 0


def test_copies_that_differ_too_much_are_not_compared_pair_by_pair(spark, monkeypatch):
    draw, found = random.Random(5), []
    base = [f"w{k}" for k in range(150)]
    for k in range(60):
        words = list(base)
        for i in draw.sample(range(150), 5 if k % 20 else 1):
            words[i] = f"x{k}y{i}"
        found.append((k, " ".join(words)))
    asked = []

    def counting(pairs, sets, percent, real=minhash.similar):
        asked.append(pairs.count())
        return real(pairs, sets, percent)

    monkeypatch.setattr(minhash, "similar", counting)
    got = cases.as_dict(minhash.groups(cases.documents(spark, found)))
    want = {d: group for d, (_, group) in exact_groups(found).items()}
    assert {d: r["component_id"] for d, r in got.items()} == want
    apart = len({r["component_id"] for r in got.values()})
    assert apart > 20 and sum(asked) < 60 * 59 / 8


def test_sketches_never_part_linked_texts():
    draw = np.random.default_rng(3)
    for n in (1, 7, 150, 4000):
        for share in (0.0, 0.1, 0.25):
            both = draw.integers(0, 2**64, n, np.uint64)
            own = int(n * share / 2)
            a, b = both[: n - own], both[own:]
            bits = [np.unpackbits(minhash.odd_sketch(s).view(np.uint8)) for s in (a, b)]
            assert (bits[0] != bits[1]).sum() <= 2 * own


def distance(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def edited(draw: random.Random, text: str, edits: int) -> str:
    out = list(text)
    for _ in range(edits):
        at = draw.randrange(len(out) + 1)
        kind = draw.randrange(3)
        if kind == 0 and at < len(out):
            out[at] = draw.choice("abé")
        elif kind == 1:
            out.insert(at, draw.choice("ab"))
        elif at < len(out) > 1:
            del out[at]
    return "".join(out)


@pytest.mark.parametrize("edits", [1, 2, 3])
def test_banded_distance(spark, edits):
    draw = random.Random(edits)
    pairs = []
    for _ in range(200):
        a = "".join(draw.choice("abé") for _ in range(draw.randrange(4, 16)))
        b = edited(draw, a, draw.randrange(0, edits + 2))
        if abs(len(a) - len(b)) <= edits and len(b) >= edits:
            pairs.append((a, b))
    d = line_dedup.edit_distance(F.split("a", ""), F.split("b", ""), edits)
    for r in spark.createDataFrame(pairs, "a string, b string").withColumn("d", d).collect():
        assert min(r.d, edits + 1) == min(distance(r.a, r.b), edits + 1)


def exact_lines(found, edits: int, min_chars: int) -> dict:
    placed = [
        (d, i, line)
        for d, t in sorted(found)
        for i, line in enumerate((t or "").split("\n"))
        if line.strip(" ")
    ]
    known, union = sorted({line for _, _, line in placed}), Union()
    for k, a in enumerate(known):
        for b in known[:k]:
            near = min(len(a), len(b)) >= min_chars and abs(len(a) - len(b)) <= edits
            if near and union.find(a) != union.find(b) and distance(a, b) <= edits:
                union.join(a, b)
    head, own = {}, {}
    for d, i, line in placed:
        head.setdefault(union.find(line), (d, i))
        own.setdefault(line, (d, i))
    out = {}
    for d, t in found:
        kept, n, equal, similar = [], 0, 0, 0
        for i, line in enumerate((t or "").split("\n")):
            if not line.strip(" "):
                kept.append(line)
                continue
            n += 1
            if head[union.find(line)] == (d, i):
                kept.append(line)
            elif own[line] == head[union.find(line)]:
                equal += 1
            else:
                similar += 1
        out[d] = (n, equal, similar, "\n".join(kept))
    return out


@pytest.mark.parametrize(("edits", "min_chars"), [(1, 6), (2, 9)])
def test_repeated_lines_match_brute_force(spark, edits, min_chars):
    draw = random.Random(5)
    base = ["".join(draw.choice("abcdefgh é") for _ in range(draw.randrange(6, 14))) for _ in range(40)]
    found = []
    for d in range(60):
        lines = [edited(draw, draw.choice(base), draw.choice([0, 0, 1, 1, 2])) for _ in range(d % 8)]
        found.append((d * 3 - 20, "\n".join(lines)))
    found += [(900, None), (901, ""), (902, "  \n ")]
    docs = cases.crowded(cases.documents(spark, found), "node", "k", "h", "row")
    limits = {"edits": edits, "min_chars": min_chars}
    got = cases.as_dict(line_dedup.with_repeats(docs.select("doc_id", "text"), **limits))
    want = exact_lines(found, edits, min_chars)
    assert sum(w[2] for w in want.values()) > 20
    for doc, (n, equal, similar, kept) in want.items():
        row = got[doc]
        assert (row["n_lines"], row["n_equal"], row["n_similar"]) == (n, equal, similar)
        assert (row["kept"] or "") == kept
    stay = line_dedup.deduplicated(docs, **limits)
    assert stay.columns == docs.columns
    left = {d: w for d, w in want.items() if w[0] == 0 or w[0] > w[1] + w[2]}
    rows = {r.doc_id: r for r in stay.collect()}
    assert set(rows) == set(left)
    assert all((rows[d].text or "") == w[3] for d, w in left.items())
    assert all(rows[d].n_chars == len(rows[d].text or "") for d in left)


def test_line_report_takes_nothing_and_repeated_rows(spark):
    assert line_dedup.report(cases.nothing(spark)).count() == 0
    line = "a line of more than thirty-two letters"
    rows = [(None, line), (4, line), (4, line), (5, f"other\n{line}x"), (6, line)]
    got = line_dedup.report(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == 5
    assert {(r.doc_id, r.n_equal, r.n_similar) for r in got} == {
        (None, 0, 0),
        (4, 1, 0),
        (5, 0, 1),
        (6, 1, 0),
    }
    empty = hashlib.sha256(b"").hexdigest()
    assert all(r.kept_sha256 == empty for r in got if r.n_lines == r.n_equal)


def test_lines_with_letters_that_lengthen_when_lowered(spark):
    line = "Dün sabah İstanbul'dan gelen tren saat dokuzda buraya vardı ."
    rows = [(1, line), (2, line.replace("İ", "I"))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = cases.as_dict(line_dedup.report(docs))
    assert (got[1]["n_similar"], got[2]["n_similar"]) == (0, 1)


def word_distance(a: str, b: str) -> int:
    return distance(a.split(" "), b.split(" "))


def linked(a: str, b: str) -> bool:
    n, words = min(len(a), len(b)), min(len(a.split(" ")), len(b.split(" ")))
    letters = 0 if n < 16 else 1 if n < 32 else 2
    few = 0 if words < 8 else max(1, words // 12)
    return (
        abs(len(a) - len(b)) <= letters and distance(a, b) <= letters
    ) or word_distance(a, b) <= few


def test_lines_with_replaced_words(spark):
    draw, known = random.Random(12), []
    for k in range(45):
        words = [f"{draw.choice('abcdefgh')}{draw.randrange(10**6)}" for _ in range(3 + 2 * k)]
        known.append(" ".join(words))
        for edits in {1, max(1, len(words) // 12), len(words) // 12 + 1}:
            new = list(words)
            for at in draw.sample(range(len(words)), min(edits, len(words))):
                kind = draw.randrange(4)
                new[at] = "" if kind == 0 else f"{new[at]} more" if kind == 1 else "otherword"
            known.append(" ".join(w for w in new if w))
    known += ["a short line of 1", "a short line of 2", "short 1", "short 2"]
    known = list(dict.fromkeys(known))
    union = Union()
    for k, a in enumerate(known):
        for j, b in enumerate(known[:k]):
            if linked(a, b):
                union.join(k, j)
    docs = spark.createDataFrame(list(enumerate(known)), "doc_id long, text string")
    got = cases.as_dict(line_dedup.report(docs))
    want = {k: int(union.find(k) != k) for k in range(len(known))}
    assert {k: r["n_similar"] for k, r in got.items()} == want
    assert sum(want.values()) > 40


def test_linked_lines_share_one_of_few_keys(spark):
    draw, found = random.Random(21), []
    for k in range(60):
        words = ["".join(draw.choices("abcdeé", k=draw.randrange(1, 9))) for _ in range(5 + 2 * k)]
        line = " ".join(words)
        letters = list(line)
        for _ in range(0 if len(line) < 16 else 1 if len(line) < 34 else 2):
            at = draw.randrange(len(letters))
            letters[at] = draw.choice(["", " ", "z", letters[at] + " ", letters[at] + "z"])
        other = list(words)
        for at in draw.sample(range(len(words)), 0 if len(words) < 8 else max(1, len(words) // 12)):
            other[at] = draw.choice([f"{other[at]} more", "otherword"])
        found += [(k, 0, line), (k, 1, "".join(letters)), (k, 2, " ".join(other))]
    known = spark.createDataFrame(found, "k int, kind int, line string")
    every = known.select("line").distinct()
    probed = line_dedup.probed_lines(every, line_dedup.LETTER_EDITS)
    keys: dict[bytes, set] = {}
    for row in probed.collect():
        keys.setdefault(bytes(row.node), set()).add(row.key)
    named = known.select("k", "kind", line_dedup.node_of(F.col("line")).alias("node")).collect()
    own = {(r.k, r.kind): keys.get(bytes(r.node), set()) for r in named}
    for k, kind, line in found:
        if linked(found[3 * k][2], line) and len(line) >= 16:
            assert own[k, 0] & own[k, kind], (found[3 * k][2], line)
        n = len(line.split(" "))
        assert n < 20 or len(own[k, kind]) <= 0.75 * n


def test_written_steps_leave_no_shuffle_files(tmp_path):
    code = f"""
import glob, sys, time
from pyspark.sql import SparkSession
from remanente.llm import common
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config(
    "spark.checkpoint.dir", "{tmp_path}/shared").getOrCreate()
before = spark.conf.get(common.CLEANUP)
step = common.written(spark.range(1000).selectExpr("id % 9 AS k").groupBy("k").count())
assert step.count() == 9 and spark.conf.get(common.CLEANUP) == before
for _ in range(20):
    # Of the count above, which is not a step, one exchange stays.
    left = {{f.split("shuffle_")[1].split("_")[0] for f in glob.glob("{tmp_path}/local/**/shuffle_*", recursive=True)}}
    if len(left) <= 1:
        break
    time.sleep(1)
assert len(left) <= 1, left
"""
    env = {**os.environ, "SPARK_LOCAL_DIRS": f"{tmp_path}/local", "PYTHONPATH": ROOT}
    subprocess.run([sys.executable, "-c", code], env=env, check=True, timeout=120)
