"""Filter audit: micro-batches and retractions against brute force over whole tables."""

from __future__ import annotations

import random
import re
from collections import Counter

import cases
import pandas as pd
import pytest

from remanente.llm import filter_audit

LABELS = "doc_id long, quality int, toxic int"


def drawn(n: int = 240) -> list[tuple]:
    """(doc_id, text, source): copies whose smaller ids come later, null ids, texts and sources."""
    draw = random.Random(9)
    texts = [cases.prose(draw, draw.randrange(1, 140)) for _ in range(30)]
    texts += ["", None, " \n", "A B C D", "x | y", "word " * 60, "á b", "word " * 30_000]
    out = [
        (draw.choice([None, *range(150)] if draw.random() < 0.1 else range(150)), draw.choice(texts),
         draw.choice(["a", "b", None]))
        for _ in range(n)
    ]
    return sorted(out, key=lambda r: -(r[0] or 0))


def mask(text: str) -> int:
    words = [w for w in re.split("[\x20\x09-\x0d]+", text) if w]
    a = len(words) < 50
    b = 100 * len(set(words)) < 65 * len(words)
    c = 100 * len(re.findall("[A-Z]", text)) > 5 * len(text)
    return a + 2 * b + 4 * c + 8 * bool(re.search("[#$%&*|]", text))


def brute(rows: list[tuple], labels: list[tuple]) -> Counter:
    out: Counter = Counter()
    for doc, text, source in rows:
        ids = [d for d, t, _ in rows if (t or "") == (text or "") and d is not None]
        copy = doc is not None and min(ids) < doc
        good, toxic = (
            int(any(x[0] == doc and x[k] == 1 for x in labels)) if doc is not None else 0 for k in (1, 2)
        )
        out[source or "", mask(text or "") + 16 * copy, good, toxic] += 1
    return out


def orders(counts: Counter) -> dict:
    """The audit by applying the filters one after another."""
    out: dict = {}
    for part in {k[0] for k in counts}:
        own = [(m, g, t, n) for (p, m, g, t), n in counts.items() if p == part]
        removed_all: Counter = Counter()
        for order in filter_audit.ORDERS:
            left, gone = own, []
            for step, letter in enumerate(order, 1):
                bit = filter_audit.BIT[letter]
                here = [x for x in left if x[0] & bit]
                out[part, order, step] = {
                    "kept": sum(x[3] for x in left if not x[0] & bit),
                    "removed": sum(x[3] for x in here),
                    "redundant": sum(x[3] for x in gone if x[0] & bit),
                    "unique_fails": sum(x[3] for x in own if x[0] == bit),
                    "good_lost": sum(x[1] * x[3] for x in here),
                    "toxic_lost": sum(x[2] * x[3] for x in here),
                }
                removed_all[letter] += sum(x[3] for x in here)
                left, gone = [x for x in left if not x[0] & bit], gone + here
        for (p, order, step), row in out.items():
            if p == part:
                row["shapley"] = removed_all[order[step - 1]]
    return out


@pytest.fixture(scope="module")
def given(spark, tmp_path_factory):
    """Documents in eight files, larger ids first, and labels."""
    folder = tmp_path_factory.mktemp("audit")
    rows = drawn()
    for k in range(8):
        part = spark.createDataFrame(rows[k * 30 : (k + 1) * 30], "doc_id long, text string, source string")
        crowded = cases.crowded(part.coalesce(1), "mask", "part", "digest", "good", "n")
        crowded.write.mode("append").parquet(f"{folder}/documents.parquet")
    labels = [(d, d % 2, d % 3 % 2) for d in range(0, 150, 4)] + [(4, 1, 1), (8, 0, 0)]
    return f"{folder}/documents.parquet", rows, labels


@pytest.mark.parametrize("files", [1, 3, 64])
def test_masks_equal_brute_force(spark, given, files):
    path, rows, labels = given
    found = filter_audit.masks_of(spark, path, spark.createDataFrame(labels, LABELS), files)
    got = {(r.part, r["mask"], r.good, r.toxic): r.n for r in found.collect()}
    assert got == dict(brute(rows, labels))


def test_report_equals_filters_applied_in_order(spark, given):
    path, rows, labels = given
    found = filter_audit.report(spark, path, spark.createDataFrame(labels, LABELS)).collect()
    want = orders(brute(rows, labels))
    assert len(found) == len(want) == 3 * 600
    for r in found:
        row = r.asDict()
        key = (row.pop("part"), row.pop("filter_order"), row.pop("step"))
        assert row == want[key], key


def test_smaller_id_takes_the_earlier_count_back():
    rows = [("a", 0, 0, 7, 1, 3)]
    least, held, found = filter_audit.changes(None, {}, rows)
    assert (least, held) == (7, {("a", 0, 0): 1})
    assert found == {("a", 0, 0, False): 1, ("a", 0, 0, True): 2}
    least, held, found = filter_audit.changes(least, held, [("b", 1, 0, 5, 2, 2)])
    assert (least, held) == (5, {("b", 1, 0): 2})
    assert found == {("a", 0, 0, False): -1, ("a", 0, 0, True): 1, ("b", 1, 0, False): 2}


class Held:
    exists, value = False, None

    @property
    def get(self):
        return self.value

    def update(self, value):
        self.exists, self.value = True, value


def test_texts_of_one_bucket_share_a_call_and_keep_their_own_ids():
    state = Held()

    def call(*rows):
        frames = filter_audit.updated((0,), iter([pd.DataFrame({"row": rows})]), state)
        return [frame["change"].tolist() for frame in frames]

    first = call("aa|7|1|3|2|0|0|p|q", "bb|9|1|1|0|1|0|p|q", "aa||0|2|2|0|0|p|q")
    assert first == [["0|1|0|1|p|q", "2|0|0|3|p|q", "18|0|0|2|p|q"]]
    assert call("aa|5|1|1|2|0|1|r", "bb|9|1|1|0|1|0|p|q") == [
        ["0|1|0|1|p|q", "2|0|0|-1|p|q", "2|0|1|1|r", "18|0|0|1|p|q"]
    ]
    assert call("aa|8|1|1|2|0|0|r") == [["18|0|0|1|r"]]


def test_failures():
    for text in ["", "a", "word " * 50, "A" * 6 + "b" * 94, "A" * 5 + "b" * 95, "#", "ÄÄÄÄÄ", " x\x0b y"]:
        assert filter_audit.failures(text.encode()) == mask(text), text


def test_empty_table(spark, tmp_path):
    empty = spark.createDataFrame([], "doc_id long, text string, source string")
    empty.write.parquet(f"{tmp_path}/documents.parquet")
    labels = spark.createDataFrame([], LABELS)
    assert filter_audit.report(spark, f"{tmp_path}/documents.parquet", labels).collect() == []
