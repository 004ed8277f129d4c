"""Personal data: base patterns, the field's learning and decoding, held-out sentences, the query."""

import hashlib
import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from roadlake.llm import personal, queries

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def plain_luhn(digits):
    total = 0
    for k, d in enumerate(reversed(digits)):
        v = int(d) * (1 + k % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def plain_base(text):
    out = []
    for k, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub(r"[^0-9]", "", m[0])
            fine = {"email": True, "ip": all(int(x) <= 255 for x in m[0].split(".")) if kind == "ip" else True, "card": 14 <= len(digits) <= 19 and plain_luhn(digits), "phone": 10 <= len(digits) <= 15}[kind]
            if fine:
                out.append((m.start(), k, m.end()))
    return sorted(out)


def test_base_spans_equal_the_patterns():
    rng = random.Random(2)
    parts = ["a", "Z9", "@", "@", ".", ".", "-", "+", "+1", " ", "(", ")", "0", "4111 1111 1111 1111", "4111-1111-1111-1112", "255", "256", "1.2.3.4", "x.y@b-c.d.e", "\n", "é", "\U0001f600", "%", "_", "12", "555-0148"]
    for _ in range(4000):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(1, 25)))
        assert personal.base_spans(text) == plain_base(text), text
    assert personal.base_spans("a@b.c@d.e x@y@z.com 000300.1.1.1 00255.1.1.1") == plain_base("a@b.c@d.e x@y@z.com 000300.1.1.1 00255.1.1.1")


@pytest.mark.parametrize("text", ["a" * 400_000 + "@", "1" * 400_000, "1." * 200_000, "+1" + " " * 400_000, "a@" * 200_000, "1 " * 200_000, "at " * 130_000, "(" * 400_000])
def test_long_texts_take_linear_time(text):
    import time

    began = time.time()
    personal.all_spans([text], personal.default_field())
    assert time.time() - began < 60


def test_viterbi_equals_trying_all_labellings():
    rng, (start, step) = np.random.default_rng(1), personal.allowed()
    step = step + rng.normal(size=step.shape)
    chains = [rng.normal(size=(n, personal.LABELS)) * 2 for n in (1, 2, 3, 4, 4, 1, 3)]
    for scores, found in zip(chains, personal.viterbi(chains, start, step)):
        value = lambda path: start[path[0]] + sum(scores[t, y] for t, y in enumerate(path)) + sum(step[a, b] for a, b in zip(path, path[1:]))  # noqa: E731, B023
        assert tuple(found) == max(itertools.product(range(personal.LABELS), repeat=len(scores)), key=value)


def test_gradient_is_that_of_the_likelihood():
    rng, (start, step) = np.random.default_rng(4), personal.allowed()
    scores, gold = rng.normal(size=(3, 5, personal.LABELS)), np.array([[0, 1, 2, 2, 0], [3, 4, 0, 0, 0], [0, 0, 0, 0, 0]])
    mask = np.arange(5) < np.array([5, 3, 1])[:, None]
    value, by_score, by_step = personal.likelihood(scores, gold, mask, start, step)
    everything = [sum(scores[1, t, y] for t, y in enumerate(p)) + start[p[0]] + step[p[0], p[1]] + step[p[1], p[2]] for p in itertools.product(range(personal.LABELS), repeat=3)]
    own = personal.likelihood(scores[1:2], gold[1:2], mask[1:2], start, step)[0]
    assert own == pytest.approx(np.log(np.sum(np.exp(everything))) - (scores[1, 0, 3] + scores[1, 1, 4] + scores[1, 2, 0]))
    for at in [(0, 1, 1), (0, 4, 2), (1, 2, 0), (1, 4, 3), (2, 0, 5)]:
        moved = scores.copy()
        moved[at] += 1e-5
        assert by_score[at] == pytest.approx((personal.likelihood(moved, gold, mask, start, step)[0] - value) / 1e-5, abs=1e-3)
    for at in [(0, 0), (1, 2), (3, 4), (2, 0)]:
        moved = step.copy()
        moved[at] += 1e-5
        assert by_step[at] == pytest.approx((personal.likelihood(scores, gold, mask, start, moved)[0] - value) / 1e-5, abs=1e-3)


def test_held_out_sentences():
    table, field = personal.labelled(6, seed=77), personal.default_field()
    hit = wrong = lost = 0
    for (text, gold), (base, added) in zip(table, personal.all_spans([t for t, _ in table], field)):
        hit += len({*gold} & {*base, *added})
        lost += len({*gold} - {*base, *added})
        wrong += len({*added} - {*gold})
    assert hit / (hit + lost) > 0.95 and wrong <= 0.02 * hit


def test_what_is_added_and_what_is_left_alone():
    field = personal.default_field()
    seen = lambda text: [(personal.KINDS[k], text[a:b]) for base, more in personal.all_spans([text], field) for a, k, b in sorted(base + more)]
    assert seen("Call (212) 555-0148 today") == [("phone", "(212) 555-0148")]
    assert seen("write to john dot doe at example dot com please") == [("email", "john dot doe at example dot com")]
    assert seen("jane [at] mail [dot] org") == [("email", "jane [at] mail [dot] org")]
    assert seen("card 4111.1111.1111.1111 ok") == [("card", "4111.1111.1111.1111")]
    assert seen("the host 10[.]0[.]0[.]12 is down") == [("ip", "10[.]0[.]0[.]12")]
    for text in ("On 2024-01-15 at 10:30 we met", "Order 12345678901 has left", "the 4111.1111.1111.1112 is not", "We met at noon. The dot com boom", "ISBN 978-3-16-148410-0", "12 | 34 | 56 | 78 | 90 | 12 | 34", "", "At dot at dot"):
        assert seen(text) == [], text


def test_find_handles_odd_rows_and_redacts(spark):
    rows = [(1, None, 1), (2, "", 1), (None, "a@b.cd and +1 (212) 555-0148!", 1), (4, "é\U0001f600 1.2.3.4", 1), (4, "é\U0001f600 1.2.3.4", 1), (5, "x " * 50_000 + "Tel: 212-555-0148", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans int").select("*", F.lit(1).alias("key"), F.lit(2).alias("redacted"))
    got = sorted(((r["doc_id"] or 0, [(s["kind"], s["start"], s["end"], s["base"]) for s in r["spans"]], r["redacted"][-40:]) for r in personal.find(docs, redact=True).collect()))
    assert got[0] == (0, [("email", 0, 6, True), ("phone", 11, 28, True)], "[email] and [phone]!")
    assert got[1:3] == [(1, [], ""), (2, [], "")] and got[3] == got[4] == (4, [("ip", 3, 10, True)], "é\U0001f600 [ip]")
    assert got[5][1] == [("phone", 100_005, 100_017, False)] and got[5][2].endswith("x x Tel: [phone]")
    assert personal.digest(personal.find(docs.limit(0))).collect() == []


def test_query_equals_the_patterns(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = queries.op13_personal_data(spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        base = plain_base(texts[r["doc_id"]])
        told = ",".join(f"{personal.KINDS[k]}:{a}:{b}" for a, k, b in base)
        assert [r[f"n_{kind}"] for kind in personal.KINDS] == [sum(k == j for _, k, _ in base) for j in range(4)]
        assert r["base_sha256"] == hashlib.sha256(told.encode()).hexdigest() and set(filter(None, told.split(","))) <= set(r["spans"].split(","))
