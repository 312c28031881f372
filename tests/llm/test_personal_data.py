import random
import re
import time
from hashlib import sha256

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from holdfast.llm import personal_data as pd

SCHEMA = "doc_id long, text string, number string, spans int"
PLAIN = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def luhn(digits):
    doubled = [int(d) if at % 2 == 0 else sum(map(int, str(2 * int(d)))) for at, d in enumerate(reversed(digits))]
    return sum(doubled) % 10 == 0


def stays(kind, value):
    digits = re.sub("[^0-9]", "", value)
    return {
        "email": lambda: True,
        "ip": lambda: all(int(p) <= 255 for p in value.split(".")),
        "card": lambda: 14 <= len(digits) <= 19 and luhn(digits),
        "phone": lambda: 10 <= len(digits) <= 15,
    }[kind]()


def brute(text):
    found = []
    for at, (kind, regex) in enumerate(PLAIN.items()):
        found += [(m.start(), at, m.end()) for m in regex.finditer(text or "") if stays(kind, m.group())]
    return sorted(found)


def spelt(spans):
    return ",".join(f"{pd.KINDS[k]}:{s}:{e}" for s, k, e in spans)


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1) for i, t in rows], SCHEMA)


@settings(max_examples=1_500, deadline=None)
@given(st.text(alphabet="0123459+@.-() abZ_%é\n٣", max_size=60))
def test_seeds_against_the_plain_expressions(text):
    assert pd.seeds_in(text) == brute(text)


@pytest.mark.parametrize(
    "text",
    ["a@b.co.@c.de", "x@y..z q@r.s-", "1.2.3.4.5.6.7.8", "256.1.1.1 1.2.3.004", "4111 1111-1111 1111", "4111  1111",
     "+1 (383) 555-6083.", "+12 ) . ( 3456789012 +", "a@b", "@b.c", "0000000000000000", "9" * 40 + ".1.1.1",
     "+1 383 555 6083 4111111111111111"],
)
def test_seeds_of_odd_texts(text):
    assert pd.seeds_in(text) == brute(text)


@pytest.mark.parametrize("unit", ["a", "1", ".", "@", "+", "1.", "a@", " 1", "+1", "at ", "1:", "(", "dot "])
def test_long_runs_take_time_in_proportion(unit):
    begun = time.perf_counter()
    text = unit * (400_000 // len(unit))
    seeds = pd.seeds_in(text)
    list(pd.fillers_in(text, pd.candidates_in(text, seeds)))
    assert time.perf_counter() - begun < 10


def number(rng):
    return f"{rng.randrange(200, 999)}", f"{rng.randrange(200, 999)}", f"{rng.randrange(10_000):04}"


def corpus(seed=1, size=60):
    """Contact lines with regular numbers and others without a country code, amid prose with numbers of other kinds."""
    rng = random.Random(seed)
    rows, planted, clean = [], [], []
    for i in range(size):
        a, b, c = number(rng)
        rows.append((i, f"Some words first. Please call us at +1 ({a}) {b}-{c} for more."))
        rows.append((1_000 + i, f"We sold {rng.randrange(10**7, 10**8)} pieces, order {rng.randrange(10**9, 10**10)} too."))
        clean.append(1_000 + i)
        rows.append((2_000 + i, f"Write to my mail : user{rng.randrange(10**6)}@example.com today"))
    for i in range(20):
        a, b, c = number(rng)
        text = f"Now please call us at {a}-{b}-{c} for news."
        rows.append((3_000 + i, text))
        planted.append((3_000 + i, text.index(a), 3, text.index(c) + 4))
        text = f"write to my mail : joe{i} (at) example (dot) org today"
        rows.append((4_000 + i, text))
        planted.append((4_000 + i, text.index("joe"), 0, text.index(" today")))
    return rows, planted, clean


def test_unseen_identifiers_are_found_by_their_context(spark):
    rows, planted, clean = corpus()
    spans, patterns = pd.bootstrapped(frame(spark, rows).repartition(4))
    found = {(r["doc_id"], *s) for r in spans.collect() for s in r["found"]}
    assert set(planted) <= found
    assert not {f for f in found if f[0] in clean} and len(found) == len(planted)
    texts = {r["text"] for r in patterns.collect()}
    assert "2 us at" in texts and "2 mail :" in texts


def test_numbers_of_another_kind_make_a_pattern_untrusted(spark):
    rng = random.Random(2)
    rows = [(i, f"it cost at +1 ({a}) {b}-{c} x") for i, (a, b, c) in enumerate(number(rng) for _ in range(10))]
    rows += [(100 + i, f"it cost at {i}.50 x") for i in range(40)] + [(200, "it cost at 383-555-6083 x")]
    spans, patterns = pd.bootstrapped(frame(spark, rows))
    assert patterns.count() == 0 and not any(r["found"] for r in spans.collect())


def test_a_found_value_makes_patterns_of_its_own(spark):
    """Numbers found in a trusted pattern are reliable instances where they occur again."""
    rng = random.Random(3)
    numbers = [number(rng) for _ in range(12)]
    rows = [(i, f"please call us at +1 ({a}) {b}-{c} now") for i, (a, b, c) in enumerate(number(rng) for _ in range(40))]
    rows += [(100 + i, f"please call us at {a}-{b}-{c} now") for i, (a, b, c) in enumerate(numbers)]
    rows += [(200 + i, f"his mobile is {a}-{b}-{c} or so") for i, (a, b, c) in enumerate(numbers)]
    rows += [(300, "his mobile is 444-555-6666 or so")]
    spans, patterns = pd.bootstrapped(frame(spark, rows))
    found = {r["doc_id"] for r in spans.collect() if r["found"]}
    assert {300, *range(100, 112), *range(200, 212)} <= found


def test_digests(spark):
    rows = [(1, "mail a.b@c.de, +1 (383) 555-6083 or 10.0.0.1"), (2, None), (2, ""), (2, ""), (None, "4111111111111111 é")]
    rows += [(9, "x" * 9_000 + " a@b.cd " + "1" * 9_000)]
    got = sorted(map(tuple, pd.personal_data(frame(spark, rows)).collect()), key=repr)
    expected = []
    for doc_id, text in rows:
        spans = brute(text)
        counts = [sum(k == kind for _, k, _ in spans) for kind in range(4)]
        expected.append((doc_id, *counts, sha256(spelt(spans).encode()).hexdigest(), spelt(spans), 0))
    assert got == sorted(expected, key=repr)


def test_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = {r["doc_id"]: r for r in pd.personal_data(docs).collect()}
    for doc_id, text in docs.select("doc_id", "text").collect():
        spans = spelt(brute(text))
        assert got[doc_id]["base_sha256"] == sha256(spans.encode()).hexdigest()
        assert set(filter(None, spans.split(","))) <= set(got[doc_id]["spans"].split(","))


def test_empty_table(spark):
    assert pd.personal_data(frame(spark, [])).count() == 0
