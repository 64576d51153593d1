"""Base patterns on very long runs: linear, and the same spans as the plain patterns."""

import random
import re
import time

from llm.helpers import documents
from riskmart.llm import pii

# the contract's patterns; the email's and ip's fit only Python's engine on short texts
PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"}


def test_long_runs_end_soon(spark):
    million = 200_000                                    # any quadratic step takes minutes
    values = ["a" * million + " x@y", "a" * million + "@b.c", "a" * million, "9" * million, "1." * (million // 4), "a@" * (million // 4),
              "a@b." * (million // 8), "x@" + "b" * million, "1.2.3." + "4" * million, "+" + "1" * 20 + " " * million]
    start = time.time()
    found = {r.doc_id: [(s.kind, s.start, s.end) for s in r.base] for r in pii.personal_data(documents(spark, values)).collect()}
    assert time.time() - start < 90
    assert found[1] == [("email", 0, million + 4)]
    assert found[0] == found[2] == []


def test_spans_are_those_of_the_plain_patterns(spark):
    rng = random.Random(8)
    pieces = ["a", "b.c", "@", "1", "23", ".", "_", "-", "%", " ", "é", "x@y.z", "1.2.3.4", "\n", "@@", ".."]
    values = ["".join(rng.choice(pieces) for _ in range(rng.randrange(1, 60))) for _ in range(400)]
    df = documents(spark, values)
    found = {kind: {} for kind in PLAIN}
    for r in pii.occurrences(df).where("kind in ('email', 'ip')").collect():
        found[r.kind].setdefault(r.id, []).append((r.start, r.end))
    for kind, pattern in PLAIN.items():
        for i, text in enumerate(values):
            assert sorted(found[kind].get(i, [])) == [m.span() for m in re.finditer(pattern, text)], (kind, text)
