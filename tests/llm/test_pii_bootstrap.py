"""Learnt spans: equal to a plain-Python version, found where the context stands out, and nowhere else."""

import math
import random
import re
from collections import Counter, defaultdict

from llm.helpers import documents
from llm.test_small_operators import plain_base
from riskmart.llm import pii


def plain_learnt(values, trust=0.6, weak=0.2, support=3, rounds=3, smooth=2.0):
    """{row: [(start, end)]} of the id spans, ASCII texts."""
    def unit(words, near, far, side):
        if not 0 <= near < len(words) or len(words[near]) > 32:
            return []
        if re.search("[a-z0-9]", words[near]):
            return [f"{side} {words[near]}"]
        if not 0 <= far < len(words) or len(words[far]) > 32:
            return []
        return [f"{side} " + " ".join(words[i] for i in sorted((near, far)))]

    def own(token):
        key, head = re.match(pii.KEY, token[:64]), re.match(pii.HEAD, token[:64])
        return ([f"key {key[0]}"] if key else []) + ([f"head {head[1]}"] if head else [])
    totals, seen = Counter(), []
    for row, text in enumerate(values):
        words = text.lower().split()
        for i, w in enumerate(words):
            totals.update(own(w) + (unit(words, i, i - 1, "left") if i + 1 < len(words) else [])
                          + (unit(words, i, i + 1, "right") if i else []))
        bases = [tuple(map(int, s.split(":")[1:])) for s in plain_base(text).split(",") if s]
        for m in re.finditer(pii.CANDIDATE, text):
            alone = [s for s in plain_base(m[0]).split(",") if s]
            digest = re.search(pii.DIGEST, m[0])
            back = re.match(pii.VALUE, m[0][::-1])
            value = back[1][::-1] if back else ""
            if not alone and not digest and (len(re.sub("[^A-Za-z0-9]", "", value)) < 8 or len(re.sub("[^0-9]", "", value)) < 2):
                continue
            end = m.end() - (back.start(1) if back else 0)
            name = value.lower()
            if alone:
                a, b = map(int, min(alone, key=lambda s: [k for k in pii.KINDS].index(s.split(":")[0])).split(":")[1:])
                name = m[0][a:b].lower()
            elif digest:
                name = digest[0].lower()
            before, after = text[:m.start()].lower().split(), text[m.end():].lower().split()
            patterns = (unit(before, len(before) - 1, len(before) - 2, "left") + unit(after, 0, 1, "right") + own(m[0].lower()))
            seen.append((row, end - len(value), end, name, bool(alone or digest), patterns, bases))
    seeds = {s[3] for s in seen if s[4]}
    links = defaultdict(Counter)
    for s in seen:
        for p in s[5]:
            links[p][s[3]] += 1
    belief = {s[3]: float(s[3] in seeds) for s in seen}

    def joint(patterns):
        held = [min(score[p], 0.99) for p in patterns if score[p] >= weak]
        return 1 - math.prod(1 - x for x in held)
    for _ in range(rounds):
        score = {p: (sum(n * belief[v] for v, n in c.items()) / (max(totals[p], sum(c.values())) + smooth)
                     if sum(belief[v] for v in c) >= support else 0.0) for p, c in links.items()}
        mean = defaultdict(list)
        for s in seen:
            mean[s[3]].append(joint(s[5]))
        means = {v: sum(x) / len(x) for v, x in mean.items()}
        belief = {v: 1.0 if v in seeds else x if x >= trust else 0.0 for v, x in means.items()}
    out = defaultdict(list)
    for row, a, b, _, _, patterns, bases in seen:
        if b > a and joint(patterns) >= trust and all(b <= x or y <= a for x, y in bases):
            out[row].append((a, b))
    return {row: sorted(set(spans)) for row, spans in out.items()}


def corpus(n=160):
    rng = random.Random(12)
    plain = "the left right of and river stone cloud was to".split()
    out = []
    for i in range(n):
        words = [rng.choice(plain) for _ in range(12)]
        secret = "".join(rng.choice("0123456789abcdef") for _ in range(40))
        short = f"{rng.randrange(10 ** 5):05d}-{rng.choice('XYZ')}{rng.randrange(10 ** 4):04d}"
        insert = [f'token = "{secret}"', f'token = "{short if i % 16 == 1 else secret}"', f"contact: {rng.choice('abcdef')}{rng.choice('gh')}.doe@mail.example now",
                  f"contact: {short} now", f"build {short}", f"the {secret[:14]}77 of", f"acct=ACME{short}", f"from 10.{i}.0.7 to"][i % 8]
        words.insert(rng.randrange(13), insert)
        out.append(" ".join(words))
    return out


def test_learnt_spans_equal_the_plain_version(spark):
    values = corpus() + ["", "contact: " + "x" * 5000, "token = " + "q7" * 4000, "1 = 2 = 3"]
    rows = pii.personal_data(documents(spark, values)).collect()
    got = {r.doc_id: [(s.start, s.end) for s in r.spans if s.kind == pii.ADDED] for r in rows}
    want = plain_learnt(values)
    assert {i: s for i, s in got.items() if s} == want
    # unseen identifiers behind the learnt contexts, none beside ordinary words
    assert all(want.get(i) for i in range(160) if i % 8 in (0, 1, 3))
    assert not any(want.get(i) for i in range(160) if i % 8 in (4, 5))


def test_no_ordinary_word_is_a_trusted_pattern(spark):
    docs = documents(spark, corpus())
    known = pii.instances(pii.occurrences(docs))
    scores = {r.pattern: r.score for r in pii.pattern_scores(known, docs).collect()}
    assert scores["left token ="] > 0.8 and scores["left contact:"] > 0.8      # letters-only addresses are seeds
    assert max(scores.get(f"{side} {w}", 0) for side in ("left", "right") for w in ("the", "left", "right", "of", "was")) < 0.2
