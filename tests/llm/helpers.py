"""Small document tables with the awkward rows that every operator must take."""

from __future__ import annotations

import random

WORDS = ("river stone cloud amber field night harbor window garden silver copper meadow lantern winter "
         "summer valley thunder marble cedar falcon").split()

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          "n long, h string, score double, shard int, kind string, start int")


def sentence(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) + str(rng.randrange(40)) for _ in range(n)).capitalize() + "."


def texts(seed: int = 1, n: int = 40) -> list[str | None]:
    """Distinct texts, exact copies, near copies, repeated lines, odd and very long texts."""
    rng = random.Random(seed)
    out: list[str | None] = ["\n".join(sentence(rng, rng.randrange(4, 14)) for _ in range(rng.randrange(1, 6)))
                             for _ in range(n)]
    out += [out[0]] * 12                                   # exact copies
    words = out[1].split(" ")
    for i in range(6):                                     # near copies
        copy = list(words)
        copy[i % len(copy)] = "changed"
        out.append(" ".join(copy))
    out += [None, "", " ", "\n\n", "one", "ONE", "two words", "á é ü ß 漢字 😀", "x" * 5000,
            "\n".join(sentence(rng, 8) for _ in range(400)), "tab\tand\x0bfeed\x0cline\r\nend"]
    return out


def documents(spark, rows: list[str | None] | None = None, empty: bool = False):
    """The documents table with extra columns whose names operators use inside."""
    rows = texts() if rows is None else rows
    data = [] if empty else [
        (i, t, None if i % 7 == 0 else "en", None if i % 5 == 0 else f"src{i % 3}", None if i % 11 == 0 else len(t or ""),
         i, "x", 0.5, 3, "k", 1) for i, t in enumerate(rows)]
    return spark.createDataFrame(data, SCHEMA)


def words_of(text: str | None) -> list[str]:
    """A-Z lower-cased, cut at space and TAB..CR."""
    import re
    fold = {c: c + 32 for c in range(65, 91)}
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(fold))


def shingle_set(text: str | None, k: int) -> frozenset:
    w = words_of(text)
    if len(w) >= k:
        return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    return frozenset([tuple(w)]) if w else frozenset()
