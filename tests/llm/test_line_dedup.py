from riskmart.llm import line_dedup
from riskmart.llm.line_dedup import deduplicated, later_matches

from .helpers import documents, texts, words_of


def plain(rows, num=80, den=100):
    """(id, line) to remove: an earlier line matches."""
    places = [((i, j), frozenset(words_of(line))) for i, t in rows for j, line in enumerate((t or "").split("\n"))]
    places = [(p, s) for p, s in places if s]
    out = set()
    for n, (p, s) in enumerate(places):
        for _, t in places[:n]:
            both = len(s & t)
            if den * both >= num * (len(s) + len(t) - both):
                out.add(p)
                break
    return out


def variants(n):
    """Lines around the threshold: a base of 20 words with some replaced."""
    base = [f"b{i}" for i in range(20)]
    return [" ".join([f"v{k}x{i}" if i < k % 5 else w for i, w in enumerate(base)]) for k in range(n)]


def test_matches_brute_force(spark):
    values = texts() + ["\n".join(variants(7)[i:] + ["same line of five words", "a b c d", "a b c d e"]) for i in range(7)]
    got = later_matches(documents(spark, values), crowd=3, bits=10)
    assert {(r.id, r.line) for r in got.collect()} == plain(list(enumerate(values)))


def test_text_without_removed_lines(spark):
    docs = documents(spark, ["first line here\nsecond line", "first line here\nthird", None, "", "second LINE\n\nsecond line"])
    got = {r.doc_id: (r.text, r.n_lines, r.removed_lines) for r in deduplicated(docs).collect()}
    assert got == {0: ("first line here\nsecond line", 2, []), 1: ("third", 2, [0]), 2: (None, 1, []), 3: ("", 1, []),
                   4: ("", 3, [0, 2])}


def test_repeated_rows_and_empty_table(spark):
    docs = documents(spark, ["one two three\none two three"])
    got = deduplicated(docs.unionByName(docs)).collect()
    assert [r.removed_lines for r in got] == [[1], [1]]       # equal rows are one document
    again = deduplicated(docs.withColumn("n_lines", docs.n))
    assert again.columns == [*docs.columns, "n_lines", "removed_lines"]
    assert deduplicated(documents(spark, empty=True)).count() == 0


def test_copies_in_many_partitions_are_one_row_of_a_block_pair(spark, monkeypatch):
    whole = line_dedup._earliest(80, 100)

    def once(num, den):
        def run(table):
            h = table["h"].to_pylist()
            if len(h) != len(set(h)):
                raise ValueError(f"{len(h)} rows of {len(set(h))} sets in a block pair")
            return whole(table)
        return run

    monkeypatch.setattr(line_dedup, "_earliest", once)
    base = " ".join(f"b{i}" for i in range(20))
    values = [base] * 64 + [base.replace("b3", "other")]
    docs = documents(spark, values).repartition(16, "doc_id")
    assert {(r.id, r.line) for r in later_matches(docs, bits=10).collect()} == {(i, 0) for i in range(1, 65)}


def test_null_and_large_ids_keep_their_order(spark):
    """Ids above 2**53 differ by one beside a null id; null comes first."""
    low = 2**60
    same = "one two three four five six"
    docs = spark.createDataFrame([(low + 1, same), (low, same), (low + 2, same), (None, same + " seven")], "doc_id long, text string")
    got = {(r.id, r.line) for r in later_matches(docs, bits=10).collect()}
    assert got == {(low, 0), (low + 1, 0), (low + 2, 0)}
    docs = docs.where("doc_id is not null").unionByName(spark.createDataFrame([(None, "x")], "doc_id long, text string"))
    assert {(r.id, r.line) for r in later_matches(docs, bits=10).collect()} == {(low + 1, 0), (low + 2, 0)}
