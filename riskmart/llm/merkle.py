"""Document fingerprints: a Merkle tree over phrases, paragraphs and sections, in Spark functions only.

Leaves are phrases (text up to a line end, or to a blank after ``.``, ``!``,
``?`` or ``e``; the cuts keep every character). A paragraph is a line; its node
hashes its leaves' digests. A section is a run of paragraphs that ends after a
paragraph whose digest begins with 0 or 1, so an edit moves section borders only
near it. The root hashes the sections' digests: equal texts, and no others but
for SHA-256 collisions, have equal roots. Two trees are compared from the root
down: only branches that differ are entered.

``likeness`` is 2 |A and B| / (|A| + |B|) over the trees' distinct leaves.

Defined results: a null text is the empty text, which has one empty leaf; a
repeated row is a row of its own and the next row after its copy; the only row
of a table is its own next; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .neighbours import with_next

LEAF_CUT = r"(?<=\n)|(?<=[.!?e] )"


def leaves(text: Column) -> Column:
    """SHA-256 of every phrase, in order; a line's last one is marked by a line end."""
    return F.transform(F.split(text, LEAF_CUT, -1),
                       lambda p: F.concat(F.sha2(p, 256), F.when(p.endswith("\n"), "\n").otherwise("")))


def paragraphs(leaf: Column) -> Column:
    """Digest of every paragraph from the leaves."""
    return F.transform(F.split(F.concat_ws("", leaf), "\n", -1), lambda p: F.sha2(p, 256))


def sections(paragraph: Column) -> Column:
    """Digest of every section from the paragraphs."""
    runs = F.concat_ws("", F.transform(paragraph, lambda p: F.concat(p, F.when(p < "2", "|").otherwise(""))))
    return F.transform(F.split(runs, r"\|", -1), lambda s: F.sha2(s, 256))


def root(section: Column) -> Column:
    return F.sha2(F.concat_ws("", section), 256)


def with_tree(df: DataFrame, text: str, prefix: str) -> DataFrame:
    """``df`` with the tree of a text: columns <prefix>leaves, paragraphs, sections, root."""
    return (df.withColumn(f"{prefix}leaves", leaves(F.coalesce(F.col(text), F.lit(""))))
            .withColumn(f"{prefix}paragraphs", paragraphs(F.col(f"{prefix}leaves")))
            .withColumn(f"{prefix}sections", sections(F.col(f"{prefix}paragraphs")))
            .withColumn(f"{prefix}root", root(F.col(f"{prefix}sections")))
            .withColumn(f"{prefix}leaves", F.array_distinct(f"{prefix}leaves")))


def likeness(a: str, b: str) -> Column:
    """Share of common leaves of two trees (prefixes), 1 for equal roots."""
    x, y = F.col(f"{a}leaves"), F.col(f"{b}leaves")
    dice = 2.0 * F.size(F.array_intersect(x, y)) / (F.size(x) + F.size(y))
    return F.when(F.col(f"{a}root") == F.col(f"{b}root"), F.lit(1.0)).otherwise(dice)


def first_difference(a: str, b: str, level: str) -> Column:
    """Index from 0 of the first node of a level that differs, -1 for equal roots."""
    x, y = F.col(f"{a}{level}"), F.col(f"{b}{level}")
    same = F.zip_with(x, y, lambda p, q: p.eqNullSafe(q))
    return F.when(F.col(f"{a}root") == F.col(f"{b}root"), F.lit(-1)).otherwise(
        F.array_position(same, F.lit(False)).cast("int") - 1)


def with_edit(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """id_col, text, next_text, n_chars, edited: the text's last half replaced from the next document."""
    clean = docs.select(F.col(id_col), F.coalesce(F.col(text), F.lit("")).alias("text"))
    half = F.expr("cast(n_chars div 2 as int)")
    return (with_next(clean, id_col, "text", "next_text")
            .withColumn("n_chars", F.length("text").cast("long"))
            .withColumn("edited", F.concat(F.substring("text", F.lit(1), (F.col("n_chars") - half).cast("int")),
                                           F.substring("next_text", F.lit(1), half))))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Trees of every text (prefix ``a_``), its edited text (``e_``) and the next text (``n_``)."""
    trees = with_edit(docs, id_col, text)
    for column, prefix in (("text", "a_"), ("edited", "e_"), ("next_text", "n_")):
        trees = with_tree(trees, column, prefix)
    return trees
