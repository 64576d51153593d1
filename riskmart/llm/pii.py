"""Personal data: fixed patterns plus bootstrapped contextual extraction, in Spark functions only.

Base spans come from the four fixed patterns. Seeds are their valid matches and
digests (runs of 32, 40 or 64 hex digits). They start a graph between instances
(identifier-like strings: eight letters or digits at least, two digits at least)
and the lexical patterns they stand in: the word before and the word after (two
words where the nearer one has no letter or digit), the text before ``=`` or ``:``
in their token, a token's first four letters. Scores travel over the graph:

* a pattern's score is the believed share of all its occurrences beside any token of
  the corpus, smoothed by ``smooth`` occurrences, so a word that stands beside
  ordinary words scores near 0; it is 0 until ``support`` distinct instances are believed;
* an occurrence is believed by the noisy-or of the patterns on all its sides that score
  ``weak`` or more; an instance that is no seed by the mean of its occurrences, and not
  below ``trust``, so many weak contexts do not add up.

After ``rounds`` rounds every occurrence believed to at least ``trust`` is found, as a
span of kind ``id``. A digest is found
like any other instance: by its context alone. Spans that overlap a base span are not added.

Positions are code points, ends exclusive. They are found without a Python
function: a text split at the matches gives the gaps, whose lengths are summed.

Defined results: a null or empty text has no span; repeated rows each get their
result (they count once as evidence and each as text beside which a pattern may stand);
without any seed nothing is added; an empty table gives an empty result; extra columns are
ignored; words of more than 32 characters are no context. A document's spans are one row's text at most, so
grouping them by document is bounded by the document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import Scratch

# The base patterns, in the order of the kinds. Possessive repeats match the
# same text as greedy ones here, since what follows never starts with a repeated character, and
# need no stack for long runs. An email or ip begins where its run of characters begins or where
# the match before ended (\\G): from elsewhere in a run it matches no better, so no run is scanned twice.
KINDS = ("email", "ip", "card", "phone")
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
ADDED = "id"
# a phone or card number with blanks as one piece, else a token that holds a digit or an @
CANDIDATE = r"\+[0-9][\x20().0-9-]+[0-9]|(?<!\S)[0-9](?:[\x20-]?[0-9]){13,}+|(?<!\S)[^\s0-9@]*+[0-9@]\S*+"
DIGEST = r"(?<![0-9A-Za-z])(?:[0-9a-fA-F]{64}|[0-9a-fA-F]{40}|[0-9a-fA-F]{32})(?![0-9A-Za-z])"
# contexts, on lower-cased tokens: the part up to = or :, the first letters, a letter or digit
KEY = r"^[^\s=:a-z]*+[a-z][^\s=:]*+[=:]++[\"'(\[{<]*+"
HEAD = r"^[^a-z0-9]*+([a-z]{4})"
ALNUM = r"[\p{L}\p{N}]"
CONTEXT_WORD = 32                        # longest word of a context
EDGE = 128                               # characters kept on either side of a match
# of a token from its end on: marks, then the value; from the end there is one place to start
TAIL = r"^[^A-Za-z0-9]*+"
VALUE = TAIL + r"([A-Za-z0-9](?:[A-Za-z0-9_./+-]*[A-Za-z0-9])?)"


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    back = F.reverse(digits)

    def add(total: Column, i: Column) -> Column:
        d = F.substring(back, i, F.lit(1)).cast("int")
        twice = d * 2
        return total + F.when(i % 2 == 1, d).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))
    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def _valid(kind: Column, match: Column) -> Column:
    digits = _digits(match)
    part = F.forall(F.split(match, r"\."),
                    lambda p: (F.length(F.regexp_replace(p, "^0+", "")) <= 3) & (F.right(p, F.lit(3)).cast("int") <= 255))
    return (F.when(kind == "email", F.lit(True)).when(kind == "ip", part)
            .when(kind == "card", F.when(F.length(digits).between(14, 19), _luhn(digits)).otherwise(False))
            .when(kind == "phone", F.length(digits).between(10, 15)).otherwise(True))


def _around(edge, i: Column) -> Column:
    """EDGE characters of the text beside a match: the gap, the neighbouring match ``i``, the gap beyond."""
    part = [edge(c, F.lit(EDGE)) for c in (F.get("gaps", i), F.get("matches", i), F.get("gaps", i + 1))]
    return edge(F.concat_ws("", *part), F.lit(EDGE))


def _pieces(rows: DataFrame, kind: str, pattern: str, present: Column) -> DataFrame:
    """A row for each match: id, h, pos, kind, match, the length of the gap before it, and the text around it.

    Matches and gaps are columns of their own first, so a lambda looks them up and never splits the text again.
    """
    cut = rows.where(present).select("id", "h", F.regexp_extract_all("text", F.lit(pattern), F.lit(0)).alias("matches"),
                                     F.split("text", pattern, -1).alias("gaps"))
    made = F.transform("matches", lambda m, i: F.struct(
        F.lit(kind).alias("kind"), m.alias("match"), F.length(F.element_at("gaps", i + 1)).alias("gap"),
        _around(F.right, i - 1).alias("before"), _around(F.left, i + 1).alias("after")))
    return cut.where(F.size("matches") > 0).select("id", "h", F.posexplode(made))


def occurrences(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """id, h, kind, match, start, end, before, after of all matches of the base and candidate patterns.

    A document is known by its id and the hash h of its text; repeated rows count once.
    """
    body = F.col("text")
    rows = (docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
            .withColumn("h", F.xxhash64("text")))
    digit, at, plus = body.rlike("[0-9]"), body.contains("@"), body.contains("+")
    present = {"email": at, "ip": digit & body.contains("."), "card": digit, "phone": plus}
    found = rows.where(digit | at)
    parts = [_pieces(found, kind, pattern, present.get(kind, digit | at if kind == "candidate" else digit))
             for kind, pattern in (*PATTERNS.items(), ("candidate", CANDIDATE))]
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    every = every.select("id", "h", "pos", "col.*").dropDuplicates(["id", "h", "kind", "pos"])
    upto = Window.partitionBy("id", "h", "kind").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("gap") + F.length("match")).over(upto)
    return (every.withColumn("end", end).withColumn("start", F.col("end") - F.length("match"))
            .drop("gap", "pos"))


def base_spans(found: DataFrame) -> DataFrame:
    return (found.where((F.col("kind") != "candidate") & _valid(F.col("kind"), F.col("match")))
            .select("id", "h", "kind", "start", "end"))


def _unit(near: Column, far: Column, side: str) -> Column:
    """A context: the nearer word, with the farther one where the nearer has no letter or digit."""
    both = F.concat(far, F.lit(" "), near) if side == "left" else F.concat(near, F.lit(" "), far)
    word = F.when(near.rlike(ALNUM), near).when(F.length(far) <= CONTEXT_WORD, both)
    return F.when(F.length(near) <= CONTEXT_WORD, F.concat(F.lit(f"{side} "), word))


def _own(token: Column) -> list[Column]:
    """The patterns inside a lower-cased token."""
    start = F.left(token, F.lit(64))
    key, head = F.regexp_extract(start, KEY, 0), F.regexp_extract(start, HEAD, 1)
    return [F.when(key != "", F.concat(F.lit("key "), key)), F.when(head != "", F.concat(F.lit("head "), head))]


def instances(found: DataFrame) -> DataFrame:
    """Candidate occurrences with their name in the graph, their span, whether it is a seed, and its patterns."""
    token = F.col("match")
    hits = []
    for kind, pattern in PATTERNS.items():
        hit = F.regexp_substr(token, F.lit(pattern))
        hits.append(F.when(_valid(F.lit(kind), hit), F.lower(hit)))
    hit = F.coalesce(*hits, F.lower(F.regexp_substr(token, F.lit(DIGEST))))
    value = F.reverse(F.regexp_extract(F.reverse(token), VALUE, 1))
    tail = F.length(F.regexp_extract(F.reverse(token), TAIL, 0))
    looks_like_id = (F.length(F.regexp_replace("value", "[^A-Za-z0-9]", "")) >= 8) & (F.length(_digits(F.col("value"))) >= 2)
    rows = (found.where(F.col("kind") == "candidate").withColumn("hit", hit).withColumn("value", value)
            .where(F.col("hit").isNotNull() | looks_like_id)
            .withColumn("to", (F.col("end") - tail).cast("long"))
            .withColumn("from", (F.col("to") - F.length("value")).cast("long"))
            .withColumn("left", F.filter(F.split(F.lower("before"), r"\s+"), lambda w: w != ""))
            .withColumn("right", F.filter(F.split(F.lower("after"), r"\s+"), lambda w: w != "")))
    patterns = F.array(
        _unit(F.try_element_at("left", F.lit(-1)), F.try_element_at("left", F.lit(-2)), "left"),
        _unit(F.try_element_at("right", F.lit(1)), F.try_element_at("right", F.lit(2)), "right"),
        *_own(F.lower("match")))
    return rows.select("id", "h", "from", "to", F.coalesce("hit", F.lower("value")).alias("name"),
                       F.col("hit").isNotNull().alias("seed"), F.array_compact(patterns).alias("patterns"))


def pattern_totals(docs: DataFrame, wanted: DataFrame, text: str = "text") -> DataFrame:
    """pattern, total: how often each wanted pattern stands beside any token of the texts, or in one."""
    words = docs.select(F.filter(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), r"\s+"), lambda w: w != "").alias("words"))
    none = F.array(F.lit(None).cast("string"))
    near = words.select(F.arrays_zip(
        F.col("words").alias("word"), F.concat(none, "words").alias("before"),
        F.concat(F.slice("words", 2, F.greatest(F.size("words"), F.lit(1))), none).alias("after")).alias("near"))
    each = near.select(F.inline("near")).where(F.col("word").isNotNull())
    patterns = F.array(F.when(F.col("after").isNotNull(), _unit(F.col("word"), F.col("before"), "left")),
                       F.when(F.col("before").isNotNull(), _unit(F.col("word"), F.col("after"), "right")), *_own(F.col("word")))
    return (each.select(F.explode(patterns).alias("pattern")).where(F.col("pattern").isNotNull())
            .join(wanted.select("pattern"), "pattern", "left_semi").groupBy("pattern").agg(F.count("*").alias("total")))


def _noisy_or(score: str) -> Column:
    return F.round(1 - F.exp(F.sum(F.log(1 - F.least(F.col(score), F.lit(0.99))))), 6)


def pattern_scores(known: DataFrame, docs: DataFrame, text: str = "text", rounds: int = 3, smooth: float = 2.0,
                   support: int = 3, weak: float = 0.2, trust: float = 0.6, scratch: Scratch | None = None) -> DataFrame:
    """pattern, n, total, score after ``rounds`` rounds over the graph of patterns and instances."""
    scratch = scratch or Scratch(docs.sparkSession, "pii", until_exit=True)
    contexts = scratch.store(known.groupBy("name", "patterns").agg(F.count("*").alias("n"), F.max("seed").alias("seed")), "contexts")
    each = contexts.withColumn("pattern", F.explode("patterns"))
    edges = scratch.store(each.groupBy("pattern", "name").agg(F.sum("n").alias("n"), F.max("seed").alias("seed")), "edges")
    # a pattern of fewer instances never has the support
    wanted = edges.groupBy("pattern").agg(F.count("*").alias("names"), F.sum("n").alias("own")).where(F.col("names") >= support)
    wanted = scratch.store(wanted, "wanted")
    totals = pattern_totals(docs, wanted, text)
    wanted = wanted.join(totals, "pattern", "left").select(           # a match may begin or end inside a token
        "pattern", "own", F.greatest("own", F.coalesce("total", "own")).alias("total"))
    links = scratch.store(edges.join(wanted, "pattern"), "links")
    belief = links.groupBy("name").agg(F.max("seed").cast("double").alias("belief"))
    for turn in range(rounds):
        share = F.sum(F.col("n") * F.col("belief")) / (F.max("total") + smooth)
        scores = scratch.store(
            links.join(belief, "name").groupBy("pattern")
            .agg(F.max("own").alias("n"), F.max("total").alias("total"),
                 F.round(F.when(F.sum("belief") >= support, share).otherwise(0.0), 6).alias("score")), "scores")
        if turn < rounds - 1:
            joint = (each.join(scores.where(F.col("score") >= weak).select("pattern", "score"), "pattern")
                     .groupBy("name", "patterns").agg(F.max("n").alias("n"), _noisy_or("score").alias("joint")))
            mean = (contexts.groupBy("name").agg(F.sum("n").alias("n"), F.max("seed").alias("seed"))
                    .join(joint.groupBy("name").agg(F.sum(F.col("n") * F.col("joint")).alias("held")), "name", "left")
                    .withColumn("mean", F.round(F.coalesce(F.col("held") / F.col("n"), F.lit(0.0)), 6)))
            belief = mean.select("name", F.when(F.col("seed"), 1.0).when(F.col("mean") >= trust, F.col("mean"))
                                 .otherwise(0.0).alias("belief"))
    return scores


def personal_data(docs: DataFrame, id_col: str = "doc_id", text: str = "text", trust: float = 0.6, weak: float = 0.2,
                  support: int = 3, rounds: int = 3, scratch: Scratch | None = None) -> DataFrame:
    """id_col, base and spans: arrays of (start, kind number, kind, end), both sorted, one row per row of ``docs``."""
    scratch = scratch or Scratch(docs.sparkSession, "pii", until_exit=True)
    found = scratch.store(occurrences(docs, id_col, text), "occurrences")
    base = base_spans(found)
    known = scratch.store(instances(found), "instances")
    scores = pattern_scores(known, docs, text, rounds, support=support, weak=weak, trust=trust, scratch=scratch)
    added = (known.withColumn("pattern", F.explode("patterns"))
             .join(scores.where(F.col("score") >= weak).select("pattern", "score"), "pattern")
             .groupBy("id", "h", "from", "to").agg(_noisy_or("score").alias("joint")).where(F.col("joint") >= trust)
             .where(F.col("to") > F.col("from"))
             .select("id", "h", F.lit(ADDED).alias("kind"), F.col("from").alias("start"), F.col("to").alias("end")))
    every = base.unionByName(added)
    order = Window.partitionBy("id", "h").orderBy("start", "end", "kind")
    is_base = F.col("kind") != ADDED
    past = F.max(F.when(is_base, F.col("end"))).over(order.rowsBetween(Window.unboundedPreceding, -1))
    back = Window.partitionBy("id", "h").orderBy(F.col("start").desc(), F.col("end").desc(), F.col("kind").desc())
    ahead = F.min(F.when(is_base, F.col("start"))).over(back.rowsBetween(Window.unboundedPreceding, -1))
    free = is_base | ((F.coalesce("past", F.lit(0)) <= F.col("start"))
                      & (F.coalesce("ahead", F.col("end")) >= F.col("end")))
    number = F.lit(len(KINDS))
    for i, kind in enumerate(KINDS):
        number = F.when(F.col("kind") == kind, i).otherwise(number)
    span = F.struct("start", number.alias("number"), "kind", "end")
    spans = (every.withColumn("past", past).withColumn("ahead", ahead).where(free)
             .groupBy("id", "h").agg(F.array_sort(F.collect_list(F.when(is_base, span))).alias("base"),
                                     F.array_sort(F.collect_list(span)).alias("spans"))
             .withColumnsRenamed({"id": "_id", "h": "_h"}))
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("h"))
    none = F.array().cast("array<struct<start:bigint,number:int,kind:string,end:bigint>>")
    return (rows.join(spans, F.col("id").eqNullSafe(F.col("_id")) & (F.col("h") == F.col("_h")), "left")
            .select(F.col("id").alias(id_col), F.coalesce("base", none).alias("base"), F.coalesce("spans", none).alias("spans")))


def joined(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"),
                                                                       s["end"].cast("string"))))
