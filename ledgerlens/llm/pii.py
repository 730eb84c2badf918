"""Personal data by bootstrapped contextual extraction, in Spark functions only.

1. Seeds: fixed patterns with their checks find e-mail and IP addresses, card
   and phone numbers, leftmost and not overlapping per kind.
2. Candidates: other identifier-like tokens (an @, or four digits or more)
   that overlap no seed. Groups of digits joined by single spaces, brackets or
   hyphens are one token.
3. Every instance (seed or candidate text) occurs after a context, the token on
   its left. Contexts are the lexical patterns; occurrences make a graph of
   patterns and instances.
4. In each round a pattern's confidence is the sum of the scores of the
   instances it precedes over *all* tokens it precedes in the corpus plus one,
   if at least ``SUPPORT`` different known instances stand behind it; an
   unknown instance's score is the noisy-or of its patterns. Instances scoring
   ``ACCEPT`` or more are known in the next round. Rounds go on until no
   confidence moves by more than ``TOLERANCE`` and no instance becomes known;
   a warning says if that took more than ``ROUNDS``. An instance of one pattern
   alone scores that pattern's confidence, which is solved for within a round:
   the limit is the same, but needs no rounds of its own.
5. Candidates accepted in the end become spans of the kind their patterns'
   seeds mostly have.

Offsets are code points. They are found by splitting the text at the same
pattern that extracts the matches and adding up lengths. The patterns are the
base patterns written with possessive quantifiers and a start guard, which
match the same but do not rescan long runs.

Cases: null or empty text has no span; repeated rows (also of one doc_id) are
kept apart and all returned; ties in kind: the first listed; an empty table
gives an empty result; other columns are kept in ``mask`` and not read here.
"""

from __future__ import annotations

import warnings
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import broadcast_if_small, materialize, numbered

KINDS = ("email", "ip", "card", "phone")
ROUNDS = 100
TOLERANCE = 1e-6
SUPPORT = 3
ACCEPT = 0.8
TOKEN = 4   # digits that make a token identifier-like

_EDGE = r"[^\s:=(\"'<>\[\])},;]"   # characters of an identifier-like token
_GROUP = r"(?:\([0-9]++\)|[0-9]++)"
_STOP = rf"[.!?]*+(?:\s|$)|(?!{_EDGE})"
_RUN = (rf"(?:\(\+[0-9]++\)|\+?+{_GROUP})"       # groups of digits, the last one up to the end of the token
        rf"(?:[\x20-]?+{_GROUP}(?=-\(?[0-9]|{_STOP}))++(?={_STOP})")
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "token": rf"(?:\G|(?<!{_EDGE}))(?:{_RUN}|(?:(?![0-9@]){_EDGE})*+[0-9@]{_EDGE}*+)",
}
_OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"
_CUT = r"(?<=[:=(\"'<>\[\])},;])[ ]*|[ ]+"   # contexts end at white space or one of these


def _digits(col):
    return F.regexp_replace(col, "[^0-9]", "")


def _passes(kind, hit):
    n = F.length(_digits(hit))
    tests = {
        "ip": hit.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$"),
        "card": (n >= 12) & (n <= 19) & F.call_function("luhn_check", _digits(hit)),
        "phone": (n >= 9) & (n <= 15),
        "token": hit.contains("@") | (n >= TOKEN),
    }
    out = F.lit(True)
    for k, test in tests.items():
        out = F.when(kind == k, test).otherwise(out)
    return out


def _flat(text):
    """White space as spaces, character for character."""
    return F.translate(text, "\t\n\x0b\x0c\r", "     ")


def _last_token(gap):
    """Lower-cased token that ends the gap (empty: none)."""
    parts = F.split(F.substring_index(F.rtrim(gap), " ", -1), _CUT)
    return F.coalesce(F.lower(F.try_element_at(F.filter(parts, lambda x: x != ""), F.lit(-1))), F.lit(""))


def _matches(docs: DataFrame) -> DataFrame:
    """rid, kind, start, end, hit, left: every match of every pattern."""
    parts = docs.select("rid", "text", F.col("text").contains("@").alias("_at"), F.col("text").rlike("[0-9]").alias("_digit"))
    need = {"email": F.col("_at"), "token": F.col("_at") | F.col("_digit")}
    parts = parts.where("_at OR _digit").select("rid", "text", *(
        F.when(need.get(k, F.col("_digit")), F.regexp_extract_all("text", F.lit(p), F.lit(0))).alias(f"{k}_hits")
        for k, p in PATTERNS.items()))
    gap = lambda g: F.struct(F.length(g).alias("size"), _last_token(_flat(g)).alias("left"))
    # split leaves the text after the last match too: one gap more than hits
    parts = parts.select("rid", F.array(*(
        F.struct(F.lit(k).alias("kind"), F.col(f"{k}_hits").alias("hits"),
                 F.when(F.size(f"{k}_hits") > 0, F.transform(F.split("text", p, -1), gap)).alias("gaps"))
        for k, p in PATTERNS.items())).alias("found"))
    parts = parts.select("rid", F.explode("found").alias("f")).where(F.size("f.hits") > 0)
    rows = parts.select("rid", "f.kind", F.posexplode(F.arrays_zip("f.hits", "f.gaps")).alias("at", "m")).where(
        F.col("m.hits").isNotNull())
    order = Window.partitionBy("rid", "kind").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("m.gaps.size") + F.length("m.hits")).over(order)
    return rows.select("rid", "kind", F.col("m.hits").alias("hit"), F.col("m.gaps.left").alias("left"), end.alias("end")
                       ).withColumn("start", F.col("end") - F.length("hit"))


def _candidates(found: DataFrame) -> DataFrame:
    """Identifier-like tokens without the signs at their end, apart from seeds."""
    trimmed = found.withColumn("hit", F.when(F.col("kind") == "token", F.regexp_replace("hit", r"[^\p{L}\p{N}]++$", ""))
                               .otherwise(F.col("hit"))).withColumn("end", F.col("start") + F.length("hit"))
    seed_end = F.when(F.col("kind") != "token", F.col("end"))
    seed_start = F.when(F.col("kind") != "token", F.col("start"))
    by_start = Window.partitionBy("rid").orderBy("start", F.when(F.col("kind") == "token", 1).otherwise(0))
    before = F.max(seed_end).over(by_start.rowsBetween(Window.unboundedPreceding, 0))
    after = F.min(seed_start).over(by_start.rowsBetween(0, Window.unboundedFollowing))
    return (trimmed.withColumn("_before", before).withColumn("_after", after)
            .where((F.col("kind") != "token")
                   | ((F.coalesce("_before", F.lit(0)) <= F.col("start")) & (F.coalesce("_after", F.col("end")) >= F.col("end"))))
            .drop("_before", "_after"))


def _context_totals(docs: DataFrame, lefts: DataFrame) -> DataFrame:
    """How many tokens each context precedes in the whole corpus."""
    words = docs.select(F.explode(F.split(F.lower(_flat(F.col("text"))), _CUT)).alias("left")).where("left != ''")
    return words.join(broadcast_if_small(lefts), "left").groupBy("left").agg(F.count(F.lit(1)).alias("total"))


def _bootstrap(occurrences: DataFrame, totals: DataFrame) -> DataFrame:
    """hit, kind of the candidates accepted by the pattern-instance graph."""
    graph = occurrences.join(totals, "left").groupBy("left", "hit", "kind").agg(
        F.count(F.lit(1)).alias("n"), F.max("total").alias("total"))
    hits = graph.groupBy("hit").agg(F.bool_or(F.col("kind") != "token").alias("seed"), F.count_distinct("left").alias("lefts"))
    graph = materialize(graph.join(hits, "hit"))
    tokens = graph.where("NOT seed")
    alone = ~F.col("seed") & (F.col("lefts") == 1)
    fixed = materialize(graph.groupBy("left").agg(
        F.sum(F.when(F.col("seed"), F.col("n")).otherwise(0)).alias("mass"), F.max("total").alias("total"),
        F.count_distinct(F.when(F.col("seed"), F.col("hit"))).alias("seeds"),
        F.sum(F.when(alone, F.col("n")).otherwise(0)).alias("own"), F.count_if(alone).alias("own_hits")).where("seeds > 0"))
    several = tokens.where("lefts > 1").select("left", "hit", "n")
    none = fixed.select("left", F.lit(0.0).alias("confidence")).limit(0)
    patterns, state = none, None
    for _ in range(ROUNDS):
        # instances of several patterns by the last round's confidences
        scores = (several.join(patterns, "left").groupBy("hit").agg((1 - F.product(1 - F.col("confidence"))).alias("score")))
        more = (several.join(scores, "hit").groupBy("left").agg(
            F.sum(F.col("n") * F.col("score")).alias("more"), F.count_if(F.col("score") >= ACCEPT).alias("more_known")))
        last = patterns.select("left", F.col("confidence").alias("last"))
        found = fixed.join(more, "left", "left").join(last, "left", "left").na.fill(0, ["more", "more_known", "last"])
        # instances of this pattern alone score its confidence c: c = (mass + own * c) / (total + 1)
        known = F.col("seeds") + F.col("more_known") + F.when(F.col("last") >= ACCEPT, F.col("own_hits")).otherwise(0)
        patterns = materialize(found.where(known >= SUPPORT).select("left", "last", F.least(
            (F.col("mass") + F.col("more")) / F.greatest(F.col("total") + 1 - F.col("own"), F.lit(1)), F.lit(1.0)).alias("confidence"), known.alias("known")))
        now = patterns.agg(F.max(F.abs(F.col("confidence") - F.col("last"))).alias("moved"),
                           F.count(F.lit(1)).alias("n"), F.sum("known").alias("known")).first()
        if not now["n"] or state == (now["n"], now["known"]) and now["moved"] <= TOLERANCE:
            break
        state = now["n"], now["known"]
    else:
        warnings.warn(f"scores still move by {now['moved']} after {ROUNDS} rounds", RuntimeWarning, stacklevel=2)
    patterns = patterns.select("left", "confidence")
    known = (tokens.join(patterns, "left").groupBy("hit").agg((1 - F.product(1 - F.col("confidence"))).alias("score")))
    patterns = patterns.where("confidence > 0")
    votes = (graph.where("kind != 'token'").join(patterns, "left").groupBy("left").agg(
        *(F.sum(F.when(F.col("kind") == k, F.col("n")).otherwise(0)).alias(k) for k in KINDS)))
    accepted = known.where(F.col("score") >= ACCEPT).select("hit")
    tally = (tokens.join(accepted, "hit").join(votes, "left")
             .groupBy("hit").agg(*(F.sum(F.col(k) * F.col("n")).alias(k) for k in KINDS)))
    most = F.greatest(*KINDS)
    kind = reduce(lambda rest, k: F.when(F.col(k) == most, F.lit(k)).otherwise(rest), reversed(KINDS), F.lit(None))
    return tally.select("hit", kind.alias("new_kind"))


def _numbered(docs: DataFrame, text: str) -> DataFrame:
    return numbered(docs, "rid").withColumn("text", F.coalesce(F.col(text), F.lit("")))


def find_spans(rows: DataFrame) -> DataFrame:
    """rid, kind, start, end, base (true for seeds) of all spans."""
    found = _matches(rows.select("rid", "text"))
    found = materialize(found.where(_passes(F.col("kind"), F.col("hit"))))
    spans = materialize(_candidates(found))
    occurrences = spans.where("left != ''").select("left", "hit", "kind")
    seeded = occurrences.where("kind != 'token'").select("left").distinct()
    lefts = materialize(occurrences.join(seeded, "left").groupBy("left").agg(
        F.count_distinct("hit").alias("n")).where(F.col("n") >= SUPPORT).select("left"))
    base = spans.where("kind != 'token'").select("rid", "kind", "start", "end", F.lit(True).alias("base"))
    if lefts.isEmpty():  # no context has enough instances to become a pattern
        return base
    accepted = _bootstrap(occurrences, _context_totals(rows.select("text"), lefts))
    new = spans.where("kind = 'token'").join(broadcast_if_small(materialize(accepted)), "hit")
    return base.unionByName(new.select("rid", F.col("new_kind").alias("kind"), "start", "end", F.lit(False).alias("base")))


def pii_spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and ``spans`` (array of start, kind number, kind, end, base) per input row."""
    rows = _numbered(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("_t")), "_t")
    number = reduce(lambda rest, k: F.when(F.col("kind") == KINDS[k], k).otherwise(rest), range(len(KINDS)), F.lit(-1))
    spans = find_spans(rows).groupBy("rid").agg(F.array_sort(F.collect_list(
        F.struct("start", number.alias("number"), "kind", "end", "base"))).alias("spans"))
    return rows.select("rid", F.col("doc_id").alias(doc_id)).join(spans, "rid", "left")


def span_string(spans):
    """kind:start:end of an array of spans, comma-joined."""
    return F.coalesce(F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","), F.lit(""))


def digests(found: DataFrame) -> DataFrame:
    """Counts and digests of ``pii_spans``."""
    base = F.filter("spans", lambda s: s["base"])
    count = lambda k: F.coalesce(F.size(F.filter(base, lambda s: s["kind"] == k)).cast("long"), F.lit(0))
    return found.select(*(c for c in found.columns if c not in ("rid", "spans")),
                        *(F.greatest(count(k), F.lit(0)).alias(f"n_{k}") for k in KINDS),
                        F.sha2(span_string(base), 256).alias("base_sha256"), span_string(F.col("spans")).alias("spans"))


def mask(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with every span replaced by its kind in angle brackets.

    Overlapping spans are masked as one, by the kind of the first. Null texts
    stay null; all columns are kept.
    """
    names = docs.columns
    rows = numbered(docs, "_rid")
    spans = find_spans(rows.select(F.col("_rid").alias("rid"), F.coalesce(F.col(text), F.lit("")).alias("text")))
    grown = Window.partitionBy("rid").orderBy("start", F.desc("end")).rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.withColumn("_to", F.coalesce(F.max("end").over(grown), F.lit(0)))
    merged = spans.where(F.col("end") > F.col("_to")).select(
        "rid", F.greatest("start", "_to").alias("start"), "end",
        F.when(F.col("start") >= F.col("_to"), F.concat(F.lit("<"), F.upper("kind"), F.lit(">"))).otherwise("").alias("mark"))
    edits = merged.groupBy(F.col("rid").alias("_rid")).agg(
        F.array_sort(F.collect_list(F.struct("start", "end", "mark"))).alias("_edits"))
    t = F.col(text)
    out = F.aggregate("_edits", F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("done")),
                      lambda acc, e: F.struct(
                          e["end"].alias("at"),
                          F.concat(acc["done"], F.array(t.substr(acc["at"] + 1, e["start"] - acc["at"]), e["mark"])).alias("done")),
                      lambda acc: F.concat(F.array_join(acc["done"], ""), t.substr(acc["at"] + 1, F.length(t).cast("long"))))
    return (rows.join(edits, "_rid", "left")
            .withColumn(text, F.when(F.col("_edits").isNull(), t).otherwise(out)).select(*names))
