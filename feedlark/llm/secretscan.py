"""Secret scans: a trigram index names the texts that a rule may match, and the rule verifies them.

From the parse tree of every rule's regular expression a Boolean query over trigrams is derived (Cox,
"Regular expression matching with a trigram index", 2012): any match contains the trigrams of one of
its clauses. The index has one posting per trigram and text, for the trigrams that some rule asks
for. A clause's postings are intersected by counting; its texts are the rule's candidates, which the
expression then scans whole. A rule that forces no trigram scans every text.

All work on texts is done by expressions, joins and aggregates of Spark; only the rules, of which
there are a few, are looked at in Python. Positions are code points, ends exclusive, and matches of a
rule are the leftmost that do not overlap.

Defined results: null is the empty text; repeated rows are scanned each; an id that stands on several
texts makes all of them candidates of what any of them matches, which verification sorts out; an
empty table gives no rows. All columns of the input are kept, but for those
named like an added one.
"""

from __future__ import annotations

import re._constants as codes
import re._parser as parser
from dataclasses import dataclass
from functools import reduce
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlark import runtime
from feedlark.llm.common import ascii_lower, shield, unshield

MOST_STRINGS = 16  # alternatives that are kept apart while a query is derived; beyond, fewer trigrams are asked


@dataclass(frozen=True)
class Rule:
    """`least` characters of the match, or of group `part`, make a match a finding."""

    kind: str
    pattern: str
    part: int = 0
    least: int = 1


# Base rules (fixed values of the contract), then those that this scan adds.
BASE = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 16),
    Rule("hex", r"[0-9a-f]{32,}", 0, 32),  # the runs of 32 and more of [0-9a-f]+
)
ADDED = (
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 27),
    Rule("signed_token", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 32),
    Rule("code_host", r"gh[pousr]_[A-Za-z0-9]{36,}", 0, 40),
    Rule("chat_bot", r"xox[abprs]-[A-Za-z0-9-]{10,}", 0, 15),
)

Clauses = frozenset  # of clauses, each a frozenset of trigrams; a clause without trigrams holds for any text


def _simplest(clauses) -> Clauses:
    """Without the clauses that a weaker one contains."""
    return frozenset(c for c in clauses if not any(o < c for o in clauses))


def _trigrams(text: str) -> frozenset[str]:
    return frozenset(text[i : i + 3] for i in range(len(text) - 2))


def _both(a: Clauses, b: Clauses) -> Clauses:
    return _simplest({x | y for x, y in product(a, b)})


ANY: Clauses = frozenset({frozenset()})


def _expressions(tree) -> list[tuple[frozenset[str] | None, Clauses]]:
    """Items of a parse tree: (the strings it can be, or None if there are many, and its clauses)."""
    items = []
    for op, value in tree:
        if op is codes.LITERAL:
            items.append((frozenset({chr(value).lower()}), ANY))
        elif op is codes.IN and all(o is codes.LITERAL for o, _ in value) and len(value) <= MOST_STRINGS:
            items.append((frozenset(chr(v).lower() for _, v in value), ANY))
        elif op is codes.SUBPATTERN:
            items.append(_query(value[-1]))
        elif op is codes.BRANCH:
            found = [_query(branch) for branch in value[1]]
            strings = None if any(s is None for s, _ in found) else frozenset().union(*(s for s, _ in found))
            if strings and len(strings) <= MOST_STRINGS:
                items.append((strings, ANY))
            else:
                clauses = [c if s is None else _both(c, frozenset(map(_trigrams, s))) for s, c in found]
                items.append((None, _simplest(frozenset().union(*clauses))))
        elif op in (codes.MAX_REPEAT, codes.MIN_REPEAT):
            least, most, inner = value
            strings, clauses = _query(inner)
            if (least, most) == (0, 1) and strings is not None:
                items.append((strings | {""}, ANY))
            elif (least, most) == (1, 1):
                items.append((strings, clauses))
            elif least >= 1:  # one copy is certain, but what stands beside it is not
                items.append((None, clauses if strings is None else _both(clauses, frozenset(map(_trigrams, strings)))))
            else:
                items.append((None, ANY))
        else:
            items.append((None, ANY))
    return items


def _query(tree) -> tuple[frozenset[str] | None, Clauses]:
    """Neighbouring items of few strings are joined to longer strings, whose trigrams are then certain."""
    clauses, run, whole = ANY, frozenset({""}), True
    for strings, own in _expressions(tree):
        clauses = _both(clauses, own)
        longer = None if strings is None else frozenset(a + b for a, b in product(run, strings))
        if longer is None or len(longer) > MOST_STRINGS:
            clauses = _both(clauses, frozenset(map(_trigrams, run)))
            run, whole = strings or frozenset({""}), False
        else:
            run = longer
    if whole:
        return run, clauses
    return None, _both(clauses, frozenset(map(_trigrams, run)))


def trigram_query(pattern: str) -> list[frozenset[str]]:
    """Clauses of lower-case trigrams: a text that matches has all trigrams of one of them.

    An empty list means that nothing is certain, so every text has to be scanned.
    """
    strings, clauses = _query(parser.parse(pattern))
    if strings is not None:
        clauses = _both(clauses, frozenset(map(_trigrams, strings)))
    return [] if frozenset() in clauses else sorted(clauses, key=sorted)


def postings(df: DataFrame, doc: str, text: str, trigrams: list[str]) -> DataFrame:
    """(trigram, doc): the index, for the given trigrams, in lower case."""
    low = ascii_lower(F.coalesce(F.col(text), F.lit("")))

    def present(t: Column) -> Column:
        return F.array_compact(F.array(*(F.when(F.contains(t, F.lit(x)), F.lit(x)) for x in trigrams)))

    # an array of one holds the lower-case text, which would else be made again for every trigram
    found = F.get(F.transform(F.array(low), present), F.lit(0))
    return df.select(F.col(doc).alias("doc"), F.explode_outer(found).alias("trigram")).filter("trigram is not null").select("trigram", "doc")


def candidates(index: DataFrame, queries: dict[str, list[frozenset[str]]]) -> DataFrame:
    """(doc, kinds): rules whose query the postings of a text fulfil. A clause is a set of bits, one
    for each of its trigrams, so postings that occur twice do no harm."""
    asked = [
        (kind, n, (1 << len(clause)) - 1, t, 1 << i)
        for kind, clauses in queries.items()
        for n, clause in enumerate(clauses)
        for i, t in enumerate(sorted(clause))
    ]
    rows = index.sparkSession.createDataFrame(asked, "kind string, clause int, full long, trigram string, bit long")
    # the rules' trigrams: a few dozen rows, whatever the corpus
    met = index.join(F.broadcast(rows), "trigram").groupBy("doc", "kind", "clause", "full")
    met = met.agg(F.bit_or("bit").alias("bits")).filter("bits = full")
    return met.groupBy("doc").agg(F.collect_set("kind").alias("kinds"))


def spans_of(found: Column, text: Column, rule: Rule) -> Column:
    """Array of (kind, start, end) of the matches `found`: in a text, gaps and matches alternate, so
    the sums of their lengths are the places."""
    blocks = F.arrays_zip(found.alias("m"), F.split(text, rule.pattern, -1).alias("g"))

    def step(seen: Column, z: Column) -> Column:
        start = seen["at"] + F.length(z["g"])
        end = start + F.length(F.coalesce(z["m"], F.lit("")))
        secret = F.regexp_extract(z["m"], rule.pattern, rule.part) if rule.part else z["m"]
        span = F.struct(F.lit(rule.kind).alias("kind"), start.alias("start"), end.alias("end"))
        grown = F.concat(seen["spans"], F.array(span))
        return F.struct(
            end.alias("at"), F.when(F.length(secret) >= rule.least, grown).otherwise(seen["spans"]).alias("spans")
        )

    none = F.array().cast("array<struct<kind:string,start:int,end:int>>")
    return F.aggregate(blocks, F.struct(F.lit(0).alias("at"), none.alias("spans")), step)["spans"]


def scan(df: DataFrame, doc: str = "doc_id", text: str = "text", rules: tuple[Rule, ...] = BASE + ADDED) -> DataFrame:
    """`df` with spans: array of (kind, start, end), by start and then in the order of the rules."""
    df, names = shield(df.withColumns({"__id": F.col(doc), "__text": F.col(text)}), "__id", "__text")
    doc, text = "__id", "__text"
    queries = {r.kind: trigram_query(r.pattern) for r in rules}
    trigrams = sorted(set().union(*(c for clauses in queries.values() for c in clauses)))
    index = runtime.materialise(postings(df, doc, text, trigrams), "trigrams")
    chosen = candidates(index, {k: q for k, q in queries.items() if q})
    chosen = runtime.materialise(chosen.withColumnRenamed("doc", "_doc"), "candidates")
    joined = df.join(chosen, F.col(doc).eqNullSafe(F.col("_doc")), "left")
    joined = joined.withColumn("_text", F.coalesce(F.col(text), F.lit("")))
    for n, r in enumerate(rules):
        found = F.regexp_extract_all("_text", F.lit(r.pattern), F.lit(0))
        if queries[r.kind]:
            found = F.when(F.array_contains("kinds", r.kind), found)
        joined = joined.withColumn(f"_found{n}", found)
    none = F.array().cast("array<struct<kind:string,start:int,end:int>>")
    places = [
        F.when(F.size(f"_found{n}") > 0, spans_of(F.col(f"_found{n}"), F.col("_text"), r)).otherwise(none)
        for n, r in enumerate(rules)
    ]
    order = {r.kind: n for n, r in enumerate(rules)}

    def rank(s: Column) -> Column:
        number = reduce(lambda rest, r: F.when(s["kind"] == r.kind, order[r.kind]).otherwise(rest), rules, F.lit(0))
        return F.struct(s["start"].alias("start"), number.alias("n"), s["kind"].alias("kind"), s["end"].alias("end"))

    ranked = F.sort_array(F.transform(F.concat(*places), rank))
    plain = F.transform(ranked, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    return unshield(joined.select(*names.values(), plain.alias("spans")), names)


def joined_spans(spans: Column) -> Column:
    """kind:start:end, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
