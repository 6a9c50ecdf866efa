"""Secret scanning with a trigram inverted index, in DataFrame operations only.

A Boolean trigram query is derived from the parse tree of each rule's pattern. Documents post the
trigrams that some rule asks for; intersecting the postings of a text leaves the rules it may
match, and only these patterns are run on it. A rule without mandatory trigrams is run on all texts.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from re import _parser as parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tastelens.llm.batches import fields_of, row_of, without
from tastelens.session import cut


@dataclass(frozen=True)
class Rule:
    """A kind of secret: ``group`` of a match has at least ``least`` characters, else it is
    dropped after it was consumed. Letters of the pattern count in either case on request.

    ``long`` is a pattern of just the matches that stay, for rules of which a dropped match holds
    no other one: short matches are then not even listed.
    """

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    any_case: bool = False
    long: str | None = None

    @property
    def java(self) -> str:
        return f"(?i){self.pattern}" if self.any_case else self.pattern

    @property
    def scanned(self) -> str:
        return self.long or self.java


BASE = (
    Rule(
        "assign",
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        6,
        True,
    ),
    # what follows an AKIA inside a run is shorter than the run from its first AKIA on
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20, long=r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]+", 0, 24, long=r"[0-9a-f]{24,}"),
)
MORE = (
    Rule("pem", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
    Rule("forge", r"gh[pousr]_[A-Za-z0-9]+", 0, 40),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 0, 40),
)
RULES = BASE + MORE

# Strings that a part of a pattern may stand for, before they are turned into trigrams.
MOST_STRINGS = 8
# Candidates, eight bytes each, up to which they are sent to every task; more are shuffled.
MOST_SENT = 500_000

# A query is None (no demand) or a set of conjunctions, each a set of trigrams.
Query = frozenset | None


def _both(a: Query, b: Query) -> Query:
    if a is None or b is None:
        return b if a is None else a
    return frozenset(x | y for x in a for y in b)


def _either(queries: Sequence[Query]) -> Query:
    if any(q is None for q in queries):
        return None
    return frozenset().union(*queries)


def _demand(strings: set[str]) -> Query:
    """What a text holds that holds one of the strings."""
    ways = []
    for s in strings:
        grams = frozenset(s[i : i + 3] for i in range(len(s) - 2))
        ways.append(frozenset([grams]) if grams else None)
    return _either(ways)


def _class_strings(items) -> set[str] | None:
    made = set()
    for op, value in items:
        if op is parser.LITERAL:
            made.add(chr(value).lower())
        elif op is parser.RANGE and value[1] - value[0] < MOST_STRINGS:
            made |= {chr(c).lower() for c in range(value[0], value[1] + 1)}
        else:
            return None
    return made if len(made) <= MOST_STRINGS else None


def _walk(tree) -> tuple[set[str] | None, Query]:
    """(all strings the tree stands for, or None; what any match demands)."""
    exact, demand = {""}, None
    whole = True
    for op, value in tree:
        if op is parser.LITERAL:
            strings, part = {chr(value).lower()}, None
        elif op is parser.IN:
            strings, part = _class_strings(value), None
        elif op is parser.SUBPATTERN:
            strings, part = _walk(value[-1])
        elif op is parser.BRANCH:
            found = [_walk(t) for t in value[1]]
            strings = None if any(f[0] is None for f in found) else set().union(*(f[0] for f in found))
            part = _either([_both(d, _demand(s) if s else None) for s, d in found])
        elif op in (parser.MAX_REPEAT, parser.MIN_REPEAT) and value[1] == 1:
            strings, part = _walk(value[2])
            strings, part = (strings | {""}, None) if strings is not None else (None, None)
        elif op in (parser.MAX_REPEAT, parser.MIN_REPEAT) and value[0] > 0:
            strings, part = None, _walk(value[2])[1]
        else:
            strings, part = None, None
        if strings is not None and len(exact) * len(strings) <= MOST_STRINGS:
            exact = {a + b for a in exact for b in strings}
            continue
        # the run of known strings ends here and turns into trigrams
        whole = False
        demand = _both(_both(demand, _demand(exact)), part)
        fits = strings is not None and len(strings) <= MOST_STRINGS
        exact = strings if fits else {""}
    if whole:
        return exact, None
    return None, _both(demand, _demand(exact))


def trigram_query(rule: Rule) -> Query:
    """Sets of lower-case trigrams, one of which every match holds whole; None: no demand."""
    exact, demand = _walk(parser.parse(rule.pattern))
    return _both(demand, _demand(exact)) if exact is not None else demand


def postings(docs: DataFrame, trigrams: Sequence[str], text: str = "text") -> DataFrame:
    """(trigram, text_key): the texts that hold each of the given trigrams, letters in any case.

    Equal texts share a key; a clash of keys only adds candidates, which are verified.
    """
    held = F.filter(
        F.array(*(F.lit(t) for t in trigrams)), lambda t: F.contains(F.col("_low"), t)
    )
    low = docs.select(F.xxhash64(text).alias("text_key"), F.lower(text).alias("_low"))
    return low.select("text_key", F.explode(held).alias("trigram"))


def candidates(posted: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(text_key, rules): which rules the postings of a text allow, at least one."""
    queries = {i: q for i, r in enumerate(rules) if (q := trigram_query(r)) is not None}
    grams = sorted({g for q in queries.values() for way in q for g in way})
    held = posted.groupBy("text_key").agg(
        *(F.max(F.col("trigram") == g).alias(f"g{i}") for i, g in enumerate(grams))
    )
    place = {g: F.col(f"g{i}") for i, g in enumerate(grams)}

    def allowed(query) -> Column:
        ways = [reduce(lambda a, b: a & b, [place[g] for g in sorted(way)]) for way in query]
        return reduce(lambda a, b: a | b, ways)

    flags = [F.when(allowed(q), F.lit(i)) for i, q in queries.items()]
    found = held.select("text_key", F.array_compact(F.array(*flags)).alias("rules"))
    return found.filter(F.size("rules") > 0)


def _running(values: Column, both) -> Column:
    """Running totals by ``both`` (sum or maximum) of an array of numbers from 0 on.

    Round k joins each total with that 2**k places before, so n values take n log n steps and no
    array grows element by element.
    """
    rounds = F.ceil(F.log2(F.greatest(F.size(values), F.lit(1)))).cast("int")
    shifts = F.transform(F.array_repeat(F.lit(0), rounds), lambda _, k: F.pow(F.lit(2), k).cast("int"))

    def joined(totals: Column, shift: Column) -> Column:
        earlier = F.slice(totals, F.lit(1), F.size(totals) - shift)
        return F.zip_with(totals, F.concat(F.array_repeat(F.lit(0), shift), earlier), both)

    return F.aggregate(shifts, values, joined)


def _spans(text: Column, rule: Rule) -> Column:
    """Array of (kind, begin, end, length) of one rule's matches, leftmost and not overlapping."""
    pattern = F.lit(rule.scanned)

    def lengths(strings: Column) -> Column:
        return F.transform(strings, F.length)

    cut = {
        "m": lengths(F.regexp_extract_all(text, pattern, F.lit(0))),
        "a": lengths(F.split(text, rule.scanned, -1)),
    }
    if rule.group:
        cut["g"] = lengths(F.regexp_extract_all(text, pattern, F.lit(rule.group)))

    def placed(f: Column) -> Column:
        # the last piece follows the last match
        before = F.slice(f.a, F.lit(1), F.size(f.m))
        ends = _running(F.zip_with(before, f.m, lambda a, m: a + m), lambda x, y: x + y)
        length = f.g if rule.group else f.m
        each = F.arrays_zip(ends.alias("end"), f.m.alias("m"), length.alias("length"))
        return F.transform(
            F.filter(each, lambda x: x["length"] >= rule.least),
            lambda x: F.struct(
                F.lit(rule.kind).alias("kind"),
                (x["end"] - x["m"]).alias("begin"),
                x["end"].alias("end"),
                x["length"].alias("length"),
            ),
        )

    # bound to a variable, so that the text is cut once
    found = F.struct(*(c.alias(name) for name, c in cut.items()))
    return F.get(F.transform(F.array(found), placed), F.lit(0))


def with_secrets(
    docs: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text", out: str = "secrets"
) -> DataFrame:
    """All columns of ``docs`` and the array ``out`` of (kind, begin, end), by begin, then rule.

    Spans are code points, the end exclusive. A null or empty text has no spans; very long texts
    are scanned whole; repeated rows stay; an empty table gives an empty one. A column named like
    ``out`` gives way; other columns, whatever their names, are passed on untouched.
    """
    kept = without(docs.columns, [out])
    content = F.col("row").getField(text)
    docs = docs.select(row_of(kept).alias("row"))
    queries = [trigram_query(r) for r in rules]
    grams = sorted({g for q in queries if q is not None for way in q for g in way})
    if grams:
        found = cut(candidates(postings(docs.select(content.alias("text")), grams), rules))
        if found.count() <= MOST_SENT:
            found = F.broadcast(found)
        docs = docs.withColumn("text_key", F.xxhash64(content)).join(found, "text_key", "left")
    else:
        docs = docs.withColumn("rules", F.lit(None).cast("array<int>"))
    empty = F.from_json(F.lit("[]"), "array<struct<kind:string,begin:int,end:int,length:int>>")
    parts = []
    for number, (rule, query) in enumerate(zip(rules, queries)):
        run = content.rlike(rule.scanned)
        if query is not None:
            run = F.array_contains("rules", number) & run
        parts.append(F.when(run, _spans(content, rule)).otherwise(empty))
    spans = F.flatten(F.array(*parts))
    place = F.create_map(*(x for i, r in enumerate(rules) for x in (F.lit(r.kind), F.lit(i))))
    ordered = F.array_sort(
        F.transform(
            spans,
            lambda s: F.struct(
                s["begin"].alias("begin"), place[s["kind"]].alias("place"),
                s["end"].alias("end"), s["kind"].alias("kind"),
            ),
        )
    )
    final = F.transform(
        ordered,
        lambda s: F.struct(s["kind"].alias("kind"), s["begin"].alias("begin"), s["end"].alias("end")),
    )
    return docs.select(*fields_of("row", kept), final.alias(out))


def written(spans: Column) -> Column:
    """Spans as kind:begin:end, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["begin"], s["end"])), ","
    )


def masked(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with every span, and what overlaps it, replaced by ``mark``.

    ``spans`` are ordered by their begin. The text is cut into characters once and put together
    from slices of them, however many spans there are.
    """

    def done(p: Column) -> Column:
        upto = _running(F.transform(p.spans, lambda s: s["end"]), lambda x, y: F.greatest(x, y))
        ends = F.concat(F.array(F.lit(0)), upto)
        starts = F.transform(p.spans, lambda s: s["begin"])

        def part(begin: Column, end: Column) -> Column:
            return F.array_join(F.slice(p.chars, begin + 1, F.greatest(end - begin, F.lit(0))), "")

        # a span that begins inside what is masked already adds nothing
        pieces = F.zip_with(
            F.slice(ends, F.lit(1), F.size(starts)), starts,
            lambda b, s: F.when(s >= b, F.concat(part(b, s), F.lit(mark))).otherwise(F.lit("")),
        )
        rest = F.transform(F.slice(ends, F.size(ends), F.lit(1)), lambda e: part(e, F.size(p.chars)))
        return F.array_join(F.concat(pieces, rest), "")

    chars = F.regexp_extract_all(text, F.lit("(?s)."), F.lit(0))
    parts = F.struct(chars.alias("chars"), spans.alias("spans"))
    made = F.get(F.transform(F.array(parts), done), F.lit(0))
    return F.when(F.size(spans) > 0, made).otherwise(text)
