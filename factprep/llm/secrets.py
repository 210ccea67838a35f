"""Secrets in texts: pattern rules whose candidates come from a trigram inverted index.

Every rule's pattern yields a Boolean trigram query: an OR of ANDs of trigrams, one AND
of which every match must hold (Cox's scheme for code search). The index lists, for each
trigram that some rule asks for, the texts that hold it. Postings are intersected by
counting, for each text and each AND, how many of its trigrams the text has. Only texts
that pass are searched by the rule's pattern; a rule without mandatory trigrams searches
all of them. Everything at run time is SQL expressions.

Texts are filed by a 64-bit hash. Two texts with the same hash share their candidates, and the
pattern decides for each, so results are exact; copies are filed once.

A null text counts as empty. Null, repeated and clashing ids do not matter, as texts are joined
by their hash; every input row gives one output row with its columns unchanged.
"""

from __future__ import annotations

import re
import re._constants as K
import re._parser as regex_parser
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factprep.llm.common import stored

#: Most strings that a part of a pattern is spelled out to, and most ANDs of a query. Beyond
#: them a query gets weaker, which costs time and loses nothing.
MOST_STRINGS = 64
MOST_ANDS = 64
#: Lengths summed in one piece, so that places take time in proportion to the number of matches.
PIECE = 256


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern``, leftmost and non-overlapping, whose ``group`` has at least ``least`` characters.

    The pattern is in the part of the syntax that Python and Java share.
    """

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


BASE_RULES = (
    Rule(
        "assign",
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        8,
    ),
    # A shorter run of the same characters cannot hold a longer one, so the length may stand in the pattern.
    Rule("access", r"AKIA[A-Z0-9]{12,}", 0, 16),
    Rule("hex", r"[0-9a-f]{32,}", 0, 32),
)
#: Kinds with a form of their own, told by public documentation of the services that hand them out.
MORE_RULES = (
    Rule("private_key", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
    Rule("repository_token", r"(?:ghp|gho|ghu|ghs|ghr)_[A-Za-z0-9]{36,}"),
    Rule("chat_token", r"xox[abpr]-[A-Za-z0-9-]{10,}"),
    Rule("map_key", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("payment_key", r"(?:sk|rk)_live_[A-Za-z0-9]{16,}"),
    Rule("bearer", r"(?i:bearer)\x20+[A-Za-z0-9_.=+/-]{20,}", 0, 28),
    Rule("address_password", r"[a-z][a-z0-9+.-]{1,20}://[^\x00-\x20:/@]{1,64}:[^\x00-\x20:/@]{3,64}@[A-Za-z0-9]"),
)

# A query is a set of ANDs, each a set of trigrams; the empty AND holds for every text.
Query = frozenset[frozenset[str]]
ANY: Query = frozenset([frozenset()])


def _spelled(strings: Iterable[str]) -> Query:
    """What a text must hold if it holds one of the strings."""
    return _simplest(frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings)


def _simplest(ands: Iterable[frozenset[str]]) -> Query:
    """Without ANDs that another one follows from; the empty AND alone if there is one or there are too many."""
    ands = set(ands)
    kept = frozenset(a for a in ands if not any(b < a for b in ands))
    return kept if 0 < len(kept) <= MOST_ANDS else ANY


def _both(one: Query, other: Query) -> Query:
    found = frozenset(a | b for a in one for b in other)
    # Too many: either query alone is necessary too.
    return _simplest(found) if len(found) <= MOST_ANDS else max(one, other, key=lambda q: min(map(len, q)))


def _characters(items: list) -> list[str] | None:
    """The members of a character class, lower-cased, if they are few."""
    found: set[str] = set()
    for kind, value in items:
        if kind is K.LITERAL:
            found.add(chr(value).lower())
        elif kind is K.RANGE and value[1] - value[0] < MOST_STRINGS:
            found.update(chr(c).lower() for c in range(value[0], value[1] + 1))
        else:
            return None
    return sorted(found) if len(found) <= 8 else None


def _walk(nodes: Iterable) -> tuple[set[str] | None, Query]:
    """The strings that a part of a pattern may match, if they are few and known, and its query."""
    query, run = ANY, {""}

    def known(strings: Iterable[str]) -> None:
        nonlocal run, query
        joined = {a + b for a in run for b in strings}
        if len(joined) > MOST_STRINGS:
            unknown()
            joined = set(strings)
        run = joined

    whole = True

    def unknown() -> None:
        nonlocal run, query, whole
        query, run, whole = _both(query, _spelled(run)), {""}, False

    for kind, value in nodes:
        if kind is K.LITERAL:
            known([chr(value).lower()])
        elif kind is K.IN:
            members = _characters(value)
            known(members) if members else unknown()
        elif kind is K.SUBPATTERN:
            strings, inner = _walk(value[3])
            known(strings) if strings is not None else unknown()
            query = _both(query, inner)
        elif kind is K.BRANCH:
            parts = [_walk(branch) for branch in value[1]]
            if all(strings is not None for strings, _ in parts):
                known(set().union(*(strings for strings, _ in parts)))
            else:
                unknown()
                alternatives = [_both(q, _spelled(s)) if s is not None else q for s, q in parts]
                query = _both(query, _simplest(frozenset().union(*alternatives)))
        elif kind in (K.MAX_REPEAT, K.MIN_REPEAT, K.POSSESSIVE_REPEAT):
            least, most, inside = value
            strings, inner = _walk(inside)
            if strings is not None and (least, most) == (0, 1):
                known({"", *strings})
            elif strings is not None and least == most and least <= 4:
                for _ in range(least):
                    known(strings)
            else:
                # At least so many copies stand side by side, after what came before them.
                if least and strings is not None:
                    for _ in range(min(least, 4)):
                        known(strings)
                unknown()
                query = _both(query, inner) if least else query
        elif kind in (K.AT, K.ASSERT, K.ASSERT_NOT):
            pass
        else:
            unknown()
    return (run, query) if whole else (None, _both(query, _spelled(run)))


def trigram_query(pattern: str) -> Query | None:
    """The Boolean query that every lower-cased text with a match satisfies; None if it cannot tell texts apart."""
    strings, query = _walk(regex_parser.parse(pattern))
    if strings is not None:
        query = _both(query, _spelled(strings))
    return None if query == ANY else query


def text_key(text: str = "text") -> Column:
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def trigram_index(docs: DataFrame, trigrams: Sequence[str], text: str = "text") -> DataFrame:
    """Postings ``trigram``, ``key`` of the given trigrams: which lower-cased texts hold them.

    Few of all trigrams occur in rules, so the index is small beside the texts. Copies of a
    text are combined before they are shuffled.
    """
    held = F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(_any_of(trigrams)), F.lit(1)))
    filed = docs.select(text_key(text).alias("key"), held.alias("held"))
    return filed.groupBy("key").agg(F.first("held").alias("held")).select(F.explode("held").alias("trigram"), "key")


def _any_of(trigrams: Sequence[str]) -> str:
    """A pattern that finds every place of any of the trigrams, also where they overlap: a tree by first characters."""
    tree: dict[str, dict[str, list[str]]] = {}
    for one, two, three in sorted(set(trigrams)):
        tree.setdefault(one, {}).setdefault(two, []).append(three)
    branches = []
    for one, below in tree.items():
        ends = [re.escape(two) + "(?:" + "|".join(map(re.escape, threes)) + ")" for two, threes in below.items()]
        branches.append(re.escape(one) + "(?:" + "|".join(ends) + ")")
    first = "".join(re.escape(one) for one in tree)
    return f"(?=[{first}])(?=({'|'.join(branches)}))"


def candidates(index: DataFrame, queries: dict[str, Query]) -> DataFrame:
    """``key`` and the ``kinds`` of rules whose query the text satisfies, by intersecting postings."""
    spark = index.sparkSession
    needs = [
        (kind, number, len(one), trigram)
        for kind, query in queries.items()
        for number, one in enumerate(sorted(map(sorted, query)))
        for trigram in one
    ]
    asked = spark.createDataFrame(needs, "kind string, number int, needed int, trigram string")
    # The rules' own trigrams: at most MOST_ANDS sets for each rule.
    met = index.join(F.broadcast(asked), "trigram").groupBy("key", "kind", "number", "needed").agg(
        F.count("*").alias("held")
    )
    return met.where("held = needed").groupBy("key").agg(F.collect_set("kind").alias("kinds"))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body mentions it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("long"), lambda n, v: n + v)


def running(lengths: Column) -> Column:
    """Sums of the elements before each element, in pieces so that long arrays take linear time."""

    def pieces(values: Column) -> Column:
        last = F.greatest(F.lit(0), F.floor((F.size(values) - 1) / PIECE).cast("int"))
        return F.transform(F.sequence(F.lit(0), last), lambda p: F.slice(values, p * PIECE + 1, F.lit(PIECE)))

    def within(piece: Column, before: Column) -> Column:
        return F.transform(piece, lambda _, j: before + _total(F.slice(piece, F.lit(1), j)))

    def across(parts: Column, sums: Column) -> Column:
        return F.transform(
            parts, lambda piece, i: _let(_total(F.slice(sums, F.lit(1), i)), lambda before: within(piece, before))
        )

    placed = _let(
        lengths, lambda v: _let(pieces(v), lambda parts: _let(F.transform(parts, _total), lambda sums: across(parts, sums)))
    )
    return F.flatten(placed)


def matches(text: Column, rule: Rule) -> Column:
    """Structs ``start``, ``end`` (code points, end exclusive) of a rule's matches that are long enough.

    The text between matches and the matches themselves, in turn, make up the text; their lengths place them.
    """
    pattern = F.lit(rule.pattern)
    size = lambda s: F.length(s)
    matched = F.transform(F.regexp_extract_all(text, pattern, F.lit(0)), size)
    measured = F.transform(F.regexp_extract_all(text, pattern, F.lit(rule.group)), size)
    between = F.transform(F.split(text, rule.pattern, -1), size)

    def places(found: Column) -> Column:
        gap = lambda i: F.get(found["between"], i)
        lengths = F.transform(found["matched"], lambda m, i: gap(i) + m)
        return _let(
            running(lengths),
            lambda before: F.transform(
                found["matched"],
                lambda m, i: F.struct(
                    (F.get(before, i) + gap(i)).alias("start"),
                    (F.get(before, i) + gap(i) + m).alias("end"),
                    F.get(found["measured"], i).alias("measured"),
                ),
            ),
        )

    found = F.struct(matched.alias("matched"), measured.alias("measured"), between.alias("between"))
    return F.filter(_let(found, places), lambda p: p["measured"] >= rule.least)


def find_secrets(docs: DataFrame, rules: Sequence[Rule], text: str = "text", name: str = "secrets") -> DataFrame:
    """``docs`` with an array of ``start``, ``end``, ``kind``, sorted by start and then by the order of rules."""
    if len({r.kind for r in rules}) < len(rules):
        raise ValueError("Each rule needs a kind of its own.")
    queries = {r.kind: trigram_query(r.pattern) for r in rules}
    asked = {kind: query for kind, query in queries.items() if query is not None}
    trigrams = sorted({t for query in asked.values() for one in query for t in one})
    rows = docs.withColumn("__key", text_key(text))
    if trigrams:
        index = stored(trigram_index(docs, trigrams, text), "trigrams")
        hits = candidates(index, asked).withColumnsRenamed({"key": "__key", "kinds": "__kinds"})
        rows = rows.join(hits, "__key", "left")
    whole = F.coalesce(F.col(text), F.lit(""))
    none = "array<struct<start:bigint,end:bigint,rule:int>>"
    found = []
    for number, rule in enumerate(rules):
        placed = _of_rule(matches(whole, rule), number)
        looked_at = F.array_contains("__kinds", rule.kind) if rule.kind in asked else whole.rlike(rule.pattern)
        found.append(F.when(looked_at, placed).otherwise(F.array().cast(none)))
    ordered = F.array_sort(
        F.concat(*found), lambda a, b: F.when(_before(a, b), -1).when(_before(b, a), 1).otherwise(0)
    )
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    named = F.transform(
        ordered, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.get(kinds, s["rule"]).alias("kind"))
    )
    own = [c for c in docs.columns if c != name]
    return rows.select(*own, named.alias(name))


def _of_rule(places: Column, number: int) -> Column:
    return F.transform(
        places, lambda p: F.struct(p["start"].alias("start"), p["end"].alias("end"), F.lit(number).alias("rule"))
    )


def _before(a: Column, b: Column) -> Column:
    return (a["start"] < b["start"]) | ((a["start"] == b["start"]) & (a["rule"] < b["rule"]))


def listed(spans: Column) -> Column:
    """``kind:start:end`` of the spans, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def summary(docs: DataFrame, text: str = "text") -> DataFrame:
    """Counts and digest of the base kinds and all spans, by ``doc_id``."""
    found = find_secrets(docs, BASE_RULES + MORE_RULES, text, "__secrets")
    base = [r.kind for r in BASE_RULES]
    of = lambda *kinds: F.filter("__secrets", lambda s: s["kind"].isin(*kinds))
    return found.select(
        "doc_id",
        *[F.size(of(kind)).cast("long").alias(f"n_{kind}") for kind in base],
        F.sha2(listed(of(*base)).cast("binary"), 256).alias("base_sha256"),
        listed(F.col("__secrets")).alias("spans"),
    )
