"""URL filter: pattern rules, looked up by their rarest literal token.

A rule's pattern is literal text with ``*`` (anything), ``^`` (a separator or
the end), ``|`` (start or end of the address) and ``||`` (start of the host or
of one of its parent domains). Its tokens are the runs of letters and digits
that no address can continue on either side; the rule is filed under the one
that the fewest addresses hold. An address is cut into tokens, fetches the rules
filed under them, and only those run their regular expressions. Rules without
such a token are tried on every address.

Patterns see the address with its host in lower case. The matching rule with
the greatest (priority, pattern length) decides; equal ones are ordered by
pattern text. A null address, or one without ``://``, has an empty host and
path, matches no rule anchored to a host, and gets the default verdict unless
another pattern fits. Repeated rows are judged alike; other columns pass
through, those named like the results are replaced.
"""

from __future__ import annotations

import re
import sys
from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

TOKEN = re.compile(r"[a-z0-9]+")
ADDRESS = re.compile(r"://([^/?#]*)([^?#]*)", re.DOTALL)
#: Rules go to the executors in blocks of at most this many.
BLOCK = 50_000
VERDICT = "host string, path string, rule string, priority int, verdict string, tried int"


@dataclass(frozen=True)
class Rule:
    pattern: str
    verdict: str
    name: str | None = None
    priority: int = 0

    def order(self) -> tuple[int, int, str]:
        return self.priority, len(self.pattern), self.pattern


def host_rule(text: str, verdict: str, priority: int = 1) -> Rule:
    """A rule for a host, its subdomains and a start of the path."""
    return Rule("||" + text, verdict, text, priority)


def expression(pattern: str) -> str:
    """The regular expression that a pattern stands for."""
    host, body = pattern.startswith("||"), pattern.removeprefix("||")
    start = not host and body.startswith("|")
    body = body[1:] if start else body
    end = body.endswith("|")
    body = body[:-1] if end else body
    parts = {"*": ".*", "^": r"(?:[^A-Za-z0-9._%-]|\Z)"}
    middle = "".join(parts.get(c) or re.escape(c) for c in body)
    return (r"^(?:(?!://).)*://(?:[^/?#]*\.)?" if host else "^" if start else "") + middle + (r"\Z" if end else "")


def literal_tokens(pattern: str) -> list[str]:
    """Tokens that every address matching the pattern holds as whole tokens."""
    anchored, body = pattern.startswith("|"), pattern.lstrip("|")
    ended, body = body.endswith("|"), body.rstrip("|")
    found = []
    for m in TOKEN.finditer(ascii_lower(body)):
        left = body[m.start() - 1] != "*" if m.start() else anchored
        right = body[m.end()] != "*" if m.end() < len(body) else ended
        if left and right:
            found.append(m[0])
    return found


def parts(url: str | None) -> tuple[str, str]:
    m = ADDRESS.search(url or "")
    return (ascii_lower(m[1]), m[2]) if m else ("", "")


def ascii_lower(text: str) -> str:
    return text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")


def normalised(url: str | None) -> str:
    m = ADDRESS.search(url or "")
    return url[: m.start(1)] + ascii_lower(m[1]) + url[m.end(1) :] if m else url or ""


def token_counts(pages: DataFrame, url: str, tokens: Iterable[str]) -> dict[str, int]:
    """How many addresses hold each of the tokens that rules name."""
    wanted = sorted(set(tokens))
    if not wanted:
        return {}
    spark = pages.sparkSession
    named = spark.createDataFrame([(t,) for t in wanted], "token string")
    held = pages.select(F.explode(F.array_distinct(F.split(F.lower(F.col(url)), "[^a-z0-9]+"))).alias("token"))
    # The rules' tokens come from the driver; a list beyond a block of rules is left to Spark's own choice.
    named = F.broadcast(named) if len(wanted) <= BLOCK else named
    return {r.token: r.n for r in held.join(named, "token").groupBy("token").agg(F.count("*").alias("n")).collect()}


def index(rules: Iterable[Rule], counts: dict[str, int]) -> dict[str | None, list[Rule]]:
    """Rules by their rarest token; None for those without one."""
    filed: dict[str | None, list[Rule]] = defaultdict(list)
    for rule in rules:
        tokens = literal_tokens(rule.pattern)
        filed[min(tokens, key=lambda t: (counts.get(t, 0), t)) if tokens else None].append(rule)
    return dict(filed)


def decide(url: str | None, filed: dict, compiled: dict) -> tuple[Rule | None, int]:
    """The deciding rule and the number of expressions run."""
    address = normalised(url)
    best, tried = None, 0
    for token in {None, *TOKEN.findall(ascii_lower(address))}:
        for rule in filed.get(token, ()):
            tried += 1
            if compiled[rule.pattern].search(address) and (best is None or rule.order() > best.order()):
                best = rule
    return best, tried


def _verdicts(filed: dict):
    @F.pandas_udf(VERDICT)
    def verdicts(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        compiled = {r.pattern: re.compile(expression(r.pattern), re.DOTALL) for rs in filed.values() for r in rs}
        for urls in batches:
            rows = []
            for u in urls:
                rule, tried = decide(u, filed, compiled)
                found = (rule.pattern, rule.priority, rule.verdict) if rule else (None, None, None)
                rows.append((*parts(u), *found, tried))
            yield pd.DataFrame(rows, columns=["host", "path", "rule", "priority", "verdict", "tried"])

    return verdicts


def judge(pages: DataFrame, rules: list[Rule], url: str = "url", default: str = "allow") -> DataFrame:
    """Every row with its host, path, deciding rule and verdict, without a shuffle."""
    counts = token_counts(pages, url, (t for r in rules for t in literal_tokens(r.pattern)))
    blocks = [rules[i : i + BLOCK] for i in range(0, len(rules), BLOCK)] or [[]]
    judged = [_verdicts(index(block, counts))(F.col(url)) for block in blocks]
    names = {r.pattern: r.name for r in rules}
    out = pages
    for i, j in enumerate(judged):
        out = out.withColumn(f"__judged{i}", j)
    order = [
        F.struct(F.col(f"__judged{i}.priority"), F.length(f"__judged{i}.rule").alias("n"), F.col(f"__judged{i}.rule"),
                 F.col(f"__judged{i}.verdict"))
        for i in range(len(judged))
    ]
    best = F.greatest(*order) if len(order) > 1 else order[0]
    out = out.withColumn("__best", best)
    named = F.expr("CASE WHEN startswith(__best.rule, '||') AND __best.priority > 0 THEN substring(__best.rule, 3) END")
    assert all(n is None or p == "||" + n for p, n in names.items()), "only host rules have names"
    return out.withColumns(
        {
            "host": F.col("__judged0.host"),
            "path": F.col("__judged0.path"),
            "rule": named,
            "pattern": F.col("__best.rule"),
            "verdict": F.coalesce(F.col("__best.verdict"), F.lit(default)),
            "tried": sum((F.col(f"__judged{i}.tried") for i in range(len(judged))), F.lit(0)),
        }
    ).drop("__best", *[f"__judged{i}" for i in range(len(judged))])
