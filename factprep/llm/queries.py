"""Queries of the corpus operators over whole tables, and their SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factprep.llm import (
    decontaminate,
    fingerprints,
    hmm,
    lexical,
    line_dedup,
    packing,
    pii,
    quality,
    secrets,
    simhash,
    toxicity,
    url_rules,
    whitening,
)
from factprep.llm.common import labelled, remainder, table

BASE_RULES = [
    url_rules.host_rule("net/", "block"),
    url_rules.host_rule("example.net/en/", "allow"),
    url_rules.host_rule("example.com/de/", "block"),
    url_rules.host_rule("org/fr/", "allow"),
]
#: Addresses that repeat a page under another name, or that are no reading matter.
PATTERN_RULES = [
    url_rules.Rule("?utm_source=", "block"),
    url_rules.Rule("&ref=", "block"),
    url_rules.Rule("/cgi-bin/", "block"),
    url_rules.Rule("/login^", "block"),
    url_rules.Rule(".exe|", "block"),
    url_rules.Rule("||ads.*^", "block"),
]


def op1_fingerprints(spark: SparkSession, root: str) -> DataFrame:
    rows = fingerprints.compared_with_edits(table(spark, root, "documents"))
    done = fingerprints.with_likeness(rows, {"near_edited": ("own", "edited"), "near_next": ("own", "next")})
    return done.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        fingerprints.fingerprint("own").alias("fingerprint"),
        fingerprints.fingerprint("edited").alias("edited_fingerprint"),
        "near_edited",
        "near_next",
    )


def op2_toxicity(spark: SparkSession, root: str) -> DataFrame:
    docs = table(spark, root, "documents").select("doc_id", "text")
    model = toxicity.fit(labelled(docs, table(spark, root, "labels"), "toxic"))
    return toxicity.with_scores(docs, model).select(
        "doc_id",
        (remainder("doc_id", 5) == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op4_url_rules(spark: SparkSession, root: str) -> DataFrame:
    pages = table(spark, root, "pages").select("page_id", "url")
    return url_rules.judge(pages, BASE_RULES + PATTERN_RULES).select("page_id", "host", "path", "rule", "verdict")


def op9_quality(spark: SparkSession, root: str) -> DataFrame:
    docs = table(spark, root, "documents").select("doc_id", "text")
    model = quality.fit(labelled(docs, table(spark, root, "labels"), "quality"))
    return quality.with_scores(docs, model).select(
        "doc_id",
        (remainder("doc_id", 5) == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


def op7_simhash(spark: SparkSession, root: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, root, "documents"))


def op10_decontaminate(spark: SparkSession, root: str) -> DataFrame:
    return decontaminate.contaminations(
        table(spark, root, "documents").select("doc_id", "text"), table(spark, root, "benchmark")
    )


def op3_line_dedup(spark: SparkSession, root: str) -> DataFrame:
    done = line_dedup.without_copies(table(spark, root, "documents").select("doc_id", "text"))
    runs = F.transform("deleted", lambda r: F.concat_ws("-", r["start"], r["start"] + r["size"] - 1))
    return done.select(
        "doc_id",
        F.col("lines").cast("long").alias("n_lines"),
        F.coalesce(F.aggregate("deleted", F.lit(0).cast("long"), lambda n, r: n + r["size"]), F.lit(0)).alias("n_deleted"),
        F.concat_ws(",", runs).alias("deleted_lines"),
        F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"),
    )


def op5_packing(spark: SparkSession, root: str) -> DataFrame:
    import public_tokenizers

    return packing.packed(
        table(spark, root, "documents").select("doc_id", "text"),
        public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.PATTERN,
    )


def op6_pii(spark: SparkSession, root: str) -> DataFrame:
    docs = table(spark, root, "documents").select("doc_id", "text")
    return pii.found(docs, pii.fit(docs)).select(
        "doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_added"
    )


def op8_hmm(spark: SparkSession, root: str) -> DataFrame:
    return hmm.scored(table(spark, root, "documents").select("doc_id", "text"))


def op11_secrets(spark: SparkSession, root: str) -> DataFrame:
    return secrets.summary(table(spark, root, "documents").select("doc_id", "text"))


def op12_lexical(spark: SparkSession, root: str) -> DataFrame:
    return lexical.ranked(table(spark, root, "documents").select("doc_id", "text"), table(spark, root, "benchmark"))


def op13_whitening(spark: SparkSession, root: str) -> DataFrame:
    return whitening.whitened(table(spark, root, "embeddings").select("vec_id", "embedding"))


def _secrets_sql() -> str:
    """Every rule on every text; the pieces between matches and the matches place each match."""

    def matches(number: int, rule: secrets.Rule) -> str:
        pattern = rule.pattern.replace("'", "''")
        return f"""
          SELECT row, '{rule.kind}' AS kind, {number} AS rule, i, m, g, s FROM (
            SELECT row, regexp_extract_all(t, '{pattern}', 0) AS m, regexp_extract_all(t, '{pattern}', {rule.group}) AS g,
                   string_split_regex(t, '{pattern}') AS s FROM texts) hits, unnest(range(1, len(m) + 1)) AS u(i)
          WHERE length(g[i]) >= {rule.least}"""

    every = " UNION ALL ".join(matches(n, r) for n, r in enumerate(secrets.BASE_RULES + secrets.MORE_RULES))
    base = ", ".join(f"'{r.kind}'" for r in secrets.BASE_RULES)
    counts = ", ".join(
        f"CAST(count(*) FILTER (WHERE kind = '{r.kind}') AS BIGINT) AS n_{r.kind}" for r in secrets.BASE_RULES
    )
    whole = "kind || ':' || begins || ':' || ends, ',' ORDER BY begins, rule"
    return f"""
        WITH texts AS (SELECT doc_id, coalesce(text, '') AS t, row_number() OVER () AS row FROM documents),
        found AS ({every}),
        placed AS (
          SELECT row, kind, rule, begins, begins + length(m[i]) AS ends FROM (
            SELECT *, list_sum(list_transform(s[1:i], lambda x: length(x)))
                    + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS begins FROM found))
        SELECT any_value(doc_id) AS doc_id, {counts},
               sha256(coalesce(string_agg({whole}) FILTER (WHERE kind IN ({base})), '')) AS base_sha256,
               coalesce(string_agg({whole}), '') AS spans
        FROM texts LEFT JOIN placed USING (row) GROUP BY row
    """


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_fingerprints": op1_fingerprints,
    "op2_toxicity": op2_toxicity,
    "op3_line_dedup": op3_line_dedup,
    "op4_url_rules": op4_url_rules,
    "op5_packing": op5_packing,
    "op6_pii": op6_pii,
    "op7_simhash": op7_simhash,
    "op8_hmm": op8_hmm,
    "op9_quality": op9_quality,
    "op10_decontaminate": op10_decontaminate,
    "op11_secrets": op11_secrets,
    "op12_lexical": op12_lexical,
    "op13_whitening": op13_whitening,
}

ORACLES: dict[str, str] = {
    # Every run of lines of at least 50 words that is as short as its first or last line allows,
    # compared line by line with all earlier ones; a copy that overlaps its first one goes from that one's end.
    "op3_line_dedup": r"""
        WITH texts AS (
          SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents
        ), lines AS (
          SELECT doc_id, unnest(range(1, len(ls) + 1)) AS pos, unnest(ls) AS line FROM texts
        ), summed AS (
          SELECT *, sum(w) OVER (PARTITION BY doc_id ORDER BY pos) AS upto FROM (
            SELECT *, greatest(1, len(regexp_extract_all(line, '[^ \t\r\x0b\x0c]+'))) AS w FROM lines)
        ), runs AS (
          SELECT a.doc_id, a.pos AS first, min(b.pos) AS last FROM summed a JOIN summed b
            ON a.doc_id = b.doc_id AND b.pos >= a.pos AND b.upto - a.upto + a.w >= 50 GROUP BY a.doc_id, a.pos
          UNION
          SELECT b.doc_id, max(a.pos), b.pos FROM summed a JOIN summed b
            ON a.doc_id = b.doc_id AND b.pos >= a.pos AND b.upto - a.upto + a.w >= 50 GROUP BY b.doc_id, b.pos
        ), ranked AS (
          SELECT r.*, row_number() OVER same AS copy,
                 CASE WHEN first_value(r.doc_id) OVER same = r.doc_id
                      THEN greatest(first, first_value(first) OVER same + last - first + 1) ELSE first END AS past
          FROM runs r JOIN texts USING (doc_id)
          WINDOW same AS (PARTITION BY ls[first:last] ORDER BY r.doc_id, first)
        ), gone AS (
          SELECT DISTINCT doc_id, unnest(range(past, last + 1)) AS pos FROM ranked WHERE copy > 1
        ), islands AS (
          SELECT doc_id, min(pos) - 1 AS first, max(pos) - 1 AS last, count(*) AS n FROM (
            SELECT *, pos - row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS island FROM gone)
          GROUP BY doc_id, island
        ), listed AS (
          SELECT doc_id, CAST(sum(n) AS BIGINT) AS n_deleted, string_agg(first || '-' || last, ',' ORDER BY first) AS runs
          FROM islands GROUP BY doc_id
        ), kept AS (
          SELECT doc_id, string_agg(line, chr(10) ORDER BY pos) AS text
          FROM lines ANTI JOIN gone USING (doc_id, pos) GROUP BY doc_id
        )
        SELECT doc_id, CAST(len(ls) AS BIGINT) AS n_lines, coalesce(n_deleted, 0) AS n_deleted,
               coalesce(runs, '') AS deleted_lines, sha256(coalesce(kept.text, '')) AS kept_sha256
        FROM texts LEFT JOIN listed USING (doc_id) LEFT JOIN kept USING (doc_id)
    """,
    "op4_url_rules": r"""
        WITH parts AS (
          SELECT page_id, coalesce(url, '') AS url, strpos(coalesce(url, ''), '://') AS mark FROM pages
        ), rest AS (
          SELECT page_id, url, CASE WHEN mark > 0 THEN substr(url, mark + 3) ELSE '' END AS rest,
                 CASE WHEN mark > 0 THEN substr(url, 1, mark + 2) ELSE '' END AS scheme FROM parts
        ), cut AS (
          SELECT page_id, scheme, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM rest
        ), named AS (
          SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                 regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path,
                 substr(rest, length(raw) + 1) AS tail, scheme, rest FROM cut
        ), ruled AS (
          SELECT *, scheme || host || tail AS address,
            CASE WHEN ('.' || host) LIKE '%.example.net' AND starts_with(path, '/en/') THEN 'example.net/en/'
                 WHEN ('.' || host) LIKE '%.example.com' AND starts_with(path, '/de/') THEN 'example.com/de/'
                 WHEN ('.' || host) LIKE '%.org' AND starts_with(path, '/fr/') THEN 'org/fr/'
                 WHEN ('.' || host) LIKE '%.net' AND starts_with(path, '/') THEN 'net/' END AS rule
          FROM named
        )
        SELECT page_id, host, path, rule,
          CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
               WHEN contains(address, '?utm_source=') OR contains(address, '&ref=') OR contains(address, '/cgi-bin/')
                 OR regexp_matches(address, '/login([^A-Za-z0-9._%-]|$)') OR ends_with(address, '.exe')
                 OR (scheme <> '' AND regexp_matches(host || tail, '^([^/?#]*\.)?ads\..*([^A-Za-z0-9._%-]|$)'))
               THEN 'block' ELSE 'allow' END AS verdict
        FROM ruled
    """,
    "op11_secrets": _secrets_sql(),
    # Every term of every document, joined with every item's terms.
    "op12_lexical": r"""
        WITH words AS (
          SELECT doc_id, row, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
          FROM (SELECT doc_id, text, row_number() OVER () AS row FROM documents)
        ), counted AS (
          SELECT row, any_value(doc_id) AS doc_id, term, count(*) AS tf FROM words GROUP BY row, term
        ), sizes AS (
          SELECT row, CAST(sum(tf) AS BIGINT) AS n FROM counted GROUP BY row
        ), whole AS (
          SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS total FROM sizes
        ), asked AS (
          SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
          FROM benchmark
        ), weighed AS (
          SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS w
          FROM (SELECT term, count(*) AS df FROM counted GROUP BY term), whole
        ), scored AS (
          SELECT item_id, row, any_value(doc_id) AS doc_id,
                 CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // total)))) AS BIGINT) AS score
          FROM asked JOIN counted USING (term) JOIN weighed USING (term) JOIN sizes USING (row), whole
          GROUP BY item_id, row
        )
        SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (
          SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0)
        WHERE rank <= 10
    """,
}
