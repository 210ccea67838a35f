"""The row-level cleaning contract as one projection and one filter."""

from __future__ import annotations

from py4j.java_gateway import JavaObject
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factprep.contract import FactContract
from factprep.functions import cleaning as C
from factprep.functions.cleaning import quoted
from factprep.functions.keys import bucket_id, row_key
from factprep.operators.quality import check_fact_schema


def project(df: DataFrame, contract: FactContract) -> DataFrame:
    """Contract columns only, whatever else the input holds."""
    return df.select(*contract.columns)


def coerce(df: DataFrame, contract: FactContract) -> DataFrame:
    """Contract columns in a comparable type each; unreadable values become null."""
    check_fact_schema(df.schema, contract)
    return df.selectExpr(*_coerced(df, contract))


def _text_times(df: DataFrame, contract: FactContract) -> list[str]:
    return [c for c in contract.times if df.schema[c].dataType.typeName() == "string"]


def _coerced(df: DataFrame, contract: FactContract) -> list[str]:
    types = {f.name: f.dataType for f in df.schema.fields}
    typed = []
    for name in contract.columns:
        if name in contract.integers:
            value = C.coerce_numeric(name, types[name])
        elif name in contract.floats:
            value = C.coerce_float(name, types[name])
        else:
            value = C.coerce_timestamp(name, types[name])
        typed.append(f"{value} AS {quoted(name)}")
    return typed


def rules(typed: DataFrame, contract: FactContract) -> dict[str, str]:
    """The predicate a coerced row must satisfy, by rule name."""
    types = {f.name: f.dataType for f in typed.schema.fields}
    numbers = [quoted(c) for c in contract.columns if c not in contract.times]
    times = [quoted(c) for c in contract.times]
    doubles = [quoted(c) for c in contract.columns if types[c].typeName() == "double"]
    whole = [quoted(c) for c in contract.integers if types[c].typeName() == "double"]
    return {
        "number_missing": " AND ".join(f"{c} IS NOT NULL" for c in numbers),
        "number_not_finite": " AND ".join(map(C.is_finite, doubles)) or "true",
        "integer_not_whole": " AND ".join(map(C.is_integral, whole)) or "true",
        "integer_out_of_range": " AND ".join(C.in_int32(quoted(c), types[c]) for c in contract.integers),
        "time_missing": " AND ".join(f"{c} IS NOT NULL" for c in times),
        "time_out_of_range": " AND ".join(map(C.in_time_range, times)),
        "distance_not_positive": f"{quoted(contract.distance)} > 0D",
        "duration_not_positive": f"{quoted(contract.end)} > {quoted(contract.start)}",
    }


def _rules_on(typed: DataFrame, contract: FactContract, columns: set[str]) -> str:
    """The rules on single columns among ``columns``, as far as a reader can apply them."""
    types = {f.name: f.dataType for f in typed.schema.fields}
    tests = ["true"]
    for name in (c for c in contract.columns if c in columns):
        column = quoted(name)
        tests.append(f"{column} IS NOT NULL")
        if name in contract.times:
            tests.append(C.in_time_range(column))
        elif name in contract.integers:
            tests.append(C.in_int32(column, types[name]))
        else:
            tests.append(C.is_finite(column))
    return " AND ".join(tests)


def is_valid(typed: DataFrame, contract: FactContract) -> str:
    return " AND ".join(f"({rule})" for rule in rules(typed, contract).values())


def normal_form(typed: DataFrame, contract: FactContract) -> dict[str, str]:
    """Stored form of a valid row's columns: whole numbers as bigint, no negative zero."""
    types = {f.name: f.dataType.typeName() for f in typed.schema.fields}
    stored = {}
    for name in contract.columns:
        column = quoted(name)
        if name in contract.integers and types[name] == "double":
            column = f"TRY_CAST({column} AS BIGINT)"
        elif name in contract.floats:
            column = C.normalize_zero(column)
        stored[name] = column
    return stored


def stored_columns(df: DataFrame) -> set[str]:
    """Columns that are a table's own, perhaps under another name, and not computed."""
    plan, kept, own = df._jdf.queryExecution().analyzed(), {}, set()

    def visit(node: JavaObject) -> None:
        children = node.children()
        if not children.size():
            own.update(_ids(node.output()))
        if node.getClass().getSimpleName() == "Project":
            for named in _each(node.projectList()):
                if named.getClass().getSimpleName() == "Alias":
                    if named.child().getClass().getSimpleName() == "AttributeReference":
                        kept[named.exprId().id()] = named.child().exprId().id()
        for child in _each(children):
            visit(child)

    visit(plan)
    found = set()
    for column in _each(plan.output()):
        at = column.exprId().id()
        while at in kept:
            at = kept[at]
        if at in own:
            found.add(column.name())
    return found


def _each(sequence: JavaObject) -> list[JavaObject]:
    return [sequence.apply(i) for i in range(sequence.size())]


def _ids(attributes: JavaObject) -> list[int]:
    return [a.exprId().id() for a in _each(attributes)]


def computed_once(df: DataFrame, *extra: str) -> DataFrame:
    """The same rows, whose computed columns the optimizer does not compute anew in every use.

    Filters move below projections and take the expressions with them, once for each
    mention. They do not move below a column that depends on the row's place, and that
    column stays only while something uses it.
    """
    placed = df.selectExpr("*", "monotonically_increasing_id() AS __place")
    return placed.where(" AND ".join(["__place >= 0", *extra])).drop("__place")


def clean(df: DataFrame, contract: FactContract) -> DataFrame:
    """Valid rows of ``df`` in the contract's stored form.

    Rules on columns that come as a table stores them reach its reader. Columns that
    are computed, here or before, are computed once a row, before their rules.
    """
    typed = coerce(df, contract)
    types = {f.name: f.dataType for f in df.schema.fields}
    own = {c for c in stored_columns(df) if isinstance(types[c], C.PLAIN)}
    if not own.issuperset(contract.columns):
        typed = computed_once(typed.where(_rules_on(typed, contract, own)))
    stored = normal_form(typed, contract)
    return typed.where(is_valid(typed, contract)).selectExpr(*[f"{v} AS {quoted(n)}" for n, v in stored.items()])


def reject_counts(df: DataFrame, contract: FactContract) -> DataFrame:
    """Rows failing each rule (a row may fail several), plus all and rejected rows; one pass.

    Times given as text that cannot be read count as missing, and also on their own.
    """
    check_fact_schema(df.schema, contract)
    texts = _text_times(df, contract)
    kept = df.selectExpr("*", *[f"{quoted(c)} AS {quoted('__text_' + c)}" for c in texts])
    typed = kept.selectExpr(*_coerced(df, contract), *[quoted("__text_" + c) for c in texts])
    tested = {**rules(typed, contract), "any_rule": is_valid(typed, contract)}
    # A rule that is null, for lack of a value, fails.
    counts = [f"struct('{n}' AS rule, count_if(({p}) IS NOT TRUE) AS row_count)" for n, p in tested.items()]
    lost = " OR ".join(f"(trim({quoted('__text_' + c)}) <> '' AND {quoted(c)} IS NULL)" for c in texts) or "false"
    counts.append(f"struct('time_unreadable' AS rule, count_if({lost}) AS row_count)")
    counts.append("struct('all_rows' AS rule, count(*) AS row_count)")
    return typed.agg(F.expr(f"array({', '.join(counts)})").alias("counts")).selectExpr("inline(counts)")


def time_spellings(df: DataFrame, contract: FactContract) -> DataFrame:
    """How the texts of each time column are spelled: ``column``, ``spelling``, ``row_count``, ``unread``.

    ``unread`` counts the texts that are spelled so but name no time there is. Nulls and blanks are left out.
    """
    texts = _text_times(df, contract)
    pairs = ", ".join(f"struct('{c}' AS column, {quoted('__text_' + c)} AS text, {quoted(c)} AS value)" for c in texts)
    if not texts:
        pairs = "struct('' AS column, '' AS text, TIMESTAMP_NTZ '1970-01-01 00:00:00' AS value)"
    kept = df.selectExpr("*", *[f"{quoted(c)} AS {quoted('__text_' + c)}" for c in texts])
    typed = kept.selectExpr(*_coerced(df, contract), *[quoted("__text_" + c) for c in texts])
    told = typed.selectExpr(f"inline(array({pairs}))").selectExpr("*", f"{C.time_spelling('text')} AS spelling")
    return (
        told.where("spelling IS NOT NULL")
        .groupBy("column", "spelling")
        .agg(F.count("*").alias("row_count"), F.count_if(F.col("value").isNull()).alias("unread"))
    )


def with_staging_columns(cleaned: DataFrame, contract: FactContract, buckets: int) -> DataFrame:
    """Add the row key and the bucket number of the staging layout."""
    return cleaned.selectExpr(
        "*", f"{row_key(contract.columns)} AS _key", f"{bucket_id(contract.columns, buckets)} AS _bucket"
    )
