"""Guarded read-only SQL over a fixed set of tables.

A query passes three gates. Its text must be one plain SELECT. Its parsed plan
may not compute names, since that happens while a query is analysed. Its
analysed plan, which runs nothing, may consist of known relational operators
only, read no files but those of the allowed tables, and call no code outside
Spark's own expressions.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MAX_ROWS = 2000
ROOTS = "tramline.adhoc.roots"  # session setting: the folders its queries may read

# Verbs that may not appear anywhere in a query.
VERBS = (
    "INSERT",
    "UPDATE",
    "DELETE",
    "DROP",
    "ALTER",
    "TRUNCATE",
    "CREATE",
    "GRANT",
    "REVOKE",
    "COPY",
    "CALL",
    "DO",
    "MERGE",
)

# Operators of an analysed SELECT.
OPERATORS = {
    "Aggregate",
    "CTERelationDef",
    "CTERelationRef",
    "Deduplicate",
    "Distinct",
    "Except",
    "Expand",
    "Filter",
    "Generate",
    "GlobalLimit",
    "Intersect",
    "Join",
    "LateralJoin",
    "LocalLimit",
    "LocalRelation",
    "LogicalRelation",
    "Offset",
    "OneRowRelation",
    "Project",
    "RepartitionByExpression",
    "ResolvedHint",
    "Sample",
    "Sort",
    "SubqueryAlias",
    "Union",
    "View",
    "Window",
    "WithCTE",
}
# Expressions that run code of others.
FOREIGN_CODE = {
    "ApplyFunctionExpression",
    "CallMethodViaReflection",
    "HiveGenericUDF",
    "HiveGenericUDTF",
    "HiveSimpleUDF",
    "HiveUDAFFunction",
    "PythonUDAF",
    "PythonUDF",
    "PythonUDTF",
    "ScalaAggregator",
    "ScalaUDAF",
    "ScalaUDF",
    "TryReflect",
    "UserDefinedGenerator",
    "V2Aggregator",
}

_VERB = re.compile(rf"\b(?:{'|'.join(VERBS)})\b", re.IGNORECASE)
_LIMIT = re.compile(r"\bLIMIT\s+\d+\b", re.IGNORECASE)

# Each rule: what is refused, and how it is recognised in the trimmed query.
REFUSALS: tuple[tuple[str, Callable[[str], object]], ...] = (
    ("an empty query", lambda q: not q),
    ("more than one statement", lambda q: ";" in q),
    ("anything but a SELECT", lambda q: not re.match(r"SELECT\b", q, re.IGNORECASE)),
    ("a writing or administrative verb", _VERB.search),
    ("a comment", lambda q: any(mark in q for mark in ("--", "/*", "*/"))),
)


class RefusedQuery(ValueError):
    """The query is not a plain read-only SELECT over the allowed tables."""


def guard(query: str, max_rows: int = MAX_ROWS) -> str:
    """The trimmed query, with a LIMIT when it has none; raises when it is refused."""
    text = query.strip()
    for what, refused in REFUSALS:
        if refused(text):
            raise RefusedQuery(f"not allowed: {what}")
    return text if _LIMIT.search(text) else f"{text} LIMIT {max_rows}"


def _list(seq) -> list:
    return [seq.apply(i) for i in range(seq.size())]


def _walk(plan, is_subquery: Callable[[object], bool]) -> Iterator[tuple[str, object]]:
    """``(class name, node)`` of all operators and expressions, subqueries included."""
    todo = [(plan, True)]
    while todo:
        node, is_plan = todo.pop()
        yield node.getClass().getSimpleName(), node
        todo += [(child, is_plan) for child in _list(node.children())]
        if is_plan:
            todo += [(e, False) for e in _list(node.expressions())]
            # Named subqueries of a parsed plan stand beside its children.
            inner = _list(node.innerChildren())
            todo += [(x, True) for x in inner if hasattr(x, "expressions")]
        elif is_subquery(node):
            todo.append((node.plan(), True))


def _class_test(session: SparkSession, name: str) -> Callable[[object], bool]:
    jvm = session.sparkContext._jvm
    loader = jvm.java.lang.Thread.currentThread().getContextClassLoader()
    return jvm.java.lang.Class.forName(name, False, loader).isInstance


def _files(relation) -> list[str]:
    """Folders a relation reads; a source without files has none that is allowed."""
    source = relation.relation()
    if source.getClass().getSimpleName() != "HadoopFsRelation":
        return [source.getClass().getName()]
    return [p.toString() for p in _list(source.location().rootPaths())]


def _inspect(session: SparkSession, text: str) -> DataFrame:
    """The query, analysed but not run; raises if its plan holds more than it may."""
    is_subquery = _class_test(session, "org.apache.spark.sql.catalyst.expressions.PlanExpression")
    is_plan = _class_test(session, "org.apache.spark.sql.catalyst.plans.logical.LogicalPlan")
    parsed = session._jsparkSession.sessionState().sqlParser().parsePlan(text)
    for name, _ in _walk(parsed, is_subquery):
        if "WithUnresolvedIdentifier" in name:
            raise RefusedQuery("not allowed: a computed name")
        if "ScriptTransformation" in name:
            raise RefusedQuery("not allowed: a script")
    df = session.sql(text)
    allowed = set(json.loads(session.conf.get(ROOTS)))
    for name, node in _walk(df._jdf.queryExecution().analyzed(), is_subquery):
        if name in FOREIGN_CODE:
            raise RefusedQuery("not allowed: a function that runs code")
        if is_plan(node) and name not in OPERATORS:
            raise RefusedQuery(f"not allowed: {name}")
        if name == "LogicalRelation" and not allowed.issuperset(_files(node)):
            raise RefusedQuery("not allowed: another table")
    return df


def isolated_session(spark: SparkSession, tables: Mapping[str, str]) -> SparkSession:
    """A session with the given Parquet tables as views.

    It shares the catalog with the given session; queries are held to the
    tables' own folders by their analysed plan.
    """
    session = spark.newSession()
    for setting in ("spark.sql.session.timeZone", "spark.sql.shuffle.partitions"):
        session.conf.set(setting, spark.conf.get(setting))
    roots: list[str] = []
    is_subquery = _class_test(session, "org.apache.spark.sql.catalyst.expressions.PlanExpression")
    for name, path in tables.items():
        df = session.read.parquet(path)
        for kind, node in _walk(df._jdf.queryExecution().analyzed(), is_subquery):
            if kind == "LogicalRelation":
                roots += _files(node)
        df.createOrReplaceTempView(name)
    session.conf.set(ROOTS, json.dumps(roots))
    session.conf.set("spark.sql.runSQLOnFiles", "false")
    return session


def table_names(session: SparkSession) -> list[str]:
    return sorted(t.name for t in session.catalog.listTables() if t.isTemporary)


def _safe(session: SparkSession, text: str) -> DataFrame:
    try:
        return _inspect(session, text)
    except AnalysisException as error:
        raise RefusedQuery(f"the query cannot be analysed: {error}") from error
    except RefusedQuery:
        raise
    except Exception as error:
        # The parser is called through the gateway, where its errors have no Python class.
        if "ParseException" in str(error):
            raise RefusedQuery(f"the query cannot be parsed: {error}") from error
        raise


def run(session: SparkSession, query: str, max_rows: int = MAX_ROWS) -> DataFrame:
    """The guarded result, never more than ``max_rows`` whatever the query's own limit."""
    return _safe(session, guard(query, max_rows)).limit(max_rows)


def run_json(session: SparkSession, query: str, max_rows: int = MAX_ROWS) -> str:
    """``{query, columns, rows, truncated}`` as JSON; the rows are bounded by ``max_rows``.

    ``truncated`` tells whether the query has more rows than that. Columns of one
    name are told apart by a number after the name.
    """
    df = _safe(session, guard(query, max_rows + 1)).limit(max_rows + 1)
    names: list[str] = []
    for column in df.columns:
        name, n = column, 1
        while name in names:
            n += 1
            name = f"{column}_{n}"
        names.append(name)
    places = df.toDF(*(f"c{i}" for i in range(len(names))))
    texts = [
        r[0]
        for r in places.select(
            F.to_json(F.struct(*places.columns), {"ignoreNullFields": "false"})
        ).collect()
    ]
    rows = [dict(zip(names, json.loads(t).values())) for t in texts[:max_rows]]
    return json.dumps(
        {
            "query": guard(query, max_rows),
            "columns": names,
            "rows": rows,
            "truncated": len(texts) > max_rows,
        },
        ensure_ascii=False,
    )


def context(session: SparkSession, trips: DataFrame, arrivals: DataFrame) -> DataFrame:
    """One row: the session's tables, newest snapshot, stored trips (all snapshots) and arrivals."""
    stored = arrivals.agg(F.count(F.lit(1)))
    return trips.agg(
        F.max("snapshot_date").alias("latest_snapshot"),
        F.count(F.lit(1)).alias("trips_in_latest_table"),
    ).select(
        F.lit(", ".join(table_names(session))).alias("tables"),
        F.col("latest_snapshot").cast("string").alias("latest_snapshot"),
        "trips_in_latest_table",
        stored.scalar().alias("realtime_arrivals"),
    )
