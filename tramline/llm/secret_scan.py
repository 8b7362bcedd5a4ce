"""Secrets in texts, with a ledger of the contents that have been scanned.

Method: every version of a document is a path to a blob, and a blob is known by
the SHA-256 of its bytes. The ledger is a table of (blob, rule version) pairs
with their findings. A run scans only pairs that the ledger lacks, appends
them, and joins the findings of all pairs back to all paths. A content that a
third of all documents hold is one blob: it is scanned once, and the findings
join back through a join that may split its rows.

Only DataFrame expressions run: matches come from ``regexp_extract_all``, the
text between them from ``split`` by the same pattern, and their running lengths
are the positions. Offsets count code points; ends are exclusive.

Defined results: a NULL text is the empty text. Ids may be NULL or repeat; each
row gets the findings of its own text. Other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.errors import AnalysisException

from tramline.session import scratch_dir


@dataclass(frozen=True)
class Rule:
    """A pattern and the least length of its match or, if given, of a group.

    ``hint`` is a pattern without which no match is possible, cheap to look for.
    """

    kind: str
    pattern: str
    least: int
    group: int = 0
    hint: str = ""
    version: int = 1


# The base kinds, in their order.
BASE = (
    Rule(
        "assign",
        r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        12,
        2,
        "(?i)passw|secret|token|api_?key",
    ),
    Rule("access", "AKIA[A-Z0-9]+", 18, 0, "AKIA"),
    Rule("hex", "[0-9a-f]+", 16, 0, "[0-9a-f]{16}"),
)
# Spans beyond the base: private keys in armour, and signed web tokens.
MORE = (
    Rule(
        "armour",
        r"-----BEGIN [A-Z ]*PRIVATE KEY-----[A-Za-z0-9+/=\s]*(?:-----END [A-Z ]*PRIVATE KEY-----)?",
        1,
        0,
        "PRIVATE KEY-----",
    ),
    Rule("web", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 20, 0, "eyJ"),
)
RULES = BASE + MORE
LEDGER_SCHEMA = "blob string, kind string, version int, spans array<struct<lo: int, hi: int>>"


def spans(text: Column, rule: Rule) -> Column:
    """``array<struct<lo, hi>>`` of the leftmost matches that do not overlap, without the short ones."""
    pattern = F.lit(rule.pattern)
    gaps = F.transform(F.split(text, rule.pattern, -1), F.length)
    wholes = F.transform(F.regexp_extract_all(text, pattern, F.lit(0)), F.length)

    def step(gap, whole, part):
        return F.struct(gap.alias("gap"), F.coalesce(whole, F.lit(0)).alias("whole"), F.coalesce(part, F.lit(0)).alias("part"))

    steps = F.zip_with(gaps, wholes, lambda gap, whole: step(gap, whole, whole))
    if rule.group:
        parts = F.transform(F.regexp_extract_all(text, pattern, F.lit(rule.group)), F.length)
        steps = F.zip_with(steps, parts, lambda s, part: step(s["gap"], s["whole"], part))
    start = F.struct(F.lit(0).alias("at"), F.expr("CAST(array() AS array<struct<lo: int, hi: int>>)").alias("found"))
    walked = F.aggregate(
        steps,
        start,
        lambda s, x: F.struct(
            (s["at"] + x["gap"] + x["whole"]).alias("at"),
            F.when(
                x["part"] >= rule.least,
                F.concat(
                    s["found"],
                    F.array(
                        F.struct((s["at"] + x["gap"]).alias("lo"), (s["at"] + x["gap"] + x["whole"]).alias("hi"))
                    ),
                ),
            )
            .otherwise(s["found"])
            .alias("found"),
        ),
        lambda s: s["found"],
    )
    none = F.expr("CAST(array() AS array<struct<lo: int, hi: int>>)")
    return F.when(text.rlike(rule.hint), walked).otherwise(none)


def read_ledger(spark, path: str) -> DataFrame | None:
    """The ledger at ``path``, or None if nothing has been written there."""
    try:
        return spark.read.schema(LEDGER_SCHEMA).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def update_ledger(versions: DataFrame, path: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Scan what the ledger at ``path`` lacks of ``versions(doc_id, text)``; returns all versions with their blob.

    The blobs are read from the documents that hold them: the least id of each,
    so a text is moved once and copies are not scanned.
    """
    spark = versions.sparkSession
    texts = versions.select(
        F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    ).withColumn("blob", F.sha2("text", 256))
    home = scratch_dir(spark, "paths")
    # Written: the digests are taken once, and everything but the scan works without texts.
    texts.select("doc_id", "blob").write.parquet(home)
    paths = spark.read.schema("doc_id long, blob string").parquet(home)
    ledger = read_ledger(spark, path)
    wanted = paths.groupBy("blob").agg(F.min("doc_id").alias("holder"))
    rule_list = F.array(*[F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version")) for r in rules])
    unseen = wanted.withColumn("seen", F.expr("CAST(array() AS array<struct<kind: string, version: int>>)"))
    if ledger is not None:
        seen = ledger.groupBy("blob").agg(F.collect_set(F.struct("kind", "version")).alias("had"))
        unseen = wanted.join(seen, "blob", "left").select(
            "blob",
            "holder",
            F.coalesce("had", F.expr("CAST(array() AS array<struct<kind: string, version: int>>)")).alias("seen"),
        )
        unseen = unseen.where(F.size(F.array_except(rule_list, "seen")) > 0)
    todo = texts.join(
        unseen.select(F.col("blob").alias("unseen_blob"), "holder", "seen"),
        F.col("doc_id").eqNullSafe(F.col("holder")) & (F.col("blob") == F.col("unseen_blob")),
    )

    def scanned(rule: Rule) -> Column:
        pair = F.struct(F.lit(rule.kind).alias("kind"), F.lit(rule.version).alias("version"))
        found = F.when(~F.array_contains("seen", pair), spans(F.col("text"), rule))
        return F.struct(F.lit(rule.kind).alias("kind"), F.lit(rule.version).alias("version"), found.alias("spans"))

    (
        todo.select("blob", F.explode(F.array(*map(scanned, rules))).alias("pair"))
        .select("blob", "pair.*")
        .where("spans IS NOT NULL")
        .dropDuplicates(["blob", "kind", "version"])
        .write.mode("append")
        .parquet(path)
    )
    return paths


def find_secrets(
    versions: DataFrame, ledger_path: str | None = None, rules: tuple[Rule, ...] = RULES
) -> DataFrame:
    """``doc_id, blob, found`` of each row of ``versions(doc_id, text)``.

    ``found`` is an array of ``(lo, rank, kind, hi)``, sorted; ``rank`` is the
    place of the kind in ``rules``. Without a ledger all contents are new.
    """
    spark = versions.sparkSession
    path = ledger_path or scratch_dir(spark, "ledger")
    paths = update_ledger(versions, path, rules)
    order = F.create_map(*[x for i, r in enumerate(rules) for x in (F.lit(f"{r.kind} {r.version}"), F.lit(i))])
    rank = order[F.concat_ws(" ", "kind", "version")]
    spans_of = (
        read_ledger(spark, path)
        .withColumn("rank", rank)
        .where("rank IS NOT NULL AND size(spans) > 0")
        .groupBy("blob")
        .agg(
            F.array_sort(
                F.flatten(
                    F.collect_list(
                        F.expr("transform(spans, s -> struct(s.lo AS lo, rank AS rank, kind AS kind, s.hi AS hi))")
                    )
                )
            ).alias("found")
        )
    )
    home = scratch_dir(spark, "findings")
    # Written: a join with a table may split the paths of one content, one with an aggregate may not.
    spans_of.write.parquet(home)
    found = "array<struct<lo: int, rank: int, kind: string, hi: int>>"
    spans_of = spark.read.schema(f"blob string, found {found}").parquet(home)
    none = F.expr(f"CAST(array() AS {found})")
    return paths.join(spans_of, "blob", "left").select("doc_id", "blob", F.coalesce("found", none).alias("found"))


def listed(found: Column) -> Column:
    """The spans as ``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s.kind, s.lo, s.hi)), ",")


def digest(secrets: DataFrame) -> DataFrame:
    """Counts of the base kinds, the digest of their spans, and all spans."""
    base = [r.kind for r in BASE]

    def count(kind: str) -> Column:
        return F.size(F.filter("found", lambda s: s.kind == kind)).cast("long").alias(f"n_{kind}")

    only_base = F.filter("found", lambda s: s.kind.isin(base))
    return secrets.select(
        "doc_id", *map(count, base), F.sha2(listed(only_base), 256).alias("base_sha256"), listed(F.col("found")).alias("spans")
    )


def redact(text: Column, found: Column) -> Column:
    """The text with each stretch that spans cover replaced by the first span's kind in brackets."""
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    walked = F.aggregate(
        found,
        start,
        lambda s, x: F.when(
            x["lo"] >= s["at"],
            F.struct(
                x["hi"].alias("at"),
                F.concat(s["out"], F.substring(text, s["at"] + 1, x["lo"] - s["at"]), F.lit("["), x["kind"], F.lit("]")).alias("out"),
            ),
        ).otherwise(F.struct(F.greatest(s["at"], x["hi"]).alias("at"), s["out"].alias("out"))),
        lambda s: F.concat(s["out"], F.substring(text, s["at"] + 1, F.length(text))),
    )
    return F.when(F.size(found) > 0, walked).otherwise(text)
