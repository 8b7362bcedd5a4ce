"""One registered query for each operator, over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tramline.llm import (
    chat_format,
    conversation_repair,
    decontamination,
    grammar,
    html_text,
    packing,
    prefix_trie,
    quality,
    secret_scan,
    simhash,
    substring,
    token_counts,
    warc,
)
from tramline.llm.digests import run_digests
from tramline.llm.stored import written
from tramline.session import scratch_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def query(sql: str | None = None):
    def register(build):
        QUERIES[build.__name__] = build
        if sql is not None:
            ORACLES[build.__name__] = sql
        return build

    return register


@query(
    r"""
    WITH split AS (
      SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words
      FROM documents),
    windows AS (
      SELECT doc_id, unnest(range(1, len(words) - 48)) AS lo, words FROM split WHERE len(words) >= 50),
    keyed AS (SELECT doc_id, lo, sha256(array_to_string(words[lo:lo + 49], ' ')) AS k FROM windows),
    owned AS (SELECT doc_id, lo, min(doc_id) OVER (PARTITION BY k) AS owner FROM keyed),
    gone AS (SELECT DISTINCT doc_id, unnest(range(lo, lo + 50)) AS i FROM owned WHERE owner < doc_id),
    word AS (SELECT doc_id, unnest(range(1, len(words) + 1)) AS i, unnest(words) AS w FROM split),
    kept AS (
      SELECT doc_id, count(*) AS n, string_agg(w, ' ' ORDER BY i) AS t
      FROM word ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
    SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(words) - coalesce(n, 0) AS BIGINT) AS n_removed,
           sha256(coalesce(t, '')) AS kept_sha256
    FROM split LEFT JOIN kept USING (doc_id)
    """
)
def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    return substring.remove_repeats(docs).drop("kept_text")


@query()
def op2_simhash_pivots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents", "doc_id", "text"))


@query()
def op9_quality_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    return quality.judge(docs).drop("lang", "version")


@query()
def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    return token_counts.token_counts(docs, public_tokenizers.path("byte_bpe_50k.json"))


@query(
    r"""
    WITH doc AS (
      SELECT doc_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
      FROM documents),
    item AS (
      SELECT item_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
      FROM benchmark),
    ds AS (
      SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM doc WHERE len(w) > 0)),
    its AS (
      SELECT DISTINCT item_id, array_to_string(w[i:i + 4], ' ') AS s
      FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM item WHERE len(w) > 0)),
    n AS (SELECT item_id, count(*) AS n_shingles FROM its GROUP BY item_id)
    SELECT doc_id, item_id, n_shingles, count(*) AS n_shared, count(*) / n_shingles AS containment
    FROM ds JOIN its USING (s) JOIN n USING (item_id)
    GROUP BY doc_id, item_id, n_shingles HAVING count(*) >= ceil(0.8 * n_shingles)
    """
)
def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    return decontamination.contained_items(docs, _table(spark, sf_dir, "benchmark", "item_id", "text"))


@query()
def op4_nnls_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


@query()
def op5_grammar_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, folder = _table(spark, sf_dir, "documents", "doc_id", "text"), scratch_dir(spark, "grammar")
    grammar.write_shards(docs, public_tokenizers.path("word_bpe_49k.json"), folder)
    return grammar.read_shards(spark, folder)


@query()
def op6_layout_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_text(_table(spark, sf_dir, "pages", "page_id", "html"))


def _spans_sql() -> str:
    """Spans of all rules: running lengths of the matches and of the text between them."""
    parts = []
    for rank, rule in enumerate(secret_scan.RULES):
        pattern = rule.pattern.replace("'", "''")
        parts.append(
            f"""
            SELECT doc_id, {rank} AS rank, '{rule.kind}' AS kind, least, lo, lo + length(whole[i]) AS hi
            FROM (
              SELECT doc_id, i, whole, length(part[i]) AS least,
                     list_sum(list_transform(gaps[1:i], lambda x: length(x)))
                     + coalesce(list_sum(list_transform(whole[1:i - 1], lambda x: length(x))), 0) AS lo
              FROM (
                SELECT doc_id, unnest(range(1, len(whole) + 1)) AS i, whole, part, gaps
                FROM (
                  SELECT doc_id, regexp_extract_all(t, '{pattern}', 0) AS whole,
                         regexp_extract_all(t, '{pattern}', {rule.group}) AS part,
                         string_split_regex(t, '{pattern}') AS gaps
                  FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents))))
            WHERE least >= {rule.least}
            """
        )
    return " UNION ALL ".join(parts)


@query(
    f"""
    WITH spans AS ({_spans_sql()}),
    named AS (
      SELECT doc_id, rank, kind, lo, kind || ':' || CAST(lo AS BIGINT) || ':' || CAST(hi AS BIGINT) AS s FROM spans),
    per AS (
      SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
             count(*) FILTER (kind = 'hex') AS n_hex,
             string_agg(s, ',' ORDER BY lo, rank) FILTER (kind IN ('assign', 'access', 'hex')) AS base,
             string_agg(s, ',' ORDER BY lo, rank) AS spans
      FROM named GROUP BY doc_id)
    SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
           sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
    FROM documents LEFT JOIN per USING (doc_id)
    """
)
def op7_secret_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest(secret_scan.find_secrets(_table(spark, sf_dir, "documents", "doc_id", "text")))


@query(
    """
    WITH p AS (
      SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha256(coalesce(html, '')) AS d FROM pages),
    h AS (SELECT *, min(page_id) OVER (PARTITION BY d) AS head FROM p)
    SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, d AS payload_digest,
           CASE WHEN n >= 100 AND page_id <> head THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN n >= 100 AND page_id <> head THEN head END AS refers_to
    FROM h
    """
)
def op8_seekable_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_dir(spark, "warc")
    warc.write_archives(_table(spark, sf_dir, "pages", "page_id", "url", "html"), folder)
    return warc.read_archives(spark, folder)


def _crc32_sql(value: str) -> str:
    """The unsigned CRC-32 of an ASCII text, bit by bit."""
    return f"""xor(4294967295, list_reduce(
        list_prepend(4294967295::BIGINT, flatten(list_transform(
          range(1, length({value}) + 1), lambda i: [ascii(({value})[i])::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
        lambda c, x: xor(xor(c, x) >> 1, (xor(c, x) & 1) * 3988292384)))"""


def damaged(rows: DataFrame) -> DataFrame:
    """Conversations with turns dropped, emptied, cut short, repeated or given to the user, by a hash of their place."""
    space = F.lit(" ")
    place = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn")))
    role, text = (F.coalesce(F.col(c).cast("string"), space) for c in ("role", "text"))
    fault = F.crc32(place) % 20
    rows = rows.where(fault != 0).select(
        "conv_id", "turn",
        F.when(fault == 4, "user").otherwise(role).alias("role"),
        F.when(fault == 1, "").when(fault == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.explode(F.when(fault == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    )
    return rows.drop("copy")


def _edit(state: str, cost: str, letter: str) -> str:
    """A state with one more edit: nine digits of cost, then the letters."""
    return f"lpad(CAST(CAST({state}[1:9] AS INT) + {cost} AS VARCHAR), 9, '0') || {state}[10:] || '{letter}'"


def _kept_sql(before: str, initial: str, condition: str = "true") -> str:
    kept = f"WHEN initial = '{initial}' THEN {_edit(before, 'extra', 'K')} "
    return f"CASE WHEN goes OR NOT {condition} THEN NULL {kept} ELSE {_edit(before, '(extra + 1)', 'R')} END"


_REPAIR_SQL = f"""
    WITH RECURSIVE damage AS (
      SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
             {_crc32_sql("(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '))")} % 20 AS f
      FROM conversations),
    damaged AS (
      SELECT conv_id, turn, CASE WHEN f = 4 THEN 'user' ELSE role END AS role,
             CASE WHEN f = 1 THEN '' WHEN f = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
             unnest(CASE WHEN f = 3 THEN [0, 1] ELSE [0] END) AS copy
      FROM damage WHERE f <> 0),
    placed AS (
      SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
             row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS seen,
             regexp_replace(text, '[\\x20\\x09-\\x0D]+$', '') AS body
      FROM damaged),
    flagged AS (
      SELECT *, left(role, 1) AS initial, body = '' AS blank, body <> '' AND seen > 1 AS again,
             body <> '' AND seen = 1 AND right(body, 1) NOT IN ('.', '!', '?') AS cut,
             lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) || left(role, 1) AS pair
      FROM placed),
    counted AS (
      SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
             count(*) FILTER (blank) AS blank, count(*) FILTER (again) AS duplicate, count(*) FILTER (cut) AS truncated,
             count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
      FROM flagged GROUP BY conv_id),
    opened AS (
      SELECT conv_id, 0::BIGINT AS i, '000000000' AS a0, NULL::VARCHAR AS a1, '000000005I' AS a2, '000000010II' AS a3
      FROM counted),
    steps AS (
      SELECT * FROM opened
      UNION ALL
      SELECT conv_id, i, b0, b1, c2, least(b3, {_edit('c2', '5', 'I')}) FROM (
        SELECT *, least(b2, {_edit('b0', '5', 'I')}, {_edit('b1', '5', 'I')}, {_edit('b3', '5', 'I')}) AS c2 FROM (
          SELECT conv_id, i, {_edit('a0', '2', 'D')} AS b0,
                 least({_edit('a1', '2', 'D')},
                       CASE WHEN NOT goes AND initial = 's' THEN {_edit('a0', 'extra', 'K')} END) AS b1,
                 least({_edit('a2', '2', 'D')}, {_kept_sql('a0', 'u')}, {_kept_sql('a1', 'u')}, {_kept_sql('a3', 'u')}) AS b2,
                 least({_edit('a3', '2', 'D')}, {_kept_sql('a2', 'a')}) AS b3
          FROM (
            SELECT s.conv_id, s.i + 1 AS i, a0, a1, a2, a3, initial, blank OR again AS goes,
                   CASE WHEN cut THEN 5 ELSE 0 END AS extra
            FROM steps s JOIN flagged f ON f.conv_id IS NOT DISTINCT FROM s.conv_id AND f.i = s.i + 1)))),
    best AS (
      SELECT c.*, CAST(least(a0, a3)[1:9] AS BIGINT) AS cost, least(a0, a3)[10:] AS audit
      FROM counted c JOIN steps s ON s.conv_id IS NOT DISTINCT FROM c.conv_id AND s.i = c.n),
    letters AS (
      SELECT conv_id, audit[p] AS e, p, length(replace(audit[1:p], 'I', '')) AS i,
             length(replace(audit[1:p], 'D', '')) - 1 AS k
      FROM (SELECT conv_id, audit, unnest(range(1, length(audit) + 1)) AS p FROM best)),
    outs AS (
      SELECT l.conv_id, p, k, e, role, initial, CASE WHEN e = 'I' THEN '' ELSE text END AS text,
             max(CASE WHEN k = 0 AND e = 'K' AND initial = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY l.conv_id) AS shift
      FROM letters l LEFT JOIN flagged f ON f.conv_id IS NOT DISTINCT FROM l.conv_id AND f.i = l.i
      WHERE e <> 'D'),
    joined AS (
      SELECT conv_id, string_agg(
               CASE WHEN e = 'K' THEN role WHEN (k - shift) % 2 = 0 THEN 'user' ELSE 'assistant' END || ':' || text,
               chr(10) ORDER BY p) AS t
      FROM outs GROUP BY conv_id)
    SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
           coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost,
           coalesce(audit, '') AS audit, sha256(coalesce(t, '')) AS repaired_sha256
    FROM (SELECT DISTINCT conv_id FROM conversations) o
    LEFT JOIN best b ON b.conv_id IS NOT DISTINCT FROM o.conv_id
    LEFT JOIN joined j ON j.conv_id IS NOT DISTINCT FROM o.conv_id
    """


@query(_REPAIR_SQL)
def op11_audit_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    report, repaired = conversation_repair.repair(damaged(rows))
    lines = repaired.select("conv_id", F.concat_ws(":", "role", "text").alias("repaired_sha256"))
    digests = run_digests(lines, "conv_id", {"repaired_sha256": "\n"}).drop("n_rows")
    known = rows.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    out = known
    for k, part in enumerate((report.drop("n_rows"), written(digests, "repaired"))):
        part = part.withColumnRenamed("conv_id", f"own_{k}")
        out = out.join(part, known["conv_id"].eqNullSafe(part[f"own_{k}"]), "left").drop(f"own_{k}")
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return out.select(
        "conv_id", *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(prefix_trie.EMPTY_SHA256)).alias("repaired_sha256"),
    )


_HEAD_SQL = _crc32_sql("CAST(conv_id AS VARCHAR)") + " % 4"


@query(
    f"""
    WITH own AS (
      SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS place,
             coalesce(role, '') AS role, coalesce(text, '') AS text
      FROM conversations WHERE conv_id IS NOT NULL),
    convs AS (SELECT conv_id, conv_id - conv_id % 20 AS base, {_HEAD_SQL} AS h FROM (SELECT DISTINCT conv_id FROM own)),
    rebuilt AS (
      SELECT c.conv_id, place, role, text FROM convs c JOIN own o ON o.conv_id = c.base AND place < h
      UNION ALL
      SELECT c.conv_id, place, role, text FROM convs c JOIN own o ON o.conv_id = c.conv_id AND place >= h),
    members AS (
      SELECT conv_id, row_number() OVER w AS depth,
             sha256(string_agg(sha256(role) || sha256(text), '') OVER w) AS k,
             len(list_filter(string_split_regex(text, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')) AS words,
             lead(place) OVER (PARTITION BY conv_id ORDER BY place) IS NULL AS ends
      FROM rebuilt WINDOW w AS (PARTITION BY conv_id ORDER BY place ROWS UNBOUNDED PRECEDING)
      UNION ALL
      SELECT conv_id, 0, 'root', 0, conv_id NOT IN (SELECT conv_id FROM rebuilt) FROM convs),
    nodes AS (
      SELECT k, depth, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(words) AS saved,
             coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '') AS ended,
             count(*) FILTER (ends) = count(*) AS leaf
      FROM members GROUP BY k, depth),
    totals AS (
      SELECT m.k, count(*) FILTER (leaf) AS n_leaves, sum(saved) AS saved_tokens
      FROM nodes n JOIN members m ON m.conv_id = n.conv_id AND m.depth <= n.depth GROUP BY m.k),
    links AS (
      SELECT n.k, m.k AS parent FROM nodes n JOIN members m ON m.conv_id = n.conv_id AND m.depth = n.depth - 1),
    children AS (SELECT parent AS k, count(*) AS n_children FROM links GROUP BY parent)
    SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(n_children, 0) AS n_children, n_leaves,
           CAST(saved_tokens AS BIGINT) AS saved_tokens, sha256(n.ended) AS ends_sha256
    FROM nodes n JOIN totals t USING (k) LEFT JOIN children c USING (k) LEFT JOIN links l USING (k)
    LEFT JOIN nodes p ON p.k = l.parent
    """
)
def op12_prefix_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    known = written(prefix_trie.turns(rows), "turns")
    conv = F.col("conv_id")
    return prefix_trie.trie(*prefix_trie.regrown(known, conv - conv % 20, F.crc32(conv.cast("string")) % 4))


CONTROL_TURN = "</s>[INST] ok [/INST]"


def _shown_chars_sql(value: str) -> str:
    """Code points of a text in a formatted conversation: one more for each control string in it."""
    return (
        f"length({value})"
        rf" + len(regexp_extract_all({value}, '<\\*/?s>|\[\\*/?INST\]|<\\*\|endoftext\|>'))"
    )


@query(
    rf"""
    WITH own AS (
      SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
      UNION ALL SELECT -1, 0, 'user', '{CONTROL_TURN}'
      UNION ALL SELECT -1, 1, 'assistant', '{CONTROL_TURN}')
    SELECT conv_id, count(*) AS n_turns,
           sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
           CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
           sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), ''))
             AS loss_sha256,
           CAST(3 + sum(17 + {_shown_chars_sql('role')} + {_shown_chars_sql('text')}) AS BIGINT) AS formatted_chars
    FROM own GROUP BY conv_id
    """
)
def op13_token_assembly(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    control = [(-1, k, role, CONTROL_TURN) for k, role in enumerate(("user", "assistant"))]
    rows = rows.unionByName(spark.createDataFrame(control, "conv_id LONG, turn LONG, role STRING, text STRING"))
    path = public_tokenizers.path("byte_bpe_50k.json")
    turns = chat_format.read_chats(chat_format.format_chats(rows, path), path)
    shown = turns.select(
        "conv_id", F.concat("role", F.lit("\n"), "text", F.lit("\n")).alias("turns_sha256"),
        F.col("loss_text").alias("loss_sha256"), F.length("loss_text").cast("long").alias("loss_chars"), "formatted_chars",
    )
    digests = run_digests(shown, "conv_id", {"turns_sha256": "", "loss_sha256": ""}, ("loss_chars", "formatted_chars"))
    return digests.withColumnRenamed("n_rows", "n_turns")
