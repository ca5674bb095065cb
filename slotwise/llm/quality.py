"""Quality rules with cross-document line frequency (native expressions only).

Base rules look at one document: word and symbol counts, repeated lines, words
in repeated five-word windows. The method then hashes every normalised line,
counts in how many distinct documents of a host it occurs, removes lines above
the limit (one number, for hosts of any size) and rejects documents of which too
little is left.

Defined cases: a null text counts as empty (no words: base rules fail); a null
host is a host of its own; null ids and repeated rows each keep their own
result row; exact copies of a text count as one document of their host, so a
text is not rejected for having copies (that is the deduplicator's task); the
first document (smallest id) holding a frequent line keeps it, so no passage
disappears from the corpus. Other columns of the input are ignored.

``cleaned_documents`` gives the kept documents without those lines; the query's
columns are fixed by its contract and hold the verdict and the counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotwise.llm.common import BLANKS, checkpointed, join_null_safe, table, text_key, words

WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PCT = 20
SYMBOLS = "#*$%&|<>"  # fixed by the query contract
LINE_DOCS = 50  # a line may occur in this many distinct documents of a host, however large the host
BROADCAST = 1_000_000  # frequent lines (some 40 bytes each) that may be broadcast
MIN_LEFT = 0.5  # share of a document's words that must survive line removal


def _windows(hashes: str) -> Column:
    w = F.col(hashes)
    return F.when(
        F.size(w) >= WINDOW,
        F.transform(F.sequence(F.lit(0), F.size(w) - WINDOW), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(WINDOW)])),
    ).otherwise(F.array().cast("array<bigint>"))


def _normalised(line: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(line), rf"[0-9{BLANKS}]+", " "))


def base_rules(docs: DataFrame, id_col: str = "doc_id", host_col: str = "source", text_col: str = "text") -> DataFrame:
    """Per-document counts and ``base_failed``; one row per input row, no shuffle."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(rf"[^{BLANKS}]"))
    d = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(host_col).alias("host"),
        text_key(text).alias("text_key"),
        F.transform(words(text), lambda x: F.xxhash64(x)).alias("_w"),
        lines.alias("_l"),
        (F.length(text) - F.length(F.regexp_replace(text, rf"[^{BLANKS}]+", ""))).cast("bigint").alias("word_chars"),
        F.length(F.regexp_replace(text, rf"[^{SYMBOLS}]+", "")).cast("bigint").alias("n_symbols"),
    )
    d = d.withColumns(
        {
            "n_words": F.size("_w").cast("bigint"),
            "n_dup_lines": (F.size("_l") - F.size(F.array_distinct("_l"))).cast("bigint"),
            "_h": _windows("_w"),
        }
    )
    # Only documents that repeat a window pay for sorting their windows.
    repeats = F.size("_h") > F.size(F.array_distinct("_h"))
    d = d.withColumn("_s", F.when(repeats, F.array_sort(F.transform("_h", lambda x, i: F.struct(x.alias("h"), i.alias("p"))))))
    s = F.col("_s")
    same = lambda x, i: (F.get(s, i + 1)["h"] == x["h"]) | ((i > 0) & (F.get(s, F.greatest(i - 1, F.lit(0)))["h"] == x["h"]))
    d = d.withColumn("_p", F.array_sort(F.transform(F.filter(s, lambda x, i: F.coalesce(same(x, i), F.lit(False))), lambda x: x["p"])))
    p = F.col("_p")
    covered = F.aggregate(
        F.transform(p, lambda x, i: F.least(F.lit(WINDOW), F.coalesce(F.get(p, i + 1) - x, F.lit(WINDOW)))), F.lit(0), lambda acc, x: acc + x
    )
    return d.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("bigint")).select(
        "doc_id",
        "host",
        "text_key",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        ((F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PCT * F.col("n_words"))).alias("base_failed"),
    )


def _line_hash(host: Column, line: Column) -> Column:
    return F.xxhash64(F.coalesce(F.concat(F.lit("="), host), F.lit("")), line)


def frequent_lines(docs: DataFrame, id_col: str = "doc_id", host_col: str = "source", text_col: str = "text", line_docs: int = LINE_DOCS) -> DataFrame:
    """``line, n_docs, first_id``: hashed normalised lines (with their host) in more than ``line_docs`` distinct texts.

    A document is shuffled once, as the hashes of its distinct lines, to drop the
    copies of its text; the remaining lines are counted map-side before the
    counts are shuffled. So neither a text with many copies nor a line that
    a third of all documents hold meets in one task.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.filter(F.transform(F.split(text, "\n", -1), _normalised), lambda x: x != "")
    host = F.col(host_col)
    d = docs.select(F.col(id_col).alias("doc_id"), host.alias("host"), text_key(text).alias("text_key"), F.array_distinct(F.transform(lines, lambda x: _line_hash(host, x))).alias("l"))
    texts = d.filter(F.size("l") > 0).groupBy("host", "text_key").agg(F.min("doc_id").alias("doc_id"), F.first("l").alias("l"))
    counts = texts.select("doc_id", F.explode("l").alias("line")).groupBy("line").agg(F.count(F.lit(1)).alias("n_docs"), F.min("doc_id").alias("first_id"))
    return counts.filter(F.col("n_docs") > line_docs)


def removed_words(
    docs: DataFrame,
    id_col: str = "doc_id",
    host_col: str = "source",
    text_col: str = "text",
    line_docs: int = LINE_DOCS,
    most: int = BROADCAST,
) -> DataFrame:
    """Words in lines above the limit and those lines' hashes, per ``(host, text_key)``.

    Texts without such a line have no row. The documents are read a second time
    and only their frequent lines go on: these are few and broadcast up to
    ``most``, beyond that joined by their hash. Copies of a text collapse before
    words are summed, by the lines' positions.
    """
    over = checkpointed(frequent_lines(docs, id_col, host_col, text_col, line_docs).select("line", "first_id"))
    text, host = F.coalesce(F.col(text_col), F.lit("")), F.col(host_col)
    entry = F.transform(
        F.transform(F.split(text, "\n", -1), _normalised), lambda x: F.struct(_line_hash(host, x).alias("line"), F.when(x != "", F.size(F.split(x, " "))).alias("w"))
    )
    all_ = docs.select(F.col(id_col).alias("doc_id"), host.alias("host"), text_key(text).alias("text_key"), F.posexplode(entry).alias("pos", "e"))
    all_ = all_.select("doc_id", "host", "text_key", "pos", "e.line", "e.w").filter("w is not null")
    found = all_.join(F.broadcast(over) if over.limit(most + 1).count() <= most else over, "line")
    one = (
        found.groupBy("host", "text_key", "pos")
        .agg(F.min("doc_id").alias("doc_id"), F.first("line").alias("line"), F.first("first_id").alias("first_id"), F.first("w").alias("w"))
        .groupBy("host", "text_key", "line")
        .agg(F.min("doc_id").alias("doc_id"), F.first("first_id").alias("first_id"), F.sum("w").alias("w"))
    )
    # coalesce: with null ids there is no first holder and the line goes everywhere
    hit = one.filter(~F.coalesce(F.col("doc_id") == F.col("first_id"), F.lit(False)))
    return hit.groupBy("host", "text_key").agg(F.sum("w").alias("removed_words"), F.collect_set("line").alias("removed_lines"))


def quality_rules(
    docs: DataFrame,
    id_col: str = "doc_id",
    host_col: str = "source",
    text_col: str = "text",
    line_docs: int = LINE_DOCS,
    min_left: float = MIN_LEFT,
) -> DataFrame:
    """Base counts, ``removed_words``, ``removed_lines`` (hashes, null if none) and the verdict ``kept`` per input row."""
    base = base_rules(docs, id_col, host_col, text_col)
    gone = removed_words(docs, id_col, host_col, text_col, line_docs)
    out = join_null_safe(base, gone, ["host", "text_key"], "left")
    removed = F.least(F.coalesce("removed_words", F.lit(0)), "n_words")
    return out.select(
        "doc_id",
        "host",
        "text_key",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        removed.cast("bigint").alias("removed_words"),
        "removed_lines",
        (~F.col("base_failed") & (F.col("n_words") - removed >= min_left * F.col("n_words"))).alias("kept"),
    )


def op1_line_quality(spark, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents")).drop("host", "text_key", "removed_lines")


def without_lines(text: Column, gone: Column, host: Column) -> Column:
    """The text without the lines whose normalised form has one of the hashes ``gone``."""
    return F.array_join(F.filter(F.split(text, "\n", -1), lambda x: ~F.array_contains(gone, _line_hash(host, _normalised(x)))), "\n")


def cleaned_documents(docs: DataFrame, line_docs: int = LINE_DOCS, min_left: float = MIN_LEFT) -> DataFrame:
    """The kept documents, all columns; ``text`` without its removed lines, ``n_chars`` follows.

    Only rejected documents and those with a removed line have a row on the
    right side of the join.
    """
    rules = quality_rules(docs, line_docs=line_docs, min_left=min_left).filter("not kept or removed_lines is not null")
    gone = F.when(F.col("kept"), F.col("removed_lines")).alias("_gone")
    changes = rules.select("doc_id", F.col("host").alias("source"), F.col("text_key").alias("_key"), F.col("kept").alias("_kept"), gone).distinct()
    keyed = docs.withColumn("_key", text_key(F.coalesce("text", F.lit(""))))
    out = join_null_safe(keyed, checkpointed(changes), ["doc_id", "source", "_key"], "left").filter(F.coalesce("_kept", F.lit(True)))
    out = out.withColumn("text", F.when(F.col("_gone").isNull(), F.col("text")).otherwise(without_lines(F.col("text"), F.col("_gone"), F.col("source"))))
    if "n_chars" in docs.columns:
        length = F.length("text").cast(docs.schema["n_chars"].dataType)
        out = out.withColumn("n_chars", F.when(F.col("_gone").isNull(), F.col("n_chars")).otherwise(length))
    return out.select(*docs.columns)


def quality_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: drop rejected documents, take frequent lines out of the rest."""
    return cleaned_documents(docs)


OP1_SQL = rf"""
WITH d AS (
  SELECT rowid_ AS rid, doc_id, source, coalesce(text, '') AS t FROM (SELECT row_number() OVER () AS rowid_, * FROM documents)
), w AS (
  SELECT rid, doc_id, source, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
  FROM d
), grams AS (
  SELECT rid, i, concat_ws(' ', ws[i], ws[i+1], ws[i+2], ws[i+3], ws[i+4]) AS g
  FROM (SELECT rid, ws, unnest(generate_series(1, len(ws) - 4)) AS i FROM w WHERE len(ws) >= 5)
), dup AS (
  SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM grams) WHERE c > 1
), rep AS (
  SELECT rid, sum(least(5, coalesce(nx - i, 5))) AS n FROM (SELECT rid, i, lead(i) OVER (PARTITION BY rid ORDER BY i) AS nx FROM dup) GROUP BY rid
), norm AS (
  SELECT source, t, doc_id, trim(regexp_replace(lower(l), '[0-9\x20\x09-\x0D]+', ' ', 'g')) AS line
  FROM (SELECT source, t, min(doc_id) AS doc_id, unnest(string_split(t, chr(10))) AS l FROM d GROUP BY source, t)
), per AS (
  SELECT source, t, line, min(doc_id) AS doc_id, sum(len(string_split(line, ' '))) AS w FROM norm WHERE line <> '' GROUP BY ALL
), over_ AS (
  SELECT f.source, f.line, f.first_id
  FROM (SELECT source, line, count(*) AS n, min(doc_id) AS first_id FROM per GROUP BY source, line) f
  WHERE f.n > {LINE_DOCS}
), gone AS (
  SELECT per.source, per.t, sum(w) AS n FROM per JOIN over_ o ON per.source IS NOT DISTINCT FROM o.source AND per.line = o.line
  WHERE per.doc_id <> o.first_id GROUP BY per.source, per.t
), x AS (
  SELECT w.doc_id, len(ws) AS n_words, coalesce(list_sum(list_transform(ws, lambda s: length(s))), 0) AS word_chars,
         length(regexp_replace(w.t, '[^{SYMBOLS}]+', '', 'g')) AS n_symbols,
         len(ls) - len(list_distinct(ls)) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words,
         least(coalesce(gone.n, 0), len(ws)) AS removed_words
  FROM w LEFT JOIN rep ON w.rid = rep.rid
  LEFT JOIN gone ON w.source IS NOT DISTINCT FROM gone.source AND w.t = gone.t
)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words,
       (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PCT} * n_words) AS base_failed,
       removed_words::BIGINT AS removed_words,
       NOT (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PCT} * n_words)
         AND n_words - removed_words >= {MIN_LEFT} * n_words AS kept
FROM x
"""
