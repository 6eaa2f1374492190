"""Line dedup by a deletion-neighbourhood join, with DataFrame functions only.

A line is dropped if an earlier line, by (doc_id, line number), is equal to it
or, both having at least ``min_chars`` characters, one edit away (a character
inserted, deleted or replaced). The earliest of each kind stays. Blank lines
are layout: always kept, never compared.

1. *Equal lines* meet by two hashes and their length; the earliest is kept.
2. *Lines that may have a neighbour.* Of two lines one edit apart, the half
   without the edit is the same: the first or last floor(m / 2) characters, m
   being the shorter length. Only distinct lines that share such a half with
   another go on; the filter loses nothing.
3. *Variants.* Each of these emits, for every character of the half that may
   hold the edit, the hash of the line without it. A line's hash is the xor of
   hashes of (character, position), so all its variants come from running xors, in
   time linear in its length. Replacements meet in equal variants with the same
   deleted position, insertions in a variant equal to a whole shorter line.
4. *Verification*: ``levenshtein`` of each line and the earliest line of its group.
   All lines of a replacement group are one edit apart, those of an insertion
   group from its whole line, so the earliest of a group decides and no pairs within it are made.

A candidate's text is picked out of the documents behind a filter of at most
2^20 hash buckets, whose broadcast is thus bounded.

NULL texts stay NULL, with no line. Empty texts have one blank line. An empty
table gives no rows. Rows repeated with id and text share one verdict, so that
both keep the same lines. Other columns pass through; ``text``, ``n_lines`` and
``n_kept`` are set anew.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hiremill.llm.common import table
from hiremill.session import materialize

MIN_CHARS = 20
BUCKETS = 1 << 20
BLANK = r"^[ \t\r]*$"


def _half(kind: str, m: Column) -> Column:
    """Hash of the first or last floor(m / 2) characters, with m."""
    size = F.floor(m / 2).cast("int")
    part = F.substring("line", F.lit(1), size) if kind == "p" else F.substring("line", F.col("n") - size + 1, size)
    return F.xxhash64(F.lit(kind), m, part)


def document_lines(docs: DataFrame, id_col: str) -> DataFrame:
    """(doc_id, text_key, line_no, line, n, h1, h2) of every line that is not blank."""
    return (
        docs.filter(F.col("text").isNotNull())
        .select(F.col(id_col).alias("doc_id"), F.xxhash64("text").alias("text_key"), F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line"))
        .filter(~F.col("line").rlike(BLANK))
        .select(
            "doc_id", "text_key", "line_no", "line", F.length("line").alias("n"),
            F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(7), "line").alias("h2"),
        )
    )


def _bucket(column: str) -> Column:
    return F.pmod(F.col(column), F.lit(BUCKETS))


def _flagged(rows: DataFrame, column: str, wanted: DataFrame) -> DataFrame:
    """The rows whose hash falls into a bucket of a wanted one: a filter before a shuffle. At most 2^20 numbers are broadcast."""
    buckets = wanted.select(_bucket(column).alias("wanted_bucket")).distinct()
    return rows.join(F.broadcast(buckets), _bucket(column) == F.col("wanted_bucket"), "left_semi")


def distinct_lines(lines: DataFrame) -> DataFrame:
    """A row for each different line: its hashes, its earliest place and the hashes of its halves."""
    n = F.col("n")
    return (
        lines.withColumns({"p0": _half("p", n), "p1": _half("p", n - 1), "s0": _half("s", n), "s1": _half("s", n - 1)})
        .groupBy("h1", "h2", "n")
        .agg(F.min(F.struct("doc_id", "line_no", "text_key")).alias("first"), *[F.min(c).alias(c) for c in ("p0", "p1", "s0", "s1")])
    )


def near_lines(lines: DataFrame, distinct: DataFrame, min_chars: int) -> DataFrame:
    """(h1, h2, n) of the lines that an earlier line is one edit away from."""
    long = distinct.filter(F.col("n") >= min_chars)
    # A line's half under its own length, and as the longer one under the length before.
    halves = long.select("h1", "h2", "n", F.explode(F.array(*[
        F.struct(F.col(c).alias("half"), F.lit(c[0] == "p").alias("is_head")) for c in ("p0", "p1", "s0", "s1")
    ])).alias("x")).select("h1", "h2", "n", "x.half", "x.is_head")
    shared = halves.groupBy("half").agg(F.count("*").alias("times")).filter("times > 1").select("half")
    # An equal head leaves the tail to be edited, and the other way round.
    candidates = materialize(
        halves.join(shared, "half", "left_semi").groupBy("h1", "h2", "n")
        .agg(F.max("is_head").alias("edit_tail"), F.max(~F.col("is_head")).alias("edit_head")),
        "line-candidates",
    )
    places = candidates.join(distinct.select("h1", "h2", "n", "first"), ["h1", "h2", "n"])
    texts = materialize(
        _flagged(lines, "h1", candidates)
        .select("h1", "h2", "n", F.struct("doc_id", "line_no", "text_key").alias("first"), "line")
        .join(places.withColumnRenamed("first", "earliest"), ["h1", "h2", "n"])
        .filter(F.col("first") == F.col("earliest"))
        .dropDuplicates(["h1", "h2", "n"])
        .select("h1", "h2", "n", "first", "line", "edit_head", "edit_tail"),
        "line-candidate-texts",
    )
    # Running xors over the characters give the hash of the line without each of them.
    chars = texts.select(
        "h1", "h2", "n", "edit_head", "edit_tail",
        F.posexplode(F.split("line", "")).alias("at", "c"),
    ).select(
        "h1", "h2", "n", "edit_head", "edit_tail", "at",
        F.xxhash64("c", "at").alias("here"), F.xxhash64("c", F.col("at") - 1).alias("moved"),
    )
    chars.createOrReplaceTempView("line_characters")
    running = chars.sparkSession.sql(
        """
        SELECT h1, h2, n, at, edit_head, edit_tail,
               coalesce(bit_xor(here) OVER (PARTITION BY h1, h2, n ORDER BY at ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0L)
               ^ bit_xor(moved) OVER (PARTITION BY h1, h2, n ORDER BY at ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
               ^ bit_xor(moved) OVER (PARTITION BY h1, h2, n) AS without
        FROM line_characters
        """
    )
    # The halves overlap by the characters that a length one more or less can move.
    tail, head = F.col("at") >= F.floor((F.col("n") - 1) / 2) - 1, F.col("at") <= F.floor((F.col("n") + 1) / 2) + 1
    variants = running.filter((F.col("edit_tail") & tail) | (F.col("edit_head") & head))
    replaced = variants.select(F.xxhash64(F.lit("r"), "n", "at", "without").alias("variant"), "h1")
    whole = materialize(
        chars.groupBy("h1", "h2", "n").agg(F.bit_xor("here").alias("whole")).select(F.xxhash64(F.lit("i"), "n", "whole").alias("variant"), "h1"),
        "line-wholes",
    )
    shorter = variants.select(F.xxhash64(F.lit("i"), F.col("n") - 1, "without").alias("variant"), "h1")
    emitted = replaced.unionByName(whole).unionByName(_flagged(shorter, "variant", whole))
    # A group's lines differ from one in a single character: no more of them than the alphabet allows.
    groups = emitted.groupBy("variant").agg(F.collect_set("h1").alias("lines")).filter(F.size("lines") > 1)
    members = materialize(groups.select("variant", F.explode("lines").alias("h1")), "line-variants")
    placed = members.join(texts.select("h1", "h2", "n", "first"), "h1")
    earliest = placed.groupBy("variant").agg(F.min("first").alias("earliest"))
    pairs = placed.join(earliest, "variant").filter(F.col("first") != F.col("earliest")).select("h1", "h2", "n", "earliest").distinct()
    # Two lines of an insertion group may be apart by two edits, but each is one from the whole line.
    x, y = texts.select("h1", "h2", "n", "line"), texts.select(F.col("first").alias("earliest"), F.col("line").alias("other"))
    one_edit = pairs.join(x, ["h1", "h2", "n"]).join(y, "earliest").filter(F.levenshtein("line", "other", 1) >= 0)
    whole_first = _whole_first(placed, whole, texts)
    return one_edit.select("h1", "h2", "n").unionByName(whole_first).distinct()


def _whole_first(placed: DataFrame, whole: DataFrame, texts: DataFrame) -> DataFrame:
    """Lines whose insertion group holds an earlier whole line, that is not the group's earliest."""
    owners = whole.select("variant", F.col("h1").alias("owner")).join(
        texts.select(F.col("h1").alias("owner"), F.col("first").alias("owner_first"), F.col("line").alias("other")), "owner"
    )
    return (
        placed.join(owners, "variant").filter(F.col("owner_first") < F.col("first"))
        .select("h1", "h2", "n", "other").distinct()
        .join(texts.select("h1", "h2", "n", "line"), ["h1", "h2", "n"])
        .filter(F.levenshtein("line", "other", 1) >= 0)
        .select("h1", "h2", "n")
    )


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, id_col: str = "doc_id") -> DataFrame:
    """``docs`` with the kept lines of each text, ``n_lines`` and ``n_kept`` (blank lines count in both)."""
    lines = document_lines(docs, id_col)
    distinct = materialize(distinct_lines(lines), "line-distinct")
    near = near_lines(lines, distinct, min_chars)
    kept = (
        distinct.join(near, ["h1", "h2", "n"], "left_anti")
        .groupBy(F.col("first.doc_id").alias("kept_id"), F.col("first.text_key").alias("kept_key"))
        .agg(F.array_sort(F.collect_list("first.line_no")).alias("kept_lines"))
    )
    # Kept numbers to a flag for each line, in one pass: a run of dropped lines before each kept one.
    flags = F.expr(
        "flatten(transform(kept_lines, (x, i) -> concat(array_repeat(false, x - if(i = 0, -1, kept_lines[i - 1]) - 1), array(true))))"
    )
    kept = kept.select("kept_id", "kept_key", flags.alias("kept_flags"))
    split = F.split("text", "\n", -1)
    chosen = F.filter(split, lambda x, i: x.rlike(BLANK) | F.coalesce(F.get("kept_flags", i), F.lit(False)))
    rest = [c for c in docs.columns if c not in ("n_lines", "n_kept")]
    # Columns that only pass through travel in one, whatever their names.
    others = [F.col(f"`{c}`") for c in rest if c not in (id_col, "text")]
    rows = docs.select(F.col(id_col).alias("row_id"), "text", (F.struct(*others) if others else F.lit(None)).alias("others"))
    new = {id_col: F.col("row_id"), "text": F.array_join("chosen_lines", "\n")}
    return (
        rows.join(kept, F.col("row_id").eqNullSafe(F.col("kept_id")) & (F.xxhash64("text") == F.col("kept_key")), "left")
        .withColumns({"n_lines": F.coalesce(F.size(split), F.lit(0)), "chosen_lines": chosen})
        .select(
            *[new.get(c, F.col("others").getField(c)).alias(c) for c in rest],
            F.when(F.col("text").isNull(), 0).otherwise(F.col("n_lines")).alias("n_lines"),
            F.when(F.col("text").isNull(), 0).otherwise(F.size("chosen_lines")).alias("n_kept"),
        )
    )


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines, kept lines and the md5 of the kept text of every document."""
    return dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", F.col("n_lines").cast("long").alias("n_lines"), F.col("n_kept").cast("long").alias("n_kept"), F.md5("text").alias("kept_md5")
    )


OP4_SQL = f"""
WITH lines AS (
  SELECT doc_id, line_no, line FROM (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS line_no
    FROM documents WHERE text IS NOT NULL)
), solid AS (
  SELECT * FROM lines WHERE NOT regexp_full_match(line, '[ \\t\\r]*')
), firsts AS (
  SELECT line, min(row(doc_id, line_no)) AS first, length(line) AS n FROM solid GROUP BY line
), halves AS (
  SELECT line, first, n, m, side, CASE side WHEN 'p' THEN left(line, (m // 2)::BIGINT) ELSE right(line, (m // 2)::BIGINT) END AS half
  FROM firsts, (VALUES (0), (1)) AS d(less), (VALUES ('p'), ('s')) AS s(side), LATERAL (SELECT n - less AS m)
  WHERE n >= {MIN_CHARS}
), pairs AS (
  SELECT DISTINCT a.line AS x, b.line AS y
  FROM halves a JOIN halves b ON a.m = b.m AND a.side = b.side AND a.half = b.half
  WHERE b.first < a.first AND abs(a.n - b.n) <= 1
), compared AS (
  SELECT x, y, coalesce(list_position(list_transform(list_zip(string_split(x, ''), string_split(y, '')), lambda p: p[1] IS NOT DISTINCT FROM p[2]), false), 0)::BIGINT AS d
  FROM pairs
), near AS (
  SELECT DISTINCT x FROM compared
  WHERE (length(x) = length(y) AND substr(x, d + 1) = substr(y, d + 1))
     OR (length(x) = length(y) + 1 AND substr(x, d + 1) = substr(y, d))
     OR (length(x) + 1 = length(y) AND substr(x, d) = substr(y, d + 1))
), kept AS (
  SELECT l.doc_id, l.line_no, l.line FROM lines l LEFT JOIN firsts f ON l.line = f.line
  WHERE f.line IS NULL OR (f.first = row(l.doc_id, l.line_no) AND l.line NOT IN (SELECT x FROM near))
), texts AS (
  SELECT doc_id, count(*) AS n_kept, string_agg(line, chr(10) ORDER BY line_no) AS text FROM kept GROUP BY doc_id
)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN 0 ELSE len(string_split(d.text, chr(10))) END::BIGINT AS n_lines,
       coalesce(t.n_kept, 0)::BIGINT AS n_kept, CASE WHEN d.text IS NULL THEN NULL ELSE md5(coalesce(t.text, '')) END AS kept_md5
FROM documents d LEFT JOIN texts t USING (doc_id)
"""
