"""Line dedup by a suffix array over line ids, built by prefix doubling.

Every text is a sequence of line ids (blank lines are left out).  A suffix's
name at length k stands for its first k lines; names of length 2k come from
pairs of names of length k at distance k, one grouping a round, and only
suffixes whose first k lines occur elsewhere go on.  Suffixes of one name are a
longest-common-prefix interval; the first in (document id, text digest, line)
order keeps its run, the others are later copies.  Runs of at least `min_lines`
lines, and single lines of at least `long_line` characters, that occur earlier
are deleted; neighbouring deletions are a maximal repeated run.

A name is the place of its first occurrence, so names are exact and need no
global sort.  DataFrame functions only.

`copied_runs` doubles on until no name repeats, and measures whole runs: a
later copy of `min_lines` lines, whose line before isn't part of the same copy,
goes on as long as it equals what follows their first occurrence.  That length
is put together from names of lengths 2^k, 2^(k-1), .. 1 at both places.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adlake.llm.tables import document_key, own_columns, written

MIN_LINES = 2
LONG_LINE = 200


def _trimmed(line: Column) -> Column:
    return F.btrim(line, F.lit(" \t\n\x0b\x0c\r"))


def line_rows(docs: DataFrame) -> DataFrame:
    """(doc, pos, line, id1, id2, chars) of each line that isn't blank: `line`
    counts all lines, `pos` those that aren't blank."""
    lines = F.transform(F.split("text", "\n"), lambda x, i: F.struct(i.alias("line"), _trimmed(x).alias("body")))
    rows = docs.select(document_key().alias("doc"), F.posexplode(F.filter(lines, lambda x: x["body"] != "")).alias("pos", "at"))
    return rows.select("doc", "pos", "at.line", F.xxhash64("at.body").alias("id1"), F.hash("at.body").alias("id2"),
                       F.length("at.body").alias("chars"))


def _named(rows: DataFrame, by: list[str], step: str, n: int) -> DataFrame:
    """`rows` whose `by` occurs more than once, with its name.  The grouping is
    partial; its result is written, so that the join can split a hot name."""
    names = written(rows.groupBy(*by).agg(F.min(F.struct("doc", "pos")).alias("name"), F.count("*").alias("n"))
                    .where("n > 1").drop("n"), f"line-names-{step}", n)
    return rows.join(names.hint("merge"), by).drop(*by)


def line_suffixes(docs: DataFrame) -> tuple[DataFrame, int]:
    """(doc, pos, line, chars, name) of the lines that occur more than once,
    and the number of all lines."""
    lines = written(line_rows(docs), "lines")
    n = lines.count()
    return written(_named(lines, ["id1", "id2"], "1", n).dropDuplicates(["doc", "pos"]), "line-suffixes-1", n), n


def longer(suffixes: DataFrame, length: int, step: int, n: int) -> DataFrame:
    """(doc, pos, name) of the suffixes whose first length + step lines occur
    more than once, from the names of `length` lines."""
    ahead = Window.partitionBy("doc").orderBy("pos").rangeBetween(step, step)  # a document's lines
    pairs = suffixes.withColumn("second", F.first("name").over(ahead)).where("second is not null")
    pairs = written(pairs.select("doc", "pos", F.struct("name", "second").alias("pair")), f"line-pairs-{length + step}", n)
    return _named(pairs, ["pair"], str(length + step), n)


def repeated_lines(docs: DataFrame, min_lines: int = MIN_LINES, long_line: int = LONG_LINE,
                   found: tuple[DataFrame, int] | None = None) -> DataFrame:
    """(doc, gone, n_runs): numbers of the lines to delete, ascending, and how
    many maximal runs they form.  `found` is `line_suffixes`, if known."""
    once, n = found or line_suffixes(docs)
    later = F.struct("doc", "pos") > F.col("name")
    suffixes, length = once.select("doc", "pos", "name"), 1
    while length < min_lines:
        step = min(length, min_lines - length)
        suffixes, length = longer(suffixes, length, step, n), length + step
    runs = suffixes.where(later).select("doc", "pos", F.lit(True).alias("starts"))
    own = Window.partitionBy("doc").orderBy("pos")
    marked = (once.withColumn("alone", later & (F.col("chars") >= long_line)).join(runs, ["doc", "pos"], "left")
              .withColumn("covered", F.max("starts").over(own.rangeBetween(1 - min_lines, 0))))
    gone = marked.where("alone or covered").withColumn("run", F.col("pos") - F.row_number().over(own))
    return gone.groupBy("doc").agg(F.sort_array(F.collect_list("line")).alias("gone"), F.count_distinct("run").alias("n_runs"))


def copied_runs(once: DataFrame, n: int, min_lines: int = MIN_LINES) -> DataFrame:
    """(doc, pos, source, length): maximal later copies of at least `min_lines`
    lines, and the place (doc, pos) that they are copies of, from
    `line_suffixes`.  Rounds double the length until no name repeats."""
    names = [once.select("doc", "pos", "name")]
    while True:  # names[k] has the names of 2^k lines
        more = written(longer(names[-1], 1 << (len(names) - 1), 1 << (len(names) - 1), n), f"line-suffixes-{1 << len(names)}", n)
        if more.isEmpty():
            break
        names.append(more)
    starts, length = names[min(min_lines.bit_length() - 1, len(names) - 1)], 1 << (min_lines.bit_length() - 1)
    if length > 1 << (len(names) - 1):
        starts = starts.limit(0)
    elif length < min_lines:
        starts = longer(starts, length, min_lines - length, n)
    own = Window.partitionBy("doc").orderBy("pos").rangeBetween(-1, -1)
    same = F.struct(F.col("name.doc").alias("doc"), (F.col("name.pos") - 1).alias("pos"))
    later = starts.where(F.struct("doc", "pos") > F.col("name")).withColumn("before", F.first("name").over(own))
    runs = later.where(~F.coalesce(F.col("before") == same, F.lit(False)))
    runs = written(runs.select("doc", "pos", F.col("name").alias("source"), F.lit(0).alias("length")), "line-runs", n)
    for k in range(len(names) - 1, -1, -1):
        # Files of a few repeated values are small and their rows many: no broadcast by file size.
        here = names[k].select("doc", F.col("pos").alias("at"), F.col("name").alias("here")).hint("merge")
        there = names[k].select(F.struct("doc", "pos").alias("to"), F.col("name").alias("there")).hint("merge")
        runs = runs.withColumn("at", F.col("pos") + F.col("length")).join(here, ["doc", "at"], "left")
        runs = runs.withColumn("to", F.struct(F.col("source.doc").alias("doc"), (F.col("source.pos") + F.col("length")).alias("pos"))).join(there, "to", "left")
        grown = F.when(F.col("here") == F.col("there"), F.col("length") + (1 << k)).otherwise(F.col("length"))
        runs = written(runs.select("doc", "pos", "source", grown.alias("length")), f"line-runs-{1 << k}", n)
    return runs


def without_lines(lines: Column, gone: Column) -> Column:
    """The text of an array of lines without those of the given numbers: what
    lies between two deleted lines is one slice."""
    before = F.concat(F.array(F.lit(-1)), gone)
    behind = F.concat(gone, F.array(F.size(lines)))
    return F.array_join(F.flatten(F.zip_with(before, behind, lambda a, b: F.slice(lines, a + 2, b - a - 1))), "\n")


def deduplicated(docs: DataFrame, min_lines: int = MIN_LINES, long_line: int = LONG_LINE, name: str = "_lines") -> DataFrame:
    """All rows and columns of `docs` and `name` (in place of a column of that
    name) with n_lines (not blank), n_removed, n_runs and kept, the text left.

    Null texts have no lines and kept is empty; blank lines stay.  Rows equal
    in doc_id and text are one document and share a result; lines are equal if
    they are after trimming white space.  An empty table gives an empty one."""
    rows = _measured(docs, repeated_lines(docs, min_lines, long_line), [])
    return rows.select(*[F.col("row").getField(c).alias(c) for c in docs.columns if c != name], F.col("lines").alias(name))


def _measured(docs: DataFrame, found: DataFrame, more: list[str]) -> DataFrame:
    """(row, lines, *more): `docs`' columns as a struct, in which no name can
    clash, and what was found, by document."""
    rows = docs.select(F.struct(*own_columns(docs)).alias("row"), document_key().alias("doc")).join(found, "doc", "left")
    text = F.coalesce(F.col("row.text").cast("string"), F.lit(""))
    rows = rows.select("row", F.split(text, "\n").alias("all"), text.alias("text"), "gone", "n_runs", *more)
    kept = F.when(F.col("gone").isNull(), F.col("text")).otherwise(without_lines(F.col("all"), F.col("gone")))
    measured = F.struct(
        F.size(F.filter("all", lambda x: _trimmed(x) != "")).cast("bigint").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("bigint").alias("n_removed"),
        F.coalesce(F.col("n_runs"), F.lit(0)).cast("bigint").alias("n_runs"), kept.alias("kept"))
    return rows.select("row", measured.alias("lines"), *more)


def report(docs: DataFrame, min_lines: int = MIN_LINES, long_line: int = LONG_LINE) -> DataFrame:
    """doc_id, n_lines, n_removed, n_runs, kept_sha256, n_copied_runs and
    longest_run (lines of the longest copied run, 0 without) of every row."""
    docs = docs.select("doc_id", "text")
    once, n = line_suffixes(docs)
    gone = repeated_lines(docs, min_lines, long_line, (once, n))
    whole = copied_runs(once, n, min_lines).groupBy("doc").agg(F.count("*").alias("n_copied_runs"), F.max("length").cast("bigint").alias("longest_run"))
    rows = _measured(docs, gone.join(whole, "doc", "full"), ["n_copied_runs", "longest_run"])
    zero = F.lit(0).cast("bigint")
    return rows.select(F.col("row.doc_id").cast("bigint").alias("doc_id"), "lines.n_lines", "lines.n_removed", "lines.n_runs", F.sha2("lines.kept", 256).alias("kept_sha256"),
                       F.coalesce("n_copied_runs", zero).alias("n_copied_runs"), F.coalesce("longest_run", zero).alias("longest_run"))
