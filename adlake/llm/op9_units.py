"""Substring dedup by line or paragraph hashing.

Units (lines or paragraphs) are normalised and digested; digests are grouped
globally; the earliest ranked occurrence of a digest stays and all others are
removed, with their places in the original text kept.  Rank: document id (null
first), text digest, unit number.

A passage that is repeated inside longer lines shows in finer units: sentences,
which end at a full stop, question or exclamation mark before white space, or at
the line's end.  Sentences of any length are grouped; a sentence repeats by
chance, but a run of neighbours that all occur elsewhere, PASSAGE_CHARS
characters together, doesn't.  `passages` reports these runs, the earliest
occurrence among them.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from adlake.llm.tables import document_key, maybe_in, own_columns, written

SEPARATORS = {"line": r"\n", "paragraph": r"\n(?:[\x20\x09-\x0D]*\n)+"}
SENTENCE = r"[.!?]+(?:[\x20\x09-\x0D]+|(?![\s\S]))|\n+"
PASSAGE_CHARS = 100  # of the normalised sentences of a run, at least
MIN_CHARS = 60  # shorter normalised units repeat by chance and stay


def normalised(unit: Column) -> Column:
    """Lower case, runs of white space as one space, none at the ends."""
    return F.trim(F.lower(F.regexp_replace(unit, r"[\x20\x09-\x0D]+", " ")))


def unit_rows(docs: DataFrame, unit: str = "line", min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc, unit, digest) of every unit of at least `min_chars` characters."""
    parts = docs.select(document_key().alias("doc"), F.posexplode(F.split("text", SEPARATORS[unit])).alias("unit", "part"))
    parts = parts.select("doc", "unit", normalised(F.col("part")).alias("part")).where(F.length("part") >= min_chars)
    return parts.select("doc", "unit", F.unhex(F.md5("part")).alias("digest"))


def later_units(units: DataFrame) -> DataFrame:
    """(doc, units): the numbers of the units to remove.  The earliest place is
    a partial aggregate, so a digest that a third of all units share is reduced
    before its shuffle; it is written, so that the join back can be split."""
    units = written(units, "units")
    first = written(units.groupBy("digest").agg(F.min(F.struct("doc", "unit")).alias("first"), F.count("*").alias("n"))
                    .where("n > 1").drop("n"), "unit-firsts", units.count())
    later = units.join(first, "digest").where(F.struct("doc", "unit") > F.col("first"))
    return later.groupBy("doc").agg(F.sort_array(F.collect_set("unit")).alias("units"))


def passages(docs: DataFrame, min_chars: int = PASSAGE_CHARS) -> DataFrame:
    """(doc, n_passages, n_passage_chars) of the documents that hold any: runs
    of neighbouring sentences which all occur at another place, too, of at least
    `min_chars` normalised characters together.  Sentences are counted by a
    partial aggregate; of those only that may repeat are shuffled again."""
    sentences = F.filter(F.transform(F.split("text", SENTENCE), normalised), lambda x: x != "")
    units = docs.select(document_key().alias("doc"), F.posexplode(sentences).alias("pos", "body"))
    units = units.select("doc", "pos", F.length("body").alias("chars"), F.xxhash64("body").alias("d1"), F.hash("body").alias("d2"))
    units = written(units, "unit-sentences")
    repeated = written(units.groupBy("d1", "d2").agg(F.count("*").alias("n")).where("n > 1").drop("n"), "unit-repeated", units.count())
    found = maybe_in(units, "d1", repeated).join(repeated, ["d1", "d2"]).dropDuplicates(["doc", "pos"])
    runs = found.withColumn("run", F.col("pos") - F.row_number().over(Window.partitionBy("doc").orderBy("pos")))
    runs = runs.groupBy("doc", "run").agg(F.sum("chars").alias("chars")).where(F.col("chars") >= min_chars)
    return runs.groupBy("doc").agg(F.count("*").alias("n_passages"), F.sum("chars").alias("n_passage_chars"))


def cut_units(text: Column, units: Column, unit: str = "line") -> Column:
    """Struct of the text without the given units and the code-point offsets
    (start, end, start, end, ...) of what went.  A unit goes with the separator
    behind it; the text doesn't end in the separator of a unit that went."""
    separator = re.compile(SEPARATORS[unit])

    @arrow_udf("kept string, spans array<long>")
    def cut(texts: pa.Array, gone: pa.Array) -> pa.Array:
        kept, spans = [], []
        for value, numbers in zip(texts, gone):
            body, drop = value.as_py() or "", set(numbers.as_py() or ())
            if not drop:
                kept.append(body)
                spans.append([])
                continue
            out, own, at, end = [], [], 0, 0
            for no, m in enumerate([*separator.finditer(body), None]):
                stop = m.start() if m else len(body)
                if no in drop:
                    own += [at, stop]
                else:
                    out += [body[at:stop], m[0] if m else ""]
                    end = len(out) - 1
                at = m.end() if m else stop
            kept.append("".join(out[:end]))
            spans.append(own)
        return pa.StructArray.from_arrays([pa.array(kept, pa.string()), pa.array(spans, pa.list_(pa.int64()))], names=["kept", "spans"])

    return cut(text, units)


def _cut_rows(docs: DataFrame, found: DataFrame, unit: str, more: list[str]) -> DataFrame:
    """(row, units, *more): `docs`' columns as a struct, in which no name can
    clash, and what was found, by document."""
    rows = docs.select(F.struct(*own_columns(docs)).alias("row"), document_key().alias("doc")).join(found, "doc", "left")
    text = F.col("row.text")
    rows = rows.select("row", *more, cut_units(text.cast("string"), F.col("units"), unit).alias("cut"))
    return rows.select("row", *more, F.struct(
        F.when(text.isNull(), 0).otherwise(F.size(F.split(text, SEPARATORS[unit]))).cast("bigint").alias("n_units"),
        (F.size("cut.spans") / 2).cast("bigint").alias("n_removed"), F.col("cut.kept").alias("kept"), F.col("cut.spans").alias("spans")).alias("units"))


def deduplicated(docs: DataFrame, unit: str = "line", min_chars: int = MIN_CHARS) -> DataFrame:
    """All rows and columns of `docs` and `_units` (in place of a column of that name) with n_units, n_removed,
    kept (the text left) and spans (offsets of removed units in the original).

    Null and empty texts have no units of that length and nothing to remove;
    kept is then empty.  Rows equal in doc_id and text are one document and
    share a result.  An empty table gives an empty one."""
    rows = _cut_rows(docs, later_units(unit_rows(docs, unit, min_chars)), unit, [])
    return rows.select(*[F.col("row").getField(c).alias(c) for c in docs.columns if c != "_units"], F.col("units").alias("_units"))


def report(docs: DataFrame, unit: str = "line", min_chars: int = MIN_CHARS, passage_chars: int = PASSAGE_CHARS) -> DataFrame:
    """doc_id, n_units, n_removed, n_removed_chars, spans (start:end, comma
    joined), kept_sha256, n_passages and n_passage_chars of every row of `docs`."""
    docs = docs.select("doc_id", "text")
    later = later_units(unit_rows(docs, unit, min_chars))
    rows = _cut_rows(docs, later.join(passages(docs, passage_chars), "doc", "full"), unit, ["n_passages", "n_passage_chars"])
    spans = F.col("units.spans")
    pairs = F.transform(F.filter(F.transform(spans, lambda x, i: F.struct(i.alias("i"), x.alias("x"))), lambda p: p["i"] % 2 == 0),
                        lambda p: F.concat_ws(":", p["x"].cast("string"), F.get(spans, p["i"] + 1).cast("string")))
    zero = F.lit(0).cast("bigint")
    return rows.select(
        F.col("row.doc_id").cast("bigint").alias("doc_id"), "units.n_units", "units.n_removed",
        F.aggregate(F.transform(spans, lambda x, i: F.when(i % 2 == 0, -x).otherwise(x)), zero, lambda a, x: a + x).alias("n_removed_chars"),
        F.array_join(pairs, ",").alias("spans"), F.sha2("units.kept", 256).alias("kept_sha256"),
        F.coalesce("n_passages", zero).alias("n_passages"), F.coalesce("n_passage_chars", zero).alias("n_passage_chars"))
