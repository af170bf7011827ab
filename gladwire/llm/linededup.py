"""Line dedup over overlapping windows of three lines.

Lines are the pieces between line feeds. Every three consecutive lines that
are not blank make a window, hashed with 128 bits; blank lines are skipped over
and edges of white space ignored. The first place of a window, by document id
and position, stays; at every later place the window's lines are covered, and
covered lines go. Overlapping windows merge, so a repeated passage of three
or more lines goes as a whole, with the blank lines inside it. A line that goes
always stands at an earlier place that stays.

Only windows that occur twice leave the counting, and only their places go
back to the documents. Counting is partial before the shuffle.

Defined cases: a null or empty text stays as it is; a text of fewer than
three lines has no window and stays; of equal texts under different ids the
first stays, later ones become empty and ``removed_lines`` tells how much
went; rows with equal id and text are one document and get the same result; a
null id comes first; ids that repeat with different texts are different
documents, in the order of the hash; columns of any name are carried along.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gladwire.llm.common import written

WINDOW = 3
_EDGES = " \t\r\x0b\f"


def _lines(text: str) -> Column:
    return F.split(F.col(text), "\n")


def _windows(text: str) -> Column:
    """``first, last, hash`` of every window: places of its outer lines from 0."""
    trimmed = F.transform(_lines(text), lambda line, i: F.struct(F.btrim(line, F.lit(_EDGES)).alias("l"), i.alias("i")))
    full = F.filter(trimmed, lambda p: p["l"] != "")

    def window(full: Column) -> Column:
        # The length before each line keeps apart what the line feed would not.
        joined = lambda i: F.concat_ws("\n", *(F.get(full, i + k)["l"] for k in range(WINDOW)))
        return F.transform(
            F.sequence(F.lit(0), F.size(full) - WINDOW),
            lambda i: F.struct(
                F.get(full, i)["i"].alias("first"), F.get(full, i + WINDOW - 1)["i"].alias("last"),
                F.unhex(F.md5(joined(i))).alias("hash"),
            ),
        )

    return F.get(F.transform(F.array(full), lambda f: F.when(F.size(f) >= WINDOW, window(f))), F.lit(0))


def repeated_places(docs: DataFrame) -> DataFrame:
    """``id, th, places``: first and last line of each later occurrence, by document."""
    placed = docs.select(
        F.col("doc_id").alias("id"), F.xxhash64("text").alias("th"), F.explode_outer(_windows("text")).alias("w")
    ).filter("w is not null")
    # Rows with equal id and text are one document.
    place = F.struct("id", "th", F.col("w.first").alias("first"))
    every = placed.select(F.col("w.hash").alias("hash"), place.alias("p"), F.col("w.last").alias("last"))
    counted = every.groupBy("hash").agg(F.min("p").alias("least"), F.max("p").alias("most"))
    repeated = written(counted.filter("least != most").select("hash", "least"), "windows")
    later = every.join(repeated.hint("merge"), "hash").filter("p != least")
    return later.groupBy(F.col("p.id").alias("id"), F.col("p.th").alias("th")).agg(
        F.collect_set(F.struct("p.first", "last")).alias("places")
    )


def dedup_lines(docs: DataFrame, count: str = "removed_lines") -> DataFrame:
    """The documents with shorter texts, and the number of removed lines behind their columns."""
    found = written(repeated_places(docs), "repeats").select(
        F.col("id").alias("_id"), F.col("th").alias("_th"), "places"
    )
    same = F.col("_docs.doc_id").eqNullSafe(F.col("_found._id")) & (
        F.xxhash64(F.col("_docs.text")) == F.col("_found._th")
    )
    # The places grow with the documents: never a side to broadcast.
    joined = docs.alias("_docs").join(found.alias("_found").hint("merge"), same, "left")
    covered = F.flatten(F.transform(F.col("_found.places"), lambda p: F.sequence(p["first"], p["last"])))
    gone = F.array_distinct(covered)
    lines = F.split(F.col("_docs.text"), "\n")
    numbers = F.sequence(F.lit(0), F.size(lines) - 1)
    left = F.array_except(numbers, gone)
    kept = F.array_join(F.transform(left, lambda i: F.get(lines, i)), "\n")
    changed = F.col("_found.places").isNotNull()
    text = F.when(changed, kept).otherwise(F.col("_docs.text"))
    return joined.select(
        *(text.alias("text") if c == "text" else F.col(f"_docs.`{c}`") for c in docs.columns),
        F.when(changed, F.size(gone)).otherwise(0).alias(count),
    )
